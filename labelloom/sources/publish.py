"""Versions of a dataset: written and checked aside, then published by one atomic rename.

A published dataset is a folder with ``versions/<id>`` and a small file ``CURRENT`` that names one of them. A new
version is written beside the others; its counters are observed while it is written; it is checked as it lies there;
then a new ``CURRENT`` is renamed over the old one. Whoever reads sees the old version or the new one, whole. A job that
stops in between leaves a version that nothing names: the old one stays, and the next one is published as usual.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from labelloom.operators.checks import assert_checks, check_split
from labelloom.schemas import RATIOS

CURRENT, VERSIONS = "CURRENT", "versions"


def _hadoop(spark: SparkSession, path: str):
    """(file context, a function from text to a Hadoop path) of the store of ``path``."""
    jvm = spark._jvm
    to_path = jvm.org.apache.hadoop.fs.Path
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to_path(path).toUri(), spark._jsc.hadoopConfiguration())
    return context, to_path


def current_version(spark: SparkSession, path: str) -> str | None:
    """The id of the published version; None if there is none."""
    context, to_path = _hadoop(spark, path)
    if not context.util().exists(to_path(f"{path}/{CURRENT}")):
        return None
    return spark.read.text(f"{path}/{CURRENT}").first()[0].strip()


def versions(spark: SparkSession, path: str) -> list[str]:
    """The ids of all versions, published ones or not."""
    context, to_path = _hadoop(spark, path)
    if not context.util().exists(to_path(f"{path}/{VERSIONS}")):
        return []
    return sorted(s.getPath().getName() for s in context.util().listStatus(to_path(f"{path}/{VERSIONS}")))


def point_to(spark: SparkSession, path: str, version: str) -> None:
    """Make ``version`` the published one: a file of its name replaces ``CURRENT`` in one step."""
    context, to_path = _hadoop(spark, path)
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    flags = jvm.java.util.EnumSet.of(jvm.org.apache.hadoop.fs.CreateFlag.CREATE)
    beside = to_path(f"{path}/.{CURRENT}-{uuid.uuid4().hex}")
    out = context.create(beside, flags, gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$CreateOpts"), 0))
    out.write(bytearray(f"{version}\n".encode()))
    out.close()
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context.rename(beside, to_path(f"{path}/{CURRENT}"), how)


def publish(df: DataFrame, path: str, check: Callable[[DataFrame], None] | None = None, overwrite: bool = False, partition_by: tuple[str, ...] = (), counters: dict[str, Column] | None = None) -> dict:
    """Write ``df`` as a new version, ``check`` it there (it raises to refuse), publish it.

    Returns ``version`` and the ``counters``, aggregates that are observed by the write itself. Without ``overwrite``,
    a dataset that is published already is refused before anything is written.
    """
    spark = df.sparkSession
    if current_version(spark, path) is not None and not overwrite:
        raise ValueError(f"{path} exists")
    version = uuid.uuid4().hex
    seen = Observation(f"publish-{version}")
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in (counters or {}).items()])
    counted.write.partitionBy(*partition_by).parquet(f"{path}/{VERSIONS}/{version}")
    if check is not None:
        check(spark.read.schema(df.schema).parquet(f"{path}/{VERSIONS}/{version}"))
    point_to(spark, path, version)
    return {"version": version, **seen.get}


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The published version."""
    version = current_version(spark, path)
    if version is None:
        raise ValueError(f"nothing is published at {path}")
    return spark.read.parquet(f"{path}/{VERSIONS}/{version}")


def drop_versions(spark: SparkSession, path: str) -> list[str]:
    """Delete all versions but the published one: what stopped jobs and replaced datasets left. Nobody may be reading
    or writing them."""
    context, to_path = _hadoop(spark, path)
    kept = current_version(spark, path)
    gone = [v for v in versions(spark, path) if v != kept]
    for v in gone:
        context.delete(to_path(f"{path}/{VERSIONS}/{v}"), True)
    return gone


def split_counters(splits: tuple[str, ...] = tuple(RATIOS), classes: tuple[int, ...] = (0, 1), status_col: str = "annotation_status") -> dict[str, Column]:
    """Images, negatives and boxes per class of each split, and invalid rows, as aggregates of a manifest."""
    out = {"invalid": F.count_if(F.col(status_col) == "invalid")}
    for s in splits:
        here = F.col("split") == s
        out |= {f"{s}_images": F.count_if(here), f"{s}_negatives": F.count_if(here & F.col("is_negative"))}
        out |= {f"{s}_class_{c}": F.coalesce(F.sum(F.when(here, F.col(f"instances_class_{c}"))), F.lit(0)).cast("long") for c in classes}
    return out


def publish_manifest(manifest: DataFrame, path: str, overwrite: bool = False, **limits) -> dict:
    """Publish a manifest that passes all checks, partitioned by split; returns its version and counters."""
    return publish(manifest, path, lambda written: assert_checks(check_split(written, **limits)), overwrite, ("split",), split_counters())
