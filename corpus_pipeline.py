"""A corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again before
the next stage begins. All stages but the last keep the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from labelloom.llm import decontaminate, minhash, packing, pii, quality, tokens
from labelloom.session import table, written


#: Words an encoder remembers here: workers go from stage to stage and share an executor's memory.
ENCODER_MEMORY = 200_000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays (five-word shingles, similarity 0.8)."""
    return minhash.keep_one(docs, k=5)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts."""
    return decontaminate.remove_spans(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind."""
    return pii.redact(docs, pii.train(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are encoded and packed into sequences of 4,096 ids."""
    return packing.pack_documents(docs, tokens.default_path(), memory=ENCODER_MEMORY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality_stage),
    ("near_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("packing", packing_stage),
]

#: Stages that train a model or encode text have no SQL; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
