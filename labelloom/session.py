"""Session helpers: shared folder, written intermediate tables, table loading."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Share of the driver's greatest heap that the heap may take before plans of finished jobs are let go.
HEAP_SHARE = 0.5


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    Read from ``spark.checkpoint.dir``. Only where that is unset and the master is local (tests) a
    temporary folder is made and set; on a cluster that is an error.
    """
    jsc = spark.sparkContext._jsc.sc()
    current = jsc.getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", "") or spark.conf.get("spark.checkpoint.dir", "")
    if not configured and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    spark.sparkContext.setCheckpointDir(configured or tempfile.mkdtemp(prefix="spark-labelloom-"))
    return jsc.getCheckpointDir().get()


def released(spark: SparkSession) -> None:
    """Let go of what the driver holds of finished jobs, if its heap has grown over ``HEAP_SHARE`` of the greatest.

    Rounds of small jobs leave plans, task results and broadcasts behind. Collected late, they make the heap grow
    to its limit, though little of it lives; collected here, shuffles and broadcasts of past rounds go with them.
    """
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime()
    if heap.totalMemory() > HEAP_SHARE * heap.maxMemory():
        gc.collect()  # DataFrames that Python still refers to in cycles keep theirs
        spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends here, and a lost
    executor costs no recomputation of what lies before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    released(spark)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint (partitions and order are kept, files go with the DataFrame)."""
    shared_dir(df.sparkSession)
    out = df.checkpoint(eager=True)
    released(df.sparkSession)
    return out


def broadcast_if_small(df: DataFrame, most: int = 1_000_000) -> DataFrame:
    """``df``, to be broadcast if it has at most ``most`` rows (counted now); else Spark chooses how to join it."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 512, size: int = 4 << 20) -> None:
    """Bound an Arrow batch by rows and bytes, so that Python workers hold few long documents at a time.

    Options of the session, which stay set: plans run later than they are made.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        now = spark.conf.get(key, None)
        number = int(now.removesuffix("b")) if now and now.removesuffix("b").lstrip("-").isdigit() else 0
        if number <= 0 or number > most:
            spark.conf.set(key, str(most))
