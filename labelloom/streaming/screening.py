"""Screening of arriving files as a stream: the same expressions as in batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from labelloom.functions.images import screen_content


def screened_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """Files as they arrive under ``path`` with ``mime`` and ``screen_code``."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("maxFilesPerTrigger", files_per_trigger).load(path)
    return screen_content(files)
