"""Incremental runs over a stream of source files: only new content is processed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lodestone.operators.incremental import changed_units, content_hash


def run_incrementally(spark: SparkSession, sources: str, cache: str, checkpoint: str, process: Callable[[DataFrame], None]) -> StreamingQuery:
    """Reads new text files under `sources` and calls `process` with those whose content the cache table lacks.

    A batch that is repeated after a failure processes only what it had not cached. Ends when all files present
    are read.
    """
    files = spark.readStream.format("text").option("wholetext", True).load(sources)
    units = files.select(F.col("_metadata.file_path").alias("unit"), F.col("value").alias("text"), content_hash(F.col("value")).alias("hash"))
    known = "unit string, hash string"

    def batch(rows: DataFrame, number: int) -> None:
        try:
            cached = rows.sparkSession.read.schema(known).parquet(cache)
        except Exception as e:  # the first batch finds no cache table
            if "PATH_NOT_FOUND" not in str(e):
                raise
            cached = rows.sparkSession.createDataFrame([], known)
        fresh = changed_units(rows, cached).persist()
        process(fresh)
        fresh.select("unit", "hash").write.mode("append").parquet(cache)
        fresh.unpersist()

    return units.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
