"""Tables for intermediate results in the folder that all executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


class _Written(threading.local):
    """Tables that `written` wrote in this thread and nothing has removed yet: queries in other threads keep theirs."""

    def __init__(self) -> None:
        self.paths: list[str] = []


_WRITTEN = _Written()


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and tables that all executors see: the one that `spark.checkpoint.dir` names.

    Only in local mode, as in tests, a temporary one is made where none is named; on a cluster that is an error, since
    executors do not share the driver's disk.
    """
    context = spark.sparkContext
    if not context.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="spark-"))
    return spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Cuts the lineage with a table in the shared folder: for loops, since a checkpoint carries the optimizer's
    constraints along, which grow from round to round, and for whole rows, since it is compressed."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    _WRITTEN.paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever file system it is."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def discard(*tables: DataFrame) -> None:
    """Deletes what `written` wrote for these."""
    for df in tables:
        for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            remove(df.sparkSession, name)
            _WRITTEN.paths[:] = [path for path in _WRITTEN.paths if not name.endswith(path.rsplit("/", 1)[1])]


def tables_written() -> int:
    """A mark for `discard_since`."""
    return len(_WRITTEN.paths)


def discard_since(spark: SparkSession, mark: int) -> None:
    """Deletes every table that this thread has written since the mark; whatever was to be read from them must have been read."""
    while len(_WRITTEN.paths) > mark:
        remove(spark, _WRITTEN.paths.pop())
