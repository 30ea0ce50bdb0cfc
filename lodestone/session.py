"""A Spark session with the settings that the library expects."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

#: Adaptive execution splits skewed joins and merges small partitions; times are in UTC.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(name: str = "lodestone", cpus: int | None = None, **settings: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    cpus = cpus or os.cpu_count() or 1
    conf = SETTINGS | {"spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "8g"} | settings
    spark = SparkSession.builder.master(f"local[{cpus}]").appName(name).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def share_package(spark: SparkSession) -> None:
    """Lets Python workers that start later import this package.

    In local mode they find it where the driver has it. On a cluster Spark sends it to them, once, as a zip file.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    context = spark.sparkContext
    paths = context.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root in paths:
        return
    context.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
    if not context.master.startswith("local["):
        archive = os.path.join(tempfile.mkdtemp(), "lodestone")
        context.addPyFile(shutil.make_archive(archive, "zip", root, "lodestone"))
