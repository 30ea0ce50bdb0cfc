"""Enriching unit records from an index of all units, as versions of a table that are published in one step."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.tables import written

RECORDS = (
    "unit string, dependencies array<struct<id: string, token: string, resolved: string>>, outbound array<string>, inbound array<string>, "
    "requests array<struct<id: string, method: string, url: string, via: string, service: string, direct: boolean>>"
)
_NO_TEXTS = "cast(array() as array<string>)"


def _version_names(spark: SparkSession, folder: str) -> list[tuple[str, bool]]:
    """The names under `published`, ascending, and whether each was written whole."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    files = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    where = path(f"{folder}/published")
    names = sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []
    return [(name, files.exists(path(f"{folder}/published/{name}/_SUCCESS"))) for name in names]


def publish(records: DataFrame, folder: str) -> None:
    """Writes records as the next version of a table.

    The data goes to a folder of its own first; a one-row table under `published` then names it. Readers go by that table
    alone, so a version is there whole or not at all, and a writer that is lost midway leaves the last one as it is. A
    number that is taken, even by a writer that was lost, is not written again.
    """
    spark = records.sparkSession
    names = _version_names(spark, folder)
    data = f"data-{uuid.uuid4().hex}"
    records.write.parquet(f"{folder}/{data}")
    number = 1 + max((int(name) for name, _ in names), default=-1)
    spark.createDataFrame([(number, data)], "version bigint, data string").coalesce(1).write.mode("error").parquet(f"{folder}/published/{number:09d}")


def published(spark: SparkSession, folder: str) -> tuple[int, str] | None:
    """The number and the data's folder of the last version that was published whole."""
    whole = [name for name, done in _version_names(spark, folder) if done]
    if not whole:
        return None
    row = spark.read.parquet(f"{folder}/published/{whole[-1]}").first()
    return row["version"], row["data"]


def snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The records of the last version."""
    version = published(spark, folder)
    if version is None:
        raise FileNotFoundError(f"no version in {folder}")
    return spark.read.schema(RECORDS).parquet(f"{folder}/{version[1]}")


def enrichment(records: DataFrame, index: DataFrame, edges: DataFrame, requests: DataFrame) -> DataFrame:
    """The records (RECORDS) that the index changes, with the fields that it fills, and counts of what was filled.

    * Dependencies without a resolved unit get the unit of the `index` (unit, kind, class_name) whose class is their token;
      of several the first by unit.
    * Empty lists of units that a unit uses (outbound) or that use it (inbound) come from `edges` (from, to), sorted.
    * An empty list of requests gets those (service, ord, method, url) of the services that the dependencies resolve to, by
      dependency and ord, numbered from 1 and marked as indirect.

    What is there already stays, so running it again changes nothing. Edges are made distinct and lists grouped once for a
    unit; a class that very many dependencies name is looked up by a join on its name, which adaptive execution splits.
    """
    classes = index.filter("class_name IS NOT NULL").groupBy(F.col("class_name").alias("token")).agg(F.min(F.struct("unit", "kind")).alias("u"))
    deps = records.select("unit", F.posexplode("dependencies").alias("pos", "d"))
    named = deps.select("unit", "pos", "d.id", "d.token", "d.resolved").join(classes.select("token", F.col("u.unit").alias("found")), "token", "left")
    whole = named.select("unit", "pos", "id", "token", F.coalesce("resolved", "found").alias("resolved"), (F.col("resolved").isNull() & F.col("found").isNotNull()).alias("filled"))
    listed = whole.groupBy("unit").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "id", "token", "resolved"))), lambda x: F.struct(x["id"].alias("id"), x["token"].alias("token"), x["resolved"].alias("resolved"))).alias("new_dependencies"),
        F.count(F.when(F.col("filled"), 1)).alias("ids_filled"),
    )
    links = edges.select("from", "to").distinct()
    out = links.groupBy(F.col("from").alias("unit")).agg(F.array_sort(F.collect_list("to")).alias("new_outbound"))
    into = links.groupBy(F.col("to").alias("unit")).agg(F.array_sort(F.collect_list("from")).alias("new_inbound"))
    services = index.filter("kind = 'service'").select(F.col("unit").alias("service")).distinct()
    through = whole.select("unit", "pos", F.col("id").alias("via"), F.col("resolved").alias("service")).join(services, "service").join(requests, "service")
    numbered = F.transform(
        F.array_sort(F.collect_list(F.struct("pos", "ord", "method", "url", "via", "service"))),
        lambda x, i: F.struct(F.concat(F.lit("http:"), (i + 1).cast("string")).alias("id"), x["method"].alias("method"), x["url"].alias("url"), x["via"].alias("via"), x["service"].alias("service"), F.lit(False).alias("direct")),
    )
    asked = through.groupBy("unit").agg(numbered.alias("new_requests"))
    rows = records.join(listed, "unit", "left").join(out, "unit", "left").join(into, "unit", "left").join(asked, "unit", "left")
    empty = lambda c: F.coalesce(F.size(c) == 0, F.lit(True))
    filled = lambda c: F.when(empty(c), F.coalesce(F.size(f"new_{c}"), F.lit(0))).otherwise(0).alias(f"{c}_filled")
    counts = rows.select("*", *[filled(c) for c in ("outbound", "inbound", "requests")]).na.fill(0, ["ids_filled"])
    changed = counts.filter("ids_filled + outbound_filled + inbound_filled + requests_filled > 0")
    taken = lambda c: F.when(F.col(f"{c}_filled") > 0, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c)
    return changed.select("unit", F.coalesce("new_dependencies", "dependencies").alias("dependencies"), *[taken(c) for c in ("outbound", "inbound", "requests")], "ids_filled", "outbound_filled", "inbound_filled", "requests_filled")


def merged(records: DataFrame, changed: DataFrame) -> DataFrame:
    """Records with those of `changed` in place of their own."""
    names = records.columns
    new = changed.select("unit", F.struct(*[c for c in names if c != "unit"]).alias("new"))
    rows = records.join(new, "unit", "left")
    return rows.select("unit", *[F.when(F.col("new").isNull(), F.col(c)).otherwise(F.col(f"new.{c}")).alias(c) for c in names if c != "unit"])


def enrich_table(spark: SparkSession, folder: str, index: DataFrame, edges: DataFrame, requests: DataFrame) -> dict[str, int]:
    """Enriches the last version of a table and publishes the result, if anything changed; returns the counts of the report.

    Safe to run twice, also after a run that was lost before it published: what it had not published it makes anew.
    """
    records = snapshot(spark, folder)
    changed = written(enrichment(records, index, edges, requests))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    row = changed.agg(
        F.count(F.when(F.col("ids_filled") > 0, 1)).alias("signature_updates"),
        F.count(F.when(F.expr("outbound_filled + inbound_filled + requests_filled > 0"), 1)).alias("dependency_updates"),
        total("requests_filled").alias("requests_added"),
        total(F.when(F.col("outbound_filled") > 0, F.expr("outbound_filled + inbound_filled")).otherwise(0)).alias("edges_added"),
        F.count(F.lit(1)).alias("units"),
    ).first()
    if row["units"]:
        publish(merged(records, changed), folder)
    return {k: v for k, v in row.asDict().items() if k != "units"}
