"""JSON documents as rows of path and leaf."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.tables import written


def flattened(rows: DataFrame, key: str, text: str) -> DataFrame:
    """key, path and leaf for every leaf of each JSON text, however deep; no rows for null or broken texts.

    Texts are parsed once into variants, which are taken apart level by level, each written and made from the one above it
    alone; properties whose names begin with
    `$comment` are left out. A null leaf is null, an empty object or array has no leaf.
    """
    spark = rows.sparkSession
    level = rows.select(F.col(key).alias("_key"), F.lit("").alias("_path"), F.try_parse_json(text).alias("_v")).filter("_v IS NOT NULL")
    inner = F.schema_of_variant("_v").rlike("^(OBJECT|ARRAY)")
    leaves = []
    while True:
        leaves.append(level.filter(~inner).select(F.col("_key").alias(key), F.col("_path").alias("path"), F.try_variant_get("_v", "$", "string").alias("leaf")))
        nested = level.filter(inner)
        if not nested.limit(1).count():
            return reduce(DataFrame.unionByName, leaves)
        step = F.when(F.col("key").isNull(), F.concat("_path", F.lit("["), F.col("pos").cast("string"), F.lit("]"))).otherwise(F.concat("_path", F.when(F.col("_path") == "", F.lit("")).otherwise(F.lit(".")), "key"))
        found = nested.lateralJoin(spark.tvf.variant_explode(F.col("_v").outer())).filter(F.col("key").isNull() | ~F.coalesce(F.startswith("key", F.lit("$comment")), F.lit(False)))
        level = written(found.select("_key", step.alias("_path"), F.col("value").alias("_v")))


def searched(leaves: DataFrame, needle: str) -> DataFrame:
    """Distinct member ids (prefix:name) among paths' last names and leaves that contain `needle`."""
    last = F.regexp_extract("path", r"([^.\[\]]+)(?:\[[0-9]+\])?$", 1)
    found = leaves.select(F.explode(F.array(last, F.col("leaf"))).alias("id"))
    return found.filter(F.contains("id", F.lit(needle)) & F.col("id").rlike("^[a-z-]+:")).distinct()


def harvested(leaves: DataFrame, names: list[str]) -> DataFrame:
    """References under the given property names: strings, members of arrays, and keys and values of maps."""
    own = F.regexp_extract("path", r"([^.\[\]]+)(?:\[[0-9]+\])?$", 1)
    above = F.regexp_extract("path", r"([^.\[\]]+)\.([^.\[\]]+)(?:\[[0-9]+\])?$", 1)
    direct = leaves.filter(own.isin(*names)).select("path", F.col("leaf").alias("ref"))
    maps = leaves.filter(above.isin(*names)).select("path", F.explode(F.array(own, F.col("leaf"))).alias("ref"))
    return direct.unionByName(maps).filter("ref IS NOT NULL").distinct()
