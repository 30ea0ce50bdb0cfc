"""Tier documents of units, and the records of runs, as files: reading, writing and their versions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.text import base_name, dir_name

# The tiers of a unit, and of a repository.
TIERS = ("signature", "dependencies", "functions", "template", "analysis")
REPOSITORY_TIERS = ("index",)


def tier_of(path):
    """The tier that a file's name stands for, with or without the prefix `expected.`; null for other files."""
    stem = F.regexp_extract(base_name(path), r"^(?:expected\.)?(.*)\.json$", 1)
    return F.when(stem.isin(*TIERS, *REPOSITORY_TIERS), stem)


def read_tiers(spark: SparkSession, path: str) -> DataFrame:
    """unit (its folder), tier, path, text, version and status of every tier document under a folder.

    Documents that are no JSON stay, with status `broken`; files of other names are left out. Only names are looked at
    before texts are read.
    """
    files = spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(path)
    return tiers_of(files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")))


def tiers_of(files: DataFrame) -> DataFrame:
    """The tier documents among files (path, text), as `read_tiers` gives them."""
    named = files.withColumn("tier", tier_of(F.col("path"))).filter("tier IS NOT NULL")
    parsed = F.try_parse_json("text")
    return named.select(
        dir_name(F.col("path")).alias("unit"), "tier", "path", "text", F.try_variant_get(parsed, "$.schemaVersion", "string").alias("version"),
        F.when(parsed.isNull(), "broken").otherwise("ok").alias("status"),
    )


def schema_versions(files: DataFrame) -> DataFrame:
    """tier and version that each schema (path, text) asks for; null where it pins none."""
    tier = F.regexp_extract(base_name(F.col("path")), r"^(.*)\.schema\.json$", 1)
    return files.select(tier.alias("tier"), F.try_variant_get(F.try_parse_json("text"), "$.properties.schemaVersion.const", "string").alias("version")).filter("tier <> ''")


def checked_versions(tiers: DataFrame, wanted: DataFrame) -> DataFrame:
    """Tier documents with their outcome: ok, broken, legacy (another version than `wanted`) or skipped (no schema)."""
    asked = wanted.select("tier", F.col("version").alias("_wanted"), F.lit(True).alias("_known"))
    old = F.col("_wanted").isNotNull() & ~F.col("version").eqNullSafe(F.col("_wanted"))
    outcome = F.when(F.col("_known").isNull(), "skipped").when(F.col("status") == "broken", "broken").when(old, "legacy").otherwise("ok")
    return tiers.join(asked, "tier", "left").withColumn("outcome", outcome).drop("_wanted", "_known")


def unit_folders(tiers: DataFrame) -> DataFrame:
    """The folders that hold a tier document, once each."""
    return tiers.select("unit").distinct()


def loaded_units(asked: DataFrame, tiers: DataFrame) -> DataFrame:
    """unit, found (its tiers, sorted) and status of the units asked for; one without any tier is `missing`."""
    found = tiers.filter("status = 'ok'").groupBy("unit").agg(F.array_sort(F.collect_set("tier")).alias("found"))
    return asked.select("unit").join(found, "unit", "left").select("unit", F.coalesce("found", F.expr("array()")).alias("found"), F.when(F.col("found").isNull(), "missing").otherwise("ok").alias("status"))


def write_tiers(tiers: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Writes tier documents (unit, tier, text), a folder for each tier."""
    tiers.select("unit", "tier", "text").write.mode(mode).partitionBy("tier").parquet(path)


def index_lines(units: DataFrame, edges: DataFrame) -> DataFrame:
    """One JSON line for each unit, with the units that it depends on, sorted; lines instead of one document, since a
    repository's index has no bound. Units that do not depend on any have an empty list."""
    targets = edges.groupBy(F.col("from").alias("unit_id")).agg(F.array_sort(F.collect_set("to")).alias("dependsOn"))
    rows = units.join(targets, "unit_id", "left").withColumn("dependsOn", F.coalesce("dependsOn", F.expr("array()")))
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))


def cache_records(hashed: DataFrame) -> DataFrame:
    """unit, hash, tier and cached_at of what has been processed: hashed has unit, hash and tier."""
    return hashed.select("unit", "hash", "tier", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("cached_at"))


def required_files(tier):
    """The files that a processed unit must have; units that are not trivial have two more."""
    always = ("signature.json", "dependencies.json", "functions.json", "template.json")
    return F.when(tier == "trivial", F.array(*[F.lit(f) for f in always])).otherwise(F.array(*[F.lit(f) for f in (*always, "analysis.json", "requirement.md")]))


def still_valid(current: DataFrame, cached: DataFrame, files: DataFrame) -> DataFrame:
    """The units (unit, hash) whose cached record has the same hash and whose required files (unit, name) are all there."""
    have = files.groupBy("unit").agg(F.collect_set("name").alias("_have"))
    same = current.join(cached.select("unit", "hash", "tier"), ["unit", "hash"]).join(have, "unit")
    return same.filter(F.size(F.array_except(required_files(F.col("tier")), "_have")) == 0).select("unit", "hash", "tier")


def index_needed(stored: DataFrame, root: str) -> bool:
    """Whether the index has to be built: there is none, or it is one of another source folder (src_root)."""
    return stored.filter(F.col("src_root") == root).limit(1).count() == 0


def inputs_hash(files: DataFrame) -> DataFrame:
    """unit and hash over its files (unit, path, text), in the order of their paths, so that names count as well.

    Each text is hashed where it is read; a unit's row holds its files' names and hashes, not their texts.
    """
    digests = files.select("unit", "path", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"))
    ordered = F.array_sort(F.collect_list(F.struct("path", "digest")))
    return digests.groupBy("unit").agg(F.sha2(F.array_join(F.transform(ordered, lambda f: F.concat(f.getField("path"), F.lit("="), f.getField("digest"))), "\n"), 256).alias("hash"))
