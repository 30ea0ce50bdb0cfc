"""Proportional stratified interleaving: every shard gets the mixture of the sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import bucket_bits, durable, hex_bucket, numbered, seeded, table, unused, with_running_total

SHARDS = 40
SEED = 7
#: Rows of a shard that one task writes.
FILE_ROWS = 100_000


def stratum_of(source: Column) -> Column:
    """A name that is never null: null sources are a stratum of their own."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("-"))


def interleaved_shards(docs: DataFrame, n_shards: int = SHARDS, seed: int = SEED, id_col: str = "doc_id", stratum_col: str = "source", text_col: str = "text", number_col: str | None = None) -> DataFrame:
    """For each row: doc_id, stratum, size, text_crc32, shard, slot, and `number` if a column is named for it.

    Rows are shuffled by a seeded hash inside their stratum and numbered 1..n; row k stands at the
    fraction (k - 1 + phase) / n, with a seeded phase for each stratum, so that strata of one row spread
    too. All rows are then ordered by fraction (ties: stratum, hash, id) and cut into `n_shards` runs
    whose lengths differ by one at most, so that a shard holds each stratum's share to within one row or
    two. Both numberings are distributed running counts over small buckets: no stratum, and no run, is
    held by one task, and texts are not shuffled.

    Null text has size 16 and the CRC of no bytes; very long texts count whole; null sources form a stratum. Rows that repeat an id
    get places of their own. With fewer rows than shards some shards are empty; an empty table gives an
    empty result. Other columns are not read.
    """
    total = docs.count()
    bits = bucket_bits(total)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        stratum_of(F.col(stratum_col)).alias("stratum"),
        (F.octet_length(F.coalesce(text_col, F.lit(""))) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(text_col, F.lit("")).cast("binary")).alias("text_crc32"),
        *([] if number_col is None else [F.col(number_col).alias("number")]),
    ).withColumn("u", seeded(seed, "doc_id"))
    rows = rows.withColumns({"bucket": hex_bucket("u", bits), "one": F.lit(1)})
    keys = docs.select(stratum_of(F.col(stratum_col)).alias("stratum"), hex_bucket(seeded(seed, F.col(id_col).cast("string")), bits).alias("bucket"), F.lit(1).alias("one"))
    sizes = keys.groupBy("stratum").agg(F.count(F.lit(1)).alias("of"))
    phase = F.conv(F.substring(seeded(seed + 1, "stratum"), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    sizes = sizes.withColumn("phase", phase)
    ranked = with_running_total(rows, keys, ["stratum"], "bucket", ["u", F.col("doc_id").asc_nulls_first(), "text_crc32", "size"], "one", "k", bits)
    placed = ranked.drop("bucket").join(sizes, "stratum").withColumn("fraction", (F.col("k") - 1 + F.col("phase")) / F.col("of"))
    buckets = 1 << bits
    bucket = F.least(F.lit(buckets - 1), F.floor(F.col("fraction") * buckets)).cast("long")
    placed = durable(placed.withColumns({"bucket": bucket, "whole": F.lit("all")}))
    order = ["fraction", "stratum", "u", F.col("doc_id").asc_nulls_first(), "text_crc32", "size", "k"]
    placed = with_running_total(placed, placed, ["whole"], "bucket", order, "one", "position", bits)
    shard = F.expr(f"(position - 1) * {n_shards} div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {n_shards - 1}) div {n_shards}")
    placed = placed.withColumn("shard", shard).withColumn("slot", F.col("position") - 1 - first)
    return placed.select("doc_id", "stratum", "size", "text_crc32", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), *([] if number_col is None else ["number"]))


def shard_documents(docs: DataFrame, path: str, n_shards: int = SHARDS, seed: int = SEED) -> None:
    """Writes the documents under `path`, a folder `shard=k` for each shard, with the slot as a last column.

    Rows are numbered first and find their place by number, so null and repeated ids keep all their rows. A file has
    FILE_ROWS rows of a shard at most, in slot order. Where documents have columns shard or slot, ours get a `_` more.
    Very long texts are written whole; documents that tie in their fraction are in the order of `interleaved_shards`. An
    empty table writes no shard.
    """
    rows = numbered(docs)
    flat = rows.select("number", *[F.col("row")[c].alias(c) for c in ("doc_id", "source", "text")])
    places = interleaved_shards(flat, n_shards, seed, number_col="number").select("number", "shard", "slot", F.expr(f"slot div {FILE_ROWS}").alias("file"))
    shard, slot = unused("shard", docs.columns), unused("slot", docs.columns)
    files = max(1, -(-rows.count() // FILE_ROWS) + n_shards)
    placed = rows.join(places, "number").repartition(files, "shard", "file").sortWithinPartitions("shard", "slot")
    placed.select("row.*", F.col("slot").alias(slot), F.col("shard").alias(shard)).write.partitionBy(shard).parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Law `rows`: the shards' row counts differ by one at most."""
    found = interleaved_shards(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


QUERIES = {"op4_stratified_interleaving": query}
ORACLES: dict[str, str] = {}
