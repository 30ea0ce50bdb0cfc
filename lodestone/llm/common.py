"""Shared pieces of the corpus operators: checkpoints, exact distributed running totals, salted lookups."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.session import share_package
from lodestone.tables import shared_folder, written

#: A key with more than 1/CELLS of all rows is hot; there are at most CELLS such keys.
CELLS = 1024
#: Smallest share of rows that is worth a salt of its own.
LEAST_ROWS_PER_SALT = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Reads one of the given tables."""
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def durable(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def unused(name: str, columns: list[str]) -> str:
    """The name, lengthened until no column has it, whatever the letters' case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(docs: DataFrame) -> DataFrame:
    """row (all columns of `docs` in one struct, so that no name clashes) and number, different for each row.

    Numbers are written with the rows, so they stay as they are however often the result is read.
    """
    return written(docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("number")))


def seeded(seed: int, *parts: str | Column) -> Column:
    """32 hex digits that depend on the seed and the parts, and on nothing else; also expressible in plain SQL."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p, F.lit("")) for p in parts]))


def bucket_bits(total: int, rows_per_bucket: int = 256) -> int:
    """Bits of a bucket number that leave about `rows_per_bucket` of `total` rows in each bucket."""
    return min(28, max(0, math.ceil(math.log2(max(1, total) / rows_per_bucket)))) if total > rows_per_bucket else 0


def hex_bucket(u: str | Column, bits: int) -> Column:
    """The first `bits` (28 at most) of a hex string as a number: follows the order of the strings."""
    return F.shiftright(F.conv(F.substring(u, 1, 7), 16, 10).cast("long"), 28 - bits)


def with_running_total(rows: DataFrame, keys: DataFrame, group: list[str], bucket: str, order: list, measure: str, out: str, bits: int) -> DataFrame:
    """Adds `out`: the sum of `measure` over the rows of the same group up to and including this one.

    No group is held by one task: rows are numbered inside (group, bucket) cells, whose totals give each
    cell's offset. The totals are themselves summed in two levels. `bucket` must be an integer below
    2**bits that does not decrease along `order`; `keys` has group, bucket and measure for the same rows
    (a cheaper projection than `rows`, or `rows` itself). Group columns must not be null.
    """
    half = (bits + 1) // 2
    cells = keys.groupBy(*group, bucket).agg(F.sum(measure).alias("_sum")).withColumn("_coarse", F.shiftright(F.col(bucket), half))
    coarse = cells.groupBy(*group, "_coarse").agg(F.sum("_sum").alias("_coarse_sum"))
    before = (Window.unboundedPreceding, -1)
    coarse = coarse.withColumn("_coarse_before", F.coalesce(F.sum("_coarse_sum").over(Window.partitionBy(*group).orderBy("_coarse").rowsBetween(*before)), F.lit(0))).drop("_coarse_sum")
    fine = cells.withColumn("_before", F.coalesce(F.sum("_sum").over(Window.partitionBy(*group, "_coarse").orderBy(bucket).rowsBetween(*before)), F.lit(0)))
    offsets = fine.join(coarse, [*group, "_coarse"]).select(*group, bucket, (F.col("_before") + F.col("_coarse_before")).alias("_offset"))
    inside = F.sum(measure).over(Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("_inside", inside).join(offsets, [*group, bucket]).withColumn(out, (F.col("_offset") + F.col("_inside")).cast("long")).drop("_offset", "_inside")


def salted_lookup(rows: DataFrame, groups: DataFrame, keys: list[str], count: str, total: int, spread: list[str], how: str = "inner") -> DataFrame:
    """Joins `rows` with one row of `groups` for each key, although one key may hold a third of the rows.

    `groups` has the number of rows of each key in `count`. Keys with more than total / CELLS rows are
    hot; there are CELLS of them at most, so they can be broadcast. Rows of a hot key are salted by
    `spread`, and its row in `groups` is repeated for each salt. Keys must not be null.
    """
    limit = max(total // CELLS, LEAST_ROWS_PER_SALT)
    salts = F.when(F.col(count) > limit, F.ceil(F.col(count) / F.lit(limit))).otherwise(F.lit(1)).cast("int")
    hot = groups.filter(F.col(count) > limit).select(*keys, salts.alias("_salts"))
    salted = rows.join(F.broadcast(hot), keys, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(*spread), F.col("_salts")), F.lit(0)).cast("int")).drop("_salts")
    repeated = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
