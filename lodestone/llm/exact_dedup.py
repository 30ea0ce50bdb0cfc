"""Exact duplicates: 128-bit content hashes, bytes compared inside hash groups, one row of each group stays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.common import durable, salted_lookup, table

#: Deleted before texts are compared: the characters of [\x20\x09-\x0D].
WHITE_SPACE = "\x20\x09\x0a\x0b\x0c\x0d"


def without_white_space(text: Column) -> Column:
    """The text (null: empty) without any white space character."""
    out = F.coalesce(text, F.lit(""))
    for c in WHITE_SPACE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def content_hash(text: Column) -> Column:
    """128 bits."""
    return F.unhex(F.md5(text))


def _points(text: Column) -> Column:
    return F.length(F.coalesce(text, F.lit("")))


def _groups(docs: DataFrame, hashed: Callable[[Column], Column]) -> DataFrame:
    """h, text_sha256, points and keep_id (of the row that stays), group_size: a row for each different text.

    Rows are grouped by hash and then by the normalised bytes themselves, so that a collision of `hashed` makes two
    groups; copies are combined before the shuffle, so that a group of any size sends one text from each task.
    """
    rank = F.struct((-_points(F.col("text"))).alias("n"), F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    rows = docs.select(without_white_space(F.col("text")).alias("norm"), rank.alias("rank")).select(hashed(F.col("norm")).alias("h"), "norm", "rank")
    groups = rows.groupBy("h", "norm").agg(F.min("rank").alias("rank"), F.count(F.lit(1)).alias("group_size"))
    return durable(groups.select("h", F.sha2("norm", 256).alias("text_sha256"), (-F.col("rank.n")).alias("points"), F.col("rank.id").alias("keep_id"), "group_size"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hashed: Callable[[Column], Column] = content_hash) -> DataFrame:
    """For each row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they are identical without white space. Of equal texts the one with the most
    code points stays, then the smallest id. Members find their group by hash and SHA-256, with large groups salted.

    Null text counts as empty; all empty texts form one group. Very long texts are compared whole. A null id is kept
    only if its group has no other. Rows that repeat an id and a text are one document: each carries the same values.
    An empty table gives an empty result. Other columns are not read.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    norm = without_white_space(F.col("text"))
    members = docs.select("doc_id", norm.alias("norm")).select("doc_id", hashed(F.col("norm")).alias("h"), F.sha2("norm", 256).alias("text_sha256"))
    found = salted_lookup(members, _groups(docs, hashed), ["h", "text_sha256"], "group_size", docs.count(), ["doc_id"])
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of `docs` for each different text, with all its columns: the one that `exact_groups` keeps.

    A row stays if id, text and length are those of its group's best; of rows that repeat all three, one stays.
    Repeated rows are combined before the shuffle. Columns may have any names.
    """
    key = lambda sha, points, id_: F.concat_ws(":", sha, points, F.coalesce(id_.cast("string"), F.lit("-")))
    groups = _groups(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), content_hash)
    best = groups.select(key(F.col("text_sha256"), F.col("points"), F.col("keep_id")).alias("key"))
    text = F.col("row")[text_col]
    rows = docs.select(F.struct("*").alias("row")).select("row", key(F.sha2(without_white_space(text), 256), _points(text), F.col("row")[id_col]).alias("key"))
    return rows.dropDuplicates(["key"]).join(best, "key", "left_semi").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents
), r AS (
  SELECT doc_id, norm,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(text) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
"""

QUERIES = {"op9_exact_dedup": query}
ORACLES = {"op9_exact_dedup": ORACLE}
