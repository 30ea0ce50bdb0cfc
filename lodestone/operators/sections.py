"""Fenced sections of rendered documents: fencing, extraction and merging with what people own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def body_hash(body: Column) -> Column:
    return F.substring(F.sha2(body, 256), 1, 8)


def fenced(name: Column, body: Column) -> Column:
    """A section with its name and the hash of its body."""
    return F.concat(F.lit("<!-- begin section="), name, F.lit(" hash="), body_hash(body), F.lit(" -->\n"), body, F.lit("\n<!-- end section -->"))


def section_body(document: Column, name: str) -> Column:
    """The body of a fenced section; empty if there is none."""
    return F.regexp_extract(document, rf"(?s)<!-- begin section={name} hash=[0-9a-f]+ -->\n(.*?)\n<!-- end section -->", 1)


def merged_sections(new: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """keys, body and kept: existing sections stay where a person has edited them, that is, where their body
    no longer has the hash that was stored with it."""
    old = existing.select(*keys, F.col("body").alias("_old"), F.col("hash").alias("_hash"))
    own = F.col("_old").isNotNull() & (body_hash(F.col("_old")) != F.col("_hash"))
    return new.join(old, keys, "left").select(*keys, F.when(own, F.col("_old")).otherwise(F.col("body")).alias("body"), F.coalesce(own, F.lit(False)).alias("kept"))
