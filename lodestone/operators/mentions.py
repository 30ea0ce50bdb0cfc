"""Which texts mention which items, by phrases and parts of words, without comparing every pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.tables import written

#: Characters of a word by which it finds the tokens that may contain it.
GRAM = 4
#: Hundredths of an item's long words that a text must contain.
SHARE = 70


def _grams(token: Column) -> Column:
    """The distinct substrings of 1 to GRAM characters; of an empty token the empty one."""
    n = F.length(token)
    cut = lambda k: F.transform(F.sequence(F.lit(1), n - (k - 1)), lambda i: F.substring(token, i, F.lit(k)))
    none = F.array(F.lit(""))
    return F.array_distinct(F.concat(none, *[F.when(n >= k, cut(k)).otherwise(F.array().cast("array<string>")) for k in range(1, GRAM + 1)]))


def mentions(items: DataFrame, texts: DataFrame) -> DataFrame:
    """item_id and doc_id of every mention by `text.mentioned_in`; `items` has item_id and needle, `texts` doc_id and hay, normalised.

    A text with SHARE of an item's long words contains at least one of its rarest ones, so many that the others are
    too few. A word stands inside one token of the text, so words find tokens by their first GRAM characters over the
    vocabulary, and texts by these tokens. Only texts that are found so are compared with the item as a whole. Items
    without long words are found by their first word; an empty one is mentioned everywhere.
    """
    long = T.significant_words(F.col("needle"))
    keys = items.select("item_id", F.when(F.size(long) > 0, long).otherwise(F.slice(F.split("needle", " "), 1, 1)).alias("words"))
    most = F.size("words") - F.ceil(F.size("words") * SHARE / 100)
    words = keys.select("item_id", most.alias("spare"), F.explode("words").alias("word")).groupBy("item_id", "word").agg(F.first("spare").alias("spare"), F.count(F.lit(1)).alias("times"))
    tokens = written(texts.select("doc_id", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), F.split("hay", " ")))).alias("token")))
    vocabulary = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("texts"))
    grams = vocabulary.select("token", "texts", F.explode(_grams(F.col("token"))).alias("gram"))
    named = words.select("word", F.substring("word", 1, GRAM).alias("gram")).distinct()
    inside = written(grams.join(named, "gram").filter(F.contains("token", "word")).select("word", "token", "texts"))
    weights = inside.groupBy("word").agg(F.sum("texts").alias("weight"))
    order = Window.partitionBy("item_id").orderBy(F.coalesce("weight", F.lit(0)), "word").rowsBetween(Window.unboundedPreceding, -1)
    rare = words.join(weights, "word", "left").withColumn("before", F.coalesce(F.sum("times").over(order), F.lit(0))).filter("before <= spare").select("item_id", "word")
    pairs = rare.join(inside.select("word", "token"), "word").select("item_id", "token").distinct().join(tokens, "token").select("item_id", "doc_id").distinct()
    return pairs.join(items, "item_id").join(texts, "doc_id").filter(T.mentioned_in(F.col("needle"), F.col("hay"))).select("item_id", "doc_id")
