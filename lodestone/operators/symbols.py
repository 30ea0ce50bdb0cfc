"""What `this.x` means at each place: symbols of several kinds with one name, resolved by how they are accessed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the analysed framework: calls that write a signal.
SIGNAL_WRITERS = ("mutate", "set", "update")
#: access, kind and relation, best first: what an access of this kind means if a symbol of that kind has the name.
#: An access is call (`this.x()`), write_call and other_call (`this.x.set()`, `this.x.other()`), assign (`this.x = v`) or
#: plain (any other `this.x`).
RULES = (
    ("call", "method", "calls"),
    ("call", "accessor", "calls"),
    ("write_call", "signal", "writes"),
    ("write_call", "dependency", "uses"),
    ("write_call", "field", "reads"),
    ("other_call", "dependency", "uses"),
    ("other_call", "signal", "reads"),
    ("other_call", "field", "reads"),
    ("assign", "signal", "writes"),
    ("assign", "field", "writes"),
    ("plain", "signal", "reads"),
    ("plain", "field", "reads"),
)
#: What a symbol's id begins with; a signal is a field.
PREFIXES = {"method": "method:", "accessor": "accessor:", "signal": "field:", "field": "field:", "dependency": "dep:"}


def access_of(form: str = "form", member: str = "member") -> Column:
    """The access of a place from its form (call, assign or plain) and the member that is called on the symbol, if any."""
    called = F.when(F.col(member).isin(*SIGNAL_WRITERS), "write_call").otherwise("other_call")
    return F.when((F.col(form) == "call") & F.col(member).isNotNull(), called).otherwise(F.col(form))


def resolved(places: DataFrame, symbols: DataFrame, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """The places (unit, place, site, name, form, member, and more) with access, kind, target and relation.

    Candidates are the symbols (unit, name, kind) of the same unit and name whose kind has a rule for the access; the best
    rule counts. It is found by a least rank for each distinct access of a name, in which tasks first combine their own,
    so neither a name that is used at very many places nor one that has many kinds is one task's work. Places that nothing
    fits keep nulls. A name that is both a method and an accessor is the method.
    """
    ranked = places.sparkSession.createDataFrame([(a, k, r, n) for n, (a, k, r) in enumerate(rules)], "access string, kind string, relation string, rank int")
    marked = places.withColumn("access", access_of())
    asked = marked.select("unit", "name", "access").distinct()
    candidates = asked.join(symbols.select("unit", "name", "kind"), ["unit", "name"]).join(F.broadcast(ranked), ["access", "kind"])
    best = candidates.groupBy("unit", "name", "access").agg(F.min(F.struct("rank", "kind", "relation")).alias("best"))
    prefix = F.element_at(F.create_map(*[F.lit(x) for pair in PREFIXES.items() for x in pair]), F.col("best.kind"))
    found = best.select("unit", "name", "access", F.col("best.kind").alias("kind"), F.concat(prefix, "name").alias("target"), F.col("best.relation").alias("relation"))
    return marked.join(found, ["unit", "name", "access"], "left")


def relations(found: DataFrame) -> DataFrame:
    """unit, relation, site, target, n and first of every relation among resolved places, with its places counted."""
    known = found.filter("relation IS NOT NULL")
    return known.groupBy("unit", "relation", "site", "target").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))


def dependency_members(found: DataFrame) -> DataFrame:
    """unit, dependency, member and the sites that call it, each once in the order of its first call."""
    used = found.filter("relation = 'uses'").groupBy("unit", "target", "member", "site").agg(F.min("place").alias("place"))
    sites = F.transform(F.array_sort(F.collect_list(F.struct("place", "site"))), lambda s: s["site"])
    return used.groupBy("unit", F.col("target").alias("dependency"), "member").agg(sites.alias("sites"))
