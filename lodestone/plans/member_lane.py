"""Queries on members of units: references and their outcomes, what names mean, orders, levels, tiers and enrichment.

Documents, symbols and records are made from rows of the given tables; the SQL states the results from these rows.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.operators import enrichment, graph, member_refs, rules, symbols
from lodestone.plans.table_lane import read_table
from lodestone.tables import shared_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


# ---- references in nested documents --------------------------------------------------------------------------


def _member_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three documents of each customer, of which some lack one: what they declare and cite follows from the order keys."""
    orders = read_table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("unit"), F.col("o_orderkey").alias("o"), F.col("o_orderkey").cast("string").alias("k"))
    each = orders.groupBy("unit").agg(F.array_sort(F.collect_list(F.struct("o", "k"))).alias("os"))
    having = lambda n, f: F.transform(F.filter("os", lambda x: x["o"] % n == 0), f)
    name = lambda prefix: lambda x: F.concat(F.lit(prefix), x["k"])
    methods = F.transform(F.filter("os", lambda x: x["o"] % 5 != 0), name("method:"))
    fields = having(7, lambda x: F.struct(name("field:f")(x).alias("id"), name("f")(x).alias("name")))
    signature = F.struct(F.struct(methods.alias("methodIds"), fields.alias("fields")).alias("stateOutline"))
    calls = F.map_from_entries(F.transform("os", lambda x: F.struct(name("method:")(x), F.array(name("http:")(x), name("test:")(x)))))
    requests = having(2, lambda x: F.struct(name("http:")(x).alias("id")))
    notes = F.transform("os", lambda x: F.struct(name("adds ")(x).alias("coveredByExistingTest"), name("field:f")(x).alias("usedBy"), F.lit("field:none").alias("other")))
    dependencies = F.struct(F.struct(calls.alias("calls")).alias("callGraph"), requests.alias("httpInteractions"), notes.alias("notes"))
    functions = F.struct(F.struct(having(3, lambda x: F.struct(name("test:")(x).alias("id"), F.lit("t").alias("title"))).alias("cases")).alias("tests"))
    tiers = F.array(
        F.struct(F.lit("signature").alias("tier"), F.to_json(signature).alias("text")),
        F.when(F.col("unit") % 3 != 0, F.struct(F.lit("dependencies").alias("tier"), F.to_json(dependencies).alias("text"))),
        F.when(F.col("unit") % 4 != 0, F.struct(F.lit("functions").alias("tier"), F.to_json(functions).alias("text"))),
    )
    return each.select("unit", F.explode(tiers).alias("t")).filter("t IS NOT NULL").select("unit", "t.*")


_CITED = """o AS (SELECT o_custkey AS unit, o_orderkey AS o, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS i FROM orders),
cited AS (
  SELECT unit, 'method:' || o AS ref, 'dependencies/callGraph/calls/method:' || o AS place, 'signature' AS owner, CASE WHEN o % 5 <> 0 THEN 'known' ELSE 'dangling' END AS outcome FROM o WHERE unit % 3 <> 0
  UNION ALL SELECT unit, 'http:' || o, 'dependencies/callGraph/calls/method:' || o, 'dependencies', CASE WHEN o % 2 = 0 THEN 'known' ELSE 'dangling' END FROM o WHERE unit % 3 <> 0
  UNION ALL SELECT unit, 'test:' || o, 'dependencies/callGraph/calls/method:' || o, 'functions', CASE WHEN unit % 4 = 0 THEN 'unowned' WHEN o % 3 = 0 THEN 'known' ELSE 'dangling' END FROM o WHERE unit % 3 <> 0
  UNION ALL SELECT unit, 'adds ' || o, 'dependencies/notes[' || i || ']/coveredByExistingTest', NULL, 'unlinked' FROM o WHERE unit % 3 <> 0
  UNION ALL SELECT unit, 'field:f' || o, 'dependencies/notes[' || i || ']/usedBy', 'signature', CASE WHEN o % 7 = 0 THEN 'known' ELSE 'dangling' END FROM o WHERE unit % 3 <> 0)"""


def _outcomes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    documents = _member_documents(spark, sf_dir)
    found = member_refs.properties(documents)
    declared = member_refs.declared_ids(found)
    return member_refs.outcomes(member_refs.references(found), declared, documents), declared, documents


@_query(f"""WITH {_CITED} SELECT unit, outcome, owner, count(*) AS refs, count(DISTINCT ref) AS ids, arg_min(ref, (place, ref)) AS example, min(place) AS cited_at FROM cited GROUP BY ALL""")
def member_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J09, A16, JSN03: what becomes of the references in nested documents, with counts and an example of each outcome."""
    return member_refs.outcome_report(_outcomes(spark, sf_dir)[0])


@_query(f"""WITH {_CITED}, declared AS (SELECT unit, sum((o % 5 <> 0)::INT + 2 * (o % 7 = 0)::INT + (o % 2 = 0 AND unit % 3 <> 0)::INT + (o % 3 = 0 AND unit % 4 <> 0)::INT) AS declared FROM o GROUP BY 1),
counts AS (SELECT unit, count(*) AS refs, count(*) FILTER (outcome = 'dangling') AS dangling, count(*) FILTER (outcome = 'unowned') AS unowned, count(*) FILTER (outcome = 'unlinked') AS unlinked FROM cited GROUP BY 1)
SELECT unit, declared::BIGINT AS declared, coalesce(refs, 0) AS refs, coalesce(dangling, 0) AS dangling, coalesce(unowned, 0) AS unowned, coalesce(unlinked, 0) AS unlinked,
CASE WHEN coalesce(dangling, 0) = 0 THEN 'ok' WHEN unit % 10 = 0 THEN 'legacy' ELSE 'failed' END AS verdict FROM declared LEFT JOIN counts USING (unit)""")
def unit_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether each unit's references hold, those of older versions reported alone."""
    found, declared, documents = _outcomes(spark, sf_dir)
    return member_refs.unit_verdicts(found, declared, documents, documents.filter("unit % 10 = 0"))


# ---- what names mean -----------------------------------------------------------------------------------------

_PLACES = """SELECT user_id AS unit, event_id AS place, 'method:m' || event_id % 7 AS site, 'x' || event_id % 6 AS name,
CASE event_type WHEN 'click' THEN 'call' WHEN 'view' THEN 'call' WHEN 'purchase' THEN 'assign' ELSE 'plain' END AS form,
CASE event_type WHEN 'view' THEN CASE WHEN event_id % 4 < 2 THEN 'set' ELSE 'load' END END AS member FROM events"""
_MEANT = f"""SELECT *, CASE name
  WHEN 'x0' THEN CASE WHEN form = 'call' AND member IS NULL THEN 'calls method:x0' END
  WHEN 'x1' THEN CASE WHEN form = 'call' AND member IS NULL THEN 'calls accessor:x1' END
  WHEN 'x2' THEN CASE WHEN form = 'assign' THEN 'writes field:x2' WHEN form = 'plain' THEN 'reads field:x2' WHEN member = 'set' THEN CASE WHEN unit % 2 = 0 THEN 'writes field:x2' ELSE 'reads field:x2' END WHEN member = 'load' THEN 'reads field:x2' END
  WHEN 'x3' THEN CASE WHEN member IS NOT NULL THEN 'uses dep:x3' END
  WHEN 'x4' THEN CASE WHEN member IS NOT NULL THEN 'uses dep:x4' WHEN form = 'assign' THEN 'writes field:x4' WHEN form = 'plain' THEN 'reads field:x4' END END AS meant FROM ({_PLACES})"""


def _resolved_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = read_table(spark, sf_dir, "events")
    form = F.when(F.col("event_type").isin("click", "view"), "call").when(F.col("event_type") == "purchase", "assign").otherwise("plain")
    member = F.when(F.col("event_type") == "view", F.when(F.col("event_id") % 4 < 2, "set").otherwise("load"))
    text = lambda prefix, n: F.concat(F.lit(prefix), (F.col("event_id") % n).cast("string"))
    places = events.select(F.col("user_id").alias("unit"), F.col("event_id").alias("place"), text("method:m", 7).alias("site"), text("x", 6).alias("name"), form.alias("form"), member.alias("member"))
    kinds = [("x0", "accessor"), ("x0", "method"), ("x1", "accessor"), ("x3", "dependency"), ("x4", "field"), ("x4", "dependency")]
    own = [F.struct(F.lit(n).alias("name"), F.lit(k).alias("kind")) for n, k in kinds] + [F.struct(F.lit("x2").alias("name"), F.when(F.col("unit") % 2 == 0, "signal").otherwise("field").alias("kind"))]
    table = events.select(F.col("user_id").alias("unit")).distinct().select("unit", F.inline(F.array(*own)))
    return symbols.resolved(places, table)


@_query(f"""SELECT unit, string_split(meant, ' ')[1] AS relation, site, string_split(meant, ' ')[2] AS target, count(*) AS n, min(place) AS first FROM ({_MEANT}) WHERE meant IS NOT NULL GROUP BY ALL""")
def symbol_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each place calls, uses, reads or writes, where names have several kinds."""
    return symbols.relations(_resolved_places(spark, sf_dir))


@_query(f"""SELECT unit, string_split(meant, ' ')[2] AS dependency, member, string_agg(site, ' ' ORDER BY place) AS sites FROM
(SELECT unit, meant, member, site, min(place) AS place FROM ({_MEANT}) WHERE meant LIKE 'uses %' GROUP BY ALL) GROUP BY ALL""")
def dependency_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The members of each dependency that are called, with their callers in order."""
    return symbols.dependency_members(_resolved_places(spark, sf_dir)).withColumn("sites", F.array_join("sites", " "))


# ---- orders and levels ---------------------------------------------------------------------------------------

_HEAP = """o AS (SELECT o_custkey AS unit, o_orderkey AS o, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders)"""


@_query(f"""WITH RECURSIVE {_HEAP}, path AS (SELECT unit, o, k, n, k AS place, '' AS way FROM o UNION ALL SELECT unit, o, k, n, place // 2, (place % 2)::VARCHAR || way FROM path WHERE place > 1)
SELECT unit, 'order:' || o AS node, row_number() OVER (PARTITION BY unit ORDER BY way || '2') - 1 AS position, CASE WHEN unit % 3 = 0 AND 2 * k > n AND n > 1 THEN 'order:' || min(o) OVER (PARTITION BY unit) ELSE '' END AS cuts FROM path WHERE place = 1""")
def post_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf-first order of each unit's members, with the edges that close a cycle and are cut."""
    orders = read_table(spark, sf_dir, "orders")
    each = orders.groupBy(F.col("o_custkey").alias("unit")).agg(F.array_sort(F.collect_list("o_orderkey")).alias("os")).withColumn("n", F.size("os"))
    ranked = each.select("unit", "n", "os", F.posexplode("os").alias("k", "o")).withColumn("k", F.col("k") + 1)
    name = lambda c: F.concat(F.lit("order:"), c.cast("string"))
    at = lambda k: F.get("os", (k - 1).cast("int"))
    back = (F.col("unit") % 3 == 0) & (2 * F.col("k") > F.col("n")) & (F.col("n") > 1)
    links = [ranked.filter(2 * F.col("k") + j <= F.col("n")).select("unit", name(F.col("o")).alias("from"), name(at(2 * F.col("k") + j)).alias("to")) for j in (0, 1)]
    links.append(ranked.filter(back).select("unit", name(F.col("o")).alias("from"), name(at(F.lit(1))).alias("to")))
    nodes = ranked.select("unit", name(F.col("o")).alias("node"), F.col("k").alias("ord"))
    return graph.leaf_first_order(nodes, reduce(DataFrame.unionByName, links)).withColumn("cuts", F.array_join("cuts", " "))


@_query("""WITH RECURSIVE n AS (SELECT o_orderkey AS node FROM orders),
c AS (SELECT node FROM n WHERE node % 5000 >= 4003 AND node // 5000 IN (SELECT node // 5000 FROM n WHERE node % 5000 = 4005)),
e AS (SELECT a.node AS f, b.node AS t FROM n a JOIN n b ON b.node = a.node - 1 WHERE a.node % 1000 <> 0 AND a.node NOT IN (FROM c)
  UNION ALL SELECT a.node, b.node FROM n a JOIN n b ON b.node = a.node - 7 WHERE a.node % 100 = 0 AND a.node % 1000 <> 0 AND a.node NOT IN (FROM c)),
p AS (SELECT node, 0 AS level FROM n WHERE node NOT IN (SELECT f FROM e) AND node NOT IN (FROM c) UNION SELECT e.f, p.level + 1 FROM p JOIN e ON e.t = p.node)
SELECT n.node, max(p.level)::BIGINT AS level FROM n LEFT JOIN p USING (node) GROUP BY n.node""")
def chain_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels along chains of a thousand orders with side steps, and a cycle in one of five, on which all above it wait."""
    nodes = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("node"))
    to = lambda shift, where: nodes.filter(where).select(F.col("node").alias("from"), (F.col("node") + shift).alias("to"))
    links = [to(-1, "node % 1000 <> 0"), to(-7, "node % 100 = 0 AND node % 1000 <> 0"), to(2, "node % 5000 = 4003")]
    return graph.topo_levels(nodes, reduce(DataFrame.unionByName, links))


# ---- tiers and enrichment ------------------------------------------------------------------------------------

_MEASURES = """SELECT c_custkey AS unit, coalesce(sum(length(o_orderpriority) * 2), 0) AS lines, count(o_orderkey) AS methods, count(*) FILTER (o_orderpriority = '1-URGENT') AS forms,
count(*) FILTER (o_orderkey % 11 = 0) AS streams, count(*) FILTER (o_orderstatus = 'P') AS requests, count(*) FILTER (o_orderkey % 13 = 0) AS called FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1"""


@_query(f"""SELECT unit, CASE WHEN lines > 200 THEN 0 WHEN methods > 10 THEN 1 WHEN forms + streams + requests + called = 0 AND methods <= 3 THEN 2 ELSE 3 END AS "rank",
CASE WHEN lines > 200 OR methods > 10 THEN 'complex' WHEN forms + streams + requests + called = 0 AND methods <= 3 THEN 'trivial' ELSE 'standard' END AS tier,
CASE WHEN lines > 800 OR methods > 40 THEN 'oversized' ELSE 'regular' END AS size FROM ({_MEASURES})""")
def unit_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tier and size of each unit by rules that are a table, over counts of its parts."""
    orders = read_table(spark, sf_dir, "orders")
    of = lambda name, value, where="true": orders.filter(where).select(F.col("o_custkey").alias("unit"), F.lit(name).alias("measure"), F.expr(value).cast("bigint").alias("value"))
    counted = [of("lines", "length(o_orderpriority) * 2"), of("methods", "1"), of("forms", "1", "o_orderpriority = '1-URGENT'"), of("streams", "1", "o_orderkey % 11 = 0"), of("requests", "1", "o_orderstatus = 'P'"), of("called_members", "1", "o_orderkey % 13 = 0"), of("other", "7")]
    units, measures = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("unit")), reduce(DataFrame.unionByName, counted)
    sizes = rules.classified(units, measures, rules.rule_table(spark, rules.OVERSIZED)).select("unit", F.col("result").alias("size"))
    return rules.classified(units, measures, rules.rule_table(spark, rules.TIERS)).withColumnRenamed("result", "tier").join(sizes, "unit")


_FILLED = """c AS (SELECT c_custkey AS k, c_custkey % 3 = 0 AS service, max(c_custkey) OVER () AS most FROM customer),
d AS (SELECT k, k + 1 AS t1, k * 2 AS t2, most, k + 1 <= most AS has1, k * 2 <= most AS has2 FROM c)"""


@_query(f"""WITH {_FILLED} SELECT k AS unit, CASE WHEN k % 5 = 0 THEN 'kept' WHEN has1 THEN 'u' || t1 ELSE '-' END || ' ' || CASE WHEN has2 THEN 'u' || t2 ELSE '-' END AS resolved,
CASE WHEN k % 2 = 1 THEN 'own' WHEN k % 3 <> 2 AND has1 THEN 'u' || t1 ELSE '' END AS outbound,
CASE WHEN k >= 1 AND (k - 1) % 3 <> 2 THEN 'u' || (k - 1) ELSE '' END AS inbound,
CASE WHEN k % 4 = 1 THEN 'http:1 own' ELSE
  CASE WHEN k % 5 <> 0 AND has1 AND t1 % 3 = 0 THEN 'http:1 d1 /' || t1 || '/1,http:2 d1 /' || t1 || '/2' || CASE WHEN has2 AND t2 % 3 = 0 THEN ',http:3 d2 /' || t2 || '/1,http:4 d2 /' || t2 || '/2' ELSE '' END
  WHEN has2 AND t2 % 3 = 0 THEN 'http:1 d2 /' || t2 || '/1,http:2 d2 /' || t2 || '/2' ELSE '' END END AS requests, 1::BIGINT AS version FROM d""")
def enriched_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK03: units' records with ids, edges and requests filled from an index, as the published version after two runs."""
    k = F.col("c_custkey")
    rows = read_table(spark, sf_dir, "customer").select(k, F.concat(F.lit("u"), k.cast("string")).alias("unit"))
    dep = lambda name, token, resolved: F.struct(F.lit(name).alias("id"), F.concat(F.lit("C"), token.cast("string")).alias("token"), resolved.cast("string").alias("resolved"))
    none = F.expr("cast(array() as array<string>)")
    request = F.struct(F.lit("http:1").alias("id"), F.lit("PUT").alias("method"), F.lit("own").alias("url"), F.lit(None).cast("string").alias("via"), F.lit(None).cast("string").alias("service"), F.lit(True).alias("direct"))
    records = rows.select(
        "unit",
        F.array(dep("d1", k + 1, F.when(k % 5 == 0, "kept")), dep("d2", k * 2, F.lit(None))).alias("dependencies"),
        F.when(k % 2 == 1, F.array(F.lit("own"))).otherwise(none).alias("outbound"),
        F.when(k % 7 == 0, none).alias("inbound"),
        F.when(k % 4 == 1, F.array(request)).alias("requests"),
    )
    index = rows.select("unit", F.when(k % 3 == 0, "service").otherwise("component").alias("kind"), F.concat(F.lit("C"), k.cast("string")).alias("class_name"))
    edges = rows.filter(k % 3 != 2).select(F.col("unit").alias("from"), F.concat(F.lit("u"), (k + 1).cast("string")).alias("to")).join(rows.select(F.col("unit").alias("to")), "to", "left_semi")
    made = rows.filter(k % 3 == 0).select(F.col("unit").alias("service"), F.explode(F.array(F.lit(1), F.lit(2))).alias("ord"), k)
    requests = made.select("service", "ord", F.lit("GET").alias("method"), F.concat_ws("/", F.lit(""), k.cast("string"), F.col("ord").cast("string")).alias("url"))
    folder = f"{shared_folder(spark)}/records-{uuid.uuid4().hex}"
    enrichment.publish(records, folder)
    for _ in range(2):
        enrichment.enrich_table(spark, folder, index, edges, requests)
    number, _ = enrichment.published(spark, folder)
    said = F.transform("requests", lambda r: F.concat_ws(" ", r["id"], r["via"], r["url"]))
    return enrichment.snapshot(spark, folder).select(
        F.substring("unit", 2, 20).cast("bigint").alias("unit"),
        F.array_join(F.transform("dependencies", lambda d: F.coalesce(d["resolved"], F.lit("-"))), " ").alias("resolved"),
        F.coalesce(F.array_join("outbound", " "), F.lit("")).alias("outbound"),
        F.coalesce(F.array_join("inbound", " "), F.lit("")).alias("inbound"),
        F.coalesce(F.array_join(said, ","), F.lit("")).alias("requests"),
        F.lit(number).cast("bigint").alias("version"),
    )
