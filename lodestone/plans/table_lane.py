"""Queries over the given tables, each with the SQL that must give the same rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.functions.json_paths import flattened, harvested, searched
from lodestone.operators import audit, diff, edges, graph, incremental, lookup, sections
from lodestone.operators.integrity import dangling_report, keyed
from lodestone.operators.mentions import mentions
from lodestone.session import share_package

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str):
    """Registers a query under its function's name, with the SQL that must agree."""

    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    share_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows of which much more is made, dealt out evenly: a table of few bytes is one task's otherwise."""
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


_read = read_table

#: (relation, table, column, owner, key, shift): a shift makes references that dangle.
RELATIONS = (
    ("lineitem.order", "lineitem", "l_orderkey", "orders", "o_orderkey", 0),
    ("lineitem.part", "lineitem", "l_partkey", "part", "p_partkey", 0),
    ("lineitem.supplier", "lineitem", "l_suppkey", "supplier", "s_suppkey", 0),
    ("orders.customer", "orders", "o_custkey", "customer", "c_custkey", 0),
    ("customer.nation", "customer", "c_nationkey", "nation", "n_nationkey", 0),
    ("nation.region", "nation", "n_regionkey", "region", "r_regionkey", 0),
    ("labels.document", "labels", "doc_id", "documents", "doc_id", 0),
    ("labels.document+500", "labels", "doc_id", "documents", "doc_id", 500),
    ("orders.customer+100", "orders", "o_custkey", "customer", "c_custkey", 100),
)


@_query(
    "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS relation, count(*) AS refs, count(DISTINCT r.ref) AS distinct_refs,
  count(*) FILTER (WHERE o.id IS NULL) AS dangling, count(DISTINCT r.ref) FILTER (WHERE o.id IS NULL) AS distinct_dangling
FROM (SELECT {c} + {shift} AS ref FROM {t}) r LEFT JOIN (SELECT DISTINCT {k} AS id FROM {o}) o ON r.ref = o.id"""
        for name, t, c, o, k, shift in RELATIONS
    )
)
def integrity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References and how many of them dangle, for each relation."""
    read = lambda t: _read(spark, sf_dir, t)
    refs = [keyed(read(t), {r[0]: F.col(r[2]) + r[5] for r in RELATIONS if r[1] == t}, "ref") for t in dict.fromkeys(r[1] for r in RELATIONS)]
    ids = [keyed(read(t), {r[0]: F.col(r[4]) for r in RELATIONS if r[3] == t}, "id") for t in dict.fromkeys(r[3] for r in RELATIONS)]
    return dangling_report([r[0] for r in RELATIONS], reduce(DataFrame.unionByName, refs), reduce(DataFrame.unionByName, ids))


# ---- edges -------------------------------------------------------------------------------------------------

_STEPS = "e AS (SELECT event_id, ts, user_id, event_type AS f, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS t FROM events)"


def _event_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.consecutive_edges(_read(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type", ["ts", "event_id"])


@_query(f'WITH {_STEPS} SELECT f AS "from", t AS "to", count(*) AS calls, arg_min(event_id, (ts, event_id)) AS first_event_id FROM e WHERE t IS NOT NULL GROUP BY f, t')
def edge_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transitions between event types, with counts and the first occurrence."""
    return edges.edge_dedupe(_event_edges(spark, sf_dir), ["ts", "event_id"], ["event_id"])


@_query("""WITH o AS (SELECT user_id, event_type, min((ts, event_id)) AS pos FROM events GROUP BY 1, 2)
SELECT user_id, string_agg(event_type, ',' ORDER BY pos) AS targets FROM o GROUP BY user_id""")
def ordered_adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event types of each user, distinct, by first occurrence."""
    events = _read(spark, sf_dir, "events").withColumn("at", F.struct("ts", "event_id"))
    return edges.adjacency(events, "user_id", "event_type", "at").select("user_id", edges.listed(F.col("targets")).alias("targets"))


@_query("SELECT o_custkey AS custkey, string_agg(DISTINCT o_orderkey::VARCHAR, ',' ORDER BY o_orderkey::VARCHAR) AS orders, count(DISTINCT o_orderkey) AS n FROM orders GROUP BY 1")
def reverse_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of each customer, the other way round."""
    orders = _read(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderkey").cast("string").alias("key"))
    found = edges.adjacency(orders, "o_custkey", "key")
    return found.select(F.col("o_custkey").alias("custkey"), edges.listed(F.col("targets")).alias("orders"), F.size("targets").cast("bigint").alias("n"))


@_query("""WITH u AS (SELECT l_suppkey AS d, l_partkey AS m, count(DISTINCT l_orderkey) AS places FROM lineitem GROUP BY 1, 2),
l AS (SELECT d, count(m) AS members, sum(places)::BIGINT AS places FROM u GROUP BY d)
SELECT s_suppkey AS dependency, coalesce(members, 0) AS members, coalesce(places, 0)::BIGINT AS places FROM supplier LEFT JOIN l ON d = s_suppkey""")
def dependency_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is used of each supplier, unused suppliers included."""
    uses = _read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("dependency"), F.col("l_partkey").alias("member"), F.col("l_orderkey").alias("place"))
    return edges.dependency_usage(uses, _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("dependency")))


@_query("""WITH e AS (SELECT 'out' AS direction, n_regionkey AS node, c_custkey AS other FROM customer JOIN nation ON c_nationkey = n_nationkey UNION ALL SELECT 'in', c_nationkey, c_custkey FROM customer)
SELECT *, count(*) OVER (PARTITION BY direction, node) AS degree FROM e""")
def mirrored_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges by either end, a row for each, with the degree of that end; no end's edges are gathered."""
    customers = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("other"), F.col("c_nationkey").alias("node"))
    regions = _read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("node"), "n_regionkey")
    both = customers.join(regions, "node").select(F.lit("out").alias("direction"), F.col("n_regionkey").alias("node"), "other").unionByName(customers.select(F.lit("in").alias("direction"), "node", "other"))
    return both.join(both.groupBy("direction", "node").agg(F.count(F.lit(1)).alias("degree")), ["direction", "node"])


# ---- graphs ------------------------------------------------------------------------------------------------


def _hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region, nation and customer nodes; an edge down each key, and one from nation to region, which makes cycles."""
    nation, customer = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "customer")
    name = lambda kind, c: F.concat(F.lit(f"{kind}:"), F.col(c).cast("string"))
    down = nation.select(name("region", "n_regionkey").alias("from"), name("nation", "n_nationkey").alias("to"))
    up = nation.select(name("nation", "n_nationkey").alias("from"), name("region", "n_regionkey").alias("to"))
    return down.unionByName(up).unionByName(customer.select(name("nation", "c_nationkey").alias("from"), name("customer", "c_custkey").alias("to")))


@_query("""WITH RECURSIVE g AS (
  SELECT 'region:' || n_regionkey AS f, 'nation:' || n_nationkey AS t FROM nation UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey FROM nation
  UNION ALL SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey FROM customer
), r AS (SELECT 'nation:' || n_nationkey AS node, 0 AS depth FROM nation WHERE n_nationkey % 7 = 0
  UNION SELECT g.t, r.depth + 1 FROM r JOIN g ON g.f = r.node WHERE r.depth < 6)
SELECT node, min(depth)::BIGINT AS depth FROM r GROUP BY node""")
def reach_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fewest steps from the entry points, in a graph with cycles."""
    entries = _read(spark, sf_dir, "nation").filter("n_nationkey % 7 = 0").select(F.concat(F.lit("nation:"), F.col("n_nationkey").cast("string")).alias("node"))
    return graph.reach(_hierarchy(spark, sf_dir), entries)


@_query("""SELECT p_partkey AS node FROM part WHERE p_partkey NOT IN (
  SELECT l_partkey FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING' AND c_nationkey < 3)""")
def unreachable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that no order of the entry customers reaches."""
    key = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
    orders, items = _read(spark, sf_dir, "orders"), _read(spark, sf_dir, "lineitem")
    links = orders.select(key("c", "o_custkey").alias("from"), key("o", "o_orderkey").alias("to")).unionByName(items.select(key("o", "l_orderkey").alias("from"), key("p", "l_partkey").alias("to")))
    entries = _read(spark, sf_dir, "customer").filter("c_mktsegment = 'BUILDING' AND c_nationkey < 3").select(key("c", "c_custkey").alias("node"))
    parts = _read(spark, sf_dir, "part").select(key("p", "p_partkey").alias("node"))
    return graph.unreachable(parts, links, entries).select(F.substring("node", 2, 20).cast("bigint").alias("node"))


@_query("SELECT c_custkey AS node FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')")
def leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers without urgent orders."""
    links = _read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("from"), F.col("o_orderkey").alias("to"))
    return graph.leaves(_read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("node")), links)


@_query("""SELECT 'region:' || r_regionkey AS node, 0::BIGINT AS level FROM region UNION ALL SELECT 'nation:' || n_nationkey, 1 FROM nation
UNION ALL SELECT 'customer:' || c_custkey, 2 FROM customer UNION ALL SELECT 'order:' || o_orderkey, 3 FROM orders""")
def topo_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch in which each node can be processed, all it depends on being done."""
    name = lambda kind, c: F.concat(F.lit(f"{kind}:"), F.col(c).cast("string"))
    read = lambda t: _read(spark, sf_dir, t)
    nodes = [read("region").select(name("region", "r_regionkey").alias("node")), read("nation").select(name("nation", "n_nationkey").alias("node")), read("customer").select(name("customer", "c_custkey").alias("node")), read("orders").select(name("order", "o_orderkey").alias("node"))]
    links = [
        read("nation").select(name("nation", "n_nationkey").alias("from"), name("region", "n_regionkey").alias("to")),
        read("customer").select(name("customer", "c_custkey").alias("from"), name("nation", "c_nationkey").alias("to")),
        read("orders").select(name("order", "o_orderkey").alias("from"), name("customer", "o_custkey").alias("to")),
    ]
    return graph.topo_levels(reduce(DataFrame.unionByName, nodes), reduce(DataFrame.unionByName, links))


@_query(f"""WITH RECURSIVE {_STEPS}, g AS (SELECT DISTINCT f, t FROM e WHERE t IS NOT NULL AND f <> t
  UNION ALL SELECT 'start', 'click' UNION ALL SELECT 'stop', 'end'),
r AS (SELECT f, t FROM g UNION SELECT r.f, g.t FROM r JOIN g ON r.t = g.f)
SELECT DISTINCT r.f AS node FROM r WHERE r.t IN (SELECT f FROM r WHERE f = t)""")
def order_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event types that no leaf-first order contains, because of cycles; `start` depends on one, `stop` does not."""
    extra = spark.createDataFrame([("start", "click"), ("stop", "end")], "from string, to string")
    links = _event_edges(spark, sf_dir).select("from", "to").distinct().unionByName(extra)
    nodes = links.select(F.col("from").alias("node")).unionByName(links.select(F.col("to").alias("node")))
    return graph.cyclic_remainder(nodes, links)


# ---- warnings, counts and coverage ---------------------------------------------------------------------------


def _event_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    severity = F.when(F.col("event_type") == "error", "error").when(F.col("event_type") == "purchase", "warning").otherwise("info")
    return _read(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.col("event_type").alias("code"), F.concat(F.lit("k"), F.floor(F.col("value") / 10).cast("string")).alias("message"), severity.alias("severity"))


@_query("""SELECT user_id, event_type AS code, 'k' || floor(value / 10)::BIGINT AS message, min(event_id) AS first, CASE WHEN count(*) >= 2 THEN count(*)::VARCHAR END AS count FROM events GROUP BY ALL""")
def warning_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated warnings as one, with a count from two on."""
    return audit.deduped_warnings(_event_warnings(spark, sf_dir), "user_id", ["event_id"], "event_id").withColumn("count", F.col("count").cast("string"))


@_query("""SELECT user_id, CASE max(CASE event_type WHEN 'error' THEN 3 WHEN 'purchase' THEN 2 ELSE 1 END) WHEN 3 THEN 'failed' WHEN 2 THEN 'partial' ELSE 'ok' END AS status FROM events GROUP BY 1""")
def severity_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's status by the worst severity."""
    warnings = _event_warnings(spark, sf_dir)
    return audit.parse_status(_read(spark, sf_dir, "events").select("user_id"), warnings, "user_id")


@_query("""SELECT event_type AS code, count(*) AS n, count(DISTINCT user_id) AS units FROM events WHERE event_type IN ('error', 'purchase') GROUP BY 1""")
def gap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings above info by code, with the number of units that have them."""
    found = _event_warnings(spark, sf_dir).filter("severity <> 'info'")
    return found.groupBy("code").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("user_id").alias("units"))


#: Constructs of a page and the patterns that find them in text.
CONSTRUCTS = {"anchors": r"<a\s", "blocks": r"<div[\s>]", "paragraphs": r"<p[\s>]", "items": r"<li[\s>]", "scripts": r"<script[\s>]", "classes": r"\sclass=", "links": r"\shref="}


@_query(" UNION ALL ".join(f"SELECT page_id, '{k}' AS construct, len(regexp_extract_all(html, '{p}'))::BIGINT AS occurrences FROM pages" for k, p in CONSTRUCTS.items()))
def construct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences of each construct in each page."""
    return audit.construct_counts(_read(spark, sf_dir, "pages"), "page_id", "html", CONSTRUCTS)


_TAG = r"<([a-z][a-z0-9]*)"


def _tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    return pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(_TAG), F.lit(1))).alias("at", "tag"))


_TAGS_SQL = f"t AS (SELECT page_id, unnest(tags) AS tag, generate_subscripts(tags, 1) - 1 AS pos FROM (SELECT page_id, regexp_extract_all(html, '{_TAG}', 1) AS tags FROM pages))"


@_query(f"""WITH {_TAGS_SQL}, s AS (SELECT page_id, 'links' AS construct, len(regexp_extract_all(html, '</(a|p|div)>'))::BIGINT AS scanned FROM pages),
r AS (SELECT page_id, count(*) FILTER (WHERE tag IN ('a', 'p')) AS recorded FROM t GROUP BY 1)
SELECT page_id, construct, scanned, recorded, scanned - recorded AS gap FROM s JOIN r USING (page_id) WHERE scanned > recorded""")
def recall_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages in which a scan for end tags sees more than the recorded anchors and paragraphs."""
    scanned = _read(spark, sf_dir, "pages").select("page_id", F.lit("links").alias("construct"), F.regexp_count("html", F.lit("</(a|p|div)>")).cast("bigint").alias("scanned"))
    recorded = _tags(spark, sf_dir).groupBy("page_id").agg(F.count(F.when(F.col("tag").isin("a", "p"), 1)).alias("recorded")).withColumn("construct", F.lit("links"))
    return audit.recall_gaps(scanned, recorded, ["page_id", "construct"])


@_query(f"WITH {_TAGS_SQL} SELECT page_id, 'tpl:' || pos AS id, tag FROM t")
def doc_order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a page's tags by place in the document."""
    return _tags(spark, sf_dir).select("page_id", F.concat(F.lit("tpl:"), F.col("at").cast("string")).alias("id"), "tag")


@_query(f"WITH {_TAGS_SQL} SELECT page_id, count(*) AS nodes_total, count(DISTINCT tag) AS tags, count(DISTINCT tag) FILTER (WHERE tag NOT IN ('a', 'div', 'p', 'li', 'ul')) AS unrecognized FROM t GROUP BY 1")
def node_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recorded nodes and how many kinds of them are not recognised."""
    known = F.col("tag").isin("a", "div", "p", "li", "ul")
    return _tags(spark, sf_dir).groupBy("page_id").agg(F.count(F.lit(1)).alias("nodes_total"), F.countDistinct("tag").alias("tags"), F.countDistinct(F.when(~known, F.col("tag"))).alias("unrecognized"))


@_query(f"WITH {_TAGS_SQL} SELECT tag, count(*) AS occurrences, count(DISTINCT page_id) AS pages FROM t GROUP BY 1")
def tag_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences by name, with the distinct units that have them."""
    return _tags(spark, sf_dir).groupBy("tag").agg(F.count(F.lit(1)).alias("occurrences"), F.countDistinct("page_id").alias("pages"))


@_query("""WITH x AS (SELECT page_id, regexp_extract_all(html, '</?(?:div|ul|li|article|nav)[\\s>]') AS tags FROM pages),
t AS (SELECT page_id, unnest(tags) AS tag, generate_subscripts(tags, 1) AS pos FROM x),
d AS (SELECT page_id, sum(CASE WHEN tag LIKE '</%' THEN -1 ELSE 1 END) OVER (PARTITION BY page_id ORDER BY pos) AS depth FROM t)
SELECT page_id, max(depth)::BIGINT AS depth FROM pages LEFT JOIN d USING (page_id) GROUP BY 1""")
def nesting_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deepest nesting of block elements; null for a page without any."""
    pages = _read(spark, sf_dir, "pages")
    found = pages.select("page_id", F.posexplode(F.regexp_extract_all("html", F.lit(r"</?(?:div|ul|li|article|nav)[\s>]"), F.lit(0))).alias("at", "tag"))
    depth = F.sum(F.when(F.col("tag").startswith("</"), -1).otherwise(1)).over(Window.partitionBy("page_id").orderBy("at"))
    return pages.select("page_id").join(found.select("page_id", depth.alias("d")), "page_id", "left").groupBy("page_id").agg(F.max("d").cast("bigint").alias("depth"))


@_query("""WITH s AS (SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '<[^>]*>', ' ', 'g'), '[ \\t\\n\\r]+', ' ', 'g')) AS words FROM pages)
SELECT page_id, length(words) AS chars, sha256(words) AS digest FROM s""")
def static_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X16, STR02: a page's visible words, white space collapsed."""
    text = F.regexp_replace("html", r"(?s)<(script|style)[^>]*>.*?</(script|style)>", " ")
    text = F.trim(F.regexp_replace(F.regexp_replace(text, "<[^>]*>", " "), r"[ \t\n\r]+", " "))
    return _read(spark, sf_dir, "pages").select("page_id", text.alias("w")).select("page_id", F.length("w").cast("bigint").alias("chars"), F.sha2("w", 256).alias("digest"))


@_query(f"WITH {_TAGS_SQL}, s(selector, component) AS (VALUES ('nav', 'Navigation'), ('article', 'Article'), ('li', 'Item'), ('app-box', 'Box')) SELECT page_id, component, count(*) AS uses FROM t JOIN s ON tag = selector GROUP BY ALL")
def child_selector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which selectors a page uses, by equality with its tags instead of a pattern for each selector."""
    selectors = spark.createDataFrame([("nav", "Navigation"), ("article", "Article"), ("li", "Item"), ("app-box", "Box")], "tag string, component string")
    return _tags(spark, sf_dir).join(selectors, "tag").groupBy("page_id", "component").agg(F.count(F.lit(1)).alias("uses"))


@_query("""SELECT source, count(*) AS total, count(l.doc_id) AS hits, round(count(l.doc_id) / count(*)::DOUBLE, 3) AS ratio FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY source""")
def coverage_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The share of each source's documents that have a label."""
    labels = _read(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("labelled"))
    return audit.coverage_ratio(_read(spark, sf_dir, "documents").select("doc_id", "source").join(labels, "doc_id", "left"), ["source"], F.col("labelled"))


@_query("""SELECT facet, value, n, total FROM (
  SELECT 'event_type' AS facet, event_type AS value, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY event_type
  UNION ALL SELECT 'bucket', (user_id % 5)::VARCHAR, count(*), round(sum(value), 2) FROM events GROUP BY user_id % 5
  UNION ALL SELECT 'all', NULL, count(*), round(sum(value), 2) FROM events)""")
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and sums by type, by user bucket and overall, in one pass."""
    events = _read(spark, sf_dir, "events").select("event_type", (F.col("user_id") % 5).alias("bucket"), F.col("value").cast("decimal(18,2)").alias("amount"))
    found = audit.run_summary(events, ["event_type", "bucket"], "amount")
    return found.select("facet", "value", "n", F.col("total").cast("double").alias("total"))


@_query("""SELECT count(*) FILTER (WHERE toxic = 0 OR quality = 0) AS checked, count(*) FILTER (WHERE quality = 0) AS failed, count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS skipped, 0::BIGINT AS legacy,
  count(*) FILTER (WHERE toxic = 0 OR quality = 0) > 0 AND count(*) FILTER (WHERE quality = 0) = 0 AS passed FROM labels""")
def validation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by status; a check that examined nothing does not pass."""
    status = F.when(F.col("quality") == 0, "failed").when(F.col("toxic") == 1, "skipped").otherwise("ok")
    return audit.validation_totals(_read(spark, sf_dir, "labels").select(status.alias("status")))


@_query("""WITH d AS (SELECT doc_id, text, CASE WHEN text = '' THEN 0 ELSE len(string_split(text, chr(10))) - CASE WHEN text LIKE '%' || chr(10) THEN 1 ELSE 0 END END AS lines FROM documents)
SELECT doc_id, lines::BIGINT AS lines, CASE WHEN lines > 20 OR length(text) > 8000 THEN 'complex' WHEN lines <= 3 AND length(text) <= 1000 THEN 'trivial' ELSE 'standard' END AS tier, lines > 80 OR length(text) > 20000 AS oversized FROM d""")
def classify_tier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents by size, as units are classified."""
    rows = _read(spark, sf_dir, "documents").select("doc_id", F.length("text").alias("chars"), T.line_count(F.col("text")).alias("lines"))
    tier = F.when((F.col("lines") > 20) | (F.col("chars") > 8000), "complex").when((F.col("lines") <= 3) & (F.col("chars") <= 1000), "trivial").otherwise("standard")
    return rows.select("doc_id", "lines", tier.alias("tier"), ((F.col("lines") > 80) | (F.col("chars") > 20000)).alias("oversized"))


# ---- lookups and joins ---------------------------------------------------------------------------------------

_URL = r"^https?://([^/?#]*)([^?#]*)"


@_query(f"""WITH u AS (SELECT page_id, regexp_extract(url, '{_URL}', 1) AS host, rtrim(regexp_extract(url, '{_URL}', 2), '/') AS path FROM pages),
k AS (SELECT DISTINCT host || path AS name FROM u),
c AS (SELECT page_id, unnest([replace(host, 'blog.', '') || path, replace(host, 'm.', '') || path, host || path]) AS name, unnest([0, 1, 2]) AS rank FROM u WHERE page_id % 2 = 0 OR true)
SELECT u.page_id, host || path AS ref, (SELECT arg_min(c.name, c.rank) FROM c JOIN k ON k.name = c.name WHERE c.page_id = u.page_id) AS resolved FROM u""")
def import_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each page resolved to the first of three candidate addresses that exists."""
    url = F.col("url")
    pages = _read(spark, sf_dir, "pages").select("page_id", F.regexp_extract(url, _URL, 1).alias("host"), F.rtrim(F.regexp_extract(url, _URL, 2), F.lit("/")).alias("path"))
    whole = lambda host: F.concat(host, F.col("path"))
    candidates = [whole(F.replace("host", F.lit("blog."), F.lit(""))), whole(F.replace("host", F.lit("m."), F.lit(""))), whole(F.col("host"))]
    refs = pages.select("page_id", whole(F.col("host")).alias("ref"), F.array(*candidates).alias("names"))
    found = lookup.first_candidate(refs, [F.col("names")[i] for i in range(3)], pages.select(whole(F.col("host")).alias("name")), "page_id", "resolved")
    return found.select("page_id", "ref", "resolved")


@_query("""SELECT c_nationkey AS nation, arg_max(c_custkey, (c_acctbal, c_custkey)) AS custkey, arg_max(c_name, (c_acctbal, c_custkey)) AS name FROM customer GROUP BY 1""")
def last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of rows with the same key the last one."""
    found = lookup.last_wins(_read(spark, sf_dir, "customer"), "c_nationkey", ["c_acctbal", "c_custkey"], ["c_custkey", "c_name"])
    return found.select(F.col("c_nationkey").alias("nation"), F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"))


@_query("""SELECT o_orderkey AS orderkey, coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 'own' END, c_name) AS resolved FROM orders LEFT JOIN customer ON c_custkey = o_custkey + 50""")
def upsert_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J07, SNK03: nulls filled from a dimension, what is there kept."""
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") + 50).alias("key"), F.when(F.col("o_orderkey") % 3 == 0, "own").alias("resolved"))
    names = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), "c_name")
    return lookup.filled(orders, names, "key", "resolved", "c_name").select(F.col("o_orderkey").alias("orderkey"), "resolved")


@_query("""SELECT c_custkey AS custkey, s_suppkey AS suppkey, n.n_name AS nation FROM customer JOIN nation n ON c_nationkey = n_nationkey JOIN supplier ON s_nationkey = n_nationkey
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AND s_acctbal > 5000""")
def multi_hop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer, nation, supplier, only for customers that have no urgent orders of their own."""
    customers = _read(spark, sf_dir, "customer").join(_read(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey")), "c_custkey", "left_anti")
    nations, suppliers = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "supplier").filter("s_acctbal > 5000")
    found = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).join(suppliers, F.col("s_nationkey") == F.col("n_nationkey"))
    return found.select(F.col("c_custkey").alias("custkey"), F.col("s_suppkey").alias("suppkey"), F.col("n_name").alias("nation"))


@_query(f"""WITH u AS (SELECT page_id, regexp_extract(url, '{_URL}', 1) || rtrim(regexp_extract(url, '{_URL}', 2), '/') AS path FROM pages),
m AS (SELECT DISTINCT regexp_extract(path, '^[^/]*(/[^/]*)?', 0) AS prefix FROM u WHERE page_id % 3 = 0)
SELECT page_id, path, arg_max(prefix, length(prefix)) AS ancestor FROM u LEFT JOIN m ON path = prefix OR starts_with(path, prefix || '/') GROUP BY ALL""")
def nearest_ancestor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest marked ancestor of each page's path."""
    path = F.concat(F.regexp_extract("url", _URL, 1), F.rtrim(F.regexp_extract("url", _URL, 2), F.lit("/")))
    pages = _read(spark, sf_dir, "pages").select("page_id", path.alias("path"))
    marked = pages.filter("page_id % 3 = 0").select(F.regexp_extract("path", "^[^/]*(/[^/]*)?", 0).alias("prefix"))
    return lookup.nearest_ancestor(pages, "page_id", "path", marked, "ancestor")


@_query(r"""WITH w AS (SELECT DISTINCT conv_id, turn, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM conversations), v(word, kind) AS (VALUES ('the', 'article'), ('der', 'article'), ('und', 'conjunction'), ('and', 'conjunction'), ('que', 'pronoun'))
SELECT kind, word, count(*) AS turns, count(DISTINCT conv_id) AS conversations FROM w JOIN v USING (word) GROUP BY ALL""")
def token_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of a vocabulary in texts, by equality of tokens."""
    words = F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))))
    vocabulary = spark.createDataFrame([("the", "article"), ("der", "article"), ("und", "conjunction"), ("and", "conjunction"), ("que", "pronoun")], "word string, kind string")
    found = _read(spark, sf_dir, "conversations").select("conv_id", "turn", words.alias("word")).join(vocabulary, "word")
    return found.groupBy("kind", "word").agg(F.count(F.lit(1)).alias("turns"), F.countDistinct("conv_id").alias("conversations"))


@_query("""SELECT id, arg_min(name, source) AS name, min(source)::BIGINT AS source FROM (SELECT c_custkey AS id, c_name AS name, 0 AS source FROM customer WHERE c_custkey % 2 = 0
UNION ALL SELECT s_suppkey, s_name, 1 FROM supplier UNION ALL SELECT p_partkey, p_name, 2 FROM part) GROUP BY id""")
def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first of several sources that knows an id."""
    customers = _read(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    suppliers = _read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    parts = _read(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return lookup.located([customers, suppliers, parts], "id", "name")


@_query("""SELECT kind, id, target FROM (SELECT 'orders' AS kind, o_orderkey AS id, o_custkey AS target FROM orders UNION ALL SELECT 'lines', l_orderkey, l_suppkey FROM lineitem UNION ALL SELECT 'events', event_id, user_id FROM events) WHERE target = 7""")
def refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """U01, verb refs: everything that refers to an id, of whatever kind."""
    parts = [("orders", "orders", "o_orderkey", "o_custkey"), ("lines", "lineitem", "l_orderkey", "l_suppkey"), ("events", "events", "event_id", "user_id")]
    return reduce(DataFrame.unionByName, [_read(spark, sf_dir, t).filter(F.col(c) == 7).select(F.lit(kind).alias("kind"), F.col(k).alias("id"), F.col(c).alias("target")) for kind, t, k, c in parts])


# ---- text ----------------------------------------------------------------------------------------------------


@_query("""SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(lower(text), '[^a-z0-9]', ' ', 'g'), '\\s+', ' ', 'g'))) AS digest FROM documents""")
def normalised_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR01: normalised texts, as digests."""
    return _read(spark, sf_dir, "documents").select("doc_id", F.sha2(T.normalised(F.col("text")), 256).alias("digest"))


_NORM_SQL = "trim(regexp_replace(regexp_replace(lower({0}), '[^a-z0-9]', ' ', 'g'), '\\s+', ' ', 'g'))"


@_query(f"""WITH n AS (SELECT item_id, {_NORM_SQL.format('text')} AS needle FROM benchmark), h AS (SELECT doc_id, {_NORM_SQL.format('text')} AS hay FROM documents),
w AS (SELECT *, list_filter(string_split(needle, ' '), lambda x: length(x) > 3) AS words FROM n)
SELECT item_id, doc_id FROM w JOIN h ON contains(hay, needle) OR (len(words) > 0 AND len(list_filter(words, lambda x: contains(hay, x))) >= ceil(len(words) * 0.7))""")
def mentioned_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J13, STR06: benchmark items that a document mentions, as a phrase or by seven tenths of its long words."""
    needles = _read(spark, sf_dir, "benchmark").select("item_id", T.normalised(F.col("text")).alias("needle"))
    texts = _read(spark, sf_dir, "documents").select("doc_id", T.normalised(F.col("text")).alias("hay"))
    return mentions(needles, texts)


@_query(f"""WITH n AS (SELECT item_id, list_distinct(list_filter(string_split({_NORM_SQL.format('text')}, ' '), lambda x: length(x) > 3)) AS words FROM benchmark),
w AS (SELECT item_id, len(words) AS n, unnest(words) AS word FROM n), h AS (SELECT DISTINCT doc_id, unnest(string_split({_NORM_SQL.format('text')}, ' ')) AS word FROM documents)
SELECT item_id, doc_id, count(*) AS found, any_value(n)::BIGINT AS words FROM w JOIN h USING (word) GROUP BY item_id, doc_id HAVING count(*) >= ceil(any_value(n) * 0.7)""")
def mentioned_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R29's other form: whole words instead of substrings, joined by equality over all documents."""
    words = F.array_distinct(T.significant_words(T.normalised(F.col("text"))))
    needles = _read(spark, sf_dir, "benchmark").select("item_id", words.alias("all")).select("item_id", F.size("all").cast("bigint").alias("words"), F.explode("all").alias("word"))
    hay = _read(spark, sf_dir, "documents").select("doc_id", F.explode(F.array_distinct(F.split(T.normalised(F.col("text")), " "))).alias("word"))
    found = hay.join(needles, "word").groupBy("item_id", "doc_id").agg(F.count(F.lit(1)).alias("found"), F.max("words").alias("words"))
    return found.filter(F.col("found") >= F.ceil(F.col("words") * 0.7))


#: Words that should not stand in neutral prose.
TERMS = ("license", "moron", "idiot", "copyright", "released")


@_query("SELECT term, count(*) FILTER (WHERE contains(lower(text), term)) AS documents, count(*) FILTER (WHERE contains(lower(text), term)) = 0 AS neutral FROM documents CROSS JOIN (VALUES " + ", ".join(f"('{t}')" for t in TERMS) + ") v(term) GROUP BY term")
def term_neutrality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents contain each term; a text is read once for all terms."""
    low = F.lower("text")
    counted = _read(spark, sf_dir, "documents").agg(*[F.count(F.when(F.contains(low, F.lit(t)), 1)).alias(t) for t in TERMS])
    return counted.unpivot([], list(TERMS), "term", "documents").withColumn("neutral", F.col("documents") == 0)


@_query(f"""SELECT page_id, regexp_extract(url, '([^/?#]*)(?:[?#].*)?$', 1) AS base, regexp_extract(regexp_replace(url, '[?#].*$', ''), '^(.*)/[^/]*$', 1) AS dir,
  TRY_CAST(nullif(regexp_extract(url, '([0-9]+)', 1), '') AS BIGINT) AS number, split_part(url, ':', 1) AS scheme, upper(substr(url, 1, 1)) || substr(url, 2) AS capital FROM pages""")
def path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR07, STR08, STR10, STR11: parts of paths and ids."""
    path = F.regexp_replace("url", "[?#].*$", "")
    return _read(spark, sf_dir, "pages").select("page_id", T.base_name(path).alias("base"), T.dir_name(path).alias("dir"), T.major_version(F.col("url")).alias("number"), T.id_prefix(F.col("url")).alias("scheme"), F.concat(F.upper(F.substring("url", 1, 1)), F.expr("substr(url, 2)")).alias("capital"))


@_query("SELECT substr(sha256(text), 1, 16) AS hash, min(doc_id) AS unit, count(*) - 1 AS hits FROM documents GROUP BY 1 HAVING count(*) > 1")
def content_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HSH01, I01: texts that a cache by content would hit."""
    hashed = _read(spark, sf_dir, "documents").select("doc_id", incremental.content_hash(F.col("text")).alias("hash"))
    return hashed.groupBy("hash").agg(F.min("doc_id").alias("unit"), (F.count(F.lit(1)) - 1).alias("hits")).filter("hits > 0")


@_query("SELECT doc_id AS unit, substr(sha256(text), 1, 16) AS hash FROM documents WHERE doc_id % 4 <> 0")
def changed_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose unit and hash the cache lacks; it has a quarter right, and another with an old hash."""
    current = _read(spark, sf_dir, "documents").select(F.col("doc_id").alias("unit"), incremental.content_hash(F.col("text")).alias("hash"))
    cached = current.filter("unit % 4 = 0").unionByName(current.filter("unit % 4 = 1").withColumn("hash", F.reverse("hash")).filter("hash <> reverse(hash)"))
    return incremental.changed_units(current, cached)


@_query("""SELECT user_id AS unit, arg_max(event_type, (ts, event_id)) FILTER (WHERE event_type <> 'view') AS status, arg_max(value, (ts, event_id)) FILTER (WHERE event_type = 'purchase') AS amount FROM events GROUP BY 1""")
def manifest_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W03, SNK07: the state that merging a unit's events in order leaves."""
    events = _read(spark, sf_dir, "events").select("ts", "event_id", F.col("user_id").alias("unit"), F.when(F.col("event_type") != "view", F.col("event_type")).alias("status"), F.when(F.col("event_type") == "purchase", F.col("value")).alias("amount"))
    return incremental.latest_state(events, "unit", ["ts", "event_id"], ["status", "amount"])


@_query("""WITH s AS (SELECT user_id, arg_max(event_type, (ts, event_id)) AS status FROM events GROUP BY 1) SELECT c_custkey AS unit FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM s WHERE status IN ('purchase', 'signup'))""")
def pending_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units that a resumed run still processes."""
    events = _read(spark, sf_dir, "events").select("ts", "event_id", F.col("user_id").alias("unit"), F.col("event_type").alias("status"))
    state = incremental.latest_state(events, "unit", ["ts", "event_id"], ["status"])
    return incremental.pending_units(_read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("unit")), state, "unit", ("purchase", "signup"))


# ---- diffs ---------------------------------------------------------------------------------------------------


@_query("""WITH e AS (SELECT c_custkey AS unit, c_mktsegment AS v FROM customer WHERE c_custkey % 10 <> 3), a AS (SELECT c_custkey AS unit, CASE WHEN c_custkey % 10 = 1 THEN NULL WHEN c_custkey % 10 = 2 THEN lower(c_mktsegment) ELSE c_mktsegment END AS v FROM customer WHERE c_custkey % 10 <> 4)
SELECT unit, e.v AS expected, a.v AS actual, CASE WHEN a.unit IS NULL THEN 'missing' WHEN e.unit IS NULL THEN 'unexpected' ELSE 'changed' END AS status FROM e FULL JOIN a USING (unit) WHERE a.unit IS NULL OR e.unit IS NULL OR e.v IS DISTINCT FROM a.v""")
def golden_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table against a changed copy of it."""
    rows = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("unit"), F.col("c_mktsegment").alias("v"))
    k = F.col("unit") % 10
    actual = rows.filter(k != 4).withColumn("v", F.when(k == 1, F.lit(None)).when(k == 2, F.lower("v")).otherwise(F.col("v")))
    return diff.golden_diff(rows.filter(k != 3), actual, ["unit"], "v")


@_query("""WITH p AS (SELECT conv_id, role, count(*)::VARCHAR AS turns, (max(length(text)) > 500)::VARCHAR AS long FROM conversations GROUP BY 1, 2),
n AS (SELECT conv_id, role, 'turns' AS name, turns AS v FROM p UNION ALL SELECT conv_id, role, 'long', long FROM p)
SELECT u.conv_id AS "left", u.name, u.v = a.v AS same FROM n u JOIN n a ON u.conv_id = a.conv_id AND u.name = a.name WHERE u.role = 'user' AND a.role = 'assistant' AND NOT (u.name = 'long' AND u.conv_id % 2 = 0)""")
def pair_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Projections of both sides of each conversation, minus declared differences."""
    turns = _read(spark, sf_dir, "conversations")
    unit = F.concat(F.col("role"), F.lit(":"), F.col("conv_id").cast("string"))
    sums = turns.groupBy(unit.alias("unit")).agg(F.count(F.lit(1)).cast("string").alias("turns"), (F.max(F.length("text")) > 500).cast("string").alias("long"))
    sums = sums.unpivot(["unit"], ["turns", "long"], "name", "value")
    ids = turns.select("conv_id").distinct()
    name = lambda role: F.concat(F.lit(f"{role}:"), F.col("conv_id").cast("string"))
    pairs = ids.select(name("user").alias("left"), name("assistant").alias("right"))
    free = ids.filter("conv_id % 2 = 0").select(name("user").alias("left"), name("assistant").alias("right"), F.lit("long").alias("name"))
    found = diff.pair_equivalence(sums, pairs, free)
    return found.select(F.substring_index("left", ":", -1).cast("bigint").alias("left"), "name", "same")


@_query("""WITH v(event_type) AS (VALUES ('click'), ('view'), ('refund'), ('error')) SELECT event_type, 'undeclared' AS side FROM (SELECT DISTINCT event_type FROM events EXCEPT SELECT event_type FROM v)
UNION ALL SELECT event_type, 'unused' FROM (SELECT event_type FROM v EXCEPT SELECT event_type FROM events)""")
def vocab_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event types in use against a declared vocabulary."""
    declared = spark.createDataFrame([("click",), ("view",), ("refund",), ("error",)], "event_type string")
    return diff.vocabulary_diff(_read(spark, sf_dir, "events"), declared, "event_type")


# ---- JSON, chunks, sections, outline -------------------------------------------------------------------------


@_query("SELECT event_id, 'k' AS path, json_extract_string(props, '$.k') AS leaf FROM events")
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSN01: leaves of each event's properties by path."""
    return flattened(_read(spark, sf_dir, "events"), "event_id", "props")


@_query("SELECT DISTINCT 'user:' || user_id AS id FROM events WHERE 'user:' || user_id LIKE '%user:1%'")
def where_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSN02, verb where: member ids that contain a string, anywhere in nested documents."""
    nested = F.to_json(F.struct(F.struct(F.array(F.concat(F.lit("user:"), F.col("user_id").cast("string"))).alias("readBy"), F.col("event_type")).alias("use")))
    return searched(flattened(_read(spark, sf_dir, "events").select("event_id", nested.alias("doc")), "event_id", "doc"), "user:1")


@_query("""SELECT ref, count(*) AS places FROM (SELECT event_id, 'user:' || user_id AS ref FROM events UNION ALL SELECT event_id, 'type:' || event_type FROM events) GROUP BY ref""")
def reference_harvest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSN03: references under known property names: arrays, and keys and values of maps."""
    made = F.struct(F.array(F.concat(F.lit("user:"), F.col("user_id").cast("string"))).alias("usedBy"), F.struct(F.concat(F.lit("type:"), F.col("event_type")).alias("kind")).alias("calls"), F.col("value").alias("other"))
    leaves_of = flattened(_read(spark, sf_dir, "events").select("event_id", F.to_json(made).alias("doc")), "event_id", "doc")
    found = harvested(leaves_of.withColumn("path", F.concat(F.col("event_id").cast("string"), F.lit("."), F.col("path"))), ["usedBy", "calls"])
    return found.filter(F.contains("ref", F.lit(":"))).groupBy("ref").agg(F.count(F.lit(1)).alias("places"))


@_query("SELECT o_custkey AS custkey, o_orderkey AS orderkey, (row_number() OVER w - 1) // 4 AS chunk, 'order:' || row_number() OVER w AS id FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def batch_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered orders of each customer, in chunks of four."""
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey"))
    rows = _read(spark, sf_dir, "orders").withColumn("n", n)
    return rows.select(F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"), F.floor((F.col("n") - 1) / 4).cast("bigint").alias("chunk"), F.concat(F.lit("order:"), F.col("n").cast("string")).alias("id"))


@_query("""SELECT c_custkey AS unit, CASE WHEN c_custkey % 5 IN (0, 1) AND c_custkey % 5 <> 1 THEN c_name || ' edited' ELSE c_name || ' in ' || c_mktsegment END AS body, c_custkey % 5 = 0 AS kept FROM customer""")
def section_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections that people edited stay, others are rendered anew."""
    rows = _read(spark, sf_dir, "customer")
    new = rows.select(F.col("c_custkey").alias("unit"), F.concat("c_name", F.lit(" in "), "c_mktsegment").alias("body"))
    edited = rows.filter("c_custkey % 5 = 0").select(F.col("c_custkey").alias("unit"), F.concat("c_name", F.lit(" edited")).alias("body"), sections.body_hash(F.col("c_name")).alias("hash"))
    untouched = rows.filter("c_custkey % 5 = 1").select(F.col("c_custkey").alias("unit"), F.col("c_name").alias("body"), sections.body_hash(F.col("c_name")).alias("hash"))
    return sections.merged_sections(new, edited.unionByName(untouched), ["unit"])


@_query("""WITH r AS (SELECT l_orderkey AS unit, string_agg(l_linenumber || ' ' || l_partkey, chr(10) ORDER BY l_linenumber, l_partkey) AS body FROM lineitem GROUP BY 1)
SELECT unit, substr(sha256(body), 1, 8) AS hash, length(body) AS chars FROM r""")
def rendered_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each order's lines, sorted, rendered into a fenced section, and its body read back."""
    line = F.struct("l_linenumber", "l_partkey")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: F.concat_ws(" ", x.getField("l_linenumber"), x.getField("l_partkey"))), "\n")
    made = _read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("unit")).agg(body.alias("body"))
    read = made.select("unit", sections.section_body(sections.fenced(F.lit("lines"), F.col("body")), "lines").alias("body"))
    return read.select("unit", sections.body_hash(F.col("body")).alias("hash"), F.length("body").cast("bigint").alias("chars"))


@_query("""SELECT c_custkey AS unit, c_mktsegment AS kind, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey) AS orders, (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_custkey = c_custkey) AS lines,
  (SELECT count(*) FROM events WHERE user_id = c_custkey AND event_type = 'error') AS errors FROM customer""")
def outline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verb outline, A10: one row for each unit with the counts of its parts."""
    count = F.count(F.lit(1))
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("unit"))
    lines = _read(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(count.alias("n"))
    by_unit = orders.join(lines, "o_orderkey", "left").groupBy("unit").agg(count.alias("orders"), F.sum("n").alias("lines"))
    errors = _read(spark, sf_dir, "events").filter("event_type = 'error'").groupBy(F.col("user_id").alias("unit")).agg(count.alias("errors"))
    units = _read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("unit"), F.col("c_mktsegment").alias("kind"))
    return units.join(by_unit, "unit", "left").join(errors, "unit", "left").select("unit", "kind", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("orders", "lines", "errors")])
