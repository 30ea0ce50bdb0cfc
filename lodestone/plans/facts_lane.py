"""Queries over the given tables for units' facts, their state and their order, each with the SQL that must give the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.operators import facts, incremental
from lodestone.plans.table_lane import read_table
from lodestone.sources import tokens

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


def _count() -> Column:
    return F.count(F.lit(1))


@_query("""SELECT o_custkey AS unit, count(*) FILTER (WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')) AS blocking, count(*) FILTER (WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')) AS other FROM orders GROUP BY 1""")
def blocking_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocking and other questions of each unit: here a customer's urgent orders and the rest."""
    blocking = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("unit")).agg(F.count_if(blocking).alias("blocking"), F.count_if(~blocking).alias("other"))


@_query("SELECT l_orderkey AS unit, bool_or(l_returnflag = 'R') AS uses, bool_and(l_quantity > 5) AS every FROM lineitem GROUP BY 1")
def exists_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A19, ARR01: whether any, and whether every part of a unit satisfies a condition, without gathering the parts."""
    return read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("unit")).agg(F.bool_or(F.col("l_returnflag") == "R").alias("uses"), F.bool_and(F.col("l_quantity") > 5).alias("every"))


@_query("""WITH b AS (SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'set' END AS was, c_name AS now FROM orders LEFT JOIN customer ON c_custkey = o_custkey + 200)
SELECT 'kept' AS change, count(*) AS n FROM b WHERE was IS NOT NULL UNION ALL SELECT 'filled', count(*) FROM b WHERE was IS NULL AND now IS NOT NULL
UNION ALL SELECT 'unresolved', count(*) FROM b WHERE was IS NULL AND now IS NULL""")
def backfill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a backfill keeps, fills and can't resolve."""
    orders = read_table(spark, sf_dir, "orders").select((F.col("o_custkey") + 200).alias("key"), F.when(F.col("o_orderkey") % 4 == 0, "set").alias("was"))
    names = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("now"))
    return facts.backfill_report(orders.join(names, "key", "left"), "was", "now")


@_query("""SELECT o_orderkey AS unit, coalesce(CASE WHEN c_custkey IS NULL THEN 'skipped' ELSE CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'pending' END END) AS status
FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3) ON c_custkey = o_custkey""")
def batch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units of a batch with their status; those that have no record are skipped."""
    known = read_table(spark, sf_dir, "customer").filter("c_nationkey <> 3").select(F.col("c_custkey").alias("key"), F.lit(True).alias("there"))
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("key"), "o_orderstatus")
    status = F.when(F.col("there").isNull(), "skipped").when(F.col("o_orderstatus") == "F", "completed").otherwise("pending")
    return orders.join(known, "key", "left").select(F.col("o_orderkey").alias("unit"), status.alias("status"))


#: Steps of a run in order, for the status machine: here the kinds of events of a user.
STEPS = ("signup", "view", "click", "purchase")


@_query(f"""WITH e AS (SELECT user_id AS unit, event_id AS pos, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'done' END AS outcome, CASE WHEN event_type = 'error' THEN NULL ELSE list_position({list(STEPS)!r}, event_type) END AS step FROM events WHERE event_type = 'error' OR event_type IN {STEPS!r}),
s AS (SELECT unit, max(pos) FILTER (WHERE outcome = 'failed') AS failed_at, max(pos) AS last_at, max(step) AS reached, count(DISTINCT step) AS steps FROM e GROUP BY 1)
SELECT user_id AS unit, {list(STEPS)!r}[reached] AS last_step, CASE WHEN s.unit IS NULL THEN 'pending' WHEN failed_at = last_at THEN 'failed' WHEN steps = {len(STEPS)} THEN 'completed' WHEN failed_at IS NOT NULL THEN 'degraded' ELSE 'running' END AS status
FROM (SELECT DISTINCT user_id FROM events) LEFT JOIN s ON s.unit = user_id""")
def status_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The status of each unit from the events of its steps."""
    events = read_table(spark, sf_dir, "events")
    steps = events.filter((F.col("event_type") == "error") | F.col("event_type").isin(*STEPS))
    steps = steps.select(F.col("user_id").alias("unit"), F.col("event_id").alias("at"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("step"), (F.col("event_type") == "error").alias("failed"))
    return incremental.step_status(events.select(F.col("user_id").alias("unit")).distinct(), steps, STEPS)


@_query("""WITH e AS (SELECT user_id AS unit, event_id AS pos, CASE WHEN event_type <> 'error' THEN event_type END AS state, CASE WHEN event_type = 'purchase' THEN value END AS score FROM events)
SELECT unit, arg_max(state, pos) FILTER (WHERE state IS NOT NULL) AS state, arg_max(score, pos) FILTER (WHERE score IS NOT NULL) AS score, max(pos) AS updated_at FROM e GROUP BY 1""")
def manifest_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK07: entries merged into a manifest, newer values over older ones, with the stamp of the last one."""
    entries = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("unit"), F.col("event_id").alias("at"), F.when(F.col("event_type") != "error", F.col("event_type")).alias("state"), F.when(F.col("event_type") == "purchase", F.col("value")).alias("score"))
    old, new = entries.filter("at % 2 = 0"), entries.filter("at % 2 = 1")
    return incremental.upserted(incremental.manifest(old, "unit", "at", ["state", "score"]), incremental.manifest(new, "unit", "at", ["state", "score"]), "unit", ["state", "score"])


@_query("""SELECT l_suppkey AS unit, l_partkey AS "from", s_nationkey AS "to", count(*) AS places FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE l_returnflag IN ('R', 'A') GROUP BY ALL""")
def derived_from(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an accessor reads: edges of one kind, joined to what declares their ends, with the number of places."""
    reads = read_table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("unit"), F.col("l_partkey").alias("from"), F.col("l_returnflag").alias("kind"))
    fields = read_table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("unit"), F.col("s_nationkey").alias("to"))
    return facts.derived_from(reads, fields, ("R", "A"))


@_query("""SELECT DISTINCT o_custkey AS "from", o_orderkey AS "to" FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.08)""")
def signal_dependencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls of one kind that lead to a declared signal, by a semi join."""
    calls = read_table(spark, sf_dir, "orders").filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("from"), F.col("o_orderkey").alias("to"))
    return facts.signal_dependencies(calls, read_table(spark, sf_dir, "lineitem").filter("l_discount > 0.08").select(F.col("l_orderkey").alias("to")))


@_query("""WITH m AS (SELECT o_custkey AS unit, 'order:' || o_orderkey AS member FROM orders WHERE o_orderstatus = 'P' UNION SELECT user_id, 'event:' || event_type FROM events UNION SELECT c_custkey, 'self:' || c_mktsegment FROM customer)
SELECT unit, string_agg(member, ',' ORDER BY member) AS members, count(*) AS n FROM m GROUP BY 1""")
def template_reachable(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each unit's entry members, the union of three sources, distinct and sorted."""
    name = lambda kind, c: F.concat(F.lit(f"{kind}:"), F.col(c).cast("string"))
    sources = [
        read_table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("unit"), name("order", "o_orderkey").alias("member")),
        read_table(spark, sf_dir, "events").select(F.col("user_id").alias("unit"), name("event", "event_type").alias("member")),
        read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("unit"), name("self", "c_mktsegment").alias("member")),
    ]
    return facts.entry_members(*sources).select("unit", F.array_join("members", ",").alias("members"), F.size("members").cast("bigint").alias("n"))


@_query("""WITH g AS (SELECT o_custkey AS f, o_orderkey AS t, 'own' AS via FROM orders UNION ALL SELECT c_custkey, c_custkey % 50, 'template' FROM customer UNION ALL SELECT o_custkey, o_custkey % 50, 'template' FROM orders)
SELECT f AS "from", t AS "to", min(via) AS via FROM g WHERE f <> t GROUP BY 1, 2""")
def joined_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of two kinds in one graph, without self edges, each pair once; an own edge before a template's."""
    orders = read_table(spark, sf_dir, "orders")
    own = orders.select(F.col("o_custkey").alias("from"), F.col("o_orderkey").alias("to"), F.lit("own").alias("via"))
    units = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("from")).unionByName(orders.select(F.col("o_custkey").alias("from")))
    return facts.joined_graph(own, units.select("from", (F.col("from") % 50).alias("to"), F.lit("template").alias("via")))


@_query("SELECT DISTINCT user_id AS unit, event_type AS code FROM events WHERE (user_id, event_type) NOT IN (SELECT user_id, event_type FROM events WHERE value > 60)")
def uncited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is recorded and never cited."""
    events = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("unit"), F.col("event_type").alias("code"), "value")
    return facts.uncited(events.select("unit", "code"), events.filter("value > 60"), ["unit", "code"])


@_query("""WITH s AS (SELECT doc_id, unnest(string_split(text, '.')) AS label FROM documents), t AS (SELECT doc_id, trim(label, ' ' || chr(9) || chr(10) || chr(13)) AS label FROM s)
SELECT doc_id, count(DISTINCT label) AS labels, min(label) AS first FROM t WHERE length(label) >= 2 AND NOT regexp_full_match(label, '[0-9]+') GROUP BY 1""")
def screen_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of each text: trimmed, two characters or more, not digits alone, distinct."""
    parts = read_table(spark, sf_dir, "documents").select("doc_id", F.explode(F.split("text", r"\.")).alias("label"))
    return parts.select("doc_id", T.label(F.col("label")).alias("label")).filter("label IS NOT NULL").groupBy("doc_id").agg(F.countDistinct("label").alias("labels"), F.min("label").alias("first"))


@_query("SELECT page_id, url, regexp_matches(url, '[?&](ref|utm_[a-z]+|session)=|/tmp/|[0-9]{4,}$') AS volatile FROM pages")
def volatile_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths that match any of a list of patterns, so that comparisons leave them out."""
    return read_table(spark, sf_dir, "pages").select("page_id", "url", T.matches_any(F.col("url"), (r"[?&](ref|utm_[a-z]+|session)=", "/tmp/", "[0-9]{4,}$")).alias("volatile"))


#: Sections that a page must have, by the tag that begins them.
REQUIRED = ("head", "body", "nav", "article", "footer")


@_query(f"""SELECT page_id, section, contains(html, '<' || section) AS present FROM pages, (SELECT unnest({list(REQUIRED)!r}) AS section)""")
def required_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P25: which of the required sections each page has; the page is read once, whatever their number."""
    return facts.required_sections(read_table(spark, sf_dir, "pages"), "page_id", F.col("html"), {s: f"<{s}" for s in REQUIRED})


@_query(r"""SELECT doc_id, length(regexp_replace(regexp_replace(regexp_replace(src, '(?s)```.*?```', ' ', 'g'), '`[^`\n]*`', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g')) AS prose
FROM (SELECT doc_id, text || ' `code` <!-- ' || source || ' --> ```' || lang || '```' || ' end' AS src FROM documents)""")
def prose_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR03: characters of a text without fenced code, inline code and comments."""
    made = F.concat("text", F.lit(" `code` <!-- "), "source", F.lit(" --> ```"), "lang", F.lit("``` end"))
    return read_table(spark, sf_dir, "documents").select("doc_id", F.length(T.prose(made)).cast("bigint").alias("prose"))


#: Pieces of source text with what is left of each; SQL joins the second halves and never looks for comments or literals.
_PIECES = (
    ("'a = '", "'a = '"),
    ("concat('\"', p_name, ' // no ', chr(92), '\" /* ', repeat(p_type, p_size * 40), '\"')", "' '"),
    ("concat(' + b; // ', p_brand, ' \"open', chr(10))", "concat(' + b; ', chr(10))"),
    ("concat('/* ', p_type, ' it', chr(39), 's \"x ', repeat('* ', p_size * 60), '*/ c(')", "' c('"),
    ("concat(chr(39), p_name, chr(92), chr(92), chr(39))", "' '"),
    ("concat(') / d `t ', p_size, ' ', chr(92), '` ', chr(10), '${ e }`')", "') / d  '"),
    ("CASE p_partkey % 4 WHEN 0 THEN concat('f /* open ', p_name) WHEN 1 THEN concat('g \"open ', p_name, chr(92)) WHEN 2 THEN concat('h // ', p_name) ELSE ';' END", "CASE p_partkey % 4 WHEN 0 THEN 'f ' WHEN 1 THEN 'g  ' WHEN 2 THEN 'h ' ELSE ';' END"),
)
_OF_PART = lambda side: "concat(" + ", ".join(p[side] for p in _PIECES).replace("p_size * 40", "CAST(p_size * 40 AS INT)").replace("p_size * 60", "CAST(p_size * 60 AS INT)") + ")"


@_query(f"SELECT p_partkey, {_OF_PART(1)} AS code FROM part")
def code_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR04: source text without comments and with string literals as a space each, whichever begins first, however long, and open ones."""
    return read_table(spark, sf_dir, "part").select("p_partkey", tokens.code_only(F.expr(_OF_PART(0))).alias("code"))


@_query("""SELECT page_id, len(regexp_extract_all(url, '\\.')) AS dots, length(url) - length(replace(url, 'e.c', '')) AS removed FROM pages""")
def literal_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR09: a literal with special characters used as a pattern."""
    url = F.col("url")
    return read_table(spark, sf_dir, "pages").select("page_id", F.regexp_count(url, F.lit(T.escaped("."))).cast("bigint").alias("dots"), (F.length(url) - F.length(F.regexp_replace(url, T.escaped("e.c"), ""))).cast("bigint").alias("removed"))


@_query("""SELECT page_id, kind, count(*) AS n FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1)) AS tag FROM pages) JOIN (VALUES ('a', 'link'), ('nav', 'link'), ('li', 'list'), ('ul', 'list'), ('p', 'text'), ('h1', 'text'), ('h2', 'text')) AS k(tag, kind) USING (tag) GROUP BY ALL""")
def construct_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Occurrences by the class that a small dimension gives to each construct."""
    kinds = spark.createDataFrame([("a", "link"), ("nav", "link"), ("li", "list"), ("ul", "list"), ("p", "text"), ("h1", "text"), ("h2", "text")], "tag string, kind string")
    tags = read_table(spark, sf_dir, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit("<([a-z][a-z0-9]*)"), F.lit(1))).alias("tag"))
    return tags.join(kinds, "tag").groupBy("page_id", "kind").agg(_count().alias("n"))


@_query("""SELECT o_custkey AS unit, o_orderkey AS step, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(rank, 0), o_orderkey) AS position
FROM (SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 END AS rank FROM orders) QUALIFY position <= 3""")
def first_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first three steps of each unit; steps without an order come as 0."""
    orders = read_table(spark, sf_dir, "orders")
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 1).when(F.col("o_orderpriority") == "2-HIGH", 2)
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy(F.coalesce(rank, F.lit(0)), "o_orderkey"))
    return orders.select(F.col("o_custkey").alias("unit"), F.col("o_orderkey").alias("step"), n.cast("bigint").alias("position")).filter("position <= 3")


@_query("""SELECT user_id AS unit, string_agg(event_type || '=' || n, ',' ORDER BY event_type) AS entries FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1""")
def entry_maps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MAP01: a map for each unit, built from entries, and its entries back in the order of the keys."""
    counts = read_table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("unit"), "event_type").agg(_count().alias("n"))
    made = counts.groupBy("unit").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return made.select("unit", F.array_join(F.transform(F.array_sort(F.map_entries("m")), lambda e: F.concat_ws("=", e.getField("key"), e.getField("value"))), ",").alias("entries"))


@_query("""SELECT c_custkey AS unit, coalesce(nullif(c_mktsegment, 'BUILDING'), n_name, '-') AS name, upper(substr(c_name, 1, 1)) || lower(substr(c_name, 2)) AS title, rpad(c_mktsegment, 12, '.') AS padded,
  starts_with(c_name, 'Customer#00000000') AS early, round(greatest(c_acctbal, 0) * 1000) / 1000 AS balance, ceil(c_acctbal)::BIGINT AS up FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND n_nationkey < 5""")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NUL01, STR10, MTH01: first values that are not null, text and number functions."""
    nation = read_table(spark, sf_dir, "nation").filter("n_nationkey < 5").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = read_table(spark, sf_dir, "customer").join(nation, "c_nationkey", "left")
    title = F.concat(F.upper(F.substring("c_name", 1, 1)), F.lower(F.expr("substring(c_name, 2)")))
    balance = F.round(F.greatest(F.col("c_acctbal"), F.lit(0.0)) * 1000) / 1000
    return rows.select(
        F.col("c_custkey").alias("unit"), F.coalesce(F.nullif(F.col("c_mktsegment"), F.lit("BUILDING")), "n_name", F.lit("-")).alias("name"), title.alias("title"), F.rpad("c_mktsegment", 12, ".").alias("padded"),
        F.startswith("c_name", F.lit("Customer#00000000")).alias("early"), balance.alias("balance"), F.ceil("c_acctbal").cast("bigint").alias("up"),
    )


@_query("""SELECT c_custkey AS unit, count(DISTINCT o_orderkey) + count(DISTINCT event_type) + 1 AS surface FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN (SELECT DISTINCT user_id, event_type FROM events) ON user_id = c_custkey GROUP BY 1""")
def api_surface(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A10: a unit's public surface: the sum of the numbers of its parts of several kinds."""
    orders = read_table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("unit")).agg(F.countDistinct("o_orderkey").alias("inputs"))
    types = read_table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("unit")).agg(F.countDistinct("event_type").alias("outputs"))
    units = read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("unit"), F.lit(1).cast("bigint").alias("methods"))
    both = units.join(orders, "unit", "left").join(types, "unit", "left")
    return both.select("unit", (F.coalesce("inputs", F.lit(0)) + F.coalesce("outputs", F.lit(0)) + F.col("methods")).alias("surface"))


@_query("""SELECT o_orderpriority AS tier, count(*) AS legacy FROM orders WHERE extract(year FROM o_orderdate) <> CASE o_orderpriority WHEN '1-URGENT' THEN 1998 WHEN '5-LOW' THEN 1999 ELSE extract(year FROM o_orderdate) END GROUP BY 1""")
def legacy_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P30, SRC14: records whose version is not the one wanted for their tier; tiers without one are not checked."""
    wanted = spark.createDataFrame([("1-URGENT", 1998), ("5-LOW", 1999)], "tier string, version int")
    rows = read_table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("tier"), F.year("o_orderdate").alias("is"))
    return rows.join(wanted, "tier").filter(F.col("is") != F.col("version")).groupBy("tier").agg(_count().alias("legacy"))


def _kind(c: Column) -> Column:
    return F.when(c.rlike("^(click|view)$"), "platform").when(c.rlike("^(purchase|refund)$"), "library").otherwise("internal")


@_query("""SELECT CASE WHEN event_type IN ('click', 'view') THEN 'platform' WHEN event_type IN ('purchase', 'refund') THEN 'library' ELSE 'internal' END AS origin,
  bool_or(value > 99) AS risky, count(*) AS tokens FROM events GROUP BY 1""")
def token_origins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens by the first group of patterns that fits, else internal, and whether any is at risk."""
    return read_table(spark, sf_dir, "events").groupBy(_kind(F.col("event_type")).alias("origin")).agg(F.bool_or(F.col("value") > 99).alias("risky"), _count().alias("tokens"))
