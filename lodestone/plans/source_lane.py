"""Queries for source units, their tier documents and records, each with the SQL that must give the same rows.

The given tables hold no sources. Texts, paths and documents are made from their rows, by expressions that both engines
read alike; the SQL then states the result from the rows' numbers, without looking at the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.text import folded_path, relative_path
from lodestone.operators import diff, lookup, predicates, projections, query_verbs, rendering
from lodestone.plans.table_lane import dealt, read_table
from lodestone.sources import tier_files, units

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


_PATH = "concat('src/', p_brand, '/p', p_partkey, CASE p_partkey % 4 WHEN 0 THEN '.component.ts' WHEN 3 THEN '.guard.ts' ELSE '.ts' END)"
_TEXT = """concat('import { A } from "', CASE p_size % 4 WHEN 0 THEN '@angular/core' WHEN 1 THEN 'rxjs' WHEN 2 THEN './p' ELSE 'lib-x/deep' END, '";', chr(10), '// if (no) @Component', chr(10),
CASE p_partkey % 4 WHEN 0 THEN '@Component({ ' WHEN 1 THEN '@Directive({ ' WHEN 2 THEN '@NgModule({ ' ELSE '@Injectable({ ' END,
CASE p_partkey % 3 WHEN 0 THEN 'selector: "[p]", ' WHEN 1 THEN concat('selector: "app-', p_partkey, '", ') ELSE '' END,
CASE p_size % 3 WHEN 0 THEN concat(chr(10), 'template: "<p>', p_name, CASE WHEN p_size % 2 = 0 THEN ' | async' ELSE '' END, '</p>"') WHEN 1 THEN concat('templateUrl: "./', p_type, '.html"') ELSE 'standalone: true' END, ' })', chr(10),
'export class P', p_partkey, ' {', chr(10), repeat(concat('  if (a && b) { c("for (;;)"); }', chr(10)), CAST(p_partkey % 6 AS INT)),
'  routes = [{ path: "', p_type, '" }, { path: "x', p_size, '" }];', chr(10),
CASE p_partkey % 5 WHEN 0 THEN '  ngOnDestroy() { this.s.unsubscribe(); }' WHEN 1 THEN '  s = o.pipe(takeUntilDestroyed())' WHEN 2 THEN '  d = inject( DestroyRef )' ELSE '' END, chr(10), '}')"""


def _sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(F.expr(_PATH).alias("path"), F.expr(_TEXT).alias("text"))


#: Sources of many shapes: comments and other objects that look like decorators, helper classes, two units in one file.
_SHAPED_PATH = "concat('src/', p_brand, '/p', p_partkey, CASE p_partkey % 6 WHEN 0 THEN '.component.ts' WHEN 1 THEN '.guard.ts' WHEN 2 THEN '.interceptor.ts' WHEN 3 THEN '.resolver.ts' ELSE '.ts' END)"
_SHAPED_TEXT = """concat('// @Component({ selector: "no", template: "no" }) class No {}', chr(10),
CASE p_size % 2 WHEN 0 THEN concat('class Helper { selector = "h"; m() { return { selector: "x" }; } }', chr(10)) ELSE '' END,
CASE p_size % 3 WHEN 0 THEN concat('const o = { selector: "other", template: `t ${ a({ b: 1 }) } t` };', chr(10)) ELSE '' END,
CASE p_partkey % 5 WHEN 0 THEN '@Component' WHEN 1 THEN '@Directive' WHEN 2 THEN '@NgModule' WHEN 3 THEN '@Injectable' ELSE concat('@Other', chr(10), '@Pipe') END,
'({ /* template: "gone" */ providers: [{ selector: "deep" }], ', CASE p_size % 4 WHEN 0 THEN 'selector: "a" + "b", ' ELSE concat('selector: "app-', p_partkey, '", ') END,
CASE p_size % 5 WHEN 0 THEN concat('template: `<p>', p_name, '</p>`') WHEN 1 THEN concat('templateUrl: "../t/', p_type, '.html"') WHEN 2 THEN concat('templateUrl: "./x/.././', p_type, '.html"') WHEN 3 THEN concat(chr(10), 'template: "it', chr(39), 's ', chr(92), '"', p_size, chr(92), '""') ELSE 'template: start + "end"' END, ' })', chr(10),
'export abstract class P', p_partkey, ' { @Input() x = "}"; }', chr(10),
CASE p_partkey % 7 WHEN 0 THEN concat('@Component({ selector: "second", template: "second" })', chr(10), 'export class Second {}') ELSE '' END)"""


def _shaped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").select(F.expr(_SHAPED_PATH).alias("path"), F.expr(_SHAPED_TEXT).alias("text"))


_UNITS = f"""SELECT kind || ':' || path || ':P' || p_partkey AS unit_id, kind, 'P' || p_partkey AS class_name, selector, path
FROM (SELECT p_partkey, {_SHAPED_PATH} AS path, CASE p_partkey % 5 WHEN 0 THEN 'component' WHEN 1 THEN 'directive' WHEN 2 THEN 'module' WHEN 4 THEN 'pipe'
  ELSE CASE p_partkey % 6 WHEN 1 THEN 'guard' WHEN 2 THEN 'interceptor' WHEN 3 THEN 'route-resolver' ELSE 'service' END END AS kind,
CASE WHEN p_partkey % 5 < 2 AND p_size % 4 <> 0 THEN 'app-' || p_partkey END AS selector FROM part)"""


@_query(_UNITS)
def unit_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unit of each source: the kind of its decorator or file name, class and selector."""
    return units.units(_shaped(spark, sf_dir))


@_query(f"SELECT unit_id, selector, selector LIKE 'app-%' AS is_element FROM ({_UNITS}) WHERE selector IS NOT NULL")
def element_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Selectors, those of elements and those that are only reported."""
    return units.element_selectors(units.units(_shaped(spark, sf_dir))).select("unit_id", "selector", "is_element")


@_query(f"""SELECT {_PATH} AS path, module, kind AS "group", CASE WHEN kind = 'thirdParty' THEN 'lib-x' END AS package, module = './p' AS relative
FROM part JOIN (VALUES (0, '@angular/core', 'angular'), (1, 'rxjs', 'rxjs'), (2, './p', 'internal'), (3, 'lib-x/deep', 'thirdParty')) AS m(n, module, kind) ON p_size % 4 = n""")
def import_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Imports by group, with the package of third parties, and those that are relative."""
    return units.imports(_sources(spark, sf_dir)).drop("ord")


@_query(f"SELECT {_PATH} AS path, ord, CASE ord WHEN 0 THEN p_type ELSE 'x' || p_size END AS route FROM part, (VALUES (0), (1)) AS o(ord)")
def route_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes of each source."""
    return units.route_paths(_sources(spark, sf_dir))


_TEMPLATES = f"""SELECT {_SHAPED_PATH} AS path, p_brand, p_type, CASE WHEN p_partkey % 5 <> 0 THEN 'absent' WHEN p_size % 5 IN (0, 3) THEN 'inline' WHEN p_size % 5 = 4 THEN 'none' ELSE 'external' END AS kind,
CASE WHEN kind = 'inline' THEN CASE p_size % 5 WHEN 0 THEN '<p>' || p_name || '</p>' ELSE 'it''s "' || p_size || '"' END END AS template,
CASE WHEN kind = 'external' THEN CASE p_size % 5 WHEN 1 THEN '../t/' ELSE './x/.././' END || p_type || '.html' END AS url,
CASE WHEN kind = 'inline' THEN 1 + (p_size % 2 = 0)::INT + (p_size % 3 = 0)::INT + (p_size % 5 = 3)::INT END AS start_line,
CASE WHEN kind = 'external' THEN CASE p_size % 5 WHEN 1 THEN 't' ELSE p_brand END END AS folder FROM part"""


@_query(f"SELECT path, kind, template, url, start_line::BIGINT AS start_line FROM ({_TEMPLATES})")
def declared_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC03: what each component's decorator says of its template, with the first line of an inline one."""
    return units.declared_templates(_shaped(spark, sf_dir))


@_query(f"""SELECT path, CASE kind WHEN 'inline' THEN template WHEN 'external' THEN CASE WHEN folder LIKE '%2' THEN '' ELSE '<i>' || folder || p_type || '</i>' END ELSE '' END AS template,
CASE WHEN kind = 'external' AND folder LIKE '%2' THEN 'template-not-found' ELSE kind END AS status FROM ({_TEMPLATES})""")
def read_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC04, SRC05: templates as read from their files, also those of other folders; those that are missing are reported and empty."""
    parts = read_table(spark, sf_dir, "part")
    each = parts.select("p_type", F.explode(F.array("p_brand", F.lit("t"))).alias("folder")).filter("folder NOT LIKE '%2'").distinct()
    files = each.select(F.expr("concat('src/', folder, '/', p_type, '.html')").alias("path"), F.expr("concat('<i>', folder, p_type, '</i>')").alias("text"))
    return units.read_templates(units.declared_templates(_shaped(spark, sf_dir)), files)


_SUITES = """concat('import x from "it"; // it("no", f)', chr(10), 'describe("outer ', p_partkey, '", () => {', chr(10),
'  it("works ', p_size, '", () => { expect(comp.load).toBe(svc); /* save */ });', chr(10),
CASE p_partkey % 3 WHEN 0 THEN '  describe(`inner`, function () { it("deep", () => { HTTP_svc(); $save(); it("held", () => load()); }); describe("innermost", () => { it("last", () => { reload() }) }) });' WHEN 1 THEN '  x.describe("no", () => { it("direct", () => Svc) });' ELSE '' END, chr(10),
'  it(title, () => 0); it.skip("skipped", f); function it(a) {} });', chr(10), CASE p_size % 2 WHEN 0 THEN concat('it("top', chr(10), '", () => load(/', chr(92), ')"/, `${ save }`));') ELSE '' END)"""
_CASES = """SELECT p_partkey, 1 AS place, ['outer ' || p_partkey] AS suite, 'works ' || p_size AS title, ['field:save', 'method:load'] AS targets, ['dep:Svc'] AS mocks, 2 AS line FROM part
UNION ALL SELECT p_partkey, 2, ['outer ' || p_partkey, 'inner'], 'deep', ['field:save', 'method:load'], ['dep:http_svc'], 3 FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, 3, ['outer ' || p_partkey, 'inner', 'innermost'], 'last', [], [], 3 FROM part WHERE p_partkey % 3 = 0
UNION ALL SELECT p_partkey, 2, ['outer ' || p_partkey], 'direct', [], ['dep:Svc'], 3 FROM part WHERE p_partkey % 3 = 1
UNION ALL SELECT p_partkey, 9, [], 'top' || chr(10), ['field:save', 'method:load'], [], 5 FROM part WHERE p_size % 2 = 0"""


@_query(f"""SELECT p_partkey, 'test:' || row_number() OVER (PARTITION BY p_partkey ORDER BY place) AS id, array_to_string(suite, ' / ') AS suites, title,
array_to_string(targets, ' ') AS targets, array_to_string(mocks, ' ') AS mocks, line::BIGINT AS line FROM ({_CASES})""")
def test_suites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cases of each spec with their suites, and the members and dependencies that their texts name."""
    parts = read_table(spark, sf_dir, "part")
    specs = dealt(parts).select(F.col("p_partkey").cast("string").alias("path"), F.expr(_SUITES).alias("text"))
    named = lambda rows, *c: parts.select(F.col("p_partkey").cast("string").alias("path"), F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for v, n in zip(r, c, strict=True)]) for r in rows])))
    cases = units.test_cases(specs, named([("load", "method:load"), ("save", "field:save"), ("size", "field:size")], "name", "id"), named([("Svc",), ("http_svc",)], "name"))
    joined = lambda c, by: F.array_join(c, by).alias(c if c != "suite_path" else "suites")
    return cases.select(F.col("path").cast("bigint").alias("p_partkey"), "id", joined("suite_path", " / "), "title", joined("targets", " "), joined("mocks", " "), F.col("line").cast("bigint").alias("line"))


@_query("""WITH p AS (SELECT p_partkey, p_size % 4 AS up, p_size % 3 AS down, p_brand AS b, p_type AS t FROM part)
SELECT p_partkey, CASE up WHEN 0 THEN 'src/' || b || '/a/' || t WHEN 1 THEN 'src/' || b || '/' || t WHEN 2 THEN 'src/' || t ELSE t END AS folded,
CASE WHEN up = 3 THEN '../' || t WHEN up = 2 THEN t ELSE b || CASE WHEN up = 0 THEN '/a/' ELSE '/' END || t END AS from_src,
repeat('../', CASE WHEN up = 3 THEN down + 1 WHEN up = 2 THEN down ELSE greatest(down - 1, 0) END::INT) || CASE WHEN up < 2 AND down = 0 THEN b || '/' ELSE '' END || CASE WHEN up = 0 THEN 'a/' WHEN up = 3 THEN '' ELSE '' END || t AS from_deep FROM p""")
def folded_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR08: paths with their steps folded, as seen from a folder, and from there back."""
    up = "repeat('../', CAST(p_size % 4 AS INT))"
    path = F.expr(f"concat('./src//', p_brand, '/./a/', {up}, p_type)")
    deep = F.expr("concat('src', CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN concat('/', p_brand) ELSE concat('/', p_brand, '/z/../y') END)")
    rows = read_table(spark, sf_dir, "part")
    return rows.select("p_partkey", folded_path(path).alias("folded"), relative_path(F.lit("src"), path).alias("from_src"), relative_path(deep, path).alias("from_deep"))


@_query(f"""SELECT {_PATH} AS path, CASE WHEN p_partkey % 6 = 0 THEN 'jest' WHEN p_partkey % 6 = 2 THEN 'jasmine-karma' WHEN p_partkey % 6 = 4 THEN 'vitest' ELSE 'unknown' END AS framework FROM part""")
def spec_frameworks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC10, P20: the test framework that the spec beside each source names."""
    text = "CASE p_partkey % 6 WHEN 0 THEN 'jest.fn(); jasmine' WHEN 2 THEN 'vitest jasmine.any' ELSE 'import \"vitest\"' END"
    specs = read_table(spark, sf_dir, "part").filter("p_partkey % 2 = 0").select(F.regexp_replace(F.expr(_PATH), r"\.ts$", ".spec.ts").alias("path"), F.expr(text).alias("text"))
    return units.with_specs(_sources(spark, sf_dir), specs).select("path", predicates.test_framework(F.col("spec")).alias("framework"))


@_query(f"""SELECT path, cleanup, CASE cleanup WHEN 'ngOnDestroy-unsubscribe' THEN 'Subscription.unsubscribe' WHEN 'async-pipe-only' THEN 'async-pipe' ELSE cleanup END AS stream
FROM (SELECT {_PATH} AS path, CASE p_partkey % 5 WHEN 0 THEN 'ngOnDestroy-unsubscribe' WHEN 1 THEN 'takeUntilDestroyed' WHEN 2 THEN 'DestroyRef' ELSE CASE WHEN p_partkey % 4 = 0 AND p_size % 6 = 0 THEN 'async-pipe-only' ELSE 'none' END END AS cleanup FROM part)""")
def cleanup_strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each unit cleans up, and what that means for its streams."""
    sources = _sources(spark, sf_dir)
    both = sources.join(units.declared_templates(sources).select("path", "template"), "path")
    found = both.select("path", predicates.cleanup_strategy(F.contains("text", F.lit("ngOnDestroy")), F.col("text"), F.col("template")).alias("cleanup"))
    return found.withColumn("stream", predicates.stream_strategy(F.col("cleanup")))


@_query(f"SELECT {_PATH} AS path, 1 + 2 * (p_partkey % 6) AS complexity FROM part")
def complexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches of each source, outside comments and literals."""
    return _sources(spark, sf_dir).select("path", predicates.complexity(F.col("text")).alias("complexity"))


_MANIFEST = """CASE CAST(substr(p_brand, -1) AS INT) WHEN 1 THEN '{"dependencies":{"@angular/compiler":"no","@angular/core":"one"},"devDependencies":{"@angular/core":"no"}}'
WHEN 2 THEN '{"devDependencies":{"@angular/core":"two","@angular/compiler":"no"},"dependencies":{"other":"1","@angular/compiler":"no"}}' WHEN 3 THEN '{"devDependencies":{"@angular/compiler":"no"},"dependencies":{"@angular/compiler":"three"}}'
WHEN 4 THEN '{"dependencies":{},"devDependencies":{"@angular/compiler":"four"}}' ELSE '{oops' END"""


@_query("""SELECT p_partkey, CASE substr(p_brand, -1) WHEN '1' THEN 'one' WHEN '2' THEN 'two' WHEN '3' THEN 'three' WHEN '4' THEN 'four' ELSE 'root' END AS version FROM part""")
def nearest_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC09: the version that the nearest manifest above declares, by the first of four entries; broken ones and those without are passed over."""
    parts = read_table(spark, sf_dir, "part")
    own = parts.select(F.expr("concat('src/', p_brand, '/package.json')").alias("path"), F.expr(_MANIFEST).alias("text")).distinct()
    root = spark.createDataFrame([("src/package.json", '{"dependencies":{"@angular/core":"root"}}'), ("package.json", "{}")], "path string, text string")
    return lookup.nearest_versions(parts.select("p_partkey", F.expr(_PATH).alias("path")), "p_partkey", "path", own.unionByName(root))


# ---- calls ---------------------------------------------------------------------------------------------------

_CALLS = """SELECT user_id AS unit, event_id % 7 AS site, event_id AS ord, CASE event_type WHEN 'click' THEN 'http' WHEN 'view' THEN 'router' WHEN 'purchase' THEN 'route' ELSE 'store' END AS owner,
CASE event_id % 4 WHEN 0 THEN 'get' WHEN 1 THEN 'navigate' WHEN 2 THEN 'post' ELSE 'queryParams' END AS member, props AS argument FROM events"""
_TOKENS = "SELECT c_custkey AS unit, property, CASE WHEN c_custkey % 5 = 0 THEN 'Helper' ELSE token END AS token FROM customer, (VALUES ('http', 'HttpClient'), ('router', 'Router'), ('route', 'ActivatedRoute')) AS t(property, token)"


def _calls(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Calls from events, and the dependencies of each customer; a fifth of these has other tokens."""
    events = read_table(spark, sf_dir, "events")
    owner = F.when(F.col("event_type") == "click", "http").when(F.col("event_type") == "view", "router").when(F.col("event_type") == "purchase", "route").otherwise("store")
    member = F.element_at(F.array(*[F.lit(m) for m in ("get", "navigate", "post", "queryParams")]), (F.col("event_id") % 4 + 1).cast("int"))
    calls = events.select(F.col("user_id").alias("unit"), (F.col("event_id") % 7).alias("site"), F.col("event_id").alias("ord"), owner.alias("owner"), member.alias("member"), F.col("props").alias("argument"))
    declared = [("http", "HttpClient"), ("router", "Router"), ("route", "ActivatedRoute")]
    pairs = F.inline(F.array(*[F.struct(F.lit(p).alias("property"), F.when(F.col("c_custkey") % 5 == 0, "Helper").otherwise(t).alias("token")) for p, t in declared]))
    return calls, read_table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("unit"), pairs)


@_query(f"""SELECT c.unit, 'http:' || row_number() OVER (PARTITION BY c.unit ORDER BY ord) AS id, upper(member) AS method, argument AS url, site
FROM ({_CALLS}) c JOIN ({_TOKENS}) d ON c.unit = d.unit AND owner = property WHERE token = 'HttpClient' AND member IN ('get', 'post')""")
def http_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests on an injected client, numbered in each unit."""
    return predicates.http_calls(*_calls(spark, sf_dir))


@_query(f"""SELECT c.unit, 'nav:' || row_number() OVER (PARTITION BY c.unit ORDER BY ord) AS id, 'router.' || member AS api, argument AS target, site
FROM ({_CALLS}) c JOIN ({_TOKENS}) d ON c.unit = d.unit AND owner = property WHERE token = 'Router' AND member = 'navigate'""")
def navigations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Navigations by an injected router, numbered in each unit."""
    return predicates.navigations(*_calls(spark, sf_dir))


@_query(f"""SELECT c.unit, member AS kind, site, min(ord) AS ord FROM ({_CALLS}) c JOIN ({_TOKENS}) d ON c.unit = d.unit AND owner = property
WHERE token = 'ActivatedRoute' AND member = 'queryParams' GROUP BY ALL""")
def route_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What sites read of the route, once for each kind."""
    return predicates.route_reads(*_calls(spark, sf_dir))


@_query("""WITH s AS (SELECT user_id AS unit, event_id % 3 AS site, event_id AS ord, event_type, event_id % 5 AS k, event_type IN ('click', 'view') AS call FROM events),
d AS (SELECT unit, site, string_agg(api, ',' ORDER BY ord) AS dom FROM (SELECT unit, site, 'document.' || event_type AS api, min(ord) AS ord FROM s WHERE call AND k = 0 GROUP BY ALL) GROUP BY ALL)
SELECT unit, site, bool_or(call AND k = 0) AS touches_dom, bool_or(call AND k = 1) AS uses_storage, bool_or(call AND k = 2) AS uses_timers, bool_or(call AND k = 3) AS subscribes, bool_or(call AND k = 4) AS navigates,
bool_or(event_type = 'purchase') AS mutates_injected, bool_or(event_type = 'error') AS throws, bool_or(event_type = 'signup') AS has_try, coalesce(any_value(dom), '') AS dom_apis FROM s LEFT JOIN d USING (unit, site) GROUP BY ALL""")
def side_effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each site does beyond its unit, from the shapes of its calls."""
    pick = lambda *v: F.element_at(F.array(*[F.lit(x) if isinstance(x, str) else x for x in v]), (F.col("event_id") % 5 + 1).cast("int"))
    form = F.when(F.col("event_type") == "error", "throw").when(F.col("event_type") == "signup", "try").when(F.col("event_type") == "purchase", "assign").otherwise("call")
    kind = F.col("event_type")
    steps = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("unit"), (F.col("event_id") % 3).alias("site"), F.col("event_id").alias("ord"), form.alias("form"),
        pick("document", "localStorage", "setTimeout", "stream", "router").alias("root"),
        pick(F.concat(F.lit("document."), kind), "localStorage.getItem", "setTimeout", "stream.subscribe", "router.navigate").alias("callee"),
        pick(kind, "getItem", F.lit(None).cast("string"), "subscribe", "navigate").alias("member"),
    )
    found = predicates.side_effects(steps)
    return found.withColumn("dom_apis", F.array_join("dom_apis", ","))


@_query("""WITH s AS (SELECT l_orderkey, l_linestatus = 'F' AS own, CASE l_returnflag WHEN 'A' THEN 'ngOnDestroy-unsubscribe' WHEN 'R' THEN 'DestroyRef' ELSE 'async-pipe-only' END AS cleanup FROM lineitem),
t AS (SELECT l_orderkey, CASE WHEN own THEN 'takeUntilDestroyed' WHEN cleanup = 'ngOnDestroy-unsubscribe' THEN 'Subscription.unsubscribe' WHEN cleanup = 'DestroyRef' THEN 'DestroyRef' ELSE 'none' END AS strategy FROM s)
SELECT l_orderkey AS unit, strategy, CASE strategy WHEN 'none' THEN 'possible' ELSE 'none' END AS leak, count(*) AS n FROM t GROUP BY ALL""")
def subscription_strategies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How subscriptions end, and which may leak."""
    operators = F.array(F.lit("map"), F.when(F.col("l_linestatus") == "F", "takeUntilDestroyed").otherwise("filter"))
    cleanup = F.when(F.col("l_returnflag") == "A", "ngOnDestroy-unsubscribe").when(F.col("l_returnflag") == "R", "DestroyRef").otherwise("async-pipe-only")
    found = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("unit"), predicates.subscription_strategy(operators, cleanup).alias("strategy"))
    return found.groupBy("unit", "strategy", predicates.leak_risk(F.col("strategy")).alias("leak")).agg(F.count(F.lit(1)).alias("n"))


@_query("""SELECT l_orderkey AS unit, CASE WHEN r > 0 AND a > 0 THEN 'mixed' WHEN r > 0 THEN 'reactive' WHEN a > 0 THEN 'template-driven' ELSE 'none' END AS approach
FROM (SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS r, count(*) FILTER (WHERE l_returnflag = 'A') AS a FROM lineitem GROUP BY 1)""")
def form_approaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The approach of each unit's forms, by its groups and its bindings."""
    counted = read_table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("unit")).agg(F.count_if(F.col("l_returnflag") == "R").alias("groups"), F.count_if(F.col("l_returnflag") == "A").alias("bound"))
    return counted.select("unit", predicates.form_approach(F.col("groups"), F.col("bound")).alias("approach"))


@_query("""SELECT l_orderkey AS unit, ['array', 'control', 'group', 'control', 'record'][l_linenumber % 5 + 1] AS kind, count(*) AS n FROM lineitem GROUP BY ALL""")
def control_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of controls that initializers make."""
    made = F.array(*[F.lit(x) for x in ("new FormArray([])", "['', Validators.required]", "this.fb.group({})", "[new FormControl(1)]", "fb.nonNullable.record({ a: fb.control(2) })")])
    rows = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("unit"), F.element_at(made, F.col("l_linenumber") % 5 + 1).alias("made"))
    return rows.groupBy("unit", predicates.control_kind(F.col("made")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@_query("""SELECT DISTINCT user_id AS unit, event_type AS name FROM events WHERE event_type <> 'signup' AND value > 50""")
def public_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Methods that are public and no lifecycle hooks."""
    name = F.when(F.col("event_type") == "signup", "ngOnInit").otherwise(F.col("event_type"))
    methods = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("unit"), name.alias("name"), F.when(F.col("value") > 50, "public").otherwise("private").alias("visibility"))
    return predicates.public_methods(methods).select("unit", "name").distinct()


@_query("""SELECT user_id AS unit, CASE event_type WHEN 'error' THEN 'error' WHEN 'click' THEN 'warning' WHEN 'view' THEN 'warning' ELSE 'info' END AS severity, count(*) AS n FROM events GROUP BY ALL""")
def warning_severities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings with the severity of their code; an unknown code fails the query."""
    codes = spark.createDataFrame([("error", "error"), ("click", "warning"), ("view", "warning"), ("signup", "info"), ("purchase", "info")], "code string, severity string")
    warnings = read_table(spark, sf_dir, "events").select(F.col("user_id").alias("unit"), F.col("event_type").alias("code"))
    return predicates.with_severity(warnings, codes).groupBy("unit", "severity").agg(F.count(F.lit(1)).alias("n"))


@_query("SELECT l_orderkey AS unit, sum(length(p_name) - length(replace(p_name, 'e', ''))) :: BIGINT AS requests FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1")
def service_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a scan of each service finds, scanned once however many units use it."""
    parts = read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("service"), "p_name")
    scan = lambda keys: parts.join(keys, "service", "left_semi").select("service", F.regexp_count("p_name", F.lit("e")).alias("found"))
    edges = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("unit"), F.col("l_partkey").alias("service"))
    return predicates.scanned_once(edges, "service", scan).groupBy("unit").agg(F.sum("found").cast("bigint").alias("requests"))


# ---- tier documents and records ------------------------------------------------------------------------------

_TIER = "CASE o_orderkey % 6 WHEN 0 THEN 'signature' WHEN 1 THEN 'dependencies' WHEN 2 THEN 'functions' WHEN 3 THEN 'template' WHEN 4 THEN 'index' ELSE 'notes' END"
_FILE = f"concat('units/u', o_custkey, '/', CASE WHEN o_orderkey % 2 = 0 THEN 'expected.' ELSE '' END, {_TIER}, '.json')"
_DOCUMENT = """CASE WHEN o_orderkey % 11 = 0 THEN '{"schemaVersion"' ELSE concat('{"schemaVersion": "0.', o_orderkey % 5, '.0", "unit": {"id": ', o_custkey, '}}') END"""


def _tier_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tier_files.tiers_of(read_table(spark, sf_dir, "orders").select(F.expr(_FILE).alias("path"), F.expr(_DOCUMENT).alias("text")))


@_query(f"""SELECT 'units/u' || o_custkey AS unit, {_TIER} AS tier, CASE WHEN o_orderkey % 6 = 4 THEN 'skipped' WHEN o_orderkey % 11 = 0 THEN 'broken' WHEN o_orderkey % 6 IN (0, 1) AND o_orderkey % 5 <> 4 THEN 'legacy' ELSE 'ok' END AS outcome, count(*) AS n
FROM orders WHERE o_orderkey % 6 <> 5 GROUP BY ALL""")
def tier_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC12, SRC13, SRC14, P30: tier documents by the tier of their names, held against the versions of their schemas."""
    pinned = '{"properties": {"schemaVersion": {"const": "0.4.0"}}}'
    schemas = spark.createDataFrame([(f"schema/{t}.schema.json", pinned if t in ("signature", "dependencies") else '{"properties": {}}') for t in tier_files.TIERS], "path string, text string")
    checked = tier_files.checked_versions(_tier_files(spark, sf_dir), tier_files.schema_versions(schemas))
    return checked.groupBy("unit", "tier", "outcome").agg(F.count(F.lit(1)).alias("n"))


@_query(f"""SELECT 'units/u' || c_custkey AS unit, coalesce(string_agg(DISTINCT tier, ',' ORDER BY tier), '') AS found, CASE WHEN count(tier) = 0 THEN 'missing' ELSE 'ok' END AS status
FROM customer LEFT JOIN (SELECT o_custkey, {_TIER} AS tier FROM orders WHERE o_orderkey % 6 <> 5 AND o_orderkey % 11 <> 0) ON o_custkey = c_custkey GROUP BY c_custkey""")
def loaded_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC11: the tiers that could be loaded for each unit; a unit without any is missing."""
    asked = read_table(spark, sf_dir, "customer").select(F.expr("concat('units/u', c_custkey)").alias("unit"))
    return tier_files.loaded_units(asked, _tier_files(spark, sf_dir)).withColumn("found", F.array_join("found", ","))


@_query("""SELECT '{"unit_id":"c' || c_custkey || '","dependsOn":[' || coalesce(string_agg(DISTINCT '"n' || o_orderkey % 7 || '"', ','  ORDER BY '"n' || o_orderkey % 7 || '"') FILTER (WHERE o_orderkey IS NOT NULL), '') || ']}' AS value FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def index_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK02: the index as a JSON line for each unit with what it depends on."""
    found = read_table(spark, sf_dir, "customer").select(F.expr("concat('c', c_custkey)").alias("unit_id"))
    edges = read_table(spark, sf_dir, "orders").select(F.expr("concat('c', o_custkey)").alias("from"), F.expr("concat('n', o_orderkey % 7)").alias("to"))
    return tier_files.index_lines(found, edges)


@_query("SELECT user_id AS unit, sha256(string_agg('f' || event_id || '=' || sha256(event_type), chr(10) ORDER BY 'f' || event_id)) AS hash FROM events GROUP BY 1")
def input_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A hash of each unit's files in the order of their paths."""
    return tier_files.inputs_hash(read_table(spark, sf_dir, "events").select(F.col("user_id").alias("unit"), F.expr("concat('f', event_id)").alias("path"), F.col("event_type").alias("text")))


_NAMES = {"1-URGENT": "signature.json", "2-HIGH": "dependencies.json", "3-MEDIUM": "functions.json", "4-NOT SPECIFIED": "template.json", "5-LOW": "analysis.json"}


@_query("""WITH f AS (SELECT o_custkey AS unit, count(DISTINCT o_orderpriority) FILTER (WHERE o_orderpriority <> '5-LOW') AS always, bool_or(o_orderpriority = '5-LOW') AND bool_or(o_orderstatus = 'P') AS more FROM orders GROUP BY 1)
SELECT c_custkey AS unit, c_mktsegment AS hash, CASE WHEN c_custkey % 2 = 0 THEN 'trivial' ELSE 'standard' END AS tier FROM customer JOIN f ON unit = c_custkey WHERE always = 4 AND (c_custkey % 2 = 0 OR more) AND c_custkey % 3 <> 0""")
def valid_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I01, SNK08: units whose record has the hash of today and whose required files are all there."""
    customers, orders = read_table(spark, sf_dir, "customer"), read_table(spark, sf_dir, "orders")
    now = customers.select(F.col("c_custkey").alias("unit"), F.col("c_mktsegment").alias("hash"))
    old = F.when(F.col("c_custkey") % 3 == 0, "old").otherwise(F.col("c_mktsegment"))
    cached = tier_files.cache_records(customers.select(F.col("c_custkey").alias("unit"), old.alias("hash"), F.when(F.col("c_custkey") % 2 == 0, "trivial").otherwise("standard").alias("tier")))
    name = F.element_at(F.create_map(*[F.lit(x) for pair in _NAMES.items() for x in pair]), F.col("o_orderpriority"))
    files = orders.select(F.col("o_custkey").alias("unit"), F.explode(F.array(name, F.when(F.col("o_orderstatus") == "P", "requirement.md"))).alias("name"))
    return tier_files.still_valid(now, cached, files)


_METHODS = """concat('["z', p_size, '","a"]')"""
_SIGNATURE = f"""concat('{{"publicApi":{{"inputs":[{{"name":"', p_type, '","required":', CASE WHEN p_size % 2 = 0 THEN 'true' ELSE 'false' END, '}}],"publicMethods":', {_METHODS}, '}}}}')"""
_TEMPLATE = """concat('{"ast":{"controlFlow":[{"construct":"', CASE WHEN p_partkey % 2 = 0 THEN '@if' ELSE '*ngIf' END, '"},{"construct":"@for","trackBy":', CASE WHEN p_size % 3 = 0 THEN '"id"' ELSE 'null' END, '},{"construct":"@empty"}]}}')"""
_DEPENDENCIES = """concat('{"callGraph":{"calls":{"a":["b","z', p_size, '","b"],"c":null}}}')"""
_FUNCTIONS = """concat('{"symbols":{"a":{"ast":{"subscriptions":[{"unsubscribeStrategy":"', CASE WHEN p_size % 2 = 0 THEN 'none' ELSE 'DestroyRef' END, '"},{}]}},"b":{"ast":{}}},"forms":{"approach":"reactive","groups":[{"controls":[{"path":"p","syncValidators":["min","max"],"disabledExpression":', CASE WHEN p_size % 4 = 0 THEN '"x"' ELSE '""' END, '}]},{}]}}')"""


def _projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views of tier documents made from parts; every fifth part has no template tier, every seventh a broken one."""
    documents = F.inline(F.array(*[F.struct(F.lit(t).alias("tier"), F.expr(sql).alias("text")) for t, sql in (("signature", _SIGNATURE), ("dependencies", _DEPENDENCIES), ("template", f"CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 7 = 0 THEN '[' ELSE {_TEMPLATE} END"), ("functions", _FUNCTIONS))]))
    return projections.projections(read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("unit"), documents))


_ITEMS = """SELECT p_partkey AS unit, 'inputs' AS name, 'name=' || p_type || ' required=' || (p_size % 2 = 0) || ' alias=-' AS item, 1 AS n FROM part
UNION ALL SELECT p_partkey, 'publicMethods', 'name=' || unnest(['z' || p_size, 'a']), 1 FROM part
UNION ALL SELECT p_partkey, 'callEdges', 'from=a to=' || unnest(['b', 'z' || p_size]), unnest([2, 1]) FROM part
UNION ALL SELECT p_partkey, 'formApproach', 'approach=reactive', 1 FROM part
UNION ALL SELECT p_partkey, 'leakRisk', 'unsubscribeStrategy=false', CASE WHEN p_size % 2 = 0 THEN 2 ELSE 1 END FROM part
UNION ALL SELECT p_partkey, 'leakRisk', 'unsubscribeStrategy=true', 1 FROM part WHERE p_size % 2 = 1
UNION ALL SELECT p_partkey, 'formConstraints', 'path=p disabledExpression=' || (p_size % 4 = 0) || ' syncValidators=max,min', 1 FROM part
UNION ALL SELECT p_partkey, unnest(['controlFlowPrimary', 'controlFlowPrimary', 'controlFlowBranches', 'loopTracking']), unnest(['class=conditional', 'class=loop', 'class=empty', 'class=loop trackBy=' || (p_size % 3 = 0)]), 1 FROM part WHERE p_partkey % 5 <> 0 AND p_partkey % 7 <> 0"""


@_query(f"SELECT unit, name, item, n::BIGINT AS n FROM ({_ITEMS})")
def semantic_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The items of each unit's documents in views that do not depend on how it is written, with their numbers."""
    said = F.array_join(F.transform(F.map_entries("item"), lambda e: F.concat_ws("=", e["key"], e["value"])), " ")
    return _projected(spark, sf_dir).select("unit", "name", said.alias("item"), "n")


_VALUES = f"SELECT p.p_partkey AS unit, v.name, (SELECT string_agg(item || n, '|' ORDER BY item) FROM ({_ITEMS}) i WHERE i.unit = p.p_partkey AND i.name = v.name) AS value FROM part p, (SELECT unnest({list(projections.VIEWS)!r}) AS name) v"


@_query(f"""WITH v AS ({_VALUES}) SELECT l.unit AS "left", name, l.value IS NOT DISTINCT FROM r.value AS same FROM v l JOIN v r USING (name) WHERE l.unit % 2 = 0 AND r.unit = l.unit + 1 AND NOT (name = 'inputs' AND l.unit % 4 = 0)""")
def projected_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of units by their views, but for what a pair is declared to differ in."""
    found = projections.view_values(_projected(spark, sf_dir), read_table(spark, sf_dir, "part").select(F.col("p_partkey").alias("unit")))
    even = read_table(spark, sf_dir, "part").filter("p_partkey % 2 = 0").select(F.col("p_partkey").alias("left"), (F.col("p_partkey") + 1).alias("right"))
    return diff.pair_equivalence(found, even, even.filter("left % 4 = 0").withColumn("name", F.lit("inputs"))).drop("right")


# ---- documents, verbs, times ---------------------------------------------------------------------------------

_SECTION = {"A": "inputs", "N": "risks", "R": "questions"}
_BODY = """coalesce(string_agg('- p' || l_partkey, chr(10) ORDER BY CASE l_linenumber WHEN 1 THEN 0 ELSE l_linenumber END, 'p' || l_partkey) FILTER (WHERE l_returnflag = '{flag}'), '_None._')"""
_PARTS = [
    f"""'## {heading}' || chr(10) || '<!-- begin section={name} hash=' || substr(sha256({body}), 1, 8) || ' -->' || chr(10) || {body} || chr(10) || '<!-- end section -->'"""
    for name, heading in rendering.SECTIONS
    for body in [next((_BODY.format(flag=f) for f, s in _SECTION.items() if s == name), "'_None._'")]
]


@_query(f"SELECT l_orderkey AS unit, {' || chr(10) || chr(10) || '.join(_PARTS)} AS document FROM lineitem GROUP BY 1")
def rendered_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK04, D01: each unit's document, its sections in order and fenced."""
    section = F.element_at(F.create_map(*[F.lit(x) for pair in _SECTION.items() for x in pair]), F.col("l_returnflag"))
    items = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("unit"), section.alias("section"), F.nullif(F.col("l_linenumber"), F.lit(1)).alias("ord"), F.expr("concat('p', l_partkey)").alias("line"))
    return rendering.documents(rendering.section_bodies(items))


_SHAPED_BODY = """WITH l AS (SELECT *, 'p' || l_partkey AS p, l_quantity::BIGINT AS q FROM lineitem)
SELECT l_orderkey AS unit, 'services' AS section, '| Service | Members | Called from |' || chr(10) || '|-|-|-|' || chr(10) || string_agg('| ' || p || ' | a\\|b |  |', chr(10) ORDER BY l_linenumber, p) AS body FROM l WHERE l_returnflag = 'R' GROUP BY 1
UNION ALL SELECT l_orderkey, 'behaviour', '### Methods' || chr(10) || string_agg('- **' || p || '** q' || q || '; last' || CASE WHEN q % 2 = 0 THEN chr(10) || '  - Pre: x' || chr(10) || '  - Post: ' || q ELSE '' END, chr(10) ORDER BY l_linenumber, p, 'q' || q) FROM l WHERE l_returnflag = 'A' GROUP BY 1
UNION ALL SELECT l_orderkey, 'migration', 'Effort ' || min(l_linenumber) || CASE WHEN bool_or(q > 25) THEN chr(10) || chr(10) || '### Steps' || chr(10) || string_agg(n || '. ' || p, chr(10) ORDER BY n) FILTER (q > 25) ELSE '' END
FROM (SELECT *, count(*) FILTER (q > 25) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, p, l_quantity, l_extendedprice ROWS UNBOUNDED PRECEDING) AS n FROM l WHERE l_returnflag = 'N') GROUP BY 1"""


@_query(_SHAPED_BODY)
def shaped_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections of different shapes: tables, nested and numbered lists, texts."""
    rows = read_table(spark, sf_dir, "lineitem").withColumns({"unit": F.col("l_orderkey"), "p": F.expr("concat('p', l_partkey)"), "q": F.col("l_quantity").cast("bigint").cast("string")})
    none = F.lit(None).cast("string")
    part = lambda where, section, name, ord_, cells, below=None: rows.filter(where).select("unit", F.lit(section).alias("section"), F.lit(name).alias("part"), ord_.cast("int").alias("ord"), cells.alias("cells"), (F.lit(None) if below is None else below).cast("array<string>").alias("below"))
    place = F.col("l_linenumber")
    items = part("l_returnflag = 'R'", "services", "calls", place, F.array("p", F.lit("a|b"), none))
    below = F.when(F.col("q") % 2 == 0, F.array(F.lit("Pre: x"), F.concat(F.lit("Post: "), "q")))
    items = items.unionByName(part("l_returnflag = 'A'", "behaviour", "methods", place, F.array(F.col("p"), F.concat(F.lit("q"), "q"), none, F.lit("last")), below))
    effort = rows.filter("l_returnflag = 'N'").groupBy("unit").agg(F.min("l_linenumber").alias("n")).select("unit", F.lit("migration").alias("section"), F.lit("effort").alias("part"), F.lit(1).alias("ord"), F.array(F.lit("Effort"), F.col("n").cast("string")).alias("cells"), F.lit(None).cast("array<string>").alias("below"))
    steps = part("l_returnflag = 'N' AND CAST(q AS BIGINT) > 25", "migration", "steps", place, F.array("p"))
    return rendering.shaped_bodies(items.unionByName(effort).unionByName(steps).unionByName(part("l_returnflag = 'N'", "nowhere", "x", place, F.array("p"))))


@_query("""SELECT p_partkey, '# ' || p_name || chr(10) || lower(p_type) || ' in src/' || p_brand || CASE WHEN p_size > 9 THEN chr(10) || '- size: ' || p_size ELSE '' END || chr(10) || '- brand: ' || p_brand AS page FROM part""")
def trivial_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK05: the short page of each trivial unit; facts that are not there have no line."""
    facts = {"size": F.when(F.col("p_size") > 9, F.col("p_size")), "brand": F.col("p_brand")}
    return read_table(spark, sf_dir, "part").select("p_partkey", rendering.trivial_page(F.col("p_name"), F.lower("p_type"), F.expr("concat('src/', p_brand)"), facts).alias("page"))


@_query("""SELECT o_orderkey AS unit, CASE WHEN n > 0 THEN round((n - coalesce(r, 0)) / n, 3) END AS returned, CASE WHEN n > 0 THEN round((n - coalesce(a, 0)) / n, 3) END AS accepted FROM orders LEFT JOIN
(SELECT l_orderkey, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') AS r, count(*) FILTER (WHERE l_returnflag = 'A') AS a FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def unit_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK06: one row of scores for each unit: the shares of its parts that are not missing."""
    lines = read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("unit"), F.when(F.col("l_returnflag") == "R", "returned").when(F.col("l_returnflag") == "A", "accepted").alias("kind"))
    due = lines.groupBy("unit").agg(F.count(F.lit(1)).alias("n"))
    found = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("unit")).join(due, "unit", "left")
    return rendering.scores(found, lines.filter("kind IS NOT NULL"), {"returned": "n", "accepted": "n"})


@_query("SELECT user_id AS unit, event_id % 7 AS \"from\", event_type AS id, min(event_id) AS ord FROM events GROUP BY ALL")
def verb_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verb calls: what every site calls, with the place of its first call."""
    return query_verbs.all_callees(read_table(spark, sf_dir, "events").select(F.col("user_id").alias("unit"), (F.col("event_id") % 7).alias("from"), F.col("event_type").alias("to"), F.col("event_id").alias("ord")))


@_query("SELECT l_orderkey AS unit, l_suppkey AS site, l_partkey AS field, CASE WHEN l_returnflag = 'R' THEN 'write' ELSE 'read' END AS mode, count(*) AS places FROM lineitem GROUP BY ALL")
def verb_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verb reads: the fields that every site reads and writes."""
    mode = F.when(F.col("l_returnflag") == "R", "write").otherwise("read")
    return query_verbs.all_accesses(read_table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("unit"), F.col("l_suppkey").alias("site"), F.col("l_partkey").alias("field"), mode.alias("mode")))


@_query("SELECT user_id AS unit, 'n' || event_id % 50 AS id, CASE WHEN bool_or(event_type = 'view') THEN 'elements' WHEN bool_or(event_type = 'click') THEN 'events' ELSE 'refs' END AS bucket FROM events GROUP BY ALL")
def verb_node(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verb node: every template node with the first bucket that has it."""
    bucket = F.when(F.col("event_type") == "view", F.struct(F.lit("elements").alias("bucket"), F.lit(0).alias("bucket_ord"))).when(F.col("event_type") == "click", F.struct(F.lit("events").alias("bucket"), F.lit(1).alias("bucket_ord"))).otherwise(F.struct(F.lit("refs").alias("bucket"), F.lit(2).alias("bucket_ord")))
    return query_verbs.all_nodes(read_table(spark, sf_dir, "events").select(F.col("user_id").alias("unit"), F.expr("concat('n', event_id % 50)").alias("id"), bucket.alias("b")).select("unit", "id", "b.*"))


@_query("SELECT user_id AS unit, strftime(min(ts), '%Y-%m-%dT%H:%M:%S.%gZ') AS began, (epoch_us(max(ts)) - epoch_us(min(ts))) // 1000 AS elapsed_ms FROM events GROUP BY 1")
def elapsed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DAT01, SNK09: when each unit's run began, as text, and the milliseconds that it took."""
    found = read_table(spark, sf_dir, "events").groupBy(F.col("user_id").alias("unit")).agg(F.min("ts").alias("began"), F.max("ts").alias("ended"))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return found.select("unit", F.date_format("began", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("began"), F.floor((micros("ended") - micros("began")) / 1000).alias("elapsed_ms"))
