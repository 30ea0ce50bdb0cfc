"""Queries on forms, injected tokens, titles, versions of documents, pairs of a manifest and runs, each with its SQL."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions.json_paths import flattened
from lodestone.operators import audit, diff, predicates, projections, query_verbs
from lodestone.plans.table_lane import dealt, read_table
from lodestone.sources import forms, tier_files, units
from lodestone.tables import shared_folder

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(oracle: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = oracle
        return f

    return add


def _made(spark: SparkSession, sf_dir: str, text: str, deal=lambda parts: parts) -> DataFrame:
    """A source for each part: path (its key) and text, by an expression that DuckDB reads alike."""
    return deal(read_table(spark, sf_dir, "part")).select(F.col("p_partkey").cast("string").alias("path"), F.expr(text).alias("text"))


# ---- forms ---------------------------------------------------------------------------------------------------

_FORM = """concat('class P { x = 1; other = this.fb.control("a");', chr(10),
CASE p_size % 4 WHEN 0 THEN 'private readonly form: FormGroup<{ a: string }> = this.fb.nonNullable.group(' WHEN 1 THEN '  form = new FormGroup(' WHEN 2 THEN '  form = new FormGroup<Typed>(' ELSE '  form!: any; y = () => { this.fb.group({ no: 1 }); }; form2 = build(' END,
'{ name: ["', p_name, '", [Validators.required, Validators.max(f(', p_size, ', 2))]], plain: 0,',
CASE p_partkey % 3 WHEN 0 THEN ' list: this.fb.array([this.fb.control("", Validators.min(1))]),' WHEN 1 THEN ' list: new FormArray([new FormControl(1)]),' ELSE '' END,
' "off": [{ value: "v", disabled: a || b(1, 2) }, Validators.email], nested: { deep: Validators.url, inner: { disabled: true } } }, { updateOn: "blur" });', chr(10),
'  after = { z: Validators.no }; }')"""


@_query("""SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'FormBuilder' ELSE 'new FormGroup' END AS built_with, 'form' AS name FROM part WHERE p_size % 4 <> 3""")
def form_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The forms that classes make, and by what."""
    return forms.form_groups(_made(spark, sf_dir, _FORM, dealt)).select(F.col("path").cast("bigint").alias("p_partkey"), "built_with", "name")


@_query("""SELECT p_partkey, 'control:form.' || name AS id, kind, validators, disabled FROM part,
(VALUES ('name', 'control', 'required max', NULL, 9), ('plain', 'control', '', NULL, 9), ('list', 'array', 'min', NULL, 0), ('list', 'array', '', NULL, 1), ('off', 'control', 'email', 'a || b(1, 2)', 9), ('nested', 'control', 'url', NULL, 9)) AS c(name, kind, validators, disabled, rest)
WHERE p_size % 4 <> 3 AND (rest = 9 OR rest = p_partkey % 3)""")
def form_controls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The controls of each form, with kinds, validators in order and conditions."""
    found = forms.form_controls(_made(spark, sf_dir, _FORM, dealt))
    return found.select(F.col("path").cast("bigint").alias("p_partkey"), "id", "kind", F.array_join("validators", " ").alias("validators"), "disabled")


# ---- tokens, titles, api -------------------------------------------------------------------------------------

_TOKENS = ("HttpClient", "HttpClientX", "Router", "MyRouter", "FormBuilder", "ElementRef", "httpClient", "DestroyRef")


@_query(f"""SELECT token, count(*) AS places, CASE WHEN token IN ('HttpClient', 'Router', 'FormBuilder', 'ElementRef', 'DestroyRef') THEN 'angular' WHEN token IS NOT NULL THEN 'internal' END AS origin
FROM (SELECT CASE WHEN event_id % 9 < 8 THEN {list(_TOKENS)!r}[event_id % 9 + 1] END AS token FROM events) GROUP BY token""")
def framework_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where injected tokens come from."""
    name = F.get(F.array(*map(F.lit, _TOKENS)), (F.col("event_id") % 9).cast("int"))
    found = read_table(spark, sf_dir, "events").groupBy(name.alias("token")).agg(F.count(F.lit(1)).alias("places"))
    return found.withColumn("origin", predicates.token_origin(F.col("token")))


_SPEC = """concat('describe("d', p_partkey, '", () => { it(', CASE p_size % 3 WHEN 0 THEN concat('"a \\\\"', p_type, '\\\\" b"') WHEN 1 THEN concat(chr(39), 'it(', p_type, ')', chr(39)) ELSE concat('`', p_type, chr(10), '`') END,
', f); // it("no", f)', chr(10), 'test.only("t', p_size, '", f); x.it("member", f); xit(title, f); fit("f", () => {}) });')"""


@_query("""SELECT p_partkey, ord, CASE ord WHEN 0 THEN CASE p_size % 3 WHEN 0 THEN 'a "' || p_type || '" b' WHEN 1 THEN 'it(' || p_type || ')' ELSE p_type || chr(10) END WHEN 1 THEN 't' || p_size ELSE 'f' END AS title FROM part, range(3) AS r(ord)""")
def spec_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR05: the titles of each spec's cases, whatever quotes they have, outside comments and literals."""
    found = units.test_titles(_made(spark, sf_dir, _SPEC, dealt))
    return found.select(F.col("path").cast("bigint").alias("p_partkey"), F.col("ord").cast("bigint").alias("ord"), "title")


_API = """concat('class P { @Input() a', p_size, ' = 1; @Output() b = new EventEmitter(); c = input.required<string>(); d', p_partkey, ' = output();', chr(10),
'  s = inject(S', p_size, '); constructor(private readonly h: HttpClient, public r: R', p_partkey, ') {} }')"""


@_query("""SELECT p_partkey, unnest(['input', 'output', 'input', 'output', 'inject', 'constructor', 'constructor']) AS kind,
unnest(['a' || p_size, 'b', 'c', 'd' || p_partkey, 's', 'h', 'r']) AS name, unnest([NULL, NULL, NULL, NULL, 'S' || p_size, 'HttpClient', 'R' || p_partkey]) AS token FROM part""")
def unit_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs, outputs and injected dependencies of each unit."""
    made = _made(spark, sf_dir, _API)
    api = units.public_api(made).select("path", F.col("direction").alias("kind"), "name", F.lit(None).cast("string").alias("token"))
    both = api.unionByName(units.injected(made).select("path", F.col("style").alias("kind"), F.col("property").alias("name"), "token"))
    return both.select(F.col("path").cast("bigint").alias("p_partkey"), "kind", "name", "token")


# ---- documents and runs --------------------------------------------------------------------------------------

_RUN = """concat('{"a":{"provenance":{"at":"', {0}, '"},"files":{"x":{"y":"', {0}, '"}},"unit":{"id":"', {0}, '","path":"', {0}, '","name":"n', p_partkey, '"},"list":[{"loc":{"file":"', {0}, '","line":', CASE WHEN p_size % 7 = 0 THEN {0} ELSE 1 END, '},"unitId":"', {0}, '"}],
"warnings":["', {0}, '"],"inputHash":"', {0}, '"', CASE WHEN p_size % 5 = 0 AND {0} = 2 THEN ',"more":{"files2":"m"}' ELSE '' END, '}}')"""


@_query("""SELECT p_partkey, 'a.list[0].loc.line' AS path, '1' AS expected, '2' AS actual, 'changed' AS status FROM part WHERE p_size % 7 = 0
UNION ALL SELECT p_partkey, 'a.more.files2', NULL, 'm', 'unexpected' FROM part WHERE p_size % 5 = 0""")
def stable_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where two runs' documents differ in what was found, not in what every run writes anew."""
    parts = read_table(spark, sf_dir, "part")
    leaves = lambda run: flattened(parts.select("p_partkey", F.expr(_RUN.replace("{0}", f"'{run}'").replace(f"'{run}' = 2", f"{run} = 2")).alias("doc")), "p_partkey", "doc")
    return diff.stable_diff(leaves(1), leaves(2), "p_partkey")


@_query("""SELECT p_partkey, 'l' || p_size AS "left", 'r' AS "right", unnest(CASE p_size % 3 WHEN 0 THEN ['inputs', 'deps'] WHEN 1 THEN ['fields'] ELSE [NULL] END) AS free FROM part""")
def manifest_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC15: pairs of a manifest, and the views in which each may differ."""
    text = """concat('{"fixtures":[{"id":"', p_partkey, '","pair":["l', p_size, '","r"],"equivalence":', CASE p_size % 3 WHEN 0 THEN '{"mayDiffer":["inputs","deps"]}' WHEN 1 THEN '{"mayDiffer":["fields"],"mode":"x"}' ELSE 'null' END, '}]}')"""
    pairs, free = projections.declared_pairs(read_table(spark, sf_dir, "part").select(F.expr(text).alias("text")))
    own = pairs.select(F.col("id").cast("bigint").alias("p_partkey"), "left", "right")
    names = free.distinct().withColumnRenamed("name", "free")
    return own.join(names, ["left", "right"], "left").select("p_partkey", "left", "right", "free")


@_query("""WITH r AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'failed' WHEN 'O' THEN 'completed' ELSE 'skipped' END AS status, CASE WHEN o_orderkey % 3 < 2 THEN ['trivial', 'standard'][o_orderkey % 3 + 1] END AS tier, o_orderkey % 100 AS ms FROM orders),
l AS (SELECT l_orderkey, l_returnflag, l_quantity, ['High', 'medium', NULL, 'odd'][l_partkey % 4 + 1] AS severity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM r WHERE status = 'completed'))
SELECT (SELECT count(*) FROM r) AS units, (SELECT sum(ms)::BIGINT FROM r) AS elapsed_ms, (SELECT string_agg(status || '=' || n, ' ' ORDER BY status) FROM (SELECT status, count(*) AS n FROM r GROUP BY 1)) AS by_status,
(SELECT string_agg(tier || '=' || n, ' ' ORDER BY tier) FROM (SELECT tier, count(*) AS n FROM r WHERE tier IS NOT NULL GROUP BY 1)) AS by_tier,
(SELECT count(*) FILTER (l_returnflag = 'R') FROM l) AS blocking, (SELECT count(*) FILTER (l_returnflag <> 'R') FROM l) AS non_blocking,
(SELECT string_agg(s || '=' || n, ' ' ORDER BY s) FROM (SELECT lower(coalesce(severity, 'low')) AS s, count(*) AS n FROM l WHERE coalesce(severity, '') <> 'odd' GROUP BY 1)) AS risks""")
def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK09: the record of a run: units by status and tier, questions, risks and time."""
    status = F.when(F.col("o_orderstatus") == "F", "failed").when(F.col("o_orderstatus") == "O", "completed").otherwise("skipped")
    tier = F.get(F.array(F.lit("trivial"), F.lit("standard")), (F.col("o_orderkey") % 3).cast("int"))
    results = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("unit"), status.alias("status"), tier.alias("tier"), (F.col("o_orderkey") % 100).alias("elapsed_ms"))
    items = read_table(spark, sf_dir, "lineitem")
    severity = F.get(F.array(F.lit("High"), F.lit("medium"), F.lit(None), F.lit("odd")), (F.col("l_partkey") % 4).cast("int"))
    record = audit.run_record(results, items.select(F.col("l_orderkey").alias("unit"), (F.col("l_returnflag") == "R").alias("blocking")), items.select(F.col("l_orderkey").alias("unit"), severity.alias("severity")))
    said = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), " ").alias(c)
    return record.select("units", "elapsed_ms", said("by_status"), said("by_tier"), "blocking", "non_blocking", said("risks"))


@_query("""SELECT c_custkey AS unit, 'signature' AS tier, c_name AS text FROM customer UNION ALL SELECT c_custkey, 'template', c_mktsegment FROM customer WHERE c_custkey % 2 = 0""")
def written_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK01: tier documents written by tier, and one tier after the other read back."""
    rows = read_table(spark, sf_dir, "customer")
    documents = rows.select(F.col("c_custkey").alias("unit"), F.lit("signature").alias("tier"), F.col("c_name").alias("text")).unionByName(rows.filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("unit"), F.lit("template").alias("tier"), F.col("c_mktsegment").alias("text")))
    folder = f"{shared_folder(spark)}/tiers-{uuid.uuid4().hex}"
    tier_files.write_tiers(documents, folder)
    return reduce(DataFrame.unionByName, [spark.read.parquet(folder).filter(F.col("tier") == tier).select("unit", "tier", "text") for tier in ("signature", "template")])


@_query("""SELECT user_id AS unit, 'x' || (event_id % 5) AS id, count(*) AS places FROM events WHERE user_id = (SELECT min(user_id) FROM events) AND event_id % 5 = 2 GROUP BY ALL""")
def verb_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verb symbol: one symbol of one unit, without its source."""
    events = read_table(spark, sf_dir, "events")
    table = events.groupBy(F.col("user_id").alias("unit"), F.expr("concat('x', event_id % 5)").alias("id")).agg(F.count(F.lit(1)).alias("places"), F.first("props").alias("source"))
    return query_verbs.symbol(table, events.agg(F.min("user_id")).first()[0], "x2")
