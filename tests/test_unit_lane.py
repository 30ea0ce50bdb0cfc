"""Forms, origins, stable differences, versions and run records by known answers and odd rows."""

from __future__ import annotations

import json

import pytest
from oracle import assert_same
from pyspark.sql import functions as F

from lodestone.operators import audit, diff, lookup, predicates
from lodestone.plans import unit_lane
from lodestone.sources import forms, units


@pytest.mark.parametrize("name", sorted(unit_lane.QUERIES))
def test_query_is_that_of_sql(spark, sf_dir, duck, name):
    assert assert_same(unit_lane.QUERIES[name](spark, sf_dir), duck, unit_lane.ORACLES[name]) > 0


FORM = """export class A {
  login = new FormGroup<Login>({ user: new FormControl('', { validators: [Validators.required] }), 'pass-word': ['', Validators.compose([Validators.min(1), Validators.max(2)])] })
  static readonly deep: FormRecord = this.a.b.record({ x: [{ value: 1, disabled: fn({ a: 1 }, 2) }, []] }, opts);
  empty = fb.group();
  by = fb.group(shape)
  not = this.fb.control({ z: 1 });
  m() { const local = this.fb.group({ no: 1 }); }
  lazy = () => new FormGroup({ no: 1 });
  // old = new FormGroup({ no: 1 });
  none = new FormGroup(
"""


def test_forms_of_odd_sources(spark):
    sources = spark.createDataFrame([("a", FORM), ("b", "x = new FormGroup({ top: 1 });"), ("c", ""), ("d", None)], "path string, text string")
    assert {(r.path, r.name, r.built_with) for r in forms.form_groups(sources).collect()} == {
        ("a", "login", "new FormGroup"),
        ("a", "deep", "FormBuilder"),
        ("a", "empty", "FormBuilder"),
        ("a", "by", "FormBuilder"),
        ("a", "none", "new FormGroup"),
    }
    found = {r.id: (r.kind, r.validators, r.disabled) for r in forms.form_controls(sources).collect()}
    assert found == {
        "control:login.user": ("control", ["required"], None),
        "control:login.pass-word": ("control", ["compose", "min", "max"], None),
        "control:deep.x": ("control", [], "fn({ a: 1 }, 2)"),
    }


def test_controls_are_found_where_their_source_lies(spark, sf_dir):
    plan = unit_lane.QUERIES["form_controls"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Join" not in plan and plan.count("MapInArrow") == 1


def test_forms_of_long_sources_take_the_work_of_their_length(spark):
    many = 3000
    controls = ", ".join(f"c{k}: [{{ value: 0, disabled: x{k} }}, Validators.min({k})]" for k in range(many))
    found = forms.form_controls(spark.createDataFrame([("a", f"class A {{ f = new FormGroup({{ {controls} }}); }}")], "path string, text string")).collect()
    assert [(r.id, r.validators, r.disabled) for r in found] == [(f"control:f.c{k}", ["min"], f"x{k}") for k in range(many)]


def test_controls_of_odd_objects(spark):
    text = "class A { f = new FormGroup({ a: [{ disabled: 1, disabled: [2, 3] }], b: ',', c: { disabled: ',' }, , d: '[', ...e, g() { Validators.no }, h: `${ Validators.max }` }); g = new FormGroup({ open: 1"
    found = forms.form_controls(spark.createDataFrame([("a", text), (None, "class B { f = this.b.group({ x: '' }) }")], "path string, text string")).collect()
    assert {(r.path, r.id[8:], tuple(r.validators), r.disabled) for r in found} == {
        ("a", "f.a", (), "[2, 3]"), ("a", "f.b", (), None), ("a", "f.c", (), "','"), ("a", "f.d", (), None), ("a", "f.h", ("max",), None), (None, "f.x", (), None)
    }


def test_titles_are_found_where_their_spec_lies(spark, sf_dir):
    plan = unit_lane.QUERIES["spec_titles"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and plan.count("MapInArrow") == 1


def test_titles_of_specs_in_any_number(spark):
    specs = [("a", "it('1', f); xit.only('no', f); fit(`2`, f); test.each(x)('no', f); it . skip ('3', f); it.only(`no ${x}`, f); describe('no', () => { test(\"\", f) })"), ("b", None), (None, "it('null', f)"), ("a", "it('same path', f)")]
    found = units.test_titles(spark.createDataFrame(specs, "path string, text string")).collect()
    assert [(r.path, r.ord, r.title) for r in found] == [("a", 0, "1"), ("a", 1, "2"), ("a", 2, "3"), ("a", 3, ""), (None, 0, "null"), ("a", 0, "same path")]


def test_groups_are_found_where_their_source_lies(spark, sf_dir):
    plan = unit_lane.QUERIES["form_groups"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and plan.count("MapInArrow") == 1


def test_groups_of_odd_sources(spark):
    text = "class A { a = b = new FormGroup({}); c =\n d = x.group(y); e() { return 1 } readonly f! = new FormArray<T>([]); g?: T = q.r.s.t.record({ z: 1 }); h = x.array({}); i = new Other({}); get j() { } }\nclass B { k = 1; }\n const l = x.group({}); class C { = x.group({}); }"
    found = forms.form_groups(spark.createDataFrame([("a", text), ("b", "".join(f"class K{k} {{ f = x.group({{}}) }}" for k in range(3000)))], "path string, text string"))
    rows = [(r.name, r.built_with, r.object is not None) for r in found.filter("path = 'a'").collect()]
    assert rows == [("a", "new FormGroup", True), ("d", "FormBuilder", False), ("f", "new FormArray", False), ("g", "FormBuilder", True)]
    assert [(r.name, r.built_with) for r in found.filter("path = 'b'").collect()] == [("f", "FormBuilder")] * 3000


def test_origins_are_whole_names(spark):
    rows = [("Router", "angular"), ("MyRouter", "internal"), ("router", "internal"), ("", "internal"), (None, None), ("NonNullableFormBuilder", "angular")]
    found = spark.createDataFrame(rows, "token string, origin string").select("origin", predicates.token_origin(F.col("token")).alias("found")).collect()
    assert [r.found for r in found] == [r.origin for r in found]


def test_volatile_paths(spark):
    rows = {"a.provenance.x": True, "a.provenance[0]": True, "a.provenances": False, "a.warnings[2].code": True, "a.unit.id": True, "a.unit.ids": False, "a.loc.file": True, "a.loc.files": False, "x.unitId": True, "unitId": False, "a.inputHash.more": False}
    found = spark.createDataFrame([(p,) for p in rows], "path string").select("path", diff.volatile(F.col("path")).alias("v")).collect()
    assert {r.path: r.v for r in found} == rows


def test_versions_of_manifests(spark):
    manifests = [("package.json", {"devDependencies": {"@angular/compiler": "1"}}), ("a/package.json", {"dependencies": {"@angular/compiler": "c"}, "devDependencies": {"@angular/core": "d"}}), ("a/b/package.json", {"dependencies": None}), ("a/b/c/package.json", {"dependencies": {"@angular/core": ""}})]
    rows = [(p, json.dumps(m)) for p, m in manifests] + [("a/b/c/d/package.json", "{"), ("e/package.json", None)]
    made = spark.createDataFrame(rows, "path string, text string")
    paths = spark.createDataFrame([(1, "a/b/c/d/x.ts"), (2, "y.ts"), (3, "e/z.ts"), (4, "ab/z.ts")], "k int, path string")
    assert {r.k: r.version for r in lookup.nearest_versions(paths, "k", "path", made).collect()} == {1: "d", 2: "1", 3: "1", 4: "1"}
    assert {r.version for r in lookup.nearest_versions(paths, "k", "path", made.limit(0)).collect()} == {None}


def test_run_records_of_odd_runs(spark):
    results = spark.createDataFrame([("a", "completed", "trivial", 5), ("b", "failed", None, None), ("c", "completed", "trivial", 1)], "unit string, status string, tier string, elapsed_ms bigint")
    questions = spark.createDataFrame([("a", True), ("a", None), ("b", True), ("x", False)], "unit string, blocking boolean")
    risks = spark.createDataFrame([("a", "HIGH"), ("c", None), ("c", "unheard"), ("b", "low")], "unit string, severity string")
    row = audit.run_record(results, questions, risks).first()
    assert (row.units, row.elapsed_ms, row.by_status, row.by_tier) == (3, 6, {"completed": 2, "failed": 1}, {"trivial": 2})
    assert (row.blocking, row.non_blocking, row.risks) == (1, 1, {"high": 1, "low": 1})
    empty = audit.run_record(results.limit(0), questions, risks).first()
    assert (empty.units, empty.elapsed_ms, empty.by_status, empty.blocking, empty.risks) == (0, 0, {}, 0, {})
