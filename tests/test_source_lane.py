"""Tier files, projections, predicates and documents by known answers, with odd rows."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from lodestone.operators import diff, predicates, projections, rendering
from lodestone.operators.sections import section_body
from lodestone.sources import tier_files, units


def _write(folder, files: dict) -> None:
    for name, text in files.items():
        (folder / name).parent.mkdir(parents=True, exist_ok=True)
        (folder / name).write_text(text if isinstance(text, str) else json.dumps(text))


def _plain(df, *columns):
    return {tuple(r[c] for c in columns) for r in df.collect()}


def test_tier_files_by_name_version_and_state(spark, tmp_path):
    _write(tmp_path / "in", {"a/signature.json": {"schemaVersion": "2"}, "a/expected.template.json": {"schemaVersion": "1"}, "b/functions.json": "{oops", "b/notes.json": {}, "c/index.json": {}, "d/readme.txt": "x"})
    tiers = tier_files.read_tiers(spark, str(tmp_path / "in"))
    assert {(u.rsplit("/", 1)[1], t, s) for u, t, s in _plain(tiers, "unit", "tier", "status")} == {("a", "signature", "ok"), ("a", "template", "ok"), ("b", "functions", "broken"), ("c", "index", "ok")}
    wanted = spark.createDataFrame([("signature", "2"), ("template", "2"), ("functions", None)], "tier string, version string")
    assert _plain(tier_files.checked_versions(tiers, wanted), "tier", "outcome") == {("signature", "ok"), ("template", "legacy"), ("functions", "broken"), ("index", "skipped")}
    assert tier_files.unit_folders(tiers).count() == 3
    asked = tier_files.unit_folders(tiers).unionByName(spark.createDataFrame([("nowhere",)], "unit string"))
    found = {(r.unit.rsplit("/", 1)[-1], tuple(r.found), r.status) for r in tier_files.loaded_units(asked, tiers).collect()}
    assert found == {("a", ("signature", "template"), "ok"), ("b", (), "missing"), ("c", ("index",), "ok"), ("nowhere", (), "missing")}
    tier_files.write_tiers(tiers.filter("status = 'ok'"), str(tmp_path / "out"))
    assert _plain(spark.read.parquet(str(tmp_path / "out")), "tier", "text") == _plain(tiers.filter("status = 'ok'"), "tier", "text")


def test_records_of_runs(spark):
    stored = spark.createDataFrame([("src",)], "src_root string")
    assert not tier_files.index_needed(stored, "src") and tier_files.index_needed(stored, "other") and tier_files.index_needed(stored.limit(0), "src")
    files = spark.createDataFrame([("u", "b", "2"), ("u", "a", "1"), ("v", "a", None)], "unit string, path string, text string")
    assert _plain(tier_files.inputs_hash(files), "unit", "hash") == _plain(tier_files.inputs_hash(files.orderBy("path")), "unit", "hash")
    record = tier_files.cache_records(spark.createDataFrame([("u", "h", "trivial")], "unit string, hash string, tier string"))
    have = spark.createDataFrame([("u", f"{t}.json") for t in ("signature", "dependencies", "functions", "template")], "unit string, name string")
    now = spark.createDataFrame([("u", "h")], "unit string, hash string")
    assert tier_files.still_valid(now, record, have).count() == 1
    assert tier_files.still_valid(now, record, have.filter("name <> 'template.json'")).count() == 0


def test_pairs_of_a_manifest(spark):
    signature = {"publicApi": {"inputs": [{"name": "b", "required": True}, {"name": "a", "alias": "x"}], "outputs": None}, "injectedDependencies": [{"propertyName": "h", "token": "T", "visibility": "private", "modifiers": {"self": True, "host": False}}]}
    other = {"publicApi": {"inputs": [{"name": "a", "alias": "x", "required": False}, {"name": "b", "required": True}], "twoWayBindings": [{"name": "m"}]}, "injectedDependencies": signature["injectedDependencies"]}
    calls = {"callGraph": {"calls": {"method:a": ["method:c", "method:b"], "method:b": None}}}
    rows = [("l", "signature", json.dumps(signature)), ("r", "signature", json.dumps(other)), ("l", "dependencies", json.dumps(calls)), ("r", "dependencies", json.dumps(calls)), ("r", "functions", "no json")]
    tiers = spark.createDataFrame(rows, "unit string, tier string, text string")
    found = {}
    for r in projections.projections(tiers).collect():
        found.setdefault((r.unit, r.name), []).append((r.item, r.n))
    views = projections.view_values(projections.projections(tiers), tiers)
    by_name = lambda x: str(x[0])
    assert sorted(found["l", "inputs"], key=by_name) == [({"name": "a", "required": "false", "alias": "x"}, 1), ({"name": "b", "required": "true", "alias": "-"}, 1)]
    assert found["l", "deps"] == [({"propertyName": "h", "token": "T", "visibility": "private", "modifiers": "self"}, 1)]
    assert sorted(found["r", "callEdges"], key=by_name) == [({"from": "method:a", "to": "method:b"}, 1), ({"from": "method:a", "to": "method:c"}, 1)]
    assert views.count() == 2 * len(projections.VIEWS) and ("l", "formApproach") not in found and ("r", "twoWay") in found
    manifest = {"fixtures": [{"id": "one", "pair": ["l", "r"], "equivalence": {"mayDiffer": ["outputs"]}}]}
    pairs, free = projections.declared_pairs(spark.createDataFrame([(json.dumps(manifest),)], "text string"))
    same = {r.name: r.same for r in diff.pair_equivalence(views, pairs.drop("id"), free).collect()}
    assert "outputs" not in same and [n for n, s in same.items() if not s] == ["twoWay"]


def test_an_unknown_warning_code_fails(spark):
    codes = spark.createDataFrame([("gap", "warning")], "code string, severity string")
    assert _plain(predicates.with_severity(spark.createDataFrame([("gap",)], "code string"), codes), "severity") == {("warning",)}
    with pytest.raises(Exception, match="unknown warning code: odd"):
        predicates.with_severity(spark.createDataFrame([("odd",)], "code string"), codes).collect()


def test_sources_and_what_they_declare(spark, tmp_path):
    _write(tmp_path, {"a.ts": "x", "e2e/b.ts": "x", ".cache/c.ts": "x", "sub/d.ts": "x", "sub/d.spec.ts": "x"})
    sources = units.read_sources(spark, str(tmp_path))
    assert {r.path.rsplit("/", 1)[1] for r in sources.collect()} == {"a.ts", "d.ts"}
    asked = sources.select("path").unionByName(spark.createDataFrame([("gone.ts",)], "path string"))
    assert units.with_status(asked, sources).filter("status = 'unreadable'").count() == 1
    made = spark.createDataFrame([("p/a.ts", "@Component({\n template: `one\ntwo`, })\nclass A {}"), ("p/b.ts", "@Component({ templateUrl: './b.html' })"), ("p/c.ts", ""), ("p/d.ts", None)], "path string, text string")
    declared = {r.path: (r.kind, r.template, r.url, r.start_line) for r in units.declared_templates(made).collect()}
    assert declared["p/a.ts"] == ("inline", "one\ntwo", None, 1) and declared["p/b.ts"] == ("external", None, "./b.html", None) and declared["p/c.ts"][0] == "absent"
    read = {r.path: (r.template, r.status) for r in units.read_templates(units.declared_templates(made), spark.createDataFrame([("p/b.html", "<b>")], "path string, text string")).collect()}
    assert read["p/b.ts"] == ("<b>", "external") and read["p/c.ts"] == ("", "absent")


def test_documents_have_all_sections_in_order(spark):
    items = spark.createDataFrame([("u", "inputs", 2, "b"), ("u", "inputs", None, "a"), ("u", "nonsense", 1, "c"), ("v", "nonsense", 1, "c")], "unit string, section string, ord int, line string")
    made = rendering.documents(rendering.section_bodies(items))
    assert [r.unit for r in made.collect()] == ["u"]
    row = made.select(section_body(F.col("document"), "inputs").alias("inputs"), section_body(F.col("document"), "forms").alias("forms"), "document").first()
    assert row.inputs == "- a\n- b" and row.forms == "_None._"
    places = [row.document.index(f"## {heading}\n") for _, heading in rendering.SECTIONS]
    assert places == sorted(places)
    assert rendering.documents(rendering.section_bodies(items.limit(0))).count() == 0


def test_sections_have_their_shapes(spark):
    items = [
        ("u", "overview", "responsibilities", 2, ["b"], None),
        ("u", "overview", "responsibilities", None, ["a", None, "note", "more"], ["below", "it"]),
        ("u", "overview", "purpose", 1, ["what", "for"], None),
        ("u", "overview", "purpose", 2, ["and"], None),
        ("u", "risks", "risks", 1, ["high", "a | b"], None),
        ("u", "risks", "risks", 2, [None, ""], None),
        ("u", "workflow", "steps", 2, ["then"], None),
        ("u", "workflow", "steps", 1, ["first"], ["why"]),
        ("u", "workflow", "unknown", 1, ["no"], None),
    ]
    made = spark.createDataFrame(items, "unit string, section string, part string, ord int, cells array<string>, below array<string>")
    found = {r.section: r.body for r in rendering.shaped_bodies(made).collect()}
    assert found == {
        "overview": "what for\n\nand\n\n### Responsibilities\n- **a** note; more\n  - below\n  - it\n- b",
        "risks": "| Severity | Risk |\n|-|-|\n| high | a \\| b |\n|  |  |",
        "workflow": "1. first\n  - why\n2. then",
    }
    assert rendering.shaped_bodies(made.limit(0)).count() == 0


def test_ways_to_clean_up(spark):
    rows = [
        (True, "this.s . unsubscribe ()", "", "ngOnDestroy-unsubscribe"),
        (True, "takeUntilDestroyed()", "", "none"),
        (False, "x.unsubscribe()", None, "none"),
        (False, "inject<DestroyRef>( DestroyRef ); o.pipe(takeUntilDestroyed(d))", "", "takeUntilDestroyed"),
        (False, "d = inject < DestroyRef > (DestroyRef, { optional: true })", "{{ a | async }}", "DestroyRef"),
        (False, "inject(DestroyRefs)", "{{ f(a)|async }}", "async-pipe-only"),
        (False, "", "{{ a || async }}", "none"),
    ]
    made = spark.createDataFrame(rows, "destroys boolean, body string, template string, way string")
    found = made.select("way", predicates.cleanup_strategy(F.col("destroys"), F.col("body"), F.col("template")).alias("found")).collect()
    assert [r.found for r in found] == [r.way for r in found]
