"""Source facts from authored files, query verbs, and incremental runs over a stream of files."""

from __future__ import annotations

from lodestone.operators import query_verbs
from lodestone.sources import units
from lodestone.streaming.incremental_runs import run_incrementally

BOX = """import { Component, Input, inject } from '@angular/core';
import { of } from 'rxjs';
import { Helper } from './helper';
export { thing } from "lib-x/deep";
/* @Directive({}) class Old {} */
@Component({ selector: 'app-box', template: '<p>hi</p>' })
export class BoxComponent {
  @Input() label = '';
  size = input<number>(1);
  private readonly helper = inject(Helper);
  constructor(private http: HttpClient) {}
}
"""
GUARD = "import { Injectable } from '@angular/core';\n@Injectable()\nexport class AreaGuard {}\n"


def test_facts_of_authored_units(spark, tmp_path):
    for name, text in (("box.component.ts", BOX), ("area.guard.ts", GUARD), ("box.component.spec.ts", "it('works', () => {});"), ("types.d.ts", "x"), ("node_modules/a.ts", GUARD)):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(text)
    sources = units.read_sources(spark, str(tmp_path))
    assert {(r.kind, r.class_name, r.selector) for r in units.units(sources).collect()} == {("component", "BoxComponent", "app-box"), ("guard", "AreaGuard", None)}
    box = sources.filter("path LIKE '%box%'")
    assert [(r.module, r.group) for r in units.imports(box).orderBy("ord").collect()] == [("@angular/core", "angular"), ("rxjs", "rxjs"), ("./helper", "internal"), ("lib-x/deep", "thirdParty")]
    assert {(r.property, r.token, r.style) for r in units.injected(box).collect()} == {("helper", "Helper", "inject"), ("http", "HttpClient", "constructor")}
    assert {(r.direction, r.name) for r in units.public_api(box).collect()} == {("input", "label"), ("input", "size")}
    specs = spark.createDataFrame([("a.spec.ts", "it('one', f); it.only(`two`, f); xit(\"three\", f)")], "path string, text string")
    assert [r.title for r in units.test_titles(specs).orderBy("ord").collect()] == ["one", "two", "three"]


def test_verbs(spark):
    calls = spark.createDataFrame([("u", "method:a", "method:b", 2), ("u", "method:a", "method:c", 1), ("u", "method:a", "method:b", 0), ("v", "method:x", "method:b", 0)], "unit string, from string, to string, ord int")
    access = spark.createDataFrame([("u", "method:a", "field:f", "read"), ("u", "method:b", "field:f", "write")], "unit string, site string, field string, mode string")
    usage = spark.createDataFrame([("u", "dep:h", "method:a")], "unit string, dependency string, place string")
    assert {tuple(r) for r in query_verbs.refs(calls, access, usage, "u", "method:b").collect()} == {("caller", "method:a")}
    assert {tuple(r) for r in query_verbs.refs(calls, access, usage, "u", "field:f").collect()} == {("reader", "method:a"), ("writer", "method:b")}
    assert [r.id for r in query_verbs.callees(calls, "u", "method:a").collect()] == ["method:b", "method:c"]
    assert {tuple(r) for r in query_verbs.outline(usage, calls, access).collect()} == {("u", 1, 3, 2), ("v", 0, 1, 0)}


def test_a_stream_processes_new_content_once(spark, tmp_path):
    folder, seen = tmp_path / "in", []
    folder.mkdir()

    def run():
        run_incrementally(spark, str(folder), str(tmp_path / "cache"), str(tmp_path / "checkpoint"), lambda rows: seen.extend(sorted(r.text for r in rows.collect()))).awaitTermination(60)

    (folder / "a.ts").write_text("one")
    (folder / "b.ts").write_text("two")
    run()
    (folder / "c.ts").write_text("three")
    run()
    assert seen == ["one", "two", "three"]
