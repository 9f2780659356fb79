"""Small cases of operators beside the catalogue: edges, ties, formats of sources."""

import json

import pytest
from pyspark.sql import functions as F

from blockloom.functions import text as T
from blockloom.operators import checks, evidence, jobs, ledger, quality, render, snapshot
from blockloom.plans import vehicles as V
from blockloom.schema import ISSUES
from blockloom.sources import binary, export, readers
from blockloom.streaming import ingest


def one(spark, value, f):
    return spark.range(1).select(f(F.lit(value)).alias("x")).first().x


@pytest.mark.parametrize("text", ["", "a", "a\n", "\n", "a\r\nb", "a\x0bb\x0cc\x1cd\x85e f", " x 　\n\n"])
def test_lines_and_strip(spark, text):
    assert one(spark, text, T.lines) == text.splitlines()
    assert one(spark, text, T.strip) == text.strip()


@pytest.mark.parametrize(
    "f,text,want",
    [
        (T.gfm_slug, " A & b-C_1 ", "a--b-c_1"), (T.gfm_slug, "!!", "section"), (T.ascii_slug, "图 Chart 3-3", "chart_3_3"), (T.job_slug, "My Doc (1)", "my-doc-1"), (T.job_slug, "文档", "doc"),
        (T.latex_strip, "$E=mc^2$", "E=mc^2"), (T.latex_strip, "a \\$", "a \\$"), (T.estimate_tokens, "", 1), (T.estimate_tokens, "123456789", 2), (T.yaml_quoted, 'a"b\\', '"a\\"b\\\\"'),
        (T.blockquote, "a\n\nb", "> a\n>\n> b"), (T.base_name, "a/b.png", "b.png"), (T.stem, "a/b.c.png", "b.c"), (snapshot.safe_component, 'a/b:"c".', "a_b__c_"),
    ],
)
def test_text_functions(spark, f, text, want):
    assert one(spark, text, f) == want


def test_gate_lattice(spark):
    rows = [("a", "warn", False), ("a", "info", False), ("b", "error", False), ("b", "warn", False), ("c", "error", True), ("d", "info", False)]
    df = spark.createDataFrame([(d, "g", str(i), ok, lv) for i, (d, lv, ok) in enumerate(rows)], "doc_id string, gate string, id string, ok boolean, level string")
    got = {r.doc_id: (r.exit_code, r.status) for r in checks.gate_status(df).collect()}
    assert got == {"a": (2, "pass_with_notes"), "b": (1, "fail"), "c": (0, "pass"), "d": (0, "pass")}


def test_ledger_with_parse_errors_is_left_alone(spark):
    names = [x.split()[0] for x in ISSUES.split(", ")]
    row = lambda **k: tuple(k.get(n, "") for n in names)
    old = spark.createDataFrame([row(doc_id="a", id="1", status="open", found_by="t"), row(doc_id="b", id="1", status="open", found_by="t")], ISSUES)
    new = spark.createDataFrame([row(doc_id="a", id="2", status="open", found_by="t"), row(doc_id="b", id="2", status="open", found_by="t")], ISSUES)
    got = {(r.doc_id, r.id): r.status for r in ledger.merge(old, new, spark.createDataFrame([("a",)], "doc_id string")).collect()}
    assert got == {("a", "1"): "open", ("b", "1"): "fixed", ("b", "2"): "open"}


def test_table_markdown_of_spans_and_missing_columns(spark):
    cell = "array(array(named_struct('text','a|b','rowspan',1,'colspan',2),named_struct('text','c','rowspan',1,'colspan',0)))"
    r = spark.range(1).select(render.table_markdown(F.array().cast("array<string>"), F.expr(cell)).alias("x"), render.table_markdown(F.array(F.lit("h"), F.lit("")), F.expr(cell)).alias("y")).first()
    assert r.x == "|  |  |\n| --- | --- |\n| a\\|b |  |".replace("|  |  |", "|   |   |", 1)
    assert r.y == "| h |   |\n| --- | --- |\n| a\\|b |  |"


def test_opening_skips_front_matter_summary_and_contents(spark):
    text = "---\ntitle: x\n---\n> **摘要** s\n> more\n\n## 目录\n- [a](#a)\n---\nPDF\nbody"
    got = quality.opening_noise(spark.createDataFrame([("d", text)], "doc_id string, text string")).first()
    assert (got.sample_size, got.noisy_count, got.ok) == (2, 1, True)


def test_relative_paths(spark):
    r = spark.range(1).select(*[quality.resolved_path(F.lit("a/b.md"), F.lit(x)).alias(f"c{i}") for i, x in enumerate(("c.md", "../c.md", "./d/../c.md"))]).first()
    assert tuple(r) == ("a/c.md", "c.md", "a/c.md")


def test_vision_cache_forms(spark):
    docs = [("a", "v", '{"file":"x/p.png","text":"1"}\nbroken\n{"file":"p.png","text":"2"}'), ("b", "v", '{"p.png":"flat","n":3}'), ("c", "v", "")]
    got = {(r.doc_id, r.file): r.text for r in readers.vision_cache(spark.createDataFrame(docs, "doc_id string, path string, text string")).collect()}
    assert got[("a", "p.png")] == "2" and got[("b", "p.png")] == "flat" and not any(k[0] == "c" for k in got)


def test_comment_files(spark):
    docs = [("d", "c/a.jsonl", '{"text":"t1"}\nbad'), ("d", "c/b.json", '{"comments":[{"comment":"t2"}],"revisions":[{"revision":"t3"}]}'), ("d", "c/c.json", "{"), ("d", "c/n.txt", " note ")]
    got, bad = readers.comments(spark.createDataFrame(docs, "doc_id string, path string, text string"))
    assert {(r.origin, r.text) for r in got.collect()} == {("a.jsonl:1", "t1"), ("b.json:1", "t2"), ("b.json:2", "t3"), ("n.txt", "note")}
    assert bad.count() == 2


def test_issue_lines_and_gate_files(spark):
    good, bad = readers.split_issues(spark.createDataFrame([("d", "p", '{"id":"1"}\n[1]\n\nx')], "doc_id string, path string, text string"), ("id", "status"))
    assert [r.id for r in good.collect()] == ["1"] and {r.error for r in bad.collect()} == {"line 2: not a JSON object", "line 4: not a JSON object"}
    files = [("d", "gate_4_audit_tables.json", json.dumps({"phase": "4_audit", "status": "pass"})), ("d", "gate_4_audit_x.json", "{"), ("d", "gate_4_audit_y.json", json.dumps({"phase": "1_extraction", "status": "fail"}))]
    got = readers.gate_results(spark.createDataFrame(files, "doc_id string, path string, text string"))
    assert {(r.gate, r.status) for r in got.collect()} == {("tables", "pass"), ("x", "unreadable")}


def test_blocks_keep_nulls_and_fail_on_bad_lines(spark, tmp_path):
    b = V.blocks(spark.range(1), doc_id=F.lit("d"), ord=F.lit(1), id=F.lit("x"), type=F.lit("para"))
    readers.write_blocks(b, f"{tmp_path}/b", "json")
    assert readers.read_blocks(spark, f"{tmp_path}/b").collect() == b.collect()
    (tmp_path / "bad.json").write_text("{nope\n")
    with pytest.raises(Exception):
        readers.read_blocks(spark, f"{tmp_path}/bad.json").collect()


def test_binary_source_and_publish(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.md").write_text("# A\ntext")
    (tmp_path / "in/b.pdf").write_bytes(b"%PDF")
    got = {r.source_file: (r.text, r.error) for r in binary.skeletons(spark, f"{tmp_path}/in").collect()}
    assert got["a.md"] == ("# A\ntext", None) and got["b.pdf"][1] == "no backend for .pdf"
    for k in (1, 2):
        export.publish(spark.createDataFrame([("d", "main", "m.md", str(k))], "doc_id string, role string, path string, text string"), f"{tmp_path}/out")
        assert spark.read.parquet(f"{tmp_path}/out").first().text == str(k)


def test_output_files(spark):
    from blockloom.operators import delivery
    from blockloom.operators.parse import parse

    docs = spark.createDataFrame([("d", "s.md", ".md", "# A\nx\n# B\ny"), ("e", "e.md", ".md", "only text")], "doc_id string, source_file string, fmt string, text string")
    b = parse(docs)
    about = spark.createDataFrame([("d", 'T "1"', "s.md", 200, " said\n"), ("e", None, "e.md", None, "<!-- later -->")], "doc_id string, title string, source_file string, pages int, seed string").withColumn("source_type", F.lit("md")).withColumn("risk", F.lit("low"))
    files = delivery.output_files(about, b, spark.createDataFrame([], "doc_id string, path string"))
    got = {(r.doc_id, r.path): r.text for r in files.collect()}
    assert {p for d, p in got if d == "d"} == {"main.md", "parts/01-a.md", "parts/02-b.md", "index.md", "index.json", "provenance.json"}
    main = got["d", "main.md"]
    assert 'title: "T \\"1\\""' in main and "split: true" in main and "> **摘要**\n> said" in main and "- [A](parts/01-a.md) - 2 blocks" in main and "](#a)" not in main
    other = got["e", "main.md"]
    assert "# 文档\n" in other and "摘要" not in other and "- [文档](#文档)" in other and other.endswith("---\n\nonly text\n")
    index = json.loads(got["d", "index.json"])
    assert index["entry"]["mode"] == "split_index" and [p["path"] for p in index["parts"]] == ["parts/01-a.md", "parts/02-b.md"] and "| [A](parts/01-a.md) |" in got["d", "index.md"]
    assert json.loads(got["e", "index.json"])["parts"] == [] and "- Mode: single file" in got["e", "index.md"]
    assert len(json.loads(got["d", "provenance.json"])["blocks"]) == 4


def test_parts_are_files_of_their_own(spark):
    """Equal headings of two parts keep their slug, and images are found from the parts' folder."""
    rows = spark.createDataFrame([(1, "heading", 1, "A"), (2, "heading", 2, "x"), (3, "figure", None, None), (4, "heading", 1, "B"), (5, "heading", 2, "x")], "ord int, type string, level int, text string")
    b = V.blocks(rows, doc_id=F.lit("d"), ord=F.col("ord"), id=F.concat(F.lit("b"), F.col("ord")), type=F.col("type"), heading=F.when(F.col("type") == "heading", V.payload("heading", level=F.col("level"), text=F.col("text"))), figure=F.when(F.col("type") == "figure", V.payload("figure", asset_file=F.lit("extracted/images/i.png"), estimated_values=F.array())))
    one, two = (r.text for r in render.parts(b).orderBy("section").collect())
    assert "](../assets/i.png)" in one and '<a id="x"></a>' in one and '<a id="x"></a>' in two
    assert "](assets/i.png)" in render.bodies(b).first().body


def test_block_types_are_checked(spark):
    from blockloom.operators import project

    b = spark.createDataFrame([("d", "a", "para"), ("d", "b", "odd"), ("d", "c", None)], "doc_id string, id string, type string")
    assert sorted(r.id for r in project.unknown_types(b).collect()) == ["b", "c"]
    assert project.checked_types(b.where("id = 'a'")).first().type == "para"
    with pytest.raises(Exception, match="unknown block type: odd"):
        project.checked_types(b.where("id = 'b'")).collect()


def test_previews_by_a_renderer(spark):
    from blockloom.operators import delivery

    f = spark.createDataFrame([("d", "m.md", "# A"), ("d", "n.md", "<b>'&")], "doc_id string, path string, text string")
    got = {r.path: (r.html, r.renderer_ok) for r in delivery.previews(f, lambda c: F.when(c.startswith("#"), F.concat(F.lit("<h1>"), c))).collect()}
    assert got == {"m.md": ("<h1># A", True), "n.md": ("<pre>&lt;b&gt;&#x27;&amp;</pre>", False)}


def test_stream_ingest(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.md").write_text("# A\n\n- x")
    run = lambda: ingest.ingest(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    run()
    (tmp_path / "in/b.md").write_text("p")
    run()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_advance_needs_results(spark):
    j = spark.createDataFrame([("a", "4_audit"), ("b", "4_audit"), ("c", "7_package"), ("d", "4_audit")], "doc_id string, current_phase string")
    g = spark.createDataFrame([("a", "4_audit", "pass"), ("a", "4_audit", "unreadable"), ("b", "4_audit", "fail"), ("c", "7_package", "pass")], "doc_id string, phase string, status string")
    assert {r.doc_id: r.next_phase for r in jobs.advance(j, g).collect()} == {"a": "5_assembly", "b": "4_audit", "c": "7_package", "d": "4_audit"}


def test_evidence_samples(spark):
    f = spark.createDataFrame([("d", 0, "m.md", "〔源 p.1〕〔源 p.1〕\n〔源 p.2〕〔源 slide 3〕〔源 p.4〕〔源 A / 段 1〕")], "doc_id string, file_no int, file string, text string")
    a = evidence.anchor_map(f)
    assert [(r["kind"], r["index"]) for r in evidence.page_samples(a).orderBy("k").collect()] == [("pdf_page", 1), ("pdf_page", 2), ("slide", 3)]
    assert [r.source_anchor for r in evidence.text_samples(a).collect()] == ["A / 段 1"]


def test_audits_feed_the_ledger(spark):
    """Audit, ledger, unresolved, and a second audit after the figure was mended."""
    from blockloom.operators import audit

    rows = spark.createDataFrame([("d", 1, "f1", "extracted/images/a.png"), ("d", 2, "f2", "extracted/images/b.png")], "doc_id string, ord int, id string, file string")
    blocks = V.blocks(rows, doc_id=F.col("doc_id"), ord=F.col("ord"), id=F.col("id"), type=F.lit("figure"), figure=V.payload("figure", asset_file=F.col("file"), caption=F.lit("c"), description=F.lit("x")))
    none = spark.createDataFrame([], "doc_id string, path string")
    found = audit.run_audits(blocks, none)
    first = ledger.merge(spark.createDataFrame([], ISSUES), found)
    ids = {r.id for r in ledger.unresolved(first).collect()}
    assert {"figure_f1_asset_missing", "figure_f2_asset_missing"} <= ids and {r.status for r in first.collect()} == {"open"}
    there = spark.createDataFrame([("d", "extracted/images/a.png")], "doc_id string, path string")
    second = {r.id: r.status for r in ledger.merge(first, audit.run_audits(blocks, there)).collect()}
    assert second["figure_f1_asset_missing"] == "fixed" and second["figure_f2_asset_missing"] == "open"


def test_a_longer_keyword_cites_the_shorter(spark):
    from blockloom.operators import bind

    rows = spark.createDataFrame([(1, "figure", None, "表 A1"), (2, "para", "见图表 A1。", None), (3, "para", "见表 A12", None)], "ord int, type string, text string, no string")
    blocks = V.blocks(rows, doc_id=F.lit("d"), ord=F.col("ord"), id=F.concat(F.lit("b"), F.col("ord")), type=F.col("type"), content=F.when(F.col("type") == "para", V.payload("content", text=F.col("text"))), figure=F.when(F.col("type") == "figure", V.payload("figure", figure_no=F.col("no"))))
    assert [(r["from"], r["to"]) for r in bind.references(blocks).collect()] == [("b2", "b1")]


def test_gate_has_no_join(spark):
    docs = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("c", 1)], "doc_id string, x int")
    failed = lambda c: checks.failing(docs, c, "x")
    stray = spark.createDataFrame([("z", 1, "w")], "doc_id string, n int, first string")
    rows = checks.gate("g", docs, [("one", "error", failed(F.col("x") == 1)), ("none", "warn", failed(F.col("x") > 1)), ("stray", "error", stray)], "p")
    got = {(r.doc_id, r.id): (r.gate, r.phase, r.ok, r.level, r.message) for r in rows.collect()}
    assert rows.count() == 9 and got["a", "one"] == ("g", "p", False, "error", "1: 1") and got["c", "one"] == ("g", "p", False, "error", "1: 1")
    assert {k for k, v in got.items() if not v[2]} == {("a", "one"), ("c", "one")}
    assert got["b", "none"] == ("g", "p", True, "warn", "ok")
    assert "Join" not in rows._jdf.queryExecution().executedPlan().toString()


def test_unresolved_text_is_not_sought_by_row(spark):
    names = [x.split()[0] for x in ISSUES.split(", ")]
    rows = [("a", "1", "plain", "open"), ("a", "2", "two\nlines", "open"), ("a", "3", "lacking", "open"), ("a", "4", None, "open"), ("a", "5", "", "open"), ("a", "6", "part", "open"), ("a", "7", "gone", "fixed"), ("b", "8", "plain", "open")]
    issues = spark.createDataFrame([tuple({"doc_id": d, "id": i, "issue": x, "status": st, "severity": "minor", "category": "table"}.get(n, "") for n in names) for d, i, x, st in rows], ", ".join(f"{n} string" for n in names))
    text = "# Unresolved\n\n## 1\n\n- issue: plain\n\n## 2\n- issue: two\nlines\n\n## 7\n- issue: a part of it\n"
    projected = spark.createDataFrame([("a", text)], "doc_id string, text string")
    out = checks.unresolved_gate(issues.select("doc_id"), issues, projected)
    got = {(r.doc_id, r.id): r.message for r in out.collect()}
    assert got["a", "unresolved_ids_projected"] == "4: 3, 4, 5, 6" and got["b", "unresolved_ids_projected"] == "1: 8"
    assert got["a", "fixed_ids_not_projected"] == "1: 7" and got["b", "fixed_ids_not_projected"] == "ok"
    assert got["a", "unresolved_issue_text_projected"] == "2: 3, 4" and got["b", "unresolved_issue_text_projected"] == "1: 8"
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "array_contains(split(text" not in plan


def test_numbers_above_999_are_whole(spark):
    from blockloom.operators import bind, parse

    text = "\n\n".join(f"[VISION_PLACEHOLDER_i{i}.png]" for i in range(1003))
    blocks = parse.parse(spark.createDataFrame([("a", "f.md", ".md", text)], "doc_id string, source_file string, fmt string, text string"))
    ids = [r.id for r in blocks.orderBy("ord").collect()]
    assert len(set(ids)) == 1003 and ids[99] == "block_figure_100" and ids[-1] == "block_figure_1003"
    names = [r.asset_name for r in bind.asset_names(blocks).orderBy("ord").collect()]
    assert len(set(names)) == 1003 and names[-1] == "fig_doc_asset_1003.png"
