"""Gates: declarative checks over the tables of a corpus, their levels and the status lattice.

A check is a row ``(doc_id, gate, phase, id, ok, level, message)``.  A gate is a list of specifications; each gives a
frame with the documents that fail and how many offenders there are.  All documents of a gate's universe get a row
for each check, by one grouping of the universe with the gathered failures.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schema import ANCHOR_KEYS, CATEGORIES, ISSUE_STATUS, PAYLOAD_OF, PHASE_STATUS, PHASES, SEVERITIES
from . import audit, bind
from . import quality as Q
from .project import anchor_text

#: Gates of each phase in order, and the gates whose results are filed under a fixed phase.
PHASE_GATES = {
    "0_intake": ("state", "manifest_draft"), "1_extraction": ("extraction",), "2_ir_build": ("ir", "provenance", "links_ir"), "3_semantic_compile": ("ir", "links_ir"),
    "4_audit": ("audit_summary", "tables", "provenance", "unresolved"), "5_assembly": ("quality", "placeholders", "links_markdown"), "6_validation": ("visual", "manifest_final"), "7_package": ("package",),
}
LEVEL_RANK = {"info": 0, "warn": 1, "error": 2}


def failing(rows: DataFrame, bad: Column, what: str | Column = "id") -> DataFrame:
    """Documents with rows where ``bad`` holds: how many, and the first five offenders."""
    name = F.col(what) if isinstance(what, str) else what
    hit = rows.where(F.coalesce(bad, F.lit(False))).select("doc_id", name.cast("string").alias("w"))
    return hit.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.slice(F.array_sort(F.collect_set("w")), 1, 5), ", ").alias("first"))


def gate(name: str, universe: DataFrame, specs: Iterable[tuple[str, str, DataFrame]], phase: str | None = None) -> DataFrame:
    """``specs``: (check id, level, failing documents).  Documents of ``universe`` without a failure pass."""
    specs = list(specs)
    # one exchange by document and no join: the failures of a large corpus never fit a broadcast
    found = reduce(DataFrame.unionByName, [f.select("doc_id", F.struct(F.lit(i).alias("id"), F.col("n").cast("long").alias("n"), "first").alias("hit")) for i, _, f in specs])
    rows = universe.select("doc_id", F.lit(True).alias("_in")).unionByName(found, allowMissingColumns=True).groupBy("doc_id").agg(F.max("_in").alias("_in"), F.collect_list("hit").alias("hits")).where("_in")
    plan = F.explode(F.array(*[F.struct(F.lit(i).alias("id"), F.lit(lv).alias("level")) for i, lv, _ in specs])).alias("c")
    rows = rows.select("doc_id", "hits", plan).withColumn("hit", F.get(F.filter("hits", lambda x: x["id"] == F.col("c.id")), F.lit(0))).select("doc_id", "c.id", "c.level", "hit.n", "hit.first")
    message = F.when(F.col("n").isNull(), "ok").otherwise(F.concat(F.col("n").cast("string"), F.lit(": "), F.coalesce("first", F.lit(""))))
    return rows.select("doc_id", F.lit(name).alias("gate"), F.lit(phase).cast("string").alias("phase"), "id", F.col("n").isNull().alias("ok"), "level", message.alias("message"))


def gate_status(checks: DataFrame) -> DataFrame:
    """Status of each gate: an error fails, a warning is noted, information never counts."""
    rank = F.when(F.col("ok"), -1).when(F.col("level") == "error", 2).when(F.col("level") == "warn", 1).otherwise(0)
    keys = [c for c in ("doc_id", "gate", "phase") if c in checks.columns]
    top = checks.groupBy(*keys).agg(F.max(rank).alias("r"), F.count_if("ok").alias("n_ok"), F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set(F.when(~F.col("ok"), F.col("id")))), ", ").alias("failed"))
    code = F.when(F.col("r") == 2, 1).when(F.col("r") == 1, 2).otherwise(0)
    log = F.concat(F.col("n_ok").cast("string"), F.lit("/"), F.col("n").cast("string"), F.when(F.col("failed") == "", "").otherwise(F.concat(F.lit(" — failed: "), F.col("failed"))))
    return top.select(*keys, code.alias("exit_code"), F.when(code == 1, "fail").when(code == 2, "pass_with_notes").otherwise("pass").alias("status"), log.alias("log"))


def _has(rows: DataFrame, universe: DataFrame) -> DataFrame:
    """Documents of the universe without any row."""
    return universe.select("doc_id").distinct().join(rows.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", F.lit(1).alias("n"), F.lit("missing").alias("first"))


def _twice(rows: DataFrame, key: str) -> DataFrame:
    twice = rows.groupBy("doc_id", key).count().where("count > 1")
    return failing(twice, F.lit(True), key)


def ir_gate(docs: DataFrame, blocks: DataFrame, order: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Blocks against their document: ``order (doc_id, id)`` is the declared order, ``stats (doc_id, block_count)``."""
    payload = F.lit(False)
    for kind, field in PAYLOAD_OF.items():
        payload = payload | ((F.col("type") == kind) & F.col(field).isNull())
    ids, named = blocks.select("doc_id", "id").distinct(), order.select("doc_id", "id").distinct()
    specs = [
        ("blocks_present", "error", _has(blocks, docs)),
        ("no_duplicate_ids", "error", _twice(blocks, "id")),
        ("block_order_exist", "error", failing(named.join(ids, ["doc_id", "id"], "left_anti"), F.lit(True))),
        ("no_orphan_blocks", "warn", failing(ids.join(named, ["doc_id", "id"], "left_anti"), F.lit(True))),
        ("required_fields", "error", failing(blocks, F.col("id").isNull() | F.col("type").isNull() | F.col("source_anchor").isNull() | F.col("confidence").isNull() | F.col("needs_review").isNull())),
        ("known_block_types", "error", failing(blocks, ~F.coalesce(F.col("type").isin(*PAYLOAD_OF), F.lit(False)))),
        ("type_subfield_present", "error", failing(blocks, payload)),
    ]
    if stats is not None:
        n = blocks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_real"))
        off = stats.join(n, "doc_id", "left").where(~F.col("block_count").eqNullSafe(F.coalesce("n_real", F.lit(0))))
        specs.append(("stats_block_count", "warn", failing(off, F.lit(True), F.col("block_count"))))
    return gate("ir", docs, specs)


def extraction_gate(docs: DataFrame, meta: DataFrame, skeletons: DataFrame, images: DataFrame) -> DataFrame:
    """What an extraction left: ``meta (doc_id, text)`` its JSON, ``skeletons`` and ``images (doc_id, path)`` its files.

    Without a readable JSON there are no further checks.  A document without errors has its profile confirmed."""
    parsed = F.try_parse_json("text")
    got = meta.select("doc_id", parsed.isNull().alias("broken"), F.coalesce(F.json_object_keys(F.when(parsed.isNotNull(), F.col("text"))), F.array().cast("array<string>")).alias("k"), F.get_json_object(F.when(parsed.isNotNull(), F.col("text")), "$.mapped_image_count").try_cast("long").alias("mapped"))
    lacks = lambda key: failing(got, ~F.array_contains("k", key), F.lit("missing"))
    count = got.join(images.groupBy("doc_id").agg(F.count(F.lit(1)).alias("there")), "doc_id", "left").select("doc_id", F.coalesce("there", F.lit(0)).alias("there"), F.coalesce("mapped", F.lit(0)).alias("mapped"))
    rows = gate("extraction", docs, [
        ("extract_meta_present", "error", _has(meta, docs)),
        ("extract_meta_parseable", "error", failing(got, F.col("broken"), F.lit("invalid JSON"))),
        ("meta.source_format", "error", lacks("source_format")),
        ("meta.image_count", "error", lacks("image_count")),
        ("meta.structured_stats", "error", lacks("structured_stats")),
        ("skeleton_present", "error", _has(skeletons, docs)),
        ("image_count_consistent", "warn", failing(count, F.col("there") != F.col("mapped"), F.concat(F.lit("on disk="), F.col("there").cast("string"), F.lit(" mapped="), F.col("mapped").cast("string")))),
    ], "1_extraction")
    state = docs.select("doc_id").distinct().join(got.select("doc_id", "broken"), "doc_id", "left")
    rows = rows.join(state, "doc_id").where((F.col("id") == "extract_meta_present") | F.when(F.col("broken"), F.col("id") == "extract_meta_parseable").otherwise(F.col("broken").isNotNull() & (F.col("id") != "extract_meta_parseable"))).drop("broken")
    fit = rows.groupBy("doc_id").agg(F.bool_and(F.col("ok") | (F.col("level") != "error")).alias("fit")).where("fit")
    sure = fit.select("doc_id", F.lit("extraction").alias("gate"), F.lit("1_extraction").alias("phase"), F.lit("profile_confirmed").alias("id"), F.lit(True).alias("ok"), F.lit("info").alias("level"), F.lit("ok").alias("message"))
    return rows.unionByName(sure)


def provenance_gate(docs: DataFrame, blocks: DataFrame, sources: DataFrame) -> DataFrame:
    """``sources (doc_id, path)`` are the declared files."""
    a = F.col("source_anchor")
    undeclared = blocks.where(a["source_file"].isNotNull()).select("doc_id", "id", a["source_file"].alias("path")).join(sources.select("doc_id", "path").distinct(), ["doc_id", "path"], "left_anti")
    high = F.col("type").isin("table", "figure", "formula")
    return gate("provenance", docs, [
        ("blocks_present", "error", _has(blocks, docs)),
        ("every_block_has_anchor", "error", failing(blocks, a.isNull() | a["kind"].isNull())),
        ("anchor_kind_known", "error", failing(blocks, a["kind"].isNotNull() & ~a["kind"].isin(*ANCHOR_KEYS))),
        ("anchor_keys_complete", "error", failing(blocks, a["kind"].isin(*ANCHOR_KEYS) & ~audit.anchor_keys_present(a))),
        ("anchor_source_declared", "warn", failing(undeclared, F.lit(True))),
        ("pdf_page_known", "warn", failing(blocks, (a["kind"] == "pdf_page") & a["page"].isNull())),
        ("high_value_traceable", "error", failing(blocks, high & ~audit.anchor_keys_present(a))),
    ])


def links_ir_gate(docs: DataFrame, blocks: DataFrame, assets: DataFrame, files: DataFrame) -> DataFrame:
    """Figures, the stored assets index (doc_id, asset_id, file) and the listing of image files (doc_id, path)."""
    figs = blocks.where("type = 'figure'").select("doc_id", "id", F.col("figure.asset_id").alias("asset_id"))
    absent = assets.select("doc_id", "asset_id", F.col("file").alias("path")).join(files.select("doc_id", "path").distinct(), ["doc_id", "path"], "left_anti")
    orphan = files.select("doc_id", "path").distinct().join(assets.select("doc_id", F.col("file").alias("path")).distinct(), ["doc_id", "path"], "left_anti")
    named = assets.withColumn("name", T.base_name(F.col("file")))
    return gate("links_ir", docs, [
        ("figure_assets_indexed", "error", failing(figs.join(assets.select("doc_id", "asset_id").distinct(), ["doc_id", "asset_id"], "left_anti"), F.lit(True))),
        ("asset_files_exist", "error", failing(absent, F.lit(True), "asset_id")),
        ("asset_names_conform", "error", failing(named, ~bind.valid_asset_name(F.col("name")), "name")),
        ("no_name_collisions", "error", _twice(named, "name")),
        ("no_orphan_image_files", "warn", failing(orphan, F.lit(True), "path")),
    ])


def tables_gate(docs: DataFrame, blocks: DataFrame) -> DataFrame:
    t = blocks.where("type = 'table'")
    cols, rows = F.coalesce("table.columns", F.array().cast("array<string>")), F.coalesce("table.rows", F.array().cast("array<array<struct<text:string,rowspan:int,colspan:int>>>"))
    span = lambda c: F.when(c.isNull() | (c["colspan"] <= 0), 0).otherwise(F.coalesce(c["colspan"], F.lit(1)))
    width = lambda r: F.aggregate(r, F.lit(0), lambda a, c: a + span(c))
    blank = F.size(F.filter(cols, lambda c: T.strip(c) == ""))
    from .render import table_markdown

    line_cells = lambda s: F.regexp_count(F.regexp_replace(s, r"\\.", ""), F.lit(r"\|")) - 1
    bad_md = F.exists(F.split(table_markdown(cols, rows), "\n"), lambda s: line_cells(s) != F.size(cols))
    return gate("tables", docs, [
        ("blocks_present", "error", _has(blocks, docs)),
        ("columns_present", "error", failing(t, F.size(cols) == 0)),
        ("row_widths_match_columns", "error", failing(t, F.exists(rows, lambda r: width(r) != F.size(cols)))),
        ("header_rows_valid", "error", failing(t, F.exists(F.coalesce("table.header_rows", F.array().cast("array<int>")), lambda i: (i < 0) | (i >= F.size(rows))))),
        ("no_empty_column_waterfall", "warn", failing(t, (blank > 0) & (blank < F.size(cols)))),
        ("markdown_projection_columns", "error", failing(t, (F.size(cols) > 0) & bad_md)),
    ], "4_audit")


def unresolved_gate(docs: DataFrame, issues: DataFrame, projected: DataFrame) -> DataFrame:
    """The ledger against its text: ``projected (doc_id, text)``."""
    from .ledger import render_unresolved

    open_, st, sev = ~F.col("status").eqNullSafe("fixed"), F.col("status"), F.col("severity")
    # the text is cut into lines once for a document; a row of the ledger meets its own lines, never the whole text
    lines = projected.select("doc_id", F.explode(F.split("text", "\n")).alias("line")).where(F.col("line").startswith("## ") | F.col("line").startswith("- issue: ")).distinct()
    heads = lines.select("doc_id", F.col("line").alias("_head"), F.lit(True).alias("_told"))
    withtext = issues.withColumn("_head", F.concat(F.lit("## "), F.col("id"))).join(heads, ["doc_id", "_head"], "left")
    told = F.coalesce("_told", F.lit(False))
    # an issue that is no line of its own (several lines, or text of another form) is sought in the whole text, once for each wording
    wanted = issues.where(open_).select("doc_id", "issue").distinct().withColumn("line", F.concat(F.lit("- issue: "), F.col("issue")))
    rest = wanted.join(lines, ["doc_id", "line"], "left_anti").groupBy("doc_id").agg(F.collect_set("issue").alias("issues")).join(projected.select("doc_id", "text"), "doc_id")
    sought = rest.select("doc_id", F.explode(F.filter("issues", lambda x: F.col("text").contains(x))).alias("issue"))
    said = wanted.join(lines, ["doc_id", "line"], "left_semi").select("doc_id", "issue").unionByName(sought).select("doc_id", "issue", F.lit(True).alias("_said")).distinct()
    unsaid = issues.where(open_).join(said, ["doc_id", "issue"], "left")
    same = render_unresolved(issues.withColumn("pos", F.coalesce("id", F.lit(""))) if "pos" not in issues.columns else issues).withColumnRenamed("text", "want").join(projected, "doc_id", "left")
    nothing = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    out = lambda c, words: ~F.coalesce(F.col(c).isin(*words), F.lit(False))
    return gate("unresolved", docs, [
        ("required_fields", "error", failing(issues, nothing("id") | sev.isNull() | st.isNull() | F.col("category").isNull() | F.col("issue").isNull())),
        ("unique_ids", "error", _twice(issues, "id")),
        ("severity_enum", "error", failing(issues, out("severity", SEVERITIES))),
        ("status_enum", "error", failing(issues, out("status", ISSUE_STATUS))),
        ("category_enum", "error", failing(issues, out("category", CATEGORIES))),
        ("unresolved_present", "error", _has(projected, docs)),
        ("unresolved_ids_projected", "error", failing(withtext, open_ & ~told)),
        ("fixed_ids_not_projected", "error", failing(withtext, ~open_ & told)),
        ("unresolved_issue_text_projected", "error", failing(unsaid, F.col("_said").isNull())),
        ("unresolved_projection_exact", "error", failing(same, ~F.col("want").eqNullSafe(F.col("text")), "doc_id")),
        ("no_open_blockers", "error", failing(issues, (sev == "blocker") & (st == "open"))),
        ("accepted_blockers_documented", "error", failing(issues, (sev == "blocker") & (st == "accepted") & (nothing("accepted_by") | nothing("accepted_reason")))),
        ("major_open_notes", "warn", failing(issues, (sev == "major") & (st == "open"))),
    ], "4_audit")


def quality_gate(docs: DataFrame, files: DataFrame) -> DataFrame:
    """Rendered text: ``files (doc_id, role, path, text)`` with role main or part."""
    t = F.col("text")
    marked = files.withColumn("_part", F.max((F.col("role") == "part").cast("int")).over(Q.doc_window()))
    own = marked.where((F.col("_part") == 0) | (F.col("role") == "part"))
    lone = lambda c: F.coalesce(c, F.lit(False))
    alts = F.transform(F.regexp_extract_all(t, F.lit(r"!\[([^\]]*)\]\(([^)]+)\)"), F.lit(1)), T.strip)
    tails = F.slice(F.split(t, r"!\[[^\]]*\]\([^)]+\)", -1), 2, 1_000_000)
    undescribed = F.exists(tails, lambda x: ~F.substring(x, 1, 500).contains(">") | F.substring(x, 1, 500).contains("未解析"))
    formulas = F.slice(F.split(t, r"(?s)\$\$\n.*?\n\$\$", -1), 2, 1_000_000)
    unanchored = F.exists(formulas, lambda x: ~F.substring(x, 1, 240).contains("〔源"))
    after_table = F.slice(F.split(t, r"(?m)^\|[ :|-]*---[ :|-]*$", -1), 2, 1_000_000)
    no_mark = F.exists(after_table, lambda x: ~F.get(F.split(x, r"(?m)^#{1,6} "), F.lit(0)).contains("〔源"))
    return gate("quality", docs, [
        ("main_or_parts_present", "error", _has(files, docs)),
        ("title_present", "error", failing(files.where("role = 'main'"), ~t.rlike(r"(?m)^# \S"), "path")),
        ("summary_present", "warn", failing(files.where("role = 'main'"), ~t.contains("**摘要**"), "path")),
        ("source_anchors_present", "error", failing(own, ~t.contains("〔源"), "path")),
        ("no_replacement_char", "error", failing(files, t.contains("�"), "path")),
        ("no_control_chars", "error", failing(files, T.control_chars(t) > 0, "path")),
        ("mojibake_risk_low", "warn", failing(files, t.rlike(T.MOJIBAKE), "path")),
        ("image_alts_present", "error", failing(files, F.exists(alts, lambda a: a == ""), "path")),
        ("image_descriptions_present", "warn", failing(files, lone(undescribed), "path")),
        ("tables_have_source_anchor", "error", failing(files, lone(no_mark), "path")),
        ("formulas_have_source_anchor", "error", failing(files, lone(unanchored), "path")),
    ], "5_assembly")


# Markers that must not be delivered.
VISION_MARK, TODO_MARK, UNRESOLVED_MARK, PENDING = r"\[VISION_PLACEHOLDER_[^\]]+\]", r"\[(?:TODO|todo)\]", r"\[未解析:[^\]]+\]", "待补充"


def placeholders_gate(docs: DataFrame, files: DataFrame, issues: DataFrame) -> DataFrame:
    """Markers in rendered text; an unresolved marker is documented if an unresolved issue holds it or its payload."""
    t = F.col("text")
    marks = files.select("doc_id", F.explode(F.array_distinct(F.regexp_extract_all(t, F.lit(UNRESOLVED_MARK), F.lit(0)))).alias("mark")).distinct()
    marks = marks.withColumn("payload", T.strip(F.regexp_extract("mark", r"^\[未解析:(.*)\]\z", 1)))
    hay = issues.where(~F.col("status").eqNullSafe("fixed")).groupBy("doc_id").agg(F.array_join(F.collect_list(F.concat_ws("\n", "id", "issue", "required_action")), "\n\n").alias("hay"))
    open_marks = marks.join(hay, "doc_id", "left").where(~F.coalesce(F.col("hay").contains(F.col("mark")) | F.col("hay").contains(F.col("payload")), F.lit(False)))
    return gate("placeholders", docs, [
        ("main_or_parts_present", "error", _has(files, docs)),
        ("no_vision_placeholders", "error", failing(files, t.rlike(VISION_MARK), "path")),
        ("no_todo_markers", "error", failing(files, t.rlike(TODO_MARK), "path")),
        ("no_pending_text", "error", failing(files, t.contains(PENDING), "path")),
        ("no_replacement_char", "error", failing(files, t.contains("�"), "path")),
        ("no_control_chars", "error", failing(files, T.control_chars(t) > 0, "path")),
        ("unresolved_markers_documented", "error", failing(open_marks, F.lit(True), "mark")),
        ("unresolved_markers_present", "warn", failing(marks, F.lit(True), "mark")),
    ], "5_assembly")


def links_markdown_gate(docs: DataFrame, files: DataFrame, paths: DataFrame) -> DataFrame:
    """Links of rendered files: ``files (doc_id, role, path, text)``, ``paths (doc_id, path)`` all delivered files."""
    bad_local, bad_anchor, names = Q.link_errors(files, paths)
    return gate("links_markdown", docs, [
        ("main_present", "error", _has(files.where("role = 'main'"), docs)),
        ("local_links_resolve", "error", failing(bad_local, F.lit(True), "target")),
        ("inpage_anchors_resolve", "error", failing(bad_anchor, F.lit(True), "target")),
        ("asset_names_conform", "warn", failing(names, ~bind.valid_asset_name(F.col("name")), "name")),
    ])


def audit_summary_gate(docs: DataFrame, summary: DataFrame, tools=("audit_tables", "audit_formulas", "audit_assets", "audit_provenance")) -> DataFrame:
    """``summary (doc_id, tool, exit_code)``: every tool ran, and ended with 0 or 2."""
    want = docs.select("doc_id").distinct().select("doc_id", F.explode(F.array(*map(F.lit, tools))).alias("tool"))
    return gate("audit_summary", docs, [
        ("audit_summary_present", "error", _has(summary, docs)),
        ("all_special_audits_ran", "error", failing(want.join(summary.select("doc_id", "tool").distinct(), ["doc_id", "tool"], "left_anti"), F.lit(True), "tool")),
        ("audit_tool_exits_ok", "error", failing(summary, ~F.coalesce(F.col("exit_code").isin(0, 2), F.lit(False)), "tool")),
    ], "4_audit")


def state_gate(jobs: DataFrame) -> DataFrame:
    """``jobs (doc_id, current_phase, phase_status map, profile_status, confirmed_by, risk, n_risk_history)``."""
    m, cur = F.col("phase_status"), F.col("current_phase")
    names = F.array(*map(F.lit, PHASES))
    at = F.array_position(names, cur)
    known = at > 0
    status = lambda p: F.try_element_at(m, p)
    numbered = F.transform(names, lambda p, i: F.struct(p.alias("p"), (i + 1).alias("i")))
    skip = lambda side, want: F.exists(numbered, lambda x: (x["i"] < at if side < 0 else x["i"] > at) & ~status(x["p"]).eqNullSafe(want))
    sound = known & (F.array_sort(F.map_keys(m)) == F.array_sort(names)) & F.forall(F.map_values(m), lambda v: v.isin(*PHASE_STATUS))
    return gate("state", jobs, [
        ("current_phase_enum", "error", failing(jobs, ~known, "current_phase")),
        ("phase_status_keys", "error", failing(jobs, ~(F.array_sort(F.map_keys(m)) == F.array_sort(names)), "doc_id")),
        ("phase_status_values", "error", failing(jobs, F.exists(F.map_values(m), lambda v: ~F.coalesce(v.isin(*PHASE_STATUS), F.lit(False))), "doc_id")),
        ("no_skip_before", "error", failing(jobs, sound & skip(-1, "done"), "doc_id")),
        ("no_skip_after", "error", failing(jobs, sound & skip(1, "pending"), "doc_id")),
        ("current_status_active", "error", failing(jobs, sound & ~F.coalesce(status(cur).isin("in_progress", "done", "failed"), F.lit(False)), "doc_id")),
        ("profile_status_enum", "error", failing(jobs, ~F.coalesce(F.col("profile_status").isin("provisional", "confirmed"), F.lit(False)), "doc_id")),
        ("confirmed_by_set", "error", failing(jobs, (F.col("profile_status") == "confirmed") & (F.coalesce("confirmed_by", F.lit("")) == ""), "doc_id")),
        ("risk_level_enum", "error", failing(jobs, ~F.coalesce(F.col("risk").isin("low", "medium", "high"), F.lit(False)), "doc_id")),
        ("risk_history_present", "warn", failing(jobs, F.coalesce("n_risk_history", F.lit(0)) == 0, "doc_id")),
    ])


def manifest_gate(manifests: DataFrame, final: bool, paths: DataFrame | None = None) -> DataFrame:
    """``manifests (doc_id, stage, slug, main, sources array<struct<path,sha256,bytes>>, outputs array<string>, input_hashes
    map)``; for the final stage ``paths (doc_id, path)`` lists what exists."""
    src = F.coalesce("sources", F.array().cast("array<struct<path:string,sha256:string,bytes:long>>"))
    if not final:
        return gate("manifest_draft", manifests, [
            ("stage", "error", failing(manifests, ~F.coalesce(F.col("stage").isin("draft", "final"), F.lit(False)), "doc_id")),
            ("document_slug", "error", failing(manifests, F.coalesce("slug", F.lit("")) == "", "doc_id")),
            ("sources_nonempty", "error", failing(manifests, F.size(src) == 0, "doc_id")),
            ("source_sha256", "error", failing(manifests, F.exists(src, lambda s: ~F.coalesce(s["sha256"].rlike("^[0-9a-f]{64}\\z"), F.lit(False))), "doc_id")),
            ("source_bytes", "warn", failing(manifests, F.exists(src, lambda s: ~F.coalesce(s["bytes"] >= 0, F.lit(False))), "doc_id")),
        ], "0_intake")
    named = manifests.select("doc_id", F.explode("outputs").alias("path")).distinct()
    absent = named.join(paths.select("doc_id", "path").distinct(), ["doc_id", "path"], "left_anti")
    return gate("manifest_final", manifests, [
        ("stage_is_final", "error", failing(manifests, ~F.col("stage").eqNullSafe("final"), "doc_id")),
        ("main_set", "error", failing(manifests, F.coalesce("main", F.lit("")) == "", "doc_id")),
        ("outputs_exist", "error", failing(absent, F.lit(True), "path")),
        ("input_hashes_present", "error", failing(manifests, F.coalesce(F.size("input_hashes"), F.lit(0)) <= 0, "doc_id")),
    ], "6_validation")


def package_gate(docs: DataFrame, manifest: DataFrame, delivered: DataFrame, issues: DataFrame, leaks: DataFrame, required=("main.md", "index.md", "index.json", "provenance.json", "manifest.json", "unresolved.md")) -> DataFrame:
    """``manifest (doc_id, path, sha256)`` hashes, ``delivered (doc_id, path, sha256)`` what is on disk."""
    want = docs.select("doc_id").distinct().select("doc_id", F.explode(F.array(*map(F.lit, required))).alias("path"))
    there = delivered.select("doc_id", "path").distinct()
    listed = delivered.where("path <> 'manifest.json'")
    both = listed.join(manifest.withColumnRenamed("sha256", "said"), ["doc_id", "path"])
    sev, st = F.col("severity"), F.col("status")
    nothing = lambda c: F.coalesce(F.col(c), F.lit("")) == ""
    return gate("package", docs, [
        ("output_present", "error", failing(want.join(there, ["doc_id", "path"], "left_anti"), F.lit(True), "path")),
        ("manifest_output_hashes_complete", "error", failing(listed.join(manifest.select("doc_id", "path"), ["doc_id", "path"], "left_anti"), F.lit(True), "path")),
        ("manifest_output_files_present", "error", failing(manifest.join(there, ["doc_id", "path"], "left_anti"), F.lit(True), "path")),
        ("manifest_output_hashes_current", "error", failing(both, F.col("said") != F.col("sha256"), "path")),
        ("no_local_path_leaks", "error", failing(leaks, F.lit(True), "pattern")),
        ("no_open_blockers", "error", failing(issues, (sev == "blocker") & (st == "open"))),
        ("accepted_blockers_documented", "error", failing(issues, (sev == "blocker") & (st == "accepted") & (nothing("accepted_by") | nothing("accepted_reason")))),
    ], "7_package")


def visual_gate(jobs: DataFrame, diagnostics: DataFrame, anchors: DataFrame, artifacts: DataFrame, paths: DataFrame, issues: DataFrame) -> DataFrame:
    """``jobs (doc_id, risk)``, ``diagnostics (doc_id, status)``, ``anchors (doc_id)``, ``artifacts (doc_id, path)``."""
    seen = jobs.join(diagnostics, "doc_id", "left")
    high = F.col("risk") == "high"
    absent = artifacts.select("doc_id", "path").distinct().join(paths.select("doc_id", "path").distinct(), ["doc_id", "path"], "left_anti")
    return gate("visual", jobs, [
        ("risk_level_valid", "error", failing(jobs, ~F.coalesce(F.col("risk").isin("low", "medium", "high"), F.lit(False)), "doc_id")),
        ("visual_status_not_fail", "error", failing(seen, F.coalesce("status", F.lit("fail")) == "fail", "doc_id")),
        ("high_risk_visual_status_pass", "error", failing(seen, high & ~F.col("status").eqNullSafe("pass"), "doc_id")),
        ("visual_warnings", "warn", failing(seen, F.col("status") == "pass_with_notes", "doc_id")),
        ("visual_artifacts_listed", "error", _has(artifacts, jobs.where(high))),
        ("visual_artifacts_exist", "error", failing(absent, F.lit(True), "path")),
        ("anchors_nonempty", "error", _has(anchors, jobs)),
        ("no_open_blockers", "error", failing(issues, (F.col("severity") == "blocker") & (F.col("status") == "open"))),
        ("major_open_notes", "warn", failing(issues, (F.col("severity") == "major") & (F.col("status") == "open"))),
    ], "6_validation")


def stale_gate(docs: DataFrame, diffs: DataFrame) -> DataFrame:
    """``diffs (doc_id, path, change)`` of hashed inputs."""
    return gate("stale", docs, [("phase_inputs_fresh", "error", failing(diffs, F.lit(True), "path"))])


__all__ = [n for n in dir() if n.endswith("_gate")] + ["gate", "gate_status", "failing", "PHASE_GATES", "anchor_text"]
