"""Structural quality of Markdown text: metrics, titles, contents, opening noise, links, golden checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

# Patterns of the metrics and of noisy opening lines.
PLACEHOLDER = r"\[VISION_PLACEHOLDER_[^\]]*\]|\[TODO\]|\[未解析:[^\]]+\]|�"
METRICS = {"h1": r"(?m)^# ", "headings": r"(?m)^#{1,6} ", "source_anchors": "〔源 ", "tables": r"(?m)^\|.*\|$", "image_refs": r"!\[", "placeholders": PLACEHOLDER}
TOC_HEAD = r"^#{2,3}\s*(目录|分卷目录)\s*\z"
TOC_ITEM = r"^\s*-\s+\[[^\]]+\]\([^)]+\)"
SUMMARY = r"^>\s*\*\*摘要\*\*"
NOISE = (
    r"(?i)^(pdf|docx?|document|table of contents|目录)\z", r"(?i)^(第\s*)?\d+\s*(页|/)\s*\d*\z", r"(?i)^page\s+\d+(\s+of\s+\d+)?\z",
    r"^\d+(\.\d+)*\s+.{2,80}\s+\.{0,}\s*\d{1,4}\z", r"(?i)^[\w.-]+\.pdf\z", r"(?i)^(confidential|copyright|www\.)",
)
OPENING = 40


def doc_window():
    return W.partitionBy("doc_id")


def metric_columns(text: Column) -> dict[str, Column]:
    out = {k: F.regexp_count(text, F.lit(p)).cast("long") for k, p in METRICS.items()}
    out["formula_markers"] = (F.regexp_count(text, F.lit(r"\$\$")) + F.regexp_count(text, F.lit(r"\\\(.+?\\\)"))).cast("long")
    return out


def metrics(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, text)``: one pass, no exchange."""
    return docs.select("doc_id", *[c.alias(k) for k, c in metric_columns(F.col("text")).items()])


def title_report(docs: DataFrame) -> DataFrame:
    t = F.col("text")
    front = T.clean_title(F.regexp_extract(t, r"(?m)^title:\s*(.+?)\s*$", 1))
    heads = F.transform(F.regexp_extract_all(t, F.lit(r"(?m)^# (.+?)\s*$"), F.lit(1)), T.clean_title)
    h1 = F.coalesce(F.get(F.filter(heads, lambda x: x != ""), F.lit(0)), F.lit(""))
    rows = docs.select("doc_id", front.alias("front_matter_title"), h1.alias("first_h1"))
    f, h = F.col("front_matter_title"), F.col("first_h1")
    return rows.withColumn("ok", ((f == "") | ~T.generic_title(f)) & (h != "") & ~T.generic_title(h))


def numbered_lines(docs: DataFrame) -> DataFrame:
    rows = docs.select("doc_id", F.posexplode(T.lines(F.col("text"))).alias("ln", "line"))
    return rows.withColumn("s", T.strip(F.col("line")))


def _runs() -> W:
    return W.partitionBy("doc_id").orderBy("ln").rowsBetween(W.unboundedPreceding, 0)


def toc_entries(docs: DataFrame) -> DataFrame:
    """Items of the first contents block of each document with indent and text."""
    head = F.col("s").rlike(TOC_HEAD)
    rows = numbered_lines(docs).withColumn("_in", F.max(head.cast("int")).over(_runs()))
    stop = (F.col("_in") == 1) & ((F.col("s") == "---") | (F.col("s").startswith("#") & ~head))
    rows = rows.withColumn("_out", F.max(stop.cast("int")).over(_runs()))
    items = rows.where("_in = 1 and _out = 0").where(F.col("s").rlike(TOC_ITEM))
    indent = F.length("line") - F.length(F.regexp_replace("line", "^ +", ""))
    return items.select("doc_id", "ln", indent.alias("indent"), T.strip(F.regexp_extract("s", r"^-\s+\[([^\]]+)\]", 1)).alias("item"))


def toc_coherence(docs: DataFrame) -> DataFrame:
    """Whether the top level of the contents holds labels, or section numbers that fall but not back to 1."""
    e = toc_entries(docs).withColumn("_min", F.min("indent").over(doc_window()))
    top = e.where("indent = _min").withColumn("label", T.caption_label(F.col("item")))
    top = top.withColumn("num", F.regexp_extract("item", r"^(\d+)(?:[.\s]|\z)", 1).try_cast("decimal(38,0)"))
    prev = F.last("num", ignorenulls=True).over(W.partitionBy("doc_id").orderBy("ln").rowsBetween(W.unboundedPreceding, -1))
    top = top.withColumn("falls", F.coalesce((F.col("num") < prev) & (F.col("num") != 1), F.lit(False)))
    got = top.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_top"), F.count_if("label").alias("n_labels"), F.count_if("falls").alias("n_falls"))
    rows = docs.select("doc_id").join(got, "doc_id", "left").na.fill(0, ["n_top", "n_labels", "n_falls"])
    return rows.withColumn("ok", (F.col("n_labels") == 0) & (F.col("n_falls") == 0))


def noise_line(s: Column) -> Column:
    clean = T.strip(F.regexp_replace(F.regexp_replace(s, T.SOURCE_MARK, ""), r"^[#>\-* ]+", ""))
    clean = F.regexp_replace(clean, r"^[`*_ ]+|[`*_ ]+\z", "")
    hit = F.lit(False)
    for p in NOISE:
        hit = hit | clean.rlike(p)
    return hit & ~s.startswith("![") & ~s.startswith("|") & ~s.startswith("$$")


def candidate_lines(docs: DataFrame) -> DataFrame:
    """Lines that count as a document's opening: front matter, summary and contents are left out."""
    rows = numbered_lines(docs)
    run, s = _runs(), F.col("s")
    front = F.first(s).over(W.partitionBy("doc_id").orderBy("ln").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)) == "---"
    rules = F.sum((s == "---").cast("int")).over(run)
    total = F.sum((s == "---").cast("int")).over(doc_window())
    rows = rows.withColumns({"_front": front & (total >= 2) & (rules < 2), "_second": front & (total >= 2) & (s == "---") & (rules == 2)})
    rows = rows.where("not _front and not _second")
    # a summary lasts to the first line that is neither quoted nor blank; a table of contents to the next rule
    head = s.rlike(SUMMARY)
    plain = ~s.startswith(">") & (s != "")
    last_sum = F.last(F.when(head, 1).when(plain, 0), ignorenulls=True).over(run)
    rows = rows.withColumn("_sum", F.coalesce(last_sum == 1, F.lit(False)))
    last_toc = F.last(F.when(s.rlike(TOC_HEAD) & ~F.col("_sum"), 1).when(s == "---", 0), ignorenulls=True).over(run)
    rows = rows.withColumn("_toc", F.coalesce(last_toc == 1, F.lit(False)))
    return rows.where(~F.col("_sum") & ~F.col("_toc") & (s != "---") & (s != "")).select("doc_id", "ln", "s")


def opening_noise(docs: DataFrame) -> DataFrame:
    """Noise in the first forty counted lines of each document."""
    lines = candidate_lines(docs).withColumn("k", F.row_number().over(W.partitionBy("doc_id").orderBy("ln"))).where(F.col("k") <= OPENING)
    got = lines.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sample_size"), F.count_if(noise_line(F.col("s"))).alias("noisy_count"))
    rows = docs.select("doc_id").join(got, "doc_id", "left").na.fill(0, ["sample_size", "noisy_count"])
    density = F.when(F.col("sample_size") > 0, F.col("noisy_count") / F.col("sample_size")).otherwise(0.0)
    return rows.select("doc_id", "sample_size", "noisy_count", F.bround(density, 3).alias("density"), ((F.col("noisy_count") < 3) | (density < 0.18)).alias("ok"))


def baseline_delta(docs: DataFrame, baseline: DataFrame) -> DataFrame:
    """Metrics of ``docs`` against those of ``baseline``, both (doc_id, text)."""
    b = metrics(baseline)
    names = [c for c in b.columns if c != "doc_id"]
    both = metrics(docs).join(b.select("doc_id", *[F.col(c).alias("b_" + c) for c in names]), "doc_id")
    total = lambda p: sum((F.col(p + c) for c in ("headings", "tables", "image_refs")), F.col(p + "formula_markers"))
    trace = (F.col("source_anchors") > 0) & (F.col("source_anchors") >= F.greatest(F.lit(1), F.floor(F.col("b_source_anchors") / 2)))
    floor = total("") >= F.greatest(F.lit(1), F.least(total("b_"), F.lit(5)))
    worse = F.col("placeholders") <= F.col("b_placeholders")
    return both.select("doc_id", *[(F.col(c) - F.col("b_" + c)).alias("d_" + c) for c in names], trace.alias("traceable"), floor.alias("structured"), worse.alias("no_new_placeholders"), (trace & floor & worse).alias("ok"))


LINK = r"!?\[[^\]]*\]\(([^)]+)\)"


def links(files: DataFrame) -> DataFrame:
    """Links of ``files (doc_id, path, text)`` with their kind: external, inpage or local."""
    rows = files.select("doc_id", "path", F.explode(F.regexp_extract_all("text", F.lit(LINK), F.lit(1))).alias("target"))
    kind = F.when(F.col("target").rlike("^[a-z]+://"), "external").when(F.col("target").startswith("#"), "inpage").otherwise("local")
    return rows.withColumn("kind", kind)


def resolved_path(path: Column, target: Column) -> Column:
    """The path that a relative target means, seen from a file; ``.`` and ``..`` are folded."""
    parts = F.filter(F.split(F.concat(F.regexp_extract(path, r"^(.*/)?", 1), target), "/"), lambda x: (x != "") & (x != "."))
    empty = F.array().cast("array<string>")
    fold = F.aggregate(parts, empty, lambda a, x: F.when((x == "..") & (F.size(a) > 0), F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).otherwise(F.array_append(a, x)))
    return F.array_join(fold, "/")


def link_errors(files: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Local targets that do not exist, in-page targets without an anchor in the same file, names of linked assets."""
    all_links = links(files)
    local = all_links.where("kind = 'local'").withColumn("target", F.regexp_replace("target", "#.*", "")).where("target <> ''")
    local = local.withColumn("at", resolved_path(F.col("path"), F.col("target")))
    bad_local = local.join(paths.select("doc_id", F.col("path").alias("at")).distinct(), ["doc_id", "at"], "left_anti")
    ids = files.select("doc_id", "path", F.explode(F.regexp_extract_all("text", F.lit('id="([^"]+)"'), F.lit(1))).alias("target"))
    heads = files.select("doc_id", "path", F.explode(F.regexp_extract_all("text", F.lit(r"(?m)^#{1,6} (.+?)\s*$"), F.lit(1))).alias("h"))
    slug = heads.select("doc_id", "path", T.gfm_slug(T.strip(F.regexp_replace("h", T.SOURCE_MARK, ""))).alias("target"))
    inpage = all_links.where("kind = 'inpage'").withColumn("target", F.substring("target", 2, 10_000))
    bad_anchor = inpage.join(ids.unionByName(slug).distinct(), ["doc_id", "path", "target"], "left_anti")
    names = local.where(F.col("target").contains("assets/")).withColumn("name", T.base_name(F.col("target")))
    return bad_local, bad_anchor, names


LOW = 0.8


def untracked(blocks: DataFrame, issues: DataFrame) -> DataFrame:
    """Blocks that need tracking (a review, or low confidence) without an unresolved issue."""
    low = blocks.where(~F.coalesce("content.likely_noise", F.lit(False)) & (F.coalesce("needs_review", F.lit(False)) | (F.coalesce("confidence", F.lit(0.0)) < LOW)))
    open_ = issues.where(~F.col("status").eqNullSafe("fixed")).select("doc_id", F.col("source_block_id").alias("id")).distinct()
    return low.join(open_, ["doc_id", "id"], "left_anti").select("doc_id", "id", "type")


def golden(docs: DataFrame, blocks: DataFrame, issues: DataFrame, files: DataFrame, baseline: DataFrame | None = None, expect: tuple[str, ...] = ()) -> DataFrame:
    """The golden checks of each document of ``docs (doc_id, text)`` with its score and status.

    ``files (doc_id, path)``: what exists; ``expect``: kinds that must occur (figure, formula, register)."""
    m = metrics(docs)
    t = title_report(docs).select("doc_id", F.col("ok").alias("title_ok"))
    toc = toc_entries(docs).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_toc"))
    c = toc_coherence(docs).select("doc_id", F.col("ok").alias("toc_ok"))
    o = opening_noise(docs).select("doc_id", F.col("ok").alias("opening_ok"))
    there = files.select("doc_id", F.col("path").alias("_path"), F.lit(True).alias("_there")).distinct()
    b = blocks.withColumn("_path", F.col("figure.asset_file")).join(there, ["doc_id", "_path"], "left")
    fig, form = F.col("type") == "figure", F.col("type") == "formula"
    reg = (F.col("type") == "table") & (F.col("table.hard_table_type") == "register")
    blank = lambda x: F.coalesce(F.col(x), F.lit("")) == ""
    latex = F.coalesce("formula.latex", F.lit(""))
    per = b.groupBy("doc_id").agg(
        F.count_if(F.col("type") == "heading").alias("n_heads"), F.count_if(fig).alias("n_fig"), F.count_if(form).alias("n_form"), F.count_if(reg).alias("n_reg"),
        F.count_if(fig & F.col("_there").isNull()).alias("fig_lost"), F.count_if(fig & (blank("figure.caption") | blank("figure.description"))).alias("fig_bare"),
        F.count_if(form & ((T.strip(latex) == "") | ~T.latex_balanced(latex))).alias("form_bad"), F.count_if(reg & ~F.col("table.hard_column_check").eqNullSafe("pass")).alias("reg_bad"),
    )
    low = untracked(blocks, issues).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_low"))
    bad_links = link_errors(docs.withColumn("path", F.lit("main.md")), files)[0].groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_links"))
    rows = docs.select("doc_id", F.col("text").rlike("(?m)" + SUMMARY).alias("summary"))
    for other in (m, t, toc, c, o, per, low, bad_links):
        rows = rows.join(other, "doc_id", "left")
    n = lambda k: F.coalesce(k, F.lit(0))
    checks = {
        "main_present": F.lit(True), "main_has_h1": n("h1") >= 1, "main_has_meaningful_title": F.col("title_ok"), "main_has_summary_block": F.col("summary"),
        "main_has_nonempty_toc": ~((n("headings") > 1) | (n("n_heads") > 0)) | (n("n_toc") > 0), "toc_structurally_coherent": F.col("toc_ok"), "opening_noise_density_ok": F.col("opening_ok"),
        "main_has_source_anchors": n("source_anchors") > 0, "main_has_no_placeholders": n("placeholders") == 0,
        "figures_expected": (n("n_fig") > 0) if "figure" in expect else F.lit(True), "figure_assets_complete": n("fig_lost") == 0, "figure_descriptions_complete": n("fig_bare") == 0,
        "formulas_expected": (n("n_form") > 0) if "formula" in expect else F.lit(True), "formulas_latex_balanced": n("form_bad") == 0,
        "register_tables_expected": (n("n_reg") > 0) if "register" in expect else F.lit(True), "register_tables_audited": n("reg_bad") == 0,
        "markdown_links_resolve": n("n_links") == 0, "low_confidence_tracked": n("n_low") == 0,
    }
    if baseline is not None:
        rows = rows.join(baseline_delta(docs, baseline).select("doc_id", F.col("ok").alias("base_ok")), "doc_id", "left")
        checks["baseline_criteria_pass"] = F.coalesce("base_ok", F.lit(True))
    else:
        checks["baseline_criteria_pass"] = F.lit(True)
    passed = sum((F.coalesce(v, F.lit(False)).cast("int") for v in checks.values()), F.lit(0))
    failed = F.filter(F.array(*[F.when(~F.coalesce(v, F.lit(False)), k) for k, v in checks.items()]), lambda x: x.isNotNull())
    return rows.select("doc_id", F.bround(passed / len(checks), 3).alias("score"), F.when(passed == len(checks), "pass").otherwise("fail").alias("status"), F.array_join(failed, ",").alias("failed_checks"))
