"""Semantic rewrites of the block table: noise, promoted headings, levels, tables over pages, formulas, figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from .project import location

MIN_REPEATS = 3
NOISE_ZONES = ("header", "footer")
# Terms of figures that are artefacts of a document, and the caption form of descriptions.
ARTEFACT_TERMS = ("logo", "brand", "品牌", "商标", "印章", "盖章", "签章", "专用章", "stamp", "seal", "水印", "装饰", "背景图", "背景水印", "不含数据", "decorative", "watermark")
DESCRIBED_CAPTION = r"^\s*((图|Figure|Fig\.?)\s*[0-9A-Za-z][0-9A-Za-z.\-]*)\s*[:：.]\s*([^\n]+)"
AUTO_REASONS = ("decorative_or_document_artifact", "duplicate_asset")


def flag_noise(blocks: DataFrame) -> DataFrame:
    """Paragraphs whose text a document repeats three times or more, in a header or footer zone, or page links."""
    text = T.strip(F.coalesce("content.text", F.lit("")))
    open_para = (F.col("type") == "para") & (F.coalesce("content.is_caption_for", F.lit("")) == "")
    counted = open_para & (text != "")
    n = F.count(F.when(counted, 1)).over(W.partitionBy("doc_id", F.xxhash64(text), text))
    noise = open_para & ((counted & (n >= MIN_REPEATS)) | F.coalesce(F.col("source_zone").isin(*NOISE_ZONES), F.lit(False)) | text.startswith("> [页面链接]"))
    rows = blocks.withColumn("_noise", noise)
    content = F.when(F.col("_noise"), F.col("content").withField("likely_noise", F.lit(True))).otherwise(F.col("content"))
    return rows.withColumns({"content": content, "needs_review": F.col("needs_review") | F.col("_noise")}).drop("_noise")


def section_level(text: Column) -> Column:
    """Level of a numbered section heading, null if the text is none."""
    s = T.strip(text)
    number, title = F.regexp_extract(s, r"^(\d+(?:\.\d+)*)\s+(.{2,80})\z", 1), T.strip(F.regexp_extract(s, r"^(\d+(?:\.\d+)*)\s+(.{2,80})\z", 2))
    bare = ~number.contains(".")
    prose = bare & ((F.coalesce(number.try_cast("decimal(38,0)"), F.lit(100)) > 99) | (F.size(F.split(title, T.WS + "+")) >= 6))
    ok = (number != "") & (F.length(s) <= 96) & ~s.contains("...") & ~s.contains("www.") & ~T.caption_label(s) & ~prose & ~title.rlike(r"[。．.!?！？]\z")
    return F.when(ok, F.least(F.lit(6), F.regexp_count(number, F.lit(r"\.")) + 1))


def promote_headings(blocks: DataFrame) -> DataFrame:
    """Numbered paragraphs that are section headings become headings; their ids stay."""
    c = F.col("content")
    free = (F.col("type") == "para") & ~F.coalesce(c["likely_noise"], F.lit(False)) & ~F.coalesce(c["quote"], F.lit(False)) & ~F.coalesce(F.col("source_zone").isin(*NOISE_ZONES), F.lit(False))
    rows = blocks.withColumn("_level", F.when(free, section_level(c["text"])))
    up = F.col("_level").isNotNull()
    head = F.struct(F.col("_level").cast("int").alias("level"), T.strip(c["text"]).alias("text"), F.lit(None).cast("int").alias("raw_level"))
    return rows.withColumns({"type": F.when(up, "heading").otherwise(F.col("type")), "heading": F.when(up, head).otherwise(F.col("heading")), "content": F.when(~up, c)}).drop("_level")


def normalize_levels(blocks: DataFrame) -> DataFrame:
    """Heading levels of a document become consecutive; the old one is kept where it changes."""
    rank = F.dense_rank().over(W.partitionBy("doc_id", F.col("type") == "heading").orderBy("heading.level"))
    rows = blocks.withColumn("_rank", rank)
    h = F.col("heading")
    new = F.when(F.col("_rank") != h["level"], h.withField("raw_level", h["level"]).withField("level", F.col("_rank"))).otherwise(h)
    return rows.withColumn("heading", F.when(F.col("type") == "heading", new)).drop("_rank")


def link_tables(blocks: DataFrame) -> DataFrame:
    """Neighbouring tables with the same columns in different places continue each other."""
    w = W.partitionBy("doc_id", F.col("type") == "table").orderBy("ord")
    me = F.struct("id", F.col("table.columns").alias("columns"), location(F.col("source_anchor")).alias("at"))
    rows = blocks.withColumn("_me", me).withColumns({"_p": F.lag("_me").over(w), "_n": F.lead("_me").over(w)})
    runs_on = lambda a, b: F.coalesce((a["columns"] == b["columns"]) & (F.size(a["columns"]) > 0) & ~a["at"].eqNullSafe(b["at"]), F.lit(False))
    t = F.col("table")
    new = t.withField("continues_from", F.when(runs_on(F.col("_p"), F.col("_me")), F.col("_p.id"))).withField("continues_to", F.when(runs_on(F.col("_me"), F.col("_n")), F.col("_n.id")))
    return rows.withColumn("table", F.when(F.col("type") == "table", new)).drop("_me", "_p", "_n")


def normalize_formulas(blocks: DataFrame) -> DataFrame:
    """Delimiters go; numbers are given only where no formula of the document has one; reviews are only added."""
    f, is_f = F.col("formula"), F.col("type") == "formula"
    doc = W.partitionBy("doc_id", is_f)
    numbered = F.max((F.coalesce(f["equation_no"], F.lit("")) != "").cast("int")).over(doc)
    n = F.row_number().over(doc.orderBy("ord"))
    rows = blocks.withColumns({"_some": numbered, "_n": n, "_latex": T.latex_strip(F.coalesce(f["latex"], F.lit("")))})
    ok = T.latex_balanced(F.col("_latex")) & (F.col("_latex") != "")
    number = F.when(F.col("_some") == 0, F.col("_n").cast("string")).otherwise(f["equation_no"])
    new = f.withField("latex", F.col("_latex")).withField("equation_no", number).withField("visual_check", F.when(ok, "ok").otherwise("needs_review"))
    review = F.when(is_f, F.col("needs_review") | ~ok).otherwise(F.col("needs_review"))
    return rows.withColumns({"needs_review": review, "formula": F.when(is_f, new)}).drop("_some", "_n", "_latex")


def backfill_figures(blocks: DataFrame, cache: DataFrame) -> DataFrame:
    """Descriptions of ``cache (doc_id, file, text)`` by the name of the current, else the original file."""
    some = cache.where(T.strip(F.col("text")) != "").select("doc_id", "file", "text")
    a = some.select("doc_id", F.col("file").alias("_a"), F.col("text").alias("_ta"))
    b = some.select("doc_id", F.col("file").alias("_b"), F.col("text").alias("_tb"))
    f, is_f = F.col("figure"), F.col("type") == "figure"
    rows = blocks.withColumns({"_a": T.base_name(f["asset_file"]), "_b": T.base_name(f["original_asset_file"])}).join(a, ["doc_id", "_a"], "left").join(b, ["doc_id", "_b"], "left")
    rows = rows.withColumn("_d", F.when(is_f, F.coalesce("_ta", "_tb")))
    d = F.col("_d")
    head = T.strip(F.regexp_extract(d, DESCRIBED_CAPTION, 1))
    parsed = d.rlike(DESCRIBED_CAPTION) & (F.coalesce(f["caption"], F.lit("")) == "")
    new = f.withField("description", d)
    new = F.when(parsed, new.withField("figure_no", F.coalesce(F.nullif(f["figure_no"], F.lit("")), head)).withField("caption", F.concat(head, F.lit("："), T.strip(F.regexp_extract(d, DESCRIBED_CAPTION, 3))))).otherwise(new)
    review = F.when(d.isNotNull(), F.lit(False)).when(is_f & (F.coalesce(f["description"], F.lit("")) == ""), F.lit(True)).otherwise(F.col("needs_review"))
    confidence = F.when(d.isNotNull(), F.greatest(F.coalesce("confidence", F.lit(0.0)), F.lit(0.85))).otherwise(F.col("confidence"))
    return rows.withColumns({"confidence": confidence, "needs_review": review, "figure": F.when(d.isNotNull(), new).otherwise(f)}).drop("_a", "_b", "_ta", "_tb", "_d")


def mark_figure_noise(blocks: DataFrame, hashes: DataFrame) -> DataFrame:
    """Artefacts by their words, then the second and later figures with the same content hash.

    ``hashes (doc_id, path, sha256)`` lists the asset files.  Automatic reasons are set anew each time."""
    f, is_f = F.col("figure"), F.col("type") == "figure"
    h = hashes.select("doc_id", F.col("path").alias("_path"), F.col("sha256").alias("_sha")).dropDuplicates(["doc_id", "_path"])
    rows = blocks.withColumn("_path", f["asset_file"]).join(h, ["doc_id", "_path"], "left")
    words = F.lower(F.concat_ws(" ", f["figure_no"], f["caption"], f["description"]))
    artefact = F.exists(F.array(*map(F.lit, ARTEFACT_TERMS)), lambda t: words.contains(t))
    nth = F.row_number().over(W.partitionBy("doc_id", is_f, "_sha").orderBy("ord"))
    reason = F.when(is_f & artefact, AUTO_REASONS[0]).when(is_f & F.col("_sha").isNotNull() & (nth > 1), AUTO_REASONS[1])
    rows = rows.withColumn("_why", reason)
    auto = F.coalesce(f["noise_reason"].isin(*AUTO_REASONS), F.lit(False))
    clean = F.when(auto, f.withField("likely_noise", F.lit(None).cast("boolean")).withField("noise_reason", F.lit(None).cast("string"))).otherwise(f)
    new = F.when(F.col("_why").isNotNull(), f.withField("likely_noise", F.lit(True)).withField("noise_reason", F.col("_why"))).otherwise(clean)
    return rows.withColumn("figure", F.when(is_f, new)).drop("_path", "_sha", "_why")


def semantic_compile(blocks: DataFrame) -> DataFrame:
    """Noise, then promotion, then levels, then tables and formulas: noise is counted before anything is promoted."""
    return normalize_formulas(link_tables(normalize_levels(promote_headings(flag_noise(blocks)))))
