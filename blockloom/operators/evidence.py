"""Anchors in rendered text, samples of them, and the source blocks that they show."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from .project import anchor_text

SAMPLES = 3
SNIPPET = 2000
LINE = 1000


def anchor_map(files: DataFrame) -> DataFrame:
    """Every marker of ``files (doc_id, file_no, file, text)`` in order of file, line and place, numbered by document."""
    rows = files.select("doc_id", "file_no", "file", F.posexplode(T.lines(F.col("text"))).alias("ln", "line"))
    rows = rows.select("doc_id", "file_no", "file", "ln", "line", F.posexplode(F.regexp_extract_all("line", F.lit("〔源 ([^〕]+)〕"), F.lit(1))).alias("at", "source_anchor"))
    n = F.row_number().over(W.partitionBy("doc_id").orderBy("file_no", "ln", "at"))
    return rows.select("doc_id", F.format_string("anchor_%04d", n).alias("anchor_id"), n.alias("n"), "file", (F.col("ln") + 1).alias("line_no"), "source_anchor", "line")


def target(c: Column) -> Column:
    """The page or slide that a marker names, as (kind, index)."""
    page, slide = F.regexp_extract(c, r"\bp\.(\d+)", 1), F.regexp_extract(c, r"(?i)\bslide\s+(\d+)", 1)
    of = lambda kind, x: F.struct(F.lit(kind).alias("kind"), x.cast("long").alias("index"))
    return F.when(page != "", of("pdf_page", F.nullif(page, F.lit("")))).when(slide != "", of("slide", F.nullif(slide, F.lit(""))))


def page_samples(anchors: DataFrame, k: int = SAMPLES) -> DataFrame:
    """The first marker of each page or slide, the first ``k`` of those in each document."""
    rows = anchors.withColumn("t", target(F.col("source_anchor"))).where("t is not null")
    first = rows.withColumn("r", F.row_number().over(W.partitionBy("doc_id", "t").orderBy("n"))).where("r = 1")
    top = first.withColumn("k", F.row_number().over(W.partitionBy("doc_id").orderBy("n"))).where(F.col("k") <= k)
    return top.select("doc_id", "k", "anchor_id", F.col("t.kind").alias("kind"), F.col("t.index").alias("index"), "source_anchor")


def text_samples(anchors: DataFrame, k: int = SAMPLES) -> DataFrame:
    """The first ``k`` distinct markers that name no page or slide."""
    rows = anchors.where(target(F.col("source_anchor")).isNull())
    first = rows.withColumn("r", F.row_number().over(W.partitionBy("doc_id", "source_anchor").orderBy("n"))).where("r = 1")
    top = first.withColumn("k", F.row_number().over(W.partitionBy("doc_id").orderBy("n"))).where(F.col("k") <= k)
    return top.select("doc_id", "k", "anchor_id", "file", "line_no", "source_anchor", "line")


def snippet() -> Column:
    """What a block says, shortened: six items of a list, three rows of a table."""
    t, f = F.col("table"), F.col("figure")
    items = F.array_join(F.transform(F.slice("content.items", 1, 6), lambda x: F.concat(F.lit("- "), x)), "\n")
    row = lambda r: F.array_join(F.transform(r, lambda c: F.coalesce(c["text"], F.lit(""))), " | ")
    table = F.array_join(F.filter(F.concat(F.array(F.array_join(t["columns"], " | ")), F.transform(F.slice(t["rows"], 1, 3), row)), lambda s: T.strip(s) != ""), "\n")
    figure = F.array_join(F.filter(F.array(f["figure_no"], f["caption"], f["description"], f["asset_file"]), lambda x: x.isNotNull() & (x != "")), "\n")
    formula = F.coalesce(F.nullif("formula.latex", F.lit("")), F.col("formula.plain_text_source"))
    kind = F.col("type")
    s = (
        F.when(kind == "heading", F.col("heading.text")).when(kind == "para", F.col("content.text")).when(kind == "list", items).when(kind == "table", table)
        .when(kind == "figure", figure).when(kind == "formula", formula).when(kind == "code", F.col("code.text"))
    )
    return F.substring(F.coalesce(s, F.lit("")), 1, SNIPPET)


def evidence(samples: DataFrame, blocks: DataFrame) -> DataFrame:
    """Samples with the first block that has their marker; ``block_id`` is null where none does."""
    mark = F.regexp_replace(anchor_text(F.col("source_anchor")), "^〔源 |〕\\z", "")
    b = blocks.select("doc_id", mark.alias("source_anchor"), "ord", F.struct("id", "type", snippet().alias("snippet")).alias("b"))
    first = b.groupBy("doc_id", "source_anchor").agg(F.min_by("b", "ord").alias("b"))
    joined = samples.join(first, ["doc_id", "source_anchor"], "left")
    return joined.select("doc_id", "k", "anchor_id", "source_anchor", F.col("b.id").alias("block_id"), F.col("b.type").alias("block_type"), F.col("b.snippet").alias("snippet"), F.substring("line", 1, LINE).alias("rendered_line"))


def overall_status(signals: DataFrame) -> DataFrame:
    """The worst of a document's signals ``(doc_id, status)``; unknown words fail."""
    rank = F.when(F.col("status") == "pass", 0).when(F.col("status") == "pass_with_notes", 1).otherwise(2)
    top = signals.groupBy("doc_id").agg(F.max(rank).alias("r"))
    return top.select("doc_id", F.when(F.col("r") == 0, "pass").when(F.col("r") == 1, "pass_with_notes").otherwise("fail").alias("status"))


def qa_report(gates: DataFrame, issues: DataFrame, own_phase: str = "6_validation") -> DataFrame:
    """Gate results of other phases with open blockers and majors; minor issues do not count."""
    g = gates.where(F.col("phase") != own_phase).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_gates"), F.count_if(F.col("status") == "fail").alias("n_failed"), F.count_if(F.col("status") == "pass_with_notes").alias("n_notes"))
    i = issues.where("status = 'open'").groupBy("doc_id").agg(F.count_if(F.col("severity") == "blocker").alias("blockers"), F.count_if(F.col("severity") == "major").alias("majors"))
    rows = g.join(i, "doc_id", "full").na.fill(0)
    status = F.when((F.col("n_failed") > 0) | (F.col("blockers") > 0), "fail").when((F.col("n_notes") > 0) | (F.col("majors") > 0), "pass_with_notes").otherwise("pass")
    return rows.withColumn("status", status)
