"""Projections of the block table: anchors as text, provenance, assets, relations, statistics, titles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schema import PAYLOAD_OF

GENERIC_BUILD_TITLES = ("", "pdf", "doc", "docx", "document", "file", "unknown", "文档", "文件")


def anchor_text(a: Column) -> Column:
    """The marker of an anchor in rendered text; empty for an unknown kind."""
    mark = lambda *parts: F.concat(F.lit("〔源 "), *[p.cast("string") for p in parts], F.lit("〕"))
    kind, page = a["kind"], a["page"]
    sheet = F.coalesce(F.nullif(a["sheet"], F.lit("")), F.lit("Sheet"))
    cells = F.nullif(a["range"], F.lit(""))
    tail = F.when(F.size(a["heading_path"]) > 0, F.element_at(a["heading_path"], -1)).otherwise("正文")
    number = F.when(F.array_contains(a["keys"], "paragraph_index"), a["paragraph_index"]).otherwise(a["block_index"])
    flow = F.when(page.isNotNull(), mark(F.lit("p."), page)).when(number.isNotNull(), mark(tail, F.lit(" / 段 "), number)).otherwise(mark(tail))
    return (
        F.when(kind == "pdf_page", F.when(page.isNotNull(), mark(F.lit("p."), page)).otherwise("〔源 PDF〕"))
        .when(kind == "slide", F.when(a["slide"].isNotNull(), mark(F.lit("slide "), a["slide"])).otherwise("〔源 slide〕"))
        .when(kind == "sheet_range", F.when(cells.isNotNull(), mark(sheet, F.lit("!"), cells)).otherwise(mark(sheet)))
        .when(kind.isin("docx_anchor", "text_anchor"), flow)
        .otherwise("")
    )


def source_ref(a: Column) -> Column:
    """Token of a location in file names; page, slide 0 and an empty sheet count as none."""
    page = F.format_string("p%03d", a["page"])
    sheet = F.coalesce(F.nullif(T.ascii_slug(a["sheet"]), F.lit("")), F.lit("sheet"))
    return (
        F.when(a["kind"].isin("pdf_page", "docx_anchor") & (a["page"] != 0), page)
        .when((a["kind"] == "slide") & (a["slide"] != 0), F.format_string("slide%02d", a["slide"]))
        .when((a["kind"] == "sheet_range") & (a["sheet"] != ""), F.concat(F.lit("sheet_"), sheet))
        .otherwise("doc")
    )


def location(a: Column) -> Column:
    """Where a block is, as (kind, value): page before slide before sheet; page 0 is a page."""
    of = lambda k: F.when(a[k].isNotNull(), F.struct(F.lit(k).alias("kind"), a[k].cast("string").alias("value")))
    return F.coalesce(of("page"), of("slide"), of("sheet"))


def provenance(blocks: DataFrame) -> DataFrame:
    """The anchor of each id; of equal ids the last."""
    return blocks.groupBy("doc_id", "id").agg(F.max_by("source_anchor", "ord").alias("source_anchor"))


def assets_index(blocks: DataFrame, files: DataFrame) -> DataFrame:
    """Assets with the first file that a figure gives, who refers to them, and whether the file is there.

    ``files (doc_id, path)`` is the listing; it is joined by key, not collected."""
    figs = blocks.where("type = 'figure' and figure.asset_id <> ''")
    out = figs.groupBy("doc_id", F.col("figure.asset_id").alias("asset_id")).agg(F.min_by("figure.asset_file", "ord").alias("file"), F.array_sort(F.collect_list("id")).alias("referenced_by"))
    there = files.select("doc_id", F.col("path").alias("file"), F.lit(True).alias("there")).distinct()
    return out.join(there, ["doc_id", "file"], "left").select("doc_id", "asset_id", "file", "referenced_by", F.coalesce("there", F.lit(False)).alias("exists"))


def relations(blocks: DataFrame, references: DataFrame | None = None) -> DataFrame:
    uses = blocks.where("type = 'figure' and figure.asset_id <> ''").select("doc_id", F.col("id").alias("from"), F.col("figure.asset_id").alias("to"), F.lit("uses_asset").alias("type"))
    return uses if references is None else uses.unionByName(references)


def same_projection(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Documents whose stored projection differs from the regenerated one, with the number of rows on either side."""
    gone = stored.exceptAll(fresh).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_stale"))
    new = fresh.exceptAll(stored).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_missing"))
    return gone.join(new, "doc_id", "full").select("doc_id", F.coalesce("n_stale", F.lit(0)).alias("n_stale"), F.coalesce("n_missing", F.lit(0)).alias("n_missing"))


def unknown_types(blocks: DataFrame) -> DataFrame:
    """Blocks of a type that the block table does not have."""
    return blocks.where(~F.coalesce(F.col("type").isin(*PAYLOAD_OF), F.lit(False))).select("doc_id", "id", "type")


def checked_types(blocks: DataFrame) -> DataFrame:
    """The same blocks; a type that the block table does not have stops the job."""
    bad = F.concat(F.lit("unknown block type: "), F.coalesce("type", F.lit("null")))
    return blocks.withColumn("type", F.when(F.col("type").isin(*PAYLOAD_OF), F.col("type")).otherwise(F.raise_error(bad).cast("string")))


def stats(blocks: DataFrame) -> DataFrame:
    n = lambda t: F.count_if(F.col("type") == t)
    return blocks.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("block_count"), n("table").alias("table_count"), n("figure").alias("figure_count"), n("formula").alias("formula_count"), n("heading").alias("heading_count"),
        F.countDistinct(F.when(F.col("figure.asset_id") != "", F.col("figure.asset_id"))).alias("asset_count"),
    )


def clean_build_title(c: Column) -> Column:
    line = F.regexp_replace(F.regexp_replace(c, T.WS + "+", " "), r"^[ #\t]+|[ #\t]+\z", "")
    return T.strip(F.substring(T.strip(F.regexp_replace(line, "<!--.*?-->", "")), 1, 160))


def _generic(c: Column) -> Column:
    n = F.lower(F.regexp_replace(clean_build_title(c), r"(?U)[\s_\-.:：/\\]+", ""))
    return n.isin(*GENERIC_BUILD_TITLES) | (F.length(n) <= 1)


def titles(blocks: DataFrame, sources: DataFrame) -> DataFrame:
    """Title of each document of ``sources (doc_id, source_file)``: a heading, a paragraph, the file's name, or
    ``document``; generic ones do not count."""
    head, para = clean_build_title(F.col("heading.text")), clean_build_title(F.col("content.text"))
    rank = F.when((F.col("type") == "heading") & (head != "") & ~_generic(head), 0).when(
        (F.col("type") == "para") & (para != "") & ~para.startswith(">") & ~para.contains("www.") & (F.length(para) <= 140) & ~_generic(para), 1
    )
    best = blocks.withColumn("rank", rank).where("rank is not null").groupBy("doc_id").agg(F.min_by(F.when(F.col("rank") == 0, head).otherwise(para), F.struct("rank", "ord")).alias("title"))
    fallback = T.stem(F.col("source_file"))
    return sources.select("doc_id", "source_file").join(best, "doc_id", "left").select("doc_id", F.coalesce("title", F.when(_generic(fallback), "document").otherwise(fallback)).alias("title"))


def language(c: Column) -> Column:
    return F.when(c.rlike("[一-鿿]"), "zh-CN").otherwise("en")
