"""Blocks to Markdown: rendering, slugs, contents, sections, parts, indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from .project import anchor_text

ANCHORED = ("heading", "table", "figure", "formula", "code")
#: Defaults of a job; a document is split above any of them.
SPLIT = {"max_blocks": 1500, "max_markdown_bytes": 307_200, "max_pages": 100, "max_sheets": 3}


def table_markdown(columns: Column, rows: Column) -> Column:
    """A table in Markdown; without columns it is as wide as its widest row."""
    rows = F.coalesce(rows, F.array().cast("array<array<struct<text:string,rowspan:int,colspan:int>>>"))
    given = F.coalesce(columns, F.array().cast("array<string>"))
    width = F.when(F.size(rows) > 0, F.array_max(F.transform(rows, F.size))).otherwise(1)
    cols = F.when(F.size(given) == 0, F.array_repeat(F.lit(""), width)).otherwise(given)
    span = lambda c: F.greatest(F.coalesce(c["colspan"], F.lit(1)), F.lit(1))
    cell = lambda c: F.replace(F.replace(F.coalesce(c["text"], F.lit("")), F.lit("\n"), F.lit(" ")), F.lit("|"), F.lit("\\|"))
    spread = lambda r: F.flatten(F.transform(r, lambda c: F.concat(F.array(cell(c)), F.array_repeat(F.lit(""), span(c) - 1))))
    fit = lambda r: F.slice(F.concat(spread(r), F.array_repeat(F.lit(""), F.size(cols))), F.lit(1), F.size(cols))
    line = lambda cells: F.concat(F.lit("| "), F.array_join(cells, " | "), F.lit(" |"))
    head = line(F.transform(cols, lambda c: F.coalesce(F.nullif(c, F.lit("")), F.lit(" "))))
    return F.array_join(F.concat(F.array(head, line(F.transform(cols, lambda c: F.lit("---")))), F.transform(rows, lambda r: line(fit(r)))), "\n")


def heading_slugs(blocks: DataFrame, *within: str) -> DataFrame:
    """Slug of each heading; the n-th of equal slugs in a document (or in its group of columns ``within``) gets ``-n``."""
    base = blocks.where("type = 'heading'").withColumn("base", T.gfm_slug(F.col("heading.text")))
    n = F.row_number().over(W.partitionBy("doc_id", *within, "base").orderBy("ord")) - 1
    return base.withColumn("n", n).select("doc_id", "ord", "id", F.when(F.col("n") == 0, F.col("base")).otherwise(F.concat_ws("-", "base", "n")).alias("slug"))


def toc(blocks: DataFrame) -> DataFrame:
    """Contents of each document with headings, as text."""
    rows = blocks.where("type = 'heading'").join(heading_slugs(blocks).select("doc_id", "ord", "slug"), ["doc_id", "ord"])
    item = F.concat(F.repeat(F.lit("  "), F.col("heading.level") - 1), F.lit("- ["), F.col("heading.text"), F.lit("](#"), F.col("slug"), F.lit(")"))
    rows = rows.select("doc_id", "ord", item.alias("item"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ord", "item"))), lambda x: x["item"]), "\n")
    return rows.groupBy("doc_id").agg(F.concat(F.lit("## 目录\n\n"), body).alias("toc"))


def block_markdown(slug: Column | None = None, assets: str = "assets") -> Column:
    """Markdown of a block; null where the block is noise and is left out.  ``assets``: the images' folder, seen from the file."""
    mark = anchor_text(F.col("source_anchor"))
    suffix = F.when(mark == "", "").otherwise(F.concat(F.lit("　"), mark))
    aid = F.lit("") if slug is None else F.when(slug.isNull(), "").otherwise(F.concat(F.lit('<a id="'), slug, F.lit('"></a>\n')))
    h, c, t, f, m, k = (F.col(x) for x in ("heading", "content", "table", "figure", "formula", "code"))
    heading = F.concat(aid, F.repeat(F.lit("#"), h["level"]), F.lit(" "), h["text"], suffix)
    para = F.when(~F.coalesce(c["likely_noise"], F.lit(False)), F.coalesce(c["text"], F.lit("")))
    items = F.transform(F.coalesce(c["items"], F.array().cast("array<string>")), lambda x, i: F.concat(F.when(F.coalesce(c["ordered"], F.lit(False)), F.concat((i + 1).cast("string"), F.lit(". "))).otherwise("- "), x))
    title = F.when(F.coalesce(F.col("title"), F.lit("")) != "", F.concat(F.lit("*"), F.col("title"), F.lit("*")))
    runs = F.when(F.coalesce(t["continues_from"], F.lit("")) != "", "> **审计注**：本表为跨页续表。")
    star = F.when(mark != "", F.concat(F.lit("*"), mark, F.lit("*")))
    table = F.concat_ws("\n\n", title, runs, table_markdown(t["columns"], t["rows"]), star)
    name = T.base_name(f["asset_file"])
    some = lambda x: F.nullif(x, F.lit(""))
    cap = F.coalesce(some(f["caption"]), some(f["figure_no"]), name)
    label = F.coalesce(some(f["figure_no"]), some(cap))
    image = F.concat(F.lit("!["), cap, F.lit(f"]({assets}/"), name, F.lit(")"))
    bold = F.when(label.isNotNull(), F.concat(F.lit("**"), label, F.lit("**"), suffix)).otherwise(some(mark))
    said = F.when(F.coalesce(f["description"], F.lit("")) != "", T.blockquote(f["description"])).otherwise("> [未解析: 图片说明 — 需视觉描述]")
    guesses = F.transform(f["estimated_values"], lambda v: F.concat(F.lit("> **编者注**："), F.coalesce(v["label"], F.lit("None")), F.lit(" ≈ "), F.coalesce(v["value"], F.lit("None")), F.lit("（"), F.coalesce(v["basis"], F.lit("图上估读")), F.lit("）")))
    figure = F.when(~F.coalesce(f["likely_noise"], F.lit(False)), F.concat_ws("\n\n", image, bold, said, guesses))
    number = F.when(F.coalesce(m["equation_no"], F.lit("")) != "", F.concat(F.lit(" *(公式 "), m["equation_no"], F.lit(")*"))).otherwise("")
    note = F.when(F.coalesce(m["visual_check"], F.lit("")) == "needs_review", "\n\n> **审计注**：公式待视觉校对。").otherwise("")
    formula = F.concat(F.lit("$$\n"), F.coalesce(m["latex"], F.lit("")), F.lit("\n$$"), number, F.when(mark == "", "").otherwise(F.concat(F.lit(" "), mark)), note)
    code = F.concat(F.lit("```"), F.coalesce(k["language"], F.lit("")), F.lit("\n"), F.coalesce(k["text"], F.lit("")), F.lit("\n```"), F.when(star.isNull(), "").otherwise(F.concat(F.lit("\n\n"), star)))
    kind = F.col("type")
    return F.when(kind == "heading", heading).when(kind == "para", para).when(kind == "list", F.array_join(items, "\n")).when(kind == "table", table).when(kind == "figure", figure).when(kind == "formula", formula).when(kind == "code", code)


def rendered(blocks: DataFrame, assets: str = "assets", within: tuple[str, ...] = ()) -> DataFrame:
    slugs = heading_slugs(blocks, *within).select("doc_id", "ord", "slug")
    return blocks.join(slugs, ["doc_id", "ord"], "left").select("doc_id", "ord", "id", "type", *within, block_markdown(F.col("slug"), assets).alias("md"))


def _joined(keys: list[str], rows: DataFrame) -> DataFrame:
    some = F.collect_list(F.when(F.col("md").isNotNull(), F.struct("ord", "md")))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(some), lambda x: x["md"]), "\n\n").alias("body"))


def bodies(blocks: DataFrame) -> DataFrame:
    """The Markdown of each document."""
    return _joined(["doc_id"], rendered(blocks))


def sections(blocks: DataFrame) -> DataFrame:
    """Blocks with ``section`` (from 0) and its title: a section begins at each heading of the least level of the
    document, what stands before is 前言; without headings a section is a run of one sheet."""
    doc = W.partitionBy("doc_id")
    run = doc.orderBy("ord").rowsBetween(W.unboundedPreceding, 0)
    level = F.when(F.col("type") == "heading", F.col("heading.level"))
    sheet = F.nullif("source_anchor.sheet", F.lit(""))
    rows = blocks.withColumn("_top", F.min(level).over(doc)).withColumn("_sheet", F.last(sheet, ignorenulls=True).over(run))
    before = F.lag("_sheet").over(doc.orderBy("ord"))
    rows = rows.withColumn("_new", F.when(F.col("_top").isNotNull(), F.coalesce(level == F.col("_top"), F.lit(False))).otherwise(F.col("_sheet").isNotNull() & ~F.col("_sheet").eqNullSafe(before)))
    rows = rows.withColumn("_n", F.sum(F.col("_new").cast("int")).over(run)).withColumn("section", F.col("_n") - F.min("_n").over(doc))
    first = F.first(F.when(F.col("_new"), F.when(F.col("_top").isNotNull(), F.col("heading.text")).otherwise(F.col("_sheet"))), ignorenulls=True).over(W.partitionBy("doc_id", "section").orderBy("ord").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    title = F.coalesce(first, F.when(F.col("_top").isNotNull(), "前言").otherwise("document"))
    return rows.withColumn("section_title", title).drop("_top", "_sheet", "_new", "_n")


def source_range(page: str = "source_anchor.page", slide: str = "source_anchor.slide", sheet: str = "source_anchor.sheet") -> Column:
    """Aggregate: the pages (or slides) of a group as ``p.a-b``, else its first sheet."""
    n = F.coalesce(F.col(page), F.col(slide))
    lo, hi = F.min(n).cast("string"), F.max(n).cast("string")
    first = F.min_by(F.when(F.coalesce(F.col(sheet), F.lit("")) != "", F.col(sheet)), F.when(F.coalesce(F.col(sheet), F.lit("")) != "", F.col("ord")))
    return F.when(lo.isNull(), first).when(lo == hi, F.concat(F.lit("p."), lo)).otherwise(F.concat(F.lit("p."), lo, F.lit("-"), hi))


def parts(blocks: DataFrame) -> DataFrame:
    """One row for each part: title, range, path, counts, text and its estimated tokens.  A part is a file of its own: slugs
    are told apart within it, and images lie beside its folder."""
    rows = sections(blocks)
    n = lambda t: F.count_if(F.col("type") == t)
    head = rows.groupBy("doc_id", "section").agg(
        F.first("section_title").alias("title"), source_range().alias("range"), F.count(F.lit(1)).alias("blocks"), n("heading").alias("headings"), n("table").alias("tables"), n("figure").alias("figures"), n("formula").alias("formulas"),
        F.min_by("type", "ord").alias("first_type"),
    )
    text = _joined(["doc_id", "section"], rendered(rows, "../assets", ("section",)))
    body = F.when(F.col("first_type") == "heading", F.col("body")).otherwise(F.concat(F.lit("# "), F.col("title"), F.lit("\n\n"), F.col("body")))
    slug = F.coalesce(F.nullif(T.ascii_slug(F.col("title")), F.lit("")), F.nullif(T.ascii_slug(F.col("range")), F.lit("")), F.lit("part"))
    path = F.format_string("parts/%02d-%s.md", F.col("section") + 1, slug)
    out = head.join(text, ["doc_id", "section"]).withColumn("text", F.concat(body, F.lit("\n")))
    return out.select("doc_id", "section", "title", "range", path.alias("path"), "blocks", "headings", "tables", "figures", "formulas", "text", T.estimate_tokens(F.col("text")).alias("approx_tokens"))


def should_split(blocks: DataFrame, pages: DataFrame, limits: dict[str, int] = SPLIT) -> DataFrame:
    """``(doc_id, split)``; ``pages (doc_id, pages)``.  All limits are exceeded strictly."""
    size = bodies(blocks).select("doc_id", F.octet_length("body").alias("n_bytes"))
    n = blocks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_blocks"), F.countDistinct(F.when(F.col("source_anchor.kind") == "sheet_range", F.coalesce("source_anchor.sheet", F.lit("")))).alias("n_sheets"))
    big = (F.col("n_blocks") > limits["max_blocks"]) | (F.col("n_bytes") > limits["max_markdown_bytes"]) | (F.coalesce("pages", F.lit(0)) > limits["max_pages"]) | (F.col("n_sheets") > limits["max_sheets"])
    return n.join(size, "doc_id", "left").join(pages, "doc_id", "left").select("doc_id", F.coalesce(big, F.lit(False)).alias("split"))


def front_matter(title: Column, source_file: Column, source_type: Column, risk: Column, counts: dict[str, Column], split: Column) -> Column:
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v)
    n = [F.concat(F.lit(f"  {k}: "), v.cast("string")) for k, v in counts.items()]
    return F.concat_ws("\n", F.lit("---"), F.lit("schema: blockloom-md/0.1"), F.lit("generated_by: blockloom"), line("title", T.yaml_quoted(title)), line("source_file", T.yaml_quoted(source_file)), line("document_type", T.yaml_quoted(source_type)), line("risk_level", T.yaml_quoted(risk)), F.lit("counts:"), *n, line("split", F.lower(split.cast("string"))), F.lit("---"))


def agent_index(parts_df: DataFrame) -> DataFrame:
    """The index of each document's parts as JSON and as a Markdown table."""
    row = F.concat(F.lit("| ["), T.md_cell(F.col("title")), F.lit("]("), F.col("path"), F.lit(") | "), T.md_cell(F.col("range")), F.lit(" | "), F.concat_ws(" | ", *[F.col(c).cast("string") for c in ("blocks", "tables", "figures", "formulas", "approx_tokens")]), F.lit(" |"))
    item = F.struct("title", "path", F.col("range").alias("source_range"), "blocks", "tables", "figures", "formulas", "approx_tokens")
    rows = parts_df.select("doc_id", "section", row.alias("row"), item.alias("item"))
    got = rows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("section", "row", "item"))).alias("p"))
    head = F.lit("| Part | Source | Blocks | Tables | Figures | Formulas | Approx Tokens |\n| --- | --- | ---: | ---: | ---: | ---: | ---: |\n")
    return got.select("doc_id", F.to_json(F.transform("p", lambda x: x["item"]), {"ignoreNullFields": "false"}).alias("json"), F.concat(head, F.array_join(F.transform("p", lambda x: x["row"]), "\n")).alias("markdown"))
