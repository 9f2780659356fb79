"""Binding of captions to figures, references to figures, and names of asset files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from .project import source_ref

# Fixed value: a caption keyword and a number token with a digit.
CAPTION = r"^\s*(图表|图|圖|表|Figure|Fig\.?|Table|Chart)\s*((?=[^\s]*[0-9])[0-9A-Za-z](?:[0-9A-Za-z.\-]*[0-9A-Za-z])?)"
#: The same grammar anywhere in a text, to find citations by equal tokens.
CITATION = r"(图表|图|圖|表|Figure|Fig\.?|Table|Chart) ((?=[^\s]*[0-9])[0-9A-Za-z](?:[0-9A-Za-z.\-]*[0-9A-Za-z])?)(?![0-9A-Za-z.\-])"
ASSET_NAME = r"^[a-z0-9](?:[a-z0-9._-]*[a-z0-9])?\.[a-z0-9]+\z"
MAX_BODY = 96


def caption_number(c: Column) -> Column:
    return F.when(c.rlike(CAPTION), T.strip(F.concat_ws(" ", F.regexp_extract(c, CAPTION, 1), F.regexp_extract(c, CAPTION, 2))))


def bind_captions(blocks: DataFrame) -> DataFrame:
    """Figures take the caption after them, else the one before unless the figure before that has it.

    Closed form of the claim in document order: a caption between two figures belongs to the first."""
    w = W.partitionBy("doc_id").orderBy("ord")
    cap = F.when(F.col("type") == "para", caption_number(F.col("content.text")))
    rows = blocks.withColumn("_me", F.struct(F.col("type").alias("t"), F.col("id"), F.col("content.text").alias("text"), cap.alias("no")))
    rows = rows.withColumns({"_next": F.lead("_me").over(w), "_prev": F.lag("_me").over(w), "_prev2": F.lag("_me", 2).over(w), "_next2": F.lead("_me", 2).over(w)})
    fig = lambda x: F.coalesce(x["t"] == "figure", F.lit(False))
    is_fig = F.col("type") == "figure"
    after = is_fig & F.col("_next.no").isNotNull()
    before = is_fig & F.col("_prev.no").isNotNull() & ~fig(F.col("_prev2")) & ~after
    mine = F.when(after, F.col("_next")).when(before, F.col("_prev"))
    # the paragraph's view of the same rule: the figure before it claims first
    me_cap = F.col("_me.no").isNotNull()
    claimed = F.when(me_cap & fig(F.col("_prev")), F.col("_prev.id")).when(me_cap & fig(F.col("_next")) & F.col("_next2.no").isNull(), F.col("_next.id"))
    rows = rows.withColumn("_cap", mine).withColumn("_for", claimed)
    figure = F.when(F.col("_cap").isNotNull(), F.col("figure").withField("figure_no", F.col("_cap.no")).withField("caption", F.col("_cap.text"))).otherwise(F.col("figure"))
    content = F.when(F.col("_for").isNotNull(), F.col("content").withField("is_caption_for", F.col("_for"))).otherwise(F.col("content"))
    review = F.when(F.col("_cap").isNotNull(), F.col("figure.description").isNull()).otherwise(F.col("needs_review"))
    return rows.withColumns({"needs_review": review, "figure": figure, "content": content}).drop("_me", "_next", "_prev", "_prev2", "_next2", "_cap", "_for")


def references(blocks: DataFrame) -> DataFrame:
    """Paragraphs that cite a known figure number, found by an equi-join on the cited token.

    Of figures with one number the last counts; captions cite nothing; the number must end at a boundary."""
    figs = blocks.where("type = 'figure' and figure.figure_no <> ''").groupBy("doc_id", F.col("figure.figure_no").alias("no")).agg(F.max_by("id", "ord").alias("to"))
    paras = blocks.where("type = 'para' and (content.is_caption_for is null or content.is_caption_for = '')")
    found = F.regexp_extract_all("content.text", F.lit(CITATION), F.lit(0))
    # one keyword ends another: a citation by the longer one is a citation by the shorter one, too
    inner = F.transform(F.filter(found, lambda x: x.startswith("图表")), lambda x: F.substring(x, 2, 1 << 20))
    cited = paras.select("doc_id", F.col("id").alias("from"), F.explode(F.array_distinct(F.concat(found, inner))).alias("no"))
    return cited.join(figs, ["doc_id", "no"]).select("doc_id", "from", "to", F.lit("references").alias("type")).distinct()


def asset_body(anchor: Column, slug: Column, seq: Column, kind: str = "fig") -> Column:
    body = F.coalesce(F.nullif(T.ascii_slug(slug), F.lit("")), F.format_string("asset_%03d", seq))
    return F.substring(F.concat_ws("_", F.lit(kind), source_ref(anchor), body), 1, MAX_BODY)


def asset_names(blocks: DataFrame) -> DataFrame:
    """The name for each figure's asset file; equal bodies of a document get ``_02``, ``_03`` … in order, cut so that the
    suffix fits."""
    w = W.partitionBy("doc_id").orderBy("ord")
    f = blocks.where("type = 'figure'").withColumn("seq", F.row_number().over(w))
    ext = F.lower(F.regexp_extract(F.coalesce("figure.asset_file", F.lit("")), r"\.([^./]+)\z", 1))
    ext = F.coalesce(F.nullif(ext, F.lit("")), F.lit("png"))
    slug = F.coalesce(F.nullif(F.col("figure.caption"), F.lit("")), F.col("figure.figure_no"))
    f = f.withColumn("ext", ext).withColumn("body", asset_body(F.col("source_anchor"), slug, F.col("seq")))
    f = f.withColumn("k", F.row_number().over(W.partitionBy("doc_id", "body", "ext").orderBy("ord")))
    suffix = F.format_string("_%02d", F.col("k"))
    body = F.when(F.col("k") == 1, F.col("body")).otherwise(F.concat(F.substring("body", F.lit(1), F.lit(MAX_BODY) - F.length(suffix)), suffix))
    return f.select("doc_id", "ord", "id", F.coalesce("figure.original_asset_file", "figure.asset_file").alias("original_asset_file"), F.concat_ws(".", body, "ext").alias("asset_name"))


def rename_assets(blocks: DataFrame, files: DataFrame) -> DataFrame:
    """Blocks with new asset names where the file is there; running it again changes nothing."""
    names = asset_names(blocks).select("doc_id", "id", F.col("original_asset_file").alias("_orig"), "asset_name")
    there = files.select("doc_id", F.col("path").alias("_path"), F.lit(True).alias("_there")).distinct()
    rows = blocks.withColumn("_path", F.col("figure.asset_file")).join(names, ["doc_id", "id"], "left").join(there, ["doc_id", "_path"], "left")
    new = F.concat(F.regexp_extract("figure.asset_file", r"^(.*/)?", 1), F.col("asset_name"))
    fig = F.col("figure").withField("original_asset_file", F.col("_orig"))
    fig = F.when(F.col("_there") & (new != F.col("figure.asset_file")), fig.withField("asset_file", new).withField("asset_id", F.concat(F.lit("asset_"), T.stem(F.col("asset_name"))))).otherwise(fig)
    return rows.withColumn("figure", F.when(F.col("type") == "figure", fig)).drop("_path", "_orig", "asset_name", "_there")


def valid_asset_name(c: Column) -> Column:
    return c.rlike(ASSET_NAME) & (F.length(F.regexp_replace(c, r"\.[^.]*\z", "")) <= MAX_BODY)
