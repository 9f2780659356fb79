"""Delivery: slots and reports of an import, the files of an assembled document, its manifest, its previews.

A job's files are rows ``(doc_id, path, text)``; paths of delivered files are relative to the output folder.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from . import project
from . import render as R

# Slots that a later step fills, and the delivered files that a final manifest gives hashes of.
SLOTS = {"review/vision_cache.json": "", "review/cleaning_decisions.json": "{}\n", "ir/summary.seed.md": "<!-- summary: replace this line with 200 to 300 words on the whole text -->\n"}
HASHED = ("main.md", "index.md", "index.json", "provenance.json", "qa_report.md", "visual_acceptance.md", "unresolved.md")
HASHED_FOLDERS = ("parts/", "assets/")
PARTS = "array<struct<title:string,path:string,source_range:string,blocks:bigint,tables:bigint,figures:bigint,formulas:bigint,approx_tokens:bigint>>"


def seed_slots(docs: DataFrame, files: DataFrame) -> DataFrame:
    """Slots that a document ``(doc_id)`` does not have yet among ``files (doc_id, path)``; what is there stays."""
    slots = F.explode(F.array(*[F.struct(F.lit(p).alias("path"), F.lit(t).alias("text")) for p, t in SLOTS.items()])).alias("s")
    return docs.select("doc_id").distinct().select("doc_id", slots).select("doc_id", "s.path", "s.text").join(files.select("doc_id", "path"), ["doc_id", "path"], "left_anti")


def import_report(meta: DataFrame) -> DataFrame:
    """Text on an extraction: ``meta (doc_id, extractor_version, source_format, image_count, n_images, n_pages,
    placeholder_count, n_duplicates, stats, console)``."""
    v = lambda c, none="None": F.coalesce(F.col(c).cast("string"), F.lit(none))
    line = lambda name, c: F.concat(F.lit(f"- {name}: "), c)
    text = F.concat_ws(
        "\n", F.lit("# Imported Quality Report (backend extraction)"), F.lit(""), line("extractor_version", v("extractor_version")), line("source_format", v("source_format")), line("image_count (meta)", v("image_count")),
        F.concat(F.lit("- mapped images: "), v("n_images", "0"), F.lit("  | mapped page renders: "), v("n_pages", "0")), line("placeholder_count", v("placeholder_count")), line("duplicate_images", v("n_duplicates", "0")), line("structured_stats", v("stats", "{}")),
        F.lit(""), F.lit("## extractor console"), F.lit(""), F.lit("```"), T.strip(v("console", "")), F.lit("```"),
    )
    return meta.select("doc_id", F.lit("review/imported_quality_report.md").alias("path"), F.concat(text, F.lit("\n")).alias("text"))


def summary(seed: Column) -> Column:
    """The summary that a seed holds: none while it is empty or still begins with its instruction."""
    s = T.strip(F.coalesce(seed, F.lit("")))
    return F.when(s.startswith("<!--"), "").otherwise(s)


def copied_assets(blocks: DataFrame, files: DataFrame) -> DataFrame:
    """Images to deliver: the files of figures that are no noise and exist in ``files (doc_id, path)``."""
    figs = blocks.where("type = 'figure' and not coalesce(figure.likely_noise, false)").select("doc_id", "ord", F.col("figure.asset_file").alias("source"))
    there = figs.join(files.select("doc_id", F.col("path").alias("source")), ["doc_id", "source"], "left_semi")
    return there.select("doc_id", "ord", "source", F.concat(F.lit("assets/"), T.base_name(F.col("source"))).alias("path"))


def _listed(n: str) -> Column:
    return F.concat(F.lit(f"- {n.capitalize()}: "), F.coalesce(F.col(n), F.lit(0)).cast("string"))


def assembled(docs: DataFrame, blocks: DataFrame, files: DataFrame, limits: dict[str, int] = R.SPLIT) -> DataFrame:
    """One row a document with all that its entry, indexes and manifest are made of.

    ``docs (doc_id, title, source_file, source_type, risk, pages, seed)``; ``files (doc_id, path)`` lists the job's files.
    A whole document has its contents and body in main.md, a split one the list of its parts."""
    count = blocks.groupBy("doc_id").agg(F.count(F.lit(1)).alias("blocks"), *[F.count_if(F.col("type") == k).alias(f"{k}s") for k in ("heading", "table", "figure", "formula")], F.min_by("type", "ord").alias("_first"))
    shown = copied_assets(blocks, files).groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("ord", "path"))), lambda x: x["path"]).alias("assets"))
    split = R.should_split(blocks, docs.select("doc_id", "pages"), limits)
    parts = R.parts(blocks.join(split.where("split"), "doc_id", "left_semi"))
    extra = F.when((F.col("tables") > 0) | (F.col("figures") > 0) | (F.col("formulas") > 0), F.concat(F.lit("tables "), F.col("tables").cast("string"), F.lit(", figures "), F.col("figures").cast("string"), F.lit(", formulas "), F.col("formulas").cast("string")))
    item = F.concat(F.lit("- ["), F.col("title"), F.lit("]("), F.col("path"), F.lit(") - "), F.concat_ws(", ", F.nullif("range", F.lit("")), F.concat(F.col("blocks").cast("string"), F.lit(" blocks")), extra))
    row = F.struct("section", item.alias("item"), F.struct("title", "path", F.col("range").alias("source_range"), "blocks", "tables", "figures", "formulas", "approx_tokens").alias("part"))
    listed = parts.groupBy("doc_id").agg(F.array_sort(F.collect_list(row)).alias("_rows"))
    table = R.agent_index(parts).select("doc_id", F.col("markdown").alias("_table"))
    rows = docs
    for other in (count, split, R.bodies(blocks), R.toc(blocks), listed, table, shown):
        rows = rows.join(other, "doc_id", "left")
    title, is_split = F.coalesce("title", F.lit("文档")), F.coalesce("split", F.lit(False))
    rows = rows.withColumn("split", is_split).withColumn("summary", summary(F.col("seed"))).withColumn("assets", F.coalesce("assets", F.array().cast("array<string>"))).withColumn("parts", F.coalesce(F.transform("_rows", lambda x: x["part"]), F.array().cast(PARTS)))
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("blocks", "tables", "figures", "formulas")}
    front = R.front_matter(F.coalesce("title", F.lit("")), F.coalesce("source_file", F.lit("")), F.coalesce("source_type", F.lit("")), F.coalesce("risk", F.lit("")), zero, F.col("split"))
    h1 = F.when(F.col("split") | ~F.coalesce(F.col("_first") == "heading", F.lit(False)), F.concat(F.lit("# "), title))
    said = F.when(F.col("summary") != "", F.concat(F.lit("> **摘要**\n> "), F.col("summary")))
    contents = F.coalesce("toc", F.concat(F.lit("## 目录\n\n- ["), title, F.lit("](#"), T.gfm_slug(title), F.lit(")")))
    whole = F.concat_ws("\n\n", front, h1, said, contents, F.lit("---"), F.coalesce("body", F.lit("")))
    of_parts = F.concat_ws("\n\n", front, h1, said, F.concat(F.lit("## 分卷目录\n\n"), F.array_join(F.transform("_rows", lambda x: x["item"]), "\n")))
    main = F.concat(F.when(F.col("split"), of_parts).otherwise(whole), F.lit("\n"))
    return rows.withColumn("main", main).withColumn("title", title).drop("body", "toc", "_first", "_rows")


def index_markdown() -> Column:
    """index.md of an assembled document."""
    c = F.col
    n = lambda x: x.cast("string")
    lines = [
        F.concat(F.lit("# Agent Index: "), c("title")), F.lit(""), F.lit("- Entry: [main.md](main.md)"), F.concat(F.lit("- Mode: "), F.when(c("split"), "split index").otherwise("single file")), F.concat(F.lit("- Approx entry tokens: "), n(T.estimate_tokens(c("main")))),
        F.concat(F.lit("- Parts: "), n(F.size("parts"))), F.concat(F.lit("- Assets: "), n(F.size("assets"))), F.when(F.coalesce("pages", F.lit(0)) != 0, F.concat(F.lit("- Source pages: "), n(c("pages")))),
        F.when(c("summary") != "", F.concat(F.lit("\n## Summary\n\n"), c("summary"))),
        F.lit("\n## Read First\n"), F.lit("- Begin with the entry."), F.lit("- Of a split document, load only the parts that the task needs."), F.lit("- Sources and counts below tell what a part holds."),
        F.when(c("_table").isNotNull(), F.concat(F.lit("\n## Parts\n\n"), c("_table"))),
        F.lit("\n## Content Counts\n"), *map(_listed, ("blocks", "headings", "tables", "figures", "formulas")),
    ]
    return F.concat(F.concat_ws("\n", *lines), F.lit("\n"))


def index_json() -> Column:
    """index.json of an assembled document."""
    entry = F.struct(F.lit("main.md").alias("path"), F.when(F.col("split"), "split_index").otherwise("single_file").alias("mode"), T.estimate_tokens(F.col("main")).alias("approx_tokens"))
    cut = F.struct(F.col("split").alias("enabled"), F.transform("parts", lambda p: p["path"]).alias("parts"))
    content = F.struct(*[F.coalesce(F.col(x), F.lit(0)).alias(x) for x in ("blocks", "headings", "tables", "figures", "formulas")])
    stats = F.struct(F.struct("risk", "pages").alias("profile"), content.alias("content"), F.size("assets").alias("asset_count"), F.size("parts").alias("part_count"))
    return F.to_json(F.struct("title", "summary", entry.alias("entry"), cut.alias("split"), stats.alias("stats"), "parts"), {"ignoreNullFields": "false"})


def provenance_files(blocks: DataFrame) -> DataFrame:
    """provenance.json: the anchor of each block, by id; an anchor has the keys that its source gave."""
    rows = project.provenance(blocks).groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("id", F.to_json(F.col("source_anchor").dropFields("keys")).alias("a"))))).alias("m"))
    # a key is escaped as JSON: {"k":"..."} without its frame
    text = F.transform(F.map_entries("m"), lambda x: F.concat(F.regexp_extract(F.to_json(F.struct(x["key"].alias("k"))), r'(?s)^\{"k":(".*")\}\z', 1), F.lit(":"), F.coalesce(x["value"], F.lit("null"))))
    return rows.select("doc_id", F.lit("provenance").alias("role"), F.lit("provenance.json").alias("path"), F.concat(F.lit('{"blocks":{'), F.array_join(text, ","), F.lit("}}")).alias("text"))


def output_files(docs: DataFrame, blocks: DataFrame, files: DataFrame, limits: dict[str, int] = R.SPLIT) -> DataFrame:
    """All text files of each document as rows ``(doc_id, role, path, text)``."""
    a = assembled(docs, blocks, files, limits)
    one = lambda role, path, c: F.struct(F.lit(role).alias("role"), F.lit(path).alias("path"), c.alias("text"))
    three = a.select("doc_id", F.explode(F.array(one("main", "main.md", F.col("main")), one("index", "index.md", index_markdown()), one("index", "index.json", index_json()))).alias("f")).select("doc_id", "f.*")
    split = R.should_split(blocks, docs.select("doc_id", "pages"), limits).where("split")
    parts = R.parts(blocks.join(split, "doc_id", "left_semi")).select("doc_id", F.lit("part").alias("role"), "path", "text")
    return reduce(DataFrame.unionByName, [three, parts, provenance_files(blocks)])


def refreshed_manifest(manifests: DataFrame, entries: DataFrame) -> DataFrame:
    """Manifests ``(doc_id, ...)`` with outputs and split taken from ``assembled``; documents without a manifest get none."""
    part = F.transform("parts", lambda p: F.struct(p["path"].alias("path"), p["title"].alias("title"), p["source_range"].alias("source_range")))
    new = entries.select("doc_id", F.lit("main.md").alias("main"), F.struct(F.lit("index.md").alias("markdown"), F.lit("index.json").alias("json")).alias("index"), part.alias("parts"), "assets", F.col("split").alias("split_enabled"), F.transform("parts", lambda p: p["path"]).alias("split_parts"))
    kept = [c for c in manifests.columns if c == "doc_id" or c not in new.columns]
    return manifests.select(*kept).join(new, "doc_id", "left")


def finalised_manifest(manifests: DataFrame, hashes: DataFrame, now: Column) -> DataFrame:
    """Manifests at their last stage, with the digests of all delivered files ``hashes (doc_id, path, sha256)`` but their own."""
    folder = reduce(Column.__or__, [F.col("path").startswith(f) for f in HASHED_FOLDERS])
    got = hashes.where(F.col("path").isin(*HASHED) | folder).groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_set(F.struct("path", "sha256")))).alias("output_hashes"))
    fixed = {"stage": F.lit("final"), "generated_at": now, "qa_report": F.lit("qa_report.md"), "visual_acceptance": F.lit("visual_acceptance.md"), "unresolved": F.lit("unresolved.md")}
    if "main" not in manifests.columns:
        fixed["main"] = F.lit("main.md")
    else:
        manifests = manifests.withColumn("main", F.coalesce("main", F.lit("main.md")))
    rows = manifests.drop("output_hashes", *[c for c in fixed if c in manifests.columns]).join(got, "doc_id", "left")
    return rows.select("*", *[v.alias(k) for k, v in fixed.items()]).withColumn("output_hashes", F.coalesce("output_hashes", F.create_map().cast("map<string,string>")))


def previews(files: DataFrame, renderer: Callable[[Column], Column] | None = None) -> DataFrame:
    """HTML of Markdown files ``(doc_id, path, text)``.  ``renderer`` makes it outside the engine (a pandas UDF, say) and gives
    null where it fails; the text then stands preformatted, and ``renderer_ok`` is false."""
    c = F.coalesce("text", F.lit(""))
    for raw, safe in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(raw), F.lit(safe))
    made = F.lit(None).cast("string") if renderer is None else renderer(F.col("text"))
    rows = files.withColumn("_made", made)
    return rows.select("doc_id", "path", F.coalesce("_made", F.concat(F.lit("<pre>"), c, F.lit("</pre>"))).alias("html"), F.col("_made").isNotNull().alias("renderer_ok"))
