"""Readers: blocks, issues, vision caches, comments, skeletons, files and gate results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..schema import BLOCKS


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """Block tables from JSON lines; a malformed line fails the read."""
    return spark.read.schema(BLOCKS).json(path, mode="FAILFAST")


def write_blocks(blocks: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Blocks as Parquet, or as JSON lines with nulls kept."""
    w = blocks.write.mode("overwrite")
    w.json(path, ignoreNullFields=False) if fmt == "json" else w.parquet(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """Whole text files: ``path, text``; bytes that are no UTF-8 become U+FFFD."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def first_skeletons(texts: DataFrame) -> DataFrame:
    """Of ``texts (doc_id, path, text)`` the first skeleton by name for each document."""
    return texts.where(F.col("path").endswith("_skeleton.md")).groupBy("doc_id").agg(F.min_by("text", "path").alias("text"), F.min("path").alias("path"))


def read_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files below a folder: path, bytes, modification time, content hash."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = (r.option("pathGlobFilter", pattern) if pattern else r).load(path)
    return files.select("path", F.col("length").alias("bytes"), F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("mtime"), F.sha2("content", 256).alias("sha256"))


def json_lines(texts: DataFrame) -> DataFrame:
    """Non-blank lines of ``texts (doc_id, path, text)`` with ``obj``, null where a line is no JSON object."""
    rows = texts.select("doc_id", "path", F.posexplode(T.lines(F.col("text"))).alias("ln", "line")).withColumn("line", T.strip(F.col("line"))).where("line <> ''")
    ok = F.try_parse_json("line").isNotNull() & F.col("line").startswith("{")
    return rows.select("doc_id", "path", (F.col("ln") + 1).alias("line_no"), "line", F.when(ok, F.col("line")).alias("obj"))


def split_issues(texts: DataFrame, fields: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """Good rows of a ledger text and its parse errors (doc_id, error)."""
    rows = json_lines(texts)
    good = rows.where("obj is not null").select("doc_id", F.col("line_no").alias("pos"), *[F.get_json_object("obj", f"$.{f}").alias(f) for f in fields])
    bad = rows.where("obj is null").select("doc_id", F.concat(F.lit("line "), F.col("line_no"), F.lit(": not a JSON object")).alias("error"))
    return good, bad


def vision_cache(texts: DataFrame) -> DataFrame:
    """Descriptions by base name: records of lines, the last of a name counts; where no line is a record, the whole text
    as one object of names."""
    recs = json_lines(texts).where("obj is not null").select("doc_id", "line_no", F.get_json_object("obj", "$.file").alias("file"), F.coalesce(F.get_json_object("obj", "$.text"), F.lit("")).alias("text")).where("file <> ''")
    lined = recs.groupBy("doc_id", T.base_name(F.col("file")).alias("file")).agg(F.max_by("text", "line_no").alias("text"))
    rest = texts.join(lined.select("doc_id").distinct(), "doc_id", "left_anti").select("doc_id", F.from_json("text", "map<string,string>").alias("m"))
    flat = rest.select("doc_id", F.explode("m").alias("k", "text")).select("doc_id", T.base_name(F.col("k")).alias("file"), "text")
    return lined.unionByName(flat.where("text is not null"))


_COMMENT = "id string, text string, comment string, revision string, source_anchor struct<kind:string,source_file:string,page:int,slide:int,sheet:string,heading_path:array<string>,paragraph_index:int,block_index:int>"


def comments(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Comments of ``texts (doc_id, path, text)`` by suffix: lines of objects, a list or an object with ``comments`` and
    ``revisions``, or a plain text as one comment.  Returns comments and parse errors."""
    named = texts.withColumn("name", T.base_name(F.col("path"))).where(T.strip(F.col("text")) != "")
    item = f"struct<{_COMMENT.replace(' string', ':string').replace(' struct', ':struct').replace(', ', ',')}>"
    blank = F.lit(None).cast(item)
    lined = named.where("name like '%.jsonl'")
    rows = json_lines(lined.withColumn("path", F.col("name")))
    a = rows.where("obj is not null").select("doc_id", F.concat_ws(":", "path", "line_no").alias("origin"), F.from_json("obj", item).alias("c"))
    bad = rows.where("obj is null").select("doc_id", F.concat(F.col("path"), F.lit(":"), F.col("line_no"), F.lit(": not a JSON object")).alias("error"))
    js = named.where("name like '%.json'").withColumn("ok", F.try_parse_json("text").isNotNull())
    bad = bad.unionByName(js.where("not ok").select("doc_id", F.concat(F.col("name"), F.lit(": not JSON")).alias("error")))
    empty = F.array().cast(f"array<{item}>")
    both = F.from_json("text", f"struct<comments:array<{item}>,revisions:array<{item}>>")
    lists = F.when(F.trim("text").startswith("["), F.from_json("text", f"array<{item}>")).otherwise(F.concat(F.coalesce(both["comments"], empty), F.coalesce(both["revisions"], empty)))
    b = js.where("ok").select("doc_id", "name", F.posexplode(F.coalesce(lists, empty)).alias("i", "c")).select("doc_id", F.concat(F.col("name"), F.lit(":"), F.col("i") + 1).alias("origin"), "c")
    plain = named.where("name not like '%.json' and name not like '%.jsonl'").select("doc_id", F.col("name").alias("origin"), T.strip(F.col("text")).alias("t"))
    out = a.unionByName(b).select("doc_id", "origin", F.coalesce(F.nullif("c.text", F.lit("")), F.nullif("c.comment", F.lit("")), "c.revision").alias("text"), _anchor(F.col("c.source_anchor")).alias("source_anchor"))
    return out.unionByName(plain.select("doc_id", "origin", F.col("t").alias("text"), _anchor(blank["source_anchor"]).alias("source_anchor"))), bad


def _anchor(a: Column) -> Column:
    """A read anchor with all fields of the block table's."""
    none = lambda t: F.lit(None).cast(t)
    return F.struct(
        a["kind"].alias("kind"), a["source_file"].alias("source_file"), a["page"].alias("page"), none("string").alias("page_label"), a["slide"].alias("slide"), a["sheet"].alias("sheet"), none("string").alias("range"),
        a["heading_path"].alias("heading_path"), a["paragraph_index"].alias("paragraph_index"), a["block_index"].alias("block_index"), none("array<string>").alias("keys"),
    )


def gate_results(texts: DataFrame) -> DataFrame:
    """Gate files ``(doc_id, path, text)`` named ``gate_<phase>_<gate>.json``: status by phase; a file that is no JSON is
    ``unreadable``; one whose own phase differs from its name is left out."""
    name = T.base_name(F.col("path"))
    rows = texts.select("doc_id", F.regexp_extract(name, r"^gate_(\d_[a-z]+(?:_build|_compile)?)_(.+)\.json\z", 1).alias("phase"), F.regexp_extract(name, r"^gate_(\d_[a-z]+(?:_build|_compile)?)_(.+)\.json\z", 2).alias("gate"), F.when(F.try_parse_json("text").isNotNull(), F.col("text")).alias("j")).where("phase <> ''")
    inner = F.get_json_object("j", "$.phase")
    return rows.where(F.col("j").isNull() | (inner == F.col("phase"))).select("doc_id", "phase", "gate", F.when(F.col("j").isNull(), "unreadable").otherwise(F.get_json_object("j", "$.status")).alias("status"))


def page_skeletons(pages: DataFrame) -> DataFrame:
    """HTML pages (page_id, url, html) as skeleton texts: headings, paragraphs, list items, footers and ads as zones."""
    t = F.coalesce("html", F.lit(""))
    t = F.regexp_replace(t, r"(?is)<(script|style)\b.*?</\1\s*>", "")
    for n in range(1, 7):
        t = F.regexp_replace(t, rf"(?is)<h{n}\b[^>]*>(.*?)</h{n}\s*>", "\n" + "#" * n + " $1\n")
    t = F.regexp_replace(t, r"(?is)<li\b[^>]*>(.*?)</li\s*>", "\n- $1")
    t = F.regexp_replace(t, r'(?is)<footer\b[^>]*>(.*?)</footer\s*>', "\n<!-- meta:zone footer -->\n$1\n<!-- meta:zone_end -->\n")
    t = F.regexp_replace(t, r'(?is)<div class="ad"[^>]*>(.*?)</div\s*>', "\n<!-- meta:zone header -->\n$1\n<!-- meta:zone_end -->\n")
    t = F.regexp_replace(t, r"(?i)<(p|br|div|ul|ol|tr)\b[^>]*>|</(p|div|ul|ol|tr)\s*>", "\n")
    t = F.regexp_replace(t, r"(?s)<(?!!--)[^>]*>", "")
    return pages.select(F.col("page_id").cast("string").alias("doc_id"), F.col("url").alias("source_file"), F.lit(".md").alias("fmt"), t.alias("text"))
