"""Skeleton text to blocks, with windows and aggregates over lines.

One exchange by document serves all windows.  Lines get a class by a ladder of patterns (first match wins); blocks of
several lines are islands of their class; what a block inherits (page, slide, sheet, zone, heading path) is the last
value before it.

Known limits, both about lines that are malformed anyway: a fence inside the look-ahead of a numbered formula opens a
code block, and a line of a list or table that also is a comment is a comment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..schema import BLOCKS, PAYLOADS

LOOK_AHEAD = 9
MAX_FORMULA_LEAD = 100
IMAGE_DIR = "extracted/images"

_IMAGE = r"<!--\s*IMAGE:\s*(.+?)\s*-->"
_PAGE = r"<!--\s*meta:page_start\s+page=(\d+)\s*-->"
_ZONE = r"<!--\s*meta:zone\s+([a-z_]+)\s*-->"
_HEADING = r"^(#{1,6})\s+(.*)\z"
_LIST = r"^([-*+]|\d+\.)\s+(.*)\z"
_EQUATION_LINE = r"^\(?(\d+)\)\z"
_EQUATION_END = r"\((\d+)\)\s*\z"
#: Class of a line by the first pattern that it matches; lines are stripped.
LADDER = (
    ("page", _PAGE),
    ("zone", _ZONE),
    ("zone_end", r"<!--\s*meta:zone_end\s*-->"),
    ("image", _IMAGE),
    ("placeholder", r"^\[VISION_PLACEHOLDER_(.+?)\]\z"),
    ("comment", r"^<!--.*-->\z"),
    ("fence", "^```"),
    ("table", r"^\|"),
    ("heading", _HEADING),
    ("formula", r"^\${1,2}[^$]+\${1,2}\z"),
    ("lead", rf"^H\s*[zs]\s*=(?=.{{0,{MAX_FORMULA_LEAD}}}\z)"),
    ("list", _LIST),
)


def line_class(s: Column) -> Column:
    c = F.when(s == "", "blank")
    for name, pattern in LADDER:
        hit = s.rlike(pattern)
        c = c.when(hit & (F.length(s) <= MAX_FORMULA_LEAD) if name == "lead" else hit, name)
    return c.otherwise("para")


def lines(docs: DataFrame) -> DataFrame:
    """``docs (doc_id, source_file, fmt, text)`` to numbered lines with their class; code is one class."""
    rows = docs.select("doc_id", "source_file", F.lower("fmt").alias("fmt"), F.posexplode(T.lines(F.col("text"))).alias("ln", "raw"))
    rows = rows.withColumn("s", T.strip(F.col("raw"))).withColumn("cls", line_class(F.col("s")))
    by_doc = W.partitionBy("doc_id").orderBy("ln")
    before = by_doc.rowsBetween(W.unboundedPreceding, 0)
    fences = F.sum((F.col("cls") == "fence").cast("int")).over(before)
    rows = rows.withColumn("fences", fences)
    return rows.withColumn("cls", F.when((F.col("fences") % 2 == 1) | (F.col("cls") == "fence"), "code").otherwise(F.col("cls")))


def _formula_ends(rows: DataFrame) -> DataFrame:
    """The line on which a numbered formula ends, for its first line; lines within it."""
    by_doc = W.partitionBy("doc_id").orderBy("ln")
    ahead = F.collect_list(F.struct("ln", "s", "cls")).over(by_doc.rowsBetween(1, LOOK_AHEAD))
    ends = lambda x: x["s"].rlike(_EQUATION_LINE) | x["s"].rlike(_EQUATION_END)
    stops = lambda x: x["s"].rlike(_HEADING) | x["s"].startswith("|") | x["s"].startswith("<!--")
    first = F.get(F.filter(F.col("ahead"), lambda x: (x["s"] != "") & (ends(x) | stops(x))), F.lit(0))
    rows = rows.withColumn("ahead", F.when(F.col("cls") == "lead", ahead))
    end = F.when((F.col("cls") == "lead") & first.isNotNull() & ~stops(first), first["ln"])
    rows = rows.withColumn("end", end).drop("ahead")
    within = F.max("end").over(by_doc.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("inside", F.coalesce(within >= F.col("ln"), F.lit(False)))
    cls = F.when(F.col("inside") & (F.col("cls") != "code"), "in_formula").when((F.col("cls") == "lead") & F.col("end").isNotNull(), "numbered")
    # a lead without an end is what the ladder says below it
    cls = cls.when(F.col("cls") == "lead", F.when(F.col("s").rlike(_LIST), "list").otherwise("para")).otherwise(F.col("cls"))
    return rows.withColumn("cls", cls)


def _image_parts(rows: DataFrame) -> DataFrame:
    raw = F.regexp_extract("s", _IMAGE, 1)
    words = F.split(T.strip(raw), r"\s+")
    pairs = F.transform(F.filter(F.slice(words, 2, 1000), lambda x: x.contains("=")), lambda x: F.struct(F.regexp_extract(x, "^([^=]*)=", 1).alias("k"), F.regexp_extract(x, "^[^=]*=(.*)", 1).alias("v")))
    rows = rows.withColumn("pairs", F.when(F.col("cls") == "image", pairs))
    last = F.filter(F.col("pairs"), lambda x: x["k"] == "zone")
    rows = rows.withColumn("file", F.when(F.col("cls") == "image", F.get(words, F.lit(0))).when(F.col("cls") == "placeholder", F.regexp_extract("s", LADDER[4][1], 1)))
    own_zone = F.when(F.size(last) > 0, F.get(last, F.size(last) - 1)["v"])
    render = F.exists(F.coalesce(F.col("pairs"), F.array().cast("array<struct<k:string,v:string>>")), lambda x: (x["k"] == "page_render") & (x["v"] == "true"))
    return rows.withColumn("own_zone", own_zone).withColumn("page_render", render).drop("pairs")


def _islands(rows: DataFrame) -> DataFrame:
    """``island``: the first line of the block that a line belongs to."""
    by_doc = W.partitionBy("doc_id").orderBy("ln")
    prev = F.lag("cls").over(by_doc)
    fence = F.floor((F.col("fences") + 1) / 2)
    same = (F.col("cls") == prev) & (F.col("cls").isin("table", "list") | ((F.col("cls") == "code") & (fence == F.lag(fence).over(by_doc))))
    same = same | ((F.col("cls") == "in_formula") & prev.isin("numbered", "in_formula"))
    start = F.when(F.coalesce(same, F.lit(False)), None).otherwise(F.col("ln"))
    return rows.withColumn("island", F.last(start, ignorenulls=True).over(by_doc.rowsBetween(W.unboundedPreceding, 0)))


def _context(rows: DataFrame) -> DataFrame:
    before = W.partitionBy("doc_id").orderBy("ln").rowsBetween(W.unboundedPreceding, 0)
    carry = lambda c: F.last(c, ignorenulls=True).over(before)
    head = F.when(F.col("cls") == "heading", T.strip(F.regexp_extract("s", _HEADING, 2)))
    rows = rows.withColumn("h_text", head).withColumn("h_level", F.when(F.col("cls") == "heading", F.length(F.regexp_extract("s", _HEADING, 1))))
    number = lambda c, p, cls=None: F.when(F.regexp_extract(c, p, 1) != "", F.regexp_extract(c, p, 1).cast("int"))
    rows = rows.withColumn("page", carry(F.when(F.col("cls") == "page", F.regexp_extract("s", _PAGE, 1).cast("int"))))
    rows = rows.withColumn("slide", carry(number(F.col("h_text"), r"^Slide\s+(\d+)\s*[:：]\s*(.*)\z")))
    sheet = r"^Sheet\s*[:：]\s*(.*)\z"
    rows = rows.withColumn("sheet", carry(F.when(F.col("h_text").rlike(sheet), T.strip(F.regexp_extract("h_text", sheet, 1)))))
    zone = F.when(F.col("cls") == "zone", F.regexp_extract("s", _ZONE, 1)).when(F.col("cls") == "zone_end", "")
    rows = rows.withColumn("zone", F.nullif(carry(zone), F.lit("")))
    # a heading of level l stands in the path while no heading of a smaller or equal level came after it
    last = [carry(F.when(F.col("h_level") == lv, F.struct("ln", "h_text"))) for lv in range(1, 7)]
    rows = rows.withColumns({f"h{lv}": c for lv, c in enumerate(last, 1)})
    parts = []
    for lv in range(1, 7):
        later = [F.coalesce(F.col(f"h{k}.ln"), F.lit(-1)) for k in range(1, lv)]
        top = F.greatest(F.lit(-1), *later) if later else F.lit(-1)
        parts.append(F.when(F.col(f"h{lv}.ln") > top, F.col(f"h{lv}.h_text")))
    return rows.withColumn("heading_path", F.filter(F.array(*parts), lambda x: x.isNotNull())).drop(*[f"h{lv}" for lv in range(1, 7)])


def split_row(r: Column) -> Column:
    """Cells of a table row; all edge pipes are dropped and escapes are not honoured."""
    return F.transform(F.split(F.regexp_replace(T.strip(r), r"^\|+|\|+\z", ""), r"\|", -1), T.strip)


def latex_text(c: Column) -> Column:
    """A plain formula line as LaTeX: minus signs, indices of ``a`` and ``b``, powers of ``z``."""
    s = F.replace(F.replace(c, F.lit("−"), F.lit("-")), F.lit(" "), F.lit(" "))
    s = F.regexp_replace(F.regexp_replace(s, r"([ab])(\d+)", "$1_{$2}"), "z-([0-9A-Za-z]+)", "z^{-$1}")
    return T.strip(F.regexp_replace(s, T.WS + "+", " "))


def anchor(fmt: Column, source: Column, ordinal: Column) -> Column:
    """The anchor of a block by the format of its source; ``keys`` are the fields that the format has."""
    fields = ("source_file", "page", "page_label", "slide", "sheet", "range", "heading_path", "paragraph_index", "block_index")
    values = {
        "source_file": source, "page": F.col("page"), "page_label": F.when(F.col("page") != 0, F.concat(F.lit("p."), F.col("page"))), "slide": F.col("slide"), "sheet": F.col("sheet"),
        "range": F.lit(None).cast("string"), "heading_path": F.col("heading_path"), "paragraph_index": ordinal.cast("int"), "block_index": ordinal.cast("int"),
    }
    types = {"page": "int", "slide": "int", "paragraph_index": "int", "block_index": "int", "heading_path": "array<string>"}

    def of(kind: str, *keys: str, **over) -> Column:
        cols = [F.lit(kind).alias("kind")]
        for f in fields:
            v = over.get(f, values[f]) if f in keys else F.lit(None)
            cols.append(v.cast(types.get(f, "string")).alias(f))
        return F.struct(*cols, F.array(F.lit("kind"), *map(F.lit, keys)).alias("keys"))

    return (
        F.when(fmt == ".pdf", of("pdf_page", "source_file", "page", "page_label"))
        .when(fmt == ".pptx", of("slide", "source_file", "slide"))
        .when(fmt == ".xlsx", of("sheet_range", "source_file", "sheet", "range"))
        .when(fmt == ".docx", of("docx_anchor", "source_file", "page", "heading_path", "paragraph_index", page=F.lit(None)))
        .otherwise(of("text_anchor", "source_file", "heading_path", "block_index"))
    )


def _payload(kind: str, **fields) -> Column:
    """A payload struct with the given fields, the others null."""
    from pyspark.sql.types import _parse_datatype_string

    schema = _parse_datatype_string(PAYLOADS[kind])
    return F.struct(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def parse(docs: DataFrame) -> DataFrame:
    """Blocks of ``docs (doc_id, source_file, fmt, text)``."""
    rows = _context(_islands(_formula_ends(lines(docs))))
    rows = _image_parts(rows)
    by_doc = W.partitionBy("doc_id").orderBy("ln")
    # a placeholder right after its image comment belongs to it
    seen = F.last(F.when(F.col("cls") != "blank", F.col("cls")), ignorenulls=True).over(by_doc.rowsBetween(W.unboundedPreceding, -1))
    rows = rows.withColumn("swallowed", (F.col("cls") == "placeholder") & F.coalesce(seen == "image", F.lit(False)))
    kept = rows.where(F.col("cls").isin("image", "placeholder", "code", "table", "heading", "formula", "numbered", "in_formula", "list", "para") & ~F.col("swallowed") & ~F.col("page_render"))
    first = lambda c: F.min_by(c, "ln").alias(c)
    groups = kept.groupBy("doc_id", "island").agg(
        *[first(c) for c in ("source_file", "fmt", "cls", "s", "raw", "page", "slide", "sheet", "zone", "own_zone", "heading_path", "h_text", "h_level", "file")],
        F.transform(F.array_sort(F.collect_list(F.struct("ln", "raw", "s"))), lambda x: x["raw"]).alias("raws"),
        F.transform(F.array_sort(F.collect_list(F.struct("ln", "s"))), lambda x: x["s"]).alias("ss"),
    )
    s, ss = F.col("s"), F.col("ss")
    at = F.array_position(F.transform(ss, lambda x: x.rlike(r"\|\s*:?-{3,}")), True).cast("int")  # 1-based, 0 if none
    groups = groups.withColumn("sep", F.when(F.col("cls") == "table", at))
    kind = (
        F.when(F.col("cls").isin("image", "placeholder"), "figure").when((F.col("cls") == "table") & (F.col("sep") == 0), "para")
        .when(F.col("cls") == "numbered", "formula").otherwise(F.col("cls"))
    )
    groups = groups.withColumn("type", kind)
    order = W.partitionBy("doc_id").orderBy("island")
    groups = groups.withColumn("ord", F.row_number().over(order)).withColumn("n", F.row_number().over(W.partitionBy("doc_id", "type").orderBy("island")))

    header_at = F.greatest(F.col("sep") - 1, F.lit(1))
    columns = split_row(F.get(ss, header_at - 1))
    data = F.transform(F.slice(ss, F.col("sep") + 1, F.greatest(F.size(ss), F.lit(1))), split_row)
    pre = F.slice(ss, 1, F.greatest(header_at - 1, F.lit(0)))
    hard = F.when(F.forall(data, lambda r: F.size(r) == F.size(columns)), "pass").otherwise("fail")
    cells = F.transform(data, lambda r: F.transform(r, lambda x: F.struct(x.alias("text"), F.lit(1).alias("rowspan"), F.lit(1).alias("colspan"))))
    title = F.nullif(F.array_join(F.transform(pre, lambda r: T.strip(F.array_join(split_row(r), " "))), " / "), F.lit(""))

    raw = F.filter(F.slice(ss, 1, F.size(ss) - 1), lambda x: x != "")
    end_line = F.element_at(ss, -1)
    end_body = T.strip(F.regexp_replace(end_line, _EQUATION_END, ""))
    lone = end_line.rlike(_EQUATION_LINE)
    number = F.when(lone, F.regexp_extract(end_line, _EQUATION_LINE, 1)).otherwise(F.regexp_extract(end_line, _EQUATION_END, 1))
    body = F.when(end_body == "", raw).otherwise(F.array_append(raw, end_body))
    fraction = F.concat(F.lit("H(z)=\\frac{"), latex_text(F.get(body, F.lit(1))), F.lit("}{"), latex_text(F.array_join(F.slice(body, 3, 100), " ")), F.lit("}"))
    numbered = F.when((F.size(body) >= 3) & s.rlike(r"^H\s*z\s*="), fraction).otherwise(latex_text(F.array_join(body, " ")))

    item = lambda x: T.strip(F.regexp_extract(x, _LIST, 2))
    fence_closed = (F.size(ss) > 1) & F.element_at(ss, -1).startswith("```")
    code_lines = F.slice(F.col("raws"), 2, F.greatest(F.size(ss) - F.when(fence_closed, 2).otherwise(1), F.lit(0)))
    tag = F.regexp_extract(s, r"^>\s*\[([^\]:：]+)", 1)
    is_cls, is_type = (lambda x: F.col("cls") == x), (lambda x: F.col("type") == x)
    payload = {
        "heading": F.when(is_type("heading"), _payload("heading", level=F.col("h_level"), text=F.col("h_text"))),
        "content": F.when(is_type("list"), _payload("content", items=F.transform(ss, item), ordered=s.rlike(r"^\d+\.")))
        .when(is_cls("table") & is_type("para"), _payload("content", text=F.array_join(ss, "\n"), quote=F.lit(False)))
        .when(is_type("para"), _payload("content", text=s, quote=s.startswith(">"), placeholder_type=F.nullif(tag, F.lit("")))),
        "table": F.when(is_type("table"), _payload("table", columns=columns, header_rows=F.array().cast("array<int>"), rows=cells, hard_column_check=hard)),
        "figure": F.when(is_type("figure"), _payload("figure", asset_id=F.concat(F.lit("asset_"), T.stem(F.col("file"))), asset_file=F.concat(F.lit(IMAGE_DIR + "/"), F.col("file")), estimated_values=F.array())),
        "formula": F.when(is_cls("formula"), _payload("formula", latex=F.regexp_replace(s, r"^[$ ]+|[$ ]+\z", ""), plain_text_source=s, visual_check=F.lit("pending")))
        .when(is_cls("numbered"), _payload("formula", equation_no=number, latex=numbered, plain_text_source=F.array_join(F.array_append(body, end_line), "\n"), visual_check=F.lit("needs_review"))),
        "code": F.when(is_type("code"), _payload("code", language=F.nullif(T.strip(F.substring(s, 4, 10_000)), F.lit("")), text=F.array_join(code_lines, "\n"))),
    }
    confidence = F.when(is_type("table"), 0.95).when(is_cls("formula"), 0.9).when(is_cls("numbered"), 0.75).when(is_type("figure"), 0.5).otherwise(1.0)
    review = F.when(is_type("table"), (hard != "pass") | (F.col("sep") == 1) | (F.size(pre) > 0)).otherwise(F.col("type").isin("formula", "figure"))
    out = groups.select(
        "doc_id", "ord", F.format_string("block_%s_%03d", F.col("type"), F.col("n")).alias("id"), "type", anchor(F.col("fmt"), F.col("source_file"), F.col("ord")).alias("source_anchor"),
        confidence.alias("confidence"), review.alias("needs_review"), F.coalesce("own_zone", "zone").alias("source_zone"), F.when(is_type("table"), title).alias("title"),
        *[c.alias(k) for k, c in payload.items()],
    )
    return out.select([F.col(f.split(" ", 1)[0]) for f in BLOCKS.split(", ")])
