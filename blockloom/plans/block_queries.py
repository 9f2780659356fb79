"""Queries over block tables made of parts, orders, conversations and inline skeletons."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators import audit, bind, compile, evidence, ledger, parse, project, quality, render
from ..schema import ISSUES
from . import vehicles as V

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


# ---- the parser over skeletons made of parts: a brand is a document, a part gives one or more lines -------------

KIND = "p_partkey % 9"


def part_skeletons(spark, sf):
    """Headings, list lines, table rows, fences, formulas, images and paragraphs from the parts of a brand."""
    p = V.read(spark, sf, "part")
    k, name, size = F.pmod("p_partkey", F.lit(9)), F.col("p_name"), F.col("p_size").cast("string")
    line = (
        F.when(k == 0, F.concat(F.repeat(F.lit("#"), F.pmod("p_size", F.lit(6)) + 1), F.lit(" "), name))
        .when(k.isin(1, 2), F.concat(F.lit("- "), name)).when(k == 3, F.concat(F.lit("| "), name, F.lit(" | "), size, F.lit(" |\n| --- | --- |\n| "), size, F.lit(" | "), name, F.lit(" |\n")))
        .when(k == 4, F.concat(F.lit("```sql\n"), name, F.lit("\n\n# "), size, F.lit("\n```"))).when(k == 5, F.concat(F.lit("$$x_{"), size, F.lit("}$$")))
        .when(k == 6, F.concat(F.lit("<!-- IMAGE: img"), F.col("p_partkey").cast("string"), F.lit(".png -->\n\n[VISION_PLACEHOLDER_img"), F.col("p_partkey").cast("string"), F.lit(".png]")))
        .when(k == 7, F.concat(F.lit("<!-- meta:page_start page="), size, F.lit(" -->\n"), name)).otherwise(F.concat(F.lit("> "), name))
    )
    lines = F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", line.alias("line")))), lambda x: x["line"])
    return p.groupBy(F.col("p_brand").alias("doc_id")).agg(F.array_join(lines, "\n").alias("text")).select("doc_id", F.lit("source/parts.pdf").alias("source_file"), F.lit(".pdf").alias("fmt"), "text")


#: One row for each block: the two list kinds merge where they follow each other in a brand.
BLOCKS_SQL = f"""r AS (SELECT *, {KIND} AS k, lag({KIND}) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS pk FROM part),
i AS (SELECT *, sum(CASE WHEN k IN (1, 2) AND pk IN (1, 2) THEN 0 ELSE 1 END) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS ord FROM r),
b AS (SELECT p_brand AS doc_id, CAST(ord AS INTEGER) AS ord, min(p_partkey) AS part, min(k) AS k, min(p_size) AS size, min(p_name) AS name, list(p_name ORDER BY p_partkey) AS names FROM i GROUP BY 1, 2),
t AS (SELECT *, CASE WHEN k = 0 THEN 'heading' WHEN k IN (1, 2) THEN 'list' WHEN k = 3 THEN 'table' WHEN k = 4 THEN 'code' WHEN k = 5 THEN 'formula' WHEN k = 6 THEN 'figure' ELSE 'para' END AS type FROM b)"""


@query(f"""WITH {BLOCKS_SQL} SELECT doc_id, ord, 'block_' || type || '_' || lpad(CAST(row_number() OVER (PARTITION BY doc_id, type ORDER BY ord) AS VARCHAR), 3, '0') AS id, type,
CASE type WHEN 'table' THEN 0.95 WHEN 'formula' THEN 0.9 WHEN 'figure' THEN 0.5 ELSE 1.0 END AS confidence, type IN ('formula', 'figure') AS needs_review FROM t""")
def block_ids(spark, sf):
    return parse.parse(part_skeletons(spark, sf)).select("doc_id", "ord", "id", "type", "confidence", "needs_review")


@query(f"""WITH {BLOCKS_SQL} SELECT doc_id, ord, max(CASE WHEN k = 7 THEN ord END) OVER (PARTITION BY doc_id ORDER BY ord) IS NULL AS before_pages,
 last_value(CASE WHEN k = 7 THEN size END IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS page FROM t""")
def page_context(spark, sf):
    b = parse.parse(part_skeletons(spark, sf))
    return b.select("doc_id", "ord", F.col("source_anchor.page").isNull().alias("before_pages"), F.col("source_anchor.page").alias("page"))


@query(f"WITH {BLOCKS_SQL} SELECT doc_id, ord, array_to_string(names, ',') AS items, FALSE AS ordered FROM t WHERE type = 'list'")
def list_islands(spark, sf):
    return parse.parse(part_skeletons(spark, sf)).where("type = 'list'").select("doc_id", "ord", F.array_join("content.items", ",").alias("items"), "content.ordered")


@query(f"WITH {BLOCKS_SQL} SELECT doc_id, ord, name || '|' || size AS columns, size || '|' || name AS cells, 'pass' AS hard FROM t WHERE type = 'table'")
def table_blocks(spark, sf):
    t = parse.parse(part_skeletons(spark, sf)).where("type = 'table'")
    cells = F.array_join(F.transform(F.flatten("table.rows"), lambda c: c["text"]), "|")
    return t.select("doc_id", "ord", F.array_join("table.columns", "|").alias("columns"), cells.alias("cells"), F.col("table.hard_column_check").alias("hard"))


@query(f"WITH {BLOCKS_SQL} SELECT doc_id, ord, 'sql' AS language, name || chr(10) || chr(10) || '# ' || size AS text FROM t WHERE type = 'code'")
def code_fences(spark, sf):
    return parse.parse(part_skeletons(spark, sf)).where("type = 'code'").select("doc_id", "ord", "code.language", "code.text")


@query(f"WITH {BLOCKS_SQL} SELECT doc_id, ord, 'x_{{' || size || '}}' AS latex, '$$x_{{' || size || '}}$$' AS source FROM t WHERE type = 'formula'")
def standalone_formulas(spark, sf):
    return parse.parse(part_skeletons(spark, sf)).where("type = 'formula'").select("doc_id", "ord", "formula.latex", F.col("formula.plain_text_source").alias("source"))


@query(f"WITH {BLOCKS_SQL} SELECT doc_id, ord, 'asset_img' || part AS asset_id, 'extracted/images/img' || part || '.png' AS file FROM t WHERE type = 'figure'")
def image_blocks(spark, sf):
    return parse.parse(part_skeletons(spark, sf)).where("type = 'figure'").select("doc_id", "ord", "figure.asset_id", F.col("figure.asset_file").alias("file"))


@query("""WITH h AS (SELECT p_brand, p_partkey, p_name, p_size % 6 + 1 AS lv FROM part)
SELECT a.p_brand AS doc_id, a.p_name AS text, string_agg(b.p_name, ' > ' ORDER BY b.p_partkey) AS path FROM h a JOIN h b ON a.p_brand = b.p_brand AND b.p_partkey <= a.p_partkey
WHERE NOT EXISTS (SELECT 1 FROM h c WHERE c.p_brand = a.p_brand AND c.p_partkey > b.p_partkey AND c.p_partkey <= a.p_partkey AND c.lv <= b.lv) GROUP BY a.p_brand, a.p_name, a.p_partkey""")
def heading_path(spark, sf):
    p = V.read(spark, sf, "part").withColumn("line", F.concat(F.repeat(F.lit("#"), F.pmod("p_size", F.lit(6)) + 1), F.lit(" "), F.col("p_name")))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", "line"))), lambda x: x["line"]), "\n")
    docs = p.groupBy(F.col("p_brand").alias("doc_id")).agg(text.alias("text")).select("doc_id", F.lit("f.md").alias("source_file"), F.lit(".md").alias("fmt"), "text")
    return parse.parse(docs).select("doc_id", "heading.text", F.array_join("source_anchor.heading_path", " > ").alias("path"))


@query("""WITH n AS (SELECT p_partkey, p_size, 'H z =' || chr(10) || 'b0 + b' || p_size || 'z−1' || chr(10) || chr(10) || '1 + a1z−' || p_size || ' (' || p_size || ')' AS t FROM part)
SELECT CAST(p_partkey AS VARCHAR) AS doc_id, CAST(p_size AS VARCHAR) AS number, 'H(z)=\\frac{b_{0} + b_{' || p_size || '}z^{-1}}{1 + a_{1}z^{-' || p_size || '}}' AS latex FROM n""")
def numbered_formula(spark, sf):
    s = F.col("p_size").cast("string")
    text = F.concat(F.lit("H z =\nb0 + b"), s, F.lit("z−1\n\n1 + a1z−"), s, F.lit(" ("), s, F.lit(")"))
    docs = V.read(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("doc_id"), F.lit("f.pdf").alias("source_file"), F.lit(".pdf").alias("fmt"), text.alias("text"))
    return parse.parse(docs).select("doc_id", F.col("formula.equation_no").alias("number"), "formula.latex")


# ---- projections ------------------------------------------------------------------------------------------------


@query("""SELECT CAST(conv_id AS VARCHAR) AS doc_id, 't' || turn AS id, '〔源 ' || role || ' / 段 ' || turn || '〕' AS anchor FROM conversations
UNION ALL SELECT p_brand, 'h' || p_partkey, '〔源 p.' || p_size || '〕' FROM part""")
def anchor_texts(spark, sf):
    rows = V.turn_blocks(spark, sf).unionByName(V.part_headings(spark, sf))
    return project.provenance(rows).select("doc_id", "id", project.anchor_text(F.col("source_anchor")).alias("anchor"))


@query("""WITH k AS (SELECT p_partkey, p_size, p_name, p_partkey % 4 AS k FROM part)
SELECT p_partkey, CASE WHEN k = 0 AND p_size <> 0 THEN 'p' || lpad(CAST(p_size AS VARCHAR), 3, '0') WHEN k = 1 AND p_size <> 0 THEN 'slide' || lpad(CAST(p_size AS VARCHAR), 2, '0') WHEN k = 2 THEN 'sheet_' || replace(p_name, ' ', '_') ELSE 'doc' END AS ref,
CASE k WHEN 0 THEN '〔源 p.' || p_size || '〕' WHEN 1 THEN '〔源 slide ' || p_size || '〕' WHEN 2 THEN '〔源 ' || p_name || '!A1:B2〕' ELSE '〔源 正文〕' END AS mark FROM k""")
def source_refs(spark, sf):
    k = F.pmod("p_partkey", F.lit(4))
    p = V.read(spark, sf, "part")
    a = V.source_anchor(kind=F.when(k == 0, "pdf_page").when(k == 1, "slide").when(k == 2, "sheet_range").otherwise("text_anchor"), page=F.when(k == 0, F.col("p_size")), slide=F.when(k == 1, F.col("p_size")), sheet=F.when(k == 2, F.col("p_name")), range=F.when(k == 2, "A1:B2"), keys=F.array(F.lit("kind")))
    rows = p.withColumn("a", a)
    return rows.select("p_partkey", project.source_ref(F.col("a")).alias("ref"), project.anchor_text(F.col("a")).alias("mark"))


def figure_blocks(spark, sf):
    """Parts as figures (size divisible by 3), captions (remainder 1) and paragraphs that cite (2)."""
    p = V.read(spark, sf, "part")
    k, s = F.pmod("p_size", F.lit(3)), F.col("p_size").cast("string")
    text = F.when(k == 1, F.concat(F.lit("Figure "), s, F.lit(" "), F.col("p_name"))).when(k == 2, F.concat(F.lit("see Figure "), (F.col("p_size") - 1).cast("string"), F.lit(" or Figure 1.5x")))
    rank = F.row_number().over(W.partitionBy("p_brand").orderBy("p_partkey"))
    rows = p.withColumn("k", k).withColumn("text", text).withColumn("rank", rank)
    return V.blocks(
        rows, doc_id=F.col("p_brand"), ord=F.col("rank"), id=F.concat(F.lit("b"), F.col("p_partkey")), type=F.when(F.col("k") == 0, "figure").otherwise("para"), confidence=F.lit(0.5), needs_review=F.lit(True),
        source_anchor=V.source_anchor(kind=F.lit("pdf_page"), source_file=F.col("p_type"), page=F.col("p_size"), keys=F.array(F.lit("source_file"), F.lit("page"))),
        content=F.when(F.col("k") != 0, V.payload("content", text=F.col("text"))), figure=F.when(F.col("k") == 0, V.payload("figure", asset_id=F.concat(F.lit("asset_"), F.col("p_name")), asset_file=F.concat(F.lit("extracted/images/"), F.col("p_name"), F.lit(".png")), estimated_values=F.array())),
    )


FIGS = """f AS (SELECT p_brand AS d, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS ord, 'b' || p_partkey AS id, p_size % 3 AS k, p_size, p_name, p_type FROM part),
w AS (SELECT *, lead(k) OVER v AS nk, lag(k) OVER v AS pk, lag(k, 2) OVER v AS ppk, lead(p_size) OVER v AS ns, lag(p_size) OVER v AS ps, lead(id) OVER v AS ni, lag(id) OVER v AS pi FROM f WINDOW v AS (PARTITION BY d ORDER BY ord)),
c AS (SELECT *, CASE WHEN nk = 1 THEN ns WHEN pk = 1 AND coalesce(ppk, 9) <> 0 THEN ps END AS num, CASE WHEN nk = 1 THEN ni WHEN pk = 1 AND coalesce(ppk, 9) <> 0 THEN pi END AS cap FROM w WHERE k = 0)"""


@query(f"WITH {FIGS} SELECT d AS doc_id, id, CASE WHEN num IS NOT NULL THEN 'Figure ' || num END AS figure_no, cap AS caption_block FROM c")
def caption_binding(spark, sf):
    b = bind.bind_captions(figure_blocks(spark, sf))
    figs = b.where("type = 'figure'").select("doc_id", "id", "figure.figure_no")
    caps = b.where("content.is_caption_for is not null").select("doc_id", F.col("id").alias("caption_block"), F.col("content.is_caption_for").alias("id"))
    return figs.join(caps, ["doc_id", "id"], "left").select("doc_id", "id", "figure_no", "caption_block")


@query(f"""WITH {FIGS}, n AS (SELECT d, num, max_by(id, ord) AS t FROM c WHERE num IS NOT NULL GROUP BY 1, 2)
SELECT f.d AS doc_id, f.id AS "from", n.t AS "to", 'references' AS type FROM f JOIN n ON f.d = n.d AND n.num = f.p_size - 1 WHERE f.k = 2
UNION SELECT f.d, f.id, n.t, 'references' FROM f JOIN n ON f.d = n.d AND n.num = f.p_size WHERE f.k = 1 AND f.id NOT IN (SELECT cap FROM c WHERE c.d = f.d AND cap IS NOT NULL)""")
def figure_references(spark, sf):
    return bind.references(bind.bind_captions(figure_blocks(spark, sf)))


@query(f"""WITH {FIGS}, b AS (SELECT c.d, c.id, c.ord, 'fig_' || CASE WHEN c.p_size = 0 THEN 'doc' ELSE 'p' || lpad(CAST(c.p_size AS VARCHAR), 3, '0') END || '_' || CASE WHEN num IS NULL THEN 'asset_' || lpad(CAST(row_number() OVER (PARTITION BY c.d ORDER BY c.ord) AS VARCHAR), 3, '0')
 ELSE trim(left(lower(replace('Figure ' || num || ' ' || q.p_name, ' ', '_')), 40), '_') END AS body FROM c LEFT JOIN f q ON q.d = c.d AND q.id = c.cap),
k AS (SELECT *, row_number() OVER (PARTITION BY d, body ORDER BY ord) AS k FROM b)
SELECT d AS doc_id, id, CASE WHEN k = 1 THEN body ELSE left(body, 93) || '_' || lpad(CAST(k AS VARCHAR), 2, '0') END || '.png' AS asset_name FROM k""")
def asset_names(spark, sf):
    return bind.asset_names(bind.bind_captions(figure_blocks(spark, sf))).select("doc_id", "id", "asset_name")


@query(f"""WITH {FIGS} SELECT d AS doc_id, 'asset_' || p_name AS asset_id, 'extracted/images/' || p_name || '.png' AS file, string_agg(id, ',' ORDER BY id) AS referenced_by, p_name LIKE 'red%' AS "exists" FROM f WHERE k = 0 GROUP BY d, p_name""")
def assets_index(spark, sf):
    b = figure_blocks(spark, sf)
    files = b.where("figure.asset_file like '%/red%'").select("doc_id", F.col("figure.asset_file").alias("path"))
    return project.assets_index(b, files).select("doc_id", "asset_id", "file", F.array_join("referenced_by", ",").alias("referenced_by"), "exists")


@query(f"""WITH {FIGS} SELECT d AS doc_id, count(*) AS block_count, count(*) FILTER (k = 0) AS figure_count, count(DISTINCT CASE WHEN k = 0 THEN p_name END) AS asset_count FROM f GROUP BY 1""")
def document_stats(spark, sf):
    return project.stats(figure_blocks(spark, sf)).select("doc_id", "block_count", "figure_count", "asset_count")


@query("""SELECT CAST(conv_id AS VARCHAR) AS doc_id, role, count(*) AS n FROM conversations GROUP BY GROUPING SETS ((conv_id, role), (conv_id), ())""")
def doc_stats_rollup(spark, sf):
    b = V.turn_blocks(spark, sf).select("doc_id", F.col("source_anchor.source_file").alias("role"))
    return b.groupingSets([["doc_id", "role"], ["doc_id"], []], "doc_id", "role").agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {FIGS} SELECT d AS doc_id, CASE WHEN d = 'Brand#3' THEN 1 ELSE 0 END AS n_stale, CASE WHEN d = 'Brand#3' THEN 1 ELSE 0 END AS n_missing FROM f WHERE d = 'Brand#3' GROUP BY 1""")
def projection_regenerated(spark, sf):
    fresh = project.provenance(figure_blocks(spark, sf)).select("doc_id", "id", "source_anchor.page")
    pick = F.min("id").over(W.partitionBy("doc_id"))
    stored = fresh.withColumn("first", pick).select("doc_id", "id", F.when((F.col("doc_id") == "Brand#3") & (F.col("id") == F.col("first")), -1).otherwise(F.col("page")).alias("page"))
    return project.same_projection(stored, fresh).select("doc_id", F.col("n_stale").cast("int"), F.col("n_missing").cast("int"))


# ---- semantic rewrites -------------------------------------------------------------------------------------------


@query("""WITH h AS (SELECT p_brand AS doc_id, p_partkey, p_size % 6 + 1 AS lv FROM part WHERE p_size % 6 <> 2)
SELECT doc_id, CAST(p_partkey AS INTEGER) AS ord, CAST(dense_rank() OVER (PARTITION BY doc_id ORDER BY lv) AS INTEGER) AS level, CASE WHEN dense_rank() OVER (PARTITION BY doc_id ORDER BY lv) <> lv THEN lv END AS raw_level FROM h""")
def heading_level_rank(spark, sf):
    b = compile.normalize_levels(V.part_headings(spark, sf).where("heading.level <> 3"))
    return b.select("doc_id", "ord", "heading.level", "heading.raw_level")


PROMOTE = "CASE p_partkey % 6 WHEN 0 THEN p_size || ' ' || p_name WHEN 1 THEN p_size || '.' || p_size % 7 || ' ' || p_name WHEN 2 THEN (2000 + p_size) || ' ' || p_name WHEN 3 THEN p_size || ' to 4 ' || p_name WHEN 4 THEN p_size || ' things you should know about ' || p_name ELSE '1.1.1.1.1.1.2 ' || p_name || CASE WHEN p_size % 2 = 0 THEN '.' ELSE '' END END"


@query(f"""WITH t AS (SELECT CAST(p_partkey AS INTEGER) AS ord, p_size, p_partkey % 6 AS k, {PROMOTE} AS text FROM part)
SELECT ord, text, CASE WHEN k = 0 AND p_size <= 99 THEN 1 WHEN k = 1 THEN 2 WHEN k = 5 AND p_size % 2 <> 0 THEN 6 END AS level FROM t""")
def promote_headings(spark, sf):
    p = V.read(spark, sf, "part").withColumn("text", F.expr(PROMOTE))
    b = V.blocks(p, doc_id=F.col("p_brand"), ord=F.col("p_partkey"), id=F.concat(F.lit("p"), F.col("p_partkey")), type=F.lit("para"), content=V.payload("content", text=F.col("text")))
    return compile.promote_headings(b).select("ord", F.coalesce("heading.text", "content.text").alias("text"), "heading.level")


@query("""WITH t AS (SELECT o_custkey, o_orderkey, o_orderstatus, month(o_orderdate) AS page, lag(o_orderstatus) OVER w AS ls, lag(month(o_orderdate)) OVER w AS lp, lag(o_orderkey) OVER w AS lk FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey))
SELECT o_orderkey AS id, lk AS continues_from FROM t WHERE ls = o_orderstatus AND lp <> page""")
def table_continuation(spark, sf):
    o = V.read(spark, sf, "orders")
    b = V.blocks(o, doc_id=F.col("o_custkey").cast("string"), ord=F.col("o_orderkey"), id=F.col("o_orderkey").cast("string"), type=F.lit("table"), source_anchor=V.source_anchor(kind=F.lit("pdf_page"), page=F.month("o_orderdate")), table=V.payload("table", columns=F.array("o_orderstatus", F.lit("amount"))))
    return compile.link_tables(b).where("table.continues_from is not null").select(F.col("id").cast("long").alias("id"), F.col("table.continues_from").cast("long").alias("continues_from"))


LATEX = "CASE p_partkey % 5 WHEN 0 THEN '$x_{' || p_size || '}$' WHEN 1 THEN '$$\\left(a\\right$$' WHEN 2 THEN 'a{b' WHEN 3 THEN 'cost \\$' ELSE '' END"


@query("""WITH t AS (SELECT p_brand, p_partkey, p_partkey % 5 AS k, p_size, max(CASE WHEN p_size = 7 THEN 1 ELSE 0 END) OVER (PARTITION BY p_brand) AS has_no, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM part)
SELECT CAST(p_partkey AS INTEGER) AS ord, CASE k WHEN 0 THEN 'x_{' || p_size || '}' WHEN 1 THEN '\\left(a\\right' WHEN 2 THEN 'a{b' WHEN 3 THEN 'cost \\$' ELSE '' END AS latex,
CASE WHEN has_no = 0 THEN CAST(n AS VARCHAR) WHEN p_size = 7 THEN '7' END AS number, CASE WHEN k IN (0, 1, 3) THEN 'ok' ELSE 'needs_review' END AS visual_check, k IN (2, 4) AS needs_review FROM t""")
def normalize_formulas(spark, sf):
    p = V.read(spark, sf, "part")
    k = F.pmod("p_partkey", F.lit(5))
    latex = F.when(k == 0, F.concat(F.lit("$x_{"), F.col("p_size").cast("string"), F.lit("}$"))).when(k == 1, r"$$\left(a\right$$").when(k == 2, "a{b").when(k == 3, r"cost \$").otherwise("")
    b = V.blocks(p, doc_id=F.col("p_brand"), ord=F.col("p_partkey"), id=F.col("p_partkey").cast("string"), type=F.lit("formula"), needs_review=F.lit(False), formula=V.payload("formula", latex=latex, equation_no=F.when(F.col("p_size") == 7, "7")))
    return compile.normalize_formulas(b).select("ord", "formula.latex", F.col("formula.equation_no").alias("number"), "formula.visual_check", "needs_review")


@query(f"""WITH {FIGS} SELECT d AS doc_id, id, CASE WHEN p_name LIKE 'red%' THEN 'Figure 9: ' || p_name END AS description, CASE WHEN p_name LIKE 'red%' THEN 'Figure 9：' || p_name END AS caption, CASE WHEN p_name LIKE 'red%' THEN 0.85 ELSE 0.5 END AS confidence, p_name NOT LIKE 'red%' AS needs_review FROM f WHERE k = 0""")
def figure_backfill(spark, sf):
    b = figure_blocks(spark, sf)
    cache = b.where("figure.asset_file like '%/red%'").select("doc_id", F.element_at(F.split("figure.asset_file", "/"), -1).alias("file")).distinct().withColumn("text", F.concat(F.lit("Figure 9: "), F.regexp_replace("file", r"\.png$", "")))
    return compile.backfill_figures(b, cache).where("type = 'figure'").select("doc_id", "id", "figure.description", "figure.caption", "confidence", "needs_review")


# ---- audits ---------------------------------------------------------------------------------------------------------

COLS = "CASE p_partkey % 5 WHEN 0 THEN ['Register Name', 'Address', 'Reset'] WHEN 1 THEN ['Parameter', 'Unit', 'Max'] WHEN 2 THEN ['Item', 'Qty', 'Unit Price'] WHEN 3 THEN ['a', 'b'] ELSE ['Addr ', 'Desc'] END"


def audited_tables(spark, sf):
    p = V.read(spark, sf, "part")
    k = F.pmod("p_partkey", F.lit(5))
    of = lambda *c: F.array(*map(F.lit, c))
    cols = F.when(k == 0, of("Register Name", "Address", "Reset")).when(k == 1, of("Parameter", "Unit", "Max")).when(k == 2, of("Item", "Qty", "Unit Price")).when(k == 3, of("a", "b")).otherwise(of("Addr ", "Desc"))
    cell = lambda c, n=1: F.struct(c.alias("text"), F.lit(1).alias("rowspan"), F.lit(n).alias("colspan"))
    address = F.when(F.pmod("p_size", F.lit(3)) == 0, F.concat(F.lit("0x"), F.hex("p_size"))).when(F.pmod("p_size", F.lit(3)) == 1, "reg?").otherwise("")
    second = cell(F.when(k == 4, F.lit("x")).otherwise(address))
    first = cell(F.when(k == 4, address).otherwise(F.col("p_name")))
    row = F.when(k.isin(3, 4), F.array(first, second)).when(F.pmod("p_size", F.lit(2)) == 0, F.array(first, second, cell(F.lit("0")))).otherwise(F.array(first, second))
    rows = p.withColumns({"k": k, "cols": cols, "row": row})
    return V.blocks(rows, doc_id=F.col("p_brand"), ord=F.col("p_partkey"), id=F.concat(F.lit("t"), F.col("p_partkey")), type=F.lit("table"), source_anchor=V.source_anchor(kind=F.lit("pdf_page"), source_file=F.col("p_type"), page=F.col("p_size"), keys=F.array(F.lit("source_file"), F.lit("page"))), confidence=F.lit(0.95), needs_review=F.lit(False), title=F.when(F.col("k") == 3, F.col("p_name")), table=V.payload("table", columns=F.col("cols"), rows=F.array("row"), header_rows=F.array()))


@query("""SELECT 't' || p_partkey AS id, CASE p_partkey % 5 WHEN 0 THEN 'register' WHEN 1 THEN 'parameter' WHEN 2 THEN 'quote' WHEN 3 THEN 'generic' ELSE 'register' END AS kind, CASE p_partkey % 5 WHEN 0 THEN 'description' WHEN 2 THEN 'amount' WHEN 4 THEN 'name,reset' ELSE '' END AS missing FROM part""")
def table_classify(spark, sf):
    return audit.classified_tables(audited_tables(spark, sf)).select("id", "kind", F.array_join("lack", ",").alias("missing"))


@query("""WITH t AS (SELECT p_brand, 't' || p_partkey AS b, p_partkey % 5 AS k, p_size, '〔源 p.' || p_size || '〕' AS a FROM part),
x AS (SELECT *, 'missing_required_columns' AS code FROM t WHERE k IN (0, 2, 4) UNION ALL SELECT *, 'row_width_mismatch' FROM t WHERE k < 3 AND p_size % 2 <> 0 UNION ALL SELECT *, 'register_address_format' FROM t WHERE k IN (0, 4) AND p_size % 3 = 1)
SELECT p_brand AS doc_id, 'table_' || b || '_' || code AS id, 'major' AS severity, a AS source_anchor FROM x""")
def table_audit(spark, sf):
    return audit.audit_tables(audited_tables(spark, sf)).select("doc_id", "id", "severity", "source_anchor")


@query("""WITH t AS (SELECT p_brand, 'f' || p_partkey AS b, p_partkey % 4 AS k, p_size % 2 = 0 AS low FROM part),
x AS (SELECT *, 'empty_latex' AS code, 'major' AS s FROM t WHERE k = 0 UNION ALL SELECT *, 'unbalanced_latex', 'major' FROM t WHERE k = 1 UNION ALL SELECT *, 'needs_visual_proof', 'minor' FROM t WHERE k = 2 UNION ALL SELECT *, 'low_confidence', 'minor' FROM t WHERE low)
SELECT p_brand AS doc_id, 'formula_' || b || '_' || code AS id, s AS severity FROM x""")
def formula_audit(spark, sf):
    k = F.pmod("p_partkey", F.lit(4))
    p = V.read(spark, sf, "part")
    b = V.blocks(p, doc_id=F.col("p_brand"), ord=F.col("p_partkey"), id=F.concat(F.lit("f"), F.col("p_partkey")), type=F.lit("formula"), confidence=F.when(F.col("p_size") % 2 == 0, 0.75).otherwise(0.9), needs_review=k == 2, formula=V.payload("formula", latex=F.when(k == 0, " ").when(k == 1, r"\left(x").otherwise("x"), visual_check=F.lit("ok")))
    return audit.audit_formulas(b).select("doc_id", "id", "severity")


@query(f"""WITH {FIGS}, x AS (SELECT *, 'asset_missing' AS code, 'major' AS s FROM f WHERE k = 0 AND p_name NOT LIKE 'red%' UNION ALL SELECT *, 'caption_missing', 'minor' FROM f WHERE k = 0 UNION ALL SELECT *, 'description_missing', 'major' FROM f WHERE k = 0)
SELECT d AS doc_id, 'figure_' || id || '_' || code AS id, s AS severity FROM x""")
def asset_audit(spark, sf):
    b = figure_blocks(spark, sf)
    files = b.where("figure.asset_file like '%/red%'").select("doc_id", F.col("figure.asset_file").alias("path"))
    return audit.audit_assets(b, files).select("doc_id", "id", "severity")


@query(f"""WITH {FIGS}, x AS (SELECT *, 'asset_missing' AS code, 'major' AS s FROM f WHERE k = 0 AND p_name NOT LIKE 'red%' UNION ALL SELECT *, 'caption_missing', 'minor' FROM f WHERE k = 0 UNION ALL SELECT *, 'description_missing', 'major' FROM f WHERE k = 0)
SELECT d AS doc_id, 'figure_' || id || '_' || code AS id, s AS severity, CASE WHEN p_name LIKE 'red%' THEN 'accepted' ELSE 'open' END AS status FROM x""")
def audit_to_ledger(spark, sf):
    """Findings enter an empty ledger, some are accepted, the audit runs again and the ledger keeps what was accepted."""
    b = figure_blocks(spark, sf)
    files = b.where("figure.asset_file like '%/red%'").select("doc_id", F.col("figure.asset_file").alias("path"))
    found = audit.audit_assets(b, files)
    first = ledger.merge(spark.createDataFrame([], ISSUES), found)
    red = b.where("figure.asset_file like '%/red%'").select("doc_id", F.col("id").alias("source_block_id"), F.lit("accepted").alias("_status"))
    reviewed = first.join(red, ["doc_id", "source_block_id"], "left").withColumn("status", F.coalesce("_status", "status")).select(*first.columns)
    return ledger.unresolved(ledger.merge(reviewed, found)).select("doc_id", "id", "severity", "status")


@query(f"""WITH {FIGS} SELECT d AS doc_id, 'provenance_' || id || '_anchor_incomplete' AS id FROM f WHERE k = 0 AND p_size % 2 = 0""")
def anchor_audit(spark, sf):
    b = figure_blocks(spark, sf)
    a = F.col("source_anchor")
    b = b.withColumn("source_anchor", F.when(a["page"] % 2 == 0, a.withField("page", F.lit(None).cast("int"))).otherwise(a))
    return audit.audit_provenance(b).select("doc_id", "id")


@query("""SELECT CAST(conv_id AS VARCHAR) AS doc_id, 'provenance_comment_' || role || '_json_' || turn || '_' || code AS id FROM conversations, (VALUES ('text_missing'), ('anchor_missing')) c(code)
WHERE (code = 'text_missing' AND turn % 2 = 0) OR (code = 'anchor_missing' AND turn % 3 = 0)""")
def comment_audit(spark, sf):
    b = V.turn_blocks(spark, sf)
    c = b.select("doc_id", F.concat(F.col("source_anchor.source_file"), F.lit(".json:"), F.col("ord")).alias("origin"), F.when(F.col("ord") % 2 == 0, " ").otherwise(F.col("content.text")).alias("text"), F.when(F.col("ord") % 3 != 0, F.col("source_anchor")).alias("source_anchor"))
    return audit.audit_provenance(b, c).select("doc_id", "id")


# ---- rendering and assembly -------------------------------------------------------------------------------------------


@query("""WITH l AS (SELECT l_orderkey, string_agg('| ' || l_linenumber || ' | ' || l_returnflag || '\\|' || l_linestatus || ' |  |', chr(10) ORDER BY l_linenumber, l_partkey, l_suppkey) AS rows FROM lineitem GROUP BY 1)
SELECT CAST(l_orderkey AS VARCHAR) AS doc_id, '| n | flag | x |' || chr(10) || '| --- | --- | --- |' || chr(10) || rows AS md FROM l""")
def render_tables(spark, sf):
    li = V.read(spark, sf, "lineitem")
    cell = lambda c: F.struct(c.cast("string").alias("text"), F.lit(1).alias("rowspan"), F.lit(1).alias("colspan"))
    row = F.array(cell(F.col("l_linenumber")), cell(F.concat_ws("|", "l_returnflag", "l_linestatus")))
    rows = li.groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", row.alias("row")))), lambda x: x["row"]).alias("rows"))
    return rows.select(F.col("l_orderkey").cast("string").alias("doc_id"), render.table_markdown(F.array(*map(F.lit, ("n", "flag", "x"))), F.col("rows")).alias("md"))


@query("""WITH b AS (SELECT p_brand, p_partkey, p_name, p_size % 6 + 1 AS lv, replace(p_name, ' ', '-') AS s FROM part), k AS (SELECT *, row_number() OVER (PARTITION BY p_brand, s ORDER BY p_partkey) - 1 AS k FROM b)
SELECT p_brand AS doc_id, '## 目录' || chr(10) || chr(10) || string_agg(repeat('  ', CAST(lv - 1 AS INTEGER)) || '- [' || p_name || '](#' || s || CASE WHEN k = 0 THEN '' ELSE '-' || k END || ')', chr(10) ORDER BY p_partkey) AS toc FROM k GROUP BY 1""")
def render_toc(spark, sf):
    return render.toc(V.part_headings(spark, sf))


@query("""WITH h AS (SELECT p_brand, p_partkey, p_name, p_size, p_size % 6 + 1 AS lv FROM part), m AS (SELECT *, min(lv) OVER (PARTITION BY p_brand) AS top FROM h),
s AS (SELECT *, sum(CASE WHEN lv = top THEN 1 ELSE 0 END) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM m), z AS (SELECT *, n - min(n) OVER (PARTITION BY p_brand) AS section FROM s)
SELECT p_brand AS doc_id, CAST(section AS BIGINT) AS section, coalesce(max(CASE WHEN lv = top THEN p_name END), '前言') AS title, count(*) AS blocks, CASE WHEN min(p_size) = max(p_size) THEN 'p.' || min(p_size) ELSE 'p.' || min(p_size) || '-' || max(p_size) END AS range FROM z GROUP BY 1, 2""")
def split_sections(spark, sf):
    rows = render.sections(V.part_headings(spark, sf))
    return rows.groupBy("doc_id", "section").agg(F.first("section_title").alias("title"), F.count(F.lit(1)).alias("blocks"), render.source_range().alias("range"))


#: Parts of the documents of ``part_headings``: range, path and text.
PART_FILES = """h AS (SELECT p_brand, p_partkey, p_name, p_size, p_size % 6 + 1 AS lv, replace(p_name, ' ', '-') AS s FROM part), top AS (SELECT *, min(lv) OVER (PARTITION BY p_brand) AS top FROM h),
cut AS (SELECT *, sum(CASE WHEN lv = top THEN 1 ELSE 0 END) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS n FROM top), sec AS (SELECT *, n - min(n) OVER (PARTITION BY p_brand) AS section FROM cut),
slug AS (SELECT *, row_number() OVER (PARTITION BY p_brand, section, s ORDER BY p_partkey) - 1 AS k FROM sec),
md AS (SELECT *, '<a id="' || s || CASE WHEN k = 0 THEN '' ELSE '-' || k END || '"></a>' || chr(10) || repeat('#', CAST(lv AS INTEGER)) || ' ' || p_name || '　〔源 p.' || p_size || '〕' AS md FROM slug),
pt AS (SELECT p_brand, section, count(*) AS blocks, string_agg(md, chr(10) || chr(10) ORDER BY p_partkey) || chr(10) AS text, max(CASE WHEN lv = top THEN p_name END) AS t, CASE WHEN min(p_size) = max(p_size) THEN 'p.' || min(p_size) ELSE 'p.' || min(p_size) || '-' || max(p_size) END AS range FROM md GROUP BY 1, 2),
parts AS (SELECT p_brand, section, blocks, range, text, coalesce(t, '前言') AS title, printf('parts/%02d-', CAST(section + 1 AS INTEGER)) || CASE WHEN t IS NULL THEN replace(replace(range, '.', '_'), '-', '_') ELSE replace(t, ' ', '_') END || '.md' AS path FROM pt)"""


@query(f"WITH {PART_FILES} SELECT p_brand AS doc_id, path, text, greatest(1, strlen(text) // 4) AS approx_tokens FROM parts")
def part_files(spark, sf):
    return render.parts(V.part_headings(spark, sf)).select("doc_id", "path", "text", "approx_tokens")


@query("""WITH b AS (SELECT p_brand, count(*) AS n, sum(strlen('<a id="' || replace(p_name, ' ', '-') || '"></a># ' || p_name)) AS bytes FROM part GROUP BY 1)
SELECT p_brand AS doc_id, n > 80 OR CAST(regexp_extract(p_brand, '\\d+') AS INTEGER) * 10 > 100 AS split FROM b""")
def should_split(spark, sf):
    b = V.part_headings(spark, sf)
    pages = b.select("doc_id").distinct().withColumn("pages", F.regexp_extract("doc_id", r"\d+", 0).cast("int") * 10)
    return render.should_split(b, pages, {"max_blocks": 80, "max_markdown_bytes": 10_000_000, "max_pages": 100, "max_sheets": 3})


@query("""WITH h AS (SELECT p_brand, p_partkey, p_name, p_size, p_size % 6 + 1 AS lv, replace(p_name, ' ', '-') AS s FROM part), m AS (SELECT *, row_number() OVER (PARTITION BY p_brand, s ORDER BY p_partkey) - 1 AS k FROM h)
SELECT p_brand AS doc_id, string_agg('<a id="' || s || CASE WHEN k = 0 THEN '' ELSE '-' || k END || '"></a>' || chr(10) || repeat('#', CAST(lv AS INTEGER)) || ' ' || p_name || '　〔源 p.' || p_size || '〕', chr(10) || chr(10) ORDER BY p_partkey) AS body FROM m GROUP BY 1""")
def render_bodies(spark, sf):
    return render.bodies(V.part_headings(spark, sf))


# ---- contents, evidence ------------------------------------------------------------------------------------------------


def toc_texts(spark, sf):
    p = V.read(spark, sf, "part")
    k = F.pmod("p_partkey", F.lit(4))
    item = F.when(k == 0, F.concat(F.lit("- ["), F.col("p_size").cast("string"), F.lit(" "), F.col("p_name"), F.lit("](#a)"))).when(k == 1, F.concat(F.lit("  - [Figure 3 "), F.col("p_name"), F.lit("](#b)"))).when((k == 2) & (F.col("p_size") == 7), "- [Figure 2 x](#c)").otherwise("text")
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("p_partkey", item.alias("i")))), lambda x: x["i"]), "\n")
    return p.groupBy(F.col("p_brand").alias("doc_id")).agg(F.concat(F.lit("# T\n\n## 目录\n\n"), lines, F.lit("\n---\n- [9 x](#y)")).alias("text"))


@query("""WITH i AS (SELECT p_brand, p_partkey, p_size, p_partkey % 4 AS k FROM part), t AS (SELECT *, lag(p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS prev FROM i WHERE k = 0),
f AS (SELECT p_brand, count(*) AS n, count(*) FILTER (prev > p_size AND p_size <> 1) AS falls FROM t GROUP BY 1), l AS (SELECT p_brand, count(*) FILTER (k = 2 AND p_size = 7) AS n, count(*) FILTER (k = 1) AS deep FROM i GROUP BY 1),
r AS (SELECT l.p_brand, coalesce(f.n, 0) + l.n AS n_top, l.n AS n_labels, coalesce(f.falls, 0) AS n_falls, l.deep FROM l LEFT JOIN f USING (p_brand)),
z AS (SELECT p_brand, CASE WHEN n_top = 0 THEN deep ELSE n_top END AS n_top, CASE WHEN n_top = 0 THEN deep ELSE n_labels END AS n_labels, n_falls FROM r)
SELECT p_brand AS doc_id, n_top, n_labels, n_falls, n_labels = 0 AND n_falls = 0 AS ok FROM z""")
def toc_coherence(spark, sf):
    return quality.toc_coherence(toc_texts(spark, sf))


def marked_texts(spark, sf):
    o = V.read(spark, sf, "orders")
    k = F.pmod("o_orderkey", F.lit(3))
    line = F.when(k == 0, F.concat(F.lit("a 〔源 p."), F.month("o_orderdate").cast("string"), F.lit("〕 b 〔源 slide 2〕"))).when(k == 1, F.concat(F.lit("x 〔源 "), F.col("o_orderstatus"), F.lit(" / 段 "), F.col("o_orderkey").cast("string"), F.lit("〕"))).otherwise("plain")
    lines = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", line.alias("l")))), lambda x: x["l"]), "\n")
    return o.groupBy(F.col("o_custkey").cast("string").alias("doc_id")).agg(lines.alias("text")).select("doc_id", F.lit(0).alias("file_no"), F.lit("main.md").alias("file"), "text")


MARKS = """l AS (SELECT o_custkey, o_orderkey, o_orderkey % 3 AS k, month(o_orderdate) AS m, o_orderstatus AS st, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS line_no FROM orders),
a AS (SELECT o_custkey, line_no, 0 AS pos, 'p.' || m AS mark, 'pdf_page' AS kind, m AS idx FROM l WHERE k = 0 UNION ALL SELECT o_custkey, line_no, 1, 'slide 2', 'slide', 2 FROM l WHERE k = 0 UNION ALL SELECT o_custkey, line_no, 0, st || ' / 段 ' || o_orderkey, NULL, NULL FROM l WHERE k = 1),
n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY line_no, pos) AS n FROM a)"""


@query(f"WITH {MARKS} SELECT CAST(o_custkey AS VARCHAR) AS doc_id, 'anchor_' || lpad(CAST(n AS VARCHAR), 4, '0') AS anchor_id, CAST(line_no AS INTEGER) AS line_no, mark AS source_anchor FROM n")
def anchor_map(spark, sf):
    return evidence.anchor_map(marked_texts(spark, sf)).select("doc_id", "anchor_id", "line_no", "source_anchor")


@query(f"""WITH {MARKS}, f AS (SELECT o_custkey, kind, idx, min(n) AS n FROM n WHERE kind IS NOT NULL GROUP BY 1, 2, 3), k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n) AS k FROM f)
SELECT CAST(o_custkey AS VARCHAR) AS doc_id, CAST(k AS INTEGER) AS k, kind, idx AS index FROM k WHERE k <= 3""")
def anchor_samples(spark, sf):
    return evidence.page_samples(evidence.anchor_map(marked_texts(spark, sf))).select("doc_id", "k", "kind", "index")


@query(f"""WITH {MARKS}, f AS (SELECT o_custkey, mark, min(n) AS n FROM n WHERE kind IS NULL GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n) AS k FROM f)
SELECT CAST(k.o_custkey AS VARCHAR) AS doc_id, CAST(k AS INTEGER) AS k, k.mark AS source_anchor, 'o' || o.o_orderkey AS block_id, o.o_orderpriority AS snippet FROM k LEFT JOIN orders o ON o.o_custkey = k.o_custkey AND o.o_orderkey % 2 = 0 AND k.mark = o.o_orderstatus || ' / 段 ' || o.o_orderkey WHERE k <= 3""")
def evidence_join(spark, sf):
    o = V.read(spark, sf, "orders").where("o_orderkey % 2 = 0")
    at = V.source_anchor(kind=F.lit("text_anchor"), heading_path=F.array("o_orderstatus"), block_index=F.col("o_orderkey"), keys=F.array(F.lit("block_index")))
    b = V.blocks(o, doc_id=F.col("o_custkey").cast("string"), ord=F.col("o_orderkey"), id=F.concat(F.lit("o"), F.col("o_orderkey")), type=F.lit("para"), source_anchor=at, content=V.payload("content", text=F.col("o_orderpriority")))
    return evidence.evidence(evidence.text_samples(evidence.anchor_map(marked_texts(spark, sf))), b).select("doc_id", "k", "source_anchor", "block_id", F.when(F.col("block_id").isNotNull(), F.col("snippet")).alias("snippet"))
