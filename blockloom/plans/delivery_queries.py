"""Queries over imports, phases, assembled files and manifests made of suppliers, parts, events and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, delivery, jobs, project, snapshot
from ..schema import PHASES
from . import vehicles as V
from .block_queries import FIGS, PART_FILES, figure_blocks
from .gate_queries import STATUS, event_checks

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def suppliers(spark, sf):
    return V.read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("doc_id"), F.col("s_suppkey").alias("k"))


@query("""WITH s AS (SELECT s_suppkey AS k, s_suppkey % 5 AS m FROM supplier), c AS (SELECT k, 'extract_meta_present' AS id, 'error' AS level, m <> 0 AS ok FROM s UNION ALL SELECT k, 'extract_meta_parseable', 'error', FALSE FROM s WHERE m = 1
UNION ALL SELECT k, 'meta.source_format', 'error', TRUE FROM s WHERE m > 1 UNION ALL SELECT k, 'meta.image_count', 'error', m <> 2 FROM s WHERE m > 1 UNION ALL SELECT k, 'meta.structured_stats', 'error', TRUE FROM s WHERE m > 1
UNION ALL SELECT k, 'skeleton_present', 'error', k % 3 <> 0 FROM s WHERE m > 1 UNION ALL SELECT k, 'image_count_consistent', 'warn', k % 2 = 1 FROM s WHERE m > 1 UNION ALL SELECT k, 'profile_confirmed', 'info', TRUE FROM s WHERE m > 2 AND k % 3 <> 0)
SELECT CAST(k AS VARCHAR) AS doc_id, '1_extraction' AS phase, id, level, ok FROM c""")
def extraction_gate(spark, sf):
    s = suppliers(spark, sf)
    whole = F.concat(F.lit('{"source_format": "pdf", "structured_stats": {}, "mapped_image_count": '), (F.col("k") % 2).cast("string"), F.when(F.col("k") % 5 == 2, "").otherwise(', "image_count": 1'), F.lit("}"))
    meta = s.where("k % 5 <> 0").select("doc_id", F.when(F.col("k") % 5 == 1, '{"source_format": ').otherwise(whole).alias("text"))
    paths = lambda rows, p: rows.select("doc_id", F.lit(p).alias("path"))
    return checks.extraction_gate(s, meta, paths(s.where("k % 3 <> 0"), "a_skeleton.md"), paths(s, "extracted/images/a.png")).select("doc_id", "phase", "id", "level", "ok")


@query("""WITH p AS (SELECT p_partkey AS k, p_partkey % 4 AS t, p_partkey % 3 = 0 AS img, CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 5 = 1 THEN 'medium' ELSE 'low' END AS prior FROM part), r AS (SELECT *, CASE WHEN t < 2 THEN 'high' WHEN t = 2 OR img OR coalesce(prior, 'medium') = 'medium' THEN 'medium' ELSE 'low' END AS risk FROM p)
SELECT CAST(k AS VARCHAR) AS doc_id, img AS has_images, t = 0 AS has_tables, t = 1 AS has_formulas, CASE WHEN t = 2 THEN 2 END AS pages, risk, risk <> coalesce(prior, 'medium') AS raised FROM r""")
def profile_confirmed(spark, sf):
    t, k = F.col("p_partkey") % 4, F.col("p_partkey")
    page = "<!-- meta:page_start page=1 -->\n"
    p = V.read(spark, sf, "part").select(
        k.cast("string").alias("doc_id"), F.when(t == 0, "| a |\n| --- |").when(t == 1, "so $x$ is").when(t == 2, page + page).otherwise(F.col("p_name")).alias("text"), F.when(k % 5 == 0, None).when(k % 5 == 1, "medium").otherwise("low").alias("prior_risk"),
        (k % 3 == 0).cast("int").alias("n_images"), *[F.lit(0).alias(c) for c in ("n_formulas", "n_charts", "n_smartart", "n_rendered")], F.lit(None).cast("int").alias("page_count"),
    )
    return jobs.confirmed_profile(p).select("doc_id", "has_images", "has_tables", "has_formulas", "pages", "risk", "raised")


@query(f"""WITH {STATUS}, u AS (SELECT user_id, count(*) AS n, bool_or(r = 2) AS f, bool_or(r = 1) AS w FROM s GROUP BY 1), a AS (SELECT *, CASE WHEN user_id % 11 = 0 THEN 0 ELSE user_id % 8 END AS ph, user_id % 8 AS cur FROM u),
g AS (SELECT *, n = 3 AND NOT f AND user_id % 7 <> 0 AND ph = cur AS go FROM a), n AS (SELECT ['0_intake', '1_extraction', '2_ir_build', '3_semantic_compile', '4_audit', '5_assembly', '6_validation', '7_package'] AS a)
SELECT CAST(user_id AS VARCHAR) AS doc_id, n.a[ph + 1] AS phase, CASE WHEN NOT go THEN 1 WHEN w THEN 2 ELSE 0 END AS exit_code, go AS snapshot, n.a[cur + CASE WHEN go AND cur < 7 THEN 2 ELSE 1 END] AS next_phase FROM g, n""")
def phase_run(spark, sf):
    g = checks.gate_status(event_checks(spark, sf))
    users = g.select("doc_id", F.col("phase").alias("current_phase")).distinct()
    k = F.col("doc_id").cast("long")
    rows = users.withColumn("phase", F.when(k % 11 == 0, PHASES[0]))
    return jobs.run_phase(rows, {p: ("g0", "g1", "g2") for p in PHASES}, g, users.where(k % 7 == 0))


SNAPS = """p AS (SELECT source, doc_id, doc_id % 5 AS k FROM documents), f AS (SELECT source, '4_audit' AS phase, 'inputs' AS kind, doc_id FROM p WHERE k < 2 UNION ALL SELECT source, '4_audit', 'outputs', doc_id FROM p WHERE k < 2
UNION ALL SELECT source, '6_validation', 'inputs', doc_id FROM p WHERE k IN (1, 3, 4))"""


def job_files(spark, sf):
    d = V.read(spark, sf, "documents")
    k, n = F.col("doc_id") % 5, F.col("doc_id").cast("string")
    path = F.when(k == 0, F.concat(F.lit("ir/a/"), n)).when(k == 1, "review/issues.jsonl").when(k == 2, F.concat(F.lit("source/x/"), n)).when(k == 3, F.concat(F.lit("output/parts/"), n, F.lit(".md"))).otherwise(F.concat(F.lit("logs/gates/gate_4_audit_"), n, F.lit(".json")))
    return d.select(F.col("source").alias("doc_id"), path.alias("path"), n.alias("sha256"), F.lit(1).alias("bytes"))


@query(f"WITH {SNAPS} SELECT source AS doc_id, phase, kind, count(*) AS n, sum(doc_id) AS ids FROM f GROUP BY 1, 2, 3")
def phase_snapshots(spark, sf):
    files = job_files(spark, sf)
    both = snapshot.phase_snapshot(files, "4_audit").unionByName(snapshot.phase_snapshot(files, "6_validation"))
    return both.groupBy("doc_id", "phase", "kind").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("sha256").cast("long")).cast("long").alias("ids"))


@query(f"""WITH {SNAPS}, q AS (SELECT f.source, CASE f.doc_id % 5 WHEN 1 THEN 'review/issues.jsonl' WHEN 3 THEN 'output/parts/' || f.doc_id || '.md' ELSE 'logs/gates/gate_4_audit_' || f.doc_id || '.json' END AS path, f.doc_id FROM f WHERE phase = '6_validation')
SELECT source AS doc_id, '6_validation' AS phase, sha256(string_agg(path || chr(0) || '1' || chr(0) || doc_id || chr(10), '' ORDER BY path, CAST(doc_id AS VARCHAR))) AS digest FROM q GROUP BY 1""")
def manifest_input_hashes(spark, sf):
    s = snapshot.phase_snapshot(job_files(spark, sf), "6_validation")
    return snapshot.input_hashes(s).select("doc_id", F.explode("input_hashes").alias("phase", "digest"))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS doc_id, 'review/cleaning_decisions.json' AS path, 3 AS length FROM supplier UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'review/vision_cache.json', 0 FROM supplier WHERE s_suppkey % 2 <> 0""")
def slot_seeds(spark, sf):
    s = suppliers(spark, sf)
    there = s.where("k % 2 = 0").select("doc_id", F.lit("review/vision_cache.json").alias("path")).unionByName(s.select("doc_id", F.lit("ir/summary.seed.md").alias("path")))
    return delivery.seed_slots(s, there).select("doc_id", "path", F.length("text").alias("length"))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS doc_id, '# Imported Quality Report (backend extraction)' || chr(10) || chr(10) || '- extractor_version: None' || chr(10) || '- source_format: pdf' || chr(10) || '- image_count (meta): ' || s_suppkey || chr(10) || '- mapped images: ' || s_suppkey || '  | mapped page renders: 0' || chr(10) || '- placeholder_count: None' || chr(10) || '- duplicate_images: 2' || chr(10) || '- structured_stats: {}' || chr(10) || chr(10) || '## extractor console' || chr(10) || chr(10) || '```' || chr(10) || s_name || chr(10) || '```' || chr(10) AS text FROM supplier""")
def import_reports(spark, sf):
    s = V.read(spark, sf, "supplier")
    none = F.lit(None).cast("string")
    meta = s.select(F.col("s_suppkey").cast("string").alias("doc_id"), none.alias("extractor_version"), F.lit("pdf").alias("source_format"), F.col("s_suppkey").alias("image_count"), F.col("s_suppkey").alias("n_images"), F.lit(0).alias("n_pages"), none.alias("placeholder_count"), F.lit(2).alias("n_duplicates"), none.alias("stats"), F.concat(F.lit("\n"), "s_name", F.lit(" \n")).alias("console"))
    return delivery.import_report(meta).select("doc_id", "text")


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN '' WHEN 1 THEN p_name ELSE '' END AS summary FROM part""")
def summary_seeds(spark, sf):
    k = F.col("p_partkey") % 3
    return V.read(spark, sf, "part").select("p_partkey", delivery.summary(F.when(k == 0, "\n<!-- later -->").when(k == 1, F.concat(F.lit(" "), "p_name", F.lit("\n\n")))).alias("summary"))


@query(f"""WITH {FIGS} SELECT d AS doc_id, 'assets/' || p_name || '.png' AS path, count(*) AS n FROM f WHERE k = 0 AND p_name LIKE 'red%' GROUP BY 1, 2""")
def copied_assets(spark, sf):
    b = figure_blocks(spark, sf)
    there = b.where("type = 'figure'").select("doc_id", F.col("figure.asset_file").alias("path")).where("path like 'extracted/images/red%'").distinct()
    return delivery.copied_assets(b, there).groupBy("doc_id", "path").agg(F.count(F.lit(1)).alias("n"))


def about(spark, sf, blocks):
    """Documents whose brand has a number above 10 have more than 100 pages and are split; even ones have a summary."""
    n = F.regexp_extract("doc_id", r"\d+", 0).cast("int")
    return blocks.select("doc_id").distinct().select("doc_id", F.concat(F.lit("On "), "doc_id").alias("title"), F.lit("a.pdf").alias("source_file"), F.lit("pdf").alias("source_type"), F.lit("low").alias("risk"), (n * 10).alias("pages"), F.when(n % 2 == 0, " said ").otherwise("<!-- -->").alias("seed"))


def nothing(spark):
    return spark.createDataFrame([], "doc_id string, path string")


LIMITS = {"max_blocks": 1 << 40, "max_markdown_bytes": 1 << 40, "max_pages": 100, "max_sheets": 3}
MAIN = f"""{PART_FILES}, o AS (SELECT *, row_number() OVER (PARTITION BY p_brand, s ORDER BY p_partkey) - 1 AS ks FROM h),
w AS (SELECT p_brand, count(*) AS n, CAST(regexp_extract(p_brand, '\\d+') AS INTEGER) AS b, '## 目录' || chr(10) || chr(10) || string_agg(repeat('  ', CAST(lv - 1 AS INTEGER)) || '- [' || p_name || '](#' || s || CASE WHEN ks = 0 THEN '' ELSE '-' || ks END || ')', chr(10) ORDER BY p_partkey) AS toc,
string_agg('<a id="' || s || CASE WHEN ks = 0 THEN '' ELSE '-' || ks END || '"></a>' || chr(10) || repeat('#', CAST(lv AS INTEGER)) || ' ' || p_name || '　〔源 p.' || p_size || '〕', chr(10) || chr(10) ORDER BY p_partkey) AS body FROM o GROUP BY 1),
pl AS (SELECT p_brand, string_agg('- [' || title || '](' || path || ') - ' || range || ', ' || blocks || ' blocks', chr(10) ORDER BY section) AS list, count(*) AS n_parts, min_by(path, section) AS first_part FROM parts GROUP BY 1),
mn AS (SELECT w.*, n_parts, first_part, b > 10 AS split, '---' || chr(10) || 'schema: blockloom-md/0.1' || chr(10) || 'generated_by: blockloom' || chr(10) || 'title: "On ' || p_brand || '"' || chr(10) || 'source_file: "a.pdf"' || chr(10) || 'document_type: "pdf"' || chr(10) || 'risk_level: "low"' || chr(10) || 'counts:' || chr(10) || '  blocks: ' || n || chr(10) || '  tables: 0' || chr(10) || '  figures: 0' || chr(10) || '  formulas: 0' || chr(10) || 'split: ' || CASE WHEN b > 10 THEN 'true' ELSE 'false' END || chr(10) || '---' || chr(10) || chr(10)
|| CASE WHEN b > 10 THEN '# On ' || p_brand || chr(10) || chr(10) ELSE '' END || CASE WHEN b % 2 = 0 THEN '> **摘要**' || chr(10) || '> said' || chr(10) || chr(10) ELSE '' END || CASE WHEN b > 10 THEN '## 分卷目录' || chr(10) || chr(10) || list ELSE toc || chr(10) || chr(10) || '---' || chr(10) || chr(10) || body END || chr(10) AS main FROM w JOIN pl USING (p_brand))"""


@query(f"WITH {MAIN} SELECT p_brand AS doc_id, main AS text FROM mn")
def main_files(spark, sf):
    b = V.part_headings(spark, sf)
    return delivery.output_files(about(spark, sf, b), b, nothing(spark), LIMITS).where("role = 'main'").select("doc_id", "text")


@query(f"""WITH {MAIN} SELECT p_brand AS doc_id, CASE WHEN split THEN 'split_index' ELSE 'single_file' END AS mode, greatest(1, strlen(main) // 4) AS tokens, CASE WHEN split THEN n_parts ELSE 0 END AS parts, CASE WHEN split THEN first_part END AS first_part, n AS blocks, CASE WHEN b % 2 = 0 THEN 'said' ELSE '' END AS summary FROM mn""")
def index_files(spark, sf):
    b = V.part_headings(spark, sf)
    f = delivery.output_files(about(spark, sf, b), b, nothing(spark), LIMITS).where("path = 'index.json'")
    j = lambda p: F.get_json_object("text", p)
    return f.select("doc_id", j("$.entry.mode").alias("mode"), j("$.entry.approx_tokens").cast("long").alias("tokens"), j("$.stats.part_count").cast("long").alias("parts"), j("$.parts[0].path").alias("first_part"), j("$.stats.content.blocks").cast("long").alias("blocks"), j("$.summary").alias("summary"))


@query("""SELECT p_brand AS doc_id, '{"blocks":{' || string_agg('"h' || p_partkey || '":{"kind":"pdf_page","source_file":"' || p_type || '","page":' || p_size || '}', ',' ORDER BY 'h' || p_partkey) || '}}' AS text FROM part GROUP BY 1""")
def provenance_files(spark, sf):
    return delivery.provenance_files(V.part_headings(spark, sf)).select("doc_id", "text")


@query(f"WITH {MAIN} SELECT p_brand AS doc_id, 'draft' AS stage, 'main.md' AS main, 'index.json' AS index_json, split AS split_enabled, CASE WHEN split THEN n_parts ELSE 0 END AS parts, CASE WHEN split THEN first_part END AS first_part FROM mn")
def manifest_refreshed(spark, sf):
    b = V.part_headings(spark, sf)
    d = about(spark, sf, b)
    old = d.select("doc_id", F.lit("draft").alias("stage"), F.lit("old.md").alias("main"))
    new = delivery.refreshed_manifest(old, delivery.assembled(d, b, nothing(spark), LIMITS))
    return new.select("doc_id", "stage", "main", F.col("index.json").alias("index_json"), "split_enabled", F.size("split_parts").cast("long").alias("parts"), F.get("split_parts", F.lit(0)).alias("first_part"))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS doc_id, 'final' AS stage, 'main.md' AS main, 'unresolved.md' AS unresolved, 'assets/' || s_suppkey || '.png=' || s_name || CASE WHEN s_suppkey % 2 = 0 THEN ',main.md=m' ELSE '' END AS output_hashes FROM supplier""")
def manifest_finalised(spark, sf):
    s = V.read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("doc_id"), F.col("s_suppkey").alias("k"), "s_name")
    file = lambda rows, path, sha: rows.select("doc_id", path.alias("path"), sha.alias("sha256"))
    hashes = file(s, F.concat(F.lit("assets/"), "doc_id", F.lit(".png")), F.col("s_name")).unionByName(file(s.where("k % 2 = 0"), F.lit("main.md"), F.lit("m"))).unionByName(file(s, F.lit("manifest.json"), F.lit("x")))
    done = delivery.finalised_manifest(s.select("doc_id", F.lit("draft").alias("stage")), hashes, F.lit("2025-01-01T00:00:00Z"))
    pairs = F.transform(F.map_entries("output_hashes"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return done.select("doc_id", "stage", "main", "unresolved", F.array_join(pairs, ",").alias("output_hashes"))


@query("""SELECT p_partkey, '<pre>' || replace(p_name, ' ', ' &lt;a&gt; &amp; &quot;&#x27;') || '</pre>' AS html, FALSE AS renderer_ok FROM part""")
def html_previews(spark, sf):
    p = V.read(spark, sf, "part").select(F.col("p_partkey").alias("doc_id"), F.lit("main.md").alias("path"), F.replace("p_name", F.lit(" "), F.lit(" <a> & \"'")).alias("text"))
    return delivery.previews(p).select(F.col("doc_id").alias("p_partkey"), "html", "renderer_ok")


@query("""SELECT p_brand AS doc_id, 'h' || p_partkey AS id, CASE WHEN p_partkey % 3 = 0 THEN 'odd' END AS type FROM part WHERE p_partkey % 3 = 0 OR p_partkey % 5 = 0""")
def unknown_types(spark, sf):
    k = F.substring("id", 2, 20).cast("long")
    return project.unknown_types(V.part_headings(spark, sf).withColumn("type", F.when(k % 3 == 0, "odd").when(k % 5 == 0, None).otherwise(F.col("type"))))
