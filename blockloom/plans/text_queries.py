"""Queries over text: lines of documents, pages, hashes."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import bind, compile, jobs, parse, project, quality, snapshot
from . import vehicles as V

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def texts(spark, sf):
    return V.read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), "text")


LINES = """lines AS (SELECT doc_id, unnest(range(len(p))) AS ln, unnest(p) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)),
s AS (SELECT doc_id, ln, line, regexp_replace(line, '^[\\s]+|[\\s]+$', '', 'g') AS s FROM lines)"""


@query("""SELECT CAST(doc_id AS VARCHAR) AS doc_id, len(regexp_extract_all(text, '(?m)^# ')) AS h1, len(regexp_extract_all(text, '(?m)^#{1,6} ')) AS headings,
 len(regexp_extract_all(text, '〔源 ')) AS source_anchors, len(regexp_extract_all(text, '(?m)^\\|.*\\|$')) AS tables, len(regexp_extract_all(text, '!\\[')) AS image_refs,
 len(regexp_extract_all(text, '\\[VISION_PLACEHOLDER_[^\\]]*\\]|\\[TODO\\]|\\[未解析:[^\\]]+\\]|�')) AS placeholders,
 len(regexp_extract_all(text, '\\$\\$')) + len(regexp_extract_all(text, '\\\\\\(.+?\\\\\\)')) AS formula_markers FROM documents""")
def md_metrics(spark, sf):
    return quality.metrics(texts(spark, sf))


@query(f"""WITH {LINES}, n AS (SELECT doc_id, s FROM s WHERE s <> '' GROUP BY 1, 2 HAVING count(*) >= 3)
SELECT CAST(s.doc_id AS VARCHAR) AS doc_id, CAST(s.ln AS INTEGER) AS ord FROM s JOIN n USING (doc_id, s)""")
def noise_repeated_lines(spark, sf):
    return compile.flag_noise(V.line_blocks(spark, sf)).where("content.likely_noise").select("doc_id", "ord")


@query("""SELECT source, CAST(doc_id AS VARCHAR) AS id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source, sha256(text) ORDER BY doc_id) AS k FROM documents) WHERE k > 1""")
def duplicate_content(spark, sf):
    d = V.read(spark, sf, "documents")
    figs = V.blocks(d, doc_id=F.col("source"), ord=F.col("doc_id"), id=F.col("doc_id").cast("string"), type=F.lit("figure"), figure=V.payload("figure", asset_file=F.col("doc_id").cast("string")))
    hashes = d.select(F.col("source").alias("doc_id"), F.col("doc_id").cast("string").alias("path"), F.sha2("text", 256).alias("sha256"))
    return compile.mark_figure_noise(figs, hashes).where("figure.noise_reason = 'duplicate_asset'").select(F.col("doc_id").alias("source"), "id")


@query("""SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 OR c_custkey % 7 = 1 THEN 'decorative_or_document_artifact' END AS reason
FROM customer""")
def artefact_figures(spark, sf):
    c = V.read(spark, sf, "customer")
    k = F.pmod("c_custkey", F.lit(7))
    text = F.when(k == 0, F.concat("c_name", F.lit(" Company LOGO"))).otherwise(F.col("c_name"))
    figs = V.blocks(c, doc_id=F.col("c_nationkey").cast("string"), ord=F.col("c_custkey"), id=F.col("c_custkey").cast("string"), type=F.lit("figure"), figure=V.payload("figure", asset_file=F.col("c_name"), description=F.when(k == 1, "timestamp").otherwise(text)))
    none = spark.createDataFrame([], "doc_id string, path string, sha256 string")
    return compile.mark_figure_noise(figs, none).select(F.col("id").cast("long").alias("id"), F.col("figure.noise_reason").alias("reason"))


@query("""SELECT lang, sum(greatest(1, strlen(text) // 4)) AS tokens, count(*) AS n FROM documents GROUP BY lang""")
def token_estimate_by_lang(spark, sf):
    return V.read(spark, sf, "documents").groupBy("lang").agg(F.sum(T.estimate_tokens(F.col("text"))).alias("tokens"), F.count(F.lit(1)).alias("n"))


@query("""SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN regexp_matches(text, '[一-鿿]') THEN 'zh-CN' ELSE 'en' END AS language FROM (SELECT doc_id, text || CASE WHEN doc_id % 3 = 0 THEN '中' ELSE '' END AS text FROM documents)""")
def document_language(spark, sf):
    d = V.read(spark, sf, "documents").withColumn("text", F.concat("text", F.when(F.col("doc_id") % 3 == 0, "中").otherwise("")))
    return d.select(F.col("doc_id").cast("string").alias("doc_id"), project.language(F.col("text")).alias("language"))


SLUG = "coalesce(nullif(replace(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}_ -]', '', 'g'), ' ', '-'), ''), 'section')"
H1 = "regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)"


@query(f"SELECT page_id, {SLUG.format('trim(' + H1 + ')')} AS slug FROM pages")
def heading_slugs(spark, sf):
    return V.read(spark, sf, "pages").select("page_id", T.gfm_slug(F.regexp_extract("html", "(?s)<h1[^>]*>(.*?)</h1>", 1)).alias("slug"))


@query(f"""WITH b AS (SELECT p_brand, p_partkey, {SLUG.format('p_name')} AS s FROM part),
n AS (SELECT *, row_number() OVER (PARTITION BY p_brand, s ORDER BY p_partkey) - 1 AS k FROM b)
SELECT p_brand AS doc_id, CAST(p_partkey AS INTEGER) AS ord, CASE WHEN k = 0 THEN s ELSE s || '-' || k END AS slug FROM n""")
def heading_slug_dedup(spark, sf):
    from ..operators import render

    return render.heading_slugs(V.part_headings(spark, sf)).select("doc_id", "ord", "slug")


@query("""WITH s AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '\\s+', ' ', 'g'), '^[ #]+|[ #]+$', '', 'g')) AS t FROM pages)
SELECT CAST(page_id AS VARCHAR) AS doc_id, trim(t[:160]) AS title FROM s""")
def page_titles(spark, sf):
    docs = V.page_docs(spark, sf)
    return project.titles(parse.parse(docs), docs)


@query("""SELECT CAST(page_id AS VARCHAR) AS doc_id, len(x) AS n_items, array_to_string(list_transform(x, lambda i: regexp_replace(i, '<[^>]*>', '', 'g')), '|') AS items FROM (SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS x FROM pages) WHERE len(x) > 0""")
def page_list_items(spark, sf):
    b = parse.parse(V.page_docs(spark, sf)).where("type = 'list'")
    return b.select("doc_id", F.size("content.items").cast("long").alias("n_items"), F.array_join("content.items", "|").alias("items"))


@query(f"""WITH {LINES}, c AS (SELECT doc_id, ln, list_transform(string_split(regexp_replace(s, '^\\|+|\\|+$', '', 'g'), '|'), lambda x: trim(x)) AS x FROM s WHERE s LIKE '%|%')
SELECT CAST(doc_id AS VARCHAR) AS doc_id, ln, len(x) AS n_cells, array_to_string(x, chr(9)) AS cells FROM c""")
def pipe_table_rows(spark, sf):
    rows = quality.numbered_lines(texts(spark, sf)).where(F.col("s").contains("|"))
    cells = parse.split_row(F.col("s"))
    return rows.select("doc_id", F.col("ln").cast("long").alias("ln"), F.size(cells).cast("long").alias("n_cells"), F.array_join(cells, "\t").alias("cells"))


NOISE_SQL = """regexp_matches(c, '(?i)^(pdf|docx?|document|table of contents|目录)$') OR regexp_matches(c, '(?i)^(第\\s*)?\\d+\\s*(页|/)\\s*\\d*$') OR regexp_matches(c, '(?i)^page\\s+\\d+(\\s+of\\s+\\d+)?$')
 OR regexp_matches(c, '^\\d+(\\.\\d+)*\\s+.{2,80}\\s+\\.{0,}\\s*\\d{1,4}$') OR regexp_matches(c, '(?i)^[\\w.-]+\\.pdf$') OR regexp_matches(c, '(?i)^(confidential|copyright|www\\.)')"""


@query(f"""WITH {LINES}, k AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY ln) AS k FROM s WHERE s <> '' AND s <> '---'),
c AS (SELECT doc_id, s, trim(regexp_replace(regexp_replace(s, '〔源 [^〕]+〕', '', 'g'), '^[#>\\-* ]+', ''), '`*_ ') AS c FROM k WHERE k <= 40),
n AS (SELECT doc_id, count(*) AS sample_size, count(*) FILTER (WHERE ({NOISE_SQL}) AND NOT (s LIKE '![%' OR s LIKE '|%' OR s LIKE '$$%')) AS noisy_count FROM c GROUP BY 1)
SELECT CAST(d.doc_id AS VARCHAR) AS doc_id, coalesce(sample_size, 0) AS sample_size, coalesce(noisy_count, 0) AS noisy_count,
 coalesce(noisy_count, 0) < 3 OR noisy_count / sample_size < 0.18 AS ok FROM documents d LEFT JOIN n USING (doc_id)""")
def opening_noise(spark, sf):
    return quality.opening_noise(texts(spark, sf)).select("doc_id", "sample_size", "noisy_count", "ok")


INJECT = "text || CASE doc_id % 5 WHEN 0 THEN chr(10) || 'see /tmp/x and Desktop' WHEN 1 THEN chr(10) || 'C:\\\\data [TODO] 待补充' WHEN 2 THEN chr(7) || 'Ã© [VISION_PLACEHOLDER_a]' WHEN 3 THEN chr(10) || '[未解析: 图]' || chr(65533) ELSE '' END"


def injected(spark, sf):
    k = F.col("doc_id") % 5
    extra = F.when(k == 0, "\nsee /tmp/x and Desktop").when(k == 1, "\nC:\\\\data [TODO] 待补充").when(k == 2, "\u0007Ã© [VISION_PLACEHOLDER_a]").when(k == 3, "\n[未解析: 图]\ufffd").otherwise("")
    return V.read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.lit("output/main.md").alias("path"), F.lit("main").alias("role"), F.concat("text", extra).alias("text"))


@query(f"""WITH d AS (SELECT doc_id, string_split({INJECT}, chr(10)) AS p FROM documents), l AS (SELECT doc_id, unnest(range(len(p))) + 1 AS line_no, unnest(p) AS line FROM d),
m AS (SELECT doc_id, line_no, CASE WHEN contains(line, '/Users/') THEN '/Users/' WHEN contains(line, '/private/tmp/') THEN '/private/tmp/' WHEN contains(line, '/tmp/') THEN '/tmp/' WHEN contains(line, 'C:\\') THEN 'C:\\'
 WHEN contains(line, 'GoogleDrive') THEN 'GoogleDrive' WHEN contains(line, 'CloudStorage') THEN 'CloudStorage' WHEN contains(line, 'Downloads') THEN 'Downloads' WHEN contains(line, 'Desktop') THEN 'Desktop' END AS pattern FROM l)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(line_no AS INTEGER) AS line_no, pattern FROM m WHERE pattern IS NOT NULL QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY line_no) <= 20""")
def path_leaks(spark, sf):
    return snapshot.path_leaks(injected(spark, sf)).select("doc_id", "line_no", "pattern")


@query(f"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, regexp_matches(t, '\\[VISION_PLACEHOLDER_[^\\]]+\\]') AS vision, regexp_matches(t, '\\[(?:TODO|todo)\\]') AS todo, contains(t, '待补充') AS pending, regexp_matches(t, '\\[未解析:[^\\]]+\\]') AS unresolved,
 contains(t, chr(65533)) AS replacement FROM (SELECT doc_id, {INJECT} AS t FROM documents)""")
def placeholder_scan(spark, sf):
    from ..operators import checks as C

    t = F.col("text")
    return injected(spark, sf).select("doc_id", t.rlike(C.VISION_MARK).alias("vision"), t.rlike(C.TODO_MARK).alias("todo"), t.contains(C.PENDING).alias("pending"), t.rlike(C.UNRESOLVED_MARK).alias("unresolved"), t.contains("�").alias("replacement"))


@query(f"SELECT CAST(doc_id AS VARCHAR) AS doc_id, regexp_matches(t, 'Ã.|Â.|â€|ï¼|ä¸|å') AS mojibake, len(regexp_extract_all(t, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f-\\x{{9f}}]')) AS controls FROM (SELECT doc_id, {INJECT} AS t FROM documents)")
def mojibake_and_controls(spark, sf):
    return injected(spark, sf).select("doc_id", F.col("text").rlike(T.MOJIBAKE).alias("mojibake"), T.control_chars(F.col("text")).cast("long").alias("controls"))


OLD_NEW = """old AS (SELECT lang AS doc_id, CAST(doc_id AS VARCHAR) AS path, sha256(text) AS sha256, strlen(text) AS bytes FROM documents WHERE doc_id % 5 <> 0),
new AS (SELECT lang AS doc_id, CAST(doc_id AS VARCHAR) AS path, sha256(CASE WHEN doc_id % 7 = 0 THEN text || 'x' ELSE text END) AS sha256, strlen(CASE WHEN doc_id % 7 = 0 THEN text || 'x' ELSE text END) AS bytes FROM documents WHERE doc_id % 6 <> 0)"""


def snapshots(spark, sf):
    d = V.read(spark, sf, "documents").select(F.col("lang").alias("doc_id"), F.col("doc_id").alias("k"), "text")
    new = d.where("k % 6 <> 0").withColumn("text", F.when(F.col("k") % 7 == 0, F.concat("text", F.lit("x"))).otherwise(F.col("text")))
    make = lambda x: snapshot.file_hashes(x.withColumn("path", F.col("k").cast("string")), "text")
    return make(d.where("k % 5 <> 0")), make(new)


@query(f"""WITH {OLD_NEW} SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, coalesce(o.path, n.path) AS path, CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'removed' ELSE 'changed' END AS change
FROM old o FULL JOIN new n ON o.doc_id = n.doc_id AND o.path = n.path WHERE o.path IS NULL OR n.path IS NULL OR o.sha256 <> n.sha256 OR o.bytes <> n.bytes""")
def snapshot_stale_diff(spark, sf):
    return snapshot.stale_diff(*snapshots(spark, sf))


@query(f"""WITH {OLD_NEW} SELECT o.doc_id, o.path, CASE WHEN n.path IS NULL THEN 'missing' ELSE 'changed' END AS problem FROM old o LEFT JOIN new n ON o.doc_id = n.doc_id AND o.path = n.path WHERE n.path IS NULL OR n.sha256 <> o.sha256""")
def snapshot_verification(spark, sf):
    return snapshot.verify_snapshot(*snapshots(spark, sf))


DIGEST = "SELECT {0} AS doc_id, sha256(string_agg(path || chr(0) || bytes || chr(0) || sha256 || chr(10), '' ORDER BY path)) AS digest, count(*) AS n_files FROM {1} GROUP BY 1"


@query(f"WITH f AS (SELECT source, CAST(doc_id AS VARCHAR) AS path, sha256(text) AS sha256, strlen(text) AS bytes FROM documents) {DIGEST.format('source', 'f')}")
def snapshot_digest(spark, sf):
    d = V.read(spark, sf, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").cast("string").alias("path"), "text")
    return snapshot.digest(snapshot.file_hashes(d, "text"))


@query("""WITH f AS (SELECT source, doc_id % 20 AS g, sha256(text) AS a, sha256(CASE WHEN doc_id % 40 = 3 THEN text || 'x' ELSE text END) AS b FROM documents) SELECT DISTINCT CAST(g AS VARCHAR) AS doc_id FROM f WHERE a <> b""")
def documents_to_recompute(spark, sf):
    d = V.read(spark, sf, "documents").select((F.col("doc_id") % 20).cast("string").alias("doc_id"), F.col("doc_id").alias("k"), "text")
    make = lambda x: snapshot.digest(snapshot.file_hashes(x.withColumn("path", F.col("k").cast("string")), "text"))
    return snapshot.to_recompute(make(d), make(d.withColumn("text", F.when(F.col("k") % 40 == 3, F.concat("text", F.lit("x"))).otherwise(F.col("text")))))


@query(f"""WITH {LINES}, p AS (SELECT doc_id, len(regexp_extract_all(t, '\\|\\s*:?-{{3,}}')) AS tables, len(regexp_extract_all(t, '\\$[^$\\n]+\\$')) AS formulas FROM (SELECT doc_id, text || CASE WHEN doc_id % 4 = 0 THEN chr(10) || '| --- |' ELSE '' END AS t FROM documents))
SELECT CAST(doc_id AS VARCHAR) AS doc_id, tables, formulas, CASE WHEN tables > 0 OR formulas > 0 THEN 'high' WHEN doc_id % 3 = 0 THEN 'medium' ELSE 'low' END AS risk FROM p""")
def profile_risk(spark, sf):
    d = V.read(spark, sf, "documents")
    t = F.concat("text", F.when(F.col("doc_id") % 4 == 0, "\n| --- |").otherwise(""))
    rows = d.select(F.col("doc_id").cast("string").alias("doc_id"), t.alias("text"), F.when(F.col("doc_id") % 3 == 0, "medium").otherwise("low").alias("prior_risk"))
    return jobs.profile(rows).select("doc_id", F.col("tables").cast("long").alias("tables"), F.col("formulas").cast("long").alias("formulas"), "risk")


@query("""SELECT page_id, coalesce(nullif(trim(regexp_replace(lower(url), '[^a-z0-9_-]+', '-', 'g'), '-_'), ''), 'doc') AS job, trim(left(lower(array_to_string(regexp_extract_all(url, '[A-Za-z0-9]+'), '_')), 40), '_') AS ascii,
 coalesce(nullif(left(trim(regexp_replace(lower(url), '[^a-z0-9_]+', '_', 'g'), '_'), 48), ''), 'item') AS issue FROM pages""")
def slugs(spark, sf):
    u = F.col("url")
    return V.read(spark, sf, "pages").select("page_id", T.job_slug(u).alias("job"), T.ascii_slug(u).alias("ascii"), T.issue_slug(u).alias("issue"))


@query("""WITH n AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'fig_p001_' || page_id || '.png' WHEN 1 THEN 'Fig ' || page_id || '.png' WHEN 2 THEN repeat('a', 97) || '.png' ELSE 'x-.' END AS name FROM pages)
SELECT page_id, regexp_matches(name, '^[a-z0-9]([a-z0-9._-]*[a-z0-9])?\\.[a-z0-9]+$') AND length(regexp_replace(name, '\\.[^.]*$', '')) <= 96 AS valid, trim(regexp_replace(name || ':' || page_id, '[<>:"/\\\\|?*]', '_', 'g'), '. ') AS safe FROM n""")
def file_names(spark, sf):
    k = F.col("page_id") % 4
    name = F.when(k == 0, F.concat(F.lit("fig_p001_"), "page_id", F.lit(".png"))).when(k == 1, F.concat(F.lit("Fig "), "page_id", F.lit(".png"))).when(k == 2, "a" * 97 + ".png").otherwise("x-.")
    return V.read(spark, sf, "pages").select("page_id", bind.valid_asset_name(name).alias("valid"), snapshot.safe_component(F.concat(name, F.lit(":"), F.col("page_id").cast("string"))).alias("safe"))


@query("""WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS target FROM pages), u AS (SELECT DISTINCT 'x' || regexp_extract(url, '^https?://[^/]*(/[^?#]*)', 1) AS at FROM pages)
SELECT CAST(page_id AS VARCHAR) AS doc_id, target FROM l WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.at = 'x' || target) AND target <> '/'""")
def link_check(spark, sf):
    p = V.read(spark, sf, "pages")
    links = F.array_join(F.transform(F.regexp_extract_all("html", F.lit('href="([^"]*)"'), F.lit(1)), lambda x: F.concat(F.lit("[a](<"), x, F.lit(">)"))), "\n")
    files = p.select(F.col("page_id").cast("string").alias("doc_id"), F.lit("x.md").alias("path"), F.regexp_replace(links, "[<>]", "").alias("text"))
    paths = p.select(F.regexp_extract("url", r"^https?://[^/]*(/[^?#]*)", 1).alias("at")).distinct()
    local = quality.links(files).where("kind = 'local'")
    return local.join(paths, local["target"] == paths["at"], "left_anti").where("target <> '/'").select("doc_id", "target")


@query("""WITH b AS (SELECT doc_id, text AS t FROM documents), m AS (SELECT doc_id, len(regexp_extract_all(t, '(?m)^#{1,6} ')) AS h, len(regexp_extract_all(t, '(?m)^\\|.*\\|$')) AS tb, len(regexp_extract_all(t, '\\$\\$')) AS f FROM b),
n AS (SELECT doc_id, len(regexp_extract_all(t, '(?m)^#{1,6} ')) AS h, len(regexp_extract_all(t, '\\$\\$')) AS f FROM (SELECT doc_id, t || chr(10) || '# H' || chr(10) || '$$' AS t FROM b))
SELECT CAST(m.doc_id AS VARCHAR) AS doc_id, n.h - m.h AS d_headings, n.f - m.f AS d_formula_markers, FALSE AS ok FROM m JOIN n USING (doc_id)""")
def baseline_delta(spark, sf):
    t = texts(spark, sf)
    more = t.withColumn("text", F.concat("text", F.lit("\n# H\n$$")))
    return quality.baseline_delta(more, t).select("doc_id", "d_headings", "d_formula_markers", "ok")


@query("""WITH h AS (SELECT doc_id, string_split(text, chr(10))[1] AS h FROM documents), t AS (SELECT doc_id, trim(h, '''" ') AS t FROM (SELECT doc_id, trim(regexp_replace(CASE WHEN doc_id % 4 = 0 THEN 'Document' ELSE h END, '<[^>]+>', '', 'g')) AS h FROM h))
SELECT CAST(doc_id AS VARCHAR) AS doc_id, t AS first_h1, t <> '' AND length(regexp_replace(t, '[\\s_\\-.:：/\\\\]+', '', 'g')) > 1 AND lower(regexp_replace(t, '[\\s_\\-.:：/\\\\]+', '', 'g')) NOT IN ('pdf','doc','docx','document','file','md','markdown','ppt','pptx','txt','untitled','unknown','xlsx','文档','文件','未命名') AS ok FROM t""")
def title_report(spark, sf):
    head = F.when(F.col("doc_id") % 4 == 0, "Document").otherwise(F.get(F.split("text", "\n"), F.lit(0)))
    d = V.read(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("doc_id"), F.concat(F.lit("# "), head, F.lit("\nbody")).alias("text"))
    return quality.title_report(d).select("doc_id", "first_h1", "ok")


@query("""WITH e AS (SELECT user_id, ts, event_id, CASE WHEN event_type IN ('signup', 'purchase') THEN event_type END AS mark FROM events)
SELECT event_id, last_value(mark IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS context FROM e""")
def context_carry_forward(spark, sf):
    e = V.read(spark, sf, "events").withColumn("mark", F.when(F.col("event_type").isin("signup", "purchase"), F.col("event_type")))
    w = W.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(W.unboundedPreceding, 0)
    return e.select("event_id", F.last("mark", ignorenulls=True).over(w).alias("context"))
