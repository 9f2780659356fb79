"""Queries over ledgers, gates and jobs made of labels, events and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks, evidence, jobs, ledger, quality, snapshot
from ..schema import ISSUES, PHASES
from . import vehicles as V
from .block_queries import audited_tables, figure_blocks

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def ledger_rows(rows, **fields):
    names = [x.split()[0] for x in ISSUES.split(", ")]
    return rows.select(*[fields.get(n, F.lit("")).cast("string").alias(n) for n in names])


def ledgers(spark, sf):
    """Existing issues from documents, generated ones from labels; the source is the document."""
    d = V.read(spark, sf, "documents")
    k = F.col("doc_id")
    old = ledger_rows(d, doc_id=F.col("source"), id=F.concat(F.lit("i"), k), severity=F.when(k % 4 == 0, "blocker").otherwise("major"), status=F.when(k % 3 == 0, "accepted").when(k % 3 == 1, "open").otherwise("fixed"), accepted_by=F.when(k % 3 == 0, F.when(k % 2 == 0, "me").otherwise("")).otherwise(""), accepted_reason=F.when(k % 3 == 0, "why").otherwise(""), category=F.lit("table"), issue=F.lit("old"), found_by=F.when(k % 5 == 0, "other").otherwise("tool"), created_at=F.when(k % 7 == 0, "").otherwise("2024-01-01T00:00:00Z"))
    lab = V.read(spark, sf, "labels").where("quality = 0 or toxic = 1").join(d.select("doc_id", "source"), "doc_id")
    new = ledger_rows(lab, doc_id=F.col("source"), id=F.concat(F.lit("i"), F.col("doc_id")), severity=F.lit("minor"), status=F.lit("open"), category=F.lit("table"), issue=F.lit("new"), found_by=F.lit("tool"), created_at=F.lit("2025-01-01T00:00:00Z"))
    return old, new


LEDGER = """o AS (SELECT source, 'i' || doc_id AS id, doc_id AS k, CASE WHEN doc_id % 4 = 0 THEN 'blocker' ELSE 'major' END AS severity, CASE doc_id % 3 WHEN 0 THEN 'accepted' WHEN 1 THEN 'open' ELSE 'fixed' END AS status,
 CASE WHEN doc_id % 6 = 0 THEN 'me' ELSE '' END AS accepted_by, CASE WHEN doc_id % 3 = 0 THEN 'why' ELSE '' END AS accepted_reason, CASE WHEN doc_id % 5 = 0 THEN 'other' ELSE 'tool' END AS found_by, CASE WHEN doc_id % 7 = 0 THEN '' ELSE '2024-01-01T00:00:00Z' END AS created_at FROM documents),
n AS (SELECT d.source, 'i' || d.doc_id AS id FROM labels l JOIN documents d USING (doc_id) WHERE l.quality = 0 OR l.toxic = 1), r AS (SELECT DISTINCT source FROM n)"""


@query(f"""WITH {LEDGER} SELECT o.source AS doc_id, o.found_by, o.id, o.status, o.accepted_by, 'old' AS issue, o.created_at FROM o WHERE o.found_by = 'other' OR o.source NOT IN (SELECT source FROM r)
UNION ALL SELECT o.source, o.found_by, o.id, 'fixed', '', 'old', o.created_at FROM o WHERE o.found_by = 'tool' AND o.source IN (SELECT source FROM r) AND NOT EXISTS (SELECT 1 FROM n WHERE n.source = o.source AND n.id = o.id)
UNION ALL SELECT n.source, 'tool', n.id, CASE WHEN o.status = 'accepted' THEN 'accepted' ELSE 'open' END, CASE WHEN o.status = 'accepted' THEN o.accepted_by ELSE '' END, 'new', coalesce(nullif(o.created_at, ''), '2025-01-01T00:00:00Z') FROM n LEFT JOIN o ON o.source = n.source AND o.id = n.id AND o.found_by = 'tool'""")
def ledger_merge(spark, sf):
    return ledger.merge(*ledgers(spark, sf)).select("doc_id", "found_by", "id", "status", "accepted_by", "issue", "created_at")


@query(f"""WITH {LEDGER} SELECT source AS doc_id, count(*) FILTER (severity = 'blocker' AND status = 'open') AS open_blockers, count(*) FILTER (severity = 'major' AND status = 'open') AS open_majors,
count(*) FILTER (severity = 'blocker' AND status = 'accepted' AND (accepted_by = '' OR accepted_reason = '')) AS undocumented_acceptances, count(*) FILTER (status <> 'fixed') AS unresolved FROM o GROUP BY 1""")
def ledger_summary(spark, sf):
    return ledger.summary(ledgers(spark, sf)[0])


@query(f"""WITH {LEDGER}, t AS (SELECT source, k, '## ' || id || chr(10) || chr(10) || '- severity: ' || severity || chr(10) || '- status: ' || status || chr(10) || '- accepted_by: ' || accepted_by || chr(10) || '- accepted_reason: ' || accepted_reason || chr(10) || '- source_block_id: ' || chr(10) || '- source_anchor: ' || chr(10) || '- category: table' || chr(10) || '- issue: old' || chr(10) || '- required_action: x' AS t FROM o WHERE status <> 'fixed')
SELECT source AS doc_id, '# Unresolved' || chr(10) || chr(10) || string_agg(t, chr(10) || chr(10) ORDER BY k) || chr(10) AS text FROM t GROUP BY 1""")
def render_unresolved(spark, sf):
    old = ledgers(spark, sf)[0].withColumn("required_action", F.lit("x")).withColumn("pos", F.substring("id", 2, 20).cast("long"))
    return ledger.render_unresolved(old)


def event_checks(spark, sf):
    e = V.read(spark, sf, "events")
    kind = F.col("event_type")
    return e.select(F.col("user_id").cast("string").alias("doc_id"), F.concat(F.lit("g"), F.col("event_id") % 3).alias("gate"), F.get(F.array(*map(F.lit, PHASES)), (F.col("user_id") % 8).cast("int")).alias("phase"), F.concat(F.lit("c"), F.col("event_id")).alias("id"), (~((kind.isin("error", "view", "click")) & (F.col("value") > 40))).alias("ok"), F.when(kind == "error", "error").when(kind == "view", "warn").otherwise("info").alias("level"))


STATUS = """s AS (SELECT user_id, event_id % 3 AS g, max(CASE WHEN event_type IN ('error', 'view', 'click') AND value > 40 THEN CASE event_type WHEN 'error' THEN 2 WHEN 'view' THEN 1 ELSE 0 END ELSE -1 END) AS r, count(*) AS n FROM events GROUP BY 1, 2)"""


@query(f"WITH {STATUS} SELECT CAST(user_id AS VARCHAR) AS doc_id, 'g' || g AS gate, CASE r WHEN 2 THEN 1 WHEN 1 THEN 2 ELSE 0 END AS exit_code, CASE r WHEN 2 THEN 'fail' WHEN 1 THEN 'pass_with_notes' ELSE 'pass' END AS status FROM s")
def gate_status(spark, sf):
    return checks.gate_status(event_checks(spark, sf)).select("doc_id", "gate", "exit_code", "status")


@query(f"""WITH {STATUS}, p AS (SELECT user_id, bool_or(r = 2) AS failed FROM s GROUP BY 1), n AS (SELECT ['0_intake', '1_extraction', '2_ir_build', '3_semantic_compile', '4_audit', '5_assembly', '6_validation', '7_package'] AS a)
SELECT CAST(user_id AS VARCHAR) AS doc_id, NOT failed AND user_id % 8 < 7 AS advanced, a[user_id % 8 + CASE WHEN NOT failed AND user_id % 8 < 7 THEN 2 ELSE 1 END] AS next_phase FROM p, n""")
def phase_advance(spark, sf):
    g = checks.gate_status(event_checks(spark, sf))
    return jobs.advance(g.select("doc_id", F.col("phase").alias("current_phase")).distinct(), g).select("doc_id", "advanced", "next_phase")


@query(f"WITH {STATUS} SELECT CAST(user_id AS VARCHAR) AS doc_id, CASE max(r) WHEN 2 THEN 'fail' WHEN 1 THEN 'pass_with_notes' ELSE 'pass' END AS status FROM s GROUP BY 1")
def overall_status(spark, sf):
    return evidence.overall_status(checks.gate_status(event_checks(spark, sf)).select("doc_id", "status"))


@query(f"""WITH {STATUS}, {LEDGER}, g AS (SELECT CAST(user_id % 20 AS VARCHAR) AS s, count(*) AS n_gates, count(*) FILTER (r = 2) AS n_failed FROM s GROUP BY 1), i AS (SELECT replace(source, 'src', '') AS s, count(*) FILTER (severity = 'blocker' AND status = 'open') AS blockers, count(*) FILTER (severity = 'major' AND status = 'open') AS majors FROM o WHERE status = 'open' GROUP BY 1)
SELECT coalesce(g.s, i.s) AS doc_id, coalesce(n_gates, 0) AS n_gates, coalesce(n_failed, 0) AS n_failed, coalesce(blockers, 0) AS blockers, coalesce(majors, 0) AS majors FROM g FULL JOIN i ON g.s = i.s""")
def qa_report(spark, sf):
    g = checks.gate_status(event_checks(spark, sf)).withColumn("doc_id", (F.col("doc_id").cast("long") % 20).cast("string")).withColumn("phase", F.lit("1_extraction"))
    i = ledgers(spark, sf)[0].withColumn("doc_id", F.replace("doc_id", F.lit("src"), F.lit("")))
    return evidence.qa_report(g, i).select("doc_id", "n_gates", "n_failed", "blockers", "majors")


# ---- gates over block tables: the offenders are made in both engines ------------------------------------------------


def _rows(gate_df):
    return gate_df.where("not ok").select("doc_id", "id", "level", F.regexp_extract("message", r"^(\d+)", 1).cast("long").alias("n"))


CONV = "c AS (SELECT conv_id, turn, role, count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)"


@query(f"""WITH {CONV} SELECT CAST(conv_id AS VARCHAR) AS doc_id, 'no_orphan_blocks' AS id, 'warn' AS level, count(*) AS n FROM c WHERE turn % 4 = 3 GROUP BY 1
UNION ALL SELECT CAST(conv_id AS VARCHAR), 'block_order_exist', 'error', 1 FROM c WHERE conv_id % 5 = 0 GROUP BY 1
UNION ALL SELECT CAST(conv_id AS VARCHAR), 'no_duplicate_ids', 'error', 1 FROM c WHERE turn = 1 AND conv_id % 3 = 0 GROUP BY 1
UNION ALL SELECT CAST(conv_id AS VARCHAR), 'required_fields', 'error', count(*) FROM c WHERE role = 'system' GROUP BY 1
UNION ALL SELECT CAST(conv_id AS VARCHAR), 'stats_block_count', 'warn', 1 FROM c WHERE conv_id % 2 = 0 GROUP BY 1""")
def ir_gate(spark, sf):
    b = V.turn_blocks(spark, sf)
    twice = b.where("ord = 1 and cast(doc_id as long) % 3 = 0")
    order = b.where("ord % 4 <> 3").select("doc_id", "id").unionByName(b.where("cast(doc_id as long) % 5 = 0").select("doc_id", F.lit("gone").alias("id")).distinct())
    stats = b.unionByName(twice).groupBy("doc_id").agg((F.count(F.lit(1)) + F.when(F.first("doc_id").cast("long") % 2 == 0, 1).otherwise(0)).alias("block_count"))
    rows = b.unionByName(twice).withColumn("confidence", F.when(F.coalesce("source_zone", F.lit("")) != "header", F.col("confidence")))
    return _rows(checks.ir_gate(b.select("doc_id"), rows, order, stats))


@query(f"""WITH {CONV} SELECT CAST(conv_id AS VARCHAR) AS doc_id, 'anchor_source_declared' AS id, 'warn' AS level, count(*) AS n FROM c WHERE role = 'user' GROUP BY 1
UNION ALL SELECT CAST(conv_id AS VARCHAR), 'anchor_keys_complete', 'error', count(*) FROM c WHERE turn % 3 = 2 GROUP BY 1
UNION ALL SELECT CAST(conv_id AS VARCHAR), 'anchor_kind_known', 'error', count(*) FROM c WHERE role = 'system' GROUP BY 1""")
def provenance_gate(spark, sf):
    b = V.turn_blocks(spark, sf)
    a = F.col("source_anchor")
    a = F.when(F.col("ord") % 3 == 2, a.withField("keys", F.array(F.lit("kind")))).otherwise(a)
    rows = b.withColumn("source_anchor", a)
    rows = rows.withColumn("source_anchor", F.when(F.col("source_zone") == "header", F.col("source_anchor").withField("kind", F.lit("odd"))).otherwise(F.col("source_anchor")))
    sources = b.select("doc_id", F.explode(F.array(F.lit("assistant"), F.lit("system"))).alias("path")).distinct()
    return _rows(checks.provenance_gate(b.select("doc_id"), rows, sources))


@query("""SELECT p_brand AS doc_id, 'row_widths_match_columns' AS id, 'error' AS level, count(*) AS n FROM part WHERE p_partkey % 5 < 3 AND p_size % 2 <> 0 GROUP BY 1""")
def tables_gate(spark, sf):
    b = audited_tables(spark, sf)
    return _rows(checks.tables_gate(b.select("doc_id"), b))


@query("""WITH f AS (SELECT p_brand AS d, p_name, count(*) AS n FROM part WHERE p_size % 3 = 0 GROUP BY 1, 2)
SELECT d AS doc_id, 'asset_files_exist' AS id, 'error' AS level, count(*) AS n FROM f WHERE p_name NOT LIKE 'red%' GROUP BY 1
UNION ALL SELECT d, 'asset_names_conform', 'error', count(*) FROM f GROUP BY 1 UNION ALL SELECT p_brand, 'no_orphan_image_files', 'warn', 1 FROM part GROUP BY 1""")
def links_ir_gate(spark, sf):
    from ..operators import project

    b = figure_blocks(spark, sf)
    files = b.where("figure.asset_file like '%/red%'").select("doc_id", F.col("figure.asset_file").alias("path")).unionByName(b.select("doc_id", F.lit("x/stray.png").alias("path")).distinct())
    return _rows(checks.links_ir_gate(b.select("doc_id"), b, project.assets_index(b, files), files))


@query(f"""WITH {LEDGER} SELECT source AS doc_id, 'no_open_blockers' AS id, 'error' AS level, count(*) AS n FROM o WHERE severity = 'blocker' AND status = 'open' GROUP BY 1
UNION ALL SELECT source, 'accepted_blockers_documented', 'error', count(*) FROM o WHERE severity = 'blocker' AND status = 'accepted' AND accepted_by = '' GROUP BY 1
UNION ALL SELECT source, 'major_open_notes', 'warn', count(*) FROM o WHERE severity = 'major' AND status = 'open' GROUP BY 1
UNION ALL SELECT source, 'unresolved_ids_projected', 'error', count(*) FROM o WHERE status <> 'fixed' AND k % 10 = 0 GROUP BY 1
UNION ALL SELECT source, 'unresolved_projection_exact', 'error', 1 FROM o WHERE status <> 'fixed' AND k % 10 = 0 GROUP BY 1
UNION ALL SELECT source, 'unresolved_issue_text_projected', 'error', count(*) FILTER (status <> 'fixed') FROM o GROUP BY 1 HAVING bool_and(k % 10 = 0)
UNION ALL SELECT source, 'unresolved_present', 'error', 1 FROM o GROUP BY 1 HAVING bool_and(k % 10 = 0)""")
def unresolved_gate(spark, sf):
    old = ledgers(spark, sf)[0].withColumn("required_action", F.lit("x")).withColumn("pos", F.substring("id", 2, 20).cast("long"))
    text = ledger.render_unresolved(old.where("pos % 10 <> 0"))
    return _rows(checks.unresolved_gate(old.select("doc_id"), old, text))


def delivered_texts(spark, sf):
    """Documents as main files with a heading, an anchor, an image without description and two links."""
    d = V.read(spark, sf, "documents")
    k = F.col("doc_id") % 4
    extra = F.when(k == 0, "\n![](assets/a.png)\n").when(k == 1, "\n$$\nx\n$$\n").when(k == 2, "\n[a](missing.md) [b](#nowhere)\n").otherwise("\n[未解析: 图] [c](../index.md)\n")
    return d.select(F.col("doc_id").cast("string").alias("doc_id"), F.lit("main").alias("role"), F.lit("output/main.md").alias("path"), F.concat(F.lit("# T\n"), F.when(F.col("doc_id") % 3 == 0, "〔源 p.1〕").otherwise(""), F.lit("\n"), extra).alias("text"))


@query("""WITH d AS (SELECT doc_id, doc_id % 4 AS k, doc_id % 3 AS a FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'source_anchors_present' AS id, 'error' AS level, 1 AS n FROM d WHERE a <> 0 UNION ALL SELECT CAST(doc_id AS VARCHAR), 'summary_present', 'warn', 1 FROM d
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'image_alts_present', 'error', 1 FROM d WHERE k = 0 UNION ALL SELECT CAST(doc_id AS VARCHAR), 'image_descriptions_present', 'warn', 1 FROM d WHERE k = 0
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'formulas_have_source_anchor', 'error', 1 FROM d WHERE k = 1""")
def quality_gate(spark, sf):
    f = delivered_texts(spark, sf)
    return _rows(checks.quality_gate(f.select("doc_id"), f))


@query("""SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'local_links_resolve' AS id, 'error' AS level, 1 AS n FROM documents WHERE doc_id % 4 = 2 OR (doc_id % 4 = 3 AND doc_id % 7 <> 0) OR doc_id % 4 = 0
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'inpage_anchors_resolve', 'error', 1 FROM documents WHERE doc_id % 4 = 2""")
def links_markdown_gate(spark, sf):
    f = delivered_texts(spark, sf)
    paths = f.where("cast(doc_id as long) % 7 = 0").select("doc_id", F.lit("index.md").alias("path"))
    return _rows(checks.links_markdown_gate(f.select("doc_id"), f, paths))


@query("""SELECT CAST(doc_id AS VARCHAR) AS doc_id, 'unresolved_markers_present' AS id, 'warn' AS level, 1 AS n FROM documents WHERE doc_id % 4 = 3
UNION ALL SELECT CAST(doc_id AS VARCHAR), 'unresolved_markers_documented', 'error', 1 FROM documents WHERE doc_id % 4 = 3 AND doc_id % 5 <> 0""")
def placeholders_gate(spark, sf):
    f = delivered_texts(spark, sf)
    issues = ledger_rows(f.where("cast(doc_id as long) % 5 = 0"), doc_id=F.col("doc_id"), id=F.lit("x"), status=F.lit("open"), issue=F.lit("about 图 here"))
    return _rows(checks.placeholders_gate(f.select("doc_id"), f, issues))


@query("""SELECT CAST(user_id AS VARCHAR) AS doc_id, 'all_special_audits_ran' AS id, 'error' AS level, 4 - count(DISTINCT k) AS n FROM (SELECT user_id, event_id % 4 AS k FROM events WHERE event_type = 'view') GROUP BY 1 HAVING count(DISTINCT k) < 4
UNION ALL SELECT CAST(user_id AS VARCHAR), 'audit_tool_exits_ok', 'error', count(*) FROM events WHERE event_type = 'view' AND event_id % 10 = 1 GROUP BY 1""")
def audit_summary_gate(spark, sf):
    e = V.read(spark, sf, "events").where("event_type = 'view'")
    tools = F.array(*map(F.lit, ("audit_tables", "audit_formulas", "audit_assets", "audit_provenance")))
    s = e.select(F.col("user_id").cast("string").alias("doc_id"), F.get(tools, (F.col("event_id") % 4).cast("int")).alias("tool"), F.when(F.col("event_id") % 10 == 1, 1).otherwise(F.when(F.col("event_id") % 2 == 0, 2).otherwise(0)).alias("exit_code"))
    return _rows(checks.audit_summary_gate(s.select("doc_id"), s))


@query("""SELECT CAST(c_custkey AS VARCHAR) AS doc_id, CASE c_custkey % 6 WHEN 1 THEN 'no_skip_before' WHEN 2 THEN 'no_skip_after' WHEN 3 THEN 'current_phase_enum' WHEN 4 THEN 'confirmed_by_set' ELSE 'risk_history_present' END AS id, CASE WHEN c_custkey % 6 = 5 THEN 'warn' ELSE 'error' END AS level, 1 AS n
FROM customer WHERE c_custkey % 6 > 0""")
def state_gate(spark, sf):
    c = V.read(spark, sf, "customer")
    k = F.pmod("c_custkey", F.lit(6))
    j = jobs.phase_status(c.select(F.col("c_custkey").cast("string").alias("doc_id"), k.alias("k"), F.lit("4_audit").alias("current_phase")))
    m = F.col("phase_status")
    swap = lambda p, v: F.map_from_entries(F.transform(F.map_entries(m), lambda e: F.struct(e["key"], F.when(e["key"] == p, v).otherwise(e["value"]))))
    j = j.withColumn("phase_status", F.when(F.col("k") == 1, swap("0_intake", "pending")).when(F.col("k") == 2, swap("7_package", "done")).otherwise(m))
    j = j.select("doc_id", F.when(F.col("k") == 3, "9_none").otherwise(F.col("current_phase")).alias("current_phase"), "phase_status", F.when(F.col("k") == 4, "confirmed").otherwise("provisional").alias("profile_status"), F.lit("").alias("confirmed_by"), F.lit("low").alias("risk"), F.when(F.col("k") == 5, 0).otherwise(1).alias("n_risk_history"))
    return _rows(checks.state_gate(j))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS doc_id, CASE s_suppkey % 4 WHEN 1 THEN 'stage' WHEN 2 THEN 'sources_nonempty' ELSE 'source_sha256' END AS id, 'error' AS level, 1 AS n FROM supplier WHERE s_suppkey % 4 > 0
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'source_bytes', 'warn', 1 FROM supplier WHERE s_suppkey % 4 = 3""")
def manifest_draft_gate(spark, sf):
    s = V.read(spark, sf, "supplier")
    k = F.pmod("s_suppkey", F.lit(4))
    src = lambda sha, n: F.array(F.struct(F.lit("a").alias("path"), sha.alias("sha256"), F.lit(n).cast("long").alias("bytes")))
    m = s.select(F.col("s_suppkey").cast("string").alias("doc_id"), F.when(k == 1, "odd").otherwise("draft").alias("stage"), F.col("s_name").alias("slug"), F.when(k == 2, F.array().cast("array<struct<path:string,sha256:string,bytes:bigint>>")).when(k == 3, src(F.lit("xyz"), -1)).otherwise(src(F.sha2("s_name", 256), 3)).alias("sources"))
    return _rows(checks.manifest_gate(m, final=False))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS doc_id, CASE s_suppkey % 4 WHEN 1 THEN 'stage_is_final' WHEN 2 THEN 'outputs_exist' ELSE 'input_hashes_present' END AS id, 'error' AS level, 1 AS n FROM supplier WHERE s_suppkey % 4 > 0""")
def manifest_final_gate(spark, sf):
    s = V.read(spark, sf, "supplier")
    k = F.pmod("s_suppkey", F.lit(4))
    m = s.select(F.col("s_suppkey").cast("string").alias("doc_id"), F.when(k == 1, "draft").otherwise("final").alias("stage"), F.lit("main.md").alias("main"), F.array(F.lit("main.md"), F.lit("index.md")).alias("outputs"), F.when(k == 3, F.create_map().cast("map<string,string>")).otherwise(F.create_map(F.lit("a"), F.lit("b"))).alias("input_hashes"))
    paths = m.select("doc_id", F.explode("outputs").alias("path")).where("path = 'main.md' or cast(doc_id as long) % 4 <> 2")
    return _rows(checks.manifest_gate(m, True, paths))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS doc_id, 'output_present' AS id, 'error' AS level, 1 AS n FROM supplier WHERE s_suppkey % 3 = 0
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'manifest_output_files_present', 'error', 1 FROM supplier WHERE s_suppkey % 3 = 0
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'manifest_output_hashes_current', 'error', 1 FROM supplier WHERE s_suppkey % 3 = 1
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'no_local_path_leaks', 'error', 1 FROM supplier WHERE s_suppkey % 3 = 2""")
def package_gate(spark, sf):
    s = V.read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("doc_id"), F.pmod("s_suppkey", F.lit(3)).alias("k"))
    names = ("main.md", "index.md", "index.json", "provenance.json", "manifest.json", "unresolved.md")
    all_ = s.select("doc_id", "k", F.explode(F.array(*map(F.lit, names))).alias("path"))
    text = F.when((F.col("k") == 2) & (F.col("path") == "main.md"), "in /tmp/x").otherwise(F.col("path"))
    files = all_.withColumn("text", text)
    hashes = files.where("path <> 'manifest.json'").select("doc_id", "path", F.sha2(F.when((F.col("k") == 1) & (F.col("path") == "main.md"), "old").otherwise(F.col("text")), 256).alias("sha256"))
    there = files.where("not (k = 0 and path = 'index.md')")
    disk = there.select("doc_id", "path", F.sha2("text", 256).alias("sha256"))
    none = spark.createDataFrame([], ISSUES)
    return _rows(checks.package_gate(s, hashes, disk, none, snapshot.path_leaks(there)))


@query("""SELECT CAST(s_suppkey AS VARCHAR) AS doc_id, 'high_risk_visual_status_pass' AS id, 'error' AS level, 1 AS n FROM supplier WHERE s_suppkey % 3 = 0 AND s_suppkey % 2 = 0
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'visual_warnings', 'warn', 1 FROM supplier WHERE s_suppkey % 2 = 0
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'anchors_nonempty', 'error', 1 FROM supplier WHERE s_suppkey % 5 = 0
UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'visual_artifacts_exist', 'error', 1 FROM supplier WHERE s_suppkey % 7 = 0""")
def visual_gate(spark, sf):
    s = V.read(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("doc_id"), F.col("s_suppkey").alias("k"))
    j = s.select("doc_id", F.when(F.pmod("k", F.lit(3)) == 0, "high").otherwise("low").alias("risk"))
    d = s.select("doc_id", F.when(F.pmod("k", F.lit(2)) == 0, "pass_with_notes").otherwise("pass").alias("status"))
    shots = s.select("doc_id", F.lit("shot.png").alias("path"))
    return _rows(checks.visual_gate(j, d, s.where("k % 5 <> 0").select("doc_id"), shots, s.where("k % 7 <> 0").select("doc_id", F.lit("shot.png").alias("path")), spark.createDataFrame([], ISSUES)))


@query("""WITH f AS (SELECT source, doc_id FROM documents WHERE doc_id % 9 = 4) SELECT source AS doc_id, 'phase_inputs_fresh' AS id, 'error' AS level, count(*) AS n FROM f GROUP BY 1""")
def stale_gate(spark, sf):
    d = V.read(spark, sf, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").cast("string").alias("path"), F.col("doc_id").alias("k"), "text")
    old = snapshot.file_hashes(d, "text")
    new = snapshot.file_hashes(d.withColumn("text", F.when(F.col("k") % 9 == 4, F.concat("text", F.lit("!"))).otherwise(F.col("text"))), "text")
    return _rows(checks.stale_gate(d.select("doc_id"), snapshot.stale_diff(old, new)))


@query("""WITH f AS (SELECT p_brand AS d, 'b' || p_partkey AS id, p_partkey, CASE WHEN p_size % 3 = 0 THEN 'figure' ELSE 'para' END AS type FROM part)
SELECT d AS doc_id, id, type FROM f WHERE p_partkey % 2 <> 0""")
def low_confidence_untracked(spark, sf):
    b = figure_blocks(spark, sf)
    issues = ledger_rows(b.where("cast(substring(id, 2) as long) % 2 = 0"), doc_id=F.col("doc_id"), id=F.col("id"), status=F.lit("open"), source_block_id=F.col("id"))
    return quality.untracked(b, issues)


@query("""WITH d AS (SELECT doc_id, doc_id % 3 AS a, doc_id % 4 AS k FROM documents), c AS (SELECT doc_id, a, k, list_filter(['main_has_summary_block', CASE WHEN a <> 0 THEN 'main_has_source_anchors' END, CASE WHEN k = 3 THEN 'main_has_no_placeholders' END, CASE WHEN k IN (0, 2, 3) THEN 'markdown_links_resolve' END, 'main_has_meaningful_title'], lambda x: x IS NOT NULL) AS f FROM d)
SELECT CAST(doc_id AS VARCHAR) AS doc_id, round((19 - len(f)) / 19, 3) AS score, 'fail' AS status FROM c""")
def golden_score(spark, sf):
    f = delivered_texts(spark, sf)
    none = V.read(spark, sf, "region").where("1 = 0")
    blocks = V.blocks(none)
    return quality.golden(f.select("doc_id", "text"), blocks, spark.createDataFrame([], ISSUES), spark.createDataFrame([], "doc_id string, path string")).select("doc_id", "score", "status")


@query("""SELECT p_partkey, p_name || '-20240101' AS job_id, CASE p_partkey % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'medium' ELSE 'low' END AS risk FROM (SELECT p_partkey, replace(p_name, ' ', '-') AS p_name FROM part)""")
def job_intake(spark, sf):
    k = F.pmod("p_partkey", F.lit(4))
    suffix = F.when(k == 0, ".txt").when(k == 1, ".PDF").when(k == 2, ".odd").otherwise(".md")
    p = V.read(spark, sf, "part").select("p_partkey", F.concat(F.lit("in/"), F.col("p_name"), suffix).alias("path"))
    return jobs.intake(p.withColumn("doc_id", F.col("p_partkey")), "20240101").select(F.col("doc_id").alias("p_partkey"), "job_id", "risk")


@query("""SELECT source AS doc_id, 'i' || doc_id AS id, count(*) AS n FROM (SELECT source, doc_id FROM documents UNION ALL SELECT source, doc_id FROM documents WHERE doc_id % 10 = 0) GROUP BY 1, 2 HAVING count(*) > 1""")
def duplicate_issue_ids(spark, sf):
    d = V.read(spark, sf, "documents").select(F.col("source").alias("doc_id"), F.concat(F.lit("i"), "doc_id").alias("id"))
    # the fixture needs repeated ids: a tenth of all rows comes twice
    return ledger.duplicate_ids(d.unionByName(d.where("substring(id, 2) % 10 = 0"))).select("doc_id", "id", "n").distinct()


@query("""WITH a AS (SELECT source AS doc_id, 'output/' || doc_id AS path FROM documents WHERE doc_id % 3 = 0 UNION SELECT source, CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id % 2 = 0)
SELECT doc_id, count(DISTINCT replace(path, 'output/', '')) AS n FROM a GROUP BY 1""")
def delivered_paths(spark, sf):
    d = V.read(spark, sf, "documents").select(F.col("source").alias("doc_id"), F.col("doc_id").cast("string").alias("path"))
    a = d.where("path % 3 = 0").withColumn("path", F.concat(F.lit("output/"), "path"))
    return snapshot.delivered(a, d.where("path % 2 = 0"), d.where("path % 6 = 0")).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
