"""Jobs: intake, profiles and risk, phases and their advance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schema import PHASES, RISKS

# Fixed value: risk at intake by file suffix; other suffixes are medium.
INTAKE_RISK = {".txt": "low", ".md": "low", ".docx": "medium", ".pdf": "medium", ".pptx": "medium", ".xlsx": "medium"}
# The files that are hashed before and after each phase, relative to the job.
PHASE_FILES = {
    "0_intake": (("source/**",), ("STATE.json", "output/manifest.json", "review/issues.jsonl", "review/unresolved.md")),
    "1_extraction": (("STATE.json", "source/**"), ("extracted/**", "review/imported_quality_report.md", "review/vision_cache.json", "review/cleaning_decisions.json", "ir/summary.seed.md")),
    "2_ir_build": (("extracted/**", "review/imported_quality_report.md"), ("ir/document.ir.json", "ir/blocks.jsonl", "ir/assets.index.json", "ir/provenance.json")),
    "3_semantic_compile": (("ir/**", "review/vision_cache.json", "review/cleaning_decisions.json"), ("ir/**", "review/semantic_compile.md")),
    "4_audit": (("ir/**", "review/issues.jsonl", "review/unresolved.md"), ("ir/**", "review/audit_summary.json", "review/issues.jsonl", "review/unresolved.md")),
    "5_assembly": (("ir/**", "review/unresolved.md"), ("output/main.md", "output/index.md", "output/index.json", "output/parts/**", "output/assets/**", "output/provenance.json", "output/manifest.json")),
    "6_validation": (
        ("output/main.md", "output/index.md", "output/index.json", "output/parts/**", "output/assets/**", "output/provenance.json", "review/visual_acceptance/**", "review/issues.jsonl", "review/unresolved.md",
         "logs/gates/gate_0_intake_*.json", "logs/gates/gate_1_extraction_*.json", "logs/gates/gate_2_ir_build_*.json", "logs/gates/gate_3_semantic_compile_*.json", "logs/gates/gate_4_audit_*.json", "logs/gates/gate_5_assembly_*.json"),
        ("output/qa_report.md", "output/visual_acceptance.md", "output/unresolved.md", "output/manifest.json"),
    ),
    "7_package": (("output/main.md", "output/index.md", "output/index.json", "output/parts/**", "output/assets/**", "output/provenance.json", "output/qa_report.md", "output/visual_acceptance.md", "output/unresolved.md"), ()),
}


def intake(sources: DataFrame, day: str) -> DataFrame:
    """``sources (doc_id, path)``: slug, job id, format and provisional risk."""
    slug = T.job_slug(T.stem(F.col("path")))
    ext = F.lower(F.regexp_extract(T.base_name(F.col("path")), r"(?<=.)(\.[^.]*)\z", 1))
    return sources.select("doc_id", slug.alias("slug"), F.concat(slug, F.lit("-" + day)).alias("job_id"), ext.alias("fmt"), intake_risk(ext).alias("risk"))


def intake_risk(ext: Column) -> Column:
    c = F.lit("medium")
    for k, v in INTAKE_RISK.items():
        c = F.when(F.lower(ext) == k, v).otherwise(c)
    return c


def risk_rank(c: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, RISKS)), c)


def profile(docs: DataFrame) -> DataFrame:
    """What a text holds and the risk that follows: ``docs (doc_id, text, prior_risk)``.  Risk is only ever raised."""
    t = F.col("text")
    n = lambda p: F.regexp_count(t, F.lit(p))
    rows = docs.select("doc_id", "prior_risk", n(r"<!--\s*IMAGE:").alias("images"), n(r"\|\s*:?-{3,}").alias("tables"), n(r"(?<!\\)\$[^$\n]+\$").alias("formulas"), n(r"<!--\s*meta:page_start\s+page=\d+\s*-->").alias("pages"))
    high, medium = (F.col("tables") > 0) | (F.col("formulas") > 0), (F.col("images") > 0) | (F.col("pages") > 1)
    rank = F.greatest(F.when(high, 3).when(medium, 2).otherwise(1), risk_rank(F.coalesce("prior_risk", F.lit("low"))))
    return rows.select("doc_id", "images", "tables", "formulas", "pages", F.element_at(F.array(*map(F.lit, RISKS)), rank.cast("int")).alias("risk"))


def confirmed_profile(docs: DataFrame) -> DataFrame:
    """What an extraction holds, from its counts and its skeleton: ``docs (doc_id, text, prior_risk, n_images, n_formulas,
    n_charts, n_smartart, n_rendered, page_count)``.  Risk is only ever raised; a raise has a line of history."""
    n, t = (lambda c: F.coalesce(F.col(c), F.lit(0))), F.coalesce("text", F.lit(""))
    marks = F.regexp_count(t, F.lit("meta:page_start"))
    pages = F.coalesce("page_count", F.nullif(marks, F.lit(0)), F.nullif(n("n_rendered"), F.lit(0)))
    seen = docs.select(
        "doc_id", "prior_risk", (n("n_images") > 0).alias("has_images"), t.rlike(r"\|\s*:?-{3,}").alias("has_tables"), ((n("n_formulas") > 0) | t.rlike(r"(?<!\\)\$\$?[^$\n]+\$\$?")).alias("has_formulas"),
        ((n("n_charts") != 0) | (n("n_smartart") != 0)).alias("_drawn"), (n("n_rendered") > 0).alias("is_scanned"), pages.cast("int").alias("pages"),
    )
    high = F.col("has_formulas") | F.col("has_tables") | F.col("is_scanned") | F.col("_drawn")
    found = F.when(high, 3).when(F.col("has_images") | (F.coalesce("pages", F.lit(0)) > 1), 2).otherwise(1)
    risk = F.element_at(F.array(*map(F.lit, RISKS)), F.greatest(found, risk_rank(F.coalesce("prior_risk", F.lit("medium"))).cast("int")))
    return seen.select("doc_id", "has_images", "has_tables", "has_formulas", "is_scanned", "pages", risk.alias("risk"), (risk != F.coalesce("prior_risk", F.lit("medium"))).alias("raised"), F.lit("confirmed").alias("profile_status"))


def advance(jobs: DataFrame, gates: DataFrame) -> DataFrame:
    """Jobs ``(doc_id, current_phase)`` with gate results ``(doc_id, phase, status)``: a job goes on if its phase has
    results, none of them fails, and it is not the last.  An unreadable result does not stop it."""
    names = F.array(*map(F.lit, PHASES))
    got = gates.groupBy("doc_id", F.col("phase").alias("current_phase")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "fail").alias("n_fail"))
    rows = jobs.join(got, ["doc_id", "current_phase"], "left")
    at = F.array_position(names, F.col("current_phase")).cast("int")
    go = (F.coalesce("n", F.lit(0)) > 0) & (F.coalesce("n_fail", F.lit(0)) == 0) & (at < len(PHASES))
    return rows.select("doc_id", "current_phase", go.alias("advanced"), F.when(go, F.get(names, at)).otherwise(F.col("current_phase")).alias("next_phase"))


def phase_status(jobs: DataFrame) -> DataFrame:
    """The status map that a current phase implies: earlier done, itself in progress, later pending."""
    names = F.array(*map(F.lit, PHASES))
    at = F.array_position(names, F.col("current_phase"))
    values = F.transform(names, lambda p, i: F.when(i + 1 < at, "done").when(i + 1 == at, "in_progress").otherwise("pending"))
    return jobs.withColumn("phase_status", F.map_from_arrays(names, values))


def run_phase(jobs: DataFrame, expected: dict[str, tuple[str, ...]], gates: DataFrame, stale: DataFrame, refresh: bool = False, go_on: bool = True) -> DataFrame:
    """One step of every job ``(doc_id, current_phase, phase)``, where ``phase`` null means the current one.

    ``expected``: gates of each phase; ``gates (doc_id, gate, phase, exit_code)``: results; ``stale (doc_id)``: jobs whose inputs
    changed since their snapshot.  Exit 2 is notes or an unknown phase, 1 a failure, 0 a pass.  Stale inputs stop a job unless
    ``refresh``; a gate that fails, has no result or another exit stops it before its snapshot is recorded; a job at another
    phase than the validated one is not advanced; the last phase stays."""
    names = F.array(*map(F.lit, PHASES))
    phase = F.coalesce("phase", "current_phase")
    rows = jobs.select("doc_id", "current_phase", phase.alias("phase")).join(stale.select("doc_id", F.lit(True).alias("_stale")).distinct(), "doc_id", "left")
    plan = F.create_map(*[x for k, v in expected.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])
    wanted = rows.select("doc_id", "phase", F.explode(F.try_element_at(plan, F.col("phase"))).alias("gate"))
    got = wanted.join(gates.select("doc_id", "gate", "phase", "exit_code"), ["doc_id", "phase", "gate"], "left")
    code = F.coalesce("exit_code", F.lit(-1))
    sums = got.groupBy("doc_id").agg(F.count_if(~code.isin(0, 2)).alias("_bad"), F.count_if(code == 2).alias("_notes"))
    rows = rows.join(sums, "doc_id", "left")
    known, at = F.array_contains(names, F.col("phase")), F.array_position(names, F.col("current_phase")).cast("int")
    stopped = F.coalesce("_stale", F.lit(False)) & F.lit(not refresh)
    fails = F.col("_bad").isNull() | (F.col("_bad") > 0)
    notes = F.when((F.col("_notes") > 0), 2).otherwise(0)
    elsewhere = F.col("phase") != F.col("current_phase")
    recorded = known & ~stopped & ~fails
    moved = recorded & F.lit(go_on) & ~elsewhere & (at < len(PHASES))
    exit_code = F.when(~F.coalesce(known, F.lit(False)), 2).when(stopped | fails, 1).when(F.lit(not go_on), notes).when(elsewhere, 1).otherwise(notes)
    return rows.select("doc_id", "phase", exit_code.alias("exit_code"), F.coalesce(recorded, F.lit(False)).alias("snapshot"), F.when(F.coalesce(moved, F.lit(False)), F.get(names, at)).otherwise(F.col("current_phase")).alias("next_phase"))
