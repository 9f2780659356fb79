"""Audits of blocks to findings: tables, formulas, assets, provenance.

A finding is a generated issue: its id is made of the kind, the block and the code, so a second run finds the same
ids.  Each audit is one pass: an array of possible findings for a block, filtered and exploded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..schema import ANCHOR_KEYS, ISSUES
from .project import anchor_text

# Words of column names by role and by kind of table, in order of precedence.
ROLES = {
    "register": {"address": ("address", "addr", "地址"), "name": ("register", "reg", "寄存器", "name", "名称"), "description": ("description", "desc", "说明", "描述"), "reset": ("reset", "default", "复位", "默认")},
    "parameter": {"parameter": ("parameter", "参数", "characteristic", "特性"), "unit": ("unit", "单位"), "limit": ("min", "typ", "max", "最小", "典型", "最大")},
    "quote": {"item": ("item", "part", "物料", "项目", "名称"), "quantity": ("qty", "quantity", "数量"), "unit_price": ("unitprice", "price", "单价"), "amount": ("amount", "total", "金额", "小计")},
}
TRIGGERS = {"parameter": ("parameter", "electrical", "参数", "特性"), "quote": ("quote", "price", "报价", "单价", "金额")}
ADDRESS = r"(?i)^(0x[0-9a-f]+|[0-9a-f]{2,}h|[0-9]+)\z"
BASIS = "图上估读"
LOW_CONFIDENCE = 0.8
FINDINGS = ("doc_id", "id", "severity", "category", "source_block_id", "source_anchor", "code", "found_by")


def _any(hay: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [hay.contains(w) for w in words])


def column_role(columns: Column, words) -> Column:
    """0-based index of the first column whose squeezed name has one of the words; null if none."""
    at = F.array_position(F.transform(columns, lambda c: _any(T.squeeze(c), words)), True)
    return F.when(at > 0, (at - 1).cast("int"))


def table_kind(title: Column, columns: Column) -> Column:
    hay = T.squeeze(F.concat_ws(" ", title, columns))
    has = lambda role: column_role(columns, ROLES["register"][role]).isNotNull()
    register = has("address") & (has("name") | has("description") | has("reset"))
    return F.when(register, "register").when(_any(hay, TRIGGERS["parameter"]), "parameter").when(_any(hay, TRIGGERS["quote"]), "quote").otherwise("generic")


def missing_roles(kind: Column, columns: Column) -> Column:
    out = F.array().cast("array<string>")
    for k, roles in ROLES.items():
        lack = F.filter(F.array(*[F.when(column_role(columns, w).isNull(), r) for r, w in roles.items()]), lambda x: x.isNotNull())
        out = F.when(kind == k, lack).otherwise(out)
    return out


def row_width(row: Column) -> Column:
    """Sum of column spans, a missing one counts 1; -1 for a row with a malformed cell."""
    return F.when(F.exists(row, lambda c: c.isNull()), -1).otherwise(F.aggregate(row, F.lit(0), lambda a, c: a + F.coalesce(c["colspan"], F.lit(1))))


def _findings(rows: DataFrame, category: str, found_by: str, cases: list[tuple[str, str, Column]], prefix: str) -> DataFrame:
    made = F.array(*[F.when(cond, F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"))) for code, severity, cond in cases])
    hit = rows.select("doc_id", "ord", F.coalesce("id", F.lit("missing")).alias("source_block_id"), anchor_text(F.col("source_anchor")).alias("source_anchor"), F.explode(F.filter(made, lambda x: x.isNotNull())).alias("f"))
    found = hit.select("doc_id", F.concat_ws("_", F.lit(prefix), "source_block_id", "f.code").alias("id"), "f.severity", F.lit(category).alias("category"), "source_block_id", "source_anchor", "f.code", F.lit(found_by).alias("found_by"))
    return as_issues(found)


def as_issues(found: DataFrame) -> DataFrame:
    """Findings as open entries of the ledger: all columns of ISSUES, then the code."""
    blank = {"status": "open", "accepted_by": "", "accepted_reason": "", "issue": "", "required_action": "", "created_at": ""}
    rows = found.withColumns({k: F.lit(v) for k, v in blank.items() if k not in found.columns})
    return rows.select(*[x.split()[0] for x in ISSUES.split(", ")], "code")


def classified_tables(blocks: DataFrame) -> DataFrame:
    """Tables with kind, missing roles, and the 1-based numbers of rows of a wrong width or with a bad address."""
    cols = F.coalesce("table.columns", F.array().cast("array<string>"))
    rows = blocks.where("type = 'table'").withColumn("kind", table_kind(F.coalesce("title", F.lit("")), cols)).withColumn("lack", missing_roles(F.col("kind"), cols))
    data = F.coalesce("table.rows", F.array().cast("array<array<struct<text:string,rowspan:int,colspan:int>>>"))
    numbered = F.transform(data, lambda r, i: F.struct((i + 1).alias("i"), r.alias("r")))
    wide = F.transform(F.filter(numbered, lambda x: x["r"].isNull() | (row_width(x["r"]) != F.size(cols))), lambda x: x["i"])
    at = column_role(cols, ROLES["register"]["address"])
    cell = lambda x: T.strip(F.coalesce(F.get(x["r"], at)["text"], F.lit("")))
    address = F.transform(F.filter(numbered, lambda x: x["r"].isNotNull() & (cell(x) != "") & ~cell(x).rlike(ADDRESS)), lambda x: x["i"])
    return rows.withColumns({"bad_rows": wide, "bad_addresses": F.when(F.col("kind") == "register", address).otherwise(F.array().cast("array<int>"))})


def audit_tables(blocks: DataFrame) -> DataFrame:
    n = lambda c: F.size(c) > 0
    cases = [("missing_required_columns", "major", (F.col("kind") != "generic") & n("lack")), ("row_width_mismatch", "major", n("bad_rows")), ("register_address_format", "major", n("bad_addresses"))]
    return _findings(classified_tables(blocks), "table", "audit_tables", cases, "table")


def audit_formulas(blocks: DataFrame) -> DataFrame:
    latex = T.strip(F.coalesce("formula.latex", F.lit("")))
    review = (F.coalesce("formula.visual_check", F.lit("")) == "needs_review") | F.coalesce("needs_review", F.lit(False))
    cases = [("empty_latex", "major", latex == ""), ("unbalanced_latex", "major", (latex != "") & ~T.latex_balanced(latex)), ("needs_visual_proof", "minor", review), ("low_confidence", "minor", F.coalesce("confidence", F.lit(0.0)) < LOW_CONFIDENCE)]
    return _findings(blocks.where("type = 'formula'"), "formula", "audit_formulas", cases, "formula")


def audit_assets(blocks: DataFrame, files: DataFrame) -> DataFrame:
    there = files.select("doc_id", F.col("path").alias("_path"), F.lit(True).alias("_there")).distinct()
    rows = blocks.where("type = 'figure'").withColumn("_path", F.col("figure.asset_file")).join(there, ["doc_id", "_path"], "left")
    noise = F.coalesce("figure.likely_noise", F.lit(False))
    blank = lambda c: T.strip(F.coalesce(c, F.lit(""))) == ""
    guess = F.exists(F.coalesce("figure.estimated_values", F.array().cast("array<struct<label:string,value:string,basis:string>>")), lambda v: ~v["basis"].eqNullSafe(BASIS))
    cases = [("asset_missing", "major", F.col("_there").isNull()), ("caption_missing", "minor", blank("figure.caption") & ~noise), ("description_missing", "major", blank("figure.description") & ~noise), ("estimated_value_basis_missing", "major", guess & ~noise)]
    return _findings(rows, "figure", "audit_assets", cases, "figure")


def anchor_values_complete(a: Column) -> Column:
    """Every required field of the kind has a value; an unknown kind is incomplete."""
    ok = F.lit(False)
    for kind, keys in ANCHOR_KEYS.items():
        ok = ok | ((a["kind"] == kind) & reduce(lambda x, y: x & y, [a[k].isNotNull() for k in keys]))
    return F.coalesce(ok, F.lit(False))


def anchor_keys_present(a: Column) -> Column:
    """Every required field of the kind is there, with or without a value."""
    ok = F.lit(False)
    for kind, keys in ANCHOR_KEYS.items():
        ok = ok | ((a["kind"] == kind) & reduce(lambda x, y: x & y, [F.array_contains(a["keys"], k) for k in keys]))
    return F.coalesce(ok, F.lit(False))


def audit_provenance(blocks: DataFrame, comments: DataFrame | None = None, errors: DataFrame | None = None) -> DataFrame:
    """Incomplete anchors of tables, figures and formulas; comments without text or anchor; unreadable comment files.

    ``comments (doc_id, origin, text, source_anchor)``, ``errors (doc_id, error)``."""
    high = blocks.where(F.col("type").isin("table", "figure", "formula"))
    out = _findings(high, "provenance", "audit_provenance", [("anchor_incomplete", "major", ~anchor_values_complete(F.col("source_anchor")))], "provenance")
    if comments is not None:
        rows = comments.withColumn("id", T.issue_slug(F.col("origin"))).withColumn("ord", F.lit(0))
        cases = [("text_missing", "major", T.strip(F.coalesce("text", F.lit(""))) == ""), ("anchor_missing", "major", ~anchor_values_complete(F.col("source_anchor")))]
        found = _findings(rows, "provenance", "audit_provenance", cases, "provenance_comment").withColumn("source_block_id", F.lit(""))
        out = out.unionByName(found)
    if errors is not None:
        rows = errors.select("doc_id", F.concat(F.lit("provenance_comments_"), T.issue_slug(F.col("error")), F.lit("_parse_error")).alias("id"))
        out = out.unionByName(as_issues(rows.select("doc_id", "id", F.lit("major").alias("severity"), F.lit("provenance").alias("category"), F.lit("").alias("source_block_id"), F.lit("").alias("source_anchor"), F.lit("parse_error").alias("code"), F.lit("audit_provenance").alias("found_by"))))
    return out


def run_audits(blocks: DataFrame, files: DataFrame, comments: DataFrame | None = None, errors: DataFrame | None = None) -> DataFrame:
    parts = [audit_tables(blocks), audit_formulas(blocks), audit_assets(blocks, files), audit_provenance(blocks, comments, errors)]
    return reduce(DataFrame.unionByName, parts)


def audit_summary(findings: DataFrame) -> DataFrame:
    """Findings by tool, and its exit code: 2 if there are any, else 0."""
    return findings.groupBy("doc_id", "found_by").agg(F.count(F.lit(1)).alias("n_findings"), F.count_if(F.col("severity") == "major").alias("n_major"), F.lit(2).alias("exit_code"))
