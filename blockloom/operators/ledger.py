"""The issue ledger: scoped merge of generated findings, what is unresolved, and its text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def merge(existing: DataFrame, generated: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Merge ``generated`` into ``existing``, both with the ledger's columns, by document, tool and id.

    Rows of tools that generated nothing for a document stay.  Own rows that are not generated again become fixed and
    lose an acceptance; those generated again take the new text, keep creation time and acceptance, and reopen if they
    were fixed.  A document with parse errors (``errors (doc_id)``) keeps its ledger as it is.
    """
    key = ["doc_id", "found_by", "id"]
    fields = [c for c in existing.columns if c not in key]
    if errors is not None:
        generated = generated.join(errors.select("doc_id").distinct(), "doc_id", "left_anti")
    tools = generated.select("doc_id", "found_by").distinct().withColumn("_ran", F.lit(True))
    old = existing.select(*key, F.struct(*fields).alias("o"))
    new = generated.select(*key, F.struct(*fields).alias("n"))
    rows = old.join(new, key, "full").join(tools, ["doc_id", "found_by"], "left")
    gone = F.col("n").isNull() & F.coalesce("_ran", F.lit(False))
    both = F.col("n").isNotNull() & F.col("o").isNotNull()
    accepted = both & (F.col("o.status") == "accepted")
    base = F.when(F.col("n").isNotNull(), F.col("n")).otherwise(F.col("o"))
    out = {f: base[f] for f in fields}
    for f, fixed in (("status", "fixed"), ("accepted_by", ""), ("accepted_reason", "")):
        out[f] = F.when(gone, fixed).when(accepted, F.col(f"o.{f}")).otherwise(base[f])
    out["created_at"] = F.when(both, F.coalesce(F.nullif("o.created_at", F.lit("")), F.col("n.created_at"))).otherwise(base["created_at"])
    return rows.select(*key, *[out[f].alias(f) for f in fields]).select(*existing.columns)


def unresolved(issues: DataFrame) -> DataFrame:
    return issues.where(~F.col("status").eqNullSafe("fixed"))


def summary(issues: DataFrame) -> DataFrame:
    sev, st = F.col("severity"), F.col("status")
    undocumented = (sev == "blocker") & (st == "accepted") & ((F.coalesce("accepted_by", F.lit("")) == "") | (F.coalesce("accepted_reason", F.lit("")) == ""))
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return issues.groupBy("doc_id").agg(n((sev == "blocker") & (st == "open")).alias("open_blockers"), n((sev == "major") & (st == "open")).alias("open_majors"), n(undocumented).alias("undocumented_acceptances"), n(~st.eqNullSafe("fixed")).alias("unresolved"))


_LINES = ("severity", "status", "accepted_by", "accepted_reason", "source_block_id", "source_anchor", "category", "issue", "required_action")


def render_unresolved(issues: DataFrame, order: str = "pos") -> DataFrame:
    """The text of the unresolved issues of each document, in the order of column ``order``."""
    item = F.concat(F.lit("## "), F.coalesce("id", F.lit("<missing-id>")), F.lit("\n\n"), F.concat_ws("\n", *[F.concat(F.lit(f"- {c}: "), F.coalesce(c, F.lit(""))) for c in _LINES]))
    rows = issues.withColumn("_open", ~F.col("status").eqNullSafe("fixed")).withColumn("_text", F.when(F.col("_open"), item))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("_open"), F.struct(F.col(order).alias("o"), F.col("_text").alias("t"))))), lambda x: x["t"]), "\n\n")
    return rows.groupBy("doc_id").agg(F.concat(F.lit("# Unresolved\n\n"), F.when(text == "", "_No unresolved issues._").otherwise(F.regexp_replace(text, r"\s+\z", "")), F.lit("\n")).alias("text"))


def duplicate_ids(issues: DataFrame) -> DataFrame:
    n = F.count(F.lit(1)).over(W.partitionBy("doc_id", "id"))
    return issues.withColumn("n", n).where("n > 1")
