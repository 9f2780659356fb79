"""A training-data pipeline over ``documents``: each stage is written as Parquet and read by the next.

Quality rules and toxicity drop the documents that they reject, near-duplicates keep one document of each group,
suffix-array dedup cuts repeated strings from later documents (a document with no word left goes), and packing
deals what is left into sequences.

Rows, not ids, are judged: a stage hands each row through its operator, and the near-duplicate stage, which must name
rows, numbers them in a stored copy.  Tables that a stage stores are deleted when the next one begins, since its
result has been written by then.

Defined cases, in every stage: a null text is empty; rows without an id or with a repeated one are judged each by its own
text; repeated rows are all kept or all dropped but by the near-duplicate stage, which keeps one; an empty table gives an
empty result; columns beyond those of ``documents`` are left out.
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blockloom.llm import queries
from blockloom.llm.minhash import near_duplicates
from blockloom.llm.packing import packing, with_token_counts
from blockloom.llm.quality import quality
from blockloom.llm.sentencepieces import model_bytes
from blockloom.llm.storage import discard_paths, held, release, shared_dir, stored, temporary
from blockloom.llm.suffix_dedup import suffix_dedup
from blockloom.llm.toxicity import toxicity

_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Tables that the last stage stored and nothing reads once its result is written.
_LEFT: set[str] = set()


def _stage(f):
    @functools.wraps(f)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard_paths(spark, _LEFT)
        release(spark)
        before = held()
        out = f(spark, docs.select(*_COLUMNS), sf_dir)
        _LEFT.clear()
        _LEFT.update(held() - before)
        return out

    return run


def _documents(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Carried columns, with the types they had."""
    return rows.select(*[F.col(c).cast(docs.schema[c].dataType) for c in _COLUMNS])


@_stage
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=_COLUMNS[1:])
    return _documents(judged.where("kept"), docs)


@_stage
def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scored = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carry=_COLUMNS[1:])
    return _documents(scored.where("predicted = 0"), docs)


@_stage
def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, similarity 0.8; of a group the row with the least id stays."""
    rows = stored(docs.withColumn("row_key", F.monotonically_increasing_id()), "pipeline-rows")
    found = near_duplicates(rows, size=5, percent=80, id_col="row_key").select(F.col("doc_id").alias("row_key"), "component_id")
    named = found.join(rows.select("row_key", "doc_id"), "row_key")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key")).alias("first"))
    return rows.join(first.select("first.row_key"), "row_key", "left_semi").select(*_COLUMNS)


@_stage
def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    left = suffix_dedup(docs, text=True, carry=("lang", "source")).withColumnRenamed("kept", "text")
    left = left.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return _documents(left.withColumn("n_chars", F.length("text")), docs)


@_stage
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    counted = with_token_counts(docs, model_bytes(queries.TOKENIZER))
    return packing(counted, counted["n_tokens"])


STAGES = [
    ("quality rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near-duplicates", near_duplicate_stage),
    ("suffix-array dedup", substring_stage),
    ("best-fit packing", packing_stage),
]

#: SQL cannot express these stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, last = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        path = temporary(spark, f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if last:
            discard_paths(spark, {last})
        last = path
    discard_paths(spark, _LEFT)
    return docs
