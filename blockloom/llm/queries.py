"""The queries of this subpackage: each applies one operator with production parameters to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_scores import lm_scores

    return lm_scores(_read(spark, sf_dir, "documents"))


#: The model of op2 and op10; a parameter, never copied here.
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sentencepieces import encode, model_bytes

    return encode(_read(spark, sf_dir, "documents"), model_bytes(TOKENIZER))


def op3_hilbert_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hilbert_search import nearest

    return nearest(_read(spark, sf_dir, "embeddings"))


def op4_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"), size=2, percent=80)


def op5_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .archives import convert

    rows = convert(_read(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "url")


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import suffix_dedup

    return suffix_dedup(_read(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import substring_dedup

    return substring_dedup(_read(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    return quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import packing, with_token_counts
    from .sentencepieces import model_bytes

    counted = with_token_counts(_read(spark, sf_dir, "documents"), model_bytes(TOKENIZER))
    return packing(counted, counted["n_tokens"])


QUERIES = {f.__name__: f for f in (op1_stupid_backoff, op2_sentencepiece, op3_hilbert_neighbours, op4_minhash_forest, op5_arc_to_warc, op6_suffix_array_dedup, op7_substring_dedup, op8_quality_rules, op9_toxicity, op10_best_fit_packing)}
#: DuckDB SQL for the queries that SQL can express on whole tables.
ORACLE_SQL: dict[str, str] = {}
