"""Tables of the driver as block tables: documents as lines, pages, conversations and parts as blocks.

The fields that a vehicle does not fill are null, with the types of the block table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string

from ..functions import text as T
from ..schema import BLOCKS, PAYLOADS


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def payload(kind: str, **fields):
    schema = _parse_datatype_string(PAYLOADS[kind])
    return F.struct(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def source_anchor(**fields):
    schema = _parse_datatype_string(BLOCKS)["source_anchor"].dataType
    return F.struct(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def blocks(rows: DataFrame, **fields) -> DataFrame:
    """Block table from ``rows``; ``fields`` give columns by name."""
    schema = _parse_datatype_string(BLOCKS)
    return rows.select(*[fields.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of a document is a paragraph."""
    docs = read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("d"), F.posexplode(T.lines(F.col("text"))).alias("ln", "line"))
    return blocks(docs, doc_id=F.col("d"), ord=F.col("ln"), id=F.concat(F.lit("p"), F.col("ln")), type=F.lit("para"), confidence=F.lit(1.0), needs_review=F.lit(False), content=payload("content", text=F.col("line")))


def page_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.readers import page_skeletons

    return page_skeletons(read(spark, sf_dir, "pages"))


def turn_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as documents: turns are paragraphs, the system's in the header zone."""
    c = read(spark, sf_dir, "conversations")
    at = source_anchor(kind=F.lit("text_anchor"), source_file=F.col("role"), heading_path=F.array(F.col("role")), block_index=F.col("turn"), keys=F.array(*map(F.lit, ("kind", "source_file", "heading_path", "block_index"))))
    return blocks(c, doc_id=F.col("conv_id").cast("string"), ord=F.col("turn"), id=F.concat(F.lit("t"), F.col("turn")), type=F.lit("para"), source_anchor=at, confidence=F.lit(1.0), needs_review=F.lit(False), source_zone=F.when(F.col("role") == "system", "header"), content=payload("content", text=F.col("text")))


def part_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as headings: the brand is the document, the size gives a level from 1 to 6."""
    p = read(spark, sf_dir, "part")
    level = F.pmod(F.col("p_size"), F.lit(6)) + 1
    return blocks(p, doc_id=F.col("p_brand"), ord=F.col("p_partkey"), id=F.concat(F.lit("h"), F.col("p_partkey")), type=F.lit("heading"), source_anchor=source_anchor(kind=F.lit("pdf_page"), source_file=F.col("p_type"), page=F.col("p_size"), keys=F.array(F.lit("page"))), confidence=F.lit(1.0), needs_review=F.lit(False), heading=payload("heading", level=level, text=F.col("p_name")))
