"""File-drop ingest: new skeleton files become blocks as they arrive, each file once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import text as T
from ..operators.parse import parse


def skeleton_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    s = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).text(path, wholetext=True)
    p = F.col("_metadata.file_path")
    return s.select(F.sha1(p).alias("doc_id"), T.base_name(p).alias("source_file"), F.lower(F.regexp_extract(p, r"(\.[^./]*)\z", 1)).alias("fmt"), F.col("value").alias("text"))


def ingest(spark: SparkSession, path: str, out: str, checkpoint: str) -> StreamingQuery:
    """Parse each batch of new files to blocks under ``out``; a batch that is run again replaces what it wrote."""

    def batch(df: DataFrame, number: int) -> None:
        parse(df).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return skeleton_stream(spark, path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
