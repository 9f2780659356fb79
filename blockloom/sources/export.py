"""Sinks: delivered files of documents, written by Spark's committer, partitioned by document."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def publish(files: DataFrame, path: str) -> None:
    """Write rows to ``path`` at once: to a folder beside it first, then by one rename; an old result is put aside and
    comes back if the rename fails."""
    spark = files.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    new, old = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    fs = at(path).getFileSystem(conf)
    files.repartition("doc_id").write.partitionBy("role").parquet(new)
    had = fs.exists(at(path))
    if had and not fs.rename(at(path), at(old)):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(at(new), at(path)):
        if had:
            fs.rename(at(old), at(path))
        raise OSError(f"cannot publish {path}")
    if had:
        fs.delete(at(old), True)


def upsert_section(text, heading: str, body):
    """A report text with the section of this heading replaced, or added at its end."""
    mark = f"## {heading}\n"
    pattern = rf"(?s)(?m)^## {heading}\n.*?(?=^## |\z)"
    new = F.concat(F.lit(mark + "\n"), body, F.lit("\n"))
    return F.when(F.coalesce(text, F.lit("")).contains(mark), F.regexp_replace(text, F.lit(pattern), F.concat(F.regexp_replace(new, r"([\\$])", r"\\$1")))).otherwise(F.concat(F.coalesce(text, F.lit("")), F.lit("\n"), new))
