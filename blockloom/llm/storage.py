"""Tables written between steps to the folder that the cluster shares, and batch sizes for Python stages."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Rows that Spark hands to Python at once; long texts make large batches.
ARROW_ROWS = 1000
_SHIPPED: dict[str, str | None] = {}
#: Paths of stored tables that are not yet deleted.
_HELD: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The shared folder: ``spark.checkpoint.dir``; where it is unset (tests on one machine), a temporary folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def _path(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def temporary(spark: SparkSession, path: str) -> str:
    """``path``, which goes when the application ends or by ``discard_paths``."""
    p, fs = _path(spark, path)
    fs.deleteOnExit(p)
    _HELD.add(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there, and any executor can
    read it.  The files go by ``discard``, or when the application ends."""
    spark = df.sparkSession
    path = temporary(spark, f"{shared_dir(spark)}/tables/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete stored tables after their last reader."""
    for t in tables:
        path = getattr(t, "stored_path", None)
        if path in _HELD:
            p, fs = _path(t.sparkSession, path)
            fs.delete(p, True)
            _HELD.discard(path)


def held() -> set[str]:
    """Paths of the stored tables that still exist."""
    return set(_HELD)


def discard_paths(spark: SparkSession, paths: set[str]) -> None:
    """Delete what lies at ``paths``.  Only where all results that read it are written."""
    for path in sorted(paths):
        p, fs = _path(spark, path)
        fs.delete(p, True)
        _HELD.discard(path)


def small_batches(spark: SparkSession) -> None:
    """Prepare the session for Python stages: small batches, and this package on every executor."""
    package = Path(__file__).resolve().parents[1]
    shipped = spark.sparkContext.getConf().get("spark.app.id")
    if _SHIPPED.get("app") != shipped and (package / "__init__.py").exists():
        path = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(path))
        _SHIPPED["app"] = shipped
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of steps that are finished and written."""
    for _ in range(2):  # first Python's hold on the plan goes, then the plan, then its files
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def text_bytes(df: DataFrame, text: str) -> int:
    """Bytes of text in the whole table: sizes the number of buckets."""
    from pyspark.sql import functions as F

    return int(df.agg(F.sum(F.octet_length(text))).first()[0] or 0)


def buckets(df: DataFrame, text: str, mb: int = 8) -> int:
    """Buckets so that one holds about ``mb`` of text, and at least as many as the session shuffles to."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes(df, text) // (mb << 20)))


