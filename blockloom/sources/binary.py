"""A data source for binary documents: the contract to an extraction backend.

The backend is a callable ``bytes, suffix -> skeleton text``, found by name in the option ``backend`` (``module:function``),
else in the session's ``blockloom.backend``.  Plain text and Markdown need none.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

PLAIN = (".md", ".txt")


def resolve(spark: SparkSession, backend: str | None = None) -> str | None:
    return backend or spark.conf.get("blockloom.backend", None)


def _load(name: str) -> Callable[[bytes, str], str]:
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def skeletons(spark: SparkSession, path: str, backend: str | None = None) -> DataFrame:
    """Skeletons of the files below ``path``: ``doc_id, source_file, fmt, text, error``.

    A file that the backend cannot read gets an error instead of a text; the others go on."""
    name = resolve(spark, backend)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    schema = pa.schema([("path", pa.string()), ("text", pa.string()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = _load(name) if name else None
        for rb in batches:
            for p, content in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                suffix = "." + p.rsplit(".", 1)[-1].lower() if "." in p.rsplit("/", 1)[-1] else ""
                text = error = None
                if suffix in PLAIN:
                    text = content.decode("utf-8", "replace")
                elif call is None:
                    error = f"no backend for {suffix or 'files without a suffix'}"
                else:
                    try:
                        text = call(content, suffix)
                    except Exception as e:  # one bad file must not end the job
                        error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in (p, text, error)], schema=schema)

    rows = files.mapInArrow(run, "path string, text string, error string")
    fmt = F.lower(F.regexp_extract("path", r"(\.[^./]*)\z", 1))
    return rows.select(F.sha1("path").alias("doc_id"), T.base_name(F.col("path")).alias("source_file"), fmt.alias("fmt"), "text", "error")
