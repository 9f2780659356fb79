"""Content hashes: digests, what is stale, leaks of local paths, delivered files."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text as T

# Marks of local paths, in order of precedence, and suffixes of text files.
LEAKS = ("/Users/", "/private/tmp/", "/tmp/", "C:\\", "GoogleDrive", "CloudStorage", "Downloads", "Desktop")
TEXT_SUFFIXES = ("", "css", "csv", "html", "js", "json", "jsonl", "log", "md", "txt", "xml", "yaml", "yml")
LEAK_LIMIT = 20


def file_hashes(files: DataFrame, content: str = "content") -> DataFrame:
    c = F.col(content).cast("binary")
    return files.select("doc_id", "path", F.sha2(c, 256).alias("sha256"), F.length(c).cast("long").alias("bytes"))


def digest(files: DataFrame, *keys: str) -> DataFrame:
    """One digest for each group, over its files in order of path."""
    keys = keys or ("doc_id",)
    line = lambda x: F.concat(x["path"], F.lit("\0"), x["bytes"].cast("string"), F.lit("\0"), x["sha256"], F.lit("\n"))
    all_ = F.array_sort(F.collect_list(F.struct("path", "bytes", "sha256")))
    return files.groupBy(*keys).agg(F.sha2(F.array_join(F.transform(all_, line), "").cast("binary"), 256).alias("digest"), F.count(F.lit(1)).alias("n_files"))


def phase_snapshot(files: DataFrame, phase: str) -> DataFrame:
    """The files ``(doc_id, path, sha256, bytes)`` that a phase reads and those that it writes, as rows of a snapshot.  A file
    that it rewrites is in both."""
    from .jobs import PHASE_FILES

    sides = zip(("inputs", "outputs"), PHASE_FILES[phase])
    kinds = F.filter(F.array(*[F.when(F.col("path").rlike(_globs(g)), kind) for kind, g in sides]), lambda k: k.isNotNull())
    return files.select("doc_id", F.lit(phase).alias("phase"), F.explode(kinds).alias("kind"), "path", "sha256", F.col("bytes").cast("long").alias("bytes"))


def _globs(patterns: tuple[str, ...]) -> str:
    """Patterns of paths as one regular expression: ``**`` is any depth, ``*`` stays within a folder."""
    one = lambda g: re.escape(g).replace(r"\*\*", ".+").replace(r"\*", "[^/]*")
    return "^(?:" + "|".join(map(one, patterns)) + r")\z" if patterns else r"(?!)"


def input_hashes(snapshots: DataFrame) -> DataFrame:
    """``input_hashes`` of each document's manifest: the digest of what each phase read."""
    d = digest(snapshots.where("kind = 'inputs'"), "doc_id", "phase")
    return d.groupBy("doc_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("phase", "digest")))).alias("input_hashes"))


def stale_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """Paths that were added, removed or changed between two snapshots (doc_id, path, sha256, bytes).  A document
    without an old snapshot has no difference."""
    o = old.select("doc_id", "path", F.struct("sha256", "bytes").alias("o"))
    n = new.join(old.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "path", F.struct("sha256", "bytes").alias("n"))
    both = o.join(n, ["doc_id", "path"], "full")
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(~F.col("o").eqNullSafe(F.col("n")), "changed")
    return both.select("doc_id", "path", change.alias("change")).where("change is not null")


def to_recompute(old_digests: DataFrame, new_digests: DataFrame) -> DataFrame:
    """Documents whose digest is new or differs: the others need no work."""
    return new_digests.select("doc_id", "digest").join(old_digests.select("doc_id", "digest"), ["doc_id", "digest"], "left_anti").select("doc_id")


def verify_snapshot(snapshot: DataFrame, files: DataFrame) -> DataFrame:
    """Files of a snapshot that are missing or changed."""
    f = files.select("doc_id", "path", F.col("sha256").alias("now"))
    both = snapshot.join(f, ["doc_id", "path"], "left")
    return both.where(~F.col("now").eqNullSafe(F.col("sha256"))).select("doc_id", "path", F.when(F.col("now").isNull(), "missing").otherwise("changed").alias("problem"))


def delivered(required: DataFrame, outputs: DataFrame, on_disk: DataFrame) -> DataFrame:
    """All paths that a package must account for, from three listings (doc_id, path)."""
    fold = F.regexp_replace("path", "^output/", "")
    return reduce(DataFrame.unionByName, [x.select("doc_id", fold.alias("path")) for x in (required, outputs, on_disk)]).distinct()


def first_leak(line: Column) -> Column:
    """The first pattern of a local path in a line."""
    c = F.lit(None).cast("string")
    for p in reversed(LEAKS):
        c = F.when(line.contains(p), p).otherwise(c)
    return c


def path_leaks(files: DataFrame, limit: int = LEAK_LIMIT) -> DataFrame:
    """Lines of text files (doc_id, path, text) that show a local path, ``limit`` for each document."""
    suffix = F.lower(F.regexp_extract(T.base_name(F.col("path")), r"\.([^.]*)\z", 1))
    rows = files.where(suffix.isin(*TEXT_SUFFIXES)).select("doc_id", "path", F.posexplode(T.lines(F.col("text"))).alias("ln", "line"))
    hit = rows.withColumn("pattern", first_leak(F.col("line"))).where("pattern is not null")
    top = hit.withColumn("k", F.row_number().over(W.partitionBy("doc_id").orderBy("path", "ln"))).where(F.col("k") <= limit)
    return top.select("doc_id", "path", (F.col("ln") + 1).alias("line_no"), "pattern")


def sanitized(c: Column, replacements: dict[str, str]) -> Column:
    """A text with local prefixes replaced, longer ones first."""
    for k in sorted(replacements, key=len, reverse=True):
        c = F.replace(c, F.lit(k), F.lit(replacements[k]))
    return c


def safe_component(c: Column) -> Column:
    """A file name without separators, reserved and control characters, and without dots or spaces at its ends."""
    s = F.regexp_replace(c, r'[<>:"/\\|?*\x00-\x1f]', "_")
    s = F.btrim(s, F.lit(". "))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("document"))
