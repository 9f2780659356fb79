"""String functions of the engine as column expressions.

Java's ``\\s`` and ``trim`` are narrower than the Unicode rules the block grammar is defined by, so white space and
line ends are spelled out here once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space plus the four information separators.
WS = r"(?U)[\s\x1c-\x1f]"
LINE_END = r"\r\n|[\n\u000b\u000c\r\x1c-\x1e\u0085\u2028\u2029]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{WS}+|{WS}+\z", "")


def rstrip(c: Column) -> Column:
    return F.regexp_replace(c, rf"{WS}+\z", "")


def lines(c: Column) -> Column:
    """Array of lines; a line end at the end of the text starts no further line, an empty text has none."""
    parts = F.split(c, LINE_END, -1)
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, 1, F.size(parts) - 1)).otherwise(parts)


def ascii_slug(c: Column, limit: int = 40) -> Column:
    """ASCII words in lower case joined by ``_``, cut to ``limit``."""
    words = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("[A-Za-z0-9]+"), F.lit(0))
    return F.btrim(F.substring(F.lower(F.array_join(words, "_")), 1, limit), F.lit("_"))


def gfm_slug(c: Column) -> Column:
    """Heading anchor: lower case, letters, digits, marks of words, spaces and hyphens only; never empty."""
    kept = F.regexp_replace(F.lower(strip(c)), r"[^\p{L}\p{N}_ -]", "")
    return F.coalesce(F.nullif(F.replace(kept, F.lit(" "), F.lit("-")), F.lit("")), F.lit("section"))


def job_slug(c: Column) -> Column:
    """Slug of a job name: runs of other characters become one hyphen, edges trimmed, ``doc`` if nothing is left."""
    s = F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9_-]+", "-"), F.lit("-_"))
    return F.coalesce(F.nullif(s, F.lit("")), F.lit("doc"))


def issue_slug(c: Column, limit: int = 48) -> Column:
    s = F.btrim(F.regexp_replace(F.lower(c), "[^a-z0-9_]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(F.substring(s, 1, limit), F.lit("")), F.lit("item"))


def squeeze(c: Column) -> Column:
    """Lower case without any white space: the form that column names are matched in."""
    return F.regexp_replace(F.lower(c), WS, "")


def estimate_tokens(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.octet_length(c) / 4)).cast("long")


def yaml_quoted(c: Column) -> Column:
    s = F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    return F.concat(F.lit('"'), s, F.lit('"'))


def md_cell(c: Column) -> Column:
    return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def blockquote(c: Column) -> Column:
    return F.array_join(F.transform(lines(c), lambda x: F.when(strip(x) == "", ">").otherwise(F.concat(F.lit("> "), x))), "\n")


def base_name(c: Column) -> Column:
    return F.regexp_extract(F.coalesce(c, F.lit("")), r"([^/]*)/*\z", 1)


def stem(c: Column) -> Column:
    return F.regexp_replace(base_name(c), r"(?<=.)\.[^.]*\z", "")


def latex_balanced(c: Column) -> Column:
    """Braces and ``\\left``/``\\right`` occur equally often."""
    n = lambda p: F.regexp_count(c, F.lit(p))
    return (n(r"\{") == n(r"\}")) & (n(r"\\left\b") == n(r"\\right\b"))


def latex_strip(c: Column) -> Column:
    """Without one matched pair of ``$`` or ``$$``; an escaped closing one does not count."""
    s = strip(c)
    inner = F.regexp_extract(s, r"(?s)^\${1,2}(.*?)(?<!\\)\${1,2}\z", 1)
    return F.when(s.rlike(r"(?s)^\${1,2}.*?(?<!\\)\${1,2}\z"), strip(inner)).otherwise(s)


SOURCE_MARK = "〔源 [^〕]+〕"
# Normalised titles that say nothing about a document.
GENERIC_TITLES = ("", "pdf", "doc", "docx", "document", "file", "md", "markdown", "ppt", "pptx", "txt", "untitled", "unknown", "xlsx", "文档", "文件", "未命名")


def clean_title(c: Column) -> Column:
    s = strip(F.regexp_replace(c, SOURCE_MARK, ""))
    return F.regexp_replace(strip(F.regexp_replace(s, "<[^>]+>", "")), r"^['\" ]+|['\" ]+\z", "")


def generic_title(c: Column) -> Column:
    n = F.lower(F.regexp_replace(clean_title(c), r"(?U)[\s_\-.:：/\\]+", ""))
    return n.isin(*GENERIC_TITLES) | (F.length(n) <= 1)


# Fixed value: labels of figures and devices that are no section headings.
CAPTION_LABEL = r"(?i)^\s*(?:\d+\s+to\s+\d+\b|\d+\s*×\s*\d+\b|(?:图|表|公式|图表|fig\.?|figure|table|equation|scheme)\s*\d)"


def caption_label(c: Column) -> Column:
    return strip(c).rlike(CAPTION_LABEL)


def control_chars(c: Column) -> Column:
    """Number of control characters other than line ends and tabs."""
    return F.regexp_count(c, F.lit(r"[\p{Cc}&&[^\n\r\t]]"))


# Fixed value: sequences that betray UTF-8 read as a single-byte encoding.
MOJIBAKE = "Ã.|Â.|â€|ï¼|ä¸|å"
