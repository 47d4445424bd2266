"""Scalar text functions as JVM column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line patterns that define the format.
# Unicode white space as one character class; (?U) makes \s Unicode-aware, (?d) lets . stop at \n only.
EDGE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"
FENCE = r"(?Ud)^\s*(`{3,}|~{3,})"
HEADER = r"(?Ud)^(#{1,6})\s+(.*)"
TAG = r"(?Ud)^\s*(#[^#\s]+)\s*$"
TABLE = r"(?Ud)^\s*\|.*\|\s*$"
HEADING_LINE = r"^#{1,6} "
LINE_BREAKS = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def strip(c: Column) -> Column:
    return F.regexp_replace(c, EDGE, "")


def strip_line(c: Column) -> Column:
    """strip(c), where a line that is nothing but printable ASCII at both ends, before its newline, needs no pattern."""
    body = F.when(c.endswith("\n"), F.substring(c, F.lit(1), F.char_length(c) - 1)).otherwise(c)
    return F.when(F.ascii(body).between(33, 126) & F.ascii(F.substring(body, -1, 1)).between(33, 126), body).otherwise(strip(c))


def universal_newlines(c: Column) -> Column:
    return F.when(c.contains("\r"), F.regexp_replace(c, "\r\n?", "\n")).otherwise(c)


def let(value: Column, use) -> Column:
    """use(value), with value computed once per row."""
    return F.element_at(F.transform(F.array(value), use), 1)


def heading_only(c: Column) -> Column:
    """Whether a stripped text is empty or consists of lines of 1-6 # and a space."""
    return (c == "") | F.forall(F.split(c, LINE_BREAKS), lambda x: strip(x).rlike(HEADING_LINE))


def md5_16(c: Column) -> Column:
    return F.substring(F.md5(c.cast("binary")), 1, 16)


def block_id(path: Column, start: Column, end: Column, content: Column) -> Column:
    return F.md5(F.concat_ws("_", path, start.cast("string"), end.cast("string"), md5_16(content)).cast("binary"))


def cjk_count(c: Column) -> Column:
    return F.char_length(F.regexp_replace(c, r"[^\x{4e00}-\x{9fff}]", ""))


def token_estimate(c: Column) -> Column:
    """max(1, int(1.3 per CJK character + 0.25 per other character))."""
    return let(cjk_count(c), lambda n: F.greatest((n * F.lit(1.3) + (F.char_length(c) - n) * F.lit(0.25)).cast("int"), F.lit(1)))
