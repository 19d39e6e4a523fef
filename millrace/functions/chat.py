"""Columns over chat-export lines such as ``1/5/17, 9:05 - name: message``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Date header, border between header and rest, time pattern. The header is looked for at
# the start of a line only, after a bracket or a direction mark if there is one.
HEADER = r"^[\[\u200e\u200f\ufeff]*\d+\W\d+\W\d{2}\W+\d+\W\d+"
BORDER = r"\s+\W+\s"
TIME_PATTERN = "M/d/yy, H:mm"
# What opens a record: all up to the border, and the sender where there is one.
OPENING = rf"^.*?{BORDER}(?:[^:\n]*: ?)?"


def starts_record(line: Column) -> Column:
    """True for a line that opens a record; NULL lines never do."""
    return F.coalesce(line.rlike(HEADER), F.lit(False))


def parse_time(text: Column) -> Column:
    """Time of a header, one- or two-digit month, day and hour; NULL when not a valid time."""
    return F.try_to_timestamp(text, F.lit(TIME_PATTERN)).cast("timestamp_ntz")


def render_time(ts: Column) -> Column:
    return F.date_format(ts, TIME_PATTERN)


def sender(rest: Column) -> Column:
    """Text before the first colon; empty for a system message."""
    return F.when(F.instr(rest, ":") > 0, F.substring_index(rest, ":", 1)).otherwise("")


def message(rest: Column) -> Column:
    """Text after the first colon without the one blank that follows it; all of a system message."""
    return F.when(F.instr(rest, ":") > 0, F.regexp_replace(rest, r"^[^:]*: ?", "")).otherwise(rest)
