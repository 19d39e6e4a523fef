"""Chat exports: folding lines into records, parsing records, statistics per sender and month."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import chat as C
from ..functions.text import drop_colons, token_rows
from .slicing import MAX_GROUP_ROWS, attach
from .windows import number_rows, rank_within, running_total


MAX_RECORD_LINES = 100_000


def fold_lines(
    lines: DataFrame,
    file_cols: Sequence[str],
    order: Sequence[str],
    line_col: str = "value",
    joiner: str = "\n",
    max_rows: int | None = MAX_GROUP_ROWS,
    max_lines: int = MAX_RECORD_LINES,
) -> DataFrame:
    """(file columns, record, part, value): a line with a date header starts a record, others
    continue it.

    Further parts of a record open with its header and sender again, so that they parse like it.
    Lines before the first header of a file are record 0. The running count of headers is taken
    in slices, so one huge file is not one task. A record is one row, part 0, unless it has more
    than ``max_lines`` lines (a file that is no chat): it then goes on in further parts, so that
    no row has to hold a whole file.
    """
    keys = [*file_cols, "record"]
    marked = running_total(lines, file_cols, order, C.starts_record(F.col(line_col)).cast("int"), "record", max_rows)
    long = _long_records(lines, marked, file_cols, keys, max_lines)
    if long:
        spark = lines.sparkSession
        # bounded: rows / max_lines records at most
        named = spark.createDataFrame(long, marked.select(*keys).schema).withColumn("__long", F.lit(True))
        known = attach(marked, F.broadcast(named), keys, "left")
        short_lines = known.where("__long IS NULL").withColumn("part", F.lit(0).cast("long"))
        numbered = number_rows(known.where("__long"), keys, order, "__row", max_rows=max_rows)
        numbered = numbered.withColumn("part", F.floor((F.col("__row") - 1) / max_lines))
        parted = short_lines.unionByName(numbered.drop("__row"))
        opening = F.regexp_extract(line_col, C.OPENING, 0)
        leads = numbered.where((F.col("__row") == 1) & C.starts_record(F.col(line_col))).select(*keys, opening.alias("__lead"))
    else:
        parted = marked.withColumn("part", F.lit(0).cast("long"))
    piece = F.struct(*order, F.col(line_col).alias("__line"))
    grouped = parted.groupBy(*keys, "part").agg(F.sort_array(F.collect_list(piece)).alias("__p"))
    folded = grouped.select(*keys, "part", F.array_join("__p.__line", joiner).alias("value"))
    if not long:
        return folded
    led = attach(folded, leads, keys, "left")
    lead = F.when(F.col("part") > 0, F.col("__lead"))
    return led.select(*keys, "part", F.concat(F.coalesce(lead, F.lit("")), "value").alias("value"))


def _long_records(
    lines: DataFrame, marked: DataFrame, file_cols: Sequence[str], keys: Sequence[str], max_lines: int
) -> list:
    """Keys of the records with more than ``max_lines`` lines: at most rows / max_lines of them.

    Only a file with that many lines can hold one, so the files are counted first.
    """
    sizes = lines.groupBy(*file_cols).agg(F.count("*").alias("__n")).where(F.col("__n") > max_lines)
    large_files = sizes.drop("__n").collect()
    if not large_files:
        return []
    chosen = lines.sparkSession.createDataFrame(large_files, sizes.drop("__n").schema)
    inside = attach(marked, F.broadcast(chosen), file_cols)
    counts = inside.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > max_lines)
    return counts.select(*keys).collect()


def parse_records(records: DataFrame, value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """(keep, header, timestamp, name, msg) of records; text after a second border is kept.

    A record without a border has no sender or message, and a NULL timestamp.
    """
    parts = F.split(F.col(value_col), C.BORDER, 2)
    cut = records.select(*keep, parts[0].alias("header"), F.try_element_at(parts, F.lit(2)).alias("rest"))
    return cut.select(
        *keep,
        "header",
        F.when(F.col("rest").isNotNull(), C.parse_time(F.col("header"))).alias("timestamp"),
        C.sender(F.col("rest")).alias("name"),
        C.message(F.col("rest")).alias("msg"),
    )


def unparsed(messages: DataFrame) -> DataFrame:
    """Messages whose time could not be read."""
    return messages.where(F.col("timestamp").isNull())


def word_counts(
    messages: DataFrame, stop_words: Sequence[str], only: str | None = None, name: str = "name", text: str = "msg"
) -> DataFrame:
    """(name, word, count): words per sender, colons deleted and stop words left out.

    Words are counted message by message and combined before the shuffle; no row ever holds a
    sender's whole history.
    """
    chosen = messages.where(F.col(name) == only) if only is not None else messages
    plain = chosen.select(F.col(name).alias("name"), drop_colons(F.col(text)).alias("text"))
    words = token_rows(plain, "text", "name")
    kept = words.where(~F.col("word").isin([w.lower() for w in stop_words]))
    return kept.groupBy("name", "word").agg(F.count("*").alias("count"))


def monthly_counts(rows: DataFrame, time: Column, name: Column) -> DataFrame:
    """(year, month, name, count)."""
    dated = rows.select(F.year(time).alias("year"), F.month(time).alias("month"), name.alias("name"))
    return dated.groupBy("year", "month", "name").agg(F.count("*").alias("count"))


def monthly_rank(rows: DataFrame, time: Column, name: Column, max_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """Dense rank of the names of each month by their count, most first."""
    counts = monthly_counts(rows, time, name)
    return rank_within(counts, ["year", "month"], "count", {"dense_rank": "rank"}, max_rows=max_rows)
