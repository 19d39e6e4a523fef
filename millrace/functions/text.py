"""Text columns: cleaning, tokens, markup. All expressions are native and NULL-safe."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns that define cleaned text, token borders and anchor markup.
NOT_LETTER_OR_SPACE = r"[^a-z\s]"
WHITESPACE = r"\s"
ANCHOR_GREEDY = r"<a.+/a>"
ANCHOR_LAZY = r"<a.+?/a>"


def clean_text(text: Column) -> Column:
    """Lower-case, then delete everything but a-z and whitespace."""
    return F.regexp_replace(F.lower(text), NOT_LETTER_OR_SPACE, "")


def tokens(text: Column) -> Column:
    """Lower-cased pieces between single whitespace characters, empty pieces removed."""
    return F.array_remove(F.split(F.lower(text), WHITESPACE), "")


def token_set(text: Column) -> Column:
    """Distinct tokens of a text."""
    return F.array_distinct(tokens(text))


def space_pieces(text: Column) -> Column:
    """Pieces between single blanks, case and empty pieces kept."""
    return F.split(text, " ")


def strip_anchors(text: Column, lazy: bool = False) -> Column:
    """Delete anchor markup within a line.

    The default runs from the first ``<a`` to the last ``/a>`` of a line, so text between two
    links goes too; ``lazy`` stops at the nearest ``/a>``.
    """
    return F.regexp_replace(text, ANCHOR_LAZY if lazy else ANCHOR_GREEDY, "")


def drop_colons(text: Column) -> Column:
    return F.regexp_replace(text, ":", "")


def token_rows(df: DataFrame, text_col: str, *keep: str, out: str = "word") -> DataFrame:
    """One row per token, with the ``keep`` columns. No shuffle."""
    return exploded(df, tokens(F.col(text_col)), out, *keep).where(F.col(out).isNotNull())


def exploded(df: DataFrame, array: Column, out: str, *keep: str) -> DataFrame:
    """One row per element; a row without elements stays, with NULL.

    A plain explode makes Spark filter on the array's size first, at the scan, and so compute an
    expensive array several times over.
    """
    return df.select(*keep, F.explode_outer(array).alias(out))


def without_stop_words(rows: DataFrame, stop_words: list[str], word_col: str = "word") -> DataFrame:
    """Drop token rows found in a word list given by the caller (a literal, so no join)."""
    return rows.where(~F.col(word_col).isin([w.lower() for w in stop_words]))


def without_stop_table(rows: DataFrame, stop_words: DataFrame, word_col: str = "word") -> DataFrame:
    """Drop token rows found in a one-column table of stop words.

    The table may be of any size: whether it is broadcast is left to its measured size.
    """
    stop = stop_words.select(F.lower(F.trim(F.col(stop_words.columns[0]))).alias(word_col)).distinct()
    return rows.join(stop, word_col, "left_anti")
