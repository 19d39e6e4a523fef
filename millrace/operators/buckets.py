"""Equi-join of two bucket tables whose buckets may be very uneven."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET_ROWS = 20_000
SAMPLE = 0.01


def large_buckets(
    rows: DataFrame, keys: Sequence[str], bucket_rows: int = BUCKET_ROWS, fraction: float = 1.0
) -> DataFrame | None:
    """(keys, parts) of the buckets with more than ``bucket_rows`` rows, or None.

    ``rows`` may come from a sample of ``fraction`` of the sets: the answer only decides into how
    many parts a bucket is cut, never which rows are compared. The result is small, as at most
    rows / ``bucket_rows`` buckets can be that large, and it is fixed on the driver so that a
    recomputed stage cuts alike.
    """
    least = max(2.0, bucket_rows * fraction)
    counts = rows.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > least)
    parts = counts.select(*keys, F.ceil(F.col("__n") / least).cast("int").alias("__parts"))
    found = parts.collect()
    return rows.sparkSession.createDataFrame(found, parts.schema) if found else None


def sampled_large_buckets(
    table: DataFrame,
    make_rows: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    bucket_rows: int = BUCKET_ROWS,
    fraction: float = SAMPLE,
) -> DataFrame | None:
    """Large buckets as seen on a sample of the input rows; a table that small has none."""
    if table.count() <= bucket_rows:  # no column is read for this
        return None
    part = table if fraction >= 1.0 else table.sample(fraction, seed=1)
    return large_buckets(make_rows(part), keys, bucket_rows, fraction)


def _cut(side: DataFrame, parts: DataFrame | None, keys: list[str], id_col: str, own: str) -> DataFrame:
    """Give the rows of large buckets a part number by a hash of their id."""
    if parts is None:
        return side.withColumn(own, F.lit(0))
    # bounded: rows / bucket_rows buckets at most
    known = side.join(F.broadcast(parts), keys, "left")
    part = F.pmod(F.xxhash64(id_col), F.coalesce("__parts", F.lit(1))).cast("int")
    return known.withColumn(own, part).drop("__parts")


def _copy(side: DataFrame, parts: DataFrame | None, keys: list[str], other: str) -> DataFrame:
    """Copy the rows of large buckets to every part of the other side."""
    if parts is None:
        return side.withColumn(other, F.lit(0))
    known = side.join(F.broadcast(parts), keys, "left")
    every = F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))
    return known.withColumn(other, every).drop("__parts")


def cut_sides(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_id: str, right_id: str, left_parts: DataFrame | None, right_parts: DataFrame | None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides with the cells of their buckets, and the keys of a cell: each side is split by a hash of its id and copied once per part of the other."""
    keys = list(keys)
    a = _copy(_cut(left, left_parts, keys, left_id, "__lp"), right_parts, keys, "__rp")
    b = _copy(_cut(right, right_parts, keys, right_id, "__rp"), left_parts, keys, "__lp")
    return a, b, [*keys, "__lp", "__rp"]


def bucket_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    condition: Column,
    left_id: str,
    right_id: str,
    left_parts: DataFrame | None = None,
    right_parts: DataFrame | None = None,
) -> DataFrame:
    """Join on ``keys`` and ``condition``; every matching pair of rows meets in exactly one task.

    A bucket named in the parts tables is cut into cells: each side is split by a hash of its id
    and copied once per part of the other side. Nothing is left out, other buckets are untouched,
    and without large buckets this is one plain equi-join.
    """
    keys = list(keys)
    if left_parts is None and right_parts is None:
        return left.join(right, keys).where(condition)
    a, b, cell = cut_sides(left, right, keys, left_id, right_id, left_parts, right_parts)
    return a.join(b, cell).where(condition).drop("__lp", "__rp")
