"""Splitting of hot groups into ordered slices.

A window over ``partitionBy(key)`` puts all rows of a key into one task. When one key holds a
large part of the data that task never ends, and adaptive execution cannot help, because it
may not split a window partition. The functions here cut such a group along its order into
slices of bounded size. A window then runs per (key, slice), and what it misses from the
slices before (counts, sums, the last few rows) is added from small per-slice totals.

The cut points are found once per call by small aggregate jobs (row counts per key, approximate
percentiles of the hot keys) and enter the plan as constants, so a recomputed stage cuts at the
same places. What comes to the driver is at most a few cut points per ``max_rows`` rows, and of one key at most
``MAX_PIECES`` or a few per ``PIECE_ROWS`` rows: every row of the key is compared with them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_GROUP_ROWS = 4_000_000
#: Slices of a key at most, unless these would hold more than ``PIECE_ROWS`` rows.
MAX_PIECES, PIECE_ROWS = 200, 1_000_000
SLICE = "__slice"
HOT = "__hot"


class Slices:
    """Rows with a slice number per key; ``hot`` tells whether any key was cut.

    If so, the rows of the cut keys are marked in the column ``__hot``.
    """

    def __init__(self, df: DataFrame, keys: Sequence[str], order: Sequence[str], hot: bool):
        self.df = df
        self.keys = list(keys)
        self.order = list(order)
        self.hot = hot
        self.parts = [*self.keys, SLICE]


def attach(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join that keeps the key columns of the left side only.

    Without keys the right side is a single row, joined over a constant.
    """
    if not keys:
        one = "__one"
        return left.withColumn(one, F.lit(1)).join(right.withColumn(one, F.lit(1)), one, how).drop(one)
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"__r_{key}"))
    return left.join(renamed, condition, how).drop(*[f"__r_{k}" for k in keys])


def _percentiles(column: str, pieces: int) -> Column:
    cuts = F.array([F.lit(i / pieces) for i in range(1, pieces)])
    return F.percentile_approx(column, cuts, F.lit(max(10_000, 20 * pieces)))


def _pieces(rows: int, max_rows: int) -> int:
    """Into how many slices a key of so many rows is cut: no more than tasks can use, as long as each stays small enough for one."""
    return min(math.ceil(rows / max_rows), max(MAX_PIECES, math.ceil(rows / PIECE_ROWS))) + 1


def _tuple(values: Sequence[Column]) -> Column:
    return F.struct(*[v.alias(f"o{i}") for i, v in enumerate(values)])


def _position(cuts: Column, n_cuts: Column, value: Column, steps: int) -> Column:
    """Number of cut points strictly below the value, by bisection."""
    start = F.struct(F.lit(0).alias("lo"), n_cuts.cast("int").alias("hi"))

    def halve(state: Column, _: Column) -> Column:
        lo, hi = state["lo"], state["hi"]
        mid = F.floor((lo + hi) / 2).cast("int")
        below = F.try_element_at(cuts, mid + 1) < value
        return (
            F.when(lo >= hi, state)
            .when(below, F.struct((mid + 1).alias("lo"), hi.alias("hi")))
            .otherwise(F.struct(lo.alias("lo"), mid.alias("hi")))
        )

    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), start, halve)["lo"]


def _cut_points(
    df: DataFrame, keys: list[str], order: list[str], hot: DataFrame, pieces: int
) -> DataFrame:
    """Sorted cut points per hot key, as arrays of order tuples.

    A first-column value that fills several percentiles is cut again along the second column.
    """
    head, rest = order[0], order[1:]
    members = attach(df, F.broadcast(hot.select(*keys)), keys) if keys else df
    first = members.groupBy(*keys).agg(
        _percentiles(head, pieces).alias("q"), *[F.max(c).alias(f"__max_{c}") for c in rest]
    )
    ends = [F.col(f"__max_{c}") for c in rest]
    value = first.select(*keys, F.explode("q").alias("v"), *ends)
    cuts = value.where("v IS NOT NULL").select(*keys, _tuple([F.col("v"), *ends]).alias("cut"))
    if rest:
        heavy = value.groupBy(*keys, "v").agg(F.count("*").alias("n")).where("n > 1")
        # one row per repeated percentile, so at most `pieces` rows per hot key
        heavy_rows = heavy.drop("n").withColumnRenamed("v", head).collect()
        if heavy_rows:
            small = df.sparkSession.createDataFrame(
                heavy_rows, T.StructType([df.schema[c] for c in [*keys, head]])
            )
            inner = attach(members, F.broadcast(small), [*keys, head])
            second = inner.groupBy(*keys, head).agg(
                _percentiles(rest[0], pieces).alias("q"),
                *[F.max(c).alias(f"__max_{c}") for c in rest[1:]],
            )
            deeper = second.select(
                *keys, F.col(head).alias("v"), F.explode("q").alias("w"),
                *[F.col(f"__max_{c}") for c in rest[1:]],
            ).where("w IS NOT NULL")
            tail = [F.col(f"__max_{c}") for c in rest[1:]]
            cuts = cuts.unionByName(
                deeper.select(*keys, _tuple([F.col("v"), F.col("w"), *tail]).alias("cut"))
            )
    return cuts.groupBy(*keys).agg(F.array_sort(F.collect_set("cut")).alias("cuts"))


def slice_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int | None = MAX_GROUP_ROWS,
) -> Slices:
    """Number the rows of every key by slice, ascending along ``order``.

    ``order`` holds one or more numeric or time columns. Rows equal in all order columns stay in
    one slice. Keys of at most ``max_rows`` rows are one slice, number 0; slices of larger ones hold about as many, or more
    where a key would have over ``MAX_PIECES`` of them, up to ``PIECE_ROWS``. Slice numbers rise with
    the order but need not be dense. ``max_rows=None`` is the caller's word that every group is
    small by nature (hours of a day, say), and skips the look for hot keys.
    """
    keys, order = list(keys), list(order)
    whole = df.withColumn(SLICE, F.lit(0))
    if max_rows is None:
        return Slices(whole, keys, order, False)
    slim = df.select(*dict.fromkeys([*keys, *order]))
    counts = slim.groupBy(*keys).agg(F.count("*").alias("__n"))
    hot_rows = counts.where(F.col("__n") > max_rows).collect()  # at most rows / max_rows keys
    if not hot_rows:
        return Slices(whole, keys, order, False)
    spark = df.sparkSession
    largest = max(r["__n"] for r in hot_rows)
    pieces = _pieces(largest, max_rows)
    hot = spark.createDataFrame(
        hot_rows, T.StructType([*[df.schema[k] for k in keys], T.StructField("__n", T.LongType())])
    )
    cut_rows = _cut_points(slim, keys, order, hot, pieces).collect()  # a few cuts per hot key
    if not cut_rows:
        return Slices(whole, keys, order, False)
    cut_type = T.StructType([T.StructField(f"o{i}", df.schema[c].dataType) for i, c in enumerate(order)])
    cut_schema = T.StructType(
        [*[df.schema[k] for k in keys], T.StructField("__cuts", T.ArrayType(cut_type))]
    )
    cuts = spark.createDataFrame(cut_rows, cut_schema)
    steps = max(1, math.ceil(math.log2(max(len(r["cuts"]) for r in cut_rows) + 1)) + 1)
    # bounded: one row per hot key, and all cut points together are few per `max_rows` rows
    small = F.broadcast(cuts)
    joined = attach(df, small, keys, "left")
    position = _position(
        F.col("__cuts"), F.size("__cuts"), _tuple([F.col(c) for c in order]), steps
    )
    sliced = (
        joined.withColumn(HOT, F.col("__cuts").isNotNull())
        .withColumn(SLICE, F.when(F.col(HOT), position).otherwise(0))
        .drop("__cuts")
    )
    return Slices(sliced, keys, order, True)
