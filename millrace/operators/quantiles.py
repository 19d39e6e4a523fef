"""Quantiles of a numeric column, exact and from summaries of bounded size, and binning."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .slicing import MAX_GROUP_ROWS, attach
from .windows import running_total


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Sequence[float], max_rows: int | None = MAX_GROUP_ROWS
) -> DataFrame:
    """(probability, value) per probability: the smallest value with that share of rows at or below it.

    Equal values are counted before anything is ordered, so the ordered part is as long as the
    number of distinct values, and is cut into slices when that is large.
    """
    counted = (
        df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("__c"))
    )
    so_far = running_total(counted, [], [column], F.col("__c"), "__upto", max_rows)
    total = counted.agg(F.sum("__c").alias("__total"))
    shares = attach(so_far, F.broadcast(total), [])  # one row

    def reached(p: float) -> Column:
        enough = F.col("__upto") >= F.greatest(F.ceil(F.col("__total") * F.lit(p)), F.lit(1))
        return F.min(F.when(enough, F.col(column))).alias("value")

    row = shares.agg(
        F.array(*[F.struct(F.lit(p).alias("probability"), reached(p)) for p in probabilities]).alias("q")
    )
    return row.select(F.inline("q"))


def quantile_edges(
    df: DataFrame, column: str, buckets: int, max_rows: int | None = MAX_GROUP_ROWS
) -> list[float]:
    """Distinct inner edges of ``buckets`` equally filled bins. At most ``buckets - 1`` numbers."""
    wanted = [i / buckets for i in range(1, buckets)]
    found = exact_quantiles(df, column, wanted, max_rows).collect()
    return sorted({float(r["value"]) for r in found if r["value"] is not None})


def _rows_of(probabilities: Sequence[float], values: Column) -> Column:
    """(probability, value) rows of an array of values in the order of the probabilities."""
    return F.inline(F.arrays_zip(F.array(*[F.lit(float(p)) for p in probabilities]).alias("probability"), values.alias("value")))


def approximate_quantiles(df: DataFrame, column: str, probabilities: Sequence[float], error: float) -> DataFrame:
    """(probability, value): values of the column whose ranks miss by at most ``error`` of the rows.

    Each task keeps a summary of a size that hangs on ``error`` alone, and summaries are merged: no sort and no shuffle of rows.
    """
    accuracy = math.ceil(1 / error)
    found = df.agg(F.percentile_approx(F.col(column).cast("double"), [float(p) for p in probabilities], accuracy).alias("value"))
    return found.where("value IS NOT NULL").select(_rows_of(probabilities, F.col("value")))


def quantile_sketches(df: DataFrame, keys: Sequence[str], column: str, size: int = 400) -> DataFrame:
    """(keys, sketch): a mergeable sketch of each group's values, to be stored and put together later. ``size`` sets its error, about 2 / size of the ranks."""
    rows = df.where(F.col(column).isNotNull() & ~F.isnan(F.col(column).cast("double")))
    return rows.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(column).cast("double"), F.lit(size)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """(probability, value) over all rows that the sketches were made of."""
    whole = sketches.agg(F.kll_merge_agg_double("sketch").alias("sketch"), F.count("*").alias("n")).where("n > 0")
    values = F.array(*[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))) for p in probabilities])
    return whole.select(values.alias("value")).select(_rows_of(probabilities, F.col("value")))


def rank_errors(df: DataFrame, column: str, quantiles: DataFrame) -> DataFrame:
    """(probability, value, n, error): by what share of the rows each value's ranks miss the wanted one, counted exactly."""
    asked = sorted((r["probability"], r["value"]) for r in quantiles.collect())  # a row per probability
    rows = df.where(F.col(column).isNotNull())
    counts = [F.struct(F.lit(p).alias("probability"), F.lit(v).alias("value"), F.count_if(F.col(column) < v).alias("below"), F.count_if(F.col(column) <= v).alias("upto")) for p, v in asked]
    if not counts:
        return df.sparkSession.createDataFrame([], "probability double, value double, n bigint, error double")
    found = rows.agg(F.count("*").alias("n"), F.array(*counts).alias("q")).select("n", F.inline("q"))
    wanted = F.col("probability") * F.col("n")
    error = F.greatest(F.col("below") - wanted, wanted - F.col("upto"), F.lit(0.0)) / F.col("n")
    return found.select("probability", "value", "n", error.alias("error"))


def bin_number(value: Column, edges: Sequence[float]) -> Column:
    """Number of edges at or below the value; NULL for NULL."""
    number = F.lit(0)
    for edge in edges:
        number = number + F.when(value >= edge, 1).otherwise(0)
    return F.when(value.isNotNull(), number)
