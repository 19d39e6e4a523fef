"""Table maintenance and summaries."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A table of rows written in the program. Made from Arrow, so that its size is known to the
    planner."""
    named = [dict(zip(schema.names, row)) for row in rows]
    return spark.createDataFrame(pa.Table.from_pylist(named, to_arrow_schema(schema)), schema)


def add_constant(df: DataFrame, name: str, value: object) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Register a temporary view and return its scan."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def append_rows(base: DataFrame, extra: DataFrame) -> DataFrame:
    """All rows of both tables, columns matched by name."""
    return base.unionByName(extra.select(*base.columns))


def upsert_rows(base: DataFrame, updates: DataFrame, keys: Sequence[str], latest: str | None = None) -> DataFrame:
    """The updates, and the base rows whose key they do not hold.

    Of updates that repeat a key the one with the largest ``latest`` counts; without that column
    repeated keys are an error, as they would leave two rows for a key.
    """
    if latest:
        last = Window.partitionBy(*keys).orderBy(F.desc_nulls_last(latest))
        updates = updates.withColumn("__n", F.row_number().over(last)).where("__n = 1").drop("__n")
    elif not updates.groupBy(*keys).count().where("count > 1").isEmpty():
        raise ValueError(f"updates repeat keys in {list(keys)}: name the column that tells the latest")
    kept = base.join(updates.select(*keys).distinct(), list(keys), "left_anti")
    return kept.select(*base.columns).unionByName(updates.select(*base.columns))


def describe_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum and maximum per numeric column, in one pass."""
    stats = {"cnt": F.count, "mean": F.mean, "stddev": F.stddev_samp, "min": F.min, "max": F.max}

    def summary(column: str):
        return F.struct(
            F.lit(column).alias("col_name"),
            *[
                (fn(column) if label == "cnt" else fn(F.col(column).cast("double"))).alias(label)
                for label, fn in stats.items()
            ],
        )

    row = df.agg(F.array(*[summary(c) for c in columns]).alias("s"))
    return row.select(F.inline("s"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def arrange(df: DataFrame, symbol: Sequence[str], order: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows brought together by symbol and sorted by (symbol, order) inside each partition.

    Range partitioning keeps a symbol's rows side by side and lets a very large symbol run over
    several partitions in order.
    """
    by = [F.col(c) for c in [*symbol, *order]]
    spread = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return spread.sortWithinPartitions(*by)


def preview(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    """The first ``n`` rows in order, kept per task before they meet."""
    return df.orderBy(*order).limit(n)
