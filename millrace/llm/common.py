"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path


def settle(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back.

    Cuts the lineage in a way that survives lost executors, and lets later joins see real sizes.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def constant(value, type_name: str) -> Column:
    """A nested constant as one expression, whatever its length."""
    return F.from_json(F.lit(json.dumps(value)), type_name)


def empty(spark: SparkSession, schema: str) -> DataFrame:
    return spark.createDataFrame([], T._parse_datatype_string(schema))


def unit_draw(*parts: Column | str) -> Column:
    """A number in (0, 1) from the MD5 of the parts, the same in any engine."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
