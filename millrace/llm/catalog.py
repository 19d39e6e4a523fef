"""The queries of this package and, where SQL can express them, their checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans.catalog import Query
from ..sources.files import read_table

LLM: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        LLM[name] = Query(build, sql)
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", spread=True)


def load() -> dict[str, Query]:
    """Import the modules that register queries, once."""
    from . import q_layout, q_pages, q_texts, q_vectors, q_words  # noqa: F401

    return LLM
