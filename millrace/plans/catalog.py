"""The catalogue: every operator as a query over the given tables, with its check in SQL.

A query is registered under a name with the function that builds it and, where SQL can express
it, the statement that computes the same rows independently.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..sources.files import read_table


@dataclass(frozen=True)
class Query:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register the decorated function as a query."""

    def register(build: Callable[[SparkSession, str], DataFrame]):
        CATALOG[name] = Query(build, sql)
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet", spread)


def load() -> dict[str, Query]:
    """Import the modules that register queries, once."""
    from . import q_chat, q_models, q_news, q_similarity, q_sources, q_tables, q_text, q_windows  # noqa: F401

    return CATALOG
