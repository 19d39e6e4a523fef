"""A stored table with keys: an upsert rewrites only the folders that hold keys of the updates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle
from .tables import upsert_rows

#: Folders of a table. More of them let an upsert rewrite less.
PARTS = 64


class KeyedTable:
    """Rows in folders by a hash of their keys; a list of versions tells which version holds each folder.

    An upsert writes new folders and then a new version of the list, so a reader sees all of it or nothing, what broke off is never
    listed, and files of other folders stay as they are. The same upsert again gives the same rows. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], parts: int = PARTS):
        self.spark, self.path, self.schema, self.keys, self.parts = spark, path, schema, list(keys), parts

    def _last(self) -> tuple[int, dict[int, int]]:
        """The newest version, and the version that holds each folder with rows: at most a number for each folder."""
        try:
            listed = self.spark.read.schema("version bigint, part int, holder bigint").parquet(f"{self.path}/versions")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, {}
        last = listed.agg(F.max("version")).first()[0] or 0
        rows = listed.where(F.col("version") == last).collect()
        return last, {r["part"]: r["holder"] for r in rows if r["part"] >= 0}

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*self.schema.names, F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int").alias("_part"))

    def _found(self, placed: DataFrame) -> list[int]:
        return sorted(r["_part"] for r in placed.select("_part").distinct().collect())  # at most the number of folders

    def _write(self, placed: DataFrame, version: int, held: dict[int, int]) -> None:
        """Write folders as a version and list it; ``held`` are the folders that stay."""
        placed.repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{self.path}/rows/version={version}")
        written = self._folders(version)
        rows = [(version, p, h) for p, h in {**held, **dict.fromkeys(written, version)}.items()] or [(version, -1, version)]
        self.spark.createDataFrame(rows, "version bigint, part int, holder bigint").coalesce(1).write.mode("append").parquet(f"{self.path}/versions")

    def _folders(self, version: int) -> list[int]:
        """Folders that a version wrote."""
        back = self.spark.read.schema(T.StructType([*self.schema, T.StructField("_part", T.IntegerType())])).parquet(f"{self.path}/rows/version={version}")
        return self._found(back)

    def create(self, rows: DataFrame) -> None:
        """Write the table; one that stands there is replaced in a new version. Keys are not repeated."""
        self._write(self._placed(rows), self._last()[0] + 1, {})

    def _read(self, held: dict[int, int]) -> DataFrame:
        if not held:
            return self.spark.createDataFrame([], self.schema)
        base = f"{self.path}/rows"
        paths = [f"{base}/version={holder}/_part={part}" for part, holder in sorted(held.items())]
        return self.spark.read.schema(self.schema).option("basePath", base).parquet(*paths).select(*self.schema.names)

    def read(self) -> DataFrame:
        return self._read(self._last()[1])

    def upsert(self, updates: DataFrame, latest: str | None = None) -> None:
        """Put the updates in place of the rows with their keys, or beside them; ``latest`` as in ``upsert_rows``."""
        version, held = self._last()
        # against no rows: the updates themselves, each key once
        changed = settle(self._placed(upsert_rows(self._read({}), updates, self.keys, latest)), "updates")
        touched = self._found(changed)
        before = self._read({p: h for p, h in held.items() if p in touched})
        after = upsert_rows(before, changed.drop("_part"), self.keys)
        self._write(self._placed(after), version + 1, {p: h for p, h in held.items() if p not in touched})
