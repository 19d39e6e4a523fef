"""Near-duplicates of arriving texts in a corpus that may grow.

The corpus is an index in the shared folder, made of segments. A segment holds the distinct token sets of the texts that were added together
and their band keys, each in folders by a hash of the id or key. A lookup reads the folders of its own keys only, and then those of
the sets it has to compare, so a small batch reads little however large the corpus is. Adding texts writes a segment and then a new
version of the list of segments; what is not on the list does not exist, so an addition that is run again, or broke
off, changes nothing twice. ``compact`` puts all segments into one. Nothing is kept between batches.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.buckets import BUCKET_ROWS, large_buckets
from ..operators.minhash import KEYS, SKETCH, band_keys, candidates, choose_bands
from ..operators.token_sets import SetsOf, distinct_sets, fingerprint, near_pairs, token_sets
from ..session import settle

#: Folders of a segment. More of them let a lookup read less, and cost files.
PARTS = 64


def _part(key: str, parts: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(parts)).cast("int")


def build_index(
    corpus: DataFrame,
    id_col: str,
    text_col: str,
    distance: float,
    path: str,
    shape: tuple[int, int] | None = None,
    sets_of: SetsOf = token_sets,
    parts: int = PARTS,
) -> tuple[int, int]:
    """Make the index of a corpus below ``path``; returns (bands, rows) used.

    ``sets_of`` makes the sets, so that stop words, say, are left out; lookups are given the same. An
    index that stands there is replaced, in a new version. The corpus may be empty and grow later.
    """
    shape = shape or choose_bands(distance)
    index = Index(corpus.sparkSession, path, shape, sets_of=sets_of, parts=parts, id_type=dict(corpus.dtypes)[id_col])
    name = f"first-{uuid.uuid4().hex}"
    index._write(distinct_sets(sets_of(corpus, id_col, text_col)), name)
    index._commit([name])
    return shape


class Index:
    """A written index, for lookups and additions. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str, shape: tuple[int, int], bucket_rows: int = BUCKET_ROWS,
                 sets_of: SetsOf = token_sets, parts: int = PARTS, id_type: str = "bigint"):
        self.spark, self.path, self.shape, self.sets_of = spark, path, shape, sets_of
        self.bucket_rows, self.parts, self.id_type = bucket_rows, parts, id_type

    def _versions(self) -> DataFrame:
        return self.spark.read.schema("version bigint, segment string").parquet(f"{self.path}/versions")

    def _last(self) -> tuple[int, list[str]]:
        """The newest version and its segments."""
        try:
            rows = self._versions().collect()  # a row per segment and version
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0, []  # no version yet
        last = max((r["version"] for r in rows), default=0)
        return last, sorted(r["segment"] for r in rows if r["version"] == last)

    def segments(self) -> list[str]:
        return self._last()[1]

    def _commit(self, segments: list[str]) -> None:
        version = self._last()[0] + 1
        rows = self.spark.createDataFrame([(version, s) for s in segments], "version bigint, segment string")
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/versions")

    def _write(self, sets: DataFrame, name: str) -> None:
        """Write a segment from distinct sets (id, tokens, copies), in place of one that was broken off."""
        placed = sets.select("id", "tokens", "copies", fingerprint(F.col("tokens")).alias("print"), _part("id", self.parts).alias("part"))
        place = f"segment={name}"
        # each task writes its rows of every folder; to bring a folder into one task would send all rows once more
        placed.sortWithinPartitions("part", "id").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/sets/{place}")
        keys = band_keys(self.sets([name]), *self.shape).withColumn("part", _part("key", self.parts))
        keys.sortWithinPartitions("part", "key").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/keys/{place}")

    def _read(self, table: str, schema: str, segments: list[str]) -> DataFrame:
        schema = f"{schema}, segment string, part int"
        if not segments:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/{table}"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/segment={s}" for s in segments])

    def sets(self, segments: list[str]) -> DataFrame:
        """(id, tokens, copies, print, segment, part) of some segments; a filter on ``part`` chooses folders."""
        return self._read("sets", f"id {self.id_type}, tokens array<string>, copies bigint, print string", segments)

    def keys(self, segments: list[str]) -> DataFrame:
        """(band, key, id, size, s0 ... s3, segment, part) of some segments."""
        sketch = ", ".join(f"s{i} bigint" for i in range(SKETCH))
        return self._read("keys", f"band int, key bigint, id {self.id_type}, size int, {sketch}", segments)

    def add(self, texts: DataFrame, id_col: str, text_col: str, name: str) -> None:
        """Add texts as the segment ``name``. A name that is already there adds nothing, so a repeated batch is harmless. Ids are unique over all texts."""
        segments = self.segments()
        if name not in segments:
            self._write(distinct_sets(self.sets_of(texts, id_col, text_col)), name)
            self._commit([*segments, name])

    def compact(self) -> None:
        """Put all segments into one, equal sets of different segments under their smallest id. Old segments stay on the disk for readers that know them."""
        sets = self.sets(self.segments())
        whole = sets.groupBy("print").agg(F.min_by("tokens", "id").alias("tokens"), F.min("id").alias("id"), F.sum("copies").alias("copies"))
        name = f"whole-{uuid.uuid4().hex}"
        self._write(whole.select("id", "tokens", "copies"), name)
        self._commit([name])

    def touched(self, keys: DataFrame, table: DataFrame, key: str) -> DataFrame:
        """The rows of an index table in the folders that a batch's keys can be in."""
        parts = sorted(r[0] for r in keys.select(_part(key, self.parts)).distinct().collect())  # one small number a folder
        return table.where(F.col("part").isin(parts))

    def lookup(self, texts: DataFrame, id_col: str, text_col: str, distance: float, without: str | None = None) -> DataFrame:
        """Pairs of a set of ``texts`` (a) and a set of the corpus (b) nearer than ``distance``: (id_a, id_b, distance, copies_a, copies_b).

        A set of the corpus counts once, under its smallest id, whatever segments hold it; the segment ``without`` is left out.
        Reads the folders of the texts' keys, then those of the candidates.
        """
        segments = [s for s in self.segments() if s != without]
        sets = settle(distinct_sets(self.sets_of(texts, id_col, text_col)), "batch_sets")
        keys = settle(band_keys(sets, *self.shape), "batch_keys")
        near = self.touched(keys, self.keys(segments), "key").drop("segment", "part")
        found = candidates(keys, near, distance, False, None, large_buckets(near, KEYS, self.bucket_rows))
        found = settle(found, "batch_candidates")
        known = self.touched(found.select(F.col("id_b").alias("id")), self.sets(segments), "id").drop("segment", "part")
        pairs = near_pairs(found, sets, known, distance)
        prints = known.select(F.col("id").alias("id_b"), "print")
        return pairs.join(prints, "id_b").groupBy("id_a", "print", "distance", "copies_a").agg(
            F.min("id_b").alias("id_b"), F.sum("copies_b").alias("copies_b")
        ).select("id_a", "id_b", "distance", "copies_a", "copies_b")


def stream_near_duplicates(
    texts: DataFrame,
    index: Index,
    id_col: str,
    text_col: str,
    distance: float,
    out: str,
    checkpoint: str,
    interval: str | None = None,
    grow: bool = False,
) -> StreamingQuery:
    """Write the pairs of each micro-batch to ``out/batch=<n>``; with ``grow`` the batch is then added to the corpus.

    A batch that is run again after a failure replaces its own folder, does not meet its own segment, and is added once.
    """

    def write_batch(batch: DataFrame, number: int) -> None:
        pairs = index.lookup(batch, id_col, text_col, distance, without=f"batch-{number}")
        pairs.write.mode("overwrite").parquet(f"{out}/batch={number}")
        if grow:
            index.add(batch, id_col, text_col, f"batch-{number}")

    return _start(texts, write_batch, checkpoint, interval)


def stream_corpus(texts: DataFrame, index: Index, id_col: str, text_col: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Add each micro-batch of arriving texts to the corpus."""
    return _start(texts, lambda batch, number: index.add(batch, id_col, text_col, f"batch-{number}"), checkpoint, interval)


def _start(texts: DataFrame, work, checkpoint: str, interval: str | None) -> StreamingQuery:
    writer = texts.writeStream.option("checkpointLocation", checkpoint).foreachBatch(work)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
