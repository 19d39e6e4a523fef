"""Near-duplicate documents: universal hash minima, banding, verification, star components."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom_cascade import screen
from .common import settle
from .components import components, partial
from .words import SPACED, Words, chunks, mix, shingles

#: Bands and minima in each: a pair at similarity 0.8 meets in no band with probability 3e-6.
BANDS, ROWS = 32, 5
#: Standard deviations that a signature's estimate may stay below the threshold.
SLACK = 5.0
#: Rows of a bucket from which its pairs are sought in blocks, and rows of a block.
LARGE, BLOCK = 8, 1024
#: Bytes of the filter that spares texts without candidates a shuffle.
SCREEN_BYTES = 4 << 20


def _coefficients(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(seed)
    high = np.iinfo(np.uint64).max
    return random.integers(1, high, n, np.uint64) | np.uint64(1), random.integers(0, high, n, np.uint64)


def _each_set(batch: pa.RecordBatch, size: int):
    """For every run of texts: first row, shingle hashes, bounds, and the distinct ones of each text."""
    for first, _, data, offsets in chunks(batch.column("text")):
        found, bounds = shingles(Words(data, offsets, SPACED), size)
        yield first, found, bounds, [np.unique(found[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]


def _signer(size: int, bands: int, rows: int):
    a, b = _coefficients(bands * rows)
    weights = mix(np.arange(1, rows + 1, dtype=np.uint64))
    salt = mix(np.arange(1000, 1000 + bands, dtype=np.uint64))
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()),
        ("bands", pa.list_(pa.int64())), ("signature", pa.binary()),
    ])

    def sign(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for first, found, bounds, sets in _each_set(batch, size):
                counts = np.array([len(s) for s in sets], np.int64)
                s1 = np.array([mix(s).sum(dtype=np.uint64) for s in sets], np.uint64)
                s2 = np.array([mix(~s).sum(dtype=np.uint64) for s in sets], np.uint64)
                full = np.flatnonzero(counts)
                minima = np.zeros((bands * rows, len(sets)), np.uint64)
                if len(full):
                    x = found >> np.uint64(32)
                    buffer = np.empty_like(x)
                    for i in range(bands * rows):
                        np.multiply(x, a[i], out=buffer)
                        np.add(buffer, b[i], out=buffer)
                        minima[i, full] = np.minimum.reduceat(buffer, bounds[full])
                minima >>= np.uint64(32)
                keys = mix((minima.reshape(bands, rows, -1) * weights[None, :, None]).sum(axis=1, dtype=np.uint64) + salt[:, None])
                signature = np.ascontiguousarray(minima.T.astype(np.uint8))
                yield pa.RecordBatch.from_arrays([
                    ids.slice(first, len(sets)), pa.array(counts), pa.array(s1.view(np.int64)), pa.array(s2.view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(len(sets) + 1, dtype=np.int32) * bands),
                        pa.array(np.ascontiguousarray(keys.T).view(np.int64).ravel()),
                    ),
                    pa.array([s.tobytes() for s in signature], pa.binary()),
                ], schema=schema)

    return sign


def _set_maker(size: int):
    def sets_of(batches):
        for batch in batches:
            for first, _, _, sets in _each_set(batch, size):
                yield pa.RecordBatch.from_pydict({
                    "doc": batch.column("doc_id").slice(first, len(sets)),
                    "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                })

    return sets_of


def _apart(percent: int):
    """A forest of links between the labels of a bucket's block.

    Rows that bear the most common label are not compared with each other, and a row that got joined is not linked again,
    so there are fewer links than rows.
    """

    def forest(key, rows):
        low, high = int(key[-2]), int(key[-1])
        rows = rows.sort_values("doc", kind="stable")
        docs, block, n = rows["doc"].to_numpy(), rows["block"].to_numpy(), rows["n"].to_numpy()
        _, root = np.unique(rows["label"].to_numpy(), return_inverse=True)
        lengths = np.array([len(s) for s in rows["shingles"]])
        bounds = np.concatenate(([0], np.cumsum(lengths)))
        known, which = np.unique(np.concatenate(rows["shingles"].to_numpy()), return_inverse=True)
        marked = np.zeros(len(known), bool)
        a, b = [], []
        for i in np.flatnonzero(root != np.bincount(root).argmax()):
            other = high if block[i] == low else low
            own = which[bounds[i] : bounds[i + 1]]
            marked[own] = True
            common = np.add.reduceat(marked[which], bounds[:-1])
            marked[own] = False
            near = (100 * common >= percent * (n + n[i] - common)) & (root != root[i]) & (block == other)
            found, at = np.unique(root[near], return_index=True)
            if len(found):
                a.append(np.full(len(found), docs[i]))
                b.append(docs[near][at])
                root[np.isin(root, found)] = root[i]
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a, b))
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return forest


def _alike(least: int):
    """Keeps pairs whose signatures agree in at least that many places."""

    def keep(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            sides = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("sig_a", "sig_b")]
            good = pa.array((sides[0] == sides[1]).sum(axis=1) >= least)
            yield batch.select(["a", "b"]).filter(good)

    return keep


class _Verifier:
    """Tells which candidate pairs really link."""

    def __init__(self, signed: DataFrame, sets: DataFrame, similarity: float, minima: int):
        self.signed = signed
        self.sets, self.similarity = sets, similarity
        deviation = (similarity * (1 - similarity) * minima) ** 0.5
        self.least = max(0, int(similarity * minima - SLACK * deviation))

    def left(self, placed: DataFrame, sizes: DataFrame, tested: DataFrame) -> DataFrame:
        """Links (a, b) that join the labels of each bucket as far as sets allow; ``placed`` has (bucket, doc, label), ``sizes`` (bucket, all)."""
        rows = placed.join(sizes, "bucket")
        few = rows.where(F.col("all") <= LARGE)
        one = few.select("bucket", F.col("doc").alias("a"), F.col("label").alias("_la"))
        two = few.select("bucket", F.col("doc").alias("b"), F.col("label").alias("_lb"))
        met = one.join(two, "bucket").where("_la < _lb").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        small = self.links(settle(met.distinct().join(tested, ["a", "b"], "left_anti"), "tested"))

        many = rows.where(F.col("all") > LARGE).withColumn("blocks", F.ceil(F.col("all") / BLOCK))
        many = many.withColumn("block", F.pmod(F.xxhash64("doc"), "blocks"))
        many = many.withColumn("_other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))).select(
            "bucket", "doc", "label", "block", F.least("block", "_other").alias("_low"), F.greatest("block", "_other").alias("_high")
        )
        sets = self.sets.withColumn("n", F.size("shingles").cast("bigint"))
        found = many.join(sets, "doc").groupBy("bucket", "_low", "_high").applyInPandas(
            _apart(round(self.similarity * 100)), "a bigint, b bigint"
        )
        return small.union(found)

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are similar enough."""
        percent = round(self.similarity * 100)
        a = self.signed.select(F.col("doc_id").alias("a"), F.col("n").alias("n_a"), F.col("signature").alias("sig_a"))
        b = self.signed.select(F.col("doc_id").alias("b"), F.col("n").alias("n_b"), F.col("signature").alias("sig_b"))
        near = (
            pairs.join(a, "a").join(b, "b")
            .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)
            .select("a", "b", "sig_a", "sig_b")
            .mapInArrow(_alike(self.least), "a bigint, b bigint")
        )
        near = settle(near, "alike")
        set_a = self.sets.select(F.col("doc").alias("a"), F.col("shingles").alias("x"))
        set_b = self.sets.select(F.col("doc").alias("b"), F.col("shingles").alias("y"))
        common = F.size(F.array_intersect("x", "y"))
        linked = common * 100 >= (F.size("x") + F.size("y") - common) * percent
        return near.join(set_b, "b").join(set_a, "a").where(linked).select("a", "b").distinct()


def _verifier(docs: DataFrame, able: DataFrame, members: DataFrame, size: int, similarity: float, minima: int) -> _Verifier:
    """Signatures and sets of the documents that share a bucket with another."""
    wanted = settle(members.select(F.col("doc").alias("doc_id")).distinct(), "wanted")
    signed = able.select("doc_id", "n", "signature").join(wanted, "doc_id", "left_semi").distinct()
    passed = screen(wanted.select(F.col("doc_id").alias("key")), max(1, wanted.count()), SCREEN_BYTES).holds(F.col("doc_id"))
    texts = docs.where(passed).join(wanted, "doc_id", "left_semi")
    sets = texts.mapInArrow(_set_maker(size), "doc bigint, shingles array<bigint>")
    return _Verifier(settle(signed, "signatures"), settle(sets, "sets"), similarity, minima)


def near_duplicates(
    docs: DataFrame, size: int = 5, similarity: float = 0.8, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text).

    Words are runs of anything but ASCII white space, A-Z lower-cased; a document's set holds its
    distinct shingles of ``size`` words (the whole sequence where there are fewer words), as 64-bit
    hashes. Documents link when their sets' Jaccard similarity, in whole percent, reaches
    ``similarity``; empty and NULL texts have no shingle and link with nothing, nor do rows without a doc_id.
    ``component_id`` is the smallest doc_id reachable, ``kept`` says that it is the row's own (or that
    doc_id is NULL). A doc_id stands for one document: rows that repeat it share their links. An empty table
    gives no rows; other columns are not looked at.

    Documents with equal sets are one before banding. In every bucket all members are tested against
    the one with the smallest id: by sizes, then signatures (a pair at the threshold falls short with probability below
    1e-6), then the full sets. In buckets that this leaves in parts, the parts are compared by full sets, in blocks of
    bounded size. Members already joined are not compared, and a block hands on a forest of links, never all its pairs.
    """
    docs = docs.select("doc_id", "text")
    signed = docs.mapInArrow(
        _signer(size, bands, rows), "doc_id bigint, n bigint, s1 bigint, s2 bigint, bands array<bigint>, signature binary"
    )
    signed = settle(signed, "signed")
    key = ["n", "s1", "s2"]
    able = signed.where("n > 0 AND doc_id IS NOT NULL")
    classes = settle(able.groupBy(*key).agg(F.min("doc_id").alias("doc_id")), "classes")
    heads = able.select(*key, "doc_id", "bands").join(classes, [*key, "doc_id"], "left_semi")
    banded = settle(heads.select("doc_id", "bands"), "heads").select(F.explode("bands").alias("bucket"), F.col("doc_id").alias("doc"))
    ends = banded.groupBy("bucket").agg(F.min("doc").alias("leader"), F.max("doc").alias("_last"))
    members = settle(banded.join(ends.where("leader < _last").drop("_last"), "bucket").distinct(), "members")
    verifier = _verifier(docs, able, members, size, similarity, bands * rows)

    tested = settle(members.where("doc <> leader").select(F.col("leader").alias("a"), F.col("doc").alias("b")).distinct(), "tested")
    links = settle(verifier.links(tested), "links")
    placed = members.join(partial(links).withColumnRenamed("node", "doc"), "doc", "left")
    placed = settle(placed.select("bucket", "doc", F.coalesce("label", "doc").alias("label")), "members")
    sizes = placed.groupBy("bucket").agg(F.count("*").alias("all"), F.min("label").alias("_first"), F.max("label").alias("_last"))
    sizes = sizes.where("_first < _last").select("bucket", "all")
    links = links.union(settle(verifier.left(placed, sizes, tested), "links"))

    joined = components(links).withColumnRenamed("node", "doc_id")
    whole = classes.join(joined, "doc_id", "left").select(*key, F.coalesce("component", "doc_id").alias("component_id"))
    placed = able.select("doc_id", *key).join(whole, key)
    rest = signed.where("n = 0 OR doc_id IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return placed.select("doc_id", "n", "component_id").union(rest).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )
