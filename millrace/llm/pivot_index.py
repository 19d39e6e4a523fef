"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its nearest reference points (pivots) in order. Every vector stands in the
inverted lists of its nearest pivots; two vectors that share a list and enough described pivots are
compared exactly.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settle
from .components import components
from .va_file import whole_vector

#: Nearest pivots in whose lists a vector stands.
LISTS = 5
#: Nearest pivots that describe a vector, and how many of them two candidates must share.
DESCRIBED, SHARED = 8, 2
#: Cosine from which two pivots are too close to stand side by side.
PIVOT_COSINE = 0.8
#: Rows of a list that are compared in one piece; larger lists are cut.
LIST_BLOCK = 1024
#: Bytes of the vectors of such a piece, and rows of it that are compared with the others at once.
BLOCK_BYTES, TILE = 8 << 20, 64
#: Cosines that are nearer to the threshold are computed again, pair by pair.
ROUNDING = 1e-9


def pivots_for(n: int) -> int:
    """Reference points for n vectors, so that lists grow with the root of n only."""
    return max(16, math.ceil(2 * math.sqrt(n)))


def _sample(rows: DataFrame, size: int, wanted: int) -> DataFrame:
    """(v): the ``wanted`` rows of the smallest hashes of ``class``, in their order, of ``size`` rows.

    Rows far above the hash that is expected last are left out before any are sent, so no task sees more than some twice as many as wanted.
    """
    draw = F.xxhash64("class")
    share = (2 * wanted + 200) / max(size, 1)
    if share < 1:
        few = rows.where(draw < F.lit(int(share * 2**64) - 2**63))
        if few.count() >= wanted:
            rows = few
    return rows.orderBy(draw).limit(wanted).select("v")


def _spread(points: np.ndarray) -> np.ndarray:
    """Unit vectors of the points, without those close to an earlier one.

    Pivots drawn from one dense group would all be nearest to its vectors, in an order that noise decides.
    """
    points = points / np.linalg.norm(points, axis=1)[:, None]
    kept = [0]
    for i in range(1, len(points)):
        if (points[kept] @ points[i]).max() < PIVOT_COSINE:
            kept.append(i)
    return points[kept]


def _describe(pivots: dict[int, np.ndarray]):
    """Adds the nearest pivots, in order, to each vector of unit length."""

    def describe(frames):
        for frame in frames:
            for dim, part in frame.groupby("dim"):
                v = np.vstack(part["v"].to_numpy()).astype(np.float64)
                points = pivots[int(dim)]
                take = min(DESCRIBED, len(points))
                near = v @ points.T / np.linalg.norm(v, axis=1)[:, None]
                order = np.argpartition(-near, take - 1, axis=1)[:, :take]
                order = np.take_along_axis(order, np.argsort(-np.take_along_axis(near, order, 1), axis=1, kind="stable"), 1)
                yield part.assign(near=list(order.astype(np.int32)))

    return describe


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of each one's connected part."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(threshold: float, lists: int, shared: int):
    """Links within one piece of a list: sums for each vector, and a forest that joins what is linked."""

    def compare(key, part):
        pivot, left_block, right_block = int(key[-3]), int(key[-2]), int(key[-1])
        part = part.sort_values("rep", kind="stable")
        v = np.vstack(part["v"].to_numpy()).astype(np.float64)
        v /= np.linalg.norm(v, axis=1)[:, None]
        near = np.vstack(part["near"].to_numpy())
        block, copies = part["block"].to_numpy(), part["copies"].to_numpy()
        used, where = np.unique(near, return_inverse=True)
        marks = np.zeros((len(part), len(used)), np.float32)
        np.put_along_axis(marks, where.reshape(near.shape), 1, axis=1)
        left = np.flatnonzero(block == left_block)
        right = np.flatnonzero(block == right_block)
        own, everyone = near[:, :lists], np.arange(len(part))
        links, root = np.zeros(len(part), np.int64), np.arange(len(part))
        for start in range(0, len(left), TILE):
            rows = left[start : start + TILE]
            cosine = v[rows] @ v[right].T
            a, b = np.nonzero((marks[rows] @ marks[right].T >= min(shared, near.shape[1])) & (cosine >= threshold - ROUNDING))
            unsure = cosine[a, b] < threshold + ROUNDING
            a, b = rows[a], right[b]
            good = np.ones(len(a), bool)
            good[unsure] = np.einsum("ij,ij->i", v[a[unsure]], v[b[unsure]]) >= threshold
            if left_block == right_block:
                good &= a < b
            a, b = a[good], b[good]
            # a pair that meets in several lists counts in that of its smallest common pivot
            common = np.full(len(a), np.iinfo(np.int32).max)
            for i in range(own.shape[1]):
                both = (own[a, i][:, None] == own[b]).any(axis=1)
                common = np.where(both, np.minimum(common, own[a, i]), common)
            mine = common == pivot
            a, b = a[mine], b[mine]
            np.add.at(links, a, copies[b])
            np.add.at(links, b, copies[a])
            root = _roots(len(part), np.concatenate((a, everyone)), np.concatenate((b, root)))
        rep = part["rep"].to_numpy()
        linked = np.flatnonzero(links)
        return pd.DataFrame({"rep": rep[linked], "links": links[linked], "root": rep[root[linked]]})

    return compare


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.98, lists: int = LISTS, shared: int = SHARED, list_block: int = LIST_BLOCK
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id, embedding, label).

    Rows link when their labels are equal and not NULL and the cosine, in double precision, reaches
    ``threshold``. Vectors that are NULL, empty, zero, or hold a NULL or non-finite component link with
    nothing, nor do vectors of different lengths, nor rows without a vec_id. ``n_links`` counts the other rows
    linked directly, ``component_id`` is the smallest vec_id reachable (a NULL vec_id its own component)
    and ``kept`` says that it is the row's own. Repeated rows are copies of each other: they count as
    links and share a component. A vec_id stands for one vector; rows that repeat it with another one
    share their links. An empty table gives no rows. Other columns are not looked at.

    Equal vectors of a label are folded into one with a count before they are indexed. Pivots are a
    sample of the vectors, twice the root of their number, less those close to another; every vector is indexed, in the lists of its ``lists`` nearest
    pivots. A list of more than ``list_block`` rows, fewer of long vectors, is cut into blocks, each pair of which is a group
    of its own. Links are summed inside the groups and leave them as one row per vector, never as pairs.
    """
    v = F.col("embedding").cast("array<double>")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    rows = vectors.select("vec_id", F.col("label").cast("string").alias("label"), v.alias("v")).where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & whole_vector(F.col("v"))
    )
    rows = rows.where((norm > 0) & (norm < float("inf")))
    rows = settle(rows.withColumn("class", F.md5(F.concat_ws(",", "label", F.col("v").cast("array<string>")))), "vectors")
    folded = rows.groupBy("class").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.any_value("label").alias("label"), F.any_value("v").alias("v")
    )
    folded = settle(folded.withColumn("dim", F.size("v")), "folded")
    count = folded.count()
    dims = folded.groupBy("dim").count().collect()  # a few
    pivots = {}
    for r in dims:
        drawn = _sample(folded.where(F.col("dim") == r["dim"]), r["count"], pivots_for(count))
        pivots[r["dim"]] = _spread(np.vstack(drawn.toPandas()["v"].to_numpy()))
    described = folded.select("rep", "copies", "label", "dim", "v").mapInPandas(
        _describe(pivots), "rep bigint, copies bigint, label string, dim int, v array<double>, near array<int>"
    )
    described = settle(described, "described")
    key = ["label", "dim", "pivot"]
    listed = described.withColumn("pivot", F.explode(F.slice("near", 1, lists)))
    most = F.greatest(F.lit(1), F.least(F.lit(list_block), F.floor(F.lit(BLOCK_BYTES) / (8 * F.col("dim")))))
    sizes = listed.groupBy(*key).count().where("count > 1").select(*key, F.ceil(F.col("count") / most).alias("blocks"))
    listed = listed.join(sizes, key).withColumn("block", F.pmod(F.xxhash64("rep"), "blocks"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
    pieces = listed.withColumn("_other", other).select(
        "*", F.least("block", "_other").alias("_low"), F.greatest("block", "_other").alias("_high")
    )
    found = pieces.select(*key, "_low", "_high", "rep", "copies", "v", "near", "block").groupBy(*key, "_low", "_high")
    found = settle(found.applyInPandas(_compare(threshold, lists, shared), "rep bigint, links bigint, root bigint"), "links")
    joined = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = (
        folded.select("class", "rep", "copies")
        .join(links, "rep", "left")
        .join(joined.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "class", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        )
    )
    own = F.md5(F.concat_ws(",", "label", v.cast("array<string>")))
    asked = vectors.select("vec_id", F.when(F.col("label").isNotNull() & F.col("vec_id").isNotNull(), own).alias("class"))
    return asked.join(classes, "class", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("component_id", "vec_id") == F.col("vec_id"), F.lit(True)).alias("kept"),
    )
