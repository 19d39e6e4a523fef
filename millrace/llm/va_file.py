"""Exact top-k inner products with a vector-approximation file.

The file holds for every vector the cell of each component, one byte, in a grid over the whole table: cells of equal
depth, and beyond them cells that grow outwards, so that a few far components widen no cell but their own. Cells alone bound an inner product from both sides. A search scans the cells, keeps what the bounds
cannot rule out, and reads exact vectors from the highest bound downwards until the k-th result is
certain.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

#: Cells of equal depth, and growing cells on either side of them: 256 fit into a byte.
INNER, OUTER = 192, 32
#: Vectors that the inner cells are fitted on at most, those whose classes have the smallest hashes; every vector gets its cells.
SAMPLE = 20_000
#: Share of the components at either end that the growing cells are for.
TAIL = 0.005
#: Share of a bound's largest terms by which it is widened for rounding.
ROUNDING = 1e-12
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 32_768
#: Queries whose bounds are held at once against a block of candidates.
QUERY_CHUNK = 64


def whole_vector(v: Column) -> Column:
    """Whether a vector takes part: not NULL, and every component is a finite number."""
    return F.coalesce(
        v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))),
        F.lit(False),
    )


def _matrix(column: pa.Array, kind) -> np.ndarray:
    """Equally long lists as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(column), -1)


def _ranges(batches):
    """Least and largest value of each component, of what one task reads."""
    low: dict[int, np.ndarray] = {}
    high: dict[int, np.ndarray] = {}
    for batch in batches:
        sizes = batch.column("dim").to_numpy()
        for dim in np.unique(sizes):
            v = _matrix(batch.column("v").filter(pa.array(sizes == dim)), np.int64)
            low[dim] = np.minimum(low[dim], v.min(axis=0)) if dim in low else v.min(axis=0)
            high[dim] = np.maximum(high[dim], v.max(axis=0)) if dim in high else v.max(axis=0)
    for dim in low:
        yield pa.RecordBatch.from_pydict({
            "dim": np.full(dim, dim, np.int32), "j": np.arange(dim, dtype=np.int32), "low": low[dim], "high": high[dim],
        })


def cell_edges(sample: np.ndarray, low: int, high: int) -> np.ndarray:
    """Lower edges of the cells of one component, and last the number after ``high``: 256 cells at most, from ``low`` to ``high``."""
    inner = np.unique(np.quantile(sample, np.linspace(TAIL, 1 - TAIL, INNER), method="lower").astype(np.int64)) if len(sample) else np.array([low])
    first, last = int(inner[0]), int(inner[-1])
    step = max(1, (last - first) // OUTER)
    grown = [step * ((1 << k) - 1) for k in range(1, OUTER)]
    inside = {int(e) for e in inner} | {last + 1}
    edges = sorted(inside | {low} | {first - g for g in grown} | {last + 1 + g for g in grown})
    return np.array([e for e in edges if low <= e <= high] + [high + 1], object)


def _grid(classes: DataFrame) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors the lower and the upper end of every cell, a row per component; unused cells are empty."""
    ranges = classes.select("dim", "v").mapInArrow(_ranges, "dim int, j int, low bigint, high bigint")
    rows = ranges.groupBy("dim", "j").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("dim", "j")
    some = classes.orderBy(F.xxhash64("class"), "class").limit(SAMPLE).select("dim", "v").toPandas()  # at most SAMPLE rows
    grid = {}
    for dim, part in rows.toPandas().groupby("dim"):  # as many rows as components
        mine = some.loc[some["dim"] == dim, "v"]
        sample = np.vstack(mine.to_numpy()).astype(np.int64) if len(mine) else np.zeros((0, dim), np.int64)
        lower, upper = (np.full((int(dim), 256), np.iinfo(np.int64).max, np.int64) for _ in range(2))
        for j, (low, high) in enumerate(zip(part["low"].tolist(), part["high"].tolist())):
            edges = cell_edges(sample[:, j], low, high)
            n = len(edges) - 1
            lower[j, :n], upper[j, :n] = edges[:-1].astype(np.int64), (edges[1:] - 1).astype(np.int64)
        grid[int(dim)] = lower, upper
    return grid


def _approximate(classes: DataFrame, grid) -> DataFrame:
    def cells(batches):
        for batch in batches:
            sizes = batch.column("dim").to_numpy()
            out: list[bytes] = [b""] * len(sizes)
            for dim in np.unique(sizes[sizes > 0]):
                at = np.flatnonzero(sizes == dim)
                lower, upper = grid[int(dim)]
                v = _matrix(batch.column("v").take(pa.array(at)), np.int64)
                found = np.empty(v.shape, np.uint8)
                for j in range(int(dim)):
                    # the first cell whose upper end is not below the component
                    found[:, j] = np.searchsorted(upper[j], v[:, j], "left")
                for i, row in zip(at, found):
                    out[i] = row.tobytes()
            yield pa.RecordBatch.from_pydict({
                "class": batch.column("class"), "dim": batch.column("dim"), "cells": pa.array(out, pa.binary()),
            })

    return classes.mapInArrow(cells, "class string, dim int, cells binary")


def _bounds(query: np.ndarray, lower: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product of each query with any vector between two corners."""
    plus, minus = np.maximum(query, 0), np.minimum(query, 0)
    slack = np.abs(query) @ np.maximum(np.abs(lower), np.abs(upper)).T * ROUNDING
    return plus @ lower.T + minus @ upper.T - slack, plus @ upper.T + minus @ lower.T + slack


def _scanner(grid, k: int):
    def scan(key, queries, candidates):
        empty = pd.DataFrame({"query": [], "class": [], "low": [], "high": []}).astype({"query": str, "class": str})
        if not len(queries) or not len(candidates):
            return empty
        dim = int(key[0])
        vectors = np.vstack(queries["v"].to_numpy()).astype(np.float64).reshape(len(queries), dim)
        names = candidates["class"].to_numpy()
        if dim:
            cells = np.frombuffer(b"".join(candidates["cells"]), np.uint8).reshape(-1, dim)
            components = np.arange(dim)
            lower, upper = (ends[components, cells].astype(np.float64) for ends in grid[dim])
        else:
            lower = upper = np.zeros((len(names), 0))
        found = []
        for start in range(0, len(vectors), QUERY_CHUNK):
            least, most = _bounds(vectors[start : start + QUERY_CHUNK], lower, upper)
            if len(names) > k:
                certain = np.partition(least, -k, axis=1)[:, -k][:, None]
                q, c = np.nonzero(most >= certain)
            else:
                q, c = np.indices(most.shape).reshape(2, -1)
            found.append(pd.DataFrame({
                "query": queries["class"].to_numpy()[start + q], "class": names[c], "low": least[q, c], "high": most[q, c],
            }))
        return pd.concat(found)

    return scan


def _exact(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs with the exact inner product of their two vectors."""
    q = classes.select(F.col("class").alias("query"), F.col("v").alias("_q"))
    terms = F.arrays_zip(F.col("_q").alias("x"), F.col("v").alias("y"))

    def summed(kind: str) -> Column:
        return F.aggregate(
            terms, F.lit(0).cast(kind), lambda s, t: F.try_add(s, F.try_multiply(t["x"].cast(kind), t["y"].cast(kind))).cast(kind)
        )

    # 64 bits where they do, then more, cut off at the ends of 64 bits
    most, least = F.lit((1 << 63) - 1), F.lit(-(1 << 63))
    rough = F.aggregate(terms, F.lit(0.0), lambda s, t: s + t["x"].cast("double") * t["y"].cast("double"))
    wide = summed("decimal(38,0)")
    cut = F.when(wide > most, most).when(wide < least, least).otherwise(wide.cast("bigint"))
    product = F.coalesce(summed("bigint"), F.when(wide.isNotNull(), cut), F.when(rough > 0, most).otherwise(least))
    return pairs.join(classes.select("class", "v"), "class").join(q, "query").select("query", "class", product.alias("score"))


def top_k(rows: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k largest inner products of every query.

    ``rows`` has vec_id (long) and v (array of bigint); rows where either is NULL take no part. A query
    is a row for which ``is_query`` holds; its candidates are all rows but itself of the same number of
    components, ties going to the smaller vec_id. Equal rows count once; rows that share a vec_id
    but differ are different rows. Fewer candidates than k give fewer ranks; no rows give none. A score
    beyond 64 bits is the largest or smallest 64-bit number. Bounds are widened for rounding, so results are exact at any size.

    Equal vectors are one class, searched for and found once; of a class only the k + 1 smallest ids can
    be among a result. Queries and classes meet in blocks of bounded size, where only cells are moved;
    exact vectors are fetched for what the bounds leave, in two reads: the k + 1 with the highest bound, then
    those whose bound reaches the k-th score of the first.
    """
    deep = k + 1
    rows = rows.where("vec_id IS NOT NULL AND v IS NOT NULL").select(
        "vec_id", "v", F.md5(F.concat_ws(",", F.col("v").cast("array<string>"))).alias("class"), is_query.alias("is_query")
    )
    rows = settle(rows, "vectors")
    classes = rows.groupBy("class").agg(F.any_value("v").alias("v"), F.max("is_query").alias("asked"))
    classes = settle(classes.withColumn("dim", F.size("v")), "classes")
    asked = classes.where("asked").select("class", "dim", "v")
    n_classes, n_asked = classes.agg(F.count("*"), F.count_if("asked")).first()
    n_q, n_c = max(1, math.ceil(n_asked / QUERY_BLOCK)), max(1, math.ceil(n_classes / CANDIDATE_BLOCK))
    grid = _grid(classes.where("dim > 0").select("class", "dim", "v"))
    file = _approximate(classes.select("class", "dim", "v"), grid)

    def dealt(df: DataFrame, own: str, own_blocks: int, other: str, other_blocks: int) -> DataFrame:
        return df.withColumn(own, F.pmod(F.xxhash64("class"), F.lit(own_blocks))).withColumn(
            other, F.explode(F.sequence(F.lit(0), F.lit(other_blocks - 1)).cast("array<bigint>"))
        )

    blocks = ["dim", "qb", "cb"]
    met = dealt(asked, "qb", n_q, "cb", n_c).groupBy(*blocks).cogroup(dealt(file, "cb", n_c, "qb", n_q).groupBy(*blocks))
    left = met.applyInPandas(_scanner(grid, deep), "query string, class string, low double, high double")
    per_query = Window.partitionBy("query")
    left = (
        left.withColumn("n", F.row_number().over(per_query.orderBy(F.desc("low"))))
        .withColumn("certain", F.max(F.when(F.col("n") == deep, F.col("low"))).over(per_query))
        .where("high >= coalesce(certain, high)")
        .withColumn("n", F.row_number().over(per_query.orderBy(F.desc("high"), "class")))
    )
    left = settle(left.select("query", "class", "high", "n"), "bounded")
    first = settle(_exact(left.where(F.col("n") <= deep).select("query", "class"), classes), "scored")
    kth = first.groupBy("query").agg(F.min("score").alias("kth"))
    more = left.where(F.col("n") > deep).join(kth, "query").where("high >= kth").select("query", "class")
    scored = first.union(_exact(more, classes))

    ids = rows.select("class", "vec_id").distinct()
    ids = ids.withColumn("n", F.row_number().over(Window.partitionBy("class").orderBy("vec_id")))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "class")
    found = (
        scored.join(ids.where(F.col("n") <= deep).drop("n"), "class")
        .withColumn("n", F.row_number().over(best))
        .where(F.col("n") <= deep)
    )
    queries = rows.where("is_query").select(F.col("class").alias("query"), F.col("vec_id").alias("query_id")).distinct()
    rank = Window.partitionBy("query_id", "query").orderBy("n")
    return (
        queries.join(found, "query")
        .where("NOT (vec_id = query_id AND class = query)")
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
