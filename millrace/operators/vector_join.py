"""Exact cosine join of vector tables of any and mixed lengths.

Unit vectors nearer than a cosine distance t lie within eps = sqrt(2 t) of each other, and so do
their projections on any unit direction. Space is cut into cells along a few directions; each
vector of one side is put into its own cell, each vector of the other side into every cell its
eps-neighbourhood touches, so a near pair meets exactly once. The directions are those along which the
given vectors spread most, and only those along which they fill several cells: where the distance is large, cutting
would copy rows and part nothing. More projections, on directions at right angles, drop most other pairs inside a cell
before the vectors themselves are compared. Where no direction parts the vectors, blocks of them are multiplied with each other.
Vectors of different lengths never meet.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settle
from .buckets import BUCKET_ROWS, SAMPLE, bucket_join, cut_sides, large_buckets, sampled_large_buckets

#: Directions on which vectors are projected.
PROJECTIONS = 16
#: Cells that a direction must part the vectors into, by four standard deviations, to be worth the copies.
LEAST_CELLS = 2.0
#: Vectors in a block, and bytes of them, at most. Rows of a block that are multiplied at once.
BLOCK_ROWS, BLOCK_BYTES, BLOCK_STEP = 4096, 1 << 25, 256
#: By how much a product may fall short because of rounding.
ROUNDING = 1e-9


def distinct_vectors(df: DataFrame, id_col: str, vector: Column) -> DataFrame:
    """(id, v, copies): one row per different non-zero vector, under its smallest id."""
    rows = df.select(F.col(id_col).alias("id"), vector.cast("array<double>").alias("v"))
    kept = rows.where(F.exists("v", lambda x: x != 0))
    return kept.groupBy("v").agg(F.min("id").alias("id"), F.count("*").alias("copies"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def placed_vectors(vectors: DataFrame, projections: int = PROJECTIONS) -> DataFrame:
    """(id, dim, p0, p1, ...): length and coordinates of the unit vectors along rows of a Walsh matrix.

    Row r has the sign of the parity of the bits that r and the place have in common. Rows are at right angles where the
    length is a power of two; rows that a length does not have count 0.
    """
    size = "sqrt(aggregate(v, 0D, (s, x) -> s + x * x)) * sqrt(cast(size(v) AS DOUBLE))"
    rows = [
        f"if({r} < size(v), aggregate(transform(v, (x, i) -> if(bit_count(i & {r}) % 2 = 0, x, -x)), 0D, (s, x) -> s + x) / ({size}), 0D)"
        for r in range(1, projections + 1)
    ]
    # exploded as one array, so that every product is computed once
    return vectors.select("id", F.size("v").alias("dim"), F.expr(f"explode(array(array({', '.join(rows)})))").alias("p")).select(
        "id", "dim", *[F.col("p")[i].alias(f"p{i}") for i in range(projections)]
    )


def choose_directions(placed: DataFrame, width: float, most: int) -> list[int]:
    """The projections, ``most`` at most, along which the vectors spread over several cells of that width."""
    spread = placed.agg(*[F.stddev_pop(f"p{i}").alias(f"p{i}") for i in range(PROJECTIONS)]).first()
    found = sorted(((spread[f"p{i}"] or 0.0, -i) for i in range(PROJECTIONS)), reverse=True)
    return sorted(-i for s, i in found[:most] if 4 * s >= LEAST_CELLS * width)


def _block_rows(vectors: DataFrame) -> int:
    """Vectors in a block: fewer of long ones, and of small tables, so that all tasks have blocks to compare."""
    rows, widest = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    return max(256, min(BLOCK_ROWS, rows // 16, BLOCK_BYTES // (8 * (widest or 1))))


def _multiplied(distance: float):
    """The pairs of two blocks that are near but for rounding, by products of the unit vectors."""

    def units(v: pd.Series) -> np.ndarray:
        rows = np.array(v.to_list(), dtype=np.float64)
        return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))

    least, step = 1 - distance - ROUNDING, BLOCK_STEP

    def work(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out = [(a["id_a"].iloc[:0], b["id_b"].iloc[:0])]
        if len(a) and len(b):
            with np.errstate(all="ignore"):
                left, right = units(a["v"]), units(b["v"]).T
                for at in range(0, len(a), step):
                    i, j = np.nonzero(left[at : at + step] @ right >= least)
                    out.append((a["id_a"].iloc[at + i], b["id_b"].iloc[j]))
        return pd.DataFrame({"id_a": pd.concat([x for x, _ in out]).to_numpy(), "id_b": pd.concat([y for _, y in out]).to_numpy()})

    return work


def _near_in_blocks(vectors_a: DataFrame, vectors_b: DataFrame, distance: float) -> DataFrame:
    """(id_a, id_b) that may be near: every pair of a length, block by block."""
    spark = vectors_a.sparkSession
    rows = min(_block_rows(vectors_a), _block_rows(vectors_b))
    a, b = (v.where("id IS NOT NULL").select(F.size("v").alias("dim"), F.col("id").alias(f"id_{s}"), "v") for v, s in ((vectors_a, "a"), (vectors_b, "b")))
    parts_a, parts_b = (large_buckets(side, ["dim"], rows) for side in (a, b))
    left, right, keys = cut_sides(a, b, ["dim"], "id_a", "id_b", parts_a, parts_b)
    # numbered parts, as adaptive execution would put small rows with much work together
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    types = ", ".join(f"{c} {t}" for side, c in ((a, "id_a"), (b, "id_b")) for t in [dict(side.dtypes)[c]])
    grouped = (side.repartition(tasks, *keys).groupBy(*keys) for side in (left, right))
    return next(grouped).cogroup(next(grouped)).applyInPandas(_multiplied(distance), types)


def near_vectors(
    df_a: DataFrame,
    df_b: DataFrame,
    id_a: str,
    id_b: str,
    vector_a: Column,
    vector_b: Column,
    dim: int | None,
    distance: float,
    directions: int = 4,
    bucket_rows: int = BUCKET_ROWS,
    sample: float = SAMPLE,
) -> DataFrame:
    """(id_a, id_b, distance, copies_a, copies_b): all pairs of equally long vectors with cosine distance below ``distance``.

    ``dim`` keeps vectors of that length only; None takes all lengths. At most ``directions`` directions cut space, and each vector of the
    second side is copied to at most 2 ** directions cells. Larger tables want more.
    """
    eps = math.sqrt(2 * distance) * (1 + 1e-9) + 1e-9
    width = 2 * eps
    coords = [f"p{i}" for i in range(PROJECTIONS)]

    def vectors_of(df: DataFrame, id_col: str, vector: Column) -> DataFrame:
        found = distinct_vectors(df, id_col, vector)
        return settle(found if dim is None else found.where(F.size("v") == dim), "vectors")

    vectors_a, vectors_b = vectors_of(df_a, id_a, vector_a), vectors_of(df_b, id_b, vector_b)
    chosen = choose_directions(placed_vectors(vectors_b), width, directions)
    if not chosen:
        return _measured(_near_in_blocks(vectors_a, vectors_b, distance), vectors_a, vectors_b, distance)
    cells = [f"c{i}" for i in chosen]
    keys = ["dim", *cells]

    def own_cell(vectors: DataFrame) -> DataFrame:
        return placed_vectors(vectors).select("id", "dim", *coords, *[F.floor(F.col(f"p{i}") / width).alias(f"c{i}") for i in chosen])

    def touched_cells(vectors: DataFrame) -> DataFrame:
        out = placed_vectors(vectors)
        for i in chosen:
            low = F.floor((F.col(f"p{i}") - eps) / width)
            high = F.floor((F.col(f"p{i}") + eps) / width)
            out = out.withColumn(f"c{i}", F.explode(F.sequence(low, high)))
        return out.select("id", *coords, *keys)

    large_a = sampled_large_buckets(vectors_a, own_cell, keys, bucket_rows, sample)
    large_b = sampled_large_buckets(vectors_b, touched_cells, keys, bucket_rows, sample)
    left = own_cell(vectors_a).select(*keys, F.col("id").alias("id_a"), *[F.col(p).alias(f"{p}_a") for p in coords])
    right = touched_cells(vectors_b).select(*keys, F.col("id").alias("id_b"), *[F.col(p).alias(f"{p}_b") for p in coords])

    def apart(names: list[str]) -> str:
        return " + ".join(f"({p}_a - {p}_b) * ({p}_a - {p}_b)" for p in names)

    # a few coordinates first; their squares add up only where rows are at right angles
    square = F.expr(f"{apart(coords[:6])} <= {eps * eps!r}D AND {apart(coords)} <= {eps * eps!r}D")
    each = F.expr(" AND ".join(f"abs({p}_a - {p}_b) <= {eps!r}D" for p in coords))
    close = F.when(F.col("dim").bitwiseAND(F.col("dim") - 1) == 0, square).otherwise(each)
    met = bucket_join(left, right, keys, close, "id_a", "id_b", large_a, large_b)
    return _measured(met, vectors_a, vectors_b, distance)


def _measured(met: DataFrame, vectors_a: DataFrame, vectors_b: DataFrame, distance: float) -> DataFrame:
    """The pairs of ``met`` nearer than the distance, by their vectors."""
    a = vectors_a.select(F.col("id").alias("id_a"), F.col("v").alias("va"), F.col("copies").alias("copies_a"))
    b = vectors_b.select(F.col("id").alias("id_b"), F.col("v").alias("vb"), F.col("copies").alias("copies_b"))
    both = met.select("id_a", "id_b").join(a, "id_a").join(b, "id_b")
    norms = F.sqrt(_dot(F.col("va"), F.col("va"))) * F.sqrt(_dot(F.col("vb"), F.col("vb")))
    measured = both.withColumn("exact", 1 - _dot(F.col("va"), F.col("vb")) / norms)
    return measured.where(F.col("exact") < distance).select(
        "id_a", "id_b", F.round("exact", 6).alias("distance"), "copies_a", "copies_b"
    )
