"""MinHash signatures and the banded similarity join.

A token is hashed once; hash i of a set is the smallest (a_i * h + b_i) mod p over its tokens.
Signatures are one aggregate of native minimums, combined before the shuffle. Sets that agree in
all rows of a band are candidates unless their sizes or 256-bit sketches rule the pair out, and
every candidate is checked on its tokens, so a result is never wrong; a pair at the threshold is missed with the probability ``miss_rate`` gives.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import exploded
from .buckets import BUCKET_ROWS, SAMPLE, bucket_join, sampled_large_buckets
from .token_sets import SetsOf, difference_bound, distinct_sets, near_pairs, set_size, size_bound, token_sets

PRIME = (1 << 31) - 1
SEED = 7
HASHES = 64
SKETCH = 4
KEYS = ["band", "key"]


def coefficients(n: int, seed: int = SEED) -> list[tuple[int, int]]:
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(n)]


def miss_rate(distance: float, bands: int, rows: int) -> float:
    """Chance that a pair exactly at the distance shares no band."""
    return (1 - (1 - distance) ** rows) ** bands


def choose_bands(distance: float, miss: float = 0.001, hashes: int = HASHES) -> tuple[int, int]:
    """(bands, rows per band) that keep the miss rate: the longest bands that ``hashes`` hashes allow.

    Single-row bands put all sets with one common token together, so bands have two rows at least;
    where those need more hashes, they get them.
    """

    def bands(rows: int) -> int:
        return max(1, math.ceil(math.log(miss) / math.log(1 - (1 - distance) ** rows)))

    fitting = [rows for rows in range(2, 13) if bands(rows) * rows <= hashes]
    rows = max(fitting, default=2)
    return bands(rows), rows


def token_hash(token: Column) -> Column:
    """A number below the prime, from the first 32 bits of the token's MD5 digest."""
    return F.pmod(F.conv(F.substring(F.md5(token), 1, 8), 16, 10).cast("long"), F.lit(PRIME))


def _sketch_columns() -> list[Column]:
    """Parity bits: every token flips one of 256 bits. Two sets differ in at least as many tokens
    as bits of their sketches differ."""
    return [
        F.expr(f"bit_xor(if((h >> 6) % {SKETCH} = {i}, shiftleft(1L, cast(h % 64 AS INT)), 0L)) AS s{i}")
        for i in range(SKETCH)
    ]


def signatures(sets: DataFrame, n: int, seed: int = SEED, sketch: bool = False) -> DataFrame:
    """(id, size, m0 ... m(n-1)) of non-empty sets of (id, tokens), with the sketch if wanted."""
    sized = sets.select("id", set_size().alias("size"), "tokens")
    hashed = exploded(sized, F.col("tokens"), "token", "id", "size").select(
        "id", "size", token_hash(F.col("token")).alias("h")
    )
    # written as SQL text: dozens of columns are built much faster from it than call by call
    smallest = [
        F.expr(f"min(({a} * h + {b}) % {PRIME}) AS m{i}") for i, (a, b) in enumerate(coefficients(n, seed))
    ]
    return hashed.groupBy("id", "size").agg(*smallest, *(_sketch_columns() if sketch else []))


def band_keys(sets: DataFrame, bands: int, rows: int, seed: int = SEED) -> DataFrame:
    """(band, key, id, size, s0 ... s3): one bucket row per set and band, with the set's sketch."""
    signed = signatures(sets, bands * rows, seed, sketch=True)
    keys = [
        f"named_struct('band', {b}, 'key', xxhash64({', '.join(f'm{b * rows + r}' for r in range(rows))}))"
        for b in range(bands)
    ]
    carried = ["id", "size", *[f"s{i}" for i in range(SKETCH)]]
    return signed.select(*carried, F.expr(f"explode(array({', '.join(keys)}))").alias("k")).select(
        "k.band", "k.key", *carried
    )


def candidates(
    keys_a: DataFrame, keys_b: DataFrame, distance: float, same_table: bool, parts_a=None, parts_b=None
) -> DataFrame:
    """(id_a, id_b) of sets that share a band and whose sizes and sketches allow the distance.

    Both tests only drop pairs that cannot be near, and do so inside the join, so a full bucket
    gives out little more than its near pairs.
    """
    sketch = [f"s{i}" for i in range(SKETCH)]
    left, right = (
        keys.select(*KEYS, *[F.col(c).alias(f"{c}_{side}") for c in ("id", "size", *sketch)])
        for keys, side in ((keys_a, "a"), (keys_b, "b"))
    )
    sizes = F.col("size_a").cast("long"), F.col("size_b").cast("long")
    differing = F.expr(" + ".join(f"bit_count({s}_a ^ {s}_b)" for s in sketch))
    condition = size_bound(*sizes, distance) & difference_bound(*sizes, differing, distance)
    if same_table:
        condition = condition & (F.col("id_a") < F.col("id_b"))
    met = bucket_join(left, right, KEYS, condition, "id_a", "id_b", parts_a, parts_b)
    return met.select("id_a", "id_b").distinct()


def _side(
    df: DataFrame, id_col: str, text_col: str, shape: tuple[int, int], bucket_rows: int, sample: float, sets_of: SetsOf
):
    def keys_of(part: DataFrame) -> DataFrame:
        return band_keys(distinct_sets(sets_of(part, id_col, text_col)), *shape)

    sets = distinct_sets(sets_of(df, id_col, text_col))
    large = sampled_large_buckets(df, keys_of, KEYS, bucket_rows, sample)
    return sets, band_keys(sets, *shape), large


def minhash_near_pairs(
    df: DataFrame,
    id_col: str,
    text_col: str,
    distance: float,
    shape: tuple[int, int] | None = None,
    bucket_rows: int = BUCKET_ROWS,
    sample: float = SAMPLE,
    sets_of: SetsOf = token_sets,
) -> DataFrame:
    """Pairs of different token sets of one table nearer than ``distance`` (see the module text).

    ``sets_of`` makes the sets: ``token_sets``, or ``hashed_sets`` for hash buckets.
    """
    sets, keys, large = _side(df, id_col, text_col, shape or choose_bands(distance), bucket_rows, sample, sets_of)
    return near_pairs(candidates(keys, keys, distance, True, large, large), sets, sets, distance)


def minhash_near_pairs_between(
    df_a: DataFrame,
    df_b: DataFrame,
    id_a: str,
    id_b: str,
    text_a: str,
    text_b: str,
    distance: float,
    shape: tuple[int, int] | None = None,
    bucket_rows: int = BUCKET_ROWS,
    sample: float = SAMPLE,
    sets_of: SetsOf = token_sets,
) -> DataFrame:
    """Pairs of a set of one table and a set of another nearer than ``distance``."""
    shape = shape or choose_bands(distance)
    sets_a, keys_a, large_a = _side(df_a, id_a, text_a, shape, bucket_rows, sample, sets_of)
    sets_b, keys_b, large_b = _side(df_b, id_b, text_b, shape, bucket_rows, sample, sets_of)
    found = candidates(keys_a, keys_b, distance, False, large_a, large_b)
    return near_pairs(found, sets_a, sets_b, distance)
