"""Exact Jaccard join: all pairs of token sets nearer than a threshold.

Two sets with similarity above s = 1 - t differ in fewer than (a + b) * t / (2 - t) tokens. If
the token space is cut into more segments than the sets may differ in, the sets agree in at least
one whole segment, so it is enough to compare sets that share a segment. A segment of several
tokens is far rarer than any single token, which keeps buckets small without a table of token
frequencies, and all keys of a set are made from its own row.

* Sets are classed by size so that a partner is in the same or the next class; every set makes
  keys for its own class and for the next one, and a pair is found in the larger one's class.
* Segments empty in both sets also "agree", but make no key. A set with too few filled segments
  to be sure of a shared one adds its tokens with the smallest hashes, as many as two near sets
  cannot both miss. So a pair shares a filled segment if either set is well filled, and one of
  these tokens if neither is.
* The shared segments of a pair are counted. A near pair shares all but the allowed number of its
  filled segments; sets that only meet in a common word or two share far fewer and are dropped
  before any tokens are fetched.

Candidates carry ids only; distances are computed on the tokens afterwards. The method is meant
for small thresholds (near copies): the number of keys per set is about 0.6 per token at t = 0.2.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import exploded
from .buckets import BUCKET_ROWS, SAMPLE, bucket_join, sampled_large_buckets
from .token_sets import SetsOf, distinct_sets, exact, near_pairs, set_size, size_bound, token_sets

LARGEST_SET = 1 << 31
KEYS = ["cls", "seg", "key"]


def _classes(distance: float) -> list[tuple[int, int, int]]:
    """(smallest size, most differing tokens of a near pair, segments) per size class."""
    t = exact(distance)
    out, low = [], 1
    while low < LARGEST_SET:
        following = max(low + 1, math.floor(low / (1 - t)) + 1, low * 11 // 10 + 1)
        differ = math.ceil(t / (2 - t) * 2 * (following - 1)) - 1  # strictly below the limit
        out.append((low, differ, differ + 2 + differ // 4))
        low = following
    return out


def _constants(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def _pick(values: list[int], index: Column) -> Column:
    return F.element_at(_constants(values), index)


def segment_keys(sets: DataFrame, distance: float, equal_sets: bool = True) -> DataFrame:
    """(cls, seg, key, id, size, own, need): the bucket rows of every set of (id, tokens).

    ``own`` tells whether the class is the set's own, ``need`` how many segments it must share
    with a near set in this class. ``equal_sets=False`` drops keys that only equal sets could share.
    """
    t = exact(distance)
    lows, differs, segments = (list(c) for c in zip(*_classes(distance)))
    hashes = F.transform("tokens", lambda w: F.xxhash64(w))
    sized = sets.select("id", set_size().alias("size"), F.sort_array(hashes).alias("hashes"))
    below = F.filter(_constants(lows), lambda v: v <= F.col("size"))
    classed = (
        sized.withColumn("own", F.size(below))
        .withColumn("cls", F.explode(F.array("own", F.col("own") + 1)))
        .withColumn("low", _pick(lows, F.col("cls")))
        .withColumn("differ", _pick(differs, F.col("cls")))
        .withColumn("segments", _pick(segments, F.col("cls")))
    )
    joins_own = F.col("cls") == F.col("own")
    if not equal_sets:
        joins_own = joins_own & (F.col("differ") > 0)
    # a set of the class below is needed only where it can be near this class's smallest
    joins_next = (
        (F.col("cls") > F.col("own"))
        & (F.col("differ") > 0)
        & (F.col("size").cast("long") * t.denominator > F.col("low") * (t.denominator - t.numerator))
    )

    def segment(h: Column) -> Column:
        return F.pmod(F.xxhash64(h, F.lit(1)), F.col("segments"))

    filled = F.size(F.array_distinct(F.transform("hashes", segment)))
    # a near partner shares more than s * size tokens, so one of these is in it
    enough = F.col("size") - F.floor(
        F.col("size") * (t.denominator - t.numerator) / F.lit(t.denominator)
    )
    smallest = F.when(
        filled <= F.col("differ"), F.slice("hashes", F.lit(1), enough.cast("int"))
    ).otherwise(F.array().cast("array<bigint>"))
    parts = F.concat(
        F.transform("hashes", lambda h: F.struct(segment(h).alias("seg"), h.alias("h"))),
        # single tokens are numbered below zero, apart from the segments
        F.transform(
            smallest, lambda h: F.struct((-1 - h.bitwiseAND((1 << 62) - 1)).alias("seg"), h.alias("h"))
        ),
    )
    need = (filled - F.col("differ")).cast("int")
    ready = classed.where(joins_own | joins_next).select(
        "id", "size", "cls", joins_own.alias("own"), need.alias("need"), parts.alias("parts")
    )
    rows = exploded(ready, F.col("parts"), "part", "id", "size", "cls", "own", "need")
    keyed = rows.groupBy("id", "size", "cls", "own", "need", F.col("part.seg").alias("seg")).agg(
        F.bit_xor("part.h").alias("key")
    )
    return keyed.select("cls", "seg", "key", "id", "size", "own", "need")


def _candidates(a: DataFrame, b: DataFrame, distance: float, same_table: bool, parts_a, parts_b) -> DataFrame:
    left, right = (
        keys.select(*KEYS, *[F.col(c).alias(f"{c}_{side}") for c in ("id", "size", "own", "need")])
        for keys, side in ((a, "a"), (b, "b"))
    )
    condition = (F.col("own_a") | F.col("own_b")) & size_bound(
        F.col("size_a").cast("long"), F.col("size_b").cast("long"), distance
    )
    if same_table:
        condition = condition & (F.col("id_a") < F.col("id_b"))
    met = bucket_join(left, right, KEYS, condition, "id_a", "id_b", parts_a, parts_b)
    shared = met.groupBy("id_a", "id_b", F.greatest("need_a", "need_b").alias("need")).agg(
        F.count(F.when(F.col("seg") >= 0, 1)).alias("shared")
    )
    return shared.where("shared >= need").select("id_a", "id_b")


def exact_near_pairs(
    df: DataFrame,
    id_col: str,
    text_col: str,
    distance: float,
    bucket_rows: int = BUCKET_ROWS,
    sample: float = SAMPLE,
    sets_of: SetsOf = token_sets,
) -> DataFrame:
    """All pairs of different token sets of one table nearer than ``distance``.

    (id_a, id_b, distance, copies_a, copies_b) with id_a < id_b, each id the smallest of the rows
    holding that set; ``token_sets.copy_links`` gives the other rows.
    """
    sets = distinct_sets(sets_of(df, id_col, text_col))

    def keys_of(part: DataFrame) -> DataFrame:
        return segment_keys(distinct_sets(sets_of(part, id_col, text_col)), distance, False)

    large = sampled_large_buckets(df, keys_of, KEYS, bucket_rows, sample)
    keys = segment_keys(sets, distance, equal_sets=False)
    return near_pairs(_candidates(keys, keys, distance, True, large, large), sets, sets, distance)


def exact_near_pairs_between(
    df_a: DataFrame,
    df_b: DataFrame,
    id_a: str,
    id_b: str,
    text_a: str,
    text_b: str,
    distance: float,
    bucket_rows: int = BUCKET_ROWS,
    sample: float = SAMPLE,
    sets_of: SetsOf = token_sets,
) -> DataFrame:
    """All pairs of a set of one table and a set of another nearer than ``distance``."""
    sides = []
    for df, id_col, text_col in ((df_a, id_a, text_a), (df_b, id_b, text_b)):

        def keys_of(part: DataFrame, id_col=id_col, text_col=text_col) -> DataFrame:
            return segment_keys(distinct_sets(sets_of(part, id_col, text_col)), distance)

        sets = distinct_sets(sets_of(df, id_col, text_col))
        large = sampled_large_buckets(df, keys_of, KEYS, bucket_rows, sample)
        sides.append((sets, segment_keys(sets, distance), large))
    (sets_a, keys_a, large_a), (sets_b, keys_b, large_b) = sides
    found = _candidates(keys_a, keys_b, distance, False, large_a, large_b)
    return near_pairs(found, sets_a, sets_b, distance)
