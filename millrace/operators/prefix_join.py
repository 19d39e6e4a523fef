"""Exact Jaccard join for any threshold, loose ones too: rare tokens first, prefixes, positions and counts.

All sets are sorted by one order of the tokens, rare ones first. Two sets with an overlap of at least o share their first
``matches`` common tokens (or all, if there are fewer) within a prefix of each that is the longer the looser the threshold.
So only prefixes are joined. A pair is dropped before any tokens are fetched if it shares fewer tokens there, or if what comes after the last
shared one cannot make up the overlap it needs.

Any order that all sets have in common gives the same pairs; that it starts with rare tokens only keeps the joined lists short.
It is taken from a table of counts by hash bucket, of a fixed size whatever the vocabulary.
"""

from __future__ import annotations

import json
import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import exploded
from ..session import settle
from .block_join import near_pairs_in_blocks, printed
from .token_sets import SetsOf, distinct_sets, exact, near_pairs, set_size, size_bound, token_sets

#: Buckets of the table of counts, as a power of two, and rows it is counted on: both only tell how good the order is.
ORDER_BITS, ORDER_ROWS = 18, 1_000_000


def token_order(sets: list[DataFrame], bits: int = ORDER_BITS, rows: int = ORDER_ROWS) -> Column:
    """The counts of hashed tokens as one constant array of 2 ** bits small numbers: four times the logarithm of each bucket's count.

    At most about ``rows`` sets of each table are counted, taken evenly.
    """
    counts = [0] * (1 << bits)
    for table in sets:
        size = table.count()  # of a written table: no column is read
        part = table.sample(rows / size, seed=1) if size > rows else table
        buckets = exploded(part.select("tokens"), F.col("tokens"), "token").select(F.pmod(F.xxhash64("token"), F.lit(1 << bits)).alias("bucket"))
        for row in buckets.groupBy("bucket").count().collect():  # 2 ** bits rows at most
            counts[row["bucket"]] += row["count"]
    steps = [min(127, math.ceil(4 * math.log2(1 + n))) for n in counts]
    return F.from_json(F.lit(json.dumps(steps)), "array<tinyint>")


def default_matches(distance: float) -> int:
    """Common tokens that a pair must show: more of them where thresholds are loose and prefixes long."""
    return 8 if distance > 0.5 else 4 if distance > 0.3 else 2


def _least_overlap(sizes: Column, distance: float) -> Column:
    """The fewest common tokens of two sets, of so many tokens together, that are nearer than the distance."""
    t = exact(distance)
    kept = t.denominator - t.numerator
    return F.floor(sizes * kept / F.lit(2 * t.denominator - t.numerator)) + 1


def prefixes(sets: DataFrame, distance: float, order: Column, matches: int, bits: int = ORDER_BITS) -> DataFrame:
    """(token, pos, id, size): the tokens of each set's prefix, as hashes, with their places."""
    keep: Fraction = 1 - exact(distance)
    placed = F.sort_array(
        F.transform(
            F.transform("tokens", lambda w: F.xxhash64(w)),
            lambda h: F.struct(F.get(order, F.pmod(h, F.lit(1 << bits)).cast("int")).alias("often"), h.alias("token")),
        )
    )
    least = F.floor(F.col("size") * keep.numerator / F.lit(keep.denominator)) + 1
    length = F.least(F.col("size"), F.col("size") - least + matches).cast("int")
    cut = sets.select("id", set_size().cast("bigint").alias("size"), placed.alias("placed"))
    cut = cut.select("id", "size", F.slice("placed", F.lit(1), length).alias("prefix"))
    rows = cut.select("id", "size", F.posexplode_outer("prefix").alias("pos", "at"))
    return rows.select(F.col("at.token").alias("token"), F.col("pos").cast("bigint").alias("pos"), "id", "size")


def prefix_candidates(rows_a: DataFrame, rows_b: DataFrame, distance: float, matches: int, same_table: bool) -> DataFrame:
    """(id_a, id_b) of the sets whose prefixes allow the distance.

    Hot tokens are left to adaptive execution, which splits the partition of one side; conditions are tested inside the join.
    """
    a, b = (rows.select("token", *[F.col(c).alias(f"{c}_{side}") for c in ("id", "size", "pos")]) for rows, side in ((rows_a, "a"), (rows_b, "b")))
    overlap = _least_overlap(F.col("size_a") + F.col("size_b"), distance)

    def after(pos_a: str, pos_b: str) -> Column:
        return F.least(F.col("size_a") - F.col(pos_a), F.col("size_b") - F.col(pos_b)) - 1

    # of the first ``matches`` common tokens, each leaves enough behind it
    fits = size_bound(F.col("size_a"), F.col("size_b"), distance) & (after("pos_a", "pos_b") + matches >= overlap)
    if same_table:
        fits = fits & (F.col("id_a") < F.col("id_b"))
    met = a.join(b, "token").where(fits).groupBy("id_a", "id_b", "size_a", "size_b").agg(
        F.count("*").alias("shared"), F.max("pos_a").alias("last_a"), F.max("pos_b").alias("last_b")
    )
    enough = (F.col("shared") >= F.least(F.lit(matches), overlap)) & (F.col("shared") + after("last_a", "last_b") >= overlap)
    return met.where(enough).select("id_a", "id_b")


def _sets(df: DataFrame, id_col: str, text_col: str, sets_of: SetsOf) -> DataFrame:
    return settle(distinct_sets(sets_of(df, id_col, text_col)), "token_sets")


def prefix_near_pairs(
    df: DataFrame, id_col: str, text_col: str, distance: float, matches: int | None = None, sets_of: SetsOf = token_sets
) -> DataFrame:
    """All pairs of different token sets of one table nearer than ``distance``.

    (id_a, id_b, distance, copies_a, copies_b) with id_a < id_b, each id the smallest of the rows holding that set; ``token_sets.copy_links``
    gives the other rows. Token sets are written once and read for their order and the blocks, in which prefixes and tokens are compared.
    """
    sets = printed(sets_of(df, id_col, text_col))
    return near_pairs_in_blocks(sets, distance, matches or default_matches(distance))


def prefix_near_pairs_between(
    df_a: DataFrame, df_b: DataFrame, id_a: str, id_b: str, text_a: str, text_b: str, distance: float,
    matches: int | None = None, sets_of: SetsOf = token_sets,
) -> DataFrame:
    """All pairs of a set of one table and a set of another nearer than ``distance``."""
    matches = matches or default_matches(distance)
    sets_a, sets_b = _sets(df_a, id_a, text_a, sets_of), _sets(df_b, id_b, text_b, sets_of)
    order = token_order([sets_a, sets_b])
    rows_a, rows_b = (prefixes(sets, distance, order, matches) for sets in (sets_a, sets_b))
    return near_pairs(prefix_candidates(rows_a, rows_b, distance, matches, False), sets_a, sets_b, distance)
