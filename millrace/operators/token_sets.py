"""Texts as token sets, with equal sets kept once, and Jaccard distances of candidate pairs.

Copies are the commonest hot group in text: a third of all rows may be one text. Equal sets are
therefore reduced to their smallest id before any join, and the other rows are linked to that id.
Pairs are then formed between different sets only, and a pair of rows is read off by joining the
links, so a group of n copies costs n links and never n * n pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from fractions import Fraction

from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import token_set
from ..session import settle


def token_sets(df: DataFrame, id_col: str, text_col: str, stop_words: Sequence[str] = ()) -> DataFrame:
    """(id, tokens) of the rows with at least one token; tokens in ``stop_words`` do not count."""
    texts = df.where(F.col(text_col).rlike(r"\S"))
    found = token_set(F.col(text_col))
    if not stop_words:
        return texts.select(F.col(id_col).alias("id"), found.alias("tokens"))
    kept = F.array_except(found, F.array(*[F.lit(w.lower()) for w in stop_words]))
    return texts.select(F.col(id_col).alias("id"), kept.alias("tokens")).where(F.size("tokens") > 0)


def hashed_sets(
    df: DataFrame, id_col: str, text_col: str, features: int = 20, stop_words: Sequence[str] = ()
) -> DataFrame:
    """(id, tokens) where the tokens are the numbers of the hash buckets a text fills.

    With few buckets different words fall together, so distances are those of hashed term
    frequencies, not of the words themselves.
    """
    sets = token_sets(df, id_col, text_col, stop_words)
    hashed = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=features).transform(sets)
    filled = F.unwrap_udt("tf")["indices"]
    return hashed.select("id", F.transform(filled, lambda i: i.cast("string")).alias("tokens"))


SetsOf = Callable[[DataFrame, str, str], DataFrame]


def set_size(tokens: str = "tokens") -> Column:
    """Number of tokens, never NULL: a join would otherwise test it for NULL down at the scan."""
    return F.coalesce(F.size(tokens), F.lit(0))


def fingerprint(tokens: Column) -> Column:
    """A 32-character digest that is equal for equal sets (tokens hold no blanks); never NULL, for
    the same reason as ``set_size``."""
    return F.coalesce(F.md5(F.array_join(F.sort_array(tokens), " ")), F.lit(""))


def copy_links(sets: DataFrame) -> DataFrame:
    """(id, rep) for every row: ``rep`` is the smallest id with the same token set.

    Digests are grouped with map-side combining and joined back one-to-many, which adaptive
    execution can split where one digest is most of the rows.
    """
    prints = sets.select("id", fingerprint(F.col("tokens")).alias("print"))
    reps = prints.groupBy("print").agg(F.min("id").alias("rep"))
    return prints.join(reps, "print").select("id", "rep")


def distinct_sets(sets: DataFrame) -> DataFrame:
    """(id, tokens, copies): one row per different token set, under its smallest id.

    The join is merged on purpose: its result is spread by id, which the per-id steps after it
    use again without another shuffle. Ids are unique, so no partition is hot.
    """
    prints = sets.select("id", fingerprint(F.col("tokens")).alias("print"))
    reps = prints.groupBy("print").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    return sets.join(reps.select("id", "copies").hint("merge"), "id").select("id", "tokens", "copies")


def exact(distance: float) -> Fraction:
    """The threshold as written, so that comparisons with it need no rounding."""
    return Fraction(str(distance))


def size_bound(size_a: Column, size_b: Column, distance: float) -> Column:
    """False where the sizes alone rule out a distance below the threshold."""
    t = exact(distance)
    kept = t.denominator - t.numerator
    return (size_a * t.denominator > size_b * kept) & (size_b * t.denominator > size_a * kept)


def difference_bound(size_a: Column, size_b: Column, differing: Column, distance: float) -> Column:
    """False where sets known to differ in at least ``differing`` tokens cannot be near."""
    t = exact(distance)
    return differing * (2 * t.denominator - t.numerator) < (size_a + size_b) * t.numerator


#: Sets of either side that a cell of pairs holds, about: their tokens are one row.
CELL_SETS = 64


def _cells(pairs: DataFrame) -> DataFrame:
    """(id_a, id_b, label, pa, pb): the pairs in cells of at most about ``CELL_SETS`` sets of either side.

    A pair goes with the smallest ``id_a`` that its ``id_b`` is paired with, so the pairs of a group of near texts come together.
    """
    roots = pairs.groupBy("id_b").agg(F.min("id_a").alias("label"))
    labelled = pairs.join(roots, "id_b")

    def parts(side: str) -> DataFrame:
        members = labelled.select("label", f"id_{side}").distinct().groupBy("label").agg(F.count("*").alias("n"))
        return members.select("label", F.ceil(F.col("n") / CELL_SETS).alias(f"n{side}"))

    counted = labelled.join(parts("a"), "label").join(parts("b"), "label")
    cut = [F.when(F.col(f"n{s}") > 1, F.pmod(F.xxhash64(f"id_{s}"), f"n{s}")).otherwise(0).cast("int").alias(f"p{s}") for s in "ab"]
    return counted.select("id_a", "id_b", "label", *cut)


def near_pairs(candidates: DataFrame, sets_a: DataFrame, sets_b: DataFrame, distance: float) -> DataFrame:
    """(id_a, id_b, distance, copies_a, copies_b) of the candidates strictly below the threshold.

    Tokens are sent once to each cell of pairs that needs them, not with every pair: of n texts that are all
    candidates of each other, each is sent to some n / ``CELL_SETS`` cells.
    """
    t = exact(distance)
    cell = ["label", "pa", "pb"]
    pairs = settle(_cells(settle(candidates.select("id_a", "id_b"), "candidates")), "pairs")

    def members(side: str, sets: DataFrame) -> DataFrame:
        found = sets.select(F.col("id").alias(f"id_{side}"), F.struct("id", "tokens", "copies").alias("m"))
        return pairs.select(*cell, f"id_{side}").distinct().join(found, f"id_{side}").select(*cell, "m")

    if sets_a is sets_b:
        ids = pairs.select(*cell, F.explode(F.array("id_a", "id_b")).alias("id")).distinct()
        held = ids.join(sets_a, "id").select(*cell, F.struct("id", "tokens", "copies").alias("m"))
        held = held.groupBy(*cell).agg(F.collect_list("m").alias("as")).withColumn("bs", F.col("as"))
    else:
        held_a, held_b = (members(s, sets).groupBy(*cell).agg(F.collect_list("m").alias(f"{s}s")) for s, sets in (("a", sets_a), ("b", sets_b)))
        held = held_a.join(held_b, cell)
    asked = pairs.groupBy(*cell).agg(F.collect_list(F.struct("id_a", "id_b")).alias("asked"))

    def compared(x: Column, y: Column) -> Column:
        return F.struct(
            x["id"].alias("id_a"), y["id"].alias("id_b"), F.size(F.array_intersect(x["tokens"], y["tokens"])).alias("common"),
            (F.size(x["tokens"]) + F.size(y["tokens"])).alias("sizes"), x["copies"].alias("copies_a"), y["copies"].alias("copies_b"),
        )

    def of(side: str, wanted: Column) -> Column:
        return F.filter(f"{side}s", lambda m: m["id"] == wanted)

    # an id may stand for several rows, all of which are compared
    each = F.transform("asked", lambda p: F.flatten(
        F.transform(of("a", p["id_a"]), lambda x: F.transform(of("b", p["id_b"]), lambda y: compared(x, y)))
    ))
    counted = held.join(asked, cell).select(F.explode(F.flatten(each)).alias("c")).select("c.*").withColumn("either", F.col("sizes") - F.col("common"))
    near = counted.where(
        F.col("common").cast("long") * t.denominator
        > F.col("either").cast("long") * (t.denominator - t.numerator)
    )
    measured = F.round(1 - F.col("common") / F.col("either"), 6).alias("distance")
    return near.select("id_a", "id_b", measured, "copies_a", "copies_b")
