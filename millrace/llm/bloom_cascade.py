"""Exact membership without joins by a cascade of Bloom filters, and URL rules judged with it.

Level 1 holds the listed keys. Level 2 holds the keys of the corpus that level 1 lets through though
they are not listed, level 3 the listed keys that level 2 lets through, and so on until a level lets
nothing wrong through. For every key of the corpus the first level that refuses it decides: an odd
level says "not listed", an even one "listed".
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import constant, settle

#: Bytes of the filters held by one pass over the corpus; a longer list takes more passes.
MAX_FILTER_BYTES = 32 << 20
#: Share of wrong answers of every level after the first.
LATER_RATE = 0.5
#: Characters A-Z and their lower case, the only ones folded in host names.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Level:
    """One Bloom filter: ``bits`` positions in 64-bit words, ``hashes`` positions for each key."""

    seed: int
    bits: int
    hashes: int
    words: list[int]

    def positions(self, key: Column) -> Column:
        """Array of the bits that stand for a key."""
        first, second = [F.pmod(F.xxhash64(key, F.lit(self.seed + i)), F.lit(self.bits)) for i in (0, 1)]
        return F.transform(F.sequence(F.lit(0), F.lit(self.hashes - 1)), lambda j: (first + j * second) % F.lit(self.bits))

    def holds(self, key: Column) -> Column:
        words = constant(self.words, "array<bigint>")
        return F.forall(
            self.positions(key),
            lambda p: F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), (p % 64).cast("int")) == 1,
        )


def _shape(keys: int, rate: float) -> tuple[int, int]:
    hashes = max(1, round(math.log2(1 / rate)))
    return max(64, math.ceil(keys * hashes / math.log(2) / 64) * 64), hashes


def _level(keys: DataFrame, count: int, rate: float, seed: int) -> Level:
    """The filter of a one-column table of keys; its words are put together by Spark."""
    bits, hashes = _shape(count, rate)
    frame = Level(seed, bits, hashes, [])
    words = (
        keys.select(F.explode(frame.positions(F.col("key"))).alias("p"))
        .groupBy(F.shiftright("p", 6).cast("int").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("value"))
    )
    filled = [0] * (bits // 64)
    for row in words.collect():  # bits / 64 rows at most, a size known beforehand
        filled[row["word"]] = row["value"]
    return Level(seed, bits, hashes, filled)


def screen(keys: DataFrame, count: int, max_bytes: int) -> Level:
    """One filter for the ``count`` rows of a one-column table ``key``, of at most ``max_bytes``.

    It lets every key through, and few others while the bound allows some ten bits a key.
    """
    return _level(keys, min(count, int(max_bytes * 8 * math.log(2) / 7)), 1 / 128, 0)


def first_rate(listed: int, universe: int) -> float:
    """Rate of level 1 at which the levels together are smallest."""
    others = max(1, universe - listed)
    return min(0.5, max(1e-9, max(1, listed) * math.sqrt(LATER_RATE) / others))


def cascade(universe: DataFrame, listed: DataFrame, universe_size: int) -> list[Level]:
    """Levels that answer exactly for every key of ``universe``.

    Both tables have one column ``key``; keys may repeat and NULL keys are ignored (they are never
    listed). ``universe_size`` only sets the sizes. An empty list gives no level: nothing is listed.
    """
    listed = settle(listed.where("key IS NOT NULL").distinct(), "listed")
    count = listed.count()
    if not count:
        return []
    levels = [_level(listed, count, first_rate(count, universe_size), 0)]
    through = universe.where(F.col("key").isNotNull() & levels[0].holds(F.col("key"))).distinct()
    wrong = settle(through.join(listed, "key", "left_anti"), "passed")
    inside, left = listed, wrong.count()
    while left:
        levels.append(_level(wrong, left, LATER_RATE, 2 * len(levels)))
        wrong, inside = settle(inside.where(levels[-1].holds(F.col("key"))), "passed"), wrong
        left = wrong.count()
    return levels


def member(key: Column, levels: list[Level]) -> Column:
    """Whether a key of the universe is listed. A NULL key is not."""
    answer = F.lit(len(levels) % 2 == 1)
    for depth in range(len(levels) - 1, -1, -1):
        answer = F.when(levels[depth].holds(key), answer).otherwise(F.lit(depth % 2 == 1))
    return F.when(key.isNull(), False).otherwise(answer)


def filter_bytes(listed: int, universe: int) -> int:
    """Bytes of a cascade, the later levels included."""
    return 2 * _shape(max(1, listed), first_rate(listed, universe))[0] // 8


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` or for NULL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    none = F.coalesce(at, F.lit(0)) == 0
    return (
        F.when(none, "").otherwise(F.translate(host, UPPER, LOWER)),
        F.when(none, "").otherwise(path),
    )


def _keys(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """Every rule that could fit: host endings by label, joined to path beginnings of given lengths."""
    parts = F.split(host, r"\.")
    endings = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(labels))),
        lambda n: F.concat_ws(".", F.slice(parts, -n, n)),
    )
    starts = F.transform(
        F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path)),
        lambda n: F.substr(path, F.lit(1), n),
    )
    return F.flatten(F.transform(endings, lambda e: F.transform(starts, lambda s: F.concat(e, s))))


def judge_urls(
    pages: DataFrame, url: str, rules: DataFrame, default: str = "allow", max_filter_bytes: int = MAX_FILTER_BYTES
) -> DataFrame:
    """The rows of ``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has (host, path, verdict), verdict ``allow`` or ``block``, paths empty or starting with
    ``/``. A rule fits its host and every subdomain where the url's path starts with the rule's. The
    longest rule wins, of equally long ones the one with the longer host; a rule listed with both
    verdicts blocks. Where none fits, no level lists a key of the url: ``rule`` is NULL and the
    verdict is ``default``. Rules with a NULL are ignored. Columns of ``pages`` that bear a name of
    the result are replaced. The result has as many rows as ``pages``, repeated ones included.

    Two cascades, of allowing and of blocking rules, over all keys that the urls of the corpus can
    give: endings of the host by whole labels, with path beginnings of the lengths that rules have.
    No row of ``pages`` is shuffled or joined. A list whose filters pass ``max_filter_bytes`` is cut
    by a hash of the key into parts that fit, each judged in a pass of its own.
    """
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    host, path = host_and_path(F.col(url))
    parsed = pages.select(*kept, host.alias("host"), path.alias("path"))
    rules = rules.dropna(subset=["host", "path", "verdict"]).select(
        F.concat("host", "path").alias("key"), "verdict", "host", "path"
    )
    shape = rules.agg(
        F.max(F.size(F.split("host", r"\."))).alias("labels"),
        F.sort_array(F.collect_set(F.length("path"))).alias("lengths"),
        F.countDistinct("key").alias("n"),
    ).first()
    if not shape["n"]:
        return parsed.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keys = _keys(F.col("host"), F.col("path"), shape["labels"], shape["lengths"])
    universe = parsed.select(F.explode(keys).alias("key"))
    universe_size = universe.agg(F.approx_count_distinct("key")).first()[0]
    parts = max(1, math.ceil(filter_bytes(shape["n"], universe_size) / max_filter_bytes))
    none = F.lit(None).cast("struct<length:int,host_length:int,rule:string,verdict:string>")
    judged = parsed.withColumn("_best", none)
    for part in range(parts):
        mine = F.pmod(F.xxhash64("key"), F.lit(parts)) == part
        some, here = (universe.where(mine), rules.where(mine)) if parts > 1 else (universe, rules)
        size = universe_size // parts
        block = cascade(some, here.where("verdict = 'block'").select("key"), size)
        allow = cascade(some, here.where("verdict = 'allow'").select("key"), size)

        def verdict(key):
            said = F.when(member(key, block), "block").when(member(key, allow), "allow")
            return said if parts == 1 else F.when(F.pmod(F.xxhash64(key), F.lit(parts)) == part, said)

        found = F.transform(
            keys,
            lambda k: F.struct(
                F.length(k).alias("length"),
                F.length(F.substring_index(k, "/", 1)).alias("host_length"),
                k.alias("rule"),
                verdict(k).alias("verdict"),
            ),
        )
        best = F.array_max(F.filter(found, lambda f: f["verdict"].isNotNull()))
        judged = judged.withColumn("_best", F.greatest(F.col("_best"), best) if part else best)
        if part < parts - 1:
            judged = settle(judged, "judged")
    return judged.select(
        *kept, "host", "path", F.col("_best.rule").alias("rule"),
        F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
    )
