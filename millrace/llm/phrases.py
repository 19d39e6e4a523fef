"""Collocations: phrases of words that stand together more often than their parts explain.

Words get ids by hashing, checked to be unique over the whole vocabulary, so no dictionary travels. Phrases are counted by counting
quotient filters of packed ids: each task builds a sorted filter of what it reads, filters are dealt out by the first bits of
the permuted phrase and merged. Longer phrases are counted only where both shorter phrases in them are frequent enough.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import settle
from .quotient_filter import Filter, permute
from .words import Words, mix

#: Bytes of text that are read together, a longer piece alone; different words that a task counts before it hands them on.
CHUNK_BYTES, HELD = 1 << 20, 400_000
#: Phrases from which a task builds a filter, and entries of a filter that it hands on.
PENDING, ENTRIES = 1 << 21, 1 << 22
#: Occurrences of phrases that one part of the phrases' space may have on average.
PART_OCCURRENCES = 1 << 21
#: Bits of the maps that tell frequent words and phrases, at most (16 MB); a full map costs time, not results.
MAP_BITS = 27
#: Parts in which the best phrases of a language are sought first.
BUCKETS = 64
#: How much less likely than 1 it is that two words get the same id, in bits.
SPARE_BITS = 8

#: Bytes that part phrases, and bytes that part words.
_BREAKS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_BREAK = re.compile(rb"[.,;:!?\n\x0b\x0c\r]")
_WORD = re.compile(rb"[^.,;:!?\n\x0b\x0c\r \t]+")


def _letters(seed: int) -> np.ndarray:
    """For each byte the number that is hashed for it, 0 outside words; another seed gives another family of hashes."""
    letters = np.random.default_rng(seed).permutation(np.arange(1, 60_000, dtype=np.uint16))[:256]
    letters[list(_BREAKS + _BLANKS)] = 0
    return letters


def _salt(lang: str) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass"))


def _segments(text: str):
    """Lower-cased bytes of a text, cut at breaks where it is long."""
    data = text.encode().lower()  # of bytes, lower() changes A to Z only
    at = 0
    while at < len(data):
        found = _BREAK.search(data, at + CHUNK_BYTES)
        end = found.end() if found else len(data)
        yield data[at:end]
        at = end


def _languages(batch: pa.RecordBatch) -> list[str]:
    return ["und" if x is None else x for x in batch.column("lang").to_pylist()]


def _vocabulary(seed: int):
    letters = _letters(seed)

    def count(batches):
        held: dict[str, Counter] = {}

        def flush():
            for lang, counts in held.items():
                words = list(counts)
                if not words:
                    continue
                data = np.frombuffer(b"\n".join(words), np.uint8)
                ids = mix(Words(data, np.array([0, len(data)]), letters).hashes ^ np.uint64(_salt(lang)))
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()),
                    pa.array(ids.view(np.int64)), pa.array(list(counts.values()), pa.int64()),
                ], names=["lang", "word", "id", "n"])
            held.clear()

        for batch in batches:
            for lang, text in zip(_languages(batch), batch.column("text").to_pylist()):
                counts = held.setdefault(lang, Counter())
                for segment in _segments(text or ""):
                    counts.update(_WORD.findall(segment))
                if sum(map(len, held.values())) > HELD:
                    yield from flush()
        yield from flush()

    return count


class Vocabulary:
    """All words by language: table (lang, word, id, n), ids of ``width`` bits from hashes of the family ``seed``."""

    def __init__(self, words: DataFrame, seed: int, width: int):
        self.words, self.seed, self.width = words, seed, width

    @staticmethod
    def of(docs: DataFrame, min_count: int, seed: int = 0) -> Vocabulary:
        """Words are counted once; where a frequent word shares its id with any other word, ids get longer, then other hashes are taken."""
        words = docs.select("lang", "text").mapInArrow(_vocabulary(seed), "lang string, word string, id bigint, n bigint")
        words = settle(words.groupBy("lang", "word", "id").agg(F.sum("n").alias("n")), "words")
        size = words.agg(F.count("*").alias("n"), F.count_if(F.col("n") >= min_count).alias("often")).first()
        least = math.ceil(math.log2(max(2, size["n"]) * max(2, size["often"]))) + SPARE_BITS
        for width in sorted({min(64, max(16, least)), 64}):
            cut = words.withColumn("id", F.shiftrightunsigned("id", 64 - width))
            shared = cut.groupBy("id").agg(F.count("*").alias("n"), F.max("n").alias("most"))
            if shared.where((F.col("n") > 1) & (F.col("most") >= min_count)).isEmpty():
                return Vocabulary(cut, seed, width)
        return Vocabulary.of(docs, min_count, seed + 1)


def _map_of(marks: DataFrame, count: int) -> np.ndarray:
    """A bit map of the top bits of ``mark``, of bounded size."""
    bits = min(MAP_BITS, max(6, math.ceil(math.log2(16 * max(1, count)))))
    place = F.shiftrightunsigned("mark", 64 - bits)
    slots = marks.select(F.shiftright(place, 6).alias("slot"), F.call_function("shiftleft", F.lit(1).cast("bigint"), (place % 64).cast("int")).alias("bit"))
    slots = slots.groupBy("slot").agg(F.expr("bit_or(bit)").alias("bits")).toPandas()  # at most 2 ** (MAP_BITS - 6) rows
    out = np.zeros(1 << (bits - 6), np.uint64)
    out[slots["slot"].to_numpy(np.int64)] = slots["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _marked(bit_map: np.ndarray, marks: np.ndarray) -> np.ndarray:
    bits = np.uint64(len(bit_map).bit_length() - 1 + 6)
    place = marks >> (np.uint64(64) - bits)
    return (bit_map[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _mark(ids: list[np.ndarray]) -> np.ndarray:
    return reduce(lambda a, b: mix(a * np.uint64(0x9E3779B97F4A7C15) + b), ids)


def _phrases_in(data: bytes, bounds: np.ndarray, salts: np.ndarray, letters, width: int, maps) -> list[np.ndarray]:
    """Ids of the words of every phrase of len(maps) + 1 words whose shorter parts the maps allow."""
    raw = np.frombuffer(data, np.uint8)
    words = Words(raw, np.array([0, len(raw)]), letters)
    breaks = np.concatenate(([0], np.cumsum(np.isin(raw, np.frombuffer(_BREAKS, np.uint8)), dtype=np.int64)))
    owner = np.searchsorted(bounds, words.starts, "right") - 1
    ids = mix(words.hashes ^ salts[owner]) >> np.uint64(64 - width)
    good = _marked(maps[0], ids << np.uint64(64 - width))
    begins = good[:-1] & good[1:] & (breaks[words.starts[1:]] == breaks[words.ends[:-1]])
    for size, bit_map in enumerate(maps[1:], 2):
        n = len(ids) - size + 1
        often = np.zeros(max(n, 0), bool)
        at = np.flatnonzero(begins)
        often[at] = _marked(bit_map, _mark([ids[at + j] for j in range(size)]))
        begins = often[:-1] & often[1:]
    at = np.flatnonzero(begins)
    return [ids[at + j] for j in range(len(maps) + 1)]


def _filters(vocabulary_seed: int, width: int, part_bits: int, shared):
    letters = _letters(vocabulary_seed)

    def build(batches):
        maps = shared.value
        size = len(maps) + 1
        held: list[Filter] = []
        pending: list[list[np.ndarray]] = []
        salts: dict[str, int] = {}
        chunk: list[bytes] = []
        owners: list[int] = []

        def read():
            bounds = np.concatenate(([0], np.cumsum([len(c) + 1 for c in chunk])))[:-1]
            found = _phrases_in(b"\n".join(chunk), bounds, np.array(owners, np.uint64), letters, width, maps)
            pending.append(permute(found, width))
            chunk.clear()
            owners.clear()

        def collapse():
            numbers = [np.concatenate(x) for x in zip(*pending)] if pending else [np.zeros(0, np.uint64)] * size
            held[:] = [Filter.merged([*held, Filter.of(numbers, np.ones(len(numbers[0]), np.int64), width)])]
            pending.clear()

        def flush():
            collapse()
            for part, packed in held[0].pack(part_bits):
                yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int64()), "packed": pa.array([packed], pa.binary())})
            held.clear()

        waiting = 0
        for batch in batches:
            for lang, text in zip(_languages(batch), batch.column("text").to_pylist()):
                salt = salts.get(lang)
                if salt is None:
                    salt = salts[lang] = _salt(lang)
                for segment in _segments(text or ""):
                    chunk.append(segment)
                    owners.append(salt)
                    waiting += len(segment)
                    if waiting >= CHUNK_BYTES:
                        read()
                        waiting = 0
                        if sum(len(p[0]) for p in pending) >= PENDING:
                            collapse()
                            if len(held[0]) >= ENTRIES:
                                yield from flush()
        if chunk:
            read()
        yield from flush()

    return build


def _merger(size: int, min_count: int):
    """Merges the filters of each part, which come one part after the other, and gives out what is frequent enough."""

    def merge(batches):
        held: list[Filter] = []
        now, most = None, 2 * ENTRIES

        def out():
            whole = Filter.merged(held)
            often = whole.counts >= min_count
            kept = Filter([x[often] for x in whole.numbers], whole.counts[often], whole.width)
            ids = kept.grams()
            held.clear()
            return pa.RecordBatch.from_arrays(
                [*(pa.array(x.view(np.int64)) for x in ids), pa.array(kept.counts), pa.array(_mark(ids).view(np.int64))],
                names=[*(f"w{i}" for i in range(size)), "n", "mark"],
            )

        for batch in batches:
            for part, packed in zip(batch.column("part").to_pylist(), batch.column("packed")):
                if part != now and held:
                    yield out()
                    most = 2 * ENTRIES
                now = part
                held.append(Filter.unpack(packed.as_py()))
                if sum(map(len, held)) > most:
                    held[:] = [Filter.merged(held)]
                    most = max(2 * ENTRIES, 2 * len(held[0]))
        if held:
            yield out()

    return merge


def count_phrases(docs: DataFrame, vocabulary: Vocabulary, longest: int, min_count: int) -> dict[int, DataFrame]:
    """For each length from 2 to ``longest`` the table (w0, w1, ..., n) of the phrases with at least ``min_count`` occurrences, as word ids."""
    context = docs.sparkSession.sparkContext
    width = vocabulary.width
    partitions = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    totals = vocabulary.words.agg(F.sum("n").alias("n"), F.count_if(F.col("n") >= min_count).alias("often")).first()
    parts = max(4 * partitions, (totals["n"] or 0) // PART_OCCURRENCES)
    part_bits = min(width, 40, math.ceil(math.log2(parts)))
    often = vocabulary.words.where(F.col("n") >= min_count).select(F.shiftleft("id", 64 - width).alias("mark"))
    maps = [_map_of(often, totals["often"])]
    found: dict[int, DataFrame] = {}
    for size in range(2, longest + 1):
        # each task holds the maps, whose size is bounded by MAP_BITS
        filters = docs.select("lang", "text").mapInArrow(
            _filters(vocabulary.seed, width, part_bits, context.broadcast(list(maps))), "part bigint, packed binary"
        )
        dealt = filters.repartition(max(partitions, parts // 64), "part").sortWithinPartitions("part")
        schema = ", ".join(f"w{i} bigint" for i in range(size)) + ", n bigint, mark bigint"
        found[size] = settle(dealt.mapInArrow(_merger(size, min_count), schema), "phrases")
        if size < longest:
            maps.append(_map_of(found[size].select("mark"), found[size].count()))
    return {size: table.drop("mark") for size, table in found.items()}


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact."""
    wide = "decimal(38,0)"
    counts = [c.cast("decimal(15,0)") for c in (a, a, left, right)]
    top = (counts[0] * counts[1]).cast(wide) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", top.cast(wide), (counts[2] * counts[3]).cast(wide))


def _scored(size: int, found: dict[int, DataFrame], words: DataFrame) -> DataFrame:
    """Phrases of one length with language, text, and the score of the lowest cut."""
    names = [f"w{i}" for i in range(size)]
    rows = found[size].withColumnRenamed("n", "a")
    for i, name in enumerate(names):
        own = words.select(F.col("id").alias(name), F.col("word").alias(f"t{i}"), F.col("n").alias(f"f{i}_{i + 1}"), *(["lang"] if not i else []))
        rows = rows.join(own, name)
    for start, stop in [(0, j) for j in range(2, size)] + [(j, size) for j in range(1, size - 1)]:
        part = found[stop - start]
        part = part.select(*[F.col(f"w{i}").alias(f"w{start + i}") for i in range(stop - start)], F.col("n").alias(f"f{start}_{stop}"))
        rows = rows.join(part, [f"w{i}" for i in range(start, stop)])
    cuts = [
        F.struct(_score(F.col("a"), F.col(f"f0_{j}"), F.col(f"f{j}_{size}")).alias("score"), F.lit(j).alias("cut"), F.col(f"f0_{j}").alias("l"), F.col(f"f{j}_{size}").alias("r"))
        for j in range(1, size)
    ]
    lowest = F.array_min(F.array(*cuts))
    phrase = F.concat_ws(" ", *[f"t{i}" for i in range(size)])
    return rows.select("lang", phrase.alias("phrase"), *names, "a", lowest.alias("cut")).select("lang", "phrase", *names, "a", "cut.score", "cut.l", "cut.r")


def _inside_longer(size: int, found: dict[int, DataFrame]) -> DataFrame | None:
    """(w0, ..., longer): of phrases of one length the most occurrences of a longer one that holds them."""
    names = [f"w{i}" for i in range(size)]
    tables = [
        table.select(*[F.col(f"w{start + i}").alias(f"w{i}") for i in range(size)], "n")
        for longer, table in found.items() if longer > size for start in range(longer - size + 1)
    ]
    return reduce(DataFrame.union, tables).groupBy(*names).agg(F.max("n").alias("longer")) if tables else None


def collocations(docs: DataFrame, longest: int = 3, min_count: int = 10, percent: int = 50, top: int = 2_000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of ``docs`` (lang, text).

    Texts are lower-cased (A to Z), cut at ``.,;:!?`` and line ends into pieces and at blanks and tabs into words. A phrase is two to ``longest``
    words in a row within a piece that occur there at least ``min_count`` times (``a``). ``score`` is the lowest floor(1000000 a a / (l r)) of its cuts in
    two, ``l`` and ``r`` the occurrences of the halves (of equal cuts the first); ``n`` are all words of the language. A phrase inside
    a longer one that has ``percent`` of its occurrences is left out. The first ``top`` by score, a, and phrase (in UTF-8 order) are given.

    A NULL language counts as ``und``; NULL and empty texts have no words; a repeated row counts again; a table without words gives no rows; other
    columns are not looked at. Very long texts are read in pieces. Counts above 10 ** 15 are beyond the exact arithmetic and give NULL scores.
    """
    docs = docs.select("lang", "text")
    vocabulary = Vocabulary.of(docs, min_count)
    found = count_phrases(docs, vocabulary, longest, min_count)
    totals = vocabulary.words.groupBy("lang").agg(F.sum("n").alias("n"))
    words = vocabulary.words.where(F.col("n") >= min_count)
    rows = []
    for size in found:
        scored, longer = _scored(size, found, words), _inside_longer(size, found)
        if longer is not None:
            names = [f"w{i}" for i in range(size)]
            scored = scored.join(longer, names, "left").where(F.coalesce(F.col("longer") * 100 < F.col("a") * percent, F.lit(True)))
        rows.append(scored.select("lang", "phrase", "a", "l", "r", "score"))
    best = settle(_first(reduce(DataFrame.union, rows), top), "best_phrases")
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _first(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language; those of each of ``BUCKETS`` parts first, so that no task gets a share that grows with the input."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(BUCKETS))).orderBy(*order)
    some = rows.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint")
    return some.withColumn("rank", rank).where(F.col("rank") <= top)
