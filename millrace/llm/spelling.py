"""Spelling variants of words: PartEnum signatures of letter multisets.

A word's letters, each with the number of equal ones before it, are a binary vector. One inserted, deleted or
replaced letter changes at most two places of it. The places are cut into ``PARTS`` parts; vectors that differ in two
places agree in all parts but two, so words are equi-joined on every choice of all parts but two, and a pair is near only
if its letters say so. One edit also leaves the beginning or the end of a word as it is, so each signature
is tied once to the first and once to the last letters. In a bucket of very many words the sub-words with one letter less are
equi-joined as well, so no bucket costs the square of its size.
"""

from __future__ import annotations

import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle
from .words import mix

#: Places by which one edit changes a letter multiset, at most.
DISTANCE = 2
PARTS = 4
#: Words from which a bucket is joined by its words' parts as well.
LARGE = 2_000
#: A variant's form is at least that many times as frequent.
RATIO = 10
#: Bytes of text whose words are counted at once, and different words that a task holds before it hands them on.
CHUNK_BYTES, HELD = 1 << 20, 400_000

#: Runs of the letters A to Z and U+00C0 to U+00FF, in lower-cased UTF-8; bytes at which no run goes on.
_RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
_GAP = re.compile(rb"[^a-z\x80-\xff]")
#: One in so many (document, word) is read with a letter less.
SLIP = 31


def _runs(text: str) -> Counter:
    """How often each lower-cased run stands in a text."""
    data = text.encode().lower()  # of bytes, lower() changes A to Z only
    found: Counter = Counter()
    at = 0
    while at < len(data):
        gap = _GAP.search(data, at + CHUNK_BYTES)
        end = gap.start() if gap else len(data)
        found.update(_RUN.findall(data[at:end]))
        at = end
    return found


def slipped(doc: str, run: bytes) -> str:
    """The run as it is counted in a document: one of ``SLIP`` loses a letter."""
    h = zlib.crc32(b"%b:%b" % (doc.encode(), run))
    word = run.decode()
    if h % SLIP:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def _count(batches):
    held: Counter = Counter()

    def flush():
        out = pa.RecordBatch.from_pydict({"word": pa.array(list(held), pa.string()), "n": pa.array(list(held.values()), pa.int64())})
        held.clear()
        return out

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            for run, n in _runs(text or "").items():
                held[slipped("" if doc is None else str(doc), run)] += n
            if len(held) > HELD:
                yield flush()
    yield flush()


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of ``docs`` (doc_id, text), counted within tasks before the shuffle; a NULL doc_id counts as the empty text."""
    counted = docs.select("doc_id", "text").mapInArrow(_count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where("word <> ''")


def _multisets(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of some words: the hash of each letter with its number among equal ones, where each word starts, and lengths."""
    texts = words.to_pylist()
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    owner = np.repeat(np.arange(len(texts)), lengths)
    points = points[np.lexsort((points, owner))]
    place = np.arange(len(points))
    first = np.ones(len(points), bool)
    first[1:] = (points[1:] != points[:-1]) | (owner[1:] != owner[:-1])
    number = (place - np.maximum.accumulate(np.where(first, place, 0))).astype(np.uint64)
    return mix(points * np.uint64(0x9E3779B97F4A7C15) + number + np.uint64(1)), starts, lengths


def _signer(end: int, parts: int):
    """Adds each word's length, 64 parity bits of its letters, and its signatures."""
    chosen = list(itertools.combinations(range(parts), max(parts - DISTANCE, 1)))

    def sign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            words = batch.column("word")
            letters, starts, lengths = _multisets(words)
            part = (mix(letters) % np.uint64(parts)).astype(np.int64)
            sums = [np.add.reduceat(np.where(part == p, letters, np.uint64(0)), starts) for p in range(parts)]
            sketch = np.bitwise_xor.reduceat(np.uint64(1) << (letters & np.uint64(63)), starts)
            texts = words.to_pylist()
            ends = [
                np.array([zlib.crc32(t.encode()) for t in side], np.uint64) * np.uint64(2) + np.uint64(i)
                for i, side in enumerate(([t[:end] for t in texts], [t[len(t) - end :] for t in texts]))
            ]
            keys = []
            for number, choice in enumerate(chosen):
                key = np.full(len(texts), number, np.uint64)
                for p in choice:
                    key = mix(key * np.uint64(0x9E3779B97F4A7C15) + sums[p])
                keys += [mix(key ^ mix(e)) for e in ends]
            flat = np.ascontiguousarray(np.stack(keys, axis=1)).view(np.int64).ravel()
            offsets = np.arange(len(texts) + 1, dtype=np.int32) * len(keys)
            yield pa.RecordBatch.from_arrays(
                [words, batch.column("n"), pa.array(lengths.astype(np.int32)), pa.array(sketch.view(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
                names=["word", "n", "length", "sketch", "keys"],
            )

    return sign


def _shortened(word: Column) -> Column:
    """Hashes of a word and of all that it gives with one letter less: words one edit apart have one in common."""
    less = F.transform(
        F.sequence(F.lit(1), F.char_length(word)),
        lambda i: F.xxhash64(F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, F.char_length(word)))),
    )
    return F.array_distinct(F.concat(F.array(F.xxhash64(word)), less))


def near_words(words: DataFrame, min_length: int, parts: int = PARTS, large: int = LARGE) -> DataFrame:
    """(a, n_a, b, n_b), a < b: the pairs of ``words`` (word, n; different, of at least ``min_length`` code points) that one edit makes equal."""
    end = max(0, (min_length - 1) // 2)  # one edit leaves as many letters at one end
    signed = words.select("word", "n").mapInArrow(
        _signer(end, parts), "word string, n bigint, length int, sketch bigint, keys array<bigint>"
    )
    rows = settle(signed.select("word", "n", "length", "sketch", F.explode("keys").alias("key")), "signatures")
    crowded = rows.groupBy("key").agg(F.count("*").alias("_all")).where(F.col("_all") > large).select("key", F.lit(True).alias("_large"))
    rows = rows.join(settle(crowded, "large_buckets"), "key", "left")
    inner = F.when(F.col("_large"), _shortened(F.col("word"))).otherwise(F.array(F.lit(0).cast("bigint")))
    rows = rows.select("key", F.explode(inner).alias("inner"), "word", "n", "length", "sketch")
    names = ["word", "n", "length", "sketch"]
    a = rows.select("key", "inner", *[F.col(c).alias(f"{c}_a") for c in names])
    b = rows.select("key", "inner", *[F.col(c).alias(f"{c}_b") for c in names])
    near = (
        (F.abs(F.col("length_a") - F.col("length_b")) <= 1)
        & (F.bit_count(F.col("sketch_a").bitwiseXOR(F.col("sketch_b"))) <= DISTANCE)
        & (F.col("word_a") < F.col("word_b"))
        & (F.levenshtein("word_a", "word_b", 1) == 1)
    )
    met = a.hint("merge").join(b, (a["key"] == b["key"]) & (a["inner"] == b["inner"]) & near)
    return met.select(F.col("word_a").alias("a"), F.col("n_a"), F.col("word_b").alias("b"), F.col("n_b")).distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): where the forms lead from each word; the way is halved in each round."""
    now = settle(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = settle(now.join(onward, "root", "left").select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_moved")), "roots")
        now = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            return now


def group_variants(counts: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = RATIO, parts: int = PARTS, large: int = LARGE) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of the words of ``counts`` (word, n), each once, long and frequent enough.

    Words are near if exactly one inserted, deleted or replaced code point makes them equal; ``n_near`` counts a word's near words. ``form`` is
    the most frequent of them (of equally frequent ones the first in code-point order) if it is ``ratio`` times as frequent,
    else NULL, as is ``form_n``; ``root`` is where forms lead, the word itself if it has none. NULL words and counts are
    left out, other columns are not looked at, and an empty table gives no rows. Long words cost their length.
    """
    words = counts.where((F.char_length("word") >= min_length) & (F.col("n") >= min_count)).select("word", "n")
    words = settle(words, "words")
    pairs = settle(near_words(words, min_length, parts, large), "near_words")
    turned = pairs.select(F.col("b").alias("a"), F.col("n_b").alias("n_a"), F.col("a").alias("b"), F.col("n_a").alias("n_b"))
    best = F.min(F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("word")))
    found = pairs.union(turned).groupBy(F.col("a").alias("word"), F.col("n_a").alias("n")).agg(F.count("*").alias("n_near"), best.alias("_best"))
    fits = -F.col("_best.n") >= F.col("n") * ratio
    found = found.select(
        "word", "n_near", F.when(fits, F.col("_best.word")).alias("form"), F.when(fits, -F.col("_best.n")).alias("form_n")
    )
    found = settle(found, "forms")
    roots = _roots(found.where("form IS NOT NULL"))
    whole = words.join(found, "word", "left").join(roots, "word", "left")
    return whole.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n"
    )


def document_variants(docs: DataFrame, min_length: int = 7, min_count: int = 2, ratio: int = RATIO) -> DataFrame:
    """``group_variants`` of the words of ``docs`` (doc_id, text).

    Words are runs of the letters A to Z and U+00C0 to U+00FF, A to Z lower-cased; where 31 divides the CRC-32 of ``<doc_id>:<word>``, the
    word loses a letter in that document. NULL and empty texts have no words, a repeated row counts again, an empty table gives
    no rows; texts are read in pieces, whatever their length.
    """
    return group_variants(count_words(docs), min_length, min_count, ratio)
