"""Language identification of mixed-language text.

A word is a run of letters of one script. Its script leaves the languages that use it as candidates;
character trigrams give it a score for each of them; the cheapest sequence of languages over the words
of a text, with a price for every switch (Viterbi), labels spans.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The scripts told apart, by their Unicode names; other letters are one more.
SCRIPTS = [
    "Latin", "Greek", "Cyrillic", "Armenian", "Hebrew", "Arabic", "Syriac", "Thaana", "Devanagari", "Bengali",
    "Gurmukhi", "Gujarati", "Oriya", "Tamil", "Telugu", "Kannada", "Malayalam", "Sinhala", "Thai", "Lao", "Tibetan",
    "Myanmar", "Georgian", "Hangul", "Ethiopic", "Khmer", "Mongolian", "Hiragana", "Katakana", "Han",
]
BUCKETS = 1 << 16
#: Added to every trigram count.
SMOOTHING = 0.5
#: Share of a language's letters that a script must have to make the language its candidate.
SCRIPT_SHARE = 0.02
#: Price of a switch of language between two words, in natural log units.
SWITCH = 12.0
#: Score of a word in a language that is no candidate.
OUT = -1e4
#: Characters whose spans are sought at once, and whose letters are taken apart at once; a longer text alone.
BATCH_CHARS, LETTER_CHARS = 1 << 21, 1 << 18
#: Rows of which texts are taken from a batch at once.
ROWS = 1024
UNKNOWN = "und"


def letter_tables() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its script (0: no letter, 255: a mark that joins the letter before) and lower case."""
    points = [i for i in range(sys.maxunicode + 1) if not 0xD800 <= i < 0xE000]
    everything = "".join(map(chr, points))
    where = np.array(points, np.int64)
    script = np.zeros(sys.maxunicode + 1, np.uint8)

    def fill(pattern: str, value: int) -> None:
        for found in regex.finditer(pattern, everything):
            script[where[found.start() : found.end()]] = value

    fill(r"\p{L}+", len(SCRIPTS) + 1)
    for i, name in enumerate(SCRIPTS):
        fill(rf"(?:(?=\p{{Script={name}}})\p{{L}})+", i + 1)
    fill(r"\p{M}+", 255)
    lower = np.arange(sys.maxunicode + 1, dtype=np.uint32)
    for found in regex.finditer(r"[\p{Lu}\p{Lt}]", everything):
        small = found.group().lower()
        if len(small) == 1:
            lower[ord(found.group())] = ord(small)
    return script, lower


class _Letters:
    """Words and trigrams of some texts."""

    def __init__(self, texts: list[str], script: np.ndarray, lower: np.ndarray):
        points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), np.uint32)
        edges = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        kind = script[points]
        owner = np.where(kind == 255, -1, np.arange(len(kind)))
        starts_text = np.zeros(len(kind) + 1, bool)
        starts_text[edges] = True
        if (kind == 255).any():  # a mark takes the script of the letter it follows, or is none
            owner = np.maximum.accumulate(np.where(starts_text[:-1], np.arange(len(kind)), owner))
            kind = np.where((kind == 255) & (kind[owner] != 255), kind[owner], kind)
            kind[kind == 255] = 0
        before = np.concatenate((np.zeros(1, np.uint8), kind[:-1]))
        first = (kind != 0) & ((before != kind) | starts_text[:-1])
        self.at = np.flatnonzero(kind)
        first = first[self.at]
        self.first = np.flatnonzero(first)  # of each word, among the letters
        self.points = lower[points[self.at]].astype(np.uint64)
        self.script = kind[self.at[self.first]] if len(self.first) else np.zeros(0, np.uint8)
        self.start = self.at[self.first] if len(self.first) else np.zeros(0, np.int64)
        self.length = np.diff(np.concatenate((self.first, [len(self.at)])))
        #: words of text i are bounds[i]:bounds[i + 1]; offsets of words within their text
        self.bounds = np.searchsorted(self.start, edges)
        self.edges = edges
        left = np.concatenate((np.zeros(1, np.uint64), self.points[:-1]))
        right = np.concatenate((self.points[1:], np.zeros(1, np.uint64)))
        if len(self.points):
            left[first] = 0
            right[np.concatenate((first[1:], [True]))] = 0
        mixed = (left * np.uint64(0x1F123BB5) + self.points) * np.uint64(0x9E3779B97F4A7C15) + right * np.uint64(0xC2B2AE3D27D4EB4F)
        self.buckets = ((mixed * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(48)).astype(np.int64) % BUCKETS


def _portions(texts: list[str], most: int):
    first = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= most:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def _counter(tables):
    """Trigram and script counts by language, summed over what one task reads."""

    def count(batches):
        script, lower = tables.value
        names: dict[str, int] = {}
        trigrams, scripts = np.zeros((0, BUCKETS), np.int64), np.zeros((0, 256), np.int64)
        for batch in batches:
            texts, langs = batch.column("text").to_pylist(), batch.column("lang").to_pylist()
            for first, last in _portions(texts, LETTER_CHARS):
                found = _Letters(texts[first:last], script, lower)
                which = np.array([names.setdefault(x, len(names)) for x in langs[first:last]])
                grow = len(names) - len(trigrams)
                trigrams = np.vstack((trigrams, np.zeros((grow, BUCKETS), np.int64)))
                scripts = np.vstack((scripts, np.zeros((grow, 256), np.int64)))
                of_word = np.repeat(which, np.diff(found.bounds))
                np.add.at(scripts, (of_word, found.script), found.length)
                of_letter = np.repeat(of_word, found.length)
                sums = np.bincount(of_letter * BUCKETS + found.buckets, minlength=len(names) * BUCKETS)
                trigrams += sums.reshape(len(names), BUCKETS)
        for name, i in names.items():
            for base, row in ((0, trigrams[i]), (BUCKETS, scripts[i])):
                at = np.flatnonzero(row)
                if len(at):
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([name] * len(at)), "feature": at + base, "n": row[at],
                    })

    return count


class Model:
    """Languages with their trigram scores and scripts."""

    def __init__(self, langs, scores, allowed, common):
        self.langs, self.scores, self.allowed, self.common = langs, scores, allowed, common

    def score(self, found: _Letters) -> np.ndarray:
        """Score of each word in each language."""
        score = np.empty((len(found.first), len(self.langs)), np.float32)
        if not len(score):
            return score
        for i in range(len(self.langs)):
            score[:, i] = np.add.reduceat(self.scores[i][found.buckets], found.first)
        allowed = self.allowed[found.script]
        score[~allowed] = OUT
        score[~allowed.any(axis=1)] = 0  # a script that no language uses says nothing
        return score

    def spans(self, found: _Letters | _Words) -> np.ndarray:
        """Language of each word."""
        score = found.score if isinstance(found, _Words) else self.score(found)
        n, k = score.shape
        if not n:
            return np.zeros(0, np.int64)
        lengths = np.diff(found.bounds)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        starts, lengths = found.bounds[:-1][order], lengths[order]
        longest = int(lengths[0])
        active = np.searchsorted(-lengths, -np.arange(longest), "left")  # texts with more than t words
        from_best = np.zeros((n, k), bool)
        best_before = np.zeros(n, np.int16)
        value = np.zeros((len(starts), k), np.float32)
        value[:] = score[starts]
        for t in range(1, longest):
            m = active[t]
            at = starts[:m] + t
            now = value[:m]
            best = now.argmax(axis=1)
            switched = (now[np.arange(m), best] - SWITCH)[:, None]
            jump = switched > now
            from_best[at], best_before[at] = jump, best
            now = np.where(jump, switched, now) + score[at]
            now -= now.max(axis=1, keepdims=True)
            value[:m] = now
        state = value.argmax(axis=1)
        label = np.zeros(n, np.int64)
        for t in range(longest - 1, -1, -1):
            m = active[t]
            at = starts[:m] + t
            now = state[:m]
            label[at] = now
            state[:m] = np.where(from_best[at, now], best_before[at], now)
        return label


class _Words:
    """Words of some texts with their scores; letters and trigrams are only held for a part of the texts at a time."""

    def __init__(self, texts: list[str], script: np.ndarray, lower: np.ndarray, model: Model):
        parts, scores, words, chars = [], [], 0, 0
        for a, b in _portions(texts, LETTER_CHARS):
            found = _Letters(texts[a:b], script, lower)
            scores.append(model.score(found))
            parts.append((found.script, found.start + chars, found.length, found.bounds[:-1] + words, found.edges[:-1] + chars))
            words, chars = words + len(found.first), chars + int(found.edges[-1])
        columns = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, np.int64)] * 5
        self.script, self.start, self.length = columns[:3]
        self.bounds, self.edges = (np.concatenate((c, [end])) for c, end in zip(columns[3:], (words, chars)))
        self.score = np.concatenate(scores) if scores else np.zeros((0, len(model.langs)), np.float32)


def train(docs: DataFrame) -> Model:
    """Model of the languages of ``docs`` (text, lang), from the whole of every text.

    Rows with a NULL text or language teach nothing. The model is one row of counts per language, put together by
    Spark, so its size hangs on the number of languages only.
    """
    context = docs.sparkSession.sparkContext
    tables = context.broadcast(letter_tables())
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counts = rows.mapInArrow(_counter(tables), "lang string, feature bigint, n bigint")
    counts = counts.groupBy("lang", "feature").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(counts["lang"].unique())
    which = np.searchsorted(langs, counts["lang"].to_numpy(str)) if langs else np.zeros(0, np.int64)
    total = np.zeros((len(langs), BUCKETS + 256))
    total[which, counts["feature"].to_numpy(np.int64)] = counts["n"].to_numpy(np.float64)
    trigrams, scripts = total[:, :BUCKETS], total[:, BUCKETS:]
    scores = np.log((trigrams + SMOOTHING) / (trigrams.sum(axis=1, keepdims=True) + SMOOTHING * BUCKETS))
    allowed = (scripts >= SCRIPT_SHARE * np.maximum(1, scripts.sum(axis=1, keepdims=True))).T
    return Model(langs, scores.astype(np.float32), allowed, int(scripts.sum(axis=1).argmax()) if langs else -1)


def _labeller(tables, shared, found_fields, without_text: bool):
    def label(batches):
        script, lower = tables.value
        model = Model(**shared.value)
        for batch in (whole.slice(at, ROWS) for whole in batches for at in range(0, whole.num_rows, ROWS)):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for first, last in _portions(texts, BATCH_CHARS):
                found = _Words(texts[first:last], script, lower, model)
                labels = model.spans(found) if model.langs else np.zeros(len(found.start), np.int64)
                rows = []
                for i in range(last - first):
                    a, b = found.bounds[i], found.bounds[i + 1]
                    if a == b or not model.langs:
                        rows.append((UNKNOWN, 0.0, [], 0.0))
                        continue
                    own, length = labels[a:b], found.length[a:b]
                    letters = np.bincount(own, length, minlength=len(model.langs))
                    if not model.allowed[found.script[a:b]].any():
                        letters = np.zeros(len(model.langs))
                        letters[model.common] = 1e-9
                    best = int(letters.argmax())
                    cuts = np.flatnonzero(np.diff(own)) + 1
                    opens, closes = np.concatenate(([0], cuts)), np.concatenate((cuts, [b - a])) - 1
                    start = found.start[a:b] - found.edges[i]
                    spans = [
                        {"start": int(start[o]), "stop": int(start[c] + length[c]), "lang": model.langs[own[o]]}
                        for o, c in zip(opens, closes)
                    ]
                    used = length[model.allowed[found.script[a:b], own]].sum()
                    rows.append((model.langs[best], float(min(1.0, letters[best] / length.sum())), spans, float(used / length.sum())))
                kept = batch.slice(first, last - first).drop_columns(["text"] if without_text else [])
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), found_fields)]
                yield pa.RecordBatch.from_arrays([*kept.columns, *columns], schema=pa.schema([*kept.schema, *found_fields]))

    return label


def label_documents(docs: DataFrame, model: Model, keep_text: bool = False, known: bool = False) -> DataFrame:
    """The columns of ``docs`` (text and others; without text unless ``keep_text``), lang_pred, score and spans.

    ``spans`` (start, stop, lang; code points) are the runs of words of one language in order,
    ``lang_pred`` the language with most letters (of equal ones the first by name) and ``score`` its share
    of the letters. A NULL text and one without a letter give ``und`` with score 0 and no span, as does
    every text where the model knows no language; a text only in scripts that no language uses gets the most frequent
    language with a score near 0. Every row gives one row, repeated ones too; an empty table gives no rows.
    With ``known`` a column of that name has the share of the letters that lie in spans of any language, without words in
    scripts that the span's language does not use.
    Columns of ``docs`` that bear the name of a result are replaced.
    """
    context = docs.sparkSession.sparkContext
    tables, shared = context.broadcast(letter_tables()), context.broadcast(vars(model))
    span = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("lang", pa.string())])
    fields = [pa.field("lang_pred", pa.string()), pa.field("score", pa.float64()), pa.field("spans", pa.list_(span))]
    fields += [pa.field("known", pa.float64())] if known else []
    docs = docs.drop(*[f.name for f in fields])
    names = "lang_pred string, score double, spans array<struct<start:bigint,stop:bigint,lang:string>>"
    found = T._parse_datatype_string(names + (", known double" if known else ""))
    kept = [f for f in docs.schema if keep_text or f.name != "text"]
    return docs.mapInArrow(_labeller(tables, shared, fields, not keep_text), T.StructType([*kept, *found]))


def held_out(doc_id: str) -> Column:
    """Whether a document is kept from training: the CRC-32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``label_documents`` with ``held_out``, by a model of the rows of ``docs`` that are not held out."""
    out = held_out("doc_id")
    model = train(docs.where(~out).select("text", "lang"))
    return label_documents(docs.select("doc_id", "text"), model).select("doc_id", out.alias("held_out"), "lang_pred", "score", "spans")
