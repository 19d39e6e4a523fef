"""Toxicity of texts: a weighted lexicon matched by Aho-Corasick over folded words.

Folding lower-cases, turns look-alike letters and digits within words into the letters they stand for, and leaves words with
single blanks between. Entries are whole words and beginnings of words, learned from labelled documents with a weight
each; exception phrases, learned as well, cancel the matches inside them. Summed weights, also by length, give the score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import settle
from .lang_id import held_out

#: Labelled documents that are learned from at most, those whose ids have the smallest hashes.
SAMPLE = 12_000
#: Entries of the lexicon and exception phrases at most, those that tell most.
LEXICON, EXCEPTIONS = 4_000, 4_000
#: Letters of a word's beginning that can be an entry.
SHORTEST, LONGEST = 3, 10
#: An entry stands in so many toxic documents, is so many times as frequent there, and is so sure by its likelihood ratio.
LEAST, LIFT, EVIDENCE = 3, 4.0, 25.0
#: Score from which a document counts as toxic.
THRESHOLD = 0.3
#: Characters of a text that are worked on at once, up to the next line end.
CHUNK_CHARS = 1 << 20
#: Different entries that a task counts before it hands them on.
HELD = 400_000

#: Letters of other scripts that look like Latin ones, digits and signs read as letters, and characters that do not show.
LOOK_ALIKES = str.maketrans(
    "аеіјкмнорстухѕԁԛԝһӏґвαβεικνορτυχηω",
    "aeijkmhopctyxsdqwhlrbabeikvoptuxnw",
)
DIGITS = str.maketrans("0134578@$!|", "oieastbasil")
_HIDDEN = re.compile("[\u00ad\u200b-\u200d\u2060\ufeff]+")
_ODD = re.compile(r"\S*[\u0370-\u052f\uff00-\uffef\U0001d400-\U0001d7ff]\S*")
_SIGNS = re.compile(r"[0134578@$!|]+")
_WORD = re.compile(r"[^\W_]+|\n")


def _plain(found: re.Match) -> str:
    """A word with look-alikes replaced, if it is all Latin then; else as it was."""
    word = found.group()
    latin = unicodedata.normalize("NFKC", word).lower().translate(LOOK_ALIKES)
    return word if _ODD.search(latin) else latin


def _letters(found: re.Match) -> str:
    """Digits and signs as letters, where letters stand on both sides, or where digits begin or end a word of letters."""
    text, run = found.string, found.group()
    before, after = text[found.start() - 1 : found.start()], text[found.end() : found.end() + 1]
    left, right = before.isalpha(), after.isalpha()
    if (left and right) or (right and not before.isalnum() and not run.strip("0134578@$")) or (left and not after.isalnum() and run.isdigit()):
        return run.translate(DIGITS)
    return run


def fold(text: str) -> tuple[str, int]:
    """The folded words of a text between single blanks, line ends as words of their own, and the number of words."""
    text = _HIDDEN.sub("", text.lower())
    if not text.isascii():
        text = _ODD.sub(_plain, text)
    words = _WORD.findall(_SIGNS.sub(_letters, text))
    return f" {' '.join(words)} ", len(words) - words.count("\n")


def _pieces(text: str):
    """A text in pieces of whole lines."""
    at = 0
    while at < len(text):
        end = text.find("\n", at + CHUNK_CHARS) + 1 or len(text)
        yield text[at:end]
        at = end


class Lexicon:
    """Entries (text, weight) and exception phrases, all between or after blanks as in folded text."""

    def __init__(self, entries: list[tuple[str, float]], exceptions: list[str]):
        self.machine = ahocorasick.Automaton()
        for text, weight in entries:
            self.machine.add_word(text, (len(text), weight))
        for text in exceptions:
            self.machine.add_word(text, (len(text), None))
        self.empty = not (entries or exceptions)
        if not self.empty:
            self.machine.make_automaton()

    def hits(self, folded: str) -> dict[int, float]:
        """Where words match (the blank before them), and the weight of the best entry; words inside an exception do not."""
        found: dict[int, float] = {}
        spared = []
        if self.empty:
            return found
        for end, (length, weight) in self.machine.iter(folded):
            start = end - length + 1
            if weight is None:
                spared.append((start, end))
            elif found.get(start, 0.0) < weight:
                found[start] = weight
        for start, end in spared:
            for at in [at for at in found if start <= at < end]:
                del found[at]
        return found

    def weigh(self, text: str) -> tuple[float, int, int]:
        """Sum of the weights, matches and words of a text."""
        total, matches, words = 0.0, 0, 0
        for piece in _pieces(text):
            folded, n = fold(piece)
            found = self.hits(folded)
            total += sum(found.values())
            matches += len(found)
            words += n
        return total, matches, words


def _features(text: str) -> set[str]:
    words: set[str] = set()
    for piece in _pieces(text):
        words.update(fold(piece)[0].split(" "))
    words -= {"", "\n"}
    found = {f" {w} " for w in words}
    for w in words:
        found.update([f" {w[:k]}" for k in range(SHORTEST, min(len(w), LONGEST) + 1)])
    return found


def _contexts(lexicon: Lexicon, text: str) -> set[str]:
    """The matched words of a text, alone and with the word before or after."""
    found: set[str] = set()
    for piece in _pieces(text):
        folded = fold(piece)[0]
        for start in lexicon.hits(folded):
            end = folded.index(" ", start + 1) + 1
            found.add(folded[start:end])
            after = folded.find(" ", end)
            if after >= 0:
                found.add(folded[start : after + 1])
            if start:
                found.add(folded[folded.rindex(" ", 0, start) : end])
    return {f for f in found if "\n" not in f}


def _counted(examples: DataFrame, features_of) -> DataFrame:
    """(feature, clean, toxic): in how many documents of each label each feature stands, counted within tasks first."""

    def count(batches):
        held: dict[str, list[int]] = defaultdict(lambda: [0, 0])

        def flush():
            pairs = list(held.values())
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), *(pa.array([p[i] for p in pairs], pa.int64()) for i in (0, 1))], names=["feature", "clean", "toxic"]
            )
            held.clear()
            return out

        for batch in batches:
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                for feature in features_of(text or ""):
                    held[feature][label] += 1
                if len(held) > HELD:
                    yield flush()
        yield flush()

    counted = examples.mapInArrow(count, "feature string, clean bigint, toxic bigint")
    return counted.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _evidence(clean: int, toxic: int):
    """Likelihood ratio of a feature being more frequent with one label, as a column."""

    def part(k, n, share):
        some = F.when(k > 0, k * F.log(share)).otherwise(0.0)
        return some + F.when(k < n, (n - k) * F.log(1 - share)).otherwise(0.0)

    c, t, both = F.col("clean"), F.col("toxic"), (F.col("clean") + F.col("toxic")) / float(clean + toxic)
    return 2 * (part(t, toxic, t / float(toxic)) + part(c, clean, c / float(clean)) - part(t, toxic, both) - part(c, clean, both))


def _measures(weights: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What the score is made of: a constant, and the weights as such, by length and by its root."""
    weights, words = np.asarray(weights, float), np.asarray(words, float)
    by_root = weights / np.sqrt(np.maximum(words, 1.0))
    return np.stack([np.ones(len(weights)), np.log1p(weights), np.log1p(1000 * weights / (words + 20)), np.log1p(by_root)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.01, rounds: int = 50) -> np.ndarray:
    b = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(b)), x.T @ (y - p) - ridge * b)
        b = b + step
        if np.abs(step).max() < 1e-9:
            break
    return b


def train(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> dict:
    """Entries, exceptions and the numbers that turn weights into a score.

    ``docs`` has (doc_id, text), ``labelled`` (doc_id, label) with label 1 for toxic; rows with a NULL or another label
    teach nothing, a document with both labels counts for both. At most ``sample`` of them are used.
    Without documents of both labels there are no entries, and every score is the share of toxic ones (0 without any).
    """
    labelled = labelled.where("label IN (0, 1)").dropna().select("doc_id", F.col("label").cast("int").alias("label")).distinct()
    chosen = settle(labelled.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample), "labelled")
    examples = settle(docs.where("text IS NOT NULL").select("doc_id", "text").join(chosen, "doc_id").select("label", "text"), "examples")
    count = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    clean, toxic = count.get(0, 0), count.get(1, 0)
    if not clean or not toxic:
        return {"entries": [], "exceptions": [], "numbers": None, "share": float(toxic > 0)}
    enough = (F.col("toxic") >= LEAST) & (F.col("toxic") / toxic > F.col("clean") / clean * LIFT)
    sure = _counted(examples, _features).where(enough).withColumn("sure", _evidence(clean, toxic)).where(F.col("sure") >= EVIDENCE)
    sure = sure.orderBy(F.desc("sure"), "feature").limit(LEXICON).collect()
    entries = [
        (r["feature"], (math.log((r["toxic"] + 0.5) / (toxic + 1)) - math.log((r["clean"] + 0.5) / (clean + 1))) ** 2) for r in sure
    ]

    def contexts():
        made = []  # by the first text of a task

        def of(text):
            made or made.append(Lexicon(entries, []))
            return _contexts(made[0], text)

        return of

    harmless = _counted(examples, contexts()).where((F.col("clean") >= LEAST) & (F.col("clean") / clean > F.col("toxic") / toxic))
    harmless = harmless.withColumn("sure", _evidence(clean, toxic)).orderBy(F.desc("sure"), "feature").limit(EXCEPTIONS).collect()
    model = {"entries": entries, "exceptions": [r["feature"] for r in harmless], "numbers": None, "share": 0.0}
    weighed = _weighed(examples, model).select("label", "weight", "words").toPandas()  # at most a row per sampled document
    x = _measures(weighed["weight"].to_numpy(), weighed["words"].to_numpy())
    order = np.lexsort((*x.T, weighed["label"].to_numpy()))  # sums do not hang on how Spark dealt the rows
    model["numbers"] = _logistic(x[order], weighed["label"].to_numpy(float)[order]).tolist()
    return model


def _weighed(docs: DataFrame, model: dict) -> DataFrame:
    """The columns of ``docs`` but text, with weight, matches and words."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in docs.schema if f.name != "text"]

    def weigh(batches):
        lexicon = Lexicon(shared.value["entries"], shared.value["exceptions"])
        for batch in batches:
            found = [lexicon.weigh(t or "") for t in batch.column("text").to_pylist()]
            weight, matches, words = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in kept), pa.array(weight, pa.float64()), pa.array(matches, pa.int64()), pa.array(words, pa.int64())],
                names=[*(f.name for f in kept), "weight", "matches", "words"],
            )

    schema = T.StructType([*kept, *T._parse_datatype_string("weight double, matches bigint, words bigint")])
    return docs.mapInArrow(weigh, schema)


def score_documents(docs: DataFrame, model: dict, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted, matches) of every row of ``docs`` (doc_id, text).

    ``score`` (0 to 1) rises with the weights of the words that match an entry and lie in no exception phrase; ``matches`` counts
    them, ``predicted`` is 1 from ``threshold`` on. Phrases do not reach over line ends. A NULL or empty text scores as
    one without a match; repeated rows give a row each, a NULL doc_id stays NULL, an empty table gives no rows and other columns are not
    looked at. Whole texts are read, very long ones in pieces of whole lines.
    """
    weighed = _weighed(docs.select("doc_id", "text"), model)
    if model["numbers"] is None:
        score = F.lit(model["share"])
    else:
        constant, plain, by_length, by_root = (F.lit(b) for b in model["numbers"])
        w, n = F.col("weight"), F.col("words").cast("double")
        sum_ = constant + plain * F.log1p(w) + by_length * F.log1p(1000 * w / (n + 20)) + by_root * F.log1p(w / F.sqrt(F.greatest(n, F.lit(1.0))))
        score = 1 / (1 + F.exp(-sum_))
    return weighed.select("doc_id", score.alias("score"), "matches").select(
        "doc_id", "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "matches"
    )


def judge(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``score_documents`` with ``held_out``, learned from those of ``labels`` (doc_id, toxic) whose document is not held out."""
    labelled = labels.where(~held_out("doc_id")).select("doc_id", F.col("toxic").alias("label"))
    found = score_documents(docs, train(docs, labelled), threshold)
    return found.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "matches")
