"""Mixing to target weights over domains that documents belong to by degrees.

A classifier trained on labelled documents gives every document a probability of each domain. Rates, expected
copies of a document, are fitted so that the expected tokens of each domain meet its target: nonnegative least squares by
projected gradient, in which every step needs one sum over the corpus with a number per domain.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle, unit_draw

#: Labelled documents that the classifier is fitted on at most, those whose ids have the smallest hashes.
SAMPLE = 12_000
FEATURES = 1 << 16
#: Parts in which the hashed sample, at most SAMPLE sparse rows of FEATURES numbers, is trained on. Every iteration brings each part's
#: whole gradient to the driver and, with several parts, shuffles them in a stage more; the driver's heap grows with that.
TRAINING_PARTS = 1
#: Steps at most, and the largest miss of a domain, as a share of all wanted tokens, at which they end.
STEPS, MISS = 60, 1e-4


def words_of(text: Column) -> Column:
    """Words of a text, A-Z and all other capitals lower-cased; none for NULL."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


class Classifier:
    """Domains and the model that tells them apart; without a model the first domain holds everything."""

    def __init__(self, domains: list[str], model):
        self.domains, self.model = domains, model

    def posteriors(self, docs: DataFrame) -> DataFrame:
        """(doc_id, tokens, p): number of words and probability of each domain."""
        rows = docs.select("doc_id", words_of(F.col("text")).alias("words"))
        if self.model is None:
            return rows.select("doc_id", F.size("words").cast("bigint").alias("tokens"), F.array(F.lit(1.0)).alias("p"))
        told = self.model.transform(_features(rows))
        return told.select("doc_id", F.size("words").cast("bigint").alias("tokens"), vector_to_array("probability").alias("p"))


def _features(rows: DataFrame) -> DataFrame:
    return HashingTF(numFeatures=FEATURES, inputCol="words", outputCol="features", binary=True).transform(rows)


def fit_classifier(docs: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> Classifier:
    """Classifier from ``labelled`` (doc_id, domain) and the texts of ``docs`` (doc_id, text).

    Rows with a NULL are ignored, a document labelled with two domains counts for each. At most ``sample`` labelled
    documents are used. One domain, or none (then named "all"), needs no model.
    """
    labelled = labelled.dropna().select("doc_id", "domain").distinct()
    chosen = settle(labelled.orderBy(F.xxhash64("doc_id"), "domain").limit(sample), "labelled")
    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text").join(chosen, "doc_id")
    rows = settle(_features(rows.select("domain", words_of(F.col("text")).alias("words"))).select("domain", "features"), "examples")
    domains = sorted(r["domain"] for r in rows.select("domain").distinct().collect())  # a few domains
    if len(domains) < 2:
        return Classifier(domains or ["all"], None)
    number = F.array_position(F.array(*[F.lit(d) for d in domains]), F.col("domain")) - 1
    training = rows.select("features", number.cast("double").alias("label")).coalesce(TRAINING_PARTS)
    model = LogisticRegression(family="multinomial", regParam=0.002, maxIter=40).fit(training)
    return Classifier(domains, model)


def _replay(p: np.ndarray, steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Rates after the given steps, from 1, and the point ahead of them at which the next gradient is taken."""
    rate = ahead = np.ones(len(p))
    momentum = 1.0
    for step in steps:
        new = np.maximum(0.0, ahead - p @ step)
        after = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        rate, ahead, momentum = new, new + (momentum - 1) / after * (new - rate), after
    return rate, ahead


def _packed(frames):
    """Rows (tokens, p) as blocks of numbers, a row of a block for each."""
    for frame in frames:
        if len(frame):
            block = np.column_stack((frame["tokens"].to_numpy().astype(np.float64), np.vstack(frame["p"].to_numpy())))
            yield pd.DataFrame({"block": [block.tobytes()]})


def _sums(steps: list[np.ndarray], domains: int):
    """Expected tokens of each domain at the current point and at the current rates, of the blocks that one task reads."""

    def work(blocks):
        total = np.zeros((2, domains))
        for row in blocks:
            block = np.frombuffer(row["block"]).reshape(-1, domains + 1)
            tokens, p = block[:, 0], block[:, 1:]
            rate, ahead = _replay(p, steps)
            total += np.vstack(((ahead * tokens) @ p, (rate * tokens) @ p))
        yield total

    return work


def fit_rates(rows: DataFrame, domains: list[str], weights: dict[str, float], total: float | None = None,
              steps: int = STEPS, miss: float = MISS) -> list[np.ndarray]:
    """Steps that lead from rate 1 to the rates; ``rows`` has (tokens, p).

    Least squares of the domains' misses, each relative to the tokens that the domain has. The step of a document
    hangs on its probabilities and the misses alone, so rates are a function of the steps and need no table of their own:
    each task replays them. ``total`` tokens are wanted in all; None means the fewest at which no wanted
    domain has to be thinned. A domain without a weight is not wanted.

    The rows are packed into blocks once, and a step is a plain job over these: a query planned for each of up to ``steps``
    steps would fill the driver's memory with plans, threads and compiled code.
    """
    k = len(domains)
    blocks = settle(rows.select("tokens", "p").mapInPandas(_packed, "block binary"), "blocks").rdd

    def sums(done):
        return blocks.mapPartitions(_sums(done, k)).fold(np.zeros((2, k)), np.add)  # two numbers per domain from each task

    own = sums([])[1]
    share = np.array([max(0.0, weights.get(d, 0.0)) for d in domains])
    share = share / share.sum() if share.sum() else share
    if total is None:
        total = max((o / s for o, s in zip(own, share) if s > 0), default=0.0)
    wanted = share * total
    scale = np.maximum(own, 1e-9)
    done: list[np.ndarray] = []
    ahead, now = own, own
    while len(done) < steps and np.abs(now - wanted).max() > miss * max(total, 1e-9):
        done.append(np.where(own > 0, (ahead - wanted) / scale, 0.0))
        ahead, now = sums(done)
    return done


def mix(
    docs: DataFrame, labelled: DataFrame, weights: dict[str, float], total: float | None = None, sample: int = SAMPLE
) -> DataFrame:
    """(doc_id, tokens, posterior, rate, copies) of every row of ``docs`` (doc_id, text).

    ``labelled`` has (doc_id, domain). ``posterior`` maps domains to probabilities, ``rate`` is nonnegative, and ``copies``
    is the rate rounded up or down by a draw from the doc_id, so that its mean is the rate. Targets that no
    nonnegative rates reach are met as well as least squares can. NULL and empty texts have no tokens and the rate that
    their (prior) probabilities give. Repeated rows are documents of their own but share the draw; a NULL doc_id
    draws as the empty text. An empty table gives no rows; other columns are not looked at.
    """
    classifier = fit_classifier(docs, labelled, sample)
    rows = settle(classifier.posteriors(docs), "posteriors")
    steps = fit_rates(rows.select("tokens", "p"), classifier.domains, weights, total)

    def rate(frames):
        for frame in frames:
            if len(frame):
                yield frame.assign(rate=_replay(np.vstack(frame["p"].to_numpy()), steps)[0])

    rated = rows.mapInPandas(rate, "doc_id bigint, tokens bigint, p array<double>, rate double")
    draw = unit_draw("copies", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return rated.select(
        "doc_id", "tokens",
        F.map_from_arrays(F.array(*[F.lit(d) for d in classifier.domains]), F.col("p")).alias("posterior"),
        "rate",
        (F.floor("rate") + (draw < F.col("rate") - F.floor("rate")).cast("int")).cast("int").alias("copies"),
    )
