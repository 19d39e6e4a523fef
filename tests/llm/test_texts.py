"""Languages, near-duplicate documents, token ids and mixing."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import lang_id, minhash_lsh, soft_mix, trie_bpe
from millrace.llm.q_texts import vocabulary_path

SF = "/root/testdata/sf0.001"


def docs_of(spark, rows, more="lang string, score string, copies string"):
    width = len(more.split(","))
    return spark.createDataFrame([(i, t, *["x"] * width) for i, t in rows], f"doc_id bigint, text string, {more}")


# languages

SPEECH = {
    "en": "the cat and the dog went with this house that was there when they thought about other things which",
    "de": "der Hund und die Katze gingen nicht über das Haus ich habe schöne Füße durch zwischen möchte werden",
    "ru": "кошка и собака пошли вместе в этот дом который был там когда они думали о других вещах",
    "el": "η γάτα και ο σκύλος πήγαν μαζί σε αυτό το σπίτι που ήταν εκεί όταν σκέφτονταν άλλα πράγματα",
}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, lang) for lang, t in SPEECH.items()] * 3 + [(None, "en"), ("nothing", None), ("", "de"), ("123", "fr")]
    return lang_id.train(spark.createDataFrame(rows, "text string, lang string"))


def test_spans_of_mixed_text(spark, model):
    text = f"{SPEECH['en']}. 12 {SPEECH['ru']}, {SPEECH['de']}"
    row = lang_id.label_documents(docs_of(spark, [(1, text)]), model).first()
    assert [(s["lang"], text[s["start"] : s["stop"]]) for s in row["spans"]] == [(x, SPEECH[x]) for x in ("en", "ru", "de")]


def test_odd_texts(spark, model):
    rows = [
        (1, None), (2, ""), (3, " 12 !? \n"), (4, "日本語"), (5, "Haus"), (5, "Haus"), (None, "дом"), (6, "the house. " * 30000),
        (7, "THE HOUSE"), (8, "́"), (9, "σπίτι"), (10, "the " + "x" * 200_000), (11, "the дом"),
    ]
    docs = docs_of(spark, rows)
    got = lang_id.label_documents(docs, model)
    assert got.columns == ["doc_id", "lang", "copies", "lang_pred", "score", "spans"]
    rows = [(r["doc_id"], r["lang_pred"], r["score"]) for r in got.collect()]
    assert len(rows) == 13 and all(0 <= r[2] <= 1 for r in rows)
    said = {r[0]: r[1:] for r in rows}
    assert said[1] == said[2] == said[3] == said[8] == ("und", 0.0)
    assert said[4][0] in model.langs and said[4][1] < 0.01
    assert (said[5][0], said[None][0], said[6][0], said[7][0], said[9][0]) == ("de", "ru", "en", "en", "el")
    assert lang_id.label_documents(docs.limit(0), model).collect() == []
    kept = lang_id.label_documents(docs, model, keep_text=True)
    assert "text" in kept.columns and kept.count() == 13


def test_no_language_to_learn(spark):
    empty = lang_id.train(spark.createDataFrame([], "text string, lang string"))
    row = lang_id.label_documents(docs_of(spark, [(1, "words")]), empty).first()
    assert (row["lang_pred"], row["score"]) == ("und", 0.0)


def test_viterbi_against_all_paths(model, monkeypatch):
    import itertools

    monkeypatch.setattr(lang_id, "SWITCH", 1.5)
    tables = lang_id.letter_tables()
    texts = ["der the und", "Katze dog", "the der die that", ""]
    found = lang_id._Letters(texts, *tables)
    labels = model.spans(found)
    k = len(model.langs)
    for i in range(len(texts)):
        a, b = found.bounds[i], found.bounds[i + 1]
        if a == b:
            continue
        score = np.array([[model.scores[j][found.buckets[f : f + n]].sum() for j in range(k)] for f, n in zip(found.first[a:b], found.length[a:b])])
        score[~model.allowed[found.script[a:b]]] = lang_id.OUT

        def worth(path):
            return sum(score[t, p] for t, p in enumerate(path)) - 1.5 * sum(x != y for x, y in zip(path, path[1:]))

        best = max(worth(p) for p in itertools.product(range(k), repeat=b - a))
        assert worth(list(labels[a:b])) == pytest.approx(best, abs=1e-3)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").union(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("doc_id", F.col("doc_id") + 10_000)
    )
    got = lang_id.identify(docs.select("doc_id", "text", "lang")).join(docs.select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").agg(F.count("*"), F.count_if(F.col("lang") == F.col("lang_pred"))).first()
    assert held[0] > 200 and held[1] >= 0.98 * held[0]


# near-duplicates


def sets_of(text, size):
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)})) if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_groups(rows, size):
    sets = [sets_of(t, size) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if rows[i][0] is not None and rows[j][0] is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        same = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(same) if d is not None else None
        out.append((d, len(sets[i]), least, d is None or d == least))
    return out


def near_rows(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 12, 60, 150]))] for _ in range(25)]
    rows = []
    for i in range(180):
        text = list(base[i % 25] if i % 4 else base[i % 3])
        for _ in range(rng.choice([0, 0, 1, 2, 6, 14])):
            text[rng.randrange(len(text))] = rng.choice(words)
        rows.append((1000 - i, rng.choice([" ", "\n", "  "]).join(text)))
    rows += [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "One"), (2004, "oNE "), (2005, "one two"), (None, rows[0][1]), rows[3]]
    return rows + [(2006, "ÄB c d"), (2007, "Äb c d"), (2008, "äb c d"), (2009, "long " * 60_000)]


@pytest.mark.parametrize("size,large", [(2, 8), (5, 1)])
def test_near_duplicates(spark, monkeypatch, size, large):
    monkeypatch.setattr(minhash_lsh, "LARGE", large)
    monkeypatch.setattr(minhash_lsh, "BLOCK", 32)
    rows = near_rows(size)
    got = minhash_lsh.near_duplicates(docs_of(spark, rows, "component_id string"), size)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute_groups(rows, size)))


def test_no_documents(spark):
    assert minhash_lsh.near_duplicates(docs_of(spark, [])).collect() == []
    assert [tuple(r) for r in minhash_lsh.near_duplicates(docs_of(spark, [(4, None)])).collect()] == [(4, 0, 4, True)]


# token ids


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(vocabulary_path())


ODD_TEXTS = [
    "", " ", "  a", "\n\n x \t y", "<|endoftext|>hi<|endoftext|>", "a<|endoftext|> <|endoftext|>b", "\x1c\x1d a\x85b　c",
    "aaaaaaaaaaaaaaaa" * 5, "😀😀 日本語テキスト ñandú 123,456 don't I'LL we've", "²³ⅧⅨ①", "﻿​ zero", " " * 50 + "x",
    "the the  the   the", "́é", "\x00", "it's'll", "word " * 20_000,
]


def random_texts():
    rng = random.Random(2)
    letters = "abcdehilnorst  '\n\t.,0é日😀²_-\xa0ABTH"
    out = ["".join(rng.choice(letters) for _ in range(rng.randrange(50))) for _ in range(600)]
    return out + ["".join(rng.choice("aeiouths l"[:n]) for _ in range(rng.randrange(70))) for n in (2, 4, 10) for _ in range(300)]


def test_ids_and_texts_as_the_library_has_them(library):
    coder = trie_bpe.Coder(trie_bpe.read_vocabulary(vocabulary_path()))
    texts = ODD_TEXTS + random_texts()
    for text, ids, want in zip(texts, coder.encode(texts), library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(ids, "<u4").tolist() == want.ids, text[:60]
        assert coder.decode(ids) == library.decode(want.ids, skip_special_tokens=False) == text


def test_forgetting_changes_nothing(monkeypatch, library):
    monkeypatch.setattr(trie_bpe, "REMEMBERED", 20)
    monkeypatch.setattr(trie_bpe, "STEPS", 0)
    coder = trie_bpe.Coder(trie_bpe.read_vocabulary(vocabulary_path()))
    for text in random_texts()[:300] * 2:
        assert np.frombuffer(coder.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_ids_that_are_no_text():
    coder = trie_bpe.Coder(trie_bpe.read_vocabulary(vocabulary_path()))
    assert coder.decode(np.array([coder.encoder.ids[b"\xff"], 70_000], "<u4").tobytes()) == "�"


def test_documents_to_ids(spark, library):
    rows = [(i, t) for i, t in enumerate(ODD_TEXTS)] + [(99, None), (None, "x"), (1, " ")]
    docs = docs_of(spark, rows, "ids string")
    got = trie_bpe.encode_documents(docs, vocabulary_path()).collect()
    assert sorted((str(r["doc_id"]), list(r["ids"])) for r in got) == sorted(
        (str(i), library.encode(t or "", add_special_tokens=False).ids) for i, t in rows
    )
    digests = {r["doc_id"]: tuple(r)[1:] for r in trie_bpe.digest_documents(docs, vocabulary_path()).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert digests[99] == digests[0] == (0, nothing, nothing)
    ids = np.array(library.encode(ODD_TEXTS[4], add_special_tokens=False).ids, "<u4").tobytes()
    assert digests[4] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(ODD_TEXTS[4].encode()).hexdigest())
    assert trie_bpe.encode_documents(docs.limit(0), vocabulary_path()).collect() == []


# mixing

WEIGHTS = {"good": 0.5, "bad": 0.5}


def mixed_docs(spark):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["apple", "pear", "plum"] if i % 4 else ["iron", "tin", "zinc"]) for _ in range(rng.randrange(1, 40)))) for i in range(400)]
    rows += [(500, None), (501, ""), (None, "apple tin"), (7, rows[7][1]), (502, "pear " * 40_000)]
    labelled = spark.createDataFrame([(i, "good" if i % 4 else "bad") for i in range(0, 400, 3)] + [(None, "good"), (1, None), (9999, "bad")], "doc_id bigint, domain string")
    return docs_of(spark, rows, "rate string"), labelled, rows


def test_targets_are_met_and_rates_are_optimal(spark):
    docs, labelled, rows = mixed_docs(spark)
    got = soft_mix.mix(docs, labelled, WEIGHTS, total=60_000.0).collect()
    assert len(got) == len(rows)
    totals = {d: sum(r["rate"] * r["tokens"] * r["posterior"][d] for r in got) for d in WEIGHTS}
    assert all(abs(v - 30_000) < 100 for v in totals.values())
    for r in got:
        assert r["rate"] >= 0 and r["copies"] in (int(r["rate"]), int(r["rate"]) + 1)
        assert sum(r["posterior"].values()) == pytest.approx(1)
    by = {r["doc_id"]: r for r in got}
    assert by[500]["tokens"] == by[501]["tokens"] == 0 and by[502]["tokens"] == 40_000
    right = sum((by[i]["posterior"]["good"] > 0.5) == bool(i % 4) for i in range(400))
    assert right >= 396


def test_least_squares_against_a_plain_solver(spark):
    rng = np.random.default_rng(6)
    p = rng.dirichlet([0.4, 0.4, 0.4], 300)
    tokens = rng.integers(1, 100, 300)
    rows = spark.createDataFrame([(int(t), [float(x) for x in q]) for t, q in zip(tokens, p)], "tokens bigint, p array<double>")
    own = p.T @ tokens
    weights = {"a": 0.9, "b": 0.1, "c": 0.0}
    total = float(tokens.sum())
    steps = soft_mix.fit_rates(rows, ["a", "b", "c"], weights, total, steps=45, miss=0)
    rate, _ = soft_mix._replay(p, steps)
    wanted = np.array([0.9, 0.1, 0.0]) * total

    def loss(r):
        return (((p * tokens[:, None]).T @ r - wanted) ** 2 / own).sum()

    plain = np.ones(300)
    for _ in range(20_000):
        plain = np.maximum(0, plain - p @ (((p * tokens[:, None]).T @ plain - wanted) / own))
    assert loss(rate) <= loss(plain) + 0.002 * loss(np.ones(300))
    gradient = p @ (((p * tokens[:, None]).T @ rate - wanted) / own)
    assert (gradient[rate <= 0] > -0.02).all() and np.abs(gradient[rate > 0.01]).max() < 0.02


def test_an_iteration_of_training_is_one_stage_with_one_gradient(spark):
    docs, labelled, _ = mixed_docs(spark)
    context = spark.sparkContext
    context.setJobGroup("training", "iterations of the classifier")
    try:
        told = soft_mix.fit_classifier(docs.repartition(8), labelled)
    finally:
        for key in ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel"):
            context.setLocalProperty(key, None)
    assert told.domains == ["bad", "good"] and told.model.numFeatures == soft_mix.FEATURES
    tracker = context.statusTracker()
    jobs = [tracker.getJobInfo(i) for i in tracker.getJobIdsForGroup("training")]
    stages = [[tracker.getStageInfo(s) for s in job.stageIds] for job in jobs]
    iterations = [job for job in stages if any("treeAggregate" in s.name for s in job if s)]
    assert len(iterations) > 3
    assert all(len(job) == 1 and job[0].numTasks == 1 for job in iterations)


def test_steps_are_sums_over_all_rows_and_plan_no_queries(spark):
    rng = np.random.default_rng(7)
    p = rng.dirichlet([0.5, 0.5], 500)
    tokens = rng.integers(1, 100, 500)
    rows = spark.createDataFrame([(int(t), [float(x) for x in q]) for t, q in zip(tokens, p)], "tokens bigint, p array<double>")
    own, total = p.T @ tokens, float(tokens.sum())
    context = spark._jsc.sc()
    planned = spark._jsparkSession.sharedState().statusStore()

    def queries():
        context.listenerBus().waitUntilEmpty(30_000)
        return planned.executionsList().iterator().toSeq().last().executionId() if planned.executionsCount() else -1

    spark.range(1).collect()
    before = queries()
    steps = soft_mix.fit_rates(rows.repartition(3), ["a", "b"], {"a": 1.0, "b": 0.0}, total, steps=25, miss=0)
    assert len(steps) == 25 and queries() - before <= 3

    expected = []
    for _ in range(25):
        ahead = soft_mix._replay(p, expected)[1]
        expected.append(((ahead * tokens) @ p - np.array([total, 0.0])) / own)
    assert np.allclose(steps, expected, rtol=1e-9, atol=1e-9)


def test_mixing_of_few_domains_and_no_rows(spark):
    docs, labelled, rows = mixed_docs(spark)
    one = soft_mix.mix(docs, labelled.where("domain = 'good'"), {"good": 1.0}).collect()
    assert {round(r["rate"], 6) for r in one} == {1.0} and {r["copies"] for r in one} == {1}
    none = soft_mix.mix(docs, labelled.limit(0), {"good": 1.0}).collect()
    assert len(none) == len(rows) and {r["rate"] for r in none} == {0.0}
    assert soft_mix.mix(docs.limit(0), labelled, WEIGHTS).collect() == []
