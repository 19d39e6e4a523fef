"""Similarity joins against brute force over all pairs of a small fixture with a hot group."""

import random
from functools import partial

import pytest
from pyspark.sql import functions as F

from millrace.operators import block_join, minhash, prefix_join, segment_join, vector_join
from millrace.operators import token_sets as token_sets_module
from millrace.operators.buckets import bucket_join, large_buckets
from millrace.operators.token_sets import copy_links, distinct_sets, hashed_sets, token_sets
from millrace.operators.vector_join import near_vectors


def make_texts(n=240, seed=3):
    """A third of the rows near or exact copies of one text, the rest random and small families."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    common = ["the", "and", "of"]
    hot = rng.sample(words, 40)
    rows = [(-1, None), (-2, ""), (-3, "  \n "), (-4, "single"), (-5, "Single")]
    for i in range(n):
        kind = i % 3
        if kind == 0:
            text = list(hot)
            for _ in range(rng.choice([0, 0, 1, 2, 6])):
                text[rng.randrange(40)] = rng.choice(words)
        elif kind == 1:
            text = rng.sample(words, rng.randrange(1, 60)) + common
        else:
            base = random.Random(i // 12).sample(words, 25)
            text = [w for w in base if rng.random() < 0.93] + common
        rows.append((i, " ".join(text)))
    return rows


def brute(rows_a, rows_b, distance, same):
    def sets(rows):
        found = {}
        for i, text in rows:
            key = frozenset((text or "").lower().split())
            if key:
                ids = found.setdefault(key, [])
                ids.append(i)
        return {min(ids): key for key, ids in found.items()}

    a, b = sets(rows_a), sets(rows_b)
    out = set()
    for i, x in a.items():
        for j, y in b.items():
            if same and i >= j:
                continue
            share, either = len(x & y), len(x | y)
            if share * 1000 > either * round(1000 * (1 - distance)):
                out.add((i, j, round(1 - share / either, 6)))
    return out


def pairs(df):
    return {(r["id_a"], r["id_b"], r["distance"]) for r in df.collect()}


@pytest.fixture(scope="module")
def texts(spark):
    rows = make_texts()
    return rows, spark.createDataFrame(rows, "id bigint, text string").repartition(4).cache()


@pytest.mark.parametrize("distance", [0.1, 0.2, 0.5])
@pytest.mark.parametrize("bucket_rows,sample", [(5, 1.0), (10, 0.5), (20_000, 0.01)])
def test_exact_join_finds_every_pair(texts, distance, bucket_rows, sample):
    rows, df = texts
    found = segment_join.exact_near_pairs(df, "id", "text", distance, bucket_rows, sample)
    assert pairs(found) == brute(rows, rows, distance, True)


@pytest.mark.parametrize("distance, matches", [(0.1, 1), (0.2, None), (0.4, 3), (0.6, None), (0.7, 20), (0.9, None)])
def test_prefix_join_finds_every_pair(texts, distance, matches):
    rows, df = texts
    found = prefix_join.prefix_near_pairs(df, "id", "text", distance, matches)
    assert pairs(found) == brute(rows, rows, distance, True)


def test_prefix_join_of_two_tables_under_any_order(spark, texts, monkeypatch):
    rows, df = texts
    other = [(i + 1000, t) for i, t in make_texts(60, seed=9)] + rows[5:40]
    df_b = spark.createDataFrame(other, "key bigint, body string")
    want = brute(rows, other, 0.7, False)
    assert pairs(prefix_join.prefix_near_pairs_between(df, df_b, "id", "key", "text", "body", 0.7)) == want
    few = prefix_join.token_order
    monkeypatch.setattr(prefix_join, "token_order", lambda sets: few(sets, rows=10))
    assert pairs(prefix_join.prefix_near_pairs_between(df, df_b, "id", "key", "text", "body", 0.7)) == want
    assert prefix_join.prefix_near_pairs_between(df, df_b.limit(0), "id", "key", "text", "body", 0.7).collect() == []


def test_prefix_join_tests_few_pairs(texts):
    """Candidates are a small multiple of the answer even where thresholds are loose."""
    rows, df = texts
    sets = distinct_sets(token_sets(df, "id", "text")).cache()
    shown = prefix_join.prefixes(sets, 0.6, prefix_join.token_order([sets]), 8)
    met = prefix_join.prefix_candidates(shown, shown, 0.6, 8, True).count()
    assert met <= 3 * len(brute(rows, rows, 0.6, True))


def test_exact_join_of_two_tables(spark, texts):
    rows, df = texts
    other = [(i + 1000, t) for i, t in make_texts(60, seed=9)] + rows[5:40]
    df_b = spark.createDataFrame(other, "key bigint, body string")
    found = segment_join.exact_near_pairs_between(df, df_b, "id", "key", "text", "body", 0.4)
    assert pairs(found) == brute(rows, other, 0.4, False)


@pytest.mark.parametrize("bucket_rows", [5, 20_000])
def test_minhash_join_is_never_wrong_and_rarely_misses(texts, bucket_rows):
    rows, df = texts
    found = pairs(minhash.minhash_near_pairs(df, "id", "text", 0.2, bucket_rows=bucket_rows, sample=1.0))
    expected = brute(rows, rows, 0.2, True)
    assert found <= expected
    assert len(found) >= 0.99 * len(expected) > 100


def test_large_buckets_do_not_change_the_minhash_result(texts):
    _, df = texts
    plain = pairs(minhash.minhash_near_pairs(df, "id", "text", 0.3))
    cut = pairs(minhash.minhash_near_pairs(df, "id", "text", 0.3, bucket_rows=3, sample=1.0))
    assert plain == cut


def test_sketches_drop_no_near_pair(texts):
    rows, df = texts
    sets = distinct_sets(token_sets(df, "id", "text"))
    signed = minhash.signatures(sets, 1, sketch=True).drop("m0").collect()
    bits = {r["id"]: [r[f"s{i}"] & (2**64 - 1) for i in range(minhash.SKETCH)] for r in signed}
    words = {r["id"]: set(r["tokens"]) for r in sets.collect()}
    for i in words:
        for j in words:
            differing = sum((x ^ y).bit_count() for x, y in zip(bits[i], bits[j]))
            assert differing <= len(words[i] ^ words[j])


def test_miss_rate_of_chosen_bands():
    for distance in (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8):
        for miss in (0.001, 1e-6):
            assert minhash.miss_rate(distance, *minhash.choose_bands(distance, miss)) <= miss
    for distance in (0.05, 0.1, 0.2, 0.3, 0.4, 0.5):
        bands, rows = minhash.choose_bands(distance)
        assert bands * rows <= minhash.HASHES


def test_copies_are_links_not_pairs(spark):
    rows = [(i, "same words here") for i in range(100)] + [(200, "Here words SAME same"), (201, "other")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    sets = token_sets(df, "id", "text")
    links = {r["id"]: r["rep"] for r in copy_links(sets).collect()}
    assert links == {**{i: 0 for i in range(100)}, 200: 0, 201: 201}
    assert {r["id"]: r["copies"] for r in distinct_sets(sets).collect()} == {0: 101, 201: 1}


def test_six_sentences_over_twenty_hash_buckets(spark):
    # Sentences whose distances over 20 buckets are known.
    a = ["Hi I heard about Spark", "I wish Java could use case classes", "Logistic regression models are neat"]
    b = ["hi i heard about spark", "I wish if scala could be use jvm", "machine learning models are neat "]
    df_a = spark.createDataFrame(list(enumerate(a)), "id bigint, sentence string")
    df_b = spark.createDataFrame(list(enumerate(b)), "id bigint, sentence string")
    found = segment_join.exact_near_pairs_between(
        df_a, df_b, "id", "id", "sentence", "sentence", 0.7, sets_of=partial(hashed_sets, features=20)
    )
    assert sorted(round(r["distance"], 4) for r in found.collect()) == [0.0, 0.5556, 0.5714]


def test_stop_words_do_not_count(spark):
    df = spark.createDataFrame([(1, "the cat and dog"), (2, "CAT dog"), (3, "the and")], "id bigint, text string")
    sets = token_sets(df, "id", "text", ["the", "and"])
    assert {r["id"]: sorted(r["tokens"]) for r in sets.collect()} == {1: ["cat", "dog"], 2: ["cat", "dog"]}


def test_bucket_join_meets_every_pair_once(spark):
    left = spark.createDataFrame([(i % 3 // 2, i) for i in range(90)], "k int, a int")
    right = spark.createDataFrame([(i % 4 // 3, i) for i in range(80)], "k int, b int")
    parts_a, parts_b = large_buckets(left, ["k"], 7), large_buckets(right, ["k"], 9)
    met = bucket_join(left, right, ["k"], F.col("a") != F.col("b"), "a", "b", parts_a, parts_b)
    got = sorted((r["a"], r["b"]) for r in met.collect())
    expected = sorted((a, b) for a in range(90) for b in range(80) if a % 3 // 2 == b % 4 // 3 and a != b)
    assert got == expected


def test_near_vectors_equal_all_pairs(spark):
    rng = random.Random(1)
    dim, rows = 16, []
    for i in range(120):
        base = random.Random(i // 4).choices(range(-50, 50), k=dim)
        rows.append((i, [float(x) + rng.gauss(0, 2) for x in base]))
    rows += [(200, rows[0][1]), (201, [0.0] * dim)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")

    def cosine(x, y):
        return 1 - sum(p * q for p, q in zip(x, y)) / (sum(p * p for p in x) * sum(q * q for q in y)) ** 0.5

    kept = [r for r in rows if r[0] < 200]
    for distance in (0.001, 0.02):
        expected = {(i, j) for i, x in kept for j, y in kept if cosine(x, y) < distance}
        for bucket_rows in (3, 20_000):
            found = near_vectors(
                df, df, "id", "id", F.col("v"), F.col("v"), dim, distance, bucket_rows=bucket_rows, sample=1.0
            ).collect()
            assert len(found) == len(expected)
            assert {(r["id_a"], r["id_b"]) for r in found} == expected


def test_vectors_of_mixed_lengths_at_loose_distances(spark):
    rng = random.Random(4)
    rows = []
    for i in range(150):
        base = random.Random(i // 5)
        length = base.choice([1, 2, 3, 8, 12, 16, 33])
        centre = [base.gauss(0, 1) for _ in range(length)]
        rows.append((i, [x + rng.gauss(0, 0.25) for x in centre]))
    rows += [(200, []), (201, None), (202, [0.0] * 8)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")

    def cosine(x, y):
        return 1 - sum(p * q for p, q in zip(x, y)) / (sum(p * p for p in x) * sum(q * q for q in y)) ** 0.5

    kept = [r for r in rows if r[0] < 200]
    for distance in (0.05, 0.4):
        expected = {(i, j) for i, x in kept for j, y in kept if len(x) == len(y) and cosine(x, y) < distance}
        found = near_vectors(df, df, "id", "id", F.col("v"), F.col("v"), None, distance, bucket_rows=20, sample=1.0).collect()
        assert {(r["id_a"], r["id_b"]) for r in found} == expected and len(found) == len(expected)


def test_tokens_of_near_texts_are_sent_once_to_a_cell(spark):
    """All pairs of 100 candidates, of which one id stands for two texts: each set goes to two cells of a side, not with each of its pairs."""
    sets = [(i, [f"t{i}", "a", "b", "c", "d", "e"][: 6 - i % 2], 1) for i in range(100)] + [(7, ["a", "b", "c"], 2)]
    table = spark.createDataFrame(sets, "id bigint, tokens array<string>, copies bigint")
    asked = spark.createDataFrame([(i, j) for i in range(100) for j in range(i + 1, 100)], "id_a bigint, id_b bigint")
    cells = token_sets_module._cells(asked).cache()
    assert cells.count() == 4950 and cells.select("label", "pa", "pb").distinct().count() <= 4
    want = sorted(
        (i, j, round(1 - len(set(x) & set(y)) / len(set(x) | set(y)), 6), n, m)
        for i, x, n in sets for j, y, m in sets if i < j and 10 * len(set(x) & set(y)) > 6 * len(set(x) | set(y))
    )
    got = token_sets_module.near_pairs(asked, table, table, 0.4)
    assert sorted(map(tuple, got.collect())) == want and want
    other = table.select("id", "tokens", "copies")
    assert sorted(map(tuple, token_sets_module.near_pairs(asked, table, other, 0.4).collect())) == want
    assert token_sets_module.near_pairs(asked.limit(0), table, table, 0.4).count() == 0


def test_vectors_that_no_direction_parts_are_compared_in_blocks(spark, monkeypatch):
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(16 if i % 3 else 5)]) for i in range(300)]
    rows += [(1000 + i, [x + rng.gauss(0, 0.2) for x in v]) for i, v in rows[:60]] + [(2000, None), (2001, [0.0] * 16), (2002, [1.0, None] * 8)]
    df = spark.createDataFrame(rows, "id bigint, v array<double>")
    monkeypatch.setattr(vector_join, "BLOCK_ROWS", 40)
    monkeypatch.setattr(vector_join, "_block_rows", lambda vectors: 40)
    near = vector_join.near_vectors(df, df, "id", "id", F.col("v"), F.col("v"), None, 0.05)
    want = set()
    full = [(i, v) for i, v in rows if v and None not in v and any(v)]
    for i, x in full:
        for j, y in full:
            if len(x) == len(y):
                d = 1 - sum(p * q for p, q in zip(x, y)) / (sum(p * p for p in x) * sum(q * q for q in y)) ** 0.5
                if d < 0.05:
                    want.add((i, j))
    got = [(r["id_a"], r["id_b"]) for r in near.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 400
    blocks = vector_join._near_in_blocks(*(vector_join.distinct_vectors(df, "id", F.col("v")) for _ in "ab"), 0.05)
    assert blocks.rdd.getNumPartitions() > 8  # small rows, but much work
    assert {(r["id_a"], r["id_b"]) for r in blocks.collect()} >= want


def test_blocks_of_any_size_give_all_pairs(spark, texts, monkeypatch):
    """Small blocks, few sent at once, small steps, and rows that repeat or lack their id; nothing is shuffled by pair."""
    rows, df = texts
    monkeypatch.setattr(block_join, "LEAST_TOKENS", 60)
    monkeypatch.setattr(block_join, "BLOCK_TOKENS", 400)
    monkeypatch.setattr(block_join, "SENT_TOKENS", 900)
    monkeypatch.setattr(block_join, "STEP", 50)
    for distance, sparse in ((0.2, 8), (0.6, 0), (0.6, 10**9), (0.9, 8)):
        monkeypatch.setattr(block_join, "SPARSE", sparse)
        assert pairs(prefix_join.prefix_near_pairs(df, "id", "text", distance)) == brute(rows, rows, distance, True)
    odd = [(None, rows[5][1]), (None, "x y z"), *rows[5:40], rows[8], rows[8]]
    df_odd = spark.createDataFrame(odd, "id bigint, text string")
    found = prefix_join.prefix_near_pairs(df_odd, "id", "text", 0.6)
    assert pairs(found) == brute(rows[5:40], rows[5:40], 0.6, True)
    copies = {i: n for r in found.collect() for i, n in ((r["id_a"], r["copies_a"]), (r["id_b"], r["copies_b"]))}
    assert copies[rows[8][0]] == 3 + sum(t.split() and set(t.split()) == set(rows[8][1].split()) for i, t in rows[5:40] if i != rows[8][0])
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    named = df.select(F.concat(F.lit("n"), "id").alias("id"), "text")
    assert len(pairs(prefix_join.prefix_near_pairs(named, "id", "text", 0.6))) == len(brute(rows, rows, 0.6, True))
    assert prefix_join.prefix_near_pairs(df.limit(0), "id", "text", 0.6).collect() == []


def test_blocks_part_sizes_that_cannot_be_near(spark):
    sets = spark.createDataFrame([(i, [f"w{k}" for k in range(n)], str(n)) for i, n in enumerate([1, 2, 3, 40, 41, 42, 43, 900])], "id bigint, tokens array<string>, print string")
    blocks, sizes = block_join.make_blocks(sets, *block_join.token_numbers(sets), 0.2, 2)
    assert blocks.count() == len(sizes) and sum(n for *_, n in sizes) == 1072
    assert block_join._planned([(0, 10, 1, 1), (9, 10, 3, 3), (10, 10, 5, 5), (13, 65, 7, 8), (15, 5, 9, 9)], 30) == (
        [0] * 9 + [1, 1, 0, 0, 2, 0, 5], [1] * 13 + [3, 1, 1], [(1, 1, 10), (3, 5, 20), *[(7, 8, 22)] * 3, (9, 9, 5)]
    )
    assert not block_join._may_meet((1, 3, 6), (40, 43, 9), token_sets_module.exact(0.2)) and block_join._may_meet((1, 33, 6), (40, 43, 9), token_sets_module.exact(0.2))


def test_tokens_that_share_a_hash_get_another(spark, monkeypatch):
    """A hash of eight bits parts 30 tokens under some seeds only."""
    rows = [(i, " ".join(f"t{(i * 7 + k) % 30}" for k in range(6 + i % 3))) for i in range(12)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    monkeypatch.setattr(block_join, "HASH_BITS", 8)
    monkeypatch.setattr(block_join, "ORDER_BITS", 3)
    sets = block_join.printed(token_sets(df, "id", "text"))
    assert block_join.token_numbers(sets)[1] > 0
    assert pairs(prefix_join.prefix_near_pairs(df, "id", "text", 0.9)) == brute(rows, rows, 0.9, True)
    monkeypatch.setattr(block_join, "HASH_BITS", 2)
    monkeypatch.setattr(block_join, "ORDER_BITS", 2)
    monkeypatch.setattr(block_join, "SEEDS", 3)
    with pytest.raises(ValueError, match="no hash"):
        block_join.token_numbers(sets)
