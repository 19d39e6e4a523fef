"""Near-duplicate vectors and exact top-k search, against brute force."""

import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import components, pivot_index, va_file

INF, NAN = float("inf"), float("nan")
ODD = [
    (900, None, 1), (901, [], 1), (902, [0.0] * 8, 1), (903, [NAN] + [1.0] * 7, 1), (904, [INF] + [1.0] * 7, 1),
    (905, [None] + [1.0] * 7, 1), (906, [1.0, 0.0], 1), (907, [2.0, 0.0], 1), (None, [1.0] * 8, 1),
]


def vectors(n=300, seed=3):
    random = np.random.default_rng(seed)
    base = random.normal(size=(n // 10, 8))
    rows = []
    for i in range(n):
        v = base[i % len(base)] + random.normal(size=8) * (0.1 if i % 3 else 0)
        rows.append((5000 - i, [float(x) for x in v.astype(np.float32)], None if i % 50 == 0 else i % 4))
    rows += [(6000 + i, rows[5][1], rows[5][2]) for i in range(60)] + ODD
    return rows + [rows[8]]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, n_links string")


def usable(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute_links(rows):
    n = len(rows)
    links = {i: set() for i in range(n)}
    for i in range(n):
        for j in range(i):
            (a, v, x), (b, w, y) = rows[i], rows[j]
            if a is None or b is None or x is None or x != y or not usable(v) or not usable(w) or len(v) != len(w):
                continue
            v, w = np.array(v), np.array(w)
            if v @ w / np.sqrt((v @ v) * (w @ w)) >= 0.98:
                links[i].add(j), links[j].add(i)
    return links


def part_of(i, links, seen):
    todo = [i]
    while todo:
        for j in links[todo.pop()] - seen:
            seen.add(j)
            todo.append(j)
    return seen


@pytest.mark.parametrize("block", [16, 1024])
def test_links_and_components(spark, block):
    rows = vectors()
    links = brute_links(rows)
    got = pivot_index.near_duplicates(frame(spark, rows), list_block=block).collect()
    assert len(got) == len(rows)
    want = []
    for i, (vec, _, _) in enumerate(rows):
        least = min((rows[j][0] for j in part_of(i, links, {i})), default=None) if vec is not None else None
        want.append((vec, len(links[i]), least, vec is None or least == vec))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_no_vectors(spark):
    assert pivot_index.near_duplicates(frame(spark, [])).collect() == []
    assert {r["n_links"] for r in pivot_index.near_duplicates(frame(spark, ODD)).collect()} == {0, 1}


def test_a_dense_group_does_not_hide_links(spark):
    random = np.random.default_rng(5)
    one = random.normal(size=16)
    rows = [(i, [float(x) for x in one + random.normal(size=16) * 0.05], 0) for i in range(200)]
    rows += [(i, [float(x) for x in random.normal(size=16)], 0) for i in range(200, 800)]
    got = {r["vec_id"]: r["n_links"] for r in pivot_index.near_duplicates(frame(spark, rows)).collect()}
    want = {i: len(v) for i, v in brute_links(rows).items()}
    assert sum(got.values()) >= 0.99 * sum(want.values()) and all(got[i] <= want[i] for i in want)


def brute_top(rows, k):
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and v is not None})
    out = []
    for q, v in rows:
        if q % 20:
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if len(w) == len(v) and (i, w) != (q, v)
        )
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(va_file, "QUERY_BLOCK", 8)
    monkeypatch.setattr(va_file, "CANDIDATE_BLOCK", 64)
    random = np.random.default_rng(4)
    rows = [(i, [int(x) for x in random.integers(-90, 90, 6)]) for i in range(400)]
    rows += [(500 + i, rows[20][1]) for i in range(70)] + [(20, rows[40][1]), rows[40], (None, [1] * 6), (800, None), (820, []), (840, [5, 5])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id bigint, v array<bigint>, rank string")
    got = va_file.top_k(df, F.col("vec_id") % 20 == 0, 20)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == brute_top(rows, 20)


def test_top_k_of_few_rows(spark):
    df = spark.createDataFrame([(0, [1, 2]), (20, [1, 2]), (3, [-4, 0])], "vec_id bigint, v array<bigint>")
    got = va_file.top_k(df, F.col("vec_id") % 20 == 0, 20)
    assert sorted(map(tuple, got.collect())) == [(0, 1, 20, 5), (0, 2, 3, -4), (20, 1, 0, 5), (20, 2, 3, -4)]
    assert va_file.top_k(df.limit(0), F.col("vec_id") % 20 == 0, 20).collect() == []


def test_one_far_vector_does_not_widen_the_cells(spark):
    random = np.random.default_rng(1)
    vectors = np.floor(64 * random.normal(size=(4096, 32))).astype(np.int64)
    vectors[7] = 10**14
    classes = spark.createDataFrame([(f"c{i}", 32, v.tolist()) for i, v in enumerate(vectors)], "class string, dim int, v array<bigint>")
    grid = va_file._grid(classes)
    file = va_file._approximate(classes, grid).toPandas()
    queries = classes.where("int(substring(class, 2)) % 64 = 0").select("class", "v").toPandas()
    left = va_file._scanner(grid, 21)((32,), queries, file)
    assert len(left) < 0.05 * len(queries) * 4096
    scores = np.vstack(queries["v"].to_numpy()) @ vectors.T
    at = {c: i for i, c in enumerate(queries["class"])}
    exact = scores[left["query"].map(at), left["class"].str[1:].astype(int)]
    assert (left["low"] <= exact).all() and (exact <= left["high"]).all()


def test_scores_beyond_64_bits_are_cut_off(spark):
    rows = [(0, [10**18, 1]), (20, [-(10**18), 1]), (3, [10**18, 5]), (4, [2, 10**18]), (5, [1, 1])]
    df = spark.createDataFrame(rows, "vec_id bigint, v array<bigint>")
    got = [tuple(r) for r in va_file.top_k(df, F.col("vec_id") % 20 == 0, 20).orderBy("query_id", "rank").collect()]
    most, least = (1 << 63) - 1, -(1 << 63)
    want = []
    for q, v in rows[:2]:
        scores = sorted((-max(least, min(most, sum(a * b for a, b in zip(v, w)))), i) for i, w in rows if i != q)
        want += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    assert got == want


def test_whole_vector(spark):
    df = frame(spark, ODD)
    assert {r["vec_id"] for r in df.where(va_file.whole_vector(F.col("embedding"))).collect()} == {901, 902, 906, 907, None}


def test_a_dense_piece_of_long_vectors_needs_little_memory():
    import tracemalloc

    import pandas as pd

    random = np.random.default_rng(2)
    centre = random.normal(size=768)
    v = centre + 0.05 * random.normal(size=(2048, 768))
    part = pd.DataFrame({
        "rep": np.arange(2048), "copies": 1, "block": np.arange(2048) % 2, "v": list(v), "near": [np.arange(8, dtype=np.int32)] * 2048,
    })
    tracemalloc.start()
    got = pivot_index._compare(0.98, 5, 2)((0, 768, 0, 0, 1), part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert set(got["links"]) == {1024} and set(got["root"]) == {0} and len(got) == 2048
    assert peak < 120 << 20


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, i) for i in range(200, 260)] + [(5, 5), (None, 3), (7, 6), (6, 7)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 100 for i in range(101, 161)} | {i: 1 for i in range(200, 260)} | {7: 6}
    assert got == want
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_the_sample_of_pivots_needs_no_task_that_sees_all(spark):
    rows = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("class"), F.array(F.col("id").cast("double")).alias("v"))
    drawn = pivot_index._sample(rows, 20_000, 100)
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Filter" in plan
    expect = rows.orderBy(F.xxhash64("class")).limit(100).select("v")
    assert drawn.collect() == expect.collect()
    assert len(pivot_index._sample(rows.limit(50), 50, 100).collect()) == 50
    # a size told too large leaves too few rows below the bound
    assert pivot_index._sample(rows, 20_000_000, 100).collect() == expect.collect()
    assert "Window" not in inspect.getsource(pivot_index.near_duplicates)
