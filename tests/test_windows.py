"""Sliced windows give what plain windows give, with one key holding a third of the rows and more."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import windows as W
from millrace.operators.quantiles import bin_number, exact_quantiles
from millrace.operators.slicing import SLICE, slice_groups


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(5)
    data = []
    for i in range(1500):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        level = 7 if rng.random() < 0.4 else rng.randrange(60)  # one value is heavy
        level = None if i % 97 == 0 else level
        data.append((i, key, level, rng.randrange(1000)))
    return spark.createDataFrame(data, "id bigint, key string, level int, amount bigint").cache()


def as_set(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("keys,descending", [(["key"], True), ([], False)])
def test_ranks_equal_plain_windows(rows, keys, descending):
    wanted = {"rank": "r", "dense_rank": "d", "percent_rank": "p", "running_sum": "s"}
    order = F.col("level").desc() if descending else F.col("level").asc()
    by = Window.partitionBy(*keys).orderBy(order)
    expected = rows.select(
        "id", F.rank().over(by).alias("r"), F.dense_rank().over(by).alias("d"),
        F.round(F.percent_rank().over(by), 9).alias("p"), F.sum("amount").over(by).alias("s"),
    )
    for max_rows in (40, 10_000):
        got = W.rank_within(rows, keys, "level", wanted, descending, "amount", max_rows)
        got = got.withColumn("p", F.round("p", 9))
        assert as_set(got, "id", "r", "d", "p", "s") == as_set(expected, "id", "r", "d", "p", "s")


@pytest.mark.parametrize(
    "keys,order,descending",
    [([], ["id"], False), (["key"], ["id"], True), (["key"], ["level", "id"], False), ([], ["level", "id"], True)],
)
def test_row_numbers(rows, keys, order, descending):
    cols = [F.col(c).desc() if descending else F.col(c).asc() for c in order]
    expected = rows.select("id", F.row_number().over(Window.partitionBy(*keys).orderBy(*cols)).alias("n"))
    got = W.number_rows(rows, keys, order, "n", descending, max_rows=30)
    assert as_set(got, "id", "n") == as_set(expected, "id", "n")


def test_slices_are_bounded_even_under_a_heavy_value(rows):
    sliced = slice_groups(rows, ["key"], ["level", "id"], 30)
    sizes = [r["count"] for r in sliced.df.groupBy("key", SLICE).count().collect()]
    assert sum(sizes) == rows.count() and max(sizes) <= 60


@pytest.mark.parametrize(
    "keys,before,after,max_rows",
    [(["key"], 1, 1, 25), ([], 1, 1, 3), (["key"], 2, 0, 3), ([], 0, 3, 25), (["key"], 2, 0, 10_000)],
)
def test_moving_average(rows, keys, before, after, max_rows):
    by = Window.partitionBy(*keys).orderBy("id").rowsBetween(-before, after)
    expected = rows.select("id", F.round(F.avg("amount").over(by), 6).alias("m"))
    got = W.moving_average(rows, keys, ["id"], "amount", "m", before, after, max_rows)
    got = got.withColumn("m", F.round("m", 6))
    assert as_set(got, "id", "m") == as_set(expected, "id", "m")


def test_running_total(rows):
    flag = (F.col("amount") > 500).cast("int")
    by = Window.partitionBy("key").orderBy("id")
    expected = rows.select("id", F.sum(flag).over(by).alias("t"))
    got = W.running_total(rows, ["key"], ["id"], flag, "t", max_rows=50)
    assert as_set(got, "id", "t") == as_set(expected, "id", "t")


def test_range_sum_includes_ties(spark):
    toy = spark.createDataFrame([(1, 10), (2, 20), (3, 20), (4, 30)], "id int, v int")
    for max_rows in (1, 100):
        got = W.rank_within(toy.withColumn("k", F.lit(1)), ["k"], "v", {"running_sum": "s"}, False, "v", max_rows)
        assert [r["s"] for r in got.orderBy("id").collect()] == [10, 50, 50, 80]


def test_lists_keep_every_row_in_order(rows):
    lists = W.lists_in_order(rows, ["key"], ["id"], ["id"], "ids", chunk_rows=64, max_rows=50)
    by_key = {}
    for r in lists.orderBy("key", "chunk").collect():
        assert len(r["ids"]) <= 64
        by_key.setdefault(r["key"], []).extend(r["ids"])
    assert sum(map(len, by_key.values())) == 1500
    assert all(v == sorted(v) for v in by_key.values())


def test_first_rows_pre_limits_before_the_shuffle(rows):
    top = W.first_rows(rows, ["key"], [F.col("id")], 2)
    assert top.count() == 10
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_exact_quantiles_match_sorted_data(rows):
    values = sorted(r[0] for r in rows.select("amount").collect())
    for max_rows in (30, 10_000):
        got = {r["probability"]: r["value"] for r in exact_quantiles(rows, "amount", [0.25, 0.5, 0.75], max_rows).collect()}
        for p, v in got.items():
            assert v == values[-(-int(len(values) * p * 100) // 100) - 1]


def test_bins_cover_all_rows(rows):
    binned = rows.select(bin_number(F.col("level"), [10.0, 30.0]).alias("b")).groupBy("b").count().collect()
    assert {r["b"] for r in binned} == {None, 0, 1, 2}
    assert sum(r["count"] for r in binned) == 1500


def test_cut_running_sums_start_with_null(spark):
    rows = [("k", i, None if i < 40 else i % 7) for i in range(120)] + [("j", i, 1) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, o int, v int")
    plain = W.rank_within(df, ["k"], "o", {"running_sum": "s"}, descending=False, sum_of="v", max_rows=None)
    cut = W.rank_within(df, ["k"], "o", {"running_sum": "s"}, descending=False, sum_of="v", max_rows=25)
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.select(*plain.columns).collect()))
    plain = W.running_total(df, ["k"], ["o"], F.col("v"), "s", max_rows=None)
    cut = W.running_total(df, ["k"], ["o"], F.col("v"), "s", max_rows=25)
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.collect()))


def test_a_key_is_cut_into_a_bounded_number_of_slices(spark, monkeypatch):
    """Every row of a cut key is compared with the cut points, so these may not grow with the rows as long as slices are small."""
    from millrace.operators import slicing

    df = spark.range(3000).select("id", (F.col("id") * 7 % 11).alias("v"))
    sliced = slice_groups(df, [], ["id"], 2)
    slices = sliced.df.select(SLICE).distinct().count()
    assert sliced.hot and 100 < slices <= slicing.MAX_PIECES + 2
    by = Window.orderBy("id").rowsBetween(-1, 1)
    want = as_set(df.select("id", F.avg("v").over(by).alias("m")), "id", "m")
    assert as_set(W.moving_average(df, [], ["id"], "v", "m", 1, 1, 2), "id", "m") == want
    monkeypatch.setattr(slicing, "PIECE_ROWS", 4)
    assert slice_groups(df, [], ["id"], 2).df.groupBy(SLICE).count().agg(F.max("count")).first()[0] <= 8
