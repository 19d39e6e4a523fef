import hashlib
import math
import random
import re
import shutil

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import schemas
from millrace.functions import geo, labels
from millrace.functions import text as X
from millrace.functions.stop_words import ENGLISH
from millrace.operators import features, quantiles, tables
from millrace.operators.keyed_table import KeyedTable
from millrace.plans import q_sources
from millrace.session import scratch_path
from millrace.sources import files, sinks


def column(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_stop_words_are_the_built_in_list(spark):
    assert ENGLISH == StopWordsRemover.loadDefaultStopWords("english")


def test_tokens(spark):
    df = spark.createDataFrame([(" Hi  there\tyou ",), ("",), ("  ",), (None,), ("one",)], "t string")
    assert column(df, X.tokens(F.col("t"))) == [["hi", "there", "you"], [], [], None, ["one"]]
    assert X.token_rows(df, "t").count() == 4
    pieces = column(df, X.space_pieces(F.col("t")))
    assert pieces[0] == ["", "Hi", "", "there\tyou", ""] and pieces[3] is None


def test_clean_and_anchors(spark):
    df = spark.createDataFrame([("Rs 52,36,000 É unsold.\nA-b",), (None,)], "t string")
    assert column(df, X.clean_text(F.col("t"))) == ["rs   unsold\nab", None]
    page = '<p><a href="x">one</a> and <a>two</a> end\n<a>three</a>'
    df = spark.createDataFrame([(page,)], "t string")
    assert column(df, X.strip_anchors(F.col("t"))) == ["<p> end\n"]
    assert column(df, X.strip_anchors(F.col("t"), lazy=True)) == ["<p> and  end\n"]


def test_stop_table_may_come_from_a_file(spark, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("The\n\n and \nthe\n")
    words = files.read_word_list(spark, str(path))
    assert sorted(column(words, "word")) == ["and", "the"]
    rows = spark.createDataFrame([("the",), ("cat",), ("and",), ("cat",)], "word string")
    assert column(X.without_stop_table(rows, words), "word") == ["cat", "cat"]


def test_labels(spark):
    df = spark.createDataFrame([(" Sports ",), ("Business",), ("x",), (None,)], "t string")
    assert column(df, labels.class_number(F.col("t"))) == [0, 4, 10, 10]
    numbers = spark.createDataFrame([(0.0,), (3.0,), (9.0,), (None,)], "n double")
    assert column(numbers, labels.class_name(F.col("n"))) == ["Sports", "Health", "unknown", "unknown"]
    payload = spark.createDataFrame([('a "q"', 1)], "s string, n int").select(labels.json_payload("s", "n"))
    assert column(payload, "value") == ['{"s":"a \\"q\\"","n":1}']


def test_distances(spark):
    rows = [(-73.98, 40.75, -73.87, 40.77), (10.0, 20.0, 10.0, 20.0), (0.0, 0.0, 180.0, 0.0), (None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    args = [F.col(c) for c in "abcd"]
    km = column(df, geo.haversine_km(*args))
    assert km[0] == pytest.approx(9.53, abs=0.05) and km[1] == 0.0 and km[3] is None
    assert km[2] == pytest.approx(math.pi * 6372.8)

    def older(lon1, lat1, lon2, lat2):
        r = math.radians
        first, second = r(r(lat1) - r(lon1)), r(r(lat2) - r(lon2))
        a = math.sin(first / 2) ** 2 + math.cos(r(lat1)) * math.cos(r(lon1)) * (second / 2) ** 2
        return 2 * 6372.8 * math.atan2(math.sqrt(a), math.sqrt(1 - a)) if 0 <= a <= 1 else None

    got = column(df, geo.legacy_trip_km(*args))
    assert got[:3] == [pytest.approx(older(*r)) for r in rows[:3]] and got[3] is None


def test_append_and_upsert(spark):
    base = tables.literal_rows(spark, [(1, "a"), (2, "b"), (None, "n")], T.StructType.fromDDL("id int, v string"))
    more = tables.literal_rows(spark, [("B", 2), ("c", 3)], T.StructType.fromDDL("v string, id int"))
    assert sorted(map(repr, map(tuple, tables.append_rows(base, more).collect()))) == sorted(
        map(repr, [(1, "a"), (2, "b"), (None, "n"), (2, "B"), (3, "c")])
    )
    assert {tuple(r) for r in tables.upsert_rows(base, more, ["id"]).collect()} == {
        (1, "a"), (2, "B"), (3, "c"), (None, "n")
    }


def test_arranged_rows_are_sorted_and_together(spark):
    rows = spark.range(2000).select((F.col("id") % 3).alias("k"), F.xxhash64("id").alias("o"))
    parts = tables.arrange(rows, ["k"], ["o"], 8).withColumn("p", F.spark_partition_id())
    by_part = {}
    for r in parts.collect():
        by_part.setdefault(r["p"], []).append((r["k"], r["o"]))
    assert sum(map(len, by_part.values())) == 2000 and len(by_part) > 3
    assert all(v == sorted(v) for v in by_part.values())


def test_describe_and_preview(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None), (6, 4.0)], "a int, b double")
    got = {r["col_name"]: r for r in tables.describe_columns(df, ["a", "b"]).collect()}
    assert (got["a"]["cnt"], got["a"]["mean"], got["a"]["min"], got["a"]["max"]) == (3, 3.0, 1.0, 6.0)
    assert got["b"]["cnt"] == 2 and got["b"]["stddev"] == pytest.approx(2 ** 0.5)
    assert column(tables.preview(df, [F.desc("a")], 2), "a") == [6, 2]


def test_conform(spark):
    raw = spark.createDataFrame([("x", "2017-10-04", "15.2"), ("y", "bad", "z")], "symbol string, date string, price string")
    typed = schemas.conform(raw, schemas.PRICE)
    assert typed.schema == schemas.PRICE
    assert [r["price"] for r in typed.collect()] == [15.2, None]


def test_header_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text("id,first_name,last_name,department,salary,gender\n1,A,B,Marketing,10,F\n2,C,D,,x,M\n")
    got = files.read_header_csv(spark, str(tmp_path / "*.csv"), schemas.EMPLOYEE).collect()
    assert [(r["id"], r["department"], r["salary"]) for r in got] == [(1, "Marketing", 10), (2, None, None)]


def test_delimited(spark, tmp_path):
    (tmp_path / "a.txt").write_text('Sports = "x, y" = z\n\nno separator\n')
    got = files.read_delimited(spark, str(tmp_path / "*"), schemas.LABELLED_TEXT).collect()
    assert [(r["label1"], r["description"]) for r in got] == [("Sports ", ' "x, y" '), ("no separator", None)]
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "f").write_text("t1$cat$some text\n")
    got = files.read_delimited(spark, str(tmp_path / "b" / "*"), schemas.TIMED_TEXT, sep="$").collect()
    assert tuple(got[0]) == ("t1", "cat", "some text")


def test_delimited_round_trip_with_quotes(spark, tmp_path):
    rows = [("a", 'say "hi", you', 0), ("b", "plain", 1)]
    df = spark.createDataFrame(rows, schemas.INDEXED_TEXT).repartition(3)
    out = str(tmp_path / "op")
    sinks.write_delimited(df, out, files=1)
    assert len(list((tmp_path / "op").glob("part-*"))) == 1
    back = files.read_delimited(spark, out + "/*", schemas.INDEXED_TEXT)
    assert sorted(map(tuple, back.collect())) == rows


def test_feed_lines(spark):
    df = spark.createDataFrame([("L", "two\nlines"), ("L", ""), ("M", None)], "l string, t string")
    assert column(sinks.feed_lines(df, F.col("l"), F.col("t")), "value") == ["L = two lines"]


def test_hashed_counts_add_up(spark):
    df = spark.createDataFrame([(1, "a b a c"), (2, ""), (3, None)], "id int, t string")
    got = {r["id"]: sum(r["counts"]) for r in features.hashed_counts(df, "id", "t").collect()}
    assert got == {1: 4.0, 2: 0.0, 3: 0.0}


def test_document_vectors_repeat(spark):
    df = spark.createDataFrame([(i, f"a b c d{i % 3}") for i in range(30)] + [(99, " ")], "id int, t string")
    first = {r["id"]: r["vector"] for r in features.document_vectors(df, "id", "t").collect()}
    second = {r["id"]: r["vector"] for r in features.document_vectors(df, "id", "t").collect()}
    assert first == second and len(first) == 30 and len(first[0]) == 10


def test_idf(spark):
    df = spark.createDataFrame([("a b a",), ("a",), (None,)], "t string")
    got = {r["word"]: (r["df"], r["idf"]) for r in features.idf_weights(df, "t").collect()}
    assert got == {"a": (2, pytest.approx(math.log(4 / 3))), "b": (1, pytest.approx(math.log(2)))}


def test_updates_that_repeat_a_key(spark):
    base = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "id int, v string, at int")
    more = spark.createDataFrame([(2, "new", 5), (2, "old", 3), (3, "c", 1)], "id int, v string, at int")
    with pytest.raises(ValueError):
        tables.upsert_rows(base, more, ["id"])
    kept = {r["id"]: r["v"] for r in tables.upsert_rows(base, more, ["id"], latest="at").collect()}
    assert kept == {1: "a", 2: "new", 3: "c"}


def test_white_space_around_class_names(spark):
    df = spark.createDataFrame([("Sports\t",), ("\r\n Sports",), ("\tHealth",), (None,)], "t string")
    assert column(df, labels.class_number(F.col("t"))) == [0, 0, 3, 10]


def test_lines_are_numbered_by_file_name_not_by_size(spark, tmp_path, monkeypatch):
    """The query's own write, forced into six files of unequal size, the smallest first."""
    rows = [(i, "en" if i % 2 else "de") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string")
    write = sinks.write_lines
    bounds = [0, 10, 50, 200, 600, 1300, 3000]

    def several(df, path, files=None, mode="error"):
        doc_id = F.element_at(F.split("value", " = "), -1).cast("long")
        for k, (low, high) in enumerate(zip(bounds, bounds[1:])):
            write(df.where((doc_id >= low) & (doc_id < high)).coalesce(1).sortWithinPartitions(doc_id), f"{tmp_path}/{k}")
        (tmp_path / "all").mkdir()
        for k in range(len(bounds) - 1):
            (source,) = (tmp_path / str(k)).glob("part-*.txt")
            shutil.copy(source, tmp_path / "all" / f"part-{k:05d}.txt")

    monkeypatch.setattr(q_sources, "table", lambda *_: docs)
    monkeypatch.setattr(q_sources, "write_lines", several)
    monkeypatch.setattr(q_sources, "scratch_path", lambda *_: str(tmp_path / "all"))
    got = {tuple(r) for r in q_sources.row_index_read_order(spark, None).collect()}
    assert got == {("de", 0, 1), ("en", 1, 1), ("de", 2, 2), ("en", 3, 2)}
    lines = files.read_ordered_lines(spark, str(tmp_path / "all")).orderBy("file_no", "block", "line").collect()
    assert [r["value"].split(" = ")[1] for r in lines] == [str(i) for i in range(3000)]


def test_numbered_lines_without_sorting(spark, tmp_path):
    rows = [f"line {i} " + "x" * (i % 50) for i in range(5000)]
    cuts = [0, 40, 41, 3000, 3000, 4990, 5000]
    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
        (tmp_path / f"part {n + 8}.txt").write_text("".join(f"{r}\n" for r in rows[a:b]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4000")
    try:
        lines = files.read_numbered_lines(spark, str(tmp_path))
        plan = lines._jdf.queryExecution().executedPlan().toString()
        # the pieces are sorted, a row each, the lines are not
        assert plan.count("- Sort [") == 1 and "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        got = [r["value"] for r in lines.orderBy("idx").collect()]
        ids = sorted(r["idx"] for r in lines.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == rows and ids == list(range(1, 5001))


def test_numbered_lines_by_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "SENT_PIECES", 0)
    (tmp_path / "a").write_text("x\ny\n")
    (tmp_path / "b").write_text("z\n\n")
    got = sorted(map(tuple, files.read_numbered_lines(spark, str(tmp_path)).collect()))
    assert got == [(1, "x"), (2, "y"), (3, "z"), (4, "")]


@pytest.mark.parametrize("error", [0.05, 0.001])
def test_approximate_quantiles_keep_their_error(spark, error):
    rng = random.Random(8)
    values = [float(rng.choice([5, rng.gauss(0, 100), rng.randrange(20)])) for _ in range(5000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "value double").repartition(13)
    found = quantiles.rank_errors(df, "value", quantiles.approximate_quantiles(df, "value", [0.0, 0.1, 0.5, 0.99, 1.0], error)).collect()
    assert len(found) == 5 and all(r["error"] <= error and r["n"] == 5000 for r in found)
    exact = quantiles.rank_errors(df, "value", quantiles.exact_quantiles(df, "value", [0.1, 0.5]))
    assert {r["error"] for r in exact.collect()} == {0.0}
    assert quantiles.approximate_quantiles(df.limit(0), "value", [0.5], 0.1).collect() == []


def test_sketches_of_groups_merge(spark):
    df = spark.range(20_000).select((F.col("id") % 37).alias("day"), F.when(F.col("id") % 10 != 0, F.pow("id", 1.5)).alias("value"))
    sketches = quantiles.quantile_sketches(df, ["day"], "value")
    assert sketches.count() == 37
    found = quantiles.rank_errors(df, "value", quantiles.merged_quantiles(sketches, [0.01, 0.5, 0.9])).collect()
    assert len(found) == 3 and all(r["error"] <= 0.02 for r in found)
    assert quantiles.merged_quantiles(sketches.limit(0), [0.5]).collect() == []


def test_stored_upsert_leaves_other_files(spark):
    rows = spark.range(1000).select("id", F.concat(F.lit("v"), "id").alias("v"), F.lit(1).alias("at"))
    stored = KeyedTable(spark, scratch_path(spark, "keyed"), rows.schema, ["id"], parts=16)
    assert stored.read().collect() == []
    stored.create(rows)
    before = set(stored.read().inputFiles())
    updates = spark.createDataFrame([(5, "old", 1), (5, "new", 2), (2000, "more", 1)], rows.schema)
    with pytest.raises(ValueError):
        stored.upsert(updates)
    stored.upsert(updates, "at")
    stored.upsert(updates, "at")  # again, as after a failure
    after = set(stored.read().inputFiles())
    assert len(before - after) <= 2 and len(before & after) >= len(before) - 2
    got = {r["id"]: r["v"] for r in stored.read().collect()}
    assert got == {**{i: f"v{i}" for i in range(1000)}, 5: "new", 2000: "more"} and stored.read().count() == 1001
    # folders written but never listed, as by a run that broke off
    stored._placed(rows.limit(3)).write.partitionBy("_part").parquet(f"{stored.path}/rows/version=99")
    assert stored.read().count() == 1001
    stored.upsert(updates.limit(0))
    assert stored.read().count() == 1001
    stored.create(rows.limit(0))
    assert stored.read().collect() == []


def test_document_vectors_send_words_once_by_word_and_once_by_text(spark):
    texts = [(1, "a b a c"), (2, "A\tb  b"), (3, None), (4, "   "), (5, ""), (6, "z"), (1, "c d"), (None, "a q")]
    df = spark.createDataFrame(texts, "id bigint, text string")
    vectors = features.document_vectors(df, "id", "text", 4)
    rows = [(i, (t or "").lower().split()) for i, t in texts]
    weight = {w: math.log((len(texts) + 1) / (sum(w in set(x) for _, x in rows) + 1)) for _, x in rows for w in x}
    sign = {w: int(hashlib.md5(w.encode()).hexdigest()[:15], 16) for w in weight}
    want = {}
    for i in {i for i, x in rows if x}:
        own = [w for j, x in rows for w in x if i == j]
        want[i] = [sum(weight[w] * (1 if sign[w] >> k & 1 else -1) for w in own) / len(own) for k in range(4)]
    got = {r["id"]: r["vector"] for r in vectors.collect()}
    assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in want)
    plan = vectors._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert len(re.findall(r"hashpartitioning\(id#", plan)) == 1


def test_learned_vectors_place_words_by_their_neighbours(spark, monkeypatch):
    """Words that stand between the same words are nearer than others; signs drawn for each word know nothing of that."""
    rng = random.Random(2)
    texts = []
    for i in range(1500):
        kind = i % 2
        texts.append((i, " ".join(rng.choice(["p", "q"] if kind else ["x", "y"]) if k % 3 == 1 else f"{'ab'[kind]}{rng.randrange(4)}" for k in range(24))))
    texts += [(9000, "p"), (9001, "Q"), (9002, "x"), (9003, "y  X y"), (9004, " "), (9005, None), (9006, "once"), (9007, "y")]
    df = spark.createDataFrame(texts, "id bigint, text string")
    first = {r["id"]: r["vector"] for r in features.word2vec_vectors(df.repartition(3), "id", "text").collect()}
    second = {r["id"]: r["vector"] for r in features.word2vec_vectors(df.repartition(5), "id", "text").collect()}
    assert first.keys() == second.keys() == {i for i, t in texts if t and t.strip()} and len(first[9006]) == 10
    assert all(first[i] == pytest.approx(second[i], abs=1e-9) for i in first)
    assert first[9003] == pytest.approx([(2 * y + x) / 3 for x, y in zip(first[9002], first[9007])])

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5

    assert cosine(first[9000], first[9001]) > cosine(first[9000], first[9002]) + 0.1
    assert features.word2vec_vectors(df.where("id = 9004"), "id", "text").collect() == []
    monkeypatch.setattr(features, "WORD2VEC_TOKENS", 20_000)
    parted = {r["id"]: r["vector"] for r in features.word2vec_vectors(df, "id", "text").collect()}
    assert parted.keys() == first.keys() and cosine(parted[9000], parted[9001]) > cosine(parted[9000], parted[9002]) + 0.1
