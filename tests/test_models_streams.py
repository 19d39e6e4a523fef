import json
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from millrace.functions.labels import class_number
from millrace.operators.token_sets import distinct_sets, token_sets
from millrace.plans import classify, fare
from millrace.schemas import LABELLED_TEXT, SCORING_INPUT
from millrace.session import scratch_path, settle
from millrace.sources import files, sinks
from millrace.streaming import near_dup
from millrace.streaming.score import scored_messages
from tests.test_similarity import make_texts, pairs

THEMES = {
    "Sports": "match team goal score win player",
    "Education": "school exam teacher class student degree",
    "Technology": "phone software chip data cloud app",
    "Health": "doctor diet heart virus sleep vaccine",
    "Business": "market stock profit bank trade price",
}


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    rng = random.Random(2)
    lines = [
        f"{label} = {' '.join(rng.choices(words.split(), k=8)).title()} {rng.randrange(99)}."
        for label, words in THEMES.items() for _ in range(40)
    ]
    lines += ["Other = something else", "no separator here"]
    rng.shuffle(lines)
    folder = tmp_path_factory.mktemp("feed")
    for i in range(3):
        (folder / f"f{i}.txt").write_text("\n".join(lines[i::3]) + "\n")
    return str(folder)


@pytest.fixture(scope="module")
def model(spark, feed):
    raw = files.read_delimited(spark, f"{feed}/*", LABELLED_TEXT)
    label = class_number(F.col("label1")).alias("label")
    rows = classify.cleaned(raw, F.col("description"), label).where("label != 10").cache()
    assert rows.count() == 200
    path = scratch_path(spark, "model")
    sinks.save_model(classify.train(rows), path)
    loaded = sinks.load_model(path)
    assert classify.accuracy(loaded.transform(rows)).collect()[0]["accuracy"] > 0.8
    return loaded


def test_scores_are_probabilities(spark, model):
    rows = classify.cleaned(spark.createDataFrame([("Team GOAL!",), (None,), ("",)], "t string"), F.col("t"))
    got = classify.score(model, rows).collect()
    assert len(got) == 2 and all(sum(r["probability"]) == pytest.approx(1) for r in got)


def test_stream_scores_equal_batch_and_restart_adds_nothing(spark, feed, model):
    batch = files.read_delimited(spark, f"{feed}/*", SCORING_INPUT)
    expected = sorted(r["value"] for r in scored_messages(batch, model, F.col("clean_description")).collect())
    root = scratch_path(spark, "scored")

    def run():
        stream = files.stream_delimited(spark, f"{feed}/*", SCORING_INPUT, max_files=1)
        messages = scored_messages(stream, model, F.col("clean_description"))
        sinks.start_stream(messages, "parquet", f"{root}/chk", path=f"{root}/out").awaitTermination()
        return sorted(r["value"] for r in spark.read.parquet(f"{root}/out").collect())

    assert run() == expected and len(expected) == 201
    assert run() == expected
    assert set(json.loads(expected[0])) == {"clean_description", "category"}


@pytest.mark.parametrize("fmt", ["console", "csv", "memory"])
def test_other_stream_sinks(spark, feed, model, fmt, capfd):
    stream = files.stream_delimited(spark, f"{feed}/*", SCORING_INPUT)
    messages = scored_messages(stream, model, F.col("clean_description"), clean=False)
    root = scratch_path(spark, fmt)
    options = {"truncate": "false"} if fmt == "console" else {}
    name = "scored_rows" if fmt == "memory" else None
    path = f"{root}/out" if fmt == "csv" else None
    sinks.start_stream(messages, fmt, f"{root}/chk", options, path, name).awaitTermination()
    if fmt == "csv":
        assert spark.read.text(path).count() == 201
    if fmt == "memory":
        assert spark.table("scored_rows").count() == 201


def test_stream_near_duplicates_equal_batch(spark):
    corpus = spark.createDataFrame(make_texts(150), "id bigint, text string")
    arriving = make_texts(60, seed=3)[5:] + [(i + 500, t) for i, t in make_texts(30, seed=8)[5:]]
    root = scratch_path(spark, "near")
    for i in range(3):
        part = spark.createDataFrame(arriving[i::3], "id bigint, text string").coalesce(1)
        part.write.mode("append").parquet(f"{root}/in")
    shape = near_dup.build_index(corpus, "id", "text", 0.3, f"{root}/index")
    index = near_dup.Index(spark, f"{root}/index", shape, bucket_rows=10)
    stream = files.stream_table(spark, f"{root}/in", corpus.schema, max_files=1)

    def run():
        near_dup.stream_near_duplicates(
            stream, index, "id", "text", 0.3, f"{root}/out", f"{root}/chk"
        ).awaitTermination()
        return spark.read.parquet(f"{root}/out")

    expected = set()
    for i in range(3):  # copies are reduced within a batch
        part = spark.createDataFrame(arriving[i::3], "id bigint, text string")
        expected |= pairs(index.lookup(part, "id", "text", 0.3))
    assert pairs(run()) == expected and expected
    assert run().count() == len(expected)


def test_outputs_hold_each_row_once_after_a_failure(spark, tmp_path):
    root = scratch_path(spark, "outputs")
    for i in range(3):
        spark.range(10 * i, 10 * i + 10).coalesce(1).write.mode("append").parquet(f"{root}/in")
    schema, failing = spark.range(1).schema, {"on": True}

    def odd(rows):
        if failing["on"] and rows.where("id >= 20").count():
            raise RuntimeError("lost between two outputs")
        return rows.where("id % 2 = 1")

    def run():
        stream = files.stream_table(spark, f"{root}/in", schema, max_files=1)
        sinks.start_outputs(stream, {"even": lambda rows: rows.where("id % 2 = 0"), "odd": odd}, f"{root}/out", f"{root}/checkpoint").awaitTermination()

    with pytest.raises(Exception, match="lost between"):
        run()
    failing["on"] = False
    run()
    run()
    for name, rest in (("even", 0), ("odd", 1)):
        got = spark.read.parquet(f"{root}/out/{name}")
        assert sorted(r["id"] for r in got.collect()) == [i for i in range(30) if i % 2 == rest]


def test_lines_of_other_lengths_are_rejected(spark, tmp_path):
    (tmp_path / "a.txt").write_text("Sports = won\nno separator\na = b = c\n = empty\n")
    stream = files.stream_delimited(spark, str(tmp_path), SCORING_INPUT, corrupt="_bad")
    root = scratch_path(spark, "rejects")
    sinks.start_outputs(stream, {"all": lambda rows: rows}, root, f"{root}/checkpoint").awaitTermination()
    got = {r["_bad"]: r["clean_description"] for r in spark.read.parquet(f"{root}/all").collect()}
    assert set(got) == {None, "no separator", "a = b = c"}


def test_a_growing_index_equals_one_built_at_once(spark):
    rows = make_texts(150)
    corpus = spark.createDataFrame(rows, "id bigint, text string")
    asked = spark.createDataFrame([(i + 500, t) for i, t in make_texts(60, seed=3)], "id bigint, text string")
    root = scratch_path(spark, "grown")
    shape = near_dup.build_index(corpus, "id", "text", 0.3, f"{root}/whole")
    whole = near_dup.Index(spark, f"{root}/whole", shape)
    near_dup.build_index(corpus.limit(0), "id", "text", 0.3, f"{root}/grown")
    grown = near_dup.Index(spark, f"{root}/grown", shape)
    assert grown.lookup(asked, "id", "text", 0.3).collect() == []
    for i in range(3):
        part = spark.createDataFrame(rows[i::3], "id bigint, text string")
        grown.add(part, "id", "text", f"part-{i}")
        grown.add(part, "id", "text", f"part-{i}")  # again, as after a failure
    assert len(grown.segments()) == 4
    want = sorted(map(tuple, whole.lookup(asked, "id", "text", 0.3).collect()))
    assert sorted(map(tuple, grown.lookup(asked, "id", "text", 0.3).collect())) == want and want
    grown._write(distinct_sets(token_sets(corpus, "id", "text")), "broken-off")  # written, never put on the list
    grown.compact()
    assert len(grown.segments()) == 1
    assert sorted(map(tuple, grown.lookup(asked, "id", "text", 0.3).collect())) == want


def test_a_small_batch_reads_few_folders(spark):
    corpus = spark.createDataFrame(make_texts(150), "id bigint, text string")
    root = scratch_path(spark, "pruned")
    shape = near_dup.build_index(corpus, "id", "text", 0.1, f"{root}/index", parts=200)
    index = near_dup.Index(spark, f"{root}/index", shape, parts=200)
    one = corpus.where("id = 5")
    keys = near_dup.band_keys(distinct_sets(token_sets(one, "id", "text")), *shape)
    all_keys = index.keys(index.segments())
    few = index.touched(keys, all_keys, "key")
    assert "PartitionFilters: [part" in few._jdf.queryExecution().toString() or "part#" in few._jdf.queryExecution().toString()
    read = few.select(F.input_file_name()).distinct().count()
    assert 0 < read <= shape[0] < 0.2 * len(all_keys.inputFiles())


def test_a_stream_that_grows_its_corpus_meets_what_came_before(spark):
    rows = [(i, t) for i, t in make_texts(90) if t and t.strip()]
    root = scratch_path(spark, "grow")
    for i in range(3):  # every part has some of the hot family
        spark.createDataFrame(rows[30 * i : 30 * i + 30], "id bigint, text string").coalesce(1).write.mode("append").parquet(f"{root}/in")
    schema = spark.createDataFrame(rows, "id bigint, text string").schema
    shape = near_dup.build_index(spark.createDataFrame([], schema), "id", "text", 0.3, f"{root}/index")
    index = near_dup.Index(spark, f"{root}/index", shape)

    def run(checkpoint):
        stream = files.stream_table(spark, f"{root}/in", schema, max_files=1)
        near_dup.stream_near_duplicates(stream, index, "id", "text", 0.3, f"{root}/out", f"{root}/{checkpoint}", grow=True).awaitTermination()
        return sorted(map(tuple, spark.read.parquet(f"{root}/out").where("batch > 0").collect()))

    first = run("checkpoint")
    assert first and len(index.segments()) == 4
    last = spark.read.parquet(f"{root}/out").where("batch = 2")
    met = {(r["id_a"], r["id_b"]) for r in last.collect()}
    assert met and not met & {(b, a) for a, b in met}
    # the last batch replayed, as after a failure between adding and the checkpoint
    batch = spark.createDataFrame(rows[:0], schema)
    assert index.lookup(batch, "id", "text", 0.3, without="batch-2").collect() == []
    index.add(batch, "id", "text", "batch-2")
    assert len(index.segments()) == 4


def test_fares(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        lat, lon, step = 40 + rng.random(), -74 + rng.random(), rng.random() / 5
        km = step * 111.2
        rows.append((str(i), 3 + 2 * km + rng.gauss(0, 1), f"2009-06-{1 + i % 28:02d} {i % 24:02d}:26:21", lon, lat, lon, lat + step, 1))
    rows += [("neg", -1.0, "2009-06-01 01:00:00", 1.0, 1.0, 2.0, 2.0, 1), ("still", 5.0, "2009-06-01 01:00:00", 1.0, 1.0, 1.0, 1.0, 1)]
    rows += [("null", 5.0, "not a time", 1.0, 1.0, 2.0, 2.0, 1), ("nan", 5.0, None, float("nan"), 1.0, 2.0, 2.0, 1)]
    from millrace.schemas import FARE

    trips = fare.prepare(spark.createDataFrame(rows, FARE)).cache()
    kept = {r["key"]: r["hour"] for r in trips.collect()}
    assert len(kept) == 601 and kept["null"] is None and kept["5"] == 5
    training, test = fare.split_by_key(trips)
    assert training.count() + test.count() == 601 and test.count() > 60
    predicted = fare.predict(fare.train(training), test)
    row = predicted.agg(
        F.sqrt(F.avg(F.pow(F.col("label") - F.col("prediction"), 2))).alias("rmse"), F.stddev_pop("label").alias("sd")
    ).collect()[0]
    assert row["rmse"] < row["sd"] / 2
    assert {r["hourbin"] for r in predicted.select("hourbin").distinct().collect()} == {0.0, 1.0, 2.0, 3.0}


def test_training_reads_its_texts_once(spark, feed, monkeypatch):
    """The regression reads features that were written, and learns what the whole pipeline would."""
    written = []
    monkeypatch.setattr(classify, "settle", lambda df, name: written.append(settle(df, name)) or written[-1])
    rows = spark.createDataFrame([(float(i % 2), f"word{i % 2} other{i % 5} text") for i in range(60)], "label double, clean_description string")
    model = classify.train(rows)
    assert [w.columns for w in written] == [["label", "features"]]
    regression = LogisticRegression(maxIter=classify.MAX_ITER, regParam=classify.REG_PARAM)
    whole = Pipeline(stages=[*classify.hashing_stages(), regression]).fit(rows)
    assert model.stages[-1].coefficients.toArray() == pytest.approx(whole.stages[-1].coefficients.toArray(), abs=1e-6)
    assert [type(s) for s in model.stages] == [type(s) for s in whole.stages]


def test_an_index_is_written_without_sending_rows_by_folder(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"u{i % 7} w{i % 5} a b c d") for i in range(60)], "id bigint, text string")
    path = scratch_path(spark, "index")

    def refuse(*args):
        raise AssertionError("rows are sent once more")

    with monkeypatch.context() as patch:
        patch.setattr(type(docs), "repartition", refuse)
        shape = near_dup.build_index(docs.where("id < 30"), "id", "text", 0.4, path, parts=4)
        index = near_dup.Index(spark, path, shape, parts=4)
        index.add(docs.where("id >= 30"), "id", "text", "more")
        index.compact()
    assert index.sets(index.segments()).count() == 35
    assert index.sets(index.segments()).where("part <> pmod(xxhash64(id), 4)").count() == 0
    assert index.lookup(docs.where("id = 3"), "id", "text", 0.1).collect()
