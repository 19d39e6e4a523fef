"""The stages of the corpus pipeline, one by one and together, on odd rows."""

import hashlib

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline as pipeline

SF = "/root/testdata/sf0.001"
STAGES = dict(pipeline.STAGES)
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, component_id string, _copies string"


def documents(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", len(t or ""), "x", "y") for i, t, lang in rows], SCHEMA)


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def test_language_rejects_what_is_in_none(spark, given):
    known = [(r["doc_id"], r["text"], r["lang"]) for r in given.collect()]
    odd = [(9001, None, "en"), (9002, "", "en"), (9003, "12 34 !!", None), (None, known[0][1], None), known[1]]
    got = STAGES["language"](spark, documents(spark, known + odd), SF)
    assert got.columns == pipeline.COLUMNS
    ids = [r["doc_id"] for r in got.collect()]
    assert not {9001, 9002, 9003} & set(ids) and None in ids and ids.count(known[1][0]) == 2
    assert len(ids) >= 0.97 * (len(known) + 2)
    assert STAGES["language"](spark, documents(spark, []), SF).collect() == []


def test_language_keeps_texts_in_several_languages(spark, given):
    known = [(r["doc_id"], r["text"], r["lang"]) for r in given.collect()]
    parts = {}
    for _, t, lang in known:
        parts[lang] = f"{parts.get(lang, '')} {t}"[:40_000]
    several = sorted(x for x in parts if x and len(parts[x]) > 2000)[:3]
    assert len(several) == 3
    mixed = " ".join(parts[lang][:n] for lang, n in zip(several, (800, 700, 500)))
    foreign = "日本語 " * 200 + parts[several[0]][:100]
    got = STAGES["language"](spark, documents(spark, [*known, (9001, mixed, None), (9002, foreign, None)]), SF)
    ids = {r["doc_id"] for r in got.collect()}
    assert 9001 in ids and 9002 not in ids


def test_one_of_each_group_stays(spark):
    base = " ".join(f"word{i}" for i in range(120))
    near, far = base.replace("word60", "other"), " ".join(f"thing{i}" for i in range(50))
    rows = [(5, base, "en"), (3, near, "en"), (9, base, "en"), (7, far, None), (8, None, "en"), (10, "", "en"), (None, base, "en")]
    got = STAGES["near_dup"](spark, documents(spark, rows), SF)
    assert got.columns == pipeline.COLUMNS
    assert sorted(map(str, (r["doc_id"] for r in got.collect()))) == ["10", "3", "7", "8", "None"]
    assert STAGES["near_dup"](spark, documents(spark, []), SF).collect() == []


def test_mixing_repeats_and_thins(spark, given):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in given.collect()] + [(None, "x", "en"), (9001, None, "en")]
    got = STAGES["mixing"](spark, documents(spark, rows), SF)
    assert got.columns == pipeline.COLUMNS
    found = [r["doc_id"] for r in got.collect()]
    assert found.count(None) == 1 and set(found) <= {r[0] for r in rows}
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
    assert len(toxic & set(found)) < 0.5 * len(toxic)
    assert STAGES["mixing"](spark, documents(spark, []), SF).collect() == []


@pytest.mark.parametrize("labels", ["false", "toxic = 1"])
def test_mixing_without_a_wanted_domain_keeps_all(spark, given, monkeypatch, labels):
    few = spark.read.parquet(f"{SF}/labels.parquet").where(labels)
    monkeypatch.setattr(pipeline, "table", lambda *_: few)
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in given.collect()]
    got = STAGES["mixing"](spark, documents(spark, rows), SF)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted(r[0] for r in rows)


def test_tokens_come_back(spark, given):
    rows = [(1, "some text", "en"), (2, None, "en"), (None, "", "en")]
    got = {r["doc_id"]: r for r in STAGES["tokens"](spark, documents(spark, rows), SF).collect()}
    assert got[1]["decoded_sha256"] == hashlib.sha256(b"some text").hexdigest()
    assert got[2]["n_tokens"] == got[None]["n_tokens"] == 0
    assert STAGES["tokens"](spark, documents(spark, []), SF).collect() == []


def test_the_whole_run_is_its_stages(spark, given):
    assert [name for name, _ in pipeline.STAGES] == ["language", "near_dup", "mixing", "tokens"]
    docs = given
    for name, stage in pipeline.STAGES:
        docs = stage(spark, docs, SF)
    step_by_step = sorted(map(str, docs.collect()))
    assert step_by_step == sorted(map(str, pipeline.run(spark, SF).collect())) and step_by_step


def test_every_operator_has_its_query():
    names = set(entry_module.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
