import datetime as dt

from pyspark.sql import functions as F

from millrace.functions import chat as C
from millrace.operators import chat
from millrace.sources.files import read_lines, read_placed_lines
from millrace.sources.sinks import write_lines

LINES = [
    "before the first header",
    "1/5/17, 9:05 - Ann: hello - there: you",
    "second line",
    "",
    "10/17/17, 19:52 - Bob added Ann",
    "13/40/17, 9:05 - Ann: no such day",
    "12/31/17, 23:59 - Bob: last",
    "tail",
]


def chat_lines(spark, copies=1):
    rows = [(f, i, line) for f in range(copies) for i, line in enumerate(LINES)]
    return spark.createDataFrame(rows, "file int, line int, value string")


def test_fold_and_parse(spark):
    folded = chat.fold_lines(chat_lines(spark), ["file"], ["line"])
    records = {r["record"]: r["value"] for r in folded.collect()}
    assert records == {
        0: "before the first header",
        1: "1/5/17, 9:05 - Ann: hello - there: you\nsecond line\n",
        2: "10/17/17, 19:52 - Bob added Ann",
        3: "13/40/17, 9:05 - Ann: no such day",
        4: "12/31/17, 23:59 - Bob: last\ntail",
    }
    parsed = {r["record"]: r for r in chat.parse_records(folded, keep=["record"]).collect()}
    assert parsed[1]["timestamp"] == dt.datetime(2017, 1, 5, 9, 5)
    assert (parsed[1]["name"], parsed[1]["msg"]) == ("Ann", "hello - there: you\nsecond line\n")
    assert (parsed[2]["name"], parsed[2]["msg"]) == ("", "Bob added Ann")
    assert parsed[2]["timestamp"] == dt.datetime(2017, 10, 17, 19, 52)
    assert parsed[3]["timestamp"] is None and parsed[3]["name"] == "Ann"
    assert parsed[0]["timestamp"] is None and parsed[0]["msg"] is None
    bad = chat.unparsed(chat.parse_records(folded, keep=["record"]))
    assert sorted(r["record"] for r in bad.collect()) == [0, 3]


def test_one_huge_file_folds_the_same_in_slices(spark):
    one_file = chat_lines(spark, 60).select(
        F.lit(0).alias("file"), (F.col("file") * 100 + F.col("line")).alias("line"), "value"
    )
    plain = chat.fold_lines(one_file, ["file"], ["line"], max_rows=None).collect()
    cut = chat.fold_lines(one_file, ["file"], ["line"], max_rows=20).collect()
    assert sorted(map(tuple, cut)) == sorted(map(tuple, plain)) and len(plain) == 241


def test_a_very_long_record_goes_on_in_parts(spark):
    rows = [(0, i, f"line {i}") for i in range(100)] + [(1, 0, LINES[1]), (1, 1, "more")]
    lines = spark.createDataFrame(rows, "file int, line int, value string")
    folded = chat.fold_lines(lines, ["file"], ["line"], max_rows=7, max_lines=30).orderBy("file", "part").collect()
    assert [(r["file"], r["part"]) for r in folded] == [(0, 0), (0, 1), (0, 2), (0, 3), (1, 0)]
    assert "\n".join(r["value"] for r in folded[:4]) == "\n".join(f"line {i}" for i in range(100))


def test_lines_of_a_file_keep_their_order(spark, tmp_path):
    path = tmp_path / "chat.txt"
    path.write_text("\n".join(LINES) + "\n")
    folded = chat.fold_lines(read_placed_lines(spark, str(path)), ["file"], ["block", "line"])
    assert folded.count() == 5
    out = str(tmp_path / "folded")
    write_lines(folded.select(F.regexp_replace("value", "\n", " ").alias("value")), out, files=1)
    assert read_lines(spark, out).count() == 5


def test_word_counts(spark):
    rows = [("a", "The cat: sat"), ("a", "cat  and dog"), ("b", "cat"), ("a", None), ("a", "")]
    messages = spark.createDataFrame(rows, "name string, msg string")
    counts = chat.word_counts(messages, ["the", "AND"], only="a")
    assert sorted(map(tuple, counts.collect())) == [("a", "cat", 2), ("a", "dog", 1), ("a", "sat", 1)]


def test_header_times_with_one_or_two_digits(spark):
    texts = spark.createDataFrame([("1/5/17, 9:05",), ("01/05/17, 09:05",), ("x",), (None,)], "t string")
    got = [r[0] for r in texts.select(C.parse_time(F.col("t"))).collect()]
    assert got == [dt.datetime(2017, 1, 5, 9, 5)] * 2 + [None, None]


def test_parts_of_a_record_parse_like_it(spark):
    lines = [(0, "1/5/17, 9:05 - bob: hi"), (1, "l2"), (2, "l3"), (3, "l4"), (4, "l5"), (5, "1/5/17, 9:06 - joined the group"), (6, "x"), (7, "y")]
    df = spark.createDataFrame([("f", i, t) for i, t in lines], "file string, line int, value string")
    parsed = chat.parse_records(chat.fold_lines(df, ["file"], ["line"], max_lines=2), keep=["record", "part"])
    got = sorted((r["record"], r["part"], r["header"], r["name"], r["msg"]) for r in parsed.collect())
    assert got == [
        (1, 0, "1/5/17, 9:05", "bob", "hi\nl2"), (1, 1, "1/5/17, 9:05", "bob", "l3\nl4"), (1, 2, "1/5/17, 9:05", "bob", "l5"),
        (2, 0, "1/5/17, 9:06", "", "joined the group\nx"), (2, 1, "1/5/17, 9:06", "", "y"),
    ]
