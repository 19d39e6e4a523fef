"""The news path: labelled lines in ``=`` files, five classes, a model, a scored stream with its rejects, and what is written."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import NEWS_CLASSES, OTHER_CLASS, class_number
from ..operators import windows as W
from ..schemas import INDEXED_TEXT, LABELLED_TEXT, SCORING_INPUT, conform
from ..session import scratch_path, settle
from ..sources.files import read_delimited, read_lines, stream_delimited, stream_table
from ..sources.sinks import feed_lines, load_model, save_model, start_outputs, start_stream, write_delimited, write_lines
from ..streaming.score import scored_messages
from . import classify
from .catalog import query, table
from .q_chat import _HEADER_SQL, _TIMED_SQL, chat_records

#: Which class the texts of a language stand for; parts are the fifth class, whatever else is none of the five.
CLASS_OF = {"en": "Sports", "de": "Education", "fr": "Technology", "es": "Health"}
PARTS_CLASS, OTHER = "Business", "Weather"
CORRUPT = "_corrupt"

_PLAIN_SQL = "trim(regexp_replace({}, '[^A-Za-z]+', ' ', 'g'))"
_CLASS_SQL = "CASE " + " ".join(f"WHEN lang = '{k}' THEN '{v}'" for k, v in CLASS_OF.items()) + f" ELSE '{OTHER}' END"
_NUMBER_SQL = "CASE " + " ".join(f"WHEN class = '{k}' THEN {v}" for k, v in NEWS_CLASSES.items()) + f" ELSE {OTHER_CLASS} END"
_FEED_SQL = f"""feed AS (SELECT {_CLASS_SQL} AS class, {_PLAIN_SQL.format('text')} AS description FROM documents WHERE text IS NOT NULL
        UNION ALL SELECT '{PARTS_CLASS}', {_PLAIN_SQL.format("concat_ws(' ', p_name, p_type, p_brand)")} FROM part),
    news AS (SELECT {_NUMBER_SQL} AS label, ' ' || lower(description) AS clean_description FROM feed
        WHERE description <> '' AND {_NUMBER_SQL} <> {OTHER_CLASS})"""
#: Hashed features of the news models.
FEATURES = 1 << 10
#: A quarter of the texts is held out, told by a digest.
_HELD_OUT = "substring(md5(clean_description), 1, 1) IN ('0', '1', '2', '3')"


def _plain(text):
    return F.trim(F.regexp_replace(text, "[^A-Za-z]+", " "))


def feed(spark, sf) -> DataFrame:
    """(class, description): texts of five classes and of others."""
    named = F.lit(OTHER)
    for lang, name in CLASS_OF.items():
        named = F.when(F.col("lang") == lang, name).otherwise(named)
    docs = table(spark, sf, "documents", spread=True).where("text IS NOT NULL")
    parts = table(spark, sf, "part").select(
        F.lit(PARTS_CLASS).alias("class"), _plain(F.concat_ws(" ", "p_name", "p_type", "p_brand")).alias("description")
    )
    return docs.select(named.alias("class"), _plain(F.col("text")).alias("description")).unionByName(parts)


def feed_files(spark, sf, lines_without: DataFrame | None = None) -> str:
    """The feed written as ``class = description`` lines, with other lines if given."""
    path = scratch_path(spark, "feed")
    lines = feed_lines(feed(spark, sf), F.col("class"), F.col("description"))
    write_lines(lines if lines_without is None else lines.unionByName(lines_without), path)
    return path


def news(spark, path: str) -> DataFrame:
    """(label, clean_description) of the five classes, read from ``=`` files."""
    raw = read_delimited(spark, path, LABELLED_TEXT)
    return classify.cleaned(raw, F.col("description"), class_number(F.col("label1")).alias("label")).where(F.col("label") != OTHER_CLASS)


@query("news_feed", f"WITH {_FEED_SQL} SELECT label, clean_description FROM news")
def news_feed(spark, sf):
    """Labelled lines written, read back, mapped to class numbers, other classes dropped, cleaned."""
    return news(spark, feed_files(spark, sf))


@query("news_train_check", f"WITH {_FEED_SQL} SELECT label, count(*) AS n, TRUE AS learned FROM news WHERE {_HELD_OUT} GROUP BY label")
def news_train_check(spark, sf):
    """Whether the five-class model finds most of each class among texts it was not trained on; a model that always says one class fails."""
    rows = settle(news(spark, feed_files(spark, sf)), "news")
    model = classify.train(rows.where(f"NOT {_HELD_OUT}"), FEATURES)
    found = model.transform(rows.where(_HELD_OUT))
    right = F.avg((F.col("prediction") == F.col("label")).cast("int"))
    return found.groupBy("label").agg(F.count("*").alias("n"), (right >= 0.5).alias("learned"))


@query(
    "news_stream_check",
    f"""WITH {_FEED_SQL} SELECT (SELECT count(*) FROM feed WHERE description <> '') AS n_kept,
        (SELECT count(*) FROM conversations WHERE {_PLAIN_SQL.format('text')} <> '') AS n_rejected, TRUE AS same_as_batch, TRUE AS several_classes""",
)
def news_stream_check(spark, sf):
    """The files as a stream: lines without a separator are rejected and kept apart, the others scored by the saved model, as in one batch."""
    spoken = table(spark, sf, "conversations").select(_plain(F.col("text")).alias("value")).where("value <> ''")
    path = feed_files(spark, sf, spoken)
    root = scratch_path(spark, "news_stream")
    save_model(classify.train(news(spark, path), FEATURES), f"{root}/model")
    model = load_model(f"{root}/model")
    stream = stream_delimited(spark, path, SCORING_INPUT, corrupt=CORRUPT)

    def kept(rows: DataFrame) -> DataFrame:
        return scored_messages(rows.where(F.col(CORRUPT).isNull()), model, F.col("clean_description"))

    def rejected(rows: DataFrame) -> DataFrame:
        return rows.where(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))

    start_outputs(stream, {"kept": kept, "rejected": rejected}, root, f"{root}/checkpoint").awaitTermination()
    said = spark.read.schema("value string").parquet(f"{root}/kept").select("value")
    batch = scored_messages(read_delimited(spark, path, SCORING_INPUT), model, F.col("clean_description"))
    # equal rows, with their counts, from both sides, by digests of the texts
    digest = F.sha2("value", 256).alias("digest")
    counts = said.select(digest, F.lit(1).alias("n")).unionByName(batch.select(digest, F.lit(-1).alias("n")))
    unlike = counts.groupBy("digest").agg(F.sum("n").alias("n")).where("n <> 0").agg(F.count("*").alias("n_unlike"))
    classes = said.agg(F.count("*").alias("n_kept"), F.count_distinct(F.get_json_object("value", "$.category")).alias("n_classes"))
    turned = spark.read.schema("value string").parquet(f"{root}/rejected").agg(F.count("*").alias("n_rejected"))
    row = classes.withColumn("one", F.lit(1)).join(turned.withColumn("one", F.lit(1)), "one").join(unlike.withColumn("one", F.lit(1)), "one")  # one row each
    return row.select(
        "n_kept", "n_rejected", (F.col("n_unlike") == 0).alias("same_as_batch"), (F.col("n_classes") >= len(NEWS_CLASSES)).alias("several_classes")
    )


@query(
    "first_two_written",
    f"""SELECT class AS label, description, idx, CAST(r AS INTEGER) AS "row" FROM (SELECT {_CLASS_SQL} AS class, {_PLAIN_SQL.format('text')} AS description,
        doc_id AS idx, row_number() OVER (PARTITION BY {_CLASS_SQL} ORDER BY doc_id) AS r FROM documents
        WHERE text IS NOT NULL AND {_PLAIN_SQL.format('text')} <> '') WHERE r <= 2""",
)
def first_two_written(spark, sf):
    """The first two texts of each class with all columns, written to one ``=`` file and read back."""
    named = F.lit(OTHER)
    for lang, name in CLASS_OF.items():
        named = F.when(F.col("lang") == lang, name).otherwise(named)
    rows = table(spark, sf, "documents").where("text IS NOT NULL").select(named.alias("label"), _plain(F.col("text")).alias("description"), F.col("doc_id").alias("idx"))
    path = scratch_path(spark, "first_two")
    write_delimited(W.first_rows(rows.where("description <> ''"), ["label"], [F.col("idx")], 2), path, files=1)
    return read_delimited(spark, path, T.StructType([*INDEXED_TEXT, T.StructField("row", T.IntegerType())]))


@query(
    "chat_fold_written",
    f"WITH {_TIMED_SQL} SELECT concat({_HEADER_SQL}, ' - ', role, ': ', replace(text, chr(10), ' ')) AS value FROM timed",
)
def chat_fold_written(spark, sf):
    """Folded chat records written one a line, and read back."""
    path = scratch_path(spark, "chat_fold_written")
    write_lines(chat_records(spark, sf).select(F.regexp_replace("value", r"\n", " ").alias("value")), path)
    return read_lines(spark, path)


@query("sink_few_files", "SELECT c_custkey, c_name, 1::BIGINT AS n_files FROM customer")
def sink_few_files(spark, sf):
    """A table of several parts written to one file."""
    rows = table(spark, sf, "customer").select("c_custkey", "c_name").repartition(4)
    path = scratch_path(spark, "sink_few_files")
    write_delimited(rows, path, files=1)
    back = read_delimited(spark, path, rows.schema)
    files = back.select(F.input_file_name().alias("f")).agg(F.count_distinct("f").alias("n_files"))
    return back.join(F.broadcast(files))  # one row


@query("stream_csv_sink", "SELECT event_id, user_id, event_type FROM events")
def stream_csv_sink(spark, sf):
    """A stream of events into CSV files."""
    root = scratch_path(spark, "stream_csv_sink")
    stream = stream_table(spark, f"{sf}/events.parquet*", table(spark, sf, "events").schema).select("event_id", "user_id", "event_type")
    start_stream(stream, "csv", f"{root}/checkpoint", path=f"{root}/out").awaitTermination()
    return spark.read.schema(stream.schema).csv(f"{root}/out")


@query(
    "typed_view",
    """SELECT p_partkey, p_name, CASE WHEN p_partkey % 10 <> 0 THEN p_size END AS p_size, p_retailprice FROM part""",
)
def typed_view(spark, sf):
    """Columns of text as a typed view; every tenth size is unreadable and becomes NULL."""
    rows = table(spark, sf, "part")
    size = F.when(F.col("p_partkey") % 10 == 0, "unreadable").otherwise(F.col("p_size").cast("string"))
    texts = rows.select(*[F.col(c).cast("string").alias(c) for c in ("p_retailprice", "p_name", "p_partkey")], size.alias("p_size"))
    wanted = rows.select("p_partkey", "p_name", "p_size", "p_retailprice").schema
    return conform(texts, wanted)
