"""Queries that write given tables to files of the formats that jobs meet, and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import chat
from ..operators import windows as W
from ..session import scratch_path
from ..sources.files import read_delimited, read_header_csv, read_numbered_lines, read_placed_lines, read_word_list
from ..sources.sinks import write_delimited, write_lines
from .catalog import query, table
from .q_chat import _HEADER_SQL, _STOP_SQL, _TIMED_SQL, STOP, chat_lines

_TEXT = "regexp_replace(regexp_replace(lower(text), '[^a-z\\s]', '', 'g'), '\\s+', ' ', 'g')"


@query("src_header_csv", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def src_header_csv(spark, sf):
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    path = scratch_path(spark, "src_header_csv")
    rows.write.csv(path, header=True)
    return read_header_csv(spark, path, rows.schema)


@query(
    "src_dollar_glob",
    f"SELECT strftime(TIMESTAMP '2017-01-01' + to_days(CAST(doc_id % 365 AS INTEGER)), '%Y-%m-%d') AS time, lang AS category, "
    f"trim({_TEXT}) AS description FROM documents",
)
def src_dollar_glob(spark, sf):
    """Two folders of files cut at ``$``, read together by a pattern."""
    day = F.date_add(F.lit("2017-01-01").cast("date"), (F.col("doc_id") % 365).cast("int")).cast("string")
    text = F.trim(F.regexp_replace(F.regexp_replace(F.lower("text"), r"[^a-z\s]", ""), r"\s+", " "))
    rows = table(spark, sf, "documents").select("doc_id", day.alias("time"), F.col("lang").alias("category"), text.alias("description"))
    root = scratch_path(spark, "src_dollar_glob")
    for part in (0, 1):
        write_delimited(rows.where(F.col("doc_id") % 2 == part).drop("doc_id"), f"{root}/part{part}", sep="$")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("time", "category", "description")])
    back = read_delimited(spark, f"{root}/part*", schema, sep="$")
    return back.withColumn("description", F.coalesce("description", F.lit("")))


@query(
    "src_chat_lines",
    f"""WITH {_TIMED_SQL} SELECT {_HEADER_SQL} AS header, ts AS timestamp, role AS name, text AS msg FROM timed""",
)
def src_chat_lines(spark, sf):
    """The chats as one text file a conversation's lines in order, read with the place of each line."""
    path = scratch_path(spark, "src_chat_lines")
    lines = chat_lines(spark, sf).repartitionByRange("conv_id").sortWithinPartitions("conv_id", "turn", "pos")
    write_lines(lines.select("value"), path)
    folded = chat.fold_lines(read_placed_lines(spark, path), ["file"], ["block", "line"])
    return chat.parse_records(folded)


@query(
    "chat_word_count_file",
    rf"""WITH w AS (SELECT role AS name, unnest(string_split_regex(lower(replace(text, ':', '')), '\s')) AS word FROM conversations)
        SELECT name, word, count(*) AS count FROM w WHERE word <> '' AND word NOT IN ({_STOP_SQL}) GROUP BY ALL""",
)
def chat_word_count_file(spark, sf):
    """Stop words from a file with a word per line; the words are counted from parsed chat lines."""
    path = scratch_path(spark, "stop_words")
    write_lines(spark.createDataFrame([(w.upper() + " ",) for w in STOP], "value string"), path)
    messages = chat.parse_records(chat.fold_lines(chat_lines(spark, sf), ["conv_id"], ["turn", "pos"]))
    counts = chat.word_counts(messages, [])
    return counts.join(read_word_list(spark, path), "word", "left_anti").select("name", "word", "count")


@query(
    "row_index_read_order",
    """SELECT lang AS label, doc_id, "row" FROM (SELECT lang, doc_id,
        CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS INTEGER) AS "row" FROM documents) WHERE "row" <= 2""",
)
def row_index_read_order(spark, sf):
    """Lines numbered as they stand in their files; the first two of each label, with all columns."""
    path = scratch_path(spark, "row_index_read_order")
    rows = table(spark, sf, "documents").select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    write_lines(ordered.select(F.concat_ws(" = ", "lang", "doc_id").alias("value")), path)
    lines = read_numbered_lines(spark, path)
    cut = F.split("value", " = ")
    labelled = lines.select("idx", cut[0].alias("label"), cut[1].cast("bigint").alias("doc_id"))
    return W.first_rows(labelled, ["label"], [F.col("idx")], 2).select("label", "doc_id", "row")
