"""Queries over chat records: folding, parsing, texts per sender, words, monthly ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.chat import render_time
from ..operators import chat
from ..operators.windows import lists_in_order
from .catalog import query, table

STOP = ["the", "and", "of", "to", "in", "is", "a", "la", "de", "le", "der", "die", "und", "el"]
_STOP_SQL = ", ".join(f"'{w}'" for w in STOP)
# Each turn gets a minute of its own, within fifty years so that a two-digit year stays clear.
MINUTES = 60 * 24 * 365 * 50

_TIMED_SQL = f"""timed AS (SELECT *, TIMESTAMP '2017-01-01 00:00:00'
    + to_minutes(CAST((conv_id * 60 + turn) % {MINUTES} AS INTEGER)) AS ts FROM conversations)"""
_HEADER_SQL = """concat(month(ts), '/', day(ts), '/', strftime(ts, '%y'), ', ', hour(ts), ':', strftime(ts, '%M'))"""


def chat_lines(spark, sf):
    """The conversations as chat exports, one file per conversation, one row per line."""
    minutes = ((F.col("conv_id") * 60 + F.col("turn")) % MINUTES).cast("int")
    ts = F.expr("TIMESTAMP_NTZ'2017-01-01 00:00:00'") + F.make_dt_interval(mins=minutes)
    value = F.concat(render_time(ts), F.lit(" - "), F.col("role"), F.lit(": "), F.col("text"))
    records = table(spark, sf, "conversations").select("conv_id", "turn", F.split(value, "\n").alias("lines"))
    return records.select("conv_id", "turn", F.posexplode("lines").alias("pos", "value"))


def chat_records(spark, sf, **sizes):
    return chat.fold_lines(chat_lines(spark, sf), ["conv_id"], ["turn", "pos"], **sizes)


@query(
    "chat_fold",
    f"""WITH {_TIMED_SQL} SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS record,
        0 AS part, concat({_HEADER_SQL}, ' - ', role, ': ', text) AS value FROM timed""",
)
def chat_fold(spark, sf):
    return chat_records(spark, sf).select("conv_id", "record", "part", "value")


@query(
    "chat_parse_parts",
    f"""WITH {_TIMED_SQL}, lines AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS record,
            string_split(text, chr(10)) AS l FROM timed),
        parts AS (SELECT *, unnest(range(0, (len(l) + 1) // 2)) AS part FROM lines)
        SELECT conv_id, record, part, {_HEADER_SQL} AS header, ts AS timestamp, role AS name,
            array_to_string(l[2 * part + 1:2 * part + 2], chr(10)) AS msg FROM parts""",
)
def chat_parse_parts(spark, sf):
    """Records that go on in parts of two lines."""
    return chat.parse_records(chat_records(spark, sf, max_lines=2), keep=["conv_id", "record", "part"])


@query(
    "chat_parse",
    f"""WITH {_TIMED_SQL} SELECT conv_id, {_HEADER_SQL} AS header, ts AS timestamp, role AS name, text AS msg
        FROM timed""",
)
def chat_parse(spark, sf):
    return chat.parse_records(chat_records(spark, sf), keep=["conv_id"])


@query(
    "group_texts",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) - 1 AS n FROM conversations)
       SELECT role, n // 100 AS chunk, string_agg(text, ' | ' ORDER BY conv_id, turn) AS texts FROM r GROUP BY ALL""",
)
def group_texts(spark, sf):
    rows = table(spark, sf, "conversations")
    lists = lists_in_order(rows, ["role"], ["conv_id", "turn"], ["text"], "texts", chunk_rows=100)
    return lists.select("role", "chunk", F.array_join("texts", " | ").alias("texts"))


@query(
    "chat_word_count",
    rf"""WITH w AS (SELECT role AS name, unnest(string_split_regex(lower(replace(text, ':', '')), '\s')) AS word
            FROM conversations WHERE role = 'user')
        SELECT name, word, count(*) AS count FROM w WHERE word <> '' AND word NOT IN ({_STOP_SQL})
        GROUP BY ALL""",
)
def chat_word_count(spark, sf):
    counts = chat.word_counts(table(spark, sf, "conversations"), STOP, only="user", name="role", text="text")
    return counts.orderBy(F.desc("count"), "name", "word")


@query(
    "monthly_counts",
    """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
       o_orderpriority AS name, count(*) AS count FROM orders GROUP BY ALL""",
)
def monthly_counts(spark, sf):
    counts = chat.monthly_counts(table(spark, sf, "orders"), F.col("o_orderdate"), F.col("o_orderpriority"))
    return counts.orderBy(F.desc("month"), F.desc("count"), "year", "name")


@query(
    "monthly_rank",
    """WITH c AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
         o_orderpriority AS name, count(*) AS count FROM orders GROUP BY ALL)
       SELECT *, CAST(dense_rank() OVER (PARTITION BY year, month ORDER BY count DESC) AS INTEGER) AS rank FROM c""",
)
def monthly_rank(spark, sf):
    return chat.monthly_rank(table(spark, sf, "orders"), F.col("o_orderdate"), F.col("o_orderpriority"))
