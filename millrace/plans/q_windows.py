"""Queries with windows: ranks, running sums, moving averages, row numbers, ordered lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import windows as W
from ..operators.slicing import MAX_GROUP_ROWS
from .catalog import CATALOG, query, table

_BY_BRAND = "OVER (PARTITION BY p_brand ORDER BY p_size DESC)"
_PART = ["p_partkey", "p_brand", "p_size"]


def _part(spark, sf, *more):
    return table(spark, sf, "part").select(*_PART, *more)


@query("win_rank", f"SELECT p_partkey, p_brand, p_size, CAST(rank() {_BY_BRAND} AS INTEGER) AS rank FROM part")
def win_rank(spark, sf, max_rows=MAX_GROUP_ROWS):
    return W.rank_within(_part(spark, sf), ["p_brand"], "p_size", {"rank": "rank"}, max_rows=max_rows)


@query(
    "win_dense_rank",
    f"SELECT p_partkey, p_brand, p_size, CAST(dense_rank() {_BY_BRAND} AS INTEGER) AS rank FROM part",
)
def win_dense_rank(spark, sf, max_rows=MAX_GROUP_ROWS):
    return W.rank_within(_part(spark, sf), ["p_brand"], "p_size", {"dense_rank": "rank"}, max_rows=max_rows)


@query(
    "win_percent_rank",
    f"SELECT p_partkey, p_brand, p_size, round(percent_rank() {_BY_BRAND}, 9) AS percent_rank FROM part",
)
def win_percent_rank(spark, sf, max_rows=MAX_GROUP_ROWS):
    ranked = W.rank_within(_part(spark, sf), ["p_brand"], "p_size", {"percent_rank": "percent_rank"}, max_rows=max_rows)
    return ranked.withColumn("percent_rank", F.round("percent_rank", 9))


@query(
    "win_row_number",
    """SELECT p_partkey, p_brand, p_size,
       row_number() OVER (PARTITION BY p_brand ORDER BY p_size DESC, p_partkey DESC) AS row_num
       FROM part WHERE p_brand = 'Brand#2'""",
)
def win_row_number(spark, sf):
    one = _part(spark, sf).where(F.col("p_brand") == "Brand#2")
    return W.number_rows(one, ["p_brand"], ["p_size", "p_partkey"], "row_num", descending=True)


@query(
    "win_running_sum",
    """SELECT p_partkey, p_brand, p_size, round(sum(p_retailprice) OVER (PARTITION BY p_brand
       ORDER BY p_size DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 2) AS total_sum FROM part""",
)
def win_running_sum(spark, sf, max_rows=MAX_GROUP_ROWS):
    summed = W.rank_within(
        _part(spark, sf, "p_retailprice"), ["p_brand"], "p_size", {"running_sum": "total_sum"}, sum_of="p_retailprice",
        max_rows=max_rows,
    )
    return summed.select(*_PART, F.round("total_sum", 2).alias("total_sum"))


def _events(spark, sf):
    return table(spark, sf, "events").select("event_id", "user_id", "ts", "value")


@query(
    "win_centered_avg",
    """SELECT event_id, round(avg(value) OVER (ORDER BY event_id
       ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS moving_average FROM events""",
)
def win_centered_avg(spark, sf, max_rows=MAX_GROUP_ROWS):
    rows = _events(spark, sf).select("event_id", "value")
    averaged = W.moving_average(rows, [], ["event_id"], "value", "moving_average", 1, 1, max_rows)
    return averaged.select("event_id", F.round("moving_average", 6).alias("moving_average"))


@query(
    "win_centered_avg_by_user",
    """SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS moving_average FROM events""",
)
def win_centered_avg_by_user(spark, sf, max_rows=MAX_GROUP_ROWS):
    averaged = W.moving_average(_events(spark, sf), ["user_id"], ["ts", "event_id"], "value", "moving_average", 1, 1, max_rows)
    return averaged.select("event_id", "user_id", F.round("moving_average", 6).alias("moving_average"))


@query(
    "sma3",
    """SELECT event_id, user_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
       ROWS BETWEEN 2 PRECEDING AND CURRENT ROW), 6) AS sma FROM events""",
)
def sma3(spark, sf, max_rows=MAX_GROUP_ROWS):
    averaged = W.moving_average(_events(spark, sf), ["user_id"], ["ts", "event_id"], "value", "sma", 2, 0, max_rows)
    return averaged.select("event_id", "user_id", F.round("sma", 6).alias("sma"))


@query(
    "first_n_per_label",
    """SELECT doc_id, lang, "row" FROM (SELECT doc_id, lang,
       CAST(row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS INTEGER) AS "row" FROM documents)
       WHERE "row" <= 2""",
)
def first_n_per_label(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang")
    return W.first_rows(rows, ["lang"], [F.col("doc_id")], 2)


@query("row_index", "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents")
def row_index(spark, sf, max_rows=MAX_GROUP_ROWS):
    numbered = W.number_rows(table(spark, sf, "documents").select("doc_id"), [], ["doc_id"], "idx", max_rows=max_rows)
    return numbered.withColumn("idx", F.col("idx") - 1)


@query(
    "series_lists",
    """WITH r AS (SELECT user_id, ts, event_id, value,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events)
       SELECT user_id, n // 50 AS chunk,
         array_to_string(list(strftime(ts, '%Y-%m-%d') || ' ' || CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR)
                              ORDER BY ts, event_id), ';') AS series
       FROM r GROUP BY ALL""",
)
def series_lists(spark, sf, max_rows=MAX_GROUP_ROWS):
    point = F.concat_ws(
        " ", F.date_format("ts", "yyyy-MM-dd"), F.round(F.col("value") * 100).cast("bigint").cast("string")
    )
    rows = _events(spark, sf).withColumn("point", point)
    lists = W.lists_in_order(rows, ["user_id"], ["ts", "event_id"], ["point"], "points", 50, max_rows)
    return lists.select("user_id", "chunk", F.array_join("points", ";").alias("series"))


#: Rows of a group from which the queries below cut it, small enough to cut the smallest tables.
CUT_ROWS = 7


def _cut(build):
    return lambda spark, sf: build(spark, sf, max_rows=CUT_ROWS)


for _build in (
    win_rank, win_dense_rank, win_percent_rank, win_running_sum, win_centered_avg, win_centered_avg_by_user, sma3,
    row_index, series_lists,
):
    query(f"{_build.__name__}_cut", CATALOG[_build.__name__].sql)(_cut(_build))
