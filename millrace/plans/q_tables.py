"""Queries over tables: constants, append, upsert, views, summaries, labels, JSON, distances."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.chat import parse_time
from ..functions.geo import haversine_km, legacy_trip_km
from ..functions.labels import class_name, class_number, json_payload
from ..operators import tables as T
from ..operators.keyed_table import KeyedTable
from ..operators.quantiles import approximate_quantiles, bin_number, merged_quantiles, quantile_edges, quantile_sketches, rank_errors
from ..session import scratch_path
from . import fare
from .catalog import query, table

EVENT_CLASSES = {"click": 0, "view": 1, "purchase": 2, "signup": 3}

# Rows written in the program: two keys the table has, one it has not.
NEW_CUSTOMERS = [
    (0, "Customer new 0", 1, 10.5, "BUILDING"),
    (1, "Customer new 1", 2, 20.25, "MACHINERY"),
    (-1, "Customer new 2", 3, 30.75, "HOUSEHOLD"),
]
_NEW_SQL = "(VALUES " + ", ".join(
    f"({k}, '{n}', {c}, {b}, '{m}')" for k, n, c, b, m in NEW_CUSTOMERS
) + ") AS v(c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)"
_CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@query("add_literal", "SELECT *, 'hello' AS temp_col FROM customer")
def add_literal(spark, sf):
    return T.add_constant(table(spark, sf, "customer"), "temp_col", "hello")


@query(
    "append_rows",
    f"SELECT {_CUSTOMER} FROM customer UNION ALL SELECT {_CUSTOMER} FROM {_NEW_SQL}",
)
def append_rows(spark, sf):
    base = table(spark, sf, "customer")
    return T.append_rows(base, T.literal_rows(spark, NEW_CUSTOMERS, base.schema))


@query(
    "upsert_rows",
    f"""SELECT {_CUSTOMER} FROM customer
        WHERE c_custkey NOT IN (SELECT c_custkey FROM {_NEW_SQL})
        UNION ALL SELECT {_CUSTOMER} FROM {_NEW_SQL}""",
)
def upsert_rows(spark, sf):
    base = table(spark, sf, "customer")
    return T.upsert_rows(base, T.literal_rows(spark, NEW_CUSTOMERS, base.schema), ["c_custkey"])


@query(
    "upsert_stored",
    f"""SELECT {_CUSTOMER} FROM customer
        WHERE c_custkey NOT IN (SELECT c_custkey FROM {_NEW_SQL})
        UNION ALL SELECT {_CUSTOMER} FROM {_NEW_SQL}""",
)
def upsert_stored(spark, sf):
    """A stored table of which only the folders of the updated keys are rewritten."""
    base = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    stored = KeyedTable(spark, scratch_path(spark, "upsert_stored"), base.schema, ["c_custkey"], parts=16)
    stored.create(base)
    stored.upsert(T.literal_rows(spark, NEW_CUSTOMERS, base.schema))
    return stored.read()


@query("view_scan", f"SELECT {_CUSTOMER} FROM customer")
def view_scan(spark, sf):
    T.register_view(table(spark, sf, "customer"), "customer_view")
    return spark.sql(f"SELECT {_CUSTOMER} FROM customer_view")


@query("row_count", "SELECT count(*) AS n FROM customer")
def row_count(spark, sf):
    return T.row_count(table(spark, sf, "customer"))


def _describe_sql(column: str) -> str:
    return f"""SELECT '{column}' AS col_name, count({column}) AS cnt, round(avg({column}), 6) AS mean,
        round(stddev_samp({column}), 6) AS stddev, CAST(min({column}) AS DOUBLE) AS min,
        CAST(max({column}) AS DOUBLE) AS max FROM customer"""


@query("describe_cols", " UNION ALL ".join(_describe_sql(c) for c in ("c_custkey", "c_nationkey", "c_acctbal")))
def describe_cols(spark, sf):
    stats = T.describe_columns(table(spark, sf, "customer"), ["c_custkey", "c_nationkey", "c_acctbal"])
    return stats.withColumn("mean", F.round("mean", 6)).withColumn("stddev", F.round("stddev", 6))


_CLASS_SQL = "CASE trim(event_type) " + " ".join(
    f"WHEN '{k}' THEN {v}" for k, v in EVENT_CLASSES.items()
) + " ELSE 10 END"


@query(
    "label_map",
    f"SELECT event_id, label FROM (SELECT event_id, {_CLASS_SQL} AS label FROM events) WHERE label <> 10",
)
def label_map(spark, sf):
    labelled = table(spark, sf, "events").select(
        "event_id", class_number(F.col("event_type"), EVENT_CLASSES).alias("label")
    )
    return labelled.where(F.col("label") != 10)


@query(
    "category_name",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view', 'purchase', 'signup')
       THEN event_type ELSE 'unknown' END AS category FROM events""",
)
def category_name(spark, sf):
    number = class_number(F.col("event_type"), EVENT_CLASSES)
    return table(spark, sf, "events").select("event_id", class_name(number, EVENT_CLASSES).alias("category"))


@query(
    "json_payload",
    "SELECT CAST(to_json({'event_id': event_id, 'event_type': event_type}) AS VARCHAR) AS value FROM events",
)
def payload(spark, sf):
    return table(spark, sf, "events").select(json_payload("event_id", "event_type"))


# An export that added six hours to the clock: evening times are no longer valid.
@query(
    "bad_timestamps",
    """SELECT event_id, concat(month(ts), '/', day(ts), '/', strftime(ts, '%y'), ', ',
              hour(ts) + 6, ':', strftime(ts, '%M')) AS text
       FROM events WHERE hour(ts) + 6 > 23""",
)
def bad_timestamps(spark, sf):
    ts = F.col("ts")
    text = F.concat(
        F.date_format(ts, "M/d/yy, "), (F.hour(ts) + 6).cast("string"), F.date_format(ts, ":mm")
    )
    return table(spark, sf, "events").select("event_id", text.alias("text")).where(
        parse_time(F.col("text")).isNull()
    )


@query(
    "sorted_within_partitions",
    "SELECT user_id, ts, event_id, value FROM events",
)
def sorted_within_partitions(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    return T.arrange(rows, ["user_id"], ["ts", "event_id"])


@query(
    "series_parse",
    "SELECT CAST(user_id AS VARCHAR) AS symbol, CAST(ts AS DATE) AS date, value AS price FROM events",
)
def series_parse(spark, sf):
    lines = table(spark, sf, "events").select(
        F.concat_ws(",", F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd"), F.col("value").cast("string")).alias("line")
    )
    field = F.split("line", ",")
    return lines.select(
        field[0].alias("symbol"),
        F.try_element_at(field, F.lit(2)).try_cast("date").alias("date"),
        F.try_element_at(field, F.lit(3)).try_cast("double").alias("price"),
    )


def trips(spark, sf):
    """Trips derived from the events: two places from the id, the value as fare."""
    i = F.col("event_id")
    return table(spark, sf, "events").select(
        i.cast("string").alias("key"),
        F.col("value").alias("label"),
        F.col("ts").alias("pickup_datetime"),
        (i * 7 % 360 - 180).cast("double").alias("pickup_longitude"),
        (i % 180 - 90).cast("double").alias("pickup_latitude"),
        ((i + 1) * 7 % 360 - 180).cast("double").alias("dropoff_longitude"),
        ((i + 1) % 180 - 90).cast("double").alias("dropoff_latitude"),
        F.lit(1).alias("passenger_count"),
    )


TRIPS_SQL = """trips AS (SELECT CAST(event_id AS VARCHAR) AS key, value AS label, ts,
    (event_id * 7 % 360 - 180)::DOUBLE AS lon1, (event_id % 180 - 90)::DOUBLE AS lat1,
    ((event_id + 1) * 7 % 360 - 180)::DOUBLE AS lon2, ((event_id + 1) % 180 - 90)::DOUBLE AS lat2 FROM events)"""
HAVERSINE_SQL = """haversine AS (SELECT *, least(1.0, pow(sin((radians(lat2) - radians(lat1)) / 2), 2)
    + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)) AS a FROM trips),
    measured AS (SELECT *, 6372.8 * 2 * atan2(sqrt(a), sqrt(1 - a)) AS distance FROM haversine)"""
_ENDS = ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")


@query("trip_distance", f"WITH {TRIPS_SQL}, {HAVERSINE_SQL} SELECT key, round(distance, 6) AS distance FROM measured")
def trip_distance(spark, sf):
    return trips(spark, sf).select("key", F.round(haversine_km(*[F.col(c) for c in _ENDS]), 6).alias("distance"))


@query(
    "trip_distance_legacy",
    f"""WITH {TRIPS_SQL}, terms AS (SELECT key,
          pow(sin(radians(radians(lat1) - radians(lon1)) / 2), 2)
          + cos(radians(lat1)) * cos(radians(lon1)) * pow(radians(radians(lat2) - radians(lon2)) / 2, 2) AS a
        FROM trips)
        SELECT key, CASE WHEN a BETWEEN 0 AND 1
          THEN round(6372.8 * 2 * atan2(sqrt(a), sqrt(1 - a)), 6) END AS distance FROM terms""",
)
def trip_distance_legacy(spark, sf):
    return trips(spark, sf).select("key", F.round(legacy_trip_km(*[F.col(c) for c in _ENDS]), 6).alias("distance"))


@query(
    "fare_prepare",
    f"""WITH {TRIPS_SQL}, {HAVERSINE_SQL}
        SELECT key, label, CAST(hour(ts) AS INTEGER) AS hour, round(distance, 6) AS distance FROM measured
        WHERE label > 0 AND distance > 0""",
)
def fare_prepare(spark, sf):
    return fare.prepare(trips(spark, sf)).select("key", "label", "hour", F.round("distance", 6).alias("distance"))


@query(
    "hour_bins",
    """WITH h AS (SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events),
       q AS (SELECT quantile_disc(hour, 0.25) AS e1, quantile_disc(hour, 0.5) AS e2,
                    quantile_disc(hour, 0.75) AS e3 FROM h),
       e AS (SELECT list_distinct([e1, e2, e3]) AS edges FROM q)
       SELECT event_id, hour, CAST(len(list_filter(edges, lambda x: x <= hour)) AS INTEGER) AS hourbin FROM h, e""",
)
def hour_bins(spark, sf):
    hours = table(spark, sf, "events").select("event_id", F.hour("ts").alias("hour"))
    edges = quantile_edges(hours, "hour", 4, max_rows=None)  # an hour has 24 values
    return hours.withColumn("hourbin", bin_number(F.col("hour"), edges))


PROBABILITIES = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]
#: Largest miss of a rank as a share of all rows: of the summary, which keeps it always, and of merged sketches.
RANK_ERROR, SKETCH_ERROR = 0.005, 0.03
_RANKS_SQL = f"SELECT unnest({PROBABILITIES})::DOUBLE AS probability, (SELECT count(value) FROM events) AS n, TRUE AS within"


def _within(rows, found, error: float):
    return rank_errors(rows, "value", found).select("probability", "n", (F.col("error") <= error).alias("within"))


@query("quantiles_approx", _RANKS_SQL)
def quantiles_approx(spark, sf):
    """Quantiles from a summary of bounded size, their ranks counted afterwards."""
    rows = table(spark, sf, "events").select("value")
    return _within(rows, approximate_quantiles(rows, "value", PROBABILITIES, RANK_ERROR), RANK_ERROR)


@query("quantiles_merged", _RANKS_SQL)
def quantiles_merged(spark, sf):
    """A sketch of each day and event type is written; the quantiles of all rows come from the written sketches."""
    rows = table(spark, sf, "events").select("value", "event_type", F.to_date("ts").alias("day"))
    path = scratch_path(spark, "quantile_sketches")
    quantile_sketches(rows, ["day", "event_type"], "value").write.parquet(path)
    return _within(rows, merged_quantiles(spark.read.parquet(path), PROBABILITIES), SKETCH_ERROR)
