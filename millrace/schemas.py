"""Explicit schemas of the inputs; nothing in this package infers a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP_NTZ": T.TimestampNTZType(),
}


def _schema(spec: str) -> T.StructType:
    """A schema from "name TYPE, ..." without needing a session."""
    fields = (field.split() for field in spec.split(","))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in fields])


PERSON = _schema(
    "id INT, first_name STRING, last_name STRING, email STRING, gender STRING, ip_address STRING"
)
EMPLOYEE = _schema(
    "id INT, first_name STRING, last_name STRING, department STRING, salary INT, gender STRING"
)
LABELLED_TEXT = _schema("label1 STRING, description STRING")
INDEXED_TEXT = _schema("label STRING, description STRING, idx BIGINT")
TIMED_TEXT = _schema("time STRING, category STRING, description STRING")
SCORING_INPUT = _schema("value STRING, clean_description STRING")
FARE = _schema(
    "key STRING, label DOUBLE, pickup_datetime STRING, pickup_longitude DOUBLE, "
    "pickup_latitude DOUBLE, dropoff_longitude DOUBLE, dropoff_latitude DOUBLE, passenger_count INT"
)
CHAT = _schema("timestamp TIMESTAMP_NTZ, name STRING, msg STRING")
PRICE = _schema("symbol STRING, date DATE, price DOUBLE")


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed view of rows: the schema's columns in order, by name.

    A value that cannot be read as its type becomes NULL, a missing column is an error.
    """

    def typed(field: T.StructField) -> Column:
        return F.col(field.name).try_cast(field.dataType).alias(field.name)

    return df.select([typed(f) for f in schema.fields])
