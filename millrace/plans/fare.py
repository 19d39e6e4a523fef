"""Fare regression: trip distance and hour of day as features, elastic-net regression."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import Bucketizer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_km, legacy_trip_km
from ..operators.quantiles import quantile_edges

# Number of hour bins, iterations, elastic-net mix and regularisation of the model.
HOUR_BINS = 4
MAX_ITER = 3
ELASTIC_NET = 0.8
REG_PARAM = 0.3


def prepare(trips: DataFrame, legacy: bool = False) -> DataFrame:
    """Trips with a positive fare and a positive distance, with ``distance`` and ``hour`` added.

    The same function serves training and scoring. A distance that is not a number is NULL and
    so does not pass; the pickup time may be text or a timestamp.
    """
    measure = legacy_trip_km if legacy else haversine_km
    ends = ("pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude")
    paid = trips.where(F.col("label") > 0)
    measured = paid.withColumn("distance", measure(*[F.col(c) for c in ends]))
    moved = measured.where(F.col("distance") > 0)  # the distances are never NaN
    return moved.withColumn("hour", F.hour(F.col("pickup_datetime").try_cast("timestamp_ntz")))


def usable(rows: DataFrame) -> Column:
    """Whether a prepared trip has what the model needs; others are rejected, never dropped unseen."""
    return F.col("hour").isNotNull() & F.col("distance").isNotNull()


def counted(rows: DataFrame) -> DataFrame:
    """(n, n_usable, n_rejected) of prepared trips."""
    return rows.agg(
        F.count("*").alias("n"), F.count_if(usable(rows)).alias("n_usable"), F.count_if(~usable(rows)).alias("n_rejected")
    )


def split_by_key(rows: DataFrame, key: str = "key", test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    """(training, test) rows by a hash of the key: the same rows every time, in one pass each."""
    side = F.pmod(F.xxhash64(key), F.lit(100))
    return rows.where(side >= test_percent), rows.where(side < test_percent)


def train(rows: DataFrame, seed_edges: list[float] | None = None) -> PipelineModel:
    """Fit on prepared trips. Hours have 24 values, so their quantiles come from 24 counts."""
    rows = rows.where(usable(rows))
    edges = seed_edges or quantile_edges(rows, "hour", HOUR_BINS, max_rows=None)
    bins = Bucketizer(
        splits=[float("-inf"), *edges, float("inf")], inputCol="hour", outputCol="hourbin", handleInvalid="error"
    )
    vector = VectorAssembler(inputCols=["hourbin", "distance"], outputCol="features", handleInvalid="error")
    regression = LinearRegression(maxIter=MAX_ITER, elasticNetParam=ELASTIC_NET, regParam=REG_PARAM)
    return Pipeline(stages=[bins, vector, regression]).fit(rows)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Every row: predictions of the usable trips, NULL for the others."""
    columns = ["key", "label", "distance", "hour", "hourbin", "prediction"]
    told = model.transform(rows.where(usable(rows))).select(*columns)
    none = F.lit(None).cast("double")
    rest = rows.where(~usable(rows)).withColumns({"hourbin": none, "prediction": none}).select(*columns)
    return told.unionByName(rest)
