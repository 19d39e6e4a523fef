"""Queries that fit and apply models: text classification, its streaming form, fare regression."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.files import stream_table
from ..sources.sinks import load_model, save_model, start_stream
from ..streaming.score import scored_messages
from . import classify, fare
from .catalog import query, table
from .q_tables import HAVERSINE_SQL, TRIPS_SQL, trips

QUALITY = {"low": 0, "high": 1}


def labelled(spark, sf):
    """Documents that have a label, cleaned."""
    rows = table(spark, sf, "documents", spread=True).join(table(spark, sf, "labels"), "doc_id")
    return classify.cleaned(rows, F.col("text"), F.col("doc_id"), F.col("quality").alias("label"))


@query("classify_train")
def classify_train(spark, sf):
    rows = labelled(spark, sf)
    scored = classify.train(rows).transform(rows)
    return classify.accuracy(scored)


@query(
    "classify_train_check",
    "SELECT count(*) AS n, TRUE AS beats_majority FROM documents JOIN labels USING (doc_id) WHERE text IS NOT NULL",
)
def classify_train_check(spark, sf):
    """Whether the fitted model is right at least as often as the more frequent class."""
    rows = labelled(spark, sf)
    scored = classify.train(rows).transform(rows)
    right = F.avg((F.col("prediction") == F.col("label")).cast("int"))
    share = F.avg("label")
    return scored.agg(F.count("*").alias("n"), (right >= F.greatest(share, 1 - share) - 1e-9).alias("beats_majority"))


def saved_model(spark, sf) -> str:
    path = scratch_path(spark, "classifier")
    save_model(classify.train(labelled(spark, sf)), path)
    return path


@query("classify_score")
def classify_score(spark, sf):
    """Trained, saved, loaded again, and applied to all documents."""
    model = load_model(saved_model(spark, sf))
    rows = classify.cleaned(table(spark, sf, "documents", spread=True), F.col("text"), F.col("doc_id"))
    scored = classify.score(model, rows, "doc_id")
    return scored.select(
        "doc_id", F.transform("probability", lambda p: F.round(p, 6)).alias("probability"), "prediction"
    )


@query(
    "classify_score_check",
    "SELECT doc_id, TRUE AS sums_to_one, TRUE AS known_class FROM documents WHERE text IS NOT NULL",
)
def classify_score_check(spark, sf):
    scored = classify_score(spark, sf)
    total = F.aggregate("probability", F.lit(0.0), lambda s, p: s + p)
    return scored.select(
        "doc_id", (F.abs(total - 1) < 1e-5).alias("sums_to_one"), F.col("prediction").isin(0.0, 1.0).alias("known_class")
    )


@query("stream_score")
def stream_score(spark, sf):
    """The documents arrive as a stream and leave as JSON messages."""
    model = load_model(saved_model(spark, sf))
    root = scratch_path(spark, "stream_score")
    schema = table(spark, sf, "documents").schema
    stream = stream_table(spark, f"{sf}/documents.parquet*", schema)
    messages = scored_messages(stream, model, F.col("text"), QUALITY)
    start_stream(messages, "parquet", f"{root}/checkpoint", path=f"{root}/out").awaitTermination()
    return spark.read.parquet(f"{root}/out").select("value")


@query(
    "stream_score_check",
    r"""SELECT regexp_replace(lower(text), '[^a-z\s]', '', 'g') AS clean_description, TRUE AS known_class
        FROM documents WHERE text IS NOT NULL""",
)
def stream_score_check(spark, sf):
    said = stream_score(spark, sf).select(F.from_json("value", "clean_description string, category string").alias("m"))
    return said.select("m.clean_description", F.col("m.category").isin(*QUALITY).alias("known_class"))


@query(
    "fare_rejects",
    f"""WITH {TRIPS_SQL}, {HAVERSINE_SQL}, late AS (SELECT *, CAST(key AS BIGINT) % 10 = 0 AS bad FROM measured WHERE label > 0 AND distance > 0)
        SELECT count(*) AS n, count(*) FILTER (NOT bad) AS n_usable, count(*) FILTER (bad) AS n_rejected FROM late""",
)
def fare_rejects(spark, sf):
    """Every tenth pickup time is unreadable; such trips are counted, not lost."""
    late = F.when(F.col("key").cast("bigint") % 10 == 0, "unreadable").otherwise(F.col("pickup_datetime").cast("string"))
    return fare.counted(fare.prepare(trips(spark, sf).withColumn("pickup_datetime", late)))


@query(
    "fare_predict_check",
    f"""WITH {TRIPS_SQL}, {HAVERSINE_SQL} SELECT key, CAST(hour(ts) AS INTEGER) AS hour, round(distance, 6) AS distance, TRUE AS finite
        FROM measured WHERE label > 0 AND distance > 0""",
)
def fare_predict_check(spark, sf):
    """Trained on the training part, predicted for all trips."""
    prepared = fare.prepare(trips(spark, sf))
    predicted = fare.predict(fare.train(fare.split_by_key(prepared)[0]), prepared)
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < float("inf"))
    return predicted.select("key", "hour", F.round("distance", 6).alias("distance"), finite.alias("finite"))


@query("fare_predict")
def fare_predict(spark, sf):
    training, test = fare.split_by_key(fare.prepare(trips(spark, sf)))
    predicted = fare.predict(fare.train(training), test)
    return predicted.select("key", "label", "hour", "hourbin", *[F.round(c, 6).alias(c) for c in ("distance", "prediction")])
