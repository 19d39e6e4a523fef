"""Score a stream of texts with a saved classifier and emit one JSON message per text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import NEWS_CLASSES, class_name, json_payload
from ..plans.classify import cleaned


def scored_messages(
    rows: DataFrame,
    model: PipelineModel,
    text: Column,
    classes: Mapping[str, int] = NEWS_CLASSES,
    clean: bool = True,
) -> DataFrame:
    """(value): JSON of the text and the name of its predicted class, for a table or a stream.

    Texts are cleaned as they were for training; ``clean=False`` scores them as they come. All
    steps are per row, so the stream keeps no state.
    """
    if clean:
        ready = cleaned(rows, text)
    else:
        ready = rows.where(text.isNotNull()).select(text.alias("clean_description"))
    predicted = model.transform(ready)
    named = predicted.withColumn("category", class_name(F.col("prediction"), classes))
    return named.select(json_payload("clean_description", "category"))
