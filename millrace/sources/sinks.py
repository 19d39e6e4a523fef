"""Writers for tables, text lines, fitted models and streams."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def write_delimited(df: DataFrame, path: str, sep: str = "=", files: int | None = None, mode: str = "error") -> None:
    """Delimited files without header, as many as there are partitions.

    ``files`` brings a small result into fewer files. Quotes inside fields are escaped with a
    backslash, so read them back the same way.
    """
    out = df.coalesce(files) if files else df
    out.write.mode(mode).csv(path, sep=sep)


def feed_lines(df: DataFrame, label: Column, text: Column) -> DataFrame:
    """(value): ``label = text`` on one line each, rows with empty text left out."""
    flat = F.regexp_replace(text, r"[\r\n]+", " ")
    return df.where(text != "").select(F.concat_ws(" = ", label, flat).alias("value"))


def write_lines(df: DataFrame, path: str, files: int | None = None, mode: str = "error") -> None:
    """One text line per row of a one-column table."""
    out = df.coalesce(files) if files else df
    out.write.mode(mode).text(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def start_stream(
    df: DataFrame,
    fmt: str,
    checkpoint: str,
    options: Mapping[str, str] | None = None,
    path: str | None = None,
    name: str | None = None,
    interval: str | None = None,
) -> StreamingQuery:
    """Start writing a stream in append mode: ``kafka``, ``console``, ``csv``, ``parquet``, ``memory``.

    Without ``interval`` the stream takes what is there and ends. The Kafka format needs its
    connector on the class path, the options ``kafka.bootstrap.servers`` and ``topic``, and a
    column ``value``.
    """
    writer = df.writeStream.outputMode("append").format(fmt).options(**(options or {}))
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start(path) if path else writer.start()


def start_outputs(
    df: DataFrame,
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
    root: str,
    checkpoint: str,
    interval: str | None = None,
) -> StreamingQuery:
    """Write several tables from each micro-batch, each to ``root/<name>/batch=<n>``.

    Every output of a batch has a folder of its own, which a batch that is run again replaces: after a failure between any two steps,
    a restart leaves each row once in each output.
    """

    def write_batch(batch: DataFrame, number: int) -> None:
        for name, make in outputs.items():
            make(batch).write.mode("overwrite").parquet(f"{root}/{name}/batch={number}")

    writer = df.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write_batch)
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()
