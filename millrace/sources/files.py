"""Readers. Every schema is explicit; separators and paths are parameters."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import settle


def read_table(spark: SparkSession, path: str, spread: bool = False) -> DataFrame:
    """A Parquet table.

    ``spread`` is for steps with much work per row: an input of fewer pieces than the cluster has
    cores is dealt out evenly first. A table of many files is read as it lies.
    """
    df = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    if spread and df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def read_header_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Comma-separated files whose first line names the columns."""
    return spark.read.schema(schema).csv(path, header=True)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = "=") -> DataFrame:
    """Files without header, cut at ``sep``; the path may hold wildcards.

    Blanks around fields are kept, extra fields are dropped and missing ones are NULL, so callers
    trim names and drop rows without text.
    """
    return spark.read.schema(schema).csv(path, sep=sep)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): one row per line."""
    return spark.read.text(path)


def read_placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, line, value): lines that can be put back in order within their file.

    ``block`` is where the piece of the file starts that a task read, ``line`` rises within it.
    Large files stay divided over many tasks. The pair is unique and ordered within a file.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
        "value",
    )


def _plain_name(name):
    """A file's name with one slash after its scheme, as different readers write it."""
    return F.regexp_replace(name, "^([A-Za-z0-9]+):/+", "$1:/")


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file_no, block, line, value): lines as ``read_placed_lines`` gives them, with the place of their file.

    ``file_no`` numbers the files by name, digits by value. Spark reads files by size, so ``line`` alone tells nothing of two files.
    The names are listed without reading the files.
    """
    lines = read_placed_lines(spark, path)
    names = [re.sub("^([A-Za-z0-9]+):/+", r"\1:/", name) for name in spark.read.text(path).inputFiles()]
    names.sort(key=lambda name: [int(x) if x.isdecimal() else x for x in re.split(r"([0-9]+)", name)])
    numbered = spark.createDataFrame(list(enumerate(names)), "file_no long, _name string")
    placed = lines.join(F.broadcast(numbered), _plain_name(F.col("file")) == F.col("_name"))
    return placed.select("file_no", "block", "line", "value")


#: Pieces of files whose first numbers are sent to all tasks; of more pieces they are joined by shuffle.
SENT_PIECES = 100_000


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(idx, value): lines numbered from 1 as they stand in their files, files in the order of ``read_ordered_lines``.

    Lines are not sorted: those of each piece of a file are counted, the counts summed up over the pieces, a row each, and a line's number is
    the sum before its piece and its place within it. Lines are written once, so that both steps see the same places.
    """
    lines = settle(read_ordered_lines(spark, path), "placed_lines")
    pieces = lines.groupBy("file_no", "block").agg(F.count("*").alias("n"), F.min("line").alias("first"))
    pieces = settle(pieces, "pieces")
    before = Window.orderBy("file_no", "block").rowsBetween(Window.unboundedPreceding, -1)  # one row per piece
    offsets = pieces.select("file_no", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    offsets = F.broadcast(offsets) if pieces.count() <= SENT_PIECES else offsets
    numbered = lines.join(offsets, ["file_no", "block"])
    return numbered.select((F.col("offset") + F.col("line") - F.col("first") + 1).alias("idx"), "value")


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """(word): a list with one word per line, lower-cased, blank lines skipped."""
    words = spark.read.text(path).select(F.lower(F.trim("value")).alias("word"))
    return words.where("word != ''").distinct()


def stream_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = "=", max_files: int | None = None, corrupt: str | None = None
) -> DataFrame:
    """Stream of delimited files; a file counts as seen by its name.

    With ``corrupt`` a column of that name holds the whole line where it has not as many fields as the schema, else NULL.
    """
    reader = spark.readStream.option("sep", sep).option("fileNameOnly", "true")
    if corrupt:
        schema = T.StructType([*schema, T.StructField(corrupt, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", corrupt).option("mode", "PERMISSIVE")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.schema(schema).csv(path)


def stream_table(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """Stream of Parquet files."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
