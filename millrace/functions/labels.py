"""Class names to numbers and back, and the JSON payload of a scored row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class numbers of the news classes, and the number for any other class.
NEWS_CLASSES = {"Sports": 0, "Education": 1, "Technology": 2, "Health": 3, "Business": 4}
OTHER_CLASS = 10
# White space and control characters, which may stand around a class name.
AROUND = "".join(map(chr, range(0x21)))


def class_number(
    name: Column, classes: Mapping[str, int] = NEWS_CLASSES, other: int = OTHER_CLASS
) -> Column:
    """Number of a class name after trimming white space; unknown names and NULL give ``other``."""
    number = F.lit(other)
    for known, value in classes.items():
        number = F.when(F.btrim(name, F.lit(AROUND)) == known, value).otherwise(number)
    return number


def class_name(
    number: Column, classes: Mapping[str, int] = NEWS_CLASSES, other: str = "unknown"
) -> Column:
    """Name of a class number; unknown numbers and NULL give ``other``."""
    name = F.lit(other)
    for known, value in classes.items():
        name = F.when(number == value, known).otherwise(name)
    return name


def json_payload(*columns: str) -> Column:
    """One JSON object of the named columns, in the column ``value`` a message sink expects."""
    return F.to_json(F.struct(*columns)).alias("value")
