"""What several operators share: reading a table, naming a value inside an expression, and splitting words."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """The maximal runs of characters other than space, tab, line feed, vertical tab, form feed and return."""
    return F.array_remove(F.split(text, SPACES, -1), "")


def free_name(wanted: str, taken: Sequence[str]) -> str:
    """``wanted``, with underscores in front until no column has that name (names do not differ by case)."""
    lower = {name.lower() for name in taken}
    while wanted.lower() in lower:
        wanted = f"_{wanted}"
    return wanted


def held_out(key: Column, folds: int, fold: int) -> Column:
    """Whether the CRC-32 of a key as text falls on ``fold``; a missing key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds == fold
