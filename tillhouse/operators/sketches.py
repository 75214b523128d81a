"""Approximate aggregates that are kept and merged: distinct counts, sizes of overlaps, quantiles.

Rows are read once, into one small sketch per group; days roll up to months, and new batches join old ones, from the
sketches alone.  All sketches are Spark's own.  Each is combined on the map side, so a group with a third of all rows is no
hot group, and its size does not depend on the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from math import sqrt
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

SIGMAS = 4  # standard errors within which counts lie
LOG2_SIZE = 12  # of the entries of a sketch that counts
RANKS = 800  # accuracy of a sketch of quantiles


@dataclass(frozen=True)
class Sketch:
    """How rows become a sketch, how sketches become one, and the error that its results stay within."""

    build: Column
    merge: Callable[[Column], Column]
    bound: float


def distinct(value: Column, log2_size: int = LOG2_SIZE) -> Sketch:
    """For ``distinct_estimate``; ``bound`` is relative to the count.  Integers, text or binary."""
    return Sketch(F.hll_sketch_agg(value, log2_size), F.hll_union_agg, SIGMAS * 1.04 / sqrt(1 << log2_size))


def distinct_set(value: Column, log2_size: int = LOG2_SIZE) -> Sketch:
    """For ``set_estimate`` and ``overlap_estimate``; ``bound`` is relative to the count of both sets together."""

    def merge(sketches: Column) -> Column:
        return F.theta_union_agg(sketches, log2_size)

    return Sketch(F.theta_sketch_agg(value, log2_size), merge, SIGMAS / sqrt(1 << log2_size))


def quantiles(value: Column, ranks: int = RANKS) -> Sketch:
    """For ``quantile_estimate``; ``bound`` is the distance in rank, as a share of the values.

    It is twice the distance that is kept in 99 of 100 cases.  Nulls and NaN are not among the values.
    """

    def merge(sketches: Column) -> Column:
        return F.kll_merge_agg_double(sketches, ranks)

    return Sketch(F.kll_sketch_agg_double(value.cast("double"), ranks), merge, 2 * 2.296 / ranks**0.9723)


def distinct_estimate(sketch: Column) -> Column:
    """Different values, nulls aside; 0 of a missing sketch."""
    return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0)).cast("long")


def set_estimate(sketch: Column) -> Column:
    return F.coalesce(F.theta_sketch_estimate(sketch), F.lit(0)).cast("long")


def overlap_estimate(left: Column, right: Column) -> Column:
    """Values that are in both; 0 if either sketch is missing."""
    return set_estimate(F.theta_intersection(left, right))


def quantile_estimate(sketch: Column, share: float) -> Column:
    """The value below which that share of the values lies; null without values."""
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(share))))


def sketch_rows(df: DataFrame, keys: Sequence[str], sketches: dict[str, Sketch]) -> DataFrame:
    """One row of sketches per group; a null key is a group like others."""
    return df.groupBy(*keys).agg(*[own.build.alias(name) for name, own in sketches.items()])


def roll_up(parts: DataFrame, keys: Sequence[str | Column], sketches: dict[str, Sketch]) -> DataFrame:
    """The same by coarser keys, from sketches only; expressions of the finer keys are welcome."""
    return parts.groupBy(*keys).agg(*[own.merge(F.col(f"`{name}`")).alias(name) for name, own in sketches.items()])


class SketchTable:
    """Sketches by ``keys`` in Parquet, with a folder for each batch.

    A batch may hold late rows of any group: groups meet when they are rolled up.  Adding a batch again replaces it, so a
    repeated or failed run counts nothing twice; a run that fails while it replaces a batch leaves that batch out until it
    is repeated.  Works as the function of a stream's ``foreachBatch``.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], sketches: dict[str, Sketch]):
        if "batch" in (*keys, *sketches) or set(keys) & set(sketches):
            raise ValueError("names of keys, sketches and batch clash")
        self.spark, self.path, self.keys, self.sketches = spark, path.rstrip("/"), tuple(keys), dict(sketches)

    def add(self, rows: DataFrame, batch: str | int) -> None:
        found = sketch_rows(rows, self.keys, self.sketches)
        found.write.mode("overwrite").parquet(f"{self.path}/batch={quote(str(batch), safe='')}")

    def parts(self) -> DataFrame:
        """(keys, sketches, batch), one row for each group of each batch."""
        first = self.spark.read.option("basePath", self.path).parquet(f"{self.path}/batch=*")
        fields = [field for field in first.schema.fields if field.name != "batch"]
        schema = StructType([*fields, StructField("batch", StringType())])
        return self.spark.read.schema(schema).parquet(self.path)

    def roll_up(self, keys: Sequence[str | Column]) -> DataFrame:
        return roll_up(self.parts(), keys, self.sketches)
