"""Exact samples by stratum that come out the same each time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

SPREAD = 64  # parts that a stratum is ranked in before its best rows meet


def _ticket(keys: Sequence[str], seed: int) -> Column:
    """A digest of a row's keys that any engine can compute: what a row draws does not depend on other rows."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-")) for key in keys]
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *cells).cast("binary"))


def stratified_sample(df: DataFrame, strata: Sequence[str], keys: Sequence[str], size: int, seed: int = 1) -> DataFrame:
    """``size`` rows of each stratum, or all where it has fewer: those whose keys have the smallest digests.

    Null strata and null keys count like others.  Rows with equal keys are taken in the order of their other columns
    (which must be sortable); rows equal in all are interchangeable.  Smallest digests can be merged: a sample of samples
    of parts of the table is the sample of the table.  A stratum is ranked in ``SPREAD`` parts first, each limited on the
    map side by Spark, so that no task sees more than that many times ``size`` of its rows.
    """
    if size < 0:
        raise ValueError("size must not be negative")
    if {"__ticket", "__part", "__place"} & set(df.columns):
        raise ValueError("columns are called __ticket, __part or __place")
    order = ["__ticket", *keys, *(name for name in df.columns if name not in keys)]
    drawn = df.withColumn("__ticket", _ticket(keys, seed))
    part = F.pmod(F.xxhash64(*df.columns), F.lit(SPREAD))
    place = F.row_number().over(Window.partitionBy(*strata, "__part").orderBy(*order))
    best = drawn.withColumn("__part", part).withColumn("__place", place).where(F.col("__place") <= size)
    place = F.row_number().over(Window.partitionBy(*strata).orderBy(*order))
    return best.withColumn("__place", place).where(F.col("__place") <= size).select(*df.columns)
