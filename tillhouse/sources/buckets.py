"""Tables stored in buckets of their keys, for joins that need no exchange.

Rows are shuffled and sorted once, when they are written; every later join of tables of one layout reads bucket by bucket.
As such a join has no exchange, adaptive execution cannot split a hot key in it, so the layout does: a key with more than a
bucket's share of the rows is divided into parts, which are dealt to buckets like keys of their own, and the other table
holds its rows of that key once for each part.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillhouse.functions.materialize import stored

PART = "bucket_part"
PARTS = "bucket_parts"


@dataclass(frozen=True)
class BucketedTable:
    """``rows`` have the column ``bucket_part`` besides their own; ``hot`` has the divided keys with their parts."""

    rows: DataFrame
    hot: DataFrame
    keys: tuple[str, ...]
    buckets: int
    layout: str  # the same for tables that can be joined
    copies: bool  # whether rows of hot keys are there once for each part


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    pairs = [left[key].eqNullSafe(right[key]) if null_safe else left[key] == right[key] for key in keys]
    return reduce(Column.__and__, pairs)


def hot_keys(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """Keys with more rows than a bucket would have on the average, fewer than ``buckets``, and the parts they need.

    Null keys count like others, as their rows have to be stored, too.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(PARTS))
    share = max(1, -(-df.count() // buckets))
    return counted.where(F.col(PARTS) > share).withColumn(PARTS, F.ceil(F.col(PARTS) / share).cast("int"))


def _divided(df: DataFrame, hot: DataFrame, keys: Sequence[str], copies: bool) -> DataFrame:
    found = df.join(F.broadcast(hot), _same(df, hot, keys, null_safe=True), "left")
    parts = F.coalesce(hot[PARTS], F.lit(1))
    if copies:
        part = F.explode(F.sequence(F.lit(0), parts - 1))
    else:
        part = F.pmod(F.monotonically_increasing_id(), parts.cast("long")).cast("int")
    return found.select(*[df[name] for name in df.columns], part.alias(PART))


def write_bucketed(
    df: DataFrame, path: str, keys: Sequence[str] = (), buckets: int = 200, like: BucketedTable | None = None
) -> BucketedTable:
    """Store ``df`` in a new folder, by keys of its own, or in the layout of another table, to be joined to that.

    With ``like``, the keys have the names and types of that table's.  Repeated rows and rows with null keys are all kept,
    and an empty table is stored with its columns.  Rows of a hot key are dealt out by their place in a stored copy, so that
    a repeated task deals them alike.
    """
    spark = df.sparkSession
    keys, buckets = (like.keys, like.buckets) if like else (tuple(keys), buckets)
    if not keys or {PART, PARTS} & set(df.columns):
        raise ValueError(f"there must be keys, and no columns {PART} and {PARTS}")
    if like and [df.schema[key].dataType for key in keys] != [like.rows.schema[key].dataType for key in keys]:
        raise ValueError("the keys must be of the same types as in the other table")
    hot = like.hot if like else hot_keys(df, keys, buckets)
    hot.coalesce(1).write.parquet(f"{path}/hot")
    hot = spark.read.schema(hot.schema).parquet(f"{path}/hot")
    divided = df.withColumn(PART, F.lit(0)) if hot.isEmpty() else _divided(stored(df, "bucketed") if not like else df, hot, keys, bool(like))
    placed = [*keys, PART]
    name = _table_name()
    writer = divided.repartition(buckets, *placed).write.bucketBy(buckets, *placed).sortBy(*placed)
    writer.option("path", f"{path}/rows").option("compression", "zstd").format("parquet").saveAsTable(name)
    layout = like.layout if like else uuid.uuid4().hex
    about = spark.range(1).select(
        F.array(*map(F.lit, keys)).alias("keys"),
        F.lit(buckets).alias("buckets"),
        F.lit(layout).alias("layout"),
        F.lit(bool(like)).alias("copies"),
    )
    about.write.parquet(f"{path}/layout")
    return BucketedTable(spark.table(name), hot, keys, buckets, layout, bool(like))


def open_bucketed(spark: SparkSession, path: str) -> BucketedTable:
    """A table that ``write_bucketed`` has stored, in a session that does not know it yet."""
    about = spark.read.parquet(f"{path}/layout").first()
    fields = spark.read.parquet(f"{path}/rows").schema.fields
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in fields)
    placed = ", ".join(f"`{key}`" for key in [*about.keys, PART])
    name = _table_name()
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({placed}) SORTED BY ({placed}) "
        f"INTO {about.buckets} BUCKETS LOCATION '{path}/rows'"
    )
    hot = spark.read.parquet(f"{path}/hot")
    return BucketedTable(spark.table(name), hot, tuple(about.keys), about.buckets, about.layout, about.copies)


def _table_name() -> str:
    return f"bucketed_{uuid.uuid4().hex}"


def join_bucketed(left: BucketedTable, right: BucketedTable, how: str = "inner") -> DataFrame:
    """Rows with equal keys, keys once and first, without an exchange.

    ``right`` is stored like ``left``, and ``how`` is inner, left, left_semi or left_anti: a right row may be there several
    times, so rows of the right without a partner cannot be returned.  Null keys equal nothing.
    """
    if left.copies or not right.copies or left.layout != right.layout:
        raise ValueError("the right table must be stored like the left one")
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"not a join of bucketed tables: {how}")
    return left.rows.join(right.rows.hint("merge"), [*left.keys, PART], how).drop(PART)


def totals_bucketed(table: BucketedTable, measures: dict[str, Column]) -> DataFrame:
    """Aggregates by the keys and ``bucket_part``, without an exchange: one row per key, but for hot keys."""
    if table.copies:
        raise ValueError("rows of hot keys are there several times")
    return table.rows.groupBy(*table.keys, PART).agg(*[how.alias(name) for name, how in measures.items()])
