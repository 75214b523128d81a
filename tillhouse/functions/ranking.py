"""Row numbers over a whole table without sending it to one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillhouse.functions.materialize import materialize

_ROW_BITS = 33  # monotonically_increasing_id(): partition number above, row number within the partition below


def global_row_numbers(df: DataFrame, orders: Mapping[str, list[Column]]) -> DataFrame:
    """Add one bigint column per entry of ``orders``: the position of each row, from 1, in that order.

    An order should end with a unique key: it makes the result repeatable, and it lets Spark's range partitioner split
    a value that many rows share.  A table of any size takes the same way, one distributed sort per order.
    """
    table = materialize(df)  # the sort reads it twice, first to choose its ranges
    for name, order in orders.items():
        table = _number_by_sorting(table, order, name)
    return table


def _number_by_sorting(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Range-sort the table and add the number of rows in earlier partitions to each row's place in its own.

    The sorted table is materialized, so that rows and offsets come from the same partitions.  There is one offset per
    sort partition, at most ``spark.sql.shuffle.partitions`` whatever the size of the table, which is why the offsets
    may be windowed in one task and broadcast.
    """
    placed = materialize(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    partition = F.shiftright("_place", _ROW_BITS)
    earlier = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(partition.alias("_partition"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_partition", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_earlier"))
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_partition", partition)
        .join(F.broadcast(offsets), "_partition")
        .select(*df.columns, (F.col("_earlier") + position + 1).alias(name))
    )
