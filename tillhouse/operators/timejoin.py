"""Joins in time: the last row before an instant, and instants or intervals inside intervals."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillhouse.functions.keys import MIN_HOT_ROWS, hot_keys
from tillhouse.functions.materialize import stored

SPANS = 64  # into which the rows of a hot key are divided


def _spans(rows: DataFrame, key: str, time: str, min_rows: int) -> DataFrame:
    """The keys with too many rows for one task, with the times that divide their rows evenly.

    Each holds more than 1/100,000 of all rows, so there are at most that many, and they may be broadcast.
    """
    sizes = stored(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows")), "asof-sizes")
    hot = F.broadcast(hot_keys(sizes, key, "_rows", min_rows).where(F.col(key).isNotNull()).select(key))
    shares = [k / SPANS for k in range(1, SPANS)]
    cuts = F.array_distinct(F.percentile_approx(time, F.array(*map(F.lit, shares)), F.lit(1000))).alias("_cuts")
    return stored(rows.join(hot, key, "left_semi").groupBy(key).agg(cuts), "asof-spans")


def as_of_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    left_time: str,
    right_time: str,
    values: Sequence[str],
    tie_break: Sequence[str] = (),
    strict: bool = False,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Each row of ``left`` with ``values`` of the last row of ``right`` with equal ``by`` that is not later (``strict``: earlier).

    Among right rows of one instant the greatest in ``tie_break``, then in ``values``, is the last.  Rows without a key or
    without a time match nothing; left rows without a match keep nulls.  Left rows that repeat stay repeated.

    Both sides are merged by key and time in one sort, and the last right row is carried along: no pair is formed that is
    not in the result.  The rows of a key with too many for one task are divided into spans of time; of each span only its
    last right row is sent ahead to the spans after it.
    """
    key, time, side, order, payload, row = "_key", "_time", "_side", "_order", "_payload", "_row"

    def merged(df: DataFrame, at: str, side_value: int) -> DataFrame:
        found = reduce(and_, (F.col(name).isNotNull() for name in [*by, at]))
        keys = F.when(found, F.struct(*(df[name].alias(f"k{n}") for n, name in enumerate(by)))).alias(key)
        return df.select(keys, df[at].alias(time), F.lit(side_value).alias(side), "*")

    right_side = 1 if strict else 0  # at one instant the right side comes first unless it has to be earlier
    all_left = merged(left, left_time, 1 - right_side)
    null_values = F.struct(*(F.lit(None).cast(right.schema[name].dataType).alias(name) for name in values))
    no_order = F.lit(None).cast(right.select(_order(tie_break).alias(order)).schema[order].dataType)
    lefts = all_left.select(
        key, time, side, no_order.alias(order), null_values.alias(payload), F.struct(*map(F.col, left.columns)).alias(row)
    )
    rights = merged(right, right_time, right_side).where(F.col(key).isNotNull())
    empty_row = F.lit(None).cast(lefts.schema[row].dataType)
    carried = rights.select(
        key, time, side, _order(tie_break).alias(order), F.struct(*values).alias(payload), empty_row.alias(row)
    )
    both = lefts.where(F.col(key).isNotNull()).unionByName(carried)

    spans = _spans(both.select(key, time), key, time, min_hot_rows)
    placed = both.join(F.broadcast(spans), key, "left")
    span = F.coalesce(F.size(F.filter("_cuts", lambda cut: cut < F.col(time))), F.lit(0))
    placed = placed.withColumn("_span", span).drop("_cuts")

    # the last right row of each span of a hot key, sent to the first later span and carried on from there
    is_right = F.col(row).isNull()
    latest = F.max(F.when(is_right, F.struct(time, order, payload)))
    ends = placed.join(F.broadcast(spans.select(key)), key, "left_semi").groupBy(key, "_span").agg(latest.alias("_end"))
    before = Window.partitionBy(key).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    heads = ends.withColumn("_head", F.max("_end").over(before)).where("_head IS NOT NULL")
    heads = heads.select(
        key,
        F.col(f"_head.{time}").alias(time),
        F.lit(0).alias(side),
        F.col(f"_head.{order}").alias(order),
        F.col(f"_head.{payload}").alias(payload),
        empty_row.alias(row),
        "_span",
    )
    sequence = Window.partitionBy(key, "_span").orderBy(time, side, order, payload)
    last_right = F.last(F.when(is_right, F.col(payload)), ignorenulls=True).over(sequence.rowsBetween(Window.unboundedPreceding, 0))
    found = placed.unionByName(heads).withColumn("_found", last_right).where(F.col(row).isNotNull())
    found = found.select(row, F.col("_found").alias(payload))
    unmatched = lefts.where(F.col(key).isNull()).select(row, payload)
    return found.unionByName(unmatched).select(f"{row}.*", *(F.col(f"{payload}.{name}") for name in values))


def _order(columns: Sequence[str]) -> Column:
    return F.struct(F.lit(0).alias("first"), *(F.col(name).alias(f"o{n}") for n, name in enumerate(columns)))


def _place(df: DataFrame, name: str) -> Column:
    """A time or date or whole number as a long."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(df[name].cast("timestamp"))
    return F.unix_date(df[name]).cast("long") if kind == "date" else df[name].cast("long")


def join_points_to_intervals(
    points: DataFrame,
    intervals: DataFrame,
    point: str,
    start: str,
    end: str,
    by: Sequence[str] = (),
    open_start: bool = False,
    least_bin: int = 1,
) -> DataFrame:
    """All pairs of a point and an interval that holds it, ``start <= point < end`` (``open_start``: ``start < point``).

    Columns of both sides must not share names besides ``by``; rows with nulls in what is compared, and intervals without
    length, match nothing.

    Time is divided into bins of several levels, each with bins twice as wide.  An interval belongs to the level whose bins
    are just longer than itself, where it touches at most two neighbours; a point looks for its one bin at each level that
    occurs, of which there are 64 at most.  So long intervals cost as much as short ones, each pair is found once, by an
    equality that Spark shuffles, and a bin that holds many rows can be split by adaptive execution.
    """
    clashing = {name.lower() for name in points.columns} & {name.lower() for name in intervals.columns} - {b.lower() for b in by}
    if clashing:
        raise ValueError(f"both sides have columns {sorted(clashing)}")
    begin, stop = _place(intervals, start), _place(intervals, end)
    length = (stop - begin).alias("length")
    sized = intervals.select("*", begin.alias("_begin"), stop.alias("_stop"), length.alias("_length")).where("_length > 0")
    bins = F.greatest(F.col("_length"), F.lit(least_bin))
    levelled = sized.withColumn("_level", F.length(F.bin(bins)))  # bins of two to the power of the level are longer

    def bin_of(place: Column, level: Column) -> Column:
        return F.call_function("shiftright", place, level)

    touched = F.array_distinct(F.array(bin_of(F.col("_begin"), F.col("_level")), bin_of(F.col("_stop") - 1, F.col("_level"))))
    binned = levelled.withColumn("_bin", F.explode(touched))
    levels = [row["_level"] for row in levelled.select("_level").distinct().collect()]  # 64 at most
    probes = points.withColumn("_point", _place(points, point)).withColumn(
        "_level", F.explode(F.array(*map(F.lit, sorted(levels))).cast("array<int>"))
    )
    probes = probes.withColumn("_bin", bin_of(F.col("_point"), F.col("_level")))
    inside = (F.col("_point") > F.col("_begin")) if open_start else (F.col("_point") >= F.col("_begin"))
    found = probes.join(binned, [*by, "_level", "_bin"]).where(inside & (F.col("_point") < F.col("_stop")))
    return found.drop("_point", "_begin", "_stop", "_length", "_level", "_bin")


def join_overlapping(
    left: DataFrame,
    right: DataFrame,
    left_span: tuple[str, str],
    right_span: tuple[str, str],
    by: Sequence[str] = (),
) -> DataFrame:
    """All pairs of intervals that share an instant, each once.  Ends do not belong to an interval.

    Of two that overlap either the left one begins inside the right one, or the right one begins later, inside the left one.
    """
    lefts = left.where(F.col(left_span[0]) < F.col(left_span[1]))
    rights = right.where(F.col(right_span[0]) < F.col(right_span[1]))
    begun = join_points_to_intervals(lefts, rights, left_span[0], *right_span, by=by)
    later = join_points_to_intervals(rights, lefts, right_span[0], *left_span, by=by, open_start=True)
    return begun.unionByName(later.select(*begun.columns))
