"""Tables as multisets of rows: differences, intersections and change feeds of snapshots, with one shuffle of rows.

Both sides are stacked and counted by their whole rows.  Equal rows are combined on the map side, so that a row with any
number of copies is one row for each input partition in the shuffle; results carry numbers of copies until the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BEFORE, AFTER = "__before", "__after"
CHUNK = 10_000  # copies of one row that one task writes out


def _aligned(left: DataFrame, right: DataFrame) -> DataFrame:
    if sorted(left.dtypes) != sorted(right.dtypes):
        raise ValueError(f"not the same columns and types: {sorted(left.dtypes)}, {sorted(right.dtypes)}")
    if len(set(left.columns)) < len(left.columns):
        raise ValueError("columns must have different names")
    return right.select(*left.columns)


def count_copies(left: DataFrame, right: DataFrame, before: str = "before", after: str = "after") -> DataFrame:
    """Each distinct row of either table with its numbers of copies in both; nulls are equal to each other.

    Columns may come in another order in ``right``, but have the same names and types.  NaN equals NaN, and 0.0 equals -0.0.
    """
    right = _aligned(left, right)
    if {before, after} & set(left.columns):
        raise ValueError(f"columns are called {before} or {after}")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    both = left.withColumns({before: one, after: none}).unionByName(right.withColumns({before: none, after: one}))
    return both.groupBy(*left.columns).agg(F.sum(before).alias(before), F.sum(after).alias(after))


def repeat_rows(df: DataFrame, copies: str) -> DataFrame:
    """Each row as often as its column ``copies`` says (null, zero and less: not at all), without that column.

    Rows with more than ``CHUNK`` copies are divided, and their parts dealt out to tasks, before they are written out.
    """
    rest = [name for name in df.columns if name != copies]
    number = F.col(copies)
    few = df.where((number > 0) & (number <= CHUNK))
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((number - 1) / CHUNK))).alias("__part")
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by number, so that few small rows stay apart
    many = df.where(number > CHUNK).select("*", parts).repartition(tasks, *rest, "__part")
    many = many.withColumn(copies, F.least(F.lit(CHUNK).cast("long"), number - F.col("__part") * CHUNK)).drop("__part")

    def written(rows: DataFrame) -> DataFrame:
        return rows.withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), number))).select(*rest)

    return written(few).unionByName(written(many))


def _repeated(left: DataFrame, right: DataFrame, copies: Column) -> DataFrame:
    counted = count_copies(left, right, BEFORE, AFTER)
    return repeat_rows(counted.select(*left.columns, copies.alias("__copies")), "__copies")


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left``, each as many times less as ``right`` has it."""
    return _repeated(left, right, F.col(BEFORE) - F.col(AFTER))


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of both tables, each as often as the table has it that has it less often."""
    return _repeated(left, right, F.least(BEFORE, AFTER))


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of which the tables have different numbers, with ``change`` (removed or added) and ``copies``."""
    counted = count_copies(left, right, BEFORE, AFTER)
    more = F.col(AFTER) - F.col(BEFORE)
    change = F.when(more > 0, "added").otherwise("removed").alias("change")
    return counted.where(more != 0).select(*left.columns, change, F.abs(more).alias("copies"))


def change_feed(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What became of each key between two snapshots: the keys, ``change``, and the other columns before and after.

    ``change`` is ``insert``, ``delete`` or ``update``; keys whose row stays as it was are left out.  The other columns
    come as ``old_`` and ``new_`` ones.  Null is a key like others.  A key that a snapshot has twice ends the job, since
    there is no telling which row became which; ``differences`` takes such tables.
    """
    right = _aligned(left, right)
    values = [name for name in left.columns if name not in keys]
    taken = {"change", "copies_before", "copies_after", *(f"{side}_{name}" for side in ("old", "new") for name in values)}
    if clash := taken & set(keys):
        raise ValueError(f"names of keys clash: {sorted(clash)}")
    whole = F.struct(F.lit(True).alias("there"), *values)
    none = F.lit(None)
    sides = left.select(*keys, whole.alias(BEFORE), none.alias(AFTER)).union(right.select(*keys, none, whole))
    found = sides.groupBy(*keys).agg(
        F.any_value(BEFORE, True).alias(BEFORE),
        F.any_value(AFTER, True).alias(AFTER),
        F.greatest(F.count(BEFORE), F.count(AFTER)).alias("__most"),
    )
    change = (
        F.when(F.col("__most") > 1, F.raise_error(F.lit("a snapshot has a key twice")))
        .when(F.col(BEFORE).isNull(), "insert")
        .when(F.col(AFTER).isNull(), "delete")
        .when(~F.col(BEFORE).eqNullSafe(F.col(AFTER)), "update")
    )
    old = [F.col(f"{BEFORE}.{name}").alias(f"old_{name}") for name in values]
    new = [F.col(f"{AFTER}.{name}").alias(f"new_{name}") for name in values]
    return found.select(*keys, change.alias("change"), *old, *new).where("change is not null")
