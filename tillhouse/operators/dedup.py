"""De-duplication by key.

Of the rows with one key the survivor is the most complete one, then the latest ingested, then the first in a fixed
order of the remaining columns, the batch at last.  Only rows that agree in all of that are interchangeable, so the outcome does not
depend on how the input was partitioned.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillhouse.functions.concurrency import run_together
from tillhouse.functions.keys import HOT_KEY_LIMIT, MAX_BROADCAST_KEYS, KeyFilter, KeySet
from tillhouse.functions.materialize import materialize
from tillhouse.operators.nulls import FLAG_COLUMN

log = logging.getLogger(__name__)

# The stamp columns.
BATCH_ID, INGESTION_TIME = "batch_id", "ingestion_time"

CROWDED_ROWS = 10_000  # copies of a key that are ranked in one task, unless that is less than 1/HOT_KEY_LIMIT of all copies
FILTER_BITS = 16  # of a filter, for each repeated key


@dataclass(frozen=True)
class RepeatedKeys(KeySet):
    """Keys that occur more than once, and those among them, ``HOT_KEY_LIMIT`` at most, with too many rows for one task."""

    crowded: DataFrame | None = None


@dataclass(frozen=True)
class _Copies:
    """How to tell the rows that may have a repeated key from the others."""

    repeated: KeySet
    few: bool
    filter: KeyFilter | None = None

    @classmethod
    def of(cls, repeated: KeySet, max_broadcast: int) -> _Copies:
        few = repeated.fits(max_broadcast)
        return cls(repeated, few, None if few else repeated.filter(FILTER_BITS, max_broadcast))

    def filters(self, df: DataFrame, keys: Sequence[str]) -> bool:
        return self.filter is not None and self.filter.suits(df, keys)

    def passed(self, df: DataFrame, keys: Sequence[str], wanted: bool) -> DataFrame:
        marked = self.filter.mark(df, keys, "_copy")
        return marked.where(F.col("_copy") if wanted else ~F.col("_copy")).drop("_copy")


def completeness(df: DataFrame) -> Column:
    """Number of non-null columns.  ``missing_values`` describes missing cells, so it is not counted as a present one."""
    return reduce(add, [F.col(c).isNotNull().cast("int") for c in df.columns if c != FLAG_COLUMN])


def survivor_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    fixed = {*keys, BATCH_ID, INGESTION_TIME, FLAG_COLUMN}
    latest = [F.desc_nulls_last(INGESTION_TIME)] if INGESTION_TIME in df.columns else []
    others = sorted(set(df.columns) - fixed)
    batch = [BATCH_ID] if BATCH_ID in set(df.columns) - set(keys) else []
    return [F.desc("_score"), *latest, *[F.asc_nulls_last(c) for c in [*others, *batch]]]


def repeated_keys(df: DataFrame, keys: Sequence[str], crowded_rows: int = CROWDED_ROWS) -> RepeatedKeys:
    """The keys that occur more than once.  Only the key columns are read and shuffled."""
    rows = F.col("_rows")
    counted = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where(rows > 1))
    most, total = counted.agg(F.max(rows), F.sum(rows)).first()
    limit = max(crowded_rows, (total or 0) // HOT_KEY_LIMIT)
    crowded = counted.where(rows > limit).select(*keys) if (most or 0) > limit else None
    return RepeatedKeys.measured(counted.select(*keys), crowded=crowded)


def _rows_with(df: DataFrame, keys: Sequence[str], found: DataFrame, kind: str, few: bool = True) -> DataFrame:
    """The rows with (``left_semi``) or without (``left_anti``) one of the keys; a null is a key like any other.

    ``few`` keys are broadcast, otherwise rows and keys are shuffled.
    """
    others = found.select(*[F.col(key).alias(f"_{key}") for key in keys])
    same = reduce(and_, [F.col(key).eqNullSafe(F.col(f"_{key}")) for key in keys])
    return df.join(F.broadcast(others) if few else others, same, kind)


def keep_survivors(
    df: DataFrame,
    keys: Sequence[str],
    repeated: KeySet | None = None,
    max_broadcast: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """One row per key.

    Without knowing the ``repeated`` keys all rows are shuffled by key.  With them, rows with a key of their own, usually
    nearly all, pass without a shuffle; only the others are ranked.  That reads the table twice, and pays off for a large
    table with few copies.  Keys that are too many to broadcast are known by a filter; the few rows that pass it though
    their key is not repeated are ranked in vain.
    """
    return _kept(df, keys, None if repeated is None else _Copies.of(repeated, max_broadcast))


def _kept(df: DataFrame, keys: Sequence[str], copies: _Copies | None) -> DataFrame:
    if copies is None:
        return _first_per_key(df, keys)
    if copies.repeated.count == 0:
        return df
    if copies.few:
        single, others = (_rows_with(df, keys, copies.repeated.keys, kind) for kind in ("left_anti", "left_semi"))
    elif copies.filters(df, keys):
        single, others = (copies.passed(df, keys, wanted) for wanted in (False, True))
    else:
        return _first_per_key(df, keys)
    return single.unionByName(_first_per_key(others, keys))


def _first_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spark turns ``row_number() = 1`` into a limit per key that runs before the shuffle as well, so of a key with any
    number of copies each map task sends one row."""
    ranked = Window.partitionBy(*keys).orderBy(*survivor_order(df, keys))
    return (
        df.withColumn("_score", completeness(df))
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") == 1)
        .select(*df.columns)
    )


def mark_survivors(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """All rows, with ``flag`` telling the one survivor of each key.

    A plain ranking would bring all copies of a key into one task.  Here the rows of a key first compete within the
    input partition they come from, which also divides rows that are equal in every column; only the winners, one per
    key and input partition, meet in a second round, while the losers stay spread out.
    """
    order = survivor_order(df, keys)
    heats = Window.partitionBy(*keys, "_slice").orderBy(*order)
    final = Window.partitionBy(*keys, F.when(F.col("_heat") > 1, F.col("_slice"))).orderBy(F.col("_heat"), *order)
    return (
        df.withColumn("_score", completeness(df))
        .withColumn("_slice", F.spark_partition_id())
        .withColumn("_heat", F.row_number().over(heats))
        .withColumn("_final", F.row_number().over(final))
        .select(*df.columns, ((F.col("_heat") == 1) & (F.col("_final") == 1)).alias(flag))
    )


def reject_copies(
    df: DataFrame,
    keys: Sequence[str],
    repeated: KeySet | None = None,
    max_broadcast: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """The rows that :func:`keep_survivors` leaves out."""
    repeated = repeated_keys(df, keys) if repeated is None else repeated
    return _rejected(df, keys, _Copies.of(repeated, max_broadcast))


def _rejected(df: DataFrame, keys: Sequence[str], copies: _Copies) -> DataFrame:
    """Copies of a key meet in one task, unless the key is crowded."""
    repeated = copies.repeated
    if repeated.count == 0:
        return df.where(F.lit(False))
    if copies.filters(df, keys):
        others = copies.passed(df, keys, True)
    else:
        others = _rows_with(df, keys, repeated.keys, "left_semi", copies.few)
    if not isinstance(repeated, RepeatedKeys):
        return _losers(mark_survivors(others, keys, "_kept"))
    if repeated.crowded is None:
        return _losers(_mark_at_once(others, keys, "_kept"))
    sparse, crowded = (_rows_with(others, keys, repeated.crowded, kind) for kind in ("left_anti", "left_semi"))
    return _losers(_mark_at_once(sparse, keys, "_kept").unionByName(mark_survivors(crowded, keys, "_kept")))


def _losers(marked: DataFrame) -> DataFrame:
    return marked.where(~F.col("_kept")).drop("_kept")


def _mark_at_once(df: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    ranked = Window.partitionBy(*keys).orderBy(*survivor_order(df, keys))
    scored = df.withColumn("_score", completeness(df))
    return scored.withColumn("_rank", F.row_number().over(ranked)).select(*df.columns, (F.col("_rank") == 1).alias(flag))


def deduplicate(
    tables: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    counted: Mapping[str, DataFrame] | None = None,
    max_broadcast: int = MAX_BROADCAST_KEYS,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """``(kept, rejected)`` table sets.  A table without keys, or lacking a key column, passes through unchanged.

    ``counted`` are tables that have at least these keys and are cheaper to read, such as those before their null policy;
    a key that is repeated only there does no harm.
    """
    if not keys:
        log.error("no de-duplication keys are configured")
        return {}, {}
    usable = {name: df for name, df in tables.items() if name in keys and set(keys[name]) <= set(df.columns)}
    for name in tables:
        if name not in usable:
            log.warning("%s has no usable de-duplication key and is passed through", name)
    if not usable:
        return dict(tables), {}
    spark = next(iter(usable.values())).sparkSession
    repeated = run_together(
        spark, {name: partial(repeated_keys, (counted or tables)[name], keys[name]) for name in usable}
    )
    copies = run_together(spark, {name: partial(_Copies.of, repeated[name], max_broadcast) for name in usable})
    kept = {name: _kept(df, keys[name], copies[name]) for name, df in usable.items()}
    rejected = {name: _rejected(df, keys[name], copies[name]) for name, df in usable.items()}
    return {name: kept.get(name, df) for name, df in tables.items()}, rejected
