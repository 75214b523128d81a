"""Null profiles and null policies.

Every policy looks at one row only, so a table's whole policy is one filter and one projection: no profile has to run
first, no shuffle is needed, and the output schema does not depend on which columns happen to hold nulls today.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from tillhouse.operators.contracts import has_columns

log = logging.getLogger(__name__)

# The policy names, the fill value and the flag column that configurations and results use.
DROP, FILL_UNKNOWN, FILL_EMPTY, FLAGGING = "drop", "fill_unknown", "fill_empty", "flagging"
UNKNOWN = "unknown"
FLAG_COLUMN = "missing_values"
FLAG_SEPARATOR = ", "


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of nulls of every column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def null_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column, ``(table_name, column_name, null_count, row_count)``: one aggregate per table."""

    def profile(name: str, df: DataFrame) -> DataFrame:
        present = [F.count(F.col(c)).alias(c) for c in df.columns]
        return (
            df.agg(F.count(F.lit(1)).alias("_rows"), *present)
            .unpivot("_rows", df.columns, "column_name", "_present")
            .select(
                F.lit(name).alias("table_name"),
                "column_name",
                (F.col("_rows") - F.col("_present")).alias("null_count"),
                F.col("_rows").alias("row_count"),
            )
        )

    return reduce(DataFrame.unionByName, [profile(name, df) for name, df in tables.items()])


def columns_with_nulls(tables: Mapping[str, DataFrame]) -> dict[str, list[str]]:
    """Tables that hold nulls and, in column order, the columns that do.  Brings one row per column to the driver."""
    counts = {
        (row.table_name, row.column_name): row.null_count for row in null_profile(tables).collect()
    } if tables else {}
    found = {name: [c for c in df.columns if counts[name, c]] for name, df in tables.items()}
    return {name: columns for name, columns in found.items() if columns}


def drop_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Keep the rows without a null in ``columns``; written as plain predicates, which Parquet scans take over."""
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in columns])) if columns else df


def _fill(df: DataFrame, fills: Mapping[str, Column]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), value) for c, value in fills.items()}) if fills else df


def _is_string(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, StringType)


def fill_unknown(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by ``'unknown'``; only a string column can hold that value, so any other one is refused."""
    wrong = [c for c in columns if not _is_string(df, c)]
    if wrong:
        raise ValueError(f"{wrong} cannot be filled with {UNKNOWN!r}: not string columns")
    return _fill(df, {c: F.lit(UNKNOWN) for c in columns})


def fill_empty(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Replace nulls by the empty string; columns of other types stay as they are."""
    return _fill(df, {c: F.lit("") for c in columns if _is_string(df, c)})


def flag_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """List the names of the null ``columns`` in ``missing_values`` (null if there are none); keep the nulls."""
    names = [F.when(F.col(c).isNull(), F.lit(c)) for c in columns]
    if FLAG_COLUMN in df.columns:
        names.insert(0, F.col(FLAG_COLUMN))
    return df.withColumn(FLAG_COLUMN, F.nullif(F.concat_ws(FLAG_SEPARATOR, *names), F.lit("")))


def apply_null_policy(df: DataFrame, policy: Mapping[str, str], table: str = "table") -> DataFrame:
    """Apply a ``column -> policy`` mapping; names in ``missing_values`` follow the order of the table's columns."""
    unknown = sorted(set(policy.values()) - {DROP, FILL_UNKNOWN, FILL_EMPTY, FLAGGING})
    if unknown:
        raise ValueError(f"unknown null policies for {table}: {unknown}")
    absent = [c for c in policy if c not in df.columns]
    if absent:
        log.warning("%s lacks the columns %s named in its null policy", table, absent)
    unruled = [c for c in df.columns if c not in policy]
    if unruled:
        log.info("%s has no null policy for %s; their nulls stay", table, unruled)

    def ruled(name: str) -> list[str]:
        return [c for c in df.columns if policy.get(c) == name]

    result = drop_nulls(df, ruled(DROP))
    result = fill_empty(fill_unknown(result, ruled(FILL_UNKNOWN)), ruled(FILL_EMPTY))
    return flag_nulls(result, ruled(FLAGGING)) if ruled(FLAGGING) else result


def handle_nulls(
    tables: Mapping[str, DataFrame],
    policies: Mapping[str, Mapping[str, str]],
    found: Mapping[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """Apply each table's policy and return a new table set.

    With ``found`` (see :func:`columns_with_nulls`) only those tables and columns are treated, and a column that holds
    nulls but has no rule is reported.  Without any policies there is no result; a table without one is a KeyError.
    """
    if not policies:
        log.error("no null policies are configured")
        return {}
    result = dict(tables)
    for name in tables if found is None else found:
        policy = policies[name]
        if found is not None:
            if not has_columns(tables[name], found[name]):
                log.warning("%s lacks some of the columns %s and is left unchanged", name, list(found[name]))
                continue
            for column in found[name]:
                if column not in policy:
                    log.warning("%s.%s holds nulls but has no null policy", name, column)
            policy = {c: policy[c] for c in found[name] if c in policy}
        result[name] = apply_null_policy(tables[name], policy, name)
    return result
