"""Column contracts, casts and emptiness checks.  All but :func:`require_content` look at metadata only."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillhouse.functions.concurrency import run_together

log = logging.getLogger(__name__)

Tables = dict[str, DataFrame]


def has_columns(df: DataFrame, names: Sequence[str]) -> bool:
    return set(names) <= set(df.columns)


def project_contract(df: DataFrame, columns: Sequence[str], table: str = "table") -> DataFrame:
    """Keep the contract's columns in contract order; names are compared case-sensitively."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks the contract columns {missing}")
    return df.select(*columns)


def project_contracts(
    tables: Mapping[str, DataFrame], contracts: Mapping[str, Sequence[str]], skip_invalid: bool = False
) -> Tables:
    """Apply every table's contract.  A table without one is left out; a broken one raises unless ``skip_invalid``."""
    result: Tables = {}
    for name, df in tables.items():
        if name not in contracts:
            log.warning("%s has no column contract and is left out", name)
        elif skip_invalid and not has_columns(df, contracts[name]):
            log.warning("%s does not meet its column contract and is left out", name)
        else:
            result[name] = project_contract(df, contracts[name], name)
    return result


def cast_columns(df: DataFrame, types: Mapping[str, str], table: str = "table", lenient: bool = False) -> DataFrame:
    """Cast the configured columns in one projection.

    The strict form fails the job on a value that cannot be cast (ANSI mode); the lenient form yields null, to be dealt
    with by the null policy.
    """
    for name in types:
        if name not in df.columns:
            log.warning("%s has no column %s to cast", table, name)
    change = Column.try_cast if lenient else Column.cast
    return df.select(*[change(F.col(c), types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def cast_tables(
    tables: Mapping[str, DataFrame], types: Mapping[str, Mapping[str, str]], lenient: bool = False
) -> Tables:
    """Cast every configured table; others pass through.  Without any configuration there is no result."""
    if not types:
        log.error("no casts are configured")
        return {}
    return {name: cast_columns(df, types.get(name, {}), name, lenient) for name, df in tables.items()}


def schema_violations(
    tables: Mapping[str, DataFrame], expected: Mapping[str, Sequence[tuple[str, str]]]
) -> list[tuple[str, str, str, str | None]]:
    """Every ``(table, column, expected type, actual type)`` that does not hold; extra columns are fine.

    A missing table is reported once, with the column ``*``.
    """
    found = []
    for table, columns in expected.items():
        if table not in tables:
            found.append((table, "*", "table", None))
            continue
        actual = dict(tables[table].dtypes)
        found += [(table, name, dtype, actual.get(name)) for name, dtype in columns if actual.get(name) != dtype]
    return found


def violations_frame(spark: SparkSession, violations: Sequence[tuple]) -> DataFrame:
    schema = "table_name string, column_name string, expected_type string, actual_type string"
    return spark.createDataFrame(list(violations), schema)


def meets_schema(
    tables: Mapping[str, DataFrame], expected: Mapping[str, Sequence[tuple[str, str]]]
) -> bool:
    violations = schema_violations(tables, expected)
    for violation in violations:
        log.error("schema violation: table %s, column %s, expected %s, found %s", *violation)
    return not violations


def require_content(tables: Mapping[str, DataFrame], skip_invalid: bool = False) -> Tables:
    """Tables with at least one row.  An empty table raises, or is left out with ``skip_invalid``."""
    if not tables:
        return {}
    spark = next(iter(tables.values())).sparkSession
    empty = run_together(spark, {name: df.isEmpty for name, df in tables.items()})
    for name in tables:
        if empty[name] and not skip_invalid:
            raise ValueError(f"{name} is empty")
        if empty[name]:
            log.warning("%s is empty and is left out", name)
    return {name: df for name, df in tables.items() if not empty[name]}
