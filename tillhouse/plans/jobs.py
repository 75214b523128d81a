"""The layer jobs: raw CSV to bronze, bronze to silver, silver to gold.

Each layer is written as Parquet before the next one reads it, which also ends the lineage there.  A job raises when it
has nothing to work with, so a failed layer stops the pipeline.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillhouse.functions.concurrency import run_together
from tillhouse.functions.materialize import materialize
from tillhouse.functions.money import SCALE
from tillhouse.operators.contracts import cast_tables, project_contracts, require_content, schema_violations
from tillhouse.operators.dedup import deduplicate
from tillhouse.operators.kpis import run_kpis
from tillhouse.operators.loyalty import customer_loyalty
from tillhouse.operators.nulls import handle_nulls
from tillhouse.operators.orders import order_buckets
from tillhouse.operators.products import product_sales, top_products_per_city
from tillhouse.operators.provenance import stamp_batch
from tillhouse.operators.rules import OVERALL_FLAG, REFERENCE_PREFIX, flag_tables
from tillhouse.operators.sales import daily_sales
from tillhouse.operators.users import city_sales, customer_metrics, revenue_per_user, user_totals
from tillhouse.plans import policies
from tillhouse.sources.tables import append_metrics, scan_csv_tables, scan_parquet_tables, write_table, write_tables


def bronze(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Mapping[str, Sequence[str]] = policies.COLUMNS,
    skip_invalid: bool = False,
    batch_id: str | None = None,
    as_of: datetime.datetime | None = None,
) -> dict[str, str]:
    """Raw CSV files to stamped string tables; returns the paths written."""
    raw = scan_csv_tables(spark, source, [f"{name}.csv" for name in columns], skip_invalid)
    tables = require_content(project_contracts(raw, columns, skip_invalid), skip_invalid)
    if not tables:
        raise ValueError(f"no usable tables in {source}")
    return write_tables(stamp_batch(tables, batch_id, as_of), target)


def _lookups(
    complete: Mapping[str, DataFrame],
    kept: Mapping[str, DataFrame],
    keys: Mapping[str, Sequence[str]],
    rules: Mapping[str, Mapping[str, str]],
) -> dict[str, DataFrame]:
    """The tables that references are looked up in.

    De-duplication keeps every value of a key column.  So where only key columns are looked up, the table before
    de-duplication serves as well, and each lookup scans one column instead of ranking whole rows once more.
    """

    def looked_up(parent: str) -> set[str]:
        return {
            column
            for table in rules.values()
            for column, text in table.items()
            if text == f"{REFERENCE_PREFIX}{parent}"
        }

    return {
        name: complete[name] if looked_up(name) <= set(keys.get(name, ())) else df for name, df in kept.items()
    }


def clean_tables(
    tables: Mapping[str, DataFrame],
    casts: Mapping[str, Mapping[str, str]] = policies.CASTS,
    null_policies: Mapping[str, Mapping[str, str]] = policies.NULL_POLICIES,
    keys: Mapping[str, Sequence[str]] = policies.KEYS,
    rules: Mapping[str, Mapping[str, str]] = policies.RULES,
    enums: Mapping[str, Sequence[str]] = policies.ENUMS,
    lenient: bool = False,
    as_of: datetime.datetime | None = None,
    ignore_case: bool = False,
) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """``(clean, rejected)``: cast, null-handled, de-duplicated and flagged tables, and the copies left out.

    Repeated keys and referring values are looked for before the null policies, where each takes a scan of one column; the
    policies look at all columns of a table.
    """
    typed = cast_tables(tables, casts, lenient)
    complete = handle_nulls(typed, null_policies)
    kept, rejected = deduplicate(complete, keys, typed)
    lookups = _lookups(complete, kept, keys, rules)
    return flag_tables(kept, rules, enums, lookups, typed, as_of, ignore_case), rejected


def silver(
    spark: SparkSession,
    source: str,
    target: str,
    names: Sequence[str] = policies.TABLES,
    rejected_target: str | None = None,
    **options,
) -> dict[str, str]:
    """Bronze tables to clean tables; returns the paths written.

    With ``rejected_target`` the copies that de-duplication left out are written there.  The other options are those of
    :func:`clean_tables`.
    """
    tables = scan_parquet_tables(spark, source, names)
    if not tables:
        raise ValueError(f"{source} lacks some of the tables {list(names)}")
    clean, rejected = clean_tables(tables, **options)
    if not clean:
        raise ValueError("nothing to write: a policy is empty")
    if rejected_target is not None:
        write_tables(rejected, rejected_target)
    return write_tables(clean, target)


def gold_tables(
    orders: DataFrame,
    order_items: DataFrame,
    users: DataFrame,
    totals: DataFrame,
    rank_type: str = "int",
    scale: int = SCALE,
) -> dict[str, Callable[[], DataFrame]]:
    """The analytical tables by name, built on call.  ``totals`` are the per-user totals that several of them share."""
    return {
        "customers_loyalty": lambda: customer_loyalty(orders, totals, rank_type),
        "products": lambda: product_sales(order_items, scale, rank_type),
        "top_products_per_city": lambda: top_products_per_city(order_items, users, rank_type=rank_type),
        "sales_and_revenues": lambda: daily_sales(orders, scale, rank_type),
        "geography": lambda: city_sales(revenue_per_user(totals), users, rank_type),
        "customer_metrics": lambda: customer_metrics(totals),
        "orders": lambda: order_buckets(orders),
    }


REPORTS = ("top_products_per_city",)


def gold(
    spark: SparkSession,
    source: str,
    target: str,
    reports: str,
    names: Sequence[str] = policies.TABLES,
    schema: Mapping[str, Sequence[tuple[str, str]]] = policies.CLEAN_SCHEMA,
    only_valid: bool = False,
    batch_id: str | None = None,
    as_of: datetime.datetime | None = None,
    rank_type: str = "int",
    scale: int = SCALE,
) -> dict[str, str]:
    """Clean tables to analytical tables and a record in the metrics history; returns the paths written.

    Rows count whatever their quality flags say, unless ``only_valid`` leaves the flagged ones out.  ``scale`` is the
    number of decimals of an amount that count.
    """
    tables = scan_parquet_tables(spark, source, names)
    if not tables:
        raise ValueError(f"{source} lacks some of the tables {list(names)}")
    violations = schema_violations(tables, schema)
    if violations:
        raise ValueError(f"the clean tables do not have the expected schema: {violations}")
    if only_valid:
        tables = {name: df.where(F.col(OVERALL_FLAG)) for name, df in tables.items()}

    orders, order_items, users = tables["orders"], tables["order_items"], tables["users"]
    totals = materialize(user_totals(orders, scale))
    history = f"{reports.rstrip('/')}/report"

    def write(name: str, build: Callable[[], DataFrame]) -> str:
        return write_table(build(), reports if name in REPORTS else target, name)

    def record() -> str:
        append_metrics(run_kpis(orders, order_items, totals, batch_id, as_of), history)
        return history

    builds = gold_tables(orders, order_items, users, totals, rank_type, scale)
    actions = {name: partial(write, name, build) for name, build in builds.items()}
    return run_together(spark, {**actions, "report": record})


def pipeline(
    spark: SparkSession,
    source: str,
    target: str,
    columns: Mapping[str, Sequence[str]] = policies.COLUMNS,
    batch_id: str | None = None,
    as_of: datetime.datetime | None = None,
    only_valid: bool = False,
    rank_type: str = "int",
    scale: int = SCALE,
    **options,
) -> dict[str, str]:
    """All layers below ``target``, under one batch id; returns the paths of the last one."""
    batch_id = batch_id or str(uuid.uuid4())
    root = target.rstrip("/")
    bronze(spark, source, f"{root}/bronze", columns, batch_id=batch_id, as_of=as_of)
    silver(spark, f"{root}/bronze", f"{root}/silver", list(columns), as_of=as_of, **options)
    return gold(
        spark,
        f"{root}/silver",
        f"{root}/gold",
        f"{root}/reports",
        list(columns),
        only_valid=only_valid,
        batch_id=batch_id,
        as_of=as_of,
        rank_type=rank_type,
        scale=scale,
    )
