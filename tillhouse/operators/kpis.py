"""The record of one run."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, functions as F

from tillhouse.functions.materialize import materialize
from tillhouse.functions.money import SCALE, percent
from tillhouse.operators.orders import multi_product_orders
from tillhouse.operators.users import active_users_expr, avg_orders_expr, revenue_per_user, top_users_share, user_totals


def run_kpis(
    orders: DataFrame,
    order_items: DataFrame,
    totals: DataFrame | None = None,
    batch_id: str | None = None,
    as_of: datetime.datetime | None = None,
    scale: int = SCALE,
) -> DataFrame:
    """One row with all scalar metrics, nothing of which passes through the driver.

    Everything about orders comes from the per-user totals, so the orders themselves are read once.
    """
    totals = materialize(user_totals(orders, scale)) if totals is None else totals
    share = top_users_share(revenue_per_user(totals)).scalar()
    many = multi_product_orders(order_items).scalar()
    order_rows = F.coalesce(F.sum("order_rows"), F.lit(0))
    return totals.agg(
        (F.lit(as_of).cast("timestamp") if as_of else F.current_timestamp()).alias("timestamp"),
        F.lit(batch_id).cast("string").alias("batch_id"),
        share.alias("share_top_users_in_total_revenue"),
        active_users_expr().alias("active_users_count"),
        avg_orders_expr().alias("avg_orders_count_per_user"),
        F.when(order_rows == 0, F.lit(0.0)).otherwise(percent(many, order_rows)).alias("big_orders_share"),
    )
