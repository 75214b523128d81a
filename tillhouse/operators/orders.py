"""Order values and order sizes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tillhouse.functions.money import percent

# The upper bounds, exclusive, of the order value buckets, and the bucket above the last of them.
BUCKETS = (
    (50, "very_low"),
    (150, "low"),
    (300, "medium_low"),
    (600, "medium"),
    (1000, "medium_high"),
    (2000, "high"),
)
TOP_BUCKET = "very_high"


def order_buckets(
    orders: DataFrame,
    buckets: Sequence[tuple[float, str]] = BUCKETS,
    above: str = TOP_BUCKET,
    null_label: str | None = None,
) -> DataFrame:
    """Each order with its value bucket.  An order without an amount gets ``null_label``, by default the top bucket."""
    amount = F.col("total_amount")
    bucket = F.when(amount.isNull(), F.lit(above if null_label is None else null_label))
    for bound, label in buckets:
        bucket = bucket.when(amount < bound, F.lit(label))
    return orders.select("order_id", "total_amount", bucket.otherwise(F.lit(above)).alias("bucket"))


def multi_product_orders(order_items: DataFrame) -> DataFrame:
    """One row: the number of orders with more than one distinct product.

    Two extremes that differ mean two products; unlike a distinct count they combine to one row per order on the map
    side.
    """
    per_order = order_items.groupBy("order_id").agg(F.min("product_id").alias("a"), F.max("product_id").alias("b"))
    return per_order.agg(F.count_if(F.col("a") != F.col("b")).alias("multi_product_orders"))


def multi_product_share(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """One row: multi-product orders as a percentage of all orders; 0 without orders."""
    many = multi_product_orders(order_items).scalar()
    count = F.count(F.lit(1))
    return orders.agg(F.when(count == 0, F.lit(0.0)).otherwise(percent(many, count)).alias("big_orders_share"))
