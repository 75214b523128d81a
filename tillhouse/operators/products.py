"""Product rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillhouse.functions.money import SCALE, money, total_units, units_to_cents
from tillhouse.functions.ranking import global_row_numbers

TOP_PRODUCTS = 10  # fixed value: the length of each city's list


def product_sales(order_items: DataFrame, scale: int = SCALE, rank_type: str = "int") -> DataFrame:
    """Quantity and revenue per product, with a rank over all products for each."""
    totals = order_items.groupBy("product_id").agg(
        F.sum("quantity").alias("sold_count"),
        units_to_cents(total_units(F.col("item_total"), scale), scale).alias("_cents"),
    )
    product = F.asc_nulls_first("product_id")
    ranks = {
        "_count_rank": [F.desc_nulls_last("sold_count"), product],
        "_revenue_rank": [F.desc_nulls_last("_cents"), product],
    }
    return global_row_numbers(totals, ranks).select(
        "product_id",
        "sold_count",
        money(F.col("_cents")).alias("summary_revenue"),
        F.col("_count_rank").cast(rank_type).alias("sold_count_ranking"),
        F.col("_revenue_rank").cast(rank_type).alias("top_revenue_ranking"),
    )


def top_products_per_city(
    order_items: DataFrame, users: DataFrame, top: int = TOP_PRODUCTS, rank_type: str = "int"
) -> DataFrame:
    """The ``top`` products by quantity in the cities of their buyers.

    Items meet the users as they are, which saves a shuffle that hardly reduces them; adaptive execution splits a user with
    very many items.  The rank limit runs before the shuffle by city as well, so of a city with
    any number of products each task sends ``top`` rows.
    """
    best_first = Window.partitionBy("city").orderBy(
        F.desc_nulls_last("ordered_quantity"), F.asc_nulls_first("product_id")
    )
    return (
        order_items.select("user_id", "product_id", "quantity")
        .join(users.select("user_id", "city"), "user_id")
        .groupBy("product_id", "city")
        .agg(F.sum("quantity").alias("ordered_quantity"))
        .withColumn("product_per_city_ranking", F.row_number().over(best_first))
        .where(F.col("product_per_city_ranking") <= top)
        .withColumn("product_per_city_ranking", F.col("product_per_city_ranking").cast(rank_type))
    )
