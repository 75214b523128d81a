"""Sales over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillhouse.functions.money import SCALE, from_cents, mean_cents, money, percent, total_units

TOP_DAYS = 5  # fixed value: the best days that get a mark


def total_revenue(orders: DataFrame, scale: int = SCALE) -> DataFrame:
    return orders.agg(money(total_units(F.col("total_amount"), scale), scale).alias("total_system_revenue"))


def daily_sales(orders: DataFrame, scale: int = SCALE, rank_type: str = "int") -> DataFrame:
    """Revenue, mean order value and order count per day, the day's revenue rank, and the change of the mean against
    the previous day with orders.

    Orders without a date form a day of their own, which comes first.  The windows run over one row per calendar day,
    so a single task is enough for any number of orders.
    """
    amount = F.col("total_amount")
    per_day = (
        orders.groupBy(F.to_date("order_date").alias("order_day"))
        .agg(
            total_units(amount, scale).alias("_units"),
            F.count(amount).alias("_amounts"),
            F.count("order_id").alias("order_count"),
        )
        .withColumn("_mean", mean_cents(F.col("_units"), F.col("_amounts"), scale))
    )
    best_first = Window.orderBy(F.desc("daily_revenue"), F.asc("order_day"))
    by_day = Window.orderBy(F.asc_nulls_first("order_day"))
    before = F.lag("_mean").over(by_day)
    return (
        per_day.withColumn("daily_revenue", money(F.col("_units"), scale))
        .withColumn("revenue_ranking", F.row_number().over(best_first).cast(rank_type))
        .withColumn("_before", before)
        .withColumn("_change", F.col("_mean") - F.col("_before"))
        .select(
            "order_day",
            "daily_revenue",
            from_cents(F.col("_mean")).alias("avg_total_amount"),
            "order_count",
            "revenue_ranking",
            (F.col("revenue_ranking") <= TOP_DAYS).alias("is_in_top_5"),
            from_cents(F.col("_change")).alias("avg_total_amount_change"),
            percent(F.col("_change"), F.col("_before")).alias("pct_change_rate"),
        )
    )
