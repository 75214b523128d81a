"""Per-user totals, and what follows from them: revenue, segments, city sales and the share of the top users.

One aggregation of the orders serves all of them.  It combines on the map side, so a user with a third of all orders
costs one row per map task.  The group of orders without a user is kept, as a null user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillhouse.functions.materialize import materialize
from tillhouse.functions.money import SCALE, from_cents, mean_cents, money, percent, to_units, total_units, units_to_cents

# The segment names and their lower bounds, exclusive, in currency.
HIGH_ABOVE, MEDIUM_ABOVE = 5000, 2000
HIGH, MEDIUM, LOW = "high", "medium", "low"

BOUNDARY_WIDTH = 1e-4  # of all users, on each side of the top tenth's boundary
MIN_USERS_FOR_SHARE = 10  # fixed value: with fewer users the top tenth is empty and its share is 0


def user_totals(orders: DataFrame, scale: int = SCALE) -> DataFrame:
    """One row per user: counts of orders, the amount in cents, and the span of the order dates."""
    return orders.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("order_rows"),
        F.count("order_id").alias("orders_count"),
        total_units(F.col("total_amount"), scale).alias("_units"),
        F.count("order_date").alias("dated_orders"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
    ).withColumn("amount_cents", units_to_cents(F.col("_units"), scale)).drop("_units")


def revenue_per_user(totals: DataFrame) -> DataFrame:
    return totals.select("user_id", money(F.col("amount_cents")).alias("revenue_per_user"))


def customer_metrics(
    totals: DataFrame, high_above: float = HIGH_ABOVE, medium_above: float = MEDIUM_ABOVE
) -> DataFrame:
    """Spend, order count, spend segment and repeat-order flag per user; an unknown spend counts as low."""
    spend = money(F.col("amount_cents"))
    return totals.select(
        "user_id",
        spend.alias("summed_amount"),
        "orders_count",
        F.when(spend > high_above, HIGH).when(spend > medium_above, MEDIUM).otherwise(LOW).alias("spent_segment"),
        (F.col("orders_count") > 1).alias("more_than_1_order"),
    )


def active_users(totals: DataFrame) -> DataFrame:
    """Distinct non-null users: the totals have one row for each."""
    return totals.agg(active_users_expr().alias("active_users_count"))


def active_users_expr() -> Column:
    return F.count("user_id")


def avg_orders_expr() -> Column:
    """Mean orders per user; the null user, if there is one, counts as a user."""
    return from_cents(mean_cents(F.sum("orders_count") * 100, F.count(F.lit(1))))


def avg_orders_per_user(totals: DataFrame) -> DataFrame:
    return totals.agg(avg_orders_expr().alias("avg_orders_count"))


def city_sales(revenue: DataFrame, users: DataFrame, rank_type: str = "int") -> DataFrame:
    """Revenue, buying users and mean revenue per user by city, with a rank for the first two.

    Both sides of the join have one row per user.  The ranks are windows over one row per city.
    """
    cents = to_units(F.col("revenue_per_user"))
    per_city = (
        revenue.join(users.select("user_id", "city"), "user_id")
        .groupBy("city")
        .agg(F.sum(cents).alias("_cents"), F.count("user_id").alias("users_count"), F.count(cents).alias("_amounts"))
    )
    city = F.asc_nulls_first("city")
    by_revenue = Window.orderBy(F.desc_nulls_last("_cents"), city)
    by_users = Window.orderBy(F.desc("users_count"), city)
    return per_city.select(
        "city",
        money(F.col("_cents")).alias("revenue_per_city"),
        "users_count",
        from_cents(mean_cents(F.col("_cents"), F.col("_amounts"))).alias("avg_per_user"),
        F.row_number().over(by_revenue).cast(rank_type).alias("revenue_per_city_ranking"),
        F.row_number().over(by_users).cast(rank_type).alias("users_count_ranking"),
    )


def top_users_share(revenue: DataFrame, total_revenue: float | None = None) -> DataFrame:
    """One row: the percentage of revenue that comes from the top tenth of users, 0 with fewer than ten users.

    ``total_revenue`` replaces the sum over all users as the whole.  Users are not ranked: approximate percentiles on
    both sides of the boundary, further apart than their error, tell the amounts that are surely in or out, which are
    summed up.  Only the distinct amounts in between, at most a few ten-thousandths of the users, are put in order.
    """
    amounts = materialize(revenue.select(to_units(F.col("revenue_per_user")).alias("_cents")))
    # An unknown amount counts as a user, and as less than any amount.
    place = F.coalesce("_cents", F.lit(-(2**62)))
    accuracy = F.lit(int(2 / BOUNDARY_WIDTH))
    low = amounts.agg(F.percentile_approx(place, 0.9 - BOUNDARY_WIDTH, accuracy)).scalar()
    high = amounts.agg(F.percentile_approx(place, 0.9 + BOUNDARY_WIDTH, accuracy)).scalar()
    placed = amounts.select("_cents", place.alias("_place"), F.when(place > high, 1).when(place < low, -1).otherwise(0).alias("_side"))
    side, rows, between = F.col("_side"), F.col("_rows"), F.col("_side") == 0
    classes = placed.groupBy(
        side, F.when(between, F.col("_cents")).alias("_cents"), F.when(between, F.col("_place")).alias("_place")
    ).agg(F.count("*").alias("_rows"), F.sum("_cents").alias("_sum"))
    earlier = Window.orderBy(F.desc("_side"), F.desc("_place")).rowsBetween(Window.unboundedPreceding, -1)
    room = F.call_function("div", F.sum("_rows").over(Window.partitionBy()), F.lit(10))
    left = classes.withColumn("_left", room - F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    taken = F.least(rows, F.col("_left"))
    top = F.sum(F.when(side > 0, F.col("_sum")).when(between & (taken > 0), taken * F.col("_cents")))
    whole = F.sum("_sum") if total_revenue is None else to_units(F.lit(total_revenue))
    return left.agg(
        F.when(F.coalesce(F.sum("_rows"), F.lit(0)) < MIN_USERS_FOR_SHARE, F.lit(0.0))
        .otherwise(percent(top, whole))
        .alias("share_top_users_in_total_revenue")
    )
