"""Customer loyalty: order rhythm per user and a rank over all users."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tillhouse.functions.keys import MIN_HOT_ROWS, hot_keys
from tillhouse.functions.materialize import materialize
from tillhouse.functions.money import SCALE, money
from tillhouse.functions.ranking import global_row_numbers
from tillhouse.operators.users import user_totals

SPAN = "minute"  # instants of a large group are compared within spans of this length


def mean_interval() -> Column:
    """Mean distance of a user's consecutive orders: the distances add up to the span from first to last order."""
    steps = F.col("dated_orders") - 1
    return F.when(steps > 0, (F.col("last_order_date") - F.col("first_order_date")) / steps)


def loyalty_ranks(totals: DataFrame, rank_type: str = "int") -> DataFrame:
    """Per-user loyalty attributes: more orders rank better, then shorter mean intervals, an unknown one first.

    The rank is dense, so it is the row number among the distinct pairs.  Pairs that many users share are joined with
    the users as the streamed side, which adaptive execution splits.
    """
    users = totals.withColumn("avg_interval", mean_interval())
    pairs = users.select("orders_count", "avg_interval").distinct()
    order = [F.desc("orders_count"), F.asc_nulls_first("avg_interval")]
    ranked = global_row_numbers(pairs, {"loyalty_ranking": order}).select(
        F.col("orders_count").alias("_count"),
        F.col("avg_interval").alias("_interval"),
        F.col("loyalty_ranking").cast(rank_type).alias("loyalty_ranking"),
    )
    same = (F.col("orders_count") == F.col("_count")) & F.col("avg_interval").eqNullSafe(F.col("_interval"))
    return users.join(ranked, same, "left").select(
        "user_id",
        "orders_count",
        money(F.col("amount_cents")).alias("user_total_amount"),
        "avg_interval",
        "loyalty_ranking",
    )


def previous_dates(orders: DataFrame) -> DataFrame:
    """Add ``prev_order_date`` to the orders of users whose orders each fit into one task."""
    by_date = Window.partitionBy("user_id").orderBy(*map(F.asc_nulls_first, ("order_date", "order_id", "total_amount")))
    return orders.withColumn("prev_order_date", F.lag("order_date").over(by_date))


def previous_dates_of_large_groups(orders: DataFrame) -> DataFrame:
    """The same for users with any number of orders, who are never gathered in one task.

    Rows that agree in id, date and amount are counted rather than told apart, and one of them is the first.

    Orders of one user at one instant follow each other without distance, except that the first of them looks back to
    the user's previous instant.  So only the distinct instants need an order: within spans of a minute, plus the last
    instant of the preceding span.  A span has a bounded number of instants, and a user as many spans as the data has
    minutes, however many orders there are.
    """
    place = F.struct("order_id", "total_amount")  # nulls are the smallest
    rest = [name for name in orders.columns if name not in ("user_id", "order_date", "order_id", "total_amount")]
    distinct = orders.groupBy("user_id", "order_date", "order_id", "total_amount", *rest).agg(F.count("*").alias("_copies"))
    instants = (
        orders.where(F.col("order_date").isNotNull())
        .groupBy("user_id", "order_date")
        .agg(F.min(place).alias("_first"))
        .withColumn("_span", F.date_trunc(SPAN, "order_date"))
    )
    spans = instants.groupBy("user_id", "_span").agg(F.max("order_date").alias("_last"))
    spans = spans.select(
        F.col("user_id").alias("_span_user"),
        F.col("_span").alias("_start"),
        F.lag("_last").over(Window.partitionBy("user_id").orderBy("_span")).alias("_last_before"),
    )
    within = F.lag("order_date").over(Window.partitionBy("user_id", "_span").orderBy("order_date"))
    steps = (
        instants.withColumn("_within", within)
        .join(spans, F.col("user_id").eqNullSafe(F.col("_span_user")) & (F.col("_span") == F.col("_start")))
        .select(
            F.col("user_id").alias("_step_user"),
            F.col("order_date").alias("_instant"),
            "_first",
            F.coalesce("_within", "_last_before").alias("_previous"),
        )
    )
    same = F.col("user_id").eqNullSafe(F.col("_step_user")) & (F.col("order_date") == F.col("_instant"))
    first = F.col("order_id").eqNullSafe(F.col("_first.order_id")) & (F.col("_copy") == 1)
    first = first & F.col("total_amount").eqNullSafe(F.col("_first.total_amount"))
    return (
        distinct.join(steps, same, "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))))
        .select(*orders.columns, F.when(first, F.col("_previous")).otherwise(F.col("order_date")).alias("prev_order_date"))
    )


def customer_loyalty(
    orders: DataFrame,
    totals: DataFrame | None = None,
    rank_type: str = "int",
    min_large_group: int = MIN_HOT_ROWS,
    scale: int = SCALE,
) -> DataFrame:
    """Every order with its user's order count, total, mean interval and loyalty rank, the previous order's date and
    the interval since then.

    The orders are shuffled once, by user, for the join with the user attributes and the look at the previous order
    alike.  Orders of the few users too large for that, and those without a user, take the other path.
    """
    totals = materialize(user_totals(orders, scale)) if totals is None else totals
    attributes = loyalty_ranks(totals, rank_type)
    large = hot_keys(totals, "user_id", "order_rows", min_large_group).select(F.col("user_id").alias("_large"))
    rows = orders.select("user_id", "order_id", "order_date", "total_amount")

    if large.isEmpty():
        joined = previous_dates(rows.join(attributes, "user_id"))
    else:
        large = F.broadcast(large)
        is_large = F.col("user_id").eqNullSafe(F.col("_large"))
        few = rows.join(large, is_large, "left_anti")
        many = previous_dates_of_large_groups(rows.join(large, is_large, "left_semi"))
        of_large = attributes.join(large, is_large, "left_semi").withColumnRenamed("user_id", "_user")
        many = many.join(F.broadcast(of_large), F.col("user_id").eqNullSafe(F.col("_user"))).drop("_user")
        joined = previous_dates(few.join(attributes, "user_id")).unionByName(many)

    return joined.select(
        "user_id",
        "order_id",
        "order_date",
        "total_amount",
        "orders_count",
        "user_total_amount",
        "prev_order_date",
        (F.col("order_date") - F.col("prev_order_date")).alias("orders_interval"),
        "avg_interval",
        "loyalty_ranking",
    )
