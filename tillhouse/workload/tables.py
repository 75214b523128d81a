"""The retail tables, derived from the sample star schema: customers are users, parts are products, and so on.

Each table is a query over whole sample tables, in Spark here and in SQL below for the checks.  ``raw_*`` tables are
what a CSV export would hold, strings throughout; as the sample has no nulls, cells of some rows, chosen by value, are
blanked there.  The sample's order lines do contain repeated keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

DAY_TIME = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def sample(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def users(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = sample(spark, folder, "customer"), sample(spark, folder, "nation")
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.lower("c_name").alias("email"),
        F.lower("c_mktsegment").alias("gender"),
        F.col("n_name").alias("city"),
        F.date_add(F.lit("1990-01-01").cast("date"), F.col("c_nationkey")).alias("signup_date"),
    )


USERS = """
    SELECT c_custkey AS user_id, c_name AS name, lower(c_name) AS email, lower(c_mktsegment) AS gender,
           n_name AS city, CAST(DATE '1990-01-01' + c_nationkey AS DATE) AS signup_date
    FROM customer JOIN nation ON c_nationkey = n_nationkey
"""


def orders(spark: SparkSession, folder: str) -> DataFrame:
    return sample(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").cast("timestamp").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
    )


ORDERS = """
    SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_date, o_orderstatus AS order_status,
           o_totalprice AS total_amount
    FROM orders
"""


def order_items(spark: SparkSession, folder: str) -> DataFrame:
    buyer = sample(spark, folder, "orders").select("o_orderkey", "o_custkey")
    lines = sample(spark, folder, "lineitem")
    return lines.join(buyer, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_tax").alias("item_price"),
        F.col("l_extendedprice").alias("item_total"),
    )


ORDER_ITEMS = """
    SELECT concat_ws('-', l_orderkey, l_linenumber) AS order_item_id, l_orderkey AS order_id,
           l_partkey AS product_id, o_custkey AS user_id, CAST(l_quantity AS INTEGER) AS quantity,
           l_tax AS item_price, l_extendedprice AS item_total
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def fine_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders whose amounts have four decimals."""
    return orders(spark, folder).withColumn("total_amount", F.col("total_amount") / 100)


FINE_ORDERS = f"SELECT * REPLACE (total_amount / 100 AS total_amount) FROM ({ORDERS})"


def fine_order_items(spark: SparkSession, folder: str) -> DataFrame:
    """Order items whose totals have five decimals."""
    return order_items(spark, folder).withColumn("item_total", F.col("item_total") / 1000)


FINE_ORDER_ITEMS = f"SELECT * REPLACE (item_total / 1000 AS item_total) FROM ({ORDER_ITEMS})"


def products(spark: SparkSession, folder: str) -> DataFrame:
    return sample(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.lower("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").cast("double").alias("rating"),
    )


PRODUCTS = """
    SELECT p_partkey AS product_id, p_name AS product_name, lower(p_type) AS category, p_brand AS brand,
           p_retailprice AS price, CAST(p_size AS DOUBLE) AS rating
    FROM part
"""


def events(spark: SparkSession, folder: str) -> DataFrame:
    return sample(spark, folder, "events").select(
        "event_id",
        "user_id",
        F.floor(F.col("value") * 10).cast("bigint").alias("product_id"),
        "event_type",
        F.col("ts").cast("timestamp").alias("event_timestamp"),
    )


EVENTS = """
    SELECT event_id, user_id, CAST(floor(value * 10) AS BIGINT) AS product_id, event_type, ts AS event_timestamp
    FROM events
"""


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    buyer = sample(spark, folder, "orders").select("o_orderkey", "o_custkey")
    returned = sample(spark, folder, "lineitem").where(F.col("l_returnflag") == "R")
    return returned.join(buyer, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("review_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_linenumber").alias("rating"),
        F.when(F.col("l_linestatus") == "F", "fulfilled").alias("review_text"),
        F.col("l_shipdate").cast("timestamp").alias("review_date"),
    )


REVIEWS = """
    SELECT concat_ws('-', l_orderkey, l_linenumber) AS review_id, l_orderkey AS order_id, l_partkey AS product_id,
           o_custkey AS user_id, l_linenumber AS rating,
           CASE WHEN l_linestatus = 'F' THEN 'fulfilled' END AS review_text, l_shipdate AS review_date
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    WHERE l_returnflag = 'R'
"""


def blank(column: str, condition: Column) -> Column:
    return F.when(~condition, F.col(column)).alias(column)


def gappy_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with nulls in every column."""
    amount, status = F.col("total_amount"), F.col("order_status")
    return orders(spark, folder).select(
        blank("order_id", amount < 20_000),
        blank("user_id", (status == "F") & (amount < 200_000)),
        blank("order_date", (status == "F") & (amount < 100_000)),
        blank("order_status", status == "P"),
        blank("total_amount", amount > 400_000),
    )


GAPPY_ORDERS = f"""
    SELECT CASE WHEN NOT total_amount < 20000 THEN order_id END AS order_id,
           CASE WHEN NOT (order_status = 'F' AND total_amount < 200000) THEN user_id END AS user_id,
           CASE WHEN NOT (order_status = 'F' AND total_amount < 100000) THEN order_date END AS order_date,
           CASE WHEN NOT order_status = 'P' THEN order_status END AS order_status,
           CASE WHEN NOT total_amount > 400000 THEN total_amount END AS total_amount
    FROM ({ORDERS})
"""


def as_text(df: DataFrame) -> DataFrame:
    """All columns as the strings of a CSV export."""
    return df.select(
        *[
            (F.date_format(name, DAY_TIME) if dtype.startswith("timestamp") else F.col(name).cast("string")).alias(name)
            for name, dtype in df.dtypes
        ]
    )


SOURCES = {
    "events": (events, EVENTS),
    "order_items": (order_items, ORDER_ITEMS),
    "orders": (gappy_orders, GAPPY_ORDERS),
    "products": (products, PRODUCTS),
    "reviews": (reviews, REVIEWS),
    "users": (users, USERS),
}


def raw_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {name: as_text(build(spark, folder)) for name, (build, _) in SOURCES.items()}
