"""A value that a third of the rows share must not end up in one task."""

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import dedup, loyalty, products, rules
from tillhouse.operators import users as per_user

ROWS = 240_000

# Small enough for the tables below; the defaults suit partitions of hundreds of megabytes.
LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def limits(spark):
    before = {key: spark.conf.get(key) for key in LIMITS}
    for key, value in LIMITS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def skewed(spark, distinct=20_000):
    """Rows ``(id, user_id, product_id)``; user ``hot`` has a third of them."""
    cold = F.format_string("u%d", F.pmod(F.xxhash64("id"), F.lit(distinct)))
    return spark.range(0, ROWS, 1, 8).select(
        F.format_string("r%d", "id").alias("id"),
        F.when(F.pmod("id", F.lit(3)) == 0, "hot").otherwise(cold).alias("user_id"),
        F.format_string("p%d", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50_000))).alias("product_id"),
    )


def all_users(spark, distinct=20_000):
    numbered = spark.range(distinct).select(F.format_string("u%d", "id").alias("user_id"))
    return numbered.union(spark.createDataFrame([("hot",)], "user_id string")).withColumn("city", F.lit("C"))


def executed(df):
    """The result's row count and the plan that adaptive execution arrived at."""
    counted = df.groupBy().agg(F.count(F.lit(1)), *[F.max(F.col(c)) for c in df.columns])
    rows = counted.collect()[0][0]
    return rows, counted._jdf.queryExecution().executedPlan().toString()


def test_reference_flags_split_a_hot_key(spark, limits):
    """With many keys and many unknown values."""
    known = all_users(spark).where(F.pmod(F.xxhash64("user_id"), F.lit(2)) == 0)
    flagged = rules.flag_reference(skewed(spark), known, "user_id", "found", max_broadcast=10)
    rows, plan = executed(flagged)
    assert rows == ROWS
    assert "SortMergeJoin(skew=true)" in plan
    assert flagged.where("found").count() == skewed(spark).join(known, "user_id", "left_semi").count()


def test_reference_flags_do_not_shuffle_rows_for_few_keys_or_few_unknown_values(spark, limits):
    users = all_users(spark)
    cold = users.where("user_id <> 'hot'")
    few_unknown = rules.flag_reference(skewed(spark), cold, "user_id", "found", max_broadcast=10)
    few_keys = rules.flag_reference(skewed(spark), users, "user_id", "found", max_broadcast=20_001)
    for flagged, found in [(few_unknown, ROWS * 2 // 3), (few_keys, ROWS)]:
        assert "Exchange hashpartitioning" not in flagged._jdf.queryExecution().executedPlan().toString()
        assert flagged.where("found").count() == found


def test_city_products_split_a_hot_user(spark, limits):
    items = skewed(spark).withColumn("quantity", F.lit(1))
    _, plan = executed(products.top_products_per_city(items, all_users(spark)))
    assert "SortMergeJoin(skew=true)" in plan


def test_loyalty_ranks_split_a_common_rhythm(spark, limits):
    """Two thirds of the users have one order, hence one rank."""
    user = F.when(F.pmod("id", F.lit(3)) > 0, F.col("id")).otherwise(F.col("id") - F.pmod("id", F.lit(12)))
    orders = spark.range(0, ROWS, 1, 8).select(
        F.format_string("o%d", "id").alias("order_id"),
        F.format_string("u%d", user).alias("user_id"),
        F.timestamp_seconds(F.col("id") * 100 + F.pmod(F.xxhash64("id"), F.lit(1000))).alias("order_date"),
        F.lit(1.0).alias("total_amount"),
    )
    totals = per_user.user_totals(orders)
    rows, plan = executed(loyalty.loyalty_ranks(totals))
    assert rows == totals.count()
    assert "SortMergeJoin(skew=true)" in plan


def test_large_group_meets_its_instants_in_parts(spark, limits):
    orders = skewed(spark).select(
        F.col("id").alias("order_id"),
        "user_id",
        F.when(F.col("user_id") == "hot", F.timestamp_seconds(F.lit(0)))
        .otherwise(F.timestamp_seconds(F.pmod(F.xxhash64("id"), F.lit(10**6))))
        .alias("order_date"),
        F.lit(1.0).alias("total_amount"),
    )
    rows, plan = executed(loyalty.previous_dates_of_large_groups(orders))
    assert rows == ROWS
    assert "SortMergeJoin(skew=true)" in plan


def test_copies_compete_within_input_partitions(spark, limits):
    """All rows are equal; each input partition ranks its own, and one row of each meets the others."""
    copies = spark.range(0, ROWS, 1, 8).select(F.lit("k").alias("id"), F.lit("v").alias("value"))
    marked = dedup.mark_survivors(copies, ["id"], "kept")
    assert marked.where("kept").count() == 1
    per_task = marked.groupBy(F.spark_partition_id()).count()
    assert per_task.agg(F.max("count")).first()[0] < ROWS / 2
    assert dedup.reject_copies(copies, ["id"]).count() == ROWS - 1
    assert dedup.keep_survivors(copies, ["id"]).count() == 1
