"""The operators applied to the sample tables, by query name.  ``oracles.py`` has the same results in SQL."""

from __future__ import annotations

import datetime
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillhouse.functions.concurrency import run_together
from tillhouse.functions.materialize import scratch_path
from tillhouse.functions.money import to_units
from tillhouse.operators import contracts, cubes, dedup, kpis, loyalty, multisets, nulls, rules, sales, sampling, sketches
from tillhouse.operators import orders as order_values
from tillhouse.operators import products as rankings
from tillhouse.operators import timejoin
from tillhouse.operators import users as per_user
from tillhouse.operators.provenance import stamp_batch
from tillhouse.plans import jobs, policies
from tillhouse.sources import buckets
from tillhouse.sources import tables as io
from tillhouse.sources.releases import Releases
from tillhouse.sources.versions import VersionedTable
from tillhouse.streaming import windows
from tillhouse.workload import tables as src

BATCH = "batch-1"
AS_OF = datetime.datetime(2020, 1, 1)
PAST_LIMIT = datetime.datetime(1998, 6, 1)

# The sample's amounts and categories differ from the defaults' scale and vocabulary.
HIGH_ABOVE, MEDIUM_ABOVE = 3_000_000, 2_000_000
BUCKETS = [
    (5_000, "very_low"),
    (15_000, "low"),
    (30_000, "medium_low"),
    (60_000, "medium"),
    (100_000, "medium_high"),
    (200_000, "high"),
]
ENUMS = {
    "event_type": ["purchase", "view", "click"],
    "order_status": ["F", "O"],
    "category": ["economy", "promo", "small"],
    "gender": ["machinery", "building", "automobile"],
}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# Schema contracts, casts, provenance


@query
def contract_projection(spark, folder):
    raw = src.raw_tables(spark, folder)
    wide = {"orders": raw["orders"].withColumn("note", F.lit("not in the contract")), "notes": raw["users"]}
    return contracts.project_contracts(wide, {"orders": ["order_id", "total_amount", "user_id"]})["orders"]


@query
def typed_cast(spark, folder):
    text = src.as_text(src.orders(spark, folder))
    types = {"order_id": "bigint", "user_id": "bigint", "order_date": "timestamp", "total_amount": "double"}
    return contracts.cast_tables({"orders": text}, {"orders": types})["orders"]


@query
def typed_cast_lenient(spark, folder):
    value = F.when(F.col("order_status") == "P", F.lit("n/a")).otherwise(F.col("user_id").cast("string"))
    text = src.orders(spark, folder).select("order_id", value.alias("user_id"))
    return contracts.cast_columns(text, {"user_id": "bigint"}, lenient=True)


@query
def schema_violations(spark, folder):
    """The violations, with the number of rows they affect."""
    tables = {"orders": src.orders(spark, folder), "products": src.products(spark, folder)}
    expected = {
        "orders": [("order_id", "bigint"), ("total_amount", "string"), ("coupon", "string")],
        "products": [("product_id", "bigint"), ("price", "double")],
        "shops": [("shop_id", "string")],
    }
    found = contracts.violations_frame(spark, contracts.schema_violations(tables, expected))
    return found.join(_row_counts(tables), "table_name", "left")


@query
def column_presence(spark, folder):
    """Whether the orders have the columns asked for, with the number of rows concerned."""
    orders = src.orders(spark, folder)
    return orders.agg(F.count("*").alias("row_count")).select(
        F.lit(contracts.has_columns(orders, ["order_id", "total_amount"])).alias("has_amount"),
        F.lit(contracts.has_columns(orders, ["order_id", "coupon"])).alias("has_coupon"),
        "row_count",
    )


@query
def nonempty_tables(spark, folder):
    tables = {
        "orders": src.orders(spark, folder),
        "refunds": src.orders(spark, folder).where(F.col("total_amount") < 0),
        "users": src.users(spark, folder),
    }
    return _row_counts(contracts.require_content(tables, skip_invalid=True))


@query
def provenance_stamp(spark, folder):
    return stamp_batch({"orders": src.orders(spark, folder)}, BATCH, AS_OF)["orders"]


# Nulls


@query
def null_profile(spark, folder):
    tables = {
        "orders": src.gappy_orders(spark, folder),
        "reviews": src.reviews(spark, folder),
        "users": src.users(spark, folder),
    }
    return nulls.null_profile(tables)


@query
def null_counts(spark, folder):
    return nulls.null_counts(src.gappy_orders(spark, folder))


@query
def null_drop(spark, folder):
    return nulls.drop_nulls(src.gappy_orders(spark, folder), ["order_id", "user_id"])


@query
def null_fill_unknown(spark, folder):
    return nulls.fill_unknown(src.gappy_orders(spark, folder), ["order_status"])


@query
def null_fill_empty(spark, folder):
    return nulls.fill_empty(src.reviews(spark, folder), ["review_text", "rating"])


@query
def null_flagging(spark, folder):
    return nulls.flag_nulls(src.gappy_orders(spark, folder), ["user_id", "order_date", "total_amount"])


@query
def null_policy(spark, folder):
    return nulls.handle_nulls({"orders": src.gappy_orders(spark, folder)}, policies.NULL_POLICIES)["orders"]


# De-duplication


@query
def dedup_kept(spark, folder):
    return dedup.keep_survivors(src.sample(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def dedup_rejected(spark, folder):
    return dedup.reject_copies(src.sample(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


def _split_lines(spark: SparkSession, folder: str, **options) -> tuple[DataFrame, DataFrame]:
    """Kept and rejected order lines, as ``silver`` gets them."""
    tables = {"lines": src.sample(spark, folder, "lineitem")}
    kept, rejected = dedup.deduplicate(tables, {"lines": ["l_orderkey", "l_linenumber"]}, **options)
    return kept["lines"], rejected["lines"]


@query
def dedup_split_kept(spark, folder):
    return _split_lines(spark, folder)[0]


@query
def dedup_split_rejected(spark, folder):
    return _split_lines(spark, folder)[1]


@query
def dedup_split_rejected_many_keys(spark, folder):
    """With more repeated keys than may be broadcast."""
    return _split_lines(spark, folder, max_broadcast=0)[1]


@query
def dedup_by_completeness(spark, folder):
    """The most complete order of each user and status."""
    return dedup.keep_survivors(src.gappy_orders(spark, folder), ["user_id", "order_status"])


# Business rules


@query
def flag_reference(spark, folder):
    """Orders of users with at least one event."""
    orders = src.gappy_orders(spark, folder).select("order_id", "user_id")
    return rules.flag_reference(orders, src.events(spark, folder), "user_id", "df_events_ref")


@query
def flag_reference_many_keys(spark, folder):
    """With more keys in the parent than may be broadcast, but fewer unknown values."""
    orders = src.gappy_orders(spark, folder).select("order_id", "user_id")
    known = rules.key_set(src.events(spark, folder), "user_id")
    return rules.flag_reference(orders, known, "user_id", "df_events_ref", max_broadcast=known.count - 1)


@query
def flag_reference_many_unknown(spark, folder):
    """With neither few keys nor few unknown values."""
    orders = src.gappy_orders(spark, folder).select("order_id", "user_id")
    return rules.flag_reference(orders, src.events(spark, folder), "user_id", "df_events_ref", max_broadcast=0)


@query
def flag_enum(spark, folder):
    orders = src.gappy_orders(spark, folder)
    flag = rules.in_domain("order_status", ENUMS["order_status"])
    return orders.select("order_id", "order_status", flag.alias("correct_order_status"))


@query
def flag_past(spark, folder):
    orders = src.gappy_orders(spark, folder)
    return orders.select("order_id", "order_date", rules.in_past("order_date", PAST_LIMIT).alias("correct_order_date"))


@query
def flag_positive(spark, folder):
    customer = src.sample(spark, folder, "customer").select("c_custkey", "c_acctbal")
    return customer.withColumn("correct_c_acctbal", rules.positive("c_acctbal"))


@query
def business_flags(spark, folder):
    tables = {"orders": src.gappy_orders(spark, folder)}
    parents = {"events": src.events(spark, folder)}
    order_rules = {**policies.RULES["orders"], "user_id": "df_events"}
    return rules.flag_tables(tables, {"orders": order_rules}, ENUMS, parents, as_of=PAST_LIMIT)["orders"]


# Analytical tables


@query
def total_revenue(spark, folder):
    return sales.total_revenue(src.orders(spark, folder))


@query
def daily_sales(spark, folder):
    return sales.daily_sales(src.orders(spark, folder), rank_type="bigint")


@query
def daily_sales_with_gaps(spark, folder):
    return sales.daily_sales(src.gappy_orders(spark, folder), rank_type="bigint")


@query
def revenue_per_user(spark, folder):
    return per_user.revenue_per_user(per_user.user_totals(src.gappy_orders(spark, folder)))


@query
def total_revenue_of_fractions(spark, folder):
    return sales.total_revenue(src.fine_orders(spark, folder))


@query
def daily_sales_of_fractions(spark, folder):
    return sales.daily_sales(src.fine_orders(spark, folder))


@query
def revenue_per_user_of_fractions(spark, folder):
    return per_user.revenue_per_user(per_user.user_totals(src.fine_orders(spark, folder)))


@query
def product_sales_of_fractions(spark, folder):
    return rankings.product_sales(src.fine_order_items(spark, folder))


@query
def top_decile_share(spark, folder):
    return per_user.top_users_share(per_user.revenue_per_user(per_user.user_totals(src.orders(spark, folder))))


@query
def city_sales(spark, folder):
    revenue = per_user.revenue_per_user(per_user.user_totals(src.orders(spark, folder)))
    return per_user.city_sales(revenue, src.users(spark, folder), rank_type="bigint")


@query
def customer_metrics(spark, folder):
    return per_user.customer_metrics(per_user.user_totals(src.gappy_orders(spark, folder)), HIGH_ABOVE, MEDIUM_ABOVE)


@query
def active_users(spark, folder):
    return per_user.active_users(per_user.user_totals(src.gappy_orders(spark, folder)))


@query
def avg_orders_per_user(spark, folder):
    return per_user.avg_orders_per_user(per_user.user_totals(src.gappy_orders(spark, folder)))


@query
def product_sales(spark, folder):
    return rankings.product_sales(src.order_items(spark, folder), rank_type="bigint")


@query
def top_products_per_city(spark, folder):
    return rankings.top_products_per_city(src.order_items(spark, folder), src.users(spark, folder), rank_type="bigint")


@query
def order_buckets(spark, folder):
    return order_values.order_buckets(src.gappy_orders(spark, folder), BUCKETS)


@query
def multi_product_share(spark, folder):
    return order_values.multi_product_share(src.orders(spark, folder), src.order_items(spark, folder))


def _micros(interval: str) -> Column:
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + F.col(interval)).alias(f"{interval}_us")


def _loyalty(orders: DataFrame, **options) -> DataFrame:
    return _with_micros(loyalty.customer_loyalty(orders, rank_type="bigint", **options))


def _with_micros(result: DataFrame) -> DataFrame:
    intervals = ("orders_interval", "avg_interval")
    return result.select(*[c for c in result.columns if c not in intervals], *map(_micros, intervals))


@query
def customer_loyalty(spark, folder):
    return _loyalty(src.orders(spark, folder))


@query
def customer_loyalty_of_fractions(spark, folder):
    return _loyalty(src.fine_orders(spark, folder))


@query
def customer_loyalty_with_gaps(spark, folder):
    """Orders without a user and orders without a date included; those without an id are dropped, as in the pipeline."""
    return _loyalty(nulls.drop_nulls(src.gappy_orders(spark, folder), ["order_id"]))


@query
def customer_loyalty_large_groups(spark, folder):
    """The same on the path of users with too many orders for one task, here taken by all."""
    return _loyalty(nulls.drop_nulls(src.gappy_orders(spark, folder), ["order_id"]), min_large_group=0)


@query
def run_kpis(spark, folder):
    orders, items = src.orders(spark, folder), src.order_items(spark, folder)
    return kpis.run_kpis(orders, items, batch_id=BATCH, as_of=AS_OF)


# Sources and sinks


def _export(spark: SparkSession, folder: str, names: list[str]) -> str:
    """A folder with CSV exports of the raw tables."""
    target = scratch_path(spark, "raw")
    raw = src.raw_tables(spark, folder)

    def export(name: str) -> None:
        raw[name].write.csv(f"{target}/{name}.csv", header=True, compression="gzip")

    run_together(spark, {name: partial(export, name) for name in names})
    return target


@query
def csv_scan(spark, folder):
    exported = _export(spark, folder, ["orders"])
    return io.scan_csv_tables(spark, exported, ["orders.csv", "absent.csv"], probe=True)["orders"]


@query
def parquet_scan(spark, folder):
    scanned = io.scan_parquet_tables(spark, folder, ["nation.parquet", "customer.parquet"], probe=True)
    return scanned["customer.parquet"]


@query
def required_tables(spark, folder):
    """Rows of a whole table set; a set that lacks one of its tables has none."""
    sets = {"whole": ["customer.parquet", "nation.parquet"], "broken": ["customer.parquet", "absent.parquet"]}
    found = {name: io.scan_parquet_tables(spark, folder, files) for name, files in sets.items()}
    return _row_counts({f"{name}/{file}": df for name, tables in found.items() for file, df in tables.items()})


@query
def parquet_sink(spark, folder):
    target = scratch_path(spark, "tables")
    tables = {"orders": src.gappy_orders(spark, folder), "users": src.users(spark, folder)}
    io.write_tables(tables, target)
    return io.scan_parquet_tables(spark, target, list(tables))["orders"]


@query
def report_sink(spark, folder):
    """A report written twice: the second replaces the first."""
    target = scratch_path(spark, "reports")
    io.write_table(src.products(spark, folder), target, "buckets")
    io.write_table(order_values.order_buckets(src.orders(spark, folder), BUCKETS), target, "buckets")
    return spark.read.parquet(f"{target}/buckets")


@query
def metrics_history(spark, folder):
    """Two runs, the second one over the orders with gaps."""
    target = scratch_path(spark, "history")
    totals = sales.total_revenue(src.orders(spark, folder)).withColumn("batch_id", F.lit("batch-1"))
    io.append_metrics(totals, target)
    second = sales.total_revenue(src.gappy_orders(spark, folder))
    io.append_metrics(second.withColumn("batch_id", F.lit("batch-2")), target)
    return io.read_metrics(spark, target, totals.schema)


# Jobs


def _row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")

    return reduce(DataFrame.unionByName, [counted(name, df) for name, df in tables.items()])


def _bronze(spark: SparkSession, folder: str, root: str) -> dict[str, str]:
    exported = _export(spark, folder, policies.TABLES)
    return jobs.bronze(spark, exported, f"{root}/bronze", batch_id=BATCH, as_of=AS_OF)


def _silver(spark: SparkSession, folder: str, root: str) -> dict[str, str]:
    _bronze(spark, folder, root)
    return jobs.silver(
        spark,
        f"{root}/bronze",
        f"{root}/silver",
        rejected_target=f"{root}/rejected",
        enums=ENUMS,
        as_of=AS_OF,
    )


@query
def bronze_job(spark, folder):
    """Rows, non-null cells and characters per table, in the one batch."""
    paths = _bronze(spark, folder, scratch_path(spark, "bronze"))

    def summary(name: str, path: str) -> DataFrame:
        columns = policies.COLUMNS[name]
        cells = reduce(Column.__add__, [F.col(c).isNotNull().cast("bigint") for c in columns])
        return (
            spark.read.parquet(path)
            .groupBy("batch_id", "ingestion_time")
            .agg(
                F.count(F.lit(1)).alias("row_count"),
                F.sum(cells).alias("cell_count"),
                F.sum(F.length(F.concat_ws("|", *columns))).alias("text_length"),
            )
            .withColumn("table_name", F.lit(name))
        )

    return reduce(DataFrame.unionByName, [summary(name, path) for name, path in paths.items()])


@query
def silver_job(spark, folder):
    """Kept, sound, gappy and rejected rows per table."""
    root = scratch_path(spark, "silver")
    paths = _silver(spark, folder, root)

    def summary(name: str, path: str) -> DataFrame:
        df = spark.read.parquet(path)
        gappy = F.col(nulls.FLAG_COLUMN).isNotNull() if nulls.FLAG_COLUMN in df.columns else F.lit(False)
        rejected = spark.read.parquet(f"{root}/rejected/{name}").agg(F.count(F.lit(1)))
        return df.agg(
            F.count(F.lit(1)).alias("kept"),
            F.count_if(rules.OVERALL_FLAG).alias("sound"),
            F.count_if(gappy).alias("gappy"),
        ).select(F.lit(name).alias("table_name"), "kept", "sound", "gappy", rejected.scalar().alias("rejected"))

    return reduce(DataFrame.unionByName, [summary(name, path) for name, path in paths.items()])


@query
def silver_orders(spark, folder):
    return spark.read.parquet(_silver(spark, folder, scratch_path(spark, "silver"))["orders"])


@query
def silver_rejected_items(spark, folder):
    root = scratch_path(spark, "silver")
    _silver(spark, folder, root)
    return spark.read.parquet(f"{root}/rejected/order_items")


def write_clean_tables(spark: SparkSession, folder: str, target: str) -> None:
    """The sample with the types of clean tables."""
    typed = {
        name: contracts.cast_columns(build(spark, folder), dict(policies.CLEAN_SCHEMA[name]), name)
        for name, (build, _) in src.SOURCES.items()
    }
    io.write_tables(typed, target)


# For each analytical table, the number that is added up to compare its contents.
GOLD_SUMS: dict[str, Callable[[], Column]] = {
    "sales_and_revenues": lambda: to_units(F.col("daily_revenue")),
    "geography": lambda: to_units(F.col("avg_per_user")),
    "customer_metrics": lambda: F.col("orders_count"),
    "products": lambda: F.col("top_revenue_ranking") * F.col("sold_count"),
    "orders": lambda: to_units(F.col("total_amount")),
    "customers_loyalty": lambda: F.col("loyalty_ranking").cast("bigint"),
    "top_products_per_city": lambda: F.col("product_per_city_ranking") * F.col("ordered_quantity"),
}


def _gold(spark: SparkSession, folder: str) -> dict[str, str]:
    root = scratch_path(spark, "gold")
    write_clean_tables(spark, folder, f"{root}/silver")
    return jobs.gold(spark, f"{root}/silver", f"{root}/gold", f"{root}/reports", batch_id=BATCH, as_of=AS_OF)


@query
def gold_customers_loyalty(spark, folder):
    return _with_micros(spark.read.parquet(_gold(spark, folder)["customers_loyalty"]))


@query
def gold_customer_metrics(spark, folder):
    return spark.read.parquet(_gold(spark, folder)["customer_metrics"])


@query
def gold_orders(spark, folder):
    return spark.read.parquet(_gold(spark, folder)["orders"])


@query
def gold_products(spark, folder):
    return spark.read.parquet(_gold(spark, folder)["products"])


@query
def gold_job(spark, folder):
    """Rows and a sum per analytical table."""
    paths = _gold(spark, folder)

    def summary(name: str, total: Column) -> DataFrame:
        df = spark.read.parquet(paths[name])
        return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(total).alias("total")).withColumn(
            "table_name", F.lit(name)
        )

    return reduce(DataFrame.unionByName, [summary(name, total()) for name, total in GOLD_SUMS.items()])


@query
def full_run(spark, folder):
    """The metrics record of a run from CSV files to reports."""
    root = scratch_path(spark, "pipeline")
    exported = _export(spark, folder, policies.TABLES)
    paths = jobs.pipeline(spark, exported, root, batch_id=BATCH, as_of=AS_OF, enums=ENUMS)
    schema = (
        "batch_id string, share_top_users_in_total_revenue double, active_users_count bigint, "
        "avg_orders_count_per_user double, big_orders_share double"
    )
    return io.read_metrics(spark, paths["report"], schema)


# Incremental merges


def _merged_orders(spark: SparkSession, folder: str) -> VersionedTable:
    """Orders in three versions: those before 2000; newer ones and changes; late news that are out of date, and deletions."""
    orders = src.orders(spark, folder)
    columns = ["order_id", "user_id", "order_status", "total_amount"]
    recent = F.col("order_date") >= F.lit("2000-01-01").cast("timestamp")
    first = orders.where(~recent).select(*columns, F.lit(1).alias("revision"))
    changed = orders.where(recent | (F.col("order_status") == "P"))
    changed = changed.withColumn("order_status", F.lit("X")).select(*columns, F.lit(2).alias("revision"))
    outdated = orders.where(F.col("order_status") == "F").withColumn("order_status", F.lit("old"))
    outdated = outdated.select(*columns, F.lit(0).alias("revision"), F.lit(False).alias("gone"))
    small = orders.where(F.col("total_amount") < 20_000).select(*columns, F.lit(3).alias("revision"), F.lit(True).alias("gone"))
    table = VersionedTable(spark, scratch_path(spark, "versions"))
    table.create(first, ["order_id"])
    table.merge(changed, "revision")
    table.merge(outdated.unionByName(small), "revision", "gone")
    return table


@query
def merged_orders(spark, folder):
    """After two merges, which equal a recompute from all orders."""
    return _merged_orders(spark, folder).read()


@query
def merged_orders_before(spark, folder):
    """The first version, read after the merges."""
    return _merged_orders(spark, folder).read(1)


@query
def merged_orders_changes(spark, folder):
    """What differs between the first version and the last."""
    return _merged_orders(spark, folder).changes(1, 3)


# Joins in time


def _reviews_as_of_orders(spark, folder, strict: bool, **options) -> DataFrame:
    reviews = src.reviews(spark, folder).select("review_id", F.col("user_id"), "review_date")
    orders = src.orders(spark, folder).select("user_id", "order_date", F.col("order_id").alias("last_order"), "total_amount")
    return timejoin.as_of_join(
        reviews, orders, ["user_id"], "review_date", "order_date", ["last_order", "total_amount"], ["last_order"], strict, **options
    )


@query
def reviews_as_of_orders(spark, folder):
    """Each review with its user's last order until then."""
    return _reviews_as_of_orders(spark, folder, False)


@query
def reviews_as_of_orders_large_users(spark, folder):
    """With most users' rows divided by time, and orders before the day of the review only."""
    return _reviews_as_of_orders(spark, folder, True, min_hot_rows=20)


@query
def events_after_purchases(spark, folder):
    """Views up to 36 hours after each purchase of their user."""
    events = src.events(spark, folder)
    views = events.where("event_type = 'view'").select("event_id", "user_id", "event_timestamp")
    bought = events.where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"),
        "user_id",
        F.col("event_timestamp").alias("bought"),
        (F.col("event_timestamp") + F.expr("INTERVAL 36 HOURS")).alias("until"),
    )
    found = timejoin.join_points_to_intervals(views, bought, "event_timestamp", "bought", "until", ["user_id"])
    return found.select("event_id", "purchase_id", "user_id")


@query
def overlapping_fulfilments(spark, folder):
    """Pairs of a user's orders of which one was placed before all lines of the other were shipped; months may pass."""
    lines = src.sample(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("order_id"))
    shipped = lines.agg(F.max(F.col("l_shipdate").cast("timestamp")).alias("shipped"))
    spans = src.orders(spark, folder).join(shipped, "order_id").select("user_id", "order_id", "order_date", "shipped")
    one = spans.toDF("user_id", "order_a", "ordered_a", "shipped_a")
    two = spans.toDF("user_id", "order_b", "ordered_b", "shipped_b")
    found = timejoin.join_overlapping(one, two, ("ordered_a", "shipped_a"), ("ordered_b", "shipped_b"), ["user_id"])
    return found.where("order_a < order_b").select("user_id", "order_a", "order_b")


# Windows and sessions, over the table and over a stream of it


def _event_totals() -> dict[str, Column]:
    return {"event_count": F.count(F.lit(1)), "first_event": F.min("event_id"), "last_event": F.max("event_id")}


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events in four files by time; errors of the first half come a file late."""
    events, path = src.events(spark, folder), scratch_path(spark, "events")
    days = F.dayofmonth("event_timestamp")
    number = F.least(F.floor((days - 1) / 8), F.lit(3)) + F.when((F.col("event_type") == "error") & (days <= 16), 1).otherwise(0)
    for part in range(4):
        events.where(number == part).coalesce(1).write.mode("append").parquet(path)
    return windows.stream_files(spark, path, events.schema, 1)


@query
def event_windows(spark, folder):
    """Twelve hours, every six."""
    events = src.events(spark, folder)
    return windows.window_totals(events, "event_timestamp", ["event_type"], _event_totals(), "12 hours", "6 hours")


@query
def event_windows_streamed(spark, folder):
    """The same of a stream, late rows included, kept up to date in a versioned table."""
    table = VersionedTable(spark, scratch_path(spark, "windows"))
    totals = windows.window_totals(
        _event_stream(spark, folder), "event_timestamp", ["event_type"], _event_totals(), "12 hours", "6 hours", "30 days"
    )
    keys = ["window_start", "window_end", "event_type"]
    windows.keep_merged(totals, table, keys, scratch_path(spark, "windows-checkpoint"), buckets=8)
    return table.read()


@query
def event_sessions(spark, folder):
    """Sessions of users that end after eight hours without an event."""
    return windows.session_counts(src.events(spark, folder), "event_timestamp", ["user_id"], "8 hours")


@query
def event_sessions_streamed(spark, folder):
    """Sessions of a stream that are final once nothing earlier than 20 days before the last event may come."""
    out, totals = scratch_path(spark, "sessions"), {"events": F.count(F.lit(1))}
    found = windows.session_totals(_event_stream(spark, folder), "event_timestamp", ["user_id"], totals, "8 hours", "20 days")
    windows.append_files(found, out, scratch_path(spark, "sessions-checkpoint"))
    return spark.read.schema(found.schema).parquet(out)


# Grouping sets


def _sold(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with their city, category and month; the month is unknown for some orders."""
    items = src.order_items(spark, folder).select("order_id", "product_id", "user_id", "quantity", "item_total")
    month = F.date_format("order_date", "yyyy-MM").alias("month")
    months = src.gappy_orders(spark, folder).where("order_id is not null").select("order_id", month)
    cities = src.users(spark, folder).select("user_id", "city")
    categories = src.products(spark, folder).select("product_id", "category")
    return items.join(months, "order_id", "left").join(cities, "user_id", "left").join(categories, "product_id", "left")


def _sold_measures() -> dict[str, cubes.Measure]:
    amount = F.col("item_total")
    return {
        "lines": cubes.row_count(),
        "sold": cubes.total(F.col("quantity")),
        "revenue": cubes.money_total(amount),
        "mean_revenue": cubes.money_mean(amount),
        "least": cubes.smallest(amount),
        "most": cubes.largest(amount),
    }


@query
def sales_cube(spark, folder):
    """By city, category and month, and all coarser sets."""
    return cubes.cube(_sold(spark, folder), ["city", "category", "month"], _sold_measures())


@query
def sales_rollup(spark, folder):
    """Statuses and users of orders, both with nulls of their own."""
    measures = {"order_rows": cubes.row_count(), "amounts": cubes.value_count(F.col("total_amount"))}
    measures["revenue"] = cubes.money_total(F.col("total_amount"))
    return cubes.rollup(src.gappy_orders(spark, folder), ["order_status", "user_id"], measures)


@query
def sales_grouping_sets(spark, folder):
    """Sets without a common finest one among them."""
    sets = [("city", "month"), ("category",), ("month",), ()]
    return cubes.grouping_sets(_sold(spark, folder), ["city", "category", "month"], sets, _sold_measures())


# Snapshots as multisets


def _lines_and_returns(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Quantity and status (unknown where fulfilled) of all order lines; and of returned ones, with larger quantities."""
    lines = src.sample(spark, folder, "lineitem")
    status = F.when(F.col("l_linestatus") != "F", F.col("l_linestatus")).alias("status")
    every = lines.select(F.col("l_quantity").alias("quantity"), status)
    returned = lines.where("l_returnflag = 'R'").select(status, (F.col("l_quantity") + 5).alias("quantity"))
    return every, returned


@query
def lines_except_all(spark, folder):
    """Multiset difference; rows have many copies and nulls."""
    return multisets.except_all(*_lines_and_returns(spark, folder))


@query
def lines_intersect_all(spark, folder):
    return multisets.intersect_all(*_lines_and_returns(spark, folder))


@query
def lines_differences(spark, folder):
    """Numbers of copies that were added or removed."""
    return multisets.differences(*_lines_and_returns(spark, folder))


@query
def orders_change_feed(spark, folder):
    """From the orders before 2000 to those above 20,000, of which some lost their status."""
    before = src.orders(spark, folder).where(F.col("order_date") < F.lit("2000-01-01").cast("timestamp"))
    after = src.orders(spark, folder).where("total_amount >= 20000")
    after = after.withColumn("order_status", F.expr("nullif(order_status, 'P')"))
    columns = ["order_id", "order_status", "total_amount"]
    return multisets.change_feed(before.select(*columns), after.select(*columns), ["order_id"])


# Samples


@query
def orders_stratified_sample(spark, folder):
    """Fifty orders of each status and each unknown one, by the digests of their ids."""
    return sampling.stratified_sample(src.gappy_orders(spark, folder), ["order_status"], ["order_id"], 50, seed=7)


# Stored sketches

SKETCH_SIZE = 9  # small, so that the samples' counts are estimated
SHARES = (0.1, 0.5, 0.99)


def _year(date: str) -> Column:
    return F.year(date).alias("year")


def _sketched_days(spark: SparkSession, folder: str, sketch: sketches.Sketch) -> sketches.SketchTable:
    """Sketches of days and statuses of orders in two batches, so that days have late rows; the first is added twice."""
    table = sketches.SketchTable(spark, scratch_path(spark, "sketches"), ["order_date", "order_status"], {"sketch": sketch})
    rows, late = src.orders(spark, folder), F.col("order_id") % 2 == 1
    for batch, chosen in (("first", ~late), ("second", late), ("first", ~late)):
        table.add(rows.where(chosen), batch)
    return table


@query
def sketched_users(spark, folder):
    """Users by year and status from sketches of days: their exact number, and whether the estimate keeps its bound."""
    sketch = sketches.distinct(F.col("user_id"), SKETCH_SIZE)
    found = _sketched_days(spark, folder, sketch).roll_up([_year("order_date"), "order_status"])
    exact = src.orders(spark, folder).groupBy(_year("order_date"), "order_status").agg(F.countDistinct("user_id").alias("users"))
    within = F.abs(sketches.distinct_estimate(F.col("sketch")) - F.col("users")) <= sketch.bound * F.col("users")
    return exact.join(found, ["year", "order_status"]).select("year", "order_status", "users", within.alias("within"))


@query
def sketched_returning_users(spark, folder):
    """Users with an order of a status in one year and in the next, from sketches of days, with the same check."""
    sketch = sketches.distinct_set(F.col("user_id"), SKETCH_SIZE)
    found = _sketched_days(spark, folder, sketch).roll_up([_year("order_date"), "order_status"])
    later = found.select((F.col("year") - 1).alias("year"), "order_status", F.col("sketch").alias("later"))
    both = sketches.overlap_estimate(F.col("sketch"), F.col("later")).alias("both")
    together = sketches.set_estimate(F.theta_union("sketch", "later", SKETCH_SIZE)).alias("together")
    estimated = found.join(later, ["year", "order_status"]).select("year", "order_status", both, together)

    years = src.orders(spark, folder).select(_year("order_date"), "order_status", "user_id").distinct()
    next_years = years.select((F.col("year") - 1).alias("year"), "order_status", "user_id")
    exact = years.join(next_years, ["year", "order_status", "user_id"]).groupBy("year", "order_status")
    within = F.abs(F.col("both") - F.col("returning_users")) <= sketch.bound * F.col("together")
    counted = exact.agg(F.count(F.lit(1)).alias("returning_users")).join(estimated, ["year", "order_status"])
    return counted.select("year", "order_status", "returning_users", within.alias("within"))


@query
def sketched_quantiles(spark, folder):
    """Amounts at three ranks by year from sketches of days: whether each has its rank, as far as the bound says."""
    sketch = sketches.quantiles(F.col("total_amount"))
    found = _sketched_days(spark, folder, sketch).roll_up([_year("order_date")])
    points = [
        F.struct(F.lit(share).alias("share"), sketches.quantile_estimate(F.col("sketch"), share).alias("point"))
        for share in SHARES
    ]
    found = found.select("year", F.inline(F.array(*points)))
    values = src.orders(spark, folder).select(_year("order_date"), "total_amount").join(F.broadcast(found), "year")
    value, point, n = F.col("total_amount"), F.col("point"), F.count("total_amount")
    below, up_to = F.count_if(value < point) / n, F.count_if(value <= point) / n
    within = (below <= F.col("share") + sketch.bound) & (up_to >= F.col("share") - sketch.bound)
    return values.groupBy("year", "share").agg(n.alias("amounts"), within.alias("within"))


# Bucketed tables


def _bucketed(spark: SparkSession, folder: str) -> tuple[buckets.BucketedTable, buckets.BucketedTable]:
    """Order lines and orders in sixteen buckets; large lines belong to order 1, and the largest to an unknown one."""
    order = F.when(F.col("quantity") > 45, F.lit(None)).when(F.col("quantity") > 30, F.lit(1)).otherwise(F.col("order_id"))
    lines = src.order_items(spark, folder).select("order_item_id", order.cast("bigint").alias("order_id"), "quantity")
    orders = src.orders(spark, folder).select("order_id", "order_status", "total_amount")
    stored_lines = buckets.write_bucketed(lines, scratch_path(spark, "lines"), ["order_id"], buckets=16)
    return stored_lines, buckets.write_bucketed(orders, scratch_path(spark, "orders"), like=stored_lines)


@query
def bucketed_join(spark, folder):
    """Order lines, a third of them of one order, with status and amount of their orders."""
    return buckets.join_bucketed(*_bucketed(spark, folder), "left")


@query
def bucketed_totals(spark, folder):
    """Lines and quantity by order; the parts of hot orders are merged at the end."""
    measures = {"lines": F.count(F.lit(1)), "sold": F.sum("quantity")}
    parts = buckets.totals_bucketed(_bucketed(spark, folder)[0], measures)
    return parts.groupBy("order_id").agg(F.sum("lines").alias("lines"), F.sum("sold").alias("sold"))


# Table sets that change together


@query
def table_releases(spark, folder):
    """Rows and amounts of two tables in each of two releases, the second with new orders and without the lines of others."""
    releases = Releases(spark, scratch_path(spark, "releases"))
    orders = src.orders(spark, folder)
    lines, users = src.order_items(spark, folder), src.users(spark, folder)
    releases.publish({"orders": orders, "order_items": lines, "users": users})
    large = releases.read(["orders"])["orders"].where("total_amount >= 150000")
    theirs = releases.read(["order_items"])["order_items"].join(large.select("order_id"), "order_id", "left_semi")
    releases.publish({"orders": large, "order_items": theirs})
    counted = [
        df.agg(F.lit(number).alias("release"), F.lit(name).alias("name"), F.count(F.lit(1)).alias("n"))
        for number in releases.numbers()
        for name, df in releases.read(number=number).items()
    ]
    return reduce(DataFrame.unionByName, counted)
