"""Analytical tables against brute force over the rows of ``conftest.py``."""

import datetime
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from random import Random

import pytest
from pyspark.sql import Row, functions as F
from pyspark.testing import assertDataFrameEqual

from tests.conftest import CITIES, DAYS, ITEM_PRICES, ITEM_ROWS, ORDER_ROWS
from tillhouse.operators import kpis, loyalty, sales
from tillhouse.operators import orders as order_values
from tillhouse.operators import products as rankings
from tillhouse.operators import users as per_user

HOURS = datetime.timedelta(hours=1)
DAY = 24 * HOURS


def same(actual, rows, schema, spark):
    assertDataFrameEqual(actual, spark.createDataFrame(rows, schema), checkRowOrder=False, rtol=0, atol=0)


def cents(value):
    return float(Decimal(value).quantize(Decimal("0.01"), ROUND_HALF_UP))


def sums(pairs):
    total = defaultdict(Decimal)
    for key, amount in pairs:
        total[key] += Decimal(amount)
    return total


def ranked(rows, *best):
    """Rank of each row's first field: larger ``best`` first, then by that field."""
    order = sorted(rows, key=lambda row: (*(-row[k] for k in best), row[0]))
    return {row[0]: rank for rank, row in enumerate(order, start=1)}


SPENT = sums((row[1], row[3]) for row in ORDER_ROWS)
TOTAL = sum(SPENT.values())
TOP_SHARE = cents(sum(sorted(SPENT.values())[-(len(SPENT) // 10) :]) / TOTAL * 100)
PRODUCTS_OF = defaultdict(set)
for _, order, product, *_ in ITEM_ROWS:
    PRODUCTS_OF[order].add(product)
BIG_ORDERS = sum(len(products) > 1 for products in PRODUCTS_OF.values())


def test_total_revenue(orders):
    assert sales.total_revenue(orders).collect() == [Row(total_system_revenue=float(TOTAL))]


def test_daily_sales(spark, orders):
    revenue, count = sums((row[2], row[3]) for row in ORDER_ROWS), sums((row[2], 1) for row in ORDER_ROWS)
    ranks = ranked(list(revenue.items()), 1)
    rows, before = [], None
    for at in sorted(revenue):
        mean = Decimal(str(cents(revenue[at] / count[at])))
        change = None if before is None else mean - before
        rate = None if before is None else cents(change / before * 100)
        change = None if change is None else float(change)
        rows.append((at.date(), float(revenue[at]), float(mean), int(count[at]), ranks[at], ranks[at] <= 5, change, rate))
        before = mean
    same(
        sales.daily_sales(orders),
        rows,
        "order_day date, daily_revenue double, avg_total_amount double, order_count bigint, revenue_ranking int, "
        "is_in_top_5 boolean, avg_total_amount_change double, pct_change_rate double",
        spark,
    )


def test_daily_sales_ties_gaps_and_zero_means(spark):
    schema = "order_id string, order_date timestamp, total_amount double"
    orders = spark.createDataFrame(
        [
            ("a", DAYS[1], 0.0),
            ("b", DAYS[2], 10.005),
            ("c", DAYS[3], 10.0),
            (None, DAYS[3], None),
            ("d", None, 5.0),
        ],
        schema,
    )
    rows = {row.order_day: row for row in sales.daily_sales(orders).collect()}
    assert rows[None].avg_total_amount_change is None
    first, second, third = (rows[DAYS[n].date()] for n in (1, 2, 3))
    assert (first.avg_total_amount_change, first.pct_change_rate) == (-5.0, -100.0)
    assert second.pct_change_rate is None
    assert (third.daily_revenue, third.avg_total_amount, third.order_count) == (10.0, 10.0, 1)
    assert second.revenue_ranking < third.revenue_ranking


def test_amounts_with_more_decimals_are_rounded_after_adding(spark):
    rows = [("a", "U1", DAYS[1], 0.0049), ("b", "U1", DAYS[1], 0.0049)]
    orders = spark.createDataFrame(rows, "order_id string, user_id string, order_date timestamp, total_amount double")
    assert sales.daily_sales(orders).first().daily_revenue == 0.01
    assert sales.total_revenue(orders).first()[0] == 0.01
    assert per_user.revenue_per_user(per_user.user_totals(orders)).first().revenue_per_user == 0.01


def test_only_five_days_are_marked(spark):
    rows = [(str(n), datetime.datetime(2026, 1, n), 7.0) for n in range(1, 9)]
    orders = spark.createDataFrame(rows, "order_id string, order_date timestamp, total_amount double")
    marked = sales.daily_sales(orders).where("is_in_top_5").collect()
    assert sorted(row.order_day.day for row in marked) == [1, 2, 3, 4, 5]


def test_city_sales(spark, orders, users):
    revenue = per_user.revenue_per_user(per_user.user_totals(orders))
    spent, buyers = sums((CITIES[u], a) for u, a in SPENT.items()), sums((CITIES[u], 1) for u in SPENT)
    rows = [(city, spent[city], int(buyers[city])) for city in spent]
    by_revenue, by_users = ranked(rows, 1), ranked(rows, 2)
    same(
        per_user.city_sales(revenue, users),
        [(city, float(sum_), n, cents(sum_ / n), by_revenue[city], by_users[city]) for city, sum_, n in rows],
        "city string, revenue_per_city double, users_count bigint, avg_per_user double, "
        "revenue_per_city_ranking int, users_count_ranking int",
        spark,
    )


@pytest.mark.parametrize("users", [10, 57, 40_000])
def test_top_users_share_equals_a_ranking(spark, users):
    """Some amounts are shared by many users, also at the boundary of the top tenth, and some are unknown."""
    generator = Random(users)
    values = [generator.choice([None, 5.25, 80.0, 80.0, generator.randrange(10_000) / 100]) for _ in range(users)]
    best = sorted((Decimal(str(v)) for v in values if v is not None), reverse=True)
    expected = sum(best[: users // 10]) * 100 / sum(best)
    revenue = spark.createDataFrame([(n, v) for n, v in enumerate(values)], "user_id int, revenue_per_user double")
    assert per_user.top_users_share(revenue.repartition(5)).first()[0] == float(expected.quantize(Decimal("0.01"), ROUND_HALF_UP))
    unknown = revenue.withColumn("revenue_per_user", F.lit(None).cast("double"))
    assert per_user.top_users_share(unknown).first()[0] is None


def test_top_users_share(spark, orders):
    revenue = per_user.revenue_per_user(per_user.user_totals(orders))
    top = sum(sorted(SPENT.values())[-(len(SPENT) // 10) :])
    assert per_user.top_users_share(revenue, float(top * 4)).first()[0] == 25.0
    assert per_user.top_users_share(revenue).first()[0] == TOP_SHARE
    assert per_user.top_users_share(revenue, 0.0).first()[0] is None
    assert per_user.top_users_share(revenue.limit(9)).first()[0] == 0.0
    assert per_user.top_users_share(revenue.limit(0)).first()[0] == 0.0


def test_customer_metrics(spark, orders):
    totals = per_user.user_totals(orders)
    amounts = {user: [r[3] for r in ORDER_ROWS if r[1] == user] for user in CITIES}
    same(
        per_user.customer_metrics(totals, high_above=150, medium_above=80),
        [
            (u, sum(a), len(a), "high" if sum(a) > 150 else "medium" if sum(a) > 80 else "low", len(a) > 1)
            for u, a in amounts.items()
            if a
        ],
        "user_id string, summed_amount double, orders_count bigint, spent_segment string, more_than_1_order boolean",
        spark,
    )
    assert {row.spent_segment for row in per_user.customer_metrics(totals).collect()} == {"low"}
    assert per_user.active_users(totals).first()[0] == len(SPENT)
    assert per_user.avg_orders_per_user(totals).first()[0] == cents(Decimal(len(ORDER_ROWS)) / len(SPENT))


def test_orders_without_user_or_amount(spark):
    orders = spark.createDataFrame(
        [("a", None, DAYS[1], 6000.0), ("b", None, DAYS[1], None), ("c", "U1", DAYS[1], None)],
        "order_id string, user_id string, order_date timestamp, total_amount double",
    )
    totals = per_user.user_totals(orders)
    rows = {row.user_id: row for row in per_user.customer_metrics(totals).collect()}
    assert (rows[None].summed_amount, rows[None].orders_count, rows[None].spent_segment) == (6000.0, 2, "high")
    assert (rows["U1"].summed_amount, rows["U1"].spent_segment) == (None, "low")
    assert per_user.active_users(totals).first()[0] == 1
    assert per_user.avg_orders_per_user(totals).first()[0] == 1.5


def test_product_sales(spark, order_items):
    sold = sums((row[2], row[4]) for row in ITEM_ROWS)
    earned = sums((row[2], price * row[4]) for row, price in zip(ITEM_ROWS, ITEM_PRICES))
    rows = [(product, int(sold[product]), earned[product]) for product in sold]
    by_count, by_revenue = ranked(rows, 1), ranked(rows, 2)
    same(
        rankings.product_sales(order_items),
        [(p, n, float(amount), by_count[p], by_revenue[p]) for p, n, amount in rows],
        "product_id string, sold_count bigint, summary_revenue double, sold_count_ranking int, top_revenue_ranking int",
        spark,
    )


def test_top_products_per_city(spark, order_items, users):
    schema = "product_id string, city string, ordered_quantity bigint, product_per_city_ranking int"
    rows = []
    for city in sorted(set(CITIES.values())):
        ordered = sums((row[2], row[4]) for row in ITEM_ROWS if CITIES[row[3]] == city)
        ranks = ranked(list(ordered.items()), 1)
        rows += [(product, city, int(n), ranks[product]) for product, n in ordered.items()]
    same(rankings.top_products_per_city(order_items, users), rows, schema, spark)
    best = [row for row in rows if row[3] == 1]
    same(rankings.top_products_per_city(order_items, users, top=1), best, schema, spark)


def test_order_buckets(spark, orders):
    def bucket(amount):
        return next(name for top, name in ((50, "very_low"), (150, "low"), (300, "medium_low")) if amount < top)

    same(
        order_values.order_buckets(orders),
        [(row[0], row[3], bucket(row[3])) for row in ORDER_ROWS],
        "order_id string, total_amount float, bucket string",
        spark,
    )


@pytest.mark.parametrize(
    "amount, bucket",
    [
        (49.99, "very_low"),
        (50.0, "low"),
        (150.0, "medium_low"),
        (300.0, "medium"),
        (600.0, "medium_high"),
        (1000.0, "high"),
        (2000.0, "very_high"),
        (None, "very_high"),
    ],
)
def test_order_bucket_bounds(spark, amount, bucket):
    orders = spark.createDataFrame([("a", amount)], "order_id string, total_amount double")
    assert order_values.order_buckets(orders).first().bucket == bucket
    if amount is None:
        assert order_values.order_buckets(orders, null_label="none").first().bucket == "none"


def test_multi_product_share(orders, order_items):
    assert order_values.multi_product_orders(order_items).first()[0] == BIG_ORDERS > 1
    assert order_values.multi_product_share(orders, order_items).first()[0] == cents(Decimal(BIG_ORDERS * 100) / len(ORDER_ROWS))
    assert order_values.multi_product_share(orders.limit(0), order_items).first()[0] == 0.0


LOYALTY = (
    "user_id string, order_id string, order_date timestamp, total_amount float, orders_count bigint, "
    "user_total_amount double, prev_order_date timestamp, orders_interval interval day to second, "
    "avg_interval interval day to second, loyalty_ranking int"
)


def nulls_first(*values):
    return tuple((value is not None, value if value is not None else 0) for value in values)


def expected_loyalty(rows):
    """Brute force over ``(order_id, user_id, order_date, total_amount)``."""
    groups = {}
    for row in rows:
        groups.setdefault(row[1], []).append(row)
    result, keys = [], {}
    for user, group in groups.items():
        group.sort(key=lambda r: nulls_first(r[2], r[0], r[3]))
        dates = [None, *[r[2] for r in group[:-1]]]
        steps = [r[2] - before if r[2] and before else None for r, before in zip(group, dates, strict=True)]
        known = [step for step in steps if step is not None]
        mean = sum(known, 0 * DAY) / len(known) if known else None
        count = sum(r[0] is not None for r in group)
        keys[user] = (-count, (mean is not None, mean or 0 * DAY))
        total = sum(r[3] for r in group)
        result += [
            (user, r[0], r[2], r[3], count, total, before, step, mean)
            for r, before, step in zip(group, dates, steps, strict=True)
        ]
    ranks = {key: rank for rank, key in enumerate(sorted(set(keys.values())), start=1)}
    return [(*row, ranks[keys[row[0]]]) for row in result]


def test_customer_loyalty(spark, orders):
    expected = expected_loyalty(ORDER_ROWS)
    assert len({row[9] for row in expected}) > 2 and any(row[7] for row in expected)
    same(loyalty.customer_loyalty(orders), expected, LOYALTY, spark)


@pytest.mark.parametrize("min_large_group", [0, 2, 1_000_000])
def test_large_groups_and_orders_without_user_or_date(spark, min_large_group):
    """The path for large groups gives the same result as the one for small groups."""
    rows = [
        (
            f"O{n:03d}",
            None if n % 7 == 0 else f"U{n % 5}",
            None if n % 11 == 0 else DAYS[1] + (n % 13) * 17 * HOURS / 60 + (n % 3) * datetime.timedelta(seconds=9),
            float(n),
        )
        for n in range(120)
    ]
    orders = spark.createDataFrame(rows, "order_id string, user_id string, order_date timestamp, total_amount float")
    actual = loyalty.customer_loyalty(orders, min_large_group=min_large_group)
    same(actual, expected_loyalty(rows), LOYALTY, spark)


@pytest.mark.parametrize("seed", range(4))
def test_group_size_does_not_change_previous_dates(spark, seed):
    """Orders without id, with repeated ids, at equal instants, without date, and repeated rows, on both paths."""
    random = Random(seed)
    rows = [
        (
            random.choice([None, "a", "b", f"c{n % 9}", f"d{n}"]),
            random.choice([None, "U1", "U2", f"V{n % 6}"]),
            random.choice([None, DAYS[1], DAYS[2], DAYS[2] + random.randrange(200) * datetime.timedelta(seconds=1)]),
            float(random.randrange(1, 4)),
        )
        for n in range(150)
    ]
    rows += rows[:40]
    schema = "order_id string, user_id string, order_date timestamp, total_amount float"
    orders = spark.createDataFrame(rows, schema).repartition(3)
    small = loyalty.previous_dates(orders).select("order_id", "user_id", "order_date", "total_amount", "prev_order_date")
    large = loyalty.previous_dates_of_large_groups(orders).select(*small.columns)
    assertDataFrameEqual(large, small, checkRowOrder=False)


def test_run_kpis(orders, order_items):
    as_of = datetime.datetime(2026, 8, 1)
    record = kpis.run_kpis(orders, order_items, batch_id="b", as_of=as_of).collect()
    assert record == [
        Row(
            timestamp=as_of,
            batch_id="b",
            share_top_users_in_total_revenue=TOP_SHARE,
            active_users_count=len(SPENT),
            avg_orders_count_per_user=cents(Decimal(len(ORDER_ROWS)) / len(SPENT)),
            big_orders_share=cents(Decimal(BIG_ORDERS * 100) / len(ORDER_ROWS)),
        )
    ]


def test_run_kpis_without_data(orders, order_items):
    record = kpis.run_kpis(orders.limit(0), order_items.limit(0)).first()
    assert record.share_top_users_in_total_revenue == 0.0
    assert record.active_users_count == 0
    assert record.avg_orders_count_per_user is None
    assert record.big_orders_share == 0.0
