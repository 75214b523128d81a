"""The results of ``queries.py`` in SQL, for checking.

Amounts are added as exact decimals and rounded half away from zero after that; ties are ordered as in the engine.
"""

from __future__ import annotations

from tillhouse.operators import orders as order_values
from tillhouse.plans import policies
from tillhouse.workload.queries import AS_OF, BATCH, BUCKETS, ENUMS, HIGH_ABOVE, MEDIUM_ABOVE, PAST_LIMIT, SHARES
from tillhouse.workload.tables import (
    EVENTS,
    FINE_ORDER_ITEMS,
    FINE_ORDERS,
    GAPPY_ORDERS,
    ORDER_ITEMS,
    ORDERS,
    PRODUCTS,
    REVIEWS,
    SOURCES,
    USERS,
)


def cents(amount: str) -> str:
    return f"CAST(round({amount} * 100) AS BIGINT)"


def half_up(numerator: str, denominator: str) -> str:
    magnitude = f"((2 * abs({numerator}) + ({denominator})) // (2 * nullif({denominator}, 0)))"
    return f"CAST(CASE WHEN ({numerator}) < 0 THEN -{magnitude} ELSE {magnitude} END AS BIGINT)"


def money(cents_: str) -> str:
    return f"(CAST({cents_} AS DOUBLE) / 100)"


def units(column: str) -> str:
    """The exact sum in millionths."""
    return f"sum(CAST(CAST({column} AS DECIMAL(18, 6)) * 1000000 AS HUGEINT))"


def rounded_total(column: str) -> str:
    """The exact sum, rounded to cents."""
    return half_up(units(column), "10000")


def percent(part: str, whole: str) -> str:
    return money(half_up(f"(CAST({part} AS HUGEINT) * 10000)", whole))


def total(column: str) -> str:
    return f"CAST(sum({column}) AS BIGINT)"


def timestamp(value) -> str:
    return f"TIMESTAMP '{value}'"


def values(names) -> str:
    return ", ".join(f"'{name}'" for name in names)


def text(column: str, kind: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')" if kind == "timestamp" else f"CAST({column} AS VARCHAR)"


def as_text(name: str) -> str:
    """A raw table with the strings of its CSV export."""
    types = policies.CASTS[name]
    columns = ", ".join(f"{text(c, types.get(c, ''))} AS {c}" for c in policies.COLUMNS[name])
    return f"SELECT {columns} FROM ({SOURCES[name][1]})"


def totals(orders: str) -> str:
    return f"""
        SELECT user_id, count(*) AS order_rows, count(order_id) AS orders_count,
               {rounded_total('total_amount')} AS amount, count(order_date) AS dated,
               min(order_date) AS first_date, max(order_date) AS last_date
        FROM ({orders}) GROUP BY user_id
    """


def daily(orders: str) -> str:
    return f"""
        WITH days AS (
            SELECT CAST(order_date AS DATE) AS order_day, {rounded_total('total_amount')} AS amount,
                   {units('total_amount')} AS units,
                   count(total_amount) AS amounts, count(order_id) AS order_count
            FROM ({orders}) GROUP BY 1
        ), means AS (
            SELECT *, {half_up('units', '(amounts * 10000)')} AS mean FROM days
        ), changes AS (
            SELECT *, row_number() OVER (ORDER BY amount DESC NULLS LAST, order_day NULLS FIRST) AS revenue_ranking,
                   lag(mean) OVER (ORDER BY order_day NULLS FIRST) AS before
            FROM means
        )
        SELECT order_day, {money('amount')} AS daily_revenue, {money('mean')} AS avg_total_amount, order_count,
               revenue_ranking, revenue_ranking <= 5 AS is_in_top_5,
               {money('mean - before')} AS avg_total_amount_change,
               {percent('(mean - before)', 'before')} AS pct_change_rate
        FROM changes
    """


def city(orders: str, users: str = USERS) -> str:
    return f"""
        WITH cities AS (
            SELECT city, {total('amount')} AS revenue, count(user_id) AS users_count, count(amount) AS amounts
            FROM ({totals(orders)}) JOIN ({users}) USING (user_id) GROUP BY city
        )
        SELECT city, {money('revenue')} AS revenue_per_city, users_count,
               {money(half_up('revenue', 'amounts'))} AS avg_per_user,
               row_number() OVER (ORDER BY revenue DESC NULLS LAST, city NULLS FIRST) AS revenue_per_city_ranking,
               row_number() OVER (ORDER BY users_count DESC, city NULLS FIRST) AS users_count_ranking
        FROM cities
    """


def share(orders: str) -> str:
    """The expression of the top tenth's share over ``totals``."""
    return f"""(
        SELECT CASE WHEN count(*) < 10 THEN 0.0
                    ELSE {percent('sum(CASE WHEN place <= users // 10 THEN amount END)', 'sum(amount)')} END
        FROM (SELECT amount, row_number() OVER (ORDER BY amount DESC NULLS LAST) AS place, count(*) OVER () AS users
              FROM ({totals(orders)}))
    )"""


def segments(orders: str, high: float, medium: float) -> str:
    return f"""
        SELECT user_id, {money('amount')} AS summed_amount, orders_count,
               CASE WHEN amount > {high * 100} THEN 'high' WHEN amount > {medium * 100} THEN 'medium' ELSE 'low' END
                   AS spent_segment,
               orders_count > 1 AS more_than_1_order
        FROM ({totals(orders)})
    """


def product_sales(items: str) -> str:
    return f"""
        WITH sold AS (
            SELECT product_id, {total('quantity')} AS sold_count, {rounded_total('item_total')} AS amount
            FROM ({items}) GROUP BY product_id
        )
        SELECT product_id, sold_count, {money('amount')} AS summary_revenue,
               row_number() OVER (ORDER BY sold_count DESC, product_id) AS sold_count_ranking,
               row_number() OVER (ORDER BY amount DESC, product_id) AS top_revenue_ranking
        FROM sold
    """


def top_products(items: str, users: str = USERS) -> str:
    return f"""
        SELECT product_id, city, {total('quantity')} AS ordered_quantity,
               row_number() OVER (PARTITION BY city ORDER BY sum(quantity) DESC, product_id)
                   AS product_per_city_ranking
        FROM ({items}) i JOIN ({users}) u USING (user_id)
        GROUP BY product_id, city
        QUALIFY product_per_city_ranking <= 10
    """


def buckets(orders: str, bounds) -> str:
    cases = " ".join(f"WHEN total_amount < {bound} THEN '{label}'" for bound, label in bounds)
    return f"SELECT order_id, total_amount, CASE {cases} ELSE 'very_high' END AS bucket FROM ({orders})"


def multi_share(orders: str, items: str) -> str:
    """The expression of the share of orders with several products."""
    return f"""(
        SELECT CASE WHEN (SELECT count(*) FROM ({orders})) = 0 THEN 0.0
                    ELSE {percent('count(*)', f'(SELECT count(*) FROM ({orders}))')} END
        FROM (SELECT order_id FROM ({items}) GROUP BY order_id HAVING count(DISTINCT product_id) > 1)
    )"""


def loyalty(orders: str) -> str:
    return f"""
        WITH o AS ({orders}), t AS (
            SELECT *, CASE WHEN dated > 1 THEN
                {half_up('(epoch_us(last_date) - epoch_us(first_date))', '(dated - 1)')} END AS avg_interval_us
            FROM ({totals('SELECT * FROM o')})
        ), r AS (
            SELECT *, dense_rank() OVER (ORDER BY orders_count DESC, avg_interval_us NULLS FIRST) AS loyalty_ranking
            FROM t
        ), p AS (
            SELECT *, lag(order_date) OVER (PARTITION BY user_id ORDER BY order_date NULLS FIRST, order_id)
                          AS prev_order_date
            FROM o
        )
        SELECT p.user_id, p.order_id, p.order_date, p.total_amount, r.orders_count,
               {money('r.amount')} AS user_total_amount, p.prev_order_date, r.loyalty_ranking,
               epoch_us(p.order_date) - epoch_us(p.prev_order_date) AS orders_interval_us, r.avg_interval_us
        FROM p JOIN r ON p.user_id IS NOT DISTINCT FROM r.user_id
    """


def kpis(orders: str, items: str) -> str:
    return f"""
        SELECT '{BATCH}' AS batch_id, {share(orders)} AS share_top_users_in_total_revenue,
               count(user_id) AS active_users_count,
               {money(half_up('sum(orders_count) * 100', 'count(*)'))} AS avg_orders_count_per_user,
               {multi_share(orders, items)} AS big_orders_share
        FROM ({totals(orders)})
    """


FLAGGED = ("user_id", "order_date", "total_amount")  # columns of orders whose nulls are flagged


def missing(columns) -> str:
    names = ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in columns)
    return f"nullif(concat_ws(', ', {names}), '')"


COMPLETE_ORDERS = f"""
    SELECT order_id, user_id, order_date, coalesce(order_status, 'unknown') AS order_status, total_amount,
           {missing(FLAGGED)} AS missing_values
    FROM ({GAPPY_ORDERS}) WHERE order_id IS NOT NULL
"""


def sound(predicate: str) -> str:
    return f"coalesce({predicate}, false)"


def found(column: str, parent: str) -> str:
    return f"({column} IS NOT NULL AND {column} IN (SELECT {column} FROM ({parent}) WHERE {column} IS NOT NULL))"


def null_cells(name: str, table: str, columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_count, "
        f"count(*) AS row_count FROM ({table})"
        for c in columns
    )


LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_ORDER = (
    "l_discount",
    "l_extendedprice",
    "l_linestatus",
    "l_partkey",
    "l_quantity",
    "l_returnflag",
    "l_shipdate",
    "l_suppkey",
    "l_tax",
)


def ranked_lines(condition: str) -> str:
    return f"""
        SELECT * EXCLUDE (place) FROM (
            SELECT *, row_number() OVER (PARTITION BY {', '.join(LINE_KEYS)} ORDER BY {', '.join(LINE_ORDER)}) AS place
            FROM lineitem
        ) WHERE {condition}
    """


def survivors(table: str, key: str, columns) -> str:
    """Rows of a raw table that de-duplication keeps; ids are compared as the strings they are in the pipeline."""
    typed = policies.CASTS.get(table, {})
    order = [c if c in typed else f"CAST({c} AS VARCHAR)" for c in sorted(columns) if c != key]
    score = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in columns)
    nulls_last = ", ".join(f"{c} NULLS LAST" for c in order)
    return f"row_number() OVER (PARTITION BY {key} ORDER BY {score} DESC, {nulls_last})"


def silver_summary() -> str:
    complete = {
        "events": EVENTS,
        "order_items": ORDER_ITEMS,
        "orders": COMPLETE_ORDERS,
        "products": PRODUCTS,
        "reviews": f"SELECT * REPLACE (coalesce(review_text, '') AS review_text) FROM ({REVIEWS})",
        "users": USERS,
    }
    past = timestamp(AS_OF)
    user, product = found("user_id", USERS), found("product_id", PRODUCTS)
    order = found("order_id", COMPLETE_ORDERS)
    rules = {
        "events": [user, product, f"event_type IN ({values(ENUMS['event_type'])})", f"event_timestamp < {past}"],
        "order_items": [order, product, user, "quantity > 0", "item_price > 0", "item_total > 0"],
        "orders": [
            user,
            f"order_date < {past}",
            f"order_status IN ({values(ENUMS['order_status'])})",
            "total_amount > 0",
        ],
        "products": [f"category IN ({values(ENUMS['category'])})", "price > 0", "rating > 0"],
        "reviews": [order, product, user, "rating > 0", f"review_date < {past}"],
        "users": [f"gender IN ({values(ENUMS['gender'])})", f"signup_date < {past}"],
    }

    def summary(name: str) -> str:
        key = policies.KEYS[name][0]
        correct = " AND ".join(sound(rule) for rule in rules[name])
        gappy = "missing_values IS NOT NULL" if name == "orders" else "false"
        return f"""
            SELECT '{name}' AS table_name, count(*) FILTER (place = 1) AS kept,
                   count(*) FILTER (place = 1 AND correct) AS sound, count(*) FILTER (place = 1 AND gappy) AS gappy,
                   count(*) FILTER (place > 1) AS rejected
            FROM (SELECT {survivors(name, key, policies.COLUMNS[name])} AS place, {correct} AS correct,
                         {gappy} AS gappy
                  FROM ({complete[name]}))
        """

    return " UNION ALL ".join(summary(name) for name in policies.TABLES)


def bronze_summary() -> str:
    def summary(name: str) -> str:
        columns = policies.COLUMNS[name]
        cells = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in columns)
        return f"""
            SELECT '{name}' AS table_name, '{BATCH}' AS batch_id, {timestamp(AS_OF)} AS ingestion_time,
                   count(*) AS row_count, {total(cells)} AS cell_count,
                   {total(f"length(concat_ws('|', {', '.join(columns)}))")} AS text_length
            FROM ({as_text(name)})
        """

    return " UNION ALL ".join(summary(name) for name in policies.TABLES)


def with_text_ids(table: str) -> str:
    """Ids as the strings they are in clean tables, which matters for the order of ties."""
    columns = policies.COLUMNS[table]
    ids = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in columns if c.endswith("_id"))
    return f"SELECT * REPLACE ({ids}) FROM ({SOURCES[table][1]})"


def gold_summary() -> str:
    orders, items, users = with_text_ids("orders"), with_text_ids("order_items"), with_text_ids("users")
    tables = {
        "sales_and_revenues": (daily(orders), cents("daily_revenue")),
        "geography": (city(orders, users), cents("avg_per_user")),
        "customer_metrics": (segments(orders, 5000, 2000), "orders_count"),
        "products": (product_sales(items), "top_revenue_ranking * sold_count"),
        "orders": (orders, cents("total_amount")),
        "customers_loyalty": (loyalty(orders), "loyalty_ranking"),
        "top_products_per_city": (top_products(items, users), "product_per_city_ranking * ordered_quantity"),
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, {total(amount)} AS total FROM ({sql})"
        for name, (sql, amount) in tables.items()
    )


def kept_items() -> str:
    """Order items after the pipeline's de-duplication, with orders as they are after null handling."""
    place = survivors("order_items", "order_item_id", policies.COLUMNS["order_items"])
    return f"SELECT * FROM ({ORDER_ITEMS}) QUALIFY {place} = 1"


def with_int(sql: str, *ranks: str) -> str:
    """Ranks as the jobs write them."""
    return f"SELECT * REPLACE ({', '.join(f'CAST({rank} AS INTEGER) AS {rank}' for rank in ranks)}) FROM ({sql})"


STAMP = f"'{BATCH}' AS batch_id, {timestamp(AS_OF)} AS ingestion_time"


def silver_orders() -> str:
    place = survivors("orders", "order_id", policies.COLUMNS["orders"])
    return f"""
        SELECT *, df_users_ref AND correct_order_date AND correct_order_status AND correct_total_amount
                      AS business_overall_correct
        FROM (SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id), {STAMP},
                     {found('user_id', USERS)} AS df_users_ref,
                     {sound(f'order_date < {timestamp(AS_OF)}')} AS correct_order_date,
                     {sound(f"order_status IN ({values(ENUMS['order_status'])})")} AS correct_order_status,
                     {sound('total_amount > 0')} AS correct_total_amount
              FROM (SELECT * FROM ({COMPLETE_ORDERS}) QUALIFY {place} = 1))
    """


def rejected_items() -> str:
    place = survivors("order_items", "order_item_id", policies.COLUMNS["order_items"])
    ids = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ("order_id", "product_id", "user_id"))
    return f"SELECT * REPLACE ({ids}), {STAMP} FROM (SELECT * FROM ({ORDER_ITEMS}) QUALIFY {place} > 1)"


def expected_schema_rows() -> str:
    return """
        SELECT v.*, c.row_count FROM (VALUES
            ('orders', 'total_amount', 'string', 'double'),
            ('orders', 'coupon', 'string', NULL),
            ('shops', '*', 'table', NULL)
        ) v(table_name, column_name, expected_type, actual_type)
        LEFT JOIN (SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
                   UNION ALL SELECT 'products', count(*) FROM part) c USING (table_name)
    """


FIRST_ORDERS = f"""
    SELECT order_id, user_id, order_status, total_amount, 1 AS revision FROM ({ORDERS})
    WHERE order_date < TIMESTAMP '2000-01-01'
"""
MERGED_ORDERS = f"""
    SELECT order_id, user_id, CASE WHEN changed THEN 'X' ELSE order_status END AS order_status, total_amount,
           CASE WHEN changed THEN 2 ELSE 1 END AS revision
    FROM (SELECT *, order_date >= TIMESTAMP '2000-01-01' OR order_status = 'P' AS changed FROM ({ORDERS}))
    WHERE total_amount >= 20000
"""


def as_of_orders(comparison: str) -> str:
    return f"""
    SELECT review_id, r.user_id, review_date, o.last_order, o.total_amount
    FROM ({REVIEWS}) r ASOF LEFT JOIN (
        SELECT user_id, order_date, max(order_id) AS last_order, arg_max(total_amount, order_id) AS total_amount
        FROM ({ORDERS}) GROUP BY ALL
    ) o ON r.user_id = o.user_id AND r.review_date {comparison} o.order_date
    """


EVENT_WINDOWS = f"""
    SELECT make_timestamp(w * 21600000000) AS window_start, make_timestamp((w + 2) * 21600000000) AS window_end, event_type,
           count(*) AS event_count, min(event_id) AS first_event, max(event_id) AS last_event
    FROM (SELECT *, unnest([epoch_us(event_timestamp) // 21600000000 - 1, epoch_us(event_timestamp) // 21600000000]) AS w
          FROM ({EVENTS}))
    GROUP BY ALL
"""
EVENT_SESSIONS = f"""
    SELECT min(event_timestamp) AS session_start, max(event_timestamp) + INTERVAL 8 HOUR AS session_end, user_id,
           count(*) AS events
    FROM (
        SELECT *, count(*) FILTER (fresh) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) AS number
        FROM (
            SELECT *, coalesce(event_timestamp - lag(event_timestamp) OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id)
                               > INTERVAL 8 HOUR, true) AS fresh
            FROM ({EVENTS})
        )
    )
    GROUP BY user_id, number
"""

SOLD = f"""
    SELECT city, category, month, quantity, item_total
    FROM ({ORDER_ITEMS}) i
    LEFT JOIN (SELECT order_id, strftime(order_date, '%Y-%m') AS month FROM ({GAPPY_ORDERS})) o ON i.order_id = o.order_id
    LEFT JOIN (SELECT user_id, city FROM ({USERS})) u ON i.user_id = u.user_id
    LEFT JOIN (SELECT product_id, category FROM ({PRODUCTS})) p ON i.product_id = p.product_id
"""


def sold_by(sets: str) -> str:
    return f"""
        SELECT city, category, month, CAST(grouping_id(city, category, month) AS BIGINT) AS grouping_id,
               count(*) AS lines, {total('quantity')} AS sold, {money(rounded_total('item_total'))} AS revenue,
               {money(half_up(units('item_total'), '(count(item_total) * 10000)'))} AS mean_revenue,
               min(item_total) AS least, max(item_total) AS most
        FROM ({SOLD}) GROUP BY {sets}
    """


LINES = "SELECT l_quantity AS quantity, nullif(l_linestatus, 'F') AS status FROM lineitem"
RETURNS = "SELECT l_quantity + 5 AS quantity, nullif(l_linestatus, 'F') AS status FROM lineitem WHERE l_returnflag = 'R'"

MERGED_LINES = f"""
    SELECT order_item_id, quantity,
           CASE WHEN quantity > 45 THEN NULL WHEN quantity > 30 THEN 1 ELSE order_id END AS order_id
    FROM ({ORDER_ITEMS})
"""

ORACLES: dict[str, str] = {
    "contract_projection": f"SELECT order_id, total_amount, user_id FROM ({as_text('orders')})",
    "typed_cast": "SELECT order_id, user_id, order_date, order_status, total_amount FROM (" + ORDERS + ")",
    "typed_cast_lenient": f"""
        SELECT order_id, CASE WHEN order_status = 'P' THEN NULL ELSE user_id END AS user_id FROM ({ORDERS})
    """,
    "schema_violations": expected_schema_rows(),
    "column_presence": "SELECT true AS has_amount, false AS has_coupon, count(*) AS row_count FROM orders",
    "nonempty_tables": """
        SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
        UNION ALL SELECT 'users', count(*) FROM customer
    """,
    "provenance_stamp": f"""
        SELECT *, '{BATCH}' AS batch_id, {timestamp(AS_OF)} AS ingestion_time FROM ({ORDERS})
    """,
    "null_profile": " UNION ALL ".join(
        [
            null_cells("orders", GAPPY_ORDERS, policies.COLUMNS["orders"]),
            null_cells("reviews", REVIEWS, policies.COLUMNS["reviews"]),
            null_cells("users", USERS, policies.COLUMNS["users"]),
        ]
    ),
    "null_counts": "SELECT "
    + ", ".join(f"count(*) - count({c}) AS {c}" for c in policies.COLUMNS["orders"])
    + f" FROM ({GAPPY_ORDERS})",
    "null_drop": f"SELECT * FROM ({GAPPY_ORDERS}) WHERE order_id IS NOT NULL AND user_id IS NOT NULL",
    "null_fill_unknown": f"""
        SELECT * REPLACE (coalesce(order_status, 'unknown') AS order_status) FROM ({GAPPY_ORDERS})
    """,
    "null_fill_empty": f"SELECT * REPLACE (coalesce(review_text, '') AS review_text) FROM ({REVIEWS})",
    "null_flagging": f"SELECT *, {missing(FLAGGED)} AS missing_values FROM ({GAPPY_ORDERS})",
    "null_policy": COMPLETE_ORDERS,
    "dedup_kept": ranked_lines("place = 1"),
    "dedup_rejected": ranked_lines("place > 1"),
    "dedup_split_kept": ranked_lines("place = 1"),
    "dedup_split_rejected": ranked_lines("place > 1"),
    "dedup_split_rejected_many_keys": ranked_lines("place > 1"),
    "dedup_by_completeness": f"""
        SELECT * FROM ({GAPPY_ORDERS})
        QUALIFY row_number() OVER (
            PARTITION BY user_id, order_status
            ORDER BY CAST(order_id IS NOT NULL AS INTEGER) + CAST(user_id IS NOT NULL AS INTEGER)
                     + CAST(order_date IS NOT NULL AS INTEGER) + CAST(order_status IS NOT NULL AS INTEGER)
                     + CAST(total_amount IS NOT NULL AS INTEGER) DESC,
                     order_date NULLS LAST, order_id NULLS LAST, total_amount NULLS LAST
        ) = 1
    """,
    **dict.fromkeys(
        ("flag_reference", "flag_reference_many_keys", "flag_reference_many_unknown"),
        f"SELECT order_id, user_id, {found('user_id', EVENTS)} AS df_events_ref FROM ({GAPPY_ORDERS})",
    ),
    "flag_enum": f"""
        SELECT order_id, order_status,
               {sound(f"order_status IN ({values(ENUMS['order_status'])})")} AS correct_order_status
        FROM ({GAPPY_ORDERS})
    """,
    "flag_past": f"""
        SELECT order_id, order_date, {sound(f'order_date < {timestamp(PAST_LIMIT)}')} AS correct_order_date
        FROM ({GAPPY_ORDERS})
    """,
    "flag_positive": "SELECT c_custkey, c_acctbal, c_acctbal > 0 AS correct_c_acctbal FROM customer",
    "business_flags": f"""
        SELECT *, df_events_ref AND correct_order_date AND correct_order_status AND correct_total_amount
                      AS business_overall_correct
        FROM (SELECT *, {found('user_id', EVENTS)} AS df_events_ref,
                     {sound(f'order_date < {timestamp(PAST_LIMIT)}')} AS correct_order_date,
                     {sound(f"order_status IN ({values(ENUMS['order_status'])})")} AS correct_order_status,
                     {sound('total_amount > 0')} AS correct_total_amount
              FROM ({GAPPY_ORDERS}))
    """,
    "total_revenue": f"SELECT {money(rounded_total("total_amount"))} AS total_system_revenue FROM ({ORDERS})",
    "daily_sales": daily(ORDERS),
    "daily_sales_with_gaps": daily(GAPPY_ORDERS),
    "revenue_per_user": f"SELECT user_id, {money('amount')} AS revenue_per_user FROM ({totals(GAPPY_ORDERS)})",
    "total_revenue_of_fractions": f"""
        SELECT {money(rounded_total("total_amount"))} AS total_system_revenue FROM ({FINE_ORDERS})
    """,
    "daily_sales_of_fractions": with_int(daily(FINE_ORDERS), "revenue_ranking"),
    "revenue_per_user_of_fractions": f"""
        SELECT user_id, {money('amount')} AS revenue_per_user FROM ({totals(FINE_ORDERS)})
    """,
    "product_sales_of_fractions": with_int(
        product_sales(FINE_ORDER_ITEMS), "sold_count_ranking", "top_revenue_ranking"
    ),
    "top_decile_share": f"SELECT {share(ORDERS)} AS share_top_users_in_total_revenue",
    "city_sales": city(ORDERS),
    "customer_metrics": segments(GAPPY_ORDERS, HIGH_ABOVE, MEDIUM_ABOVE),
    "active_users": f"SELECT count(DISTINCT user_id) AS active_users_count FROM ({GAPPY_ORDERS})",
    "avg_orders_per_user": f"""
        SELECT {money(half_up('sum(orders_count) * 100', 'count(*)'))} AS avg_orders_count
        FROM ({totals(GAPPY_ORDERS)})
    """,
    "product_sales": product_sales(ORDER_ITEMS),
    "top_products_per_city": top_products(ORDER_ITEMS),
    "order_buckets": buckets(GAPPY_ORDERS, BUCKETS),
    "multi_product_share": f"SELECT {multi_share(ORDERS, ORDER_ITEMS)} AS big_orders_share",
    "customer_loyalty": loyalty(ORDERS),
    "customer_loyalty_of_fractions": loyalty(FINE_ORDERS),
    "customer_loyalty_with_gaps": loyalty(f"SELECT * FROM ({GAPPY_ORDERS}) WHERE order_id IS NOT NULL"),
    "customer_loyalty_large_groups": loyalty(f"SELECT * FROM ({GAPPY_ORDERS}) WHERE order_id IS NOT NULL"),
    "run_kpis": f"SELECT {timestamp(AS_OF)} AS timestamp, * FROM ({kpis(ORDERS, ORDER_ITEMS)})",
    "csv_scan": as_text("orders"),
    "parquet_scan": "SELECT * FROM customer",
    "required_tables": """
        SELECT 'whole/customer.parquet' AS table_name, count(*) AS row_count FROM customer
        UNION ALL SELECT 'whole/nation.parquet', count(*) FROM nation
    """,
    "parquet_sink": GAPPY_ORDERS,
    "report_sink": buckets(ORDERS, BUCKETS),
    "metrics_history": f"""
        SELECT {money(rounded_total("total_amount"))} AS total_system_revenue, 'batch-1' AS batch_id
        FROM ({ORDERS})
        UNION ALL
        SELECT {money(rounded_total("total_amount"))}, 'batch-2' FROM ({GAPPY_ORDERS})
    """,
    "bronze_job": bronze_summary(),
    "silver_orders": silver_orders(),
    "silver_rejected_items": rejected_items(),
    "gold_customers_loyalty": with_int(loyalty(with_text_ids("orders")), "loyalty_ranking"),
    "gold_customer_metrics": segments(with_text_ids("orders"), 5000, 2000),
    "gold_orders": buckets(with_text_ids("orders"), order_values.BUCKETS),
    "gold_products": with_int(
        product_sales(with_text_ids("order_items")), "sold_count_ranking", "top_revenue_ranking"
    ),
    "silver_job": silver_summary(),
    "gold_job": gold_summary(),
    "merged_orders": MERGED_ORDERS,
    "merged_orders_before": FIRST_ORDERS,
    "merged_orders_changes": f"""
        SELECT *, 'removed' AS change FROM (({FIRST_ORDERS}) EXCEPT ({MERGED_ORDERS}))
        UNION ALL SELECT *, 'added' FROM (({MERGED_ORDERS}) EXCEPT ({FIRST_ORDERS}))
    """,
    "reviews_as_of_orders": as_of_orders(">="),
    "reviews_as_of_orders_large_users": as_of_orders(">"),
    "events_after_purchases": f"""
        SELECT v.event_id, p.event_id AS purchase_id, v.user_id
        FROM ({EVENTS}) v JOIN ({EVENTS}) p ON v.user_id = p.user_id AND v.event_timestamp >= p.event_timestamp
            AND v.event_timestamp < p.event_timestamp + INTERVAL 36 HOUR
        WHERE v.event_type = 'view' AND p.event_type = 'purchase'
    """,
    "overlapping_fulfilments": f"""
        WITH s AS (
            SELECT user_id, order_id, order_date, shipped
            FROM ({ORDERS}) JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem GROUP BY 1) ON order_id = l_orderkey
            WHERE order_date < shipped
        )
        SELECT a.user_id, a.order_id AS order_a, b.order_id AS order_b
        FROM s a JOIN s b ON a.user_id = b.user_id AND a.order_id < b.order_id
            AND a.order_date < b.shipped AND b.order_date < a.shipped
    """,
    "event_windows": EVENT_WINDOWS,
    "event_windows_streamed": EVENT_WINDOWS,
    "event_sessions": EVENT_SESSIONS,
    "event_sessions_streamed": f"""
        SELECT * FROM ({EVENT_SESSIONS})
        WHERE session_end <= (SELECT max(event_timestamp) - INTERVAL 20 DAY FROM ({EVENTS}))
    """,
    "sales_cube": sold_by("CUBE (city, category, month)"),
    "sales_grouping_sets": sold_by("GROUPING SETS ((city, month), (category), (month), ())"),
    "sales_rollup": f"""
        SELECT order_status, user_id, CAST(grouping_id(order_status, user_id) AS BIGINT) AS grouping_id,
               count(*) AS order_rows, count(total_amount) AS amounts, {money(rounded_total('total_amount'))} AS revenue
        FROM ({GAPPY_ORDERS}) GROUP BY ROLLUP (order_status, user_id)
    """,
    "lines_except_all": f"({LINES}) EXCEPT ALL ({RETURNS})",
    "lines_intersect_all": f"({LINES}) INTERSECT ALL ({RETURNS})",
    "lines_differences": f"""
        SELECT quantity, status, CASE WHEN sum(side) > 0 THEN 'added' ELSE 'removed' END AS change,
               CAST(abs(sum(side)) AS BIGINT) AS copies
        FROM (SELECT *, -1 AS side FROM ({LINES}) UNION ALL SELECT *, 1 FROM ({RETURNS}))
        GROUP BY quantity, status HAVING sum(side) <> 0
    """,
    "orders_change_feed": f"""
        SELECT coalesce(b.order_id, a.order_id) AS order_id,
               CASE WHEN b.order_id IS NULL THEN 'insert' WHEN a.order_id IS NULL THEN 'delete' ELSE 'update' END AS change,
               b.order_status AS old_order_status, b.total_amount AS old_total_amount,
               a.order_status AS new_order_status, a.total_amount AS new_total_amount
        FROM (SELECT * FROM ({ORDERS}) WHERE order_date < TIMESTAMP '2000-01-01') b
        FULL JOIN (SELECT * REPLACE (nullif(order_status, 'P') AS order_status) FROM ({ORDERS}) WHERE total_amount >= 20000) a
            ON a.order_id = b.order_id
        WHERE b.order_id IS NULL OR a.order_id IS NULL OR a.order_status IS DISTINCT FROM b.order_status
            OR a.total_amount IS DISTINCT FROM b.total_amount
    """,
    "orders_stratified_sample": f"""
        SELECT * FROM ({GAPPY_ORDERS})
        QUALIFY row_number() OVER (
            PARTITION BY order_status
            ORDER BY md5(concat_ws('|', '7', coalesce('=' || CAST(order_id AS VARCHAR), '-'))), order_id NULLS FIRST,
                     user_id NULLS FIRST, order_date NULLS FIRST, total_amount NULLS FIRST
        ) <= 50
    """,
    "sketched_users": f"""
        SELECT CAST(year(order_date) AS INTEGER) AS year, order_status, count(DISTINCT user_id) AS users, true AS within
        FROM ({ORDERS}) GROUP BY ALL
    """,
    "sketched_returning_users": f"""
        WITH years AS (SELECT DISTINCT CAST(year(order_date) AS INTEGER) AS year, order_status, user_id FROM ({ORDERS}))
        SELECT a.year, a.order_status, count(*) AS returning_users, true AS within
        FROM years a JOIN years b ON b.year = a.year + 1 AND b.order_status = a.order_status AND b.user_id = a.user_id
        GROUP BY ALL
    """,
    "sketched_quantiles": f"""
        SELECT CAST(year(order_date) AS INTEGER) AS year, CAST(share AS DOUBLE) AS share, count(total_amount) AS amounts,
               true AS within
        FROM ({ORDERS}), (SELECT unnest({list(SHARES)}) AS share) GROUP BY ALL
    """,
    "bucketed_join": f"""
        SELECT l.*, o.order_status, o.total_amount FROM ({MERGED_LINES}) l LEFT JOIN ({ORDERS}) o USING (order_id)
    """,
    "bucketed_totals": f"""
        SELECT order_id, count(*) AS lines, {total('quantity')} AS sold FROM ({MERGED_LINES}) GROUP BY order_id
    """,
    "table_releases": f"""
        WITH large AS (SELECT order_id FROM ({ORDERS}) WHERE total_amount >= 150000)
        SELECT CAST(release AS INTEGER) AS release, name, n FROM (
            SELECT 1 AS release, 'orders' AS name, count(*) AS n FROM ({ORDERS})
            UNION ALL SELECT 1, 'order_items', count(*) FROM ({ORDER_ITEMS})
            UNION ALL SELECT 2, 'orders', count(*) FROM large
            UNION ALL SELECT 2, 'order_items', count(*) FROM ({ORDER_ITEMS}) SEMI JOIN large USING (order_id)
            UNION ALL SELECT unnest([1, 2]), 'users', n FROM (SELECT count(*) AS n FROM ({USERS}))
        )
    """,
    "full_run": kpis(COMPLETE_ORDERS, kept_items()),
}
