"""Sources, sinks and the layer jobs, over temporary folders."""

import datetime
import pathlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from tests.conftest import CITIES, ITEM_ROWS, ORDER_ROWS
from tests.test_analytics import cents, sums
from tillhouse.functions.concurrency import run_together
from tillhouse.operators import loyalty, products
from tillhouse.operators import users as per_user
from tillhouse.plans import jobs, policies
from tillhouse.sources import tables as io
from tillhouse.workload import queries

AS_OF = datetime.datetime(2026, 8, 1)
STAMP = "2026-07-01 10:00:00"


def write_csv(folder, name, header, rows):
    lines = [",".join(header), *[",".join("" if cell is None else str(cell) for cell in row) for row in rows]]
    (folder / f"{name}.csv").write_text("\n".join(lines) + "\n")


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    rows = {
        "users": [(u, f"name {u}", None, "female", city, "2025-01-01") for u, city in CITIES.items()],
        "products": [(f"P{n}", "thing", "toys", None, 2.5, None if n == 1 else 4.5) for n in (1, 2, 3)],
        "orders": [(o, u, at, "completed", amount) for o, u, at, amount in ORDER_ROWS]
        + [("O90", None, STAMP, None, 40.0), (None, "U01", STAMP, "shipped", 1.0), ("O01", "U15", STAMP, None, 10.0)],
        "order_items": [
            (item, f"O{n:02d}", product, user, quantity, 1.5, 3.0)
            for n, (item, _, product, user, quantity) in enumerate(ITEM_ROWS, start=1)
        ],
        "events": [("E1", "U01", "P1", "view", STAMP), ("E2", "nobody", "P1", "cart", STAMP)],
        "reviews": [("R1", "O01", "P1", "U15", 5, None, STAMP), ("R2", "O02", "P9", "U03", 4, "fine", None)],
    }
    for name, table in rows.items():
        write_csv(folder, name, policies.COLUMNS[name], table)
    return str(folder)


def test_csv_scan(spark, tmp_path):
    write_csv(tmp_path, "t", ["b", "a"], [(1, None), (2, "x")])
    tables = io.scan_csv_tables(spark, str(tmp_path), ["t.csv", "absent.csv"], probe=True)
    assert set(tables) == {"t"}
    assert tables["t"].dtypes == [("b", "string"), ("a", "string")]
    assert [tuple(row) for row in tables["t"].collect()] == [("1", None), ("2", "x")]
    assert tables["t"].count() == 2


def test_csv_files_with_different_headers_are_refused(spark, tmp_path):
    folder = tmp_path / "t.csv"
    folder.mkdir()
    write_csv(folder, "part-1", ["a", "b"], [(1, 2)])
    write_csv(folder, "part-2", ["b", "a"], [(2, 1)])
    with pytest.raises(Exception, match="CSV header does not conform|CSV"):
        io.scan_csv(spark, str(folder)).collect()


def test_unreadable_csv(spark, tmp_path):
    (tmp_path / "t.csv").mkdir()
    write_csv(tmp_path, "u", ["a"], [(1,)])
    (tmp_path / "t.csv" / "part.csv.gz").write_bytes(b"not gzip")
    with pytest.raises(Exception):
        io.scan_csv_tables(spark, str(tmp_path), ["t.csv", "u.csv"], probe=True)
    assert set(io.scan_csv_tables(spark, str(tmp_path), ["t.csv", "u.csv"], skip_invalid=True, probe=True)) == {"u"}


def test_parquet_sets_are_all_or_nothing(spark, tmp_path):
    paths = io.write_tables({"a": spark.range(2), "b": spark.range(3)}, str(tmp_path))
    assert paths == {"a": f"{tmp_path}/a", "b": f"{tmp_path}/b"}
    tables = io.scan_parquet_tables(spark, str(tmp_path), ["a", "b"], probe=True)
    assert {name: df.count() for name, df in tables.items()} == {"a": 2, "b": 3}
    assert io.scan_parquet_tables(spark, str(tmp_path), ["a", "c"]) == {}
    assert io.write_tables({}, str(tmp_path)) == {}


def test_report_is_replaced(spark, tmp_path):
    for size in (40, 3, 0):
        report = spark.range(size).select("id", F.format_string("row %d of the report", "id").alias("line"))
        assertDataFrameEqual(spark.read.parquet(io.write_table(report, str(tmp_path), "lines")), report)


def test_metrics_history_grows(spark, tmp_path):
    path = str(tmp_path / "runs")
    runs = [(f"run {n}", None if n % 2 else n / 8) for n in range(3)]
    for n in range(len(runs)):
        io.append_metrics(spark.createDataFrame(runs[n : n + 1], "batch string, share double"), path)
        assert sorted(io.read_metrics(spark, path, "batch string, share double").collect()) == runs[: n + 1]


def test_actions_run_together(spark):
    assert run_together(spark, {"a": lambda: spark.range(3).count(), "b": lambda: 1}) == {"a": 3, "b": 1}
    with pytest.raises(ZeroDivisionError):
        run_together(spark, {"a": lambda: 1 / 0, "b": lambda: 1})


def test_bronze(spark, raw, tmp_path):
    paths = jobs.bronze(spark, raw, str(tmp_path / "bronze"), batch_id="b1", as_of=AS_OF)
    assert set(paths) == set(policies.TABLES)
    orders = spark.read.parquet(paths["orders"])
    assert orders.columns == [*policies.COLUMNS["orders"], "batch_id", "ingestion_time"]
    assert orders.count() == len(ORDER_ROWS) + 3
    assert [tuple(row) for row in orders.select("batch_id", "ingestion_time").distinct().collect()] == [("b1", AS_OF)]


def test_bronze_needs_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="no usable tables"):
        jobs.bronze(spark, str(tmp_path), str(tmp_path / "bronze"))


def test_silver(spark, raw, tmp_path):
    bronze, silver, rejected = (str(tmp_path / name) for name in ("bronze", "silver", "rejected"))
    jobs.bronze(spark, raw, bronze, batch_id="b1", as_of=AS_OF)
    paths = jobs.silver(spark, bronze, silver, rejected_target=rejected, as_of=AS_OF)
    tables = {name: spark.read.parquet(path) for name, path in paths.items()}

    orders = {row.order_id: row for row in tables["orders"].collect()}
    assert len(orders) == len(ORDER_ROWS) + 1
    # Of two equally complete rows for O01 the earlier order date comes first.
    assert orders["O01"].order_status == "completed" and orders["O01"].business_overall_correct
    assert (orders["O90"].missing_values, orders["O90"].order_status) == ("user_id", "unknown")
    assert (orders["O90"].df_users_ref, orders["O90"].correct_order_status) == (False, False)
    assert spark.read.parquet(f"{rejected}/orders").select("order_id").collect() == [("O01",)]

    events = {row.event_id: row for row in tables["events"].collect()}
    assert (events["E1"].business_overall_correct, events["E2"].df_users_ref) == (True, False)
    reviews = {row.review_id: row for row in tables["reviews"].collect()}
    assert (reviews["R1"].review_text, reviews["R1"].business_overall_correct) == ("", True)
    assert (reviews["R2"].df_products_ref, reviews["R2"].correct_review_date) == (False, False)
    products_ = {row.product_id: row for row in tables["products"].collect()}
    assert (products_["P1"].missing_values, products_["P1"].brand) == ("rating", "")
    assert {row.email for row in tables["users"].collect()} == {"unknown"}
    types = dict(tables["order_items"].dtypes)
    assert (types["quantity"], types["item_total"]) == ("int", "double")


def test_silver_needs_all_tables(spark, tmp_path):
    with pytest.raises(ValueError, match="lacks some of the tables"):
        jobs.silver(spark, str(tmp_path), str(tmp_path / "silver"))


def test_lookup_before_deduplication_only_for_key_columns(spark):
    complete = {"users": spark.range(1), "orders": spark.range(2)}
    kept = {"users": spark.range(3), "orders": spark.range(4)}
    configured = {"orders": {"user_id": "df_users", "name": "df_orders"}}
    keys = {"users": ["user_id"], "orders": ["order_id"]}
    lookups = jobs._lookups(complete, kept, keys, configured)
    assert lookups["users"] is complete["users"]
    assert lookups["orders"] is kept["orders"]


def test_pipeline(spark, raw, tmp_path):
    target = str(tmp_path / "out")
    for batch in ("b1", "b2"):
        paths = jobs.pipeline(spark, raw, target, batch_id=batch, as_of=AS_OF)
    assert {path.removeprefix(target) for path in paths.values()} == {
        "/gold/sales_and_revenues",
        "/gold/geography",
        "/gold/customer_metrics",
        "/gold/products",
        "/gold/orders",
        "/gold/customers_loyalty",
        "/reports/top_products_per_city",
        "/reports/report",
    }
    history = io.read_metrics(spark, paths["report"])
    assert [row.batch_id for row in history.orderBy("batch_id").collect()] == ["b1", "b2"]
    record = history.first()
    # The order without a user counts as one more user and one more order.
    spent = sums([*((row[1], row[3]) for row in ORDER_ROWS), (None, 40)])
    assert record.active_users_count == len(spent) - 1
    assert record.avg_orders_count_per_user == cents(Decimal(len(ORDER_ROWS) + 1) / len(spent))
    assert record.big_orders_share == 0.0
    top = sum(sorted(spent.values())[-(len(spent) // 10) :])
    assert record.share_top_users_in_total_revenue == cents(top / sum(spent.values()) * 100)

    silver = io.scan_parquet_tables(spark, f"{target}/silver", policies.TABLES)
    saved = {name: spark.read.parquet(path) for name, path in paths.items() if name != "report"}
    assertDataFrameEqual(saved["customers_loyalty"], loyalty.customer_loyalty(silver["orders"]))
    assertDataFrameEqual(saved["products"], products.product_sales(silver["order_items"]))
    revenue = per_user.revenue_per_user(per_user.user_totals(silver["orders"]))
    assertDataFrameEqual(saved["geography"], per_user.city_sales(revenue, silver["users"]))


def test_gold_over_valid_rows_only(spark, raw, tmp_path):
    target = str(tmp_path / "out")
    paths = jobs.pipeline(spark, raw, target, as_of=AS_OF, only_valid=True)
    orders = spark.read.parquet(paths["orders"])
    assert orders.count() == len(ORDER_ROWS)
    assert orders.where(F.col("order_id") == "O90").isEmpty()


def test_gold_checks_the_schema(spark, tmp_path):
    source = str(tmp_path / "silver")
    io.write_tables({name: spark.range(1) for name in policies.TABLES}, source)
    with pytest.raises(ValueError, match="expected schema"):
        jobs.gold(spark, source, str(tmp_path / "gold"), str(tmp_path / "reports"))


def test_tables_and_exports_are_written_compressed(spark, tmp_path, monkeypatch):
    io.write_table(spark.range(3), str(tmp_path), "numbers")
    assert all(file.name.endswith(".zstd.parquet") for file in (tmp_path / "numbers").glob("part-*"))
    raw = spark.createDataFrame([("1", None), ("2", "b,c")], "a string, b string")
    monkeypatch.setattr(queries.src, "raw_tables", lambda *_: {"t": raw})
    exported = queries._export(spark, "unused", ["t"])
    assert sorted(io.scan_csv_tables(spark, exported, ["t.csv"])["t"].collect()) == [("1", None), ("2", "b,c")]
    assert all(file.name.endswith(".csv.gz") for file in pathlib.Path(exported, "t.csv").glob("part-*"))
