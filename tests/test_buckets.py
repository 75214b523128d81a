"""Bucketed tables: joins without an exchange, hot keys in parts, and the same rows as plain joins."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillhouse.sources import buckets

# A third of the lines are of order 7, many of none; lines 5 and 6 of order 9 are equal; order 11 has no line.
LINES = [(7 if k % 3 == 0 else None if k % 5 == 0 else k % 11, "x" if k in (20, 31) else f"l{k}") for k in range(600)]
LINES += [(9, "twin"), (9, "twin"), (99, "orphan")]
ORDERS = [(k, f"o{k}") for k in range(12)] + [(4, "again"), (None, "unknown")]


@pytest.fixture(scope="module")
def lines(spark):
    return spark.createDataFrame(LINES, "order_id int, line string")


@pytest.fixture(scope="module")
def orders(spark):
    return spark.createDataFrame(ORDERS, "order_id int, name string")


@pytest.fixture(scope="module")
def both(lines, orders, tmp_path_factory):
    folder = tmp_path_factory.mktemp("bucketed")
    left = buckets.write_bucketed(lines, str(folder / "lines"), ["order_id"], buckets=8)
    return left, buckets.write_bucketed(orders, str(folder / "orders"), like=left), folder


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def exchanges(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_joins_are_the_plain_ones_without_an_exchange(lines, orders, both, how):
    found = buckets.join_bucketed(both[0], both[1], how)
    assert exchanges(found) == 0
    plain = lines.join(orders, "order_id", how)
    assert found.columns == plain.columns and rows_of(found) == rows_of(plain)
    assert exchanges(plain) > 0  # the count would see one


def test_hot_keys_are_dealt_out(both):
    left, right, _ = both
    hot = {row["order_id"]: row[buckets.PARTS] for row in left.hot.collect()}
    assert set(hot) == {7, None} and hot[7] >= 3
    parts = left.rows.where("order_id = 7").groupBy(buckets.PART).count().collect()
    assert len(parts) == hot[7] and max(row["count"] for row in parts) <= 2 * min(row["count"] for row in parts)
    assert right.rows.where("order_id = 7").count() == hot[7]
    assert right.rows.where("order_id = 4").count() == 2


def test_totals_without_an_exchange(lines, both):
    found = buckets.totals_bucketed(both[0], {"lines": F.count(F.lit(1)), "last": F.max("line")})
    assert exchanges(found) == 0
    merged = found.groupBy("order_id").agg(F.sum("lines"), F.max("last"))
    assert rows_of(merged) == rows_of(lines.groupBy("order_id").agg(F.count(F.lit(1)), F.max("line")))
    with pytest.raises(ValueError):
        buckets.totals_bucketed(both[1], {"n": F.count(F.lit(1))})


def test_a_session_that_opens_the_folders(spark, lines, orders, both):
    left, right = (buckets.open_bucketed(spark.newSession(), str(both[2] / name)) for name in ("lines", "orders"))
    assert (left.keys, left.buckets, left.copies, right.copies) == (("order_id",), 8, False, True)
    left, right = (buckets.open_bucketed(spark, str(both[2] / name)) for name in ("lines", "orders"))
    found = buckets.join_bucketed(left, right, "left")
    assert exchanges(found) == 0 and rows_of(found) == rows_of(lines.join(orders, "order_id", "left"))


def test_several_keys_few_rows_and_none(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", 1.5), (1, "b", None), (None, "a", 2.5)], "x bigint, y string, z double")
    for name, rows in (("few", df), ("none", df.limit(0))):
        left = buckets.write_bucketed(rows, str(tmp_path / name), ["x", "y"], buckets=4)
        right = buckets.write_bucketed(df.withColumnRenamed("z", "w"), str(tmp_path / f"{name}-right"), like=left)
        found = buckets.join_bucketed(left, right, "left")
        assert found.columns == ["x", "y", "z", "w"]
        assert rows_of(found) == rows_of(rows.join(df.withColumnRenamed("z", "w"), ["x", "y"], "left"))


def test_what_is_refused(spark, lines, orders, both, tmp_path):
    left, right, _ = both
    for pair in ((right, left), (left, left)):
        with pytest.raises(ValueError):
            buckets.join_bucketed(*pair)
    with pytest.raises(ValueError):
        buckets.join_bucketed(left, right, "full")
    other = buckets.write_bucketed(lines, str(tmp_path / "other"), ["order_id"], buckets=8)
    with pytest.raises(ValueError):
        buckets.join_bucketed(other, right)
    with pytest.raises(ValueError):
        buckets.write_bucketed(orders.withColumn("order_id", F.col("order_id").cast("string")), str(tmp_path / "text"), like=left)
    with pytest.raises(ValueError):
        buckets.write_bucketed(lines.withColumn(buckets.PART, F.lit(1)), str(tmp_path / "clash"), ["order_id"])
