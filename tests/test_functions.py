"""Money arithmetic, global row numbers, large groups and scratch space."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tillhouse.functions import money
from tillhouse.functions.keys import KeySet, hot_keys
from tillhouse.functions.materialize import materialize, scratch_path
from tillhouse.functions.ranking import global_row_numbers

CENTS = Decimal("0.01")


def rounded(value: Decimal) -> float:
    return float(value.quantize(CENTS, ROUND_HALF_UP))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(-(10**12), 10**12), min_size=1, max_size=40))
def test_sums_and_means_are_exact(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "amount double").repartition(3)
    units = money.to_units(F.col("amount"))
    row = df.agg(
        money.money(F.sum(units)).alias("total"),
        money.from_cents(money.mean_cents(F.sum(units), F.count(units))).alias("mean"),
    ).first()
    exact = sum(Decimal(c) for c in cents) / 100
    assert row.total == float(exact)
    assert row.mean == rounded(exact / len(cents))


@pytest.mark.parametrize(
    "part, whole, share",
    [
        (1, 3, 33.33),
        (2, 3, 66.67),
        (1, 16, 6.25),
        (5, 0, None),
        (-1, 8, -12.5),
        (1, -8, -12.5),
        (-1, -8, 12.5),
    ],
)
def test_percent(spark, part, whole, share):
    df = spark.createDataFrame([(part, whole)], "part bigint, whole bigint")
    assert df.select(money.percent(F.col("part"), F.col("whole"))).first()[0] == share


def test_percent_of_very_large_totals(spark):
    df = spark.createDataFrame([(9 * 10**18, 9 * 10**18)], "part bigint, whole bigint")
    assert df.select(money.percent(F.col("part"), F.col("whole"))).first()[0] == 100.0


def test_halves_round_away_from_zero(spark):
    df = spark.createDataFrame([(1, 2), (-1, 2), (3, 2), (1, 3), (-2, 3)], "n bigint, d bigint")
    quotients = [row[0] for row in df.select(money.divide_half_up(F.col("n"), F.col("d"))).collect()]
    assert quotients == [1, -1, 2, 0, -1]


def test_values_that_are_no_amounts_are_refused(spark):
    df = spark.createDataFrame([(float("nan"),)], "amount double")
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        df.select(money.to_units(F.col("amount"))).collect()


def test_halves_of_a_cent(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (0.5,), (None,)], "amount double")
    assert [row[0] for row in df.select(money.to_units(F.col("amount"))).collect()] == [13, -13, 50, None]


def test_more_decimals_than_cents(spark):
    df = spark.createDataFrame([(0.0049,), (0.0001,), (1.0,)], "amount double")
    units = F.sum(money.to_units(F.col("amount"), 4))
    row = df.agg(money.money(units, 4), money.from_cents(money.mean_cents(units, F.lit(3), 4))).first()
    assert tuple(row) == (1.01, 0.34)


@pytest.mark.parametrize("partitions", [1, 5])
def test_global_row_numbers(spark, partitions):
    """Most rows share one value, which must not hold them together."""
    generator = random.Random(7)
    rows = [(key, generator.choice([None, 1, 1, 1, 1, 2, 3])) for key in range(500)]
    generator.shuffle(rows)
    df = spark.createDataFrame(rows, "key int, value int").repartition(partitions)
    by_value = [F.desc_nulls_last("value"), F.asc("key")]
    ranked = global_row_numbers(df, {"place": by_value, "reverse": [F.desc("key")]})
    ordered = sorted(rows, key=lambda row: (row[1] is None, -(row[1] or 0), row[0]))
    assert sorted((row.place, row.key) for row in ranked.collect()) == [
        (place, row[0]) for place, row in enumerate(ordered, start=1)
    ]
    assert all(row.reverse == 500 - row.key for row in ranked.collect())
    assert ranked.dtypes == [("key", "int"), ("value", "int"), ("place", "bigint"), ("reverse", "bigint")]


def test_global_row_numbers_of_nothing(spark):
    empty = spark.range(0).toDF("key")
    assert global_row_numbers(empty, {"place": [F.asc("key")]}).collect() == []


def test_hot_keys(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 3), (None, 1)], "key string, size bigint")
    assert {row.key for row in hot_keys(sizes, "key", "size", min_rows=5).collect()} == {"a", None}
    assert {row.key for row in hot_keys(sizes, "key", "size").collect()} == {None}


def test_scratch_paths_are_below_the_shared_folder_and_differ(spark):
    paths = {scratch_path(spark, "x") for _ in range(3)}
    assert len(paths) == 3
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert all(path.startswith(configured) for path in paths)


def test_materialize_keeps_rows(spark):
    df = spark.range(100).withColumn("r", F.rand(3))
    kept = materialize(df)
    assert sorted(kept.collect()) == sorted(kept.collect()) == sorted(df.collect())


def test_filter_of_keys(spark):
    """All keys pass a filter, nulls and both zeros included; of others, few do."""
    rows = [(f"k{n}", float(n)) for n in range(300)] + [(None, 1.0), ("zero", -0.0)]
    known = KeySet.of(spark.createDataFrame(rows, "name string, n double"))
    found = known.filter(16, max_keys=20)
    probe = spark.createDataFrame([*rows[:-1], ("zero", 0.0)], known.keys.schema)
    marked = found.mark(probe, ["name", "n"], "passed")
    assert marked.columns == ["name", "n", "passed"] and marked.where("passed").count() == len(rows)
    others = spark.range(10_000).select(F.format_string("k%d", "id").alias("name"), F.lit(0.5).alias("n"))
    assert found.mark(others, ["name", "n"], "passed").where("passed").count() < 500
    assert found.mark(others, ["name", "n"], "passed").count() == 10_000
    assert "Exchange hashpartitioning" not in marked._jdf.queryExecution().executedPlan().toString()
    assert found.suits(probe, ["name", "n"]) and not found.suits(probe, ["n", "name"])


def test_a_filter_is_no_larger_than_keys_that_may_be_broadcast(spark):
    known = KeySet.of(spark.range(20_000))
    assert known.filter(16, max_keys=0) is None
    assert known.filter(16, max_keys=100).segments == 100 * 67 * 8 // 4096
    assert known.filter(16, max_keys=50) is None
    assert known.filter(16).segments == 79
