"""Grouping sets, multisets of rows and samples by stratum, against plain Python and Spark's own operators."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import cubes, multisets, sampling

ROWS = [
    (("N", "S", None)[k % 3], ("red", None)[k % 5 == 0], f"m{k % 4}", k % 7, None if k % 11 == 0 else k * 0.25)
    for k in range(200)
]
SCHEMA = "place string, colour string, month string, pieces int, price double"
def measures():
    return {
        "rows": cubes.row_count(),
        "priced": cubes.value_count(F.col("price")),
        "pieces_sold": cubes.total(F.col("pieces")),
        "amount": cubes.money_total(F.col("price")),
        "mean": cubes.money_mean(F.col("price")),
        "least": cubes.smallest(F.col("price")),
        "most": cubes.largest(F.col("price")),
    }


@pytest.fixture
def sold(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def plain(df, keys):
    """Spark's own cube, which expands the rows."""
    return df.cube(*keys).agg(
        F.grouping_id(*keys).alias("grouping_id"),
        F.count(F.lit(1)).alias("rows"),
        F.count("price").alias("priced"),
        F.sum("pieces").alias("pieces_sold"),
        F.round(F.sum(F.col("price").cast("decimal(20,6)")), 2).cast("double").alias("amount"),
        F.round(F.sum(F.col("price").cast("decimal(20,6)")) / F.count("price"), 2).cast("double").alias("mean"),
        F.min("price").alias("least"),
        F.max("price").alias("most"),
    )


def rows_of(df):
    return Counter(map(tuple, df.collect()))


def test_cube_is_that_of_spark(sold):
    keys = ["place", "colour", "month"]
    found = cubes.cube(sold, keys, measures())
    assert rows_of(found) == rows_of(plain(sold, keys).select(*found.columns))


def test_sets_and_rollups_are_parts_of_the_cube(sold):
    keys = ["place", "colour", "month"]
    whole = cubes.cube(sold, keys, measures())
    assert rows_of(cubes.rollup(sold, keys, measures())) == rows_of(whole.where("grouping_id in (0, 1, 3, 7)"))
    some = cubes.grouping_sets(sold, keys, iter([["month"], ["month", "place"], ["colour"]]), measures())
    assert rows_of(some) == rows_of(whole.where("grouping_id in (6, 2, 5)"))


def test_rows_are_not_expanded(sold):
    plan = cubes.cube(sold, ["place", "colour"], measures())._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "ExistingRDD" not in plan  # everything is read from stored results


def test_sets_of_an_empty_table(sold):
    found = cubes.cube(sold.where("pieces > 99"), ["place", "colour"], measures()).collect()
    assert [tuple(row) for row in found] == [(None, None, 3, 0, 0, None, None, None, None, None)]


@pytest.mark.parametrize("keys, sets", [(["place"], [("place",), ("place",)]), (["place"], [("month",)]), (["place"], [])])
def test_sets_that_make_no_sense(sold, keys, sets):
    with pytest.raises(ValueError):
        cubes.grouping_sets(sold, keys, sets, measures())


LEFT = [(1, "a"), (1, "a"), (1, "a"), (2, None), (2, None), (None, None), (3, "c"), (4, "d")]
RIGHT = [("a", 1), (None, 2), (None, None), (None, None), ("e", 5), ("d", 4)]


@pytest.fixture
def snapshots(spark):
    return spark.createDataFrame(LEFT, "id int, v string"), spark.createDataFrame(RIGHT, "v string, id int")


def test_multisets(snapshots):
    left, right = snapshots
    a, b = Counter(LEFT), Counter((i, v) for v, i in RIGHT)
    assert rows_of(multisets.except_all(left, right)) == a - b
    assert rows_of(multisets.except_all(right, left)) == Counter({(v, i): n for (i, v), n in (b - a).items()})
    assert rows_of(multisets.intersect_all(left, right)) == a & b
    assert rows_of(multisets.except_all(left, right.where("false"))) == a
    assert not rows_of(multisets.intersect_all(left.where("false"), right))
    expected = {(*row, "removed", n) for row, n in (a - b).items()} | {(*row, "added", n) for row, n in (b - a).items()}
    assert set(rows_of(multisets.differences(left, right))) == expected


def test_rows_with_very_many_copies(spark, monkeypatch):
    """A row with more copies than a task writes out is divided, and none is lost."""
    monkeypatch.setattr(multisets, "CHUNK", 100)
    numbers = {"a": 1, "b": 100, "c": 101, "d": 12_345, "e": 0, "f": None, "g": 200}
    df = spark.createDataFrame(list(numbers.items()), "v string, n long")
    repeated = multisets.repeat_rows(df, "n")
    assert {row["v"]: row["count"] for row in repeated.groupBy("v").count().collect()} == {v: n for v, n in numbers.items() if n}
    spread = repeated.where("v = 'd'").groupBy(F.spark_partition_id()).count()
    assert spread.count() > 1
    hot = spark.range(3000).select(F.lit("x").alias("v"))
    assert multisets.except_all(hot, hot.limit(999)).count() == 2001


def test_different_columns_are_refused(spark, snapshots):
    left, right = snapshots
    with pytest.raises(ValueError):
        multisets.except_all(left, right.withColumn("id", F.col("id").cast("long")))
    with pytest.raises(ValueError):
        multisets.differences(left, right.drop("v"))


def test_change_feed(spark):
    before = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, None, 3.0), (None, "n", 0.0)], "id int, v string, w double")
    after = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (4, "d", 4.0), (None, None, 0.0)], "id int, v string, w double")
    assert rows_of(multisets.change_feed(before, after, ["id"])) == Counter(
        [
            (2, "update", "b", None, "b", 2.0),
            (3, "delete", None, 3.0, None, None),
            (4, "insert", None, None, "d", 4.0),
            (None, "update", "n", 0.0, None, 0.0),
        ]
    )
    assert multisets.change_feed(before, before, ["id"]).count() == 0
    with pytest.raises(Exception, match="a snapshot has a key twice"):
        multisets.change_feed(before.union(before), after, ["id"]).collect()


def test_stratified_sample(spark):
    """Exact numbers, also of a stratum with most of the rows; repeatable, and mergeable."""
    n = F.col("id")
    stratum = F.when(n % 10 < 7, "hot").when(n % 10 == 7, "cold").when(n < 40, "rare")
    df = spark.range(5000).select(n, stratum.alias("s"), (n % 3).alias("extra"))

    def draw(rows, **options):
        return sampling.stratified_sample(rows, ["s"], ["id"], 20, **options)

    found = rows_of(draw(df))
    assert Counter(s for _, s, _ in found.elements()) == {"hot": 20, "cold": 20, "rare": 8, None: 20}
    assert rows_of(draw(df.repartition(11).orderBy(F.desc("id")))) == found
    assert rows_of(draw(draw(df.where("id < 1700")).union(draw(df.where("id >= 1700"))))) == found
    assert rows_of(draw(df, seed=2)) != found
    assert set(found) <= set(rows_of(df)) and draw(df).columns == df.columns
    assert sampling.stratified_sample(df, ["s"], ["id"], 0).count() == 0
    assert draw(df.where("false")).count() == 0
    same = spark.createDataFrame([("a", None)] * 30 + [("a", 1)] * 5, "s string, id int")
    assert draw(same).count() == 20


def test_sample_is_limited_before_the_shuffle(spark):
    df = spark.range(100).select("id", (F.col("id") % 3).alias("s"))
    plan = sampling.stratified_sample(df, ["s"], ["id"], 5)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
