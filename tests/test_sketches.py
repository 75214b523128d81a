"""Stored sketches against exact counts and ranks, in whatever order they are merged."""

import random

import pytest
from pyspark.sql import functions as F

from tillhouse.operators import sketches

DRAWN = random.Random(5)
# Ten days; a third of the rows are of one day, some lack a user or a value.
VISITS = [
    (
        3 if k % 3 == 0 else DRAWN.randrange(10),
        None if k % 50 == 0 else DRAWN.randrange(6000),
        None if k % 40 == 0 else DRAWN.expovariate(0.01),
    )
    for k in range(30_000)
]


def measures(size=9, ranks=400):
    return {
        "users": sketches.distinct(F.col("user"), size),
        "who": sketches.distinct_set(F.col("user"), size),
        "values": sketches.quantiles(F.col("value"), ranks),
    }


@pytest.fixture(scope="module")
def visits(spark):
    return spark.createDataFrame(VISITS, "day int, user int, value double").repartition(6)


def users_of(days):
    return {user for day, user, _ in VISITS if day in days and user is not None}


def values_of(days):
    return [value for day, _, value in VISITS if day in days and value is not None]


def estimates(df, *keys):
    return df.select(
        *keys,
        sketches.distinct_estimate(F.col("users")).alias("users"),
        sketches.set_estimate(F.col("who")).alias("who"),
        *[sketches.quantile_estimate(F.col("values"), share).alias(f"at_{share}") for share in (0.05, 0.5, 0.95)],
    ).collect()


def check(row, days):
    own, exact, values = measures(), len(users_of(days)), values_of(days)
    assert abs(row["users"] - exact) <= own["users"].bound * exact
    assert abs(row["who"] - exact) <= own["who"].bound * exact
    for share in (0.05, 0.5, 0.95):
        rank = sum(value <= row[f"at_{share}"] for value in values) / len(values)
        assert abs(rank - share) <= own["values"].bound + 1 / len(values)


def test_days_and_all_days_keep_their_bounds(visits):
    days = sketches.sketch_rows(visits, ["day"], measures())
    for row in estimates(days, "day"):
        check(row, {row["day"]})
    halves = estimates(sketches.roll_up(days, [(F.col("day") < 5).alias("early")], measures()), "early")
    assert len(halves) == 2
    for row in halves:
        check(row, set(range(5)) if row["early"] else set(range(5, 10)))
    check(estimates(sketches.roll_up(days, [], measures()))[0], set(range(10)))


def test_order_of_merges_does_not_matter(visits):
    days = sketches.sketch_rows(visits, ["day"], measures())
    for groups in (2, 3, 7):
        some = sketches.roll_up(days, [(F.col("day") % groups).alias("group")], measures())
        for order in ("group", F.desc("group")):
            check(estimates(sketches.roll_up(some.orderBy(order), [], measures()))[0], set(range(10)))


def test_sketches_do_not_grow_with_rows(spark, visits):
    sizes = [
        sketches.sketch_rows(df, [], {k: v for k, v in measures().items() if k != "values"})
        .select(F.greatest(F.length("users"), F.length("who")).alias("bytes"))
        .first()["bytes"]
        for df in (visits, spark.range(400_000).select(F.col("id").alias("user")))
    ]
    assert max(sizes) <= 2 * 8 * 512 + 64


def test_overlap(visits):
    own = measures()
    halves = sketches.roll_up(
        sketches.sketch_rows(visits, ["day"], own), [F.when(F.col("day") < 4, "a").otherwise("b").alias("half")], own
    )
    left = halves.where("half = 'a'").select(F.col("who").alias("left"))
    right = halves.where("half = 'b'").select(F.col("who").alias("right"))
    found = left.crossJoin(right).select(sketches.overlap_estimate(F.col("left"), F.col("right"))).first()[0]
    early, late = users_of(range(4)), users_of(range(4, 10))
    assert abs(found - len(early & late)) <= own["who"].bound * len(early | late)


def test_batches_late_rows_and_repeats(spark, visits, tmp_path):
    table = sketches.SketchTable(spark, str(tmp_path / "kept"), ["day"], measures())
    part = F.coalesce(F.col("user"), F.lit(0)) % 3
    table.add(visits.limit(500), "one/1")  # a failed attempt, replaced below
    for batch, number in (("one/1", 0), ("two", 1), (3, 2), ("one/1", 0), ("two", 1)):
        table.add(visits.where(part == number), batch)
    assert {row["batch"] for row in table.parts().select("batch").distinct().collect()} == {"one/1", "two", "3"}
    check(estimates(table.roll_up([]))[0], set(range(10)))
    for row in estimates(table.roll_up(["day"]), "day"):
        check(row, {row["day"]})
    table.add(visits.limit(0), "two")
    table.add(visits.limit(0), 3)
    third = {user for user in users_of(range(10)) if user % 3 == 0}
    assert abs(estimates(table.roll_up([]))[0]["users"] - len(third)) <= measures()["users"].bound * len(third)


def test_nothing_and_nulls(spark):
    rows = [("a", None, None), ("a", None, None), (None, 1, 2.5), (None, 1, float("nan"))]
    df = spark.createDataFrame(rows, "kind string, user int, value double")
    found = {row["kind"]: row for row in estimates(sketches.sketch_rows(df, ["kind"], measures()), "kind")}
    assert found["a"][1:] == (0, 0, None, None, None)
    assert found[None][1:] == (1, 1, 2.5, 2.5, 2.5)
    assert estimates(sketches.sketch_rows(df.limit(0), ["kind"], measures()), "kind") == []
    assert estimates(sketches.sketch_rows(df.limit(0), [], measures()))[0] == (0, 0, None, None, None)
    missing = df.limit(1).select(F.lit(None).cast("binary").alias("s"))
    assert missing.select(sketches.distinct_estimate(F.col("s")), sketches.overlap_estimate(F.col("s"), F.col("s"))).first() == (0, 0)


def test_names_must_not_clash(spark):
    for keys, name in ((["batch"], "x"), (["x"], "x"), (["y"], "batch")):
        with pytest.raises(ValueError):
            sketches.SketchTable(spark, "nowhere", keys, {name: sketches.distinct(F.col("user"))})
