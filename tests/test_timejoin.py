"""Joins in time against plain loops."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import day
from tillhouse.operators import timejoin

START = day("2026-01-01")


def minute(n):
    return None if n is None else START + datetime.timedelta(minutes=n)


def visits(seed, count, users, minutes):
    source = random.Random(seed)
    return [
        (k, source.choice(users), minute(source.choice([None, *range(minutes)]) if k % 9 == 0 else source.randrange(minutes)))
        for k in range(count)
    ]


def plain_as_of(lefts, rights, strict):
    out = []
    for key, user, at in lefts:
        before = [
            (time, tie, value) for _, other, time, tie, value in rights
            if None not in (user, at, time) and other == user and (time < at or not strict and time == at)
        ]
        last = max(before, key=lambda x: (x[0], x[1] is not None, x[1] or 0, x[2] is not None, x[2] or ""), default=(None, None, None))
        out.append((key, user, at, last[1], last[2]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("hot", [None, 20])
def test_as_of_join(spark, strict, hot):
    """With ``hot`` the rows of most users are divided by time; one user has a third of all rows."""
    users = ["a"] * 4 + ["b", "c", "d", "e", None, "f", "g", "h"]
    lefts = visits(1, 240, users, 90)
    rights = [(*row, row[0] % 3, f"v{row[0]}" if row[0] % 7 else None) for row in visits(2, 200, users[:-2], 90)]
    left = spark.createDataFrame(lefts, "visit int, user string, at timestamp").repartition(5)
    right = spark.createDataFrame(rights, "id int, user string, time timestamp, tie int, value string").repartition(4)
    options = {} if hot is None else {"min_hot_rows": hot}
    found = timejoin.as_of_join(left, right, ["user"], "at", "time", ["tie", "value"], ["tie"], strict, **options)
    assert found.columns == ["visit", "user", "at", "tie", "value"]
    assert sorted(map(tuple, found.collect()), key=repr) == plain_as_of(lefts, rights, strict)


def test_as_of_join_of_empty_sides(spark):
    left = spark.createDataFrame(visits(3, 9, ["a"], 5), "visit int, user string, at timestamp")
    right = spark.createDataFrame([], "user string, time timestamp, value string")
    assert timejoin.as_of_join(left, right, ["user"], "at", "time", ["value"]).where("value IS NULL").count() == 9
    assert timejoin.as_of_join(left.limit(0), right, ["user"], "at", "time", ["value"]).count() == 0


def test_as_of_join_forms_no_pairs(spark):
    left = spark.createDataFrame(visits(3, 9, ["a"], 5), "visit int, user string, at timestamp")
    right = left.select("user", F.col("at").alias("time"), F.col("visit").alias("value"))
    plan = timejoin.as_of_join(left, right, ["user"], "at", "time", ["value"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def spans(seed, count, users):
    source = random.Random(seed)
    out = []
    for k in range(count):
        begin = source.randrange(-50, 200)
        out.append((k, source.choice(users), begin, begin + source.choice([0, 1, 2, 3, 10, 300, -4])))
    return [*out, (count, users[0], None, 5), (count + 1, None, 0, 9), (count + 2, users[0], -(10**12), 10**12)]


def test_points_in_intervals(spark):
    users = ["a", "a", "b", "c"]
    points = [(k, user, at) for k, (_, user, at, _) in enumerate(spans(5, 150, users))]
    intervals = spans(6, 120, users)
    left = spark.createDataFrame(points, "point int, user string, at long").repartition(3)
    right = spark.createDataFrame(intervals, "span int, user string, begin long, stop long").repartition(3)
    found = timejoin.join_points_to_intervals(left, right, "at", "begin", "stop", ["user"])
    expected = sorted(
        (p, s) for p, user, at in points for s, other, begin, stop in intervals
        if None not in (user, at, other, begin, stop) and user == other and begin <= at < stop
    )
    assert sorted(map(tuple, found.select("point", "span").collect())) == expected
    anywhere = timejoin.join_points_to_intervals(left.drop("user"), right, "at", "begin", "stop")
    assert anywhere.count() == sum(
        begin <= at < stop for _, _, at in points for _, _, begin, stop in intervals if None not in (at, begin, stop)
    )
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    with pytest.raises(ValueError):
        timejoin.join_points_to_intervals(left, right.withColumn("AT", F.lit(1)), "at", "begin", "stop", ["user"])


def test_overlapping_intervals(spark):
    users = ["a", "b"]
    one, two = spans(7, 90, users), spans(8, 80, users)
    left = spark.createDataFrame(one, "l int, user string, l0 long, l1 long")
    right = spark.createDataFrame(two, "r int, user string, r0 long, r1 long")
    found = timejoin.join_overlapping(left, right, ("l0", "l1"), ("r0", "r1"), ["user"]).select("l", "r").collect()
    expected = sorted(
        (l, r) for l, u, l0, l1 in one for r, v, r0, r1 in two
        if None not in (u, v, l0, l1, r0, r1) and u == v and l0 < l1 and r0 < r1 and l0 < r1 and r0 < l1
    )
    assert sorted(map(tuple, found)) == expected


def test_dates_and_instants(spark):
    dates = spark.sql("SELECT DATE '2026-01-05' AS d, 1 AS point")
    weeks = spark.sql("SELECT DATE '2026-01-01' AS first, DATE '2026-01-06' AS last, 2 AS span")
    assert timejoin.join_points_to_intervals(dates, weeks, "d", "first", "last").count() == 1
    times = spark.sql("SELECT TIMESTAMP_NTZ '2026-01-05 00:00:00' AS t, 1 AS point")
    hours = spark.sql("SELECT TIMESTAMP '2026-01-04 23:59:59.999999' AS a, TIMESTAMP '2026-01-05 00:00:00.000001' AS b")
    assert timejoin.join_points_to_intervals(times, hours, "t", "a", "b").count() == 1
