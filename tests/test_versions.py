"""Merges into versioned tables against plain dictionaries."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tillhouse.sources.versions import ConflictError, VersionedTable

SCHEMA = "id long, part string, at int, value string"
CHANGES = f"{SCHEMA}, gone boolean"


def key(row):
    return row[0], row[1]


def random_rows(seed, count, keys):
    source = random.Random(seed)
    return [
        (source.choice([None, *range(keys)]), source.choice(["x", "y", None]), source.choice([None, *range(30)]), f"{seed}-{k}")
        for k in range(count)
    ]


def rank(row, new):
    """What makes a row win: the greatest order, then being a change, then deletion, then the least other column."""
    gone = len(row) > 4 and bool(row[4])
    return (row[2] is not None, row[2] or 0, new, gone, [-ord(c) for c in row[3]])


def plain_merge(state, changes):
    out = dict(state)
    for row in sorted(changes, key=lambda row: rank(row, 1)):
        present = out.get(key(row))
        if present is None or rank(present, 0) <= rank(row, 1) or present in changes:
            out[key(row)] = row
    return {k: row[:4] for k, row in out.items() if len(row) == 4 or not row[4]}


def rows_of(df):
    return {key(row): tuple(row) for row in df.collect()}


@pytest.mark.parametrize("max_broadcast", [10**6, 0])
def test_merges_equal_a_recompute(spark, tmp_path, max_broadcast):
    first = list({key(row): row for row in random_rows(1, 120, 40)}.values())
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(spark.createDataFrame(first, SCHEMA), ["id", "part"], buckets=8)
    state = {key(row): row for row in first}
    history = [state]
    for seed in (2, 3):
        changes = [(*row, k % 4 == 0) for k, row in enumerate(random_rows(seed, 90, 60))]
        table.merge(spark.createDataFrame(changes, CHANGES).repartition(3), "at", "gone", max_broadcast=max_broadcast)
        state = plain_merge(state, changes)
        history.append(state)
    assert table.versions() == [1, 2, 3]
    for number, expected in enumerate(history, 1):
        assert rows_of(table.read(number)) == expected
    assert table.read().count() == len(state)

    feed = {(row["change"], *row[:4]) for row in table.changes(1, 3).collect()}
    assert feed == {("removed", *row) for row in set(history[0].values()) - set(state.values())} | {
        ("added", *row) for row in set(state.values()) - set(history[0].values())
    }


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    first = table.create(spark.range(500).selectExpr("id", "'x' AS part", "1 AS at", "'v' AS value"), ["id"], buckets=16)
    files = {path: path.stat().st_mtime_ns for path in Path(tmp_path).rglob("data/**/*.parquet")}
    second = table.merge(spark.createDataFrame([(7, "x", 2, "new"), (1_000, "x", 1, "more")], SCHEMA))
    changed = {b for b in range(16) if first.folders.get(b) != second.folders.get(b)}
    assert 1 <= len(changed) <= 2 and table.read().count() == 501
    assert all(path.stat().st_mtime_ns == time for path, time in files.items())
    assert table.read().where("id = 7").first()["value"] == "new" and table.read(1).where("id = 7").first()["value"] == "v"
    table.remove_before(2)
    assert table.versions() == [2] and table.read().count() == 501


def test_a_failure_before_the_commit_changes_nothing(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(spark.range(50).selectExpr("id", "'x' AS part", "1 AS at", "'v' AS value"), ["id"], buckets=4)
    bad = spark.range(9).selectExpr("id", "'x' AS part", "2 AS at", "if(id = 8, raise_error('lost'), 'n') AS value")
    with pytest.raises(Exception, match="lost"):
        table.merge(bad)
    assert table.versions() == [1] and table.read().where("value = 'v'").count() == 50


def test_writers_that_come_second_fail(spark, tmp_path):
    one = VersionedTable(spark, str(tmp_path / "t"))
    rows = spark.range(10).selectExpr("id", "'x' AS part", "1 AS at", "'v' AS value")
    one.create(rows, ["id"], buckets=2)
    with pytest.raises(ConflictError):
        one.create(rows, ["id"])
    base = one.version()
    one.merge(rows.withColumn("value", F.lit("a")), base=1)
    with pytest.raises(ConflictError):
        one.merge(rows, base=1)
    with pytest.raises(ConflictError):  # based on the first version, and too late to be the second
        one._commit(base, rows)
    assert one.versions() == [1, 2] and {row["value"] for row in one.read().collect()} == {"a"}


def test_empty_tables_and_batches(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.create(spark.createDataFrame([], SCHEMA), ["id", "part"], buckets=3)
    assert table.read().count() == 0 and table.read().columns == ["id", "part", "at", "value"]
    table.merge(spark.createDataFrame([], SCHEMA))
    table.merge(spark.createDataFrame([(None, None, None, None)] * 3, SCHEMA), "at")
    assert table.read().count() == 1
    table.merge(spark.createDataFrame([(None, None, 1, None, True)], CHANGES), "at", "gone")
    assert table.read().count() == 0
