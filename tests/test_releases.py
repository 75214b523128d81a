"""Releases of table sets: all tables of a run at once, or none."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tillhouse.sources.manifests import ConflictError
from tillhouse.sources.releases import Releases


@pytest.fixture
def releases(spark, tmp_path):
    return Releases(spark, str(tmp_path / "set"))


def ids(df):
    return sorted(row["id"] for row in df.collect())


def test_tables_of_a_run_change_together(spark, releases):
    assert releases.publish({"a": spark.range(3), "b": spark.range(5)}) == 1
    assert releases.publish({"a": spark.range(10, 12)}) == 2
    now, before = releases.read(), releases.read(number=1)
    assert set(now) == {"a", "b"} and ids(now["a"]) == [10, 11] and ids(now["b"]) == [0, 1, 2, 3, 4]
    assert ids(before["a"]) == [0, 1, 2]
    assert list(releases.read(["b"])) == ["b"]
    with pytest.raises(KeyError):
        releases.read(["a", "c"])


def test_a_run_that_fails_is_not_seen(spark, releases):
    releases.publish({"a": spark.range(3), "b": spark.range(5)})
    broken = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(PySparkException):
        releases.publish({"a": spark.range(7, 9), "b": broken})
    assert releases.numbers() == [1]
    assert ids(releases.read()["a"]) == [0, 1, 2] and ids(releases.read()["b"]) == [0, 1, 2, 3, 4]
    assert releases.publish({"a": spark.range(1)}) == 2


def test_of_two_runs_from_one_release_the_second_conflicts(spark, releases):
    releases.publish({"a": spark.range(3)})
    assert releases.publish({"a": spark.range(4)}, base=1) == 2
    with pytest.raises(ConflictError):
        releases.publish({"a": spark.range(5)}, base=1)
    assert len(ids(releases.read()["a"])) == 4


def test_a_table_made_from_itself(spark, releases):
    releases.publish({"a": spark.range(3)})
    releases.publish({"a": releases.read()["a"].select((F.col("id") * 2).alias("id"))})
    assert ids(releases.read()["a"]) == [0, 2, 4]


def test_old_releases_are_removed_with_what_only_they_name(spark, releases):
    releases.publish({"a": spark.range(3), "b": spark.range(5)})
    releases.publish({"a": spark.range(4)})
    releases.remove_before(2)
    assert releases.numbers() == [2]
    assert len(ids(releases.read()["a"])) == 4 and len(ids(releases.read()["b"])) == 5
    with pytest.raises(KeyError):
        releases.remove_before(1)


def test_empty_tables_keep_their_columns(spark, releases):
    releases.publish({"a": spark.range(0).withColumn("text", F.lit("x"))})
    found = releases.read()["a"]
    assert found.columns == ["id", "text"] and found.count() == 0
