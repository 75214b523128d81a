"""Windows and sessions over tables and streams of files."""

import datetime
import random
from collections import Counter

from pyspark.sql import functions as F

from tests.conftest import day
from tillhouse.sources.versions import VersionedTable
from tillhouse.streaming import windows

SCHEMA = "id int, user string, at timestamp"
START = day("2026-03-01")


def at(minutes):
    return None if minutes is None else START + datetime.timedelta(minutes=minutes)


def rows(seed, count, minutes=range(600)):
    source = random.Random(seed)
    users = ["a", "a", "b", None]
    return [(k, source.choice(users), at(source.choice([*minutes, None]))) for k in range(count)]


def plain_windows(events, width, slide):
    out = Counter()
    for _, user, time in events:
        if time is not None:
            minute = int((time - START).total_seconds() // 60)
            first = (minute // slide) * slide
            for begin in range(first, minute - width, -slide):
                out[at(begin), at(begin + width), user] += 1
    return out


def plain_sessions(events, gap):
    out = []
    for key in {user for _, user, _ in events}:
        times = sorted(time for _, user, time in events if user == key and time is not None)
        found = []
        for time in times:
            if found and time <= found[-1][1]:
                found[-1] = (found[-1][0], time + gap, found[-1][2] + 1)
            else:
                found.append((time, time + gap, 1))
        out += [(begin, end, key, n) for begin, end, n in found]
    return sorted(out, key=repr)


def put(spark, folder, part):
    spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def count():
    return {"events": F.count(F.lit(1))}


def test_windows_of_a_table(spark):
    events = rows(1, 300)
    df = spark.createDataFrame(events, SCHEMA)
    for width, slide in ((30, 30), (60, 20)):
        found = windows.window_totals(df, "at", ["user"], count(), f"{width} minutes", f"{slide} minutes").collect()
        assert {tuple(row)[:3]: row["events"] for row in found} == plain_windows(events, width, slide)


def test_sessions_of_a_table(spark):
    events = rows(2, 250, range(0, 3000, 4))
    expected = plain_sessions(events, datetime.timedelta(minutes=20))
    df = spark.createDataFrame(events, SCHEMA).repartition(4)
    whole = windows.session_totals(df, "at", ["user"], count(), "20 minutes")
    assert sorted(map(tuple, whole.collect()), key=repr) == expected
    for span in ("1 day", "10 minutes"):  # sessions cut many times are joined again
        found = windows.session_counts(df.where("at IS NOT NULL"), "at", ["user"], "20 minutes", span)
        assert sorted(map(tuple, found.collect()), key=repr) == expected


def test_windows_of_a_stream_and_a_restart(spark, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    table = VersionedTable(spark, str(tmp_path / "out"))
    parts = [rows(3, 80, range(200)), rows(4, 80, range(150, 400)), rows(5, 80, range(300, 600))]

    def run():
        stream = windows.stream_files(spark, source, spark.createDataFrame([], SCHEMA).schema, 1)
        totals = windows.window_totals(stream, "at", ["user"], count(), "60 minutes", "30 minutes", late="1 day")
        windows.keep_merged(totals, table, ["window_start", "window_end", "user"], checkpoint, buckets=2)

    put(spark, source, parts[0])
    run()
    put(spark, source, parts[1])
    put(spark, source, parts[2])
    run()  # another query, which goes on from the checkpoint
    run()
    found = {tuple(row)[:3]: row["events"] for row in table.read().collect()}
    assert found == plain_windows(sum(parts, []), 60, 30)


def test_rows_behind_the_watermark_are_left_out(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = spark.createDataFrame([], SCHEMA).schema

    def run():
        totals = windows.window_totals(
            windows.stream_files(spark, source, schema, 1), "at", ["user"], count(), "10 minutes", late="30 minutes"
        )
        windows.append_files(totals, out, str(tmp_path / "checkpoint"))

    put(spark, source, [(1, "a", at(5)), (2, "a", at(100))])
    run()
    put(spark, source, [(3, "a", at(6)), (4, "a", at(95)), (5, "a", at(300))])  # the first comes after its window has closed
    run()
    found = {tuple(row)[:3]: row["events"] for row in spark.read.parquet(out).collect()}
    assert found == {(at(0), at(10), "a"): 1, (at(90), at(100), "a"): 1, (at(100), at(110), "a"): 1}


def test_sessions_of_a_stream(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    parts = [rows(6, 60, range(0, 500, 5)), rows(7, 60, range(400, 900, 5)), [(0, "a", at(5000))]]
    gap = datetime.timedelta(minutes=15)
    for part in parts:
        put(spark, source, part)
        stream = windows.stream_files(spark, source, spark.createDataFrame([], SCHEMA).schema, 1)
        totals = windows.session_totals(stream, "at", ["user"], count(), "15 minutes", late="600 minutes")
        windows.append_files(totals, out, str(tmp_path / "checkpoint"))
    expected = [row for row in plain_sessions(sum(parts, []), gap) if row[1] < at(4000)]
    assert sorted(map(tuple, spark.read.parquet(out).collect()), key=repr) == expected
