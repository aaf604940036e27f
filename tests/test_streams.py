"""Streams over several lots and restarts, against plain Python on the same rows."""

import datetime as dt
import random

from worklode.streaming import streams

EPOCH = dt.datetime(2024, 1, 1)
SCHEMA = "k long, at timestamp, e long"


def minutes(n):
    return EPOCH + dt.timedelta(minutes=n)


def land(spark, path, rows):
    spark.createDataFrame([(k, minutes(m), e) for k, m, e in rows], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def arriving(spark, tmp_path, lots, run):
    """A new stream per lot, so that each one goes on from the checkpoint of the one before; then one with nothing new."""
    for lot in [*lots, []]:
        if lot:
            land(spark, f"{tmp_path}/in", lot)
        run(streams.arrivals(spark, f"{tmp_path}/in", spark.createDataFrame([], SCHEMA).schema))


def test_latest_per_key_ignores_late_rows(spark, tmp_path):
    lots = [[(1, 10, 1), (2, 5, 2)], [(1, 4, 3), (2, 5, 4), (3, 1, 5)], [(None, 2, 6)]]
    out = f"{tmp_path}/out"
    arriving(spark, tmp_path, lots, lambda s: streams.run_to_changes(streams.latest_per_key(s, ["k"], ["at", "e"]), out, f"{tmp_path}/cp"))
    got = {r.k: r.e for r in streams.newest_changes(spark, out, ["k"]).collect()}
    assert got == {1: 1, 2: 4, 3: 5, None: 6}


def test_a_repeated_batch_replaces_its_own_changes(spark, tmp_path):
    out = f"{tmp_path}/out"
    lots = [[(1, 1, 1)], [(2, 2, 2)]]
    arriving(spark, tmp_path, lots, lambda s: streams.run_to_changes(streams.latest_per_key(s, ["k"], ["at", "e"]), out, f"{tmp_path}/cp"))
    again = spark.read.parquet(out).filter("batch = 1").drop("batch").collect()
    spark.createDataFrame(again, "k long, at timestamp, e long").write.mode("overwrite").parquet(f"{out}/batch=1")
    assert {r.k: r.e for r in streams.newest_changes(spark, out, ["k"]).collect()} == {1: 1, 2: 2}


def test_time_in_state_marks_late_events(spark, tmp_path):
    lots = [[(1, 4, 2), (1, 1, 1), (2, 3, 3)], [(1, 2, 4), (1, 9, 5), (2, 3, 6), (2, 3, 1), (None, 1, 7)], [(1, 9, 8), (None, 1, 9)]]
    out = f"{tmp_path}/out"
    arriving(spark, tmp_path, lots, lambda s: streams.run_to_files(streams.time_in_state(s, "k", "at", "e"), out, f"{tmp_path}/cp"))
    got = sorted(((r.k or 0), r.at, r.e, r.previous_at, r.is_late) for r in spark.read.parquet(out).collect())
    want = [(0, 1, 7, None, False), (0, 1, 9, 1, False), (1, 1, 1, None, False), (1, 2, 4, None, True), (1, 4, 2, 1, False),
            (1, 9, 5, 4, False), (1, 9, 8, 9, False), (2, 3, 1, None, True), (2, 3, 3, None, False), (2, 3, 6, 3, False)]
    assert got == [(k, minutes(a), e, None if b is None else minutes(b), late) for k, a, e, b, late in want]


def plain_sessions(rows, gap):
    found = []
    for k in {k for k, _, _ in rows}:
        times = sorted(m for kk, m, _ in rows if kk == k)
        start, last, n = times[0], times[0], 1
        for m in times[1:]:
            if m < last + gap:
                last, n = m, n + 1
            else:
                found.append((k, start, last + gap, n))
                start, last, n = m, m, 1
        found.append((k, start, last + gap, n))
    return sorted(found)


def test_sessions_grow_and_merge_over_lots(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.randrange(2000), i) for i in range(300)]
    rows += [(9, 0, 1000), (9, 20, 1001), (9, 10, 1002)]
    rows.sort(key=lambda r: r[1] + rng.randrange(120))
    lots = [rows[:100], rows[100:200], rows[200:]]
    out = f"{tmp_path}/out"
    arriving(spark, tmp_path, lots, lambda s: streams.run_to_changes(streams.sessions(s, "at", "3 hours", "k", 600), out, f"{tmp_path}/cp"))
    found = streams.newest_changes(spark, out, ["k", "session_start"]).filter("n > 0").collect()
    got = sorted((r.k, r.session_start, r.session_end, r.n) for r in found)
    assert got == [(k, minutes(a), minutes(b), n) for k, a, b, n in plain_sessions(rows, 10)]


def test_sessions_joined_by_a_later_event(spark, tmp_path):
    lots = [[(1, 0, 1), (1, 15, 2)], [(1, 8, 3)]]
    out = f"{tmp_path}/out"
    arriving(spark, tmp_path, lots, lambda s: streams.run_to_changes(streams.sessions(s, "at", "1 hour", "k", 600), out, f"{tmp_path}/cp"))
    newest = {r.session_start: r.n for r in streams.newest_changes(spark, out, ["k", "session_start"]).collect()}
    assert newest == {minutes(0): 3, minutes(15): 0}
