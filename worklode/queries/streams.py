"""Streaming queries over the events table; the SQL is the batch form on the same data."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from worklode.queries.registry import query
from worklode.session import shared_dir
from worklode.streaming import streams

TS = "%Y-%m-%d %H:%M:%S"


def place(t) -> str:
    return f"{shared_dir(t.spark)}/run-{uuid.uuid4().hex}"


def text_of(*names: str):
    return [F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n) for n in names]


def arriving(t, root: str, run) -> None:
    """Let the events arrive in three lots by time, and run the stream after each."""
    cuts = [None, "2024-01-11", "2024-01-21", None]
    for low, high in zip(cuts, cuts[1:]):
        lot = t.events
        lot = lot.filter(F.col("ts") >= F.lit(low).cast("timestamp_ntz")) if low else lot
        lot = lot.filter(F.col("ts") < F.lit(high).cast("timestamp_ntz")) if high else lot
        lot.write.mode("append").parquet(f"{root}/landing")
        run(streams.arrivals(t.spark, f"{root}/landing", t.events.schema))


@query("stream_ingest", "ST-01 IO-03", """
    select event_type, count(*) as n, cast(sum(event_id) as bigint) as id_sum from {events} group by 1""")
def _(t):
    root = place(t)
    arriving(t, root, lambda s: streams.run_to_files(s, f"{root}/out", f"{root}/checkpoint"))
    return t.spark.read.parquet(f"{root}/out").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum")
    )


@query("stream_upsert", "ST-02 M-01 M-11", """
    select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from {events}) where rn = 1""")
def _(t):
    root = place(t)

    def run(s):
        latest = streams.latest_per_key(s.select("user_id", "ts", "event_id", "event_type"), ["user_id"], ["ts", "event_id"])
        streams.run_to_changes(latest, f"{root}/out", f"{root}/checkpoint")

    arriving(t, root, run)
    return streams.newest_changes(t.spark, f"{root}/out", ["user_id"]).select("user_id", "event_id", "event_type")


@query("stream_deduplicated", "ST-03 A-01", "select distinct user_id, event_type, props from {events}")
def _(t):
    root = place(t)

    def run(s):
        kept = streams.deduplicated(s, ["user_id", "event_type", "props"], "ts", "60 days")
        streams.run_to_files(kept.select("user_id", "event_type", "props"), f"{root}/out", f"{root}/checkpoint")

    arriving(t, root, run)
    return t.spark.read.parquet(f"{root}/out")


@query("stream_daily_counts", "ST-04 G-01", f"""
    select strftime(date_trunc('day', ts), '{TS}') as window_start, strftime(date_trunc('day', ts) + interval 1 day, '{TS}') as window_end,
           event_type, count(*) as n from {{events}} group by date_trunc('day', ts), event_type""")
def _(t):
    root = place(t)

    def run(s):
        counted = streams.windowed_counts(s, "ts", "60 days", ["event_type"], "1 day")
        streams.run_to_changes(counted, f"{root}/out", f"{root}/checkpoint")

    arriving(t, root, run)
    counts = streams.newest_changes(t.spark, f"{root}/out", ["window_start", "window_end", "event_type"])
    return counts.select(*text_of("window_start", "window_end"), "event_type", "n")


@query("stream_weekly_counts", "ST-04 W-09 W-14", f"""
    with w as (select date_trunc('day', ts) - to_days(cast(k as int)) as s, event_type from {{events}}, generate_series(0, 6) g(k))
    select strftime(s, '{TS}') as window_start, strftime(s + interval 7 day, '{TS}') as window_end, event_type, count(*) as n from w group by s, event_type""")
def _(t):
    root = place(t)

    def run(s):
        counted = streams.windowed_counts(s, "ts", "60 days", ["event_type"], "7 days", "1 day")
        streams.run_to_changes(counted, f"{root}/out", f"{root}/checkpoint")

    arriving(t, root, run)
    counts = streams.newest_changes(t.spark, f"{root}/out", ["window_start", "window_end", "event_type"])
    return counts.select(*text_of("window_start", "window_end"), "event_type", "n")


@query("stream_time_in_state", "ST-05 W-08", f"""
    select event_id, user_id, strftime(lag(ts) over (partition by user_id order by ts, event_id), '{TS}') as previous_at, false as is_late
    from {{events}}""")
def _(t):
    root = place(t)

    def run(s):
        streams.run_to_files(streams.time_in_state(s, "user_id", "ts", "event_id"), f"{root}/out", f"{root}/checkpoint")

    arriving(t, root, run)
    return t.spark.read.parquet(f"{root}/out").select("event_id", "user_id", *text_of("previous_at"), "is_late")


@query("stream_sessions", "ST-05", f"""
    with m as (select *, case when lag(ts) over w is null or ts >= lag(ts) over w + interval 12 hour then 1 else 0 end as starts
               from {{events}} window w as (partition by user_id order by ts, event_id)),
    s as (select user_id, ts, sum(starts) over (partition by user_id order by ts, event_id) as sid from m),
    g as (select user_id, sid, min(ts) as a, max(ts) + interval 12 hour as b, count(*) as n from s group by 1, 2)
    select user_id, strftime(a, '{TS}') as session_start, strftime(b, '{TS}') as session_end, n from g""")
def _(t):
    root = place(t)

    def run(s):
        streams.run_to_changes(streams.sessions(s, "ts", "1 day", "user_id", 12 * 3600), f"{root}/out", f"{root}/checkpoint")

    arriving(t, root, run)
    found = streams.newest_changes(t.spark, f"{root}/out", ["user_id", "session_start"]).filter("n > 0")
    return found.select("user_id", *text_of("session_start", "session_end"), "n")
