"""Structured Streaming forms of the incremental operators.

Every stream is bounded by ``availableNow``: it reads what has arrived, ends, and goes on from its
checkpoint at the next run.  What a stream remembers is Spark's own keyed state; sinks only ever add
files, so neither state nor result is written anew per micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def arrivals(
    spark: SparkSession, path: str, schema: T.StructType, pattern: str = "*.parquet", max_bytes: str | None = None
) -> DataFrame:
    """Files as they arrive in a folder; ``max_bytes`` (such as ``4g``) bounds a micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    return (reader.option("maxBytesPerTrigger", max_bytes) if max_bytes else reader).parquet(path)


def run_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append the stream's output to a folder and wait for the end of what has arrived."""
    query = (
        stream.writeStream.outputMode("append").format("parquet").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def run_to_changes(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write the rows that a micro-batch changed to a folder of that batch (``batch=<number>``).

    A repeated micro-batch replaces its own folder and no other, so a restart changes nothing.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    query = (
        stream.writeStream.outputMode("update").foreachBatch(each)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def newest_changes(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The last written row of every key, folded before the shuffle."""
    changes = spark.read.parquet(path)
    rest = [c for c in changes.columns if c not in (*keys, "batch")]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("_row")).select(*keys, "_row.*")


def latest_per_key(stream: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the largest ``order`` per key.  Rows compete by their own columns: late or repeated ones change nothing."""
    rest = [c for c in stream.columns if c not in keys]
    best = F.max_by(F.struct(*rest), F.struct(*order))
    return stream.groupBy(*keys).agg(best.alias("_row")).select(*keys, "_row.*")


def timed(stream: DataFrame, at: str, delay: str) -> DataFrame:
    """Watermark on ``at``; zoneless times are read in the session's zone, as watermarks need instants."""
    return stream.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)


def deduplicated(stream: DataFrame, keys: list[str], at: str, delay: str) -> DataFrame:
    """First arrival per key; keys are remembered until the watermark has passed them."""
    return timed(stream, at, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, at: str, delay: str, keys: list[str], size: str, slide: str | None = None) -> DataFrame:
    """Counts per key and tumbling (or sliding) window; rows later than the watermark are dropped."""
    span = F.window(at, size, slide) if slide else F.window(at, size)
    counted = timed(stream, at, delay).groupBy(span, *keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *keys, "n")


def sessions(stream: DataFrame, at: str, delay: str, key: str, gap_seconds: int) -> DataFrame:
    """Changes of the activity sessions per key: (key, session_start, session_end, n), for update mode.

    Open sessions come out as well, and again whenever they grow; ``n`` = 0 says that the session which began
    there is now part of an earlier one.  State holds the sessions that the watermark has not passed;
    the events of a key are folded one Arrow batch at a time and never held together.
    """
    gap = gap_seconds * 1_000_000
    key_type = stream.schema[key].dataType.simpleString()

    def merged(starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        by_start = np.argsort(starts, kind="stable")
        starts, ends, counts = starts[by_start], ends[by_start], counts[by_start]
        reach = np.maximum.accumulate(ends)
        first = np.flatnonzero(np.r_[True, starts[1:] >= reach[:-1]])
        return starts[first], np.maximum.reduceat(ends, first), np.add.reduceat(counts, first)

    def fold(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = [np.array(a, dtype=np.int64) for a in state.get] if state.exists else [np.empty(0, np.int64)] * 3
        known = {int(a): (int(b), int(c)) for a, b, c in zip(*held)}
        for frame in frames:
            us = frame["_us"].to_numpy(np.int64)
            held = list(merged(*(np.r_[a, b] for a, b in zip(held, (us, us + gap, np.ones_like(us))))))
        now = {int(a): (int(b), int(c)) for a, b, c in zip(*held)}
        rows = [(a, *bc) for a, bc in now.items() if known.get(a) != bc]
        rows += [(a, b, 0) for a, (b, _) in known.items() if a not in now]
        passed = state.getCurrentWatermarkMs() * 1000
        still = held[1] > passed
        if still.any():
            state.update(tuple(a[still].tolist() for a in held))
            state.setTimeoutTimestamp(-(-int(held[1].max()) // 1000))
        elif state.exists:
            state.remove()
        yield pd.DataFrame({key: [k[0]] * len(rows), "a": [r[0] for r in rows], "b": [r[1] for r in rows], "n": [r[2] for r in rows]})

    keyed = timed(stream, at, delay).filter(F.col(at).isNotNull()).select(key, at, F.unix_micros(at).alias("_us"))
    folded = keyed.groupBy(key).applyInPandasWithState(
        fold, f"`{key}` {key_type}, a long, b long, n long",
        "starts array<long>, ends array<long>, counts array<long>", "update", GroupStateTimeout.EventTimeTimeout,
    )
    return folded.select(
        key, F.timestamp_micros("a").alias("session_start"), F.timestamp_micros("b").alias("session_end"), "n"
    )


def time_in_state(stream: DataFrame, key: str, at: str, event: str) -> DataFrame:
    """Each event with the time of the key's event before it: (event, key, at, previous_at, is_late).

    ``event`` is a whole-number id that orders events of one time.  State is the last event per key.  An event
    not later than that is late: it comes out too, marked and without a previous time, and leaves the state as it
    is.  A task holds two numbers per event of a key and micro-batch; ``arrivals(max_bytes=...)`` bounds that.
    """
    key_type = stream.schema[key].dataType.simpleString()

    def line(k: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows = pd.concat([f[["_us", "_id"]] for f in frames]).sort_values(["_us", "_id"], ignore_index=True)
        late = np.zeros(len(rows), dtype=bool)
        last = state.get if state.exists else None
        if last:
            late = ((rows["_us"] < last[0]) | ((rows["_us"] == last[0]) & (rows["_id"] <= last[1]))).to_numpy()
        fresh = rows[~late]
        before = fresh["_us"].shift(1).astype("Int64")
        if last and len(fresh):
            before.iloc[0] = last[0]
        if len(fresh):
            state.update((int(fresh["_us"].iloc[-1]), int(fresh["_id"].iloc[-1])))
        out = pd.DataFrame({key: k[0], "_id": rows["_id"], "_us": rows["_us"], "_before": before.reindex(rows.index), "is_late": late})
        yield out

    keyed = stream.filter(F.col(at).isNotNull() & F.col(event).isNotNull()).select(
        key, F.unix_micros(F.col(at).cast("timestamp")).alias("_us"), F.col(event).cast("long").alias("_id")
    )
    lined = keyed.groupBy(key).applyInPandasWithState(
        line, f"`{key}` {key_type}, _id long, _us long, _before long, is_late boolean", "us long, id long", "append",
        GroupStateTimeout.NoTimeout,
    )
    return lined.select(
        F.col("_id").alias(event), key, F.timestamp_micros("_us").alias(at),
        F.timestamp_micros("_before").alias("previous_at"), "is_late",
    )
