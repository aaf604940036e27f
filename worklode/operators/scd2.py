"""Type-2 history: validity intervals with exactly one open version per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worklode.operators.ranking import shift_spread, shifted, spread


def apply_history(
    history: DataFrame, changes: DataFrame, key: str, attributes: list[str], hash_col: str, at: str, bucket: Column
) -> DataFrame:
    """Next state of a history table.

    ``history`` has key, attributes, hash, ``effective_from``, ``effective_to``, ``is_current``;
    ``changes`` has key, attributes, hash, ``at`` and may hold several rows per key, in any order and also
    older than versions there are (same-day changes included; equal times are ordered by hash).  All
    versions and changes of a changed key are laid on one line: a row whose hash equals the one before it
    changes nothing, and each remaining row is closed by the next.  Where a closed version ends and none
    starts, the key is absent until the next row, so gaps stay gaps.  Keys without changes pass through.
    ``bucket`` coarsens ``effective_from`` to spread hot keys.

    Versions, their ends and changes are shuffled once, by key; all comparisons are windows over that.
    """
    columns = [key, *attributes, hash_col, "effective_from"]
    whole = [*columns, "effective_to", "is_current"]
    blank = {c: F.lit(None).cast(history.schema[c].dataType) for c in [*attributes, hash_col, "effective_to", "is_current"]}
    own = [F.col("effective_to").alias("_to"), F.col("is_current").alias("_now")]
    none = [blank["effective_to"].alias("_to"), blank["is_current"].alias("_now")]
    keyed = history.filter(F.col(key).isNotNull())  # versions without a key have no changes
    starts = keyed.select(*columns, F.lit(1).alias("_kind"), *own)
    nothing = [blank[c].alias(c) for c in [*attributes, hash_col]]
    ends = keyed.filter(F.col("effective_to").isNotNull()).select(key, *nothing, F.col("effective_to").alias("effective_from"), F.lit(0).alias("_kind"), *none)
    incoming = changes.select(key, *attributes, hash_col, F.col(at).alias("effective_from"), F.lit(2).alias("_kind"), *none)
    counted = keyed.select(key, F.lit(False).alias("_c")).union(changes.select(key, F.lit(True).alias("_c")))
    events = spread(starts.unionByName(ends).unionByName(incoming), [key], bucket, counted, _changed=F.max("_c"))

    order = ["effective_from", "_kind", hash_col]
    lot = [key, "_hot", "_bucket"]
    every = (Window.unboundedPreceding, Window.unboundedFollowing)
    of_key = Window.partitionBy(*lot).orderBy(*order).rowsBetween(*every)
    of_time = Window.partitionBy(*lot, "effective_from").orderBy(*order[1:]).rowsBetween(*every)
    is_change = F.col("_kind") == 2
    moved = F.when(F.col(key).isNull(), is_change).when(F.col("_hot"), F.col("_changed")).otherwise(F.max(is_change).over(of_key))
    starting = F.max(F.col("_kind") == 1).over(of_time)
    events = events.withColumns({"_moved": moved, "_starting": starting}).filter((F.col("_kind") > 0) | (F.col("_moved") & ~F.col("_starting")))
    line = shift_spread(events.drop("_changed", "_starting"), [key], order, {"_prev": hash_col, "_prev_kind": "_kind"}, bucket)
    first = F.col("_prev_kind").isNull() | (F.col("_prev_kind") == 0) | (F.col("_kind") == 0)
    kept = line.filter(~F.col("_moved") | first | ~F.col("_prev").eqNullSafe(F.col(hash_col))).drop("_prev", "_prev_kind")
    timed = shift_spread(kept, [key], order, {"_next": "effective_from"}, bucket, back=False).filter("_kind > 0")
    made = timed.select(
        *columns, F.when(F.col("_moved"), F.col("_next")).otherwise(F.col("_to")).alias("effective_to"),
        F.when(F.col("_moved"), F.col("_next").isNull()).otherwise(F.col("_now")).alias("is_current"),
    )
    return history.filter(F.col(key).isNull()).select(*whole).unionByName(made)


def change_kind(history: DataFrame, staged: DataFrame, key: str, hash_col: str) -> DataFrame:
    """INSERT, UPDATE or NOCHANGE per staged key against the open versions."""
    open_rows = history.filter("is_current").select(F.col(key).alias("_k"), F.col(hash_col).alias("_h"))
    joined = staged.join(open_rows, F.col(key) == F.col("_k"), "left")
    kind = (
        F.when(F.col("_k").isNull(), "INSERT")
        .when(~F.col(hash_col).eqNullSafe(F.col("_h")), "UPDATE")
        .otherwise("NOCHANGE")
    )
    return joined.select(key, kind.alias("change_type"))


def close_bridge(bridge: DataFrame, history: DataFrame, fresh: DataFrame, version_key: str, item: str) -> DataFrame:
    """Bridge rows of closed versions are closed with them; fresh rows of open versions are upserted."""
    ends = history.select(F.col(version_key), F.col("effective_to").alias("_end"), F.col("is_current").alias("_open"))
    joined = bridge.join(ends, version_key, "left")
    shut = F.col("is_current") & ~F.coalesce(F.col("_open"), F.lit(True))
    state = joined.withColumns(
        {
            "effective_to": F.when(shut, F.col("_end")).otherwise(F.col("effective_to")),
            "is_current": F.when(shut, F.lit(False)).otherwise(F.col("is_current")),
        }
    ).drop("_end", "_open")
    alive = fresh.join(ends.filter("_open").select(version_key), version_key, "left_semi")
    kept = state.join(alive.select(version_key, item), [version_key, item], "left_anti")
    return kept.unionByName(alive.select(*bridge.columns))


def version_at(history: DataFrame, moment: str) -> DataFrame:
    """Versions valid at a moment."""
    t = F.lit(moment).cast("timestamp")
    return history.filter(
        (F.col("effective_from") <= t) & (F.col("effective_to").isNull() | (t < F.col("effective_to")))
    )


def interval_faults(history: DataFrame, key: str, bucket: Column) -> DataFrame:
    """Gaps and overlaps between consecutive versions of a key, and versions left open too early."""
    line = shifted(history, [key], ["effective_from", "effective_to"], {"next_from": "effective_from"}, bucket, back=False)
    fault = (
        F.when(F.col("next_from").isNull(), None)
        .when(F.col("effective_to").isNull() | (F.col("effective_to") > F.col("next_from")), "OVERLAP")
        .when(F.col("effective_to") < F.col("next_from"), "GAP")
    )
    return line.withColumn("fault", fault).filter(F.col("fault").isNotNull())
