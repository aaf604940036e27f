"""Upserts as DataFrame functions: each returns the next state of the table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.operators.ranking import best_per_key


def _match(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys])


def one_row_per_key(source: DataFrame, keys: list[str]) -> DataFrame:
    """``source`` itself; a repeated key stops the job with a clear error, as a merge would."""
    counts = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    checked = counts.filter(
        F.when(F.col("_n") > 1, F.raise_error(F.lit(f"merge source repeats a key of {keys}")).cast("boolean")).otherwise(
            F.lit(True)
        )
    )
    return source.join(checked.drop("_n"), keys, "left_semi")


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``source`` replace rows of ``target`` with the same key; the others stay."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.unionByName(source, allowMissingColumns=True)


def update_columns(
    target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], insert: bool = False
) -> DataFrame:
    """Matched target rows take ``columns`` from the source; optionally insert unmatched source rows."""
    marked = source.select(*keys, *columns).withColumn("_hit", F.lit(True))
    joined = target.alias("t").join(marked.alias("s"), _match(keys), "left")
    taken = [
        (F.when(F.col("s._hit"), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")) if c in columns else F.col(f"t.{c}")).alias(c)
        for c in target.columns
    ]
    updated = joined.select(*taken)
    if not insert:
        return updated
    fresh = source.join(target.select(*keys), keys, "left_anti")
    return updated.unionByName(fresh.select(*[c for c in target.columns if c in fresh.columns]), allowMissingColumns=True)


def insert_new(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Add only source rows whose key the target lacks."""
    return target.unionByName(source.join(target.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def update_where(df: DataFrame, condition: Column, values: dict[str, Column]) -> DataFrame:
    """Set columns on the rows that meet a condition."""
    hit = F.coalesce(condition, F.lit(False))
    return df.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in values.items()})


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows that meet a condition; rows for which it is unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def compared(staged: DataFrame, current: DataFrame, key: str, source: str, as_of: str, stale_days: int) -> DataFrame:
    """One full outer join of a load with the state before it: the key, ``change_type``, and both rows as ``old`` and ``new``.

    The type is INSERT, UPDATE, DELETE, UNCHANGED or KEEP.  DELETE needs the key to be absent from the staged rows, active,
    last seen more than ``stale_days`` before ``as_of``, and its source to be among the staged sources (an unread source
    deletes nothing), however many these are.  Classes, next state and log are read from this one result.
    """
    read = staged.filter(F.col(source).isNotNull()).select(F.col(source).alias("_read")).distinct()
    s = staged.select(*[F.col(c).alias(f"_s_{c}") for c in staged.columns])
    marked = current.join(read, F.col(source) == F.col("_read"), "left")
    c = marked.select("_read", *[F.col(c).alias(f"_c_{c}") for c in current.columns])
    sk, ck = F.col(f"_s_{key}"), F.col(f"_c_{key}")
    stale = F.datediff(F.lit(as_of).cast("date"), F.col("_c_last_seen")) > stale_days
    kind = (
        F.when(ck.isNull(), "INSERT")
        .when(sk.isNotNull() & ~F.col("_s_record_hash").eqNullSafe(F.col("_c_record_hash")), "UPDATE")
        .when(sk.isNotNull(), "UNCHANGED")
        .when(F.col("_c_is_active") & stale & F.col("_read").isNotNull(), "DELETE")
        .otherwise("KEEP")
    )

    def whole(side: str, df: DataFrame, there: Column, name: str) -> Column:
        return F.when(there.isNotNull(), F.struct(*[F.col(f"{side}{c}").alias(c) for c in df.columns])).alias(name)

    joined = s.join(c, sk == ck, "full")
    return joined.select(F.coalesce(sk, ck).alias(key), kind.alias("change_type"), whole("_c_", current, ck, "old"), whole("_s_", staged, sk, "new"))


def classify_changes(staged: DataFrame, current: DataFrame, key: str, source: str, as_of: str, stale_days: int) -> DataFrame:
    """The class of every key, with its source and both hashes (see ``compared``)."""
    both = compared(staged, current, key, source, as_of, stale_days)
    return both.select(
        key, F.coalesce(f"new.{source}", f"old.{source}").alias(source), "change_type",
        F.col("old.record_hash").alias("old_hash"), F.col("new.record_hash").alias("new_hash"),
    )


def apply_changes(both: DataFrame) -> DataFrame:
    """Current state after a load, from ``compared``: inserted and updated rows as staged, deletes deactivated, the others as
    they were."""
    columns = both.select("old.*").columns
    taken = F.col("change_type").isin("INSERT", "UPDATE")
    state = {c: F.when(taken, F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")) for c in columns}
    state["is_active"] = F.when(F.col("change_type") == "DELETE", F.lit(False)).otherwise(state["is_active"])
    return both.select(*[value.alias(c) for c, value in state.items()])


def latest_change(changes: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One change per key, the latest."""
    return best_per_key(changes, keys, order)


#: How rows are written to a log and read back without loss.
LOG_FORMAT = {"ignoreNullFields": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def change_log(staged: DataFrame, current: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """INSERT / UPDATE / DELETE rows: which of ``columns`` changed, and both whole rows as JSON."""
    old = current.select(F.col(key).alias("_ok"), F.struct(*current.columns).alias("_old"))
    new = staged.select(F.col(key).alias("_nk"), F.struct(*staged.columns).alias("_new"))
    joined = new.join(old, F.col("_nk") == F.col("_ok"), "full")
    changed = F.filter(
        F.array(*[F.when(~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")), F.lit(c)) for c in columns]),
        lambda c: c.isNotNull(),
    )
    both = F.col("_ok").isNotNull() & F.col("_nk").isNotNull()
    kind = F.when(F.col("_ok").isNull(), "INSERT").when(F.col("_nk").isNull(), "DELETE").otherwise("UPDATE")
    return (
        joined.withColumn("changed_columns", F.when(both, changed))
        .filter(~both | (F.size("changed_columns") > 0))
        .select(
            F.coalesce("_nk", "_ok").alias(key), kind.alias("change_type"), "changed_columns",
            F.to_json("_old", LOG_FORMAT).alias("old_value_json"), F.to_json("_new", LOG_FORMAT).alias("new_value_json"),
        )
    )


def undo_batch(current: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Take a batch back by one join with its log: inserted keys go, updated and deleted keys get their whole old rows.

    A key that was deleted and is there again by now gets its old row too; rows the log does not name stay.
    """
    old = log.select(F.col(key).alias("_lk"), "change_type", F.from_json("old_value_json", current.schema, LOG_FORMAT).alias("_old"))
    joined = current.join(old, F.col(key) == F.col("_lk"), "full").filter("change_type is null or change_type <> 'INSERT'")
    return joined.select(*[F.when(F.col("_lk").isNotNull(), F.col(f"_old.{c}")).otherwise(F.col(c)).alias(c) for c in current.columns])


def soft_delete(
    current: DataFrame, ids: DataFrame, key: str, delete: bool, reason: str, as_of: str
) -> tuple[DataFrame, DataFrame]:
    """Flag (or restore) the listed keys.  Returns the new state and the change-log rows, both taken
    from the state before the update; keys already in the wanted state produce no log row."""
    wanted = ids.select(key).distinct().withColumn("_hit", F.lit(True))
    joined = current.join(wanted, key, "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False)) & (F.coalesce(F.col("soft_delete_flag"), F.lit(False)) != F.lit(delete))
    log = joined.filter(hit).select(
        key,
        F.lit("DELETE" if delete else "RESTORE").alias("change_type"),
        F.to_json(F.struct("is_active", "soft_delete_flag")).alias("old_value_json"),
        F.to_json(F.struct(F.lit(not delete).alias("is_active"), F.lit(delete).alias("soft_delete_flag"))).alias(
            "new_value_json"
        ),
        F.lit(reason).alias("change_reason"),
        F.lit(as_of).cast("timestamp").alias("changed_at"),
    )
    state = update_where(
        joined.withColumn("_do", hit), F.col("_do"),
        {
            "is_active": F.lit(not delete),
            "soft_delete_flag": F.lit(delete),
            "soft_delete_reason": F.lit(reason if delete else None).cast("string"),
        },
    ).drop("_hit", "_do")
    return state, log


def roll_back_batch(
    current: DataFrame, ledger: DataFrame, batch_id, batch_col: str, dry_run: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Take a batch out: its ledger rows become ROLLED_BACK and its records are soft-deleted.

    Returns (state, ledger, audit).  A batch already rolled back is left alone; a dry run only audits.
    """
    pending = (F.col(batch_col) == F.lit(batch_id)) & (F.col("status") != "ROLLED_BACK")
    target = ledger.filter(pending).select(batch_col).distinct().withColumn("_hit", F.lit(True))
    marked = current.join(target, batch_col, "left")
    touched = F.coalesce(F.col("_hit"), F.lit(False)) & ~F.coalesce(F.col("soft_delete_flag"), F.lit(False))
    audit = marked.agg(F.count(F.when(touched, 1)).alias("records_affected")).select(
        F.lit(batch_id).alias(batch_col), "records_affected", F.lit(dry_run).alias("dry_run")
    )
    if dry_run:
        return current, ledger, audit
    state = update_where(
        marked.withColumn("_do", touched), F.col("_do"),
        {"is_active": F.lit(False), "soft_delete_flag": F.lit(True), "soft_delete_reason": F.lit("BATCH_ROLLBACK")},
    ).drop("_hit", "_do")
    return state.select(*current.columns), update_where(ledger, pending, {"status": F.lit("ROLLED_BACK")}), audit
