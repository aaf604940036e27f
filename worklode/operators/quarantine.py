"""Quarantine life cycle: routing, browsing, review, reprocessing and retention."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.functions.dates import age_days
from worklode.functions.fixed_values import RETENTION_DAYS
from worklode.operators.aggregates import count_where
from worklode.operators.upsert import delete_where, update_where


def route(df: DataFrame, key: str, reason: Column, stage: str, severity: str, at: str) -> DataFrame:
    """Rows with a reason, as quarantine records carrying the whole row as JSON."""
    return df.withColumn("_reason", reason).filter(F.col("_reason").isNotNull()).select(
        F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(stage), F.col("_reason"))).alias("quarantine_key"),
        F.col(key), F.lit(stage).alias("stage"), F.col("_reason").alias("rule_name"), F.lit(severity).alias("severity"),
        F.to_json(F.struct(*[F.col(c) for c in df.columns])).alias("payload_json"),
        F.lit("PENDING").alias("status"), F.lit(at).cast("timestamp").alias("quarantined_at"),
    )


def browse(quarantine: DataFrame, current: DataFrame, key: str, filters: dict[str, object], pattern: tuple[str, str] | None,
           limit: int) -> DataFrame:
    """Newest records meeting the given filters, with the current row they stand for."""
    tests = [F.col(c) == v for c, v in filters.items() if v is not None]
    if pattern:
        tests.append(F.col(pattern[0]).like(pattern[1]))
    found = quarantine.filter(reduce(lambda a, b: a & b, tests, F.lit(True)))
    page = found.orderBy(F.desc("quarantined_at"), "quarantine_id").limit(limit)
    return page.join(current, key, "left")


def reinstate(quarantine: DataFrame, current: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Resolve the listed records and bring their current rows back.  Returns (quarantine, current, log)."""
    picked = ids.select("quarantine_id").distinct().withColumn("_hit", F.lit(True))
    marked = quarantine.join(picked, "quarantine_id", "left")
    open_hit = F.coalesce(F.col("_hit"), F.lit(False)) & (F.col("status") != "RESOLVED")
    log = marked.filter(open_hit).select(
        "quarantine_id", key, F.lit("RESTORE").alias("change_type"), F.col("status").alias("old_status")
    )
    state = update_where(marked.withColumn("_do", open_hit), F.col("_do"), {"status": F.lit("RESOLVED")}).drop("_do", "_hit")
    back = log.select(key).distinct().withColumn("_back", F.lit(True))
    restored = update_where(current.join(back, key, "left"), F.col("_back"), {"is_active": F.lit(True)}).drop("_back")
    return state, restored, log


def discard(quarantine: DataFrame, as_of: str, source=None, rule=None, severity=None, older_than: int | None = None) -> DataFrame:
    """Mark open records that meet all given criteria as DISCARDED; nothing is removed."""
    tests = [F.col("status") == "PENDING"]
    tests += [F.col(c) == v for c, v in (("source_name", source), ("rule_name", rule), ("severity", severity)) if v is not None]
    if older_than is not None:
        tests.append(age_days(as_of, F.col("quarantined_at")) > older_than)
    return update_where(quarantine, reduce(lambda a, b: a & b, tests), {"status": F.lit("DISCARDED")})


def summaries(quarantine: DataFrame) -> DataFrame:
    """Overall, by stage, by rule and severity, and by source, from one grouping-sets pass."""
    cols = [F.col(c) for c in ("stage", "rule_name", "severity", "source_name")]
    sets = [[], [cols[0]], [cols[1], cols[2]], [cols[3]]]
    grouped = quarantine.groupingSets(sets, *cols).agg(
        F.count(F.lit(1)).alias("records"),
        count_where(F.col("status") == "PENDING").alias("pending"),
        F.countDistinct("job_id").alias("jobs"),
        F.grouping_id(*cols).alias("_gid"),
    )
    view = F.when(F.col("_gid") == 15, "overall").when(F.col("_gid") == 7, "stage").when(F.col("_gid") == 9, "rule")
    return grouped.withColumn("view", view.otherwise("source")).drop("_gid")


def age_buckets(quarantine: DataFrame, as_of: str, edges: list[int]) -> DataFrame:
    """Counts by age bucket and status."""
    age, low, label = age_days(as_of, F.col("quarantined_at")), 0, None
    for edge in edges:
        name = F.lit(f"{low}-{edge}")
        label = F.when(age <= edge, name) if label is None else label.when(age <= edge, name)
        low = edge + 1
    return quarantine.groupBy(label.otherwise(f"{low}+").alias("age_bucket"), "status").agg(
        F.count(F.lit(1)).alias("records")
    )


def reprocess(quarantine: DataFrame, payload_schema: str, valid: Column) -> tuple[DataFrame, DataFrame]:
    """Parse RESOLVED payloads with the declared schema.  Returns (rows for the stage's table, next state):
    rows that parse and pass ``valid`` are REPROCESSED, the others REPROCESS_FAILED."""
    parsed = quarantine.withColumn("_p", F.from_json("payload_json", payload_schema))
    good = parsed.select("*", "_p.*").withColumn("_ok", F.coalesce(valid, F.lit(False)))
    resolved = F.col("status") == "RESOLVED"
    fields = parsed.select("_p.*").columns
    rows = good.filter(resolved & F.col("_ok")).select("quarantine_id", "job_id", "stage", *fields)
    state = good.withColumn(
        "status", F.when(resolved & F.col("_ok"), "REPROCESSED").when(resolved, "REPROCESS_FAILED").otherwise(F.col("status"))
    )
    return rows, state.select(*quarantine.columns)


def retention_plan(quarantine: DataFrame, as_of: str, policy: dict[str, dict[str, int]] = RETENTION_DAYS) -> DataFrame:
    """What the policy asks for each record: DELETE, ARCHIVE, ALERT or KEEP, by status and age."""
    age, action = age_days(as_of, F.col("quarantined_at")), F.lit("KEEP")
    for status, limits in policy.items():
        due = F.lit("KEEP")
        for step in ("alert", "archive", "delete"):
            if step in limits:
                due = F.when(age > limits[step], step.upper()).otherwise(due)
        action = F.when(F.col("status") == status, due).otherwise(action)
    return quarantine.withColumn("age_days", age).withColumn("retention_action", action)


def apply_retention(quarantine: DataFrame, archive: DataFrame, as_of: str, policy: dict = RETENTION_DAYS,
                    dry_run: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(quarantine, archive, alerts) after retention.  A record leaves quarantine only once the archive
    holds it: overdue records are archived first and deleted by the next pass that finds them there."""
    plan = retention_plan(quarantine, as_of, policy)
    alerts = plan.filter(F.col("retention_action") == "ALERT").select("quarantine_id", "status", "age_days")
    if dry_run:
        return quarantine, archive, alerts
    due = plan.filter(F.col("retention_action").isin("ARCHIVE", "DELETE"))
    held = archive.select("quarantine_id").withColumn("_held", F.lit(True))
    added = due.join(held, "quarantine_id", "left_anti").select(*archive.columns)
    marked = plan.join(held, "quarantine_id", "left")
    gone = (F.col("retention_action") == "DELETE") & F.coalesce(F.col("_held"), F.lit(False))
    return delete_where(marked, gone).select(*quarantine.columns), archive.unionByName(added), alerts


def stale_pending(quarantine: DataFrame, as_of: str, days: int) -> DataFrame:
    """Sources and rules with records that have waited longer than ``days``."""
    waiting = quarantine.filter((F.col("status") == "PENDING") & (age_days(as_of, F.col("quarantined_at")) > days))
    return waiting.groupBy("source_name", "rule_name").agg(
        F.count(F.lit(1)).alias("waiting"), F.min("quarantined_at").alias("oldest")
    )


def operation_entry(before: DataFrame, after: DataFrame, operation: str, wanted: str) -> DataFrame:
    """Ledger row of a bulk operation: records it looked at, changed, and left as they were."""
    old = before.select("quarantine_id", F.col("status").alias("_old"))
    joined = after.select("quarantine_id", "status").join(old, "quarantine_id", "left")
    changed = ~F.col("status").eqNullSafe(F.col("_old"))
    return joined.agg(
        F.count(F.lit(1)).alias("records_processed"),
        count_where(changed & (F.col("status") == wanted)).alias("records_succeeded"),
        count_where(changed & (F.col("status") != wanted)).alias("records_failed"),
    ).select(F.lit(operation).alias("operation"), "*")
