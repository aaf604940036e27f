"""Batch control, audit summaries and monitoring, all from aggregates over audit tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.functions.dates import age_days
from worklode.operators.aggregates import count_where, guarded_ratio
from worklode.operators.upsert import upsert


def advance_watermarks(marks: DataFrame, batches: DataFrame, source: str, at: str) -> DataFrame:
    """Per-source high-water mark after a set of batches; only successful batches move it, never back."""
    done = batches.filter(F.col("status") == "SUCCESS").groupBy(source).agg(F.max(at).alias("_new"))
    moved = done.join(marks, source, "left").select(source, F.greatest("_new", "high_water_mark").alias("high_water_mark"))
    return upsert(marks, moved, [source])


def batch_ledger(staged: DataFrame, batch: list[str], failed: Column, run_id: str) -> DataFrame:
    """One ledger row per processed batch: rows in, rows out, status."""
    counts = staged.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("records_in"), count_where(~failed).alias("records_out"), count_where(failed).alias("records_failed")
    )
    status = F.when(F.col("records_out") == 0, "FAILED").otherwise("SUCCESS")
    return counts.withColumns({"status": status, "run_id": F.lit(run_id)})


def checked_entries(entries: DataFrame, enums: dict[str, list[str]]) -> tuple[DataFrame, DataFrame]:
    """Split audit rows into (accepted, refused) by their enumerated columns."""
    good = reduce(lambda a, b: a & b, [F.coalesce(F.col(c).isin(v), F.lit(False)) for c, v in enums.items()])
    return entries.filter(good), entries.filter(~good)


def run_summary(runs: DataFrame, as_of: str, days: int) -> DataFrame:
    """Runs per day and environment with outcome counts and mean run time."""
    recent = runs.filter(age_days(as_of, F.col("started_at")) <= days)
    return recent.groupBy(F.to_date("started_at").alias("run_day"), "environment").agg(
        F.count(F.lit(1)).alias("runs"),
        count_where(F.col("status") == "SUCCESS").alias("succeeded"),
        count_where(F.col("status").isin("FAILURE", "FAILED")).alias("failed"),
        guarded_ratio(F.sum("runtime_seconds"), F.count(F.lit(1))).alias("avg_seconds"),
        F.sum("rows_written").alias("rows_written"),
    )


def rule_summary(results: DataFrame, as_of: str, days: int) -> DataFrame:
    """Per severity: results, failures, the failing rules by name (as many as the catalog has), and a status word."""
    recent = results.filter(age_days(as_of, F.col("evaluated_at")) <= days)
    counts = recent.groupBy("severity").agg(
        F.count(F.lit(1)).alias("results"), count_where(F.col("status") == "FAIL").alias("failures"),
        F.sum("failed_records").alias("failed_records"),
    )
    names = recent.filter(F.col("status") == "FAIL").select("severity", "rule_name").distinct()
    listed = names.groupBy("severity").agg(
        F.array_join(F.sort_array(F.collect_list("rule_name")), ", ").alias("failing_rules")
    )
    state = F.when((F.col("severity") == "ERROR") & (F.col("failures") > 0), "CRITICAL").when(
        F.col("failures") > 0, "ATTENTION"
    )
    return counts.join(listed, "severity", "left").withColumn("state", state.otherwise("OK"))


def access_summary(access: DataFrame) -> DataFrame:
    """Per user: attempts, denials, resources touched and a threat level from the denials."""
    counts = access.groupBy("user_name").agg(
        F.count(F.lit(1)).alias("attempts"),
        count_where(F.col("access_result") == "DENIED").alias("denied"),
        F.countDistinct("resource").alias("resources"),
    )
    level = F.when(F.col("denied") >= 10, "HIGH").when(F.col("denied") >= 5, "MEDIUM").when(F.col("denied") > 0, "LOW")
    return counts.withColumn("threat_level", level.otherwise("NONE"))


def needing_attention(runs: DataFrame, as_of: str, days: int, least_failures: int, limit: int) -> DataFrame:
    """Job names with repeated failures, worst first."""
    recent = runs.filter(age_days(as_of, F.col("started_at")) <= days)
    counts = recent.groupBy("run_name").agg(
        F.count(F.lit(1)).alias("runs"),
        count_where(F.col("status").isin("FAILURE", "FAILED", "TIMEOUT")).alias("failures"),
        F.max("started_at").alias("last_run"),
    )
    bad = counts.filter(F.col("failures") >= least_failures)
    return bad.orderBy(F.desc("failures"), "run_name").limit(limit)


def layer_freshness(layers: dict[str, tuple[DataFrame, str]], as_of: str, hours: int) -> DataFrame:
    """Rows, newest time and age in hours of each layer, with a verdict."""
    def one(name: str, df: DataFrame, at: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias("row_count"), F.max(F.col(at).cast("timestamp_ntz")).alias("newest")).select(
            F.lit(name).alias("layer"), "row_count", "newest"
        )

    rows = reduce(lambda a, b: a.unionByName(b), [one(n, d, c) for n, (d, c) in layers.items()])
    # Without zones, so that the age does not depend on the session's.
    age = F.timestamp_diff("HOUR", F.date_trunc("second", "newest").cast("timestamp_ntz"), F.lit(as_of).cast("timestamp_ntz"))
    return rows.withColumn("age_hours", age).withColumn("is_fresh", F.coalesce(F.col("age_hours") <= hours, F.lit(False)))


def missing_days(records: DataFrame, source: str, at: str, first: str, last: str) -> DataFrame:
    """Days of the expected spine on which a source delivered nothing."""
    seen = records.select(source, F.to_date(at).alias("day")).distinct()
    spine = seen.select(source).distinct().withColumn(
        "day", F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
    )
    return spine.join(seen, [source, "day"], "left_anti")


def audit_report(runs: DataFrame, results: DataFrame, access: DataFrame, as_of: str, days: int) -> DataFrame:
    """(section, metric, value) rows of the periodic report, one aggregate per audit table."""
    def section(name: str, df: DataFrame, at: str, metrics: dict[str, Column]) -> DataFrame:
        row = df.filter(age_days(as_of, F.col(at)) <= days).agg(*[m.alias(n) for n, m in metrics.items()])
        pairs = F.explode(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in metrics]))
        return row.select(pairs.alias("_p")).select(F.lit(name).alias("section"), "_p.*")

    failed = F.col("status").isin("FAILURE", "FAILED")
    return (
        section("runs", runs, "started_at", {
            "total": F.count(F.lit(1)), "failed": count_where(failed), "rows_written": F.sum("rows_written"),
            "success_rate": guarded_ratio(count_where(F.col("status") == "SUCCESS"), F.count(F.lit(1)))})
        .unionByName(section("rules", results, "evaluated_at", {
            "total": F.count(F.lit(1)), "failed": count_where(F.col("status") == "FAIL"),
            "pass_rate": guarded_ratio(count_where(F.col("status") == "PASS"), F.count(F.lit(1)))}))
        .unionByName(section("access", access, "accessed_at", {
            "total": F.count(F.lit(1)), "denied": count_where(F.col("access_result") == "DENIED"),
            "users": F.countDistinct("user_name")}))
    )
