"""Facts and dimensions of the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.functions.dates import date_key
from worklode.functions.text import location_parts
from worklode.operators.aggregates import count_where
from worklode.operators.joins import UNKNOWN_KEY, value_as_of
from worklode.operators.keys import extend_keys
from worklode.operators.ranking import best_per_key, shifted


def lifecycle_class() -> Column:
    """Class of a change row; the first rule that holds wins."""
    old_on, new_on = F.col("old_is_active"), F.col("new_is_active")
    old_gone, new_gone = F.col("old_soft_delete"), F.col("new_soft_delete")
    kind = F.col("change_type")
    return (
        F.when(kind == "INSERT", "JOB_CREATED")
        .when(kind == "DELETE", "JOB_DELETED")
        .when((old_on == "false") & (new_on == "true"), "JOB_ACTIVATED")
        .when((old_on == "true") & (new_on == "false"), "JOB_DEACTIVATED")
        .when((old_gone == "false") & (new_gone == "true"), "JOB_SOFT_DELETED")
        .when((old_gone == "true") & (new_gone == "false"), "JOB_RESTORED")
        .when(kind == "UPDATE", "JOB_UPDATED")
        .otherwise("UNKNOWN_TRANSITION")
    )


def date_dimension(df: DataFrame, first: Column, last: Column, fiscal_start_month: int = 1) -> DataFrame:
    """One row per day between two bounds taken from ``df`` (aggregate expressions).

    The fiscal year is named after the calendar year it starts in; Monday is day 1.
    """
    days = df.agg(first.cast("date").alias("a"), last.cast("date").alias("b")).select(
        F.explode(F.sequence("a", "b")).alias("date_value")
    )
    d = F.col("date_value")
    month, day = F.month(d), F.dayofmonth(d)
    ends = F.last_day(d) == d
    return days.select(
        date_key(d).alias("date_sk"), "date_value", F.year(d).alias("year"), F.quarter(d).alias("quarter"),
        month.alias("month"), F.date_format(d, "MMMM").alias("month_name"), day.alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week"), F.date_format(d, "EEEE").alias("day_of_week_name"),
        F.dayofyear(d).alias("day_of_year"), F.weekofyear(d).alias("week_of_year"),
        (F.weekday(d) >= 5).alias("is_weekend"), (day == 1).alias("is_month_start"), ends.alias("is_month_end"),
        ((month % 3 == 1) & (day == 1)).alias("is_quarter_start"), ((month % 3 == 0) & ends).alias("is_quarter_end"),
        ((month == 1) & (day == 1)).alias("is_year_start"), ((month == 12) & (day == 31)).alias("is_year_end"),
        (F.year(d) - F.when(month >= fiscal_start_month, 0).otherwise(1)).alias("fiscal_year"),
        (F.floor(((month - fiscal_start_month + 12) % 12) / 3) + 1).cast("int").alias("fiscal_quarter"),
    )


def source_dimension(records: DataFrame, existing: DataFrame, source: str, seen: str, kinds: DataFrame) -> DataFrame:
    """Sources with first and last sighting and a kind looked up by name."""
    ends = records.groupBy(F.col(source).alias("source_name")).agg(
        F.min(seen).alias("first_seen"), F.max(seen).alias("last_seen"), F.count(F.lit(1)).alias("record_count")
    )
    keyed = extend_keys(existing, ends, ["source_name"], "source_sk")
    return keyed.join(kinds, "source_name", "left").fillna({"source_kind": "UNKNOWN"})


def taxonomy_dimension(taxonomy: DataFrame, existing: DataFrame, natural: str, id_col: str, words: str) -> DataFrame:
    """Dimension from a taxonomy whose word list is pipe-separated; keys of known entries are kept."""
    listed = taxonomy.withColumn(words, F.filter(F.transform(F.split(words, r"\|"), lambda w: F.trim(w)), lambda w: w != ""))
    return extend_keys(existing, listed, [natural], id_col)


def role_dimension(roles: DataFrame, families: DataFrame, existing: DataFrame) -> DataFrame:
    """Roles with their family name and seniority flags."""
    joined = roles.join(families, "family_key", "left").withColumns(
        {
            "is_senior": F.col("seniority").isin("senior", "executive"),
            "is_executive": F.col("seniority") == "executive",
        }
    )
    return extend_keys(existing, joined, ["role_key"], "role_sk")


def location_dimension(postings: DataFrame, existing: DataFrame, location: str) -> DataFrame:
    """Distinct locations split into city, state and country; a remote reading wins over an on-site one."""
    seen = postings.filter(F.col(location).isNotNull()).groupBy(F.col(location).alias("location_name")).agg(
        F.max(F.col("remote_type") == "REMOTE").alias("is_remote")
    )
    parts = location_parts(F.col("location_name"))
    return extend_keys(existing, seen.select("location_name", "is_remote", *parts), ["location_name"], "location_sk")


def company_dimension(companies: DataFrame, mappings: DataFrame, existing: DataFrame) -> DataFrame:
    """Companies with the number, mean confidence and best method of their name mappings."""
    stats = mappings.groupBy("company_name").agg(
        F.count(F.lit(1)).alias("mapping_count"),
        F.sum(F.col("confidence").cast("decimal(18,4)")).cast("double").alias("confidence_total"),
        F.min_by("method", F.struct((-F.col("confidence")).alias("c"), "method")).alias("best_method"),
    )
    joined = companies.join(stats, "company_name", "left").fillna({"mapping_count": 0})
    return extend_keys(existing, joined, ["company_name"], "company_sk")


def company_aliases(mappings: DataFrame, companies: DataFrame, existing: DataFrame) -> DataFrame:
    """Aliases read from the JSON explanation of each mapping, one row per company and alias."""
    said = mappings.withColumn("alias", F.get_json_object("explanation_json", "$.input"))
    joined = said.join(companies.select("company_name", "company_sk"), "company_name").filter(
        F.col("alias").isNotNull() & (F.col("alias") != F.col("company_name"))
    )
    grouped = joined.groupBy("company_sk", "alias").agg(
        F.max("confidence").alias("confidence"), F.count(F.lit(1)).alias("seen")
    )
    return extend_keys(existing, grouped, ["company_sk", "alias"], "alias_sk")


def posting_fact(jobs: DataFrame, changes: DataFrame, as_of: str, lookups: list) -> DataFrame:
    """One row per posting version with dimension keys and event flags from its latest change."""
    from worklode.operators.joins import resolve_keys

    latest = best_per_key(changes, ["job_id"], [F.desc("changed_at"), F.desc("change_id")]).select(
        "job_id", F.col("change_type").alias("_last"), F.col("changed_at").alias("last_changed_at")
    )
    keyed = resolve_keys(jobs.join(latest, "job_id", "left"), lookups)
    return keyed.withColumns(
        {
            "is_new_job": F.coalesce(F.col("_last") == "INSERT", F.lit(False)),
            "is_updated_job": F.coalesce(F.col("_last") == "UPDATE", F.lit(False)),
            "is_soft_delete": F.coalesce(F.col("_last") == "DELETE", F.lit(False)),
            "is_restored": F.coalesce(F.col("_last") == "RESTORE", F.lit(False)),
            "days_since_posted": F.datediff(F.lit(as_of).cast("date"), "last_seen"),
        }
    ).drop("_last")


def lifecycle_fact(changes: DataFrame, versions: DataFrame, done: DataFrame) -> DataFrame:
    """Change events with class, days in the state before, and the version valid at the time; events
    already in the fact are left out after the time in state is known."""
    timed = shifted(
        changes.withColumn("event_class", lifecycle_class()), ["job_id"], ["changed_at", "change_id"],
        {"previous_at": "changed_at"}, F.date_trunc("hour", "changed_at"),
    ).withColumn("days_in_previous_state", F.datediff("changed_at", "previous_at"))
    fresh = timed.join(done.select("change_id"), "change_id", "left_anti")
    found = value_as_of(
        fresh, versions, "job_id", "changed_at", "effective_from", "effective_to", ["version_sk"], F.date_trunc("hour", "_at")
    )
    return found.withColumn("job_sk", F.coalesce("version_version_sk", F.lit(UNKNOWN_KEY))).drop("version_version_sk")


def lifecycle_summary(changes: DataFrame, as_of: str) -> DataFrame:
    """Accumulating form: one row per job with first and last event, days active and event counts."""
    counts = [count_where(F.col("change_type") == k).alias(f"{k.lower()}_count") for k in ("UPDATE", "DELETE", "RESTORE")]
    rows = changes.groupBy("job_id").agg(
        F.min("changed_at").alias("first_seen"), F.max("changed_at").alias("last_seen"), *counts
    )
    return rows.withColumns(
        {
            "days_active": F.datediff("last_seen", "first_seen"),
            "days_since_last": F.datediff(F.lit(as_of).cast("date"), "last_seen"),
        }
    )


def salary_fact(observations: DataFrame, rates: dict[str, str]) -> DataFrame:
    """Midpoint, width and US-dollar amounts; ``rates`` = {currency: rate as decimal text}.

    The rate list is a parameter of a few dozen currencies, so it is a constant map, not a join.
    """
    rate = F.lit(None).cast("decimal(9,4)")
    for code, value in rates.items():
        rate = F.when(F.col("currency") == code, F.lit(value).cast("decimal(9,4)")).otherwise(rate)
    rate = F.coalesce(rate, F.lit("1").cast("decimal(9,4)"))
    low, high = F.col("salary_min").cast("decimal(16,2)"), F.col("salary_max").cast("decimal(16,2)")
    return observations.withColumns(
        {
            "salary_midpoint": ((low + high) / 2).cast("double"),
            "salary_range_width": (high - low).cast("double"),
            "has_salary_range": low.isNotNull() & high.isNotNull(),
            "usd_exchange_rate": rate.cast("double"),
            "salary_min_usd": (low * rate).cast("double"),
            "salary_max_usd": (high * rate).cast("double"),
        }
    )


def run_fact(runs: DataFrame, rule_results: DataFrame, key: str, result_key: str) -> DataFrame:
    """Runs with pass, warn and fail counts of the rules evaluated for them on that day."""
    quality = rule_results.groupBy(F.col(result_key).alias(key), date_key(F.col("evaluated_at")).alias("run_date_sk")).agg(
        *[count_where(F.col("status") == s).alias(f"{s.lower()}_rules") for s in ("PASS", "WARN", "FAIL")],
        F.sum("failed_records").alias("failed_records"),
    )
    daily = runs.groupBy(key, "run_date_sk").agg(
        F.count(F.lit(1)).alias("run_count"),
        count_where(F.col("status") == "SUCCESS").alias("success_count"),
        F.sum("rows_written").alias("rows_written"),
        F.max_by("status", F.struct("started_at", "run_id")).alias("last_status"),
    )
    joined = daily.join(quality, [key, "run_date_sk"], "left")
    return joined.fillna(0, ["pass_rules", "warn_rules", "fail_rules", "failed_records"])
