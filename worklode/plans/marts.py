"""Analytic marts over posting facts, the job-skill bridge and salary observations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worklode.functions.dates import key_days_before, key_to_date
from worklode.operators.aggregates import count_where, distinct_where, guarded_ratio
from worklode.operators.quantiles import exact_percentiles
from worklode.operators.ranking import best_per_key, change_ratio, rolling_mean, top_n_with_ties
from worklode.operators.rollups import rollup_levels, stack_levels

ROLLUPS = {"sector": ["sector_sk"], "role": ["role_sk"], "location": ["location_sk"]}


def since(df: DataFrame, col: str, as_of: str, days: int) -> DataFrame:
    return df.filter(F.col(col) >= key_days_before(as_of, days))


def named(df: DataFrame, key: str, dim: DataFrame, dim_key: str, name: str, out: str) -> DataFrame:
    """Replace a surrogate key by the dimension's name."""
    lookup = dim.select(F.col(dim_key).alias("_k"), F.col(name).alias(out))
    return df.join(lookup, F.col(key) == F.col("_k"), "left").drop("_k", key)


def hiring_trends(postings: DataFrame, closings: DataFrame, as_of: str, days: int) -> DataFrame:
    """Per day and sector: new, active and closed postings, hiring companies, mean days to close.

    ``closings`` has one row per posting with ``closed_at``; days to close is closing minus posting.
    """
    f = since(postings, "posting_date_sk", as_of, days).join(closings, "job_sk", "left")
    open_days = F.when(F.col("is_soft_delete"), F.datediff("closed_at", "posted_at"))
    f = f.withColumn("_open_days", open_days)
    return f.groupBy(F.col("posting_date_sk").alias("hiring_date_sk"), "sector_sk").agg(
        count_where(F.col("is_new_job")).alias("total_new_jobs"),
        count_where(F.col("active_flag")).alias("total_active_jobs"),
        count_where(F.col("is_soft_delete")).alias("total_closed_jobs"),
        distinct_where(F.col("active_flag"), "company_sk").alias("unique_companies"),
        guarded_ratio(F.sum("_open_days"), F.count("_open_days")).alias("avg_days_to_fill"),
    )


def _with_tops(base: DataFrame, keys: list[str], tops: dict[str, tuple[str, Column]], totals: dict[str, Column]) -> DataFrame:
    """Totals per key and, for each {output: (attribute, measure)}, the attribute with the largest summed
    measure (ties go to the smaller attribute).

    One grouping-sets pass counts per key and attribute, a second aggregate folds those few rows per
    key; the facts are read and shuffled once and nothing is joined.  ``totals`` are summed over the rows
    of the first attribute.
    """
    attributes = [a for a, _ in tops.values()]
    every = [F.col(c) for c in [*keys, *attributes]]
    sums = {f"_t_{n}": e for n, e in totals.items()} | {f"_m_{o}": m for o, (_, m) in tops.items()}
    level = [F.grouping(a).alias(f"_g_{a}") for a in attributes]
    counted = base.groupingSets([[F.col(c) for c in [*keys, a]] for a in attributes], *every).agg(
        *[F.sum(e).alias(n) for n, e in sums.items()], *level
    )
    first = F.col(f"_g_{attributes[0]}") == 0
    folded = [F.sum(F.when(first, F.col(f"_t_{n}"))).alias(n) for n in totals]
    for out, (attribute, _) in tops.items():
        place = F.when(F.col(f"_g_{attribute}") == 0, F.struct((-F.col(f"_m_{out}")).alias("m"), F.col(attribute).alias("a")))
        folded.append(F.min_by(attribute, place).alias(out))
    return counted.groupBy(*keys).agg(*folded)


def _ones(condition: Column) -> Column:
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def company_hiring(postings: DataFrame, roles: DataFrame, locations: DataFrame, as_of: str, days: int) -> DataFrame:
    """Per company and day: active, new in 30 days, top role, top location, remote share."""
    base = since(postings, "posting_date_sk", as_of, days).withColumnRenamed("posting_date_sk", "hiring_date_sk")
    active = _ones(F.col("active_flag"))
    mart = _with_tops(
        base, ["company_sk", "hiring_date_sk"],
        {"_role": ("role_sk", active), "_place": ("location_sk", active)},
        {
            "active_jobs": active,
            "new_jobs_30d": _ones(F.col("hiring_date_sk") >= key_days_before(as_of, 30)),
            "_remote": _ones(F.col("active_flag") & (F.col("remote_type") == "REMOTE")),
        },
    ).withColumn("remote_ratio", guarded_ratio(F.col("_remote"), F.col("active_jobs"))).drop("_remote")
    mart = named(mart, "_role", roles, "role_sk", "role_name", "top_role")
    return named(mart, "_place", locations, "location_sk", "location_name", "top_location")


def company_activity(postings: DataFrame, roles: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    """Per sector and company over the last days: active, total, top role."""
    base = since(postings, "posting_date_sk", as_of, days)
    active = _ones(F.col("active_flag"))
    mart = _with_tops(
        base, ["sector_sk", "company_sk"], {"_role": ("role_sk", active)},
        {"active_jobs": active, "total_jobs_30d": _ones(F.lit(True))},
    )
    return named(mart, "_role", roles, "role_sk", "role_name", "top_role")


def hiring_activity(postings: DataFrame, roles: DataFrame, as_of: str, days: int) -> DataFrame:
    """Per sector and day: active postings, new postings, top role."""
    base = since(postings, "posting_date_sk", as_of, days).filter(F.col("sector_sk").isNotNull())
    active = _ones(F.col("active_flag"))
    mart = _with_tops(
        base.withColumnRenamed("posting_date_sk", "hiring_date_sk"), ["sector_sk", "hiring_date_sk"],
        {"_role": ("role_sk", active)}, {"total_jobs": active, "new_jobs": _ones(F.col("is_new_job"))},
    )
    return named(mart, "_role", roles, "role_sk", "role_name", "top_role")


def location_trends(postings: DataFrame, sectors: DataFrame, as_of: str, days: int) -> DataFrame:
    """Per location and day: active, remote and on-site postings, mean pay, dominant sector.

    Pay keeps its sum and count through the re-aggregation, so it is a mean of rows, not of means.
    """
    base = since(postings, "posting_date_sk", as_of, days).filter(F.col("location_sk").isNotNull())
    on = F.col("active_flag")
    paid = F.when(on, F.col("price").cast("decimal(18,2)"))
    mart = _with_tops(
        base.withColumnRenamed("posting_date_sk", "trend_date_sk"), ["location_sk", "trend_date_sk"],
        {"_sector": ("sector_sk", _ones(on))},
        {
            "total_jobs": _ones(on),
            "remote_jobs": _ones(on & (F.col("remote_type") == "REMOTE")),
            "onsite_jobs": _ones(on & F.col("remote_type").isin("ONSITE", "HYBRID")),
            "_pay": paid,
            "_paid": _ones(paid.isNotNull()),
        },
    ).withColumn("avg_salary_usd", guarded_ratio(F.col("_pay"), F.col("_paid"))).drop("_pay", "_paid")
    return named(mart, "_sector", sectors, "sector_sk", "sector_name", "top_sector")


def salary_trends(salaries: DataFrame, as_of: str, days: int, min_sample: int = 5) -> DataFrame:
    """Percentiles of minimum and maximum pay per day at three rollup levels, with a smallest sample."""
    usable = since(salaries, "observation_date_sk", as_of, days).filter(
        (F.col("salary_period") == "ANNUAL") & (F.col("currency") == "USD")
        & (F.col("salary_min") > 0) & (F.col("salary_max") > 0)
    )
    cells = [F.col("observation_date_sk").alias("salary_date_sk"), "sector_sk", "role_sk", "location_sk"]

    def paid(side: str) -> DataFrame:
        counted = usable.groupBy(*cells, F.col(f"salary_{side}").alias("_pay")).agg(F.count(F.lit(1)).alias("_times"))
        return counted.withColumn("_side", F.lit(side))

    # Equal pay of a day, sector, role and place is one row before the levels are formed.
    levels = stack_levels(paid("min").unionByName(paid("max")), ROLLUPS)
    keys = ["salary_date_sk", "rollup_level", "sector_sk", "role_sk", "location_sk"]
    found = exact_percentiles(
        levels, [*keys, "_side"], "_pay", {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}, count_col="_n", weight="_times"
    )

    def pick(side: str, p: str):
        return F.round(F.max(F.when(F.col("_side") == side, F.col(p))), 4)

    return found.filter(F.col("_n") >= min_sample).groupBy(*keys).agg(
        pick("min", "p50").alias("salary_min_median"), pick("max", "p50").alias("salary_max_median"),
        pick("min", "p25").alias("salary_min_p25"), pick("min", "p75").alias("salary_min_p75"),
        pick("max", "p25").alias("salary_max_p25"), pick("max", "p75").alias("salary_max_p75"),
        pick("max", "p90").alias("salary_max_p90"), F.max("_n").alias("observation_count"),
    )


def skill_facts(job_skills: DataFrame, postings: DataFrame, as_of: str, days: int) -> DataFrame:
    """Current skills of recent postings with the posting's dimensions."""
    facts = since(postings, "posting_date_sk", as_of, days).select(
        "job_sk", "company_sk", "location_sk", "sector_sk", "role_sk", "posting_date_sk", "active_flag"
    )
    return job_skills.filter("is_current").join(facts, "job_sk")


def skill_demand(job_skills: DataFrame, postings: DataFrame, as_of: str, days: int, grand_total: bool = False) -> DataFrame:
    """Mentions, distinct postings and mean confidence per skill and day at three rollup levels."""
    facts = skill_facts(job_skills, postings, as_of, days).filter("active_flag")
    levels = dict(ROLLUPS, all=[]) if grand_total else ROLLUPS
    # A posting has one sector, role and location, so after this aggregate it is one row per skill and
    # the levels need no distinct count.
    jobs = facts.groupBy(
        F.col("posting_date_sk").alias("demand_date_sk"), "skill_sk", "sector_sk", "role_sk", "location_sk", "job_sk"
    ).agg(F.count(F.lit(1)).alias("_n"), F.sum("confidence").alias("_sum"), F.count("confidence").alias("_known"))
    demand = rollup_levels(
        jobs, ["demand_date_sk", "skill_sk"], levels,
        [F.sum("_n").alias("mentions_count"), F.count(F.lit(1)).alias("unique_jobs_count"),
         guarded_ratio(F.sum("_sum"), F.sum("_known")).alias("avg_confidence")],
    )
    return demand


def skill_demand_by_sector(
    job_skills: DataFrame, postings: DataFrame, as_of: str, days: int, top_n: int = 500
) -> DataFrame:
    """Rank of each skill inside its day and sector, share of the sector's demand, share required.

    ``penetration_rate`` divides by the sum of per-skill counts; ``job_share`` by distinct postings.
    """
    active = F.col("active_flag")
    facts = skill_facts(job_skills, postings, as_of, days).filter(
        F.col("sector_sk").isNotNull() & (F.col("sector_sk") != -1) & F.col("skill_sk").isNotNull()
    )
    facts = facts.withColumnRenamed("posting_date_sk", "trend_date_sk")
    keys = ["trend_date_sk", "sector_sk"]
    # Fold mentions to postings, postings to companies, companies to skills: each step counts what the
    # step before made unique, so no row is copied per distinct count.  A posting has one company.
    required, preferred = F.col("evidence_type") == "REQUIRED", F.col("evidence_type") == "PREFERRED"
    jobs_of = facts.groupBy(*keys, "skill_sk", "company_sk", "job_sk").agg(
        F.max(active).alias("_on"), F.max(active & required).alias("_req"), F.max(active & preferred).alias("_pref")
    )
    companies_of = jobs_of.groupBy(*keys, "skill_sk", "company_sk").agg(
        *[count_where(F.col(c)).alias(c) for c in ("_on", "_req", "_pref")]
    )
    base = companies_of.groupBy(*keys, "skill_sk").agg(
        F.sum("_on").alias("job_count"),
        count_where((F.col("_on") > 0) & F.col("company_sk").isNotNull()).alias("company_count"),
        F.sum("_req").alias("required_count"),
        F.sum("_pref").alias("preferred_count"),
    )
    totals = base.groupBy(*keys).agg(F.sum("job_count").alias("_mentions"))
    jobs = facts.groupBy(*keys).agg(distinct_where(active, "job_sk").alias("_jobs"))
    ranked = top_n_with_ties(base, keys, [F.col("job_count").desc()], top_n, "demand_rank")
    return (
        ranked.join(totals, keys).join(jobs, keys)
        .withColumn("penetration_rate", guarded_ratio(F.col("job_count"), F.col("_mentions")))
        .withColumn("job_share", guarded_ratio(F.col("job_count"), F.col("_jobs")))
        .withColumn("required_pct", guarded_ratio(F.col("required_count"), F.col("job_count")))
        .drop("_mentions", "_jobs")
    )


def sector_overview(
    postings: DataFrame, job_skills: DataFrame, salaries: DataFrame, as_of: str, days: int
) -> DataFrame:
    """Per day and sector: posting counts, distinct companies, roles, locations and skills, median pay."""
    active, keys = F.col("active_flag"), ["sector_date_sk", "sector_sk"]
    counts = {"active_jobs": active, "new_jobs": F.col("is_new_job"), "closed_jobs": F.col("is_soft_delete")}
    facets = {"active_companies": "company_sk", "active_roles": "role_sk", "active_locations": "location_sk"}
    # Postings are folded to cells once; what is distinct is counted over the cells, which Spark shuffles for all facets once.
    cells = (
        since(postings, "posting_date_sk", as_of, days)
        .groupBy(F.col("posting_date_sk").alias("sector_date_sk"), "sector_sk", *facets.values())
        .agg(*[count_where(c).alias(n) for n, c in counts.items()])
    )
    rows = [cells.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in counts])]
    for name, attribute in facets.items():
        members = cells.filter((F.col("active_jobs") > 0) & F.col(attribute).isNotNull()).select(*keys, attribute).distinct()
        rows.append(members.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    jobs = stacked.groupBy(*keys).agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in [*counts, *facets]])
    skills = (
        skill_facts(job_skills, postings, as_of, days)
        .filter(active)
        .groupBy(F.col("posting_date_sk").alias("sector_date_sk"), "sector_sk")
        .agg(F.countDistinct("skill_sk").alias("_skills"))
    )
    paid = since(salaries, "observation_date_sk", as_of, days).filter(
        (F.col("salary_period") == "ANNUAL") & (F.col("currency") == "USD") & (F.col("salary_max") > 0)
    ).withColumnRenamed("observation_date_sk", "sector_date_sk")
    pay = exact_percentiles(paid, keys, "salary_max", {"_median": 0.5}, count_col="_observations")
    return (
        jobs.join(skills, keys, "left").join(pay, keys, "left")
        .withColumn("unique_skills_demanded", F.coalesce("_skills", F.lit(0)))
        .withColumn("jobs_per_company", guarded_ratio(F.col("active_jobs"), F.col("active_companies")))
        .withColumn("median_salary_max", F.round(F.coalesce("_median", F.lit(0.0)), 4))
        .withColumn("salary_observations", F.coalesce("_observations", F.lit(0)))
        .drop("_skills", "_median", "_observations")
    )


def sector_summary(postings: DataFrame, job_skills: DataFrame, skills: DataFrame, salaries: DataFrame, top: int = 10, lag: int = 30) -> DataFrame:
    """Per sector and day: active postings and their companies, growth against ``lag`` days with postings earlier, and, over all
    days of the sector, mean pay and the ``top`` skills that its active postings mention most (ties by name).

    Sectors without pay or skills have null and an empty list.  A posting is one row, so postings are counted, not made distinct.
    """
    active = postings.filter("active_flag")
    # A row per company first: its companies are then counted without a copy of any posting.
    hiring = active.groupBy("sector_sk", F.col("posting_date_sk").alias("overview_date_sk"), "company_sk").agg(F.count(F.lit(1)).alias("_n"))
    daily = hiring.groupBy("sector_sk", "overview_date_sk").agg(
        F.sum("_n").alias("total_jobs"), F.count("company_sk").alias("total_companies")
    )
    daily = growth_by_lag(daily, ["sector_sk"], "overview_date_sk", "total_jobs", lag).withColumnRenamed("growth_rate", "growth_rate_30d")
    pay = salaries.groupBy("sector_sk").agg(guarded_ratio(F.sum("salary_max"), F.count("salary_max")).alias("avg_salary_usd"))

    mentions = job_skills.join(active.select("job_sk", "sector_sk"), "job_sk").groupBy("sector_sk", "skill_sk").agg(F.count(F.lit(1)).alias("_n"))
    by_name = mentions.join(skills.select("skill_sk", "skill_name"), "skill_sk").groupBy("sector_sk", "skill_name").agg(F.sum("_n").alias("_n"))
    rank = F.row_number().over(Window.partitionBy("sector_sk").orderBy(F.desc("_n"), "skill_name"))
    best = by_name.withColumn("_rank", rank).filter(F.col("_rank") <= top)
    names = F.transform(F.array_sort(F.collect_list(F.struct("_rank", "skill_name"))), lambda s: s["skill_name"])
    lists = best.groupBy("sector_sk").agg(names.alias("top_skills"))
    found = daily.alias("d")
    for side, name, default in ((pay, "avg_salary_usd", None), (lists, "top_skills", F.array().cast("array<string>"))):
        joined = found.alias("d").join(side.alias("s"), F.col("d.sector_sk").eqNullSafe(F.col("s.sector_sk")), "left")
        found = joined.select("d.*", F.col(name) if default is None else F.coalesce(name, default).alias(name))
    return found


def run_health(runs: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Per day and job name: run counts, success share, throughput, change against the day before,
    rolling means and anomaly flags.  Both spellings of a failed run are counted."""
    keys = ["health_date_sk", "run_name"]
    r = since(runs, "run_date_sk", as_of, days).withColumnRenamed("run_date_sk", "health_date_sk")
    daily = r.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("run_count"),
        count_where(F.col("status") == "SUCCESS").alias("success_count"),
        count_where(F.col("status").isin("FAILURE", "FAILED")).alias("failure_count"),
        count_where(F.col("status") == "TIMEOUT").alias("timeout_count"),
        F.sum("rows_read").alias("total_rows_read"), F.sum("rows_written").alias("total_rows_written"),
        F.sum("runtime_seconds").alias("total_runtime_seconds"),
        F.max("runtime_seconds").alias("max_runtime_seconds"), F.min("runtime_seconds").alias("min_runtime_seconds"),
    )
    daily = daily.withColumn("success_rate", guarded_ratio(F.col("success_count"), F.col("run_count"))).withColumn(
        "avg_runtime_seconds", guarded_ratio(F.col("total_runtime_seconds"), F.col("run_count"))
    )
    # One row per job name and day from here on, so the windows are small whatever the number of runs.
    w = Window.partitionBy("run_name").orderBy("health_date_sk")
    daily = daily.withColumn("_prev_rows", F.lag("total_rows_written").over(w)).withColumn(
        "_prev_runtime", F.lag("avg_runtime_seconds").over(w)
    )
    daily = rolling_mean(daily, ["run_name"], "health_date_sk", "total_rows_written", "rolling_7day_avg_rows_written")
    daily = rolling_mean(daily, ["run_name"], "health_date_sk", "total_runtime_seconds", "rolling_7day_avg_runtime")
    volume, pace = F.col("rolling_7day_avg_rows_written"), F.col("rolling_7day_avg_runtime")
    return (
        daily.withColumn("pct_change_rows_vs_prev_day", change_ratio(F.col("total_rows_written"), F.col("_prev_rows")))
        .withColumn("pct_change_runtime_vs_prev_day", change_ratio(F.col("avg_runtime_seconds"), F.col("_prev_runtime")))
        .withColumn("volume_anomaly_flag", (volume > 0) & (F.abs(F.col("total_rows_written") - volume) / volume > 0.5))
        .withColumn("performance_anomaly_flag", (pace > 0) & (F.col("total_runtime_seconds") > pace * 1.5))
        .drop("_prev_rows", "_prev_runtime")
    )


def growth_over_spine(daily: DataFrame, keys: list[str], day: str, measure: str, lag_days: int, first: str, last: str) -> DataFrame:
    """Change of a daily measure against ``lag_days`` earlier, on a complete day spine (missing day = 0).

    A calendar shift is an equi-join of the series with itself, so no day has to be filled in for it.
    """
    series = daily.select(*keys, F.col(day).alias("_day"), F.col(measure).alias("_now"))
    earlier = series.select(*keys, F.date_add("_day", lag_days).alias("_day"), F.col("_now").alias("_then"))
    spine = series.select(*keys).distinct().withColumn(
        "_day", F.explode(F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date")))
    )
    return (
        spine.join(series, [*keys, "_day"], "left").join(earlier, [*keys, "_day"], "left")
        .select(*keys, F.col("_day").alias(day), F.coalesce("_now", F.lit(0)).alias(measure),
                F.coalesce("_then", F.lit(0)).alias("previous"))
        .withColumn("delta", F.col(measure) - F.col("previous"))
        .withColumn("growth", change_ratio(F.col(measure), F.col("previous")))
    )


def monthly_change(postings: DataFrame, keys: list[str]) -> DataFrame:
    """Postings per month with the change against the month before (months without postings count 0)."""
    month = F.date_trunc("month", "posted_at").cast("date")
    counts = postings.groupBy(*keys, month.alias("month")).agg(F.count(F.lit(1)).alias("job_count"))
    ends = counts.groupBy(*keys).agg(F.min("month").alias("_a"), F.max("month").alias("_b"))
    spine = ends.select(*keys, F.explode(F.expr("sequence(_a, _b, interval 1 month)")).alias("month"))
    full = spine.join(counts, [*keys, "month"], "left").fillna(0, ["job_count"])
    w = Window.partitionBy(*keys).orderBy("month")
    return full.withColumn("mom_delta", F.col("job_count") - F.lag("job_count").over(w)).withColumn(
        "mom_pct", change_ratio(F.col("job_count"), F.lag("job_count").over(w))
    )


def growth_by_lag(daily: DataFrame, keys: list[str], order: str, measure: str, rows: int) -> DataFrame:
    """Growth against the value ``rows`` rows earlier (one row per key and day expected)."""
    earlier = F.lag(measure, rows).over(Window.partitionBy(*keys).orderBy(order))
    return daily.withColumn("growth_rate", change_ratio(F.col(measure), earlier))


def sector_view(mart: DataFrame, sectors: DataFrame, wanted: str) -> DataFrame:
    """A mart narrowed to one sector by name."""
    return mart.join(sectors.filter(F.col("sector_name") == wanted).select("sector_sk", "sector_name"), "sector_sk")


def top_sector_per_skill(demand: DataFrame) -> DataFrame:
    """Sector with the most postings per skill, over all days of the by-sector demand mart."""
    totals = demand.groupBy("skill_sk", "sector_sk").agg(F.sum("job_count").alias("job_count"))
    return best_per_key(totals, ["skill_sk"], [F.col("job_count").desc(), F.col("sector_sk").asc()])


def rolling_rollup(mart: DataFrame, level: str) -> DataFrame:
    """Rows of one rollup level only (a null key of that level means unknown, not rolled up)."""
    return mart.filter(F.col("rollup_level") == level)
