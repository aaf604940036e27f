"""Marts and their drill-ins."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklode.operators.aggregates import count_where, unpivot_counts
from worklode.plans import marts
from worklode.plans.feed import AS_OF, EVENTS_AS_OF, LOOKBACK_DAYS
from worklode.queries.registry import query

CUT = marts.key_days_before(AS_OF, LOOKBACK_DAYS)
CUT_30 = marts.key_days_before(AS_OF, 30)


def closings(t):
    return t.lineitem.groupBy(F.col("l_orderkey").alias("job_sk")).agg(F.max("l_shipdate").alias("closed_at"))


HIRING = f"""
    select posting_date_sk as hiring_date_sk, sector_sk,
           count(case when is_new_job then 1 end) as total_new_jobs,
           count(case when active_flag then 1 end) as total_active_jobs,
           count(case when is_soft_delete then 1 end) as total_closed_jobs,
           count(distinct case when active_flag then company_sk end) as unique_companies,
           case when count(d) > 0 then cast(sum(d) as double) / cast(count(d) as double) end as avg_days_to_fill
    from (select p.*, case when is_soft_delete then date_diff('day', posted_at, closed_at) end as d
          from {{postings}} p left join (select l_orderkey, max(l_shipdate) as closed_at from {{lineitem}} group by 1) c
          on p.job_sk = c.l_orderkey where posting_date_sk >= {CUT})
    group by 1, 2"""


@query("hiring_trends", "G-01 A-02 A-03 PF-03 IO-09", HIRING)
def _(t):
    return marts.hiring_trends(t.postings, closings(t), AS_OF, LOOKBACK_DAYS)


def top_sql(keys: str, base: str, attribute: str, measure: str, out: str) -> str:
    return f"""select {keys}, {attribute} as {out} from (
        select {keys}, {attribute}, row_number() over (partition by {keys} order by sum({measure}) desc, {attribute}) as rn
        from {base} group by {keys}, {attribute}) where rn = 1"""


@query("company_hiring", "G-02 A-19 W-04 A-09 A-07", f"""
    with base as (
        select company_sk, posting_date_sk as hiring_date_sk, role_sk, location_sk, remote_type,
               count(case when active_flag then 1 end) as a, count(*) as n
        from {{postings}} where posting_date_sk >= {CUT} group by 1, 2, 3, 4, 5),
    tot as (select company_sk, hiring_date_sk, cast(sum(a) as bigint) as active_jobs,
                   cast(sum(case when hiring_date_sk >= {CUT_30} then n else 0 end) as bigint) as new_jobs_30d,
                   sum(case when remote_type = 'REMOTE' then a else 0 end) as remote from base group by 1, 2),
    tr as ({top_sql("company_sk, hiring_date_sk", "base", "role_sk", "a", "r")}),
    tl as ({top_sql("company_sk, hiring_date_sk", "base", "location_sk", "a", "l")})
    select company_sk, hiring_date_sk, active_jobs, new_jobs_30d, role_name as top_role, location_name as top_location,
           case when active_jobs > 0 then cast(remote as double) / cast(active_jobs as double) end as remote_ratio
    from tot join tr using (company_sk, hiring_date_sk) join tl using (company_sk, hiring_date_sk)
    left join {{roles}} rr on rr.role_sk = r left join {{locations}} ll on ll.location_sk = l""")
def _(t):
    return marts.company_hiring(t.postings, t.roles, t.locations, AS_OF, LOOKBACK_DAYS)


def activity_sql(days: int) -> str:
    cut = marts.key_days_before(AS_OF, days)
    return f"""
    with base as (select sector_sk, company_sk, role_sk, count(case when active_flag then 1 end) as a, count(*) as n
                  from {{postings}} where posting_date_sk >= {cut} group by 1, 2, 3),
    tot as (select sector_sk, company_sk, cast(sum(a) as bigint) as active_jobs, cast(sum(n) as bigint) as total_jobs_30d
            from base group by 1, 2),
    tr as ({top_sql("sector_sk, company_sk", "base", "role_sk", "a", "r")})
    select sector_sk, company_sk, active_jobs, total_jobs_30d, role_name as top_role
    from tot join tr using (sector_sk, company_sk) left join {{roles}} rr on rr.role_sk = r"""


@query("company_activity", "G-03 W-04", activity_sql(LOOKBACK_DAYS))
def _(t):
    return marts.company_activity(t.postings, t.roles, AS_OF, LOOKBACK_DAYS)


@query("company_activity_30d", "G-03 PF-03", activity_sql(30))
def _(t):
    return marts.company_activity(t.postings, t.roles, AS_OF)


ACTIVITY = f"""
    with base as (select sector_sk, posting_date_sk as hiring_date_sk, role_sk,
                         count(case when active_flag then 1 end) as a, count(case when is_new_job then 1 end) as n
                  from {{postings}} where posting_date_sk >= {CUT} and sector_sk is not null group by 1, 2, 3),
    tot as (select sector_sk, hiring_date_sk, cast(sum(a) as bigint) as total_jobs, cast(sum(n) as bigint) as new_jobs
            from base group by 1, 2),
    tr as ({top_sql("sector_sk, hiring_date_sk", "base", "role_sk", "a", "r")}),
    mart as (select sector_sk, hiring_date_sk, total_jobs, new_jobs, role_name as top_role
             from tot join tr using (sector_sk, hiring_date_sk) left join {{roles}} rr on rr.role_sk = r)"""


@query("hiring_activity", "G-04 W-04", ACTIVITY + " select * from mart")
def _(t):
    return marts.hiring_activity(t.postings, t.roles, AS_OF, LOOKBACK_DAYS)


@query("hiring_activity_sector", "G-11 J-23", ACTIVITY + """
    select mart.*, sector_name from mart join {sectors} using (sector_sk) where sector_name = 'HOUSEHOLD'""")
def _(t):
    return marts.sector_view(marts.hiring_activity(t.postings, t.roles, AS_OF, LOOKBACK_DAYS), t.sectors, "HOUSEHOLD")


@query("location_trends", "G-05 A-02 W-04 A-09", f"""
    with base as (
        select location_sk, posting_date_sk as trend_date_sk, sector_sk, remote_type,
               count(case when active_flag then 1 end) as a,
               sum(case when active_flag then cast(price as decimal(18,2)) end) as pay,
               count(case when active_flag then price end) as paid
        from {{postings}} where posting_date_sk >= {CUT} and location_sk is not null group by 1, 2, 3, 4),
    tot as (select location_sk, trend_date_sk, cast(sum(a) as bigint) as total_jobs,
                   cast(sum(case when remote_type = 'REMOTE' then a else 0 end) as bigint) as remote_jobs,
                   cast(sum(case when remote_type in ('ONSITE', 'HYBRID') then a else 0 end) as bigint) as onsite_jobs,
                   case when sum(paid) > 0 then cast(sum(pay) as double) / cast(sum(paid) as double) end as avg_salary_usd
            from base group by 1, 2),
    ts as ({top_sql("location_sk, trend_date_sk", "base", "sector_sk", "a", "s")})
    select location_sk, trend_date_sk, total_jobs, remote_jobs, onsite_jobs, avg_salary_usd, sector_name as top_sector
    from tot join ts using (location_sk, trend_date_sk) left join {{sectors}} ss on ss.sector_sk = s""")
def _(t):
    return marts.location_trends(t.postings, t.sectors, AS_OF, LOOKBACK_DAYS)


SALARY = f"""
    with usable as (select * from {{salaries}} where observation_date_sk >= {CUT} and salary_period = 'ANNUAL'
                    and currency = 'USD' and salary_min > 0 and salary_max > 0),
    lv as (select observation_date_sk as d, 'sector' as rollup_level, sector_sk, cast(null as int) as role_sk,
                  cast(null as int) as location_sk, salary_min, salary_max from usable
           union all select observation_date_sk, 'role', null, role_sk, null, salary_min, salary_max from usable
           union all select observation_date_sk, 'location', null, null, location_sk, salary_min, salary_max from usable),
    trends as (
    select d as salary_date_sk, rollup_level, sector_sk, role_sk, location_sk,
           round(quantile_cont(salary_min, 0.5), 4) as salary_min_median,
           round(quantile_cont(salary_max, 0.5), 4) as salary_max_median,
           round(quantile_cont(salary_min, 0.25), 4) as salary_min_p25,
           round(quantile_cont(salary_min, 0.75), 4) as salary_min_p75,
           round(quantile_cont(salary_max, 0.25), 4) as salary_max_p25,
           round(quantile_cont(salary_max, 0.75), 4) as salary_max_p75,
           round(quantile_cont(salary_max, 0.9), 4) as salary_max_p90, count(*) as observation_count
    from lv group by 1, 2, 3, 4, 5 having count(*) >= 5)"""


@query("salary_trends", "G-06 A-04 A-05 A-06", SALARY + " select * from trends")
def _(t):
    return marts.salary_trends(t.salaries, AS_OF, LOOKBACK_DAYS)


@query("salary_trends_sector_level", "G-14 A-05", SALARY + """
    select salary_date_sk, sector_name, salary_max_median, observation_count
    from trends join {sectors} s on s.sector_sk = trends.sector_sk where rollup_level = 'sector'""")
def _(t):
    level = marts.rolling_rollup(marts.salary_trends(t.salaries, AS_OF, LOOKBACK_DAYS), "sector")
    return level.join(t.sectors, "sector_sk").select(
        "salary_date_sk", "sector_name", "salary_max_median", "observation_count"
    )


@query("salary_trends_checks", "G-12 U-02", SALARY + """
    select 'null_level_key' as check_name, count(case when coalesce(sector_sk, role_sk, location_sk) is null then 1 end)
           as issue_count from trends
    union all select 'negative_value', count(case when salary_min_p25 < 0 or salary_max_p25 < 0 then 1 end) from trends
    union all select 'percentile_order', count(case when salary_max_p25 > salary_max_median
           or salary_max_median > salary_max_p75 or salary_max_p75 > salary_max_p90 then 1 end) from trends
    union all select 'small_sample', count(case when observation_count < 8 then 1 end) from trends""")
def _(t):
    mart = marts.salary_trends(t.salaries, AS_OF, LOOKBACK_DAYS)
    order = (F.col("salary_max_p25") > F.col("salary_max_median")) | (
        F.col("salary_max_median") > F.col("salary_max_p75")
    ) | (F.col("salary_max_p75") > F.col("salary_max_p90"))
    checks = {
        "null_level_key": F.coalesce("sector_sk", "role_sk", "location_sk").isNull(),
        "negative_value": (F.col("salary_min_p25") < 0) | (F.col("salary_max_p25") < 0),
        "percentile_order": order,
        "small_sample": F.col("observation_count") < 8,
    }
    return unpivot_counts(mart.agg(*[count_where(c).alias(n) for n, c in checks.items()]), list(checks))


def skill_sql(grand: bool) -> str:
    levels = [("sector", "sector_sk", "null", "null"), ("role", "null", "role_sk", "null"), ("location", "null", "null", "location_sk")]
    if grand:
        levels.append(("all", "null", "null", "null"))
    parts = " union all ".join(
        f"select posting_date_sk as demand_date_sk, skill_sk, '{n}' as rollup_level, cast({s} as int) as sector_sk, "
        f"cast({r} as int) as role_sk, cast({lo} as int) as location_sk, job_sk, confidence from sk" for n, s, r, lo in levels
    )
    return f"""
    with sk as (select k.*, posting_date_sk, sector_sk, role_sk, location_sk from {{job_skills}} k
                join {{postings}} p on k.job_sk = p.job_sk
                where k.is_current and active_flag and posting_date_sk >= {CUT})
    select demand_date_sk, skill_sk, rollup_level, sector_sk, role_sk, location_sk, count(*) as mentions_count,
           count(distinct job_sk) as unique_jobs_count,
           cast(sum(cast(confidence as decimal(18,2))) as double) / cast(count(*) as double) as avg_confidence
    from ({parts}) group by 1, 2, 3, 4, 5, 6"""


@query("skill_demand", "G-07 A-03 A-05", skill_sql(False))
def _(t):
    return marts.skill_demand(t.job_skills, t.postings, AS_OF, LOOKBACK_DAYS)


@query("skill_demand_with_total", "G-15 A-05", skill_sql(True))
def _(t):
    return marts.skill_demand(t.job_skills, t.postings, AS_OF, LOOKBACK_DAYS, grand_total=True)


BY_SECTOR = f"""
    with sk as (select k.*, posting_date_sk, sector_sk, company_sk, active_flag from {{job_skills}} k
                join {{postings}} p on k.job_sk = p.job_sk
                where k.is_current and posting_date_sk >= {CUT} and sector_sk is not null and sector_sk <> -1),
    base as (select posting_date_sk as trend_date_sk, sector_sk, skill_sk,
                    count(distinct case when active_flag then job_sk end) as job_count,
                    count(distinct case when active_flag then company_sk end) as company_count,
                    count(distinct case when active_flag and evidence_type = 'REQUIRED' then job_sk end) as required_count,
                    count(distinct case when active_flag and evidence_type = 'PREFERRED' then job_sk end) as preferred_count
             from sk group by 1, 2, 3),
    jobs as (select posting_date_sk as trend_date_sk, sector_sk, count(distinct case when active_flag then job_sk end) as jobs
             from sk group by 1, 2),
    ranked as (select *, dense_rank() over (partition by trend_date_sk, sector_sk order by job_count desc) as demand_rank,
                      sum(job_count) over (partition by trend_date_sk, sector_sk) as mentions from base),
    mart as (select trend_date_sk, sector_sk, skill_sk, job_count, company_count, required_count, preferred_count,
           cast(demand_rank as int) as demand_rank,
           case when mentions > 0 then cast(job_count as double) / cast(mentions as double) end as penetration_rate,
           case when jobs > 0 then cast(job_count as double) / cast(jobs as double) end as job_share,
           case when job_count > 0 then cast(required_count as double) / cast(job_count as double) end as required_pct
    from ranked join jobs using (trend_date_sk, sector_sk) where demand_rank <= 500)"""


def by_sector(t):
    return marts.skill_demand_by_sector(t.job_skills, t.postings, AS_OF, LOOKBACK_DAYS)


@query("skill_demand_by_sector", "G-08 W-05 A-03 A-09", BY_SECTOR + " select * from mart")
def _(t):
    return by_sector(t)


@query("top_sector_per_skill", "G-15 W-04", BY_SECTOR + """
    select skill_sk, sector_sk, job_count from (
        select skill_sk, sector_sk, cast(sum(job_count) as bigint) as job_count,
               row_number() over (partition by skill_sk order by sum(job_count) desc, sector_sk) as rn
        from mart group by 1, 2) where rn = 1""")
def _(t):
    return marts.top_sector_per_skill(by_sector(t))


OVERVIEW = f"""
    with jm as (
        select posting_date_sk as sector_date_sk, sector_sk, count(case when active_flag then 1 end) as active_jobs,
               count(case when is_new_job then 1 end) as new_jobs, count(case when is_soft_delete then 1 end) as closed_jobs,
               count(distinct case when active_flag then company_sk end) as active_companies,
               count(distinct case when active_flag then role_sk end) as active_roles,
               count(distinct case when active_flag then location_sk end) as active_locations
        from {{postings}} where posting_date_sk >= {CUT} group by 1, 2),
    sm as (select posting_date_sk as sector_date_sk, sector_sk, count(distinct skill_sk) as skills
           from {{postings}} p join {{job_skills}} k on p.job_sk = k.job_sk
           where posting_date_sk >= {CUT} and active_flag and k.is_current group by 1, 2),
    sal as (select observation_date_sk as sector_date_sk, sector_sk, quantile_cont(salary_max, 0.5) as med, count(*) as n
            from {{salaries}} where observation_date_sk >= {CUT} and salary_period = 'ANNUAL' and currency = 'USD'
            and salary_max > 0 group by 1, 2),
    mart as (select jm.*, coalesce(skills, 0) as unique_skills_demanded,
           case when active_companies > 0 then cast(active_jobs as double) / cast(active_companies as double) end
               as jobs_per_company,
           round(coalesce(med, 0), 4) as median_salary_max, coalesce(n, 0) as salary_observations
    from jm left join sm using (sector_date_sk, sector_sk) left join sal using (sector_date_sk, sector_sk))"""


@query("sector_overview", "G-09 A-03 A-04 A-09", OVERVIEW + " select * from mart")
def _(t):
    return marts.sector_overview(t.postings, t.job_skills, t.salaries, AS_OF, LOOKBACK_DAYS)


@query("sector_summary", "G-09 A-07 W-12", """
    with d as (select sector_sk, posting_date_sk as overview_date_sk, count(*) as total_jobs, count(distinct company_sk) as total_companies
               from {postings} where active_flag group by 1, 2),
    l as (select *, lag(total_jobs, 30) over (partition by sector_sk order by overview_date_sk) as p from d),
    pay as (select sector_sk, cast(sum(salary_max) as double) / cast(count(salary_max) as double) as avg_salary_usd from {salaries} group by 1),
    m as (select sector_sk, skill_name, count(*) as n from {postings} join {job_skills} using (job_sk) join {skills} using (skill_sk)
          where active_flag group by 1, 2),
    r as (select *, row_number() over (partition by sector_sk order by n desc, skill_name) as rn from m),
    s as (select sector_sk, string_agg(skill_name, ', ' order by rn) as top_skills from r where rn <= 10 group by 1)
    select l.sector_sk, overview_date_sk, total_jobs, total_companies, round(avg_salary_usd, 4) as avg_salary_usd,
           coalesce(top_skills, '') as top_skills, case when p > 0 then cast(total_jobs - p as double) / cast(p as double) end as growth_rate_30d
    from l left join pay on l.sector_sk is not distinct from pay.sector_sk left join s on l.sector_sk is not distinct from s.sector_sk""")
def _(t):
    found = marts.sector_summary(t.postings, t.job_skills, t.skills, t.salaries)
    return found.withColumn("top_skills", F.array_join("top_skills", ", ")).withColumn("avg_salary_usd", F.round("avg_salary_usd", 4))


@query("sector_growth_by_lag", "W-12 G-09", f"""
    with d as (select sector_sk, posting_date_sk, count(*) as job_count from {{postings}} where posting_date_sk >= {CUT}
               group by 1, 2),
    l as (select *, lag(job_count, 30) over (partition by sector_sk order by posting_date_sk) as p from d)
    select sector_sk, posting_date_sk, job_count,
           case when p > 0 then cast(job_count - p as double) / cast(p as double) end as growth_rate from l""")
def _(t):
    daily = marts.since(t.postings, "posting_date_sk", AS_OF, LOOKBACK_DAYS).groupBy("sector_sk", "posting_date_sk").agg(
        F.count(F.lit(1)).alias("job_count")
    )
    return marts.growth_by_lag(daily, ["sector_sk"], "posting_date_sk", "job_count", 30)


@query("sector_growth_30d", "G-15 W-12", f"""
    with spine as (select sector_sk, cast(g as date) as day from (select distinct sector_sk from {{postings}}),
                   generate_series(timestamp '1995-01-01', timestamp '2001-08-01', interval 1 day) x(g)),
    d as (select sector_sk, cast(posted_at as date) as day, count(*) as n from {{postings}} group by 1, 2),
    j as (select s.sector_sk, s.day, coalesce(a.n, 0) as job_count, coalesce(b.n, 0) as previous
          from spine s left join d a on a.sector_sk = s.sector_sk and a.day = s.day
          left join d b on b.sector_sk = s.sector_sk and b.day = cast(s.day - interval 30 day as date))
    select sector_sk, strftime(day, '%Y-%m-%d') as day, job_count, previous, job_count - previous as delta,
           case when previous > 0 then cast(job_count - previous as double) / cast(previous as double) end as growth
    from j""")
def _(t):
    daily = t.postings.groupBy("sector_sk", F.to_date("posted_at").alias("day")).agg(F.count(F.lit(1)).alias("job_count"))
    found = marts.growth_over_spine(daily, ["sector_sk"], "day", "job_count", 30, "1995-01-01", "2001-08-01")
    return found.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("monthly_change", "G-15 W-07", """
    with c as (select sector_sk, date_trunc('month', posted_at) as m, count(*) as n from {postings} group by 1, 2),
    e as (select sector_sk, min(m) as a, max(m) as b from c group by 1),
    s as (select sector_sk, unnest(generate_series(cast(a as timestamp), cast(b as timestamp), interval 1 month)) as m from e),
    f as (select s.sector_sk, s.m, coalesce(n, 0) as job_count from s left join c on c.sector_sk = s.sector_sk and c.m = s.m),
    l as (select *, lag(job_count) over (partition by sector_sk order by m) as p from f)
    select sector_sk, strftime(m, '%Y-%m-%d') as month, job_count, job_count - p as mom_delta,
           case when p > 0 then cast(job_count - p as double) / cast(p as double) end as mom_pct from l""")
def _(t):
    return marts.monthly_change(t.postings, ["sector_sk"]).withColumn("month", F.date_format("month", "yyyy-MM-dd"))


RUN_CUT = marts.key_days_before(EVENTS_AS_OF, 90)


@query("run_health", "G-10 A-02 W-07 W-09", f"""
    with d as (select run_date_sk as health_date_sk, run_name, count(*) as run_count,
                      count(case when status = 'SUCCESS' then 1 end) as success_count,
                      count(case when status in ('FAILURE', 'FAILED') then 1 end) as failure_count,
                      count(case when status = 'TIMEOUT' then 1 end) as timeout_count,
                      cast(sum(rows_read) as bigint) as total_rows_read, cast(sum(rows_written) as bigint) as total_rows_written,
                      cast(sum(runtime_seconds) as bigint) as total_runtime_seconds,
                      max(runtime_seconds) as max_runtime_seconds, min(runtime_seconds) as min_runtime_seconds
               from {{runs}} where run_date_sk >= {RUN_CUT} group by 1, 2),
    r as (select *, cast(success_count as double) / run_count as success_rate,
                 cast(total_runtime_seconds as double) / run_count as avg_runtime_seconds from d),
    w as (select *, lag(total_rows_written) over w1 as pr, lag(avg_runtime_seconds) over w1 as pt,
                 cast(sum(total_rows_written) over w7 as double) / count(*) over w7 as rolling_7day_avg_rows_written,
                 cast(sum(total_runtime_seconds) over w7 as double) / count(*) over w7 as rolling_7day_avg_runtime
          from r window w1 as (partition by run_name order by health_date_sk),
                        w7 as (partition by run_name order by health_date_sk rows between 6 preceding and current row))
    select health_date_sk, run_name, run_count, success_count, failure_count, timeout_count, total_rows_read,
           total_rows_written, total_runtime_seconds, max_runtime_seconds, min_runtime_seconds, success_rate,
           avg_runtime_seconds, rolling_7day_avg_rows_written, rolling_7day_avg_runtime,
           case when pr > 0 then cast(total_rows_written - pr as double) / cast(pr as double) end
               as pct_change_rows_vs_prev_day,
           case when pt > 0 then (avg_runtime_seconds - pt) / pt end as pct_change_runtime_vs_prev_day,
           rolling_7day_avg_rows_written > 0 and abs(total_rows_written - rolling_7day_avg_rows_written)
               / rolling_7day_avg_rows_written > 0.5 as volume_anomaly_flag,
           rolling_7day_avg_runtime > 0 and total_runtime_seconds > rolling_7day_avg_runtime * 1.5
               as performance_anomaly_flag
    from w""")
def _(t):
    return marts.run_health(t.runs, EVENTS_AS_OF)


@query("hiring_top_sectors", "G-13 S-03 A-10", f"""
    select sector_name, count(case when p.active_flag then 1 end) as active_jobs
    from {{postings}} p join {{sectors}} s on p.sector_sk = s.sector_sk where posting_date_sk >= {CUT}
    group by 1 order by 2 desc, 1 limit 3""")
def _(t):
    mart = marts.hiring_trends(t.postings, closings(t), AS_OF, LOOKBACK_DAYS)
    per_sector = mart.groupBy("sector_sk").agg(F.sum("total_active_jobs").alias("active_jobs"))
    return per_sector.join(t.sectors, "sector_sk").select("sector_name", "active_jobs").orderBy(
        F.desc("active_jobs"), "sector_name"
    ).limit(3)


@query("location_latest_top", "G-13 J-19", """
    select location_name, count(case when active_flag then 1 end) as total_jobs
    from {postings} p join {locations} l on l.location_sk = p.location_sk
    where posting_date_sk = (select max(posting_date_sk) from {postings})
    group by 1 order by 2 desc, 1 limit 10""")
def _(t):
    mart = marts.location_trends(t.postings, t.sectors, AS_OF, LOOKBACK_DAYS)
    latest = mart.filter(F.col("trend_date_sk") == t.postings.select(F.max("posting_date_sk")).scalar())
    return latest.join(t.locations, "location_sk").select("location_name", "total_jobs").orderBy(
        F.desc("total_jobs"), "location_name"
    ).limit(10)


@query("rollup_breakdown", "G-13 A-11", SALARY + """
    select rollup_level, count(*) as rows_in_level, cast(sum(observation_count) as bigint) as observations
    from trends group by 1""")
def _(t):
    mart = marts.salary_trends(t.salaries, AS_OF, LOOKBACK_DAYS)
    return mart.groupBy("rollup_level").agg(
        F.count(F.lit(1)).alias("rows_in_level"), F.sum("observation_count").alias("observations")
    )


@query("demand_velocity", "G-14 W-14", """
    with d as (select role_sk, cast(posted_at as date) as day, count(*) as n from {postings} group by 1, 2)
    select role_sk, strftime(day, '%Y-%m-%d') as day, n as job_count,
           cast(sum(n) over (partition by role_sk order by day range between interval 6 day preceding and current row) as bigint)
               as last_7_days,
           cast(coalesce(sum(n) over (partition by role_sk order by day range between interval 13 day preceding
               and interval 7 day preceding), 0) as bigint) as prior_7_days
    from d""")
def _(t):
    from pyspark.sql import Window

    daily = t.postings.groupBy("role_sk", F.to_date("posted_at").alias("day")).agg(F.count(F.lit(1)).alias("job_count"))
    w = Window.partitionBy("role_sk").orderBy(F.datediff("day", F.lit("1970-01-01")))
    return daily.select(
        "role_sk", F.date_format("day", "yyyy-MM-dd").alias("day"), "job_count",
        F.sum("job_count").over(w.rangeBetween(-6, 0)).alias("last_7_days"),
        F.coalesce(F.sum("job_count").over(w.rangeBetween(-13, -7)), F.lit(0)).alias("prior_7_days"),
    )
