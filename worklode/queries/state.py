"""Change detection, upserts, history, keys, dimensions and facts."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklode.functions import fixed_values as fixed
from worklode.operators import keys, scd2, upsert
from worklode.plans import facts
from worklode.plans.feed import AS_OF, EVENTS_AS_OF
from worklode.queries.registry import query

TS = "%Y-%m-%d %H:%M:%S"


def secs(col: str):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss").alias(col)


# Change detection -------------------------------------------------------------------------------

CHANGES_SQL = f"""
    select coalesce(s.job_id, c.job_id) as job_id, coalesce(s.source_name, c.source_name) as source_name,
           case when c.job_id is null then 'INSERT'
                when s.job_id is not null and s.record_hash is distinct from c.record_hash then 'UPDATE'
                when s.job_id is not null then 'UNCHANGED'
                when c.is_active and date_diff('day', cast(c.last_seen as date), date '{AS_OF}') > 400
                     and c.source_name in (select source_name from {{staged_jobs}}) then 'DELETE' else 'KEEP' end as change_type,
           c.record_hash as old_hash, s.record_hash as new_hash
    from {{staged_jobs}} s full join {{current_jobs}} c on s.job_id = c.job_id"""


def changes(t):
    return upsert.classify_changes(t.staged_jobs, t.current_jobs, "job_id", "source_name", AS_OF, 400)


@query("classify_changes", "J-02 J-03 J-04 U-01 T-05", CHANGES_SQL)
def _(t):
    return changes(t)


@query("apply_changes", "M-01 M-02 J-02 J-03 J-04", f"""
    with ch as ({CHANGES_SQL})
    select job_id, status, is_active, record_hash from {{staged_jobs}}
    where job_id in (select job_id from ch where change_type in ('INSERT', 'UPDATE'))
    union all
    select c.job_id, status, case when ch.change_type = 'DELETE' then false else is_active end, record_hash
    from {{current_jobs}} c join ch on ch.job_id = c.job_id where ch.change_type not in ('INSERT', 'UPDATE')""")
def _(t):
    state = upsert.apply_changes(upsert.compared(t.staged_jobs, t.current_jobs, "job_id", "source_name", AS_OF, 400))
    return state.select("job_id", "status", "is_active", "record_hash")


@query("full_upsert", "M-01 IO-20", """
    select job_id, status, price from {staged_jobs}
    union all select job_id, status, price from {current_jobs} c
    where not exists (select 1 from {staged_jobs} s where s.job_id = c.job_id)""")
def _(t):
    source = upsert.one_row_per_key(t.staged_jobs.select("job_id", "status", "price"), ["job_id"])
    return upsert.upsert(t.current_jobs.select("job_id", "status", "price"), source, ["job_id"])


@query("partial_update", "M-02", """
    select c.job_id, case when s.job_id is not null then s.status else c.status end as status, c.price
    from {current_jobs} c left join {staged_jobs} s on s.job_id = c.job_id
    union all select job_id, status, price from {staged_jobs} where job_id not in (select job_id from {current_jobs})""")
def _(t):
    columns = ["job_id", "status", "price"]
    source = t.staged_jobs.select(*columns)
    target = t.current_jobs.select(*columns)
    updated = upsert.update_columns(target, source, ["job_id"], ["status"])
    return upsert.insert_new(updated, source, ["job_id"])


@query("full_refresh", "M-08 IO-09", """
    select job_id, source_name, status from {staged_jobs}""")
def _(t):
    from worklode.sources.tables import refresh

    return refresh(t.staged_jobs.select("job_id", "source_name", "status"), "full_refresh")


@query("latest_change_per_key", "M-11 W-01", """
    select job_id, change_id, change_type from (select *, row_number() over (partition by job_id, change_type
        order by changed_at desc, change_id desc) as rn from {changes}) where rn = 1""")
def _(t):
    order = [F.desc("changed_at"), F.desc("change_id")]
    return upsert.latest_change(t.changes, ["job_id", "change_type"], order).select("job_id", "change_id", "change_type")


LOGGED = ["company_id", "status", "source_name"]


@query("change_log", "M-12", """
    select coalesce(s.job_id, c.job_id) as job_id,
           case when c.job_id is null then 'INSERT' when s.job_id is null then 'DELETE' else 'UPDATE' end as change_type,
           case when c.job_id is not null and s.job_id is not null then concat_ws(',',
             case when s.company_id is distinct from c.company_id then 'company_id' end,
             case when s.status is distinct from c.status then 'status' end,
             case when s.source_name is distinct from c.source_name then 'source_name' end) end as changed_columns,
           c.status as old_status, s.status as new_status
    from {staged_jobs} s full join {current_jobs} c on s.job_id = c.job_id
    where s.job_id is null or c.job_id is null or s.company_id is distinct from c.company_id
       or s.status is distinct from c.status or s.source_name is distinct from c.source_name""")
def _(t):
    log = upsert.change_log(t.staged_jobs, t.current_jobs, "job_id", LOGGED)
    return log.select("job_id", "change_type", F.array_join("changed_columns", ",").alias("changed_columns"),
                      F.get_json_object("old_value_json", "$.status").alias("old_status"),
                      F.get_json_object("new_value_json", "$.status").alias("new_status"))


@query("undo_batch", "M-13", f"select * replace ({"strftime(last_seen, '%Y-%m-%d %H:%M:%S')"} as last_seen) from {{current_jobs}}")
def _(t):
    log = upsert.change_log(t.staged_jobs, t.current_jobs, "job_id", [c for c in t.current_jobs.columns if c != "job_id"])
    state = upsert.undo_batch(t.staged_jobs, log, "job_id")
    return state.withColumn("last_seen", secs("last_seen"))


FLAGS = "job_id, is_active, false as soft_delete_flag, cast(null as string) as soft_delete_reason"


@query("soft_delete", "M-09 PF-02", f"""
    select job_id, case when status = 'F' then false else is_active end as is_active, status = 'F' as soft_delete_flag,
           case when status = 'F' then 'expired' end as soft_delete_reason from {{current_jobs}}""")
def _(t):
    jobs = t.current_jobs.selectExpr(*FLAGS.split(", "), "status")
    ids = t.current_jobs.filter("status = 'F'")
    state, _log = upsert.soft_delete(jobs, ids, "job_id", True, "expired", AS_OF)
    return state.select("job_id", "is_active", "soft_delete_flag", "soft_delete_reason")


@query("soft_delete_log", "M-09", """
    select job_id, 'DELETE' as change_type, 'expired' as change_reason, cast(is_active as string) as old_is_active,
           'false' as new_is_active from {current_jobs} where status = 'F'""")
def _(t):
    jobs = t.current_jobs.selectExpr(*FLAGS.split(", "), "status")
    _state, log = upsert.soft_delete(jobs, t.current_jobs.filter("status = 'F'"), "job_id", True, "expired", AS_OF)
    return log.select("job_id", "change_type", "change_reason",
                      F.get_json_object("old_value_json", "$.is_active").alias("old_is_active"),
                      F.get_json_object("new_value_json", "$.is_active").alias("new_is_active"))


def rollback(t):
    jobs = t.current_jobs.selectExpr(*FLAGS.split(", "), "source_name as batch_id")
    ledger = t.current_jobs.groupBy(F.col("source_name").alias("batch_id")).agg(F.count(F.lit(1)).alias("records"))
    status = F.when(F.col("batch_id") == "5-LOW", "ROLLED_BACK").otherwise("SUCCESS")
    return upsert.roll_back_batch(jobs, ledger.withColumn("status", status), "2-HIGH", "batch_id")


@query("roll_back_batch", "M-10", """
    select job_id, case when source_name = '2-HIGH' then false else is_active end as is_active,
           source_name = '2-HIGH' as soft_delete_flag, case when source_name = '2-HIGH' then 'BATCH_ROLLBACK' end as soft_delete_reason
    from {current_jobs}""")
def _(t):
    return rollback(t)[0].drop("batch_id")


@query("roll_back_ledger", "M-10 AU-02", """
    select source_name as batch_id, count(*) as records,
           case when source_name in ('2-HIGH', '5-LOW') then 'ROLLED_BACK' else 'SUCCESS' end as status
    from {current_jobs} group by 1""")
def _(t):
    return rollback(t)[1]


# History ----------------------------------------------------------------------------------------

# Prior history: the first 'signup' of each key; changes: every 'signup' and 'purchase'. The hash is the value's band.
PRIOR = """
    select job_id, band, effective_from from (
        select user_id as job_id, cast(floor(value / 20) as int) as band, ts as effective_from,
               row_number() over (partition by user_id order by ts, event_id) as rn
        from {events} where event_type = 'signup') where rn = 1"""
HISTORY_SQL = f"""
    with prior as ({PRIOR}),
    line as (select job_id, band, effective_from, 0 as kind from prior
             union all select user_id, cast(floor(value / 20) as int), ts, 1 from {{events}} e
             where event_type in ('signup', 'purchase')),
    marked as (select *, lag(band) over w as pb, lag(kind) over w as pk from line
               window w as (partition by job_id order by effective_from, kind, band)),
    kept as (select * from marked where pk is null or pb <> band),
    hist as (select job_id, band, effective_from, lead(effective_from) over (partition by job_id order by effective_from, kind, band)
             as effective_to from kept)"""


def history(t):
    prior = t.sql(PRIOR).withColumns(
        {"effective_to": F.lit(None).cast("timestamp_ntz"), "is_current": F.lit(True), "row_hash": F.md5(F.lpad(F.col("band").cast("string"), 4, "0"))}
    )
    feed = t.events.filter(F.col("event_type").isin("signup", "purchase")).select(
        F.col("user_id").alias("job_id"), F.floor(F.col("value") / 20).cast("int").alias("band"), "ts"
    ).withColumn("row_hash", F.md5(F.lpad(F.col("band").cast("string"), 4, "0")))
    return scd2.apply_history(prior, feed, "job_id", ["band"], "row_hash", "ts", F.date_trunc("hour", "effective_from"))


@query("apply_history", "M-04 WH-09", HISTORY_SQL + f"""
    select job_id, band, strftime(effective_from, '{TS}') as effective_from, strftime(effective_to, '{TS}') as effective_to,
           effective_to is null as is_current from hist""")
def _(t):
    return history(t).select("job_id", "band", secs("effective_from"), secs("effective_to"), "is_current")


# Prior state with closed versions and gaps: the first two 'signup' of a key, the first of which ended before the second
# or at it; changes of any time.  SQL writes the end of a closed version as a row of its own.
LATE_PRIOR = """
    select user_id as job_id, cast(floor(value / 20) as int) as band, ts as effective_from,
           case when rn = 1 and nx is not null and user_id % 2 = 0 then ts + (nx - ts) / 2 when rn = 1 then nx end as effective_to
    from (select *, row_number() over (partition by user_id order by ts, event_id) as rn,
                 lead(ts) over (partition by user_id order by ts, event_id) as nx from {events} where event_type = 'signup')
    where rn <= 2"""


@query("apply_history_late", "M-04 WH-09 W-15", f"""
    with prior as ({LATE_PRIOR}),
    feed as (select user_id as job_id, cast(floor(value / 20) as int) as band, ts from {{events}} where event_type = 'purchase'),
    t as (select distinct job_id from feed),
    line as (
        select job_id, band, effective_from, 1 as kind from prior where job_id in (select job_id from t)
        union all select job_id, null, effective_to, 0 from prior p where effective_to is not null and job_id in (select job_id from t)
            and not exists (select 1 from prior q where q.job_id = p.job_id and q.effective_from = p.effective_to)
        union all select job_id, band, ts, 2 from feed),
    marked as (select *, lag(band) over w as pb, lag(kind) over w as pk from line
               window w as (partition by job_id order by effective_from, kind, band)),
    kept as (select * from marked where pk is null or pk = 0 or kind = 0 or pb <> band),
    hist as (select job_id, band, effective_from, kind,
                    lead(effective_from) over (partition by job_id order by effective_from, kind, band) as effective_to from kept),
    whole as (select job_id, band, effective_from, effective_to from hist where kind > 0
              union all select job_id, band, effective_from, effective_to from prior where job_id not in (select job_id from t))
    select job_id, band, strftime(effective_from, '{TS}') as effective_from, strftime(effective_to, '{TS}') as effective_to,
           effective_to is null as is_current from whole""")
def _(t):
    prior = t.sql(LATE_PRIOR).withColumns(
        {"is_current": F.col("effective_to").isNull(), "row_hash": F.md5(F.lpad(F.col("band").cast("string"), 4, "0"))}
    )
    feed = t.events.filter("event_type = 'purchase'").select(
        F.col("user_id").alias("job_id"), F.floor(F.col("value") / 20).cast("int").alias("band"), "ts"
    ).withColumn("row_hash", F.md5(F.lpad(F.col("band").cast("string"), 4, "0")))
    made = scd2.apply_history(prior, feed, "job_id", ["band"], "row_hash", "ts", F.date_trunc("hour", "effective_from"))
    return made.select("job_id", "band", secs("effective_from"), secs("effective_to"), "is_current")


@query("history_kinds", "M-04 J-03", f"""
    with prior as ({PRIOR}),
    s as (select job_id, band from (select user_id as job_id, cast(floor(value / 20) as int) as band,
          row_number() over (partition by user_id order by ts desc, event_id desc) as rn from {{events}}) where rn = 1)
    select s.job_id, case when p.job_id is null then 'INSERT' when p.band <> s.band then 'UPDATE' else 'NOCHANGE' end as change_type
    from s left join prior p on p.job_id = s.job_id""")
def _(t):
    from worklode.operators.ranking import best_per_key

    prior = t.sql(PRIOR).withColumn("is_current", F.lit(True))
    staged = best_per_key(t.events, ["user_id"], [F.desc("ts"), F.desc("event_id")]).select(
        F.col("user_id").alias("job_id"), F.floor(F.col("value") / 20).cast("int").alias("band")
    )
    return scd2.change_kind(prior, staged, "job_id", "band")


@query("version_at_date", "WH-16 J-06", HISTORY_SQL + """
    select job_id, band from hist where effective_from <= timestamp '2024-01-15 00:00:00'
    and (effective_to is null or timestamp '2024-01-15 00:00:00' < effective_to)""")
def _(t):
    return scd2.version_at(history(t), "2024-01-15 00:00:00").select("job_id", "band")


@query("interval_faults", "W-15", f"""
    with v as (select event_id, user_id as job_id, ts as effective_from,
                      case when value < 10 then cast(null as timestamp) when value < 20 then ts + interval 10 day
                           else ts + interval 1 hour end as effective_to from {{events}} where event_type = 'signup'),
    l as (select *, lead(effective_from) over (partition by job_id order by effective_from, event_id) as nx from v)
    select event_id, case when effective_to is null or effective_to > nx then 'OVERLAP' else 'GAP' end as fault
    from l where nx is not null and (effective_to is null or effective_to <> nx)""")
def _(t):
    v = t.sql("""select event_id, user_id as job_id, ts as effective_from,
                 case when value < 10 then null when value < 20 then ts + interval 10 day else ts + interval 1 hour end as effective_to
                 from {events} where event_type = 'signup'""")  # fmt: skip
    return scd2.interval_faults(v, "job_id", F.date_trunc("hour", "effective_from")).select("event_id", "fault")


@query("close_bridge", "M-05 WH-10", """
    with h as (select event_id as job_sk, ts as effective_to, value < 40 as is_current from {events}),
    b as (select o_orderkey as job_sk, cast(o_custkey as int) as skill_sk from {orders}),
    fresh as (select o_orderkey as job_sk, cast(o_custkey as int) as skill_sk from {orders} where o_orderstatus = 'P'
              union all select o_orderkey, -1 from {orders} where o_orderstatus = 'O'),
    alive as (select f.* from fresh f join h on h.job_sk = f.job_sk where h.is_current)
    select b.job_sk, b.skill_sk, case when h.job_sk is not null and not h.is_current then false else true end as is_current,
           case when h.job_sk is not null and not h.is_current then strftime(h.effective_to, '%Y-%m-%d %H:%M:%S') end as effective_to
    from b left join h on h.job_sk = b.job_sk
    where not exists (select 1 from alive a where a.job_sk = b.job_sk and a.skill_sk = b.skill_sk)
    union all select job_sk, skill_sk, true, null from alive""")
def _(t):
    hist = t.events.select(F.col("event_id").alias("job_sk"), F.col("ts").alias("effective_to"), (F.col("value") < 40).alias("is_current"))
    cols = [F.col("o_orderkey").alias("job_sk"), F.col("o_custkey").cast("int").alias("skill_sk"), F.lit(True).alias("is_current"),
            F.lit(None).cast("timestamp_ntz").alias("effective_to")]
    bridge = t.orders.select(*cols)
    fresh = t.orders.filter("o_orderstatus = 'P'").select(*cols).unionByName(
        t.orders.filter("o_orderstatus = 'O'").select(*cols).withColumn("skill_sk", F.lit(-1))
    )
    state = scd2.close_bridge(bridge, hist, fresh, "job_sk", "skill_sk")
    return state.select("job_sk", "skill_sk", "is_current", secs("effective_to"))


# Keys and dimensions ----------------------------------------------------------------------------


@query("dense_keys", "W-13", """
    select c_name, c_custkey, row_number() over (order by c_name) as company_sk from {customer}""")
def _(t):
    return keys.dense_ids(t.customer.select("c_name", "c_custkey"), ["c_name"], "company_sk")


@query("extend_keys", "W-13 M-03", """
    with old as (select c_name, row_number() over (order by c_name) as company_sk from {customer} where c_acctbal > 3000)
    select c_name, company_sk from old
    union all select c_name, (select max(company_sk) from old) + row_number() over (order by c_name) from {customer}
    where c_name not in (select c_name from old)""")
def _(t):
    names = t.customer.select("c_name")
    old = keys.dense_ids(t.customer.filter("c_acctbal > 3000").select("c_name"), ["c_name"], "company_sk")
    return keys.extend_keys(old, names, ["c_name"], "company_sk")


@query("dim_date", "WH-01", """
    with d as (select cast(unnest(generate_series(min(o_orderdate), max(o_orderdate), interval 1 day)) as date) as d from {orders})
    select cast(strftime(d, '%Y%m%d') as int) as date_sk, strftime(d, '%Y-%m-%d') as date_value, year(d) as "year",
           quarter(d) as "quarter", month(d) as "month", monthname(d) as month_name, day(d) as day_of_month,
           isodow(d) as day_of_week, dayname(d) as day_of_week_name, dayofyear(d) as day_of_year, weekofyear(d) as week_of_year,
           isodow(d) >= 6 as is_weekend, day(d) = 1 as is_month_start, last_day(d) = d as is_month_end,
           day(d) = 1 and month(d) in (1, 4, 7, 10) as is_quarter_start, last_day(d) = d and month(d) in (3, 6, 9, 12) as is_quarter_end,
           day(d) = 1 and month(d) = 1 as is_year_start, day(d) = 31 and month(d) = 12 as is_year_end,
           case when month(d) >= 4 then year(d) else year(d) - 1 end as fiscal_year,
           cast(((month(d) - 4 + 12) % 12) // 3 + 1 as int) as fiscal_quarter from d""")
def _(t):
    dim = facts.date_dimension(t.orders, F.min("o_orderdate"), F.max("o_orderdate"), fiscal_start_month=4)
    return dim.withColumn("date_value", F.date_format("date_value", "yyyy-MM-dd"))


@query("dim_source", "WH-02 W-11 W-13", f"""
    select o_orderpriority as source_name, strftime(min(o_orderdate), '{TS}') as first_seen, strftime(max(o_orderdate), '{TS}') as last_seen,
           count(*) as record_count, row_number() over (order by o_orderpriority) as source_sk,
           case when o_orderpriority < '3' then 'FEED' else 'UNKNOWN' end as source_kind
    from {{orders}} group by o_orderpriority""")
def _(t):
    nothing = t.orders.limit(0).select(F.col("o_orderpriority").alias("source_name"), F.lit(0).cast("bigint").alias("source_sk"))
    kinds = t.orders.filter("o_orderpriority < '3'").select(F.col("o_orderpriority").alias("source_name")).distinct()
    dim = facts.source_dimension(t.orders, nothing, "o_orderpriority", "o_orderdate", kinds.withColumn("source_kind", F.lit("FEED")))
    return dim.withColumn("first_seen", secs("first_seen")).withColumn("last_seen", secs("last_seen"))


TAXONOMY = """select p_brand as sector_key, min(p_type) as parent, concat(min(p_name), '| ', max(p_name), '|') as keywords
              from {part} group by p_brand"""


@query("dim_sector", "WH-03 T-21 M-02", f"""
    with x as ({TAXONOMY})
    select sector_key, parent, row_number() over (order by sector_key) as sector_sk,
           concat_ws(',', split_part(keywords, '|', 1), trim(split_part(keywords, '|', 2))) as keywords from x""")
def _(t):
    nothing = t.part.limit(0).select(F.col("p_brand").alias("sector_key"), F.lit(0).cast("bigint").alias("sector_sk"))
    dim = facts.taxonomy_dimension(t.sql(TAXONOMY), nothing, "sector_key", "sector_sk", "keywords")
    return dim.withColumn("keywords", F.array_join("keywords", ","))


@query("dim_role", "WH-04", """
    with one as (select p_name as role_key, min(p_type) as family_key from {part} group by 1),
    fam as (select p_type as family_key, count(*) as family_size from {part} group by 1)
    select role_key, family_key, family_size, role_key like 'old%' as is_senior, false as is_executive,
           row_number() over (order by role_key) as role_sk from one left join fam using (family_key)""")
def _(t):
    roles = t.part.groupBy(F.col("p_name").alias("role_key")).agg(F.min("p_type").alias("family_key"))
    roles = roles.withColumn("seniority", F.when(F.col("role_key").like("old%"), "senior").otherwise("mid"))
    families = t.part.groupBy(F.col("p_type").alias("family_key")).agg(F.count(F.lit(1)).alias("family_size"))
    nothing = t.part.limit(0).select(F.col("p_name").alias("role_key"), F.lit(0).cast("bigint").alias("role_sk"))
    return facts.role_dimension(roles, families, nothing).drop("seniority")


@query("dim_skill", "WH-05", """
    select p_name as skill_key, count(*) as parts, row_number() over (order by p_name) as skill_sk from {part} group by p_name""")
def _(t):
    skills = t.part.groupBy(F.col("p_name").alias("skill_key")).agg(F.count(F.lit(1)).alias("parts"))
    nothing = t.part.limit(0).select(F.col("p_name").alias("skill_key"), F.lit(0).cast("bigint").alias("skill_sk"))
    return keys.extend_keys(nothing, skills, ["skill_key"], "skill_sk")


PLACES = """select case c_mktsegment when 'BUILDING' then n_name when 'FURNITURE' then concat(n_name, ', ', r_name)
                   else concat(c_mktsegment, ', ', n_name, ' , ', r_name) end as place,
                   case when c_acctbal > 0 then 'REMOTE' else 'ONSITE' end as remote_type
            from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey"""


@query("dim_location", "WH-06 T-22 W-03", f"""
    with p as (select place as location_name, bool_or(remote_type = 'REMOTE') as is_remote from ({PLACES}) group by 1),
    s as (select *, string_split(location_name, ',') as a from p)
    select location_name, is_remote, trim(a[1]) as city, case when len(a) >= 3 then trim(a[2]) end as state,
           case when len(a) >= 3 then trim(a[3]) when len(a) = 2 then trim(a[2]) else 'Unknown' end as country,
           row_number() over (order by location_name) as location_sk from s""")
def _(t):
    nothing = t.nation.limit(0).select(F.col("n_name").alias("location_name"), F.lit(0).cast("bigint").alias("location_sk"))
    return facts.location_dimension(t.sql(PLACES), nothing, "place")


MAPPINGS = """select c_name as company_name, cast(1 as decimal(6,4)) - cast(o_totalprice / 1000000 as decimal(6,4)) as confidence,
                     case o_orderstatus when 'F' then 'exact' when 'O' then 'alias' else 'fuzzy' end as method,
                     case when o_orderstatus = 'O' then lower(c_name) else c_name end as said
              from {orders} join {customer} on o_custkey = c_custkey where o_orderdate > timestamp '1997-01-01 00:00:00'"""


@query("dim_company", "WH-07 W-13", f"""
    with m as ({MAPPINGS}),
    st as (select company_name, count(*) as mapping_count, cast(sum(cast(confidence as decimal(18,4))) as double) as confidence_total,
                  arg_min(method, (-confidence, method)) as best_method from m group by 1)
    select c_name as company_name, c_nationkey as nation, coalesce(mapping_count, 0) as mapping_count, confidence_total, best_method,
           row_number() over (order by c_name) as company_sk from {{customer}} left join st on st.company_name = c_name""")
def _(t):
    nothing = t.customer.limit(0).select(F.col("c_name").alias("company_name"), F.lit(0).cast("bigint").alias("company_sk"))
    companies = t.customer.select(F.col("c_name").alias("company_name"), F.col("c_nationkey").alias("nation"))
    return facts.company_dimension(companies, t.sql(MAPPINGS), nothing)


@query("dim_company_alias", "WH-08", f"""
    with m as ({MAPPINGS}),
    g as (select c_custkey as company_sk, said as alias, cast(max(confidence) as double) as confidence, count(*) as seen
          from m join {{customer}} on c_name = company_name where said <> company_name group by 1, 2)
    select *, row_number() over (order by company_sk, alias) as alias_sk from g""")
def _(t):
    told = t.sql(MAPPINGS).withColumn("explanation_json", F.to_json(F.struct(F.col("said").alias("input"), "method")))
    companies = t.customer.select(F.col("c_name").alias("company_name"), F.col("c_custkey").alias("company_sk"))
    nothing = t.customer.limit(0).select(
        F.col("c_custkey").alias("company_sk"), F.col("c_name").alias("alias"), F.lit(0).cast("bigint").alias("alias_sk")
    )
    return facts.company_aliases(told, companies, nothing).withColumn("confidence", F.col("confidence").cast("double"))


# Facts ------------------------------------------------------------------------------------------


@query("fact_postings", "WH-11 W-01 J-05", f"""
    with lc as (select * from (select *, row_number() over (partition by job_id order by changed_at desc, change_id desc) as rn
                from {{changes}}) where rn = 1)
    select c.job_id, coalesce(s.k, -1) as company_sk, coalesce(change_type = 'INSERT', false) as is_new_job,
           coalesce(change_type = 'UPDATE', false) as is_updated_job, coalesce(change_type = 'DELETE', false) as is_soft_delete,
           coalesce(change_type = 'RESTORE', false) as is_restored,
           date_diff('day', cast(last_seen as date), date '{AS_OF}') as days_since_posted
    from {{current_jobs}} c left join lc on lc.job_id = c.job_id
    left join (select c_custkey, min(c_custkey) as k from {{customer}} where c_acctbal > 0 group by 1) s on s.c_custkey = c.company_id""")
def _(t):
    companies = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("company_id"), F.col("c_custkey").alias("sk"))
    fact = facts.posting_fact(t.current_jobs, t.changes, AS_OF, [(companies, "company_id", "sk", "company_sk")])
    return fact.select("job_id", "company_sk", "is_new_job", "is_updated_job", "is_soft_delete", "is_restored", "days_since_posted")


@query("fact_lifecycle", "WH-12 W-08 J-06 J-22 PF-07", """
    with c as (select *, case when change_type = 'INSERT' then 'JOB_CREATED' when change_type = 'DELETE' then 'JOB_DELETED'
                      when old_is_active = 'false' and new_is_active = 'true' then 'JOB_ACTIVATED'
                      when old_is_active = 'true' and new_is_active = 'false' then 'JOB_DEACTIVATED'
                      when old_soft_delete = 'true' and new_soft_delete = 'false' then 'JOB_RESTORED'
                      when change_type = 'UPDATE' then 'JOB_UPDATED' else 'UNKNOWN_TRANSITION' end as event_class,
                      lag(changed_at) over (partition by job_id order by changed_at, change_id) as prev from {changes})
    select change_id, event_class, date_diff('day', cast(prev as date), cast(changed_at as date)) as days_in_previous_state,
           coalesce(version_sk, -1) as job_sk
    from c left join {job_versions} v on v.job_id = c.job_id and v.effective_from <= changed_at
         and (effective_to is null or changed_at < effective_to)
    where c.value >= 5""")
def _(t):
    done = t.changes.filter("value < 5")
    fact = facts.lifecycle_fact(t.changes, t.job_versions, done)
    return fact.select("change_id", "event_class", "days_in_previous_state", "job_sk")


@query("lifecycle_summary", "WH-13", f"""
    select job_id, strftime(min(changed_at), '{TS}') as first_seen, strftime(max(changed_at), '{TS}') as last_seen,
           count(case when change_type = 'UPDATE' then 1 end) as update_count,
           count(case when change_type = 'DELETE' then 1 end) as delete_count,
           count(case when change_type = 'RESTORE' then 1 end) as restore_count,
           date_diff('day', cast(min(changed_at) as date), cast(max(changed_at) as date)) as days_active,
           date_diff('day', cast(max(changed_at) as date), date '{EVENTS_AS_OF}') as days_since_last
    from {{changes}} group by 1""")
def _(t):
    rows = facts.lifecycle_summary(t.changes, EVENTS_AS_OF)
    return rows.withColumn("first_seen", secs("first_seen")).withColumn("last_seen", secs("last_seen"))


RATE = "cast(case currency " + " ".join(f"when '{c}' then {r}" for c, r in fixed.USD_RATES.items()) + " else 1 end as decimal(9,4))"


@query("fact_salary", "WH-14 T-23", f"""
    with s as (select job_sk, observation_no, currency, cast(salary_min as decimal(16,2)) as a, cast(salary_max as decimal(16,2)) as b,
                      {RATE} as r from {{salaries}})
    select job_sk, observation_no, currency, cast(a + b as double) / 2 as salary_midpoint, cast(b - a as double) as salary_range_width,
           a is not null and b is not null as has_salary_range, cast(r as double) as usd_exchange_rate,
           cast(a * r as double) as salary_min_usd, cast(b * r as double) as salary_max_usd from s""")
def _(t):
    fact = facts.salary_fact(t.salaries, fixed.USD_RATES)
    return fact.select("job_sk", "observation_no", "currency", "salary_midpoint", "salary_range_width", "has_salary_range",
                       "usd_exchange_rate", "salary_min_usd", "salary_max_usd")


@query("fact_runs", "WH-15", """
    with q as (select substr(rule_name, 6) as run_name, cast(strftime(evaluated_at, '%Y%m%d') as int) as run_date_sk,
                      count(case when status = 'PASS' then 1 end) as pass_rules, count(case when status = 'WARN' then 1 end) as warn_rules,
                      count(case when status = 'FAIL' then 1 end) as fail_rules, cast(sum(failed_records) as bigint) as failed_records
               from {rule_results} group by 1, 2),
    d as (select run_name, run_date_sk, count(*) as run_count, count(case when status = 'SUCCESS' then 1 end) as success_count,
                 cast(sum(rows_written) as bigint) as rows_written, arg_max(status, (started_at, run_id)) as last_status
          from {runs} group by 1, 2)
    select d.*, coalesce(pass_rules, 0) as pass_rules, coalesce(warn_rules, 0) as warn_rules, coalesce(fail_rules, 0) as fail_rules,
           coalesce(failed_records, 0) as failed_records
    from d left join q using (run_name, run_date_sk)""")
def _(t):
    results = t.rule_results.withColumn("run", F.substring("rule_name", 6, 100))
    return facts.run_fact(t.runs, results, "run_name", "run")
