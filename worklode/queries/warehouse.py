"""The star schema from end to end: two loads, the second one given twice, which must change nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklode.operators import classify, joins
from worklode.operators.dictionaries import literal_dictionary
from worklode.plans import warehouse
from worklode.queries.registry import query
from worklode.session import write_table

TS = "%Y-%m-%d %H:%M:%S"
SECTORS = [{"sector_id": 1, "words": ["urgent", "mach"]}, {"sector_id": 2, "words": ["high", "build"]},
           {"sector_id": 3, "words": ["medium", "auto"]}, {"sector_id": 4, "words": ["spec", "house", "low"]}]

# Two loads of jobs.  The second one holds changed hashes, and every tenth job comes with a time before its first version.
JOBS = """
    select job_id, c_name as company_name, n_name as location_name, source_name as title, c_mktsegment as description,
           source_name, record_hash, is_active, not is_active as soft_delete, last_seen as posted_at,
           {1} as updated_at
    from {{{0}}} join {{customer}} on company_id = c_custkey join {{nation}} on c_nationkey = n_nationkey"""
FIRST = JOBS.format("current_jobs", "last_seen")
SECOND = JOBS.format("staged_jobs", "case when job_id % 10 = 0 then last_seen - interval 1 day else last_seen + interval 1 day end")
KNOWN = "select c_name as company_name, c_custkey as company_sk, c_acctbal as balance from {customer} where c_acctbal > 0"
ALL = "select c_name as company_name, c_acctbal as balance from {customer}"
PLACES = "select n_name as location_name, n_nationkey as location_sk from {nation} where n_regionkey <> 2"
SOURCES = "select o_orderpriority as source_name, min(cast(substr(o_orderpriority, 1, 1) as bigint)) as source_sk from {orders} where o_orderpriority <> '5-LOW' group by o_orderpriority"
EVIDENCE = """
    select l_orderkey as job_id, case when l_suppkey % 2 = 0 then concat(' ', lower(p_brand)) else p_brand end as skill_name,
           cast(l_discount as decimal(4,2)) as confidence, l_returnflag as evidence_type, cast(l_linenumber as int) as source_priority
    from {lineitem} join {part} on l_partkey = p_partkey"""
SKILLS = "select skill_sk, skill_name from {skills} where skill_sk <> 11"
ATTRIBUTES = ["company_sk", "location_sk", "sector_sk", "title"]


def score_sql(entry) -> str:
    title = " + ".join(f"contains(lower(title), '{w}')::int" for w in entry["words"])
    body = " + ".join(f"contains(lower(description), '{w}')::int" for w in entry["words"])
    return f"select job_id, lot, {entry['sector_id']} as id, 2 * ({title}) + ({body}) as score from lots"


# The loads as plain SQL: each version with the lot that brought it, numbered in the order of the lots.
BUILD_SQL = f"""
    with lots as (select 1 as lot, * from ({FIRST}) union all select 2, * from ({SECOND})),
    known as ({KNOWN}),
    inferred as (select company_name, (select max(company_sk) from known) + row_number() over (order by company_name) as company_sk
                 from (select distinct company_name from lots where lot = 1 and company_name not in (select company_name from known))),
    named as (select company_name, company_sk from known union all select * from inferred),
    firms as (select * from named union all
              select c_name, (select max(company_sk) from named) + row_number() over (order by c_name) from {{customer}}
              where c_name not in (select company_name from named)),
    points as ({" union all ".join(score_sql(e) for e in SECTORS)}),
    sector as (select job_id, lot, id from points where score >= 2
               qualify row_number() over (partition by job_id, lot order by score desc, id) = 1),
    keyed as (select l.*, coalesce(f.company_sk, -1) as company_sk, coalesce(p.location_sk, -1) as location_sk, coalesce(s.id, -1) as sector_sk
              from lots l left join firms f on f.company_name = l.company_name left join ({PLACES}) p on p.location_name = l.location_name
              left join sector s on s.job_id = l.job_id and s.lot = l.lot),
    line as (select * from keyed b where lot = 1 or not exists (select 1 from keyed a where a.lot = 1 and a.job_id = b.job_id
             and a.record_hash = b.record_hash and a.updated_at >= b.updated_at)),
    kept as (select * from (select *, lag(record_hash) over (partition by job_id order by updated_at, lot, record_hash) as ph from line)
             where ph is null or ph <> record_hash),
    dim as (select *, updated_at as effective_from, row_number() over (order by lot, job_id, updated_at, record_hash) as job_sk,
                   lead(updated_at) over (partition by job_id order by updated_at, lot, record_hash) as effective_to from kept),
    latest as (select * from dim where effective_to is null)"""


def resolved(t, jobs, companies):
    words = literal_dictionary(SECTORS, ["sector_id", "words"])
    scored = classify.score_sectors(jobs, "job_id", "title", "description", words, threshold=2)
    needed = scored.select("job_id", "company_name", "location_name", "title", "record_hash", "updated_at", F.col("sector_id").cast("int").alias("sector_sk"))
    lookups = [(companies, "company_name", "company_sk", "company_sk"), (t.sql(PLACES), "location_name", "location_sk", "location_sk")]
    return write_table(joins.resolve_keys(needed, lookups).select("job_id", *ATTRIBUTES, "record_hash", "updated_at"))


def companies(t):
    """The company dimension after the first and after the second load."""
    known = t.sql(KNOWN).withColumn("is_inferred", F.lit(False))
    first = write_table(warehouse.infer_members(known, "company_name", "company_sk", t.sql(FIRST)))
    return first, write_table(warehouse.fill_members(first, "company_name", "company_sk", t.sql(ALL)))


def job_dimensions(t):
    """The job dimension after the first load, and after the second one given twice."""
    month = F.date_trunc("month", "effective_from")
    before, after = companies(t)
    first = resolved(t, t.sql(FIRST), before)
    nothing = first.limit(0).select(
        "job_id", *ATTRIBUTES, F.lit(0).cast("bigint").alias("job_sk"), "record_hash", F.col("updated_at").alias("effective_from"),
        F.col("updated_at").alias("effective_to"), F.lit(True).alias("is_current"),
    )
    states = [warehouse.job_dimension(nothing, first, ATTRIBUTES, month)]
    second = resolved(t, t.sql(SECOND), after)
    states.append(warehouse.job_dimension(states[0], second, ATTRIBUTES, month))
    states.append(warehouse.job_dimension(states[1], second, ATTRIBUTES, month))
    return states


@query("dim_company_inferred", "WH-03 J-05", BUILD_SQL + """
    select company_name, cast(company_sk as bigint) as company_sk, c_acctbal as balance, false as is_inferred
    from firms join {customer} on c_name = company_name""")
def _(t):
    _, after = companies(t)
    return after.select("company_name", F.col("company_sk").cast("bigint").alias("company_sk"), "balance", "is_inferred")


@query("dim_job_build", "WH-09 M-04 J-05 T-11", BUILD_SQL + f"""
    select job_sk, job_id, company_sk, location_sk, sector_sk, title, strftime(effective_from, '{TS}') as effective_from,
           strftime(effective_to, '{TS}') as effective_to, effective_to is null as is_current from dim""")
def _(t):
    dim = job_dimensions(t)[-1]
    ends = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("effective_from", "effective_to")]
    return dim.select("job_sk", "job_id", *ATTRIBUTES, *ends, "is_current")


BRIDGE_SQL = BUILD_SQL + f""",
    told as (select job_id, skill_sk, confidence, evidence_type, source_priority from ({EVIDENCE}) e
             join ({SKILLS}) s on lower(trim(e.skill_name)) = lower(trim(s.skill_name))),
    start as (select * from dim where lot = 1),
    b1 as (select job_sk, skill_sk, confidence, evidence_type, source_priority, effective_from
           from told join start using (job_id) where source_priority <= 3
           qualify row_number() over (partition by job_sk, skill_sk order by confidence desc, source_priority, evidence_type) = 1),
    k1 as (select *, row_number() over (order by job_sk, skill_sk) as bridge_sk from b1),
    b2 as (select job_sk, skill_sk, confidence, evidence_type, source_priority, effective_from
           from told join latest using (job_id)
           qualify row_number() over (partition by job_sk, skill_sk order by confidence desc, source_priority, evidence_type) = 1),
    new2 as (select b2.*, (select coalesce(max(bridge_sk), 0) from k1) + row_number() over (order by job_sk, skill_sk) as bridge_sk
             from b2 where not exists (select 1 from k1 where k1.job_sk = b2.job_sk and k1.skill_sk = b2.skill_sk)),
    whole as (
        select bridge_sk, b2.* from b2 join k1 on k1.job_sk = b2.job_sk and k1.skill_sk = b2.skill_sk
        union all select bridge_sk, * exclude (bridge_sk) from new2
        union all select bridge_sk, * exclude (bridge_sk) from k1
        where not exists (select 1 from b2 where k1.job_sk = b2.job_sk and k1.skill_sk = b2.skill_sk))"""


@query("bridge_build", "WH-10 M-05", BRIDGE_SQL + f"""
    select bridge_sk, w.job_sk, skill_sk, cast(confidence as double) as confidence, evidence_type, source_priority,
           strftime(d.effective_to, '{TS}') as effective_to, d.effective_to is null as is_current
    from whole w join dim d on d.job_sk = w.job_sk""")
def _(t):
    dims = job_dimensions(t)
    evidence, skills = write_table(t.sql(EVIDENCE)), t.sql(SKILLS)
    nothing = dims[0].join(evidence, "job_id").limit(0).select(
        F.lit(0).cast("bigint").alias("bridge_sk"), "job_sk", F.lit(0).alias("skill_sk"),
        "confidence", "evidence_type", "source_priority", "effective_from", "effective_to", "is_current",
    )
    bridge = write_table(warehouse.skill_bridge(nothing, evidence.filter("source_priority <= 3"), dims[0], skills))
    for dim in dims[1:]:
        bridge = write_table(warehouse.skill_bridge(bridge, evidence, dim, skills))
    return bridge.select(
        "bridge_sk", "job_sk", "skill_sk", F.col("confidence").cast("double").alias("confidence"), "evidence_type", "source_priority",
        F.date_format("effective_to", "yyyy-MM-dd HH:mm:ss").alias("effective_to"), "is_current",
    )


@query("fact_postings_build", "WH-11 W-01 J-05", BUILD_SQL + f""",
    last as (select job_id, change_type from {{changes}} qualify row_number() over (partition by job_id order by changed_at desc, change_id desc) = 1),
    posted as (
        select l.lot, v.job_sk, v.company_sk, v.location_sk, v.sector_sk, coalesce(s.source_sk, -1) as source_sk,
               cast(strftime(l.posted_at, '%Y%m%d') as int) as posting_date_sk, l.is_active as active_flag,
               coalesce(change_type, 'INSERT') = 'INSERT' as is_new_job, coalesce(change_type = 'UPDATE', false) as is_update,
               l.soft_delete as is_soft_delete, coalesce(change_type = 'RESTORE', false) as is_restore
        from lots l join (select 1 as lot, * exclude (lot) from dim where lot = 1 union all select 2, * exclude (lot) from latest) v
             on v.job_id = l.job_id and v.lot = l.lot
        left join ({SOURCES}) s on s.source_name = l.source_name left join last on last.job_id = l.job_id),
    f1 as (select *, row_number() over (order by job_sk) as fact_sk from posted where lot = 1),
    f2 as (select *, (select max(fact_sk) from f1) + row_number() over (order by job_sk) as fact_sk from posted
           where lot = 2 and job_sk not in (select job_sk from f1))
    select f1.* exclude (lot, active_flag, is_soft_delete), coalesce(p.active_flag, f1.active_flag) as active_flag,
           coalesce(p.is_soft_delete, f1.is_soft_delete) as is_soft_delete
    from f1 left join posted p on p.lot = 2 and p.job_sk = f1.job_sk
    union all select * exclude (lot, active_flag, is_soft_delete), active_flag, is_soft_delete from f2""")
def _(t):
    sources = t.sql(SOURCES)
    dims = job_dimensions(t)
    flags = ["active_flag", "is_new_job", "is_update", "is_soft_delete", "is_restore"]
    ids = dims[0].limit(0).select("job_sk", *ATTRIBUTES[:3])
    nothing = ids.select(
        "*", F.lit(0).cast("bigint").alias("source_sk"), F.lit(0).alias("posting_date_sk"),
        *[F.lit(True).alias(f) for f in flags], F.lit(0).cast("bigint").alias("fact_sk"),
    )
    fact = write_table(warehouse.posting_fact(nothing, t.sql(FIRST), t.changes, dims[0], sources))
    for dim in dims[1:]:
        fact = write_table(warehouse.posting_fact(fact, t.sql(SECOND), t.changes, dim, sources))
    return fact
