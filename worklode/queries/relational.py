"""Filters, joins, aggregates, windows, sorts and set operations over the feed."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

from worklode.functions.dates import age_days, key_days_before
from worklode.operators import aggregates as agg
from worklode.operators import joins, ranking
from worklode.plans.feed import AS_OF, EVENTS_AS_OF
from worklode.queries.registry import query

TS = "%Y-%m-%d %H:%M:%S"


def ts_text(col: str):
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


# Filters and predicates -------------------------------------------------------------------------


@query("filter_by_parameters", "PF-02 PF-06 PF-08", """
    select job_id, source_name, status from {current_jobs}
    where source_name in ('1-URGENT', '2-HIGH') and status = 'O' and is_active""")
def _(t):
    wanted = {"source_name": ["1-URGENT", "2-HIGH"], "status": "O", "company_id": None}
    tests = [F.col(c).isin(v) if isinstance(v, list) else F.col(c) == v for c, v in wanted.items() if v is not None]
    kept = t.current_jobs.filter(reduce(lambda a, b: a & b, tests)).filter("is_active")
    return kept.select("job_id", "source_name", "status")


@query("lookback_by_date_key", "PF-03", f"""
    select job_sk, posting_date_sk, sector_sk from {{postings}} where posting_date_sk >= {key_days_before(AS_OF, 365)}""")
def _(t):
    kept = t.postings.filter(F.col("posting_date_sk") >= key_days_before(AS_OF, 365))
    return kept.select("job_sk", "posting_date_sk", "sector_sk")


@query("text_patterns", "PF-04 PF-05", """
    select doc_id, text like '%tion%' as has_piece, text not like '%@%' as no_at,
           regexp_matches(text, '[A-Za-z0-9._]+@[A-Za-z0-9.]+') as has_address,
           regexp_matches(source, '^src[0-9]+$') as good_source
    from {documents}""")
def _(t):
    return t.documents.select(
        "doc_id", F.col("text").like("%tion%").alias("has_piece"), (~F.col("text").like("%@%")).alias("no_at"),
        F.col("text").rlike("[A-Za-z0-9._]+@[A-Za-z0-9.]+").alias("has_address"),
        F.col("source").rlike("^src[0-9]+$").alias("good_source"),
    )


@query("change_classes", "PF-07", """
    select change_id, case when change_type = 'INSERT' then 'JOB_CREATED' when change_type = 'DELETE' then 'JOB_DELETED'
           when old_is_active = 'false' and new_is_active = 'true' then 'JOB_ACTIVATED'
           when old_is_active = 'true' and new_is_active = 'false' then 'JOB_DEACTIVATED'
           when old_soft_delete = 'false' and new_soft_delete = 'true' then 'JOB_SOFT_DELETED'
           when old_soft_delete = 'true' and new_soft_delete = 'false' then 'JOB_RESTORED'
           when change_type = 'UPDATE' then 'JOB_UPDATED' else 'UNKNOWN_TRANSITION' end as event_class
    from {changes}""")
def _(t):
    from worklode.plans.facts import lifecycle_class

    return t.changes.select("change_id", lifecycle_class().alias("event_class"))


@query("range_violations", "PF-09", """
    select l_orderkey, l_linenumber, l_quantity, l_discount from {lineitem}
    where l_discount > 0.08 or l_quantity < 3 or l_quantity > 48""")
def _(t):
    from worklode.operators.quality import out_of_range

    bad = out_of_range("l_discount", high=0.08) | out_of_range("l_quantity", low=3, high=48)
    return t.lineitem.filter(bad).select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")


# Joins ------------------------------------------------------------------------------------------

BATCHES = """select o_orderpriority as source_name, date_trunc('month', o_orderdate) as batch_month, count(*) as job_count
             from {orders} group by 1, 2"""
LEDGER = """select o_orderpriority as source_name, date_trunc('month', o_orderdate) as batch_month
            from {orders} where o_orderstatus = 'F' group by 1, 2 having count(*) > 60"""


@query("unprocessed_batches", "J-01 S-03", f"""
    with b as ({BATCHES}), l as ({LEDGER})
    select b.source_name, strftime(b.batch_month, '%Y-%m') as batch_month, job_count from b
    where not exists (select 1 from l where l.source_name = b.source_name and l.batch_month = b.batch_month)
    order by b.batch_month, b.source_name limit 10""")
def _(t):
    month = F.date_trunc("month", "o_orderdate").alias("batch_month")
    source = F.col("o_orderpriority").alias("source_name")
    batches = t.orders.groupBy(source, month).agg(F.count(F.lit(1)).alias("job_count"))
    ledger = t.orders.filter(F.col("o_orderstatus") == "F").groupBy(source, month).agg(F.count(F.lit(1)).alias("n"))
    todo = joins.unprocessed(batches, ledger.filter("n > 60"), ["source_name", "batch_month"], "batch_month", limit=10)
    return todo.withColumn("batch_month", F.date_format("batch_month", "yyyy-MM"))


@query("resolve_foreign_keys", "J-05 J-20", """
    select l_orderkey, l_linenumber, coalesce(s.k, -1) as supplier_sk, coalesce(n.k, -1) as nation_sk
    from {lineitem} l
    left join (select lower(trim(s_name)) as nk, min(s_suppkey) as k from {supplier} where s_acctbal > 0 group by 1) s
        on lower(trim('Supplier#' || lpad(cast(l_suppkey as varchar), 9, '0') || ' ')) = s.nk
    left join (select n_nationkey as nk, min(n_nationkey) as k from {nation} where n_regionkey <> 2 group by 1) n
        on l_linenumber * 5 = n.nk""")
def _(t):
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", (F.col("l_linenumber") * 5).alias("nation_nk"),
        F.lower(F.trim(F.concat(F.lit("Supplier#"), F.lpad(F.col("l_suppkey").cast("string"), 9, "0"), F.lit(" "))))
        .alias("supplier_nk"),
    )
    suppliers = t.supplier.filter("s_acctbal > 0").withColumn("nk", F.lower(F.trim("s_name")))
    nations = t.nation.filter("n_regionkey <> 2").withColumn("nk", F.col("n_nationkey"))
    resolved = joins.resolve_keys(
        lines,
        [
            (suppliers.withColumnRenamed("nk", "supplier_nk"), "supplier_nk", "s_suppkey", "supplier_sk"),
            (nations.withColumnRenamed("nk", "nation_nk"), "nation_nk", "n_nationkey", "nation_sk"),
        ],
    )
    return resolved.select("l_orderkey", "l_linenumber", "supplier_sk", "nation_sk")


@query("change_with_version", "J-06 WH-12", """
    select c.change_id, v.version_sk as version_version_sk
    from {changes} c left join {job_versions} v on c.job_id = v.job_id and v.effective_from <= c.changed_at
         and (c.changed_at < v.effective_to or v.effective_to is null)""")
def _(t):
    found = joins.value_as_of(
        t.changes, t.job_versions, "job_id", "changed_at", "effective_from", "effective_to", ["version_sk"],
        F.date_trunc("hour", "_at"),
    )
    return found.select("change_id", "version_version_sk")


@query("max_date_on_every_row", "J-12 J-19", """
    select job_sk, posting_date_sk, (select max(posting_date_sk) from {postings}) as latest_date_sk from {postings}""")
def _(t):
    latest = t.postings.select(F.max("posting_date_sk")).scalar()
    return t.postings.select("job_sk", "posting_date_sk", latest.alias("latest_date_sk"))


@query("missing_parent", "J-13 J-16", """
    select o_orderkey, o_custkey from {orders} o
    where not exists (select 1 from {customer} c where c.c_custkey = o.o_custkey and c_acctbal > 0)""")
def _(t):
    return joins.orphans(t.orders, t.customer.filter("c_acctbal > 0"), {"o_custkey": "c_custkey"}).select(
        "o_orderkey", "o_custkey"
    )


@query("missing_any_parent", "J-13", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey from {lineitem} l
    where not exists (select 1 from {part} where p_partkey = l_partkey and p_size > 5)
       or not exists (select 1 from {supplier} where s_suppkey = l_suppkey and s_acctbal > 500)""")
def _(t):
    parents = [(t.part.filter("p_size > 5"), "l_partkey", "p_partkey"),
               (t.supplier.filter("s_acctbal > 500"), "l_suppkey", "s_suppkey")]
    return joins.orphans_of_any(t.lineitem, parents).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


PAIRS = [
    ("orders", "o_custkey", "customer", "c_custkey", "c_acctbal > 0"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey", "o_orderstatus <> 'P'"),
    ("lineitem", "l_partkey", "part", "p_partkey", "p_size > 3"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey", "s_acctbal > 0"),
    ("customer", "c_nationkey", "nation", "n_nationkey", "n_regionkey > 0"),
    ("supplier", "s_nationkey", "nation", "n_nationkey", "n_regionkey > 0"),
    ("nation", "n_regionkey", "region", "r_regionkey", "r_name <> 'ASIA'"),
    ("labels", "doc_id", "documents", "doc_id", "lang = 'en'"),
]


@query("orphan_report", "J-16 U-03", " union all ".join(
    f"select '{c}.{ck}' as relation, count(*) as orphan_rows from {{{c}}} a where {ck} is not null and not exists "
    f"(select 1 from {{{p}}} b where b.{pk} = a.{ck} and {cond})" for c, ck, p, pk, cond in PAIRS))
def _(t):
    def count(c, ck, p, pk, cond):
        lost = joins.orphans(getattr(t, c), getattr(t, p).filter(cond), {ck: pk})
        return lost.agg(F.count(F.lit(1)).alias("orphan_rows")).select(F.lit(f"{c}.{ck}").alias("relation"), "orphan_rows")

    return reduce(lambda a, b: a.unionByName(b), [count(*p) for p in PAIRS])


@query("dimension_still_used", "J-14 J-18", """
    select p_partkey, p_name from {part} where p_size < 10 and exists (select 1 from {lineitem} where l_partkey = p_partkey)
    and p_brand in (select p_brand from {part} group by p_brand having count(*) > 60)""")
def _(t):
    big = t.part.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n")).filter("n > 60")
    used = t.part.filter("p_size < 10").join(t.lineitem, F.col("p_partkey") == F.col("l_partkey"), "left_semi")
    return used.join(big, "p_brand", "left_semi").select("p_partkey", "p_name")


@query("not_in_with_nulls", "J-15", """
    select c_custkey from {customer} where c_custkey not in (select o_custkey from {orders} where o_orderstatus = 'F')""")
def _(t):
    finished = t.orders.filter(F.col("o_orderstatus") == "F")
    return joins.not_in(t.customer, "c_custkey", finished, "o_custkey").select("c_custkey")


@query("reconcile_mart", "J-17 DQ-07", """
    with s as (select sector_sk, role_sk, count(*) as jobs, count(distinct company_sk) as companies from {postings} group by 1, 2),
    g as (select sector_sk, role_sk, count(*) as jobs, count(distinct company_sk) as companies from {postings}
          where role_sk <> 5 and (active_flag or sector_sk <> 2) group by 1, 2)
    select coalesce(s.sector_sk, g.sector_sk) as sector_sk, coalesce(s.role_sk, g.role_sk) as role_sk,
           s.jobs as source_jobs, g.jobs as target_jobs, s.companies as source_companies, g.companies as target_companies
    from s full join g on s.sector_sk = g.sector_sk and s.role_sk = g.role_sk
    where s.jobs is distinct from g.jobs or s.companies is distinct from g.companies""")
def _(t):
    def summary(df):
        return df.groupBy("sector_sk", "role_sk").agg(
            F.count(F.lit(1)).alias("jobs"), F.countDistinct("company_sk").alias("companies")
        )

    partial = t.postings.filter((F.col("role_sk") != 5) & (F.col("active_flag") | (F.col("sector_sk") != 2)))
    return joins.reconcile(summary(t.postings), summary(partial), ["sector_sk", "role_sk"], ["jobs", "companies"])


@query("value_or_alias_member", "J-21", """
    with d as (select p_brand, p_name from {part} where p_size < 2),
    names as (select p_brand as v from d union select unnest(string_split(p_name, ' ')) from d)
    select p_partkey, p_name from {part}
    where p_brand not in (select v from names) or split_part(p_name, ' ', 1) not in (select v from names)""")
def _(t):
    dims = t.part.filter("p_size < 2").select("p_brand", F.split("p_name", " ").alias("aliases"))
    names = dims.select(F.explode(F.concat(F.array("p_brand"), "aliases")).alias("v")).distinct()
    parts = t.part.select("p_partkey", "p_name", "p_brand", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("word"))
    return joins.orphans_of_any(parts, [(names, "p_brand", "v"), (names, "word", "v")]).select("p_partkey", "p_name")


@query("append_only_new", "J-22 M-03", """
    select job_id, status from {current_jobs}
    union all select job_id, status from {staged_jobs} s
    where not exists (select 1 from {current_jobs} c where c.job_id = s.job_id)""")
def _(t):
    from worklode.operators.upsert import insert_new

    columns = ["job_id", "status"]
    return insert_new(t.current_jobs.select(*columns), t.staged_jobs.select(*columns), ["job_id"])


@query("star_report", "J-23 A-10", """
    select country, s.sector_name, role_name, count(*) as jobs, count(distinct f.company_sk) as companies,
           cast(sum(cast(price as decimal(18,2))) as double) as total_price
    from {postings} f join {sectors} s on s.sector_sk = f.sector_sk join {roles} r on r.role_sk = f.role_sk
    left join {locations} l on l.location_sk = f.location_sk join {companies} c on c.company_sk = f.company_sk
    where c.balance > 0 group by 1, 2, 3""")
def _(t):
    f = t.postings.select("sector_sk", "role_sk", "location_sk", "company_sk", "price")
    companies = t.companies.filter("balance > 0").select("company_sk")
    star = (
        f.join(companies, "company_sk").join(t.sectors.select("sector_sk", "sector_name"), "sector_sk")
        .join(t.roles, "role_sk").join(t.locations, "location_sk", "left")
    )
    return star.groupBy("country", "sector_name", "role_name").agg(
        F.count(F.lit(1)).alias("jobs"), F.countDistinct("company_sk").alias("companies"),
        agg.exact_sum("price").alias("total_price"),
    )


# Aggregates -------------------------------------------------------------------------------------


@query("payload_duplicates", "A-01 T-06 W-02", f"""
    select md5(text) as payload_hash, count(*) as occurrences, arg_min(doc_id, doc_id) as first_id,
           arg_min(source, doc_id) as first_source, min(n_chars) as first_seen, max(n_chars) as last_seen,
           count(*) > 1 as is_duplicate from {{documents}} group by 1""")
def _(t):
    hashed = t.documents.select(F.md5("text").alias("payload_hash"), "doc_id", "source", "n_chars")
    return agg.duplicate_stats(
        hashed, ["payload_hash"], ["doc_id"], {"first_id": "doc_id", "first_source": "source"}, "n_chars"
    )


@query("distribution", "A-11 A-17 S-01", """
    select event_type, count(*) as row_count, cast(count(*) as double) / (select count(*) from {events}) as share
    from {events} group by 1""")
def _(t):
    return agg.share_of_total(t.events, ["event_type"]).orderBy(F.desc("row_count"), "event_type")


@query("distinct_keys", "A-12", "select distinct o_custkey, o_orderpriority from {orders}")
def _(t):
    return t.orders.select("o_custkey", "o_orderpriority").distinct()


@query("duplicate_business_keys", "A-14", """
    select l_orderkey, l_linenumber, count(*) as key_rows from {lineitem} group by 1, 2 having count(*) > 1""")
def _(t):
    return agg.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


COUNTED = {"current_jobs": ["job_id", "source_name", "status"], "changes": ["change_id", "job_id", "props"],
           "job_versions": ["version_sk", "effective_to"], "postings": ["job_sk", "company_sk", "remote_type"]}


@query("row_and_null_counts", "A-15", " union all ".join(
    f"select '{tb}' as table_name, count(*) as total_rows, '{c}' as column_name, count(*) - count({c}) as nulls from {{{tb}}}"
    for tb, cols in COUNTED.items() for c in cols))
def _(t):
    return reduce(lambda a, b: a.unionByName(b), [agg.null_counts(getattr(t, n), c, n) for n, c in COUNTED.items()])


@query("age_buckets", "A-16 Q-05", f"""
    select case when d <= 7 then '0-7' when d <= 14 then '8-14' when d <= 21 then '15-21' else '22+' end as age_bucket,
           status, count(*) as records
    from (select status, date_diff('day', cast(quarantined_at as date), date '{EVENTS_AS_OF}') as d from {{quarantine}})
    group by 1, 2""")
def _(t):
    from worklode.operators.quarantine import age_buckets

    return age_buckets(t.quarantine, EVENTS_AS_OF, [7, 14, 21])


@query("run_time_trend", "A-18", """
    select strftime(date_trunc('week', started_at), '%Y-%m-%d') as week, run_name, count(*) as runs,
           cast(sum(runtime_seconds) as double) / count(*) as avg_seconds, max(runtime_seconds) as max_seconds
    from {runs} group by 1, 2""")
def _(t):
    week = F.date_format(F.date_trunc("week", "started_at"), "yyyy-MM-dd").alias("week")
    return t.runs.groupBy(week, "run_name").agg(
        F.count(F.lit(1)).alias("runs"),
        (F.sum("runtime_seconds").cast("double") / F.count(F.lit(1))).alias("avg_seconds"),
        F.max("runtime_seconds").alias("max_seconds"),
    )


@query("percentiles_by_priority", "A-04", """
    select o_orderpriority, count(*) as n, round(quantile_cont(o_totalprice, 0.25), 4) as p25,
           round(quantile_cont(o_totalprice, 0.5), 4) as p50, round(quantile_cont(o_totalprice, 0.75), 4) as p75,
           round(quantile_cont(o_totalprice, 0.9), 4) as p90 from {orders} group by 1""")
def _(t):
    from worklode.operators.quantiles import exact_percentiles

    probs = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}
    found = exact_percentiles(t.orders, ["o_orderpriority"], "o_totalprice", probs, "n")
    return found.select("o_orderpriority", "n", *[F.round(p, 4).alias(p) for p in probs])


@query("invalid_values", "A-08", """
    select source_name, status, count(*) as rows_with_value from {quarantine} where status is not null group by 1, 2""")
def _(t):
    return agg.value_counts(t.quarantine, ["source_name"], "status")


@query("conditional_counts", "A-02 A-03 A-09", """
    select o_orderpriority, count(case when o_orderstatus = 'O' then 1 end) as open_jobs,
           count(distinct case when o_orderstatus = 'O' then o_custkey end) as open_companies,
           count(distinct o_custkey) as companies,
           cast(count(case when o_orderstatus = 'O' then 1 end) as double) / cast(count(*) as double) as open_ratio,
           cast(sum(cast(o_totalprice as decimal(18,2))) as double) / cast(count(o_totalprice) as double) as avg_price
    from {orders} group by 1""")
def _(t):
    is_open = F.col("o_orderstatus") == "O"
    return t.orders.groupBy("o_orderpriority").agg(
        agg.count_where(is_open).alias("open_jobs"),
        agg.distinct_where(is_open, "o_custkey").alias("open_companies"),
        F.countDistinct("o_custkey").alias("companies"),
        agg.guarded_ratio(agg.count_where(is_open), F.count(F.lit(1))).alias("open_ratio"),
        agg.exact_mean("o_totalprice").alias("avg_price"),
    )


# Windows ----------------------------------------------------------------------------------------


@query("latest_per_key", "W-01 AU-12", """
    select job_id, change_id, change_type from (
        select *, row_number() over (partition by job_id order by changed_at desc, change_id desc) as rn from {changes})
    where rn = 1""")
def _(t):
    latest = ranking.best_per_key(t.changes, ["job_id"], [F.desc("changed_at"), F.desc("change_id")])
    return latest.select("job_id", "change_id", "change_type")


@query("first_per_hash", "W-02", """
    select payload_hash, doc_id, source from (select md5(text) as payload_hash, doc_id, source,
           row_number() over (partition by md5(text) order by n_chars, doc_id) as rn from {documents}) where rn = 1""")
def _(t):
    hashed = t.documents.select(F.md5("text").alias("payload_hash"), "doc_id", "source", "n_chars")
    return ranking.best_per_key(hashed, ["payload_hash"], [F.asc("n_chars"), F.asc("doc_id")]).drop("n_chars")


@query("best_candidate_nulls_last", "W-03", """
    select p_brand, p_partkey from (select p_brand, p_partkey, row_number() over (partition by p_brand
           order by case when p_size > 25 then p_retailprice end desc nulls last, p_partkey) as rn from {part}) where rn = 1""")
def _(t):
    score = F.when(F.col("p_size") > 25, F.col("p_retailprice"))
    best = ranking.best_per_key(t.part, ["p_brand"], [score.desc_nulls_last(), F.asc("p_partkey")])
    return best.select("p_brand", "p_partkey")


@query("top_n_with_ties", "W-05", """
    select p_brand, p_type, n, cast(demand_rank as int) as demand_rank from (
        select *, dense_rank() over (partition by p_brand order by n desc) as demand_rank from (
            select p_brand, p_type, count(*) as n from {part} group by 1, 2)) where demand_rank <= 2""")
def _(t):
    counts = t.part.groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n"))
    return ranking.top_n_with_ties(counts, ["p_brand"], [F.desc("n")], 2, "demand_rank")


@query("previous_row_change", "W-07 W-08", f"""
    select change_id, job_id, strftime(prev_at, '{TS}') as prev_at, prev_type,
           date_diff('day', cast(prev_at as date), cast(changed_at as date)) as days_in_previous_state
    from (select *, lag(changed_at) over w as prev_at, lag(change_type) over w as prev_type from {{changes}}
          window w as (partition by job_id order by changed_at, change_id))""")
def _(t):
    line = ranking.shifted(
        t.changes, ["job_id"], ["changed_at", "change_id"],
        {"prev_at": "changed_at", "prev_type": "change_type"}, F.date_trunc("hour", "changed_at"),
    )
    return line.select(
        "change_id", "job_id", ts_text("prev_at").alias("prev_at"), "prev_type",
        F.datediff("changed_at", "prev_at").alias("days_in_previous_state"),
    )


@query("rolling_means", "W-09", """
    with d as (select user_id, cast(ts as date) as day, count(*) as n from {events} group by 1, 2)
    select user_id, strftime(day, '%Y-%m-%d') as day, n,
           cast(sum(n) over (partition by user_id order by day rows between 6 preceding and current row) as double)
             / count(n) over (partition by user_id order by day rows between 6 preceding and current row) as mean_7_rows,
           cast(sum(n) over (partition by user_id order by day range between interval 6 day preceding and current row) as double)
             / count(n) over (partition by user_id order by day range between interval 6 day preceding and current row) as mean_7_days
    from d""")
def _(t):
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    both = ranking.rolling_mean(daily, ["user_id"], "day", "n", "mean_7_rows")
    both = ranking.rolling_mean_days(both, ["user_id"], "day", "n", "mean_7_days")
    return both.withColumn("day", F.date_format("day", "yyyy-MM-dd"))


@query("uniqueness_flag", "W-10", """
    select l_orderkey, l_linenumber, l_partkey, count(*) over (partition by l_orderkey, l_linenumber) as key_rows
    from {lineitem}""")
def _(t):
    counted = ranking.key_counts(t.lineitem, ["l_orderkey", "l_linenumber"])
    return counted.select("l_orderkey", "l_linenumber", "l_partkey", "key_rows")


@query("first_and_last_seen", "W-11", f"""
    select source_name, strftime(min(last_seen), '{TS}') as first_seen, strftime(max(last_seen), '{TS}') as last_seen
    from {{current_jobs}} group by 1""")
def _(t):
    ends = t.current_jobs.groupBy("source_name").agg(F.min("last_seen").alias("a"), F.max("last_seen").alias("b"))
    return ends.select("source_name", ts_text("a").alias("first_seen"), ts_text("b").alias("last_seen"))


# Sorts and set operations -----------------------------------------------------------------------


@query("severity_order", "S-02", """
    select severity, count(*) as n from {rule_results} group by 1
    order by case severity when 'ERROR' then 1 when 'WARNING' then 2 else 3 end""")
def _(t):
    order = F.when(F.col("severity") == "ERROR", 1).when(F.col("severity") == "WARNING", 2).otherwise(3)
    return t.rule_results.groupBy("severity").agg(F.count(F.lit(1)).alias("n")).orderBy(order)


@query("top_k_jobs", "S-03 S-01", """
    select o_orderkey, o_totalprice from {orders} order by o_totalprice desc, o_orderkey limit 20""")
def _(t):
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(20)


@query("latest_batch", "S-04", f"""
    select arg_max(change_id, (changed_at, change_id)) as change_id, strftime(max(changed_at), '{TS}') as changed_at
    from {{changes}}""")
def _(t):
    latest = t.changes.agg(
        F.max_by("change_id", F.struct("changed_at", "change_id")).alias("change_id"), F.max("changed_at").alias("m")
    )
    return latest.select("change_id", ts_text("m").alias("changed_at"))


@query("union_of_aligned_sets", "U-01 U-04", """
    select 'customer' as kind, cast(c_custkey as varchar) as node, cast(c_acctbal as double) as weight from {customer}
    union all select 'supplier', cast(s_suppkey as varchar), cast(s_acctbal as double) from {supplier}
    union all select 'part', cast(p_partkey as varchar), cast(p_size as double) from {part}""")
def _(t):
    def edges(df, kind, node, weight):
        return df.select(F.lit(kind).alias("kind"), F.col(node).cast("string").alias("node"),
                         F.col(weight).cast("double").alias("weight"))

    parts = [edges(t.customer, "customer", "c_custkey", "c_acctbal"), edges(t.supplier, "supplier", "s_suppkey", "s_acctbal"),
             edges(t.part, "part", "p_partkey", "p_size")]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("expected_minus_found", "U-05", """
    select distinct c_nationkey as nation from {customer} where c_acctbal > 0
    except select distinct s_nationkey from {supplier} where s_acctbal > 4000""")
def _(t):
    expected = t.customer.filter("c_acctbal > 0").select(F.col("c_nationkey").alias("nation")).distinct()
    found = t.supplier.filter("s_acctbal > 4000").select(F.col("s_nationkey").alias("nation")).distinct()
    return expected.exceptAll(found)


@query("week_over_week", "W-14 A-18", f"""
    with w as (select event_type, date_trunc('week', ts) as wk, count(*) as n from {{events}} group by 1, 2),
    l as (select *, lag(n) over (partition by event_type order by wk) as p from w)
    select event_type, strftime(wk, '%Y-%m-%d') as week, n,
           case when p > 0 then cast(n - p as double) / cast(p as double) end as growth from l""")
def _(t):
    weekly = t.events.groupBy("event_type", F.date_trunc("week", "ts").alias("wk")).agg(F.count(F.lit(1)).alias("n"))
    p = F.lag("n").over(Window.partitionBy("event_type").orderBy("wk"))
    return weekly.select("event_type", F.date_format("wk", "yyyy-MM-dd").alias("week"), "n",
                         ranking.change_ratio(F.col("n"), p).alias("growth"))


@query("stale_jobs", "PF-08 PF-09", f"""
    select job_id, date_diff('day', cast(last_seen as date), date '{AS_OF}') as age from {{current_jobs}}
    where is_active and date_diff('day', cast(last_seen as date), date '{AS_OF}') > 365""")
def _(t):
    aged = t.current_jobs.withColumn("age", age_days(AS_OF, F.col("last_seen")))
    return aged.filter(F.col("is_active") & (F.col("age") > 365)).select("job_id", "age")
