"""The job-feed tables, derived from the driver's generic tables.

The driver has no postings table, so every feed table is one SQL projection over its tables.  The
texts keep to the SQL both Spark and DuckDB understand: Spark runs them through ``spark.sql`` with
DataFrame parameters, and the checks prepend the same texts as common table expressions.  Only the
*inputs* are shared this way; each operator is written twice.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from worklode.plans.rule_feed import RULE_FEED

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# The day after the last order: every age, lookback and freshness test is measured from here.
AS_OF = "2001-08-02"
EVENTS_AS_OF = "2024-01-31"
# Orders before this day make up the state the previous load left behind.
PREVIOUS_LOAD = "2001-01-01"
LOOKBACK_DAYS = 3650

DATE_KEY = "cast(year({0}) * 10000 + month({0}) * 100 + day({0}) as int)"


def date_key(col: str) -> str:
    return DATE_KEY.format(col)


FEED: dict[str, str] = {
    # dimensions -------------------------------------------------------------------------------
    "sectors": """
        select case c_mktsegment when 'AUTOMOBILE' then 1 when 'BUILDING' then 2 when 'FURNITURE' then 3
               when 'HOUSEHOLD' then 4 else 5 end as sector_sk,
               c_mktsegment as sector_name,
               case when c_mktsegment in ('AUTOMOBILE', 'MACHINERY') then 'INDUSTRY' else 'HOME' end as sector_family,
               c_mktsegment <> 'FURNITURE' as active_flag
        from {customer} group by c_mktsegment""",
    "roles": """
        select cast(substr(o_orderpriority, 1, 1) as int) as role_sk, o_orderpriority as role_name
        from {orders} group by o_orderpriority""",
    "companies": """
        select c_custkey as company_sk, c_name as company_name, c_nationkey as location_sk,
               c_mktsegment as sector_name, c_acctbal as balance
        from {customer}""",
    "locations": """
        select n_nationkey as location_sk, n_name as location_name, r_name as country
        from {nation} join {region} on n_regionkey = r_regionkey""",
    "skills": """
        select cast(substr(p_brand, 7) as int) as skill_sk, p_brand as skill_name, min(p_type) as skill_category
        from {part} group by p_brand""",
    # facts ------------------------------------------------------------------------------------
    "postings": f"""
        select o_orderkey as job_sk, o_custkey as company_sk, c_nationkey as location_sk,
               case c_mktsegment when 'AUTOMOBILE' then 1 when 'BUILDING' then 2 when 'FURNITURE' then 3
                    when 'HOUSEHOLD' then 4 else 5 end as sector_sk,
               cast(substr(o_orderpriority, 1, 1) as int) as role_sk,
               {date_key("o_orderdate")} as posting_date_sk,
               o_orderdate as posted_at,
               o_orderstatus = 'O' as active_flag,
               o_orderstatus = 'P' as is_new_job,
               o_orderstatus = 'F' as is_soft_delete,
               case substr(o_orderpriority, 1, 1) when '1' then 'REMOTE' when '2' then 'HYBRID'
                    when '5' then 'UNKNOWN' else 'ONSITE' end as remote_type,
               o_totalprice as price
        from {{orders}} join {{customer}} on o_custkey = c_custkey""",
    "job_skills": """
        select l_orderkey as job_sk, cast(substr(p_brand, 7) as int) as skill_sk,
               cast(1 as decimal(4,2)) - cast(l_discount as decimal(4,2)) as confidence,
               case l_returnflag when 'R' then 'REQUIRED' when 'A' then 'PREFERRED' else 'MENTIONED' end
                   as evidence_type,
               l_linestatus = 'O' as is_current, l_linenumber as line_no
        from {lineitem} join {part} on l_partkey = p_partkey""",
    "salaries": """
        select l_orderkey as job_sk, l_linenumber as observation_no, posting_date_sk as observation_date_sk,
               sector_sk, role_sk, location_sk,
               l_extendedprice as salary_min, l_extendedprice + l_quantity as salary_max,
               case l_returnflag when 'R' then 'EUR' when 'A' then 'GBP' else 'USD' end as currency,
               case when l_quantity < 10 then 'HOURLY' else 'ANNUAL' end as salary_period,
               l_discount as confidence,
               case l_linestatus when 'O' then 'POSTED' else 'INFERRED' end as observation_type
        from {lineitem} join {postings} on l_orderkey = job_sk""",
    # change data ------------------------------------------------------------------------------
    "current_jobs": f"""
        select o_orderkey as job_id, o_orderpriority as source_name, o_custkey as company_id,
               case when o_orderstatus = 'P' then 'O' else o_orderstatus end as status,
               o_totalprice as price, o_orderdate as last_seen, o_orderpriority <> '5-LOW' as is_active,
               md5(concat(cast(o_custkey as string), '|',
                   case when o_orderstatus = 'P' then 'O' else o_orderstatus end)) as record_hash
        from {{orders}} where o_orderdate < timestamp '{PREVIOUS_LOAD} 00:00:00'""",
    "staged_jobs": f"""
        select o_orderkey as job_id, o_orderpriority as source_name, o_custkey as company_id,
               o_orderstatus as status, o_totalprice as price, o_orderdate as last_seen, true as is_active,
               md5(concat(cast(o_custkey as string), '|', o_orderstatus)) as record_hash
        from {{orders}}
        where o_orderstatus <> 'F' or o_orderdate >= timestamp '{PREVIOUS_LOAD} 00:00:00'""",
    "changes": """
        select event_id as change_id, user_id as job_id, ts as changed_at, value,
               case event_type when 'signup' then 'INSERT' when 'error' then 'DELETE' when 'purchase' then 'RESTORE'
                    else 'UPDATE' end as change_type,
               case event_type when 'click' then 'false' else 'true' end as old_is_active,
               case event_type when 'view' then 'false' else 'true' end as new_is_active,
               case event_type when 'purchase' then 'true' else 'false' end as old_soft_delete,
               case event_type when 'error' then 'true' else 'false' end as new_soft_delete,
               props
        from {events}""",
    "job_versions": """
        select event_id as version_sk, user_id as job_id, ts as effective_from,
               lead(ts) over (partition by user_id order by ts, event_id) as effective_to, value
        from {events} where event_type = 'signup'""",
    "runs": f"""
        select event_id as run_id, event_type as run_name, {date_key("ts")} as run_date_sk, ts as started_at,
               case when value < 5 then 'FAILURE' when value < 8 then 'FAILED' when value < 12 then 'TIMEOUT'
                    else 'SUCCESS' end as status,
               cast(user_id as int) + 10 as rows_read, cast(user_id as int) as rows_written,
               1 + cast(floor(value) as int) as runtime_seconds,
               case when user_id = 7 then 'staging' else 'production' end as environment
        from {{events}}""",
    "rule_results": """
        select event_id as result_id, concat('RULE_', event_type) as rule_name, ts as evaluated_at,
               case when value > 100 then 'ERROR' when value > 50 then 'WARNING' else 'INFO' end as severity,
               case when value > 80 then 'FAIL' when value > 40 then 'WARN' else 'PASS' end as status,
               cast(floor(value) as int) as failed_records, cast(user_id as int) + 1 as total_records
        from {events}""",
    "access_events": """
        select event_id, ts as accessed_at, concat('user', cast(user_id as string)) as user_name,
               event_type as action, concat('table', cast(user_id as string)) as resource,
               case when value > 60 then 'DENIED' else 'GRANTED' end as access_result
        from {events}""",
    "quarantine": """
        select event_id as quarantine_id, user_id as job_id, event_type as source_name,
               case event_type when 'error' then 'bronze' when 'click' then 'silver' else 'warehouse' end as stage,
               concat('RULE_', event_type) as rule_name,
               case when value > 30 then 'ERROR' else 'WARNING' end as severity, props as payload_json,
               ts as quarantined_at, value,
               case event_type when 'signup' then 'REPROCESSED' when 'click' then 'DISCARDED'
                    when 'view' then 'RESOLVED' when 'purchase' then 'REPROCESS_FAILED' else 'PENDING' end as status
        from {events}""",
    "text_jobs": """
        select doc_id as job_id, source as source_name, lang, text as description,
               split_part(text, ' ', 1) as title, n_chars
        from {documents}""",
    "raw_names": """
        select s_suppkey as name_id, concat(n_name, ' ', replace(s_name, 'Supplier#', 'Holding '), ', Inc.') as raw_name
        from {supplier} join {nation} on s_nationkey = n_nationkey
        union all
        select 1000000000 + p_partkey as name_id,
               case when p_size < 10 then concat(p_name, ' ', p_brand, ' LLC')
                    when p_size < 20 then concat(upper(p_name), '-', p_brand)
                    when p_size < 30 then concat(substr(p_name, 2), ' ', p_brand)
                    when p_size < 40 then concat(p_name, 's ', p_brand, ' Corp.')
                    else concat(replace(p_name, 'e', 'a'), 'x', p_brand) end as raw_name
        from {part}""",
    "canonical_names": """
        select min(p_partkey) as canonical_id, concat(p_name, ' ', p_brand) as canonical_name
        from {part} group by concat(p_name, ' ', p_brand)""",
}

FEED.update(RULE_FEED)

_REF = re.compile(r"\{(\w+)\}")


def _needs(sql: str) -> list[str]:
    """Table names in ``{braces}``, in order, without repeats."""
    return [n for n in dict.fromkeys(_REF.findall(sql)) if n in FEED or n in BASE_TABLES]


def _plain(sql: str) -> str:
    """SQL with ``{table}`` replaced by ``table``; other braces (in patterns) stay."""
    return _REF.sub(lambda m: m.group(1) if m.group(1) in FEED or m.group(1) in BASE_TABLES else m.group(0), sql)


def _feed_closure(sql: str) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in BASE_TABLES or name in ordered:
            return
        for parent in _needs(FEED[name]):
            visit(parent)
        ordered.append(name)

    for name in _needs(sql):
        visit(name)
    return ordered


def with_feed(sql: str) -> str:
    """SQL text for the checks: feed tables named in ``{braces}`` become common table expressions."""
    ctes = ",\n".join(f"{n} as ({_plain(FEED[n])})" for n in _feed_closure(sql))
    body = _plain(sql).strip()
    if not ctes:
        return body
    if body.lower().startswith("with recursive"):
        return f"with recursive {ctes},\n{body[len('with recursive') :]}"
    if body.lower().startswith("with"):
        return f"with {ctes},\n{body[4:]}"
    return f"with {ctes}\n{body}"


class Tables:
    """Lazy access to base and feed tables: ``t.orders``, ``t.postings``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._cache:
            if name in BASE_TABLES:
                self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
            elif name in FEED:
                self._cache[name] = self.sql(FEED[name])
            else:
                raise AttributeError(name)
        return self._cache[name]

    def sql(self, text: str) -> DataFrame:
        """Run SQL whose ``{braces}`` name base or feed tables."""
        return self.spark.sql(text, **{n: getattr(self, n) for n in _needs(text)})
