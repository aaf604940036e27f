"""Data quality, quarantine and audit queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklode.functions import fixed_values as fixed
from worklode.operators import audit, quality, quarantine
from worklode.operators.quality import Rule
from worklode.plans.feed import AS_OF, EVENTS_AS_OF
from worklode.plans.rule_catalog import ACTIONS, catalog
from worklode.queries.registry import query

TS = "%Y-%m-%d %H:%M:%S"

COLUMN_CHECKS_SQL = {
    "not_null_price": "o_totalprice is null",
    "price_range": "o_totalprice < 2000 or o_totalprice > 400000",
    "status_enum": "o_orderstatus not in ('O', 'F')",
    "priority_format": "not regexp_matches(o_orderpriority, '^[1-4]-[A-Z ]+$')",
}


@query("column_validators", "DQ-01 PF-05 PF-06 PF-09", " union all ".join(
    f"select '{n}' as check_name, count(*) as total, count(case when {c} then 1 end) as failed, "
    f"cast(count(*) - count(case when {c} then 1 end) as double) / count(*) as pass_rate from {{orders}}"
    for n, c in COLUMN_CHECKS_SQL.items()) + """
    union all select 'unique_o_custkey', cast(sum(n) as bigint), cast(sum(case when n > 1 then n else 0 end) as bigint),
    cast(sum(n) - sum(case when n > 1 then n else 0 end) as double) / cast(sum(n) as double)
    from (select o_custkey, count(*) as n from {orders} group by 1)""")
def _(t):
    checks = {
        "not_null_price": F.col("o_totalprice").isNull(),
        "price_range": quality.out_of_range("o_totalprice", 2000, 400000),
        "status_enum": ~F.col("o_orderstatus").isin("O", "F"),
        "priority_format": ~F.col("o_orderpriority").rlike("^[1-4]-[A-Z ]+$"),
    }
    return quality.validate_columns(t.orders, checks, key="o_custkey")


ROW_CHECKS_SQL = """
    select *, case when title_raw is null then 'FAIL' else 'PASS' end as dq_title,
           case when not regexp_matches(source_job_id, '^[0-9]+$') then 'FAIL' else 'PASS' end as dq_format,
           case when posted_at > last_seen then 'FAIL' else 'PASS' end as dq_order,
           case when coalesce(remote_type not in ('REMOTE', 'HYBRID', 'ONSITE', 'UNKNOWN'), false) then 'WARN' else 'PASS' end as dq_remote
    from {rf_jobs}"""
ROW_STATUS_SQL = """case when 'FAIL' in (dq_title, dq_format, dq_order) then 'FAIL' when dq_remote = 'WARN' then 'WARN' else 'PASS' end"""
FAILED_SQL = """concat_ws(',', case when dq_title <> 'PASS' then 'title' end, case when dq_format <> 'PASS' then 'format' end,
    case when dq_order <> 'PASS' then 'order' end, case when dq_remote <> 'PASS' then 'remote' end)"""


def flagged(t):
    return quality.flag_rows(t.rf_jobs, {
        "title": ("FAIL", F.col("title_raw").isNull()),
        "format": ("FAIL", ~F.col("source_job_id").rlike("^[0-9]+$")),
        "order": ("FAIL", F.col("posted_at") > F.col("last_seen")),
        "remote": ("WARN", ~F.col("remote_type").isin(fixed.REMOTE_TYPES)),
    })


@query("row_flags", "DQ-02", f"""
    select enterprise_job_id, dq_title, dq_format, dq_order, dq_remote, {FAILED_SQL} as failed_rules,
           {ROW_STATUS_SQL} as dq_overall_status from ({ROW_CHECKS_SQL})""")
def _(t):
    return flagged(t).select("enterprise_job_id", "dq_title", "dq_format", "dq_order", "dq_remote",
                             F.array_join("failed_rules", ",").alias("failed_rules"), "dq_overall_status")


@query("failed_rows_to_quarantine", "DQ-03 Q-01", f"""
    select enterprise_job_id, {FAILED_SQL} as rule_name, 'silver' as stage, 'PENDING' as status,
           enterprise_job_id as payload_id, source_name as payload_source,
           md5(concat(enterprise_job_id, '|silver|', {FAILED_SQL})) as quarantine_key
    from ({ROW_CHECKS_SQL}) where {ROW_STATUS_SQL} = 'FAIL'""")
def _(t):
    bad = flagged(t).select("enterprise_job_id", "source_name", "failed_rules", "dq_overall_status")
    reason = F.when(F.col("dq_overall_status") == "FAIL", F.array_join("failed_rules", ","))
    tagged = bad.withColumn("reason", reason).select("enterprise_job_id", "source_name", "reason")
    routed = quarantine.route(tagged, "enterprise_job_id", F.col("reason"), "silver", "ERROR", AS_OF)
    payload = F.from_json("payload_json", "enterprise_job_id bigint, source_name string")
    return routed.select(
        "enterprise_job_id", "rule_name", "stage", "status", payload["enterprise_job_id"].alias("payload_id"),
        payload["source_name"].alias("payload_source"), "quarantine_key",
    )


@query("batch_quality", "DQ-04 AU-02", f"""
    select source_name, count(*) as total_rows, count(case when s = 'PASS' then 1 end) as pass_rows,
           count(case when s = 'WARN' then 1 end) as warn_rows, count(case when s = 'FAIL' then 1 end) as fail_rows,
           cast(count(case when s = 'PASS' then 1 end) as double) / count(*) as pass_rate
    from (select source_name, {ROW_STATUS_SQL} as s from ({ROW_CHECKS_SQL})) group by 1""")
def _(t):
    return quality.batch_metrics(flagged(t), "source_name")


# The rule catalog -------------------------------------------------------------------------------

RULES = catalog(AS_OF)
FRAME_SQL = {
    "SECT_004": """select count(*) from {rf_sector_map} m where canonical_sector_code is not null and not exists (
        select 1 from {rf_dim_sector} d where d.sector_name = m.canonical_sector_name
        or list_contains(string_split(d.aliases, '|'), m.canonical_sector_name))""",
    "SECT_008": """select count(*) from {rf_dim_sector} where sector_family not in (
        select sector_family from {rf_dim_sector} where active_flag and sector_family is not null
        group by sector_family having count(*) > 1)""",
    "SECT_009": """select count(*) from {rf_sector_companies} g where sector_name = 'Hospitality' and not exists (
        select 1 from {rf_dim_company} c join {rf_postings} f on c.company_sk = f.company_sk
        join {rf_dim_sector} s on s.sector_sk = c.sector_sk
        where c.company_name = g.company_name and s.sector_family = 'HOME')""",
    "SAL_009": """select count(*) from (select d.sector_sk from {rf_dim_sector} d left join {rf_salary} s
        on s.sector_sk = d.sector_sk where d.active_flag group by 1 having count(s.fact_salary_sk) < 10)""",
    "SAL_011": """select count(*) from {rf_postings} p where is_active and not exists (
        select 1 from {rf_salary} s where s.job_sk = p.job_sk)""",
    "LOC_011": """select count(*) from (select lower(trim(location_name)) from {rf_dim_location}
        where latitude is not null and longitude is not null and location_name is not null group by 1
        having count(distinct concat(cast(latitude as varchar), ',', cast(longitude as varchar))) > 1)""",
}


def rule_sql(r: Rule) -> str:
    """Failed records of one rule as a query of its own (one scan per rule, unlike the runner)."""
    tb, s = f"{{{r.table}}}", r.spec
    if r.kind == "where":
        bad = s["bad"].replace("interval 48 hours", "interval 48 hour").replace("interval 168 hours", "interval 168 hour")
        return f"select count(*) from {tb} where {bad}"
    if r.kind == "unique":
        keys = ", ".join(s["keys"])
        present = " and ".join(f"{k} is not null" for k in s["keys"])
        return f"select count(*) from (select {keys} from {tb} where {present} group by {keys} having count(*) > 1)"
    if r.kind == "orphan" and "any" in s:
        lost = " or ".join(
            f"(c.{ck} is not null and not exists (select 1 from {{{p}}} p where p.{pk} = c.{ck}))" for p, ck, pk in s["any"]
        )
        return f"select count(*) from {tb} c where {lost}"
    if r.kind == "orphan":
        on = " and ".join(f"p.{pk} = c.{ck}" for ck, pk in s["on"].items())
        present = " and ".join(f"c.{ck} is not null" for ck in s["on"])
        extra = f" and ({s['where']})" if "where" in s else ""
        return f"select count(*) from {tb} c where {present}{extra} and not exists (select 1 from {{{s['parent']}}} p where {on})"
    if r.kind == "used":
        return f"select count(*) from {tb} d where {s['bad']} and exists (select 1 from {{{s['child']}}} c where c.{s['child_key']} = d.{s['key']})"
    if r.kind == "fresh":
        group = f" group by {s['per']}" if "per" in s else ""
        return (f"select count(*) from (select max({s['at']}) as m from {tb}{group}) "
                f"where m is null or m < timestamp '{AS_OF} 00:00:00' - interval {s['hours']} hour")  # fmt: skip
    return FRAME_SQL[r.name]


def rules_sql(rules: list[Rule]) -> str:
    return " union all ".join(
        f"select '{r.name}' as rule_name, '{r.category}' as rule_category, '{r.severity}' as severity, "
        f"'{r.table}' as target_table, ({rule_sql(r)}) as failed_records" for r in rules
    )


def tables_of(t, rules: list[Rule]):
    class Lookup(dict):
        def __missing__(self, name):
            return getattr(t, name)

        def get(self, name, default=None):
            return self[name]

    return Lookup()


GROUPS = {
    "rules_completeness": ("Completeness", "DQ-05 A-08"), "rules_uniqueness": ("Uniqueness", "DQ-05 A-14"),
    "rules_freshness": ("Freshness", "DQ-05 DQ-10"), "rules_referential": ("Referential Integrity", "DQ-05 J-13 J-16"),
    "rules_business": ("Business Logic", "DQ-05 J-14 PF-06"), "rules_sector": ("Sector Classification", "DQ-05 J-21 J-15"),
    "rules_salary": ("Salary Validation", "DQ-05 A-06 J-19"), "rules_location": ("Location Normalization", "DQ-05 A-03 PF-04"),
}


def _register_group(name: str, category: str, covers: str) -> None:
    rules = [r for r in RULES if r.category == category]

    @query(name, covers, rules_sql(rules))
    def _(t):
        return quality.run_rules(tables_of(t, rules), rules, AS_OF)


for _name, (_category, _covers) in GROUPS.items():
    _register_group(_name, _category, _covers)

SALARY_RULES = [r for r in RULES if r.category == "Salary Validation"]


@query("rule_actions", "DQ-06", f"""
    with r as ({rules_sql(SALARY_RULES)}),
    a(severity, action) as (values {", ".join(f"('{s}', '{n}')" for s, names in ACTIONS.items() for n in names)})
    select rule_name, r.severity, failed_records, action from r join a on a.severity = r.severity where failed_records > 0""")
def _(t):
    return quality.route_actions(quality.run_rules(tables_of(t, SALARY_RULES), SALARY_RULES, AS_OF), ACTIONS)


@query("failing_rows_of_a_rule", "DQ-05 A-08", """
    select fact_salary_sk, salary_min, salary_max from {rf_salary} where salary_min > salary_max""")
def _(t):
    rule = next(r for r in RULES if r.name == "SAL_001")
    return quality.failing_rows(tables_of(t, [rule]), rule).select("fact_salary_sk", "salary_min", "salary_max")


@query("import_validation", "DQ-08 A-15 J-16", """
    select 'rows_orders' as check_name, count(*) as issue_count from {orders}
    union all select 'rows_lineitem', count(*) from {lineitem}
    union all select 'orphan_orders', (select count(*) from {orders} where o_custkey not in (select c_custkey from {customer} where c_acctbal > 0))
    union all select 'future_dates', count(case when l_shipdate > timestamp '2001-06-01 00:00:00' then 1 end) from {lineitem}
    union all select 'negative_balance', count(case when c_acctbal < 0 then 1 end) from {customer}
    union all select 'duplicate_lines', (select count(*) from (select 1 from {lineitem} group by l_orderkey, l_linenumber having count(*) > 1))""")
def _(t):
    from worklode.operators.aggregates import count_where, duplicate_keys
    from worklode.operators.joins import orphans

    def one(name, df, measure=None):
        n = count_where(measure) if measure is not None else F.count(F.lit(1))
        return df.agg(n.alias("issue_count")).select(F.lit(name).alias("check_name"), "issue_count")

    parts = [
        one("rows_orders", t.orders), one("rows_lineitem", t.lineitem),
        one("orphan_orders", orphans(t.orders, t.customer.filter("c_acctbal > 0"), {"o_custkey": "c_custkey"})),
        one("future_dates", t.lineitem, F.col("l_shipdate") > F.lit("2001-06-01").cast("timestamp")),
        one("negative_balance", t.customer, F.col("c_acctbal") < 0),
        one("duplicate_lines", duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("publish_gate", "DQ-09", """
    with p as (select l_shipdate < timestamp '2000-01-01 00:00:00' as old, l_returnflag as k from {lineitem}),
    a as (select k as table_name, count(*) as previous_rows from p where old and k <> 'R' group by 1),
    b as (select k as table_name, count(*) as current_rows from p where not old or k = 'A' group by 1),
    j as (select coalesce(a.table_name, b.table_name) as table_name, previous_rows, coalesce(current_rows, 0) as current_rows
          from a full join b on a.table_name = b.table_name)
    select *, abs(current_rows - previous_rows) / cast(previous_rows as double) as variance,
           case when previous_rows is null then 'NEW'
                when abs(current_rows - previous_rows) / cast(previous_rows as double) > case table_name when 'A' then 0.9 else 0.1 end
                then 'BLOCK' else 'PASS' end as verdict from j""")
def _(t):
    rows = t.lineitem.withColumn("old", F.col("l_shipdate") < F.lit("2000-01-01").cast("timestamp"))

    def counts(df, name):
        return df.groupBy(F.col("l_returnflag").alias("table_name")).agg(F.count(F.lit(1)).alias(name))

    previous = counts(rows.filter("old and l_returnflag <> 'R'"), "n")
    current = counts(rows.filter("not old or l_returnflag = 'A'"), "n")
    return quality.publish_gate(previous, current, "table_name", "n", {"A": 0.9}, 0.1)


SLA_SQL = """
    select metric, value, case metric when 'success_rate' then value >= 0.95 when 'pass_rate' then value >= 0.5
           else value <= 3000 end as meets_sla
    from (select 'success_rate' as metric, cast(count(case when status = 'SUCCESS' then 1 end) as double) / count(*) as value from {runs}
    union all select 'pass_rate', cast(count(case when status = 'PASS' then 1 end) as double) / count(*) from {rule_results}
    union all select 'denied', cast(count(case when access_result = 'DENIED' then 1 end) as double) from {access_events})"""


@query("sla_verdicts", "DQ-10 AU-08", SLA_SQL)
def _(t):
    from worklode.operators.aggregates import count_where, guarded_ratio

    n = F.count(F.lit(1))
    parts = [
        t.runs.agg(guarded_ratio(count_where(F.col("status") == "SUCCESS"), n).alias("value")).withColumn("metric", F.lit("success_rate")),
        t.rule_results.agg(guarded_ratio(count_where(F.col("status") == "PASS"), n).alias("value")).withColumn("metric", F.lit("pass_rate")),
        t.access_events.agg(count_where(F.col("access_result") == "DENIED").cast("double").alias("value")).withColumn("metric", F.lit("denied")),
    ]
    metrics = parts[0].unionByName(parts[1]).unionByName(parts[2])
    limits = {"success_rate": ("min", 0.95), "pass_rate": ("min", 0.5), "denied": ("max", 3000)}
    return quality.sla_verdicts(metrics, limits)


# Quarantine -------------------------------------------------------------------------------------


@query("quarantine_browse", "Q-02 S-03", f"""
    select quarantine_id, q.job_id, strftime(quarantined_at, '{TS}') as quarantined_at, c_name from (
        select * from {{quarantine}} where severity = 'ERROR' and status = 'PENDING' and rule_name like 'RULE_e%'
        order by quarantined_at desc, quarantine_id limit 50) q left join {{customer}} on c_custkey = q.job_id""")
def _(t):
    current = t.customer.select(F.col("c_custkey").alias("job_id"), "c_name")
    found = quarantine.browse(
        t.quarantine, current, "job_id", {"severity": "ERROR", "status": "PENDING", "stage": None}, ("rule_name", "RULE_e%"), 50
    )
    return found.select("quarantine_id", "job_id", F.date_format("quarantined_at", "yyyy-MM-dd HH:mm:ss").alias("quarantined_at"), "c_name")


@query("quarantine_reinstate", "Q-03 M-06 M-02", """
    select status, count(*) as records, count(case when status = 'RESOLVED' and value > 60 then 1 end) as listed
    from (select value, case when value > 60 then 'RESOLVED' else status end as status from {quarantine}) group by 1""")
def _(t):
    ids = t.quarantine.filter("value > 60").select("quarantine_id")
    current = t.customer.select(F.col("c_custkey").alias("job_id"), F.lit(False).alias("is_active"))
    state, _restored, _log = quarantine.reinstate(t.quarantine, current, ids, "job_id")
    listed = F.count(F.when((F.col("status") == "RESOLVED") & (F.col("value") > 60), 1)).alias("listed")
    return state.groupBy("status").agg(F.count(F.lit(1)).alias("records"), listed)


@query("quarantine_reinstated_jobs", "Q-03", """
    select c_custkey as job_id, exists (select 1 from {quarantine} where value > 60 and status <> 'RESOLVED' and job_id = c_custkey)
        as is_active from {customer}""")
def _(t):
    ids = t.quarantine.filter("value > 60").select("quarantine_id")
    current = t.customer.select(F.col("c_custkey").alias("job_id"), F.lit(False).alias("is_active"))
    return quarantine.reinstate(t.quarantine, current, ids, "job_id")[1]


@query("quarantine_discard", "Q-04 M-06", f"""
    select quarantine_id, case when status = 'PENDING' and severity = 'ERROR' and source_name = 'error'
        and date_diff('day', cast(quarantined_at as date), date '{EVENTS_AS_OF}') > 10 then 'DISCARDED' else status end as status
    from {{quarantine}}""")
def _(t):
    state = quarantine.discard(t.quarantine, EVENTS_AS_OF, source="error", severity="ERROR", older_than=10)
    return state.select("quarantine_id", "status")


@query("quarantine_summaries", "Q-05 A-11", " union all ".join(
    f"select '{view}' as \"view\", {st} as stage, {ru} as rule_name, {se} as severity, {so} as source_name, count(*) as records, "
    f"count(case when status = 'PENDING' then 1 end) as pending, count(distinct job_id) as jobs from {{quarantine}} {gr}"
    for view, st, ru, se, so, gr in [
        ("overall", "null", "null", "null", "null", ""), ("stage", "stage", "null", "null", "null", "group by stage"),
        ("rule", "null", "rule_name", "severity", "null", "group by rule_name, severity"),
        ("source", "null", "null", "null", "source_name", "group by source_name")]))
def _(t):
    return quarantine.summaries(t.quarantine)


@query("quarantine_reprocess", "Q-06 IO-05", """
    select quarantine_id, job_id, stage, cast(json_extract(payload_json, '$.k') as int) as k from {quarantine}
    where status = 'RESOLVED' and cast(json_extract(payload_json, '$.k') as int) > 20""")
def _(t):
    return quarantine.reprocess(t.quarantine, "k int", F.col("k") > 20)[0]


@query("quarantine_after_reprocess", "Q-06 Q-09", """
    select 'reprocess' as operation, count(*) as records_processed,
           count(case when status = 'RESOLVED' and cast(json_extract(payload_json, '$.k') as int) > 20 then 1 end) as records_succeeded,
           count(case when status = 'RESOLVED' and cast(json_extract(payload_json, '$.k') as int) <= 20 then 1 end) as records_failed
    from {quarantine}""")
def _(t):
    state = quarantine.reprocess(t.quarantine, "k int", F.col("k") > 20)[1]
    return quarantine.operation_entry(t.quarantine, state, "reprocess", "REPROCESSED")


POLICY = {"REPROCESSED": {"archive": 10, "delete": 20}, "DISCARDED": {"archive": 3, "delete": 12},
          "PENDING": {"alert": 5, "archive": 15, "delete": 25}, "REPROCESS_FAILED": {"archive": 8, "delete": 16}}


def policy_case(policy) -> str:
    arms = []
    for status, limits in policy.items():
        for step in ("delete", "archive", "alert"):
            if step in limits:
                arms.append(f"when status = '{status}' and d > {limits[step]} then '{step.upper()}'")
    return f"case {' '.join(arms)} else 'KEEP' end"


AGED = f"""(select *, date_diff('day', cast(quarantined_at as date), date '{EVENTS_AS_OF}') as d from {{quarantine}})"""


@query("retention_plan", "Q-07", f"""
    select quarantine_id, status, cast(d as int) as age_days, {policy_case(POLICY)} as retention_action from {AGED}""")
def _(t):
    plan = quarantine.retention_plan(t.quarantine, EVENTS_AS_OF, POLICY)
    return plan.select("quarantine_id", "status", "age_days", "retention_action")


@query("retention_applied", "Q-07 M-07", f"""
    with p as (select *, {policy_case(POLICY)} as act from {AGED}),
    held as (select quarantine_id from {{quarantine}} where value > 20)
    select quarantine_id from p where not (act = 'DELETE' and quarantine_id in (select quarantine_id from held))""")
def _(t):
    archive = t.quarantine.filter("value > 20")
    return quarantine.apply_retention(t.quarantine, archive, EVENTS_AS_OF, POLICY)[0].select("quarantine_id")


@query("retention_default_policy", "Q-07", f"""
    select {policy_case(fixed.RETENTION_DAYS)} as retention_action, status, count(*) as records from {AGED} group by 1, 2""")
def _(t):
    plan = quarantine.retention_plan(t.quarantine, EVENTS_AS_OF)
    return plan.groupBy("retention_action", "status").agg(F.count(F.lit(1)).alias("records"))


@query("stale_pending", "Q-08", f"""
    select source_name, rule_name, count(*) as waiting, strftime(min(quarantined_at), '{TS}') as oldest from {AGED}
    where status = 'PENDING' and d > 7 group by 1, 2""")
def _(t):
    found = quarantine.stale_pending(t.quarantine, EVENTS_AS_OF, 7)
    return found.withColumn("oldest", F.date_format("oldest", "yyyy-MM-dd HH:mm:ss"))


# Audit ------------------------------------------------------------------------------------------


@query("watermarks", "AU-01 M-02", f"""
    with m as (select event_type as source_name, max(ts) as h from {{events}} where value < 100 and event_type <> 'view' group by 1),
    n as (select run_name as source_name, max(started_at) as h from {{runs}} where status = 'SUCCESS' and rows_read > 50 group by 1)
    select source_name, strftime(greatest(m.h, n.h), '{TS}') as high_water_mark
    from m full join n using (source_name)""")
def _(t):
    marks = t.events.filter("value < 100 and event_type <> 'view'").groupBy(F.col("event_type").alias("source_name")).agg(
        F.max("ts").alias("high_water_mark")
    )
    batches = t.runs.filter("rows_read > 50").withColumnRenamed("run_name", "source_name")
    after = audit.advance_watermarks(marks, batches, "source_name", "started_at")
    return after.withColumn("high_water_mark", F.date_format("high_water_mark", "yyyy-MM-dd HH:mm:ss"))


@query("batch_ledger", "AU-02", """
    select source_name, batch_id, count(*) as records_in, count(payload_json) as records_out,
           count(*) - count(payload_json) as records_failed,
           case when count(payload_json) = 0 then 'FAILED' else 'SUCCESS' end as status, 'run1' as run_id
    from {rf_snapshots} group by 1, 2""")
def _(t):
    return audit.batch_ledger(t.rf_snapshots, ["source_name", "batch_id"], F.col("payload_json").isNull(), "run1")


@query("refused_audit_rows", "AU-03 PF-06", """
    select enterprise_job_id, status, severity from {rf_quarantine}
    where status not in ('PENDING', 'IN_PROGRESS', 'RESOLVED', 'DISCARDED', 'REPROCESSED', 'REPROCESS_FAILED')
       or severity not in ('ERROR', 'WARNING', 'INFO')""")
def _(t):
    enums = {"status": fixed.REPROCESS_STATUSES, "severity": fixed.SEVERITIES}
    return audit.checked_entries(t.rf_quarantine, enums)[1].select("enterprise_job_id", "status", "severity")


@query("daily_run_summary", "AU-04", f"""
    select strftime(cast(started_at as date), '%Y-%m-%d') as run_day, environment, count(*) as runs,
           count(case when status = 'SUCCESS' then 1 end) as succeeded,
           count(case when status in ('FAILURE', 'FAILED') then 1 end) as failed,
           cast(sum(runtime_seconds) as double) / count(*) as avg_seconds, cast(sum(rows_written) as bigint) as rows_written
    from {{runs}} where date_diff('day', cast(started_at as date), date '{EVENTS_AS_OF}') <= 40 group by 1, 2""")
def _(t):
    return audit.run_summary(t.runs, EVENTS_AS_OF, 40).withColumn("run_day", F.date_format("run_day", "yyyy-MM-dd"))


@query("rule_summary_by_severity", "AU-05 A-08 S-02", f"""
    with r as (select * from {{rule_results}} where date_diff('day', cast(evaluated_at as date), date '{EVENTS_AS_OF}') <= 40),
    n as (select severity, string_agg(rule_name, ', ' order by rule_name) as failing_rules from (
          select distinct severity, rule_name from r where status = 'FAIL') group by 1)
    select r.severity, count(*) as results, count(case when status = 'FAIL' then 1 end) as failures,
           cast(sum(failed_records) as bigint) as failed_records, any_value(failing_rules) as failing_rules,
           case when r.severity = 'ERROR' and count(case when status = 'FAIL' then 1 end) > 0 then 'CRITICAL'
                when count(case when status = 'FAIL' then 1 end) > 0 then 'ATTENTION' else 'OK' end as state
    from r left join n on n.severity = r.severity group by 1""")
def _(t):
    return audit.rule_summary(t.rule_results, EVENTS_AS_OF, 40)


@query("access_threats", "AU-06 W-10 A-06", """
    select user_name, count(*) as attempts, count(case when access_result = 'DENIED' then 1 end) as denied,
           count(distinct resource) as resources,
           case when count(case when access_result = 'DENIED' then 1 end) >= 10 then 'HIGH'
                when count(case when access_result = 'DENIED' then 1 end) >= 5 then 'MEDIUM'
                when count(case when access_result = 'DENIED' then 1 end) > 0 then 'LOW' else 'NONE' end as threat_level
    from {access_events} group by 1""")
def _(t):
    return audit.access_summary(t.access_events)


@query("runs_needing_attention", "AU-07 A-06 S-03", f"""
    select run_name, count(*) as runs, count(case when status in ('FAILURE', 'FAILED', 'TIMEOUT') then 1 end) as failures,
           strftime(max(started_at), '{TS}') as last_run
    from {{runs}} where date_diff('day', cast(started_at as date), date '{EVENTS_AS_OF}') <= 31
    group by 1 having count(case when status in ('FAILURE', 'FAILED', 'TIMEOUT') then 1 end) >= 3 order by 3 desc, 1 limit 10""")
def _(t):
    found = audit.needing_attention(t.runs, EVENTS_AS_OF, 31, 3, 10)
    return found.withColumn("last_run", F.date_format("last_run", "yyyy-MM-dd HH:mm:ss"))


@query("audit_report", "AU-09", f"""
    with r as (select * from {{runs}} where date_diff('day', cast(started_at as date), date '{EVENTS_AS_OF}') <= 31),
    q as (select * from {{rule_results}} where date_diff('day', cast(evaluated_at as date), date '{EVENTS_AS_OF}') <= 31),
    a as (select * from {{access_events}} where date_diff('day', cast(accessed_at as date), date '{EVENTS_AS_OF}') <= 31)
    select 'runs' as section, 'total' as metric, cast(count(*) as double) as value from r
    union all select 'runs', 'failed', count(case when status in ('FAILURE', 'FAILED') then 1 end) from r
    union all select 'runs', 'rows_written', sum(rows_written) from r
    union all select 'runs', 'success_rate', cast(count(case when status = 'SUCCESS' then 1 end) as double) / count(*) from r
    union all select 'rules', 'total', count(*) from q
    union all select 'rules', 'failed', count(case when status = 'FAIL' then 1 end) from q
    union all select 'rules', 'pass_rate', cast(count(case when status = 'PASS' then 1 end) as double) / count(*) from q
    union all select 'access', 'total', count(*) from a
    union all select 'access', 'denied', count(case when access_result = 'DENIED' then 1 end) from a
    union all select 'access', 'users', count(distinct user_name) from a""")
def _(t):
    return audit.audit_report(t.runs, t.rule_results, t.access_events, EVENTS_AS_OF, 31)


@query("layer_freshness", "AU-10", f"""
    select layer, row_count, strftime(newest, '{TS}') as newest,
           cast(floor((epoch(timestamp '{EVENTS_AS_OF} 00:00:00') - floor(epoch(newest))) / 3600) as bigint) as age_hours,
           cast(floor((epoch(timestamp '{EVENTS_AS_OF} 00:00:00') - floor(epoch(newest))) / 3600) as bigint) <= 24 as is_fresh
    from (select 'raw' as layer, count(*) as row_count, max(ts) as newest from {{events}}
          union all select 'rules', count(*), max(evaluated_at) from {{rule_results}}
          union all select 'jobs', count(*), max(o_orderdate) from {{orders}})""")
def _(t):
    layers = {"raw": (t.events, "ts"), "rules": (t.rule_results, "evaluated_at"), "jobs": (t.orders, "o_orderdate")}
    rows = audit.layer_freshness(layers, EVENTS_AS_OF, 24)
    return rows.withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss"))


@query("missing_days", "AU-11", """
    with s as (select distinct o_orderpriority as source_name, cast(o_orderdate as date) as day from {orders}),
    spine as (select source_name, cast(g as date) as day from (select distinct source_name from s),
              generate_series(timestamp '1995-01-01', timestamp '2001-08-01', interval 1 day) x(g))
    select source_name, strftime(day, '%Y-%m-%d') as day from spine
    where not exists (select 1 from s where s.source_name = spine.source_name and s.day = spine.day)""")
def _(t):
    records = t.orders.select(F.col("o_orderpriority").alias("source_name"), "o_orderdate")
    found = audit.missing_days(records, "source_name", "o_orderdate", "1995-01-01", "2001-08-01")
    return found.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
