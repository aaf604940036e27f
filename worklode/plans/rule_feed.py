"""Tables the rule catalog looks at, derived from the driver's tables.  Faults are already in the data
(low balances, small sizes, repeated line numbers) or follow from the mapping, so every kind of rule
has something to find."""

RULE_FEED: dict[str, str] = {
    "rf_snapshots": """
        select o_orderkey as snapshot_id, o_orderpriority as source_name, cast(o_orderkey as string) as source_job_id,
               case when o_totalprice < 2000 then null else concat('price=', cast(o_totalprice as string)) end as payload_json,
               o_orderdate as ingestion_timestamp, concat(o_orderpriority, cast(year(o_orderdate) as string)) as batch_id,
               md5(concat(cast(o_custkey as string), o_orderstatus)) as payload_hash
        from {orders}""",
    "rf_batches": """
        select concat(o_orderpriority, cast(year(o_orderdate) as string)) as batch_id,
               case when count(*) < 300 then null else o_orderpriority end as source_name, min(o_orderdate) as started_at
        from {orders} group by o_orderpriority, year(o_orderdate)""",
    "rf_jobs": """
        select o_orderkey as enterprise_job_id, o_orderpriority as source_name,
               case when o_totalprice > 490000 then 'gone' else cast(o_orderkey as string) end as source_job_id,
               case when o_totalprice < 5000 then null else o_orderpriority end as title_raw,
               case when o_totalprice < 5000 then null else upper(o_orderpriority) end as title_normalized,
               case when o_totalprice < 1500 then o_orderdate + interval 3000 day else o_orderdate end as posted_at,
               o_orderdate + interval 5 day as last_seen, o_orderdate as created_at,
               case when o_custkey < 20 then o_orderdate - interval 1 day else o_orderdate + interval 6 day end as updated_at,
               o_orderstatus <> 'F' as is_active, o_orderstatus = 'P' and o_orderpriority = '1-URGENT' as soft_delete_flag,
               case when c_acctbal < 0 then null else c_name end as company_name_norm,
               case when c_nationkey = 3 then 'Remote' when c_nationkey < 6 then 'NATION, X' else c_name end as location_raw,
               case when c_nationkey = 5 then null else c_name end as location_norm,
               case substr(o_orderpriority, 1, 1) when '1' then 'REMOTE' when '2' then 'HYBRID' when '3' then 'ON-SITE'
                    when '4' then null else 'ONSITE' end as remote_type,
               case o_orderstatus when 'F' then 'PASS' when 'O' then 'WARN' else 'BROKEN' end as dq_overall_status,
               case when c_mktsegment = 'FURNITURE' then null else c_mktsegment end as sector_assigned,
               c_acctbal / 10000 as sector_confidence,
               case when o_orderstatus = 'P' then null else 'RULE_BASED' end as sector_assignment_method
        from {orders} join {customer} on o_custkey = c_custkey""",
    "rf_skill_mapping": """
        select l_orderkey as enterprise_job_id, case when l_discount > 0.09 then null else l_returnflag end as skill_name_raw
        from {lineitem}""",
    "rf_sector_map": """
        select case when o_totalprice > 480000 then 1 else o_orderkey end as sector_map_id,
               case when c_acctbal > 9000 then -o_orderkey else o_orderkey end as enterprise_job_id,
               case when c_acctbal < -900 then null else c_mktsegment end as canonical_sector_code,
               case when c_mktsegment = 'MACHINERY' then 'MACHINES' else c_mktsegment end as canonical_sector_name,
               c_acctbal / 9000 as normalization_confidence,
               case o_orderstatus when 'P' then 'GUESS' else 'LOOKUP' end as normalization_method,
               case o_orderstatus when 'F' then 'ISIC' else 'NAICS' end as taxonomy_type, o_orderdate as created_at
        from {orders} join {customer} on o_custkey = c_custkey where c_mktsegment <> 'FURNITURE'""",
    "rf_company_canonical": """
        select case when c_acctbal > 9900 then 0 else c_custkey end as canonical_company_id,
               case when c_acctbal < -990 then null else c_name end as canonical_company_name from {customer}""",
    "rf_company_map": """
        select case when o_totalprice > 480000 then -1 - o_orderkey else o_orderkey end as enterprise_job_id from {orders}""",
    "rf_skill_catalog": """
        select case when p_size = 50 then 1 else p_partkey end as canonical_skill_id,
               case when p_size = 1 then null else p_name end as canonical_skill_name from {part}""",
    "rf_identity_map": "select case when quality = 0 then 1 else doc_id end as mapping_id from {labels}",
    "rf_dim_company": """
        select case when c_acctbal > 9950 then 0 else c_custkey end as company_sk,
               case when c_acctbal < -950 then null else c_name end as company_name,
               case c_mktsegment when 'AUTOMOBILE' then 1 when 'BUILDING' then 2 when 'HOUSEHOLD' then 4 else 5 end as sector_sk
        from {customer}""",
    "rf_dim_location": """
        select s_suppkey as location_sk, case when s_acctbal < 0 then null else n_name end as location_name,
               s_acctbal > 1000 as active_flag, concat('L', cast(s_nationkey as string)) as location_nk,
               case when s_nationkey < 10 then 'N' else 'NN' end as iso_country_code,
               case when s_nationkey > 20 then 'N-1' else 'NN-12' end as iso_region_code,
               case when s_acctbal > 5000 then s_acctbal / 80 end as latitude, s_acctbal / 40 as longitude,
               case when s_nationkey > 2 then n_name end as city, case when s_nationkey > 5 then n_name end as state,
               case when s_nationkey > 3 then 'X' end as country
        from {supplier} join {nation} on s_nationkey = n_nationkey""",
    "rf_dim_sector": """
        select sector_sk, sector_name, case when sector_sk = 5 then null else sector_family end as sector_family, active_flag,
               case when sector_sk = 5 then 'MACHINE|MACHINES' else lower(sector_name) end as aliases
        from {sectors}""",
    "rf_dim_skill": "select case when p_size = 49 then 1 else p_partkey end as skill_sk from {part} where p_size > 2",
    "rf_dim_job": "select o_orderkey as job_sk from {orders} where o_totalprice < 450000",
    "rf_postings": """
        select o_orderkey as job_sk, case when o_totalprice > 495000 then null else o_custkey end as company_sk,
               o_custkey as location_sk, case when o_orderpriority = '5-LOW' then 9 else cast(substr(o_orderpriority, 1, 1) as int) end
                   as sector_sk, 1 as source_sk, o_orderstatus <> 'F' as is_active, o_orderdate as load_timestamp
        from {orders}""",
    "rf_salary": """
        select l_orderkey * 10 + l_linenumber as fact_salary_sk, l_orderkey as job_sk, l_partkey as company_sk,
               l_suppkey as location_sk, cast(l_linenumber as int) as sector_sk, year(l_shipdate) as observation_date_sk,
               case when l_tax > 0.07 then 'SCRAPED' when l_linestatus = 'O' then 'POSTED' else 'INFERRED' end as salary_observation_type,
               case when l_discount > 0.09 then l_extendedprice + 1 else l_extendedprice - 1000 end as salary_min,
               l_extendedprice as salary_max, case when l_tax < 0.01 then 'XXX' else 'USD' end as salary_currency,
               case when l_quantity < 2 then 'YEARLY' when l_quantity < 10 then 'HOURLY' else 'ANNUAL' end as salary_period,
               l_discount * 11 as salary_confidence
        from {lineitem} where l_quantity > 0""",
    "rf_bridge": "select l_orderkey as job_sk, l_partkey as skill_sk from {lineitem}",
    "rf_hiring_mart": """
        select case when event_type = 'error' then null else event_type end as trend_period, count(*) as total_postings,
               max(ts) as calculated_at from {events} group by event_type, user_id""",
    "rf_salary_mart": """
        select l_returnflag as observation_period, case when l_returnflag = 'R' and l_suppkey < 5 then null
               else avg(l_quantity) end as median_salary, min(l_quantity) + 3 as min_salary, max(l_quantity) - 30 as max_salary
        from {lineitem} group by l_returnflag, l_suppkey""",
    "rf_location_mart": """
        select case when s_acctbal < 0 then null else s_name end as location_name,
               case when s_nationkey = 4 then null else 'X' end as country from {supplier}""",
    "rf_company_names": "select o_custkey as canonical_company_id, o_orderpriority as raw_company_name from {orders}",
    "rf_sector_companies": """
        select c_name as company_name, case when c_mktsegment = 'BUILDING' then 'Hospitality' else c_mktsegment end as sector_name,
               c_acctbal from {customer}""",
    "rf_quarantine": """
        select quarantine_id, case when value > 100 then -job_id - 1 else job_id end as enterprise_job_id,
               case when value > 50 then 'FATAL' else severity end as severity, case when value > 200 then 'LOST' else status end as status
        from {quarantine}""",
}
