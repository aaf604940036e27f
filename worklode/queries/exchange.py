"""Ingest, publish and reload."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from worklode.plans.feed import AS_OF, BASE_TABLES
from worklode.queries.registry import query
from worklode.session import shared_dir
from worklode.sources import catalogs, ingest, publish
from worklode.sources.tables import TableStore


def folder(t) -> str:
    """A new folder of this run below the shared folder."""
    return f"{shared_dir(t.spark)}/run-{uuid.uuid4().hex}"


PAYLOADS = """select event_id, event_type, user_id, ts, case when value < 1 then 'broken' else props end as props from {events}"""


@query("valid_records", "IO-01 IO-05", """
    select event_id, cast(json_extract(props, '$.k') as int) as k from {events} where value >= 1 and cast(json_extract(props, '$.k') as int) <= 90""")
def _(t):
    records = t.sql(PAYLOADS).withColumn("payload", F.from_json("props", "k int", {"mode": "PERMISSIVE"})).withColumn("k", F.col("payload.k"))
    valid, _rejected = ingest.split_valid(records, ["event_type", "k"], {"OUT_OF_RANGE": F.col("k") > 90})
    return valid.select("event_id", "k")


@query("rejected_records", "IO-01", """
    select event_id, case when value < 1 then 'MISSING_REQUIRED_FIELD' else 'OUT_OF_RANGE' end as reject_reason from {events}
    where value < 1 or cast(json_extract(props, '$.k') as int) > 90""")
def _(t):
    records = t.sql(PAYLOADS).withColumn("k", F.from_json("props", "k int")["k"])
    return ingest.split_valid(records, ["event_type", "k"], {"OUT_OF_RANGE": F.col("k") > 90})[1].select("event_id", "reject_reason")


@query("append_snapshots", "IO-02 IO-03 PF-01", """
    select concat(cast(user_id as varchar), ':', cast(event_id as varchar)) as snapshot_id, event_type as source_name, upper(event_type) as title,
           cast(user_id as varchar) as company, value > 10 as is_big from {events}""")
def _(t):
    store = TableStore(t.spark, folder(t))
    batch = ingest.snapshots(t.events, ["user_id", "event_id"], ["event_type", "user_id", "value"], "event_type", "b1", AS_OF)
    path = store.append("snapshots", batch, ["ingestion_date_sk"])
    parsed = ingest.payload_columns(t.spark.read.parquet(path), "event_type string, user_id long, value double")
    return ingest.standardize(parsed, {
        "title": F.upper("payload.event_type"), "company": F.coalesce(F.col("payload.user_id").cast("string"), F.lit("")),
        "is_big": F.col("payload.value") > 10,
    }).drop("batch_id")


@query("replayed_log", "IO-10", """
    select event_id, cast(json_extract(props, '$.k') as int) as k, true as is_replay from {events}
    where ts >= timestamp '2024-01-05 00:00:00' and ts < timestamp '2024-01-12 00:00:00'""")
def _(t):
    found = ingest.replay(t.events, "2024-01-05", "2024-01-12", "ts", "props", "event_id", "k int", "replay-1")
    return found.select("event_id", "k", "is_replay")


@query("replayed_files", "IO-10 IO-03", """
    select event_type, count(*) as n, cast(sum(user_id) as bigint) as users, count(*) as replayed from {events} group by 1""")
def _(t):
    path = f"{folder(t)}/landed"
    t.events.select("event_id", "event_type", "user_id").write.json(path)
    rows = ingest.replay_files(t.spark, path, "event_id long, event_type string, user_id long", "replay-2")
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("user_id").alias("users"), F.count(F.when(F.col("is_replay"), 1)).alias("replayed")
    )


@query("taxonomy_words", "IO-06 T-21", """
    with x as (select p_brand, p_type, p_name from {part})
    select sector_key, word, count(*) as uses from (
        select distinct p_brand as sector_key, p_type, lower(unnest(string_split(p_name, ' '))) as word from x) group by 1, 2""")
def _(t):
    path = f"{folder(t)}/sectors"
    rows = t.part.select(
        F.col("p_brand").alias("sector_key"), F.col("p_type").alias("sector_name"), F.lit(None).cast("string").alias("parent_sector"),
        F.lit("51").alias("naics_code"), F.concat(F.replace(F.col("p_name"), F.lit(" "), F.lit("| ")), F.lit("|")).alias("keywords"),
    )
    rows.write.option("header", "true").csv(path)
    words = catalogs.exploded_words(catalogs.read_taxonomy(t.spark, path, "sectors"), "keywords", "word")
    return words.select("sector_key", "sector_name", "word").distinct().groupBy("sector_key", "word").agg(F.count(F.lit(1)).alias("uses"))


@query("external_catalogs", "IO-07 U-03", """
    select priority, count(*) as entries, count(distinct skill_name) as skills from (
        select 0 as priority, p_name as skill_name from {part} union all select 1, p_brand from {part}
        union all select 2, c_mktsegment from {customer}) group by 1""")
def _(t):
    root = folder(t)
    t.part.select(F.col("p_name").alias("name"), F.col("p_type").alias("kind")).write.option("header", "true").csv(f"{root}/a")
    t.part.select(F.col("p_brand").alias("label"), F.col("p_type").alias("kind")).write.json(f"{root}/b")
    t.customer.select(F.col("c_mktsegment").alias("skill"), F.col("c_mktsegment").alias("kind")).write.parquet(f"{root}/c")
    found = catalogs.load_catalogs(t.spark, [
        {"path": f"{root}/a", "format": "csv", "schema": "name string, kind string", "name": "name", "category": "kind", "priority": 0},
        {"path": f"{root}/b", "format": "json", "schema": "label string, kind string", "name": "label", "category": "kind", "priority": 1},
        {"path": f"{root}/c", "format": "parquet", "name": "skill", "category": "kind", "priority": 2},
    ])
    return found.groupBy("priority").agg(F.count(F.lit(1)).alias("entries"), F.countDistinct("skill_name").alias("skills"))


# One text file per part brand and nation, whose content the tables say.
FILES = """select p_brand as name, concat('brand ', p_brand, chr(10)) as content from {part} group by 1
    union all select n_name, concat('nation ', n_name, chr(10)) from {nation}"""


@query("file_hashes", "IO-08", f"""
    select length(content) as bytes, sha256(content) as sha256, md5(content) as md5 from ({FILES})""")
def _(t):
    root = folder(t)
    files = t.sql(FILES).select("name", F.rtrim(F.col("content"), F.lit("\n")).alias("value"))
    files.repartition("name").write.partitionBy("name").text(root)
    return publish.file_hashes(t.spark, root, "*.txt").drop("file_name")


def digest_sql(table: str, columns: list[str]) -> str:
    row = ", '|', ".join(f"coalesce(concat('=', cast({c} as varchar)), '~')" for c in columns)
    h = f"('0x' || substr(md5(concat({row})), 1, 15))::bigint"
    return f"select count(*) as row_count, cast(sum({h}) as varchar) as hash_sum, cast(bit_xor({h}) as varchar) as hash_xor from {{{table}}}"


@query("table_digests", "IO-13", " union all ".join(
    f"select '{tb}' as table_name, * from ({digest_sql(tb, cols)})" for tb, cols in
    {"part": ["p_partkey", "p_name", "p_brand", "p_type", "p_size"], "labels": ["doc_id", "quality", "toxic"]}.items()))
def _(t):
    a = publish.digest(t.part, ["p_partkey", "p_name", "p_brand", "p_type", "p_size"]).select(F.lit("part").alias("table_name"), "*")
    return a.unionByName(publish.digest(t.labels).select(F.lit("labels").alias("table_name"), "*"))


def bundle(t):
    from worklode.functions.dates import date_key

    facts = t.orders.withColumn("date_sk", date_key(F.col("o_orderdate")))
    return {"orders": facts, "customer": t.customer, "part": t.part}, {"orders": ["date_sk", "o_orderkey"], "customer": ["c_custkey"], "part": ["p_partkey"]}


@query("bundle_manifest", "IO-14 IO-13", """
    select 'customer' as table_name, count(*) as row_count, cast(null as int) as first_date_sk, cast(null as int) as last_date_sk, '2001.31.2' as bundle_version from {customer}
    union all select 'part', count(*), null, null, '2001.31.2' from {part}
    union all select 'orders', count(*), cast(min(strftime(o_orderdate, '%Y%m%d')) as int), cast(max(strftime(o_orderdate, '%Y%m%d')) as int), '2001.31.2' from {orders}""")
def _(t):
    return publish.manifest(bundle(t)[0], {"orders": "date_sk"}, AS_OF, 2).drop("hash_sum", "hash_xor")


@query("bundle_period", "IO-14", """
    select cast(min(strftime(o_orderdate, '%Y%m%d')) as int) as period_start, cast(max(strftime(o_orderdate, '%Y%m%d')) as int) as period_end,
           (select count(*) from {orders}) + (select count(*) from {customer}) + (select count(*) from {part}) as total_rows, '2001.31.0' as bundle_version
    from {orders}""")
def _(t):
    return publish.data_period(publish.manifest(bundle(t)[0], {"orders": "date_sk"}, AS_OF))


@query("bundle_round_trip", "IO-11 IO-12 IO-17 S-05", """
    select 'orders' as table_name, count(*) as expected_rows, count(*) as found_rows, 'OK' as result from {orders}
    union all select 'customer', count(*), count(*), 'OK' from {customer} union all select 'part', count(*), count(*), 'OK' from {part}""")
def _(t):
    tables, order = bundle(t)
    root = folder(t)
    publish.export_bundle(tables, order, root)
    # The manifest is computed from the source, so the comparison covers the written files.
    listed = publish.manifest(tables, {"orders": "date_sk"}, AS_OF)
    return publish.validate_bundle(t.spark, listed, {n: d.schema for n, d in tables.items()}, root)


@query("incremental_bundle", "IO-12", """
    select 'orders' as table_name, count(*) as row_count from {orders} where o_orderdate >= timestamp '2001-01-01 00:00:00'
    union all select 'customer', count(*) from {customer} union all select 'part', count(*) from {part}""")
def _(t):
    tables, order = bundle(t)
    return publish.export_bundle(tables, order, folder(t), {"orders": "date_sk"}, 20001231).select("table_name", "row_count")


@query("bundle_load", "IO-18 M-01", """
    select 'fact' as part, count(*) as row_count, cast(sum(o_custkey) as bigint) as key_sum from {orders}
    union all select 'dimension', count(*), cast(sum(c_custkey) as bigint) from {customer}""")
def _(t):
    tables, order = bundle(t)
    root = folder(t)
    publish.export_bundle({n: tables[n] for n in ("orders", "customer")}, order, root)
    held = tables["orders"].filter(F.col("date_sk") <= 20001231)
    facts = publish.load_fact(held, publish.read_csv(t.spark, f"{root}/orders", held.schema), "date_sk")
    some = t.customer.filter("c_acctbal > 0").withColumn("c_name", F.lit("old"))
    dims = publish.load_dimension(some, publish.read_csv(t.spark, f"{root}/customer", some.schema), ["c_custkey"])
    a = facts.agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_custkey").alias("key_sum")).select(F.lit("fact").alias("part"), "*")
    b = dims.filter("c_name <> 'old'").agg(F.count(F.lit(1)).alias("row_count"), F.sum("c_custkey").alias("key_sum"))
    return a.unionByName(b.select(F.lit("dimension").alias("part"), "*"))


@query("upsert_reconciliation", "IO-16 M-01", """
    with s as (select job_id from {staged_jobs}), c as (select job_id from {current_jobs}),
    m as (select count(*) as n from s where job_id in (select job_id from c))
    select 'jobs' as table_name, (select count(*) from s) as source_rows, n as updated_rows, (select count(*) from c) as rows_before,
           (select count(*) from c) + (select count(*) from s) - n as rows_after, (select count(*) from s) as source_rows_held,
           (select count(*) from s) - n as inserted_rows, 'SUCCESS' as status from m""")
def _(t):
    from worklode.operators.upsert import upsert

    after = upsert(t.current_jobs, t.staged_jobs, ["job_id"])
    return publish.reconcile_load(t.staged_jobs, t.current_jobs, after, ["job_id"], "jobs")


@query("schema_manifest", "IO-15 A-15", " union all ".join(
    f"select '{tb}' as table_name, count(*) as row_count, '{c}' as column_name, {i} as \"position\", '{ty}' as data_type, count(*) - count({c}) as nulls from {{{tb}}}"
    for tb, cols in {"part": [("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"), ("p_size", "int"), ("p_retailprice", "double")],
                     "labels": [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")]}.items() for i, (c, ty) in enumerate(cols)))
def _(t):
    found = publish.schema_manifest({"part": t.part, "labels": t.labels})
    return found.withColumn("data_type", F.replace(F.col("data_type"), F.lit("bigint"), F.lit("bigint")))


@query("snapshot_registry", "IO-15 M-01", """
    select 'orders' as table_name, '2001.31.0' as bundle_version, count(*) as row_count from {orders}
    union all select 'customer', '2001.31.0', count(*) from {customer} union all select 'part', '2001.31.0', count(*) from {part}
    union all select 'part', '2001.30.0', count(*) from {part} where p_size > 10""")
def _(t):
    older = publish.manifest({"part": t.part.filter("p_size > 10")}, {}, "2001-07-26")
    empty = older.limit(0)
    registry = publish.register_snapshot(
        empty.select("table_name", "bundle_version", "row_count", "hash_sum", F.lit("").alias("registered_on")), older, "2001-07-26"
    )
    listed = publish.manifest(bundle(t)[0], {"orders": "date_sk"}, AS_OF)
    return publish.register_snapshot(registry, listed, AS_OF).select("table_name", "bundle_version", "row_count")


EDGES = [("customer", "orders"), ("orders", "lineitem"), ("part", "lineitem"), ("supplier", "lineitem"), ("nation", "customer"),
         ("nation", "supplier"), ("region", "nation"), ("documents", "labels")]
ORDER_TABLES = [n for n in BASE_TABLES if n not in ("embeddings", "pages", "benchmark", "conversations", "events")]


@query("load_order_check", "IO-19", f"""
    with n as ({" union all ".join(f"select '{n}' as table_name, count(*) as n from {{{n}}}" for n in ORDER_TABLES)}),
    o as (select table_name, cast(rank() over (order by n desc, table_name) as int) as "position" from n),
    e(parent, child) as (values {", ".join(str(e) for e in EDGES)})
    select parent, child, a."position" as parent_position, b."position" as child_position from e join o a on a.table_name = parent
    join o b on b.table_name = child where a."position" >= b."position" """)
def _(t):
    from functools import reduce

    from pyspark.sql import Window

    def size(n):
        return getattr(t, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("table_name"), "n")

    # A deliberately poor order (largest table first); one row per table.
    sizes = reduce(lambda a, b: a.unionByName(b), [size(n) for n in ORDER_TABLES])
    order = sizes.select("table_name", F.rank().over(Window.orderBy(F.desc("n"), "table_name")).alias("position"))
    edges = t.spark.createDataFrame(EDGES, "parent string, child string")
    return publish.load_order_violations(order, edges)


@query("evolved_schema", "IO-21", """
    select p_partkey, p_name, cast(p_size as bigint) as p_size, cast(null as varchar) as p_note, p_brand from {part}""")
def _(t):
    target = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
                           T.StructField("p_size", T.LongType()), T.StructField("p_note", T.StringType())])
    return publish.align_schema(t.part.select("p_partkey", "p_name", "p_size", "p_brand"), target)


@query("schema_drift", "IO-22 U-05", """
    select column_name, drift, breaking, (select count(*) from {part}) as row_count from (values ('p_brand', 'ADDED', false),
        ('p_note', 'REMOVED', true), ('p_retailprice', 'ADDED', false), ('p_size', 'TYPE_CHANGED', true), ('p_type', 'ADDED', false)) v(column_name, drift, breaking)""")
def _(t):
    expected = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
                             T.StructField("p_size", T.LongType()), T.StructField("p_note", T.StringType())])
    return publish.schema_drift(t.part, expected)


@query("dimension_delta", "IO-23", """
    select o_orderkey, o_orderstatus from {orders} where o_orderdate > timestamp '2001-03-01 00:00:00'""")
def _(t):
    return publish.dimension_delta(t.orders, "o_orderdate", "2001-03-01").select("o_orderkey", "o_orderstatus")


@query("response_log", "IO-04", """
    select event_type as source_name, concat('b', cast(user_id as varchar)) as batch_id, count(*) as record_count, 'logged' as state
    from {events} group by 1, 2""")
def _(t):
    store = TableStore(t.spark, folder(t))
    calls = t.events.groupBy(F.col("event_type").alias("source_name"), F.concat(F.lit("b"), F.col("user_id").cast("string")).alias("batch_id")).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    path = store.append("responses", calls.withColumn("state", F.lit("logged")), ["source_name"])
    return t.spark.read.schema("batch_id string, record_count bigint, state string, source_name string").parquet(path)


@query("partitioned_mart", "IO-09 M-08", """
    select sector_sk, role_sk, count(*) as jobs from {postings} where sector_sk = 3 group by 1, 2""")
def _(t):
    mart = t.postings.groupBy("sector_sk", "role_sk").agg(F.count(F.lit(1)).alias("jobs"))
    store = TableStore(t.spark, folder(t))
    store.replace("mart", mart, ["sector_sk"])
    return store.read("mart").filter("sector_sk = 3").select("sector_sk", "role_sk", "jobs")
