"""Skill graph queries: skills are part brands, postings are orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from worklode.operators import graph
from worklode.queries.registry import query

TYPES = ["CO_OCCURS", "REQUIRES", "SIMILAR"]

PAIRS_CTE = """
    b as (select distinct job_sk, skill_sk from {job_skills}), n as (select count(distinct job_sk) as total from {job_skills}),
    pairs as (select x.skill_sk as item_a, y.skill_sk as item_b, count(*) as pair_count, cast(count(*) as double) / (select total from n) as support
              from b x join b y on x.job_sk = y.job_sk and x.skill_sk < y.skill_sk group by 1, 2
              having count(*) >= 5 and cast(count(*) as double) / (select total from n) >= 0.012)"""


def pairs(t):
    return graph.co_occurrence(t.job_skills, "job_sk", "skill_sk", 5, 0.012)


@query("skill_co_occurrence", "J-08 A-13 GR-02", f"with {PAIRS_CTE} select * from pairs")
def _(t):
    return pairs(t)


@query("co_occurrence_edges", "GR-02", f"""
    with {PAIRS_CTE} select item_a as source, item_b as target, support as weight, 'CO_OCCURS' as edge_type from pairs
    union all select item_b, item_a, support, 'CO_OCCURS' from pairs""")
def _(t):
    return graph.co_occurrence_edges(pairs(t))


PART_ITEMS = "select p_partkey as item, p_name as name, p_type as category from {part}"
RULES = """select distinct upper(p_name) as name, 'red bolt ' as requires, 0.9 as weight from {part} where p_size < 3"""
PREREQ = f"""
    req as (select a.item as source, b.item as target, cast(0.9 as double) as weight, 'REQUIRES' as edge_type
            from ({RULES}) r join (select min(item) as item, name from ({PART_ITEMS}) group by 2) a on lower(trim(a.name)) = lower(trim(r.name))
            join (select min(item) as item, name from ({PART_ITEMS}) group by 2) b on lower(trim(b.name)) = lower(trim(r.requires)))"""
SIMILAR = f"""
    sim as (select source, target, cast(0.7 as double) as weight, 'SIMILAR' as edge_type from (
            select cast(a.item as varchar) as source, cast(b.item as varchar) as target,
                   row_number() over (partition by a.item order by cast(b.item as varchar)) as rn
            from ({PART_ITEMS}) a join ({PART_ITEMS}) b on a.category = b.category and a.item <> b.item) where rn <= 20)"""


def small_items(t):
    """Brands as items, so that the prerequisite rules name few of them."""
    return t.skills.select(F.col("skill_sk").alias("item"), F.col("skill_name").alias("name"), F.col("skill_category").alias("category"))


BRAND_ITEMS = "select skill_sk as item, skill_name as name, skill_category as category from {skills}"
BRAND_RULES = """select skill_name as name, concat(' brand#', cast(skill_sk - 10 as string)) as requires, cast(0.9 as double) as weight
    from {skills} where skill_sk > 10"""
BRAND_EDGES = f"""
    it as ({BRAND_ITEMS}),
    req as (select a.item as source, b.item as target, weight, 'REQUIRES' as edge_type from ({BRAND_RULES}) r
            join it a on lower(trim(a.name)) = lower(trim(r.name)) join it b on lower(trim(b.name)) = lower(trim(r.requires))),
    sim as (select a.item as source, b.item as target, cast(0.7 as double) as weight, 'SIMILAR' as edge_type
            from it a join it b on a.category = b.category and a.item <> b.item),
    co as (select item_a as source, item_b as target, support as weight, 'CO_OCCURS' as edge_type from pairs
           union all select item_b, item_a, support, 'CO_OCCURS' from pairs),
    al as (select cast(source as varchar) as source, cast(target as varchar) as target, weight, edge_type
           from (select * from co union all select * from req union all select * from sim)),
    edges as (select source, target, weight, edge_type, md5(concat(source, '|', target, '|', edge_type)) as edge_id from (
              select *, row_number() over (partition by source, edge_type order by weight desc, target) as rn from al) where rn <= 20)"""


def edges(t):
    items = small_items(t)
    parts = [
        graph.co_occurrence_edges(pairs(t)), graph.prerequisite_edges(t.sql(BRAND_RULES), items, "item", "name"),
        graph.similarity_edges(items, "item", "category"),
    ]
    return graph.unify_edges(parts)


@query("prerequisite_edges", "GR-03", f"with {PREREQ.strip()} select source, target, weight, edge_type from req")
def _(t):
    return graph.prerequisite_edges(t.sql(RULES), t.sql(PART_ITEMS), "item", "name")


@query("similarity_edges", "GR-04 A-20", f"with {SIMILAR.strip()} select source, target, weight, edge_type from sim")
def _(t):
    return graph.similarity_edges(t.sql(PART_ITEMS), "item", "category")


@query("skill_graph", "GR-05 U-04 W-06", f"with {PAIRS_CTE}, {BRAND_EDGES} select * from edges")
def _(t):
    return edges(t)


@query("node_metrics", "GR-06 A-02", f"""
    with {PAIRS_CTE}, {BRAND_EDGES}
    select source as node, count(*) as degree, count(case when edge_type = 'CO_OCCURS' then 1 end) as co_occurs_edges,
           count(case when edge_type = 'REQUIRES' then 1 end) as requires_edges, count(case when edge_type = 'SIMILAR' then 1 end) as similar_edges,
           cast(sum(cast(weight as decimal(18,8))) as double) / count(*) as avg_weight, max(weight) as max_weight from edges group by 1""")
def _(t):
    return graph.node_metrics(edges(t), TYPES)


FACTS = "select p.job_sk, company_sk, sector_sk, role_sk, location_sk, skill_sk from {postings} p join {job_skills} k on k.job_sk = p.job_sk"
KINDS = {"BELONGS_TO": ("company_sk", "sector_sk"), "CONTAINS": ("sector_sk", "role_sk"), "REQUIRES": ("role_sk", "skill_sk"),
         "HIRES_FOR": ("company_sk", "role_sk"), "LOCATED_IN": ("company_sk", "location_sk")}


@query("ontology_edges", "GR-07", f"with f as ({FACTS}) " + " union all ".join(
    f"select cast({a} as varchar) as source, cast({b} as varchar) as target, count(distinct job_sk) as job_count, '{n}' as edge_type from f group by 1, 2"
    for n, (a, b) in KINDS.items()))
def _(t):
    return graph.typed_edges(t.sql(FACTS), KINDS)


@query("skill_pathways", "GR-08", f"""
    with {PAIRS_CTE}, {BRAND_EDGES},
    e as (select source, target, max(weight) as weight from edges group by 1, 2),
    one as (select source as origin, target as node, weight as strength from e where cast(source as int) <= 5),
    two as (select origin, e.target as node, max(strength * e.weight) as strength from one join e on e.source = one.node where e.target <> origin group by 1, 2)
    select origin, node, strength, 1 as hops from one union all select origin, node, strength, 2 from two""")
def _(t):
    return graph.neighbours(edges(t), 2, F.col("source").cast("int") <= 5)


@query("role_skills", "GR-08 S-03", f"""
    with f as ({FACTS}) select role_sk, skill_sk, job_count from (select role_sk, skill_sk, count(distinct job_sk) as job_count,
        row_number() over (partition by role_sk order by count(distinct job_sk) desc, skill_sk) as rn from f group by 1, 2) where rn <= 5""")
def _(t):
    from worklode.operators.ranking import best_per_key

    counts = t.sql(FACTS).groupBy("role_sk", "skill_sk").agg(F.countDistinct("job_sk").alias("job_count"))
    return best_per_key(counts, ["role_sk"], [F.desc("job_count"), F.asc("skill_sk")], 5)


@query("company_role_skills", "GR-08", f"""
    with f as ({FACTS}) select company_sk, count(distinct role_sk) as roles, count(distinct skill_sk) as skills from f group by 1""")
def _(t):
    return t.sql(FACTS).groupBy("company_sk").agg(F.countDistinct("role_sk").alias("roles"), F.countDistinct("skill_sk").alias("skills"))


@query("cross_sector_skills", "GR-08", f"""
    with f as ({FACTS}), s as (select distinct sector_sk, skill_sk, location_sk from f)
    select a.sector_sk as sector_a, b.sector_sk as sector_b, count(*) as shared_skills from s a join s b on a.skill_sk = b.skill_sk
    and a.location_sk = b.location_sk and a.sector_sk < b.sector_sk group by 1, 2""")
def _(t):
    # A skill at a place is the group, its sectors are the items (a handful, so no support is needed).
    facts = t.sql(FACTS).withColumn("skill_place", F.concat_ws("|", "skill_sk", "location_sk"))
    found = graph.co_occurrence(facts, "skill_place", "sector_sk", 1, 1e-9)
    return found.select(F.col("item_a").alias("sector_a"), F.col("item_b").alias("sector_b"), F.col("pair_count").alias("shared_skills"))


@query("related_skills_json", "G-15 GR-02", f"""
    with {PAIRS_CTE}, e as (select item_a as item, item_b as other, pair_count from pairs union all select item_b, item_a, pair_count from pairs),
    r as (select *, row_number() over (partition by item order by pair_count desc, other) as rn from e)
    select item, concat('[', string_agg(concat(chr(123), '"item":', other, ',"count":', pair_count, chr(125)), ',' order by rn), ']') as related_json
    from r where rn <= 5 group by 1""")
def _(t):
    return graph.top_related(pairs(t))
