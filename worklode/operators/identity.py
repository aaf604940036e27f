"""The same posting in several sources: match keys, partners and clusters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.functions.fixed_values import IDENTITY_RULES
from worklode.functions.text import record_hash
from worklode.operators.ranking import best_per_key
from worklode.session import cut_lineage


def match_keys(jobs: DataFrame, key: str, source: str, company: str, title: str, location: str, description: str, order: list[str]) -> DataFrame:
    """One row per record and rule: rule, score, match key.  The whole description is hashed.

    The keys are used several times and are far smaller than the texts, so write them once
    (``cut_lineage``) before matching.
    """
    parts = {
        "EXACT_MATCH": [company, title, location],
        "COMPOSITE_HASH": [company, title, description],
        "COMPANY_TITLE": [company, title],
    }
    rules = F.explode(F.array(*[
        F.struct(F.lit(rule).alias("match_rule"), F.lit(IDENTITY_RULES[rule]).alias("match_score"), record_hash(cols).alias("match_key"))
        for rule, cols in parts.items()
    ]))
    kept = list(dict.fromkeys([key, source, *order]))
    return jobs.select(*kept, rules.alias("_r")).select(*kept, "_r.*")


def cross_source_partners(keyed: DataFrame, key: str, source: str, order: list[str]) -> DataFrame:
    """For every record and rule, the earliest record of *another* source with the same match key.

    This is the linear form of all cross-source pairs: of each key group only the earliest record per
    source is kept, and of those the first two (from different sources) serve every member.  A group of
    n copies so costs n rows, not n * n, and connects the same records.
    """
    group = ["match_rule", "match_key"]
    position = F.struct(*[F.col(c) for c in dict.fromkeys([*order, key])])
    firsts = keyed.groupBy(*group, source).agg(F.min(position).alias("_at"))
    anchors = best_per_key(firsts, group, [F.asc("_at")], 2)
    pairs = anchors.groupBy(*group).agg(
        F.min(F.struct(F.col("_at"), F.col(source).alias("s"))).alias("_a"),
        F.max(F.struct(F.col("_at"), F.col(source).alias("s"))).alias("_b"), F.count(F.lit(1)).alias("_k"),
    ).filter("_k = 2")
    joined = keyed.join(pairs, group)
    other = F.when(F.col(source) == F.col("_a.s"), F.col("_b")).otherwise(F.col("_a"))
    return joined.select(
        key, source, F.col("match_rule"), "match_score",
        other["_at"][key].alias("partner_id"), other["s"].alias("partner_source"),
    )


def best_partner(partners: DataFrame, key: str) -> DataFrame:
    """The strongest rule per record."""
    return best_per_key(partners, [key], [F.desc("match_score"), F.asc("partner_id")])


def pair_counts(keyed: DataFrame, source: str) -> DataFrame:
    """Number of unordered cross-source pairs per rule, counted from group sizes without forming a pair."""
    per_source = keyed.groupBy("match_rule", "match_key", source).agg(F.count(F.lit(1)).alias("_n"))
    per_key = per_source.groupBy("match_rule", "match_key").agg(
        F.sum("_n").alias("_n"), F.sum(F.col("_n") * F.col("_n")).alias("_own")
    )
    return per_key.groupBy("match_rule").agg(F.sum((F.col("_n") * F.col("_n") - F.col("_own")) / 2).cast("bigint").alias("pair_count"))


def keep_first_posting(jobs: DataFrame, keys: list[str], posted: str, priority: Column, tie: str) -> DataFrame:
    """One record per identity key: the earliest, then by source priority, then by id."""
    return best_per_key(jobs, keys, [F.asc(posted), priority.asc(), F.asc(tie)])


def clusters(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Connected components as (node, cluster), the cluster named by its smallest node.

    Each round takes the smallest label among the neighbours and then the label of that label (pointer
    jumping), so long chains shrink geometrically.  Labels are written to the shared folder each round;
    the rounds end when no label changes.
    """
    one_way = edges.select(F.col(a).alias("src"), F.col(b).alias("dst")).filter(F.col(a) != F.col(b))
    both = one_way.unionByName(one_way.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct()
    both = cut_lineage(both)
    labels = cut_lineage(both.groupBy(F.col("src").alias("node")).agg(F.least(F.col("src"), F.min("dst")).alias("label")))
    while True:
        near = both.join(labels.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node")).agg(
            F.min("label").alias("_near")
        )
        lower = labels.join(near, "node").select("node", F.col("label").alias("_old"), F.least("label", "_near").alias("_new"))
        jump = labels.select(F.col("node").alias("_new"), F.col("label").alias("_root"))
        moved = lower.join(jump, "_new", "left").select(
            "node", "_old", F.least("_new", F.coalesce("_root", "_new")).alias("label")
        )
        moved = cut_lineage(moved)
        if moved.filter(F.col("label") != F.col("_old")).isEmpty():
            return moved.select("node", F.col("label").alias("cluster"))
        labels = moved.select("node", "label")
