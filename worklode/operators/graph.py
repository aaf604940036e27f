"""Skill graph: co-occurrence, prerequisite and similarity edges, node metrics, typed edges and walks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.operators.aggregates import count_where
from worklode.operators.ranking import best_per_key

PART_ROWS = 250_000  # facts whose edges one task makes unique


def co_occurrence(pairs: DataFrame, group: str, item: str, min_count: int = 5, min_support: float = 0.01) -> DataFrame:
    """(item_a < item_b, pair_count, support) for items that share enough groups.

    An item below a threshold cannot be part of a pair that meets it, so such items go first.  Since each
    remaining item is in at least ``min_support`` of all groups, there are at most (mean group size /
    min_support) of them, which bounds what a group can hold.  Groups with the same items are counted
    once with a weight.  Both steps are exact.
    """
    if not min_support > 0:
        raise ValueError("min_support must be positive: it bounds the number of items per group")
    rows = pairs.select(F.col(group).alias("_g"), F.col(item).alias("_i")).dropna().distinct()
    total = pairs.select(F.countDistinct(group)).scalar()
    counts = rows.groupBy("_i").agg(F.count(F.lit(1)).alias("_n"))
    common = counts.filter((F.col("_n") >= min_count) & (F.col("_n").cast("double") / total >= min_support)).select("_i")
    baskets = rows.join(common, "_i").groupBy("_g").agg(F.sort_array(F.collect_list("_i")).alias("_items"))
    weighted = baskets.filter(F.size("_items") > 1).groupBy("_items").agg(F.count(F.lit(1)).alias("_w"))
    first = weighted.select("_items", "_w", F.posexplode("_items").alias("_p", "item_a"))
    second = F.explode(F.slice("_items", F.col("_p") + 2, F.size("_items")))
    found = first.select("_w", "item_a", second.alias("item_b")).groupBy("item_a", "item_b").agg(F.sum("_w").alias("pair_count"))
    support = F.col("pair_count").cast("double") / total.cast("double")
    return found.withColumn("support", support).filter((F.col("pair_count") >= min_count) & (F.col("support") >= min_support))


def co_occurrence_edges(pairs: DataFrame) -> DataFrame:
    """Both directions of each pair as edges."""
    one = pairs.select(F.col("item_a").alias("source"), F.col("item_b").alias("target"), F.col("support").alias("weight"))
    two = pairs.select(F.col("item_b").alias("source"), F.col("item_a").alias("target"), F.col("support").alias("weight"))
    return one.unionByName(two).withColumn("edge_type", F.lit("CO_OCCURS"))


def prerequisite_edges(rules: DataFrame, items: DataFrame, item: str, name: str) -> DataFrame:
    """Edges from a rule table (name, requires, weight) whose two ends are both known items.  A name used
    by several items stands for the one with the smallest id."""
    ends = items.groupBy(F.lower(F.trim(name)).alias("_n")).agg(F.min(item).alias("_id"))
    left = rules.withColumn("_n", F.lower(F.trim("name"))).join(ends.withColumnRenamed("_id", "source"), "_n").drop("_n")
    both = left.withColumn("_n", F.lower(F.trim("requires"))).join(ends.withColumnRenamed("_id", "target"), "_n")
    return both.select("source", "target", F.col("weight").cast("double").alias("weight"), F.lit("REQUIRES").alias("edge_type"))


def similarity_edges(items: DataFrame, item: str, category: str, weight: float = 0.7, keep: int = 20) -> DataFrame:
    """Each item to items of its category, already pruned to ``keep`` per item.

    All these edges weigh the same, so pruning by (weight, target) keeps the ``keep`` smallest other ids
    of the category.  They are found among the first ``keep + 1`` members: the result equals pruning
    all pairs, at a cost linear in the number of items.
    """
    nodes = items.select(F.col(item).cast("string").alias("_id"), F.col(category).alias("_c")).dropna().distinct()
    heads = best_per_key(nodes, ["_c"], [F.asc("_id")], keep + 1).withColumnRenamed("_id", "target")
    edges = nodes.join(heads, "_c").filter(F.col("_id") != F.col("target"))
    kept = best_per_key(edges, ["_id"], [F.asc("target")], keep)
    return kept.select(F.col("_id").alias("source"), "target", F.lit(weight).alias("weight"), F.lit("SIMILAR").alias("edge_type"))


def unify_edges(parts: list[DataFrame], keep: int = 20) -> DataFrame:
    """All edge kinds in one schema, the ``keep`` heaviest per source and type, with a stable edge id."""
    columns = [F.col("source").cast("string"), F.col("target").cast("string"), F.col("weight").cast("double"), F.col("edge_type")]
    merged = reduce(lambda a, b: a.unionByName(b), [p.select(*columns) for p in parts])
    top = best_per_key(merged, ["source", "edge_type"], [F.desc("weight"), F.asc("target")], keep)
    return top.withColumn("edge_id", F.md5(F.concat_ws("|", "source", "target", "edge_type")))


def node_metrics(edges: DataFrame, types: list[str]) -> DataFrame:
    """Out-degree in all and by type, mean and largest weight per node."""
    total = F.sum(F.col("weight").cast("decimal(18,8)")).cast("double")
    return edges.groupBy(F.col("source").alias("node")).agg(
        F.count(F.lit(1)).alias("degree"),
        *[count_where(F.col("edge_type") == t).alias(f"{t.lower()}_edges") for t in types],
        (total / F.count(F.lit(1)).cast("double")).alias("avg_weight"), F.max("weight").alias("max_weight"),
    )


def typed_edges(facts: DataFrame, kinds: dict[str, tuple[str, str]]) -> DataFrame:
    """Ontology edges {type: (from column, to column)} with the number of postings behind each.

    Facts are dealt into as many parts as their number asks for, so what one task makes unique does not grow with them.
    """
    columns = list(dict.fromkeys(["job_sk", *[c for ends in kinds.values() for c in ends]]))
    facts = facts.select(*columns)
    # By posting, as the edges of a posting are made unique: that needs no further shuffle.
    facts = facts.repartition(facts.count() // PART_ROWS + 1, "job_sk")
    pairs = [F.struct(F.lit(n).alias("edge_type"), F.col(a).cast("string").alias("source"), F.col(b).cast("string").alias("target"))
             for n, (a, b) in kinds.items()]
    rows = facts.select("job_sk", F.explode(F.array(*pairs)).alias("_e")).select("job_sk", "_e.*").dropna()
    # Postings are made unique per edge first, so a hub is counted from partial results.
    unique = rows.distinct()
    return unique.groupBy("edge_type", "source", "target").agg(F.count(F.lit(1)).alias("job_count"))


def neighbours(edges: DataFrame, hops: int, start: Column) -> DataFrame:
    """Walks of 1..``hops`` edges from the chosen nodes: (origin, node, hops, strength).

    ``edges`` is the built graph, which keeps a bounded number of edges per node and type, so a hub cannot
    multiply walks.  The strength of a walk is the product of its weights; after each step only the best
    walk per pair of ends is carried on.
    """
    pruned = edges.groupBy("source", "target").agg(F.max("weight").alias("weight"))
    frontier = pruned.filter(start).select(F.col("source").alias("origin"), F.col("target").alias("node"), F.col("weight").alias("strength"))
    levels = []
    for hop in range(1, hops + 1):
        if hop > 1:
            frontier = frontier.join(pruned, F.col("node") == F.col("source")).select(
                "origin", F.col("target").alias("node"), (F.col("strength") * F.col("weight")).alias("strength")
            ).filter(F.col("node") != F.col("origin"))
        frontier = frontier.groupBy("origin", "node").agg(F.max("strength").alias("strength"))
        levels.append(frontier.withColumn("hops", F.lit(hop)))
    return reduce(lambda a, b: a.unionByName(b), levels)


def top_related(pairs: DataFrame, keep: int = 5) -> DataFrame:
    """Per item a JSON list of the ``keep`` items it most often occurs with."""
    edges = pairs.select(F.col("item_a").alias("item"), F.col("item_b").alias("other"), "pair_count").unionByName(
        pairs.select(F.col("item_b").alias("item"), F.col("item_a").alias("other"), "pair_count")
    )
    top = best_per_key(edges, ["item"], [F.desc("pair_count"), F.asc("other")], keep)
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("pair_count")).alias("o"), "other", "pair_count")))
    listed = F.transform(ordered, lambda s: F.struct(s["other"].alias("item"), s["pair_count"].alias("count")))
    return top.groupBy("item").agg(F.to_json(listed).alias("related_json"))
