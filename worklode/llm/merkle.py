"""Merkle manifest of a table: a root over all rows, a proof for every row, and the check of rows against it.

Rows are the leaves of one tree per group; the roots of the groups are the leaves of a last tree.  Every node carries the
interval of leaf ranks that it covers (nested-interval labels).  Ancestors are found by containment of intervals, joined
within buckets of levels, and the siblings on the way are what is left of a parent's interval without the node's own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worklode.llm.common import written
from worklode.operators.keys import dense_ids

#: Children of a node.  The last run of a level may be shorter, down to one.
FAN = 3
#: Levels that one containment join attaches; a bucket then holds at most FAN ** TIER units.
TIER = 3


def text_of(digest: Column) -> Column:
    """A digest, or several put together, as lowercase hex digits: the form in which digests are hashed."""
    return F.lower(F.hex(digest))


def hashed(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def field(value: Column) -> Column:
    """A value so that no two lists of values give the same text: ``-`` for null, else its bytes in UTF-8, ``:``, the value."""
    written = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(written).cast("string"), F.lit(":"), written))


def leaf_digest(values: list[Column]) -> Column:
    return hashed(F.concat(*map(field, values)))


@dataclass(frozen=True)
class Manifest:
    """``proofs``: a row per row of the table (see :func:`build`).  ``groups``: group, leaves, subroot, root."""

    proofs: DataFrame
    groups: DataFrame


def _rank(leaves: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(leaves with ``tree``, ``at`` (from 0) and ``size``; one row per tree with its group).

    Leaves are range-partitioned by group, id and digest, so that a group of any size, or any number of equal rows, is
    dealt over many tasks; a running total over one row per range and group turns places inside ranges into ranks.
    """
    order = ["_group", id_col, "leaf", "_row"]
    ranged = leaves.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order])
    ranged = ranged.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order]).withColumn("_place", F.monotonically_increasing_id())
    # Written once: ranges come from a sample, and places must be the same wherever they are used.
    ranged = written(ranged.withColumn("_range", F.shiftright("_place", 33)))
    spans = ranged.groupBy("_group", "_range").agg(F.count("*").alias("_n"), F.min("_place").alias("_first"))
    whole = Window.partitionBy("_group")
    ahead = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumns({"_before": F.coalesce(F.sum("_n").over(ahead), F.lit(0)), "size": F.sum("_n").over(whole)})
    trees = dense_ids(spans.select("_group", "size").distinct(), ["_group"], "tree", start=-1)
    spans = spans.join(trees.select("_group", "tree"), "_group")
    ranked = ranged.join(spans, ["_group", "_range"]).withColumn("at", F.col("_before") + F.col("_place") - F.col("_first"))
    return written(ranked.drop("_group", "_range", "_row", "_place", "_n", "_first", "_before")), trees


def _grow(base: DataFrame) -> list[DataFrame]:
    """The levels of all trees from the leaves up.  ``base``: tree, at, size, digest.

    A node is (tree, at, size, lo, hi, digest, children), with the intervals and digests of its children; ``size`` is the
    number of leaves of its tree.  A level has a third of the nodes of the one below, and trees that have come down to one
    node are not in it.
    """
    none = F.array().cast("array<struct<lo:bigint,hi:bigint,digest:binary>>")
    level = base.select("tree", "at", "size", F.col("at").alias("lo"), (F.col("at") + 1).alias("hi"), "digest", none.alias("children"))
    levels, most, width = [level], base.agg(F.max("size")).first()[0] or 0, 1
    while width < most:
        child = F.struct("lo", "hi", "digest")
        runs = level.filter(F.col("size") > width).groupBy("tree", F.expr(f"at div {FAN}").alias("at"), "size")
        level = runs.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(child)).alias("children"))
        joined = F.array_join(F.transform("children", lambda c: text_of(c["digest"])), "")
        level = written(level.withColumn("digest", hashed(joined)).select(*levels[0].columns))
        levels.append(level)
        width *= FAN
    return levels


def _roots(levels: list[DataFrame]) -> DataFrame:
    tops = [level.filter("lo = 0 and hi = size").select("tree", "size", "digest") for level in levels]
    return reduce(DataFrame.unionByName, tops)


def _paths(levels: list[DataFrame], units: DataFrame, seeds: DataFrame) -> DataFrame:
    """``units`` (tree, at, size, and columns of their own; the leaves of ``levels``) with ``steps`` from the leaf to the end.

    A step is (before, after): the digests left and right of the node among its parent's children.  ``seeds``: for every
    tree the steps after its root, and columns that its leaves are given.  Levels are taken in buckets of TIER, from the
    top: a unit (a node of the lowest level of a bucket) is joined to the ancestors in its bucket that contain its interval,
    and to the steps of the unit above.  So the steps near the root are handed on once for FAN ** TIER nodes, and no row is
    repeated for each of its ancestors on more than TIER levels.
    """
    given = [c for c in seeds.columns if c not in ("tree", "size", "steps")]
    above = None
    for low in range((len(levels) - 1) // TIER * TIER, -1, -TIER):
        width = FAN ** (low + TIER)
        bucket = F.expr(f"lo div {width}").alias("bucket")
        tops = seeds.filter(F.col("size") * FAN <= width)
        if low:
            tops = tops.filter(F.col("size") * FAN > FAN**low)
        tops = tops.select("tree", F.lit(0).cast("bigint").alias("bucket"), "steps", *given)
        above = tops if above is None else above.unionByName(tops)

        nodes = units if low == 0 else levels[low].drop("children", "digest")
        if low == 0:
            nodes = nodes.withColumns({"lo": F.col("at"), "hi": F.col("at") + 1})
        own = [c for c in nodes.columns if c not in ("lo", "hi", "tree")]
        nodes = nodes.select("*", bucket)
        parents = [
            level.select("tree", bucket, F.lit(low + i).alias("level"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "children")
            for i, level in enumerate(levels[low + 1 : low + TIER + 1])
        ]
        steps = F.array().cast("array<struct<before:binary,after:binary>>")
        if parents:
            inside = (F.col("n.tree") == F.col("p.tree")) & (F.col("n.bucket") == F.col("p.bucket"))
            inside &= (F.col("_lo") <= F.col("lo")) & (F.col("hi") <= F.col("_hi"))
            found = nodes.alias("n").join(reduce(DataFrame.unionByName, parents).alias("p"), inside, "left")

            def side(keep) -> Column:
                return F.unhex(F.array_join(F.transform(F.filter("children", keep), lambda c: F.hex(c["digest"])), ""))

            # What the parent's interval holds beside the node's own.
            before, after = side(lambda c: c["hi"] <= F.col("lo")), side(lambda c: c["lo"] >= F.col("hi"))
            step = F.struct("level", before.alias("before"), after.alias("after"))
            keys = [F.col("n.tree").alias("tree"), F.col("n.bucket").alias("bucket"), *own, "lo", "hi"]
            nodes = found.groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(F.col("level").isNotNull(), step))).alias("steps"))
            steps = F.transform("steps", lambda s: F.struct(s["before"].alias("before"), s["after"].alias("after")))
        nodes = nodes.select("tree", "bucket", *own, steps.alias("_steps")).join(above, ["tree", "bucket"])
        nodes = nodes.withColumn("steps", F.concat("_steps", "steps"))
        if low == 0:
            return nodes.select("tree", *own, "steps", *given)
        above = written(nodes.select("tree", F.col("at").alias("bucket"), "steps", *given))


def build(
    rows: DataFrame, columns: list[str], id_col: str = "doc_id", group_col: str = "source", altered: dict[str, Column] | None = None
) -> Manifest:
    """Trees over ``rows``: a leaf is the digest of the values of ``columns``.

    Leaves of a group ascend by id (null first, then by digest); while a group has several nodes, every FAN consecutive ones
    become the digest of their digests.  What remains is the subroot of the group (a lone leaf itself), and the subroots,
    ordered by group (null first, then by UTF-8 bytes), become the root in the same way.

    ``proofs``: the id, ``leaf``, ``held`` (the leaf of the row with the values ``altered`` in place of its own; without
    any, the leaf), ``steps`` (before, after: the siblings on each level up to the root), ``subroot``, ``root``; digests are
    binary.  Null values have a digest of their own, texts of any length are hashed whole, repeated rows are leaves of
    their own with equal digests, other columns do not matter, and an empty table gives no rows and no groups.
    """
    at_first = leaf_digest([F.col(c) for c in columns])
    altered = altered or {}
    later = leaf_digest([altered.get(c, F.col(c)) for c in columns])
    # The order of marked groups is that of the groups, with null as the empty text before all others.
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = rows.select(group.alias("_group"), F.col(id_col).alias("_id"), at_first.alias("leaf"), later.alias("_later"))
    changed = F.when(F.col("_later") != F.col("leaf"), F.col("_later"))
    # Texts are read once; the row number deals equal rows over ranges.
    leaves = written(leaves.withColumn("_changed", changed).drop("_later").withColumn("_row", F.monotonically_increasing_id()))
    ranked, trees = _rank(leaves, "_id")

    levels = _grow(ranked.withColumnRenamed("leaf", "digest"))
    roots = written(_roots(levels))
    last = roots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("at"), F.lit(roots.count()).cast("bigint").alias("size"), "digest")
    upper = _grow(last)
    no_steps = F.array().cast("array<struct<before:binary,after:binary>>").alias("steps")
    top = _roots(upper).select("tree", "size", no_steps, F.col("digest").alias("root"))
    subroots = _paths(upper, last.drop("digest"), top).select(F.col("at").alias("tree"), "steps", "root")
    seeds = written(subroots.join(roots.select("tree", "size", F.col("digest").alias("subroot")), "tree"))
    proofs = _paths(levels, ranked, seeds)
    held = F.coalesce("_changed", "leaf").alias("held")
    proofs = proofs.select(F.col("_id").alias(id_col), "leaf", held, "steps", "subroot", "root")
    named = trees.join(seeds.select("tree", "subroot", "root"), "tree")
    name = F.when(F.col("_group") != "", F.substr("_group", F.lit(2))).alias(group_col)
    return Manifest(proofs, named.select(name, F.col("size").alias("leaves"), text_of(F.col("subroot")).alias("subroot"), text_of(F.col("root")).alias("root")))


def folded_root(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(steps, leaf, lambda digest, s: hashed(text_of(F.concat(s["before"], digest, s["after"]))))


def check(proofs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Every row held now against the root it was built into: the id, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (of all
    its siblings from the leaf to the root, left to right), ``folded_root``, ``verified``; digests as hex digits."""
    siblings = F.aggregate("steps", F.lit(b""), lambda all, s: F.concat(all, s["before"], s["after"]))
    found = proofs.withColumn("_folded", folded_root(F.col("held"), F.col("steps")))
    return found.select(
        id_col, text_of(F.col("leaf")).alias("leaf"), text_of(F.col("subroot")).alias("subroot"), text_of(F.col("root")).alias("root"),
        F.sha2(text_of(siblings), 256).alias("proof_sha256"), text_of(F.col("_folded")).alias("folded_root"),
        (F.col("_folded") == F.col("root")).alias("verified"),
    )
