"""Join shapes.  No broadcast hints on data: Spark broadcasts a side only when its own size estimate
allows, and adaptive execution splits skewed partitions of the sort-merge joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.operators.ranking import carried_forward

UNKNOWN_KEY = -1


def unprocessed(batches: DataFrame, ledger: DataFrame, keys: list[str], order: str, limit: int | None = None) -> DataFrame:
    """The batches that the ledger does not list yet, oldest first; at most ``limit`` if a run takes only so many."""
    todo = batches.join(ledger.select(*keys), keys, "left_anti").orderBy(order, *keys)
    return todo if limit is None else todo.limit(limit)


def resolve_keys(df: DataFrame, lookups: list[tuple[DataFrame, str, str, str]]) -> DataFrame:
    """Left-join each (dimension, natural key, surrogate key, output column); unknown becomes -1.

    A natural key that repeats in a dimension would multiply rows, so each lookup is reduced to the
    smallest surrogate key per natural key first.
    """
    for dim, natural, surrogate, out in lookups:
        unique = dim.groupBy(F.col(natural).alias("_nk")).agg(F.min(surrogate).alias(out))
        df = df.join(unique, F.col(natural) == F.col("_nk"), "left").drop("_nk")
        df = df.withColumn(out, F.coalesce(F.col(out), F.lit(UNKNOWN_KEY)))
    return df


def orphans(child: DataFrame, parent: DataFrame, pairs: dict[str, str]) -> DataFrame:
    """Child rows with a non-null key that no parent has; ``pairs`` = {child column: parent column}."""
    keys = parent.select(*[F.col(p).alias(f"_p_{c}") for c, p in pairs.items()])
    on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_p_{c}") for c in pairs])
    return child.dropna(subset=list(pairs)).join(keys, on, "left_anti")


def orphans_of_any(child: DataFrame, parents: list[tuple[DataFrame, str, str]]) -> DataFrame:
    """Child rows for which at least one of several (parent, child column, parent column) is missing."""
    flags = []
    for i, (parent, child_col, parent_col) in enumerate(parents):
        keys = parent.select(F.col(parent_col).alias(f"_p{i}")).distinct().withColumn(f"_hit{i}", F.lit(True))
        child = child.join(keys, F.col(child_col) == F.col(f"_p{i}"), "left")
        flags.append(F.col(child_col).isNotNull() & F.col(f"_hit{i}").isNull())
    helper = [c for c in child.columns if c.startswith(("_p", "_hit"))]
    return child.filter(reduce(lambda a, b: a | b, flags)).drop(*helper)


def not_in(df: DataFrame, column: str, values: DataFrame, value_col: str) -> DataFrame:
    """``column NOT IN (SELECT value_col ...)`` with SQL null rules: a null among the values rejects
    every row, and a null column is never accepted while there are values."""
    has_null = values.select(F.max(F.col(value_col).isNull()).cast("boolean")).scalar()
    is_empty = values.select(F.count(F.lit(1)) == 0).scalar()
    keys = values.select(F.col(value_col).alias("_v"))
    kept = df.join(keys, F.col(column) == F.col("_v"), "left_anti")
    return kept.filter(is_empty | (~F.coalesce(has_null, F.lit(False)) & F.col(column).isNotNull()))


def reconcile(source: DataFrame, target: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Full outer comparison: keys or measures that differ, nulls included."""
    left = source.select(*[F.col(k).alias(f"_s_{k}") for k in keys], *[F.col(m).alias(f"source_{m}") for m in measures])
    right = target.select(*[F.col(k).alias(f"_t_{k}") for k in keys], *[F.col(m).alias(f"target_{m}") for m in measures])
    on = reduce(lambda a, b: a & b, [F.col(f"_s_{k}").eqNullSafe(F.col(f"_t_{k}")) for k in keys])
    differs = reduce(lambda a, b: a | b, [~F.col(f"source_{m}").eqNullSafe(F.col(f"target_{m}")) for m in measures])
    return (
        left.join(right, on, "full")
        .filter(differs)
        .select(
            *[F.coalesce(f"_s_{k}", f"_t_{k}").alias(k) for k in keys],
            *[c for m in measures for c in (f"source_{m}", f"target_{m}")],
        )
    )


def value_as_of(
    facts: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str, valid_to: str, carry: list[str], bucket: Column
) -> DataFrame:
    """Attach the version valid at each fact's time: ``valid_from <= at < valid_to`` (or open).

    Facts and versions of a key are laid on one time line and the latest version is carried forward,
    split over time buckets.  Unlike an interval join this never pairs every fact of a hot key with
    every version of it.  ``bucket`` coarsens the column ``_at``.
    """
    payload = F.struct(F.col(valid_to).alias("_to"), *[F.col(c).alias(f"_c_{c}") for c in carry])
    opened = versions.select(
        F.col(key), F.col(valid_from).alias("_at"), F.lit(0).alias("_kind"), payload.alias("_version"),
        F.lit(None).cast(facts.select(F.struct("*")).schema[0].dataType).alias("_fact"),
    )
    asked = facts.select(
        F.col(key), F.col(at).alias("_at"), F.lit(1).alias("_kind"),
        F.lit(None).cast(opened.schema["_version"].dataType).alias("_version"), F.struct("*").alias("_fact"),
    )
    line = carried_forward(opened.unionByName(asked), [key], ["_at", "_kind"], "_version", bucket, "_valid")
    valid = (F.col("_valid._to").isNull()) | (F.col("_at") < F.col("_valid._to"))
    return line.filter(F.col("_kind") == 1).select(
        "_fact.*", *[F.when(valid, F.col(f"_valid._c_{c}")).alias(f"version_{c}") for c in carry]
    )
