"""Multi-level aggregates in one pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_levels(
    df: DataFrame, fixed: list[str], levels: dict[str, list[str]], measures: list[Column], level_col: str = "rollup_level"
) -> DataFrame:
    """Aggregate ``measures`` by ``fixed`` + the columns of each level, as one GROUPING SETS pass.

    ``levels`` = {level name: columns kept}.  Columns a level leaves out are null; the level name tells
    such a null apart from an unknown key.
    """
    varying = list(dict.fromkeys(c for cols in levels.values() for c in cols))
    sets = [[F.col(c) for c in [*fixed, *cols]] for cols in levels.values()]
    every = [F.col(c) for c in [*fixed, *varying]]
    grouped = df.groupingSets(sets, *every).agg(*measures, F.grouping_id(*every).alias("_gid"))

    def gid(cols: list[str]) -> int:
        bits = [0] * len(fixed) + [0 if c in cols else 1 for c in varying]
        return reduce(lambda total, bit: total * 2 + bit, bits, 0)

    name = reduce(
        lambda acc, item: acc.when(F.col("_gid") == gid(item[1]), item[0]), levels.items(), F.when(F.lit(False), "")
    )
    return grouped.withColumn(level_col, name).drop("_gid")


def stack_levels(df: DataFrame, levels: dict[str, list[str]], level_col: str = "rollup_level") -> DataFrame:
    """The rows of every level below each other, with the columns that a level leaves out as null (for operators that are
    not plain aggregates, such as exact percentiles).  ``df`` is best aggregated already: Spark shuffles for it once and
    reads the result for each level, so no row of the facts is copied."""
    varying = list(dict.fromkeys(c for cols in levels.values() for c in cols))
    types, others = dict(df.dtypes), [c for c in df.columns if c not in varying]

    def level(name: str, cols: list[str]) -> DataFrame:
        kept = [F.col(c) if c in cols else F.lit(None).cast(types[c]).alias(c) for c in varying]
        return df.select(*others, F.lit(name).alias(level_col), *kept)

    return reduce(DataFrame.unionByName, [level(n, c) for n, c in levels.items()])
