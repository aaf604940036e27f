"""Exact percentiles without collecting a group in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worklode.session import write_table


def same_keys(left: str, right: str, keys: list[str]) -> Column:
    """Join condition on equal keys where null equals null (rolled-up keys are null)."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, probabilities: dict[str, float], count_col: str | None = None, weight: str | None = None
) -> DataFrame:
    """One row per key: linear-interpolated percentiles {column: probability}, and the row count.  A row counts ``weight`` times.

    All groups are ranked at once.  Equal values are counted first, so a key and value is one row; these are dealt into
    ranges by key and value, so that a group of any size lies in as many ranges as it needs, and small groups share one.
    Rows are ranked inside their range.  Only the first and the last key of a range can go on in another one; for these,
    two rows a range at most, counts per range give the rows before it and in all.  Null values are left out, and keys
    without any other value have no row; null keys are keys.
    """
    times = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).alias("_v")).agg(times.alias("_n"))
    ranged = counted.repartitionByRange(*[F.col(c).asc_nulls_first() for c in [*keys, "_v"]])
    # Written once: range borders come from a sample, and must be the same for counting and for ranking.
    ranged = write_table(ranged.withColumn("_range", F.spark_partition_id()))

    ends = F.explode(F.array_distinct(F.array(F.min(F.struct(*keys)), F.max(F.struct(*keys))))).alias("_key")
    ends = ranged.groupBy("_range").agg(ends).select("_range", "_key.*")
    inside = Window.partitionBy(*keys, "_range")
    placed = ranged.withColumns({"_upto": F.sum("_n").over(inside.orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)), "_in": F.sum("_n").over(inside)})

    # Bounded by the number of ranges, whatever the number of rows and groups: two rows each.
    cut = ranged.alias("r").join(F.broadcast(ends).alias("e"), same_keys("r", "e", [*keys, "_range"]))
    cut = cut.groupBy(*[F.col(f"r.{k}").alias(k) for k in [*keys, "_range"]]).agg(F.sum("_n").alias("_in"))
    group = Window.partitionBy(*keys)
    ahead = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.select(*keys, "_range", F.sum("_in").over(ahead).alias("_before"), F.sum("_in").over(group).alias("_total"))
    held = placed.alias("r").join(F.broadcast(cut).alias("s"), same_keys("r", "s", [*keys, "_range"]), "left")
    last = (F.coalesce("_before", F.lit(0)) + F.col("_upto") - 1).alias("_last")
    held = held.select(*[F.col(f"r.{k}").alias(k) for k in keys], "_v", "_n", last, F.coalesce("_total", "_in").alias("_total"))

    def place(p: float) -> Column:
        return F.lit(p) * (F.col("_total") - 1)

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("_last") - F.col("_n") < rank) & (rank <= F.col("_last")), F.col("_v"))).cast("double")

    picks, outs = [F.max("_total").alias("_total")], []
    for name, p in probabilities.items():
        picks += [at(F.floor(place(p))).alias(f"_lo_{name}"), at(F.ceil(place(p))).alias(f"_hi_{name}")]
        low, high = F.col(f"_lo_{name}"), F.col(f"_hi_{name}")
        outs.append((low + (high - low) * (place(p) - F.floor(place(p)))).alias(name))
    return held.groupBy(*keys).agg(*picks).select(*keys, *outs, *([F.col("_total").alias(count_col)] if count_col else []))
