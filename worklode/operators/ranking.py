"""Row picking and row-to-row comparison that stay balanced when one key holds most of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOT = 100_000  # rows of a key that one task takes whole


def best_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows per key.  The rank filter is pushed below the shuffle, so each task sends at
    most ``n`` rows of a hot key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") <= n).drop("_rn")


def top_n_with_ties(df: DataFrame, keys: list[str], order: list[Column], n: int, rank_col: str) -> DataFrame:
    """Rows whose dense rank is at most ``n``, ties included."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.dense_rank().over(window)).filter(F.col(rank_col) <= n)


def spread(df: DataFrame, keys: list[str], bucket: Column, counted: DataFrame | None = None, **known: Column) -> DataFrame:
    """``df`` with ``_hot`` (the key has more than HOT rows, or is null) and ``_bucket``, which is null unless hot.

    ``counted``: rows to count the keys by, if others than ``df`` are cheaper.  ``known``: aggregates of these, added to the
    rows of keys with more than HOT rows.
    """
    counts = (df if counted is None else counted).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in known.items()])
    hot = counts.filter(F.col("_n") > HOT).drop("_n").withColumn("_hot", F.lit(True))
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    # One row per hot key: at most one for every HOT rows.
    marked = df.join(F.broadcast(hot), keys, "left").withColumn("_hot", F.coalesce("_hot", missing))
    return marked.withColumn("_bucket", F.when(F.col("_hot"), bucket))


def shifted(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, str], bucket: Column, back: bool = True
) -> DataFrame:
    """``lag`` (or ``lead`` if not ``back``) of ``values`` = {new column: source column} per key.

    Rows of a key with more than HOT rows are spread over ``bucket`` (a coarsening of the first order column, such as its
    month).  Inside a bucket this is a plain window; the row at a bucket's edge takes its neighbour
    from a summary of one row per key and bucket.  A key holding a third of all rows is so split over
    as many tasks as it has buckets.  All other keys are one bucket, so their rows are shuffled once.
    """
    return shift_spread(spread(df, keys, bucket), keys, order, values, bucket, back).drop("_hot", "_bucket")


def shift_spread(
    df: DataFrame, keys: list[str], order: list[str], values: dict[str, str], bucket: Column, back: bool = True
) -> DataFrame:
    """``shifted`` for rows that ``spread`` has marked; the marks stay, so a second shift needs no further shuffle."""
    lot = [*keys, "_hot", "_bucket"]
    move, edge = (F.lag, F.max_by) if back else (F.lead, F.min_by)
    carried = F.struct(*[F.col(src).alias(new) for new, src in values.items()])
    inside = Window.partitionBy(*lot).orderBy(*order)
    across = Window.partitionBy(*keys, "_hot").orderBy("_bucket")
    near = move(carried).over(inside)
    if not back:  # rows without a bucket are not followed by those of a bucket
        near = F.when(bucket.isNotNull() | F.lead(bucket).over(inside).isNull(), near)
    ends = df.filter("_hot").groupBy(*lot).agg(edge(carried, F.struct(*order)).alias("_edge"))
    edges = ends.withColumn("_carry", move("_edge").over(across)).drop("_edge")
    joined = df.withColumn("_near", near).join(edges, lot, "left").withColumn("_pick", F.coalesce("_near", "_carry"))
    return joined.select(*df.columns, *[F.col(f"_pick.{new}").alias(new) for new in values])


def carried_forward(df: DataFrame, keys: list[str], order: list[str], value: str, bucket: Column, out: str) -> DataFrame:
    """Last non-null ``value`` at or before each row, per key, split over buckets like ``shifted``."""
    df = df.withColumn("_bucket", bucket)
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    across = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    position = F.struct(*[F.col(c) for c in order])
    ends = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*keys, "_bucket")
        .agg(F.max_by(value, position).alias("_end"))
    )
    buckets = df.select(*keys, "_bucket").distinct().join(ends, [*keys, "_bucket"], "left")
    carry = buckets.select(*keys, "_bucket", F.last("_end", ignorenulls=True).over(across).alias("_carry"))
    return (
        df.withColumn("_near", F.last(value, ignorenulls=True).over(inside))
        .join(carry, [*keys, "_bucket"], "left")
        .withColumn(out, F.coalesce("_near", "_carry"))
        .drop("_near", "_carry", "_bucket")
    )


def key_counts(df: DataFrame, keys: list[str], out: str = "key_rows") -> DataFrame:
    """``df`` with the number of rows sharing its key, by pre-aggregation and a join (not a window,
    which would send all rows of a hot key to one task)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    return df.join(counts, keys, "left")


def change_ratio(current: Column, previous: Column) -> Column:
    """(current - previous) / previous, null where there is nothing to compare with."""
    return F.when(previous > 0, (current - previous).cast("double") / previous.cast("double"))


def rolling_mean(df: DataFrame, keys: list[str], order: str, measure: str, out: str, rows: int = 7) -> DataFrame:
    """Mean over this row and the ``rows - 1`` before it (one row per key and day expected)."""
    window = Window.partitionBy(*keys).orderBy(order).rowsBetween(-(rows - 1), 0)
    total, count = F.sum(measure).over(window), F.count(measure).over(window)
    return df.withColumn(out, total.cast("double") / count.cast("double"))


def rolling_mean_days(df: DataFrame, keys: list[str], day: str, measure: str, out: str, days: int = 7) -> DataFrame:
    """Calendar form of ``rolling_mean``: missing days shrink the frame instead of widening it."""
    number = F.datediff(F.col(day), F.lit("1970-01-01"))
    window = Window.partitionBy(*keys).orderBy(number).rangeBetween(-(days - 1), 0)
    total, count = F.sum(measure).over(window), F.count(measure).over(window)
    return df.withColumn(out, total.cast("double") / count.cast("double"))
