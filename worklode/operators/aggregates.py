"""Aggregations shared by the marts, checks and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_where(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def distinct_where(condition: Column, value: str) -> Column:
    return F.countDistinct(F.when(condition, F.col(value)))


def exact_mean(value: str, digits: int = 2) -> Column:
    """Mean whose sum is exact (decimal), so the result does not depend on the order of addition."""
    total = F.sum(F.col(value).cast(f"decimal(18,{digits})")).cast("double")
    return total / F.count(value).cast("double")


def exact_sum(value: str, digits: int = 2) -> Column:
    return F.sum(F.col(value).cast(f"decimal(18,{digits})")).cast("double")


def guarded_ratio(part: Column, whole: Column) -> Column:
    """part / whole as double, null when the whole is zero or missing."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def duplicate_stats(df: DataFrame, keys: list[str], order: list[str], first: dict[str, str], seen: str) -> DataFrame:
    """Per key: number of rows, attributes of the first row, first and last time seen, duplicate flag."""
    position = F.struct(*[F.col(c) for c in order])
    carried = [F.min_by(src, position).alias(new) for new, src in first.items()]
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("occurrences"),
        *carried,
        F.min(seen).alias("first_seen"),
        F.max(seen).alias("last_seen"),
        (F.count(F.lit(1)) > 1).alias("is_duplicate"),
    )


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (null keys are not compared)."""
    present = df.dropna(subset=keys)
    return present.groupBy(*keys).agg(F.count(F.lit(1)).alias("key_rows")).filter(F.col("key_rows") > 1)


def null_counts(df: DataFrame, columns: list[str], table: str) -> DataFrame:
    """One row per column with its number of nulls, from one aggregate over one scan."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_n_{c}") for c in columns]
    )
    items = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_n_{c}").alias("nulls")) for c in columns]))
    return counts.select(F.lit(table).alias("table_name"), F.col("_rows").alias("total_rows"), items.alias("_c")).select(
        "table_name", "total_rows", "_c.*"
    )


def unpivot_counts(row: DataFrame, names: list[str], label: str = "check_name", value: str = "issue_count") -> DataFrame:
    """Turn a one-row frame of counts into (label, value) rows."""
    pairs = F.explode(F.array(*[F.struct(F.lit(n).alias(label), F.col(n).cast("bigint").alias(value)) for n in names]))
    return row.select(pairs.alias("_p")).select("_p.*")


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Every distinct value per key with its row count, in long form, so that no list has to be cut."""
    return df.dropna(subset=[value]).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("rows_with_value"))


def share_of_total(df: DataFrame, keys: list[str], out: str = "share") -> DataFrame:
    """Count per key and its share of all rows."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    total = df.select(F.count(F.lit(1))).scalar()
    return counts.withColumn(out, F.col("row_count").cast("double") / total.cast("double"))
