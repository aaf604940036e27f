"""Surrogate keys that are dense, ordered and stable, without a single-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from worklode.session import write_table


def dense_ids(df: DataFrame, order: list[str], id_col: str, start: int | Column = 0) -> DataFrame:
    """Number rows ``start + 1, start + 2, ...`` in the order of ``order`` (which must be unique).

    Rows are range-partitioned and sorted, each range is numbered on its own as it is written, and a running
    total over one row per range supplies the offsets.  The ranged rows are written once, because range boundaries
    come from a sample and must be the same for counting and for numbering; nothing is shuffled after that.
    """
    ordered = [F.col(c).asc_nulls_first() for c in order]
    place = F.monotonically_increasing_id()  # number of the partition, and below it the place in it
    ranged = write_table(df.repartitionByRange(*ordered).sortWithinPartitions(*ordered).withColumn("_place", place))
    ranged = ranged.withColumns({"_range": F.shiftright("_place", 33), "_row": F.col("_place").bitwiseAND(F.lit((1 << 33) - 1)) + 1})
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: the only thing a single task sees is the list of range sizes.
    offsets = sizes.select("_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    numbered = ranged.join(F.broadcast(offsets), "_range")
    first = start if isinstance(start, Column) else F.lit(start)
    return numbered.withColumn(id_col, (first + F.col("_offset") + F.col("_row")).cast("bigint")).drop(
        "_place", "_range", "_row", "_offset"
    )


def extend_keys(existing: DataFrame, incoming: DataFrame, natural: list[str], id_col: str) -> DataFrame:
    """``incoming`` with keys: known natural keys keep their id, new ones are numbered after the largest.

    ``existing`` holds ``natural`` + ``id_col``; ``incoming`` must be unique on ``natural``.
    """
    known = existing.select(*natural, id_col, F.lit(True).alias("_known"))
    # Written once, as rows with and without a key go on from it.
    keyed = write_table(incoming.join(known, natural, "left"))
    fresh = keyed.filter("_known is null").drop("_known", id_col)
    top = F.coalesce(known.select(F.max(id_col)).scalar(), F.lit(0))
    return keyed.filter("_known").drop("_known").unionByName(dense_ids(fresh, natural, id_col, top))
