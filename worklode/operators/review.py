"""Review queues: listing, resolving, dismissing and summarizing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.operators.aggregates import count_where
from worklode.operators.upsert import update_where


def pending(queue: DataFrame, entity: str | None = None, below: float | None = None, limit: int = 50) -> DataFrame:
    """The weakest open items, for a reviewer's page."""
    found = queue.filter(F.col("status") == "pending")
    if entity is not None:
        found = found.filter(F.col("entity_type") == entity)
    if below is not None:
        found = found.filter(F.col("confidence") < below)
    return found.orderBy("confidence", "review_id").limit(limit)


def close(queue: DataFrame, ids: DataFrame, outcome: str) -> DataFrame:
    """Set the listed open items to 'resolved' or 'dismissed'."""
    if outcome not in ("resolved", "dismissed"):
        raise ValueError(outcome)
    hit = ids.select("review_id").distinct().withColumn("_hit", F.lit(True))
    joined = queue.join(hit, "review_id", "left")
    return update_where(joined, F.col("_hit") & (F.col("status") == "pending"), {"status": F.lit(outcome)}).drop("_hit")


def summary(queue: DataFrame) -> DataFrame:
    """Items by issue type and state."""
    return queue.groupBy("issue_type").agg(
        F.count(F.lit(1)).alias("items"),
        *[count_where(F.col("status") == s).alias(s) for s in ("pending", "rejected", "resolved")],
        F.round(F.min("confidence"), 6).alias("lowest"),
    )


def confidence_band(confidence: str, threshold: float) -> Column:
    """Band shown to reviewers."""
    c = F.col(confidence)
    return F.when(c.isNull(), "NO_MATCH").when(c >= threshold, "ACCEPTED").when(c >= 0.5, "MEDIUM").otherwise("LOW")
