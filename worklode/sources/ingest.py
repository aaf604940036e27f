"""Landed records to raw snapshots: validation, wrapping, logging and replay."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from worklode.functions.dates import date_key


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a declared schema; a line that does not parse keeps its text in ``_bad``."""
    return spark.read.schema(f"{schema}, _bad string").option("columnNameOfCorruptRecord", "_bad").json(path)


def split_valid(records: DataFrame, required: list[str], rules: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): rejected rows name their first broken rule instead of being dropped."""
    reason = F.lit(None).cast("string")
    for name, broken in reversed(list((rules or {}).items())):
        reason = F.when(F.coalesce(broken, F.lit(False)), name).otherwise(reason)
    missing = reduce(lambda a, b: a | b, [F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) == "" for c in required])
    reason = F.when(missing, "MISSING_REQUIRED_FIELD").otherwise(reason)
    if "_bad" in records.columns:
        reason = F.when(F.col("_bad").isNotNull(), "NOT_JSON").otherwise(reason)
    marked = records.withColumn("reject_reason", reason)
    return marked.filter("reject_reason is null").drop("reject_reason"), marked.filter("reject_reason is not null")


def snapshots(records: DataFrame, key: list[str], payload: list[str], source: str, batch_id: str, at: str) -> DataFrame:
    """Raw snapshot rows: key, source, batch, canonical JSON payload (columns in name order) and its hash."""
    body = F.to_json(F.struct(*[F.col(c) for c in sorted(payload)]), {"ignoreNullFields": "false"})
    rows = records.withColumn("payload_json", body)
    return rows.select(
        F.concat_ws(":", *[F.col(c).cast("string") for c in key]).alias("snapshot_id"), F.col(source).alias("source_name"),
        F.lit(batch_id).alias("batch_id"), "payload_json", F.sha2("payload_json", 256).alias("payload_hash"),
        F.lit(at).cast("timestamp").alias("ingestion_timestamp"), date_key(F.lit(at).cast("date")).alias("ingestion_date_sk"),
    )


def payload_columns(snapshots_df: DataFrame, schema: str) -> DataFrame:
    """Snapshot rows with the payload parsed by a declared schema."""
    return snapshots_df.withColumn("payload", F.from_json("payload_json", schema))


def standardize(parsed: DataFrame, mapping: dict[str, Column]) -> DataFrame:
    """One target schema from source-specific payload fields: {target column: expression}."""
    return parsed.select("snapshot_id", "source_name", "batch_id", *[expr.alias(name) for name, expr in mapping.items()])


def response_log(spark: SparkSession, entries: list[dict]) -> DataFrame:
    """API response log rows (one per call, built by the caller) with a stable id."""
    schema = "source_name string, batch_id string, url string, status_code int, record_count int, called_at timestamp"
    rows = spark.createDataFrame(entries, schema)
    return rows.withColumn("log_id", F.md5(F.concat_ws("|", "source_name", "batch_id", "url", F.col("called_at").cast("string"))))


def replay(log: DataFrame, start: str, end: str, at: str, payload: str, key: str, schema: str, replay_id: str) -> DataFrame:
    """Logged responses of a time range, parsed again and tagged as a replay.  End is exclusive."""
    ranged = log.filter((F.col(at) >= F.lit(start).cast("timestamp")) & (F.col(at) < F.lit(end).cast("timestamp")))
    parsed = ranged.withColumn("_p", F.from_json(payload, schema))
    return parsed.filter(F.col("_p").isNotNull()).select(
        F.col(key), F.lit(replay_id).alias("replay_id"), F.lit(True).alias("is_replay"), F.col(at).alias("original_at"), "_p.*"
    )


def replay_files(spark: SparkSession, path: str, schema: str, replay_id: str) -> DataFrame:
    """The file form: landed JSON files read again and tagged."""
    rows = spark.read.schema(schema).json(path)
    return rows.withColumns({"replay_id": F.lit(replay_id), "is_replay": F.lit(True), "source_file": F.input_file_name()})
