"""Versioned bundles: export, manifests, digests, validation and reload."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from worklode.operators.aggregates import count_where
from worklode.operators.upsert import upsert

# Compressed files cannot be split anyway, so reading records that span lines costs nothing.
CSV = {"header": "true", "nullValue": "\\N", "escape": '"', "multiLine": "true",
       "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
       "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def bundle_version(as_of: str, patch: int = 0) -> str:
    """``YYYY.WW.PATCH`` from the ISO year and week of a day."""
    year, week, _ = dt.date.fromisoformat(as_of).isocalendar()
    return f"{year}.{week:02d}.{patch}"


def row_number_hash(columns: list[str]) -> Column:
    """60 bits of the row's MD5 as a number; null and '' differ, and fields cannot shift."""
    cells = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("~")) for c in columns]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *cells)), 1, 15), 16, 10).cast("decimal(38,0)")


def digest_columns(columns: list[str]) -> list[Column]:
    """Row count and order-free checksums (sum and xor of row hashes) as aggregate expressions."""
    h = row_number_hash(columns)
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.coalesce(F.sum(h).cast("string"), F.lit("0")).alias("hash_sum"),
        F.coalesce(F.bit_xor(h.cast("bigint")).cast("string"), F.lit("0")).alias("hash_xor"),
    ]


def digest(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row: the digest of a table, from one aggregate."""
    return df.agg(*digest_columns(columns or df.columns))


def export_csv(df: DataFrame, path: str, order: list[str]) -> DataFrame:
    """Write gzip CSV sorted over all files: ranges of the key, each sorted.  Returns the read-back."""
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode("errorifexists").options(compression="gzip", **CSV).csv(path)
    return read_csv(df.sparkSession, path, df.schema)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).options(**CSV).csv(path)


def export_bundle(
    tables: dict[str, DataFrame], order: dict[str, list[str]], root: str, date_columns: dict[str, str] | None = None, since: int | None = None
) -> DataFrame:
    """Export tables, in full or (with ``since``) only facts newer than a date key; dimensions always in
    full.  Returns the manifest: one row per table with path, rows and digest of what was written."""
    rows = []
    for name, df in tables.items():
        column = (date_columns or {}).get(name)
        if since is not None and column:
            df = df.filter(F.col(column) > since)
        back = export_csv(df, f"{root}/{name}", order[name])
        rows.append(digest(back).select(F.lit(name).alias("table_name"), F.lit(f"{root}/{name}").alias("path"), "*"))
    return reduce(lambda a, b: a.unionByName(b), rows)


def manifest(tables: dict[str, DataFrame], date_columns: dict[str, str], as_of: str, patch: int = 0) -> DataFrame:
    """Per table: rows, digest, first and last date key, and the bundle version."""
    def one(name: str, df: DataFrame) -> DataFrame:
        day = date_columns.get(name)
        ends = (F.min(day), F.max(day)) if day else (F.lit(None).cast("int"),) * 2
        period = [ends[0].cast("int").alias("first_date_sk"), ends[1].cast("int").alias("last_date_sk")]
        return df.agg(*digest_columns(df.columns), *period).select(F.lit(name).alias("table_name"), "*")

    rows = reduce(lambda a, b: a.unionByName(b), [one(n, d) for n, d in tables.items()])
    return rows.withColumn("bundle_version", F.lit(bundle_version(as_of, patch)))


def data_period(listed: DataFrame) -> DataFrame:
    """First and last date over all fact tables of a manifest."""
    return listed.agg(F.min("first_date_sk").alias("period_start"), F.max("last_date_sk").alias("period_end"),
                      F.sum("row_count").alias("total_rows"), F.max("bundle_version").alias("bundle_version"))


def schema_manifest(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per column: position, type, nulls and distinct values, from one aggregate per table."""
    def one(name: str, df: DataFrame) -> DataFrame:
        stats = [F.struct(F.lit(f.name).alias("column_name"), F.lit(i).alias("position"), F.lit(f.dataType.simpleString()).alias("data_type"),
                          count_where(F.col(f.name).isNull()).alias("nulls")) for i, f in enumerate(df.schema)]
        row = df.agg(F.count(F.lit(1)).alias("row_count"), F.array(*stats).alias("_s"))
        return row.select(F.lit(name).alias("table_name"), "row_count", F.explode("_s").alias("_c")).select("table_name", "row_count", "_c.*")

    return reduce(lambda a, b: a.unionByName(b), [one(n, d) for n, d in tables.items()])


def register_snapshot(registry: DataFrame, listed: DataFrame, as_of: str) -> DataFrame:
    """Snapshot registry with the tables of a manifest added; a version registered before is replaced."""
    fresh = listed.select("table_name", "bundle_version", "row_count", "hash_sum", F.lit(as_of).alias("registered_on"))
    return upsert(registry, fresh, ["table_name", "bundle_version"])


def validate_bundle(spark: SparkSession, listed: DataFrame, schemas: dict[str, T.StructType], root: str) -> DataFrame:
    """Read every table of a bundle back and compare rows and digest with the manifest; a table without files is MISSING."""
    def one(name: str, schema: T.StructType) -> DataFrame | None:
        try:
            read = digest(read_csv(spark, f"{root}/{name}", schema))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return read.select(F.lit(name).alias("table_name"), F.col("row_count").alias("_rows"), F.col("hash_sum").alias("_sum"), F.col("hash_xor").alias("_xor"))

    parts = [p for name, schema in schemas.items() if (p := one(name, schema)) is not None]
    none = spark.createDataFrame([], "table_name string, _rows long, _sum string, _xor string")
    found = reduce(lambda a, b: a.unionByName(b), parts) if parts else none
    joined = listed.join(found, "table_name", "full")
    issue = (
        F.when(F.col("row_count").isNull(), "NOT_IN_MANIFEST").when(F.col("_rows").isNull(), "MISSING")
        .when(F.col("row_count") != F.col("_rows"), "ROW_COUNT")
        .when((F.col("hash_sum") != F.col("_sum")) | (F.col("hash_xor") != F.col("_xor")), "CHECKSUM").otherwise("OK")
    )
    return joined.select("table_name", F.col("row_count").alias("expected_rows"), F.col("_rows").alias("found_rows"), issue.alias("result"))


def load_dimension(target: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    return upsert(target, incoming, keys)


def load_fact(target: DataFrame, incoming: DataFrame, date_column: str) -> DataFrame:
    """Append only rows newer than the newest already loaded."""
    newest = F.coalesce(target.select(F.max(date_column)).scalar(), F.lit(0))
    return target.unionByName(incoming.filter(F.col(date_column) > newest))


def reconcile_load(source: DataFrame, before: DataFrame, after: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Result row of an upsert: rows offered, inserted, updated, rows now held, and a status."""
    def n(df: DataFrame, out: str) -> DataFrame:
        return df.agg(F.count(F.lit(1)).alias(out))

    known = before.select(*keys)
    matched = source.join(known, keys, "left_semi")
    held = after.join(source.select(*keys), keys, "left_semi")
    row = n(source, "source_rows").select(
        F.lit(name).alias("table_name"), "source_rows", n(matched, "n").scalar().alias("updated_rows"),
        n(before, "n").scalar().alias("rows_before"), n(after, "n").scalar().alias("rows_after"), n(held, "n").scalar().alias("source_rows_held"),
    )
    inserted = F.col("source_rows") - F.col("updated_rows")
    good = (F.col("source_rows_held") == F.col("source_rows")) & (F.col("rows_after") == F.col("rows_before") + inserted)
    return row.withColumn("inserted_rows", inserted).withColumn("status", F.when(good, "SUCCESS").otherwise("MISMATCH"))


def load_order_violations(order: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges (parent, child) whose parent is not loaded before its child.  ``order``: table_name, position."""
    parent = order.select(F.col("table_name").alias("parent"), F.col("position").alias("parent_position"))
    child = order.select(F.col("table_name").alias("child"), F.col("position").alias("child_position"))
    placed = edges.join(parent, "parent", "left").join(child, "child", "left")
    wrong = F.col("parent_position").isNull() | F.col("child_position").isNull() | (F.col("parent_position") >= F.col("child_position"))
    return placed.filter(wrong)


def align_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Columns of the target in its order and types: missing ones become null, extra ones stay at the end."""
    have = set(df.columns)
    wanted = [(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target]
    return df.select(*wanted, *[c for c in df.columns if c not in target.names])


def schema_drift(df: DataFrame, expected: T.StructType) -> DataFrame:
    """One row per column that differs, with the table's row count; an empty table never breaks."""
    have, want = {f.name: f for f in df.schema}, {f.name: f for f in expected}
    found = []
    for name in sorted({*have, *want}):
        if name not in want:
            found.append((name, "ADDED", False))
        elif name not in have:
            found.append((name, "REMOVED", True))
        elif have[name].dataType != want[name].dataType:
            found.append((name, "TYPE_CHANGED", True))
    rows = F.array(*[F.struct(F.lit(n).alias("column_name"), F.lit(k).alias("drift"), F.lit(b).alias("breaking")) for n, k, b in found])
    counts = df.agg(F.count(F.lit(1)).alias("row_count"))
    if not found:
        return counts.limit(0).select(F.lit("").alias("column_name"), F.lit("").alias("drift"), F.lit(False).alias("breaking"), "row_count")
    listed = counts.select("row_count", F.explode(rows).alias("_d")).select("_d.*", "row_count")
    return listed.withColumn("breaking", F.col("breaking") & (F.col("row_count") > 0))


def dimension_delta(dim: DataFrame, modified: str, last_published: str) -> DataFrame:
    """Rows changed since the last publication."""
    return dim.filter(F.col(modified) > F.lit(last_published).cast("timestamp"))


def file_hashes(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """SHA-256 and MD5 of every file below a folder, hashed where the files are read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("sha256"), F.md5("content").alias("md5"),
    )


