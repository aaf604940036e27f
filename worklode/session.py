"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "worklode", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, skew-join splitting and a UTC clock."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session (tests, benches) may fall back to a temporary folder: on a cluster a
    machine-local folder would be lost with its executor, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    named = named or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="worklode-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the written copy."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table of its own in the shared folder and go on from there.

    Unlike a checkpoint it is computed once, has a size that the optimizer knows, and may be used several times in a plan.
    """
    path = f"{shared_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
