"""The star schema from end to end: inferred members, job versions, the skill bridge and the posting fact.

Each build takes the state before it and a load, and returns the state after it.  The same load again changes nothing:
keys belong to versions and pairs, not to runs.  Pass states that were written as tables, or that a build here returned: a build
reads them several times.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from worklode.functions.dates import date_key
from worklode.operators.joins import UNKNOWN_KEY, resolve_keys
from worklode.operators.keys import dense_ids, extend_keys
from worklode.operators.ranking import best_per_key
from worklode.operators.scd2 import apply_history
from worklode.session import write_table


def infer_members(dimension: DataFrame, natural: str, sk: str, facts: DataFrame) -> DataFrame:
    """Members that facts name and the dimension lacks, added with keys of their own.

    They are marked ``is_inferred``, and their other columns are null until ``fill_members`` brings them.
    """
    named = facts.select(natural).filter(F.col(natural).isNotNull()).distinct()
    missing = named.join(dimension.select(natural), natural, "left_anti")
    top = F.coalesce(dimension.select(F.max(sk)).scalar(), F.lit(0))
    added = dense_ids(missing, [natural], sk, top).withColumn("is_inferred", F.lit(True))
    return dimension.unionByName(added, allowMissingColumns=True)


def fill_members(dimension: DataFrame, natural: str, sk: str, records: DataFrame) -> DataFrame:
    """The dimension after a load of whole records, unique by ``natural``: known members keep their key, inferred ones are filled."""
    top = F.coalesce(dimension.select(F.max(sk)).scalar(), F.lit(0))
    keyed = records.join(dimension.select(natural, sk), natural, "left").withColumn("is_inferred", F.lit(False))
    fresh = dense_ids(keyed.filter(F.col(sk).isNull()).drop(sk), [natural], sk, top)
    kept = dimension.join(records.select(natural), natural, "left_anti")
    return kept.unionByName(keyed.filter(F.col(sk).isNotNull())).unionByName(fresh)


def job_dimension(existing: DataFrame, jobs: DataFrame, attributes: list[str], bucket: Column) -> DataFrame:
    """Versions of jobs after a load.

    ``existing``: job_sk, job_id, ``attributes``, record_hash, effective_from, effective_to, is_current; ``jobs``: one row per
    job_id with ``attributes``, record_hash and updated_at.  A changed hash closes the version of its time and opens another
    one; a late row gets its place between the versions there are, unless the version that follows says the same: that one
    keeps its start and with it its key.  Versions keep ``job_sk``; new ones are numbered after the largest.
    """
    versions = existing.select("job_id", F.col("record_hash").alias("_h"), F.col("effective_from").alias("_from"))
    later = F.when(F.col("_from") >= F.col("updated_at"), F.col("_from"))
    following = jobs.select("job_id", "updated_at").join(versions, "job_id").groupBy("job_id").agg(F.min_by("_h", later).alias("_next"))
    news = jobs.join(following, "job_id", "left").filter(~F.col("record_hash").eqNullSafe(F.col("_next")) | F.col("_next").isNull())
    changes = write_table(news.select("job_id", *attributes, F.lit(None).cast("bigint").alias("job_sk"), "record_hash", "updated_at"))
    if changes.isEmpty():  # a load given again: the history has no reason to move
        return existing
    line = write_table(apply_history(existing, changes, "job_id", [*attributes, "job_sk"], "record_hash", "updated_at", bucket))
    top = existing.agg(F.coalesce(F.max("job_sk"), F.lit(0))).first()[0]
    fresh = line.filter(F.col("job_sk").isNull()).drop("job_sk")
    return line.filter(F.col("job_sk").isNotNull()).unionByName(dense_ids(fresh, ["job_id", "effective_from", "record_hash"], "job_sk", top))


def skill_bridge(bridge: DataFrame, evidence: DataFrame, jobs: DataFrame, skills: DataFrame) -> DataFrame:
    """Pairs of job version and skill after a load of evidence.

    ``evidence``: job_id, skill_name, confidence, evidence_type, source_priority; ``jobs``: the job dimension; ``skills``: skill_sk,
    skill_name, matched without case and outer blanks.  The best evidence of a pair counts: the highest confidence, then the
    lowest priority number, then the type.  Pairs of closed versions end with them.  An open pair keeps its key and takes the new evidence.
    """
    columns = ["bridge_sk", "job_sk", "skill_sk", "confidence", "evidence_type", "source_priority", "effective_from", "effective_to", "is_current"]
    ends = jobs.select("job_sk", F.col("effective_to").alias("_end"), F.col("is_current").alias("_open"))
    shut = F.col("is_current") & ~F.coalesce(F.col("_open"), F.lit(True))
    state = bridge.join(ends, "job_sk", "left").withColumns(
        {"effective_to": F.when(shut, F.col("_end")).otherwise(F.col("effective_to")), "is_current": F.col("is_current") & ~shut}
    )
    names = skills.groupBy(F.lower(F.trim("skill_name")).alias("_name")).agg(F.min("skill_sk").alias("skill_sk"))
    current = jobs.filter("is_current").select("job_id", "job_sk", "effective_from")
    told = evidence.withColumn("_name", F.lower(F.trim("skill_name"))).join(names, "_name").join(current, "job_id")
    rest = ["evidence_type", "confidence", "source_priority", "effective_from"]
    rank = F.struct((-F.col("confidence")).alias("c"), F.col("source_priority").alias("p"), F.col("evidence_type").alias("t"))
    # A version belongs to one job: with job_id in the key the rows stay where the join by job_id has put them.
    best = told.groupBy("job_id", "job_sk", "skill_sk").agg(F.min_by(F.struct(*rest), rank).alias("_b")).select("job_sk", "skill_sk", "_b.*")
    keyed = extend_keys(bridge, best, ["job_sk", "skill_sk"], "bridge_sk").withColumns(
        {"effective_to": F.lit(None).cast(bridge.schema["effective_to"].dataType), "is_current": F.lit(True)}
    )
    untouched = state.join(keyed.select("job_sk", "skill_sk"), ["job_sk", "skill_sk"], "left_anti")
    return untouched.select(*columns).unionByName(keyed.select(*columns))


def posting_fact(fact: DataFrame, jobs: DataFrame, changes: DataFrame, dimension: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per job version that was posted, after a load.

    ``jobs``: job_id, source_name, posted_at, is_active, soft_delete; ``changes``: job_id, change_type, changed_at, change_id.  Keys of
    company, place and sector are those of the job's open version; jobs without a version wait for a later load.  A version
    that has its row keeps it, with new activity flags only.
    """
    latest = best_per_key(changes, ["job_id"], [F.desc("changed_at"), F.desc("change_id")]).select("job_id", "change_type")
    kind = F.coalesce("change_type", F.lit("INSERT"))
    current = dimension.filter("is_current").select("job_id", "job_sk", "company_sk", "location_sk", "sector_sk")
    events = resolve_keys(jobs, [(sources, "source_name", "source_sk", "source_sk")]).join(current, "job_id").join(latest, "job_id", "left")
    rows = write_table(events.select(
        "job_sk", "company_sk", "location_sk", "sector_sk", "source_sk",
        F.coalesce(date_key(F.col("posted_at")), F.lit(UNKNOWN_KEY)).alias("posting_date_sk"), F.col("is_active").alias("active_flag"),
        (kind == "INSERT").alias("is_new_job"), (kind == "UPDATE").alias("is_update"),
        F.col("soft_delete").alias("is_soft_delete"), (kind == "RESTORE").alias("is_restore"),
    ))
    new_flags = rows.select("job_sk", F.struct("active_flag", "is_soft_delete").alias("_new"))
    updated = fact.join(new_flags, "job_sk", "left").withColumns(
        {c: F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(c)) for c in ("active_flag", "is_soft_delete")}
    )
    fresh = rows.join(fact.select("job_sk"), "job_sk", "left_anti")
    top = F.coalesce(fact.select(F.max("fact_sk")).scalar(), F.lit(0))
    return updated.drop("_new").unionByName(dense_ids(fresh, ["job_sk"], "fact_sk", top))
