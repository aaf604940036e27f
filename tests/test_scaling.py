"""Steps that must not grow faster than their input: shuffles, repeated work and the parts that tasks get."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from worklode.operators import classify, graph, keys, ranking, scd2
from worklode.plans import warehouse

HISTORY = "k long, a int, h string, effective_from timestamp, effective_to timestamp, is_current boolean"


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()



def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


def month(c):
    return F.date_trunc("month", c)


@pytest.mark.parametrize("back", [True, False])
def test_shift_of_hot_keys_equals_that_of_others(spark, monkeypatch, back):
    rnd = random.Random(3)
    rows = [(rnd.choice([1, 2, 3, None]), day(n) if n % 9 else None, n) for n in rnd.sample(range(400), 300)]
    df = spark.createDataFrame(rows, "k long, at timestamp, v long")

    def shift():
        got = ranking.shifted(df, ["k"], ["at", "v"], {"w": "v"}, month("at"), back)
        return sorted(map(str, got.collect()))

    whole = shift()
    monkeypatch.setattr(ranking, "HOT", 5)
    assert shift() == whole


def test_shift_sends_its_rows_once(spark):
    df = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").cast("timestamp").alias("at"), "id")
    got = ranking.shifted(df, ["k"], ["at"], {"w": "id"}, month("at"))
    assert len(got.collect()) == 1000
    # Once as rows and once as counts of the keys: no key is hot, so there are no edges to shuffle or join.
    final = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(") <= 2


@pytest.mark.parametrize("hot", [100_000, 2])
def test_history_with_gaps_hot_keys_and_keys_without_changes(spark, monkeypatch, hot):
    monkeypatch.setattr(ranking, "HOT", hot)
    old = [(1, 1, "x", day(0), day(5), False), (1, 2, "y", day(9), None, True), (2, 1, "x", day(0), day(40), False), (2, 1, "x", day(40), None, True),
           (None, 1, "x", day(0), None, True), (3, 1, "x", day(0), day(70), False)]
    new = [(1, 3, "x", day(6)), (1, 4, "y", day(80)), (3, 2, "x", day(75)), (4, 1, "z", day(1)), (4, 2, "z", day(2)), (None, 5, "q", day(3))]
    history, changes = spark.createDataFrame(old, HISTORY), spark.createDataFrame(new, "k long, a int, h string, at timestamp")
    got = scd2.apply_history(history, changes, "k", ["a"], "h", "at", month("effective_from")).collect()
    want = [(1, 1, "x", day(0), day(5), False), (1, 3, "x", day(6), day(9), False), (1, 2, "y", day(9), None, True),
            (2, 1, "x", day(0), day(40), False), (2, 1, "x", day(40), None, True), (3, 1, "x", day(0), day(70), False), (3, 2, "x", day(75), None, True),
            (4, 1, "z", day(1), None, True), (None, 1, "x", day(0), None, True), (None, 5, "q", day(3), None, True)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_numbering_shuffles_nothing_after_its_ranges_are_written(spark):
    made = keys.dense_ids(spark.range(1000).select((-F.col("id")).alias("a"), F.lit("x" * 50).alias("b")), ["a"], "n")
    assert [r.n for r in made.orderBy("a").collect()] == list(range(1, 1001))
    assert "hashpartitioning(_range" not in made.filter("b <> ''")._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]


def test_evidence_of_a_bridge_is_read_once(spark, monkeypatch):
    dim = spark.createDataFrame([(1, 1, day(0), None, True)], "job_id long, job_sk long, effective_from timestamp, effective_to timestamp, is_current boolean")
    seen = spark.sparkContext.accumulator(0)

    def told(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    evidence = spark.createDataFrame([(1, "a", 0.5, "R", 1), (1, "b", 0.5, "R", 1)], "job_id long, skill_name string, confidence double, evidence_type string, source_priority int")
    evidence = evidence.coalesce(1).mapInArrow(told, evidence.schema)
    skills = spark.createDataFrame([(1, "A"), (2, "B ")], "skill_sk int, skill_name string")
    empty = spark.createDataFrame([], "bridge_sk long, job_sk long, skill_sk int, confidence double, evidence_type string, source_priority int, effective_from timestamp, effective_to timestamp, is_current boolean")
    got = warehouse.skill_bridge(empty, evidence, dim, skills).collect()
    assert sorted((r.bridge_sk, r.skill_sk) for r in got) == [(1, 1), (2, 2)]
    assert seen.value == 2


def test_postings_of_a_load_are_read_once(spark):
    dim = spark.createDataFrame([(1, 7, 1, 1, 1, True)], "job_id long, job_sk long, company_sk long, location_sk int, sector_sk int, is_current boolean")
    seen = spark.sparkContext.accumulator(0)

    def read(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    jobs = spark.createDataFrame([(1, "s", day(0), True, False)], "job_id long, source_name string, posted_at timestamp, is_active boolean, soft_delete boolean")
    jobs = jobs.coalesce(1).mapInArrow(read, jobs.schema)
    changes = spark.createDataFrame([], "job_id long, change_type string, changed_at timestamp, change_id long")
    sources = spark.createDataFrame([("s", 3)], "source_name string, source_sk long")
    flags = "active_flag boolean, is_new_job boolean, is_update boolean, is_soft_delete boolean, is_restore boolean"
    fact = spark.createDataFrame([], f"job_sk long, company_sk long, location_sk int, sector_sk int, source_sk long, posting_date_sk int, {flags}, fact_sk long")
    got = warehouse.posting_fact(fact, jobs, changes, dim, sources).collect()
    assert [(r.fact_sk, r.job_sk, r.source_sk) for r in got] == [(1, 7, 3)]
    assert seen.value == 1


def test_facts_of_ontology_edges_are_dealt_into_more_parts(spark, monkeypatch):
    monkeypatch.setattr(graph, "PART_ROWS", 100)
    facts = spark.range(1000).select(F.col("id").alias("job_sk"), (F.col("id") % 3).alias("a"), (F.col("id") % 2).alias("b"))
    got = graph.typed_edges(facts, {"X": ("a", "b")})
    assert "RepartitionByExpression" in plan(got) and ", 11" in plan(got)
    assert sorted((r.source, r.target, r.job_count) for r in got.collect()) == sorted((str(a), str(b), sum(i % 3 == a and i % 2 == b for i in range(1000))) for a in range(3) for b in range(2))


def test_texts_are_searched_once_for_sectors(spark):
    jobs = spark.createDataFrame([(1, "Data BANK", "x"), (2, "x", "NURSE"), (3, None, "x"), (4, "x", None)], "id int, c string, t string")
    found = classify.assign_sector(jobs, "c", "t").filter("sector = 'unknown' or sector_confidence < 0.8")
    assert plan(found).lower().count("lower(") == 2
    assert sorted((r.id, r.sector, r.assignment_method) for r in found.collect()) == [(2, "healthcare", "title_keyword"), (3, "unknown", "no_match"), (4, "unknown", "no_match")]
