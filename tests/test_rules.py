"""The rule runner on literal rows, and the number of scans in its plan."""

import datetime as dt
import re

import pytest

from worklode.operators import quality
from worklode.operators.quality import Rule

AS_OF = "2024-01-10"


def rule(name, table, kind, **spec):
    return Rule(name, "c", "ERROR", table, kind, spec)


RULES = [
    rule("w", "jobs", "where", bad="price < 0"),
    rule("w2", "jobs", "where", bad="price > 100"),
    rule("u", "jobs", "unique", keys=["job", "src"]),
    rule("o", "jobs", "orphan", parent="firms", on={"firm": "id"}),
    rule("ow", "jobs", "orphan", parent="firms", on={"firm": "id"}, where="price > 0"),
    rule("o2", "firms", "orphan", parent="jobs", on={"id": "firm", "src": "src"}),
    rule("used", "firms", "used", bad="not active", child="jobs", child_key="firm", key="id"),
    rule("f", "jobs", "fresh", at="seen", hours=24),
    rule("fp", "jobs", "fresh", at="seen", hours=24, per="src"),
]


def day(n):
    return dt.datetime(2024, 1, n)


@pytest.fixture
def tables(spark, tmp_path):
    jobs = [(1, "a", 10, -1, day(9)), (1, "a", 10, 5, day(1)), (2, None, 11, 200, day(2)), (2, None, 12, None, None),
            (3, "b", None, 7, day(10)), (4, "b", 12, 3, day(3)), (5, "c", 10, 1, None)]
    firms = [(10, "a", False), (10, "x", False), (13, "b", False), (11, None, True), (None, "a", False)]
    made = {
        "jobs": spark.createDataFrame(jobs, "job long, src string, firm int, price int, seen timestamp"),
        "firms": spark.createDataFrame(firms, "id int, src string, active boolean").selectExpr("cast(id as decimal(12,2)) as id", "src", "active", "1 as rule_name"),
    }
    for name, df in made.items():
        df.write.parquet(f"{tmp_path}/{name}")
    return {name: spark.read.parquet(f"{tmp_path}/{name}") for name in made}


def test_kinds(tables):
    got = {r.rule_name: r.failed_records for r in quality.run_rules(tables, RULES, AS_OF).collect()}
    # o: firms 12 twice; o2: (10, x) and (13, b) have no job, null keys are not compared; fp: null source and c are old.
    assert got == {"w": 1, "w2": 1, "u": 1, "o": 2, "ow": 1, "o2": 2, "used": 2, "f": 0, "fp": 2}


def test_empty_tables(tables):
    empty = {name: df.limit(0) for name, df in tables.items()}
    got = {r.rule_name: r.failed_records for r in quality.run_rules(empty, RULES, AS_OF).collect()}
    assert got == {r.name: int(r.name == "f") for r in RULES}


def test_every_table_is_read_once(tables):
    plan = quality.run_rules(tables, RULES, AS_OF)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan parquet", plan)) == len(tables)
    assert "Join" not in plan
