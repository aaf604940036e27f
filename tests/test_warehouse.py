"""Job versions over loads: late rows, unchanged rows and a load given twice."""

import datetime as dt

from pyspark.sql import functions as F

from worklode.plans import warehouse
from worklode.session import write_table


def day(n):
    return dt.datetime(2024, 1, n)


def load(spark, *rows):
    return spark.createDataFrame([(j, a, h, day(d)) for j, a, h, d in rows], "job_id long, a int, record_hash string, updated_at timestamp")


def test_job_versions(spark):
    nothing = spark.createDataFrame([], "job_id long, a int, job_sk long, record_hash string, effective_from timestamp, effective_to timestamp, is_current boolean")

    def step(state, jobs):
        made = write_table(warehouse.job_dimension(state, jobs, ["a"], F.date_trunc("month", "effective_from")))
        return made, sorted((r.job_id, r.effective_from.day, r.record_hash, r.job_sk, r.effective_to and r.effective_to.day) for r in made.collect())

    one, _ = step(nothing, load(spark, (1, 1, "x", 5), (2, 1, "x", 5), (3, 1, "x", 5), (4, 1, "x", 5)))
    # 1 changes, 2 is the same later, 3 is another one earlier, 4 the same earlier, 5 is new.
    second = load(spark, (1, 2, "y", 7), (2, 1, "x", 7), (3, 2, "y", 3), (4, 1, "x", 3), (5, 1, "z", 7))
    two, rows = step(one, second)
    assert rows == [(1, 5, "x", 1, 7), (1, 7, "y", 5, None), (2, 5, "x", 2, None), (3, 3, "y", 6, 5), (3, 5, "x", 3, None),
                    (4, 5, "x", 4, None), (5, 7, "z", 7, None)]
    assert step(two, second)[1] == rows


def test_inferred_members_are_filled_and_keep_their_key(spark):
    dim = spark.createDataFrame([("a", 1, 10, False)], "name string, sk long, pay int, is_inferred boolean")
    facts = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "name string")
    seen = write_table(warehouse.infer_members(dim, "name", "sk", facts))
    assert sorted(map(tuple, seen.select("name", "sk", "pay", "is_inferred").collect())) == [("a", 1, 10, False), ("b", 2, None, True)]
    filled = warehouse.fill_members(seen, "name", "sk", spark.createDataFrame([("b", 20), ("c", 30)], "name string, pay int"))
    got = sorted(map(tuple, filled.select("name", "sk", "pay", "is_inferred").collect()))
    assert got == [("a", 1, 10, False), ("b", 2, 20, False), ("c", 3, 30, False)]
