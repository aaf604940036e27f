"""Rounds of the rate fit read little, so they must not have a task for every shuffle partition."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from worklode.llm import source_mix


@pytest.fixture
def many_partitions(spark):
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_rounds_have_as_many_tasks_as_the_counts_ask_for(spark, many_partitions, monkeypatch):
    parts = F.array(F.pmod("id", F.lit(1001)), F.lit(1000) - F.pmod("id", F.lit(1001)))
    df = spark.range(5000).select((F.col("id") % 7).alias("n_tokens"), parts.cast("array<bigint>").alias("parts"))
    sc = spark.sparkContext

    def tasks_and_rounds(share):
        monkeypatch.setattr(source_mix, "SHARE", share, raising=False)
        group = f"rounds-{share}"
        sc.setJobGroup(group, group)
        rates = source_mix.fit_rates(df, [0.2, 0.5])
        tracker = sc.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
        sc.setJobGroup("", "")
        return sum(i.numCompletedTasks for s in stages if (i := tracker.getStageInfo(s))), rates

    few, rates = tasks_and_rounds(50_000)
    assert few < 4 * 40 + 3 * len(rates.totals)
    more, same = tasks_and_rounds(100)  # 1,001 rows: the tasks still grow with the counts
    assert more > few + 8 * len(same.totals)
    assert len(rates.totals) == len(same.totals) and np.allclose(rates.totals, same.totals, atol=1e-12)
