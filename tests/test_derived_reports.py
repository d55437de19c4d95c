"""How derived reports are grouped, and that calls cut from one text are the calls built one by one."""

import json

import pytest
from pyspark.sql import functions as F

from workload import derived


def test_reports_are_grouped_from_sorted_rows(spark, tmp_path):
    """No hash map of event JSON, which would be sorted and spilled as a whole; one shuffle of plain events feeds the grouping."""
    rows = [(i, i % 3 + 1, "click", '{"k": %d}' % i) for i in range(30)]
    spark.createDataFrame(rows, "event_id long, user_id long, event_type string, props string").write.parquet(f"{tmp_path}/events.parquet")
    reports = derived.event_reports(spark, str(tmp_path))
    plan = reports._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" in plan and "ObjectHashAggregate" not in plan
    assert plan.count("Exchange") == 1
    for row in reports.collect():
        assert len(json.loads(row.raw)["behavior"]["processes"]) == 10


@pytest.mark.parametrize("k", [0, 1, 24, 28, 99, 100, 699, 12345])
def test_calls_cut_from_one_text_equal_calls_built_one_by_one(spark, k):
    row = spark.range(1).select(F.lit(k).alias("k")).select(
        derived._calls(F.col("k")).alias("cut"), derived._calls_one_by_one(F.col("k")).alias("built")).first()
    assert row.cut == row.built
