"""Report text moves as little as it can."""

from workload.derived import derived_reports


def test_report_text_is_not_shuffled(spark, tmp_path):
    events = [(i, i % 3 + 1, "click", '{"k": %d}' % i) for i in range(30)]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, props string").write.parquet(f"{tmp_path}/events.parquet")
    spark.createDataFrame([(7, "http://a.b/c", "<p>x</p>")], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    reports = derived_reports(spark, str(tmp_path))
    plan = reports._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and "raw" not in plan[plan.index("Exchange "):].split("\n")[0]
    assert sorted(r.task_id for r in reports.collect()) == ["p7", "u1_0", "u2_0", "u3_0"]
