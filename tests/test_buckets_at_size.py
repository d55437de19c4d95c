"""Reports stored bucketed: one file per bucket."""

import glob

from triagelake.plans.job import ingest_reports_bucketed


def test_each_bucket_of_reports_is_one_file(spark):
    reports = spark.range(200).selectExpr("string(id) AS task_id", "'{}' AS raw").repartition(6)
    table = ingest_reports_bucketed(reports, "reports_one_file", 4)
    assert table.count() == 200
    assert len(glob.glob(spark.conf.get("spark.sql.warehouse.dir").removeprefix("file:") + "/reports_one_file/part-*")) == 4
