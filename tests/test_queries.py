"""Every query against its expected result on the smallest data set."""

import glob
import os

import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shown = [tuple(round(row[i], 9) if isinstance(row[i], float) else row[i] for i in order) for row in rows]
    return sorted(columns), sorted(shown, key=repr)


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query(spark, duck, name):
    result = driver.queries()[name](spark, SF_DIR)
    rows = [tuple(row) for row in result.collect()]
    sql = driver.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    cursor = duck.execute(sql)
    expected = canonical([column[0] for column in cursor.description], cursor.fetchall())
    assert canonical(result.columns, rows) == expected


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_skewed_users_make_bounded_reports(spark, tmp_path):
    """A user with most events has many bounded reports, not one huge one."""
    from pyspark.sql import functions as F

    from workload.derived import BLOCK, event_reports

    events = spark.range(BLOCK * 2 + 10).select(
        F.col("id").alias("event_id"), F.lit(None).cast("timestamp").alias("ts"), F.lit(1).cast("long").alias("user_id"),
        F.lit("view").alias("event_type"), F.lit(1.0).alias("value"), F.lit('{"k": 3}').alias("props"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    reports = event_reports(spark, str(tmp_path))
    assert sorted(r.task_id for r in reports.select("task_id").collect()) == ["u1_0", "u1_1", "u1_2"]
