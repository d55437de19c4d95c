import datetime as dt
import json

from pyspark.sql import functions as F

from triagelake.operators.responses import pair_responses
from triagelake.streaming.pairing import pair_stream, stream_paired_assessments

TASKS = "task_id string, sent_at timestamp"
REPLIES = "task_id string, body string, transport_error string, received_at timestamp"


def at(seconds):
    return dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=seconds)


def ok(text):
    return json.dumps({"choices": [{"message": {"content": text}}]})


def drop(spark, folder, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def run(spark, folder, sink, progress):
    tasks = spark.readStream.schema(TASKS).option("maxFilesPerTrigger", 1).parquet(f"{folder}/tasks")
    replies = spark.readStream.schema(REPLIES).option("maxFilesPerTrigger", 1).parquet(f"{folder}/replies")
    query = (pair_stream(tasks, replies, reply_timeout_s=60).writeStream.format("parquet").option("checkpointLocation", progress)
             .trigger(availableNow=True).start(sink))
    query.awaitTermination(240)
    return query


def test_one_pairing_per_task_with_late_repeated_and_absent_replies(spark, tmp_path):
    folder, sink, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")
    drop(spark, folder, "tasks", [(t, at(0)) for t in ("t1", "t2", "t3", "t4")] + [(None, at(0))], TASKS)
    drop(spark, folder, "replies", [("t1", ok("first"), None, at(10)), ("t2", "<html>502</html>", None, at(5)),
                                    ("t2", ok("b"), None, at(20))], REPLIES)
    drop(spark, folder, "replies", [("t3", ok("too late"), None, at(70)), ("t2", ok("a"), None, at(30)),
                                    ("t5", ok("before its task"), None, at(100))], REPLIES)
    run(spark, folder, sink, progress)
    # A restart with the same progress folder: a repeated task, the task of the early reply, and a clock far ahead.
    drop(spark, folder, "tasks", [("t1", at(0)), ("t5", at(90))], TASKS)
    drop(spark, folder, "replies", [("clock", None, "timeout", at(1000))], REPLIES)
    run(spark, folder, sink, progress)
    run(spark, folder, sink, progress)
    found = spark.read.parquet(sink).collect()
    by_task = {r.task_id: r for r in found}
    assert len(found) == len(by_task) == 5
    assert (by_task["t3"].outcome, by_task["t3"].error) == ("failed", "no_response")
    assert (by_task["t4"].outcome, by_task["t4"].error) == ("failed", "no_response")
    assert (by_task["t5"].outcome, by_task["t5"].content) == ("ok", "before its task")
    assert (by_task["t1"].outcome, by_task["t1"].dropped) == ("ok", 0)
    # Replies in time give what the batch form gives on the same rows.
    tasks = spark.createDataFrame([(t,) for t in ("t1", "t2", "t3", "t4", "t5")], "task_id string")
    in_time = spark.read.parquet(f"{folder}/replies").where(
        (F.col("task_id") != "t3") & (F.col("task_id") != "clock")).drop("received_at")
    batch = {r.task_id: tuple(r) for r in pair_responses(tasks, in_time).collect()}
    assert {t: tuple(r) for t, r in by_task.items()} == batch


def test_assessments_once_per_task(spark, tmp_path):
    folder, sink, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")
    drop(spark, folder, "tasks", [("a", at(0)), ("b", at(0))], TASKS)
    drop(spark, folder, "replies", [("a", ok('{"verdict": {"is_malicious": true}}'), None, at(3)), ("b", None, "timeout", at(4)),
                                    ("clock", None, "timeout", at(500))], REPLIES)
    for _ in range(2):
        tasks = spark.readStream.schema(TASKS).parquet(f"{folder}/tasks")
        replies = spark.readStream.schema(REPLIES).parquet(f"{folder}/replies")
        stream_paired_assessments(tasks, replies, sink, progress, reply_timeout_s=60).awaitTermination(240)
    found = spark.read.parquet(sink).collect()
    assert sorted(r.task_id for r in found) == ["a", "b"]


def test_state_and_calls_per_bucket_not_per_task(spark, tmp_path):
    folder, sink, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")
    drop(spark, folder, "tasks", [(f"t{i}", at(0)) for i in range(300)], TASKS)
    drop(spark, folder, "replies", [(f"t{i}", ok(f"r{i}"), None, at(10)) for i in range(0, 300, 2)], REPLIES)
    drop(spark, folder, "replies", [("clock", None, "timeout", at(1000))], REPLIES)
    most = 0
    for _ in range(3):
        tasks = spark.readStream.schema(TASKS).parquet(f"{folder}/tasks")
        replies = spark.readStream.schema(REPLIES).parquet(f"{folder}/replies")
        query = (pair_stream(tasks, replies, 60, buckets=8, with_content=False).writeStream.format("parquet")
                 .option("checkpointLocation", progress).trigger(availableNow=True).start(sink))
        query.awaitTermination(240)
        most = max([most, *(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators)])
    assert 0 < most <= 8
    found = {r.task_id: (r.outcome, r.error, r.content) for r in spark.read.parquet(sink).collect()}
    assert found == {f"t{i}": ("ok", None, None) if i % 2 == 0 else ("failed", "no_response", None) for i in range(300)}


def test_a_task_with_replies_in_every_batch_is_paired_at_its_deadline(spark, tmp_path):
    folder, sink, progress = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress")
    drop(spark, folder, "tasks", [("hot", at(0))], TASKS)
    drop(spark, folder, "replies", [("hot", ok("in time"), None, at(30)), ("hot", None, "timeout", at(200))], REPLIES)
    run(spark, folder, sink, progress)
    drop(spark, folder, "replies", [("hot", ok("too late"), None, at(210))], REPLIES)
    run(spark, folder, sink, progress)
    found = spark.read.parquet(sink).collect()
    assert [(r.task_id, r.outcome, r.content, r.dropped) for r in found] == [("hot", "ok", "in time", 0)]
