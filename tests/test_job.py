"""Whole job, sinks, sources, streams and scale properties."""

import json

import pytest
from pyspark.sql import functions as F

from triagelake import (
    TriageOptions,
    detect_risks,
    extract_iocs,
    ingest_reports,
    keyed,
    normalize_reports,
    prepare_requests,
    publish_evidence,
    read_report_lines,
    read_reports,
    run_triage,
    write_outputs,
)
from triagelake.operators import artifacts, tables
from triagelake.sources.outputs import JSON_DATASET, MARKDOWN_DATASET
from triagelake.streaming.incremental import REPORTS, RESPONSES, arriving, stream_assessments, stream_evidence


def envelope(content):
    return json.dumps({"choices": [{"message": {"content": content}}]})


@pytest.fixture
def reports(spark):
    rows = [("a", "{}"), ("b", '{"info": {"id": 2}}'), (None, '{"x": 1}'), ("dup", "{}"), ("dup", "{}")]
    return spark.createDataFrame(rows, "task_id string, raw string")


@pytest.fixture
def responses(spark):
    rows = [("a", envelope("{}"), None), ("b", None, "timeout"), ("dup", envelope('{"status": "x"}'), None)]
    return spark.createDataFrame(rows, "task_id string, body string, transport_error string")


def test_disabled_job_does_nothing(reports, responses):
    options = TriageOptions.from_mapping({"enabled": "no"})
    assert run_triage(reports, responses, options) is None and prepare_requests(reports, options) is None


def test_job_attaches_and_survives_failures(spark, reports, responses, tmp_path):
    options = TriageOptions.from_mapping({"enabled": "yes", "attach_to_results": "yes", "store_markdown": "yes"})
    result = run_triage(reports, responses, options, str(tmp_path))
    assert result.written == {JSON_DATASET: "written", MARKDOWN_DATASET: "written"}
    attached = result.attached.collect()
    assert len(attached) == 5 and all(r.llm_assessment is not None for r in attached)
    messages = {r.raw: r.llm_assessment.message for r in attached}
    assert messages['{"info": {"id": 2}}'] == "LLM invocation failed: timeout"
    assert messages['{"x": 1}'] == "LLM invocation failed: no_response"
    saved = {r.task_id: r.status for r in spark.read.json(f"{tmp_path}/{JSON_DATASET}").collect()}
    assert len(saved) == 4 and saved["a"] == "ok" and saved["dup"] == "x"
    assert spark.read.parquet(f"{tmp_path}/{MARKDOWN_DATASET}").count() == 4


def test_markdown_failure_is_not_fatal(spark, reports, responses, tmp_path):
    options = TriageOptions(enabled=True)
    assessments = run_triage(reports, responses, options).assessments
    written = write_outputs(assessments, str(tmp_path), render=lambda rows: rows.selectExpr("raise_error('x')"))
    assert written[JSON_DATASET] == "written" and written[MARKDOWN_DATASET] != "written"
    assert spark.read.json(f"{tmp_path}/{JSON_DATASET}").count() == 4


def test_unusable_limits_give_error_assessments(reports, responses):
    options = TriageOptions.from_mapping({"enabled": "on", "max_processes": "many", "temperature": "hot"})
    assert options.temperature == 0.0
    rows = run_triage(reports, responses, options).assessments.collect()
    assert len(rows) == 4 and {r.error_type for r in rows} == {"module_exception"}


def test_infinite_limits_are_unusable():
    options = TriageOptions.from_mapping({"enabled": "on", "max_processes": float("inf"), "max_tokens": float("nan")})
    assert not options.usable and options.max_tokens == TriageOptions().max_tokens


def test_unreadable_reports_get_no_request_but_an_assessment(spark, responses, tmp_path):
    rows = [("a", "{}"), ("b", '{"cut": '), ("dup", "{}"), ("dup", "nope"), (None, "nope")]
    reports = ingest_reports(spark.createDataFrame(rows, "task_id string, raw string"), str(tmp_path / "reports"))
    options = TriageOptions(enabled=True, attach_to_results=True)
    publish_evidence(reports, str(tmp_path / "evidence"), options)
    evidence = spark.read.parquet(str(tmp_path / "evidence" / "evidence"))
    assert sorted(r.task_id for r in prepare_requests(None, options, evidence).collect()) == ["a", "dup"]
    result = run_triage(reports, responses, options, evidence=evidence, ingested=True)
    found = {r.task_id: (r.status, r.error_type) for r in result.assessments.collect()}
    assert len(found) == 4 and found["a"] == ("ok", "") and found["dup"][0] == "x"
    assert [e for t, (_, e) in found.items() if t not in ("a", "dup")] == ["module_exception"] * 2
    assert result.attached.count() == 5
    result.release()
    assert not list((tmp_path / "reports").parent.glob("assessments-*"))


def test_pairing_reads_ids_only(spark, reports, responses, tmp_path):
    from triagelake import assess

    stored = ingest_reports(reports, str(tmp_path / "reports"))
    responses.write.parquet(str(tmp_path / "replies"))
    plan = plan_of(assess(stored, spark.read.parquet(str(tmp_path / "replies")), TriageOptions(enabled=True)))
    assert "ReadSchema: struct<task_id:string>" in plan and "raw" not in plan


def test_shared_folder_needs_a_setting_on_a_cluster(spark):
    from types import SimpleNamespace

    from triagelake.sources.session import shared_folder

    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master=master, applicationId=f"app-{master}"))

    assert shared_folder(session("yarn"), "/given/") == "/given"
    assert shared_folder(session("local[4]")) == shared_folder(session("local[4]"))
    for master in ("yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared_folder(session(master))


def test_risks_and_indicators_from_stored_evidence(spark, tmp_path):
    raw = json.dumps({"behavior": {"summary": {"executed_commands": ["whoami"], "files": ["f"]}}})
    rows = spark.createDataFrame([("t", raw)], "task_id string, raw string")
    publish_evidence(rows, str(tmp_path), TriageOptions())
    evidence = spark.read.parquet(str(tmp_path / "evidence"))
    assert [r.title for r in detect_risks(evidence).first().risk_indicators] == ["Discovery commands detected"]
    assert extract_iocs(evidence).first().file_paths == ["f"]


def test_published_tables(spark, reports, tmp_path):
    written = publish_evidence(reports, str(tmp_path), TriageOptions())
    assert set(written.values()) == {"written"} and len(written) == 10
    assert spark.read.parquet(f"{tmp_path}/scores").count() == 5


def test_sources(spark, tmp_path):
    for task in ("11", "12"):
        folder = tmp_path / "analyses" / task / "reports"
        folder.mkdir(parents=True)
        (folder / "llm_summary.json").write_text('{"status": "ok"}')
        (folder / "report.json").write_text('{"info":\n {"id": %s}}' % task)
    rows = read_reports(spark, str(tmp_path / "analyses")).collect()
    assert {r.task_id for r in rows} == {"11", "12"} and all(json.loads(r.raw) for r in rows)
    lines = tmp_path / "lines.json"
    lines.write_text('{"info": {"id": 5}}\nbroken\n')
    assert [r.task_id for r in keyed(read_report_lines(spark, str(lines))).sort("raw", ascending=False).collect()][0] == "5"
    assert keyed(read_report_lines(spark, str(lines))).where("task_id IS NULL").count() == 0


def test_streams_write_each_row_once(spark, reports, responses, tmp_path):
    for at, part in enumerate((reports.where("task_id = 'a'"), reports.where("task_id = 'b'"))):
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream_evidence(arriving(spark, str(tmp_path / "in"), REPORTS), str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination(120)
        assert spark.read.parquet(str(tmp_path / "out")).count() == at + 1
    responses.write.parquet(str(tmp_path / "replies"))
    stream_assessments(arriving(spark, str(tmp_path / "replies"), RESPONSES), str(tmp_path / "done"), str(tmp_path / "progress-2")).awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "done")).count() == 3


def plan_of(rows):
    return rows._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def test_evidence_needs_no_shuffle_and_computes_once(spark, tmp_path, reports):
    reports.write.parquet(str(tmp_path / "reports"))
    evidence = normalize_reports(spark.read.parquet(str(tmp_path / "reports")))
    for build in (tables.risks, tables.iocs, tables.signatures, tables.process_highlights, tables.network_highlights):
        plan = plan_of(build(evidence))
        assert "Exchange" not in plan and plan.count("parseJson") == 2  # the second reading is for texts that the first refuses
        # No filter inferred for the explode: it would inline the whole computation below the parse.
        assert "Filter (" not in plan
    scores = plan_of(tables.scores(evidence))
    assert "code_block" not in scores and "behavior.summary" not in scores


def test_long_lists_against_brute_force_with_a_hot_group(spark):
    rows = [(0 if i % 3 else i % 7, f" v{(i * i) % 41} " if i % 5 else " ", i) for i in range(3000)]
    table = spark.createDataFrame(rows, "g int, v string, p int").repartition(8)
    expected = {}
    for group, value, position in rows:
        if value.strip():
            expected.setdefault(group, {}).setdefault(value.strip(), position)
    distinct = artifacts.dedupe_first_seen(table, "g", "v", "p")
    found = {}
    for r in distinct.collect():
        found.setdefault(r.g, {})[r.v] = r.p
    assert found == expected
    lists = artifacts.sorted_lists(table, "g", "v", "p", 5)
    assert {r.g: r["values"] for r in lists.collect()} == {
        g: sorted(sorted(values, key=values.get)[:5]) for g, values in expected.items()}
    assert plan_of(artifacts.first_n(table, "g", "p", 5)).count("WindowGroupLimit") == 2


def test_large_limits_cut_hot_groups_in_parts(spark):
    rows = spark.range(20_000).select((F.col("id") % 3 == 0).cast("int").alias("g"), F.col("id").alias("p"))
    first = artifacts.first_n(rows, "g", "p", 5000)
    found = {r.g: (r.n, r.low, r.high) for r in first.groupBy("g").agg(F.count("*").alias("n"), F.min("rank").alias("low"), F.max("p").alias("high")).collect()}
    assert found == {0: (5000, 1, 7499), 1: (5000, 1, 14997)}
    assert "__bucket" in plan_of(first) and first.columns == ["g", "p", "rank"]


def test_hot_task_in_attach_keeps_all_rows(spark, responses):
    many = spark.range(2000).select(F.lit("a").alias("task_id"), F.concat(F.lit('{"n":'), F.col("id"), F.lit("}")).alias("raw"))
    result = run_triage(many, responses, TriageOptions(enabled=True, attach_to_results=True))
    assert result.assessments.count() == 1
    assert result.attached.where("llm_assessment.status = 'ok'").count() == 2000


def test_attach_to_bucketed_reports_moves_no_report_text(spark, reports, responses):
    from triagelake.plans.job import ingest_reports_bucketed

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the layout, not a broadcast, must keep the reports in place
    try:
        stored_reports = ingest_reports_bucketed(reports, "reports_bucketed_test", 4)
        options = TriageOptions(enabled=True, attach_to_results=True)
        result = run_triage(stored_reports, responses, options, ingested=True)
        plan = result.attached._jdf.queryExecution().executedPlan().toString()
        report_side = [line for line in plan.splitlines() if "raw" in line and ("Exchange" in line or "Scan" in line)]
        assert report_side and not any("Exchange" in line for line in report_side)
        plain = run_triage(keyed(reports), responses, options, ingested=True).attached
        shown = lambda rows: sorted((r.task_id, r.raw, r.llm_assessment.status) for r in rows.collect())
        assert shown(result.attached) == shown(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_numbering_a_group_with_half_of_all_rows(spark):
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 7 == 1, F.lit(None))
                                    .otherwise((F.col("id") % 13).cast("string")).alias("g"), (F.col("id") * 7919 % 4001).alias("p"))
    numbered = artifacts.number_rows(rows.repartition(6), "g", ["p"], "n").collect()
    expected = {}
    for r in sorted(rows.collect(), key=lambda r: (r.g is not None, r.g or "", r.p)):
        expected.setdefault(r.g, []).append(r.p)
    assert sorted((r.g or "", r.p, r.n) for r in numbered) == sorted(
        (g or "", p, i) for g, ps in expected.items() for i, p in enumerate(ps, 1))
    assert artifacts.number_rows(rows.where("false"), "g", ["p"]).count() == 0
