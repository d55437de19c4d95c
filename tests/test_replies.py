"""Replies: envelopes, parsing, coercion, Markdown."""

import json

import pytest

from triagelake import classify_responses, pair_responses, parse_replies, render_markdown
from triagelake.operators.assessments import assessment_json, default_assessment, error_assessments

META = {"provider": "p", "model": "m", "prompt_version": "v1"}


@pytest.fixture
def parse(spark):
    def run(content, metadata=None):
        text = content if isinstance(content, str) else json.dumps(content)
        return parse_replies(spark.createDataFrame([("t", text)], "task_id string, content string"), metadata)

    return run


@pytest.fixture
def classify(spark):
    def run(body=None, error=None, provider="openai_compatible"):
        text = body if isinstance(body, str) or body is None else json.dumps(body)
        rows = spark.createDataFrame([("t", text, error)], "task_id string, body string, transport_error string")
        return classify_responses(rows, provider).collect()[0]

    return run


def test_reply_between_prose(parse):
    raw = 'My view:\n\n```\n{"verdict": {"confidence": -4, "severity": "INFORMATIONAL", "category": ["loader", "loader"]}}\n```\nRegards, model'
    row = parse(raw, META).collect()[0]
    assert (row.verdict.confidence, row.verdict.severity, row.verdict.category) == (0.0, "low", ["loader"])
    assert row.model_metadata.asDict() == META


def test_entries_with_unusable_fields(parse):
    row = parse({
        "ttps": [{"id": "Phishing"}, {"id": "t1566", "evidence_ids": {"a": 1}}, {"id": "T12345"}, {"id": " T1204.002"}],
        "observed_facts": [{"title": "dropper", "evidence_ids": 12}, {"summary": ["list"]}],
        "iocs": {"urls": ["http://z.example/", "", "http://k.example/", "http://z.example/"], "ips": "10.0.0.1"},
    }).collect()[0]
    assert [(t.id, t.evidence_ids) for t in row.ttps] == [("T1566", []), ("T1204.002", [])]
    assert [f.evidence_ids for f in row.observed_facts] == [[], []]
    assert row.iocs.urls == ["http://k.example/", "http://z.example/"] and row.iocs.ips == []


@pytest.mark.parametrize("raw", ["not-json", "", "{}{}", "{'a': 1}", "{\"a\": 1"])
def test_unreadable_replies(parse, raw):
    row = parse(raw).collect()[0]
    assert (row.status, row.error_type) == ("error", "invalid_json") and len(row.uncertainties) == 1


@pytest.mark.parametrize("raw", ["[1, 2]", "5", "null", "{}", '{"verdict": "text", "ttps": {}, "iocs": 3}', "x {} y"])
def test_readable_replies_without_content_give_defaults(parse, raw):
    data = json.loads(assessment_json(parse(raw)).collect()[0].json)
    assert data == default_assessment()


def test_steps_and_truth(parse):
    row = parse({"attack_flow": [5, {"step": 0}, {"step": 7}, {"step": "x"}, {"step": True}], "verdict": {"is_malicious": "false"}}).collect()[0]
    assert [s.step for s in row.attack_flow] == [1, 7, 3, 1] and row.verdict.is_malicious


def test_metadata_of_the_job_wins(parse):
    reply = {"model_metadata": {"provider": "claimed", "model": "m" * 100}}
    assert parse(reply).collect()[0].model_metadata.provider == "claimed"
    assert len(parse(reply).collect()[0].model_metadata.model) == 80
    assert parse(reply, META).collect()[0].model_metadata.asDict() == META


@pytest.mark.parametrize(("body", "outcome", "error"), [
    ({"choices": []}, "failed", "empty_response"), ([], "failed", "empty_response"), ({"choices": {"0": 1}}, "failed", "empty_response"),
    ({"choices": [None]}, "failed", "empty_content"), ({"choices": [{"message": {"content": " \u3000"}}]}, "failed", "empty_content"),
    ({"choices": [{"message": {"content": 5}}]}, "failed", "empty_content"), ({"choices": [{"message": ""}]}, "failed", "empty_content"),
    ({"choices": ["s"]}, "broken", None), ({"choices": [{"message": [1]}]}, "broken", None), ("nope", "failed", "invalid_response"),
    ({"choices": [{"message": {"content": "x"}}]}, "ok", None),
])
def test_envelopes(classify, body, outcome, error):
    row = classify(body)
    assert (row.outcome, row.error) == (outcome, error)


@pytest.mark.parametrize("error", ["timeout", "http_error", "connection_error", "io_error"])
def test_transport_errors_pass_through(classify, error):
    assert classify(None, error).error == error


def test_other_provider(classify):
    row = classify({"choices": [{"message": {"content": "x"}}]}, provider="other")
    assert (row.error, row.details) == ("unsupported_provider", "other")


def test_one_row_per_task_with_hot_and_missing_keys(spark):
    # One task holds most tasks and most replies; a delivered reply beats a failed one.
    tasks = spark.createDataFrame([("hot",)] * 300 + [("a",), ("b",), (None,)], "task_id string")
    envelope = json.dumps({"choices": [{"message": {"content": "{}"}}]})
    replies = spark.createDataFrame(
        [("hot", None, "timeout")] * 200 + [("hot", envelope, None)] * 100 + [("a", None, "timeout"), ("z", envelope, None)],
        "task_id string, body string, transport_error string")
    rows = {r.task_id: (r.outcome, r.error) for r in pair_responses(tasks, replies).collect()}
    assert rows == {"hot": ("ok", None), "a": ("failed", "timeout"), "b": ("failed", "no_response"), None: ("failed", "no_response")}


def test_best_reply_wins_and_the_rest_is_counted(spark):
    good, page, none = json.dumps({"choices": [{"message": {"content": "{}"}}]}), "<html>bad gateway</html>", '{"choices":[]}'
    odd = '{"choices":["text"]}'
    rows = [("a", good, None), ("a", page, None), ("a", page, None), ("b", none, None), ("b", good, None), ("c", None, "timeout"), ("c", good, None),
            ("d", odd, None), ("d", None, "timeout"), ("e", "oops{", None), ("f", good, None), ("f", good, None), (None, good, None)]
    replies = spark.createDataFrame(rows, "task_id string, body string, transport_error string").repartition(5)
    tasks = spark.createDataFrame([(t,) for t in "abcdefg"], "task_id string")
    found = {r.task_id: (r.outcome, r.error, r.dropped) for r in pair_responses(tasks, replies).collect()}
    assert found == {"a": ("ok", None, 2), "b": ("ok", None, 1), "c": ("ok", None, 1), "d": ("failed", "timeout", 1),
                     "e": ("failed", "invalid_response", 0), "f": ("ok", None, 1), "g": ("failed", "no_response", 0)}


def test_markdown_of_empty_and_long_fields(spark, parse):
    text = render_markdown(parse({
        "key_findings": [{"title": "T" * 300, "severity": "critical", "why_it_matters": "W" * 300, "evidence_ids": ["sig_1"]}],
        "verdict": {"is_malicious": 1, "confidence": 0.125},
    })).collect()[0].markdown
    assert "## Executive Verdict" in text and "## Uncertainties\n- none\n" in text and "`0.12`" in text and "`True`" in text
    assert max(map(len, text.splitlines())) < 400 and text.endswith("\n")
    tasks = spark.createDataFrame([("t",)], "task_id string")
    stub = render_markdown(error_assessments(tasks, "x", "y", META)).collect()[0].markdown
    assert "- Status: `error`" in stub and "- hashes: not observed" in stub


def test_bare_number_names(parse):
    row = parse('{"verdict": {"confidence": NaN, "severity": Infinity}, "message": -Infinity}').collect()[0]
    assert row.verdict.confidence != row.verdict.confidence and row.message == "-inf"
    assert "- Confidence: `nan`" in render_markdown(parse('{"verdict": {"confidence": NaN}}')).collect()[0].markdown


def test_pairing_sorts_no_reply_text(spark):
    from pyspark.sql import functions as F

    tasks = spark.range(50).select(F.concat(F.lit("t"), (F.col("id") % 5).cast("string")).alias("task_id"))
    body = F.concat(F.lit('{"choices":[{"message":{"content":"x'), F.col("id").cast("string"), F.lit('"}}]}'))
    replies = spark.range(3000).select(F.lit("t1").alias("task_id"), body.alias("body"), F.lit(None).cast("string").alias("transport_error"))
    paired = pair_responses(tasks, replies)
    plan = paired._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "first(" not in plan
    rows = {r.task_id: (r.outcome, r.dropped) for r in paired.collect()}
    assert rows["t1"] == ("ok", 2999) and rows["t0"] == ("failed", 0) and len(rows) == 5
