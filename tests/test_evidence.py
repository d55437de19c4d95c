"""Evidence of hand-written reports."""

import json

import pytest

from triagelake import TriageOptions, evidence_packages, normalize_reports
from triagelake.operators import tables
from triagelake.operators.prompts import build_prompts, request_payloads


@pytest.fixture
def evidence(spark):
    def build(report, **options):
        raw = report if isinstance(report, str) or report is None else json.dumps(report)
        rows = spark.createDataFrame([("t", raw)], "task_id string, raw string")
        return normalize_reports(rows, TriageOptions(**options))

    return build


@pytest.mark.parametrize("report", [{}, "junk", "[1]", "5", None, '"x"'])
def test_empty_and_unreadable_reports(evidence, report):
    row = evidence(report, max_input_events=3).collect()[0]
    assert row.sample.task_id is None and row.sample.submitted_filename == ""
    assert row.behavior_summary.files == [] and row.signatures == [] and row.risk_indicators == []
    assert row.detections == "{}" and row.config_extraction == "{}"
    assert row.high_level_scores.signature_count == 0


def test_lists_with_stray_entries_are_cut_after_repeats_are_dropped(evidence):
    report = {
        "behavior": {
            "summary": {"mutexes": ["one", "two", "one", "two", "three", "four"], "services": 17},
            "processes": [None, 3, {"process_name": "MSHTA.exe", "calls": [{"api": "NtQueueApcThread"}, {"api": "SetWindowsHookExA"}]},
                          {"process_name": "regsvr32.exe"}],
        },
        "network": {"domains": [{"domain": "Mirror.Example.NET."}, "x", {"domain": "mirror.example.net"}, {"domain": "b.example.net"}]},
    }
    row = evidence(report, max_input_events=3, max_processes=2).collect()[0]
    assert row.behavior_summary.mutexes == ["one", "two", "three"] and row.behavior_summary.services == []
    assert [p.id for p in row.process_highlights] == ["proc_3", "proc_4"]
    assert row.ioc_candidates.domains == ["b.example.net", "mirror.example.net"]
    assert all(r.evidence_ref in ("proc_3", "proc_4") for r in row.risk_indicators) and row.risk_indicators


@pytest.mark.parametrize(("raw", "status"), [
    ('{"malscore":NaN,"signatures":[{"name":"Emotet"}]}', "ok"), ('{"a":"x, NaN","b":[-Infinity],"signatures":[{"name":"Emotet"}]}', "ok"),
    ("{}", "ok"), ("[1]", "not_object"), ("5", "not_object"), ('{"signatures":[{"name":"Emo', "not_json"), (None, "not_json"), ("", "not_json"),
    ("[" * 1500 + "]" * 1500, "too_deep"), ('{"a": "' + "[" * 1500 + '"}', "ok"), ('{"a": [' + "{" * 1001, "too_deep"),
    ("[" * 1000 + "]" * 1000, "not_object"),
])
def test_read_status(evidence, raw, status):
    row = evidence(raw).collect()[0]
    assert row.read_status == status
    assert [s.name for s in row.signatures] == (["Emotet"] if raw and "Emotet" in raw and status == "ok" else [])


def test_huge_reports_are_read_or_named(spark):
    from pyspark.sql import functions as F

    from triagelake.operators.evidence import readable, unreadable

    rows = spark.range(1).select(
        F.lit("string").alias("task_id"), F.concat(F.lit('{"info":{"id":"'), F.repeat(F.lit("x"), 25_000_000), F.lit('"}}')).alias("raw"))
    rows = rows.unionByName(spark.range(1).select(
        F.lit("text").alias("task_id"),
        F.concat(F.lit('{"signatures":['), F.repeat(F.lit('{"name":"' + "n" * 9990 + '"},'), 14_000), F.lit('{}]}')).alias("raw")))
    found = normalize_reports(rows)
    assert {r.task_id: r.read_status for r in unreadable(found).collect()} == {"string": "too_large", "text": "too_large"}
    assert readable(found).count() == 0


@pytest.mark.parametrize("node", [None, 5, "x", [], {}, [1], True])
def test_any_node_may_hold_anything(evidence, node):
    for path in ("info", "target", "behavior", "signatures", "network", "detections", "CAPE", "malscore"):
        assert evidence({path: node}).count() == 1
    inner = {"behavior": {"summary": node, "processes": node}, "network": {"domains": node, "http": node, "dns": node},
             "target": {"file": node}}
    assert evidence(inner).collect()[0].process_highlights == []


def test_calls_and_process_ids(evidence):
    calls = [{"api": "a"}] * 12 + [{"api": "QueueUserAPC"}]
    procs = [{"process_id": "7", "calls": calls}, {"process_id": True}, {"process_id": 5.0}, {"process_id": 9, "calls": "x"},
             {"calls": [{"api": ""}, {"api": 0}, 4, {"api": "WRITEPROCESSMEMORY"}]}]
    row = evidence({"behavior": {"processes": procs}}).collect()[0]
    assert [p.pid for p in row.process_highlights] == [None, 1, None, 9, None]
    assert len(row.process_highlights[0].suspicious_api_calls) == 12
    # The call after the twelfth is not seen; the fifth process is the first that injects.
    assert [r.evidence_ref for r in row.risk_indicators] == ["proc_5"]


def test_phrases_may_span_two_commands(evidence):
    row = evidence({"behavior": {"summary": {"executed_commands": ["ping net", "user list", "set SAM"]}}}).collect()[0]
    assert [r.title for r in row.risk_indicators] == ["Discovery commands detected", "Credential access hints"]


def test_bulk_files_need_a_wide_limit(evidence):
    report = {"behavior": {"summary": {"files": [f"f{i}" for i in range(201)]}}}
    assert evidence(report).collect()[0].risk_indicators == []
    assert evidence(report, max_input_events=201).collect()[0].risk_indicators[0].severity == "critical"


def test_redaction_switch_and_unredacted_lists(evidence):
    report = {"behavior": {"summary": {"files": ["C:\\Users\\bob\\x"], "mutexes": ["/home/bob/m"]}}}
    row = evidence(report).collect()[0]
    assert row.behavior_summary.files == ["C:\\Users\\<redacted>\\x"] and row.behavior_summary.mutexes == ["/home/bob/m"]
    assert evidence(report, redact_pii=False).collect()[0].behavior_summary.files == ["C:\\Users\\bob\\x"]


def test_signature_severity_missing_or_null(evidence):
    rows = tables.signatures(evidence({"signatures": [{}, {"severity": None}, {"severity": "high"}, 3, {"mitre": ["T1"], "ttp": []}]}))
    assert [(r.id, r.severity, r.ttp) for r in rows.collect()] == [
        ("sig_1", "1", ""), ("sig_2", None, ""), ("sig_3", "high", ""), ("sig_5", "1", "T1")]


def test_negative_limits_mean_none(evidence):
    row = evidence({"behavior": {"summary": {"files": ["a"]}, "processes": [{}]}}, max_input_events=-1, max_processes=-5).collect()[0]
    assert row.behavior_summary.files == [] and row.process_highlights == []


def test_hashes_domains_and_urls(evidence):
    report = {
        "target": {"file": {"md5": "A" * 32, "sha1": "zz", "sha256": "b" * 65}},
        "network": {"http": [{"uri": "", "url": "HTTP://X.com/a?b#c"}, {}, "s"], "hosts": [{"ip": " 1.2.3.4 "}, {"ip": 0}]},
    }
    iocs = evidence(report).collect()[0].ioc_candidates
    assert (iocs.hashes, iocs.urls, iocs.ips) == (["a" * 32], ["http://x.com/a?b"], ["1.2.3.4"])


def test_package_text(evidence):
    report = {
        "info": {"id": 7, "category": ""}, "target": {"category": "file", "file": {"name": 'a"b\\c', "md5": None}}, "malscore": 1.0,
        "detections": {"z": 1, "a": 2.50}, "CAPE": {}, "cape": {"q": [1, 2.0]},
        "network": {"http": [{"z": 1, "uri": "HTTP://X.com", "ok": True}, "plain", 5, None]},
        "signatures": [{"name": "s", "severity": None, "families": ["f"]}],
        "behavior": {"summary": {"keys": ["x\\run\\y"]}, "processes": [{"process_name": "cmd.exe", "process_id": 4}]},
    }
    text = evidence_packages(evidence(report)).collect()[0].evidence_package
    expected = {
        "sample": {"task_id": 7, "category": "file", "submitted_filename": 'a"b\\c', "sha256": None, "sha1": None, "md5": None, "type": ""},
        "high_level_scores": {"malscore": 1.0, "signature_count": 1, "process_count": 1},
        "detections": {"z": 1, "a": 2.5},
        "behavior_summary": {"files": [], "keys": ["x\\run\\y"], "mutexes": [], "executed_commands": [], "services": [],
                             "scheduled_tasks": [], "injection_signals": []},
        "process_highlights": [
            {"id": "proc_1", "process_name": "cmd.exe", "pid": 4, "suspicious_api_calls": [], "command_line": ""}],
        "network_summary": {"domains": [], "hosts": [], "http": ["{'z': 1, 'uri': 'HTTP://X.com', 'ok': True}", "plain", "5"],
                            "dns": [], "tcp": [], "udp": []},
        "network_highlights": [],
        "signatures": [{"id": "sig_1", "name": "s", "severity": None, "description": "", "families": ["f"], "ttp": []}],
        "config_extraction": {"q": [1, 2.0]},
        "ioc_candidates": {"hashes": [], "domains": [], "ips": [], "urls": ["http://x.com"], "registry_keys": ["x\\run\\y"],
                           "file_paths": [], "mutexes": []},
        "risk_indicators": [
            {"title": "Persistence behavior observed", "severity": "high",
             "reason": "Autostart registry or task/service creation activity found", "evidence_ref": "behavior_summary", "id": "risk_1"},
            {"title": "LOLBins execution", "severity": "medium", "reason": "Potentially abused built-in binary executed",
             "evidence_ref": "proc_1", "id": "risk_2"}],
        "raw_evidence_refs": ["info", "target", "detections", "signatures", "behavior.summary", "behavior.processes", "network",
                              "dropped", "procdump", "CAPE"],
    }
    assert text == json.dumps(expected, ensure_ascii=False)


def test_prompts_and_requests(evidence):
    prompts = build_prompts(evidence({"info": {"id": "中"}}), "v9")
    user = json.loads(prompts.collect()[0].user_prompt)
    assert user["prompt_version"] == "v9" and user["schema"]["verdict"]["severity"] == "unknown"
    assert json.loads(user["evidence_package"])["sample"]["task_id"] == "中"
    payload = json.loads(request_payloads(prompts, TriageOptions(temperature=0.5)).collect()[0].payload)
    assert payload["model"] == "qwen2.5-72b-instruct" and payload["response_format"] == {"type": "json_object"}
    assert [m["role"] for m in payload["messages"]] == ["system", "user"]


def test_package_is_cut_to_budget(evidence):
    files = [f"{i:04d}" + "x" * 250 for i in range(200)]
    text = evidence_packages(evidence({"behavior": {"summary": {"files": files}}}, max_input_events=200)).collect()[0].evidence_package
    assert len(text) == 24_000
