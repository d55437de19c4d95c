"""Process rules joined against a rule table equal the in-row rules."""

import json

import pytest

from triagelake import TriageOptions, normalize_reports
from triagelake.operators.detectors import findings_of
from triagelake.operators.rule_tables import joined_findings, rule_table

COLUMNS = ["task_id", "title", "severity", "reason", "evidence_ref"]


def proc(name=None, *apis, pid=None):
    found = {"process_name": name, "calls": [{"api": a} for a in apis]}
    return found if pid is None else {**found, "process_id": pid}


REPORTS = [
    ("a", {"behavior": {"processes": [proc("notepad.exe", "ReadFile"), proc("CMD.EXE", "writeprocessmemory", pid=11),
                                      proc("cmd.exe", "QueueUserAPC", pid=12), proc("x", "CreateRemoteThreadEx")]}}),
    ("a", {"behavior": {"processes": [proc("powershell.exe"), proc(None, None, "NtUnmapViewOfSection", pid=3)]}}),  # same task id
    ("b", {"behavior": {"processes": [proc("Rundll32.exe", pid=1), proc("rundll32.exe", pid=1)]}}),  # repeated process
    ("c", {"behavior": {"processes": []}}),
    ("d", {"behavior": {"processes": [proc(None)]}}),
    ("e", {}),
    ("f", None),
    ("g", {"behavior": {"processes": [proc("calc.exe", *(["nothing"] * 5), "CREATEREMOTETHREAD", pid=7)] * 30}}),
]


@pytest.fixture(scope="module")
def evidence(spark):
    rows = [(t, r if r is None else json.dumps(r)) for t, r in REPORTS]
    raw = spark.createDataFrame(rows, "task_id string, raw string").repartition(3)
    return normalize_reports(raw, TriageOptions(max_processes=40)).cache()


def rows(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


@pytest.mark.parametrize("rule", ["injection", "system_binaries"])
def test_joined_equal_in_row(evidence, rule):
    expected = rows(findings_of(evidence, rule))
    assert expected  # the fixture has matches of both rules
    assert rows(joined_findings(evidence, rule)) == expected
    assert rows(joined_findings(evidence, rule, most_rows=0)) == expected  # a rule table too large to broadcast


def test_first_process_and_repeats(evidence):
    injected = rows(joined_findings(evidence, "injection"))
    assert [r[0] for r in injected] == ["a", "a", "g"]  # one per report, also for reports that share a task id
    binaries = [r for r in rows(joined_findings(evidence, "system_binaries")) if r[0] == "b"]
    assert len(binaries) == 2  # a repeated process gives two findings


def test_rule_table_repeats_and_other_rules(evidence, spark):
    doubled = rule_table(spark).unionAll(rule_table(spark)).unionAll(spark.createDataFrame([("other", "calc.exe")], "rule string, value string"))
    for rule in ("injection", "system_binaries"):
        assert rows(joined_findings(evidence, rule, doubled)) == rows(findings_of(evidence, rule))


def test_broadcast_only_below_the_bound(evidence):
    small = joined_findings(evidence, "system_binaries")._jdf.queryExecution().executedPlan().toString()
    large = joined_findings(evidence, "system_binaries", most_rows=0)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small and "LeftSemi" in small
    assert "BroadcastHashJoin" not in large


def test_empty_evidence(evidence):
    for rule in ("injection", "system_binaries"):
        assert joined_findings(evidence.where("false"), rule).count() == 0
