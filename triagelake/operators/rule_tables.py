"""Process rules as joins against a rule table, over processes held as a long table (one row per process or per call).

The in-row form (``detectors``) filters each report's process list in place.  Here the rules are data: a table of (rule, value)
rows that can change without code, and the processes of all reports are a long table with their position in the list.  A left semi
join keeps the processes (or calls) whose lower-case value equals a value of the rule; a semi join never repeats a row, whatever the
rule table holds twice.

The rule table is broadcast only after its row count is checked against ``BROADCAST_ROWS``; above that bound the hint is left out
and the planner joins by a shuffle on the value.  Processes are never broadcast.

- ``system_binaries``: one finding per process whose name, in lower case, is a value of the rule, in list order (``pos``).
- ``injection``: one finding for the first process of a report (smallest position) with any call that, in lower case, is a value
  of the rule.  The calls are exploded and joined, and the first process per report is a minimum of (position, process id): a
  combined aggregate, reduced in each task before the shuffle, so a report with a million matching calls sends one row per task.
  Evidence rows are told apart by a row number of the scan (``row``), so rows that repeat a task_id stay separate reports.

Defined results, equal to the in-row form: a null or empty process list, a null name, a null call list or null calls match nothing;
repeated processes each give a finding (``system_binaries``); a report without matches gives no row; an empty evidence table gives an
empty result.  Columns: task_id, title, severity, reason, evidence_ref (the process id, at most 60 characters), pos (the process's
place in its list, from 0).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.operators.detectors import INJECTION_APIS, INJECTION_FINDING, SYSTEM_BINARIES, SYSTEM_BINARY_FINDING

#: A rule table of at most this many rows is broadcast; a larger one is joined by a shuffle.
BROADCAST_ROWS = 100_000


def rule_table(spark: SparkSession) -> DataFrame:
    """rule, value: the values of the two process rules, in lower case."""
    rows = [("system_binaries", v) for v in SYSTEM_BINARIES] + [("injection", v) for v in INJECTION_APIS]
    return spark.createDataFrame(rows, "rule string, value string")


def small_side(table: DataFrame, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``table`` with a broadcast hint if it holds at most ``most_rows`` rows (counted first), else unchanged."""
    return F.broadcast(table) if table.count() <= most_rows else table


def process_rows(evidence: DataFrame) -> DataFrame:
    """row, task_id, pos, id, process_name, suspicious_api_calls: one row per process of every report; ``row`` tells evidence rows
    apart."""
    return evidence.select(F.monotonically_increasing_id().alias("row"), "task_id", "process_highlights").select(
        "row", "task_id", F.posexplode("process_highlights").alias("pos", "p")).select(
        "row", "task_id", "pos", "p.id", "p.process_name", "p.suspicious_api_calls")


def _values(rules: DataFrame, rule: str, most_rows: int) -> DataFrame:
    return small_side(rules.where(F.col("rule") == rule).select(F.lower("value").alias("value")), most_rows)


def _finding(rows: DataFrame, finding: tuple[str, str, str]) -> DataFrame:
    title, severity, reason = finding
    return rows.select("task_id", F.lit(title).alias("title"), F.lit(severity).alias("severity"), F.lit(reason).alias("reason"),
                       F.substring("id", 1, 60).alias("evidence_ref"), "pos")


def system_binary_rows(evidence: DataFrame, rules: DataFrame | None = None, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Findings of ``system_binaries``: every process whose lower-case name is a value of the rule."""
    rules = rules if rules is not None else rule_table(evidence.sparkSession)
    procs = process_rows(evidence).select("task_id", "pos", "id", F.lower("process_name").alias("value"))
    return _finding(procs.join(_values(rules, "system_binaries", most_rows), "value", "left_semi"), SYSTEM_BINARY_FINDING)


def injection_rows(evidence: DataFrame, rules: DataFrame | None = None, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Findings of ``injection``: per report, the first process with a call that is a value of the rule."""
    rules = rules if rules is not None else rule_table(evidence.sparkSession)
    calls = process_rows(evidence).select("row", "task_id", "pos", "id", F.explode("suspicious_api_calls").alias("api")).select(
        "row", "task_id", "pos", "id", F.lower("api").alias("value"))
    hits = calls.join(_values(rules, "injection", most_rows), "value", "left_semi")
    first = hits.groupBy("row", "task_id").agg(F.min(F.struct("pos", "id")).alias("first")).select("task_id", "first.pos", "first.id")
    return _finding(first, INJECTION_FINDING)


def joined_findings(evidence: DataFrame, rule: str, rules: DataFrame | None = None, most_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Findings of ``injection`` or ``system_binaries`` by joins against the rule table."""
    build = {"injection": injection_rows, "system_binaries": system_binary_rows}[rule]
    return build(evidence, rules, most_rows)
