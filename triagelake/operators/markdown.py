"""Assessments -> Markdown reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from triagelake.functions.sql import case, concat, let, lit
from triagelake.functions.text import sanitize
from triagelake.functions.variants import clamp_unit
from triagelake.operators.assessments import TEAMS
from triagelake.operators.evidence import IOC_KINDS

_UNIT = 2**62


def two_digits(number: str) -> str:
    """A confidence with two decimals, rounded from its exact binary value, ties to even: 0.125 gives 0.12, 0.285 gives 0.28.

    Spark rounds the shortest decimal text of a double instead.  Scaled by 2**62 a confidence is a whole number (any rest lies
    far below the second decimal), and whole numbers round exactly.
    """
    unit = f"CAST({_UNIT} AS decimal(20,0))"
    scaled = f"CAST(CAST(x * {float(_UNIT)}D AS bigint) AS decimal(20,0)) * 100"
    parts = f"named_struct('rest', s % {unit}, 'whole', CAST((s - s % {unit}) / {unit} AS int))"
    up = f"(r.rest * 2 > {unit} OR (r.rest * 2 = {unit} AND r.whole % 2 = 1))"
    cents = f"r.whole + CAST({up} AS int)"
    text = let("c", cents, "concat(string(c div 100), '.', lpad(string(c % 100), 2, '0'))")
    rounded = let("s", scaled, let("r", parts, text))
    return let("x", clamp_unit(number), case(("isnan(x)", "'nan'"), otherwise=rounded))


def cell(text: str, size: int) -> str:
    return sanitize(text, size, redact=False)


def _or(text: str, fallback: str) -> str:
    return f"coalesce(nullif({text}, ''), {lit(fallback)})"


def _ids(entry: str) -> str:
    return _or(f"array_join({entry}.evidence_ids, ',')", "n/a")


def _lines(values: str, line: str, fallback: str) -> str:
    """One line per entry ``e`` of a list."""
    return case((f"size({values}) > 0", f"array_join(transform({values}, e -> {line}), '\\n')"), otherwise=lit(fallback))


def _joined(values: str, size: int, separator: str, fallback: str) -> str:
    shown = f"array_join(transform({values}, e -> {cell('e', size)}), {lit(separator)})"
    return case((f"size({values}) > 0", shown), otherwise=lit(fallback))


_FAMILY = concat(
    "'- **'", _or(cell("e.name", 80), "N/A"), "'** ('", two_digits("e.confidence"), "'): '", cell("e.reason", 140),
    "' | evidence: '", _ids("e"),
)
_FINDING = concat(
    "'- **'", cell("e.title", 100), "'** ('", "e.severity", "'): '", cell("e.why_it_matters", 150), "' | evidence: '",
    _ids("e"),
)
_STEP = concat(
    "string(e.step)", "'. **'", cell("e.title", 80), "'** - '", cell("e.details", 140), "' (evidence: '", _ids("e"), "')'",
)
_TECHNIQUE = concat(
    "'- `'", _or("e.id", "N/A"), "'` '", cell("e.name", 80), "' (confidence '", two_digits("e.confidence"),
    "') evidence: '", _ids("e"),
)


def render_markdown(assessments: DataFrame) -> DataFrame:
    """``task_id, markdown``: the analyst's view of each assessment."""
    # The headings, labels and placeholders of the summary, in the order they are shown.
    lines = [
        "'# LLM Assessment Summary'", "''", "'## Executive Verdict'",
        concat("'- Status: `'", "status", "'`'"),
        concat("'- Malicious: `'", "initcap(string(verdict.is_malicious))", "'`'"),
        concat("'- Confidence: `'", two_digits("verdict.confidence"), "'`'"),
        concat("'- Severity: `'", "verdict.severity", "'`'"),
        "''", "'### Family Hypotheses'", _lines("verdict.family_hypotheses", _FAMILY, "- not observed"),
        "''", "'## Key Findings'", _lines("key_findings", _FINDING, "- not observed"),
        "''", "'## Attack Flow'", _lines("attack_flow", _STEP, "- insufficient evidence"),
        "''", "'## ATT&CK / TTP Assessment'", _lines("ttps", _TECHNIQUE, "- not observed"),
        "''", "'## IOCs'",
        *(concat(lit(f"- {kind}: "), _joined(f"slice(iocs.{kind}, 1, 10)", 90, ", ", "not observed")) for kind in IOC_KINDS),
        "''", "'## Recommended Actions'",
        *(
            concat(lit(f"- {team.upper()}: "), _joined(f"analyst_actions.{team}", 120, "; ", "not provided"))
            for team in TEAMS
        ),
        "''", "'## Uncertainties'", _lines("uncertainties", concat("'- '", cell("e", 200)), "- none"),
        "''",
    ]
    return assessments.selectExpr("task_id", f"concat_ws('\\n', {', '.join(lines)}) AS markdown")
