"""Model reply text -> assessment of a fixed schema, exactly one row per input row."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.functions.lists import or_empty, sanitize_texts, sorted_distinct
from triagelake.functions.sql import array, case, let, lit, lits, struct
from triagelake.functions.text import attack_id, sanitize, severity_label
from triagelake.functions.variants import (
    ANY_LIST,
    array_type,
    as_integer,
    confidence,
    display_text_lists,
    display_texts,
    strict_json,
    strip,
    struct_type,
    truthy,
    typed_at,
)
from triagelake.operators.evidence import IOC_KINDS
from triagelake.operators.responses import BROKEN, FAILED, OK
from triagelake.operators.tables import exploded, kind_rows

# The teams that actions are meant for, and the model metadata fields with the length each is cut to.
TEAMS = ("soc", "ir", "reverse")
METADATA = {"provider": 60, "model": 80, "prompt_version": 30}

# Error types, messages and the note that error assessments carry.
INVALID_JSON = ("invalid_json", "Model output could not be parsed as JSON.")
CALL_FAILED = ("llm_invocation_failed", "LLM invocation failed: ")
MODULE_EXCEPTION = ("module_exception", "llm_assessment internal exception")
DEGRADED = "LLM assessment degraded due to upstream error."

ASSESSMENT_COLUMNS = (
    "status", "error_type", "message", "verdict", "observed_facts", "attack_flow", "ttps", "iocs", "key_findings",
    "analyst_actions", "uncertainties", "model_metadata",
)


def default_assessment() -> dict[str, Any]:
    """An assessment in which nothing was stated; prompts show it as the expected schema."""
    # The keys and empty values of an assessment.
    return {
        "status": "ok",
        "error_type": "",
        "message": "",
        "verdict": {"is_malicious": False, "confidence": 0.0, "severity": "unknown", "category": [], "family_hypotheses": []},
        "observed_facts": [],
        "attack_flow": [],
        "ttps": [],
        "iocs": {kind: [] for kind in IOC_KINDS},
        "key_findings": [],
        "analyst_actions": {team: [] for team in TEAMS},
        "uncertainties": [],
        "model_metadata": {name: "" for name in METADATA},
    }


def _entries(*fields: str) -> str:
    return array_type(struct_type(*fields, evidence_ids=ANY_LIST))


REPLY = struct_type(
    "status", "error_type", "message",
    verdict=struct_type(
        "is_malicious", "confidence", "severity",
        category=ANY_LIST,
        family_hypotheses=_entries("name", "confidence", "reason"),
    ),
    observed_facts=_entries("title", "summary"),
    attack_flow=_entries("title", "details", "step"),
    key_findings=_entries("title", "why_it_matters", "severity"),
    ttps=_entries("id", "name", "reason", "confidence"),
    iocs=struct_type(**{kind: ANY_LIST for kind in IOC_KINDS}),
    analyst_actions=struct_type(**{team: ANY_LIST for team in TEAMS}),
    uncertainties=ANY_LIST,
    model_metadata=struct_type(*METADATA),
)


def json_blob(content: str) -> str:
    """The part of a reply that should be the JSON object.

    The first fenced block counts, else the whole text; within it, everything from the first ``{`` to the last ``}``, or all
    of it without such a pair.  Positions are found by ``locate``, in linear time whatever the text holds.
    """
    fence = lit(r"(?is)```(?:json)?(.*?)```")
    inner = let("whole", strip(content), case(
        (f"contains(whole, '```') AND whole RLIKE {fence}", strip(f"regexp_extract(whole, {fence}, 1)")), otherwise="whole",
    ))
    span = "named_struct('first', locate('{', part), 'last', length(part) - locate('}', reverse(part)) + 1)"
    braced = case(
        ("s.first > 0 AND contains(part, '}') AND s.last > s.first", "substring(part, s.first, s.last - s.first + 1)"),
        otherwise="part",
    )
    whole = "startswith(part, '{') AND endswith(part, '}')"
    return let("part", inner, case((whole, "part"), otherwise=let("s", span, braced)))


Built = Callable[[str, str], dict[str, str]]


def _entries_of(
    values: str, texts: dict[str, int | None], raw: tuple[str, ...], build: Built, order: tuple[str, ...]
) -> str:
    """Records of a list: ``texts`` become sanitised text of the given length, ``build`` makes the other fields.

    Entries that are no records are dropped first.  Texts and evidence ids are converted in one step and named, so that
    later steps may use them more than once.
    """
    shown = struct(
        **{name: f"v.{name}" for name in raw},
        texts=display_text_lists(array(*(f"v.{name}" for name in texts)), "v.evidence_ids"),
    )
    fields = {
        name: f"v.texts[0][{at}]" if size is None else sanitize(f"v.texts[0][{at}]", size, redact=False)
        for at, (name, size) in enumerate(texts.items())
    }
    fields = {**fields, **build("v", "i"), "evidence_ids": sanitize_texts("v.texts[1]", 60, redact=False)}
    entry = struct(**{name: fields[name] for name in order})
    kept = f"filter({values}, v -> v IS NOT NULL)"
    return f"transform(transform({kept}, v -> {shown}), (v, i) -> {entry})"


def _confidence(v: str, i: str) -> dict[str, str]:
    return {"confidence": confidence(f"{v}.confidence")}


def _families(values: str) -> str:
    return or_empty(_entries_of(
        values, {"name": 80, "reason": 180}, ("confidence",), _confidence, ("name", "confidence", "reason", "evidence_ids")
    ))


def _facts(values: str) -> str:
    return or_empty(_entries_of(
        values, {"title": 120, "summary": 220}, (), lambda v, i: {}, ("title", "summary", "evidence_ids")
    ))


def _flow(values: str) -> str:
    """Steps keep a stated non-zero number, else take their position among the kept entries."""
    return or_empty(_entries_of(
        values, {"title": 120, "details": 220}, ("step",),
        lambda v, i: {"step": f"coalesce(nullif({as_integer(f'{v}.step')}, 0L), bigint({i} + 1))"},
        ("step", "title", "details", "evidence_ids"),
    ))


def _findings(values: str) -> str:
    return or_empty(_entries_of(
        values, {"title": 120, "why_it_matters": 220, "severity": None}, (),
        lambda v, i: {"severity": severity_label(f"{v}.texts[0][2]")},
        ("title", "severity", "why_it_matters", "evidence_ids"),
    ))


def _techniques(values: str) -> str:
    """Techniques whose id is empty or well formed."""
    entries = _entries_of(
        values, {"id": None, "name": 80, "reason": 180}, ("confidence",),
        lambda v, i: {"id": attack_id(f"{v}.texts[0][0]"), **_confidence(v, i)},
        ("id", "name", "confidence", "reason", "evidence_ids"),
    )
    return or_empty(f"filter({entries}, t -> t.id IS NOT NULL)")


def validate_replies(rows: DataFrame, metadata: Mapping[str, str] | None = None) -> DataFrame:
    """Assessment of each row of ``task_id, outcome, error, content``.

    ``metadata`` (provider, model, prompt_version) overrides what a reply claims about itself; without it the claims stand.
    """
    blobs = rows.selectExpr(
        "task_id", "outcome", "error", f"{case((f'outcome = {lit(OK)}', json_blob('content')))} AS blob"
    )
    parsed = blobs.selectExpr("task_id", "outcome", "error", f"{strict_json('blob')} AS doc")
    outcome = case((f"outcome = {lit(OK)} AND doc IS NULL", "'invalid'"), otherwise="outcome")
    typed = parsed.selectExpr("task_id", "error", f"{outcome} AS outcome", f"{typed_at('doc', '$', REPLY)} AS reply")
    heads = array(
        "reply.status", "reply.error_type", "reply.message", "reply.verdict.severity",
        *(f"reply.model_metadata.{name}" for name in METADATA),
    )
    iocs = [f"reply.iocs.{kind}" for kind in IOC_KINDS]
    actions = [f"reply.analyst_actions.{team}" for team in TEAMS]
    labels = display_text_lists("reply.verdict.category", "reply.uncertainties", *iocs, *actions)
    texts = typed.selectExpr("*", f"{display_texts(heads)} AS heads", f"{labels} AS labels")

    def head(at: int, size: int) -> str:
        return sanitize(f"heads[{at}]", size, redact=False)

    def label(at: int, size: int) -> str:
        return sanitize_texts(f"labels[{at}]", size, redact=False)

    ok = f"outcome = {lit(OK)}"
    stated = {name: lit(str(metadata[name])) for name in METADATA if metadata and name in metadata}
    columns = {
        "status": case((f"NOT {ok}", "'error'"), otherwise=f"coalesce(nullif({head(0, 16)}, ''), 'ok')"),
        "error_type": case((ok, head(1, 48)), *_errors(0), otherwise=lit(MODULE_EXCEPTION[0])),
        "message": case((ok, head(2, 200)), *_errors(1), otherwise=lit(MODULE_EXCEPTION[1])),
        "verdict": struct(
            is_malicious=truthy("reply.verdict.is_malicious"),
            confidence=confidence("reply.verdict.confidence"),
            severity=severity_label("heads[3]"),
            category=label(0, 60),
            family_hypotheses=_families("reply.verdict.family_hypotheses"),
        ),
        "observed_facts": _facts("reply.observed_facts"),
        "attack_flow": _flow("reply.attack_flow"),
        "ttps": _techniques("reply.ttps"),
        "iocs": struct(**{kind: sorted_distinct(label(2 + at, 280)) for at, kind in enumerate(IOC_KINDS)}),
        "key_findings": _findings("reply.key_findings"),
        "analyst_actions": struct(**{team: label(2 + len(IOC_KINDS) + at, 200) for at, team in enumerate(TEAMS)}),
        "uncertainties": case((ok, label(1, 220)), otherwise=f"array({lits(DEGRADED)})"),
        "model_metadata": struct(**{
            name: sanitize(stated.get(name, f"heads[{4 + at}]"), size, redact=False)
            for at, (name, size) in enumerate(METADATA.items())
        }),
    }
    return texts.selectExpr("task_id", *(f"{columns[name]} AS {name}" for name in ASSESSMENT_COLUMNS))


def _errors(part: int) -> list[tuple[str, str]]:
    """Type (0) or message (1) of the errors that have a known cause."""
    failed = (lit(CALL_FAILED[0]), sanitize(f"concat({lit(CALL_FAILED[1])}, error)", 180, redact=False))
    return [("outcome = 'invalid'", lit(INVALID_JSON[part])), (f"outcome = {lit(FAILED)}", failed[part])]


def parse_replies(contents: DataFrame, metadata: Mapping[str, str] | None = None) -> DataFrame:
    """Assessment of plain reply texts: ``task_id, content``, without an envelope around them."""
    rows = contents.selectExpr("task_id", f"{lit(OK)} AS outcome", "'' AS error", "coalesce(content, '') AS content")
    return validate_replies(rows, metadata)


def error_assessments(
    tasks: DataFrame, error_type: str, message: str, metadata: Mapping[str, str] | None = None
) -> DataFrame:
    """The same error assessment for every task."""
    rows = tasks.selectExpr("task_id", f"{lit(BROKEN)} AS outcome", "'' AS error", "'' AS content")
    return validate_replies(rows, metadata).withColumns({
        "error_type": F.expr(sanitize(lit(error_type), 48, redact=False)),
        "message": F.expr(sanitize(lit(message), 180, redact=False)),
    })


def assessment_json(assessments: DataFrame) -> DataFrame:
    """``task_id`` and the assessment as one JSON object."""
    packed = F.struct(*(F.col(name) for name in ASSESSMENT_COLUMNS))
    return assessments.select("task_id", F.to_json(packed, {"ignoreNullFields": "false"}).alias("json"))


def spread_entries(assessments: DataFrame, column: str, fields: tuple[str, ...]) -> DataFrame:
    """One row per entry of a list column of the assessment."""
    return exploded(assessments, column).selectExpr("task_id", "pos", *(
        f"array_join(item.{name}, '|') AS {name}" if name == "evidence_ids" else f"item.{name}" for name in fields
    ))


def spread_lists(assessments: DataFrame, column: str, names: tuple[str, ...]) -> DataFrame:
    """One row per value of a struct of string lists."""
    return kind_rows(assessments, column, names)
