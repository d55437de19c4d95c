"""Report documents -> bounded, sanitised evidence, one row per report.

The whole stage is narrow.  Each area of the report (processes, signatures, network, ...) is read by its own guarded cast, so
a query that needs only one area prunes the others, and every list is cut before anything is built from its elements.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.functions.lists import (
    dedupe_first_seen,
    first_n,
    keep_numbered,
    numbered,
    or_empty,
    sanitize_texts,
    sorted_distinct,
)
from triagelake.functions.pyformat import spaced_json
from triagelake.functions.sql import array, case, lit, lits, struct
from triagelake.functions.text import canonical_domain, canonical_ip, canonical_url, is_hash, sanitize
from triagelake.functions.variants import (
    ANY_LIST,
    array_type,
    as_integer,
    as_list,
    display_text,
    display_text_lists,
    display_texts,
    first_truthy,
    is_record,
    kind,
    named_numbers,
    struct_type,
    truthy,
    typed_at,
)
from triagelake.operators.detectors import risk_indicators
from triagelake.options import TriageOptions

# The behaviour lists in order, with the length items are cut to and whether account names are hidden.
BEHAVIOR_LISTS = {
    "files": (256, True),
    "keys": (256, True),
    "mutexes": (256, False),
    "executed_commands": (220, True),
    "services": (256, True),
    "scheduled_tasks": (256, True),
    "injection_signals": (256, False),
}

# The traffic lists in order, with the length items are cut to and whether account names are hidden.
TRAFFIC_LISTS = {"http": (180, True), "dns": (180, True), "tcp": (160, False), "udp": (160, False)}

IOC_KINDS = ("hashes", "domains", "ips", "urls", "registry_keys", "file_paths", "mutexes")

# The report sections that evidence may be traced back to.
EVIDENCE_REFS = (
    "info", "target", "detections", "signatures", "behavior.summary", "behavior.processes", "network", "dropped",
    "procdump", "CAPE",
)

# The keys an extracted malware configuration may be stored under, the preferred one first.
CONFIG_KEYS = ("CAPE", "cape")

FILE_FIELDS = ("name", "type", "md5", "sha1", "sha256")

API_LIMIT = 12
HASH_LIMIT = 10
HIGHLIGHT_LIMIT = 10

PROCESS = struct_type(
    "process_name", "process_id", "command_line", calls=array_type(struct_type("api"))
)
SIGNATURE = struct_type("name", "severity", "description", "ttp", "mitre", families=ANY_LIST)

# Records are shown with their keys in document order, which VARIANT does not keep, so their text comes from a second reading: one for
# all of them.  The configuration keys differ by case only, so they are renamed by position.
_TRAFFIC_TEXT = f"struct<{', '.join(f'{name}: array<string>' for name in TRAFFIC_LISTS)}>"
ORDERED_TEXT = f"detections string, network {_TRAFFIC_TEXT}, {', '.join(f'{key} string' for key in CONFIG_KEYS)}"
ORDERED = f"struct<detections: string, network: {_TRAFFIC_TEXT}, {', '.join(f'config_{i}: string' for i, _ in enumerate(CONFIG_KEYS))}>"


# What became of a report's text. The parser takes neither texts nor single strings beyond its size limits nor very deep nesting.
READ, NOT_JSON, TOO_LARGE, TOO_DEEP, NOT_OBJECT = "ok", "not_json", "too_large", "too_deep", "not_object"
READABLE = (READ, NOT_OBJECT)
#: Bytes from which an unread text counts as too large: the parser's limit for one string.
LARGE = 20_000_000
#: Nesting depth of arrays and objects that the JSON reader takes at most.
DEEPEST = 1000


def nesting_depth(text: str) -> str:
    """SQL: the greatest nesting depth of brackets outside JSON strings, in linear time.

    Escaped backslashes, then escaped quotes are removed, so that the quotes left bound strings; the parts between them at even
    places lie outside strings.  Their brackets are scanned once, keeping the running and the greatest depth.
    """
    bare = f"regexp_replace(regexp_replace({text}, {lit(chr(92) * 4)}, ''), {lit(chr(92) * 2 + chr(34))}, '')"
    outside = f"array_join(filter(split({bare}, '\"'), (nd, i) -> i % 2 = 0), '')"
    brackets = f"regexp_replace({outside}, {lit('[^\\[\\]{}]')}, '')"
    step = "IF(c IN ('[', '{'), 1, IF(c IN (']', '}'), -1, 0))"
    return (f"aggregate(split({brackets}, ''), named_struct('d', 0, 'm', 0), "
            f"(a, c) -> named_struct('d', a.d + {step}, 'm', greatest(a.m, a.d + {step}))).m")


def read_reports_json(reports: DataFrame) -> DataFrame:
    """``task_id, raw, doc, read_status`` of each report.

    A text with bare NaN or Infinity, which Python writes by default, is read again with these quoted.  An unread text is
    ``too_large`` beyond ``LARGE`` bytes, ``too_deep`` when its brackets nest deeper than ``DEEPEST`` outside strings, else
    ``not_json`` (missing, cut or broken).  Valid JSON that is no object holds no evidence, but is no failure.
    """
    spelled = "doc_0 IS NULL AND (contains(raw, 'NaN') OR contains(raw, 'Infinity'))"
    first = reports.selectExpr("task_id", "raw", "try_parse_json(raw) AS doc_0")
    named = first.selectExpr("task_id", f"{case((spelled, named_numbers('raw')), otherwise='raw')} AS raw", "doc_0")
    doc = case(("doc_0 IS NULL", "try_parse_json(raw)"), otherwise="doc_0")
    read = named.selectExpr("task_id", "raw", f"{doc} AS doc")
    status = case(
        (f"doc IS NULL AND octet_length(raw) > {LARGE}", lit(TOO_LARGE)),
        (f"doc IS NULL AND {nesting_depth('raw')} > {DEEPEST}", lit(TOO_DEEP)), ("doc IS NULL", lit(NOT_JSON)),
        (is_record("doc"), lit(READ)), otherwise=lit(NOT_OBJECT),
    )
    return read.selectExpr("task_id", "raw", "doc", f"{status} AS read_status")


def _areas(reports: DataFrame) -> DataFrame:
    """Guarded view of each report area; a wrongly typed node is NULL."""
    file = struct_type(*FILE_FIELDS)
    areas = {
        "info": typed_at("doc", "$.info", struct_type("id", "category")),
        "target": typed_at("doc", "$.target", struct_type("category", file=file)),
        "malscore": typed_at("doc", "$.malscore", "variant"),
        "raw_detections": typed_at("doc", "$.detections", "variant"),
        **{f"config_{i}": typed_at("doc", f"$.{key}", "variant") for i, key in enumerate(CONFIG_KEYS)},
        **{f"raw_{name}": typed_at("doc", f"$.behavior.summary.{name}", ANY_LIST) for name in BEHAVIOR_LISTS},
        "raw_processes": typed_at("doc", "$.behavior.processes", array_type(PROCESS)),
        "raw_signatures": typed_at("doc", "$.signatures", array_type(SIGNATURE)),
        "raw_domains": typed_at("doc", "$.network.domains", array_type(struct_type("domain"))),
        "raw_hosts": typed_at("doc", "$.network.hosts", array_type(struct_type("ip"))),
        "raw_requests": typed_at("doc", "$.network.http", array_type(struct_type("uri", "url"))),
        **{f"raw_{name}": typed_at("doc", f"$.network.{name}", ANY_LIST) for name in TRAFFIC_LISTS},
        "ordered": f"cast(from_json(raw, '{ORDERED_TEXT}') AS {ORDERED})",
    }
    return read_reports_json(reports).selectExpr("task_id", "read_status", *_named(areas))


def _named(expressions: dict[str, str]) -> list[str]:
    return [f"{expression} AS {name}" for name, expression in expressions.items()]


def _with(rows: DataFrame, **expressions: str) -> DataFrame:
    return rows.selectExpr("*", *_named(expressions))


def _process_texts(item: str) -> str:
    calls = first_n(f"filter({item}.calls, c -> {truthy('c.api')})", API_LIMIT)
    return struct(
        process_id=f"{item}.process_id",
        texts=display_text_lists(
            array(f"{item}.process_name", f"{item}.command_line"), f"transform({calls}, c -> c.api)"
        ),
    )


def _process(item: str, at: str, options: TriageOptions) -> str:
    return struct(
        id=numbered("proc_", at),
        process_name=sanitize(f"{item}.texts[0][0]", 120, redact=False),
        pid=as_integer(f"{item}.process_id"),
        suspicious_api_calls=or_empty(f"transform({item}.texts[1], api -> {sanitize('api', 80, redact=False)})"),
        command_line=sanitize(f"{item}.texts[0][1]", 220, options.redact_pii),
    )


def _signature_texts(item: str) -> str:
    techniques = as_list(first_truthy(f"{item}.ttp", f"{item}.mitre"))
    return struct(
        severity=f"{item}.severity",
        texts=display_text_lists(array(f"{item}.name", f"{item}.description"), f"{item}.families", techniques),
    )


def _signature(item: str, at: str, options: TriageOptions) -> str:
    return struct(
        id=numbered("sig_", at),
        name=sanitize(f"{item}.texts[0][0]", 120, redact=False),
        severity=f"coalesce({item}.severity, parse_json('1'))",
        description=sanitize(f"{item}.texts[0][1]", 320, options.redact_pii),
        families=sanitize_texts(f"{item}.texts[1]", 80, False, 8),
        ttp=sanitize_texts(f"{item}.texts[2]", 30, False, 8),
    )


def _behavior(areas: DataFrame, options: TriageOptions) -> DataFrame:
    areas = _with(areas, behavior_texts=display_text_lists(*(f"raw_{name}" for name in BEHAVIOR_LISTS)))
    return _with(areas, behavior_summary=struct(**{
        name: sanitize_texts(f"behavior_texts[{at}]", size, redact and options.redact_pii, options.max_input_events)
        for at, (name, (size, redact)) in enumerate(BEHAVIOR_LISTS.items())
    }))


def _processes(areas: DataFrame, options: TriageOptions) -> DataFrame:
    built = keep_numbered(
        "raw_processes", _process_texts, lambda item, at: _process(item, at, options), options.max_processes
    )
    return _with(areas, process_highlights=or_empty(built))


def _signatures(areas: DataFrame, options: TriageOptions) -> DataFrame:
    built = keep_numbered(
        "raw_signatures", _signature_texts, lambda item, at: _signature(item, at, options), options.max_signatures
    )
    return _with(areas, signatures=or_empty(built))


def _field(values: str, name: str) -> str:
    """One field of each record that has it."""
    return f"transform(filter({values}, r -> {truthy(f'r.{name}')}), r -> r.{name})"


def _indicators(values: str, limit: int) -> str:
    """Sorted distinct indicators of canonical network values, which are cut before repeats are dropped.

    The values are sanitised already, so only length and outer blanks can differ from the stored indicator.
    """
    kept = or_empty(first_n(f"filter({values}, nv -> nv <> '')", limit))
    return sorted_distinct(dedupe_first_seen(f"transform({kept}, nv -> substring(trim(nv), 1, 260))"))


def _iocs(areas: DataFrame, options: TriageOptions) -> DataFrame:
    limit = options.max_network_artifacts
    urls = f"transform(filter(raw_requests, r -> r IS NOT NULL), r -> {first_truthy('r.uri', 'r.url')})"
    areas = _with(
        areas,
        file_texts=display_texts(array(*(f"target.file.{name}" for name in FILE_FIELDS))),
        network_texts=display_text_lists(_field("raw_domains", "domain"), _field("raw_hosts", "ip"), urls),
    )
    hashes = sanitize_texts("slice(file_texts, 3, 3)", 256, False, HASH_LIMIT)
    network = {
        name: _indicators(f"transform(network_texts[{at}], nt -> {canonical('nt')})", limit)
        for at, (name, canonical) in enumerate(
            (("domains", canonical_domain), ("ips", canonical_ip), ("urls", canonical_url))
        )
    }
    return _with(areas, ioc_candidates=struct(
        hashes=sorted_distinct(f"transform(filter({hashes}, h -> {is_hash('h')}), h -> lower(h))"),
        **network,
        registry_keys=sorted_distinct("behavior_summary.keys"),
        file_paths=sorted_distinct("behavior_summary.files"),
        mutexes=sorted_distinct("behavior_summary.mutexes"),
    ))


def _network(areas: DataFrame, options: TriageOptions) -> DataFrame:
    values = array(*(f"raw_{name}" for name in TRAFFIC_LISTS))
    ordered = array(*(f"ordered.network.{name}" for name in TRAFFIC_LISTS))
    shown = f"zip_with({values}, {ordered}, (vs, ts) -> zip_with(vs, ts, (v, t) -> {display_text('v', 't')}))"
    areas = _with(areas, traffic_texts=shown)
    traffic = {
        name: sanitize_texts(
            f"traffic_texts[{at}]", size, redact and options.redact_pii, options.max_network_artifacts
        )
        for at, (name, (size, redact)) in enumerate(TRAFFIC_LISTS.items())
    }
    highlight = struct(id=numbered("net_", "i"), type="'domain'", value="d")
    return _with(
        areas,
        network_summary=struct(domains="ioc_candidates.domains", hosts="ioc_candidates.ips", **traffic),
        network_highlights=f"transform({first_n('ioc_candidates.domains', HIGHLIGHT_LIMIT)}, (d, i) -> {highlight})",
    )


def _records_only(value: str, text: str) -> str:
    """JSON text of an object in document order, ``{}`` for anything else."""
    return case((is_record(value), spaced_json(text)), otherwise="'{}'")


def _config() -> str:
    """JSON text of the extracted configuration: the preferred key if it holds a non-empty object, else the other one."""
    filled = f"{is_record('config_0')} AND {kind('config_0')} <> 'OBJECT<>'"
    return case((filled, spaced_json("ordered.config_0")), otherwise=_records_only("config_1", "ordered.config_1"))


def behavior_entries(reports: DataFrame) -> DataFrame:
    """row, task_id, kind, pos (from 1), text: every entry of the seven behaviour lists of every report as display text, one row per
    entry.  ``row`` tells reports apart, also those that repeat a task_id.  Nothing is cleaned, dropped or cut: this is the long
    input of ``long_evidence.first_distinct``."""
    texts = display_text_lists(*(f"raw_{name}" for name in BEHAVIOR_LISTS))
    labelled = ", ".join(
        f"transform(coalesce(bt[{at}], array()), (v, i) -> named_struct('kind', '{name}', 'pos', i + 1, 'text', v))"
        for at, name in enumerate(BEHAVIOR_LISTS))
    areas = _areas(reports).select(F.monotonically_increasing_id().alias("row"), "task_id", F.expr(texts).alias("bt"))
    return areas.selectExpr("row", "task_id", f"explode(concat({labelled})) AS e").selectExpr("row", "task_id", "e.kind", "e.pos",
                                                                                           "e.text")


def ioc_entries(reports: DataFrame) -> DataFrame:
    """row, task_id, kind, pos (from 1), text: the entries that indicators are made of, one row each, from one reading of each report:
    ``keys``, ``files``, ``mutexes`` (display text), ``hashes`` (the md5, sha1 and sha256 of the target file) and ``domains``,
    ``ips``, ``urls`` (canonical, as the row form makes them).  Nothing is dropped, cut or cleaned."""
    urls = f"transform(filter(raw_requests, r -> r IS NOT NULL), r -> {first_truthy('r.uri', 'r.url')})"
    lists = {
        **{name: f"lt[{at}]" for at, name in enumerate(("keys", "files", "mutexes"))},
        "hashes": f"slice({display_texts(array(*(f'target.file.{name}' for name in FILE_FIELDS)))}, 3, 3)",
        **{name: f"transform(nt[{at}], cv -> {canonical('cv')})"
           for at, (name, canonical) in enumerate((("domains", canonical_domain), ("ips", canonical_ip), ("urls", canonical_url)))},
    }
    labelled = ", ".join(
        f"transform(coalesce({values}, array()), (v, i) -> named_struct('kind', '{name}', 'pos', i + 1, 'text', v))"
        for name, values in lists.items())
    areas = _areas(reports).select(
        F.monotonically_increasing_id().alias("row"), "task_id", "target",
        F.expr(display_text_lists(*(f"raw_{name}" for name in ("keys", "files", "mutexes")))).alias("lt"),
        F.expr(display_text_lists(_field("raw_domains", "domain"), _field("raw_hosts", "ip"), urls)).alias("nt"))
    return areas.selectExpr("row", "task_id", f"explode(concat({labelled})) AS e").selectExpr("row", "task_id", "e.kind", "e.pos",
                                                                                           "e.text")


def normalize_reports(reports: DataFrame, options: TriageOptions = TriageOptions()) -> DataFrame:
    """Evidence of each report. ``reports`` needs ``task_id`` and the report JSON in ``raw``.

    ``read_status`` tells whether the evidence stands for the report; unless it is one of READABLE, the report could not be read, its
    evidence is empty, and no request must be made of it.
    """
    areas = _areas(reports)
    for step in (_behavior, _processes, _signatures, _iocs, _network):
        areas = step(areas, options)
    columns = {
        "sample": struct(
            task_id="info.id",
            category=first_truthy("info.category", "target.category"),
            submitted_filename=sanitize("file_texts[0]", 120, redact=False),
            sha256="target.file.sha256", sha1="target.file.sha1", md5="target.file.md5",
            type=sanitize("file_texts[1]", 120, redact=False),
        ),
        "high_level_scores": struct(
            malscore="malscore",
            signature_count="coalesce(array_size(raw_signatures), 0)",
            process_count="coalesce(array_size(raw_processes), 0)",
        ),
        "detections": _records_only("raw_detections", "ordered.detections"),
        **{name: name for name in (
            "behavior_summary", "process_highlights", "network_summary", "network_highlights", "signatures",
        )},
        "config_extraction": _config(),
        "ioc_candidates": "ioc_candidates",
        "risk_indicators": "risk_indicators",
        "raw_evidence_refs": f"array({lits(*EVIDENCE_REFS)})",
    }
    return risk_indicators(areas).selectExpr("task_id", "read_status", *_named(columns))


def extract_iocs(evidence: DataFrame) -> DataFrame:
    """``task_id`` and the indicator candidates by kind, from evidence, stored or not."""
    return evidence.selectExpr("task_id", "ioc_candidates.*")


def readable(evidence: DataFrame) -> DataFrame:
    """Evidence of the reports that could be read."""
    return evidence.where(F.col("read_status").isin(*READABLE))


def unreadable(evidence: DataFrame) -> DataFrame:
    """``task_id, read_status`` of the reports that could not be read: what to look at by hand."""
    return evidence.where(~F.col("read_status").isin(*READABLE)).select("task_id", "read_status")
