"""Triage of malware-sandbox reports as Spark jobs: DataFrames in, DataFrames out."""

from triagelake.operators.assessments import (
    assessment_json,
    error_assessments,
    parse_replies,
    validate_replies,
)
from triagelake.operators.detectors import detect_risks
from triagelake.operators.evidence import extract_iocs, normalize_reports, readable, unreadable
from triagelake.operators.markdown import render_markdown
from triagelake.operators.prompts import build_prompts, evidence_packages, request_payloads
from triagelake.operators.responses import classify_responses, pair_responses
from triagelake.options import TriageOptions
from triagelake.plans.job import assess, ingest_reports, prepare_requests, publish_evidence, run_triage
from triagelake.sources.outputs import attach_assessments, write_evidence, write_outputs
from triagelake.sources.reports import from_table, keyed, read_report_lines, read_reports
from triagelake.sources.session import configure

__all__ = [
    "TriageOptions", "assess", "assessment_json", "attach_assessments", "build_prompts", "classify_responses", "configure",
    "detect_risks", "error_assessments", "evidence_packages", "extract_iocs", "from_table", "ingest_reports", "keyed",
    "normalize_reports", "pair_responses", "parse_replies", "prepare_requests", "publish_evidence", "read_report_lines",
    "read_reports", "readable", "render_markdown", "request_payloads", "run_triage", "unreadable", "validate_replies",
    "write_evidence", "write_outputs",
]
