"""The whole job in two halves around the model: reports to prompts, and replies to published assessments.

Ids are given once, by ``ingest_reports``; what follows reads them from the stored table, and only what needs report text reads it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.operators.assessments import MODULE_EXCEPTION, error_assessments, validate_replies
from triagelake.operators.evidence import READABLE, normalize_reports, readable
from triagelake.operators.prompts import build_prompts, request_payloads
from triagelake.operators.responses import pair_responses
from triagelake.options import TriageOptions
from triagelake.sources.outputs import attach_assessments, stored, write_evidence, write_outputs
from triagelake.sources.reports import keyed
from triagelake.sources.session import PACKED, configure, fresh_path, remove


@dataclass(frozen=True)
class TriageResult:
    """``intermediates`` are read by ``assessments`` and ``attached``: call ``release`` when these are not needed any more."""

    assessments: DataFrame
    attached: DataFrame | None
    written: dict[str, str] = field(default_factory=dict)
    intermediates: tuple[str, ...] = ()

    def release(self) -> None:
        remove(self.assessments.sparkSession, *self.intermediates)


def ingest_reports(reports: DataFrame, path: str) -> DataFrame:
    """Store reports with an id each, so that later stages need no report text to know it."""
    configure(reports.sparkSession)
    return stored(keyed(reports), path)


def ingest_reports_bucketed(reports: DataFrame, table: str, buckets: int) -> DataFrame:
    """Store reports with an id each as a table of the warehouse bucketed by ``task_id``.

    Joins on the task id, such as attaching assessments, then read the reports where they lie: only the other, narrow side is
    shuffled to the buckets, and no report text moves.  Choose ``buckets`` so that a bucket holds some hundred MB of reports.

    The reports are dealt to their buckets first, so that each bucket is one file: else every task writes a file to every bucket.
    """
    configure(reports.sparkSession)
    dealt = keyed(reports).repartition(buckets, "task_id")
    dealt.write.mode("overwrite").option("compression", PACKED).bucketBy(buckets, "task_id").sortBy("task_id").saveAsTable(table)
    return reports.sparkSession.table(table)


def prepare_requests(
    reports: DataFrame | None, options: TriageOptions, evidence: DataFrame | None = None
) -> DataFrame | None:
    """Request payload per readable report, or None if the job is disabled or its limits are unusable.

    Pass stored ``evidence`` where there is some: then reports are not read again.
    """
    if not options.enabled or not options.usable:
        return None
    source = reports if evidence is None else evidence
    configure(source.sparkSession)
    if evidence is None:
        evidence = normalize_reports(keyed(reports), options)
    return request_payloads(build_prompts(readable(evidence), options.system_prompt_version), options)


def publish_evidence(reports: DataFrame, path: str, options: TriageOptions) -> dict[str, str]:
    """Write the evidence and all its tables; the reports are parsed once."""
    configure(reports.sparkSession)
    evidence = stored(normalize_reports(keyed(reports), options), f"{path}/evidence")
    return write_evidence(evidence, path)


def unread_tasks(evidence: DataFrame) -> DataFrame:
    """``task_id`` of the tasks none of whose reports could be read."""
    read = F.max(F.col("read_status").isin(*READABLE)).alias("read")
    return evidence.groupBy("task_id").agg(read).where("NOT read").select("task_id")


def assess(
    reports: DataFrame, responses: DataFrame, options: TriageOptions, evidence: DataFrame | None = None
) -> DataFrame:
    """One assessment per distinct task of ``reports``, whatever happened to its report and its reply.

    Where ``evidence`` is given, tasks whose report could not be read get an error assessment, even if a reply came for them.
    """
    if not options.usable:
        return error_assessments(reports.select("task_id").distinct(), *MODULE_EXCEPTION, options.metadata)
    if evidence is None:
        return validate_replies(pair_responses(reports, responses, options.provider), options.metadata)
    tasks = reports.select("task_id").distinct()
    unread = unread_tasks(evidence).withColumnRenamed("task_id", "unread_id")
    same = F.col("task_id").eqNullSafe(F.col("unread_id"))
    paired = pair_responses(tasks.join(unread, same, "left_anti"), responses, options.provider)
    failed = error_assessments(tasks.join(unread, same, "left_semi"), *MODULE_EXCEPTION, options.metadata)
    return validate_replies(paired, options.metadata).unionByName(failed)


def run_triage(
    reports: DataFrame, responses: DataFrame, options: TriageOptions, path: str | None = None,
    evidence: DataFrame | None = None, ingested: bool = False, folder: str | None = None,
) -> TriageResult | None:
    """Second half of the job; None, without any plan built, if it is disabled.

    ``ingested`` says that ``reports`` come from ``ingest_reports``: then pairing reads their ids only.  The assessments are stored in the
    shared folder (or ``folder``) before anything is published from them, so the replies are parsed once.
    """
    if not options.enabled:
        return None
    spark = configure(reports.sparkSession)
    reports = reports if ingested else keyed(reports)
    place = fresh_path(spark, "assessments", folder)
    assessments = stored(assess(reports, responses, options, evidence), place)
    written = write_outputs(assessments, path, options.store_markdown) if path else {}
    attached = attach_assessments(reports, assessments) if options.attach_to_results else None
    return TriageResult(assessments, attached, written, (place,))
