"""Flat tables published from evidence: one row per artefact, process, signature, indicator or finding."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.operators.evidence import BEHAVIOR_LISTS, IOC_KINDS


def exploded(rows: DataFrame, values: str) -> DataFrame:
    """One row per entry of an array: ``task_id``, the 1-based ``pos`` and the ``item``.

    The positions are put into the array.  For ``posexplode`` of a bare column Spark would infer a "not empty" filter and push
    it to the scan, with the whole computation of the array inlined, which then runs twice or more.
    """
    placed = f"transform({values}, (v, i) -> named_struct('pos', i + 1, 'item', v))"
    return rows.selectExpr("task_id", f"explode({placed}) AS entry").selectExpr("task_id", "entry.pos", "entry.item")


def _fields(rows: DataFrame, *fields: str) -> DataFrame:
    return rows.selectExpr("task_id", "pos", *(f"item.{name}" for name in fields))


def kind_rows(rows: DataFrame, record: str, names: tuple[str, ...]) -> DataFrame:
    """One row per value of a struct of lists; the struct is read once for all its lists."""
    labelled = ", ".join(
        f"transform({record}.{name}, (v, i) -> named_struct('kind', '{name}', 'pos', i + 1, 'value', v))" for name in names
    )
    return rows.selectExpr("task_id", f"explode(concat({labelled})) AS item").selectExpr(
        "task_id", "item.kind", "item.pos", "item.value"
    )


def samples(evidence: DataFrame) -> DataFrame:
    fields = ("task_id", "category", "submitted_filename", "sha256", "sha1", "md5", "type")
    return evidence.select(
        "task_id",
        *(F.col(f"sample.{name}").cast("string").alias("sample_id" if name == "task_id" else name) for name in fields),
        "detections", "config_extraction",
        F.array_join("raw_evidence_refs", "|").alias("evidence_refs"),
    )


def scores(evidence: DataFrame) -> DataFrame:
    return evidence.select(
        "task_id",
        F.col("high_level_scores.malscore").cast("string").alias("malscore"),
        F.col("high_level_scores.signature_count").alias("signature_count"),
        F.col("high_level_scores.process_count").alias("process_count"),
    )


def behavior_artifacts(evidence: DataFrame) -> DataFrame:
    return kind_rows(evidence, "behavior_summary", tuple(BEHAVIOR_LISTS))


def iocs(evidence: DataFrame) -> DataFrame:
    return kind_rows(evidence, "ioc_candidates", IOC_KINDS)


def network_summary(evidence: DataFrame) -> DataFrame:
    return kind_rows(evidence, "network_summary", ("domains", "hosts", "http", "dns", "tcp", "udp"))


def process_highlights(evidence: DataFrame) -> DataFrame:
    rows = exploded(evidence, "process_highlights")
    return _fields(rows, "id", "process_name", "pid", "suspicious_api_calls", "command_line").withColumn(
        "suspicious_api_calls", F.array_join("suspicious_api_calls", "|")
    )


def process_apis(evidence: DataFrame) -> DataFrame:
    rows = exploded(evidence, "process_highlights")
    calls = rows.select(
        "task_id", F.col("item.id").alias("process_id"), F.posexplode("item.suspicious_api_calls").alias("call_pos", "api")
    )
    return calls.withColumn("call_pos", F.col("call_pos") + 1)


def signatures(evidence: DataFrame) -> DataFrame:
    rows = _fields(
        exploded(evidence, "signatures"), "id", "name", "severity", "description", "families", "ttp"
    )
    return rows.withColumns({
        "severity": F.col("severity").cast("string"),
        "families": F.array_join("families", "|"),
        "ttp": F.array_join("ttp", "|"),
    })


def network_highlights(evidence: DataFrame) -> DataFrame:
    return _fields(exploded(evidence, "network_highlights"), "id", "type", "value")


def risks(evidence: DataFrame) -> DataFrame:
    return _fields(
        exploded(evidence, "risk_indicators"), "id", "title", "severity", "reason", "evidence_ref"
    )
