"""Run the row-local stages over arriving files.

Evidence building and reply validation work on one row at a time, so a stream needs no state, no watermark and no shuffle; the
file sink with its progress log writes each input row exactly once, also after a restart.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from triagelake.operators.assessments import validate_replies
from triagelake.operators.evidence import normalize_reports
from triagelake.operators.responses import PROVIDER, classify_responses
from triagelake.options import TriageOptions
from triagelake.sources.reports import keyed
from triagelake.sources.session import configure

REPORTS = "task_id string, raw string"
RESPONSES = "task_id string, body string, transport_error string"


def arriving(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1000) -> DataFrame:
    """Parquet files as a stream, with a bounded number of new files per batch."""
    configure(spark)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _write(rows: DataFrame, path: str, progress: str) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", progress)
        .trigger(availableNow=True).start(path)
    )


def stream_evidence(
    reports: DataFrame, path: str, progress: str, options: TriageOptions = TriageOptions()
) -> StreamingQuery:
    """Append the evidence of newly arrived reports to ``path``.

    ``progress`` is a folder that outlives the session: a restart with the same folder goes on where the stream stopped.
    """
    return _write(normalize_reports(keyed(reports), options), path, progress)


def stream_assessments(
    responses: DataFrame, path: str, progress: str, provider: str = PROVIDER, metadata: Mapping[str, str] | None = None
) -> StreamingQuery:
    """Append the assessments of newly arrived replies to ``path``."""
    return _write(validate_replies(classify_responses(responses, provider), metadata), path, progress)
