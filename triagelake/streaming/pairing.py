"""Pairing tasks with replies on streams: state over event time, one assessment per task at its deadline.

Tasks (``task_id, sent_at``) and replies (``task_id, body, transport_error``, optional ``transport_detail``, ``received_at``) arrive as
two streams.  Replies are classified where they arrive (no state), then both become one stream of events keyed by task, with a
watermark ``lateness`` behind the latest event time.  The state of a task holds its request time, the number of replies and the best
reply so far, by the same code as the batch form (``best_replies``): rank of the outcome, then a checksum of the reply.

Tasks are kept in ``buckets`` by a hash of their id: Spark calls Python once per bucket and batch, which costs about as much as a
call per task would for each of them.  A bucket holds only its live tasks, as one JSON text, rewritten when any of them changes; more
buckets make it smaller.  Their number belongs to the progress folder like the state itself and must not change between restarts.

A reply counts if its ``received_at`` is at most ``sent_at + reply_timeout``, the task's deadline.  When the watermark passes the deadline, an event-time timer (the earliest of the bucket), or rows that come for the
bucket, emit the pairing: the best reply, or ``failed`` with ``no_response`` if none counted; ``dropped`` is the number of further replies that counted.  The state then stays as a tombstone (without the reply)
until the watermark passes the deadline by ``reply_timeout`` once more, so that a repeated task or a late reply in that time changes
nothing; rows older than the watermark are dropped by Spark.  Replies whose task has not come yet wait for it in the state (judged
when it comes) for two timeouts after the first of them; a reply for a task that never comes is dropped with its state.  A task without an id is never paired (its key cannot be followed).

The stream is exactly once with a file sink and a progress folder: a restart resumes the state, the timers and the sink's log.  If all
replies come within the timeout and the stream is read in time order, the result equals ``pair_responses`` on the same rows.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from triagelake.operators.assessments import validate_replies
from triagelake.operators.responses import FAILED, NO_RESPONSE, PROVIDER, RANKS, classify_responses

PAIRED = "task_id string, outcome string, error string, details string, content string, dropped long"
#: The state of a bucket of tasks: JSON, task_id to its fields in the order of ``_FRESH``.
STATE = "tasks string"
#: sent, first (event time of the first waiting reply), code, outcome, error, details, content, count, emitted, waiting
_FRESH = (None, None, None, None, None, None, None, 0, False)
BUCKETS = 4096


def _code() -> F.Column:
    rank = F.element_at(F.create_map(*(F.lit(x) for pair in RANKS.items() for x in pair)), F.col("outcome"))
    checksum = F.xxhash64("error", "details", "content")
    return F.shiftleft(rank.cast("long"), 60).bitwiseOR(F.shiftrightunsigned(checksum, 4))


def events(tasks: DataFrame, replies: DataFrame, provider: str = PROVIDER) -> DataFrame:
    """One stream of task and reply events: task_id, at (event time), kind, outcome, error, details, content, code."""
    none = F.lit(None).cast("string")
    asked = tasks.where(F.col("task_id").isNotNull()).select(
        "task_id", F.col("sent_at").cast("timestamp").alias("at"), F.lit("task").alias("kind"), none.alias("outcome"),
        none.alias("error"), none.alias("details"), none.alias("content"), F.lit(0).cast("long").alias("code"))
    detail = F.col("transport_detail") if "transport_detail" in replies.columns else none
    # The event time passes through classification as part of the key.
    keyed = replies.where(F.col("task_id").isNotNull()).select(
        F.struct("task_id", F.col("received_at").cast("timestamp").alias("at")).alias("task_id"), "body", "transport_error",
        detail.alias("transport_detail"))
    found = classify_responses(keyed, provider)
    answered = found.select(F.col("task_id.task_id").alias("task_id"), F.col("task_id.at").alias("at"), F.lit("reply").alias("kind"),
                            "outcome", "error", "details", "content", _code().alias("code"))
    return asked.unionByName(answered)


def pair_stream(tasks: DataFrame, replies: DataFrame, reply_timeout_s: int = 600, provider: str = PROVIDER, buckets: int = BUCKETS,
                with_content: bool = True) -> DataFrame:
    """Streaming pairing: one row (``PAIRED``) per task, emitted when the watermark passes its deadline.

    Without ``with_content`` the texts of the replies are neither shuffled nor kept in the state, and ``content`` is null.
    """
    timeout_ms = reply_timeout_s * 1000

    def until(task: list) -> int:
        sent, first, emitted = task[0], task[1], task[8]
        return first + 2 * timeout_ms if sent is None else sent + (2 if emitted else 1) * timeout_ms

    def judge(task: list, reply: tuple) -> None:
        ms, code = reply[:2]
        if ms <= task[0] + timeout_ms:
            task[7] += 1
            if task[2] is None or code < task[2]:
                task[2:7] = reply[1:]

    def take(held: dict[str, list], batches: Iterator[pd.DataFrame]) -> set[str]:
        """The rows of one batch, tasks before replies; returns the tasks that had rows."""
        asked: dict[str, int] = {}
        answers = []
        for rows in batches:
            for task_id, kind, ms, *reply in zip(*(rows[c].tolist() for c in (
                    "task_id", "kind", "ms", "code", "outcome", "error", "details", "content"))):
                if kind == "task":
                    asked[task_id] = min(ms, asked.get(task_id, ms))
                else:
                    answers.append((task_id, (ms, *reply)))
        for task_id, ms in asked.items():
            task = held.setdefault(task_id, [*_FRESH, []])
            if task[0] is None:
                task[0] = ms
                for reply in task[9]:
                    judge(task, reply)
                task[9] = []
        for task_id, reply in answers:
            task = held.setdefault(task_id, [*_FRESH, []])
            if task[8]:
                continue
            if task[0] is not None:
                judge(task, reply)
            else:
                task[9].append(reply)
                task[1] = reply[0] if task[1] is None else min(task[1], reply[0])
        return {*asked, *(task_id for task_id, _ in answers)}

    def pair(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {}
        touched = set() if state.hasTimedOut else take(held, batches)
        watermark = state.getCurrentWatermarkMs()
        found = []
        for task_id in [t for t, task in held.items() if until(task) < watermark]:
            task = held[task_id]
            if task[0] is not None and not task[8]:
                best = (FAILED, NO_RESPONSE, None, None) if task[2] is None else task[3:7]
                found.append((task_id, *best, max(task[7] - 1, 0)))
                task[2:7], task[8] = [None] * 5, True
            elif task_id not in touched:
                del held[task_id]
        if held:
            state.update((json.dumps(held),))
            state.setTimeoutTimestamp(max(min(map(until, held.values())), watermark + 1))
        elif state.exists:
            state.remove()
        if found:
            yield pd.DataFrame(found, columns=["task_id", "outcome", "error", "details", "content", "dropped"])

    rows = events(tasks, replies, provider)
    if not with_content:
        rows = rows.withColumn("content", F.lit(None).cast("string"))
    rows = rows.withColumns({"ms": F.unix_millis("at"), "bucket": F.pmod(F.xxhash64("task_id"), F.lit(buckets))})
    return (rows.withWatermark("at", f"{reply_timeout_s} seconds").groupBy("bucket")
            .applyInPandasWithState(pair, PAIRED, STATE, "append", GroupStateTimeout.EventTimeTimeout))


def stream_paired_assessments(tasks: DataFrame, replies: DataFrame, path: str, progress: str, reply_timeout_s: int = 600,
                              provider: str = PROVIDER, metadata: Mapping[str, str] | None = None,
                              available_now: bool = True) -> StreamingQuery:
    """Append one assessment per task to ``path`` (Parquet) once its deadline has passed; ``progress`` outlives the session."""
    paired = pair_stream(tasks, replies, reply_timeout_s, provider)
    writer = validate_replies(paired, metadata).writeStream.format("parquet").outputMode("append").option("checkpointLocation", progress)
    return (writer.trigger(availableNow=True) if available_now else writer).start(path)
