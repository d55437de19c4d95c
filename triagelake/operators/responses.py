"""Model replies: classify transport results and pair them with reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from triagelake.functions.sql import case, let, lit, lits, struct
from triagelake.functions.variants import is_record, is_text, plain_text, strict_json, strip, truthy, typed_at
from triagelake.sources.session import fresh_path

# Fixed value: the one provider whose replies are understood.
PROVIDER = "openai_compatible"

# What can go wrong between sending a prompt and getting text back. `details` holds a status code or a reason.
TRANSPORT_ERRORS = ("timeout", "http_error", "connection_error", "io_error")
# What the classification itself finds wrong; NO_RESPONSE and unsupported_provider complete the vocabulary.
REPLY_ERRORS = ("invalid_response", "empty_response", "empty_content")

# Our own code for a report that no reply was found for.
NO_RESPONSE = "no_response"

OK, FAILED, BROKEN = "ok", "failed", "broken"


def _optional(rows: DataFrame, name: str) -> Column:
    return F.col(name) if name in rows.columns else F.lit(None).cast("string")


def classify_responses(responses: DataFrame, provider: str = PROVIDER) -> DataFrame:
    """Outcome of each reply: ``task_id, outcome, error, details, content``.

    ``responses`` needs ``task_id``, ``body`` (the reply envelope as text) and ``transport_error``; ``transport_detail`` is
    optional.  ``outcome`` is ok, failed (with ``error``), or broken for an envelope whose first choice or message is not an
    object, which no error code covers.
    """
    if provider != PROVIDER:
        return responses.select(
            "task_id",
            F.lit(FAILED).alias("outcome"),
            F.lit("unsupported_provider").alias("error"),
            F.lit(provider).alias("details"),
            F.lit(None).cast("string").alias("content"),
        )
    return _classified(
        responses.select(
            "task_id", "body", "transport_error", _optional(responses, "transport_detail").alias("details")
        )
    )


def _classified(rows: DataFrame) -> DataFrame:
    """The outcome is one expression in which every step is named.

    A filter on the outcome, which Spark copies down to the scan, then repeats the work once and not once per mention.
    """
    known = f"transport_error IN ({lits(*TRANSPORT_ERRORS, NO_RESPONSE)})"
    error = case(
        # A name outside the vocabulary would pass for a cause that nothing downstream knows.
        ("transport_error IS NOT NULL", case((known, "transport_error"), otherwise="'io_error'")),
        ("envelope IS NULL", "'invalid_response'"),
        ("choice IS NULL", "'empty_response'"),
        ("broken", "NULL"),
        (f"content IS NULL OR {strip('content')} = ''", "'empty_content'"),
    )
    state = struct(
        outcome=case(("error IS NOT NULL", lit(FAILED)), ("broken", lit(BROKEN)), otherwise=lit(OK)),
        error="error",
        details="details",
        content="CASE WHEN error IS NULL AND NOT broken THEN content END",
    )
    steps = {
        "envelope": case(("transport_error IS NULL", strict_json("body"))),
        "choice": typed_at("envelope", "$.choices[0]", "variant"),
        "message": typed_at("choice", "$.message", "variant"),
        "broken": f"{_misplaced('choice')} OR {_misplaced('message')}",
        "reply": typed_at("message", "$.content", "variant"),
        "content": case((is_text("reply"), plain_text("reply"))),
        "error": error,
    }
    for name, expression in reversed(steps.items()):
        state = let(name, expression, state)
    return rows.selectExpr("task_id", f"{state} AS state").selectExpr("task_id", "state.*")


def _misplaced(value: str) -> str:
    """True for a value that should be an object and is something else that counts as true."""
    return f"({value} IS NOT NULL AND NOT {is_record(value)} AND {truthy(value)})"


#: The better a reply turned out, the lower its rank.
RANKS = {OK: 0, FAILED: 1, BROKEN: 2}


def best_replies(responses: DataFrame, provider: str = PROVIDER, folder: str | None = None) -> DataFrame:
    """Of the replies of each task the best one, classified, with the number of ``replies`` that there were.

    A usable reply beats a failed one, and that one a broken one; among equals a checksum of the reply decides.  Replies are parsed
    once and stored with a row number (in the shared folder, or ``folder``).  Per task, rank and checksum are one number of fixed
    width; the row number of its minimum (``min_by``, two longs) is found by a hash aggregation that is combined before the shuffle,
    and the best row is joined back on (task, row number), a key that no two rows share, so a task with many replies spreads over
    all tasks of the join.  No reply text is sorted or aggregated.
    """
    from triagelake.sources.outputs import stored  # the sinks import the operators

    named = responses.where(F.col("task_id").isNotNull())
    rank = F.element_at(F.create_map(*(F.lit(x) for pair in RANKS.items() for x in pair)), F.col("outcome"))
    marked = classify_responses(named, provider).withColumn("checksum", F.xxhash64("error", "details", "content"))
    # 60 bits of the checksum below the rank.
    code = F.shiftleft(rank.cast("long"), 60).bitwiseOR(F.shiftrightunsigned("checksum", 4))
    marked = stored(marked.select("task_id", "outcome", "error", "details", "content", code.alias("code"),
                                  F.monotonically_increasing_id().alias("row")),
                    fresh_path(responses.sparkSession, "classified-replies", folder))
    best = marked.groupBy("task_id").agg(F.min_by("row", "code").alias("row"), F.count(F.lit(1)).alias("replies"))
    return marked.join(best, ["task_id", "row"]).drop("code", "row")


def pair_responses(tasks: DataFrame, responses: DataFrame, provider: str = PROVIDER) -> DataFrame:
    """Classified reply of every distinct task of ``tasks``; a task without a reply fails with ``no_response``.

    Only the key of ``tasks`` takes part, and it is reduced to one row per task before the join, so no key is hot.  A NULL key stays one
    row without a reply.  ``dropped`` tells how many further replies of the task were left out.
    """
    keys = tasks.select("task_id").distinct()
    joined = keys.join(best_replies(responses, provider), "task_id", "left")
    missing = F.col("replies").isNull()
    unanswered = "unsupported_provider" if provider != PROVIDER else NO_RESPONSE
    return joined.select(
        "task_id",
        F.when(missing, F.lit(FAILED)).otherwise(F.col("outcome")).alias("outcome"),
        F.when(missing, F.lit(unanswered)).otherwise(F.col("error")).alias("error"),
        F.when(missing & F.lit(provider != PROVIDER), F.lit(provider)).otherwise(F.col("details")).alias("details"),
        "content",
        F.coalesce(F.col("replies") - 1, F.lit(0)).cast("long").alias("dropped"),
    )
