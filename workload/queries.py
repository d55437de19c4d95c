"""One query per operator or group of operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.functions import text as texts
from triagelake.functions.lists import first_n, sorted_distinct
from triagelake.functions.lists import dedupe_first_seen as distinct_in_order
from triagelake.functions.variants import clamp_unit, strict_json, typed_at
from triagelake.operators import artifacts, tables
from triagelake.operators.assessments import TEAMS, json_blob, spread_entries, spread_lists, validate_replies
from triagelake.operators.detectors import findings_of
from triagelake.operators.rule_tables import joined_findings
from triagelake.operators.evidence import BEHAVIOR_LISTS, HASH_LIMIT, IOC_KINDS, behavior_entries, ioc_entries, normalize_reports
from triagelake.operators.long_evidence import first_distinct, ioc_lists
from triagelake.operators.markdown import render_markdown
from triagelake.operators.prompts import build_prompts, evidence_packages, request_payloads
from triagelake.operators.responses import classify_responses, pair_responses
from triagelake.options import TriageOptions
from triagelake.plans.job import ingest_reports_bucketed, run_triage
from triagelake.sources.outputs import ATTACHED_COLUMN, JSON_DATASET, MARKDOWN_DATASET
from triagelake.sources.reports import read_report_lines
from triagelake.sources.session import configure, fresh_path
from triagelake.streaming.pairing import pair_stream
from workload.derived import derived_reports, derived_responses, page_reports, reports_raw, responses_raw, table

Query = Callable[[SparkSession, str], DataFrame]

JOB = TriageOptions(enabled=True, model="m1", attach_to_results=True)
# Bulk file activity shows only if more than 200 files survive the event limit.
WIDE = TriageOptions(max_input_events=300)


# Text functions ---------------------------------------------------------------------------------------------------------

def _sanitized(rows: DataFrame, keys: tuple[str, ...], text: str, size: int, redact: bool) -> DataFrame:
    """The clean text cut to ``size``, and the checksum of all of it before account names are hidden."""
    whole = rows.selectExpr(*keys, f"{texts.sanitize(text, 1_000_000_000, redact=False)} AS whole")
    shown = texts.redact_paths("whole") if redact else "whole"
    return whole.selectExpr(*keys, f"substring({shown}, 1, {size}) AS clean", "md5(whole) AS whole_text")


def sanitize_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sanitized(table(spark, sf_dir, "documents"), ("doc_id",), "text", 256, True)


def sanitize_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sanitized(table(spark, sf_dir, "conversations"), ("conv_id", "turn"), "text", 180, True)


def sanitize_pages_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sanitized(table(spark, sf_dir, "pages"), ("page_id",), "html", 320, False)


def redact_user_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, key = F.col("c_name"), F.col("c_custkey")
    path = F.when(key % 2 == 0, F.concat(F.lit("C:\\users\\"), name, F.lit("\\a b.exe"))).otherwise(
        F.concat(F.lit("/HOME/"), name, F.lit("/x  /home/"), F.col("c_mktsegment"), F.lit("/y")))
    rows = table(spark, sf_dir, "customer").select("c_custkey", path.alias("path"))
    return rows.selectExpr("c_custkey", f"{texts.sanitize('path')} AS path")


def clamp_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = table(spark, sf_dir, "events").selectExpr(
        "event_id AS id", "'event' AS kind", f"{clamp_unit('value / 100')} AS confidence")
    balances = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "'customer' AS kind", f"{clamp_unit('c_acctbal / 1000')} AS confidence")
    return values.unionByName(balances)


def severity_of_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = "array(' High ', 'INFO', 'moderate', 'Severe', 'none', 'Critical')"
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "string(p_size % 8) AS code", f"{words}[p_partkey % 6] AS word")
    return rows.selectExpr(
        "p_partkey", f"{texts.severity_label('code')} AS by_code", f"{texts.severity_label('word')} AS by_word",
        f"{texts.severity_label('word', allow_unknown=False)} AS by_word_known")


def canonical_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.concat(F.lit(".."), F.upper(F.regexp_extract("url", "^https?://([^/?#]*)", 1)), F.lit("."))
    rows = table(spark, sf_dir, "pages").select("page_id", host.alias("host"))
    return rows.selectExpr("page_id", f"{texts.canonical_domain('host')} AS domain")


def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    long_url = F.concat(F.regexp_replace(F.upper("url"), "[?#].*$", ""), F.lit("?Q="), F.repeat(F.lit("x1"), 45), F.lit("#f"))
    rows = table(spark, sf_dir, "pages").select("page_id", "url", long_url.alias("long_url"))
    return rows.selectExpr(
        "page_id", f"{texts.canonical_url('url')} AS url", f"{texts.canonical_url('long_url')} AS long_url")


def _matches(spark: SparkSession, sf_dir: str, pattern: str) -> DataFrame:
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    return table(spark, sf_dir, "documents").select("doc_id", F.posexplode(found).alias("pos", "found"))


def canonical_ips(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _matches(spark, sf_dir, r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}")
    padded = r"concat(' ', found, '\t')"
    return found.selectExpr("doc_id", "pos", f"{texts.canonical_ip(padded)} AS ip")


def document_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _matches(spark, sf_dir, "[0-9a-fA-F]{20,}").where(texts.is_hash("found"))
    return found.select("doc_id", F.lower("found").alias("hash"))


def attack_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("p_partkey")
    name = F.when(key % 3 == 0, F.concat(F.lit("t"), key.cast("string"))).when(
        key % 3 == 1, F.concat(F.lit(" T"), key.cast("string"), F.lit(".00"), (key % 10).cast("string"))).otherwise(F.lit(" "))
    rows = table(spark, sf_dir, "part").select("p_partkey", name.alias("name"))
    return rows.selectExpr("p_partkey", f"{texts.attack_id('name')} AS attack_id")


# List operators ---------------------------------------------------------------------------------------------------------

def dedupe_first_seen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values with white space of all kinds around them, and blank ones."""
    around = F.element_at(F.array(*(F.lit(x) for x in ("", "\t", " \n", "\u2003", "\r\x1f"))), (F.col("event_id") % 5 + 1).cast("int"))
    value = F.when(F.col("event_id") % 11 == 0, around).otherwise(F.concat(around, F.col("props"), around))
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", value.alias("props"))
    return artifacts.dedupe_first_seen(rows, "user_id", "props", "event_id")


def first_n_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    distinct = artifacts.dedupe_first_seen(table(spark, sf_dir, "events"), "user_id", "props", "event_id")
    return artifacts.first_n(distinct, "user_id", "event_id", 20)


def sorted_lists_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = artifacts.sorted_lists(table(spark, sf_dir, "events"), "user_id", "props", "event_id", 20)
    return lists.select("user_id", F.array_join("values", "|").alias("values"))


def numbered_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positional ids over long groups: every event of a user numbered by event id, without a window over a whole user."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id")
    return artifacts.number_rows(events, "user_id", ["event_id"], "pos").select(
        "user_id", "event_id", F.concat(F.lit("evt_"), F.col("pos").cast("string")).alias("ref"))


def words_in_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = first_n(distinct_in_order(r"split(regexp_replace(text, '[^ -~]+', ' '), ' ')"), 12)
    kept = table(spark, sf_dir, "documents").selectExpr("doc_id", f"{words} AS words")
    return kept.selectExpr("doc_id", "array_join(words, '|') AS first_words",
                           f"array_join({sorted_distinct('words')}, '|') AS sorted_words")


# Evidence ---------------------------------------------------------------------------------------------------------------

def evidence(spark: SparkSession, sf_dir: str, options: TriageOptions = TriageOptions()) -> DataFrame:
    return normalize_reports(reports_raw(configure(spark), sf_dir), options)


def _evidence_table(build: Callable[[DataFrame], DataFrame], options: TriageOptions = TriageOptions()) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return build(evidence(spark, sf_dir, options))

    return query


def _one_risk(rule: str, options: TriageOptions = TriageOptions()) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return findings_of(evidence(spark, sf_dir, options), rule)

    return query


def _joined_risk(rule: str) -> Query:
    """Findings of a process rule by a semi join of all processes (or calls) against the rule table; equal to the in-row form."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return joined_findings(evidence(spark, sf_dir), rule).drop("pos")

    return query


def behavior_artifacts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``behavior_artifacts`` from one row per list entry: repeats dropped and lists cut by aggregation and distributed numbering."""
    options = TriageOptions()
    kinds = {name: (size, redact and options.redact_pii) for name, (size, redact) in BEHAVIOR_LISTS.items()}
    return first_distinct(behavior_entries(reports_raw(configure(spark), sf_dir)), kinds, options.max_input_events)


def iocs_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``iocs`` from one row per list entry, by aggregations and distributed numbering."""
    options = TriageOptions()
    kinds = {name: (size, redact and options.redact_pii) for name, (size, redact) in BEHAVIOR_LISTS.items()}
    return ioc_lists(ioc_entries(reports_raw(configure(spark), sf_dir)), kinds, options.max_input_events,
                     options.max_network_artifacts, HASH_LIMIT)


def report_read_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What becomes of reports that hold bare NaN, are cut, too deep, no object, or missing."""
    pages = page_reports(configure(spark), sf_dir)
    kind, rest = F.substring("task_id", F.lit(2), F.lit(18)).cast("long") % 8, F.substring("raw", F.lit(2), F.length("raw"))
    raw = (
        F.when(kind == 1, F.concat(F.lit('{"malscore":NaN,'), rest)).when(kind == 2, F.substring("raw", F.lit(1), F.length("raw") - 1))
        .when(kind == 3, F.concat(F.lit("["), F.col("raw"), F.lit("]")))
        .when(kind == 4, F.lit("[" * 1200 + "]" * 1200)).when(kind == 5, F.lit("5"))
        .when(kind == 7, F.concat(F.lit('{"note":"x, NaN, \\"y","limit":[-Infinity,Infinity],'), rest)).when(kind != 6, F.col("raw"))
    )
    found = normalize_reports(pages.select("task_id", raw.alias("raw")))
    return found.select("task_id", "read_status", F.col("high_level_scores.signature_count").alias("signature_count"),
                        F.size("ioc_candidates.domains").alias("domains"))


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reports written as lines and read back by the line reader; page reports hold no ``info.id``, so their task_id is NULL."""
    path = fresh_path(configure(spark), "report-lines")
    reports_raw(spark, sf_dir).select("raw").write.text(path)
    return tables.scores(normalize_reports(read_report_lines(spark, path)))


def evidence_packages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence_packages(evidence(spark, sf_dir))


def page_evidence_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evidence_packages(normalize_reports(page_reports(configure(spark), sf_dir)))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_prompts(evidence(spark, sf_dir))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return request_payloads(prompts(spark, sf_dir), JOB)


# Replies ----------------------------------------------------------------------------------------------------------------

def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return responses_raw(configure(spark), sf_dir)


def response_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_responses(replies(spark, sf_dir)).select("task_id", "outcome", "error", "details")


def unsupported_provider(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_responses(replies(spark, sf_dir), "other").select("task_id", "outcome", "error", "details")


def paired_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = configure(spark)
    paired = pair_responses(reports_raw(spark, sf_dir), responses_raw(spark, sf_dir))
    return paired.select("task_id", "outcome", "error", "details")


#: Replies come (d % 7) * 15 seconds after the request; with a timeout of 60 seconds those of 75 and 90 seconds do not count.
STREAM_TIMEOUT_S, STREAM_START = 60, "2026-01-01 00:00:00"


def stream_paired_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairing on streams: all tasks and replies arrive as files with event times; one pairing per task after its deadline."""
    spark = configure(spark)
    folder = fresh_path(spark, "stream-pairing")
    start = F.to_timestamp(F.lit(STREAM_START))
    d = F.coalesce(F.expr("try_cast(substring(task_id, 2) AS BIGINT)"), F.lit(0))
    # Of the reports only their ids are needed, and the files of the stream are the one copy of the replies: neither is ingested.
    derived_reports(spark, sf_dir).select("task_id", start.alias("sent_at")).write.parquet(f"{folder}/tasks")
    derived_responses(spark, sf_dir).select(
        "task_id", "body", "transport_error", "transport_detail",
        (start + F.make_dt_interval(secs=(d % 7 * 15).cast("decimal(8,0)"))).alias("received_at")).write.parquet(f"{folder}/replies")
    # A clock far ahead moves the watermark past every deadline; its reply has no task and is dropped.
    spark.range(1).select(F.lit("clock").alias("task_id"), F.lit(None).cast("string").alias("body"), F.lit("timeout").alias("transport_error"),
                          F.lit(None).cast("string").alias("transport_detail"),
                          (start + F.expr("INTERVAL 1 DAY")).alias("received_at")).write.mode("append").parquet(f"{folder}/replies")
    tasks_schema, replies_schema = "task_id string, sent_at timestamp", ("task_id string, body string, transport_error string, "
                                                                         "transport_detail string, received_at timestamp")
    for _ in range(3):  # the first run reads all files; timers fire in the runs after it, once the watermark has moved
        tasks = spark.readStream.schema(tasks_schema).parquet(f"{folder}/tasks")
        replies = spark.readStream.schema(replies_schema).parquet(f"{folder}/replies")
        (pair_stream(tasks, replies, STREAM_TIMEOUT_S, with_content=False).writeStream.format("parquet").option("checkpointLocation", f"{folder}/progress")
         .trigger(availableNow=True).start(f"{folder}/out").awaitTermination())
    return spark.read.parquet(f"{folder}/out").select("task_id", "outcome", "error", "details")


def paired_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tasks with a second and a third reply: an error page, an empty answer, or a timeout beside the first one."""
    spark = configure(spark)
    first = responses_raw(spark, sf_dir)
    d = F.substring("task_id", F.lit(2), F.lit(18)).cast("long")
    doubled = first.where(~((d / 8).cast("long") % 10).isin(5, 6, 7) & (d % 8 != 7))
    none = F.lit(None).cast("string")
    extra = [
        doubled.where(d % 3 == 0).select("task_id", F.lit("<html>502</html>").alias("body"), none.alias("transport_error"), none.alias("transport_detail")),
        doubled.where(d % 3 == 1).select("task_id", F.lit('{"choices":[]}').alias("body"), none.alias("transport_error"), none.alias("transport_detail")),
        doubled.where(d % 3 == 2).select("task_id", none.alias("body"), F.lit("timeout").alias("transport_error"), none.alias("transport_detail")),
    ]
    replies_ = first.unionByName(extra[0]).unionByName(extra[0]).unionByName(extra[1]).unionByName(extra[2])
    paired = pair_responses(first, replies_)
    return paired.select("task_id", "outcome", "error", "dropped")


def json_blobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    # CASE in place of a filter, which would be pushed below the classification and repeat it.
    blobs = classify_responses(replies(spark, sf_dir)).selectExpr(
        "task_id", f"CASE WHEN outcome = 'ok' THEN {json_blob('content')} END AS blob")
    parsed = blobs.selectExpr("task_id", "blob", f"{strict_json('blob')} AS doc")
    title = typed_at("doc", "$.key_findings[0].title", "string")
    return parsed.selectExpr("task_id", "doc IS NOT NULL AS is_json", "left(blob, 1) AS first", "right(blob, 1) AS last",
                             f"md5({title}) AS title_text")


def assessments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate_replies(classify_responses(replies(spark, sf_dir)), JOB.metadata)


def assessment_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assessments(spark, sf_dir).select("task_id", "status", "error_type", "message")


def assessment_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict = F.col("verdict")
    return assessments(spark, sf_dir).select(
        "task_id", verdict["is_malicious"].alias("is_malicious"), verdict["confidence"].alias("confidence"),
        verdict["severity"].alias("severity"), F.array_join(verdict["category"], "|").alias("category"))


def _entries(column: str, *fields: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spread_entries(assessments(spark, sf_dir), column, fields)

    return query


def assessment_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assessments(spark, sf_dir).select("task_id", F.col("verdict.family_hypotheses").alias("families"))
    return spread_entries(rows, "families", ("name", "confidence", "reason", "evidence_ids"))


def assessment_iocs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_lists(assessments(spark, sf_dir), "iocs", IOC_KINDS)


def assessment_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread_lists(assessments(spark, sf_dir), "analyst_actions", TEAMS)


def assessment_uncertainties(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = assessments(spark, sf_dir).select("task_id", F.struct("uncertainties").alias("notes"))
    return spread_lists(rows, "notes", ("uncertainties",)).drop("kind")


def assessment_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    claimed = validate_replies(classify_responses(replies(spark, sf_dir)))
    stated = assessments(spark, sf_dir)
    fields = ("provider", "model", "prompt_version")
    both = [
        rows.select("task_id", F.lit(kind).alias("kind"), *(F.col(f"model_metadata.{name}").alias(name) for name in fields))
        for kind, rows in (("claimed", claimed), ("stated", stated))
    ]
    return both[0].unionByName(both[1])


def markdown_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_markdown(assessments(spark, sf_dir))


# Whole job --------------------------------------------------------------------------------------------------------------

def attached_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark = configure(spark)
    result = run_triage(reports_raw(spark, sf_dir), responses_raw(spark, sf_dir), JOB, ingested=True)
    found = result.attached.withColumn("a", F.col(ATTACHED_COLUMN))
    return found.select("task_id", F.length("raw").isNotNull().alias("has_report"), *_shown("a."))


def attached_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """attached_reports with reports stored bucketed by task at ingest: attaching moves no report text."""
    spark = configure(spark)
    table = "reports_" + fresh_path(spark, "b").rsplit("-", 1)[-1]
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    reports = ingest_reports_bucketed(derived_reports(spark, sf_dir), table, buckets)
    result = run_triage(reports, responses_raw(spark, sf_dir), JOB, ingested=True)
    found = result.attached.withColumn("a", F.col(ATTACHED_COLUMN))
    return found.select("task_id", F.length("raw").isNotNull().alias("has_report"), *_shown("a."))


def _shown(prefix: str = "") -> list[Column]:
    """What is compared of each field of an assessment."""
    plain = ("status", "error_type", "message")
    lists = {"n_facts": "observed_facts", "n_flow": "attack_flow", "n_findings": "key_findings", "n_families": "verdict.family_hypotheses",
             "n_domains": "iocs.domains", "n_actions": "analyst_actions.soc"}
    return [
        *(F.col(f"{prefix}{name}").alias(name) for name in plain),
        *(F.col(f"{prefix}verdict.{name}").alias(name) for name in ("severity", "is_malicious", "confidence")),
        *(F.size(f"{prefix}{name}").alias(alias) for alias, name in lists.items()),
        F.col(f"{prefix}model_metadata.model").alias("model"),
    ]


def saved_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's published JSON lines, read back with all their columns."""
    spark = configure(spark)
    path = fresh_path(spark, "saved-outputs")
    result = run_triage(reports_raw(spark, sf_dir), responses_raw(spark, sf_dir), JOB, path, ingested=True)
    saved = spark.read.schema(result.assessments.schema).json(f"{path}/{JSON_DATASET}")
    result.release()
    return saved.select("task_id", *_shown())


def saved_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's published Markdown for the tasks that have a reply, read back."""
    spark = configure(spark)
    path = fresh_path(spark, "saved-markdown")
    answered = responses_raw(spark, sf_dir)
    run_triage(answered.select("task_id", F.lit("{}").alias("raw")), answered, JOB, path, ingested=True).release()
    return spark.read.parquet(f"{path}/{MARKDOWN_DATASET}")


QUERIES: dict[str, Query] = {
    "sanitize_documents": sanitize_documents,
    "sanitize_conversations": sanitize_conversations,
    "sanitize_pages_html": sanitize_pages_html,
    "redact_user_paths": redact_user_paths,
    "clamp_values": clamp_values,
    "severity_of_codes": severity_of_codes,
    "canonical_domains": canonical_domains,
    "canonical_urls": canonical_urls,
    "canonical_ips": canonical_ips,
    "document_hashes": document_hashes,
    "attack_ids": attack_ids,
    "dedupe_first_seen": dedupe_first_seen,
    "first_n_per_user": first_n_per_user,
    "sorted_lists_per_user": sorted_lists_per_user,
    "numbered_events": numbered_events,
    "words_in_row": words_in_row,
    "report_samples": _evidence_table(tables.samples),
    "report_scores": _evidence_table(tables.scores),
    "behavior_artifacts": _evidence_table(tables.behavior_artifacts),
    "behavior_artifacts_long": behavior_artifacts_long,
    "process_highlights": _evidence_table(tables.process_highlights),
    "process_apis": _evidence_table(tables.process_apis),
    "signatures": _evidence_table(tables.signatures),
    "iocs": _evidence_table(tables.iocs),
    "iocs_long": iocs_long,
    "network_highlights": _evidence_table(tables.network_highlights),
    "network_summary": _evidence_table(tables.network_summary),
    "report_read_status": report_read_status,
    "report_lines": report_lines,
    "risk_persistence": _one_risk("persistence"),
    "risk_discovery": _one_risk("discovery"),
    "risk_credential_access": _one_risk("credential_access"),
    "risk_ransomware": _one_risk("ransomware"),
    "risk_ransomware_bulk_files": _one_risk("ransomware", WIDE),
    "risk_defense_evasion": _one_risk("defense_evasion"),
    "risk_injection": _one_risk("injection"),
    "risk_lolbins": _one_risk("system_binaries"),
    "risk_injection_joined": _joined_risk("injection"),
    "risk_lolbins_joined": _joined_risk("system_binaries"),
    "risks": _evidence_table(tables.risks),
    "evidence_packages": evidence_packages_query,
    "page_evidence_packages": page_evidence_packages,
    "prompts": prompts,
    "requests": requests,
    "response_status": response_status,
    "unsupported_provider": unsupported_provider,
    "paired_status": paired_status,
    "paired_duplicates": paired_duplicates,
    "stream_paired_status": stream_paired_status,
    "json_blobs": json_blobs,
    "assessment_status": assessment_status,
    "assessment_verdicts": assessment_verdicts,
    "assessment_families": assessment_families,
    "assessment_facts": _entries("observed_facts", "title", "summary", "evidence_ids"),
    "assessment_flow": _entries("attack_flow", "step", "title", "details", "evidence_ids"),
    "assessment_findings": _entries("key_findings", "title", "severity", "why_it_matters", "evidence_ids"),
    "assessment_ttps": _entries("ttps", "id", "name", "confidence", "reason", "evidence_ids"),
    "assessment_iocs": assessment_iocs,
    "assessment_actions": assessment_actions,
    "assessment_uncertainties": assessment_uncertainties,
    "assessment_metadata": assessment_metadata,
    "markdown_reports": markdown_reports,
    "attached_reports": attached_reports,
    "attached_bucketed": attached_bucketed,
    "saved_outputs": saved_outputs,
    "saved_markdown": saved_markdown,
}