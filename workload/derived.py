"""Report and reply tables that Spark derives from the given tables, with faults planted on purpose.

Reports: one per user and block of 16,384 event ids (task ``u<user>_<block>``), and one per page (task ``p<page>``).  The block
bounds every report, so that a user with a third of all events has many reports and not one huge group; it drops no event, but a user
of more than one block has several reports, and none is large.  Large reports are tested apart from these tables.  Replies: one per
document (task ``p<document>``), so that some tasks get a reply and some do not.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from triagelake.sources.session import PACKED, shared_folder

BLOCK = 16_384
BULK_FILES = 250
INJECTION_CALL = '{"api":"CreateRemoteThread"}'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(*parts: Column | str) -> Column:
    return F.concat(*(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts))


def _json(**fields: Column) -> Column:
    """JSON object text; NULL fields are left out."""
    return F.to_json(F.struct(*(value.alias(name) for name, value in fields.items())))


def _quoted(value: Column) -> Column:
    listed = F.to_json(F.array(value))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _pick(number: Column, choices: dict[int, Column], otherwise: Column | None = None) -> Column:
    picked = None
    for key, value in choices.items():
        picked = F.when(number == key, value) if picked is None else picked.when(number == key, value)
    return picked if otherwise is None else picked.otherwise(otherwise)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("e"), F.col("user_id").alias("u"), F.col("event_type").alias("t"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.expr(f"event_id div {BLOCK}").alias("block"),
    )


def _partitions(spark: SparkSession) -> int:
    """The configured number, which adaptive execution keeps; it would merge small inputs into one task."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _calls(k: Column) -> Column:
    """Up to 25 calls; some entries are no records, some name no API, and the last may be an injection API.

    The entries depend on ``k % 7`` and their place only and are equally long for all ``k``, so a list is cut from one of seven texts.
    """
    def entry(j: int, k: int) -> str:
        return '"junk"' if j % 5 == 2 else '{"api":""}' if j % 5 == 3 else f'{{"api":"NtApi{(k + j) % 7}"}}'

    whole = [[entry(j, k) for j in range(25)] for k in range(7)]
    starts = [sum(len(text) + 1 for text in whole[0][:j]) for j in range(25)]
    ends = [start + len(text) for start, text in zip(starts, whole[0])]

    def at(values: list, place: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), place + 1)

    texts, last = at([",".join(entries) for entries in whole], k % 7), k % 25
    cut = F.when(k % 4 == 0, F.concat(F.substring(texts, F.lit(1), at(starts, last)), F.lit(INJECTION_CALL))).otherwise(
        F.substring(texts, F.lit(1), at(ends, last)))
    return F.when(k >= 0, F.concat(F.lit("["), cut, F.lit("]"))).otherwise(_calls_one_by_one(k))


def _calls_one_by_one(k: Column) -> Column:
    last = k % 25

    def call(j: Column) -> Column:
        return (
            F.when((j == last) & (k % 4 == 0), F.lit(INJECTION_CALL))
            .when(j % 5 == 2, F.lit('"junk"'))
            .when(j % 5 == 3, _json(api=F.lit("")))
            .otherwise(_json(api=_text("NtApi", (k + j) % 7)))
        )

    return F.concat(F.lit("["), F.array_join(F.transform(F.sequence(F.lit(0), last), call), ","), F.lit("]"))


def _with_raw(record: Column, key: str, raw: Column) -> Column:
    """Add a field whose value is JSON text already."""
    body = F.substring(record, F.lit(1), F.length(record) - 1)
    comma = F.when(F.length(record) > 2, F.lit(",")).otherwise(F.lit(""))
    return F.concat(body, comma, F.lit(f'"{key}":'), raw, F.lit("}"))


def _event_fragments(rows: DataFrame) -> DataFrame:
    """JSON of each event.  Texts that grow field by field are columns of their own: an expression used twice would be computed twice."""
    e, u, t, k = (F.col(name) for name in "eutk")
    name = (
        F.when(t == "click", F.lit("CMD.EXE")).when(t == "error", F.lit("powershell.exe"))
        .when(t == "view", F.lit("explorer.exe")).when(t == "signup", _text("  app", k % 7, ".exe "))
    )
    process = _json(process_name=name, command_line=_text("C:\\Users\\user", u, "\\run.exe  /k ", k))
    process_id = F.when(e % 5 == 0, _quoted(e.cast("string"))).when(e % 7 == 0, _text(e, ".5")).otherwise(e.cast("string"))
    rows = rows.withColumn("process", process).withColumn("process", _with_raw(F.col("process"), "process_id", process_id))
    rows = rows.withColumn("process", _with_raw(F.col("process"), "calls", _calls(k)))
    command = _pick(e % 7, {
        0: F.when(k % 10 == 0, F.lit("cmd /c WhoAmI /all")).otherwise(_text("dir ", k % 5)),
        1: F.when(k % 10 == 1, _text("schtasks /create /tn t", k)).otherwise(_text("tasklist ", k)),
        2: _text("reg add  HKCU x", k),
        3: F.lit("ping net"),
        4: F.lit("user list"),
        5: _text("C:\\Users\\sam", u, "\\a", k, ".exe"),
        6: _pick(k % 20, {
            0: F.lit("vssadmin delete shadows /all"), 1: F.lit("wevtutil cl System"), 2: F.lit("procdump lsass"),
            3: F.lit("bcdedit /set x"),
        }, _text("echo ", e)),
    })
    key = (
        F.when(k == 48, _quoted(_text("HKCU\\Software\\Microsoft\\Windows\\CurrentVersion\\Run\\v", k)))
        .when(k % 12 == 1, k.cast("string")).when(k % 12 == 2, F.lit('""'))
        .otherwise(_quoted(_text("HKLM\\Software\\Vendor", k % 6)))
    )
    file = _pick(e % 3, {
        0: _text("C:\\Users\\u", u, "\\f", e % 40, ".tmp"), 1: _text("/home/u", u, "/f", e), 2: _text("D:\\data\\f", e, ".bin"),
    })
    severity = _pick(k % 5, {1: F.lit("null"), 2: F.lit("2"), 3: F.lit('"3"'), 4: F.lit('"high"')})
    signature = _json(name=_text("sig_", t), description=_text("Seen  at \\Users\\u", u, "\\x by event ", e))
    rows = rows.withColumn("signature", F.when(e % 4 == 0, signature))
    signature = F.col("signature")
    rows = rows.withColumn("signature", _with_raw(
        signature, "families", _text("[", _quoted(t), ",", _quoted(t), ",", _quoted(_text("fam", k % 4)), ",5]")))
    rows = rows.withColumn("signature", _with_raw(signature, "mitre", _text('["T1059.00', k % 9, '"]')))
    rows = rows.withColumn("signature", F.when(k % 5 == 0, signature).otherwise(_with_raw(signature, "severity", severity)))
    techniques = (
        F.when(k % 6 == 0, F.lit('"T1000"')).when(k % 2 == 0, _text('["T1055","T', k + 1000, '"]'))
        .when(k % 10 == 1, F.lit("[]"))
    )
    rows = rows.withColumn("techniques", techniques)
    techniques = F.col("techniques")
    rows = rows.withColumn("signature", F.when(techniques.isNull(), signature).otherwise(_with_raw(signature, "ttp", techniques)))
    domain = (
        F.when(e % 13 == 0, F.lit('"stray"')).when(e % 9 == 0, F.lit('{"domain":null}'))
        .otherwise(_json(domain=_text("HOST", k % 30, ".Example.COM.")))
    )
    request = F.when(e % 2 == 0, _json(
        method=F.lit("GET"), uri=_text("HTTP://u", u, "@Host", k % 10, ".Example.com/p/", k, "?q=", e, "#frag"),
    )).otherwise(_with_raw(_json(url=_text("https://example.org/", k % 10)), "size", F.lit('1.50,"ok":true')))
    return rows.select(
        "e", "u", "block",
        "process",
        _quoted(command).alias("command"),
        key.alias("key"),
        _quoted(file).alias("file"),
        _quoted(_text("Global\\m", k % 20, "```x```")).alias("mutex"),
        _quoted(_text("svc é", k % 9)).alias("service"),
        _pick(k % 3, {0: F.lit("true"), 1: _quoted(_text("task ", k % 8))}, F.lit("null")).alias("task"),
        F.when(e % 11 == 0, _quoted(_text("inject into /home/u", u, "/x"))).alias("injection"),
        "signature",
        domain.alias("domain"),
        _json(ip=_text("10.0.", k % 30, ".", e % 4)).alias("host"),
        request.alias("request"),
        _json(request=_text("q", k % 15, ".net"), type=F.lit("A")).alias("lookup"),
        _json(dst=_text("10.0.0.", k % 8), dport=F.lit(443)).alias("stream"),
        _quoted(_text("udp ", k % 5)).alias("datagram"),
    )


def _list_of(name: str) -> Column:
    """JSON list of one fragment of all items; items without it are left out."""
    return F.concat(F.lit("["), F.array_join(f"items.{name}", ","), F.lit("]"))


def _prefixed(condition: Column, entry: str, values: Column) -> Column:
    """Put an entry in front of a JSON list, which may be empty."""
    opened = F.when(values == "[]", F.lit(f"[{entry}")).otherwise(F.lit(f"[{entry},"))
    return F.when(condition, F.concat(opened, F.substring(values, F.lit(2), F.length(values)))).otherwise(values)


def event_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Shuffling and sorting the plain events first handles far less data than their JSON; the grouping below reuses both, so it keeps one
    # report at a time (a hash aggregation of lists falls back to sorting, and spilling, all JSON of a task).
    # Texts move once, compressed, into the files: reports are spread evenly by the events, and pages by their own files.
    plain = events(spark, sf_dir).repartition(_partitions(spark), "u", "block").sortWithinPartitions("u", "block", "e")
    fragments = _event_fragments(plain)
    names = [name for name in fragments.columns if name not in ("u", "block")]
    grouped = fragments.groupBy("u", "block").agg(F.array_sort(F.collect_list(F.struct(*names))).alias("items"))
    grouped = grouped.select("*", _list_of("process").alias("processes"), _list_of("signature").alias("signatures"))
    u = F.col("u")
    bulk = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(BULK_FILES)), lambda i: _text('"/tmp/bulk', i, '"')), ",")
    files = _list_of("file")
    files = F.when(
        u % 19 == 0, F.concat(F.substring(files, F.lit(1), F.length(files) - 1), F.lit(","), bulk, F.lit("]"))
    ).otherwise(files)
    summary = F.concat(
        F.lit('{"files":'), files,
        F.lit(',"keys":'), F.when(u % 13 == 0, F.lit('"bad"')).otherwise(_list_of("key")),
        F.lit(',"mutexes":'), _list_of("mutex"), F.lit(',"executed_commands":'), _list_of("command"),
        F.lit(',"services":'), _list_of("service"), F.lit(',"scheduled_tasks":'), _list_of("task"),
        F.lit(',"injection_signals":'), _list_of("injection"), F.lit("}"),
    )
    network = F.when(u % 17 == 0, F.lit('"offline"')).otherwise(F.concat(
        F.lit('{"domains":'), _list_of("domain"), F.lit(',"hosts":'), _list_of("host"), F.lit(',"http":'), _list_of("request"),
        F.lit(',"dns":'), _list_of("lookup"), F.lit(',"tcp":'), _list_of("stream"), F.lit(',"udp":'), _list_of("datagram"),
        F.lit("}"),
    ))
    file = _json(
        name=_text("C:\\x\\sample", u, ".exe"), type=F.lit("PE32  executable"), md5=F.md5(u.cast("string")),
        sha1=F.lit("nothex"), sha256=F.upper(F.sha2(u.cast("string"), 256)),
    )
    parts = F.array_compact(F.array(
        _text('"info":{"id":', u * 1000 + F.col("block"), ',"category":', F.when(u % 4 == 0, F.lit('"file"')).otherwise(F.lit('""')), "}"),
        _text('"target":{"category":"archive","file":', file, "}"),
        F.when(u % 6 != 0, _text('"malscore":', (u % 11) / 2)),
        _pick(u % 3, {0: _text('"detections":{"family":"Fam', u, '","score":1.0}'), 1: F.lit('"detections":"text"')}),
        _pick(u % 5, {0: F.lit('"CAPE":{},"cape":{"configs":[1,2]}'), 1: F.lit('"CAPE":{"b":1,"a":[true,null]}')}),
        _text(
            '"behavior":{"summary":', summary, ',"processes":', _prefixed(u % 11 == 0, '"bad"', F.col("processes")), "}"
        ),
        _text('"signatures":', _prefixed(u % 11 == 0, "7", F.col("signatures"))),
        _text('"network":', network),
    ))
    return grouped.select(
        _text("u", u, "_", F.col("block")).alias("task_id"),
        F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}")).alias("raw"),
    )


def page_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    host = F.upper(F.regexp_extract("url", "^https?://([^/?#]*)", 1))
    report = F.struct(
        F.struct(F.lit("url").alias("category")).alias("target"),
        F.array(F.struct(F.lit("page  content").alias("name"), F.col("html").alias("description"),
                         F.lit("none").alias("families"))).alias("signatures"),
        F.struct(
            F.array(F.struct(F.concat(host, F.lit(".")).alias("domain"))).alias("domains"),
            F.array(F.struct(F.col("url").alias("uri"))).alias("http"),
        ).alias("network"),
    )
    return table(spark, sf_dir, "pages").select(_text("p", F.col("page_id")).alias("task_id"), F.to_json(report).alias("raw"))


def derived_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All reports, each made where its events were sent to (or its page was read): no report text is shuffled."""
    return event_reports(spark, sf_dir).unionByName(page_reports(spark, sf_dir))


def _ingested(spark: SparkSession, sf_dir: str, name: str, derive: Callable[[SparkSession, str], DataFrame]) -> DataFrame:
    """A derived table, written once per application to the shared folder, as reports and replies are in practice."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _INGESTED:
        path = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
        derive(spark, sf_dir).write.option("compression", PACKED).parquet(path)
        _INGESTED[key] = path
    return spark.read.parquet(_INGESTED[key])


_INGESTED: dict[tuple[str, str, str], str] = {}


def reports_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``task_id, raw``: all derived reports."""
    return _ingested(spark, sf_dir, "reports", derived_reports)


def _reply_object(with_verdict: bool) -> Column:
    """JSON text of a model's answer about a document; keys missing, values of wrong types and stray entries included."""
    d, n, text, lang, source = (F.col(name) for name in ("doc_id", "n_chars", "text", "lang", "source"))
    body, lang_text, source_text = _quoted(text), _quoted(lang), _quoted(source)
    malicious = _pick(d % 4, {
        0: F.coalesce(F.col("toxic").cast("string"), F.lit("null")), 1: F.lit("true"), 2: F.lit('"false"'), 3: F.lit("0.0"),
    })
    certainty = _pick(d % 3, {
        0: (n / 1000.0).cast("string"), 1: _text('" ', (n % 100) / 100.0, '"'), 2: F.lit('"high"'),
    })
    severity = _pick(d % 7, {
        0: F.lit('"Severe"'), 1: F.lit("2"), 2: F.lit('"INFO"'), 3: F.lit('"critical"'), 4: F.lit("5"), 5: F.lit("true"),
        6: F.lit('" moderate\\t"'),
    })
    verdict = _text(
        '{"is_malicious":', malicious, ',"confidence":', certainty, ',"severity":', severity,
        ',"category":[', lang_text, ",", source_text, ",", lang_text, ',7],"family_hypotheses":[{"name":', source_text,
        ',"confidence":', (n % 128) / 128.0, ',"reason":', body, ',"evidence_ids":["sig_1","sig_1","proc_', d,
        '"]},"junk",{"name":null,"confidence":[1]}]}',
    ) if with_verdict else F.lit('"clearly bad"')
    technique = _pick(d % 3, {0: F.lit('"BAD"'), 1: F.lit('"t1055.012"'), 2: F.lit('""')})
    status = F.when(d % 5 == 0, F.lit('"status":"partial",')).otherwise(F.lit(""))
    return _text(
        "{", status, '"message":', source_text, ',"unknown":1,"verdict":', verdict,
        ',"observed_facts":[{"title":', lang_text, ',"summary":', body, ',"evidence_ids":"oops"},3,',
        '{"title":"second","summary":null,"evidence_ids":[1,"",2]}]',
        ',"attack_flow":[{"step":', d % 3, ',"title":"a","details":', body, '},"bad",{"step":"x","title":"b"},',
        '{"step":9,"title":"c"}]',
        ',"ttps":[{"id":', technique, ',"name":', lang_text, ',"confidence":2},{"id":"T1059","reason":', body, "}]",
        ',"iocs":{"domains":[', _quoted(F.concat(source, F.lit(".COM"))), ",", _quoted(F.concat(lang, F.lit(".net"))), ",",
        _quoted(F.concat(lang, F.lit(".net"))), ',""],"hashes":["', F.md5(d.cast("string")), '","zz"],"urls":"none"}',
        ',"key_findings":[{"title":', body, ',"severity":', d % 6, ',"why_it_matters":', source_text,
        ',"evidence_ids":["sig_2"]}]',
        ',"analyst_actions":{"soc":[', _quoted(F.concat(F.lit("check "), source)), ",",
        _quoted(F.concat(F.lit("check "), source)), '],"ir":[', body, "]}",
        ',"uncertainties":[', lang_text, ",", body, '],"model_metadata":{"provider":"claimed","model":', lang_text, "}}",
    )


def responses_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All derived replies."""
    return _ingested(spark, sf_dir, "responses", derived_responses)


def derived_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``task_id, body, transport_error, transport_detail``: eight forms of content in ten forms of envelope."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    d = F.col("doc_id")
    rows = documents.repartition(_partitions(spark), "doc_id").join(labels, "doc_id", "left")
    rows = rows.withColumn("answer", _reply_object(True))
    answer = F.col("answer")
    content = _pick(d % 8, {
        0: answer, 1: _text("Here it is\n```json\n", answer, "\n```\nbye"), 2: _text("Result: ", answer, " done"),
        3: F.lit("no json here"), 4: F.lit("[1, 2]"), 5: F.concat(answer, answer), 6: _reply_object(False), 7: F.lit(" \n "),
    })
    form = F.expr("(doc_id div 8) % 10")
    usual = _text('{"id":', d, ',"choices":[{"index":0,"message":{"role":"assistant","content":', _quoted(content), "}}]}")
    body = _pick(form, {
        5: F.lit('{"choices":[]}'), 6: F.lit("oops{"), 7: F.lit(None).cast("string"), 8: F.lit('{"choices":["text"]}'),
    }, usual)
    error = F.when(form == 7, F.when(d % 2 == 0, F.lit("timeout")).otherwise(F.lit("http_error")))
    return rows.select(
        _text("p", d).alias("task_id"), body.alias("body"), error.alias("transport_error"),
        F.when((form == 7) & (d % 2 == 1), F.lit("500")).alias("transport_detail"),
    )
