"""What long lists must not do more than once, or for more rows than they need."""

from triagelake.functions.text import CODE_BLOCK_MARK, clean_column, sanitize
from triagelake.operators import long_evidence
from triagelake.operators.evidence import HASH_LIMIT

ENTRY = "row long, task_id string, kind string, pos int, text string"
NAMES = {"keys": (256, True), "files": (256, True), "mutexes": (256, False)}


def _plan(rows):
    return rows._jdf.queryExecution().optimizedPlan().toString()


def test_indicators_number_only_what_lies_behind_the_limit(spark, monkeypatch):
    numbered = []
    keep = long_evidence.number_rows

    def counted(rows, group, order, *rest):
        numbered.append((tuple(order), rows.count()))
        return keep(rows, group, order, *rest)

    monkeypatch.setattr(long_evidence, "number_rows", counted)
    entries = [(1, "t", "keys", p, f"k{p}") for p in range(1, 4)] + [(2, "t", "files", p, v) for p, v in enumerate("aabcbd", 1)]
    entries += [(2, "t", "ips", p, v) for p, v in enumerate(["", "9", "", "8", "9", "7"], 1)] + [(None, "n", "files", p, f"f{p}") for p in range(1, 6)]
    found = long_evidence.ioc_lists(spark.createDataFrame(entries, ENTRY), NAMES, 3, 2, HASH_LIMIT).collect()
    assert numbered[0] == (("first",), 7)  # c, d, f4, f5; 8, 9, 7
    assert sorted((r.task_id, r.kind, r.pos, r.value) for r in found) == [
        ("n", "file_paths", 1, "f1"), ("n", "file_paths", 2, "f2"), ("n", "file_paths", 3, "f3"),
        ("t", "file_paths", 1, "a"), ("t", "file_paths", 2, "b"), ("t", "file_paths", 3, "c"), ("t", "ips", 1, "8"), ("t", "ips", 2, "9"),
        ("t", "registry_keys", 1, "k1"), ("t", "registry_keys", 2, "k2"), ("t", "registry_keys", 3, "k3")]


def test_entries_are_cleaned_once(spark):
    entries = spark.createDataFrame([(1, "t", "files", 1, "a```b```"), (1, "t", "files", 2, " "), (1, "t", "other", 3, "x")], ENTRY)
    rows = long_evidence.cleaned(entries, NAMES)
    assert _plan(rows).count(CODE_BLOCK_MARK) == 1
    assert [r.value for r in rows.collect()] == ["a" + CODE_BLOCK_MARK]


def test_clean_column_equals_sanitize(texts):
    values = ["", " a ", None, "é x", "a\n b", "x```y```z", "```", "C:\\Users\\bob\\c d", "/home/bob/x", "中文 \u2003", "y" * 400, "a" * 255 + " b"]
    rows = texts(values)
    for redact in (True, False):
        found = clean_column(rows, "text", "256", str(redact), "clean").selectExpr("clean", f"{sanitize('text', 256, redact)} AS expected")
        assert all(r.clean == r.expected for r in found.collect())
