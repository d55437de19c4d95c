"""What the quick paths of text functions must keep."""

from triagelake.functions.pyformat import json_string
from triagelake.functions.sql import let
from triagelake.functions.text import sanitize


def test_let_binds_null_text_and_lists(spark):
    row = spark.range(1).selectExpr(
        f"{let('a', 'CAST(NULL AS STRING)', 'a IS NULL')} AS x", f"{let('b', 'array(1, 2)', 'size(b) + b[0]')} AS y").first()
    assert (row.x, row.y) == (True, 3)
    assert "transform(" not in let("a", "1", "a")


def test_quoting_without_escapes_equals_to_json(texts):
    values = ["", "plain", 'a"b', "a\\b", "tab\t", "line\n", "é", "\x7f", "a/b", "[x]{y}", None]
    rows = texts(values).selectExpr("text", f"{json_string('text')} AS quick", "to_json(array(text)) AS listed").collect()
    assert [r.quick for r in rows] == [r.listed[1:-1] for r in rows]


def test_tidy_test_sees_every_untidy_form(texts):
    values = {"a b": "a b", " a": "a", "a ": "a", "a  b": "a b", "a\n": "a", "a\x00b": "a?b", "x```y```z": "x[code_block_removed]z", "é": "?"}
    rows = texts(list(values)).selectExpr("text", f"{sanitize('text')} AS clean").collect()
    assert {r.text: r.clean for r in rows} == values
