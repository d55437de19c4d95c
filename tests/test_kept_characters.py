"""The class of characters that clean-up replaces: the rare kept ones apart, so that usual text is not compared with each of them."""

from triagelake.functions.sql import lit
from triagelake.functions.text import KEPT_CJK, UNPRINTABLE


def test_rare_characters_are_a_class_of_their_own(texts):
    assert UNPRINTABLE.endswith(f"[{KEPT_CJK}]]")
    plain = r"[^\t\n\r\x20-\x7e" + KEPT_CJK + "]"
    every = "".join(chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000) + "\U0001F600"
    row = texts([every]).selectExpr(
        f"regexp_replace(text, {lit(UNPRINTABLE)}, '?') AS found", f"regexp_replace(text, {lit(plain)}, '?') AS expected").first()
    assert row.found == row.expected and row.found.count("?") > 60000
