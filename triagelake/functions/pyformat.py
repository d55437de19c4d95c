"""Text forms of numbers and records (SQL expression -> SQL expression).

Records inside lists (network traffic, for instance) are shown as text with single quotes, ``True``/``None`` and shortest
round-trip floats; documents inside prompts are JSON with a space after ``,`` and ``:``.  Both work on compact JSON text
cut into tokens.  Escaped backslashes and quotes are first swapped for two control characters, which JSON text never holds
raw, so that a string token is simply ``"[^"]*"`` and no pattern needs to recurse.
"""

from __future__ import annotations

from triagelake.functions.sql import case, concat, let, lit, lits, replace

_BACKSLASH = "\x01"
_QUOTE = "\x02"
PLAIN = r"\A[ !#-\[\]-~]*+\z"
_TOKEN = r'"[^"]*+"|[^",:\[\]{}]++|[,:\[\]{}]'


def double_text(number: str) -> str:
    """Shortest text of a DOUBLE: plain from 1e-4 up to 1e16, else with a signed exponent of two digits or more."""
    digits = "trim(TRAILING '0' FROM string(try_cast(d AS decimal(38,21))))"
    power = "regexp_replace(substring_index(string(d), 'E', -1), '^-', '')"
    exponent = concat(
        "CASE WHEN string(d) LIKE '%E-%' THEN '-' ELSE '+' END", f"CASE WHEN length({power}) < 2 THEN '0' ELSE '' END", power
    )
    return let("d", number, case(
        ("isnan(d)", "'nan'"),
        ("string(d) = 'Infinity'", "'inf'"),
        ("string(d) = '-Infinity'", "'-inf'"),
        ("NOT contains(string(d), 'E')", "string(d)"),
        ("abs(d) >= 1e-4D AND abs(d) < 1e16D", replace(digits, r"\.$", ".0")),
        otherwise=concat(replace("substring_index(string(d), 'E', 1)", r"\.0$", ""), "'e'", exponent),
    ))


def _tokens(json_text: str) -> str:
    guarded = f"replace(replace({json_text}, {lit(chr(92) * 2)}, {lit(_BACKSLASH)}), {lit(chr(92) + chr(34))}, {lit(_QUOTE)})"
    return f"regexp_extract_all({guarded}, {lit(_TOKEN)}, 0)"


def _number_token(token: str) -> str:
    return case((f"{token} RLIKE '[.eE]'", double_text(f"try_cast({token} AS double)")), otherwise=token)


def _control_escapes(body: str) -> str:
    """Write ``\\u001F`` as ``\\x1f`` and the two escapes that only JSON knows as hexadecimal."""
    body = f"replace(replace({body}, {lits(chr(92) + 'b', chr(92) + 'x08')}), {lits(chr(92) + 'f', chr(92) + 'x0c')})"
    body = replace(body, r"\\u00([01])([0-9A-Fa-f])", r"\\x$1$2")
    for letter in "ABCDEF":
        body = replace(body, rf"(\\x[01]){letter}", f"$1{letter.lower()}")
    return body


def _hidden_characters(body: str) -> str:
    """Write non-printable characters as hexadecimal escapes."""
    digits = "lower(hex(encode(ch, 'UTF-32')))"
    shown = case(
        (f"ch IN ({lits(' ', _BACKSLASH, _QUOTE)}) OR NOT ch RLIKE {lit('^[' + chr(92) + 'p{C}' + chr(92) + 'p{Z}]$')}", "ch"),
        (f"{digits} LIKE '000000%'", concat(lit("\\x"), f"substring({digits}, 7, 2)")),
        (f"{digits} LIKE '0000%'", concat(lit("\\u"), f"substring({digits}, 5, 4)")),
        otherwise=concat(lit("\\U"), digits),
    )
    spread = f"array_join(transform(split({body}, '(?s)(?<=.)'), ch -> {shown}), '')"
    hidden = rf"[\p{{C}}\p{{Z}}&&[^ {_BACKSLASH}{_QUOTE}]]"
    return case((f"{body} RLIKE {lit(hidden)}", spread), otherwise=body)


def _quoted_token(token: str) -> str:
    escaped = let("inner", f"substring({token}, 2, length({token}) - 2)",
                  case((f"contains(inner, {lit(chr(92))})", _control_escapes("inner")), otherwise="inner"))
    double = concat(lit('"'), "body", lit('"'))
    single = concat(lit("'"), f"replace(body, {lits(chr(39), chr(92) + chr(39))})", lit("'"))
    quoted = case((f"contains({token}, {lit(chr(39))}) AND NOT contains({token}, {lit(_QUOTE)})", double), otherwise=single)
    shown = let("body", let("plain", escaped, _hidden_characters("plain")), quoted)
    return f"replace(replace({shown}, {lits(_BACKSLASH, chr(92) * 2)}), {lits(_QUOTE, chr(34))})"


def record_text(json_text: str) -> str:
    """Display form of a JSON record, e.g. ``{'port': 80, 'ok': True, 'note': None}``."""
    shown = case(
        ("tok = ','", "', '"),
        ("tok = ':'", "': '"),
        (f"startswith(tok, {lit(chr(34))})", _quoted_token("tok")),
        ("tok = 'true'", "'True'"),
        ("tok = 'false'", "'False'"),
        ("tok = 'null'", "'None'"),
        otherwise=_number_token("tok"),
    )
    return f"array_join(transform({_tokens(json_text)}, tok -> {shown}), '')"


def spaced_json(json_text: str) -> str:
    """JSON with one space after each ``,`` and ``:`` outside strings."""
    shown = case(
        ("tok = ','", "', '"),
        ("tok = ':'", "': '"),
        (f"startswith(tok, {lit(chr(34))}) OR tok IN ('[', ']', '{{', '}}', 'true', 'false', 'null')", "tok"),
        otherwise=_number_token("tok"),
    )
    joined = f"array_join(transform({_tokens(json_text)}, tok -> {shown}), '')"
    return f"replace(replace({joined}, {lits(_BACKSLASH, chr(92) * 2)}), {lits(_QUOTE, chr(92) + chr(34))})"


def json_string(text: str) -> str:
    """A STRING as a quoted JSON string; text without anything to escape is only put in quotes."""
    escaped = let("jq", "to_json(array(jt))", "substring(jq, 2, length(jq) - 2)")
    return let("jt", text, case((f"jt RLIKE {lit(PLAIN)}", concat(lit('"'), "jt", lit('"'))), otherwise=escaped))


def json_strings(values: str) -> str:
    """An ARRAY<STRING> as a JSON list with a space after each comma."""
    return concat("'['", f"array_join(transform({values}, js -> {json_string('js')}), ', ')", "']'")
