"""Guards and conversions for VARIANT values (SQL expression -> SQL expression).

Report and reply documents have no fixed schema: any key may be missing and any node may hold the wrong type.  The guard
used everywhere is one ``try_variant_get(doc, path, <typed schema>)`` per area.  Casting a VARIANT to a struct or an array
gives NULL for a node of another type and keeps its siblings, also inside arrays, so a wrong node costs only itself and
positions stay as they were in the document.
"""

from __future__ import annotations

from triagelake.functions.pyformat import record_text, spaced_json
from triagelake.functions.sql import array, case, let, lit, lits

ANY_LIST = "array<variant>"

# The characters Unicode counts as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    + "".join(map(chr, range(0x2000, 0x200B)))
    + "\u2028\u2029\u202f\u205f\u3000"
)

# Decimal number text: digits may be grouped by single underscores.
_DIGITS = "[0-9]+(?:_[0-9]+)*"
NUMERIC_TEXT = rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$"

# String forms of the VARIANT values that count as false, besides NULL and empty text.
_FALSE_FORMS = lits("false", "0", "0.0", "-0.0", "[]", "{}")


def struct_type(*fields: str, **typed: str) -> str:
    """DDL of a struct whose plain ``fields`` stay VARIANT and whose ``typed`` fields have the given type."""
    parts = [f"{name}: variant" for name in fields] + [f"{name}: {ddl}" for name, ddl in typed.items()]
    return f"struct<{', '.join(parts)}>"


def array_type(element: str) -> str:
    return f"array<{element}>"


def typed_at(doc: str, path: str, ddl: str) -> str:
    """The node at ``path`` as ``ddl``, NULL where the node is missing or of another type."""
    return f"try_variant_get({doc}, {lit(path)}, {lit(ddl)})"


def as_list(value: str) -> str:
    """A VARIANT as ARRAY<VARIANT>, NULL unless it is a list."""
    return typed_at(value, "$", ANY_LIST)


def is_record(value: str) -> str:
    """True for a JSON object. The one-field struct cast looks up a single key, however large the object is."""
    return f"({typed_at(value, '$', 'struct<a: variant>')} IS NOT NULL)"


def kind(value: str) -> str:
    return f"schema_of_variant({value})"


def is_text(value: str) -> str:
    return f"({kind(value)} <=> 'STRING')"


def plain_text(value: str) -> str:
    """The VARIANT cast to text: scalars as they are, records as compact JSON."""
    return typed_at(value, "$", "string")


def as_integer(value: str) -> str:
    """BIGINT for JSON integers and booleans (1/0), NULL for everything else, fractions like 5.0 included."""
    return case((f"{kind(value)} IN ('BIGINT', 'BOOLEAN')", typed_at(value, "$", "bigint")))


def truthy(value: str) -> str:
    """False for NULL, JSON null, false, zero, and empty text, lists and objects."""
    text = plain_text(value)
    test = case((f"{kind(value)} = 'STRING'", f"{text} <> ''"), otherwise=f"{text} NOT IN ({_FALSE_FORMS})")
    return f"coalesce({test}, false)"


def first_truthy(first: str, second: str) -> str:
    return case((truthy(first), first), otherwise=second)


def _with_fraction(value: str, text: str | None = None, shape: str | None = None) -> str:
    """Plain text in which 1.0, stored as a whole decimal, has its fraction back.

    A whole decimal in the range of BIGINT was written with a fraction, as integers of that range are stored as BIGINT; beyond it
    the digits are those of an integer.
    """
    text, shape = text or plain_text(value), shape or kind(value)
    whole = f"{shape} LIKE 'DECIMAL%' AND NOT contains({text}, '.') AND try_cast({text} AS bigint) IS NOT NULL"
    return case((whole, f"concat({text}, '.0')"), otherwise=text)


def display_text(value: str, document_text: str | None = None) -> str:
    """Text of a VARIANT as analysts see it: '' for falsy values, True for true, 1.0 for 1.0, records in full.

    ``document_text`` is the JSON text of the value where its key order is known; VARIANT itself sorts keys.  Pass a name:
    ``value`` is used several times, which is free for a lambda variable and costly for a computed expression.
    """
    known = _with_fraction(value, "dt", "dk")
    if document_text is not None:
        known = case(("dk LIKE 'OBJECT%' OR dk LIKE 'ARRAY%'", document_text), otherwise=known)
    shown = case(
        ("dk = 'STRING'", "dt"),
        (f"dt IS NULL OR dt IN ({_FALSE_FORMS})", "''"),
        ("dk = 'BIGINT'", "dt"),
        otherwise=record_text(known),
    )
    return let("dk", kind(value), let("dt", plain_text(value), shown))


def display_texts(values: str) -> str:
    """``display_text`` of each element of an ARRAY<VARIANT>."""
    return f"transform({values}, dv -> {display_text('dv')})"


def display_text_lists(*lists: str) -> str:
    """``display_texts`` of several lists as one ARRAY<ARRAY<STRING>>, which keeps the expression small."""
    return f"transform({array(*lists)}, dl -> {display_texts('dl')})"


def json_fragment(value: str) -> str:
    """JSON text of a VARIANT with spaces as in prompts; NULL and JSON null give ``null``."""
    text = case((f"{kind(value)} LIKE 'DECIMAL%'", _with_fraction(value)), otherwise=f"to_json({value})")
    return case((f"{value} IS NULL OR is_variant_null({value})", "'null'"), otherwise=spaced_json(text))


def clamp_unit(number: str) -> str:
    """Clamp a DOUBLE into [0, 1]; NULL gives 0 and NaN stays NaN."""
    return let("cu", number, case(
        ("cu IS NULL OR cu < 0", "0D"), ("isnan(cu)", "cu"), ("cu > 1", "1D"), otherwise="cu",
    ))


def confidence(value: str) -> str:
    """Clamp a VARIANT number, boolean or numeric text into [0, 1]; everything else gives 0."""
    number = let("ct", strip(plain_text(value)), case(
        (f"{kind(value)} <> 'STRING'", typed_at(value, "$", "double")),
        (f"ct RLIKE {lit(NUMERIC_TEXT)}", "try_cast(replace(ct, '_', '') AS double)"),
        ("lower(ct) IN ('nan', '+nan', '-nan')", "double('NaN')"),
        ("lower(ct) IN ('inf', '+inf', 'infinity', '+infinity')", "1D"),
    ))
    return clamp_unit(number)


def strip(text: str) -> str:
    """Remove Unicode white space from both ends, in linear time also for long inner runs."""
    return f"btrim({text}, {lit(WHITESPACE)})"


def wrapped_json(text: str) -> str:
    """Strict parse: the VARIANT if ``text`` is exactly one JSON value, else NULL.

    Spark's parser ignores text after the first value.  So the text is parsed as the first element of a list whose second
    element is the text's own checksum: the checksum is found there only if the text is one complete value.
    """
    listed = f"""try_parse_json(concat('[', {text}, ',"', md5({text}), '"]'))"""
    closed = f"{typed_at('wj', '$[1]', 'string')} = md5({text})"
    return let("wj", listed, case((closed, typed_at("wj", "$[0]", "variant"))))


def named_numbers(text: str) -> str:
    """Quote bare NaN and Infinity values, but not those inside strings, so that a document using them still parses.

    One pass marks the end of each string and puts the mark alone in the place of each bare name; the mark is a control character
    that no JSON text holds.
    """
    for literal, quoted in (("NaN", "nan"), ("-Infinity", "-inf"), ("Infinity", "inf")):
        pattern = rf"(\"(?:[^\"\\]++|\\.)*+\")|(?<=[\[,:\s]){literal}(?=\s*(?:[,\]}}]|$))"
        marked = f"regexp_replace({text}, {lit(pattern)}, {lit('$1' + chr(1))})"
        text = f"replace(replace({marked}, {lit(chr(34) + chr(1))}, {lit(chr(34))}), {lit(chr(1))}, {lit(chr(34) + quoted + chr(34))})"
    return text


def strict_json(text: str) -> str:
    """``wrapped_json`` that also accepts the number names NaN, Infinity and -Infinity as values."""
    named = let("nn", named_numbers("concat(' ', sj)"), wrapped_json("nn"))
    spelled = "contains(sj, 'NaN') OR contains(sj, 'Infinity')"
    return let("sj", text, f"coalesce({wrapped_json('sj')}, {case((spelled, named))})")
