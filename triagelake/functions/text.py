"""Clean-up and canonical forms of untrusted text (SQL expression -> SQL expression)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from triagelake.functions.sql import case, concat, let, lit, lits, replace
from triagelake.functions.variants import strip

# The characters kept besides printable ASCII.
KEPT_CJK = "中文，。；：！？（）【】《》、“”‘’"

CODE_BLOCK = r"(?s)```.*?```"
CODE_BLOCK_MARK = "[code_block_removed]"
# The rare characters are a class of their own, looked at last: else each character is compared with all of them.
UNPRINTABLE = r"[^\t\n\r\x20-\x7e[" + KEPT_CJK + "]]"

# Schemes whose URL keeps an empty authority ("file:///tmp").
AUTHORITY_SCHEMES = (
    "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file", "mms", "https", "shttp", "snews", "prospero",
    "rtsp", "rtsps", "rtspu", "rsync", "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss", "itms-services",
)

ATTACK_ID = r"^T[0-9]{4}(\.[0-9]{3})?$"
HASH = "^[a-fA-F0-9]{32,64}$"


# Printable ASCII to the last character; one pass without alternatives, as evidence packages are long.
PRINTABLE = r"\A[ -~]*+\z"


def redact_paths(text: str) -> str:
    """Hide account names in Windows and Unix profile paths."""
    text = replace(text, r"(?i)\\Users\\[^\\\s]+", r"\\Users\\<redacted>")
    return replace(text, r"(?i)/home/[^/\s]+", "/home/<redacted>")


def _tidy(text: str) -> str:
    """Control characters are among the unprintable ones and no part of a fence, so one replacement serves for both."""
    text = case((f"contains({text}, '```')", replace(text, CODE_BLOCK, CODE_BLOCK_MARK)), otherwise=text)
    return f"trim({replace(replace(text, UNPRINTABLE, '?'), r'[ \t\n\r]+', ' ')})"


def _untidy(text: str) -> str:
    """Text that clean-up would change: anything but printable ASCII, a code fence, or blanks that are doubled or at an end."""
    return (f"NOT {text} RLIKE {lit(PRINTABLE)} OR contains({text}, '  ') OR startswith({text}, ' ') OR endswith({text}, ' ') "
            f"OR contains({text}, '```')")


def clean_column(rows: DataFrame, text: str, max_len: str, redacted: str, name: str) -> DataFrame:
    """``rows`` with ``name``: ``sanitize`` of a column, each step a column of its own, which Spark compiles (it interprets ``let``).

    ``max_len`` and ``redacted`` are SQL and may differ by row.
    """
    names = [f"__{name}_{step}" for step in ("given", "tidy", "shown")]
    given, tidy, shown = names
    slash = f"({redacted}) AND (contains({tidy}, '/') OR contains({tidy}, {lit(chr(92))}))"
    rows = rows.selectExpr("*", f"coalesce({text}, '') AS {given}")
    rows = rows.selectExpr("*", f"{case((_untidy(given), _tidy(given)), otherwise=given)} AS {tidy}")
    rows = rows.selectExpr("*", f"{case((slash, redact_paths(tidy)), otherwise=tidy)} AS {shown}")
    return rows.selectExpr("*", f"substring({shown}, 1, {max_len}) AS {name}").drop(*names)


def sanitize(text: str, max_len: int = 256, redact: bool = True) -> str:
    """Printable, single-spaced text of at most ``max_len`` characters; NULL becomes ''.

    The order matters: code blocks, unprintable characters, white space, account names, cut.  Most
    artefacts are tidy already, so one test saves them the replacements, and text without a slash the redaction.
    """
    tidy = let("sx", f"coalesce({text}, '')", case((_untidy("sx"), _tidy("sx")), otherwise="sx"))
    if redact:
        slash = f"contains(sy, '/') OR contains(sy, {lit(chr(92))})"
        tidy = let("sy", tidy, case((slash, redact_paths("sy")), otherwise="sy"))
    return f"substring({tidy}, 1, {max_len})"


def severity_label(text: str, allow_unknown: bool = True) -> str:
    """low, medium, high, critical or unknown for a free-form severity."""
    return let("sv", f"lower({strip(f'coalesce({text}, {lit(str())})')})", case(
        ("sv IN ('low', 'medium', 'high', 'critical')", "sv"),
        ("sv IN ('1', 'info', 'informational')", "'low'"),
        ("sv IN ('2', 'moderate')", "'medium'"),
        ("sv IN ('3', 'severe')", "'high'"),
        ("sv IN ('4', '5')", "'critical'"),
        otherwise="'unknown'" if allow_unknown else "'low'",
    ))


def canonical_domain(text: str) -> str:
    return f"btrim(lower({sanitize(text, 255, redact=False)}), '.')"


def canonical_ip(text: str) -> str:
    return sanitize(text, 64, redact=False)


def canonical_url(text: str, max_len: int = 300) -> str:
    """Lower-case scheme and authority, bounded path and query, no fragment.

    A URL with a malformed authority is kept as it is, cut to ``max_len``.
    """
    return let("url", sanitize(text, max_len * 2, redact=False), _rebuilt_url(max_len))


_BYTE = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
_IPV4 = rf"{_BYTE}(?:\.{_BYTE}){{3}}"
_GROUP = "[0-9a-fA-F]{1,4}"


def _ipv6_pattern() -> str:
    tail = rf"(?:{_GROUP}:{_GROUP}|{_IPV4})"
    forms = [rf"(?:{_GROUP}:){{6}}{tail}"]
    for after in range(5, -1, -1):
        # "::" stands for at least one group; `after` full groups and the two-group tail follow it.
        before = 5 - after
        head = rf"(?:{_GROUP}(?::{_GROUP}){{0,{before - 1}}})?" if before else ""
        forms.append(rf"{head}::(?:{_GROUP}:){{{after}}}{tail}")
    forms.append(rf"(?:{_GROUP}(?::{_GROUP}){{0,5}})?::{_GROUP}")
    forms.append(rf"(?:{_GROUP}(?::{_GROUP}){{0,6}})?::")
    return rf"(?:{'|'.join(forms)})(?:%[^%]+)?"


BRACKETED_HOST = rf"^(?:.*@)?\[(?:v[a-fA-F0-9]+\..+|{_ipv6_pattern()})\](?::.*)?$"

# Authority, path and query of what follows the scheme.
URL_PARTS = r"^(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?"


def _rebuilt_url(max_len: int) -> str:
    """The URL named ``url``, taken apart and put together again."""
    scheme = f"lower(regexp_extract(url, {lit(r'^([A-Za-z][A-Za-z0-9+.\-]*):')}, 1))"
    rest = case(("scheme = ''", "url"), otherwise="substring(url, length(scheme) + 2)")
    authority, path, query = (f"regexp_extract(rest, {lit(URL_PARTS)}, {group})" for group in (1, 2, 3))
    body = case(
        ("p.authority <> '' AND p.path <> '' AND NOT startswith(p.path, '/')", "concat('//', p.authority, '/', p.path)"),
        ("p.authority <> ''", "concat('//', p.authority, p.path)"),
        ("startswith(p.path, '//')", "concat('//', p.path)"),
        (f"scheme IN ({lits(*AUTHORITY_SCHEMES)}) AND (p.path = '' OR startswith(p.path, '/'))", "concat('//', p.path)"),
        otherwise="p.path",
    )
    full = concat(
        "CASE WHEN scheme <> '' THEN concat(scheme, ':') ELSE '' END", body,
        "CASE WHEN length(p.query) > 80 THEN concat('?', substring(p.query, 1, 80), '...') "
        "WHEN p.query <> '' THEN concat('?', p.query) ELSE '' END",
    )
    # Unpaired or misplaced brackets, a bracketed host that is no address, or a wide ':' or '?'.
    malformed = (
        f"(p.authority RLIKE {lit(r'[\[\]]')} AND NOT p.authority RLIKE {lit(BRACKETED_HOST)}) OR p.authority RLIKE '[：？]'"
    )
    parts = f"named_struct('authority', lower({authority}), 'path', substring({path}, 1, 140), 'query', {query})"
    rebuilt = f"substring({case((malformed, 'url'), otherwise=full)}, 1, {max_len})"
    return let("scheme", scheme, let("rest", rest, let("p", parts, rebuilt)))


def attack_id(text: str) -> str:
    """Upper-case technique id, '' if empty, NULL if it is not of the form T1234 or T1234.567."""
    return let("tid", f"upper({sanitize(text, 16, redact=False)})",
               case((f"tid = '' OR tid RLIKE {lit(ATTACK_ID)}", "tid")))


def is_hash(text: str) -> str:
    return f"({text} RLIKE {lit(HASH)})"
