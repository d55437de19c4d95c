"""List operators on ARRAY values (SQL expression -> SQL expression). They work inside one row, so none of them shuffles."""

from __future__ import annotations

from collections.abc import Callable

from triagelake.functions.sql import lit
from triagelake.functions.text import sanitize
from triagelake.functions.variants import strip


def or_empty(values: str) -> str:
    return f"coalesce({values}, array())"


def dedupe_first_seen(values: str) -> str:
    """Distinct strings without white space around them, in order of first appearance; blank ones are left out."""
    return f"array_distinct(filter(transform({values}, t -> {strip('t')}), t -> t <> ''))"


def first_n(values: str, limit: int) -> str:
    return f"slice({values}, 1, {max(0, limit)})"


def sanitize_texts(texts: str, max_len: int, redact: bool, limit: int | None = None) -> str:
    """Sanitise each string of an ARRAY<STRING>, then drop repeats, then cut; NULL gives [].

    Equal texts stay equal when cleaned, so repeats are dropped before the costly cleaning too; their order is the same.  Cleaned
    text holds no white space but single spaces.
    """
    clean = f"transform(array_distinct({texts}), st -> trim({sanitize('st', max_len, redact)}))"
    cleaned = f"array_distinct(filter({clean}, st -> st <> ''))"
    return or_empty(cleaned if limit is None else first_n(cleaned, limit))


def sorted_distinct(values: str) -> str:
    """Distinct strings by code point."""
    return f"sort_array(array_distinct({values}))"


def numbered(prefix: str, position: str) -> str:
    """1-based name such as ``proc_3`` for a 0-based position."""
    return f"concat({lit(prefix)}, string({position} + 1))"


def keep_numbered(values: str, prepare: Callable[[str], str], build: Callable[[str, str], str], limit: int) -> str:
    """Build one struct per non-NULL element, numbered by its raw position, and keep the first ``limit`` of them.

    Positions count the NULL elements too, so a name such as ``proc_2`` still points at the second entry of the report.
    Elements are numbered and cut before anything is computed for them.  ``prepare`` computes what ``build`` uses more than
    once.
    """
    placed = f"transform({values}, (v, i) -> named_struct('at', i, 'item', v))"
    kept = first_n(f"filter({placed}, p -> p.item IS NOT NULL)", limit)
    prepared = f"transform({kept}, p -> named_struct('at', p.at, 'item', {prepare('p.item')}))"
    return f"transform({prepared}, p -> {build('p.item', 'p.at')})"
