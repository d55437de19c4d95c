"""Quoting for SQL expressions.

The building blocks of this package are functions from SQL expressions to SQL expressions, used with ``F.expr`` and
``selectExpr``.  An expression of a few hundred nodes then reaches Spark as one string; built from Column objects, every node
would be a call into the JVM, and planning a report query took longer than running it.
"""

from __future__ import annotations


def lit(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def lits(*texts: str) -> str:
    """A comma-separated list of string literals."""
    return ", ".join(lit(text) for text in texts)


def case(*branches: tuple[str, str], otherwise: str | None = None) -> str:
    """CASE over (condition, value) pairs."""
    parts = [f"WHEN {condition} THEN {value}" for condition, value in branches]
    parts += [f"ELSE {otherwise}"] if otherwise is not None else []
    return f"CASE {' '.join(parts)} END"


def replace(text: str, pattern: str, by: str) -> str:
    return f"regexp_replace({text}, {lit(pattern)}, {lit(by)})"


def concat(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def array(*items: str) -> str:
    return f"array({', '.join(items)})"


def struct(**fields: str) -> str:
    """named_struct(...)"""
    return f"named_struct({', '.join(f'{lit(name)}, {value}' for name, value in fields.items())})"


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is thus computed once however often ``body`` uses it.

    ``value`` is the start of a sum over nothing and ``body`` its last step.  One entry of a transformed list would do too, but reading it
    asks the whole of ``body`` for its type, row by row, and copies the result.
    """
    return f"aggregate(array(), {value}, (unchanged, nothing) -> unchanged, {name} -> {body})"
