"""Quality rules as weak supervision: each rule votes or abstains, and what the votes are worth is estimated from all documents.

Per document a handful of measures is taken by Spark's own functions.  Each rule turns measures into a vote to keep (1), to drop (-1)
or none (0).  The patterns of votes are counted over all documents (at most 3 to the power of their number), expectation-maximisation estimates how often each
rule votes how on good and on bad documents, and the posterior probability of a good document replaces passing every single filter.

Defined results: a null or empty text has no words; it fails the base (fewer than 20 words).  Rows that repeat an id are judged each by
themselves.  An empty table gives an empty result.  Further columns do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.functions.sql import let
from triagelake.llm.common import stored
from triagelake.llm.votes import Reliabilities, estimate

WINDOW = 8
_SPACE = r"' \t\n\u000B\u000C\r'"

#: rule: (to drop if, to keep if); in between it abstains.
RULES = {
    "length": ("n_words < 20", "n_words >= 40"),
    "word_length": ("word_chars < 2 * n_words OR word_chars > 14 * n_words", "word_chars BETWEEN 3 * n_words AND 10 * n_words"),
    "symbols": ("10 * n_symbols > n_words", "50 * n_symbols <= n_words"),
    "lines": ("2 * n_dup_lines > n_lines", "10 * n_dup_lines <= n_lines"),
    "repeats": ("10 * n_repeat_words > 3 * n_words", "50 * n_repeat_words <= n_words"),
    "capitals": ("10 * n_capitals > 4 * n_letters", "100 * n_capitals <= 15 * n_letters"),
    "variety": ("10 * n_distinct < 2 * n_words", "10 * n_distinct >= 3 * n_words"),
    "bare": ("10 * n_bare > 2 * n_words", "50 * n_bare <= n_words"),
    "letters": ("10 * n_letters < 6 * word_chars", "10 * n_letters >= 8 * word_chars"),
}
#: Belief before any document is seen: chance of the votes (-1, 0, 1) on bad and on good documents.
BELIEVED = ((0.25, 0.10, 0.65), (0.005, 0.065, 0.93))
PRIOR = 0.85
#: The rules abstain in doubt, so a good document gets a vote to drop from one of them with this chance at most.  A bad document mostly
#: breaks one rule and passes the others; without this bound nothing but votes that agree could tell it from a good one.
MOST_FALSE = 0.01


def measures() -> dict[str, str]:
    """SQL of each measure; the text and its words are named ``t`` and ``w``."""
    numbers = "transform(w, x -> xxhash64(x))"
    windows = f"transform(sequence(1, size(h) - {WINDOW - 1}), i -> xxhash64(slice(h, i, {WINDOW})))"
    # Windows side by side with their places, in the order of their hashes: equal ones are neighbours.
    ordered = "array_sort(transform(v, (x, i) -> struct(x AS x, i AS i)))"
    twice = ("array_sort(filter(transform(s, (a, k) -> CASE WHEN a.x = get(s, k - 1).x OR a.x = get(s, k + 1).x THEN a.i END), "
             "i -> i IS NOT NULL))")
    covered = f"aggregate(transform(p, (a, k) -> least({WINDOW}, coalesce(get(p, k + 1) - a, {WINDOW}))), 0L, (a, x) -> a + x)"
    counted = let("s", ordered, let("p", twice, covered))
    repeated = let("h", numbers, let("v", windows, f"CASE WHEN size(array_distinct(v)) = size(v) THEN 0L ELSE {counted} END"))
    lines = r"filter(split(t, '\n', -1), l -> l RLIKE '[^\\x20\\x09-\\x0D]')"
    return {
        "n_words": "bigint(size(w))",
        "word_chars": f"bigint(length(translate(t, {_SPACE}, '')))",
        "n_symbols": "bigint(length(t) - length(translate(t, '#*$%&|<>', '')))",
        "dup": let("l", lines, "struct(bigint(size(l)) AS n_lines, bigint(size(l) - size(array_distinct(l))) AS n_dup_lines)"),
        "n_repeat_words": f"CASE WHEN size(w) <= {WINDOW} THEN 0L ELSE {repeated} END",
        "n_distinct": "bigint(size(array_distinct(w)))",
        "n_bare": r"bigint(size(filter(w, x -> NOT x RLIKE '\\p{L}')))",
        "n_letters": r"bigint(length(regexp_replace(t, '[^\\p{L}]++', '')))",
        "n_capitals": r"bigint(length(regexp_replace(t, '[^\\p{Lu}]++', '')))",
    }


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the measures of every row of ``docs`` (doc_id, text)."""
    fields = ", ".join(f"{sql} AS {name}" for name, sql in measures().items())
    words = r"regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+', 0)"
    whole = let("t", "coalesce(text, '')", let("w", words, f"struct({fields})"))
    rows = docs.selectExpr("doc_id", f"{whole} AS m").select("doc_id", "m.*")
    return rows.select("doc_id", *(c for c in measures() if c != "dup"), "dup.n_lines", "dup.n_dup_lines")


def _vote(rule: str) -> str:
    drop, keep = RULES[rule]
    return f"CASE WHEN {drop} THEN -1 WHEN {keep} THEN 1 ELSE 0 END"


def voted(docs: DataFrame) -> DataFrame:
    """Measures, votes (an array in the order of RULES) and base_failed, written once: what follows reads no text again."""
    base = "n_words < 20 OR 100 * n_repeat_words > 30 * n_words"
    votes = f"array({', '.join(map(_vote, RULES))})"
    return stored(measured(docs).selectExpr("*", f"{base} AS base_failed", f"{votes} AS votes"), "votes")


def reliabilities(rows: DataFrame) -> Reliabilities:
    """Estimated over the patterns of votes of all rows."""
    patterns = rows.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # 3 ** len(RULES) at most
    return estimate({tuple(r.votes): r.n for r in patterns}, PRIOR, [BELIEVED] * len(RULES), most_false=MOST_FALSE)


def posterior(found: Reliabilities) -> str:
    """SQL of the probability of a good document, from ``votes``."""
    odds = [repr(math.log(found.prior / (1 - found.prior))) + "D"]
    for i, (bad, good) in enumerate(found.given):
        worth = [repr(math.log(g / b)) + "D" for b, g in zip(bad, good)]
        odds.append(f"element_at(array({', '.join(worth)}), votes[{i}] + 2)")
    return f"1 / (1 + exp(-({' + '.join(odds)})))"


def judged(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: the base, the verdict and the posterior probability behind it."""
    rows = voted(docs)
    chance = posterior(reliabilities(rows))
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return rows.selectExpr(*columns, f"NOT base_failed AND {chance} >= 0.5 AS kept", f"{chance} AS quality", "votes")
