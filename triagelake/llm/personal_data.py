"""Personal data by weak supervision: labelers vote on candidate spans, and a classifier trained on what the votes are worth decides.

Candidates are the base matches of four kinds (e-mail addresses, IP addresses, card numbers, phone numbers) and looser ones that the
base does not take: addresses written with "at" and "dot", phone numbers without country code, IPv6 addresses.  Labelers are the form
itself (regex), gazetteers of known providers, issuers and area forms, and the words in front of the span (context).  Each votes for,
against, or not.  Expectation-maximisation over the counted patterns of votes estimates the labelers' reliabilities; its posteriors are
the soft labels on which a logistic span classifier is trained, with the votes and the kind as features.  Spans of the base always
stay; looser ones are added where the classifier says so and no base span of their kind overlaps.

Everything on the rows is Spark's own functions.  Places of matches follow from the matches and the gaps between them.  The patterns are
possessive, so long runs of digits or dots cost linear time and no stack.

Defined results: null counts as empty: no spans.  Rows that repeat an id are searched each by themselves.  Places count code points.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.functions.sql import let, lit
from triagelake.llm.common import stored
from triagelake.llm.votes import Reliabilities, estimate

KINDS = ("email", "ip", "card", "phone")

#: What each pattern takes is fixed; (?:\G|(?<!...)) only spares starts inside a run that would fail as its first character did.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){13,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?i)(?<![a-z0-9])[a-z0-9_-]{2,40}(?:\.[a-z0-9_-]{1,40}){0,4} ?[(\[{] ?at ?[)\]}] ?[a-z0-9-]{2,40}"
             r"(?: ?(?:[(\[{] ?dot ?[)\]}]|\.) ?[a-z]{2,12}){1,4}",
    "ip": r"(?i)(?<![0-9a-z:])(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}(?![0-9a-z:])",
    "card": r"(?<![0-9])3[47][0-9]{2}[.][0-9]{6}[.][0-9]{5}(?![0-9])",
    "phone": r"(?<![0-9+(.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9.-])",
}
#: A cheap look before a pattern runs.
MAY_HOLD = {
    "email": "instr(t, '@') > 0", "ip": r"t RLIKE '[0-9]\\.[0-9]'", "card": r"t RLIKE '[0-9](?:[ -]?[0-9]){13}'", "phone": "instr(t, '+') > 0",
}
MAY_HOLD_LOOSE = {
    "email": r"t RLIKE '(?i)[(\\[{] ?at ?[)\\]}]'", "ip": r"t RLIKE '(?:[0-9A-Fa-f]{1,4}:){7}'",
    "card": r"t RLIKE '3[47][0-9]{2}[.][0-9]{6}[.]'", "phone": r"t RLIKE '[0-9]{3}[-. ][0-9]{4}'",
}
_DIGITS = r"length(regexp_replace(m.value, '[^0-9]', ''))"
PASSES = {
    "email": "true",
    "ip": r"forall(split(m.value, '\\.'), x -> length(ltrim('0', x)) < 3 OR (length(ltrim('0', x)) = 3 AND ltrim('0', x) <= '255'))",
    "card": f"{_DIGITS} BETWEEN 14 AND 19 AND luhn_check(regexp_replace(m.value, '[^0-9]', ''))",
    "phone": f"{_DIGITS} BETWEEN 10 AND 15",
}
#: Labelers beside the form: SQL over the candidate ``m`` (value, before), as (for, against); fixed word lists.
GAZETTEER = {
    "email": (r"lower(m.value) RLIKE '(com|org|net|edu|gov|io|de|fr|es|uk|eu|info)$'",
              r"lower(m.value) RLIKE '(png|jpe?g|gif|svg|js|css|html?)$'"),
    "ip": (r"NOT m.value RLIKE '^(0|127|255)\\.' AND NOT m.value RLIKE '^[0-9](\\.[0-9]){3}$'", r"m.value RLIKE '^[0-9](\\.[0-9]){3}$'"),
    "card": (r"regexp_replace(m.value, '[^0-9]', '') RLIKE '^(4|5[1-5]|2[2-7]|3[47]|6)'",
             r"regexp_replace(m.value, '[^0-9]', '') RLIKE '^(0|1|7|8|9)'"),
    "phone": (r"m.value RLIKE '^(\\+[1-9]|\\([2-9]|[2-9])'", r"m.value RLIKE '^(\\+0|\\([01]|[01])'"),
}
CONTEXT = {
    "email": (r"e-?mail|mail|contact|correo|courriel|kontakt|write to|@", r"version|package|import"),
    "ip": (r"\\bip\\b|address|host|server|login|adresse|from", r"version|section|chapter|\\bv$|kapitel"),
    "card": (r"card|visa|master|amex|karte|carte|tarjeta|credit|payment", r"isbn|order|invoice|serial|tracking|\\bid\\b"),
    "phone": (r"tel|phone|call|fax|mobil|handy|whatsapp|contact", r"isbn|order|invoice|serial|version"),
}
BELIEVED = (
    ((0.55, 0.25, 0.20), (0.03, 0.07, 0.90)),  # form
    ((0.45, 0.35, 0.20), (0.05, 0.35, 0.60)),  # gazetteer
    ((0.10, 0.85, 0.05), (0.01, 0.74, 0.25)),  # context
)
PRIOR = 0.8
_SPANS = "array<struct<start:int,stop:int,value:string,before:string>>"


def _matches(pattern: str, when: str) -> str:
    """SQL of the matches of a pattern in ``t``, with their places and the 40 characters in front."""
    step = ("(a, i) -> named_struct('at', a.at + length(g[i]) + length(v[i]), 'found', concat(a.found, array(named_struct("
            "'start', a.at + length(g[i]), 'stop', a.at + length(g[i]) + length(v[i]), 'value', v[i], 'before', lower(right(g[i], 40))))))")
    first = f"named_struct('at', 0, 'found', cast(array() AS {_SPANS}))"
    walk = f"aggregate(sequence(0, size(v) - 1), {first}, {step}, a -> a.found)"
    found = let("v", f"regexp_extract_all(t, {lit(pattern)}, 0)",
                let("g", f"split(t, {lit(pattern)}, -1)", f"CASE WHEN size(v) > 0 THEN {walk} ELSE cast(array() AS {_SPANS}) END"))
    return f"CASE WHEN {when} THEN {found} ELSE cast(array() AS {_SPANS}) END"


def _vote(pro: str, contra: str) -> str:
    return f"CASE WHEN {contra} THEN -1 WHEN {pro} THEN 1 ELSE 0 END"


def _candidates(kind: str, base: bool) -> str:
    """SQL of the candidates of a kind: kind, start, stop, base, votes."""
    matches = _matches(BASE[kind], MAY_HOLD[kind]) if base else _matches(LOOSE[kind], MAY_HOLD_LOOSE[kind])
    if base:
        matches = f"filter({matches}, m -> {PASSES[kind]})"
    context = [f"m.before RLIKE '{words}'" for words in CONTEXT[kind]]
    votes = f"array({'1' if base else '0'}, {_vote(*GAZETTEER[kind])}, {_vote(*context)})"
    return (f"transform({matches}, m -> named_struct('start', m.start, 'rank', {KINDS.index(kind)}, 'stop', m.stop, 'base', {str(base).lower()}, "
            f"'votes', {votes}))")


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id and ``spans`` of every row: all candidates in the order of start and kind.  Written once; no text is read again."""
    own = ", ".join(_candidates(k, b) for b in (True, False) for k in KINDS)
    found = let("t", "coalesce(text, '')", f"array_sort(flatten(array({own})))")
    return stored(docs.selectExpr("doc_id", f"{found} AS spans"), "spans")


def _features(rank: int, votes: tuple[int, ...]) -> list[float]:
    return [1.0, *(float(rank == k) for k in range(1, len(KINDS))), *(float(v == s) for v in votes for s in (-1, 1))]


def train(counts: dict[tuple[int, tuple[int, ...]], int], rounds: int = 300) -> tuple[Reliabilities, list[float]]:
    """Reliabilities of the labelers by EM, and weights of the logistic classifier fitted to its posteriors.

    ``counts`` has the candidates by kind and votes: 4 * 27 entries at most.
    """
    patterns: dict[tuple[int, ...], float] = {}
    for (_, votes), n in counts.items():
        patterns[votes] = patterns.get(votes, 0) + n
    found = estimate(patterns, PRIOR, BELIEVED)
    total = sum(counts.values())
    weights = [0.0] * len(_features(0, (0, 0, 0)))
    rows = [(_features(rank, votes), 1 / (1 + math.exp(-found.log_odds(votes))), n / total) for (rank, votes), n in sorted(counts.items())]
    for _ in range(rounds):
        slope = [1e-4 * w for w in weights]
        for x, goal, share in rows:
            off = 1 / (1 + math.exp(-sum(w * v for w, v in zip(weights, x)))) - goal
            slope = [s + share * off * v for s, v in zip(slope, x)]
        weights = [w - 2.0 * s for w, s in zip(weights, slope)]
    return found, weights


def _chance(weights: list[float]) -> str:
    kinds, votes = weights[1: len(KINDS)], weights[len(KINDS):]
    terms = [f"{weights[0]!r}D", f"element_at(array(0D, {', '.join(f'{w!r}D' for w in kinds)}), c.rank + 1)"]
    terms += [f"element_at(array({votes[2 * i]!r}D, 0D, {votes[2 * i + 1]!r}D), c.votes[{i}] + 2)" for i in range(3)]
    return f"1 / (1 + exp(-({' + '.join(terms)})))"


def _shown(spans: str) -> str:
    names = ", ".join(lit(k) for k in KINDS)
    return f"array_join(transform({spans}, c -> concat_ws(':', array({names})[c.rank], c.start, c.stop)), ',')"


def find_personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, how many base spans of each kind, base_sha256, and all spans, of every row of ``docs`` (doc_id, text)."""
    rows = candidates(docs)
    each = rows.where("size(spans) > 0").select(F.explode("spans").alias("c"))
    counted = each.groupBy("c.rank", "c.votes").agg(F.count(F.lit(1)).alias("n")).collect()  # 4 * 27 at most
    weights = train({(r["rank"], tuple(r["votes"])): r.n for r in counted})[1] if counted else [0.0] * 10
    base = "filter(spans, c -> c.base)"
    apart = "NOT exists(b, o -> o.rank = c.rank AND o.start < c.stop AND c.start < o.stop)"
    spans = let("b", base, f"filter(spans, c -> c.base OR ({_chance(weights)} >= 0.5 AND {apart}))")
    counts = [f"bigint(size(filter(spans, c -> c.base AND c.rank = {i}))) AS n_{kind}" for i, kind in enumerate(KINDS)]
    return rows.selectExpr("doc_id", *counts, f"sha2({_shown(base)}, 256) AS base_sha256", f"{_shown(spans)} AS spans")
