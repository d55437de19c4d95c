"""Plain versions of what the operators compute, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall(text or "")


def exact(docs):
    """(doc_id, keep_id, group_size, kept, sha) of (doc_id, text) rows."""
    groups = defaultdict(list)
    for i, text in docs:
        groups[text or ""].append(i)
    out = []
    for i, text in docs:
        ids = groups[text or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, sha(text or "")))
    return out


def repeats(docs, window):
    """(doc_id, n_words, n_removed, sha of the kept words)."""
    first = {}
    split = [(i, words(text)) for i, text in docs]
    for i, own in split:
        for s in range(len(own) - window + 1):
            key = tuple(own[s: s + window])
            first[key] = min(i, first.get(key, i))
    out = []
    for i, own in split:
        gone = {p for s in range(len(own) - window + 1) if first[tuple(own[s: s + window])] < i for p in range(s, s + window)}
        out.append((i, len(own), len(gone), sha(" ".join(w for p, w in enumerate(own) if p not in gone))))
    return out


def shingles(text, size):
    own = words((text or "").translate(ASCII_LOWER))
    width = min(size, len(own))
    return {tuple(own[s: s + width]) for s in range(len(own) - width + 1)} if own else set()


def near(docs, size, percent=80):
    """(doc_id, n_shingles, component_id, kept)."""
    sets = [(i, shingles(text, size)) for i, text in docs]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return [(i, len(s), root(i), root(i) == i) for i, s in sets]


def base_measures(text):
    own = words(text)
    places = defaultdict(list)
    for s in range(len(own) - 7):
        places[tuple(own[s: s + 8])].append(s)
    covered = {p for found in places.values() if len(found) > 1 for s in found for p in range(s, s + 8)}
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    n = len(own)
    return (n, sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text or "")), repeated, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


def luhn(digits):
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def base_spans(text):
    """(start, kind, stop) in order, and how many of each kind."""
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    kinds, found = list(patterns), []
    for kind, pattern in patterns.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]:
                found.append((m.start(), kinds.index(kind), m.end()))
    found.sort()
    counts = Counter(kinds[r] for _, r, _ in found)
    return [counts[k] for k in kinds], ",".join(f"{kinds[r]}:{a}:{b}" for a, r, b in found)
