"""Expectation-maximisation over votes, on counted patterns.

Rules vote +1, -1 or 0 (abstain).  A pattern of votes is one combination; with R rules there are 3 ** R at most, so what comes from
Spark is bounded, and the estimation itself is plain arithmetic over those counts.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

VOTES = (-1, 0, 1)


@dataclass(frozen=True)
class Reliabilities:
    """``prior``: share of the positive class; ``given[rule][class][vote]``: chance of the vote (class 0 or 1; votes as in VOTES)."""

    prior: float
    given: tuple[tuple[tuple[float, float, float], tuple[float, float, float]], ...]

    def log_odds(self, votes: Sequence[int]) -> float:
        total = math.log(self.prior) - math.log(1 - self.prior)
        for vote, (bad, good) in zip(votes, self.given):
            total += math.log(good[vote + 1]) - math.log(bad[vote + 1])
        return total


def estimate(counts: Mapping[tuple[int, ...], float], prior: float, believed: Sequence[tuple[tuple[float, ...], tuple[float, ...]]],
             trust: float = 0.05, rounds: int = 200, most_false: float = 1.0) -> Reliabilities:
    """Reliabilities of all rules by EM.

    It starts from ``believed`` and keeps it as pseudo-counts worth ``trust`` of all patterns, so that a rule that hardly ever votes
    stays near its belief and the two classes cannot change places.  ``most_false`` bounds the chance of a negative vote on the positive
    class.
    """
    total = sum(counts.values())
    now = Reliabilities(prior, tuple((tuple(b), tuple(g)) for b, g in believed))
    if not total:
        return now
    weight = max(1.0, trust * total)
    for _ in range(rounds):
        mass = [[[weight * p for p in chances] for chances in rule] for rule in believed]
        positive = prior * weight
        for votes, n in sorted(counts.items()):
            good = 1 / (1 + math.exp(-max(-60.0, min(60.0, now.log_odds(votes)))))
            positive += n * good
            for rule, vote in zip(mass, votes):
                rule[0][vote + 1] += n * (1 - good)
                rule[1][vote + 1] += n * good
        for _, chances in mass:
            least = chances[0] * (1 - most_false) / most_false - chances[1] - chances[2]
            if least > 0:  # the bound holds: the other votes get the rest in their proportion
                share = (chances[1] + chances[2] + least) / (chances[1] + chances[2])
                chances[1:] = [chances[1] * share, chances[2] * share]
        given = tuple(tuple(tuple(m / sum(chances) for m in chances) for chances in rule) for rule in mass)
        after = Reliabilities(positive / (total + weight), given)
        moved = abs(after.prior - now.prior)
        now = after
        if moved < 1e-9:
            break
    return now
