"""Toxicity through a noisy channel: hidden words are restored before they are scored.

A writer hides a word by leetspeak, by spaces or signs between its letters, or by repeating letters.  Each suspicious stretch of a
text becomes a lattice: a sign may be a letter it resembles or be skipped, a run of one letter may stand for one or two of it, and
letters standing alone may belong together.  Viterbi finds the likeliest letters under a character trigram model and the costs of
the channel.  The character model is counted over all documents.  Words of plain letters none of which stands twice in a row have a
lattice with a single path, so they are their own restoration and need no search.  All other words are decoded whatever their length,
with the signs at their edges as possible letters and also without them; where a word holds letters it is also read with every sign
that looks like a letter as one, as a frequent short word may make skipping it cheaper.  Rows of letters standing alone are split
into words by the same model.

Features of a document are the distinct beginnings and whole forms of its restored words.  Labelled documents tell which of them
are tied to the label (counts by label, combined in Spark); a small logistic model on the strength of the ties gives the score.

Learning uses ``MOST_LABELLED`` labelled documents at most (a documented bound on fitting the classifier); all documents of the
learning split if there are no more than that.

Defined results: null and empty texts are scored as texts without any tie.  Without labels of both kinds every score is 0.
Documents without id are never learned from.  Labels that repeat an id count once, the larger label; rows that repeat an id are
scored each by themselves.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from triagelake.llm.common import bounded_sample, remainder, stored, with_columns

MOST_LABELLED = 20_000
#: Words whose ties a task remembers before it starts anew.
WORDS_KEPT = 800_000
#: Features that may be looked up among the other documents, by count; and how sure a tie must be (nats of a Poisson bound).
MOST_CANDIDATES, LEAST_SURE = 100_000, 10.0
#: Features that the model keeps: those with the strongest ties.  It bounds the model, not what is counted.
MOST_FEATURES = 5_000
FOLDS, HELD_OUT = 3, 1

#: Letters that a sign may stand for; fixed values.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "il",
              "+": "t", "€": "e", "(": "c"}
#: Signs put between letters; fixed values.
FILLERS = "._-*~'/^"
SWAP, SKIP, REPEAT = 1.5, 1.0, 0.5  # costs of the channel, in nats

_PLAIN = re.compile(r"[^\W\d_]+")
_AROUND = "()[]{}<>\\\"'.,;:?!*#%&$|-_=~`^/"
#: Signs around a word that no letter looks like: every path skips them.
_NEVER_LETTERS = "".join(set(_AROUND) - set(LOOKALIKES))
_TWICE = re.compile(r"([^\W\d_])\1")
_LOOKALIKE = re.compile("[" + re.escape("".join(LOOKALIKES)) + "]")
_HIDING = re.compile("[" + re.escape("".join(LOOKALIKES) + FILLERS) + "]")
_UNIT = r"(?:[^\W\d_]|[" + re.escape("".join(LOOKALIKES)) + "])"
_GAP = r"(?:_|[^\w" + re.escape("".join(LOOKALIKES)) + "])"
#: Three or more letters or look-alikes that touch no other letter or digit.
_ALONE = re.compile(rf"(?<![^\W_]){_UNIT}(?:{_GAP}+{_UNIT}(?![^\W_])){{2,}}")
LETTERS = 28  # 0: edge of a word, 1 to 26: a to z, 27: any other letter


def _code(letter: str) -> int:
    return ord(letter) - 96 if "a" <= letter <= "z" else 27


@dataclass(frozen=True)
class Letters:
    """Character trigram model: cost[a, b, c] is -log P(c | a, b) in nats."""

    cost: np.ndarray

    @cached_property
    def table(self) -> list[list[list[float]]]:
        """The costs as lists, which are faster to read one by one."""
        return self.cost.tolist()


def letter_model(docs: DataFrame) -> Letters:
    """Trigrams of letters of all documents, counted in numpy per batch and summed in Spark: 28 ** 3 rows at most come back."""
    table = np.full(256, 0, dtype=np.int32)
    table[97:123] = np.arange(1, 27)
    table[65:91] = np.arange(1, 27)
    table[128:] = 27

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(LETTERS ** 3, dtype=np.int64)
        for batch in batches:
            texts = [t for t in batch.column(0).cast(pa.binary()).to_pylist() if t]
            for at in range(0, len(texts), 256):
                raw = np.frombuffer(b"  " + b"  ".join(texts[at: at + 256]) + b"  ", dtype=np.uint8)
                codes = table[raw]
                total += np.bincount((codes[:-2] * LETTERS + codes[1:-1]) * LETTERS + codes[2:], minlength=LETTERS ** 3)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["gram", "n"])

    found = docs.select("text").mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(LETTERS ** 3)
    for row in found:
        counts[row.gram] = row.n
    counts = counts.reshape((LETTERS,) * 3)
    lower = counts.sum(axis=0) + 0.1
    backed = lower / lower.sum(axis=1, keepdims=True)
    return Letters(-np.log((counts + 5.0 * backed[None]) / (counts.sum(axis=2, keepdims=True) + 5.0)))


def _choices(stretch: str, skip: bool = True) -> list[list[tuple[str, float]]]:
    """The lattice of a stretch: for each place the letters it may stand for, with their costs; ``skip``: look-alikes may be skipped."""
    places: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(stretch):
        sign, run = stretch[i], 1
        while i + run < len(stretch) and stretch[i + run] == sign:
            run += 1
        if sign.isalpha():
            one = (sign, REPEAT * (run > 1))
            places.append([one, (sign * 2, 0.0 if run == 2 else REPEAT)] if run > 1 else [one])
        elif sign in LOOKALIKES:
            places.append([*[("", SKIP)] * skip, *((letter, SWAP) for letter in LOOKALIKES[sign])])
        else:
            places.append([("", 0.0 if sign.isspace() else SKIP)])
        i += run
    return places


def restore(stretch: str, model: Letters, skip: bool = True) -> str:
    """The likeliest word behind a stretch of lower-case signs."""
    cost = model.table
    # State: the last two letters; value: cost and the letters so far, as a chain that shares its beginning with other states.
    states: dict[tuple[int, int], tuple[float, tuple]] = {(0, 0): (0.0, ())}
    for choices in _choices(stretch, skip):
        after: dict[tuple[int, int], tuple[float, tuple]] = {}
        for (a, b), (sofar, chain) in states.items():
            for letters, extra in choices:
                x, y, value = a, b, sofar + extra
                for letter in letters:
                    code = _code(letter)
                    x, y, value = y, code, value + cost[x][y][code]
                if (x, y) not in after or value < after[x, y][0]:
                    after[x, y] = (value, (chain, letters) if letters else chain)
        states = after
    chain = min(((value + cost[a][b][0], chain) for (a, b), (value, chain) in states.items()), key=lambda end: end[0])[1]
    found: list[str] = []
    while chain:
        chain, letters = chain
        found.append(letters)
    return "".join(reversed(found))


#: Letters of a word in a row of words; and how much likelier (nats) the best splitting of a row may be than one with the word in it.
LONGEST, NEAR = 24, 8.0


def split(letters: str, model: Letters) -> list[str]:
    """The words of a row of letters without gaps: those of three letters or more of the likeliest splittings under the letter model.

    Viterbi with word edges, from both ends: a word is there if the best splitting that holds it is within ``NEAR`` nats of the best of all.
    """
    cost, codes, n = model.table, [_code(letter) for letter in letters], len(letters)
    ahead = [0.0] + [math.inf] * n
    for i in range(n):
        a = b = 0
        value = ahead[i]
        for j in range(i, min(n, i + LONGEST)):
            value += cost[a][b][codes[j]]
            a, b = b, codes[j]
            ahead[j + 1] = min(ahead[j + 1], value + cost[a][b][0])
    most, behind, found = ahead[n] + NEAR, [math.inf] * n + [0.0], []
    for i in range(n - 1, -1, -1):
        a = b = 0
        value = 0.0
        for j in range(i, min(n, i + LONGEST)):
            value += cost[a][b][codes[j]]
            a, b = b, codes[j]
            whole = value + cost[a][b][0] + behind[j + 1]
            behind[i] = min(behind[i], whole)
            if j - i >= 2 and ahead[i] + whole <= most:
                found.append(letters[i: j + 1])
    return found


#: Longer stretches are decoded like all others, but not remembered.
REMEMBERED = 200


class Restorer:
    """Restored words of texts (UTF-8 bytes)."""

    def __init__(self, model: Letters) -> None:
        self.model, self.remembered = model, lru_cache(maxsize=100_000)(lambda *given: restore(given[0], model, *given[1:]))

    def restore(self, stretch: str, *how: bool) -> str:
        return self.remembered(stretch, *how) if len(stretch) <= REMEMBERED else restore(stretch, self.model, *how)

    def forms(self, word: bytes) -> tuple[str, ...]:
        """What a word between white space may say: itself if its lattice has one path, else its restoration, also without the signs
        at its edges, and its plain parts."""
        low = word.decode("utf-8", "replace").lower()
        if low.isalpha() and not _TWICE.search(low):
            return (low,)
        plain, whole, core = _PLAIN.findall(low), low.strip(_NEVER_LETTERS), low.strip(_AROUND)
        read = [self.restore(s) for s in dict.fromkeys((whole, core)) if _HIDING.search(s) or _TWICE.search(s)]
        if plain:
            edges = dict.fromkeys((core, whole.rstrip(_AROUND), whole.lstrip(_AROUND), whole))
            read += [self.restore(s, False) for s in edges if _LOOKALIKE.search(s)]
        return tuple(dict.fromkeys(f for f in (*read, *plain) if f))

    def spaced(self, text: bytes) -> list[str]:
        """Words whose letters stand alone.  A stretch is read as one word, also without its first or last letter, which may be a word of
        its own, and as a row of words."""
        found: dict[str, None] = {}
        for stretch in _ALONE.findall(text.decode("utf-8", "replace").lower()):
            for skip in (True, False) if _LOOKALIKE.search(stretch) and _PLAIN.search(stretch) else (True,):
                whole = self.restore(stretch, skip)
                found.update(dict.fromkeys((whole, whole[1:], whole[:-1], *split(whole, self.model))))
        return [form for form in found if form]


def features(word: str) -> list[str]:
    """The whole word, and its beginnings of four to six letters."""
    return [word, *(word[:size] + "-" for size in (4, 5, 6) if len(word) > size)]


class Ties(dict):
    """Strongest tie of each word met so far; 0 for most."""

    def __init__(self, restorer: Restorer, ties: dict[str, float]) -> None:
        super().__init__()
        self.restorer, self.ties = restorer, ties

    def of(self, form: str) -> float:
        return max((self.ties.get(f, 0.0) for f in features(form)), default=0.0)

    def __missing__(self, word: bytes) -> float:
        if len(self) >= WORDS_KEPT:
            self.clear()
        found = max(map(self.of, self.restorer.forms(word)), default=0.0)
        if len(word) <= REMEMBERED:
            self[word] = found
        return found

    def summary(self, text: bytes) -> tuple[float, float, float, float]:
        """1, strongest tie, sum of the ties of distinct words, and how many there are."""
        strong = [t for t in map(self.__getitem__, set(text.split())) if t]
        strong += [t for t in map(self.of, self.restorer.spaced(text)) if t]
        return (1.0, max(strong, default=0.0), min(sum(strong), 30.0), math.log1p(len(strong)))


@dataclass(frozen=True)
class Model:
    letters: Letters
    ties: dict[str, float]
    weights: tuple[float, ...]


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 50) -> np.ndarray:
    """Regularised logistic regression by Newton's method."""
    weights, penalty = np.zeros(x.shape[1]), np.diag([1e-6, *[1e-2] * (x.shape[1] - 1)])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (p - y) + penalty @ weights
        change = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(weights)), slope)
        weights = weights - np.clip(change, -5, 5)
        if np.abs(change).max() < 1e-8:
            break
    return weights


def _counted(rows: DataFrame, letters: Letters, only: frozenset[str] | None) -> DataFrame:
    """feature, n: number of texts that hold each feature, summed within tasks before Spark sums the tasks."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer, total = Restorer(letters), Counter()
        for batch in batches:
            for text in batch.column(0).cast(pa.binary()).to_pylist():
                found: set[str] = set()
                for word in set((text or b"").split()):
                    for form in restorer.forms(word):
                        found.update(features(form))
                for form in restorer.spaced(text or b""):
                    found.update(features(form))
                total.update(found if only is None else found & only)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())],
                                         names=["feature", "n"])

    return rows.select("text").mapInArrow(count, "feature string, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def learn(docs: DataFrame, labels: DataFrame, letters: Letters | None = None, most: int = MOST_LABELLED) -> Model:
    """Fit on the labelled documents of the learning split: two thirds find the ties, the rest weighs them."""
    letters = letters or letter_model(docs)
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y"))
    split = docs.select("doc_id", "text").where(remainder(FOLDS) != HELD_OUT)
    chosen = bounded_sample(marks.where(remainder(FOLDS) != HELD_OUT), most, 3)
    rows = stored(split.join(chosen, "doc_id").withColumn("part", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(3))), "labelled")
    kinds = rows.groupBy((F.col("part") > 0).alias("ties"), "y").count().collect()
    size = {(r.ties, r.y): r["count"] for r in kinds}
    toxic, clean = size.get((True, 1), 0), size.get((True, 0), 0)
    if not toxic or not clean:
        return Model(letters, {}, (-30.0, 0.0, 0.0, 0.0))

    base = toxic / (toxic + clean)
    most_held = _counted(rows.where("part > 0 AND y = 1"), letters, None).where("n >= 3")
    held = {r.feature: r.n for r in most_held.orderBy(F.desc("n"), "feature").limit(MOST_CANDIDATES).collect()}
    other = {r.feature: r.n for r in _counted(rows.where("part > 0 AND y = 0"), letters, frozenset(held)).collect()}
    ties: dict[str, float] = {}
    for feature, n in held.items():
        expected = base * (n + other.get(feature, 0))
        if n > expected and n * math.log(n / expected) - (n - expected) >= LEAST_SURE:
            tie = math.log((n + 0.1) / (toxic + 1)) - math.log((other.get(feature, 0) + 0.5) / (clean + 1))
            if tie > 1.0:
                ties[feature] = tie
    ties = dict(sorted(ties.items(), key=lambda t: (-t[1], t[0]))[:MOST_FEATURES])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Ties(Restorer(letters), ties)
        for batch in batches:
            found = [own.summary(t or b"")[1:] for t in batch.column(0).cast(pa.binary()).to_pylist()]
            columns = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.float64()) for c in columns), batch.column(1)], names=["a", "b", "c", "y"])

    fitted = rows.where("part = 0").select("text", "y").mapInArrow(summarise, "a double, b double, c double, y int").toPandas()
    if fitted["y"].nunique() < 2:
        return Model(letters, ties, (-4.0, 1.0, 0.0, 0.0))
    x = np.c_[np.ones(len(fitted)), fitted[["a", "b", "c"]].to_numpy()]
    return Model(letters, ties, tuple(_logistic(x, fitted["y"].to_numpy(dtype=float))))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: the probability that the text is toxic."""
    def build() -> Callable[[list[bytes]], list[pa.Array]]:
        own, weights = Ties(Restorer(model.letters), model.ties), np.array(model.weights)

        def run(texts: list[bytes]) -> list[pa.Array]:
            x = np.array([own.summary(t) for t in texts]).reshape(-1, 4)
            return [pa.array(1 / (1 + np.exp(-np.clip(x @ weights, -30, 30))), pa.float64())]

        return run

    return with_columns(docs, [StructField(name, DoubleType())], build)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    scored = score(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select("doc_id", (remainder(FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """The documents whose score stays below the threshold, with all columns of ``docs``."""
    scored = score(docs, learn(docs, labels), "__toxicity")
    return scored.where(F.col("__toxicity") < threshold).drop("__toxicity")
