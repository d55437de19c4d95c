"""Quality classifier: random-indexing word vectors pooled per document, and a calibrated two-layer network in numpy.

Texts are cut into units: runs of letters (capitals folded), of digits, and of other signs; marks are added for words in capitals,
for a unit that repeats the one before it, and for line ends.  Units are hashed into ``UNITS`` rows.  Each row has a sparse random
index vector given by a rule; the vector of a unit is the sum of the index vectors of its neighbours over all documents, counted in
tasks and summed in Spark (whole numbers, so reruns agree).  A document is the mean of its units' vectors and of their index vectors,
with its length.  A network of two layers is fitted to labelled documents, and a temperature, found on labelled documents that the
network was not fitted to, calibrates its probabilities.

Fitting the network takes ``MOST_LABELLED`` labelled documents at most (a documented bound); the vectors cover all documents.

Defined results: null and empty texts are pooled as zeros and scored so.  Without labels of both kinds every score is that kind, or 0.5
without labels.  Labels that repeat an id count once, the smaller one; documents without id are never learned from.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, StructField

from triagelake.llm.common import bounded_sample, remainder, stored, with_columns
from triagelake.llm.words import BASES, SPACE, U64, Spans, mix, pieces

UNITS, WIDTH, SPOTS = 4096, 32, 4
SIGNS = 1024  # rows for units that are not words; the first MARKS of them for marks
MARKS, CAPITALS, AGAIN, LINE = 8, 0, 1, 2
REACH = 2
MOST_LABELLED = 20_000
FOLDS, HELD_OUT = 3, 1

_KIND = np.full(256, 3, dtype=np.int8)  # 0 white space, 1 letters, 2 digits, 3 other signs
_KIND[SPACE] = 0
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = _KIND[128:] = 1
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_VALUE = mix(np.arange(1, 257, dtype=U64))[_FOLD]
_SMALL = np.zeros(256, dtype=np.int64)
_SMALL[97:123] = 1


def index_vectors() -> np.ndarray:
    """Rows of UNITS x WIDTH with SPOTS times plus or minus one (or their sum where spots meet), by rule."""
    spot = mix(np.arange(UNITS * SPOTS, dtype=U64)).reshape(UNITS, SPOTS)
    out = np.zeros((UNITS, WIDTH), dtype=np.int64)
    for column in spot.T:
        np.add.at(out, (np.arange(UNITS), (column % U64(WIDTH)).astype(int)), np.where(column >> U64(63), 1, -1))
    return out


def units(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the units of all texts, and where each text's units begin (one more entry at the end)."""
    data = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(data, dtype=np.uint8)
    kind = _KIND[raw]
    edge = np.flatnonzero(np.r_[True, (kind[1:] != kind[:-1]) | (raw[1:] == 10)])
    end = np.r_[edge[1:], len(raw)]
    line = raw[edge] == 10
    own = (kind[edge] > 0) | line
    start, end, line = edge[own], end[own], line[own]
    hashed = Spans(_VALUE[raw], BASES[0]).of(start, end)
    word = kind[start] == 1
    row = np.where(word, SIGNS + (hashed % U64(UNITS - SIGNS)).astype(np.int64), MARKS + (hashed % U64(SIGNS - MARKS)).astype(np.int64))
    row[line] = LINE
    small = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum(_SMALL[raw], out=small[1:])
    shout = word & (small[end] == small[start]) & (end - start > 1) & (raw[start] < 128)
    again = np.r_[False, (hashed[1:] == hashed[:-1]) & ~line[1:]]
    copies = 1 + shout + again
    place = np.cumsum(copies) - 1  # of the unit itself, behind its marks
    out = np.empty(int(copies.sum()), dtype=np.int64)
    out[place] = row
    out[(place - 1 - again)[shout]] = CAPITALS
    out[(place - 1)[again]] = AGAIN
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=offsets[1:])
    before = np.r_[0, np.cumsum(copies)]
    return out, before[np.searchsorted(start, offsets)]


def unit_vectors(docs: DataFrame) -> np.ndarray:
    """Vectors of all units over all documents: UNITS x WIDTH cells come back, whatever the input."""
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors()
        spots = [np.nonzero(index[r])[0] for r in range(UNITS)]
        wide = max(map(len, spots))
        place = np.zeros((UNITS, wide), dtype=np.int64)
        value = np.zeros((UNITS, wide))
        for r, s in enumerate(spots):
            place[r, : len(s)], value[r, : len(s)] = s, index[r, s]
        total = np.zeros(UNITS * WIDTH)
        for batch in batches:
            for _, some in pieces([t or b"" for t in batch.column(0).cast(pa.binary()).to_pylist()], 1 << 19):
                rows, _ = units(some)
                for step in range(1, REACH + 1):
                    a, b = rows[:-step], rows[step:]
                    for x, y in ((a, b), (b, a)):
                        for k in range(wide):
                            total += np.bincount(x * WIDTH + place[y, k], value[y, k], minlength=UNITS * WIDTH)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen].astype(np.int64))], names=["cell", "n"])

    found = docs.select("text").mapInArrow(gather, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    vectors = np.zeros(UNITS * WIDTH)
    vectors[found["cell"].to_numpy(dtype=int)] = found["n"].to_numpy()
    vectors = vectors.reshape(UNITS, WIDTH)
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1)).astype(np.float32)


def _pooler(vectors: np.ndarray) -> Callable[[list[bytes]], np.ndarray]:
    table = np.concatenate([vectors, index_vectors().astype(np.float32)], axis=1)

    def pool(texts: list[bytes]) -> np.ndarray:
        out = []
        for _, some in pieces(texts, 1 << 18):
            rows, first = units(some)
            n = np.maximum(np.diff(first), 1)[:, None]
            # Every text has a unit at least, its line end.
            means = np.add.reduceat(table[rows], first[:-1], axis=0) / n
            out.append(np.concatenate([means, np.log(n)], axis=1))
        return np.concatenate(out) if out else np.zeros((0, 2 * WIDTH + 1))

    return pool


@dataclass(frozen=True)
class Network:
    mean: np.ndarray
    spread: np.ndarray
    first: np.ndarray
    second: np.ndarray
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        hidden = np.tanh(np.c_[(x - self.mean) / self.spread, np.ones(len(x))] @ self.first)
        return np.c_[hidden, np.ones(len(x))] @ self.second

    def chances(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 24, rounds: int = 60, seed: int = 1) -> Network:
    """Two layers by Adam on log loss with weight decay; every fifth row is kept for the temperature."""
    if len(set(y.tolist())) < 2:
        certain = float(y[0] * 60 - 30) if len(y) else 0.0
        return Network(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros((x.shape[1] + 1, 1)), np.array([0.0, certain]))
    random = np.random.default_rng(seed)
    order = random.permutation(len(y))
    x, y = x[order], y[order]
    aside = np.arange(len(y)) % 5 == 0
    train, goal = x[~aside], y[~aside]
    mean, spread = train.mean(axis=0), train.std(axis=0) + 1e-6
    z = np.c_[(train - mean) / spread, np.ones(len(train))]
    weights = [random.normal(0, z.shape[1] ** -0.5, (z.shape[1], hidden)), random.normal(0, hidden ** -0.5, hidden + 1)]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    turn, size = 0, 128
    for _ in range(rounds):
        for at in range(0, len(z), size):
            a, b = z[at: at + size], goal[at: at + size]
            h = np.c_[np.tanh(a @ weights[0]), np.ones(len(a))]
            off = (1 / (1 + np.exp(-np.clip(h @ weights[1], -30, 30))) - b) / len(a)
            slopes = [a.T @ ((off[:, None] * weights[1][None, :-1]) * (1 - h[:, :-1] ** 2)), h.T @ off]
            turn += 1
            for w, g, m in zip(weights, slopes, moments):
                g = g + 1e-4 * w
                m[0] = 0.9 * m[0] + 0.1 * g
                m[1] = 0.999 * m[1] + 0.001 * g * g
                w -= 3e-3 * (m[0] / (1 - 0.9 ** turn)) / (np.sqrt(m[1] / (1 - 0.999 ** turn)) + 1e-8)
    network = Network(mean, spread, weights[0], weights[1])
    logits, target = network.logits(x[aside]), y[aside]
    scale = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
    loss = [np.mean(np.logaddexp(0, logits / t) - target * logits / t) for t in scale]
    return Network(mean, spread, weights[0], weights[1], float(scale[int(np.argmin(loss))]))


@dataclass(frozen=True)
class Model:
    vectors: np.ndarray
    network: Network


def learn(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    vectors = unit_vectors(docs)
    marks = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("y"))
    chosen = bounded_sample(marks.where(remainder(FOLDS) != HELD_OUT), most, 23)
    rows = stored(docs.select("doc_id", "text").join(chosen, "doc_id"), "labelled")

    def build() -> Callable[[list[bytes]], list[pa.Array]]:
        pool = _pooler(vectors)
        return lambda texts: [pa.array(list(pool(texts).astype(np.float32)), pa.list_(pa.float32()))]

    pooled = with_columns(rows, [StructField("x", ArrayType(FloatType()))], build).select("doc_id", "x", "y").toPandas()
    pooled = pooled.sort_values("doc_id", kind="stable")
    x = np.array(pooled["x"].tolist(), dtype=float).reshape(len(pooled), 2 * WIDTH + 1)
    return Model(vectors, fit(x, pooled["y"].to_numpy(dtype=float)))


def score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with a column ``name``: the probability that the text is of quality."""
    def build() -> Callable[[list[bytes]], list[pa.Array]]:
        pool = _pooler(model.vectors)
        return lambda texts: [pa.array(model.network.chances(pool(texts)), pa.float64())]

    return with_columns(docs, [StructField(name, DoubleType())], build)


def quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    scored = score(docs.select("doc_id", "text"), learn(docs, labels))
    return scored.select("doc_id", (remainder(FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
