"""Language identification by prediction by partial matching.

Each language has a context tree over bytes: how often each symbol followed each context of up to ``ORDER`` symbols in its learning
texts.  A symbol's code length under the frozen tree follows from its longest known context: its share there, or the escape
probability (method C: distinct symbols against occurrences) and then the next shorter context, down to equal shares.  The language
that needs the fewest bits for the text wins; ties go to the first by name.

Symbols are bytes with capitals folded, all ASCII signs but letters as one, and the rarer bytes above 127 as one (``SYMBOLS`` in all).
So a tree unfolds into a table of the code lengths of all contexts and symbols, and scoring is one look-up per byte and language.
With more than ``TABLES`` languages the same code lengths are worked out from the counts, language by language, for the grams that a
run of texts holds, so their number is not bounded.

Learning counts over ``MOST_LEARNED`` documents at most (a documented bound on fitting the classifier), or all of the learning split.

Defined results: ``und`` with score 0 for a null text and for one without letters.  Without any learning text every result is ``und``.
A null language is never learned.  Rows that repeat an id are judged each by themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from triagelake.llm.common import bounded_sample, remainder, stored, with_columns
from triagelake.llm.words import pieces

ORDER, SYMBOLS = 3, 40
MOST_LEARNED = 40_000
FOLDS, HELD_OUT = 5, 0
#: Each table costs SYMBOLS ** (ORDER + 1) numbers in every task; more languages than this are scored without tables.
TABLES = 40
#: Bytes of text that are scored at once with tables, and without.
RUN, LONG_RUN = 1 << 18, 1 << 23

_ASCII = np.zeros(256, dtype=np.int32)
_ASCII[97:123] = np.arange(1, 27)
_ASCII[65:91] = np.arange(1, 27)


def folded(data: bytes) -> np.ndarray:
    """Bytes with the capitals of Latin-1 folded as well; ASCII capitals are folded by the symbol table."""
    raw = np.frombuffer(data, dtype=np.uint8)
    capital = np.zeros(len(raw), dtype=bool)
    capital[1:] = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] <= 0x9E)
    return np.where(capital, raw + np.uint8(0x20), raw)


def symbols(high: list[int]) -> np.ndarray:
    """Symbol of each byte: 0 signs, 1 to 26 letters, then the given bytes above 127, and the last for all others."""
    table = _ASCII.copy()
    table[128:] = SYMBOLS - 1
    for i, byte in enumerate(high[: SYMBOLS - 28]):
        table[byte] = 27 + i
    return table


def grams(data: bytes, table: np.ndarray) -> np.ndarray:
    """Code of the last ORDER + 1 symbols at each byte; in front of the text there are signs."""
    code = table[folded(data)]
    out, power = code.copy(), 1
    for back in range(1, ORDER + 1):
        power *= SYMBOLS
        out[back:] += code[:-back] * power
    return out


@dataclass(frozen=True)
class Model:
    languages: list[str]
    high: list[int]
    counts: list[tuple[np.ndarray, np.ndarray]]  # of each language: gram codes, occurrences

    def code_lengths(self) -> np.ndarray:
        """Nats of each gram's last symbol in each language, as a table of grams by languages."""
        out = np.empty((SYMBOLS ** (ORDER + 1), len(self.languages)), dtype=np.float32)
        for i, (codes, n) in enumerate(self.counts):
            full = np.zeros(SYMBOLS ** (ORDER + 1))
            full[codes] = n
            full = full.reshape((SYMBOLS,) * (ORDER + 1))
            cost = np.full(SYMBOLS, np.log(SYMBOLS))
            for order in range(ORDER + 1):
                seen = full.sum(axis=tuple(range(ORDER - order)))
                total, distinct = seen.sum(axis=-1, keepdims=True), (seen > 0).sum(axis=-1, keepdims=True)
                known = total > 0
                escape = np.where(known, -np.log(np.maximum(distinct, 1) / np.maximum(total + distinct, 1)), 0.0)
                own = -np.log(np.maximum(seen, 1) / np.maximum(total + distinct, 1))
                cost = np.where(seen > 0, own, escape + cost)
            out[:, i] = cost.ravel()
        return out

    def code_lengths_of(self, language: int, wanted: np.ndarray) -> np.ndarray:
        """Nats of the last symbol of the ``wanted`` grams in one language, as in ``code_lengths`` but without its table."""
        codes, n = self.counts[language]
        cost = np.full(len(wanted), np.log(SYMBOLS))
        for order in range(ORDER + 1):
            size = SYMBOLS ** (order + 1)
            grams_, of = np.unique(codes % size, return_inverse=True)
            seen_ = np.bincount(of, weights=n, minlength=len(grams_))
            contexts, within = np.unique(grams_ // SYMBOLS, return_inverse=True)
            total_, distinct_ = np.bincount(within, weights=seen_), np.bincount(within)
            seen = _found(grams_, seen_, wanted % size)
            total, distinct = (_found(contexts, v, wanted % size // SYMBOLS) for v in (total_, distinct_))
            escape = np.where(total > 0, -np.log(np.maximum(distinct, 1) / np.maximum(total + distinct, 1)), 0.0)
            own = -np.log(np.maximum(seen, 1) / np.maximum(total + distinct, 1))
            cost = np.where(seen > 0, own, escape + cost)
        return cost.astype(np.float32)


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of the ``wanted`` keys, 0 for those not among the sorted ``keys``."""
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]


def learn(docs: DataFrame, most: int = MOST_LEARNED) -> Model:
    """Trees of all languages of the learning split of ``docs`` (doc_id, text, lang)."""
    own = docs.select("doc_id", "text", "lang").where((remainder(FOLDS) != HELD_OUT) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = stored(bounded_sample(own, most, 17).select("text", "lang"), "learned")

    def high_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(256, dtype=np.int64)
        for batch in batches:
            for _, some in pieces(_texts(batch)):
                total += np.bincount(folded(b" ".join(some)), minlength=256)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(128, 256, dtype=np.int32)), pa.array(total[128:])], names=["byte", "n"])

    found = rows.mapInArrow(high_bytes, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n")).where("n > 0").collect()
    high = [r.byte for r in sorted(found, key=lambda r: (-r.n, r.byte))][: SYMBOLS - 28]
    table = symbols(high)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            languages = np.array(batch.column("lang").to_pylist(), dtype=object)
            texts = _texts(batch)
            for language in set(languages.tolist()):
                joined = b" ".join([b"   ", *(texts[i] for i in np.flatnonzero(languages == language))])
                seen, n = np.unique(grams(joined, table)[3:], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([language] * len(seen), pa.string()), pa.array(seen.astype(np.int32)), pa.array(n.astype(np.int64))],
                    names=["lang", "gram", "n"])

    languages = sorted(r.lang for r in rows.select("lang").distinct().collect())
    summed = rows.mapInArrow(count, "lang string, gram int, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    summed = summed.sort_values(["lang", "gram"])  # the trees have SYMBOLS ** (ORDER + 1) leaves each at most
    by = {language: (own["gram"].to_numpy(), own["n"].to_numpy()) for language, own in summed.groupby("lang")}
    nothing = (np.zeros(0, dtype=np.int32), np.zeros(0, dtype=np.int64))
    return Model(languages, high, [by.get(language, nothing) for language in languages])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with lang_pred and score (the chance of that language if all were equally likely before)."""
    tables = len(model.languages) <= TABLES

    def build() -> Callable[[list[bytes]], list[pa.Array]]:
        table, lengths = symbols(model.high), model.code_lengths() if tables else None

        def run(texts: list[bytes]) -> list[pa.Array]:
            names, chances = [], []
            for _, some in pieces(texts, RUN if lengths is not None else LONG_RUN):
                if not model.languages:
                    names += ["und"] * len(some)
                    chances += [0.0] * len(some)
                    continue
                padded = [b"   " + t + b" " for t in some]
                starts = np.zeros(len(padded), dtype=np.int64)
                np.cumsum([len(t) for t in padded[:-1]], out=starts[1:])
                code = grams(b"".join(padded), table)
                if lengths is not None:
                    bits = np.add.reduceat(lengths[code], starts, axis=0, dtype=np.float64)
                else:
                    wanted, of = np.unique(code, return_inverse=True)
                    bits = np.stack([np.add.reduceat(model.code_lengths_of(i, wanted)[of], starts, dtype=np.float64)
                                     for i in range(len(model.languages))], axis=1)
                best = bits.argmin(axis=1)
                chance = 1 / np.exp(bits.min(axis=1, keepdims=True) - bits).sum(axis=1)
                for text, b, c in zip(some, best.tolist(), chance.tolist()):
                    lettered = any(x.isalpha() for x in text.decode("utf-8", "replace")) if not text[:40].isalpha() else True
                    names.append(model.languages[b] if lettered else "und")
                    chances.append(c if lettered else 0.0)
            return [pa.array(names, pa.string()), pa.array(chances, pa.float64())]

        return run

    return with_columns(docs, [StructField("lang_pred", StringType()), StructField("score", DoubleType())], build)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``."""
    found = predict(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", (remainder(FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
