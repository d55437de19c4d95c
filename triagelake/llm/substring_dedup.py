"""Repeated passages of ``window`` words, found and removed with automata of recurring phrases.

1. Every window of a document is filed under its least phrase: of the phrases of ``PHRASE`` words inside it the one with the least
   hash.  Equal windows have equal least phrases, wherever they stand.  Consecutive windows with the same least phrase form a run,
   so a document has one row per 21 words or so, and equal rows of a document count once.
2. Passages are confirmed: a phrase recurs if two documents hold it, and then the first document of each run is the least id that
   holds exactly this run.  Where a recurring phrase stands in different runs, they may still share some windows; for these, which
   are the edges of copied passages, the windows themselves are compared in the same way.
3. Documents are streamed in blocks.  The recurring phrases of the documents of a block, with the confirmed passages around them,
   are compiled into one Aho-Corasick automaton per block: the automata are sharded by block, so that each is as small as its block
   and no document has to pass through the automata of the whole corpus.  The automaton locates every occurrence of each phrase; a
   128-bit hash of the whole passage around it confirms the occurrence, and its words go if the passage has an earlier document.

Hot passages cost one row per document and are only ever reduced by min and max, before the shuffle, or joined with one row.

Defined results: null or empty text has no words and nothing is removed.  Rows that share an id belong to one document, which is no
earlier document to itself.  Rows without id neither lose words nor make others lose them.  Windows are judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from triagelake.llm.common import stored
from triagelake.llm.words import BASES, Spans, Words, mix, pieces, signed, words_of

WINDOW, PHRASE = 50, 8

RUN = "doc_id long, phrase long, place int, lead int, length int, hash_1 long, hash_2 long"


class Passages:
    """Hashes of the passages of one document, in 2 x 64 bits."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.first, self.second = Spans(hashes, BASES[1]), Spans(mix(hashes), BASES[2])

    def of(self, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return signed(self.first.of(start, start + length)), signed(self.second.of(start, start + length))


def runs(hashes: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """phrase hash, place of the phrase, words of the run before it, length of the run, and the run's hash; equal runs once."""
    n = len(hashes) - window + 1
    if n < 1:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(6))
    places = np.arange(len(hashes) - PHRASE + 1)
    phrases = Spans(hashes, BASES[1]).of(places, places + PHRASE)
    inside = np.lib.stride_tricks.sliding_window_view(phrases, window - PHRASE + 1)
    least = inside.argmin(axis=1) + np.arange(n)
    start = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    last = np.r_[start[1:], n] - 1
    place, length = least[start], last - start + window
    one, two = Passages(hashes).of(start, length)
    _, once = np.unique(one, return_index=True)
    return signed(phrases[place[once]]), place[once], (place - start)[once], length[once], one[once], two[once]


def _runs(docs: DataFrame, window: int) -> DataFrame:
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for first, texts in pieces([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]):
                words = words_of(texts)
                found = [runs(words.hashes[words.slice(d)], window) for d in range(len(texts))]
                owners = np.repeat(np.array(ids[first: first + len(texts)], dtype=np.int64), [len(f[0]) for f in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(owners), *(pa.array(np.concatenate(c).astype(t)) for c, t in zip(
                        zip(*found), ("int64", "int32", "int32", "int32", "int64", "int64")))],
                    names=["doc_id", "phrase", "place", "lead", "length", "hash_1", "hash_2"])

    return docs.mapInArrow(find, RUN)


def _windows(docs: DataFrame, edges: DataFrame, window: int) -> DataFrame:
    """The single windows of the runs ``edges``, in the form of runs."""
    wanted = edges.groupBy("doc_id").agg(F.collect_list(F.struct("place", "lead", "length", "phrase")).alias("edges"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            ids, all_edges = batch.column("doc_id").to_pylist(), batch.column("edges").to_pylist()
            for first, some in pieces(texts):
                words = words_of(some)
                columns: list[list] = [[] for _ in range(7)]
                for d in range(len(some)):
                    own = words.hashes[words.slice(d)]
                    passages = Passages(own)
                    for e in all_edges[first + d]:
                        start = e["place"] - e["lead"] + np.arange(e["length"] - window + 1)
                        if start[-1] + window > len(own):  # of another row with the same id
                            continue
                        n = len(start)
                        one, two = passages.of(start, np.full(n, window))
                        for c, v in zip(columns, (np.full(n, ids[first + d]), np.full(n, e["phrase"]), np.full(n, e["place"]),
                                                  e["place"] - start, np.full(n, window), one, two)):
                            c.append(v)
                kinds = ("int64", "int64", "int32", "int32", "int32", "int64", "int64")
                yield pa.RecordBatch.from_arrays(
                    [pa.array((np.concatenate(c) if c else np.zeros(0)).astype(k)) for c, k in zip(columns, kinds)],
                    names=["doc_id", "phrase", "place", "lead", "length", "hash_1", "hash_2"])

    return docs.join(wanted, "doc_id").select("doc_id", "text", "edges").mapInArrow(find, RUN)


def confirmed(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Passages that also stand in an earlier document: doc_id, place, lead, length, hash_1, hash_2, first (that document)."""
    found = stored(_runs(docs, window), "runs")
    phrases = found.groupBy("phrase").agg(
        F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.min("hash_1").alias("x"), F.max("hash_1").alias("y"))
    recurring = phrases.where("low < high").select("phrase", (F.col("x") != F.col("y")).alias("varied"))
    held = stored(found.join(recurring, "phrase"), "recurring")
    firsts = held.groupBy("hash_1", "hash_2").agg(F.min("doc_id").alias("first"))
    known = stored(held.join(firsts, ["hash_1", "hash_2"]), "firsts")
    columns = ["doc_id", "place", "lead", "length", "hash_1", "hash_2", "first"]
    whole = known.where("first < doc_id").select(*columns)

    edges = stored(_windows(docs, known.where("first = doc_id AND varied"), window), "windows")
    firsts = edges.groupBy("hash_1", "hash_2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    return whole.unionByName(edges.join(firsts, ["hash_1", "hash_2"]).where("first < doc_id").select(*columns))


def _phrase(words: Words, d: int, place: int) -> bytes | None:
    """Text of a phrase, with single spaces around and between its words."""
    own = words.slice(d)
    if own.start + place + PHRASE > own.stop:
        return None
    i = own.start + place
    return b" " + b" ".join(words.data[words.starts[i]: words.ends[i + PHRASE - 1]].split()) + b" "


def _compile(words: Words, passages: list[list[dict] | None]) -> ahocorasick.Automaton | None:
    """The automaton of a block: each recurring phrase with the distinct passages (lead, length, hashes, first) around it."""
    around: dict[bytes, set[tuple]] = {}
    for d, some in enumerate(passages):
        for p in some or ():
            phrase = _phrase(words, d, p["place"])
            if phrase:
                around.setdefault(phrase, set()).add((p["lead"], p["length"], p["hash_1"], p["hash_2"], p["first"]))
    if not around:
        return None
    automaton = ahocorasick.Automaton()
    for phrase, found in around.items():
        lead, length, one, two, first = (np.array(c, dtype=np.int64) for c in zip(*sorted(found)))
        automaton.add_word(phrase.decode("latin-1"), (len(phrase), lead, length, one, two, first))
    automaton.make_automaton()
    return automaton


def _covered(automaton: ahocorasick.Automaton, doc_id: int, text: list[bytes], hashes: np.ndarray) -> np.ndarray:
    """For each word whether a located passage with an earlier document covers it."""
    n = len(text)
    step = np.zeros(n + 1, dtype=np.int64)
    begin = np.zeros(n, dtype=np.int64)
    np.cumsum([len(w) + 1 for w in text[:-1]], out=begin[1:])
    own = Passages(hashes)
    for end, (size, lead, length, one, two, first) in automaton.iter((b" " + b" ".join(text) + b" ").decode("latin-1")):
        start = np.searchsorted(begin, end - size + 1) - lead
        fits = np.flatnonzero((start >= 0) & (start + length <= n) & (first < doc_id))
        if len(fits):
            start, length = start[fits], length[fits]
            x, y = own.of(start, length)
            same = (x == one[fits]) & (y == two[fits])
            np.add.at(step, start[same], 1)
            np.add.at(step, (start + length)[same], -1)
    return np.cumsum(step[:-1]) > 0


RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string"


def _removed(rows: DataFrame, with_text: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            ids, passages = batch.column("doc_id").to_pylist(), batch.column("passages").to_pylist()
            out: list[list] = [[], [], [], []]
            kept_texts = []
            for first, some in pieces(texts):
                words = words_of(some)
                automaton = _compile(words, passages[first: first + len(some)])
                for d, text in enumerate(some):
                    own = words.slice(d)
                    kept, n, removed = text.split(), own.stop - own.start, 0
                    if automaton and n >= PHRASE and ids[first + d] is not None and passages[first + d]:
                        gone = _covered(automaton, ids[first + d], kept, words.hashes[own])
                        removed = int(gone.sum())
                        if removed:
                            kept = [w for w, g in zip(kept, gone.tolist()) if not g]
                    joined = b" ".join(kept)
                    for column, value in zip(out, (ids[first + d], n, removed, hashlib.sha256(joined).hexdigest())):
                        column.append(value)
                    kept_texts.append(joined.decode() if with_text else None)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([*(pa.array(c, k) for c, k in zip(out, kinds)), pa.array(kept_texts, pa.string())],
                                             names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])

    return rows.mapInArrow(run, RESULT + ", kept_text string")


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept_text (null unless asked for) of every row of ``docs`` (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    named = rows.where("doc_id IS NOT NULL")
    passages = confirmed(named, window).groupBy("doc_id").agg(
        F.collect_list(F.struct("place", "lead", "length", "hash_1", "hash_2", "first")).alias("passages"))
    nameless = rows.where("doc_id IS NULL").withColumn("passages", F.lit(None).cast(passages.schema["passages"].dataType))
    return _removed(named.join(passages, "doc_id", "left").unionByName(nameless), with_text)
