"""Packing of documents into sequences: first-fit decreasing with a tournament tree, in randomised groups of documents.

A document's tokens are cut into full sequences and a rest.  The rests are dealt by a hash of the id into groups of about ``GROUP``
rests; each group is packed by itself, the longest rest first, each into the first sequence with room for it.  A tournament tree
over the capacities finds that sequence in logarithmic time: a node holds the larger capacity of its two children.  Groups are
random samples of the rests, so all fill equally well; the padding does not depend on how many groups there are, and a group is as
large whatever the input.

Tokens are made where the documents are read; only ids, places and checksums of the pieces are shuffled.  White space always
separates tokens of this vocabulary, so each distinct word is encoded once per process and looked up afterwards (``WORDS_KEPT``
words are remembered in two halves; when the newer one is full, the older one goes, but for the words used since).

Defined results: a null or empty text is the end token alone.  Rows that repeat an id are packed each by themselves; ``copy`` tells
them apart.  A row without id is packed like any other.  An empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer, pre_tokenizers

from triagelake.llm.common import stored

LENGTH = 4096
GROUP = 5_000
WORDS_KEPT = 250_000
#: Units that the model gets in one call.
UNITS = 4096

#: Letters whose lower case is one letter and which the tokenizer takes as such.
_LETTERS = re.compile("[a-zß-öø-ÿāăąćĉċčďđēĕėęěœšž]+")
#: Fixed value: the characters beyond ASCII with the Unicode White_Space property, which the tokenizer's normaliser replaces by one
#: space like the six that ``bytes.split`` knows.
_WHITE = re.compile(b"\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2(?:\x80[\x80-\x8a\xa8\xa9\xaf]|\x81\x9f)|\xe3\x80\x80")
#: Bytes of texts that need no further look: all but the lead bytes of that white space and of characters from U+0300 on.
_COMMON = bytes([*range(0xC2), *range(0xC3, 0xCC)])
#: What keeps a text from being put in lower case before it is split: a special token may begin, or a character from U+0300 on (but for
#: U+2000 to U+203F) may combine with a letter before it in another way than with its lower case.
_CASED = re.compile(b"<\\||[\xcc-\xe1\xe3-\xff]|\xe2[^\x80]")
#: The commonest signs between an ASCII letter or digit and a space.
_COMMA, _STOP = re.compile(b", (?<=[a-z0-9], )"), re.compile(b"[.] (?<=[a-z0-9][.] )")
#: ASCII punctuation but for the apostrophe, behind a word: one unit of the tokenizer of its own.
_BEHIND = b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in byte-level vocabularies: printable bytes for themselves, the others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder(dict):
    """Little-endian 32-bit token ids of each word met so far, found on demand."""

    def __init__(self, path: str, kept: int | None = None) -> None:
        super().__init__()
        self.kept = kept
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are parallel already
        self.tokenizer = Tokenizer.from_file(path)
        self.unit = self.tokenizer.model.tokenize
        self.letters = "".join(letter for _, letter in sorted(_byte_letters().items()))
        self.packed = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))]
        self.older: dict[bytes, bytes] = {}

    @cached_property
    def spaced(self) -> Tokenizer:
        """The model alone, for units apart by spaces."""
        spaced = Tokenizer(self.tokenizer.model)
        spaced.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return spaced

    @cached_property
    def closes(self) -> np.ndarray:
        """Which ids end a unit."""
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        closes = np.zeros(len(self.packed), dtype=bool)
        closes[[i for t, i in self.tokenizer.get_vocab().items() if suffix and t.endswith(suffix)]] = True
        return closes

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def _unit(self, letters: str) -> bytes:
        packed = self.packed
        return b"".join([packed[t.id] for t in self.unit(letters)])

    def __missing__(self, word: bytes) -> bytes:
        if 2 * len(self) >= (self.kept or WORDS_KEPT):
            self.older = dict(self)
            self.clear()
        found = self.older.get(word)
        if found is None:
            found = self._ids(word)
        self[word] = found
        return found

    def _ids(self, word: bytes) -> bytes:
        low = word.lower()
        if low.isalpha():  # plain ASCII letters
            return self._unit(low.decode())
        core = low.rstrip(_BEHIND)
        if core and len(core) < len(low) and b"<|" not in word and core[-1:].isalnum():
            # Behind an ASCII letter or digit the trailing punctuation is a piece of its own.  Behind any other character the
            # tokenizer's own letter classes decide (their Unicode version may differ from any table here): the whole word goes to it.
            return self[core] + self[low[len(core):]]
        if len(core) == len(low) and _LETTERS.fullmatch(core.decode("utf-8", "replace")):
            return self._unit(core.decode("latin-1").translate(self.letters))
        return self._whole(word.decode("utf-8", "replace"))

    def _units(self, units: list[str]) -> list[bytes]:
        """Ids of each unit, by one call of the model for many of them: the ids that end a unit tell where to cut."""
        made: list[bytes] = []
        for at in range(0, len(units), UNITS):
            some = units[at: at + UNITS]
            ids = np.array(self.spaced.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            ends = 4 * (np.flatnonzero(self.closes[ids]) + 1)
            if len(ends) == len(some) and ends[-1] == 4 * len(ids):
                flat, cuts = ids.tobytes(), ends.tolist()
                made += [flat[a:b] for a, b in zip([0, *cuts], cuts)]
            else:  # units of this vocabulary have no ends of their own
                made += map(self._unit, some)
        return made

    def many(self, words: list[bytes]) -> list[bytes]:
        """Ids of each of some distinct ``words``.  Those of letters among them that were not met before go to the model together,
        trailing punctuation apart; the others are found one by one."""
        found = list(map(self.get, words))
        lacking = [i for i, ids in enumerate(found) if ids is None]
        if lacking and 2 * (len(self) + len(lacking)) >= (self.kept or WORDS_KEPT):
            self.older = dict(self)
            self.clear()
        older, rest, units = self.older, [], {}
        for i in lacking:
            word = words[i]
            ids = older.get(word)
            if ids is not None:
                found[i] = self[word] = ids
                continue
            rest.append(i)
            core = word if word.isalpha() else word.rstrip(_BEHIND)
            if core in self or core in older:
                continue
            if core.isalpha():
                units[core] = core.lower().decode()
            elif len(core) == len(word) and _LETTERS.fullmatch(core.decode("utf-8", "replace")):
                units[core] = core.decode("latin-1").translate(self.letters)
        if units:
            self.update(zip(units, self._units(list(units.values()))))
        for i in rest:
            found[i] = self[words[i]]
        return found

    def flat(self, texts: list[bytes], end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the id ``end`` behind it, and how many each has.  Equal to ``encode``, but
        each distinct word is looked up once for all texts, and no Python object is made for the others."""
        # The split is by bytes, so that texts need not be valid UTF-8; "large" types have no limit of 2 GB.
        spaced = pa.array([self._spaced(t) for t in texts], pa.large_binary()).cast(pa.large_string(), safe=False)
        split = pc.ascii_split_whitespace(spaced)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False).tolist()
        found = pa.array(self.many(words), pa.large_binary()).take(coded.indices)
        ends = np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1] // 4 if len(found) else np.zeros(1, np.int64)
        ids = np.frombuffer(found.buffers()[2] or b"", "<u4")[: ends[-1]]
        cuts = ends[split.offsets.to_numpy()]
        return np.insert(ids, cuts[1:], end), np.diff(cuts) + 1

    def _spaced(self, text: bytes) -> bytes:
        """The text with its words apart by ASCII white space; see ``words``."""
        if text.translate(None, _COMMON):
            text = _WHITE.sub(b" ", text)
            cased = _CASED.search(text)
        else:
            cased = b"<|" in text
        if not cased:
            text = _STOP.sub(b" . ", _COMMA.sub(b" , ", text.lower()))
        return text

    def words(self, text: bytes) -> list[bytes]:
        """The words between white space; where that cannot change what the tokenizer makes of them, with ASCII letters in lower
        case and a comma or full stop behind a letter or digit as a word of its own (``_ids`` says why), so that fewer differ."""
        return self._spaced(text).split()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text, equal to those of the tokenizer on the whole text without special tokens."""
        return [b"".join(map(self.__getitem__, self.words(t))) for t in texts]


@lru_cache(maxsize=1)
def encoder(path: str, kept: int | None = None) -> WordEncoder:
    return WordEncoder(path, kept)


PIECES = "doc_id long, copy long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


def _pieces(docs: DataFrame, path: str, end: int, length: int, with_ids: bool) -> DataFrame:
    closing = np.array([end], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path)
        for batch in batches:
            ids, copies = batch.column("doc_id").to_pylist(), batch.column("copy").to_pylist()
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            for at in range(0, len(texts), 512):
                rows: list[tuple] = []
                for d, tokens in enumerate(words.encode(texts[at: at + 512]), at):
                    tokens += closing
                    total = len(tokens) // 4
                    for start in range(0, total, length):
                        part = tokens[4 * start: 4 * (start + length)]
                        rows.append((ids[d], copies[d], start, len(part) // 4, zlib.crc32(part), total, part if with_ids else None))
                kinds = (*[pa.int64()] * 6, pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                                 names=["doc_id", "copy", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("copy"), "text")
    return rows.mapInArrow(cut, PIECES)


def first_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each size (none above capacity), in the given order: the first bin with room takes it."""
    leaves = 1 << max(0, (len(sizes) - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(sizes), dtype=np.int64), np.zeros(len(sizes), dtype=np.int64)
    for i, size in enumerate(sizes.tolist()):
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            best = max(room[2 * node], room[2 * node + 1])
            if room[node] == best:
                break
            room[node] = best
    return bins, offsets


def pack(docs: DataFrame, path: str, end: int = 2, length: int = LENGTH, seed: int = 11, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, copy, and ids if asked for.

    ``path`` names the tokenizer file on every machine.
    """
    made = stored(_pieces(docs, path, end, length, with_ids), "pieces")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "copy", *(["ids"] if with_ids else [])]
    whole = made.where(F.col("length") == length).withColumns({
        # Odd ids for whole sequences, even ones for packed rests: no shuffle is needed to keep them apart.
        "sequence_id": F.monotonically_increasing_id() * 2 + 1, "offset": F.lit(0).cast("long")})
    rests = made.where(F.col("length") < length)
    groups = 1 + rests.count() // GROUP
    rests = rests.withColumn("group", F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("copy")), F.lit(groups)))

    def fill(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "copy"], ascending=[False, True, True], kind="stable")
        bins, offsets = first_fit(rows["length"].to_numpy(), length)
        return rows.assign(sequence_id=(int(key[0]) << 24 | bins) * 2, offset=offsets)[columns]

    schema = made.select("doc_id", "start", "length", "ids_crc32", "doc_tokens").schema
    names = ", ".join(f"{f.name} long" for f in schema) + ", sequence_id long, offset long, copy long" + (", ids binary" if with_ids else "")
    return whole.select(*columns).unionByName(rests.groupBy("group").applyInPandas(fill, names))
