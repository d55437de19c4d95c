"""Token ids as binary files: frequency-ranked ids in byte-aligned variable-length code with separate control bytes.

Tokens.  Each document is encoded by the tokenizer file without special tokens, and the end id is appended.  The tokenizer's own
normaliser turns every run of Unicode white space into one space, and its splitting pattern never joins pieces across a space, so
the ids of a text are the ids of its white-space separated words, one after the other (the word encoder of the packing operator,
whose ids equal the tokenizer's on whole texts).  Arrow splits about ``SLICE_BYTES`` of texts at once and finds their distinct words;
only these are looked up among the ``WORDS_KEPT`` words that a process remembers, and the new ones of letters go to the tokenizer's
model together.  The ids of all these texts are put into the code at once, and read from it in slices of ``SLICE_ROWS`` rows: numpy
over the concatenated streams, no step per document.

Ranks.  Each task counts its ids as it makes them (a vector as long as the vocabulary) and adds the counts as one row behind its
documents, in columns of their own, so that the ids are not read again for them; the counts are summed by id and ranked by falling
count, ties by id.  The rank table is as long as the vocabulary at most, which bounds what the driver reads and what every task gets.

The ids are stored and shuffled in the code of the files (with ids in place of ranks), about 2.25 bytes an id.

Files.  Documents are range-partitioned by (doc_id, checksum of the text) and sorted, so one task writes one ascending run.  A task
cuts its run into blocks of whole documents of about ``BLOCK_IDS`` ids.  A block holds the doc ids, the number of ids of each
document, and the ranks of all its ids in the code: four 2-bit lengths (1 to 4 bytes) in one control byte, and the little-endian
low bytes of each rank in a data stream of its own.  Blocks are rows of a Parquet table (``blocks``), so that every Hadoop file
system takes them; ``vocabulary`` maps ranks to ids.  Reading decodes a block with two table lookups in numpy: control byte to four
lengths, rank to id.

Defined results: a null or empty text is the end id alone.  A null doc_id sorts first.  Rows that repeat a doc_id are separate
documents, ordered by a checksum of their texts; equal rows give equal results.  An empty table writes no block and reads back empty.
Very long texts are encoded whole; a block then holds that one document.  Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from triagelake.llm.common import stored
from triagelake.llm.packing import encoder
from triagelake.llm.words import pieces
from triagelake.sources.session import fresh_path

BLOCK_IDS = 1 << 20
#: Rows put into the code, or read from it, at once.
SLICE_ROWS = 512
#: Bytes of text whose distinct words are looked up together; a longer text is taken by itself.
SLICE_BYTES = 4 << 20
#: Words remembered per process: many words are rare, and those forgotten have to be encoded anew.
WORDS_KEPT = 1_000_000

#: Control byte to the byte lengths of its four values: bits 0-1 hold the first length less one, and so on.
LENGTHS = ((np.arange(256)[:, None] >> (2 * np.arange(4))) & 3).astype(np.uint8) + np.uint8(1)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The rows of all batches in slices of at most ``rows`` rows: what numpy holds at once is bounded by the slice, not the batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def tokens(docs: DataFrame, path: str, end: int = 2) -> DataFrame:
    """doc_id, tie (checksum of the text, orders rows that repeat an id), n (ids) and the ids (end id last) of every row, in the
    code of the files with the ids themselves in place of ranks: ``control`` and ``data``.  Stored and shuffled in this form.

    Each task adds one row (``n`` is null) with the ids it met, ``seen``, and how often, ``times``; both are null in all other rows.
    """
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path, WORDS_KEPT)
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for at, texts in pieces([t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()], SLICE_BYTES):
                ids, n = words.flat(texts, end)
                found = np.bincount(ids, minlength=len(total))
                found[: len(total)] += total
                total = found
                control, data = encode_batch(ids, n)
                none = pa.nulls(len(n), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(at, len(n)) for c in ("doc_id", "tie")),
                                                  pa.array(n, pa.int64()), control, data, none, none], schema=_TOKENS_SCHEMA)
        if len(total):
            seen = np.flatnonzero(total)
            yield pa.RecordBatch.from_pydict({"doc_id": [None], "tie": [None], "n": [None], "control": [None], "data": [None],
                                              "seen": [seen], "times": [total[seen]]}, schema=_TOKENS_SCHEMA)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("tie"), "text")
    return rows.mapInArrow(encode, "doc_id long, tie long, n long, control binary, data binary, seen array<bigint>, times array<bigint>")


_TOKENS_SCHEMA = pa.schema([("doc_id", pa.int64()), ("tie", pa.int64()), ("n", pa.int64()), ("control", pa.binary()),
                            ("data", pa.binary()), ("seen", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])


def counts(ids: DataFrame) -> DataFrame:
    """id, count: the counts of all tasks, summed by id."""
    pairs = ids.where("n IS NULL").select(F.inline(F.arrays_zip("seen", "times")))
    return pairs.groupBy(F.col("seen").alias("id")).agg(F.sum("times").alias("count"))


def ranking(ids: DataFrame) -> DataFrame:
    """rank, id, count: the most frequent id first, ties by id.  As many rows as distinct ids, so at most the vocabulary."""
    return counts(ids).select(
        (F.row_number().over(Window.orderBy(F.desc("count"), "id")) - 1).alias("rank"), "id", "count")


def _lengths(ranks: np.ndarray) -> np.ndarray:
    """Bytes of each rank, 1 to 4, as unsigned bytes."""
    one = np.uint8(1)
    lengths = one + (ranks > 0xFF)
    if len(ranks) and ranks.max() > 0xFFFF:
        lengths += (ranks > 0xFFFF)
        lengths += (ranks > 0xFFFFFF)
    return lengths


def _low_bytes(ranks: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The lowest bytes of each rank, as many as ``lengths`` says, one after the other."""
    width = 2 if not len(ranks) or lengths.max() <= 2 else 4
    return ranks.astype(f"<u{width}").view(np.uint8).reshape(-1, width)[np.arange(width, dtype=np.uint8) < lengths[:, None]]


def _control(codes: np.ndarray) -> np.ndarray:
    return codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned ranks."""
    ranks = ranks.astype(np.uint32)
    lengths = _lengths(ranks)
    codes = np.zeros(-(-len(ranks) // 4) * 4, dtype=np.uint8)
    codes[: len(ranks)] = lengths - 1
    return _control(codes).tobytes(), _low_bytes(ranks, lengths).tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks of a control and a data stream, by table lookup: no loop over values."""
    return _values(LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n], np.frombuffer(data, np.uint8))


def _values(lengths: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Values of byte lengths ``lengths`` read one after the other from ``data``, little-endian."""
    starts = np.cumsum(lengths, dtype=np.int64) - lengths
    padded = np.concatenate([data, np.zeros(3, np.uint8)])
    values = padded[starts].astype(np.int64)
    for k in range(1, int(lengths.max(initial=1))):
        values |= (padded[starts + k] * (lengths > k)).astype(np.int64) << (8 * k)
    return values


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0, one more than rows) and bytes of a binary column without nulls."""
    column = column.cast(pa.binary())
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int32)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    values = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return offsets - offsets[0], values[offsets[0]: offsets[-1]]


def _binary(offsets: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1,
                                 [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))])


def encode_batch(ranks: np.ndarray, n: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Control and data bytes of many rows at once: ``ranks`` holds the values of all rows one after the other, ``n`` how many
    each row has.  Equal, row by row, to ``encode_ranks`` of each row's values."""
    ranks = ranks.astype(np.uint32)
    n = np.asarray(n, dtype=np.int64)
    lengths = _lengths(ranks)
    groups = (n + 3) // 4
    group_ends = np.cumsum(groups)
    row_starts = np.cumsum(n) - n
    codes = np.zeros(4 * int(group_ends[-1]) if len(n) else 0, dtype=np.uint8)
    codes[np.repeat(4 * (group_ends - groups) - row_starts, n) + np.arange(len(ranks))] = lengths - 1
    byte_ends = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
    return (_binary(np.concatenate([[0], group_ends]), _control(codes)),
            _binary(byte_ends[np.concatenate([[0], np.cumsum(n)])], _low_bytes(ranks, lengths)))


def decode_batch(control: pa.Array, data: pa.Array, n: np.ndarray) -> np.ndarray:
    """The values of all rows of a control and a data column, one row after the other: two table lookups over the batch."""
    n = np.asarray(n, dtype=np.int64)
    control_offsets, control_bytes = _flat(control)
    slots = 4 * np.diff(control_offsets)
    lengths = LENGTHS[control_bytes].reshape(-1)
    within = np.arange(len(lengths)) - np.repeat(4 * control_offsets[:-1], slots)
    return _values(lengths[within < np.repeat(n, slots)], _flat(data)[1])


BLOCKS = ("part int, block int, part_start long, doc_ids array<bigint>, n_docs int, n_ids long, "
          "length_control binary, length_data binary, control binary, data binary")


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end: int = 2, parts: int | None = None) -> str:
    """Encode all ``docs`` and write their ids to the folder ``path``: ``vocabulary`` and ``blocks`` (Parquet).  Returns ``path``."""
    spark = docs.sparkSession
    vocabulary = Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True)
    made = stored(tokens(docs, tokenizer, end), "token-ids")
    ranked = ranking(made)
    ranked.write.parquet(f"{path}/vocabulary")
    # One row per distinct id: the vocabulary bounds what the driver reads and ships to the tasks.
    table = spark.read.parquet(f"{path}/vocabulary").select("id", "rank").toPandas()
    to_rank = np.zeros(max(vocabulary, end + 1), dtype=np.int64)
    to_rank[table["id"].to_numpy()] = table["rank"].to_numpy()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part_start, block, held = 0, 0, []

        def flush() -> pa.RecordBatch:
            ids = np.concatenate([v for _, v in held])
            lengths = np.array([len(v) for _, v in held], dtype=np.int64)
            length_control, length_data = encode_ranks(lengths)
            control, data = encode_ranks(to_rank[ids])
            values = [[part], [block], [part_start], [[d for d, _ in held]], [len(held)], [len(ids)], [length_control], [length_data],
                      [control], [data]]
            return pa.RecordBatch.from_pydict(dict(zip([c.split()[0] for c in BLOCKS.split(", ")], values)),
                                              schema=_BLOCK_SCHEMA)

        part = None
        size = 0
        for batch in _slices(batches):
            counts_seen = batch.column("n").to_numpy(zero_copy_only=False)
            every = decode_batch(batch.column("control"), batch.column("data"), counts_seen)
            for d, p, ids in zip(batch.column("doc_id").to_pylist(), batch.column("part").to_pylist(),
                                 np.split(every, np.cumsum(counts_seen)[:-1])):
                part = p
                held.append((d, ids))
                size += len(ids)
                if size >= BLOCK_IDS:
                    yield flush()
                    part_start, block, held, size = part_start + size, block + 1, [], 0
        if held:
            yield flush()

    parts = parts or max(1, made.rdd.getNumPartitions())
    ordered = (made.where("n IS NOT NULL").repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "tie")
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
               .select(F.spark_partition_id().alias("part"), "doc_id", "n", "control", "data"))
    ordered.mapInArrow(write, BLOCKS).write.parquet(f"{path}/blocks")
    return path


_BLOCK_SCHEMA = pa.schema([
    ("part", pa.int32()), ("block", pa.int32()), ("part_start", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("n_docs", pa.int32()),
    ("n_ids", pa.int64()), ("length_control", pa.binary()), ("length_data", pa.binary()), ("control", pa.binary()),
    ("data", pa.binary())])


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ids (u32 little-endian) if asked for.

    The start of each task's run is the sum of the ids of all runs before it: a window over one row per run, not per document.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    table = spark.read.parquet(f"{path}/vocabulary").select("rank", "id").toPandas()
    to_id = np.zeros(len(table), dtype=np.int64)
    to_id[table["rank"].to_numpy()] = table["id"].to_numpy()
    runs = blocks.groupBy("part").agg(F.sum("n_ids").alias("run_ids")).select(
        "part", (F.sum("run_ids").over(Window.orderBy("part")) - F.col("run_ids")).alias("run_start"))
    # One row per writing task: bounded by the number of tasks that wrote the files.
    placed = blocks.join(F.broadcast(runs), "part").select("run_start", *[c.split()[0] for c in BLOCKS.split(", ")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"doc_id": [], "start": [], "n_tokens": [], "ids_crc32": [], "ids": []}
            for row in batch.to_pylist():
                lengths = decode_ranks(row["length_control"], row["length_data"], row["n_docs"])
                ids = to_id[decode_ranks(row["control"], row["data"], row["n_ids"])].astype("<u4")
                at = row["run_start"] + row["part_start"]
                cut = np.concatenate([[0], np.cumsum(lengths)])
                for d, a, b in zip(row["doc_ids"], cut[:-1].tolist(), cut[1:].tolist()):
                    piece = ids[a:b].tobytes()
                    out["doc_id"].append(d)
                    out["start"].append(at + a)
                    out["n_tokens"].append(b - a)
                    out["ids_crc32"].append(zlib.crc32(piece))
                    out["ids"].append(piece if with_ids else None)
            yield pa.RecordBatch.from_pydict(out, schema=_READ_SCHEMA)

    found = placed.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    return found if with_ids else found.drop("ids")


_READ_SCHEMA = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
                          ("ids", pa.binary())])


def token_ids(docs: DataFrame, tokenizer: str, end: int = 2, path: str | None = None) -> DataFrame:
    """Write the files of all ``docs`` (to a new folder in the shared one unless ``path`` is given) and read them back."""
    spark = docs.sparkSession
    path = write_token_files(docs, path or fresh_path(spark, "token-files"), tokenizer, end)
    return read_token_files(spark, path)
