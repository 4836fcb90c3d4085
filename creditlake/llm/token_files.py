"""Operator 5: token ids in binary files of patched frame-of-reference blocks.

A file is self-contained bytes: a header, a directory of its documents, the starts of its blocks, and the blocks. A block
holds ``BLOCK`` ids: its minimum, a bit width that the ``PERCENTILE`` smallest differences from the minimum fit in, the
low bits of all differences packed at that width, and a list of exceptions (position and remaining high bits) for the
others. The index of block starts gives any id range without reading what comes before it (``FileReader.ids``).

``write_table`` deals documents out by ranges of doc_id, encodes them in ascending order and writes files as rows (part,
number and ids before it within the part, bytes) of a Parquet table in the shared folder, so any store that Spark reaches can hold them;
``read_table`` reads them back. Only the totals of the parts meet in one place, for the number of ids before each part.

Defined results: a null text counts as empty; every document has at least the end id. Repeated rows each have their own
entry; rows of one doc_id are in the order of their texts. Null doc_ids come first. An empty table gives no files and no
rows. A document never spans files, so a very long text makes one large file. Extra columns are ignored.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cuts, ranges, scratch, table
from .pieces import PieceCoder, default_vocabulary, vocabulary

BLOCK = 256
PERCENTILE = 90
END_ID = 2
FILE_IDS = 1 << 19
MAGIC = b"PFOR1\0\0\0"
HEADER = struct.Struct("<8sQQQQ")  # magic, documents, ids, blocks, bytes of the blocks
NULL_ID = -(1 << 63)
COLUMNS = "part int, number long, before long, n_ids long, file binary"


def pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of BLOCK values of ``width`` bits each, packed into little-endian 32-bit words."""
    n = len(values)
    words = np.zeros((n, BLOCK * width // 32 + 1), np.uint64)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 32)
        moved = values[:, i] << np.uint64(shift)
        words[:, word] |= moved & np.uint64(0xFFFFFFFF)
        if shift + width > 32:
            words[:, word + 1] |= moved >> np.uint64(32)
    return words[:, :BLOCK * width // 32].astype("<u4")


def unpack(words: np.ndarray, width: int) -> np.ndarray:
    n = len(words)
    out = np.zeros((n, BLOCK), np.uint64)
    if width == 0:
        return out
    wide = np.concatenate([words.astype(np.uint64), np.zeros((n, 1), np.uint64)], 1)
    mask = np.uint64((1 << width) - 1)
    for i in range(BLOCK):
        word, shift = divmod(i * width, 32)
        both = wide[:, word] | (wide[:, word + 1] << np.uint64(32)) if shift + width > 32 else wide[:, word]
        out[:, i] = (both >> np.uint64(shift)) & mask
    return out


def bit_lengths(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Block starts (with the end at last) and the blocks. A block: minimum (u4), width (u1), an unused byte, number of
    exceptions (u2), packed words, exception positions (u1 each), their high bits (u4 each), zeros up to a multiple of 4."""
    n_blocks = -(-len(ids) // BLOCK)
    if not n_blocks:
        return np.zeros(1, np.uint64), b""
    padded = np.concatenate([ids, np.full(n_blocks * BLOCK - len(ids), ids[-1], ids.dtype)]).astype(np.uint64).reshape(n_blocks, BLOCK)
    least = padded.min(1)
    diff = padded - least[:, None]
    bits = bit_lengths(diff)
    rank = -(-BLOCK * PERCENTILE // 100) - 1
    width = np.partition(bits, rank, 1)[:, rank]
    odd = bits > width[:, None]
    n_odd = odd.sum(1)
    sizes = 8 + BLOCK * width // 8 + (5 * n_odd + 3) // 4 * 4
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    out = np.zeros(int(starts[-1]), np.uint8)
    head = np.zeros(n_blocks, np.dtype([("least", "<u4"), ("width", "u1"), ("pad", "u1"), ("odd", "<u2")]))
    head["least"], head["width"], head["odd"] = least, width, n_odd
    out[starts[:-1, None] + np.arange(8)] = head.view(np.uint8).reshape(n_blocks, 8)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        if w:
            words = pack(diff[rows] & np.uint64((1 << w) - 1), w)
            out[starts[rows, None] + 8 + np.arange(words.shape[1] * 4)] = words.view(np.uint8).reshape(len(rows), -1)
    row, col = np.nonzero(odd)
    if len(row):
        at = starts[:-1] + 8 + BLOCK * width // 8
        out[ranges(at, n_odd)] = col
        high = (diff[row, col] >> width[row].astype(np.uint64)).astype("<u4")
        slot = ranges(at + n_odd, n_odd * 4).reshape(-1, 4)
        out[slot] = high.view(np.uint8).reshape(-1, 4)
    return starts.astype(np.uint64), out.tobytes()


def decode_blocks(starts: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """All ids of whole blocks, padding of the last one included."""
    starts = starts.astype(np.int64)
    n = len(starts) - 1
    head = raw[starts[:-1, None] + np.arange(8)].copy().view(np.dtype([("least", "<u4"), ("width", "u1"), ("pad", "u1"), ("odd", "<u2")]))[:, 0]
    width, n_odd = head["width"].astype(np.int64), head["odd"].astype(np.int64)
    out = np.zeros((n, BLOCK), np.uint64)
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        words = raw[starts[rows, None] + 8 + np.arange(BLOCK * w // 8)].view("<u4")
        out[rows] = unpack(words, w)
    if n_odd.any():
        at = starts[:-1] + 8 + BLOCK * width // 8
        row = np.repeat(np.arange(n), n_odd)
        col = raw[ranges(at, n_odd)]
        high = raw[ranges(at + n_odd, n_odd * 4)].view("<u4").astype(np.uint64)
        out[row, col] |= high << width[row].astype(np.uint64)
    return (out + head["least"].astype(np.uint64)[:, None]).astype(np.uint32).ravel()


def write_file(doc_ids: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    starts, blocks = encode_blocks(ids)
    return b"".join([HEADER.pack(MAGIC, len(doc_ids), len(ids), len(starts) - 1, len(blocks)), doc_ids.astype("<i8").tobytes(),
                     counts.astype("<u8").tobytes(), starts.astype("<u8").tobytes(), blocks])


class FileReader:
    """One file: ``doc_ids``, ``counts`` and, by range, ``ids``."""

    def __init__(self, raw: bytes):
        magic, n_docs, self.n_ids, n_blocks, size = HEADER.unpack_from(raw)
        at = HEADER.size
        if magic != MAGIC or len(raw) != at + 16 * n_docs + 8 * (n_blocks + 1) + size:
            raise ValueError("not a whole token file")
        self.doc_ids = np.frombuffer(raw, "<i8", n_docs, at)
        self.counts = np.frombuffer(raw, "<u8", n_docs, at + 8 * n_docs).astype(np.int64)
        self.starts = np.frombuffer(raw, "<u8", n_blocks + 1, at + 16 * n_docs).astype(np.int64)
        self.blocks = np.frombuffer(raw, np.uint8, size, at + 16 * n_docs + 8 * (n_blocks + 1))

    def ids(self, lo: int = 0, hi: int | None = None) -> np.ndarray:
        """Ids lo to hi; only the blocks that hold them are read."""
        hi = self.n_ids if hi is None else min(hi, self.n_ids)
        if hi <= lo:
            return np.zeros(0, np.uint32)
        a, b = lo // BLOCK, -(-hi // BLOCK)
        return decode_blocks(self.starts[a:b + 1], self.blocks)[lo - a * BLOCK:hi - a * BLOCK]


def library_encode(path: str, pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids by the tokenizers library. Pieces of a blank and letters stay apart when they are joined, so many go through one
    call and the ids are dealt to them by their lengths in bytes; all other pieces are encoded one by one."""
    coder, v = library(path), vocabulary(path)
    counts = np.zeros(len(pieces), np.int64)
    plain = np.array([len(p) > 1 and p[0] == " " and p[1:].isalpha() for p in pieces], bool)
    rows, parts = np.flatnonzero(plain), []
    if len(rows):
        texts = [pieces[r] for r in rows]
        coded = coder.encode_batch(["".join(texts[i:i + 256]) for i in range(0, len(texts), 256)], add_special_tokens=False)
        ids = np.concatenate([np.array(c.ids, np.int64) for c in coded])
        stops = np.searchsorted(np.cumsum(v.token_length[ids]), np.cumsum([len(t.encode()) for t in texts])) + 1
        counts[rows] = np.diff(stops, prepend=0)
        parts.append((rows, ids))
    rows = np.flatnonzero(~plain)
    if len(rows):
        coded = [c.ids for c in coder.encode_batch([pieces[r] for r in rows], add_special_tokens=False)]
        counts[rows] = [len(c) for c in coded]
        parts.append((rows, np.fromiter((i for c in coded for i in c), np.int64, int(counts[rows].sum()))))
    start = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint32)
    for rows, ids in parts:
        out[ranges(start[rows], counts[rows])] = ids
    return out, counts


@lru_cache(2)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(2)
def library_coder(path: str) -> PieceCoder:
    return PieceCoder(path, partial(library_encode, path))


def files_of(batches: Iterator[pa.RecordBatch], path: str, end_id: int, file_ids: int) -> Iterator[pa.RecordBatch]:
    coder, part, number = library_coder(path), TaskContext.get().partitionId(), 0
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = before = 0

    def close() -> pa.RecordBatch:
        docs, counts, ids = (np.concatenate(x) for x in zip(*held, strict=True))
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([number], pa.int64()), pa.array([before], pa.int64()),
                                           pa.array([len(ids)], pa.int64()), pa.array([write_file(docs, counts, ids)], pa.binary())],
                                          ["part", "number", "before", "n_ids", "file"])

    for batch in batches:
        for lo, hi in cuts(batch, "text"):
            rows = batch.slice(lo, hi - lo)
            ids, counts = coder([t or "" for t in rows.column(1).to_pylist()])
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id)
            held.append((rows.column(0).fill_null(NULL_ID).to_numpy(zero_copy_only=False), counts + 1, ids))
            size += len(ids)
            if size >= file_ids:
                yield close()
                held, size, before, number = [], 0, before + size, number + 1
    if held:
        yield close()


def write_table(docs: DataFrame, to: str, path: str | None = None, end_id: int = END_ID, file_ids: int = FILE_IDS) -> None:
    """Write token files of the documents, in ascending doc_id order over parts and numbers, to the table ``to``."""
    path = path or default_vocabulary()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = rows.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    ordered.mapInArrow(lambda it: files_of(it, path, end_id, file_ids), COLUMNS) \
        .write.option("compression", "none").parquet(to)


def crcs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for before, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            file = FileReader(raw)
            ends = np.cumsum(file.counts)
            ids = memoryview(file.ids().astype("<u4").tobytes())
            sums = [zlib.crc32(ids[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), file.counts.tolist(), strict=True)]
            null = file.doc_ids == NULL_ID
            yield pa.RecordBatch.from_arrays([pa.array(file.doc_ids, pa.int64(), mask=null), pa.array(before + ends - file.counts, pa.int64()),
                                              pa.array(file.counts, pa.int64()), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_table(spark: SparkSession, at: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32, all from the files."""
    files = spark.read.schema(COLUMNS).parquet(at)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    parts = totals.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("before_part"))
    placed = files.join(F.broadcast(parts), "part")  # one row for each task of write_table
    return placed.select((F.col("before") + F.col("before_part")).alias("before"), "file").mapInArrow(crcs, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op5_token_files(spark: SparkSession, root: str) -> DataFrame:
    at = scratch(spark, "token-files")
    write_table(table(spark, root, "documents"), at)
    return read_table(spark, at)
