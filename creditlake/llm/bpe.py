"""Operator 10: byte-level BPE encoding and decoding with a segment tree over adjacent pair ranks.

The leaves of the tree hold, for each live position of a piece, the rank of the merge of the symbol there with the next
one (no merge: a large value) together with the position; each inner node holds the smaller of its children, so the
root is the leftmost pair of the lowest rank. A merge changes three leaves, each updated up to the root. Short pieces
(up to 64 bytes) run through one tree each, all at once in a numpy matrix; longer pieces through ``PairTree``, which
needs O(n log n) steps for a piece of n bytes.

Defined results: a null text counts as empty; an empty text has no ids and decodes to the empty text. A special token
of the vocabulary is one id. Repeated rows and repeated or null doc_ids give one row each. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import map_arrow, ranges, table
from .pieces import PieceCoder, Vocabulary, default_vocabulary, vocabulary

SHORT = 64
NONE = np.int64(1) << 60


class PairTree:
    """Segment tree over the pair ranks of one piece."""

    def __init__(self, v: Vocabulary, symbols: list[int]):
        self.v, self.symbols, n = v, symbols, len(symbols)
        self.size = 1 << max(n - 1, 1).bit_length()
        self.next, self.prev = list(range(1, n + 1)), list(range(-1, n - 1))
        none = (int(NONE), 0)
        self.tree = [none] * (2 * self.size)
        for i in range(n - 1):
            self.tree[self.size + i] = (self.rank(i), i)
        for i in range(self.size - 1, 0, -1):
            self.tree[i] = min(self.tree[2 * i], self.tree[2 * i + 1])

    def rank(self, i: int) -> int:
        j = self.next[i]
        if j >= len(self.symbols):
            return int(NONE)
        return self.v.ranks.get(self.symbols[i] * self.v.size + self.symbols[j], int(NONE))

    def put(self, i: int, rank: int) -> None:
        tree, i = self.tree, i + self.size
        tree[i] = (rank, i - self.size)
        while i > 1:
            i >>= 1
            least = min(tree[2 * i], tree[2 * i + 1])
            if tree[i] == least:
                break
            tree[i] = least

    def merge_all(self) -> list[int]:
        n = len(self.symbols)
        while (root := self.tree[1])[0] < NONE:
            rank, i = root
            j = self.next[i]
            self.symbols[i], self.symbols[j] = int(self.v.merged[rank]), -1
            self.next[i] = self.next[j]
            if self.next[i] < n:
                self.prev[self.next[i]] = i
            self.put(j, int(NONE))
            self.put(i, self.rank(i))
            if self.prev[i] >= 0:
                self.put(self.prev[i], self.rank(self.prev[i]))
        return [s for s in self.symbols if s >= 0]


def merge_matrix(v: Vocabulary, symbols: np.ndarray) -> np.ndarray:
    """The same for many short pieces: one row each, -1 beyond the end; the width is a power of two."""
    n, width = symbols.shape
    wide = np.int64(width)
    sym = np.full((n, width + 1), -1, np.int64)
    sym[:, :width] = symbols
    nxt = np.tile(np.arange(1, width + 2), (n, 1))
    prv = np.tile(np.arange(-1, width), (n, 1))

    def ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * v.size + b
        at = np.minimum(np.searchsorted(v.keys, key), len(v.keys) - 1)
        return np.where((a >= 0) & (b >= 0) & (v.keys[at] == key), v.rank_of_key[at], NONE >> 8)

    tree = np.full((n, 2 * width), NONE, np.int64)
    tree[:, width:] = ranks(sym[:, :-1], sym[:, 1:]) * wide + np.arange(width)
    for i in range(width - 1, 0, -1):
        tree[:, i] = np.minimum(tree[:, 2 * i], tree[:, 2 * i + 1])
    limit = (NONE >> 8) * wide
    live = np.flatnonzero(tree[:, 1] < limit)
    while len(live):
        root = tree[live, 1]
        i, rank = root % wide, root // wide
        j = nxt[live, i]
        k = nxt[live, j]
        sym[live, i] = v.merged[rank]
        sym[live, j] = -1
        nxt[live, i] = k
        prv[live, k] = i
        before = prv[live, i]
        has = before >= 0
        before0 = np.maximum(before, 0)
        tree[live, width + j] = NONE
        tree[live, width + i] = ranks(sym[live, i], np.where(k < width, sym[live, np.minimum(k, width)], -1)) * wide + i
        left = ranks(sym[live, before0], sym[live, i]) * wide + before0
        tree[live[has], width + before[has]] = left[has]
        for leaf in (j, i, before0):
            node = (leaf + width) >> 1
            while node[0] >= 1:
                tree[live, node] = np.minimum(tree[live, 2 * node], tree[live, 2 * node + 1])
                node >>= 1
        live = live[tree[live, 1] < limit]
    return sym[:, :width]


def encode_pieces(v: Vocabulary, pieces: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of the pieces, one piece after another, and the number of ids of each."""
    raw = [p.encode() for p in pieces]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    counts = np.zeros(len(raw), np.int64)
    parts = []
    width, done = 2, 0
    while done < SHORT:
        rows = np.flatnonzero((sizes > done) & (sizes <= width))
        if len(rows):
            flat = np.frombuffer(b"".join(raw[r] for r in rows), np.uint8)
            matrix = np.full((len(rows), width), -1, np.int64)
            matrix[np.arange(width) < sizes[rows][:, None]] = v.byte_ids[flat]
            merged = merge_matrix(v, matrix)
            kept = merged >= 0
            counts[rows] = kept.sum(1)
            parts.append((rows, merged[kept]))
        done, width = width, width * 2
    for r in np.flatnonzero(sizes > SHORT).tolist():
        ids = PairTree(v, v.byte_ids[np.frombuffer(raw[r], np.uint8)].tolist()).merge_all()
        counts[r] = len(ids)
        parts.append((np.array([r]), np.array(ids, np.int64)))
    start = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint32)
    for rows, ids in parts:
        out[ranges(start[rows], counts[rows])] = ids
    return out, counts


@lru_cache(2)
def tree_coder(path: str) -> PieceCoder:
    return PieceCoder(path, partial(encode_pieces, vocabulary(path)), max_entries=200_000)


def decode_bytes(v: Vocabulary, ids: np.ndarray) -> np.ndarray:
    return v.token_bytes[ranges(v.token_start[ids], v.token_length[ids])]


def decode(ids: Sequence[int], path: str | None = None) -> str:
    """The text of these ids; bytes that form no character become U+FFFD."""
    v = vocabulary(path or default_vocabulary())
    return decode_bytes(v, np.asarray(ids, np.int64)).tobytes().decode("utf-8", "replace")


def chunk(batch: pa.RecordBatch, path: str, texts: bool) -> pa.RecordBatch:
    v = vocabulary(path)
    ids, counts = tree_coder(path)([t or "" for t in batch.column(1).to_pylist()])
    ids = ids.astype("<u4")
    at = np.concatenate([[0], np.cumsum(counts)])
    plain = decode_bytes(v, ids)
    plain_at = np.concatenate([[0], np.cumsum(v.token_length[ids])])[at]
    back, sums, digests = [], [], []
    raw, raw_plain = memoryview(ids.tobytes()), memoryview(plain.tobytes())
    for d in range(len(counts)):
        mine = raw[4 * at[d]:4 * at[d + 1]]
        text = raw_plain[plain_at[d]:plain_at[d + 1]].tobytes().decode("utf-8", "replace")
        if texts:
            back.append((mine.tobytes(), text))
        else:
            sums.append(hashlib.sha256(mine).hexdigest())
            digests.append(hashlib.sha256(text.encode()).hexdigest())
    number = pa.array(counts, pa.int64())
    if texts:
        return pa.RecordBatch.from_arrays([batch.column(0), number, pa.array([b[0] for b in back], pa.binary()), pa.array([b[1] for b in back], pa.string())],
                                          ["doc_id", "n_tokens", "ids", "decoded"])
    return pa.RecordBatch.from_arrays([batch.column(0), number, pa.array(sums, pa.string()), pa.array(digests, pa.string())],
                                      ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def round_trip(docs: DataFrame, path: str | None = None, digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, and either ids (little-endian unsigned 32-bit integers) with the text decoded from them, or, with
    ``digests``, the SHA-256 of both in hexadecimal."""
    path = path or default_vocabulary()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    columns = "ids_sha256 string, decoded_sha256 string" if digests else "ids binary, decoded string"
    return map_arrow(rows, lambda b: chunk(b, path, not digests), f"doc_id long, n_tokens long, {columns}")


def op10_bpe(spark: SparkSession, root: str) -> DataFrame:
    return round_trip(table(spark, root, "documents"), digests=True)
