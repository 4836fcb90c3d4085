"""Operator 12: documents packed into few sequences of at most ``capacity`` tokens.

1. Documents are encoded, closed by an end id, and cut into pieces where they are longer than a sequence. While a task encodes
   it numbers its pieces of each length; pieces are written to the shared folder with that number, without any shuffle.
2. Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the driver. Which contents (so many pieces of
   this length, so many of that) the sequences should have is a linear programme over that histogram: multiplicative weights
   price the lengths, a knapsack dynamic programme finds the contents of highest price, and lengths that these contents cover
   lose weight. The masses are rounded down to whole sequences; what is left is filled up from the longest piece on, each time
   with the piece that leaves the smallest gap, one content for as many sequences as its pieces last.
3. Contents give each length a list of places by number: the n-th piece of a length is in this sequence at this offset. The
   number of a piece over all tasks is its number within the task plus a sum over a table of counts a task.

Defined results: null text is empty, a document of its end id alone. Rows without doc_id and rows of equal doc_id are packed
row by row. Very long texts become pieces of ``capacity`` tokens and one shorter. No row gives no row. Extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import LOWER, SPACES, Words, cuts, ranges, stored, table, utf8
from .pieces import Grown
from .spans import SpanCache

CAPACITY, END_ID = 2048, 0
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, nth long"


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(2)
def library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: White space, letters, digits and other signs of ASCII, and all other bytes.
KINDS = np.full(256, 4, np.uint8)
KINDS[:128] = 3
KINDS[SPACES] = 0
KINDS[[*range(65, 91), *range(97, 123)]] = 1
KINDS[48:58] = 2


#: One kind of small letters, a digit, or signs: a single word to the tokenizer, as it stands.
PLAIN = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff\u03b1-\u03c9\u0430-\u045f]+|[0-9]|[!-&(-/:-@\[-`{-~]+")


def stretches(data: np.ndarray, offsets: np.ndarray, special: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of stretches that the tokenizer encodes apart from each other: words, cut where two ASCII characters of
    different kinds or two digits meet. Not cut: what follows an apostrophe at once (short endings), special tokens, and
    next to other characters, which may form one with those beside them."""
    words = Words(data, offsets)
    kind = KINDS[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = (kind[1:] % 4 > 0) & (kind[:-1] % 4 > 0) & ((kind[1:] != kind[:-1]) | (kind[1:] == 2))
    quote = np.flatnonzero(data == 39)
    for step in (1, 2, 3):
        cut[np.minimum(quote + step, len(data) - 1)] = False
    raw = data.tobytes() if special else b""
    for token in special:
        at = raw.find(token)
        while at >= 0:
            cut[at + 1:at + len(token)] = False
            at = raw.find(token, at + 1)
    cut[words.start] = True
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(data))[:len(start)]
    last = np.searchsorted(words.start, start, "right") - 1
    return start, np.minimum(end, words.end[last])


class WordCoder:
    """Ids of texts by a tokenizer that drops white space and merges inside letters, digits or signs only, whatever their case:
    each distinct stretch is encoded once.

    White space here is the ASCII kind; other white space stays inside a stretch and is left to the library, as are special tokens.
    """

    def __init__(self, path: str, max_entries: int = 700_000):
        self.path = path
        self.last = np.zeros(library(path).get_vocab_size() + 1, bool)
        self.last[[i for t, i in library(path).get_vocab().items() if t.endswith("</w>")]] = True
        self.special = [t.content.encode() for t in library(path).get_added_tokens_decoder().values()]
        self.cache = SpanCache(self.learn, self.forget, max_entries)

    def forget(self) -> None:
        self.ids, self.at, self.n = Grown(np.uint32), Grown(np.int64), Grown(np.int64)

    def learn(self, stretches: list[str]) -> None:
        """Plain ones, of which each has one id that ends a word, go through the library many at a time."""
        plain = np.fromiter((PLAIN.fullmatch(w) is not None for w in stretches), bool, len(stretches))
        coder = library(self.path)
        together, apart = np.flatnonzero(plain), np.flatnonzero(~plain)
        counts = np.zeros(len(stretches), np.int64)
        joined = [" ".join([stretches[i] for i in together[at:at + 200].tolist()]) for at in range(0, len(together), 200)]
        flat = [np.array(e.ids, np.uint32) for e in coder.encode_batch_fast(joined, add_special_tokens=False)]
        first = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        counts[together] = np.diff(np.flatnonzero(self.last[first]), prepend=-1)
        lists = [np.array(e.ids, np.uint32) for e in coder.encode_batch_fast([stretches[i] for i in apart.tolist()], add_special_tokens=False)]
        counts[apart] = [len(ids) for ids in lists]
        start = np.cumsum(counts) - counts
        ids = np.zeros(int(counts.sum()), np.uint32)
        ids[ranges(start[together], counts[together])] = first
        ids[ranges(start[apart], counts[apart])] = np.concatenate([np.zeros(0, np.uint32), *lists])
        self.at.add(self.ids.n + start)
        self.n.add(counts)
        self.ids.add(ids)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after another, and the number of ids of each text."""
        raw = data.tobytes()
        special = [t for t in self.special if t in raw]
        start, end = stretches(data, offsets, special)
        # special tokens are told by case, and small letters don't make new ones
        entry = self.cache(data if special or any(t in raw.lower() for t in self.special) else LOWER[data], start, end)
        counts = self.n.data[entry]
        total = np.concatenate([[0], np.cumsum(counts)])
        return self.ids.data[ranges(self.at.data[entry], counts)], np.diff(total[np.searchsorted(start, offsets)])


@lru_cache(2)
def word_coder(path: str) -> WordCoder:
    return WordCoder(path)


def pieces_of(batches: Iterator[pa.RecordBatch], path: str, end_id: int, capacity: int) -> Iterator[pa.RecordBatch]:
    coder, part = word_coder(path), TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, np.int64)
    for batch in batches:
        for lo, hi in cuts(batch, 1):
            rows = batch.slice(lo, hi - lo)
            ids, counts = coder(*utf8(rows.column(1)))
            ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            many = -(-counts // capacity)
            row = np.repeat(np.arange(len(counts)), many)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
            start = piece * capacity
            length = np.minimum(counts[row] - start, capacity)
            raw, at = memoryview(ids.tobytes()), (np.cumsum(counts) - counts)[row] + start
            sums = [zlib.crc32(raw[4 * a:4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist(), strict=True)]
            # the number of each piece among the task's pieces of its length
            order = np.argsort(length, kind="stable")
            kinds, first, size = np.unique(length[order], return_index=True, return_counts=True)
            nth = np.empty(len(row), np.int64)
            nth[order] = np.arange(len(row)) - np.repeat(first, size) + np.repeat(seen[kinds], size)
            seen[kinds] += size
            yield pa.RecordBatch.from_arrays([rows.column(0).take(pa.array(row)), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(sums, pa.int64()),
                                              pa.array(np.full(len(row), part, np.int32)), pa.array(nth)], [c.split()[0] for c in PIECES.split(", ")])


def knapsack(price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Highest total price of pieces (any number of each length) that fill at most 0 .. capacity tokens, and the length taken
    last (0 where a token stays empty)."""
    best, last = np.zeros(capacity + 1), np.zeros(capacity + 1, np.int64)
    backwards = price[::-1]  # price[l] at -1 - l
    for c in range(1, capacity + 1):
        total = best[:c] + backwards[-1 - c:-1]  # a piece of length c - j on top of j tokens
        j = int(total.argmax())
        if total[j] > best[c - 1]:
            best[c], last[c] = total[j], c - j
        else:
            best[c] = best[c - 1]
    return best, last


def contents(last: np.ndarray, room: int) -> dict[int, int]:
    out: dict[int, int] = {}
    while room > 0:
        length = int(last[room])
        out[length] = out.get(length, 0) + 1
        room -= max(length, 1)
    out.pop(0, None)
    return out


def fractional(need: np.ndarray, capacity: int, rounds: int = 120, columns: int = 24, rate: float = 0.1) -> tuple[dict[tuple, float], float]:
    """Masses of contents that cover the histogram ``need`` (pieces by length) to the same part each, about (those of the second
    half of the rounds: the weights settle before), and a bound that
    no packing goes below: the worth of all pieces at prices at which no contents are worth more than 1."""
    kinds = np.flatnonzero(need)
    weight = np.zeros(capacity + 1)
    weight[kinds] = kinds  # a token is worth the same in every length where all sequences can be filled
    covered, mass, bound = np.zeros(capacity + 1), {}, 0.0
    for r in range(rounds):
        if r == rounds // 2:
            mass = {}
        best, last = knapsack(weight, capacity)
        bound = max(bound, float((need * weight).sum() / best[capacity]))
        behind = kinds[np.argsort(covered[kinds] / need[kinds], kind="stable")[:columns]]
        worth = weight[behind] + best[capacity - behind]
        for length in behind[worth >= (1 - rate / 4) * worth.max()].tolist():
            one = contents(last, capacity - length)
            one[length] = one.get(length, 0) + 1
            ls, ns = np.array(list(one)), np.array(list(one.values()))
            step = float((need[ls] / ns).min())
            key = tuple(sorted(one.items(), reverse=True))
            mass[key] = mass.get(key, 0.0) + step
            covered[ls] += step * ns
            weight[ls] *= np.exp(-rate * step * ns / need[ls])
        weight *= capacity / weight.max()
    return mass, bound


def rounded(need: np.ndarray, mass: dict[tuple, float], capacity: int) -> list[tuple[tuple, int]]:
    """(contents, sequences) that hold every piece exactly once."""
    left, out = need.copy(), []
    tokens = float((need * np.arange(capacity + 1)).sum())
    given = 1e-9 + sum(x * sum(n * k for n, k in c) for c, x in mass.items())
    for c, x in sorted(mass.items(), key=lambda m: (-m[1], m[0])):
        copies = min(int(x * tokens / given), *(int(left[n]) // k for n, k in c))
        if copies:
            out.append((c, copies))
            for n, k in c:
                left[n] -= k * copies
    while left.any():
        one, room = {}, capacity
        kinds = np.flatnonzero(left)
        while len(kinds := kinds[kinds <= room]):
            free = {int(n): int(left[n]) - one.get(int(n), 0) for n in kinds}
            fits = [n for n in free if free[n] > 0]
            if not fits:
                break
            take = fits[-1]
            if one:  # two pieces that leave no gap, before the largest that fits
                there = set(fits)
                if room not in there:
                    pair = next((n for n in reversed(fits) if room - n in there and (2 * n != room or free[n] > 1)), None)
                    take = take if pair is None else pair
            one[take] = one.get(take, 0) + 1
            room -= take
        copies = min(int(left[n]) // k for n, k in one.items())
        out.append((tuple(sorted(one.items(), reverse=True)), copies))
        for n, k in one.items():
            left[n] -= k * copies
    return out


def places(plan: list[tuple[tuple, int]], capacity: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first number, sequence of it, pieces a sequence and offset, of each block of pieces."""
    out: dict[int, list[tuple]] = {}
    used: dict[int, int] = {}
    sequence = 0
    for c, copies in plan:
        offset = 0
        for n, k in c:
            out.setdefault(n, []).append((used.get(n, 0), sequence, k, offset))
            used[n] = used.get(n, 0) + k * copies
            offset += n * k
        sequence += copies
    return {n: tuple(np.array(col, np.int64) for col in zip(*rows, strict=True)) for n, rows in out.items()}


def plan_for(need: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    if not need.any():
        return []
    full = int(need[capacity])
    rest = need.copy()
    rest[capacity] = 0
    plan = [(((capacity, 1),), full)] if full else []
    return plan + (rounded(rest, fractional(rest, capacity)[0], capacity) if rest.any() else [])


def packed(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    path = path or default_tokenizer()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = stored(rows.mapInArrow(lambda it: pieces_of(it, path, end_id, capacity), PIECES), "pieces")
    counts = stored(pieces.groupBy("part", F.col("length").alias("kind")).agg(F.count("*").alias("n")), "counts")
    need = np.zeros(capacity + 1, np.int64)
    for r in counts.groupBy("kind").agg(F.sum("n").alias("n")).collect():  # at most ``capacity`` rows
        need[r["kind"]] = r["n"]
    at = places(plan_for(need, capacity), capacity)
    before = counts.select(F.col("part").alias("of_part"), "kind", (F.sum("n").over(W.partitionBy("kind").orderBy("part")) - F.col("n")).alias("before"))
    numbered = pieces.join(before, (F.col("part") == F.col("of_part")) & (F.col("length") == F.col("kind"))) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("nth")).alias("number"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for n in np.unique(length).tolist():
                rows = np.flatnonzero(length == n)
                first, base, k, place = at[n]
                block = np.searchsorted(first, number[rows], "right") - 1
                within = number[rows] - first[block]
                sequence[rows] = base[block] + within // k[block]
                offset[rows] = place[block] + n * (within % k[block])
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)],
                                             ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return numbered.mapInArrow(put, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op12_packing(spark: SparkSession, root: str) -> DataFrame:
    return packed(table(spark, root, "documents"))
