"""Operator 11: stretches of words that repeat with a period (runs), by a suffix automaton with link-cut access.

1. Where runs can be: in a run of period q each stretch of up to q words but those of the first period occurs q words before. For
   each power of two up to the text's length, the places whose previous occurrence (of 1, 2, 4 or 8 words) is nearer than the next
   power are marked; runs of such periods lie within marked places in a row, at least three times the power long, and a margin. This
   leaves out most of most texts and no run.
2. There, the suffix automaton of the words is built. Its links form a tree whose root paths are the suffixes of a prefix. A
   link-cut forest over it keeps, for each preferred path, where its strings ended last. Appending a word accesses the node of
   the new prefix: each path segment met holds the suffixes of lengths (l, m] that ended last at e, so with p = (new end) - e, where
   l < p <= m, the last 2p words are a square of smallest period p, and the period reaches m + p words back. All squares that end
   here are found so, in amortised O(log n) steps a word.
3. Squares of one start and period are one run; its end is the last one's. Each run of enough periods lies whole in one of the
   stretches of step 1, so none is cut.

Defined results: null and empty texts have no words, no runs and an empty collapsed text. Documents without doc_id are taken as
they are (``dealt`` leaves them unchanged). Rows of equal doc_id give a row each. Ties between runs go to the smallest start, then period. Texts are whole,
however long. No row gives no row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, Words, map_arrow, mix, ranges, table, utf8

LEAST_WORDS, LEAST_PERIODS = 6, 4
FAR = 1 << 40
COLUMNS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Length of the longest string and link of each state, and the state of each prefix. State 0 is none, 1 the root."""
    size, link, steps = [0, 0], [0, 0], [{}, {}]
    prefix, last = [], 1
    for i, w in enumerate(words):
        state = len(size)
        size.append(i + 1)
        link.append(1)
        steps.append({})
        p = last
        while p and w not in steps[p]:
            steps[p][w] = state
            p = link[p]
        if p:
            q = steps[p][w]
            if size[p] + 1 == size[q]:
                link[state] = q
            else:
                clone = len(size)
                size.append(size[p] + 1)
                link.append(link[q])
                steps.append(steps[q].copy())
                while p and steps[p].get(w) == q:
                    steps[p][w] = clone
                    p = link[p]
                link[q] = link[state] = clone
        prefix.append(state)
        last = state
    return size, link, prefix


def squares(words: list[int]) -> dict[tuple[int, int], int]:
    """(start, period) -> end of the runs of at least two periods."""
    size, link, prefix = automaton(words)
    n = len(size)
    up = link[:]  # parent in the splay tree of a preferred path, or at its root the node that the path hangs from
    up[1] = 0
    left, right, ended = [0] * n, [0] * n, [-1] * n
    out: dict[tuple[int, int], int] = {}
    for i, x in enumerate(prefix):
        below = 0  # the path under x, now preferred
        old, longest = -1, 0
        while x:
            # splay x to the root of its tree, where ``ended`` stands
            while True:
                y = up[x]
                if y == 0 or (left[y] != x and right[y] != x):
                    break
                z = up[y]
                inner = z != 0 and (left[z] == y or right[z] == y)
                if inner:
                    first = y if (left[z] == y) == (left[y] == x) else x
                    turns = (first, x)
                else:
                    turns = (x,)
                for c in turns:
                    p = up[c]
                    g = up[p]
                    if left[p] == c:
                        b = right[c]
                        left[p] = b
                        right[c] = p
                    else:
                        b = left[c]
                        right[p] = b
                        left[c] = p
                    if b:
                        up[b] = p
                    up[p] = c
                    up[c] = g
                    if g:
                        if left[g] == p:
                            left[g] = c
                        elif right[g] == p:
                            right[g] = c
                    if ended[p] != -1:
                        ended[c], ended[p] = ended[p], -1
            mine, m = ended[x], size[x]
            if old >= 0:
                p = i - old
                if m < p <= longest:
                    out[(i - longest - p + 1, p)] = i + 1
            old, longest = mine, m
            rest = right[x]
            if rest:
                ended[rest] = mine  # what hung below keeps its end
            right[x] = below
            if below:
                ended[below] = -1
            below = x
            x = up[x]
        if old >= 0 and 0 < i - old <= longest:
            p = i - old
            out[(i - longest - p + 1, p)] = i + 1
        ended[below] = i
    return out


def nearest(keys: np.ndarray) -> np.ndarray:
    """How far back the same key stands, a large number where nowhere."""
    order = np.argsort(keys, kind="stable")
    back = np.full(len(keys), FAR)
    same = keys[order[1:]] == keys[order[:-1]]
    back[order[1:][same]] = (order[1:] - order[:-1])[same]
    return back


def likely(hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint stretches of words, each within a row, that hold all runs of at least LEAST_PERIODS periods. ``first``: where
    rows begin, and the end."""
    n, longest = len(hashes), int(np.diff(first).max(initial=0))
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    left = first[row + 1] - np.arange(n)  # words from here to the end of the row
    gram = mix(hashes + row.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    found, width = [], 1
    while width * LEAST_PERIODS <= longest:
        k = min(width, 8)
        if width <= 8:  # grams of twice as many words
            if k > 1:
                gram = mix(gram * np.uint64(BASE) + gram[np.minimum(np.arange(n) + k // 2, n - 1)])
            whole = np.flatnonzero(left >= k)
            back = nearest(gram[whole])  # of one row, places count as in ``whole`` wherever both are
            places, back = whole[back < FAR], back[back < FAR]
        marked = places[back < 2 * width]
        cut = np.flatnonzero(np.diff(marked, prepend=-2, append=-2) != 1)
        lo, hi = marked[cut[:-1]], marked[cut[1:] - 1]
        for a, b in zip(lo.tolist(), hi.tolist(), strict=True):
            if b - a + 1 >= (LEAST_PERIODS - 1) * width - k + 1:
                found.append((max(a - 2 * width + 1, int(first[row[a]])), b + k))
        width *= 2
    out: list[tuple[int, int]] = []
    for lo, hi in sorted(found):
        if out and lo < out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def dealt(ids: list, first: np.ndarray) -> np.ndarray:
    """The word that stands at each place: in every tenth document by the crc32 of its id, the words of its tail repeat."""
    source = np.arange(int(first[-1]))
    for r, doc in enumerate(ids):
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        n = int(first[r + 1] - first[r])
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            base = int(first[r]) + a
            source[base:int(first[r + 1])] = base + np.arange(n - a) % p
    return source


def runs_of(hashes: np.ndarray, first: np.ndarray) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of all runs of each row, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(len(first) - 1)]
    for lo, hi in likely(hashes, first):
        r = int(np.searchsorted(first, lo, "right")) - 1
        for (start, period), end in squares(np.unique(hashes[lo:hi], return_inverse=True)[1].tolist()).items():
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * period):
                out[r].append((lo - int(first[r]) + start, end - start, period))
    return [sorted(runs, key=lambda x: (x[0], x[2])) for runs in out]


def chunk(batch: pa.RecordBatch, change: bool) -> pa.RecordBatch:
    data, offsets = utf8(batch.column(1))
    words = Words(data, offsets)
    first = words.first
    source = dealt(batch.column(0).to_pylist(), first) if change else np.arange(len(words.hash))
    every = runs_of(words.hash[source], first)
    kept = np.ones(len(source), bool)
    for r, runs in enumerate(every):
        for start, length, period in runs:
            kept[first[r] + start + period:first[r] + start + length] = False
    place = np.flatnonzero(kept)
    begin, size = words.start[source[place]], words.end[source[place]] - words.start[source[place]] + 1
    stop = np.cumsum(size)
    at = ranges(begin, size)
    text = np.append(data, np.uint8(32))[at]
    text[stop - 1] = 32
    ends = np.concatenate([[0], stop])[np.searchsorted(place, first)].tolist()
    view = memoryview(text.tobytes())
    best, lines, plain = [], [], []
    for r, runs in enumerate(every):
        best.append(max(runs, key=lambda x: (Fraction(x[1], x[2]), -x[0], -x[2])) if runs else (None,) * 3)
        lines.append(hashlib.sha256("".join(f"{s},{m},{p}\n" for s, m, p in runs).encode()).hexdigest())
        plain.append(hashlib.sha256(view[ends[r]:max(ends[r + 1] - 1, ends[r])]).hexdigest())
    start, length, period = zip(*best, strict=True)
    milli = [None if p is None else 1000 * m // p for m, p in zip(length, period, strict=True)]
    kinds = [pa.int64()] * 6 + [pa.string()] * 2
    columns = [batch.column(0), [len(x) for x in every], start, length, period, milli, lines, plain]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in COLUMNS.split(", ")])


def periodic_runs(docs: DataFrame, change: bool = False) -> DataFrame:
    """A row for each document: number of runs, the run of the highest exponent, digests of all runs and of the text without the
    repeats. ``change``: first let the tails of some documents repeat, as the contract of the query asks."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return map_arrow(rows, lambda batch: chunk(batch, change), COLUMNS)


def op11_runs(spark: SparkSession, root: str) -> DataFrame:
    return periodic_runs(table(spark, root, "documents"), change=True)
