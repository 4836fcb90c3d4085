"""Helpers shared by the operators of this folder: shared scratch tables and vectorised text handling.

Text work runs on whole Arrow batches: numpy sees the UTF-8 bytes of many documents at once, cut into chunks of a few
megabytes so that memory does not depend on the size of a batch. A document is never cut.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
#: White space of the word rule `[^\x20\x09-\x0D]+`.
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True
#: A-Z to a-z, all other bytes unchanged.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder: ``spark.checkpoint.dir``, or a folder below the warehouse where that is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{root.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: work done once, lineage cut, safe from lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """True for the fifth of the rows that no model may learn from; null ids belong to it."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(col.cast("string")) % 5 == 0, F.lit(True))


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, text: int | None = None) -> DataFrame:
    """Apply ``fn`` to slices of the rows of about ``CHUNK_BYTES`` of text (the column at ``text``, or the first of strings), at
    least one row each."""
    if text is None:
        text = next((i for i, f in enumerate(df.schema.fields) if f.dataType.typeName() == "string"), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in cuts(batch, text):
                out = fn(batch.slice(lo, hi - lo))
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def cuts(batch: pa.RecordBatch, text: int | str | None) -> Iterator[tuple[int, int]]:
    if text is None or batch.num_rows == 0:
        if batch.num_rows:
            yield 0, batch.num_rows
        return
    _, offsets = utf8(batch.column(text))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(offsets, offsets[lo] + CHUNK_BYTES, "right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield lo, hi
        lo = hi


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts, one after another, and where each begins (with the end at last). Null is empty."""
    wide = pa.types.is_large_string(column.type)
    if column.null_count:
        column = column.fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64) \
        if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    return data, offsets - offsets[0]


@lru_cache(4)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.cumprod(np.full(n, BASE, np.uint64)) if n else np.zeros(0, np.uint64)
    down = np.cumprod(np.full(n, pow(BASE, -1, 1 << 64), np.uint64)) if n else np.zeros(0, np.uint64)
    return up, down


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of ``values``, by content alone."""
    n = len(values)
    up, down = powers(1 << max(int(n).bit_length(), 10))
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The words of a chunk of documents: ``start``, ``end`` (bytes), ``doc`` (row in the chunk), ``hash``; ``first[d]`` is
    the first word of row d (one more entry at the end)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = SPACES):
        n = len(data)
        gap = np.ones(n + 1, bool)
        gap[:n] = breaks[data]
        begins = np.empty(n, bool)
        stops = np.empty(n, bool)
        inner = ~gap[:n]
        if n:
            begins[0] = inner[0]
            begins[1:] = inner[1:] & gap[:n - 1]
            stops[:] = inner & gap[1:]
            edge = offsets[1:-1]
            edge = edge[(edge > 0) & (edge < n)]
            begins[edge] |= inner[edge]
            stops[edge - 1] |= inner[edge - 1]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.doc = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = span_hash(data, self.start, self.end)

    def grams(self, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, row and first word of each run of k words within a document. With ``short``, a document of fewer words
        (at least one) has its whole sequence as its only run."""
        n = len(self.hash)
        rolled = np.zeros(n, np.uint64)
        count = np.diff(self.first)
        size = np.minimum(k, count)[self.doc] if n else np.zeros(0, np.int64)
        for j in range(min(k, int(count.max(initial=0)))):
            at = np.arange(n) + j
            live = j < size
            at = np.minimum(at, n - 1)
            rolled = np.where(live, mix(rolled * np.uint64(BASE) + self.hash[at] + np.uint64(j + 1)), rolled)
        left = self.first[self.doc + 1] - np.arange(n)
        keep = left >= k
        if short:
            keep |= (count[self.doc] < k) & (np.arange(n) == self.first[self.doc])
        return rolled[keep], self.doc[keep], np.flatnonzero(keep)


def distinct_by(group: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (group, value) pairs, sorted."""
    order = np.lexsort((value, group))
    g, v = group[order], value[order]
    if len(g):
        new = np.empty(len(g), bool)
        new[0] = True
        new[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
        g, v = g[new], v[new]
    return g, v


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(start, start + length)."""
    total = int(lengths.sum())
    base = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]) if len(lengths) else starts, lengths)
    return base + np.arange(total)
