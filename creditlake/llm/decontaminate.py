"""Operator 9: benchmark passages in documents, by the q-gram lemma and banded alignment.

Texts are compared with A-Z (and accented Latin capitals) as small letters and runs of white space as one blank. A place within k edits of an item of m bytes shares at
least m - q + 1 - k * q of the item's q-grams with it, all on diagonals (text position less item position) that lie within
k of each other. Diagonals are dealt to overlapping bands of 2 * (k + 1), one starting every k + 1, so some band holds all of
them. Where many items share wording, that wording alone may reach the bound; so the same lemma is asked again with grams of ``FINE``
bytes over the whole band, which spoil less. Bands that reach both bounds are aligned with the item in a band of the dynamic programme; what is within k edits is
a match. k is a tenth of the item's length, or less where the bound would fall below one q-gram.

The items are an index of hashed q-grams sent to every task. Its size is checked: items beyond ``index_bytes`` of text are
dealt into groups of about that size, and each group passes over the documents in turn, with the same results.

Defined results: null, empty or blank items and documents match nothing. Items shorter than q match as whole words only,
without edits. Each matching place gives one row (of overlapping ones of the same item the one with the fewest edits, then
the leftmost). Repeated documents or items each give their rows; a null doc_id or item_id stays null. Extra columns are
ignored. No items or no documents: no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, SPACES, map_arrow, mix, ranges, table, utf8

Q = 8
ERROR = 0.1
FINE = 4
INDEX_BYTES = 16 << 20
ENTRIES = 2_000_000  # pairs of a q-gram of a text and one of an item that are looked at at a time
FOLD = np.where(SPACES, np.uint8(32), LOWER)


def normal(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, where each text begins in them, and the original place of each byte."""
    folded = FOLD[data]
    if len(data):
        accented = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)) + 1
        folded[accented] += 32
    blank = folded == 32
    keep = np.ones(len(data), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[offsets[:-1][offsets[:-1] < len(data)]] = True
    place = np.flatnonzero(keep)
    return folded[place], np.searchsorted(place, offsets), place


def gram_hashes(data: np.ndarray, q: int = Q) -> np.ndarray:
    """A hash of the q bytes from each place on (q up to 8: the bytes themselves, scrambled)."""
    n = len(data) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(q):
        out = (out << np.uint64(8)) | data[j:j + n]
    return mix(out)


@dataclass
class Index:
    ids: list
    data: np.ndarray  # folded items, one after another, without blanks at their ends
    at: np.ndarray
    edits: np.ndarray
    bound: np.ndarray
    grams: np.ndarray  # distinct hashes, sorted
    first: np.ndarray  # where the entries of each begin (with the end at last)
    item: np.ndarray
    place: np.ndarray
    key: np.ndarray  # gram and item of each entry, as one number, ascending
    fine: np.ndarray  # codes of FINE bytes from each place of ``data`` on
    seen: np.ndarray  # one flag for each value of the top bits of a hash
    shift: int


def build_index(ids: list, texts: list[str | None], q: int = Q, error: float = ERROR) -> Index:
    raw = [(t or "").encode() for t in texts]
    data, at, _ = normal(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64))
    whole = [data[a:b].tobytes().strip() for a, b in zip(at, at[1:], strict=False)]
    data = np.frombuffer(b"".join(whole), np.uint8)
    size = np.array([len(w) for w in whole], np.int64)
    at = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    edits = np.maximum(np.minimum((size * error).astype(np.int64), (size - q) // q), 0)
    bound = size - q + 1 - edits * q
    hashes = gram_hashes(data, q)
    owner = np.repeat(np.arange(len(size)), size)
    inner = np.flatnonzero(at[owner[:len(hashes)] + 1] - np.arange(len(hashes)) >= q)
    hashes, item, place = hashes[inner], owner[inner], inner - at[owner[inner]]
    order = np.argsort(hashes, kind="stable")  # items ascend within a gram
    grams, first = np.unique(hashes[order], return_index=True)
    bits = min(max(int(len(grams)).bit_length() + 6, 16), 26)
    seen = np.zeros(1 << bits, bool)
    seen[(grams >> np.uint64(64 - bits)).astype(np.int64)] = True
    first = np.append(first, len(order))
    key = np.repeat(np.arange(len(grams)), np.diff(first)) * np.int64(len(size)) + item[order]
    return Index(ids, data, at, edits, bound, grams, first, item[order], place[order], key, fine_codes(data), seen, 64 - bits)


def fine_codes(data: np.ndarray) -> np.ndarray:
    """16 bits of each FINE bytes. Different grams may share a code, which only lets more pass."""
    return (gram_hashes(data, FINE) >> np.uint64(48)).astype(np.int64)


def reaches(index: Index, codes: np.ndarray, items: list[int], spans: list[tuple[int, int]]) -> np.ndarray:
    """Whether enough of each item's fine grams stand in its stretch of the text."""
    there, out = np.zeros(1 << 16, bool), np.zeros(len(items), bool)
    before: tuple[int, int] = (0, 0)
    for g, (i, span) in enumerate(zip(items, spans, strict=True)):
        if span != before:
            there[codes[before[0]:before[1]]] = False
            there[codes[span[0]:span[1]]] = True
            before = span
        a, b = int(index.at[i]), int(index.at[i + 1]) - FINE + 1
        out[g] = b <= a or there[index.fine[a:b]].sum() >= b - a - FINE * int(index.edits[i])
    return out


def candidates(index: Index, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, item and first diagonal of every band that reaches its item's bound (diagonals count from the row's start)."""
    hashes = gram_hashes(data)
    hit = np.flatnonzero(index.seen[(hashes >> np.uint64(index.shift)).astype(np.int64)]) if len(index.grams) else np.zeros(0, np.int64)
    gram = np.minimum(np.searchsorted(index.grams, hashes[hit]), max(len(index.grams) - 1, 0))
    exact = index.grams[gram] == hashes[hit] if len(hit) else np.zeros(0, bool)
    hit, gram = hit[exact], gram[exact]
    row = np.searchsorted(at, hit, "right") - 1
    inner = hit + Q <= at[row + 1]
    hit, gram, row = hit[inner], gram[inner], row[inner]
    # rows after rows, or within a row with very many, items after items: the work of each part is bounded
    many = index.first[gram + 1] - index.first[gram]
    total = np.cumsum(np.bincount(row, many, len(at) - 1)).astype(np.int64)
    parts, lo = [], 0
    while lo < len(at) - 1:
        hi = max(int(np.searchsorted(total, (total[lo - 1] if lo else 0) + ENTRIES, "right")), lo + 1)
        mine = slice(*np.searchsorted(row, [lo, hi]))
        pieces = int(many[mine].sum()) // ENTRIES + 1
        cuts = np.linspace(0, len(index.edits), pieces + 1).astype(np.int64)
        parts += [bands(index, at, hit[mine], gram[mine], row[mine], int(a), int(b)) for a, b in zip(cuts, cuts[1:], strict=False)]
        lo = hi
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *x]) for x in zip(*parts, strict=True)) if parts else (none, none, none)


def bands(index: Index, at: np.ndarray, hit: np.ndarray, gram: np.ndarray, row: np.ndarray, first_item: int, end_item: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bands of these hits for items from ``first_item`` to before ``end_item``."""
    n = np.int64(len(index.edits))
    first = np.searchsorted(index.key, gram * n + first_item)
    many = np.searchsorted(index.key, gram * n + end_item) - first
    entry = ranges(first, many)
    row = np.repeat(row, many)
    item, place = index.item[entry], index.place[entry]
    diagonal = np.repeat(hit, many) - at[row] - place
    step = index.edits[item] + 1
    band = diagonal // step
    # each hit counts in its band and in the one that began before it
    row, item, place = np.tile(row, 2), np.tile(item, 2), np.tile(place, 2)
    band = np.concatenate([band, band - 1])
    low = int(band.min(initial=0))
    key = (row * np.int64(len(index.edits)) + item) * np.int64(int(band.max(initial=0)) - low + 1) + (band - low)
    order = np.lexsort((place, key))
    key, place = key[order], place[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    new[1:] |= place[1:] != place[:-1]  # a q-gram of the item counts once
    counts = np.add.reduceat(new.astype(np.int64), starts) if len(starts) else starts
    picked = order[starts]
    picked = picked[counts >= index.bound[item[picked]]]
    return row[picked], item[picked], band[picked] * (index.edits[item[picked]] + 1)


def align(pattern: list[np.ndarray], text: list[np.ndarray], width: int, anchored: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits of each whole pattern within its text, and where that ends in the text. The pattern's row i meets the columns
    i to i + width - 1 of the text; ``anchored``: the match begins where the text does."""
    n = len(pattern)
    size = np.array([len(p) for p in pattern])
    longest = int(size.max(initial=0))
    p = np.full((n, longest), 258, np.int16)
    t = np.full((n, longest + width), 257, np.int16)
    stop = np.array([len(x) for x in text])
    for i in range(n):
        p[i, :size[i]] = pattern[i]
        t[i, :min(stop[i], longest + width)] = text[i][:longest + width]
    columns = np.arange(width)
    big = np.int32(1 << 20)
    cost = np.tile(columns if anchored else 0 * columns, (n, 1)).astype(np.int32)
    cost = np.where(columns[None, :] <= stop[:, None], cost, big)
    best, end = np.full(n, big, np.int32), np.zeros(n, np.int64)
    for i in range(longest + 1):
        done = size == i
        if done.any():
            at = cost[done].argmin(1)
            best[done], end[done] = cost[done, at], i + at
        if i == longest:
            break
        # column c of row i is the text before place i + c
        stay = cost + (t[:, i:i + width] != p[:, i:i + 1])
        up = np.concatenate([cost[:, 1:] + 1, np.full((n, 1), big, np.int32)], 1)
        cost = np.minimum(stay, up)
        cost = np.minimum.accumulate(cost - columns, 1) + columns
        cost = np.where(i + 1 + columns[None, :] <= stop[:, None], cost, big).astype(np.int32)
    return best, end


def matches(index: Index, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, item, start, end, edits) of all matches; places are bytes of the original chunk."""
    folded, at, place = normal(data, offsets)
    found: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    row, item, diagonal = candidates(index, folded, at)
    if len(row):  # the band's stretch of the text: the item's length and its edits to either side of the diagonals
        size, k = index.at[item + 1] - index.at[item], index.edits[item]
        begin = np.maximum(diagonal - k, 0) + at[row]
        end = np.minimum(diagonal + size + 3 * k + 4, at[row + 1] - at[row]) + at[row] - FINE + 1
        order = np.lexsort((end, begin))
        keep = order[reaches(index, fine_codes(folded), item[order].tolist(), list(zip(begin[order].tolist(), np.maximum(end[order], begin[order]).tolist(), strict=True)))]
        keep.sort()
        row, item, diagonal = row[keep], item[keep], diagonal[keep]
    for lo in range(0, len(row), 256):
        rows, items, first = (x[lo:lo + 256].tolist() for x in (row, item, diagonal))
        k = index.edits[item[lo:lo + 256]].tolist()
        begin = [d - e for d, e in zip(first, k, strict=True)]  # below 0: that much of nothing stands before the text
        pattern = [index.data[index.at[i]:index.at[i + 1]] for i in items]
        width = 4 * max(k) + 4
        text = [np.concatenate([np.full(max(-b, 0), 256, np.int16), folded[at[r] + max(b, 0):min(at[r + 1], at[r] + b + len(p) + width)]])
                for r, b, p in zip(rows, begin, pattern, strict=True)]
        best, end = align(pattern, text, width)
        good = [g for g in range(len(rows)) if best[g] <= k[g]]
        if good:
            _, back = align([pattern[g][::-1] for g in good], [text[g][:end[g]][::-1] for g in good], 2 * max(k) + 2, anchored=True)
            for g, length in zip(good, back.tolist(), strict=True):
                stop = int(at[rows[g]] + begin[g] + end[g])
                found.setdefault((rows[g], items[g]), []).append((int(best[g]), max(stop - length, int(at[rows[g]])), stop))
    short = [i for i in range(len(index.edits)) if 0 < index.at[i + 1] - index.at[i] < Q]
    if short:
        for r in range(len(at) - 1):
            body = b" " + folded[at[r]:at[r + 1]].tobytes() + b" "
            for i in short:
                word = b" " + index.data[index.at[i]:index.at[i + 1]].tobytes() + b" "
                p = body.find(word)
                while p >= 0:
                    start = int(at[r]) + p
                    found.setdefault((r, i), []).append((0, start, start + len(word) - 2))
                    p = body.find(word, p + 1)
    out = []
    for (r, i), spans in found.items():
        taken: list[tuple[int, int]] = []
        for edits, a, b in sorted(spans):
            if all(b <= x or a >= y for x, y in taken):
                taken.append((a, b))
                out.append((r, i, int(place[a]), int(place[b - 1]) + 1, edits))
    return sorted(out)


def contaminated(docs: DataFrame, benchmark: DataFrame, error: float = ERROR, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """doc_id, item_id, start and end (characters of the text), edits and similarity (1 - edits / item length)."""
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text"))
    size = items.agg(F.sum(F.octet_length("text")).alias("n"), F.max(F.octet_length("text")).alias("most")).first()
    groups = max(1, -(-(size.n or 0) // index_bytes))
    dealt = items.withColumn("g", F.pmod(F.xxhash64("item_id", "text"), F.lit(groups)))
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    kinds = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    out = None
    for g in range(groups):
        own = dealt.filter(F.col("g") == g).select("item_id", "text").collect()  # about index_bytes of text
        part = find(rows, build_index([r.item_id for r in own], [r.text for r in own], error=error), *kinds)
        out = part if out is None else out.unionByName(part)
    return out


def find(rows: DataFrame, index: Index, doc_kind: str, item_kind: str) -> DataFrame:
    held = rows.sparkSession.sparkContext.broadcast(index)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        index = held.value
        data, offsets = utf8(batch.column(1))
        got = matches(index, data, offsets)
        if not got:
            return None
        r, i, a, b, edits = (np.array(x, np.int64) for x in zip(*got, strict=True))
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        base = chars[offsets[r]]
        similar = 1 - edits / np.maximum(index.at[i + 1] - index.at[i], 1)
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(r)), pa.array([index.ids[x] for x in i.tolist()]).cast(item_type),
                                           pa.array(chars[a] - base, pa.int64()), pa.array(chars[b] - base, pa.int64()), pa.array(edits, pa.int32()), pa.array(similar)],
                                          ["doc_id", "item_id", "start", "end", "edits", "similarity"])

    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import _parse_datatype_string

    item_type = to_arrow_type(_parse_datatype_string(item_kind))
    return map_arrow(rows, run, f"doc_id {doc_kind}, item_id {item_kind}, start long, end long, edits int, similarity double")


def op9_decontaminate(spark: SparkSession, root: str) -> DataFrame:
    return contaminated(table(spark, root, "documents"), table(spark, root, "benchmark"))
