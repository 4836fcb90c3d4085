"""Operator 1: passages that repeat across documents, by chaining shared k-mer seeds.

1. Seeds are runs of ``k`` words (A-Z as a-z), one out of every ``window`` in a row: the one with the smallest hash, so equal
   stretches of window + k - 1 words give equal seeds. A seed that occurs in several rows is joined with its first occurrence in
   the smallest doc_id only: as many rows as occurrences, however common it is. The smallest doc_id is thus the source that
   later copies of a passage point to.
2. The matches of a document with one source are merged into fragments of equal diagonal, and the fragments chained in order
   of both texts. A chain gains the words of its fragments and pays for the words skipped in either text. The best
   predecessor of a fragment is a prefix maximum in a Fenwick tree over the places in the source.
3. Chains long enough are aligned word by word: along diagonals within and between fragments and outwards from the ends as
   long as matches outweigh differences, and by dynamic programming where a gap changes the diagonal. What has at least
   ``min_words`` words in the document and ``similarity`` equal words (of the longer side) is a passage; a chain that falls
   short is cut at its widest gap, and each part tried.
4. The seeds of one passage may have their smallest doc_ids in different documents, none of which has the whole passage.
   Stretches of repeated seeds that no passage of step 3 covers are therefore joined a second time, by pairs of seeds: every two
   seeds at most ``PAIRED`` of ``min_words`` apart that point to different sources (or far apart in one), whatever stands between them. Such a
   pair again has its own smallest doc_id, a document that has both parts together, and is a match of both its seeds.

Defined results: null and empty texts, and texts of fewer than k words, have no passages. Rows without doc_id take no part.
Rows of equal doc_id are not compared with each other; each is compared with others on its own (equal rows count once). A
text that repeats itself is not reported for that. Ties between sources go to the smallest doc_id. Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BASE, CHUNK_BYTES, LOWER, Words, map_arrow, mix, table, utf8
from .common import stored as written

K, WINDOW, MIN_WORDS, SIMILARITY = 5, 8, 50, 0.8
SALTS = 8  # tasks that the occurrences of one seed are dealt to
PAIRED = 0.8
SEEDS = 20_000
SKIP = 0.1  # price of a word skipped in either text
EDGE = 8  # how far an extension may fall below its best
NEAR = 96
TRIMMED = 0.7  # share of min_words that a passage whose ends were trimmed has left
STEP = 128  # words that an extension looks at at a time
FARTHER = 24  # words beyond that at either end, where a passage would else be too short
BLOCK = 1 << 14  # words of a gap in one text that are compared at a time
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str) -> DataFrame:
    """A written step, whose shuffle files are removed with its end: the steps' shuffles together are several times the input."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return written(df, name)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def seeds_of(words: Words, k: int, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, row and first word (within its row) of the seeds of a chunk: the smallest of each ``window`` runs in a row."""
    hashed, doc, at = words.grams(k, short=False)
    n = len(hashed)
    if n == 0:
        return hashed, doc, at
    # smallest of the runs i .. i + window - 1 that are of the same row
    count = np.bincount(doc, minlength=len(words.first) - 1)
    last = np.cumsum(count)[doc] - 1
    best = np.arange(n)
    step = 1
    while step < window:
        width = min(step, window - step)
        other = best[np.minimum(np.arange(n) + width, last)]
        best = np.where(hashed[other] < hashed[best], other, best)
        step += width
    whole = (last - np.arange(n) >= window - 1) | (np.arange(n) == np.cumsum(count)[doc] - count[doc])
    chosen = np.unique(best[whole])
    return hashed[chosen], doc[chosen], at[chosen] - words.first[doc[chosen]]


def seed_rows(docs: DataFrame, k: int, window: int) -> DataFrame:
    """h, doc, place (row mark in the upper, first word in the lower half)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch.column(2))
        h, row, at = seeds_of(Words(LOWER[data], offsets), k, window)
        ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(ids[row]), pa.array((marks[row] << 32) | at)], ["h", "doc", "place"])

    return map_arrow(docs.select("doc", "mark", "text"), run, "h long, doc long, place long")


class Fenwick:
    """Prefix maxima: ``put`` raises a place, ``best`` gives the largest (value, number) at places below ``end``."""

    def __init__(self, n: int):
        self.tree = [(-1e18, -1)] * (n + 1)

    def put(self, place: int, value: float, number: int) -> None:
        place += 1
        while place < len(self.tree):
            if self.tree[place][0] < value:
                self.tree[place] = (value, number)
            place += place & -place

    def best(self, end: int) -> tuple[float, int]:
        out = (-1e18, -1)
        while end > 0:
            if self.tree[end][0] > out[0]:
                out = self.tree[end]
            end -= end & -end
        return out


def fragments(b: np.ndarray, a: np.ndarray, k: int, reach: int) -> list[tuple[int, int, int, int]]:
    """(start, source start, length, words gained): matches of one diagonal with at most ``reach`` words between them, merged."""
    order = np.lexsort((b, b - a))
    b, a = b[order], a[order]
    new = np.ones(len(b), bool)
    new[1:] = (np.diff(b - a) != 0) | (np.diff(b) > reach)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(b)) - 1
    length = b[last] - b[first] + k
    covered = np.minimum(np.diff(b, append=b[-1:] + k), k)
    covered[last] = k
    gain = np.add.reduceat(covered, first)
    out = sorted(zip(b[first].tolist(), a[first].tolist(), length.tolist(), gain.tolist(), strict=True))
    return out


def chains(parts: list[tuple[int, int, int, int]]) -> list[list[int]]:
    """The fragments' best chains, each fragment in one chain at most; numbers of fragments in order."""
    n = len(parts)
    places = sorted({p[1] + p[2] for p in parts})
    tree = Fenwick(len(places))
    score, before = [0.0] * n, [-1] * n
    events = sorted([(p[0], 1, i) for i, p in enumerate(parts)] + [(p[0] + p[2], 0, i) for i, p in enumerate(parts)])
    for _, opens, i in events:
        b, a, length, gain = parts[i]
        if opens:
            value, j = tree.best(bisect_left(places, a + 1))
            score[i] = gain
            if j >= 0 and (joined := value - SKIP * (a + b)) > 0:
                score[i], before[i] = gain + joined, j
        else:
            tree.put(bisect_left(places, a + length), score[i] + SKIP * (a + b + 2 * length), i)
    used = [False] * n
    out = []
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = before[i]
        if chain:
            out.append(chain[::-1])
    return out


def extend(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """How many words further, and how many of them equal, while matches outweigh differences."""
    n = min(len(x), len(y))
    total, at, gained, best, equal_best = 0, 0, 0, 0, 0
    while at < n:
        same = x[at:min(at + STEP, n)] == y[at:min(at + STEP, n)]
        run = total + np.cumsum(np.where(same, 1, -2))
        top = np.maximum.accumulate(np.maximum(run, gained))
        drop = np.flatnonzero(top - run > EDGE)
        stop = int(drop[0]) + 1 if len(drop) else len(run)
        if stop and run[:stop].max() > gained:
            where = int(run[:stop].argmax())
            gained, best = int(run[where]), at + where + 1
        if len(drop):
            break
        total = int(run[-1])
        at += STEP
    equal_best = int((x[:best] == y[:best]).sum())
    return best, equal_best


def extend_near(x: list[int], y: list[int], b: int, a: int, step: int) -> tuple[int, int] | None:
    """The same from these places on (``step`` -1: before them), if it ends within NEAR words: most do, and need no arrays."""
    n = min(len(x) - b, len(y) - a) if step > 0 else min(a, b)
    if step < 0:
        b, a = b - 1, a - 1
    total = gained = best = equal = equal_best = 0
    for i in range(min(n, NEAR)):
        if x[b + step * i] == y[a + step * i]:
            total, equal = total + 1, equal + 1
            if total > gained:
                gained, best, equal_best = total, i + 1, equal
        else:
            total -= 2
            if gained - total > EDGE:
                return best, equal_best
    return (best, equal_best) if n <= NEAR else None


def common_words(x: np.ndarray, y: np.ndarray) -> int:
    """Length of the longest common subsequence: a row of the dynamic programme is the bits of one number. A block of ``y``
    hands the carry of each row to the next block."""
    total, carry, rows = 0, [0] * len(x), x.tolist()
    for lo in range(0, len(y), BLOCK):
        where: dict[int, int] = {}
        part = y[lo:lo + BLOCK].tolist()
        for i, word in enumerate(part):
            where[word] = where.get(word, 0) | 1 << i
        width, v, out = len(part), (1 << len(part)) - 1, []
        full = v
        for word, c in zip(rows, carry, strict=True):
            hit = v & where.get(word, 0)
            up = v + hit + c
            out.append(up >> width)
            v = (up & full) | (v - hit)
        total += width - v.bit_count()
        carry = out
    return total


def farther(x: list[int], y: list[int], b: int, a: int, step: int) -> list[tuple[int, int]]:
    """How many words further on (or back) an equal word stands with at least half of the words up to it equal, and how many are."""
    n = min(len(x) - b, len(y) - a) if step > 0 else min(a, b)
    if step < 0:
        b, a = b - 1, a - 1
    out, equal = [(0, 0)], 0
    for i in range(min(n, FARTHER)):
        if x[b + step * i] == y[a + step * i]:
            equal += 1
            if 2 * equal > i:
                out.append((i + 1, equal))
    return out


def lengthened(b0: int, bp: int, a0: int, ap: int, equal: int, x: list[int], y: list[int], similarity: float) -> tuple[int, int, int, int, int]:
    """The longest extension at both ends that keeps ``similarity``: for a passage whose ends the score has trimmed."""
    size, best = max(bp - b0, ap - a0), (0, 0, 0, equal)
    right = farther(x, y, bp, ap, 1)
    for left, less in farther(x, y, b0, a0, -1):
        for on, more in right:
            if left + on > best[0] and equal + less + more >= similarity * (size + left + on):
                best = (left + on, left, on, equal + less + more)
    _, left, on, equal = best
    return b0 - left, bp + on, a0 - left, ap + on, equal


def beside(x: np.ndarray, y: np.ndarray, b: int, a: int, n: int) -> int:
    """Equal words among the ``n`` from these places on (before them, where n is negative), side by side."""
    if n < 0:
        n = min(-n, a, b)
        b, a = b - n, a - n
    n = min(n, len(x) - b, len(y) - a)
    return int(np.count_nonzero(x[b:b + n] == y[a:a + n])) if n > 0 else 0


def passages(b: np.ndarray, a: np.ndarray, x: np.ndarray, y: np.ndarray, k: int, reach: int, min_words: int, similarity: float) -> list[tuple[int, int, int, int, float]]:
    """(start, end, source start, source end, similarity) in words, from matches (b, a) and word hashes of both texts."""
    parts, xs, ys = fragments(b, a, k, reach), x.tolist(), y.tolist()
    # a passage has 0.8 * min_words equal words in and beside its chain, or goes on beyond min_words words of one side, of which
    # more than 0.6 are equal: matches that outweigh differences but for EDGE
    least = min(similarity * min_words, (2 * min_words - EDGE) / 3)
    out: list[tuple[int, int, int, int, float]] = []
    todo = chains(parts)
    while todo:
        chain = todo.pop()
        b0, a0 = parts[chain[0]][:2]
        fb, fa, length, _ = parts[chain[-1]]
        gaps = [max(parts[j][0] - parts[i][0] - parts[i][2], parts[j][1] - parts[i][1] - parts[i][2]) for i, j in zip(chain, chain[1:], strict=False)]
        if min(fb + length - b0, fa + length - a0) + beside(x, y, b0, a0, -min_words) + beside(x, y, fb + length, fa + length, min_words) < least:
            if gaps:
                cut = gaps.index(max(gaps)) + 1
                todo += [chain[:cut], chain[cut:]]
            continue
        equal, bp, ap = 0, b0, a0
        for i in chain:
            fb, fa, length, _ = parts[i]
            if fb - bp == fa - ap:
                equal += int((x[bp:fb] == y[ap:fa]).sum())
            else:
                equal += common_words(x[bp:fb], y[ap:fa])
            equal += int((x[fb:fb + length] == y[fa:fa + length]).sum())
            bp, ap = fb + length, fa + length
        more, same = extend_near(xs, ys, bp, ap, 1) or extend(x[bp:], y[ap:])
        bp, ap, equal = bp + more, ap + more, equal + same
        more, same = extend_near(xs, ys, b0, a0, -1) or extend(x[:b0][::-1], y[:a0][::-1])
        b0, a0, equal = b0 - more, a0 - more, equal + same
        if TRIMMED * min_words <= bp - b0 < min_words:
            b0, bp, a0, ap, equal = lengthened(b0, bp, a0, ap, equal, xs, ys, similarity)
        if bp - b0 >= min_words and equal >= similarity * max(bp - b0, ap - a0):
            out.append((b0, bp, a0, ap, equal / max(bp - b0, ap - a0)))
        elif gaps:  # two passages may have been joined: try both sides of the widest gap
            cut = gaps.index(max(gaps)) + 1
            todo += [chain[:cut], chain[cut:]]
    kept: list[tuple[int, int, int, int, float]] = []
    for p in sorted(out, key=lambda p: (p[0] - p[1], p)):  # of passages that overlap in the document, the longest
        if all(p[1] <= q[0] or p[0] >= q[1] for q in kept):
            kept.append(p)
    return sorted(kept)


COLUMNS = "doc_id long, source_id long, start long, end long, source_start long, source_end long, n_words int, similarity double"
PLACES = ", mark int, b0 int, b1 int"  # the row of the document, and the passage in words


def repeated_passages(docs: DataFrame, k: int = K, window: int = WINDOW, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """A row for each passage of a document that an earlier document (smaller doc_id) has: doc_id, source_id, places in both
    texts (characters), number of words, similarity."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), (F.xxhash64(text).bitwiseAND(0x7FFFFFFF)).cast("int").alias("mark"), text.alias("text")) \
        .filter("doc is not null and text is not null")
    # each seed with the smallest document that has it; shuffled once, and no seed is written that one document alone has
    seeds = with_first(seed_rows(rows, k, window), ["h"], "doc", "place").withColumn("last", F.max("doc").over(Window.partitionBy("h")))
    linked = stored(seeds.filter("first.doc < last").select("doc", "place", F.col("first.doc").alias("source"), F.col("first.place").alias("source_place")), "linked")
    span = F.max("b") - F.min("b") + k >= (min_words - 2 * (window + k)) // 2 + k
    pairs = stored(by_pair(linked, span.alias("wide"), F.count("*").alias("n")).filter("wide and n > 1").drop("wide", "n"), "pairs")
    # only shared k-mers within two windows of each other make one fragment
    reach = 2 * window + k
    found = stored(aligned(pairs, rows, k, reach, min_words, similarity), "found")

    # seeds of an earlier document in stretches that no passage covers, and all occurrences of those seeds
    spans = found.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("b0", "b1")).alias("spans")) \
        .select(F.col("doc_id").alias("doc"), "mark", F.col("spans.b0").alias("from"), F.col("spans.b1").alias("to"))
    earlier = linked.filter("doc > source").groupBy("doc", mark("place").alias("mark")) \
        .agg(F.collect_list(F.struct(word("place").alias("b"), "source", "source_place")).alias("m"))
    asked = stored(map_arrow(earlier.join(spans, ["doc", "mark"], "left").select("doc", "mark", "m.b", "m.source", "m.source_place", "from", "to"),
                             lambda batch: open_seeds(batch, k, 2 * reach, min_words, window), "doc long, mark int, source long, source_place long"), "asked")
    # a seed may stand in very many documents: its occurrences are dealt over SALTS tasks
    salted = asked.select("source", "source_place").distinct().withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    places = linked.withColumn("salt", F.pmod(F.xxhash64("doc", "place"), F.lit(SALTS)).cast("int")).join(salted, ["source", "source_place", "salt"], "left_semi") \
        .groupBy("doc", mark("place").alias("mark")).agg(F.collect_list(F.struct(word("place").alias("b"), "source", "source_place")).alias("m"))
    asks = asked.select("doc", "mark").distinct().withColumn("asks", F.lit(True))
    places = stored(places.join(asks, ["doc", "mark"], "left").select("doc", "mark", "m.b", "m.source", "m.source_place", F.coalesce("asks", F.lit(False)).alias("asks")), "places")
    # a seed goes to its task as one row with the list of its pairs; lists of copies shrink to little in the shuffle and are long
    # behind it, so the number of tasks is fixed and not drawn from their bytes
    couples = places.mapInArrow(lambda batches: all_seed_pairs(batches, reach, int(PAIRED * min_words)), "seed long, doc long, place long, asks boolean, hs array<long>, gaps array<int>")
    couples = couples.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "seed") \
        .select("seed", "doc", "place", "asks", F.inline(F.arrays_zip(F.col("hs").alias("h"), F.col("gaps").alias("gap"))))
    met = with_first(couples, ["seed", "h"], "doc", "place", "gap").filter("asks and doc > first.doc") \
        .select("doc", "place", "gap", F.col("first.doc").alias("source"), F.col("first.place").alias("source_place"), F.col("first.gap").alias("source_gap"))
    ends = F.inline(F.array(F.struct("place", "source_place"), F.struct((F.col("place") + F.col("gap")).alias("place"), (F.col("source_place") + F.col("source_gap")).alias("source_place"))))
    again = met.select("doc", "source", ends).distinct()
    more = stored(aligned(stored(by_pair(again, span.alias("wide")).filter("wide").drop("wide"), "pairs"), rows, k, reach, min_words, similarity), "more")
    # of these, none that lies in another one or in a passage found before; equal ones by the smallest source
    listed = found.withColumn("old", F.lit(True)).unionByName(more.withColumn("old", F.lit(False))).groupBy("doc_id", "mark") \
        .agg(F.collect_list(F.struct("old", "source_id", "b0", "b1")).alias("all"))
    col = F.col
    around = lambda p: (p["b0"] <= col("b0")) & (p["b1"] >= col("b1")) & (p["old"] | (p["b1"] - p["b0"] > col("b1") - col("b0")) | (p["source_id"] < col("source_id")))
    again_found = lambda p: p["old"] & (p["source_id"] == col("source_id")) & (p["b0"] < col("b1")) & (p["b1"] > col("b0"))
    new = more.join(listed, ["doc_id", "mark"]).filter(~F.exists("all", lambda p: around(p) | again_found(p)))
    names = [c.split()[0] for c in COLUMNS.split(", ")]
    return found.select(names).unionByName(new.select(names))


def word(place: str) -> Column:
    return F.col(place).bitwiseAND(0xFFFFFFFF).cast("int")


def mark(place: str) -> Column:
    return F.shiftright(place, 32).cast("int")


def with_first(rows: DataFrame, keys: list[str], *place: str) -> DataFrame:
    """The rows, with the smallest place of all rows of equal keys as ``first``."""
    return rows.withColumn("first", F.min(F.struct(*place)).over(Window.partitionBy(*keys)))


def by_pair(linked: DataFrame, *more: Column) -> DataFrame:
    """doc, mark, source, source_mark and the list m of common places (b, a)."""
    hits = linked.filter("doc > source") \
        .select("doc", "source", mark("place").alias("mark"), mark("source_place").alias("source_mark"), word("place").alias("b"), word("source_place").alias("a"))
    return hits.groupBy("doc", "mark", "source", "source_mark").agg(F.collect_list(F.struct("b", "a")).alias("m"), *more)


def aligned(pairs: DataFrame, rows: DataFrame, k: int, reach: int, min_words: int, similarity: float) -> DataFrame:
    """The passages of pairs."""
    ends = pairs.select("doc", "mark").unionByName(pairs.select(F.col("source").alias("doc"), F.col("source_mark").alias("mark"))).distinct()
    bodies = stored(rows.join(ends, ["doc", "mark"], "left_semi").dropDuplicates(["doc", "mark"]), "bodies")
    sources = bodies.select(F.col("doc").alias("source"), F.col("mark").alias("source_mark"), F.col("text").alias("source_text"))
    both = pairs.join(bodies, ["doc", "mark"]).join(sources, ["source", "source_mark"]) \
        .select("doc", "source", F.col("m.b").alias("b"), F.col("m.a").alias("a"), "text", "source_text", "mark")
    return both.mapInArrow(lambda batches: align_all(batches, k, reach, min_words, similarity), COLUMNS + PLACES)


def stretches(b: np.ndarray, k: int, reach: int, span: int) -> list[tuple[int, int]]:
    """First and last seed (places in the sorted ``b``) of each stretch of seeds at most ``reach`` apart that is ``span`` words long."""
    cut = np.flatnonzero(np.diff(b) > reach)
    first, last = np.append(0, cut + 1), np.append(cut, len(b) - 1)
    return [(i, j) for i, j in zip(first.tolist(), last.tolist(), strict=True) if b[j] - b[i] + k >= span]


def open_seeds(batch: pa.RecordBatch, k: int, reach: int, min_words: int, window: int) -> pa.RecordBatch | None:
    """The seeds of stretches that may be part of a passage and are not within one."""
    out: list[tuple] = []
    columns = [(np.asarray(c.values), np.asarray(c.offsets)) for c in (batch.column(i) for i in (2, 3, 4))]
    ids, marks, starts, ends = (batch.column(i).to_pylist() for i in (0, 1, 5, 6))
    for r in range(batch.num_rows):
        b, source, place = (v[o[r]:o[r + 1]] for v, o in columns)
        order = np.argsort(b, kind="stable")
        b, source, place = b[order], source[order], place[order]
        free = np.ones(len(b), bool)
        for lo, hi in zip(starts[r] or [], ends[r] or [], strict=True):
            free &= (b < lo) | (b + k > hi)
        if not free.any():
            continue
        # what is covered counts as far as a passage of min_words words can reach into it
        at = b[free]
        right = np.searchsorted(at, b)
        near = np.minimum(np.abs(b - at[np.minimum(right, len(at) - 1)]), np.abs(b - at[np.maximum(right - 1, 0)])) <= min_words
        b, source, place, free = b[near], source[near], place[near], free[near]
        for i, j in stretches(b, k, reach, min_words - 2 * (window + k)):
            if free[i:j + 1].any():
                out += zip([ids[r]] * (j + 1 - i), [marks[r]] * (j + 1 - i), source[i:j + 1].tolist(), place[i:j + 1].tolist(), strict=True)
    if not out:
        return None
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["doc", "mark", "source", "source_place"])


def all_seed_pairs(batches: Iterator[pa.RecordBatch], reach: int, most: int) -> Iterator[pa.RecordBatch]:
    """``seed_pairs`` of rows with about SEEDS seeds at a time, so that memory does not depend on the size of a batch."""
    for batch in batches:
        offsets, lo = np.asarray(batch.column(2).offsets), 0
        while lo < batch.num_rows:
            hi = max(int(np.searchsorted(offsets, offsets[lo] + SEEDS, "right")) - 1, lo + 1)
            out = seed_pairs(batch.slice(lo, hi - lo), reach, most)
            if out is not None:
                yield out
            lo = hi


def seed_pairs(batch: pa.RecordBatch, reach: int, most: int) -> pa.RecordBatch | None:
    """Every two seeds of a row, at most ``most`` words apart, that point to different sources or, by more than ``reach``, to
    different places of one: seed, doc, place and asks of the first, with the lists of hashes of the pairs and of gaps."""
    (b, offsets), (source, _), (place, _) = ((np.asarray(c.values).astype(np.int64), np.asarray(c.offsets)) for c in (batch.column(i) for i in (2, 3, 4)))
    row = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
    b, source, place = (v[offsets[0]:offsets[-1]] for v in (b, source, place))
    order = np.lexsort((b, row))
    b, source, place, row = b[order], source[order], place[order], row[order]
    apart = b - (place & 0xFFFFFFFF)
    one = mix(source.astype(np.uint64) * np.uint64(BASE) + place.astype(np.uint64))
    left, right, step = [], [], 1
    while step < len(b):
        near = (row[step:] == row[:-step]) & (b[step:] - b[:-step] <= most)
        if not near.any():
            break
        i = np.flatnonzero(near & ((source[step:] != source[:-step]) | (np.abs(apart[step:] - apart[:-step]) > reach)))
        left.append(i)
        right.append(i + step)
        step += 1
    if not left or not sum(map(len, left)):
        return None
    i, j = np.concatenate(left), np.concatenate(right)
    order = np.argsort(i, kind="stable")
    i, j = i[order], j[order]
    h = mix(one[i] * np.uint64(BASE) + one[j])
    ids, marks = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64)
    asks = batch.column(5).to_numpy(zero_copy_only=False)
    left, count = np.unique(i, return_counts=True)
    ends = pa.array(np.append(0, np.cumsum(count)), pa.int32())
    return pa.RecordBatch.from_arrays([pa.array(one[left].view(np.int64)), pa.array(ids[row[left]]), pa.array((marks[row[left]] << 32) | b[left]), pa.array(asks[row[left]]),
                                       pa.ListArray.from_arrays(ends, pa.array(h.view(np.int64))), pa.ListArray.from_arrays(ends, pa.array(b[j] - b[i], pa.int32()))],
                                      ["seed", "doc", "place", "asks", "hs", "gaps"])


def align_all(batches: Iterator[pa.RecordBatch], k: int, reach: int, min_words: int, similarity: float) -> Iterator[pa.RecordBatch]:
    """``align_batch`` of rows with about CHUNK_BYTES of both texts at a time: the sources of short texts may be long ones."""
    for batch in batches:
        ends, lo = utf8(batch.column(4))[1] + utf8(batch.column(5))[1], 0
        while lo < batch.num_rows:
            hi = max(int(np.searchsorted(ends, ends[lo] + CHUNK_BYTES, "right")) - 1, lo + 1)
            out = align_batch(batch.slice(lo, hi - lo), k, reach, min_words, similarity)
            if out is not None:
                yield out
            lo = hi


def align_batch(batch: pa.RecordBatch, k: int, reach: int, min_words: int, similarity: float) -> pa.RecordBatch | None:
    out = []
    sides = []
    for c in (4, 5):
        data, offsets = utf8(batch.column(c))
        words = Words(LOWER[data], offsets)
        sides.append((words, offsets, np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])))
    (wx, ox, cx), (wy, oy, cy) = sides
    lists = [(np.asarray(col.values), np.asarray(col.offsets)) for col in (batch.column(2), batch.column(3))]
    ids, sources, marks = (batch.column(i).to_pylist() for i in (0, 1, 6))
    for r in range(batch.num_rows):
        b, a = (v[o[r]:o[r + 1]].astype(np.int64) for v, o in lists)
        x0, y0 = wx.first[r], wy.first[r]
        x, y = wx.hash[x0:wx.first[r + 1]], wy.hash[y0:wy.first[r + 1]]
        if len(x) == len(y) and (x == y).all():  # copies need no chain
            spans = [(0, len(x), 0, len(y), 1.0)] if len(x) >= min_words else []
        else:
            spans = passages(b, a, x, y, k, reach, min_words, similarity)
        for b0, b1, a0, a1, similar in spans:
            out.append((ids[r], sources[r], cx[wx.start[x0 + b0]] - cx[ox[r]], cx[wx.end[x0 + b1 - 1]] - cx[ox[r]],
                        cy[wy.start[y0 + a0]] - cy[oy[r]], cy[wy.end[y0 + a1 - 1]] - cy[oy[r]], b1 - b0, similar, marks[r], b0, b1))
    if not out:
        return None
    kinds = [pa.int64()] * 6 + [pa.int32(), pa.float64()] + [pa.int32()] * 3
    return pa.RecordBatch.from_arrays([pa.array([int(v) if kind != pa.float64() else float(v) for v in col], kind) for col, kind in zip(zip(*out, strict=True), kinds, strict=True)],
                                      [c.split()[0] for c in (COLUMNS + PLACES).split(", ")])


def op1_passages(spark: SparkSession, root: str) -> DataFrame:
    return repeated_passages(table(spark, root, "documents"))
