"""Operator 13: alignment of two tokenizers over a corpus, and counts of the ids that end together.

Vocabulary A (byte-level BPE) reads a blank and the text; vocabulary B (pieces) puts that blank there itself. Byte offsets where
tokens of both end cut a document into groups; the last ids of a group are a link.

1. Neither vocabulary merges across a blank that follows a visible character, so texts are cut there, and each distinct stretch is
   encoded by both libraries and aligned once (``StretchAligner``); a document is put together from its stretches.
2. Fast path: an array made from the vocabularies alone gives for each A id the B id of the same bytes. A group of one A id and
   that B id is counted in a vector as long as vocabulary A, which each task hands on once. Only the links of other, irregular
   groups are pairs, counted per document before they are shuffled.
3. Links of a document look up their counts: regular ones in that vector, irregular ones of at least 1/``HOT`` of all irregular
   links (at most ``HOT`` pairs, so a bounded array) in the task; the others by a join on the pair, of which no pair then has
   more than that part of the rows.

Defined results: texts null or empty, or whose bytes are not given back by both vocabularies (a text with U+2581, which stands for
a blank in B), have no tokens: zeros and an empty digest. Strings of special tokens are plain text. Rows of equal or no doc_id give a
row each. Long texts are whole. No row gives no row. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cuts, ranges, stored, table, utf8
from .pieces import Grown, default_vocabulary, vocabulary
from .spans import SpanCache

HOT = 20_000
SLICE = 8192  # stretches that the libraries see at once
ROWS = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, row long, a array<int>, a_n array<int>, pair array<long>, pair_n array<int>"


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(2)
def byte_library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(path)
    coder.encode_special_tokens = True
    return coder


@lru_cache(2)
def piece_library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


@lru_cache(2)
def piece_bytes(path: str) -> list[bytes]:
    """The bytes of each B id; unknown and control ids have none."""
    sp, out = piece_library(path), []
    for i in range(sp.get_piece_size()):
        piece = sp.id_to_piece(i)
        out.append(b"" if sp.is_unknown(i) or sp.is_control(i) else bytes([int(piece[3:5], 16)]) if sp.is_byte(i) else piece.replace("▁", " ").encode())
    return out


@lru_cache(2)
def identity_map(a_path: str, b_path: str) -> np.ndarray:
    """For each A id the B id of the same bytes, -1 where there is none. A piece goes before a byte id."""
    sp, v, mine = piece_library(b_path), vocabulary(a_path), {}
    for i, raw in enumerate(piece_bytes(b_path)):
        if raw and (raw not in mine or not sp.is_byte(i)):
            mine[raw] = i
    raw = v.token_bytes.tobytes()
    return np.array([mine.get(raw[s:s + n], -1) for s, n in zip(v.token_start.tolist(), v.token_length.tolist(), strict=True)], np.int64)


def boundaries(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where stretches begin: at texts, and at a blank after a visible character. A character whose last bytes could be those of
    other white space counts as not visible."""
    n = len(data)
    begins = np.zeros(n, bool)
    if n:
        one = data[:-1]
        two = np.concatenate([[np.uint8(0)], data[:-2]]) if n > 1 else one
        visible = (one > 32) & (one != 127) & ~((one >= 128) & ((two == 0x80) | (two == 0x81) | (two == 0x9A) | ((two == 0xC2) & ((one == 0x85) | (one == 0xA0)))))
        begins[1:] = (data[1:] == 32) & visible
        # blanks at the end stay with what is before them: B gives no id for a blank alone, which it adds by itself
        solid = np.append(-1, np.flatnonzero(data != 32))
        last = solid[np.searchsorted(solid, offsets[1:]) - 1]
        blank = np.repeat(last, np.diff(offsets)) < np.arange(n)
        begins &= ~blank
        first = offsets[:-1]
        begins[first[first < n]] = True
    return np.flatnonzero(begins)


class StretchAligner:
    """What is known of each distinct stretch: numbers of ids, links and the digits of its groups."""

    def __init__(self, a_path: str, b_path: str, max_entries: int = 150_000):
        self.a, self.b = byte_library(a_path), piece_library(b_path)
        v = vocabulary(a_path)
        self.a_size, self.b_bytes = v.token_length, piece_bytes(b_path)
        self.b_size, self.same = np.array([len(p) for p in self.b_bytes], np.int64), identity_map(a_path, b_path)
        names = [b"%d" % i for i in range(max(len(self.a_size), len(self.b_size)))]
        self.name_size = np.array([len(x) for x in names], np.int64)
        self.name_at = np.cumsum(self.name_size) - self.name_size
        self.names = np.frombuffer(b"".join(names), np.uint8)
        self.cache = SpanCache(self.learn, self.forget, max_entries)

    def forget(self) -> None:
        self.numbers = [Grown(np.int32) for _ in range(3)]  # ids of A, ids of B, groups (-1: not given back)
        self.links, self.link_at, self.link_n = Grown(np.int64), Grown(np.int64), Grown(np.int64)  # a << 20 | b, or -1 - a where regular
        self.text, self.text_at, self.text_n = Grown(np.uint8), Grown(np.int64), Grown(np.int64)

    def learn(self, stretches: list[str]) -> None:
        """Stretches begin with a blank, which B adds by itself."""
        for at in range(0, len(stretches), SLICE):
            self.learn_slice(stretches[at:at + SLICE])

    def a_ids(self, stretches: list[str], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of A and the number of each stretch. Those that end visibly go through the library as one text: their ids
        are told apart by bytes, which A keeps."""
        together = np.flatnonzero(np.fromiter((not s[-1].isspace() for s in stretches), bool, len(stretches)))
        apart = np.setdiff1d(np.arange(len(stretches)), together)
        order = np.concatenate([together, apart])
        texts = ["".join([stretches[i] for i in together[at:at + 256].tolist()]) for at in range(0, len(together), 256)]
        ids = np.concatenate([np.zeros(0, np.int64), *(np.array(e.ids, np.int64) for e in self.a.encode_batch_fast(texts + [stretches[i] for i in apart.tolist()], add_special_tokens=False))])
        stop = np.searchsorted(np.cumsum(self.a_size[ids]), np.cumsum(size[order]), "right")
        many = np.diff(stop, prepend=0)
        counts, first = np.empty(len(order), np.int64), np.empty(len(order), np.int64)
        counts[order], first[order] = many, stop - many
        return ids[ranges(first, counts)], counts

    def learn_slice(self, stretches: list[str]) -> None:
        n = len(stretches)
        size = np.fromiter((len(s.encode()) for s in stretches), np.int64, n)
        flat_a, na = self.a_ids(stretches, size)
        b_ids = self.b.encode([s[1:] for s in stretches])
        nb = np.fromiter(map(len, b_ids), np.int64, n)
        flat_b = np.fromiter((i for ids in b_ids for i in ids), np.int64, int(nb.sum()))
        of_a, of_b = np.repeat(np.arange(n), na), np.repeat(np.arange(n), nb)
        base = np.cumsum(size) - size
        end_a, end_b = (self.ends(sizes[flat], m, base) for sizes, flat, m in ((self.a_size, flat_a, na), (self.b_size, flat_b, nb)))
        bad = np.bincount(of_b, self.b_size[flat_b], n) != size
        same_size = np.flatnonzero(~bad)
        raw = self.b_bytes
        for i in same_size[np.fromiter(("▁" in stretches[i] for i in same_size.tolist()), bool, len(same_size))].tolist():
            bad[i] = b"".join(raw[j] for j in b_ids[i]) != stretches[i].encode()
        good_a, good_b = ~bad[of_a], ~bad[of_b]
        flat_a, of_a, end_a, flat_b, of_b, end_b = flat_a[good_a], of_a[good_a], end_a[good_a], flat_b[good_b], of_b[good_b], end_b[good_b]
        last_a, last_b = np.isin(end_a, end_b), np.isin(end_b, end_a)
        # groups are numbered by their last ids; a group is regular with one id on both sides, of the same bytes
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        many = int(last_a.sum())
        la, lb, of = flat_a[last_a], flat_b[last_b], of_a[last_a]
        regular = (np.bincount(group_a, minlength=many) == 1) & (np.bincount(group_b, minlength=many) == 1) & (self.same[la] == lb)
        groups = np.bincount(of, minlength=n)
        for grown, values in zip(self.numbers, (np.where(bad, 0, na), np.where(bad, 0, nb), np.where(bad, -1, groups)), strict=True):
            grown.add(values)
        self.link_at.add(self.links.n + np.cumsum(groups) - groups)
        self.link_n.add(groups)
        self.links.add(np.where(regular, -1 - la, (la << 20) | lb))
        # the ids in the order of groups, A before B, each with the sign that follows it
        ids, group = np.concatenate([flat_a, flat_b]), np.concatenate([group_a, group_b])
        side = np.repeat([0, 1], [len(flat_a), len(flat_b)])
        sign = np.concatenate([np.where(last_a, ord("|"), ord(",")), np.where(last_b, ord(";"), ord(","))]).astype(np.uint8)
        order = np.lexsort((np.arange(len(ids)), side, group))
        ids, sign = ids[order], sign[order]
        width = self.name_size[ids] + 1
        stop = np.cumsum(width)
        place = ranges(self.name_at[ids], width)
        text = self.names[np.minimum(place, len(self.names) - 1)]
        text[stop - 1] = sign
        long = np.bincount(np.concatenate([of_a, of_b])[order], width, n).astype(np.int64)
        self.text_at.add(self.text.n + np.cumsum(long) - long)
        self.text_n.add(long)
        self.text.add(text)

    @staticmethod
    def ends(sizes: np.ndarray, many: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Byte offsets at which tokens end, stretch after stretch from ``base`` on."""
        total = np.cumsum(sizes)
        before = np.concatenate([[0], total])[np.cumsum(many) - many]
        return total - np.repeat(before, many) + np.repeat(base, many)


@lru_cache(2)
def aligner(a_path: str, b_path: str) -> StretchAligner:
    return StretchAligner(a_path, b_path)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()), pa.array(values, kind))


def tally(row: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each row with their numbers: values, numbers, and how many values each row has."""
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    first = np.flatnonzero(new)
    return value[first], np.diff(np.append(first, len(row))), np.bincount(row[first], minlength=n)


def document_rows(batches: Iterator[pa.RecordBatch], a_path: str, b_path: str) -> Iterator[pa.RecordBatch]:
    known, row = aligner(a_path, b_path), TaskContext.get().partitionId() << 36
    for batch in batches:
        for lo, hi in cuts(batch, 1):
            part = batch.slice(lo, hi - lo)
            data, offsets = utf8(part.column(1))
            n = len(offsets) - 1
            # a blank before each text that isn't empty
            full = np.diff(offsets) > 0
            data = np.insert(data, offsets[:-1][full], 32)
            offsets = offsets + np.concatenate([[0], np.cumsum(full)])
            start = boundaries(data, offsets)
            entry = known.cache(data, start, np.append(start[1:], len(data))[:len(start)])
            doc = np.searchsorted(offsets, start, "right") - 1
            groups = known.numbers[2].data[entry]
            lost = np.zeros(n, bool)
            lost[doc[groups < 0]] = True
            entry, doc = entry[~lost[doc]], doc[~lost[doc]]
            sums = [np.bincount(doc, grown.data[entry], n).astype(np.int64) for grown in known.numbers]
            size = known.text_n.data[entry]
            text = known.text.data[ranges(known.text_at.data[entry], size)].tobytes()
            stop = np.cumsum(np.bincount(doc, size, n).astype(np.int64)).tolist()
            view, digests, at = memoryview(text), [], 0
            for end in stop:
                digests.append(hashlib.sha256(view[at:end - 1]).hexdigest() if end > at else "")
                at = end
            count = known.link_n.data[entry]
            link, of = known.links.data[ranges(known.link_at.data[entry], count)], np.repeat(doc, count)
            a, a_n, a_rows = tally(of[link < 0], -1 - link[link < 0], n)
            pair, pair_n, pair_rows = tally(of[link >= 0], link[link >= 0], n)
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(s) for s in sums), pa.array(digests, pa.string()), pa.array(row + np.arange(n)), lists(a, a_rows, pa.int32()),
                                              lists(a_n, a_rows, pa.int32()), lists(pair, pair_rows, pa.int64()), lists(pair_n, pair_rows, pa.int32())],
                                             [c.split()[0] for c in ROWS.split(", ")])
            row += n


def regular_counts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """A task's regular groups by A id, in one vector."""
    total = np.zeros(size, np.int64)
    for batch in batches:
        a, n = (np.asarray(c.flatten()) for c in batch.columns)
        total += np.bincount(a, n, size).astype(np.int64)
    a = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(total[a])], ["a", "n"])


def looked_up(batches: Iterator[pa.RecordBatch], regular: np.ndarray, highest: np.ndarray, same: np.ndarray, hot: np.ndarray, hot_n: np.ndarray) -> Iterator[pa.RecordBatch]:
    """What a task can tell of its documents' links, and the pairs left to look up."""
    regular_best = (same >= 0) & (regular == highest[np.maximum(same, 0)])
    for batch in batches:
        n = batch.num_rows
        cols = []
        for c in ("a", "pair"):
            col = batch.column(c)
            values, many = np.asarray(col.flatten()), np.asarray(batch.column(f"{c}_n").flatten())
            cols.append((values, many, np.repeat(np.arange(n), np.diff(np.asarray(col.offsets)))))
        (a, a_n, of_a), (pair, pair_n, of_pair) = cols
        at = np.minimum(np.searchsorted(hot, pair), max(len(hot) - 1, 0))
        there = hot[at] == pair if len(hot) else np.zeros(len(pair), bool)
        count = hot_n[at[there]]
        best = count == highest[pair[there] & 0xFFFFF]
        links = np.bincount(of_a, a_n, n) + np.bincount(of_pair, pair_n, n)
        n_best = np.bincount(of_a, a_n * regular_best[a], n) + np.bincount(of_pair[there], pair_n[there] * best, n)
        # sums in whole numbers: weights of bincount are floats, which end at 2 ** 53
        total = np.zeros(n, np.int64)
        np.add.at(total, of_a, a_n.astype(np.int64) * regular[a])
        np.add.at(total, of_pair[there], pair_n[there].astype(np.int64) * count)
        rest = np.bincount(of_pair[~there], minlength=n)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")), pa.array(links.astype(np.int64)), pa.array(n_best.astype(np.int64)), pa.array(total),
                                          batch.column("groups_sha256"), batch.column("row"), lists(pair[~there], rest, pa.int64()), lists(pair_n[~there], rest, pa.int32())],
                                         ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "row", "pair", "pair_n"])


def aligned(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, hot_pairs: int = HOT) -> tuple[DataFrame, DataFrame]:
    """A row for each document, and (a, b, n): how often each pair of ids is linked."""
    a_path, b_path = a_path or default_vocabulary(), b_path or default_pieces()
    spark = docs.sparkSession
    same, size = identity_map(a_path, b_path), vocabulary(a_path).size
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = stored(rows.mapInArrow(lambda it: document_rows(it, a_path, b_path), ROWS), "links")
    regular = np.zeros(size, np.int64)
    for r in known.select("a", "a_n").mapInArrow(lambda it: regular_counts(it, size), "a int, n long").groupBy("a").agg(F.sum("n").alias("n")).collect():
        regular[r["a"]] = r["n"]  # as many rows as vocabulary A at most
    split = F.explode(F.arrays_zip("pair", "pair_n")).alias("p")
    pairs = stored(known.select(split).groupBy(F.col("p.pair").alias("pair")).agg(F.sum("p.pair_n").alias("n")), "pairs")
    highest = np.zeros(len(piece_bytes(b_path)), np.int64)
    np.maximum.at(highest, same[same >= 0], regular[same >= 0])
    for r in pairs.groupBy(F.col("pair").bitwiseAND(0xFFFFF).alias("b")).agg(F.max("n").alias("n")).collect():  # as many as vocabulary B
        highest[r["b"]] = max(highest[r["b"]], r["n"])
    every = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    found = pairs.filter(F.col("n") * hot_pairs > every).orderBy("pair").collect()  # fewer than ``hot_pairs``
    hot, hot_n = np.array([r["pair"] for r in found], np.int64), np.array([r["n"] for r in found], np.int64)
    told = known.mapInArrow(lambda it: looked_up(it, regular, highest, same, hot, hot_n),
                            "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string, row long, pair array<long>, pair_n array<int>")
    top = spark.createDataFrame([(i, int(n)) for i, n in enumerate(highest)], "b int, top long")
    numbers = pairs.filter(F.col("n") * hot_pairs <= every).join(F.broadcast(top), F.col("pair").bitwiseAND(0xFFFFF) == F.col("b")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))
    rest = told.select("row", split).select("row", F.col("p.pair").alias("pair"), F.col("p.pair_n").alias("many")).join(numbers, "pair") \
        .groupBy("row").agg(F.sum(F.col("many") * F.col("n")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("many")).otherwise(0)).alias("more_best"))
    result = told.drop("pair", "pair_n").join(rest, "row", "left") \
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"), "groups_sha256")
    plain = spark.createDataFrame([(int(a), int(same[a]), int(regular[a])) for a in np.flatnonzero(regular)], "a long, b long, n long")
    return result, plain.unionByName(pairs.select(F.shiftright("pair", 20).alias("a"), F.col("pair").bitwiseAND(0xFFFFF).alias("b"), "n"))


def op13_alignment(spark: SparkSession, root: str) -> DataFrame:
    return aligned(table(spark, root, "documents"))[0]
