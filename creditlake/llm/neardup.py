"""Operator 6: near-duplicate groups by SuperMinHash signatures, banding, verification and union-find grouping.

A document's set are the hashes of its distinct word shingles. SuperMinHash gives each element one random value and one slot
per round, the slots of its rounds being a random permutation; the value of round j lies in [j, j+1), so a document is done
after the first round that leaves no slot empty: long documents need one or two rounds, and the signature varies less
than with independent minima. All documents of a chunk go through a round at once.

1. Equal sets (128-bit digest) collapse to their smallest doc_id; only these representatives go on.
2. Bands of the signature are buckets. Each member of a bucket is paired with the smallest doc_id of the bucket, so a bucket
   gives as many pairs as members, whatever its size. Pairs are confirmed on the full sets and grouped by union-find.
3. The buckets with one smallest doc_id make a family. A family whose members are still of two or more groups may hide a link
   between members other than its smallest. In families of up to ``FEW`` members, those outside the largest group meet
   the others in a join that only passes pairs that can reach the threshold: by sizes, and by how many shingles of a
   member occur in no other member of such families (those can't be shared); what passes is confirmed too. In larger
   families they are dealt to blocks, and each block of them meets each block of members in one task, where a product of
   incidence matrices gives all intersections; one link for each two groups is returned.

With 32 bands of 5 slots a link at similarity 0.8 shares no bucket with probability 3e-6, one at 0.9 with 1e-12.

Defined results: null or empty texts, and texts of white space, have an empty set and are linked with nothing. Documents of
fewer than k words have their whole sequence as one shingle. Rows with the same doc_id are one node: a link of one of
them is a link of all, and each row is returned. Rows without doc_id are linked with nothing, have no component and are kept.
An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER, Words, distinct_by, map_arrow, mix, stored, table, utf8

BANDS, ROWS = 32, 5
FEW, BLOCK = 16, 256
HOT_ROOTS = 1000


def shingle_sets(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of the distinct shingles, sorted by row; A-Z count as a-z."""
    hashed, doc, _ = Words(LOWER[data], offsets).grams(k)
    return distinct_by(doc, hashed)


def superminhash(doc: np.ndarray, element: np.ndarray, n_docs: int, slots: int) -> np.ndarray:
    """Signatures (rows of ``slots`` numbers) of sets given as sorted row numbers and element hashes."""
    best = np.full(n_docs * slots, np.iinfo(np.uint64).max, np.uint64)
    order = np.arange(len(doc))
    moved = None  # what has been swapped where, for each element
    for j in range(slots):
        x = mix(element[order] + np.uint64((j * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
        pick = j + (((x & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j)) >> np.uint64(32)).astype(np.int64)
        if moved is None:
            slot = pick
        else:
            row = np.arange(len(order))
            slot = moved[row, pick].astype(np.int64)
            moved[row, pick] = moved[:, j]
        np.minimum.at(best, doc[order] * slots + slot, (x >> np.uint64(32)) | np.uint64(j << 32))
        open_docs = (best.reshape(n_docs, slots) == np.iinfo(np.uint64).max).any(1)
        stay = open_docs[doc[order]]
        if not stay.any():
            break
        order = order[stay]
        if moved is None:
            moved = np.tile(np.arange(slots, dtype=np.uint16), (len(order), 1))
            row = np.arange(len(order))
            moved[row, pick[stay]] = 0
        else:
            moved = moved[stay]
    return best.reshape(n_docs, slots)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    parts = signature.reshape(len(signature), bands, rows)
    key = np.tile(np.arange(1, bands + 1, dtype=np.uint64), (len(signature), 1))
    for r in range(rows):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def signatures(docs: DataFrame, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n (set size), a and b (digest of the set), keys (of the bands; none for an empty set)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, offsets = utf8(batch.column(1))
        n_docs = batch.num_rows
        doc, element = shingle_sets(data, offsets, k)
        n = np.bincount(doc, minlength=n_docs)
        first = np.searchsorted(doc, np.arange(n_docs))
        digests = []
        for salt in (0x243F6A8885A308D3, 0x13198A2E03707344):
            total = np.concatenate([[0], np.cumsum(mix(element ^ np.uint64(salt)), dtype=np.uint64)]).astype(np.uint64)
            digests.append((total[first + n] - total[first]).view(np.int64))
        keys = np.zeros((n_docs, bands), np.int64)
        full = n > 0
        if full.any():
            renumber = np.cumsum(full) - 1
            keys[full] = band_keys(superminhash(renumber[doc], element, int(full.sum()), bands * rows), bands, rows)
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(full * bands)]), pa.int32()), pa.array(keys[full].ravel(), pa.int64()))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), *(pa.array(d, pa.int64()) for d in digests), lists],
                                          ["doc_id", "n", "a", "b", "keys"])

    return map_arrow(docs, run, "doc_id long, n long, a long, b long, keys array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets have 100 * intersection >= percent * union."""
    right = texts.select(F.col("doc_id").alias("v"), F.col("text").alias("text_v"))
    left = texts.select(F.col("doc_id").alias("u"), F.col("text").alias("text_u"))
    rows = pairs.join(right, "v").join(left, "u").select("text_u", "text_v", "u", "v")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        sets = [shingle_sets(*utf8(batch.column(c)), k) for c in (0, 1)]
        sizes = [np.bincount(doc, minlength=n) for doc, _ in sets]
        both, _ = distinct_by(*(np.concatenate(x) for x in zip(*sets, strict=True)))
        union = np.bincount(both, minlength=n)
        common = sizes[0] + sizes[1] - union
        linked = (100 * common >= percent * union) & (common > 0)
        return pa.RecordBatch.from_arrays([batch.column(2), batch.column(3)], ["u", "v"]).filter(pa.array(linked))

    return map_arrow(rows, run, "u long, v long").distinct()


def local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the edges of one task: each node with the smallest node it is joined to there."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent.setdefault(up, up)
            x = up
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    for lo in range(0, len(nodes), 100_000):
        part = nodes[lo:lo + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array([root(x) for x in part], pa.int64()), pa.array(part, pa.int64())], ["u", "v"])


def with_least(rows: DataFrame, least: DataFrame, n: int) -> DataFrame:
    """Rows (u, v) with ``m``, the one value of ``least`` for each u (and ``c``, how many rows u has). A u with more than a
    thousandth of all ``n`` rows, of which there are fewer than a thousand, is looked up in every task; the others are joined."""
    hot = least.filter(F.col("c") * HOT_ROOTS > n).select("u", "m")
    cold = least.filter(F.col("c") * HOT_ROOTS <= n).select("u", "m")
    known = rows.join(F.broadcast(hot), "u", "left")
    return known.filter("m is not null").unionByName(known.filter("m is null").drop("m").join(cold, "u"))


def components(edges: DataFrame) -> DataFrame:
    """id and component (smallest id reachable) of every node of the edges (u, v), by rounds of union-find within tasks and
    of pointing each node and its neighbours to the smallest of them. Every round is written to the shared folder."""
    now, seen = stored(edges.mapInArrow(local_roots, "u long, v long"), "edges"), None
    n = now.count()
    while True:
        # large star: the neighbours above a node go to the smallest of all; then small star: those below it do
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = stored(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c")).select("u", F.least("u", "m").alias("m"), "c"), "least")
        down = stored(with_least(both, least, 2 * n).filter("v > u").select(F.greatest("m", "v").alias("u"), F.least("m", "v").alias("v")).distinct(), "down")
        least = stored(down.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("c")), "least")
        small = with_least(down, least, n).select(F.col("m").alias("u"), "v").unionByName(least.select(F.col("m").alias("u"), F.col("u").alias("v"))).filter("u <> v").distinct()
        now = stored(small, "edges")
        n, *state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if [n, *state] == seen:
            return now.groupBy(F.col("v").alias("id")).agg(F.min("u").alias("component"))
        seen = [n, *state]


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable over links) and kept (it is its component's smallest)."""
    texts = docs.select(F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("doc_id")).select("doc_id", "text")
    signed = stored(signatures(texts, k, bands, rows), "signatures")
    full = signed.filter("n > 0 and doc_id is not null")
    sets = stored(full.groupBy("a", "b").agg(F.min("doc_id").alias("set_id")), "sets")
    nodes = stored(full.join(sets, ["a", "b"]).select("doc_id", "n", "a", "b", "set_id", F.when(F.col("doc_id") == F.col("set_id"), F.col("keys")).alias("keys")), "nodes")

    # a doc_id may have several sets (its rows' texts), each with its keys; a center is joined by its smallest and largest set
    buckets = nodes.filter("keys is not null").dropDuplicates(["doc_id", "a", "b"]).select(F.explode("keys").alias("key"), F.col("doc_id").alias("v"), "n")
    centers = stored(buckets.groupBy("key").agg(F.min(F.struct("v", "n")).alias("low"), F.min(F.struct("v", (-F.col("n")).alias("n"))).alias("high"), F.count("*").alias("members"))
                     .filter("members > 1").select("key", F.col("low.v").alias("u"), F.col("low.n").alias("least_n"), (-F.col("high.n")).alias("most_n")), "centers")
    shared = stored(buckets.join(centers, "key"), "buckets")
    similar = (percent * F.col("n") <= 100 * F.col("most_n")) & (percent * F.col("least_n") <= 100 * F.col("n"))
    pairs = stored(shared.filter((F.col("u") < F.col("v")) & similar).select("u", "v").distinct(), "pairs")
    chosen = shared.select(F.col("v").alias("doc_id")).distinct()
    bodies = stored(texts.join(chosen, "doc_id", "left_semi"), "texts")
    links = stored(confirmed(pairs, bodies, k, percent), "links")
    same = nodes.filter("doc_id <> set_id").select(F.col("set_id").alias("u"), F.col("doc_id").alias("v"))
    first = stored(components(links), "components")

    members = shared.select("u", "v", "n").distinct().join(first, F.col("v") == first.id, "left").select("u", "v", "n", F.coalesce("component", "v").alias("c"))
    counts = members.groupBy("u", "c").agg(F.count("*").alias("m")).groupBy("u").agg(F.max_by("c", F.struct("m", "c")).alias("main"), F.sum("m").alias("total"), F.max("m").alias("most"))
    families = stored(counts.filter("most < total").select("u", "main", "total", (F.col("total") - F.col("most")).alias("outside")), "families")
    rest = stored(members.join(families, "u"), "rest")
    few, many = rest.filter(F.col("total") <= FEW), rest.filter(F.col("total") > FEW)

    open_docs = few.select(F.col("v").alias("doc_id")).distinct()
    own = map_arrow(bodies.join(open_docs, "doc_id", "left_semi"), lambda b: own_shingles(b, k), "doc_id long, shingles array<long>")
    single = own.select("doc_id", F.explode("shingles").alias("s")).groupBy("s").agg(F.min("doc_id").alias("v"), F.max("doc_id").alias("w")) \
        .filter("v = w").groupBy("v").agg(F.count("*").alias("alone"))
    # of documents of one text; those of several count as sharing all of their shingles
    single = single.join(own.groupBy(F.col("doc_id").alias("v")).agg(F.count("*").alias("texts")).filter("texts = 1").select("v"), "v", "left_semi")
    capped = stored(few.join(single, "v", "left").withColumn("most", F.col("n") - F.coalesce("alone", F.lit(0))), "capped")
    a, b = capped.filter("c <> main").alias("a"), capped.alias("b")
    able = (100 + percent) * F.least("a.most", "b.most") >= percent * (F.col("a.n") + F.col("b.n"))
    hidden = a.join(b, (F.col("a.u") == F.col("b.u")) & (F.col("a.c") != F.col("b.c")) & able) \
        .select(F.least("a.v", "b.v").alias("u"), F.greatest("a.v", "b.v").alias("v")).distinct().join(pairs, ["u", "v"], "left_anti")
    more = confirmed(stored(hidden, "hidden"), bodies, k, percent).unionByName(block_links(many, bodies, k, percent))

    linked = stored(components(links.unionByName(more).unionByName(same)), "linked")
    known = nodes.groupBy("doc_id").agg(F.lit(1).alias("has_set"))
    out = signed.join(known.join(linked, known.doc_id == linked.id).select("doc_id", "component"), "doc_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def block_links(many: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Links (u, v) between members of different groups in large families, one for each two groups of a pair of blocks."""
    left_blocks, right_blocks = F.ceil(F.col("outside") / BLOCK), F.ceil(F.col("total") / BLOCK)
    rows = many.join(texts.withColumnRenamed("doc_id", "v"), "v") \
        .withColumn("lb", F.pmod(F.xxhash64("v"), left_blocks)).withColumn("rb", F.pmod(F.xxhash64("v", F.lit(1)), right_blocks))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    left = rows.filter("c <> main").withColumn("rb", every(right_blocks)).select("u", "lb", "rb", "v", "c", "text")
    right = rows.withColumn("lb", every(left_blocks)).select(*[F.col(x).alias(x) for x in ("u", "lb", "rb", "v", "c", "text")])
    keys = ["u", "lb", "rb"]

    def meet(mine: pa.Table, others: pa.Table) -> pa.Table:
        none = pa.table({"u": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        if not mine.num_rows or not others.num_rows:
            return none
        sides = [(t, shingle_sets(*utf8(t.column("text").combine_chunks()), k)) for t in (mine, others)]
        common = np.intersect1d(sides[0][1][1], sides[1][1][1])
        sizes = [np.bincount(doc, minlength=t.num_rows) for t, (doc, _) in sides]
        both = np.zeros((mine.num_rows, others.num_rows))
        for lo in range(0, len(common), 8192):
            part = common[lo:lo + 8192]
            flags = []
            for t, (doc, element) in sides:
                at = np.minimum(np.searchsorted(part, element), len(part) - 1)
                hit = part[at] == element
                flag = np.zeros((t.num_rows, len(part)), np.float32)
                flag[doc[hit], at[hit]] = 1
                flags.append(flag)
            both += flags[0] @ flags[1].T
        (c0, v0), (c1, v1) = ((t.column("c").to_numpy(), t.column("v").to_numpy()) for t in (mine, others))
        union = sizes[0][:, None] + sizes[1] - both
        x, y = np.nonzero((100 * both >= percent * union) & (both > 0) & (c0[:, None] != c1))
        _, one = np.unique(np.stack([c0[x], c1[y]], 1), axis=0, return_index=True)
        x, y = x[one], y[one]
        return pa.table({"u": np.minimum(v0[x], v1[y]), "v": np.maximum(v0[x], v1[y])}) if len(one) else none

    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "u long, v long")


def own_shingles(batch: pa.RecordBatch, k: int) -> pa.RecordBatch:
    doc, element = shingle_sets(*utf8(batch.column(1)), k)
    ends = np.searchsorted(doc, np.arange(batch.num_rows + 1))
    return pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(element.view(np.int64), pa.int64()))],
                                      ["doc_id", "shingles"])


def op6_superminhash(spark: SparkSession, root: str) -> DataFrame:
    return near_duplicates(table(spark, root, "documents"), k=2)
