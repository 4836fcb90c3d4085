"""Near duplicates, repeated passages, decontamination and top-k against brute force on small tables."""

import itertools
import random
import re
import time
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from creditlake.llm import decontaminate, neardup, passages, topk
from creditlake.llm.common import Words, mix, utf8

from llm_frames import frame  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sentence(draw, n, vocabulary=4000):
    return [f"w{draw.randrange(vocabulary)}" for _ in range(n)]


def shingles(text, k):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if len(words) >= k else ({tuple(words)} if words else set())


def brute_groups(rows, k, percent=80):
    parent = {d: d for d, _ in rows if d is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(d, shingles(t, k)) for d, t in rows if d is not None]
    for (a, x), (b, y) in itertools.combinations(sets, 2):
        both = len(x & y)
        if both and 100 * both >= percent * (len(x) + len(y) - both):
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    return {d: root(d) for d in parent}


def near_copies(draw):
    base = sentence(draw, 90)
    rows = []
    for i in range(70):
        copy = list(base)
        for _ in range(draw.choice([0, 1, 2, 3, 4, 5, 6, 8])):
            place = draw.randrange(len(copy))
            if draw.random() < 0.5:
                copy[place] = f"e{draw.randrange(30)}"
            else:
                del copy[place]
        rows.append((100 + i, " ".join(copy)))
    other = sentence(draw, 40)
    rows += [(i, " ".join(sentence(draw, draw.randrange(1, 40)))) for i in range(40)]
    rows += [(300, " ".join(other)), (299, " ".join(other).upper()), (298, " ".join(other) + " end"), (41, "one"), (40, "ONE"), (42, "two words"), (43, "two\t\nwords ")]
    return rows


@pytest.mark.parametrize("few", [2, 16])
@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(frame, monkeypatch, few, k):
    monkeypatch.setattr(neardup, "FEW", few)
    monkeypatch.setattr(neardup, "BLOCK", 16)
    rows = near_copies(random.Random(k)) + [(50, None), (51, ""), (52, " \n\t "), (None, "no id here"), (None, "no id here"), (53, "long " * 20000)]
    rows += [(300, rows[110][1]), (60, "same id one text"), (60, "same id other words entirely")]
    # two texts of one length under one id, each with a near copy of its own
    draw = random.Random(9)
    twins = [sentence(draw, 60, 10 ** 6) for _ in range(2)]
    rows += [(900, " ".join(t)) for t in twins] + [(901 + i, " ".join([*t[:59], "else"])) for i, t in enumerate(twins)]
    got = neardup.near_duplicates(frame(rows), k=k).collect()
    want = brute_groups(rows, k)
    assert want[902] == want[901] == 900
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)
    assert {(r.doc_id, r.n_shingles) for r in got} == {(d, len(shingles(t, k))) for d, t in rows}


def test_near_duplicates_of_nothing(frame):
    assert neardup.near_duplicates(frame([])).count() == 0


def test_signature_estimates_similarity():
    draw = np.random.default_rng(5)
    errors = []
    for n in (1, 4, 30, 400):
        for _ in range(20):
            elements = mix(draw.integers(0, 1 << 60, n + n // 4).astype(np.uint64))
            x, y = np.sort(elements[:n]), np.sort(elements[n // 4:])
            signs = neardup.superminhash(np.repeat([0, 1], [n, n]), np.concatenate([x, y]), 2, 160)
            errors.append((signs[0] == signs[1]).mean() - len(np.intersect1d(x, y)) / len(np.union1d(x, y)))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_passages(frame):
    draw = random.Random(3)
    source = sentence(draw, 400)
    text = lambda *parts: " ".join(w for p in parts for w in p)
    changed = list(source[100:170])
    changed[20] = "changed"
    del changed[45]
    rows = [(1, text(source)), (2, text(sentence(draw, 50), source[100:160], sentence(draw, 30))), (3, text(sentence(draw, 20), changed, sentence(draw, 60))),
            (4, text(source).upper()), (5, text(sentence(draw, 60), source[10:50], sentence(draw, 60))), (6, text(sentence(draw, 300))), (7, None), (8, ""), (9, "few words"),
            (10, text(source[:80], source[:80])), (11, text(source[:60], source[110:170])), (None, text(source)), (4, text(source).upper()), (4, "another text of that id")]
    got = passages.repeated_passages(frame(rows)).collect()
    texts = dict(rows[:11])
    found = {(r.doc_id, r.source_id): texts[r.doc_id][r.start:r.end].lower().split() for r in got if r.doc_id in (2, 3, 4)}
    assert found[2, 1] == source[100:160] and found[4, 1] == source and found[3, 1] == changed
    assert {r.doc_id for r in got} == {2, 3, 4, 10, 11} and sum(r.doc_id == 11 for r in got) == 2 and all(r.n_words >= 50 and r.similarity >= 0.8 for r in got)
    assert {r.source_id for r in got} == {1}
    assert all(texts[r.source_id][r.source_start:r.source_end] for r in got)
    assert passages.repeated_passages(frame([])).count() == 0


@pytest.mark.parametrize("block", [1, 5, 1 << 14])
def test_common_words(monkeypatch, block):
    monkeypatch.setattr(passages, "BLOCK", block)
    draw = np.random.default_rng(block)
    for _ in range(60):
        x, y = (draw.integers(0, 4, draw.integers(0, 20)) for _ in range(2))
        table = np.zeros((len(x) + 1, len(y) + 1), int)
        for i, a in enumerate(x):
            for j, b in enumerate(y):
                table[i + 1, j + 1] = table[i, j] + 1 if a == b else max(table[i, j + 1], table[i + 1, j])
        assert passages.common_words(x, y) == table[-1, -1]


def test_recall_of_changed_passages(frame):
    """Both joins, words changed at random: the source of a passage, and one that only has both its parts together."""
    draw = np.random.default_rng(4)
    fresh = lambda n: [f"w{v}" for v in draw.integers(0, 10 ** 6, n)]
    rows, asked = [], {}

    def add(words):
        rows.append((len(rows) + 1, " ".join([*fresh(30), *words, *fresh(30)])))
        return len(rows)

    def changed(words, share):
        out = list(words)
        for i in draw.choice(np.arange(1, len(out) - 1), round(share * len(out)), replace=False):
            out[i] = f"z{draw.integers(0, 10 ** 9)}"
        return out

    for _ in range(30):
        for share in (0.0, 0.1, 0.15):
            x, y = fresh(40), fresh(40)
            add(x), add(y)
            asked.setdefault(("second", 80, share), []).append((add(x + y), add(changed(x + y, share))))
        for n, share in ((50, 0.1), (60, 0.1), (60, 0.15), (80, 0.2), (120, 0.2)):
            x = fresh(n)
            asked.setdefault(("first", n, share), []).append((add(x), add(changed(x, share))))
    found = {(r.source_id, r.doc_id) for r in passages.repeated_passages(frame(rows)).collect()}
    share = {case: np.mean([pair in found for pair in pairs]) for case, pairs in asked.items()}
    assert share["second", 80, 0.0] == 1 and all(v >= 0.8 for v in share.values()) and np.mean(list(share.values())) >= 0.92
    assert {b for pairs in asked.values() for _, b in pairs} >= {d for _, d in found}


def test_long_gap(frame):
    """A passage whose middle is another text in both documents, of more than a thousand words and unequal lengths."""
    draw = random.Random(8)
    part = lambda n: sentence(draw, n, 10 ** 6)
    a, b, middle = part(2500), part(2500), part(1100)
    other = [w if i % 2 else f"x{i}" for i, w in enumerate(middle)][:-30]
    got = passages.repeated_passages(frame([(1, " ".join(a + middle + b)), (2, " ".join(a + other + b))])).collect()
    assert [(r.doc_id, r.source_id, r.n_words) for r in got] == [(2, 1, 6070)] and got[0].similarity > 0.89


def test_passages_whose_parts_have_other_first_documents(frame):
    draw = random.Random(12)
    x, y, z, v = (sentence(draw, 40, 10 ** 6) for _ in range(4))
    filler = lambda: sentence(draw, 60, 10 ** 6)
    changed = [w if i % 16 != 12 else f"other{i}" for i, w in enumerate(z + v)]  # no seed run is left between the blocks' first documents
    one = x + y
    parts = {1: x, 2: y, 3: one, 4: x, 5: y, 6: one, 11: z, 12: v, 13: z + v, 14: changed, 21: one[:46], 22: one[4:52]}
    rows = [(i, " ".join(filler() + words + filler())) for i, words in parts.items()]
    rows += [(31, " ".join(filler() + one[:50] + filler()))]
    got = passages.repeated_passages(frame(rows)).collect()
    texts = dict(rows)
    found = {(r.doc_id, r.source_id): texts[r.doc_id][r.start:r.end].split() for r in got}
    assert found[6, 3] == one and found[31, 3] == one[:50]
    assert 70 <= len(found[14, 13]) <= 80
    assert set(found) == {(6, 3), (14, 13), (31, 3)} and len(got) == 3


def test_seeds_reach_passages_with_many_changed_words():
    draw, found = np.random.default_rng(5), 0
    for _ in range(100):
        base = [f"w{v}" for v in draw.integers(0, 10 ** 9, 80)]
        copy = list(base)
        for i in draw.choice(np.arange(1, 79), 16, replace=False):
            copy[i] = f"c{draw.integers(0, 10 ** 9)}"
        fill = lambda: [f"f{v}" for v in draw.integers(0, 10 ** 9, 60)]
        texts = [" ".join(fill() + x + fill()).encode() for x in (base, copy)]
        words = Words(np.frombuffer(b"".join(texts), np.uint8), np.array([0, len(texts[0]), len(texts[0]) + len(texts[1])]))
        h, doc, place = passages.seeds_of(words, passages.K, passages.WINDOW)
        first = dict(zip(h[doc == 0].tolist(), place[doc == 0].tolist(), strict=True))
        hits = [(p, first[x]) for x, p in zip(h[doc == 1].tolist(), place[doc == 1].tolist(), strict=True) if x in first]
        k, window = passages.K, passages.WINDOW
        if len(hits) > 1 and hits[-1][0] - hits[0][0] + k >= (50 - 2 * (window + k)) // 2 + k:
            b, a = np.array(hits).T
            found += bool(passages.passages(b, a, words.hash[words.first[1]:], words.hash[:words.first[1]], k, 2 * window + k, 50, 0.8))
    assert found >= 80


def test_chaining_against_brute_force():
    draw = random.Random(8)
    for _ in range(40):
        parts = sorted((draw.randrange(60), draw.randrange(60), n := draw.randrange(2, 8), n) for _ in range(9))

        def best(i):
            b, a, _, gain = parts[i]
            options = [best(j) - passages.SKIP * (b + a - parts[j][0] - parts[j][1] - 2 * parts[j][2]) for j in range(len(parts))
                       if parts[j][0] + parts[j][2] <= b and parts[j][1] + parts[j][2] <= a]
            return gain + max([0, *options])

        top = passages.chains(parts)[0]
        value = sum(parts[i][3] for i in top) - sum(passages.SKIP * (parts[j][0] + parts[j][1] - parts[i][0] - parts[i][1] - 2 * parts[i][2]) for i, j in itertools.pairwise(top))
        assert abs(value - max(best(i) for i in range(len(parts)))) < 1e-9


def edit_distance(p, t):
    row = [0] * (len(t) + 1)
    for i in range(1, len(p) + 1):
        new = [i]
        for j in range(1, len(t) + 1):
            new.append(min(row[j - 1] + (p[i - 1] != t[j - 1]), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_alignment_against_brute_force():
    draw = random.Random(2)
    patterns, texts = [], []
    for _ in range(60):
        p = [draw.choice(b"abcd") for _ in range(draw.randrange(5, 30))]
        t = [draw.choice(b"abcd") for _ in range(8)] + [c for c in p if draw.random() > 0.1] + [draw.choice(b"abcd") for _ in range(4)]
        patterns.append(np.array(p, np.uint8))
        texts.append(np.array(t, np.uint8))
    best, _ = decontaminate.align(patterns, texts, 40)
    assert best.tolist() == [edit_distance(p.tolist(), t.tolist()) for p, t in zip(patterns, texts, strict=True)]


def test_decontamination(spark, frame):
    draw = random.Random(6)
    letters = "abcdefghijklmnoprstu"
    item = lambda n: " ".join("".join(draw.choice(letters) for _ in range(draw.randrange(2, 8))) for _ in range(n))
    items = [(i, item(25)) for i in range(12)] + [(20, "yes"), (21, ""), (22, None), (23, "  "), (24, "short words here")]
    rows = []
    for i in range(12):
        text = list(items[i][1])
        for _ in range(i % 4 * 3):
            text[draw.randrange(len(text))] = draw.choice(letters)
        rows.append((i, f"{item(30)} {''.join(text).upper() if i % 2 else ''.join(text)}\n\n{item(10)}"))
    rows += [(50, item(60)), (51, None), (52, ""), (53, "well yes, yes no"), (54, "yes"), (55, "the  Short\nwords here"), (0, rows[0][1]), (None, rows[1][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    for limit in (1 << 20, 400):  # in one group and in many
        got = decontaminate.contaminated(frame(rows), bench, index_bytes=limit).collect()
        assert {(r.doc_id, r.item_id) for r in got} == {(i, i) for i in range(12)} | {(None, 1), (53, 20), (54, 20), (55, 24)}
        assert sum(r.doc_id == 0 for r in got) == 2 and sum(r.doc_id == 53 for r in got) == 1
        for r in got:
            if r.doc_id in range(12):
                text = dict(rows[:12])[r.doc_id][r.start:r.end]
                assert r.edits <= 9 and abs(len(text) - len(items[r.item_id][1])) <= r.edits
    assert decontaminate.contaminated(frame([]), bench).count() == 0
    assert decontaminate.contaminated(frame(rows), bench.limit(0)).count() == 0


def test_top_k(spark):
    draw = np.random.default_rng(1)
    rows = [(i, [float(x) for x in draw.normal(size=6).round(1)], "x") for i in range(300)] + [(i, [0.5, 0.0, 0.0, 0.0, 0.0, 0.25], "x") for i in range(300, 420)]
    rows += [(500, None, "x"), (501, [float("nan")] * 6, "x"), (502, [None] * 6, "x"), (None, [1.0] * 6, "x"), (550, [1.0, 2.0], "x"), (600, [1.0], "x"), (650, [], "x"),
             (700, [0.0] * 6, "x"), (50, rows[50][1], "x"), (503, [float("inf")] * 6, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    whole = {i: [int(np.floor(256 * np.float64(np.float32(x)))) for x in v] for i, v, _ in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    want = []
    for q in whole:
        if q % 50 == 0:
            order = sorted((-sum(a * b for a, b in zip(whole[q], whole[x], strict=True)), x) for x in whole if x != q and len(whole[x]) == len(whole[q]))[:5]
            want += [(q, rank, x, -s) for rank, (s, x) in enumerate(order, 1)]
    for lists in (1, 2, 3):
        assert sorted(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0, lists=lists).collect())) == sorted(want)
    assert topk.top_k(df.filter("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_keeps_pairs_in_their_task(spark, monkeypatch):
    """What is written grows with vectors and with queries times k, not with their pairs; in one group of queries and in many."""
    draw = np.random.default_rng(2)
    values = (draw.normal(size=(6000, 8)) * draw.choice([0.1, 1, 300, 3e4], (6000, 1))).round(1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(values)], "vec_id long, embedding array<double>")
    whole = np.floor(256 * values).astype(np.int64)
    want = set()
    for q in range(0, 6000, 50):
        score = whole[q] @ whole.T
        order = [x for x in np.lexsort((np.arange(6000), -score))[:6] if x != q][:5]
        want |= {(q, rank, int(x), int(score[x])) for rank, x in enumerate(order, 1)}
    folders = lambda: set(Path(spark.conf.get("spark.checkpoint.dir")).glob("llm-*"))
    for limit in (None, 40_000):
        if limit:
            monkeypatch.setattr(topk, "QUERY_BYTES", limit)
        before = folders()
        assert set(map(tuple, topk.top_k(df, F.col("vec_id") % 50 == 0).collect())) == want
        rows = [spark.read.parquet(str(f)).count() for f in folders() - before]
        assert sum(rows) < 3 * 6000 + 8 * 120 * 6


def test_items_with_a_shared_opening(monkeypatch):
    """The opening alone fills the bound of every item; no such item matches, and the work of a row is dealt in parts."""
    draw = random.Random(6)
    letters = lambda n: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    opening = letters(200)
    items = [opening + letters(300) for _ in range(150)]
    docs = [letters(300) + opening + letters(300) for _ in range(40)] + [" ".join([opening] * 200)]
    near = list(items[7])
    for i in range(20, 480, 15):
        near[i] = "_"
    docs[3] = letters(100) + "".join(near) + letters(100)
    index = decontaminate.build_index(list(range(len(items))), items)
    got = decontaminate.matches(index, *utf8(pa.array(docs)))
    assert [(g[0], g[1], g[4]) for g in got] == [(3, 7, 31)]
    monkeypatch.setattr(decontaminate, "ENTRIES", 5000)
    assert decontaminate.matches(index, *utf8(pa.array(docs))) == got


def test_passages_leave_no_shuffle_files(frame, spark):
    """Each written step removes its shuffle files, and the session's own setting comes back."""
    draw = random.Random(21)
    base = sentence(draw, 200, 10 ** 6)
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    kept = lambda: {f.getName() for f in (blocks.getAllFiles().apply(i) for i in range(blocks.getAllFiles().length())) if f.getName().startswith("shuffle_")}
    before, setting = kept(), spark.conf.get(passages.CLEANUP, None)
    out = passages.repeated_passages(frame([(i, " ".join(base[i:i + 120])) for i in range(1, 40)]))
    assert spark.conf.get(passages.CLEANUP, None) == setting
    for _ in range(50):  # files go in the background
        if not (left := kept() - before):
            break
        time.sleep(0.2)
    assert not left and out.count() > 0


def test_aligned_texts_are_bounded_on_both_sides(monkeypatch):
    """Short texts whose sources are long are not taken all at once."""
    seen = []
    monkeypatch.setattr(passages, "align_batch", lambda batch, *a: seen.append((batch.num_rows, sum(len(t) for c in (4, 5) for t in batch.column(c).to_pylist()))))
    texts = pa.array(["few words"] * 40), pa.array(["long " * 20_000] * 40)
    batch = pa.RecordBatch.from_arrays([pa.array(range(40))] * 4 + [*texts], list("dsbaxy"))
    assert list(passages.align_all(iter([batch]), 5, 21, 50, 0.8)) == []
    assert sum(n for n, _ in seen) == 40 and max(size for _, size in seen) <= passages.CHUNK_BYTES


def test_seed_pairs_are_one_row_a_seed():
    batch = pa.RecordBatch.from_pydict({"doc": [7, 8], "mark": pa.array([1, 2], pa.int32()), "b": pa.array([[0, 10, 30, 90], [5]], pa.list_(pa.int32())),
                                        "source": pa.array([[1, 2, 3, 4], [1]], pa.list_(pa.int64())), "source_place": pa.array([[0, 0, 0, 0], [0]], pa.list_(pa.int64())), "asks": [True, False]})
    out = passages.seed_pairs(batch, 21, 40).to_pylist()
    assert [(r["doc"], r["place"] & 0xFFFFFFFF, r["gaps"], r["asks"]) for r in out] == [(7, 0, [10, 30], True), (7, 10, [20], True)]
    assert len({h for r in out for h in r["hs"]}) == 3
