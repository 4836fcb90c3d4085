"""Runs of words against brute force over all starts and periods."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from creditlake.llm import runs

from llm_frames import frame  # noqa: F401


def brute(w, least=2, words=0):
    """(start, length, period) of stretches of period q that neither neighbour extends, q being the smallest period."""
    out = set()
    for q in range(1, len(w) // least + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(words, least * q) and not any(all(w[k] == w[k + p] for k in range(i, j + q - p)) for p in range(1, q)):
                out.add((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda x: (x[0], x[2]))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40))
def test_squares(words):
    assert sorted((s, e - s, p) for (s, p), e in runs.squares(words).items()) == sorted(brute(words))


@pytest.mark.parametrize("seed", range(30))
def test_rows_of_runs(seed):
    """Several rows of blocks repeated now and then, most of which the search of likely stretches leaves out."""
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(8):
        row = []
        while len(row) < rng.integers(1, 150):
            block = rng.integers(0, rng.choice([2, 5, 200]), rng.integers(1, 25)).tolist()
            many = int(rng.choice([1, 1, 2, 4, 5, 9]))
            row += (block * many)[:len(block) * many - int(rng.integers(0, len(block)))]
        rows.append(row)
    rows.insert(3, [])
    rows.append(rows[0][-5:] * 4)
    first = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    hashes = runs.mix(np.array([x for r in rows for x in r], np.uint64) + np.uint64(1))
    assert runs.runs_of(hashes, first) == [brute(r, 4, 6) for r in rows]


def wanted(doc, text, change):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    n = len(words)
    if change and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute(words, 4, 6)
    keep = [i for i in range(n) if not any(s + p <= i < s + m for s, m, p in found)]
    best = sorted(found, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))[:1]
    s, m, p = best[0] if best else (None, None, None)
    return (str(doc), len(found), s, m, p, 1000 * m // p if p else None, hashlib.sha256("".join("%d,%d,%d\n" % x for x in found).encode()).hexdigest(),
            hashlib.sha256(" ".join(words[i] for i in keep).encode()).hexdigest())


TEXTS = ["", " \n\t ", "one", "la la la la la la end", "a b a b a b a b c", "A a A a A a A a", "é  ü\x0bé ü é\nü é ü é", "x " * 500, "no break space no break space " * 5, "w1 w2 w3 w4 w5 w6 w7 w8 w9 w10 " * 12,
         " ".join(f"n{i}" for i in range(300)), "x x x x x x y y y y y y x x x x x x y y y y y y " * 4]


@pytest.mark.parametrize("change", [False, True])
def test_documents(frame, change):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(130)] + [(3, "again " * 9), (3, "again " * 9), (None, "no id " * 9), (-5, None)]
    got = runs.periodic_runs(frame(rows).repartition(3), change).collect()
    assert sorted(map(str, ((str(r[0]), *r[1:]) for r in got))) == sorted(map(str, (wanted(d, t, change) for d, t in rows)))
    assert sum(r.n_runs > 1 for r in got) > 3


def test_long_text(frame):
    block = " ".join(f"w{i}" for i in range(5000))
    got = runs.periodic_runs(frame([(1, f"start {block} " + f"{block} " * 9 + "end")])).first()
    assert (got.n_runs, got.start, got["length"], got.period, got.exponent_milli) == (1, 1, 50000, 5000, 10000)


def test_no_rows(frame):
    assert runs.periodic_runs(frame([])).count() == 0
