"""Packing: ids against the tokenizers library, plans against the volume bound, sequences without gaps."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from creditlake.llm import packing
from creditlake.llm.common import utf8

from llm_frames import frame  # noqa: F401

LIBRARY = Tokenizer.from_file(packing.default_tokenizer())
TEXTS = ["", "Hello, WORLD 1234", "it's we'll I'M''s 's they've x'd'll'sx", "a" * 3000, " " * 200 + "x", "<|endoftext|>", "a<|startoftext|>b<|EndOfText|>!<|endoftext|>c",
         "漢字 و العربية ½²³ ǅ́ é,é ,́x", "don'T 'S x y\x85z", "=" * 200 + "word", "The house, the 42 houses. " * 900, "İstanbul Ω Straße ΑΣ буквы"]


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def mine(texts, **kw):
    ids, counts = packing.WordCoder(packing.default_tokenizer(), **kw)(*utf8(pa.array(texts, pa.string())))
    at = np.concatenate([[0], np.cumsum(counts)])
    return [ids[at[i]:at[i + 1]].tolist() for i in range(len(texts))]


def test_ids():
    assert mine(TEXTS) == [expected(t) for t in TEXTS]
    coder = packing.WordCoder(packing.default_tokenizer(), max_entries=3)  # starts anew with each text
    for t in TEXTS:
        assert coder(*utf8(pa.array([t])))[0].tolist() == expected(t)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" '\n\tstremdvlaB1!é́ß<|>"), st.characters(exclude_categories=["Cs"])), max_size=60), min_size=1, max_size=5))
def test_any_text(texts):
    assert mine(texts) == [expected(t) for t in texts]


@pytest.mark.parametrize("seed", range(4))
def test_knapsack(seed):
    rng = np.random.default_rng(seed)
    price = np.zeros(61)
    kinds = rng.choice(np.arange(1, 61), 9, replace=False)
    price[kinds] = rng.random(9)
    best, last = packing.knapsack(price, 60)
    slow = [0.0]
    for c in range(1, 61):
        slow.append(max([slow[c - 1]] + [slow[c - n] + price[n] for n in kinds if n <= c]))
    assert np.allclose(best, slow)
    for c in range(61):
        one = packing.contents(last, c)
        assert sum(n * k for n, k in one.items()) <= c and np.isclose(sum(price[n] * k for n, k in one.items()), best[c])


def best_fit(need, capacity):
    room = np.zeros(capacity + 1, np.int64)  # sequences by free tokens
    for n in np.repeat(np.arange(capacity + 1), need)[::-1]:
        free = n + int((room[n:] > 0).argmax()) if room[n:].any() else capacity
        room[free] -= room[free] > 0
        room[free - n] += 1
    return int(room.sum())


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    """Every piece placed once, no sequence too full, between the dual bound and best-fit decreasing, piece by piece."""
    rng = np.random.default_rng(seed)
    capacity = 256
    need = np.zeros(capacity + 1, np.int64)
    need[1:] = rng.poisson(10 ** rng.uniform(-1, 3), capacity) * (rng.random(capacity) < rng.uniform(0.05, 1))
    need[capacity] = seed * 5
    plan = packing.plan_for(need, capacity)
    got = np.zeros_like(need)
    for one, copies in plan:
        assert copies > 0 and sum(n * k for n, k in one) <= capacity
        for n, k in one:
            got[n] += k * copies
    assert (got == need).all()
    rest = need.copy()
    rest[capacity] = 0
    least = need[capacity] + packing.fractional(rest, capacity)[1]
    assert least <= sum(copies for _, copies in plan) <= 1.01 * (need[capacity] + best_fit(rest, capacity)) + 1


def test_optimum_of_a_small_programme():
    """Lengths 6, 5, 4 and 3 in sequences of 10: the contents 6 + 4 and 5 + 5 leave nothing over."""
    need = np.zeros(11, np.int64)
    need[[6, 4, 5]] = 700, 700, 600
    assert sum(x for _, x in packing.plan_for(need, 10)) == 1000
    assert packing.plan_for(np.zeros(11, np.int64), 10) == []


@pytest.mark.parametrize("capacity", [16, 2048])
def test_rows(frame, capacity):
    rows = [(i * 7 % 40, TEXTS[i % len(TEXTS)]) for i in range(60)] + [(5, "twice"), (5, "twice"), (99, None), (None, "no id")]
    got = packing.packed(frame(rows).repartition(5), capacity=capacity).collect()
    want = []
    for d, t in rows:
        ids = [*expected(t), packing.END_ID]
        for p, at in enumerate(range(0, len(ids), capacity)):
            cut = ids[at:at + capacity]
            want.append((str(d), p, at, len(cut), zlib.crc32(np.array(cut, "<u4").tobytes())))
    assert sorted((str(r.doc_id), *r[1:5]) for r in got) == sorted(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= 1.05 * sum(r.length for r in got) / capacity + 2


def test_no_rows(frame):
    assert packing.packed(frame([])).count() == 0
