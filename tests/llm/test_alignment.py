"""Alignment of two vocabularies, against both libraries on whole texts."""

import hashlib
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from creditlake.llm import alignment
from creditlake.llm.pieces import default_vocabulary, vocabulary

from llm_frames import frame  # noqa: F401

A, B = alignment.byte_library(default_vocabulary()), alignment.piece_library(alignment.default_pieces())
TEXTS = ["", "Hello world", " two  blanks \n\n  after\tlines  ", "x", " ", "   ", "it's naïve — 你好 🙂 1234", "<|endoftext|> <s> </s> <unk> <0x41>", "a\x00b", "▁ mark", "no ▁", "a  b  c　  d",
         "quoted” word” \u0085 x", "word " * 900, "=" * 300, "Straße Ünïcödé schön", "﻿mark", "é a"]


def brute(text):
    """(groups, links, A ids, B ids) of one text."""
    text = text or ""
    if not text:
        return [], [], 0, 0
    v = vocabulary(default_vocabulary())
    raw = v.token_bytes.tobytes()
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    a_bytes = [raw[v.token_start[i]:v.token_start[i] + v.token_length[i]] for i in a]
    b_bytes = [alignment.piece_bytes(alignment.default_pieces())[i] for i in b]
    if b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
        return [], [], 0, 0
    ends = []
    for parts in (a_bytes, b_bytes):
        at, out = 0, []
        for p in parts:
            at += len(p)
            out.append(at)
        ends.append(out)
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        ni, nj = ends[0].index(end) + 1, ends[1].index(end) + 1
        groups.append((a[i:ni], b[j:nj]))
        i, j = ni, nj
    return groups, [(g[-1], h[-1]) for g, h in groups], len(a), len(b)


def wanted(rows):
    each = [(d, brute(t)) for d, t in rows]
    count = Counter(link for _, (_, links, _, _) in each for link in links)
    top = {}
    for (_, b), n in count.items():
        top[b] = max(top.get(b, 0), n)
    out = []
    for d, (groups, links, na, nb) in each:
        text = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        out.append((str(d), na, nb, len(groups), len(links), sum(count[x] == top[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if na else ""))
    return sorted(out), count


@pytest.mark.parametrize("hot", [0, 50, alignment.HOT])
def test_rows(frame, hot):
    rows = [(i, t) for i, t in enumerate(TEXTS * 2)] + [(3, "again"), (3, "again"), (None, "no id"), (90, None)]
    got, pairs = alignment.aligned(frame(rows).repartition(3), hot_pairs=hot)
    want, count = wanted(rows)
    assert sorted((str(r[0]), *r[1:]) for r in got.collect()) == want
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(count) and pairs.count() == len(count)
    assert any(r[1] for r in want) and sum(r[1] == 0 for r in want) > 4


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\tabc1.'é▁  "), st.characters(exclude_categories=["Cs"])), min_size=1, max_size=80))
def test_any_text(text):
    import numpy as np
    import pyarrow as pa

    from creditlake.llm.common import utf8
    data, offsets = utf8(pa.array([" " + text]))
    known = alignment.StretchAligner(default_vocabulary(), alignment.default_pieces())
    start = alignment.boundaries(data, offsets)
    entry = known.cache(data, start, np.append(start[1:], len(data)))
    groups, links, na, nb = brute(text)
    if (known.numbers[2].data[entry] < 0).any():
        assert na == 0
        return
    assert [int(g.data[entry].sum()) for g in known.numbers] == [na, nb, len(groups)]
    digits = b"".join(known.text.data[a:a + n].tobytes() for a, n in zip(known.text_at.data[entry], known.text_n.data[entry]))
    assert digits.decode() == "".join(f"{','.join(map(str, g))}|{','.join(map(str, h))};" for g, h in groups)
    got = [int(x) for a, n in zip(known.link_at.data[entry], known.link_n.data[entry]) for x in known.links.data[a:a + n]]
    assert [(x >> 20, x & 0xFFFFF) if x >= 0 else (-1 - x, int(known.same[-1 - x])) for x in got] == links


def test_no_rows(frame):
    got, pairs = alignment.aligned(frame([]))
    assert got.count() == 0 and pairs.count() == 0
