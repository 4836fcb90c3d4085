"""BPE against the tokenizers library, token files against an exact round trip."""

import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from creditlake.llm import bpe, token_files
from creditlake.llm.common import scratch
from creditlake.llm.pieces import default_vocabulary, vocabulary

from llm_frames import frame  # noqa: F401

LIBRARY = Tokenizer.from_file(default_vocabulary())
TEXTS = ["", "Hello world", "it's we'll I'm''s 's they've x'd'll'", "a" * 3000, " " * 2000 + "x", "\n\n  x \t ", "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>",
         "漢字 و العربية ½²³ ǅ́", "don'T 'S x y\x85z", "=" * 200 + "word", "The house. " * 500]


def expected(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def both(texts):
    ids, counts = bpe.tree_coder(default_vocabulary())(texts)
    at = np.concatenate([[0], np.cumsum(counts)])
    return [ids[at[i]:at[i + 1]].tolist() for i in range(len(texts))]


def test_pieces_and_merges():
    assert both(TEXTS) == [expected(t) for t in TEXTS]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" '\n\tstremdvlaB1!é<|>"), st.characters(exclude_categories=["Cs"])), max_size=60), min_size=1, max_size=5))
def test_any_text(texts):
    assert both(texts) == [expected(t) for t in texts]
    assert [bpe.decode(expected(t)) for t in texts] == [LIBRARY.decode(expected(t), skip_special_tokens=False) for t in texts]


def test_merge_forms_agree():
    v = vocabulary(default_vocabulary())
    for piece in ("aaaaaaaaaaaaaaaaaaaaaaa", " international", "ñandú", "x" * 63):
        symbols = v.byte_ids[np.frombuffer(piece.encode(), np.uint8)].tolist()
        ids, counts = bpe.encode_pieces(v, [piece])
        assert bpe.PairTree(v, symbols).merge_all() == ids.tolist() and counts.tolist() == [len(ids)]


def test_cache_starts_anew():
    coder = bpe.PieceCoder(default_vocabulary(), lambda p: bpe.encode_pieces(vocabulary(default_vocabulary()), p), max_entries=3)
    for text in TEXTS:
        assert coder([text])[0].tolist() == expected(text)


def test_round_trip_of_rows(frame):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(3, "again"), (3, "again"), (None, "no id"), (90, None)]
    got = bpe.round_trip(frame(rows), digests=True).collect()
    want = sorted((str(d), len(expected(t)), hashlib.sha256(np.array(expected(t), "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert {r.decoded for r in bpe.round_trip(frame(rows)).collect()} == {t or "" for _, t in rows}
    assert bpe.round_trip(frame([])).count() == 0


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
@pytest.mark.parametrize("top", [1, 2, 300, 50257, 2 ** 32])
def test_blocks(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    if n > 9:
        ids[9] = top - 1
    file = token_files.FileReader(token_files.write_file(np.array([7]), np.array([n]), ids))
    assert (file.ids() == ids).all() and (file.ids(200, 700) == ids[200:700]).all() and file.doc_ids.tolist() == [7]


def test_broken_file():
    raw = token_files.write_file(np.array([7]), np.array([5]), np.arange(5, dtype=np.uint32))
    with pytest.raises(ValueError):
        token_files.FileReader(raw[:-1])


def test_token_table(spark, frame):
    rows = [(i * 7 % 40, TEXTS[i % len(TEXTS)]) for i in range(40)] + [(5, "twice"), (5, "twice"), (99, None), (None, "first")]
    at = scratch(spark, "files")
    token_files.write_table(frame(rows).repartition(5), at, file_ids=1000)
    got = token_files.read_table(spark, at).collect()
    start, want = 0, []
    for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = [*expected(t), token_files.END_ID]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    empty = scratch(spark, "files")
    token_files.write_table(frame([]), empty)
    assert token_files.read_table(spark, empty).count() == 0
