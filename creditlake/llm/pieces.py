"""Byte-level BPE vocabularies: the split of texts into pieces, and a cache of the ids of pieces already seen.

A byte-level BPE merges inside pieces only, so equal pieces have equal ids. ``PieceCoder`` splits a chunk of documents
with numpy, gives each distinct new piece to ``encode`` once, and puts the ids of the documents together from the cache.
Pieces are found by hash and compared character by character, so a hash collision can't change a result. The cache
holds ``max_entries`` pieces and what one chunk adds to them, and starts anew beyond that. ``encode`` takes pieces and
returns all their ids, one piece after another, with the number of ids of each.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import regex

from .common import ranges, span_hash

SPACE, LETTER, NUMBER, OTHER = range(4)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself where printable, else from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in plain else spare))
        spare += b not in plain
    return out


class Vocabulary:
    """Ids, merges and special tokens of a byte-level BPE file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        ids = spec["model"]["vocab"]
        letters = byte_letters()
        back = {c: b for b, c in enumerate(letters)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.size = 1 + max([*ids.values(), *self.special.values()])
        self.byte_ids = np.array([ids[c] for c in letters], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], np.int64)
        self.right = np.array([ids[b] for _, b in pairs], np.int64)
        self.merged = np.array([ids[a + b] for a, b in pairs], np.int64)
        keys = self.left * self.size + self.right
        self.rank_of_key = np.argsort(keys, kind="stable")
        self.keys = keys[self.rank_of_key]
        self.ranks = {int(k): r for r, k in reversed(list(enumerate(keys.tolist())))}
        text = [b""] * self.size
        for t, i in ids.items():
            text[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
        for t, i in self.special.items():
            text[i] = t.encode()
        self.token_length = np.array([len(t) for t in text], np.int64)
        self.token_start = np.concatenate([[0], np.cumsum(self.token_length)])[:-1]
        self.token_bytes = np.frombuffer(b"".join(text), np.uint8)


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(2)
def classes(path: str) -> np.ndarray:
    """The class of each code point as the library's split sees it. Unicode versions differ in characters that one of
    them doesn't know yet; for those, the library itself is asked."""
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    out = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern, probe in ((SPACE, r"\s", None), (LETTER, r"\p{L}", "x"), (NUMBER, r"\p{N}", "1")):
        for ch in regex.findall(pattern, every):
            if probe is None or unicodedata.category(ch) != "Cn" or len(split(probe + ch + probe)) == 1:
                out[ord(ch)] = kind
    return out


def split_pieces(points: np.ndarray, kinds: np.ndarray, breaks: np.ndarray) -> np.ndarray:
    """Where pieces begin. ``points``: code points; ``kinds``: their classes; ``breaks``: where a text or a stretch
    between special tokens begins. The rules are those of the GPT-2 pattern: a run of letters, numbers or other signs
    with one blank before it; white space but for its last character where something follows; short English endings
    after an apostrophe."""
    n = len(points)
    if n == 0:
        return np.zeros(0, np.int64)
    begins = breaks.copy()
    begins[0] = True
    begins[1:] |= kinds[1:] != kinds[:-1]
    runs = np.flatnonzero(begins)
    stops = np.append(runs[1:], n)
    white = (kinds[runs] == SPACE) & (stops < n)
    last = stops[white] - 1
    inside = ~breaks[last + 1]
    last = last[inside]
    begins[last] = True
    begins[last[points[last] == 32] + 1] = False
    quote = np.flatnonzero((points == 39) & begins)
    if len(quote):
        padded = np.concatenate([points, [0, 0]])
        ends = np.concatenate([breaks, [True, True]])
        one, two = padded[quote + 1], padded[np.minimum(quote + 2, n + 1)]
        same1, same2 = ~ends[quote + 1], ~ends[np.minimum(quote + 2, n + 1)]
        short = same1 & np.isin(one, [ord(c) for c in "stmd"])
        long = same1 & same2 & np.logical_or.reduce([(one == ord(a)) & (two == ord(b)) for a, b in ("re", "ve", "ll")])
        size = np.where(short, 1, np.where(long, 2, 0))
        hit, size = quote[size > 0], size[size > 0]
        # one ending may begin where another ends, never inside it: letters only
        begins[hit + 1] = False
        after = hit + 1 + size
        begins[after[after < n]] = True
    return np.flatnonzero(begins)


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self.data, self.n = np.zeros(1024, kind), 0

    def add(self, values) -> None:
        need = self.n + len(values)
        if need > len(self.data):
            self.data = np.concatenate([self.data, np.zeros(max(need, len(self.data)), self.data.dtype)])
        self.data[self.n:need] = values
        self.n = need


class PieceCoder:
    def __init__(self, path: str, encode: Callable[[Sequence[str]], tuple[np.ndarray, np.ndarray]], max_entries: int = 700_000):
        self.kinds = classes(path)
        self.special = vocabulary(path).special
        self.encode, self.max_entries = encode, max_entries
        self.reset()

    def reset(self) -> None:
        self.known: dict[int, int] = {}
        self.ids, self.ids_at, self.ids_n = Grown(np.uint32), Grown(np.int64), Grown(np.int64)
        self.chars, self.chars_at, self.chars_n = Grown(np.uint32), Grown(np.int64), Grown(np.int64)

    def add(self, pieces: list[str]) -> np.ndarray:
        """New entries for these pieces."""
        ids, counts = self.encode(pieces)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        first = self.ids_at.n
        self.ids_at.add(self.ids.n + np.cumsum(counts) - counts)
        self.ids_n.add(counts)
        self.chars_at.add(self.chars.n + np.cumsum(sizes) - sizes)
        self.chars_n.add(sizes)
        self.ids.add(ids)
        self.chars.add(np.frombuffer("".join(pieces).encode("utf-32-le"), np.uint32))
        return np.arange(first, first + len(pieces))

    def __call__(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, one text after another, and the number of ids of each text."""
        if len(self.known) > self.max_entries:
            self.reset()
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        n = len(points)
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        breaks = np.zeros(n, bool)
        breaks[offsets[:-1][offsets[:-1] < n]] = True
        marked: dict[int, int] = {}
        if n and self.special and any(s in whole for s in self.special):
            pattern = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
            for d, t in enumerate(texts):
                for m in regex.finditer(pattern, t):
                    a, b = offsets[d] + m.start(), offsets[d] + m.end()
                    breaks[a] = True
                    if b < n:
                        breaks[b] = True
                    marked[int(a)] = self.special[m[0]]
        starts = split_pieces(points, self.kinds[points], breaks)
        if marked:
            inner = np.zeros(n, bool)
            for a, i in marked.items():
                inner[a + 1:a + len(next(s for s, k in self.special.items() if k == i))] = True
            starts = starts[~inner[starts]]
        ends = np.append(starts[1:], n)[:len(starts)]
        hashes = span_hash(points, starts, ends)
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        known = self.known.get
        entry = np.array([known(h, -1) for h in distinct.tolist()], np.int64)
        new = np.flatnonzero(entry < 0)
        if len(new):
            entry[new] = self.add([whole[a:b] for a, b in zip(starts[at[new]].tolist(), ends[at[new]].tolist(), strict=True)])
            self.known.update(zip(distinct[new].tolist(), entry[new].tolist(), strict=True))
        entry = entry[which]
        sizes = ends - starts
        same = self.chars_n.data[entry] == sizes
        within = np.arange(n) - np.repeat(starts, sizes)
        expected = self.chars.data[np.minimum(np.repeat(self.chars_at.data[entry], sizes) + within, max(self.chars.n - 1, 0))]
        wrong = np.flatnonzero(expected != points)
        if len(wrong):
            same[np.searchsorted(starts, wrong, "right") - 1] = False
        odd = np.flatnonzero(~same)
        if len(odd):
            entry[odd] = self.add([whole[a:b] for a, b in zip(starts[odd].tolist(), ends[odd].tolist(), strict=True)])
        counts = self.ids_n.data[entry].copy()
        ids = self.ids.data[ranges(self.ids_at.data[entry], counts)]
        if marked:
            at_piece = np.searchsorted(starts, np.array(sorted(marked)))
            begin = np.concatenate([[0], np.cumsum(counts)])
            keep = np.ones(len(ids), bool)
            for p, a in zip(at_piece.tolist(), sorted(marked), strict=True):
                ids[begin[p]] = marked[a]
                keep[begin[p] + 1:begin[p + 1]] = False
                counts[p] = 1
            ids = ids[keep]
        piece = np.searchsorted(starts, offsets)
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(total[piece])
