"""Operator 3: language of words and texts by a linear-chain conditional random field.

A word's features are the runs of 1 to 4 bytes of the lower-cased word between two marks (runs that touch a mark are its
affixes) and the word itself (lexicon), hashed into one table of weights per language. Chains are sentences; transitions
between neighbouring words are learned. Forward-backward gives each word the probability of each language, so texts
that switch languages are labelled word by word. A text's language is the one with the largest sum over its words; its score
is the mean probability of that language.

Training takes at most ``max_rows`` rows with text and lang outside the held-out fifth, those with the smallest hash of
doc_id, of texts up to ``max_bytes`` bytes. Rows name one language each, so chains are made of sentences of random rows put
one after another: transitions see switches as well as runs.

Defined results: a null text, or one without a letter, gets `und` with score 0, and no words. Without training rows every
text is `und`. Ties go to the language first in order. Repeated rows give one row each; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, held_out, map_arrow, ranges, span_hash, table, utf8

BITS = 17
MAX_ROWS = 1500
MAX_BYTES = 1 << 18
#: Bytes that end a word: all ASCII but letters.
NOT_LETTER = np.ones(256, bool)
NOT_LETTER[65:91] = NOT_LETTER[97:123] = NOT_LETTER[128:] = False
STOP = np.zeros(256, bool)
STOP[[10, 33, 46, 63]] = True


@dataclass
class Chunk:
    """Distinct words with their features, and the sentences of some texts."""

    words: Words
    word: np.ndarray  # the distinct word of each word
    features: np.ndarray  # of the distinct words, one after another
    first: np.ndarray  # where those of each distinct word begin (with the end at last)
    begin: np.ndarray  # first word of each sentence
    length: np.ndarray


def prepare(data: np.ndarray, offsets: np.ndarray) -> Chunk:
    """``data`` is lower-case."""
    words = Words(data, offsets, NOT_LETTER)
    _, at, word = np.unique(words.hash, return_index=True, return_inverse=True)
    start, size = words.start[at], words.end[at] - words.start[at]
    padded_at = np.cumsum(size + 2) - size - 2
    padded = np.zeros(int((size + 2).sum()), np.uint32)
    padded[ranges(padded_at + 1, size)] = data[ranges(start, size)]
    padded[padded_at + size + 1] = 1
    rolled = np.zeros(len(padded), np.uint32)
    left = np.repeat(padded_at + size + 2, size + 2) - np.arange(len(padded))
    owner, feature = [], []
    number = np.repeat(np.arange(len(at)), size + 2)
    for order in range(1, 5):
        n = len(padded) - order + 1
        if n <= 0:
            break
        rolled[:n] = rolled[:n] * np.uint32(0x01000193) + padded[order - 1:] + np.uint32(7)
        whole = left[:n] >= order
        hashed = (rolled[:n][whole] + np.uint32(order)) * np.uint32(0x9E3779B1)
        owner.append(number[:n][whole])
        feature.append(hashed >> np.uint32(32 - BITS))
    owner.append(np.arange(len(at)))
    feature.append((span_hash(data, start, start + size) >> np.uint64(64 - BITS)).astype(np.uint32))
    owner_all, feature_all = np.concatenate(owner), np.concatenate(feature).astype(np.int64)
    order = np.argsort(owner_all, kind="stable")
    first = np.searchsorted(owner_all[order], np.arange(len(at) + 1))
    marks = np.concatenate([[0], np.cumsum(STOP[data])])
    new = np.ones(len(words.start), bool)
    if len(new):
        new[1:] = (words.doc[1:] != words.doc[:-1]) | (marks[words.start[1:]] > marks[words.end[:-1]])
    begin = np.flatnonzero(new)
    return Chunk(words, word, feature_all[order], first, begin, np.diff(np.append(begin, len(new))))


def emissions(c: Chunk, weights: np.ndarray) -> np.ndarray:
    """Scores of the distinct words: the mean weight of their features, times 8."""
    if not len(c.first) - 1:
        return np.zeros((0, weights.shape[1]))
    return 8 * np.add.reduceat(weights[c.features], c.first[:-1], axis=0) / np.diff(c.first)[:, None]


def forward_backward(scores: np.ndarray, begin: np.ndarray, length: np.ndarray, transition: np.ndarray, pairs: bool = False):
    """Word marginals of all chains (rows of ``scores``: words, chain after chain), and the expected number of each transition."""
    n, k = scores.shape
    emit = np.exp(scores - scores.max(1, keepdims=True)) if n else scores
    move = np.exp(transition - transition.max())
    order = np.argsort(-length, kind="stable")
    begin, length = begin[order], length[order]
    longest = int(length.max(initial=0))
    live = np.searchsorted(-length, -np.arange(1, longest + 1), "right")  # chains with a word at t
    alpha, beta = np.empty((n, k)), np.ones((n, k))
    for t in range(longest):
        at = begin[:live[t]] + t
        a = emit[at] if t == 0 else (alpha[at - 1] @ move) * emit[at]
        alpha[at] = a / a.sum(1, keepdims=True)
    expected = np.zeros((k, k))
    for t in range(longest - 2, -1, -1):
        at = begin[:live[t + 1]] + t
        ahead = emit[at + 1] * beta[at + 1]
        b = ahead @ move.T
        beta[at] = b / b.sum(1, keepdims=True)
        if pairs:
            joint = alpha[at][:, :, None] * move * ahead[:, None, :]
            expected += (joint / joint.sum((1, 2), keepdims=True)).sum(0)
    marginal = alpha * beta
    return marginal / np.maximum(marginal.sum(1, keepdims=True), 1e-300), expected


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray
    transition: np.ndarray

    def label(self, c: Chunk) -> np.ndarray:
        """Probability of each language for each word."""
        return forward_backward(emissions(c, self.weights)[c.word], c.begin, c.length, self.transition)[0]


def lower_utf8(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    raw = [(t or "").lower().encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


def fit(texts: list[str], labels: list[str], epochs: int = 3, batch: int = 400, rate: float = 0.05, seed: int = 11) -> LanguageModel:
    languages = sorted(set(labels))
    k = len(languages)
    weights, transition = np.zeros((1 << BITS, k), np.float32), np.zeros((k, k))
    if k == 0:
        return LanguageModel([], weights, transition)
    data, offsets = lower_utf8(texts)
    c = prepare(data, offsets)
    gold = np.array([languages.index(x) for x in labels])[c.words.doc]
    draw = np.random.default_rng(seed)
    square, square_t = np.full_like(weights, 1e-6), np.full_like(transition, 1e-6)
    for _ in range(epochs):
        order = draw.permutation(len(c.begin))
        for lo in range(0, len(order), batch):
            mine = order[lo:lo + batch]
            words = ranges(c.begin[mine], c.length[mine])
            joined = np.maximum(1, len(mine) // 3)  # about three sentences make one chain
            cut = np.sort(np.append(0, draw.choice(np.arange(1, len(mine)), joined - 1, replace=False))) if joined > 1 else np.array([0])
            at = np.cumsum(c.length[mine]) - c.length[mine]
            begin = at[cut]
            length = np.diff(np.append(begin, len(words)))
            distinct, local = np.unique(c.word[words], return_inverse=True)
            sizes = c.first[distinct + 1] - c.first[distinct]
            features = c.features[ranges(c.first[distinct], sizes)]
            local_first = np.cumsum(sizes) - sizes
            scores = 8 * np.add.reduceat(weights[features], local_first, axis=0) / sizes[:, None]
            marginal, expected = forward_backward(scores[local].astype(float), begin, length, transition, True)
            truth = gold[words]
            marginal[np.arange(len(words)), truth] -= 1
            inner = np.ones(len(words), bool)
            inner[begin] = False
            inner = np.flatnonzero(inner)
            observed = np.bincount(truth[inner - 1] * k + truth[inner], minlength=k * k).reshape(k, k)
            slope_t = (expected - observed) / len(words) + 1e-4 * transition
            square_t += slope_t ** 2
            transition -= rate * slope_t / np.sqrt(square_t)
            for label in range(k):
                each = np.bincount(local, marginal[:, label], len(distinct)) * 8 / sizes / len(words)
                slope = np.bincount(features, np.repeat(each, sizes), 1 << BITS).astype(np.float32)
                slope += np.float32(1e-6) * weights[:, label] * (slope != 0)
                square[:, label] += slope ** 2
                weights[:, label] -= np.float32(rate) * slope / np.sqrt(square[:, label])
    return LanguageModel(languages, weights, transition)


def training_rows(docs: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """text and lang of at most ``max_rows`` rows. They are drawn by their ids; only theirs are the texts that move."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")) \
        .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out() & (F.octet_length("text") <= max_bytes))
    marked = rows.withColumn("mark", F.xxhash64("text"))
    drawn = marked.select("doc_id", "lang", "mark").orderBy(F.xxhash64("doc_id"), "doc_id", "lang", "mark").limit(max_rows)
    return marked.join(F.broadcast(drawn.distinct()), ["doc_id", "lang", "mark"]).groupBy("doc_id", "lang", "mark").agg(F.min("text").alias("text")).select("text", "lang")


def train(docs: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> LanguageModel:
    rows = training_rows(docs, max_rows, max_bytes).collect()  # at most max_rows
    rows.sort()
    return fit([r.text for r in rows], [r.lang for r in rows])


def score_chunk(batch: pa.RecordBatch, model: LanguageModel, spans: bool) -> pa.RecordBatch:
    texts = batch.column(1).to_pylist()
    letter = np.array(batch.column(2).fill_null(False).to_pylist(), bool)
    n, k = len(texts), len(model.languages)
    data, offsets = lower_utf8([t if ok else "" for t, ok in zip(texts, letter, strict=True)])
    c = prepare(data, offsets)
    p = model.label(c) if k else np.zeros((len(c.word), 0))
    count = np.bincount(c.words.doc, minlength=n)
    total = np.stack([np.bincount(c.words.doc, p[:, j], n) for j in range(k)], 1) if k else np.zeros((n, 1))
    best = total.argmax(1)
    ok = letter & (count > 0) & (k > 0)
    score = np.where(ok, total[np.arange(n), best] / np.maximum(count, 1), 0.0).clip(0, 1)
    names = [model.languages[b] if o else "und" for b, o in zip(best.tolist(), ok.tolist(), strict=True)]
    columns, heads = [batch.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"]
    if spans:
        word = p.argmax(1) if k else np.zeros(0, np.int64)
        new = np.ones(len(word), bool)
        if len(word):
            new[1:] = (word[1:] != word[:-1]) | (c.words.doc[1:] != c.words.doc[:-1])
        at = np.flatnonzero(new)
        stop = np.append(at[1:], len(word))[:len(at)]
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        base = chars[offsets[c.words.doc[at]]] if len(at) else at
        sure = np.add.reduceat(p.max(1), at) / (stop - at) if len(at) else np.zeros(0)
        struct = pa.StructArray.from_arrays([pa.array([model.languages[w] for w in word[at]], pa.string()), pa.array(chars[c.words.start[at]] - base, pa.int32()),
                                             pa.array(chars[c.words.end[stop - 1]] - base, pa.int32()), pa.array(stop - at, pa.int32()), pa.array(sure, pa.float64())],
                                            ["lang", "start", "end", "words", "score"])
        ends = np.searchsorted(c.words.doc[at], np.arange(n + 1))
        columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), struct))
        heads.append("spans")
    return pa.RecordBatch.from_arrays(columns, heads)


SPANS = "spans array<struct<lang: string, start: int, end: int, words: int, score: double>>"


def predict(docs: DataFrame, model: LanguageModel, spans: bool = False) -> DataFrame:
    """doc_id, lang_pred and score of each document; with ``spans`` also the runs of words of one language (character
    positions in the lower-cased text, mean probability)."""
    text = F.col("text").cast("string")
    rows = docs.select(F.col("doc_id"), text.alias("text"), text.rlike(r"\p{L}").alias("letter"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, lambda b: score_chunk(b, model, spans), f"doc_id {kind}, lang_pred string, score double" + (f", {SPANS}" if spans else ""))


def op3_language(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    found = predict(docs, train(docs))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
