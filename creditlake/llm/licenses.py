"""Operator 4: licence notices in texts by a trained paragraph classifier.

Paragraphs are the lines of a text and, for notices that are wrapped or stand inside other text, windows of ``WINDOW`` words every
``STEP`` words. Features are word 1-, 2- and 3-grams (A-Z as a-z, outer signs cut off) of the templates, each counted and divided
by the root of the paragraph's number of n-grams. A multinomial logistic regression tells the families and the class of
other text apart. It is trained on variants of the templates (words left out, cut or framed by corpus words), and, as other
text, paragraphs of at most ``max_rows`` documents and templates with their words shuffled. A temperature fitted on variants
held apart calibrates its probabilities. A prediction counts where other text is less likely than ``threshold`` and a template of the
family confirms it: ``similarity`` of the 2-grams of the shorter one are in the other.

Defined results: null and empty texts have no findings. Overlapping findings of one text give the likeliest one (tie: the
shortest, then the first). Without documents nothing is fitted from the corpus and there are no findings. Repeated rows each give
their findings; a null doc_id stays null. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BASE, LOWER, SPACES, map_arrow, mix, span_hash, table, utf8
from .license_texts import TEMPLATES

ORDERS = 3
WINDOW, STEP = 16, 4
MAX_ROWS, MAX_BYTES = 400, 1 << 18
THRESHOLD, SIMILARITY = 0.5, 0.6
OTHER = "other"
#: Signs that words are freed of on both sides.
SIGNS = np.zeros(256, bool)
SIGNS[[b for b in range(33, 128) if not chr(b).isalnum()]] = True


@dataclass
class Paragraphs:
    grams: list[np.ndarray]  # hash of the n-gram that begins at each word, by order; only where it lies in one text
    at: list[np.ndarray]  # the word it begins at
    start: np.ndarray  # bytes of the words
    end: np.ndarray
    lo: np.ndarray  # first word and end of each paragraph
    hi: np.ndarray
    row: np.ndarray


def paragraphs(data: np.ndarray, offsets: np.ndarray, windows: bool = True) -> Paragraphs:
    folded = LOWER[data]
    n = len(data)
    gap = SPACES[data]
    inner = ~gap
    begins, stops = inner.copy(), inner.copy()
    if n:
        begins[1:] &= gap[:-1]
        stops[:-1] &= gap[1:]
        edge = offsets[1:-1]
        edge = edge[(edge > 0) & (edge < n)]
        begins[edge] |= inner[edge]
        stops[edge - 1] |= inner[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    sign = SIGNS[data]
    # first and last byte of each word that is no sign
    plain = np.flatnonzero(inner & ~sign)
    first = np.searchsorted(plain, start)
    last = np.searchsorted(plain, end)
    core = last > first
    start, end = start[core], end[core]
    core_start, core_end = plain[first[core]], plain[last[core] - 1] + 1
    hashed = span_hash(folded, core_start, core_end)
    first_word = np.searchsorted(start, offsets)
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(first_word))
    grams, at = [], []
    rolled = np.zeros(len(hashed), np.uint64)
    for order in range(1, ORDERS + 1):
        m = len(hashed) - order + 1
        if m <= 0:
            grams.append(np.zeros(0, np.uint64))
            at.append(np.zeros(0, np.int64))
            continue
        rolled = mix(rolled[:m] * np.uint64(BASE) + hashed[order - 1:] + np.uint64(order))
        whole = row_of[:m] == row_of[order - 1:]
        grams.append(rolled[whole])
        at.append(np.flatnonzero(whole))
    lines = np.concatenate([[0], np.cumsum(data == 10)])[start] if len(start) else np.zeros(0, np.int64)
    new = np.ones(len(start), bool)
    if len(start):
        new[1:] = (lines[1:] != lines[:-1]) | (row_of[1:] != row_of[:-1])
    lo = np.flatnonzero(new)
    hi = np.append(lo[1:], len(start))[:len(lo)]
    if windows and len(start):
        inside = np.arange(len(start)) - first_word[row_of]
        more = np.flatnonzero((inside % STEP == 0) & (first_word[row_of + 1] - np.arange(len(start)) > STEP))
        lo = np.concatenate([lo, more])
        hi = np.concatenate([hi, np.minimum(more + WINDOW, first_word[row_of[more] + 1])])
    return Paragraphs(grams, at, start, end, lo, hi, row_of[lo] if len(start) else np.zeros(0, np.int64))


def chunk_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    raw = [t.encode() for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)


@dataclass
class LicenseModel:
    families: list[str]  # the last is other text
    known: np.ndarray  # sorted hashes of the templates' n-grams
    weights: np.ndarray  # n-grams x classes
    bias: np.ndarray
    temperature: float
    pairs: dict[str, list[set[int]]]  # the 2-grams of each template

    def look_up(self, hashed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.known, hashed), len(self.known) - 1)
        hit = np.flatnonzero(self.known[at] == hashed)
        return hit, at[hit]

    def logits(self, p: Paragraphs) -> np.ndarray:
        out = np.zeros((len(p.lo), len(self.families)))
        for order, (hashed, at) in enumerate(zip(p.grams, p.at, strict=True), 1):
            hit, feature = self.look_up(hashed)
            place = at[hit]
            total = np.concatenate([np.zeros((1, len(self.families))), np.cumsum(self.weights[feature], axis=0)])
            a = np.searchsorted(place, p.lo)
            b = np.maximum(np.searchsorted(place, p.hi - order + 1), a)
            out += total[b] - total[a]
        return out / np.sqrt(n_grams(p))[:, None] + self.bias

    def probabilities(self, p: Paragraphs) -> np.ndarray:
        return softmax(self.logits(p) / self.temperature)


def n_grams(p: Paragraphs) -> np.ndarray:
    words = p.hi - p.lo
    return np.maximum(sum(np.maximum(words - k, 0) for k in range(ORDERS)), 1)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(1, keepdims=True)) if len(x) else x
    return e / e.sum(1, keepdims=True) if len(x) else x


def variants(text: str, filler: list[str], draw: np.random.Generator, n: int) -> list[str]:
    words = text.split()
    out = [text, text.lower(), text.upper()]
    while len(out) < n:
        mine = [w for w in words if len(words) < 5 or draw.random() > 0.08]
        if len(mine) > 14 and draw.random() < 0.5:
            a = int(draw.integers(0, len(mine) - 12))
            mine = mine[a:a + int(draw.integers(12, WINDOW + 1))]
        side = int(draw.integers(0, 4)) if draw.random() < 0.5 else 0
        frame = [filler[int(i)] for i in draw.integers(0, len(filler), 2 * side)] if filler else []
        out.append(" ".join([*frame[:side], *mine, *frame[side:]]))
    return out


def fit(corpus: list[str], seed: int = 23, each: int = 24, epochs: int = 20, others: int = 5000) -> LicenseModel:
    draw = np.random.default_rng(seed)
    families = [*TEMPLATES, OTHER]
    filler = [w for t in corpus[:50] for w in t.split()][:5000]
    texts, labels = [], []
    for number, family in enumerate(TEMPLATES):
        for template in TEMPLATES[family]:
            made = variants(template, filler, draw, each)
            texts += made
            labels += [number] * len(made)
            words = template.split()
            if len(words) > 5:
                for _ in range(3):
                    texts.append(" ".join(draw.permutation(words)))
                    labels.append(len(families) - 1)
    templates = [t for family in TEMPLATES.values() for t in family]
    p = paragraphs(*chunk_of(templates), windows=False)
    known = np.unique(np.concatenate(p.grams))
    pairs = {f: [bigrams(paragraphs(*chunk_of([t]), windows=False)) for t in TEMPLATES[f]] for f in TEMPLATES}
    model = LicenseModel(families, known, np.zeros((len(known), len(families))), np.zeros(len(families)), 1.0, pairs)
    p, q = paragraphs(*chunk_of(texts), windows=False), paragraphs(*chunk_of(corpus))
    keep = np.sort(draw.choice(len(q.lo), min(len(q.lo), others), replace=False))
    keep = keep[confirmation(q, pairs, keep) < SIMILARITY]  # notices in the corpus are not other text
    x = np.concatenate([dense(model, p, np.arange(len(p.lo))), dense(model, q, keep)])
    y = np.concatenate([np.array(labels)[p.row], np.full(len(keep), len(families) - 1)])
    apart = draw.random(len(y)) < 0.2
    train = np.flatnonzero(~apart)
    w, b = np.zeros((len(known), len(families)), np.float32), np.zeros(len(families), np.float32)
    mw, vw, mb, vb, step = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b), 0
    for _ in range(epochs):
        order = draw.permutation(train)
        for lo in range(0, len(order), 512):
            i = order[lo:lo + 512]
            error = softmax(x[i] @ w + b)
            error[np.arange(len(i)), y[i]] -= 1
            gw, gb = x[i].T @ error / len(i) + 1e-5 * w, error.mean(0)
            step += 1
            rate = 0.05 * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            mw, mb = 0.9 * mw + 0.1 * gw, 0.9 * mb + 0.1 * gb
            vw, vb = 0.999 * vw + 0.001 * gw * gw, 0.999 * vb + 0.001 * gb * gb
            w -= rate * mw / (np.sqrt(vw) + 1e-8)
            b -= rate * mb / (np.sqrt(vb) + 1e-8)
    z, t = x[apart] @ w + b, y[apart]
    losses = {h: float(-np.log(softmax(z / h)[np.arange(len(t)), t] + 1e-12).mean()) for h in np.geomspace(0.3, 5, 25)}
    model.weights, model.bias, model.temperature = w.astype(float), b.astype(float), float(min(losses, key=losses.get))
    return model


def dense(model: LicenseModel, p: Paragraphs, which: np.ndarray) -> np.ndarray:
    out = np.zeros((len(which), len(model.known)), np.float32)
    root = np.sqrt(n_grams(p))
    for order, (hashed, at) in enumerate(zip(p.grams, p.at, strict=True), 1):
        hit, feature = model.look_up(hashed)
        place = at[hit]
        for i, k in enumerate(which.tolist()):
            a, b = np.searchsorted(place, p.lo[k]), np.searchsorted(place, p.hi[k] - order + 1)
            if b > a:
                np.add.at(out[i], feature[a:b], 1 / root[k])
    return out


def bigrams(p: Paragraphs, lo: int = 0, hi: int | None = None) -> set[int]:
    a = np.searchsorted(p.at[1], lo)
    b = np.searchsorted(p.at[1], (len(p.start) if hi is None else hi) - 1)
    return set(p.grams[1][a:max(a, b)].tolist())


def likeness(mine: set[int], templates: list[set[int]]) -> float:
    return max((len(mine & t) / max(min(len(mine), len(t)), 1) for t in templates if t), default=0.0) if mine else 0.0


def confirmation(p: Paragraphs, pairs: dict[str, list[set[int]]], which: np.ndarray) -> np.ndarray:
    every = [t for f in pairs.values() for t in f]
    union = set().union(*every)
    out = np.zeros(len(which))
    for i, (a, b) in enumerate(zip(p.lo[which].tolist(), p.hi[which].tolist(), strict=True)):
        mine = bigrams(p, a, b)
        if mine & union:
            out[i] = likeness(mine, every)
    return out


def findings(model: LicenseModel, data: np.ndarray, offsets: np.ndarray, threshold: float, similarity: float) -> list[tuple[int, str, int, int, float, float]]:
    """(row, family, start, end, probability, likeness) in bytes of the chunk."""
    p = paragraphs(data, offsets)
    if not len(p.lo):
        return []
    chance = model.probabilities(p)
    by_row: dict[int, list] = {}
    for i in np.flatnonzero(chance[:, -1] < threshold).tolist():
        k = int(chance[i, :-1].argmax())
        like = likeness(bigrams(p, int(p.lo[i]), int(p.hi[i])), model.pairs[model.families[k]])
        if like >= similarity:
            a, b = int(p.start[p.lo[i]]), int(p.end[p.hi[i] - 1])
            by_row.setdefault(int(p.row[i]), []).append((-round(float(chance[i, k]), 3), b - a, a, b, model.families[k], float(chance[i, k]), like))
    out = []
    for row, found in sorted(by_row.items()):
        taken: list[tuple[int, int]] = []
        for _, _, a, b, family, chance_k, like in sorted(found):
            if all(b <= x or a >= y for x, y in taken):
                taken.append((a, b))
                out.append((row, family, a, b, chance_k, like))
    return out


COLUMNS = "family string, start long, end long, probability double, likeness double"


def train(docs: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> LicenseModel:
    rows = docs.select(F.col("doc_id").cast("string").alias("id"), F.col("text").cast("string").alias("text")) \
        .filter(F.col("id").isNotNull() & (F.octet_length("text") <= max_bytes))
    drawn = rows.select("id").orderBy(F.xxhash64("id"), "id").limit(max_rows).distinct()  # so at most max_rows rows are broadcast
    texts = rows.join(F.broadcast(drawn), "id").groupBy("id").agg(F.min("text").alias("text")).orderBy("id").collect()
    return fit([r.text for r in texts])


def find_licenses(docs: DataFrame, model: LicenseModel, threshold: float = THRESHOLD, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, family, start and end (characters), probability and likeness of every notice found."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        data, offsets = utf8(batch.column(1))
        got = findings(model, data, offsets, threshold, similarity)
        if not got:
            return None
        row, family, a, b, chance, like = (list(x) for x in zip(*got, strict=True))
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        base = chars[offsets[row]]
        return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(family), pa.array(chars[a] - base, pa.int64()), pa.array(chars[b] - base, pa.int64()),
                                           pa.array(chance, pa.float64()), pa.array(like, pa.float64())], ["doc_id", *(c.split()[0] for c in COLUMNS.split(", "))])

    return map_arrow(rows, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {COLUMNS}")


def op4_licenses(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    return find_licenses(docs, train(docs))
