"""Operator 7: text quality by a support vector machine on naive Bayes features.

Features are indicators of n-grams (runs of 1, 2, 3 and 5 bytes of the whole text, hashed) and of how much a text repeats its
own word n-grams. Each indicator is scaled by its class log-count ratio, a document's vector is scaled to length 1, and a
linear model of hinge loss is fitted by dual coordinate descent. Margins become probabilities by a logistic curve
fitted on margins of held-apart folds of the training rows.

The fit uses at most ``max_rows`` labelled rows, those with the smallest hash of doc_id, of texts up to ``max_bytes`` bytes, as far
as all of them together have up to ``max_total`` bytes (a byte makes at most four features, so that bounds the driver's memory);
everything is scored on its whole text. Of rows with one doc_id the first text in order is learned from. Labels of one doc_id that disagree count as their majority (tie: 0).

Defined results: null and empty texts have no n-gram, only the indicators of an empty text, and get a score like any
other. Without labelled rows of both classes every score is the share of label 1 (no labels at all: 1). Repeated rows
give one row each. Extra columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import SPACES, Words, held_out, map_arrow, table, utf8

ORDERS = (1, 2, 3, 5)
BITS = 16
SIZE = len(ORDERS) * (1 << BITS) + 512
MAX_ROWS = 5000
MAX_BYTES = 1 << 20
MAX_TOTAL = 16 << 20


def indicator_pairs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (row, feature) pairs of a chunk."""
    n_docs = len(offsets) - 1
    rows, features = [], []
    owner = np.repeat(np.arange(n_docs), np.diff(offsets))
    left = offsets[1:][owner] - np.arange(len(data))
    rolled = np.zeros(len(data), np.uint32)
    done = 0
    for k, order in enumerate(ORDERS):
        n = len(data) - order + 1
        if n <= 0:
            break
        for j in range(done, order):
            rolled[:n] = rolled[:n] * np.uint32(0x01000193) + data[j:j + n] + np.uint32(1)
        done = order
        whole = left[:n] >= order
        hashed = (rolled[:n][whole] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        doc, feature = distinct(owner[:n][whole], hashed.astype(np.int64), n_docs, 1 << BITS)
        rows.append(doc)
        features.append(feature + (k << BITS))
    doc, feature = repetition(data, offsets)
    rows.append(doc)
    features.append(feature + (len(ORDERS) << BITS))
    return np.concatenate(rows), np.concatenate(features)


def distinct(doc: np.ndarray, feature: np.ndarray, n_docs: int, n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs; ``doc`` ascends."""
    if len(doc) < 400 * n_docs:  # short texts: sort them all at once
        keys = np.unique(doc * n_features + feature)
        return keys // n_features, keys % n_features
    keep = np.zeros(len(doc), bool)
    last = np.zeros(n_features, np.int64)
    bounds = np.searchsorted(doc, np.arange(n_docs + 1)).tolist()
    places = np.arange(len(doc))
    for a, b in zip(bounds, bounds[1:], strict=False):
        mine = feature[a:b]
        last[mine] = places[a:b]
        keep[a:b] = last[mine] == places[a:b]
    return doc[keep], feature[keep]


def repetition(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indicators of the share of repeated word 1- and 3-grams, of capitals and of signs, and of length: at most 512 values."""
    n_docs = len(offsets) - 1
    words = Words(data, offsets)
    count = np.diff(words.first)
    out = [np.minimum(np.ceil(np.log2(count + 1)), 31).astype(np.int64)]
    for k, base in ((1, 32), (3, 64)):
        hashed, doc, _ = words.grams(k)
        total = np.bincount(doc, minlength=n_docs)
        order = np.lexsort((hashed, doc))
        h, d = hashed[order], doc[order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
        share = 1 - np.bincount(d[first], minlength=n_docs) / np.maximum(total, 1)
        out.append(base + np.where(total == 0, 0, 1 + np.minimum(share * 20, 19)).astype(np.int64))
    again = np.zeros(len(words.hash), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (words.doc[1:] == words.doc[:-1])
    out.append(192 + np.minimum(np.sqrt(np.bincount(words.doc, again, n_docs) / np.maximum(count, 1)) * 24, 23).astype(np.int64))
    upper = (data >= 65) & (data <= 90)
    sign = ((data > 32) & (data < 48)) | ((data > 57) & (data < 65)) | ((data > 90) & (data < 97)) | ((data > 122) & (data < 128))
    for flag, base in ((upper, 96), (sign, 128), (SPACES[data], 160)):
        share = np.diff(np.concatenate([[0], np.cumsum(flag)])[offsets]) / np.maximum(np.diff(offsets), 1)
        out.append(base + np.minimum(np.sqrt(share) * 24, 23).astype(np.int64))
    return np.repeat(np.arange(n_docs), len(out)), np.stack(out, 1).ravel()


def dual_coordinate_descent(x: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, cost: float = 1.0, epochs: int = 20, seed: int = 7) -> np.ndarray:
    """Weights (bias last) of the hinge loss; rows as (features, values), labels -1 and 1. Each dual variable stays within 0 and
    ``cost``; the descent ends where no slope that points inside that range is left."""
    w = np.zeros(SIZE + 1)
    alpha = np.zeros(len(x))
    square = np.array([float(v @ v) + 1 for _, v in x])
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        worst = 0.0
        for i in order.permutation(len(x)):
            f, v = x[i]
            slope = y[i] * (float(w[f] @ v) + w[-1]) - 1
            step = min(max(alpha[i] - slope / square[i], 0.0), cost) - alpha[i]
            if step:
                alpha[i] += step
                w[f] += step * y[i] * v
                w[-1] += step * y[i]
                worst = max(worst, abs(step))
        if worst < 1e-3:
            break
    return w


def log_count_ratio(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    total = []
    for label in (1, -1):
        mine = [f for f, k in zip(rows, y, strict=True) if k == label]
        p = np.ones(SIZE)
        for lo in range(0, len(mine), 256):  # a part at a time: the driver need not hold all of them once more
            p += np.bincount(np.concatenate(mine[lo:lo + 256]), minlength=SIZE)
        total.append(p / p.sum())
    return np.log(total[0] / total[1])


def scaled(rows: list[np.ndarray], ratio: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    out = []
    for f in rows:
        v = ratio[f]
        out.append((f, (v / max(math.sqrt(float(v @ v)), 1e-9)).astype(np.float32)))
    return out


def logistic_curve(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the likeliest logistic curve through smoothed labels, by Newton steps."""
    n1, n0 = (y > 0).sum(), (y < 0).sum()
    target = np.where(y > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g = np.array([((p - target) * margin).sum() + 1e-6 * a, (p - target).sum()])
        s = p * (1 - p) + 1e-9
        h = np.array([[(s * margin * margin).sum() + 1e-6, (s * margin).sum()], [(s * margin).sum(), s.sum()]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-7:
            break
    return float(a), float(b)


@dataclass
class QualityModel:
    ratio: np.ndarray
    weight: np.ndarray  # ratio times weight: what an indicator adds before scaling to length 1
    bias: float
    slope: float
    shift: float

    def scores(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        doc, feature = indicator_pairs(data, offsets)
        total = np.bincount(doc, self.weight[feature], n)
        length = np.sqrt(np.bincount(doc, self.ratio[feature] ** 2, n))
        return 1 / (1 + np.exp(-np.clip(self.slope * (total / np.maximum(length, 1e-9) + self.bias) + self.shift, -30, 30)))


def fit(rows: list[np.ndarray], labels: np.ndarray, folds: int = 3) -> QualityModel:
    """From the features and the labels (0, 1) of the training rows."""
    y = np.where(labels > 0, 1, -1)
    if min((y > 0).sum(), (y < 0).sum()) < folds:
        share = float((y > 0).mean()) if len(y) else 1.0
        p = min(max(share, 1e-9), 1 - 1e-9)
        return QualityModel(np.zeros(SIZE), np.zeros(SIZE), 0.0, 0.0, math.log(p / (1 - p)))
    margin = np.zeros(len(y))
    fold = np.zeros(len(y), int)
    for label in (1, -1):
        at = np.flatnonzero(y == label)
        fold[at] = np.arange(len(at)) % folds
    for k in range(folds):
        train, test = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
        ratio = log_count_ratio([rows[i] for i in train], y[train])
        w = dual_coordinate_descent(scaled([rows[i] for i in train], ratio), y[train])
        margin[test] = [float(w[f] @ v) + w[-1] for f, v in scaled([rows[i] for i in test], ratio)]
    slope, shift = logistic_curve(margin, y)
    ratio = log_count_ratio(rows, y)
    w = dual_coordinate_descent(scaled(rows, ratio), y)
    return QualityModel(ratio, ratio * w[:-1], float(w[-1]), slope, shift)


def row_features(batch: pa.RecordBatch) -> pa.RecordBatch:
    data, offsets = utf8(batch.column(0))
    doc, feature = indicator_pairs(data, offsets)
    order = np.argsort(doc, kind="stable")
    ends = np.searchsorted(doc[order], np.arange(len(offsets)))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(feature[order], pa.int32()))
    return pa.RecordBatch.from_arrays([lists, batch.column(1)], ["features", "label"])


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES, max_total: int = MAX_TOTAL) -> DataFrame:
    """text and label of at most ``max_rows`` labelled documents outside the held-out fifth, of up to ``max_total`` bytes in all."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")) \
        .filter(F.col("quality").isin(0, 1) & ~held_out())
    drawn = known.groupBy("doc_id").agg((F.avg("quality") > 0.5).cast("int").alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)  # so at most max_rows rows are broadcast
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(size <= max_bytes)
    # at most max_rows pairs of numbers in one task
    before = W.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(W.unboundedPreceding, W.currentRow)
    sizes = rows.select("doc_id", size.cast("long").alias("bytes")).join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "label").agg(F.max("bytes").alias("bytes"))
    drawn = sizes.withColumn("total", F.sum("bytes").over(before)).filter(F.col("total") <= max_total).select("doc_id", "label")
    rows = rows.join(F.broadcast(drawn), "doc_id")
    return rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).orderBy("doc_id").select("text", "label")


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> QualityModel:
    rows = map_arrow(training_rows(docs, labels, max_rows, max_bytes), row_features, "features array<int>, label int").toArrow()
    labels_seen = rows.column("label").to_numpy().astype(int)
    features = pa.chunked_array(rows.column("features").chunks, pa.list_(pa.int32())).combine_chunks() if len(rows) else pa.array([], pa.list_(pa.int32()))
    flat, at = features.values.to_numpy(), features.offsets.to_numpy()
    return fit([flat[at[i]:at[i + 1]] for i in range(len(labels_seen))], labels_seen)


def score(docs: DataFrame, model: QualityModel, keep: list[str] | None = None, name: str = "score") -> DataFrame:
    """The columns ``keep`` (default: doc_id) of each document with its score, in a column of that ``name``."""
    keep = ["doc_id"] if keep is None else keep
    once = "text" in keep and dict(docs.dtypes)["text"] == "string"  # a kept text goes through once
    rows = docs.select(*keep) if once else docs.select(*keep, F.col("text").cast("string").alias("__text"))
    place = keep.index("text") if once else len(keep)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema.fields)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        scores = model.scores(*utf8(batch.column(place)))
        return pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(scores, pa.float64())], [*batch.schema.names[:len(keep)], name])

    return map_arrow(rows, run, f"{fields}, `{name}` double", place)


def op7_quality(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents")
    scored = score(docs, train(docs, table(spark, root, "labels")))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
