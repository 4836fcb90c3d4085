"""Trained operators: held-out accuracy, invariants and odd inputs on small tables."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditlake.llm import langid, licenses, quality, secrets
from creditlake.llm.common import held_out, stored, table

from llm_frames import frame  # noqa: F401

SF, SMALL = "/root/testdata/sf0.01", "/root/testdata/sf0.001"
ODD = [(900001, None), (900002, ""), (900003, " \n"), (900004, "12 34 !!"), (900005, "word " * 30000), (None, "no id"), (900006, "same"), (900006, "same"), (900007, "漢字 ñandú")]
KEY = "a8f5f167f44f4964e6c998dee827110c9f1b2c3d"


@pytest.fixture(scope="module")
def docs(spark):
    return table(spark, SF, "documents")


def auc(y, p):
    order = np.argsort(p, kind="stable")
    rank = np.empty(len(p))
    rank[order] = np.arange(1, len(p) + 1)
    n = y.sum()
    return (rank[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def test_quality(spark, docs, frame):
    labels = table(spark, SF, "labels")
    model = quality.train(docs, labels)
    got = quality.score(docs, model).join(labels, "doc_id").filter(held_out()).toPandas()
    assert auc(got.quality.to_numpy(), got.score.to_numpy()) > 0.95
    odd = quality.score(frame(ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert len({r.score for r in odd if r.doc_id == 900006}) == 1
    assert quality.score(frame([]), model).count() == 0
    clash = quality.score(frame(ODD), model, frame(ODD).columns, "__quality")
    assert clash.columns == [*frame(ODD).columns, "__quality"] and clash.count() == len(ODD)


def test_quality_learns_from_no_held_out_row(spark, docs):
    labels = table(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    rows = lambda x: sorted(map(tuple, quality.training_rows(docs, x).collect()))
    assert rows(labels) == rows(turned) and len(rows(labels)) <= quality.MAX_ROWS


def test_quality_without_two_classes(spark, frame):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert min(r.score for r in quality.score(frame(ODD), quality.train(frame(ODD), none)).collect()) > 0.999999
    assert quality.score(frame([]), quality.train(frame([]), none)).count() == 0


def test_dual_coordinate_descent_solves_the_primal():
    draw = np.random.default_rng(4)
    x = [(np.array([0, 1, 2]), draw.normal(size=3)) for _ in range(60)]
    y = np.array([1 if v[0] + 0.3 * v[1] > 0 else -1 for _, v in x])
    loss = lambda w, b: 0.5 * (w @ w + b * b) + sum(max(0.0, 1 - k * (v @ w + b)) for (_, v), k in zip(x, y, strict=True))
    w = quality.dual_coordinate_descent(x, y, epochs=3000)
    best = loss(w[:3], w[-1])
    assert all(loss(w[:3] + d[:3], w[-1] + d[3]) >= best - 1e-4 for d in draw.normal(scale=0.05, size=(200, 4)))


def test_training_rows_are_bounded(frame):
    rows = [(i, "word " * 20) for i in range(40)]
    labels = frame([]).sparkSession.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    every = quality.training_rows(frame(rows), labels).count()
    assert every > 20 and quality.training_rows(frame(rows), labels, max_total=1000).count() == 10
    assert quality.training_rows(frame(rows), labels, max_rows=5).count() == 5


def test_forward_backward_against_brute_force():
    draw = np.random.default_rng(3)
    scores, move = draw.normal(size=(9, 3)), draw.normal(size=(3, 3))
    begin, length = np.array([0, 4, 5]), np.array([4, 1, 4])
    marginal, expected = langid.forward_backward(scores, begin, length, move, True)
    want, pairs = np.zeros((9, 3)), np.zeros((3, 3))
    for b, n in zip(begin, length, strict=True):
        paths = list(itertools.product(range(3), repeat=int(n)))
        weight = np.array([np.exp(sum(scores[b + i, p[i]] for i in range(n)) + sum(move[p[i], p[i + 1]] for i in range(n - 1))) for p in paths])
        weight /= weight.sum()
        for p, w in zip(paths, weight, strict=True):
            for i in range(n):
                want[b + i, p[i]] += w
            for i in range(n - 1):
                pairs[p[i], p[i + 1]] += w
    assert np.allclose(marginal, want) and np.allclose(expected, pairs)


def test_language(docs, frame):
    model = langid.train(docs)
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(held_out()).collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    odd = {r.doc_id: r for r in langid.predict(frame(ODD), model, spans=True).collect()}
    assert {i for i, r in odd.items() if r.lang_pred == "und"} == {900001, 900002, 900003, 900004}
    assert all(0 <= r.score <= 1 and (r.lang_pred != "und" or r.score == 0 and not r.spans) for r in odd.values())
    assert odd[900007].lang_pred in model.languages
    assert langid.predict(frame([]), model).count() == 0
    texts = {r.lang: r.text for r in docs.filter(F.length("text") > 600).groupBy("lang").agg(F.max_by("text", "n_chars").alias("text")).collect()}
    first, second = (" ".join(texts[x].split()[:60]) for x in ("en", "es"))
    spans = langid.predict(frame([(1, first + ".\n" + second)]), model, spans=True).first().spans
    words = {x: sum(s.words for s in spans if s.lang == x and (s.end <= len(first) + 1) == (x == "en")) for x in ("en", "es")}
    assert min(words.values()) > 45


def test_language_without_rows(frame):
    bare = frame(ODD).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predict(bare, langid.train(bare)).collect()} == {"und"}


def test_licenses(docs, frame):
    model = licenses.train(docs)
    pattern = re.compile(r"(?i)licensed? under|all rights|mit license")
    assert {r.doc_id for r in licenses.find_licenses(docs, model).collect()} == {r.doc_id for r in docs.collect() if pattern.search(r.text or "")}
    body = "Some words before.\nPermission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files, to deal in the Software"
    rows = [*ODD, (1, body), (2, "the license plate is under the public bench of the software house and you may not copy it"), (3, "x " * 20000 + "SPDX-License-Identifier: MIT")]
    found = licenses.find_licenses(frame(rows), model).collect()
    assert {(r.doc_id, r.family) for r in found} == {(1, "MIT"), (3, "MIT")}
    assert licenses.find_licenses(frame([]), model).count() == 0
    assert licenses.find_licenses(frame(ODD), licenses.train(frame([]))).count() == 0


def test_secrets(docs, frame):
    rows = [*ODD, (1, f'api_key = "{KEY}" and then api_key = "{KEY}"'), (2, f"see commit {KEY} for the file"), (3, "mail some.long.name.here99@example.com or 1234 5678"),
            (4, "/usr/share/words99/of/the/house.txt"), (None, f"secret: {KEY}"), (1, f'api_key = "{KEY}" and then api_key = "{KEY}"')]
    every = frame(rows).unionByName(docs.select("doc_id", "text"), allowMissingColumns=True)
    got = [r for r in secrets.find_secrets(every).collect() if r.is_secret]
    texts = {r.doc_id: r.text for r in docs.collect()}
    true = {(i, m.start(1)) for i, t in texts.items() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', t or "")}
    assert {(r.doc_id, r.start) for r in got if r.doc_id in texts and r.candidate != KEY} == true
    assert all(texts[r.doc_id][r.start:r.end] == r.candidate for r in got if r.candidate != KEY)
    mine = sorted(((r.doc_id, r.start) for r in got if r.candidate == KEY), key=str)
    assert mine == sorted([(1, 11), (1, 11), (1, 73), (1, 73), (None, 8)], key=str)
    assert not [r for r in got if r.candidate != KEY and r.doc_id not in texts]
    assert secrets.find_secrets(frame([])).count() == 0


def test_secrets_assigned_without_blanks(docs, frame):
    mixed = "AbCd1234EfGh5678IjKl9012MnOp3456QrSt7890"
    values = [("token=", KEY, ""), ("password=", "hunter2hunter2", ""), ("AWS_SECRET=", mixed, ","), ("api_key='", mixed, "'"), ("checked=", "QWxhZGRpbjpvcGVuIHNlc2FtZQ1=", "")]
    rows = [(i, f"we set {name}{value}{end} for the house") for i, (name, value, end) in enumerate(values, 10 ** 7)]
    every = frame(rows).unionByName(docs.select("doc_id", "text"), allowMissingColumns=True)
    got = {r.doc_id: r for r in secrets.find_secrets(every).filter("doc_id >= 10000000").collect()}
    assert {i: r.candidate for i, r in got.items()} == {i: v for i, (_, v, _) in enumerate(values, 10 ** 7)}
    assert all(rows[i - 10 ** 7][1][r.start:r.end] == r.candidate for i, r in got.items())
    assert all(got[10 ** 7 + i].is_secret for i in (0, 2, 3))


def test_redaction(spark, frame):
    rows = frame([(1, "keep abc def abc"), (2, None), (3, "whole"), (4, "ünïc abc")])
    spans = spark.createDataFrame([(1, 5, 8), (1, 13, 16), (1, 5, 8), (3, 0, 5), (4, 5, 8)], "doc_id long, start int, end int")
    got = {r.doc_id: r.text for r in secrets.redacted(rows, "doc_id", spans).collect()}
    assert got == {1: "keep [SECRET] def [SECRET]", 2: None, 3: "[SECRET]", 4: "ünïc [SECRET]"}


def test_pipeline(spark):
    import corpus_pipeline as pipeline

    docs = table(spark, SMALL, "documents")
    base = docs.filter("n_chars between 800 and 3000").orderBy("doc_id").limit(6).collect()
    item = table(spark, SMALL, "benchmark").first().text
    more = [(10 ** 6, base[0].text, "en", "s", 1), (10 ** 6 + 1, base[1].text[:400] + "\n" + item + "\n" + base[4].text[-400:], "en", "s", 1), (10 ** 6 + 2, base[2].text[:-200] + f' token = "{KEY}"', "en", "s", 1),
            (None, base[3].text + f'\ntoken = "{KEY}"', None, None, None), (10 ** 6 + 3, None, "en", "s", 0)]
    rows = docs.unionByName(spark.createDataFrame(more, docs.schema)).withColumn("score", F.lit("mine")).withColumn("__f", F.lit(1))
    seen = {}
    for name, stage in pipeline.STAGES[:-1]:
        rows = stored(stage(spark, rows, SMALL), name)
        assert rows.columns == [*docs.columns, "score", "__f"]
        seen[name] = {(r.doc_id, r.text) for r in rows.collect()}
    ids = lambda name: {i for i, _ in seen[name]}
    assert 10 ** 6 in ids("quality") and 10 ** 6 not in ids("near_duplicates")
    assert 10 ** 6 + 1 in ids("near_duplicates") and 10 ** 6 + 1 not in ids("decontamination")
    assert not any(KEY in (t or "") for _, t in seen["secrets"]) and None in ids("secrets")
    assert any("[SECRET]" in (t or "") for i, t in seen["secrets"] if i is None)
    assert pipeline.STAGES[-1][1](spark, rows, SMALL).count() == rows.count()


def test_pipeline_of_nothing(spark):
    import corpus_pipeline as pipeline

    rows = table(spark, SMALL, "documents").limit(0)
    for name, stage in pipeline.STAGES:
        rows = stored(stage(spark, rows, SMALL), f"empty-{name}")
    assert rows.count() == 0
