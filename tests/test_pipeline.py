import json
import math
import random

import pytest
from pyspark.sql import functions as F

from creditlake.catalog.products import build_profile
from creditlake.operators import forecast as fc
from creditlake.operators import learning as ml
from creditlake.operators.quality import same_answer
from creditlake.plans import registry
from creditlake.plans.telemetry import spark_event_log
from creditlake.session import scratch_path
from creditlake.sources import files, versions
from creditlake.sources import tables as tb
from creditlake.streaming import incremental as inc
from creditlake.streaming import jobs


def test_medallion_run_equals_direct_build(spark, tables):
    names = ("customer", "loan_app", "card_app", "loan_coll", "card_coll", "card")
    done = registry.run(spark, {n: tables.f(n) for n in names}, scratch_path(spark, "lake"))
    assert same_answer(build_profile(tables), done["gold_profile"]).first().equal
    with pytest.raises(ValueError):
        registry.run(spark, {}, scratch_path(spark, "lake"))


def test_plain_csv_is_split(spark):
    path = scratch_path(spark, "csv")
    spark.range(20000).selectExpr("id", "repeat('x', 50) as t").coalesce(1).write.option("header", "true").csv(path)
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = files.load_csv(spark, path, "id bigint, t string")
        assert df.count() == 20000 and df.rdd.getNumPartitions() > 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)


def test_increment_takes_late_same_day_and_undated_rows(spark):
    path = scratch_path(spark, "inc")
    df = lambda rows: spark.createDataFrame(rows, "k int, d string").withColumn("d", F.to_date("d"))
    first, more = [(1, "2024-01-01"), (2, None), (3, "2024-01-05")], [(4, "2024-01-05"), (5, None), (6, "2024-01-06"), (7, "2024-01-03")]
    for rows in (first, first + more, first + more):
        inc.load_increment(spark, df(rows), path, "d", ["k"], lookback_days=2)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_declare_refuses_undeclared_columns(spark):
    df, layout = spark.createDataFrame([(1, 2)], "a int, b int"), {"a": ("bigint", "first")}
    with pytest.raises(ValueError):
        tb.declare(df, layout)
    assert tb.declare(df, layout, keep_others=True).columns == ["a", "b"]


def test_incremental_equals_full(spark):
    rows = spark.range(100).select("id", F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("id") / 10).cast("int")).alias("d"))
    path = scratch_path(spark, "inc")
    for limit in ("2024-01-04", "2024-01-04", "2024-02-01"):
        inc.load_increment(spark, rows.where(F.col("d") <= F.to_date(F.lit(limit))), path, "d", ["id"])
    assert same_answer(rows, spark.read.parquet(path)).first().equal


def test_upsert_is_idempotent_and_touches_only_its_buckets(spark):
    path = scratch_path(spark, "up")
    df = lambda rows: spark.createDataFrame(rows, "k string, ver int, v string")
    first = df([(f"k{i}", 1, "old") for i in range(50)])
    inc.upsert(spark, path, first, ["k"], "ver", ["v"], buckets=16)
    before = versions.current(spark, path)
    for _ in range(2):
        inc.upsert(spark, path, df([("k3", 2, "new"), ("k3", 0, "late")]), ["k"], "ver", ["v"], buckets=16)
    got = {r.k: r.v for r in inc.read_upserted(spark, path).collect()}
    assert len(got) == 50 and got["k3"] == "new" and sum(v == "new" for v in got.values()) == 1
    after = versions.current(spark, path)
    assert sum(after[k] != before.get(k) for k in after) == 1 and after.keys() == before.keys()


def test_upsert_that_stops_before_publishing_changes_nothing(spark, monkeypatch):
    path = scratch_path(spark, "up")
    df = lambda rows: spark.createDataFrame(rows, "k string, ver int, v string")
    inc.upsert(spark, path, df([("a", 1, "old"), ("b", 1, "old")]), ["k"], "ver", ["v"], buckets=2)
    with monkeypatch.context() as m:
        m.setattr(versions, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            inc.upsert(spark, path, df([("a", 2, "new")]), ["k"], "ver", ["v"], buckets=2)
    assert {r.k: r.v for r in inc.read_upserted(spark, path).collect()} == {"a": "old", "b": "old"}
    inc.upsert(spark, path, df([("a", 2, "new")]), ["k"], "ver", ["v"], buckets=2)
    assert {r.k: r.v for r in inc.read_upserted(spark, path).collect()} == {"a": "new", "b": "old"}


def test_failed_assertion_leaves_the_published_table(spark):
    root = scratch_path(spark, "lake")
    step = registry.Step("people", "silver", ("raw",), lambda df: df, (), ("k",), ("k",))
    df = lambda rows: spark.createDataFrame(rows, "k int")
    registry.run(spark, {"raw": df([(1,), (2,)])}, root, [step])
    with pytest.raises(Exception, match="k"):
        registry.run(spark, {"raw": df([(1,), (1,)])}, root, [step])
    assert sorted(r.k for r in registry.read(spark, root, step).collect()) == [1, 2]


def test_clustered_files_prune(spark):
    path = scratch_path(spark, "clu")
    df = spark.range(0, 20000, 1, 4).select((F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    tb.write_clustered(df, path, ["k"], partitions=10)
    spans = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).agg(F.min("k").alias("a"), F.max("k").alias("b")).collect()
    assert len(spans) > 3 and all(s.b - s.a < 25 for s in spans)
    hot = spark.range(20000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    path = scratch_path(spark, "hot")
    tb.write_clustered(hot, path, ["k"], partitions=8)
    sizes = [r[1] for r in spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 20000 / 3


def test_csv_keeps_quotes_newlines_and_empty_text(spark):
    rows = [(1, 'a "quoted"\nline, x'), (2, ""), (3, None), (4, "  spaced  "), (5, "back\\slash")]
    path = scratch_path(spark, "csv")
    df = spark.createDataFrame(rows, "id int, t string")
    files.write_csv(df, path)
    assert {tuple(r) for r in files.load_csv(spark, path, df.schema, multi_line=True).collect()} == set(rows)


def test_staging(spark):
    df = spark.createDataFrame([("1", "x"), ("", "")], "n string, s string")
    assert [tuple(r) for r in files.type_staging(df, {"n": "bigint", "s": "string"}).collect()] == [(1, "x"), (None, "")]
    assert files.try_type_staging(spark.createDataFrame([("q",)], "n string"), {"n": "int"}).first()[0] is None
    with pytest.raises(Exception):
        files.type_staging(spark.createDataFrame([("q",)], "n string"), {"n": "int"}).collect()
    assert files.clean_header(["E-KYC", "_addr", "addr", ""]) == ["E_KYC", "addr", "addr_2", "column_4"]


def test_metrics_against_all_pairs(spark):
    rnd = random.Random(5)
    rows = [(rnd.randrange(2), rnd.choice([0.0, 0.1, 0.25, 0.2504, 0.5, 0.77, 1.0])) for _ in range(300)]
    got = ml.evaluate(spark.createDataFrame(rows, "y int, p double"), "y", "p").first()
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert got.roc_auc == pytest.approx(auc, abs=1e-12)
    assert got.accuracy == pytest.approx(sum((p >= 0.5) == bool(y) for y, p in rows) / len(rows))


def test_attributions_add_up(spark):
    rnd = random.Random(9)
    rows = [(rnd.choice("abc"), float(rnd.randrange(50)), rnd.randrange(2)) for _ in range(200)]
    df = spark.createDataFrame(rows, "s string, x double, y int")
    p = ml.fit_propensity(df, "y", ["s"], ["x"])
    unseen = df.limit(3).withColumn("s", F.lit("never seen"))
    for r in ml.explain(p, df.union(unseen), df, k=2).collect():
        assert r.logit == pytest.approx(math.log(r.probability / (1 - r.probability)), abs=1e-6)
        assert r.baseline + sum(a.attribution for a in r.top_feature_attributions) == pytest.approx(r.logit, abs=1e-6)
    with pytest.raises(ValueError):
        ml.fit_propensity(df.where("y = 1"), "y", ["s"], ["x"])
    with pytest.raises(ValueError, match="too many"):
        ml.fit_propensity(df, "y", ["s"], ["x"], max_categories=1)
    gaps = df.withColumn("x", F.when(F.rand(3) > 0.3, F.col("x")))
    mean = gaps.agg(F.avg("x")).first()[0]
    filled = ml.predict(ml.fit_propensity(gaps, "y", ["s"], ["x"]), gaps.where("x is null").withColumn("x", F.lit(mean)))
    missing = ml.predict(ml.fit_propensity(gaps, "y", ["s"], ["x"]), gaps.where("x is null"))
    pick = lambda d: sorted(round(r[0][0].prob, 9) for r in d.select("predicted_y_probs").collect())
    assert pick(filled) == pick(missing)


def test_forecast_of_a_straight_line(spark):
    days = spark.range(28).select(F.lit("a").alias("k"), F.date_add(F.to_date(F.lit("2024-01-01")), F.col("id").cast("int")).alias("ds"),
                                  (100 + 2 * F.col("id")).cast("double").alias("value"))
    rows = fc.forecast(days, ["k"], horizon=5).orderBy("forecast_date").collect()
    assert [float(r.forecast_value) for r in rows] == [156.0, 158.0, 160.0, 162.0, 164.0]
    assert all(r.lower_bound <= r.forecast_value <= r.upper_bound for r in rows)
    assert fc.forecast(days.limit(1), ["k"], horizon=2).count() == 2


def test_event_log(spark, tmp_path):
    lines = [{"Event": "SparkListenerJobStart", "Job ID": 1, "Submission Time": 1000},
             {"Event": "SparkListenerJobEnd", "Job ID": 1, "Completion Time": 4500}, {"Event": "Other"}]
    (tmp_path / "log").write_text("\n".join(json.dumps(x) for x in lines))
    assert spark_event_log(spark, str(tmp_path / "log")).first().total_slot_ms == 3500


def test_glossary(spark):
    text = "glossary: {id: g}\ncategories: [{id: c, display_name: C}]\nterms:\n - {id: t, display_name: T, category: c, definition: d, synonyms: [a, b]}\n"
    pytest.importorskip("yaml")
    assert files.glossary(spark, text).first().synonyms == "a, b"


def test_series_of_a_run_that_has_not_caught_up(spark):
    """Three days loaded; a second run on a new checkpoint fails at its second file: the series stays, then is the second run's."""
    src, out = scratch_path(spark, "days"), scratch_path(spark, "series")
    for day in (1, 2, 3):
        spark.sql(f"select timestamp'2024-01-0{day} 12:00:00' as ts, 'a' as kind, {day} as amount").coalesce(1).write.mode("append").parquet(src)
    rows = lambda: jobs.file_stream(spark, src, spark.read.parquet(src).schema, per_batch=1)
    run = lambda stream, cp: jobs.daily_series(stream, out, cp, "ts", "kind", "amount")
    total = lambda: sorted(float(r.total) for r in jobs.read_daily_series(spark, out, "kind").collect())
    with pytest.raises(ValueError, match="no series"):
        total()
    first = scratch_path(spark, "cp")
    jobs.publish_daily_series(run(rows(), first), spark, out)
    assert total() == [1.0, 2.0, 3.0]
    second, broken = scratch_path(spark, "cp"), F.when(F.col("amount") == 2, F.raise_error(F.lit("stop"))).otherwise(F.col("amount"))
    with pytest.raises(Exception, match="stop"):
        jobs.publish_daily_series(run(rows().withColumn("amount", broken.cast("int")), second), spark, out)
    assert total() == [1.0, 2.0, 3.0]
    jobs.publish_daily_series(run(rows(), second), spark, out)
    assert total() == [1.0, 2.0, 3.0]
    # the published run goes on: each of its batches is seen at once
    spark.sql("select timestamp'2024-01-03 18:00:00' as ts, 'a' as kind, 10 as amount").write.mode("append").parquet(src)
    run(rows(), second).awaitTermination()
    assert total() == [1.0, 2.0, 13.0]
