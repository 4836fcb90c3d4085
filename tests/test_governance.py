import pytest
from pyspark.sql import functions as F

from creditlake.functions.scalars import mask_sha256
from creditlake.operators import quality as dq
from creditlake.operators import security as sec


@pytest.fixture
def people(spark):
    return spark.createDataFrame([(f"c{i}", f"name{i}", "S1" if i < 25 else "S2", float(i)) for i in range(30)],
                                 "id string, name string, state string, amt double")


def test_row_policies(people):
    pol = [sec.RowPolicy("a", frozenset({"u1"}), "state = 'S1'"), sec.RowPolicy("b", frozenset({"u1", "u2"}), "amt > 28")]
    assert sec.secure_rows(people, pol, "u1").count() == 26
    assert sec.secure_rows(people, pol, "u2").count() == 1
    assert sec.secure_rows(people, pol, "nobody").count() == 0


def test_column_grants(people):
    df = sec.tag_columns(people, {"name": "pii"})
    pol = {"pii": sec.MaskPolicy(mask_sha256, raw=frozenset({"officer"}), masked=frozenset({"analyst"}))}
    assert sec.select_governed(df, ["name"], pol, "officer").first()[0] == "name0"
    masked = [r[0] for r in sec.select_governed(df, ["name"], pol, "analyst").collect()]
    assert not any(m.startswith("name") for m in masked)
    with pytest.raises(PermissionError):
        sec.select_governed(df, ["id", "name"], pol, "guest")
    assert sec.select_governed(df, ["id"], pol, "guest").count() == 30
    assert sec.active_tags(sec.untag_all(df)) == {}


def test_clean_room(people, spark):
    room = sec.CleanRoom(people, "id", 20, ["state"])
    assert [tuple(r) for r in room.aggregate(["state"], n=("count", "amt")).collect()] == [("S1", 25)]
    repeated = sec.CleanRoom(people.where("state = 'S2'").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(50)))), "id", 20)
    assert repeated.aggregate(["state"], n=("count", "amt")).count() == 0
    for attempt in (lambda: room.select("id"), lambda: room.collect(), lambda: room.toPandas(),
                    lambda: room.aggregate(["id"], n=("count", "amt")), lambda: room.join(people, ["name"]),
                    lambda: room.aggregate(["state"], n=("max", "id")), lambda: room.aggregate(["state"], n=("collect_list", "name"))):
        with pytest.raises(PermissionError):
            attempt()


def test_erase(people, spark):
    kept, audit = sec.erase({"p": people}, {"p": "id"}, spark.createDataFrame([("c3",), ("c3",), ("nope",)], "s string"), "s")
    assert kept["p"].where("id = 'c3'").count() == 0 and kept["p"].count() == 29
    assert tuple(audit.first()) == ("p", 1, 29)


def test_rules_and_assertions(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 0.0), (None, None)], "k string, v double")
    rules = [dq.Rule("nn", "k", "C", "not_null"), dq.Rule("u", "k", "U", "unique", 30),
             dq.Rule("r", "v", "V", "range", 30, low=0, strict_low=True)]
    got = {r.rule_name: (r.passed_rows, float(r.pass_rate_pct), r.rule_status) for r in dq.scan_rules(df, rules).collect()}
    assert got == {"nn": (2, 66.67, "FAILED"), "u": (1, 33.33, "PASSED"), "r": (1, 33.33, "PASSED")}
    assert dq.scan_rules(df.where("false"), rules).count() == 3
    with pytest.raises(AssertionError, match="nonNull"):
        dq.assert_table(df, ["k"], ["k"])
    dq.assert_table(df.where("k is not null").limit(1), ["k"], ["k"])


def test_reconcile_and_profile(spark):
    df = spark.createDataFrame([(1, 1.10), (2, 2.20)], "k int, amount double")
    ok, bad = dq.Control("f", "amount", df, df), dq.Control("g", "amount", df, df.limit(1))
    assert {r.flow: r.audit_status for r in dq.reconcile([ok, bad]).collect()} == {"f": "PASS", "g": "INVESTIGATE"}
    assert {r.column_name: r.distinct_count for r in dq.profile(df).collect()} == {"k": 2, "amount": 2}
    assert dq.first_present(df, ["x", "AMOUNT"]) == "amount" and dq.first_present(df, ["x"]) is None


def test_same_answer_counts_duplicates(spark):
    a, b = spark.createDataFrame([(1,), (1,)], "x int"), spark.createDataFrame([(1,)], "x int")
    assert tuple(dq.same_answer(a, b).first()) == (1, 0, False)


def test_pii_scan_reports_only_hits(spark):
    df = spark.createDataFrame([("a@b.com", "x"), ("none", None)], "t string, u string")
    got = dq.pii_scan(df, [dq.InfoType("EMAIL", r"[a-z]+@[a-z]+\.com"), dq.InfoType("WORD", words=("zz",))]).collect()
    assert [(r.column_name, r.infotype, r.hits, float(r.hit_ratio), r.likelihood) for r in got] == [("t", "EMAIL", 1, 0.5, "LIKELY")]


def test_exact_profile_deals_rows_out(spark):
    df = spark.range(2000).coalesce(1).selectExpr("id as k", "id % 7 as seven", "cast(null as string) as none")
    got = dq.profile(df, exact=df.columns)
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
    assert {r.column_name: r.distinct_count for r in got.collect()} == {"k": 2000, "seven": 7, "none": 0}
