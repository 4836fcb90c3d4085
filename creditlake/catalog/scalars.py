"""Projections, scalar functions and filters."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions.aggregates import sum_money
from ..operators.lookup import lookup_row
from ..plans import profile
from .base import query
from .products import gold_features, gold_profile, gold_wide


@query("prj_01_key", "SELECT o_orderkey, trim(' ' || o_custkey::varchar || ' ') AS cif_id, "
                     "(o_custkey::double)::bigint::varchar AS double_cif_id FROM orders")
def prj_01(t):
    padded = F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" "))
    return t.orders.select("o_orderkey", s.key(padded).alias("cif_id"),
                           s.double_key(F.col("o_custkey").cast("double")).alias("double_cif_id"))


@query("prj_02_ymd_date", "SELECT appl_no, try_strptime(nullif(trim(appl_dt::varchar), '0'), '%Y%m%d')::date AS d "
                          "FROM f_loan_app")
def prj_02(t):
    return t.f("loan_app").select("appl_no", s.ymd_date("appl_dt").alias("d"))


@query("prj_03_iso_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderdate::date END AS d "
                          "FROM orders")
def prj_03(t):
    raw = F.when(F.col("o_orderkey") % 9 == 0, "20xx-01-01").otherwise(F.col("o_orderdate").cast("string"))
    return t.orders.select("o_orderkey", s.iso_date(raw).alias("d"))


@query("prj_04_parsed_only", "SELECT appl_no, d FROM (SELECT appl_no, "
                             "try_strptime(nullif(appl_dt::varchar, '0'), '%Y%m%d')::date AS d FROM f_loan_app) "
                             "WHERE d IS NOT NULL")
def prj_04(t):
    return t.f("loan_app").select("appl_no", s.ymd_date("appl_dt").alias("d")).where(F.col("d").isNotNull())


@query("prj_05_numeric_casts", "SELECT l_orderkey, l_quantity::bigint AS q, "
                               "l_extendedprice::decimal(18,2)::double AS price, l_linenumber::double AS line, "
                               "CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_partkey END AS raw_part FROM lineitem")
def prj_05(t):
    raw = F.when(F.col("l_returnflag") == "R", "n/a").otherwise(F.col("l_partkey").cast("string"))
    return t.lineitem.select("l_orderkey", F.col("l_quantity").cast("bigint").alias("q"),
                             s.money("l_extendedprice").alias("price"),
                             F.col("l_linenumber").cast("double").alias("line"),
                             raw.try_cast("bigint").alias("raw_part"))


@query("prj_06_defaults", "SELECT cif_id, coalesce(recv_promo, citizen, 'N') AS v FROM f_customer")
def prj_06(t):
    return t.f("customer").select("cif_id", F.coalesce("recv_promo", "citizen", F.lit("N")).alias("v"))


@query("prj_07_blank_default", "SELECT cif_id, coalesce(nullif(trim(nob), ''), 'GENERAL_SECTOR') AS v FROM f_customer")
def prj_07(t):
    return t.f("customer").select("cif_id", s.text_or("nob", "GENERAL_SECTOR").alias("v"))


@query("prj_08_flag", "SELECT cif_id, CASE WHEN combined_unpaid > 0 THEN 1 ELSE 0 END AS delinquency_risk_flag "
                      "FROM gold_profile")
def prj_08(t):
    return gold_profile(t).select(
        "cif_id", F.when(F.col("combined_unpaid") > 0, 1).otherwise(0).alias("delinquency_risk_flag"))


@query("prj_09_code_names", "SELECT region_iso, state FROM geo_target_rows")
def prj_09(t):
    from ..plans.marts import STATES
    return t.f("geo_region").select("region_iso",
                                    s.lookup("region_iso", STATES, F.col("target_region")).alias("state"))


@query("prj_10_offer_ladder", """
SELECT cif_id, CASE WHEN net_income >= 8000 AND latest_bureau_score >= 700 THEN 'Platinum (Fast-Track)'
  WHEN net_income >= 4000 AND latest_bureau_score >= 660 THEN 'Gold (Fast-Track)' ELSE 'Classic' END AS offer
FROM feature_rows""")
def prj_10(t):
    return gold_features(t).select("cif_id", profile.offer().alias("offer"))


@query("prj_11_keyword_category", """
SELECT p_partkey, CASE WHEN upper(p_name) LIKE '%RING%' THEN 'jewellery'
  WHEN upper(p_name) LIKE '%WIDGET%' OR upper(p_name) LIKE '%BOLT%' THEN 'hardware' ELSE 'other' END AS category
FROM part""")
def prj_11(t):
    rules = {"jewellery": ["ring"], "hardware": ["widget", "bolt"]}
    return t.part.select("p_partkey", s.like_ladder("p_name", rules, "other").alias("category"))


@query("prj_12_messages", """
SELECT account_no, cif_id::varchar || '->' || account_no::varchar AS edge_id,
  'usage (' || cp_usage::decimal(18,2)::varchar || ') > limit (' || cp_cl::decimal(18,2)::varchar || ')' AS detail
FROM f_card""")
def prj_12(t):
    return t.f("card").select(
        "account_no", F.concat(s.key("cif_id"), F.lit("->"), s.key("account_no")).alias("edge_id"),
        F.concat(F.lit("usage ("), s.amount_text("cp_usage"), F.lit(") > limit ("), s.amount_text("cp_cl"),
                 F.lit(")")).alias("detail"))


@query("prj_13_safe_ratio", """
SELECT account_no, CASE WHEN cp_usage <> 0 THEN cp_cl / cp_usage END AS r FROM f_card""")
def prj_13(t):
    return t.f("card").select("account_no", s.ratio("cp_cl", "cp_usage").alias("r"))


@query("prj_14_arithmetic", """
SELECT o_orderkey, round(o_totalprice::decimal(18,2), 1)::double AS r, abs(o_custkey - 700) AS a, o_orderkey % 7 AS m,
  pow(o_custkey % 10, 2) AS p FROM orders""")
def prj_14(t):
    return t.orders.select("o_orderkey", F.round(s.money("o_totalprice"), 1).alias("r"),
                           F.abs(F.col("o_custkey") - 700).alias("a"), (F.col("o_orderkey") % 7).alias("m"),
                           F.pow(F.col("o_custkey") % 10, F.lit(2)).alias("p"))


@query("prj_15_greatest", "SELECT agree_no, greatest(coalesce(grade, 'A'), coalesce(sub_code, 'A')) AS g FROM f_loan_coll")
def prj_15(t):
    return t.f("loan_coll").select("agree_no", F.greatest(F.coalesce("grade", F.lit("A")),
                                                         F.coalesce("sub_code", F.lit("A"))).alias("g"))


@query("prj_16_bucket", "SELECT c_custkey, ('0x' || substr(md5(c_custkey::varchar), 1, 15))::bigint % 10 AS b FROM customer")
def prj_16(t):
    return t.customer.select("c_custkey", s.bucket("c_custkey", 10).alias("b"))


@query("prj_17_boolean", "SELECT cif_id, total_unpaid > 0 OR akpk_status = 'Y' AS is_delinquent FROM gold_wide")
def prj_17(t):
    return gold_wide(t).select("cif_id", ((F.col("total_unpaid") > 0) | (F.col("akpk_status") == "Y"))
                                .alias("is_delinquent"))


@query("prj_18_array_access", "SELECT vec_id, embedding[1] AS first, embedding[1000] AS missing, "
                              "len(embedding)::int AS n FROM embeddings")
def prj_18(t):
    items = F.transform("embedding", lambda x: F.struct(x.alias("prob")))
    return t.embeddings.select("vec_id", F.get(items, F.lit(0))["prob"].alias("first"),
                               F.get(items, F.lit(999))["prob"].alias("missing"), F.size("embedding").alias("n"))


@query("prj_19_time_difference", """
SELECT event_id, date_diff('millisecond', ts, TIMESTAMP '2024-02-01 00:00:00') AS age_ms,
  date_diff('second', date_trunc('second', ts), TIMESTAMP '2024-02-01 00:00:00') AS age_s, ts::date AS day
FROM events WHERE ts >= TIMESTAMP '2024-02-01 00:00:00' - INTERVAL 7 DAY""")
def prj_19(t):
    now = F.lit(datetime.datetime(2024, 2, 1)).cast("timestamp_ntz")
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    diff = micros(now) - micros(F.date_trunc("millisecond", F.col("ts")).cast("timestamp_ntz"))
    return t.events.where(F.col("ts") >= now - F.expr("interval 7 days")).select(
        "event_id", (diff / 1000).cast("bigint").alias("age_ms"),
        F.floor((micros(now) - micros(F.date_trunc("second", "ts"))) / 1000000).alias("age_s"),
        F.to_date("ts").alias("day"))


@query("prj_20_text_tests", """
SELECT p_partkey, upper(p_name) AS u, starts_with(p_name, 'red') AS pre, suffix(p_name, 'ring') AS suf,
  substr(p_brand, 7, 2) AS sub, length(p_name) AS n FROM part""")
def prj_20(t):
    return t.part.select("p_partkey", F.upper("p_name").alias("u"), F.startswith("p_name", F.lit("red")).alias("pre"),
                         F.endswith("p_name", F.lit("ring")).alias("suf"), F.substring("p_brand", 7, 2).alias("sub"),
                         F.length("p_name").cast("bigint").alias("n"))


@query("prj_21_strip_quotes", "SELECT p_partkey, p_name AS v FROM part")
def prj_21(t):
    return t.part.select("p_partkey", s.strip_quotes(F.concat(F.lit('"'), "p_name", F.lit('"'))).alias("v"))


@query("prj_22_to_json", """
SELECT c_custkey, '{"id":' || c_custkey::varchar || ',"name":"' || c_name || '"}' AS j FROM customer""")
def prj_22(t):
    return t.customer.select("c_custkey", F.to_json(F.struct(F.col("c_custkey").alias("id"),
                                                             F.col("c_name").alias("name"))).alias("j"))


@query("prj_23_all_except", "SELECT * EXCLUDE (c_name) FROM customer")
def prj_23(t):
    return t.customer.drop("c_name")


@query("prj_24_identity")
def prj_24(t):
    return t.customer.groupBy(F.current_user().alias("queried_by")).agg(F.count(F.lit(1)).alias("n"))


@query("prj_24b_identity_check", "SELECT true AS is_session_user, count(*) AS n FROM customer")
def prj_24b(t):
    return t.customer.groupBy((F.current_user() == F.lit(t.spark.sparkContext.sparkUser())).alias("is_session_user")).agg(F.count(F.lit(1)).alias("n"))


@query("flt_01_predicates", """
SELECT cif_id, state, age FROM f_customer
WHERE state IN ('NATION_1', 'NATION_2', 'NATION_3') AND age BETWEEN 25 AND 60 AND citizen IS NOT NULL
  AND (nob <> '' OR recv_promo IS NULL) AND (net_income > 0) IS TRUE""")
def flt_01(t):
    return t.f("customer").where(
        F.col("state").isin("NATION_1", "NATION_2", "NATION_3") & F.col("age").between(25, 60)
        & F.col("citizen").isNotNull() & (s.non_blank("nob") | F.col("recv_promo").isNull())
        & F.coalesce(F.col("net_income") > 0, F.lit(False))).select("cif_id", "state", "age")


LOOKUP_COLS = ["cif_id", "state", "occupation", "wallet_tier", "total_cards_held", "akpk_status",
               "debt_service_ratio", "collection_grade", "has_unpaid_delinquency"]


@query("flt_02_point_lookup", f"SELECT {', '.join(LOOKUP_COLS)}, 'FOUND' AS status FROM gold_wide WHERE cif_id = '7'")
def flt_02(t):
    return lookup_row(gold_wide(t).select(*LOOKUP_COLS), "cif_id", "7")


@query("flt_02b_refused_id", f"""SELECT '7;' AS cif_id, {', '.join(f'any_value({c}) FILTER (false) AS {c}' for c in LOOKUP_COLS[1:])}, 'NOT_FOUND' AS status
FROM gold_wide""")
def flt_02b(t):
    """An id that holds other signs is not cut to one that exists."""
    return lookup_row(gold_wide(t).select(*LOOKUP_COLS), "cif_id", "7;")


@query("prj_05b_small_amounts", """
SELECT l_returnflag, round(sum((l_discount::decimal(18,4) * l_tax::decimal(18,4))::decimal(28,9)), 2)::double AS total,
  round(max((l_discount::decimal(18,4) * l_tax::decimal(18,4))::decimal(28,9)), 4)::double AS top FROM lineitem GROUP BY 1""")
def prj_05b(t):
    """Amounts far below a hundredth add up; only the sum is rounded."""
    small = F.col("l_discount").cast("decimal(18,4)") * F.col("l_tax").cast("decimal(18,4)")
    return t.lineitem.groupBy("l_returnflag").agg(sum_money(small).alias("total"), F.round(F.max(s.money(small)), 4).alias("top"))


@query("flt_03_eligible", "SELECT * FROM feature_rows WHERE active_card_count = 0 AND loan_app_count > 0 "
                          "AND recv_promo = 'Y'")
def flt_03(t):
    return profile.prequalified(gold_features(t))
