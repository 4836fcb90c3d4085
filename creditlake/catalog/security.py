"""Security, sharing and privacy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as s
from ..functions.aggregates import avg_money
from ..operators import security as sec
from ..operators.topk import top_k
from ..operators.windows import with_totals
from ..plans import marts
from ..session import scratch_path
from ..sources.tables import write_clustered
from .base import query
from .products import build_partner, gold_profile

BRANCH, AUDITOR = "user:branch", "user:auditor"
POLICIES = [
    sec.RowPolicy("branch_states", frozenset({BRANCH}), "state in ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4')"),
    sec.RowPolicy("all_states", frozenset({AUDITOR})),
]


@query("sec_01_row_policy", "SELECT cif_id, state FROM gold_profile WHERE state IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4')")
def sec_01(t):
    return sec.secure_rows(gold_profile(t), POLICIES, BRANCH).select("cif_id", "state")


@query("sec_02_mask_sha256", "SELECT cif_id, sha256(cif_nm) AS cif_nm FROM gold_profile")
def sec_02(t):
    df = sec.tag_columns(gold_profile(t), {"cif_nm": "customer_name"})
    policy = {"customer_name": sec.MaskPolicy(s.mask_sha256, raw=frozenset({AUDITOR}), masked=frozenset({BRANCH}))}
    return sec.select_governed(df, ["cif_id", "cif_nm"], policy, BRANCH)


@query("sec_03_mask_last4_zero", "SELECT 'XXXXX' || right(account_no::varchar, 4) AS account_no, 0.0::double AS cp_cl FROM f_card")
def sec_03(t):
    return t.f("card").select(s.mask_last4("account_no").alias("account_no"), s.mask_zero("cp_cl").alias("cp_cl"))


@query("sec_04_restricted_column_left_out", "SELECT cif_id, net_income::double AS net_income FROM gold_profile")
def sec_04(t):
    """The restricted column is left out, so an ungranted principal passes; naming it raises (tests)."""
    df = sec.tag_columns(gold_profile(t), {"cif_nm": "customer_name"})
    return sec.select_governed(df, ["cif_id", "net_income"], {}, "user:guest")


@query("sec_05_tag_audit", """
SELECT 'customer_profile' AS table_name, 'cif_nm' AS column_name, 'string' AS data_type, 'customer_name' AS tag,
  count(cif_nm) AS values FROM gold_profile
UNION ALL SELECT 'customer_profile', 'net_income', 'decimal(28,9)', 'financial_amount', count(net_income) FROM gold_profile""")
def sec_05(t):
    df = sec.tag_columns(gold_profile(t), {"cif_nm": "customer_name", "net_income": "financial_amount",
                                            "state": "location"})
    return sec.tag_audit(sec.tag_columns(df, {"state": None}), "customer_profile")


def _by_state(df):
    groups = df.groupBy("state").agg(F.count(F.lit(1)).alias("visible_customers"),
                                     avg_money("annual_income").alias("avg_annual_income"))
    return with_totals(groups, visible_states=F.count(F.lit(1)), total_customers=F.sum("visible_customers"))


_SEC06 = """
SELECT state, count(*) AS visible_customers, round(avg(annual_income)::decimal(22,6), 2)::double AS avg_annual_income,
  count(*) OVER () AS visible_states, (sum(count(*)) OVER ())::bigint AS total_customers, '{who}' AS queried_by
FROM gold_profile WHERE {cond} GROUP BY state"""


@query("sec_06_two_principals", _SEC06.format(
    who=BRANCH, cond="state IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4')") + " UNION ALL " + _SEC06.format(
    who=AUDITOR, cond="true"))
def sec_06(t):
    return sec.as_principals(gold_profile(t), POLICIES, [BRANCH, AUDITOR], _by_state)


@query("sec_07_role_view", """
SELECT cif_id, left(cif_nm, 2) || '****' || right(cif_nm, 2) AS customer_name, '*** REDACTED ***' AS home_address,
  CASE WHEN net_income < 3000 THEN 'B40' WHEN net_income <= 7000 THEN 'M40' ELSE 'T20' END AS income_band,
  NULL::double AS net_income FROM gold_profile""")
def sec_07(t):
    return gold_profile(t).select(
        "cif_id", s.mask_middle("cif_nm").alias("customer_name"), s.redact("REDACTED").alias("home_address"),
        s.income_band("net_income").alias("income_band"), F.lit(None).cast("double").alias("net_income"))


@query("sec_07b_two_roles", """
SELECT 'marketing' AS role, cif_id, left(cif_nm, 2) || '****' || right(cif_nm, 2) AS customer_name,
  CASE WHEN net_income < 3000 THEN 'B40' WHEN net_income <= 7000 THEN 'M40' ELSE 'T20' END AS income_band, NULL::double AS net_income
FROM gold_profile WHERE recv_promo = 'Y'
UNION ALL SELECT 'underwriting', cif_id, cif_nm,
  CASE WHEN net_income < 3000 THEN 'B40' WHEN net_income <= 7000 THEN 'M40' ELSE 'T20' END, net_income::double FROM gold_profile""")
def sec_07b(t):
    """Two roles side by side: masked names and bands of consenting customers, and exact figures of all."""
    band, income = s.income_band("net_income"), F.col("net_income").cast("double")
    rules = {
        "marketing": sec.RoleRule({"cif_id": F.col("cif_id"), "customer_name": s.mask_middle("cif_nm"), "income_band": band,
                                   "net_income": F.lit(None).cast("double")}, F.col("recv_promo") == "Y"),
        "underwriting": sec.RoleRule({"cif_id": F.col("cif_id"), "customer_name": F.col("cif_nm"), "income_band": band, "net_income": income})}
    views = [sec.role_view(gold_profile(t), role, rules).withColumn("role", F.lit(role)) for role in rules]
    return views[0].unionByName(views[1])


@query("sec_08_clean_room", """
SELECT state, marital_sts, count(DISTINCT cif_id) AS joint_customers,
  sum(card_spend)::double AS total_card_spend, sum(partner_spend)::double AS total_partner_spend
FROM joint_rows GROUP BY 1, 2 HAVING count(DISTINCT cif_id) >= 20""")
def sec_08(t):
    rows = marts.joint_totals(t.f("customer"), t.f("card_sales"), build_partner(t))
    room = sec.CleanRoom(rows, "cif_id", 20, ["cif_id", "state"])
    return room.aggregate(["state", "marital_sts"], joint_customers=("count_distinct", "cif_id"),
                          total_card_spend=("sum", "card_spend"), total_partner_spend=("sum", "partner_spend"))


@query("sec_09_results_only", """
SELECT r.subcontinent, count(*)::bigint AS transactions FROM joint_rows j JOIN f_geo_region r ON r.target_region = j.state
GROUP BY 1 HAVING count(DISTINCT cif_id) >= 20""")
def sec_09(t):
    """A partner joins own data on an allowed column and takes results out, never rows."""
    rows = marts.joint_totals(t.f("customer"), t.f("card_sales"), build_partner(t))
    room = sec.CleanRoom(rows, "cif_id", 20, ["cif_id", "state"])
    own = t.f("geo_region").select(F.col("target_region").alias("state"), "subcontinent")
    return room.join(own, ["state"]).aggregate(["subcontinent"], transactions=("sum", "transactions"))


@query("sec_10_shared_view", """
SELECT grp AS merchant_group, ldesc AS location_name, count(*) AS total_transactions,
  sum(amount::decimal(18,2))::double AS total_spending FROM f_card_sales GROUP BY 1, 2
ORDER BY sum(amount::decimal(18,2)) DESC, 1, 2 LIMIT 15""")
def sec_10(t):
    return top_k(marts.merchant_spend(t.f("card_sales")),
                 [F.col("total_spending").desc(), F.col("merchant_group").asc(), F.col("location_name").asc()], 15)


@query("sec_11_erasure_audit", """
SELECT 'cards' AS table_name, count(*) FILTER (g) AS removed_rows, count(*) FILTER (NOT g) AS kept_rows
FROM (SELECT cif_id IN (SELECT cif_id FROM f_customer WHERE net_income <= -500) AS g FROM f_card)
UNION ALL
SELECT 'sales', count(*) FILTER (g), count(*) FILTER (NOT g)
FROM (SELECT cif_no IN (SELECT cif_id FROM f_customer WHERE net_income <= -500) AS g FROM f_card_sales)""")
def sec_11(t):
    subjects = t.f("customer").where(F.col("net_income") <= -500)
    _, audit = sec.erase({"cards": t.f("card"), "sales": t.f("card_sales")},
                         {"cards": "cif_id", "sales": "cif_no"}, subjects, "cif_id")
    return audit


@query("sec_11b_erased_cards", "SELECT account_no FROM f_card WHERE cif_id NOT IN "
                               "(SELECT cif_id FROM f_customer WHERE net_income <= -500)")
def sec_11b(t):
    kept, _ = sec.erase({"cards": t.f("card")}, {"cards": "cif_id"},
                        t.f("customer").where(F.col("net_income") <= -500), "cif_id")
    return kept["cards"].select("account_no")


@query("sec_11c_erased_by_file", "SELECT account_no, cif_id FROM f_card WHERE cif_id NOT IN (SELECT cif_id FROM f_customer WHERE net_income <= -900)")
def sec_11c(t):
    """Only files that hold a subject are written anew; what is published is the table without the subjects."""
    root = scratch_path(t.spark, "erasable")
    write_clustered(t.f("card"), f"{root}/first", ["cif_id"], partitions=16)
    sec.publish_files(t.spark, root, "first")
    sec.erase_from_files(t.spark, root, t.f("customer").where(F.col("net_income") <= -900), "cif_id", "cif_id")
    return sec.read_files(t.spark, root).select("account_no", "cif_id")
