"""Data products on the derived bronze tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import Tables
from ..plans import marts, profile, silver
from .base import part, query, stored


# --- builders shared with other modules -------------------------------------------------------

def build_profile(t: Tables):
    cust = silver.customers(t.f("customer"))
    return profile.customer_profile(
        cust, silver.loan_applications(t.f("loan_app")), silver.card_applications(t.f("card_app")),
        silver.collections_summary(t.f("loan_coll"), t.f("card_coll")), t.f("card"))


def gold_profile(t: Tables):
    return stored(t, "gold_profile", build_profile)


def build_features(t: Tables):
    return profile.feature_store(gold_profile(t))


def gold_features(t: Tables):
    return stored(t, "gold_features", build_features)


def build_sales(t: Tables):
    return silver.sales(t.f("card_sales"), t.f("loan_sales"))


def build_collections(t: Tables):
    return silver.collections(t.f("loan_coll"), t.f("card_coll"))


def build_wide(t: Tables):
    return profile.wide_mart(silver.newest_by_text_key(t.f("customer")), t.f("card"), t.f("loan_app"),
                             build_sales(t), build_collections(t))


def gold_wide(t: Tables):
    return stored(t, "gold_wide", build_wide)


# Test rules: digits of the merchant name stand for the keywords of a category.
CATEGORY_RULES = {"department_store": ["#00000000"], "supermarket": ["#00000001", "#00000002"],
                  "electronics_store": ["#00000003"], "pharmacy": ["#00000004", "#00000005"],
                  "restaurant": ["#00000006"], "gas_station": ["#00000007"],
                  "home_goods_store": ["#00000008"]}
STORES = ["Store North", "Store South", "Store East", "Store West", "Store Central", "Store Harbour"]
TIERS = ["Gold Member", "Silver Member", "Standard Member"]


def build_partner(t: Tables):
    return marts.partner_members(t.f("customer"), STORES, TIERS)


def build_geo(t: Tables, samples: int = 5):
    return marts.geo_targets(t.f("geo_region"), t.f("geo_city"), "Malaysia", samples)


def build_trends(t: Tables):
    return marts.trend_snapshot(t.f("trend"), t.f("rising"))


# --- relations for the check SQL --------------------------------------------------------------

part("newest_customer", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cif_id ORDER BY rcd_dt DESC) AS rn FROM f_customer)
WHERE rn = 1""")
part("silver_customer", """
SELECT cif_id::varchar AS cif_id, rcd_dt AS record_refresh_date, trim(cif_nm) AS cif_nm, gender, marital_sts,
  citizen, state, region, race, occupation, emp_sts, age, yr_stay::decimal(18,2) AS yr_stay,
  yr_job::decimal(18,2) AS yr_job, net_income::decimal(18,2) AS net_income,
  gross_income::decimal(18,2) AS gross_income, annual_income::decimal(18,2) AS annual_income,
  coalesce(recv_promo, 'N') AS recv_promo
FROM newest_customer""")


def _d(col: str) -> str:
    return f"try_strptime(nullif(trim({col}::varchar), '0'), '%Y%m%d')::date"


part("silver_loan_app", f"""
SELECT appl_no::varchar AS appl_no, agree_no::varchar AS agree_no, cif_no::varchar AS cif_id,
  {_d('appl_dt')} AS application_date, trim(status) AS status, score::decimal(28,9) AS score, rank, decision,
  loan_grp::varchar AS loan_grp, fin_amt::decimal(28,9) AS fin_amt, inst_amt::decimal(28,9) AS inst_amt,
  interest::decimal(28,9) AS interest, total_inst, net_income::decimal(28,9) AS net_income,
  ndi::decimal(28,9) AS ndi, cur_dsr::decimal(28,9) AS cur_dsr, new_dsr::decimal(28,9) AS new_dsr,
  total_osb::decimal(28,9) AS total_osb
FROM f_loan_app""")
part("silver_card_app", f"""
SELECT appl_id::varchar AS appl_id, account_no::varchar AS account_no, cif_id::varchar AS cif_id,
  {_d('appl_dt')} AS application_date, trim(status) AS status, card_type, card_brand, decision, rank,
  net_income::decimal(28,9) AS net_income, ndi::decimal(28,9) AS ndi, cur_dsr::decimal(28,9) AS cur_dsr,
  new_dsr::decimal(28,9) AS new_dsr, cr_limit::decimal(28,9) AS cr_limit,
  final_score::decimal(28,9) AS final_score, final_score_desc
FROM f_card_app""")
part("silver_coll_summary", """
SELECT coalesce(l.k, c.k)::varchar AS cif_id, coalesce(l.u, 0) AS total_loan_unpaid,
  coalesce(c.u, 0) AS total_card_unpaid, coalesce(l.u, 0) + coalesce(c.u, 0) AS combined_unpaid,
  greatest(coalesce(l.g, 'A'), coalesce(c.g, 'A')) AS worst_collection_grade
FROM (SELECT cif_no AS k, sum(unpaid::decimal(18,2)) AS u, max(grade) AS g FROM f_loan_coll GROUP BY 1) l
FULL JOIN (SELECT cif_no AS k, sum(unpaid::decimal(18,2)) AS u, max(grade) AS g FROM f_card_coll GROUP BY 1) c
  ON l.k = c.k""")
part("gold_profile", """
SELECT c.cif_id, cif_nm, state, region, occupation, age, net_income, annual_income, recv_promo,
  coalesce(l.n, 0) AS loan_app_count, coalesce(l.total, 0) AS total_loan_financed, l.dsr AS avg_loan_dsr,
  coalesce(a.n, 0) AS card_app_count, coalesce(a.total, 0) AS total_card_limit, a.score AS latest_bureau_score,
  coalesce(total_loan_unpaid, 0) AS total_loan_unpaid, coalesce(total_card_unpaid, 0) AS total_card_unpaid,
  coalesce(combined_unpaid, 0) AS combined_unpaid,
  coalesce(worst_collection_grade, 'NONE') AS worst_collection_grade,
  coalesce(d.active, 0) AS active_card_count, coalesce(d.used, 0) AS total_cp_usage,
  coalesce(d.free, 0) AS total_cp_available
FROM silver_customer c
LEFT JOIN (SELECT cif_id, count(*) AS n, sum(coalesce(fin_amt, 0)) AS total,
    round(avg(new_dsr)::decimal(22,6), 2) AS dsr FROM silver_loan_app GROUP BY 1) l ON l.cif_id = c.cif_id
LEFT JOIN (SELECT cif_id, count(*) AS n, sum(coalesce(cr_limit, 0)) AS total, max(final_score) AS score
    FROM silver_card_app GROUP BY 1) a ON a.cif_id = c.cif_id
LEFT JOIN silver_coll_summary s ON s.cif_id = c.cif_id
LEFT JOIN (SELECT cif_id::varchar AS cif_id, count(*) FILTER (card_status = 'Active') AS active,
    sum(cp_usage::decimal(18,2)) AS used, sum(cp_available::decimal(18,2)) AS free FROM f_card GROUP BY 1) d
  ON d.cif_id = c.cif_id""")
part("feature_rows", """
SELECT cif_id, cif_nm, coalesce(state, 'Unknown') AS state, coalesce(region, 'Unknown') AS region,
  coalesce(occupation, 'Unknown') AS occupation, coalesce(age, 35)::bigint AS age,
  coalesce(net_income, 0)::double AS net_income, coalesce(annual_income, 0)::double AS annual_income, recv_promo,
  loan_app_count, total_loan_financed::double AS total_loan_financed,
  coalesce(avg_loan_dsr, 30)::double AS avg_loan_dsr, coalesce(latest_bureau_score, 650)::double AS latest_bureau_score,
  active_card_count, CASE WHEN active_card_count > 0 THEN 1 ELSE 0 END AS label_has_card
FROM gold_profile WHERE combined_unpaid = 0""")
part("silver_sales_all", f"""
SELECT 'CARD' AS product_line, cif_no::varchar AS cif_id, {_d('tx_dt')} AS tx_date, trim(ldesc) AS merchant_id,
  grp AS merchant_group, sales_type, amount::decimal(18,2) AS amount, trans_count FROM f_card_sales
UNION ALL
SELECT 'LOAN', cif_no, {_d('tx_dt::bigint')}, trim(ldesc), grp, sales_type, amount::decimal(18,2),
  trans_count::bigint FROM f_loan_sales""")
part("silver_coll_all", f"""
SELECT 'LOAN' AS product_line, {_d('tx_dt')} AS reporting_date, agree_no::varchar AS facility_account_no,
  cif_no::varchar AS cif_id, branch::varchar AS branch_id, del_sts AS delinquency_status,
  score_value::double AS score_value, grade, finplus AS finplus_tier, sub_code,
  billing::decimal(18,2) AS billing, collection::decimal(18,2) AS collection, unpaid::decimal(18,2) AS unpaid
FROM f_loan_coll
UNION ALL
SELECT 'CARD', {_d('tx_dt')}, account_no::varchar, cif_no::varchar, branch::varchar, dc_sts, score_value::double,
  grade, finplus, NULL, billing::decimal(18,2), collection::decimal(18,2), unpaid::decimal(18,2)
FROM f_card_coll""")
part("gold_wide", """
SELECT c.cif_id::varchar AS cif_id, cif_nm AS customer_name, age, gender, marital_sts, state, region, occupation,
  nob AS nature_of_business, net_income::decimal(18,2) AS net_income, gross_income::decimal(18,2) AS gross_income,
  race AS program_flag, coalesce(recv_promo, 'N') AS marketing_consent_flag,
  coalesce(p.tier, 'Non-Cardholder') AS wallet_tier, coalesce(p.held, 0) AS total_cards_held,
  coalesce(p.active, 0) AS active_cards_count, coalesce(p.akpk, 'N') AS akpk_status,
  coalesce(p.lim, 0) AS total_cp_limit, coalesce(p.used, 0) AS total_cp_usage,
  CASE WHEN p.lim <> 0 THEN p.used::double / p.lim::double END AS credit_utilization_ratio,
  coalesce(l.n, 0) AS loan_applications_count, coalesce(l.fin, 0) AS total_loan_financed,
  coalesce(l.dsr, 0.0)::double AS debt_service_ratio, coalesce(s.lo, 0) AS total_loan_spend,
  coalesce(s.ca, 0) AS total_card_spend, coalesce(s.al, 0) AS total_combined_spend,
  coalesce(s.n, 0)::bigint AS total_transactions_count, s.last AS last_transaction_date,
  coalesce(o.b, 0) AS total_billing, coalesce(o.c, 0) AS total_collection, coalesce(o.u, 0) AS total_unpaid,
  coalesce(o.f, 'Unrated') AS finplus_tier, coalesce(o.g, 'A') AS collection_grade,
  coalesce(o.u, 0) > 0 OR coalesce(p.akpk, 'N') = 'Y' AS has_unpaid_delinquency
FROM newest_customer c
LEFT JOIN (SELECT cif_id, count(DISTINCT account_no) AS held, count(*) FILTER (card_status = 'Active') AS active,
    max(tier) AS tier, max(akpk) AS akpk, sum(cp_cl::decimal(18,2)) AS lim, sum(cp_usage::decimal(18,2)) AS used
    FROM f_card GROUP BY 1) p ON p.cif_id = c.cif_id
LEFT JOIN (SELECT cif_no, count(DISTINCT appl_no) AS n, sum(fin_amt::decimal(18,2)) AS fin, max(new_dsr) AS dsr
    FROM f_loan_app GROUP BY 1) l ON l.cif_no = c.cif_id
LEFT JOIN (SELECT cif_id, sum(CASE WHEN product_line = 'LOAN' THEN amount ELSE 0 END) AS lo,
    sum(CASE WHEN product_line = 'CARD' THEN amount ELSE 0 END) AS ca, sum(amount) AS al,
    sum(trans_count) AS n, max(tx_date) AS last FROM silver_sales_all GROUP BY 1) s ON s.cif_id = c.cif_id::varchar
LEFT JOIN (SELECT cif_id, sum(billing) AS b, sum(collection) AS c, sum(unpaid) AS u, max(finplus_tier) AS f,
    max(grade) AS g FROM silver_coll_all GROUP BY 1) o ON o.cif_id = c.cif_id::varchar""")
_H = "(('0x' || substr(md5({}), 1, 15))::bigint % {})"
_C = "cif_id::varchar"
part("partner_rows", f"""
SELECT {_C} AS match_key, 'MEMBER_' || {_C} AS member_id,
  CASE {_H.format(_C, 6)} WHEN 0 THEN 'Store North' WHEN 1 THEN 'Store South' WHEN 2 THEN 'Store East'
    WHEN 3 THEN 'Store West' WHEN 4 THEN 'Store Central' ELSE 'Store Harbour' END AS preferred_store,
  CASE {_H.format(_C, 3)} WHEN 0 THEN 'Gold Member' WHEN 1 THEN 'Silver Member' ELSE 'Standard Member' END
    AS loyalty_tier,
  (180 + {_H.format(_C + " || '_retail'", 2400)})::decimal(18,2) AS retail_spend,
  2 + {_H.format(_C, 18)} AS monthly_visits
FROM f_customer WHERE {_H.format(_C, 10)} < 7""")
part("joint_rows", """
SELECT c.cif_id::varchar AS cif_id, c.state, c.marital_sts, c.gross_income::decimal(18,2) AS monthly_income,
  s.amount::decimal(18,2) AS card_spend, p.retail_spend AS partner_spend, p.preferred_store, p.loyalty_tier
FROM f_customer c JOIN f_card_sales s ON c.cif_id = s.cif_no JOIN partner_rows p ON p.match_key = c.cif_id::varchar""")
part("geo_target_rows", """
SELECT r.region_iso, r.target_region, r.country, r.subcontinent,
  CASE r.region_iso WHEN 'MY-01' THEN 'Johor' WHEN 'MY-02' THEN 'Kedah' WHEN 'MY-03' THEN 'Kelantan'
    WHEN 'MY-04' THEN 'Melaka' WHEN 'MY-05' THEN 'Negeri Sembilan' WHEN 'MY-06' THEN 'Pahang'
    WHEN 'MY-07' THEN 'Pulau Pinang' WHEN 'MY-08' THEN 'Perak' WHEN 'MY-09' THEN 'Perlis'
    WHEN 'MY-10' THEN 'Selangor' WHEN 'MY-11' THEN 'Terengganu' WHEN 'MY-12' THEN 'Sabah'
    WHEN 'MY-13' THEN 'Sarawak' WHEN 'MY-14' THEN 'Kuala Lumpur' WHEN 'MY-15' THEN 'Labuan'
    WHEN 'MY-16' THEN 'Putrajaya' ELSE r.target_region END AS state,
  count(DISTINCT c.criteria_id) AS criteria_ids, count(DISTINCT c.target_city) AS cities,
  array_to_string(list_sort(list(DISTINCT c.target_city) FILTER (c.target_city IS NOT NULL))[1:5], ', ')
    AS sample_cities
FROM f_geo_region r LEFT JOIN f_geo_city c ON r.country = c.country AND r.target_region = c.target_region
GROUP BY 1, 2, 3, 4""")
part("trend_rows", """
SELECT * FROM (
  SELECT t.*, r.percent_gain,
    row_number() OVER (PARTITION BY t.region_no, t.rank ORDER BY t.week DESC, t.term) AS rn
  FROM f_trend t LEFT JOIN f_rising r ON t.refresh_date = r.refresh_date AND t.week = r.week
    AND t.region_no = r.region_no AND t.term = r.term
  WHERE t.refresh_date = (SELECT max(refresh_date) FROM f_trend) AND t.rank <= 5) WHERE rn = 1""")
part("creative_rows", """
SELECT upper(trim(ad_format)) AS ad_format, topic, verification,
  count(DISTINCT advertiser_id) AS advertisers, count(DISTINCT creative_id) AS creatives,
  count(*) FILTER (location = 'MY') AS domestic_creatives,
  CASE upper(trim(ad_format)) WHEN 'IMAGE' THEN 'Gold' WHEN 'VIDEO' THEN 'Platinum' WHEN 'TEXT' THEN 'Silver'
    ELSE 'Basic' END AS wallet_tier
FROM f_creative WHERE verification = 'VERIFIED' AND ad_format IS NOT NULL AND topic IS NOT NULL GROUP BY 1, 2, 3""")


def doubles(*cols: str) -> str:
    return ", ".join(f"{c}::double AS {c}" for c in cols)


# --- queries ----------------------------------------------------------------------------------

@query("dp_01_customer_master", f"""
SELECT * REPLACE ({doubles('yr_stay', 'yr_job', 'net_income', 'gross_income', 'annual_income')})
FROM silver_customer""")
def dp_01(t):
    return silver.customers(t.f("customer"))


@query("dp_02_loan_applications", f"""
SELECT * REPLACE ({doubles('score', 'fin_amt', 'inst_amt', 'interest', 'net_income', 'ndi', 'cur_dsr',
                           'new_dsr', 'total_osb')}) FROM silver_loan_app""")
def dp_02(t):
    return silver.loan_applications(t.f("loan_app"))


@query("dp_03_card_applications", f"""
SELECT * REPLACE ({doubles('net_income', 'ndi', 'cur_dsr', 'new_dsr', 'cr_limit', 'final_score')})
FROM silver_card_app""")
def dp_03(t):
    return silver.card_applications(t.f("card_app"))


@query("dp_04_collections_summary", f"""
SELECT * REPLACE ({doubles('total_loan_unpaid', 'total_card_unpaid', 'combined_unpaid')}) FROM silver_coll_summary""")
def dp_04(t):
    return silver.collections_summary(t.f("loan_coll"), t.f("card_coll"))


PROFILE_SQL = f"""
SELECT * REPLACE ({doubles('net_income', 'annual_income', 'total_loan_financed', 'avg_loan_dsr',
    'total_card_limit', 'latest_bureau_score', 'total_loan_unpaid', 'total_card_unpaid', 'combined_unpaid',
    'total_cp_usage', 'total_cp_available')}) FROM gold_profile"""


@query("dp_05_customer_profile", PROFILE_SQL)
def dp_05(t):
    return build_profile(t)


@query("dp_06_underwriting_funnel", f"""
SELECT 'Loan' AS product_line, appl_no::varchar AS application_id, cif_no::varchar AS cif_id,
  {_d('appl_dt')} AS application_date, {_d('judge_dt')} AS decision_date, channel AS application_channel,
  trim(status) AS decision_status, rank AS score_rank, score::double AS credit_score,
  reject_code AS decline_reason_code, fin_amt AS exposure, net_income, new_dsr FROM f_loan_app
UNION ALL
SELECT 'Card', appl_id::varchar, cif_id::varchar, {_d('appl_dt')}, {_d('judge_dt')}, channel, trim(status), rank,
  final_score::double, decline_id::varchar, cr_limit, net_income::double, new_dsr::double FROM f_card_app""")
def dp_06(t):
    return marts.underwriting_funnel(t.f("loan_app"), t.f("card_app"))


_RISK = """
FROM silver_coll_all o LEFT JOIN {cust} c ON o.cif_id = c.cif_id::varchar
LEFT JOIN (SELECT account_no, akpk FROM f_card) k ON o.facility_account_no = k.account_no::varchar"""
part("risk_rows", f"""
SELECT product_line, reporting_date, facility_account_no, o.cif_id, coalesce(state, 'Unknown') AS state,
  coalesce(region, 'Unknown') AS region, coalesce(occupation, 'Unknown') AS occupation, branch_id,
  delinquency_status, score_value, grade, finplus_tier, coalesce(sub_code, akpk, 'N') AS akpk_indicator,
  billing, collection, unpaid,
  CASE WHEN billing <> 0 THEN collection::double / billing::double END AS collection_efficiency
{_RISK.format(cust='newest_customer')}""")


@query("dp_07_collections_risk", f"""
SELECT * REPLACE ({doubles('billing', 'collection', 'unpaid')}) FROM risk_rows""")
def dp_07(t):
    return marts.collections_risk(build_collections(t), t.f("customer"), t.f("card"))


@query("dp_07b_collections_risk_raw_dims", f"""
SELECT product_line, reporting_date, facility_account_no, o.cif_id, state, region, occupation, branch_id,
  delinquency_status, score_value, grade, finplus_tier, coalesce(sub_code, akpk, 'N') AS akpk_indicator,
  {doubles('billing', 'collection', 'unpaid')},
  CASE WHEN billing <> 0 THEN collection::double / billing::double END AS collection_efficiency
{_RISK.format(cust='f_customer')}""")
def dp_07b(t):
    return marts.collections_risk(build_collections(t), t.f("customer"), t.f("card"), dedup_dims=False)


@query("dp_08_wide_customer_mart", f"""
SELECT * REPLACE ({doubles('net_income', 'gross_income', 'total_cp_limit', 'total_cp_usage',
    'total_loan_financed', 'total_loan_spend', 'total_card_spend', 'total_combined_spend', 'total_billing',
    'total_collection', 'total_unpaid')}) FROM gold_wide""")
def dp_08(t):
    return build_wide(t)


@query("dp_09_merchant_spend", """
SELECT grp AS merchant_group, ldesc AS location_name, count(*) AS total_transactions,
  sum(amount::decimal(18,2))::double AS total_spending FROM f_card_sales GROUP BY 1, 2""")
def dp_09(t):
    return marts.merchant_spend(t.f("card_sales"))


@query("dp_10_partner_members", "SELECT * REPLACE (retail_spend::double AS retail_spend) FROM partner_rows")
def dp_10(t):
    return build_partner(t)


@query("dp_11_joint_spend", f"""
SELECT * REPLACE ({doubles('monthly_income', 'card_spend', 'partner_spend')}) FROM joint_rows""")
def dp_11(t):
    return marts.joint_spend(t.f("customer"), t.f("card_sales"), build_partner(t))


@query("dp_11b_joint_spend_per_customer", """
SELECT c.cif_id::varchar AS cif_id, c.state, c.marital_sts, c.gross_income::decimal(18,2)::double AS monthly_income,
  s.spend::double AS card_spend, p.retail_spend::double AS partner_spend, p.preferred_store, p.loyalty_tier
FROM newest_customer c
JOIN (SELECT cif_no, sum(amount::decimal(18,2)) AS spend FROM f_card_sales GROUP BY 1) s ON s.cif_no = c.cif_id
JOIN (SELECT DISTINCT * FROM partner_rows) p ON p.match_key = c.cif_id::varchar""")
def dp_11b(t):
    return marts.joint_spend_per_customer(t.f("customer"), t.f("card_sales"), build_partner(t))


@query("dp_12_feature_store", "SELECT * FROM feature_rows")
def dp_12(t):
    return build_features(t)


@query("dp_13_tier_portfolio", """
SELECT wallet_tier, count(DISTINCT cif_id) AS customer_count, count(*) FILTER (akpk_status = 'Y') AS akpk_count,
  sum(total_cp_limit)::double AS total_cp_limit, sum(total_cp_usage)::double AS total_cp_usage,
  sum(total_unpaid)::double AS total_unpaid,
  round((avg(credit_utilization_ratio::decimal(18,6))::decimal(22,10) * 100)::decimal(26,10), 2)::double
    AS avg_utilization_pct
FROM gold_wide GROUP BY 1""")
def dp_13(t):
    return profile.tier_portfolio(gold_wide(t))


@query("dp_14_geo_targets", "SELECT * FROM geo_target_rows")
def dp_14(t):
    return build_geo(t)


@query("dp_15_trend_snapshot", "SELECT * EXCLUDE (rn) FROM trend_rows")
def dp_15(t):
    return build_trends(t)


@query("dp_16_state_trends", """
SELECT s.region_no, c.state, c.region, s.latest_refresh_date, s.avg_score::double AS avg_score, s.peak_score,
  s.top_terms, c.n AS active_customers, c.income::double AS avg_gross_income
FROM (SELECT region_name, region_no, max(refresh_date) AS latest_refresh_date,
    round(avg(score)::decimal(20,6), 1) AS avg_score, max(score) AS peak_score,
    array_to_string(list(term || ' (#' || rank::varchar || ')' ORDER BY rank)[1:3], ', ') AS top_terms
  FROM trend_rows GROUP BY 1, 2) s
JOIN (SELECT state, region, count(DISTINCT cif_id) AS n,
    round(avg(gross_income::decimal(18,2))::decimal(22,6), 2) AS income FROM f_customer GROUP BY 1, 2) c
  ON upper(trim(c.state)) = upper(trim(s.region_name))""")
def dp_16(t):
    return marts.state_trends(build_trends(t), t.f("customer"))


@query("dp_17_category_benchmark", """
SELECT s.*, p.total_pois, p.card_pois, p.nfc_pois, p.max_rating
FROM (SELECT ldesc AS location, grp AS merchant_group, count(*) AS tx_count,
    sum(amount::decimal(18,2))::double AS total_spend,
    CASE WHEN upper(ldesc) LIKE '%#00000000%' THEN 'department_store'
      WHEN upper(ldesc) LIKE '%#00000001%' OR upper(ldesc) LIKE '%#00000002%' THEN 'supermarket'
      WHEN upper(ldesc) LIKE '%#00000003%' THEN 'electronics_store'
      WHEN upper(ldesc) LIKE '%#00000004%' OR upper(ldesc) LIKE '%#00000005%' THEN 'pharmacy'
      WHEN upper(ldesc) LIKE '%#00000006%' THEN 'restaurant'
      WHEN upper(ldesc) LIKE '%#00000007%' THEN 'gas_station'
      WHEN upper(ldesc) LIKE '%#00000008%' THEN 'home_goods_store' ELSE 'shopping_mall' END AS primary_type
  FROM f_card_sales GROUP BY 1, 2) s LEFT JOIN f_place_summary p ON p.primary_type = s.primary_type""")
def dp_17(t):
    return marts.category_benchmark(t.f("card_sales"), t.f("place_summary"), CATEGORY_RULES, "shopping_mall")


@query("dp_18_creative_benchmark", "SELECT * FROM creative_rows")
def dp_18(t):
    return marts.creative_benchmark(t.f("creative"), "MY")


part("geo_card_source", """
SELECT region_iso, state, target_region, criteria_ids, sample_cities FROM geo_target_rows""")


@query("dp_19_geo_cards", """
SELECT g.region_iso, g.state, g.target_region, g.criteria_ids, g.sample_cities, p.tier AS wallet_tier,
  b.ad_format AS primary_format, b.n AS benchmark_creatives, count(DISTINCT p.account_no) AS active_cards,
  sum(p.cp_usage::decimal(18,2))::double AS total_usage
FROM (SELECT * REPLACE ('NATION_' || (row_number() OVER (ORDER BY region_iso) - 1)::varchar AS state)
      FROM geo_card_source) g
JOIN f_customer m ON upper(trim(g.state)) = upper(trim(m.state))
JOIN f_card p ON p.cif_id = m.cif_id
LEFT JOIN (SELECT wallet_tier, ad_format, sum(creatives)::bigint AS n FROM creative_rows GROUP BY 1, 2) b
  ON b.wallet_tier = p.tier
WHERE p.card_status = 'Active' GROUP BY 1, 2, 3, 4, 5, 6, 7, 8""")
def dp_19(t):
    geo = build_geo(t).withColumn("state", F.col("target_region"))
    return marts.geo_cards(geo, t.f("customer"), t.f("card"), marts.creative_benchmark(t.f("creative"), "MY"))


@query("dp_20_cross_source_sales", """
SELECT c.state, s.sales_type, s.card_status, count(DISTINCT s.cif_no) AS active_customers,
  sum(s.trans_count)::bigint AS total_transactions, sum(s.amount::decimal(18,2))::double AS total_sales
FROM (SELECT s.*, p.card_status FROM f_card_sales s JOIN f_card p ON s.cif_no = p.cif_id
      UNION ALL
      SELECT s.*, p.card_status FROM f_card_sales s JOIN f_card p ON s.tx_dt = p.cif_id AND s.cif_no <> p.cif_id) s
JOIN f_customer c ON s.cif_no = c.cif_id GROUP BY 1, 2, 3""")
def dp_20(t):
    return marts.cross_source_sales(t.f("card_sales"), t.f("customer"), t.f("card"))


@query("dp_21_tier_summary", """
SELECT card_status, tier, count(*) AS total_cards,
  round(avg(cp_cl::decimal(18,2))::decimal(22,6), 2)::double AS avg_limit FROM f_card GROUP BY 1, 2""")
def dp_21(t):
    return marts.tier_summary(t.f("card"))


def max_days(t: Tables):
    days = t.f("loan_coll").select("cif_no", "days_past_due").unionByName(
        t.f("card_coll").select("cif_no", "days_past_due"))
    return days.groupBy(F.col("cif_no").cast("string").alias("cif_id")).agg(
        F.max("days_past_due").alias("days_past_due"))


@query("dp_23_business_bands", """
SELECT p.cif_id, net_income::double AS net_income,
  CASE WHEN net_income < 3000 THEN 'B40' WHEN net_income <= 7000 THEN 'M40' WHEN net_income > 7000 THEN 'T20' END
    AS income_band,
  CASE WHEN coalesce(d.dpd, 0) <= 0 THEN 'M0' WHEN d.dpd <= 30 THEN 'M1' WHEN d.dpd <= 60 THEN 'M2'
    WHEN d.dpd <= 90 THEN 'M3' ELSE 'M4+' END AS arrears_bucket,
  coalesce(total_card_limit <> 0 AND total_cp_usage > total_card_limit * 0.8, false) AS high_utilisation,
  CASE WHEN avg_loan_dsr > 100 THEN 'QUARANTINE' WHEN avg_loan_dsr > 60 THEN 'REVIEW' ELSE 'OK' END AS dsr_review
FROM gold_profile p LEFT JOIN (
  SELECT cif_no::varchar AS cif_id, max(days_past_due) AS dpd FROM (
    SELECT cif_no, days_past_due FROM f_loan_coll UNION ALL SELECT cif_no, days_past_due FROM f_card_coll)
  GROUP BY 1) d ON d.cif_id = p.cif_id""")
def dp_23(t):
    return profile.business_bands(gold_profile(t), max_days(t))
