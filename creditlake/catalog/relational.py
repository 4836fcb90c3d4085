"""Joins, aggregations, windows, ordered limits and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import aggregates as agg
from ..functions.scalars import key, money
from ..operators import joins, sets, topk, windows
from ..operators.lists import top_list
from ..plans import silver
from ..sources.tables import column_listing
from .base import query
from .products import build_collections, gold_profile, build_sales, build_trends

# --- joins ------------------------------------------------------------------------------------


@query("jn_01_star", """
SELECT c.c_custkey, o.n AS orders, p.n AS purchases FROM customer c
LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT user_id, count(*) AS n FROM events GROUP BY 1) p ON p.user_id = c.c_custkey""")
def jn_01(t):
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("orders"))
    events = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("purchases"))
    return joins.star(t.customer.select("c_custkey"), orders, events, on="c_custkey")


@query("jn_02_full_outer", """
SELECT coalesce(l.cif_no, c.cif_id) AS cif_id, l.n AS loans, c.n AS cards
FROM (SELECT cif_no, count(*) AS n FROM f_loan_app WHERE cif_no % 3 <> 1 GROUP BY 1) l
FULL JOIN (SELECT cif_id, count(*) AS n FROM f_card GROUP BY 1) c ON l.cif_no = c.cif_id""")
def jn_02(t):
    loans = t.f("loan_app").where(F.col("cif_no") % 3 != 1).groupBy(F.col("cif_no").alias("cif_id")).agg(
        F.count(F.lit(1)).alias("loans"))
    return joins.full_on(loans, t.f("card").groupBy("cif_id").agg(F.count(F.lit(1)).alias("cards")), "cif_id")


@query("jn_03_inner_three", """
SELECT p.loyalty_tier, count(*) AS n, sum(s.amount::decimal(18,2))::double AS spend
FROM newest_customer c JOIN f_card_sales s ON s.cif_no = c.cif_id
JOIN (SELECT DISTINCT * FROM partner_rows) p ON p.match_key = c.cif_id::varchar GROUP BY 1""")
def jn_03(t):
    from .products import build_partner
    cust = silver.newest_customers(t.f("customer")).select(key("cif_id").alias("cif_id"))
    sales = t.f("card_sales").groupBy(key("cif_no").alias("cif_id")).agg(F.count(F.lit(1)).alias("sales"), F.sum(money("amount")).alias("amount"))
    members = build_partner(t).distinct().select(F.col("match_key").alias("cif_id"), "loyalty_tier")
    return cust.join(members, "cif_id").join(sales, "cif_id").groupBy("loyalty_tier").agg(
        F.sum("sales").alias("n"), F.round(F.sum("amount"), 2).alias("spend"))


@query("jn_04_folded_text", """
SELECT c_custkey, n_regionkey FROM customer JOIN nation
  ON upper(trim(' nation_' || c_nationkey::varchar)) = upper(trim(n_name))""")
def jn_04(t):
    cust = t.customer.select("c_custkey", F.concat(F.lit(" nation_"), F.col("c_nationkey").cast("string")).alias("st"))
    return joins.join_folded(cust, t.nation, "st", "n_name").select("c_custkey", "n_regionkey")


@query("jn_05_any_of", """
SELECT o_orderkey, p_partkey FROM orders JOIN part ON o_custkey = p_partkey
UNION ALL
SELECT o_orderkey, p_partkey FROM orders JOIN part ON o_orderkey = p_partkey WHERE o_custkey <> p_partkey""")
def jn_05(t):
    return joins.join_any_of(t.orders.select("o_orderkey", "o_custkey"), t.part.select("p_partkey"),
                             [("o_custkey", "p_partkey"), ("o_orderkey", "p_partkey")]).drop("o_custkey")


@query("jn_06_distance", "SELECT hub_id, poi_id FROM near_rows")
def jn_06(t):
    from .geo import near
    return near(t).select("hub_id", "poi_id")


@query("jn_07_four_columns", """
SELECT t.week, t.region_no, t.term, r.percent_gain FROM f_trend t LEFT JOIN f_rising r
  ON t.refresh_date = r.refresh_date AND t.week = r.week AND t.region_no = r.region_no AND t.term = r.term""")
def jn_07(t):
    return t.f("trend").join(t.f("rising"), ["refresh_date", "week", "region_no", "term"], "left").select(
        "week", "region_no", "term", "percent_gain")


@query("jn_08_latest_refresh", "SELECT week, region_no, term FROM f_trend "
                               "WHERE refresh_date = (SELECT max(refresh_date) FROM f_trend)")
def jn_08(t):
    return joins.at_latest(t.f("trend"), "refresh_date").select("week", "region_no", "term")


@query("jn_09_shared_neighbours", """
SELECT m AS merchant_id, count(*) AS customers, (count(*) * (count(*) - 1)) // 2 AS pairs
FROM (SELECT DISTINCT ldesc AS m, cif_no FROM f_card_sales WHERE trim(ldesc) <> '') GROUP BY 1 HAVING count(*) > 1""")
def jn_09(t):
    """Customer pairs per shared merchant, counted without listing them."""
    from ..operators.rings import pair_counts
    edges = t.f("card_sales").where(F.trim("ldesc") != "").select(
        F.col("ldesc").alias("merchant_id"), "cif_no").distinct()
    return pair_counts(edges, ["merchant_id"], "customers", "pairs")


@query("jn_10_wide_to_long", """
SELECT cif_id, measure, amount FROM (SELECT cif_id, unnest(['net', 'gross']) AS measure,
  unnest([net_income, gross_income]) AS amount FROM f_customer)""")
def jn_10(t):
    return joins.explode_wide(t.f("customer").select("cif_id", F.col("net_income").alias("net"),
                                                     F.col("gross_income").alias("gross")),
                              ["cif_id"], ["net", "gross"], "measure", "amount")


@query("jn_11_two_dims", """
SELECT s.o_orderkey, c.state, k.tier FROM orders s LEFT JOIN newest_customer c ON c.cif_id = s.o_custkey
LEFT JOIN f_card k ON k.account_no = s.o_orderkey""")
def jn_11(t):
    cust = silver.newest_customers(t.f("customer")).select(F.col("cif_id").alias("o_custkey"), "state")
    card = windows.latest_per(t.f("card"), ["account_no"], "expiry_dt", ("cif_id",)).select(
        F.col("account_no").alias("o_orderkey"), "tier")
    return t.orders.select("o_orderkey", "o_custkey").join(cust, "o_custkey", "left").join(
        card, "o_orderkey", "left").drop("o_custkey")


@query("jn_12_known_endpoints", "SELECT event_id, user_id FROM events WHERE user_id IN (SELECT cif_id FROM f_card)")
def jn_12(t):
    return joins.keep_known(t.events.select("event_id", "user_id"), t.f("card"), "user_id", "cif_id")


@query("jn_13_orphans", "SELECT event_id, user_id FROM events WHERE user_id NOT IN (SELECT cif_id FROM f_card)")
def jn_13(t):
    return joins.orphans(t.events.select("event_id", "user_id"), t.f("card"), "user_id", "cif_id")


# --- aggregations -----------------------------------------------------------------------------

@query("ag_01_measures", """
SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_extendedprice::decimal(18,2))::double AS total,
  round(avg(l_extendedprice::decimal(18,2))::decimal(22,6), 2)::double AS average,
  min(l_quantity) AS lo, max(l_quantity) AS hi FROM lineitem GROUP BY 1, 2""")
def ag_01(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), agg.sum_money("l_extendedprice").alias("total"),
        agg.avg_money("l_extendedprice").alias("average"), F.min("l_quantity").alias("lo"),
        F.max("l_quantity").alias("hi"))


@query("ag_02_conditional_count", "SELECT cif_id, count(*) FILTER (trim(card_status) = 'Active') AS active FROM f_card GROUP BY 1")
def ag_02(t):
    return t.f("card").groupBy("cif_id").agg(F.count_if(key("card_status") == "Active").alias("active"))


@query("ag_03_distinct_counts", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS orders, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1""")
def ag_03(t):
    return t.lineitem.groupBy("l_returnflag").agg(F.count_distinct("l_orderkey").alias("orders"),
                                                  F.count_distinct("l_partkey").alias("parts"))


@query("ag_04_conditional_sum", """
SELECT cif_id, sum(CASE WHEN product_line = 'LOAN' THEN amount ELSE 0 END)::double AS loan,
  sum(CASE WHEN product_line = 'CARD' THEN amount ELSE 0 END)::double AS card FROM silver_sales_all GROUP BY 1""")
def ag_04(t):
    line = F.col("product_line")
    return build_sales(t).groupBy("cif_id").agg(agg.sum_if(line == "LOAN", "amount").alias("loan"),
                                                agg.sum_if(line == "CARD", "amount").alias("card"))


@query("ag_05_distinct_list", """
SELECT state, array_to_string(list_sort(list(DISTINCT occupation))[1:3], ', ') AS occupations FROM f_customer GROUP BY 1""")
def ag_05(t):
    return top_list(t.f("customer"), ["state"], F.col("occupation"), [F.col("occupation")], 3, "occupations",
                    distinct=True)


@query("ag_06_ordered_list", """
SELECT region_no, array_to_string(list(term ORDER BY score DESC, term, week)[1:3], ', ') AS terms
FROM f_trend GROUP BY 1""")
def ag_06(t):
    return top_list(t.f("trend"), ["region_no"], F.col("term"), [-F.col("score"), F.col("term"), F.col("week")],
                    3, "terms")


@query("ag_07_ordinal_list", """
SELECT 'customer' AS table_name, 'cif_id=' || count(cif_id)::varchar || ', state=' || count(state)::varchar || ', citizen='
  || count(citizen)::varchar || ', recv_promo=' || count(recv_promo)::varchar AS columns FROM f_customer""")
def ag_07(t):
    """Column definitions in ordinal order: a list as long as the table is wide."""
    cols = column_listing(t.f("customer").select("cif_id", "state", "citizen", "recv_promo"))
    item = cols.withColumn("item", F.concat("column_name", F.lit("="), F.col("values").cast("string")))
    return item.groupBy(F.lit("customer").alias("table_name")).agg(
        F.expr("listagg(item, ', ') within group (order by ordinal)").alias("columns"))


@query("ag_08_any_value", "SELECT ldesc, min(grp) AS grp FROM f_card_sales GROUP BY 1")
def ag_08(t):
    return t.f("card_sales").groupBy("ldesc").agg(F.min("grp").alias("grp"))


@query("ag_09_total_row", """
SELECT coalesce(state, 'TOTAL') AS state, count(*) AS n, sum(net_income::decimal(18,2))::double AS income
FROM f_customer GROUP BY ROLLUP (state)""")
def ag_09(t):
    return (t.f("customer").rollup("state")
            .agg(F.count(F.lit(1)).alias("n"), agg.sum_money("net_income").alias("income"),
                 F.grouping("state").alias("is_total"))
            .orderBy("is_total", "state")
            .select(F.when(F.col("is_total") == 1, "TOTAL").otherwise(F.col("state")).alias("state"), "n", "income"))


@query("ag_10_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 12")
def ag_10(t):
    return t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 12)


@query("ag_11_audit_row", """
SELECT count(*) AS customers, count(DISTINCT state) AS states, count(*) FILTER (combined_unpaid > 0) AS delinquent,
  round(avg(net_income)::decimal(22,6), 2)::double AS avg_income FROM gold_profile""")
def ag_11(t):
    return gold_profile(t).agg(
        F.count(F.lit(1)).alias("customers"), F.count_distinct("state").alias("states"),
        F.count_if(F.col("combined_unpaid") > 0).alias("delinquent"), agg.avg_money("net_income").alias("avg_income"))


EIGHT = ["state", "region", "occupation", "gender", "marital_sts", "tier", "card_status", "akpk"]


@query("ag_12_eight_keys", f"""
SELECT {', '.join(EIGHT)}, count(*) AS n, sum(amount)::double AS spend
FROM newest_customer c JOIN f_card k ON k.cif_id = c.cif_id
JOIN (SELECT cif_no, sum(amount::decimal(18,2)) AS amount FROM f_card_sales GROUP BY 1) s ON s.cif_no = c.cif_id
GROUP BY {', '.join(EIGHT)}""")
def ag_12(t):
    spend = t.f("card_sales").groupBy(F.col("cif_no").alias("cif_id")).agg(agg.sum_money("amount").alias("amount"))
    return silver.newest_customers(t.f("customer")).join(spend, "cif_id").join(t.f("card"), "cif_id").groupBy(*EIGHT).agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount").alias("spend"))


@query("ag_13_count_or_one", "SELECT ldesc, sum(coalesce(trans_count, 1))::bigint AS n FROM f_card_sales GROUP BY 1")
def ag_13(t):
    return t.f("card_sales").groupBy("ldesc").agg(agg.count_or_one("trans_count").alias("n"))


@query("ag_14_worst_grade", "SELECT cif_no, max(trim(grade)) AS worst FROM f_card_coll GROUP BY 1")
def ag_14(t):
    return t.f("card_coll").groupBy("cif_no").agg(F.max(key("grade")).alias("worst"))


@query("ag_15_gate", """
SELECT (SELECT sum(fin_amt::decimal(18,2)) FROM f_loan_app) - (SELECT sum(fin_amt) FROM silver_loan_app) = 0
  AND (SELECT count(*) FROM gold_profile) > 0 AS passed""")
def ag_15(t):
    from ..operators.quality import zero_variance_gate
    return zero_variance_gate(t.f("loan_app"), silver.loan_applications(t.f("loan_app")), "fin_amt",
                              [gold_profile(t)])


# --- windows ----------------------------------------------------------------------------------

@query("wn_01_latest_record", "SELECT cif_id, rcd_dt, net_income FROM newest_customer")
def wn_01(t):
    return silver.newest_customers(t.f("customer")).select("cif_id", "rcd_dt", "net_income")


@query("wn_02_first_per_two_keys", "SELECT region_no, rank, week, term FROM trend_rows")
def wn_02(t):
    return build_trends(t).select("region_no", "rank", "week", "term")


@query("wn_03_total_on_rows", "SELECT cif_id, count(*) OVER () AS total_customers FROM gold_profile")
def wn_03(t):
    return windows.with_totals(gold_profile(t).select("cif_id"), total_customers=F.count(F.lit(1)))


@query("wn_04_distinct_total_on_rows", "SELECT cif_id, (SELECT count(DISTINCT state) FROM gold_profile) AS total_states FROM gold_profile")
def wn_04(t):
    return windows.with_totals(gold_profile(t).select("cif_id", "state"),
                               total_states=F.count_distinct("state")).drop("state")


@query("wn_05_total_over_groups", """
SELECT state, count(*) AS customers, (sum(count(*)) OVER ())::bigint AS total FROM gold_profile GROUP BY 1""")
def wn_05(t):
    groups = gold_profile(t).groupBy("state").agg(F.count(F.lit(1)).alias("customers"))
    return windows.with_totals(groups, total=F.sum("customers"))


# --- ordered limits ---------------------------------------------------------------------------

@query("sl_01_top_k", "SELECT cif_id, net_income::double AS net_income FROM gold_profile "
                      "ORDER BY net_income DESC, cif_id LIMIT 15")
def sl_01(t):
    return topk.top_k(gold_profile(t).select("cif_id", "net_income"),
                      [F.col("net_income").desc(), F.col("cif_id").asc()], 15)


@query("sl_02_order_by_expression", """
SELECT cif_id FROM gold_profile ORDER BY CASE WHEN recv_promo = 'Y' THEN 1 ELSE 2 END,
  total_loan_financed + total_card_limit DESC, cif_id LIMIT 10""")
def sl_02(t):
    return topk.top_k(gold_profile(t), [
        F.when(F.col("recv_promo") == "Y", 1).otherwise(2).asc(),
        (F.col("total_loan_financed") + F.col("total_card_limit")).desc(), F.col("cif_id").asc()], 10).select("cif_id")


@query("sl_03_ordered_view", "SELECT state, count(*) AS n FROM f_customer GROUP BY 1")
def sl_03(t):
    return t.f("customer").groupBy("state").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "state")


@query("sl_04_hash_sample", """
SELECT topic, count(*) AS n FROM (SELECT topic FROM f_creative WHERE verification = 'VERIFIED'
  ORDER BY md5(creative_id::varchar), creative_id LIMIT 5000) GROUP BY 1""")
def sl_04(t):
    rows = t.f("creative").where(F.col("verification") == "VERIFIED").select("topic", "creative_id")
    return topk.hash_sample(rows, "creative_id", 5000).groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("sl_05_top_k_per_group", """
SELECT cif_no, ldesc, total::double AS total FROM (
  SELECT *, row_number() OVER (PARTITION BY cif_no ORDER BY total DESC, ldesc) AS rn
  FROM (SELECT cif_no, ldesc, sum(amount::decimal(18,2)) AS total FROM f_card_sales GROUP BY 1, 2)) WHERE rn <= 3""")
def sl_05(t):
    spend = t.f("card_sales").groupBy("cif_no", "ldesc").agg(agg.sum_money("amount").alias("total"))
    return windows.top_per(spend, ["cif_no"], [F.col("total").desc(), F.col("ldesc").asc()], 3)


# --- unions -----------------------------------------------------------------------------------

@query("so_01_conforming_union", """
SELECT product_line, facility_account_no, sub_code, unpaid::double AS unpaid FROM silver_coll_all""")
def so_01(t):
    return build_collections(t).select("product_line", "facility_account_no", "sub_code", "unpaid")


@query("so_02_rule_union", """
SELECT 'over_limit' AS rule, account_no::varchar AS k FROM f_card WHERE cp_usage > cp_cl
UNION ALL SELECT 'no_income', cif_id::varchar FROM f_customer WHERE net_income <= 0""")
def so_02(t):
    over = t.f("card").where(F.col("cp_usage") > F.col("cp_cl")).select(
        F.lit("over_limit").alias("rule"), key("account_no").alias("k"))
    none = t.f("customer").where(F.col("net_income") <= 0).select(F.lit("no_income").alias("rule"), key("cif_id").alias("k"))
    return sets.union_all([over, none])


@query("so_03_distinct_union", """
SELECT count(*) AS customers FROM (SELECT cif_no FROM f_loan_coll UNION SELECT cif_no FROM f_card_coll)""")
def so_03(t):
    return t.f("loan_coll").select("cif_no").union(t.f("card_coll").select("cif_no")).distinct().agg(
        F.count(F.lit(1)).alias("customers"))


@query("so_04_labelled_counts", """
SELECT 'customers' AS label, count(*) AS row_count FROM f_customer UNION ALL SELECT 'cards', count(*) FROM f_card
UNION ALL SELECT 'sales', count(*) FROM f_card_sales""")
def so_04(t):
    return sets.labelled_counts({"customers": t.f("customer"), "cards": t.f("card"), "sales": t.f("card_sales")})


@query("so_05_schema_evolution", """
SELECT appl_id, cr_limit, NULL::varchar AS card_type FROM f_card_app
UNION ALL SELECT appl_id, cr_limit, card_type FROM f_card_app""")
def so_05(t):
    v2 = t.f("card_app").select("appl_id", "cr_limit", "card_type")
    return sets.union_all([v2.drop("card_type"), v2], missing=True)
