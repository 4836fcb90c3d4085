"""Graph tables and graph questions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.graph import Edge, Hop, Node, PropertyGraph
from ..operators.topk import top_k
from ..plans import graph_queries as q
from ..plans.graph_tables import EDGE_ENDS, NODE_KEYS, credit_graph
from .base import is_stored, part, query, stored
from .products import build_collections, build_sales, doubles


def built_graph(t, **kwargs):
    return credit_graph(t.f("customer"), t.f("card"), t.f("loan_app"), t.f("card_app"), build_sales(t),
                        build_collections(t), **kwargs)


def graph(t):
    """The graph over its written tables, as questions are asked of it."""
    keep = lambda label, build: stored(t, f"graph_{label}", lambda _: build())
    if not all(is_stored(t, f"graph_{label}") for label in [*NODE_KEYS, *EDGE_ENDS]):
        return built_graph(t, store=keep)
    return PropertyGraph([Node(label, keep(label, None), k) for label, k in NODE_KEYS.items()],
                         [Edge(label, keep(label, None), "edge_id", *ends) for label, ends in EDGE_ENDS.items()])


part("node_customer", """
SELECT c.cif_id::varchar AS cif_id, cif_nm AS customer_name, state, region, occupation, age,
  net_income::decimal(18,2) AS net_income, coalesce(recv_promo, 'N') AS marketing_consent,
  coalesce(p.tier, 'Non-Cardholder') AS wallet_tier, coalesce(p.akpk, 'N') AS akpk_status,
  coalesce(p.active, 0) AS active_card_count, coalesce(p.lim, 0)::decimal(18,2) AS total_cp_limit,
  coalesce(p.used, 0)::decimal(18,2) AS total_cp_usage, coalesce(o.u, 0)::decimal(18,2) AS combined_unpaid,
  coalesce(o.g, 'A') AS worst_collection_grade,
  coalesce(o.u, 0) > 0 OR coalesce(p.akpk, 'N') = 'Y' AS is_delinquent
FROM newest_customer c
LEFT JOIN (SELECT cif_id, count(*) FILTER (card_status = 'Active') AS active, max(tier) AS tier, max(akpk) AS akpk,
    sum(cp_cl::decimal(18,2)) AS lim, sum(cp_usage::decimal(18,2)) AS used FROM f_card GROUP BY 1) p
  ON p.cif_id = c.cif_id
LEFT JOIN (SELECT cif_id, sum(unpaid) AS u, max(grade) AS g FROM risk_rows GROUP BY 1) o
  ON o.cif_id = c.cif_id::varchar""")
part("node_facility", """
SELECT 'LOAN_' || appl_no::varchar AS facility_id, cif_no::varchar AS cif_id, 'LOAN' AS product_line,
  trim(status) AS application_status, rank AS score_rank, score::double AS credit_score,
  fin_amt::decimal(18,2) AS exposure_amount, new_dsr::decimal(18,2) AS new_dsr FROM f_loan_app
UNION ALL
SELECT 'CARD_' || appl_id::varchar, cif_id::varchar, 'CARD', trim(status), rank, final_score::double,
  cr_limit::decimal(18,2), new_dsr::decimal(18,2) FROM f_card_app""")
part("node_merchant", """
SELECT merchant_id, merchant_id AS merchant_name, coalesce(max(merchant_group), 'General Retail') AS merchant_group,
  sum(amount) AS total_sales_volume, sum(coalesce(trans_count, 1))::bigint AS total_tx_count,
  count(DISTINCT cif_id) AS distinct_customers FROM silver_sales_all WHERE merchant_id <> '' GROUP BY 1""")
_SEG = "coalesce(nullif(trim(nob), ''), 'GENERAL_SECTOR')"
part("node_segment", f"""
SELECT {_SEG} || '|' || state AS segment_id, {_SEG} AS sector, state, count(DISTINCT cif_id) AS customer_count,
  round(avg(net_income::decimal(18,2))::decimal(22,6), 2) AS avg_net_income FROM f_customer GROUP BY 1, 2, 3""")
part("edge_holds", """
SELECT f.cif_id || '->' || facility_id AS edge_id, f.cif_id, facility_id, product_line, exposure_amount, new_dsr,
  application_status FROM node_facility f JOIN node_customer c ON c.cif_id = f.cif_id""")
part("edge_transacted", """
SELECT s.cif_id || '->' || s.merchant_id AS edge_id, s.* FROM (
  SELECT cif_id, merchant_id, max(product_line) AS product_line, max(sales_type) AS sales_type,
    sum(amount) AS total_spend, sum(coalesce(trans_count, 1))::bigint AS tx_count
  FROM silver_sales_all WHERE merchant_id <> '' AND cif_id IS NOT NULL GROUP BY 1, 2) s
JOIN node_customer c ON c.cif_id = s.cif_id JOIN node_merchant m ON m.merchant_id = s.merchant_id""")
part("edge_works", f"""
SELECT cif_id::varchar || '->' || {_SEG} || '|' || state AS edge_id, cif_id::varchar AS cif_id,
  {_SEG} || '|' || state AS segment_id, yr_job AS years_in_job, net_income::decimal(18,2) AS net_income
FROM newest_customer""")
part("two_hop", """
SELECT c.cif_id, c.state, c.is_delinquent, h.facility_id, h.product_line, h.exposure_amount, h.new_dsr,
  t.total_spend, m.merchant_id, m.merchant_group
FROM edge_holds h JOIN node_customer c ON c.cif_id = h.cif_id JOIN edge_transacted t ON t.cif_id = c.cif_id
JOIN node_merchant m ON m.merchant_id = t.merchant_id""")
part("pair_rows", """
SELECT c1.cif_id AS cif_1, c2.cif_id AS cif_2, m.merchant_name, m.merchant_group, w1.segment_id,
  c1.combined_unpaid + c2.combined_unpaid AS pair_unpaid, t1.total_spend + t2.total_spend AS pair_spend
FROM edge_transacted t1 JOIN edge_transacted t2 ON t1.merchant_id = t2.merchant_id AND t1.cif_id < t2.cif_id
JOIN edge_works w1 ON w1.cif_id = t1.cif_id JOIN edge_works w2 ON w2.cif_id = t2.cif_id AND w1.segment_id = w2.segment_id
JOIN node_customer c1 ON c1.cif_id = t1.cif_id AND c1.is_delinquent
JOIN node_customer c2 ON c2.cif_id = t2.cif_id AND c2.is_delinquent
JOIN node_merchant m ON m.merchant_id = t1.merchant_id""")
part("cross_paths", """
SELECT c.cif_id, c.customer_name, c.state, c.occupation, c.net_income, f.facility_id, f.exposure_amount, f.new_dsr,
  f.credit_score, m.merchant_id, m.merchant_name, m.merchant_group, t.total_spend
FROM node_customer c JOIN node_facility f ON f.cif_id = c.cif_id JOIN edge_transacted t ON t.cif_id = c.cif_id
JOIN node_merchant m ON m.merchant_id = t.merchant_id
WHERE f.product_line = 'LOAN' AND c.active_card_count = 0 AND NOT c.is_delinquent AND c.marketing_consent = 'Y'
  AND c.net_income >= 4000""")


@query("gr_01_customer_node", f"""
SELECT * REPLACE ({doubles('net_income', 'total_cp_limit', 'total_cp_usage', 'combined_unpaid')}) FROM node_customer""")
def gr_01(t):
    return built_graph(t).node("Customer")


@query("gr_02_facility_node", f"SELECT * REPLACE ({doubles('exposure_amount', 'new_dsr')}) FROM node_facility")
def gr_02(t):
    return built_graph(t).node("CreditFacility")


@query("gr_03_merchant_node", f"SELECT * REPLACE ({doubles('total_sales_volume')}) FROM node_merchant")
def gr_03(t):
    return built_graph(t).node("Merchant")


@query("gr_04_segment_node", f"SELECT * REPLACE ({doubles('avg_net_income')}) FROM node_segment")
def gr_04(t):
    return built_graph(t).node("EmployerSegment")


@query("gr_05_holds_edge", f"SELECT * REPLACE ({doubles('exposure_amount', 'new_dsr')}) FROM edge_holds")
def gr_05(t):
    return built_graph(t).edge("HOLDS_FACILITY")


@query("gr_06_transacted_edge", f"SELECT * REPLACE ({doubles('total_spend')}) FROM edge_transacted")
def gr_06(t):
    return built_graph(t).edge("TRANSACTED_AT")


@query("gr_07_works_edge", f"SELECT * REPLACE ({doubles('net_income')}) FROM edge_works")
def gr_07(t):
    return built_graph(t).edge("WORKS_IN_SEGMENT")


_TABLES = {"Customer": ("node_customer", "cif_id"), "CreditFacility": ("node_facility", "facility_id"),
           "Merchant": ("node_merchant", "merchant_id"), "EmployerSegment": ("node_segment", "segment_id"),
           "HOLDS_FACILITY": ("edge_holds", "edge_id"), "TRANSACTED_AT": ("edge_transacted", "edge_id"),
           "WORKS_IN_SEGMENT": ("edge_works", "edge_id")}


def _validation_sql():
    out = [f"""SELECT '{label}' AS label, 'unique({k})' AS "check", count(*) - count(DISTINCT {k}) AS violations FROM {table}"""
           for label, (table, k) in _TABLES.items()]
    for label, ends in EDGE_ENDS.items():
        for node, column in ends:
            out.append(f"""SELECT '{label}', 'references({node}.{column})', count(*) FROM {_TABLES[label][0]} e
  WHERE NOT EXISTS (SELECT 1 FROM {_TABLES[node][0]} n WHERE n.{column} = e.{column})""")
    return " UNION ALL ".join(out)


@query("gr_08_graph_validation", _validation_sql())
def gr_08(t):
    return graph(t).validate()


@query("gr_09_cardinality", """
SELECT 'NODE' AS element, 'Customer' AS label, count(*) AS row_count FROM node_customer
UNION ALL SELECT 'NODE', 'CreditFacility', count(*) FROM node_facility
UNION ALL SELECT 'NODE', 'Merchant', count(*) FROM node_merchant
UNION ALL SELECT 'NODE', 'EmployerSegment', count(*) FROM node_segment
UNION ALL SELECT 'EDGE', 'HOLDS_FACILITY', count(*) FROM edge_holds
UNION ALL SELECT 'EDGE', 'TRANSACTED_AT', count(*) FROM edge_transacted
UNION ALL SELECT 'EDGE', 'WORKS_IN_SEGMENT', count(*) FROM edge_works""")
def gr_09(t):
    return graph(t).cardinality()


@query("gr_10_portfolio_paths", """
SELECT '[{"label":"CreditFacility","facility_id":"' || facility_id || '","product_line":"' || product_line
  || '"},{"label":"HOLDS_FACILITY","cif_id":"' || cif_id || '","facility_id":"' || facility_id
  || '"},{"label":"Customer","cif_id":"' || cif_id || '","state":"' || state
  || '"},{"label":"TRANSACTED_AT","cif_id":"' || cif_id || '","merchant_id":"' || merchant_id || '","total_spend":'
  || total_spend::decimal(28,2)::varchar || '},{"label":"Merchant","merchant_id":"' || merchant_id || '"}]' AS path
FROM two_hop WHERE NOT is_delinquent AND total_spend >= 1500 ORDER BY cif_id, merchant_id, facility_id LIMIT 40""")
def gr_10(t):
    return q.portfolio_paths(graph(t))


@query("gr_11_portfolio_by_state", """
SELECT state, product_line, merchant_group, count(DISTINCT cif_id) AS active_customers,
  count(DISTINCT facility_id) AS facilities_held, round(avg(new_dsr)::decimal(22,6), 2)::double AS avg_dsr_pct,
  sum(exposure_amount)::double AS total_exposure, sum(total_spend)::double AS total_spend,
  count(*) FILTER (is_delinquent) AS delinquent_paths
FROM two_hop GROUP BY 1, 2, 3 ORDER BY sum(total_spend) DESC, 1, 2, 3 LIMIT 15""")
def gr_11(t):
    return top_k(q.portfolio_by_state(graph(t)), [F.col("total_spend").desc(), "state", "product_line",
                                                  "merchant_group"], 15)


@query("gr_11b_portfolio_by_state_all", """
SELECT state, product_line, merchant_group, count(DISTINCT cif_id) AS active_customers,
  count(DISTINCT facility_id) AS facilities_held, round(avg(new_dsr)::decimal(22,6), 2)::double AS avg_dsr_pct,
  sum(exposure_amount)::double AS total_exposure, sum(total_spend)::double AS total_spend,
  count(*) FILTER (is_delinquent) AS delinquent_paths FROM two_hop GROUP BY 1, 2, 3""")
def gr_11b(t):
    return q.portfolio_by_state(graph(t))


@query("gr_12_ring_pairs", f"""
SELECT * REPLACE ({doubles('pair_unpaid', 'pair_spend')}) FROM pair_rows
ORDER BY merchant_name, merchant_group, segment_id, cif_1, cif_2 LIMIT 30""")
def gr_12(t):
    return q.ring_pairs(graph(t))


@query("gr_12b_ring_members", """
SELECT c.cif_id, c.combined_unpaid::double AS combined_unpaid, w.segment_id, m.merchant_name, m.merchant_group,
  t.total_spend::double AS total_spend
FROM node_customer c JOIN edge_works w ON w.cif_id = c.cif_id JOIN edge_transacted t ON t.cif_id = c.cif_id
JOIN node_merchant m ON m.merchant_id = t.merchant_id WHERE c.is_delinquent""")
def gr_12b(t):
    return q.ring_members(graph(t))


_RING = """
SELECT merchant_name, merchant_group, segment_id, count(*) AS connected_pairs,
  count(DISTINCT cif_1) + count(DISTINCT cif_2) AS distinct_ring_members,
  len(list_distinct(list_concat(list(cif_1), list(cif_2))))::bigint AS true_members,
  round(avg(pair_unpaid)::decimal(22,6), 2)::double AS avg_pair_unpaid, sum(pair_spend)::double AS total_ring_spend
FROM pair_rows GROUP BY 1, 2, 3"""


@query("gr_13_top_rings", f"""
SELECT * FROM ({_RING}) ORDER BY connected_pairs DESC, avg_pair_unpaid DESC, merchant_name, merchant_group, segment_id
LIMIT 15""")
def gr_13(t):
    return q.top_rings(graph(t))


@query("gr_13b_all_rings", _RING)
def gr_13b(t):
    return q.ring_ranking(graph(t))


_CONTAGION = """
SELECT m.merchant_name, m.merchant_group, count(DISTINCT c.cif_id) AS delinquent_customers,
  sum(t.total_spend)::double AS delinquent_spend, sum(c.combined_unpaid)::double AS linked_unpaid
FROM node_customer c JOIN edge_transacted t ON t.cif_id = c.cif_id JOIN node_merchant m ON m.merchant_id = t.merchant_id
WHERE c.is_delinquent GROUP BY 1, 2"""


@query("gr_14_merchant_contagion", _CONTAGION + " ORDER BY sum(c.combined_unpaid) DESC, 1 LIMIT 15")
def gr_14(t):
    return top_k(q.merchant_contagion(graph(t)), [F.col("linked_unpaid").desc(), F.col("merchant_name").asc()], 15)


@query("gr_15_exposure_by_status", """
SELECT f.product_line, f.application_status, count(DISTINCT f.facility_id) AS facility_count,
  count(DISTINCT c.cif_id) AS distinct_customers, round(avg(f.credit_score)::decimal(22,6), 1)::double AS avg_credit_score,
  round(avg(f.new_dsr)::decimal(22,6), 2)::double AS avg_dsr_pct, sum(f.exposure_amount)::double AS total_exposure
FROM node_customer c JOIN edge_holds h ON h.cif_id = c.cif_id JOIN node_facility f ON f.facility_id = h.facility_id
GROUP BY 1, 2""")
def gr_15(t):
    return q.exposure_by_status(graph(t))


@query("gr_16_segment_clusters", """
SELECT e.segment_id, e.sector, e.state, count(DISTINCT c.cif_id) AS total_customers,
  count(*) FILTER (c.is_delinquent) AS delinquent_customers,
  count(*) FILTER (c.akpk_status = 'Y') AS restructured_customers,
  round(avg(w.years_in_job)::decimal(22,6), 1)::double AS avg_years_in_job,
  sum(c.combined_unpaid)::double AS segment_unpaid
FROM node_customer c JOIN edge_works w ON w.cif_id = c.cif_id JOIN node_segment e ON e.segment_id = w.segment_id
GROUP BY 1, 2, 3 HAVING count(*) FILTER (c.is_delinquent) > 0
ORDER BY sum(c.combined_unpaid) DESC, 1 LIMIT 15""")
def gr_16(t):
    return top_k(q.segment_clusters(graph(t)), [F.col("segment_unpaid").desc(), F.col("segment_id").asc()], 15)


@query("gr_17_cross_sell_candidates", """
SELECT p.cif_id, state, occupation, net_income::double AS net_income, count(DISTINCT facility_id) AS loan_facilities,
  max(credit_score) AS best_credit_score, count(DISTINCT merchant_id) AS merchants_visited,
  (SELECT sum(total_spend) FROM edge_transacted e WHERE e.cif_id = p.cif_id)::double AS true_merchant_spend,
  sum(total_spend)::double AS total_merchant_spend
FROM cross_paths p GROUP BY 1, 2, 3, net_income ORDER BY sum(total_spend) DESC, p.net_income DESC, 1 LIMIT 15""")
def gr_17(t):
    return top_k(q.cross_sell_candidates(graph(t)), [F.col("total_merchant_spend").desc(),
                                                     F.col("net_income").desc(), F.col("cif_id").asc()], 15)


@query("gr_18_cross_sell_paths", """
SELECT cif_id, customer_name, state, occupation, net_income::double AS net_income, facility_id,
  exposure_amount::double AS loan_exposure, new_dsr::double AS loan_dsr, merchant_name, merchant_group,
  total_spend::double AS merchant_spend
FROM cross_paths WHERE new_dsr <= 50
ORDER BY total_spend DESC, cross_paths.net_income DESC, cif_id, merchant_id, facility_id LIMIT 20""")
def gr_18(t):
    return q.cross_sell_paths(graph(t))


@query("gr_18b_cross_sell_path_json", """
SELECT '[{"label":"CreditFacility","facility_id":"' || facility_id || '","loan_exposure":'
  || exposure_amount::decimal(28,9)::varchar || ',"loan_dsr":' || new_dsr::decimal(28,9)::varchar
  || '},{"label":"Customer","cif_id":"' || cif_id || '","state":"' || state
  || '"},{"label":"TRANSACTED_AT","merchant_spend":' || total_spend::decimal(28,2)::varchar
  || '},{"label":"Merchant","merchant_name":"' || merchant_name || '","merchant_group":"' || merchant_group || '"}]' AS path
FROM cross_paths WHERE new_dsr <= 50
ORDER BY total_spend DESC, cross_paths.net_income DESC, cif_id, merchant_id, facility_id LIMIT 40""")
def gr_18b(t):
    return q.cross_sell_path_json(graph(t))


@query("gr_19_pattern", """
SELECT c.cif_id, c.state, h.facility_id, f.credit_score, h.exposure_amount::double AS exposure_amount
FROM node_customer c JOIN edge_holds h ON h.cif_id = c.cif_id JOIN node_facility f ON f.facility_id = h.facility_id
WHERE NOT c.is_delinquent AND f.credit_score >= 600""")
def gr_19(t):
    return graph(t).match(
        {"c": "Customer", "f": "CreditFacility"}, [Hop("c", "h", "HOLDS_FACILITY", "f")],
        {"cif_id": ("c", "cif_id"), "state": ("c", "state"), "facility_id": ("f", "facility_id"),
         "credit_score": ("f", "credit_score"), "exposure_amount": ("h", "exposure_amount")},
        where={"c": "not is_delinquent", "f": "credit_score >= 600"})


@query("dq_16_same_answer", "SELECT 0::bigint AS only_left, 0::bigint AS only_right, true AS equal "
                            "FROM customer LIMIT 1")
def dq_16(t):
    from ..operators.quality import same_answer
    g = graph(t)
    return same_answer(q.merchant_contagion(g), q.merchant_contagion_paths(g))


# Whole results of the questions above, asked as patterns whose paths are never written.

@query("gr_11d_portfolio_by_messages", """
SELECT state, product_line, merchant_group, count(DISTINCT cif_id) AS active_customers,
  count(DISTINCT facility_id) AS facilities_held, round(avg(new_dsr)::decimal(22,6), 2)::double AS avg_dsr_pct,
  sum(exposure_amount)::double AS total_exposure, sum(total_spend)::double AS total_spend,
  count(*) FILTER (is_delinquent) AS delinquent_paths FROM two_hop GROUP BY 1, 2, 3""")
def gr_11d(t):
    return q.portfolio_by_messages(graph(t))


@query("gr_14b_contagion_by_messages", _CONTAGION)
def gr_14b(t):
    return q.contagion_by_messages(graph(t))


_CROSS = """
SELECT p.cif_id, state, occupation, net_income::double AS net_income, count(DISTINCT facility_id) AS loan_facilities,
  max(credit_score) AS best_credit_score, count(DISTINCT merchant_id) AS merchants_visited,
  (SELECT sum(total_spend) FROM edge_transacted e WHERE e.cif_id = p.cif_id)::double AS true_merchant_spend,
  sum(total_spend)::double AS total_merchant_spend
FROM cross_paths p GROUP BY 1, 2, 3, net_income"""


@query("gr_17b_cross_sell_by_messages", _CROSS)
def gr_17b(t):
    return q.cross_sell_by_messages(graph(t))


@query("gr_17c_all_cross_sell_candidates", _CROSS)
def gr_17c(t):
    return q.cross_sell_candidates(graph(t))


@query("gr_20_exposure_beside_delinquents", """
SELECT f.product_line, e.sector, count(*) AS paths, count(DISTINCT m.merchant_id) AS merchants, count(DISTINCT d.cif_id) AS delinquents,
  sum(h.exposure_amount)::double AS exposure, round((sum(d.combined_unpaid) / count(*))::decimal(22,6), 2)::double AS mean_unpaid,
  min(t.total_spend)::double AS least_spend, max(f.credit_score) AS highest_score
FROM edge_holds h JOIN node_facility f ON f.facility_id = h.facility_id JOIN node_customer c ON c.cif_id = h.cif_id
JOIN edge_transacted t ON t.cif_id = c.cif_id JOIN node_merchant m ON m.merchant_id = t.merchant_id
JOIN edge_transacted u ON u.merchant_id = m.merchant_id JOIN node_customer d ON d.cif_id = u.cif_id
JOIN edge_works w ON w.cif_id = d.cif_id JOIN node_segment e ON e.segment_id = w.segment_id
WHERE NOT c.is_delinquent AND d.is_delinquent GROUP BY 1, 2""")
def gr_20(t):
    return q.exposure_beside_delinquents(graph(t)).withColumn("mean_unpaid", F.round("mean_unpaid", 2))


@query("gr_11c_portfolio_of_small_amounts", """
SELECT state, product_line, merchant_group, round(sum(exposure_amount * 1.003457), 2)::double AS total_exposure,
  round((sum(new_dsr * 0.013579) / count(new_dsr))::decimal(22,8), 2)::double AS avg_dsr_pct FROM two_hop GROUP BY 1, 2, 3""")
def gr_11c(t):
    """Amounts below a cent count: they are rounded once, after they have been summed over all paths."""
    g = graph(t)
    held = g.edge("HOLDS_FACILITY").withColumns({
        "exposure_amount": (F.col("exposure_amount").cast("decimal(18,2)") * F.lit("1.003457").cast("decimal(7,6)")).cast("decimal(28,9)"),
        "new_dsr": (F.col("new_dsr").cast("decimal(18,2)") * F.lit("0.013579").cast("decimal(7,6)")).cast("decimal(28,9)")})
    small = PropertyGraph(list(g.nodes.values()), [Edge(e.label, held if e.label == "HOLDS_FACILITY" else e.df, e.key, e.source, e.target) for e in g.edges.values()])
    return q.portfolio_by_state(small).select("state", "product_line", "merchant_group", "total_exposure", "avg_dsr_pct")
