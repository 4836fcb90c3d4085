"""Questions asked of the credit graph.

A two-hop pattern facility <- customer -> merchant has facilities times merchants paths per customer.
Sums over those paths are computed from per-customer sums of each arm, and the first paths of an order
from the first edges of that order; the paths themselves are never all built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.graph import Hop, PropertyGraph, path_json
from ..operators.rings import first_pairs
from ..operators.topk import top_k

GROUP = ["merchant_name", "merchant_group", "segment_id"]


def portfolio_by_state(g: PropertyGraph) -> DataFrame:
    """Path aggregates by state, product and merchant group: exposure counts once per merchant and
    spend once per facility, and the delinquent count is one of paths. Spending edges are dealt out by customer before they are
    summed by customer and group, so that the sums need not move again to meet the customers."""
    fac = g.edge("HOLDS_FACILITY").groupBy("cif_id", "product_line").agg(
        F.count(F.lit(1)).alias("nf"), F.sum("exposure_amount").alias("exposure"),
        F.sum("new_dsr").alias("dsr"), F.count("new_dsr").alias("n_dsr"))
    group = g.node("Merchant").select("merchant_id", "merchant_group")
    spend = g.edge("TRANSACTED_AT").select("cif_id", "merchant_id", "total_spend").join(group, "merchant_id").drop("merchant_id").repartition("cif_id").groupBy(
        "cif_id", "merchant_group").agg(F.count(F.lit(1)).alias("nm"), F.sum("total_spend").alias("spend"))
    cust = g.node("Customer").select("cif_id", "state", "is_delinquent")
    nm, nf = F.col("nm"), F.col("nf")
    # sums of all decimals times paths; rounded once, at the end
    weight = lambda c, n: F.col(c).cast("decimal(27,9)") * n.cast("decimal(10,0)")
    return cust.join(fac, "cif_id").join(spend, "cif_id").groupBy("state", "product_line", "merchant_group").agg(
        F.count(F.lit(1)).alias("active_customers"), F.sum("nf").alias("facilities_held"),
        F.round(F.sum(weight("dsr", nm)) / F.sum(F.col("n_dsr") * nm), 2).alias("avg_dsr_pct"),
        F.round(F.sum(weight("exposure", nm)), 2).alias("total_exposure"), F.round(F.sum(weight("spend", nf)), 2).alias("total_spend"),
        F.sum(F.when(F.col("is_delinquent"), nf * nm).otherwise(0)).alias("delinquent_paths"))


def portfolio_by_messages(g: PropertyGraph) -> DataFrame:
    """The same, asked as a pattern whose paths are counted and summed without being written."""
    out = g.match_aggregate(
        {"c": "Customer", "f": "CreditFacility", "m": "Merchant"},
        [Hop("c", "h", "HOLDS_FACILITY", "f"), Hop("c", "t", "TRANSACTED_AT", "m")],
        {"state": ("c", "state"), "product_line": ("h", "product_line"), "merchant_group": ("m", "merchant_group")},
        {"active_customers": ("distinct", "c"), "facilities_held": ("distinct", "f"), "avg_dsr_pct": ("avg", "h", "new_dsr"),
         "total_exposure": ("sum", "h", "exposure_amount"), "total_spend": ("sum", "t", "total_spend"),
         "delinquent_paths": ("sum", "c", "if(is_delinquent, 1L, 0L)")})
    return out.withColumns({c: F.round(c, 2) for c in ("avg_dsr_pct", "total_exposure", "total_spend")})


def contagion_by_messages(g: PropertyGraph) -> DataFrame:
    """``merchant_contagion`` as an aggregated pattern."""
    return g.match_aggregate(
        {"m": "Merchant", "c": "Customer"}, [Hop("c", "t", "TRANSACTED_AT", "m")],
        {"merchant_name": ("m", "merchant_name"), "merchant_group": ("m", "merchant_group")},
        {"delinquent_customers": ("distinct", "c"), "delinquent_spend": ("sum", "t", "total_spend"),
         "linked_unpaid": ("sum", "c", "combined_unpaid")}, {"c": "is_delinquent"})


def cross_sell_by_messages(g: PropertyGraph) -> DataFrame:
    """``cross_sell_candidates`` as aggregated patterns: all measures but the spend without repeats come from one of three nodes; that
    one from the pattern without facilities."""
    eligible = "active_card_count = 0 and not is_delinquent and marketing_consent = 'Y' and net_income >= 4000"
    by = {c: ("c", c) for c in ("cif_id", "state", "occupation", "net_income")}
    loan, spent = Hop("c", "h", "HOLDS_FACILITY", "f"), Hop("c", "t", "TRANSACTED_AT", "m")
    nodes = {"c": "Customer", "f": "CreditFacility", "m": "Merchant"}
    paths = g.match_aggregate(nodes, [loan, spent], by, {
        "loan_facilities": ("distinct", "f"), "best_credit_score": ("max", "f", "credit_score"), "merchants_visited": ("distinct", "m"),
        "total_merchant_spend": ("sum", "t", "total_spend")}, {"c": eligible, "f": "product_line = 'LOAN'"})
    once = g.match_aggregate({"c": "Customer", "m": "Merchant"}, [spent], {"cif_id": ("c", "cif_id")},
                             {"true_merchant_spend": ("sum", "t", "total_spend")}, {"c": eligible})
    return paths.join(once, "cif_id")


def exposure_beside_delinquents(g: PropertyGraph) -> DataFrame:
    """Four hops: facilities of performing customers, by product, that share a merchant with delinquent customers of a sector."""
    return g.match_aggregate(
        {"m": "Merchant", "f": "CreditFacility", "c": "Customer", "d": "Customer", "e": "EmployerSegment"},
        [Hop("c", "h", "HOLDS_FACILITY", "f"), Hop("c", "t", "TRANSACTED_AT", "m"), Hop("d", "u", "TRANSACTED_AT", "m"), Hop("d", "w", "WORKS_IN_SEGMENT", "e")],
        {"product_line": ("f", "product_line"), "sector": ("e", "sector")},
        {"paths": ("count", "f"), "merchants": ("distinct", "m"), "delinquents": ("distinct", "d"), "exposure": ("sum", "h", "exposure_amount"),
         "mean_unpaid": ("avg", "d", "combined_unpaid"), "least_spend": ("min", "t", "total_spend"), "highest_score": ("max", "f", "credit_score")},
        {"c": "not is_delinquent", "d": "is_delinquent"})


def ring_members(g: PropertyGraph) -> DataFrame:
    """Delinquent customers with their merchants and their one segment: the members of every ring."""
    return g.match(
        {"c": "Customer", "m": "Merchant", "e": "EmployerSegment"},
        [Hop("c", "w", "WORKS_IN_SEGMENT", "e"), Hop("c", "t", "TRANSACTED_AT", "m")],
        {"cif_id": ("c", "cif_id"), "combined_unpaid": ("c", "combined_unpaid"), "segment_id": ("e", "segment_id"),
         "merchant_name": ("m", "merchant_name"), "merchant_group": ("m", "merchant_group"),
         "total_spend": ("t", "total_spend")}, where={"c": "is_delinquent"})


def ring_pairs(g: PropertyGraph, k: int = 30) -> DataFrame:
    """The first ``k`` delinquent pairs that share a merchant and a segment, in the order
    (merchant, segment, left, right)."""
    pairs = first_pairs(ring_members(g), GROUP, "cif_id", ["combined_unpaid", "total_spend"], k)
    return pairs.select(
        F.col("cif_id_1").alias("cif_1"), F.col("cif_id_2").alias("cif_2"), *GROUP,
        (F.col("combined_unpaid_1") + F.col("combined_unpaid_2")).alias("pair_unpaid"),
        (F.col("total_spend_1") + F.col("total_spend_2")).alias("pair_spend"))


def ring_ranking(g: PropertyGraph) -> DataFrame:
    """Rings by connected pairs, from the members alone.

    ``distinct_ring_members`` adds distinct left and right ends, so middle members count twice;
    ``true_members`` counts each once.
    """
    n = F.col("true_members")
    return (ring_members(g).groupBy(*GROUP)
            .agg(F.count(F.lit(1)).alias("true_members"), F.sum("combined_unpaid").alias("u"),
                 F.sum("total_spend").alias("s")).where(n > 1)
            .select(*GROUP, F.expr("(true_members * (true_members - 1)) div 2").alias("connected_pairs"),
                    (2 * (n - 1)).alias("distinct_ring_members"), "true_members",
                    F.round(F.col("u").cast("decimal(24,2)") * 2 / n, 2).alias("avg_pair_unpaid"),
                    (F.col("s").cast("decimal(24,2)") * (n - 1).cast("decimal(13,0)")).alias("total_ring_spend")))


def top_rings(g: PropertyGraph, k: int = 15) -> DataFrame:
    return top_k(ring_ranking(g), [F.col("connected_pairs").desc(), F.col("avg_pair_unpaid").desc(),
                                   *[F.col(c).asc() for c in GROUP]], k)


def merchant_contagion(g: PropertyGraph) -> DataFrame:
    """Merchants by their delinquent customers, as joins."""
    bad = g.node("Customer").where("is_delinquent").select("cif_id", "combined_unpaid")
    edges = g.edge("TRANSACTED_AT").select("cif_id", "merchant_id", "total_spend").join(bad, "cif_id")
    per = edges.groupBy("merchant_id").agg(
        F.count(F.lit(1)).alias("delinquent_customers"), F.sum("total_spend").alias("delinquent_spend"),
        F.sum("combined_unpaid").alias("linked_unpaid"))
    names = g.node("Merchant").select("merchant_id", "merchant_name", "merchant_group")
    return per.join(names, "merchant_id").select("merchant_name", "merchant_group", "delinquent_customers",
                                                 "delinquent_spend", "linked_unpaid")


def merchant_contagion_paths(g: PropertyGraph) -> DataFrame:
    """The same question as a pattern."""
    rows = g.match({"c": "Customer", "m": "Merchant"}, [Hop("c", "t", "TRANSACTED_AT", "m")],
                   {"cif_id": ("c", "cif_id"), "combined_unpaid": ("c", "combined_unpaid"),
                    "total_spend": ("t", "total_spend"), "merchant_name": ("m", "merchant_name"),
                    "merchant_group": ("m", "merchant_group")}, where={"c": "is_delinquent"})
    return rows.groupBy("merchant_name", "merchant_group").agg(
        F.count_distinct("cif_id").alias("delinquent_customers"), F.sum("total_spend").alias("delinquent_spend"),
        F.sum("combined_unpaid").alias("linked_unpaid"))


def exposure_by_status(g: PropertyGraph) -> DataFrame:
    """Facilities by product and status. A facility has one customer, so its own row is the path."""
    fac = g.node("CreditFacility").select("facility_id", "application_status", "product_line", "credit_score")
    held = g.edge("HOLDS_FACILITY").select("facility_id", "cif_id", "new_dsr", "exposure_amount")
    return held.join(fac, "facility_id").groupBy("product_line", "application_status").agg(
        F.count(F.lit(1)).alias("facility_count"), F.count_distinct("cif_id").alias("distinct_customers"),
        F.round(F.avg(F.col("credit_score").cast("decimal(18,2)")), 1).alias("avg_credit_score"),
        F.round(F.avg("new_dsr"), 2).alias("avg_dsr_pct"), F.sum("exposure_amount").alias("total_exposure"))


def segment_clusters(g: PropertyGraph) -> DataFrame:
    """Segments with delinquent customers; a customer has one segment, so rows count customers."""
    cust = g.node("Customer").select("cif_id", "is_delinquent", "akpk_status", "combined_unpaid")
    work = g.edge("WORKS_IN_SEGMENT").select("cif_id", "segment_id", "years_in_job")
    per = work.join(cust, "cif_id").groupBy("segment_id").agg(
        F.count(F.lit(1)).alias("total_customers"), F.count_if("is_delinquent").alias("delinquent_customers"),
        F.count_if(F.col("akpk_status") == "Y").alias("restructured_customers"),
        F.round(F.avg(F.col("years_in_job").cast("decimal(18,2)")), 1).alias("avg_years_in_job"),
        F.sum("combined_unpaid").alias("segment_unpaid")).where(F.col("delinquent_customers") > 0)
    return per.join(g.node("EmployerSegment").select("segment_id", "sector", "state"), "segment_id")


def _cross_sell_customers(g: PropertyGraph) -> DataFrame:
    return g.node("Customer").where(
        (F.col("active_card_count") == 0) & ~F.col("is_delinquent") & (F.col("marketing_consent") == "Y")
        & (F.col("net_income") >= 4000)).select("cif_id", "customer_name", "state", "occupation", "net_income")


def cross_sell_candidates(g: PropertyGraph) -> DataFrame:
    """Eligible loan customers with facility and merchant measures; spend repeats per facility
    (``total_merchant_spend``), ``true_merchant_spend`` has it once."""
    loans = g.node("CreditFacility").where(F.col("product_line") == "LOAN").groupBy("cif_id").agg(
        F.count(F.lit(1)).alias("loan_facilities"), F.max("credit_score").alias("best_credit_score"))
    spend = g.edge("TRANSACTED_AT").groupBy("cif_id").agg(
        F.count(F.lit(1)).alias("merchants_visited"), F.sum("total_spend").alias("true_merchant_spend"))
    joined = _cross_sell_customers(g).drop("customer_name").join(loans, "cif_id").join(spend, "cif_id")
    return joined.withColumn("total_merchant_spend", F.col("true_merchant_spend").cast("decimal(24,2)")
                             * F.col("loan_facilities").cast("decimal(13,0)"))


def _first_paths(customers: DataFrame, facilities: DataFrame, spend: DataFrame, edge_order: Sequence[Column],
                 k: int) -> DataFrame:
    """The first ``k`` paths ordered by (edge order, facility): every qualifying spend edge has at least
    one path, so the first ``k`` edges contain them."""
    able = customers.join(facilities.select("cif_id"), "cif_id", "left_semi")
    first = top_k(spend.join(able, "cif_id"), edge_order, k)
    return top_k(first.join(facilities, "cif_id"), [*edge_order, F.col("facility_id").asc()], k)


def portfolio_paths(g: PropertyGraph, min_spend: float = 1500, k: int = 40) -> DataFrame:
    """Facility <- customer -> merchant paths of performing customers as JSON."""
    cust = g.node("Customer").where(~F.col("is_delinquent")).select("cif_id", "state")
    fac = g.edge("HOLDS_FACILITY").select("cif_id", "facility_id", "product_line")
    spend = g.edge("TRANSACTED_AT").where(F.col("total_spend") >= min_spend).select("cif_id", "merchant_id", "total_spend")
    paths = _first_paths(cust, fac, spend, [F.col("cif_id").asc(), F.col("merchant_id").asc()], k)
    return paths.select(path_json(
        ("CreditFacility", ["facility_id", "product_line"]), ("HOLDS_FACILITY", ["cif_id", "facility_id"]),
        ("Customer", ["cif_id", "state"]), ("TRANSACTED_AT", ["cif_id", "merchant_id", "total_spend"]),
        ("Merchant", ["merchant_id"])).alias("path"))


def cross_sell_paths(g: PropertyGraph, max_dsr: float = 50, k: int = 20) -> DataFrame:
    """Ranked loan-to-card paths by spend and income."""
    fac = g.node("CreditFacility").where((F.col("product_line") == "LOAN") & (F.col("new_dsr") <= max_dsr)).select(
        "cif_id", "facility_id", F.col("exposure_amount").alias("loan_exposure"), F.col("new_dsr").alias("loan_dsr"))
    names = g.node("Merchant").select("merchant_id", "merchant_name", "merchant_group")
    spend = g.edge("TRANSACTED_AT").select("cif_id", "merchant_id", F.col("total_spend").alias("merchant_spend"))
    order = [F.col("merchant_spend").desc(), F.col("net_income").desc(), F.col("cif_id").asc(), F.col("merchant_id").asc()]
    paths = _first_paths(_cross_sell_customers(g), fac, spend, order, k)
    return paths.join(names, "merchant_id").drop("merchant_id")


def cross_sell_path_json(g: PropertyGraph, k: int = 40) -> DataFrame:
    return cross_sell_paths(g, k=k).select(path_json(
        ("CreditFacility", ["facility_id", "loan_exposure", "loan_dsr"]), ("Customer", ["cif_id", "state"]),
        ("TRANSACTED_AT", ["merchant_spend"]), ("Merchant", ["merchant_name", "merchant_group"])).alias("path"))
