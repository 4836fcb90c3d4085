"""The seven node and edge tables of the credit graph."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import sum_money
from ..functions.scalars import MONEY, key, money, text_or
from ..operators.graph import Edge, Node, PropertyGraph
from ..operators.grouping import sums_and_greatest
from ..operators.joins import keep_known, star
from ..operators.sets import tagged_union
from ..operators.windows import latest_per
from .silver import newest_by_text_key


NODE_KEYS = {"Customer": "cif_id", "CreditFacility": "facility_id", "Merchant": "merchant_id",
             "EmployerSegment": "segment_id"}
EDGE_ENDS = {
    "HOLDS_FACILITY": (("Customer", "cif_id"), ("CreditFacility", "facility_id")),
    "TRANSACTED_AT": (("Customer", "cif_id"), ("Merchant", "merchant_id")),
    "WORKS_IN_SEGMENT": (("Customer", "cif_id"), ("EmployerSegment", "segment_id")),
}


SALTS = 4  # tasks that the sales of one customer are dealt to


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast(MONEY).alias(c)


def customer_nodes(customers: DataFrame, cards: DataFrame, collections: DataFrame) -> DataFrame:
    """16 properties per customer. Deduplicated before the joins; collections are summed straight
    from the silver rows, since the risk mart's dimensions add nothing here."""
    card = cards.groupBy(key("cif_id").alias("cif_id")).agg(
        F.count_if(key("card_status") == "Active").alias("active_card_count"),
        F.max(key("tier")).alias("wallet_tier"), F.max(key("akpk")).alias("akpk"),
        sum_money("cp_cl").alias("total_cp_limit"), sum_money("cp_usage").alias("total_cp_usage"))
    col = collections.groupBy("cif_id").agg(sum_money("unpaid").alias("combined_unpaid"),
                                            F.max("grade").alias("grade"))
    base = newest_by_text_key(customers.where(F.col("cif_id").isNotNull())).select(
        "cif_id", key("cif_nm").alias("customer_name"),
        *[F.coalesce(key(c), F.lit("Unknown")).alias(c) for c in ("state", "region", "occupation")],
        F.col("age").cast("bigint").alias("age"), money("net_income").alias("net_income"),
        F.coalesce(key("recv_promo"), F.lit("N")).alias("marketing_consent"))
    akpk = F.coalesce(F.col("akpk"), F.lit("N"))
    unpaid = F.coalesce(F.col("combined_unpaid"), F.lit(0))
    return star(base, card, col, on="cif_id").select(
        *base.columns, F.coalesce(F.col("wallet_tier"), F.lit("Non-Cardholder")).alias("wallet_tier"),
        akpk.alias("akpk_status"), F.coalesce(F.col("active_card_count"), F.lit(0)).alias("active_card_count"),
        _zero("total_cp_limit"), _zero("total_cp_usage"), _zero("combined_unpaid"),
        F.coalesce(F.col("grade"), F.lit("A")).alias("worst_collection_grade"),
        ((unpaid > 0) | (akpk == "Y")).alias("is_delinquent"))


def facility_nodes(loan: DataFrame, card: DataFrame) -> DataFrame:
    """Applications of both products with prefixed ids, the highest exposure per id."""

    def side(df: DataFrame, prefix: str, app: str, cif: str, score: str, exposure: str) -> DataFrame:
        return df.where(F.col(app).isNotNull() & F.col(cif).isNotNull()).select(
            F.concat(F.lit(prefix), key(app)).alias("facility_id"), key(cif).alias("cif_id"),
            key("status").alias("application_status"), key("rank").alias("score_rank"),
            F.col(score).cast("double").alias("credit_score"), money(exposure).alias("exposure_amount"),
            money("new_dsr").alias("new_dsr"))

    rows = tagged_union({"LOAN": side(loan, "LOAN_", "appl_no", "cif_no", "score", "fin_amt"),
                         "CARD": side(card, "CARD_", "appl_id", "cif_id", "final_score", "cr_limit")},
                        "product_line")
    return latest_per(rows, ["facility_id"], "exposure_amount", ("cif_id", "credit_score", "new_dsr"))


def customer_merchant_spend(sales: DataFrame) -> DataFrame:
    """Sales summed to customer and merchant, which merchant nodes and spending edges are both made of. Sums keep all decimals.
    Rows are dealt out by customer and ``salt``, a hash of the merchant, so that ``with_known`` moves none of them again and the sales
    of one customer (or of none) fill SALTS tasks."""
    rows = sales.where(F.col("merchant_id").isNotNull() & (F.col("merchant_id") != "")).withColumn(
        "salt", F.pmod(F.xxhash64("merchant_id"), F.lit(SALTS)).cast("int"))
    return sums_and_greatest(rows, ["cif_id", "salt", "merchant_id"], ["product_line", "sales_type", "merchant_group"], {
        "spend": money("amount"), "tx_count": F.coalesce(F.col("trans_count").cast("bigint"), F.lit(1))}, ["cif_id", "salt"])


def customer_ids(customers: DataFrame) -> DataFrame:
    """The keys of the customer nodes, without their properties; may repeat."""
    return customers.where(F.col("cif_id").isNotNull()).select(key("cif_id").alias("cif_id"))


def with_known(spend: DataFrame, ids: DataFrame) -> DataFrame:
    """With a mark of the rows whose customer is among the nodes."""
    each = ids.distinct().select("cif_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(True).alias("known"))
    return spend.join(each, ["cif_id", "salt"], "left").withColumn("known", F.coalesce("known", F.lit(False)))


def merchant_nodes(spend: DataFrame) -> DataFrame:
    """Summed by merchant and group first: a maximum over text sorts its input, which so is a few rows per merchant."""
    groups = spend.groupBy("merchant_id", "merchant_group").agg(
        F.sum("spend").alias("spend"), F.sum("tx_count").alias("tx_count"), F.count("cif_id").alias("customers"))
    return groups.groupBy("merchant_id").agg(
        F.coalesce(F.max("merchant_group"), F.lit("General Retail")).alias("merchant_group"),
        F.round(F.sum("spend"), 2).alias("total_sales_volume"), F.sum("tx_count").alias("total_tx_count"),
        F.sum("customers").alias("distinct_customers")).withColumn("merchant_name", F.col("merchant_id"))


def _segment() -> list[Column]:
    sector, state = text_or("nob", "GENERAL_SECTOR"), text_or("state", "UNKNOWN_STATE")
    return [F.concat(sector, F.lit("|"), state).alias("segment_id"), sector.alias("sector"), state.alias("state")]


def segment_nodes(customers: DataFrame) -> DataFrame:
    """Sector and state segments over every customer row, stale ones included."""
    return customers.where(F.col("cif_id").isNotNull()).groupBy(*_segment()).agg(
        F.count_distinct("cif_id").alias("customer_count"),
        F.round(F.avg(money("net_income")), 2).alias("avg_net_income"))


def holds_edges(facilities: DataFrame, customers: DataFrame) -> DataFrame:
    return keep_known(facilities, customers, "cif_id", "cif_id").select(
        F.concat("cif_id", F.lit("->"), "facility_id").alias("edge_id"), "cif_id", "facility_id", "product_line",
        "exposure_amount", "new_dsr", "application_status")


def transacted_edges(spend: DataFrame) -> DataFrame:
    """The marked sums of known customers. Merchant nodes are the merchants of these same sums, so that end is always known."""
    rows = spend.where("known").select(
        "cif_id", "merchant_id", "product_line", "sales_type", F.round("spend", 2).alias("total_spend"), "tx_count")
    return rows.select(F.concat("cif_id", F.lit("->"), "merchant_id").alias("edge_id"), *rows.columns)


def works_edges(customers: DataFrame, nodes: DataFrame, segments: DataFrame) -> DataFrame:
    rows = newest_by_text_key(customers.where(F.col("cif_id").isNotNull())).select(
        "cif_id", _segment()[0],
        F.coalesce(F.col("yr_job").cast("bigint"), F.lit(0)).alias("years_in_job"),
        F.coalesce(money("net_income"), F.lit(0)).cast(MONEY).alias("net_income"))
    known = keep_known(keep_known(rows, nodes, "cif_id", "cif_id"), segments, "segment_id", "segment_id")
    return known.select(F.concat("cif_id", F.lit("->"), "segment_id").alias("edge_id"), *rows.columns)


def credit_graph(customers: DataFrame, cards: DataFrame, loan: DataFrame, card: DataFrame, sales: DataFrame,
                 collections: DataFrame,
                 store: Callable[[str, Callable[[], DataFrame]], DataFrame] | None = None) -> PropertyGraph:
    """All seven tables. ``store`` may write each table as it is built (and the spend that two of them are made of) and return the
    copy, so that edges are checked against stored nodes and nothing is computed twice. Without it, ends are checked against the keys
    of the nodes alone, so that an edge table does not compute their properties."""
    keep = store or (lambda label, build: build())
    sums, ids = customer_merchant_spend(sales), customer_ids(customers)
    nodes = {"Customer": keep("Customer", lambda: customer_nodes(customers, cards, collections))}
    cust = nodes["Customer"].select("cif_id") if store else ids
    spend = keep("customer_merchant_spend", lambda: with_known(sums, cust))
    nodes |= {"CreditFacility": keep("CreditFacility", lambda: facility_nodes(loan, card)),
              "Merchant": keep("Merchant", lambda: merchant_nodes(spend if store else sums)),
              "EmployerSegment": keep("EmployerSegment", lambda: segment_nodes(customers))}
    edges = {"HOLDS_FACILITY": keep("HOLDS_FACILITY", lambda: holds_edges(nodes["CreditFacility"], cust)),
             "TRANSACTED_AT": keep("TRANSACTED_AT", lambda: transacted_edges(spend)),
             "WORKS_IN_SEGMENT": keep("WORKS_IN_SEGMENT",
                                      lambda: works_edges(customers, cust, nodes["EmployerSegment"]))}
    return PropertyGraph([Node(label, nodes[label], k) for label, k in NODE_KEYS.items()],
                         [Edge(label, edges[label], "edge_id", *ends) for label, ends in EDGE_ENDS.items()])
