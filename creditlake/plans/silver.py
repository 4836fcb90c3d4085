"""Silver layer: typed, trimmed and deduplicated records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import MONEY, key, money, ymd_date
from ..operators.sets import tagged_union
from ..operators.windows import latest_per

CUSTOMER_TIES = ("net_income", "cif_nm", "state", "nob")


def newest_customers(bronze: DataFrame) -> DataFrame:
    """The newest bronze record per customer."""
    return latest_per(bronze, ["cif_id"], "rcd_dt", CUSTOMER_TIES)


def newest_by_text_key(bronze: DataFrame) -> DataFrame:
    """The same with the id as text: joins on the text key reuse the partitioning of the deduplication."""
    return newest_customers(bronze.withColumn("cif_id", key("cif_id")))


def customers(bronze: DataFrame) -> DataFrame:
    """One row per customer, consent defaulting to N."""
    return newest_by_text_key(bronze).select(
        "cif_id",
        F.col("rcd_dt").cast("date").alias("record_refresh_date"),
        *[key(c).alias(c) for c in ("cif_nm", "gender", "marital_sts", "citizen", "state", "region",
                                    "race", "occupation")],
        F.col("emp_sts").cast("bigint").alias("emp_sts"),
        F.col("age").cast("bigint").alias("age"),
        *[money(c).alias(c) for c in ("yr_stay", "yr_job", "net_income", "gross_income", "annual_income")],
        F.coalesce(key("recv_promo"), F.lit("N")).alias("recv_promo"),
    )


def loan_applications(bronze: DataFrame) -> DataFrame:
    """Row-preserving typed loan applications."""
    return bronze.select(
        key("appl_no").alias("appl_no"), key("agree_no").alias("agree_no"), key("cif_no").alias("cif_id"),
        ymd_date("appl_dt").alias("application_date"), key("status").alias("status"),
        money("score").alias("score"), key("rank").alias("rank"), key("decision").alias("decision"),
        key("loan_grp").alias("loan_grp"), money("fin_amt").alias("fin_amt"),
        money("inst_amt").alias("inst_amt"), money("interest").alias("interest"),
        F.col("total_inst").cast("bigint").alias("total_inst"),
        *[money(c).alias(c) for c in ("net_income", "ndi", "cur_dsr", "new_dsr", "total_osb")],
    )


def card_applications(bronze: DataFrame) -> DataFrame:
    """Row-preserving typed card applications."""
    return bronze.select(
        key("appl_id").alias("appl_id"), key("account_no").alias("account_no"), key("cif_id").alias("cif_id"),
        ymd_date("appl_dt").alias("application_date"),
        *[key(c).alias(c) for c in ("status", "card_type", "card_brand", "decision", "rank")],
        *[money(c).alias(c) for c in ("net_income", "ndi", "cur_dsr", "new_dsr", "cr_limit", "final_score")],
        key("final_score_desc").alias("final_score_desc"),
    )


def collections_summary(loan: DataFrame, card: DataFrame) -> DataFrame:
    """Unpaid amounts and worst grade per customer over both products.

    A full outer join of two aggregates, written as one aggregation over the union: one shuffle instead of
    three, and the result keeps its partitioning for the profile join. Rows without a customer id make one row.
    """

    def side(df: DataFrame) -> DataFrame:
        return df.select(key("cif_no").alias("cif_id"), money("unpaid").alias("unpaid"), key("grade").alias("grade"))

    rows = tagged_union({"loan": side(loan), "card": side(card)}, "product")
    of = lambda tag, c: F.when(F.col("product") == tag, F.col(c))
    total = lambda tag: F.coalesce(F.sum(of(tag, "unpaid")), F.lit(0).cast(MONEY))
    worst = lambda tag: F.coalesce(F.max(of(tag, "grade")), F.lit("A"))
    return rows.groupBy("cif_id").agg(
        total("loan").alias("total_loan_unpaid"), total("card").alias("total_card_unpaid"),
        (total("loan") + total("card")).alias("combined_unpaid"),
        F.greatest(worst("loan"), worst("card")).alias("worst_collection_grade"))


def sales(card: DataFrame, loan: DataFrame) -> DataFrame:
    """Both sales feeds with one key type, date type and count type."""

    def side(df: DataFrame) -> DataFrame:
        return df.select(
            key("cif_no").alias("cif_id"), ymd_date(F.col("tx_dt").cast("bigint")).alias("tx_date"),
            key("ldesc").alias("merchant_id"), key("grp").alias("merchant_group"),
            key("sales_type").alias("sales_type"), money("amount").alias("amount"),
            F.col("trans_count").cast("bigint").alias("trans_count"))

    return tagged_union({"CARD": side(card), "LOAN": side(loan)}, "product_line")


def collections(loan: DataFrame, card: DataFrame) -> DataFrame:
    """Both collection feeds in one layout; the restructuring code exists for loans only."""

    def side(df: DataFrame, account: str, status: str) -> DataFrame:
        return df.select(
            ymd_date("tx_dt").alias("reporting_date"), key(account).alias("facility_account_no"),
            key("cif_no").alias("cif_id"), key("branch").alias("branch_id"),
            F.col(status).cast("bigint").alias("delinquency_status"),
            F.col("score_value").cast("double").alias("score_value"), key("grade").alias("grade"),
            key("finplus").alias("finplus_tier"),
            *([key("sub_code").alias("sub_code")] if "sub_code" in df.columns else []),
            *[money(c).alias(c) for c in ("billing", "collection", "unpaid")])

    return tagged_union({"LOAN": side(loan, "agree_no", "del_sts"),
                         "CARD": side(card, "account_no", "dc_sts")}, "product_line")
