"""Gold marts over applications, collections, merchants, partners and outside data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.aggregates import avg_money, sum_money
from ..functions.scalars import bucket, fold, key, like_ladder, lookup, money, ratio, ymd_date
from ..operators.joins import at_latest, join_any_of, join_folded
from ..operators.lists import top_list
from ..operators.sets import tagged_union
from ..operators.windows import latest_per, top_per
from .silver import CUSTOMER_TIES


def underwriting_funnel(loan: DataFrame, card: DataFrame) -> DataFrame:
    """Applications of both products in one 13-column layout."""

    def side(df: DataFrame, app: str, cif: str, score: str, reason: str, exposure: str) -> DataFrame:
        return df.select(
            key(app).alias("application_id"), key(cif).alias("cif_id"),
            ymd_date("appl_dt").alias("application_date"), ymd_date("judge_dt").alias("decision_date"),
            key("channel").alias("application_channel"), key("status").alias("decision_status"),
            key("rank").alias("score_rank"), F.col(score).cast("double").alias("credit_score"),
            key(reason).alias("decline_reason_code"), F.col(exposure).cast("double").alias("exposure"),
            F.col("net_income").cast("double").alias("net_income"),
            F.col("new_dsr").cast("double").alias("new_dsr"))

    return tagged_union({
        "Loan": side(loan, "appl_no", "cif_no", "score", "reject_code", "fin_amt"),
        "Card": side(card, "appl_id", "cif_id", "final_score", "decline_id", "cr_limit"),
    }, "product_line")


def collections_risk(collections: DataFrame, customers: DataFrame, cards: DataFrame,
                     dedup_dims: bool = True) -> DataFrame:
    """Collection rows with customer and card attributes and the collected share of billing.

    ``dedup_dims=False`` is the variant that joins the dimensions as they are, without defaults.
    """
    cust, card = customers, cards
    if dedup_dims:
        cust = latest_per(cust, ["cif_id"], "rcd_dt", CUSTOMER_TIES)
        card = latest_per(card, ["account_no"], "expiry_dt", ("akpk", "cif_id"))
    cust = cust.select(key("cif_id").alias("cif_id"), *[key(c).alias(c) for c in
                                                        ("state", "region", "occupation")])
    card = card.select(key("account_no").alias("facility_account_no"), key("akpk").alias("akpk"))
    joined = collections.join(cust, "cif_id", "left").join(card, "facility_account_no", "left")

    def dim(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("Unknown")).alias(c) if dedup_dims else F.col(c)

    return joined.select(
        "product_line", "reporting_date", "facility_account_no", "cif_id", dim("state"), dim("region"),
        dim("occupation"), "branch_id", "delinquency_status", "score_value", "grade", "finplus_tier",
        F.coalesce(F.col("sub_code"), F.col("akpk"), F.lit("N")).alias("akpk_indicator"),
        "billing", "collection", "unpaid",
        ratio("collection", "billing").alias("collection_efficiency"))


def merchant_spend(card_sales: DataFrame) -> DataFrame:
    """Spend per merchant group and location, without customer columns."""
    return card_sales.groupBy(F.col("grp").alias("merchant_group"), F.col("ldesc").alias("location_name")).agg(
        F.count(F.lit(1)).alias("total_transactions"), sum_money("amount").alias("total_spending"))


def partner_members(customers: DataFrame, stores: Sequence[str], tiers: Sequence[str],
                    share: int = 7) -> DataFrame:
    """Partner loyalty members: a stable sample of ``share`` tenths of the customers, with store,
    tier, spend and visits from the digest of the id. The moduli are fixed values."""
    cif = F.col("cif_id").cast("string")
    pick = lambda names, n: lookup(bucket(cif, n).cast("string"),
                                   {str(i): s for i, s in enumerate(names[:-1])}, F.lit(names[-1]))
    return customers.where(bucket(cif, 10) < share).select(
        cif.alias("match_key"), F.concat(F.lit("MEMBER_"), cif).alias("member_id"),
        pick(stores, len(stores)).alias("preferred_store"), pick(tiers, len(tiers)).alias("loyalty_tier"),
        (bucket(F.concat(cif, F.lit("_retail")), 2400) + 180).cast("decimal(18,2)").alias("retail_spend"),
        (bucket(cif, 18) + 2).alias("monthly_visits"))


def joint_spend(customers: DataFrame, card_sales: DataFrame, partner: DataFrame) -> DataFrame:
    """One row per card transaction of a customer who is also a partner member.

    Partner spend repeats on every transaction, so sums of it count it once per transaction;
    ``joint_spend_per_customer`` has it once.
    """
    cust = customers.select(key("cif_id").alias("cif_id"), "state", "marital_sts",
                            money("gross_income").alias("monthly_income"))
    sales = card_sales.select(key("cif_no").alias("cif_id"), money("amount").alias("card_spend"))
    members = partner.select(key("match_key").alias("cif_id"), F.col("retail_spend").alias("partner_spend"),
                             "preferred_store", "loyalty_tier")
    return cust.join(members, "cif_id").join(sales, "cif_id")


def joint_totals(customers: DataFrame, card_sales: DataFrame, partner: DataFrame) -> DataFrame:
    """Sums of ``joint_spend`` per pair of customer row and member row: sales are summed per customer before the joins, so a
    customer with very many sales meets them as one row, and partner spend is weighted by their number."""
    spend = card_sales.groupBy(key("cif_no").alias("cif_id")).agg(
        sum_money("amount").alias("card_spend"), F.count(F.lit(1)).alias("__n"), F.count("amount").alias("transactions"))
    cust = customers.select(key("cif_id").alias("cif_id"), "state", "marital_sts")
    members = partner.select(key("match_key").alias("cif_id"), "retail_spend", "preferred_store", "loyalty_tier")
    return cust.join(members, "cif_id").join(spend, "cif_id").withColumn("partner_spend", F.col("retail_spend") * F.col("__n")).drop("__n", "retail_spend")


def joint_spend_per_customer(customers: DataFrame, card_sales: DataFrame, partner: DataFrame) -> DataFrame:
    """One row per shared customer: card spend summed before the join, partner spend once."""
    spend = card_sales.groupBy(key("cif_no").alias("cif_id")).agg(sum_money("amount").alias("card_spend"))
    members = partner.select(key("match_key").alias("cif_id"), F.col("retail_spend").alias("partner_spend"),
                             "preferred_store", "loyalty_tier").dropDuplicates(["cif_id"])
    cust = latest_per(customers, ["cif_id"], "rcd_dt", CUSTOMER_TIES).select(
        key("cif_id").alias("cif_id"), "state", "marital_sts", money("gross_income").alias("monthly_income"))
    return cust.join(members, "cif_id").join(spend, "cif_id")


# Region codes and the state they stand for.
STATES = {
    "MY-01": "Johor", "MY-02": "Kedah", "MY-03": "Kelantan", "MY-04": "Melaka",
    "MY-05": "Negeri Sembilan", "MY-06": "Pahang", "MY-07": "Pulau Pinang", "MY-08": "Perak",
    "MY-09": "Perlis", "MY-10": "Selangor", "MY-11": "Terengganu", "MY-12": "Sabah",
    "MY-13": "Sarawak", "MY-14": "Kuala Lumpur", "MY-15": "Labuan", "MY-16": "Putrajaya",
}


def geo_targets(regions: DataFrame, cities: DataFrame, country: str, samples: int = 5) -> DataFrame:
    """Advertising regions with their criteria and city counts and the first city names."""
    keys = ["country", "target_region"]
    city = cities.where(F.col("country") == country)
    counts = city.groupBy(*keys).agg(F.count_distinct("criteria_id").alias("criteria_ids"),
                                     F.count_distinct("target_city").alias("cities"))
    names = top_list(city, keys, F.col("target_city"), [F.col("target_city")], samples, "sample_cities",
                     distinct=True)
    return (regions.where(F.col("country") == country).join(counts, keys, "left").join(names, keys, "left")
            .select("region_iso", "target_region", "country", "subcontinent",
                    lookup("region_iso", STATES, F.col("target_region")).alias("state"),
                    F.coalesce("criteria_ids", F.lit(0)).alias("criteria_ids"),
                    F.coalesce("cities", F.lit(0)).alias("cities"), "sample_cities").distinct())


def trend_snapshot(top_terms: DataFrame, rising: DataFrame, max_rank: int = 5) -> DataFrame:
    """Latest refresh only, rising gain attached, newest week per region and rank."""
    keys = ["refresh_date", "week", "region_no", "term"]
    latest = at_latest(top_terms, "refresh_date").where(F.col("rank") <= max_rank)
    return top_per(latest.join(rising, keys, "left"), ["region_no", "rank"],
                   [F.col("week").desc(), F.col("term").asc()])


def state_trends(trends: DataFrame, customers: DataFrame, terms: int = 3) -> DataFrame:
    """Search interest of a state next to its customer base."""
    state = ["region_name", "region_no"]
    summary = trends.groupBy(*state).agg(
        F.max("refresh_date").alias("latest_refresh_date"),
        F.round(F.avg(F.col("score").cast("decimal(12,0)")), 1).alias("avg_score"),
        F.max("score").alias("peak_score"))
    label = F.concat(F.col("term"), F.lit(" (#"), F.col("rank").cast("string"), F.lit(")"))
    names = top_list(trends, state, label, [F.col("rank")], terms, "top_terms")
    base = customers.groupBy(fold("state").alias("state_key"), "state", F.col("region")).agg(
        F.count_distinct("cif_id").alias("active_customers"),
        avg_money("gross_income").alias("avg_gross_income"))
    return (join_folded(summary.join(names, state), base, "region_name", "state_key")
            .drop("state_key", "region_name"))


def category_benchmark(card_sales: DataFrame, places: DataFrame, rules: Mapping[str, Sequence[str]],
                       default: str) -> DataFrame:
    """Merchant locations by keyword category with the category's outside counts.

    Aggregated before the labels are matched and joined: the keywords run once per location.
    """
    spend = card_sales.groupBy(F.col("ldesc").alias("location"), F.col("grp").alias("merchant_group")).agg(
        F.count(F.lit(1)).alias("tx_count"), sum_money("amount").alias("total_spend"))
    spend = spend.withColumn("primary_type", like_ladder("location", rules, default))
    return spend.join(places, "primary_type", "left")


# Ad format and the wallet tier it stands for.
FORMAT_TIERS = {"IMAGE": "Gold", "VIDEO": "Platinum", "TEXT": "Silver"}


def creative_benchmark(creatives: DataFrame, home: str) -> DataFrame:
    """Verified creatives by format and topic over the whole table."""
    rows = creatives.where((F.col("verification") == "VERIFIED") & F.col("ad_format").isNotNull()
                           & F.col("topic").isNotNull()).withColumn("ad_format", fold("ad_format"))
    return rows.groupBy("ad_format", "topic", "verification").agg(
        F.count_distinct("advertiser_id").alias("advertisers"),
        F.count_distinct("creative_id").alias("creatives"),
        F.count_if(F.col("location") == home).alias("domestic_creatives"),
    ).withColumn("wallet_tier", lookup("ad_format", FORMAT_TIERS, F.lit("Basic")))


def geo_cards(geo: DataFrame, customers: DataFrame, cards: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Active cards and usage by target region, wallet tier and creative format.

    A tier that several formats map to repeats its cards once per format. Cards are summed per state
    and tier before the small benchmark is attached, and each account is counted once per state.
    """
    creatives = benchmark.groupBy("wallet_tier", F.col("ad_format").alias("primary_format")).agg(
        F.sum("creatives").alias("benchmark_creatives"))
    cust = customers.select(key("cif_id").alias("cif_id"), fold("state").alias("state_key"))
    live = cards.where(F.col("card_status") == "Active").select(
        key("cif_id").alias("cif_id"), F.col("tier").alias("wallet_tier"), "account_no", "cp_usage")
    usage = live.join(cust, "cif_id").groupBy("state_key", "wallet_tier").agg(
        F.count_distinct("account_no").alias("active_cards"), sum_money("cp_usage").alias("total_usage"))
    regions = geo.select("region_iso", "state", "target_region", "criteria_ids", "sample_cities",
                         fold("state").alias("state_key"))
    return (regions.join(usage, "state_key").join(creatives, "wallet_tier", "left")
            .drop("state_key"))


def cross_source_sales(card_sales: DataFrame, customers: DataFrame, cards: DataFrame) -> DataFrame:
    """Sales by state, type and card status, a card matching on customer or on date text.

    The joins multiply sales by cards and by customer records. All three sides are summed to their
    join keys first and weighted afterwards, so a customer with very many sales and cards never
    becomes a product of rows. Date text that is no card's customer is forgotten before the sum, so that what is
    shuffled after it is a customer's totals, not their days.
    """
    holders = cards.select(key("cif_id").alias("__holder")).distinct()
    days = card_sales.select(key("cif_no").alias("cif_no"), key("tx_dt").alias("__tx"), "sales_type", "trans_count", "amount")
    sales = days.join(holders.hint("shuffle_hash"), F.col("__tx") == F.col("__holder"), "left").groupBy(
        "cif_no", F.col("__holder").alias("tx_key"), "sales_type").agg(F.sum("trans_count").alias("trans"), sum_money("amount").alias("amount"))
    card = cards.groupBy(key("cif_id").alias("card_cif"), "card_status").agg(F.count(F.lit(1)).alias("n_cards"))
    cust = customers.groupBy(key("cif_id").alias("cust_cif"), "state").agg(F.count(F.lit(1)).alias("n_cust"))
    pairs = join_any_of(sales, card, [("cif_no", "card_cif"), ("tx_key", "card_cif")])
    pairs = pairs.groupBy("cif_no", "sales_type", "card_status").agg(
        F.sum(F.col("trans") * F.col("n_cards")).alias("trans"),
        F.sum(F.col("amount") * F.col("n_cards")).alias("amount"))
    return pairs.join(cust, F.col("cif_no") == F.col("cust_cif")).groupBy(
        "state", "sales_type", "card_status").agg(
        F.count_distinct("cif_no").alias("active_customers"),
        F.sum(F.col("trans") * F.col("n_cust")).alias("total_transactions"),
        F.sum(F.col("amount") * F.col("n_cust")).alias("total_sales"))


def tier_summary(cards: DataFrame) -> DataFrame:
    return cards.groupBy("card_status", "tier").agg(F.count(F.lit(1)).alias("total_cards"),
                                                    avg_money("cp_cl").alias("avg_limit"))


