"""Data quality, reconciliation and metadata."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..functions.scalars import amount_text
from ..operators import quality as dq
from ..operators.lineage import lineage_report
from ..operators.profiles import column_sketches, merged_profile
from ..operators.quality import InfoType, RowRule, Rule
from ..operators.sets import union_all
from ..plans import registry, silver
from ..plans import profile as profile_plans
from ..session import scratch_path
from ..sources.tables import declare, literal_rows
from .base import part, query, stored
from .products import gold_profile

RULES = [
    Rule("cif_id_not_null", "cif_id", "COMPLETENESS", "not_null"),
    Rule("cif_id_unique", "cif_id", "UNIQUENESS", "unique"),
    Rule("positive_annual_income", "annual_income", "VALIDITY", "range", 99.0, low=0, strict_low=True),
    Rule("valid_dsr_range", "avg_loan_dsr", "VALIDITY", "range", 95.0, low=0, high=100, null_as=0),
    Rule("state_not_null", "state", "COMPLETENESS", "not_null"),
]


def _rule_sql(name, dim, col, passed, threshold):
    pct = f"round(({passed})::decimal(20,0) * 100 / count(*), 2)"
    return f"""SELECT '{name}' AS rule_name, '{dim}' AS dimension, '{col}' AS column_name, count(*) AS evaluated_rows,
  {passed} AS passed_rows, count(*) - {passed} AS failed_rows, {pct}::double AS pass_rate_pct,
  {threshold}::double AS threshold_pct, CASE WHEN {pct} >= {threshold} THEN 'PASSED' ELSE 'FAILED' END AS rule_status
FROM gold_profile"""


@query("dq_01_rule_scan", " UNION ALL ".join([
    _rule_sql("cif_id_not_null", "COMPLETENESS", "cif_id", "count(cif_id)", 100),
    _rule_sql("cif_id_unique", "UNIQUENESS", "cif_id", "count(DISTINCT cif_id)", 100),
    _rule_sql("positive_annual_income", "VALIDITY", "annual_income", "count(*) FILTER (annual_income > 0)", 99),
    _rule_sql("valid_dsr_range", "VALIDITY", "avg_loan_dsr",
              "count(*) FILTER (coalesce(avg_loan_dsr, 0) BETWEEN 0 AND 100)", 95),
    _rule_sql("state_not_null", "COMPLETENESS", "state", "count(state)", 100)]))
def dq_01(t):
    return dq.scan_rules(gold_profile(t), RULES)


def now():
    return F.lit(datetime.datetime(2024, 2, 1)).cast("timestamp_ntz")


def row_rules():
    # The names of rules and of the actions they ask for, which reports are read by.
    return [
        RowRule("DQ_RULE_01_CREDIT_LIMIT_BREACH", "card", F.col("account_no"), F.col("cif_id"),
                F.col("cp_usage") > F.col("cp_cl"),
                F.concat(F.lit("usage ("), amount_text("cp_usage"), F.lit(") > limit ("), amount_text("cp_cl"), F.lit(")"))),
        RowRule("DQ_RULE_02_EXCESSIVE_NEW_DSR", "loan_app", F.col("appl_no"), F.col("cif_no"), F.col("new_dsr") > 100,
                F.concat(F.lit("new_dsr = "), amount_text("new_dsr"), F.lit("% exceeds 100% policy cap")),
                "WARN_FOR_MANUAL_UNDERWRITING"),
        RowRule("DQ_RULE_03_INVALID_NET_INCOME", "customer", F.col("cif_id"), F.col("cif_id"), F.col("net_income") <= 0,
                F.concat(F.lit("net_income = "), amount_text("net_income"), F.lit(" is <= 0")),
                "DROP_FROM_GOLD_FEATURE_STORE"),
    ]


def build_quarantine(t):
    return dq.quarantine({n: t.f(n) for n in ("card", "loan_app", "customer")}, row_rules(), now())


part("quarantine_rows", """
SELECT TIMESTAMP '2024-02-01 00:00:00' AS evaluated_at, 'card' AS source_table, account_no::varchar AS record_key,
  cif_id::varchar AS cif_id, 'DQ_RULE_01_CREDIT_LIMIT_BREACH' AS rule_id, 'WARN_AND_QUARANTINE' AS enforcement_action,
  'usage (' || cp_usage::decimal(18,2)::varchar || ') > limit (' || cp_cl::decimal(18,2)::varchar || ')' AS violation_detail
FROM f_card WHERE cp_usage > cp_cl
UNION ALL
SELECT TIMESTAMP '2024-02-01 00:00:00', 'loan_app', appl_no::varchar, cif_no::varchar, 'DQ_RULE_02_EXCESSIVE_NEW_DSR',
  'WARN_FOR_MANUAL_UNDERWRITING', 'new_dsr = ' || new_dsr::decimal(18,2)::varchar || '% exceeds 100% policy cap'
FROM f_loan_app WHERE new_dsr > 100
UNION ALL
SELECT TIMESTAMP '2024-02-01 00:00:00', 'customer', cif_id::varchar, cif_id::varchar, 'DQ_RULE_03_INVALID_NET_INCOME',
  'DROP_FROM_GOLD_FEATURE_STORE', 'net_income = ' || net_income::decimal(18,2)::varchar || ' is <= 0'
FROM f_customer WHERE net_income <= 0""")


@query("dq_02_quarantine", "SELECT * FROM quarantine_rows")
def dq_02(t):
    return build_quarantine(t)


@query("dq_03_quarantine_summary", """
SELECT evaluated_at, rule_id, source_table, enforcement_action, count(*) AS quarantined_rows
FROM quarantine_rows GROUP BY 1, 2, 3, 4""")
def dq_03(t):
    return dq.quarantine_summary(build_quarantine(t))


@query("dq_04_assertions", """
SELECT 'nonNull(cif_id)' AS assertion, 0::bigint AS violations FROM customer WHERE c_custkey = 0
UNION ALL SELECT 'nonNull(state)', count(*) FILTER (state IS NULL) FROM f_customer
UNION ALL SELECT 'uniqueKey(cif_id)', count(*) - count(DISTINCT cif_id) FROM f_customer""")
def dq_04(t):
    return dq.assertion_report(t.f("customer"), ["cif_id", "state"], ["cif_id"])


def _recon_sql(flow, metric, b_rows, b_total, s_from, s_total):
    return f"""SELECT '{flow}' AS flow, '{metric}' AS metric, b.n AS bronze_rows, s.n AS silver_rows,
  round(b.v, 2)::double AS bronze_total, round(s.v, 2)::double AS silver_total, (s.v - b.v)::double AS variance,
  CASE WHEN b.n = s.n AND s.v = b.v THEN 'PASS' ELSE 'INVESTIGATE' END AS audit_status
FROM (SELECT {b_rows} AS n, sum(({b_total})::decimal(28,9)) AS v FROM {{b}}) b,
  (SELECT count(*) AS n, sum({s_total}::decimal(28,9)) AS v FROM {s_from}) s"""


@query("dq_05_reconciliation", " UNION ALL ".join([
    _recon_sql("loan applications", "fin_amt", "count(*)", "fin_amt", "silver_loan_app", "fin_amt").format(b="f_loan_app"),
    _recon_sql("card applications", "cr_limit", "count(*)", "cr_limit", "silver_card_app", "cr_limit").format(b="f_card_app"),
    _recon_sql("collections", "unpaid", "count(DISTINCT cif_no)", "unpaid", "silver_coll_summary", "combined_unpaid").format(
        b="(SELECT cif_no, unpaid FROM f_loan_coll UNION ALL SELECT cif_no, unpaid FROM f_card_coll)")]))
def dq_05(t):
    loan, card = t.f("loan_app"), t.f("card_app")
    coll = t.f("loan_coll").select("cif_no", "unpaid").unionByName(t.f("card_coll").select("cif_no", "unpaid"))
    return dq.reconcile([
        dq.Control("loan applications", "fin_amt", loan, silver.loan_applications(loan), "fin_amt", "fin_amt"),
        dq.Control("card applications", "cr_limit", card, silver.card_applications(card), "cr_limit", "cr_limit"),
        dq.Control("collections", "unpaid", coll, silver.collections_summary(t.f("loan_coll"), t.f("card_coll")),
                   "unpaid", "combined_unpaid", F.count_distinct("cif_no"))])


@query("dq_05b_reconciliation_below_a_cent", " UNION ALL ".join([
    _recon_sql("kept", "fee", "count(*)", "l_discount * l_tax", "(SELECT l_discount * l_tax AS v FROM lineitem)", "v").format(b="lineitem"),
    _recon_sql("rounded", "fee", "count(*)", "l_discount * l_tax", "(SELECT round((l_discount * l_tax)::decimal(28,9), 2) AS v FROM lineitem)", "v").format(b="lineitem")]))
def dq_05b(t):
    """Fees of a few thousandths: a silver table that rounds each of them is found out."""
    fees = t.lineitem.select((F.col("l_discount") * F.col("l_tax")).alias("amount"))
    return dq.reconcile([dq.Control("kept", "fee", fees, fees.select("amount")),
                         dq.Control("rounded", "fee", fees, fees.select(F.round(F.col("amount").cast("decimal(28,9)"), 2).alias("amount")))])


INPUTS = ("customer", "card", "loan_app", "card_app", "loan_coll", "card_coll", "card_sales", "loan_sales")


@query("dq_06_readiness", " UNION ALL ".join(f"SELECT 'bronze_{n}' AS table_name, true AS present, count(*) AS row_count FROM f_{n}" for n in INPUTS) + """
UNION ALL SELECT 'bronze_absent', count(*) < 0, CASE WHEN count(*) < 0 THEN 1 END FROM f_card""")
def dq_06(t):
    """Which of the eight bronze relations are registered, with their rows."""
    names = list(INPUTS)
    for n in names:
        t.f(n).createOrReplaceTempView(f"bronze_{n}")
    ready = dq.tables_ready(t.spark, [f"bronze_{n}" for n in [*names, "absent"]])
    counts = {f"bronze_{n}": t.spark.table(f"bronze_{n}") for n in names}
    from ..operators.sets import labelled_counts
    return ready.join(labelled_counts(counts, "table_name"), "table_name", "left")


@query("dq_07_post_run_gate", """
SELECT (SELECT sum(fin_amt::decimal(18,2)) FROM f_loan_app) - (SELECT sum(fin_amt) FROM silver_loan_app) = 0
  AND (SELECT count(*) FROM gold_profile) > 0 AND (SELECT count(*) FROM feature_rows) > 0 AS passed""")
def dq_07(t):
    gold = gold_profile(t)
    return dq.zero_variance_gate(t.f("loan_app"), silver.loan_applications(t.f("loan_app")), "fin_amt",
                                 [gold, profile_plans.feature_store(gold)])


# Every column of the customer table, and an id beyond sixteen digits.
TEXTS = ["cif_nm", "gender", "marital_sts", "citizen", "state", "region", "race", "occupation", "nob", "recv_promo"]
NUMBERS = ["cif_id", "emp_sts", "age", "yr_stay", "yr_job", "net_income", "gross_income", "annual_income"]


def _profile_sql(c):
    lo, av, hi = (f"min({c})::double", f"round(avg({c}::decimal(28,9))::double, 4)", f"max({c})::double") if c in NUMBERS else (
        (f"min({c})::double", "NULL::double", f"max({c})::double") if c == "long_id" else ("NULL::double",) * 3)
    return f"""SELECT '{c}' AS column_name, count(*) AS row_count,
  round((count(*) - count({c}))::decimal(20,0) * 100 / count(*), 2)::double AS null_pct,
  round(count(DISTINCT {c})::decimal(20,0) * 100 / count(*), 2)::double AS uniqueness_pct,
  count(DISTINCT {c}) AS distinct_count, {lo} AS min_value, {av} AS avg_value, {hi} AS max_value
FROM (SELECT *, cif_id + 100000000000000000 AS long_id FROM f_customer)"""


@query("dq_08_profile", " UNION ALL ".join(_profile_sql(c) for c in [*TEXTS, *NUMBERS, "rcd_dt", "long_id"]))
def dq_08(t):
    rows = t.f("customer").withColumn("long_id", F.col("cif_id") + F.lit(100000000000000000))
    number = lambda c: F.when(F.col("column_name").isin(*NUMBERS, "long_id"), F.col(c).try_cast("double"))
    return dq.profile(rows, exact=rows.columns).withColumns({
        "min_value": number("min_value"), "max_value": number("max_value"),
        "avg_value": F.when(F.col("column_name") != "long_id", F.round("avg_value", 4))})


@query("dq_09_first_present", "SELECT round(avg(avg_loan_dsr)::decimal(22,6), 2)::double AS avg_dsr FROM gold_profile")
def dq_09(t):
    gold = gold_profile(t)
    column = dq.first_present(gold, ["avg_dsr", "AVG_LOAN_DSR", "avg_card_dsr"])
    return gold.agg(F.round(F.avg(column), 2).alias("avg_dsr"))


COMMENTS = {"cif_id": ("bigint", "Customer id"), "state": ("string", "State of residence"), "age": ("bigint", "")}
ALL_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
              "labels", "conversations")


@query("dq_10_metadata_coverage", """
SELECT 'cards' AS table_name, count(*) AS row_count, 11::bigint AS total_columns, 0::bigint AS described_columns,
  0.0::double AS coverage_pct FROM f_card
UNION ALL SELECT 'customers', count(*), 19, 2, 10.5 FROM f_customer
UNION ALL SELECT 'TOTAL', (SELECT count(*) FROM f_card) + (SELECT count(*) FROM f_customer), 30, 2, 6.7""")
def dq_10(t):
    return dq.metadata_coverage({"cards": t.f("card"), "customers": declare(t.f("customer"), COMMENTS, keep_others=True)})


@query("dq_11_storage_audit")
def dq_11(t):
    return dq.storage_audit({n: t.raw(n) for n in ALL_TABLES})


@query("dq_11b_stored_rows", " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in ALL_TABLES))
def dq_11b(t):
    return dq.storage_audit({n: t.raw(n) for n in ALL_TABLES}).select("table_name", F.col("row_count").cast("bigint").alias("row_count"))


# Test dictionary: kinds of values present in the derived customer table.
STATE_WORDS = tuple(f"NATION_{i}" for i in range(25))
INFO_TYPES = [InfoType("PERSON_NAME", r"^Customer#[0-9]{9}$", level="HIGH_PII", action="SHA256"),
              InfoType("CUSTOMER_ID", r"^[0-9]{3,10}$", level="MODERATE_IDENTIFIER", action="PSEUDONYMISE"),
              InfoType("STATE", words=STATE_WORDS, level="QUASI_IDENTIFIER", action="ROW_POLICY")]


def _pii_sql(col, kind, hit, level, action):
    ratio = f"round((count(*) FILTER ({hit}))::decimal(20,0) / count({col}), 4)"
    return f"""SELECT '{col}' AS column_name, '{kind}' AS infotype, count({col}) AS values,
  count(*) FILTER ({hit}) AS hits, '{level}' AS sensitivity_level, '{action}' AS governance_action,
  {ratio}::double AS hit_ratio, CASE WHEN {ratio} >= 0.95 THEN 'VERY_LIKELY' WHEN {ratio} >= 0.5 THEN 'LIKELY'
  ELSE 'POSSIBLE' END AS likelihood FROM f_customer"""


@query("dq_12_sensitive_data", " UNION ALL ".join([
    _pii_sql("cif_nm", "PERSON_NAME", "regexp_full_match(cif_nm, 'Customer#[0-9]{9}')", "HIGH_PII", "SHA256"),
    _pii_sql("cif_id", "CUSTOMER_ID", "regexp_full_match(cif_id::varchar, '[0-9]{3,10}')", "MODERATE_IDENTIFIER", "PSEUDONYMISE"),
    _pii_sql("state", "STATE", "state LIKE 'NATION_%'", "QUASI_IDENTIFIER", "ROW_POLICY")]))
def dq_12(t):
    return dq.pii_scan(t.f("customer"), INFO_TYPES)


_MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
TEXT_COLUMNS = [("documents", "text"), ("documents", "lang"), ("documents", "source"), ("pages", "url"), ("pages", "html"),
                ("conversations", "role"), ("conversations", "text")]


def _mail_sql(table, col):
    hits = f"count(*) FILTER (regexp_matches({col}, '{_MAIL}'))"
    return f"""SELECT '{table}' AS table_name, '{col}' AS column_name, 'EMAIL' AS infotype, count({col}) AS values, {hits} AS hits,
  'HIGH_PII' AS sensitivity_level, 'REDACT' AS governance_action, round(({hits})::decimal(20,0) / count({col}), 4)::double AS hit_ratio,
  CASE WHEN round(({hits})::decimal(20,0) / count({col}), 4) >= 0.95 THEN 'VERY_LIKELY'
    WHEN round(({hits})::decimal(20,0) / count({col}), 4) >= 0.5 THEN 'LIKELY' ELSE 'POSSIBLE' END AS likelihood
FROM {table} HAVING {hits} > 0"""


@query("dq_12b_sensitive_text", " UNION ALL ".join(_mail_sql(*c) for c in TEXT_COLUMNS))
def dq_12b(t):
    """Every text column of the three text tables."""
    mail = InfoType("EMAIL", _MAIL, level="HIGH_PII", action="REDACT")
    return union_all([dq.pii_scan(t.raw(n).select(*[c for m, c in TEXT_COLUMNS if m == n]), [mail]).withColumn("table_name", F.lit(n))
                      for n in dict.fromkeys(m for m, _ in TEXT_COLUMNS)])


CATALOG = [("cif_nm", "HIGH_PII", "SHA256 mask", True), ("cif_id", "MODERATE_IDENTIFIER", "Pseudonymise in clean rooms", True),
           ("cif_no", "MODERATE_IDENTIFIER", "Pseudonymise in clean rooms", True),
           ("net_income", "HIGH_CONFIDENTIAL", "Default value mask", True),
           ("state", "QUASI_IDENTIFIER", "Row policy by state", False)]


@query("dq_13_sensitivity_tags", """
SELECT 'customer' AS table_name, 'bronze' AS layer, count(*) AS row_count, 19::bigint AS columns, 4::bigint AS catalogued,
  'cif_id, cif_nm, net_income' AS pii_columns, 'SHA256 mask' AS masking_advice FROM f_customer
UNION ALL SELECT 'card', 'bronze', count(*), 11, 1, 'cif_id', 'Pseudonymise in clean rooms' FROM f_card
UNION ALL SELECT 'profile', 'gold', count(*), 22, 4, 'cif_id, cif_nm, net_income', 'SHA256 mask' FROM gold_profile""")
def dq_13(t):
    catalog = literal_rows(t.spark, CATALOG, "column_name string, level string, advice string, is_pii boolean")
    return dq.sensitivity_tags({"customer": t.f("customer"), "card": t.f("card"), "profile": gold_profile(t)},
                               catalog, {"profile": "gold"})


@query("dq_14_lineage")
def dq_14(t):
    gold = gold_profile(t)
    schemas = {n: t.f(n) for n in ("customer", "loan_app", "card_app", "loan_coll", "card_coll", "card")}
    schemas |= {"silver_customer": silver.customers(schemas["customer"]),
                "silver_loan_app": silver.loan_applications(schemas["loan_app"]),
                "silver_card_app": silver.card_applications(schemas["card_app"]),
                "silver_collections": silver.collections_summary(schemas["loan_coll"], schemas["card_coll"]),
                "gold_profile": gold, "gold_features": profile_plans.feature_store(gold)}
    return registry.lineage(registry.MEDALLION, schemas)


def stored_bronze(t):
    """The six bronze tables of the profile as files, which a plan can be traced to."""
    return {n: stored(t, f"bronze_{n}", lambda t, n=n: t.f(n)) for n in ("customer", "loan_app", "card_app", "loan_coll", "card_coll", "card")}


def profile_from(bronze):
    return profile_plans.customer_profile(
        silver.customers(bronze["customer"]), silver.loan_applications(bronze["loan_app"]), silver.card_applications(bronze["card_app"]),
        silver.collections_summary(bronze["loan_coll"], bronze["card_coll"]), bronze["card"])


# Read off the definitions of the tables: (columns of the profile, bronze table, its column, how).
_SUMS = "total_loan_unpaid total_card_unpaid combined_unpaid"
TRACED = [
    *[(c, "customer", c, "derived") for c in ("cif_id", "cif_nm", "state", "region", "occupation", "age", "net_income", "annual_income", "recv_promo")],
    ("avg_loan_dsr", "loan_app", "new_dsr", "aggregated"), ("total_loan_financed", "loan_app", "fin_amt", "aggregated"),
    ("latest_bureau_score", "card_app", "final_score", "aggregated"), ("total_card_limit", "card_app", "cr_limit", "aggregated"),
    ("active_card_count", "card", "card_status", "aggregated"), ("total_cp_usage", "card", "cp_usage", "aggregated"),
    ("total_cp_available", "card", "cp_available", "aggregated"),
    *[(c, t, "unpaid", "aggregated") for c in _SUMS.split() for t in ("loan_coll", "card_coll")],
    *[("worst_collection_grade", t, "grade", "aggregated") for t in ("loan_coll", "card_coll")],
    # which rows there are: the newest record of each customer, matched with four sums by customer
    *[("*", "customer", c, how) for c in ("cif_id", "rcd_dt", "net_income", "cif_nm", "state", "nob") for how in ("window", "filter")],
    ("*", "customer", "cif_id", "join"),
    *[("*", t, c, how) for t, c in (("loan_app", "cif_no"), ("card_app", "cif_id"), ("loan_coll", "cif_no"), ("card_coll", "cif_no"), ("card", "cif_id"))
      for how in ("group", "join")]]


@query("dq_14b_column_lineage", " UNION ALL ".join(
    f"SELECT '{target}' AS target_column, '{t}' AS source_table, '{c}' AS source_column, '{how}' AS how, count(*) AS source_rows, "
    f"count({c}) AS source_values FROM f_{t}" for target, t, c, how in TRACED))
def dq_14b(t):
    """Each column of the customer profile traced through renamings, expressions, aggregates and a deduplication to bronze columns."""
    bronze = stored_bronze(t)
    return lineage_report(profile_from(bronze), bronze)


def _contain_sql(l, lc, r, rc):
    return f"""SELECT '{l}' AS left_table, '{lc}' AS left_column, '{r}' AS right_table, '{rc}' AS right_column,
  count(*) AS left_keys, count(*) FILTER (k IN (SELECT {rc} FROM {r} WHERE {rc} IS NOT NULL)) AS shared_keys,
  round((count(*) FILTER (k IN (SELECT {rc} FROM {r} WHERE {rc} IS NOT NULL)))::decimal(20,0) / count(*), 4)::double AS confidence
FROM (SELECT DISTINCT {lc} AS k FROM {l} WHERE {lc} IS NOT NULL)"""


CANDIDATES = [("orders", "o_custkey", "customer", "c_custkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
              ("part", "p_partkey", "supplier", "s_suppkey"), ("customer", "c_nationkey", "nation", "n_nationkey")]


@query("dq_15_relationships", " UNION ALL ".join(_contain_sql(*c) for c in CANDIDATES))
def dq_15(t):
    names = {n for c in CANDIDATES for n in (c[0], c[2])}
    return dq.relationships({n: t.raw(n) for n in names}, CANDIDATES)


FOUND = [("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
         ("supplier", "s_nationkey", "nation", "n_nationkey"), ("lineitem", "l_orderkey", "orders", "o_orderkey"),
         ("lineitem", "l_partkey", "part", "p_partkey"), ("nation", "n_regionkey", "region", "r_regionkey")]


@query("dq_15b_discovered_relationships", " UNION ALL ".join(f"SELECT * FROM ({_contain_sql(*c)}) WHERE confidence >= 0.5" for c in
       [*FOUND, ("lineitem", "l_suppkey", "supplier", "s_suppkey"), ("labels", "doc_id", "documents", "doc_id")]))
def dq_15b(t):
    """The keys of all tables that their names give away."""
    return dq.discover_relationships({n: t.raw(n) for n in ALL_TABLES})


KEY_COLUMNS = {
    "number": {"region": "r_regionkey", "nation": "n_nationkey n_regionkey", "customer": "c_custkey c_nationkey", "supplier": "s_suppkey s_nationkey",
               "part": "p_partkey p_size", "orders": "o_orderkey o_custkey", "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber",
               "events": "event_id user_id", "documents": "doc_id n_chars", "embeddings": "vec_id label", "pages": "page_id", "benchmark": "item_id",
               "labels": "doc_id quality toxic", "conversations": "conv_id turn"},
    "text": {"region": "r_name", "nation": "n_name", "customer": "c_name c_mktsegment", "supplier": "s_name", "part": "p_name p_brand p_type",
             "orders": "o_orderstatus o_orderpriority", "lineitem": "l_returnflag l_linestatus", "events": "event_type props",
             "documents": "text lang source", "pages": "url html", "benchmark": "text", "conversations": "role text"},
    "time": {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}}
_VALUES = " UNION ALL ".join(f"SELECT '{t}' AS t, '{c}' AS c, '{k}' AS k, {c}::varchar AS v, count(*) AS n FROM {t} WHERE {c} IS NOT NULL GROUP BY ALL"
                             for k, names in KEY_COLUMNS.items() for t, cs in names.items() for c in cs.split())


@query("dq_15c_inclusion_dependencies", f"""
WITH held AS ({_VALUES}), sizes AS (SELECT t, c, count(*) AS keys, max(n) = 1 AS is_key FROM held GROUP BY 1, 2),
shared AS (SELECT a.t AS lt, a.c AS lc, b.t AS rt, b.c AS rc, count(*) AS n FROM held a JOIN held b ON a.k = b.k AND a.v = b.v AND a.t <> b.t GROUP BY ALL)
SELECT lt AS left_table, lc AS left_column, rt AS right_table, rc AS right_column, l.keys AS left_keys, n AS shared_keys,
  round(n::decimal(20,0) / l.keys, 4)::double AS confidence, r.is_key AS right_unique
FROM shared JOIN sizes l ON l.t = lt AND l.c = lc JOIN sizes r ON r.t = rt AND r.c = rc WHERE n / l.keys >= 0.5""")
def dq_15c(t):
    """Every column of all tables against every other, names unseen."""
    return dq.inclusion_dependencies({n: t.raw(n) for n in ALL_TABLES})


# All scalar columns of the raw tables: (table, column, is a number).
_SCALARS = [(t, c, k == "number") for k, names in KEY_COLUMNS.items() for t, cs in names.items() for c in cs.split()] + [
    (t, c, True) for t, cs in {"customer": "c_acctbal", "supplier": "s_acctbal", "part": "p_retailprice", "orders": "o_totalprice",
                               "lineitem": "l_quantity l_extendedprice l_discount l_tax", "events": "value"}.items() for c in cs.split()]


@query("dq_08b_profiles_of_parts", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) AS row_count, count({c}) AS filled, "
    f"round((count(*) - count({c}))::decimal(20,0) * 100 / count(*), 2)::double AS null_pct, "
    + (f"min({c})::double AS min_number, max({c})::double AS max_number" if number else "NULL::double AS min_number, NULL::double AS max_number") + f" FROM {t}"
    for t, c, number in _SCALARS))
def dq_08b(t):
    """Every scalar column of all tables: sketches by part, stored, then united. Estimates are held to their bounds in the tests."""
    out = []
    for name in ALL_TABLES:
        df = t.raw(name)
        part = F.pmod(F.xxhash64(F.col(df.columns[0])), F.lit(4))
        path = scratch_path(t.spark, "sketches")
        column_sketches(df, part).write.parquet(path)
        out.append(merged_profile(t.spark.read.parquet(path)).select(F.lit(name).alias("table_name"), "column_name", "row_count", "filled", "null_pct", "min_number", "max_number"))
    return union_all(out)


@query("dq_16b_differing_rows", """
SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 1000 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, 'right' AS side, 1::bigint AS copies
FROM orders WHERE o_orderkey % 1000 IN (7, 9)
UNION ALL SELECT o_orderkey, o_custkey, o_totalprice, 'left', 1 FROM orders WHERE o_orderkey % 1000 IN (7, 8)""")
def dq_16b(t):
    """Orders against a copy with changed, lost and repeated rows."""
    left = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    part = F.col("o_orderkey") % 1000
    right = left.where(part != 8).withColumn("o_totalprice", F.col("o_totalprice") + F.when(part == 7, 1).otherwise(0)).unionByName(left.where(part == 9))
    return dq.differing_rows(left, right, ["o_orderkey"])
