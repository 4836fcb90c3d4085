"""Sources and sinks: write from the test tables, read back."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from ..operators.joins import at_latest
from ..plans import marts
from ..schemas import BRONZE, LOAN_APPLICATION
from ..session import scratch_path
from ..sources import files, tables
from .base import query


@query("src_01_csv_gzip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def src_01(t):
    """Whole texts with quotes and newlines through gzip CSV and back."""
    path = scratch_path(t.spark, "csv")
    rows = t.documents.select("doc_id", "text", "lang", "source", "n_chars")
    files.write_csv(rows, path)
    return files.load_csv(t.spark, path, rows.schema, multi_line=True)


@query("src_02_described_table", "SELECT appl_no, cif_no, appl_dt, status, fin_amt FROM f_loan_app")
def src_02(t):
    name, path = "described_loan_app", scratch_path(t.spark, "described")
    tables.create_table(t.spark, name, LOAN_APPLICATION, "Loan applications, as delivered", path)
    tables.declare(t.f("loan_app"), LOAN_APPLICATION).write.mode("append").insertInto(name)
    return t.spark.read.table(name).select("appl_no", "cif_no", "appl_dt", "status", "fin_amt")


@query("src_03_landed_table", "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer")
def src_03(t):
    csv, path = scratch_path(t.spark, "landing"), scratch_path(t.spark, "landed")
    files.write_csv(t.customer, csv, compression="none")
    tables.land_table(files.load_csv_inferred(t.spark, csv), "landed_customer", path)
    return t.spark.read.table("landed_customer").select(
        F.col("c_custkey").cast("bigint").alias("c_custkey"), "c_name", "c_acctbal", "c_mktsegment")


CARD_CASTS = {"account_no": "bigint", "cif_id": "bigint", "expiry_dt": "bigint", "card_status": "string",
              "tier": "string", "cp_cl": "double", "cp_usage": "double"}


@query("src_04_typed_staging", "SELECT account_no, CASE WHEN cif_id % 7 <> 0 THEN cif_id END AS cif_id, expiry_dt, card_status, "
                               "tier, cp_cl, cp_usage FROM f_card")
def src_04(t):
    staged = t.f("card").select(*[F.col(c).cast("string").alias(c) for c in CARD_CASTS])
    staged = staged.withColumn("cif_id", F.when(F.col("cif_id").cast("bigint") % 7 == 0, "").otherwise(F.col("cif_id")))
    return files.type_staging(staged, CARD_CASTS)


DICTIONARY = {"CIF_ID": "Customer id", "State": "State of residence", "Net_Income": "Monthly net income"}


@query("src_05_described_view", """
SELECT i AS ordinal, c AS column_name, d AS comment, n AS values FROM (
  SELECT 1 AS i, 'cif_id' AS c, 'Customer id' AS d, count(cif_id) AS n FROM f_customer
  UNION ALL SELECT 2, 'state', 'State of residence', count(state) FROM f_customer
  UNION ALL SELECT 3, 'net_income', 'Monthly net income', count(net_income) FROM f_customer
  UNION ALL SELECT 4, 'citizen', 'Attribute: citizen', count(citizen) FROM f_customer)""")
def src_05(t):
    view = tables.describe(t.f("customer").select("cif_id", "state", "net_income", "citizen"), DICTIONARY)
    return tables.column_listing(view).drop("data_type")


@query("src_06_three_stores", """
SELECT c.state, s.sales_type, s.card_status, count(DISTINCT s.cif_no) AS active_customers,
  sum(s.trans_count)::bigint AS total_transactions, sum(s.amount::decimal(18,2))::double AS total_sales
FROM (SELECT s.*, p.card_status FROM f_card_sales s JOIN f_card p ON s.cif_no = p.cif_id
      UNION ALL
      SELECT s.*, p.card_status FROM f_card_sales s JOIN f_card p ON s.tx_dt = p.cif_id AND s.cif_no <> p.cif_id) s
JOIN f_customer c ON s.cif_no = c.cif_id GROUP BY 1, 2, 3""")
def src_06(t):
    """Sales from Parquet, customers from CSV and cards from a catalog table in one query."""
    csv, path = scratch_path(t.spark, "customers"), scratch_path(t.spark, "cards")
    files.write_csv(t.f("customer").select("cif_id", "state"), csv)
    tables.land_table(t.f("card").select("cif_id", "card_status"), "landed_card", path)
    customers = files.load_csv(t.spark, csv, "cif_id bigint, state string")
    return marts.cross_source_sales(t.f("card_sales"), customers, t.spark.read.table("landed_card"))


SEGMENTS = [("AUTOMOBILE", "goods"), ("BUILDING", "works"), ("FURNITURE", "goods"), ("HOUSEHOLD", "goods"), ("MACHINERY", "works")]


@query("src_07_literal_relation", """
SELECT kind, count(*) AS n FROM customer JOIN (VALUES ('AUTOMOBILE', 'goods'), ('BUILDING', 'works'), ('FURNITURE', 'goods'),
  ('HOUSEHOLD', 'goods'), ('MACHINERY', 'works')) v(segment, kind) ON c_mktsegment = segment GROUP BY 1""")
def src_07(t):
    dim = tables.literal_rows(t.spark, SEGMENTS, "c_mktsegment string, kind string")
    return t.customer.join(dim, "c_mktsegment").groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query("src_08_clustered_table", "SELECT account_no, tier, cif_id FROM f_card WHERE tier = 'Gold'")
def src_08(t):
    path = scratch_path(t.spark, "clustered")
    tables.write_clustered(t.f("card"), path, ["tier", "cif_id"])
    return t.spark.read.parquet(path).where(F.col("tier") == "Gold").select("account_no", "tier", "cif_id")


@query("src_08b_interleaved_table", "SELECT account_no, tier, cif_id, card_status FROM f_card WHERE cif_id BETWEEN 100 AND 140")
def src_08b(t):
    """Clustered on three columns at once: a filter on the last alone prunes files."""
    path = scratch_path(t.spark, "interleaved")
    tables.write_interleaved(t.f("card"), path, ["account_no", "tier", "cif_id"])
    return t.spark.read.parquet(path).where(F.col("cif_id").between(100, 140)).select("account_no", "tier", "cif_id", "card_status")


@query("src_09_append_log", "SELECT ts::date AS log_date, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def src_09(t):
    path = scratch_path(t.spark, "log")
    purchase = F.col("event_type") == "purchase"
    tables.append_log(t.events.where(purchase), path, "ts", ["event_type"])
    tables.append_log(t.events.where(~purchase), path, "ts", ["event_type"])
    return t.spark.read.parquet(path).groupBy("log_date", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("src_10_json_rows", "SELECT event_id, user_id, event_type, value, props FROM events")
def src_10(t):
    path = scratch_path(t.spark, "json")
    rows = t.events.select("event_id", "user_id", "event_type", "value", "props")
    rows.write.json(path)
    return files.load_json(t.spark, path, rows.schema)


@query("src_11_discovery", """
SELECT 'Customer_CSV' AS table_name, 4::bigint AS total_columns, 'c_key,name,Nation_Key,acct' AS columns, count(*) AS row_count
FROM customer
UNION ALL SELECT 'Nation_CSV', 2, 'n_nationkey,n_name', count(*) FROM nation""")
def src_11(t):
    root = scratch_path(t.spark, "discover")
    files.write_csv(t.customer.select(F.col("c_custkey").alias("c-key"), F.col("c_name").alias("_name"),
                                      F.col("c_nationkey").alias("Nation-Key"), F.col("c_acctbal").alias("__acct")),
                    f"{root}/Customer_CSV", compression="none")
    files.write_csv(t.nation.select("n_nationkey", "n_name"), f"{root}/Nation_CSV", compression="none")
    found, audit = files.discover(t.spark, root)
    from ..operators.sets import union_all
    rows = union_all([df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(n).alias("table_name"), F.lit(len(df.columns)).cast("bigint").alias("total_columns"),
        F.lit(",".join(df.columns)).alias("columns"), "row_count") for n, df in found.items()])
    return rows.join(audit.select("table_name"), "table_name", "left_semi")


@query("src_11b_discovery_of_like_names", """
SELECT 'east/2024' AS table_name, sum(CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END)::bigint AS row_count, true AS has_objects FROM customer
UNION ALL SELECT 'west/2024', count(*), true FROM nation
UNION ALL SELECT 'west/parts', count(*), true FROM region""")
def src_11b(t):
    """Folders of one name below different parents, and one with partition folders, are three tables; the audit names objects."""
    root = scratch_path(t.spark, "discover")
    files.write_csv(t.customer.where("c_custkey % 2 = 0"), f"{root}/east/2024", compression="none")
    files.write_csv(t.nation, f"{root}/west/2024", compression="none")
    t.region.write.partitionBy("r_regionkey").option("header", "true").csv(f"{root}/west/parts")
    found, audit = files.discover(t.spark, root)
    from ..operators.sets import labelled_counts
    objects = audit.groupBy("table_name").agg((F.count_if(F.col("object_name").endswith(".csv") & (F.col("size_bytes") > 0)) > 0).alias("has_objects"))
    return labelled_counts(found, "table_name").join(objects, "table_name", "left")


@query("src_12_snapshot", "SELECT week, region_no, term, score FROM f_trend WHERE refresh_date = (SELECT max(refresh_date) FROM f_trend)")
def src_12(t):
    latest = at_latest(t.f("trend"), "refresh_date").select("week", "region_no", "term", "score")
    return tables.snapshot(latest, scratch_path(t.spark, "snapshot"))


LINKS = [("customer-id", "cif_id"), ("income-band", "net_income"), ("income-band", "annual_income"),
         ("marketing-consent", "recv_promo"), ("debt-service-ratio", "avg_loan_dsr"), ("bureau-score", "latest_bureau_score"),
         ("unpaid-principal", "combined_unpaid"), ("unpaid-principal", "total_loan_unpaid"),
         ("unpaid-principal", "total_card_unpaid"), ("utilisation", "total_cp_usage"), ("utilisation", "total_card_limit")]


@query("src_13_glossary", " UNION ALL ".join(
    f"SELECT '{term}' AS term_id, '{c}' AS column_name, count({c}) AS values FROM gold_profile" for term, c in LINKS))
def src_13(t):
    """Glossary terms with the number of values in each linked profile column."""
    from .products import gold_profile
    text = (Path(files.__file__).parent / "glossary.yaml").read_text()
    terms = files.glossary(t.spark, text).withColumn("column_name", F.explode(F.split("linked_columns", ", ")))
    return terms.join(tables.column_listing(gold_profile(t)).select("column_name", "values"), "column_name", "left").select(
        "term_id", "column_name", "values")


def declared(t, name: str):
    """A bronze fixture in its declared layout."""
    return tables.declare(t.f(name), BRONZE[name])


