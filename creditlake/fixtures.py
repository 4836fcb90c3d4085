"""Bronze inputs derived from the test tables.

Every fixture is one SQL text that Spark and DuckDB read alike, so an oracle check and the library
start from the same rows. ``{table}`` marks an input.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

RAW = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def ymd(col: str) -> str:
    return f"cast(year({col})*10000 + month({col})*100 + day({col}) as bigint)"


_CUSTOMER_COLS = """c_custkey as cif_id, c_name as cif_nm,
  case when c_custkey%2=0 then 'F' else 'M' end as gender,
  case when c_custkey%3=0 then 'Single' else 'Married' end as marital_sts,
  case when c_custkey%41=0 then null else 'Citizen' end as citizen,
  n_name as state, r_name as region, substr(c_mktsegment,1,1) as race, c_mktsegment as occupation,
  case when c_custkey%17=0 then '' else c_mktsegment end as nob,
  c_custkey%4 as emp_sts, 21+c_custkey%45 as age, c_custkey%12 as yr_stay, c_custkey%30 as yr_job"""

_PROMO = "case when c_custkey%5=0 then null when c_custkey%3=0 then 'N' else 'Y' end as recv_promo"

_GRADE = ("case l_linenumber%5 when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then 'D' "
          "else 'E' end")

_UNPAID = ("case when l_returnflag='R' and l_discount>=0.085e0 and l_tax>=0.065e0 "
           "then l_extendedprice else 0e0 end")


def _collection(status: str, account: str, status_col: str, sub: str) -> str:
    return f"""
select l_orderkey as {account}, o_custkey as cif_no, {ymd('l_shipdate')} as tx_dt,
  l_suppkey%50 as branch, cast(l_linenumber%5 as bigint) as {status_col},
  300+l_partkey%500 as score_value, {_GRADE} as grade, {sub}
  'Tier-'||substr(l_returnflag,1,1) as finplus, l_extendedprice as billing,
  l_extendedprice - {_UNPAID} as collection, {_UNPAID} as unpaid,
  cast(l_linenumber*20-20 as bigint) as days_past_due
from {{lineitem}} join {{orders}} on l_orderkey=o_orderkey where l_linestatus='{status}'"""


FIXTURES: dict[str, str] = {
    "f_customer": f"""
select {_CUSTOMER_COLS}, c_acctbal as net_income, c_acctbal+500e0 as gross_income,
  c_acctbal*12e0 as annual_income, {_PROMO}, date '2024-01-02' as rcd_dt
from {{customer}} join {{nation}} on c_nationkey=n_nationkey join {{region}} on n_regionkey=r_regionkey
union all
select {_CUSTOMER_COLS}, 0e0 as net_income, 0e0 as gross_income, 0e0 as annual_income, {_PROMO},
  date '2024-01-01' as rcd_dt
from {{customer}} join {{nation}} on c_nationkey=n_nationkey join {{region}} on n_regionkey=r_regionkey
where c_custkey%10=0""",
    "f_loan_app": f"""
select o_orderkey as appl_no, o_orderkey+1000000 as agree_no, o_custkey as cif_no,
  case when o_orderkey%50=0 then 0 when o_orderkey%70=0 then 20240231 else {ymd('o_orderdate')} end as appl_dt,
  {ymd('o_orderdate')} as judge_dt, ' '||o_orderstatus as status, o_orderpriority as channel,
  300+o_orderkey%550 as score, substr(o_orderpriority,1,1) as rank,
  case when o_orderkey%3=0 then 'DECLINE' else 'ACCEPT' end as decision,
  case when o_orderkey%3=0 then 'R'||cast(o_orderkey%9 as string) end as reject_code,
  o_orderkey%6 as loan_grp, o_totalprice as fin_amt, floor(o_totalprice)/24e0 as inst_amt,
  cast(o_orderkey%15 as double) as interest, 6+o_orderkey%60 as total_inst,
  cast(2000+o_custkey%9000 as double) as net_income, cast(500+o_custkey%3000 as double) as ndi,
  cast((o_orderkey*3)%100 as double) as cur_dsr, cast((o_orderkey*7)%120 as double) as new_dsr,
  floor(o_totalprice*2e0)/2e0 as total_osb
from {{orders}} where o_orderkey%2=0""",
    "f_card_app": f"""
select o_orderkey as appl_id, o_orderkey+2000000 as account_no, o_custkey as cif_id,
  case when o_orderkey%49=0 then 0 else {ymd('o_orderdate')} end as appl_dt,
  {ymd('o_orderdate')} as judge_dt, o_orderstatus||' ' as status, o_orderpriority as channel,
  case when o_orderkey%4=1 then 'VISA' else 'MASTER' end as card_type,
  'B'||cast(o_orderkey%7 as string) as card_brand,
  case when o_orderkey%3=0 then 'DECLINE' else 'ACCEPT' end as decision,
  substr(o_orderpriority,1,1) as rank, o_orderkey%11 as decline_id,
  2000+o_custkey%9000 as net_income, 500+o_custkey%3000 as ndi, (o_orderkey*5)%100 as cur_dsr,
  (o_orderkey*11)%120 as new_dsr, o_totalprice as cr_limit, 300+o_orderkey%600 as final_score,
  'S'||cast(o_orderkey%5 as string) as final_score_desc
from {{orders}} where o_orderkey%2=1""",
    "f_card": f"""
select o_orderkey as account_no, o_custkey as cif_id, {ymd('o_orderdate')} as expiry_dt,
  case o_orderstatus when 'P' then 'Blocked' else 'Active' end as card_status,
  case when o_custkey%20=0 then 'Y' else 'N' end as akpk,
  case o_custkey%4 when 0 then 'Platinum' when 1 then 'Gold' when 2 then 'Silver' else 'Basic' end as tier,
  o_totalprice as cp_cl, floor(o_totalprice*(o_orderkey%110))/100e0 as cp_usage,
  floor(o_totalprice*50e0)/100e0 as cp_available, floor(o_totalprice)/2e0 as ca_cl,
  floor(o_totalprice*(o_orderkey%30))/200e0 as ca_usage
from {{orders}} where o_orderkey%2=1 and o_custkey%3<>0""",
    "f_card_sales": f"""
select {ymd('l_shipdate')} as tx_dt, o_custkey as cif_no,
  case when l_partkey%97=0 then ' ' else s_name end as ldesc, n_name as grp,
  case l_linestatus when 'O' then 'Cash Purchase' else 'Cash Advance' end as sales_type,
  l_extendedprice as amount,
  case when l_partkey%53=0 then null else cast(l_quantity as bigint) end as trans_count
from {{lineitem}} join {{orders}} on l_orderkey=o_orderkey join {{supplier}} on l_suppkey=s_suppkey
  join {{nation}} on s_nationkey=n_nationkey""",
    "f_loan_sales": f"""
select cast({ymd('ts')} as double) as tx_dt, cast(user_id as string) as cif_no,
  'Supplier#'||lpad(cast(event_id%100 as string),9,'0') as ldesc, cast(null as string) as grp,
  'Instalment' as sales_type, value as amount, 1e0 as trans_count
from {{events}} where event_type='purchase'""",
    "f_loan_coll": _collection("F", "agree_no", "del_sts",
                               "case when l_suppkey%25=0 then 'Y' end as sub_code,"),
    "f_card_coll": _collection("O", "account_no", "dc_sts", ""),
    "f_hub": """
select s_suppkey as hub_id, s_name as hub_name, n_name as state, r_name as region,
  100e0+(s_suppkey*37%700)/100e0 as lon, 1e0+(s_suppkey*53%550)/100e0 as lat
from {supplier} join {nation} on s_nationkey=n_nationkey join {region} on n_regionkey=r_regionkey""",
    "f_poi": """
select p_partkey as poi_id, p_name as poi_name, p_type as category, p_partkey%11<>0 as takes_card,
  p_partkey%3=0 as takes_nfc, cast(p_size%6 as double) as rating, p_partkey%13<>0 as operational,
  100e0+(p_partkey*37%701)/100e0 as lon, 1e0+(p_partkey*53%551)/100e0 as lat
from {part}""",
    "f_jobs": """
select event_id as job_id, 'user'||cast(user_id as string) as user_email,
  case event_type when 'signup' then 'LOAD' else 'QUERY' end as job_type, event_type as statement_type,
  case event_type when 'signup' then 0 else cast(floor(value*1000000e0) as bigint) end as total_bytes_billed,
  cast(floor(value*3000e0) as bigint) as total_slot_ms, ts as creation_time, ts as start_time,
  cast(floor(value) as bigint) as run_ms
from {events}""",
    "f_agent_log": """
select cast(conv_id as string)||'-'||cast(turn as string) as invocation_id,
  role as agent_name, text as user_query, length(text) as prompt_tokens, turn*10 as completion_tokens,
  cast(conv_id as string) as subject_id, turn*1.2345e0 as latency_ms,
  conv_id%28 as day_offset
from {conversations}""",
    "f_trend": """
with weekly as (
  select cast(date_trunc('week', o_orderdate) as date) as week, c_nationkey, o_orderpriority as term,
    count(*) as score
  from {orders} join {customer} on o_custkey=c_custkey group by 1, 2, 3)
select case when week<date '1998-01-05' then date '2024-01-01' else date '2024-01-08' end as refresh_date,
  week, n_name as region_name, n_nationkey as region_no, term, score,
  row_number() over (partition by week, n_nationkey order by score desc, term) as rank
from weekly join {nation} on c_nationkey=n_nationkey""",
    "f_rising": """
select case when date_trunc('week', o_orderdate)<timestamp '1998-01-05 00:00:00' then date '2024-01-01'
    else date '2024-01-08' end as refresh_date,
  cast(date_trunc('week', o_orderdate) as date) as week, c_nationkey as region_no, o_orderpriority as term,
  max(o_orderkey%200) as percent_gain
from {orders} join {customer} on o_custkey=c_custkey where o_orderkey%3=0 group by 1, 2, 3, 4""",
    "f_creative": """
select 'ADV'||cast(user_id as string) as advertiser_id, event_id as creative_id,
  case event_type when 'click' then ' image' when 'view' then 'Video ' when 'signup' then 'text'
    when 'error' then null else 'audio' end as ad_format,
  'topic'||cast(event_id%6 as string) as topic,
  case when event_id%4=0 then 'PENDING' else 'VERIFIED' end as verification,
  case when user_id%3=0 then 'MY' else 'SG' end as location
from {events}""",
    "f_geo_region": """
select 'MY-'||lpad(cast(n_nationkey+1 as string),2,'0') as region_iso, n_name as target_region,
  'Malaysia' as country, r_name as subcontinent
from {nation} join {region} on n_regionkey=r_regionkey""",
    "f_geo_city": """
select s_suppkey as criteria_id, 'Malaysia' as country, n_name as target_region,
  'City'||cast(s_suppkey%40 as string) as target_city
from {supplier} join {nation} on s_nationkey=n_nationkey where s_suppkey%7<>0""",
    "f_place_summary": """
select case p_size%8 when 0 then 'department_store' when 1 then 'supermarket' when 2 then 'electronics_store'
    when 3 then 'pharmacy' when 4 then 'restaurant' when 5 then 'gas_station'
    when 6 then 'home_goods_store' else 'bakery' end as primary_type,
  count(*) as total_pois, count(case when p_partkey%11<>0 then 1 end) as card_pois,
  count(case when p_partkey%3=0 then 1 end) as nfc_pois, max(p_size) as max_rating
from {part} group by 1""",
}


def placeholders(sql: str) -> set[str]:
    return set(re.findall(r"\{(\w+)\}", sql))


class Tables:
    """Lazy access to raw tables and fixtures of one scale-factor folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._read: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._read[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in RAW:
            return self.raw(name)
        raise AttributeError(name)

    def f(self, name: str) -> DataFrame:
        """The fixture ``f_<name>``."""
        name = f"f_{name}"
        if name not in self._read:
            sql = FIXTURES[name]
            self._read[name] = self.spark.sql(sql, **{t: self.raw(t) for t in placeholders(sql)})
        return self._read[name]


def duckdb_sql(name: str) -> str:
    """The fixture as DuckDB text over the registered views."""
    sql = FIXTURES[name]
    return sql.format_map({t: t for t in placeholders(sql)}).strip()
