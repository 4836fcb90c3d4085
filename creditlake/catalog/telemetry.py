"""Agent and job telemetry queries."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..plans import telemetry as tel
from .base import part, query


def agent_log(t):
    return tel.inference_log(t.f("agent_log")).withColumn("referenced_ids", F.array("subject_id"))


def jobs(t):
    return t.f("jobs").withColumn("end_time", F.expr("start_time + make_dt_interval(0, 0, 0, run_ms / 1000.0)"))


def now():
    return F.lit(datetime.datetime(2024, 1, 31)).cast("timestamp_ntz")


part("log_rows", """
SELECT invocation_id, agent_name, user_query, prompt_tokens, completion_tokens, subject_id,
  latency_ms::decimal(18,2)::double AS latency_ms, prompt_tokens + completion_tokens AS total_tokens,
  round((prompt_tokens + completion_tokens)::decimal(12,0) * 2.67::decimal(6,4) / 1000000::bigint, 6)::double AS estimated_cost
FROM f_agent_log""")
part("job_rows", """
SELECT creation_time, job_id, user_email, job_type, statement_type,
  round((total_bytes_billed / 1048576.0)::decimal(30,12), 2)::double AS billed_megabytes,
  round((total_slot_ms::decimal(20,0) / 1000.0)::decimal(30,6), 2)::double AS slot_seconds, run_ms AS latency_ms,
  CASE WHEN job_type = 'LOAD' AND total_bytes_billed = 0 THEN 'FREE_BATCH_POOL'
    WHEN total_slot_ms > 600000 THEN 'HEAVY_OR_ZOMBIE_CANDIDATE' ELSE 'OPTIMIZED' END AS finops_class
FROM f_jobs WHERE creation_time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 DAY""")


@query("tel_01_inference_log", "SELECT invocation_id, agent_name, user_query, total_tokens::bigint AS total_tokens, latency_ms, "
                               "estimated_cost FROM log_rows")
def tel_01(t):
    return agent_log(t).select("invocation_id", "agent_name", "user_query", "total_tokens", "latency_ms", "estimated_cost")


@query("tel_02_forensics", "SELECT agent_name, subject_id, count(*) AS calls, sum(total_tokens)::bigint AS tokens "
                           "FROM log_rows GROUP BY 1, 2")
def tel_02(t):
    return tel.touched(agent_log(t))


@query("tel_03_job_costs", "SELECT * FROM job_rows")
def tel_03(t):
    return tel.job_costs(jobs(t), now())


@query("tel_04_cost_summary", """
SELECT finops_class, job_type, count(*) AS jobs, sum(billed_megabytes::decimal(18,2))::double AS billed_mb,
  sum(slot_seconds::decimal(18,2))::double AS slot_sec FROM job_rows GROUP BY 1, 2""")
def tel_04(t):
    return tel.cost_summary(tel.job_costs(jobs(t), now()))


@query("tel_05_recent_loads", """
SELECT job_id, statement_type, creation_time, total_bytes_billed AS bytes_billed, run_ms // 1000 AS duration_seconds
FROM f_jobs WHERE job_type = 'LOAD' AND creation_time >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 24 HOUR
ORDER BY creation_time DESC, job_id LIMIT 8""")
def tel_05(t):
    return tel.recent_loads(jobs(t), now())
