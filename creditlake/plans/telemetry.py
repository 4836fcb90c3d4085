"""Agent and job telemetry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import ladder
from ..operators.topk import top_k

# Price per million tokens and exchange rate.
PRICE_PER_MILLION, EXCHANGE_RATE = "0.60", "4.45"
HEAVY_SLOT_MS = 600000


def inference_log(rows: DataFrame) -> DataFrame:
    """Token total, cost and latency to 2 decimals; the query stays whole."""
    total = F.col("prompt_tokens") + F.col("completion_tokens")
    rate = F.lit(PRICE_PER_MILLION).cast("decimal(6,2)") * F.lit(EXCHANGE_RATE).cast("decimal(6,2)")
    return rows.withColumns({
        "total_tokens": total,
        "estimated_cost": F.round(total.cast("decimal(12,0)") * rate / 1000000, 6),
        "latency_ms": F.col("latency_ms").cast("decimal(18,2)")})


def touched(log: DataFrame, refs: str = "referenced_ids") -> DataFrame:
    """Which agent touched which subject, how often and with how many tokens."""
    return log.select("agent_name", F.explode(refs).alias("subject_id"), "total_tokens").groupBy(
        "agent_name", "subject_id").agg(F.count(F.lit(1)).alias("calls"), F.sum("total_tokens").alias("tokens"))


def job_costs(jobs: DataFrame, now: Column, days: int = 7) -> DataFrame:
    """Megabytes, slot seconds, latency and cost class of the jobs of the last days."""
    billed = F.coalesce("total_bytes_billed", F.lit(0))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    # The names of the cost classes.
    label = ladder([((F.col("job_type") == "LOAD") & (billed == 0), "FREE_BATCH_POOL"),
                    (F.col("total_slot_ms") > HEAVY_SLOT_MS, "HEAVY_OR_ZOMBIE_CANDIDATE")], "OPTIMIZED")
    return jobs.where(F.col("creation_time") >= now - F.expr(f"interval {int(days)} days")).select(
        "creation_time", "job_id", "user_email", "job_type", "statement_type",
        F.round(billed.cast("decimal(20,0)") / (1024 * 1024), 2).alias("billed_megabytes"),
        F.round(F.coalesce("total_slot_ms", F.lit(0)).cast("decimal(20,0)") / 1000, 2).alias("slot_seconds"),
        ((micros("end_time") - micros("start_time")) / 1000).cast("bigint").alias("latency_ms"), label.alias("finops_class"))


def cost_summary(costs: DataFrame) -> DataFrame:
    return costs.groupBy("finops_class", "job_type").agg(
        F.count(F.lit(1)).alias("jobs"), F.sum("billed_megabytes").alias("billed_mb"), F.sum("slot_seconds").alias("slot_sec"))


def recent_loads(jobs: DataFrame, now: Column, hours: int = 24, k: int = 8) -> DataFrame:
    """The latest load jobs with bytes and whole seconds."""
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    rows = jobs.where((F.col("job_type") == "LOAD") & (F.col("creation_time") >= now - F.expr(f"interval {int(hours)} hours")))
    out = rows.select("job_id", "statement_type", "creation_time", F.coalesce("total_bytes_billed", F.lit(0)).alias("bytes_billed"),
                      ((micros("end_time") - micros("start_time")) / 1000000).cast("bigint").alias("duration_seconds"))
    return top_k(out, [F.col("creation_time").desc(), F.col("job_id").asc()], k)


def spark_event_log(spark, path: str) -> DataFrame:
    """Jobs of a Spark event log (JSON lines) in the layout of ``job_costs``: one row per finished job with
    its run time as slot milliseconds."""
    schema = "Event string, `Job ID` bigint, `Submission Time` bigint, `Completion Time` bigint"
    raw = spark.read.schema(schema).json(path)
    start = raw.where(F.col("Event") == "SparkListenerJobStart").select("Job ID", "Submission Time")
    end = raw.where(F.col("Event") == "SparkListenerJobEnd").select("Job ID", "Completion Time")
    ts = lambda c: F.timestamp_millis(F.col(c)).cast("timestamp_ntz")
    return start.join(end, "Job ID").select(
        F.col("Job ID").alias("job_id"), F.lit(None).cast("string").alias("user_email"), F.lit("QUERY").alias("job_type"),
        F.lit("JOB").alias("statement_type"), F.lit(0).cast("bigint").alias("total_bytes_billed"),
        (F.col("Completion Time") - F.col("Submission Time")).alias("total_slot_ms"),
        ts("Submission Time").alias("creation_time"), ts("Submission Time").alias("start_time"),
        ts("Completion Time").alias("end_time"))
