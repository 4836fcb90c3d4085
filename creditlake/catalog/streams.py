"""Incremental and streaming queries. Each drains its input and returns the table it keeps."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import incremental as inc
from ..streaming import jobs
from .base import query


def _split_files(t, df, order, name, n=4):
    """The rows as ``n`` files in time order: the arrivals of a stream."""
    path = scratch_path(t.spark, name)
    df.repartitionByRange(n, order).write.parquet(path)
    return path


def _drain(q):
    q.awaitTermination()


@query("st_01_incremental_load", "SELECT o_orderkey, o_orderdate FROM orders")
def st_01(t):
    path = scratch_path(t.spark, "increment")
    rows = t.orders.select("o_orderkey", "o_orderdate")
    for part in (rows.where(F.year("o_orderdate") < 1998), rows, rows):
        inc.load_increment(t.spark, part, path, "o_orderdate", ["o_orderkey"])
    return t.spark.read.parquet(path)


@query("st_01c_late_rows", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate END AS o_orderdate FROM orders")
def st_01c(t):
    """Rows that come later with the newest date, an older date within the lookback, or no date, equal one full load."""
    path = scratch_path(t.spark, "increment")
    rows = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate")).alias("o_orderdate"))
    newest = rows.select(F.date_sub(F.max("o_orderdate"), 30)).scalar()
    late = (F.col("o_orderkey") % 3 == 0) & (F.col("o_orderdate").isNull() | (F.col("o_orderdate") >= newest))
    for part in (rows.where(~late), rows, rows):
        inc.load_increment(t.spark, part, path, "o_orderdate", ["o_orderkey"], lookback_days=30)
    return t.spark.read.parquet(path)


@query("st_01b_incremental_stream", "SELECT event_id, user_id FROM events")
def st_01b(t):
    """The same by file: the checkpoint remembers which files are done."""
    src = _split_files(t, t.events, "ts", "events")
    out, cp = scratch_path(t.spark, "loaded"), scratch_path(t.spark, "cp")
    schema = t.events.schema
    for _ in range(2):
        _drain(jobs.ingest(jobs.file_stream(t.spark, src, schema, per_batch=2), out, cp))
    return t.spark.read.parquet(out).select("event_id", "user_id")


@query("st_02_latest_upsert", "SELECT cif_id, rcd_dt, net_income FROM newest_customer")
def st_02(t):
    path = scratch_path(t.spark, "upsert")
    rows = t.f("customer").select("cif_id", "rcd_dt", "net_income")
    new = F.col("rcd_dt") == F.to_date(F.lit("2024-01-02"))
    for batch in (rows.where(~new), rows.where(new), rows.where(~new)):
        inc.upsert(t.spark, path, batch, ["cif_id"], "rcd_dt", ["net_income"], buckets=8)
    return inc.read_upserted(t.spark, path)


@query("st_03_change_capture", """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def st_03(t):
    src = _split_files(t, t.events, "ts", "events")
    out, cp = scratch_path(t.spark, "current"), scratch_path(t.spark, "cp")
    stream = jobs.file_stream(t.spark, src, t.events.schema, per_batch=2).select("user_id", "event_id", "event_type", "ts")
    _drain(jobs.apply_changes(stream, out, cp, ["user_id"], "ts", ["event_id"]))
    return inc.read_upserted(t.spark, out).select("user_id", "event_id", "event_type")


@query("st_03b_changes_with_deletes", """
SELECT user_id, event_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_id % 3 <> 0""")
def st_03b(t):
    """Files in no order; a user whose newest change is a deletion stays deleted when older changes come later."""
    src, out, cp = (scratch_path(t.spark, n) for n in ("changes", "current", "cp"))
    rows = t.events.select("user_id", "event_id", "event_type", "ts", (F.col("event_id") % 3 == 0).alias("gone"))
    rows.repartition(4, "event_id").write.parquet(src)
    _drain(jobs.apply_changes(jobs.file_stream(t.spark, src, rows.schema, per_batch=2), out, cp, ["user_id"], "ts", ["event_id"], buckets=16))
    return inc.read_upserted(t.spark, out, deleted="gone").select("user_id", "event_id", "event_type")


@query("st_04_telemetry_append", "SELECT conv_id, turn, role, DATE '2024-01-01' + (conv_id % 28)::int AS log_date FROM conversations")
def st_04(t):
    src, out = scratch_path(t.spark, "telemetry-in"), scratch_path(t.spark, "telemetry")
    rows = t.conversations.select("conv_id", "turn", "role",
                                  F.expr("timestamp_ntz'2024-01-01 12:00:00' + make_dt_interval(int(conv_id % 28))").alias("logged_at"))
    rows.write.json(src)
    stream = jobs.file_stream(t.spark, src, rows.schema, fmt="json")
    _drain(jobs.append_telemetry(stream, out, scratch_path(t.spark, "cp"), "logged_at"))
    return t.spark.read.parquet(out).select("conv_id", "turn", "role", "log_date")


@query("st_05_daily_series", """
SELECT ts::date AS day, event_type, sum(value::decimal(18,2))::double AS total FROM events GROUP BY 1, 2""")
def st_05(t):
    src = _split_files(t, t.events, "ts", "events")
    out, cp = scratch_path(t.spark, "daily"), scratch_path(t.spark, "cp")
    stream = jobs.file_stream(t.spark, src, t.events.schema, per_batch=2)
    jobs.publish_daily_series(jobs.daily_series(stream, out, cp, "ts", "event_type", "value"), t.spark, out)
    return jobs.read_daily_series(t.spark, out, "event_type")


@query("st_05b_daily_series_out_of_order", """
SELECT ts::date AS day, event_type, sum(value::decimal(18,2))::double AS total FROM events GROUP BY 1, 2""")
def st_05b(t):
    """Newest files first: every other row is late by days, and none is lost."""
    src, out, cp = scratch_path(t.spark, "events"), scratch_path(t.spark, "daily"), scratch_path(t.spark, "cp")
    rows = t.events.select("ts", "event_type", "value")
    middle = rows.select(F.percentile_approx(F.col("ts").cast("timestamp").cast("double"), 0.5)).scalar()
    newer = F.col("ts").cast("timestamp").cast("double") >= middle
    for part in (rows.where(newer), rows.where(~newer)):
        part.write.mode("append").parquet(src)
        jobs.publish_daily_series(jobs.daily_series(jobs.file_stream(t.spark, src, rows.schema), out, cp, "ts", "event_type", "value"), t.spark, out)
    return jobs.read_daily_series(t.spark, out, "event_type")


@query("st_05c_daily_series_restarted", """
SELECT ts::date AS day, event_type, sum(value::decimal(18,2))::double AS total FROM events GROUP BY 1, 2""")
def st_05c(t):
    """After a full run, one on a new checkpoint has got as far as its first file: the series is still whole."""
    rows = t.events.select("ts", "event_type", "value")
    src, out = _split_files(t, rows, "ts", "events"), scratch_path(t.spark, "daily")
    run = lambda **only: jobs.daily_series(jobs.file_stream(t.spark, src, rows.schema, per_batch=1, **only), out, scratch_path(t.spark, "cp"), "ts", "event_type", "value")
    jobs.publish_daily_series(run(), t.spark, out)
    _drain(run(pattern="part-00000*"))
    return jobs.read_daily_series(t.spark, out, "event_type")
