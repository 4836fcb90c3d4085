"""Daily forecasts per series."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def daily_series(df: DataFrame, date, ids: list[str], amount: str, value: str = "value") -> DataFrame:
    """Exact daily sums per series; rows without a date are left out."""
    rows = df.withColumn("ds", date).where(F.col("ds").isNotNull())
    return rows.groupBy(*ids, "ds").agg(F.round(F.sum(F.col(amount).cast("decimal(28,9)")), 2).alias(value))


def forecast(daily: DataFrame, ids: list[str], horizon: int = 30, level: float = 0.95, date: str = "ds",
             value: str = "value") -> DataFrame:
    """Linear trend plus day-of-week effect with a normal interval from the residual deviation.

    Everything is one shuffle on the series id: after daily aggregation a series has one row per calendar
    day, however many transactions it holds.
    """
    z = round(NormalDist().inv_cdf((1 + level) / 2), 6)
    w, by_dow = Window.partitionBy(*ids), Window.partitionBy(*ids, "dow")
    y, x = F.col("y"), F.col("x")
    rows = (daily.select(*ids, F.col(date).alias("ds"), F.col(value).cast("double").alias("y"))
            .withColumn("first", F.min("ds").over(w)).withColumn("last", F.max("ds").over(w))
            .withColumn("x", F.datediff("ds", "first").cast("double")).withColumn("dow", F.dayofweek("ds"))
            .withColumn("slope", F.coalesce(F.regr_slope("y", "x").over(w), F.lit(0.0)))
            .withColumn("level0", F.avg("y").over(w) - F.col("slope") * F.avg("x").over(w))
            .withColumn("r", y - F.col("level0") - F.col("slope") * x)
            .withColumn("season", F.avg("r").over(by_dow))
            .withColumn("sd", F.coalesce(F.stddev_samp(F.col("r") - F.col("season")).over(w), F.lit(0.0))))
    keys = [*ids, "first", "last", "slope", "level0", "sd"]
    # At most seven entries per series.
    seasons = rows.select(*keys, "dow", "season").groupBy(*keys, "dow").agg(F.min("season").alias("season")).groupBy(
        *keys).agg(F.map_from_entries(F.collect_list(F.struct("dow", "season"))).alias("seasons"))
    out = seasons.withColumn("h", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn(
        "forecast_date", F.date_add("last", F.col("h")))
    point = (F.col("level0") + F.col("slope") * F.datediff("forecast_date", "first")
             + F.coalesce(F.try_element_at("seasons", F.dayofweek("forecast_date")), F.lit(0.0)))
    money = lambda c: c.cast("decimal(18,2)")
    return out.select(*ids, "forecast_date", money(point).alias("forecast_value"),
                      money(point - z * F.col("sd")).alias("lower_bound"),
                      money(point + z * F.col("sd")).alias("upper_bound"), F.lit(level).alias("confidence_level"))


def repeat_last(daily: DataFrame, ids: list[str], days: int = 7, date: str = "ds") -> DataFrame:
    """The last rows of each series, moved on by as many days."""
    w = Window.partitionBy(*ids).orderBy(F.col(date).desc())
    last = daily.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= days).drop("__rn")
    return last.withColumn(date, F.date_add(date, days))
