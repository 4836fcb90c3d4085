"""Profiles that add up: sketches of every column by part of a table, united for the whole.

A part (a day, a bucket) is read once, when it is new or has changed; the table's profile comes from the stored rows of its parts, a
row per part and column. Distinct counts are HyperLogLog sketches of 2 ** ``LOG_K`` registers, quantiles KLL sketches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Relative standard error of distinct counts: about 0.83 / 2 ** (LOG_K / 2), 0.7 percent; ranks of quantiles: about 1.3 percent.
LOG_K, KLL_K = 14, 200
SCALARS = (T.NumericType, T.StringType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def column_sketches(df: DataFrame, part: str | Column | None = None) -> DataFrame:
    """part, column_name, row_count, filled, distinct_sketch, quantile_sketch (numbers only), min_value and max_value (numbers as
    numbers, texts as text), of all columns in one aggregation by part. A null part is a part of its own."""
    fields = [f for f in df.schema.fields if isinstance(f.dataType, SCALARS)]
    by = (F.lit("all") if part is None else F.col(part) if isinstance(part, str) else part).cast("string").alias("part")
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        number = isinstance(f.dataType, T.NumericType)
        hashed = c.cast("string") if not isinstance(f.dataType, (T.IntegerType, T.LongType, T.StringType)) else c
        real = c.cast("double")
        aggs += [F.count(c).alias(f"__c{i}"), F.hll_sketch_agg(hashed, LOG_K).alias(f"__d{i}"),
                 (F.kll_sketch_agg_double(F.when(~F.isnan(real), real), KLL_K) if number else F.lit(None).cast("binary")).alias(f"__q{i}"),
                 *[F.struct((g(real) if number else F.lit(None).cast("double")).alias("number"),
                            (F.lit(None).cast("string") if number else g(c.cast("string"))).alias("text")).alias(f"__{n}{i}") for n, g in (("lo", F.min), ("hi", F.max))]]
    rows = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col("__n").alias("row_count"), F.col(f"__c{i}").alias("filled"), F.col(f"__d{i}").alias("distinct_sketch"),
                              F.col(f"__q{i}").alias("quantile_sketch"), F.col(f"__lo{i}").alias("min_value"), F.col(f"__hi{i}").alias("max_value")) for i, f in enumerate(fields)])
    return df.groupBy(by).agg(*aggs).select("part", F.inline(rows))


def merged_profile(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row per column over all parts: exact counts, null share and extremes; estimated distinct values and quantiles."""
    n, filled = F.sum("row_count"), F.sum("filled")
    both = sketches.groupBy("column_name").agg(
        n.alias("row_count"), filled.alias("filled"), F.round((n - filled).cast("decimal(20,0)") * 100 / F.nullif(n, F.lit(0)), 2).alias("null_pct"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_estimate"), F.kll_merge_agg_double("quantile_sketch").alias("q"),
        F.min("min_value.number").alias("min_number"), F.max("max_value.number").alias("max_number"), F.min("min_value.text").alias("min_text"), F.max("max_value.text").alias("max_text"))
    known = F.col("min_number").isNotNull() & ~F.isnan("min_number")
    return both.select("column_name", "row_count", "filled", "null_pct", "distinct_estimate", "min_number", "max_number", "min_text", "max_text",
                       *[F.when(known, F.kll_sketch_get_quantile_double("q", F.lit(float(p)))).alias(f"q{round(p * 100):02d}") for p in quantiles])
