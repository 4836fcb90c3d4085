"""Deduplication and whole-set totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows per key.

    ``order`` has to be total. Spark cuts every task to ``n`` rows per key before the shuffle
    (window group limit), so a hot key costs no more than a cold one.
    """
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    w = Window.partitionBy(*cols).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def latest_per(df: DataFrame, keys: Sequence[str], newest: str | Sequence[str],
               ties: Sequence[str] = ()) -> DataFrame:
    """The newest record per key; ``ties`` make the choice unique."""
    by = [newest] if isinstance(newest, str) else list(newest)
    order = [F.col(c).desc_nulls_last() for c in by] + [F.col(c).desc_nulls_last() for c in ties]
    return top_per(df, keys, order, 1)


def with_totals(df: DataFrame, **totals: Column) -> DataFrame:
    """Whole-set aggregates on every row.

    A window without partition would pull all rows into one task and does not take distinct counts;
    a scalar subquery aggregates in parallel and gives one literal.
    """
    out = df
    for name, agg in totals.items():
        out = out.withColumn(name, df.select(agg.alias("v")).scalar())
    return out
