"""Bounded text lists per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import top_per


def top_list(df: DataFrame, keys: Sequence[str], text: Column, order: Sequence[Column], n: int,
             name: str, sep: str = ", ", distinct: bool = False) -> DataFrame:
    """Per key, the first ``n`` texts in order joined to one string.

    Only ``n`` rows per key are ever collected, whatever the size of the group.
    """
    rows = df.select(*keys, text.alias("__t"), *[o.alias(f"__o{i}") for i, o in enumerate(order)])
    rows = rows.where(F.col("__t").isNotNull())
    if distinct:
        rows = rows.groupBy(*keys, "__t").agg(
            *[F.min(f"__o{i}").alias(f"__o{i}") for i in range(len(order))])
    by = [f"__o{i}" for i in range(len(order))] + ["__t"]
    kept = top_per(rows, keys, [F.col(c).asc() for c in by], n)
    items = F.array_sort(F.collect_list(F.struct(*by)))
    return kept.groupBy(*keys).agg(
        F.array_join(F.transform(items, lambda s: s["__t"]), sep).alias(name))
