"""Grouping where a measure is a maximum over text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sums_and_greatest(df: DataFrame, keys: Sequence[str], texts: Sequence[str], sums: dict[str, Column],
                      dealt_by: Sequence[str] | None = None) -> DataFrame:
    """Sums and greatest texts per key.

    Spark sorts what it takes a maximum over text of, in map tasks every row. Here rows are dealt out by ``dealt_by`` (some of the
    keys; all, if not given) and hashed by keys and texts, and only the few rows left of a key are sorted. The result is still
    dealt out by those columns, so a join on them moves none of it.
    """
    rows = df.select(*keys, *texts, *[c.alias(n) for n, c in sums.items()]).repartition(*(dealt_by or keys))
    few = rows.groupBy(*keys, *texts).agg(*[F.sum(n).alias(n) for n in sums])
    return few.groupBy(*keys).agg(*[F.max(t).alias(t) for t in texts], *[F.sum(n).alias(n) for n in sums])
