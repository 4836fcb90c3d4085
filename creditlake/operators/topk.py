"""Ordered limits and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Ordered limit; each task keeps ``k`` rows, no full sort. ``order`` should be total."""
    return df.orderBy(*order).limit(k)


def hash_sample(df: DataFrame, key: str, n: int) -> DataFrame:
    """``n`` rows in the order of the MD5 of a unique key: the same rows on every run and layout."""
    return (df.withColumn("__h", F.md5(F.col(key).cast("string").cast("binary")))
            .orderBy("__h", key).limit(n).drop("__h"))
