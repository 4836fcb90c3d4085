"""Unions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(frames: Sequence[DataFrame], missing: bool = False) -> DataFrame:
    """Union by name; ``missing`` fills absent columns with null (schema evolution)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), frames)


def tagged_union(frames: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """Union of the frames with their label in column ``tag``; absent columns become null."""
    return union_all([df.withColumn(tag, F.lit(label)) for label, df in frames.items()], missing=True)


def labelled_counts(frames: Mapping[str, DataFrame], label: str = "label") -> DataFrame:
    """One row per frame with its row count."""
    return union_all([
        df.select(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias(label), "row_count")
        for name, df in frames.items()])
