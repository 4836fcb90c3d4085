"""Pairs inside groups, in closed form where only measures of the pairs are wanted.

A group of ``n`` members has n(n-1)/2 pairs. Counts, distinct ends and sums over those pairs follow
from sums over the members, so a group with millions of members costs one aggregation, not its square.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .windows import top_per


def pair_counts(members: DataFrame, group: Sequence[str], size: str, pairs: str) -> DataFrame:
    """Members and unordered pairs per group of two or more. ``members`` has unique rows."""
    return (members.groupBy(*group).agg(F.count(F.lit(1)).alias(size)).where(F.col(size) > 1)
            .withColumn(pairs, F.expr(f"({size} * ({size} - 1)) div 2")))


def first_pairs(members: DataFrame, group: Sequence[str], ident: str, values: Sequence[str],
                k: int) -> DataFrame:
    """The first ``k`` pairs ``left < right`` in the order (group, left, right), exactly.

    Every group of two or more gives a pair at least, so the first ``k`` such groups hold them all; and within a group
    those pairs only involve its ``k + 1`` smallest ids. Just these are kept before the self-join.
    """
    groups = members.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").orderBy(*group).limit(k).select(*group)
    rows = members.select(*group, ident, *values).join(groups, list(group), "left_semi")
    few = top_per(rows, list(group), [F.col(ident).asc()], k + 1)

    def side(n: int) -> DataFrame:
        return few.select(*group, *[F.col(c).alias(f"{c}_{n}") for c in [ident, *values]])

    both = side(1).join(side(2), list(group)).where(F.col(f"{ident}_1") < F.col(f"{ident}_2"))
    return both.orderBy(*group, f"{ident}_1", f"{ident}_2").limit(k)
