"""Join shapes that need more than one plain equi-join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_any_of(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Inner join on ``l1 = r1 or l2 = r2 or ..``, every matching pair once.

    A disjunction plans as a nested loop; here each pair is an equi-join of its own, and a later one
    leaves out what an earlier one already matched. Where all keys have one type, the pairs are one join on
    (number of the pair, key), so that either side is computed once. Column names of the two sides must differ.
    """
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"rename columns on both sides: {sorted(shared)}")

    def unmatched(i: int) -> list[Column]:
        return [~F.coalesce(F.col(lc) == F.col(rc), F.lit(False)) for lc, rc in pairs[:i]]

    if len({df.schema[c].dataType for p in pairs for df, c in zip((left, right), p, strict=True)}) == 1:
        l = left.select("*", F.posexplode(F.array(*[lc for lc, _ in pairs])).alias("__pair_l", "__key_l")).where("__key_l is not null")
        r = right.select("*", F.posexplode(F.array(*[rc for _, rc in pairs])).alias("__pair_r", "__key_r")).where("__key_r is not null")
        cond = (F.col("__pair_l") == F.col("__pair_r")) & (F.col("__key_l") == F.col("__key_r"))
        for i, first in enumerate(unmatched(len(pairs) - 1)):
            cond = cond & ((F.col("__pair_l") <= i) | first)
        return l.join(r, cond).drop("__pair_l", "__key_l", "__pair_r", "__key_r")
    legs = []
    for i, (lc, rc) in enumerate(pairs):
        legs.append(left.join(right, reduce(Column.__and__, unmatched(i), F.col(lc) == F.col(rc)), "inner"))
    return reduce(DataFrame.unionByName, legs)


def star(base: DataFrame, *facts: DataFrame, on: str | list[str]) -> DataFrame:
    """Left star join of facts that have one row per key; all sides share one partitioning."""
    return reduce(lambda acc, fact: acc.join(fact, on, "left"), facts, base)


def full_on(left: DataFrame, right: DataFrame, on: str | list[str]) -> DataFrame:
    """Full outer join with the key taken from whichever side has it."""
    return left.join(right, on, "full")


def keep_known(edges: DataFrame, nodes: DataFrame, edge_key: str, node_key: str) -> DataFrame:
    """Rows whose key exists on the other side; never multiplies rows."""
    keys = nodes.select(F.col(node_key).alias("__key"))
    return edges.join(keys, F.col(edge_key) == F.col("__key"), "left_semi")


def orphans(edges: DataFrame, nodes: DataFrame, edge_key: str, node_key: str) -> DataFrame:
    """Rows whose key is missing on the other side."""
    keys = nodes.select(F.col(node_key).alias("__key"))
    return edges.join(keys, F.col(edge_key) == F.col("__key"), "left_anti")


def join_folded(left: DataFrame, right: DataFrame, left_col: str, right_col: str,
                how: str = "inner") -> DataFrame:
    """Join on upper-cased trimmed text, folded once per side."""
    l = left.withColumn("__fold_l", F.upper(F.trim(F.col(left_col))))
    r = right.withColumn("__fold_r", F.upper(F.trim(F.col(right_col))))
    return l.join(r, F.col("__fold_l") == F.col("__fold_r"), how).drop("__fold_l", "__fold_r")


def at_latest(df: DataFrame, date_col: str) -> DataFrame:
    """Rows at the newest date, which is a scalar subquery and so a filter the scan can use."""
    newest = df.select(F.max(date_col)).scalar()
    return df.where(F.col(date_col) == newest)


def explode_wide(df: DataFrame, keep: Sequence[str], values: Sequence[str], name: str,
                 value: str) -> DataFrame:
    """Wide to long: one row per value column."""
    return df.unpivot(list(keep), list(values), name, value)
