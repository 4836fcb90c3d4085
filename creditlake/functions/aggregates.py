"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import MONEY, col, money


def sum_money(c: str | Column) -> Column:
    """Exact sum of amounts, rounded to two decimals after the sum."""
    return F.round(F.sum(money(c)), 2)


def sum_money_or_zero(c: str | Column) -> Column:
    return F.round(F.sum(F.coalesce(money(c), F.lit(0).cast(MONEY))), 2)


def avg_money(c: str | Column, digits: int = 2) -> Column:
    return F.round(F.avg(money(c)), digits)


def sum_if(cond: Column, c: str | Column) -> Column:
    """Sum over the rows that satisfy the condition, zero for the others."""
    return F.round(F.sum(F.when(cond, money(c)).otherwise(F.lit(0).cast(MONEY))), 2)


def count_or_one(c: str | Column) -> Column:
    """Transactions where a missing count stands for one."""
    return F.sum(F.coalesce(col(c).cast("bigint"), F.lit(1)))

