"""Keyword and vector search."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import top_per


def keyword_search(df: DataFrame, phrase: str, columns: Sequence[str], ident: str, k: int = 4) -> DataFrame:
    """Rows whose text holds the phrase without case, the first ``k`` by id. The phrase is plain text:
    percent and underscore have no meaning."""
    needle = F.lower(F.lit(phrase))
    hit = F.lower(F.col(columns[0])).contains(needle)
    for c in columns[1:]:
        hit = hit | F.lower(F.col(c)).contains(needle)
    return df.where(hit).orderBy(ident).limit(k)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(_dot(a, b), F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b)))


def centroid(df: DataFrame, vector: str) -> DataFrame:
    """One row with the mean vector, from per-position averages."""
    per = df.select(F.posexplode(vector).alias("i", "v")).groupBy("i").agg(F.avg("v").alias("v"))
    items = F.array_sort(F.collect_list(F.struct("i", "v")))  # one entry per dimension
    return per.agg(F.transform(items, lambda s: s["v"]).alias("centroid"))


def nearest(df: DataFrame, vector: str, ident: str, queries: Sequence[Column], k: int = 5) -> DataFrame:
    """The ``k`` most similar rows per query vector.

    The queries are the caller's own few vectors (literals or scalar subqueries). They are unfolded inside
    the projection, the table is read once, and every task keeps ``k`` rows per query before the shuffle.
    """
    asked = F.array(*[F.struct(F.lit(i).alias("query_id"), q.alias("v")) for i, q in enumerate(queries)])
    rows = df.select(F.col(ident), F.col(vector).alias("__v"), F.inline(asked))
    scored = rows.select("query_id", ident, F.round(cosine(F.col("__v"), F.col("v")), 6).alias("similarity"))
    return top_per(scored, ["query_id"], [F.col("similarity").desc(), F.col(ident).asc()], k)
