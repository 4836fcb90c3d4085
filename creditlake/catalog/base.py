"""Registration of queries and composition of their check SQL."""

from __future__ import annotations

import re
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..fixtures import FIXTURES, Tables, duckdb_sql
from ..session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
PARTS: dict[str, str] = {name: duckdb_sql(name) for name in FIXTURES}


_STORED: dict[tuple[str, str, str], str] = {}
_LOCK = threading.RLock()  # building one mart may store another


def stored_path(t: Tables, name: str, build: Callable[[str], None]) -> str:
    """A folder that ``build`` fills on first use in a session."""
    key = (t.spark.sparkContext.applicationId, t.root, name)
    with _LOCK:
        if key not in _STORED:
            path = scratch_path(t.spark, name)
            build(path)
            _STORED[key] = path
    return _STORED[key]


def stored(t: Tables, name: str, build: Callable[[Tables], DataFrame]) -> DataFrame:
    """A mart that later queries read as a table: built and written on first use in a session."""
    return t.spark.read.parquet(stored_path(t, name, lambda path: build(t).write.parquet(path)))


def is_stored(t: Tables, name: str) -> bool:
    return (t.spark.sparkContext.applicationId, t.root, name) in _STORED


def part(name: str, sql: str) -> None:
    """A named relation that check SQL may refer to."""
    PARTS[name] = sql.strip()


def compose(sql: str) -> str:
    """Prefix the named relations that ``sql`` uses, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(re.findall(r"[a-z_][a-z_0-9]*", text)):
            if name in PARTS and name not in order:
                visit(PARTS[name])
                order.append(name)

    visit(sql)
    if not order:
        return sql.strip()
    head = "WITH " + ",\n".join(f"{n} AS ({PARTS[n]})" for n in order)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the one type both engines report alike."""
    return df.select(*[
        F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else F.col(f"`{f.name}`") for f in df.schema.fields
    ])


def query(name: str, oracle: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(Tables(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register
