"""Incremental loads and keyed upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import latest_per
from ..sources import versions

BUCKET = "key_bucket"


def incremental(source: DataFrame, target: DataFrame, date_col: str, key: Sequence[str], lookback_days: int = 0) -> DataFrame:
    """Source rows that the target lacks, by ``key``, among those from the target's newest date on (less the lookback)
    and those without a date; all rows for an empty target.

    The limit is a scalar subquery, so it prunes both scans: only the target's rows from that date on, and its undated
    ones, take part in the anti-join.
    """
    since = target.select(F.date_sub(F.max(date_col), lookback_days)).scalar()
    late = lambda: since.isNull() | F.col(date_col).isNull() | (F.col(date_col) >= since)
    have = target.where(late()).select(*key).distinct()
    fresh = source.where(late()).alias("s")
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"h.{k}")) for k in key]
    return fresh.join(have.alias("h"), same, "left_anti")


def load_increment(spark: SparkSession, source: DataFrame, path: str, date_col: str, key: Sequence[str], lookback_days: int = 0) -> None:
    """Append the increment to the table at ``path``; the first load takes everything."""
    try:
        target = spark.read.schema(source.schema).parquet(path)
        rows = incremental(source, target, date_col, key, lookback_days)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = source
    rows.write.mode("append").parquet(path)


def bucketed(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in key]), F.lit(buckets)).cast("int"))


def upsert(spark: SparkSession, path: str, batch: DataFrame, key: Sequence[str], newest: str | Sequence[str],
           ties: Sequence[str] = (), buckets: int = 64) -> None:
    """Keep the newest record per key after a batch.

    The table is dealt out by a hash bucket of the key. Only buckets that the batch touches are read and written anew, into
    a folder of their own, so cost follows the batch, not the table. One manifest file then publishes the new buckets;
    a writer that stops before leaves the table as it was. Applying a batch twice changes nothing.
    """
    rows = bucketed(batch, key, buckets)
    # At most ``buckets`` numbers.
    touched = [r[0] for r in rows.select(BUCKET).distinct().collect()]
    if not touched:
        return
    parts = versions.current(spark, path)
    if old := [parts[str(b)] for b in touched if str(b) in parts]:
        rows = _read(spark, path, old).select(*rows.columns).unionByName(rows)
    kept = latest_per(rows, [*key, BUCKET], newest, ties)
    folder = versions.new_folder()
    kept.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
    versions.publish(spark, path, parts | {str(b): f"{folder}/{BUCKET}={b}" for b in touched})


def _read(spark: SparkSession, path: str, folders: Sequence[str]) -> DataFrame:
    names = sorted(folders)
    parts = [spark.read.parquet(f"{path}/{f}").withColumn(BUCKET, F.lit(int(f.rpartition("=")[2]))) for f in names]
    return reduce(DataFrame.unionByName, parts)


def read_upserted(spark: SparkSession, path: str, deleted: str | None = None) -> DataFrame:
    """The published records. ``deleted`` names a boolean column of tombstones: a key whose newest record is one is left out,
    and an older record that comes later does not bring it back."""
    rows = _read(spark, path, list(versions.current(spark, path).values())).drop(BUCKET)
    return rows.where(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted) if deleted else rows
