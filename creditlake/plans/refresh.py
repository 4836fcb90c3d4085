"""The medallion kept up to date from change rows: only the keys that a change reaches are computed anew.

Landed tables and products lie in folders by a hash bucket of one product key (the customer id). A change row says, through the
identity of its record, which old rows it replaces; the keys of the old and the new rows are the keys of the step's output that may
differ. A step is run on its inputs' rows of those keys alone, read from the buckets that hold them; where its output differs, the
differing rows are the changes that later steps see. Buckets without such a key keep their folders.

All new folders of a refresh become visible by one manifest, so readers see all tables before it or all after it, and a refresh that
stops anywhere is simply run again. A repeated delta changes nothing.

Disk: what only a refresh needs (landed deltas, keys, changes, shuffle files) goes as soon as it has been read. A first load is
written at once, from one shuffle on the identity; so is a later one that reaches half the buckets or more.

This holds for steps whose output rows of a key depend on input rows of that key only, which is what ``Product`` states.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import key
from ..operators.quality import assert_table
from ..session import scratch_path
from ..sources import versions
from . import marts, profile, silver
from .registry import MEDALLION, Step

KEY, BUCKET, VERSION, GONE = "product_key", "key_bucket", "change_version", "change_deleted"
LOADS = 2  # sources loaded at a time; their shuffle files lie on disk together
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Landed:
    """A bronze table: the columns that tell its records apart, and its product key. All rows of an identity come and go
    together; those of the highest version stand, and of equal versions those that came last."""

    name: str
    identity: tuple[str, ...]
    product_key: Callable[[], Column]


@dataclass(frozen=True)
class Product:
    """A step whose rows of a key depend on input rows of that key only; ``product_key`` names its column."""

    step: Step
    product_key: str = "cif_id"


SOURCES: tuple[Landed, ...] = (
    Landed("customer", ("cif_id", "rcd_dt"), lambda: key("cif_id")),
    Landed("loan_app", ("appl_no",), lambda: key("cif_no")),
    Landed("card_app", ("appl_id",), lambda: key("cif_id")),
    Landed("loan_coll", ("agree_no", "tx_dt"), lambda: key("cif_no")),
    Landed("card_coll", ("account_no", "tx_dt"), lambda: key("cif_no")),
    Landed("card", ("account_no",), lambda: key("cif_id")),
    Landed("card_sales", ("cif_no", "tx_dt", "ldesc"), lambda: key("cif_no")),
    Landed("loan_sales", ("cif_no", "tx_dt", "ldesc"), lambda: key("cif_no")),
)

def _wide(customer: DataFrame, card: DataFrame, loan_app: DataFrame, card_sales: DataFrame, loan_sales: DataFrame,
          loan_coll: DataFrame, card_coll: DataFrame) -> DataFrame:
    return profile.wide_mart(silver.newest_by_text_key(customer), card, loan_app, silver.sales(card_sales, loan_sales),
                             silver.collections(loan_coll, card_coll))


#: All steps of the medallion, the underwriting funnel and the wide mart. The risk mart looks cards up by account, not by customer,
#: so a change of a card may reach rows of another key; it is built whole.
PRODUCTS: tuple[Product, ...] = (
    *[Product(s) for s in MEDALLION],
    Product(Step("gold_funnel", "gold", ("loan_app", "card_app"), marts.underwriting_funnel, non_null=("cif_id",))),
    Product(Step("gold_wide", "gold", ("customer", "card", "loan_app", "card_sales", "loan_sales", "loan_coll", "card_coll"), _wide, unique=("cif_id",))),
)


@dataclass
class _Refresh:
    spark: SparkSession
    root: str
    buckets: int
    parts: dict[str, str]
    changes: dict[str, DataFrame] = field(default_factory=dict)
    temporary: list[str] = field(default_factory=list)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(KEY)), F.lit(self.buckets)).cast("int")

    def rows(self, table: str, numbers: Sequence[int] | None = None) -> DataFrame | None:
        """Rows of these buckets of a table, or of all; None before its first rows."""
        names = None if numbers is None else {f"{table}/{b}" for b in (*numbers, "columns")}
        return _read(self.spark, self.root, [f for p, f in self.parts.items() if p.rpartition("/")[0] == table and (names is None or p in names)])

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        self.temporary.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def put(self, table: str, rows: DataFrame, numbers: Sequence[int]) -> str:
        """New folders for these buckets of a table, and the folder they lie in."""
        folder = f"{table}/{versions.new_folder()}"
        if f"{table}/columns" not in self.parts:  # an empty file, for tables and buckets without rows
            rows.limit(0).write.parquet(f"{self.root}/{folder}-columns")
            self.parts[f"{table}/columns"] = f"{folder}-columns"
        out = rows.withColumn(BUCKET, self.bucket())
        if 2 * len(numbers) < self.buckets:  # few rows, so few files; else each task writes its rows, unmoved
            out = out.hint("rebalance", BUCKET)
        out.write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        there = versions.subfolders(self.spark, f"{self.root}/{folder}")
        for b in numbers:
            self.parts.pop(f"{table}/{b}", None)
            if f"{BUCKET}={b}" in there:
                self.parts[f"{table}/{b}"] = f"{folder}/{BUCKET}={b}"
        return f"{self.root}/{folder}"

    def forget(self, name: str = "") -> None:
        """Remove temporary tables of this name, or all."""
        for path in [p for p in self.temporary if name in p]:
            versions.remove(self.spark, path)
            self.temporary.remove(path)

    def note(self, table: str, before: DataFrame | None, after: DataFrame) -> None:
        """The keys whose rows differ, if any, are the table's changes: by count and order-free sums of row hashes, so one short
        row per key and task is shuffled, not the rows. ``after`` is written in its place."""
        differ = after.select(KEY)
        if before is not None:
            marks = _marks(after).unionByName(_marks(before.select(*after.columns), -1))
            sums = [c for c in marks.columns if c != KEY]
            totals = marks.groupBy(KEY).agg(*[F.sum(c).alias(c) for c in sums])
            differ = self.stored(totals.where(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in sums])).select(KEY), "changes")
        if not differ.isEmpty():
            self.changes[table] = differ


def _marks(df: DataFrame, sign: int = 1) -> DataFrame:
    """Rows per key and the sums of two hashes of them, in halves that do not overflow."""
    # hashes pass over nulls, so where they are is hashed as well
    every = [F.col(f"`{c}`") for c in df.columns] + [F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in df.columns])]
    sums = {"n": F.lit(1).cast("long")}
    for name, value in (("h", F.xxhash64(*every)), ("g", F.xxhash64(F.lit(1), *every))):
        sums[f"{name}1"], sums[f"{name}2"] = F.shiftright(value, 32), value.bitwiseAND(F.lit(0xFFFFFFFF))
    return df.groupBy(KEY).agg(*[(F.sum(v) * sign).alias(f"__{c}") for c, v in sums.items()])


def _read(spark: SparkSession, root: str, folders: Sequence[str]) -> DataFrame | None:
    return spark.read.parquet(*[f"{root}/{f}" for f in sorted(folders)]) if folders else None


def _numbers(df: DataFrame, bucket: Column) -> list[int]:
    """Buckets of the keys: at most as many as there are buckets."""
    return [r[0] for r in df.select(bucket.alias("b")).distinct().collect()]


def _same(columns: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def _land(job: _Refresh, table: Landed, delta: DataFrame) -> None:
    marks = {c: d for c, d in ((VERSION, F.lit(0)), (GONE, F.lit(False))) if c not in delta.columns}
    new = delta.withColumns(marks).withColumns({VERSION: F.col(VERSION).cast("long"), KEY: table.product_key()})
    old, numbers = None, range(job.buckets)
    if job.rows(table.name) is not None:
        new = job.stored(new, f"delta-{table.name}")
        numbers = _numbers(new, job.bucket())
        # buckets of the keys that the records had before, unless they are among these
        rest = [b for b in range(job.buckets) if b not in numbers and f"{table.name}/{b}" in job.parts]
        if rest:
            ids = new.select(*table.identity).distinct()
            numbers += _numbers(job.rows(table.name, rest).alias("o").join(ids.alias("i"), _same(table.identity, "o", "i"), "left_semi"), job.bucket())
        old = job.rows(table.name, numbers)
    come = new.withColumn("__last", F.lit(1))
    if old is not None:
        come = old.select(*new.columns).withColumn("__last", F.lit(0)).unionByName(come)
    newest = Window.partitionBy(*table.identity).orderBy(F.col(VERSION).desc(), F.col("__last").desc())
    kept = come.withColumn("__rank", F.rank().over(newest)).where("__rank = 1").drop("__rank", "__last")
    job.put(table.name, kept, numbers)
    now = job.rows(table.name, numbers)
    live = lambda df: df.where(~F.col(GONE)).drop(VERSION, GONE)
    job.note(table.name, None if old is None else live(old), live(now))
    job.forget(f"creditlake-delta-{table.name}-")


def _step(job: _Refresh, product: Product, landed: set[str]) -> None:
    step = product.step
    moved = [job.changes[i].select(KEY) for i in step.inputs if i in job.changes]
    if not moved:
        return
    first = job.rows(step.name) is None  # then all rows of all inputs are its rows
    numbers = range(job.buckets)
    if not first:
        keys = job.stored(reduce(DataFrame.unionByName, moved).distinct(), "keys")
        numbers = _numbers(keys, job.bucket())

    def affected(table: str) -> DataFrame:
        rows = job.rows(table, numbers)
        if rows is None:
            raise ValueError(f"{step.name}: {table} has never been loaded")
        if table in landed:
            rows = rows.where(~F.col(GONE)).drop(VERSION, GONE)
        return (rows if first else rows.alias("r").join(keys.alias("k"), _same([KEY], "r", "k"), "left_semi")).drop(KEY)

    new = step.build(*[affected(i) for i in step.inputs])
    new = new.withColumn(KEY, F.col(product.product_key))
    before = None if first else job.rows(step.name, numbers)
    after = new
    if before is not None:
        rest = before.alias("b").join(keys.alias("k"), _same([KEY], "b", "k"), "left_anti")
        after = rest.select(*new.columns).unionByName(new)
    parts = dict(job.parts)
    folder = job.put(step.name, after, numbers)
    now = job.rows(step.name, numbers)
    if step.non_null or step.unique:
        assert_table(now, step.non_null, step.unique)
    job.note(step.name, before, now)
    if step.name not in job.changes and before is not None:
        job.parts = parts
        versions.remove(job.spark, folder)


def refresh(spark: SparkSession, root: str, deltas: Mapping[str, DataFrame], sources: Sequence[Landed] = SOURCES,
            products: Sequence[Product] = PRODUCTS, buckets: int = 64) -> dict[str, int]:
    """Take in change rows and bring all products up to date; how many buckets of each table were written.

    A delta has the source's columns and may have ``change_version`` (a late row of a lower version changes nothing) and
    ``change_deleted``. The first refresh builds everything; all sources have to be in it, those without rows as an empty table.
    """
    parts = versions.current(spark, root)
    job = _Refresh(spark, root, buckets, dict(parts))
    known = {s.name: s for s in sources}
    if unknown := sorted(set(deltas) - set(known)):
        raise ValueError(f"no source {unknown}")
    setting = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        with ThreadPoolExecutor(LOADS) as pool:  # of different tables, so one need not wait for another's last task
            for landing in [pool.submit(_land, job, known[name], delta) for name, delta in deltas.items()]:
                landing.result()
        for product in products:
            _step(job, product, set(known))
    finally:
        spark.conf.unset(CLEANUP) if setting is None else spark.conf.set(CLEANUP, setting)
        job.forget()
    written = [p.rpartition("/")[0] for p in {*parts, *job.parts} if parts.get(p) != job.parts.get(p)]
    if written:
        versions.publish(spark, root, job.parts)
    return {t: written.count(t) for t in sorted(set(written))}


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A product as published last."""
    folders = [f for p, f in versions.current(spark, root).items() if p.rpartition("/")[0] == table]
    rows = _read(spark, root, folders)
    if rows is None:
        raise ValueError(f"no rows of {table} below {root}")
    return rows.drop(KEY)
