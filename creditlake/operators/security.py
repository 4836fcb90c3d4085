"""Row policies, column tags and masks, clean-room aggregation, erasure."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versions
from .sets import union_all

TAG = "tag"


@dataclass(frozen=True)
class RowPolicy:
    """Principals in ``grants`` see the rows of ``condition`` (SQL over the table's columns)."""

    name: str
    grants: frozenset[str]
    condition: str = "true"


def secure_rows(df: DataFrame, policies: Sequence[RowPolicy], principal: str) -> DataFrame:
    """Rows any granted policy lets through; without a grant none. The filter reaches the scan."""
    granted = [f"({p.condition})" for p in policies if principal in p.grants]
    return df.where(" or ".join(granted) if granted else "false")


def as_principals(df: DataFrame, policies: Sequence[RowPolicy], principals: Sequence[str],
                  summary: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The same summary as each principal, side by side."""
    return union_all([summary(secure_rows(df, policies, p)).withColumn("queried_by", F.lit(p))
                      for p in principals])


# --- column tags ------------------------------------------------------------------------------

def tag_columns(df: DataFrame, tags: Mapping[str, str | None]) -> DataFrame:
    """Set (or with None remove) the tag of columns, kept in the schema metadata."""
    unknown = set(tags) - set(df.columns)
    if unknown:
        raise ValueError(f"no such columns: {sorted(unknown)}")
    out = df
    for name, tag in tags.items():
        meta = {k: v for k, v in df.schema[name].metadata.items() if k != TAG}
        out = out.withMetadata(name, meta if tag is None else {**meta, TAG: tag})
    return out


def untag_all(df: DataFrame) -> DataFrame:
    return tag_columns(df, {c: None for c in active_tags(df)})


def active_tags(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata[TAG] for f in df.schema.fields if TAG in f.metadata}


def tag_audit(df: DataFrame, table: str) -> DataFrame:
    """Tagged columns with type, tag and the number of values they protect, from one aggregation."""
    tags = active_tags(df)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                              F.lit(types[c]).alias("data_type"), F.lit(tag).alias("tag"),
                              F.col(f"__n{i}").alias("values"))
                     for i, (c, tag) in enumerate(sorted(tags.items()))])
    wide = df.agg(*[F.count(F.col(c)).alias(f"__n{i}") for i, c in enumerate(sorted(tags))])
    return wide.select(F.inline(rows))


@dataclass(frozen=True)
class MaskPolicy:
    """What a tag does: ``raw`` principals see the value, ``masked`` ones the mask, all others are refused."""

    mask: Callable[[str], Column]
    raw: frozenset[str] = field(default_factory=frozenset)
    masked: frozenset[str] = field(default_factory=frozenset)


def select_governed(df: DataFrame, columns: Sequence[str], policies: Mapping[str, MaskPolicy],
                    principal: str) -> DataFrame:
    """Select columns as a principal. Naming a tagged column without a grant raises; leaving it out
    passes."""
    tags = active_tags(df)
    out, refused = [], []
    for c in columns:
        policy = policies.get(tags.get(c, ""))
        if c not in tags or (policy and principal in policy.raw):
            out.append(F.col(c))
        elif policy and principal in policy.masked:
            out.append(policy.mask(c).alias(c))
        else:
            refused.append(c)
    if refused:
        raise PermissionError(f"{principal} may not read {', '.join(refused)}")
    return df.select(*out)


@dataclass(frozen=True)
class RoleRule:
    """What a role sees: output columns in order, and the rows it may see (all by default)."""

    columns: Mapping[str, Column]
    rows: Column | None = None


def role_view(df: DataFrame, role: str, rules: Mapping[str, RoleRule]) -> DataFrame:
    """The relation as a role sees it; a role without a rule sees nothing at all."""
    if role not in rules:
        raise PermissionError(f"{role} has no view")
    rule = rules[role]
    return (df if rule.rows is None else df.where(rule.rows)).select(*[c.alias(n) for n, c in rule.columns.items()])


# --- clean room -------------------------------------------------------------------------------

class CleanRoom:
    """Aggregates only, over groups of at least ``k`` distinct privacy units.

    Rows, schema-level selects and joins on other columns are refused, and single values leave only through columns listed
    as ``extremes``. This is a convention between careful parties: code in the same process can always reach the rows.
    """

    _AGGS = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max,
             "count_distinct": F.count_distinct, "count_if": F.count_if}

    def __init__(self, df: DataFrame, unit: str, k: int = 20, join_columns: Sequence[str] = (),
                 extremes: Sequence[str] = ()):
        if k < 1:
            raise ValueError("k must be positive")
        self.__df, self.__unit, self.__k, self.__joins = df, unit, k, tuple(join_columns)
        self.__extremes = tuple(c for c in extremes if c != unit)

    def aggregate(self, by: Sequence[str], **aggs: tuple[str, str]) -> DataFrame:
        """Group by columns; ``aggs`` maps names to (function, column). Small groups vanish silently.

        Neither may a group be the privacy unit itself, nor may single values leave through min and max, but
        for the listed columns.
        """
        if self.__unit in by:
            raise PermissionError("the privacy unit cannot be a group")
        cols = []
        for name, (fn, col) in aggs.items():
            if fn not in self._AGGS:
                raise PermissionError(f"{fn} is not an allowed aggregate")
            if fn in ("min", "max") and col not in self.__extremes:
                raise PermissionError(f"single values of {col} cannot leave the room")
            cols.append(self._AGGS[fn](F.col(col)).alias(name))
        out = self.__df.groupBy(*by).agg(F.count_distinct(self.__unit).alias("__units"), *cols)
        return out.where(F.col("__units") >= self.__k).drop("__units")

    def join(self, other: DataFrame, on: Sequence[str]) -> "CleanRoom":
        """The room joined with own data, on the listed columns only."""
        refused = [c for c in on if c not in self.__joins]
        if refused or not on:
            raise PermissionError(f"join on {refused or 'nothing'} is not allowed")
        return CleanRoom(self.__df.join(other, list(on)), self.__unit, self.__k, self.__joins, self.__extremes)

    def select(self, *columns: str) -> DataFrame:
        raise PermissionError("raw rows cannot leave the room; use aggregate")

    def __getattr__(self, name: str):
        raise PermissionError(f"{name}: only aggregate and join are offered")


# --- erasure ----------------------------------------------------------------------------------

def erase(tables: Mapping[str, DataFrame], keys: Mapping[str, str], subjects: DataFrame,
          subject_key: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables without the subjects' rows, and an audit of removed and kept rows per table."""
    ids = subjects.select(F.col(subject_key).cast("string").alias("__s")).distinct()
    kept, audit = {}, []
    for name, df in tables.items():
        cond = F.col(keys[name]).cast("string") == F.col("__s")
        kept[name] = df.join(ids, cond, "left_anti")
        marked = df.join(ids, cond, "left").select(F.col("__s").isNotNull().alias("gone"))
        audit.append(marked.agg(F.count_if("gone").alias("removed_rows"), F.count_if(~F.col("gone")).alias("kept_rows"))
                     .select(F.lit(name).alias("table_name"), "removed_rows", "kept_rows"))
    return kept, union_all(audit)


def erase_from_files(spark: SparkSession, path: str, subjects: DataFrame, subject_key: str, key: str) -> DataFrame:
    """Remove the subjects' rows from the published table at ``path`` by writing only those of its files anew that hold one.

    Returns the audit: per file that held a subject, how many rows were removed and kept. The manifest lists files; one publication
    replaces all that were rewritten, so readers see the table with all subjects or with none of them. Files without a subject keep
    their place. A subject that is nowhere changes nothing.
    """
    files = versions.current(spark, path)
    ids = subjects.select(F.col(subject_key).cast("string").alias("__s")).where("__s is not null").distinct()
    audit = spark.createDataFrame([], "file string, removed_rows long, kept_rows long")
    if not files:
        return audit
    table = spark.read.parquet(*[f"{path}/{f}" for f in sorted(files.values())])
    name = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)$", 1)
    here = table.select("*", name.alias("__file"))
    found = here.select("__file", F.col(key).cast("string").alias("__s")).join(ids, "__s", "left_semi").groupBy("__file").agg(F.count(F.lit(1)).alias("removed_rows"))
    held = {r["__file"]: r["removed_rows"] for r in found.collect()}  # at most one row a file
    if not held:
        return audit
    touched = {n: f for n, f in files.items() if f.rpartition("/")[2] in held}
    rows = spark.read.parquet(*[f"{path}/{f}" for f in sorted(touched.values())]).select("*", name.alias("__file"))
    kept = rows.join(ids, F.col(key).cast("string") == F.col("__s"), "left_anti")
    folder = versions.new_folder()
    kept.drop("__file").write.parquet(f"{path}/{folder}")
    left = {r["__file"]: r["n"] for r in kept.groupBy("__file").agg(F.count(F.lit(1)).alias("n")).collect()}
    new = {f"{folder}/{n}": f"{folder}/{n}" for n in versions.files(spark, f"{path}/{folder}")}
    versions.publish(spark, path, {n: f for n, f in files.items() if n not in touched} | new)
    return spark.createDataFrame([(n, held[n], left.get(n, 0)) for n in sorted(held)], audit.schema)


def publish_files(spark: SparkSession, path: str, folder: str) -> None:
    """Make the data files of a folder below ``path`` the table, each a part of its own."""
    versions.publish(spark, path, {f"{folder}/{n}": f"{folder}/{n}" for n in versions.files(spark, f"{path}/{folder}")})


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """The published files."""
    return spark.read.parquet(*[f"{path}/{f}" for f in sorted(versions.current(spark, path).values())])
