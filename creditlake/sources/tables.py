"""Table writers and readers."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def declare(df: DataFrame, columns: Mapping[str, tuple[str, str]], keep_others: bool = False) -> DataFrame:
    """Cast to declared types and attach column comments: ``columns`` maps name to (type, comment). Missing columns are
    refused, and so are undeclared ones unless ``keep_others`` passes them on behind the declared."""
    missing = [c for c in columns if c not in df.columns]
    others = [c for c in df.columns if c not in columns]
    if missing or (others and not keep_others):
        raise ValueError(f"missing columns {missing}, undeclared columns {others}")
    return df.select(*[F.col(f"`{c}`").cast(t).alias(c, metadata={"comment": note}) for c, (t, note) in columns.items()],
                     *[F.col(f"`{c}`") for c in others])


def struct_of(columns: Mapping[str, tuple[str, str]]) -> T.StructType:
    """The declared columns as a read schema with comments."""
    out = T.StructType()
    for c, (t, note) in columns.items():
        out.add(T.StructField(c, T.StructType.fromDDL(f"c {t}")[0].dataType, True, {"comment": note}))
    return out


def create_table(spark: SparkSession, name: str, columns: Mapping[str, tuple[str, str]], comment: str, path: str) -> None:
    """An empty described table, replacing one of the same name."""
    quote = lambda text: text.replace("\\", "\\\\").replace("'", "\\'")
    cols = ", ".join(f"`{c}` {t} COMMENT '{quote(note)}'" for c, (t, note) in columns.items())
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet LOCATION '{quote(path)}' COMMENT '{quote(comment)}'")


def land_table(df: DataFrame, name: str, path: str, fmt: str = "parquet") -> None:
    """Create or replace an open table at ``path``; other formats need their jar."""
    df.write.mode("overwrite").format(fmt).option("path", path).saveAsTable(name)


def describe(df: DataFrame, dictionary: Mapping[str, str], default: str = "Attribute: ") -> DataFrame:
    """Attach the dictionary text to each column, matching names without case; unknown columns get
    ``default`` and their name. A pass-through view: no data moves."""
    texts = {k.lower(): v for k, v in dictionary.items()}
    return df.select(*[F.col(f"`{c}`").alias(c, metadata={**df.schema[c].metadata,
                                                          "comment": texts.get(c.lower(), f"{default}{c}")})
                       for c in df.columns])


def column_listing(df: DataFrame) -> DataFrame:
    """Column, position, type, comment and number of values, from one aggregation."""
    wide = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"__n{i}") for i, c in enumerate(df.columns)])
    rows = F.array(*[F.struct(F.lit(i + 1).alias("ordinal"), F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString()).alias("data_type"),
                              F.lit(f.metadata.get("comment", "")).alias("comment"),
                              F.col(f"__n{i}").alias("values"))
                     for i, f in enumerate(df.schema.fields)])
    return wide.select(F.inline(rows))


def write_clustered(df: DataFrame, path: str, cluster: Sequence[str], partitions: int | None = None) -> None:
    """Parquet laid out by up to three columns, so that row-group minima and maxima prune reads.

    Range partitioning samples the keys; a value that fills several partitions is spread over them by a
    hash of the whole row as last sort key.
    """
    if not cluster:
        df.write.mode("overwrite").parquet(path)
        return
    if len(cluster) > 3:
        raise ValueError("cluster on at most three columns")
    plain = [c for c, t in df.dtypes if not t.startswith(("map", "variant"))]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in plain])
    keys = [F.col(c) for c in cluster] + [spread]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    ranged.sortWithinPartitions(*cluster).write.mode("overwrite").parquet(path)


def _up_to(column: str) -> Callable[[Column], Column]:
    return lambda edge: edge <= F.col(column)


def interleaved(df: DataFrame, cluster: Sequence[str], bits: int = 6, sample_rows: int = 20_000, seed: int = 11) -> Column:
    """The place of a row on a curve that keeps rows near that are near in all the columns: the bits of their ranks, dealt out in turn.

    Ranks are among 2 ** ``bits`` - 1 boundaries, quantiles of about ``sample_rows`` rows drawn (bounded at the driver); equal values have
    equal ranks, nulls the lowest. Any ordered type will do.
    """
    count = df.count()
    drawn = df.select(*cluster).sample(min(1.0, sample_rows / count) if count else 1.0, seed).limit(2 * sample_rows).collect()
    ranks = []
    for c in cluster:
        values = sorted(r[c] for r in drawn if r[c] is not None)
        edges = sorted({values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)}) if values else []
        kind = df.schema[c].dataType
        below = F.size(F.filter(F.array(*[F.lit(v).cast(kind) for v in edges]), _up_to(c))) if edges else F.lit(0)
        ranks.append(F.when(F.col(c).isNull(), 0).otherwise(below).cast("long"))
    place = F.lit(0).cast("long")
    for bit in range(bits):
        for i, rank in enumerate(ranks):
            place = place + F.shiftleft(F.shiftright(rank, bit).bitwiseAND(1), bit * len(ranks) + len(ranks) - 1 - i)
    return place


def write_interleaved(df: DataFrame, path: str, cluster: Sequence[str], partitions: int | None = None) -> None:
    """Parquet laid out so that a filter on any of the columns alone prunes files, not only one on the first."""
    if not 1 <= len(cluster) <= 4:
        raise ValueError("cluster on one to four columns")
    plain = [c for c, t in df.dtypes if not t.startswith(("map", "variant"))]
    keys = ["__place", F.xxhash64(*[F.col(f"`{c}`") for c in plain])]
    placed = df.withColumn("__place", interleaved(df, cluster))
    ranged = placed.repartitionByRange(partitions, *keys) if partitions else placed.repartitionByRange(*keys)
    ranged.sortWithinPartitions("__place").drop("__place").write.mode("overwrite").parquet(path)


def append_log(df: DataFrame, path: str, timestamp: str, cluster: Sequence[str] = ()) -> None:
    """Append rows to a log partitioned by day, sorted by the cluster columns within files.

    Days are rebalanced by size: adaptive execution splits a busy day among as many tasks (and files) as its
    bytes need and puts small days together.
    """
    out = df.withColumn("log_date", F.to_date(timestamp))
    (out.hint("rebalance", "log_date").sortWithinPartitions("log_date", *cluster)
     .write.mode("append").partitionBy("log_date").parquet(path))


def snapshot(df: DataFrame, path: str) -> DataFrame:
    """Overwrite the stored snapshot and return it."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small inline relation."""
    return spark.createDataFrame(list(rows), schema)
