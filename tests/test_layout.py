"""What is read and written: pruned files, rewritten files, united sketches, compared buckets."""

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from creditlake.catalog.quality import ALL_TABLES
from creditlake.operators import security as sec
from creditlake.operators.profiles import column_sketches, merged_profile
from creditlake.operators.quality import differing_rows
from creditlake.session import scratch_path
from creditlake.sources import tables as tb
from creditlake.sources import versions

from conftest import SF


def files_of(path):
    from pathlib import Path
    return sorted(Path(path.removeprefix("file:")).glob("*.parquet"))


@pytest.mark.parametrize("column", ["a", "b", "c"])
def test_interleaved_prunes_on_every_column(spark, column):
    rows = spark.range(40_000).select((F.xxhash64("id") % 1000).alias("a"), F.concat(F.lit("k"), F.lpad((F.xxhash64("id", F.lit(1)) % 500).cast("string"), 4, "0")).alias("b"),
                                      F.when(F.col("id") % 50 > 0, F.rand(3)).alias("c"))
    path = scratch_path(spark, "z")
    tb.write_interleaved(rows, path, ["a", "b", "c"], partitions=512)
    wanted = {"a": (-400, -390), "b": ("k0100", "k0104"), "c": (0.3, 0.302)}[column]
    hit = 0
    for f in files_of(path):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index(column)
        stats = [meta.row_group(i).column(at).statistics for i in range(meta.num_row_groups)]
        cast = (lambda v: v.decode() if isinstance(v, bytes) else v)
        hit += any(s.has_min_max and cast(s.min) <= wanted[1] and cast(s.max) >= wanted[0] for s in stats)
    assert 0 < hit < len(files_of(path)) / 4 and len(files_of(path)) > 400
    got = spark.read.parquet(path)
    assert differing_rows(rows, got, ["a", "b"]).count() == 0


def test_interleaved_edges(spark):
    path = scratch_path(spark, "z")
    tb.write_interleaved(spark.createDataFrame([], "a int, b string"), path, ["a", "b"])
    assert spark.read.parquet(path).count() == 0
    tb.write_interleaved(spark.createDataFrame([(None, None), (1, "x")], "a int, b string"), path, ["a", "b"])
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        tb.write_interleaved(spark.range(1), path, [])


def test_erasure_by_file(spark):
    root = scratch_path(spark, "erase")
    tb.write_clustered(spark.range(2000).select((F.col("id") % 200).alias("who"), "id"), f"{root}/first", ["who"], partitions=10)
    sec.publish_files(spark, root, "first")
    before = versions.current(spark, root)
    gone = spark.createDataFrame([("3",), ("5",), (None,), ("nobody",)], "subject string")
    audit = sec.erase_from_files(spark, root, gone, "subject", "who").collect()
    after = versions.current(spark, root)
    assert sum(r.removed_rows for r in audit) == 20 and 1 <= len(audit) <= 3 and len(before) >= 8
    assert len(set(before) & set(after)) == len(before) - len(audit)
    left = sec.read_files(spark, root)
    assert left.count() == 1980 and left.where("who in (3, 5)").count() == 0
    assert sec.erase_from_files(spark, root, gone, "subject", "who").count() == 0 and versions.current(spark, root) == after


@pytest.mark.parametrize("table", ALL_TABLES)
def test_profiles_within_their_bounds(spark, table):
    df = spark.read.parquet(f"{SF}/{table}.parquet")
    parts = column_sketches(df, F.pmod(F.xxhash64(F.col(df.columns[0])), F.lit(5)))
    got = {r.column_name: r for r in merged_profile(parts).collect()}
    once = {r.column_name: r for r in merged_profile(column_sketches(df)).collect()}
    con = duckdb.connect()
    con.execute(f"create view t as select * from '{SF}/{table}.parquet'")
    assert got
    for name, r in got.items():
        n, filled, distinct = con.execute(f"select count(*), count({name}), count(distinct {name}) from t").fetchone()
        assert (r.row_count, r.filled) == (n, filled) and abs(r.distinct_estimate - distinct) <= 0.03 * distinct + 1
        assert (r.min_number, r.max_number, r.min_text) == (once[name].min_number, once[name].max_number, once[name].min_text)
        assert abs(r.distinct_estimate - once[name].distinct_estimate) <= 0.03 * distinct + 1  # one pass knows the order of arrival, too
        if r.q50 is not None:
            below, upto = con.execute(f"select avg(({name} < {r.q50!r})::int), avg(({name} <= {r.q50!r})::int) from t where {name} is not null").fetchone()
            assert below - 0.04 <= 0.5 <= upto + 0.04


def test_differing_rows(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None), (3, "c"), (None, "d")], "k int, v string")
    right = spark.createDataFrame([("a", 1), (None, 2), ("x", 3), ("d", None), ("e", 9), ("e", 9)], "v string, k int")
    got = {tuple(r) for r in differing_rows(left, right, ["k"], buckets=3).collect()}
    assert got == {(1, "a", "left", 1), (3, "c", "left", 1), (3, "x", "right", 1), (9, "e", "right", 2)}
    assert differing_rows(left, left, ["k"]).count() == 0 and differing_rows(left.limit(0), left.limit(0), ["k"]).count() == 0
