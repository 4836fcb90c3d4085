"""Every named query against its SQL in DuckDB, on the smallest tables."""

from collections import Counter

import duckdb
import pytest

from __spark_entry__ import entry
from check import rows_of
from creditlake.catalog import ORACLES, QUERIES
from creditlake.fixtures import RAW

from conftest import SF

# Rows-only queries that need a richer table than the smallest one.
MAY_BE_EMPTY = {"dp_22_next_product_list", "gr_18b_cross_sell_path_json"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, SF)
    got, cols = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        assert got or name in MAY_BE_EMPTY
        return
    con = duckdb.connect()
    for t in RAW:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    res = con.execute(ORACLES[name])
    want, wcols = rows_of([d[0] for d in res.description], res.fetchall())
    assert cols == wcols
    assert Counter(got) == Counter(want)


def test_entry(spark):
    assert entry(spark).count() > 0
