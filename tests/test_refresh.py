"""Products refreshed by change rows: only what a change reaches is written, and all at once."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from creditlake.functions.scalars import key
from creditlake.plans import refresh as plan
from creditlake.plans.registry import Step
from creditlake.session import scratch_path
from creditlake.sources import versions

SOURCES = [plan.Landed("sale", ("sale_no",), lambda: key("cust")), plan.Landed("person", ("id",), lambda: key("id"))]


def totals(sale, person):
    sums = sale.groupBy(key("cust").alias("cif_id")).agg(F.sum("amount").alias("spent"), F.count("*").alias("n"))
    return sums.join(person.select(key("id").alias("cif_id"), "name"), "cif_id", "left")


def loud(total):
    return total.where("spent > 100").select("cif_id", F.upper("name").alias("name"))


PRODUCTS = [plan.Product(Step("total", "gold", ("sale", "person"), totals, unique=("cif_id",))),
            plan.Product(Step("loud", "gold", ("total",), loud, non_null=("cif_id",)))]
SALE, PERSON = "sale_no int, cust int, amount int, change_version int, change_deleted boolean", "id int, name string"


@pytest.fixture
def lake(spark):
    root = scratch_path(spark, "lake")

    def load(sales=(), people=(), **kw):
        deltas = {"sale": spark.createDataFrame(list(sales), SALE), "person": spark.createDataFrame(list(people), PERSON)}
        return plan.refresh(spark, root, deltas, SOURCES, kw.pop("products", PRODUCTS), buckets=16)

    load.root = root
    load.rows = lambda table: sorted(map(str, (tuple(r) for r in plan.read(spark, root, table).collect())))
    load.parts = lambda: versions.current(spark, root)
    return load


def row(no, cust, amount, version=0, gone=False):
    return (no, cust, amount, version, gone)


def test_only_reached_buckets(lake):
    lake([row(i, i, 60) for i in range(40)], [(i, f"n{i}") for i in range(40)])
    before = lake.parts()
    assert len({p for p in before if p.startswith("total/")}) > 8 and lake.rows("loud") == []
    written = lake([row(100, 7, 50)])
    after = lake.parts()
    assert written == {"sale": 1, "total": 1, "loud": 1}
    changed = {p for p in before if before[p] != after.get(p)}
    assert len(changed) == 2 and lake.rows("loud") == ["('7', 'N7')"]
    assert "('7', 110, 2, 'n7')" in lake.rows("total") and len(lake.rows("total")) == 40
    # a name that no product of the second step shows: it stops at the first
    assert set(lake(people=[(9, "other")])) == {"person", "total"}


def test_late_moved_deleted_and_repeated(lake):
    lake([row(1, 1, 200, 1), row(2, 1, 5, 1), row(3, None, 7, 1)], [(1, "a"), (2, "b")])
    assert lake.rows("total") == ["('1', 205, 2, 'a')", "(None, 7, 1, None)"]
    delta = [row(1, 2, 300, 2), row(2, 1, 9, 0), row(3, None, 0, 2, True)]  # moved, late, deleted
    lake(delta)
    assert lake.rows("total") == ["('1', 5, 1, 'a')", "('2', 300, 1, 'b')"] and lake.rows("loud") == ["('2', 'B')"]
    state = lake.parts()
    lake(delta)
    assert {p: f for p, f in lake.parts().items() if p.startswith(("total/", "loud/"))} == {p: f for p, f in state.items() if p.startswith(("total/", "loud/"))}
    # an older record doesn't bring the deleted one back; all rows of a key go
    lake([row(3, None, 8, 1), row(1, 2, 0, 3, True), row(2, 1, 0, 3, True)])
    assert lake.rows("total") == [] and lake.rows("loud") == []


def test_all_or_nothing(lake):
    lake([row(1, 1, 200)], [(1, "a")])
    state = lake.parts()
    broken = [*PRODUCTS, plan.Product(Step("bad", "gold", ("total",), lambda t: t.unionByName(t), unique=("cif_id",)))]
    with pytest.raises(AssertionError):
        lake([row(2, 1, 1)], products=broken)
    assert lake.parts() == state and lake.rows("total") == ["('1', 200, 1, 'a')"]
    lake([row(2, 1, 1)])
    assert lake.rows("total") == ["('1', 201, 2, 'a')"]


def test_refusals(spark):
    root = scratch_path(spark, "lake")
    with pytest.raises(ValueError, match="no source"):
        plan.refresh(spark, root, {"other": spark.range(1)}, SOURCES, PRODUCTS)
    with pytest.raises(ValueError, match="never been loaded"):
        plan.refresh(spark, root, {"person": spark.createDataFrame([(1, "a")], PERSON)}, SOURCES, PRODUCTS)
    with pytest.raises(ValueError, match="no rows"):
        plan.read(spark, root, "total")


def test_a_load_reads_its_records_once(tables):
    from creditlake.catalog.refreshing import deltas
    for load in deltas(tables):
        text = load["card_sales"]._jdf.queryExecution().optimizedPlan().toString()
        assert text.count("Relation [l_orderkey") == 1 and text.count("Relation [o_orderkey") == 1


def test_marks_tell_where_nulls_are(spark):
    def marks(*rows):
        return plan._marks(spark.createDataFrame([("k", *r) for r in rows], f"{plan.KEY} string, a int, b int")).collect()

    assert marks((None, 5)) != marks((5, None)) and marks((1, 2), (3, 4)) == marks((3, 4), (1, 2))
    assert marks((1, 2)) != marks((1, 2), (1, 2)) and len(marks((1, 2), (3, 4))) == 1


def test_what_only_a_refresh_needs_goes(lake, spark):
    """No landed delta, list of keys or shuffle file is left; a step without a change leaves no folder; the setting comes back."""
    scratch = Path(spark.conf.get("spark.checkpoint.dir"))
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    kept = lambda: {f.getName() for f in (blocks.getAllFiles().apply(i) for i in range(blocks.getAllFiles().length())) if f.getName().startswith("shuffle_")}
    before, files, setting = set(scratch.iterdir()), kept(), spark.conf.get(plan.CLEANUP, None)
    lake([row(i, i, 60) for i in range(40)], [(i, f"n{i}") for i in range(40)])
    folders = lambda table: {f.name for f in Path(lake.root, table).iterdir()}
    loud_before = folders("loud")
    lake([row(100, 7, 1)])
    assert folders("loud") == loud_before and lake.rows("loud") == []
    assert set(scratch.iterdir()) - before <= {Path(lake.root)} and spark.conf.get(plan.CLEANUP, None) == setting
    for _ in range(50):  # files go in the background
        if not (left := kept() - files):
            break
        time.sleep(0.2)
    assert not left


def test_a_first_load_is_written_once(spark, lake, monkeypatch):
    """Neither the delta nor a step's rows are written aside before they are put in their place."""
    written, stored = [], plan._Refresh.stored
    monkeypatch.setattr(plan._Refresh, "stored", lambda job, df, name: written.append(name) or stored(job, df, name))
    lake([row(i, i, 60) for i in range(40)], [(i, f"n{i}") for i in range(40)])
    assert written == [] and len(lake.rows("total")) == 40
