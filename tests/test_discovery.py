"""Relationships, lineage and reconciliation on small tables."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from creditlake.operators import quality as dq
from creditlake.operators.lineage import column_lineage, lineage_report
from creditlake.session import scratch_path


def test_inclusions(spark):
    long = "x" * 100
    tables = {
        "left": spark.createDataFrame([(1, "a", None), (2, long, 1.0), (2, "c", 2.0), (None, "c", 3.0)], "k int, t string, m double"),
        "right": spark.createDataFrame([(1, 1, long), (2, 1, "a"), (9, 1, "b")], "id long, one int, name string"),
        "other": spark.createDataFrame([("1", True)], "k string, b boolean"),
        "none": spark.createDataFrame([], "v int")}
    got = {tuple(r)[:6] + (float(r.confidence), r.right_unique) for r in dq.inclusion_dependencies(tables, 0.5).collect()}
    assert got == {("left", "k", "right", "id", 2, 2, 1.0, True), ("right", "id", "left", "k", 3, 2, 0.6667, False),
                   ("right", "one", "left", "k", 1, 1, 1.0, False), ("left", "k", "right", "one", 2, 1, 0.5, False),
                   ("left", "t", "right", "name", 3, 2, 0.6667, True), ("right", "name", "left", "t", 3, 2, 0.6667, False)}
    assert dq.inclusion_dependencies({n: tables[n] for n in ("none", "other")}).count() == 0


def test_many_columns(spark):
    """More columns than one word of bits has."""
    wide = spark.range(5).select(*[(F.col("id") + i).alias(f"c{i}") for i in range(130)])
    got = dq.inclusion_dependencies({"wide": wide, "few": spark.range(128, 131)}, 1.0).collect()
    assert {(r.left_column, r.right_column) for r in got} == {("id", "c126"), ("id", "c127"), ("id", "c128")}


def test_discovered(spark):
    docs, labels = spark.createDataFrame([(1,), (2,)], "doc_id long"), spark.createDataFrame([(1, 0)], "doc_id long, quality int")
    got = dq.discover_relationships({"documents": docs, "labels": labels}).collect()
    assert [tuple(r)[:4] for r in got] == [("labels", "doc_id", "documents", "doc_id")]
    assert dq.discover_relationships({"a": docs, "b": docs}).count() == 0


def test_small_amounts(spark):
    bronze = spark.createDataFrame([("0.004",)] * 1000, "amount string").select(F.col("amount").cast("decimal(9,3)"))
    flat = bronze.select(F.lit(0).alias("amount"))
    rows = dq.reconcile([dq.Control("lost", "x", bronze, flat), dq.Control("kept", "x", bronze, bronze)]).collect()
    assert {r.flow: (r.audit_status, float(r.variance)) for r in rows} == {"lost": ("INVESTIGATE", -4.0), "kept": ("PASS", 0.0)}


def test_lineage(spark):
    at = {}
    for name, df in (("sale", spark.range(4).selectExpr("id as sale_no", "id % 2 as who", "id * 1.5 as amount", "'x' as note")),
                     ("person", spark.range(2).selectExpr("id", "concat('n', id) as name", "id as age"))):
        path = scratch_path(spark, name)
        df.write.parquet(path)
        at[name] = spark.read.parquet(path)
    sale, person = at["sale"], at["person"]
    newest = sale.withColumn("rn", F.row_number().over(Window.partitionBy("who").orderBy("sale_no"))).where("rn = 1")
    sums = sale.where("note = 'x'").groupBy(F.col("who").alias("buyer")).agg((F.sum("amount") * 2).alias("twice"))
    both = sums.join(person.withColumnRenamed("name", "called"), F.col("buyer") == F.col("id"))
    assert column_lineage(both.select("called", "twice", F.upper("called").alias("loud"), F.lit(1).alias("one")), at) == [
        ("*", "person", "id", "join"), ("*", "sale", "note", "filter"), ("*", "sale", "who", "group"), ("*", "sale", "who", "join"),
        ("called", "person", "name", "copied"), ("loud", "person", "name", "derived"), ("twice", "sale", "amount", "aggregated")]
    assert [r for r in column_lineage(newest.select("rn", "amount"), at) if r[0] != "*"] == [
        ("amount", "sale", "amount", "copied"), ("rn", "sale", "sale_no", "window"), ("rn", "sale", "who", "window")]
    # unions by place, a table read twice, a subquery, an exploded list
    union = sale.select(F.col("sale_no").alias("v")).union(person.select("age"))
    assert {r[1:3] for r in column_lineage(union, at) if r[0] == "v"} == {("sale", "sale_no"), ("person", "age")}
    twice = person.alias("a").join(person.alias("b"), F.col("a.id") == F.col("b.age")).select(F.col("b.name").alias("n"))
    assert column_lineage(twice, at) == [("*", "person", "age", "join"), ("*", "person", "id", "join"), ("n", "person", "name", "copied")]
    assert ("m", "sale", "amount", "aggregated") in column_lineage(person.select((F.col("age") + sale.select(F.max("amount")).scalar()).alias("m")), at)
    assert column_lineage(person.select(F.explode(F.split("name", "")).alias("letter")), at) == [("letter", "person", "name", "derived")]
    report = lineage_report(both.select("called"), at).where("target_column = 'called'").collect()
    assert [tuple(r) for r in report] == [("called", "person", "name", "copied", 2, 2)]
    assert lineage_report(person.select(F.lit(1).alias("one")), at).count() == 0
