import pytest
from pyspark.sql import functions as F

from creditlake.catalog.graph import built_graph
from creditlake.operators.graph import Edge, Hop, Node, PropertyGraph
from creditlake.operators.quality import same_answer
from creditlake.plans import graph_queries as q
from creditlake.session import scratch_path


@pytest.fixture(scope="module")
def graph(spark, tables):
    return built_graph(tables).save(scratch_path(spark, "graph"))


def test_valid(graph):
    assert {r.violations for r in graph.validate().collect()} == {0}


def test_two_phrasings(graph):
    assert same_answer(q.merchant_contagion(graph), q.merchant_contagion_paths(graph)).first().equal


def test_path_aggregates_equal_enumerated_paths(graph):
    """The factorised sums against the paths written out by the pattern matcher."""
    paths = graph.match(
        {"f": "CreditFacility", "c": "Customer", "m": "Merchant"},
        [Hop("c", "h", "HOLDS_FACILITY", "f"), Hop("c", "t", "TRANSACTED_AT", "m")],
        {"cif_id": ("c", "cif_id"), "state": ("c", "state"), "bad": ("c", "is_delinquent"), "facility_id": ("f", "facility_id"),
         "product_line": ("f", "product_line"), "dsr": ("f", "new_dsr"), "exposure": ("f", "exposure_amount"),
         "spend": ("t", "total_spend"), "merchant_group": ("m", "merchant_group")})
    want = paths.groupBy("state", "product_line", "merchant_group").agg(
        F.count_distinct("cif_id").alias("active_customers"), F.count_distinct("facility_id").alias("facilities_held"),
        F.round(F.avg("dsr"), 2).cast("double").alias("avg_dsr_pct"), F.sum("exposure").cast("double").alias("total_exposure"),
        F.sum("spend").cast("double").alias("total_spend"), F.count_if("bad").alias("delinquent_paths"))
    got = q.portfolio_by_state(graph)
    got = got.select(*[F.col(c).cast("double").alias(c) if t.startswith("decimal") else F.col(c) for c, t in got.dtypes])
    assert same_answer(want, got).first().equal


def test_rings_equal_enumerated_pairs(graph):
    m = q.ring_members(graph)
    side = lambda n: m.select(*q.GROUP, *[F.col(c).alias(f"{c}{n}") for c in ("cif_id", "combined_unpaid", "total_spend")])
    pairs = side(1).join(side(2), q.GROUP).where("cif_id1 < cif_id2")
    want = pairs.groupBy(*q.GROUP).agg(
        F.count(F.lit(1)).alias("connected_pairs"),
        (F.count_distinct("cif_id1") + F.count_distinct("cif_id2")).alias("distinct_ring_members"),
        F.sum(F.col("total_spend1") + F.col("total_spend2")).cast("double").alias("total_ring_spend"))
    got = q.ring_ranking(graph).select(*q.GROUP, "connected_pairs", "distinct_ring_members",
                                       F.col("total_ring_spend").cast("double").alias("total_ring_spend"))
    assert same_answer(want, got).first().equal


def test_match_refuses_bad_patterns(spark):
    n = spark.createDataFrame([("a",)], "id string")
    e = spark.createDataFrame([("e", "a", "zzz")], "eid string, s string, d string")
    g = PropertyGraph([Node("A", n, "id"), Node("B", n, "id")], [Edge("E", e, "eid", ("A", "s"), ("B", "d"))])
    bad = {r["check"]: r.violations for r in g.validate().where("label = 'E'").collect()}
    assert bad == {"unique(eid)": 0, "references(A.s)": 0, "references(B.d)": 1}
    with pytest.raises(ValueError):
        g.match({"x": "B", "y": "A"}, [Hop("x", "e", "E", "y")], {"id": ("x", "id")})
    with pytest.raises(ValueError):
        PropertyGraph([Node("A", n, "id")], [Edge("E", e, "eid", ("A", "s"), ("B", "d"))])


def test_hot_group_stays_linear(spark):
    """One group with 200,000 members: 20 thousand million pairs, counted and listed without building them."""
    from creditlake.operators.rings import first_pairs, pair_counts
    hot = spark.range(200000).select(F.lit("m").alias("g"), F.format_string("c%06d", "id").alias("c"), F.col("id").alias("v"))
    assert pair_counts(hot.select("g", "c"), ["g"], "n", "pairs").first().pairs == 200000 * 199999 // 2
    got = first_pairs(hot, ["g"], "c", ["v"], 30).collect()
    assert [(r.c_1, r.c_2) for r in got] == [("c000000", f"c{i:06d}") for i in range(1, 31)]


def test_aggregates_without_paths(spark):
    """Against the paths of ``match``, with nulls, repeated edges, conditions and elements without a match."""
    df = spark.createDataFrame
    people = df([(i, ["x", "y", None][i % 3], None if i == 4 else i) for i in range(8)], "id int, town string, age int")
    shops = df([(i, f"s{i % 2}") for i in range(4)], "shop int, kind string")
    visits = df([(n, n % 7, (n * n) % 4, None if n % 5 == 0 else n / 2) for n in range(30)], "visit int, who int, shop int, spent double")
    owns = df([(n, n % 5, n % 3) for n in range(9)], "own int, who int, pet int")
    pets = df([(i, i * 10) for i in range(3)], "pet int, weight int")
    g = PropertyGraph([Node("P", people, "id"), Node("S", shops, "shop"), Node("A", pets, "pet")],
                      [Edge("VISITS", visits, "visit", ("P", "who"), ("S", "shop")), Edge("OWNS", owns, "own", ("P", "who"), ("A", "pet"))])
    nodes, hops = {"p": "P", "s": "S", "a": "A", "q": "P"}, [Hop("p", "v", "VISITS", "s"), Hop("p", "o", "OWNS", "a"), Hop("q", "w", "VISITS", "s")]
    where = {"q": "id > 1", "v": "visit != 3"}
    paths = g.match(nodes, hops, {"town": ("p", "town"), "kind": ("s", "kind"), "pet": ("a", "pet"), "q": ("q", "id"), "s": ("s", "shop"), "spent": ("v", "spent"),
                                  "other": ("w", "spent"), "age": ("q", "age"), "weight": ("a", "weight")}, where)
    want = paths.groupBy("town", "kind").agg(F.count("*").alias("n"), F.sum("spent").alias("spent"), F.avg("age").alias("age"), F.min("other").alias("least"),
                                             F.max("weight").alias("heaviest"), F.count_distinct("q").alias("others"), F.count_distinct("s").alias("shops"))
    got = g.match_aggregate(nodes, hops, {"town": ("p", "town"), "kind": ("s", "kind")}, {
        "n": ("count", "p"), "spent": ("sum", "v", "spent"), "age": ("avg", "q", "age"), "least": ("min", "w", "spent"), "heaviest": ("max", "a", "weight"),
        "others": ("distinct", "q"), "shops": ("distinct", "s")}, where)
    rows = lambda d: sorted(str(tuple(round(x, 9) if isinstance(x, float) else x for x in r)) for r in d.select(want.columns).collect())
    assert rows(got) == rows(want) and want.count() == 6
    with pytest.raises(ValueError, match="not a tree"):
        g.match_aggregate({"p": "P", "s": "S"}, [Hop("p", "v", "VISITS", "s"), Hop("p", "w", "VISITS", "s")], {"t": ("p", "town")}, {"n": ("count", "p")})
    with pytest.raises(ValueError, match="not a tree"):
        g.match_aggregate({"p": "P", "s": "S", "a": "A"}, [Hop("p", "v", "VISITS", "s")], {"t": ("p", "town")}, {"n": ("count", "p")})
    with pytest.raises(ValueError, match="joins P to S"):
        g.match_aggregate({"p": "P", "s": "S"}, [Hop("s", "v", "VISITS", "p")], {"t": ("p", "town")}, {"n": ("count", "p")})


def test_merchant_sums_do_not_sort_the_spend(spark):
    from decimal import Decimal
    from creditlake.plans.graph_tables import merchant_nodes
    rows = [("1", "m", "b", "1.004", 2), ("2", "m", "a", "2.004", 1), (None, "m", None, "4.004", 3), ("1", "n", None, "8.0", 1)]
    spend = spark.createDataFrame(rows, "cif_id string, merchant_id string, merchant_group string, spend string, tx_count long").withColumn(
        "spend", F.col("spend").cast("decimal(38,9)"))
    got = merchant_nodes(spend)
    assert sorted((r.merchant_id, r.merchant_name, r.merchant_group, r.total_sales_volume, r.total_tx_count, r.distinct_customers) for r in got.collect()) == [
        ("m", "m", "b", Decimal("7.01"), 6, 2), ("n", "n", "General Retail", Decimal("8.00"), 1, 1)]
    plan = got._jdf.queryExecution().sparkPlan().toString()  # rows come from the last line up: spend is hashed, only its groups are sorted
    assert plan.rindex("HashAggregate(") > plan.rindex("SortAggregate(")


def test_spend_is_dealt_out_once(spark):
    """Edges come from sums that lie by customer: neither the check of their ends nor the maxima over text move or sort all sales again."""
    from creditlake.plans.graph_tables import customer_ids, customer_merchant_spend, merchant_nodes, transacted_edges, with_known

    sales = spark.createDataFrame(
        [("7", "m1", "CARD", "a", None, 1.25, None), ("7", "m1", "LOAN", "b", "g", 2.005, 3), ("7", "m2", "CARD", "a", "g", 1.0, 1), ("8", "m1", "CARD", "a", "h", 5.0, 2),
         (None, "m1", "CARD", "a", "z", 9.0, 1), ("7", "", "CARD", "a", "g", 4.0, 1), ("7", None, "CARD", "a", "g", 4.0, 1)],
        "cif_id string, merchant_id string, product_line string, sales_type string, merchant_group string, amount double, trans_count long")
    customers = spark.createDataFrame([(7, "A"), (7, "B"), (9, "C"), (None, "D")], "cif_id long, state string")
    sums = customer_merchant_spend(sales)
    assert sums.count() == 4
    edges = transacted_edges(with_known(sums, customer_ids(customers)))
    assert sorted((r.edge_id, r.product_line, r.sales_type, float(r.total_spend), r.tx_count) for r in edges.collect()) == \
        [("7->m1", "LOAN", "b", 3.26, 4), ("7->m2", "CARD", "a", 1.0, 1)]
    assert {(r.merchant_id, r.merchant_group, float(r.total_sales_volume)) for r in merchant_nodes(sums).collect()} == {("m1", "z", 17.26), ("m2", "g", 1.0)}
    plan = edges.where("tx_count > 0")._jdf.queryExecution().executedPlan().toString()
    # the sales once, the ids once for each other and once to meet the sales
    assert plan.count("REPARTITION_BY_COL") == 1 and plan.count("Exchange ") == 3, plan


def test_distinct_ends_are_counted_behind_their_edge(spark):
    """Nodes with one edge do not meet the groups themselves; nodes with several are still counted once a group."""
    a = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None), (5, "y")], "a int, kind string")
    b = spark.createDataFrame([(1, "s"), (2, "s"), (3, "t")], "b int, state string")
    c = spark.createDataFrame([(1, "g"), (2, "g"), (3, "h")], "c int, grp string")
    ab = spark.createDataFrame([(1, 1, 1), (2, 2, 1), (3, 2, 2), (4, 3, 1), (5, 3, 1), (6, 4, 3), (7, 5, 3)], "id int, a int, b int")
    bc = spark.createDataFrame([(1, 1, 1), (2, 1, 2), (3, 1, 3), (4, 2, 1), (5, 3, 3)], "id int, b int, c int")
    g = PropertyGraph([Node("A", a, "a"), Node("B", b, "b"), Node("C", c, "c")],
                      [Edge("AB", ab, "id", ("A", "a"), ("B", "b")), Edge("BC", bc, "id", ("B", "b"), ("C", "c"))])
    pattern = {"b": "B", "a": "A", "c": "C"}, [Hop("a", "p", "AB", "b"), Hop("b", "q", "BC", "c")]
    by = {"kind": ("a", "kind"), "state": ("b", "state"), "grp": ("c", "grp")}
    for where in ({}, {"a": "a <> 5"}):
        got = g.match_aggregate(*pattern, by, {"n": ("distinct", "a"), "m": ("distinct", "c")}, where)
        rows = g.match(*pattern, {**by, "a": ("a", "a"), "c": ("c", "c")}, where)
        want = rows.groupBy(*by).agg(F.count_distinct("a").alias("n"), F.count_distinct("c").alias("m"))
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    plan = g.match_aggregate(*pattern, by, {"n": ("distinct", "a")})._jdf.queryExecution().optimizedPlan().toString()
    assert "(__e" in plan


def test_portfolio_moves_edges_once(graph):
    """The sums of spending edges meet the customers where they were made."""
    plan = q.portfolio_by_state(graph)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 1
    assert not any("hashpartitioning(cif_id" in line and "merchant_group" in line for line in plan.splitlines())
