import math
import random

import pytest
from pyspark.sql import functions as F

from creditlake.functions.geo import EARTH_RADIUS_M
from creditlake.operators import geo, joins, lists, lookup, rings, sets, topk, windows
from creditlake.plans import marts


def test_join_any_of_matches_the_disjunction(spark):
    rnd = random.Random(3)
    pick = lambda: rnd.choice([None, 1, 2, 3, 4])
    left = [(i, pick(), pick()) for i in range(60)]
    right = [(i, pick(), pick()) for i in range(50)]
    got = joins.join_any_of(spark.createDataFrame(left, "l int, a int, b int"),
                            spark.createDataFrame(right, "r int, c int, d int"), [("a", "c"), ("b", "d")])
    eq = lambda x, y: x is not None and x == y
    want = sorted((l[0], r[0]) for l in left for r in right if eq(l[1], r[1]) or eq(l[2], r[2]))
    assert sorted((r.l, r.r) for r in got.collect()) == want
    assert "NestedLoop" not in got._jdf.queryExecution().toString()
    with pytest.raises(ValueError):
        joins.join_any_of(spark.range(1), spark.range(1), [("id", "id")])


def test_join_any_of_computes_each_side_once(spark):
    left, right = spark.range(50).selectExpr("id l", "id % 7 a", "id % 5 b"), spark.range(40).selectExpr("id r", "id % 9 c", "id % 4 d")
    got = joins.join_any_of(left, right, [("a", "c"), ("b", "d")])
    assert got.columns == ["l", "a", "b", "r", "c", "d"]
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Range (") == 2
    both = [(x, y) for x in range(50) for y in range(40) if x % 7 == y % 9 or x % 5 == y % 4]
    assert sorted((r.l, r.r) for r in got.collect()) == both
    mixed = joins.join_any_of(left.withColumn("a", F.col("a").cast("string")), right.withColumn("c", F.col("c").cast("string")), [("a", "c"), ("b", "d")])
    assert sorted((r.l, r.r) for r in mixed.collect()) == both


def test_cross_source_sales_matches_days_to_card_customers(spark, tables):
    sales = [(1, 20240101, "x", 2, 1.5), (1, 20240102, "x", None, 2.5), (1, 1, "x", 1, 4.0), (2, None, "y", 3, 1.0), (2, 3, "y", 1, 8.0),
             (4, 20240101, "y", 1, 16.0), (None, 1, "y", 1, 32.0), (4, 5, "x", 1, 64.0)]
    cards = [(1, "A"), (1, "A"), (1, "B"), (3, "B"), (20240101, "A"), (None, "A")]
    customers = [(1, "s"), (1, "s"), (1, "t"), (2, "s"), (4, "t")]
    got = marts.cross_source_sales(spark.createDataFrame(sales, "cif_no long, tx_dt long, sales_type string, trans_count long, amount double"),
                                   spark.createDataFrame(customers, "cif_id long, state string"),
                                   spark.createDataFrame(cards, "cif_id long, card_status string"))
    want = {}
    for cif, tx, kind, n, amount in sales:
        for card, status in cards:
            for cust, state in customers:
                if cif is not None and cif == cust and card is not None and card in (cif, tx):
                    row = want.setdefault((state, kind, status), [set(), None, 0.0])
                    row[0].add(cif)
                    row[1] = row[1] if n is None else (row[1] or 0) + n
                    row[2] += amount
    assert {(r.state, r.sales_type, r.card_status): (r.active_customers, r.total_transactions, float(r.total_sales)) for r in got.collect()} == {
        k: (len(ids), n, amount) for k, (ids, n, amount) in want.items()}
    plan = marts.cross_source_sales(tables.f("card_sales"), tables.f("customer"), tables.f("card"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1


def haversine(a, b):
    p1, p2 = math.radians(a[1]), math.radians(b[1])
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(b[0] - a[0]) / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(min(1, math.sqrt(h)))


@pytest.mark.parametrize("metres", [3000.0, 120000.0])
def test_distance_join_against_all_pairs(spark, metres):
    rnd = random.Random(int(metres))
    centres = [(0, 0), (179.99, 10), (-179.99, -40), (100, 89.7), (30, -89.9), (103.8, 1.5), (0, 60)]
    spread = metres / 60000

    def points(n):
        out = []
        for _ in range(n):
            x, y = rnd.choice(centres)
            x, y = x + rnd.uniform(-spread, spread), max(-90.0, min(90.0, y + rnd.uniform(-spread, spread)))
            out.append(((x + 180) % 360 - 180, y))
        return out

    hubs, pois = points(60), points(300)
    h = spark.createDataFrame([(i, *p) for i, p in enumerate(hubs)], "h int, hx double, hy double")
    p = spark.createDataFrame([(i, *q) for i, q in enumerate(pois)], "p int, px double, py double")
    got = geo.dwithin_join(h, p, metres, ("hx", "hy"), ("px", "py"))
    want = sorted((i, j) for i, a in enumerate(hubs) for j, b in enumerate(pois) if haversine(a, b) <= metres)
    assert want and sorted((r.h, r.p) for r in got.collect()) == want


def test_points_of_one_place_are_dealt_to_many_tasks(spark):
    h = spark.range(1500).selectExpr("id as h", "103.8d as hx", "1.5d + id * 1e-7 as hy")
    p = spark.range(4000).selectExpr("id as p", "103.8d as px", "1.5d + id * 1e-7 as py")
    got = geo.dwithin_join(h, p, 1000.0, ("hx", "hy"), ("px", "py"))
    per = [r.n for r in got.groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n")).collect()]
    assert sum(per) == 1500 * 4000 and len(per) > 1 and max(per) < 1500 * 4000


@pytest.mark.parametrize("metres", [3.0, 3000.0, 120000.0])
def test_totals_of_near_pairs_without_pairs(spark, monkeypatch, metres):
    """Against all pairs, at the date line, the poles and with null coordinates; in whole cells and in many small pieces."""
    rnd = random.Random(int(metres) + 1)
    spread = metres / 60000

    def points(n):
        out = []
        for _ in range(n):
            x, y = rnd.choice([(0, 0), (179.99999, 10), (-179.99999, -40), (100, 89.99), (30, -89.99), (103.8, 1.5), (0, 60)])
            x, y = x + rnd.uniform(-spread, spread), max(-90.0, min(90.0, y + rnd.uniform(-spread, spread)))
            out.append(((x + 180) % 360 - 180, y))
        return out

    hubs = points(60)
    pois = [(*q, rnd.choice(["a", "b", "c", None]), rnd.randrange(3)) for q in points(300)]
    h = spark.createDataFrame([(i // 2, *p) for i, p in enumerate(hubs)] + [(99, None, 1.0)], "h int, hx double, hy double")
    p = spark.createDataFrame(pois + [(0.0, None, "a", 1), (float("nan"), 0.0, "a", 1)], "px double, py double, c string, w int")
    want = {}
    for i, a in enumerate(hubs):
        for *b, c, w in pois:
            if (d := haversine(a, b)) <= metres:
                n, s, least, total = want.get((i // 2, c), (0, 0, math.inf, 0))
                mm = math.floor(d * 1000 + 0.5)
                want[i // 2, c] = (n + 1, s + w, min(least, mm), total + mm)
    for sizes in ((geo.SMALL_PIECE, geo.LARGE_PIECE), (5, 7)):
        monkeypatch.setattr(geo, "SMALL_PIECE", sizes[0])
        monkeypatch.setattr(geo, "LARGE_PIECE", sizes[1])
        got = geo.dwithin_totals(h, p, metres, ["h"], "c", {"w": F.col("w")}, ("hx", "hy"), ("px", "py"), distances=True)
        assert want and {(r.h, r.c): (r.pairs, r.w, r.nearest_mm, r.total_mm) for r in got.collect()} == want


def test_summaries_make_no_pairs(spark):
    """No join on distance: a million pairs are totals of their pieces."""
    from creditlake.plans import geo as plans
    h = spark.range(1000).selectExpr("id as hub_id", "'h' as hub_name", "'s' as state", "'r' as region", "103.8d as lon", "1.5d + id * 1e-7 as lat")
    p = spark.range(1000).selectExpr("id as poi_id", "'p' as poi_name", "if(id % 2 = 0, 'x', 'y') as category", "id % 5 = 0 as takes_card", "id % 3 = 0 as takes_nfc",
                                     "double(id % 4) as rating", "true as operational", "103.8d as lon", "1.5d + id * 1e-7 as lat")
    members = spark.createDataFrame([("m", "h", 1.0)], "match_key string, preferred_store string, retail_spend double")
    density = plans.radial_density(h, p, 5000)
    summary = plans.catchment_summary(h, p, members, 5000)
    for df, rows in ((density, 2000), (summary, 1000)):
        assert df.count() == rows and "asin(sqrt" not in df._jdf.queryExecution().optimizedPlan().toString().lower()
    assert {tuple(r) for r in density.select("category", "places", "card_places", "nfc_places", "avg_rating").collect()} \
        == {("x", 500, 100, 167, 1), ("y", 500, 100, 167, 2)}
    assert {tuple(r) for r in summary.select("pois", "categories").collect()} == {(1000, 2)}


def test_nearest_places_join_within_their_reach(spark, monkeypatch):
    """The first k of all pairs, without joining all: their radius is told by a grid."""
    from creditlake.plans import geo as plans
    rnd = random.Random(5)
    h = spark.createDataFrame([(i, "h", "s", "r", 100 + rnd.random(), 1 + rnd.random()) for i in range(200)], "hub_id int, hub_name string, state string, region string, lon double, lat double")
    p = spark.createDataFrame([(i, "p", "c", True, True, 1.0, True, 100 + rnd.random(), 1 + rnd.random()) for i in range(2000)],
                              "poi_id int, poi_name string, category string, takes_card boolean, takes_nfc boolean, rating double, operational boolean, lon double, lat double")
    seen, join = [], plans.dwithin_join
    monkeypatch.setattr(plans, "dwithin_join", lambda a, b, metres, *more: seen.append(metres) or join(a, b, metres, *more))
    for k in (20, 300, 10 ** 6):
        whole = plans.near(h, p, 50000.0).select("poi_id", "hub_id", F.round("distance_m", 0).alias("d"))
        want = [(r.d, r.poi_id, r.hub_id) for r in whole.orderBy("d", "poi_id", "hub_id").limit(k).collect()]
        got = [(r.distance_m, r.poi_id, r.hub_id) for r in plans.map_pois(h, p, 50000.0, k).collect()]
        assert got == want
    assert seen[1] < 5000 and seen[3] < 20000 and seen[5] == 50000


def members(spark, seed=1):
    rnd = random.Random(seed)
    rows = {(f"g{rnd.randrange(4)}", f"c{rnd.randrange(40):02d}") for _ in range(90)} | {("solo", "c00")}
    return sorted((g, c, rnd.randrange(100)) for g, c in rows)


def test_first_pairs_are_exact(spark):
    rows = members(spark)
    df = spark.createDataFrame(rows, "g string, c string, v int")
    want = sorted((a[0], a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1])
    for k in (1, 7, 30, 10000):
        got = [(r.g, r.c_1, r.c_2) for r in rings.first_pairs(df, ["g"], "c", ["v"], k).collect()]
        assert got == want[:k]


def test_pair_counts(spark):
    rows = members(spark)
    got = {r.g: (r.n, r.pairs) for r in rings.pair_counts(spark.createDataFrame(rows, "g string, c string, v int").select("g", "c"),
                                                          ["g"], "n", "pairs").collect()}
    size = {}
    for g, _, _ in rows:
        size[g] = size.get(g, 0) + 1
    assert got == {g: (n, n * (n - 1) // 2) for g, n in size.items() if n > 1}


def test_latest_per_is_the_same_in_any_layout(spark):
    rows = [(i % 5, i % 3, i) for i in range(60)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k int, d int, v int").repartition(seed + 1)
        results.add(tuple(sorted(tuple(r) for r in windows.latest_per(df, ["k"], "d", ["v"]).collect())))
    assert len(results) == 1 and len(results.pop()) == 5


def test_totals_lists_and_samples(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "x"), ("b", None)], "k string, t string")
    tot = windows.with_totals(df, n=F.count(F.lit(1)), d=F.count_distinct("t")).first()
    assert (tot.n, tot.d) == (4, 2)
    got = lists.top_list(df, ["k"], F.col("t"), [F.col("t")], 5, "names", distinct=True).collect()
    assert [tuple(r) for r in got] == [("a", "x, y")]
    ids = spark.range(1000)
    sample = lambda n: sorted(r.id for r in topk.hash_sample(ids.repartition(n), "id", 20).collect())
    assert sample(1) == sample(7)


def test_unions(spark):
    a, b = spark.createDataFrame([(1,)], "x int"), spark.createDataFrame([(2, "q")], "x int, y string")
    got = {tuple(r) for r in sets.tagged_union({"A": a, "B": b}, "tag").select("x", "y", "tag").collect()}
    assert got == {(1, None, "A"), (2, "q", "B")}
    assert {tuple(r) for r in sets.labelled_counts({"A": a, "none": b.where("false")}).collect()} == {("A", 1), ("none", 0)}


def test_lookup(spark):
    df = spark.createDataFrame([("7", 1)], "id string, v int")
    assert tuple(lookup.lookup_row(df, "id", "7' or 1=1 --").first())[-1] == "NOT_FOUND"
    assert tuple(lookup.lookup_row(df, "id", "'7'").first()) == ("'7'", None, "NOT_FOUND")
    assert tuple(lookup.lookup_row(df, "id", "7").first()) == ("7", 1, "FOUND")


def test_known_and_orphans(spark):
    e, n = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int"), spark.createDataFrame([(2,), (2,)], "id int")
    assert joins.keep_known(e, n, "k", "id").count() == 2
    assert sorted(str(r.k) for r in joins.orphans(e, n, "k", "id").collect()) == ["1", "None"]
