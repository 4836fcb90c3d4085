import datetime

from pyspark.sql import functions as F

from creditlake.functions import geo as g
from creditlake.functions import scalars as s


def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_dates(spark):
    rows = spark.createDataFrame([(0,), (20240231,), (20240229,), (None,), (202401,)], "d bigint")
    got = [r[0] for r in rows.select(s.ymd_date("d")).collect()]
    assert got == [None, None, datetime.date(2024, 2, 29), None, None]
    r = one(spark, a=s.ymd_date(F.lit(20240105.0).cast("bigint")), b=s.iso_date(F.lit("2024-01-05 10:00:00")),
            c=s.iso_date(F.lit("x")), k=s.double_key(F.lit(20240101.0)))
    assert r == (datetime.date(2024, 1, 5), datetime.date(2024, 1, 5), None, "20240101")


def test_defaults_and_ratio(spark):
    r = one(spark, blank=s.text_or(F.lit("  "), "D"), null=s.text_or(F.lit(None), "D"), kept=s.text_or(F.lit(" x "), "D"),
            zero=s.ratio(F.lit(1.0), F.lit(0.0)), none=s.ratio(F.lit(1.0), F.lit(None)), ok=s.ratio(F.lit(1.0), F.lit(4.0)))
    assert r == ("D", "D", "x", None, None, 0.25)


def test_labels(spark):
    names = {"A": "one", "B": "two"}
    r = one(spark, a=s.lookup(F.lit("A"), names), z=s.lookup(F.lit("Z"), names), d=s.lookup(F.lit("Z"), names, F.lit("other")),
            b40=s.income_band(F.lit(2999.99)), m40=s.income_band(F.lit(7000)), t20=s.income_band(F.lit(7000.01)),
            m0=s.arrears_bucket(F.lit(0)), m1=s.arrears_bucket(F.lit(30)), m4=s.arrears_bucket(F.lit(91)))
    assert r == ("one", "Z", "other", "B40", "M40", "T20", "M0", "M1", "M4+")


def test_masks_hide_the_value(spark):
    r = one(spark, h=s.mask_sha256(F.lit("AHMAD")), l=s.mask_last4(F.lit(1234567)), z=s.mask_zero(F.lit(9.5)),
            m=s.mask_middle(F.lit("AHMAD ALI")), short=s.mask_middle(F.lit("ALI")))
    assert len(r.h) == 64 and "AHMAD" not in r.h
    assert r.l == "XXXXX4567" and r.z == 0.0 and r.m == "AH****LI" and r.short == "****"


def test_buffer_ring(spark):
    pts = spark.createDataFrame([(101.7, 3.1), (10.0, 60.0), (0.0, -45.0)], "lon double, lat double")
    v = pts.select("lon", "lat", F.explode(g.buffer_ring("lon", "lat", 5000)).alias("v"))
    d = [r[0] for r in v.select(g.distance_m("lon", "lat", F.col("v.lon"), F.col("v.lat"))).collect()]
    assert len(d) == 3 * 37 and all(abs(x - 5000) < 5 for x in d)
    area = [r[0] for r in pts.select(g.ring_area_m2(g.buffer_ring("lon", "lat", 5000, 1))).collect()]
    assert all(abs(a / (3.14159265 * 5000 ** 2) - 1) < 1e-3 for a in area)
    assert one(spark, w=g.wkt(F.lit(200.0), F.lit(0.0))).w is None
