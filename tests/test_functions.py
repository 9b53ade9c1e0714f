"""Column functions on hand-written values."""

import datetime as dt
import math
import statistics
import struct

import pytest
from pyspark.sql import functions as F

from citypulse.functions import dates, people, points, values
from citypulse.ml.quantile import inverse_normal, normal_score, share_below


def column_of(spark, data, kind, expression):
    """Values of an expression over one column, in input order."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}").coalesce(1)
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v")).alias("o")).collect()]


def test_lenient_double(spark):
    texts = ["1.5", " 2 ", "", None, "x", "1e3", "nan", "NaN", "1d", "2F", "1_000", "-3", "inf"]
    found = column_of(spark, texts, "string", values.lenient_double)
    assert found == [1.5, 2.0, 0.0, 0.0, 0.0, 1000.0, 0.0, 0.0, 0.0, 0.0, 0.0, -3.0, 0.0]


def test_optional_double(spark):
    assert column_of(spark, ["1", "", None, "x", "-0.5"], "string", values.optional_double) == [1.0, None, None, None, -0.5]


def test_integer_text(spark):
    texts = ["0012", "12.7", "-0.5", "abc", "", None, "1e2", "99999999999999999999"]
    assert column_of(spark, texts, "string", values.integer_text) == ["12", "12", "0", None, None, None, "100", None]
    assert column_of(spark, [123.0, None], "double", values.cell_id_text) == ["123", None]


def test_district_code(spark):
    assert column_of(spark, ["46130510", " 7 "], "string", values.district_code) == ["4613051000", "700"]


ADDRESSES = [
    # road, legal, main, sub, mountain, expected
    ("4613", "99", "12", "3", "1", "4613-12-3"),
    ("4613", "99", "0012", "0", None, "4613-12-0"),
    ("4613", "99", "12", " ", "2", "4613-S12"),
    ("4613", "99", "12", None, "2.0", "4613-S12"),
    (" ", "99", "12", "x", "?", "99-12"),
    (None, "99", "12.7", "5", "1", "99-12-5"),
    (None, None, "12", "5", "1", "undefined"),
    ("abc", "99", "12", "5", "1", "undefined"),
    ("4613", "99", "", "5", "1", "undefined"),
    ("4613", "99", None, "5", "1", "undefined"),
    ("4613", "99", "abc", "5", "1", "undefined"),
]


def test_address_key(spark):
    df = spark.createDataFrame(ADDRESSES, "a string, b string, c string, d string, e string, expected string")
    found = df.select("expected", values.address_key(*[F.col(c) for c in "abcde"]).alias("key")).collect()
    assert [r.key for r in found] == [r.expected for r in found]


def test_not_in_keeps_nulls(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "v string")
    assert {r.v for r in df.filter(values.not_in_keep_nulls(F.col("v"), ["a"])).collect()} == {None, "b"}


def test_clip_at_zero(spark):
    assert column_of(spark, [-1.0, 2.0, None], "double", values.clip_at_zero) == [0.0, 2.0, None]


def test_date_from_text(spark):
    texts = ["2025-01-31", "20250131", "202501", " 20250131\t"]
    day = dt.date(2025, 1, 31)
    assert column_of(spark, texts, "string", dates.date_from_text) == [day, day, dt.date(2025, 1, 1), day]
    lenient = column_of(spark, ["2025", None, "20250230", "x"], "string", lambda c: dates.date_from_text(c, "null"))
    assert lenient == [None] * 4
    for bad in ("2025", "20251340", None):
        with pytest.raises(Exception, match="unrecognised date text"):
            column_of(spark, [bad], "string", dates.date_from_text)


def test_month_bounds():
    assert dates.month_bounds("202512") == (dt.date(2025, 12, 1), dt.date(2026, 1, 1))
    assert dates.month_bounds("202501") == (dt.date(2025, 1, 1), dt.date(2025, 2, 1))


def test_slot_and_calendar(spark):
    df = spark.createDataFrame([("20250103", "7"), ("20250105", "23")], "d string, h string")
    slots = df.select(dates.slot_timestamp(F.col("d"), F.col("h")).alias("ts"))
    found = slots.select(F.date_format("ts", "yyyy-MM-dd HH").alias("ts"), *[c.alias(n) for n, c in dates.calendar_features(F.col("ts")).items()])
    assert [tuple(r) for r in found.collect()] == [("2025-01-03 07", 1, 7, "Friday", 1), ("2025-01-05 23", 1, 23, "Sunday", 1)]


def test_age_on(spark):
    rows = [
        (dt.date(2025, 2, 28), dt.date(2000, 2, 29), 24),
        (dt.date(2025, 3, 1), dt.date(2000, 2, 29), 25),
        (dt.date(2025, 5, 5), dt.date(2000, 5, 5), 25),
        (dt.date(2025, 5, 4), dt.date(2000, 5, 5), 24),
        (None, dt.date(2000, 5, 5), None),
        (dt.date(2025, 5, 4), None, None),
    ]
    df = spark.createDataFrame(rows, "d date, b date, expected int")
    assert all(r[0] == r[1] for r in df.select("expected", dates.age_on(F.col("d"), F.col("b"))).collect())


def test_age_band_edges(spark):
    ages = [9, 10, 11, 20, 21, 70, 71, 200, 201, None]
    names = people.AGE_BAND_LABELS
    assert column_of(spark, ages, "int", people.age_band) == [
        None, None, names[0], names[0], names[1], names[5], names[6], names[6], None, None,
    ]
    shifted = column_of(spark, ages, "int", lambda c: people.age_band(c, left_closed=True))
    assert shifted == [None, names[0], names[0], names[1], names[1], names[6], names[6], None, None, None]


def test_sex_age_decade(spark):
    ids = ["0001011000001", "9912312000001", "250101", None, "2501013000001"]
    assert column_of(spark, ids, "string", people.sex_from_id) == ["M", "F", "F", "F", "M"]
    as_of = dt.date(2025, 6, 1)
    assert column_of(spark, ids, "string", lambda c: people.age_from_id(c, as_of)) == [25, 26, 0, None, 0]
    assert column_of(spark, [0, 9, 10, 99, None], "int", people.age_decade) == ["0", "0", "10", "90", None]


def wkb(lon, lat, order="<", srid=None, code=1):
    head = b"\x01" if order == "<" else b"\x00"
    kind = code | (0x20000000 if srid is not None else 0)
    body = struct.pack(order + "I", kind) + (struct.pack(order + "I", srid) if srid is not None else b"")
    return head + body + struct.pack(order + "dd", lon, lat)


def test_wkb_points(spark):
    places = [(127.662289, 34.760448), (-0.1, 0.0), (1e-310, -5.5e300), (0.1 + 0.2, 2.0**-1022)]
    blobs = [wkb(*p, order=o, srid=s) for p in places for o in "<>" for s in (None, 4326)]
    expected = [p for p in places for _ in range(4)]
    found = column_of(spark, [b.hex() for b in blobs], "string", points.wkb_point)
    assert [(r.lon, r.lat) for r in found] == expected
    found = column_of(spark, [bytearray(b) for b in blobs], "binary", points.wkb_point_from_bytes)
    assert [(r.lon, r.lat) for r in found] == expected


def test_wkb_that_is_no_point(spark):
    bad = [None, "", "zz", "01", wkb(1, 2).hex()[:-2], wkb(1, 2, code=2).hex(), wkb(math.nan, math.nan).hex(), "02" + wkb(1, 2).hex()[2:]]
    assert column_of(spark, bad, "string", points.wkb_point) == [None] * len(bad)


def test_metric_projection(spark):
    places = [(127.5, 38.0), (127.662289, 34.760448), (128.6, 35.9), (126.1, 33.2)]
    df = spark.createDataFrame(places, "lon double, lat double")
    x, y = points.to_metric(F.col("lon"), F.col("lat"))
    lon, lat = points.to_degrees(F.col("x"), F.col("y"))
    rows = df.withColumns({"x": x, "y": y}).withColumns({"lon2": lon, "lat2": lat}).collect()
    assert (rows[0].x, round(rows[0].y, 6)) == (1_000_000.0, 2_000_000.0)
    for r in rows:
        assert abs(r.lon - r.lon2) < 1e-10 and abs(r.lat - r.lat2) < 1e-10


def test_metric_projection_along_the_central_meridian(spark):
    """Northings there are the scaled meridian arc, integrated numerically."""
    e2 = points.FLATTENING * (2 - points.FLATTENING)

    def arc(a, b, steps=20_000):
        h = math.radians(b - a) / steps
        at = [math.radians(a) + (i + 0.5) * h for i in range(steps)]
        return sum(points.SEMI_MAJOR * (1 - e2) / (1 - e2 * math.sin(t) ** 2) ** 1.5 for t in at) * h

    df = spark.createDataFrame([(34.0,)], "lat double")
    x, y = points.to_metric(F.lit(points.ORIGIN_LON), F.col("lat"))
    found = df.select(x.alias("x"), y.alias("y")).first()
    assert found.x == 1_000_000.0
    assert abs(found.y - (2_000_000.0 - points.SCALE * arc(34.0, 38.0))) < 1e-3


def test_inverse_normal(spark):
    shares = [1e-7, 0.001, 0.02, 0.3, 0.5, 0.9, 0.98, 0.9999999]
    normal = statistics.NormalDist()
    for p, z in zip(shares, column_of(spark, shares, "double", inverse_normal)):
        assert abs(z - normal.inv_cdf(p)) < 1e-7


def test_share_among_quantiles(spark):
    numpy = pytest.importorskip("numpy")
    knots = [0.0, 1.0, 1.0, 1.0, 2.0, 5.0, 5.0, 9.0, 9.0]
    xs = [-1.0, 0.0, 0.5, 1.0, 1.5, 2.0, 4.9, 5.0, 7.0, 9.0, 10.0]
    refs = numpy.linspace(0, 1, len(knots))
    right = numpy.interp(xs, knots, refs)
    left = -numpy.interp(-numpy.array(xs), -numpy.array(knots[::-1]), -refs[::-1])
    expected = (left + right) / 2
    expected[numpy.array(xs) >= knots[-1]] = 1.0
    expected[numpy.array(xs) <= knots[0]] = 0.0
    found = column_of(spark, xs, "double", lambda c: share_below(c, knots))
    assert numpy.allclose(found, expected)
    scores = column_of(spark, [None, -1.0, 10.0], "double", lambda c: normal_score(c, knots))
    assert scores[0] is None and abs(scores[1] + 5.1993) < 1e-3 and abs(scores[2] - 5.1993) < 1e-3
