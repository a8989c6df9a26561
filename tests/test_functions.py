import math
import random

import pytest
from pyspark.sql import functions as F

from fleetgrid.functions.cells import cell_number, geohash
from fleetgrid.functions.numbers import number, with_numbers
from fleetgrid.functions.slots import (
    calendar_date,
    clock,
    hour_start,
    interval_label,
    minute_start,
    with_clocks,
    with_minutes,
)

ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"


def bisected(lat, lon):
    """Geohash by halving intervals; the upper half needs a strictly larger value."""
    if lat is None or lon is None:
        return None
    ranges = {"lon": [-180.0, 180.0], "lat": [-90.0, 90.0]}
    bits = ""
    for i in range(30):
        axis, value = ("lat", lat) if i % 2 else ("lon", lon)
        low, high = ranges[axis]
        middle = (low + high) / 2
        upper = value > middle
        ranges[axis] = [middle, high] if upper else [low, middle]
        bits += "1" if upper else "0"
    return "".join(ALPHABET[int(bits[i : i + 5], 2)] for i in range(0, 30, 5))


def cells(spark, points):
    df = spark.createDataFrame(points, "lat string, lon string")
    df = with_numbers(df, "lat", "lon")
    df = df.select("lat", "lon", geohash(cell_number(number("lat"), number("lon"))).alias("g"))
    return df.collect()


def test_known_cells(spark):
    points = [
        ("57.64911", "10.40744"),
        ("40.7128", "-74.0060"),
        ("0", "0"),
        ("90", "180"),
        ("NaN", "10"),
        ("abc", "1"),
        (None, "1"),
        ("", "1"),
        ("1", "abc"),
        ("1", None),
        ("inf", "1"),
        ("nan", "1"),
    ]
    assert [r.g for r in cells(spark, points)] == [
        "u4pruy", "dr5reg", "7zzzzz", "zzzzzz", "h0p058", *[None] * 7,
    ]


def test_cells_match_bisection(spark):
    rng = random.Random(7)
    special = [0.0, -0.0, 5e-324, -5e-324, 1e-300, math.inf, -math.inf, math.nan, 1e300]
    points = []
    for _ in range(6000):
        points.append((rng.uniform(-91, 91), rng.uniform(-181, 181)))
    for _ in range(6000):
        edges = -90 + rng.randrange(32769) * 45 / 8192, -180 + rng.randrange(32769) * 45 / 4096
        points.append(tuple(rng.choice([e, math.nextafter(e, 1e9), math.nextafter(e, -1e9)]) for e in edges))
    points += [(a, b) for a in special for b in special]
    texts = [tuple("NaN" if math.isnan(v) else repr(v).replace("inf", "Infinity") for v in p) for p in points]
    found = cells(spark, texts)
    for (lat, lon), row in zip(points, found):
        assert row.g == bisected(lat, lon), (lat, lon)


def test_numbers(spark):
    texts = ["1.5", " 2 ", "1e3", "1d", "NaN", "Infinity", "-Infinity", "1e999", "nan", "inf",
             "INFINITY", "+inf", "", "x", "1,5", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in with_numbers(df, "t").select(number("t")).collect()]
    assert got[:4] == [1.5, 2.0, 1000.0, 1.0]
    assert math.isnan(got[4])
    assert got[5:8] == [math.inf, -math.inf, math.inf]
    assert got[8:] == [None] * 8


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_slots(spark, zone):
    expected = {
        "2015-09-01 00:02:34": ("2015-09-01", "0-1", "0-10"),
        "2015-09-01 23:55:00": ("2015-09-01", "23-24", "50-60"),
        "2015-09-01 07:09:59": ("2015-09-01", "7-8", "0-10"),
        "2015-09-01 07:10:00": ("2015-09-01", "7-8", "10-20"),
        "2015-03-08 02:30:00": ("2015-03-08", "2-3", "30-40"),
        "2015-09-01 07:10:00.987": ("2015-09-01", "7-8", "10-20"),
        "2015-09-01 07:10:300": ("2015-09-01", "7-8", "10-20"),
        "2015-9-1 1:2:3": ("2015-09-01", "1-2", "0-10"),
        "2015-13-45 25:61:61": (None, "25-26", "60-70"),
        "2015-09-01 25:00:00": ("2015-09-01", "25-26", "0-10"),
        "2015-09-01T07:10:00": ("2015-09-01", None, None),
        "2015-09-01": ("2015-09-01", None, None),
        "2015-09-01 07": ("2015-09-01", "7-8", None),
        "2015-09-01  07:10:00": ("2015-09-01", None, None),
        "x 5:17": (None, "5-6", "10-20"),
        "x -5:-17": (None, "-5--4", "-10-0"),
        "oops": (None, None, None),
        "": (None, None, None),
        None: (None, None, None),
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = with_clocks(spark.createDataFrame([(t,) for t in expected], "t string"), "t")
        out = df.select(
            "t",
            calendar_date(F.col("t")).cast("string"),
            interval_label(hour_start(F.col("t"), clock("t")), 1),
            interval_label(minute_start(F.col("t"), clock("t")), 10),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {r[0]: tuple(r)[1:] for r in out} == expected


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_minutes(spark, zone):
    noon = "2015-09-01 12:00:00"
    expected = {
        (noon, "2015-09-01 12:10:06"): 10,
        (noon, "2015-09-01 12:00:30"): 0,
        (noon, "2015-09-01 11:55:00"): -5,
        (noon, "2015-09-01 11:59:30"): 0,
        (noon, "2015-09-01 11:58:01"): -1,
        (noon, "2015-09-01 12:10:00.999"): 10,
        (noon, "2015-09-01 12:10:00 trailing"): 10,
        (noon, "2015-9-1 12:5:0"): 5,
        (noon, "2015-09-01 12:00:300"): 5,
        (noon, "2015-09-01 36:00:00"): 24 * 60,
        (noon, "2015-08-32 12:00:00"): 0,
        (noon, "2014-21-01 12:00:00"): 0,
        (noon, "2015-10-00 12:00:00"): 29 * 24 * 60,
        ("2015-13-45 25:61:61", "2016-02-15 02:02:01"): 0,
        ("1969-12-31 23:59:59", "1970-01-01 00:01:00"): 1,
        # A night with a clock change: wall-clock time in any session zone.
        ("2015-03-08 01:30:00", "2015-03-08 03:30:00"): 120,
        ("2015-03-08 01:30:00", "2015-03-08 02:30:00"): 60,
        (noon, "2015-09-01T12:10:00"): None,
        (noon, "2015-09-01"): None,
        (noon, "2015-09-01 12:10"): None,
        (noon, "12015-09-01 12:10:00"): 10_000 * 365_2425 // 10_000 * 24 * 60 + 10,
        (noon, "2015-09-01 12:-5:00"): -5,
        (noon, "2015-09--1 12:00:00"): -2 * 24 * 60,
        (noon, "2015-09-01 12:00:6000000"): 100_000,
        (noon, "2015-09-01 0012:0000000010:00"): 10,
        ("-1-1-1 0:0:0", "0-01-01 00:00:00"): 365 * 24 * 60,
        (noon, "2015-09-01 12:00:99999999999999999999"): None,
        (noon, "9223372036854775807-01-01 00:00:00"): None,
        (noon, "oops"): None,
        (noon, ""): None,
        (noon, None): None,
        (None, noon): None,
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame(list(expected), "a string, b string")
        out = with_minutes(with_clocks(df, "a", "b"), "m", "a", "b").select("a", "b", "m").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert {(r.a, r.b): r.m for r in out} == expected
