from datetime import datetime

import pytest

from octoseg.operators.timestamps import DAY_DOTS_MONTH_SLASHES, normalise

CASES = [
    ("2024-03-31T01:30:00+01:00", None, "2024-03-31 00:30:00"),
    (" 2024-07-01 12:00:00 CEST\t", "Asia/Tokyo", "2024-07-01 10:00:00"),
    ("2024-07-01T12:00:00[America/New_York]", "Asia/Tokyo", "2024-07-01 16:00:00"),
    ("2024-10-27 02:30:00", "Europe/Berlin", "2024-10-27 00:30:00"),  # twice: the first
    ("2024-03-31 02:30:00", "Europe/Berlin", None),  # never
    ("05.07.2024 14:00", "Europe/London", "2024-07-05 13:00:00"),
    ("05/07/2024 12:15 AM", "Asia/Kolkata", "2024-05-06 18:45:00"),
    ("25/12/2024", "UTC", None),
    ("31.12.2024", "Asia/Tokyo", "2024-12-30 15:00:00"),
    ("20240229", "UTC", "2024-02-29 00:00:00"),
    ("20230229", "UTC", None),
    ("1422568560", None, "2015-01-29 21:56:00"),
    ("1424270255825", None, "2015-02-18 14:37:35.825000"),
    ("2015-03-16T21:48:30.259518973Z", None, "2015-03-16 21:48:30.259518"),
    ("Thu, 26 Feb 2015 00:20:47 +1000", None, "2015-02-25 14:20:47"),
    ("28-MAR-2015", "America/Bogota", "2015-03-28 05:00:00"),
    ("20150217T234149", "UTC", "2015-02-17 23:41:49"),
    ("2015-01-25T18:43:07-08", None, "2015-01-26 02:43:07"),
    ("2015-06", "UTC", None),
    ("2015-12-XX", "UTC", None),
    ("2015-01-01 10:00:00 XYZ", "UTC", None),
    ("2015-01-01T10:00:00[No/Where]", "UTC", None),
    ("2015-01-01 10:00", "No/Where", None),
    ("2015-01-01 10:00", None, None),
    ("2015-13-01", "UTC", None),
    ("2015-01-01 24:00:00", "UTC", None),
    ("", "UTC", None),
    (None, "UTC", None),
    ("x" * 50_000, "UTC", None),
]


def us(text):
    return None if text is None else int((datetime.fromisoformat(text) - datetime(1970, 1, 1)).total_seconds() * 1_000_000 + 0.5)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "s" if i % 2 else None, z, "own") for i, (v, z, *_) in enumerate(rows)], "i int, v string, src string, zone string, state string")


def test_notations(spark):
    got = {r["i"]: r["utc_us"] for r in normalise(frame(spark, CASES), "v", "src", "zone", DAY_DOTS_MONTH_SLASHES).collect()}
    for i, (v, z, want) in enumerate(CASES):
        assert got[i] == us(want), (v, z)


def test_empty_and_repeated(spark):
    assert normalise(frame(spark, []), "v", "src", "zone").count() == 0
    assert normalise(frame(spark, [("2024-01-01", "UTC")] * 3), "v", "src", "zone").where("state = 'ok'").count() == 3


def test_mixture_decides_or_says_it_cannot(spark):
    day_first = [(f"{d:02d}/06/2024", "UTC") for d in range(1, 29)]
    df = spark.createDataFrame([(i, v, "day", z) for i, (v, z) in enumerate(day_first)] + [(100, "03/04/2024", "none", "UTC"), (101, "04/04/2024", "none", "UTC")], "i int, v string, src string, zone string")
    got = {r["i"]: r for r in normalise(df, "v", "src", "zone").collect()}
    assert got[2]["utc_us"] == us("2024-06-03") and got[2]["posterior"] > 0.9
    assert got[100]["state"] == "ambiguous" and got[100]["utc_us"] is None and got[100]["posterior"] == pytest.approx(0.5)
    assert got[101]["state"] == "ok"  # both readings agree
