"""Golden values of the scalar functions."""

import math
import re

import pytest
from pyspark.sql import functions as F

from airtrack.functions import clock, text
from airtrack.functions.geo import with_lonlat, with_utm


def one(spark, column, **values):
    columns = {name: F.lit(value) for name, value in values.items()}
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).select(column.alias("v")).first()["v"]


def test_utm_golden(spark):
    row = with_utm(
        spark.createDataFrame([(114.0520450097575, 22.520713013248166)], "longitude double, latitude double")
    ).first()
    assert row.utm_x == pytest.approx(-422873.52832781605, abs=1e-6)
    assert row.utm_y == pytest.approx(2518220.7499508113, abs=1e-6)


@pytest.mark.parametrize("zone", [1, 31, 51])
def test_utm_round_trip(spark, zone):
    middle = 6.0 * zone - 183.0
    points = [(middle + dl, lat) for dl in (-9.0, -3.0, 0.0, 2.5, 9.0) for lat in (-80.0, -33.3, 0.0, 22.5, 60.0, 83.9)]
    frame = spark.createDataFrame(points, "longitude double, latitude double")
    back = with_lonlat(with_utm(frame, zone=zone), longitude="lon2", latitude="lat2", zone=zone).collect()
    for row in back:
        assert row.lon2 == pytest.approx(row.longitude, abs=1e-11)
        assert row.lat2 == pytest.approx(row.latitude, abs=1e-11)


@pytest.mark.parametrize(
    "batch, lasting, expected",
    [
        ("92025ㆍ202411261051373704", 1716, 1732589499086),
        ("92025ㆍ20240813132319495", 0, 1723526599495),
        ("92025ㆍ2024", 5, 1704038400000),
        ("92025ㆍ20241399999999999", 5, 1704038400000),
    ],
)
def test_ods_time(spark, batch, lasting, expected):
    assert one(spark, clock.ods_event_ms(F.col("b"), F.col("l")), b=batch, l=lasting) == expected


@pytest.mark.parametrize(
    "batch, lasting, expected",
    [
        ("92025ㆍ202412061458457811", 32, 1733468357),
        ("92025202412061458457811", 32, 1733468357),
        ("92025ㆍ2024", 32, None),
        ("92025ㆍ20241306145845781", 32, None),
    ],
)
def test_event_seconds(spark, batch, lasting, expected):
    assert one(spark, clock.event_seconds(F.col("b"), F.col("l")), b=batch, l=lasting) == expected


def test_takeoff_text(spark):
    assert one(spark, clock.takeoff_text(F.col("b")), b="92025ㆍ20241226174202401") == "2024-12-26 17:42:02"
    assert one(spark, clock.takeoff_text(F.col("b")), b="20241226174202401") is None


def test_partition_columns(spark):
    parts = clock.partition_columns(F.col("t"))
    assert one(spark, F.concat_ws(" ", parts["dt"], parts["hr"]), t=1704038400000) == "2024-01-01 00"
    assert one(spark, F.concat_ws(" ", parts["dt"], parts["hr"]), t=1704038399999) == "2023-12-31 23"


def test_batch_label(spark):
    assert one(spark, clock.batch_label(F.col("t")), t=1733476470) == "1733476470000-1733476471000"


@pytest.mark.parametrize("raw, number, whole", [("5.8", 5.8, 5), ("abc", 0.0, 0), ("", 0.0, 0), ("-7.9", -7.9, -7)])
def test_lenient_casts(spark, raw, number, whole):
    assert one(spark, text.lenient_double(F.col("t")), t=raw) == number
    assert one(spark, text.lenient_int(F.col("t")), t=raw) == whole


def test_inner_json(spark):
    assert one(spark, text.inner_json(F.col("t")), t='"{\\"a\\":1}"') == '{"a":1}'
    assert one(spark, text.inner_json(F.col("t")), t='{"a":1}') is None
    assert one(spark, text.inner_json(F.col("t")), t="not json") is None


def test_strip_control(spark):
    assert one(spark, text.strip_control(F.col("t")), t='{"a":"x\\r\\ny\\nz"\x01\n}') == '{"a":"xyz"}'


def test_heading_is_counter_clockwise_from_east(spark):
    from airtrack.functions.geo import planar_heading

    for dx, dy, expected in ((1.0, 0.0, 0.0), (0.0, 1.0, 90.0), (-1.0, 0.0, 180.0), (0.0, -1.0, 270.0)):
        assert math.isclose(one(spark, planar_heading(F.col("x"), F.col("y")), x=dx, y=dy), expected)


def test_strip_control_of_odd_texts(spark):
    def plain(t):
        return None if t is None else re.sub(r"[\x00-\x1f\x7f]", "", re.sub(r"\\n", "", re.sub(r"\\r", "", re.sub(r"\\r\\n", "", t))))

    texts = [None, "", "a", "ㆍ", "a\nb", "\n", "\x7f", "\x85", "\u2028", "a\\", "\\\\rn", "\\\\r\\nr", "x\\r\\n\x00\\\nn", "é\\ny", "{\"a\": 1}"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.strip_control(F.col("t")).alias("s")).collect()
    assert [r.s for r in got] == [plain(r.t) for r in got]
