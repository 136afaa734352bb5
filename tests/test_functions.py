import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meltemi.functions import dates, geo, labels, numeric
from meltemi.operators.places import near_known_city, report_countries


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize(
    ("pm25", "label"),
    [(0.0, "good"), (12.0, "good"), (12.1, "moderate"), (35.4, "moderate"), (35.5, "unhealthy_sensitive"),
     (55.4, "unhealthy_sensitive"), (55.5, "unhealthy"), (150.4, "unhealthy"), (150.5, "very_unhealthy"),
     (250.4, "very_unhealthy"), (250.5, "hazardous"), (999.0, "hazardous"), (None, "unknown")],
)
def test_aqi_edges_are_upper_inclusive(spark, pm25, label):
    assert one(spark, labels.aqi_category(F.lit(pm25).cast("double"))) == label


@pytest.mark.parametrize(("gust", "label"), [(19.9, "calm"), (20.0, "breezy"), (39.0, "windy"), (62.0, "gale"),
                                             (89.0, "storm"), (None, "unknown")])
def test_wind_bands_are_left_closed(spark, gust, label):
    assert one(spark, labels.wind_level(F.lit(gust).cast("double"))) == label


@pytest.mark.parametrize(("dust", "label"), [(0.0, "none"), (20.0, "moderate"), (50.0, "high"), (200.0, "severe"),
                                             (None, "unknown")])
def test_dust_bands_are_left_closed(spark, dust, label):
    assert one(spark, labels.dust_level(F.lit(dust).cast("double"))) == label


@pytest.mark.parametrize(("score", "label"), [(25.0, "low"), (25.1, "moderate"), (50.0, "moderate"), (75.0, "high"),
                                              (75.1, "extreme")])
def test_risk_levels_are_right_closed(spark, score, label):
    assert one(spark, labels.risk_level(F.lit(score))) == label


@pytest.mark.parametrize(("code", "label"), [(0, "clear"), (48, "fog"), (82, "rain"), (99, "thunderstorm"),
                                             (4, "unknown"), (None, "unknown")])
def test_weather_codes(spark, code, label):
    assert one(spark, labels.wmo_condition(F.lit(code).cast("double"))) == label


def test_worst_ignores_labels_outside_the_order(frame):
    order = ("unknown", "clear", "rain")
    df = frame("k string, v string", [("a", "clear"), ("a", "rain"), ("a", "frogs"), ("b", "frogs"), ("c", None)])
    got = {r.k: r.w for r in df.groupBy("k").agg(labels.worst(F.col("v"), order).alias("w")).collect()}
    assert got == {"a": "rain", "b": "unknown", "c": "unknown"}


def test_clip_keeps_null(spark):
    assert one(spark, numeric.clip(F.lit(None).cast("double"), 0.0, 10.0)) is None
    assert one(spark, numeric.clip(F.lit(-3.0), 0.0, 10.0)) == 0.0
    assert one(spark, numeric.clip(F.lit(30.0), high=10.0)) == 10.0


def test_text_and_nan_become_null(frame):
    got = frame("v string", [("1.5",), ("n/a",), ("NaN",), (None,)]).select(numeric.to_double("v").alias("x")).collect()
    assert [r.x for r in got] == [1.5, None, None, None]


def test_the_two_rounding_rules_differ_on_ties(spark):
    assert one(spark, numeric.round_even(F.lit(0.125), 2)) == 0.12
    assert one(spark, numeric.round_up(F.lit(0.125), 2)) == 0.13


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e4, 1e4)), min_size=1, max_size=30))
def test_clip_stays_inside_bounds(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", numeric.clip("v", -5.0, 7.0).alias("c")).collect():
        assert (row.c is None) == (row.v is None)
        assert row.c is None or row.c == min(max(row.v, -5.0), 7.0)


def test_dates(spark):
    assert one(spark, dates.iso_date(F.lit("2024-01-15T06:00:00"))) == "2024-01-15"
    assert one(spark, dates.iso_date(F.lit("2024-13-45"))) is None
    assert one(spark, dates.season_of(F.lit(None).cast("date"))) is None
    months = {1: "winter", 2: "winter", 3: "spring", 5: "spring", 6: "summer", 8: "summer", 9: "autumn", 11: "autumn",
              12: "winter"}
    for month, name in months.items():
        assert one(spark, dates.season_of(F.lit(f"2024-{month:02d}-10").cast("date"))) == name


def test_partition_date_lists():
    assert dates.parse_dates("2026-06-04 2026-06-05,2026-06-04") == ["2026-06-04", "2026-06-05"]
    with pytest.raises(ValueError):
        dates.parse_dates("2026-13-01")


def test_distance_between_two_capitals(spark):
    km = one(spark, geo.haversine_km(F.lit(37.98), F.lit(23.73), F.lit(30.06), F.lit(31.24)))
    assert 1050 < km < 1200


def _plain_km(lat1, lon1, lat2, lon2):
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2
    b = math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371 * math.asin(math.sqrt(a + b))


def test_near_city_agrees_with_distance(frame):
    from meltemi.settings import CITY_ANCHORS

    points = [("EG", 30.06 + i / 10, 31.24 + j / 10) for i in range(-12, 13, 3) for j in range(-12, 13, 3)]
    points += [("GR", 33.95, -83.38), ("EG", 38.8, -77.1), ("FR", 0.0, 0.0), ("eg", 31.2, 29.92)]
    df = frame("cc string, lat double, lon double", points)
    got = df.select("cc", "lat", "lon", near_known_city(F.col("lat"), F.col("lon"), F.col("cc")).alias("near")).collect()
    for r in got:
        anchors = CITY_ANCHORS.get(r.cc.upper())
        want = not anchors or any(_plain_km(r.lat, r.lon, *a) <= 100 for a in anchors)
        assert r.near == want, r


def test_missing_coordinates_are_rejected_only_where_anchors_exist(frame):
    df = frame("cc string, lat double, lon double",
               [("EG", None, 31.2), ("EG", float("nan"), 31.2), ("FR", None, None), (None, None, None)])
    near = near_known_city(F.col("lat"), F.col("lon"), F.col("cc"))
    assert [r.n for r in df.select(near.alias("n")).collect()] == [False, False, True, True]


def test_report_filter_judges_only_the_station_feed_by_distance(frame):
    df = frame(
        "country_code string, source string, station_name string, latitude double, longitude double",
        [("EG", "waqi", "Fairfax", 38.8, -77.1), ("EG", "waqi", "Cairo", 30.05, 31.25),
         ("GR", "openaq", "Thessaloniki", 40.64, 22.94), ("CL", "openaq", "Santiago", -33.4, -70.6),
         (None, "openmeteo", "grid", 1.0, 1.0)],
    )
    kept = {r.station_name for r in report_countries(df).collect()}
    assert kept == {"Cairo", "Thessaloniki", "grid"}
