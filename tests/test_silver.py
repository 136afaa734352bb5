from pyspark.sql import functions as F

from meltemi.operators import bronze, silver
from meltemi.schemas import SILVER_AIR
from tests.conftest import rows_of

BRONZE = """station_id string, station_name string, country_code string, latitude double, longitude double,
    date string, pm2_5 double, pm10 double, nitrogen_dioxide double, ozone double, partition_date string"""
DAY = "2024-01-15"
GRID = "latitude double, longitude double, date string, model_pm2_5 double"


def station(name, lat=36.8, lon=10.2, pm25=None, pm10=None, no2=None, o3=None, date=DAY):
    return (name, name.title(), "TN", lat, lon, date, pm25, pm10, no2, o3, DAY)


def test_clean_clips_drops_and_fills_columns(frame):
    df = frame(BRONZE, [
        station("a_tn", pm25=5000.0, pm10=-4.0), station("far", lat=95.0, pm25=1.0), station("edge", lat=90.0, lon=-180.0),
        (None, "x", "TN", 1.0, 1.0, DAY, 1.0, 1.0, 1.0, 1.0, DAY), station("undated", date="soon"),
    ])
    got = silver.clean_air(df.drop("ozone"), "openmeteo")
    assert rows_of(got, "station_id", "pm2_5", "pm10", "ozone", "city", "source") == [
        ("a_tn", 1000.0, 0.0, None, None, "openmeteo"), ("edge", None, None, None, None, "openmeteo")]


def test_enrich_flags_completeness_and_floor(frame):
    df = frame(BRONZE, [station("full", pm25=15.0, pm10=45.1, no2=25.0, o3=100.5), station("one", o3=10.0), station("none")])
    got = silver.enrich_air(df, "now")
    assert rows_of(got, "station_id", "data_completeness", "aqi_category", "who_pm25_exceed", "who_pm10_exceed",
                   "who_no2_exceed", "who_o3_exceed") == [
        ("full", 1.0, "moderate", 0, 1, 0, 1), ("one", 0.25, "unknown", 0, 0, 0, 0)]


def test_an_all_null_city_stays_a_string(frame):
    df = silver.canonical_air(silver.enrich_air(silver.clean_air(frame(BRONZE, [station("a", pm25=1.0)]), "openmeteo"), "now"))
    wanted = [part.split() for part in SILVER_AIR.replace("\n", " ").split(",")]
    kinds = {"long": "bigint"}
    assert [(f.name, f.dataType.simpleString()) for f in df.schema.fields] == [
        (n, kinds.get(t, t)) for n, t in wanted]
    assert df.first().city is None


def test_patch_fills_from_the_grid_and_records_provenance(frame):
    rows = [station("a", 36.80001, 10.2, o3=1.0), station("b", 36.80001, 10.2, o3=2.0), station("own", pm25=7.0),
            station("lost", 40.0, 10.2, o3=3.0)]
    df = frame(BRONZE, rows).withColumn("source", F.lit("openaq"))
    grid = frame(GRID, [(36.8, 10.2, DAY, 9.5), (36.8, 10.2, "2024-01-16", 1.0)])
    got = silver.fill_pm25(df, grid)
    assert rows_of(got, "station_id", "pm2_5", "pm2_5_source") == [
        ("a", 9.5, "model_estimated"), ("b", 9.5, "model_estimated"), ("lost", None, None), ("own", 7.0, "ground_sensor")]


def test_grid_source_is_never_patched(frame):
    df = frame(BRONZE, [station("a", pm25=3.0), station("b", o3=1.0)]).withColumn("source", F.lit("openmeteo"))
    got = silver.fill_pm25(df, frame(GRID, [(36.8, 10.2, DAY, 9.5)]))
    assert rows_of(got, "station_id", "pm2_5", "pm2_5_source") == [("a", 3.0, "model_grid"), ("b", None, None)]


def test_an_empty_grid_keeps_every_row(frame):
    df = frame(BRONZE, [station("a", o3=1.0)]).withColumn("source", F.lit("waqi"))
    assert rows_of(silver.fill_pm25(df, frame(GRID, [])), "station_id", "pm2_5") == [("a", None)]


WEATHER = "station_id string, date string, temp_max_c double, weather_code int, wind_gust_max_kmh double, dust double"


def test_weather_clean_and_labels(frame):
    df = frame(WEATHER, [("tunis_tn", "2026-08-20", 1200.0, 0, 39.0, 50.0), ("rome_it", "2026-08-20", None, 0, 1.0, 1.0),
                         ("cairo_eg", "2026-08-20", 20.0, 42, None, None)])
    got = silver.build_weather(df, "now")
    assert rows_of(got, "station_id", "temp_max_c", "condition", "wind_level", "dust_level", "weather_code") == [
        ("cairo_eg", 20.0, "unknown", "unknown", "unknown", 42), ("tunis_tn", 60.0, "clear", "windy", "high", 0)]


def test_a_missing_weather_code_is_minus_one(frame):
    df = frame(WEATHER, [("a", "2026-08-20", 20.0, None, None, None)])
    assert silver.build_weather(df, "now").first().weather_code == -1


LONG = """station_id string, station_name string, city string, country_code string, latitude double,
    longitude double, date string, parameter string, value double"""


def test_pivot_means_and_null_keys(frame):
    def r(city, parameter, value, name="s"):
        return (name, "S", city, "TN", 1.0, 2.0, DAY, parameter, value)

    df = frame(LONG, [r("T", "pm2_5", 1.0), r("T", "pm2_5", 2.0), r("T", "ozone", -5.0), r(None, "pm10", 4.0, "n")])
    assert rows_of(bronze.pivot_measurements(df), "station_id", "city", "pm2_5", "pm10", "nitrogen_dioxide", "ozone") == [
        ("n", None, None, 4.0, None, None), ("s", "T", 1.5, None, None, None)]
    assert rows_of(bronze.pivot_measurements(df, drop_null_keys=True), "station_id") == [("s",)]


def test_incomplete_ingest_is_refused(frame):
    import pytest

    have, want = frame("station_id string", [("a",)]), frame("station_id string", [("a",), ("b",)])
    assert rows_of(bronze.station_gaps(have, want)) == [("b", "missing")]
    assert rows_of(bronze.station_gaps(want, have)) == [("b", "unexpected")]
    with pytest.raises(RuntimeError, match="incomplete"):
        bronze.require_complete(have, want)
    assert bronze.require_complete(want, want) is want


def test_search_keeps_three_per_query_and_each_station_once(frame):
    hits = frame("query_order int, country_code string, position int, uid long",
                 [(0, "TN", p, u) for p, u in enumerate((1, 2, 3, 4))] + [(1, "DZ", 0, 2), (1, "DZ", 1, 9)])
    assert rows_of(bronze.search_stations(hits), "uid", "query_order") == [(1, 0), (2, 0), (3, 0), (9, 1)]
