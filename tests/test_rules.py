"""Rules that a plain run never meets: huge readings, lagging tables, odd stamps, scratch clean-up."""

import os

import pytest
from pyspark.sql import functions as F

from meltemi import session
from meltemi.functions.numeric import round_raw
from meltemi.operators import bronze, gold, monitoring, silver
from meltemi.plans import brief, catalog, report, season
from tests.conftest import SMALL, rows_of

HUGE = 1e12


def test_a_huge_reading_passes_bronze_and_is_clipped_in_silver(frame):
    hours = frame(
        "station_id string, date string, pm2_5 double, pm10 double, nitrogen_dioxide double, ozone double",
        [("a", "2024-01-01", HUGE, 1.23456, 1e35, None), ("b", "2024-01-01", 2.00005, 1.0, 1.0, 1.0)])
    got = {r.station_id: r for r in bronze.hourly_to_daily(hours).collect()}
    assert (got["a"].pm2_5, got["a"].pm10, got["a"].nitrogen_dioxide, got["a"].ozone) == (HUGE, 1.2346, 1e35, None)
    assert got["b"].pm10 == 1.0
    dust = frame("station_id string, date string, dust double", [("a", "d", HUGE), ("b", "d", 1.005)])
    assert rows_of(bronze.dust_to_daily(dust), "station_id", "dust") == [("a", HUGE), ("b", 1.0)]
    ddl = """station_id string, station_name string, city string, country_code string, latitude double, longitude double,
        date string, parameter string, value double"""
    wide = bronze.pivot_measurements(frame(ddl, [
        ("a", "n", "c", "TN", 1.0, 2.0, "2024-01-01", "pm2_5", HUGE), ("a", "n", "c", "TN", 1.0, 2.0, "2024-01-01", "ozone", 5.0)]))
    row = wide.first()
    assert (row.pm2_5, row.ozone, row.pm10) == (HUGE, 5.0, None)
    clean = silver.clean_air(wide.withColumns({"partition_date": F.col("date"), "source": F.lit("openaq")}), "openaq").first()
    assert (clean.pm2_5, clean.ozone) == (1000.0, 5.0)


def test_round_raw_keeps_what_it_cannot_round(frame):
    df = frame("v double", [(0.125,), (1e31,), (float("inf"),), (None,)])
    assert [r.v for r in df.select(round_raw("v", 2).alias("v")).collect()] == [0.12, 1e31, float("inf"), None]


def test_a_row_drop_is_measured_against_the_day_before(frame):
    ddl = "stage string, run_ts timestamp, rows long, duration_seconds double, quality_failures long"
    runs = [("bronze_openmeteo", "2024-01-01 06:00:00", 1000), ("bronze_openmeteo", "2024-01-02 05:00:00", 90),
            ("bronze_openmeteo", "2024-01-02 07:00:00", 100)]
    df = frame(ddl.replace("timestamp", "string"), [(s, t, n, 1.0, 0) for s, t, n in runs]).withColumn("run_ts", F.col("run_ts").cast("timestamp"))
    alerts = monitoring.run_alerts(df, "2024-01-02 08:00:00")
    assert [(r.alert, r.value) for r in alerts.collect()] == [("row_count_drop", 100.0)]
    calm = monitoring.run_alerts(df.filter("run_ts > '2024-01-02'"), "2024-01-02 08:00:00")
    assert calm.collect() == []


def test_failures_alert_per_check_and_layer(frame):
    got = monitoring.quality_alerts(frame("check_name string, layer string, failures long", [("a", "silver", 2), ("a", "bronze", 1), ("b", "gold", 0)]))
    assert rows_of(got, "check_name", "layer", "value") == [("a", "bronze", 1.0), ("a", "silver", 2.0)]


def test_no_country_column_means_no_country(frame):
    without = gold.with_country(frame("station_id string", [("tunis_tn",)])).first()
    blank = gold.with_country(frame("station_id string, country_code string", [("tunis_tn", None)])).first()
    assert (without.country_code, blank.country_code) == (None, "TN")


def test_one_row_per_station_and_date(frame):
    df = frame("station_id string, partition_date string, v int", [("a", "d", 2), ("a", "d", 1), ("a", "e", 3), (None, "d", 4)])
    assert rows_of(gold.one_per_day(df)) == [(None, "d", 4), ("a", "d", 1), ("a", "e", 3)]


def test_lagging_anomalies_give_no_facts(spark):
    anomalies, weather = catalog.report_anomalies(spark, SMALL), catalog.report_weather(spark, SMALL)
    newest = anomalies.agg(F.max("partition_date")).first()[0]
    assert brief.top_anomaly_facts(anomalies, weather, newest).count() == 1
    assert brief.top_anomaly_facts(anomalies, weather, "2031-01-01").collect() == []
    assert report.most_anomalous(anomalies, anomalies.select(F.lit("2031-01-01").alias("partition_date"))).collect() == []


def scans(df, table):
    return df._jdf.queryExecution().executedPlan().toString().count(table)


def test_season_frames_scan_weather_once(spark):
    weather = catalog.report_weather(spark, SMALL)
    assert scans(season.event_days(weather, *season.FOCI.values()), "FileScan") == 1
    # The rows, and the dates twice in the printed plan: joined, and to prune partitions.
    assert scans(season.rank_all(weather, "2024-01-28"), "FileScan") <= 3


def test_scratch_is_deleted(spark, monkeypatch):
    monkeypatch.setattr(session, "_SCRATCH", [])
    path = session.scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.exists(path.removeprefix("file:"))
    session.delete_scratch()
    assert not os.path.exists(path.removeprefix("file:")) and session._SCRATCH == []


def test_an_off_cluster_run_needs_no_folder_but_a_cluster_does(spark, monkeypatch):
    class Far:
        class sparkContext:
            master = "yarn"

        class conf:
            @staticmethod
            def get(*_):
                return None

    with pytest.raises(RuntimeError):
        session.scratch_path(Far, "x")
