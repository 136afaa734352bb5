import json

import pytest
from pyspark.sql import functions as F

from meltemi.plans import brief, catalog, report, season
from tests.conftest import SMALL, rows_of

COVERAGE = "partition_date string, station_days long"


def test_readiness_flags_a_jump_and_accepts_early_dates(frame):
    counts = [20, 22, 21, 19, 20, 21, 100]
    df = frame(COVERAGE, [(f"2026-06-{i + 1:02d}", c) for i, c in enumerate(counts)])
    got = report.mark_readiness(df).orderBy("partition_date").collect()
    assert [r.is_reporting_ready for r in got] == [True] * 6 + [False]
    assert got[2].coverage_ratio is None and got[6].coverage_baseline_station_days == 20.5
    assert got[6].coverage_ratio == 4.878


def test_readiness_needs_as_many_prior_dates_as_a_short_lookback_allows(frame):
    df = frame(COVERAGE, [("a", 10), ("b", 10), ("c", 100)])
    assert [r.is_reporting_ready for r in report.mark_readiness(df, lookback=1).orderBy("partition_date").collect()] == [
        True, True, False]


SUMMARY = "partition_date string, country_code string, source string, station_count long"


def test_coverage_lists_sources_and_leaves_null_out(frame):
    df = frame(SUMMARY, [("d", "TN", "waqi", 1), ("d", None, "openaq", 2), ("d", "TN", None, 3), (None, "TN", "openaq", 9)])
    assert rows_of(report.coverage_by_date(df)) == [("d", 6, 1, 2, "openaq, waqi")]


def test_latest_dates_need_a_positive_count(frame):
    df = frame(SUMMARY, [(f"2026-06-{i:02d}", "TN", "openaq", 5) for i in range(1, 6)])
    assert [r.partition_date for r in report.latest_reporting_dates(df, 2).collect()] == ["2026-06-04", "2026-06-05"]
    with pytest.raises(ValueError):
        report.latest_reporting_dates(df, 0)


def test_rates_leave_the_index_source_out(frame):
    df = frame("partition_date string, source string, is_anomaly long",
               [("a", "openaq", 1), ("a", "openaq", 0), ("a", "openmeteo", 0), ("a", "waqi", 1), ("b", "waqi", 1)])
    assert rows_of(report.anomaly_daily_rates(df)) == [("a", 1, 3, 33.33)]


def test_histogram_of_one_value_and_of_the_maximum(frame):
    df = frame("k string, v double", [("flat", 3.0), ("flat", 3.0), ("wide", 0.0), ("wide", 1.0), ("wide", 9.99), ("wide", 10.0)])
    assert rows_of(report.histogram(df, ["k"], "v", F.lit(10)), "k", "bin", "rows") == [
        ("flat", 5, 2), ("wide", 0, 1), ("wide", 1, 1), ("wide", 9, 2)]


WEATHER = """partition_date string, country_code string, temp_max_c double, temp_min_c double, condition string,
    heat_alert string, heat_streak_days long, cold_alert string, cold_streak_days long, precipitation_mm double,
    dust double, dust_level string"""


HIGHS = [33.0, 29.5, 30.0, 36.5, 35.0, 37.0, 39.0, 40.5, 41.0, 42.5, 41.5]


def history(cold_on=None):
    """Eleven August days: TN warms into a wave, GR never changes and measures no dust."""
    rows = []
    for i, high in enumerate(HIGHS):
        day = f"2026-08-{10 + i}"
        cold = "cold_advisory" if day == cold_on else "none"
        rows.append((day, "TN", high, high - 11, "clear", "extreme_heatwave" if i >= 8 else "none", max(0, i - 5), cold, 0,
                     0.5 * i, 5.0 + i, "none"))
        rows.append((day, "GR", 30.0, 20.0, "cloudy", "none", 0, "none", 0, 0.0, None, "unknown"))
    return rows


def test_profile_covers_the_last_ten_rows(frame):
    got = {r.country_code: r for r in brief.weather_profile(frame(WEATHER, history()), "2026-08-20").collect()}
    tn, gr = got["TN"], got["GR"]
    assert (tn.date, tn.days_of_history, tn.high_c, tn.low_c, tn.day_night_range_c) == ("2026-08-20", 10, 41.5, 30.5, 11.0)
    assert (tn.window_highest_c, tn.window_high_spread_c) == (42.5, 13.0)  # the first day's 33 degrees are outside
    assert (tn.biggest_day_to_day_change_c, tn.biggest_change_on) == (6.5, "2026-08-13")
    assert (tn.rain_today_mm, tn.window_rain_total_mm, tn.window_dust_peak) == (5.0, 27.5, 15.0)
    assert (tn.heat_alert, tn.heat_streak_days, tn.swung_between_heat_and_cold) == ("extreme_heatwave", 5, False)
    records = json.loads(tn.days)
    assert [r["date"] for r in records] == [f"2026-08-{d}" for d in range(11, 21)] and records[0]["high_c"] == 29.5
    assert gr.biggest_change_on == "2026-08-12" and gr.window_dust_peak is None  # a tie goes to the first day


def test_profile_flags_both_kinds_of_alert_and_stops_at_its_day(frame):
    def tn(cold_on, day):
        return brief.weather_profile(frame(WEATHER, history(cold_on)), day).filter("country_code = 'TN'").first()

    assert tn("2026-08-12", "2026-08-20").swung_between_heat_and_cold
    assert not tn("2026-08-10", "2026-08-20").swung_between_heat_and_cold
    assert not tn("2026-08-12", "2026-08-15").swung_between_heat_and_cold
    assert (tn(None, "2026-08-15").date, tn(None, "2026-08-15").high_c) == ("2026-08-15", 37.0)


def test_focus_follows_the_season_unless_a_wave_is_on(frame):
    df = frame(WEATHER, history())
    got = {r.partition_date: r.focus for r in season.focus_by_day(df).collect()}
    assert set(got.values()) == {"heat"}
    october = frame(WEATHER, [("2026-10-05", "TN", 41.0, 20.0, "clear", "heatwave", 3, "none", 0, 0.0, 0.0, "none"),
                              ("2026-10-06", "TN", 20.0, 1.0, "clear", "none", 0, "cold_wave", 3, 0.0, 0.0, "none"),
                              ("2026-10-07", "TN", 20.0, 9.0, "clear", "heat_advisory", 1, "none", 0, 0.0, 0.0, "none")])
    assert [season.focus_for(october, d).name for d in ("2026-10-05", "2026-10-06", "2026-10-07", "2026-04-01")] == [
        "heat", "cold", "rain", "dust"]


def test_events_and_ranking(frame):
    df = frame(WEATHER, [("2026-10-05", "TN", 1.0, 1.0, "rain", "none", 0, "none", 0, 10.0, 0.0, "high"),
                         ("2026-10-06", "TN", 1.0, 1.0, "rain", "none", 0, "none", 0, 9.9, 0.0, "moderate"),
                         ("2026-10-06", "GR", 1.0, -1.0, "rain", "none", 0, "none", 0, None, 0.0, None)])
    assert rows_of(season.event_days(df, season.FOCI["rain"])) == [("rain", "TN", 1)]
    assert rows_of(season.event_days(df, season.FOCI["dust"])) == [("dust", "TN", 1)]
    ranked = season.rank_countries(df, season.FOCI["rain"], "2026-10-06").collect()
    assert [(r.country_code, r.value) for r in ranked] == [("TN", 9.95)]
    assert [r.country_code for r in season.rank_countries(df, season.FOCI["cold"], "2026-10-06").collect()] == ["GR", "TN"]
    assert (season.FOCI["rain"].rank_days, season.FOCI["rain"].unit, season.FOCI["rain"].lowest_first) == (10, "mm", False)


def test_written_diagnostics_and_brief(spark, frame, tmp_path):
    summary = frame(SUMMARY, [("2026-06-01", "TN", "openaq", 5), ("2026-06-02", "TN", "waqi", 6)])
    anomalies = frame("partition_date string, source string, is_anomaly long", [("2026-06-01", "openaq", 1)])
    report.write_diagnostics(report.readiness_diagnostics(summary, anomalies), str(tmp_path / "csv"))
    got = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert rows_of(got, "partition_date", "station_days", "anomaly_flags", "rows") == [
        ("2026-06-01", "5", "1", "1"), ("2026-06-02", "6", "0", "0")]
    day = frame(WEATHER, history()).filter("partition_date = '2026-08-20'").selectExpr(
        "*", "null as temp_mean_c", "null as apparent_temp_max_c", "'calm' as wind_level", "1.26D as wind_gust_max_kmh",
        "null as humidity_pct")
    brief.write_brief(brief.weather_facts(day), str(tmp_path / "json"))
    facts = {r["country_code"]: r for r in map(json.loads, (r.value for r in spark.read.text(str(tmp_path / "json")).collect()))}
    assert facts["TN"]["temp_max_c"] == 41.5 and facts["TN"]["wind_gust_max_kmh"] == 1.3
    assert "temp_mean_c" not in facts["TN"] and "dust" not in facts["GR"]


def test_spotlight_names_the_leader(frame):
    got = brief.spotlight(frame(WEATHER, history()), "2026-08-20").collect()
    assert [(r.country_code, r.focus, r.value) for r in got] == [("TN", "heat", 41.5)]


def test_top_anomaly_facts_read_the_day_a_few_times(spark):
    plan = catalog.REGISTRY["top_anomaly_facts"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 9
