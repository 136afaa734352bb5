from datetime import date, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window

from meltemi.operators import gold, marts
from meltemi.operators.quantiles import group_quantiles
from meltemi.operators.series import with_streak
from tests.conftest import rows_of

WEATHER = """station_id string, country_code string, partition_date string, temp_max_c double, temp_min_c double,
    temp_mean_c double, apparent_temp_max_c double, precipitation_mm double, wind_gust_max_kmh double,
    humidity_pct double, dust double, condition string, wind_level string, dust_level string"""


def days(station, country, highs, condition="clear"):
    start = date(2026, 6, 1)
    return [(station, country, (start + timedelta(days=i)).isoformat(), h, h - 10, h - 5, h + 2, 0.0, 10.0, 50.0, 5.0,
             condition, "calm", "none") for i, h in enumerate(highs)]


def by_day(df, *columns):
    return [tuple(r) for r in df.orderBy("partition_date").select(*columns).collect()]


MILD = [24.0, 25.0] * 16


@pytest.mark.parametrize(
    ("highs", "heat", "cold"),
    [
        # too short a history for any verdict, however extreme
        ([47.0] * 10, ["none"] * 3, ["none"] * 3),
        # the eleventh row has ten behind it
        ([20.0] * 10 + [33.0], ["none", "none", "heat_advisory"], ["none"] * 3),
        # a wave needs three days; its tier looks at the high
        (MILD + [33.0, 34.0, 39.9], ["heat_advisory", "heat_advisory", "heatwave"], ["none"] * 3),
        (MILD + [33.0, 34.0, 40.0], ["heat_advisory", "heat_advisory", "extreme_heatwave"], ["none"] * 3),
        # level with its own month is ordinary, and so is warm weather under the floor
        ([36.6] * 40, ["none"] * 3, ["none"] * 3),
        ([15.0] * 30 + [28.0, 29.0, 30.0], ["none"] * 3, ["none"] * 3),
        # the low is ten under the high here: 4, 1 and 0 degrees, then -1
        (MILD + [14.0, 11.0, 10.5], ["none"] * 3, ["cold_advisory", "cold_advisory", "cold_wave"]),
        (MILD + [14.0, 11.0, 9.0], ["none"] * 3, ["cold_advisory", "cold_advisory", "severe_cold_wave"]),
        # a cool day in between starts the count again
        (MILD + [35.0, 36.0, 24.0, 37.0], ["heat_advisory", "none", "heat_advisory"], ["none"] * 3),
    ],
)
def test_alert_tiers(frame, highs, heat, cold):
    got = by_day(gold.daily_country_weather(frame(WEATHER, days("x_tn", "TN", highs))), "heat_alert", "cold_alert")
    assert [h for h, _ in got][-3:] == heat and [c for _, c in got][-3:] == cold


def test_a_young_station_has_no_baseline(frame):
    got = gold.flag_heat_events(frame(WEATHER, days("x_tn", "TN", [47.0] * 9)))
    assert set(by_day(got, "heat_baseline_c", "is_hot_day", "heat_streak_days")) == {(None, False, 0)}


def test_stations_count_their_own_streaks_and_the_country_takes_the_worst(frame):
    df = frame(WEATHER, days("p_gr", "GR", MILD + [41.5, 42.0, 41.0]) + days("q_gr", "GR", [22.0] * 35, "snow"))
    streaks = gold.flag_heat_events(df).groupBy("station_id").max("heat_streak_days")
    assert rows_of(streaks) == [("p_gr", 3), ("q_gr", 0)]
    last = gold.daily_country_weather(df).orderBy("partition_date").collect()[-1]
    assert (last.stations, last.stations_hot, last.temp_max_c, last.temp_min_c) == (2, 1, 41.0, 12.0)
    assert (last.heat_alert, last.condition, last.wind_level) == ("extreme_heatwave", "snow", "calm")


def test_baseline_matches_a_plain_rolling_quantile(frame):
    values = [((i * 37) % 23) + i / 10 if i % 7 else None for i in range(80)]
    rows = [("s", "TN", f"2026-{1 + i // 28:02d}-{1 + i % 28:02d}", v, v, *[None] * 6, *[None] * 3) for i, v in enumerate(values)]
    got = by_day(gold.flag_heat_events(frame(WEATHER, rows)), "heat_baseline_c", "cold_baseline_c")
    series = pd.Series(values, dtype="float64").shift(1).rolling(30, min_periods=10)
    for (heat, cold), h, c in zip(got, series.quantile(0.9), series.quantile(0.1)):
        assert (heat is None) == pd.isna(h)
        if heat is not None:
            assert abs(heat - h) < 1e-9 and abs(cold - c) < 1e-9


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.booleans()), min_size=1, max_size=25))
def test_streak_counts_back_to_the_last_false(spark, flags):
    df = spark.createDataFrame([("s", i, f) for i, f in enumerate(flags)], "k string, i int, flag boolean")
    got = with_streak(df, "flag", Window.partitionBy("k").orderBy("i"), "n").orderBy("i").collect()
    run = 0
    for row, flag in zip(got, flags):
        run = run + 1 if flag else 0
        assert row.n == run


AIR = """station_id string, country_code string, source string, partition_date string, pm2_5 double, pm10 double,
    nitrogen_dioxide double, ozone double, who_pm25_exceed long, who_pm10_exceed long, who_no2_exceed long,
    who_o3_exceed long"""


def test_summary_restores_the_country_and_rounds_half_even(frame):
    df = frame(AIR, [("a_tn", None, "openaq", "d", 0.125, 1.0, None, 2.0, 0, 0, 0, 0),
                     ("b_tn", "TN", "openaq", "d", 0.125, 3.0, None, None, 1, 0, 0, 0),
                     ("b_tn", "TN", "openaq", "d", 0.125, None, None, None, 0, 0, 0, 0)])
    r = gold.daily_country_summary(df).collect()
    assert len(r) == 1
    assert (r[0].country_code, r[0].station_count, r[0].mean_pm2_5, r[0].mean_pm10) == ("TN", 2, 0.12, 2.0)
    assert r[0].who_pm25_exceed_pct == 33.3 and r[0].mean_no2 is None


def test_risk_of_missing_and_extreme_readings(frame):
    df = frame("station_id string, source string, partition_date string, pm2_5 double, ozone double",
               [("none", "x", "d", None, None), ("top", "x", "d", 900.0, 400.0), ("mid", "x", "d", 75.0, None)])
    assert rows_of(gold.wildfire_risk_index(df), "station_id", "risk_index", "risk_level") == [
        ("mid", 20.0, "low"), ("none", 0.0, "low"), ("top", 100.0, "extreme")]


def test_exceedance_streak_golden_rows(frame):
    flags = [(1, 0, 0, 0), (0, 0, 1, 0), (0, 0, 0, 0), (0, 1, 0, 0)]
    rows = [("s1", "S1", "TN", "openaq", date(2024, 1, i + 1), *f) for i, f in enumerate(flags)]
    df = frame("""station_id string, station_name string, country_code string, source string, observation_date date,
        who_pm25_exceed int, who_pm10_exceed int, who_no2_exceed int, who_o3_exceed int""", rows)
    got = marts.mart_who_exceedance_streak(df).orderBy("observation_date").collect()
    assert [r.current_exceedance_streak_days for r in got] == [1, 2, 0, 1]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", None, "b"]), st.one_of(st.none(), st.floats(-50, 150))), min_size=1,
                max_size=40), st.sampled_from([0.05, 0.5, 0.9]))
def test_distributed_quantiles_are_exact(spark, rows, q):
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.q for r in group_quantiles(df, ["k"], "v", q, "q", 0.0, 100.0, cells=8).collect()}
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    assert got.keys() == groups.keys()
    for k, values in groups.items():
        assert abs(got[k] - pd.Series(values).quantile(q)) < 1e-9


def test_quantile_of_a_group_made_of_copies(spark):
    df = spark.range(5000).selectExpr("case when id < 4000 then 7.0D else cast(id as double) end as v")
    got = group_quantiles(df, [], "v", 0.5, "q", 0.0, 100.0).collect()
    assert [tuple(r) for r in got] == [(7.0,)]
