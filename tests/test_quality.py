import pytest
from pyspark.sql import functions as F

from meltemi.operators import contracts, quality
from tests.conftest import rows_of


def suite(df, *checks, **kw):
    return {r.check_name: r for r in quality.run_suite(df, "silver", "t", list(checks), **kw).collect()}


def numbers(frame, values):
    return frame("v double, s string", [(v, "x") for v in values])


def test_null_rate_boundaries(frame):
    def outcome(nulls, hard=True):
        df = numbers(frame, [None] * nulls + [1.0] * (10 - nulls))
        r = suite(df, quality.null_rate(df, "v", 0.3, 0.7, hard))["null_rate_v"]
        return r.passed, r.severity, r.detail

    assert outcome(2) == (True, "warn", "20.0% nulls — OK")
    assert outcome(3) == (False, "warn", "30.0% nulls (warn threshold 30%)")
    assert outcome(7) == (False, "fail", "70.0% nulls (threshold 70%)")
    assert outcome(8, hard=False) == (False, "warn", "80.0% nulls (threshold 70%; non-blocking optional source)")


def test_range_counts_only_present_values(frame):
    df = numbers(frame, [1.0, 2.0, 3.0, -4.0, None])
    checks = suite(df, quality.value_range(df, "v", 0, 10, mostly=0.75))
    assert checks["range_v"].passed and checks["range_v"].detail == "75.0% in [0, 10] (required 75%)"
    assert not suite(df, quality.value_range(df, "v", 0))["range_v"].passed
    empty = numbers(frame, [None])
    assert suite(empty, quality.value_range(empty, "v", 0))["range_v"].detail == "no non-null values to check"


def test_missing_columns(frame):
    df = numbers(frame, [1.0])
    got = suite(df, *quality.required_columns(df, ["v", "w"]), quality.null_rate(df, "w"), quality.value_range(df, "w", 0),
                quality.valid_values(df, "w", ["a"]), quality.completeness_floor(df))
    assert {k: (r.passed, r.severity) for k, r in got.items()} == {
        "column_exists_v": (True, "fail"), "column_exists_w": (False, "fail"), "null_rate_w": (False, "fail"),
        "range_w": (False, "warn"), "valid_values_w": (False, "warn"), "data_completeness_floor": (True, "warn")}


def test_valid_values_ignore_null(frame):
    df = frame("s string", [("a",), (None,), ("b",), ("c",)])
    r = suite(df, quality.valid_values(df, "s", ["a", "b"]))["valid_values_s"]
    assert (r.passed, r.detail) == (False, "1 invalid values")


def test_a_table_without_rows_gives_one_result(frame):
    df = numbers(frame, [])
    got = suite(df, quality.row_count(), quality.null_rate(df, "v"), required=False, dates=["2026-06-05"])
    assert list(got) == ["data_present"]
    assert (got["data_present"].severity, got["data_present"].passed) == ("warn", False)
    assert "2026-06-05" in got["data_present"].detail


def test_hard_failures_stop_the_run(frame):
    df = numbers(frame, [None] * 9 + [1.0])
    results = quality.run_suite(df, "silver", "t", [quality.null_rate(df, "v")])
    assert rows_of(quality.failures(results)) == [("null_rate_v", "silver", 1)]
    with pytest.raises(RuntimeError, match="null_rate_v"):
        quality.require_no_hard_failures(results)


def test_audits_count_violations(frame):
    df = frame("k string, v int", [("a", 1), ("a", 1), ("b", None), ("c", 9), (None, 1)])
    got = rows_of(quality.audit(df, "t", [
        quality.Audit("not_null", "v"), quality.Audit("accepted_values", "k", values=("a", "b")),
        quality.Audit("accepted_range", "v", low=0, high=5), quality.Audit("unique", "k,v")]), "audit", "violations")
    assert got == [("accepted_range", 1), ("accepted_values", 1), ("not_null", 1), ("unique", 1)]
    with pytest.raises(RuntimeError, match="unique"):
        quality.require_clean(quality.audit(df, "t", [quality.Audit("unique", "k,v")]))


def messages(df, name):
    bad = contracts.violations(df, contracts.CONTRACTS[name])
    return [r.m for r in bad.select(contracts.message(F.col("table"), F.col("check_name"), F.col("reason")).alias("m")).collect()]


SUMMARY = """partition_date string, country_code string, source string, mean_pm2_5 double, max_pm2_5 double,
    mean_pm10 double, mean_no2 double, mean_o3 double, station_count long, who_pm25_exceed_pct double,
    who_pm10_exceed_pct double, who_no2_exceed_pct double, who_o3_exceed_pct double"""
ONE = ("2026-06-04", "TN", "openmeteo", 1.0, 2.0, None, 1.0, 1.0, 1, 0.0, 0.0, 0.0, 100.0)


def test_summary_contract(spark, frame):
    assert messages(frame(SUMMARY, [ONE]), "daily_country_summary") == []
    assert messages(frame(SUMMARY, []), "daily_country_summary") == [
        "gold/daily_country_summary: Check that model daily_country_summary has row_count > 0: "
        "Actual row_count(daily_country_summary) was 0, expected > 0"]
    wanted = contracts.wanted_dates(spark, ["2026-06-05", "2026-06-04"])
    gap = contracts.missing_partition_violations(frame(SUMMARY, [ONE]), "daily_country_summary", wanted)
    assert [(r.check_name, r.reason) for r in gap.collect()] == [("missing requested partition(s)", "['2026-06-05']")]


def test_weather_contract_finds_each_fault(frame):
    ddl = """partition_date string, country_code string, stations long, temp_max_c double, temp_mean_c double,
        temp_min_c double, condition string, wind_level string, dust_level string, heat_alert string,
        heat_streak_days long, cold_alert string, cold_streak_days long"""
    good = ("2026-06-05", "GR", 2, 31.0, 25.0, 18.0, "rain", "calm", "none", "none", 0, "none", 0)
    assert messages(frame(ddl, [good]), "daily_country_weather") == []
    swapped = (*good[:3], 3.0, 5.0, 9.0, *good[6:])
    labelled = (*good[:9], "boiling", 0, "icy", -2)
    heads = [m.split(": ", 1)[1].split(":")[0] for m in messages(frame(ddl, [good, swapped, labelled]), "daily_country_weather")]
    assert heads == [
        "Check that field heat_alert has invalid_count = 0", "Check that field cold_alert has invalid_count = 0",
        "Check that field cold_streak_days has a minimum of 0", "The low never sits above the high."]


def test_risk_and_anomaly_contracts(frame):
    risk = frame("partition_date string, source string, station_id string, risk_index double, risk_level string",
                 [("d", "openmeteo", "s", 120.0, "unknown")])
    assert len(messages(risk, "wildfire_risk_index")) == 2
    short = frame("partition_date string, source string, station_id string, anomaly_score double", [("d", "openaq", "s", -0.5)])
    assert messages(short, "anomaly_alerts") == [
        "gold/anomaly_alerts: Check that field 'is_anomaly' is present: Required column 'is_anomaly' is missing"]
    assert contracts.type_warnings(short.withColumn("is_anomaly", F.lit("1")), contracts.CONTRACTS["anomaly_alerts"]) == [
        "is_anomaly: string is not integer"]


def test_an_unreadable_table_is_one_finding_and_the_rest_goes_on(spark, frame):
    def broken():
        raise OSError("403 Forbidden")

    got = contracts.verify_gold(
        spark, {"wildfire_risk_index": broken, "daily_country_summary": lambda: frame(SUMMARY, [])}, ["2026-06-05"])
    assert rows_of(got, "table", "check_name") == [
        ("daily_country_summary", "Check that model daily_country_summary has row_count > 0"),
        ("daily_country_summary", "missing requested partition(s)"), ("wildfire_risk_index", "cannot read table")]
