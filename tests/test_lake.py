import pytest
from pyspark.sql import functions as F

from meltemi.operators import incremental, monitoring, sinks
from meltemi.plans import lake as jobs
from meltemi.sources import landing, tables
from meltemi.streaming import silver_feed
from meltemi.operators import silver
from tests.conftest import SMALL, rows_of

GOLD = "partition_date string, value int"


def test_day_counts_from_configuration():
    assert tables.configured_days("", 60) == 60
    assert tables.configured_days(None, 60) == 60
    assert tables.configured_days(" ALL ", 60) is None
    assert tables.configured_days("0", 60) is None
    assert tables.configured_days("-3", 60) == 1
    assert tables.configured_days("soon", 60) == 60
    assert tables.cutoff("2024-01-31", 14) == "2024-01-17"


def test_the_read_window_must_cover_a_baseline():
    tables.check_lead_in(60, 14)
    tables.check_lead_in(None, 14)
    with pytest.raises(ValueError):
        tables.check_lead_in(40, 14)


def test_splice_keeps_history_and_drops_lead_in(frame):
    old = frame(GOLD, [("2024-01-01", 1), ("2024-01-20", 2)])
    fresh = frame(GOLD, [("2024-01-01", 10), ("2024-01-20", 20), ("2024-01-21", 30)])
    assert rows_of(incremental.merge_refreshed(old, fresh, "2024-01-17")) == [
        ("2024-01-01", 1), ("2024-01-20", 20), ("2024-01-21", 30)]
    assert incremental.merge_refreshed(old, fresh, None) is fresh
    assert incremental.merge_refreshed(None, fresh, "2024-01-17") is fresh


def test_refresh_replaces_only_its_range(spark, frame, tmp_path):
    path = str(tmp_path / "gold")
    first = frame(GOLD, [("2023-12-01", 1), ("2024-01-20", 2), ("2024-01-25", 3)])
    assert sinks.refresh(first, path, "2024-01-31").rows == 3  # a new table takes the frame whole
    fresh = frame(GOLD, [("2023-12-01", 99), ("2024-01-20", 20), ("2024-01-22", 22)])
    for _ in range(2):
        done = sinks.refresh(fresh, path, "2024-01-31")
        assert rows_of(tables.read_table(spark, path), "partition_date", "value") == [
            ("2023-12-01", 1), ("2024-01-20", 20), ("2024-01-22", 22)]
    assert done.rows == 2 and done.removed == []


def test_a_full_refresh_replaces_everything(spark, frame, tmp_path):
    path = str(tmp_path / "gold")
    sinks.refresh(frame(GOLD, [("2023-12-01", 1)]), path, "2024-01-31")
    sinks.refresh(frame(GOLD, [("2024-01-02", 5)]), path, "2024-01-31", refresh_days=None, window_days=None)
    assert rows_of(tables.read_table(spark, path), "partition_date", "value") == [("2024-01-02", 5)]


def test_a_failed_refresh_leaves_the_table_alone(spark, frame, tmp_path):
    path = str(tmp_path / "gold")
    sinks.refresh(frame(GOLD, [("2024-01-20", 2)]), path, "2024-01-31")
    broken = frame(GOLD, [("2024-01-20", 0), ("2024-01-21", 4)]).withColumn("value", (F.lit(8) / F.col("value")).cast("int"))
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        sinks.refresh(broken, path, "2024-01-31")
    assert rows_of(tables.read_table(spark, path), "partition_date", "value") == [("2024-01-20", 2)]


def test_replace_range_removes_nested_partitions_without_rows(spark, frame, tmp_path):
    path, ddl = str(tmp_path / "t"), "partition_date string, source string, v int"
    sinks.append(frame(ddl, [("2024-01-01", "a", 1), ("2024-01-01", "b", 2), ("2024-01-05", "a", 3)]), path)
    done = sinks.replace_range(frame(ddl, [("2024-01-01", "a", 9)]), path, "2024-01-01", "2024-01-03", sinks.DAY_SOURCE)
    assert done.removed == ["partition_date=2024-01-01/source=b"]
    assert rows_of(tables.read_table(spark, path), "partition_date", "source", "v") == [
        ("2024-01-01", "a", 9), ("2024-01-05", "a", 3)]


def test_a_missing_table_is_not_an_unreadable_one(spark, frame, tmp_path):
    assert tables.read_or_empty(spark, str(tmp_path / "none"), GOLD).isEmpty()
    assert sinks.list_partitions(spark, str(tmp_path / "none")) == []
    spoiled = tmp_path / "spoiled" / "partition_date=2024-01-01"
    spoiled.mkdir(parents=True)
    (spoiled / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        tables.read_or_empty(spark, str(tmp_path / "spoiled"), GOLD).count()
    with pytest.raises(RuntimeError, match="empty"):
        path = str(tmp_path / "hollow")
        frame(GOLD, []).write.parquet(path)
        tables.read_non_empty(spark, path)


def test_partition_predicates_prune_the_scan(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(frame(GOLD, [(f"2024-01-{d:02d}", d) for d in range(1, 10)]), path, sinks.DAY)
    df = tables.in_window(tables.read_table(spark, path), "2024-01-10", 3)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan and ">= 2024-01-07" in plan
    assert len(df.inputFiles()) <= 9 and df.count() == 3
    assert rows_of(tables.recent_or_named(df, "2024-01-10", dates=["2024-01-08"]), "value") == [(8,)]


def test_dates_in_paths(frame):
    df = frame("path string", [("s3://b/partition_date=2024-01-05/source=waqi/x.parquet",), ("a\\partition_date=2024-01-06\\y",),
                               ("_delta/0.json",), ("s3://b/partition_date=2024-01-05/z",)])
    assert rows_of(tables.dates_in_paths(df)) == [("2024-01-05",), ("2024-01-06",)]


def test_missing_dates_then_keep_them(spark, frame):
    held = frame(GOLD, [("2024-01-02", 1)])
    missing = incremental.missing_dates(spark, held, "2024-01-01", "2024-01-03")
    assert rows_of(missing) == [("2024-01-01",), ("2024-01-03",)]
    assert rows_of(incremental.keep_missing(frame(GOLD, [("2024-01-01", 5), ("2024-01-02", 6)]), missing)) == [("2024-01-01", 5)]


def test_alerts(spark, frame):
    ddl = "stage string, run_ts string, rows long, duration_seconds double, quality_failures long"
    df = frame(ddl, [
        ("bronze_openmeteo", "2024-01-29 06:00:00", 12, 5.0, 0), ("bronze_openmeteo", "2024-01-30 06:00:00", 5, 1801.0, 0),
        ("bronze_openaq", "2024-01-30 06:00:00", 0, 5.0, 0), ("silver", "2024-01-30 06:00:00", 9, 3600.0, 2),
        ("gold", "2024-01-30 06:00:00", 9, 1.0, 0)]).withColumn("run_ts", F.col("run_ts").cast("timestamp"))
    assert rows_of(monitoring.run_alerts(df, "2024-01-31 08:30:00"), "stage", "alert") == [
        ("bronze_openaq", "no_rows"), ("bronze_openmeteo", "row_count_drop"), ("bronze_openmeteo", "run_slow"),
        ("bronze_openmeteo", "run_stale"), ("silver", "quality_failed"), ("silver", "run_stale")]
    assert rows_of(monitoring.never_ran(spark, df)) == [("quality",)]


def _bronze(spark):
    rows = landing.bronze_air(spark, SMALL)
    return {s: rows.filter(F.col("source") == s) for s in ("openmeteo", "openaq", "waqi")}


def test_the_whole_lake_twice_and_a_late_partition(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path / "lake"))
    grid, late = landing.model_grid(spark, SMALL), "2024-01-27"
    for source, df in _bronze(spark).items():
        jobs.ingest(spark, lake, source, df.filter(F.col("partition_date") != late))
    jobs.ingest(spark, lake, "openmeteo_weather", landing.bronze_weather(spark, SMALL))
    first = jobs.run_silver_air(spark, lake, grid, landing.RUN_TS)
    assert first > 0 and jobs.run_silver_air(spark, lake, grid, landing.RUN_TS) == 0
    assert jobs.run_silver_weather(spark, lake, landing.RUN_TS) == 352
    assert jobs.run_silver_weather(spark, lake, landing.RUN_TS) == 0

    names = ("daily_country_summary", "wildfire_risk_index", "daily_country_weather")

    def state():
        return {n: rows_of(tables.read_table(spark, lake.gold(n)).select("partition_date", "country_code", "gold_ts")) for n in names}

    jobs.run_gold(spark, lake, landing.AS_OF, "run", with_anomalies=False)
    before = state()
    jobs.run_gold(spark, lake, landing.AS_OF, "run", with_anomalies=False)
    assert state() == before

    for source, df in _bronze(spark).items():
        jobs.ingest(spark, lake, source, df)
    assert jobs.run_silver_air(spark, lake, grid, landing.RUN_TS) > 0
    jobs.run_gold(spark, lake, landing.AS_OF, "later", with_anomalies=False)
    after = state()
    cut = tables.cutoff(landing.AS_OF, 14)
    for n in names:
        assert [r for r in after[n] if r[0] < cut] == [r for r in before[n] if r[0] < cut]
        assert {r[2] for r in after[n] if r[0] >= cut} == {"later"}
    assert late in {r[0] for r in after["daily_country_summary"]}

    findings = jobs.run_contracts(spark, lake, ["2024-01-27"])
    assert rows_of(findings, "table", "check_name") == [("anomaly_alerts", "cannot read table")]
    jobs.record(spark, lake, "silver", "2024-01-31 06:00:00", first, 0.0)
    assert jobs.alerts(spark, lake, "2024-01-31 07:00:00").count() <= 1
    suites = jobs.run_quality(spark, lake, landing.AS_OF, dates=["2024-01-27"])
    assert suites.filter("check_name = 'row_count_non_zero'").count() == 6


def test_streamed_silver_takes_late_rows(spark, tmp_path):
    bronze_path, silver_path = str(tmp_path / "bronze"), str(tmp_path / "silver")
    grid = landing.model_grid(spark, SMALL)
    rows = landing.bronze_air(spark, SMALL)

    def drain():
        stream = silver_feed.bronze_stream(spark, bronze_path)
        silver_feed.write_silver(
            stream, bronze_path, silver_path, str(tmp_path / "cp"), lambda b: silver.build_air(b, grid, landing.RUN_TS)
        ).awaitTermination()
        return tables.read_table(spark, silver_path)

    # Half of the stations of every date, then the others in a second run, some in files of their own.
    early = F.pmod(F.xxhash64("station_id"), F.lit(2)) == 0
    sinks.append(rows.filter(early), bronze_path, sinks.DAY_SOURCE)
    whole = silver.build_air(rows, grid, landing.RUN_TS)
    assert drain().count() == whole.filter(early).count()
    late = rows.filter(~early)
    sinks.append(late.filter("partition_date <= '2024-01-15'"), bronze_path, sinks.DAY_SOURCE)
    sinks.append(late.filter("partition_date > '2024-01-15'"), bronze_path, sinks.DAY_SOURCE)
    got = drain()
    assert rows_of(got, "station_id", "date", "source") == rows_of(whole, "station_id", "date", "source")
    assert rows_of(drain(), "station_id", "date", "source") == rows_of(got, "station_id", "date", "source")


def test_overwriting_twice_keeps_odd_partition_values(frame, spark, tmp_path):
    path = str(tmp_path / "odd")
    days = [None, "x:y", "a b", "50%", "2024-01-01"]
    df = frame("partition_date string, source string, v int", [(d, s, 1) for d in days for s in ("p:q", None)])
    for _ in range(3):
        done = sinks.overwrite(df, path, sinks.DAY_SOURCE)
        assert done.rows == 10 and done.removed == [] and len(done.partitions) == 10
        assert sinks.list_partitions(spark, path, sinks.DAY_SOURCE) == done.partitions
        assert rows_of(tables.read_table(spark, path), "partition_date", "source") == rows_of(df, "partition_date", "source")
    assert sinks.partition_days(done.partitions) == ["2024-01-01", "50%", "a b", "x:y"]
    less = sinks.overwrite(df.filter("partition_date is not null"), path, sinks.DAY_SOURCE)
    assert len(less.removed) == 2 and tables.read_table(spark, path).count() == 8


def test_a_crash_leaves_the_table_as_it_was_and_the_next_run_ends_the_work(frame, spark, tmp_path, monkeypatch):
    path, ddl = str(tmp_path / "crash"), "partition_date string, v int"
    sinks.overwrite(frame(ddl, [(f"2024-01-0{d}", 1) for d in (1, 2, 3)]), path)
    fresh = frame(ddl, [("2024-01-01", 2), ("2024-01-03", 2)])

    def lost(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(sinks, "folder_day", lost)
        with pytest.raises(RuntimeError):
            sinks.replace_range(fresh, path, "2024-01-01", "2024-01-03")
    assert rows_of(tables.read_table(spark, path), "partition_date", "v") == [("2024-01-01", 1), ("2024-01-02", 1), ("2024-01-03", 1)]
    assert sinks.replace_range(fresh, path, "2024-01-01", "2024-01-03").removed == ["partition_date=2024-01-02"]
    assert rows_of(tables.read_table(spark, path), "partition_date", "v") == [("2024-01-01", 2), ("2024-01-03", 2)]


def test_a_window_read_lists_only_its_own_partitions(spark, frame, tmp_path):
    path, ddl = str(tmp_path / "silver"), "partition_date string, source string, v int"
    sinks.append(frame(ddl, [(f"2024-01-{d:02d}", s, d) for d in range(1, 21) for s in ("a", "b")]), path)
    got = jobs.read_window(spark, path, "2024-01-20", 3, ddl)
    assert all(f"partition_date=2024-01-{d}" in " ".join(got.inputFiles()) for d in (17, 18, 19, 20))
    assert len(got.inputFiles()) == 8 and got.count() == 8
    assert jobs.read_window(spark, path, "2025-01-01", 3, ddl) is None
    assert jobs.read_window(spark, path, "2024-01-20", None, ddl).count() == 40


def test_weather_backfill_is_complete_or_refused(spark, frame, tmp_path):
    lake = jobs.Lake(str(tmp_path / "lake"))
    ddl = "station_id string, partition_date string, temp_max_c double"
    expected = frame("station_id string", [("a",), ("b",)])

    def days(values, *dates):
        return frame(ddl, [(s, d, v) for d in dates for s, v in zip("ab", values)])

    def held():
        return rows_of(tables.read_table(spark, lake.bronze("openmeteo_weather")), "partition_date", "station_id", "temp_max_c")

    def load(df, **kw):
        return jobs.ingest_weather_range(spark, lake, df, expected, "2024-01-01", "2024-01-02", **kw)

    with pytest.raises(RuntimeError, match="incomplete"):
        load(frame(ddl, [("a", "2024-01-01", 1.0)]))
    assert load(days((1.0, 2.0), "2024-01-01")).rows == 2
    assert load(days((9.0, 9.0), "2024-01-01")) is None
    assert load(days((5.0, 6.0), "2024-01-01", "2024-01-02", "2024-01-03")).rows == 2
    assert held() == [("2024-01-01", "a", 1.0), ("2024-01-01", "b", 2.0), ("2024-01-02", "a", 5.0), ("2024-01-02", "b", 6.0)]
    assert load(days((7.0, 8.0), "2024-01-02"), rebuild=True).removed == ["partition_date=2024-01-01"]
    assert held() == [("2024-01-02", "a", 7.0), ("2024-01-02", "b", 8.0)]


def test_marts_are_rebuilt_and_audited(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path / "lake"))
    rows = landing.bronze_air(spark, SMALL)
    built = silver.build_air(rows.filter("country_code is not null"), landing.model_grid(spark, SMALL), landing.RUN_TS)
    sinks.append(built, lake.silver("air_quality"))
    written = jobs.run_marts(spark, lake, landing.RUN_TS)
    assert written["mart_who_exceedance_streak"].rows == built.count()
    assert jobs.run_marts(spark, lake, landing.RUN_TS)["mart_source_coverage"].rows == written["mart_source_coverage"].rows

    unnamed = silver.build_air(rows.filter("country_code is null"), landing.model_grid(spark, SMALL), landing.RUN_TS)
    sinks.append(unnamed, lake.silver("air_quality"))
    with pytest.raises(RuntimeError, match="country_code not_null"):
        jobs.run_marts(spark, lake, landing.RUN_TS)
