"""Late readings, alert intervals, anchors, stored distinct counts, contracts as data, quarantine, changed partitions."""

import json
import random
from importlib import resources

import numpy as np
import pytest
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.functions import dates
from meltemi.operators import contracts, distincts, gold, grid, incremental, intervals, monitoring, sinks
from meltemi.plans import catalog, report
from meltemi.plans import lake as jobs
from meltemi.schemas import BRONZE_AIR
from meltemi.sources import landing, payloads, tables
from meltemi.streaming import daily_means, series
from tests.conftest import SMALL, rows_of

# --- late readings --------------------------------------------------------------------
HOURS = "station_id string, ts timestamp, " + ", ".join(f"{p} double" for p in S.POLLUTANTS)


def readings(spark, rows):
    """rows: (station, time, value), the value under every pollutant, halved under all but the first."""
    made = [(s, t, *[v if k == 0 else None if v is None else v / 2 for k in range(len(S.POLLUTANTS))]) for s, t, v in rows]
    return spark.createDataFrame(made, HOURS.replace("ts timestamp", "ts string")).withColumn("ts", F.col("ts").cast("timestamp"))


@pytest.fixture()
def drained(spark, tmp_path):
    inbox, out, checkpoint = (str(tmp_path / n) for n in ("inbox", "means", "checkpoint"))

    def run(rows):
        readings(spark, rows).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(HOURS).parquet(inbox)
        daily_means.write_daily_means(stream, out, checkpoint).awaitTermination()
        return tables.read_table(spark, out)

    run.path = out
    return run


def batch_means(spark, rows):
    return daily_means.means(daily_means.partials(readings(spark, rows)))


def test_readings_that_come_months_late_count(spark, drained):
    rng = random.Random(1)
    first = [(f"s{rng.randrange(4)}", f"2024-06-{rng.randrange(1, 9):02d} {rng.randrange(24):02d}:00:00", float(rng.randrange(100))) for _ in range(200)]
    late = [(s, t.replace("2024-06", "2024-02"), v) for s, t, v in first[:60]] + [("s0", "2024-06-03 23:00:00", 7.0), ("new", "2024-06-03 01:00:00", None)]
    drained(first)
    got = drained(late)
    columns = ["date", "station_id", *S.POLLUTANTS]
    assert rows_of(got, *columns) == rows_of(batch_means(spark, first + late), *columns)
    assert {r.date[:7] for r in got.collect()} == {"2024-02", "2024-06"}


def test_a_repeated_batch_adds_nothing(spark, drained, monkeypatch):
    rows = [("a", "2024-01-01 01:00:00", 10.0), ("a", "2024-01-01 02:00:00", 20.0)]
    drained(rows[:1])
    replace = sinks.replace_partitions

    def lost(df, path, by=sinks.DAY_SOURCE):
        if path == drained.path:
            raise RuntimeError("driver lost")
        return replace(df, path, by)

    # The sums are stored, the means are not: the batch comes again.
    monkeypatch.setattr(sinks, "replace_partitions", lost)
    with pytest.raises(Exception):
        drained(rows[1:])
    monkeypatch.setattr(sinks, "replace_partitions", replace)
    got = drained([("b", "2024-01-09 00:00:00", 1.0)])
    assert rows_of(got, "date", "station_id", S.POLLUTANTS[0]) == [("2024-01-01", "a", 15.0), ("2024-01-09", "b", 1.0)]


def test_settled_batches_are_added_up(spark, drained, monkeypatch):
    monkeypatch.setattr(daily_means, "FOLD", 2)
    monkeypatch.setattr(daily_means.fold, "__defaults__", (2,))
    rows = [("a", f"2024-01-0{1 + k % 2} 0{k}:00:00", float(k)) for k in range(8)]
    for r in rows:
        got = drained([r])
    assert rows_of(got, "date", "station_id", S.POLLUTANTS[0]) == [("2024-01-01", "a", 3.0), ("2024-01-02", "a", 4.0)]
    held = sinks.list_partitions(spark, daily_means.partials_path(drained.path), daily_means.BY)
    assert len(held) < 8 and any(p.endswith("batch=7") for p in held)


# --- alert intervals ------------------------------------------------------------------
def stamps(rows):
    return sorted(tuple(r) for r in rows.collect())


def test_intervals_merge_and_last(frame):
    df = frame("k string, begin long, until long", [
        ("a", 0, 10), ("a", 10, 20), ("a", 25, 30), ("a", 26, 27), ("a", 40, None), ("a", 50, 60), ("b", 5, 6)])
    whole = intervals.merged(df, ["k"])
    assert rows_of(whole, "k", "begin", "until") == [("a", 0, 20), ("a", 25, 30), ("a", 40, None), ("b", 5, 6)]
    cut = intervals.until_now(whole, F.lit(45))
    kept = intervals.lasting(cut, F.lit(5), F.lit(45))
    assert rows_of(kept, "k", "begin", "fired", "until") == [("a", 0, 5, 20), ("a", 25, 30, 30), ("a", 40, 45, None)]
    assert rows_of(intervals.until_now(whole, F.lit(28)), "begin", "until") == [(0, 20), (5, 6), (25, None)]


def test_a_value_beside_the_one_a_day_before(frame):
    runs = frame("stage string, at long, rows long", [("s", 0, 100), ("s", 50, 40), ("s", 120, 90)])
    got = intervals.beside_earlier(runs, ["stage"], "at", "rows", 100)
    assert rows_of(got, "begin", "until", "now", "earlier") == [
        (0, 50, 100, None), (50, 100, 40, None), (100, 120, 40, 100), (120, 150, 90, 100), (150, 220, 90, 40), (220, None, 90, 90)]


RUNS = "stage string, run_ts string, rows long, duration_seconds double, quality_failures long"


def alerts_of(frame, rows, as_of):
    return stamps(monitoring.alert_intervals(frame(RUNS, rows).withColumn("run_ts", F.col("run_ts").cast("timestamp")), as_of))


def test_an_alert_waits_for_its_holding_time(frame):
    # Stale after 25 h: at 01:00:00 on the 2nd. The next run comes 4 min 59 s or 5 min later.
    early = [("bronze_openmeteo", "2024-01-01 00:00:00", 10, 1.0, 0), ("bronze_openmeteo", "2024-01-02 01:04:59", 10, 1.0, 0)]
    assert alerts_of(frame, early, "2024-01-02 02:00:00") == []
    late = [early[0], ("bronze_openmeteo", "2024-01-02 01:05:00", 10, 1.0, 0)]
    assert alerts_of(frame, late, "2024-01-02 02:00:00") == [
        ("run_stale", "warning", "bronze_openmeteo", "2024-01-02 01:00:00", "2024-01-02 01:05:00", "2024-01-02 01:05:00")]
    assert alerts_of(frame, early[:1], "2024-01-02 01:04:59") == []
    assert alerts_of(frame, early[:1], "2024-01-02 01:05:00") == [
        ("run_stale", "warning", "bronze_openmeteo", "2024-01-02 01:00:00", "2024-01-02 01:05:00", None)]


def test_conditions_that_follow_each_other_are_one_alert(frame):
    rows = [("bronze_openaq", f"2024-01-01 0{h}:00:00", n, 1.0, q) for h, (n, q) in enumerate([(0, 0), (0, 2), (5, 1), (0, 0), (4, 0)])]
    assert alerts_of(frame, rows, "2024-01-01 06:00:00") == [
        ("no_rows", "warning", "bronze_openaq", "2024-01-01 00:00:00", "2024-01-01 00:01:00", "2024-01-01 02:00:00"),
        ("no_rows", "warning", "bronze_openaq", "2024-01-01 03:00:00", "2024-01-01 03:01:00", "2024-01-01 04:00:00"),
        ("quality_failed", "pipeline", "bronze_openaq", "2024-01-01 01:00:00", "2024-01-01 01:01:00", "2024-01-01 03:00:00")]


def test_the_bronze_layer_is_as_slow_as_its_slowest_stage(frame):
    rows = [("bronze_waqi", "2024-01-01 00:00:00", 9, 2000.0, 0), ("bronze_openaq", "2024-01-01 01:00:00", 9, 1801.0, 0),
            ("bronze_waqi", "2024-01-01 02:00:00", 9, 5.0, 0), ("bronze_openaq", "2024-01-01 03:00:00", 9, 1800.0, 0),
            ("silver", "2024-01-01 03:00:00", 9, 3600.0, 0), ("gold", "2024-01-01 03:00:00", 9, 9999.0, 0)]
    assert alerts_of(frame, rows, "2024-01-01 09:00:00") == [
        ("run_slow", "warning", "bronze", "2024-01-01 00:00:00", "2024-01-01 00:05:00", "2024-01-01 03:00:00")]


def test_a_drop_lasts_until_the_count_or_the_day_before_changes(frame):
    rows = [("bronze_openmeteo", "2024-01-01 06:00:00", 100, 1.0, 0), ("bronze_openmeteo", "2024-01-02 05:00:00", 49, 1.0, 0),
            ("bronze_openmeteo", "2024-01-02 20:00:00", 50, 1.0, 0)]
    assert alerts_of(frame, rows, "2024-01-03 01:00:00") == [
        ("row_count_drop", "warning", "bronze_openmeteo", "2024-01-02 06:00:00", "2024-01-02 06:10:00", "2024-01-02 20:00:00")]


# --- anchors as a table ---------------------------------------------------------------
ROWS = "id int, country_code string, latitude double, longitude double"
ANCHORS = "anchor_id int, country_code string, latitude double, longitude double"


def near_by_hand(rows, anchors, max_km):
    import math

    def km(a, b):
        (p, l), (q, m) = ((math.radians(x), math.radians(y)) for x, y in (a, b))
        h = math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin((m - l) / 2) ** 2
        return 2 * S.EARTH_RADIUS_KM * math.asin(math.sqrt(min(1.0, h)))

    kept, best = [], []
    codes = {c.upper() for _, c, *_ in anchors if c}
    for i, c, lat, lon in rows:
        own = (c or "").upper()
        if own not in codes:
            kept.append(i)
        if lat is None or lon is None or lat != lat or not -90 <= lat <= 90:
            continue
        found = sorted((round(km((lat, lon), (a, o)), 4), k) for k, ac, a, o in anchors if ac and a is not None and ac.upper() == own and km((lat, lon), (a, o)) <= max_km)
        if found:
            if own in codes:
                kept.append(i)
            best.append((i, found[0][1], found[0][0]))
    return sorted(kept), sorted(best)


@pytest.mark.parametrize("max_km", [3.0, 60.0, 900.0, 30000.0])
def test_anchor_joins_equal_brute_force(frame, max_km):
    rng = random.Random(6)
    spots = [(90.0, 0.0), (-90.0, 50.0), (0.0, 180.0), (10.0, -179.99), (89.99, 120.0), (36.8, 10.2), (0.0, 0.0)]
    place = lambda: (lambda s: (max(-90.0, min(90.0, s[0] + rng.gauss(0, 1))), s[1] + rng.gauss(0, 1)))(rng.choice(spots))
    rows = [(k, rng.choice(["TN", "tn", "IT", "XX", None]), *place()) for k in range(400)]
    rows += [(1000, "TN", None, 1.0), (1001, "TN", float("nan"), 1.0), (1002, "IT", 91.0, 1.0), (1003, None, None, None)]
    rows += [(2000 + k, "TN", 36.8, 10.2) for k in range(60)]
    anchors = [(k, rng.choice(["TN", "IT"]), *place()) for k in range(80)] + [(500, "TN", 36.8, 10.2), (501, "TN", 36.8, 10.2), (502, None, 0.0, 0.0), (503, "IT", None, 0.0)]
    kept, best = near_by_hand(rows, anchors, max_km)
    made, held = frame(ROWS, rows), frame(ANCHORS, anchors)
    for split in (10**6, 20):
        assert [i for (i,) in rows_of(grid.keep_near_anchors(made, held, max_km, split), "id")] == kept
        got = rows_of(grid.nearest_anchor(made, "id", held, max_km, split))
        assert [(i, a) for i, a, _ in got] == [(i, a) for i, a, _ in best]
        assert all(abs(x[2] - y[2]) < 2e-4 for x, y in zip(got, best))


def test_a_crowded_cell_is_dealt_over_parts_and_no_cross_join_is_planned(spark, frame):
    rows = frame(ROWS, [(k, "TN", 36.8, 10.2) for k in range(500)])
    placed, entered, keys = grid._sides(rows, frame(ANCHORS, [(1, "TN", 36.9, 10.2)]), 50.0, 100)
    parts = placed.groupBy(*keys).count().collect()
    assert len(parts) == 5 and max(r["count"] for r in parts) < 200
    many = spark.range(100_000).selectExpr("int(id) as anchor_id", "if(id % 9 = 0, 'IT', 'TN') as country_code", "double(id % 317) / 10 + 10 as latitude", "double(id % 911) / 10 as longitude")
    got = grid.keep_near_anchors(rows, many, 50.0)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and got.count() == 500
    assert grid.keep_near_anchors(rows, many.limit(0), 50.0).count() == 500 and grid.keep_near_anchors(rows.limit(0), many, 50.0).count() == 0


# --- distinct counts that add up ------------------------------------------------------
def test_bitmaps_roll_up_and_a_day_can_be_replaced(spark, frame, tmp_path):
    rng = random.Random(2)
    ddl = "station_id string, country_code string, source string, partition_date string"
    make = lambda days, n: [(f"st{rng.randrange(n)}_tn", rng.choice(["TN", "IT", None]), rng.choice("ab"), f"2024-0{m}-{d:02d}") for m, d in days for _ in range(60)]
    first, root = make([(1, d) for d in range(1, 15)], 40), str(tmp_path / "b")
    distincts.refresh(spark, frame(ddl, first), root)
    second = make([(1, 13), (1, 14), (2, 1)], 90)
    distincts.refresh(spark, frame(ddl, second), root, "2024-01-13", None)
    now = [r for r in first if r[3] < "2024-01-13"] + second
    numbers = tables.read_table(spark, f"{root}/station_numbers").select("station_id", "number").collect()
    assert len({r.number for r in numbers}) == len(numbers) == len({r[0] for r in first + second})
    got = rows_of(distincts.roll_up(distincts.stored(spark, root), month=distincts.month()))
    assert got == sorted((m, len({r[0] for r in now if r[3][:7] == m})) for m in ("2024-01", "2024-02"))
    in_all = distincts.roll_up_sets(distincts.stored(spark, root), [["source"], []], source=F.col("source"))
    assert sorted((r.level, r.source or "", r.stations) for r in in_all.collect()) == [
        *((0, s, len({r[0] for r in now if r[2] == s})) for s in "ab"), (1, "", len({r[0] for r in now}))]


def test_a_roll_up_reads_no_silver(spark):
    got = catalog.REGISTRY["stations_by_month"](spark, SMALL)
    assert got._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert got.inputFiles() and all("/station_bitmaps/" in f for f in got.inputFiles())


# --- figures by grouping sets ---------------------------------------------------------
def test_report_figures_read_every_table_at_most_twice(spark):
    plan = catalog.REGISTRY["report_kpis"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 4


def test_report_figures_of_empty_tables(spark):
    d = SMALL
    frames = [f(spark, d).limit(0) for f in (catalog.report_summary, catalog.report_risk, catalog.report_anomalies, catalog.report_weather)]
    row = report.report_kpis(*frames).first()
    assert row.summary_rows == row.risk_rows == row.weather_rows == row.under_heat_alert == row.stations == row.dates == 0
    assert row.season is None and row.hottest_country is None and row.country_list == ""


# --- contracts as data ----------------------------------------------------------------
def test_a_changed_document_changes_the_outcome(spark, frame, tmp_path):
    risk = frame("partition_date string, source string, station_id string, risk_index double, risk_level string",
                 [("d", "openmeteo", "s", 80.0, "high"), ("d", "openmeteo", "t", None, "extreme")])
    text = resources.files("meltemi").joinpath("contracts/wildfire_risk_index.json").read_text()

    def outcome(changed):
        (tmp_path / "docs").mkdir(exist_ok=True)
        (tmp_path / "docs" / "risk.json").write_text(changed)
        read = contracts.read_documents(spark, str(tmp_path / "docs"))
        by_rules = contracts.check_rules({"wildfire_risk_index": risk}, contracts.rule_rows(spark, read)).filter("not passed").drop("passed")
        one_pass = contracts.verify_gold(spark, {"wildfire_risk_index": lambda: risk}, documents=str(tmp_path / "docs"))
        assert rows_of(by_rules) == rows_of(one_pass)
        return [r.reason for r in one_pass.orderBy("check_name").collect()]

    assert outcome(text) == []
    assert outcome(text.replace('"maximum": 100', '"maximum": 79')) == ["Actual invalid_count(risk_index) was 1, expected = 0"]
    assert outcome(text.replace('"extreme"', '"severe"')) == ["Actual invalid_count(risk_level) was 1, expected = 0"]
    assert outcome(text.replace('"mustBeGreaterThan": 0', '"mustBeGreaterThan": 2')) == ["Actual row_count(wildfire_risk_index) was 2, expected > 2"]
    more = '{"type": "sql", "description": "Scores are whole.", "query": "SELECT COUNT(*) FROM wildfire_risk_index WHERE risk_index < 90", "mustBe": 0}, {"metric"'
    assert outcome(text.replace('{"metric": "rowCount"', more + ': "rowCount"')) == ["Actual custom_sql(wildfire_risk_index) was 1, expected = 0"]
    assert outcome(text.replace('"name": "source"', '"name": "origin"')) == ["Required column 'origin' is missing"]
    with pytest.raises(ValueError, match="no way to check"):
        outcome(text.replace('"rowCount"', '"freshness"'))


def test_yaml_documents_say_the_same(spark, tmp_path):
    yaml = pytest.importorskip("yaml")
    text = resources.files("meltemi").joinpath("contracts/anomaly_alerts.json").read_text()
    (tmp_path / "a.odcs.yaml").write_text(yaml.safe_dump(json.loads(text)))
    assert contracts.read_documents(spark, str(tmp_path)) == {"anomaly_alerts": contracts.CONTRACTS["anomaly_alerts"]}


def test_rules_of_an_empty_table(spark, frame):
    df = frame("partition_date string, source string, station_id string, risk_index double, risk_level string", [])
    rules = contracts.rule_rows(spark, {"wildfire_risk_index": contracts.CONTRACTS["wildfire_risk_index"]})
    failed = contracts.check_rules({"wildfire_risk_index": df}, rules).filter("not passed").collect()
    assert [r.reason for r in failed] == ["Actual row_count(wildfire_risk_index) was 0, expected > 0"]


# --- payloads that do not parse -------------------------------------------------------
def test_rows_and_quarantine_account_for_every_payload(frame):
    good = '{"station_id": "a", "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "pm2_5": [1.5, null]}}'
    bodies = {
        None: "empty body", "": "empty body", "  ": "empty body", "{": "not JSON", "nonsense": "not JSON", good[:-2]: "not JSON",
        "[1]": "not an object", "7": "not an object", "null": "not an object", "{}": "no station_id",
        '{"station_id": 3, "hourly": {"time": []}}': "station_id is no text", '{"station_id": "a"}': "no hourly",
        '{"station_id": "a", "hourly": null}': "no hourly", '{"station_id": "a", "hourly": {}}': "no hourly.time",
        '{"station_id": "a", "hourly": {"time": "now"}}': "hourly.time is no array", good.replace("[1.5, null]", "[1.5]"): "arrays of unequal length",
        good: None, good.replace("1.5", '"x"'): None, good.replace("}}", "}, \"more\": 1}"): None,
    }
    df = frame("id int, body string", list(enumerate(bodies)))
    rows, aside = payloads.parse_or_quarantine(df, "body", payloads.SHAPES["hourly"])
    assert {r.id: r.reason for r in aside.collect()} == {k: why for k, why in enumerate(bodies.values()) if why}
    assert aside.columns == ["id", "body", "reason"] and rows.count() + aside.count() == len(bodies)
    assert payloads.hourly_rows(rows).count() == 6


# --- partitions that changed ----------------------------------------------------------
def test_fingerprints_see_every_change_and_no_order(frame):
    ddl = "source string, partition_date string, v int, t string"
    rows = [("a", "d1", 1, "x"), ("a", "d1", 2, None), ("a", "d1", 2, None), ("a", None, 5, ""), ("b", "d1", 1, "x")]
    kept = incremental.fingerprints(frame(ddl, rows))

    def changed(new):
        return rows_of(incremental.changed_partitions(incremental.fingerprints(frame(ddl, new).repartition(3)), kept))

    assert changed(rows[::-1]) == []
    assert changed(rows[:2] + rows[3:]) == [("a", "d1")]  # one of two equal rows is gone
    assert changed([*rows[:3], ("a", None, 5, None), rows[4]]) == [("a", None)]  # null is not empty
    assert changed([("a", "d1", 1, None), ("a", "d1", 2, "x"), *rows[2:]]) == [("a", "d1")]  # values that change places
    assert changed([*rows, ("c", "d9", 1, "x")]) == [("c", "d9")]


def test_a_partition_landed_again_is_built_again_only_if_its_rows_differ(spark, tmp_path):
    lake = jobs.Lake(str(tmp_path))
    bronze = landing.bronze_air(spark, SMALL).filter("source = 'openmeteo' and partition_date <= '2024-01-06'").drop("source").withColumn("source", F.lit("openmeteo"))
    grid_ = landing.model_grid(spark, SMALL)
    path, target = lake.bronze("openmeteo"), lake.silver("air_quality")
    sinks.replace_partitions(bronze, path, sinks.DAY)
    first = jobs.run_silver_air(spark, lake, grid_, "t1")
    assert 0 < first <= bronze.count() and jobs.run_silver_air(spark, lake, grid_, "t2") == 0
    of_day = tables.read_table(spark, target).filter("partition_date = '2024-01-04'").count()

    # The same rows in other files: looked at, not built.
    sinks.replace_partitions(bronze.filter("partition_date = '2024-01-03'").repartition(3), path, sinks.DAY)
    assert jobs.outdated(spark, lake, "openmeteo", BRONZE_AIR, target).seen.count() == 1
    assert jobs.run_silver_air(spark, lake, grid_, "t3") == 0
    assert jobs.outdated(spark, lake, "openmeteo", BRONZE_AIR, target).seen is None

    other = bronze.filter("partition_date = '2024-01-04'").withColumn("ozone", F.lit(123.0))
    sinks.replace_partitions(other, path, sinks.DAY)
    assert jobs.run_silver_air(spark, lake, grid_, "t4") >= of_day > 0
    silver_ = tables.read_table(spark, target)
    assert {r.partition_date for r in silver_.filter("silver_ts = 't4'").collect()} == {"2024-01-04"}
    assert silver_.filter("partition_date = '2024-01-04' and ozone <> 123.0").count() == 0 and silver_.count() >= first


def test_a_build_that_fails_is_tried_again(spark, tmp_path, monkeypatch):
    lake = jobs.Lake(str(tmp_path))
    bronze = landing.bronze_air(spark, SMALL).filter("partition_date = '2024-01-06'").withColumn("source", F.lit("openmeteo"))
    sinks.replace_partitions(bronze, lake.bronze("openmeteo"), sinks.DAY)
    grid_ = landing.model_grid(spark, SMALL)
    with monkeypatch.context() as m:
        m.setattr(jobs.silver, "union_sources", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            jobs.run_silver_air(spark, lake, grid_, "t1")
    assert jobs.run_silver_air(spark, lake, grid_, "t2") > 0 and jobs.run_silver_air(spark, lake, grid_, "t3") == 0


def test_date_lists_of_a_column(frame):
    df = frame("raw string", [("2026-06-04 2026-06-05,2026-06-04",), (None,), (" , ",)])
    assert [r.d for r in df.select(dates.date_list(F.col("raw")).alias("d")).collect()] == [["2026-06-04", "2026-06-05"], [], []]
    with pytest.raises(Exception, match="2026-13-01"):
        frame("raw string", [("2026-13-01",)]).select(dates.date_list(F.col("raw"))).collect()


# --- series from state ----------------------------------------------------------------
def station_days(seed, stations, days):
    rng = random.Random(seed)
    value = lambda a, b: None if rng.random() < 0.1 else rng.uniform(a, b)
    return [(f"s{k}", f"2023-{1 + d // 28:02d}-{1 + d % 28:02d}", value(20, 45), value(-10, 12)) for k in range(stations) for d in range(days)]


WEATHER = "station_id string, partition_date string, temp_max_c double, temp_min_c double"
JUDGED = ["station_id", "partition_date", "temp_max_c", "temp_min_c", "is_hot_day", "is_cold_day", "heat_streak_days", "cold_streak_days"]


def test_day_by_day_equals_the_batch_and_a_late_day_corrects_all_that_follow(spark, frame, tmp_path):
    rows = station_days(3, 3, 80)
    late = [r for r in rows if r[1] == "2023-01-20"]
    again = [(s, d, None if v is None else v + 30, w) for s, d, v, w in rows if d == "2023-02-10"]
    parts = [[r for r in rows if r[1] < "2023-03-01" and r not in late], [r for r in rows if r[1] == "2023-03-01"],
             [r for r in rows if r[1] > "2023-03-01"], late, again, [("new", "2023-01-05", 50.0, -20.0), (None, "2023-01-05", 1.0, 1.0)]]
    seen = {}
    for n, part in enumerate(parts):
        for s, d, v, w in part:
            if s is not None:
                seen[s, d] = (s, d, v, w)
        frame(WEATHER, part).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(WEATHER).parquet(str(tmp_path / "in"))
        series.write_judged(stream, series.HeatEvents(), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        if n in (0, 3, 5):
            got = tables.read_table(spark, str(tmp_path / "out"))
            assert rows_of(got, *JUDGED) == rows_of(gold.flag_heat_events(frame(WEATHER, list(seen.values()))), *JUDGED)
            bars = gold.flag_heat_events(frame(WEATHER, list(seen.values())))
            close = got.alias("g").join(bars.alias("b"), ["station_id", "partition_date"]).filter("abs(g.heat_baseline_c - b.heat_baseline_c) > 1e-9")
            assert close.count() == 0


def test_interpolated_quantiles():
    for n in (1, 2, 5, 10, 30):
        values = [random.Random(n).uniform(-5, 5) for _ in range(n)]
        for q in (0.0, 0.1, 0.5, 0.9, 1.0):
            assert abs(series.quantile([*values, None], q, 1) - float(np.quantile(values, q))) < 1e-12
    assert series.quantile([1.0, None], 0.5, 2) is None


# --- payloads are parsed once -----------------------------------------------------------
def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_body_is_parsed_once_however_many_conditions_judge_it(frame):
    df = frame("id int, body string", [(1, "{")])
    for kind, shape in payloads.SHAPES.items():
        rows, aside = payloads.parse_or_quarantine(df, "body", shape)
        assert [_plan(x).count("parseJson(") for x in (rows, aside)] == [1, 1], kind
        assert _plan(rows).count("from_json(") == 1 and _plan(aside).count("from_json(") == (1 if shape.block else 0), kind


def test_filters_on_payload_fields_do_not_parse_again(frame):
    bodies = frame("body string", [('{"queried_country": "FR", "results": [{"id": 1, "country": {"code": "FR"}, "sensors": [{"id": 5, "parameter": {"id": 2}}]}]}',), (None,), ("{",), ("{}",)])
    parsed = payloads.parse_json(bodies, "body", payloads.schemas.LOCATIONS_PAYLOAD)
    sensors = payloads.sensor_rows(payloads.location_rows(parsed)).select("station_id", "sensor_id", "parameter")
    assert _plan(sensors).count("from_json(") == 1 and parsed.count() == 4
    assert rows_of(sensors) == [("1", 5, "pm2_5")]


def test_payload_rows_are_dealt_over_all_tasks(spark):
    for landed in (landing.search_payloads, landing.location_payloads, landing.feed_payloads, landing.measurement_payloads):
        assert landed(spark, SMALL).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_nearest_anchors_cost_few_pairs_however_many_are_in_reach(frame, monkeypatch):
    rng = random.Random(8)
    place = lambda: (rng.uniform(30, 31), rng.uniform(9, 10))
    rows, anchors = [(k, "TN", *place()) for k in range(300)], [(k, "TN", *place()) for k in range(600)]
    rows += [(1000, "TN", 31.4, 10.0), (1001, "TN", 45.0, 10.0)]
    compared, sides = [], grid._sides

    def watched(*args):
        placed, entered, keys = sides(*args)
        compared.append(placed.join(entered, keys).count())
        return placed, entered, keys

    monkeypatch.setattr(grid, "_sides", watched)
    got = rows_of(grid.nearest_anchor(frame(ROWS, rows), "id", frame(ANCHORS, anchors), 60.0))
    best = near_by_hand(rows, anchors, 60.0)[1]
    assert [(i, a) for i, a, _ in got] == [(i, a) for i, a, _ in best]
    assert sum(compared) < 40 * len(rows)


def test_a_null_key_picks_no_country_for_a_payload(spark, tmp_path):
    rows = [(k, "c", None if k % 2 else 13) for k in range(1, 9)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int").write.parquet(str(tmp_path / "customer.parquet"))
    for landed, path in ((landing.search_payloads, "$.country_code"), (landing.location_payloads, "$.queried_country")):
        codes = landed(spark, str(tmp_path)).select(F.get_json_object("body", path)).collect()
        assert sorted(c or "" for (c,) in codes) == [""] * 4 + ["NL"] * 4


class _State:
    """Value and map states of one key, which count how often they are written."""

    def __init__(self):
        self.map, self.value, self.writes = {}, None, 0

    getValueState = getMapState = lambda self, *_: self  # noqa: E731, N815
    exists = lambda self: self.value is not None
    get = lambda self: self.value
    containsKey = lambda self, k: k in self.map  # noqa: E731, N815
    getValue = lambda self, k: self.map[k]  # noqa: E731, N815
    iterator = lambda self: iter(list(self.map.items()))

    def update(self, value):
        self.value, self.writes = value, self.writes + 1

    def updateValue(self, k, v):  # noqa: N802
        self.map[k], self.writes = v, self.writes + 1


def test_state_is_written_by_the_month():
    def batch(days):
        rows = [{"observation_date": f"2024-01-{n:02d}", "station_name": None, "country_code": "TN", **dict.fromkeys(series.FLAGS, 1.0)} for n in days]
        return [r.current_exceedance_streak_days for r in judge.handleInputRows(("s", "x"), rows, None)]

    state, judge = _State(), series.Exceedances()
    judge.init(state)
    assert batch(range(11, 31)) == list(range(1, 21)) and state.writes == 2
    assert batch(range(1, 11)) == list(range(1, 31)) and batch([31]) == [31] and state.writes == 6 and len(state.map) == 1


def test_few_messages_to_the_state_and_exact_values(monkeypatch):
    class Counted(_State):
        def __init__(self):
            super().__init__()
            self.calls = 0

        def __getattribute__(self, name):
            if name in ("exists", "get", "containsKey", "getValue", "iterator", "update", "updateValue"):
                self.calls += 1
            return super().__getattribute__(name)

    def batch(days):
        rows = [{"observation_date": d, "station_name": "n\x01\u00e9", "country_code": None, **dict.fromkeys(series.FLAGS, v)} for d, v in days]
        before = state.calls
        return [(r.observation_date, r.station_name, r.who_o3_exceed, r.current_exceedance_streak_days) for r in judge.handleInputRows(("s", "x"), rows, None)], state.calls - before

    state, judge = Counted(), series.Exceedances()
    judge.init(state)
    name = "n\x01\u00e9"
    assert batch([("2024-01-20", 1.0), ("2024-01-21", None)]) == ([("2024-01-20", name, 1.0, 1), ("2024-01-21", name, None, 0)], 3)
    assert batch([("2024-01-10", 1.0)])[1] == 4
    assert batch([("2024-01-22", 1.0)]) == ([("2024-01-22", name, 1.0, 1)], 4)
    assert batch([("2024-02-01", 0.1)]) == ([("2024-02-01", name, 0.1, 0)], 3)
    days, calls = batch([("2024-01-21", 1.0)])
    assert days == [("2024-01-21", name, 1.0, 3), ("2024-01-22", name, 1.0, 4), ("2024-02-01", name, 0.1, 0)] and calls == 5
