import subprocess
import sys

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from meltemi.operators import anomaly
from tests.conftest import rows_of

AIR = """station_id string, station_name string, country_code string, source string, date string, partition_date string,
    pm2_5 double, ozone double, nitrogen_dioxide double"""


def readings(n=400, outliers=4):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(n):
        date = f"2024-01-{1 + i % 28:02d}"
        values = rng.normal((20, 60, 15), (3, 8, 2)).round(3).tolist()
        if i < outliers:
            values = [400.0 + i, 300.0, 200.0]
        rows.append((f"s{i % 40}", f"S{i % 40}", "TN", "openaq", date, date, *values))
    return rows


def test_feature_rows_need_a_source_and_one_value(frame):
    df = frame(AIR, [("a", "", "", "waqi", "d", "d", 1.0, 1.0, 1.0), ("b", "", "", "openaq", "d", "d", None, None, None),
                     ("c", "", "", "openaq", "d", "d", None, 2.0, None)])
    assert rows_of(anomaly.feature_rows(df), "station_id") == [("c",)]


def test_first_appearance_stations_are_left_out(frame):
    df = frame(AIR, [("a", "", "", "openaq", "d1", "d1", 1.0, 1.0, 1.0), ("a", "", "", "openaq", "d2", "d2", 1.0, 1.0, 1.0),
                     ("b", "", "", "openaq", "d1", "d1", 1.0, 1.0, 1.0), ("b", "", "", "openaq", "d1", "d1", 2.0, 1.0, 1.0)])
    assert rows_of(anomaly.established_rows(df), "station_id") == [("a",), ("a",)]


def test_too_few_rows_raise(frame):
    with pytest.raises(RuntimeError, match="usable"):
        anomaly.anomaly_alerts(frame(AIR, readings(9, 0)))
    lonely = [(f"s{i}", *r[1:]) for i, r in enumerate(readings(30, 0))]
    with pytest.raises(RuntimeError, match="established"):
        anomaly.anomaly_alerts(frame(AIR, lonely))


def test_outliers_rank_first_and_the_partitioning_does_not_matter(frame):
    df = frame(AIR, readings())
    results = []
    for parts in (1, 7):
        got = anomaly.anomaly_alerts(df.repartition(parts), trees=40, sample=64).collect()
        results.append(sorted((r.station_id, r.date, r.anomaly_score, r.is_anomaly) for r in got))
    assert results[0] == results[1]
    ranked = sorted(results[0], key=lambda r: r[2])
    assert {r[0] for r in ranked[:4]} == {"s0", "s1", "s2", "s3"}
    assert sum(r[3] for r in ranked) == 20 and all(r[2] < 0 for r in ranked)


def test_draws_come_from_the_whole_table_and_copies_keep_their_weight(spark):
    df = spark.range(90000).select(
        F.when(F.col("id") < 30000, F.lit("hot")).otherwise(F.concat(F.lit("s"), F.col("id").cast("string"))).alias("station_id"),
        F.lit("d").alias("date"), F.lit("openaq").alias("source"),
        *[F.col("id").cast("double").alias(f) if k == 0 else F.lit(1.0).alias(f) for k, f in enumerate(anomaly.FILLED)])
    df = df.withColumn(anomaly.FILLED[0], F.when(F.col("station_id") == "hot", 0.0).otherwise(F.col(anomaly.FILLED[0])))
    drawn = anomaly.draw_trees(df, 90000, trees=20, sample=100)
    got = drawn.collect()
    assert [n for _, n in rows_of(drawn.groupBy("tree").count())] == [100] * 20
    hot = sum(r[anomaly.FILLED[0]] == 0.0 for r in got)
    assert 520 < hot < 820  # a third of 2,000
    late = sum(r[anomaly.FILLED[0]] >= 65536 for r in got)
    assert 400 < late < 700  # 24,464 of 90,000
    for parts in (1, 4, 16):
        assert rows_of(anomaly.draw_trees(df.repartition(parts), 90000, trees=20, sample=100)) == rows_of(drawn)
    few = anomaly.draw_trees(df.limit(30), 30, trees=3, sample=100)
    assert rows_of(few.groupBy("tree").count()) == [(0, 30), (1, 30), (2, 30)]
    copies = anomaly.draw_trees(df.filter("station_id = 'hot'"), 30000, trees=3, sample=100)
    assert rows_of(copies.groupBy("tree").count()) == [(0, 100), (1, 100), (2, 100)]


def test_path_lengths_agree_with_a_walk_of_each_tree():
    rng = np.random.default_rng(1)
    points = rng.normal(size=(64, 3))
    trees = [anomaly.grow_tree(points, [1, t]) for t in range(5)]

    class Row:
        def __init__(self, tree, nodes):
            self.tree = tree
            self.__dict__.update(nodes)

    model = anomaly.pack([Row(t, nodes) for t, nodes in enumerate(trees)])

    def walk(nodes, x):
        at = 0
        while nodes["feature"][at] >= 0:
            at = nodes["left" if x[nodes["feature"][at]] <= nodes["threshold"][at] else "right"][at]
        return nodes["path"][at]

    probe = rng.normal(size=(20, 3)) * 3
    want = [np.mean([walk(nodes, x) for nodes in trees]) for x in probe]
    assert np.allclose(anomaly.path_means(probe, model), want)
    assert anomaly.average_path(1) == 0 and anomaly.average_path(2) == 1
    assert abs(anomaly.average_path(256) - 10.244) < 0.01


def test_worker_functions_run_where_the_package_is_not_installed(tmp_path):
    for name, fn in (("grow", anomaly.grow_tree), ("walk", anomaly.path_means), ("norm", anomaly.average_path)):
        (tmp_path / name).write_bytes(cloudpickle.dumps(fn))
    code = """
import pickle, sys
import numpy as np
grow, walk, norm = (pickle.load(open(n, 'rb')) for n in ('grow', 'walk', 'norm'))
assert len(grow(np.arange(30.0).reshape(10, 3), [1, 2])['feature']) > 1 and norm(256) > 10
assert 'meltemi' not in sys.modules
"""
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={"PATH": "/usr/bin"}, check=True)
