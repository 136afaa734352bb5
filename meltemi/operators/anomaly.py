"""Isolation Forest (Liu, Ting and Zhou, ICDM 2008) over station readings.

The table is never brought together: each tree draws its 256 rows from all of it by hash, is
grown in a task of its own, and the grown trees (under 51,200 nodes in all) are broadcast to
score every row where it lies. All draws are hashes of row content, so a seed gives the same
model however the table is partitioned.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.functions.numeric import round_even
from meltemi.operators.quantiles import group_quantiles
from meltemi.session import scratch_path

# The functions below travel inside their tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

OVERDRAW = 4
VALUE_SPAN = (0.0, max(S.POLLUTANT_MAX[f] for f in S.ANOMALY_FEATURES))
SCORE_SPAN = (-1.0, 0.0)
FEATURES = list(S.ANOMALY_FEATURES)
FILLED = [f"_{f}" for f in FEATURES]
KEY = ["station_id", "date", "source", *FILLED]
OUTPUT = ["station_id", "station_name", "country_code", "source", "date", "partition_date", *FEATURES]

TREE = """tree int, feature array<int>, threshold array<double>, left array<int>,
    right array<int>, path array<double>, drawn int"""


def feature_rows(silver: DataFrame) -> DataFrame:
    """Concentration sources only, with at least one of the three features present."""
    return silver.filter(F.col("source").isin(*S.CONCENTRATION_SOURCES)).dropna(
        how="all", subset=FEATURES
    )


def established_rows(features: DataFrame) -> DataFrame:
    """Rows of stations seen on two dates or more.

    Two distinct dates exist exactly when the earliest and the latest differ, which combines
    map-side where a distinct count would not.
    """
    span = features.groupBy("station_id").agg(F.min("date").alias("_first"), F.max("date").alias("_last"))
    return features.join(span.filter("_first < _last"), "station_id", "left_semi")


def feature_medians(features: DataFrame) -> DataFrame:
    """Median of each feature as (feature, median): exact, and spread over many tasks."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in FEATURES])
    return group_quantiles(features.select(F.inline(pairs)), ["feature"], "value", 0.5, "median", *VALUE_SPAN, few_groups=True)


def impute(features: DataFrame) -> DataFrame:
    """Feature columns with nulls replaced by the median, under underscore names.

    The three medians reach the rows as one scalar subquery.
    """
    medians = feature_medians(features)
    by_name = medians.agg(F.map_from_entries(F.collect_list(F.struct("feature", "median")))).scalar()
    return (
        features.withColumn("_medians", by_name)
        .withColumns({f"_{f}": F.coalesce(F.col(f), F.col("_medians")[f]) for f in FEATURES})
        .drop("_medians")
    )


def _uniform(*parts: Column | str) -> Column:
    """Hash of row content as a number in [0, 1)."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 48)) / float(1 << 48)


def draw_trees(
    rows: DataFrame, n: int, trees: int = S.N_TREES, sample: int = S.TREE_SAMPLE, seed: int = S.MODEL_SEED,
    overdraw: int = OVERDRAW,
) -> DataFrame:
    """Exactly min(sample, n) rows for each tree, without replacement, by tickets drawn from all n rows.

    Equal rows are counted first, with map-side partials, so a group of copies is one row. Each
    copy has a ticket per tree, uniform in [0, 1), of which only those below a bar that about
    overdraw * sample rows pass leave their task. Which trees a group enters is drawn by the gaps
    between them, which are geometric: one hash says for most rows of a large table that no tree takes
    them. The tickets of c copies are drawn as order statistics, smallest first: one minus the k-th is
    the product of (1 - h_i) ** (1 / (c - i + 1)) for i up to k, the first of them given that it is
    below the bar. Of a group, the `sample` smallest are all a tree can take.
    """
    # xxhash64 of row content, so neither partitioning nor a repeated task changes a draw.
    copies = rows.groupBy(*KEY).agg(F.count("*").alias("_copies"))
    bar = min(1.0, overdraw * sample / max(n, 1))
    # Logarithm of the chance that all tickets of a group miss one tree's bar.
    miss = F.lit(math.log1p(-bar) if bar < 1 else -math.inf) * F.col("_copies")

    def trees_passed(turn: Column) -> Column:
        gap = F.floor(F.log1p(-_uniform(F.lit(seed), F.lit("gap"), *KEY, turn)) / miss)
        return F.least(gap, F.lit(trees)).cast("int")

    met = copies.withColumn("_first", trees_passed(F.lit(0))).filter(F.col("_first") < trees)
    start = F.struct(F.col("_first").alias("at"), F.array("_first").alias("trees"))

    def further(held: Column, turn: Column) -> Column:
        at = held["at"] + 1 + trees_passed(turn)
        return F.struct(at.alias("at"), F.when(at < trees, F.concat(held["trees"], F.array(at))).otherwise(held["trees"]).alias("trees"))

    later = F.sequence(F.lit(1), F.lit(trees))
    entered = met.withColumn("tree", F.explode(F.aggregate(later, start, further, lambda held: held["trees"]))).drop("_first")

    def step(tree: Column, k: Column) -> Column:
        left = (F.col("_copies") - k + 1).cast("double")
        # The first ticket is below the bar, with the chance -expm1(miss) that one is.
        under = F.when(k == 1, -F.expm1(miss)).otherwise(1.0)
        return F.pow(1 - under * _uniform(F.lit(seed), tree, *KEY, k), 1 / left)

    first = F.lit(1)
    taken = F.sequence(first, F.least("_copies", F.lit(sample)).cast("int"))
    tickets = F.transform(
        taken, lambda k: 1 - F.aggregate(F.sequence(first, k), F.lit(1.0), lambda held, i: held * step(F.col("tree"), i))
    )
    drawn = entered.select("*", F.posexplode(tickets).alias("_copy", "_ticket")).filter(F.col("_ticket") < bar)
    order = Window.partitionBy("tree").orderBy("_ticket", *KEY, "_copy")
    # A stated number of partitions: AQE would merge these few rows into one task, and the
    # trees would then be grown one after the other.
    return (
        drawn.repartition(trees, "tree")
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= sample)
        .select("tree", "_rank", *FILLED)
    )


def average_path(n: int) -> float:
    """Mean depth of an unsuccessful search in a binary tree of n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + np.euler_gamma) - 2.0 * (n - 1) / n


def grow_tree(points: np.ndarray, seed: list[int]) -> dict[str, list]:
    """One isolation tree as flat arrays; leaves carry their path length."""
    rng = np.random.default_rng(seed)
    limit = math.ceil(math.log2(max(len(points), 2)))
    nodes: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "path")}

    def add(rows: np.ndarray, depth: int) -> int:
        me = len(nodes["feature"])
        for name, value in (("feature", -1), ("threshold", 0.0), ("left", me), ("right", me), ("path", 0.0)):
            nodes[name].append(value)
        low, high = rows.min(axis=0), rows.max(axis=0)
        splittable = np.flatnonzero(high > low)
        if depth >= limit or len(splittable) == 0:
            nodes["path"][me] = depth + average_path(len(rows))
            return me
        f = int(rng.choice(splittable))
        cut = float(rng.uniform(low[f], high[f]))
        below = rows[:, f] <= cut
        if below.all():  # the draw fell on the maximum itself
            cut = float(low[f])
            below = rows[:, f] <= cut
        nodes["feature"][me], nodes["threshold"][me] = f, cut
        nodes["left"][me] = add(rows[below], depth + 1)
        nodes["right"][me] = add(rows[~below], depth + 1)
        return me

    add(points, 0)
    return nodes


def fit_forest(samples: DataFrame, seed: int = S.MODEL_SEED) -> DataFrame:
    """One row per tree, each grown in its own task from at most TREE_SAMPLE rows."""

    def grow(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(key[0])
        points = pdf.sort_values("_rank")[FILLED].to_numpy(dtype="float64")
        nodes = grow_tree(points, [seed, tree])
        return pd.DataFrame([{"tree": tree, **nodes, "drawn": len(points)}])

    return samples.groupBy("tree").applyInPandas(grow, schema=TREE)


def grow_forest(rows: DataFrame, n: int, trees: int, sample: int, seed: int) -> dict[str, np.ndarray]:
    """Draw, grow and pack; should a tree come out short, all are drawn again with a higher bar."""
    overdraw = OVERDRAW
    while True:
        grown = fit_forest(draw_trees(rows, n, trees, sample, seed, overdraw), seed).collect()  # bounded: trees x 2 x sample nodes
        if len(grown) == trees and all(t.drawn == min(sample, n) for t in grown):
            return pack(grown)
        overdraw *= 4


def pack(trees: list) -> dict[str, np.ndarray]:
    """All trees in one set of arrays, child indices shifted to match."""
    trees = sorted(trees, key=lambda t: t.tree)
    starts = np.cumsum([0] + [len(t.feature) for t in trees[:-1]])
    return {
        "roots": starts.astype("int32"),
        "feature": np.concatenate([np.array(t.feature, "int32") for t in trees]),
        "threshold": np.concatenate([np.array(t.threshold, "float64") for t in trees]),
        "left": np.concatenate([np.array(t.left, "int32") + s for t, s in zip(trees, starts)]),
        "right": np.concatenate([np.array(t.right, "int32") + s for t, s in zip(trees, starts)]),
        "path": np.concatenate([np.array(t.path, "float64") for t in trees]),
    }


def path_means(points: np.ndarray, model: dict[str, np.ndarray]) -> np.ndarray:
    """Mean path length per row: all trees step down one level at a time."""
    at = np.broadcast_to(model["roots"], (len(points), len(model["roots"]))).copy()
    row = np.arange(len(points))[:, None]
    while True:
        f = model["feature"][at]
        if (f < 0).all():
            return model["path"][at].mean(axis=1)
        goes_left = points[row, np.maximum(f, 0)] <= model["threshold"][at]
        at = np.where(f < 0, at, np.where(goes_left, model["left"][at], model["right"][at]))


def score(rows: DataFrame, model: dict[str, np.ndarray], sample: int) -> DataFrame:
    """Add _score = -2^(-E[path] / c(sample)): always negative, lower is more anomalous."""
    shared = rows.sparkSession.sparkContext.broadcast(model)
    norm = average_path(sample) or 1.0
    block = 4096

    @F.pandas_udf("double")
    def forest_score(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
        points = np.column_stack([a, b, c]).astype("float64")
        parts = [path_means(points[i:i + block], shared.value) for i in range(0, len(points), block)]
        return pd.Series(-np.exp2(-np.concatenate(parts) / norm))

    return rows.withColumn("_score", forest_score(*FILLED))


def anomaly_alerts(
    silver: DataFrame, contamination: float = S.CONTAMINATION, trees: int = S.N_TREES,
    sample: int = S.TREE_SAMPLE, seed: int = S.MODEL_SEED,
) -> DataFrame:
    """Score and flag every usable reading; the lowest share is flagged.

    The prepared features and the scores are each written once to the shared scratch folder,
    so neither the joins nor the Python scoring runs again for a later pass or a lost executor.
    """
    spark = silver.sparkSession
    usable = Observation()
    features = feature_rows(silver).select(*OUTPUT).observe(usable, F.count(F.lit(1)).alias("rows"))
    features_path, prepared_path = scratch_path(spark, "anomaly-features"), scratch_path(spark, "anomaly-prepared")
    features.write.parquet(features_path)
    if usable.get["rows"] < S.MIN_MODEL_ROWS:
        raise RuntimeError(f"only {usable.get['rows']} usable concentration rows (< {S.MIN_MODEL_ROWS})")
    # Written before imputing: medians, imputed rows and draws then read a table, not Silver again.
    features = spark.read.parquet(features_path)
    established_path = scratch_path(spark, "anomaly-established")
    established_rows(features).write.parquet(established_path)
    kept = Observation()
    impute(spark.read.parquet(established_path)).observe(kept, F.count(F.lit(1)).alias("rows")).write.parquet(prepared_path)
    prepared = spark.read.parquet(prepared_path)
    n = kept.get["rows"]
    if n < S.MIN_MODEL_ROWS:
        raise RuntimeError(f"only {n} established-station rows remain (< {S.MIN_MODEL_ROWS})")

    model = grow_forest(prepared, n, trees, sample, seed)
    scored_path = scratch_path(spark, "anomaly-scores")
    score(prepared, model, min(sample, n)).write.parquet(scored_path)
    scored = spark.read.parquet(scored_path)
    bar = group_quantiles(scored, [], "_score", contamination, "bar", *SCORE_SPAN, few_groups=True).scalar()
    return scored.select(
        *OUTPUT,
        round_even(F.col("_score"), 6).alias("anomaly_score"),
        (F.col("_score") < bar).cast("long").alias("is_anomaly"),
    )
