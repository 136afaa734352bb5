"""Distance joins with a table of anchors, over a grid of cells in space.

Places on the sphere become points of three-dimensional space, where two places are within a distance
exactly if their points are within the chord of it. Cells are cubes with that chord as edge: an anchor
is entered in its own cell and the 26 around it, a row has one cell, and an equi-join brings together
what can be near; the exact distance comes last. Neither poles nor the date line are special. A cell
that holds many rows is split, and its anchors are copied to every part.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.functions.geo import haversine_km
from meltemi.functions.numeric import round_even, to_double
from meltemi.session import scratch_path

#: Rows of a cell from which it is split.
SPLIT_ROWS = 1_000_000
#: At most so many cells can hold more than this share of all rows, which bounds the list of split cells.
MOST_SPLIT = 4096
CELL = ["_x", "_y", "_z"]
#: Cells for the nearest anchor: how much wider each size is than the one before, how many sizes, and anchors a cell of the first.
STEP, LEVELS, CROWD = 4, 10, 4


def chord(km: float) -> float:
    """Straight distance of two points of the unit sphere that are km apart along it."""
    return 2 * math.sin(min(km / S.EARTH_RADIUS_KM, math.pi) / 2)


def cell_of(lat: Column, lon: Column, edge: float) -> list[Column]:
    phi, lam = F.radians(lat), F.radians(lon)
    point = (F.cos(phi) * F.cos(lam), F.cos(phi) * F.sin(lam), F.sin(phi))
    return [F.floor(p / edge).cast("int").alias(name) for p, name in zip(point, CELL)]


def _usable(lat: Column, lon: Column) -> Column:
    """Numbers a place can have; NaN compares above every number and drops out."""
    return lat.between(-90.0, 90.0) & lon.between(-1e6, 1e6)


def _sides(rows: DataFrame, anchors: DataFrame, max_km: float, split_rows: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows and entered anchors with the columns they join on."""
    # A hair wider, so that rounding cannot push a pair at just max_km two cells apart.
    edge = max(chord(max_km), 1e-6) * (1 + 1e-9)
    lat, lon = ((F.col(c) if rows.schema[c].dataType.typeName() == "double" else to_double(c)) for c in ("latitude", "longitude"))
    placed = rows.withColumns({"_lat": lat, "_lon": lon, "_country": F.upper(F.coalesce("country_code", F.lit("")))})
    placed = placed.filter(_usable(F.col("_lat"), F.col("_lon"))).select("*", *cell_of(F.col("_lat"), F.col("_lon"), edge))

    keys = ["_country", *CELL]
    counts = placed.groupBy(*keys).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    most = max(split_rows, total // MOST_SPLIT)
    # More than `most` rows each: no more than MOST_SPLIT cells can, whatever the table's size.
    crowded = F.broadcast(counts.filter(F.col("_n") > most).select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_parts")))
    part = F.pmod(F.xxhash64("_lat", "_lon", F.monotonically_increasing_id()), F.coalesce("_parts", F.lit(1)))
    placed = placed.join(crowded, keys, "left").withColumn("_part", part.cast("int")).drop("_parts")

    near = F.array(*[F.lit(d) for d in (-1, 0, 1)])
    entered = anchors.select(
        F.upper("country_code").alias("_country"), F.col("anchor_id").alias("_anchor"), F.col("latitude").cast("double").alias("_alat"),
        F.col("longitude").cast("double").alias("_alon"))
    entered = entered.filter(_usable(F.col("_alat"), F.col("_alon"))).select("*", *cell_of(F.col("_alat"), F.col("_alon"), edge))
    for axis in CELL:
        entered = entered.withColumn("_d", F.explode(near)).withColumn(axis, F.col(axis) + F.col("_d")).drop("_d")
    entered = entered.join(crowded, keys, "left").withColumn(
        "_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_parts")
    return placed, entered, [*keys, "_part"]


def _km() -> Column:
    return haversine_km(F.col("_lat"), F.col("_lon"), F.col("_alat"), F.col("_alon"))


def keep_near_anchors(
    rows: DataFrame, anchors: DataFrame, max_km: float = S.ANCHOR_MAX_KM, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Rows within max_km of any anchor of their country, and those whose country has no anchors.

    anchors: anchor_id, country_code, latitude, longitude, of any number. A row of a country with
    anchors and without usable coordinates goes. A semi-join keeps each row once, however many
    anchors are near, and stops at the first.
    """
    placed, entered, keys = _sides(rows, anchors, max_km, split_rows)
    theirs = entered.withColumnsRenamed({k: f"_a{k}" for k in keys})
    same = [F.col(k) == F.col(f"_a{k}") for k in keys]
    near = placed.join(theirs, [*same, _km() <= max_km], "left_semi").select(*rows.columns)
    code = F.upper(F.coalesce("country_code", F.lit("")))
    with_anchors = anchors.select(F.upper("country_code").alias("_country")).filter("_country is not null").distinct()
    free = rows.withColumn("_country", code).join(with_anchors, "_country", "left_anti").select(*rows.columns)
    return near.unionByName(free)


def nearest_anchor(
    rows: DataFrame, key: str, anchors: DataFrame, max_km: float = S.ANCHOR_MAX_KM, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """(key, anchor_id, km): the nearest anchor of the row's country within max_km; ties go to the smaller id.

    Distances are compared at a tenth of a metre. Cells are tried from small to large: an anchor nearer
    than a cell's edge is among the neighbours of that cell, so a row that finds one is done, and only
    the others go on to cells four times as wide, up to max_km. The first cells are so small that an
    anchor shares its own with few others.
    """
    placed = anchors.filter(_usable(F.col("latitude").cast("double"), F.col("longitude").cast("double")))
    spots = _stored(placed.groupBy(F.upper("country_code").alias("country_code"), *[F.col(c).cast("double").alias(c) for c in ("latitude", "longitude")]).agg(
        F.min(F.struct("anchor_id")).alias("_first")).select("_first.anchor_id", "country_code", "latitude", "longitude"), "anchors")
    rest, done = rows, None
    for level in range(_finest(spots, max_km), -1, -1):
        reach = max_km / STEP ** level
        placed, entered, keys = _sides(rest, spots, reach, split_rows)
        near = placed.join(entered, keys, "left").withColumn("km", _km())
        best = F.min(F.when(F.col("_alat").isNotNull() & (F.col("km") <= max_km), F.struct(round_even("km", 4).alias("km"), F.col("_anchor").alias("anchor_id"))))
        tried = _stored(near.groupBy(F.col(key), F.col("_country").alias("country_code"), F.col("_lat").alias("latitude"), F.col("_lon").alias("longitude")).agg(
            best.alias("_best")), "nearest")
        # Whatever is as near as the best at a tenth of a metre must be inside as well.
        sure = F.col("_best").isNotNull() if level == 0 else F.coalesce(F.col("_best.km") <= reach - 0.001, F.lit(False))
        found = tried.filter(sure).select(key, "_best")
        done = found if done is None else done.unionByName(found)
        rest = tried.filter(~sure).drop("_best")
    return done.groupBy(key).agg(F.min("_best").alias("_best")).select(key, "_best.anchor_id", "_best.km")


def _finest(spots: DataFrame, max_km: float) -> int:
    """How often cells are made smaller: until an anchor shares its cell with CROWD others or fewer on average."""
    lat, lon = F.col("latitude"), F.col("longitude")
    cells = [F.struct(F.lit(k).alias("_k"), *cell_of(lat, lon, max(chord(max_km / STEP ** k), 1e-9))) for k in range(LEVELS)]
    counts = spots.filter(_usable(lat, lon)).select("country_code", F.inline(F.array(*cells))).groupBy("country_code", "_k", *CELL).agg(F.count("*").alias("_n"))
    # One row per level.
    shared = {r["_k"]: r["shared"] for r in counts.groupBy("_k").agg((F.sum(F.col("_n") * F.col("_n")) / F.sum("_n")).alias("shared")).collect()}
    return next((k for k in range(LEVELS) if shared.get(k, 0) <= CROWD), LEVELS - 1)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
