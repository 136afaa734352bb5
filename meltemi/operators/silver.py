"""Bronze to Silver: clean, fill PM2.5 from the model grid, enrich, canonical schema."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meltemi import settings as S
from meltemi.functions.dates import iso_date
from meltemi.functions.labels import aqi_category, dust_level, wind_level, wmo_condition
from meltemi.functions.numeric import clip, to_double
from meltemi.schemas import SILVER_AIR, SILVER_WEATHER, canonical


def _numbers_or_null(df: DataFrame, bounds: dict[str, tuple[float, float]]) -> dict[str, Column]:
    return {
        name: clip(to_double(name), low, high) if name in df.columns else F.lit(None).cast("double")
        for name, (low, high) in bounds.items()
    }


def _ensure_text(df: DataFrame, names: tuple[str, ...]) -> dict[str, Column]:
    return {n: F.lit(None).cast("string") for n in names if n not in df.columns}


def _coordinate(df: DataFrame, name: str) -> Column:
    return to_double(name) if name in df.columns else F.lit(None).cast("double")


def clean_air(df: DataFrame, source: str | None = None) -> DataFrame:
    """Coerce, clip and date-normalise; drop rows without identity or with an impossible place.

    With no source given, the frame's own source column is kept, so several sources can be
    cleaned in one pass.
    """
    bounds = {name: (0.0, S.POLLUTANT_MAX[name]) for name in S.POLLUTANTS}
    columns = _numbers_or_null(df, bounds) | _ensure_text(df, ("city", "country_code", "station_name"))
    columns |= {
        "latitude": _coordinate(df, "latitude"),
        "longitude": _coordinate(df, "longitude"),
        "date": iso_date(F.col("date")),
    }
    if source is not None:
        columns["source"] = F.lit(source)
    return (
        df.withColumns(columns)
        .dropna(subset=["station_id", "latitude", "longitude", "date"])
        .filter(F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180))
    )


def coordinate_key(degrees: Column) -> Column:
    """Coordinate rounded to four decimals, as a whole number of 1e-4 degrees."""
    return F.rint(degrees * 10000).cast("long")


def fill_pm25(df: DataFrame, grid: DataFrame) -> DataFrame:
    """Fill missing station PM2.5 from the model grid and record where each value came from.

    The grid has one value per coordinate and date, so the left join never multiplies rows;
    unmatched stations keep what they reported. Grid-source rows are model values already.
    """
    grid_keys = grid.groupBy(
        coordinate_key(F.col("latitude")).alias("_lat"),
        coordinate_key(F.col("longitude")).alias("_lon"),
        F.col("date").alias("_date"),
    ).agg(F.max("model_pm2_5").alias("_model"))
    joined = df.join(
        grid_keys,
        (coordinate_key(df["latitude"]) == F.col("_lat"))
        & (coordinate_key(df["longitude"]) == F.col("_lon"))
        & (df["date"] == F.col("_date")),
        "left",
    )
    own, from_grid_source = F.col("pm2_5"), F.col("source") == "openmeteo"
    provenance = (
        F.when(own.isNotNull() & from_grid_source, S.MODEL_GRID)
        .when(own.isNotNull(), S.GROUND_SENSOR)
        .when(~from_grid_source & F.col("_model").isNotNull(), S.MODEL_ESTIMATED)
    )
    filled = F.when(from_grid_source, own).otherwise(F.coalesce(own, F.col("_model")))
    return joined.withColumns({"pm2_5": filled, "pm2_5_source": provenance}).drop(
        "_lat", "_lon", "_date", "_model"
    )


def enrich_air(df: DataFrame, run_ts: str) -> DataFrame:
    """Completeness share (rows under the floor go), AQI tier and guideline flags."""
    present = reduce(lambda a, b: a + b, [F.col(p).isNotNull().cast("int") for p in S.POLLUTANTS])
    flags = {
        flag: (F.coalesce(F.col(name), F.lit(0.0)) > S.WHO_GUIDELINE[name]).cast("long")
        for name, flag in S.WHO_FLAGS.items()
    }
    return (
        # Quarters are exact, so this share needs no rounding.
        df.withColumn("data_completeness", present / F.lit(float(len(S.POLLUTANTS))))
        .filter(F.col("data_completeness") >= S.MIN_COMPLETENESS)
        .withColumns({"aqi_category": aqi_category(F.col("pm2_5")), **flags, "silver_ts": F.lit(run_ts)})
    )


def canonical_air(df: DataFrame) -> DataFrame:
    return canonical(df, SILVER_AIR, fill={flag: 0 for flag in S.WHO_FLAGS.values()})


def build_air(df: DataFrame, grid: DataFrame, run_ts: str, source: str | None = None) -> DataFrame:
    return canonical_air(enrich_air(fill_pm25(clean_air(df, source), grid), run_ts))


def union_sources(frames: dict[str, DataFrame], grid: DataFrame, run_ts: str) -> DataFrame:
    """Bronze tables of unlike columns into one canonical table.

    Each is cleaned under its own name first; the union then shares one grid join.
    """
    cleaned = [clean_air(df, name) for name, df in frames.items()]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cleaned)
    return canonical_air(enrich_air(fill_pm25(merged, grid), run_ts))


def clean_weather(df: DataFrame) -> DataFrame:
    """Coerce and clip nine variables; drop rows without identity or a daily high."""
    columns = _numbers_or_null(df, S.WEATHER_BOUNDS) | _ensure_text(df, ("station_name", "country_code"))
    columns |= {
        "latitude": _coordinate(df, "latitude"),
        "longitude": _coordinate(df, "longitude"),
        "weather_code": _coordinate(df, "weather_code"),
        "date": iso_date(F.col("date")),
        "source": F.lit(S.WEATHER_SOURCE),
    }
    return df.withColumns(columns).dropna(subset=["station_id", "date", "temp_max_c"])


def enrich_weather(df: DataFrame, run_ts: str) -> DataFrame:
    return df.withColumns(
        {
            "condition": wmo_condition(F.col("weather_code")),
            "wind_level": wind_level(F.col("wind_gust_max_kmh")),
            "dust_level": dust_level(F.col("dust")),
            "silver_ts": F.lit(run_ts),
        }
    )


def canonical_weather(df: DataFrame) -> DataFrame:
    return canonical(df, SILVER_WEATHER, fill={"weather_code": -1})


def build_weather(df: DataFrame, run_ts: str) -> DataFrame:
    return canonical_weather(enrich_weather(clean_weather(df), run_ts))


def air_with_weather(air: DataFrame, weather: DataFrame) -> DataFrame:
    """Air quality and weather share (station_id, date) by design."""
    names = ["temp_max_c", "temp_min_c", "condition", "wind_level", "dust_level"]
    return air.join(weather.select("station_id", "date", *names), ["station_id", "date"])
