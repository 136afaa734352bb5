"""Landed API payloads to rows.

Each reader takes parsed payloads (``spark.read.schema(...).json(path)`` or ``from_json``)
and flattens them with generators, so one payload file is never held whole in Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meltemi import schemas
from meltemi import settings as S
from meltemi.functions.dates import stamp_date
from meltemi.functions.numeric import to_double


def read_json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Explicit schema: a field the API left out reads as null, a new field is ignored."""
    return spark.read.schema(ddl).json(path)


def parse_json(df: DataFrame, column: str, ddl: str) -> DataFrame:
    """The same for payloads landed as a text column.

    The one struct is inlined: Spark carries no filter on its fields below a generator, where each
    condition would build and parse the text once more.
    """
    return df.select(_once(F.from_json(column, ddl)))


def _once(struct: Column) -> Column:
    """The fields of a struct as columns, evaluated once a row however often they are read."""
    return F.inline(F.array(struct))


@dataclass(frozen=True)
class Shape:
    """What a payload must have to become rows: paths with their kinds, and a block of parallel arrays."""

    ddl: str
    paths: tuple[tuple[str, str], ...]
    block: str | None = None


# --- fixed values: the parts of each payload its rows cannot do without ------------------
SHAPES = {
    "hourly": Shape(schemas.HOURLY_PAYLOAD, (("station_id", "text"), ("hourly", "object"), ("hourly.time", "array")), "hourly"),
    "dust": Shape(schemas.HOURLY_PAYLOAD, (("station_id", "text"), ("hourly", "object"), ("hourly.time", "array")), "hourly"),
    "daily": Shape(schemas.DAILY_PAYLOAD, (("station_id", "text"), ("daily", "object"), ("daily.time", "array")), "daily"),
    "locations": Shape(schemas.LOCATIONS_PAYLOAD, (("queried_country", "text"), ("results", "array"))),
    "measurements": Shape(schemas.MEASUREMENTS_PAYLOAD, (("sensor_id", "number"), ("results", "array"))),
    "feed": Shape(schemas.FEED_PAYLOAD, (("target_date", "text"), ("feed", "object"), ("feed.time", "object"), ("feed.time.v", "number"))),
    "search": Shape(schemas.SEARCH_PAYLOAD, (("country_code", "text"), ("data", "array"))),
}
_VARIANT_KINDS = {"text": "STRING", "array": "ARRAY", "object": "OBJECT", "number": "BIGINT|DOUBLE|DECIMAL|FLOAT"}


def parse_or_quarantine(df: DataFrame, column: str, shape: Shape) -> tuple[DataFrame, DataFrame]:
    """Parsed payloads, and beside them those that cannot become rows: all columns of df and the reason.

    Together they account for every payload. A body is read as VARIANT once, so that a part of another
    kind than it should have is told from one that is missing.
    """
    body, document = F.col(column), F.col("_document")
    # Each step is a generator: a filter on the reason that reached below would parse the body once for each condition.
    read = df.select("*", _once(F.struct(F.try_parse_json(body).alias("_document"))))
    kinds = {f"_kind{k}": F.schema_of_variant(F.try_variant_get(document, f"$.{path}", "variant")) for k, (path, _) in enumerate(shape.paths)}
    read = read.select("*", _once(F.struct(F.schema_of_variant(document).alias("_kind"), *[kind.alias(name) for name, kind in kinds.items()])))
    fault = (
        F.when(body.isNull() | (F.trim(body) == ""), "empty body")
        .when(document.isNull(), "not JSON")
        .when(~F.col("_kind").startswith("OBJECT"), "not an object")
    )
    for k, (path, wanted) in enumerate(shape.paths):
        found = F.col(f"_kind{k}")
        fault = fault.when(found.isNull() | (found == "VOID"), f"no {path}")
        fault = fault.when(~found.rlike(f"^({_VARIANT_KINDS[wanted]})"), f"{path} is no {wanted}")
    used = ["_document", "_kind", *kinds]
    if shape.block:
        # Arrays side by side, one value an hour or day: a length of its own leaves no telling which.
        of_block = StructType.fromDDL(shape.ddl)[shape.block].dataType
        read = read.select("*", _once(F.struct(F.from_json(body, shape.ddl).alias("_parsed"))))
        block = f"_parsed.{shape.block}"
        sizes = F.array(*[F.size(f"{block}.{f.name}") for f in of_block.fields if f.name != "time"])
        read = read.withColumns({"_sizes": sizes, "_time": F.size(f"{block}.time")})
        fault = fault.when(F.exists("_sizes", lambda n: (n >= 0) & (n != F.col("_time"))), "arrays of unequal length")
        used += ["_parsed", "_sizes", "_time"]
    judged = read.withColumn("reason", fault)
    good = judged.filter("reason is null")
    parsed = good.select("_parsed.*") if shape.block else parse_json(good, column, shape.ddl)
    return parsed, judged.drop(*used).filter("reason is not null")


def _zip_arrays(block: str, fields: dict[str, str]) -> Column:
    """Parallel arrays of a block to an array of row structs, driven by its time array.

    arrays_zip is null when any input is null, so an absent variable becomes an empty array.
    """
    time = F.coalesce(F.col(f"{block}.time"), F.array().cast("array<string>"))
    values = [
        F.coalesce(F.col(f"{block}.{name}"), F.array().cast("array<double>")).alias(alias)
        for name, alias in fields.items()
    ]
    return F.arrays_zip(time.alias("time"), *values)


def hourly_rows(payloads: DataFrame) -> DataFrame:
    """Hourly air-quality payloads: one row per hour; an empty block gives no row."""
    rows = payloads.select(
        "station_id", F.inline(_zip_arrays("hourly", {name: name for name in S.POLLUTANTS}))
    )
    return rows.filter(F.col("time").isNotNull()).select(
        "station_id",
        "time",
        stamp_date(F.col("time")).alias("date"),
        *[to_double(name).alias(name) for name in S.POLLUTANTS],
    )


def hourly_dust_rows(payloads: DataFrame) -> DataFrame:
    """Hourly dust payloads: one row per hour; no dust block gives no row."""
    has_dust = F.col("hourly.dust").isNotNull()
    rows = payloads.filter(has_dust).select(
        "station_id", F.inline(_zip_arrays("hourly", {"dust": "dust"}))
    )
    return rows.filter(F.col("time").isNotNull()).select(
        "station_id", stamp_date(F.col("time")).alias("date"), to_double("dust").alias("dust")
    )


def daily_weather_rows(payloads: DataFrame) -> DataFrame:
    """Daily weather payloads: one row per day under the canonical variable names."""
    rows = payloads.select("station_id", F.inline(_zip_arrays("daily", S.DAILY_VARIABLES)))
    return rows.filter(F.col("time").isNotNull()).withColumnRenamed("time", "date")


def location_rows(payloads: DataFrame) -> DataFrame:
    """Station locations; one whose country differs from the queried one is dropped."""
    loc = F.col("loc")
    return (
        payloads.select("queried_country", F.explode("results").alias("loc"))
        .filter(loc["country"]["code"] == F.col("queried_country"))
        .select(
            loc["id"].cast("string").alias("station_id"),
            loc["name"].alias("station_name"),
            loc["locality"].alias("city"),
            loc["country"]["code"].alias("country_code"),
            loc["coordinates"]["latitude"].alias("latitude"),
            loc["coordinates"]["longitude"].alias("longitude"),
            loc["sensors"].alias("sensors"),
        )
    )


def sensor_rows(locations: DataFrame) -> DataFrame:
    """One row per sensor that measures a mapped parameter."""
    code = F.col("sensor")["parameter"]["id"]
    parameter = F.lit(None).cast("string")
    for number, name in S.PARAMETER_IDS.items():
        parameter = F.when(code == number, name).otherwise(parameter)
    return (
        locations.select(
            *[c for c in locations.columns if c != "sensors"], F.explode("sensors").alias("sensor")
        )
        .select("*", F.col("sensor")["id"].alias("sensor_id"), parameter.alias("parameter"))
        .drop("sensor")
        .filter(F.col("parameter").isNotNull())
    )


def measurement_rows(payloads: DataFrame) -> DataFrame:
    """Daily sensor values: non-null, not negative, dated by period start or else by stamp."""
    result = F.col("result")
    stamp = F.coalesce(
        F.nullif(result["period"]["datetimeFrom"]["utc"], F.lit("")),
        F.nullif(result["datetime"]["utc"], F.lit("")),
    )
    return (
        payloads.select("sensor_id", F.explode("results").alias("result"))
        .select("sensor_id", stamp_date(stamp).alias("date"), to_double(result["value"]).alias("value"))
        .filter(F.col("value").isNotNull() & (F.col("value") >= 0) & F.col("date").isNotNull())
    )


def first_measurement(payloads: DataFrame) -> DataFrame:
    """Single-day form: the first result of each payload, kept when not negative."""
    value = to_double(F.get(F.col("results"), F.lit(0))["value"])
    return payloads.select("sensor_id", value.alias("value")).filter("value >= 0")


def feed_rows(payloads: DataFrame) -> DataFrame:
    """Latest station readings within a day of the target date, all booked to that date."""
    feed = F.col("feed")
    reading_day = F.to_date(F.timestamp_seconds(feed["time"]["v"]))
    target = F.col("target_date").cast("date")
    geo = feed["city"]["geo"]
    return payloads.filter(F.abs(F.datediff(reading_day, target)) <= 1).select(
        feed["idx"].cast("string").alias("station_id"),
        feed["city"]["name"].alias("station_name"),
        feed["city"]["name"].alias("city"),
        "country_code",
        F.get(geo, F.lit(0)).alias("latitude"),
        F.get(geo, F.lit(1)).alias("longitude"),
        *[to_double(feed["iaqi"][key]["v"]).alias(name) for key, name in S.FEED_KEYS.items()],
        F.col("target_date").alias("date"),
        F.col("target_date").alias("partition_date"),
        F.lit("waqi").alias("source"),
    )


def search_hits(payloads: DataFrame) -> DataFrame:
    """Search results that carry a uid and a two-element position, in result order."""
    hit = F.col("hit")
    return (
        payloads.select("query_order", "country_code", F.posexplode("data").alias("position", "hit"))
        .filter(hit["uid"].isNotNull() & (F.size(hit["station"]["geo"]) == 2))
        .select(
            "query_order",
            "country_code",
            "position",
            hit["uid"].alias("uid"),
            hit["station"]["name"].alias("station_name"),
            F.get(hit["station"]["geo"], F.lit(0)).alias("latitude"),
            F.get(hit["station"]["geo"], F.lit(1)).alias("longitude"),
        )
    )
