"""The given star-schema tables read as air-quality and weather landings.

events become station readings, customers stations, nations countries, lineitem a long
weather history. Every row takes part: where a case needs a sparse date or a single-day
station, rows are re-dated, never left out. Measurements are pre-aggregated per station-day
before any join, so one user with a third of all events costs one row per day downstream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meltemi.functions.numeric import ROUNDING_TYPE, round_even, round_raw
from meltemi.settings import AIR_SOURCES, POLLUTANTS

# --- fixed values: how the tables map to the domain ----------------------------------
AS_OF = "2024-01-31"
RUN_TS = "2024-01-31T06:00:00+00:00"
COUNTRIES = ("TN", "DZ", "MA", "LY", "EG", "LB", "GR", "TR", "IT", "FR", "ES", "CL", "GB", "NL")
COUNTRY_LAT = (36.82, 36.74, 33.57, 32.90, 30.06, 33.89, 37.98, 41.01, 41.90, 43.30, 40.42,
               -33.45, 51.51, 52.37)
COUNTRY_LON = (10.17, 3.06, -7.59, 13.18, 31.24, 35.50, 23.73, 28.95, 12.50, 5.37, -3.70,
               -70.67, -0.13, 4.90)
EVENT_POLLUTANT = {"view": "pm2_5", "click": "pm10", "purchase": "nitrogen_dioxide",
                   "signup": "ozone", "error": "dust"}
SPARSE_DATES = ("2024-01-12", "2024-01-20")
SINGLE_DATE = "2024-01-05"


_SCHEMAS: dict[tuple[str, str], StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One given table; its schema is read from a footer once and declared afterwards."""
    path = f"{sf_dir}/{name}.parquet"
    if (sf_dir, name) not in _SCHEMAS:
        _SCHEMAS[sf_dir, name] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[sf_dir, name]).parquet(path)


def _picked(values: tuple, key: str) -> str:
    items = ", ".join(f"'{v}'" if isinstance(v, str) else f"{v}D" for v in values)
    return f"element_at(array({items}), cast({key} % {len(values)} as int) + 1)"


def country_of(nation: str) -> str:
    return _picked(COUNTRIES, nation)


def latitude_of(user: str, nation: str) -> str:
    return f"({_picked(COUNTRY_LAT, nation)} + ({user} * 7 % 200) / 100D - 1D)"


def longitude_of(user: str, nation: str) -> str:
    return f"({_picked(COUNTRY_LON, nation)} + ({user} * 13 % 300) / 100D - 1.5D)"


def _even(text: str, digits: int) -> str:
    """The rounding rule of meltemi.functions.numeric as SQL text."""
    return f"cast(bround(cast({text} as {ROUNDING_TYPE}), {digits}) as double)"


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One station per customer."""
    code = country_of("c_nationkey")
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as user_id",
        f"concat('st', c_custkey, '_', lower({code})) as station_id",
        "c_name as station_name",
        """case when c_custkey % 3 <> 0 then case when c_custkey % 4 = 0 then ''
           when c_custkey % 4 <> 1 then concat('City ', c_nationkey) end end as city""",
        f"case when c_custkey % 11 <> 0 then {code} end as country_code",
        f"{latitude_of('c_custkey', 'c_nationkey')} as latitude",
        f"{longitude_of('c_custkey', 'c_nationkey')} as longitude",
        f"{_picked(AIR_SOURCES, 'c_custkey')} as source",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long measurements: user_id, date, parameter, value, weather code.

    Users 5 of 13 are booked to one date, and four fifths of two dates to the day after.
    """
    parameter = " ".join(f"when '{event}' then '{name}'" for event, name in EVENT_POLLUTANT.items())
    sparse = ", ".join(f"date'{day}'" for day in SPARSE_DATES)
    return table(spark, sf_dir, "events").selectExpr(
        "user_id",
        "ts",
        f"""cast(case when user_id % 13 = 5 then date'{SINGLE_DATE}'
            when to_date(ts) in ({sparse}) and user_id % 5 <> 0 then date_add(to_date(ts), 1)
            else to_date(ts) end as string) as date""",
        f"case event_type {parameter} end as parameter",
        "case when event_type = 'purchase' then value / 2 else value end as value",
        "value as raw_value",
        "try_cast(get_json_object(props, '$.k') as int) as code",
    )


def bronze_air(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze air quality, one row per station-day, with planted faults for the cleaner."""
    means = [
        F.expr(f"{_even(f'avg(value) filter (where parameter = {name!r})', 4)} as {name}")
        for name in POLLUTANTS
    ]
    days = readings(spark, sf_dir).groupBy("user_id", "date").agg(*means)
    return days.join(stations(spark, sf_dir), "user_id").selectExpr(
        "station_id", "station_name", "city", "country_code",
        "case when user_id % 29 = 11 then 999D else latitude end as latitude",
        "longitude",
        "case when user_id % 23 = 7 then pm2_5 * 20 else pm2_5 end as pm2_5",
        "case when user_id % 31 = 5 then -pm10 else pm10 end as pm10",
        "nitrogen_dioxide", "ozone", "date", "date as partition_date",
        f"'{RUN_TS}' as ingestion_ts", "source",
    )


def model_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Modelled PM2.5 per coordinate and date, present where a station-day has dust."""
    model = F.expr(f"{_even('avg(value) / 2', 4)} as model_pm2_5")
    days = readings(spark, sf_dir).filter("parameter = 'dust'").groupBy("user_id", "date").agg(model)
    return days.join(stations(spark, sf_dir), "user_id").select(
        "latitude", "longitude", "date", "model_pm2_5"
    )


def bronze_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze weather, one row per station-day."""
    measures = {
        "temp_max_c": "max(raw_value) / 5 + 10",
        "temp_min_c": "min(raw_value) / 5 - 5",
        "temp_mean_c": _even("avg(raw_value) / 10 + 10", 4),
        "apparent_temp_max_c": "max(raw_value) / 5 + 12",
        "precipitation_mm": "max(raw_value) filter (where parameter = 'nitrogen_dioxide') / 10",
        "wind_speed_max_kmh": "max(raw_value) filter (where parameter = 'pm10') / 2",
        "wind_gust_max_kmh": "max(raw_value) filter (where parameter = 'pm10')",
        "humidity_pct": _even("avg(raw_value) filter (where parameter = 'ozone')", 4),
        "weather_code": "max(code)",
        "dust": _even("avg(raw_value) filter (where parameter = 'dust')", 2),
    }
    days = readings(spark, sf_dir).groupBy("user_id", "date").agg(
        *[F.expr(f"{text} as {name}") for name, text in measures.items()]
    )
    return days.join(stations(spark, sf_dir), "user_id").selectExpr(
        "station_id", "station_name", "country_code", "latitude", "longitude", "date", *measures,
        "date as partition_date", f"'{RUN_TS}' as ingestion_ts", "'openmeteo_weather' as source",
    )


def weather_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Years of station-days: supplier by ship date."""
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", F.expr("cast(to_date(l_shipdate) as string) as partition_date"))
        .agg(
            F.expr("max(l_extendedprice) / 2500 + 5 as temp_max_c"),
            F.expr("min(l_extendedprice) / 2500 - 5 as temp_min_c"),
        )
        .selectExpr("concat('sup', l_suppkey) as station_id", "partition_date", "temp_max_c", "temp_min_c")
    )


# --- payload documents, one per source row --------------------------------------------
def _subjects(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The rows of a table that payloads are made of, dealt over all tasks.

    A row is a few bytes in its file and a document that takes a hundred times as long to build and
    to parse: the one split that a file of megabytes gives would be the whole job in one task.
    """
    return table(spark, sf_dir, name).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def _absent_unless(kind: Column, events: tuple[str, ...], values: list[Column]) -> Column:
    return F.when(kind.isin(*events), F.array(*[v.cast("double") for v in values]))


def _known(text: str, key: str) -> Column:
    """What is picked by a key; null for a null one, which element_at takes for the last place where it counts as never null."""
    return F.when(F.col(key).isNotNull(), F.expr(text))


def hourly_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly air-quality documents from events; some variables are absent, some blocks empty."""
    kind, v, none = F.col("event_type"), F.col("value"), F.lit(None).cast("double")
    start = F.date_trunc("hour", "ts")
    hours = [start + F.expr(f"interval {h} hours") for h in range(3)]
    stamps = F.array(*[F.date_format(h, "yyyy-MM-dd'T'HH:mm") for h in hours])
    block = F.struct(
        F.when(kind == "error", F.array().cast("array<string>")).otherwise(stamps).alias("time"),
        _absent_unless(kind, ("view", "click", "purchase"), [v, v + 1, none]).alias("pm2_5"),
        _absent_unless(kind, ("click", "purchase", "signup"), [v / 2, none, v]).alias("pm10"),
        _absent_unless(kind, ("purchase", "signup", "view"), [v / 4, v / 4, v / 4]).alias("nitrogen_dioxide"),
        _absent_unless(kind, ("view", "click", "purchase", "signup"), [v * 2, none, none]).alias("ozone"),
    )
    document = F.struct(F.col("user_id").cast("string").alias("station_id"), block.alias("hourly"))
    return _subjects(spark, sf_dir, "events").select(F.to_json(document).alias("body"))


def dust_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly dust documents from events; the dust block is missing on view events."""
    kind, v, none = F.col("event_type"), F.col("value"), F.lit(None).cast("double")
    start = F.date_trunc("hour", "ts")
    stamps = F.array(*[F.date_format(start + F.expr(f"interval {h} hours"), "yyyy-MM-dd'T'HH:mm") for h in (0, 12, 24)])
    block = F.struct(
        stamps.alias("time"),
        _absent_unless(kind, ("click", "purchase", "signup", "error"), [v, none, v * 2]).alias("dust"),
    )
    document = F.struct(F.col("user_id").cast("string").alias("station_id"), block.alias("hourly"))
    return _subjects(spark, sf_dir, "events").select(F.to_json(document).alias("body"))


def daily_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather documents of two days from events; rain is absent on view events."""
    kind, v, none = F.col("event_type"), F.col("value"), F.lit(None).cast("double")
    every = tuple(EVENT_POLLUTANT)
    day = F.to_date("ts")
    code = F.get_json_object("props", "$.k").try_cast("double")
    block = F.struct(
        F.array(day.cast("string"), F.date_add(day, 1).cast("string")).alias("time"),
        _absent_unless(kind, every, [v, v + 1]).alias("temperature_2m_max"),
        _absent_unless(kind, every, [v - 20, none]).alias("temperature_2m_min"),
        _absent_unless(kind, every, [v - 5, v - 4]).alias("temperature_2m_mean"),
        _absent_unless(kind, every, [v + 2, v + 3]).alias("apparent_temperature_max"),
        _absent_unless(kind, ("click", "purchase", "signup", "error"), [v / 10, none]).alias("precipitation_sum"),
        _absent_unless(kind, every, [v / 2, v / 2]).alias("wind_speed_10m_max"),
        _absent_unless(kind, every, [v, v]).alias("wind_gusts_10m_max"),
        _absent_unless(kind, every, [v / 4, v / 4]).alias("relative_humidity_2m_mean"),
        _absent_unless(kind, every, [code, none]).alias("weather_code"),
    )
    document = F.struct(F.col("user_id").cast("string").alias("station_id"), block.alias("daily"))
    return _subjects(spark, sf_dir, "events").select(F.to_json(document).alias("body"))


def location_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location documents from customers; every seventh answers with a foreign country."""
    user, nation = F.col("c_custkey"), F.col("c_nationkey")
    code = _known(country_of("c_nationkey"), "c_nationkey")
    lat = _known(latitude_of("c_custkey", "c_nationkey"), "c_nationkey")
    lon = _known(longitude_of("c_custkey", "c_nationkey"), "c_nationkey")
    sensors = F.array(
        *[
            F.struct((user * 10 + i).alias("id"), F.struct(F.lit(i).alias("id")).alias("parameter"))
            for i in range(1, 7)
        ]
    )

    def place(ident: Column, country: Column) -> Column:
        return F.struct(
            ident.alias("id"),
            F.col("c_name").alias("name"),
            F.when(user % 4 != 1, F.concat(F.lit("City "), nation.cast("string"))).alias("locality"),
            F.struct(country.alias("code")).alias("country"),
            F.struct(lat.alias("latitude"), lon.alias("longitude")).alias("coordinates"),
            sensors.alias("sensors"),
        )

    own = F.when(user % 7 == 0, _known(country_of("(c_nationkey + 1)"), "c_nationkey")).otherwise(code)
    document = F.struct(
        code.alias("queried_country"),
        F.array(place(user, own), place(user + 1000000, F.lit(None).cast("string"))).alias("results"),
    )
    return _subjects(spark, sf_dir, "customer").select(F.to_json(document).alias("body"))


def measurement_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sensor documents from orders, with negative, null and undated results among them."""
    price = F.col("o_totalprice")
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    no_text = F.lit(None).cast("string")

    def result(value: Column, period: Column, plain: Column) -> Column:
        return F.struct(
            value.cast("double").alias("value"),
            F.struct(F.struct(period.alias("utc")).alias("datetimeFrom")).alias("period"),
            F.struct(plain.alias("utc")).alias("datetime"),
        )

    document = F.struct(
        F.col("o_custkey").alias("sensor_id"),
        F.array(
            result(price / 1000, stamp, no_text),
            result(F.lit(-1.0), stamp, no_text),
            result(price / 2000, no_text, stamp),
            result(price / 4000, F.lit(""), stamp),
            result(F.lit(5.0), F.lit(""), no_text),
            result(F.lit(None), stamp, no_text),
        ).alias("results"),
    )
    return _subjects(spark, sf_dir, "orders").select(F.to_json(document).alias("body"))


def feed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station-feed documents from events, targeted up to two days off their reading."""
    kind, v, user = F.col("event_type"), F.col("value"), F.col("user_id")

    def reading(event: str) -> Column:
        return F.when(kind == event, F.struct(v.alias("v")))

    geo = F.when(kind != "error", F.array((user % 10 + 30).cast("double"), (user % 20).cast("double")))
    feed = F.struct(
        user.alias("idx"),
        F.struct(F.unix_seconds(F.col("ts").cast("timestamp")).alias("v")).alias("time"),
        F.struct(F.concat(F.lit("City "), (user % 25).cast("string")).alias("name"), geo.alias("geo")).alias("city"),
        F.struct(
            reading("view").alias("pm25"), reading("click").alias("pm10"),
            reading("purchase").alias("no2"), reading("signup").alias("o3"),
        ).alias("iaqi"),
    )
    target = F.date_add(F.to_date("ts"), (F.col("event_id") % 5 - 2).cast("int"))
    document = F.struct(_known(country_of("user_id"), "user_id").alias("country_code"), target.cast("string").alias("target_date"), feed.alias("feed"))
    return _subjects(spark, sf_dir, "events").select(F.to_json(document).alias("body"))


def search_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search documents from customers: a good hit, one without a full position, one without
    a uid, one far away."""
    user, nation = F.col("c_custkey"), F.col("c_nationkey")
    lat = _known(latitude_of("c_custkey", "c_nationkey"), "c_nationkey")
    lon = _known(longitude_of("c_custkey", "c_nationkey"), "c_nationkey")

    def hit(uid: Column, *geo: Column) -> Column:
        return F.struct(
            uid.cast("long").alias("uid"),
            F.struct(F.col("c_name").alias("name"), F.array(*geo).alias("geo")).alias("station"),
        )

    document = F.struct(
        nation.cast("int").alias("query_order"),
        _known(country_of("c_nationkey"), "c_nationkey").alias("country_code"),
        F.array(
            hit(user, lat, lon), hit(user + 1000000, lat), hit(F.lit(None), lat, lon),
            hit(user + 2000000, lat + 5, lon), hit(user % 500, lat, lon),
        ).alias("data"),
    )
    return _subjects(spark, sf_dir, "customer").select(F.to_json(document).alias("body"))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run log from events: one run per stage and day."""
    kind = F.col("event_type")
    stage = (
        F.when(kind == "view", "bronze_openmeteo").when(kind == "click", "bronze_openaq")
        .when(kind == "purchase", "silver").when(kind == "signup", "gold").otherwise("quality")
    )
    return (
        table(spark, sf_dir, "events")
        .groupBy(stage.alias("stage"), F.to_date("ts").alias("run_day"))
        .agg(
            F.date_trunc("second", F.max("ts").cast("timestamp")).alias("run_ts"),
            F.sum(F.when(F.col("value") > 100, 1).otherwise(0)).cast("long").alias("rows"),
            round_raw(F.sum("value"), 2).alias("duration_seconds"),
            F.sum(F.when(F.col("value") < 0.5, 1).otherwise(0)).cast("long").alias("quality_failures"),
        )
        .drop("run_day")
    )
