"""Fixed values of the data model: thresholds, bounds, labels and domains.

Every number and word here is part of the results, so each is stated once, as text.
"""

from __future__ import annotations

# --- fixed values: pollutants -------------------------------------------------------
POLLUTANTS = ("pm2_5", "pm10", "nitrogen_dioxide", "ozone")
WHO_GUIDELINE = {"pm2_5": 15.0, "pm10": 45.0, "nitrogen_dioxide": 25.0, "ozone": 100.0}
POLLUTANT_MAX = {"pm2_5": 1000.0, "pm10": 2000.0, "nitrogen_dioxide": 500.0, "ozone": 500.0}
WHO_FLAGS = {
    "pm2_5": "who_pm25_exceed",
    "pm10": "who_pm10_exceed",
    "nitrogen_dioxide": "who_no2_exceed",
    "ozone": "who_o3_exceed",
}
MIN_COMPLETENESS = 0.20

# Upper-inclusive PM2.5 edges of the US EPA tiers.
AQI_TIERS = (
    (12.0, "good"),
    (35.4, "moderate"),
    (55.4, "unhealthy_sensitive"),
    (150.4, "unhealthy"),
    (250.4, "very_unhealthy"),
)
AQI_TOP = "hazardous"
AQI_LABELS = ("good", "moderate", "unhealthy_sensitive", "unhealthy", "very_unhealthy",
              "hazardous", "unknown")

# --- fixed values: sources and provenance -------------------------------------------
AIR_SOURCES = ("openmeteo", "openaq", "waqi")
REQUIRED_AIR_SOURCES = ("openmeteo",)
CONCENTRATION_SOURCES = ("openmeteo", "openaq")
WEATHER_SOURCE = "openmeteo_weather"
GROUND_SENSOR = "ground_sensor"
MODEL_ESTIMATED = "model_estimated"
MODEL_GRID = "model_grid"

# Numeric parameter ids of the measurement network and short keys of the station feed.
PARAMETER_IDS = {2: "pm2_5", 1: "pm10", 5: "nitrogen_dioxide", 3: "ozone"}
FEED_KEYS = {"pm25": "pm2_5", "pm10": "pm10", "no2": "nitrogen_dioxide", "o3": "ozone"}

# --- fixed values: weather ----------------------------------------------------------
DAILY_VARIABLES = {
    "temperature_2m_max": "temp_max_c",
    "temperature_2m_min": "temp_min_c",
    "temperature_2m_mean": "temp_mean_c",
    "apparent_temperature_max": "apparent_temp_max_c",
    "precipitation_sum": "precipitation_mm",
    "wind_speed_10m_max": "wind_speed_max_kmh",
    "wind_gusts_10m_max": "wind_gust_max_kmh",
    "relative_humidity_2m_mean": "humidity_pct",
    "weather_code": "weather_code",
}
WEATHER_BOUNDS = {
    "temp_max_c": (-60.0, 60.0),
    "temp_min_c": (-60.0, 60.0),
    "temp_mean_c": (-60.0, 60.0),
    "apparent_temp_max_c": (-80.0, 80.0),
    "precipitation_mm": (0.0, 1000.0),
    "wind_speed_max_kmh": (0.0, 400.0),
    "wind_gust_max_kmh": (0.0, 500.0),
    "humidity_pct": (0.0, 100.0),
    "dust": (0.0, 10000.0),
}
WMO_CONDITIONS = {
    "clear": (0,),
    "cloudy": (1, 2, 3),
    "fog": (45, 48),
    "drizzle": (51, 53, 55, 56, 57),
    "rain": (61, 63, 65, 66, 67, 80, 81, 82),
    "snow": (71, 73, 75, 77, 85, 86),
    "thunderstorm": (95, 96, 99),
}
# Left-closed band edges: a value on an edge belongs to the band above it.
WIND_BANDS = ((20.0, "calm"), (39.0, "breezy"), (62.0, "windy"), (89.0, "gale"))
WIND_TOP = "storm"
DUST_BANDS = ((20.0, "none"), (50.0, "moderate"), (200.0, "high"))
DUST_TOP = "severe"

# Least to most severe.
CONDITION_ORDER = ("unknown", "clear", "cloudy", "fog", "drizzle", "rain", "snow", "thunderstorm")
WIND_ORDER = ("unknown", "calm", "breezy", "windy", "gale", "storm")
DUST_ORDER = ("unknown", "none", "moderate", "high", "severe")

# --- fixed values: heat and cold events ---------------------------------------------
BASELINE_ROWS = 30
BASELINE_MIN_ROWS = 10
HEAT_QUANTILE, COLD_QUANTILE = 0.90, 0.10
HEAT_FLOOR_C, COLD_CEILING_C = 30.0, 5.0
EXTREME_HEAT_C, SEVERE_COLD_C = 40.0, 0.0
WAVE_DAYS = 3
HEAT_ALERTS = ("none", "heat_advisory", "heatwave", "extreme_heatwave")
COLD_ALERTS = ("none", "cold_advisory", "cold_wave", "severe_cold_wave")
HEATWAVE = ("heatwave", "extreme_heatwave")
COLD_WAVE = ("cold_wave", "severe_cold_wave")

# --- fixed values: wildfire risk ----------------------------------------------------
RISK_OZONE_REF, RISK_PM25_REF = 180.0, 150.0
RISK_OZONE_SHARE, RISK_PM25_SHARE = 0.6, 0.4
RISK_LEVELS = ("low", "moderate", "high", "extreme")
# Right-closed: a value on an edge belongs to the level below it.
RISK_EDGES = ((25.0, "low"), (50.0, "moderate"), (75.0, "high"))
RISK_TOP = "extreme"

# --- fixed values: incremental windows ----------------------------------------------
WINDOW_DAYS = 60
REFRESH_DAYS = 14
FULL_REBUILD_WORDS = ("all", "full", "0")

# --- fixed values: anomaly model ----------------------------------------------------
ANOMALY_FEATURES = ("pm2_5", "ozone", "nitrogen_dioxide")
CONTAMINATION = 0.05
MIN_MODEL_ROWS = 10
N_TREES = 100
TREE_SAMPLE = 256
MODEL_SEED = 42

# --- fixed values: reporting --------------------------------------------------------
EXCLUDED_COUNTRIES = ("CL", "GB", "NL")
DISPLAY_DATES = 45
COVERAGE_LOOKBACK = 7
COVERAGE_MIN_RATIO, COVERAGE_MAX_RATIO = 0.45, 2.25
HEAVY_RAIN_MM = 10.0
DUSTY = ("high", "severe")
PROFILE_ROWS = 10
SEARCH_HITS = 3
LOCATIONS_PER_COUNTRY = 50

# --- fixed values: geography --------------------------------------------------------
EARTH_RADIUS_KM = 6371.0
ANCHOR_MAX_KM = 100.0
CITY_ANCHORS = {
    "LB": ((33.89, 35.50),),
    "MA": ((33.57, -7.59), (34.02, -6.84), (31.63, -8.01)),
    "TN": ((36.82, 10.17),),
    "DZ": ((36.74, 3.06),),
    "EG": ((30.06, 31.24), (31.20, 29.92)),
    "TR": ((41.01, 28.95), (39.93, 32.86)),
    "GR": ((37.98, 23.73),),
    "ES": ((40.42, -3.70), (41.39, 2.17)),
    "IT": ((41.90, 12.50), (45.46, 9.19)),
}
