"""Data model: schemas, feature lists and the fixed values every module shares."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, codes and thresholds the results depend on -----------------

OBS_SCHEMA = T.StructType(
    [
        T.StructField("session_id", T.StringType()),
        T.StructField("tick", T.IntegerType()),
        T.StructField("vehicle_id", T.IntegerType()),
        T.StructField("speed", T.DoubleType()),
        T.StructField("acceleration", T.DoubleType()),
        T.StructField("x", T.DoubleType()),
        T.StructField("y", T.DoubleType()),
        T.StructField("z", T.DoubleType()),
        T.StructField("yaw", T.DoubleType()),
        T.StructField("traffic_density", T.IntegerType()),
        T.StructField("weather", T.IntegerType()),
        T.StructField("weather_name", T.StringType()),
        T.StructField("town", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("congestion_label", T.StringType()),
    ]
)
OBS_COLUMNS = OBS_SCHEMA.fieldNames()

KEY = ["session_id", "tick", "vehicle_id"]
LABELS = ["Low", "Medium", "High"]
LABEL_SEVERITY = {"Low": 10, "Medium": 50, "High": 90}

# Columns a row must have to survive cleaning.
CRITICAL = ["speed", "acceleration", "traffic_density", "x", "y",
            "congestion_label", "weather", "hour", "town"]

SPEED_MAX = 200.0
ACCEL_MAX = 50.0
DENSITY_MAX = 199
MIN_SESSION_ROWS = 500
MIN_TOTAL_ROWS = 10_000

WEATHER_CODES = {
    "ClearNoon": 0, "CloudyNoon": 1, "WetNoon": 2, "WetCloudyNoon": 3,
    "MidRainyNoon": 4, "HardRainNoon": 5, "SoftRainNoon": 6,
    "ClearSunset": 7, "CloudySunset": 8, "WetSunset": 9, "WetCloudySunset": 10,
    "SoftRainSunset": 11, "MidRainSunset": 12, "HardRainSunset": 13,
    "ClearNight": 14, "CloudyNight": 15, "WetNight": 16, "WetCloudyNight": 17,
    "SoftRainNight": 18, "MidRainyNight": 19, "HardRainNight": 20,
}
DEFAULT_WEATHER = "ClearNoon"
# Right-closed intervals and their names.
SPEED_EDGES, SPEED_INTERVALS = [0, 5, 20, 50, 200], ["<5", "5-20", "20-50", "50+"]
DENSITY_EDGES, DENSITY_INTERVALS = [0, 3, 8, 15, 200], ["<3", "3-8", "8-15", "15+"]
HOUR_EDGES, HOUR_BUCKETS = [0, 6, 12, 18, 24], ["Night", "Morning", "Afternoon", "Evening"]
DROP_REASONS = ["null_critical_cols", "duplicates", "bad_acceleration", "bad_speed",
                "bad_density", "bad_label"]
# Words of an attribution sentence.
STRONG, WEAK, TOWARD, AWAY = "strongly", "slightly", "pushed toward", "pushed away from"
RAINY_CODES = [2, 3, 4, 5, 6, 9, 10, 11, 12, 13, 16, 17, 18, 19, 20]

TICKS_PER_SECOND = 20
LOG_INTERVAL = 5
WARMUP_SECONDS = 5
SECONDS_PER_LOGGED_TICK = LOG_INTERVAL / TICKS_PER_SECOND
PROXIMITY_RADIUS_M = 50.0

FEATURES = [
    "speed", "acceleration", "traffic_density", "speed_bin", "density_bin",
    "is_stationary", "is_high_density", "is_rush_hour", "is_rainy",
    "speed_x_density", "is_braking", "weather", "hour", "town_code", "yaw",
]
# Features computed from traffic density, which itself defines the label.
LEAKAGE = ["traffic_density", "density_bin", "is_high_density", "speed_x_density"]
MODEL_FEATURES = [f for f in FEATURES if f not in LEAKAGE]
SPLIT_COLUMNS = FEATURES + ["label", "congestion_label", *KEY, "x", "y"]

SPLIT_SHARES = {"train": 0.70, "val": 0.15, "test": 0.15}
# Underscore: hidden from partition discovery next to the split folders.
FEATURE_LIST = "_feature_cols.txt"
METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]

REASONS = {
    "stationary": "🔴 Vehicle is stationary — strong congestion signal",
    "slow": "🟡 Speed is low ({speed} km/h)",
    "braking": "🟡 High deceleration at low speed — stop-and-go traffic",
    "rush_hour": "🟡 Rush hour window (7–9am or 5–7pm)",
    "rainy": "🔵 Wet weather reduces vehicle speeds",
    "fast": "🟢 High speed indicates free-flow conditions",
    "none": "🔵 No dominant single signal — prediction from combined feature pattern",
}
# --------------------------------------------------------------------------------------

ACTOR_SCHEMA = T.StructType(
    [T.StructField("session_id", T.StringType()),
     T.StructField("raw_tick", T.IntegerType()),
     T.StructField("vehicle_id", T.IntegerType()),
     T.StructField("wheels", T.IntegerType())]
    + [T.StructField(c, T.DoubleType())
       for c in ["x", "y", "z", "yaw", "vx", "vy", "vz", "ax", "ay", "az"]]
)

COMPARISON_SCHEMA = T.StructType(
    [T.StructField("model", T.StringType())]
    + [T.StructField(m, T.DoubleType()) for m in METRICS]
)
