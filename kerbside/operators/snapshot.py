"""Observations derived from raw actor states (position, velocity, acceleration vectors)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from kerbside.functions import columns as C
from kerbside.schema import (DEFAULT_WEATHER, LOG_INTERVAL, PROXIMITY_RADIUS_M, TICKS_PER_SECOND,
                             WARMUP_SECONDS, WEATHER_CODES)
from kerbside.operators.spatial import proximity_density


def downsample_ticks(df: DataFrame, interval: int = LOG_INTERVAL,
                     warmup: int = WARMUP_SECONDS * TICKS_PER_SECOND) -> DataFrame:
    """Skip the warm-up, keep every ``interval``-th tick, number the kept ones densely."""
    since = F.col("raw_tick") - warmup
    return (df.where((F.col("raw_tick") >= warmup) & (F.pmod(since, F.lit(interval)) == 0))
            .withColumn("tick", F.floor(since / interval).cast("int")))


def keep_vehicles(df: DataFrame, min_wheels: int = 4) -> DataFrame:
    return df.where(F.col("wheels") >= min_wheels)


def keep_live(df: DataFrame) -> DataFrame:
    """Actors without a position were destroyed between ticks."""
    return df.where(F.col("x").isNotNull() & F.col("y").isNotNull())


def add_kinematics(df: DataFrame) -> DataFrame:
    """Speed in km/h and acceleration in m/s2 from vectors, positions rounded as stored."""
    return df.withColumns({
        "speed": F.round(C.magnitude("vx", "vy", "vz") * 3.6, 3),
        "acceleration": F.round(C.magnitude("ax", "ay", "az"), 4),
        "x": F.round("x", 3), "y": F.round("y", 3), "z": F.round("z", 3),
        "yaw": F.round("yaw", 2)})


def weather_dimension(spark) -> DataFrame:
    return spark.createDataFrame(list(WEATHER_CODES.items()), "weather_name string, weather int")


def encode_weather(df: DataFrame, preset: str = "preset") -> DataFrame:
    """Code of a preset (-1 when unknown) and the preset that is applied in its place.

    The dimension has 21 rows, so broadcasting it is safe at any scale.
    """
    names = F.broadcast(weather_dimension(df.sparkSession))
    known = df.join(names, F.col(preset) == F.col("weather_name"), "left")
    return known.withColumns({
        "weather": F.coalesce("weather", F.lit(-1)),
        "applied_weather": F.coalesce("weather_name", F.lit(DEFAULT_WEATHER))}).drop("weather_name")


def add_session_id(df: DataFrame, started: str = "started", town: str = "town",
                   preset: str = "preset") -> DataFrame:
    return df.withColumn("session_id", C.session_id(started, town, preset))


def observe(df: DataFrame, radius: float = PROXIMITY_RADIUS_M) -> DataFrame:
    """Whole derivation: filters, ticks, kinematics, proximity density, label.

    ``df`` has one state per session, raw tick and vehicle. The label uses the unrounded
    speed, as the stored one may round across a threshold.
    """
    live = (df.transform(downsample_ticks).transform(keep_vehicles).transform(keep_live))
    density = live.select("session_id", "tick", "vehicle_id", "x", "y").transform(
        proximity_density, radius)
    exact = live.withColumn("_exact_speed", C.magnitude("vx", "vy", "vz") * 3.6)
    return (exact.transform(add_kinematics)
            .join(density.hint("merge"), ["session_id", "tick", "vehicle_id"])
            .withColumn("congestion_label", C.congestion_label("traffic_density", "_exact_speed"))
            .drop("_exact_speed"))
