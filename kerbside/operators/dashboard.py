"""Dashboard tables: filter choices, filters, KPI cards, per-session summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions import columns as C

ALL = "All"


def _share_high() -> Column:
    high = F.coalesce(F.col("congestion_label") == "High", F.lit(False))
    return F.avg(high.cast("double")) * 100.0


def filter_choices(df: DataFrame) -> DataFrame:
    """Distinct towns and weathers plus ``All`` for each, from one pass."""
    pairs = F.array(F.struct(F.lit("town").alias("dimension"), F.col("town").alias("choice")),
                    F.struct(F.lit("weather").alias("dimension"),
                             F.col("weather_name").alias("choice")))
    found = (df.select(F.explode(pairs).alias("p")).select("p.*")
             .where("choice IS NOT NULL").distinct())
    always = df.sparkSession.createDataFrame([("town", ALL), ("weather", ALL)],
                                             "dimension string, choice string")
    return always.unionByName(found).distinct().orderBy("dimension", F.col("choice") != ALL, "choice")


def filtered(df: DataFrame, town: str = ALL, weather: str = ALL) -> DataFrame:
    """Optional equality filters; they reach the scan of a stored table."""
    out = df
    if town != ALL:
        out = out.where(F.col("town") == town)
    if weather != ALL and "weather_name" in df.columns:
        out = out.where(F.col("weather_name") == weather)
    return out


def kpi(df: DataFrame) -> DataFrame:
    """Rows, sessions, mean speed, percent High.

    One grouping by session carries the sums, so the distinct count costs no extra shuffle.
    """
    high = F.coalesce(F.col("congestion_label") == "High", F.lit(False))
    speed = F.when(~F.isnan("speed"), F.col("speed"))
    part = df.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(speed).alias("s"), F.count(speed).alias("c"),
        F.count_if(high).alias("h"))
    return part.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count("session_id").alias("n_sessions"),
        C.steady(F.try_divide(F.sum("s"), F.sum("c")), 1).alias("avg_speed"),
        C.steady(F.try_divide(100.0 * F.sum("h"), F.sum("n")), 1).alias("pct_high"))


def session_summary(df: DataFrame) -> DataFrame:
    return (df.where(F.col("session_id").isNotNull()).groupBy("session_id")
            .agg(F.count("speed").alias("n_rows"), C.steady(F.avg("speed"), 2).alias("avg_speed"),
                 C.steady(F.avg("traffic_density"), 2).alias("avg_density"),
                 C.steady(_share_high(), 2).alias("pct_high")))
