"""Queries: cleaning, features, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.functions import columns as C
from kerbside.operators import cleaning, features, split
from kerbside.plans.registry import query
from kerbside.plans.tables import ORDER, observations, plain, sql, worked_out
from kerbside.schema import MODEL_FEATURES, OBS_COLUMNS, SPLIT_COLUMNS

OBS_LIST = ", ".join(OBS_COLUMNS)
KEYS = "session_id, tick, vehicle_id"


def cleaned(spark, sf_dir, share=None):
    """``share``: only the keys whose hash lies below it; the rest is left out before the shuffle."""
    rows = observations(spark, sf_dir)
    rows = rows if share is None else rows.where(split.key_below(share))
    return worked_out(rows).transform(cleaning.clean, ORDER)


@query("scan_observations", sql("obs", f"SELECT {OBS_LIST} FROM obs"))
def scan_observations(spark, sf_dir):
    return observations(spark, sf_dir).select(*OBS_COLUMNS)


@query("clean_dropna", sql("complete", f"SELECT {OBS_LIST} FROM complete"))
def clean_dropna(spark, sf_dir):
    return plain(observations(spark, sf_dir).transform(cleaning.drop_incomplete))


@query("clean_dedup", sql("deduped", f"SELECT {OBS_LIST} FROM deduped"))
def clean_dedup(spark, sf_dir):
    return plain(observations(spark, sf_dir).transform(cleaning.drop_incomplete)
                 .transform(cleaning.deduplicate, ORDER))


@query("clean_accel", sql("obs", f"""SELECT {OBS_LIST} FROM obs
    WHERE acceleration >= 0 AND acceleration <= 50"""))
def clean_accel(spark, sf_dir):
    return plain(observations(spark, sf_dir)
                 .transform(cleaning.keep_range, "acceleration", 0, 50.0))


@query("clean_speed", sql("obs", f"SELECT {OBS_LIST} FROM obs WHERE speed >= 0 AND speed <= 200"))
def clean_speed(spark, sf_dir):
    return plain(observations(spark, sf_dir).transform(cleaning.keep_range, "speed", 0, 200.0))


@query("clean_density", sql("obs", f"SELECT {OBS_LIST} FROM obs WHERE traffic_density >= 0"))
def clean_density(spark, sf_dir):
    return plain(observations(spark, sf_dir)
                 .transform(cleaning.keep_range, "traffic_density", 0, None))


@query("clean_label", sql("obs", f"""SELECT {OBS_LIST} FROM obs
    WHERE congestion_label IN ('Low', 'Medium', 'High')"""))
def clean_label(spark, sf_dir):
    return plain(observations(spark, sf_dir).transform(cleaning.keep_labels))


@query("clean_all", sql("clean", f"SELECT {OBS_LIST} FROM clean"))
def clean_all(spark, sf_dir):
    return plain(cleaned(spark, sf_dir))


@query("clean_report", sql(
    "clean",
    """SELECT CAST(step AS INT) AS step, reason, CAST(n AS BIGINT) AS n_rows,
         round(100e0 * n / (SELECT count(*) FROM obs), 3) AS pct_of_input
       FROM lost""",
    s1="SELECT * FROM deduped WHERE acceleration >= 0 AND acceleration <= 50",
    s2="SELECT * FROM s1 WHERE speed >= 0 AND speed <= 200",
    s3="SELECT * FROM s2 WHERE traffic_density >= 0",
    lost="""SELECT 1 AS step, 'null_critical_cols' AS reason,
        (SELECT count(*) FROM obs) - (SELECT count(*) FROM complete) AS n
      UNION ALL SELECT 2, 'duplicates',
        (SELECT count(*) FROM complete) - (SELECT count(*) FROM deduped)
      UNION ALL SELECT 3, 'bad_acceleration',
        (SELECT count(*) FROM deduped) - (SELECT count(*) FROM s1)
      UNION ALL SELECT 4, 'bad_speed', (SELECT count(*) FROM s1) - (SELECT count(*) FROM s2)
      UNION ALL SELECT 5, 'bad_density', (SELECT count(*) FROM s2) - (SELECT count(*) FROM s3)
      UNION ALL SELECT 6, 'bad_label', (SELECT count(*) FROM s3) - (SELECT count(*) FROM clean)
      UNION ALL SELECT 7, 'total_dropped',
        (SELECT count(*) FROM obs) - (SELECT count(*) FROM clean)
      UNION ALL SELECT 8, 'remaining', (SELECT count(*) FROM clean)"""))
def clean_report(spark, sf_dir):
    return observations(spark, sf_dir).transform(cleaning.drop_report, ORDER)


@query("coerce_numeric", sql("obs", f"""SELECT {KEYS},
    TRY_CAST(raw_speed AS DOUBLE) AS raw_speed, TRY_CAST(raw_yaw AS DOUBLE) AS raw_yaw
    FROM texts""", texts=f"""SELECT {KEYS},
      CASE WHEN row_a % 5 = 0 THEN 'n/a' ELSE CAST(vehicle_id AS STRING) END AS raw_speed,
      CASE WHEN row_a % 7 = 0 THEN '' ELSE CAST(tick AS STRING) END AS raw_yaw FROM obs"""))
def coerce_numeric(spark, sf_dir):
    texts = observations(spark, sf_dir).select(
        "session_id", "tick", "vehicle_id",
        F.when(F.col("row_a") % 5 == 0, "n/a").otherwise(F.col("vehicle_id").cast("string"))
        .alias("raw_speed"),
        F.when(F.col("row_a") % 7 == 0, "").otherwise(F.col("tick").cast("string"))
        .alias("raw_yaw"))
    return texts.transform(features.coerce_numeric, ["raw_speed", "raw_yaw"])


@query("feature_bins", sql("feat", f"SELECT {KEYS}, speed_bin, density_bin FROM feat"))
def feature_bins(spark, sf_dir):
    return cleaned(spark, sf_dir).select("session_id", "tick", "vehicle_id",
                                         C.speed_bin().alias("speed_bin"),
                                         C.density_bin().alias("density_bin"))


@query("feature_flags", sql("feat", f"""SELECT {KEYS}, is_stationary, is_high_density,
    is_rush_hour, is_rainy, is_braking FROM feat"""))
def feature_flags(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "session_id", "tick", "vehicle_id", C.is_stationary().alias("is_stationary"),
        C.is_high_density().alias("is_high_density"), C.is_rush_hour().alias("is_rush_hour"),
        C.is_rainy().alias("is_rainy"), C.is_braking().alias("is_braking"))


@query("feature_interaction", sql("feat", f"""SELECT {KEYS},
    round(round(speed_x_density, 9), 6) AS speed_x_density FROM feat"""))
def feature_interaction(spark, sf_dir):
    return cleaned(spark, sf_dir).select(
        "session_id", "tick", "vehicle_id",
        C.steady(C.speed_x_density(), 6).alias("speed_x_density"))


@query("feature_town_code", sql("feat", """SELECT town, town_code, count(*) AS n_rows
    FROM feat GROUP BY town, town_code"""))
def feature_town_code(spark, sf_dir):
    return (cleaned(spark, sf_dir).withColumn("town_code", C.town_code())
            .groupBy("town", "town_code").agg(F.count(F.lit(1)).alias("n_rows")))


@query("label_rule", sql("obs", f"""SELECT {KEYS}, row_a, row_b,
    CASE WHEN traffic_density >= 10 AND speed < 20 THEN 'High'
      WHEN traffic_density < 4 OR speed >= 50 THEN 'Low' ELSE 'Medium' END AS derived_label
    FROM obs"""))
def label_rule(spark, sf_dir):
    return observations(spark, sf_dir).select(
        "session_id", "tick", "vehicle_id", *ORDER, C.congestion_label().alias("derived_label"))


@query("label_encode", sql("obs", f"""SELECT * FROM (SELECT {KEYS}, row_a, row_b,
      congestion_label, CAST(CASE congestion_label WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1
        WHEN 'High' THEN 2 ELSE -1 END AS INT) AS label FROM obs) WHERE label <> -1"""))
def label_encode(spark, sf_dir):
    return (observations(spark, sf_dir)
            .select("session_id", "tick", "vehicle_id", *ORDER, "congestion_label")
            .transform(features.encode_labels))


@query("label_encode_counts", sql("feat", """SELECT congestion_label, label, count(*) AS n
    FROM feat GROUP BY congestion_label, label"""))
def label_encode_counts(spark, sf_dir):
    return (cleaned(spark, sf_dir).transform(features.encode_labels)
            .transform(features.label_counts))


def _feature_list(names: list[str]) -> str:
    return ", ".join("round(round(speed_x_density, 9), 6) AS speed_x_density" if n == "speed_x_density"
                     else n for n in names)


def _rounded(df):
    if "speed_x_density" not in df.columns:
        return df
    return df.withColumn("speed_x_density", C.steady("speed_x_density", 6))


@query("feature_table", sql("feat", f"SELECT {_feature_list(SPLIT_COLUMNS)} FROM feat"))
def feature_table(spark, sf_dir):
    return _rounded(cleaned(spark, sf_dir).transform(features.feature_table))


@query("leakage_free_features", sql("feat", "SELECT label, " + ", ".join(
    f"CAST({f} AS DOUBLE) AS {f}" for f in MODEL_FEATURES) + " FROM feat"))
def leakage_free_features(spark, sf_dir):
    table = cleaned(spark, sf_dir).transform(features.feature_table)
    return table.transform(features.drop_leakage).transform(features.project_features,
                                                            MODEL_FEATURES)


@query("severity_from_label", sql("obs", """SELECT congestion_label,
    CAST(CASE congestion_label WHEN 'Low' THEN 10 WHEN 'Medium' THEN 50 WHEN 'High' THEN 90
      ELSE 50 END AS INT) AS severity, count(*) AS n_rows FROM obs GROUP BY ALL"""))
def severity_from_label(spark, sf_dir):
    return (observations(spark, sf_dir)
            .withColumn("severity", C.label_severity(missing=50))
            .groupBy("congestion_label", "severity").agg(F.count(F.lit(1)).alias("n_rows")))
