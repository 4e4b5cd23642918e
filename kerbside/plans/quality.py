"""Queries: data-quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.functions import columns as C
from kerbside.operators import quality
from kerbside.plans.registry import query
from kerbside.plans.tables import observations, plain, sql
from kerbside.schema import OBS_COLUMNS


def _raw(spark, sf_dir):
    return plain(observations(spark, sf_dir))


_STATUS = " UNION ALL ".join(
    [f"SELECT '{c}' AS column_name, 'present' AS status" for c in OBS_COLUMNS]
    + [f"SELECT '{c}', 'extra'" for c in ("row_a", "row_b")])


@query("dq_schema", sql("obs", """SELECT column_name, status,
    (SELECT count(*) FROM obs) AS n_rows, CAST(17 AS INT) AS n_columns FROM expected""",
                        expected=_STATUS))
def dq_schema(spark, sf_dir):
    return observations(spark, sf_dir).transform(quality.check_schema)


@query("dq_volume", sql("obs", """SELECT CAST(sum(n) AS BIGINT) AS n_rows,
    count(*) AS n_sessions, count(*) FILTER (WHERE n < 500) AS n_short_sessions
    FROM (SELECT session_id, count(*) AS n FROM obs GROUP BY session_id)"""))
def dq_volume(spark, sf_dir):
    return _raw(spark, sf_dir).transform(quality.volume)


@query("rows_per_session", sql("obs", """SELECT session_id, count(*) AS n_rows,
    right(session_id, 22) AS session_tail, split_part(session_id, '_', 3) AS town_token,
    CAST(count(*) < 500 AS INT) AS too_few FROM obs GROUP BY session_id"""))
def rows_per_session(spark, sf_dir):
    return _raw(spark, sf_dir).transform(quality.rows_per_session)


@query("rows_by_town_weather", sql("obs", """SELECT 'town' AS dimension, town AS name,
    count(*) AS n_rows, round(round(100e0 * count(*) / sum(count(*)) OVER (), 9), 6) AS pct
    FROM obs GROUP BY town
    UNION ALL SELECT 'weather', weather_name, count(*),
      round(round(100e0 * count(*) / sum(count(*)) OVER (), 9), 6) FROM obs GROUP BY weather_name"""))
def rows_by_town_weather(spark, sf_dir):
    return _raw(spark, sf_dir).transform(quality.rows_by_town_and_weather)


@query("dq_missing", sql("obs", """SELECT column_name, n_missing,
    round(round(100e0 * n_missing / (SELECT count(*) FROM obs), 9), 6) AS pct FROM m WHERE n_missing > 0""",
    m=" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing FROM obs"
                         for c in OBS_COLUMNS)))
def dq_missing(spark, sf_dir):
    return _raw(spark, sf_dir).transform(quality.missing_values)


@query("dq_duplicates", sql("obs", """SELECT CAST(sum(n - 1) AS BIGINT) AS n_duplicates,
    CASE WHEN sum(n - 1) = 0 THEN 'OK' ELSE 'WARN' END AS status
    FROM (SELECT count(*) AS n FROM obs GROUP BY session_id, tick, vehicle_id)"""))
def dq_duplicates(spark, sf_dir):
    return _raw(spark, sf_dir).transform(quality.duplicate_keys)


@query("dq_ranges", sql("obs", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round(round(CAST(min({c}) AS DOUBLE), 9), 6) AS min_value,
      round(round(CAST(max({c}) AS DOUBLE), 9), 6) AS max_value, round(round(avg({c}), 9), 6) AS mean_value,
      count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) AS n_out_of_range,
      CASE WHEN count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi}) = 0 THEN 'OK' ELSE 'WARN' END
        AS status FROM obs"""
    for c, lo, hi in [("speed", 0, 200), ("acceleration", 0, 50), ("traffic_density", 0, 199),
                      ("hour", 0, 23)])))
def dq_ranges(spark, sf_dir):
    return _raw(spark, sf_dir).transform(quality.value_ranges)


@query("dq_infinite", sql("obs", "SELECT CAST(" + " + ".join(
    f"count(*) FILTER (WHERE abs({c}) = 'inf'::DOUBLE)"
    for c in ["speed", "acceleration", "x", "y", "z", "yaw"])
    + " AS BIGINT) AS n_infinite, 'OK' AS status FROM obs"))
def dq_infinite(spark, sf_dir):
    return _raw(spark, sf_dir).transform(quality.infinite_values)


@query("session_parse", sql("obs", """SELECT session_id,
    split_part(session_id, '_', 3) AS town_token,
    nullif(regexp_extract(session_id, '_(Town[0-9]+)_', 1), '') AS town_number,
    count(*) AS n_rows FROM obs GROUP BY session_id"""))
def session_parse(spark, sf_dir):
    return (observations(spark, sf_dir).groupBy("session_id")
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumns({"town_token": C.session_town_token(), "town_number": C.session_town()}))


@query("label_distribution", sql("obs", """SELECT CAST(i AS INT) AS label, name AS label_name,
    coalesce(n, 0) AS n_rows,
    round(round(100e0 * coalesce(n, 0) / (SELECT sum(n) FROM c), 9), 6) AS pct,
    round(round((SELECT 100e0 * min(n) FILTER (WHERE congestion_label IS NOT NULL) / sum(n) FROM c), 9), 6)
      AS min_share_pct,
    CASE WHEN (SELECT 100e0 * min(n) FILTER (WHERE congestion_label IS NOT NULL) / sum(n) FROM c)
      >= 5 THEN 'OK' ELSE 'WARN' END AS balance
    FROM (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High')) AS d(i, name)
    LEFT JOIN c ON c.congestion_label = name""",
    c="SELECT congestion_label, count(*) AS n FROM obs GROUP BY congestion_label"))
def label_distribution(spark, sf_dir):
    return _raw(spark, sf_dir).transform(quality.label_distribution)


@query("dq_spatial", sql("obs", """SELECT town, round(round(max(x) - min(x), 9), 6) AS x_range,
    round(round(max(y) - min(y), 9), 6) AS y_range,
    CASE WHEN max(x) - min(x) < 100 OR max(y) - min(y) < 100 THEN 'WARN' ELSE 'OK' END AS status
    FROM obs GROUP BY town"""))
def dq_spatial(spark, sf_dir):
    return _raw(spark, sf_dir).transform(quality.spatial_coverage)


@query("dq_corr", sql("obs", """SELECT round(round(r, 9), 6) AS pearson_r, CASE WHEN r < -0.05 THEN 'OK'
    WHEN r > 0.1 THEN 'WARN' ELSE 'INFO' END AS status
    FROM (SELECT corr(speed, traffic_density) AS r FROM obs)"""))
def dq_corr(spark, sf_dir):
    return _raw(spark, sf_dir).transform(quality.speed_density_correlation)


@query("dq_verdict", sql(
    "obs",
    """SELECT CAST(rule_no AS INT) AS rule_no, rule, round(round(metric, 9), 6) AS metric,
         'ACTION NEEDED' AS verdict FROM failed
       UNION ALL SELECT 0, 'all', NULL, 'PASS' WHERE NOT EXISTS (SELECT 1 FROM failed)""",
    f="""SELECT count(*) AS n, """ + " + ".join(f"count(*) - count({c})" for c in OBS_COLUMNS)
      + """ AS n_null, count(*) FILTER (WHERE speed > 200) AS n_fast,
      corr(speed, traffic_density) AS r FROM obs""",
    lab="""SELECT 100e0 * min(n) / sum(n) AS share FROM (SELECT count(*) AS n FROM obs
      WHERE congestion_label IS NOT NULL GROUP BY congestion_label)""",
    short="""SELECT count(*) FILTER (WHERE n < 500) AS n FROM (SELECT count(*) AS n FROM obs
      GROUP BY session_id)""",
    failed="""SELECT 1 AS rule_no, 'too_few_rows' AS rule, CAST(n AS DOUBLE) AS metric FROM f
        WHERE n < 10000
      UNION ALL SELECT 2, 'null_values', 100e0 * n_null / (n * 15) FROM f WHERE n_null > 0
      UNION ALL SELECT 3, 'speed_above_limit', n_fast FROM f WHERE n_fast > 0
      UNION ALL SELECT 4, 'label_imbalance', share FROM lab WHERE share < 5
      UNION ALL SELECT 5, 'positive_speed_density_correlation', r FROM f WHERE r > 0.1
      UNION ALL SELECT 6, 'short_sessions', n FROM short WHERE n > 0"""))
def dq_verdict(spark, sf_dir):
    return _raw(spark, sf_dir).transform(quality.verdict)
