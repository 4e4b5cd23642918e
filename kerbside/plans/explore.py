"""Queries: the tables behind the exploratory charts and the dashboard."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.functions import columns as C
from kerbside.operators import distributions as D, quality, series, spatial
from kerbside.plans import checks
from kerbside.plans.registry import query
from kerbside.plans.tables import ORDER, observations, plain, sql
from kerbside.schema import KEY, LABELS, OBS_COLUMNS, RAINY_CODES

LABEL_IN = "congestion_label IN ('Low', 'Medium', 'High')"
RAINY = f"weather IN ({', '.join(map(str, sorted(RAINY_CODES)))})"
LABEL_CODE = ("CASE congestion_label WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2 "
              "ELSE -1 END")


def raw(spark, sf_dir):
    return plain(observations(spark, sf_dir))


def labelled(spark, sf_dir):
    return D.only_groups(raw(spark, sf_dir), "congestion_label", LABELS)


# --- overview --------------------------------------------------------------------------

@query("dq_report_hist", sql(
    "obs",
    """SELECT r.panel, CAST(t.bin AS INT) AS bin, round(round(lo + t.bin * w, 9), 6) AS bin_lo,
         round(round(lo + (t.bin + 1) * w, 9), 6) AS bin_hi, coalesce(n, 0) AS n_rows,
         round(round(coalesce(n, 0) / (total * w), 9), 6) AS density
       FROM r CROSS JOIN (SELECT unnest(range(60)) AS bin) AS t
       LEFT JOIN b ON b.panel = r.panel AND b.bin = t.bin WHERE t.bin < bins""",
    v=f"""SELECT 'speed' AS panel, 60 AS bins, {checks.clip('speed', 0, 130)} AS value FROM obs
        WHERE speed IS NOT NULL
      UNION ALL SELECT 'acceleration', 60, {checks.clip('acceleration', 0, 15)} FROM obs
      UNION ALL SELECT 'traffic_density', 40, traffic_density FROM obs""",
    r="""SELECT panel, bins, count(*) AS total, min(value) AS lo, max(value) AS hi,
        (hi - lo) / bins AS w FROM v GROUP BY panel, bins""",
    b="""SELECT v.panel, least(floor((value - lo) / w), v.bins - 1) AS bin, count(*) AS n
        FROM v JOIN r USING (panel) GROUP BY ALL"""))
def dq_report_hist(spark, sf_dir):
    panels = F.array(*[
        F.struct(F.lit(name).alias("panel"), value.cast("double").alias("value"))
        for name, value in [("speed", C.clip("speed", 0.0, 130.0)),
                            ("acceleration", C.clip("acceleration", 0.0, 15.0)),
                            ("traffic_density", F.col("traffic_density"))]])
    long = raw(spark, sf_dir).select(F.explode(panels).alias("p")).select("p.*")
    bins = F.when(F.col("panel") == "traffic_density", 40).otherwise(60)
    return long.transform(D.histogram, "value", bins, ["panel"], bounded=True)  # three panels


@query("town_weather_pivot", sql(
    "obs",
    """SELECT t.town, w.weather_name, coalesce(n, 0) AS n_rows,
         CAST(coalesce(sum(coalesce(n, 0)) OVER (PARTITION BY t.town ORDER BY w.weather_name
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS stack_start
       FROM (SELECT DISTINCT town FROM obs) AS t
       CROSS JOIN (SELECT DISTINCT weather_name FROM obs) AS w
       LEFT JOIN c ON c.town = t.town AND c.weather_name = w.weather_name""",
    c="SELECT town, weather_name, count(*) AS n FROM obs GROUP BY ALL"))
def town_weather_pivot(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.pivot_counts, "town", "weather_name")


_VPT = """SELECT regexp_extract(session_id, '_(Town[0-9]+)_', 1) AS town_number,
    count(DISTINCT vehicle_id) AS vehicles FROM obs GROUP BY session_id, tick"""


@query("vehicles_per_tick", checks.box("obs", "town_number", "vehicles", per=_VPT).replace(
    "CAST(vehicles AS DOUBLE) AS value FROM obs", "CAST(vehicles AS DOUBLE) AS value FROM per"))
def vehicles_per_tick(spark, sf_dir):
    per = series.per_tick(raw(spark, sf_dir), vehicles=F.count_distinct("vehicle_id"))
    return (per.withColumn("town_number", C.session_town())
            .transform(D.box_stats, ["town_number"], "vehicles"))


@query("cumulative_rows", sql("obs", """SELECT session_id, n AS n_rows,
    CAST(sum(n) OVER (ORDER BY session_id) AS BIGINT) AS cumulative_rows,
    round(round(sum(n) OVER (ORDER BY session_id) / 1e6, 9), 6) AS cumulative_millions
    FROM (SELECT session_id, count(*) AS n FROM obs GROUP BY session_id)"""))
def cumulative_rows(spark, sf_dir):
    return raw(spark, sf_dir).transform(series.cumulative_rows)


@query("top_sessions", sql("obs", """SELECT session_id, count(*) AS n_rows FROM obs
    GROUP BY session_id ORDER BY n_rows DESC, session_id LIMIT 15"""))
def top_sessions(spark, sf_dir):
    return raw(spark, sf_dir).transform(series.top_by_rows, "session_id", 15)


# --- samples ---------------------------------------------------------------------------

@query("sample_bounded", sql("obs", f"""SELECT {', '.join(OBS_COLUMNS)}, row_a, row_b FROM obs
    ORDER BY md5(concat_ws('|', '42', session_id, CAST(tick AS STRING),
      CAST(vehicle_id AS STRING))), session_id, tick, vehicle_id, row_a, row_b LIMIT 8000"""))
def sample_bounded(spark, sf_dir):
    ordered = observations(spark, sf_dir).select(
        *KEY, *ORDER, *[c for c in OBS_COLUMNS if c not in KEY])
    return ordered.transform(D.sample_bounded, 8000, 42)


_MATRIX = ["speed", "traffic_density", "acceleration"]
_SAMPLED = """SELECT congestion_label, speed, traffic_density, acceleration FROM obs
    ORDER BY md5(concat_ws('|', '5', session_id, CAST(tick AS STRING), CAST(vehicle_id AS STRING))),
      session_id, tick, vehicle_id, row_a, row_b LIMIT 3000"""


@query("scatter_matrix_hist", checks.histogram(
    "obs", "panel", "value", 20, "TRUE", m=_SAMPLED, q=" UNION ALL ".join(
        f"""SELECT '{c} ' || congestion_label AS panel, greatest(CAST({c} AS DOUBLE), 0e0) AS value
        FROM m WHERE {LABEL_IN} AND {c} IS NOT NULL""" for c in _MATRIX)).replace(
            "AS value FROM obs", "AS value FROM q"))
def scatter_matrix_hist(spark, sf_dir):
    """Histograms on the diagonal of the scatter matrix: three values of 3,000 sampled rows by
    label, nothing below zero."""
    ordered = observations(spark, sf_dir).select(
        *KEY, *ORDER, *[c for c in OBS_COLUMNS if c not in KEY])
    sample = D.only_groups(ordered.transform(D.sample_bounded, 3000, 5), "congestion_label", LABELS)
    panels = F.array(*[F.struct(
        F.concat_ws(" ", F.lit(c), "congestion_label").alias("panel"),
        F.when(F.col(c).isNotNull(), F.greatest(F.col(c).cast("double"), F.lit(0.0))).alias("value"))
        for c in _MATRIX])
    long = sample.select(F.explode(panels).alias("p")).select("p.*")
    return long.transform(D.histogram, "value", 20, ["panel"], bounded=True)  # nine panels


# --- histograms and densities ----------------------------------------------------------

@query("hist_1d", checks.histogram("obs", None, checks.clip("speed", 0, 100), 100,
                                   "speed IS NOT NULL"))
def hist_1d(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.histogram, C.clip("speed", 0.0, 100.0), 100)


@query("hist_density", checks.histogram("obs", None, "traffic_density", 40))
def hist_density(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.histogram, "traffic_density", 40)


@query("hist_acceleration", checks.histogram("obs", None, checks.clip("acceleration", -10, 10), 60))
def hist_acceleration(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.histogram, C.clip("acceleration", -10.0, 10.0), 60)


@query("yaw_rose", checks.histogram("obs", None, "radians(yaw)", 36,
                                    value_range=("-pi()", "pi()")))
def yaw_rose(spark, sf_dir):
    import math
    return raw(spark, sf_dir).transform(D.histogram, F.radians("yaw"), 36,
                                        value_range=(-math.pi, math.pi))


@query("yaw_histogram_360", checks.histogram("obs", None, "((yaw % 360e0) + 360e0) % 360e0", 72))
def yaw_histogram_360(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.histogram, C.degrees_0_360(), 72)


def _by_label(value, bins):
    return lambda spark, sf_dir: labelled(spark, sf_dir).transform(
        D.histogram, value, bins, ["congestion_label"], bounded=True)


query("hist_by_group", checks.histogram("obs", "congestion_label", "speed", 80, LABEL_IN))(
    _by_label("speed", 80))
query("hist_speed_label_50", checks.histogram("obs", "congestion_label", "speed", 50, LABEL_IN))(
    _by_label("speed", 50))
query("hist_density_label", checks.histogram("obs", "congestion_label", "traffic_density", 30,
                                             LABEL_IN))(_by_label("traffic_density", 30))


@query("hist_speed_weather", checks.histogram("obs", "weather_name", checks.clip("speed", 0, 100),
                                              60, "speed IS NOT NULL AND weather_name IS NOT NULL"))
def hist_speed_weather(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.histogram, C.clip("speed", 0.0, 100.0), 60,
                                        ["weather_name"])


@query("hist_speed_rain", checks.histogram(
    "obs", "is_rainy", checks.clip("speed", 0, 100), 60, "speed IS NOT NULL").replace(
        "SELECT is_rainy,  1 AS one", f"SELECT CAST({RAINY} AS INT) AS is_rainy,  1 AS one"))
def hist_speed_rain(spark, sf_dir):
    return (raw(spark, sf_dir).withColumn("is_rainy", C.is_rainy())
            .transform(D.histogram, C.clip("speed", 0.0, 100.0), 60, ["is_rainy"], bounded=True))


@query("hist_elevation_town", checks.histogram("obs", "town", "z", 40, "town IS NOT NULL"))
def hist_elevation_town(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.histogram, "z", 40, ["town"])


@query("severity_hist", sql("obs", """SELECT CAST(i AS INT) AS bin, lo AS bin_lo, hi AS bin_hi,
    (SELECT count(*) FROM s WHERE v >= lo AND (v < hi OR (i = 4 AND v <= hi))) AS n_rows
    FROM (VALUES (0, 0e0, 25e0), (1, 25e0, 40e0), (2, 40e0, 60e0), (3, 60e0, 75e0),
      (4, 75e0, 100e0)) AS e(i, lo, hi)""",
    s="""SELECT CASE congestion_label WHEN 'Low' THEN 10 WHEN 'Medium' THEN 50 WHEN 'High' THEN 90
      END AS v FROM obs"""))
def severity_hist(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.edge_histogram, C.label_severity(),
                                        [0, 25, 40, 60, 75, 100])


@query("kde_by_group", checks.density("obs", "congestion_label", "speed", 0, 100, 300, 0.15, LABELS))
def kde_by_group(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.kernel_density, "congestion_label", "speed", 0, 100, 300,
                                        0.15, LABELS)


@query("kde_acceleration_label", checks.density("obs", "congestion_label", "acceleration", 0, 12,
                                                200, 0.2, LABELS, 11))
def kde_acceleration_label(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.kernel_density, "congestion_label", "acceleration", 0, 12,
                                        200, 0.2, LABELS, 11)


@query("kde_acceleration_weather", checks.density("obs", "weather_name", "acceleration", 0, 8, 200,
                                                  0.25, None, 101))
def kde_acceleration_weather(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.kernel_density, "weather_name", "acceleration", 0, 8, 200,
                                        0.25, None, 101)


# --- shares, centres, boxes ------------------------------------------------------------

query("share_by_group", checks.shares("obs", "weather_name"))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(D.label_shares, ["weather_name"]))
query("label_by_town", checks.shares("obs", "town"))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(D.label_shares, ["town"]))
query("share_rainy", checks.shares("obs", "is_rainy").replace(
    "FROM obs WHERE congestion_label",
    f"FROM (SELECT *, CAST({RAINY} AS INT) AS is_rainy FROM obs) WHERE congestion_label"))(
    lambda spark, sf_dir: raw(spark, sf_dir).withColumn("is_rainy", C.is_rainy())
    .transform(D.label_shares, ["is_rainy"]))


@query("high_share_town_weather", sql("obs", """SELECT t.town, w.weather_name,
      coalesce(n_rows, 0) AS n_rows, coalesce(pct_high, 0e0) AS pct_high
    FROM (SELECT DISTINCT town FROM obs) AS t CROSS JOIN (SELECT DISTINCT weather_name FROM obs) AS w
    LEFT JOIN c ON c.town = t.town AND c.weather_name = w.weather_name""",
    c="""SELECT town, weather_name, count(*) AS n_rows,
    round(round(100e0 * count(*) FILTER (WHERE congestion_label = 'High') / count(*), 9), 6) AS pct_high
    FROM obs GROUP BY town, weather_name"""))
def high_share_town_weather(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.high_shares, "town", "weather_name")


query("box_stats", checks.box("obs", "town", checks.clip("speed", 0, 100)).replace(
    "AND (CASE", "AND speed IS NOT NULL AND (CASE"))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(
        D.box_stats, ["town"], C.clip("speed", 0.0, 100.0)))
query("box_speed_weather", checks.box("obs", "weather_name", checks.clip("speed", 0, 100)).replace(
    "AND (CASE", "AND speed IS NOT NULL AND (CASE"))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(
        D.box_stats, ["weather_name"], C.clip("speed", 0.0, 100.0)))
query("box_speed_label", checks.box("obs", "congestion_label", "speed"))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(D.box_stats, ["congestion_label"], "speed"))
query("box_speed_town_full", checks.box("obs", "town", "speed"))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(D.box_stats, ["town"], "speed"))


@query("hour_bucket_speed", checks.box("obs", "hour_bucket", "speed", 2, h="""SELECT *,
    CASE WHEN hour BETWEEN 0 AND 6 THEN 'Night' WHEN hour <= 12 THEN 'Morning'
      WHEN hour <= 18 THEN 'Afternoon' WHEN hour <= 24 THEN 'Evening' END AS hour_bucket
    FROM obs""").replace("CAST(speed AS DOUBLE) AS value FROM obs",
                         "CAST(speed AS DOUBLE) AS value FROM h"))
def hour_bucket_speed(spark, sf_dir):
    return (raw(spark, sf_dir).withColumn("hour_bucket", C.hour_bucket())
            .transform(D.box_stats, ["hour_bucket"], "speed", 2))


@query("speed_center", sql("obs", """SELECT count(speed) AS n_rows, round(round(avg(speed), 9), 6) AS mean,
    round(round(quantile_cont(speed, 0.5), 9), 6) AS median FROM obs"""))
def speed_center(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.mean_and_median, "speed")


@query("median_town_label", sql("obs", """SELECT town, congestion_label, count(speed) AS n_rows,
    round(round(quantile_cont(speed, 0.5), 9), 6) AS median FROM obs
    WHERE congestion_label IN ('Low', 'Medium', 'High') GROUP BY ALL"""))
def median_town_label(spark, sf_dir):
    return labelled(spark, sf_dir).transform(D.medians, ["town", "congestion_label"], "speed")


def _mean_std_sql(by: str, value: str) -> str:
    return sql("obs", f"""SELECT {by}, count({value}) AS n_rows, round(round(avg({value}), 9), 6) AS mean,
        round(round(stddev_samp({value}), 9), 6) AS std FROM obs WHERE {by} IS NOT NULL GROUP BY {by}""")


query("speed_by_weather", _mean_std_sql("weather_name", "speed"))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(D.mean_and_std, ["weather_name"], "speed"))
query("density_by_label", _mean_std_sql("congestion_label", "traffic_density"))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(D.mean_and_std, ["congestion_label"],
                                                       "traffic_density"))
query("speed_by_hour", _mean_std_sql("hour", "speed"))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(D.mean_and_std, ["hour"], "speed"))

query("ecdf_speed", checks.ecdf("obs", "congestion_label", "speed", LABEL_IN))(
    lambda spark, sf_dir: labelled(spark, sf_dir).transform(D.ecdf, ["congestion_label"], "speed"))

query("corr_matrix", checks.correlations("obs", {
    c: c for c in ["speed", "acceleration", "traffic_density", "yaw", "z"]}))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(
        D.correlations, ["speed", "acceleration", "traffic_density", "yaw", "z"]))

_NINE = ["speed", "acceleration", "x", "y", "z", "yaw", "traffic_density", "hour", "label"]


@query("corr_matrix_label", checks.correlations("obs", {
    c: c if c != "label" else f"nullif({LABEL_CODE}, -1)" for c in _NINE}))
def corr_matrix_label(spark, sf_dir):
    coded = raw(spark, sf_dir).withColumn("label", F.nullif(C.label_code(), F.lit(-1)))
    return coded.transform(D.correlations, _NINE)


@query("weather_hour_label", sql("obs", f"""SELECT weather_name, hour, count(*) AS n_rows,
    round(round(avg({LABEL_CODE}), 9), 6) AS mean_label FROM obs WHERE {LABEL_IN} GROUP BY ALL"""))
def weather_hour_label(spark, sf_dir):
    return (labelled(spark, sf_dir).where("weather_name IS NOT NULL AND hour IS NOT NULL")
            .groupBy("weather_name", "hour")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 C.steady(F.avg(C.label_code()), 6).alias("mean_label")))


@query("bin_crosstab", sql(
    "obs",
    """SELECT d.name AS density_bin, s.name AS speed_bin, (SELECT count(*) FROM obs
         WHERE speed > s.lo AND speed <= s.hi AND traffic_density > d.lo
           AND traffic_density <= d.hi) AS n_rows
       FROM (VALUES ('<5', 0, 5), ('5-20', 5, 20), ('20-50', 20, 50), ('50+', 50, 200))
         AS s(name, lo, hi)
       CROSS JOIN (VALUES ('<3', 0, 3), ('3-8', 3, 8), ('8-15', 8, 15), ('15+', 15, 200))
         AS d(name, lo, hi)"""))
def bin_crosstab(spark, sf_dir):
    return raw(spark, sf_dir).transform(D.bin_crosstab)


@query("top_vehicles", sql("obs", """SELECT vehicle_id, count(speed) AS n_rows,
    round(round(avg(speed), 9), 6) AS mean, round(round(stddev_samp(speed), 9), 6) AS std FROM obs
    WHERE vehicle_id IN (SELECT vehicle_id FROM obs GROUP BY vehicle_id
      ORDER BY count(*) DESC, vehicle_id LIMIT 8) GROUP BY vehicle_id"""))
def top_vehicles(spark, sf_dir):
    df = raw(spark, sf_dir)
    chosen = series.restrict(df, series.top_by_rows(df, "vehicle_id", 8), "vehicle_id")
    return chosen.transform(D.mean_and_std, ["vehicle_id"], "speed")


@query("top_vehicle_share", checks.shares("obs", "vehicle_id").replace(
    " GROUP BY vehicle_id", """ AND vehicle_id IN (SELECT vehicle_id FROM obs GROUP BY 1
      ORDER BY count(*) DESC, vehicle_id LIMIT 8) GROUP BY vehicle_id"""))
def top_vehicle_share(spark, sf_dir):
    df = raw(spark, sf_dir)
    chosen = series.restrict(df, series.top_by_rows(df, "vehicle_id", 8), "vehicle_id")
    return chosen.transform(D.label_shares, ["vehicle_id"])


# --- time series -----------------------------------------------------------------------

@query("speed_per_tick", sql("obs", """SELECT session_id, tick, round(round(avg(speed), 9), 6) AS avg_speed
    FROM obs GROUP BY session_id, tick"""))
def speed_per_tick(spark, sf_dir):
    return series.per_tick(raw(spark, sf_dir), avg_speed=C.steady(F.avg("speed"), 6))


@query("top_session_series", sql("obs", """SELECT session_id, tick,
    round(round(avg(speed), 9), 6) AS avg_speed,
    round(round(avg(acceleration), 9), 6)
      AS avg_acceleration FROM obs
    WHERE session_id IN (SELECT session_id FROM obs GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5)
    GROUP BY session_id, tick"""))
def top_session_series(spark, sf_dir):
    df = raw(spark, sf_dir)
    chosen = series.restrict(df, series.top_by_rows(df, "session_id", 5), "session_id")
    return series.per_tick(chosen, avg_speed=C.steady(F.avg("speed"), 6),
                           avg_acceleration=C.steady(F.avg("acceleration"), 6))


_ROLL = "OVER (PARTITION BY session_id ORDER BY tick ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)"


def _rolling(value: str) -> str:
    return f"CASE WHEN count({value}) {_ROLL} = 5 THEN avg({value}) {_ROLL} END"


@query("label_share_rolling", sql(
    "obs", "SELECT session_id, tick, " + ", ".join(
        f"round(round(100e0 * {_rolling(l)}, 9), 6) AS pct_{l}" for l in ("low", "medium", "high"))
    + " FROM t",
    t="SELECT session_id, tick, " + ", ".join(
        f"avg(CAST(congestion_label = '{l}' AS DOUBLE)) AS {l.lower()}" for l in LABELS)
    + " FROM obs GROUP BY session_id, tick"))
def label_share_rolling(spark, sf_dir):
    return raw(spark, sf_dir).transform(series.label_shares_per_tick)


@query("stationary_rolling", sql(
    "obs", f"""SELECT session_id, tick, round(round(p, 9), 6) AS pct_stationary,
      round(round({_rolling('p')}, 9), 6) AS pct_rolling FROM t""",
    t="""SELECT session_id, tick, avg(CAST(coalesce(speed < 1, FALSE) AS DOUBLE)) * 100e0 AS p
      FROM obs GROUP BY session_id, tick"""))
def stationary_rolling(spark, sf_dir):
    return raw(spark, sf_dir).transform(series.stationary_share)


@query("speed_volatility", sql(
    "obs", f"""SELECT session_id, tick, round(round(s, 9), 6) AS speed_std,
      round(round({_rolling('s')}, 9), 6) AS speed_std_rolling FROM t""",
    t="SELECT session_id, tick, stddev_samp(speed) AS s FROM obs GROUP BY session_id, tick"))
def speed_volatility(spark, sf_dir):
    return raw(spark, sf_dir).transform(series.speed_volatility)


@query("tick_profile", sql(
    "obs", """SELECT session_id, tick, round(round(avg(speed), 9), 6) AS avg_speed,
      round(round(avg(traffic_density), 9), 6) AS avg_density, any_value(mode_label) AS mode_label
      FROM obs JOIN m USING (session_id, tick) GROUP BY session_id, tick""",
    m=f"""SELECT session_id, tick, congestion_label AS mode_label FROM (SELECT *,
      row_number() OVER (PARTITION BY session_id, tick ORDER BY n DESC,
        CASE WHEN {LABEL_CODE} < 0 THEN 99 ELSE {LABEL_CODE} END) AS rn
      FROM (SELECT session_id, tick, congestion_label, count(*) AS n FROM obs GROUP BY ALL))
      WHERE rn = 1"""))
def tick_profile(spark, sf_dir):
    return raw(spark, sf_dir).transform(series.tick_profile)


@query("label_transitions", sql(
    "obs",
    """SELECT a.l AS from_label, b.l AS to_label, coalesce(n, 0) AS n_pairs,
         round(round(coalesce(100e0 * n / (SELECT sum(n) FROM p AS q WHERE q.cur = a.i), 0e0), 9), 6) AS pct
       FROM (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High')) AS a(i, l)
       CROSS JOIN (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High')) AS b(i, l)
       LEFT JOIN p ON p.cur = a.i AND p.nxt = b.i""",
    seq=f"""SELECT {LABEL_CODE} AS cur, lead({LABEL_CODE}) OVER (
        PARTITION BY session_id, vehicle_id ORDER BY tick, {LABEL_CODE}, congestion_label) AS nxt
      FROM obs""",
    p="SELECT cur, nxt, count(*) AS n FROM seq WHERE cur >= 0 AND nxt >= 0 GROUP BY cur, nxt"))
def label_transitions(spark, sf_dir):
    return raw(spark, sf_dir).transform(series.label_transitions)


# --- space -----------------------------------------------------------------------------

@query("hist_2d", checks.grid("obs", None, None))
def hist_2d(spark, sf_dir):
    return raw(spark, sf_dir).transform(spatial.grid)


@query("spatial_speed_grid", checks.grid("obs", None, "speed"))
def spatial_speed_grid(spark, sf_dir):
    return raw(spark, sf_dir).transform(spatial.grid, 60, None, "speed")


_VIEWS = {"speed": "speed", "density": "traffic_density",
          "severity": "CASE congestion_label WHEN 'Low' THEN 10 WHEN 'Medium' THEN 50 "
                      "WHEN 'High' THEN 90 ELSE 50 END"}


@query("spatial_value_grid", checks.grid("obs", None, None).replace(
    "count(*) AS n_rows FROM cells", "count(*) AS n_rows, " + ", ".join(
        f"round(round(avg({v}), 9), 6) AS mean_{n}" for n, v in _VIEWS.items()) + " FROM cells"))
def spatial_value_grid(spark, sf_dir):
    df = raw(spark, sf_dir)
    views = {"speed": "speed", "density": "traffic_density",
             "severity": C.label_severity(missing=50)}
    return spatial.grid_means(df, views)


def _town_grid(spark, sf_dir):
    return raw(spark, sf_dir).transform(spatial.grid, 60, ["town"])


query("spatial_grid_town", checks.grid("obs", "town", None))(_town_grid)

_KERNEL = ", ".join(f"({k - 6}, {w!r})" for k, w in enumerate(spatial.smoothing_weights(1.5)))


@query("spatial_smooth", sql(
    "obs",
    "SELECT town, ix, iy, round(round(v, 9), 6) AS smoothed FROM s2",
    pts="SELECT * FROM obs",
    ext="""SELECT town, min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh FROM pts
      GROUP BY town""",
    c="""SELECT town, CAST(least(floor((x - xl) / ((xh - xl) / 60)), 59) AS INT) AS ix,
        CAST(least(floor((y - yl) / ((yh - yl) / 60)), 59) AS INT) AS iy,
        CAST(count(*) AS DOUBLE) AS v FROM pts JOIN ext USING (town) GROUP BY 1, 2, 3""",
    k=f"SELECT * FROM (VALUES {_KERNEL}) AS k(d, w)",
    tgt="""SELECT CAST(t AS INT) AS t, w, CASE WHEN t + d < 0 THEN -(t + d) - 1
        WHEN t + d > 59 THEN 119 - (t + d) ELSE t + d END AS s
      FROM (SELECT unnest(range(60)) AS t) CROSS JOIN k""",
    s1="SELECT town, t AS ix, iy, sum(v * w) AS v FROM c JOIN tgt ON ix = s GROUP BY 1, 2, 3",
    s2="SELECT town, ix, t AS iy, sum(v * w) AS v FROM s1 JOIN tgt ON iy = s GROUP BY 1, 2, 3"))
def spatial_smooth(spark, sf_dir):
    return _town_grid(spark, sf_dir).transform(spatial.smooth_grid, ["town"], 60)


query("hexbin_count", checks.hexbin("obs", "x", "y", 60))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(spatial.hexbin, "x", "y", 60))
query("hexbin_speed", checks.hexbin("obs", "x", "y", 60, "speed"))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(spatial.hexbin, "x", "y", 60, "speed"))


def _known(column, lo, hi):
    return F.when(F.col(column).isNotNull(), C.clip(column, lo, hi))


query("hexbin_density_speed", checks.hexbin(
    "obs", checks.clip("traffic_density", 0, 30), checks.clip("speed", 0, 100), 40))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(
        spatial.hexbin, _known("traffic_density", 0.0, 30.0), _known("speed", 0.0, 100.0), 40))
query("hexbin_speed_acceleration", checks.hexbin(
    "obs", checks.clip("speed", 0, 100), checks.clip("acceleration", 0, 10), 40))(
    lambda spark, sf_dir: raw(spark, sf_dir).transform(
        spatial.hexbin, _known("speed", 0.0, 100.0), _known("acceleration", 0.0, 10.0), 40))


# --- dashboard -------------------------------------------------------------------------

@query("hotspots", sql("clean", """SELECT CAST(floor(x / 20) * 20 AS INT) AS x_bin,
    CAST(floor(y / 20) * 20 AS INT) AS y_bin, count(speed) AS records,
    round(round(avg(speed), 9), 1) AS avg_speed, round(round(avg(traffic_density), 9), 1) AS avg_density,
    round(round(avg(CAST(congestion_label = 'High' AS DOUBLE)) * 100e0, 9), 1) AS pct_high
    FROM clean GROUP BY 1, 2
    ORDER BY avg(CAST(congestion_label = 'High' AS DOUBLE)) DESC, records DESC, x_bin, y_bin
    LIMIT 10"""))
def hotspots(spark, sf_dir):
    from kerbside.plans.cleaning import cleaned
    return cleaned(spark, sf_dir).transform(spatial.hotspots)


@query("session_summary", sql("obs", """SELECT session_id, count(speed) AS n_rows,
    round(round(avg(speed), 9), 2) AS avg_speed, round(round(avg(traffic_density), 9), 2) AS avg_density,
    round(round(avg(CAST(congestion_label = 'High' AS DOUBLE)) * 100e0, 9), 2) AS pct_high
    FROM obs GROUP BY session_id"""))
def session_summary(spark, sf_dir):
    from kerbside.operators import dashboard
    return raw(spark, sf_dir).transform(dashboard.session_summary)


@query("kpi", sql("obs", """SELECT count(*) AS n_rows, count(DISTINCT session_id) AS n_sessions,
    round(round(avg(speed), 9), 1) AS avg_speed,
    round(round(100e0 * avg(CAST(congestion_label = 'High' AS DOUBLE)), 9), 1) AS pct_high FROM obs"""))
def kpi(spark, sf_dir):
    from kerbside.operators import dashboard
    return raw(spark, sf_dir).transform(dashboard.kpi)


@query("filter_choices", sql("obs", """SELECT 'town' AS dimension, 'All' AS choice
    UNION ALL SELECT 'weather', 'All' UNION ALL SELECT DISTINCT 'town', town FROM obs
    UNION ALL SELECT DISTINCT 'weather', weather_name FROM obs"""))
def filter_choices(spark, sf_dir):
    from kerbside.operators import dashboard
    return raw(spark, sf_dir).transform(dashboard.filter_choices)


@query("filtered_view", sql("obs", f"""SELECT {', '.join(OBS_COLUMNS)} FROM obs
    WHERE town = 'Town01' AND weather_name = 'ClearNoon'"""))
def filtered_view(spark, sf_dir):
    from kerbside.operators import dashboard
    return raw(spark, sf_dir).transform(dashboard.filtered, "Town01", "ClearNoon")


@query("summary_stats", sql("feat", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round(round(avg({c}), 9), 6) AS mean,
      round(round(stddev_samp({c}), 9), 6) AS stddev, round(round(CAST(min({c}) AS DOUBLE), 9), 6) AS min_value,
      round(round(CAST(max({c}) AS DOUBLE), 9), 6) AS max_value FROM feat"""
    for c in ["speed", "acceleration", "traffic_density", "speed_x_density", "x", "y", "yaw"])))
def summary_stats(spark, sf_dir):
    from kerbside.operators.features import add_features
    from kerbside.plans.cleaning import cleaned
    return cleaned(spark, sf_dir).transform(add_features).transform(
        D.summary_stats,
        ["speed", "acceleration", "traffic_density", "speed_x_density", "x", "y", "yaw"])
