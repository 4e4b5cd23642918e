"""Telemetry views over the driver's ``lineitem`` table.

The view text is written once and runs unchanged in Spark and in the check engine, so both
see the same input. ``row_a, row_b`` order the copies of a duplicated key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.schema import RAINY_CODES

SESSION_TEXT = """concat('20240101_00000', CAST(l_suppkey % 8 AS STRING),
    '_Town0', CAST(l_suppkey % 4 + 1 AS STRING), '_',
    CASE l_suppkey % 8 WHEN 0 THEN 'ClearNoon' WHEN 1 THEN 'HardRainNoon'
      WHEN 2 THEN 'MidRainyNoon' WHEN 3 THEN 'WetCloudyNoon' WHEN 4 THEN 'HardRainNoon'
      WHEN 5 THEN 'ClearNoon' WHEN 6 THEN 'WetCloudyNoon' ELSE 'ClearNoon' END)"""

UNLABELLED_TEXT = f"""SELECT {SESSION_TEXT} AS session_id,
  CAST(year(l_shipdate) * 12 + month(l_shipdate) - 23904 AS INT) AS tick,
  CAST(l_partkey AS INT) AS vehicle_id,
  CASE WHEN l_orderkey % 997 = 0 THEN NULL WHEN l_orderkey % 499 = 1 THEN 250e0
    ELSE (l_quantity - 1e0) * (1e0 + 10e0 * l_discount) END AS speed,
  l_extendedprice / 2000e0 AS acceleration,
  ((l_partkey * 7919 + l_orderkey * 13) % 3000) / 10e0 - 150e0 AS x,
  ((l_orderkey * 104729 + l_linenumber * 977) % 3000) / 10e0 - 150e0 AS y,
  l_tax * 100e0 AS z,
  ((l_orderkey * 37 + l_linenumber * 11) % 3600) / 10e0 - 180e0 AS yaw,
  CAST(CASE WHEN l_orderkey % 983 = 2 THEN -1
    ELSE (l_partkey * 31 + l_orderkey * 17) % 22 END AS INT) AS traffic_density,
  CAST(CASE WHEN l_orderkey % 43 = 5 THEN -1 ELSE CASE l_suppkey % 8 WHEN 0 THEN 0 WHEN 1 THEN 5 WHEN 2 THEN 4 WHEN 3 THEN 3
    WHEN 4 THEN 5 WHEN 5 THEN 0 WHEN 6 THEN 3 ELSE 0 END END AS INT) AS weather,
  CASE WHEN l_orderkey % 43 = 5 THEN 'Duststorm' ELSE CASE l_suppkey % 8 WHEN 0 THEN 'ClearNoon' WHEN 1 THEN 'HardRainNoon'
    WHEN 2 THEN 'MidRainyNoon' WHEN 3 THEN 'WetCloudyNoon' WHEN 4 THEN 'HardRainNoon'
    WHEN 5 THEN 'ClearNoon' WHEN 6 THEN 'WetCloudyNoon' ELSE 'ClearNoon' END END
    AS weather_name,
  CASE WHEN l_orderkey % 37 = 3 THEN 'Town05' WHEN l_orderkey % 41 = 4 THEN 'Town10HD'
    ELSE concat('Town0', CAST(l_suppkey % 4 + 1 AS STRING)) END AS town,
  CAST((l_partkey + l_linenumber) % 24 AS INT) AS hour,
  l_orderkey AS row_a, l_linenumber AS row_b
FROM {{lineitem}}"""

OBS_TEXT = f"""SELECT *, CASE WHEN row_a % 991 = 0 THEN 'Unknown'
    WHEN traffic_density >= 10 AND speed < 20 THEN 'High'
    WHEN traffic_density < 4 OR speed >= 50 THEN 'Low'
    ELSE 'Medium' END AS congestion_label
FROM ({UNLABELLED_TEXT}) AS unlabelled"""

# Raw actor states: what a collector sees before observations are derived from them.
ACTORS_TEXT = f"""SELECT {SESSION_TEXT} AS session_id,
  CAST((l_orderkey * 7 + l_linenumber * 3) % 400 AS INT) AS raw_tick,
  CAST(l_partkey AS INT) AS vehicle_id,
  CAST(CASE WHEN l_partkey % 9 = 0 THEN 2 WHEN l_partkey % 9 = 1 THEN 6 ELSE 4 END AS INT)
    AS wheels,
  CASE WHEN l_orderkey % 211 = 0 THEN NULL
    ELSE ((l_partkey * 7919 + l_orderkey * 13) % 300000) / 1000e0 - 150e0 END AS x,
  CASE WHEN l_orderkey % 211 = 0 THEN NULL
    ELSE ((l_orderkey * 104729 + l_linenumber * 977) % 300000) / 1000e0 - 150e0 END AS y,
  l_tax * 100e0 AS z,
  ((l_orderkey * 37 + l_linenumber * 11) % 3600) / 10e0 - 180e0 AS yaw,
  l_quantity / 4e0 AS vx, l_discount * 50e0 AS vy, l_tax * 3e0 AS vz,
  l_extendedprice / 20000e0 AS ax, l_discount * 20e0 AS ay, l_tax * 9e0 AS az,
  l_shipdate AS started, concat('Town0', CAST(l_suppkey % 4 + 1 AS STRING)) AS town,
  CASE l_suppkey % 5 WHEN 0 THEN 'ClearNoon' WHEN 1 THEN 'HardRainNight'
    WHEN 2 THEN 'WetSunset' WHEN 3 THEN 'Sandstorm' ELSE 'SoftRainNoon' END AS preset,
  l_orderkey AS row_a, l_linenumber AS row_b
FROM {{lineitem}}"""

ORDER = ["row_a", "row_b"]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def observations_over(lineitem: DataFrame) -> DataFrame:
    """The observation view over any frame shaped like ``lineitem``, streams included."""
    return lineitem.sparkSession.sql(OBS_TEXT, lineitem=lineitem)


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations_over(read_table(spark, sf_dir, "lineitem"))


def worked_out(view: DataFrame) -> DataFrame:
    """The same rows, with every column worked out before anything is filtered. Filters over a wide
    view would otherwise be moved below it, with the whole text of each column they name, and the
    generated method gets too long for the JVM to compile."""
    return view.select(F.inline(F.array(F.struct(*view.columns))))


def actors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(ACTORS_TEXT, lineitem=read_table(spark, sf_dir, "lineitem"))


def plain(df: DataFrame) -> DataFrame:
    """Drop the ordering helpers before a result is returned."""
    return df.drop(*ORDER)


# --- check SQL -------------------------------------------------------------------------

_CTES = {
    "obs": OBS_TEXT.format(lineitem="lineitem"),
    "actors": ACTORS_TEXT.format(lineitem="lineitem"),
    "complete": """SELECT * FROM obs WHERE speed IS NOT NULL AND acceleration IS NOT NULL
        AND traffic_density IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL
        AND congestion_label IS NOT NULL AND weather IS NOT NULL AND hour IS NOT NULL
        AND town IS NOT NULL""",
    "ranked": """SELECT *, row_number() OVER (PARTITION BY session_id, tick, vehicle_id
        ORDER BY row_a, row_b) AS rn FROM complete""",
    "deduped": "SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1",
    "clean": """SELECT * FROM deduped WHERE acceleration >= 0 AND acceleration <= 50
        AND speed >= 0 AND speed <= 200 AND traffic_density >= 0
        AND congestion_label IN ('Low', 'Medium', 'High')""",
    "feat": f"""SELECT *,
        CAST(CASE WHEN speed < 5 THEN 0 WHEN speed < 20 THEN 1 WHEN speed < 50 THEN 2 ELSE 3 END
          AS INT) AS speed_bin,
        CAST(CASE WHEN traffic_density < 3 THEN 0 WHEN traffic_density < 8 THEN 1
          WHEN traffic_density < 15 THEN 2 ELSE 3 END AS INT) AS density_bin,
        CAST(speed < 1 AS INT) AS is_stationary,
        CAST(traffic_density >= 10 AS INT) AS is_high_density,
        CAST(hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 19 AS INT) AS is_rush_hour,
        CAST(weather IN ({', '.join(map(str, sorted(RAINY_CODES)))}) AS INT) AS is_rainy,
        CAST(speed * traffic_density AS DOUBLE) AS speed_x_density,
        CAST(acceleration > 1 AND speed < 15 AS INT) AS is_braking,
        TRY_CAST(regexp_extract(town, '([0-9]+)$', 1) AS INT) AS town_code,
        CAST(CASE congestion_label WHEN 'Low' THEN 0 WHEN 'Medium' THEN 1 WHEN 'High' THEN 2
          ELSE -1 END AS INT) AS label
        FROM clean""",
}
_NEEDS = {"obs": [], "actors": [], "complete": ["obs"], "ranked": ["complete"],
          "deduped": ["ranked"], "clean": ["deduped"], "feat": ["clean"]}


def sql(source: str, body: str, **extra: str) -> str:
    """``WITH`` chain up to ``source``, further named steps, then the final select."""
    chain: list[str] = []

    def add(name: str) -> None:
        for needed in _NEEDS[name]:
            add(needed)
        if name not in chain:
            chain.append(name)

    add(source)
    steps = [(n, _CTES[n]) for n in chain] + list(extra.items())
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in steps) + f"\n{body}"
