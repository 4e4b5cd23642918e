"""Queries: snapshots, splits, evaluation and scoring that SQL can check."""

from __future__ import annotations

from pyspark.sql import functions as F

from kerbside.functions import columns as C
from kerbside.operators import evaluate, features, score, snapshot, spatial, split
from kerbside.plans.cleaning import KEYS, cleaned
from kerbside.plans.registry import query
from kerbside.plans.tables import ORDER, actors, observations, sql
from kerbside.schema import KEY, REASONS
from kerbside.sources.scratch import written

# --- snapshots -------------------------------------------------------------------------


@query("tick_downsample", sql("actors", """SELECT session_id, raw_tick, vehicle_id, row_a, row_b,
    CAST((raw_tick - 100) // 5 AS INT) AS tick FROM actors
    WHERE raw_tick >= 100 AND raw_tick % 5 = 0"""))
def tick_downsample(spark, sf_dir):
    return (actors(spark, sf_dir).select("session_id", "raw_tick", "vehicle_id", *ORDER)
            .transform(snapshot.downsample_ticks))


@query("vehicle_class_filter", sql("actors", """SELECT session_id, raw_tick, vehicle_id, row_a,
    row_b, wheels FROM actors WHERE wheels >= 4"""))
def vehicle_class_filter(spark, sf_dir):
    return (actors(spark, sf_dir).transform(snapshot.keep_vehicles)
            .select("session_id", "raw_tick", "vehicle_id", *ORDER, "wheels"))


@query("live_filter", sql("actors", """SELECT session_id, raw_tick, vehicle_id, row_a, row_b, x, y
    FROM actors WHERE x IS NOT NULL AND y IS NOT NULL"""))
def live_filter(spark, sf_dir):
    return (actors(spark, sf_dir).transform(snapshot.keep_live)
            .select("session_id", "raw_tick", "vehicle_id", *ORDER, "x", "y"))


@query("kinematics_magnitude", sql("actors", """SELECT session_id, raw_tick, vehicle_id, row_a,
    row_b, round(sqrt(vx * vx + vy * vy + vz * vz) * 3.6e0, 3) AS speed,
    round(sqrt(ax * ax + ay * ay + az * az), 4) AS acceleration, round(x, 3) AS x,
    round(y, 3) AS y, round(z, 3) AS z, round(yaw, 2) AS yaw FROM actors"""))
def kinematics_magnitude(spark, sf_dir):
    return (actors(spark, sf_dir).transform(snapshot.add_kinematics)
            .select("session_id", "raw_tick", "vehicle_id", *ORDER, "speed", "acceleration",
                    "x", "y", "z", "yaw"))


_CODES = ", ".join(f"('{n}', {c})" for n, c in snapshot.WEATHER_CODES.items())


@query("weather_encode", sql("actors", f"""SELECT preset, CAST(coalesce(code, -1) AS INT) AS weather,
    coalesce(name, 'ClearNoon') AS applied_weather, count(*) AS n_rows
    FROM actors LEFT JOIN (VALUES {_CODES}) AS d(name, code) ON preset = name GROUP BY ALL"""))
def weather_encode(spark, sf_dir):
    return (actors(spark, sf_dir).select("preset").transform(snapshot.encode_weather)
            .groupBy("preset", "weather", "applied_weather")
            .agg(F.count(F.lit(1)).alias("n_rows")))


@query("session_id_build", sql("actors", """SELECT row_a, row_b, vehicle_id,
    concat_ws('_', strftime(started, '%Y%m%d_%H%M%S'), town, preset) AS session_id FROM actors"""))
def session_id_build(spark, sf_dir):
    return (actors(spark, sf_dir).transform(snapshot.add_session_id)
            .select(*ORDER, "vehicle_id", "session_id"))


_POSITIONS = """SELECT session_id, tick, vehicle_id, min(x) AS x, min(y) AS y FROM {source}
    GROUP BY session_id, tick, vehicle_id"""
_NEAR = """SELECT a.session_id, a.tick, a.vehicle_id, count(b.vehicle_id) AS n
    FROM pos AS a LEFT JOIN pos AS b ON a.session_id = b.session_id AND a.tick = b.tick
      AND a.vehicle_id <> b.vehicle_id
      AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) <= 50
    GROUP BY 1, 2, 3"""


@query("proximity_density", sql(
    "obs", "SELECT session_id, tick, vehicle_id, CAST(n AS INT) AS traffic_density FROM near",
    pos=_POSITIONS.format(source="obs"), near=_NEAR))
def proximity_density(spark, sf_dir):
    positions = (observations(spark, sf_dir).groupBy("session_id", "tick", "vehicle_id")
                 .agg(F.min("x").alias("x"), F.min("y").alias("y")))
    return written(positions, "positions").transform(spatial.proximity_density)


@query("snapshot_observations", sql(
    "actors",
    """SELECT session_id, tick, vehicle_id, round(v, 3) AS speed, round(acc, 4) AS acceleration,
         round(x, 3) AS x, round(y, 3) AS y, round(yaw, 2) AS yaw,
         CAST(n AS INT) AS traffic_density,
         CASE WHEN n >= 10 AND v < 20 THEN 'High' WHEN n < 4 OR v >= 50 THEN 'Low'
           ELSE 'Medium' END AS congestion_label
       FROM one JOIN near USING (session_id, tick, vehicle_id)""",
    one="""SELECT session_id, CAST((raw_tick - 100) // 5 AS INT) AS tick, vehicle_id, x, y, yaw,
        sqrt(vx * vx + vy * vy + vz * vz) * 3.6e0 AS v, sqrt(ax * ax + ay * ay + az * az) AS acc
      FROM (SELECT *, row_number() OVER (PARTITION BY session_id, raw_tick, vehicle_id
        ORDER BY row_a, row_b, ax, started) AS rn FROM actors)
      WHERE rn = 1 AND raw_tick >= 100 AND raw_tick % 5 = 0 AND wheels >= 4 AND x IS NOT NULL
        AND y IS NOT NULL""",
    pos="SELECT session_id, tick, vehicle_id, x, y FROM one", near=_NEAR))
def snapshot_observations(spark, sf_dir):
    from kerbside.operators.cleaning import deduplicate
    # Here the row numbers alone do not tell all copies apart.
    states = actors(spark, sf_dir).transform(deduplicate, [*ORDER, "ax", "started"],
                                             ["session_id", "raw_tick", "vehicle_id"])
    return states.transform(snapshot.observe).select(
        "session_id", "tick", "vehicle_id", "speed", "acceleration", "x", "y", "yaw",
        "traffic_density", "congestion_label")


# --- splits ----------------------------------------------------------------------------

_TICKET = "md5(concat_ws('|', session_id, CAST(tick AS STRING), CAST(vehicle_id AS STRING)))"
_SPLIT = f"""SELECT *, CASE WHEN substr({_TICKET}, 1, 8) < '26666666' THEN 'test'
    WHEN substr({_TICKET}, 1, 8) < '4ccccccc' THEN 'val' ELSE 'train' END AS split FROM feat"""


def split_features(spark, sf_dir, parts=None, share=None):
    """``parts``: that many partitions by key. With as many as shuffles make, the deduplication has
    left the rows so, and nothing is shuffled again. ``share``: see ``cleaned``."""
    rows = cleaned(spark, sf_dir, share)
    rows = rows if parts is None else rows.repartition(parts, *reversed(KEY))
    return rows.transform(features.feature_table).transform(split.add_split)


@query("stratified_split", sql("feat", f"SELECT {KEYS}, label, split FROM s", s=_SPLIT))
def stratified_split(spark, sf_dir):
    return split_features(spark, sf_dir).select("session_id", "tick", "vehicle_id", "label", "split")


@query("split_shuffled", sql("feat", f"SELECT {KEYS}, label, split FROM s", s=_SPLIT))
def split_shuffled(spark, sf_dir):
    """The split rows in the order of their hash."""
    return split.shuffled(split_features(spark, sf_dir)).select(
        "session_id", "tick", "vehicle_id", "label", "split")


@query("stratified_split_exact", sql(
    "feat",
    f"""SELECT {KEYS}, label, CASE WHEN rn < t THEN 'test' WHEN rn < t + v THEN 'val'
      ELSE 'train' END AS split FROM r""",
    r=f"""SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_TICKET}) - 1 AS rn,
        round(count(*) OVER (PARTITION BY label) * 0.15e0) AS t,
        round(count(*) OVER (PARTITION BY label) * 0.15e0) AS v FROM feat"""))
def stratified_split_exact(spark, sf_dir):
    table = cleaned(spark, sf_dir).transform(features.encode_labels).select(
        "session_id", "tick", "vehicle_id", "label")
    return table.transform(split.add_exact_split)


@query("split_report", sql(
    "feat",
    """SELECT split, label, n AS n_rows,
         round(round(100e0 * n / (SELECT count(*) FROM s), 9), 6) AS pct_of_all,
         round(round(100e0 * n / (SELECT count(*) FROM s WHERE s.split = c.split), 9), 6) AS pct_of_split
       FROM c""",
    s=_SPLIT, c="SELECT split, label, count(*) AS n FROM s GROUP BY ROLLUP (split, label)").replace(
        "/ (SELECT count(*) FROM s WHERE s.split = c.split)",
        "/ nullif((SELECT count(*) FROM s WHERE s.split = c.split), 0)"))
def split_report(spark, sf_dir):
    return split_features(spark, sf_dir).transform(split.split_report)


@query("class_weights", sql("feat", """SELECT label, n AS n_rows,
    round(round((SELECT sum(n) FROM c) / (3e0 * n), 9), 6) AS weight FROM c""",
    s=_SPLIT, c="SELECT label, count(*) AS n FROM s WHERE split = 'train' GROUP BY label"))
def class_weights(spark, sf_dir):
    return (split_features(spark, sf_dir).where("split = 'train'").transform(split.class_weights)
            .withColumn("weight", C.steady("weight", 6)))


# --- evaluation on rule baselines ------------------------------------------------------
# Two fixed-arithmetic scorers stand in for fitted models, so the evaluators can be checked
# exactly: one binomial in speed, one that follows density.

_BASE = """SELECT label, least(speed, 100e0) / 100e0 AS a,
    least(traffic_density, 21) / 21e0 AS b FROM s WHERE split = 'test'"""
_SCORED = """SELECT model, label, p0, p1, p2,
    CAST(CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1 ELSE 2 END AS INT)
      AS prediction
  FROM (SELECT 'speed rule' AS model, label, a * a AS p0, 2e0 * a * (1e0 - a) AS p1,
      (1e0 - a) * (1e0 - a) AS p2 FROM base
    UNION ALL SELECT 'density rule', label, (1e0 - b) * (1e0 - b), 2e0 * b * (1e0 - b), b * b
      FROM base)"""
_CONF = """SELECT model, label AS i, prediction AS j, count(*) AS n FROM scored GROUP BY ALL"""
_PER = """SELECT m.model, m.i, coalesce(tp, 0) AS tp, coalesce(pp, 0) AS pp, coalesce(ap, 0) AS ap,
    CASE WHEN coalesce(pp, 0) = 0 THEN 0e0 ELSE coalesce(tp, 0) / CAST(pp AS DOUBLE) END AS pr,
    CASE WHEN coalesce(ap, 0) = 0 THEN 0e0 ELSE coalesce(tp, 0) / CAST(ap AS DOUBLE) END AS rc,
    CASE WHEN pr + rc = 0 THEN 0e0 ELSE 2e0 * pr * rc / (pr + rc) END AS f1
  FROM (SELECT DISTINCT model, i FROM (SELECT model FROM scored)
      CROSS JOIN (VALUES (0), (1), (2)) AS c(i)) AS m
  LEFT JOIN (SELECT model, i, sum(n) AS tp FROM conf WHERE i = j GROUP BY 1, 2) AS t
    ON t.model = m.model AND t.i = m.i
  LEFT JOIN (SELECT model, j, sum(n) AS pp FROM conf GROUP BY 1, 2) AS p
    ON p.model = m.model AND p.j = m.i
  LEFT JOIN (SELECT model, i, sum(n) AS ap FROM conf GROUP BY 1, 2) AS a
    ON a.model = m.model AND a.i = m.i"""
_SCORES = """SELECT model, c AS class, CASE c WHEN 0 THEN p0 WHEN 1 THEN p1 ELSE p2 END AS score,
    CAST(label = c AS INT) AS hit FROM scored CROSS JOIN (VALUES (0), (1), (2)) AS k(c)"""
_RANKED = """SELECT model, class, hit, rank() OVER (PARTITION BY model, class ORDER BY score)
    + (count(*) OVER (PARTITION BY model, class, score) - 1) / 2e0 AS r FROM scores"""
_AUC = """SELECT model, class, sum(hit) AS support,
    (sum(r) FILTER (WHERE hit = 1) - sum(hit) * (sum(hit) + 1) / 2e0)
      / (CAST(sum(hit) AS DOUBLE) * (count(*) - sum(hit))) AS auc FROM ranked_scores
    GROUP BY model, class"""
_EVAL = {"s": _SPLIT, "base": _BASE, "scored": _SCORED}
_FULL = {**_EVAL, "conf": _CONF, "per": _PER, "scores": _SCORES, "ranked_scores": _RANKED,
         "auc": _AUC,
         "metrics": """SELECT model, round(round(sum(tp) / CAST(sum(ap) AS DOUBLE), 9), 6) AS accuracy,
            round(round(sum(pr * ap) / sum(ap), 9), 6) AS precision,
            round(round(sum(rc * ap) / sum(ap), 9), 6) AS recall, round(round(sum(f1 * ap) / sum(ap), 9), 6) AS f1,
            round(round((SELECT sum(auc * support) / sum(support) FROM auc WHERE auc.model = per.model), 9),
              6) AS roc_auc FROM per GROUP BY model"""}


def rule_scores(df):
    """Scores of both baselines for a feature table, in long form."""
    a = F.least("speed", F.lit(100.0)) / 100.0
    b = F.least("traffic_density", F.lit(21)) / F.lit(21.0)
    models = F.array(
        F.struct(F.lit("speed rule").alias("model"), F.array(
            a * a, 2.0 * a * (1.0 - a), (1.0 - a) * (1.0 - a)).alias("probability")),
        F.struct(F.lit("density rule").alias("model"), F.array(
            (1.0 - b) * (1.0 - b), 2.0 * b * (1.0 - b), b * b).alias("probability")))
    return (df.withColumn("_m", F.explode(models)).select("*", "_m.*").drop("_m")
            .transform(score.add_score))


def _scored_test(spark, sf_dir):
    """Scored test rows as a stored table: the evaluators read them more than once."""
    scored = rule_scores(split_features(spark, sf_dir).where("split = 'test'"))
    return written(scored.select("model", "label", "prediction", "probability"), "scored")


@query("eval_metrics", sql("feat", "SELECT * FROM metrics", **_FULL))
def eval_metrics(spark, sf_dir):
    return _scored_test(spark, sf_dir).transform(evaluate.metrics)


@query("eval_confusion", sql(
    "feat",
    """SELECT m.model, a.l AS actual, b.l AS predicted, coalesce(n, 0) AS n_rows,
         round(round(100e0 * coalesce(n, 0) / (SELECT sum(n) FROM conf AS q
           WHERE q.model = m.model AND q.i = a.i), 9), 6) AS pct
       FROM (SELECT DISTINCT model FROM scored) AS m
       CROSS JOIN (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High')) AS a(i, l)
       CROSS JOIN (VALUES (0, 'Low'), (1, 'Medium'), (2, 'High')) AS b(i, l)
       LEFT JOIN conf AS c ON c.model = m.model AND c.i = a.i AND c.j = b.i""",
    **_EVAL, conf=_CONF))
def eval_confusion(spark, sf_dir):
    return _scored_test(spark, sf_dir).transform(evaluate.confusion_matrix)


@query("eval_class_report", sql(
    "feat",
    """SELECT model, CAST(i AS INT) AS line, CASE i WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium'
         ELSE 'High' END AS class_name, round(pr, 4) AS precision, round(rc, 4) AS recall,
         round(f1, 4) AS f1, CAST(ap AS BIGINT) AS support FROM per
       UNION ALL SELECT model, 3, 'accuracy', round(sum(tp) / CAST(sum(ap) AS DOUBLE), 4),
         round(sum(tp) / CAST(sum(ap) AS DOUBLE), 4), round(sum(tp) / CAST(sum(ap) AS DOUBLE), 4),
         CAST(sum(ap) AS BIGINT) FROM per GROUP BY model
       UNION ALL SELECT model, 4, 'macro avg', round(avg(pr), 4), round(avg(rc), 4),
         round(avg(f1), 4), CAST(sum(ap) AS BIGINT) FROM per GROUP BY model
       UNION ALL SELECT model, 5, 'weighted avg', round(sum(pr * ap) / sum(ap), 4),
         round(sum(rc * ap) / sum(ap), 4), round(sum(f1 * ap) / sum(ap), 4),
         CAST(sum(ap) AS BIGINT) FROM per GROUP BY model""", **_EVAL, conf=_CONF, per=_PER))
def eval_class_report(spark, sf_dir):
    return _scored_test(spark, sf_dir).transform(evaluate.class_report)


@query("eval_roc_auc", sql("feat", """SELECT model, CAST(class AS INT) AS class,
    round(round(auc, 9), 6) AS auc, CAST(support AS BIGINT) AS support FROM auc""",
    **_EVAL, scores=_SCORES, ranked_scores=_RANKED, auc=_AUC))
def eval_roc_auc(spark, sf_dir):
    return (_scored_test(spark, sf_dir).transform(evaluate.class_auc)
            .withColumn("auc", C.steady("auc", 6)))


@query("eval_roc_curve", sql(
    "feat",
    """SELECT model, CAST(class AS INT) AS class, round(round(score, 9), 6) AS threshold,
         round(round(sum(neg) OVER w / CAST(sum(neg) OVER g AS DOUBLE), 9), 6) AS fpr,
         round(round(sum(pos) OVER w / CAST(sum(pos) OVER g AS DOUBLE), 9), 6) AS tpr FROM k
       WINDOW g AS (PARTITION BY model, class),
         w AS (PARTITION BY model, class ORDER BY score DESC)
       UNION ALL SELECT DISTINCT model, CAST(class AS INT), 'inf'::DOUBLE, 0e0, 0e0 FROM k""",
    **_EVAL, scores=_SCORES, k="""SELECT model, class, score, sum(hit) AS pos,
      sum(1 - hit) AS neg FROM scores GROUP BY 1, 2, 3"""))
def eval_roc_curve(spark, sf_dir):
    return _scored_test(spark, sf_dir).transform(evaluate.roc_curve)


@query("model_comparison", sql(
    "feat",
    """SELECT model, metric, value, printf('%.4f', value) AS shown,
         CAST(abs(value - max(value) OVER (PARTITION BY metric)) < 1e-6 AS INT) AS is_best
       FROM (UNPIVOT metrics ON accuracy, precision, recall, f1, roc_auc
         INTO NAME metric VALUE value)""", **_FULL))
def model_comparison(spark, sf_dir):
    return (_scored_test(spark, sf_dir).transform(evaluate.metrics)
            .transform(evaluate.comparison))


# --- scoring ---------------------------------------------------------------------------

_SEV = "50e0 * p1 + 100e0 * p2"


@query("severity_score", sql(
    "feat",
    f"""SELECT {KEYS}, model, prediction, CASE prediction WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium'
          ELSE 'High' END AS predicted_label,
        round(round(100e0 * greatest(p0, p1, p2), 9), 6) AS confidence_pct, round(round({_SEV}, 9), 6) AS severity,
        CASE WHEN {_SEV} < 20 THEN 'Free flow' WHEN {_SEV} < 40 THEN 'Light'
          WHEN {_SEV} < 60 THEN 'Moderate' WHEN {_SEV} < 80 THEN 'Heavy' ELSE 'Gridlock' END
          AS severity_band,
        CASE WHEN {_SEV} < 33 THEN 'green' WHEN {_SEV} < 66 THEN 'amber' ELSE 'red' END
          AS severity_colour FROM scored""",
    base=f"""SELECT {KEYS}, label, least(speed, 100e0) / 100e0 AS a,
      least(traffic_density, 21) / 21e0 AS b FROM feat""",
    scored=_SCORED.replace("SELECT model, label", f"SELECT {KEYS}, model, label")
    .replace("AS model, label", f"AS model, {KEYS}, label")
    .replace("'density rule', label", f"'density rule', {KEYS}, label")))
def severity_score(spark, sf_dir):
    return rule_scores(cleaned(spark, sf_dir).transform(features.feature_table)).select(
        "session_id", "tick", "vehicle_id", "model", "prediction", "predicted_label",
        C.steady("confidence_pct", 6).alias("confidence_pct"),
        C.steady("severity", 6).alias("severity"), "severity_band", "severity_colour")


_SLOW_HEAD, _SLOW_TAIL = REASONS["slow"].split("{speed}")
_REASON_SQL = f"""concat_ws(' | ', CASE WHEN is_stationary = 1 THEN '{REASONS["stationary"]}' END,
    CASE WHEN speed < 15 THEN concat('{_SLOW_HEAD}', CAST(CAST(round_even(speed, 0) AS BIGINT)
      AS STRING), '{_SLOW_TAIL}') END,
    CASE WHEN is_braking = 1 THEN '{REASONS["braking"]}' END,
    CASE WHEN is_rush_hour = 1 THEN '{REASONS["rush_hour"]}' END,
    CASE WHEN is_rainy = 1 THEN '{REASONS["rainy"]}' END,
    CASE WHEN speed >= 50 THEN '{REASONS["fast"]}' END)"""


@query("signal_reasons", sql("feat", f"""SELECT {KEYS},
    CASE WHEN {_REASON_SQL} = '' THEN '{REASONS["none"]}' ELSE {_REASON_SQL} END AS reasons
    FROM feat"""))
def signal_reasons(spark, sf_dir):
    return (cleaned(spark, sf_dir).transform(features.add_features).transform(score.add_reasons)
            .select("session_id", "tick", "vehicle_id",
                    F.concat_ws(" | ", "reasons").alias("reasons")))


@query("event_time", sql("obs", f"""SELECT {KEYS}, row_a, row_b,
    strptime(substr(session_id, 1, 15), '%Y%m%d_%H%M%S') + to_milliseconds(tick * 250) AS event_ts
    FROM obs"""))
def event_time(spark, sf_dir):
    return observations(spark, sf_dir).select("session_id", "tick", "vehicle_id", *ORDER,
                                              C.event_time().alias("event_ts"))
