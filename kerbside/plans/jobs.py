"""Queries: sources and sinks, model training, attribution, streaming.

Sinks write to the shared scratch folder and are read back, so their result is checked like any
other. Model fits have the sizes of the operator defaults; they are keyword arguments here as
well.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from kerbside.functions import columns as C
from kerbside.operators import attribution, boosting, evaluate, leaf_bits, ml, score
from kerbside.plans.cleaning import KEYS, OBS_LIST
from kerbside.plans.modelling import _FULL, _scored_test, split_features
from kerbside.plans.registry import ORACLES, query
from kerbside.plans.tables import observations, observations_over, plain, read_table, sql, worked_out
from kerbside.schema import FEATURES, KEY, METRICS, MODEL_FEATURES, OBS_COLUMNS, SPLIT_COLUMNS
from kerbside.sources import readers, sinks
from kerbside.sources.scratch import scratch_path, written
from kerbside.streaming import batches, streams

# --- sources and sinks -----------------------------------------------------------------


@query("read_observations", sql("obs", f"SELECT {OBS_LIST} FROM obs"))
def read_observations(spark, sf_dir):
    """Two Parquet logs of one directory, found by pattern."""
    base = scratch_path(spark, "logs")
    rows = observations(spark, sf_dir).select(*OBS_COLUMNS)
    sinks.append_parquet(rows.where("hour < 12"), f"{base}/a.parquet", by_session=False)
    sinks.append_parquet(rows.where("hour >= 12"), f"{base}/b.parquet", by_session=False)
    return readers.read_observations(spark, base).select(*OBS_COLUMNS)


@query("scan_mixed_dedup_stem", sql("obs", f"""SELECT {OBS_LIST},
    CASE WHEN hour < 12 THEN 'a.parquet' WHEN hour < 18 THEN 'b.csv' ELSE 'c.csv' END AS source_file
    FROM obs"""))
def scan_mixed_dedup_stem(spark, sf_dir):
    """``a`` exists in both formats, ``b`` and ``c`` only as CSV, ``c`` in another column order."""
    base = scratch_path(spark, "mixed")
    rows = observations(spark, sf_dir).select(*OBS_COLUMNS)
    first = rows.where("hour < 12")
    sinks.append_parquet(first, f"{base}/a.parquet", by_session=False)
    sinks.append_csv(first, f"{base}/a.csv")
    sinks.append_csv(rows.where("hour >= 12 AND hour < 18"), f"{base}/b.csv")
    sinks.append_csv(rows.where("hour >= 18").select(*reversed(OBS_COLUMNS)), f"{base}/c.csv")
    return readers.read_mixed(spark, base)


@query("scan_recursive_twins", sql("obs", f"""SELECT {OBS_LIST}, source_file FROM (
    SELECT *, 'north/a.parquet' AS source_file FROM obs WHERE hour < 12
    UNION ALL SELECT *, 'north/a.csv' FROM obs WHERE hour < 12
    UNION ALL SELECT *, 'south/b.csv' FROM obs WHERE hour >= 12)"""))
def scan_recursive_twins(spark, sf_dir):
    """Both formats in folders below; a log that is there in both counts twice."""
    base = scratch_path(spark, "tree")
    rows = observations(spark, sf_dir).select(*OBS_COLUMNS)
    sinks.append_parquet(rows.where("hour < 12"), f"{base}/north/a.parquet", by_session=False)
    sinks.append_csv(rows.where("hour < 12"), f"{base}/north/a.csv")
    sinks.append_csv(rows.where("hour >= 12"), f"{base}/south/b.csv")
    return readers.read_mixed(spark, base, recursive=True, keep_twins=True)


@query("bad_record_ledger", sql("obs", """SELECT 'log.csv' AS source_file, reason, column_name, count(*) AS n_records
    FROM (SELECT 'malformed' AS reason, NULL AS column_name FROM obs WHERE row_a % 10 = 0
      UNION ALL SELECT 'not_cast', 'speed' FROM obs WHERE row_a % 10 <> 0 AND row_a % 7 = 0
      UNION ALL SELECT 'not_cast', 'tick' FROM obs WHERE row_a % 10 <> 0 AND row_a % 11 = 0) GROUP BY ALL"""))
def bad_record_ledger(spark, sf_dir):
    """A CSV log with cut lines, words for speeds and ticks beyond the integers."""
    base = scratch_path(spark, "ledger")
    odd = {"speed": F.when(F.col("row_a") % 7 == 0, "fast"), "tick": F.when(F.col("row_a") % 11 == 0, "99999999999")}
    values = [F.coalesce(odd.get(c, F.lit(None).cast("string")), F.col(c).cast("string"), F.lit("")) for c in OBS_COLUMNS]
    line = F.when(F.col("row_a") % 10 == 0, F.concat_ws(",", "session_id", F.lit("1"))).otherwise(F.concat_ws(",", *values))
    # One text column named like a header line, written without a separator that occurs in it.
    (observations(spark, sf_dir).select(line.alias(",".join(OBS_COLUMNS))).write.option("header", "true")
     .option("sep", "\u0001").csv(f"{base}/log.csv"))
    return readers.bad_records(spark, base).drop("example")


@query("sink_csv", sql("obs", f"SELECT {OBS_LIST} FROM obs"))
def sink_csv(spark, sf_dir):
    """Two appends to one CSV target."""
    base = scratch_path(spark, "csv")
    rows = observations(spark, sf_dir).select(*OBS_COLUMNS)
    sinks.append_csv(rows.where("tick < 80"), f"{base}/log.csv")
    sinks.append_csv(rows.where("tick >= 80"), f"{base}/log.csv")
    return readers.read_mixed(spark, base).select(*OBS_COLUMNS)


@query("sink_parquet", sql("obs", f"SELECT {OBS_LIST} FROM obs"))
def sink_parquet(spark, sf_dir):
    """Two appends to one Parquet target, partitioned by session."""
    path = f"{scratch_path(spark, 'parquet')}/log.parquet"
    rows = observations(spark, sf_dir).select(*OBS_COLUMNS)
    sinks.append_parquet(rows.where("tick < 80"), path)
    sinks.append_parquet(rows.where("tick >= 80"), path)
    return spark.read.parquet(path).select(*OBS_COLUMNS)


def _stored_splits(spark, sf_dir):
    base = scratch_path(spark, "splits")
    sinks.write_splits(split_features(spark, sf_dir), base)
    return base


_STORED = ", ".join("round(round(speed_x_density, 9), 6) AS speed_x_density" if c == "speed_x_density" else c
                    for c in SPLIT_COLUMNS)


@query("sink_splits", sql("feat", f"SELECT {_STORED}, split FROM s", s=_FULL["s"]))
def sink_splits(spark, sf_dir):
    stored = spark.read.parquet(_stored_splits(spark, sf_dir))
    return stored.select(*SPLIT_COLUMNS, "split").withColumn(
        "speed_x_density", C.steady("speed_x_density", 6))


@query("split_reader", sql("feat", "SELECT label, " + ", ".join(
    f"CAST({f} AS DOUBLE) AS {f}" for f in MODEL_FEATURES) + " FROM s WHERE split = 'test'",
    s=_FULL["s"]))
def split_reader(spark, sf_dir):
    base = _stored_splits(spark, sf_dir)
    wanted = readers.model_features(spark, f"{base}/_feature_cols.txt")
    return readers.read_split(spark, base, "test", wanted)


@query("feature_list", sql("feat", " UNION ALL ".join(
    f"SELECT CAST({i} AS INT) AS position, '{f}' AS feature, count({f}) AS n_values FROM feat"
    for i, f in enumerate(FEATURES, 1))))
def feature_list(spark, sf_dir):
    """The stored list, with the number of values each named column has in the stored data."""
    base = _stored_splits(spark, sf_dir)
    names = readers.read_feature_list(spark, f"{base}/_feature_cols.txt")
    counts = spark.read.parquet(base).agg(*[F.count(n).alias(n) for n in names])
    return counts.select(F.explode(F.array(*[
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("feature"), F.col(n).alias("n_values"))
        for i, n in enumerate(names, 1)])).alias("r")).select("r.*")


@query("comparison_csv", sql("feat", "SELECT model, " + ", ".join(METRICS) + " FROM metrics",
                             **_FULL))
def comparison_csv(spark, sf_dir):
    path = scratch_path(spark, "comparison")
    sinks.write_comparison(_scored_test(spark, sf_dir).transform(evaluate.metrics), path)
    return readers.read_comparison(spark, path)


# --- models ----------------------------------------------------------------------------

FOREST, BOOSTED, LOGISTIC = "Random Forest", "Gradient Boosting", "Logistic Regression"

# What one Spark application has fitted, by application, tables and name: queries that look at
# the same model share one fit.
_FITTED: dict[tuple, object] = {}


def _once(spark, sf_dir, name, make):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _FITTED:
        _FITTED[key] = make()
    return _FITTED[key]


def training_table(spark, sf_dir):
    """Split features without incomplete rows, written once: every fit reads it many times.

    The rows are dealt by key, so that a small table keeps all cores busy as well. Features are
    worked out before rows without one are left out, as columns of a view are.
    """
    def make():
        parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
        table = split_features(spark, sf_dir, parts).select(*SPLIT_COLUMNS, "split")
        return written(worked_out(table).transform(ml.usable), "training")

    return _once(spark, sf_dir, "training", make)


def fit_table(spark, sf_dir, at_least):
    """Rows of ``training_table`` for trials on a bounded sample: all, or those of keys whose hash lies
    below a cut, with ``at_least`` so many training rows. No registered query uses it: ``fitted`` reads
    the whole training table.

    The cut stands before the deduplication: every row is read, but only the keys below the cut are
    shuffled and get features. It is doubled until there are enough rows.
    """
    def make():
        share = 3 * at_least / max(read_table(spark, sf_dir, "lineitem").count(), 1)
        while share < 1:
            some = worked_out(split_features(spark, sf_dir, share=share).select(*SPLIT_COLUMNS, "split"))
            table = written(some.transform(ml.usable), "fit-table")
            if table.where("split = 'train'").count() >= at_least:
                return table
            share *= 2
        return training_table(spark, sf_dir)

    return _once(spark, sf_dir, ("fit-table", at_least), make)


def fitted(spark, sf_dir, name, trees=200, depth=20, rounds=500):
    """One of the three models, fitted on the whole training split."""
    def make():
        table = training_table(spark, sf_dir)
        if name == LOGISTIC:
            return ml.fit_logistic(table.where("split = 'train'"))
        if name == FOREST:
            return ml.fit_forest(table.where("split = 'train'"), trees=trees, depth=depth)
        known = table.where("split <> 'test'").withColumn("is_val", F.col("split") == "val")
        return boosting.fit_softmax(known.select(*MODEL_FEATURES, "label", "is_val"), rounds=rounds)

    return _once(spark, sf_dir, (name, trees, depth, rounds), make)


def scored_by(df, model):
    if isinstance(model, boosting.BoostedModel):
        return boosting.add_boosted_probability(df, model)
    if isinstance(model.stages[-1], RandomForestClassificationModel):
        return leaf_bits.add_forest_probability(df, model.stages[-1], MODEL_FEATURES)
    return score.add_probability(df, model)


def _held_out(spark, sf_dir, names):
    """Validation and test rows with the probabilities of some models, written once."""
    table = training_table(spark, sf_dir).where("split <> 'train'")
    scored = None
    for name in names:
        one = scored_by(table, fitted(spark, sf_dir, name)).select(
            F.lit(name).alias("model"), "split", "label", "probability")
        scored = one if scored is None else scored.unionByName(one)
    return written(scored.withColumn("prediction", C.best_class("probability")), "scored")


def _evaluated(scored):
    """Metrics per model and split."""
    named = scored.withColumn("model", F.concat_ws(" / ", "model", "split")).transform(evaluate.metrics)
    cut = F.split("model", " / ")
    return named.select(cut[0].alias("model"), cut[1].alias("split"), *METRICS)


@query("ml_logreg")
def ml_logreg(spark, sf_dir):
    return _evaluated(_held_out(spark, sf_dir, [LOGISTIC]))


@query("ml_random_forest")
def ml_random_forest(spark, sf_dir):
    """Evaluated after it was saved and loaded."""
    saved = sinks.save_model(fitted(spark, sf_dir, FOREST), scratch_path(spark, "models"), FOREST)
    table = training_table(spark, sf_dir).where("split <> 'train'")
    scored = scored_by(table, PipelineModel.load(saved)).select(
        F.lit(FOREST).alias("model"), "split", "label", "probability", C.best_class("probability").alias("prediction"))
    return _evaluated(written(scored, "scored"))


@query("ml_gbt_ovr")
def ml_gbt_ovr(spark, sf_dir):
    """One softmax ensemble (the name is that of the survey), saved and loaded."""
    saved = boosting.save_boosted(fitted(spark, sf_dir, BOOSTED), spark, scratch_path(spark, "models"))
    table = training_table(spark, sf_dir).where("split <> 'train'")
    scored = boosting.add_boosted_probability(table, boosting.load_boosted(spark, saved)).select(
        F.lit(BOOSTED).alias("model"), "split", "label", "probability", C.best_class("probability").alias("prediction"))
    return _evaluated(written(scored, "scored"))


@query("model_comparison_fitted")
def model_comparison_fitted(spark, sf_dir):
    """All three models on the validation and on the test split, best per split and metric marked."""
    per_model = written(_evaluated(_held_out(spark, sf_dir, [LOGISTIC, FOREST, BOOSTED])), "metrics")
    parts = [evaluate.comparison(per_model.where(F.col("split") == s)).withColumn("split", F.lit(s))
             for s in ("val", "test")]
    return parts[0].unionByName(parts[1])


_SPLIT_ROWS = "SELECT count(*) FROM s WHERE split = "


@query("metrics_check", sql("feat", f"""SELECT model, split, n_rows, CAST(0 AS BIGINT) AS n_off
    FROM (VALUES ('{LOGISTIC}'), ('{FOREST}'), ('{BOOSTED}')) AS m(model),
      (SELECT split, count(*) AS n_rows FROM s WHERE split <> 'train' GROUP BY split)""", s=_FULL["s"]))
def metrics_check(spark, sf_dir):
    """Accuracy, precision, recall and F1 of the fitted models equal a plain count over the
    stored scores."""
    stored = _held_out(spark, sf_dir, [LOGISTIC, FOREST, BOOSTED])
    per = None
    for c in range(3):
        hit = F.count_if((F.col("label") == c) & (F.col("prediction") == c))
        one = stored.groupBy("model", "split").agg(
            F.count_if(F.col("label") == c).alias("support"),
            F.coalesce(F.try_divide(hit, F.count_if(F.col("prediction") == c)), F.lit(0.0)).alias("p"),
            F.coalesce(F.try_divide(hit, F.count_if(F.col("label") == c)), F.lit(0.0)).alias("r"), hit.alias("hit"))
        per = one if per is None else per.unionByName(one)
    f1 = F.coalesce(F.try_divide(2 * F.col("p") * F.col("r"), F.col("p") + F.col("r")), F.lit(0.0))
    plain = per.groupBy("model", "split").agg(
        F.sum("support").alias("n_rows"), (F.sum("hit") / F.sum("support")).alias("accuracy_2"),
        *[(F.sum(v * F.col("support")) / F.sum("support")).alias(f"{n}_2")
          for n, v in (("precision", F.col("p")), ("recall", F.col("r")), ("f1", f1))])
    off = sum((F.abs(F.col(m) - F.col(f"{m}_2")) > 2e-6).cast("long") for m in ("accuracy", "precision", "recall", "f1"))
    return plain.join(_evaluated(stored), ["model", "split"]).select("model", "split", "n_rows", off.alias("n_off"))


@query("logistic_slope", sql("feat", f"""SELECT ({_SPLIT_ROWS}'train') AS n_rows, true AS is_flat""", s=_FULL["s"]))
def logistic_slope(spark, sf_dir):
    """The gradient of the penalised loss is zero at the fitted coefficients."""
    train = training_table(spark, sf_dir).where("split = 'train'")
    slope = ml.logistic_slope(train, fitted(spark, sf_dir, LOGISTIC))
    return train.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(slope < 1e-4).alias("is_flat"))


@query("score_batch")
def score_batch(spark, sf_dir):
    """Every cleaned row scored by a fitted model."""
    table = training_table(spark, sf_dir)
    return scored_by(table, fitted(spark, sf_dir, LOGISTIC)).transform(score.add_score).select(
        *KEY, "label", "prediction", "predicted_label", "confidence_pct", "severity",
        "severity_band")


def _coverage(spark, sf_dir, name):
    """Every cleaned row has a score, towns without a number included; probabilities sum to 1."""
    scored = scored_by(training_table(spark, sf_dir), fitted(spark, sf_dir, name)).transform(score.add_score)
    scored = written(scored.select("town_code", "predicted_label", "severity", "probability"), "scored")
    total = F.aggregate("probability", F.lit(0.0), lambda a, p: a + p)
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("town_code") == -1).alias("n_unnumbered_town"),
        F.count_if(F.col("predicted_label").isNull() | F.isnan("severity")).alias("n_unscored"),
        F.count_if(F.abs(total - 1.0) > 1e-9).alias("n_off_one"))


_COVERED = sql("feat", """SELECT count(*) AS n_rows,
    count(*) FILTER (WHERE town_code IS NULL) AS n_unnumbered_town, CAST(0 AS BIGINT) AS n_unscored,
    CAST(0 AS BIGINT) AS n_off_one FROM feat""")


@query("score_coverage", _COVERED)
def score_coverage(spark, sf_dir):
    return _coverage(spark, sf_dir, LOGISTIC)


@query("forest_coverage", _COVERED)
def forest_coverage(spark, sf_dir):
    return _coverage(spark, sf_dir, FOREST)


@query("boosted_coverage", _COVERED)
def boosted_coverage(spark, sf_dir):
    return _coverage(spark, sf_dir, BOOSTED)


def _importance(spark, sf_dir):
    return ml.feature_importance(spark, {
        FOREST: fitted(spark, sf_dir, FOREST).stages[-1].featureImportances.toArray(),
        BOOSTED: boosting.gain_importance(fitted(spark, sf_dir, BOOSTED))})


@query("feature_importance")
def feature_importance(spark, sf_dir):
    return _importance(spark, sf_dir)


@query("importance_check", sql("feat", f"""SELECT model, CAST({len(MODEL_FEATURES)} AS BIGINT) AS n_features,
    1e0 AS total, CAST(0 AS BIGINT) AS n_negative FROM (VALUES ('{FOREST}'), ('{BOOSTED}')) AS m(model)
    WHERE (SELECT count(*) FROM feat) > 0"""))
def importance_check(spark, sf_dir):
    """Importances are shares of one."""
    return _importance(spark, sf_dir).groupBy("model").agg(
        F.count_distinct("feature").alias("n_features"), C.steady(F.sum("importance"), 6).alias("total"),
        F.count_if(F.col("importance") < 0).alias("n_negative"))


def _attributed(spark, sf_dir, name):
    """Test rows with the attributions of a model, and its output with every feature unknown."""
    def make():
        rows, base = _attribute_test(spark, sf_dir, name)
        return written(rows, "attributed"), base

    return _once(spark, sf_dir, ("attributed", name), make)


def _attribute_test(spark, sf_dir, name):
    model = fitted(spark, sf_dir, name)
    scored = (scored_by(training_table(spark, sf_dir).where("split = 'test'"), model)
              .withColumn("prediction", C.best_class("probability"))
              .select(*KEY, "prediction", "probability", *MODEL_FEATURES)
              .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *KEY))  # heavy rows, dealt evenly
    nodes = (attribution.boosted_nodes(spark, model) if name == BOOSTED
             else attribution.forest_nodes(spark, model.stages[-1]))
    return attribution.attribute_ensemble(scored, nodes, scored.columns)


@query("attribution")
def attribution_values(spark, sf_dir):
    """One line per test row, class and feature."""
    rows, _ = _attributed(spark, sf_dir, FOREST)
    lines = rows.select(*KEY, F.posexplode("attribution").alias("class", "v"))
    return (lines.select(*KEY, "class", F.posexplode("v").alias("i", "value"))
            .select(*KEY, "class", F.element_at(F.array(*[F.lit(f) for f in MODEL_FEATURES]),
                                                F.col("i") + 1).alias("feature"), "value"))


def _attribution_check(spark, sf_dir, name):
    rows, base = _attributed(spark, sf_dir, name)
    told = F.transform("attribution", lambda v, c: F.aggregate(v, F.lit(0.0), lambda a, x: a + x) + F.element_at(
        F.array(*[F.lit(float(b)) for b in base]), c + 1))
    if name == BOOSTED:  # raw scores: shares of their exponentials are the probabilities
        e = F.transform(told, lambda v: F.exp(v))
        told = F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda a, x: a + x))
    lines = rows.select(F.explode(F.zip_with(told, "probability", lambda a, b: F.abs(a - b))).alias("gap"))
    return lines.agg(F.count(F.lit(1)).alias("n_lines"),
                     F.count_if(F.isnan("gap") | (F.col("gap") > 1e-9)).alias("n_off"))


_ADDS_UP = sql("feat", f"SELECT 3 * ({_SPLIT_ROWS}'test') AS n_lines, CAST(0 AS BIGINT) AS n_off", s=_FULL["s"])


@query("attribution_check", _ADDS_UP)
def attribution_check(spark, sf_dir):
    """For every test row and class: base and attributions add up to the forest's probability."""
    return _attribution_check(spark, sf_dir, FOREST)


@query("attribution_check_boosted", _ADDS_UP)
def attribution_check_boosted(spark, sf_dir):
    """The same for the boosted model, whose attributions are of raw scores."""
    return _attribution_check(spark, sf_dir, BOOSTED)


@query("attribution_top")
def attribution_top(spark, sf_dir):
    return _attributed(spark, sf_dir, FOREST)[0].transform(attribution.top_attributions, KEY)


# --- streaming -------------------------------------------------------------------------

def _stream(spark, sf_dir, timed=True):
    """The observation view over the table's files, read as a stream.

    The pattern matches the table whether it is one file or a folder of files. Without ``timed``
    there is no event time, which costs a text to parse per row.
    """
    schema = read_table(spark, sf_dir, "lineitem").schema
    files = streams.read_files(spark, f"{sf_dir}/lineitem[.]parquet", schema)
    view = plain(observations_over(files))
    return worked_out(streams.add_event_time(view) if timed else view)


def _timed(spark, sf_dir):
    """Valid rows with their event time, which is worked out once, not once per use in a window."""
    return worked_out(streams.add_event_time(plain(observations(spark, sf_dir)))).transform(streams.clean_rows)


_VALID = """SELECT * FROM complete WHERE acceleration >= 0 AND acceleration <= 50 AND speed >= 0
    AND speed <= 200 AND traffic_density >= 0 AND congestion_label IN ('Low', 'Medium', 'High')"""


@query("stream_ingest", sql("complete", f"SELECT {OBS_LIST} FROM valid", valid=_VALID))
def stream_ingest(spark, sf_dir):
    path = streams.run_available(streams.clean_rows(_stream(spark, sf_dir)).drop("event_ts"), "ingest")
    return spark.read.parquet(path)


@query("stream_dedup", sql("complete", f"SELECT DISTINCT {KEYS} FROM valid", valid=_VALID))
def stream_dedup(spark, sf_dir):
    """Keys only: which copy of a key arrives first is up to the stream."""
    rows = _stream(spark, sf_dir).transform(streams.clean_rows)
    path = streams.run_available(rows.transform(streams.deduplicate_stream).select(*KEY), "dedup")
    return spark.read.parquet(path)


_TIMED = """SELECT *, strptime(substr(session_id, 1, 15), '%Y%m%d_%H%M%S')
    + to_milliseconds(tick * 250) AS event_ts FROM valid"""
_KPI = """count(*) AS n_rows, round(round(avg(speed), 9), 6) AS avg_speed,
    round(round(100e0 * avg(CAST(congestion_label = 'High' AS DOUBLE)), 9), 6) AS pct_high"""


@query("windowed_kpi", sql(
    "complete", f"""SELECT time_bucket(INTERVAL '5 seconds', event_ts) AS window_start,
      time_bucket(INTERVAL '5 seconds', event_ts) + INTERVAL '5 seconds' AS window_end, town,
      {_KPI}, count(DISTINCT vehicle_id) AS vehicles FROM timed GROUP BY 1, 2, 3""",
    valid=_VALID, timed=_TIMED))
def windowed_kpi(spark, sf_dir):
    return _timed(spark, sf_dir).transform(streams.windowed_kpi, distinct=F.count_distinct("vehicle_id"))


@query("windowed_kpi_sliding", sql(
    "complete", f"""SELECT w AS window_start, w + INTERVAL '5 seconds' AS window_end, town, {_KPI},
      count(DISTINCT vehicle_id) AS vehicles
      FROM (SELECT *, time_bucket(INTERVAL '1 second', event_ts) - to_seconds(k) AS w FROM timed
        CROSS JOIN (SELECT unnest(range(5)) AS k)) GROUP BY 1, 2, 3""",
    valid=_VALID, timed=_TIMED))
def windowed_kpi_sliding(spark, sf_dir):
    return streams.slid_kpi(streams.vehicle_sums(_timed(spark, sf_dir), "1 second"), "1 second", 5)


_LONG = """SELECT time_bucket(INTERVAL '{n} seconds', event_ts) AS window_start,
      time_bucket(INTERVAL '{n} seconds', event_ts) + INTERVAL '{n} seconds' AS window_end, town,
      {kpi}, true AS vehicles_near FROM timed GROUP BY 1, 2, 3"""


def _near_exact(spark, sf_dir, length, slide=None, steps=1):
    """Windows rolled up from one table of sketches, their vehicles compared with exact counts."""
    rows = _timed(spark, sf_dir)
    sketches = written(streams.vehicle_sketches(rows), "sketches")
    exact = (streams.windowed_kpi(rows, length, distinct=F.count_distinct("vehicle_id")) if slide is None
             else streams.slid_kpi(streams.vehicle_sums(rows, slide), slide, steps))
    exact = exact.select("window_start", "town", F.col("vehicles").alias("exact"))
    near = F.abs(F.col("vehicles") - F.col("exact")) <= streams.sketch_slack("exact")
    return streams.rolled_up(sketches, length, slide).join(exact, ["window_start", "town"]).select(
        "window_start", "window_end", "town", "n_rows", "avg_speed", "pct_high", near.alias("vehicles_near"))


@query("sketch_kpi_long", sql("complete", _LONG.format(n=30, kpi=_KPI), valid=_VALID, timed=_TIMED))
def sketch_kpi_long(spark, sf_dir):
    return _near_exact(spark, sf_dir, "30 seconds")


@query("sketch_kpi_sliding", sql(
    "complete", f"""SELECT w AS window_start, w + INTERVAL '5 seconds' AS window_end, town, {_KPI}, true AS vehicles_near
      FROM (SELECT *, time_bucket(INTERVAL '1 second', event_ts) - to_seconds(k) AS w FROM timed
        CROSS JOIN (SELECT unnest(range(5)) AS k)) GROUP BY 1, 2, 3""", valid=_VALID, timed=_TIMED))
def sketch_kpi_sliding(spark, sf_dir):
    return _near_exact(spark, sf_dir, "5 seconds", "1 second", 5)


@query("stream_kpi", sql(
    "complete", f"""SELECT time_bucket(INTERVAL '5 seconds', event_ts) AS window_start,
      time_bucket(INTERVAL '5 seconds', event_ts) + INTERVAL '5 seconds' AS window_end, town,
      {_KPI} FROM timed GROUP BY 1, 2, 3
      HAVING window_end <= (SELECT max(event_ts) FROM timed) - INTERVAL '5 seconds'""",
    valid=_VALID, timed=_TIMED))
def stream_kpi(spark, sf_dir):
    """Append mode emits the windows the watermark has passed. The approximate vehicle count is
    left out here because no exact check exists for it."""
    rows = _stream(spark, sf_dir).transform(streams.clean_rows)
    path = streams.run_available(rows.transform(streams.windowed_kpi, lateness="5 seconds"), "kpi")
    return spark.read.parquet(path).drop("vehicles")


@query("stream_kpi_sliding", sql(
    "complete", f"""SELECT w AS window_start, w + INTERVAL '5 seconds' AS window_end, town, {_KPI}
      FROM (SELECT *, time_bucket(INTERVAL '1 second', event_ts) - to_seconds(k) AS w FROM timed
        CROSS JOIN (SELECT unnest(range(5)) AS k)) GROUP BY 1, 2, 3
      HAVING window_end <= (SELECT max(event_ts) FROM timed) - INTERVAL '5 seconds'""",
    valid=_VALID, timed=_TIMED))
def stream_kpi_sliding(spark, sf_dir):
    """As ``stream_kpi`` with windows that start every second."""
    rows = _stream(spark, sf_dir).transform(streams.clean_rows)
    path = streams.run_available(rows.transform(streams.windowed_kpi, "5 seconds", "1 second",
                                                lateness="5 seconds"), "kpi-sliding")
    return spark.read.parquet(path).drop("vehicles")


@query("stream_kpi_all", ORACLES["windowed_kpi"])
def stream_kpi_all(spark, sf_dir):
    """Every window of the stream, the last ones included, with exact vehicles."""
    rows = _stream(spark, sf_dir).transform(streams.clean_rows)
    return batches.complete_kpi(spark, batches.run_windows(rows, "kpi-all"))


@query("stream_kpi_sliding_all", ORACLES["windowed_kpi_sliding"])
def stream_kpi_sliding_all(spark, sf_dir):
    rows = _stream(spark, sf_dir).transform(streams.clean_rows)
    target = batches.run_windows(rows, "kpi-sliding-all", length="1 second", lateness="65 seconds")
    return batches.complete_kpi(spark, target, "1 second", 5)


@query("stream_score_fitted", sql("complete", """SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_off,
    CAST(0 AS BIGINT) AS n_without_reason FROM valid""", valid=_VALID))
def stream_score_fitted(spark, sf_dir):
    """The stream scored by the fitted forest, with reasons, holds the rows of the batch twin."""
    model = fitted(spark, sf_dir, FOREST)

    def probability(df):
        return scored_by(df.transform(ml.usable), model)

    kept = [*KEY, "speed", "prediction", "predicted_label", C.steady("severity", 6).alias("severity"),
            F.concat_ws(" | ", "reasons").alias("reasons")]
    target = batches.run_batches(
        streams.score_rows(_stream(spark, sf_dir).transform(streams.clean_rows), probability).select(*kept), "scored-stream")
    twin = streams.score_rows(worked_out(plain(observations(spark, sf_dir))).transform(streams.clean_rows), probability).select(*kept)
    schema = ", ".join(f"{n} {t}" for n, t in twin.dtypes)
    stored = batches.read_batches(spark, target, schema).drop("batch")
    both = stored.withColumn("side", F.lit(1)).unionByName(twin.withColumn("side", F.lit(-1)))
    per = both.groupBy(*stored.columns).agg(F.count_if(F.col("side") == 1).alias("n"), F.sum("side").alias("more"))
    return per.agg(F.sum("n").alias("n_rows"), F.sum(F.abs("more")).alias("n_off"),
                   F.sum(F.when(F.col("reasons") == "", F.col("n")).otherwise(0)).alias("n_without_reason"))


_A = "least(speed, 100e0) / 100e0"


@query("stream_score", sql(
    "complete",
    f"""SELECT {KEYS}, row_n, CAST(CASE WHEN p0 >= p1 AND p0 >= p2 THEN 0 WHEN p1 >= p2 THEN 1
          ELSE 2 END AS INT) AS prediction, round(round(50e0 * p1 + 100e0 * p2, 9), 6) AS severity
        FROM p""",
    valid=_VALID,
    p=f"""SELECT {KEYS}, count(*) AS row_n, {_A} * {_A} AS p0,
        2e0 * {_A} * (1e0 - {_A}) AS p1, (1e0 - {_A}) * (1e0 - {_A}) AS p2
      FROM valid GROUP BY {KEYS}, speed"""))
def stream_score(spark, sf_dir):
    """Scores by the fixed speed rule; copies of a key with equal speed are counted."""
    def rule(df):
        a = F.least("speed", F.lit(100.0)) / 100.0
        return df.withColumn("probability", F.array(
            a * a, 2.0 * a * (1.0 - a), (1.0 - a) * (1.0 - a)))

    rows = _stream(spark, sf_dir, timed=False).transform(streams.clean_rows)
    scored = rows.transform(streams.score_rows, rule).select(*KEY, "speed", "prediction", "severity")
    path = streams.run_available(scored, "score")
    return (spark.read.parquet(path).groupBy(*KEY, "speed", "prediction", "severity")
            .agg(F.count(F.lit(1)).alias("row_n"))
            .select(*KEY, "row_n", "prediction", C.steady("severity", 6).alias("severity")))
