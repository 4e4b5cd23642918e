import inspect
import pickle

import numpy as np
import pandas as pd
import pytest
from pyspark import RDD
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from kerbside.operators import attribution, boosting, evaluate, features, leaf_bits, ml, score, split
from kerbside.plans import jobs
from kerbside.schema import FEATURES, KEY, MODEL_FEATURES, SPLIT_COLUMNS
from kerbside.sources import readers, sinks


def scored_frame(spark, rows):
    return spark.createDataFrame(
        [("m", label, int(np.argmax(p)), [float(v) for v in p]) for label, p in rows],
        "model string, label int, prediction int, probability array<double>")


@pytest.fixture(scope="module")
def random_scores(spark):
    rng = np.random.default_rng(11)
    rows = []
    for _ in range(400):
        label = int(rng.integers(0, 3))
        p = np.round(rng.dirichlet(np.ones(3) + 2 * np.eye(3)[label]), 2)
        rows.append((label, p))
    return scored_frame(spark, rows)


def test_metrics_agree_with_spark_evaluators(random_scores):
    got = evaluate.metrics(random_scores).first()
    doubles = random_scores.withColumns({"label": F.col("label").cast("double"),
                                         "prediction": F.col("prediction").cast("double")})
    for ours, theirs in [("accuracy", "accuracy"), ("precision", "weightedPrecision"),
                         ("recall", "weightedRecall"), ("f1", "f1")]:
        want = MulticlassClassificationEvaluator(metricName=theirs).evaluate(doubles)
        assert got[ours] == pytest.approx(want, abs=1e-6)


def test_auc_agrees_with_spark_evaluator(random_scores):
    aucs = {r["class"]: r.auc for r in evaluate.class_auc(random_scores).collect()}
    for c in range(3):
        one = random_scores.select(
            (F.col("label") == c).cast("double").alias("label"),
            F.element_at("probability", c + 1).alias("rawPrediction"))
        want = BinaryClassificationEvaluator(numBins=0).evaluate(one)
        assert aucs[c] == pytest.approx(want, abs=1e-9)


@pytest.mark.parametrize("scores, auc", [
    ([0.5, 0.5, 0.5, 0.5], 0.5), ([0.9, 0.8, 0.2, 0.1], 1.0), ([0.1, 0.2, 0.8, 0.9], 0.0)])
def test_auc_extremes(spark, scores, auc):
    df = scored_frame(spark, [(int(i > 1) * 1, (s, 1 - s, 0.0)) for i, s in enumerate(scores)])
    assert evaluate.class_auc(df).where("class = 0").first().auc == auc


def test_roc_curve_runs_from_origin_to_one(random_scores):
    curve = evaluate.roc_curve(random_scores).where("class = 1").toPandas().sort_values(["fpr", "tpr"])
    assert tuple(curve.iloc[0][["fpr", "tpr"]]) == (0.0, 0.0)
    assert tuple(curve.iloc[-1][["fpr", "tpr"]]) == (1.0, 1.0)
    area = np.trapezoid(curve.tpr, curve.fpr)
    want = evaluate.class_auc(random_scores).where("class = 1").first().auc
    assert area == pytest.approx(want, abs=1e-5)


def test_unpredicted_class_scores_zero(spark):
    df = scored_frame(spark, [(0, (0.9, 0.1, 0)), (1, (0.8, 0.2, 0)), (2, (0.7, 0.2, 0.1))])
    report = {r.class_name: r for r in evaluate.class_report(df).collect()}
    assert (report["High"].precision, report["High"].f1) == (0.0, 0.0)
    assert report["weighted avg"].support == 3


def test_best_model_is_marked(spark):
    per_model = spark.createDataFrame(
        [("a", .5, .5, .5, .5, .5), ("b", .6, .5, .4, .5, .5000005)],
        "model string, accuracy double, precision double, recall double, f1 double, roc_auc double")
    best = {(r.model, r.metric) for r in evaluate.comparison(per_model).collect() if r.is_best}
    assert ("a", "accuracy") not in best and ("a", "recall") in best
    assert {("a", "roc_auc"), ("b", "roc_auc"), ("a", "f1"), ("b", "f1")} <= best


@pytest.fixture(scope="module")
def table(spark, sf_dir):
    from kerbside.plans.jobs import training_table
    return training_table(spark, sf_dir).persist()


def test_splits_are_disjoint_complete_and_stratified(spark, sf_dir):
    from kerbside.plans.cleaning import cleaned
    base = features.feature_table(cleaned(spark, sf_dir)).select(*KEY, "label")
    for assign, slack in ((split.add_split, 0.03), (split.add_exact_split, 0.001)):
        out = assign(base).toPandas()
        assert len(out) == base.count() == len(out.drop_duplicates(KEY))
        shares = pd.crosstab(out.label, out.split, normalize="index")
        assert np.allclose(shares[["test", "val", "train"]], [0.15, 0.15, 0.70], atol=slack)
    again = split.add_split(base.repartition(9)).toPandas()
    first = split.add_split(base).toPandas()
    keys = [*KEY, "split"]
    assert set(map(tuple, again[keys].values)) == set(map(tuple, first[keys].values))


def test_class_weights_balance(table):
    weighted = split.add_class_weight(table).groupBy("label").agg(F.sum("weight").alias("w")).collect()
    assert len({round(r.w, 6) for r in weighted}) == 1


def test_models_fit_save_and_score(spark, table, tmp_path):
    train = table.where("split = 'train'")
    forest = ml.fit_forest(train, trees=5, depth=4)
    path = sinks.save_model(forest, str(tmp_path), "Random Forest")
    assert path.endswith("random_forest")
    assert ml.load_model(spark, str(tmp_path), "XGBoost") is None
    loaded = ml.load_model(spark, str(tmp_path), "Random Forest")
    assert isinstance(loaded, PipelineModel)
    out = score.add_score(score.add_probability(table, loaded)).toPandas()
    assert out.severity.between(0, 100).all() and out.prediction.isin([0, 1, 2]).all()
    linear = score.add_score(score.add_probability(table, ml.fit_logistic(train, max_iter=50)))
    accuracy = linear.agg(F.avg((F.col("prediction") == F.col("label")).cast("double"))).first()[0]
    assert accuracy > 0.5


@pytest.fixture(scope="module")
def known(table):
    return (table.where("split <> 'test'").withColumn("is_val", F.col("split") == "val")
            .select(*MODEL_FEATURES, "label", "is_val"))


@pytest.fixture(scope="module")
def boosted(known):
    return boosting.fit_softmax(known, rounds=6, depth=3)


def test_boosted_model_is_saved_and_scores_every_row(spark, table, known, boosted, tmp_path):
    assert boosted.rounds == 6 and boosted.losses == sorted(boosted.losses, reverse=True)
    assert boosted.losses[0] == pytest.approx(np.log(3), abs=1e-6)
    loaded = boosting.load_boosted(spark, boosting.save_boosted(boosted, spark, str(tmp_path / "m")))
    test = table.where("split = 'test'")
    a, b = (boosting.add_boosted_probability(test, m).orderBy(*KEY).toPandas() for m in (boosted, loaded))
    assert len(a) == test.count() and np.allclose([sum(p) for p in a.probability], 1.0)
    assert [list(p) for p in a.probability] == [list(p) for p in b.probability]
    # The loss that training reports is that of the scores.
    val = boosting.add_boosted_probability(known.where("is_val"), boosted).toPandas()
    loss = -np.mean([np.log(p[c]) for p, c in zip(val.probability, val.label)])
    assert loss == pytest.approx(boosted.losses[6], abs=1e-6)


def test_boosting_does_not_depend_on_the_layout_of_the_rows(known, boosted):
    again = boosting.fit_softmax(known.repartition(3), rounds=6, depth=3)
    assert again.node_rows() == boosted.node_rows()


def test_boosting_sends_splits_not_sums_to_the_driver(known, monkeypatch):
    sent = []
    real = RDD.collect
    monkeypatch.setattr(RDD, "collect", lambda rdd: (sent.append(real(rdd)), sent[-1])[1])
    boosting.fit_softmax(known, rounds=2, depth=4)
    assert len(sent) >= 8
    assert max(len(pickle.dumps(s)) for s in sent) < 300 * 3 * 8


def test_boosting_stops_when_validation_no_longer_gains(spark):
    rng = np.random.default_rng(3)
    rows = [(float(rng.normal()), float(rng.normal()), int(rng.integers(0, 3)), bool(i % 4 == 0)) for i in range(600)]
    noise = spark.createDataFrame(rows, "a double, b double, label int, is_val boolean")
    model = boosting.fit_softmax(noise, ["a", "b"], rounds=60, depth=2, rate=0.5, patience=3, min_child=1)
    best = int(np.argmin(model.losses))
    assert model.rounds == best < 57 and len(model.losses) == best + 4


def brute_tree(x, g, h, depth, min_child, penalty, rate):
    """(indices, value) of the leaves of one tree, grown over all thresholds."""
    def grow(rows, level):
        best = (1e-9, None)
        for f in range(x.shape[1]):
            for t in np.unique(x[rows, f])[:-1]:
                left = rows[x[rows, f] <= t]
                right = rows[x[rows, f] > t]
                if h[left].sum() < min_child or h[right].sum() < min_child:
                    continue
                gain = (g[left].sum() ** 2 / (h[left].sum() + penalty) + g[right].sum() ** 2 / (h[right].sum() + penalty)
                        - g[rows].sum() ** 2 / (h[rows].sum() + penalty))
                if gain > best[0] + 1e-9:
                    best = (gain, (left, right))
        if level == depth or best[1] is None:
            return [(rows, -rate * g[rows].sum() / (h[rows].sum() + penalty))]
        return grow(best[1][0], level + 1) + grow(best[1][1], level + 1)
    return grow(np.arange(len(x)), 0)


def test_boosting_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    x = np.stack([rng.integers(0, 9, 200), rng.integers(0, 2, 200), rng.integers(0, 30, 200)], axis=1).astype(float)
    label = (x[:, 0] > 4).astype(int) + ((x[:, 2] > 20) & (rng.random(200) < 0.8))
    df = spark.createDataFrame([(*r, int(c), False) for r, c in zip(x.tolist(), label)],
                               "a double, b double, c double, label int, is_val boolean")
    model = boosting.fit_softmax(df, ["a", "b", "c"], rounds=3, depth=3, rate=0.3, subsample=1.0, feature_share=1.0,
                                 min_child=2.0)
    raw = np.zeros((200, 3))
    for _ in range(3):
        p = boosting.softmax(raw)
        step = np.zeros_like(raw)
        for c in range(3):
            g, h = p[:, c] - (label == c), 2 * p[:, c] * (1 - p[:, c])
            for rows, value in brute_tree(x, g, h, 3, 2.0, 1.0, 0.3):
                step[rows, c] = value
        raw += step
    assert np.allclose(model.trees.raw(x), raw, atol=1e-6)
    assert model.rounds == 3 and model.losses == []


def test_fits_use_a_bounded_sample(spark):
    df = spark.range(20_000).withColumn("v", F.col("id") * 2)
    assert boosting.bounded_sample(df, 20_000).count() == 20_000
    some = boosting.bounded_sample(df, 2_000)
    assert 1_700 < some.count() < 2_300
    assert sorted(some.collect()) == sorted(boosting.bounded_sample(df.repartition(5), 2_000).collect())


def test_rows_for_fits_are_drawn_before_the_deduplication(spark, sf_dir, tmp_path, monkeypatch):
    """With five copies of every row the first two cuts leave too few training rows."""
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    for _ in range(5):
        lines.write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    whole = jobs.training_table(spark, str(tmp_path))
    shares = []
    real = jobs.split_features
    monkeypatch.setattr(jobs, "split_features", lambda *a, share=None: (share and shares.append(share), real(*a, share=share))[1])
    some = jobs.fit_table(spark, str(tmp_path), lines.count() // 4)
    assert shares == pytest.approx([0.15, 0.3, 0.6], abs=1e-3)
    assert sorted(some.collect()) == sorted(whole.where(split.key_below(shares[-1])).collect())
    assert some.where("split = 'train'").count() >= lines.count() // 4
    below = jobs.split_features(spark, str(tmp_path), share=0.1)._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" in below.split("Window")[-1]
    assert jobs.fit_table(spark, sf_dir, 40_000).count() == jobs.training_table(spark, sf_dir).count()


def test_gain_importance_is_a_share(boosted):
    shares = boosting.gain_importance(boosted)
    assert sum(shares) == pytest.approx(1.0) and min(shares) >= 0 and len(shares) == len(MODEL_FEATURES)


def test_attributions_sum_to_prediction_minus_base(spark, table):
    forest = ml.fit_forest(table.where("split = 'train'"), trees=4, depth=5)
    scored = score.add_probability(table.where("split = 'test'"), forest).select(*KEY, "probability", *MODEL_FEATURES)
    out, base = attribution.attribute_ensemble(scored, attribution.forest_nodes(spark, forest.stages[-1]),
                                               [*KEY, "probability"])
    assert base.sum() == pytest.approx(1.0)
    rows = out.toPandas()
    assert len(rows) == scored.count()
    for r in rows.itertuples():
        assert np.allclose(base + [sum(a) for a in r.attribution], r.probability)


def test_attributions_of_the_boosted_model_sum_to_raw_scores(spark, table, boosted):
    test = table.where("split = 'test'").select(*KEY, *MODEL_FEATURES)
    out, base = attribution.attribute_ensemble(test, attribution.boosted_nodes(spark, boosted), [*KEY, *MODEL_FEATURES])
    rows = out.toPandas()
    raw = boosted.trees.raw(rows[MODEL_FEATURES].to_numpy(float))
    assert np.allclose(base + np.array([[sum(a) for a in v] for v in rows.attribution]), raw)


def test_forest_scores_by_bit_sets_equal_the_models_own(spark, table, monkeypatch):
    forest = ml.fit_forest(table.where("split = 'train'"), trees=9, depth=12, min_leaf=1)
    assert isinstance(forest.stages[-1], RandomForestClassificationModel)
    own, got = (scored.orderBy(*KEY).toPandas() for scored in (
        score.add_probability(table, forest), jobs.scored_by(table, forest)))
    assert np.abs(np.stack(own.probability) - np.stack(got.probability)).max() < 1e-12
    plan = jobs.scored_by(table, forest)._jdf.queryExecution().toString()
    assert "ArrowEvalPython" in plan and "VectorAssembler" not in plan


def test_boosted_scores_do_not_walk_the_trees(table, boosted, monkeypatch):
    rows = table.where("split = 'test'").toPandas()
    raw = boosted.trees.raw(rows[MODEL_FEATURES].to_numpy(float))
    trees = boosted.trees
    bits = leaf_bits.heap_bits(trees.feature, trees.threshold, trees.value, len(boosted.features))
    assert np.allclose(bits.raw(rows[MODEL_FEATURES].to_numpy(float)), raw, atol=1e-12)
    sent = []
    real = type(table.sparkSession.sparkContext).broadcast
    monkeypatch.setattr(type(table.sparkSession.sparkContext), "broadcast", lambda sc, v: (sent.append(v), real(sc, v))[1])
    boosting.add_boosted_probability(table, boosted)
    assert [type(v) for v in sent] == [leaf_bits.LeafBits]


def test_bit_sets_of_trees_with_many_leaves():
    """Leaves fill several words, bounds lie on values, one tree is a single leaf."""
    cuts = np.concatenate(([-np.inf], np.arange(150.0), [np.inf]))
    many = {"lo": cuts[:-1, None], "hi": cuts[1:, None], "value": np.arange(151.0)[:, None]}
    one = {"lo": np.array([[-np.inf]]), "hi": np.array([[np.inf]]), "value": np.array([[0.5]])}
    x = np.array([[-3.0], [0.0], [0.1], [63.0], [63.5], [149.0], [1e9]])
    assert leaf_bits.LeafBits([many, one]).raw(x).ravel().tolist() == [0.5, 0.5, 1.5, 63.5, 64.5, 149.5, 150.5]


def test_attribution_in_parts_equals_one_pass(spark, table):
    forest = ml.fit_forest(table.where("split = 'train'"), trees=4, depth=3)
    nodes = attribution.forest_nodes(spark, forest.stages[-1])
    boxes = attribution.leaf_boxes(nodes, len(MODEL_FEATURES), chunk=3)
    assert boxes.agg(F.max("n")).first()[0] == 3
    assert len(list(attribution.box_parts(boxes, 10))) > 1
    rows = table.where("split = 'test'").orderBy(*KEY).limit(20)
    whole, parts = (attribution.attribute_ensemble(rows, nodes, KEY, max_leaves=m)[0]
                    .orderBy(*KEY).toPandas() for m in (1000, 10))
    for a, b in zip(whole.attribution, parts.attribution):
        assert np.allclose([list(v) for v in a], [list(v) for v in b])


def brute_shapley(x, boxes):
    """Sum over all feature subsets, by definition."""
    from itertools import combinations
    from math import factorial
    d = len(x)
    o = ((x > boxes["lo"]) & (x <= boxes["hi"])).astype(float)

    def value(known):
        mask = np.isin(np.arange(d), list(known))
        return (np.where(mask, o, boxes["share"]).prod(1)[:, None] * boxes["value"]).sum(0)

    out = np.zeros((d, boxes["value"].shape[1]))
    for i in range(d):
        others = [j for j in range(d) if j != i]
        for size in range(d):
            for known in combinations(others, size):
                w = factorial(size) * factorial(d - size - 1) / factorial(d)
                out[i] += w * (value({*known, i}) - value(known))
    return out


@pytest.mark.parametrize("direct", [1 << 24, 4])
def test_attributions_equal_the_definition(direct, monkeypatch):
    monkeypatch.setattr(attribution, "DIRECT_CODES", direct)
    rng = np.random.default_rng(7)
    lo, hi, share, value = [], [], [], []
    for _ in range(12):  # random boxes over five features, some unused
        used = rng.random(5) < 0.6
        a = np.where(used, rng.normal(-1, 1, 5), -np.inf)
        lo.append(a), hi.append(np.where(used, a + 2, np.inf))
        share.append(np.where(used, rng.uniform(0.05, 0.9, 5), 1.0)), value.append(rng.random(2))
    boxes = {k: np.array(v) for k, v in zip(("lo", "hi", "share", "value"), (lo, hi, share, value))}
    x = rng.normal(0, 1, (30, 5))
    x[0], x[1] = np.where(np.isfinite(boxes["lo"][0]), boxes["lo"][0], 0), boxes["hi"][0].clip(-9, 9)  # on the edges
    got = attribution.shapley(x, [{k: v[i:i + 5] for k, v in boxes.items()} for i in (0, 5, 10)])
    for row, values in zip(x, got):
        assert np.allclose(values, brute_shapley(row, boxes))


def test_weights_are_worked_out_once_per_leaf_and_mask(monkeypatch):
    rng = np.random.default_rng(2)
    asked = []
    real = attribution.mask_weights
    monkeypatch.setattr(attribution, "mask_weights", lambda z, o: (asked.append(len(z)), real(z, o))[1])
    boxes = {"lo": np.array([[0.0, -np.inf], [-np.inf, 0.5]]), "hi": np.array([[1.0, np.inf], [2.0, 0.9]]),
             "share": np.array([[0.5, 1.0], [0.4, 0.3]]), "value": np.ones((2, 1))}
    attribution.shapley(rng.random((3000, 2)) * 4 - 1, [boxes])
    assert asked == [2 + 4]


@pytest.mark.parametrize("cells, axes", [(1, 0), (30, 1), (90, 2), (1 << 19, 3)])
def test_attributions_by_grids_equal_the_definition(cells, axes, monkeypatch):
    """Groups of rows alike in the other features take no path per row, whatever the axes."""
    monkeypatch.setattr(attribution, "MAX_CELLS", cells)
    rng = np.random.default_rng(5)
    part = []
    for n in (7, 9):
        used = rng.random((n, 5)) < 0.7
        a, b = rng.integers(0, 4, (n, 5)) / 2.0, rng.integers(4, 8, (n, 5)) / 2.0
        part.append({"lo": np.where(used & (rng.random((n, 5)) < 0.7), a, -np.inf), "hi": np.where(used, b, np.inf),
                     "share": np.where(used, rng.uniform(0.05, 0.9, (n, 5)), 1.0), "value": rng.random((n, 3))})
    x = np.repeat(rng.integers(0, 9, (40, 5)) / 2.0, 3, axis=0)  # on the bounds as well
    whole = {k: np.concatenate([b[k] for b in part]) for k in ("lo", "hi", "share", "value")}
    table = attribution.GridTable(part)
    assert len(table.axes) == axes
    monkeypatch.setattr(attribution, "shapley", None)
    got = attribution.grouped_shapley(x, part, table, least=1)
    for row, values in zip(x, got):
        assert np.allclose(values, brute_shapley(row, whole))


def test_top_attributions(spark):
    df = spark.createDataFrame([(1, 2, [[0.0, 0.0]] * 2 + [[0.05, -0.3]], 7.0, 8.0)],
                               "id int, prediction int, attribution array<array<double>>, a double, b double")
    rows = attribution.top_attributions(df, ["id"], ["a", "b"], explained=1).orderBy("rank").collect()
    assert [(r.feature, r.value) for r in rows] == [("b", -0.3), ("a", 0.05)]
    assert rows[0].explanation == "b = 8.00: strongly pushed away from High (-0.3000)"
    assert rows[1].explanation is None


def test_stored_splits_round_trip(spark, table, tmp_path):
    base = str(tmp_path / "splits")
    sinks.write_splits(table.select(*SPLIT_COLUMNS, "split"), base, files=2)
    assert readers.read_feature_list(spark, f"{base}/_feature_cols.txt") == FEATURES
    assert readers.model_features(spark, f"{base}/_feature_cols.txt") == MODEL_FEATURES
    test = readers.read_split(spark, base, "test", MODEL_FEATURES)
    assert test.count() == table.where("split = 'test'").count()
    assert set(dict(test.dtypes).values()) == {"double", "int"}
    assert readers.read_split(spark, base, "other", MODEL_FEATURES) is None


def test_towns_without_a_number_are_trained_on_and_scored(spark, make_obs):
    rows = make_obs({"town": "Town01"}, {"town": "Town10HD", "speed": 3.0}, {"town": "Town12", "speed": 80.0})
    table = ml.usable(features.add_features(rows))
    assert {(r.town, r.town_code) for r in table.collect()} == {("Town01", 1), ("Town10HD", -1), ("Town12", 12)}


def test_shuffled_is_a_fixed_order_unlike_the_key(spark, make_obs):
    rows = make_obs(*[{"vehicle_id": i} for i in range(200)])
    first = [r.vehicle_id for r in split.shuffled(rows).collect()]
    assert first == [r.vehicle_id for r in split.shuffled(rows.repartition(7)).collect()]
    assert sorted(first) == list(range(200)) and first != sorted(first)


def test_bands_are_even_wherever_the_values_lie(spark):
    """A million distinct values in one octave, most of them in a tiny part of it."""
    from kerbside.operators.prefix import ranged, running_totals
    near = F.when(F.col("id") % 10 == 0, F.lit(0.5) + F.col("id") / 2.1e6).otherwise(F.lit(0.75) + F.col("id") / 1e12)
    values = spark.range(1_000_000).select(F.lit("g").alias("g"), near.alias("value"), F.lit(1).alias("n"))
    sizes = [r["count"] for r in ranged(values, ["g"], "value").groupBy("_band").count().collect()]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(sizes) == 1_000_000 and max(sizes) < 1.5 * 1_000_000 / min(parts, len(sizes))
    got = running_totals(values.limit(2_000), ["g"], "value", ["n"]).orderBy("value").collect()
    assert [r.n_before for r in got] == list(range(len(got))) and {r.n_total for r in got} == {len(got)}


def test_registered_fits_have_the_default_sizes():
    given = inspect.signature(jobs.fitted).parameters
    for fit, names in ((ml.fit_forest, ["trees", "depth"]), (boosting.fit_softmax, ["rounds"])):
        default = inspect.signature(fit).parameters
        assert [given[n].default for n in names] == [default[n].default for n in names]


def test_the_slope_of_a_fitted_logistic_model_is_zero(table):
    train = table.where("split = 'train'")
    assert ml.logistic_slope(train, ml.fit_logistic(train)) < 1e-4
    assert ml.logistic_slope(train, ml.fit_logistic(train, max_iter=1)) > 1e-3


def test_shown_digits_are_those_of_the_stored_double(spark):
    """0.81265 is stored a little below that tie, 0.00035 above its own; 0.03125 is a tie: to even."""
    values = [0.81265, 0.76235, 0.00035, 0.03125, 1.0]
    df = spark.createDataFrame([("m", *values)], "model string, accuracy double, precision double, recall double, "
                               "f1 double, roc_auc double")
    got = {r.value: r.shown for r in evaluate.comparison(df).collect()}
    assert got == {v: f"{v:.4f}" for v in values}
