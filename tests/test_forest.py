import numpy as np
import pytest
from pyspark.sql import functions as F

from kerbside.operators import attribution, boosting, forest, leaf_bits, ml
from kerbside.plans import jobs
from kerbside.schema import MODEL_FEATURES


def frame(spark, x, label):
    names = [f"f{i}" for i in range(x.shape[1])]
    rows = [(i, *map(float, r), int(c)) for i, (r, c) in enumerate(zip(x, label))]
    return spark.createDataFrame(rows, ", ".join(["id long", *[f"{n} double" for n in names], "label int"])), names


@pytest.fixture(scope="module")
def two(spark):
    """Two features, of which a node may choose both: the tree is decided by the rows alone."""
    rng = np.random.default_rng(4)
    x = np.stack([rng.integers(0, 12, 900), rng.integers(0, 5, 900)], axis=1)
    label = np.where(rng.random(900) < 0.7, (x[:, 0] > 6).astype(int) + ((x[:, 1] > 2) & (x[:, 0] > 3)), rng.integers(0, 3, 900))
    return x, label, *frame(spark, x, label)


def brute(x, label, weights, depth, min_leaf):
    """(row numbers, class shares) of the leaves, Spark's pruning included."""
    def stats(rows):
        return np.bincount(label[rows], minlength=3) * weights

    def impure(s):
        return s.sum() - (s ** 2).sum() / s.sum()

    def grown(rows, level):
        best = (1e-12, None)
        for f in range(x.shape[1]) if level < depth else ():
            for t in np.unique(x[rows, f])[:-1]:
                a, b = rows[x[rows, f] <= t], rows[x[rows, f] > t]
                gain = (impure(stats(rows)) - impure(stats(a)) - impure(stats(b))) / stats(rows).sum()
                if min(len(a), len(b)) >= min_leaf and gain > best[0] + 1e-12:
                    best = (gain, (a, b))
        if best[1] is None:
            return [(rows, stats(rows) / stats(rows).sum())]
        a, b = (grown(side, level + 1) for side in best[1])
        if len(a) == len(b) == 1 and a[0][1].argmax() == b[0][1].argmax():
            return [(rows, stats(rows) / stats(rows).sum())]
        return a + b

    return grown(np.arange(len(x)), 0)


def probabilities(spark, df, model, names):
    got = leaf_bits.add_forest_probability(df, model.stages[-1], names).orderBy("id").toPandas()
    return np.stack(got.probability)


@pytest.mark.parametrize("most", [1 << 22, 100])
def test_a_tree_equals_brute_force(spark, two, monkeypatch, most):
    """Grown in one task, or with its large nodes level by level over the blocks."""
    monkeypatch.setattr(forest, "MAX_ROWS", most)
    x, label, df, names = two
    weights = len(x) / (3 * np.bincount(label))
    model = ml.fit_forest(df, names, trees=1, depth=6, min_leaf=10)
    want = np.zeros((len(x), 3))
    for rows, shares in brute(x, label, weights, 6, 10):
        want[rows] = shares
    assert np.allclose(probabilities(spark, df, model, names), want, atol=1e-9)


def test_a_fit_does_not_depend_on_layout_waves_or_tasks(spark, two, monkeypatch):
    x, label, df, names = two
    whole = ml.fit_forest(df, names, trees=7, depth=8, min_leaf=3)
    want = probabilities(spark, df, whole, names)
    monkeypatch.setattr(forest, "WAVE_ROWS", 2_000)
    monkeypatch.setattr(forest, "BLOCK_ROWS", 50)
    monkeypatch.setattr(forest, "NODES_AT_ONCE", 3)
    parts = ml.fit_forest(df.repartition(5), names, trees=7, depth=8, min_leaf=3)
    assert np.array_equal(probabilities(spark, df, parts, names), want)
    monkeypatch.setattr(forest, "MAX_ROWS", 200)
    heads = ml.fit_forest(df, names, trees=7, depth=8, min_leaf=3)
    assert np.allclose(probabilities(spark, df, heads, names), want, atol=1e-12)
    assert heads.stages[-1].totalNumNodes == whole.stages[-1].totalNumNodes
    assert np.allclose(heads.stages[-1].featureImportances.toArray(), whole.stages[-1].featureImportances.toArray())


def test_trees_take_part_of_the_rows_and_of_the_features(spark, two):
    x, label, df, names = two
    model = ml.fit_forest(df, names, trees=40, depth=2, min_leaf=1).stages[-1]
    nodes = attribution.forest_nodes(spark, model)
    roots = [sum(v) for (v,) in nodes.where("id = 0").select(F.transform("value", lambda v: v * F.col("cover"))).collect()]
    assert len(set(roots)) > 20 and model.getNumTrees == 40
    plan = forest.Plan(1, 1, 1, 42, 2, 11, np.ones(3), np.ones(3))
    picked = plan.picked(4_000, 3)
    assert picked.shape == (4_000, 4) and (np.diff(picked, axis=1) > 0).all()
    assert np.allclose(np.bincount(picked.ravel()) / 16_000, 1 / 11, atol=0.01)
    many = forest.Plan(2, 1, 1, 42, 2, 11, np.ones(3), np.ones(3))
    drawn = many.draws(np.random.default_rng(1).integers(0, 1 << 63, 100_000).astype(np.uint64), 1)
    assert np.allclose(np.bincount(drawn)[:4] / 1e5, np.exp(-1) / np.array([1, 1, 2, 6]), atol=0.01)


def test_every_row_is_fitted(spark):
    """Beyond 40,000 rows fits took a sample."""
    df = spark.range(60_000).selectExpr("id", "id % 100 / 10 AS f0", "id % 7 * 1.0 AS f1", "CAST(id % 3 AS INT) AS label")
    root = ml.fit_forest(df, ["f0", "f1"], trees=1, depth=2).stages[-1]
    nodes = attribution.forest_nodes(spark, root).where("id = 0").first()
    assert nodes.cover == pytest.approx(60_000)
    boosted = boosting.fit_softmax(df.withColumn("is_val", F.lit(False)), ["f0", "f1"], rounds=1, depth=2, subsample=1.0)
    assert np.allclose(boosted.cover[0, :, 0], 60_000 * 4 / 9, rtol=1e-6)


def test_registered_fits_read_the_whole_training_split(spark, tmp_path, monkeypatch):
    lines = spark.range(200_000).selectExpr(
        "id + 1 AS l_orderkey", "CAST(id % 7 + 1 AS INT) AS l_linenumber", "id AS l_partkey", "id % 50 AS l_suppkey",
        "CAST(id % 50 + 1 AS DOUBLE) AS l_quantity", "CAST(id % 90000 AS DOUBLE) AS l_extendedprice",
        "id % 11 / 100 AS l_discount", "id % 9 / 100 AS l_tax", "date_add(DATE '1995-01-01', CAST(id % 900 AS INT)) AS l_shipdate")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    seen = {}
    monkeypatch.setattr(jobs.ml, "fit_forest", lambda df, **_: seen.update(forest=df.count()))
    monkeypatch.setattr(jobs.boosting, "fit_softmax", lambda df, **_: seen.update(boosted=df.count(), val=df.where("is_val").count()))
    for name in (jobs.FOREST, jobs.BOOSTED):
        jobs.fitted(spark, str(tmp_path), name)
    sizes = {r.split: r["count"] for r in jobs.training_table(spark, str(tmp_path)).groupBy("split").count().collect()}
    assert sizes["train"] > 100_000
    assert seen == {"forest": sizes["train"], "boosted": sizes["train"] + sizes["val"], "val": sizes["val"]}


def test_thresholds_come_from_all_rows(spark):
    """One row in 50,000 has a value of its own; Spark's own fit looks at some 10,000 rows."""
    df = spark.range(50_000).selectExpr("IF(id = 31337, 2.0, id % 2 * 1.0) AS a", "id * 1.0 AS b")
    few, many = forest.value_edges(df, ["a", "b"], 64)
    assert few.tolist() == [0.5, 1.5] and 50 < len(many) <= 63


def test_odd_rows(spark):
    """A class that is missing, one row that no tree may draw, a feature without a value, no rows."""
    df, names = frame(spark, np.array([[1.0, 2.0]]), [2])
    model = ml.fit_forest(df, names, trees=5, depth=3)
    assert probabilities(spark, df, model, names).tolist() == [[0.0, 0.0, 1.0]]
    with pytest.raises(ValueError):
        ml.fit_forest(df.limit(0), names, trees=2, depth=2)
    with pytest.raises(Exception, match="without a value"):
        ml.fit_forest(df.withColumn("f1", F.lit(None).cast("double")), names, trees=2, depth=2)


def test_walks_follow_a_loaded_forest_of_any_order(spark, two):
    """Spark saves the nodes of its own fits depth first."""
    from pyspark.ml.classification import RandomForestClassifier
    x, label, df, names = two
    own = RandomForestClassifier(numTrees=5, maxDepth=7, seed=3).fit(ml.assembler(names).transform(df))
    want = np.stack([r.probability.toArray() for r in own.transform(ml.assembler(names).transform(df)).orderBy("id").collect()])
    got = leaf_bits.add_forest_probability(df, own, names).orderBy("id").toPandas().probability
    assert np.abs(np.stack(got) - want).max() < 1e-12
    left = np.array([1, 2, -1, -1, 5, -1, -1])
    order, below = leaf_bits.in_levels(left, np.array([4, 3, -1, -1, 6, -1, -1]))
    assert order.tolist() == [0, 1, 4, 2, 3, 5, 6] and below.tolist() == [1, 3, 5, 3, 4, 5, 6]
