import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from kerbside.operators import distributions as D, prefix


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows, one value repeats, one outlier is far away."""
    rng = np.random.default_rng(3)
    frame = pd.DataFrame({
        "g": ["hot"] * 3000 + ["cold"] * 40 + ["one"],
        "v": np.concatenate([np.round(rng.normal(20, 5, 1500), 3), np.full(1499, 7.5), [1e7],
                             np.round(rng.normal(-3, 1, 40), 3), [2.0]])})
    return frame, spark.createDataFrame(frame).repartition(5)


def test_running_totals_equal_a_plain_window(skewed):
    frame, df = skewed
    counts = prefix.value_counts(df, ["g"], "v")
    got = prefix.running_totals(counts, ["g"], "value", ["n"]).toPandas()
    want = frame.groupby(["g", "v"]).size().rename("n").reset_index().sort_values(["g", "v"])
    want["before"] = want.groupby("g")["n"].cumsum() - want["n"]
    merged = got.merge(want, left_on=["g", "value"], right_on=["g", "v"])
    assert len(merged) == len(want) == len(got)
    assert (merged.n_before == merged.before).all()
    assert (merged.n_total == merged.g.map(frame.g.value_counts())).all()


def test_percentiles_are_exact(skewed):
    frame, df = skewed
    got = {r.g: r for r in D.box_stats(df, ["g"], "v").collect()}
    for g, part in frame.groupby("g"):
        q1, med, q3 = np.percentile(part.v, [25, 50, 75])
        fence = 1.5 * (q3 - q1)
        inside = part.v[(part.v >= q1 - fence) & (part.v <= q3 + fence)]
        assert (got[g].q1, got[g].median, got[g].q3) == pytest.approx((q1, med, q3), abs=1e-6)
        assert got[g].whisker_hi == pytest.approx(inside.max(), abs=1e-6)
        assert got[g].n_outliers == len(part) - len(inside)


def test_ecdf_of_one_row_starts_at_zero(skewed):
    _, df = skewed
    rows = D.ecdf(df, ["g"], "v").where("g = 'one'").collect()
    assert [(r.value, r.cumulative) for r in rows] == [(2.0, 0.0)]
    assert D.ecdf(df, ["g"], "v").where("g = 'hot'").agg(F.max("cumulative")).first()[0] == 1.0


def test_histogram_matches_numpy(skewed):
    frame, df = skewed
    cold = frame[frame.g == "cold"].v
    counts, edges = np.histogram(cold, bins=7)
    got = D.histogram(df, "v", 7, ["g"]).where("g = 'cold'").orderBy("bin").collect()
    assert [r.n_rows for r in got] == list(counts)
    assert [r.bin_lo for r in got] == pytest.approx(list(edges[:-1]), abs=1e-5)
    width = edges[1] - edges[0]
    assert sum(r.density for r in got) * width == pytest.approx(1.0, abs=1e-4)


def test_histogram_of_one_value_and_of_nothing(spark, skewed):
    _, df = skewed
    single = D.histogram(df.where("g = 'one'"), "v", 4).orderBy("bin").collect()
    assert [(r.bin_lo, r.n_rows) for r in single] == [(1.5, 0), (1.75, 0), (2.0, 1), (2.25, 0)]
    assert D.histogram(df.where("false"), "v", 4).count() == 0


def test_density_matches_direct_sum(spark):
    values = np.array([1.0, 2.0, 2.0, 4.0, 9.0])
    df = spark.createDataFrame([("a", float(v)) for v in values], "g string, v double")
    got = D.kernel_density(df, "g", "v", 0, 10, 11, 0.5, ["a", "b"]).orderBy("point").collect()
    h = 0.5 * values.std(ddof=1)
    grid = np.linspace(0, 10, 11)
    want = np.exp(-0.5 * ((grid[:, None] - values) / h) ** 2).sum(1) / (5 * h * np.sqrt(2 * np.pi))
    assert [r.density for r in got] == pytest.approx(list(want), abs=1e-6)


@pytest.mark.parametrize("factor", [0.02, 0.3, 2.0])
def test_density_of_very_many_values_matches_direct_sum(spark, factor):
    rng = np.random.default_rng(12)
    values = np.concatenate([rng.gamma(2.0, 3.0, 20_000), rng.normal(25, 0.3, 5_000), [0.0, 40.0]]).clip(0, 40)
    df = spark.createDataFrame(pd.DataFrame({"g": "a", "v": values}))
    got = D.kernel_density(df, "g", "v", 0, 40, 200, factor, ["a"]).orderBy("point").collect()
    h = factor * values.std(ddof=1)
    grid = np.linspace(0, 40, 200)
    want = [np.exp(-0.5 * ((t - values) / h) ** 2).sum() / (len(values) * h * np.sqrt(2 * np.pi)) for t in grid]
    assert [r.density for r in got] == pytest.approx(want, abs=1.5e-6)


def test_densities_bear_sums_that_differ_in_their_last_digits(spark):
    """Sums run in another order each time they are worked out again on a cluster: one row per point."""
    @F.udf("double")
    def shaken(v):
        return v + 1e-12 * random.random()

    rows = spark.range(500).select(F.lit("a").alias("g"), shaken.asNondeterministic()(F.col("id") / 7.0).alias("v"))
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = D.kernel_density(rows, "g", "v", 0, 100, 50, 0.2, ["a"]).collect()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert sorted(r.point for r in got) == list(range(50))
    assert all(r.density > 0 for r in got if r["at"] < 70)


def test_correlations_use_pairwise_present_rows(spark):
    rng = np.random.default_rng(1)
    frame = pd.DataFrame(rng.normal(1000, 1, (200, 3)), columns=["a", "b", "c"])
    frame.loc[::7, "a"] = np.nan
    frame.loc[::5, "c"] = np.nan
    frame["k"] = 4.0
    want = frame.corr()
    got = D.correlations(spark.createDataFrame(frame), ["a", "b", "c", "k"]).collect()
    assert len(got) == 16
    for r in got:
        if r.a == "k" or r.b == "k":
            assert r.r is None
        else:
            assert r.r == pytest.approx(want.loc[r.a, r.b], abs=1e-6)


def test_pivot_fills_and_stacks(make_obs):
    df = make_obs({"town": "A", "weather_name": "w1"}, {"town": "A", "weather_name": "w2"},
                  {"town": "A", "weather_name": "w2"}, {"town": "B", "weather_name": "w2"})
    got = {(r.town, r.weather_name): (r.n_rows, r.stack_start)
           for r in D.pivot_counts(df, "town", "weather_name").collect()}
    assert got == {("A", "w1"): (1, 0), ("A", "w2"): (2, 1), ("B", "w1"): (0, 0),
                   ("B", "w2"): (1, 0)}


def test_sample_is_bounded_and_repeatable(make_obs):
    df = make_obs(*[{"x": float(i)} for i in range(50)])
    first = sorted(r.vehicle_id for r in D.sample_bounded(df, 10).collect())
    again = sorted(r.vehicle_id for r in D.sample_bounded(df.repartition(7), 10).collect())
    assert len(first) == 10 and first == again
    assert D.sample_bounded(df, 500).count() == 50
    assert first != sorted(r.vehicle_id for r in D.sample_bounded(df, 10, seed=1).collect())


def test_severity_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0, 24, 25, 60, 75, 100, 101)], "v int")
    got = D.edge_histogram(df, F.col("v"), [0, 25, 40, 60, 75, 100]).orderBy("bin").collect()
    assert [r.n_rows for r in got] == [2, 1, 0, 1, 2]


def test_share_matrix_has_zero_cells(spark, make_obs):
    rows = make_obs({"town": "Town05", "weather_name": "ClearNoon", "congestion_label": "High"},
                    {"town": "Town10HD", "weather_name": "Duststorm"})
    got = {(r.town, r.weather_name): (r.n_rows, r.pct_high)
           for r in D.high_shares(rows, "town", "weather_name").collect()}
    assert got == {("Town05", "ClearNoon"): (1, 100.0), ("Town05", "Duststorm"): (0, 0.0),
                   ("Town10HD", "ClearNoon"): (0, 0.0), ("Town10HD", "Duststorm"): (1, 0.0)}


def test_groups_outside_the_known_names_stay(spark, make_obs):
    rows = make_obs(*[{"town": t, "weather_name": w, "z": float(i), "acceleration": float(i % 7)}
                      for t, w in [("Town10HD", "Duststorm"), ("Town05", "ClearNoon")] for i in range(120)])
    assert {r.town for r in D.histogram(rows, "z", 40, ["town"]).collect()} == {"Town10HD", "Town05"}
    density = D.kernel_density(rows, "weather_name", "acceleration", 0, 8, 20, 0.25, None, 101)
    assert {r.weather_name for r in density.collect()} == {"Duststorm", "ClearNoon"}
