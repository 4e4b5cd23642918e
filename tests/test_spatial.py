import math
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from kerbside.operators import crowds, snapshot, spatial, tiles
from kerbside.schema import ACTOR_SCHEMA


def near_count(points, radius=50.0):
    return {a[:3]: sum(1 for b in points if a[:2] == b[:2] and a[2] != b[2]
                       and math.sqrt((a[3] - b[3]) ** 2 + (a[4] - b[4]) ** 2) <= radius)
            for a in points}


def density(spark, points):
    df = spark.createDataFrame(points, "session_id string, tick int, vehicle_id int, x double, y double")
    return {(r.session_id, r.tick, r.vehicle_id): r.traffic_density
            for r in spatial.proximity_density(df).collect()}


def test_proximity_boundaries(spark):
    points = [("s", 1, 1, 0.0, 0.0), ("s", 1, 2, 50.0, 0.0), ("s", 1, 3, 1000.0, 0.0),
              ("s", 1, 4, 1050.001, 0.0), ("s", 1, 5, -1001.0, -1001.0),
              ("s", 1, 6, -999.0, -999.0), ("s", 2, 7, 0.0, 0.0), ("s", 1, 8, 5000.0, 5000.0)]
    got = density(spark, points)
    assert [got["s", t, v] for t, v in [(1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (1, 6), (2, 7),
                                        (1, 8)]] == [1, 1, 0, 0, 1, 1, 0, 0]


def test_proximity_equals_brute_force_with_a_crowded_cell(spark):
    rng = random.Random(8)
    points = [("s", rng.randrange(2), v, rng.uniform(-200, 200), rng.uniform(-200, 200))
              for v in range(150)]
    points += [("s", 0, 1000 + v, 10.0 + rng.choice([0.0, 1.0, 30.0, 45.0]), 10.0)
               for v in range(120)]
    assert density(spark, points) == near_count(points)


def test_one_spot_with_very_many_vehicles_makes_no_pairs(spark):
    df = spark.range(30000).selectExpr("'s' AS session_id", "1 AS tick", "cast(id as int) AS vehicle_id",
                                       "if(id < 29990, 0.0D, id - 29980.0D) AS x", "0.0D AS y")
    got = {r.traffic_density: r["count"] for r in
           spatial.proximity_density(df).groupBy("traffic_density").count().collect()}
    assert got == {29999: 30000}


@pytest.mark.parametrize("limit, levels", [(crowds.PAIR_LIMIT, crowds.LEVELS), (4, 2)])
def test_crowded_cells_equal_brute_force(spark, monkeypatch, limit, levels):
    """Crowds beside sparse cells, copies of a spot, positions on cell edges and at the radius."""
    monkeypatch.setattr(crowds.crowded_counts, "__defaults__", (levels, limit))
    rng = random.Random(5)
    points = [("s", t, v, rng.uniform(-160, 160), rng.uniform(-160, 160)) for t in (0, 1) for v in range(60)]
    points += [("s", 0, 100 + v, rng.uniform(-20, 70), rng.uniform(-20, 20)) for v in range(700)]
    points += [("s", 0, 1000 + v, rng.choice([0.0, 25.0, 50.0, -50.0, 12.5]), rng.choice([0.0, 30.0, 40.0, -50.0]))
               for v in range(150)]
    df = spark.createDataFrame(points, "session_id string, tick int, vehicle_id int, x double, y double")
    got = {(r.session_id, r.tick, r.vehicle_id): r.traffic_density
           for r in spatial.proximity_density(df, crowd=40).collect()}
    assert got == near_count(points)


def test_a_crowd_of_twenty_thousand_positions_makes_few_pairs(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x, y = rng.uniform(0, 50, 20_000), rng.uniform(0, 50, 20_000)
    paired = []
    real = crowds.meetings

    def meetings(*args):
        found = real(*args)
        paired.append(found.where("_state = 'pair'").agg(F.sum(F.col("_am") * F.col("_bm"))).first()[0])
        return found

    monkeypatch.setattr(crowds, "meetings", meetings)
    df = spark.createDataFrame([("s", 1, i, float(a), float(b)) for i, (a, b) in enumerate(zip(x, y))],
                               "session_id string, tick int, vehicle_id int, x double, y double")
    got = {r.vehicle_id: r.traffic_density for r in spatial.proximity_density(df).collect()}
    for start in range(0, 20_000, 2_000):
        part = slice(start, start + 2_000)
        dx, dy = x[part, None] - x, y[part, None] - y
        want = (np.sqrt(dx * dx + dy * dy) <= 50).sum(axis=1) - 1
        assert [got[i] for i in range(start, start + 2_000)] == want.tolist()
    assert paired[0] < 20_000 * 19_999 / 2 / 10


def test_vehicles_without_a_position_have_no_neighbours(spark):
    assert density(spark, [("s", 1, 1, None, 0.0), ("s", 1, 2, 0.0, 0.0)]) == {
        ("s", 1, 1): 0, ("s", 1, 2): 0}


def test_proximity_plan_has_no_cross_join(spark):
    df = spark.createDataFrame([("s", 1, 1, 0.0, 0.0)],
                               "session_id string, tick int, vehicle_id int, x double, y double")
    plan = spatial.proximity_density(df)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "BroadcastHash" not in plan


def test_grid_counts_every_row_and_closes_the_last_bin(spark):
    df = spark.createDataFrame([(0.0, 0.0, 1.0), (10.0, 10.0, 3.0), (9.9, 9.9, 5.0)],
                               "x double, y double, v double")
    got = {(r.ix, r.iy): (r.n_rows, r.mean_value)
           for r in spatial.grid(df, 10, None, "v").collect()}
    assert got == {(0, 0): (1, 1.0), (9, 9): (2, 4.0)}


def test_smoothing_keeps_mass_and_matches_a_dense_filter(spark):
    bins, rng = 9, np.random.default_rng(2)
    dense = np.where(rng.random((bins, bins)) < 0.2, rng.integers(1, 50, (bins, bins)), 0).astype(float)
    cells = [("t", int(i), int(j), float(dense[i, j])) for i, j in zip(*dense.nonzero())]
    got = np.zeros_like(dense)
    df = spark.createDataFrame(cells, "town string, ix int, iy int, n_rows double")
    for r in spatial.smooth_grid(df, ["town"], bins).collect():
        got[r.ix, r.iy] = r.smoothed
    weights = spatial.smoothing_weights(1.5)
    r = len(weights) // 2
    want = dense
    for axis in (0, 1):
        padded = np.pad(want, [(r, r) if a == axis else (0, 0) for a in (0, 1)], mode="symmetric")
        want = np.apply_along_axis(lambda v: np.convolve(v, weights, "valid"), axis, padded)
    assert np.allclose(got, want, atol=1e-5)
    assert got.sum() == pytest.approx(dense.sum(), abs=1e-3)


def test_hexagons_hold_every_point(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(rng.random(), rng.random()) for _ in range(300)], "x double, y double")
    cells = spatial.hexbin(df, "x", "y", 8).collect()
    assert sum(c.n_rows for c in cells) == 300 and {c.lattice for c in cells} == {0, 1}


def test_hotspots_order_and_support(make_obs):
    df = make_obs({"x": 1.0, "congestion_label": "High"}, {"x": -5.0, "congestion_label": "High"},
                  {"x": -6.0, "congestion_label": "High"}, {"x": 50.0, "congestion_label": "Low"})
    got = spatial.hotspots(df, top=2).collect()
    assert [(r.x_bin, r.records, r.pct_high) for r in got] == [(-20, 2, 100.0), (0, 1, 100.0)]
    assert [r.x_bin for r in spatial.hotspots(df, min_records=2).collect()] == [-20]


def test_observations_from_actor_states(spark):
    def actor(tick, vehicle, wheels=4, x=0.0, vx=10.0):
        return ("s", tick, vehicle, wheels, x, 0.0, 0.0, 12.345, vx, 0.0, 0.0, 3.0, 4.0, 0.0)
    df = spark.createDataFrame([
        actor(95, 1), actor(100, 1), actor(101, 1), actor(105, 1), actor(105, 2, x=20.0),
        actor(105, 3, wheels=2), actor(105, 4, x=None)], ACTOR_SCHEMA)
    got = {(r.tick, r.vehicle_id): (r.speed, r.acceleration, r.traffic_density, r.congestion_label)
           for r in snapshot.observe(df).collect()}
    assert got == {(0, 1): (36.0, 5.0, 0, "Low"), (1, 1): (36.0, 5.0, 1, "Low"),
                   (1, 2): (36.0, 5.0, 1, "Low")}


def test_unknown_weather(spark):
    df = spark.createDataFrame([("WetNoon",), ("Fog",)], "preset string")
    got = {r.preset: (r.weather, r.applied_weather) for r in snapshot.encode_weather(df).collect()}
    assert got == {"WetNoon": (2, "WetNoon"), "Fog": (-1, "ClearNoon")}


@pytest.mark.parametrize("shift", [0.0, 1e7])
def test_counts_within_equal_brute_force(shift):
    """Random positions, a lattice whose points lie exactly at the radius, and a far one."""
    rng = np.random.default_rng(9)
    x = np.concatenate((rng.uniform(0, 150, 1_500), rng.integers(0, 15, 400) * 10.0, [9e4])) + shift
    y = np.concatenate((rng.uniform(-90, 90, 1_500), rng.integers(0, 15, 400) * 10.0, [9e4])) - shift
    n = rng.integers(1, 5, len(x))
    for size in (len(x), 1_900, 300, 1):
        got = tiles.counts_within(x, y, x[:size], y[:size], n[:size], 50.0)
        dx, dy = x[:, None] - x[:size], y[:, None] - y[:size]
        assert got.tolist() == ((np.sqrt(dx * dx + dy * dy) <= 50) * n[:size]).sum(axis=1).tolist()


def test_crowded_cells_make_no_rows_per_pair(spark, monkeypatch):
    """Sparse, crowded and huge cells side by side; the crowded ones are not taken apart."""
    rng = random.Random(3)
    points = [("s", 0, v, rng.uniform(-160, 160), rng.uniform(-160, 160)) for v in range(300)]
    points += [("s", 0, 1000 + v, rng.uniform(-60, 40), rng.uniform(-20, 20)) for v in range(700)]
    df = spark.createDataFrame(points, "session_id string, tick int, vehicle_id int, x double, y double")
    for huge in (150, 16_384):
        got = {(r.session_id, r.tick, r.vehicle_id): r.traffic_density
               for r in spatial.proximity_density(df, crowd=20, huge=huge).collect()}
        assert got == near_count(points)
    monkeypatch.setattr(crowds, "meetings", None)
    assert spatial.proximity_density(df, crowd=20).count() == 1000
