import datetime

import pytest
from pyspark.sql import functions as F

from kerbside.functions import columns as C
from kerbside.schema import REASONS


def values(spark, data, expression, ddl):
    df = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,)))
                                for i, v in enumerate(data)], f"i int, {ddl}")
    return [r.out for r in df.select("i", expression.alias("out")).orderBy("i").collect()]


def test_bins(spark):
    assert values(spark, [0.0, 4.999, 5.0, 19.999, 20.0, 49.999, 50.0, None], C.speed_bin("v"),
                  "v double") == [0, 0, 1, 1, 2, 2, 3, 3]
    assert values(spark, [2, 3, 7, 8, 14, 15], C.density_bin("v"), "v int") == [0, 1, 1, 2, 2, 3]


def test_right_closed_bins_leave_zero_out(spark):
    assert values(spark, [0.0, 5.0, 5.001, 200.0, 200.1], C.speed_interval("v"), "v double") == [
        None, "<5", "5-20", "50+", None]
    assert values(spark, [0, 6, 7, 12, 18, 23, 25], C.hour_bucket("v"), "v int") == [
        "Night", "Night", "Morning", "Morning", "Afternoon", "Evening", None]


def test_town_code_is_null_without_digits(spark):
    assert values(spark, ["Town01", "Town10HD", "Town12", ""], C.town_code("v"), "v string") == [
        1, None, 12, None]


def test_flags(spark):
    assert values(spark, [6, 7, 9, 10, 16, 17, 19, 20], C.is_rush_hour("v"), "v int") == [
        0, 1, 1, 0, 0, 1, 1, 0]
    assert values(spark, [-1, 1, 2, 6, 7, 8, 9, 13, 14, 15, 16, 20], C.is_rainy("v"), "v int") == [
        0, 0, 1, 1, 0, 0, 1, 1, 0, 0, 1, 1]


def test_label_rule(spark):
    pairs = [(10, 19.999), (10, 20.0), (9, 0.0), (4, 49.999), (4, 50.0), (3, 0.0)]
    assert values(spark, pairs, C.congestion_label("d", "s"), "d int, s double") == [
        "High", "Medium", "Medium", "Medium", "Low", "Low"]


def test_clip_and_angles_and_cells(spark):
    assert values(spark, [None, -1.0, 5.0, 11.0], C.clip("v", 0.0, 10.0), "v double") == [
        None, 0.0, 5.0, 10.0]
    assert values(spark, [-5.0, 0.0, 19.9, 20.0], C.grid_origin("v", 20), "v double") == [
        -20, 0, 0, 20]
    assert values(spark, [-90.0, 0.0, 359.0], C.degrees_0_360("v"), "v double") == [
        270.0, 0.0, 359.0]


@pytest.mark.parametrize("p, score, band", [
    ([1.0, 0.0, 0.0], 0.0, "Free flow"), ([0.0, 1.0, 0.0], 50.0, "Moderate"),
    ([0.0, 0.0, 1.0], 100.0, "Gridlock"), ([0.602, 0.398, 0.0], 19.9, "Free flow"),
    ([0.6, 0.4, 0.0], 20.0, "Light"), ([0.0, 0.4, 0.6], 80.0, "Gridlock")])
def test_severity(spark, p, score, band):
    df = spark.createDataFrame([(p,)], "p array<double>").select(C.severity("p").alias("s"))
    row = df.select("s", C.severity_band(F.round("s", 6)).alias("b")).first()
    assert row.s == pytest.approx(score) and row.b == band


def test_reasons(spark):
    df = spark.createDataFrame([(30.0, 0, 0, 0, 0), (0.5, 1, 1, 1, 1), (60.0, 0, 0, 0, 0)],
                               "speed double, a int, b int, c int, d int")
    got = [r[0] for r in df.select(C.signal_reasons("speed", "a", "b", "c", "d")).collect()]
    assert got[0] == [REASONS["none"]]
    assert got[1] == [REASONS["stationary"], REASONS["slow"].format(speed=0), REASONS["braking"],
                      REASONS["rush_hour"], REASONS["rainy"]]
    assert got[2] == [REASONS["fast"]]


def test_sessions(spark):
    df = spark.createDataFrame([("20240203_040506_Town10HD_WetNoon", 6), ("odd", 1)],
                               "session_id string, tick int")
    rows = df.select(C.session_town_token().alias("t"), C.session_town().alias("n"),
                     C.event_time().alias("e")).collect()
    assert (rows[0].t, rows[0].n) == ("Town10HD", None)
    assert rows[0].e == datetime.datetime(2024, 2, 3, 4, 5, 7, 500000)
    assert (rows[1].t, rows[1].e) == (None, None)


def test_band_is_monotone(spark):
    numbers = sorted([-1e9, -3.5, -3.4999, -1e-12, 0.0, 1e-12, 0.1, 0.2, 1.0, 199.999, 200.0, 1e9])
    bands = values(spark, numbers, C.value_band("v"), "v double")
    assert bands == sorted(bands) and bands[4] == 0
