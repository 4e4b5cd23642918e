from kerbside.operators import cleaning as O


def ids(df):
    return sorted(r.vehicle_id for r in df.collect())


def test_incomplete_rows_include_nan(make_obs):
    df = make_obs({}, {"speed": None}, {"speed": float("nan")}, {"town": None}, {"z": None})
    assert ids(O.drop_incomplete(df)) == [0, 4]


def test_range_bounds_are_inclusive(make_obs):
    df = make_obs({"acceleration": -0.1}, {"acceleration": 50.0}, {"acceleration": 50.1},
                  {"speed": 200.0}, {"speed": 200.1}, {"traffic_density": -1},
                  {"congestion_label": "high"}, {"congestion_label": "High"})
    assert ids(O.clean(df)) == [1, 3, 7]


def test_first_copy_wins_before_the_range_filter(make_obs):
    copies = make_obs({"vehicle_id": 7, "acceleration": 60.0, "x": 1.0},
                      {"vehicle_id": 7, "acceleration": 1.0, "x": 2.0})
    assert ids(O.clean(copies, ["x"])) == []
    kept = O.clean(copies, ["acceleration"]).collect()
    assert [(r.vehicle_id, r.acceleration) for r in kept] == [(7, 1.0)]


def test_report_counts_in_cleaning_order(make_obs):
    df = make_obs({}, {"speed": None}, {"speed": None},
                  {"vehicle_id": 50, "acceleration": 60.0, "x": 1.0}, {"vehicle_id": 50, "x": 2.0},
                  {"speed": 250.0, "traffic_density": -1}, {"traffic_density": -1},
                  {"congestion_label": "?"})
    report = {r.reason: r.n_rows for r in O.drop_report(df, ["x"]).collect()}
    assert report == {"null_critical_cols": 2, "duplicates": 1, "bad_acceleration": 1,
                      "bad_speed": 1, "bad_density": 1, "bad_label": 1, "total_dropped": 7,
                      "remaining": 1}
    assert O.clean(df, ["x"]).count() == report["remaining"]


def test_report_of_an_empty_table(make_obs):
    report = O.drop_report(make_obs(), ["x"]).collect()
    assert len(report) == 8 and all(r.n_rows == 0 and r.pct_of_input is None for r in report)


def test_one_key_with_very_many_copies(spark, make_obs):
    """Copies are cut to one per map task before the shuffle."""
    df = make_obs({"vehicle_id": 1}).drop("x").crossJoin(
        spark.range(20000, numPartitions=8).selectExpr("cast(id as double) as x"))
    kept = O.deduplicate(df, ["x"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert [r.x for r in kept.collect()] == [0.0]
