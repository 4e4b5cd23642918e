import pytest

from kerbside.operators import dashboard, quality


def test_missing_counts_null_and_nan(make_obs):
    df = make_obs({"speed": None}, {"speed": float("nan")}, {"town": None}, {})
    got = {r.column_name: (r.n_missing, r.pct) for r in quality.missing_values(df).collect()}
    assert got == {"speed": (2, 50.0), "town": (1, 25.0)}


def test_schema_lists_missing_and_extra(make_obs):
    df = make_obs({}).drop("z").selectExpr("*", "1 AS lane", "'f' AS source_file")
    got = {r.column_name: r.status for r in quality.check_schema(df).collect()}
    assert got["z"] == "missing" and got["lane"] == "extra" and got["speed"] == "present"
    assert "source_file" not in got


def test_infinite_and_ranges(make_obs):
    df = make_obs({"speed": float("inf")}, {"x": float("-inf")}, {"speed": -1.0}, {"hour": 24})
    assert quality.infinite_values(df).first().n_infinite == 2
    got = {r.column_name: (r.n_out_of_range, r.status) for r in quality.value_ranges(df).collect()}
    assert got["speed"] == (2, "WARN") and got["hour"] == (1, "WARN")
    assert got["acceleration"] == (0, "OK")


def test_duplicates_on_the_keys_that_exist(make_obs):
    df = make_obs({"vehicle_id": 1}, {"vehicle_id": 1}, {"vehicle_id": 2})
    assert quality.duplicate_keys(df).first().n_duplicates == 1
    assert quality.duplicate_keys(df.drop("vehicle_id")).first().n_duplicates == 2


def test_label_distribution_fills_absent_labels(make_obs):
    df = make_obs({"congestion_label": "Low"}, {"congestion_label": "Low"},
                  {"congestion_label": None}, {"congestion_label": "Odd"})
    got = {r.label_name: (r.n_rows, r.pct) for r in quality.label_distribution(df).collect()}
    assert got == {"Low": (2, 50.0), "Medium": (0, 0.0), "High": (0, 0.0)}


def test_verdict_passes_clean_data_and_names_each_failure(make_obs):
    good = make_obs(*[{"traffic_density": i, "speed": 60.0 - i, "congestion_label": label}
                      for i, label in enumerate(["Low", "Medium", "High"] * 4)])
    limits = dict(min_total=5, min_rows=5)
    assert [r.verdict for r in quality.verdict(good, **limits).collect()] == ["PASS"]
    bad = make_obs({"speed": 250.0, "traffic_density": 9, "z": None}, {"speed": 1.0},
                   {"speed": 1.0, "traffic_density": 1})
    assert {r.rule for r in quality.verdict(bad, **limits).collect()} == {
        "too_few_rows", "null_values", "speed_above_limit", "short_sessions",
        "positive_speed_density_correlation"}


@pytest.mark.parametrize("check", [
    quality.volume, quality.duplicate_keys, quality.value_ranges, quality.missing_values,
    quality.label_distribution, quality.spatial_coverage, quality.speed_density_correlation,
    quality.infinite_values, quality.verdict, dashboard.kpi, dashboard.session_summary])
def test_empty_table_divides_by_nothing(make_obs, check):
    check(make_obs()).collect()


def test_filters(make_obs):
    df = make_obs({"town": "Town02"}, {"weather_name": "WetNoon"}, {})
    assert dashboard.filtered(df).count() == 3
    assert dashboard.filtered(df, "Town01", "ClearNoon").count() == 1
    choices = [(r.dimension, r.choice) for r in dashboard.filter_choices(df).collect()]
    assert choices[0] == ("town", "All") and ("weather", "WetNoon") in choices


def test_verdict_reads_its_rows_once(spark, make_obs):
    read = spark.sparkContext.accumulator(0)
    rows = make_obs(*[{"tick": i} for i in range(30)])

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    quality.verdict(rows.mapInPandas(counted, rows.schema)).collect()
    assert read.value == 30
