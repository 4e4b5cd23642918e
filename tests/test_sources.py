import pandas as pd
import pytest
from pyspark.sql import functions as F

from kerbside.schema import OBS_COLUMNS, OBS_SCHEMA
from kerbside.sources import readers, scratch, sinks


@pytest.fixture
def files(make_obs):
    return make_obs({"session_id": "a"}, {"session_id": "a", "speed": None}).toPandas()


def test_csv_twin_is_skipped(spark, files, tmp_path):
    files.to_parquet(tmp_path / "one.parquet")
    files.to_csv(tmp_path / "one.csv", index=False)
    files.assign(session_id="b").to_csv(tmp_path / "two.csv", index=False)
    (tmp_path / "broken.parquet").write_bytes(b"not a parquet file")
    got = readers.read_mixed(spark, str(tmp_path))
    assert got.columns == [*OBS_COLUMNS, "source_file"]
    counts = {r.source_file: r["count"] for r in got.groupBy("source_file").count().collect()}
    assert counts == {"one.parquet": 2, "two.csv": 2}
    assert got.where("speed IS NULL").count() == 2


def test_each_csv_is_read_by_its_own_header(spark, files, tmp_path):
    one, two = files.assign(speed=1.0, acceleration=2.0), files.assign(speed=3.0, acceleration=4.0)
    one.to_csv(tmp_path / "one.csv", index=False)
    two[two.columns[::-1]].to_csv(tmp_path / "two.csv", index=False)
    got = readers.read_mixed(spark, str(tmp_path)).select("speed", "acceleration").distinct().collect()
    assert sorted(map(tuple, got)) == [(1.0, 2.0), (3.0, 4.0)]


def test_csv_stays_when_its_parquet_twin_is_broken(spark, files, tmp_path):
    (tmp_path / "a.parquet").write_bytes(b"broken")
    files.to_csv(tmp_path / "a.csv", index=False)
    files.to_parquet(tmp_path / "b.parquet")
    files.to_csv(tmp_path / "b.csv", index=False)
    got = readers.read_mixed(spark, str(tmp_path)).groupBy("source_file").count().collect()
    assert {tuple(r) for r in got} == {("a.csv", 2), ("b.parquet", 2)}
    report = {tuple(r) for r in readers.scan_report(spark, str(tmp_path)).collect()}
    assert report == {("a.parquet", "unreadable"), ("a.csv", "loaded"), ("b.parquet", "loaded"), ("b.csv", "twin")}



@pytest.mark.parametrize("wide", [False, True])
def test_part_files_with_different_columns_are_read_whole(spark, files, tmp_path, wide):
    folder = tmp_path / "log.parquet"
    folder.mkdir()
    tall = files.assign(tick=files.tick.astype("int64")) if wide else files  # types that don't merge
    files.drop(columns=["yaw"]).assign(speed=1.0).to_parquet(folder / "part-0.parquet")
    tall.drop(columns=["hour"]).assign(speed=2.0, yaw=5.0).to_parquet(folder / "part-1.parquet")
    files.assign(speed=3.0, yaw=6.0).to_parquet(folder / "part-2.parquet")
    got = readers.read_mixed(spark, str(tmp_path))
    assert [tuple(r) for r in got.select("source_file", "speed", "yaw", "hour", "tick").distinct().orderBy("speed").collect()] == [
        ("log.parquet", 1.0, None, 12, 1), ("log.parquet", 2.0, 5.0, None, 1), ("log.parquet", 3.0, 6.0, 12, 1)]
    assert got.count() == 6


def test_recursive_scan(spark, files, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    files.to_csv(tmp_path / "top.csv", index=False)
    files.to_parquet(tmp_path / "deep" / "er" / "low.parquet")
    flat = readers.read_mixed(spark, str(tmp_path))
    assert {r.source_file for r in flat.collect()} == {"top.csv"}
    deep = readers.read_mixed(spark, str(tmp_path), recursive=True)
    assert {r.source_file for r in deep.collect()} == {"top.csv", "deep/er/low.parquet"}


def test_nothing_to_load(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.read_mixed(spark, str(tmp_path))
    empty = readers.read_observations(spark, str(tmp_path))
    assert empty.schema == OBS_SCHEMA and empty.count() == 0
    assert readers.read_feature_list(spark, str(tmp_path / "none.txt")) == []
    assert readers.read_comparison(spark, str(tmp_path / "none.csv")).count() == 0


def test_wide_integers_are_cast(spark, files, tmp_path):
    files.astype({"tick": "int64", "vehicle_id": "int64"}).to_parquet(tmp_path / "one.parquet")
    assert readers.read_observations(spark, str(tmp_path)).schema == OBS_SCHEMA


def test_blank_lines_in_the_feature_list(spark, tmp_path):
    (tmp_path / "f.txt").write_text("speed\n\n  hour \ntraffic_density\n")
    assert readers.read_feature_list(spark, str(tmp_path / "f.txt")) == [
        "speed", "hour", "traffic_density"]
    assert readers.model_features(spark, str(tmp_path / "f.txt")) == ["speed", "hour"]


def test_appends_add_rows_and_prune_by_session(spark, make_obs, tmp_path):
    path = str(tmp_path / "log.parquet")
    for session in ("a", "b", "a"):
        sinks.append_parquet(make_obs({"session_id": session}, {"session_id": session}), path)
    stored = spark.read.parquet(path)
    assert stored.count() == 6
    only = stored.where("session_id = 'a'")
    assert only.count() == 4
    assert "PartitionFilters: [isnotnull(session_id" in only._jdf.queryExecution().executedPlan().toString()


def test_scratch_uses_the_named_folder(spark):
    assert scratch.scratch_path(spark, "t").startswith(spark.conf.get("spark.checkpoint.dir"))
    again = scratch.written(spark.range(5), "t")
    assert again.count() == 5


def test_comparison_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("m", 0.1234567, 1.0, 0.0, 0.5, 0.9)],
                               "model string, accuracy double, precision double, recall double, f1 double, roc_auc double")
    sinks.write_comparison(df, str(tmp_path / "c.csv"))
    assert readers.read_comparison(spark, str(tmp_path / "c.csv")).first().accuracy == 0.123457


def test_scratch_follows_the_cluster_or_the_warehouse():
    class Session:
        def __init__(self, **settings):
            self.conf = {k.replace("_", "."): v for k, v in settings.items()}

    named = Session(spark_checkpoint_dir="hdfs:///shared", spark_sql_warehouse_dir="file:/w/")
    unnamed = Session(spark_sql_warehouse_dir="file:/w/")
    assert scratch.scratch_root(named) == "hdfs:///shared"
    assert scratch.scratch_root(unnamed) == "file:/w/_kerbside"
    cluster = Session(spark_master="spark://host:7077", spark_sql_warehouse_dir="file:/w/")
    with pytest.raises(ValueError):
        scratch.scratch_root(cluster)


def test_split_files_follow_the_bytes_and_cluster_sessions(spark, sf_dir, tmp_path):
    """A few files whatever the tasks; each holds a range of sessions of its own."""
    from kerbside.plans.jobs import training_table
    from kerbside.schema import SPLIT_COLUMNS
    table = training_table(spark, sf_dir).select(*SPLIT_COLUMNS, "split").repartition(16)
    few, ranges = str(tmp_path / "few"), str(tmp_path / "ranges")
    sinks.write_splits(table, few)
    stored = spark.read.parquet(few)
    assert stored.count() == table.count()
    assert stored.select(F.input_file_name()).distinct().count() <= 4
    sinks.write_splits(table, ranges, files=6)
    per_file = (spark.read.parquet(ranges).groupBy("split", F.input_file_name().alias("f"))
                .agg(F.min("session_id").alias("lo"), F.max("session_id").alias("hi")).orderBy("split", "lo").collect())
    assert len(per_file) > 3
    assert all(a.hi <= b.lo for a, b in zip(per_file, per_file[1:]) if a.split == b.split)
    plan = spark.read.parquet(ranges).where("session_id = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(session_id,x)" in plan


def test_twins_can_be_kept_and_folders_below_read(spark, files, tmp_path):
    (tmp_path / "deep").mkdir()
    files.to_parquet(tmp_path / "deep" / "one.parquet")
    files.to_csv(tmp_path / "deep" / "one.csv", index=False)
    def counts(**options):
        return {r.source_file: r["count"] for r in
                readers.read_mixed(spark, str(tmp_path), **options).groupBy("source_file").count().collect()}
    assert counts(recursive=True) == {"deep/one.parquet": 2}
    assert counts(recursive=True, keep_twins=True) == {"deep/one.parquet": 2, "deep/one.csv": 2}


def test_bad_records_are_listed_per_file(spark, files, tmp_path):
    header = ",".join(OBS_COLUMNS)
    good = files.iloc[0].map(str).reindex(OBS_COLUMNS)
    odd = good.copy()
    odd["speed"], odd["tick"] = "fast", str(1 << 40)
    (tmp_path / "log.csv").write_text("\n".join([header, ",".join(good), "cut,1", ",".join(odd), ",".join(good) + ",more"]))
    wide = files.assign(tick=[1 << 40, 7])
    wide.to_parquet(tmp_path / "wide.parquet")
    (tmp_path / "broken.parquet").write_bytes(b"not a parquet file")
    got = {(r.source_file, r.reason, r.column_name): (r.n_records, r.example)
           for r in readers.bad_records(spark, str(tmp_path)).collect()}
    assert got.pop(("log.csv", "malformed", None))[0] == 2
    assert got == {("log.csv", "not_cast", "speed"): (1, "fast"), ("log.csv", "not_cast", "tick"): (1, str(1 << 40)),
                   ("wide.parquet", "not_cast", "tick"): (1, str(1 << 40)),
                   ("broken.parquet", "unreadable", None): (None, None)}
    assert readers.read_mixed(spark, str(tmp_path)).count() == 6


def test_tables_of_a_cleared_block_are_deleted(spark, make_obs):
    kept = scratch.scratch_path(spark, "kept")
    with scratch.cleared(spark):
        inner = scratch.written(make_obs({}), "inner")
        folder = inner.inputFiles()[0].rsplit("/", 1)[0]
        inner.write.parquet(kept)
    assert not readers.path_exists(spark, folder) and spark.read.parquet(kept).count() == 1
    assert scratch.written(make_obs({}), "after").count() == 1


def test_parquet_logs_with_the_same_columns_are_one_scan(spark, make_obs, tmp_path):
    for i in range(30):
        make_obs({"tick": i}).coalesce(1).write.parquet(str(tmp_path / f"log{i}.parquet"))
    make_obs({"tick": 99}).drop("z").coalesce(1).write.parquet(str(tmp_path / "narrow.parquet"))
    got = readers.read_mixed(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2
    rows = {r.source_file: (r.tick, r.z) for r in got.collect()}
    assert len(rows) == 31 and rows["log7.parquet"] == (7, 0.0) and rows["narrow.parquet"] == (99, None)
