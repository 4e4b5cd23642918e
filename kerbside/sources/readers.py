"""Readers for observations, splits, feature lists and comparison tables."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from kerbside.operators.features import drop_leakage, project_features
from kerbside.schema import COMPARISON_SCHEMA, LEAKAGE, OBS_SCHEMA


def path_exists(spark: SparkSession, path: str) -> bool:
    """True when a path or glob matches something, on any file system Spark can reach."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(target)
    return found is not None and len(found) > 0


def _conform(df: DataFrame, schema: StructType, extra: list[str] | None = None) -> DataFrame:
    """Select and cast to the schema; a column the files lack becomes null."""
    return df.select(*[
        (F.col(f.name).try_cast(f.dataType) if f.name in df.columns
         else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema], *(extra or []))


def read_observations(spark: SparkSession, directory: str) -> DataFrame:
    """All observation Parquet files of a directory; an empty typed frame when there is none.

    Files may carry 64-bit integers; they are cast, and the casts do not block pruning.
    """
    pattern = f"{directory.rstrip('/')}/*.parquet"
    if not path_exists(spark, pattern):
        return spark.createDataFrame([], OBS_SCHEMA)
    return _conform(spark.read.option("mergeSchema", "true").parquet(pattern), OBS_SCHEMA)


def _entry(path: str, directory: str) -> Column:
    """Path below ``directory`` of the ``*.parquet`` or ``*.csv`` file or folder a file belongs to."""
    folder = directory.rstrip("/").rsplit("/", 1)[-1]
    return F.regexp_extract(F.col(path), "/" + re.escape(folder) + r"/(.*?[.](?:parquet|csv))(?:/|$)", 1)


def _columns(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """Column names that an entry states itself; None if it can't be read."""
    try:
        if path.endswith(".parquet"):
            return tuple(spark.read.parquet(path).columns)
        return tuple(spark.read.option("header", "true").csv(path).columns) or None
    except (PySparkException, Py4JJavaError):
        return None


def _part_files(spark: SparkSession, path: str) -> list[DataFrame]:
    """All part files of a Parquet entry with the columns of each; a frame per file where
    columns have types that don't merge."""
    try:
        return [spark.read.option("mergeSchema", "true").parquet(path)]
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
    return [spark.read.option("basePath", path).parquet(unquote(p))
            for p in sorted(spark.read.parquet(path).inputFiles())]


def _parquet_entries(spark: SparkSession, paths: list[str]) -> list[DataFrame]:
    """Entries with the same column names in one read; one by one where their types differ."""
    try:
        return [spark.read.option("mergeSchema", "true").parquet(*paths)]
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
    return [df for p in paths for df in _part_files(spark, p)]


def _scan(spark: SparkSession, directory: str, recursive: bool) -> list[tuple[str, str, tuple | None]]:
    """(entry, status, columns) of the entries of a directory, in order of their names.

    Only names are listed; of each entry one footer or header line is read. A CSV entry is a
    "twin" if a Parquet entry of the same stem can be read.
    """
    base = directory.rstrip("/")
    names = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
             .select(_entry("path", base).alias("entry")).where("entry <> ''").distinct())
    entries = sorted(r.entry for r in names.collect() if recursive or "/" not in r.entry)
    columns = {e: _columns(spark, f"{base}/{e}") for e in entries}
    loaded = {e.removesuffix(".parquet") for e in entries if e.endswith(".parquet") and columns[e]}
    return [(e, "unreadable" if columns[e] is None
             else "twin" if e.endswith(".csv") and e.removesuffix(".csv") in loaded else "loaded",
             columns[e]) for e in entries]


def scan_report(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """``source_file, status``: loaded, twin (a Parquet entry stands in) or unreadable."""
    rows = [(entry, status) for entry, status, _ in _scan(spark, directory, recursive)]
    return spark.createDataFrame(rows, "source_file string, status string")


def _frames(spark: SparkSession, directory: str, recursive: bool, keep_twins: bool) -> list[DataFrame]:
    """Rows as the entries have them, with ``source_file``: text of CSV entries, those with the
    same columns together and lines that don't fit in ``_corrupt``; Parquet entries likewise."""
    base = directory.rstrip("/")
    source = _entry("_metadata.file_path", base).alias("source_file")
    taken = {"loaded", "twin"} if keep_twins else {"loaded"}
    alike: dict[tuple, list[str]] = {}
    for entry, status, columns in _scan(spark, directory, recursive):
        if status in taken:
            alike.setdefault((entry.endswith(".csv"), columns), []).append(f"{base}/{entry}")
    if not alike:
        raise FileNotFoundError(f"no Parquet or CSV files in {directory}")
    frames = []
    for (is_csv, columns), paths in alike.items():
        if is_csv:
            text = StructType([StructField(c, StringType()) for c in (*columns, "_corrupt")])
            frames.append(spark.read.schema(text).option("header", "true").option("enforceSchema", "false")
                          .option("columnNameOfCorruptRecord", "_corrupt").csv(paths).select("*", source))
        else:
            frames += [df.select("*", source) for df in _parquet_entries(spark, paths)]
    return frames


def read_mixed(spark: SparkSession, directory: str, recursive: bool = False,
               keep_twins: bool = False) -> DataFrame:
    """Parquet and CSV files together, with ``source_file``.

    An entry is a file or a folder of part files named ``*.parquet`` or ``*.csv``; with
    ``recursive`` also in folders below. A CSV entry is skipped when a Parquet entry with the
    same stem can be read, unless ``keep_twins``. Each entry is read by its own columns, those
    with the same ones together; a part file whose header differs from its entry's is an error,
    not a swap. Lines with too few or too many values keep what fits, values that are no number
    become null: ``bad_records`` counts both. Entries that can't be read are left out and listed
    by ``scan_report``; no readable entry at all is an error.
    """
    frames = _frames(spark, directory, recursive, keep_twins)
    return reduce(DataFrame.unionByName, [_conform(df, OBS_SCHEMA, ["source_file"]) for df in frames])


def bad_records(spark: SparkSession, directory: str, recursive: bool = False,
                keep_twins: bool = False) -> DataFrame:
    """``source_file, reason, column_name, n_records, example`` of what ``read_mixed`` could not
    take as it is: ``malformed`` lines (too few or too many values), ``not_cast`` values that don't
    fit their column's type, and entries that are ``unreadable`` (without a count)."""
    def problems(df: DataFrame) -> DataFrame:
        def one(wrong: Column, reason: str, column: Column, value: Column) -> Column:
            return F.when(wrong, F.struct(F.lit(reason).alias("reason"), column.alias("column_name"),
                                          value.cast("string").alias("value")))

        found = [one(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull(), "not_cast",
                     F.lit(f.name), F.col(f.name)) for f in OBS_SCHEMA if f.name in df.columns]
        if "_corrupt" in df.columns:
            found.append(one(F.col("_corrupt").isNotNull(), "malformed", F.lit(None).cast("string"), F.col("_corrupt")))
        return (df.select("source_file", F.explode(F.filter(F.array(*found), lambda p: p.isNotNull())).alias("p"))
                .select("source_file", "p.*"))

    lines = reduce(DataFrame.unionByName, map(problems, _frames(spark, directory, recursive, keep_twins)))
    counted = lines.groupBy("source_file", "reason", "column_name").agg(
        F.count(F.lit(1)).alias("n_records"), F.min("value").alias("example"))
    missing = scan_report(spark, directory, recursive).where("status = 'unreadable'").select(
        "source_file", F.lit("unreadable").alias("reason"), F.lit(None).cast("string").alias("column_name"),
        F.lit(None).cast("long").alias("n_records"), F.lit(None).cast("string").alias("example"))
    return counted.unionByName(missing)


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    """Feature names, one per line in file order, blank lines dropped.

    The list is a handful of names, so collecting it is bounded by the schema width.
    """
    if not path_exists(spark, path):
        return []
    lines = spark.read.text(path, wholetext=True).where(F.length("value") > 0)
    rows = lines.select(F.explode(F.filter(
        F.transform(F.split("value", r"\r?\n"), lambda s: F.trim(s)), lambda s: s != "")).alias("f"))
    return [r.f for r in rows.collect()]


def read_split(spark: SparkSession, directory: str, name: str,
               features: list[str]) -> DataFrame | None:
    """One processed split as doubles plus integer label; None when it does not exist."""
    path = f"{directory.rstrip('/')}/split={name}"
    if not path_exists(spark, path):
        return None
    return spark.read.parquet(path).transform(project_features, features)


def model_features(spark: SparkSession, path: str) -> list[str]:
    """The stored feature list without the leaking features."""
    return [f for f in read_feature_list(spark, path) if f not in LEAKAGE]


def read_comparison(spark: SparkSession, path: str) -> DataFrame:
    """Model comparison table, empty when it was never written."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], COMPARISON_SCHEMA)
    return spark.read.schema(COMPARISON_SCHEMA).option("header", "true").csv(path)
