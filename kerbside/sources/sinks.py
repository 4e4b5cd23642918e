"""Sinks. Appends add files; nothing already written is read back or rewritten."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.schema import FEATURE_LIST, FEATURES, METRICS, SPLIT_COLUMNS


def append_csv(df: DataFrame, path: str) -> None:
    """Append rows as CSV files with a header each."""
    df.write.mode("append").option("header", "true").csv(path)


def append_parquet(df: DataFrame, path: str, by_session: bool = True) -> None:
    """Append rows as snappy Parquet, one folder per session so readers can prune.

    Rebalancing gathers a session into few files and splits a session that is too large.
    """
    if by_session:
        (df.hint("rebalance", "session_id").write.mode("append")
         .option("compression", "snappy").partitionBy("session_id").parquet(path))
    else:
        df.write.mode("append").option("compression", "snappy").parquet(path)


def write_feature_list(spark: SparkSession, path: str, features: list[str] = FEATURES) -> None:
    text = spark.createDataFrame([("\n".join(features),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(path)


def write_splits(df: DataFrame, directory: str, files: int | None = None) -> None:
    """Write train, val and test folders and the feature list next to them.

    Rows are range-partitioned by split and session, so the number of files follows the bytes
    (adaptive execution joins small ranges) and a session lies in few files, in order: a reader's
    filter on it skips the others by their statistics. ``files`` fixes the number of ranges.
    """
    base = directory.rstrip("/")
    out = df.select(*SPLIT_COLUMNS, "split")
    by = ["split", "session_id"]
    out = out.repartitionByRange(*by) if files is None else out.repartitionByRange(files, *by)
    out.sortWithinPartitions(*by).write.mode("overwrite").partitionBy("split").parquet(base)
    write_feature_list(df.sparkSession, f"{base}/{FEATURE_LIST}")


def write_comparison(per_model: DataFrame, path: str) -> None:
    """One row per model with metrics rounded to six digits."""
    (per_model.select("model", *[F.round(m, 6).alias(m) for m in METRICS])
     .coalesce(1).write.mode("overwrite").option("header", "true").csv(path))


def model_slug(name: str) -> str:
    return name.lower().replace(" ", "_")


def save_model(model, directory: str, name: str) -> str:
    path = f"{directory.rstrip('/')}/{model_slug(name)}"
    model.write().overwrite().save(path)
    return path
