"""Ordered cleaning: incomplete rows, duplicates, range and label filters, drop report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.schema import ACCEL_MAX, CRITICAL, DROP_REASONS, KEY, LABELS, SPEED_MAX

def _other_columns(df: DataFrame, keys: list[str]) -> list[str]:
    return [c for c in df.columns if c not in keys]


def drop_incomplete(df: DataFrame, columns: list[str] = CRITICAL) -> DataFrame:
    """Drop rows with a null or NaN in any of ``columns``."""
    return df.dropna(subset=columns)


def deduplicate(df: DataFrame, order_by: list[str] | None = None,
                keys: list[str] = KEY) -> DataFrame:
    """Keep the first row of each key by ``order_by`` (default: all other columns).

    Filtering ``row_number() = 1`` lets Spark cut every key to one row per map task before
    the shuffle, so a key with very many copies stays cheap. The keys are listed in reverse
    because rows are sorted by them: vehicle ids tell rows apart sooner than session ids,
    which share a long prefix.
    """
    order = order_by or _other_columns(df, keys)
    first = Window.partitionBy(*reversed(keys)).orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(first))
            .where("_rn = 1").drop("_rn"))


def keep_range(df: DataFrame, column: str, lo: float | None, hi: float | None) -> DataFrame:
    kept = df
    if lo is not None:
        kept = kept.where(F.col(column) >= lo)
    if hi is not None:
        kept = kept.where(F.col(column) <= hi)
    return kept


def keep_labels(df: DataFrame, labels: list[str] = LABELS) -> DataFrame:
    return df.where(F.col("congestion_label").isin(labels))


def keep_valid(df: DataFrame, accel_max: float = ACCEL_MAX,
               speed_max: float = SPEED_MAX) -> DataFrame:
    """The row-wise part of cleaning after deduplication."""
    return (df.transform(keep_range, "acceleration", 0, accel_max)
            .transform(keep_range, "speed", 0, speed_max)
            .transform(keep_range, "traffic_density", 0, None)
            .transform(keep_labels))


def clean(df: DataFrame, order_by: list[str] | None = None, accel_max: float = ACCEL_MAX,
          speed_max: float = SPEED_MAX) -> DataFrame:
    """Whole chain. Range filters come after the duplicates are resolved: which copy
    survives decides whether the key survives."""
    return (df.transform(drop_incomplete)
            .transform(deduplicate, order_by)
            .transform(keep_valid, accel_max, speed_max))


def _incomplete(df: DataFrame, columns: list[str]) -> Column:
    doubles = {n for n, t in df.dtypes if t in ("double", "float")}
    bad = F.lit(False)
    for c in columns:
        bad = bad | F.col(c).isNull()
        if c in doubles:
            bad = bad | F.isnan(c)
    return bad


def first_failure(accel_max: float = ACCEL_MAX, speed_max: float = SPEED_MAX) -> Column:
    """Name of the first row-wise rule a complete row breaks, null when it breaks none."""
    return (F.when((F.col("acceleration") < 0) | (F.col("acceleration") > accel_max),
                   "bad_acceleration")
            .when((F.col("speed") < 0) | (F.col("speed") > speed_max), "bad_speed")
            .when(F.col("traffic_density") < 0, "bad_density")
            .when(~F.col("congestion_label").isin(LABELS), "bad_label"))


def drop_report(df: DataFrame, order_by: list[str] | None = None, accel_max: float = ACCEL_MAX,
                speed_max: float = SPEED_MAX) -> DataFrame:
    """Rows lost per reason in cleaning order, total and remaining: one scan, one shuffle.

    Each key is reduced to its row count and the verdict on its surviving copy. Incomplete
    rows share one null key, which map-side combining collapses.
    """
    order = order_by or _other_columns(df, KEY)
    marked = df.withColumn("_bad", _incomplete(df, CRITICAL))
    keys = [F.when(~F.col("_bad"), F.col(k)).alias(k) for k in KEY]
    per_key = (
        marked.select("_bad", *keys, F.struct(*order).alias("_order"),
                      first_failure(accel_max, speed_max).alias("_failure"))
        .groupBy(*reversed(KEY), "_bad")
        .agg(F.count(F.lit(1)).alias("n"), F.min_by("_failure", "_order").alias("failure")))
    usable = ~F.col("_bad")
    totals = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input"),
        F.coalesce(F.sum(F.when(F.col("_bad"), F.col("n"))), F.lit(0)).alias(DROP_REASONS[0]),
        F.coalesce(F.sum(F.when(usable, F.col("n") - 1)), F.lit(0)).alias(DROP_REASONS[1]),
        *[F.count_if(usable & (F.col("failure") == r)).alias(r) for r in DROP_REASONS[2:]],
        F.count_if(usable & F.col("failure").isNull()).alias("remaining"))
    lines = [*DROP_REASONS, "total_dropped", "remaining"]
    return (totals.withColumn("total_dropped", F.col("input") - F.col("remaining"))
            .select("input", F.explode(F.array(*[
                F.struct(F.lit(i).alias("step"), F.lit(r).alias("reason"),
                         F.col(r).alias("n_rows")) for i, r in enumerate(lines, 1)])).alias("r"))
            .select("r.*", F.round(F.try_divide(F.lit(100.0) * F.col("r.n_rows"),
                                                F.col("input")), 3).alias("pct_of_input")))
