"""Data-quality checks; each returns a small table instead of printed text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions import columns as C
from kerbside.sources.scratch import written
from kerbside.schema import (ACCEL_MAX, DENSITY_MAX, KEY, LABELS, MIN_SESSION_ROWS,
                             MIN_TOTAL_ROWS, OBS_COLUMNS, SPEED_MAX)

RANGES = {"speed": (0, SPEED_MAX), "acceleration": (0, ACCEL_MAX),
          "traffic_density": (0, DENSITY_MAX), "hour": (0, 23)}


def _records(items: list[Column]) -> Column:
    return F.explode(F.array(*items))


def _is_missing(df: DataFrame, column: str) -> Column:
    missing = F.col(column).isNull()
    if dict(df.dtypes)[column] in ("double", "float"):
        missing = missing | F.isnan(column)
    return missing


def check_schema(df: DataFrame, expected: list[str] = OBS_COLUMNS) -> DataFrame:
    """One line per expected or extra column, with the row and column counts."""
    status = {c: "present" if c in df.columns else "missing" for c in expected}
    status |= {c: "extra" for c in df.columns if c not in expected and c != "source_file"}
    return (df.agg(F.count(F.lit(1)).alias("n_rows"))
            .withColumn("n_columns", F.lit(len(df.columns)))
            .select("n_rows", "n_columns", _records([
                F.struct(F.lit(c).alias("column_name"), F.lit(s).alias("status"))
                for c, s in status.items()]).alias("r"))
            .select("r.*", "n_rows", "n_columns"))


def rows_per(df: DataFrame, column: str) -> DataFrame:
    """Rows per non-null value of a column."""
    return (df.where(F.col(column).isNotNull())
            .groupBy(column).agg(F.count(F.lit(1)).alias("n_rows")))


def volume(df: DataFrame, min_rows: int = MIN_SESSION_ROWS) -> DataFrame:
    """Rows, sessions and sessions that are too short, from one grouping by session."""
    return (df.groupBy("session_id").agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
                 F.count("session_id").alias("n_sessions"),
                 F.count_if(F.col("session_id").isNotNull() & (F.col("n") < min_rows))
                 .alias("n_short_sessions")))


def rows_per_session(df: DataFrame, min_rows: int = MIN_SESSION_ROWS) -> DataFrame:
    return (rows_per(df, "session_id")
            .withColumns({"session_tail": F.right("session_id", F.lit(22)),
                          "town_token": C.session_town_token(),
                          "too_few": C.flag(F.col("n_rows") < min_rows)})
            .orderBy("n_rows", "session_id"))


def rows_by_town_and_weather(df: DataFrame) -> DataFrame:
    """Rows and share by town and by weather in one pass over the data."""
    known = df.select("town", "weather_name")
    counts = (known.groupingSets([["town"], ["weather_name"]], "town", "weather_name")
              .agg(F.count(F.lit(1)).alias("n_rows"),
                   F.grouping("town").alias("_by_weather")))
    long = counts.select(
        F.when(F.col("_by_weather") == 1, "weather").otherwise("town").alias("dimension"),
        F.when(F.col("_by_weather") == 1, F.col("weather_name")).otherwise(F.col("town"))
        .alias("name"), "n_rows").where("name IS NOT NULL")
    totals = long.groupBy("dimension").agg(F.sum("n_rows").alias("_total"))
    return (long.join(F.broadcast(totals), "dimension")  # two rows
            .select("dimension", "name", "n_rows",
                    C.steady(100.0 * F.col("n_rows") / F.col("_total"), 6).alias("pct")))


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with nulls or NaN, their number and percentage."""
    columns = df.columns
    one = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count_if(_is_missing(df, c)).alias(c) for c in columns])
    return (one.select("_rows", _records([
                F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_missing"))
                for c in columns]).alias("r"))
            .select("r.*", C.steady(F.try_divide(100.0 * F.col("r.n_missing"), F.col("_rows")), 6)
                    .alias("pct"))
            .where("n_missing > 0"))


def duplicate_keys(df: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """Rows beyond the first of their key, over the key columns that exist."""
    present = [k for k in keys if k in df.columns]
    return (df.groupBy(*present).agg(F.count(F.lit(1)).alias("n"))
            .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_duplicates"))
            .withColumn("status", F.when(F.col("n_duplicates") == 0, "OK").otherwise("WARN")))


def value_ranges(df: DataFrame, ranges: dict[str, tuple[float, float]] = RANGES) -> DataFrame:
    """Minimum, maximum, mean and out-of-range rows of each listed column that exists."""
    aggregates, lines = [], []
    for c, (lo, hi) in ranges.items():
        if c not in df.columns:
            continue
        v = F.col(c).cast("double")
        ok = F.when(~F.isnan(v), v)
        aggregates += [F.min(ok).alias(f"{c}_min"), F.max(ok).alias(f"{c}_max"),
                       F.avg(ok).alias(f"{c}_mean"),
                       F.count_if((ok < lo) | (ok > hi)).alias(f"{c}_bad")]
        lines.append(F.struct(
            F.lit(c).alias("column_name"), C.steady(f"{c}_min", 6).alias("min_value"),
            C.steady(f"{c}_max", 6).alias("max_value"), C.steady(f"{c}_mean", 6).alias("mean_value"),
            F.col(f"{c}_bad").alias("n_out_of_range"),
            F.when(F.col(f"{c}_bad") == 0, "OK").otherwise("WARN").alias("status")))
    return df.agg(*aggregates).select(_records(lines).alias("r")).select("r.*")


def infinite_values(df: DataFrame) -> DataFrame:
    """Infinite values over all floating-point columns (integers cannot hold one)."""
    doubles = [c for c, t in df.dtypes if t in ("double", "float")]
    total = F.lit(0)
    for c in doubles:
        total = total + F.count_if(F.abs(F.col(c)) == float("inf"))
    return (df.agg(total.alias("n_infinite"))
            .withColumn("status", F.when(F.col("n_infinite") == 0, "OK").otherwise("WARN")))


def label_distribution(df: DataFrame) -> DataFrame:
    """Count and share of Low, Medium, High in that order, zero when absent, with the
    smallest share among all labels that occur (warned below five percent)."""
    per_label = df.groupBy("congestion_label").agg(F.count(F.lit(1)).alias("n"))
    one = per_label.agg(
        F.sum("n").alias("_total"),
        F.min(F.when(F.col("congestion_label").isNotNull(), F.col("n"))).alias("_least"),
        *[F.coalesce(F.sum(F.when(F.col("congestion_label") == l, F.col("n"))), F.lit(0)).alias(l)
          for l in LABELS])
    share = F.try_divide(100.0 * F.col("_least"), F.col("_total"))
    return (one.select("_total", C.steady(share, 6).alias("min_share_pct"),
                       F.when(share >= 5, "OK").otherwise("WARN").alias("balance"),
                       _records([F.struct(F.lit(i).alias("label"), F.lit(l).alias("label_name"),
                                          F.col(l).alias("n_rows"))
                                 for i, l in enumerate(LABELS)]).alias("r"))
            .select("r.*", C.steady(F.try_divide(100.0 * F.col("r.n_rows"), F.col("_total")), 6)
                    .alias("pct"), "min_share_pct", "balance"))


def spatial_coverage(df: DataFrame, min_range: float = 100.0) -> DataFrame:
    ok = {c: F.when(C.present(c), F.col(c)) for c in ("x", "y")}
    return (df.where(F.col("town").isNotNull()).groupBy("town")
            .agg((F.max(ok["x"]) - F.min(ok["x"])).alias("x_range"),
                 (F.max(ok["y"]) - F.min(ok["y"])).alias("y_range"))
            .select("town", C.steady("x_range", 6).alias("x_range"),
                    C.steady("y_range", 6).alias("y_range"),
                    F.when((F.col("x_range") < min_range) | (F.col("y_range") < min_range), "WARN")
                    .otherwise("OK").alias("status")))


def pearson(a: str, b: str) -> Column:
    """Correlation over rows where both values are present."""
    both = C.present(a) & C.present(b)
    return F.corr(F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double")))


def speed_density_correlation(df: DataFrame) -> DataFrame:
    return (df.agg(pearson("speed", "traffic_density").alias("r"))
            .select(C.steady("r", 6).alias("pearson_r"),
                    F.when(F.col("r") < -0.05, "OK").when(F.col("r") > 0.1, "WARN")
                    .otherwise("INFO").alias("status")))


def verdict(df: DataFrame, min_total: int = MIN_TOTAL_ROWS, speed_max: float = SPEED_MAX,
            min_share: float = 5.0, max_corr: float = 0.1,
            min_rows: int = MIN_SESSION_ROWS) -> DataFrame:
    """Failed rules with their measured value, or one PASS line.

    The rows are read once: a grouping by session and label carries every count and the sums
    behind the correlation, and is written before the rules look at it.
    """
    nulls = F.lit(0)
    for c in df.columns:
        nulls = nulls + _is_missing(df, c).cast("int")
    both = C.present("speed") & C.present("traffic_density")
    x, y = (F.when(both, F.col(c).cast("double")) for c in ("speed", "traffic_density"))
    products = {"x": x, "y": y, "xx": x * x, "yy": y * y, "xy": x * y}
    cell = written(
        df.groupBy("session_id", "congestion_label")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(nulls).alias("n_null"),
             F.count_if(F.col("speed") > speed_max).alias("n_fast"), F.count(x).alias("n_both"),
             *[F.sum(v).alias(k) for k, v in products.items()]), "verdict-cells")
    overall = cell.agg(*[F.sum(c).alias(c) for c in ("n", "n_null", "n_fast", "n_both", *products)])
    m = F.col("n_both")
    spread = {v: F.greatest(F.lit(0.0), F.col(2 * v) - F.col(v) * F.col(v) / m) for v in "xy"}
    r = F.try_divide(F.col("xy") - F.col("x") * F.col("y") / m, F.sqrt(spread["x"]) * F.sqrt(spread["y"]))
    smallest = (cell.where(F.col("congestion_label").isNotNull())
                .groupBy("congestion_label").agg(F.sum("n").alias("n"))
                .agg(F.try_divide(100.0 * F.min("n"), F.sum("n")).alias("v")))
    short = (cell.where(F.col("session_id").isNotNull())
             .groupBy("session_id").agg(F.sum("n").alias("n"))
             .agg(F.count_if(F.col("n") < min_rows).alias("v")))
    facts = overall.select(
        F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("n_null", F.lit(0)).alias("n_null"),
        F.coalesce("n_fast", F.lit(0)).alias("n_fast"), smallest.scalar().alias("share"),
        r.alias("corr"), short.scalar().alias("n_short"))
    rules = [
        ("too_few_rows", F.col("n") < min_total, F.col("n")),
        ("null_values", F.col("n_null") > 0,
         F.try_divide(100.0 * F.col("n_null"), F.col("n") * len(df.columns))),
        ("speed_above_limit", F.col("n_fast") > 0, F.col("n_fast")),
        ("label_imbalance", F.col("share") < min_share, F.col("share")),
        ("positive_speed_density_correlation", F.col("corr") > max_corr, F.col("corr")),
        ("short_sessions", F.col("n_short") > 0, F.col("n_short")),
    ]
    failed = F.filter(F.array(*[
        F.when(broken, F.struct(F.lit(i).alias("rule_no"), F.lit(name).alias("rule"),
                                C.steady(value.cast("double"), 6).alias("metric"),
                                F.lit("ACTION NEEDED").alias("verdict")))
        for i, (name, broken, value) in enumerate(rules, 1)]), lambda r: r.isNotNull())
    passed = F.array(F.struct(F.lit(0).alias("rule_no"), F.lit("all").alias("rule"),
                              F.lit(None).cast("double").alias("metric"),
                              F.lit("PASS").alias("verdict")))
    return (facts.select(F.explode(F.when(F.size(failed) > 0, failed).otherwise(passed)).alias("r"))
            .select("r.*"))
