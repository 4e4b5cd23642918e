"""Reproducible train / validation / test splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.functions import columns as C
from kerbside.operators.prefix import running_totals
from kerbside.schema import KEY, SPLIT_SHARES


def split_ticket(key: list[str] = KEY) -> Column:
    """Hash of the row key: uniform, and the same on every evaluation of the plan."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in key]))


def key_below(share: float, key: list[str] = KEY) -> Column:
    """Whether another hash of the row key lies in the lowest ``share``. Copies of a key share its
    fate, so the filter may stand before or after a deduplication."""
    return F.pmod(F.xxhash64(*key), F.lit(1 << 30)) < int(share * (1 << 30))


def _cut(share: float) -> str:
    """Eight-digit hexadecimal point below which ``share`` of all hashes lie."""
    return format(int(share * 16**8), "08x")


def add_split(df: DataFrame, shares: dict[str, float] = SPLIT_SHARES,
              key: list[str] = KEY) -> DataFrame:
    """Assign rows by hash: no shuffle, and shares hold within each label in expectation."""
    head = F.substring(split_ticket(key), 1, 8)
    test, val = shares["test"], shares["val"]
    return df.withColumn("split", F.when(head < _cut(test), "test")
                         .when(head < _cut(test + val), "val").otherwise("train"))


def add_exact_split(df: DataFrame, shares: dict[str, float] = SPLIT_SHARES,
                    key: list[str] = KEY) -> DataFrame:
    """Exact shares inside each label: rows are ranked by hash and cut at rounded counts.

    The rank comes from band totals (leading hash digits), so the three labels do not become
    three tasks. Keys must be unique.
    """
    ticketed = df.withColumns({
        "_ticket": F.concat(split_ticket(key), F.concat_ws("|", *[F.col(k).cast("string")
                                                                  for k in key])),
        "_one": F.lit(1)})
    ranked = running_totals(ticketed, ["label"], "_ticket", ["_one"],
                            F.substring("_ticket", 1, 4))
    total = F.col("_one_total")
    test_end = F.round(total * F.lit(shares["test"]))
    val_end = test_end + F.round(total * F.lit(shares["val"]))
    rank = F.col("_one_before")
    return ranked.select(*df.columns, F.when(rank < test_end, "test").when(rank < val_end, "val")
                         .otherwise("train").alias("split"))


def shuffled(df: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Order by the row hash; only for consumers that need a random order."""
    return df.orderBy(split_ticket(key), *key)


def split_report(df: DataFrame) -> DataFrame:
    """Rows per split and label with subtotals (null = all) and share of the whole."""
    counts = df.rollup("split", "label").agg(F.count(F.lit(1)).alias("n_rows"),
                                             F.grouping_id().alias("_level"))
    # The windows run over the rolled-up table: splits times labels, plus subtotals.
    whole = F.max(F.when(F.col("_level") == 3, F.col("n_rows"))).over(Window.partitionBy())
    per_split = F.max(F.when(F.col("_level") == 1, F.col("n_rows"))).over(
        Window.partitionBy("split"))
    return counts.select(
        "split", "label", "n_rows",
        C.steady(100.0 * F.col("n_rows") / whole, 6).alias("pct_of_all"),
        F.when(F.col("split").isNotNull(),
               C.steady(F.try_divide(100.0 * F.col("n_rows"), per_split), 6)).alias("pct_of_split"))


def class_weights(df: DataFrame) -> DataFrame:
    """Balanced weight n / (k * n_c) per label."""
    counts = df.groupBy("label").agg(F.count(F.lit(1)).alias("n_rows"))
    every = Window.partitionBy()  # over one row per label
    return counts.select("label", "n_rows", (F.sum("n_rows").over(every) / (
        F.count(F.lit(1)).over(every) * F.col("n_rows"))).alias("weight"))


def add_class_weight(df: DataFrame) -> DataFrame:
    """Join the weights back; ``label`` has three values, so the table is tiny."""
    return df.join(F.broadcast(class_weights(df).select("label", "weight")), "label")
