"""Ordered running totals that never put a whole group into one task.

A plain ``sum() over (partition by g order by v)`` sorts all of ``g`` in one task. Here the
group is cut into many small ordered *bands*. The totals of the bands are tiny and are
accumulated first; each band is then accumulated on its own and shifted by what precedes it.
The bands are range partitions: Spark samples the rows for splitters that give parts of equal
size, wherever the values lie.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.functions import columns as C
from kerbside.sources.scratch import written


def running_totals(df: DataFrame, by: list[str], order: str, measures: list[str],
                   band: Column | None = None) -> DataFrame:
    """Add ``<m>_before`` and ``<m>_total`` to rows that are unique per ``(by, order)``.

    ``band`` may name a non-decreasing function of ``order`` alone that is known to cut evenly,
    such as leading hash digits; otherwise the rows are range-partitioned by sampled splitters
    and written, so that each keeps its part. Keys in ``by`` must not be null.
    """
    banded = ranged(df, by, order) if band is None else df.withColumn("_band", band)
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    sums = banded.groupBy(*by, "_band").agg(*[F.sum(m).alias(m) for m in measures])
    offsets = sums.select(
        *by, "_band",
        *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"_{m}_base") for m in measures],
        *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
    )
    inside = (Window.partitionBy(*by, "_band").orderBy(order)
              .rowsBetween(Window.unboundedPreceding, -1))
    local = banded.select(
        *df.columns, "_band",
        *[F.coalesce(F.sum(m).over(inside), F.lit(0)).alias(f"_{m}_local") for m in measures],
    )
    return local.join(offsets, [*by, "_band"]).select(
        *df.columns,
        *[(F.col(f"_{m}_base") + F.col(f"_{m}_local")).alias(f"{m}_before") for m in measures],
        *[f"{m}_total" for m in measures],
    )


def ranged(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Rows with ``_band``: their part of the range partitioning by ``by`` and ``order``."""
    return written(df.repartitionByRange(*by, order).withColumn("_band", F.spark_partition_id()), "ranged")


def value_counts(df: DataFrame, by: list[str], value: str | Column,
                 name: str = "value") -> DataFrame:
    """Rows per distinct value and group, with nulls and NaN of the value left out.

    Map-side combining shrinks hot groups to their distinct values before any shuffle.
    """
    column = F.col(value) if isinstance(value, str) else value
    rows = df.select(*by, column.cast("double").alias(name)).where(C.present(name))
    for b in by:
        rows = rows.where(F.col(b).isNotNull())
    return rows.groupBy(*by, name).agg(F.count(F.lit(1)).alias("n"))


def order_statistics(counts: DataFrame, by: list[str], probabilities: dict[str, float],
                     value: str = "value") -> DataFrame:
    """Exact percentiles (linear interpolation) from the output of ``value_counts``."""
    ranked = running_totals(counts, by, value, ["n"])
    picks, results = [], []
    for name, p in probabilities.items():
        rank = (F.col("n_total") - 1) * F.lit(float(p))
        for side, position in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            covers = (F.col("n_before") <= position) & (position < F.col("n_before") + F.col("n"))
            picks.append(F.max(F.when(covers, F.col(value))).alias(f"_{name}_{side}"))
        final = (F.col("n") - 1) * F.lit(float(p))
        results.append((F.col(f"_{name}_lo") + (F.col(f"_{name}_hi") - F.col(f"_{name}_lo"))
                        * (final - F.floor(final))).alias(name))
    gathered = ranked.groupBy(*by).agg(F.sum("n").alias("n"), *picks)
    return gathered.select(*by, "n", *results)
