"""Distribution tables: samples, histograms, densities, shares, box summaries, correlations.

Everything works on counts per distinct value, so a hot group costs its distinct values and
not its rows. Where the groups come from a closed list (labels, weather names, towns) the
caller passes it as ``groups``; only then is a per-group table broadcast, because only then
is its size known beforehand. Other per-group tables are joined without a hint and the
adaptive planner decides from measured size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions import columns as C
from kerbside.operators.prefix import order_statistics, running_totals, value_counts
from kerbside.schema import KEY, LABELS


def only_groups(df: DataFrame, column: str, groups: list[str]) -> DataFrame:
    return df.where(F.col(column).isin(groups))


def attach(big: DataFrame, small: DataFrame, by: list[str], bounded: bool = False) -> DataFrame:
    """Add the columns of a per-group table: by scalar subquery when there is no group."""
    if not by:
        return big.select("*", *[small.select(c).scalar().alias(c) for c in small.columns])
    return big.join(F.broadcast(small) if bounded else small, by)


# --- samples ---------------------------------------------------------------------------

def sample_bounded(df: DataFrame, n: int, seed: int = 42, key: list[str] = KEY) -> DataFrame:
    """min(n, rows) rows, those with the smallest seeded hash of the key.

    Counts per hash prefix give the prefix at which n rows are reached. Only rows up to it are
    sorted, about n of them, so a plain top-n does not send n rows per input task to one
    place. The same rows come back whatever the partitioning; copies of a key are told apart
    by the other columns.
    """
    ticket = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))
    rest = [c for c in df.columns if c not in key]
    ticketed = df.withColumn("_ticket", ticket)
    prefix = F.substring("_ticket", 1, 6)
    counts = ticketed.groupBy(prefix.alias("prefix")).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, [], "prefix", ["n"], F.substring("prefix", 1, 3))
    last = ranked.where(F.col("n_before") < n).agg(F.max("prefix"))
    return (ticketed.where(prefix <= last.scalar())
            .orderBy("_ticket", *key, *rest).limit(n).drop("_ticket"))


# --- histograms ------------------------------------------------------------------------

def _edges(ranges: DataFrame) -> DataFrame:
    """Widen an empty range by half a unit on both sides."""
    flat = F.col("lo") == F.col("hi")
    return ranges.withColumns({"lo": F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")),
                               "hi": F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))})


def bin_index(value: Column, lo: Column, hi: Column, bins: int | Column) -> Column:
    """Equal-width bin number; the last bin is closed on the right."""
    count = F.lit(bins) if isinstance(bins, int) else bins
    width = (hi - lo) / count
    return F.least(F.floor((value - lo) / width), count - 1).cast("int")


def histogram(df: DataFrame, value: str | Column, bins: int | Column, by: list[str] | None = None,
              value_range: tuple[float, float] | None = None, bounded: bool = False) -> DataFrame:
    """Counts and normalised density per equal-width bin over each group's own range.

    ``value_range`` fixes the range instead; values outside it are not counted. Empty bins
    are present with zero. ``bins`` may be a column of the grouping.
    """
    by = by or []
    counts = value_counts(df, by, value)
    if value_range is not None:
        lo, hi = (F.lit(float(v)) for v in value_range)
        counts = counts.where((F.col("value") >= lo) & (F.col("value") <= hi))
        ranges = counts.groupBy(*by).agg(F.sum("n").alias("total")).select(
            *by, lo.alias("lo"), hi.alias("hi"), "total")
    else:
        ranges = _edges(counts.groupBy(*by).agg(
            F.min("value").alias("lo"), F.max("value").alias("hi"), F.sum("n").alias("total")))
    if isinstance(bins, int):
        ranges = ranges.withColumn("bins", F.lit(bins))
    else:
        ranges = ranges.withColumn("bins", bins)
    ranges = ranges.where(F.col("total") > 0)
    index = bin_index(F.col("value"), F.col("lo"), F.col("hi"), F.col("bins"))
    filled = (attach(counts, ranges, by, bounded).withColumn("bin", index)
              .groupBy(*by, "bin").agg(F.sum("n").alias("n")))
    frame = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)))
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    count = F.coalesce("n", F.lit(0))
    return frame.join(filled, [*by, "bin"], "left").select(
        *by, "bin", C.steady(F.col("lo") + F.col("bin") * width, 6).alias("bin_lo"),
        C.steady(F.col("lo") + (F.col("bin") + 1) * width, 6).alias("bin_hi"),
        count.alias("n_rows"),
        C.steady(count / (F.col("total") * width), 6).alias("density"))


def edge_histogram(df: DataFrame, value: Column, edges: list[float]) -> DataFrame:
    """Counts between unequal edges; left-closed, the last bin closed on both sides."""
    last = len(edges) - 2
    chain = None
    for i in range(last + 1):
        upper = value <= edges[i + 1] if i == last else value < edges[i + 1]
        inside = (value >= edges[i]) & upper
        chain = F.when(inside, i) if chain is None else chain.when(inside, i)
    picked = [F.count_if(F.col("bin") == i).alias(f"b{i}") for i in range(last + 1)]
    return (df.select(chain.alias("bin")).agg(*picked)
            .select(F.explode(F.array(*[
                F.struct(F.lit(i).alias("bin"), F.lit(float(edges[i])).alias("bin_lo"),
                         F.lit(float(edges[i + 1])).alias("bin_hi"),
                         F.col(f"b{i}").alias("n_rows")) for i in range(last + 1)])).alias("r"))
            .select("r.*"))


# --- kernel density --------------------------------------------------------------------

#: Terms of a cell's expansion, and bandwidths beyond which a kernel is taken as zero (5e-15).
TERMS, REACH = 12, 8.0


def hermite(k: int) -> list[int]:
    """Coefficients of the k-th (probabilists') Hermite polynomial by rising power."""
    before, now = [0], [1]
    for i in range(k):
        after = [0, *now]
        for power, c in enumerate(before):
            after[power] -= i * c
        before, now = now, after
    return now


def kernel_density(df: DataFrame, by: str, value: str | Column, lo: float, hi: float, points: int,
                   factor: float, groups: list[str] | None = None,
                   min_rows: int = 2) -> DataFrame:
    """Gaussian density of each group on a fixed grid; bandwidth = factor * sample std.

    All groups that occur, or a closed list of ``groups``; only with such a list is the table
    of bandwidths broadcast.

    Values are clamped to the grid first. A fast Gauss transform: values fall into cells half a
    bandwidth wide, a cell keeps TERMS moments of them about its centre, and its expansion in
    Hermite polynomials is evaluated at the grid points within REACH bandwidths. With values at
    most a quarter bandwidth off the centre, what is left out of a value's kernel stays below
    1e-11, so the work is that of cells and points, whatever the number of distinct values.
    """
    column = F.col(value) if isinstance(value, str) else value
    chosen = df if groups is None else only_groups(df, by, groups)
    counts = value_counts(chosen, [by], C.clip(column, float(lo), float(hi)))
    moments = counts.groupBy(by).agg(
        F.sum("n").alias("total"), F.sum(F.col("n") * F.col("value")).alias("s1"),
        F.sum(F.col("n") * F.col("value") * F.col("value")).alias("s2"))
    variance = ((F.col("s2") - F.col("s1") * F.col("s1") / F.col("total"))
                / (F.col("total") - 1))
    widths = (moments.where(F.col("total") >= min_rows)
              .select(by, "total", (F.lit(float(factor)) * F.sqrt(variance)).alias("h"))
              .where("h > 0"))
    step = (float(hi) - float(lo)) / (points - 1)
    at = F.lit(float(lo)) + F.col("point") * F.lit(step)
    cell = F.floor((F.col("value") - F.lit(float(lo))) / (F.col("h") * 0.5))
    centre = F.lit(float(lo)) + (F.col("cell") + 0.5) * 0.5 * F.col("h")
    off = (F.col("value") - F.col("centre")) / F.col("h")
    cells = (counts.join(widths if groups is None else F.broadcast(widths), by)
             .withColumn("cell", cell).withColumn("centre", centre).withColumn("off", off)
             .groupBy(by, "total", "h", "centre").agg(*[
                 F.sum(F.col("n") * F.pow("off", F.lit(k)) / float(math.factorial(k))).alias(f"m{k}")
                 for k in range(TERMS)]))

    def point(value: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(points - 1), F.floor((value - F.lit(float(lo))) / step).cast("int")))

    near = F.sequence(point(F.col("centre") - REACH * F.col("h")), point(F.col("centre") + REACH * F.col("h") + step))
    u = (at - F.col("centre")) / F.col("h")
    # The moments times their Hermite polynomials, gathered by powers of u.
    expansion = F.lit(0.0)
    for power in reversed(range(TERMS)):
        gathered = sum((F.lit(float(hermite(k)[power])) * F.col(f"m{k}") for k in range(power, TERMS)
                        if hermite(k)[power]), F.lit(0.0))
        expansion = expansion * F.col("u") + gathered
    # Bandwidths are worked out again here, and their sums may run in another order: the last digits
    # of ``h`` can differ from those of the cells, so they are no part of the key.
    every = widths.select(by, "total", "h", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"),
                          F.lit(0.0).alias("w"))
    return (cells.withColumn("point", F.explode(near)).withColumn("u", u)
            .select(by, "total", "h", "point", (expansion * C.normal_kernel(F.col("u"))).alias("w"))
            .unionByName(every)
            .groupBy(by, "point").agg(F.sum("w").alias("w"), F.max("total").alias("total"), F.max("h").alias("h"))
            .select(by, "point", C.steady(at, 6).alias("at"),
                    C.steady(F.col("w") / (F.col("total") * F.col("h")), 6).alias("density")))


# --- category shares -------------------------------------------------------------------

def label_shares(df: DataFrame, by: list[str]) -> DataFrame:
    """Counts and row-percent of Low, Medium, High per group; absent cells are zero.

    The percentage is of all labelled rows of the group, other labels included.
    """
    known = df.where(F.col("congestion_label").isNotNull())
    for b in by:
        known = known.where(F.col(b).isNotNull())
    counted = known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col("congestion_label") == l).alias(f"n_{l.lower()}") for l in LABELS])
    return counted.select("*", *[
        C.steady(100.0 * F.col(f"n_{l.lower()}") / F.col("n_rows"), 6).alias(f"pct_{l.lower()}")
        for l in LABELS])


def pivot_counts(df: DataFrame, row: str, column: str) -> DataFrame:
    """Long cross table with zero cells, and where each cell starts in a stacked bar.

    Both axes must be low-cardinality names; the stack is per row over the columns in order.
    """
    cells = (df.where(F.col(row).isNotNull() & F.col(column).isNotNull())
             .groupBy(row, column).agg(F.count(F.lit(1)).alias("n")))
    rows = cells.groupBy(row).agg(F.map_from_entries(
        F.collect_list(F.struct(column, "n"))).alias("_cells"))
    names = cells.agg(F.sort_array(F.collect_set(column)).alias("names")).scalar()
    amount = F.coalesce(F.try_element_at("_cells", F.element_at("_names", F.col("_i") + 1)),
                        F.lit(0))
    before = F.aggregate(
        F.slice("_names", F.lit(1), F.col("_i")), F.lit(0).cast("long"),
        lambda acc, name: acc + F.coalesce(F.try_element_at(F.col("_cells"), name), F.lit(0)))
    return (rows.withColumn("_names", names)
            .withColumn("_i", F.explode(F.sequence(F.lit(0), F.size("_names") - 1)))
            .select(row, F.element_at("_names", F.col("_i") + 1).alias(column),
                    amount.alias("n_rows"), before.alias("stack_start")))


def high_shares(df: DataFrame, rows: str, columns: str) -> DataFrame:
    """Rows and % High per pair of low-cardinality names; pairs that don't occur have 0."""
    high = F.coalesce(F.col("congestion_label") == "High", F.lit(False)).cast("double")
    cells = df.groupBy(rows, columns).agg(
        F.count(F.lit(1)).alias("n_rows"), C.steady(100.0 * F.avg(high), 6).alias("pct_high"))
    frame = pivot_counts(df, rows, columns).select(rows, columns)
    return frame.join(cells, [rows, columns], "left").fillna({"n_rows": 0, "pct_high": 0.0})


# --- centre and spread -----------------------------------------------------------------

def box_stats(df: DataFrame, by: list[str], value: str | Column, min_rows: int = 1,
              bounded: bool = False) -> DataFrame:
    """Exact quartiles, 1.5 IQR whiskers, notch and extremes per group."""
    counts = value_counts(df, by, value)
    quartiles = (order_statistics(counts, by, {"q1": 0.25, "median": 0.5, "q3": 0.75})
                 .where(F.col("n") >= min_rows)
                 .withColumnRenamed("n", "n_rows"))
    iqr = F.col("q3") - F.col("q1")
    inside = F.col("value").between(F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr)
    stats = ["n_rows", "q1", "median", "q3"]
    grouped = attach(counts, quartiles, by, bounded).groupBy(*by, *stats).agg(
        F.min("value").alias("min_value"), F.max("value").alias("max_value"),
        F.min(F.when(inside, F.col("value"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("value"))).alias("whisker_hi"),
        F.sum(F.when(~inside, F.col("n")).otherwise(0)).alias("n_outliers"))
    half_notch = 1.57 * iqr / F.sqrt("n_rows")
    numbers = {"q1": F.col("q1"), "median": F.col("median"), "q3": F.col("q3"),
               "whisker_lo": F.col("whisker_lo"), "whisker_hi": F.col("whisker_hi"),
               "notch_lo": F.col("median") - half_notch, "notch_hi": F.col("median") + half_notch,
               "min_value": F.col("min_value"), "max_value": F.col("max_value")}
    return grouped.select(*by, "n_rows", *[C.steady(v, 6).alias(k) for k, v in numbers.items()],
                          "n_outliers")


def medians(df: DataFrame, by: list[str], value: str | Column) -> DataFrame:
    return (order_statistics(value_counts(df, by, value), by, {"median": 0.5})
            .select(*by, F.col("n").alias("n_rows"), C.steady("median", 6).alias("median")))


def mean_and_median(df: DataFrame, value: str | Column) -> DataFrame:
    counts = value_counts(df, [], value)
    means = counts.agg((F.sum(F.col("n") * F.col("value")) / F.sum("n")).alias("m"))
    return (order_statistics(counts, [], {"median": 0.5})
            .select(F.col("n").alias("n_rows"), C.steady(means.scalar(), 6).alias("mean"),
                    C.steady("median", 6).alias("median")))


def mean_and_std(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Mean and sample standard deviation; the deviation of one row is null."""
    known = df
    for b in by:
        known = known.where(F.col(b).isNotNull())
    number = F.when(C.present(value), F.col(value).cast("double"))
    return known.groupBy(*by).agg(
        F.count(number).alias("n_rows"), C.steady(F.avg(number), 6).alias("mean"),
        C.steady(F.stddev_samp(number), 6).alias("std"))


def ecdf(df: DataFrame, by: list[str], value: str | Column) -> DataFrame:
    """Empirical curve y = (i - 1) / (n - 1), one point per distinct value (its last i)."""
    ranked = running_totals(value_counts(df, by, value), by, "value", ["n"])
    y = F.try_divide((F.col("n_before") + F.col("n") - 1).cast("double"), F.col("n_total") - 1)
    return ranked.select(*by, C.steady("value", 6).alias("value"), F.col("n").alias("n_rows"),
                         C.steady(F.coalesce(y, F.lit(0.0)), 6).alias("cumulative"))


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Long symmetric Pearson matrix over pairwise present values.

    Rows are grouped by which columns are missing (few patterns occur) and each group keeps
    plain sums of centred values and products. A pair adds up the groups that have both
    columns, so the work per row is one product per pair, not one correlation state.
    """
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    numbers = df.select(*[F.when(C.present(c), F.col(c).cast("double")).alias(f"v{i}")
                          for i, c in enumerate(columns)])
    centres = numbers.agg(*[F.avg(f"v{i}").alias(f"m{i}") for i in range(len(columns))])
    mask = sum((F.col(f"v{i}").isNotNull().cast("int") * (1 << i)
                for i in range(1, len(columns))), F.col("v0").isNotNull().cast("int"))
    centred = numbers.select(mask.alias("mask"), *[
        F.coalesce(F.col(f"v{i}") - centres.select(f"m{i}").scalar(), F.lit(0.0)).alias(f"c{i}")
        for i in range(len(columns))])
    sums = centred.groupBy("mask").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        *[F.sum(f"c{i}").alias(f"s{i}") for i in range(len(columns))],
        *[F.sum(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"p{i}_{j}") for i, j in pairs])
    # From here on there is one row per pattern of missing columns.
    per_pair = F.array(*[
        F.struct(F.lit(columns[i]).alias("a"), F.lit(columns[j]).alias("b"),
                 F.lit((1 << i) | (1 << j)).alias("need"), F.col(f"s{i}").alias("sa"),
                 F.col(f"s{j}").alias("sb"), F.col(f"p{i}_{i}").alias("aa"),
                 F.col(f"p{j}_{j}").alias("bb"), F.col(f"p{i}_{j}").alias("ab"))
        for i, j in pairs])
    long = (sums.select("mask", "n", F.explode(per_pair).alias("p")).select("mask", "n", "p.*")
            .where(F.col("mask").bitwiseAND(F.col("need")) == F.col("need"))
            .groupBy("a", "b").agg(*[F.sum(c).alias(c) for c in ("n", "sa", "sb", "aa", "bb", "ab")]))
    n = F.col("n")
    covariance = F.col("ab") - F.col("sa") * F.col("sb") / n
    spread = F.sqrt((F.col("aa") - F.col("sa") * F.col("sa") / n)
                    * (F.col("bb") - F.col("sb") * F.col("sb") / n))
    r = C.steady(F.try_divide(covariance, spread), 6)
    both = F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
        F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b"))))
    return (long.select(F.explode(both).alias("k"), r.alias("r")).select("k.a", "k.b", "r"))


def summary_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, sample deviation, minimum and maximum of each column, in one aggregate."""
    aggregates, lines = [], []
    for c in columns:
        v = F.col(c).cast("double")
        aggregates += [F.avg(v).alias(f"{c}_mean"), F.stddev_samp(v).alias(f"{c}_std"),
                       F.min(v).alias(f"{c}_min"), F.max(v).alias(f"{c}_max")]
        lines.append(F.struct(
            F.lit(c).alias("column_name"), C.steady(f"{c}_mean", 6).alias("mean"),
            C.steady(f"{c}_std", 6).alias("stddev"), C.steady(f"{c}_min", 6).alias("min_value"),
            C.steady(f"{c}_max", 6).alias("max_value")))
    return (df.agg(*aggregates).select(F.explode(F.array(*lines)).alias("r")).select("r.*"))


def bin_crosstab(df: DataFrame) -> DataFrame:
    """Rows per density interval and speed interval (right-closed), zero cells included."""
    speeds, densities = ["<5", "5-20", "20-50", "50+"], ["<3", "3-8", "8-15", "15+"]
    cells = df.select(C.speed_interval().alias("s"), C.density_interval().alias("d"))
    one = cells.agg(*[F.count_if((F.col("s") == s) & (F.col("d") == d)).alias(f"c{i}_{j}")
                      for i, d in enumerate(densities) for j, s in enumerate(speeds)])
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(d).alias("density_bin"), F.lit(s).alias("speed_bin"),
                 F.col(f"c{i}_{j}").alias("n_rows"))
        for i, d in enumerate(densities) for j, s in enumerate(speeds)])).alias("r")).select("r.*")
