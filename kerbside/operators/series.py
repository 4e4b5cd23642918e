"""Time-series tables. Orders are by tick; long series are cut into blocks, never sorted whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.functions import columns as C
from kerbside.operators.prefix import running_totals
from kerbside.schema import LABELS

BLOCK = 4096


def first_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n smallest distinct values: a top-n, so each task keeps n rows."""
    return (df.where(F.col(column).isNotNull()).select(column).distinct()
            .orderBy(column).limit(n))


def top_by_rows(df: DataFrame, column: str, n: int) -> DataFrame:
    """The n values with most rows; ties by value."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(F.count(F.lit(1)).alias("n_rows"))
            .orderBy(F.desc("n_rows"), column).limit(n))


def restrict(df: DataFrame, chosen: DataFrame, column: str) -> DataFrame:
    """Rows whose value is in a table made by ``limit(n)``; broadcasting n rows is bounded."""
    return df.join(F.broadcast(chosen.select(column)), column, "left_semi")


def per_tick(df: DataFrame, **aggregates: Column) -> DataFrame:
    return (df.where(F.col("session_id").isNotNull() & F.col("tick").isNotNull())
            .groupBy("session_id", "tick")
            .agg(*[a.alias(name) for name, a in aggregates.items()]))


def trailing_mean(df: DataFrame, by: list[str], order: str, values: list[str],
                  size: int = 5, block: int = BLOCK) -> DataFrame:
    """Mean of the current and the ``size - 1`` previous rows, null until ``size`` exist.

    ``df`` has one row per ``(by, order)``. Rows get their position in the group from block
    totals; the last rows of a block are copied into the next one, so a window of rows is
    complete inside its block and no group has to fit in one task.
    """
    band = F.floor(F.col(order) / block)
    placed = running_totals(df.withColumn("_one", F.lit(1)), by, order, ["_one"], band)
    home = F.floor(F.col("_one_before") / block)
    spill = F.pmod("_one_before", F.lit(block)) >= block - (size - 1)
    copies = placed.withColumn("_home", home).withColumn(
        "_block", F.explode(F.when(spill, F.array(home, home + 1)).otherwise(F.array(home))))
    frame = (Window.partitionBy(*by, "_block").orderBy("_one_before")
             .rowsBetween(-(size - 1), 0))
    full = F.col("_one_before") >= size - 1
    rolled = [F.when(full & (F.count(v).over(frame) == size), F.avg(v).over(frame))
              .alias(f"{v}_rolling") for v in values]
    return (copies.select(*df.columns, "_home", "_block", *rolled)
            .where("_home = _block").drop("_home", "_block"))


def label_shares_per_tick(df: DataFrame, size: int = 5) -> DataFrame:
    """Share of each label per session and tick with its trailing mean, in percent."""
    known = df.where(F.col("congestion_label").isNotNull())
    names = [l.lower() for l in LABELS]
    shares = per_tick(known, **{
        n: F.avg((F.col("congestion_label") == l).cast("double")) for n, l in zip(names, LABELS)})
    rolled = trailing_mean(shares, ["session_id"], "tick", names, size)
    return rolled.select("session_id", "tick", *[
        C.steady(100.0 * F.col(f"{n}_rolling"), 6).alias(f"pct_{n}") for n in names])


def stationary_share(df: DataFrame, size: int = 5) -> DataFrame:
    """Percent of stationary vehicles per session and tick with its trailing mean."""
    slow = F.coalesce(F.col("speed") < 1.0, F.lit(False)).cast("double")
    share = per_tick(df, pct_stationary=F.avg(slow) * 100.0)
    return (trailing_mean(share, ["session_id"], "tick", ["pct_stationary"], size)
            .select("session_id", "tick", C.steady("pct_stationary", 6).alias("pct_stationary"),
                    C.steady("pct_stationary_rolling", 6).alias("pct_rolling")))


def speed_volatility(df: DataFrame, size: int = 5) -> DataFrame:
    """Trailing mean of the per-tick sample deviation of speed."""
    speed = F.when(C.present("speed"), F.col("speed"))
    spread = per_tick(df, std=F.stddev_samp(speed))
    return (trailing_mean(spread, ["session_id"], "tick", ["std"], size)
            .select("session_id", "tick", C.steady("std", 6).alias("speed_std"),
                    C.steady("std_rolling", 6).alias("speed_std_rolling")))


def tick_profile(df: DataFrame) -> DataFrame:
    """Mean speed, mean density and most frequent label per session and tick.

    Grouping by label first keeps one large tick from being gathered; ties go to the lower
    label code, labels outside the three coming last.
    """
    speed = F.when(C.present("speed"), F.col("speed"))
    partial = per_tick_label(df, speed)
    code = C.label_code("congestion_label")
    preference = F.struct(F.col("n").alias("n"),
                          (-F.when(code < 0, 99).otherwise(code)).alias("p"))
    named = F.col("congestion_label").isNotNull()
    return partial.groupBy("session_id", "tick").agg(
        C.steady(F.try_divide(F.sum("s"), F.sum("c")), 6).alias("avg_speed"),
        C.steady(F.try_divide(F.sum("ds"), F.sum("dc")), 6).alias("avg_density"),
        F.max_by(F.when(named, F.col("congestion_label")), F.when(named, preference))
        .alias("mode_label"))


def per_tick_label(df: DataFrame, speed: Column) -> DataFrame:
    return (df.where(F.col("session_id").isNotNull() & F.col("tick").isNotNull())
            .groupBy("session_id", "tick", "congestion_label")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(speed).alias("s"), F.count(speed).alias("c"),
                 F.sum("traffic_density").cast("double").alias("ds"),
                 F.count("traffic_density").alias("dc")))


def cumulative_rows(df: DataFrame) -> DataFrame:
    """Running row count over sessions in id order.

    Session ids start with their date and hour, which makes an ordered band of fixed width.
    """
    sessions = (df.where(F.col("session_id").isNotNull())
                .groupBy("session_id").agg(F.count(F.lit(1)).alias("n")))
    ranked = running_totals(sessions, [], "session_id", ["n"], F.substring("session_id", 1, 11))
    total = F.col("n_before") + F.col("n")
    return ranked.select("session_id", F.col("n").alias("n_rows"), total.alias("cumulative_rows"),
                         C.steady(total / 1e6, 6).alias("cumulative_millions"))


def label_transitions(df: DataFrame, block: int = BLOCK) -> DataFrame:
    """Lag-1 label transitions along each (session, vehicle) trajectory, with row percent.

    Rows are ordered by tick, copies of one tick by label code. Equal rows collapse to a
    count first: n copies hold n - 1 transitions to themselves. Trajectories are cut into
    blocks of ticks; the pair that spans two blocks comes from the block ends, a table about
    ``block`` times smaller.
    """
    known = df.where(F.col("session_id").isNotNull() & F.col("vehicle_id").isNotNull()
                     & F.col("tick").isNotNull())
    runs = known.groupBy("session_id", "vehicle_id", "tick", "congestion_label").agg(
        F.count(F.lit(1)).alias("n"))
    code = C.label_code("congestion_label")
    runs = runs.withColumns({"_block": F.floor(F.col("tick") / block), "code": code})
    trail = ["vehicle_id", "session_id"]  # sorted by: the sooner-telling column first
    order = ["tick", "code", "congestion_label"]
    inside = Window.partitionBy("vehicle_id", "_block", "session_id").orderBy(*order)
    linked = runs.withColumns({"next": F.lead("code").over(inside),
                               "_first": F.row_number().over(inside) == 1})
    ends = linked.groupBy(*trail, "_block").agg(
        F.max(F.when(F.col("_first"), F.col("code"))).alias("head"),
        F.max(F.when(F.col("next").isNull(), F.col("code"))).alias("tail"))
    across = Window.partitionBy(*trail).orderBy("_block")
    one = F.lit(1).cast("long")
    pairs = (linked.select(F.explode(F.array(
                 F.struct(F.col("code").alias("a"), F.col("code").alias("b"),
                          (F.col("n") - 1).alias("n")),
                 F.struct(F.col("code").alias("a"), F.col("next").alias("b"), one.alias("n"))))
                 .alias("p")).select("p.*")
             .unionByName(ends.select(F.col("tail").alias("a"),
                                      F.lead("head").over(across).alias("b"), one.alias("n"))))
    cells = [(i, j) for i in range(len(LABELS)) for j in range(len(LABELS))]
    counted = (pairs.where("a >= 0 AND b >= 0").groupBy("a", "b").agg(F.sum("n").alias("n"))
               .agg(*[F.coalesce(F.sum(F.when((F.col("a") == i) & (F.col("b") == j), F.col("n"))),
                                 F.lit(0)).alias(f"c{i}{j}") for i, j in cells]))
    lines = []
    for i, j in cells:
        total = sum((F.col(f"c{i}{k}") for k in range(1, 3)), F.col(f"c{i}0"))
        lines.append(F.struct(
            F.lit(LABELS[i]).alias("from_label"), F.lit(LABELS[j]).alias("to_label"),
            F.col(f"c{i}{j}").alias("n_pairs"),
            C.steady(F.coalesce(F.try_divide(100.0 * F.col(f"c{i}{j}"), total), F.lit(0.0)), 6)
            .alias("pct")))
    return counted.select(F.explode(F.array(*lines)).alias("r")).select("r.*")
