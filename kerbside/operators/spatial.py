"""Spatial tables: grids, smoothing, hexagons, hotspots, and the proximity join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.functions import columns as C
from kerbside.operators import crowds, tiles
from kerbside.operators.distributions import attach, bin_index
from kerbside.schema import PROXIMITY_RADIUS_M
from kerbside.sources.scratch import written

#: Positions of a cell beyond which it is counted by tiles instead of paired, and beyond which it
#: is taken apart (so that a tile's group is bounded).
CROWD, HUGE = 128, 16_384


def _bounds(df: DataFrame, by: list[str]) -> DataFrame:
    flat_x, flat_y = F.min("x") == F.max("x"), F.min("y") == F.max("y")
    return df.groupBy(*by).agg(
        (F.min("x") - F.when(flat_x, 0.5).otherwise(0.0)).alias("x_lo"),
        (F.max("x") + F.when(flat_x, 0.5).otherwise(0.0)).alias("x_hi"),
        (F.min("y") - F.when(flat_y, 0.5).otherwise(0.0)).alias("y_lo"),
        (F.max("y") + F.when(flat_y, 0.5).otherwise(0.0)).alias("y_hi"))


def _cells(df: DataFrame, bins: int, by: list[str], values: dict[str, str | Column],
           bounded: bool) -> DataFrame:
    located = df.where(C.present("x") & C.present("y"))
    for b in by:
        located = located.where(F.col(b).isNotNull())
    numbers = [(F.col(v) if isinstance(v, str) else v).cast("double").alias(f"_{name}")
               for name, v in values.items()]
    points = located.select(*by, "x", "y", *numbers)
    return attach(points, _bounds(points, by), by, bounded).select(
        *by, bin_index(F.col("x"), F.col("x_lo"), F.col("x_hi"), bins).alias("ix"),
        bin_index(F.col("y"), F.col("y_lo"), F.col("y_hi"), bins).alias("iy"),
        *[f"_{name}" for name in values])


def grid_means(df: DataFrame, values: dict[str, str | Column], bins: int = 60,
               by: list[str] | None = None, bounded: bool = False) -> DataFrame:
    """Rows and the mean of several values per cell of an equal-width x-y grid.

    The grid spans each group's own extent. Cells without rows are absent.
    """
    by = by or []
    means = [C.steady(F.avg(F.when(C.present(f"_{n}"), F.col(f"_{n}"))), 6).alias(f"mean_{n}")
             for n in values]
    return (_cells(df, bins, by, values, bounded).groupBy(*by, "ix", "iy")
            .agg(F.count(F.lit(1)).alias("n_rows"), *means))


def grid(df: DataFrame, bins: int = 60, by: list[str] | None = None,
         value: str | Column | None = None, bounded: bool = False) -> DataFrame:
    """``grid_means`` for plain counts or one value, whose mean is ``mean_value``."""
    return grid_means(df, {} if value is None else {"value": value}, bins, by, bounded)


def smoothing_weights(sigma: float, truncate: float = 4.0) -> list[float]:
    """Normalised Gaussian weights for offsets -r..r with r = truncate * sigma, rounded."""
    radius = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * (k / sigma) ** 2) for k in range(-radius, radius + 1)]
    return [w / sum(raw) for w in raw]


def smooth_grid(cells: DataFrame, by: list[str], bins: int, value: str = "n_rows",
                sigma: float = 1.5) -> DataFrame:
    """Gaussian smoothing of a sparse grid with mirrored borders, one axis at a time.

    A cell spreads to its neighbours and, near a border, through its mirror image. The work
    is the number of cells times the kernel width, independent of the rows behind them.
    """
    weights = smoothing_weights(sigma)
    radius = len(weights) // 2
    kernel = F.array(*[F.struct(F.lit(k - radius).alias("k"), F.lit(w).alias("w"))
                       for k, w in enumerate(weights)])
    out = cells.select(*by, "ix", "iy", F.col(value).cast("double").alias("v"))
    for axis, other in (("ix", "iy"), ("iy", "ix")):
        mirrored = F.array(F.col(axis), -F.col(axis) - 1, F.lit(2 * bins - 1) - F.col(axis))
        out = (out.withColumn("_e", F.explode(mirrored)).withColumn("_k", F.explode(kernel))
               .withColumn("_t", F.col("_e") - F.col("_k.k"))
               .where(F.col("_t").between(0, bins - 1))
               .groupBy(*by, F.col("_t").alias(axis), other)
               .agg(F.sum(F.col("v") * F.col("_k.w")).alias("v")))
    return out.select(*by, "ix", "iy", C.steady("v", 6).alias("smoothed"))


def hexbin(df: DataFrame, x: str | Column, y: str | Column, gridsize: int,
           value: str | None = None) -> DataFrame:
    """Counts, and the mean of ``value`` if given, per cell of a regular hexagon lattice.

    The lattice is two interleaved rectangular ones; each point goes to the nearer centre.
    """
    px = F.col(x) if isinstance(x, str) else x
    py = F.col(y) if isinstance(y, str) else y
    extra = [] if value is None else [F.col(value).cast("double").alias("_v")]
    points = (df.select(px.cast("double").alias("x"), py.cast("double").alias("y"), *extra)
              .where(C.present("x") & C.present("y")))
    rows = int(gridsize / math.sqrt(3))
    span = attach(points, points.agg(
        F.min("x").alias("x_lo"), F.max("x").alias("x_hi"),
        F.min("y").alias("y_lo"), F.max("y").alias("y_hi")), [])
    pad = F.lit(1e-9)
    x0 = F.col("x_lo") - pad * (F.col("x_hi") - F.col("x_lo"))
    y0 = F.col("y_lo") - pad * (F.col("y_hi") - F.col("y_lo"))
    sx = (F.col("x_hi") + pad * (F.col("x_hi") - F.col("x_lo")) - x0) / gridsize
    sy = (F.col("y_hi") + pad * (F.col("y_hi") - F.col("y_lo")) - y0) / rows
    placed = span.withColumns({"u": (F.col("x") - x0) / sx, "v": (F.col("y") - y0) / sy})
    d1 = ((F.col("u") - F.rint("u")) * (F.col("u") - F.rint("u"))
          + 3.0 * (F.col("v") - F.rint("v")) * (F.col("v") - F.rint("v")))
    hu, hv = F.col("u") - F.floor("u") - 0.5, F.col("v") - F.floor("v") - 0.5
    near = d1 < hu * hu + 3.0 * hv * hv
    cells = placed.select(
        F.when(near, 0).otherwise(1).alias("lattice"),
        F.when(near, F.rint("u")).otherwise(F.floor("u")).cast("int").alias("i"),
        F.when(near, F.rint("v")).otherwise(F.floor("v")).cast("int").alias("j"),
        *([] if value is None else ["_v"]))
    mean = [] if value is None else [
        C.steady(F.avg(F.when(C.present("_v"), F.col("_v"))), 6).alias("mean_value")]
    return cells.groupBy("lattice", "i", "j").agg(F.count(F.lit(1)).alias("n_rows"), *mean)


def hotspots(df: DataFrame, cell: int = 20, top: int = 10, by: list[str] | None = None,
             min_records: int = 0) -> DataFrame:
    """Cells with the largest share of High rows; ties by more records, then position."""
    by = by or []
    high = (F.col("congestion_label") == "High")
    grouped = (df.where(C.present("x") & C.present("y"))
               .groupBy(*by, C.grid_origin("x", cell).alias("x_bin"),
                        C.grid_origin("y", cell).alias("y_bin"))
               .agg(F.count("speed").alias("records"), F.avg("speed").alias("s"),
                    F.avg("traffic_density").alias("d"),
                    F.avg(F.coalesce(high, F.lit(False)).cast("double")).alias("h")))
    return (grouped.where(F.col("records") >= min_records)
            .orderBy(F.desc("h"), F.desc("records"), *by, "x_bin", "y_bin").limit(top)
            .select(*by, "x_bin", "y_bin", "records", C.steady("s", 1).alias("avg_speed"),
                    C.steady("d", 1).alias("avg_density"),
                    C.steady(F.col("h") * 100.0, 1).alias("pct_high")))


def proximity_density(df: DataFrame, radius: float = PROXIMITY_RADIUS_M,
                      frame: list[str] | None = None, vehicle: str = "vehicle_id",
                      crowd: int = CROWD, huge: int = HUGE) -> DataFrame:
    """Other vehicles within ``radius`` metres (inclusive, in the plane) in the same frame.

    ``df`` has one row per frame and vehicle. Vehicles at one spot (parked, or logged at a
    default position) become one position with a count, so a crowded spot makes no pairs.
    Positions fall into square cells of side ``radius``, which puts partners into the same or
    an adjacent cell. Each unordered pair of positions is met once: a position looks in its own
    cell (one direction only) and in four of the eight neighbours, and a match counts for both
    sides. The merge hint keeps the planner from broadcasting a side that grows with the
    data. Cells with more than ``crowd`` positions, and their neighbours towards them, are counted
    by ``tiles``, those with more than ``huge`` by a hierarchy of smaller cells (``crowds``); neither
    makes a row per pair.
    """
    frame = frame or ["session_id", "tick"]
    spots = (df.where(C.present("x") & C.present("y")).groupBy("x", "y", *reversed(frame))
             .agg(F.count(F.lit(1)).alias("n"), F.min(vehicle).alias("_id"))
             .withColumns({"_cx": F.floor(F.col("x") / radius), "_cy": F.floor(F.col("y") / radius)}))
    spots = written(spots, "spots")
    cell = ["_cx", "_cy", *reversed(frame)]
    dense = written(spots.groupBy(*cell).agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") > crowd), "crowded-cells")
    sparse, crowded = spots, []
    if not dense.isEmpty():
        several = dense.where(F.col("_m") > huge).select(*cell)
        if not several.isEmpty():
            crowded.append(crowds.crowded_counts(spots, several, radius, frame).select(*frame, "x", "y", "_near"))
        told = spots.join(dense, cell, "left")
        sparse = told.where("_m IS NULL").drop("_m")
        held = told.where(F.col("_m").isNull() | (F.col("_m") <= huge))
        crowded.append(tiles.tile_counts(held.withColumn("_crowded", F.col("_m").isNotNull()), radius, frame))
    looks = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"))
                      for dx, dy in ((0, 0), (1, 0), (-1, 1), (0, 1), (1, 1))])
    seekers = (sparse.withColumn("_o", F.explode(looks))
               .select(*frame, F.col("_id").alias("_a"), F.col("x").alias("_ax"),
                       F.col("y").alias("_ay"), F.col("n").alias("_an"),
                       (F.col("_cx") + F.col("_o.dx")).alias("_cx"),
                       (F.col("_cy") + F.col("_o.dy")).alias("_cy"),
                       ((F.col("_o.dx") == 0) & (F.col("_o.dy") == 0)).alias("_own")))
    dx, dy = F.col("_ax") - F.col("x"), F.col("_ay") - F.col("y")
    near = (crowds.distance(dx, dy) <= radius) & (~F.col("_own") | (F.col("_a") < F.col("_id")))
    # Join columns are sorted by in this order: cells tell rows apart sooner than sessions.
    pairs = seekers.join(sparse.hint("merge"), ["_cx", "_cy", *reversed(frame)]).where(near)
    # Both ends of a pair, each with the number of vehicles at the other end.
    ends = F.array(F.struct(F.col("_ax").alias("x"), F.col("_ay").alias("y"), F.col("n").alias("_near")),
                   F.struct("x", "y", F.col("_an").alias("_near")))
    lines = pairs.select(*frame, F.explode(ends).alias("_e")).select(*frame, "_e.*")
    for more in (*crowded, spots.select(*frame, "x", "y", (F.col("n") - 1).alias("_near"))):
        lines = lines.unionByName(more)
    counted = lines.groupBy("x", "y", *reversed(frame)).agg(F.sum("_near").alias("_near"))
    return (df.select(*frame, vehicle, "x", "y")
            .join(counted.hint("merge"), ["x", "y", *reversed(frame)], "left")
            .select(*frame, vehicle, F.coalesce("_near", F.lit(0)).cast("int")
                    .alias("traffic_density")))
