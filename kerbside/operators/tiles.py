"""Neighbour counts of crowded cells, a tile of cells per group.

A tile is TILE x TILE cells with a border of one cell, so every partner of a position in the tile is
in its group. Positions of a group are sorted by thin strips and along them. For a position and
a strip, two look-ups bound the stretch that surely lies within the radius and two more the
stretch that may; running sums count the former, only positions between the two are measured. With
strips that get thinner as the crowd gets denser, a position costs about the square root of its
neighbours.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Cells along a side of a tile, and positions of one group that are looked up at once.
TILE, AT_ONCE = 4, 8_192


def counts_within(sx: np.ndarray, sy: np.ndarray, x: np.ndarray, y: np.ndarray, n: np.ndarray,
                  radius: float) -> np.ndarray:
    """Sum of ``n`` over the positions ``x, y`` within ``radius`` (inclusive) of each of ``sx, sy``."""
    out = np.zeros(len(sx), np.int64)
    if not len(sx) or not len(x):
        return out
    x_lo, y_lo = min(x.min(), sx.min()), min(y.min(), sy.min())
    width, height = max(x.max(), sx.max()) - x_lo, max(y.max(), sy.max()) - y_lo
    around = len(x) * radius * radius / max(width * height, radius * radius)
    k = int(np.clip(np.sqrt(around / 8), 2, 64))
    side = radius / k
    # Look-ups are off by rounding only; what lies that close to a bound is measured.
    guard = 1e-6 * radius + 1e-12 * max(abs(x_lo), abs(y_lo), width, height)
    pitch = width + 4 * radius
    strip = np.floor((y - y_lo) / side).astype(np.int64)
    order = np.lexsort((x, strip))
    x, y, n, strip = x[order], y[order], n[order], strip[order]
    key = strip * pitch + (x - x_lo)
    before = np.concatenate(([0], np.cumsum(n)))
    last = int(strip[-1])
    along = np.lexsort((sx, np.floor((sy - y_lo) / side)))
    for start in range(0, len(sx), AT_ONCE):
        rows = along[start:start + AT_ONCE]
        qx, qy = sx[rows], sy[rows]
        home = np.floor((qy - y_lo) / side).astype(np.int64)
        found = np.zeros(len(rows), np.int64)
        for step in range(-k - 1, k + 2):
            at = home + step
            some = np.flatnonzero((at >= 0) & (at <= last))
            if not len(some):
                continue
            low = y_lo + at[some] * side - qy[some]
            high = low + side
            near = np.maximum(np.maximum(low, -high), 0.0) - guard
            far = np.maximum(-low, high) + guard
            reach = np.sqrt(np.maximum(radius * radius - np.maximum(near, 0.0) ** 2, 0.0)) + guard
            sure = np.sqrt(np.maximum(radius * radius - far ** 2, 0.0)) - guard
            middle = at[some] * pitch + (qx[some] - x_lo)
            sure = np.maximum(sure, 0.0)
            a, d = np.searchsorted(key, middle - reach), np.searchsorted(key, middle + reach, "right")
            a = np.where(near > radius, d, a)
            has = sure > 0
            b, c = np.searchsorted(key, middle - sure), np.searchsorted(key, middle + sure, "right")
            b, c = np.where(has, np.clip(b, a, d), d), np.where(has, np.clip(c, a, d), d)
            found[some] += before[c] - before[b]
            for first, stop in ((a, b), (c, d)):
                sizes = stop - first
                total = int(sizes.sum())
                if not total:
                    continue
                who = np.repeat(np.arange(len(some)), sizes)
                which = np.arange(total) + np.repeat(first - (np.cumsum(sizes) - sizes), sizes)
                dx, dy = qx[some][who] - x[which], qy[some][who] - y[which]
                hit = np.sqrt(dx * dx + dy * dy) <= radius
                found[some] += np.bincount(who, np.where(hit, n[which], 0), len(some)).astype(np.int64)
        out[rows] = found
    return out


def tile_counts(spots: DataFrame, radius: float, frame: list[str]) -> DataFrame:
    """``frame, x, y, _near``: what positions in or next to crowded cells gain from meeting these.

    ``spots`` has one row per position with ``x``, ``y``, ``n`` vehicles, its cell ``_cx, _cy`` of side
    ``radius`` and ``_crowded``. Two positions meet if either one's cell is crowded; a position
    does not meet itself. A group has the positions of (TILE + 2) squared cells.
    """
    keys = [*frame, "_tx", "_ty"]

    def tile(axis: str, step: int):
        return F.floor((F.col(axis) + step) / TILE)

    def reached(df: DataFrame) -> DataFrame:
        places = F.array_distinct(F.array(*[F.struct(tile("_cx", i).alias("_tx"), tile("_cy", j).alias("_ty"))
                                            for i in (-1, 0, 1) for j in (-1, 0, 1)]))
        return df.withColumn("_t", F.explode(places)).select("*", "_t.*").drop("_t")

    wanted = reached(spots.where("_crowded").select(*frame, "_cx", "_cy").distinct()).select(*keys).distinct()
    own = (F.col("_tx") == tile("_cx", 0)) & (F.col("_ty") == tile("_cy", 0))
    held = reached(spots).select(*keys, "x", "y", "n", "_crowded", own.alias("_own")).join(wanted, keys, "left_semi")

    def count(table: pa.Table) -> pa.Table:
        x, y, n, crowded, core = (table.column(c).to_numpy() for c in ("x", "y", "n", "_crowded", "_own"))
        near = np.zeros(len(x), np.int64)
        dense, rest = core & crowded, core & ~crowded
        near[dense] = counts_within(x[dense], y[dense], x, y, n, radius) - n[dense]
        near[rest] = counts_within(x[rest], y[rest], x[crowded], y[crowded], n[crowded], radius)
        gains = near > 0
        return (table.select([*frame, "x", "y"]).append_column("_near", pa.array(near, pa.int64()))
                .filter(pa.array(gains)))

    kinds = dict(spots.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in [*frame, "x", "y"])
    return held.groupBy(*keys).applyInArrow(count, f"{schema}, _near long")
