"""Neighbour counts in crowded places without meeting every pair of positions.

A hierarchy of square cells, each level half as wide, lies over the crowded cells and those next
to them. Two cells meet by the bounds of the positions in them: if even the farthest two are
within the radius, each position of one side gains the vehicles of the other without any pair;
if even the nearest two are not, nothing happens; otherwise their children meet on the next
level. Only cells of few positions on the ring in between are paired position by position. The
bounds are subject to the same rounding as the distances, so the counts are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from kerbside.sources.scratch import written

#: Levels of cells below the widest, and pairs of positions that no longer are worth a split.
LEVELS, PAIR_LIMIT = 10, 256


def distance(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def _leveled(points: DataFrame, radius: float, levels: int) -> DataFrame:
    """Each position once per level, with its cell there."""
    by_level = points.withColumn("_l", F.explode(F.sequence(F.lit(0), F.lit(levels))))
    scale = F.pow(F.lit(2.0), F.col("_l"))
    return by_level.withColumns({"_ix": F.floor(F.col("x") / radius * scale), "_iy": F.floor(F.col("y") / radius * scale)})


def _named(nodes: DataFrame, side: str, frame: list[str], keys: dict[str, str]) -> DataFrame:
    """A side of a meeting: node columns with the side's letter in front."""
    return nodes.select(*frame, *[F.col(k).alias(v) for k, v in keys.items()],
                        *[F.col(c).alias(f"_{side}{c}") for c in ("_ix", "_iy", "m", "w", "x0", "x1", "y0", "y1")])


def first_meetings(dense: DataFrame, frame: list[str]) -> DataFrame:
    """Crowded cells with each of their neighbours and themselves, every pair once."""
    around = F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx in (-1, 0, 1) for dy in (-1, 0, 1)])
    here = F.struct(F.col("_cx").alias("x"), F.col("_cy").alias("y"))
    there = F.struct((F.col("_cx") + F.col("_o.dx")).alias("x"), (F.col("_cy") + F.col("_o.dy")).alias("y"))
    return (dense.withColumn("_o", F.explode(around))
            .select(*frame, F.least(here, there).alias("_a"), F.greatest(here, there).alias("_b")).distinct()
            .select(*frame, F.col("_a.x").alias("_ax"), F.col("_a.y").alias("_ay"),
                    F.col("_b.x").alias("_bx"), F.col("_b.y").alias("_by")))


def meetings(leveled: DataFrame, first: DataFrame, radius: float, frame: list[str], levels: int = LEVELS,
             pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """All settled meetings: ``_l``, both cells (``_ax, _ay, _bx, _by``), their positions (``_am,
    _bm``) and vehicles (``_aw, _bw``), and ``_state``: ``in`` or ``pair``."""
    nodes = written(leveled.groupBy(*frame, "_l", "_ix", "_iy").agg(
        F.count(F.lit(1)).alias("m"), F.sum("n").alias("w"), F.min("x").alias("x0"), F.max("x").alias("x1"),
        F.min("y").alias("y0"), F.max("y").alias("y1")), "cells")
    settled = None
    pairs = first
    for level in range(levels + 1):
        own = nodes.where(F.col("_l") == level)
        met = (pairs.join(_named(own, "a", frame, {"_ix": "_ax", "_iy": "_ay"}), [*frame, "_ax", "_ay"])
               .join(_named(own, "b", frame, {"_ix": "_bx", "_iy": "_by"}), [*frame, "_bx", "_by"]))
        far = distance(*[F.greatest(F.col(f"_a{c}1") - F.col(f"_b{c}0"), F.col(f"_b{c}1") - F.col(f"_a{c}0"))
                         for c in "xy"])
        close = distance(*[F.greatest(F.lit(0.0), F.col(f"_b{c}0") - F.col(f"_a{c}1"),
                                      F.col(f"_a{c}0") - F.col(f"_b{c}1")) for c in "xy"])
        few = (F.col("_am") * F.col("_bm") <= pair_limit) | F.lit(level == levels)
        state = (F.when(far <= radius, "in").when(close > radius, "out").when(few, "pair").otherwise("split"))
        met = written(met.withColumn("_state", state).where("_state <> 'out'").select(
            *frame, F.lit(level).alias("_l"), "_ax", "_ay", "_bx", "_by", "_am", "_bm", "_aw", "_bw", "_state"), "met")
        done = met.where("_state <> 'split'")
        settled = done if settled is None else settled.unionByName(done)
        open_ = met.where("_state = 'split'").select(*frame, "_ax", "_ay", "_bx", "_by")
        if open_.isEmpty():
            break
        below = nodes.where(F.col("_l") == level + 1).select(
            *frame, "_ix", "_iy", F.shiftright("_ix", 1).alias("_px"), F.shiftright("_iy", 1).alias("_py"))

        def child(side: str) -> DataFrame:
            return below.select(*frame, F.col("_px").alias(f"_{side}x"), F.col("_py").alias(f"_{side}y"),
                                F.struct("_ix", "_iy").alias(f"_{side}"))

        alone = (F.col("_ax") == F.col("_bx")) & (F.col("_ay") == F.col("_by"))
        pairs = (open_.join(child("a"), [*frame, "_ax", "_ay"]).join(child("b"), [*frame, "_bx", "_by"])
                 .where(~alone | (F.col("_a") <= F.col("_b")))
                 .select(*frame, F.col("_a._ix").alias("_ax"), F.col("_a._iy").alias("_ay"),
                         F.col("_b._ix").alias("_bx"), F.col("_b._iy").alias("_by")))
    return settled


def crowded_counts(spots: DataFrame, dense: DataFrame, radius: float, frame: list[str], levels: int = LEVELS,
                   pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """``frame, _id, x, y, _near``: what positions in or next to crowded cells gain from meeting
    these, several lines per position.

    ``spots`` has one row per position with ``_id``, ``x``, ``y``, ``n`` vehicles and its cell
    ``_cx, _cy`` of side ``radius``; ``dense`` lists crowded cells. A position does not meet
    itself.
    """
    first = written(first_meetings(dense, frame), "first-meetings")
    touched = first.select(*frame, F.col("_ax").alias("_cx"), F.col("_ay").alias("_cy")).union(
        first.select(*frame, "_bx", "_by")).distinct()
    points = spots.join(touched, [*frame, "_cx", "_cy"], "left_semi").select(*frame, "_id", "x", "y", "n")
    leveled = written(_leveled(points, radius, levels), "leveled")
    settled = meetings(leveled, first, radius, frame, levels, pair_limit)

    alone = (F.col("_ax") == F.col("_bx")) & (F.col("_ay") == F.col("_by"))
    # Vehicles that every position of a cell gains, and whether its own are among them.
    gains = F.when(alone, F.array(F.struct(F.col("_ax").alias("_ix"), F.col("_ay").alias("_iy"),
                                           F.col("_aw").alias("_g"), F.lit(1).alias("_self")))).otherwise(
        F.array(F.struct(F.col("_ax").alias("_ix"), F.col("_ay").alias("_iy"), F.col("_bw").alias("_g"),
                         F.lit(0).alias("_self")),
                F.struct(F.col("_bx").alias("_ix"), F.col("_by").alias("_iy"), F.col("_aw").alias("_g"),
                         F.lit(0).alias("_self"))))
    given = (settled.where("_state = 'in'").select(*frame, "_l", F.explode(gains).alias("_e"))
             .select(*frame, "_l", "_e.*").groupBy(*frame, "_l", "_ix", "_iy")
             .agg(F.sum("_g").alias("_g"), F.sum("_self").alias("_self")))
    by_cell = leveled.join(given, [*frame, "_l", "_ix", "_iy"]).select(
        *frame, "_id", "x", "y", (F.col("_g") - F.col("_self") * F.col("n")).alias("_near"))

    def side(s: str) -> DataFrame:
        return leveled.select(*frame, "_l", F.col("_ix").alias(f"_{s}x"), F.col("_iy").alias(f"_{s}y"),
                              F.struct("_id", "x", "y", "n").alias(f"_{s}"))

    pairs = (settled.where("_state = 'pair'").select(*frame, "_l", "_ax", "_ay", "_bx", "_by")
             .join(side("a").hint("merge"), [*frame, "_l", "_ax", "_ay"])
             .join(side("b").hint("merge"), [*frame, "_l", "_bx", "_by"])
             .where(~alone | (F.col("_a._id") < F.col("_b._id")))
             .where(distance(F.col("_a.x") - F.col("_b.x"), F.col("_a.y") - F.col("_b.y")) <= radius))
    ends = F.array(*[F.struct(F.col(f"_{p}._id").alias("_id"), F.col(f"_{p}.x").alias("x"), F.col(f"_{p}.y").alias("y"),
                              F.col(f"_{q}.n").alias("_near")) for p, q in ("ab", "ba")])
    by_pair = pairs.select(*frame, F.explode(ends).alias("_e")).select(*frame, "_e.*")
    return by_cell.unionByName(by_pair)
