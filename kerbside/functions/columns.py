"""Row-level expressions shared by batch and streaming plans."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from kerbside.schema import (DENSITY_EDGES, DENSITY_INTERVALS, HOUR_BUCKETS, HOUR_EDGES,
                             LABEL_SEVERITY, LABELS, RAINY_CODES, REASONS,
                             SECONDS_PER_LOGGED_TICK, SPEED_EDGES, SPEED_INTERVALS)


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    return condition.cast("int")


def present(c: str | Column) -> Column:
    """True for a number that is neither null nor NaN."""
    value = _col(c).cast("double")
    return value.isNotNull() & ~F.isnan(value)


def clip(c: str | Column, lo: float | None = None, hi: float | None = None) -> Column:
    """Clamp to [lo, hi]; null stays null (least/greatest would swallow it)."""
    value = _col(c)
    out = value
    if hi is not None:
        out = F.when(value > hi, F.lit(hi)).otherwise(out)
    if lo is not None:
        out = F.when(value < lo, F.lit(lo)).otherwise(out)
    return out


def steady(c: str | Column, digits: int) -> Column:
    """Round for output. Rounding to nine digits first removes the noise that the order of a
    floating-point sum leaves, so a tie falls the same way on any partitioning."""
    return F.round(F.round(_col(c), 9), digits)


# --- bins ------------------------------------------------------------------------------

def ordinal_bin(c: str | Column, edges: list[float]) -> Column:
    """Left-closed bins 0..len(edges); values at or past the last edge, and null, go last."""
    value = _col(c)
    chain = F.when(value < edges[0], 0)
    for i, edge in enumerate(edges[1:], 1):
        chain = chain.when(value < edge, i)
    return chain.otherwise(len(edges)).cast("int")


def speed_bin(c: str | Column = "speed") -> Column:
    return ordinal_bin(c, [5, 20, 50])


def density_bin(c: str | Column = "traffic_density") -> Column:
    return ordinal_bin(c, [3, 8, 15])


def interval_label(c: str | Column, edges: list[float], names: list[str],
                   include_lowest: bool = False) -> Column:
    """Right-closed bins (a, b]; outside values are null. The first edge belongs to no
    bin unless ``include_lowest``."""
    value = _col(c)
    chain = None
    for i, name in enumerate(names):
        lower = value >= edges[i] if include_lowest and i == 0 else value > edges[i]
        inside = lower & (value <= edges[i + 1])
        chain = F.when(inside, name) if chain is None else chain.when(inside, name)
    return chain


def speed_interval(c: str | Column = "speed") -> Column:
    return interval_label(c, SPEED_EDGES, SPEED_INTERVALS)


def density_interval(c: str | Column = "traffic_density") -> Column:
    return interval_label(c, DENSITY_EDGES, DENSITY_INTERVALS)


def hour_bucket(c: str | Column = "hour") -> Column:
    return interval_label(c, HOUR_EDGES, HOUR_BUCKETS, include_lowest=True)


def grid_origin(c: str | Column, size: float) -> Column:
    """Lower corner of the grid cell holding the value; floors toward minus infinity."""
    return (F.floor(_col(c) / F.lit(float(size))) * F.lit(size)).cast("int")


def value_band(c: str | Column, per_octave: int | Column = 64) -> Column:
    """Coarse non-decreasing key of a number: sign times its scaled binary logarithm.

    Used to split a sorted group into many small runs. It depends on the value alone, so a
    recomputed partition gets the same key, and an outlier cannot squeeze the rest into
    one band as equal-width bins would.
    """
    value = _col(c).cast("double")
    scale = per_octave if isinstance(per_octave, Column) else F.lit(float(per_octave))
    magnitude = F.floor((F.log2(F.abs(value)) + F.lit(1100.0)) * scale)
    return F.when(value == 0, F.lit(0).cast("long")).otherwise(
        (F.signum(value) * magnitude).cast("long"))


# --- flags and features ----------------------------------------------------------------

def is_stationary(speed: str | Column = "speed") -> Column:
    return flag(_col(speed) < 1.0)


def is_high_density(density: str | Column = "traffic_density") -> Column:
    return flag(_col(density) >= 10)


def is_rush_hour(hour: str | Column = "hour") -> Column:
    h = _col(hour)
    return flag(h.between(7, 9) | h.between(17, 19))


def is_rainy(weather: str | Column = "weather") -> Column:
    return flag(_col(weather).isin(RAINY_CODES))


def is_braking(acceleration: str | Column = "acceleration",
               speed: str | Column = "speed") -> Column:
    return flag((_col(acceleration) > 1.0) & (_col(speed) < 15.0))


def speed_x_density(speed: str | Column = "speed",
                    density: str | Column = "traffic_density") -> Column:
    return (_col(speed) * _col(density)).cast("double")


def town_code(town: str | Column = "town") -> Column:
    """Trailing digits of the town name; null when it has none (``Town10HD``)."""
    return F.regexp_extract(_col(town), r"(\d+)$", 1).try_cast("int")


# --- labels and severity ---------------------------------------------------------------

def congestion_label(density: str | Column = "traffic_density",
                     speed: str | Column = "speed") -> Column:
    d, v = _col(density), _col(speed)
    return (F.when((d >= 10) & (v < 20.0), "High")
            .when((d < 4) | (v >= 50.0), "Low")
            .otherwise("Medium"))


def label_code(label: str | Column = "congestion_label") -> Column:
    """0, 1, 2 for Low, Medium, High; -1 for anything else."""
    name = _col(label)
    chain = F.when(name == LABELS[0], 0)
    for code, text in enumerate(LABELS[1:], 1):
        chain = chain.when(name == text, code)
    return chain.otherwise(-1).cast("int")


def label_name(code: str | Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in LABELS]), _col(code).cast("int") + 1)


def label_severity(label: str | Column = "congestion_label", missing: int | None = None) -> Column:
    """Representative 0-100 severity of a label; ``missing`` stands in for other labels."""
    name = _col(label)
    chain = None
    for text, value in LABEL_SEVERITY.items():
        chain = (F.when(name == text, value) if chain is None
                 else chain.when(name == text, value))
    return chain.otherwise(F.lit(missing)).cast("int")


def severity(probabilities: str | Column) -> Column:
    """Expected severity of class probabilities: the classes stand for 0, 50 and 100."""
    p = _col(probabilities)
    return F.lit(50.0) * F.element_at(p, 2) + F.lit(100.0) * F.element_at(p, 3)


def severity_band(score: str | Column) -> Column:
    s = _col(score)
    return (F.when(s < 20, "Free flow").when(s < 40, "Light").when(s < 60, "Moderate")
            .when(s < 80, "Heavy").otherwise("Gridlock"))


def severity_colour(score: str | Column) -> Column:
    s = _col(score)
    return F.when(s < 33, "green").when(s < 66, "amber").otherwise("red")


def best_class(probabilities: str | Column) -> Column:
    """Index of the largest probability, the first one on ties."""
    p = _col(probabilities)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def signal_reasons(speed: str | Column = "speed", stationary: str | Column = "is_stationary",
                   braking: str | Column = "is_braking",
                   rush_hour: str | Column = "is_rush_hour",
                   rainy: str | Column = "is_rainy") -> Column:
    """Array of the messages whose rule holds, or the single default message."""
    v = _col(speed)
    slow_head, slow_tail = REASONS["slow"].split("{speed}")
    # Half-even rounding; the sum with zero turns a negative zero into plain zero.
    shown = F.rint(v).cast("long").cast("string")
    found = F.filter(
        F.array(
            F.when(_col(stationary) == 1, F.lit(REASONS["stationary"])),
            F.when(v < 15, F.concat(F.lit(slow_head), shown, F.lit(slow_tail))),
            F.when(_col(braking) == 1, F.lit(REASONS["braking"])),
            F.when(_col(rush_hour) == 1, F.lit(REASONS["rush_hour"])),
            F.when(_col(rainy) == 1, F.lit(REASONS["rainy"])),
            F.when(v >= 50, F.lit(REASONS["fast"])),
        ),
        lambda m: m.isNotNull(),
    )
    return F.when(F.size(found) == 0, F.array(F.lit(REASONS["none"]))).otherwise(found)


# --- session ids and time --------------------------------------------------------------

def session_id(started: str | Column, town: str | Column, weather: str | Column) -> Column:
    return F.concat_ws("_", F.date_format(_col(started), "yyyyMMdd_HHmmss"),
                       _col(town), _col(weather))


def session_town_token(session: str | Column = "session_id") -> Column:
    """Third underscore-separated token."""
    return F.try_element_at(F.split(_col(session), "_"), F.lit(3))


def session_town(session: str | Column = "session_id") -> Column:
    """Numbered town inside the id; null when the pattern is absent."""
    found = F.regexp_extract(_col(session), r"_(Town\d+)_", 1)
    return F.when(found != "", found)


def session_start(session: str | Column = "session_id") -> Column:
    return F.try_to_timestamp(F.substring(_col(session), 1, 15), F.lit("yyyyMMdd_HHmmss"))


def event_time(session: str | Column = "session_id", tick: str | Column = "tick") -> Column:
    """Session start plus a quarter second per logged tick."""
    seconds = (_col(tick) * F.lit(SECONDS_PER_LOGGED_TICK)).cast("decimal(18,6)")
    return session_start(session) + F.make_dt_interval(secs=seconds)


def magnitude(x: str | Column, y: str | Column, z: str | Column) -> Column:
    a, b, c = _col(x), _col(y), _col(z)
    return F.sqrt(a * a + b * b + c * c)


def degrees_0_360(yaw: str | Column = "yaw") -> Column:
    return F.pmod(_col(yaw), F.lit(360.0))


def normal_kernel(u: Column) -> Column:
    return F.exp(F.lit(-0.5) * u * u) / F.lit(math.sqrt(2 * math.pi))
