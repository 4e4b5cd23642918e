"""Builders of check SQL for the table shapes that recur."""

from __future__ import annotations

from kerbside.plans.tables import sql


def clip(column: str, lo: float, hi: float) -> str:
    return (f"CASE WHEN {column} < {lo} THEN {lo}e0 WHEN {column} > {hi} THEN {hi}e0 "
            f"ELSE CAST({column} AS DOUBLE) END")


def histogram(source: str, by: str | None, value: str, bins: int, where: str = "TRUE",
              value_range: tuple[str, str] | None = None, **steps: str) -> str:
    group = f"{by}, " if by else ""
    key = by or "one"
    lo, hi = ("min(value)", "max(value)") if value_range is None else value_range
    inside = "" if value_range is None else f"WHERE value >= {lo} AND value <= {hi}"
    return sql(
        source,
        f"""SELECT {'r.' + by + ',' if by else ''} CAST(t.bin AS INT) AS bin,
              round(round(lo + t.bin * w, 9), 6) AS bin_lo, round(round(lo + (t.bin + 1) * w, 9), 6) AS bin_hi,
              coalesce(n, 0) AS n_rows, round(round(coalesce(n, 0) / (total * w), 9), 6) AS density
            FROM r CROSS JOIN (SELECT unnest(range({bins})) AS bin) AS t
            LEFT JOIN b ON b.{key} = r.{key} AND b.bin = t.bin""",
        **steps,
        v0=f"""SELECT {group} 1 AS one, CAST({value} AS DOUBLE) AS value FROM {source}
          WHERE ({where}) AND ({value}) IS NOT NULL""",
        v=f"SELECT * FROM v0 {inside}",
        e=f"""SELECT {key}, {lo} AS a, {hi} AS z, count(*) AS total FROM v GROUP BY {key}""",
        r=f"""SELECT {key}, total, CASE WHEN a = z THEN a - 0.5e0 ELSE a END AS lo,
          CASE WHEN a = z THEN z + 0.5e0 ELSE z END AS hi, (hi - lo) / {bins} AS w FROM e""",
        b=f"""SELECT {key}, least(floor((value - lo) / w), {bins} - 1) AS bin, count(*) AS n
          FROM v JOIN r USING ({key}) GROUP BY ALL""")


def density(source: str, by: str, value: str, lo: float, hi: float, points: int, factor: float,
            groups: list[str] | None, min_rows: int = 2) -> str:
    inside = f"{by} IS NOT NULL"
    if groups is not None:
        inside = f"{by} IN ({', '.join(repr(g) for g in groups)})"
    step = (float(hi) - float(lo)) / (points - 1)
    return sql(
        source,
        f"""SELECT {by}, CAST(point AS INT) AS point, round(round({lo}e0 + point * {step!r}, 9), 6) AS at,
              round(round(sum(n * exp(-0.5e0 * pow(({lo}e0 + point * {step!r} - value) / h, 2)))
                / (any_value(total) * any_value(h) * sqrt(2 * pi())), 9), 6) AS density
            FROM v JOIN m USING ({by}) CROSS JOIN (SELECT unnest(range({points})) AS point)
            GROUP BY {by}, point""",
        v=f"""SELECT {by}, {clip(value, lo, hi)} AS value, count(*) AS n FROM {source}
          WHERE {inside} AND {value} IS NOT NULL GROUP BY ALL""",
        m=f"""SELECT {by}, sum(n) AS total,
            {factor} * sqrt((sum(n * value * value) - sum(n * value) * sum(n * value) / sum(n))
              / (sum(n) - 1)) AS h
          FROM v GROUP BY {by} HAVING sum(n) >= {min_rows}""")


def shares(source: str, by: str) -> str:
    def n(label: str) -> str:
        return f"count(*) FILTER (WHERE congestion_label = '{label}')"
    return sql(source, f"SELECT {by}, count(*) AS n_rows, "
               + ", ".join(f"{n(l)} AS n_{l.lower()}, "
                           f"round(round(100e0 * {n(l)} / count(*), 9), 6) AS pct_{l.lower()}"
                           for l in ("Low", "Medium", "High"))
               + f" FROM {source} WHERE congestion_label IS NOT NULL AND {by} IS NOT NULL"
               f" GROUP BY {by}")


def box(source: str, by: str, value: str, min_rows: int = 1, **steps: str) -> str:
    return sql(
        source,
        f"""SELECT {by}, any_value(n_rows) AS n_rows, round(round(any_value(q1), 9), 6) AS q1,
              round(round(any_value(med), 9), 6) AS median, round(round(any_value(q3), 9), 6) AS q3,
              round(round(min(value) FILTER (WHERE inside), 9), 6) AS whisker_lo,
              round(round(max(value) FILTER (WHERE inside), 9), 6) AS whisker_hi,
              round(round(any_value(med - 1.57e0 * (q3 - q1) / sqrt(n_rows)), 9), 6) AS notch_lo,
              round(round(any_value(med + 1.57e0 * (q3 - q1) / sqrt(n_rows)), 9), 6) AS notch_hi,
              round(round(min(value), 9), 6) AS min_value, round(round(max(value), 9), 6) AS max_value,
              count(*) FILTER (WHERE NOT inside) AS n_outliers
            FROM (SELECT *, value BETWEEN q1 - 1.5e0 * (q3 - q1) AND q3 + 1.5e0 * (q3 - q1)
              AS inside FROM v JOIN q USING ({by})) GROUP BY {by}""",
        **steps,
        v=f"""SELECT {by}, CAST({value} AS DOUBLE) AS value FROM {source}
          WHERE {by} IS NOT NULL AND ({value}) IS NOT NULL""",
        q=f"""SELECT {by}, count(*) AS n_rows, quantile_cont(value, 0.25) AS q1,
            quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3
          FROM v GROUP BY {by} HAVING count(*) >= {min_rows}""")


def ecdf(source: str, by: str, value: str, where: str) -> str:
    return sql(
        source,
        f"""SELECT {by}, round(round(value, 9), 6) AS value, n AS n_rows, round(round(CASE WHEN total = 1 THEN 0e0
              ELSE CAST(upto - 1 AS DOUBLE) / (total - 1) END, 9), 6) AS cumulative
            FROM (SELECT {by}, value, n, sum(n) OVER (PARTITION BY {by}) AS total,
              sum(n) OVER (PARTITION BY {by} ORDER BY value) AS upto FROM c)""",
        c=f"""SELECT {by}, {value} AS value, count(*) AS n FROM {source}
          WHERE {where} AND {value} IS NOT NULL GROUP BY ALL""")


def correlations(source: str, columns: dict[str, str]) -> str:
    names = list(columns)
    return sql(source, " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(round(corr({columns[a]}, {columns[b]}), 9), 6) AS r "
        f"FROM {source}" for a in names for b in names))


def grid(source: str, by: str | None, value: str | None, bins: int = 60, where: str = "TRUE",
         **steps: str) -> str:
    key = by or "one"
    group = f"{by}, " if by else ""
    mean = f", round(round(avg({value}), 9), 6) AS mean_value" if value else ""
    return sql(
        source,
        f"SELECT {group} ix, iy, count(*) AS n_rows{mean} FROM cells GROUP BY {group} ix, iy",
        **steps,
        pts=f"SELECT *, 1 AS one FROM {source} WHERE {where}",
        ext=f"""SELECT {key}, min(x) AS xl, max(x) AS xh, min(y) AS yl, max(y) AS yh
          FROM pts GROUP BY {key}""",
        cells=f"""SELECT pts.*,
            CAST(least(floor((x - xl) / ((xh - xl) / {bins})), {bins} - 1) AS INT) AS ix,
            CAST(least(floor((y - yl) / ((yh - yl) / {bins})), {bins} - 1) AS INT) AS iy
          FROM pts JOIN ext USING ({key})""")


def hexbin(source: str, x: str, y: str, gridsize: int, value: str | None = None) -> str:
    rows = int(gridsize / 3 ** 0.5)
    mean = f", round(round(avg(val), 9), 6) AS mean_value" if value else ""
    val = value or "NULL"
    return sql(
        source,
        f"""SELECT CAST(CASE WHEN near THEN 0 ELSE 1 END AS INT) AS lattice,
              CAST(CASE WHEN near THEN round_even(u, 0) ELSE floor(u) END AS INT) AS i,
              CAST(CASE WHEN near THEN round_even(v, 0) ELSE floor(v) END AS INT) AS j,
              count(*) AS n_rows{mean}
            FROM (SELECT *, (u - round_even(u, 0)) * (u - round_even(u, 0))
                + 3e0 * (v - round_even(v, 0)) * (v - round_even(v, 0))
                < (u - floor(u) - 0.5e0) * (u - floor(u) - 0.5e0)
                + 3e0 * ((v - floor(v) - 0.5e0) * (v - floor(v) - 0.5e0)) AS near FROM s)
            GROUP BY 1, 2, 3""",
        p=f"SELECT CAST({x} AS DOUBLE) AS px, CAST({y} AS DOUBLE) AS py, {val} AS val "
          f"FROM {source} WHERE {x} IS NOT NULL AND {y} IS NOT NULL",
        e="""SELECT min(px) - 1e-9 * (max(px) - min(px)) AS x0,
            max(px) + 1e-9 * (max(px) - min(px)) AS x1,
            min(py) - 1e-9 * (max(py) - min(py)) AS y0,
            max(py) + 1e-9 * (max(py) - min(py)) AS y1 FROM p""",
        s=f"""SELECT val, (px - x0) / ((x1 - x0) / {gridsize}) AS u,
            (py - y0) / ((y1 - y0) / {rows}) AS v FROM p CROSS JOIN e""")
