"""Exact top-k search over vectors by distributed histogram selection.

Scores are integer inner products. No score is stored: each pass scores blocks of queries
against blocks of rows and counts the scores of every query in equal steps of a window. The
counts of all tasks are added up, the window shrinks to the step that holds the k-th value, and
after a few passes that value is known exactly. A last pass keeps the scores above it and as
many at it as are still wanted, those with the smallest ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.llm.common import Rows, slices
from kerbside.sources.scratch import written

#: Vectors and bytes in a block of rows or queries, and the queries scored at a time.
BLOCK_ROWS, BLOCK_QUERIES, BLOCK_BYTES, TILE = 8_192, 1_024, 8 << 20, 128

#: Scores lie between -EDGE and EDGE; one beyond is taken as the edge itself.
EDGE = 1 << 61

_EXACT = float(1 << 53)
# Of each query: where its window begins, how wide it and its steps are, scores above it.
_WINDOW = ("pos", "low", "span", "step", "above")
_PACKED = "block long, width int, ids binary, unknown binary, rows binary, parts binary, largest double"


def whole(values: list | None) -> np.ndarray | None:
    """floor(256 x) of each component as a double, or None if the vector takes no part."""
    if values is None or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    if not np.isfinite(x).all():
        return None
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(256.0 * x))


class _Pack:
    """Collects vectors and gives one record batch for each full block.

    Within a block rows stand by id, null ids last, which is how ties are broken.
    """

    def __init__(self, rows: int):
        self.rows, self.held, self.width = rows, [], 0

    def add(self, row: int, vec_id: int | None, x: np.ndarray) -> Rows:
        width = max(self.width, len(x))
        if self.held and (len(self.held) >= self.rows or 8 * width * (len(self.held) + 1) > BLOCK_BYTES):
            yield from self.flush()
            width = len(x)
        self.held.append((vec_id is None, vec_id or 0, row, x))
        self.width = width

    def flush(self) -> Rows:
        if not self.held:
            return
        self.held.sort(key=lambda h: h[:3])
        parts = np.zeros((len(self.held), self.width))
        for i, (_, _, _, x) in enumerate(self.held):
            parts[i, :len(x)] = x
        unknown, ids, rows = (np.array(c) for c in list(zip(*self.held))[:3])
        data = [int(rows[0]), self.width, ids.astype(np.int64).tobytes(), unknown.astype(np.uint8).tobytes(),
                rows.astype(np.int64).tobytes(), parts.tobytes(), float(np.abs(parts).max(initial=0.0))]
        schema = pa.schema([("block", pa.int64()), ("width", pa.int32()), ("ids", pa.binary()),
                            ("unknown", pa.binary()), ("rows", pa.binary()), ("parts", pa.binary()),
                            ("largest", pa.float64())])
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, data))], schema)
        self.held, self.width = [], 0


def row_blocks(vectors: DataFrame) -> DataFrame:
    """All vectors that take part, in blocks."""
    def pack(batches: Rows) -> Rows:
        held = _Pack(BLOCK_ROWS)
        for batch in slices(batches, 1024):
            columns = [batch.column(n).to_pylist() for n in ("row", "vec_id", "embedding")]
            for row, vec_id, values in zip(*columns):
                x = whole(values)
                if x is not None:
                    yield from held.add(row, vec_id, x)
        yield from held.flush()

    return vectors.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(pack, _PACKED)


def query_blocks(rows: DataFrame, every: int) -> DataFrame:
    """The vectors whose id is divisible by ``every``, in blocks of their own."""
    def pick(batches: Rows) -> Rows:
        held = _Pack(BLOCK_QUERIES)
        for block in _blocks(batches):
            for i in np.flatnonzero((block.ids % every == 0) & ~block.unknown):
                yield from held.add(int(block.rows[i]), int(block.ids[i]), block.parts[i])
        yield from held.flush()

    return rows.mapInArrow(pick, _PACKED)


class _Block:
    def __init__(self, columns: dict, prefix: str = ""):
        def array(name: str, kind) -> np.ndarray:
            return np.frombuffer(columns[prefix + name], kind)

        self.block = columns[prefix + "block"]
        self.ids, self.rows = array("ids", np.int64), array("rows", np.int64)
        self.unknown = array("unknown", np.uint8).astype(bool)
        self.parts = array("parts", np.float64).reshape(len(self.rows), columns[prefix + "width"])


def _blocks(batches: Rows):
    for batch in slices(batches, 1):
        yield _Block(batch.to_pylist()[0])


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of whole-numbered rows; missing components count as zero."""
    width = min(a.shape[1], b.shape[1])
    a, b = a[:, :width], b[:, :width]
    with np.errstate(over="ignore"):
        bound = np.abs(a).sum(axis=1).max(initial=0.0) * np.abs(b).max(initial=0.0)
    if bound < _EXACT:
        return (a @ b.T).astype(np.int64)
    left, right = ([[int(v) for v in row] for row in m] for m in (a, b))
    return np.array([[max(-EDGE, min(EDGE, sum(map(int.__mul__, x, y)))) for y in right] for x in left],
                    np.int64).reshape(len(a), len(b))


def _scored(batches: Rows, wanted: str):
    """Per pair of blocks and tile: the row block, the query block, the positions of the tile's
    queries, their state and their scores, with the mask of pairs that count."""
    for batch in slices(batches, 1):
        columns = batch.to_pylist()[0]
        rows, queries = _Block(columns), _Block(columns, "q_")
        state = {n: np.array([s[n] for s in columns["state"]], np.int64)
                 for n in _WINDOW}
        own = np.argsort(rows.rows)
        for start in range(0, len(state["pos"]), TILE):
            tile = {n: v[start:start + TILE] for n, v in state.items()}
            open_ = tile["step"] > 0 if wanted == "open" else tile["step"] == 0
            tile = {n: v[open_] for n, v in tile.items()}
            if not len(tile["pos"]):
                continue
            counted = np.ones((len(tile["pos"]), len(rows.rows)), bool)
            place = np.searchsorted(rows.rows[own], queries.rows[tile["pos"]])
            for i, p in enumerate(place):
                if p < len(own) and rows.rows[own[p]] == queries.rows[tile["pos"][i]]:
                    counted[i, own[p]] = False
            yield rows, queries, tile, inner_products(queries.parts[tile["pos"]], rows.parts), counted


def _histograms(k: int, bins: int):
    """Counts per step of each query's window, from the highest step down to the one in which
    this block of rows alone has enough: the k-th value of all rows is never below it."""
    def count(batches: Rows) -> Rows:
        for _, queries, tile, score, counted in _scored(batches, "open"):
            step = (score - tile["low"][:, None]) // tile["step"][:, None]
            counted &= (step >= 0) & (score < tile["low"][:, None] + tile["span"][:, None])
            flat = (step + np.arange(len(step))[:, None] * bins)[counted]
            n = np.bincount(flat, minlength=len(step) * bins).reshape(len(step), bins)
            higher = n[:, ::-1].cumsum(axis=1)[:, ::-1] - n
            q, at = np.nonzero((n > 0) & (higher < (k - tile["above"])[:, None]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(q), queries.block, np.int64)), pa.array(tile["pos"][q].astype(np.int32)),
                 pa.array(at.astype(np.int32)), pa.array(n[q, at].astype(np.int64))],
                names=["q_block", "pos", "bin", "n"])

    return count


def _chosen(k: int):
    """Scores above the k-th value, and the first of those at it that are still wanted."""
    def choose(batches: Rows) -> Rows:
        for rows, queries, tile, score, counted in _scored(batches, "done"):
            kth = tile["low"][:, None]
            tie = counted & (score == kth)
            tie &= tie.cumsum(axis=1) <= (k - tile["above"])[:, None]
            q, c = np.nonzero(tie | (counted & (score > kth)))
            pos = tile["pos"][q]
            yield pa.RecordBatch.from_arrays(
                [pa.array(queries.rows[pos]), pa.array(queries.ids[pos]), pa.array(rows.rows[c]),
                 pa.array(rows.ids[c], mask=rows.unknown[c]), pa.array(score[q, c])],
                names=["q_row", "query_id", "row", "vec_id", "score"])

    return choose


def _first_windows(bins: int):
    """Per query the window that holds every score it can have: the sum of its components'
    sizes times the largest component of all rows, on both sides of zero."""
    def window(batches: Rows) -> Rows:
        for batch in slices(batches, 1):
            columns = batch.to_pylist()[0]
            block = _Block(columns)
            with np.errstate(over="ignore"):
                reach = np.abs(block.parts).sum(axis=1) * columns["bound"] * (1 + 1e-9) + 1
            reach = [int(min(r, EDGE)) for r in reach]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.block] * len(reach), pa.int64()), pa.array(range(len(reach)), pa.int32()),
                 pa.array([-r for r in reach], pa.int64()),
                 pa.array([2 * r + 1 for r in reach], pa.int64()),
                 pa.array([-(-(2 * r + 1) // bins) for r in reach], pa.int64()),
                 pa.array([0] * len(reach), pa.int64())], names=["q_block", *_WINDOW])

    return window


_STATE = "q_block long, pos int, low long, span long, step long, above long"


def _refined(state: DataFrame, counts: DataFrame, k: int, bins: int) -> DataFrame:
    """The windows after a pass. A step of 0 says that ``low`` is the k-th value; a query with
    fewer than k rows in all gets a value below every score."""
    upto = (Window.partitionBy("q_block", "pos").orderBy(F.desc("bin"))
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = counts.withColumn("higher", F.sum("n").over(upto) - F.col("n"))
    hit = ranked.join(state, ["q_block", "pos"]).where(
        (F.col("above") + F.col("higher") < k) & (F.col("above") + F.col("higher") + F.col("n") >= k)).select(
        "q_block", "pos", "bin", "higher")
    joined = state.join(hit, ["q_block", "pos"], "left")
    open_, found = F.col("step") > 0, F.col("bin").isNotNull()

    def pick(refined: Column, missing: Column, name: str) -> Column:
        return F.when(open_ & found, refined).when(open_, missing).otherwise(F.col(name)).cast("long").alias(name)

    finer = F.when(F.col("step") == 1, F.lit(0)).otherwise(F.expr(f"(step + {bins - 1}) div {bins}"))
    return joined.select(
        "q_block", "pos", pick(F.col("low") + F.col("bin") * F.col("step"), F.lit(-2 * EDGE), "low"),
        pick(F.col("step"), F.lit(0), "span"), pick(finer, F.lit(0), "step"), pick(F.col("above") + F.col("higher"), F.lit(0), "above"))


def top_vectors(vectors: DataFrame, k: int = 5, every: int = 50, bins: int = 1_024) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows with the highest inner product for each
    row of ``(vec_id, embedding)`` whose vec_id is divisible by ``every``.

    Components count as floor(256 x). A vector that is null or holds a null or non-finite
    component takes no part; of vectors of different lengths, the missing components count as
    zero, so an empty vector scores 0. Every other row is a candidate, copies included. Equal
    scores stand by ascending vec_id, a null vec_id last. Rows that share a vec_id are rows of
    their own: each of them is a query with a list of its own, and a candidate for the other. A
    query with fewer than ``k`` candidates gets them all. Scores beyond +-2^61 are reported and
    ranked as that limit. An empty table gives no rows.

    Queries meet rows in blocks, which Spark broadcasts or pairs up by their measured size; no
    row meets another outside of them. What leaves a task are counts of at most ``k`` steps per
    query and block, and the rows of the last pass.
    """
    rows = written(row_blocks(vectors), "vector-rows")
    queries = written(query_blocks(rows, every), "vector-queries")
    bound = rows.agg(F.coalesce(F.max("largest"), F.lit(0.0)).alias("bound"))
    state = written(queries.crossJoin(F.broadcast(bound)).mapInArrow(_first_windows(bins), _STATE), "windows")
    named = queries.select("block", *[F.col(c).alias(f"q_{c}") for c in queries.columns])

    def met(state: DataFrame) -> DataFrame:
        held = state.groupBy(F.col("q_block").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct(*_WINDOW))).alias("state"))
        # The stated query set against all rows, block by block.
        return rows.crossJoin(named.join(held, "block").drop("block"))

    while not state.where("step > 0").isEmpty():
        counts = met(state).mapInArrow(_histograms(k, bins), "q_block long, pos int, bin int, n long")
        total = written(counts.groupBy("q_block", "pos", "bin").agg(F.sum("n").alias("n")), "score-counts")
        state = written(_refined(state, total, k, bins), "windows")
    chosen = met(state).mapInArrow(_chosen(k), "q_row long, query_id long, row long, vec_id long, score long")
    order = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (chosen.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
