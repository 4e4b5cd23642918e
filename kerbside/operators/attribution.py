"""Per-row feature attribution of tree ensembles (path-dependent Shapley values).

Each leaf is a box in feature space: an interval per feature on its path, and the share of
training weight that follows the path when that feature is unknown. A row either lies in a
feature's interval (o = 1) or not (o = 0), so all a leaf needs to know of a row is the bit mask
of the features it satisfies. For a leaf of value v and shares z, feature i gets
v * (o_i - z_i) * integral over t in [0, 1] of prod_{j != i} (z_j (1 - t) + o_j t).
The integrand is a polynomial whose degree is below the number of features, so a small
Gauss-Legendre rule is exact. It is worked out once per leaf and mask that occurs among the rows
of a batch; every (row, leaf) is then one look-up in that table.

Boxes are compiled where the node table lies, a tree per group; rows never move.
"""

from __future__ import annotations

import math
import weakref
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from kerbside.functions import columns as C
from kerbside.schema import AWAY, LABELS, MODEL_FEATURES, STRONG, TOWARD, WEAK
from kerbside.sources.scratch import scratch_path, written

# Leaves broadcast at once: with eleven features about 60 MB.
MAX_LEAVES = 200_000

# Leaves in one row of the box table, so that a tree of any size is cut.
CHUNK_LEAVES = 2_048

# Leaves times masks that are addressed directly.
DIRECT_CODES = 1 << 24

# Cells of a grid, and rows of a group from which on a grid is less work than row by row.
MAX_CELLS, GRID_ROWS = 1 << 19, 50

_NODES = "tree int, id int, left_id int, right_id int, feature int, threshold double, cover double, value array<double>"
_BOXES = "tree int, chunk int, n int, lo binary, hi binary, share binary, value binary"


# Where a model's saved form lies already.
SAVED: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()


def forest_nodes(spark: SparkSession, model) -> DataFrame:
    """Node table of a fitted Spark forest: the model's own saved form, read back as a table. A
    node's value is its class distribution times the tree's share of all tree weights."""
    path = SAVED.get(model)
    if path is None:
        path = scratch_path(spark, "trees")
        model.write().save(path)
    n, total = "nodeData", float(sum(model.treeWeights))
    weights = F.array(*[F.lit(w / total) for w in model.treeWeights])  # one per tree
    cover = F.aggregate(f"{n}.impurityStats", F.lit(0.0), lambda a, v: a + v)
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"), F.col(f"{n}.id").alias("id"), F.col(f"{n}.leftChild").alias("left_id"),
        F.col(f"{n}.rightChild").alias("right_id"), F.col(f"{n}.split.featureIndex").alias("feature"),
        F.try_element_at(f"{n}.split.leftCategoriesOrThreshold", F.lit(1)).alias("threshold"), cover.alias("cover"),
        F.transform(f"{n}.impurityStats", lambda v: v / cover * F.element_at(weights, F.col("treeID") + 1)).alias("value"))


def boosted_nodes(spark: SparkSession, model) -> DataFrame:
    """Node table of a ``boosting.BoostedModel``. Values are raw scores of the tree's class."""
    leaf = F.col("feature") < 0
    return model.node_table(spark).select(
        (F.col("round") * len(LABELS) + F.col("class")).alias("tree"), F.col("node").alias("id"),
        F.when(leaf, -1).otherwise(2 * F.col("node") + 1).alias("left_id"),
        F.when(leaf, -1).otherwise(2 * F.col("node") + 2).alias("right_id"), "feature", "threshold", "cover",
        F.array(*[F.when(F.col("class") == c, F.col("value")).otherwise(F.lit(0.0)) for c in range(len(LABELS))])
        .alias("value"))


def tree_boxes(nodes: dict[int, tuple], n_features: int) -> dict[str, np.ndarray]:
    """Interval bounds, path shares and values of the leaves of one tree; ``nodes`` maps an id
    to (left, right, feature, threshold, cover, value)."""
    lo, hi, share, value = [], [], [], []
    stack = [(0, np.full(n_features, -np.inf), np.full(n_features, np.inf), np.ones(n_features))]
    while stack:
        node_id, low, high, shares = stack.pop()
        left, right, f, threshold, cover, leaf = nodes[node_id]
        if left < 0:
            lo.append(low), hi.append(high), share.append(shares), value.append(leaf)
            continue
        for child, goes_left in ((left, True), (right, False)):
            low2, high2, shares2 = low.copy(), high.copy(), shares.copy()
            if goes_left:
                high2[f] = min(high2[f], threshold)
            else:
                low2[f] = max(low2[f], threshold)
            shares2[f] *= nodes[child][4] / cover
            stack.append((child, low2, high2, shares2))
    return {"lo": np.array(lo), "hi": np.array(hi), "share": np.array(share), "value": np.array(value, float)}


def leaf_boxes(nodes: DataFrame, n_features: int, chunk: int = CHUNK_LEAVES) -> DataFrame:
    """The boxes of all trees, some leaves of a tree per row. A tree is compiled by one task: its
    nodes are bounded by the depth and the rows of the fit."""
    def compile_trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        tree = None

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            boxes = tree_boxes(held, n_features)
            for i, start in enumerate(range(0, len(boxes["lo"]), chunk)):
                part = {k: np.ascontiguousarray(v[start:start + chunk]) for k, v in boxes.items()}
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], t) for v, t in [
                        (tree, pa.int32()), (i, pa.int32()), (len(part["lo"]), pa.int32()),
                        *[(part[k].tobytes(), pa.binary()) for k in ("lo", "hi", "share", "value")]]],
                    names=[c.split()[0] for c in _BOXES.split(", ")])

        for batch in batches:
            columns = [batch.column(c.split()[0]).to_pylist() for c in _NODES.split(", ")]
            for t, node_id, *rest in zip(*columns):
                if t != tree:
                    yield from flush()
                    held.clear()
                    tree = t
                held[node_id] = tuple(rest)
        yield from flush()

    return (nodes.select(*[c.split()[0] for c in _NODES.split(", ")]).repartition("tree").sortWithinPartitions("tree")
            .mapInArrow(compile_trees, _BOXES))


def box_arrays(row) -> dict[str, np.ndarray]:
    """The arrays of one row of the box table."""
    return {k: np.frombuffer(row[k]).reshape(row.n, -1) for k in ("lo", "hi", "share", "value")}


def box_parts(boxes: DataFrame, max_leaves: int = MAX_LEAVES) -> Iterator[list[dict[str, np.ndarray]]]:
    """Lists of boxes with at most ``max_leaves`` leaves in all (or a single row of the table)."""
    held, size = [], 0
    for row in boxes.orderBy("tree", "chunk").toLocalIterator():
        if held and size + row.n > max_leaves:
            yield held
            held, size = [], 0
        held.append(box_arrays(row))
        size += row.n
    if held:
        yield held


def expected_value(part: list[dict[str, np.ndarray]]) -> np.ndarray:
    """Model output with every feature unknown."""
    return sum((b["value"] * b["share"].prod(axis=1)[:, None]).sum(axis=0) for b in part)


def mask_weights(share: np.ndarray, satisfied: np.ndarray) -> np.ndarray:
    """Weight of each feature, for a leaf of value 1, per pair of path shares and mask."""
    n_features = share.shape[1]
    nodes, weights = np.polynomial.legendre.leggauss(n_features // 2 + 1)
    kept = np.zeros(share.shape)
    for t, w in zip((nodes + 1) / 2, weights / 2):
        factors = share * (1 - t) + satisfied * t
        kept += w * factors.prod(axis=1, keepdims=True) / factors
    return kept * (satisfied - share)


class LeafTable:
    """The leaves of one row of the box table, ready to give masks and look up weights."""

    def __init__(self, boxes: dict[str, np.ndarray]):
        self.share, self.value = boxes["share"], boxes["value"]
        n, n_features = self.share.shape
        lo, hi = boxes["lo"], boxes["hi"]
        used = np.isfinite(lo) | np.isfinite(hi)
        place = np.cumsum(used, axis=1) - 1
        self.width = int(used.sum(axis=1).max(initial=0))
        self.place = np.where(used, place, -1)
        # Per feature its thresholds and, for each interval between them, the bit of every leaf.
        self.features = []
        for f in np.flatnonzero(used.any(axis=0)):
            edges = np.unique(np.concatenate((lo[:, f], hi[:, f])))
            edges = edges[np.isfinite(edges)]
            above = np.arange(len(edges) + 1)[:, None]
            inside = (above > np.searchsorted(edges, lo[:, f], side="right") - 1) & (above <= np.searchsorted(edges, hi[:, f]))
            bit = np.where(used[:, f], 1 << np.maximum(place[:, f], 0), 0)
            self.features.append((f, edges, np.where(inside, bit, 0).astype(np.int64)))

    def masks(self, x: np.ndarray) -> np.ndarray:
        """(rows, leaves): bit i tells whether the i-th feature on the leaf's path is satisfied."""
        out = np.zeros((len(x), len(self.share)), np.int64)
        for f, edges, bits in self.features:
            out += bits[np.searchsorted(edges, x[:, f])]
        return out

    def add(self, x: np.ndarray, out: np.ndarray, rows_at_once: int = 64) -> None:
        """Add the leaves' attributions to ``out``, shaped (rows, features, outputs)."""
        n = len(self.share)
        code = self.masks(x)
        code += np.arange(n) << self.width
        if n << self.width <= DIRECT_CODES:
            occurs = np.zeros(n << self.width, bool)
            occurs[code.ravel()] = True
            codes = np.flatnonzero(occurs)
            at = np.zeros(len(occurs), np.int32)
            at[codes] = np.arange(len(codes))
            at = at[code]
        else:  # many features: the codes are sorted instead of addressed
            codes, at = np.unique(code, return_inverse=True)
            at = at.reshape(code.shape)
        leaf, mask = codes >> self.width, codes & ((1 << self.width) - 1)
        place = self.place[leaf]
        # A feature that is not on the path has share 1 and counts as satisfied: weight 0.
        satisfied = np.where(place >= 0, (mask[:, None] >> np.maximum(place, 0)) & 1, 1).astype(float)
        weights = mask_weights(self.share[leaf], satisfied)
        for start in range(0, len(x), rows_at_once):
            found = weights[at[start:start + rows_at_once]]
            out[start:start + rows_at_once] += np.matmul(found.transpose(0, 2, 1), self.value)


def shapley(x: np.ndarray, part: list[dict[str, np.ndarray]]) -> np.ndarray:
    """Attributions with shape (rows, features, outputs)."""
    out = np.zeros((*x.shape, part[0]["value"].shape[1]))
    for boxes in part:
        LeafTable(boxes).add(x, out)
    return out


class GridTable:
    """The leaves of a part, for rows that are alike in all features but a few with many thresholds.

    For such rows a leaf's attribution depends on the intervals between thresholds that a row's
    values lie in along these few axes, as a sum of products of one step function per axis. So
    leaves add their steps to the cells of a grid, and running sums along the axes give the value in
    every cell: the work for a group of rows is that of leaves and cells, whatever its rows.
    """

    def __init__(self, part: list[dict[str, np.ndarray]]):
        lo, hi, self.share, self.value = (np.concatenate([b[k] for b in part]) for k in ("lo", "hi", "share", "value"))
        n, n_features = self.share.shape
        self.edges, self.axes, self.rest = grid_axes(part)
        spans = [interval_spans(lo[:, f], hi[:, f], self.edges[f]) for f in range(n_features)]
        self.first, self.last = (np.stack([s[i] for s in spans], axis=1) for i in (0, 1))
        used = np.isfinite(lo) | np.isfinite(hi)
        points, weights = np.polynomial.legendre.leggauss(int(used.sum(axis=1).max(initial=0)) // 2 + 1)
        self.t, self.w = (points + 1) / 2, weights / 2
        self.shape = [len(self.edges[f]) + 1 for f in self.axes]
        # Steps of a leaf along an axis: 0 at the start, 1 up where its interval begins, 2 down past its end.
        steps = [(np.zeros(n, int), self.first[:, f], self.last[:, f] + 1) for f in self.axes]
        there = [(np.ones(n, bool), (self.first[:, f] > 0) & (self.first[:, f] < size), self.last[:, f] + 1 < size)
                 for f, size in zip(self.axes, self.shape)]
        entry, cell, sign = [], [], []
        for kind in np.ndindex(*[3] * len(self.axes)):
            leaves = np.flatnonzero(np.all([there[j][k] for j, k in enumerate(kind)], axis=0)) if kind else np.arange(n)
            place = np.zeros(len(leaves), np.int64)
            for j, k in enumerate(kind):
                place = place * self.shape[j] + steps[j][k][leaves]
            moved = sum(1 << j for j, k in enumerate(kind) if k)
            entry.append(leaves + n * moved), cell.append(place), sign.append(-(sum(k == 2 for k in kind) % 2))
        order = sorted(range(len(entry)), key=lambda k: sign[k])  # steps down come first
        self.entry, self.cell = (np.concatenate([v[k] for k in order]) for v in (entry, cell))
        self.n_down = sum(len(e) for e, down in zip(entry, sign) if down)
        self._axis_factors(n)

    def _axis_factors(self, n: int) -> None:
        """Per set of axes with a step, leaf and t: the product over axes, as it is and with one axis
        replaced by its own weight (satisfied or not, less its share)."""
        z, t = self.share[:, self.axes], self.t
        starts = (self.first[:, self.axes] == 0).astype(float)
        plain = [(z[:, j, None] * (1 - t) + starts[:, j, None] * t, np.broadcast_to(t, (n, len(t)))) for j in range(len(self.axes))]
        own = [(np.repeat((starts - z)[:, j, None], len(t), axis=1), np.ones((n, len(t)))) for j in range(len(self.axes))]
        sets = 1 << len(self.axes)
        self.both = np.ones((sets, 1 + len(self.axes), n, len(t)))
        for s in range(sets):
            for j in range(len(self.axes)):
                moved = s >> j & 1
                for i in range(1 + len(self.axes)):
                    self.both[s, i] *= (own if i == j + 1 else plain)[j][moved]

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(self.edges)], axis=1)

    def add(self, bins: np.ndarray, out: np.ndarray) -> None:
        """Attributions of rows that lie in the same intervals of all features but the axes."""
        z = self.share[:, self.rest]
        inside = ((self.first <= bins[0]) & (bins[0] <= self.last))[:, self.rest].astype(float)
        factors = z[:, :, None] * (1 - self.t) + inside[:, :, None] * self.t
        known = factors.prod(axis=1) * self.w
        found = np.empty(len(self.entry))
        cells = np.zeros(len(bins), np.int64)
        for f, size in zip(self.axes, self.shape):
            cells = cells * size + bins[:, f]
        for place, f in enumerate([*self.rest, *self.axes]):
            if place < len(self.rest):
                # A feature that is not on the path has share 1 and counts as satisfied: weight 0.
                weight = known * ((inside - z)[:, place, None] / factors[:, place])
                which = 0
            else:
                weight, which = known, 1 + place - len(self.rest)
            steps = np.einsum("snt,nt->sn", self.both[:, which], weight)
            for c in np.flatnonzero(self.value.any(axis=0)):
                np.take((steps * self.value[:, c]).ravel(), self.entry, out=found, mode="clip")
                np.negative(found[:self.n_down], out=found[:self.n_down])
                grid = np.bincount(self.cell, found, math.prod(self.shape)).reshape(self.shape)
                for axis in range(len(self.shape)):
                    np.cumsum(grid, axis=axis, out=grid)
                out[:, f, c] += grid.ravel()[cells]


def interval_spans(lo: np.ndarray, hi: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last interval between thresholds that each box admits."""
    first = np.where(np.isneginf(lo), 0, np.searchsorted(edges, lo, side="right"))
    return np.where(np.isposinf(lo), len(edges) + 1, first), np.searchsorted(edges, hi)


def grid_axes(part: list[dict[str, np.ndarray]]) -> tuple[list[np.ndarray], list[int], list[int]]:
    """Thresholds per feature, the features with most of them whose cells make a grid of bounded
    size (at most three), and the other features."""
    lo, hi = (np.concatenate([b[k] for b in part]) for k in ("lo", "hi"))
    edges = []
    for f in range(lo.shape[1]):
        found = np.unique(np.concatenate((lo[:, f], hi[:, f])))
        edges.append(found[np.isfinite(found)])
    axes: list[int] = []
    cells = 1
    for f in sorted(range(len(edges)), key=lambda f: -len(edges[f])):
        if len(axes) < 3 and cells * (len(edges[f]) + 1) <= MAX_CELLS:
            axes.append(f)
            cells *= len(edges[f]) + 1
    return edges, axes, [f for f in range(len(edges)) if f not in axes]


def grouped_shapley(x: np.ndarray, part: list[dict[str, np.ndarray]], table: GridTable,
                    rows_at_once: int = 4_096, least: int = GRID_ROWS) -> np.ndarray:
    """As ``shapley``; groups of at least ``least`` rows, alike in all but the axes, by their grid."""
    out = np.zeros((*x.shape, table.value.shape[1]))
    bins = table.bins(x)
    order = np.lexsort([np.zeros(len(x)), *[bins[:, f] for f in table.rest]])
    turns = np.flatnonzero((np.diff(bins[order][:, table.rest], axis=0) != 0).any(axis=1)) + 1
    few = []
    for rows in np.split(order, turns):
        if len(rows) < least:
            few.append(rows)
            continue
        held = np.zeros((len(rows), *out.shape[1:]))
        table.add(bins[rows], held)
        out[rows] = held
    rest = np.concatenate(few) if few else np.zeros(0, int)
    for start in range(0, len(rest), rows_at_once):
        rows = rest[start:start + rows_at_once]
        out[rows] = shapley(x[rows], part)
    return out


def attribute(df: DataFrame, part: list[dict[str, np.ndarray]], keep: list[str],
              features: list[str] = MODEL_FEATURES, rows_at_once: int = 32_768) -> DataFrame:
    """Add ``attribution``: one array over features per output, in feature order.

    Rows are dealt and sorted so that those alike in the features with few thresholds lie together;
    large groups are cut. Each task works through some rows at a time. ``part`` has bounded size
    (``box_parts``).
    """
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(part)
    names = [f"_f{i}" for i in range(len(features))]
    edges, _, rest = grid_axes(part)

    def below(f: int) -> Column:  # thresholds below the value
        return F.aggregate(F.array(*[F.lit(float(e)) for e in edges[f]]), F.lit(0),
                           lambda n, e: n + (F.col(names[f]) > e).cast("int")) if len(edges[f]) else F.lit(0)

    wanted = df.select(*keep, *[F.col(f).cast("double").alias(n) for n, f in zip(names, features)])
    dealt = (wanted.withColumn("_group", F.array(*[below(f) for f in rest], F.lit(0)))
             .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), "_group", F.xxhash64(*names))
             .sortWithinPartitions("_group").drop("_group"))
    kept = ", ".join(f"`{n}` {t}" for n, t in wanted.dtypes if n in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = GridTable(shared.value)
        held, size = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks()
            x = np.stack([rows.column(n).to_numpy() for n in names], axis=1)
            values = grouped_shapley(x, shared.value, table).transpose(0, 2, 1)  # rows, outputs, features
            n, outputs, width = values.shape
            inner = pa.ListArray.from_arrays(pa.array(np.arange(n * outputs + 1) * width, pa.int32()),
                                             pa.array(np.ascontiguousarray(values).ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * outputs, pa.int32()), inner)
            yield from rows.select(keep).append_column("attribution", lists).to_batches()

        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= rows_at_once:
                yield from flush()
                held, size = [], 0
        if size:
            yield from flush()

    return dealt.mapInArrow(run, f"{kept}, attribution array<array<double>>")


def attribute_ensemble(df: DataFrame, nodes: DataFrame, keep: list[str], features: list[str] = MODEL_FEATURES,
                       max_leaves: int = MAX_LEAVES) -> tuple[DataFrame, np.ndarray]:
    """Attributions of a whole ensemble of any size, and the output with every feature unknown.

    Attributions add up over leaves, so a large ensemble is worked through in parts of bounded
    size, each adding to the table the previous part has written.
    """
    boxes = written(leaf_boxes(nodes, len(features)), "boxes")
    out, base = None, 0.0
    columns = list(dict.fromkeys([*keep, *features]))
    for part in box_parts(boxes, max_leaves):
        base = base + expected_value(part)
        if out is None:
            out = attribute(df, part, columns, features)
            continue
        total = written(out, "attribution").withColumnRenamed("attribution", "_sum")
        added = F.zip_with("_sum", "attribution",
                           lambda a, b: F.zip_with(a, b, lambda p, q: p + q))
        out = (attribute(total, part, [*columns, "_sum"], features)
               .select(*columns, added.alias("attribution")))
    if out is None:
        raise ValueError("the model has no trees")
    return out.select(*keep, "attribution"), base


def top_attributions(df: DataFrame, key: list[str], features: list[str] = MODEL_FEATURES,
                     top: int = 11, explained: int = 5) -> DataFrame:
    """Largest attributions of the predicted class per row, with a sentence for the first few.

    ``df`` has ``attribution``, ``prediction`` and the feature columns. Ranking sorts an
    array inside the row, so nothing is shuffled.
    """
    values = F.element_at("attribution", F.col("prediction") + 1)
    items = F.array(*[F.struct(
        (-F.abs(F.element_at(values, i + 1))).alias("order"), F.lit(i).alias("position"),
        F.lit(f).alias("feature"), F.col(f).cast("double").alias("feature_value"),
        F.element_at(values, i + 1).alias("value")) for i, f in enumerate(features)])
    best = F.slice(F.array_sort(items), 1, top)
    label = C.label_name("prediction")
    strength = F.when(F.abs("item.value") > 0.1, STRONG).otherwise(WEAK)
    direction = F.when(F.col("item.value") > 0, TOWARD).otherwise(AWAY)
    text = F.format_string("%s = %.2f: %s %s %s (%+.4f)", "item.feature", "item.feature_value",
                           strength, direction, label, "item.value")
    return (df.select(*key, "prediction", F.posexplode(best).alias("pos", "item"))
            .select(*key, (F.col("pos") + 1).alias("rank"), label.alias("predicted_label"),
                    F.col("item.feature").alias("feature"),
                    F.col("item.value").alias("value"),
                    F.when(F.col("pos") < explained, text).alias("explanation")))
