"""Random forest on all labelled rows: the rows are binned once, every tree sees all its rows.

Thresholds come from all rows (``value_edges``), and rows are packed into blocks of bins, a dozen
bytes a row. While a node has more than ``MAX_ROWS`` rows, each level of all trees is one pass over
the blocks, whose sums meet per node in one task. A node with fewer rows is finished by one task:
its rows are dealt to that task, some trees at a time, and the subtree is grown in memory. Only
splits of the large nodes reach the driver before the forest is whole.

How often a row takes part in a tree is drawn by a hash of row and tree, and sums are whole numbers,
so neither the layout of the rows nor the order of tasks shows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.operators import attribution
from kerbside.operators.boosting import BLOCK_ROWS, bin_edges, mixed
from kerbside.operators.split import class_weights
from kerbside.schema import LABELS
from kerbside.sources.scratch import scratch_path, written

#: Rows of a node, draws counted, up to which one task finishes its subtree (some 100 MB).
MAX_ROWS = 1 << 22

#: Rows, draws counted, that are dealt to tasks at once: about 1 GB of shuffled bytes.
WAVE_ROWS = 128_000_000

# Nodes and rows whose sums are worked out at once.
NODES_AT_ONCE, ROWS_AT_ONCE = 2_048, 1 << 18

# A gain below this is the noise of its sums.
LEAST_GAIN = 1e-12

# Poisson(1): how often a row is drawn for a tree.
_DRAWS = np.cumsum([np.exp(-1.0) / float(np.prod(range(1, k + 1))) for k in range(16)])

_BLOCK = "bins binary, label binary, ticket binary"
_NODE = ("tree int, id int, prediction double, impurity double, stats array<double>, n long, gain double, left int, "
         "right int, feature int, threshold double")


@dataclass(frozen=True)
class Plan:
    """What every task of a fit needs to know; ``weights`` and ``sizes`` (rows) are those of the classes."""

    trees: int
    depth: int
    min_leaf: int
    seed: int
    n_bins: int
    n_features: int
    weights: np.ndarray
    sizes: np.ndarray

    @property
    def n_picked(self) -> int:
        """Features a node may choose from."""
        return int(np.ceil(np.sqrt(self.n_features)))

    def picked(self, nodes: int, *stream: int) -> np.ndarray:
        """For each node of a level the features it may choose from, in order."""
        keys = np.random.default_rng([self.seed, *stream]).random((nodes, self.n_features))
        return np.sort(np.argsort(keys, axis=1)[:, :self.n_picked], axis=1)

    def draws(self, ticket: np.ndarray, tree: int) -> np.ndarray:
        """How often each row takes part in a tree; once if there is only one tree."""
        if self.trees == 1:
            return np.ones(len(ticket), np.uint8)
        return np.searchsorted(_DRAWS[:-1], mixed(ticket, tree, self.seed), side="right").astype(np.uint8)


@dataclass
class Head:
    """The nodes of a tree with too many rows for one task: parallel lists, the root first. A child
    that one task finishes is ~slot."""

    feature: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    gain: list[float] = field(default_factory=list)
    counts: list[np.ndarray] = field(default_factory=list)
    root: int = 0

    def place(self, bins: np.ndarray) -> np.ndarray:
        """The node, or ~slot, in which each row ends."""
        at = np.full(len(bins), self.root)
        if not self.feature:
            return at
        feature, cut, left, right = (np.array(v) for v in (self.feature, self.bin, self.left, self.right))
        while True:
            rows = np.flatnonzero((at >= 0) & (feature[np.maximum(at, 0)] >= 0))
            if not len(rows):
                return at
            node = at[rows]
            at[rows] = np.where(bins[rows, feature[node]] <= cut[node], left[node], right[node])


def value_edges(df: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Thresholds per feature, from all rows: between any two neighbouring values of a feature that
    has at most ``bins`` of them, else approximate quantiles."""
    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = [np.zeros(0)] * len(features)
        for batch in batches:
            for f in range(len(features)):
                if len(held[f]) <= bins:
                    values = batch.column(f).to_numpy(zero_copy_only=False)
                    held[f] = np.unique(np.concatenate((held[f], values)))[:bins + 1]
        for f, values in enumerate(held):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), f, np.int32)), pa.array(values)],
                                             names=["feature", "value"])

    doubles = df.select(*[F.col(f).cast("double").alias(f) for f in features])
    rows = doubles.mapInArrow(seen, "feature int, value double").distinct().collect()
    values = [np.unique([r.value for r in rows if r.feature == f]) for f in range(len(features))]
    many = [f for f, v in zip(features, values) if len(v) > bins]
    quantiles = dict(zip(many, bin_edges(df, many, bins) if many else []))
    return [quantiles[f] if f in quantiles else (v[:-1] + v[1:]) / 2 for f, v in zip(features, values)]


def row_blocks(df: DataFrame, features: list[str], edges: list[np.ndarray]) -> DataFrame:
    """Rows as blocks of bins. A row's bin is the number of thresholds below its value."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                bins = np.stack([np.searchsorted(e, part.column(i).to_numpy(zero_copy_only=False)).astype(np.uint8)
                                 for i, e in enumerate(edges)], axis=1)
                if any(part.column(i).null_count or np.isnan(part.column(i).to_numpy(zero_copy_only=False)).any()
                       for i in range(len(edges))):
                    raise ValueError("a row has a feature without a value")
                arrays = (bins, part.column("label").to_numpy().astype(np.uint8), part.column("ticket").to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in arrays],
                                                 names=["bins", "label", "ticket"])

    return df.select(*[F.col(f).cast("double").alias(f) for f in features], F.col("label").cast("int").alias("label"),
                     F.xxhash64(*df.columns).alias("ticket")).mapInArrow(pack, _BLOCK)


def _arrays(row, n_features: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    label = np.frombuffer(row["label"], np.uint8)
    return (np.frombuffer(row["bins"], np.uint8).reshape(len(label), n_features), label,
            np.frombuffer(row["ticket"], np.uint64))


# --- splits ----------------------------------------------------------------------------


def class_sums(bins: np.ndarray, label: np.ndarray, count: np.ndarray, node: np.ndarray, picked: np.ndarray,
               n_bins: int) -> np.ndarray:
    """Draws per class, node, picked feature and bin; ``node`` is a row's place in ``picked``."""
    nodes, k = picked.shape
    shape = (len(LABELS), nodes, k, n_bins)
    out = np.zeros(int(np.prod(shape)))
    for start in range(0, len(bins), ROWS_AT_ONCE):
        part = slice(start, start + ROWS_AT_ONCE)
        at = node[part]
        key = bins[part][np.arange(len(at))[:, None], picked[at]] + (at[:, None] * k + np.arange(k)) * n_bins
        key += (label[part].astype(np.int64) * (nodes * k * n_bins))[:, None]
        out += np.bincount(key.ravel(), np.repeat(count[part], k), len(out))
    return out.reshape(shape)


def best_splits(sums: np.ndarray, total: np.ndarray, weights: np.ndarray,
                min_leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per node the picked feature (-1: none gains), the bin up to which rows go left, the gain in
    weighted Gini impurity and the draws per class on the left. ``total`` has the draws per node and
    class. Equal gains go to the first feature and bin."""
    classes, nodes, k, n_bins = sums.shape
    left = np.cumsum(sums, axis=3)[..., :-1]
    drawn = left.sum(axis=0)
    fits = (drawn >= min_leaf) & (total.sum(axis=1)[:, None, None] - drawn >= min_leaf)
    size = [np.zeros(drawn.shape), np.zeros(drawn.shape)]
    squares = [np.zeros(drawn.shape), np.zeros(drawn.shape)]
    for c in range(classes):
        own = left[c] * weights[c]
        for i, side in enumerate((own, (total[:, c] * weights[c])[:, None, None] - own)):
            size[i] += side
            squares[i] += side * side
    whole = total * weights
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = squares[0] / size[0] + squares[1] / size[1]
    gain -= ((whole ** 2).sum(axis=1) / whole.sum(axis=1))[:, None, None]
    gain /= whole.sum(axis=1)[:, None, None]
    gain = np.where(fits, gain, -np.inf).reshape(nodes, -1)
    best = gain.argmax(axis=1) if n_bins > 1 else np.zeros(nodes, int)
    best_gain = gain[np.arange(nodes), best] if n_bins > 1 else np.full(nodes, -np.inf)
    which, cut = np.divmod(best, max(n_bins - 1, 1))
    found = best_gain > LEAST_GAIN
    on_left = left[:, np.arange(nodes), which, cut].T if n_bins > 1 else np.zeros((nodes, classes))
    return np.where(found, which, -1), cut, np.where(found, best_gain, -1.0), on_left


def _open(counts: np.ndarray, min_leaf: int) -> np.ndarray:
    """Nodes that may have a split: two classes, and enough rows for two sides."""
    return ((counts > 0).sum(axis=1) > 1) & (counts.sum(axis=1) >= 2 * min_leaf)


def grow(bins: np.ndarray, label: np.ndarray, count: np.ndarray, plan: Plan, levels: int, *stream: int) -> dict[str, np.ndarray]:
    """The tree of some rows, level by level: nodes in the order of levels, children side by side
    (``left`` and the one after; -1 for a leaf). Rows are kept in the order of the level's nodes."""
    counts = np.bincount(label, count, len(LABELS))[None]
    order = np.arange(len(bins), dtype=np.int64)
    bounds = np.array([0, len(bins)])
    feature, cut, left, gain, stats = [np.full(1, -1)], [np.zeros(1, int)], [np.full(1, -1)], [np.full(1, -1.0)], [counts]
    opened = np.flatnonzero(_open(counts, plan.min_leaf))
    n_nodes = 1
    for level in range(levels):
        if not len(opened):
            break
        picked = plan.picked(len(opened), *stream, level)
        splits, pieces, sizes = [], [], []
        for a in range(0, len(opened), NODES_AT_ONCE):
            b = min(a + NODES_AT_ONCE, len(opened))
            rows = order[bounds[a]:bounds[b]]
            node = np.repeat(np.arange(b - a), np.diff(bounds[a:b + 1]))
            own = bins[rows]
            sums = class_sums(own, label[rows], count[rows], node, picked[a:b], plan.n_bins)
            which, at, won, on_left = best_splits(sums, counts[opened[a:b]], plan.weights, plan.min_leaf)
            split = which >= 0
            f = picked[np.arange(a, b), np.maximum(which, 0)]
            splits.append((np.where(split, f, -1), at, won, on_left))
            # Rows of split nodes, dealt to the children in order.
            stay = split[node]
            rows, node, own = rows[stay], (np.cumsum(split) - 1)[node[stay]], own[stay]
            went = own[np.arange(len(rows)), f[split][node]] > at[split][node]
            child = 2 * node + went
            size = np.bincount(child, minlength=2 * int(split.sum()))
            starts = np.cumsum(size) - size
            lefts = np.cumsum(~went)
            before = np.concatenate(([0], lefts))[starts[::2]] if len(starts) else np.zeros(0, int)
            place = np.where(went, starts[child] + np.arange(len(rows)) - starts[child - went] - (lefts - before[node]),
                             starts[child] + lefts - 1 - before[node])
            dealt = np.empty_like(rows)
            dealt[place] = rows
            pieces.append(dealt), sizes.append(size)
        f, at, won, on_left = (np.concatenate(v) for v in zip(*splits))
        split = f >= 0
        feature[-1][opened], cut[-1][opened], gain[-1][opened] = f, at, won
        left[-1][opened[split]] = n_nodes + 2 * np.arange(int(split.sum()))
        both = np.stack([on_left[split], counts[opened[split]] - on_left[split]], axis=1).reshape(-1, len(LABELS))
        n_nodes += len(both)
        counts = both
        feature.append(np.full(len(both), -1)), cut.append(np.zeros(len(both), int)), left.append(np.full(len(both), -1))
        gain.append(np.full(len(both), -1.0)), stats.append(both)
        may = _open(both, plan.min_leaf)
        opened = np.flatnonzero(may)
        sizes = np.concatenate(sizes)
        order = np.concatenate(pieces)[np.repeat(may, sizes)]
        bounds = np.concatenate(([0], np.cumsum(sizes[may])))
    return pruned([len(s) for s in stats], {
        "feature": np.concatenate(feature), "bin": np.concatenate(cut), "left": np.concatenate(left),
        "gain": np.concatenate(gain), "stats": np.concatenate(stats)}, plan.weights)


def pruned(level_sizes: list[int], tree: dict[str, np.ndarray], weights: np.ndarray) -> dict[str, np.ndarray]:
    """Leaves side by side with one prediction become one leaf, from the lowest level up."""
    left, guess = tree["left"], (tree["stats"] * weights).argmax(axis=1)
    ends = np.cumsum(level_sizes)
    for start, end in reversed(list(zip(ends - level_sizes, ends))):
        at = start + np.flatnonzero(left[start:end] >= 0)
        child = left[at]
        same = (left[child] < 0) & (left[child + 1] < 0) & (guess[child] == guess[child + 1])
        left[at[same]] = -1
    inner = left >= 0
    tree["feature"][~inner], tree["gain"][~inner] = -1, -1.0
    kept = np.zeros(len(left), bool)
    kept[0] = True
    for start, end in zip(ends - level_sizes, ends):
        at = start + np.flatnonzero(kept[start:end] & inner[start:end])
        kept[left[at]] = kept[left[at] + 1] = True
    moved = np.cumsum(kept) - 1
    tree["left"] = np.where(inner, moved[np.maximum(left, 0)], -1)
    return {k: v[kept] for k, v in tree.items()}


# --- large nodes -----------------------------------------------------------------------


def _level(blocks: RDD, heads: list[Head], opened: list[tuple[int, int]], level: int, plan: Plan) -> list[tuple]:
    """(draws per class, feature, bin, gain, draws on the left) per open node, one pass over the blocks."""
    slots = {node: i for i, node in enumerate(opened)}
    picked = {t: plan.picked(len(heads[t].feature), t, 0, level) for t in {t for t, _ in opened}}

    def count(parts: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        held: dict[int, np.ndarray] = {}
        for bins, label, ticket in parts:
            for tree in picked:
                drawn = plan.draws(ticket, tree)
                at = heads[tree].place(bins)
                for node in np.unique(at[at >= 0]).tolist():
                    rows = np.flatnonzero((at == node) & (drawn > 0))
                    sums = class_sums(bins[rows], label[rows], drawn[rows], np.zeros(len(rows), int),
                                      picked[tree][node:node + 1], plan.n_bins)
                    slot = slots[tree, node]
                    held[slot] = held[slot] + sums if slot in held else sums
        yield from held.items()

    def choose(slot: int, sums: np.ndarray) -> tuple:
        total = sums[:, 0, 0].sum(axis=1)[None]
        which, cut, gain, on_left = best_splits(sums, total, plan.weights, plan.min_leaf)
        tree, node = opened[slot]
        return (slot, total[0], int(picked[tree][node, which[0]]) if which[0] >= 0 else -1, int(cut[0]), float(gain[0]),
                on_left[0])

    parts = min(blocks.getNumPartitions(), len(opened))
    return sorted(blocks.mapPartitions(count).reduceByKey(np.add, parts).map(lambda s: choose(*s)).collect(),
                  key=lambda s: s[0])


def _heads(blocks: RDD, n_rows: int, plan: Plan) -> tuple[list[Head], list[tuple[int, int, int]]]:
    """The nodes above ``MAX_ROWS`` of all trees, and (tree, level, draws) of every node below them."""
    heads = [Head() for _ in range(plan.trees)]
    slots: list[tuple[int, int, int]] = []

    def add(tree: int, level: int, drawn: int) -> int:
        if drawn <= MAX_ROWS or level == plan.depth:
            slots.append((tree, level, drawn))
            return ~(len(slots) - 1)
        head = heads[tree]
        for values, empty in ((head.feature, -1), (head.bin, 0), (head.left, 0), (head.right, 0), (head.gain, -1.0), (head.counts, None)):
            values.append(empty)
        opened.append((tree, len(head.feature) - 1))
        return len(head.feature) - 1

    opened: list[tuple[int, int]] = []
    for tree, head in enumerate(heads):
        head.root = add(tree, 0, n_rows)
    for level in range(plan.depth):
        if not opened:
            break
        splits, known, opened = _level(blocks, heads, opened, level, plan), opened, []
        for slot, total, f, cut, gain, on_left in splits:
            tree, node = known[slot]
            head = heads[tree]
            head.feature[node], head.bin[node], head.gain[node], head.counts[node] = f, cut, gain, total
            if f >= 0:
                head.left[node] = add(tree, level + 1, int(on_left.sum()))
                head.right[node] = add(tree, level + 1, int((total - on_left).sum()))
    return heads, slots


# --- small nodes -----------------------------------------------------------------------


def _waves(slots: list[tuple[int, int, int]], tasks: int) -> Iterator[list[list[int]]]:
    """Slots in the groups that a task each finishes, some groups at a time."""
    cap = min(MAX_ROWS, sum(s[2] for s in slots) // tasks)
    wave, group, wave_rows, group_rows = [], [], 0, 0
    for i, (_, _, drawn) in enumerate(slots):
        if group and group_rows + drawn > cap:
            wave.append(group)
            group, group_rows = [], 0
            if wave_rows + drawn > WAVE_ROWS:
                yield wave
                wave, wave_rows = [], 0
        group.append(i)
        group_rows, wave_rows = group_rows + drawn, wave_rows + drawn
    yield [*wave, group]


def _grown(blocks: RDD, heads: list[Head], slots: list[tuple[int, int, int]], wave: list[list[int]], plan: Plan) -> RDD:
    """The subtrees of a wave, one row of ``_PART`` each, and the shuffled RDD behind them."""
    task = {slot: i for i, group in enumerate(wave) for slot in group}
    trees = sorted({slots[slot][0] for slot in task})

    def deal(parts: Iterator[tuple]) -> Iterator[tuple]:
        for bins, label, ticket in parts:
            for tree in trees:
                drawn = plan.draws(ticket, tree)
                at = heads[tree].place(bins)
                for end in np.unique(at[at < 0]).tolist():
                    rows = np.flatnonzero((drawn > 0) & (at == end)) if ~end in task else ()
                    if len(rows):
                        yield task[~end], (~end, bins[rows].tobytes(), label[rows].tobytes(), drawn[rows].tobytes())

    def finish(parts: Iterator[tuple]) -> Iterator[tuple]:
        held: dict[int, list[tuple]] = {}
        for _, (slot, *arrays) in parts:
            held.setdefault(slot, []).append(arrays)
        for slot in sorted(held):
            bins, label, drawn = (np.frombuffer(b"".join(a[i] for a in held[slot]), np.uint8) for i in range(3))
            del held[slot]
            tree, level, _ = slots[slot]
            grown = grow(bins.reshape(len(label), plan.n_features), label, drawn, plan, plan.depth - level, tree, 1, slot)
            yield (slot, len(grown["left"]), *[bytearray(grown[c].astype(t).tobytes()) for c, t in _TYPES.items()])

    dealt = blocks.mapPartitions(deal).partitionBy(len(wave), int)
    return dealt, dealt.mapPartitions(finish)


_TYPES = {"feature": np.int8, "bin": np.uint8, "left": np.int32, "gain": np.float64, "stats": np.float64}


def _subtrees(blocks: RDD, heads: list[Head], slots: list[tuple[int, int, int]], plan: Plan, spark: SparkSession) -> DataFrame:
    """One row per slot: its nodes as arrays. What a wave shuffled goes when it ends."""
    path = scratch_path(spark, "subtrees")
    schema = "slot int, n int, " + ", ".join(f"{c} binary" for c in _TYPES)
    for wave in _waves(slots, 4 * spark.sparkContext.defaultParallelism):
        dealt, grown = _grown(blocks, heads, slots, wave, plan)
        spark.createDataFrame(grown, schema, verifySchema=False).write.mode("append").parquet(path)
        dealt._jrdd.rdd().cleanShuffleDependencies(True)
    return spark.read.schema(schema).parquet(path)


def _nodes(parts: DataFrame, heads: list[Head], slots: list[tuple[int, int, int]], plan: Plan,
           edges: list[np.ndarray]) -> DataFrame:
    """The nodes of all trees in the columns of ``_NODE``; ids of a tree run from 0, parents first."""
    tops = {r.slot: (r.n, r.stats) for r in parts.select("slot", "n", F.substring("stats", 1, 8 * len(LABELS)).alias("stats"))
            .toLocalIterator()}
    guess = lambda counts: int((counts * plan.weights).argmax())
    offsets: dict[int, tuple[int, int]] = {}
    rows = []
    for tree, head in enumerate(heads):
        if head.root < 0 and ~head.root not in tops:  # of few rows, none was drawn: a leaf of all
            head.root, head.feature, head.bin, head.left, head.right, head.gain = 0, [-1], [0], [0], [0], [-1.0]
            head.counts = [plan.sizes]
        # A leaf's prediction per node or ~slot; nodes whose two leaves agree become a leaf.
        leaf = {}
        for slot in sorted({~v for v in (*head.left, *head.right, head.root) if v < 0}):
            n, stats = tops[slot]
            if n == 1:
                leaf[~slot] = guess(np.frombuffer(stats))
        for node in reversed(range(len(head.feature))):
            a, b = head.left[node], head.right[node]
            if head.feature[node] < 0 or (a in leaf and b in leaf and leaf[a] == leaf[b]):
                leaf[node] = guess(head.counts[node])
        ids, queue = {}, [head.root]
        for at in queue:
            if at >= 0:
                ids[at] = len(ids)
                if at not in leaf:
                    queue += [head.left[at], head.right[at]]
        free = len(ids)
        for at in queue:
            if at < 0:
                ids[at] = free
                offsets[~at] = (tree, free)
                free += tops[~at][0]
        for at in queue:
            if at >= 0:
                is_leaf = at in leaf
                f, stats = head.feature[at], head.counts[at] * plan.weights
                rows.append((tree, ids[at], float(stats.argmax()), _gini(stats[None])[0].item(), stats.tolist(),
                             int(head.counts[at].sum()), -1.0 if is_leaf else head.gain[at],
                             -1 if is_leaf else ids[head.left[at]], -1 if is_leaf else ids[head.right[at]],
                             -1 if is_leaf else f, None if is_leaf else float(edges[f][head.bin[at]])))
    cuts = np.full((plan.n_features, plan.n_bins), np.nan)
    for f, e in enumerate(edges):
        cuts[f, :len(e)] = e

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["slot"] in offsets:
                    yield from _node_batches(row, *offsets[row["slot"]], plan, cuts)

    spark = parts.sparkSession
    found = parts.mapInArrow(spread, _NODE)
    return found.unionByName(spark.createDataFrame(rows, _NODE)) if rows else found


def _gini(stats: np.ndarray) -> np.ndarray:
    return 1.0 - ((stats / stats.sum(axis=1, keepdims=True)) ** 2).sum(axis=1)


def _node_batches(row: dict, tree: int, offset: int, plan: Plan, cuts: np.ndarray, at_once: int = 8_192) -> Iterator[pa.RecordBatch]:
    arrays = {c: np.frombuffer(row[c], t) for c, t in _TYPES.items()}
    counts = arrays["stats"].reshape(row["n"], -1)
    for start in range(0, row["n"], at_once):
        feature, cut, left, gain = (arrays[c][start:start + at_once] for c in ("feature", "bin", "left", "gain"))
        drawn = counts[start:start + at_once]
        stats = drawn * plan.weights
        inner = left >= 0
        ids = offset + np.arange(start, start + len(left))
        lists = pa.ListArray.from_arrays(pa.array(np.arange(0, stats.size + 1, stats.shape[1], dtype=np.int32)), pa.array(stats.ravel()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(left), tree, np.int32)), pa.array(ids.astype(np.int32)),
             pa.array(stats.argmax(axis=1).astype(float)), pa.array(_gini(stats)), lists,
             pa.array(drawn.sum(axis=1).astype(np.int64)), pa.array(gain),
             pa.array(np.where(inner, left + offset, -1).astype(np.int32)),
             pa.array(np.where(inner, left + offset + 1, -1).astype(np.int32)), pa.array(feature.astype(np.int32)),
             pa.array(cuts[np.maximum(feature, 0), cut], mask=~inner)],
            names=[c.split()[0] for c in _NODE.split(", ")])


# --- the whole fit ---------------------------------------------------------------------


def fit(train: DataFrame, features: list[str], trees: int, depth: int, min_leaf: int, bins: int,
        seed: int) -> RandomForestClassificationModel:
    """A Spark forest fitted on all rows of ``features`` and ``label`` (0, 1, 2), with balanced class
    weights; ``features`` are assembled by the caller, in this order."""
    spark = train.sparkSession
    balance = class_weights(train).collect()
    if not balance:
        raise ValueError("no rows to fit a forest on")
    weights, sizes = np.zeros(len(LABELS)), np.zeros(len(LABELS))
    for r in balance:
        weights[int(r.label)], sizes[int(r.label)] = r.weight, r.n_rows
    edges = value_edges(train, features, bins)
    plan = Plan(trees, depth, min_leaf, seed, max(len(e) for e in edges) + 1, len(features), weights, sizes)
    packed = row_blocks(train, features, edges).repartition(spark.sparkContext.defaultParallelism)
    blocks = written(packed, "fit-blocks").rdd.map(lambda row: _arrays(row, plan.n_features))
    heads, slots = _heads(blocks, int(sizes.sum()), plan)
    nodes = _nodes(_subtrees(blocks, heads, slots, plan, spark), heads, slots, plan, edges)
    return as_model(nodes, plan)


def as_model(nodes: DataFrame, plan: Plan) -> RandomForestClassificationModel:
    """The node table in the saved form of Spark's own model, loaded: a stump forest lends its metadata."""
    spark = nodes.sparkSession
    stumps = spark.createDataFrame([(float(c), Vectors.dense([0.0] * plan.n_features)) for c in range(len(LABELS))], ["label", "features"])
    lent = RandomForestClassifier(numTrees=plan.trees, maxDepth=plan.depth, minInstancesPerNode=plan.min_leaf,
                                  featureSubsetStrategy="sqrt", maxBins=max(plan.n_bins, 2), seed=plan.seed).fit(stumps)
    path = scratch_path(spark, "forest")
    lent.write().save(path)
    split = F.struct(
        F.col("feature").alias("featureIndex"),
        F.when(F.col("feature") >= 0, F.array("threshold")).otherwise(F.array().cast("array<double>"))
        .alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    nodes.select(F.col("tree").alias("treeID"), F.struct(
        "id", "prediction", "impurity", F.col("stats").alias("impurityStats"), F.col("n").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split")).alias("nodeData"),
    ).write.mode("overwrite").parquet(f"{path}/data")
    model = RandomForestClassificationModel.load(path)
    attribution.SAVED[model] = path
    return model
