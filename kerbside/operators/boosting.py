"""Multi-class gradient boosting: one softmax ensemble with a tree per class and round.

All rows are binned once and packed into blocks that the workers keep; a round adds its trees to
the rows' scores there. Each level of the three trees
of a round is one Spark job: every task adds up gradients and Hessians of its blocks per class,
node, feature and bin; the sums of a class and node meet in one task, which finds their best split,
and only splits reach the driver. Gradients are summed as whole numbers, so the order in which tasks
finish does not show. The validation loss of a round comes with the first level of the
next one, and training stops when it has not fallen for ``patience`` rounds.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.operators import leaf_bits
from kerbside.schema import LABELS, MODEL_FEATURES
from kerbside.sources.scratch import removed, scratch_path, written

#: Rounds whose scores are kept by the workers before they are written anew, which cuts the plan.
PENDING_ROUNDS = 10

#: Rows packed into one block, and rows of a task at most: their whole-number sums stay exact.
BLOCK_ROWS, PART_ROWS = 8_192, 1 << 22

_SCALE = float(1 << 30)
_BLOCK = "n int, bins binary, label binary, is_val binary, ticket binary, raw binary"
_MODEL = ("round int, class int, node int, feature int, threshold double, value double, cover double, "
          "gain double")

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Trees:
    """Trees as heaps: the children of node i are 2i + 1 (at most the threshold) and 2i + 2. All
    arrays have the shape (rounds, classes, nodes); a leaf has feature -1."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Node in which each row ends, for every tree: (rows, rounds * classes)."""
        feature, threshold = (a.reshape(-1, a.shape[-1]) for a in (self.feature, self.threshold))
        inner, places = feature >= 0, np.arange(feature.shape[1])
        below = np.where(inner, 2 * places + 1, places)  # a leaf leads to itself
        cut = np.where(inner, threshold, np.inf)
        flat, starts = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1]
        node = np.zeros((len(feature), len(x)), np.int64)
        for t, last in enumerate((inner * (places + 1)).max(axis=1, initial=0)):
            at = node[t]
            for _ in range(int(last).bit_length()):
                value = flat.take(starts + np.maximum(feature[t], 0).take(at))
                at = below[t].take(at) + (value > cut[t].take(at))
            node[t] = at
        return node.T

    def raw(self, x: np.ndarray, rows_at_once: int = 2_048) -> np.ndarray:
        """Sums of leaf values per class."""
        rounds, classes, _ = self.value.shape
        value = self.value.reshape(rounds * classes, self.value.shape[-1])
        out = np.zeros((len(x), classes))
        for start in range(0, len(x) if rounds else 0, rows_at_once):
            node = self.leaves(x[start:start + rows_at_once])
            got = value[np.arange(len(value)), node].reshape(-1, rounds, classes)
            out[start:start + rows_at_once] = got.sum(axis=1)
        return out


@dataclass(frozen=True)
class BoostedModel:
    """A fitted ensemble. ``losses`` are the validation losses after 0, 1, 2 ... rounds."""

    features: list[str]
    trees: Trees
    cover: np.ndarray
    gain: np.ndarray
    losses: list[float] = field(default_factory=list)

    @property
    def rounds(self) -> int:
        return len(self.cover)

    def node_rows(self) -> list[tuple]:
        """One tuple per node in use, in the columns of the saved table."""
        out = []
        used = np.zeros(self.cover.shape, bool)
        used[:, :, 0] = True
        for i in range(used.shape[-1] // 2):
            for child in (2 * i + 1, 2 * i + 2):
                used[:, :, child] = used[:, :, i] & (self.trees.feature[:, :, i] >= 0)
        for r, c, n in np.argwhere(used).tolist():
            out.append((r, c, n, int(self.trees.feature[r, c, n]), float(self.trees.threshold[r, c, n]),
                        float(self.trees.value[r, c, n]), float(self.cover[r, c, n]), float(self.gain[r, c, n])))
        return out

    def node_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.node_rows(), _MODEL)


def softmax(raw: np.ndarray) -> np.ndarray:
    columns = list(raw.T)  # few: column by column is several times faster than along short rows
    top = functools.reduce(np.maximum, columns)
    e = [np.exp(c - top) for c in columns]
    total = functools.reduce(np.add, e)
    return np.stack([v / total for v in e], axis=1)


def bounded_sample(df: DataFrame, max_rows: int) -> DataFrame:
    """All rows, or about ``max_rows`` of them chosen by a hash of the row."""
    n = df.count()
    if n <= max_rows:
        return df
    return df.where(F.pmod(F.xxhash64(*df.columns), F.lit(1 << 30)) < int((1 << 30) * max_rows / n))


def bin_edges(df: DataFrame, features: list[str], bins: int) -> list[np.ndarray]:
    """Up to ``bins - 1`` thresholds per feature: its least value and (approximate) quantiles."""
    steps = [i / (bins - 1) for i in range(bins - 1)]
    return [np.unique(np.array(q)) for q in df.approxQuantile(features, steps, 0.25 / bins)]


def packed_blocks(df: DataFrame, features: list[str], edges: list[np.ndarray], classes: int) -> DataFrame:
    """Rows as blocks of bins. A row's bin is the number of thresholds below its value."""
    def pack(batches: Batches) -> Batches:
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(start, BLOCK_ROWS)
                bins = np.stack([np.searchsorted(e, part.column(f).to_numpy(zero_copy_only=False)).astype(np.uint8)
                                 for f, e in zip(features, edges)], axis=1)
                yield _block_batch(bins, part.column("label").to_numpy().astype(np.uint8),
                                   part.column("is_val").to_numpy(zero_copy_only=False).astype(np.uint8),
                                   part.column("ticket").to_numpy(), np.zeros((part.num_rows, classes)))

    return df.select(*[F.col(f).cast("double").alias(f) for f in features], F.col("label").cast("int").alias("label"),
                     "is_val", F.xxhash64(*df.columns).alias("ticket")).mapInArrow(pack, _BLOCK)


def _block_batch(bins: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([len(bins)], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in (bins, *columns)]],
        names=[c.split()[0] for c in _BLOCK.split(", ")])


def _arrays(row: dict, n_features: int, classes: int) -> tuple[np.ndarray, ...]:
    n = row["n"]
    return (np.frombuffer(row["bins"], np.uint8).reshape(n, n_features), np.frombuffer(row["label"], np.uint8),
            np.frombuffer(row["is_val"], np.uint8).astype(bool), np.frombuffer(row["ticket"], np.uint64),
            np.frombuffer(row["raw"], np.float64).reshape(n, classes))


def mixed(ticket: np.ndarray, turn: int, seed: int) -> np.ndarray:
    """A number from [0, 1) per row and turn, the same in every attempt."""
    held = (ticket ^ np.uint64((turn * 0x9E3779B97F4A7C15 + seed) % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
    held = (held ^ (held >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (held >> np.uint64(11)).astype(np.float64) / float(1 << 53)


def _stored(held: RDD, spark: SparkSession) -> tuple[str, RDD]:
    """Blocks of arrays in the shared folder: the path and the blocks as read from there."""
    path = scratch_path(spark, "binned")
    rows = held.map(lambda b: (len(b[0]), *[bytearray(np.ascontiguousarray(a).tobytes()) for a in b]))
    spark.createDataFrame(rows, _BLOCK, verifySchema=False).write.parquet(path)
    return path, spark.read.schema(_BLOCK).parquet(path).rdd


def _held(blocks: RDD, n_features: int, classes: int) -> RDD:
    """The blocks as arrays in the workers' cache. Training is some thousand tiny jobs over the
    same few blocks; on an RDD of arrays such a job takes a fifth of what a DataFrame's does."""
    return blocks.map(lambda row: _arrays(row.asDict(), n_features, classes)).persist(StorageLevel.MEMORY_AND_DISK)


def _scored(held: RDD, new: Trees) -> RDD:
    """The blocks with the trees of a round added to their scores."""
    return held.map(lambda b: (*b[:4], b[4] + new.raw(b[0]))).persist(StorageLevel.MEMORY_AND_DISK)


def _level_splits(held: RDD, grown: Trees, level: int, turn: int, n_features: int, n_bins: int,
                  allowed: np.ndarray, options: dict) -> dict[int, tuple]:
    """The best split per slot, a class and node of a level; slot -1 has the validation loss and its
    rows. Sums of gradients and Hessians (2, features, bins) stay with the workers."""
    classes = grown.feature.shape[1]
    nodes, first = 1 << level, (1 << level) - 1

    def count(blocks: Iterator[tuple]) -> Iterator[tuple[int, np.ndarray]]:
        sums = np.zeros((classes, nodes, 2, n_features, n_bins))
        loss = np.zeros(2)
        for bins, label, is_val, ticket, raw in blocks:
            rows = np.flatnonzero(~is_val & (mixed(ticket, turn, options["seed"]) < options["subsample"]))
            if level == 0 and is_val.any():
                p = softmax(raw[is_val])
                loss += (-np.log(np.maximum(p[np.arange(len(p)), label[is_val]], 1e-15)).sum(), is_val.sum())
            if not len(rows):
                continue
            bins, label, p = bins[rows], label[rows], softmax(raw[rows])
            at = grown.leaves(bins) - first
            g = np.rint((p - (label[:, None] == np.arange(classes))) * _SCALE)
            h = np.rint(np.maximum(2.0 * p * (1.0 - p), 1e-16) * _SCALE)
            for c in range(classes):
                own = np.flatnonzero(at[:, c] >= 0)
                base, weights = at[own, c] * n_bins, (g[own, c], h[own, c])
                for f in np.flatnonzero(allowed[c]):
                    key = base + bins[own, f]
                    for i, w in enumerate(weights):
                        sums[c, :, i, f] += np.bincount(key, w, nodes * n_bins).reshape(nodes, n_bins)
        sums = sums.reshape(classes * nodes, 2, n_features * n_bins)
        for slot in np.flatnonzero(sums.any(axis=(1, 2))).tolist():
            yield slot, sums[slot].astype(np.int64)
        if level == 0:
            yield -1, np.rint(loss * (_SCALE, 1)).astype(np.int64)

    def choose(slot: int, total: np.ndarray) -> tuple:
        if slot < 0:
            return tuple(total.tolist())
        return best_split(total.reshape(2, n_features, n_bins) / _SCALE, allowed[slot // nodes], options["min_child"],
                          options["penalty"])

    totals = held.mapPartitions(count).reduceByKey(np.add, min(held.getNumPartitions(), classes * nodes + 1))
    return dict(totals.map(lambda item: (item[0], choose(*item))).collect())


def best_split(sums: np.ndarray, allowed: np.ndarray, min_child: float, penalty: float) -> tuple:
    """(feature, bin, gain, left, right) of the split with the largest gain, where left and right
    are the gradient and Hessian sums of the sides; feature -1 and the whole node on the left if
    none gains. Rows in bins up to the split's go left. Equal gains go to the first feature and bin."""
    g, h = sums.cumsum(axis=2)
    any_f = int(np.argmax(allowed))
    whole_g, whole_h = g[any_f, -1], h[any_f, -1]
    other_g, other_h = whole_g - g, whole_h - h
    fits = (h >= min_child) & (other_h >= min_child) & allowed[:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = g ** 2 / (h + penalty) + other_g ** 2 / (other_h + penalty) - whole_g ** 2 / (whole_h + penalty)
    gain = np.where(fits, gain, -np.inf)
    f, b = np.unravel_index(int(gain.argmax()), gain.shape)
    if not gain[f, b] > 1e-9:
        return -1, 0, 0.0, (float(whole_g), float(whole_h)), (0.0, 0.0)
    return int(f), int(b), float(gain[f, b]), (float(g[f, b]), float(h[f, b])), (float(other_g[f, b]), float(other_h[f, b]))


def best_round(losses: list[float]) -> int:
    """Rounds after which the loss is smallest; the first of equals."""
    return int(np.argmin(losses))


def fit_softmax(train_and_val: DataFrame, features: list[str] = MODEL_FEATURES, rounds: int = 500,
                depth: int = 6, rate: float = 0.05, subsample: float = 0.8, feature_share: float = 0.8,
                min_child: float = 5.0, penalty: float = 1.0, patience: int = 20, bins: int = 64,
                seed: int = 42) -> BoostedModel:
    """Fit on rows with ``features``, ``label`` (0, 1, 2) and a boolean ``is_val``.

    Leaves are -G / (H + penalty) times ``rate``. Each tree sees a share of the features and each
    round a share of the rows, drawn by hash. Of the rounds, those up to the smallest loss on
    the rows with ``is_val`` are kept; without such rows all are. Every row is used.
    """
    classes, n_nodes = len(LABELS), (1 << (depth + 1)) - 1
    options = {"seed": seed, "subsample": subsample, "min_child": min_child, "penalty": penalty}
    spark = train_and_val.sparkSession
    columns = list(dict.fromkeys([*train_and_val.columns, *features]))
    n = train_and_val.count()
    parts = max(1, min(spark.sparkContext.defaultParallelism, -(-n // BLOCK_ROWS)), -(-n // PART_ROWS))
    rows = written(train_and_val.select(*columns).repartition(parts), "fit-rows")
    edges = bin_edges(rows.where("NOT is_val"), features, bins)
    held = _held(written(packed_blocks(rows, features, edges, classes), "binned").rdd, len(features), classes)
    path, stale = None, []
    rng = np.random.default_rng(seed)
    n_used = max(1, round(feature_share * len(features)))
    done: list[dict[str, np.ndarray]] = []
    losses: list[float] = []

    def trees(parts: list[dict[str, np.ndarray]], threshold: str) -> Trees:
        def stack(name: str) -> np.ndarray:
            return np.stack([p[name] for p in parts]) if parts else np.zeros((0, classes, n_nodes))
        return Trees(stack("feature").astype(np.int64), stack(threshold), stack("value"))

    for turn in range(rounds + 1):
        now = {"feature": np.full((classes, n_nodes), -1), "bin": np.zeros((classes, n_nodes)),
               **{n: np.zeros((classes, n_nodes)) for n in ("threshold", "value", "cover", "gain")}}
        allowed = np.zeros((classes, len(features)), bool)
        for c in range(classes):
            allowed[c, rng.choice(len(features), n_used, replace=False)] = True
        for level in range(depth):
            splits = _level_splits(held, trees([now], "bin"), level, turn, len(features), bins, allowed, options)
            while stale:  # the first level has worked out the scores anew
                stale.pop().unpersist()
            loss, n_val = splits.pop(-1, (0, 0))
            if n_val:
                losses.append(float(loss / _SCALE / n_val))
            if turn == rounds or (losses and len(losses) - 1 - best_round(losses) >= patience):
                break
            split = False
            for slot, (f, b, gain, left, right) in sorted(splits.items()):
                c, node = slot // (1 << level), (1 << level) - 1 + slot % (1 << level)
                if level == 0:
                    _set_leaf(now, c, 0, left[0] + right[0], left[1] + right[1], rate, penalty)
                if f >= 0:
                    split = True
                    now["feature"][c, node], now["bin"][c, node], now["gain"][c, node] = f, b, gain
                    now["threshold"][c, node] = edges[f][b] if b < len(edges[f]) else np.inf
                    _set_leaf(now, c, 2 * node + 1, *left, rate, penalty)
                    _set_leaf(now, c, 2 * node + 2, *right, rate, penalty)
            if not split:
                break
        if turn == rounds or (losses and len(losses) - 1 - best_round(losses) >= patience):
            break
        done.append(now)
        stale.append(held)
        held = _scored(held, trees([now], "bin"))
        if len(done) % PENDING_ROUNDS == 0:
            before, (path, blocks) = path, _stored(held, spark)
            for old in (*stale, held):
                old.unpersist()
            held, stale = _held(blocks, len(features), classes), []
            if before:
                removed(spark, before)
    held.unpersist()
    if path:
        removed(spark, path)
    kept = done[:best_round(losses)] if losses else done
    stacked = {n: np.stack([p[n] for p in kept]) if kept else np.zeros((0, classes, n_nodes)) for n in ("cover", "gain")}
    return BoostedModel(list(features), trees(kept, "threshold"), stacked["cover"], stacked["gain"], losses)


def _set_leaf(tree: dict[str, np.ndarray], c: int, node: int, g: float, h: float, rate: float, penalty: float) -> None:
    tree["value"][c, node] = -rate * g / (h + penalty)
    tree["cover"][c, node] = h


def add_boosted_probability(df: DataFrame, model: BoostedModel) -> DataFrame:
    """Add ``probability``, an array of doubles; works on streams as well. Narrow: the model is
    broadcast, its size is bounded by its rounds and depth."""
    trees = model.trees
    if model.rounds:
        trees = leaf_bits.heap_bits(trees.feature, trees.threshold, trees.value, len(model.features))
    shared = df.sparkSession.sparkContext.broadcast(trees)

    @F.pandas_udf("array<double>")
    def probability(*columns: pd.Series) -> pd.Series:
        x = np.stack([c.to_numpy(dtype=np.float64) for c in columns], axis=1)
        return pd.Series(list(softmax(shared.value.raw(x))))

    return df.withColumn("probability", probability(*[F.col(f).cast("double") for f in model.features]))


def gain_importance(model: BoostedModel) -> list[float]:
    """Mean gain of a feature's splits, as shares of one."""
    f = model.trees.feature
    mean = [float(model.gain[f == i].mean()) if (f == i).any() else 0.0 for i in range(len(model.features))]
    total = sum(mean)
    return [m / total if total else 0.0 for m in mean]


def save_boosted(model: BoostedModel, spark: SparkSession, path: str) -> str:
    """The node table with the feature names, as Parquet."""
    nodes = model.node_table(spark).withColumn("features", F.array(*[F.lit(f) for f in model.features]))
    nodes.withColumn("n_nodes", F.lit(model.cover.shape[-1])).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_boosted(spark: SparkSession, path: str) -> BoostedModel:
    """A saved model; its table has one row per node, whatever the data."""
    nodes = spark.read.parquet(path).toPandas()
    if not len(nodes):
        raise ValueError(f"{path} holds no trees")
    shape = (int(nodes["round"].max()) + 1, len(LABELS), int(nodes["n_nodes"].iloc[0]))
    at = (nodes["round"].to_numpy(), nodes["class"].to_numpy(), nodes["node"].to_numpy())

    def filled(name: str, empty: float = 0.0) -> np.ndarray:
        out = np.full(shape, empty)
        out[at] = nodes[name]
        return out

    return BoostedModel(list(nodes["features"].iloc[0]),
                        Trees(filled("feature", -1).astype(np.int64), filled("threshold"), filled("value")),
                        filled("cover"), filled("gain"))
