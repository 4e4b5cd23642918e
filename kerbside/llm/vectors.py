"""Near-duplicate vectors: cross-polytope hashing after fast Hadamard rotations.

A rotation flips signs at random and mixes by a fast Hadamard transform, three times over; the
hash is the coordinate of largest size with its sign. Several rotations make one key; besides
the best key, keys with one coordinate replaced by its runner-up are probed. Vectors that share
a key with the same label meet (``block_pairs``) and their cosines are computed exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.common import Rows, block_pairs, components, grouped, id_or_last, roots, slices
from kerbside.sources.scratch import written

#: Vectors in a block that is compared in one task.
BLOCK_VECTORS = 2_000

_SIGNED = ("vec_id long, label int, unit binary, direction long, direction_b long, keys array<long>")


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Hadamard transform of rows whose length is a power of two (not normalised)."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack((x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]), axis=2).reshape(n, d)
        h *= 2
    return x


class Hashes:
    """``tables`` keys of ``width`` rotations, each with ``width`` further probes."""

    def __init__(self, dims: int, tables: int, width: int, seed: int):
        self.size = 1 << max(1, dims - 1).bit_length()
        self.tables, self.width = tables, width
        rng = np.random.default_rng([seed, dims])
        self.signs = rng.choice([-1.0, 1.0], (tables * width, 3, self.size))

    def keys(self, x: np.ndarray) -> np.ndarray:
        """(n, tables * (1 + width)) keys; probes first replace the closest runner-up."""
        wide = np.zeros((len(x), self.size))
        wide[:, :x.shape[1]] = x
        rows = np.arange(len(x))
        out = []
        for t in range(self.tables):
            best, second = [], []
            for w in range(self.width):
                y = wide
                for signs in self.signs[t * self.width + w]:
                    y = hadamard(y * signs)
                    y /= np.sqrt(self.size)
                size = np.abs(y)
                top = size.argmax(axis=1)
                best.append(2 * top + (y[rows, top] < 0))
                size[rows, top] = -1
                top = size.argmax(axis=1)
                second.append(2 * top + (y[rows, top] < 0))
            for probe in range(-1, self.width):
                key = np.full(len(x), t, np.int64)
                for w in range(self.width):
                    key = key * 2 * self.size + (second[w] if w == probe else best[w])
                out.append(key)
        return np.stack(out, axis=1)


def usable(values: list | None) -> np.ndarray | None:
    """A vector in double precision with length 1, or None if it can't be linked."""
    if values is None or not len(values) or any(v is None for v in values):
        return None
    x = np.array(values, np.float64)
    if not np.isfinite(x).all():
        return None
    x = x / (np.abs(x).max() or 1.0)
    length = np.sqrt(x @ x)
    return x / length if length else None


def signatures(vectors: DataFrame, tables: int, width: int, seed: int) -> DataFrame:
    def sign(batches: Rows) -> Rows:
        made: dict[int, Hashes] = {}
        for batch in slices(batches, 1024):
            units = [usable(v) for v in batch.column("embedding").to_pylist()]
            labels = batch.column("label").to_pylist()
            keys = [np.zeros(0, np.int64)] * len(units)
            linkable = [i for i, u in enumerate(units) if u is not None and labels[i] is not None]
            for dims in {len(units[i]) for i in linkable}:
                own = [i for i in linkable if len(units[i]) == dims]
                if dims not in made:
                    made[dims] = Hashes(dims, tables, width, seed)
                found = made[dims].keys(np.array([units[i] for i in own]))
                places = np.array([labels[i] for i in own], np.int64) * np.int64(1_000_003) + dims
                found = (found ^ (places * np.int64(0x1E3779B97F4A7C15))[:, None]) * np.int64(0x3F58476D1CE4E5B9)
                for i, row in zip(own, found):
                    keys[i] = np.unique(row)
            data = [None if len(k) == 0 else units[i].tobytes() for i, k in enumerate(keys)]
            digests = np.array([np.frombuffer(xxhash.xxh3_128_digest(d or b""), "<i8") for d in data],
                               np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), pa.array(data, pa.binary()),
                 pa.array(digests[:, 0]), pa.array(digests[:, 1]), pa.array(keys, pa.list_(pa.int64()))],
                names=["vec_id", "label", "unit", "direction", "direction_b", "keys"])

    return vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("int").alias("label"),
                          F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(sign, _SIGNED)


def _compare(threshold: float):
    def compare(batches: Rows) -> Rows:
        held: list[tuple] = []
        for group in grouped(batches, "pair"):
            order = np.argsort(np.array(group["node"]), kind="stable")
            node = np.array(group["node"])[order]
            side = np.array(group["side"])[order]
            copies = np.array(group["copies"])[order]
            kind = np.array([(group["label"][i], len(group["unit"][i])) for i in order]).reshape(-1, 2)
            linked = np.zeros((len(node), len(node)), bool)
            for same in np.unique(kind, axis=0):
                own = np.flatnonzero((kind == same).all(axis=1))
                x = np.frombuffer(b"".join(group["unit"][order[i]] for i in own)).reshape(len(own), -1)
                linked[np.ix_(own, own)] = x @ x.T >= threshold
            np.fill_diagonal(linked, False)
            if side.any():
                linked &= side[:, None] != side[None, :]
            root = roots(linked)
            held += [(int(node[i]), int(copies[linked[i]].sum()), int(node[root[i]]))
                     for i in np.flatnonzero(linked.any(axis=1))]
            if len(held) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)],
                                                 names=["node", "links", "root"])
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)],
                                             names=["node", "links", "root"])

    return compare


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, tables: int = 8, width: int = 4,
                    seed: int = 1) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``(vec_id, embedding, label)``.

    Rows are linked if their labels are equal and not null and the cosine of their vectors, in
    double precision, is ``threshold`` or more. A vector that is null, empty, zero or holds a
    null or non-finite component is linked with nothing, nor are vectors of different lengths.
    Equal vectors are linked and counted one by one. ``component_id`` is the smallest vec_id
    reachable by links, the row's own included. Rows that share a vec_id are vectors of their
    own; a null vec_id comes after all others, and a component of nothing but null ids has a
    null id and is not kept.
    """
    signed = written(signatures(vectors, tables, width, seed)
                     .withColumn("row", F.monotonically_increasing_id()), "vectors")
    classes = written(signed.where("unit IS NOT NULL").groupBy("label", "direction", "direction_b").agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"),
        F.min(id_or_last("vec_id")).alias("least_id")), "classes")
    nodes = written(signed.join(classes.select(F.col("node").alias("row"), "copies"), "row")
                    .select(F.col("row").alias("node"), "label", "unit", "copies", "keys"), "nodes")
    groups = written(block_pairs(nodes.select("node", F.explode("keys").alias("key")),
                                 nodes.select("node", F.lit(1).alias("weight")), BLOCK_VECTORS), "groups")
    compared = written(
        groups.join(nodes.select("node", "label", "unit", "copies"), "node")
        .repartition("pair").sortWithinPartitions("pair")
        .mapInArrow(_compare(threshold), "node long, links long, root long"), "links")
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(compared.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (classes.join(links, "node", "left").join(parts, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    least = written(named.groupBy("root").agg(F.min("least_id").alias("least")), "least")
    classed = named.join(least, "root").select("label", "direction", "direction_b", "copies", "links", "least")
    linked = signed.where("unit IS NOT NULL").join(classed, ["label", "direction", "direction_b"]).select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.nullif("least", F.lit((1 << 63) - 1)).alias("component_id"))
    alone = signed.where("unit IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
