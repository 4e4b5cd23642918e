"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.sources.scratch import written

#: Stands for a null id where ids are compared: such a row comes after every other.
LAST_ID = (1 << 63) - 1

#: How often a home is passed on to nodes that share a key. Affects cost only.
HOME_ROUNDS = 2

Rows = Iterator[pa.RecordBatch]


def id_or_last(name: str) -> Column:
    return F.coalesce(F.col(name).cast("long"), F.lit(LAST_ID))


def slices(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Rows:
    """Smaller batches, so that what a task holds in Python stays small."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text", rows: int = 1024, size: int = 1 << 22) -> Rows:
    """As ``slices``, with at most ``size`` bytes of text in a batch of several rows."""
    for batch in slices(batches, rows):
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def grouped(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[dict[str, list]]:
    """Column lists of each run of equal ``key`` values in rows that are sorted by it."""
    held: dict[str, list] = {}
    for batch in slices(batches, 4096):
        columns = {n: batch.column(i).to_pylist() for i, n in enumerate(batch.schema.names)}
        keys = columns[key]
        if not keys:
            continue
        changes = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        for start, stop in zip([0, *changes], [*changes, len(keys)]):
            if held and held[key][0] != keys[start]:
                yield held
                held = {}
            for n, values in columns.items():
                held.setdefault(n, []).extend(values[start:stop])
    if held:
        yield held


def running_offsets(rows: DataFrame, order: list[str], amount: str, name: str) -> DataFrame:
    """Add ``name``: the sum of ``amount`` over all rows that come earlier in ``order``.

    The order should be total. Rows are range-partitioned, each partition is summed on its own
    and shifted by the totals of those before it (one row per partition).
    """
    schema = rows.select("*", F.lit(0).alias("_part"), F.lit(0).cast("long").alias("_before")).schema

    def within(batches: Rows) -> Rows:
        total = 0
        for batch in batches:
            amounts = batch.column(amount).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(amounts) + total
            if len(ends):
                total = int(ends[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(ends - amounts)], names=[*batch.schema.names, "_before"])

    ordered = written(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_part", F.spark_partition_id()).mapInArrow(within, schema), "ordered")
    totals = ordered.groupBy("_part").agg(F.sum(amount).alias("_total"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    return ordered.join(bases, "_part").select(
        *rows.columns, (F.col("_base") + F.col("_before")).alias(name))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)``: the smallest node reachable from each node that has an edge.

    Every node passes its smallest neighbour on to the others until nothing changes; each round
    is written to the shared folder, so that plans stay short.
    """
    pairs = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .where("u != v").distinct(), "edges")
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).where("m < u")
        passed = (both.join(least, "u").where("v != m")
                  .select(F.col("v").alias("u"), F.col("m").alias("v"), F.lit(1).alias("fresh")))
        direct = least.select("u", F.col("m").alias("v"), F.lit(0).alias("fresh"))
        pairs = written(passed.unionByName(direct).groupBy("u", "v")
                        .agg(F.min("fresh").alias("fresh")), "edges")
        if pairs.where("fresh = 1").isEmpty():
            return pairs.select(F.col("u").alias("node"), F.col("v").alias("root"))
        pairs = pairs.select("u", "v")


def block_pairs(keys: DataFrame, weights: DataFrame, limit: int) -> DataFrame:
    """Rows to compare: ``(pair, node, side)`` for nodes that share a key with another node.

    ``keys`` has ``(node, key)``, ``weights`` ``(node, weight)``. A node's home is its smallest
    shared key, or a smaller home of a node it shares a key with (so that a dense group has one
    home); the nodes of a home are cut into blocks of about ``limit`` weight, and two blocks
    meet (once) if some key has nodes in both. Any two nodes with a common key are in one
    block or in two that meet, whatever the size of a key, and no list of node pairs is made.
    Side 0 and 1 tell the two blocks of a pair apart; a block compared with itself has side 0.
    """
    # Written, so that the join is planned on its own and a hot key's rows can be split.
    shared = written(keys.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"))
                     .where("lo < hi").select("key"), "shared")
    member = written(keys.join(shared, "key", "left_semi"), "members")
    homes = member.groupBy("node").agg(F.min("key").alias("home"))
    for _ in range(HOME_ROUNDS):
        nearest = written(member.join(homes, "node").groupBy("key").agg(F.min("home").alias("home")), "nearest")
        homes = member.join(nearest, "key").groupBy("node").agg(F.min("home").alias("home"))
    homes = written(homes.join(weights, "node"), "homes")
    load = written(homes.groupBy("home").agg(F.sum("weight").alias("load")), "load")
    salt = F.pmod(F.xxhash64("node"), F.ceil(F.col("load") / F.lit(limit)).cast("long"))
    blocks = written(homes.join(load, "home").select(
        "node", F.xxhash64("home", salt).alias("block")), "blocks")
    touched = member.join(blocks, "node").select("key", "block").distinct()
    several = (touched.groupBy("key").agg(F.min("block").alias("lo"), F.max("block").alias("hi"))
               .where("lo < hi").select("key"))
    split = touched.join(several, "key", "left_semi")
    across = (split.withColumnRenamed("block", "left")
              .join(split.withColumnRenamed("block", "right"), "key").where("left < right")
              .select("left", "right").distinct())
    alone = (blocks.groupBy("block").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select(F.col("block").alias("left"), F.col("block").alias("right")))
    pairs = written(across.unionByName(alone).withColumn("pair", F.xxhash64("left", "right")),
                    "pairs")
    sides = (pairs.select("pair", F.col("left").alias("block"), F.lit(0).alias("side"))
             .unionByName(pairs.where("left < right")
                          .select("pair", F.col("right").alias("block"), F.lit(1).alias("side"))))
    return sides.join(blocks, "block").select("pair", "node", "side")


def roots(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix: the smallest index that each index is connected to."""
    label = np.arange(len(linked))
    while True:
        near = np.where(linked, label[None, :], len(linked)).min(axis=1, initial=len(linked))
        fresh = np.minimum(label, near)
        fresh = fresh[fresh]
        if (fresh == label).all():
            return label
        label = fresh


def row_results(fn: Callable[[pa.RecordBatch], list[pa.Array]], names: list[str],
                rows: int = 512) -> Callable[[Rows], Rows]:
    """A mapInArrow body that turns small batches into small batches."""
    def body(batches: Rows) -> Rows:
        for batch in slices(batches, rows):
            yield pa.RecordBatch.from_arrays(fn(batch), names=names)
    return body
