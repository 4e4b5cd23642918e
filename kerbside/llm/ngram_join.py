"""Similarity self-join of documents on their word n-grams: MinHash banding, exact verification.

Texts with the same n-gram set form a class and are represented by one of them. Signatures are
cut into bands; representatives that share a band hash come together (``block_pairs``), where
the full n-gram sets are compared. Nothing is listed pair by pair: each comparison returns one
row per document with its number of links and the root of its connected part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.common import Rows, block_pairs, components, grouped, roots, slices
from kerbside.sources.scratch import written

#: n-grams in a block of documents that are compared with each other in one task.
BLOCK_NGRAMS = 500_000
#: Documents in such a block, about: a comparison holds matrices of documents by documents.
BLOCK_DOCS = 1_000

_SIGNED = ("doc long, text_hash long, n_ngrams long, set_a long, set_b long, bands array<long>")


def choose_bands(threshold: float, recall: float, max_hashes: int = 256) -> tuple[int, int]:
    """``(bands, rows)``: the longest rows for which so many bands as the recall at the threshold
    needs still fit into ``max_hashes``. Longer rows mean fewer candidates below the threshold."""
    best = None
    for rows in range(1, 33):
        bands = math.ceil(math.log1p(-recall) / math.log1p(-threshold ** rows))
        if bands * rows <= max_hashes:
            best = (bands, rows)
    if best is None:
        raise ValueError("max_hashes is too small for this recall")
    return best


def ngrams(text: bytes, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of n words; of all words if there are fewer;
    none of no words."""
    found = text.split()
    if not found:
        return np.zeros(0, np.uint64)
    words = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(n, len(words))
    hashed = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        hashed = (hashed ^ words[k:len(words) - width + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
    return np.unique(hashed)


def signatures(docs: DataFrame, n: int, bands: int, rows: int, seed: int = 1) -> DataFrame:
    """Size, digest and band hashes of each document's n-gram set."""
    def sign(batches: Rows) -> Rows:
        factors = np.random.default_rng(seed).integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        marks = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
        for batch in slices(batches):
            sizes, digests, keys = [], [], []
            for text in batch.column("text").to_pylist():
                found = ngrams(text or b"", n)
                sizes.append(len(found))
                digests.append(np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), "<i8"))
                if not len(found):
                    keys.append(np.zeros(0, np.int64))
                    continue
                least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
                for start in range(0, len(found), 256):
                    least = np.minimum(least, (found[start:start + 256, None] * factors).min(axis=0))
                key = marks.copy()
                for column in least.reshape(bands, rows).T:
                    key = (key ^ column) * np.uint64(0xBF58476D1CE4E5B9)
                    key ^= key >> np.uint64(31)
                keys.append(key.view(np.int64))
            digests = np.array(digests, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("text_hash"), pa.array(sizes, pa.int64()),
                 pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                 pa.array(keys, pa.list_(pa.int64()))],
                names=["doc", "text_hash", "n_ngrams", "set_a", "set_b", "bands"])

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long").alias("doc"), F.xxhash64(text).alias("text_hash"),
                       text.cast("binary").alias("text")).mapInArrow(sign, _SIGNED)


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections. Elements of one set alone don't matter; the others make the
    columns of a 0/1 matrix, multiplied in strips."""
    m = len(sets)
    values, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), [len(s) for s in sets])
    several = times[column] > 1
    place = np.cumsum(times > 1) - 1
    row, column = row[several], place[column[several]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    counts = np.zeros((m, m), np.float32)
    strip = max(64, (4 << 20) // max(m, 1))
    n_columns = int(column[-1]) + 1 if len(column) else 0
    for start in range(0, n_columns, strip):
        a, b = np.searchsorted(column, [start, start + strip])
        matrix = np.zeros((m, min(strip, n_columns - start)), np.float32)
        matrix[row[a:b], column[a:b] - start] = 1
        counts += matrix @ matrix.T
    return counts.astype(np.int64)


def _compare(n: int, threshold: float):
    """Rows sorted by pair -> (node, links, root) of the nodes with a link."""
    def compare(batches: Rows) -> Rows:
        held: list[tuple] = []
        for group in grouped(batches, "pair"):
            seen: dict[int, int] = {}
            for i, node in enumerate(group["node"]):
                seen.setdefault(node, i)
            order = [seen[node] for node in sorted(seen)]
            if len(order) > 1:
                nodes = [group["node"][i] for i in order]
                side = np.array([group["side"][i] for i in order])
                copies = np.array([group["copies"][i] for i in order])
                sets = [ngrams(group["text"][i], n) for i in order]
                sizes = np.array([len(s) for s in sets])
                both = shared_counts(sets)
                either = sizes[:, None] + sizes[None, :] - both
                linked = both >= threshold * either
                np.fill_diagonal(linked, False)
                if side.any():  # each block is compared with itself elsewhere
                    linked &= side[:, None] != side[None, :]
                root = roots(linked)
                held += [(nodes[i], int(copies[linked[i]].sum()), nodes[root[i]])
                         for i in np.flatnonzero(linked.any(axis=1))]
            if len(held) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)],
                                                 names=["node", "links", "root"])
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)],
                                             names=["node", "links", "root"])

    return compare


def near_duplicates(docs: DataFrame, n: int = 5, threshold: float = 0.8, recall: float = 0.9999,
                    max_hashes: int = 256) -> DataFrame:
    """``doc_id, n_ngrams, copies, n_links, class_id, text_hash`` for each row of ``(doc_id, text)``.

    Two rows are linked if the Jaccard similarity of their n-gram sets is ``threshold`` or more;
    ``recall`` is the chance that a pair right at the threshold meets. ``copies`` counts the rows
    with the same set, ``n_links`` all rows linked directly (copies included), ``class_id`` is
    the smallest doc_id reachable by links, the row's own included. Texts of fewer than n words
    are compared as one n-gram. A null or blank text has no words and is linked with nothing.
    Rows that share a doc_id are compared like any others; null ids come last, and a class of
    nothing but null ids has a null class_id.
    """
    bands, rows = choose_bands(threshold, recall, max_hashes)
    signed = written(signatures(docs, n, bands, rows).withColumn("row", F.monotonically_increasing_id()),
                     "signatures")
    # One node per set; copies are counted before the shuffle. The node's text is fetched later.
    classes = written(signed.where("n_ngrams > 0").groupBy("set_a", "set_b").agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("copies"),
        F.min(F.coalesce("doc", F.lit((1 << 63) - 1))).alias("least_doc")), "classes")
    nodes = signed.join(classes.select(F.col("node").alias("row"), "copies"), "row")
    keys = nodes.select(F.col("row").alias("node"), F.explode("bands").alias("key"))
    floor = F.lit(max(1, BLOCK_NGRAMS // BLOCK_DOCS))
    weights = nodes.select(F.col("row").alias("node"), F.greatest("n_ngrams", floor).alias("weight"))
    groups = written(block_pairs(keys, weights, BLOCK_NGRAMS), "groups")
    met = (groups.select("node").distinct()
           .join(nodes.select(F.col("row").alias("node"), "doc", "text_hash", "copies"), "node"))
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_key"), F.xxhash64(text).alias("hash_key"),
                        text.cast("binary").alias("text"))
    # One text per node, however many rows share its id and text.
    told = (met.join(texts, met["doc"].eqNullSafe(texts["doc_key"]) & (met["text_hash"] == texts["hash_key"]))
            .select("node", "copies", "text").dropDuplicates(["node"]))
    compared = written(
        groups.join(told, "node")
        .select("pair", "node", "side", "copies", "text").repartition("pair").sortWithinPartitions("pair")
        .mapInArrow(_compare(n, threshold), "node long, links long, root long"), "links")
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(compared.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (classes.join(links, "node", "left").join(parts, "node", "left")
             .withColumn("root", F.coalesce("root", "node")))
    least = written(named.groupBy("root").agg(F.min("least_doc").alias("least")), "least")
    classed = named.join(least, "root").select("set_a", "set_b", "copies", "links", "least")
    own = F.col("doc")
    return (signed.join(classed, ["set_a", "set_b"], "left").select(
        own.alias("doc_id"), "n_ngrams", F.coalesce("copies", F.lit(1)).alias("copies"),
        (F.coalesce("links", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_links"),
        F.when(F.col("n_ngrams") == 0, own).otherwise(F.nullif("least", F.lit((1 << 63) - 1))).alias("class_id"),
        "text_hash", "row"))


def representatives(docs: DataFrame, **options) -> DataFrame:
    """One row of ``docs`` per class: the one with the smallest doc_id (of several rows with that
    id and text one is kept; rows without words all stay). Columns stay as they are."""
    found = written(near_duplicates(docs, **options), "classes")
    first = (found.where("n_ngrams > 0").groupBy("class_id")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("best")))
    chosen = written(
        first.select(F.col("best.row").alias("row")).join(found, "row").select("doc_id", "text_hash")
        .withColumn("wordless", F.lit(False))
        .unionByName(found.where("n_ngrams = 0").select("doc_id", "text_hash").distinct()
                     .withColumn("wordless", F.lit(True))), "chosen")
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_row"),
                       F.col("doc_id").cast("long").alias("_doc"), F.xxhash64(F.col("text").cast("string")).alias("_hash"))
    kept = held.join(chosen, held["_doc"].eqNullSafe(chosen["doc_id"]) & (held["_hash"] == chosen["text_hash"]))
    once = kept.where("wordless").select("_row").unionByName(
        kept.where("NOT wordless").dropDuplicates(["_doc", "_hash"]).select("_row"))
    return once.select(*[F.col(f"_row.`{c}`").alias(c) for c in columns])
