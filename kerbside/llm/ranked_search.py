"""Ranked lexical search with the Best Position Algorithm.

Documents are cut into shards. A shard has one impact list per query term: its documents by
falling impact. Lists are read in step from the top; each document met is looked up in all the
lists of the item at once (direct access), which gives its whole score and its position in each
list. The best position of a list is the last one up to which all are seen, by reading or by
look-up. No unseen document scores more than the sum of the impacts at the best positions, and
reading stops when that sum is strictly below the score of the k-th document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from kerbside.llm.common import Rows, slices
from kerbside.sources.scratch import written

#: Items are searched in blocks of so many items and different terms (or a single item).
BLOCK_ITEMS, BLOCK_TERMS = 4_096, 16_384

#: Look-up cells (terms x documents) and documents of a shard.
SHARD_CELLS, SHARD_DOCS = 1 << 24, 20_000

#: Positions of each list in the first reading; every further one is twice as long.
FIRST_STEP = 8

# Upper-case letters become lower-case ones, ASCII characters outside terms a space.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERMS).split()


class Item:
    def __init__(self, number: int, item_id: int | None, terms: set[bytes]):
        self.number, self.item_id, self.terms = number, item_id, terms


def item_blocks(items: DataFrame) -> Iterator[list[Item]]:
    """Items with terms, in blocks of bounded size."""
    block: list[Item] = []
    known: set[bytes] = set()
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    for number, row in enumerate(rows.toLocalIterator()):
        item = Item(number, row.item_id, set(terms_of(row.text)))
        if not item.terms:
            continue
        if block and (len(block) >= BLOCK_ITEMS or len(known | item.terms) > BLOCK_TERMS):
            yield block
            block, known = [], set()
        block.append(item)
        known |= item.terms
    if block:
        yield block


def postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs`` of each document that has a term: its number of terms, and the
    numbers and occurrences of those in the vocabulary."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def find(batches: Rows) -> Rows:
        known = shared.value
        size = len(known)
        for batch in slices(batches, 256):
            words = [terms_of(t) for t in batch.column("text").to_pylist()]
            found = [[v for v in map(known.get, w) if v is not None] for w in words]
            code = np.fromiter((v for f in found for v in f), np.int64)
            code += np.repeat(np.arange(len(found)), [len(f) for f in found]) * size
            code, tf = np.unique(code, return_counts=True)
            edges = np.searchsorted(code, np.arange(len(found) + 1) * size)
            lists = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(v, pa.int32()))
                     for v in (code % size, tf)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(w) for w in words], pa.int64()), *lists],
                names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(
        find, "doc_id long, n long, terms array<int>, tfs array<int>").where("n > 0")


class Shard:
    """Impact lists of some documents, with the position of each document in each list."""

    def __init__(self, n: np.ndarray, edges: np.ndarray, terms: np.ndarray, tfs: np.ndarray,
                 weights: np.ndarray, n_docs: int, n_terms: int):
        if 50 * int(n.max()) * n_docs < 1 << 63:
            length = 50 + (50 * n * n_docs) // n_terms
        else:
            length = np.array([50 + 50 * int(v) * n_docs // n_terms for v in n], np.int64)
        doc = np.repeat(np.arange(len(n)), np.diff(edges))
        impact = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 20 * length[doc]))
        doc, terms, impact = (v[impact > 0] for v in (doc, terms, impact))
        order = np.lexsort((doc, -impact, terms))
        self.doc, self.impact, terms = doc[order], impact[order], terms[order]
        self.start = np.searchsorted(terms, np.arange(len(weights) + 1))
        self.place = np.full((len(weights), len(n)), -1, np.int32)
        self.place[terms, self.doc] = np.arange(len(terms)) - self.start[terms]
        self.n_docs = len(n)


class Top:
    """The best documents of an item so far: score, null id, id."""

    def __init__(self, k: int):
        self.k = k
        self.score = self.doc_id = np.zeros(0, np.int64)
        self.unknown = np.zeros(0, bool)

    def add(self, score: np.ndarray, doc_id: np.ndarray, unknown: np.ndarray) -> None:
        score, doc_id, unknown = (np.concatenate(p) for p in (
            (self.score, score), (self.doc_id, doc_id), (self.unknown, unknown)))
        best = np.lexsort((doc_id, unknown, -score))[:self.k]
        self.score, self.doc_id, self.unknown = score[best], doc_id[best], unknown[best]

    def kth(self) -> int:
        """The score that a document must reach; 0 while there is room."""
        return int(self.score[-1]) if len(self.score) == self.k else 0


def best_position_search(shard: Shard, terms: np.ndarray, top: Top, doc_id: np.ndarray, unknown: np.ndarray) -> int:
    """Add the shard's documents to ``top``; gives the number of documents looked up."""
    size = np.diff(shard.start)[terms]
    terms, size = terms[size > 0], size[size > 0]
    start = shard.start[terms]
    offset = np.concatenate(([0], np.cumsum(size)))
    seen = np.zeros(offset[-1], bool)
    met = np.zeros(shard.n_docs, bool)
    best = np.zeros(len(terms), np.int64)  # positions below are all seen
    bound = int(shard.impact[start].sum())
    read, step = 0, FIRST_STEP
    while bound > 0 and bound >= top.kth():
        docs = np.concatenate([shard.doc[a + read:a + min(s, read + step)]
                               for a, s in zip(start.tolist(), size.tolist()) if s > read])
        docs = np.unique(docs[~met[docs]])
        if len(docs):
            met[docs] = True
            place = shard.place[terms[:, None], docs]
            there = place >= 0
            score = np.where(there, shard.impact[np.where(there, start[:, None] + place, 0)], 0).sum(axis=0)
            seen[(offset[:-1, None] + place)[there]] = True
            good = score >= max(top.kth(), 1)
            top.add(score[good], doc_id[docs[good]], unknown[docs[good]])
        read, step = read + step, 2 * step
        for i, (a, b) in enumerate(zip(offset[:-1].tolist(), offset[1:].tolist())):
            rest = seen[a + int(best[i]):b]
            if len(rest):
                gap = int(rest.argmin())
                best[i] += gap if not rest[gap] else len(rest)
        # A list that is seen to its end holds no unseen document.
        left = best < size
        bound = int(shard.impact[(start + best - 1)[left]].sum())
    return int(met.sum())


def _searched(items: list[Item], vocabulary: dict[bytes, int], weights: np.ndarray, n_docs: int, n_terms: int,
              k: int, found: DataFrame) -> DataFrame:
    wanted = [(i.number, i.item_id, np.sort(np.array([vocabulary[t] for t in i.terms]))) for i in items]
    shared = found.sparkSession.sparkContext.broadcast((weights, wanted))
    shard_docs = max(64, min(SHARD_DOCS, SHARD_CELLS // len(vocabulary)))

    def search(batches: Rows) -> Rows:
        weights, wanted = shared.value
        tops = [Top(k) for _ in wanted]

        def run(held: list[pa.RecordBatch]) -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            ids = table.column("doc_id").combine_chunks()
            unknown = np.asarray(ids.is_null())
            ids = ids.fill_null(0).to_numpy()
            lists = table.column("terms").combine_chunks()
            edges = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))))
            terms = lists.flatten().to_numpy().astype(np.int64)
            tfs = table.column("tfs").combine_chunks().flatten().to_numpy().astype(np.int64)
            shard = Shard(table.column("n").to_numpy(), edges.astype(np.int64), terms, tfs, weights, n_docs, n_terms)
            for top, (_, _, own) in zip(tops, wanted):
                best_position_search(shard, own, top, ids, unknown)

        held, size = [], 0
        for batch in slices(batches, min(shard_docs, 4096)):
            if held and size + batch.num_rows > shard_docs:
                run(held)
                held, size = [], 0
            held.append(batch)
            size += batch.num_rows
        if size:
            run(held)
        for top, (number, item_id, _) in zip(tops, wanted):
            n = len(top.score)
            yield pa.RecordBatch.from_arrays(
                [pa.array([number] * n, pa.int64()), pa.array([item_id] * n, pa.int64()),
                 pa.array(top.doc_id, mask=top.unknown), pa.array(top.score)],
                names=["number", "item_id", "doc_id", "score"])

    return found.mapInArrow(search, "number long, item_id long, doc_id long, score long")


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of ``(doc_id, text)`` for each
    item of ``(item_id, text)``.

    Terms are runs of ASCII letters, digits and characters beyond ASCII in the whole text, only
    A-Z lower-cased. N counts the documents with terms, L their terms, df a term's documents. A
    term weighs floor(1000 ln((2N + 2) / (2 df + 1))); a document of n terms gains
    weight * ((10^9 tf) div (1000 tf + 20 m)) by it, with m = 50 + (50 n N) div L, in 64-bit
    integers. Only scores above 0 count. Equal scores stand by ascending doc_id, a null doc_id
    last.

    Null and empty texts have no terms; an item without any has no rows, nor has one that
    matches nothing. Rows that share a doc_id are documents of their own, and rows that share
    an item_id are items of their own with a list each. Empty tables give no rows.

    Items are taken to the tasks in blocks of bounded size, one pass over the documents each. A
    task keeps the best ``k`` of every item across its shards, so later shards stop earlier.
    """
    out = None
    for block in item_blocks(items):
        names = sorted(set().union(*[i.terms for i in block]))
        vocabulary = {t: i for i, t in enumerate(names)}
        found = written(postings(docs, vocabulary), "postings")
        n_docs, n_terms = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        weights = np.zeros(len(names), np.int64)
        # One row per term of the block.
        for row in found.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
            weights[row.term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * row["count"] + 1)))
        part = _searched(block, vocabulary, weights, n_docs, n_terms or 1, k, found)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = docs.sparkSession.createDataFrame([], "number long, item_id long, doc_id long, score long")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("item_id", "rank", "doc_id", "score"))
