"""How the sources of a language differ in their words: a token-start pointer sort.

Each task works on slices of the Arrow text buffer. Pointers to all word starts of a slice are
sorted by what they point at, eight bytes at a time: pointers with equal bytes so far form a
run, and only runs that are not told apart go on to the next eight bytes. Equal runs give the
documents and occurrences of a term per source, which Spark adds up.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kerbside.llm.common import Rows, grouped
from kerbside.sources.scratch import written

#: Bytes of text that one pointer table covers (a longer text has a table of its own).
SLICE_BYTES = 4 << 20

#: Cells (sources x terms) that are compared at a time.
BLOCK_CELLS = 1 << 14

# Term bytes: letters and all bytes of characters beyond ASCII.
_IN_TERM = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
_LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def word_bounds(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the terms in a byte buffer; no term runs across an edge."""
    inside = _IN_TERM[data]
    before = np.concatenate(([False], inside[:-1]))
    after = np.concatenate((inside[1:], [False]))
    first, last = edges[:-1], edges[1:] - 1
    filled = edges[1:] > edges[:-1]
    before[first[filled]] = False
    after[last[filled]] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def _keys(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Gives, for pointers and a depth, the eight bytes of each term from ``8 * depth`` on as a
    number that sorts like them; what lies behind the term counts as zero, which no term holds."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    eights = np.lib.stride_tricks.sliding_window_view(padded, 8)
    masks = np.array([(1 << 64) - (1 << (64 - 8 * n)) for n in range(9)], np.uint64)

    def key(pointers: np.ndarray, depth: int) -> np.ndarray:
        at = start[pointers] + 8 * depth
        taken = np.ascontiguousarray(eights[at]).view(">u8").ravel().astype(np.uint64)
        return taken & masks[np.clip(end[pointers] - at, 0, 8)]

    return key


def pointer_sort(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the terms, and for each place in it whether a new term begins there."""
    keys = _keys(data, start, end)
    key = keys(np.arange(len(start)), 0)
    order = np.argsort(key)
    key = key[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = key[1:] != key[:-1]
    depth = 1
    active = np.arange(len(order))
    while True:
        # Only runs of several pointers whose terms may go on are cut further.
        run = np.cumsum(fresh[active])
        size = np.bincount(run)[run] if len(run) else run
        alive = (size > 1) & ((key & np.uint64(0xFF)) != 0)
        active, run = active[alive], run[alive]
        if not len(active):
            return order, fresh
        key = keys(order[active], depth)
        inner = np.lexsort((key, run))
        order[active] = order[active[inner]]
        key = key[inner]
        changes = (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        fresh[active[1:]] = changes
        depth += 1


def _sums(code: np.ndarray, amount: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes, how often each occurs and the sum of its amounts."""
    order = np.argsort(code, kind="stable")
    code, amount = code[order], amount[order]
    at = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1])))
    return code[at], np.diff(np.append(at, len(code))), np.add.reduceat(amount, at)


def slice_counts(data: np.ndarray, edges: np.ndarray, group: np.ndarray) -> tuple[list[bytes], ...]:
    """Terms of a slice with, per group of documents, documents and occurrences."""
    start, end = word_bounds(data, edges)
    if not len(start):
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    lower = _LOWER[data]
    doc = np.searchsorted(edges, start, side="right") - 1
    order, fresh = pointer_sort(lower, start, end)
    run = np.cumsum(fresh) - 1
    docs, groups = len(edges) - 1, int(group.max()) + 1
    seen, times, _ = _sums(run * docs + doc[order], np.ones(len(order), np.int64))
    code, n_docs, n = _sums(seen // docs * groups + group[seen % docs], times)
    firsts = order[fresh]
    text = lower.tobytes()
    names = [text[a:b] for a, b in zip(start[firsts].tolist(), end[firsts].tolist())]
    return [names[r] for r in (code // groups).tolist()], code % groups, n_docs, n


def _slices(batch: pa.RecordBatch):
    """Byte buffer and edges of consecutive texts, about SLICE_BYTES at a time."""
    text = batch.column("text")
    kind = np.int64 if pa.types.is_large_binary(text.type) else np.int32
    edges = np.frombuffer(text.buffers()[1], kind)[text.offset:text.offset + len(text) + 1].astype(np.int64)
    held = text.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(text):
        stop = int(np.searchsorted(edges, edges[at] + SLICE_BYTES, side="right")) - 1
        stop = min(max(stop, at + 1), len(text))
        yield at, stop, data[edges[at]:edges[stop]], edges[at:stop + 1] - edges[at]
        at = stop


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, source, term, n_docs, n`` per slice: to be added up."""
    def count(batches: Rows) -> Rows:
        for batch in batches:
            place = list(zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist()))
            for a, b, data, edges in _slices(batch):
                known = {g: i for i, g in enumerate(dict.fromkeys(place[a:b]))}
                group = np.array([known[g] for g in place[a:b]], np.int64)
                terms, of, n_docs, n = slice_counts(data, edges, group)
                langs, sources = (pa.array([g[i] for g in known], pa.string()) for i in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [langs.take(pa.array(of)), sources.take(pa.array(of)), pa.array(terms, pa.binary()),
                     pa.array(n_docs, pa.int64()), pa.array(n, pa.int64())],
                    names=["lang", "source", "term", "n_docs", "n"])

    return docs.select("lang", "source", F.col("text").cast("binary").alias("text")).mapInArrow(
        count, "lang string, source string, term binary, n_docs long, n long")


def _share(n: str, total: str, kept: str) -> Column:
    """Smoothed share in billionths, computed exactly."""
    return F.expr(f"1L + (CAST(1000000000 AS DECIMAL(10, 0)) * CAST({n} + 5 AS DECIMAL(20, 0)))"
                  f" div CAST({total} + 5L * {kept} AS DECIMAL(20, 0))")


def _distances(batches: Rows) -> Rows:
    """Sums of differences between all sources of a language over one block of terms.

    A row without a term names a source and its share of a term that it lacks.
    """
    for block in grouped(batches, "key"):
        term, share = block["term"], np.array(block["share"], np.int64)
        heads = [i for i, t in enumerate(term) if t is None]
        names = sorted(block["source"][i] for i in heads)
        line = {s: i for i, s in enumerate(names)}
        places = np.array([line[s] for s in block["source"]])
        cells = np.array([i for i, t in enumerate(term) if t is not None], np.int64)
        base = np.zeros(len(names), np.int64)
        base[places[heads]] = share[heads]
        columns, column = np.unique(np.array([term[i] for i in cells], np.int64), return_inverse=True)
        table = np.repeat(base[:, None], len(columns), axis=1)
        table[places[cells], column] = share[cells]
        lang = block["lang"][0]
        for i, name in enumerate(names):
            value = np.abs(table - table[i]).sum(axis=1)
            others = [j for j in range(len(names)) if j != i]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(others), pa.string()), pa.array([name] * len(others), pa.string()),
                 pa.array([names[j] for j in others], pa.string()), pa.array(value[others], pa.int64())],
                names=["lang", "source", "item", "value"])


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """``lang, source, part, item, value, rank`` for the sources of each language.

    Terms are runs of letters and of characters beyond ASCII in the whole text, only A-Z
    lower-cased; each language keeps those in at least ``min_docs`` of its documents. A group's
    share of a kept term is 1 + floor(10^9 (n + 5) / (N + 5 V)). Part ``pair`` sums the
    differences of two sources of a language over all kept terms, part ``term`` lists the
    ``top`` terms whose share is above the language's.

    Null and empty text, lang and source are the same. Rows are documents of their own, whatever
    their ids. A source without terms is compared as well; a language without kept terms has
    pairs of value 0 and no terms; a language with one source has no pairs. Equal values stand
    by the bytes of the item. An empty table gives no rows.
    """
    clean = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = written(term_counts(clean).groupBy("lang", "source", "term").agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n").alias("n")), "term-counts")
    kept = written(counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("n_docs"), F.sum("n").alias("lang_n"))
                   .where(F.col("n_docs") >= min_docs).withColumn("term_no", F.monotonically_increasing_id()),
                   "kept-terms")
    present = written(counts.drop("n_docs").join(kept.drop("n_docs"), ["lang", "term"]), "present-terms")
    sources = clean.select("lang", "source").distinct()
    per_source = present.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    per_lang = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"), F.sum("lang_n").alias("lang_total"))
    per_size = sources.groupBy("lang").agg(F.count(F.lit(1)).alias("n_sources"))
    groups = written(
        sources.join(per_source, ["lang", "source"], "left").join(per_lang, "lang", "left").join(per_size, "lang")
        .fillna(0, ["total", "kept", "lang_total"])
        .withColumn("blocks", F.ceil(F.col("kept") * F.col("n_sources") / F.lit(BLOCK_CELLS)).cast("long"))
        .withColumn("blocks", F.greatest("blocks", F.lit(1))), "term-sources")

    shared = present.join(groups, ["lang", "source"]).withColumn("share", _share("n", "total", "kept"))
    key = F.concat(F.col("block").cast("string"), F.lit(" "), F.col("lang"))
    heads = groups.select(
        "lang", "source", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.lit(None).cast("long").alias("term"),
        F.when(F.col("kept") > 0, _share("0L", "total", "kept")).otherwise(F.lit(0).cast("long")).alias("share"))
    cells = shared.select("lang", "source", F.pmod(F.xxhash64("term_no"), "blocks").alias("block"),
                          F.col("term_no").alias("term"), "share")
    pairs = (heads.unionByName(cells).select(key.alias("key"), "lang", "source", "term", "share")
             .repartition("key").sortWithinPartitions("key")
             .mapInArrow(_distances, "lang string, source string, item string, value long")
             .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    terms = (shared.withColumn("value", F.col("share") - _share("lang_n", "lang_total", "kept"))
             .where("value > 0").select("lang", "source", F.col("term").cast("string").alias("item"), "value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        return rows.withColumn("rank", F.row_number().over(order)).select(
            "lang", "source", F.lit(part).alias("part"), "item", "value", "rank")

    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top))
