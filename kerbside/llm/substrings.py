"""Substring deduplication with FM-indexes over shards of text fragments.

Every window of ``length`` words has an anchor: its smallest hashed k-gram, leftmost among
equals. Consecutive windows with one anchor make a fragment, so equal windows lie in fragments
of equal anchors, and only anchors that occur in two documents or more matter. Their distinct
fragments, each with the smallest document that holds it, are dealt to shards by anchor; in a
shard, fragments of later documents stream past an index of those of earlier ones, which tells
for each window an earlier document in which it starts.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from kerbside.llm.common import Rows, grouped, id_or_last, slices
from kerbside.llm.fm_index import FMIndex, matches
from kerbside.sources.scratch import written

#: Words per k-gram of an anchor.
ANCHOR_WORDS = 8
#: Words after which a shard is closed (at the next anchor).
SHARD_WORDS = 400_000
#: Different fragments from which on the windows of an anchor are counted before indexing.
CROWD = 2_000

_ANCHORS = ("doc long, carried {carried}, n_words long, whole_sha256 string, packed binary, "
            "fragments array<struct<anchor:long,digest:long,start:int,words:int>>")
_FRAGMENT = "anchor long, digest long, least long, words binary"
_RUN = "anchor long, digest long, from_window int, to_window int, first_doc long"
_WINDOW = "anchor long, digest long, least long, place int, window long, window_b long"


def anchored(words: list[bytes], length: int) -> list[tuple[int, int, int, int]]:
    """(anchor, digest of the words, first word, number of words) of each fragment."""
    n = len(words)
    if n < length:
        return []
    k = min(ANCHOR_WORDS, length)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, n)
    grams = np.full(n - k + 1, k, np.uint64)
    for i in range(k):
        grams = (grams ^ hashed[i:n - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(29)
    wide = np.lib.stride_tricks.sliding_window_view(grams, length - k + 1)
    places = np.arange(n - length + 1) + wide.argmin(axis=1)
    first = np.flatnonzero(np.concatenate(([True], places[1:] != places[:-1])))
    last = np.append(first[1:], len(places)) - 1 + length
    anchors = grams[places[first]].view(np.int64)
    ends = np.cumsum([len(w) + 1 for w in words])
    text = memoryview(b" ".join(words))
    begins = np.concatenate(([0], ends))[first].tolist()
    stops = (ends[last - 1] - 1).tolist()
    digests = [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in zip(begins, stops)]
    return list(zip(anchors.tolist(), np.array(digests, np.uint64).view(np.int64).tolist(),
                    first.tolist(), (last - first).tolist()))


def _find_anchors(length: int):
    def find(batches: Rows) -> Rows:
        shrink = zstandard.ZstdCompressor(3)
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                words = (text or b"").split()
                rows.append((len(words), hashlib.sha256(b" ".join(words)).hexdigest(),
                             None if text is None else shrink.compress(text),
                             [dict(zip(("anchor", "digest", "start", "words"), f))
                              for f in anchored(words, length)]))
            kind = pa.list_(pa.struct([("anchor", pa.int64()), ("digest", pa.int64()),
                                       ("start", pa.int32()), ("words", pa.int32())]))
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("carried"), pa.array(columns[0], pa.int64()),
                 pa.array(columns[1], pa.string()), pa.array(columns[2], pa.binary()),
                 pa.array(columns[3], kind)],
                names=["doc", "carried", "n_words", "whole_sha256", "packed", "fragments"])

    return find


def _cut_out(batches: Rows) -> Rows:
    """Words of the wanted fragments of each text."""
    grow = zstandard.ZstdDecompressor()
    for batch in slices(batches, 256):
        rows = []
        for text, wanted in zip(batch.column("packed").to_pylist(), batch.column("wanted").to_pylist()):
            words = grow.decompress(text).split()
            for w in wanted:
                rows.append((w["anchor"], w["digest"], w["least"],
                             b" ".join(words[w["start"]:w["start"] + w["words"]])))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 4, (
                pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
            names=["anchor", "digest", "least", "words"])


def _windows(length: int):
    """All windows of fragments, by a 128-bit digest of their words."""
    def windows(batches: Rows) -> Rows:
        for batch in slices(batches, 512):
            rows = []
            for anchor, digest, least, text in zip(*(batch.column(c).to_pylist()
                                                     for c in ("anchor", "digest", "least", "words"))):
                words = text.split(b" ")
                for place in range(len(words) - length + 1):
                    mark = xxhash.xxh3_128_digest(b" ".join(words[place:place + length]))
                    rows.append((anchor, digest, least, place, int.from_bytes(mark[:8], "little", signed=True),
                                 int.from_bytes(mark[8:], "little", signed=True)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, (
                    pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()))],
                names=["anchor", "digest", "least", "place", "window", "window_b"])

    return windows


def _may_repeat(flat: np.ndarray, group: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Whether all k-grams of the windows that begin at ``at`` occur twice or more in their group
    (given per word): the others repeat nothing."""
    k = min(ANCHOR_WORDS, length)
    n = len(flat) - k + 1
    grams = group[:n].astype(np.uint64)
    for i in range(k):
        grams = (grams ^ flat[i:n + i].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        grams ^= grams >> np.uint64(29)
    _, kind, count = np.unique(grams, return_inverse=True, return_counts=True)
    lone = np.concatenate(([0], np.cumsum(count[kind] == 1)))
    return lone[at + length - k + 1] == lone[at]


def _search(length: int, shard_words: int):
    """Stream fragments, sorted by anchor, past the fragments of smaller documents in their shard.

    Two fragments of an anchor, numbered by document, have numbers that agree above some bit and
    differ in it. So for each bit the fragments without it are indexed and those with it stream
    past, and every fragment meets all earlier ones of its anchor, in as many passes as the
    largest number has bits; no fragment streams past an index that holds it. A window that is
    found drops out of later passes on both sides: its first occurrence never does.
    """
    def shard(held: dict[str, list]) -> pa.RecordBatch:
        split = [w.split(b" ") for w in held["words"]]
        names = {w: i + 1 for i, w in enumerate(dict.fromkeys(w for ws in split for w in ws))}
        flat = np.fromiter((names[w] for ws in split for w in ws), np.int64)
        sizes = np.array([len(ws) for ws in split])
        least = np.array(held["least"], np.int64)
        number, many = np.array(held["number"], np.int64), np.array(held["many"], np.int64)
        # Per window: its fragment, its place there and in ``flat``.
        windows = sizes - length + 1
        query = np.repeat(np.arange(len(sizes)), windows)
        start = np.arange(len(query)) - np.repeat(np.cumsum(windows) - windows, windows)
        at = (np.cumsum(sizes) - sizes)[query] + start
        group = np.repeat(np.unique(np.array(held["anchor"], np.int64), return_inverse=True)[1], sizes)
        first = least[query]
        live = _may_repeat(flat, group, at, length)
        for bit in range(int(number.max()).bit_length()):
            # Runs of live windows, [begin, stop).
            same = np.append(query[1:] == query[:-1], False) & live & np.append(live[1:], False)
            begin = np.flatnonzero(live & ~np.concatenate(([False], same[:-1])))
            stop = np.flatnonzero(live & ~same) + 1
            who = number[query[begin]] >> bit
            later = np.flatnonzero(who & 1)
            earlier = np.flatnonzero((who & 1 == 0) & ((who | 1) << bit < many[query[begin]]))
            if not len(later) or not len(earlier):
                continue
            pieces = [flat[a:b] for a, b in zip(at[begin].tolist(), (at[stop - 1] + length).tolist())]
            text = np.concatenate([np.append(pieces[i], 0) for i in earlier])
            owner = np.repeat(least[query[begin[earlier]]], [len(pieces[i]) + 1 for i in earlier])
            # Symbols of this index; 0, the separator, also stands for words it lacks.
            used = np.unique(text)
            code = np.zeros(len(names) + 1, np.int64)
            code[used] = np.arange(len(used))
            index = FMIndex(code[text], len(used), length, owner)
            hit, place, owners = matches(index, [code[pieces[i]] for i in later])
            found = begin[later[hit]] + place
            smaller = owners < least[query[found]]
            first[found[smaller]] = owners[smaller]
            live[found[smaller]] = False
        # Runs of neighbouring windows with the same document.
        edge = np.concatenate(([True], (query[1:] != query[:-1]) | (first[1:] != first[:-1])))
        begin = np.flatnonzero(edge)
        end = np.append(begin[1:], len(query)) - 1
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(held["anchor"], np.int64)[query[begin]]),
             pa.array(np.array(held["digest"], np.int64)[query[begin]]),
             pa.array(start[begin].astype(np.int32)), pa.array(start[end].astype(np.int32)), pa.array(first[begin])],
            names=["anchor", "digest", "from_window", "to_window", "first_doc"])

    def search(batches: Rows) -> Rows:
        held: dict[str, list] = {}
        size = 0
        for group in grouped(batches, "anchor"):
            if size >= shard_words:
                yield shard(held)
                held, size = {}, 0
            place = np.argsort(np.argsort(np.array(group["least"], np.int64), kind="stable"))
            group["number"], group["many"] = place.tolist(), [len(place)] * len(place)
            for name, values in group.items():
                held.setdefault(name, []).extend(values)
            size += sum(w.count(b" ") + 2 for w in group["words"])
        if held:
            yield shard(held)

    return search


def _covered(words: list[bytes], spans: list[dict]) -> np.ndarray:
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, [s["start"] for s in spans], 1)
    np.add.at(change, [s["stop"] for s in spans], -1)
    return np.cumsum(change[:-1]) > 0


def _remove(with_text: bool):
    """Drop covered words; hash the rest or return it as text."""
    def remove(batches: Rows) -> Rows:
        grow = zstandard.ZstdDecompressor()
        for batch in slices(batches, 256):
            rows = []
            for whole, packed, spans in zip(*(batch.column(c).to_pylist()
                                              for c in ("whole_sha256", "packed", "spans"))):
                if not spans:
                    text = grow.decompress(packed) if with_text and packed is not None else None
                    rows.append((0, text if with_text else whole))
                    continue
                words = grow.decompress(packed).split()
                gone = _covered(words, spans)
                kept = b" ".join([w for w, g in zip(words, gone.tolist()) if not g])
                rows.append((int(gone.sum()), kept if with_text else hashlib.sha256(kept).hexdigest()))
            columns = list(zip(*rows)) if rows else [[]] * 2
            last = pa.array(columns[1], pa.binary()).cast(pa.string()) if with_text else pa.array(columns[1], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("carried"), batch.column("n_words"), pa.array(columns[0], pa.int64()), last],
                names=["carried", "n_words", "n_removed", "text" if with_text else "kept_sha256"])

    return remove


def _indexed(fragments: DataFrame, length: int, shard_words: int) -> DataFrame:
    return (fragments.select("anchor", "digest", "least", "words")
            .repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(_search(length, shard_words), _RUN))


def _crowded(fragments: DataFrame, length: int) -> DataFrame:
    """Runs for anchors with very many different fragments, such as the edges of a passage that
    a third of all documents quote.

    Neither an anchor nor a passage has to fit into one task: windows are counted by digest,
    with map-side sums. An index would not serve here, as blocks of fragments would have to
    stream past each other, which is quadratic in the crowd.
    """
    windows = written(fragments.mapInArrow(_windows(length), _WINDOW), "windows")
    often = written(windows.groupBy("window", "window_b").agg(
        F.count(F.lit(1)).alias("n"), F.min("least").alias("first_doc")).where("n > 1").drop("n"), "often")
    return windows.join(often, ["window", "window_b"], "left").select(
        "anchor", "digest", F.col("place").alias("from_window"), F.col("place").alias("to_window"),
        F.coalesce("first_doc", "least").alias("first_doc"))


def _spans(docs: DataFrame, carried: Column, length: int, shard_words: int, crowd: int) -> DataFrame:
    """``carried, n_words, whole_sha256, packed, spans``: words to remove from each row's text."""
    held = docs.select(id_or_last("doc_id").alias("doc"), carried.alias("carried"),
                       F.col("text").cast("string").cast("binary").alias("text"))
    found = written(
        held.mapInArrow(_find_anchors(length), _ANCHORS.format(
            carried=held.schema["carried"].dataType.simpleString()))
        .withColumn("row", F.monotonically_increasing_id()), "anchors")
    every = found.select("row", "doc", F.explode("fragments").alias("f")).select("row", "doc", "f.*")
    # Written, so that the join is planned on its own and a hot anchor's rows can be split.
    shared = written(every.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"))
                     .where("lo < hi").select("anchor"), "shared")
    placed = written(every.join(shared, "anchor", "left_semi"), "placed")
    # One fragment of each content, from its smallest document, whatever the number of copies.
    distinct = written(placed.groupBy("anchor", "digest").agg(
        F.min(F.struct("doc", "row", "start", "words")).alias("at")), "distinct")
    wanted = distinct.groupBy("at.row").agg(F.collect_list(F.struct(
        "anchor", "digest", F.col("at.doc").alias("least"), "at.start", "at.words")).alias("wanted"))
    cut = written(found.select("row", "packed").join(wanted, "row").select("packed", "wanted")
                  .mapInArrow(_cut_out, _FRAGMENT), "fragments")
    crowds = written(distinct.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"))
                     .where(F.col("n") > crowd).select("anchor"), "crowds")
    runs = written(
        _indexed(cut.join(crowds, "anchor", "left_anti"), length, shard_words)
        .unionByName(_crowded(cut.join(crowds, "anchor", "left_semi"), length)), "runs")
    spans = (placed.select("row", "doc", "anchor", "digest", "start").join(runs, ["anchor", "digest"])
             .where("first_doc < doc")
             .groupBy("row").agg(F.collect_list(F.struct(
                 (F.col("start") + F.col("from_window")).alias("start"),
                 (F.col("start") + F.col("to_window") + length).alias("stop"))).alias("spans")))
    return found.select("row", "carried", "n_words", "whole_sha256", "packed").join(
        spans, "row", "left").drop("row")


def judged(docs: DataFrame, length: int = 50, shard_words: int = SHARD_WORDS,
           crowd: int = CROWD) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for each row of ``(doc_id, text)``.

    A word goes if a window of ``length`` words that covers it also starts in a document with a
    smaller doc_id; windows are judged on the input. Words are runs without ASCII white space.
    A null or blank text has no words. Repeats within a document, or between rows that share a
    doc_id, remove nothing; a null doc_id comes after all others.
    """
    found = _spans(docs, F.col("doc_id").cast("long"), length, shard_words, crowd)
    return found.mapInArrow(
        _remove(False), "carried long, n_words long, n_removed long, kept_sha256 string"
    ).withColumnRenamed("carried", "doc_id")


def shortened(docs: DataFrame, length: int = 50, shard_words: int = SHARD_WORDS,
              crowd: int = CROWD) -> DataFrame:
    """All rows and columns of ``docs``; a text that loses words becomes the kept words, joined
    by one space, others stay as they are (see ``judged``)."""
    columns = docs.columns
    others = F.struct(*[F.col(f"`{c}`") for c in columns if c not in ("text",)])
    found = _spans(docs, others, length, shard_words, crowd)
    kind = found.schema["carried"].dataType.simpleString()
    cut = found.mapInArrow(_remove(True), f"carried {kind}, n_words long, n_removed long, text string")
    return cut.select(*[(F.col("text") if c == "text" else F.col(f"carried.`{c}`")).alias(c) for c in columns])
