"""Packing along a space-filling curve.

Token counts of a document are hashed to a vector, projected to a few dimensions and turned
into a Hilbert key. Documents are laid end to end in the order of their keys, so neighbours on
the curve share sequences, and the line is cut every ``length`` tokens.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from kerbside.llm.common import Rows, running_offsets, slices, text_slices
from kerbside.llm.encoding import encoder
from kerbside.sources.scratch import written

PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
         "sequence_id long, offset long")


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of integer points (n, dims) with ``bits`` bits a dimension."""
    x = points.astype(np.int64).copy()
    dims = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, low = 1 << level, (1 << level) - 1
        for d in range(dims):
            swap = np.where(x[:, d] & bit, 0, (x[:, 0] ^ x[:, d]) & low)
            x[:, 0] ^= np.where(x[:, d] & bit, low, swap)
            if d:
                x[:, d] ^= swap
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    flip = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[:, -1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[:, d] >> level) & 1)
    return key


class Curve:
    """Hashed token counts -> ``dims`` random directions -> Hilbert key."""

    def __init__(self, dims: int = 4, bits: int = 15, buckets: int = 256, seed: int = 7):
        self.bits, self.buckets = bits, buckets
        self.directions = np.random.default_rng(seed).standard_normal((buckets, dims))

    def keys(self, documents: list[np.ndarray]) -> np.ndarray:
        rows = np.zeros((len(documents), self.buckets))
        for row, ids in zip(rows, documents):
            mixed = ids.astype(np.uint32) * np.uint32(0x9E3779B1)
            row += np.bincount(mixed >> np.uint32(24), weights=1.0 - 2.0 * ((mixed >> np.uint32(12)) & 1),
                               minlength=256)[:self.buckets]
        rows /= np.maximum(np.linalg.norm(rows, axis=1), 1e-12)[:, None]
        spread = 1.0 / (1.0 + np.exp(-1.7 * (rows @ self.directions)))
        return hilbert_key(np.minimum((spread * (1 << self.bits)).astype(np.int64),
                                      (1 << self.bits) - 1), self.bits)


def pack(docs: DataFrame, vocabulary: str, end_id: int, length: int = 4096, spaced: bool = False,
         with_ids: bool = False, marks: bool = False) -> DataFrame:
    """One row per piece of a document of ``(doc_id, text)``.

    Every row is a document: a null text is empty and gives the end id alone, rows that share a
    doc_id or have none are packed one by one. Pieces cover each document without gap or
    overlap; all sequences but the last are full. ``with_ids`` adds the ids as ``array<int>``.
    Equal keys (copies) are ordered by a row number, so a hot key spreads over partitions.
    ``marks``: special tokens in a text give their own ids, as the library does by default.
    """
    def tokenize(batches: Rows) -> Rows:
        code, curve, shrink = encoder(vocabulary, spaced, marks), Curve(), zstandard.ZstdCompressor(1)
        for batch in text_slices(batches):
            got = code.split(batch.column("text"), end_id)
            wide = [ids.astype("<u2") if len(ids) == 0 or ids.max() < 1 << 16 else ids for ids in got]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([shrink.compress(w.tobytes()) for w in wide], pa.binary()),
                 pa.array([w.itemsize for w in wide], pa.int32()),
                 pa.array([len(ids) for ids in got], pa.int64()), pa.array(curve.keys(got))],
                names=["doc_id", "data", "width", "doc_tokens", "curve"])

    tokens = written(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(tokenize, "doc_id long, data binary, width int, doc_tokens long, curve long")
        .withColumn("_row", F.monotonically_increasing_id()), "tokens")
    places = running_offsets(tokens.select("curve", "_row", "doc_tokens"), ["curve", "_row"],
                             "doc_tokens", "position")

    def cut(batches: Rows) -> Rows:
        grow = zstandard.ZstdDecompressor()
        for batch in slices(batches, 256):
            rows = []
            for row in batch.to_pylist():
                ids = np.frombuffer(grow.decompress(row["data"]), f"<u{row['width']}").astype("<u4")
                at, n = row["position"], row["doc_tokens"]
                start = 0
                while start < n:
                    sequence, offset = divmod(at + start, length)
                    stop = min(n, start + length - offset)
                    piece = ids[start:stop]
                    rows.append((row["doc_id"], start, stop - start, zlib.crc32(piece.tobytes()), n,
                                 sequence, offset, *([piece.astype(np.int32)] if with_ids else [])))
                    start = stop
            names = [f.split()[0] for f in PIECE.split(", ")] + ["ids"] * with_ids
            kinds = [pa.int64()] * 7 + [pa.list_(pa.int32())] * with_ids
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)],
                names=names)

    return (tokens.join(places.select("_row", "position"), "_row")
            .select("doc_id", "data", "width", "doc_tokens", "position")
            .mapInArrow(cut, PIECE + (", ids array<int>" if with_ids else "")))
