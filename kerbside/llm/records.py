"""Token-ID output: length-delimited binary records with a separate offset index.

A shard is a sequence of frames: the length of the data (unsigned 64-bit), a masked CRC-32C of
those eight bytes, the data, a masked CRC-32C of the data; all little-endian. The data is the
document id (signed 64-bit), the number of ids and their width in bytes (two unsigned 32-bit
numbers) and the ids (16 or 32 bits each). The index of a shard lists (document id, offset,
frame length) as three signed 64-bit numbers for each frame.
"""

from __future__ import annotations

import re
import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F

from kerbside.llm.common import LAST_ID, Rows, id_or_last, slices
from kerbside.llm.encoding import encoder
from kerbside.sources.scratch import scratch_path, written

# Fixed values of the frame format: reflected Castagnoli polynomial and the checksum mask.
POLYNOMIAL = 0x82F63B78
MASK_DELTA = 0xA282EAD8

_BLOCK = 64
_HEAD = struct.Struct("<QI")
_DATA = struct.Struct("<qII")

MANIFEST = ("part int, shard int, path string, index_path string, n_records long, n_ids long, "
            "n_bytes long")


def _byte_steps() -> np.ndarray:
    """State after one zero byte, for each value of the low byte."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(POLYNOMIAL), steps >> 1)
    return steps.astype(np.uint32)


_BYTE = _byte_steps()


def _advance(state: np.ndarray, n: int) -> np.ndarray:
    for _ in range(n):
        state = _BYTE[state & 0xFF] ^ (state >> np.uint32(8))
    return state


_PAIR = _advance(np.arange(1 << 16, dtype=np.uint32), 2)


def _operator(images: np.ndarray) -> np.ndarray:
    """Four tables of 256 from the images of the 32 unit states."""
    tables = np.zeros((4, 256), np.uint32)
    for byte in range(4):
        for bit in range(8):
            rows = (np.arange(256) >> bit) & 1 == 1
            tables[byte, rows] ^= images[8 * byte + bit]
    return tables


def _apply(tables: np.ndarray, state: np.ndarray) -> np.ndarray:
    return (tables[0][state & 0xFF] ^ tables[1][(state >> np.uint32(8)) & 0xFF]
            ^ tables[2][(state >> np.uint32(16)) & 0xFF] ^ tables[3][state >> np.uint32(24)])


def _block_operators() -> list[np.ndarray]:
    """Advance by 1, 2, 4, ... blocks of zero bytes."""
    images = _advance(np.uint32(1) << np.arange(32, dtype=np.uint32), _BLOCK)
    found = []
    for _ in range(32):
        found.append(_operator(images))
        images = _apply(found[-1], images)
    return found


_SHIFTS = _block_operators()


def masked_checksums(chunks: list[bytes]) -> np.ndarray:
    """Masked CRC-32C of each chunk of four bytes or more, computed side by side.

    Chunks are filled up with zero bytes in front (which leave a zero state alone) and cut into
    blocks; the blocks advance together and are then shifted to their places.
    """
    if not chunks:
        return np.zeros(0, np.uint32)
    sizes = np.array([len(c) for c in chunks])
    counts = -(-sizes // _BLOCK)
    data = bytearray().join(x for c, n, k in zip(chunks, sizes, counts)
                            for x in (bytes(k * _BLOCK - n), c))
    padded = np.frombuffer(data, np.uint8)
    ends = np.cumsum(counts) * _BLOCK
    for byte in range(4):  # the initial state of all ones
        padded[ends - sizes + byte] ^= 0xFF
    words = padded.view("<u2").reshape(-1, _BLOCK // 2)
    state = np.zeros(len(words), np.uint32)
    for column in words.T:
        state = _PAIR[(state ^ column) & 0xFFFF] ^ (state >> np.uint32(16))
    firsts = np.cumsum(counts) - counts
    behind = np.repeat(firsts + counts - 1, counts) - np.arange(len(words))
    for bit in range(int(behind.max()).bit_length()):
        rows = np.flatnonzero((behind >> bit) & 1)
        state[rows] = _apply(_SHIFTS[bit], state[rows])
    plain = np.bitwise_xor.reduceat(state, firsts) ^ np.uint32(0xFFFFFFFF)
    return ((plain >> np.uint32(15)) | (plain << np.uint32(17))) + np.uint32(MASK_DELTA)


def frames(data: list[bytes]) -> list[bytes]:
    lengths = [struct.pack("<Q", len(d)) for d in data]
    return [b"".join((n, a.tobytes(), d, b.tobytes())) for n, a, d, b in
            zip(lengths, masked_checksums(lengths), data, masked_checksums(data))]


def unframed(buffer: bytes, at: list[tuple[int, int]]) -> list[bytes]:
    """The data of the frames at (offset, length), checked against both checksums."""
    heads, bodies, sums = [], [], []
    for offset, length in at:
        size, _ = _HEAD.unpack_from(buffer, offset)
        if size + 16 != length:
            raise ValueError(f"frame at {offset} has {size} bytes of data, not {length - 16}")
        heads.append(buffer[offset:offset + 8])
        bodies.append(buffer[offset + 12:offset + length - 4])
        sums.append((buffer[offset + 8:offset + 12], buffer[offset + length - 4:offset + length]))
    stored = np.frombuffer(b"".join(a + b for a, b in sums), "<u4").reshape(-1, 2)
    if (stored[:, 0] != masked_checksums(heads)).any() or (stored[:, 1] != masked_checksums(bodies)).any():
        raise ValueError("checksum mismatch")
    return bodies


def folder(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path that Spark uses, for executors."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", path))


def pack_sequence(doc_id: int, ids: np.ndarray, width: int) -> bytes:
    return _DATA.pack(doc_id, len(ids), width) + ids.astype(f"<u{width}").tobytes()


def unpack_sequence(data: bytes) -> tuple[int, np.ndarray]:
    doc_id, n, width = _DATA.unpack_from(data)
    ids = np.frombuffer(data, f"<u{width}", offset=_DATA.size)
    if len(ids) != n:
        raise ValueError(f"document {doc_id} has {len(ids)} ids, not {n}")
    return doc_id, ids.astype("<u4")


def write_sequences(docs: DataFrame, vocabulary: str, end_id: int, spaced: bool = True,
                    width: int = 2, shard_bytes: int = 32 << 20, target: str | None = None,
                    marks: bool = False) -> DataFrame:
    """Write the ids of ``(doc_id, text)`` in ascending doc_id order; return the manifest.

    A null text is empty (only the end id is written); rows that share a doc_id are all written,
    ordered by a hash of the text; null doc_ids come last. Tasks write shards of about
    ``shard_bytes`` under names of their own and report them as rows, so the shards of an
    attempt that was lost are simply not in the manifest. ``width`` is 2 bytes for vocabularies
    of up to 65,536 ids, else 4. ``marks``: special tokens in a text give their own ids, as the
    library does by default.
    """
    out = target or scratch_path(docs.sparkSession, "sequences")

    def write(batches: Rows) -> Rows:
        from pyspark import TaskContext

        store, base = folder(out)
        store.create_dir(base, recursive=True)
        part, shard, done = TaskContext.get().partitionId(), 0, []
        held, index, size, n_ids = [], [], 0, 0

        def flush():
            nonlocal held, index, size, n_ids, shard
            name = f"{base}/part-{part:06d}-{shard:04d}-{uuid.uuid4().hex}"
            with store.open_output_stream(f"{name}.rec") as f:
                for x in held:
                    f.write(x)
            with store.open_output_stream(f"{name}.idx") as f:
                f.write(np.array(index, "<i8").tobytes())
            row = (part, shard, f"{name}.rec", f"{name}.idx", len(index), n_ids, size)
            done.append(row)
            held, index, size, n_ids, shard = [], [], 0, 0, shard + 1

        code = encoder(vocabulary, spaced, marks)
        for batch in slices(batches, 1024):
            names = batch.column("_id").to_pylist()
            got = code.split(batch.column("text"), end_id)
            for name, ids, frame in zip(names, got, frames(
                    [pack_sequence(n, ids, width) for n, ids in zip(names, got)])):
                index.append((name, size, len(frame)))
                held.append(frame)
                size += len(frame)
                n_ids += len(ids)
                if size >= shard_bytes:
                    flush()
        if index:
            flush()
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(
                zip(*done) if done else [[]] * 7,
                (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
            names=["part", "shard", "path", "index_path", "n_records", "n_ids", "n_bytes"])

    rows = docs.select(id_or_last("doc_id").alias("_id"), F.col("text").cast("string").alias("text"))
    order = [F.col("_id"), F.xxhash64("text")]
    return written(rows.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(write, MANIFEST), "manifest")


def _spread(manifest: DataFrame) -> DataFrame:
    """One shard per task, as far as ranges allow."""
    n = max(1, manifest.count())
    return manifest.repartitionByRange(n, "part", "shard")


def read_sequences(manifest: DataFrame) -> DataFrame:
    """Every record of the manifest's shards, in the files' order, with its place.

    Returns doc_id, start (ids of all records before it), n_tokens, ids_crc32 (of the ids as
    unsigned 32-bit numbers). Frames are read in stretches of a few MB and checked.
    """
    earlier = Window.orderBy("part", "shard").rowsBetween(Window.unboundedPreceding, -1)
    based = manifest.select("part", "shard", "path", "index_path",
                            F.coalesce(F.sum("n_ids").over(earlier), F.lit(0)).alias("base"))

    def read(batches: Rows) -> Rows:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = folder(row["path"])
                with store.open_input_stream(row["index_path"]) as f:
                    index = np.frombuffer(f.read(), "<i8").reshape(-1, 3)
                start, first = row["base"], 0
                with store.open_input_file(path) as f:
                    while first < len(index):
                        last = first + max(1, int(np.searchsorted(
                            index[first:, 1] + index[first:, 2], index[first, 1] + (4 << 20))))
                        some = index[first:last]
                        base = int(some[0, 1])
                        buffer = f.read_at(int(some[-1, 1] + some[-1, 2]) - base, base)
                        got = [unpack_sequence(d) for d in unframed(
                            buffer, [(int(o) - base, int(n)) for _, o, n in some])]
                        sizes = np.array([len(ids) for _, ids in got], np.int64)
                        yield pa.RecordBatch.from_arrays([
                            pa.array([None if d == LAST_ID else d for d, _ in got], pa.int64()),
                            pa.array(start + np.cumsum(sizes) - sizes), pa.array(sizes),
                            pa.array([zlib.crc32(ids.tobytes()) for _, ids in got], pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])
                        start += int(sizes.sum())
                        first = last

    return _spread(based).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_index(manifest: DataFrame) -> DataFrame:
    """``(path, doc_id, offset, length)`` of every record: shuffle or sample these rows, then
    fetch them with ``read_at``."""
    def read(batches: Rows) -> Rows:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = folder(row["index_path"])
                with store.open_input_stream(path) as f:
                    index = np.frombuffer(f.read(), "<i8").reshape(-1, 3)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["path"]] * len(index)),
                     pa.array(index[:, 0], mask=index[:, 0] == LAST_ID),
                     pa.array(index[:, 1]), pa.array(index[:, 2])],
                    names=["path", "doc_id", "offset", "length"])

    return _spread(manifest).mapInArrow(read, "path string, doc_id long, offset long, length long")


def read_at(rows: DataFrame) -> DataFrame:
    """``(doc_id, ids)`` of single records given by ``(path, offset, length)``, in the rows' order."""
    def read(batches: Rows) -> Rows:
        for batch in slices(batches, 256):
            got = []
            for row in batch.to_pylist():
                store, path = folder(row["path"])
                with store.open_input_file(path) as f:
                    frame = f.read_at(row["length"], row["offset"])
                got.append(unpack_sequence(unframed(frame, [(0, row["length"])])[0]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([None if d == LAST_ID else d for d, _ in got], pa.int64()),
                 pa.array([ids.astype(np.int64) for _, ids in got], pa.list_(pa.int64()))],
                names=["doc_id", "ids"])

    return rows.select("path", "offset", "length").mapInArrow(read, "doc_id long, ids array<long>")
