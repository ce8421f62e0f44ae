"""Count-min sketch of 64-bit hashes, built by partition and merged by shard.

Each task sketches its own rows in pieces of bounded size; a piece is cut into
``SHARDS`` shards a row of the sketch, whatever its width, and only counters in
use are sent. One row of the shuffle is one shard of one piece, so rows grow
with the input alone; the merge adds counters shard by shard with one shard
(4 MB at 29 bits) in memory. The merged sketch is reduced to a bit per
counter (count of 2 or more) and sent to the driver and back as a compressed
broadcast: at most ``depth * 2^width_bits / 8`` bytes, bounded by ``max_width_bits`` whatever the
input. A fuller sketch marks more hashes as repeated, never fewer: counters
only overestimate, so a hash that occurs twice is always marked.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import ship

MIN_WIDTH_BITS = 16
SHARD_LOG = 9
SHARDS = 1 << SHARD_LOG
DEPTH = 2
#: Hashes gathered before a task sends a partial sketch.
FLUSH = 2_000_000
_MIX = [np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)]
PARTIAL = "shard long, used long, cells binary, counts binary"
MERGED = "shard long, repeated binary, heavy binary"


def width_for(n_hashes: int, max_width_bits: int) -> int:
    """Bits of a row's width: about four counters a hash, up to the given bound."""
    return min(max_width_bits, max(MIN_WIDTH_BITS, math.ceil(math.log2(max(1, n_hashes) * 4))))


def cells(h: np.ndarray, row: int, bits: int) -> np.ndarray:
    x = h * _MIX[row]
    x ^= x >> np.uint64(32)
    return ((x * _MIX[1 - row]) >> np.uint64(64 - bits)).astype(np.int64)


def _pack(x: np.ndarray) -> bytes:
    """Low bytes as they are (those of gaps are random), the planes of higher bytes compressed."""
    planes = x.view(np.uint8).reshape(-1, x.itemsize).T
    squeeze = zlib.compressobj(1, zlib.DEFLATED, -15, 8, zlib.Z_RLE)
    return planes[0].tobytes() + squeeze.compress(planes[1:].tobytes()) + squeeze.flush()


def _unpack(blob: bytes, n: int, dtype) -> np.ndarray:
    high = np.frombuffer(zlib.decompress(blob[n:], -15), np.uint8).reshape(-1, n)
    return np.ascontiguousarray(np.vstack([np.frombuffer(blob[:n], np.uint8), high]).T).view(dtype).ravel()


def _partial(hashes: list[np.ndarray], bits: int) -> pa.RecordBatch:
    h = np.concatenate(hashes)
    own = bits - SHARD_LOG
    shards, used, gaps_of, counts = [], [], [], []
    for row in range(DEPTH):
        at, n = np.unique(cells(h, row, bits), return_counts=True)
        n = np.minimum(n, 65535).astype(np.uint16)
        of = at >> own
        cut = np.flatnonzero(np.diff(of)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(at)], strict=True):
            if b > a:
                gaps = np.diff((at[a:b] & ((1 << own) - 1)).astype(np.uint32), prepend=np.uint32(0))
                shards.append((row << SHARD_LOG) | int(of[a]))
                used.append(b - a)
                gaps_of.append(_pack(gaps))
                counts.append(zlib.compress(n[a:b].tobytes(), 1))
    return pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), pa.array(used, pa.int64()), pa.array(gaps_of, pa.binary()),
                                       pa.array(counts, pa.binary())], ["shard", "used", "cells", "counts"])


class Sketch:
    """The merged sketch as the tasks see it."""

    def __init__(self, bits: int, planes: np.ndarray, heavy: list[np.ndarray]):
        self.bits, self.planes, self.heavy_cells = bits, planes, heavy

    def __getstate__(self):
        """Set bits are few, so the broadcast travels and lies on disk compressed."""
        return self.bits, [zlib.compress(p.tobytes(), 1) for p in self.planes], self.heavy_cells

    def __setstate__(self, state):
        self.bits, packed, self.heavy_cells = state
        self.planes = [np.frombuffer(zlib.decompress(p, bufsize=(1 << self.bits) // 8), np.uint8) for p in packed]

    def repeated(self, h: np.ndarray) -> np.ndarray:
        """Whether each hash is estimated to occur twice or more (no false negatives)."""
        out = np.ones(len(h), bool)
        for row in range(DEPTH):
            c = cells(h, row, self.bits)
            out &= (self.planes[row][c >> 3] >> (7 - (c & 7)).astype(np.uint8)) & 1 != 0
        return out

    def heavy(self, h: np.ndarray) -> np.ndarray:
        """Whether each hash is estimated to occur ``heavy_at`` times or more."""
        out = np.ones(len(h), bool)
        for row in range(DEPTH):
            own = self.heavy_cells[row]
            c = cells(h, row, self.bits)
            i = np.searchsorted(own, c)
            out &= (own[np.minimum(i, len(own) - 1)] == c) if len(own) else False
        return out


def build(df: DataFrame, hashes: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]], n_hashes: int,
          max_width_bits: int = 29, heavy_at: int = 20_000):
    """Broadcast of the Sketch of all hashes that ``hashes`` yields over df's rows."""
    ship(df.sparkSession)
    bits = width_for(n_hashes, max_width_bits)
    width = 1 << (bits - SHARD_LOG)

    def partial(batches):
        held, n = [], 0
        for h in hashes(batches):
            held.append(h)
            n += len(h)
            if n >= FLUSH:
                yield _partial(held, bits)
                held, n = [], 0
        if n:
            yield _partial(held, bits)

    def merge(batches):
        now, total = -1, np.zeros(width, np.uint32)

        def done():
            heavy = np.flatnonzero(total >= min(heavy_at, 65535)).astype(np.uint32)
            return pa.RecordBatch.from_pydict({"shard": pa.array([now], pa.int64()), "repeated": pa.array([np.packbits(total >= 2).tobytes()], pa.binary()),
                                               "heavy": pa.array([heavy.tobytes()], pa.binary())})

        for batch in batches:
            for shard, n, gaps, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if shard != now:
                    if now >= 0:
                        yield done()
                    now = shard
                    total[:] = 0
                at = np.cumsum(_unpack(gaps, n, np.uint32), dtype=np.uint32)
                total[at] = np.minimum(total[at] + np.frombuffer(zlib.decompress(counts), np.uint16), 65535)
        if now >= 0:
            yield done()

    merged = (df.mapInArrow(partial, PARTIAL).repartition("shard").sortWithinPartitions("shard")
              .mapInArrow(merge, MERGED).toArrow())
    planes = np.zeros((DEPTH, (1 << bits) // 8), np.uint8)
    heavy: list[list[np.ndarray]] = [[] for _ in range(DEPTH)]
    step = width // 8
    for shard, repeated, big in zip(*(merged.column(i) for i in range(3)), strict=True):
        row, k = divmod(shard.as_py(), SHARDS)
        planes[row, k * step:(k + 1) * step] = np.frombuffer(repeated.as_py(), np.uint8)
        if len(x := np.frombuffer(big.as_py(), np.uint32)):
            heavy[row].append(x.astype(np.int64) + k * width)
    del merged
    flat = [np.sort(np.concatenate(x)) if x else np.zeros(0, np.int64) for x in heavy]
    return df.sparkSession.sparkContext.broadcast(Sketch(bits, planes, flat))
