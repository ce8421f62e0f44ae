"""Helpers shared by the operators: column selection, Arrow batches, rolling hashes."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text put through numpy at once (one longer text goes alone).
BATCH_BYTES = 1 << 20

#: Bytes that end a word: space, \t, \n, \v, \f, \r.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

_RNG = np.random.default_rng(20240229)
#: A random 64-bit value for each byte, the "digits" of the rolling hashes.
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Odd bases (so invertible modulo 2^64).
BASES = [int(x) | 1 for x in _RNG.integers(2**62, 2**63, 4, dtype=np.uint64)]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application, so
    that executors need not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="barline-py-")) / "barline_llm.zip"
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    _SHIPPED.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, so that no other column's name can clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up, self.down = (np.concatenate([[np.uint64(1)], np.cumprod(np.full(size - 1, b, np.uint64))]).astype(np.uint64)
                                  for b in (np.uint64(self.base), np.uint64(self.inverse)))
        return self.up[:n], self.down[:n]


POWERS = [Powers(b) for b in BASES]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def prefix_hash(values: np.ndarray, base: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial hash of ``values`` (one longer than they are) and the
    inverse powers: ``(c[j] - c[i]) * down[i]`` is the hash of ``values[i:j]``."""
    up, down = POWERS[base].upto(len(values) + 1)
    c = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=c[1:])
    return c, down


def grams(values: np.ndarray, size: int, base: int = 0) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` consecutive values."""
    if len(values) < size:
        return np.zeros(0, np.uint64)
    c, down = prefix_hash(values, base)
    return mixed((c[size:] - c[:-size]) * down[: len(values) - size + 1])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Record batches cut so that each holds about BATCH_BYTES of text (a null
    text counts as empty), with the texts as UTF-8 bytes."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index(column))
        kind = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
        raw = texts.cast(kind)
        start = total = 0
        held: list[bytes] = []
        for i, value in enumerate(raw):
            b = value.as_py() or b""
            if held and total + len(b) > BATCH_BYTES:
                yield batch.slice(start, i - start), held
                start, total, held = i, 0, []
            held.append(b)
            total += len(b)
        if held:
            yield batch.slice(start), held


class Joined:
    """Texts laid end to end with a line feed after each: bytes, offsets and lengths."""

    def __init__(self, texts: list[bytes]):
        self.texts = texts
        self.bytes = np.frombuffer(b"".join(x for t in texts for x in (t, b"\n")), np.uint8)
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.offsets = np.cumsum(self.lengths + 1) - self.lengths - 1


#: Words beyond this many bytes are hashed one by one.
LONG_WORD = 64
_LANES = [np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F)]


def eights(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place of ``raw`` on as one integer (zeros behind the end); a view of a padded copy."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    return np.ndarray(len(raw), "<u8", padded.data, strides=(1,))


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
    """Two independent 64-bit hashes of each run of bytes.

    Eight bytes at a time are put into a state and spread by a bijection, in two
    lanes with keys of their own, so no arrangement of equal bytes cancels (as it
    can in a polynomial modulo 2^64). Words beyond LONG_WORD bytes: xxh3-128.
    """
    size = ends - starts
    out = [mixed(size.astype(np.uint64) * lane + lane) for lane in _LANES]
    view = eights(raw)
    live = np.flatnonzero(size <= LONG_WORD)
    for k in range(0, LONG_WORD, 8):
        live = live[size[live] > k]
        if not len(live):
            break
        chunk = view[starts[live] + k]
        spare = np.maximum(8 - (size[live] - k), 0).astype(np.uint64) * np.uint64(8)
        chunk = (chunk << spare) >> spare
        for h, lane in zip(out, _LANES, strict=True):
            h[live] = mixed((h[live] ^ (chunk * lane)) + lane)
    for i in np.flatnonzero(size > LONG_WORD).tolist():
        both = xxhash.xxh3_128_intdigest(raw[starts[i]:ends[i]].tobytes())
        out[0][i], out[1][i] = both & 0xFFFFFFFFFFFFFFFF, both >> 64
    return out


def byte_windows(raw: np.ndarray, size: int, lane: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` bytes: spread groups of eight, and a
    polynomial over these. The two lanes are independent."""
    if len(raw) < size:
        return np.zeros(0, np.uint64)
    if size < 8:
        return grams(BYTE_VALUES[raw], size, 1 + lane)
    spread = mixed((eights(raw) ^ _LANES[lane]) * _LANES[lane])
    out = np.empty(len(raw) - size + 1, np.uint64)
    for r in range(min(8, len(out))):
        own = out[r::8]
        own[:] = grams(spread[r::8], size // 8, 1 + lane)[:len(own)]
    if size % 8:
        out = mixed(out ^ (spread[size - 8:][:len(out)] * _LANES[1 - lane]))
    return out


class Words(Joined):
    """The words of the texts: where each starts, its text's index, and two 64-bit hashes."""

    def __init__(self, texts: list[bytes]):
        super().__init__(texts)
        space = SPACES[self.bytes]
        before = np.concatenate([[True], space[:-1]]) if len(space) else space
        starts, ends = np.flatnonzero(~space & before), np.flatnonzero(space & ~before)
        self.hashes, self.others = word_hashes(self.bytes, starts, ends)
        self.doc = np.searchsorted(self.offsets, starts, "right") - 1
        self.counts = np.bincount(self.doc, minlength=len(texts))

    def starts(self, size: int) -> np.ndarray:
        """The windows of ``size`` words of one text, by the number of their first word."""
        n = max(0, len(self.doc) - size + 1)
        return np.flatnonzero(self.doc[:n] == self.doc[size - 1:][:n])

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows of ``size`` words of one text."""
        at = self.starts(size)
        return at, grams(self.hashes, size, 1)[at]

    def second(self, size: int, at: np.ndarray) -> np.ndarray:
        """Another hash of the windows that start at ``at``, of other word hashes and another base."""
        return grams(self.others, size, 2)[at]

    def anchors(self, size: int, part: int) -> tuple[np.ndarray, np.ndarray]:
        """The least hash of the ``part``-word strings of each window of ``starts(size)``
        (equal windows have equal ones), and each such string once: its hashes."""
        g = grams(self.hashes, part, 3) | np.uint64(1)  # never 0
        at = self.starts(size)
        if not len(at):
            return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        width = size - part + 1
        least = sliding_min(g, width)
        mine = np.zeros(len(least), np.uint64)
        mine[at] = least[at]  # of windows within a text; 0 elsewhere
        reach = ~sliding_min(~np.concatenate([np.zeros(width - 1, np.uint64), mine, np.zeros(width - 1, np.uint64)]), width)
        return least[at], g[(reach == g) & (reach != 0)]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, by doubling."""
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have:]) if have < width else x


def covered(n: int, starts: np.ndarray, size: int) -> np.ndarray:
    """Which of n places lie in one of the runs of ``size`` places from ``starts``."""
    step = np.zeros(n + 1, np.int32)
    np.add.at(step, starts, 1)
    np.add.at(step, np.minimum(starts + size, n), -1)
    return np.cumsum(step[:-1]) > 0
