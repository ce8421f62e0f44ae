"""Operator 13: fill-in-middle transformation by SWAR words.

Texts are laid end to end as UTF-8, each padded to whole 64-bit words. The bytes
that end a unit are marked arithmetically, eight at a time (no carry crosses a
byte, so the marks are exact), ``bitwise_count`` counts them by word, and the
running counts of all words find the word of any unit by binary search; the
place inside the word is selected by clearing lower marks. Code points are
counted the same way. A text is thus cut without a list of its units.

Units are lines (``[^\\n]*\\n|[^\\n]+``) or code points. Cut points, order and
whether a text stays plain come from SHA-256 of ``seed:doc_id``, so a row gets
the same result in every run and partition.

Edge cases: a null text counts as empty; empty texts and texts that contain a
mark stay plain; a null doc_id hashes as empty (``7:``); repeated rows give
repeated results; an empty table gives no rows; other columns are ignored. A
text of any length is cut whole: one longer than a batch (1 MB) goes alone, and
a task then holds a few times its bytes. No shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow, ship, slices

MARKS = ("<P>", "<S>", "<M>")

_ONES = np.uint64(0x0101010101010101)
_LOW7, _HIGH = np.uint64(0x7F) * _ONES, np.uint64(0x80) * _ONES


def equal_bytes(words: np.ndarray, byte: int) -> np.ndarray:
    """0x80 in every byte of ``words`` that equals ``byte``, 0 elsewhere."""
    x = words ^ (np.uint64(byte) * _ONES)
    return ~(((x & _LOW7) + _LOW7) | x | _LOW7)


def point_starts(words: np.ndarray) -> np.ndarray:
    """0x80 in every byte that begins a code point (that isn't 10xxxxxx)."""
    return (~words | (words << np.uint64(1))) & _HIGH


def select_in_word(flags: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The byte (0 to 7) of the rank-th flag (from 1) of each word."""
    for lower in range(1, 8):
        flags = np.where(rank > lower, flags & (flags - np.uint64(1)), flags)
    lowest = flags & (~flags + np.uint64(1))
    return np.bitwise_count(lowest - np.uint64(1)).astype(np.int64) >> 3


class Marked:
    """Flags of a word array with running counts: rank and select over all of it."""

    def __init__(self, flags: np.ndarray):
        self.flags = flags
        self.before = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(np.bitwise_count(flags), out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Flags in the bytes before ``at``."""
        word, part = at >> 3, (at & 7).astype(np.uint64)
        inside = np.append(self.flags, np.uint64(0))[word] & ((np.uint64(1) << (part * np.uint64(8))) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inside)

    def select(self, rank: np.ndarray) -> np.ndarray:
        """The byte of the rank-th flag (from 1)."""
        word = np.searchsorted(self.before, rank, "left") - 1
        return word * 8 + select_in_word(self.flags[word], rank - self.before[word])


class Units:
    """Texts in padded words, with their units counted."""

    def __init__(self, texts: Sequence[bytes], unit: str = "line"):
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.cumsum((self.lengths + 7) // 8 * 8)
        self.starts = np.concatenate([[0], self.starts[:-1]]).astype(np.int64)
        words = np.frombuffer(b"".join(x for t in texts for x in (t, bytes(-len(t) % 8))), "<u8")
        self.by_line = unit == "line"
        self.points = Marked(point_starts(words))
        self.ends = Marked(equal_bytes(words, 0x0A)) if self.by_line else self.points
        self.first = self.ends.rank(self.starts)
        found = self.ends.rank(self.starts + self.lengths) - self.first
        self.open = np.fromiter((bool(t) and t[-1] != 0x0A for t in texts), bool, len(texts)) if self.by_line else np.zeros(len(texts), bool)
        self.counts = found + self.open

    def cut(self, k: np.ndarray) -> np.ndarray:
        """The bytes of each text's first k units (k from 0 to its count)."""
        if self.by_line:
            out = np.where(k == 0, 0, self.lengths)
            inner = (k > 0) & ~((k == self.counts) & self.open)
            out[inner] = self.ends.select((self.first + k)[inner]) + 1 - self.starts[inner]
        else:  # the next code point begins where k of them end
            out = self.lengths.copy()
            inner = k < self.counts
            out[inner] = self.ends.select((self.first + k + 1)[inner]) - self.starts[inner]
        return out

    def code_points(self, at: np.ndarray) -> np.ndarray:
        """Code points in the first ``at`` bytes of each text."""
        return self.points.rank(self.starts + at) - self.points.rank(self.starts)


def rearrange(texts: Sequence[bytes], h: np.ndarray, rate: int, spm_rate: int, marks: Sequence[bytes], unit: str):
    """Number of units, form, code points of prefix and middle, and output of each text; h: four columns of hashes."""
    own = Units(texts, unit)
    one, two = (h[:, i] % (own.counts + 1) for i in (0, 1))
    a, b = own.cut(np.minimum(one, two)), own.cut(np.maximum(one, two))
    prefix = own.code_points(a)
    middle = own.code_points(b) - prefix
    p, s, m = marks
    forms, outputs = [], []
    for i, t in enumerate(texts):
        if not t or h[i, 2] % 100 >= rate or p in t or s in t or m in t:
            forms.append("plain")
            outputs.append(t)
        elif h[i, 3] % 100 < spm_rate:
            forms.append("spm")
            outputs.append(b"".join((s, t[b[i]:], p, t[:a[i]], m, t[a[i]:b[i]])))
        else:
            forms.append("psm")
            outputs.append(b"".join((p, t[:a[i]], s, t[b[i]:], m, t[a[i]:b[i]])))
    return own.counts, forms, prefix, middle, outputs


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50, marks: Sequence[str] = MARKS,
              unit: str = "line", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n (units), form, prefix_chars, middle_chars, output.

    ``rate`` per cent of the texts are rearranged, ``spm_rate`` per cent of these
    suffix first; ``unit`` is ``line`` or ``char``. ``restore`` gives the text back.
    """
    if unit not in ("line", "char"):
        raise ValueError(f"unknown unit {unit!r}")
    if len({*marks}) != 3 or any(not re.fullmatch(r"<[^<>]+>", x) for x in marks):
        raise ValueError("three different marks of the form <...> are needed: parts of them cannot join with a text to another mark")
    ship(docs.sparkSession)
    digest = F.sha2(F.concat(F.lit(f"{int(seed)}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    df = narrow(docs, doc_id=id_col, text=text_col).withColumn("digest", F.substring(digest, 1, 32))
    packed = [x.encode() for x in marks]

    def emit(batches):
        for batch, texts in slices(batches):
            hexes = "".join(batch.column("digest").to_pylist())
            h = np.frombuffer(bytes.fromhex(hexes), ">u4").reshape(-1, 4).astype(np.int64)
            n, forms, prefix, middle, outputs = rearrange(texts, h, rate, spm_rate, packed, unit)
            plain = np.fromiter((x == "plain" for x in forms), bool, len(forms))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(forms), pa.array(prefix, pa.int64(), mask=plain),
                 pa.array(middle, pa.int64(), mask=plain), pa.array(outputs, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(emit, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(made: DataFrame, marks: Sequence[str] = MARKS, output_col: str = "output", form_col: str = "form", name: str = "restored") -> DataFrame:
    """``made`` with the exact text rebuilt from output and form as column ``name``.
    A rearranged text holds no mark of its own, so its output splits into four parts."""
    output, form = F.col(f"`{output_col}`"), F.col(f"`{form_col}`")
    parts = F.split(output, "|".join(map(re.escape, marks)), -1)
    order = F.when(form == "spm", F.array(parts[2], parts[3], parts[1])).otherwise(F.array(parts[1], parts[3], parts[2]))
    return made.withColumn(name, F.when(form == "plain", output).otherwise(F.array_join(order, "")))
