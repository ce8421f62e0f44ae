"""Operator 11: language identification by string kernels.

The kernel of two texts counts the byte n-grams (``blend``: n = 2, 3 and 4, of
the lower-cased UTF-8) that are present in both, however often, divided by the
geometric mean of each text's own count. Nyström: ``landmarks`` learnt texts,
dealt evenly to the languages, stand for all; only their n-grams can match, so
they are the vocabulary, and a text's own count is that of its vocabulary
n-grams. With eigenvectors of the landmarks' kernel as features, one ridge
regression for each language (one versus the rest, targets 1 and -1) is fitted.

Scoring is a matrix product for each block of texts: presence rows (texts x
vocabulary) times the vocabulary's weights (vocabulary x languages). The weights
are landmark presence x landmark coefficients, multiplied once after fitting,
as (P G) W = P (G W); the kernel of every text with every landmark is never
stored. Codes of n-grams are found in two hash tables without collisions.

Learnt from: rows whose crc32(doc_id) leaves 0 or 2 modulo 3, whose lang is not
null and whose text has 1 to ``max_train_chars`` characters; of the
``max_languages`` most frequent languages about ``max_train_rows`` rows in all,
evenly by language, those of least hash of doc_id. The driver holds these rows
and a vocabulary of at most ``landmarks * max_train_chars * 4`` bytes' n-grams;
all other texts, of any length, are only scored, whole: a long text is read in
pieces of 1 MB that mark the same presence row.

Edge cases: a null text, or one without a letter (Unicode class L), is ``und``
with score 0; a text with letters but without any known n-gram gets the most
frequent learnt language; nothing to learn from (empty table, no languages)
makes every row ``und``; ties go to the least language; a null doc_id is scored
but not learnt from; n-grams with a NUL byte are not features; repeated rows get
equal results; other columns are ignored.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_BYTES, narrow, ship, slices
from .quality_model import held_out

LETTER = regex.compile(r"\p{L}")
#: Cells of a presence block (4 bytes each).
BLOCK_CELLS = 8_000_000
_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def ngram_codes(raw: np.ndarray, n: int) -> np.ndarray:
    """The n-gram that starts at each byte as an integer, n in its top byte."""
    code = raw[: max(0, len(raw) - n + 1)].astype(np.uint64)
    for i in range(1, n):
        code = (code << np.uint64(8)) | raw[i:len(raw) - n + 1 + i]
    return code | np.uint64(n << 56)


def lowered(text: bytes) -> tuple[bytes, bool]:
    """The text in lower case, and whether it has a letter."""
    s = text.decode("utf-8", "replace")
    return s.lower().encode("utf-8", "replace"), bool(LETTER.search(s))


def distinct_codes(text: bytes, blend: Sequence[int]) -> np.ndarray:
    raw = np.frombuffer(text, np.uint8)
    ends = np.cumsum(np.concatenate([[0], raw == 0]))
    return np.concatenate([np.unique(c[ends[n:][:len(c)] == ends[:len(c)]]) for n in blend for c in [ngram_codes(raw, n)]])


class CodeTable:
    """The place of a code in a sorted array by two probes: the codes that lose
    their cell in the first table have cells of their own in the second."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        bits = max(10, (16 * len(codes)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.cells = [np.zeros(1 << bits, np.uint64) for _ in range(2)]
        self.places = [np.zeros(1 << bits, np.int32) for _ in range(2)]
        left = np.arange(len(codes), dtype=np.int32)
        self.factors = [_SPREAD, _SPREAD]
        for t in range(2):
            factor = int(_SPREAD)
            while True:
                h = (codes[left] * np.uint64(factor)) >> self.shift
                self.cells[t][:] = 0
                self.cells[t][h] = codes[left]
                lost = self.cells[t][h] != codes[left]
                if t == 0 or not lost.any():
                    break
                factor = (factor * 0xD1342543DE82EF95 + 2) % 2**64  # stays odd
            self.factors[t] = np.uint64(factor)
            self.places[t][h[~lost]] = left[~lost]
            left = left[lost]

    def find(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``codes`` are known, and the places of those."""
        found, places = [], []
        for cells, where, factor in zip(self.cells, self.places, self.factors, strict=True):
            h = (codes * factor) >> self.shift
            own = np.flatnonzero(cells[h] == codes)
            found.append(own)
            places.append(where[h[own]])
        return np.concatenate(found), np.concatenate(places)


@dataclasses.dataclass
class Model:
    """Vocabulary, its weights by language, and the offset of each language."""
    languages: list[str]
    blend: tuple[int, ...]
    codes: np.ndarray
    weights: np.ndarray
    offset: np.ndarray

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_table"}  # each worker builds its own

    def presence(self, texts: Sequence[bytes]):
        """(first text, block of presence rows) for consecutive blocks of lower-case texts; the block is reused."""
        if not hasattr(self, "_table"):
            self._table = CodeTable(self.codes)
        height = max(1, BLOCK_CELLS // max(1, len(self.codes)))
        block = np.zeros((min(height, len(texts)), len(self.codes)), np.float32)
        for first in range(0, len(texts), height):
            own = texts[first:first + height]
            block[:] = 0
            raw = np.frombuffer(b"\0".join(own), np.uint8)
            row = np.repeat(np.arange(len(own), dtype=np.int32), [len(t) + 1 for t in own])
            for at in range(0, len(raw), BATCH_BYTES):  # pieces overlap by the longest n-gram
                piece = raw[at:at + BATCH_BYTES + max(self.blend) - 1]
                for n in self.blend:
                    where, place = self._table.find(ngram_codes(piece, n))
                    block[row[at + where], place] = 1
            yield first, block[:len(own)]

    def margins(self, texts: Sequence[bytes]) -> np.ndarray:
        """One value for each lower-case text and language, about 1 for the right one and -1 for others."""
        out = np.tile(self.offset, (len(texts), 1))
        for first, block in self.presence(texts):
            n = block.sum(1, dtype=np.float64)
            out[first:first + len(block)] += (block @ self.weights) / np.sqrt(np.maximum(n, 1))[:, None]
        return out

    def predict(self, texts: Sequence[bytes]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        names, score = ["und"] * len(texts), np.zeros(len(texts))
        if self.languages:
            low = [lowered(t) for t in texts]
            live = [i for i, (_, letters) in enumerate(low) if letters]
            f = self.margins([low[i][0] for i in live])
            for i, c in zip(live, f.argmax(1), strict=True):
                names[i] = self.languages[c]
            score[live] = np.clip((f.max(1) + 1) / 2, 0, 1)
        return names, score


def fit(texts: Sequence[bytes], labels: Sequence[str], landmarks: int = 200, blend: Sequence[int] = (2, 3, 4), ridge: float = 1e-2) -> Model:
    """Nyström features of the kernel and one ridge regression for each language.
    Landmarks are the first texts of each language, in turn."""
    kept = [(low, y) for t, y in zip(texts, labels, strict=True) for low, letters in [lowered(t)] if letters]
    languages = sorted({y for _, y in kept})
    model = Model(languages, tuple(blend), np.zeros(0, np.uint64), np.zeros((0, len(languages)), np.float32), np.zeros(len(languages)))
    if not kept:
        return model
    turn: dict[str, int] = {}
    order = []
    for i, (_, y) in enumerate(kept):
        order.append((turn.setdefault(y, 0), y, i))
        turn[y] += 1
    chosen = [i for *_, i in sorted(order)[:landmarks]]
    sets = [(i, x) for i in chosen for x in [distinct_codes(kept[i][0], blend)] if len(x)]
    chosen, own = [i for i, _ in sets], [x for _, x in sets]
    target = np.array([[1.0 if y == x else -1.0 for x in languages] for _, y in kept])
    model.offset = target.mean(0)
    if not own:
        return model
    model.codes = np.unique(np.concatenate(own))
    places = [np.searchsorted(model.codes, x) for x in own]
    flat, starts = np.concatenate(places), np.cumsum([0, *map(len, places)])[:-1]
    counts = np.array([len(x) for x in own], float)

    def kernel(rows: list[bytes]) -> np.ndarray:
        out = np.zeros((len(rows), len(own)))
        for first, block in model.presence(rows):
            n = np.sqrt(np.maximum(block.sum(1, dtype=np.float64), 1))
            for i, row in enumerate(block):
                out[first + i] = np.add.reduceat(row[flat], starts, dtype=np.float64) / n[i]
        return out / np.sqrt(counts)

    knm = kernel([t for t, _ in kept])
    kmm = knm[chosen]
    values, vectors = np.linalg.eigh((kmm + kmm.T) / 2)
    live = values > 1e-8 * values.max()
    root = vectors[:, live] / np.sqrt(values[live])
    phi = knm @ root
    w = np.linalg.solve(phi.T @ phi + ridge * len(phi) / len(languages) * np.eye(phi.shape[1]), phi.T @ (target - model.offset))
    coefficients = (root @ w) / np.sqrt(counts)[:, None]
    weights = np.zeros((len(model.codes), len(languages)))
    for ids, c in zip(places, coefficients, strict=True):
        weights[ids] += c
    model.weights = weights.astype(np.float32)
    return model


def train(docs: DataFrame, max_train_rows: int = 1500, max_languages: int = 200, max_train_chars: int = 20_000, landmarks: int = 200,
          blend: Sequence[int] = (2, 3, 4), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Model:
    """Fit on a bounded sample of the rows that are not held out: two passes over
    the table, one of them over doc_id and lang alone."""
    ship(docs.sparkSession)
    own = (narrow(docs, doc_id=id_col, text=text_col, lang=lang_col).withColumn("lang", F.col("lang").cast("string"))
           .filter("doc_id is not null and lang is not null").filter(~held_out(F.col("doc_id"))))
    counts = own.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    if not counts:
        return fit([], [])
    each = max(1, max_train_rows // len(counts))
    parts = 1 << 30
    below = F.create_map(*[F.lit(x) for r in counts for x in (r["lang"], min(parts, -(-parts * each // r["count"])))])
    # dealt to each language by its count: about ``each`` rows of every one, all of a rare one
    rows = (own.withColumn("h", F.xxhash64("doc_id")).filter(F.pmod("h", F.lit(parts)) < F.element_at(below, F.col("lang")))
            .filter(F.length("text").between(1, max_train_chars))
            .orderBy("h", "doc_id", "lang", F.xxhash64("text")).limit(max_train_rows).select("text", "lang").collect())
    return fit([r["text"].encode() for r in rows], [r["lang"] for r in rows], landmarks, blend)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score. No shuffle."""
    ship(docs.sparkSession)
    df = narrow(docs, doc_id=id_col, text=text_col).withColumn("held_out", held_out(F.col("doc_id")))

    def emit(batches):
        for batch, texts in slices(batches):
            names, score = model.predict(texts)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                                             ["doc_id", "held_out", "lang_pred", "score"])

    return df.mapInArrow(emit, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, held_out boolean, lang_pred string, score double")
