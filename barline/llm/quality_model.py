"""Operator 6: quality classifier, histogram gradient-boosted trees.

Document statistics (shares of symbols, capitals, repeated words and lines, ...)
are computed from the whole text. The trees are fitted on a bounded sample of
labelled rows: those with the ``max_train_rows`` smallest hashes of doc_id, so
the sample is the same on every run and the driver holds at most
``max_train_rows`` rows of statistics. Each feature is cut into at most BINS
histogram bins; a level of a tree is grown from gradient sums by (node, bin).
The trees are flattened into arrays (feature, threshold, left child) and all
rows of a batch walk them together, one numpy step a level.

Edge cases: a null text counts as empty and gets a score like any other text;
a doc_id that is null or has no label is scored but not learnt from; repeated
labels of a doc_id count by majority (a tie is 0), null labels are left out;
without labels of both kinds the score is the share of 1 (0.5 without any); an
empty table gives no rows; other columns are ignored. A text of any length is
measured whole: a task holds one text, its words and their counts.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow, ship, slices

BINS = 64
SYMBOLS = b"#*$%&|<>!?.,;:()[]{}\"'/\\=+-_@~^`"
FEATURES = ("log_bytes", "log_words", "word_bytes", "distinct_words", "same_as_before", "top_word", "capitals", "digits", "high_bytes", "letters",
            "symbol_words", "pipes", "stars", "hashes", "money", "ampersands", "percent", "exclamations", "angles", "stops", "commas", "lines_words",
            "distinct_lines", "longest_word", "single_words", "upper_words", "controls")
_CAPITALS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_LETTERS = _CAPITALS + bytes(range(97, 123))
_HIGH, _LOW = bytes(range(128, 256)), bytes([*range(0, 9), *range(14, 32), 127])


def statistics(text: bytes) -> list[float]:
    n, words = max(1, len(text)), text.split()
    w = max(1, len(words))
    seen: dict[bytes, int] = {}
    for x in words:
        seen[x] = seen.get(x, 0) + 1
    lines = [x for x in text.split(b"\n") if x.strip()]
    share = lambda chars: (len(text) - len(text.translate(None, chars))) / n
    count = text.count
    return [np.log1p(len(text)), np.log1p(len(words)), sum(map(len, words)) / w, len(seen) / w,
            sum(a == b for a, b in zip(words, words[1:], strict=False)) / w, max(seen.values(), default=0) / w,
            share(_CAPITALS), share(_DIGITS), share(_HIGH), share(_LETTERS), share(SYMBOLS) * n / w,
            count(b"|") / w, count(b"*") / w, count(b"#") / w, count(b"$") / w, count(b"&") / w, count(b"%") / w, count(b"!") / w,
            (count(b"<") + count(b">")) / w, count(b".") / w, count(b",") / w, len(lines) / w, len(set(lines)) / max(1, len(lines)),
            max(map(len, seen), default=0), sum(c == 1 for c in seen.values()) / w, sum(c for x, c in seen.items() if x.isupper()) / w, share(_LOW)]


class Trees:
    """Flattened trees: node i of tree t sends a row to ``left[i]`` if its feature
    is at most ``cut[i]``, else to ``left[i] + 1``; a leaf sends it to itself."""

    def __init__(self, base: float):
        self.base, self.depth = base, 0
        self.roots: list[int] = []
        self.feature = np.zeros(0, np.int32)
        self.cut, self.value = np.zeros(0), np.zeros(0)
        self.left = np.zeros(0, np.int32)

    def add(self, feature, cut, left, value, depth) -> None:
        at = len(self.feature)
        self.roots.append(at)
        self.feature = np.concatenate([self.feature, feature]).astype(np.int32)
        self.cut, self.value = np.concatenate([self.cut, cut]), np.concatenate([self.value, value])
        self.left = np.concatenate([self.left, np.asarray(left) + at]).astype(np.int32)
        self.depth = max(self.depth, depth)

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root, np.int32)
            for _ in range(self.depth):
                node = self.left[node] + (x[rows, self.feature[node]] > self.cut[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, l2: float = 1.0, least: float = 2.0) -> Trees:
    """Boosted trees for the logistic loss."""
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    trees = Trees(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return trees
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    margin, k = np.full(len(y), trees.base), x.shape[1]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        feature, cut, left, value = [0], [np.inf], [0], [0.0]
        node, frontier = np.zeros(len(y), np.int64), [0]
        for level in range(depth + 1):
            place = np.full(len(feature), -1)
            place[frontier] = np.arange(len(frontier))
            live = place[node] >= 0
            own = place[node[live]]
            m = len(frontier)
            hist = np.stack([[np.bincount(own * BINS + binned[j, live], w[live], m * BINS).reshape(m, BINS) for j in range(k)] for w in (g, h)])
            total = hist[:, 0].sum(-1)  # gradient and curvature by node
            below = np.cumsum(hist, -1)
            above = total[:, None, :, None] - below
            gain = below[0] ** 2 / (below[1] + l2) + above[0] ** 2 / (above[1] + l2) - (total[0] ** 2 / (total[1] + l2))[None, :, None]
            gain[(below[1] < least) | (above[1] < least)] = -np.inf
            grown = []
            for i, f in enumerate(frontier):
                value[f] = -rate * total[0, i] / (total[1, i] + l2)
                j, b = np.unravel_index(np.argmax(gain[:, i]), gain[:, i].shape)
                if level < depth and gain[j, i, b] > 1e-6 and b < len(edges[j]):
                    feature[f], cut[f], left[f] = int(j), float(edges[j][b]), len(feature)
                    for _ in range(2):
                        grown.append(len(feature))
                        feature.append(0)
                        cut.append(np.inf)
                        left.append(len(left))
                        value.append(0.0)
                    rows = node == f
                    node[rows] = left[f] + (binned[j, rows] > b)
            frontier = grown
            if not frontier:
                break
        margin += np.asarray(value)[node]
        trees.add(feature, cut, left, value, depth)
    return trees


def held_out(doc_id):
    """Rows that are never learnt from: crc32 of doc_id as text leaves 1 modulo 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", max_train_rows: int = 20_000,
          id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Fit on the labelled rows that are not held out, at most ``max_train_rows`` of them."""
    ship(docs.sparkSession)
    chosen = (narrow(labels, doc_id=id_col, label=label_col).filter("doc_id is not null and label is not null").filter(~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg((F.avg(F.col("label").cast("double")) > 0.5).cast("int").alias("label"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train_rows))
    rows = narrow(docs, doc_id=id_col, text=text_col).join(F.broadcast(chosen), "doc_id")  # at most max_train_rows rows of two numbers

    def emit(batches):
        for batch, texts in slices(batches):
            x = pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("label"), x], ["doc_id", "label", "x"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    # repeated rows of a doc_id give one row of statistics, so the driver gets max_train_rows rows at most
    got = (rows.mapInArrow(emit, f"doc_id {kind}, label int, x array<double>").groupBy("doc_id")
           .agg(F.max("label").alias("label"), F.max("x").alias("x")).orderBy("doc_id").select("label", "x").toArrow())
    y = np.asarray(got.column("label"), np.float64)
    x = np.asarray(got.column("x").combine_chunks().flatten()).reshape(len(y), len(FEATURES)) if len(y) else np.zeros((0, len(FEATURES)))
    return fit(x, y)


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text", whole_rows: bool = False) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on), one row per input row.
    With ``whole_rows`` a struct ``row`` of all columns in place of doc_id."""
    ship(docs.sparkSession)
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if whole_rows else F.col(f"`{id_col}`")
    df = docs.select(own.alias("row"), F.col(f"`{text_col}`").alias("text"))

    def emit(batches):
        for batch, texts in slices(batches):
            s = trees.score(np.array([statistics(t) for t in texts]))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["row", "score", "predicted"])

    kind = df.schema["row"].dataType.simpleString()
    out = df.mapInArrow(emit, f"row {kind}, score double, predicted int")
    return out if whole_rows else out.withColumnRenamed("row", "doc_id")
