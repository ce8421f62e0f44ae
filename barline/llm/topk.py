"""Operator 4: exact top-k by inner product over a bit-sliced index.

*Index.* Vectors are quantised to integers and gathered in blocks of BLOCK
rows. A block holds, for each attribute, one bitmap over its rows for each bit
of the value (values are shifted by the block's least one, so none is
negative; a second, mirrored reading serves negative weights).

*Search.* A query's score is a weighted sum of attributes: every bit of a
weight adds the attribute's slices, moved up by that bit. All bitmaps of one
place value are added by carry-save adders (AND, OR, XOR of whole bitmaps),
which leaves the bit slices of the scores. From the most significant slice
downward, rows with the bit are taken while no more than k stand; rows that
are still tied at the end are the boundary, settled by the smaller id. The
scores of the chosen rows are then read back from their slices.

*Distribution.* Row blocks and groups of query blocks form a grid. Each row
block goes to every query group, each query block to every row block, and a cell
of the grid is one cogroup of bounded size: its index is built once for all the
queries of the group. A cell leaves at most k rows for each query, and the best k
of all cells are found with a window over the query. Repeated query ids are
searched once each.

Edge cases: a vector that is null or holds a null or non-finite component takes
no part; every other one does. Bit slices have no width limit; a component that
does not fit a long after quantising, or a score among the k highest that does not
fit a long, is an error, never a row left out. A shorter vector counts as padded
with zeros; rows with a null id take no part; ids that repeat are separate
candidates, but never of a query of the same id; fewer than k candidates are all
returned; an empty table gives no rows; very long vectors are handled whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import ship

#: Rows of a block, queries of a query block, most query blocks of a group, and cells wanted at least.
BLOCK, QUERIES, GROUP, CELLS = 16_384, 512, 8, 96


def quantised(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """id and q (array<bigint>) of the vectors that take part."""
    large = F.raise_error(F.lit("a quantised component does not fit a long"))

    def whole(x):
        x = x.cast("double") * scale
        return F.when(F.abs(x) >= 2.0**63, large.cast("long")).otherwise(F.floor(x))

    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    ok = F.col(vec_col).isNotNull() & F.col(id_col).isNotNull() & F.forall(F.col(vec_col), finite)
    return vectors.filter(ok).select(F.col(id_col).cast("long").alias("id"), F.transform(F.col(vec_col), whole).alias("q"))


def _blocks(df: DataFrame, size: int) -> DataFrame:
    """Rows gathered by task: (block, n, width, ids, q), values packed in as few bytes as hold them."""

    def gather(batches):
        part, k, ids, vecs = TaskContext.get().partitionId(), 0, [], []

        def done():
            dims = max((len(v) for v in vecs), default=0)
            q = np.zeros((len(vecs), dims), np.int64)
            for i, v in enumerate(vecs):
                q[i, :len(v)] = v
            top = max(int(q.max()), -int(q.min()) - 1) if q.size else 0
            width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w - 1))
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) | k]), pa.array([len(ids)]), pa.array([width]), pa.array([np.array(ids, np.int64).tobytes()], pa.binary()),
                 pa.array([q.astype(f"i{width}").tobytes()], pa.binary())], ["block", "n", "width", "ids", "q"])

        for batch in batches:
            for i, v in zip(batch.column("id").to_pylist(), batch.column("q"), strict=True):
                ids.append(i)
                vecs.append(np.asarray(v.values))
                if len(ids) == size:
                    yield done()
                    k, ids, vecs = k + 1, [], []
        if ids:
            yield done()

    # dealt out evenly, so that blocks are full whatever the files were
    return stored(df.repartition(max(1, -(-df.count() // size))).mapInArrow(gather, "block long, n long, width long, ids binary, q binary"), "blocks")


class BitSlices:
    """Bit slices of a block: ``slices[d, b]`` is the bitmap of bit b of attribute d."""

    def __init__(self, q: np.ndarray):
        self.rows, self.dims = q.shape
        self.low = int(q.min()) if q.size else 0
        self.high = int(q.max()) if q.size else 0
        self.bits = max(1, (self.high - self.low).bit_length())
        words = -(-self.rows // 64)
        bit = np.arange(self.bits, dtype=np.uint64)

        def cut(values):  # differences modulo 2^64 are right, as they lie from 0 to 2^64 - 1
            raised = (values.T[:, None, :] >> bit[None, :, None]) & np.uint64(1)
            padded = np.zeros((self.dims, self.bits, words * 64), np.uint8)
            padded[:, :, :self.rows] = raised
            return np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)

        low, high, u = (np.array(x, np.int64).view(np.uint64) for x in (self.low, self.high, q))
        self.up, self.down = cut(u - low), cut(high - u)
        self.all = np.packbits(np.arange(words * 64) < self.rows, bitorder="little").view(np.uint64)

    def scores(self, weights: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of the weighted sum (least significant first), and what to add to it."""
        piles: dict[int, list[np.ndarray]] = {}
        plus = sum(w for w in weights.tolist() if w >= 0) * self.low
        minus = sum(w for w in weights.tolist() if w < 0) * self.high
        size = np.abs(weights)
        for a in range(int(size.max()).bit_length() if size.size else 0):
            has = size >> a & 1 != 0
            for source, sign in ((self.up, weights > 0), (self.down, weights < 0)):
                pick = np.flatnonzero(has & sign)
                if len(pick):
                    for b in range(self.bits):
                        piles.setdefault(a + b, []).append(source[pick, b])
        out, place = [], 0
        while place <= max(piles, default=-1):
            pile = np.concatenate(piles[place]) if place in piles else np.zeros((0, len(self.all)), np.uint64)
            while len(pile) > 2:  # three bitmaps become a sum here and a carry one place up
                n = len(pile) // 3
                x, y, z = pile[:n], pile[n:2 * n], pile[2 * n:3 * n]
                half = x ^ y
                piles.setdefault(place + 1, []).append((x & y) | (half & z))
                pile = np.concatenate([half ^ z, pile[3 * n:]])
            if len(pile) == 2:
                piles.setdefault(place + 1, []).append(pile[:1] & pile[1:])
                out.append(pile[0] ^ pile[1])
            else:
                out.append(pile[0] if len(pile) else np.zeros_like(self.all))
            place += 1
        return out, plus + minus

    def top(self, slices: list[np.ndarray], k: int, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bitmaps of the rows surely among the k highest and of the boundary's tied rows."""
        sure, tied = np.zeros_like(among), among
        for s in reversed(slices):
            more = sure | (tied & s)
            n = int(np.bitwise_count(more).sum())
            if n > k:
                tied = tied & s
            else:
                sure, tied = more, tied & ~s
                if n == k:
                    return sure, np.zeros_like(tied)
        return sure, tied

    def rows_of(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _search(rows: pa.Table, queries: pa.Table, k: int) -> pa.Table:
    """The k best of a cell's rows for each of its queries."""
    out: list[list[np.ndarray]] = [[], [], []]
    for row in rows.to_pylist() if queries.num_rows else []:
        index = BitSlices(np.frombuffer(row["q"], f"i{row['width']}").reshape(row["n"], -1).astype(np.int64))
        own = np.frombuffer(row["ids"], np.int64)
        by_id = np.argsort(own, kind="stable")
        for block in queries.to_pylist():
            weights = np.frombuffer(block["q"], f"i{block['width']}").reshape(block["n"], -1).astype(np.int64)
            dims = min(index.dims, weights.shape[1])
            for query, w in zip(np.frombuffer(block["ids"], np.int64).tolist(), weights, strict=True):
                slices, add = index.scores(np.concatenate([w[:dims], np.zeros(index.dims - dims, np.int64)]))
                among = index.all.copy()
                a, z = (np.searchsorted(own, query, side, sorter=by_id) for side in ("left", "right"))
                for r in by_id[a:z].tolist():  # not its own
                    among[r >> 6] &= ~(np.uint64(1) << np.uint64(r & 63))
                sure, tied = index.top(slices, k, among)
                best = index.rows_of(sure)
                if len(best) < k:
                    edge = index.rows_of(tied)
                    best = np.concatenate([best, edge[np.argsort(own[edge], kind="stable")][:k - len(best)]])
                wide = len(slices) > 62 or abs(add) >= 1 << 62
                total = np.array([add] * len(best), object) if wide else np.full(len(best), add, np.int64)
                for b, s in enumerate(slices):
                    bits = ((s[best >> 6] >> (best & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
                    total = total + (bits.astype(object) * (1 << b) if wide else bits << b)
                if wide and any(not -(1 << 63) <= x < 1 << 63 for x in total):
                    raise OverflowError(f"a score of query {query} does not fit a long")
                for o, x in zip(out, (np.full(len(best), query), own[best], total.astype(np.int64)), strict=True):
                    o.append(x)
    return pa.table([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out], ["query_id", "id", "score"])


def top_k(vectors: DataFrame, k: int = 20, query_every: int = 20, scale: int = 64, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each row whose id is divisible
    by ``query_every`` its k highest scores among all rows of another id."""
    ship(vectors.sparkSession)
    rows = quantised(vectors, scale, id_col, vec_col)
    index, queries = _blocks(rows, BLOCK), _blocks(rows.filter(F.col("id") % query_every == 0), QUERIES)
    high, wide = index.count(), queries.count()
    groups = max(1, min(wide, max(-(-wide // GROUP), -(-CELLS // max(1, high)))))
    cells = max(1, high) * groups
    # the task that gathered a block deals it to a row or column of the grid; there are as many tasks as cells
    slot = lambda n: F.shiftright("block", 32) % n
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["cell", "n", "width", "ids", "q"]
    down = index.withColumn("g", numbers(groups)).withColumn("cell", slot(max(1, high)) * groups + F.col("g")).select(*columns)
    across = queries.withColumn("r", numbers(max(1, high))).withColumn("cell", F.col("r") * groups + slot(groups)).select(*columns)
    parts = min(cells, 20_000)
    found = (down.repartition(parts, "cell").groupBy("cell").cogroup(across.repartition(parts, "cell").groupBy("cell"))
             .applyInArrow(lambda a, b: _search(a, b, k), "query_id long, id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias("vec_id"), "score"))
