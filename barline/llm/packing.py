"""Operator 3: mixture-controlled packing by deficit round-robin.

Every source is a queue of its documents' tokens. In each round every source
sends its quantum, the target share of ``window`` tokens, as whole tokens; the
fraction that it could not send stays as its deficit for the next round. With
rational quanta a deficit after r rounds is known without playing the rounds:
the source has sent ``floor(d + r * q)`` tokens. So each task computes the
chunks of its own documents alone, deficits carry exactly across windows and
partitions, and no task or driver walks the corpus. The rounds laid end to end
are cut every ``window`` tokens, so a window holds one round's mixture to
within a token a source. When a source runs dry its rest is sent and the
shares of the others are raised in proportion (one phase for each such event;
with shares taken from the corpus itself all end together). The last, partial
window is split into sequences of powers of two, so nothing is padded.

Place in the queue: documents keep the order of the stored token table. A
task's running total comes with the rows; the totals of earlier partitions are
a running sum over one row for each source and partition.

Edge cases: a null text counts as empty (only the end id); a null source is a
source of its own; repeated rows are packed each; doc_id may be null; no rows
give no pieces; other columns are ignored. A text of any length is tokenised
whole, in a batch of its own beyond 1 MB, and cut into as many pieces as it has
rounds. The number of distinct sources is taken to be small (a mixture's
targets): their totals go to the driver.
"""

from __future__ import annotations

import zlib
from fractions import Fraction
from math import lcm

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored
from .common import narrow, ship, slices
from .tokens import id_width, tokenizer


#: Rows of (source, partition) totals that are broadcast; beyond it Spark joins by key.
BASES = 1_000_000


class Phase:
    """Rounds with one set of active sources. ``sent[s]`` and ``position`` say
    what lay before; ``share[s] / den`` is the quantum, ``debt[s] / den`` the deficit."""

    def __init__(self, position: int, sent: dict, debt: dict, quanta: dict):
        self.position, self.sent = position, sent
        self.den = lcm(*(x.denominator for x in [*debt.values(), *quanta.values()]))
        self.order = sorted(quanta)
        self.share = {s: int(quanta[s] * self.den) for s in quanta}
        self.debt = {s: int(debt[s] * self.den) for s in quanta}
        self.rounds = 0
        self.cache: dict[int, dict] = {}

    def out(self, s, r: int) -> int:
        """Tokens that s has sent in the first r rounds of this phase."""
        return (self.debt[s] + r * self.share[s]) // self.den

    def round_of(self, s, k: int) -> int:
        """The round in which s sends its token k (from 0, of this phase)."""
        return -((self.debt[s] - (k + 1) * self.den) // self.share[s]) - 1 if self.debt[s] < (k + 1) * self.den else 0

    def starts(self, r: int) -> dict:
        """Where each source's chunk of round r begins in the stream, and which tokens it has."""
        if r not in self.cache:
            if len(self.cache) > 5000:
                self.cache.clear()
            before = {s: self.out(s, r) for s in self.order}
            at, found = self.position + sum(before.values()), {}
            for s in self.order:
                n = self.out(s, r + 1) - before[s]
                found[s] = (before[s], n, at)
                at += n
            self.cache[r] = found
        return self.cache[r]


def schedule(totals: dict, targets: dict | None, window: int) -> list:
    """Phases, each followed by the rests of the sources that ran dry:
    [(phase, {source: (first token, tokens, position)}), ...]."""
    left = {s: n for s, n in totals.items() if n}
    sent, debt, position, plan = dict.fromkeys(left, 0), dict.fromkeys(left, Fraction(0)), 0, []
    while left:
        weight = {s: Fraction(targets.get(s, 0)) if targets else Fraction(totals[s]) for s in left}
        weight = {s: w for s, w in weight.items() if w > 0} or {s: Fraction(n) for s, n in left.items()}
        whole = sum(weight.values())
        quanta = {s: window * w / whole for s, w in weight.items()}
        phase = Phase(position, {s: sent[s] for s in quanta}, {s: debt[s] for s in quanta}, quanta)
        phase.rounds = max(0, min(int((left[s] - debt[s]) // quanta[s]) for s in quanta))
        for s in quanta:
            n = phase.out(s, phase.rounds)
            debt[s] = debt[s] + phase.rounds * quanta[s] - n
            sent[s] += n
            left[s] -= n
            position += n
        rests = {}
        for s in sorted(quanta):
            if left[s] < debt[s] + quanta[s]:  # less than another quantum: send it and leave
                rests[s] = (sent[s], left[s], position)
                sent[s] += left[s]
                position += left.pop(s)
        plan.append((phase, rests))
    return plan


def chunks(plan: list, source, start: int, stop: int):
    """(queue place, tokens, stream position) of the chunks that hold the source's tokens start to stop."""
    for phase, rests in plan:
        if source in phase.share:
            base = phase.sent[source]
            end = min(stop, base + phase.out(source, phase.rounds))
            at = max(start, base)
            r = phase.round_of(source, at - base) if at < end else 0
            while at < end:
                first, n, position = phase.starts(r)[source]
                first += base
                upto = min(end, first + n)
                if upto > at:
                    yield at, upto - at, position + at - first
                    at = upto
                r += 1
        if source in rests:
            first, n, position = rests[source]
            a, z = max(start, first), min(stop, first + n)
            if a < z:
                yield a, z - a, position + a - first


def sequences(position: int, n: int, total: int, window: int):
    """(tokens, sequence_id, offset) of the cuts of a stream run; the last window is cut into powers of two."""
    full = total // window
    while n:
        k, offset = divmod(position, window)
        size = window
        if k >= full:
            rest, base, k = total - full * window, 0, full
            size = 1 << (rest.bit_length() - 1)
            while offset >= base + size:
                base, rest, k = base + size, rest - size, k + 1
                size = 1 << (rest.bit_length() - 1)
            offset -= base
        part = min(n, size - offset)
        yield part, k, offset
        position += part
        n -= part


def tokenised(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The stored token table: ids as packed integers, and the running total of
    the source's tokens within the partition that wrote the row."""
    ship(docs.sparkSession)
    df = narrow(docs, doc_id=id_col, text=text_col, source=source_col).withColumn("source", F.col("source").cast("string"))

    def emit(batches):
        tok = tokenizer(path)
        end = end_id.to_bytes(tok.width, "little")
        part, running = TaskContext.get().partitionId(), {}
        for batch, texts in slices(batches):
            packed = [ids + end for ids in tok.encode_many(texts)]
            first, sizes = [], [len(x) // tok.width for x in packed]
            for s, n in zip(batch.column("source").to_pylist(), sizes, strict=True):
                first.append(running.get(s, 0))
                running[s] = first[-1] + n
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), pa.array(packed, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(np.full(len(packed), part)), pa.array(first, pa.int64())], ["doc_id", "source", "ids", "n", "part", "first"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return stored(df.mapInArrow(emit, f"doc_id {kind}, source string, ids binary, n long, part long, first long"), "tokens")


def pack(docs: DataFrame, path: str, window: int = 2048, end_id: int = 1, targets: dict[str, float] | None = None,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", keep_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, source, and with ``keep_ids`` the piece's ids (array<int>).

    ``targets`` maps sources to the share wanted of each window (any scale);
    without it the shares are those of the corpus. Sources without a target
    come when the others are used up.
    """
    rows = tokenised(docs, path, end_id, id_col, text_col, source_col)
    sums = rows.groupBy("source", "part").agg(F.sum("n").alias("n"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.col("source").alias("of"), F.col("part").alias("in"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = {(r[0] is not None, r[0] or ""): r[1] for r in rows.groupBy("source").agg(F.sum("n")).collect()}
    wanted = {(True, s): Fraction(w) for s, w in targets.items()} if targets else None
    plan, total = schedule(totals, wanted, window), sum(totals.values())
    kind = rows.schema["doc_id"].dataType.simpleString()

    whole_windows = total // window * window
    width = id_width(path)

    def cut(batches):
        for batch in batches:
            cols = [batch.column(x).to_pylist() for x in ("source", "n", "first", "base")]
            ids, last = batch.column("ids"), batch.num_rows - 1
            out: list[list[int]] = [[] for _ in range(6)]  # row, start, length, crc, sequence, offset
            kept: list[np.ndarray] = []
            row, at_, length, crc, sequence, offset_ = (x.append for x in out)
            for i, (source, n, first, base) in enumerate(zip(*cols, strict=True)):
                start = first + base
                whole = np.frombuffer(ids[i].as_py(), f"<u{width}").astype("<u4")
                raw = memoryview(whole).cast("B")
                for place, size, position in chunks(plan, (source is not None, source or ""), start, start + n):
                    a = place - start
                    k, offset = divmod(position, window)
                    if offset + size <= window and position < whole_windows:
                        parts = ((size, k, offset),)
                    else:
                        parts = sequences(position, size, total, window)
                    for part, k, offset in parts:
                        row(i)
                        at_(a)
                        length(part)
                        crc(zlib.crc32(raw[4 * a:4 * (a + part)]))
                        sequence(k)
                        offset_(offset)
                        if keep_ids:
                            kept.append(whole[a:a + part].astype(np.int32))
                        a += part
                if out[0] and (len(out[0]) > 20_000 or i == last):
                    index, *found = (pa.array(np.array(x, np.int64)) for x in out)
                    arrays = [batch.column("doc_id").take(index), *found[:3], batch.column("n").take(index), *found[3:], batch.column("source").take(index)]
                    yield pa.RecordBatch.from_arrays(arrays + ([pa.array(kept, pa.list_(pa.int32()))] if keep_ids else []), names)
                    for x in (*out, kept):
                        x.clear()

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"] + ["ids"] * keep_ids
    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, `offset` long, source string"
              + ", ids array<int>" * keep_ids)
    if sums.count() <= BASES:
        bases = F.broadcast(bases)  # of a checked size: the token ids then stay where they are
    placed = rows.join(bases, F.col("source").eqNullSafe(F.col("of")) & (F.col("part") == F.col("in")))
    return placed.select("doc_id", "source", "ids", "n", "first", "base").mapInArrow(cut, schema)
