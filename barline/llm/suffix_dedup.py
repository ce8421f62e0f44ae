"""Operator 9: removal of repeated byte strings by an enhanced suffix array.

Every byte covered by a ``size``-byte string that also starts anywhere else in
the corpus is removed. Texts are UTF-8 bytes; matches never cross documents.

*Distribution.* Each ``size``-byte window is assigned an anchor: the leftmost
of its GRAM-byte strings with the smallest hash. Equal windows have equal
anchors at equal offsets, so a suffix array needs only the windows of one
anchor. Consecutive windows with one anchor form a block (at most
``2 * size - GRAM`` bytes), about one block for 75 bytes of text. A count-min
sketch of the anchors, merged over partitions, keeps the blocks whose anchor
may occur twice; only these are sent, equal blocks combined in the task before
the shuffle and after it.

*Enhanced suffix array.* The distinct blocks of an anchor meet in one task:
their suffixes of ``size`` bytes or more are sorted, common prefixes of
neighbours computed, and a stack scan yields the tree of common-prefix
intervals. An interval of ``size`` bytes or more whose occurrences are preceded
by different bytes (a block's edge counts as different) is a maximal repeat
group within the block, with all of its occurrences, not just neighbours. The
windows inside the occurrences are the repeated ones.

*Hot anchors.* An anchor that the sketch puts at ``heavy_at`` blocks or more
(a passage in a third of all texts, each time with other surroundings) is not
gathered: its windows are grouped one by one by a 128-bit hash with partial
aggregation, which leaves a row a task for each window. So a task never holds
more than ``heavy_at`` distinct blocks of one anchor.

*Result.* Both ways give back the places that are *not* repeated although the
sketch let them through. Each text, joined to its own such places, drops what
the remaining estimated windows cover.

Edge cases: a null text counts as empty; texts shorter than ``size`` are kept
whole; rows that repeat (doc_id, text) are separate places; doc_id may be null;
other columns are ignored; an empty table gives no rows. A text of any length is read
whole: one longer than a batch (1 MB) goes alone, and a task holds about 40 times its bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from .common import BYTE_VALUES, Joined, byte_windows, grams, sliding_min, slices
from .substring_dedup import text_bytes

GRAM = 50
POSITION_BITS = 28
#: Bytes of blocks put into one suffix array, unless one anchor has more.
ARRAY_BYTES = 1 << 19
BLOCK = "anchor long, block binary, n long, key long, key2 long, start long"
PLACE = "key long, key2 long, start long, run long"


def sliding_argmin(x: np.ndarray, width: int) -> np.ndarray:
    """The place of the least (leftmost, if several) of every ``width`` consecutive values."""
    place, have = np.arange(len(x)), 1
    while have < width:
        step = min(have, width - have)  # the last step overlaps
        left, right = place[:-step], place[step:]
        place = np.where(x[left] <= x[right], left, right)
        have += step
    return place


class Blocks(Joined):
    """Runs of windows with one anchor: first window, number of windows, anchor hash, text."""

    def __init__(self, texts: list[bytes], size: int):
        super().__init__(texts)
        self.size = size
        n = np.maximum(self.lengths - size + 1, 0)
        at = np.arange(n.sum()) + np.repeat(self.offsets - (np.cumsum(n) - n), n)
        if not len(at):
            self.first = self.runs = self.doc = np.zeros(0, np.int64)
            self.anchor = np.zeros(0, np.uint64)
            return
        gram = min(GRAM, size)
        g = grams(BYTE_VALUES[self.bytes], gram)
        low = np.uint64((1 << POSITION_BITS) - 1)
        if len(g) <= 1 << POSITION_BITS:  # hash and place in one word
            place = (sliding_min((g & ~low) | np.arange(len(g), dtype=np.uint64), size - gram + 1)[at] & low).astype(np.int64)
        else:  # the same choice, with places of their own
            place = sliding_argmin(g & ~low, size - gram + 1)[at]
        cut = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        self.first, self.anchor = at[cut], g[place[cut]]
        self.runs = np.diff(np.concatenate([cut, [len(at)]]))
        self.doc = np.searchsorted(self.offsets, self.first, "right") - 1


def repeats(blocks: list[bytes], size: int) -> tuple[list[tuple[int, list[tuple[int, int]]]], np.ndarray]:
    """Maximal repeat groups of the suffixes of ``blocks``: (length, occurrences
    as (block, offset)), and for each suffix (block by block) the length of the
    longest group that it belongs to, 0 if none."""
    counts = [max(0, len(b) - size + 1) for b in blocks]
    own = np.repeat(np.arange(len(blocks)), counts)
    offset = np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
    suffixes = [b[i:] for b, n in zip(blocks, counts, strict=True) for i in range(n)]
    order = np.array(sorted(range(len(suffixes)), key=suffixes.__getitem__), dtype=np.int64)
    groups: list[tuple[int, list[tuple[int, int]]]] = []
    longest = np.zeros(len(order), np.int64)
    if len(order) < 2:
        return groups, longest
    # common prefixes of neighbours, from a window of the longest suffix over the padded blocks
    width = max(map(len, blocks))
    base = np.cumsum([0] + [len(b) for b in blocks])
    padded = np.concatenate([np.frombuffer(b"".join(blocks), np.uint8), np.zeros(width, np.uint8)])
    at = (base[own] + offset)[order]
    left = np.array([len(s) for s in suffixes], dtype=np.int64)[order]
    common = np.empty(len(order) - 1, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(padded, width)
    for a in range(0, len(common), 20_000):
        z = min(a + 20_000, len(common))
        differ = view[at[a:z]] != view[at[a + 1:z + 1]]
        common[a:z] = np.where(differ.any(1), differ.argmax(1), width)
    common = np.minimum(common, np.minimum(left[:-1], left[1:]))
    before = np.where(offset[order] > 0, padded[np.maximum(at - 1, 0)].astype(np.int64), -1)

    def merge(x: int, y: int) -> int:
        return x if x == y else -1

    reach = np.zeros(len(order), np.int64)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], common >= size, [False]]).astype(np.int8)))
    for a, z in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):  # suffixes a to z share a prefix of size bytes
        stack: list[list[int]] = []  # length, first suffix, byte before all of them or -1 if they differ
        chars = before[a:z + 1].tolist()
        for i, c in enumerate([*common[a:z].tolist(), 0], a):
            first, char = i, chars[i - a]
            while stack and stack[-1][0] > c:
                length, lb, ch = stack.pop()
                ch = merge(ch, char)
                if ch < 0:
                    groups.append((length, [(int(own[k]), int(offset[k])) for k in order[lb:i + 1]]))
                    np.maximum(reach[lb:i + 1], length, out=reach[lb:i + 1])
                first, char = lb, ch
            if c:
                if stack and stack[-1][0] == c:
                    stack[-1][2] = merge(stack[-1][2], char)
                else:
                    stack.append([c, first, char])
    longest[order] = reach
    return groups, longest


def _blocks(df: DataFrame, wide, size: int) -> DataFrame:
    """Blocks that the sketch lets through, equal ones of a task combined."""

    def flush(held):
        names = ["anchor", "block", "n", "key", "key2", "start"]
        cols = [*zip(*held), *zip(*held.values())]
        kinds = [pa.int64(), pa.binary(), *[pa.int64()] * 4]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

    def emit(batches):
        held: dict[tuple[int, bytes], list[int]] = {}
        for batch, texts in slices(batches):
            b = Blocks(texts, size)
            hit = np.flatnonzero(wide.value.repeated(b.anchor) & ~wide.value.heavy(b.anchor))
            key, key2 = (batch.column(x).to_pylist() for x in ("key", "key2"))
            ends = (b.first + b.runs + size - 1)[hit].tolist()
            raw = b.bytes.tobytes()
            for a, z, g, d in zip(b.first[hit].tolist(), ends, b.anchor[hit].view(np.int64).tolist(), b.doc[hit].tolist(), strict=True):
                if (own := held.get(k := (g, raw[a:z]))) is None:
                    held[k] = [1, key[d], key2[d], a - int(b.offsets[d])]
                else:
                    own[0] += 1
            if len(held) >= 20_000:
                yield flush(held)
                held = {}
        if held:
            yield flush(held)

    # dealt by anchor once: the blocks of an anchor are combined and sorted where they are
    return (df.mapInArrow(emit, BLOCK).repartition("anchor").groupBy("anchor", "block")
            .agg(F.sum("n").alias("n"), F.max("key").alias("key"), F.max("key2").alias("key2"), F.max("start").alias("start"))
            .sortWithinPartitions("anchor"))


def anchor_groups(batches):
    """Lists of (anchor, block, n, key, key2, start) with all blocks of every
    anchor in one list, of about ARRAY_BYTES. An anchor of one block has nothing
    to be compared with and comes as a list of its own kind (second value)."""
    held, group, total, now = [], [], 0, None
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[0] != now:
                if len(group) == 1:
                    yield group, True
                else:
                    held += group
                    total += sum(len(r[1]) for r in group)
                if total >= ARRAY_BYTES:
                    yield held, False
                    held, total = [], 0
                group, now = [], row[0]
            group.append(row)
    if len(group) == 1:
        yield group, True
    else:
        held += group
    if held:
        yield held, False


def _single(batches, size: int):
    """Places let through by the sketch that are not repeated: (key, key2, start, run)."""
    out: list[tuple[int, int, int, int]] = []

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["key", "key2", "start", "run"])

    for rows, alone in anchor_groups(batches):
        if alone:
            _, block, n, key, key2, start = rows[0]
            if n == 1:
                out.append((key, key2, start, len(block) - size + 1))
        else:
            _, longest = repeats([r[1] for r in rows], size)
            first = 0
            for _, block, n, key, key2, start in rows:
                windows = len(block) - size + 1
                if n == 1:
                    reach = longest[first:first + windows]
                    at = np.flatnonzero(reach)
                    step = np.zeros(windows + 1, np.int64)  # windows inside an occurrence
                    np.add.at(step, at, 1)
                    np.add.at(step, np.minimum(at + reach[at] - size + 1, windows), -1)
                    free = np.concatenate([[False], np.cumsum(step[:-1]) == 0, [False]])
                    edge = np.flatnonzero(free[1:] != free[:-1]).tolist()
                    out += [(key, key2, start + a, z - a) for a, z in zip(edge[::2], edge[1::2], strict=True)]
                first += windows
        if len(out) >= 20_000:
            yield batch_of(out)
            out = []
    if out:
        yield batch_of(out)


def _heavy_single(df: DataFrame, wide, size: int) -> DataFrame:
    """The same for hot anchors, window by window."""

    def emit(batches):
        for batch, texts in slices(batches):
            b = Blocks(texts, size)
            hit = np.flatnonzero(wide.value.heavy(b.anchor) & wide.value.repeated(b.anchor))
            if not len(hit):
                continue
            runs = b.runs[hit]
            at = np.arange(runs.sum()) + np.repeat(b.first[hit] - (np.cumsum(runs) - runs), runs)
            doc = np.repeat(b.doc[hit], runs)
            h1, h2 = (byte_windows(b.bytes, size, lane)[at].view(np.int64) for lane in (0, 1))
            order = np.lexsort((h2, h1))  # equal windows of the batch become one row with their number
            new = np.flatnonzero(np.concatenate([[True], (np.diff(h1[order]) != 0) | (np.diff(h2[order]) != 0)]))
            one = order[new]
            cols = [h1[one], h2[one], np.diff(np.concatenate([new, [len(order)]])),
                    *(np.asarray(batch.column(x))[doc[one]] for x in ("key", "key2")), (at - b.offsets[doc])[one]]
            yield pa.RecordBatch.from_arrays([*map(pa.array, cols)], ["h1", "h2", "n", "key", "key2", "start"])

    return (df.mapInArrow(emit, "h1 long, h2 long, n long, key long, key2 long, start long").groupBy("h1", "h2")
            .agg(F.sum("n").alias("n"), *[F.max(c).alias(c) for c in ("key", "key2", "start")])
            .filter("n = 1").select("key", "key2", "start", F.lit(1).cast("long").alias("run")))


def _prepared(docs: DataFrame, size: int, id_col: str, text_col: str, max_width_bits: int, heavy_at: int, extra: list[str] | None = None):
    own = [F.struct(*[F.col(f"`{c}`") for c in extra]).alias("extra")] if extra else []
    df = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), *own)
    df = df.withColumns({"key": F.xxhash64("doc_id", "text", F.lit(7)), "key2": F.xxhash64("text", F.lit(11), "doc_id")})
    wide = sketch.build(df.select("text"), lambda batches: (Blocks(t, size).anchor for _, t in slices(batches)),
                        text_bytes(df) // max(1, (size - GRAM) // 2), max_width_bits, heavy_at)
    return df, wide


def remove_repeats(docs: DataFrame, size: int = 200, id_col: str = "doc_id", text_col: str = "text",
                   max_width_bits: int = 28, heavy_at: int = 20_000, keep_text: bool = False,
                   extra: list[str] | None = None) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256,
    and with ``keep_text`` also kept_text, in which a character goes if any of
    its bytes goes. ``extra`` names further columns of ``docs`` to pass through."""
    extra = extra or []
    df, wide = _prepared(docs, size, id_col, text_col, max_width_bits, heavy_at, extra)
    single = _blocks(df.select("key", "key2", "text"), wide, size).mapInArrow(lambda batches: _single(batches, size), PLACE)
    if any(len(x) for x in wide.value.heavy_cells):
        single = single.unionByName(_heavy_single(df.select("key", "key2", "text"), wide, size))
    single = single.groupBy("key", "key2").agg(F.collect_list(F.struct("start", "run")).alias("single"))
    kind = df.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch, texts in slices(batches):
            b = Blocks(texts, size)
            hit = np.flatnonzero(wide.value.repeated(b.anchor))
            here = np.zeros(len(b.bytes) + 1, np.int32)  # estimated windows, then without the single ones
            np.add.at(here, b.first[hit], 1)
            np.add.at(here, b.first[hit] + b.runs[hit], -1)
            lists = batch.column("single")
            flat = lists.flatten()
            if len(flat):
                n = np.asarray(lists.value_lengths().fill_null(0))
                at = np.asarray(flat.field("start")) + np.repeat(b.offsets, n)
                np.add.at(here, at, -1)
                np.add.at(here, at + np.asarray(flat.field("run")), 1)
            starts = np.flatnonzero(np.cumsum(here[:-1]) > 0)
            step = np.zeros(len(b.bytes) + 1, np.int32)
            np.add.at(step, starts, 1)
            np.add.at(step, starts + size, -1)
            gone = np.cumsum(step[:-1]) > 0
            spans = gone & ~np.concatenate([[False], gone[:-1]]) if len(gone) else gone
            total, runs = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, spans))
            ends = b.offsets + b.lengths
            removed, n_spans = total[ends] - total[b.offsets], runs[ends] - runs[b.offsets]
            kept = [t if not r else b.bytes[o:e][~gone[o:e]].tobytes() for t, r, o, e in
                    zip(texts, removed.tolist(), b.offsets.tolist(), ends.tolist(), strict=True)]
            cols = [batch.column("doc_id"), *(pa.array(x, pa.int64()) for x in (b.lengths, removed, n_spans)),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if keep_text:
                begins = (b.bytes & 0xC0) != 0x80  # first bytes of characters
                char = np.cumsum(begins) - 1
                broken = np.zeros(len(b.bytes) + 1, bool)
                broken[char[gone]] = True
                whole = ~broken[char]
                cols.append(pa.array([t if not r else b.bytes[o:e][whole[o:e]].tobytes() for t, r, o, e in
                                      zip(texts, removed.tolist(), b.offsets.tolist(), ends.tolist(), strict=True)], pa.binary()).cast(pa.string()))
                names.append("kept_text")
            if extra:
                cols.append(batch.column("extra"))
                names.append("extra")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * keep_text
    if extra:
        schema += f", extra {df.schema['extra'].dataType.simpleString()}"
    return df.join(single, ["key", "key2"], "left").select("doc_id", "text", "single", *["extra"] * bool(extra)).mapInArrow(cut, schema)


def _places(df: DataFrame, wide, size: int) -> DataFrame:
    """Every place of the blocks that the sketch lets through: doc_id, start,
    anchor, block. Those of hot anchors are cut to their runs of repeated windows."""
    single = F.lit(None).cast("array<struct<start:bigint,run:bigint>>")
    if any(len(x) for x in wide.value.heavy_cells):
        once = (_heavy_single(df.select("key", "key2", "text"), wide, size).groupBy("key", "key2")
                .agg(F.collect_list(F.struct("start", "run")).alias("single")))
        df, single = df.join(once, ["key", "key2"], "left"), F.col("single")
    kind = df.schema["doc_id"].dataType.simpleString()

    def emit(batches):
        for batch, texts in slices(batches):
            b = Blocks(texts, size)
            hit = np.flatnonzero(wide.value.repeated(b.anchor))
            if not len(hit):
                continue
            step = np.zeros(len(b.bytes) + 1, np.int32)
            np.add.at(step, b.first[hit], 1)
            np.add.at(step, b.first[hit] + b.runs[hit], -1)
            kept = np.cumsum(step) > 0
            lists = batch.column("single")
            if len(flat := lists.flatten()):
                n = np.asarray(lists.value_lengths().fill_null(0))
                kept[np.asarray(flat.field("start")) + np.repeat(b.offsets, n)] = False
            new = np.concatenate([[True], ~kept[:-1]])
            new[b.first] = True
            starts = np.flatnonzero(kept & new)
            runs = np.flatnonzero(kept & np.concatenate([~kept[1:] | new[1:], [True]])) - starts + 1
            if not len(starts):
                continue
            block = np.searchsorted(b.first, starts, "right") - 1
            doc, raw = b.doc[block], b.bytes.tobytes()
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").take(pa.array(doc)), pa.array(starts - b.offsets[doc]), pa.array(b.anchor[block].view(np.int64)),
                pa.array([raw[a:a + n + size - 1] for a, n in zip(starts.tolist(), runs.tolist(), strict=True)], pa.binary())],
                ["doc_id", "start", "anchor", "block"])

    return df.select("doc_id", "text", single.alias("single")).mapInArrow(emit, f"doc_id {kind}, start long, anchor long, block binary")


def maximal_repeat_groups(docs: DataFrame, size: int = 200, id_col: str = "doc_id", text_col: str = "text",
                          max_width_bits: int = 28, heavy_at: int = 20_000) -> DataFrame:
    """The maximal repeat groups themselves, one row for each occurrence: doc_id,
    start (in bytes), repeat (hash of the repeated string), length, anchor, and the
    block that holds it with the offset there and the number of the block's places.
    Groups are maximal within blocks.

    Blocks of hot anchors are cut to their runs of repeated windows first, which
    changes no group: every window of an occurrence is repeated, and beside a window
    that is not, no group goes on. A passage with other surroundings each time is
    then one distinct block. A task holds the distinct cut blocks of one anchor."""
    df, wide = _prepared(docs, size, id_col, text_col, max_width_bits, heavy_at)
    places = _places(df, wide, size)

    def found(batches):
        for rows, _ in anchor_groups(batches):
            groups, _ = repeats([r[1] for r in rows], size)
            groups += [(len(r[1]), [(i, 0)]) for i, r in enumerate(rows) if r[2] > 1]
            # a block at several places may also be a group with other blocks
            out = [(rows[i][0], hashlib.sha256(rows[i][1][at:at + n]).hexdigest(), n, at, rows[i][1], rows[i][2])
                   for n, i, at in sorted({(n, *place) for n, occ in groups for place in occ})]
            if out:
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds, strict=True)],
                                                 ["anchor", "repeat", "length", "offset", "block", "places"])

    ids = [F.xxhash64("block", F.lit(x)).alias(f"id{x}") for x in (1, 2)]
    # equal blocks are combined before those of an anchor meet
    groups = (places.groupBy("anchor", "block").agg(F.count(F.lit(1)).alias("n")).repartition("anchor").sortWithinPartitions("anchor")
              .mapInArrow(found, "anchor long, repeat string, length long, offset long, block binary, places long").select("*", *ids))
    return (places.select("doc_id", "start", "anchor", *ids).join(groups, ["anchor", "id1", "id2"])
            .select("doc_id", (F.col("start") + F.col("offset")).alias("start"), "repeat", "length", "anchor", "offset", "block", "places"))
