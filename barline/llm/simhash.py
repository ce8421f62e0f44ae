"""Operator 8: SimHash near-duplicates by a Gray-order hierarchical index.

*Fingerprints.* Words of the text (A-Z lower-cased), shingles of ``shingle``
words, a 64-bit XXH64 for each; a bit is set if it is set in over half.

*Dealing out.* Two fingerprints within d bits agree on one of d+1 blocks of
bits, and among the other bits on one of d+1 sub-blocks. Each distinct
fingerprint goes once to each of the (d+1)^2 pairs (block, sub-block), keyed by
its bits there: 28 bits for d = 3, so a key gathers few of any number of
unrelated fingerprints. Equal fingerprints are one row from the start.

*Index.* The fingerprints of a key are sorted by Gray rank, so neighbours
differ in few bits. Runs of FAN nodes form a parent that holds the bits all of
them share; a child keeps only the shared bits that its parent lacks. A search
goes down from the root adding differences in those bits and drops a whole
group when the sum passes d. A node whose open bits cannot lift the sum over d
is taken whole by one link, since its members are then linked to each other
too; a large cluster so costs links in proportion to its size, not pairs.

*Groups.* Links are contracted in the task to a star for each local group; the
stars of all tasks go through distributed connected components.

Edge cases: a null or empty text has fingerprint zero and is linked like any
other; fewer than ``shingle`` words are one shingle; a component with null
doc_ids only has component_id null; repeated rows are linked to each other; an
empty table gives no rows; other columns are ignored. A text of any length is
hashed whole: one longer than a batch (1 MB) goes alone.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import narrow, ship, slices
from .components import connected_components

FAN = 8
#: Rows put into one index, unless one key has more.
INDEX_ROWS = 200_000
#: Search states expanded at once.
FRONTIER = 400_000


def _fingerprints(texts: list[bytes], shingle: int, seed: int) -> np.ndarray:
    digest, hashes, counts = xxhash.xxh64_intdigest, [], []
    for text in texts:
        words = text.lower().split()
        own = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))] if words else []
        hashes += [digest(x, seed) for x in own]
        counts.append(len(own))
    n = np.array(counts)
    out = np.zeros(len(texts), ">u8")
    if hashes:
        bits = np.unpackbits(np.array(hashes, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        full = np.flatnonzero(n)
        ones = np.add.reduceat(bits, (np.cumsum(n) - n)[full], axis=0, dtype=np.int64)
        out[full] = np.packbits(2 * ones > n[full, None], axis=1).view(">u8").ravel()
    return out.astype(np.uint64).view(np.int64)


def text_keys(text) -> dict:
    """Two 64-bit hashes that stand for a text."""
    return {"key": F.xxhash64(text, F.lit(7)), "key2": F.xxhash64(F.lit(11), text)}


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text", keys: bool = False) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long, one row per input row; with ``keys`` also its text's key and key2."""
    ship(docs.sparkSession)
    df = narrow(docs, doc_id=id_col, text=text_col)
    names = ["doc_id"]
    if keys:
        df, names = df.withColumns(text_keys(F.col("text"))), ["doc_id", "key", "key2"]

    def emit(batches):
        for batch, texts in slices(batches):
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(_fingerprints(texts, shingle, seed))], [*names, "fp"])

    return df.mapInArrow(emit, ", ".join(f"{c} {df.schema[c].dataType.simpleString()}" for c in names) + ", fp long")


def block_masks(max_bits: int) -> list[int]:
    """The (max_bits + 1)^2 bit masks that keys are made with."""
    parts = max_bits + 1

    def split(bits: list[int]) -> list[list[int]]:
        cut = [len(bits) * i // parts for i in range(parts + 1)]
        return [bits[a:z] for a, z in zip(cut, cut[1:])]

    return [sum(1 << b for b in {*block, *sub}) for block in split([*range(64)])
            for sub in split([b for b in range(64) if b not in block])]


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Place of a bit pattern in the Gray order."""
    for step in (1, 2, 4, 8, 16, 32):
        fp = fp ^ (fp >> np.uint64(step))
    return fp


class GrayIndex:
    """Hierarchical index over fingerprints sorted by (group, Gray rank)."""

    def __init__(self, fps: np.ndarray, group: np.ndarray):
        self.fps = fps
        n = len(fps)
        pattern, mask, lo, hi = fps, np.full(n, ~np.uint64(0)), np.arange(n), np.arange(1, n + 1)
        self.levels = [{"pattern": pattern, "mask": mask, "lo": lo, "hi": hi, "child": None}]
        groups = 1 + int(np.count_nonzero(np.diff(group))) if n else 0
        while len(pattern) > groups:
            new = np.concatenate([[True], group[1:] != group[:-1]])
            first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
            starts = np.flatnonzero((np.arange(len(new)) - first) % FAN == 0)
            sizes = np.diff(np.concatenate([starts, [len(new)]]))
            open_bits = np.bitwise_or.reduceat((pattern ^ np.repeat(pattern[starts], sizes)) | ~mask, starts)
            below = self.levels[-1]
            below["own"] = mask & np.repeat(open_bits, sizes)  # shared bits that the parent lacks
            pattern, mask, group = pattern[starts], ~open_bits, group[starts]
            lo, hi = lo[starts], hi[starts + sizes - 1]
            self.levels.append({"pattern": pattern, "mask": mask, "lo": lo, "hi": hi, "child": (starts, sizes)})
        self.levels[-1]["own"] = mask

    def links(self, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Links (as places) that connect exactly what pairs within max_bits connect."""
        left, right = [], []
        for level in self.levels[1:]:  # members of a node with few open bits are near each other
            level["open"] = 64 - np.bitwise_count(level["mask"]).astype(np.int64)
            near = np.flatnonzero(level["open"] <= max_bits)
            n = level["hi"][near] - level["lo"][near]
            left.append(np.repeat(level["lo"][near], n))
            right.append(np.arange(n.sum()) + np.repeat(level["lo"][near] - (np.cumsum(n) - n), n))
        top, root = len(self.levels) - 1, self.levels[-1]
        q = np.arange(len(self.fps))
        node = np.searchsorted(root["hi"], q, "right")
        stack = [(top, q, node, np.zeros(len(q), np.int64))]
        while stack:
            depth, q, node, seen = stack.pop()
            if len(q) > FRONTIER:
                half = len(q) // 2
                stack += [(depth, q[:half], node[:half], seen[:half]), (depth, q[half:], node[half:], seen[half:])]
                continue
            level = self.levels[depth]
            seen = seen + np.bitwise_count((self.fps[q] ^ level["pattern"][node]) & level["own"][node])
            go = (seen <= max_bits) & (level["hi"][node] - 1 > q)  # each pair once
            q, node, seen = q[go], node[go], seen[go]
            if depth == 0:
                left.append(q)
                right.append(node)
                continue
            whole = seen + level["open"][node] <= max_bits
            left.append(q[whole])
            right.append(level["lo"][node[whole]])
            q, node, seen = q[~whole], node[~whole], seen[~whole]
            if len(q):
                starts, sizes = level["child"]
                n = sizes[node]
                kids = np.arange(n.sum()) + np.repeat(starts[node] - (np.cumsum(n) - n), n)
                stack.append((depth - 1, np.repeat(q, n), kids, np.repeat(seen, n)))
        return np.concatenate(left), np.concatenate(right)


def contract(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least place of each place's group under the links (a, b)."""
    label = np.arange(n)
    while len(a):
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], least)
        np.minimum.at(label, label[b], least)
        while not np.array_equal(deeper := label[label], label):
            label = deeper
        if np.array_equal(before, label):
            break
        differ = label[a] != label[b]
        a, b = a[differ], b[differ]
    return label


def _stars(batches, max_bits: int):
    """(src, dst) links of the groups found among complete keys, INDEX_ROWS at a time."""

    def flush(part, masked, fps):
        part, masked = np.concatenate(part), np.concatenate(masked)
        fps = np.concatenate(fps)
        key = np.cumsum(np.concatenate([[0], (part[1:] != part[:-1]) | (masked[1:] != masked[:-1])]))
        order = np.lexsort((gray_rank(fps), key))
        a, b = GrayIndex(fps[order], key[order]).links(max_bits)
        unique, place = np.unique(fps, return_inverse=True)
        place = place[order]
        label = contract(len(unique), place[a], place[b])
        own = np.flatnonzero(label != np.arange(len(label)))
        return pa.RecordBatch.from_arrays([pa.array(unique[own].view(np.int64)), pa.array(unique[label[own]].view(np.int64))], ["src", "dst"])

    held: list[list[np.ndarray]] = [[], [], []]
    for batch in batches:
        new = [np.asarray(batch.column(0)), np.asarray(batch.column(1)), np.asarray(batch.column(2)).view(np.uint64)]
        if sum(map(len, held[0])) >= INDEX_ROWS:  # cut where a key ends
            change = np.flatnonzero((new[0] != held[0][-1][-1]) | (new[1] != held[1][-1][-1]))
            if len(change):
                for h, x in zip(held, new, strict=True):
                    h.append(x[: change[0]])
                yield flush(*held)
                held = [[], [], []]
                new = [x[change[0]:] for x in new]
        for h, x in zip(held, new, strict=True):
            h.append(x)
    if sum(map(len, held[0])):
        yield flush(*held)


def _rooted(kinds: DataFrame, max_bits: int) -> DataFrame:
    """``kinds``, a row for each fingerprint, with the root of its group."""
    signed = [m - (1 << 64) if m >> 63 else m for m in block_masks(max_bits)]
    keys = F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("masked")) for i, m in enumerate(signed)]))
    dealt = kinds.select("fp", keys.alias("k")).select("k.part", "k.masked", "fp")
    links = (dealt.repartition("part", "masked").sortWithinPartitions("part", "masked")
             .mapInArrow(lambda batches: _stars(batches, max_bits), "src long, dst long"))
    groups = connected_components(links)
    return kinds.join(groups, kinds["fp"] == groups["node"], "left").select("fp", "first", F.coalesce("component", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (signed long) and component_id, the least doc_id reachable by
    links of at most ``max_bits`` differing bits. One row per input row."""
    marked = stored(fingerprints(docs, shingle, seed, id_col, text_col), "fingerprints")
    root = _rooted(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), max_bits)
    least = root.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = root.join(least, "root").select("fp", "component_id")
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def leaders(docs: DataFrame, shingle: int = 3, max_bits: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each group of near-duplicates: doc_id (the least, null only if
    all are), key and key2 of its text, and n, the number of rows with all three."""
    marked = stored(fingerprints(docs, shingle, seed, id_col, text_col, keys=True), "fingerprints")
    rows = marked.groupBy("fp", "doc_id", "key", "key2").agg(F.count("*").alias("n"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "key", "key2", "n"))
    root = _rooted(rows.groupBy("fp").agg(first.alias("first")), max_bits)
    return root.groupBy("root").agg(F.min("first").alias("first")).select("first.doc_id", "first.key", "first.key2", "first.n")
