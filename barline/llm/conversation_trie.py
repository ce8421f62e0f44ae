"""Operator 12: prefix trie of conversations in balanced parentheses.

A conversation is its path: 20 bytes a turn, 128 bits of the SHA-256 of (role,
text) and the text's UTF-8 length. Texts themselves are never shuffled. Paths
are range-partitioned in trie order, by (path, conv_id), so equal conversations,
however many, are dealt to many tasks, and a task cuts its sorted run into
shards of bounded size. A shard's trie is a sequence of parentheses in preorder:

* range min-max blocks over the excess give ``findclose`` of every node, which
  delimits its subtree;
* rank of ``()`` pairs up to both ends counts the leaves in between;
* running sums in preorder give members and savings of subtrees, and a range
  minimum the smallest member.

Only nodes on a shard's first and last path (its spines) may go on in other
shards. All others are complete and leave at once. The spines, with what hangs
off them summed by depth, are at most two rows a shard; they are merged as the
paths were, round by round, until one shard holds them. The ids that end at a
spine node are hashed in order, as a stream of chunks.

Memory: a task holds one shard (4 MB of paths or 32,768 rows; a longer path goes
with at most seven others) and its trie, about 40 times that. Driver: Spark's
sample of the range partitioning (100 paths a partition). The last round reads
at most FINAL_BYTES, or what the round before could not make smaller.

Edge cases: rows without conv_id belong to no conversation; a null turn comes
first, turns of equal number follow their SHA-256, so equal rows are equal turns;
null role or text counts as empty; very long texts are hashed where they are read;
a conversation's turns meet in one row of 20 bytes each; an empty table gives no
rows, not even the root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stored
from .common import narrow, ship

#: Bytes of a turn in a path: 16 of its SHA-256, 4 of its text's length (big-endian).
STEP = 20
SHARD_BYTES, SHARD_ROWS, LEAST_ROWS = 4 << 20, 1 << 15, 8
FINAL_BYTES = 8 << 20
#: Ids in a chunk that is hashed later.
CHUNK = 1 << 9
BLOCK = 32
NONE = np.iinfo(np.int64).max
NOTHING = hashlib.sha256(b"").hexdigest()

PATH_SCHEMA = "path binary, conv_id long"
#: kind 0: a complete node, 1: a spine (path, weights by depth), 2: ids that end at a spine node.
SHARD_SCHEMA = ("kind int, key binary, parent_key binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                "n_leaves long, saved_tokens long, ends_sha256 string, path binary, weights binary, ids binary")
_NAMES = [x.split()[0] for x in SHARD_SCHEMA.split(", ")]
_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
_ARROW = pa.schema([(x.split()[0], _TYPES[x.split()[1]]) for x in SHARD_SCHEMA.split(", ")])
OUTPUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def step(role: Column, text: Column) -> Column:
    """The 20 bytes of a turn."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    return F.unhex(F.concat(F.substring(digest, 1, 32), F.lpad(F.hex(F.octet_length(text).cast("long")), 8, "0")))


def _turns(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    own = narrow(conversations, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col).filter("conv_id is not null")
    return own.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", step(F.col("role"), F.col("text")).alias("step"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes]]:
    """(conv_id, its steps) of rows sorted by conversation."""
    now, held = None, []
    for batch in batches:
        conv = batch.column("conv_id").to_numpy()
        if not len(conv):
            continue
        steps = b"".join(batch.column("step").to_pylist())
        cuts = [0, *(np.flatnonzero(conv[1:] != conv[:-1]) + 1).tolist(), len(conv)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if int(conv[a]) != now:
                if held:
                    yield now, b"".join(held)
                now, held = int(conv[a]), []
            held.append(steps[a * STEP:b * STEP])
    if held:
        yield now, b"".join(held)


def paths(conversations: DataFrame, family: int = 1, heads: int = 1, conv_col: str = "conv_id", turn_col: str = "turn",
          role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(path, conv_id) of every conversation.

    With ``family`` f above 1 conversations share openings: conversation c starts
    with the first h turns of conversation c - c % f (h = crc32(decimal c) %
    ``heads``; fewer if it has fewer, none if there is none), then has its own
    turns after its first h. One shuffle, by family; a task holds one path.
    """
    ship(conversations.sparkSession)
    turns = _turns(conversations, conv_col, turn_col, role_col, text_col).withColumn("base", F.expr(f"conv_id - pmod(conv_id, {int(family)})"))
    rows = turns.repartition("base").sortWithinPartitions("base", "conv_id", F.asc_nulls_first("turn"), "step").select("conv_id", "step")

    def emit(batches):
        base, opening, out = None, b"", []
        for conv, own in _runs(batches):
            if conv - conv % family != base:
                base, opening = conv - conv % family, own[:heads * STEP] if conv % family == 0 else b""
            h = STEP * (zlib.crc32(str(conv).encode()) % heads)
            out.append((opening[:h] + own[h:], conv))
            if len(out) == 1000 or len(own) > 1 << 20:
                yield _path_batch(out)
                out = []
        if out:
            yield _path_batch(out)

    return rows.mapInArrow(emit, PATH_SCHEMA)


def _path_batch(rows: list[tuple[bytes, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.binary()), pa.array([c for _, c in rows], pa.int64())], ["path", "conv_id"])


class Parentheses:
    """Balanced parentheses of a tree given by its depths in preorder, with excess and a range-minimum tree over its blocks."""

    def __init__(self, depth: np.ndarray):
        n = len(depth)
        self.opens = 2 * np.arange(n) - depth  # of the v nodes before node v all but its ancestors are closed
        bits = np.full(2 * n, -1, np.int32)
        bits[self.opens] = 1
        self.bits = bits
        size = max(1, -(-2 * n // BLOCK))
        self.width = 1 << (size - 1).bit_length()
        top = np.iinfo(np.int32).max
        self.excess = np.full(size * BLOCK, top, np.int32)
        np.cumsum(bits, out=self.excess[:2 * n])
        self.blocks = self.excess.reshape(size, BLOCK)
        self.least = np.full(2 * self.width, top, np.int32)
        self.least[self.width:self.width + size] = self.blocks.min(1)
        at = self.width
        while at > 1:
            self.least[at // 2:at] = self.least[at:2 * at].reshape(-1, 2).min(1)
            at //= 2

    def findclose(self, p: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one: the first later place of less excess than before it opened."""
        goal = self.excess[p] - 1
        out = np.full(len(p), -1, np.int64)
        left = np.arange(len(p))
        j = p + 1
        while len(left):  # inside the own block
            inside = j % BLOCK != 0
            left, j = left[inside], j[inside]
            hit = self.excess[j] <= goal[left]
            out[left[hit]] = j[hit]
            left, j = left[~hit], j[~hit] + 1
        left = np.flatnonzero(out < 0)
        if not len(left):
            return out
        node, want = p[left] // BLOCK + self.width, goal[left]
        up = np.ones(len(left), bool)
        while up.any():  # climb to the first right neighbour that reaches the goal
            here = np.flatnonzero(up)
            found = (node[here] % 2 == 0) & (self.least[np.minimum(node[here] + 1, len(self.least) - 1)] <= want[here])
            node[here] = np.where(found, node[here] + 1, node[here] // 2)
            up[here] = ~found
        while (down := np.flatnonzero(node < self.width)).size:
            first = 2 * node[down]
            node[down] = np.where(self.least[first] <= want[down], first, first + 1)
        block = node - self.width
        for a in range(0, len(left), 1 << 14):
            own = slice(a, a + (1 << 14))
            out[left[own]] = block[own] * BLOCK + (self.blocks[block[own]] <= want[own, None]).argmax(1)
        return out


def range_minimum(values: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least value of each run first..last, by runs of doubling length of which one length at a time is held."""
    level = np.frexp((last - first + 1).astype(float))[1] - 1
    out, table = np.empty(len(first), values.dtype), values
    for k in range(int(level.max(initial=0)) + 1):
        own = np.flatnonzero(level == k)
        out[own] = np.minimum(table[first[own]], table[last[own] - (1 << k) + 1])
        table = np.minimum(table[:-(1 << k)], table[1 << k:]) if len(table) > 1 << k else table[:0]
    return out


class Trie:
    """The trie of sorted distinct paths; nodes are numbered in preorder, the root 0."""

    def __init__(self, own: list[bytes]):
        self.paths = own
        self.lens = np.fromiter((len(p) // STEP for p in own), np.int64, len(own))
        flat = np.frombuffer(b"".join(own), ">u4").reshape(-1, STEP // 4)
        at = np.cumsum(self.lens) - self.lens
        shared = np.minimum(self.lens[1:], self.lens[:-1])  # steps that a path shares with the one before it
        path = np.repeat(np.arange(len(shared)), shared)
        k = np.arange(len(path)) - np.repeat(np.cumsum(shared) - shared, shared)
        differ = (flat[at[1:][path] + k] != flat[at[:-1][path] + k]).any(1)
        np.minimum.at(shared, path[differ], k[differ])
        self.shared = np.concatenate([[0], shared])
        fresh = self.lens - self.shared
        self.first = 1 + np.cumsum(fresh) - fresh
        self.path_of = np.repeat(np.arange(len(own)), fresh)
        nth = np.arange(len(self.path_of)) - np.repeat(self.first - 1, fresh)
        self.depth = np.concatenate([[0], self.shared[self.path_of] + nth + 1])
        self.tokens = np.concatenate([[0], flat[at[self.path_of] + self.depth[1:] - 1, -1].astype(np.int64)])
        self.ends = self.first + fresh - 1  # the node of each whole path (an empty first path: the root)
        n = self.n = len(self.depth)
        self.by_depth = np.sort(self.depth * n + np.arange(n))
        self.parent = np.full(n, -1, np.int64)
        self.parent[1:] = self.ancestor(np.arange(1, n), self.depth[1:] - 1)
        self.tree = Parentheses(self.depth)
        self.closes = self.tree.findclose(self.tree.opens)
        self.last = (self.closes + 1 + self.tree.excess[self.closes]) // 2 - 1  # opened up to the close, less one

    def ancestor(self, node: np.ndarray, depth: np.ndarray) -> np.ndarray:
        """The ancestor (or self) of each node at a depth: the last node of that depth so far."""
        return self.by_depth[np.searchsorted(self.by_depth, depth * self.n + node, "right") - 1] - depth * self.n

    def subtree(self, values: np.ndarray) -> np.ndarray:
        """Sum over each node's subtree."""
        c = np.concatenate([[0], np.cumsum(values)])
        return c[self.last + 1] - c[:-1]

    def pairs(self, flags: np.ndarray) -> np.ndarray:
        """Rank difference of ``()`` pairs between a node's parentheses; flags: which of the nodes count."""
        marks = np.zeros(2 * self.n + 1, np.int64)
        leaf = self.last == np.arange(self.n)
        marks[self.tree.opens[leaf & flags] + 1] = 1
        rank = np.cumsum(marks)
        return rank[self.closes + 1] - rank[self.tree.opens]

    def keys(self, nodes: np.ndarray) -> dict[int, bytes]:
        """16 bytes that name the path of each of the given nodes (SHA-256, carried on from step to step)."""
        wanted, out, stack = set(nodes.tolist()), {}, [hashlib.sha256()]
        if 0 in wanted:
            out[0] = stack[0].digest()[:16]
        if not wanted:
            return out
        needed = np.zeros(len(self.paths), np.int64)  # deepest wanted step on each path's own nodes
        inner = nodes[nodes > 0]
        np.maximum.at(needed, self.path_of[inner - 1], self.depth[inner])
        for i, p in enumerate(self.paths):
            del stack[self.shared[i] + 1:]
            until = int(max([needed[i], *([0] if i + 1 == len(self.paths) else [self.shared[i + 1]])]))
            for d in range(len(stack), until + 1):
                state = stack[-1].copy()
                state.update(p[(d - 1) * STEP:d * STEP])
                stack.append(state)
                node = int(self.first[i] + d - self.shared[i] - 1)
                if node in wanted:
                    out[node] = state.digest()[:16]
        return out


def _batch(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    made = lambda x, kind: x if isinstance(x, pa.Array) else pa.array(x, kind)
    return pa.RecordBatch.from_arrays([made(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _ARROW], schema=_ARROW)


def _solve(own: list[bytes], node_weights, ids: list[list[int]] | None, final: bool) -> Iterator[pa.RecordBatch]:
    """Complete nodes, spines and loose ids of one shard.

    ``own``: sorted distinct paths. ``node_weights(trie)`` gives members, least
    member, children, leaves and savings that are already known at each node.
    ``ids``: of the conversations that end at each path, in order (None above the first round).
    """
    trie = Trie(own)
    count, least, children, leaves, saved = node_weights(trie)
    n = trie.n
    members = trie.subtree(count)
    smallest = range_minimum(least, np.arange(n), trie.last)
    kids = children + np.bincount(trie.parent[1:], minlength=n)
    total_leaves = trie.subtree(leaves) + trie.pairs(children == 0)
    total_saved = trie.subtree(saved + (members - 1) * trie.tokens)
    spine = np.zeros(n, bool)
    right = trie.ancestor(np.full(trie.lens[-1] + 1, n - 1), np.arange(trie.lens[-1] + 1))
    if not final:
        spine[:trie.lens[0] + 1] = True
        spine[right] = True
    done = np.flatnonzero(~spine)
    inner = done[done > 0]
    loose = np.zeros(n, bool)  # complete nodes that hang off a spine
    loose[inner] = spine[trie.parent[inner]]
    keys = trie.keys(np.flatnonzero(spine) if ids is not None else np.arange(n))

    ends = [None] * n if ids is None else [NOTHING] * n
    for i, x in zip(trie.ends.tolist(), ids or [], strict=ids is not None):
        if not spine[i]:
            ends[i] = hashlib.sha256(",".join(map(str, x)).encode()).hexdigest()
    for a in range(0, len(done), 10_000):
        v = done[a:a + 10_000]
        known = (v > 0) & ~loose[v]
        yield _batch(kind=np.zeros(len(v), np.int32), key=[keys.get(x) if ids is None else None for x in v.tolist()],
                     parent_key=[keys[p] if x else None for x, p in zip(loose[v].tolist(), trie.parent[v].tolist(), strict=True)],
                     conv_id=smallest[v], depth=trie.depth[v],
                     parent_conv_id=pa.array(smallest[np.maximum(trie.parent[v], 0)], pa.int64(), mask=~known),
                     n_convs=members[v], n_children=kids[v], n_leaves=total_leaves[v], saved_tokens=total_saved[v], ends_sha256=[ends[x] for x in v.tolist()])
    if final:
        return
    off = np.flatnonzero(loose)
    to = trie.parent[off]
    for known, found in ((count, members), (saved, total_saved), (leaves, total_leaves), (children, np.ones(n, np.int64))):
        np.add.at(known, to, found[off])
    np.minimum.at(least, to, smallest[off])
    weights = np.stack([count, least, children, leaves, saved], 1)
    rows = [(own[0], weights[:trie.lens[0] + 1])]
    if len(own) > 1:
        there = weights[right].copy()
        there[right <= trie.lens[0]] = (0, NONE, 0, 0, 0)  # these stand in the first spine
        rows.append((own[-1], there))
    yield _batch(kind=np.ones(len(rows), np.int32), path=[p for p, _ in rows], weights=[np.ascontiguousarray(w, "<i8").tobytes() for _, w in rows])
    for i, x in zip(trie.ends.tolist(), ids or [], strict=ids is not None):
        if spine[i]:
            for a in range(0, len(x), CHUNK):
                yield _batch(kind=[2], key=[keys[i]], conv_id=[x[a]], ids=[",".join(map(str, x[a:a + CHUNK])).encode()])


def _conversation_shard(rows: list[tuple[bytes, int]]) -> Iterator[pa.RecordBatch]:
    own: list[bytes] = []
    ids: list[list[int]] = []
    for p, conv in rows:
        if not own or own[-1] != p:
            own.append(p)
            ids.append([])
        ids[-1].append(conv)

    def weights(trie: Trie):
        count, children, leaves, saved = (np.zeros(trie.n, np.int64) for _ in range(4))
        least = np.full(trie.n, NONE)
        count[trie.ends], least[trie.ends] = [len(x) for x in ids], [x[0] for x in ids]
        return count, least, children, leaves, saved

    yield from _solve(own, weights, ids, final=False)


def _spine_shard(rows: list[tuple[bytes, bytes]], final: bool) -> Iterator[pa.RecordBatch]:
    own: list[bytes] = []
    which = []
    for p, _ in rows:
        if not own or own[-1] != p:
            own.append(p)
        which.append(len(own) - 1)
    given = np.frombuffer(b"".join(w for _, w in rows), "<i8").reshape(-1, 5)
    sizes = np.array([len(p) // STEP + 1 for p, _ in rows])

    def weights(trie: Trie):
        depth = np.arange(len(given)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        node = trie.ancestor(np.repeat(trie.ends[which], sizes), depth)
        out = [np.zeros(trie.n, np.int64) for _ in range(5)]
        out[1][:] = NONE
        for k, x in enumerate(out):
            (np.minimum if k == 1 else np.add).at(x, node, given[:, k])
        return out

    yield from _solve(own, weights, None, final)


def _shards(batches: Iterator[pa.RecordBatch], second: str, solve, whole: bool = False) -> Iterator[pa.RecordBatch]:
    """Consecutive runs of sorted (path, second) rows, of bounded size unless ``whole``."""
    rows, size = [], 0
    for batch in batches:
        for p, x in zip(batch.column("path").to_pylist(), batch.column(second).to_pylist(), strict=True):
            rows.append((p, x))
            size += len(p)
            if not whole and (size >= SHARD_BYTES and len(rows) >= LEAST_ROWS or len(rows) >= SHARD_ROWS):
                yield from solve(rows)
                rows, size = [], 0
    if rows:
        yield from solve(rows)


def _digests(chunks: DataFrame) -> DataFrame:
    """(key, ends_sha256): the chunks of each key one after another, by first id; one chunk is held at a time."""
    def emit(batches):
        now, state = None, None
        for batch in batches:
            for key, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if key != now:
                    if now is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])
                    now, state = key, hashlib.sha256(ids)
                else:
                    state.update(b",")
                    state.update(ids)
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    own = chunks.repartition("key").sortWithinPartitions("key", "conv_id").select("key", "ids")
    return own.mapInArrow(emit, "key binary, ends_sha256 string")


def trie(given: DataFrame, final_bytes: int = FINAL_BYTES) -> DataFrame:
    """One row per node of the trie of ``paths()``: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    ship(given.sparkSession)
    ordered = given.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    shards = stored(ordered.mapInArrow(lambda b: _shards(b, "conv_id", _conversation_shard), SHARD_SCHEMA), "trie")
    spines, upper, before = shards.filter("kind = 1"), None, None
    while True:
        rows, size = spines.agg(F.count("*"), F.sum(F.octet_length("path") + F.octet_length("weights"))).first()
        if not rows:
            return shards.select(*OUTPUT)  # no conversations
        final = size <= final_bytes or before is not None and rows > 0.75 * before
        before = rows
        own = spines.select("path", "weights")
        if final:
            own = own.coalesce(1).sortWithinPartitions("path")
        else:
            own = own.repartitionByRange(-(-size // (4 * final_bytes)), "path").sortWithinPartitions("path")
        merged = stored(own.mapInArrow(lambda b, final=final: _shards(b, "weights", lambda r: _spine_shard(r, final), final), SHARD_SCHEMA), "trie")
        nodes = merged.filter("kind = 0")
        upper = nodes if upper is None else upper.union(nodes)
        if final:
            break
        spines = merged.filter("kind = 1")

    names = upper.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    digests = _digests(shards.filter("kind = 2").select("key", "conv_id", "ids"))
    above = upper.drop("ends_sha256").join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    whole = shards.filter("kind = 0")
    columns = [*OUTPUT, "parent_key"]
    known = whole.filter("parent_key is null").select(*columns).union(above.filter("parent_key is null").select(*columns)).select(*OUTPUT)
    waiting = whole.filter("parent_key is not null").select(*columns).union(above.filter("parent_key is not null").select(*columns))
    return known.union(waiting.join(names, "parent_key").withColumn("parent_conv_id", F.col("parent")).select(*OUTPUT))
