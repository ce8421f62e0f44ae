"""Operator 5: byte-level BPE encoding and decoding.

*Encoding.* A text is cut at the vocabulary's special tokens, each part into
words by the vocabulary's pattern, and each word into byte symbols on a doubly
linked list. A priority queue holds the possible merges by (rank, place). The
least is taken off; if its two symbols have changed since, the entry is stale
and skipped; else they are joined and the merges with both new neighbours are
queued. A word of n bytes so takes O(n log n) steps, however long it is. The
ids of words are kept in a bounded cache of each worker.

*Decoding.* The vocabulary strings' bytes are concatenated and read as UTF-8.

Edge cases: a null text counts as empty (no ids, empty decoded text); doc_id
may be null or repeated, rows are independent; other columns are ignored.
"""

from __future__ import annotations

import array
import functools
import hashlib
import heapq
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import narrow, ship
from .tokens import BYTE_CHARS, Cache

#: Fixed value: the pattern that cuts a part into words, that of the byte-level pre-tokenizer.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteBPE:
    """Encoder and decoder of one byte-level BPE vocabulary file (tokenizers' JSON)."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.byte_ids = [vocab[BYTE_CHARS[b]] for b in range(256)]
        self.merges = {(vocab[a], vocab[b]): (rank, vocab[a + b]) for rank, (a, b) in enumerate(pairs)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = special
        self.parts = regex.compile("|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True))) if special else None
        self.words = regex.compile(WORDS)
        byte_of = {c: b for b, c in BYTE_CHARS.items()}
        self.strings = {i: bytes(byte_of[c] for c in s) for s, i in vocab.items() if all(c in byte_of for c in s)}
        self.strings |= {i: s.encode() for s, i in special.items()}
        self.cache = Cache(self.word)

    def word(self, word: str) -> bytes:
        """Ids of one word, as packed unsigned 32-bit integers."""
        ids = [self.byte_ids[b] for b in word.encode()]
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        merges, queue = self.merges, []
        for i in range(n - 1):
            if m := merges.get((ids[i], ids[i + 1])):
                queue.append((m[0], i, ids[i], ids[i + 1], m[1]))
        heapq.heapify(queue)
        while queue:
            _, i, a, b, joined = heapq.heappop(queue)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue  # stale: one of the two was merged into something else
            ids[i], ids[j] = joined, -1
            k = after[i] = after[j]
            after[j] = -1
            if k >= 0:
                before[k] = i
                if m := merges.get((joined, ids[k])):
                    heapq.heappush(queue, (m[0], i, joined, ids[k], m[1]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], joined))):
                heapq.heappush(queue, (m[0], h, ids[h], joined, m[1]))
        return array.array("I", [x for x in ids if x >= 0]).tobytes()

    def _part(self, text: str) -> bytes:
        return b"".join(map(self.cache.__getitem__, self.words.findall(text)))

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers."""
        if not self.parts or not (marks := list(self.parts.finditer(text))):
            return self._part(text)
        out, at = [], 0
        for m in marks:
            out += [self._part(text[at:m.start()]), self.special[m[0]].to_bytes(4, "little")]
            at = m.end()
        return b"".join([*out, self._part(text[at:])])

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


@functools.cache
def vocabulary(path: str) -> ByteBPE:
    return ByteBPE(path)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens and ids (packed little-endian unsigned 32-bit integers)."""
    ship(docs.sparkSession)
    df = narrow(docs, doc_id=id_col, text=text_col)

    def emit(batches):
        bpe = vocabulary(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                ids = [bpe.encode(t.as_py() or "") for t in batch.column("text")[a:a + 500]]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id")[a:a + 500], pa.array([len(x) // 4 for x in ids]), pa.array(ids, pa.binary())],
                                                 ["doc_id", "n_tokens", "ids"])

    return df.mapInArrow(emit, f"doc_id {df.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids binary")


def decode(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded (text), decoded_sha256."""
    ship(encoded.sparkSession)
    df = narrow(encoded, doc_id=id_col, ids=ids_col)

    def emit(batches):
        bpe = vocabulary(path)
        for batch in batches:
            for a in range(0, batch.num_rows, 500):
                ids = [x.as_py() or b"" for x in batch.column("ids")[a:a + 500]]
                texts = [bpe.decode(x) for x in ids]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id")[a:a + 500], pa.array([len(x) // 4 for x in ids]), pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                     pa.array(texts), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts])],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded", "decoded_sha256"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.mapInArrow(emit, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded string, decoded_sha256 string")
