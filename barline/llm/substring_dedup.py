"""Operator 7: exact removal of repeated word windows behind a count-min prefilter.

A window is ``size`` consecutive words (runs of bytes other than ASCII white
space) of one text. Every word covered by a window whose word sequence also
starts anywhere else in the corpus is removed.

1. Each window has an anchor, the least hash of its PART-word strings; equal
   windows have equal anchors, and there is about one anchor for 14 windows. The
   tasks' sketches of all anchors are merged (``sketch.py``). Counters
   overestimate, so no repeat is lost.
2. The windows whose anchor is estimated repeated are sketched in turn, by a
   64-bit hash of all their words.
3. Only windows estimated repeated by both are grouped exactly, by a 128-bit
   hash (two lanes of word hashes and window hashes that share nothing), with
   partial aggregation before the shuffle (a window that a third of all rows hold
   costs one row a task). A group with one member was an overestimate; its only
   place is sent back to its text.
4. The texts, joined to their overestimated windows, drop the words that the
   remaining estimated windows cover.

Edge cases: a null or empty text has no words and keeps the hash of the empty
string; rows that repeat (doc_id, text) count as separate places; doc_id may
be null; other columns are ignored; an empty table gives no rows. A text of any
length is read whole: one longer than a batch (1 MB) goes alone, and a task then
holds about 20 times its bytes.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import sketch
from .common import Words, covered, mixed, narrow, slices

_STEP = np.uint64(0xA24BAED4963EE407)
#: Words of the strings of which a window's anchor is one.
PART = 8


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a 64-bit key of both. Rows that share a key are equal
    copies: their windows occur twice, so none of them is ever an overestimate."""
    df = narrow(docs, doc_id=id_col, text=text_col)
    return df.withColumn("key", F.xxhash64("doc_id", "text", F.lit(7)))


def text_bytes(df: DataFrame) -> int:
    """Bytes of all texts, a sum on the JVM side."""
    return df.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def remove_repeats(docs: DataFrame, size: int = 35, id_col: str = "doc_id", text_col: str = "text",
                   max_width_bits: int = 29, keep_text: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 (of the
    kept words joined by one space), and with ``keep_text`` also kept_text."""
    df = keyed(docs, id_col, text_col)
    part = min(PART, size)
    n_anchors = text_bytes(df) // (3 * (size - part + 2))
    anchors = sketch.build(df.select("text"), lambda batches: (Words(t).anchors(size, part)[1] for _, t in slices(batches)), n_anchors, max_width_bits)

    def likely(words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of the windows whose anchor is estimated repeated."""
        hit = np.flatnonzero(anchors.value.repeated(words.anchors(size, part)[0]))
        if not len(hit):
            return hit, np.zeros(0, np.uint64)
        at, h = words.windows(size)
        return at[hit], h[hit]

    wide = sketch.build(df.select("text"), lambda batches: (likely(Words(t))[1] for _, t in slices(batches)), n_anchors, max_width_bits)

    def estimated(batches):
        for batch, texts in slices(batches):
            words = Words(texts)
            at, h = likely(words)
            hit = wide.value.repeated(h)
            if hit.any():
                key = np.asarray(batch.column("key"))[words.doc[at[hit]]]
                yield pa.RecordBatch.from_arrays([pa.array(h[hit].view(np.int64)), pa.array(words.second(size, at[hit]).view(np.int64)), pa.array(key)],
                                                 ["h1", "h2", "key"])

    over = (df.select("key", "text").mapInArrow(estimated, "h1 long, h2 long, key long")
            .groupBy("h1", "h2").agg(F.count("*").alias("n"), F.max("key").alias("key"))
            .filter("n = 1").groupBy("key").agg(F.collect_list(F.struct("h1", "h2")).alias("over")))
    kind = df.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        for batch, texts in slices(batches):
            words = Words(texts)
            at, h = likely(words)
            hit = wide.value.repeated(h)
            at, h = at[hit], h[hit]
            lists = batch.column("over")
            if len(at) and len(flat := lists.flatten()):
                n = np.asarray(lists.value_lengths().fill_null(0))
                lone, lone2 = (np.asarray(flat.field(i)).view(np.uint64) for i in (0, 1))
                lone = mixed(lone + np.repeat(np.arange(len(n)).astype(np.uint64), n) * _STEP)
                order = np.argsort(lone)
                own = mixed(h + words.doc[at].astype(np.uint64) * _STEP)
                near = order[np.minimum(np.searchsorted(lone, own, sorter=order), len(lone) - 1)]
                at = at[(lone[near] != own) | (lone2[near] != words.second(size, at))]
            gone = covered(len(words.doc), at, size)
            removed = np.bincount(words.doc[gone], minlength=len(texts))
            first = np.cumsum(words.counts) - words.counts
            kept = []
            for i, text in enumerate(texts):
                own_words = text.split()
                if removed[i]:
                    own_words = compress(own_words, (~gone[first[i]:first[i] + words.counts[i]]).tolist())
                kept.append(b" ".join(own_words))
            cols = [batch.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in kept])]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if keep_text:
                cols.append(pa.array([x.decode("utf-8", "replace") for x in kept]))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text
    return df.join(over, "key", "left").select("doc_id", "text", "over").mapInArrow(cut, schema)
