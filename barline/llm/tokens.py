"""Token ids of whole texts by a public tokenizer file, many texts at once.

The tokenizer's pieces never span white space. Texts whose letters all lie below
U+0100 (most western text) are cut into pieces by numpy over their bytes, one a
character: runs of letters, single digits, runs of other signs, contractions. A
piece is known by two independent 64-bit hashes in a table whose entries point
into one array of ids, so a known word costs a few vectorised steps and no Python;
only a new piece goes through the BPE model. The table is emptied when full
(PIECES entries, about 100 MB), so memory stays bounded.

Other texts, and texts with added tokens or odd control characters, are encoded
chunk by chunk with a bounded cache, or by the whole tokenizer.
"""

from __future__ import annotations

import array
import functools
import gc
import json
import os
import re

import numpy as np

from .common import word_hashes

#: Chunks kept by a worker: up to twice as many before the older half is dropped.
CACHE = 400_000
#: Pieces kept by a worker before the table starts anew.
PIECES = 1 << 21
#: Control characters that Python's split() takes for white space and the tokenizer does not.
ODD_SPACE = re.compile("[\x1c-\x1f]")


def _byte_chars() -> dict[int, str]:
    """The printable stand-in of every byte in byte-level vocabularies: bytes
    that print stand for themselves, the others count up from U+0100."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


BYTE_CHARS = _byte_chars()


class Cache(dict):
    """A dict that computes what is missing and forgets the oldest entries."""

    def __init__(self, compute, most: int = CACHE):
        super().__init__()
        self.compute, self.most, self.older = compute, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class PieceTable:
    """Ids of pieces by two hashes: open addressing over arrays, looked up many at a time."""

    def __init__(self, dtype, most: int = PIECES):
        self.dtype, self.most = dtype, most
        self.clear()

    def clear(self) -> None:
        self.mask = (1 << (2 * self.most - 1).bit_length()) - 1
        self.cells = np.full(self.mask + 1, -1, np.int32)
        self.one, self.two = (np.zeros(self.most, np.uint64) for _ in range(2))
        self.first = np.zeros(self.most + 1, np.int64)  # entry i holds ids first[i] to first[i + 1]
        self.ids = np.zeros(4 * self.most, self.dtype)
        self.n = 0

    def find(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The entry of each pair of hashes, -1 for unknown ones."""
        out = np.full(len(one), -1, np.int64)
        slot = (one & np.uint64(self.mask)).astype(np.int64)
        live = np.arange(len(one))
        while len(live):
            c = self.cells[slot[live]]
            same = (c >= 0) & (self.one[c] == one[live]) & (self.two[c] == two[live])
            out[live[same]] = c[same]
            live = live[(c >= 0) & ~same]
            slot[live] = (slot[live] + 1) & self.mask
        return out

    def add(self, one: int, two: int, ids: bytes) -> None:
        i, k = self.n, one & self.mask
        while self.cells[k] >= 0:
            k = (k + 1) & self.mask
        self.cells[k], self.one[i], self.two[i] = i, one, two
        own = np.frombuffer(ids, self.dtype)
        a = self.first[i]
        if a + len(own) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(own)), self.dtype)])
        self.ids[a:a + len(own)] = own
        self.first[i + 1] = a + len(own)
        self.n += 1

    def gathered(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the entries one after another, and where each one's begin (one more than there are)."""
        size = self.first[entry + 1] - self.first[entry]
        ends = np.concatenate([[0], np.cumsum(size)])
        return self.ids[np.repeat(self.first[entry] - ends[:-1], size) + np.arange(ends[-1])], ends


SPACE, LETTER, DIGIT, OTHER = range(4)


def sign_classes() -> np.ndarray:
    """The class of each character below U+0100, as the tokenizer's pattern sees it."""
    import regex

    kind = lambda c: SPACE if c.isspace() else LETTER if regex.match(r"\p{L}", c) else DIGIT if regex.match(r"\p{N}", c) else OTHER
    return np.array([kind(chr(i)) for i in range(256)], np.uint8)


def cut_pieces(raw: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pieces of lower-case text, one byte a character:
    contractions, runs of letters, single digits, runs of other signs."""
    kind = classes[raw]
    before = np.concatenate([[SPACE], kind[:-1]]).astype(np.uint8)
    start = (kind != SPACE) & ((kind != before) | (kind == DIGIT))
    sign = np.flatnonzero((raw == 0x27) & (before != OTHER))  # an apostrophe that begins a piece
    if len(sign):
        after = np.concatenate([raw, np.zeros(3, np.uint8)])
        a, b = after[sign + 1], after[sign + 2]
        one = np.isin(a, np.frombuffer(b"stmd", np.uint8))
        two = ((a == 0x72) | (a == 0x76)) & (b == 0x65) | (a == 0x6C) & (b == 0x6C)  # re, ve, ll
        start[sign[one | two] + 1] = False  # joined to the apostrophe
        rest = np.concatenate([sign[one] + 2, sign[two] + 3])
        rest = rest[rest < len(raw)]
        start[rest[kind[rest] == LETTER]] = True
    starts = np.flatnonzero(start)
    breaks = np.append(np.flatnonzero(start | (kind == SPACE)), len(raw))
    return starts, breaks[np.searchsorted(breaks, starts, "right")]


def _top(spec: dict) -> int:
    return max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])


@functools.cache
def id_width(path: str) -> int:
    """Bytes of a packed id."""
    with open(path, encoding="utf-8") as f:
        return 2 if _top(json.load(f)) < 65536 else 4


class WordTokenizer:
    """Ids of the given tokenizer (add_special_tokens=False), as packed unsigned
    integers of ``width`` bytes. Texts are split at white space only if the file's
    normalizer and pre-tokenizer drop white space; else the whole text is encoded."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        import regex

        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        self.kind, self.width = ("H", 2) if _top(spec) < 65536 else ("I", 4)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        norms = (spec.get("normalizer") or {}).get("normalizers", [])
        self.split = [n["type"] for n in norms] == ["NFC", "Replace", "Lowercase"] and [s["type"] for s in steps] == ["Split", "ByteLevel"] \
            and steps[0]["behavior"] == "Removed" and steps[0]["invert"]
        if self.split:
            self.pattern = regex.compile(steps[0]["pattern"]["Regex"])
            self.marks = [t["content"] for t in spec["added_tokens"]]
            self.model = self.whole.model
            self.pieces = Cache(self._piece, CACHE // 4)
            self.chunks = Cache(self._chunk, CACHE // 4)
            self.table = PieceTable(np.dtype(f"<u{self.width}"))
            self.classes = sign_classes()

    def _packed(self, ids) -> bytes:
        return array.array(self.kind, ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii() or not piece.isalnum():
            piece = "".join(map(BYTE_CHARS.__getitem__, piece.encode()))
        return self._packed([t.id for t in self.model.tokenize(piece)])

    def _chunk(self, chunk: str) -> bytes:
        if chunk.isascii():
            if (low := chunk.lower()).isalpha():
                return self.pieces[low]
            plain = True
        elif plain := max(chunk) < "ɐ":
            low = "".join(map(str.lower, chunk))  # sign by sign, as the normalizer does
        if plain and not any(m in chunk for m in self.marks):
            return b"".join(map(self.pieces.__getitem__, self.pattern.findall(low)))
        return self._packed(self.whole.encode(chunk, add_special_tokens=False).ids)

    def encode_many(self, texts: list[bytes]) -> list[bytes]:
        """Ids of many UTF-8 texts; those of plain letters together."""
        out: list[bytes] = [b""] * len(texts)
        plain, rows = [], []
        for i, text in enumerate(texts):
            s = text.decode("utf-8", "replace")
            if self.split and not ODD_SPACE.search(s) and not any(m in s for m in self.marks):
                try:
                    plain.append(s.lower().encode("latin-1"))
                    rows.append(i)
                    continue
                except UnicodeEncodeError:
                    pass
            out[i] = self.encode(s)
        if rows:
            for i, ids in zip(rows, self._plain(plain), strict=True):
                out[i] = ids
        return out

    def _plain(self, texts: list[bytes]) -> list[bytes]:
        """Ids of lower-case texts of one byte a character."""
        raw = np.frombuffer(b"\n".join(texts), np.uint8)
        starts, ends = cut_pieces(raw, self.classes)
        one, two = word_hashes(raw, starts, ends)
        entry = self.table.find(one, two)
        while len(new := np.flatnonzero(entry < 0)):
            new = new[np.unique(one[new], return_index=True)[1]]
            if self.table.n + len(new) > self.table.most:  # start anew, with this batch's pieces
                self.table = PieceTable(self.table.dtype, max(PIECES, 2 * len(starts)))
                new = np.unique(one, return_index=True)[1]
            for i in new.tolist():
                self.table.add(int(one[i]), int(two[i]), self._piece(raw[starts[i]:ends[i]].tobytes().decode("latin-1")))
            entry = self.table.find(one, two)
        ids, at = self.table.gathered(entry)
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        cut = at[np.searchsorted(starts, offsets)]
        return [ids[a:z].tobytes() for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]

    def encode(self, text: str) -> bytes:
        if not self.split or ODD_SPACE.search(text):
            return self._packed(self.whole.encode(text, add_special_tokens=False).ids)
        return b"".join(map(self.chunks.__getitem__, text.split()))


@functools.cache
def tokenizer(path: str) -> WordTokenizer:
    gc.set_threshold(100_000, 50, 100)  # the caches hold no cycles; scanning them often costs more than they do
    return WordTokenizer(path)
