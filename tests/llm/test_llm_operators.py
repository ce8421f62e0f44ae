"""Each operator against brute force on small fixtures with nulls, ties, repeats and odd texts."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barline.llm import (bpe, components, license_scan, packing, quality_model, quality_rules, simhash, substring_dedup,
                         suffix_dedup, topk, url_filter)
from barline.llm.common import grams as suffix_dedup_grams
from barline.llm.queries import tokenizer_path
from barline.llm.tokens import Cache, PieceTable, WordTokenizer

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, hashes string, n_words long, extra string"


def corpus():
    """Texts with shared passages, near and exact copies, nulls, blanks, runs of one byte and a long text."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["é", "Straße", "日本", "x" * 300]
    say = lambda n: " ".join(rnd.choice(words) for _ in range(n))
    passage, texts = say(70), []
    for i in range(40):
        texts.append(f"{say(rnd.randint(0, 60))} {passage if i % 3 == 0 else say(20)}\n{say(30)}")
    texts += [texts[0], texts[0], texts[1] + " tail", texts[1].replace("w1", "w2", 1), None, None, "", " \n\t", "a", "A b", "ab" * 400, "ab" * 300, "z" * 900,
              (passage + "\n") * 3, say(9000), "\x1c odd \x85 space   ", "*** " * 30, "<|endoftext|> Hello's  'LL 12३"]
    rows = [(i, t, "en", f"s{min(i % 7, 3)}" if i % 11 else None, 1, 2, "h", 3, "e") for i, t in enumerate(texts)]
    return rows + [(None, texts[2], None, None, None, None, None, None, None), (5, texts[5], "en", "s0", 1, 1, "h", 1, "e")]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def bag(records):
    return Counter(tuple(r) for r in records)


def removed_words(texts, size):
    found, every = Counter(), [WORD.findall((t or "").encode()) for t in texts]
    for w in every:
        found.update(tuple(w[i:i + size]) for i in range(len(w) - size + 1))
    out = []
    for w in every:
        gone = {j for i in range(len(w) - size + 1) if found[tuple(w[i:i + size])] > 1 for j in range(i, i + size)}
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("bits", [16, 24])
def test_substring_dedup(docs, rows, bits):
    got = substring_dedup.remove_repeats(docs, size=12, max_width_bits=bits).collect()
    want = [(r[0], *x) for r, x in zip(rows, removed_words([r[1] for r in rows], 12), strict=True)]
    assert bag(got) == Counter(want)


def thue_morse(n):
    return "".join("ab"[i.bit_count() & 1] for i in range(n))


def test_words_that_polynomials_confuse(spark):
    """Thue-Morse words and their complements have equal hashes in any polynomial modulo 2^64."""
    rnd = random.Random(6)
    swap = str.maketrans("ab", "ba")
    texts, around = [], [" ".join(f"v{rnd.randrange(10**9)}" for _ in range(60)) for _ in range(40)]
    for i, n in enumerate((8, 32, 64, 65, 512, 1024, 2048, 4096)):
        a = thue_morse(n)
        texts += [f"{around[i][:200]} {a} {around[i][200:400]}", f"{around[i][:200]} {a.translate(swap)} {around[i][200:400]}"]
    texts += ["x " * 20 + " ".join(thue_morse(64)) + " y" * 20, "x " * 20 + " ".join(thue_morse(64).translate(swap)) + " y" * 20, "q" * 3_000_000 + " end", ("w " * 30 + "\n") * 40_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    for size in (9, 35):
        got = substring_dedup.remove_repeats(df, size=size).collect()
        assert bag(got) == Counter((i, *x) for i, x in enumerate(removed_words(texts[:-1], size))) + Counter(
            [(len(texts) - 1, 1_200_000, 1_200_000, hashlib.sha256(b"").hexdigest())]), size


def removed_bytes(texts, size):
    every, found = [(t or "").encode() for t in texts], Counter()
    for b in every:
        found.update(b[i:i + size] for i in range(len(b) - size + 1))
    out = []
    for b in every:
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            if found[b[i:i + size]] > 1:
                gone[i:i + size] = b"\1" * size
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


@pytest.mark.parametrize("heavy,size", [(2, 60), (2000, 60), (2000, 200)])
def test_suffix_dedup(docs, rows, heavy, size):
    got = suffix_dedup.remove_repeats(docs, size=size, heavy_at=heavy, keep_text=True, extra=["key", "extra"]).collect()
    want = [(r[0], *x) for r, x in zip(rows, removed_bytes([r[1] for r in rows], size), strict=True)]
    assert bag((*r[:5],) for r in got) == Counter(want)
    assert bag((r["extra"]["key"],) for r in got) == bag((r[5],) for r in rows)
    assert all(len(r["kept_text"].encode()) <= r["n_bytes"] - r["n_removed"] for r in got)


def test_anchors_beyond_packed_places(spark, docs, rows, monkeypatch):
    """Texts whose places do not fit beside the hash get the same anchors."""
    raw = [(r[1] or "").encode() for r in rows]
    packed = suffix_dedup.Blocks(raw, 60)
    monkeypatch.setattr(suffix_dedup, "sliding_min", None)
    low = suffix_dedup.POSITION_BITS
    real = suffix_dedup.sliding_argmin
    monkeypatch.setattr(suffix_dedup, "sliding_argmin", lambda x, width: real((x >> np.uint64(low)) << np.uint64(low), width))
    monkeypatch.setattr(suffix_dedup, "POSITION_BITS", 3)
    monkeypatch.setattr(suffix_dedup, "grams", lambda *a: (suffix_dedup_grams(*a) >> np.uint64(low)) << np.uint64(low))
    apart = suffix_dedup.Blocks(raw, 60)
    assert (packed.first == apart.first).all() and (packed.runs == apart.runs).all() and (packed.doc == apart.doc).all()
    assert (packed.anchor >> np.uint64(low) == apart.anchor >> np.uint64(low)).all()


def test_maximal_repeat_groups():
    blocks = [b"xxabcdefgh1", b"yyabcdefgh2", b"zzabcdezz", b"xxabcdefgh1"]
    groups, longest = suffix_dedup.repeats(blocks, 5)
    found = {(blocks[occ[0][0]][occ[0][1]:][:n], n): sorted(occ) for n, occ in groups}
    assert found[(b"abcde", 5)] == [(0, 2), (1, 2), (2, 2), (3, 2)]
    assert found[(b"abcdefgh", 8)] == [(0, 2), (1, 2), (3, 2)]
    assert found[(b"xxabcdefgh1", 11)] == [(0, 0), (3, 0)]
    assert (b"bcdefgh", 7) not in found  # always after "a": not maximal to the left
    assert longest[0] == 11


def test_repeat_group_rows(docs, rows):
    got = suffix_dedup.maximal_repeat_groups(docs, size=60).collect()
    assert got and all(r["length"] >= 60 and r["places"] >= 1 for r in got)
    texts = [(r[1] or "").encode() for r in rows]
    for r in got[:50]:
        piece = bytes(r["block"])[r["offset"]:][: r["length"]]
        assert hashlib.sha256(piece).hexdigest() == r["repeat"]
        assert sum(t.count(piece) for t in texts) > 1


def test_repeat_group_occurrences(spark):
    rnd = random.Random(9)
    say = lambda n: " ".join(f"{rnd.randrange(10**6)}" for _ in range(n))
    hot, pair = say(40), say(30)
    texts = [f"{say(20)} {hot} {say(20)}" for _ in range(30)] + [f"{say(5)} {pair} {hot[30:]} {pair}", f"{hot[:90]} {pair}é", f"é{hot}", f"é{hot}", "z" * 150, None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    raw = [(t or "").encode() for t in texts]
    windows = Counter(b[i:i + 60] for b in raw for i in range(len(b) - 59))
    seen = []
    for heavy in (2, 20_000):
        got = suffix_dedup.maximal_repeat_groups(df, size=60, heavy_at=heavy).collect()
        at = defaultdict(set)
        for r in got:
            at[raw[r["doc_id"]][r["start"]:r["start"] + r["length"]]].add((r["doc_id"], r["start"]))
            assert hashlib.sha256(raw[r["doc_id"]][r["start"]:r["start"] + r["length"]]).hexdigest() == r["repeat"]
        assert len(got) == sum(map(len, at.values()))  # no occurrence twice
        for piece, places in at.items():
            assert places == {(d, i) for d, b in enumerate(raw) for i in range(len(b)) if b.startswith(piece, i)} and len(places) > 1
        covered = {(d, j) for piece, places in at.items() for d, i in places for j in range(i, i + len(piece) - 59)}
        assert covered == {(d, i) for d, b in enumerate(raw) for i in range(len(b) - 59) if windows[b[i:i + 60]] > 1}
        seen.append({(piece, *p) for piece, places in at.items() for p in places})
    assert seen[0] == seen[1] and len({d for _, d, _ in seen[0]}) == 35


def fingerprint(text):
    w = WORD.findall((text or "").encode().lower())
    shingles = [b" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x, seed=42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(n, linked):
    group = list(range(n))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        group[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


@pytest.mark.parametrize("bits", [3, 9])
def test_simhash(docs, rows, bits):
    got = simhash.near_duplicates(docs, max_bits=bits).collect()
    fps = [fingerprint(r[1]) for r in rows]
    group = classes(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= bits])
    least = defaultdict(list)
    for r, g in zip(rows, group, strict=True):
        least[g].append(r[0])
    want = [(r[0], f - (1 << 64) if f >> 63 else f, min((x for x in least[g] if x is not None), default=None))
            for r, f, g in zip(rows, fps, group, strict=True)]
    assert bag(got) == Counter(want)


def test_gray_index_finds_all_links():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 60, dtype=np.uint64)
    near = [int(x) ^ sum({1 << int(b) for b in rng.integers(0, 64, rng.integers(0, 6))}) for x in base for _ in range(20)]
    fps = np.unique(np.array([*base.tolist(), *near, *range(64)], np.uint64))
    fps = fps[np.argsort(simhash.gray_rank(fps))]
    a, b = simhash.GrayIndex(fps, np.zeros(len(fps), int)).links(3)
    assert (np.bitwise_count(fps[a] ^ fps[b]) <= 3).all()
    x, y = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= 3)
    assert (simhash.contract(len(fps), a, b) == simhash.contract(len(fps), x, y)).all()


def test_components(spark):
    rnd = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, 1000 + i) for i in range(200)] + [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    got = {r[0]: r[1] for r in components.connected_components(spark.createDataFrame([*edges, (9, 9), (None, 4)], "src long, dst long")).collect()}
    group = classes(2000, edges)
    assert got == {n: group[n] for e in edges if e[0] != e[1] for n in e}


def test_packing(docs, rows):
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    ids = [[*whole.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows]
    total = sum(map(len, ids))
    for targets in (None, {"s0": 3, "s1": 1}):
        got = packing.pack(docs, path, window=256, targets=targets, keep_ids=True).collect()
        sequences, pieces = defaultdict(list), defaultdict(list)
        for r in got:
            sequences[r["sequence_id"]].append((r["offset"], r["length"], r["source"]))
            assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] and len(r["ids"]) == r["length"]
            pieces[r["doc_id"]].append(r)
        assert sorted(x for r in got for x in r["ids"]) == sorted(x for d in ids for x in d)
        for (doc_id, text, *_), want in zip(rows, ids, strict=True):
            if doc_id not in (None, 5):  # those of repeated ids lie in between each other
                own = sorted(pieces[doc_id], key=lambda r: r["start"])
                assert [x for r in own for x in r["ids"]] == want and {r["doc_tokens"] for r in own} == {len(want)}
        assert sorted(sequences) == [*range(len(sequences))]
        for k, parts in sequences.items():
            at = 0
            for offset, length, _ in sorted(parts):
                assert offset == at
                at += length
            assert at == 256 if k < total // 256 else at & (at - 1) == 0
        if targets is None:
            share = Counter()
            for r, d in zip(rows, ids, strict=True):
                share[r[3]] += len(d) / total * 256
            for k in range(total // 256):
                has = Counter()
                for _, length, source in sequences[k]:
                    has[source] += length
                assert all(abs(has[s] - share[s]) <= 2 * len(share) for s in share)
        else:
            has = Counter()
            for _, length, source in sequences[0]:
                has[source] += length
            assert has == {"s0": 192, "s1": 64}


def played(totals, targets, window):
    """Deficit round-robin played round by round: (source, first token, tokens, position) of every turn."""
    left, sent, debt, at, out = dict(totals), dict.fromkeys(totals, 0), dict.fromkeys(totals, Fraction(0)), 0, []

    def send(s, n):
        nonlocal at
        if n:
            out.append((s, sent[s], n, at))
        sent[s] += n
        left[s] -= n
        at += n

    left = {s: n for s, n in left.items() if n}
    while left:
        weight = {s: Fraction(targets.get(s, 0)) if targets else Fraction(totals[s]) for s in left}
        weight = {s: w for s, w in weight.items() if w > 0} or {s: Fraction(n) for s, n in left.items()}
        quantum = {s: window * w / sum(weight.values()) for s, w in weight.items()}
        while all(left[s] >= debt[s] + quantum[s] for s in quantum):
            for s in sorted(quantum):
                debt[s] += quantum[s]
                n = int(debt[s])
                debt[s] -= n
                send(s, n)
        for s in sorted(quantum):
            if left[s] < debt[s] + quantum[s]:
                send(s, left[s])
                del left[s]
    return out


@pytest.mark.parametrize("totals,targets", [({"a": 1000, "b": 337, "c": 61}, None), ({"a": 1000, "b": 337, "c": 61, "d": 5}, {"a": 1, "b": 1, "c": 7}),
                                            ({"a": 7}, None), ({"a": 50, "b": 0, "c": 900}, {"a": 3, "c": 2, "x": 9}), ({"a": 3, "b": 2}, {"z": 1})])
def test_schedule_equals_played_rounds(totals, targets):
    plan = packing.schedule(totals, targets, 32)
    want = defaultdict(list)
    for s, first, n, at in played(totals, targets, 32):
        want[s] += [(first + i, at + i) for i in range(n)]
    for s, total in totals.items():
        for cuts in ([0, total], [0, total // 3, total // 3, total // 2, total]):
            got = [(place + i, position + i) for a, z in zip(cuts, cuts[1:]) for place, n, position in packing.chunks(plan, s, a, z) for i in range(n)]
            assert got == want[s], s


def test_word_tokenizer_and_cache():
    from tokenizers import Tokenizer

    path = tokenizer_path("word_bpe_49k.json")
    own, whole, rnd = WordTokenizer(path), Tokenizer.from_file(path), random.Random(2)
    signs = ["a", "B", "é", "Σ", "İ", "́", " ", "\n", "\x1d", " ", "1", "'s", "<|endoftext|>", "!", "漢", "😀", "\xa0", "ŉ", "ẞ", "Å"]
    for _ in range(500):
        t = "".join(rnd.choice(signs) for _ in range(rnd.randint(0, 20)))
        assert np.frombuffer(own.encode(t), "<u2").tolist() == whole.encode(t, add_special_tokens=False).ids
    plain = ["a", "B", "é", "À", "ß", "µ", " ", "\n", "\t", "\xa0", "\x85", "1", "²", "½", "ª", "'", "'", "s", "re", "ve", "ll", "'m", "!", "...", "-", "\0", "word", "×", "x" * 70]
    texts = [*("".join(rnd.choice(plain) for _ in range(rnd.randint(0, 30))) for _ in range(3000)), *("".join(rnd.choice(signs) for _ in range(rnd.randint(0, 20))) for _ in range(500)), "", "'", "a'", "it's", "''s", "'s's"]
    for size in (1 << 21, 50):  # a table that is started anew again and again
        own.table = PieceTable(own.table.dtype, size)
        for a in range(0, len(texts), 700):
            got = own.encode_many([t.encode() for t in texts[a:a + 700]])
            assert [np.frombuffer(x, "<u2").tolist() for x in got] == [e.ids for e in whole.encode_batch(texts[a:a + 700], add_special_tokens=False)]
            own.table.most = min(own.table.most, size)
    assert own.encode_many([]) == [] and own.encode_many([b"", b""]) == [b"", b""]
    c = Cache(lambda k: k * 2, most=10)
    assert [c[i % 37] for i in range(500)] == [i % 37 * 2 for i in range(500)] and len(c) + len(c.older) <= 21


def test_bpe(docs, rows):
    from tokenizers import Tokenizer

    path = tokenizer_path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(path)
    want = []
    for r in rows:
        ids = whole.encode(r[1] or "", add_special_tokens=False).ids
        text = whole.decode(ids, skip_special_tokens=False)
        want.append((r[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), text, hashlib.sha256(text.encode()).hexdigest()))
    assert bag(bpe.decode(bpe.encode(docs, path), path).collect()) == Counter(want)
    own, rnd = bpe.ByteBPE(path), random.Random(4)
    signs = ["a", "the", " ", "  ", "\n", "\x85", "1", "'s", "<|endoftext|>", "!", "漢", "😀", "²", "ing", "́"]
    for t in [*("".join(rnd.choice(signs) for _ in range(rnd.randint(0, 25))) for _ in range(500)), "a" * 20_000]:
        ids = own.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(t, add_special_tokens=False).ids and own.decode(ids) == t


def test_classifier(spark):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(600):
        good = i % 3 != 0
        words = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(5, 60))]
        rows.append((i, " ".join(w if good else w + "###" for w in words), "x"))
        labels.append((i, int(good)))
    rows += [(None, "a b", "x"), (9999, None, "x"), (9998, "", "x"), (1, rows[1][1], "x")]
    labels += [(2, 1 - labels[2][1]), (2, labels[2][1]), (2, labels[2][1]), (700, None), (None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    trees = quality_model.train(docs, marks)
    got = quality_model.score(docs, trees).withColumn("out", quality_model.held_out(F.col("doc_id"))).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    truth = dict((a, b) for a, b in labels[:600])
    held = [r for r in got if r["out"] and r["doc_id"] in truth]
    assert {r["doc_id"] for r in held} == {d for d in {r[0] for r in rows} & truth.keys() if zlib.crc32(str(d).encode()) % 3 == 1}
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held)
    flat = quality_model.train(docs, marks.filter("quality = 1"))
    assert not flat.roots and len(quality_model.train(docs.limit(0), marks).roots) == 0
    walked = [trees.base] * 3
    x = np.array([quality_model.statistics(t) for t in (b"a b", b"", b"a### b###")])
    for root in trees.roots:
        for i in range(3):
            node = root
            while not np.isinf(trees.cut[node]):
                node = trees.left[node] + (x[i, trees.feature[node]] > trees.cut[node])
            walked[i] += trees.value[node]
    assert np.allclose(trees.margin(x), walked)


def test_top_k(spark):
    rng = np.random.default_rng(8)
    rows = [(i, (rng.integers(-40, 40, 6) / 64).tolist() if i % 5 else [0.5] * 6) for i in range(300)]
    rows += [(300, None), (301, [1.0, None, 1.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (304, []), (305, [1.0]), (None, [1.0] * 6), (40, [0.25] * 6), (7, rows[7][1]), (306, [1e9] * 6), (340, [1e6, -1e6, 3.5, 0.0, 1e6, -7e5])]
    got = topk.top_k(spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, id string, q int"), k=20).collect()
    good = [(i, [int(np.floor(64 * x)) for x in v] + [0] * (6 - len(v))) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    found = defaultdict(Counter)
    for r in got:
        found[r["query_id"]][(r["vec_id"], r["score"])] += 1
    for q, v in good:
        if q % 20 == 0 and q != 40:
            scored = sorted(((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q))[:20]
            assert found[q] == Counter((i, -s) for s, i in scored), q
    assert 40 in found and len(found) == len({i for i, _ in good if i % 20 == 0})


def test_top_k_wide_values(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.integers(-2**30, 2**30, 4) * 2.0 ** int(rng.integers(-20, 20))).tolist()) for i in range(100)] + [(200, [2.0**50, 0.0]), (201, [1e-3] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    good = [(i, [int(np.floor(64 * x)) for x in v] + [0] * (4 - len(v))) for i, v in rows]
    fits = {(q, i): s for q, v in good for i, w in good if q != i for s in [sum(a * b for a, b in zip(v, w))]}
    assert max(fits.values()) >= 2**63  # the best scores of some queries do not fit a long
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(df).collect()
    with pytest.raises(Exception, match="does not fit a long"):
        topk.top_k(spark.createDataFrame([(20, [1e300]), (21, [1.0])], "vec_id long, embedding array<double>")).collect()
    small = [(i, [x * 2.0**-28 for x in v]) for i, v in rows]
    monkeypatch.setattr(topk, "BLOCK", 30)
    monkeypatch.setattr(topk, "QUERIES", 2)
    got = topk.top_k(spark.createDataFrame(small, "vec_id long, embedding array<double>"), k=7, query_every=10).collect()
    good = [(i, [int(np.floor(64 * x)) for x in v] + [0] * (4 - len(v))) for i, v in small]
    want = set()
    for q, v in good:
        if q % 10 == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)[:7]
            want |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(best)}
    assert {tuple(r) for r in got} == want and max(abs(s) for *_, s in want) > 2**40


def test_top_k_few_rows(spark):
    got = topk.top_k(spark.createDataFrame([(20, [0.5]), (21, [0.5]), (22, [-0.5])], "vec_id long, embedding array<float>")).orderBy("rank").collect()
    assert [tuple(r) for r in got] == [(20, 1, 21, 1024), (20, 2, 22, -1024)]


def base_statistics(text):
    text = text or ""
    w = [x.decode() for x in WORD.findall(text.encode())]
    wins = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    hit = {j for i in range(len(w) - 7) if wins[tuple(w[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x.encode())]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_quality_rules(docs, rows):
    got = quality_rules.verdicts(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    want = []
    for r in rows:
        s = base_statistics(r[1])
        want.append((r[0], *s, s[0] < 20 or 100 * s[4] > 30 * s[0]))
    assert bag(r[:7] for r in got) == Counter(want)
    assert not any(r["base_failed"] and r["kept"] for r in got) and any(r["kept"] for r in got)
    kept = quality_rules.kept_documents(docs)
    assert kept.columns == docs.columns
    assert bag((r["doc_id"],) for r in kept.collect()) == bag((r["doc_id"],) for r in got if r["kept"])


def test_rule_order_prefers_rejections_per_cost(spark, docs):
    assert sorted(quality_rules.ordered(docs)) == sorted(["few_words", "repeated_windows", "word_length", "symbols", "repeated_lines", "echoes", "capitals"])
    order = quality_rules.by_rejections_per_cost
    assert order(["a", "b", "c"], {0b001: 10, 0b010: 10, 0b100: 10}, {"a": 3.0, "b": 1.0, "c": 2.0}) == ["b", "c", "a"]
    assert order(["a", "b", "c"], {0b011: 50, 0b100: 30, 0b010: 1}, {"a": 1.0, "b": 1.0, "c": 1.0}) == ["b", "c", "a"]  # what b leaves, a does not reject
    assert order(["a", "b"], {}, {"a": 2.0, "b": 1.0}) == ["b", "a"]

    texts = spark.createDataFrame([("word " * (30 + i % 7) + ("x" if i % 2 else "") + ("y" if i % 10 == 0 else ""),) for i in range(3000)], "text string").coalesce(1)

    def given(f):
        dear = F.aggregate(F.sequence(F.lit(1), F.lit(3000)), F.lit(0).cast("long"), lambda a, i: a + i * f["n_words"] % 7) >= 0  # always true
        half, tenth = f["word_chars"] % 2 == 1, f["n_words"] % 5 == 0
        return [quality_rules.Rule("dear_tenth", dear & tenth), quality_rules.Rule("dear_half", dear & half),
                quality_rules.Rule("never", f["n_words"] < 0), quality_rules.Rule("cheap_half", half)]

    for at_hand in ((), ("n_words", "word_chars")):
        found = quality_rules.ordered(texts, at_hand=at_hand, given=given)
        assert found[:2] == ["cheap_half", "dear_tenth"] and set(found[2:]) == {"never", "dear_half"}, found


def dice(a, b):
    a, b = Counter(zip(a, a[1:])), Counter(zip(b, b[1:]))
    return (a & b).total(), a.total() + b.total()


def test_license_scan(spark):
    mit = license_scan.TEMPLATES["MIT"]
    texts = ["Foo bar.\nReleased under the MIT License.\nmore text here", "released  UNDER the mit licence", mit[2], mit[2].replace(", ", ",\n"), None, "",
             "x\n\nLicensed under the\nApache License, Version 2.0.\n\ny", "a a a a a", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-SA 4.0", "long " * 5000]
    got = {r["doc_id"]: r for r in license_scan.scan(spark.createDataFrame([(i, t, "q", 1) for i, t in enumerate(texts)], "doc_id long, text string, units string, n int")).collect()}
    for i, t in enumerate(texts):
        clean = re.sub("[^a-z0-9\n]+", " ", (t or "").lower())
        parts = clean.split("\n") + re.split(r"\n(?: *\n)+", clean) + [clean]
        units = {" ".join(u.split()) for u in parts} - {""}
        best = min(((-s / n, name, -n, s) for u in units for name, texts_ in license_scan.TEMPLATES.items() for x in texts_
                    for s, n in [dice(u.split(), license_scan.template_words(x))] if n and 200 * s >= 80 * n), default=None)
        assert got[i]["n_units"] == len(units)
        assert (got[i]["license"], got[i]["shared"], got[i]["total"]) == ((best[1], best[3], -best[2]) if best else (None, None, None)), t
    assert got[0]["license"] == "MIT" and got[6]["license"] == "Apache-2.0" and got[8]["license"] == "CC-BY-NC-4.0" and got[10]["license"] is None


def prose():
    gnu, more = "This work is licensed under the GNU {}General Public License, version {}.", license_scan.MORE
    cases = [("Copyright 2020 Foo. Released under the MIT License.", "MIT"), ("The toolkit is released under the MIT License.", "MIT"),
             ("some words before it " * 30 + "Licensed under the\n * Apache License,\n * Version 2.0. " + "and after it " * 30, "Apache-2.0"),
             ("Header\n" + gnu.format("", 2) + " See below.", "GPL-2.0"), (gnu.format("", 3), "GPL-3.0"), (gnu.format("Lesser ", 3), "LGPL-3.0"),
             (gnu.format("Lesser ", 2.1), "LGPL-2.1"), (gnu.format("Affero ", 3), "AGPL-3.0"), (gnu.format("", 4), None), (gnu.format("Library ", 2), None),
             ("This project is licensed under the terms of the Foo license.", None), ("Photo: licensed under CC BY-ND 4.0. All else is not.", "CC-BY-ND-4.0"),
             ("Licensed under CC BY-SA 3.0.", None), ("Copyright\n\n" + more["BSD-2-Clause"][2].replace(", ", ",\n"), "BSD-2-Clause"),
             ("Copyright\n\n" + more["BSD-3-Clause"][2].replace(", ", ",\n"), "BSD-3-Clause"), ("a b c " * 100 + more["MIT"][2] + " d e f" * 100, "MIT"),
             ("The mit license of released work, under the sea.", None)]
    return cases + [(f"He wrote: {t} And so on.", name) for name, texts in more.items() for t in texts]


def test_license_notices_in_prose(spark):
    cases = prose()
    got = license_scan.scan(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["license"] for r in got} == {i: name for i, (_, name) in enumerate(cases)}


def test_license_windows_by_brute_force(spark):
    rnd, templates = random.Random(3), {"A": ["a b c d e f g a b c", "d d e"], "B": ["b c d e f h"]}
    texts = ["".join(rnd.choice(["a b c d e ", "f g a b c ", "x ", "b c ", "d e f h", "\n", " d d ", "y y "]) for _ in range(rnd.randint(1, 9))) for _ in range(120)]
    got = {r["doc_id"]: r for r in license_scan.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), templates, least=70).collect()}
    for i, t in enumerate(texts):
        w = t.split()
        units = [x.split() for x in t.split("\n")] + [x.split() for x in re.split(r"\n(?: *\n)+", t)] + [w]
        scores = []
        for name, x in ((name, x.split()) for name, texts_ in templates.items() for x in texts_):
            for u in units + [w[j:j + len(x)] for j in range(len(w) - len(x) + 1)]:
                s, n = dice(u, x)
                if len(u) > 1 and 200 * s >= 70 * n:
                    scores.append((-s / n, name, -n, s))
        best = min(scores, default=None)
        assert (got[i]["license"], got[i]["shared"], got[i]["total"]) == ((best[1], best[3], -best[2]) if best else (None, None, None)), t


def test_license_repeated_bigrams(spark):
    out = license_scan.scan(spark.createDataFrame([(1, "go go go go stop")], "doc_id long, text string"), {"L": ["go go go stop stop"]}, least=50).first()
    assert (out["shared"], out["total"]) == dice("go go go go stop".split(), "go go go stop stop".split())


PAGES = [
    (1, "http://a.net/x", ""), (2, "http://b.com/p", '<link rel="canonical" href="http://a.net/x">'),
    (3, "http://c.com/p", "<LINK HREF='/q' REL='nofollow canonical'>"), (4, "http://c.com/q", '<meta http-equiv="refresh" content="0; url=http://b.com/p#top">'),
    (5, "http://d.example.net/en/1", '<link rel=canonical href=http://e.com/1>'), (6, "http://e.com/1", ""),
    (7, "http://f.com/", '<link rel="canonical" href="http://bad.net/z">'), (8, "http://f.com/", None),
    (9, "http://g.com/1", '<link rel="canonical" href="http://d.example.net/en/1"><meta http-equiv=refresh content="5;URL=//h.net/k">'),
    (10, "HTTP://WWW.Example.COM/de/1?x#y", ""), (11, "http://example.net", ""), (12, None, "x"), (13, "no scheme/net/", ""), (14, "", None),
    (15, "http://i.com/a/b?c=1", '<link rel="alternate canonical" href="../b"><link rel="stylesheet" href="http://a.net/x">'), (16, "http://j.org/fr/x", ""),
    (None, "http://xnet/", ""), (2, "http://b.com/p", ""),
]


def test_url_filters(spark):
    pages = spark.createDataFrame([(*p, "x", 1) for p in PAGES], "page_id long, url string, html string, node string, rule int")
    got = url_filter.judge(pages)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"]
    said = {(r["page_id"], r["rule"], r["verdict"]) for r in got.collect()}
    assert got.count() == len(PAGES)
    assert said == {(1, "net/", "block"), (2, None, "block"), (3, None, "block"), (4, None, "block"), (5, "example.net/en/", "allow"), (6, None, "allow"),
                    (7, None, "block"), (8, None, "block"), (9, None, "allow"), (10, "example.com/de/", "block"), (11, None, "allow"), (12, None, "allow"),
                    (13, None, "allow"), (14, None, "allow"), (15, None, "allow"), (16, "org/fr/", "allow"), (None, None, "allow")}
    one = got.filter("page_id = 10").first()
    assert (one["host"], one["path"]) == ("www.example.com", "/de/1")
    more = url_filter.judge(pages, redirects=spark.createDataFrame([("http://i.com/a/b?c=1", "http://a.net/x")], "src string, dst string"))
    assert more.filter("page_id = 15").first()["verdict"] == "block"


def test_url_dot_segments_and_base(spark):
    link = '<link rel="canonical" href="{}">'.format
    pages = [("http://a.net/x/y", "", "block"), ("http://b.net/x/", "", "block"),
             ("http://k.com/b", link("http://a.net/x/y"), "block"), ("http://k.com/a/c", link("../b"), "block"), ("http://k.com/a/d/e?q=../z", link("./../../b"), "block"),
             ("http://l.com/a/./up/../p", link("http://a.net/w/../x/./y"), "block"), ("http://l.com/a/q", link("./p"), "block"),
             ("http://m.com/q", '<BASE target=x><base href="http://b.net/w/v">' + link("../x/."), "block"), ("http://m.com/r", '<base href="/s/">' + link("../q"), "block"),
             ("http://n.com/1", "<base href=http://a.net/x/y>" + link("#top"), "block"), ("http://n.com/2", "<basefont href=http://a.net/x/y>" + link("#top"), "allow"),
             ("http://o.com/a", link("b/../../../.."), "allow"), ("http://o.com/", "", "allow"), ("http://o.com/...", link("..x"), "allow"),
             ("http://example.com/en/../de/1", "", "allow"), ("http://p.com/a//..", link("b?u=/../x"), "allow"),
             ("http://example.com/de/../en/", "", "block"), ("http://q.com/1", link("http://example.com/en/"), "block"), ("http://q.com/2", link("http://example.com/y/../de/z"), "allow"),
             ("http://example.com/en/z", link("../de/w"), "block")]
    got = url_filter.judge(spark.createDataFrame([(i, u, h) for i, (u, h, _) in enumerate(pages)], "page_id long, url string, html string"))
    assert {r["page_id"]: r["verdict"] for r in got.collect()} == {i: v for i, (_, _, v) in enumerate(pages)}


#: Rules see the path of the url as it is; classes go by addresses without dot segments and fragment.
RAW_PATHS = [("http://example.com/x/../de/a", "", "example.com", "/x/../de/a", None, "allow"), ("http://example.com/de/../en/", "", "example.com", "/de/../en/", "example.com/de/", "block"),
             ("http://a.org/./fr/x", "", "a.org", "/./fr/x", None, "allow"), ("x#y://net/", "", "net", "/", "net/", "block"), ("http://a.org/fr/../x", "", "a.org", "/fr/../x", "org/fr/", "allow"),
             ("http://r.com/a", '<link rel="canonical" href="http://example.com/q/../en/">', "r.com", "/a", None, "block"), ("http://r.com/b/../c?x", "", "r.com", "/b/../c", None, "allow"),
             ("http://r.com/d", '<link rel="canonical" href="/./e">', "r.com", "/d", None, "allow"), ("http://r.com/" + "x/" * 200_000, "y" * 2_000_000, "r.com", "/" + "x/" * 200_000, None, "allow")]


def test_rules_on_the_path_as_given(spark):
    got = url_filter.judge(spark.createDataFrame([(i, *x[:2]) for i, x in enumerate(RAW_PATHS)], "page_id long, url string, html string"))
    assert sorted(map(tuple, got.collect())) == [(i, *x[2:]) for i, x in enumerate(RAW_PATHS)]


def test_dot_segments(spark):
    def plain(path):
        out, segments = [], path.split("/")[1:]
        for x in segments:
            if x == "..":
                out = out[:-1]
            elif x != ".":
                out.append(x)
        return "/" + "/".join(out + [""] * (segments[-1] in (".", ".."))) if path else path
    rnd = random.Random(4)
    paths = ["", "/"] + ["".join("/" + rnd.choice([".", "..", "a", "b.", "", "...", "c"]) for _ in range(rnd.randint(1, 7))) for _ in range(200)]
    assert plain("/a/b/c/./../../g") == "/a/g" and plain("/a/..") == "/"
    df = spark.createDataFrame([(f"HTTP://X.com{p}?../q#/../f",) for p in paths], "u string").select("u", url_filter.address(F.col("u")).alias("a"))
    assert {r["u"]: r["a"] for r in df.collect()} == {f"HTTP://X.com{p}?../q#/../f": f"http://x.com{plain(p)}?../q" for p in paths}


def test_very_long_texts(spark):
    """One text beyond a batch among short ones, against brute force or the library."""
    from tokenizers import Tokenizer

    rnd = random.Random(12)
    say = lambda n: " ".join(f"w{rnd.randrange(10**7)}é" for _ in range(n))
    passage = say(40)
    texts = ["short text", f"{say(150_000)} {passage}\n{say(60_000)} released under the MIT License.\n", f"{say(10)}\n{passage} {say(10)}", None, "x " * 30]
    assert len(texts[1]) > 1_500_000
    df = spark.createDataFrame([(i, t, "s", 1) for i, t in enumerate(texts)], "doc_id long, text string, source string, words int").coalesce(2)
    assert {r["doc_id"]: r["license"] for r in license_scan.scan(df).collect()} == {0: None, 1: "MIT", 2: None, 3: None, 4: None}
    got = {r["doc_id"]: tuple(r)[1:6] for r in quality_rules.verdicts(df).collect()}
    assert got == {i: base_statistics(t) for i, t in enumerate(texts)}
    words, path = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
    whole = Tokenizer.from_file(words)
    want = {i: [*whole.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    ids = defaultdict(list)
    for r in sorted(packing.pack(df, words, keep_ids=True).collect(), key=lambda r: r["start"]):
        ids[r["doc_id"]] += r["ids"]
    assert ids == want
    whole = Tokenizer.from_file(path)
    coded = {r["doc_id"]: r for r in bpe.decode(bpe.encode(df, path), path).collect()}
    assert all(coded[i]["decoded"] == (t or "") and coded[i]["n_tokens"] == len(whole.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts))
    labels = spark.createDataFrame([(0, 1), (2, 0)], "doc_id long, quality int")
    assert all(0 <= r["score"] <= 1 for r in quality_model.score(df, quality_model.train(df, labels)).collect())
    near = {r["doc_id"]: r for r in simhash.near_duplicates(df).collect()}
    assert all(near[i]["fp"] % 2**64 == fingerprint(t) for i, t in enumerate(texts))
    size = len(passage.encode())
    cut = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove_repeats(df).collect()}
    assert size <= cut[1][0] <= size + 4 and cut[1][1] == 1 and cut[1] == cut[2] and cut[0] == (0, 0)


def test_empty_tables(spark, empty):
    words, path = tokenizer_path("word_bpe_49k.json"), tokenizer_path("byte_bpe_50k.json")
    for df in (substring_dedup.remove_repeats(empty), suffix_dedup.remove_repeats(empty), simhash.near_duplicates(empty), packing.pack(empty, words),
               bpe.decode(bpe.encode(empty, path), path), quality_rules.verdicts(empty), quality_rules.kept_documents(empty), license_scan.scan(empty),
               topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>")),
               url_filter.judge(spark.createDataFrame([], "page_id long, url string, html string"))):
        assert df.count() == 0
