"""Operators 11 to 13 against brute force on small fixtures with nulls, ties, repeats, odd and long texts."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from barline.llm import conversation_trie, fill_middle, language_id
from barline.llm.queries import QUERIES
from barline.llm.sql import ORACLE
from barline.session import stored

SF = "/root/testdata/sf0.01"


# ---- operator 12

def brute_trie(rows, family=1, heads=1):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own[conv].append(((turn is not None, turn or 0, digest), (role, text)))
    turns = {c: [x for _, x in sorted(v, key=lambda y: y[0])] for c, v in own.items()}
    built = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % heads
        built[c] = tuple(turns.get(c - c % family, [])[:h] + turns[c][h:]) if family > 1 else tuple(turns[c])
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[built[c][:d]].append(c)
        ends[built[c]].append(c)
    kids = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return Counter((m[0], len(p), members[p[:-1]][0] if p else None, len(m), kids[p], leaves[p], saved[p],
                    hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


def conversations(seed=3):
    rnd = random.Random(seed)
    texts = ["hi", "", None, "é 日", "x" * 50_000, "a\0b", "hi "]
    rows = []
    for c in range(-12, 400):
        if c % 5 == 0 and rnd.random() < 0.2:
            continue  # a missing opener
        for t in range(rnd.choice([1, 1, 2, 3, 5, 9, 12])):
            rows.append((c, t if rnd.random() < 0.95 else None, rnd.choice(["user", "assistant", None, ""]), rnd.choice(texts[:3]) if t < 4 else rnd.choice(texts)))
    same = [(t, "user", f"common {t}") for t in range(6)]
    rows += [(c, *x) for c in range(1000, 1400) for x in same]  # a hot conversation
    rows += [(c, *x) for c in range(1400, 1500) for x in same[:3]]
    rows += [(2000, t, "user", "deep") for t in range(700)] + [(2001, t, "user", "deep") for t in range(650)]
    return rows + [(None, 0, "user", "lost"), (7, 0, "user", "tie"), (7, 0, "user", "eit"), (8, 0, "a", "a"), (8, 0, "a", "a")]


CONVERSATIONS = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("family,heads,rows_a_shard,final_bytes", [(5, 9, 1 << 15, 8 << 20), (5, 9, 16, 8 << 20), (1, 1, 9, 3_000), (5, 9, 23, 5_000)])
def test_conversation_trie(spark, monkeypatch, family, heads, rows_a_shard, final_bytes):
    rows = conversations()
    df = spark.createDataFrame(rows, CONVERSATIONS).withColumn("path", F.lit("clash")).withColumn("key", F.lit(1)).repartition(5)
    monkeypatch.setattr(conversation_trie, "SHARD_ROWS", rows_a_shard)
    solve = conversation_trie._shards

    def small(batches, second, own, whole=False):  # the workers import the module afresh: carry the setting with the function
        conversation_trie.SHARD_ROWS, conversation_trie.CHUNK = rows_a_shard, 7
        return solve(batches, second, own, whole)

    monkeypatch.setattr(conversation_trie, "_shards", small)
    rounds = []
    monkeypatch.setattr(conversation_trie, "stored", lambda d, name: rounds.append(out := stored(d, name)) or out)
    got = conversation_trie.trie(conversation_trie.paths(df, family, heads), final_bytes=final_bytes)
    assert tuple(got.columns) == conversation_trie.OUTPUT
    assert Counter(map(tuple, got.collect())) == brute_trie(rows, family, heads)
    if final_bytes < 100_000:
        assert len(rounds) > 2 and rounds[0].filter("kind = 1").count() >= len(rows) / 10 / rows_a_shard


def test_trie_of_nothing(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert conversation_trie.trie(conversation_trie.paths(empty, 5, 9)).collect() == []
    lost = spark.createDataFrame([(None, 1, "a", "b")], CONVERSATIONS)
    assert conversation_trie.trie(conversation_trie.paths(lost, 5, 9)).collect() == []
    bare = [(c, 0, "user", "x") for c in range(1, 60)]  # openers are missing: many lose all turns
    got = conversation_trie.trie(conversation_trie.paths(spark.createDataFrame(bare, CONVERSATIONS), 5, 9)).collect()
    assert Counter(map(tuple, got)) == brute_trie(bare, 5, 9)


def test_trie_sql_on_odd_rows(spark):
    rows = [r for r in conversations(4) if r[0] is None or r[0] < 300 or r[0] % 40 == 0]
    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    want = con.execute(ORACLE["op12_conversation_trie"])
    assert [d[0] for d in want.description] == list(conversation_trie.OUTPUT)
    assert Counter(want.fetchall()) == brute_trie(rows, 5, 9)


def test_parentheses():
    rnd = random.Random(2)
    for n in (1, 2, 5, 40, 3000):
        depth = [0]
        for _ in range(n - 1):
            depth.append(rnd.randint(1, depth[-1] + 1) if rnd.random() < 0.5 else depth[-1] + 1)
        tree = conversation_trie.Parentheses(np.array(depth))
        stack, want = [], {}
        for i, b in enumerate(tree.bits):
            if b > 0:
                stack.append(i)
            else:
                want[stack.pop()] = i
        assert tree.findclose(tree.opens).tolist() == [want[p] for p in tree.opens.tolist()]
        values = np.array([rnd.randrange(1000) for _ in range(n)])
        first = np.array([rnd.randrange(n) for _ in range(50)])
        last = np.array([rnd.randrange(f, n) for f in first])
        assert conversation_trie.range_minimum(values, first, last).tolist() == [values[a:b + 1].min() for a, b in zip(first, last)]


# ---- operator 13

def brute_fill(doc_id, text, seed=7, rate=100, spm=50, unit="line"):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(x[i:i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return (doc_id, len(units), "plain", None, None, text, text)
    out = f"<S>{s}<P>{p}<M>{m}" if h4 % 100 < spm else f"<P>{p}<S>{s}<M>{m}"
    return (doc_id, len(units), "spm" if h4 % 100 < spm else "psm", len(p), len(m), out, text)


def texts():
    rnd = random.Random(8)
    bits = ["a", "é", "日本", "😀", "\n", "\n\n", "\0", "\x0b", "\r\n", "<", "<P", "S>", " ", "word ", "ਊ", " "]
    out = [None, "", "\n", "\n\n\n", "no end", "ends\n", "<P>x\ny", "x\n<M>", "a<S>", "<\nP>\n", "long line " * 300_000, "many\n" * 400_000, "é" * 1_200_000 + "\nend"]
    return out + ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 60))) for _ in range(300)]


@pytest.mark.parametrize("rate,spm,unit", [(100, 50, "line"), (60, 100, "line"), (100, 0, "char")])
def test_fill_middle(spark, rate, spm, unit):
    rows = [*enumerate(texts()), (None, "null\nid\n"), (3, "again\nand again"), (3, "again\nand again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit("clash")).withColumn("digest", F.lit(2)).repartition(3)
    made = fill_middle.restore(fill_middle.transform(df, rate=rate, spm_rate=spm, unit=unit))
    assert made.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    assert Counter(map(tuple, made.collect())) == Counter(brute_fill(*r, rate=rate, spm=spm, unit=unit) for r in rows)


def test_fill_middle_bounds(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert fill_middle.transform(empty).collect() == []
    blank = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string").coalesce(1)
    assert [tuple(r) for r in fill_middle.transform(blank).collect()] == [(1, 0, "plain", None, None, ""), (2, 0, "plain", None, None, "")]
    with pytest.raises(ValueError):
        fill_middle.transform(empty, unit="page")
    with pytest.raises(ValueError):
        fill_middle.transform(empty, marks=("A", "B", "AB"))


def test_fill_middle_sql(spark):
    rows = [*enumerate(t for t in texts() if t is None or len(t) < 10_000)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = Counter(con.execute(ORACLE["op13_fill_middle"]).fetchall())
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert want == Counter((*x[:5], sha(x[5]), sha(x[6])) for x in (brute_fill(*r) for r in rows))


# ---- operator 11

def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = QUERIES["op11_language_id"](spark, SF).collect()
    want = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    assert len(got) == len(want) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) and 0 <= r["score"] <= 1 for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in held]) > 0.97


def test_language_margins_are_kernel_ridge():
    """Scores by weights of the vocabulary equal kernel rows times coefficients."""
    rnd = random.Random(4)
    say = lambda alphabet: "".join(rnd.choice(alphabet) for _ in range(rnd.randint(5, 80)))
    train = [(say("abc d"), "x") for _ in range(30)] + [(say("bcé f"), "y") for _ in range(30)] + [(say("xyz "), "z") for _ in range(3)]
    model = language_id.fit([t.encode() for t, _ in train], [y for _, y in train], landmarks=20, blend=(1, 2, 3))
    grams = lambda t: {(n, t[i:i + n]) for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    firsts = {y: [t for t, z in train if z == y] for y in "xyz"}
    chosen = [t for k in range(30) for y in "xyz" for t in firsts[y][k:k + 1]][:20]
    marks = [grams(t.encode()) for t in chosen]
    vocabulary = set().union(*marks)
    assert len(vocabulary) == len(model.codes)

    def row(t):
        own = grams(t.encode()) & vocabulary
        return np.array([len(own & m) / np.sqrt(max(1, len(own)) * len(m)) for m in marks])

    knm, kmm = np.array([row(t) for t, _ in train]), np.array([row(t) for t in chosen])
    values, vectors = np.linalg.eigh(kmm)
    live = values > 1e-8 * values.max()
    root = vectors[:, live] / np.sqrt(values[live])
    y = np.array([[1.0 if b == c else -1.0 for c in "xyz"] for _, b in train])
    w = np.linalg.solve((phi := knm @ root).T @ phi + 1e-2 * len(train) / 3 * np.eye(live.sum()), phi.T @ (y - y.mean(0)))
    probe = [say("abcdéfxyz ") for _ in range(40)] + ["", "é", "qqq"]
    assert np.allclose(model.margins([t.encode() for t in probe]), np.array([row(t) for t in probe]) @ root @ w + y.mean(0), atol=1e-4)


def test_language_edge_cases(spark, monkeypatch):
    schema = "doc_id long, text string, lang string, score string, held_out int"
    empty = spark.createDataFrame([], schema)
    assert language_id.predict(empty, language_id.train(empty)).collect() == []
    rows = [(i, "the cat sat on the mat and then the dog" if i % 2 else "der hund und die katze auf dem dach", "en" if i % 2 else "de") for i in range(60)]
    odd = [(100, None, "en"), (101, "", "de"), (102, "123 *** \n", "en"), (None, "the dog and the cat", "fr"), (103, "Ω", None), (104, "a" * 3_000_000 + " the cat", "en"),
           (105, "\0\0 the\0 dog and the cat sat", None), (7, "the dog", "en"), (7, "the dog", "en"), (106, "DIE KATZE UND DER HUND", "x" * 9)]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows + odd], schema).repartition(3)
    model = language_id.train(df, max_train_rows=50)
    assert "fr" not in model.languages  # a row without doc_id is not learnt from
    got = {}
    for r in language_id.predict(df, model).collect():
        got.setdefault(r["doc_id"], set()).add((r["lang_pred"], round(r["score"], 6)))
    assert got[100] == got[101] == got[102] == {("und", 0.0)}
    assert {x for x, _ in got[None]} == {"en"} and {x for x, _ in got[105]} == {"en"} and len(got[7]) == 2 and {x for x, _ in got[106]} <= {"de", "x" * 9}
    assert next(iter(got[104]))[0] in model.languages and next(iter(got[103]))[0] in model.languages
    assert all(len(got[i]) == 1 and next(iter(got[i]))[0] == ("en" if i % 2 else "de") for i in range(60) if i != 7)
    none = language_id.train(df.withColumn("lang", F.lit(None).cast("string")))
    assert {tuple(r) for r in language_id.predict(df, none).select("lang_pred", "score").collect()} == {("und", 0.0)}
    monkeypatch.setattr(language_id, "BATCH_BYTES", 50)  # pieces of long texts mark the same row
    whole = language_id.fit([r[1].encode() for r in rows], [r[2] for r in rows], landmarks=8)
    pieces = whole.margins([b"der hund und die katze auf dem dach " * 20, b"the cat"])
    monkeypatch.setattr(language_id, "BATCH_BYTES", 1 << 20)
    assert np.allclose(pieces, whole.margins([b"der hund und die katze auf dem dach " * 20, b"the cat"]))
