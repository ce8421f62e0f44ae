"""Registered queries against DuckDB SQL, and the pipeline against its parts."""

import hashlib
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barline.llm import quality_model, quality_rules, simhash, suffix_dedup
from barline.llm.queries import QUERIES
from barline.llm.sql import ORACLE

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(df.columns)
    assert Counter(tuple(r) for r in df.select(*names).collect()) == Counter(want.fetchall())


def test_licences_in_sql(spark):
    from test_llm_operators import prose
    from barline.llm import license_scan
    rows = [(i, t) for i, (t, _) in enumerate(prose())] + [(1000, None), (1001, ""), (1002, "go go go go"), (None, "Released under the MIT License."), (0, "x\n\n\n  \n y")]
    c = duckdb.connect()
    c.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    c.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = c.execute(ORACLE["op1_license_scans"])
    names = [d[0] for d in want.description]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).select(*names).collect()
    assert Counter(map(tuple, got)) == Counter(want.fetchall())


def test_aliases_in_sql(spark):
    from test_llm_operators import PAGES, RAW_PATHS
    PAGES = PAGES + [(100 + i, *x[:2]) for i, x in enumerate(RAW_PATHS)] + [(200, "http://s.com/1/./2", '<meta http-equiv=refresh content="0; url=../x/../../net/">'), (201, "http://s.com/net/", '<link rel=canonical href=//z.net/../q>')]
    c = duckdb.connect()
    c.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    c.executemany("INSERT INTO pages VALUES (?, ?, ?)", PAGES)
    from barline.llm import url_filter
    got = url_filter.judge(spark.createDataFrame(PAGES, "page_id long, url string, html string"))
    want = c.execute(ORACLE["op10_url_filters"])
    names = [d[0] for d in want.description]
    assert Counter(tuple(r) for r in got.select(*names).collect()) == Counter(want.fetchall())


def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(None, "word " * 50, "en", "x", 5), (None, "word " * 50, "en", "x", 5), (3, None, None, None, None), (-1, "", "en", "x", 0)], docs.schema)
    docs = docs.union(docs.filter("doc_id < 4")).union(odd).withColumn("__text", F.lit(1)).withColumn("score", F.lit(2))
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert [*stages] == ["quality_classifier", "quality_rules", "simhash_near_dedup", "suffix_array_dedup", "packing"]

    good = stages["quality_classifier"](spark, docs, SF)
    trees = quality_model.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    want = [r["predicted"] for r in quality_model.score(docs, trees).collect()]
    assert good.columns == columns and good.count() == sum(want)

    ruled = stages["quality_rules"](spark, docs, SF)
    assert ruled.columns == columns and ruled.count() == quality_rules.verdicts(docs).filter("kept").count()

    single = stages["simhash_near_dedup"](spark, docs, SF)
    groups = simhash.near_duplicates(docs).select("fp", "component_id").distinct().collect()
    assert single.columns == columns
    assert {r["doc_id"] for r in single.select("doc_id").collect()} - {None} == {r["component_id"] for r in groups} - {None}
    assert single.filter("doc_id is not null").count() == single.filter("doc_id is not null").select("doc_id").distinct().count()

    cut = stages["suffix_array_dedup"](spark, single, SF)
    assert cut.columns == columns and cut.dtypes == single.dtypes and cut.count() == single.count()
    kept = {r["doc_id"]: r["kept_text"] for r in suffix_dedup.remove_repeats(single, keep_text=True).collect()}
    for r in cut.collect():
        assert r["text"] == kept[r["doc_id"]] and r["n_chars"] == len(r["text"])

    packed = stages["packing"](spark, cut, SF)
    whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert len(whole) == cut.select("doc_id").distinct().count() and all(r["n"] == r["m"] for r in whole if r["doc_id"] is not None)


def test_near_duplicates_by_row(spark):
    a, b, c, d = (" ".join(f"{x}{i * i % 97}" for i in range(40)) for x in "abcd")
    rows = [(5, a, 1), (5, b, 2), (None, c, 3), (None, d, 4), (7, d, 5), (6, a, 6), (None, c, 7), (8, b, 8), (7, d, 9), (None, a, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int")
    got = corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter([(5, a), (5, b), (None, c), (7, d)])
    assert all(tuple(r) in rows for r in got)


def test_stages_by_brute_force(spark):
    from test_llm_operators import SCHEMA, base_statistics, classes, corpus, fingerprint, removed_bytes
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)

    def passes(text):
        text = text or ""
        n, chars, symbols, dup, again = base_statistics(text)
        words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
        lines = sum(1 for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x))
        return not (n < 20 or 100 * again > 30 * n or chars < 2 * n or chars > 15 * n or 10 * symbols > n or (dup >= 5 and 10 * dup > 3 * lines)
                    or 10 * sum(x == y for x, y in zip(words, words[1:])) > 3 * n or 2 * sum(c in quality_rules.CAPITALS for c in text) > chars)

    got = corpus_pipeline.apply_rules(spark, docs, SF).collect()
    assert Counter(map(tuple, got)) == Counter(r for r in rows if passes(r[1]))

    fps = [fingerprint(r[1]) for r in rows]
    groups = {}
    for r, g in zip(rows, classes(len(rows), [(i, j) for i in range(len(rows)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 3]), strict=True):
        groups.setdefault(g, []).append(r)
    got = [tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs, SF).collect()]
    assert len(got) == len(groups)
    for own in groups.values():
        least = min((r[0] for r in own if r[0] is not None), default=None)
        assert sum(r in own and r[0] == least for r in got) == 1

    kept = corpus_pipeline.drop_repeats(spark, docs, SF).collect()
    want = removed_bytes([r[1] for r in rows], 200)
    texts = {(r[0], r[5]): (r[1], x) for r, x in zip(rows, want, strict=True)}
    assert len(kept) == len(rows) and any(x[1] for x in want)
    for r in kept:
        text, (_, gone, _, digest) = texts[r["doc_id"], r["key"]]
        if (text or "").isascii():
            assert hashlib.sha256(r["text"].encode()).hexdigest() == digest
        assert len(r["text"].encode()) <= len((text or "").encode()) - gone and r["n_chars"] == len(r["text"])


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns
