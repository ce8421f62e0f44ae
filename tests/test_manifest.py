"""The staging and dead-letter tables as lists of files: what a batch opens, compaction, replay."""

import datetime as dt
import json

from pyspark.sql import functions as F

from barline.schemas import MESSAGE_ENVELOPE
from barline.session import work_path
from barline.streaming import ingest as ING
from barline.streaming.manifest import Entry, FileTable, bins, compact, unreferenced

DAY = 86_400_000
T0 = 1_704_067_200_000          # 2024-01-01 00:00 UTC


def message(offset, ms, symbol="A", text=None):
    body = {"symbol": symbol, "exchange": "x", "timestamp_ms": ms, "open": 1.0, "high": 2.0, "low": 0.5, "close": 1.5, "volume": 10.0}
    return (None, (json.dumps(body) if text is None else text).encode(), "raw", 0, offset, dt.datetime(2024, 1, 1))


def batch_of(spark, messages):
    return spark.createDataFrame(messages, MESSAGE_ENVELOPE)


def tables(spark, base):
    return ING.staging_table(spark, f"{base}/staging"), ING.dead_letter_table(spark, f"{base}/dlq")


def test_batch_opens_only_files_it_reaches_into(spark):
    base = work_path(spark, "manifest")
    staging, letters = tables(spark, base)
    # one batch a day, each with a reject; then a hundred earlier commits that only the manifest knows
    for i in range(4):
        ING.ingest_batch(batch_of(spark, [message(10 * i + k, T0 + i * DAY + k * 1000) for k in range(3)] + [message(10 * i + 9, 0, text="{bad")]), staging, letters, i)
    assert [e.rows for e in staging.entries()] == [3] * 4 and staging.row_count() == 12 and letters.row_count() == 4
    late = batch_of(spark, [message(100, T0 + DAY + 500), message(101, T0 + DAY + 2000), message(102, T0 + 3 * DAY + 60_000)])
    want = [e.file for e in staging.entries(["2024-01-02"])]
    seen = ING.ingest_batch(late, staging, letters, 4)
    assert seen == {"staging": want, "dead_letters": []}      # day 4's file ends before the batch's time of that day
    assert staging.read().count() == 14                       # (A, x, day 2 + 2000) was there already
    ghosts = [Entry(k, k, f"2023-{1 + k % 12:02d}-01", f"batch=0/candle_date=2023/{k}.parquet", 1, 10, 0, 1) for k in range(100)]
    staging.commit(ghosts)
    again = batch_of(spark, [message(200, T0 + DAY + 501)])
    assert ING.ingest_batch(again, staging, letters, 5)["staging"] == [e.file for e in staging.entries(["2024-01-02"]) if e.batch_id == 1]  # batch 4 left 500 alone there
    # what a new process loads is what this one holds
    other, _ = tables(spark, base)
    assert sorted(other.entries(), key=str) == sorted(staging.entries(), key=str) and other.commits == staging.commits


def test_replay_adds_nothing_and_lost_writes_are_not_read(spark):
    base = work_path(spark, "manifest-replay")
    staging, letters = tables(spark, base)
    batch = batch_of(spark, [message(k, T0 + k * 3_600_000) for k in range(30)] + [message(50, 0, text="[]"), message(51, 0, text="")])
    ING.ingest_batch(batch, staging, letters, 0)
    rows, bad = staging.read().orderBy("id").collect(), letters.read().orderBy("offset").collect()
    staging.write(staging.read(), 1)                          # a batch that died between its files and its commit
    for st, le in ((staging, letters), tables(spark, base)):
        ING.ingest_batch(batch, st, le, 0)
        assert st.read().orderBy("id").collect() == rows and le.read().orderBy("offset").collect() == bad
    assert len(rows) == 30 and [bytes(r["value"]) for r in bad] == [b"[]", b""]
    assert {r["reason_detail"] for r in bad} == {"invalid_json"}
    left = {r["file"] for r in unreferenced(staging).collect()}
    assert left and not left & {e.file for e in staging.entries()}


def test_compaction_keeps_rows_marks_and_replay(spark):
    base = work_path(spark, "manifest-compact")
    staging, letters = tables(spark, base)
    for i in range(6):
        ING.ingest_batch(batch_of(spark, [message(100 * i + k, T0 + (k % 2) * DAY + (100 * i + k) * 1000) for k in range(10)] + [message(100 * i + 50, 0, text="{}")]),
                         staging, letters, i)
    ING.ingest_batch(batch_of(spark, [message(900, T0 + 5 * DAY)]), staging, letters, 6)
    mark = staging.commits
    before = staging.read().orderBy("id").collect(), letters.read().orderBy("offset").collect()
    old = staging.read()                                      # a reader from before the swap
    assert compact(staging) == 12 and compact(letters) == 6
    assert [len(staging.entries([d])) for d in ("2024-01-01", "2024-01-02", "2024-01-06")] == [1, 1, 1] and len(letters.entries()) == 1
    for st, le in ((staging, letters), tables(spark, base)):
        assert (st.read().orderBy("id").collect(), le.read().orderBy("offset").collect()) == before
        assert st.touched_since(mark) == [] and st.touched_since(mark - 1) == ["2024-01-06"] and st.commits == mark
        assert st.touched_since(0) == ["2024-01-01", "2024-01-02", "2024-01-06"]
    assert old.count() == len(before[0])
    replay = batch_of(spark, [message(100 * i + k, T0 + (k % 2) * DAY + (100 * i + k) * 1000) for i in range(6) for k in range(10)])
    ING.ingest_batch(replay, staging, letters, 7)
    assert staging.read().count() == len(before[0]) and compact(staging) == 0


def test_bins_fill_up_by_size():
    entry = lambda i, size: Entry(1, 1, "d", f"f{i:03d}", 1, size, 0, 0)
    sizes = [49, 45, 40, 30, 30, 20, 10, 5, 5, 3, 60, 100]
    packed = bins([entry(i, s) for i, s in enumerate(sizes)], 100)
    assert all(sum(e.bytes for e in own) <= 100 and len(own) > 1 for own in packed)
    assert {e.bytes for own in packed for e in own} == {s for s in sizes if s < 50}
    assert sum(len(own) for own in packed) == 10 and len(packed) == 3
    assert bins([entry(0, 1)], 100) == []


def test_stream_compacts_between_batches(spark):
    from barline.plans.registry import QUERIES, message_files
    sf = "/root/testdata/sf0.001"
    src, base = message_files(spark, sf), work_path(spark, "manifest-stream")
    opened = []
    ING.drain(spark, src, f"{base}/ck", f"{base}/staging", f"{base}/dlq", source_options={"maxFilesPerTrigger": "1"},
              ingested_at="timestamp", compact_every=2, after_batch=lambda b, files: opened.append((b, files)))
    staging, letters = tables(spark, base)
    assert [b for b, _ in opened] == [0, 1, 2, 3] and opened[0][1] == {"staging": [], "dead_letters": []}
    assert all(len(staging.entries([d])) == 1 for d in staging.live) and len(letters.entries()) == 1
    want = QUERIES["s04_micro_batch_ingest"](spark, sf)
    assert staging.read().select("id").exceptAll(want.select("id")).count() == 0 and staging.row_count() == want.count()


def test_empty_table(spark):
    table = FileTable(spark, work_path(spark, "manifest-empty"), ING.STAGING, "timestamp_ms", "candle_date")
    assert table.read().count() == 0 and table.read().columns == ING.STAGING.names and compact(table) == 0
    assert table.append(table.read(), 0) == [] and table.commits == 0 and unreferenced(table).count() == 0


def test_dead_letters_to_a_sink_by_format(spark):
    base = work_path(spark, "manifest-sink")
    staging, letters = tables(spark, base)
    ING.ingest_batch(batch_of(spark, [message(0, 0, text="{bad")]), staging, letters, 0, dead_letter_format="parquet",
                     dead_letter_options={"path": f"{base}/sink"})
    got = spark.read.parquet(f"{base}/sink").select("value", F.col("headers")[0]["key"].alias("h")).collect()
    assert [(bytes(r["value"]), r["h"]) for r in got] == [(b"{bad", "error_reason")]
