"""Message stream -> staging table + dead-letter table, one micro-batch at a time.

One Structured Streaming query (T01): ``readStream`` of the message envelope
(Kafka in production, a file source in tests), ``foreachBatch`` that

1. drops tombstones (S03),
2. decodes and validates every message in one projection (S05),
3. appends the new candles to the staging table with insert-ignore (S07:
   dedupe inside the batch, anti-join against the table), and
4. appends the rejects to the dead-letter table (S06), again anti-joined on
   ``(topic, partition, offset)``.

Both tables are lists of files (:mod:`barline.streaming.manifest`). A batch opens
by name the staging files of its dates whose times it reaches into, and the
dead-letter files whose offsets it reaches into; nothing is listed, so a batch
costs the same whatever came before. ``compact_every`` packs small files between
batches.

Offsets are committed by the checkpoint only after ``foreachBatch`` returns,
so a failed batch is re-run after restart (T03) and a replayed batch adds
nothing (both writes are idempotent): at-least-once delivery, exactly-once
table contents. ``trigger="availableNow"`` is the bounded drain (T02); a
processing-time trigger the continuous consumer; the source's own option
(``maxOffsetsPerTrigger`` / ``maxFilesPerTrigger``) caps a batch.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barline.operators.dedupe import anti_join, new_rows, update_marks
from barline.schemas import CANDLE_KEY, DEAD_LETTER, MESSAGE_ENVELOPE, RAW_OHLCV
from barline.sources.messages import dead_letters, message_id, parse_messages, to_raw_rows, valid_records
from barline.streaming.manifest import TARGET_BYTES, FileTable, compact

PARTITION_COLUMN = "candle_date"
DLQ_KEY = ("topic", "partition", "offset")
STAGING = T.StructType([*RAW_OHLCV.fields, T.StructField(PARTITION_COLUMN, T.DateType())])

# The consumer flushes a batch at 500 records or every 5 seconds.
BATCH_RECORDS = 500
FLUSH_INTERVAL = "5 seconds"


def staging_table(spark: SparkSession, path: str) -> FileTable:
    """The staged candles: one part a candle date, files with the range of their times."""
    return FileTable(spark, path, STAGING, "timestamp_ms", PARTITION_COLUMN)


def dead_letter_table(spark: SparkSession, path: str) -> FileTable:
    """The rejected messages: files with the range of their offsets."""
    return FileTable(spark, path, DEAD_LETTER, "offset")


def read_staging(spark: SparkSession, path: str) -> DataFrame:
    return staging_table(spark, path).read()


def read_dead_letters(spark: SparkSession, path: str) -> DataFrame:
    return dead_letter_table(spark, path).read()


def drop_tombstones(envelope: DataFrame) -> DataFrame:
    """A NULL value is a tombstone, not a message."""
    return envelope.filter(F.col("value").isNotNull())


def _spans(parsed: DataFrame) -> tuple[dict, tuple[int, int] | None]:
    """The batch's candle dates with their range of times, and the rejects' range of offsets:
    one aggregation (a row a date), which also fills the batch's cache."""
    good = F.col("reason").isNull()
    day = F.when(good, F.to_date(F.timestamp_millis("timestamp_ms")))
    key = F.when(good, F.col("timestamp_ms")).otherwise(F.col("offset"))
    rows = parsed.groupBy(good.alias("good"), day.cast("string").alias("day")).agg(
        F.min(key).alias("low"), F.max(key).alias("high")).collect()
    dates = {r["day"]: (r["low"], r["high"]) for r in rows if r["good"]}
    return dates, next(((r["low"], r["high"]) for r in rows if not r["good"]), None)


def ingest_batch(batch: DataFrame, staging: FileTable, letters: FileTable, batch_id: int = 0,
                 ingested_at: str | None = None, dead_letter_format: str | None = None,
                 dead_letter_options: Mapping[str, str] | None = None,
                 marks_path: str | None = None) -> dict[str, list[str]]:
    """Process one micro-batch (S04 body): two idempotent appends.

    With ``dead_letter_format`` (any Spark sink, e.g. ``kafka``) the rejects also go
    there as ``key, value, headers``, once for each try of the batch. ``marks_path``
    keeps the high-water marks by symbol. Returns the files that were opened, by table.
    """
    # Both outputs read the same parse: cache it for the life of the batch.
    parsed = parse_messages(drop_tombstones(batch)).persist()
    opened: dict[str, list[str]] = {"staging": [], "dead_letters": []}
    try:
        dates, offsets = _spans(parsed)
        if dates:
            ing = F.col(ingested_at).cast("timestamp") if ingested_at else F.current_timestamp()
            rows = to_raw_rows(valid_records(parsed), message_id(), ing)
            rows = rows.withColumn(PARTITION_COLUMN, F.to_date(F.timestamp_millis("timestamp_ms")))
            near = staging.overlapping(dates)
            opened["staging"] = [e.file for e in near]
            fresh = new_rows(rows, staging.read(near) if near else None, CANDLE_KEY, ("timestamp_ms", "id"))
            staging.append(fresh, batch_id)
            if marks_path:
                update_marks(batch.sparkSession, marks_path, rows)
        if offsets:
            rejects = dead_letters(parsed, (*DLQ_KEY, "timestamp"))
            if dead_letter_format:
                (rejects.select("key", "value", "headers").write.format(dead_letter_format)
                 .options(**dict(dead_letter_options or {})).mode("append").save())
            near = letters.overlapping({None: offsets})
            opened["dead_letters"] = [e.file for e in near]
            letters.append(anti_join(rejects, letters.read(near), DLQ_KEY) if near else rejects, batch_id)
    finally:
        parsed.unpersist()
    return opened


def start_ingest(spark: SparkSession, source: str, checkpoint: str, staging_path: str,
                 dlq_path: str, source_format: str = "parquet",
                 source_options: dict | None = None, trigger: str = "availableNow",
                 ingested_at: str | None = None, before_batch: Callable[[int], None] | None = None,
                 compact_every: int | None = None, target_bytes: int = TARGET_BYTES,
                 after_batch: Callable[[int, dict], None] | None = None,
                 dead_letter_format: str | None = None, dead_letter_options: Mapping[str, str] | None = None,
                 marks_path: str | None = None):
    """Start the ingest query (T01/T02). ``source`` is a path for file formats,
    ignored for ``kafka`` (give ``subscribe``/``kafka.bootstrap.servers`` and
    ``startingOffsets=earliest`` in ``source_options``).

    ``before_batch`` is called on the driver with each batch's id; an error it
    raises stops the query before the batch is written, as any failed batch does.
    ``after_batch`` gets the batch's id and the files it opened. Every
    ``compact_every`` batches small files of both tables are packed.
    """
    staging, letters = staging_table(spark, staging_path), dead_letter_table(spark, dlq_path)
    reader = spark.readStream.format(source_format).options(**dict(source_options or {}))
    if source_format != "kafka":
        reader = reader.schema(MESSAGE_ENVELOPE)
        stream = reader.load(source)
    else:
        stream = reader.load()

    def run_batch(df: DataFrame, batch_id: int) -> None:
        if before_batch is not None:
            before_batch(batch_id)
        opened = ingest_batch(df, staging, letters, batch_id, ingested_at, dead_letter_format, dead_letter_options, marks_path)
        if compact_every and batch_id % compact_every == compact_every - 1:
            for table in (staging, letters):
                compact(table, target_bytes)
        if after_batch is not None:
            after_batch(batch_id, opened)

    w = stream.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    if trigger == "availableNow":
        w = w.trigger(availableNow=True)
    else:
        w = w.trigger(processingTime=trigger)
    return w.start()


def drain(spark: SparkSession, source: str, checkpoint: str, staging_path: str, dlq_path: str,
          **kw) -> None:
    """Run the query until everything available is processed, then stop."""
    q = start_ingest(spark, source, checkpoint, staging_path, dlq_path, trigger="availableNow", **kw)
    q.awaitTermination()


def start_consumer(spark: SparkSession, staging_path: str, dlq_path: str, checkpoint: str,
                   source_format: str = "kafka", source: str = "",
                   source_options: dict | None = None, records_per_batch: int = BATCH_RECORDS,
                   interval: str = FLUSH_INTERVAL, ingested_at: str | None = None, **kw):
    """T01 as the always-on consumer. For Kafka a micro-batch starts as soon as
    ``records_per_batch`` records wait or ``interval`` has passed, and the next
    one follows at once, with no maximum (a caller may set one in
    ``source_options``). A file source is polled every ``interval``. For Kafka pass
    ``kafka.bootstrap.servers`` and ``subscribe`` in ``source_options``;
    reading starts from the earliest offsets, as the reference's consumer."""
    opts = dict(source_options or {})
    if source_format == "kafka":
        opts.setdefault("startingOffsets", "earliest")
        opts.setdefault("minOffsetsPerTrigger", str(records_per_batch))
        opts.setdefault("maxTriggerDelay", interval.replace(" seconds", "s").replace(" second", "s"))
        interval = "0 seconds"
    return start_ingest(spark, source, checkpoint, staging_path, dlq_path, source_format, opts,
                        trigger=interval, ingested_at=ingested_at, **kw)
