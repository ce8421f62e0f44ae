"""A table as a list of its files (S04, S06, T01): what each file holds, who wrote it.

A table lives in ``root/files`` and its manifest in ``root/manifest``, a small
append-only JSON table with one row per file: the part (candle date), rows,
bytes, the range of one key column, and the batch that added it. A commit is one
manifest file, put in place by one rename, so it is seen whole or not at all; files
that no commit names (of a batch that failed half-way) are never read.

* A batch opens by name just the files whose part and key range it reaches into.
  No folder is listed, and files of other dates or times are not touched, so a
  batch's cost does not grow with history.
* ``compact`` packs the small files of a part into few and swaps them in with one
  commit; readers see the old files or the new ones, never both.
* ``touched_since`` is the ledger of the daily run: the parts to which batches
  committed after a mark, whatever time their rows carry.

One writer at a time (the ingest query). It holds the list of live files in the
driver: metadata, about 200 bytes a file, bounded by compaction.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

from barline.sources.tables import by_partition

LOG_SCHEMA = ("op string, touched long, batch_id long, part string, file string, rows long, bytes long, "
              "min_key long, max_key long")
#: Files are packed up to this size; those of at least half of it are left alone.
TARGET_BYTES = 256 << 20


@dataclass(frozen=True)
class Entry:
    """A live file. ``touched``: the commit that last brought rows into it."""
    touched: int
    batch_id: int
    part: str | None
    file: str
    rows: int
    bytes: int
    min_key: int | None
    max_key: int | None


def read_if_any(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame | None:
    """The Parquet folder, or None where nothing has been written yet."""
    try:
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.parquet(path)
    except AnalysisException as exc:  # anything else is an error
        if exc.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


class FileTable:
    """A table whose files are named by a manifest.

    ``schema`` is that of the data, with ``part_column`` (the files' folder, may be
    None) and ``key_column`` (a long, whose range each file's row keeps).
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key_column: str,
                 part_column: str | None = None):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.key_column, self.part_column = key_column, part_column
        self.live: dict[str | None, dict[str, Entry]] = {}
        self.generation, self.commits = 0, 0
        self._load()

    # ---- manifest
    def _load(self) -> None:
        try:
            log = self.spark.read.schema(f"{LOG_SCHEMA}, generation long").json(f"{self.root}/manifest")
        except AnalysisException as exc:  # nothing committed yet
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
            return
        every = log.collect()
        if not every:
            return
        newest = max(r["generation"] for r in every)
        rows = [r for r in every if r["generation"] == newest]
        gone = {r["file"] for r in rows if r["op"] == "drop"}
        for r in rows:
            self.generation, self.commits = r["generation"], max(self.commits, r["touched"])
            if r["op"] == "add" and r["file"] not in gone:
                self._hold(Entry(*(r[c] for c in Entry.__dataclass_fields__)))

    def _hold(self, entry: Entry) -> None:
        self.live.setdefault(entry.part, {})[entry.file] = entry

    def _log(self, rows: list[tuple], generation: int) -> None:
        """One more file in the manifest: a commit. Written aside, then renamed."""
        names = [x.split()[0] for x in LOG_SCHEMA.split(", ")]
        text = "".join(json.dumps(dict(zip(names, r, strict=True))) + "\n" for r in rows)
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        folder = jvm.org.apache.hadoop.fs.Path(f"{self.root}/manifest/generation={generation}")
        aside = jvm.org.apache.hadoop.fs.Path(folder, f".{uuid.uuid4().hex}.tmp")
        fs = folder.getFileSystem(conf)
        out = fs.create(aside)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if not fs.rename(aside, jvm.org.apache.hadoop.fs.Path(folder, f"{uuid.uuid4().hex}.json")):
            raise RuntimeError(f"commit to {folder} failed")

    @staticmethod
    def _row(op: str, e: Entry) -> tuple:
        return op, *(getattr(e, c) for c in Entry.__dataclass_fields__)

    def commit(self, added: Iterable[Entry], dropped: Iterable[Entry] = ()) -> None:
        """Add and drop files at once, for readers that load the manifest from now on."""
        added, dropped = list(added), list(dropped)
        if not added and not dropped:
            return
        self._log([self._row("add", e) for e in added] + [self._row("drop", e) for e in dropped], self.generation)
        for e in dropped:
            del self.live[e.part][e.file]
        for e in added:
            self._hold(e)
        self.commits = max([self.commits, *(e.touched for e in added)])

    def fold(self) -> None:
        """Write the live files as one manifest file of a new generation; earlier ones are not read again."""
        rows = [self._row("add", e) for e in self.entries()]
        rows.append(("mark", self.commits, None, None, None, None, None, None, None))
        self._log(rows, self.generation + 1)
        self.generation += 1

    # ---- what the manifest answers without reading data
    def entries(self, parts: Iterable[str | None] | None = None) -> list[Entry]:
        chosen = self.live.values() if parts is None else (self.live.get(p, {}) for p in parts)
        return [e for files in chosen for e in files.values()]

    def row_count(self) -> int:
        return sum(e.rows for e in self.entries())

    def overlapping(self, spans: Mapping[str | None, tuple[int, int]]) -> list[Entry]:
        """The files of the given parts whose key range meets the part's (low, high)."""
        return [e for part, (low, high) in spans.items() for e in self.live.get(part, {}).values()
                if e.min_key is None or (e.min_key <= high and e.max_key >= low)]

    def touched_since(self, mark: int) -> list[str | None]:
        """The parts that commits after ``mark`` brought rows to, in order."""
        return sorted((p for p, files in self.live.items() if any(e.touched > mark for e in files.values())),
                      key=lambda p: p or "")

    # ---- data
    def read(self, entries: Iterable[Entry] | None = None) -> DataFrame:
        """The rows of the given files (all live ones by default), opened by name."""
        files = [f"{self.root}/files/{e.file}" for e in (self.entries() if entries is None else entries)]
        if not files:
            return self.spark.createDataFrame([], self.schema)
        found = self.spark.read.schema(self.schema).option("basePath", f"{self.root}/files").parquet(*files)
        return found.select(*self.schema.names)

    def write(self, df: DataFrame, batch_id: int, one_task: bool = False) -> list[Entry]:
        """Write ``df`` as new files that no reader sees before they are committed.

        Each write has a folder of its own; only that folder is read back, for the
        files' rows and key ranges (from the key column alone).
        """
        folder = f"{self.root}/files/batch={self.commits + 1}-{uuid.uuid4().hex[:12]}"
        rows = df.select(*self.schema.names)
        w = (by_partition(rows, [self.part_column]) if self.part_column and not one_task else rows).write
        if self.part_column:
            w = w.partitionBy(self.part_column)
        w.parquet(folder)
        # one batch's folder: its files' names come with the rows
        back = self.spark.read.schema(self.schema).option("basePath", f"{self.root}/files").parquet(folder)
        part = F.col(self.part_column).cast("string") if self.part_column else F.lit(None).cast("string")
        key = F.col(self.key_column)
        name = F.substring_index(F.col("_metadata.file_path"), "/files/", -1)
        found = back.groupBy(part.alias("part"), name.alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(
            F.count(F.lit(1)).alias("rows"), F.min(key).alias("low"), F.max(key).alias("high")).collect()
        return [Entry(self.commits + 1, batch_id, r["part"], r["file"], r["rows"], r["bytes"], r["low"], r["high"]) for r in found]

    def append(self, df: DataFrame, batch_id: int) -> list[Entry]:
        added = self.write(df, batch_id)
        self.commit(added)
        return added


def bins(entries: Iterable[Entry], target_bytes: int) -> list[list[Entry]]:
    """Small files of one part packed by size, largest first, each into the first
    bin with room; bins of one file are left out. At most one bin stays under half full."""
    small = sorted((e for e in entries if e.bytes < target_bytes // 2), key=lambda e: (-e.bytes, e.file))
    packed: list[tuple[int, list[Entry]]] = []
    for e in small:
        for k, (size, own) in enumerate(packed):
            if size + e.bytes <= target_bytes:
                packed[k] = (size + e.bytes, [*own, e])
                break
        else:
            packed.append((e.bytes, [e]))
    return [own for _, own in packed if len(own) > 1]


def compact(table: FileTable, target_bytes: int = TARGET_BYTES) -> int:
    """Pack the small files of every part, swap them in with one commit and fold
    the manifest; returns the number of files replaced.

    Rows, and the marks by which the daily run finds touched parts, stay the same.
    Replaced files stay on disk, unread (see ``unreferenced``), for readers that
    loaded the manifest before.
    """
    plan = [(part, own) for part, files in table.live.items() for own in bins(files.values(), target_bytes)]
    if not plan:
        return 0
    spark = table.spark
    chosen = [e for _, own in plan for e in own]
    places = spark.createDataFrame([(e.file, k) for k, (_, own) in enumerate(plan) for e in own], "_file string, _bin long")
    files = [f"{table.root}/files/{e.file}" for e in chosen]
    rows = spark.read.schema(table.schema).option("basePath", f"{table.root}/files").parquet(*files)
    rows = rows.withColumn("_file", F.substring_index(F.col("_metadata.file_path"), "/files/", -1)).join(places, "_file")
    packed = rows.repartition(len(plan), "_bin").sortWithinPartitions("_bin", table.key_column)
    last = {part: (max(e.touched for e in own), max(e.batch_id for e in own)) for part in {p for p, _ in plan}
            for own in [[e for p, group in plan if p == part for e in group]]}
    made = table.write(packed, -1, one_task=True)
    table.commit([Entry(*last[e.part], e.part, e.file, e.rows, e.bytes, e.min_key, e.max_key) for e in made], chosen)
    table.fold()
    return len(chosen)


def unreferenced(table: FileTable) -> DataFrame:
    """Paths under ``files`` that no live entry names: leftovers of failed batches and of compaction."""
    spark = table.spark
    found = read_if_any(spark, f"{table.root}/files", table.schema)
    if found is None:
        return spark.createDataFrame([], "file string")
    every = found.select(F.substring_index(F.col("_metadata.file_path"), "/files/", -1).alias("file")).distinct()
    live = spark.createDataFrame([(e.file,) for e in table.entries()], "file string")
    return every.join(live, "file", "left_anti")
