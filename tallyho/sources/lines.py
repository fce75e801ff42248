"""X1 global line index over text files, and the scans built on it.

Line order exists only through the files: files in path order, lines in file
order.  Spark packs splits into tasks by size, so task order is not file order.
The index is therefore built per split ("block"):

1. tag every row with its file, block start and ``monotonically_increasing_id``
   (contiguous inside one task, and one block is read by one task) and store the
   tagged rows as parquet: splits are planned once, so nothing that changes later
   (settings, executors, retries) matters;
2. aggregate the stored rows per block: row count and first id -> a table with
   one row per file split;
3. a distributed exclusive running sum of counts over that block table gives
   each block's offset;
4. join the stored rows with it on (file hash, block start): broadcast when the
   block count is under ``MAX_BROADCAST_BLOCKS`` (checked on the stored table), else a
   shuffle join.  A row without an offset, or outside its block, raises.

No UDF, no single-partition ``row_number`` over the data.  ``with_line_index`` does that for one scan;
``StoredLines`` keeps the result for later calls: raw lines, so that positions and any
types (given or inferred) come from one stored pass, with a manifest of the files that it was made of.
``prefix_lines`` needs no store: it counts lines, whole files first, and reads only the files that
the prefix touches.
"""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyho.functions.stats import int_div
from tallyho.operators.indexing import exclusive_prefix_sum
from tallyho.schema import CHUNK_ID, LINE_INDEX
from tallyho.session import fresh_dir
from tallyho.sinks import versions

# One row of the block table is ~32 bytes once broadcast; 2M blocks is
# 256 TB of input at 128 MB splits.
MAX_BROADCAST_BLOCKS = 2_000_000


def _tag(scan: DataFrame) -> DataFrame:
    cols = scan.columns
    return scan.select(
        *cols,
        F.xxhash64(F.col("_metadata.file_path")).alias("_fh"),
        F.col("_metadata.file_path").alias("_fp"),
        F.col("_metadata.file_block_start").alias("_fb"),
        F.monotonically_increasing_id().alias("_mid"),
    )


def stored_rows(scan: DataFrame) -> DataFrame:
    """The scan's tagged rows, written once and read back."""
    path = fresh_dir(scan.sparkSession, "line-index")
    tagged = _tag(scan)
    tagged.write.parquet(path)
    return scan.sparkSession.read.schema(tagged.schema).parquet(path)


def block_offsets(stored: DataFrame, *more: str) -> DataFrame:
    """One row per file split: ``_fh, _fb, _first, _offset, _n`` (and ``more`` of ``_fp``)."""
    blocks = stored.groupBy("_fp", "_fh", "_fb").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    # One row per input split; the running sum over it is itself distributed.
    # The prefix sum checkpoints the sorted block table itself, so its result is
    # a cheap, stable function of stored data (no second checkpoint needed).
    offsets = exclusive_prefix_sum(blocks, ["_fp", "_fb"], "_n", "_offset")
    return offsets.select("_fh", "_fb", "_first", "_offset", "_n", *more)


def place_rows(stored: DataFrame, offsets: DataFrame, columns: list[str], broadcast: bool) -> DataFrame:
    """``columns`` and the line index; raises where the offsets don't fit the rows."""
    joined = stored.join(F.broadcast(offsets) if broadcast else offsets, ["_fh", "_fb"], "left")
    within = F.col("_mid") - F.col("_first")
    wrong = F.raise_error(F.concat(F.lit("line index: no offset for a row of "), F.col("_fp"))).cast("bigint")
    index = F.when((within >= 0) & (within < F.col("_n")), F.col("_offset") + within).otherwise(wrong)
    return joined.select(*columns, index.alias(LINE_INDEX))


def line_index_with_total(scan: DataFrame) -> tuple[DataFrame, int]:
    """X1 plus the total row count, read from the per-split table (no extra pass)."""
    stored = stored_rows(scan)
    offsets = block_offsets(stored)
    stats = offsets.agg(F.count(F.lit(1)).alias("blocks"),
                        F.count_distinct("_fh", "_fb").alias("keys"),
                        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")).first()
    if stats["keys"] != stats["blocks"]:
        # Two file paths with the same 64-bit hash and block start: refuse
        # rather than mix their rows.
        raise RuntimeError("file path hash collision in the line index")
    return (place_rows(stored, offsets, scan.columns, stats["blocks"] <= MAX_BROADCAST_BLOCKS), int(stats["rows"]))


def with_line_index(scan: DataFrame) -> DataFrame:
    """Add ``line_idx`` (0-based position of the row in the input files).

    ``scan`` must be a file scan straight from ``spark.read`` (it needs the
    hidden ``_metadata`` column).
    """
    return line_index_with_total(scan)[0]


def with_chunk_id(indexed: DataFrame, chunk_rows: int) -> DataFrame:
    """Chunk k holds rows ``[k*chunk_rows, (k+1)*chunk_rows)`` exactly."""
    if chunk_rows <= 0:
        raise ValueError("chunk_rows must be positive")
    return indexed.withColumn(CHUNK_ID, int_div(F.col(LINE_INDEX), F.lit(chunk_rows)))


def first_lines(indexed: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` lines (all when ``n`` is None), deterministic."""
    if n is None:
        return indexed
    return indexed.where(F.col(LINE_INDEX) < F.lit(n))


# ------------------------------------------------------------------ S6 without a store
def text_files(spark: SparkSession, path: str) -> list[str]:
    """The files of a text path in path order, as URIs (the order of ``_metadata.file_path``)."""
    return sorted(spark.read.text(path).inputFiles())


def read_text_files(spark: SparkSession, uris: list[str]) -> DataFrame:
    """Exactly these files; characters that Spark's paths take for patterns are escaped."""
    return spark.read.text([re.sub(r"([\\\\*?{}\[\]])", r"\\\1", unquote(u)) for u in uris])


def _line_counts(spark: SparkSession, uris: list[str]) -> dict[str, int]:
    found = (read_text_files(spark, uris).groupBy(F.col("_metadata.file_path").alias("file"))
             .agg(F.count(F.lit(1)).alias("n")).collect())  # a row per file, as the listing itself
    by_path = {_bare(r["file"]): r["n"] for r in found}
    return {u: by_path.get(_bare(u), 0) for u in uris}


def _bare(uri: str) -> str:
    return re.sub(r"^([a-z][a-z0-9+.-]*:)/+", r"\1/", uri)


def prefix_lines(spark: SparkSession, path: str, n: int | None) -> DataFrame:
    """``value`` of the first ``n`` lines in file order (all when ``n`` is None); lazy but for the counts.

    Lines are counted, not parsed: first in one file, then in four times as many, until they
    reach ``n``.  Files behind the prefix are never opened again.  In the file where it
    ends, lines are counted per split, splits behind the end are dropped unparsed, and only the split with the last
    line is numbered (one split, so the window is bounded by ``spark.sql.files.maxPartitionBytes``).
    If the file's splits are planned otherwise when the rows are read, that read raises.
    """
    if n is None:
        return spark.read.text(path)
    if n < 0:
        raise ValueError("the number of lines must not be negative")
    files, counts, batch = text_files(spark, path), {}, 1
    while len(counts) < len(files) and sum(counts.values()) < n:
        counts |= _line_counts(spark, files[len(counts):len(counts) + batch])
        batch *= 4
    whole, before = [], 0
    for uri in files:
        if uri not in counts or before + counts[uri] > n:
            break
        whole.append(uri)
        before += counts[uri]
    nothing = spark.createDataFrame([], "value string")
    head = read_text_files(spark, whole) if whole else nothing
    if before >= n or len(whole) == len(files):
        return head
    # The file in which the prefix ends.
    split = F.struct(F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_block_length").alias("length"))
    last = read_text_files(spark, [files[len(whole)]])
    sizes = sorted(last.groupBy(split.alias("split")).agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["split"]["start"])
    full = []
    for row in sizes:
        if before + row["n"] > n:
            end = row["split"]
            break
        full.append(row["split"])
        before += row["n"]
    tagged = last.select("value", split.alias("split"), F.monotonically_increasing_id().alias("id"))
    planned = spark.createDataFrame([(r["split"]["start"], r["split"]["length"]) for r in sizes], "start long, length long")
    known = tagged.join(F.broadcast(planned.select(F.struct("start", "length").alias("known"))), F.col("split") == F.col("known"), "left")
    changed = F.raise_error(F.lit("prefix: the splits of the file where it ends have changed since they were counted")).cast("long")
    start = F.when(F.col("known").isNotNull(), F.col("split.start")).otherwise(changed)
    complete = known.where(start < end["start"]).select("value") if full else None
    order = Window.partitionBy("split").orderBy("id")
    partly = (tagged.where(F.col("split.start") == end["start"]).withColumn("at", F.row_number().over(order))
              .where(F.col("at") <= n - before).select("value"))
    parts = [x for x in (head if whole else None, complete, partly) if x is not None]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# ------------------------------------------------------------------ X1, stored
class ChangedInput(RuntimeError):
    """The files that stored lines were made of are no longer the same."""


def _listing(spark: SparkSession, path: str) -> DataFrame:
    """``path, length, modificationTime`` of the files (listed, not read)."""
    return spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")


class StoredLines:
    """Lines of a text path, stored once with what their positions are computed from.

    ``open_lines`` makes or reuses one; ``remove`` deletes it.  ``rows`` are raw: parse them with
    ``sources.text.parse_measure_lines`` or ``sources.infer``, which drop no line but empty ones."""

    def __init__(self, spark: SparkSession, folder: str, root: str):
        self.spark, self.folder, self.root = spark, folder, root
        total = spark.read.parquet(f"{folder}/total").first()
        self.total, self.blocks = int(total["lines"]), int(total["blocks"])

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}")

    def rows(self) -> DataFrame:
        """``value, line_idx`` of every line."""
        return place_rows(self._read("rows"), self._read("blocks").drop("_fp"), ["value"], self.blocks <= MAX_BROADCAST_BLOCKS)

    def between(self, start: int, end: int) -> DataFrame:
        """Lines ``start`` to ``end - 1``; of the stored rows, only those of blocks that hold them are
        read (the filter on file and block reaches the parquet scan)."""
        blocks = self._read("blocks")
        own = blocks.where((F.col("_offset") < end) & (F.col("_offset") + F.col("_n") > start))
        place = F.struct("_fp", "_fb")
        edge = own.agg(F.min(place).alias("a"), F.max(place).alias("b")).first()
        if edge["a"] is None:
            return self.rows().where("false")
        fp, fb = F.col("_fp"), F.col("_fb")
        stored = self._read("rows").where((fp > edge["a"]["_fp"]) | ((fp == edge["a"]["_fp"]) & (fb >= edge["a"]["_fb"])))
        stored = stored.where((fp < edge["b"]["_fp"]) | ((fp == edge["b"]["_fp"]) & (fb <= edge["b"]["_fb"])))
        placed = place_rows(stored, blocks.drop("_fp"), ["value"], self.blocks <= MAX_BROADCAST_BLOCKS)
        return placed.where((F.col(LINE_INDEX) >= start) & (F.col(LINE_INDEX) < end))

    def first(self, n: int | None) -> DataFrame:
        """The first ``n`` lines, all when ``n`` is None."""
        if n is not None and n < 0:
            raise ValueError("the number of lines must not be negative")
        return self.rows() if n is None or n >= self.total else self.between(0, n)

    def remove(self) -> None:
        """Delete the stored rows; the input stays."""
        versions.remove(self.spark, self.root)


def _same_files(spark: SparkSession, folder: str, path: str) -> bool:
    before, now = spark.read.parquet(f"{folder}/manifest"), _listing(spark, path)
    return before.exceptAll(now).isEmpty() and now.exceptAll(before).isEmpty()


def open_lines(spark: SparkSession, path: str, store: str, rebuild: bool = False) -> StoredLines:
    """The lines of ``path`` as stored below ``store``; stored now if they aren't yet.

    Files that were changed, added or removed since raise ``ChangedInput``, or are stored anew with
    ``rebuild`` (readers of the previous rows keep them until ``versions.remove_unused``)."""
    try:
        folder = versions.current(spark, store)
    except FileNotFoundError:
        return _store_lines(spark, path, store)
    if _same_files(spark, folder, path):
        return StoredLines(spark, folder, store)
    if not rebuild:
        raise ChangedInput(f"files below {path} have changed since their lines were stored in {store}")
    return _store_lines(spark, path, store)


def _store_lines(spark: SparkSession, path: str, store: str) -> StoredLines:
    def write(folder: str) -> None:
        _listing(spark, path).write.parquet(f"{folder}/manifest")
        _tag(spark.read.text(path)).write.parquet(f"{folder}/rows")
        stored = spark.read.parquet(f"{folder}/rows")
        block_offsets(stored, "_fp").write.parquet(f"{folder}/blocks")
        blocks = spark.read.parquet(f"{folder}/blocks")
        total = blocks.agg(F.count(F.lit(1)).alias("blocks"), F.count_distinct("_fh", "_fb").alias("keys"),
                           F.coalesce(F.sum("_n"), F.lit(0)).alias("lines"))
        total.write.parquet(f"{folder}/total")
        counted = total.first()
        if counted["keys"] != counted["blocks"]:
            raise RuntimeError("file path hash collision in the line index")
        if not _same_files(spark, folder, path):
            raise ChangedInput(f"files below {path} changed while their lines were stored")

    return StoredLines(spark, versions.publish(spark, store, write), store)
