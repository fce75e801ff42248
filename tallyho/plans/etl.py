"""Extract -> transform -> load jobs (K6, K7) and chunk fan-out / fan-in.

Stages hand over *paths* (K6, K8) or lazy DataFrames (K7).  Every stage of K6 publishes a
version of its output (``sinks.versions``), so a stage that fails midway leaves the previous one
readable, and the stored hand-over cuts lineage between stages.  The fan-out of K8 commits its chunks
to a ledger, so a rerun does only what is missing.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.operators.chunks import chunk_partials, merge_partials
from tallyho.operators.summary import sort_stations, summary_decimal, summary_double, text_lines
from tallyho.sinks.files import write_lines, write_parquet
from tallyho.schema import CHUNK_ID, LINE_INDEX, MEASURE_DECIMAL
from tallyho.sinks import versions
from tallyho.sources.lines import open_lines, with_chunk_id, with_line_index
from tallyho.sources.parquet import read_parquet, summary_sql_view
from tallyho.sources.text import parse_measure_lines, scan_text_decimal, scan_text_double, scan_text_inferred


def _missing_to_fnf(path: str, read):
    """Run a stage's read; a missing input stops it with ``FileNotFoundError``.

    Spark raises ``PATH_NOT_FOUND`` while resolving the read (file listing, no
    data), on any file system; the listing is the one the stage needs anyway.
    """
    try:
        return read()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(f"input not found: {path}") from e
        raise


# ------------------------------------------------------------------ K6
SCANS = {"decimal": scan_text_decimal, "double": scan_text_double, "inferred": scan_text_inferred}
SUMMARIES = {"decimal": summary_decimal, "double": summary_double, "inferred": summary_double}


def extract(spark: SparkSession, text_path: str, out_path: str, kind: str = "decimal") -> str:
    """Text measurements -> raw rows as a parquet folder (K2); returns the new version's folder."""
    raw = _missing_to_fnf(text_path, lambda: SCANS[kind](spark, text_path))
    return versions.publish(spark, out_path, lambda folder: write_parquet(raw, folder))


def transform(spark: SparkSession, in_path: str, out_path: str, kind: str = "decimal") -> str:
    """Raw parquet rows -> sorted summary parquet (``kind`` double: with the raw mean)."""
    raw = _missing_to_fnf(in_path, lambda: read_parquet(spark, in_path))
    return versions.publish(spark, out_path, lambda folder: write_parquet(SUMMARIES[kind](raw), folder))


def load(spark: SparkSession, in_path: str, out_path: str, single_file: bool = False) -> str:
    """Publish the summary to its final location, sorted again."""
    summ = _missing_to_fnf(in_path, lambda: read_parquet(spark, in_path))
    return versions.publish(spark, out_path, lambda folder: write_parquet(
        summ if single_file else sort_stations(summ), folder, single_file=single_file))


def staged_etl(spark: SparkSession, text_path: str, work_dir: str, kind: str = "decimal",
               single_file: bool = False) -> str:
    """K6: extract -> transform -> load with stored hand-over; returns the final version's folder.

    Each stage reads the version that the one before it has just published.  Versions that are
    replaced stay until ``remove_replaced``; ``versions.current`` finds the newest summary."""
    raw = extract(spark, text_path, f"{work_dir}/extracted", kind)
    summ = transform(spark, raw, f"{work_dir}/transformed", kind)
    return load(spark, summ, f"{work_dir}/summary", single_file)


def remove_replaced(spark: SparkSession, work_dir: str, keep: int = 1) -> dict[str, list[str]]:
    """Delete the versions of each stage that no pointer needs; returns their names."""
    return {stage: versions.remove_unused(spark, f"{work_dir}/{stage}", keep) for stage in ("extracted", "transformed", "summary")
            if versions.published(spark, f"{work_dir}/{stage}")}


# ------------------------------------------------------------------ K7
def chained_etl(spark: SparkSession, text_path: str, out_path: str, output: str = "parquet",
                single_file: bool = False) -> str:
    """K7: the same three stages handing over lazy DataFrames (one Spark job).

    Extract is a scan, transform is SQL over it, load is the write (parquet, or
    ``station: min/mean/max`` lines); nothing is materialised between them.
    """
    rows = _missing_to_fnf(text_path, lambda: scan_text_decimal(spark, text_path))
    summ = summary_sql_view(spark, rows)
    if output == "text":
        return write_lines(text_lines(summ), "value", out_path, single_file=single_file)
    if output != "parquet":
        raise ValueError(f"unknown output {output!r}")
    return write_parquet(summ, out_path, single_file=single_file)


# ------------------------------------------------------------------ K8 / A8
CHUNK_ROWS = 100_000_000


def write_chunk_partials(spark: SparkSession, text_path: str, chunk_rows: int, partials_dir: str) -> str:
    """Fan-out: chunk the text by row ranges, aggregate each chunk, store the partials.

    ``chunk_id`` is a column; the number of files follows the shuffle, not the
    number of chunks."""
    scan = _missing_to_fnf(text_path, lambda: scan_text_decimal(spark, text_path))
    chunk_partials(with_chunk_id(with_line_index(scan), chunk_rows)).write.mode("overwrite").parquet(partials_dir)
    return partials_dir


def merge_partial_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Fan-in: read a folder of partials, or exactly the given files, and merge them."""
    if not paths:
        raise ValueError("no partial files to merge")
    return merge_partials(read_parquet(spark, *paths))


def partial_files_merge(spark: SparkSession, text_path: str, work_dir: str, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """K8: chunks -> partials of each -> merge, as one Spark application."""
    return merge_partial_files(spark, write_chunk_partials(spark, text_path, chunk_rows, f"{work_dir}/partials"))


# ------------------------------------------------------------------ K8, recoverable
WAVE_CHUNKS = 64                   # chunks of a wave, which are committed together
_LEDGER = "chunk_id bigint, n_lines bigint, run string"


def ledger(spark: SparkSession, work_dir: str) -> DataFrame:
    """``chunk_id, n_lines, run`` of every committed chunk."""
    if not versions.names(spark, f"{work_dir}/ledger"):
        return spark.createDataFrame([], _LEDGER)
    return spark.read.schema(_LEDGER).parquet(f"{work_dir}/ledger/*")


def fan_out(spark: SparkSession, text_path: str, chunk_rows: int, work_dir: str, wave: int = WAVE_CHUNKS,
            waves: int | None = None) -> int:
    """Aggregate chunks of ``chunk_rows`` lines and store their partials; returns how many chunks this run did.

    Chunks go in waves of ``wave``: a wave's partials are written to a folder of its own, then its
    chunks enter the ledger (one folder, put in place by one rename).  A rerun takes the chunks that should
    exist, without those of the ledger, so work that was committed is never done again and a wave that broke off leaves
    nothing that counts.  Lines are stored once below ``work_dir`` (a changed input raises), and a wave
    reads the blocks of its own lines only.  ``waves`` ends the run early."""
    stored = _missing_to_fnf(text_path, lambda: open_lines(spark, text_path, f"{work_dir}/lines"))
    settings = f"{work_dir}/chunk-rows-{chunk_rows}"
    if not versions.names(spark, f"{work_dir}/ledger"):
        versions.remove(spark, settings)
        versions.create_empty(spark, settings)
    elif f"chunk-rows-{chunk_rows}" not in versions.names(spark, work_dir):
        raise ValueError(f"the chunks committed below {work_dir} have another length")
    expected = spark.range(-(-stored.total // chunk_rows)).withColumnRenamed("id", CHUNK_ID)
    missing = expected.join(ledger(spark, work_dir), CHUNK_ID, "left_anti").orderBy(CHUNK_ID)
    done = 0
    while waves is None or waves > 0:
        chunks = [r[CHUNK_ID] for r in missing.limit(wave).collect()]
        if not chunks:
            break
        _commit_wave(spark, stored, chunks, chunk_rows, work_dir)
        missing = expected.join(ledger(spark, work_dir), CHUNK_ID, "left_anti").orderBy(CHUNK_ID)
        done += len(chunks)
        waves = None if waves is None else waves - 1
    return done


def _commit_wave(spark: SparkSession, stored, chunks: list[int], chunk_rows: int, work_dir: str) -> None:
    run = uuid.uuid4().hex
    lines = stored.between(chunks[0] * chunk_rows, (chunks[-1] + 1) * chunk_rows)
    own = with_chunk_id(lines, chunk_rows).where(F.col(CHUNK_ID).isin(chunks))
    rows = parse_measure_lines(own, MEASURE_DECIMAL.simpleString(), CHUNK_ID)
    chunk_partials(rows).write.parquet(f"{work_dir}/partials/{run}")
    committed = spark.createDataFrame([(c, min(chunk_rows, stored.total - c * chunk_rows), run) for c in chunks], _LEDGER)
    committed.coalesce(1).write.parquet(f"{work_dir}/pending/{run}")
    versions.move(spark, f"{work_dir}/pending/{run}", f"{work_dir}/ledger/{run}")


def committed_partials(spark: SparkSession, work_dir: str) -> DataFrame:
    """Partials of the chunks in the ledger; folders of waves that broke off are never read."""
    runs = [r["run"] for r in ledger(spark, work_dir).select("run").distinct().collect()]
    if not runs:
        raise ValueError("no partial files to merge")
    return read_parquet(spark, *[f"{work_dir}/partials/{run}" for run in runs])


def merge_committed(spark: SparkSession, work_dir: str) -> DataFrame:
    """Fan-in of a finished fan-out."""
    return merge_partials(committed_partials(spark, work_dir))
