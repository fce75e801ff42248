"""File sinks.  Every writer overwrites its target, so stages are re-runnable."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.schema import MEASURE, STATION


def measurement_line(station, measure):
    """``station;measure`` text; a station containing ``;`` or ``"`` is quoted with
    inner quotes doubled (what the scans read back); NULL station -> empty field."""
    st = F.col(station) if isinstance(station, str) else station
    needs_quotes = st.contains(";") | st.contains('"')
    quoted = F.concat(F.lit('"'), F.replace(st, F.lit('"'), F.lit('""')), F.lit('"'))
    name = F.coalesce(F.when(needs_quotes, quoted).otherwise(st), F.lit(""))
    m = F.col(measure) if isinstance(measure, str) else measure
    return F.concat(name, F.lit(";"), F.coalesce(m.cast("string"), F.lit("")))


def write_measurement_text(df: DataFrame, path: str, order_by: str | None = None,
                           files: int | None = None) -> str:
    """Write ``station;measure`` lines with the plain text writer.

    ``order_by`` range-partitions and sorts first, so part files (in name order)
    hold the lines in that order; ``files`` sets how many part files (a
    shuffle; leave it unset to write one file per task).
    """
    line = measurement_line(STATION, MEASURE).alias("value")
    if order_by is not None:
        src = df.select(line, F.col(order_by).alias("_o"))
        if files:
            src = src.repartitionByRange(files, "_o").sortWithinPartitions("_o")
        else:
            src = src.orderBy("_o")
        out = src.select("value")
    else:
        out = df.select(line)
        if files:
            out = out.repartition(files)
    out.write.mode("overwrite").text(path)
    return path


def _one_sorted(df: DataFrame, order_by: str | None) -> DataFrame:
    """All rows in one task, sorted there; the work before it stays parallel."""
    one = df.repartition(1)
    return one if order_by is None else one.sortWithinPartitions(F.col(order_by).asc_nulls_last())


def write_parquet(df: DataFrame, path: str, single_file: bool = False, order_by: str | None = STATION) -> str:
    """K1/K2: overwrite a parquet folder.

    Part files are written in parallel; those of a sorted frame are sorted in name
    order.  ``single_file`` gathers the rows in one file, sorted by ``order_by``: for small
    results that some reader needs as one file."""
    (_one_sorted(df, order_by) if single_file else df).write.mode("overwrite").parquet(path)
    return path


def write_lines(df: DataFrame, column: str, path: str, single_file: bool = False, order_by: str | None = STATION) -> str:
    """K4/K5: one text line per row from a string column; files as in ``write_parquet``."""
    out = _one_sorted(df, order_by) if single_file else df
    out.select(F.col(column).alias("value")).write.mode("overwrite").text(path)
    return path
