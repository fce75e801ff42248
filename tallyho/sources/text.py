"""Delimited text scans of ``station;measure`` lines (no header, UTF-8).

All scans are lazy and strict (FAILFAST): a malformed line raises once a query
parses the column it breaks.  Spark prunes CSV columns, so a query that never
touches ``measure`` does not parse it; ``row_count`` therefore references it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyho.schema import MEASURE, MEASURE_DECIMAL, STATION

# Fixed reader options shared by every text scan.
CSV_OPTIONS = {
    "sep": ";",
    "header": "false",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
    "encoding": "UTF-8",
}

_RAW_SCHEMA = T.StructType([
    T.StructField(STATION, T.StringType(), True),
    T.StructField(MEASURE, T.StringType(), True),
])


def _reader(spark: SparkSession):
    return spark.read.options(**CSV_OPTIONS)


def _fields(lines: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``_s, _m`` (text) of every line that isn't empty, and carried columns."""
    v = F.col("value")
    # Stage 1: split once; the pieces are referenced several times below, so they
    # are computed in their own projection rather than re-evaluated per use.
    split = lines.where(F.octet_length(v) > 0).select(
        v.alias("_v"),
        F.substring_index(v, ";", 1).alias("_head"),
        F.substring_index(v, ";", -1).alias("_tail"),
        *carry,
    )
    v, head, tail = F.col("_v"), F.col("_head"), F.col("_tail")
    # Exactly one ";" iff head + ";" + tail is the whole line (byte lengths are
    # O(1) on Spark strings; no character counting, no extra scan).
    single_sep = (F.octet_length(head) + F.octet_length(tail) + 1) == F.octet_length(v)
    quoted = v.startswith('"')
    csv = F.from_csv(v, "station STRING, measure STRING",
                     {k: CSV_OPTIONS[k] for k in ("sep", "quote", "escape", "mode")})
    bad = F.raise_error(F.concat(F.lit("malformed measurement line: "), v))
    # Stage 2: quoted lines (rare) through the CSV parser, the rest as split.
    return split.select(
        F.when(quoted, csv.getField(STATION)).when(single_sep, head)
         .otherwise(bad.cast("string")).alias("_s"),
        F.when(quoted, csv.getField(MEASURE)).otherwise(tail).alias("_m"), *carry)


def split_fields(lines: DataFrame, *carry: str) -> DataFrame:
    """``station, measure`` as text (an empty station is NULL), and carried columns."""
    return _fields(lines, carry).select(F.when(F.col("_s") != "", F.col("_s")).alias(STATION), F.col("_m").alias(MEASURE), *carry)


def parse_measure_lines(lines: DataFrame, dtype: str = "decimal(3,1)", *carry: str) -> DataFrame:
    """``value`` text lines -> ``station, measure`` with the CSV rules of the scans, and carried columns.

    Fast path for the usual line ``name;number``: split at the one ``;`` with
    ``substring_index`` (no CSV tokenizer).  Lines starting with a quote go
    through ``from_csv`` (FAILFAST, doubled-quote escape).  An unquoted line
    with no ``;`` or more than one raises; empty fields are NULL; empty lines
    are skipped.  The measure is trimmed and parsed strictly (whatever the
    session's ANSI setting), so ``12.35`` rounds to 12.4 (for DECIMAL(3,1)) and
    ``100.0``, ``abc`` or ``NaN`` raise.
    """
    fields = _fields(lines, carry)
    s_, m_ = F.col("_s"), F.col("_m")
    # Stage 3: parse once (the cast ignores surrounding blanks), check on the
    # parsed value; blank text is a NULL measure.
    parsed = fields.select(F.when(s_ != "", s_).alias("_s"), m_.alias("_m"),
                           m_.try_cast(dtype).alias("_p"), *carry)
    return parsed.select(F.col("_s").alias(STATION),
                         _strict(F.col("_m"), F.col("_p"), dtype).alias(MEASURE), *carry)


def _strict(text, parsed, dtype: str):
    """``parsed``, or an error when non-blank ``text`` did not parse (the trim runs
    only on that rare path)."""
    bad = F.raise_error(F.concat(F.lit(f"bad {dtype} measurement: "), text))
    failed = text.isNotNull() & parsed.isNull() & (F.trim(text) != "")
    return F.when(failed, bad.cast(dtype)).otherwise(parsed)


def strict_number(text, dtype: str):
    """Parse ``text`` as ``dtype``; a non-NULL text that does not parse (or does
    not fit, e.g. ``100.0`` as DECIMAL(3,1)) raises, whatever the session's ANSI
    setting."""
    return _strict(text, text.try_cast(dtype), dtype)


def scan_text_decimal(spark: SparkSession, path, parser: str = "lines") -> DataFrame:
    """``station STRING, measure DECIMAL(3,1)``.

    ``parser="lines"`` (default) reads raw lines and splits them
    (:func:`parse_measure_lines`); ``parser="csv"`` uses the CSV reader.  Both
    are strict: ``12.35`` rounds to 12.4, ``100.0`` and ``abc`` raise, blanks
    around the number are allowed while the station keeps its spaces (SQL
    engine behaviour).
    """
    if parser == "lines":
        return parse_measure_lines(spark.read.text(path), MEASURE_DECIMAL.simpleString())
    if parser != "csv":
        raise ValueError(f"unknown parser {parser!r}")
    raw = _reader(spark).schema(_RAW_SCHEMA).csv(path)
    m = F.trim(MEASURE)
    return raw.select(STATION, strict_number(F.when(m != "", m), MEASURE_DECIMAL.simpleString())
                      .alias(MEASURE))


def scan_text_double(spark: SparkSession, path, parser: str = "lines") -> DataFrame:
    """``station STRING, measure DOUBLE``."""
    if parser == "lines":
        return parse_measure_lines(spark.read.text(path), "double")
    schema = T.StructType([T.StructField(STATION, T.StringType(), True),
                           T.StructField(MEASURE, T.DoubleType(), True)])
    return _reader(spark).schema(schema).csv(path)


def scan_text_float(spark: SparkSession, path, parser: str = "lines") -> DataFrame:
    """32-bit float variant (measure FLOAT)."""
    if parser == "lines":
        return parse_measure_lines(spark.read.text(path), "float")
    schema = T.StructType([T.StructField(STATION, T.StringType(), True),
                           T.StructField(MEASURE, T.FloatType(), True)])
    return _reader(spark).schema(schema).csv(path)


def scan_text_inferred(spark: SparkSession, path) -> DataFrame:
    """S3: types inferred from the content (an extra pass), names supplied."""
    return _reader(spark).option("inferSchema", "true").csv(path).toDF(STATION, MEASURE)


def scan_lines_split(spark: SparkSession, path, dtype: str = "double") -> DataFrame:
    """Raw lines split on every ``;`` (no quoting), field 1 parsed as ``dtype``.

    A line without a second field raises, as does a bad number (whatever the
    ANSI setting); extra fields are ignored.  Empty lines are skipped.
    """
    lines = spark.read.text(path).where(F.length("value") > 0)
    parts = F.split(F.col("value"), ";")
    second = F.when(F.size(parts) >= 2, F.element_at(parts, 2)).otherwise(
        F.raise_error(F.concat(F.lit("line without a second field: "), F.col("value"))))
    return lines.select(
        F.element_at(parts, 1).alias(STATION),
        strict_number(F.trim(second), dtype).alias(MEASURE),
    )


def station_names(spark: SparkSession, path) -> DataFrame:
    """Reference list ``name;...`` -> distinct names; lines containing ``#`` skipped."""
    lines = spark.read.text(path)
    return (lines.where(~F.col("value").contains("#"))
            .select(F.element_at(F.split("value", ";"), 1).alias(STATION))
            .distinct())
