"""Measurement relations derived from the driver tables.

The driver tables hold no weather data, so the measurement view ``M`` maps
``events`` onto the ``(rid, station, measure)`` shape exactly (same rows in
Spark and in the SQL oracle).  A wider variant maps ``lineitem`` (no unique
row key there, so it carries none).  Both are pure projections: Catalyst prunes
the parquet scan down to the referenced columns.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.schema import MEASURE, MEASURE_DECIMAL, ROW_ID, STATION
from tallyho.session import table_path


def _measure_from(value: Column) -> Column:
    # Fixed mapping shared with the SQL oracle: a deterministic spread of tenths
    # over -99.9 .. 99.9 taken from a double column.
    # round(x) half away from zero with primitive double ops, then tenths ->
    # DECIMAL(3,1) by one small decimal multiply.
    scaled = value * 100
    r = (F.signum(scaled) * F.floor(F.abs(scaled) + F.lit(0.5))).cast("bigint")
    t = (r % 1999) - 999
    return (t.cast("decimal(4,0)") * F.lit(Decimal("0.1"))).cast(MEASURE_DECIMAL)


def events_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View M: ``rid BIGINT, station STRING, measure DECIMAL(3,1)`` over ``events``."""
    ev = spark.read.parquet(table_path(sf_dir, "events"))
    return ev.select(
        F.col("event_id").alias(ROW_ID),
        F.concat(F.col("event_type"), F.lit("-"), F.col("user_id").cast("string")).alias(STATION),
        _measure_from(F.col("value")).alias(MEASURE),
    )


def lineitem_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wider view: ``station STRING, measure DECIMAL(3,1)`` over ``lineitem``."""
    li = spark.read.parquet(table_path(sf_dir, "lineitem"))
    return li.select(
        F.concat(F.lit("part-"), F.col("l_partkey").cast("string")).alias(STATION),
        _measure_from(F.col("l_extendedprice")).alias(MEASURE),
    )


# SQL text of the same views for the DuckDB oracle (fixed values shared with
# the Spark expressions above).
M_SQL = (
    "SELECT event_id AS rid, "
    "concat(event_type, '-', CAST(user_id AS VARCHAR)) AS station, "
    "CAST(((CAST(round(value * 100) AS BIGINT) % 1999) - 999) / 10.0 AS DECIMAL(3,1)) AS measure "
    "FROM events"
)

ML_SQL = (
    "SELECT concat('part-', CAST(l_partkey AS VARCHAR)) AS station, "
    "CAST(((CAST(round(l_extendedprice * 100) AS BIGINT) % 1999) - 999) / 10.0 AS DECIMAL(3,1)) AS measure "
    "FROM lineitem"
)
