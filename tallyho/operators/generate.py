"""Test-data generation as Spark jobs.

Rows come from ``spark.range(n)`` split over tasks; no Python runs per row.
Every draw is a hash of the seed and the row id.  Name tables are broadcast only
when their measured size is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.functions.stats import int_div
from tallyho.functions.text import human_bytes
from tallyho.operators.indexing import dense_index
from tallyho.schema import MEASURE, MEASURE_DECIMAL, ROW_ID, STATION

# Fixed values of the generator: pool of 10,000 station draws; measures are
# uniform over -99.9 .. 99.9 with one decimal; the cyclic variant draws
# uniform -99 .. 99 as 32-bit floats; the labelled variant uses labels
# "Cidade_<i>" and uniform -20 .. 50 rounded to 4 decimals.
POOL_SIZE = 10_000
HOTTEST_TENTHS = 999
CYCLIC_LOW, CYCLIC_HIGH = -99.0, 99.0
CHOICE_PREFIX = "Cidade_"
CHOICE_LOW, CHOICE_HIGH = -20.0, 50.0
LENGTH_SAMPLE = ",-123.4"  # stands for separator and measure in the size estimate

POOL_BROADCAST_BYTES = 32 * 1024 * 1024
DRAW = 1 << 32  # draws are 32 bits of an md5


def draw(part: int, *of) -> Column:
    """A number in [0, ``DRAW``) from the md5 of ``of`` joined by ``|``: the ``part``-th 32 bits.
    The same for any engine, number of cores or split of the rows."""
    digest = F.md5(F.concat_ws("|", *[F.lit(str(x)) if not isinstance(x, Column) else x.cast("string") for x in of]))
    return F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10).cast("bigint")


def _pool(spark: SparkSession, names: DataFrame, pool_size: int, seed: int) -> DataFrame:
    """``slot, station``: ``pool_size`` draws with replacement from the names."""
    idx = dense_index(names.select(F.col(STATION)), STATION, "name_idx")
    n_names = idx.count()
    if n_names == 0:
        raise ValueError("station name list is empty")
    slots = spark.range(pool_size).select(F.col("id").alias("slot"),
                                          (draw(0, seed, "pool", F.col("id")) % n_names).alias("name_idx"))
    return slots.join(idx, "name_idx").select("slot", STATION)


def _small(df: DataFrame, name: str, max_bytes: int) -> DataFrame:
    """Broadcast ``df`` if its measured size allows it, else leave the join a shuffle join."""
    size = df.agg(F.coalesce(F.sum(F.octet_length(name) + 24), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= max_bytes else df


def generate_measurements(spark: SparkSession, names: DataFrame, n_rows: int, pool_size: int = POOL_SIZE,
                          seed: int = 0, max_broadcast_bytes: int = POOL_BROADCAST_BYTES) -> DataFrame:
    """G1 + G2: exactly ``n_rows`` rows ``rid, station, measure DECIMAL(3,1)``.

    Stations are drawn twice with replacement (a pool of ``pool_size`` names, then a slot
    of it per row), so some are heavier and some absent; measures are uniform over
    -99.9 .. 99.9.  All draws are hashes of (seed, row id).
    """
    pool = _small(_pool(spark, names, pool_size, seed), STATION, max_broadcast_bytes)
    rid = F.col("id")
    tenths = draw(1, seed, "row", rid) % (2 * HOTTEST_TENTHS + 1) - HOTTEST_TENTHS
    rows = spark.range(n_rows).select(rid.alias(ROW_ID), (draw(0, seed, "row", rid) % pool_size).alias("slot"),
                                      (tenths.cast("decimal(20,0)") / F.lit(10)).cast(MEASURE_DECIMAL).alias(MEASURE))
    return rows.join(pool, "slot").select(ROW_ID, STATION, MEASURE)


def generate_cyclic(spark: SparkSession, cities: DataFrame, n_rows: int, seed: int = 0,
                    max_broadcast_bytes: int = POOL_BROADCAST_BYTES) -> DataFrame:
    """Row ``i`` gets city ``i % k`` (cities in code-point order) and a FLOAT drawn
    uniformly from -99 .. 99 by a hash of (seed, row id)."""
    idx = dense_index(cities, STATION, "city_idx")
    k = idx.count()
    if k == 0:
        raise ValueError("city list is empty")
    value = draw(0, seed, "cyclic", F.col("id")) / float(DRAW) * (CYCLIC_HIGH - CYCLIC_LOW) + CYCLIC_LOW
    rows = spark.range(n_rows).select("id", (F.col("id") % k).alias("city_idx"), value.cast("float").alias("value"))
    return (rows.join(_small(idx, STATION, max_broadcast_bytes), "city_idx")
            .select(F.col("id").alias(ROW_ID), F.col(STATION).alias("city"), "value"))


def city_summary(rows: DataFrame) -> DataFrame:
    """Per-city ``min_value, max_value`` (FLOAT) and ``avg_value`` (DOUBLE)."""
    return rows.groupBy("city").agg(F.min("value").alias("min_value"),
                                    F.max("value").alias("max_value"),
                                    F.avg("value").alias("avg_value"))


def generate_choice(ids: DataFrame, n_labels: int = 20, seed: int = 0) -> DataFrame:
    """For every row of ``ids`` (one column) the id, ``estacao`` uniformly from
    ``Cidade_0..Cidade_{k-1}`` and ``medida`` uniformly from -20 .. 50 at 4 decimals, both by
    hashes of (seed, id) and in integers, so any SQL engine makes the same rows."""
    (name,) = ids.columns
    span = int(CHOICE_HIGH - CHOICE_LOW) * 10_000
    steps = int_div(draw(1, seed, "choice", F.col(name)) * (2 * span) + DRAW, F.lit(2 * DRAW))
    label = draw(0, seed, "choice", F.col(name)) % n_labels
    return ids.select(name, F.concat(F.lit(CHOICE_PREFIX), label.cast("string")).alias("estacao"),
                      ((steps + int(CHOICE_LOW) * 10_000).cast("double") / 10_000.0).alias("medida"))


def size_estimate(names: DataFrame, n_rows: int) -> DataFrame:
    """Estimated text size for ``n_rows`` lines over these names.

    record = (longest + 2 * shortest + len(LENGTH_SAMPLE)) / 2 bytes;
    total = n_rows * record, shown with 1024-based units (NULL past 1023.9 GiB).
    One global aggregate over the names; ``n_rows`` is a scalar (a count).
    """
    lens = names.agg(F.max(F.length(STATION)).cast("bigint").alias("max_len"),
                     F.min(F.length(STATION)).cast("bigint").alias("min_len"))
    record = (F.col("max_len") + F.col("min_len") * 2 + F.lit(len(LENGTH_SAMPLE))) / F.lit(2.0)
    total = F.lit(float(n_rows)) * record
    return lens.select("max_len", "min_len", record.alias("record_bytes"),
                       total.alias("total_bytes"), human_bytes(total).alias("size_text"))
