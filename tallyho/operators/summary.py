"""Per-station summaries (the flagship question) and their variants.

All of these are one hash aggregate with map-side partial aggregation: each
scan task emits at most one state row per station, so a station holding a
third of all rows costs no more shuffle than any other, and the only exchange
carries ``(station, state)`` rows.  Sorting is a range exchange over the
(small) result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.functions.stats import (exact_mean, from_tenths, int_div,
                                     merge_aggs, state_aggs, sum_tenths,
                                     tenths)
from tallyho.functions.text import delimited, triple_text, with_awk_mean_text
from tallyho.schema import (MAX_COL, MEAN_COL, MEASURE, MEASURE_DECIMAL,
                            MIN_COL, STATION, SUM_DECIMAL)


def sort_stations(df: DataFrame, key: str = STATION) -> DataFrame:
    """Code-point order (Spark's binary UTF-8 order), NULL station last."""
    return df.orderBy(F.col(key).asc_nulls_last())


def drop_null_keys(df: DataFrame, key: str = STATION) -> DataFrame:
    """Rows whose station is NULL removed (what a pandas group-by does)."""
    return df.where(F.col(key).isNotNull())


def station_state(df: DataFrame, keys=(STATION,), measure: str = MEASURE) -> DataFrame:
    """Mergeable state ``keys..., min, max, sum DECIMAL(18,1), count``."""
    return df.groupBy(*keys).agg(*state_aggs(measure))


def merge_state(state: DataFrame, keys=(STATION,)) -> DataFrame:
    return state.groupBy(*keys).agg(*merge_aggs())


def finish_state(state: DataFrame, key: str = STATION) -> DataFrame:
    """State -> ``station, min_temperature, mean_temperature, max_temperature``."""
    return state.select(
        F.col(key).alias(STATION),
        F.col("min").cast(MEASURE_DECIMAL).alias(MIN_COL),
        exact_mean("sum", "count").alias(MEAN_COL),
        F.col("max").cast(MEASURE_DECIMAL).alias(MAX_COL),
    )


def summary_decimal(df: DataFrame, drop_nulls: bool = False) -> DataFrame:
    """A1: per-station min, mean rounded to one decimal, max; sorted by station.

    ``df`` needs ``station`` and a one-decimal ``measure``.  NULL stations form
    their own group (SQL semantics) unless ``drop_nulls``.
    """
    if drop_nulls:
        df = drop_null_keys(df)
    return sort_stations(finish_state(station_state(df)))


def summary_double(df: DataFrame) -> DataFrame:
    """A2: same question on 64-bit floats, raw (unrounded) mean."""
    m = F.col(MEASURE).cast("double")
    out = df.groupBy(STATION).agg(
        F.min(m).alias(MIN_COL), F.avg(m).alias(MEAN_COL), F.max(m).alias(MAX_COL))
    return sort_stations(out)


def summary_float(df: DataFrame) -> DataFrame:
    """A3: 32-bit float input; min/max stay FLOAT, the mean is a DOUBLE."""
    m = F.col(MEASURE).cast("float")
    out = df.groupBy(STATION).agg(
        F.min(m).alias(MIN_COL), F.avg(m).alias(MEAN_COL), F.max(m).alias(MAX_COL))
    return sort_stations(out)


def sum_count_mean(df: DataFrame) -> DataFrame:
    """A4: per-station exact sum and count, mean = sum / count (double)."""
    st = station_state(df)
    return sort_stations(st.select(
        STATION,
        F.col("sum").alias("sum_measure"),
        F.col("count").alias("n_measure"),
        (sum_tenths("sum") / F.col("count") / F.lit(10.0)).alias("mean_measure"),
    ))


def summary_arrays(df: DataFrame, list_rows: int = 100_000) -> DataFrame:
    """A5: group values into lists, then min / sum / len / max over each list.

    Lists are built per (station, block of ``list_rows`` consecutive scan rows),
    so no list ever grows past ``list_rows`` however hot a station is; the
    per-list results are then merged like chunk partials.  The merge is
    associative, so the answer does not depend on how rows fall into blocks
    (a recomputed task may number its rows differently and still be exact).
    """
    block = int_div(F.monotonically_increasing_id(), F.lit(list_rows)).alias("_block")
    lists = (df.select(STATION, MEASURE, block)
             .groupBy(STATION, "_block")
             .agg(F.collect_list(MEASURE).alias("values")))
    per_list = lists.select(
        STATION,
        F.array_min("values").alias("min"),
        F.array_max("values").alias("max"),
        from_tenths(F.aggregate("values", F.lit(0).cast("bigint"),
                                lambda acc, x: acc + tenths(x)), SUM_DECIMAL).alias("sum"),
        F.size("values").cast("bigint").alias("count"),
    )
    return sort_stations(finish_state(merge_state(per_list)))


def row_count(df: DataFrame, measure: str = MEASURE) -> DataFrame:
    """A10: number of rows.  References ``measure`` so a strict text scan parses it."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count(measure).alias("n_measures"))


def station_count(df: DataFrame) -> DataFrame:
    """Number of result groups (NULL station counts as one group)."""
    return df.groupBy(STATION).agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("n_stations"))


def summary_head(summary: DataFrame, n: int = 5) -> DataFrame:
    """O2: first ``n`` rows of the sorted summary (TakeOrderedAndProject)."""
    return sort_stations(summary).limit(n)


def summary_formatted(summary: DataFrame) -> DataFrame:
    """``station, stats`` with stats = ``min/mean/max`` at one decimal."""
    return summary.select(STATION, triple_text(MIN_COL, MEAN_COL, MAX_COL).alias("stats"))


def text_lines(summary: DataFrame) -> DataFrame:
    """``station, value`` with value = ``station: min/mean/max``."""
    value = F.concat(F.coalesce(F.col(STATION), F.lit("")), F.lit(": "), triple_text(MIN_COL, MEAN_COL, MAX_COL))
    return summary.select(STATION, value.alias("value"))


def delimited_lines(df: DataFrame) -> DataFrame:
    """``station, value`` with value = ``station;max;min;mean`` (mean at 6 significant
    digits), from raw rows; always four fields."""
    state = station_state(df).withColumn("_st", sum_tenths("sum"))
    state = with_awk_mean_text(state, "_st", "count", "mean_text")
    return sort_stations(state.select(STATION, delimited(";", STATION, "max", "min", "mean_text").alias("value")))
