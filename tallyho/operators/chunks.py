"""Chunk partials and their merge (A6-A9), and the user-function forms.

A partial is ``chunk_id, station, min, max, sum, count``; the merge is
min of mins, max of maxes, sum of sums, sum of counts, so the merged mean is
the true (weighted) mean for any chunking.  ``mean_of_chunk_means`` keeps the
other answer (unweighted mean of chunk means) under its own name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyho.functions.stats import from_tenths, int_div, merge_aggs, sum_input, tenths
from tallyho.operators.indexing import exclusive_prefix_sum
from tallyho.operators.summary import finish_state, sort_stations
from tallyho.schema import CHUNK_ID, MEASURE, STATION, SUM_DECIMAL


def chunk_partials(chunked: DataFrame) -> DataFrame:
    """``chunk_id, station, min, max, sum DECIMAL(18,1), count`` per chunk."""
    return chunked.groupBy(CHUNK_ID, STATION).agg(
        F.min(MEASURE).alias("min"),
        F.max(MEASURE).alias("max"),
        F.sum(sum_input(MEASURE)).alias("sum"),
        F.count(MEASURE).alias("count"),
    )


def union_partials(*partials: DataFrame) -> DataFrame:
    """Bag union of partial frames (columns matched by name)."""
    out = partials[0]
    for p in partials[1:]:
        out = out.unionByName(p)
    return out


def merge_partials(partials: DataFrame) -> DataFrame:
    """Merge partials into the canonical summary (equals A1)."""
    return sort_stations(finish_state(partials.groupBy(STATION).agg(*merge_aggs())))


def mean_of_chunk_means(chunked: DataFrame) -> DataFrame:
    """Unweighted mean of per-chunk means (what a naive chunk merge gives).

    Chunk means and their mean are doubles; only equal to the true mean when
    every chunk holds the same number of rows of the station.
    """
    per_chunk = chunked.groupBy(CHUNK_ID, STATION).agg(
        F.min(MEASURE).alias("min"), F.max(MEASURE).alias("max"),
        F.avg(F.col(MEASURE).cast("double")).alias("mean"))
    out = per_chunk.groupBy(STATION).agg(
        F.min("min").cast("double").alias("min"),
        F.max("max").cast("double").alias("max"),
        F.avg("mean").alias("mean"))
    return sort_stations(out)


# ----------------------------------------------------------------- U1 / U2
# The pandas functions see the measure as integer tenths (``measure_tenths``,
# int64), an Arrow-native type: no Python Decimal objects per row, and sums stay
# exact.  They return state in tenths; Spark turns it back into decimals.
TENTHS_COL = "measure_tenths"
ROW_BYTES = 24               # of a row beside its station text
BATCH_STATE_SCHEMA = "station string, min_t bigint, max_t bigint, sum_t bigint, count bigint"
CHUNK_STATE_SCHEMA = "chunk_id bigint, " + BATCH_STATE_SCHEMA


def pandas_state(pdf: pd.DataFrame) -> pd.DataFrame:
    """Per-station (min, max, sum, count) in tenths of one pandas frame."""
    t = pdf[TENTHS_COL]
    g = pd.DataFrame({STATION: pdf[STATION], "t": t}).groupby(STATION, dropna=False, sort=False)["t"]
    out = pd.DataFrame({
        "min_t": g.min(), "max_t": g.max(),
        "sum_t": g.sum(min_count=0), "count": g.count(),
    }).reset_index()
    out[STATION] = out[STATION].astype(object).where(out[STATION].notna(), None)
    for c in ("min_t", "max_t"):
        out[c] = out[c].astype("Int64")
    out["sum_t"] = out["sum_t"].astype(np.int64)
    out["count"] = out["count"].astype(np.int64)
    return out


def _with_tenths(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(*keys, STATION, tenths(MEASURE).alias(TENTHS_COL))


def _state_from_tenths(state: DataFrame) -> DataFrame:
    """Tenths state -> (station, min, max, sum DECIMAL(18,1), count), merged natively."""
    dec = state.select(STATION,
                       from_tenths("min_t").alias("min"), from_tenths("max_t").alias("max"),
                       from_tenths("sum_t", SUM_DECIMAL).alias("sum"), "count")
    return sort_stations(finish_state(dec.groupBy(STATION).agg(*merge_aggs())))


def batch_partials_udf(df: DataFrame, fn=None) -> DataFrame:
    """A pandas function over each Arrow batch, run in parallel by Spark.

    Batches are not chunks, so ``fn`` must return mergeable state
    (``station, min_t, max_t, sum_t, count`` in tenths, see :func:`pandas_state`);
    the merge of the per-batch states is a native aggregate.
    """
    fn = fn or pandas_state

    def per_batch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield fn(pdf)

    return _state_from_tenths(_with_tenths(df).mapInPandas(per_batch, BATCH_STATE_SCHEMA))


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in a pandas frame of station and measure, about: text, two references, the number."""
    return F.coalesce(F.octet_length(STATION), F.lit(0)) + F.lit(ROW_BYTES)


def with_byte_chunks(df: DataFrame, order_by: str, chunk_bytes: int) -> DataFrame:
    """``chunk_id`` such that no chunk's rows (``row_bytes``) exceed ``chunk_bytes``, but for a single row that does.

    Rows up to half the bound are dealt out by the running sum of their bytes in ``order_by``
    order, half a bound of starts to a chunk; a larger row is a chunk of its own.  The running
    sum is distributed (``exclusive_prefix_sum``), so consecutive rows share a chunk without any task seeing
    all rows.  Ids are not dense: even ones for the first kind, odd ones for the second."""
    if chunk_bytes <= 0:
        raise ValueError("chunk_bytes must be positive")
    half = max(1, chunk_bytes // 2)
    sized = df.withColumn("_bytes", row_bytes(df).cast("bigint"))
    large = F.col("_bytes") > half
    dealt = exclusive_prefix_sum(sized.withColumns({"_small": F.when(large, 0).otherwise(F.col("_bytes")).cast("bigint"),
                                                    "_one": large.cast("bigint")}), [order_by], "_small", "_start")
    number = F.monotonically_increasing_id() * 2 + 1
    chunk = F.when(F.col("_one") == 1, number).otherwise(int_div(F.col("_start"), F.lit(half)) * 2)
    return dealt.select(*df.columns, chunk.alias(CHUNK_ID))


def chunk_apply_udf(chunked: DataFrame, fn=None) -> DataFrame:
    """A pandas function over each whole chunk (``groupBy(chunk_id).applyInPandas``).

    The chunks bound the memory one worker needs: ``with_byte_chunks`` makes them by bytes,
    ``sources.lines.with_chunk_id`` by rows.  The per-chunk results are merged natively.
    """
    fn = fn or pandas_state

    def per_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        out = fn(pdf)
        out.insert(0, CHUNK_ID, int(pdf[CHUNK_ID].iloc[0]))
        return out

    state = _with_tenths(chunked, CHUNK_ID).groupBy(CHUNK_ID).applyInPandas(per_chunk, CHUNK_STATE_SCHEMA)
    return _state_from_tenths(state.drop(CHUNK_ID))

