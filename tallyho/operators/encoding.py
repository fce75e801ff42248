"""Encoding and footprint profile.

``footprint_profile`` gives *logical* bytes (what the columns need, not Python object
overhead): a string column costs its UTF-8 bytes; a dictionary-encoded column
costs the dictionary's bytes plus one fixed-width code per row; DOUBLE is 8
bytes and FLOAT 4 bytes per row.  ``stored_footprint`` gives the bytes that the same columns
take as parquet files, each written alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.operators.indexing import dense_index
from tallyho.schema import MEASURE, STATION
from tallyho.session import fresh_dir
from tallyho.sinks import versions

# Code width by dictionary size (pandas-style narrowest signed
# integer): fewer than 127 values -> 1 byte, fewer than 32,767 -> 2 bytes,
# fewer than 2,147,483,647 -> 4 bytes, else 8 bytes.
CODE_WIDTHS = [(127, 1), (32_767, 2), (2_147_483_647, 4)]


def code_width(k: Column) -> Column:
    expr = None
    for limit, width in CODE_WIDTHS:
        cond = k < F.lit(limit)
        expr = F.when(cond, F.lit(width)) if expr is None else expr.when(cond, F.lit(width))
    return expr.otherwise(F.lit(8))


def describe_types(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``column, type`` rows for a frame's schema (metadata only)."""
    rows = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    return spark.createDataFrame(rows, "column string, type string")


# Largest dictionary shipped to every task (UTF-8 bytes plus ~16 bytes per entry).
DICT_BROADCAST_BYTES = 32 * 1024 * 1024


def _dictionary_side(dictionary: DataFrame, key: str, max_bytes: int) -> DataFrame:
    """Broadcast the dictionary only when its measured size is under ``max_bytes``;
    otherwise a shuffle join (AQE splits hot keys of the big side)."""
    size = dictionary.agg(
        (F.coalesce(F.sum(F.octet_length(key)), F.lit(0)) + F.count(F.lit(1)) * 16).alias("b")).first()["b"]
    return F.broadcast(dictionary) if size <= max_bytes else dictionary


def dictionary_encode(df: DataFrame, key: str = STATION, code_col: str | None = None,
                      max_broadcast_bytes: int = DICT_BROADCAST_BYTES, code_type: str = "int"):
    """replace ``key`` by its code (0-based, sorted category order).

    Returns ``(encoded, dictionary)``.  NULL keys get a NULL code.  Codes are of
    ``code_type`` at every size (``bigint`` for more than 2**31 keys; a code that doesn't fit
    raises in ANSI mode); the narrowest width is only reported (F3).  The dictionary
    (one row per distinct key, over the checkpointed index) is measured and broadcast
    only under ``max_broadcast_bytes``; beyond that the join is a shuffle join, whose hot
    keys need ``spark.sql.adaptive.skewJoin.enabled`` (the default) to be split.
    """
    code_col = code_col or f"{key}_code"
    dictionary = dense_index(df, key, code_col).select(key, F.col(code_col).cast(code_type).alias(code_col))
    others = [c for c in df.columns if c != key]
    side = _dictionary_side(dictionary, key, max_broadcast_bytes)
    encoded = df.join(side, key, "left").select(code_col, *others)
    return encoded, dictionary


def dictionary_decode(encoded: DataFrame, dictionary: DataFrame, key: str = STATION,
                      code_col: str | None = None,
                      max_broadcast_bytes: int = DICT_BROADCAST_BYTES) -> DataFrame:
    """Inverse of :func:`dictionary_encode` (same broadcast rule)."""
    code_col = code_col or f"{key}_code"
    others = [c for c in encoded.columns if c != code_col]
    side = _dictionary_side(dictionary, key, max_broadcast_bytes)
    return encoded.join(side, code_col, "left").select(key, *others)


def downcast_measure(df: DataFrame, col: str = MEASURE) -> DataFrame:
    """Numeric column narrowed to 32-bit FLOAT."""
    return df.withColumn(col, F.col(col).cast("float"))


def _stored_bytes(df: DataFrame) -> int:
    """Bytes of the parquet files of a frame that is written for this only."""
    spark = df.sparkSession
    folder = fresh_dir(spark, "footprint")
    df.write.parquet(folder)
    size = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
            .agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0])
    versions.remove(spark, folder)
    return int(size)


def stored_footprint(df: DataFrame, key: str = STATION) -> DataFrame:
    """F3, measured: ``column, bytes_before, bytes_after, reduction`` of the stored columns.

    Each column is written as parquet by itself and its files' sizes are added up: the station as
    strings, then as codes and dictionary; the measure as DOUBLE, then as FLOAT.  Parquet has its own
    dictionaries, so the stored gain of codes is smaller than the logical one.  The written files are removed."""
    encoded, dictionary = dictionary_encode(df.select(key), key)
    sizes = [(key, _stored_bytes(df.select(key)), _stored_bytes(encoded) + _stored_bytes(dictionary)),
             (MEASURE, _stored_bytes(df.select(F.col(MEASURE).cast("double"))),
              _stored_bytes(downcast_measure(df.select(MEASURE))))]
    sizes.append(("total", sum(s[1] for s in sizes), sum(s[2] for s in sizes)))
    rows = df.sparkSession.createDataFrame(sizes, "column string, bytes_before bigint, bytes_after bigint")
    return rows.withColumn("reduction", F.when(F.col("bytes_before") > 0, 1.0 - F.col("bytes_after") / F.col("bytes_before")))


def footprint_profile(df: DataFrame, key: str = STATION) -> DataFrame:
    """``column, bytes_before, bytes_after, reduction`` for station, measure, total.

    Before: station as UTF-8 strings, measure as DOUBLE.  After: station
    dictionary-encoded, measure as FLOAT.  One aggregation pass (per-station
    counts, then a global sum); no join.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    b = F.coalesce(F.octet_length(key).cast("bigint"), F.lit(0))
    g = per_key.agg(
        F.sum("_n").alias("n"),
        F.sum(b * F.col("_n")).alias("str_bytes"),
        F.sum(F.when(F.col(key).isNotNull(), b)).alias("dict_bytes"),
        F.count(key).alias("k"),
    )
    n = F.coalesce(F.col("n"), F.lit(0)).cast("bigint")
    st_before = F.coalesce(F.col("str_bytes"), F.lit(0)).cast("bigint")
    st_after = (F.coalesce(F.col("dict_bytes"), F.lit(0)) + code_width(F.col("k")) * n).cast("bigint")
    me_before, me_after = (n * 8), (n * 4)
    rows = g.select(F.explode(F.array(
        F.struct(F.lit(key).alias("column"), st_before.alias("bytes_before"), st_after.alias("bytes_after")),
        F.struct(F.lit(MEASURE).alias("column"), me_before.alias("bytes_before"), me_after.alias("bytes_after")),
        F.struct(F.lit("total").alias("column"), (st_before + me_before).alias("bytes_before"),
                 (st_after + me_after).alias("bytes_after")),
    )).alias("r")).select("r.*")
    return rows.withColumn(
        "reduction",
        F.when(F.col("bytes_before") > 0,
               F.lit(1.0) - F.col("bytes_after").cast("double") / F.col("bytes_before").cast("double")))
