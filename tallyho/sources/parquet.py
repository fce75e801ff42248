"""Parquet scans (S7-S10) and SQL over a registered frame."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.schema import STATION

def read_parquet(spark: SparkSession, *paths: str, base_path: str | None = None) -> DataFrame:
    """One file, a folder of parts, or an explicit list of files.

    ``base_path`` keeps partition columns (e.g. ``chunk_id``) when reading
    individual files of a partitioned folder.  A missing path raises
    ``FileNotFoundError`` (S13).
    """
    if not paths:
        raise ValueError("no parquet paths given")
    reader = spark.read
    if base_path:
        reader = reader.option("basePath", base_path)
    try:
        return reader.parquet(*paths)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            raise FileNotFoundError(str(e)) from e
        raise


def serve_summary(spark: SparkSession, path: str) -> DataFrame:
    """``SELECT *`` straight over a stored summary (a serving read)."""
    return spark.sql("SELECT * FROM {stored}", stored=read_parquet(spark, path))


ZONES = "_zones"  # beside the part files; the underscore hides it from scans of the folder


def write_zones(spark: SparkSession, path: str, key: str = STATION) -> str:
    """Zone map of a stored sorted summary: first and last key of every part file, and whether it has NULL keys."""
    part = F.col("_metadata.file_name").alias("file")
    zones = read_parquet(spark, path).groupBy(part).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count_if(F.col(key).isNull()).alias("nulls"))
    zones.write.mode("overwrite").parquet(f"{path}/{ZONES}")
    return f"{path}/{ZONES}"


def lookup(spark: SparkSession, path: str, value: str | None, key: str = STATION) -> DataFrame:
    """S10 by name: the rows of one key, from the part files whose zone holds it (one, in a sorted summary).

    No other file is opened; a key in no zone opens none.  The zone map has to be that of these
    files: one that names a missing file raises."""
    zones = spark.read.parquet(f"{path}/{ZONES}")
    if value is None:
        own = zones.where("nulls > 0")
    else:
        own = zones.where((F.col("first") <= F.lit(value)) & (F.col("last") >= F.lit(value)))
    files = [f"{path}/{r['file']}" for r in own.select("file").collect()]
    schema = read_parquet(spark, path).schema
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*files).where(F.col(key).eqNullSafe(F.lit(value).cast("string")))


SUMMARY_SQL = """
SELECT station,
       min_m AS min_temperature,
       CAST(CAST(CASE WHEN s < 0 THEN -q ELSE q END AS DECIMAL(20,0)) / 10 AS DECIMAL(3,1))
           AS mean_temperature,
       max_m AS max_temperature
FROM (
  SELECT station, min_m, max_m, s,
         CASE WHEN n > 0 THEN (abs(s) * 2 + n) div (n * 2) END AS q
  FROM (
    SELECT station,
           MIN(measure) AS min_m,
           MAX(measure) AS max_m,
           SUM(CAST(measure * 10 AS BIGINT)) AS s,
           COUNT(measure) AS n
    FROM {measurements}
    GROUP BY station
  ) agg
) r
ORDER BY station ASC NULLS LAST
"""


def summary_sql_view(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The summary in SQL over ``df`` (no view name that two jobs could share)."""
    return spark.sql(SUMMARY_SQL, measurements=df)
