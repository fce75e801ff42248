"""Schemas and canonical column names."""

from pyspark.sql import types as T

STATION = "station"
MEASURE = "measure"
ROW_ID = "rid"
CHUNK_ID = "chunk_id"
LINE_INDEX = "line_idx"

# Canonical summary columns (rounded contract).
MIN_COL = "min_temperature"
MEAN_COL = "mean_temperature"
MAX_COL = "max_temperature"

MEASURE_DECIMAL = T.DecimalType(3, 1)
SUM_DECIMAL = T.DecimalType(18, 1)
