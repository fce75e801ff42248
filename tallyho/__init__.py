"""tallyho: exact per-station min / mean / max summaries on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built from the DataFrame / SQL / Structured Streaming APIs.
The most used entry points are re-exported here.
"""

from tallyho.operators.chunks import chunk_partials, merge_partials
from tallyho.operators.summary import (summary_decimal, summary_double,
                                       summary_float)
from tallyho.sources.lines import with_chunk_id, with_line_index
from tallyho.sources.text import (scan_text_decimal, scan_text_double,
                                  station_names)
from tallyho.streaming.incremental import incremental_summary

__all__ = [
    "chunk_partials", "merge_partials", "summary_decimal", "summary_double", "summary_float",
    "with_chunk_id", "with_line_index", "scan_text_decimal", "scan_text_double",
    "station_names", "incremental_summary",
]
