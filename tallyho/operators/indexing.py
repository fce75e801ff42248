"""Dense 0-based index over the sorted distinct values of a column.

Used for dictionaries (F2) and name lists (G1, G4).  The distinct values are
range-sorted across tasks, tagged with ``monotonically_increasing_id`` and
checkpointed (so every later use sees the same ids); a per-task count table
(one row per task) gives each task's offset, broadcast back to the values.
Nothing passes through a single task except that per-task table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyho.session import scratch_root


def dense_index(df: DataFrame, key: str, index_col: str = "idx") -> DataFrame:
    """``key, index_col`` for every non-null distinct ``key``, index in code-point order."""
    scratch_root(df.sparkSession)
    values = (df.select(key).where(F.col(key).isNotNull()).distinct()
              .orderBy(F.col(key).asc()))
    tagged = values.select(key, F.monotonically_increasing_id().alias("_mid")).checkpoint(eager=True)
    part = F.shiftright(F.col("_mid"), 33)
    per_task = tagged.groupBy(part.alias("_task")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    w = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, 0)
    offsets = per_task.select("_task", "_first", (F.sum("_n").over(w) - F.col("_n")).alias("_off"))
    out = tagged.join(F.broadcast(offsets), part == F.col("_task"))
    return out.select(key, (F.col("_off") + F.col("_mid") - F.col("_first")).alias(index_col))


def exclusive_prefix_sum(df: DataFrame, order_cols: list[str], weight: str,
                         out_col: str = "offset") -> DataFrame:
    """Add ``out_col``: sum of ``weight`` over all rows before this one in
    ``order_cols`` order (ties broken by position), computed without any
    single-task window over the rows.

    Rows are range-sorted across tasks and checkpointed with their
    ``monotonically_increasing_id``; per-task totals (one row per task) give
    each task's starting offset; a window partitioned by task adds the running
    sum inside it.
    """
    scratch_root(df.sparkSession)
    ordered = df.orderBy(*order_cols)
    tagged = ordered.withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    task = F.shiftright(F.col("_mid"), 33)
    with_task = tagged.withColumn("_task", task)
    per_task = with_task.groupBy("_task").agg(F.sum(weight).alias("_tw"))
    w_tasks = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, 0)
    task_off = per_task.select("_task", (F.sum("_tw").over(w_tasks) - F.col("_tw")).alias("_toff"))
    w_rows = Window.partitionBy("_task").orderBy("_mid").rowsBetween(Window.unboundedPreceding, 0)
    within = with_task.withColumn("_run", F.sum(weight).over(w_rows) - F.col(weight))
    out = within.join(F.broadcast(task_off), "_task")
    return out.select(*df.columns, (F.col("_toff") + F.col("_run")).alias(out_col))
