"""Incremental summary over a folder of measurement files.

The reference's "streaming" is a bounded-memory pass over a finite file.  Here
it is a Structured Streaming query over a directory of text files, parsed with
the same strict line rules as the batch scan: files are consumed a few
per micro-batch (``maxFilesPerTrigger``) and the per-station state
(min, max, sum, count) lives in the state store (one row per station, however
many rows arrive).  ``availableNow`` processes what is there and stops;
restarting with the same checkpoint continues with new files only.

Below the output folder:

* ``data/`` has a *delta* per micro-batch, the state of the stations that it changed (``update`` output), and
  *bases*, the state of all stations.  What a batch writes follows the stations it changes;
* ``state/`` publishes a manifest after each (``sinks.versions``): a base and the deltas behind it.
  Readers merge them, the newest state of a station wins (``live_summary``).  Every
  ``compact_every`` deltas are merged into a new base;
* ``summary/`` publishes the sorted summary once per run that found something.

A batch that is run again (after a failure) finds its number in the manifest and publishes nothing; one that broke
off during compaction only compacts.  ``remove_unused`` deletes what no newest pointer needs.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.functions.stats import state_aggs
from tallyho.operators.summary import finish_state, sort_stations
from tallyho.schema import MEASURE, MEASURE_DECIMAL, STATION
from tallyho.sinks import versions
from tallyho.sources.text import parse_measure_lines


# Fixed value: Spark's RocksDB state store provider class (off-heap state, the
# usual choice when the state is large).
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


COMPACT_EVERY = 8                  # deltas, before they are merged into a base
_NO_STATE = {"batch": -1, "base": None, "deltas": []}


def published(spark: SparkSession, out_path: str) -> str:
    """Folder of the newest published summary (versions are written once and never changed)."""
    return versions.current(spark, f"{out_path}/summary")


def manifest(spark: SparkSession, out_path: str) -> dict:
    """The last batch, the base and the deltas of the newest published state."""
    try:
        folder = versions.current(spark, f"{out_path}/state")
    except FileNotFoundError:
        return dict(_NO_STATE)
    return json.loads(spark.read.text(folder).first()["value"])


def _publish_manifest(spark: SparkSession, out_path: str, content: dict) -> None:
    line = spark.createDataFrame([(json.dumps(content),)], "value string").coalesce(1)
    versions.publish(spark, f"{out_path}/state", line.write.text)


def live_state(spark: SparkSession, out_path: str) -> DataFrame:
    """``station, min, max, sum, count`` as of the last published batch: base and deltas, merged on read."""
    now = manifest(spark, out_path)
    folders = [f for f in (now["base"], *now["deltas"]) if f]
    if not folders:
        raise FileNotFoundError(f"nothing published below {out_path}")
    parts = [spark.read.parquet(f"{out_path}/data/{f}").withColumn("_age", F.lit(i)) for i, f in enumerate(folders)]
    newest = reduce(DataFrame.unionByName, parts).groupBy(STATION).agg(
        F.max_by(F.struct("min", "max", "sum", "count"), "_age").alias("s"))
    return newest.select(STATION, "s.*")


def live_summary(spark: SparkSession, out_path: str) -> DataFrame:
    """The sorted summary as of the last published batch, also while a run goes on."""
    return sort_stations(finish_state(live_state(spark, out_path)))


def compact(spark: SparkSession, out_path: str) -> None:
    """Merge base and deltas into a new base; readers of the old ones are not disturbed."""
    now = manifest(spark, out_path)
    base = f"base-{now['batch']:09d}-{uuid.uuid4().hex[:8]}"
    live_state(spark, out_path).write.parquet(f"{out_path}/data/{base}")
    _publish_manifest(spark, out_path, {"batch": now["batch"], "base": base, "deltas": []})


def remove_unused(spark: SparkSession, out_path: str) -> list[str]:
    """Delete replaced manifests and summaries, and data that the newest manifest doesn't name.
    Not while a run goes on."""
    now = manifest(spark, out_path)
    kept = {now["base"], *now["deltas"]}
    gone = [f for f in versions.names(spark, f"{out_path}/data") if f not in kept]
    for root in ("state", "summary"):
        if versions.published(spark, f"{out_path}/{root}"):
            versions.remove_unused(spark, f"{out_path}/{root}")
    for folder in gone:
        versions.remove(spark, f"{out_path}/data/{folder}")
    return gone


def incremental_summary(spark: SparkSession, text_dir: str, out_path: str,
                        checkpoint_path: str, files_per_trigger: int = 1,
                        state_partitions: int | None = None,
                        state_store: str | None = None, compact_every: int = COMPACT_EVERY) -> str:
    """Run (or continue) the incremental summary; returns the newest summary's folder.

    Every micro-batch writes the state of the stations it changed and then publishes it, so a failed
    batch changes nothing; the sorted summary is published when the run ends (``published``), and
    ``live_summary`` reads the state in between.

    ``state_partitions`` sizes the state store (one row per station) apart from
    the batch shuffle width; ``state_store="rocksdb"`` keeps the state in
    RocksDB.  Both are fixed by the first run of a checkpoint.  The stream runs in a
    session of its own, so the caller's settings stay as they are.
    """
    if state_store not in (None, "default", "rocksdb"):
        raise ValueError(f"unknown state store {state_store!r}")
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and session.conf.isModifiable(key):
            session.conf.set(key, value)
    if state_partitions is not None:
        session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    if state_store == "rocksdb":
        session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    before = len(versions.published(spark, f"{out_path}/state"))
    lines = (session.readStream.option("maxFilesPerTrigger", files_per_trigger)
             .text(text_dir))
    rows = parse_measure_lines(lines, MEASURE_DECIMAL.simpleString())
    state = rows.groupBy(STATION).agg(*state_aggs(MEASURE))

    def publish(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        now = manifest(own, out_path)
        if batch_id > now["batch"]:
            delta = f"delta-{batch_id:09d}-{uuid.uuid4().hex[:8]}"
            batch.write.parquet(f"{out_path}/data/{delta}")
            now = {"batch": batch_id, "base": now["base"], "deltas": [*now["deltas"], delta]}
            _publish_manifest(own, out_path, now)
        else:  # run again: the stream's own state still has to move on
            batch.write.format("noop").mode("overwrite").save()
        if len(now["deltas"]) >= compact_every:
            compact(own, out_path)

    query = (state.writeStream.outputMode("update")
             .option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True)
             .foreachBatch(publish).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    if len(versions.published(spark, f"{out_path}/state")) > before or not versions.published(spark, f"{out_path}/summary"):
        versions.publish(spark, f"{out_path}/summary", live_summary(spark, out_path).write.parquet)
    return published(spark, out_path)
