"""A training corpus from ``documents`` in five stages, each written and reread.

``STAGES`` is a list of (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of ``docs``; the last adds
the shard.  Rows that a stage drops are gone for all later ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.llm import decontaminate, mixing, neardup, quality, sharding
from tallyho.llm.common import materialize, table
from tallyho.llm.queries import QUALITY_THRESHOLD, SHARDS, id_crc


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold, fitted on labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels").where(F.coalesce(id_crc() % 5 != 0, F.lit(True)))
    score = "score" + "_" * sum(c.startswith("score") for c in docs.columns)
    scored = quality.with_score(docs, quality.fit(docs, labels), out=score)
    return scored.where(F.col(score) >= QUALITY_THRESHOLD).drop(score)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return neardup.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixing.mixture(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard."""
    return sharding.with_shard(docs, shards=SHARDS)


STAGES = [("quality", quality_stage), ("near_duplicates", near_duplicate_stage),
          ("decontamination", decontamination_stage), ("mixing", mixing_stage), ("sharding", sharding_stage)]

#: No SQL: the first two stages are a trained network and sketches; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
