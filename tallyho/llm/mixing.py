"""Mixing sources to target weights by systematic sampling (DataFrame functions only).

Every document of a source is expected ``target / source size`` times.  The
documents of a source are laid end to end, each as long as its expected copies; one
random offset per source shifts the integers, and a document is emitted once per
integer inside its stretch: floor or ceiling of its expectation, never more than
``MAX_COPIES`` as targets stop there.  Documents lie in order of size, so that the
words taken follow the target closely whatever the sizes.

Defined cases: a null text has size 0; a null source is one source, the last; sources
of size 0 get target 0 and no copies; repeated rows are separate documents; an empty
table gives an empty result; columns other than the named ones are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyho.llm.common import decided, materialize, text_key
from tallyho.operators.indexing import dense_index, exclusive_prefix_sum

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_COPIES = 2
SEED = 7


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in the text (null: 0)."""
    trimmed = F.regexp_replace(text, "^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$", "")
    return (F.when(F.coalesce(trimmed, F.lit("")) == "", F.lit(0))
            .otherwise(F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+")))).cast("bigint")


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) from the md5 of the joined parts (any engine can repeat it)."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
                   most: float = MAX_COPIES) -> DataFrame:
    """``source, source_size`` to ``source, source_size, target``.

    Sources in code-point order (null last) take the weights in turn.  Targets are
    ``level * weight``, cut at ``most`` times the size; the level rises until nothing
    is left to share.  Each round is one aggregate over the (checkpointed) sources
    and fixes at least one more source at its limit."""
    index = dense_index(sources, "source", "place").withColumnRenamed("source", "name")
    named = sources.where("source IS NOT NULL").count()
    turn = F.coalesce(F.col("place"), F.lit(named)) % len(weights)
    weight = F.array(*map(F.lit, weights))[turn.cast("int")].cast("double")
    rows = materialize(sources.join(index, sources["source"] == index["name"], "left")
                       .select("source", "source_size", weight.alias("weight"),
                               (F.col("source_size") * most).cast("double").alias("limit")), "mix-sources")
    total = share * (rows.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:
        full = F.col("limit") <= F.col("weight") * level
        fixed, free = rows.agg(F.sum(F.when(full, F.col("limit"))), F.sum(F.when(~full, F.col("weight")))).first()
        rising = (total - (fixed or 0.0)) / free if free else level
        if rising <= level:
            break
        level = rising
    return rows.select("source", "source_size", F.least("limit", F.col("weight") * level).alias("target"))


def mix(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
        weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MAX_COPIES,
        seed: int = SEED, text_keys: bool = False) -> DataFrame:
    """``id_col, source, size, source_size, target, copies`` for every document, and with
    ``text_keys`` the md5 of its text as ``node``."""
    node = [text_key(F.coalesce(F.col(text), F.lit(""))).alias("node")] if text_keys else []
    docs = materialize(df.select(F.col(id_col).alias("id"), F.col(source).alias("source"),
                                 word_count(F.col(text)).alias("size"), *node), "mix-sizes")
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, most)
    # The expected copies are the same for all documents of a source, so its prefix sum
    # is a rank times that number: exact integers are added up, not fractions.
    ordered = exclusive_prefix_sum(
        docs.withColumn("one", F.lit(1)).withColumn("draw", unit_hash(F.lit(seed), F.col("id"))),
        ["source", "size", "draw", "id"], "one", "position")
    first = ordered.groupBy("source").agg(F.min("position").alias("base"))
    per_source = (targets.join(first.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
                  .select(F.col("of"), "source_size", "target", "base"))
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank = F.col("position") - F.col("base")
    offset = unit_hash(F.lit(seed), F.lit("offset"), F.col("source"))
    copies = F.floor(offset + expected * (rank + 1)) - F.floor(offset + expected * rank)
    return (ordered.join(per_source, F.col("source").eqNullSafe(F.col("of")))
            .select(F.col("id").alias(id_col), "source", "size", "source_size", "target",
                    copies.cast("bigint").alias("copies"), *(["node"] if text_keys else [])))


def mixture(df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix itself: all columns of ``df``, every row as often as ``mix`` takes it."""
    taken = mix(df, id_col, text, source, text_keys=True, **options).where("copies > 0")
    taken = (taken.groupBy(F.col(id_col).alias("id"), "node")
             .agg(F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n")))
    rows = decided(df, materialize(taken, "mix-taken"), id_col, text, "copies")
    inner = [f"c{i}" for i in range(len(df.columns))]
    again = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return rows.toDF(*inner, "copies").select(*inner, again.alias("copy")).drop("copy").toDF(*df.columns)
