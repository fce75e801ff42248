"""Registered queries of the subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.llm import bytepair, decontaminate, fingerprint, html, language, lexical, licenses, mixing, neardup, quality, sharding, sql, substrings, variants
from tallyho.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}  # filled at the end of the module

QUALITY_THRESHOLD = 0.3
SHARDS = 40
FOLDER_ROWS = 1024  # document ids per lowest directory in the license scan
LICENCE_LINE = "(?i)licen[cs]ed under|released under the|terms of the|public domain|spdx"


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def id_crc(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


@query
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_crc() % 4 == 2, F.lit(False))
    model = language.train(docs.where(~held_out))
    return language.predict(docs.drop("lang"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op2_decontamination(spark, sf_dir):
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"))


@query
def op3_fingerprints(spark, sf_dir):
    return fingerprint.successor_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_mixing(spark, sf_dir):
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


@query
def op5_html_extraction(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html.main_text(pages, html.fit(pages), "html", "page_id", "url")
    return found.withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op6_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_crc() % 5 == 0, F.lit(False))
    model = quality.fit(docs, table(spark, sf_dir, "labels").where(~held_out))
    return quality.with_score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


@query
def op7_substring_dedup(spark, sf_dir):
    return substrings.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


@query
def op8_license_scan(spark, sf_dir):
    """Documents as files ``source/lang/folder/name``, the folder by id.  A document with a line that names a
    licence is a licence file, of its source, its language there or its folder by the id."""
    docs = table(spark, sf_dir, "documents")
    states = F.coalesce(F.col("text").rlike(LICENCE_LINE), F.lit(False))
    source, lang = F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-"))
    folder = F.floor(F.col("doc_id") / FOLDER_ROWS).cast("string")
    depth = F.when(states, F.pmod("doc_id", F.lit(3))).otherwise(2)
    name = F.when(states, F.concat(F.lit("LICENSE-"), F.col("doc_id"))).otherwise(F.col("doc_id").cast("string"))
    path = F.concat_ws("/", source, F.when(depth >= 1, lang), F.when(depth >= 2, folder), name)
    return licenses.scan(docs.withColumn("path", path), "path", "text", None, licenses.COSINE, "doc_id")


@query
def op9_sharding(spark, sf_dir):
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=SHARDS)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


@query
def op10_minhash(spark, sf_dir):
    return neardup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size")


@query
def op11_lexical_search(spark, sf_dir):
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_spelling_variants(spark, sf_dir):
    return variants.variants(table(spark, sf_dir, "documents"))


@query
def op13_byte_bpe(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bytepair.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), "text", path, decoded="decoded")
    return coded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


ORACLE.update({
    "op2_decontamination": sql.DECONTAMINATION,
    "op4_mixing": sql.MIXING,
    "op7_substring_dedup": sql.SUBSTRINGS,
    "op11_lexical_search": sql.LEXICAL,
    "op12_spelling_variants": sql.VARIANTS,
    "op8_license_scan": sql.license_sql(FOLDER_ROWS, LICENCE_LINE),
})
