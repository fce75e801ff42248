"""Benchmark decontamination by a distributed positional inverted index (DataFrame functions only).

1. ``term_frequency``: how often each test term occurs in the training texts.
2. ``phrases``: every window of ``WINDOW`` consecutive words of a test item (the whole
   item where it is shorter) names its rarest terms; a window with a term that never
   occurs is dropped.  Windows of an item with the same rarest terms are one phrase.
3. ``postings``: (term, text, position) of those rarest terms only, stored.
4. ``intersect``: the offset-adjusted posting lists of a phrase's terms, rarest first,
   give (item, text, diagonal), the diagonal being text position minus item position;
   ``slop`` > 0 gives proximity matches instead.
5. ``overlaps``: along each diagonal the item is compared word by word with the text,
   and runs of a whole window are kept: exact matches.

Texts are keyed by their md5, so copies are searched once and no join depends on ids.
Joins against postings have the term, the text and the position in the key; the only
join on a term alone has the phrases on one side, broadcast where its counted size
allows, else a sort-merge join whose hot terms adaptive execution splits.

Defined cases: null texts have no words; an item without words has no window; repeated
items count as items each; repeated rows get equal results; empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyho.llm.common import materialize, text_key

WINDOW = 13
TERMS = 3                    # rarest terms intersected per phrase
BROADCAST_BYTES = 32 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z; null has none."""
    parts = F.split(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
    return F.array_remove(parts, "")


def small(df: DataFrame) -> DataFrame:
    """``df`` (stored) with a broadcast hint if its counted size allows one."""
    width = sum((F.coalesce(F.octet_length(f.name), F.lit(0)) if f.dataType.typeName() in ("string", "binary")
                 else F.coalesce(F.size(f.name), F.lit(0)) * 32 if f.dataType.typeName() == "array"
                 else F.lit(0)) + 16 for f in df.schema)
    return F.broadcast(df) if (df.agg(F.sum(width)).first()[0] or 0) <= BROADCAST_BYTES else df


def term_frequency(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``term, n``: occurrences in all ``texts.text`` of the terms in ``vocabulary.term``."""
    tokens = texts.select(F.explode(words(F.col("text"))).alias("term"))
    return tokens.join(small(vocabulary), "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def phrases(items: DataFrame, frequency: DataFrame, window: int = WINDOW) -> DataFrame:
    """``item, span, p1..pk, t1..tk``: item positions and terms, rarest first (a window of
    fewer terms repeats its last one)."""
    terms = (items.select("item", F.posexplode("words").alias("p", "t"))
             .join(frequency.withColumnRenamed("term", "t"), "t", "left")
             .groupBy("item").agg(F.array_sort(F.collect_list(F.struct("p", F.coalesce("n", F.lit(0)).alias("n"), "t")))
                                  .alias("terms")))
    span = F.least(F.lit(window), F.size("terms"))
    starts = F.sequence(F.lit(0), F.size("terms") - span)
    ranked = F.transform(starts, lambda s: F.slice(F.array_sort(F.transform(
        F.slice("terms", s + 1, span), lambda w: F.struct(w["n"].alias("n"), w["t"].alias("t"), w["p"].alias("p")))),
        1, TERMS))
    possible = F.array_distinct(F.filter(ranked, lambda r: r[0]["n"] > 0))
    each = terms.select("item", span.alias("span"), F.explode(possible).alias("r"))
    place = [F.least(F.lit(k), F.size("r") - 1) for k in range(TERMS)]
    return each.select("item", "span", *[F.get("r", k)["p"].alias(f"p{i}") for i, k in enumerate(place)],
                       *[F.get("r", k)["t"].alias(f"t{i}") for i, k in enumerate(place)])


def postings(texts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``term, text_key, pos`` of the vocabulary's terms, once per distinct text."""
    tokens = texts.select(text_key(F.col("text")).alias("text_key"), F.posexplode(words(F.col("text"))).alias("pos", "term"))
    return tokens.join(small(vocabulary), "term").select("term", "text_key", "pos").distinct()


def intersect(index: DataFrame, wanted: DataFrame, slop: int = 0) -> DataFrame:
    """``item, text_key, diagonal`` where all terms of a phrase occur at its offsets, each
    at most ``slop`` words away."""
    found = (index.join(small(wanted), F.col("term") == F.col("t0"))
             .withColumn("diagonal", F.col("pos") - F.col("p0")).drop("term", "pos"))
    for k in range(1, TERMS):
        at = F.col("diagonal") + F.col(f"p{k}")
        near = found.withColumn("pos", F.explode(F.sequence(at - slop, at + slop)) if slop else at)
        found = (near.join(index.withColumnRenamed("term", f"t{k}"), ["text_key", f"t{k}", "pos"])
                 .drop("pos", f"t{k}"))
        if slop:
            found = found.distinct()
    return found.select("item", "text_key", "diagonal").distinct()


def test_items(benchmark: DataFrame, item_col: str = "item_id", text: str = "text") -> DataFrame:
    """``item_id, words, item`` (stored): the items that have words, keyed by their words."""
    tests = benchmark.select(F.col(item_col).cast("string").alias("item_id"), words(F.col(text)).alias("words"))
    return materialize(tests.where(F.size("words") > 0)
                       .withColumn("item", F.md5(F.array_join("words", " ").cast("binary"))), "decon-items")


def overlaps(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (any columns with ``text``) with ``n_words`` and ``matches``: one (item key, hit
    positions) per matching distinct item text, null where there is none.  ``items``:
    item, words (distinct)."""
    texts = docs.select("text").where("text IS NOT NULL")
    vocabulary = materialize(items.select(F.explode("words").alias("term")).distinct(), "decon-terms")
    frequency = materialize(term_frequency(texts, vocabulary), "decon-frequency")
    wanted = materialize(phrases(items, frequency, window), "decon-phrases")
    rare = materialize(wanted.select(F.explode(F.array(*[f"t{k}" for k in range(TERMS)])).alias("term")).distinct(),
                       "decon-rare")
    index = materialize(postings(texts, rare), "decon-postings")
    spans = items.select("item", "words", F.least(F.lit(window), F.size("words")).alias("span"))
    candidates = materialize(intersect(index, wanted).join(spans, "item").groupBy("text_key")
                             .agg(F.collect_list(F.struct("item", "diagonal", "words", "span")).alias("candidates")),
                             "decon-candidates")
    # Candidates grow with the texts, so this is a sort-merge join at every size.
    placed = (docs.withColumn("key", text_key(F.col("text")))
              .join(candidates.withColumnRenamed("text_key", "key").hint("merge"), "key", "left")
              .withColumn("document", words(F.col("text"))))

    def compared(c: Column) -> Column:
        equal = F.transform(c["words"], lambda w, i: F.when(F.get("document", c["diagonal"] + i) == w, "1").otherwise("0"))
        return F.struct(c["item"].alias("item"), c["diagonal"].alias("diagonal"), c["span"].alias("span"),
                        F.array_join(equal, "").alias("equal"))

    def hits(c: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.length(c["equal"]) - c["span"]),
                          lambda s: F.substr(c["equal"], s + 1, c["span"]) == F.repeat(F.lit("1"), c["span"]))
        return F.struct(c["item"].alias("item"), F.array_distinct(F.flatten(F.transform(starts, lambda s: F.sequence(
            c["diagonal"] + s, c["diagonal"] + s + c["span"] - 1)))).alias("hit"))

    matches = F.filter(F.transform(F.transform("candidates", compared), hits), lambda m: F.size(m["hit"]) > 0)
    return placed.select(*docs.columns, F.size("document").cast("bigint").alias("n_words"), matches.alias("matches"))


def n_hit(matches: Column) -> Column:
    """Words of a text inside any of its matches (null: 0)."""
    return F.coalesce(F.size(F.array_distinct(F.flatten(matches["hit"]))), F.lit(0)).cast("bigint")


def is_contaminated(hit: Column, n_words: Column, share: float = 0.05) -> Column:
    """At least one word hit, and at least ``share`` of all words."""
    return (hit > 0) & (round(1 / share) * hit >= n_words)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_col: str = "item_id",
                         item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs``, all columns, that aren't contaminated."""
    items = test_items(benchmark, item_col, item_text).groupBy("item").agg(F.first("words").alias("words"))
    inner = ["text" if c == text else f"c{i}" for i, c in enumerate(docs.columns)]
    found = overlaps(docs.toDF(*inner), items, window)
    matches = F.when(F.size("matches") > 0, F.col("matches"))
    kept = found.where(~is_contaminated(n_hit(matches), F.col("n_words"), 0.05))
    return kept.select(*inner).toDF(*docs.columns)


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
                  item_col: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``id_col, n_words, n_hit, item_ids`` for every row: the words inside any occurrence of
    a window, and the items (ids as strings, sorted) with an occurring window."""
    tests = test_items(benchmark, item_col, item_text)
    items = tests.groupBy("item").agg(F.first("words").alias("words"))
    names = tests.groupBy("item").agg(F.collect_set("item_id").alias("ids"))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))
    matched = F.when(F.size("matches") > 0, F.col("matches"))
    rows = materialize(overlaps(rows, items, window).withColumn("matches", matched).select(
        "id", "n_words", n_hit(F.col("matches")).alias("n_hit"),
        F.array_sort(F.array_distinct("matches.item")).alias("set")), "decon-hits")
    # Rows without a match have no set; the others meet the id lists of their items by the
    # set of items, which many copies share.
    sets = rows.where("set IS NOT NULL").select("set").distinct()
    ids = (sets.select("set", F.explode("set").alias("item")).join(names, "item")
           .groupBy("set").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("item_ids")))
    none = F.array().cast("array<string>")
    return (rows.join(ids, "set", "left")
            .select(F.col("id").alias(id_col), "n_words", "n_hit", F.coalesce("item_ids", none).alias("item_ids")))
