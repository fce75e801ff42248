import random
from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry
from tallyho.llm import decontaminate, mixing, neardup, sharding
from tallyho.llm.common import materialize, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_registry_has_every_operator():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert names["pipeline"] is corpus_pipeline.run and set(entry.oracle_sql()) <= set(names)


def test_stages_on_the_small_tables(spark, sf):
    docs = table(spark, sf, "documents")
    before = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        after = materialize(stage(spark, before, sf), f"test-{name}")
        assert after.columns == (COLUMNS if i < 4 else [*COLUMNS, "shard"])
        if name in ("quality", "near_duplicates", "decontamination"):
            assert after.exceptAll(before).isEmpty()  # whole rows, none twice
        if name == "near_duplicates":
            kept = {r.doc_id for r in after.collect()}
            assert kept == {r.class_id for r in neardup.classes(before).collect()}
        if name == "decontamination":
            found = decontaminate.decontaminate(before, table(spark, sf, "benchmark"))
            clean = found.where("NOT (n_hit > 0 AND 20 * n_hit >= n_words)")
            assert sorted(r.doc_id for r in clean.collect()) == sorted(r.doc_id for r in after.collect())
        if name == "mixing":
            want = {r.doc_id: r.copies for r in mixing.mix(before).collect() if r.copies}
            assert Counter(r.doc_id for r in after.collect()) == want
        if name == "sharding":
            want = Counter((r.doc_id, r.shard) for r in sharding.shard(before, shards=40).collect())
            assert Counter((r.doc_id, r.shard) for r in after.collect()) == want
        before = after


def test_stages_with_odd_rows(spark, sf, documents):
    """Nulls, empty and long texts, repeated rows and further columns, through every stage."""
    rng = random.Random(1)
    texts = [None, "", "same", "same", "same", "long " * 20_000] + [
        " ".join("".join(rng.choice("abcdefg") for _ in range(4)) for _ in range(30)) for _ in range(6)]
    docs = documents(texts, ids=[1, 2, 3, 3, None, 4, 5, 6, 7, 8, 9, 9], sources=["a"] * 6 + [None] * 6)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        assert out.columns[:len(docs.columns)] == docs.columns
        assert set(r.doc_id for r in out.collect()) <= {None, *range(1, 10)}
        assert stage(spark, docs.limit(0), sf).count() == 0
