"""Byte-level BPE against the tokenizer library and exact round trips."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tallyho.llm import bytepair as B

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = B.read_ranks(PATH)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=B.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def odd_texts() -> list[str]:
    draw = random.Random(5)
    letters = "ab1 \n\t'sstmdrevlé中²½٣.,!- 　​\U0001d4b3\U0001f600\x00\x1c\x85"
    return ["".join(draw.choice(letters) for _ in range(draw.randint(0, 16))) for _ in range(3000)]


def test_pattern_is_the_vocabularies():
    assert B.PATTERN == public_tokenizers.PATTERN


def test_cut_equals_the_pattern():
    texts = odd_texts() + ["", "   ", "x", " ", "\n", "don't 's they'll''ve 'rest"]
    cut = B.Cut([t.encode() for t in texts])
    got: list[list[str]] = [[] for _ in texts]
    for i in range(len(cut)):
        got[cut.document[i]].append(cut.word(i).decode())
    pattern = regex.compile(B.PATTERN)
    assert got == [pattern.findall(t) for t in texts]


def test_every_code_point_has_the_class_of_the_pattern():
    pattern = regex.compile(B.PATTERN)
    texts = ["a" + chr(c) + "a1" + chr(c) + "1!" + chr(c) + "! " + chr(c) + " "
             for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3200 or c % 7 == 0)]
    for a in range(0, len(texts), 20_000):
        cut = B.Cut([t.encode() for t in texts[a:a + 20_000]])
        assert [cut.word(i).decode() for i in range(len(cut))] == [w for t in texts[a:a + 20_000] for w in pattern.findall(t)]


def test_long_words_by_the_heap(library):
    draw = random.Random(3)
    for text in ("a" * 1000, "ab" * 700, "".join(draw.choice("abcdef") for _ in range(3000)), "é" * 500):
        assert B.merge(text.encode(), RANKS) == library.encode_ordinary(text)


@pytest.mark.parametrize("most", [0, 50, B.CACHED])
def test_encode_equals_the_library_for_any_table(spark, library, most):
    draw = random.Random(11)
    words = ["".join(draw.choice("abcdefghijklmnopéß") for _ in range(draw.randint(1, 12))) for _ in range(300)]
    texts = odd_texts()[:200] + [" ".join(draw.choice(words) for _ in range(60)) for _ in range(20)]
    texts += [None, "", "x" * 5000, "=" * 129 + " y", "<|endoftext|>", texts[-1], texts[-1]]
    rows = [(i, t, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    coded = B.encode(df.select("doc_id", "text", F.col("ids").alias("gaps")), "text", PATH, most=most)
    assert coded.columns == ["doc_id", "gaps", "ids"]
    found = {r.doc_id: (r.ids, bytes(r.decoded)) for r in B.decode(coded, "ids", PATH).collect()}
    assert found == {i: (library.encode_ordinary(t or ""), (t or "").encode()) for i, t, _ in rows}


def test_empty_table_and_clashing_names(spark):
    empty = spark.createDataFrame([], "c0 long, text string, out string")
    coded = B.decode(B.encode(empty, "text", PATH), "ids", PATH)
    assert coded.columns == ["c0", "out", "ids", "decoded"] and coded.count() == 0
    one = spark.createDataFrame([(1, "a b", "x")], "c1 long, text string, word string")
    assert [tuple(r)[:2] for r in B.encode(one, "text", PATH, out="c0").collect()] == [(1, "x")]


def test_decoding_an_unknown_id_raises(spark):
    with pytest.raises(Exception, match="KeyError"):
        B.decode(spark.createDataFrame([([70000],)], "ids array<int>"), "ids", PATH).collect()


def test_query_on_the_small_table(spark, library):
    from tallyho.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    import hashlib

    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    found = QUERIES["op13_byte_bpe"](spark, sf).collect()
    assert len(found) == len(docs)
    for r in found:
        ids = library.encode_ordinary(docs[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
