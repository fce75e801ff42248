import functools
import zlib

import numpy as np
import pytest

from tallyho.llm import language, quality
from tallyho.llm.common import table
from tallyho.llm.queries import QUERIES

ODD = [None, "", "  \n\t", "12 34 !!", "x" * 200_000, "the of and", "the of and", "été à la", "é"]


def test_language_query_held_out_accuracy(spark, sf):
    got = {r.doc_id: r for r in QUERIES["op1_language_id"](spark, sf).collect()}
    docs = table(spark, sf, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 4 == 2)
        assert 0 <= got[d.doc_id].score <= 1
    held = [d for d in docs if got[d.doc_id].held_out]
    assert np.mean([got[d.doc_id].lang_pred == d.lang for d in held]) >= 0.97


def test_language_edge_cases(documents):
    train = documents(["the of and that", "le la les des", None, "der die das"], langs=["en", "fr", "en", None])
    model = language.train(train)
    assert model.labels == ["en", "fr"]
    got = language.predict(documents(ODD), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got[:4]] == ["und"] * 4 and all(r.score == 0 for r in got[:4])
    assert got[5].lang_pred == "en" and got[5][1:] == got[6][1:]
    assert got[7].lang_pred == "fr"
    empty = language.train(train.limit(0))
    assert {r.lang_pred for r in language.predict(documents(ODD), empty).collect()} == {"und"}
    assert language.predict(documents([]), model).count() == 0


def test_ngrams_match_a_plain_count():
    texts = ["Abc 1b", "", "b"]
    ids, starts, _ = language.ngram_ids([t.lower() for t in texts])
    ends = [*starts[1:], len(ids)]
    for t, a, b in zip(texts, starts, ends):
        n = sum(max(0, len(t) - k + 1) for k in language.NGRAMS)
        assert (ids[a:b] < language.BUCKETS).sum() == n


def test_score_does_not_depend_on_the_batch():
    model = language.Model(["a", "b"], np.random.default_rng(0).normal(size=(language.BUCKETS + 1, 2)), np.zeros(2))
    model.log_prob[-1] = 0
    texts = ["some text", "another é", "third"]
    together = language.score_texts(texts, model)
    for i, t in enumerate(texts):
        names, scores = language.score_texts([t], model)
        assert names[0] == together[0][i] and scores[0] == together[1][i]


def test_quality_query_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op6_quality"](spark, sf).collect()}
    assert len(got) == table(spark, sf, "documents").count()
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    right = [got[i].predicted == q for i, q in labels.items() if i in got and got[i].held_out]
    assert np.mean(right) >= 0.95
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in got.items())


def test_quality_edge_cases(spark, documents):
    docs = documents(["the good words here"] * 30 + ["BAD!! STUFF!! $$$"] * 30)
    labels = spark.createDataFrame([(i, int(i < 30)) for i in range(60)] + [(3, None), (None, 1)], "doc_id bigint, quality int")
    model = quality.fit(docs, labels)
    out = quality.with_score(documents(ODD + ["good words", "BAD!! $$$"]), model)
    assert out.columns.count("score") == 1 and "n" in out.columns  # replaced; others are carried along
    got = out.orderBy("doc_id").collect()
    assert all(0 <= r.score <= 1 for r in got)
    assert got[-2].score > 0.5 > got[-1].score
    one = quality.fit(docs, labels.where("quality = 1"))
    assert {r.score for r in quality.with_score(docs, one).collect()} == {1.0}
    none = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.with_score(docs, none).collect()} == {0.5}
    assert quality.with_score(docs.limit(0), model).count() == 0


def test_context_sums_by_hand():
    index = quality.index_vectors()
    texts = [b"a b c a", b"b"]
    ids, counts = quality.tokens(texts)
    assert list(counts) == [4, 1]
    want = np.zeros((quality.VOCABULARY, quality.WIDTH))
    at = 0
    for n in counts:
        own = ids[at:at + n]
        for i in range(n):
            for j in range(max(0, i - quality.REACH), min(n, i + quality.REACH + 1)):
                if i != j:
                    want[own[i]] += index[own[j]]
        at += n
    sums, seen = quality.context_sums(texts, index)
    assert np.allclose(sums, want) and seen.sum() == 5 and seen[ids[1]] == 2


@pytest.mark.parametrize("text", [b"Hello, wor\xc3\xa9ld 42!!"])
def test_tokens_split_by_kind(text):
    assert list(quality.tokens([text])[1]) == [5]


def _grams(text):
    """Buckets of the plain n-grams of a text: lower case, ASCII but letters as spaces."""
    t = "".join(c if ord(c) > 127 or c.isalpha() else " " for c in text.lower())
    return [_bucket(t[i:i + n]) for n in language.NGRAMS for i in range(len(t) - n + 1)]


@functools.cache
def _bucket(gram):
    return int(language.ngram_ids([gram])[0][0][len(gram) - 1])


def test_language_equals_plain_naive_bayes(spark):
    import math
    import random
    from collections import Counter

    draw = random.Random(3)
    alphabets = {"xx": "abcde ", "yy": "cdefgé ", "zz": "fghi中 "}
    rows = [(i, "".join(draw.choice(alphabets[k]) for _ in range(draw.randint(5, 40))), k) for i, k in enumerate(list(alphabets) * 30)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    counts = {k: Counter(g for _, t, label in rows if label == k for g in _grams(t)) for k in alphabets}
    totals = {k: math.log(sum(c.values()) + language.SMOOTHING * language.BUCKETS) for k, c in counts.items()}
    asked = [(i, "".join(draw.choice("abcdefghié中 .7") for _ in range(draw.randint(1, 30)))) for i in range(80)]
    found = language.predict(spark.createDataFrame(asked, "doc_id long, text string"), model).collect()
    texts = dict(asked)
    for r in found:
        if not any(c.isalpha() for c in texts[r.doc_id]):
            assert (r.lang_pred, r.score) == (language.UNDETERMINED, 0.0)
            continue
        grams = _grams(texts[r.doc_id])
        like = {k: sum(math.log(c[g] + language.SMOOTHING) - totals[k] for g in grams) for k, c in counts.items()}
        best = max(like, key=lambda k: like[k])  # equal priors
        soft = {k: math.exp((like[k] - like[best]) / math.sqrt(max(1, len(grams)))) for k in like}
        assert r.lang_pred == best and abs(r.score - soft[best] / sum(soft.values())) < 1e-9


@pytest.mark.parametrize("text", ["½ ² Ⅷ ①", "123 _", "\u0301", "", None])
def test_texts_without_letters_have_no_language(spark, text):
    model = language.train(spark.createDataFrame([(1, "abc", "xx")], "doc_id long, text string, lang string"))
    row = language.predict(spark.createDataFrame([(1, text)], "doc_id long, text string"), model).first()
    assert (row.lang_pred, row.score) == (language.UNDETERMINED, 0.0)


def test_too_many_labels_raise(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_LABELS", 1)
    with pytest.raises(ValueError, match="labels"):
        language.train(spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "doc_id long, text string, lang string"))
