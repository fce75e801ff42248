import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallyho.llm import fingerprint, mixing, sharding
from tallyho.llm.common import table
from tallyho.llm.queries import QUERIES

TEXTS = [None, "", "ab", "one two three", "one two three", "é" * 5000, "The quick brown fox jumps. " * 50]


def edited(rows):
    """(id, text) in descending order to the edited text of each."""
    rows = sorted(rows, key=lambda r: (r[0], r[1]), reverse=False)
    rows = sorted(rows, key=lambda r: -r[0])
    out = {}
    for i, (doc, text) in enumerate(rows):
        after, k = rows[(i + 1) % len(rows)][1], len(text) // 3
        out[doc] = text[:len(text) - k] + after[:k]
    return out


def test_fingerprint_query_by_brute_force(spark, sf):
    docs = [(r.doc_id, r.text or "") for r in table(spark, sf, "documents").collect()]
    want, got = edited(docs), QUERIES["op3_fingerprints"](spark, sf).collect()
    assert len(got) == len(docs)
    text = dict(docs)
    one = lambda t: fingerprint.encode(fingerprint.digests([t.encode()]))[0]
    for r in got:
        assert r.n_chars == len(text[r.doc_id])
        assert r.edited_sha256 == hashlib.sha256(want[r.doc_id].encode()).hexdigest()
        assert r.fingerprint == one(text[r.doc_id]) and r.edited_fingerprint == one(want[r.doc_id])
        assert 0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1
    assert np.mean([r.near_edited > r.near_next for r in got]) > 0.95


def test_triplet_counts_by_hand():
    text = bytes(range(40)) * 3
    counts = Counter()
    for s, (i, j, k) in enumerate(fingerprint.SHAPES):
        for at in range(len(text) - k):
            value = np.array([text[at + i] | text[at + j] << 8 | text[at + k] << 16 | s << 24], np.uint64)
            counts[int(fingerprint.mix(value)[0] >> np.uint64(50)) % fingerprint.BUCKETS] += 1
    full = np.array([counts[b] for b in range(fingerprint.BUCKETS)])
    ranked = np.sort(full)
    code = sum((full > ranked[fingerprint.BUCKETS * q // 4 - 1]).astype(int) for q in (1, 2, 3))
    for others in ([], [b""], [b"xy" * 99]):
        assert (fingerprint.digests([*others, text])[-1, :-1] == code).all()


def test_fingerprint_edge_cases(documents):
    got = fingerprint.successor_report(documents(TEXTS)).collect()
    want = edited(list(enumerate(t or "" for t in TEXTS)))
    assert {r.doc_id: r.edited_sha256 for r in got} == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in want.items()}
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[3] == prints[4] and prints[0] == prints[1]
    alone = fingerprint.successor_report(documents(["abcdef"])).collect()
    assert alone[0].edited_sha256 == hashlib.sha256(b"abcdab").hexdigest()
    assert fingerprint.successor_report(documents([])).count() == 0
    out = fingerprint.with_fingerprint(documents(TEXTS))
    assert out.columns[-1] == "fingerprint" and {r.doc_id: r.fingerprint for r in out.collect()} == prints


def targets(sizes):
    """Source targets by reshaping step by step."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = dict(zip(names, (5, 2, 1) * len(names)))
    left, open_, out = 1.5 * sum(sizes.values()), set(names), dict.fromkeys(names, 0.0)
    while open_ and left > 1e-9:
        total = sum(weight[s] for s in open_)
        add = {s: left * weight[s] / total for s in open_}
        left = 0.0
        for s in list(open_):
            out[s] += add[s]
            if out[s] > 2 * sizes[s]:
                left += out[s] - 2 * sizes[s]
                out[s] = 2.0 * sizes[s]
                open_.discard(s)
    return out


def test_mixing_follows_targets(spark, sf):
    docs = {r.doc_id: r for r in table(spark, sf, "documents").collect()}
    got = QUERIES["op4_mixing"](spark, sf).collect()
    again = {r.doc_id: r.taken for r in QUERIES["op4_mixing"](spark, sf).collect()}
    sizes, taken = Counter(), Counter()
    for r in got:
        assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        assert r.taken <= 2 * r["size"] and again[r.doc_id] == r.taken
        sizes[docs[r.doc_id].source] += r["size"]
        taken[docs[r.doc_id].source] += r.taken
    want = targets(sizes)
    for r in got:
        s = docs[r.doc_id].source
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
    largest = max(r["size"] for r in got)
    assert all(abs(taken[s] - want[s]) <= 2 * largest for s in sizes)


def test_mixing_edge_cases(documents):
    texts = ["a b c", "a b c", None, "", "d", "e f\x0bg", "h i"]
    docs = documents(texts, sources=["x", "x", "x", "y", None, "z", "z"])
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    want = targets({"x": 6, "y": 0, None: 1, "z": 5})
    for i, s in enumerate(["x", "x", "x", "y", None, "z", "z"]):
        assert got[i].target == pytest.approx(want[s]) and got[i].copies <= 2
    assert got[2]["size"] == got[3]["size"] == 0 and got[3].copies == 0 and got[5]["size"] == 3
    whole = mixing.mixture(docs)
    assert whole.columns == docs.columns
    counts = Counter(r.doc_id for r in whole.collect())
    assert {i: counts[i] for i in got} == {i: r.copies for i, r in got.items()}
    assert mixing.mix(documents([])).count() == 0 and mixing.mixture(documents([])).count() == 0


def test_mixture_of_equal_rows(documents):
    docs = documents(["a b"] * 4, ids=[1, 1, 1, 2])
    copies = sum(r.copies for r in mixing.mix(docs).collect())
    assert mixing.mixture(docs).count() == copies


def test_mixing_plan_is_native(spark, sf):
    plan = mixing.mix(table(spark, sf, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan


def test_sharding_query(spark, sf):
    docs = {r.doc_id: r.text or "" for r in table(spark, sf, "documents").collect()}
    got = QUERIES["op9_sharding"](spark, sf).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    slots = {}
    for r in got:
        assert r["size"] == len(docs[r.doc_id].encode()) + 16 and r.text_crc32 == zlib.crc32(docs[r.doc_id].encode())
        assert 0 <= r.shard < 40 and r.law == "bytes" and r.grown_shard is None
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_sharding_balances_bytes_and_keeps_groups(documents):
    rng = np.random.default_rng(5)
    texts = ["w" * int(n) + str(i) for i, n in enumerate(rng.integers(50, 150, 1500))] + ["copy of a text " * 6] * 700
    docs = documents(texts)
    rows = sharding.shard(docs, shards=7).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r["size"]
    mean = sum(sizes.values()) / 7
    assert len(sizes) == 7 and max(abs(v - mean) for v in sizes.values()) < 0.03 * mean
    small = documents([f"text {i % 300}" * 4 for i in range(900)])
    home = {}
    for r in sharding.shard(small, shards=4).collect():
        home.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) > 1 for s in home.values()) <= 3  # at most a group per cut
    out = sharding.with_shard(docs, shards=7)
    assert out.columns == [*docs.columns, "shard"]
    assert {r.doc_id: r.shard for r in out.collect()} == {r.doc_id: r.shard for r in rows}


def test_sharding_edge_cases(documents):
    rows = sharding.shard(documents(TEXTS), shards=40).collect()
    assert len(rows) == len(TEXTS) and all(0 <= r.shard < 40 for r in rows)
    assert sharding.shard(documents([]), shards=3).count() == 0
    assert sharding.with_shard(documents([])).count() == 0
    same = sharding.shard(documents(["x"] * 5, ids=[1] * 5), shards=3).collect()
    assert len({r.shard for r in same}) == 1 and sorted(r.slot for r in same) == list(range(5))
    by_bytes = sharding.shard(documents(["abc"] * 10), target_bytes=38).collect()
    assert len({r.shard for r in by_bytes}) == 5


def test_sharding_rounds_send_no_tables(documents, monkeypatch):
    """Rounds and levels put the nodes' few numbers into the plan: no table from the driver, join or broadcast."""
    docs = documents([f"text {i} " * (i % 7 + 1) for i in range(300)] + ["copy"] * 100)

    def refuse(*_, **__):
        raise AssertionError("a round made a table on the driver")

    plans, plain = [], sharding.materialize
    monkeypatch.setattr(type(docs.sparkSession), "createDataFrame", refuse)
    monkeypatch.setattr(sharding, "materialize", lambda df, label: plans.append(
        df._jdf.queryExecution().optimizedPlan().toString()) or plain(df, label))
    shards = Counter(r.shard for r in sharding.with_shard(docs, shards=7).collect())
    assert sum(shards.values()) == 400 and set(shards) == set(range(7))
    assert len(plans) > 3 and not any("Join" in p for p in plans)
