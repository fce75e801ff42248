"""Decontamination, near-duplicates and substring dedup against brute force."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tallyho.llm import decontaminate, neardup, substrings
from tallyho.llm.common import Words, gram_hashes, materialize, table
from tallyho.llm.fmindex import FMIndex
from tallyho.llm.queries import QUERIES

TEST_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PLAIN = re.compile(r"[^\x20\x09-\x0D]+")
AZ = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_words(text):
    return TEST_WORD.findall((text or "").translate(AZ))


test_words.__test__ = False


def overlap(docs, items, window=13):
    """doc id -> (words, hits, items) by comparing every window."""
    of = defaultdict(set)
    for item, text in items:
        w = test_words(text)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            of[tuple(w[s:s + n])].add(str(item))
    out = {}
    for doc, text in docs:
        w, hit, found = test_words(text), set(), set()
        for n in {len(k) for k in of}:
            for s in range(len(w) - n + 1):
                if (k := tuple(w[s:s + n])) in of:
                    hit |= set(range(s, s + n))
                    found |= of[k]
        out[doc] = (len(w), len(hit), sorted(found))
    return out


def vocabulary(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randrange(1, 5))) for _ in range(n)]


def test_decontamination_by_brute_force(spark, documents):
    rng = random.Random(3)
    vocab = vocabulary(60, 1)
    items = [(i, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 2, 5, 12, 13, 14, 30])))) for i in range(25)]
    items += [(90, items[4][1].upper()), (91, None), (92, " .. "), (93, items[20][1] + "!")]
    texts = [None, "", "!?", *(" ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 80))) for _ in range(60))]
    for i in range(40):
        item = rng.choice(items)[1] or ""
        part = item.split()[rng.randrange(0, 3):]
        texts.append(", ".join([rng.choice(vocab) for _ in range(9)] + part + [rng.choice(vocab)] * rng.randrange(0, 40)).title())
    texts += texts[-5:] + ["zz " * 30_000 + items[22][1]]
    docs = list(enumerate(texts))
    table_ = spark.createDataFrame(items, "item_id bigint, text string")
    for window in (13, 3):
        want = overlap(docs, items, window)
        got = decontaminate.decontaminate(documents(texts), table_, window=window).collect()
        assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in got} == want
    left = decontaminate.without_contaminated(documents(texts), table_)
    assert left.columns == documents([]).columns
    want = overlap(docs, items)
    assert sorted(r.doc_id for r in left.collect()) == [d for d, (n, h, _) in want.items() if not (h and 20 * h >= n)]


def test_decontamination_of_empty_tables(spark, documents):
    none = spark.createDataFrame([], "item_id bigint, text string")
    one = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert [tuple(r)[1:] for r in decontaminate.decontaminate(documents(["a b c"]), none).collect()] == [(3, 0, [])]
    assert decontaminate.decontaminate(documents([]), one).count() == 0
    assert decontaminate.without_contaminated(documents([]), one).count() == 0
    equal = decontaminate.decontaminate(documents(["x a b c"] * 3, ids=[5, 5, 6]), one).collect()
    assert [tuple(r)[1:] for r in equal] == [(4, 3, ["1"])] * 3


def test_proximity_matches(spark, documents):
    docs = documents(["p q alpha x beta gamma r", "alpha beta gamma", "gamma beta alpha"])
    items = materialize(spark.createDataFrame([("i", ["alpha", "beta", "gamma"])], "item string, words array<string>"), "t")
    texts = docs.select("text")
    freq = materialize(decontaminate.term_frequency(texts, items.selectExpr("explode(words) AS term")), "t")
    wanted = decontaminate.phrases(items, freq)
    index = materialize(decontaminate.postings(texts, freq.select("term")), "t")
    assert decontaminate.intersect(index, wanted).count() == 1
    near = decontaminate.intersect(index, wanted, slop=1).select("text_key").distinct()
    assert near.count() == 2


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def varied(rng, words, edits, vocab):
    words = list(words)
    for _ in range(edits):
        at = rng.randrange(len(words) + 1)
        kind = rng.random()
        if kind < 0.4 and words:
            del words[min(at, len(words) - 1)]
        elif kind < 0.7:
            words.insert(at, rng.choice(vocab))
        elif words:
            words[min(at, len(words) - 1)] = rng.choice(vocab)
    return words


def test_banded_distance_by_full_table():
    rng = random.Random(7)
    for _ in range(4000):
        size = rng.choice([2, 3, 6, 30])
        a = [rng.randrange(size) for _ in range(rng.randrange(0, 30))]
        b = varied(rng, a, rng.randrange(0, 9), range(size))
        d, most = distance(a, b), rng.randrange(0, 12)
        assert neardup.edit_distance(a, b, most) == min(d, most + 1)


def test_sketch_by_hand():
    """The smallest occurrence-labelled 5-grams, in text order; one text or many."""
    texts = [b"a b c d e f g a b c d e f g a b c d e", b"one two", b"", b"a b c d e"]
    counts, full, together = neardup.sketches(texts)
    assert list(counts) == [19, 2, 0, 5] and list(full) == [0, 1, 3]
    for i, d in enumerate(full):
        assert (neardup.sketches([texts[d]])[2][0] == together[i]).all()
    w = Words([texts[0]])
    grams = gram_hashes(w.hash, 5)
    seen = Counter()
    labels = []
    for g in grams:
        labels.append(seen[int(g)])
        seen[int(g)] += 1
    assert list(neardup.occurrences(grams, np.zeros(len(grams), int))) == labels and max(labels) == 2
    same_bag = b"f g a b c d e f g a b c d e f g a b c".split()
    assert (neardup.sketches([b" ".join(same_bag)])[2][0] != together[0]).any()  # order matters


@pytest.mark.parametrize("n_words", [60, 300])
def test_sketches_find_pairs_of_the_least_similarity(n_words):
    """Random pairs with a fifth of their words replaced become candidates 95 times in 100."""
    rng = random.Random(n_words)
    vocab = vocabulary(5000, 3)
    texts = []
    for _ in range(300):
        a = [rng.choice(vocab) for _ in range(n_words)]
        b = list(a)
        for i in rng.sample(range(n_words), n_words // 5):
            b[i] = "new" + b[i]
        texts += [" ".join(a).encode(), " ".join(b).encode()]
    values = neardup.sketches(texts)[2]
    assert (values[::2] == values[1::2]).any(axis=1).mean() >= 0.95


def classes_of(texts, ids, least=0.8):
    parent = list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    words = [(t or "").encode().split() for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            longer = max(len(words[i]), len(words[j]))
            if (texts[i] or "") == (texts[j] or "") or \
                    longer and distance(words[i], words[j]) <= int(longer * (1 - least) + 1e-9):
                parent[find(i)] = find(j)
    smallest = {}
    for i, d in enumerate(ids):
        smallest[find(i)] = min(smallest.get(find(i), d), d)
    return {d: smallest[find(i)] for i, d in enumerate(ids)}


def test_near_duplicates_by_brute_force(documents):
    rng = random.Random(11)
    vocab = vocabulary(400, 2)
    texts = [None, "", "  ", "x", "x", "y"]
    for _ in range(8):
        base = [rng.choice(vocab) for _ in range(rng.randrange(40, 120))]
        texts += [" ".join(varied(rng, base, rng.randrange(0, 5), vocab)) for _ in range(rng.randrange(1, 8))]
    passage = [rng.choice(vocab) for _ in range(30)]
    texts += [" ".join([rng.choice(vocab) for _ in range(60)] + passage) for _ in range(12)]  # share a passage only
    texts += [texts[-1]] * 30
    ids = [1000 - i for i in range(len(texts))]
    want = classes_of(texts, ids)
    docs = documents(texts, ids=ids)
    got = neardup.classes(docs).collect()
    assert {r.doc_id: r.class_id for r in got} == want
    sizes = Counter(want.values())
    assert all(r.class_size == sizes[r.class_id] for r in got)
    left = neardup.one_of_each(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(want.values()))


def test_near_duplicates_rest_rounds(documents, monkeypatch):
    """Buckets that hold different groups are searched until nothing is left."""
    rng = random.Random(13)
    vocab = vocabulary(300, 4)
    head = [rng.choice(vocab) for _ in range(30)]
    bases = [head + [rng.choice(vocab) for _ in range(60)] for _ in range(25)]
    texts = [" ".join(varied(rng, b, 1, vocab)) for b in bases for _ in range(3)]
    monkeypatch.setattr(neardup, "SKETCHES", 6)
    monkeypatch.setattr(neardup, "PICKED", 1)
    # one sketch value for all: every text is a candidate of every other
    monkeypatch.setattr(neardup, "bucketed", lambda docs, f=neardup.bucketed: _one_bucket(f(docs)))
    got = {r.doc_id: r.class_id for r in neardup.classes(documents(texts)).collect()}
    assert got == classes_of(texts, list(range(len(texts))))


def test_near_duplicates_rows_of_cells(documents, monkeypatch):
    """Members of a large bucket go to a number of cells that grows with the square root of their number, and
    each two of them still meet."""
    rng = random.Random(29)
    vocab = vocabulary(400, 4)
    head = [rng.choice(vocab) for _ in range(10)]
    texts = [" ".join(head + [rng.choice(vocab) for _ in range(30)]) for _ in range(300)]
    texts += [" ".join(varied(rng, t.split(), 1, vocab)) for t in texts[:20]]
    monkeypatch.setattr(neardup, "BLOCK", 16)
    monkeypatch.setattr(neardup, "bucketed", lambda docs, f=neardup.bucketed: _one_bucket(f(docs)))
    docs, made, write = documents(texts), {}, neardup.materialize
    monkeypatch.setattr(neardup, "materialize", lambda df, label: made.setdefault(label, write(df, label)))
    prints = write(neardup.printed(docs.selectExpr("doc_id AS id", "text")), "prints")
    nodes = prints.selectExpr("node", "n_words", "signature")
    members = neardup.members_of(docs.selectExpr("doc_id AS id", "text"), nodes)
    root = nodes.select("node").selectExpr("node", "node AS root")
    pairs = neardup._rest(members, root, nodes, 0.8)
    rows = made["near-rest"].groupBy("bucket", "blocks").count().collect()
    assert max(r["count"] for r in rows) >= 300
    assert all(r.blocks <= (r["count"] / 16) ** 0.5 + 1 for r in rows)
    got = {(bytes(r.a), bytes(r.b)) for r in pairs.collect()}
    inside = {bytes(r.node) for r in made["near-rest"].select("node").collect()}
    names = [hashlib.md5(t.encode()).digest() for t in texts]
    near = {(max(a, b), min(a, b)) for a, b in zip(names, names[300:]) if a != b and {a, b} <= inside}
    assert len(near) >= 18 and near <= got


def test_near_duplicates_chains_in_one_bucket(documents, monkeypatch):
    """R-A-B, A similar to both, R not to B, R the representative: one class, at equal and at
    growing lengths, and where the rounds of several representatives part A and B."""
    rng = random.Random(17)
    vocab = vocabulary(3000, 5)
    texts = []

    def changed(words, first, n):
        return words[:first] + [rng.choice(vocab) for _ in range(n)] + words[first + n:]

    for _ in range(6):
        while True:
            a = [rng.choice(vocab) for _ in range(50)]
            chain = [changed(a, 5, 8), a, changed(a, 30, 8)]
            chain = [" ".join(w) for w in chain]
            if min(chain, key=lambda t: hashlib.md5(t.encode()).digest()) == chain[0]:
                break
        texts += chain
        a = [rng.choice(vocab) for _ in range(70)]
        texts += [" ".join(w) for w in (a[:59], a, a + [rng.choice(vocab) for _ in range(14)])]
    base = [rng.choice(vocab) for _ in range(60)]
    texts += [" ".join(changed(base, rng.randrange(0, 48), rng.randrange(4, 12))) for _ in range(40)]
    monkeypatch.setattr(neardup, "bucketed", lambda docs, f=neardup.bucketed: _one_bucket(f(docs)))
    for part in (texts[:3], texts):
        got = {r.doc_id: r.class_id for r in neardup.classes(documents(part)).collect()}
        assert got == classes_of(part, list(range(len(part))))


def _one_bucket(found):
    from pyspark.sql import functions as F

    return found.withColumn("buckets", F.array(F.lit(1).cast("bigint")))


@pytest.mark.parametrize("n_words", [2, 4, 5, 6, 8, 10, 15, 20, 25])
def test_short_texts_always_meet(n_words):
    """Whatever the edits, two similar texts share a bucket if one of them is short."""
    rng = random.Random(n_words)
    vocab = vocabulary(40, 3)
    met = 0
    for _ in range(400):
        a = [rng.choice(vocab) for _ in range(n_words)]
        b = varied(rng, a, rng.randrange(0, n_words // 4 + 1), vocab)
        if b and distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9):
            x, y = (set(neardup.segments(Words([" ".join(w).encode()]).hash)) for w in (a, b))
            assert x & y
            met += 1
    assert met > 50


def test_signatures_bound_the_distance():
    rng = random.Random(8)
    vocab = vocabulary(300, 4)
    for _ in range(300):
        a = [rng.choice(vocab) for _ in range(rng.randrange(1, 200))]
        b = varied(rng, a, rng.randrange(0, 30), vocab)
        x, y = neardup.signatures(Words([" ".join(a).encode(), " ".join(b).encode()]))
        assert sum(int(v).bit_count() for v in x ^ y) <= 2 * distance(a, b)


def test_members_that_signatures_part_never_meet(documents, monkeypatch):
    """Half with 3 of 100 words changed and half with 30: no pair of the two halves is made but with a
    representative, far fewer than their product."""
    rng = random.Random(5)
    vocab = vocabulary(4000, 6)
    base = [rng.choice(vocab) for _ in range(100)]
    texts = []
    for i in range(60):
        w = list(base)
        for k in rng.sample(range(100), 3 if i % 2 else 30):
            w[k] = rng.choice(vocab)
        texts.append(" ".join(w))
    made = []
    plain = neardup.materialize
    monkeypatch.setattr(neardup, "materialize", lambda df, label: made.append((label, plain(df, label))) or made[-1][1])
    got = {r.doc_id: r.class_id for r in neardup.classes(documents(texts)).collect()}
    assert len({got[i] for i in range(1, 60, 2)}) == 1
    assert sum(df.count() for label, df in made if label == "near-across") < 30 * 30 / 10


def test_signatures_part_long_texts_of_one_passage():
    """A passage repeated 300 times in texts that are otherwise different doesn't make them alike."""
    texts = [" ".join(["Is", "so."] * 300 + [f"w{i}.{k}" for k in range(330)]).encode() for i in range(8)]
    marks = neardup.signatures(Words(texts))
    for i in range(8):
        for j in range(i):
            assert sum(int(v).bit_count() for v in marks[i] ^ marks[j]) > 2 * 0.2 * 930


def test_cells_give_the_alike_pairs_of_different_classes():
    rng = random.Random(10)
    vocab = vocabulary(500, 6)
    bases = [[rng.choice(vocab) for _ in range(60)] for _ in range(4)]
    texts = [" ".join(varied(rng, bases[i % 4], 3, vocab)).encode() for i in range(24)]
    words = Words(texts)
    marks = neardup.signatures(words)
    rows = [{"own": i // 12, "node": bytes([i]), "n_words": int(words.counts[i]), "root": bytes([i % 3]),
             "signature": marks[i].astype(np.int64).tolist()} for i in range(24)]
    for two in (False, True):
        got = neardup._cell_pairs(pa.array(rows), two, 0.8)
        want = set()
        for i in range(24):
            for j in range(i):
                n, m = rows[i]["n_words"], rows[j]["n_words"]
                bits = sum(int(v).bit_count() for v in marks[i] ^ marks[j])
                if (i % 3 != j % 3 and (not two or i // 12 != j // 12) and min(n, m) >= 0.8 * max(n, m)
                        and bits + abs(n - m) <= 0.4 * max(n, m)):
                    want.add((bytes([i]), bytes([j]), n, m, bits))
        assert want and set(got) == want and len(got) == len(want)


def test_near_duplicates_edge_cases(documents):
    assert neardup.classes(documents([])).count() == 0
    assert neardup.one_of_each(documents([])).count() == 0
    equal = documents(["same text here"] * 4 + ["other"], ids=[3, 3, 2, 2, 9])
    assert {(r.doc_id, r.class_id, r.class_size) for r in neardup.classes(equal).collect()} == {(3, 2, 4), (2, 2, 4), (9, 9, 1)}
    assert sorted(r.doc_id for r in neardup.one_of_each(equal).collect()) == [2, 9]


def test_components_of_long_chains(spark):
    edges = [(f"n{i:03}", f"n{i + 1:03}") for i in range(60)] + [("z2", "z1"), ("z3", "z2"), ("z1", "z3")]
    df = spark.createDataFrame([(a.encode(), b.encode()) for a, b in edges], "a binary, b binary")
    got = {bytes(r.node).decode(): bytes(r.root).decode() for r in neardup.components(df).collect()}
    assert got == {f"n{i:03}": "n000" for i in range(61)} | {f"z{i}": "z1" for i in (1, 2, 3)}


def removed(docs, window=13):
    """doc id -> (words, removed, kept) by the rule's own words."""
    words = {d: PLAIN.findall(t or "") for d, t in docs}
    first = {}
    for d, w in sorted(words.items()):
        for s in range(len(w) - window + 1):
            first.setdefault(tuple(w[s:s + window]), d)
    out = {}
    for d, w in words.items():
        gone = set()
        for s in range(len(w) - window + 1):
            if first[tuple(w[s:s + window])] < d:
                gone |= set(range(s, s + window))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substrings_by_brute_force(documents, monkeypatch, seed):
    rng = random.Random(seed)
    vocab = vocabulary(5 if seed == 1 else 50, seed)
    passages = [[rng.choice(vocab) for _ in range(rng.randrange(10, 40))] for _ in range(6)]
    texts = [None, "", " ", "a b c"]
    for _ in range(70):
        w = []
        for _ in range(rng.randrange(0, 6)):
            w += [rng.choice(vocab) for _ in range(rng.randrange(0, 25))] if rng.random() < 0.6 else rng.choice(passages)
        texts.append(rng.choice([" ", "\n", " \t"]).join(w))
    texts += [texts[20]] * 5 + ["loop " * 400, "loop " * 300]
    ids = rng.sample(range(-500, 500), len(texts))
    monkeypatch.setattr(substrings, "GROUP_BYTES", 2_000)  # many groups
    got = substrings.remove_repeats(documents(texts, ids=ids)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got} == removed(list(zip(ids, texts)))
    assert all(r.kept_sha256 == hashlib.sha256(r.kept.encode()).hexdigest() for r in got)


def test_substrings_edge_cases(documents):
    assert substrings.remove_repeats(documents([])).count() == 0
    text = " ".join(f"w{i}" for i in range(20))
    same = substrings.remove_repeats(documents([text] * 3, ids=[4, 4, 7])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in same) == [(4, 0), (4, 0), (7, 20)]


def test_fm_index_by_scanning():
    rng = np.random.default_rng(4)
    runs = [rng.integers(1, 6, rng.integers(13, 40)) for _ in range(40)]
    text = np.concatenate([np.append(r, 0) for r in runs])
    index = FMIndex(text)
    ends, at = [], 0
    for r in runs:
        ends += range(at + 12, at + len(r))
        at += len(r) + 1
    matched, low, high = index.matching(np.array(ends), 13)
    for e, n, a, b in zip(ends, matched, low, high):
        def times(k):
            p = text[e - k + 1:e + 1]
            return sum((text[i:i + k] == p).all() for i in range(len(text) - k + 1))

        longest = max((k for k in range(1, 14) if times(k) > 1), default=0)
        assert n == longest
        if n:
            assert b - a == times(n) and (e - n + 1) in index.suffixes[a:b]


def test_queries_on_the_small_tables(spark, sf):
    """Classes equal those of comparing all pairs whose word bags allow a link."""
    docs = [(r.doc_id, r.text or "") for r in table(spark, sf, "documents").collect()]
    got = {r.doc_id: r.class_id for r in QUERIES["op10_minhash"](spark, sf).collect()}
    words = [t.encode().split() for _, t in docs]
    parent = list(range(len(docs)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            small, large = sorted((len(words[i]), len(words[j])))
            if docs[i][1] == docs[j][1] or small >= 0.8 * large > 0 and neardup.similarity(
                    docs[i][1].encode(), docs[j][1].encode()) is not None:
                parent[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(docs):
        smallest[find(i)] = min(smallest.get(find(i), d), d)
    assert got == {d: smallest[find(i)] for i, (d, _) in enumerate(docs)}
