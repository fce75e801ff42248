"""Near-duplicates by order MinHash, verified by banded alignment.

Texts are sequences of words ``[^\\x20\\x09-\\x0D]+``; a k-mer is ``K`` = 5 consecutive
words (all words of a shorter text) labelled with how often it occurred before in its
text.  Each of ``SKETCHES`` hash functions picks the ``PICKED`` smallest labelled k-mers and
keeps them in text order; texts that agree in one sketch are candidates.  A candidate
pair is a link if its word edit distance, aligned in a band of diagonals, is at
most a fifth of the longer text: similarity 0.8 or more.

Sketches of few k-mers miss much, so texts of up to ``SHORT`` words are found exactly: with at most
e edits between them, of e + 1 segments of the shorter one is one left whole in the other, moved by no
more than the edits before and behind it.  Segments, by length, number and place, are buckets like
sketches.

Groups of copies stay cheap: equal texts are one node (their md5), and a bucket's texts are first
compared with the bucket's smallest node only.  Pairs whose *signatures* differ too much are
never verified: a signature has a bit for every value that the hash of a word and its
occurrence can take (whether an odd number has it, so long texts don't fill it), one edit changes two of them at most,
so no link is lost.  After that, members of a bucket
need to meet only if their classes differ.  Those in the smallest node's class meet the others if the bits in
which both differ from it leave that possible (``_across``); the others meet each other in cells of two blocks, where
signatures are compared as matrices (``_rest``): nothing is capped, and only pairs that are alike become rows.
Only texts of the pairs that are left are read again.  Classes are the connected components of the links,
found by star contraction on written tables; nothing of them reaches the driver.

Defined cases: a null text is the empty text; texts without words are near-duplicates of
equal texts only; equal rows are in one class; ids may repeat or be null (a class's
id is its smallest id, null if all are); an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyho.llm.common import U64, Words, batches, decided, gram_hashes, materialize, mix, mix_into, text_key, utf8

K = 5
SIMILARITY = 0.8
SKETCHES = 160              # find 95 % of pairs even at the least similarity
PICKED = 2
SHORT = 25                  # words of texts that are found by equal segments instead of sketches
SIGNATURE = 32              # 64-bit words of a text's signature
BLOCK = 1024                # members of a bucket up to which it is one block; above, blocks grow too
SMALL_BYTES = 16 << 20      # of keys (or half as many of texts) that are sent to all tasks
_TOP = U64(0xFFFFFFFFFFFFFFFF)


def kmers(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of every k-mer, document by document; the documents that have any; their starts."""
    counts = words.counts
    n = np.where(counts >= K, counts - K + 1, (counts > 0).astype(int))
    full = np.flatnonzero(n)
    starts = np.concatenate(([0], np.cumsum(n[full])[:-1])) if len(full) else np.zeros(0, int)
    runs = gram_hashes(words.hash, K)
    at = np.repeat(words.first[full] - starts, n[full]) + np.arange(n.sum())
    out = runs[np.minimum(at, len(runs) - 1)] if len(runs) else np.zeros(len(at), U64)
    for d, s in zip(full, starts):
        if counts[d] < K:  # the whole text is its only k-mer
            own = words.hash[words.first[d]:words.first[d + 1]]
            out[s] = gram_hashes(own, len(own))[0] + U64(len(own))
    return out, full, starts


def occurrences(grams: np.ndarray, document: np.ndarray) -> np.ndarray:
    """How often each k-mer occurred before in its document."""
    out = np.zeros(len(grams), np.int64)
    key = mix(grams ^ mix(document.astype(U64) + U64(1)))
    ordered = np.sort(key)
    repeated = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if len(repeated):
        at = np.minimum(np.searchsorted(repeated, key), len(repeated) - 1)
        again = np.flatnonzero(repeated[at] == key)
        order = again[np.argsort(key[again], kind="stable")]
        new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
        first = np.flatnonzero(new)
        out[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.concatenate((first, [len(order)]))))
    return out


def sketches(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word counts of the texts; the texts with words; one row of ``SKETCHES`` values for each of those."""
    words = Words(texts)
    grams, full, starts = kmers(words)
    out = np.zeros((len(full), SKETCHES), U64)
    if len(full):
        sizes = np.diff(np.concatenate((starts, [len(grams)])))
        document = np.repeat(np.arange(len(full)), sizes)
        labelled = mix(grams + mix(occurrences(grams, document).astype(U64)))
        bits = U64(len(grams)).item().bit_length()
        place, above = np.arange(len(grams), dtype=U64), _TOP ^ U64((1 << bits) - 1)
        rank, half = np.empty_like(labelled), np.empty_like(labelled)
        for j in range(SKETCHES):
            np.bitwise_xor(labelled, mix(np.array([j + 1], U64)), out=rank)
            mix_into(rank, half)
            rank &= above  # the lowest bits, which hardly ever decide, are a k-mer's place
            rank |= place
            picked = np.full((len(full), PICKED), len(grams))
            for i in range(PICKED):
                least = np.minimum.reduceat(rank, starts)
                there = np.flatnonzero(least != _TOP)  # a text with fewer k-mers has no more
                at = (least[there] & ~above).astype(np.int64)
                picked[there, i] = at
                rank[at] = _TOP
            picked.sort(axis=1)
            value = np.full(len(full), j, U64)
            for i in range(PICKED):
                there = picked[:, i] < len(grams)
                value = mix(value * U64(31) + np.where(there, grams[np.minimum(picked[:, i], len(grams) - 1)], U64(0)))
            out[:, j] = value
    return words.counts, full, out


def edit_distance(a: list, b: list, most: int) -> int:
    """Edit distance of two sequences if it is at most ``most``, else ``most + 1``.

    Bit-parallel columns of a band of ``2 * most + 1`` diagonals, shifted by one row per
    column; the distance is followed down the main diagonal, then along the last row."""
    lo, end_a, end_b = 0, len(a), len(b)
    while lo < end_a and lo < end_b and a[lo] == b[lo]:
        lo += 1
    while end_a > lo and end_b > lo and a[end_a - 1] == b[end_b - 1]:
        end_a, end_b = end_a - 1, end_b - 1
    a, b = a[lo:end_a], b[lo:end_b]
    if len(a) > len(b):
        a, b = b, a
    m, n = len(a), len(b)
    if n - m > most:
        return most + 1
    if m == 0:
        return n
    most_here = min(most, n)
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    band = (1 << (2 * most_here + 1)) - 1
    up, down, distance = band >> most_here << most_here, 0, 0  # vertical steps +1 and -1
    for j, x in enumerate(b, 1):
        same = where.get(x, 0)
        shift = j - most_here - 1
        same = (same >> shift if shift >= 0 else same << -shift) & band
        diagonal = ((((same & up) + up) ^ up) | same | down) & band
        right = down | (band & ~(diagonal | up))
        left = diagonal & up
        if j <= m:
            distance += not diagonal >> most_here & 1
            if distance - (n - m) > most:
                return most + 1
        else:
            at = m - j + most_here
            distance += (right >> at & 1) - (left >> at & 1)
        moved = diagonal >> 1
        up, down = left | (band & ~(moved | right)), moved & right
    return min(distance, most + 1)


def similarity(a: bytes, b: bytes, least: float = SIMILARITY) -> float | None:
    """1 - edit distance / longer length over words, or None below ``least``.  A narrow band
    is tried first: most candidates are close."""
    x, y = a.split(), b.split()
    longer = max(len(x), len(y))
    if not longer:
        return None
    most = int(longer * (1 - least) + 1e-9)
    if longer - sum((Counter(x) & Counter(y)).values()) > most:  # too few words in common
        return None
    for limit in sorted({min(most, max(4, longer // 50)), most}):
        d = edit_distance(x, y, limit)
        if d <= limit:
            return 1 - d / longer
    return None


def segments(words: np.ndarray) -> list[int]:
    """Buckets of a text by its word hashes: its own segments if it is short, and for every length of a
    short text that it may be similar to, the runs that can be a segment of that one."""
    n, out = len(words), set()
    least = int(np.ceil(n * SIMILARITY - 1e-9))
    for length in range(max(1, least), min(n, SHORT) + 1):
        parts = length // 4 + 1  # one more than the edits that a text similar to it can have
        for i in range(parts):
            first, end = i * length // parts, (i + 1) * length // parts
            low = max(0, first - i, first + n - length - (parts - 1 - i))
            high = min(n - (end - first), first + i, first + n - length + (parts - 1 - i))
            for at in range(low, high + 1):
                run = gram_hashes(words[at:at + end - first], end - first)
                out.add(int(mix(run ^ U64(length * 64 + i + 1))[0].astype(np.int64)))
    return sorted(out)


def signatures(words: Words) -> np.ndarray:
    """A row of ``SIGNATURE`` 64-bit words per text: of its words, each labelled with how often it occurred before
    (so a repeated word counts as often as it is there), a bit says whether an odd number has its value."""
    document = words.document()
    out = np.zeros((len(words.first) - 1, SIGNATURE), U64)
    labelled = mix(words.hash ^ mix(occurrences(words.hash, document).astype(U64) + U64(1)))
    bit = (labelled >> U64(32)) % U64(64 * SIGNATURE)
    np.bitwise_xor.at(out, (document, (bit // U64(64)).astype(np.int64)), U64(1) << (bit % U64(64)))
    return out


def printed(docs: DataFrame) -> DataFrame:
    """``id, node, n_words, signature`` of every row of ``docs`` (id, text)."""
    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(rows, "text"):
            words = Words(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([hashlib.md5(t).digest() for t in texts], pa.binary()),
                 pa.array(words.counts, pa.int64()), pa.array(list(signatures(words).astype(np.int64)), pa.list_(pa.int64()))],
                names=["id", "node", "n_words", "signature"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(work, f"id {kind}, node binary, n_words bigint, signature array<bigint>")


def bucketed(docs: DataFrame) -> DataFrame:
    """``node, buckets`` of every row of ``docs`` (text) with words: sketches, segments or both."""
    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(rows, "text"):
            words = Words(texts)
            counts = words.counts
            cells: list = [segments(words.hash[a:b]) if 0 < b - a and (b - a) * SIMILARITY <= SHORT + 1e-9 else []
                           for a, b in zip(words.first, words.first[1:])]
            long = np.flatnonzero(counts > SHORT)
            if len(long):
                _, full, values = sketches([texts[d] for d in long])
                for d, v in zip(long[full], values.astype(np.int64)):
                    cells[d] = v if not cells[d] else np.concatenate((v, cells[d]))
            some = np.flatnonzero(counts > 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array([hashlib.md5(texts[d]).digest() for d in some], pa.binary()),
                 pa.array([cells[d] for d in some], pa.list_(pa.int64()))], names=["node", "buckets"])

    return docs.select("text").mapInArrow(work, "node binary, buckets array<bigint>")


PAIR = ("a", "b", "na", "nb")  # two nodes, b the smaller one, and their word counts


class Texts:
    """The texts of nodes, looked up in the documents when pairs need them."""

    def __init__(self, docs: DataFrame, nodes: DataFrame):
        self.docs = docs.select("id", text_key(F.col("text")).alias("node"), "text")
        self.nodes = nodes.select("node", "id")

    def of(self, pairs: DataFrame) -> DataFrame:
        """``node, text`` of every node of the pairs, once."""
        wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
        # One row per node: the id beside the node spreads copies out.
        wanted = materialize(self.nodes.join(wanted, "node"), "near-wanted")
        size = wanted.agg(F.count(F.lit(1)) * 40 + F.coalesce(F.sum(F.octet_length(F.col("id").cast("string"))), F.lit(0))).first()[0]
        side = (F.broadcast(wanted) if size <= SMALL_BYTES else wanted).alias("w")
        found = self.docs.alias("d").join(side, (F.col("d.node") == F.col("w.node")) & F.col("d.id").eqNullSafe(F.col("w.id")))
        return materialize(found.select("d.node", "d.text").dropDuplicates(["node"]), "near-texts")


def _bits(a, b):
    """In how many bits the signatures a and b differ."""
    return sum((F.bit_count(F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))) for i in range(1, SIGNATURE)),
               F.bit_count(F.get(a, F.lit(0)).bitwiseXOR(F.get(b, F.lit(0)))))


def _alike(n_a, n_b, bits, least: float):
    """Whether texts of these lengths whose signatures differ in ``bits`` can be similar.  Of two texts the longer
    has as many more words of its own as it is longer, and each edit takes one at most."""
    return _lengths(n_a, n_b, least) & (bits + F.abs(F.col(n_a) - F.col(n_b)) <= 2 * (1 - least) * F.greatest(n_a, n_b) + 1e-6)


def _apart(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The ``pairs`` (``PAIR``) with the ``bits`` in which their signatures differ."""
    both = (pairs.join(nodes.select(F.col("node").alias("a"), F.col("signature").alias("sa")), "a")
            .join(nodes.select(F.col("node").alias("b"), F.col("signature").alias("sb")), "b"))
    return both.select(*PAIR, _bits(F.col("sa"), F.col("sb")).alias("bits"))


def _verified(pairs: DataFrame, texts: Texts, least: float) -> DataFrame:
    """``pairs`` (``PAIR``) with ``similarity``, null below ``least``."""
    pairs = materialize(pairs.select(*PAIR), "near-pairs")
    found = texts.of(pairs)
    if found.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] <= SMALL_BYTES // 2:
        found = F.broadcast(found)  # the same few texts in many pairs
    both = (pairs.join(found.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
            .join(found.select(F.col("node").alias("b"), F.col("text").alias("y")), "b").select(*PAIR, "x", "y"))

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found = [similarity(x, y, least) for x, y in zip(utf8(batch.column("x")), utf8(batch.column("y")))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in PAIR), pa.array(found, pa.float64())],
                                             names=[*PAIR, "similarity"])

    return both.mapInArrow(work, "a binary, b binary, na bigint, nb bigint, similarity double")


def _lengths(a, b, least: float):
    """Lengths that differ by no more than the similarity ``least`` allows."""
    return F.least(a, b) >= least * F.greatest(a, b) - 1e-9


def _roots(linked: DataFrame) -> DataFrame:
    """``node, root`` of the nodes with a link."""
    return materialize(components(linked), "near-roots")


def _named(rows: DataFrame, root: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with the class of each column's node in a further one, ``r`` and its name."""
    named = F.broadcast(root) if root.count() * 32 <= SMALL_BYTES else root
    for c in columns:
        rows = rows.join(named.select(F.col("node").alias(c), F.col("root").alias("r" + c)), c, "left")
        rows = rows.withColumn("r" + c, F.coalesce("r" + c, c))
    return rows


def _linked(pairs: DataFrame, texts: Texts, least: float, of: list, linked: DataFrame | None = None,
            root: DataFrame | None = None) -> tuple[DataFrame | None, DataFrame | None]:
    """The links among ``pairs`` (``PAIR``, bits) beside those ``linked`` already, with classes ``root``, and
    all pairs that were verified.

    Of the pairs that are equal in ``of`` (nodes, or ``r`` and a node's name for its class) the closest
    goes first: most others are in one class after it and need no verification."""
    tested = None
    for closest in (True, False):
        left = pairs
        if tested is not None:
            left, root = pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti"), _roots(linked)
        if root is not None:
            left = _named(left, root, "a", "b").where("ra != rb")
        left = materialize(left, "near-apart")
        if left.isEmpty():
            break
        first = left
        if closest:
            first = left.groupBy(*of).agg(F.min(F.struct("bits", *PAIR)).alias("pair")).select("pair.*").distinct()
        checked = materialize(_verified(first, texts, least), "near-checked")
        links = checked.where("similarity IS NOT NULL")
        linked = links if linked is None else linked.unionByName(links)
        tested = checked if tested is None else tested.unionByName(checked)
    return linked, tested


def _across(met: DataFrame, root: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs (``PAIR``, bits) that met the same node b but not each other: p, in its class, and q, which isn't.

    Differing bits are a metric: a q that is farther from b than all the p by more than similar texts can
    be apart meets none of them, and a p only meets the q that it can be similar to."""
    named = _named(met, root, "a", "b")
    marks = nodes.select("node", "signature")
    near = (named.where("ra = rb").select("b", F.col("a").alias("p"), F.col("na").alias("np"), F.col("bits").alias("bp")))
    reach = near.groupBy("b").agg(F.max("bp").alias("reach"), F.max("np").alias("longest"))
    allowed = 2 * (1 - least)
    far = (named.where("ra != rb").join(reach, "b")
           .where(F.col("bits") - F.col("reach") <= allowed * F.greatest("na", "longest") + 1e-6)
           .select("b", F.col("a").alias("q"), F.col("na").alias("nq"), F.col("bits").alias("bq"), F.col("ra").alias("rq"), F.col("rb")))
    p = near.join(far.select("b").distinct(), "b", "left_semi").join(marks.withColumnsRenamed({"node": "p", "signature": "sp"}), "p")
    q = far.join(marks.withColumnsRenamed({"node": "q", "signature": "sq"}), "q")
    bits, up = _bits(F.col("sp"), F.col("sq")), F.col("p") > F.col("q")
    pairs = p.join(q, (p["b"] == q["b"]) & (F.abs(F.col("bq") - F.col("bp")) <= allowed * F.greatest("np", "nq") + 1e-6) &
                   _alike("np", "nq", bits, least))
    return pairs.select(
        F.greatest("p", "q").alias("a"), F.least("p", "q").alias("b"), F.when(up, F.col("np")).otherwise(F.col("nq")).alias("na"),
        F.when(up, F.col("nq")).otherwise(F.col("np")).alias("nb"), bits.alias("bits"))


def _blocks(n: str) -> Column:
    """The number of blocks of a bucket of ``n`` members.  It grows with the square root of n, as does a block: rows of
    cells grow as n to the power 1.5, and a cell with the root of n."""
    return F.expr(f"CAST(ceil(sqrt({n} / {BLOCK})) AS INT)")


def _rest(members: DataFrame, root: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs (``PAIR``, bits) of members of one bucket that aren't in the class of its smallest node, if of
    different classes and alike.

    Members are dealt to blocks, and each two blocks of a bucket meet in a cell whose signatures are compared as
    matrices: a bucket gives a row for each member and block (``_blocks``), not for each pair.  A node meets its
    signature once, with the list of its buckets."""
    rest = _named(members, root, "node", "least").where("rnode != rleast").select("bucket", "node", "n_words", "native", "rnode")
    whole = Window.partitionBy("bucket")
    rest = rest.withColumns({"n": F.count(F.lit(1)).over(whole), "lo": F.min("rnode").over(whole), "hi": F.max("rnode").over(whole),
                             "natives": F.max("native").over(whole)})
    rest = materialize(rest.where("lo != hi AND natives").select("bucket", "node", "n_words", "rnode", _blocks("n").alias("blocks")),
                       "near-rest")
    own = F.pmod(F.xxhash64("node"), F.col("in.blocks")).cast("int")
    cells = (rest.groupBy("node", "n_words", "rnode").agg(F.collect_list(F.struct("bucket", "blocks")).alias("ins"))
             .join(nodes.select("node", "signature"), "node")
             .select("node", "n_words", "rnode", "signature", F.explode("ins").alias("in"))
             .select("node", "n_words", "rnode", "signature", F.col("in.bucket").alias("bucket"), own.alias("own"),
                     F.explode(F.sequence(F.lit(0), F.col("in.blocks") - 1)).alias("other"))
             .groupBy("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
             .agg(F.collect_list(F.struct("own", "node", "n_words", F.col("rnode").alias("root"), "signature")).alias("cell")))

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows:
            found: list[tuple] = []
            for at in range(len(batch)):
                found += _cell_pairs(batch.column("cell")[at].values, batch.column("i")[at].as_py() != batch.column("j")[at].as_py(), least)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(
                zip(*found) if found else [[]] * 5, (pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()))], names=[*PAIR, "bits"])

    return cells.mapInArrow(work, "a binary, b binary, na bigint, nb bigint, bits bigint").distinct()


def _cell_pairs(cell: pa.StructArray, two: bool, least: float) -> list[tuple]:
    """``PAIR`` and bits of the pairs of a cell, those of two blocks only if it has ``two``."""
    nodes = cell.field("node").to_pylist()
    own, n = (cell.field(c).to_numpy(zero_copy_only=False) for c in ("own", "n_words"))
    classes = np.unique(np.array(cell.field("root").to_pylist(), object), return_inverse=True)[1]
    marks = cell.field("signature").flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(U64).reshape(len(nodes), SIGNATURE)
    out = []
    for x in range(len(nodes) - 1):
        longer = np.maximum(n[x + 1:], n[x])
        met = (classes[x + 1:] != classes[x]) & (np.minimum(n[x + 1:], n[x]) >= least * longer - 1e-9)
        if two:
            met &= own[x + 1:] != own[x]
        some = np.flatnonzero(met)
        if len(some):
            bits = np.bitwise_count(marks[x + 1 + some] ^ marks[x]).sum(axis=1, dtype=np.int64)
            for k in np.flatnonzero(bits + np.abs(n[x + 1:] - n[x])[some] <= 2 * (1 - least) * longer[some] + 1e-6):
                y = x + 1 + some[k]
                big, small = (x, y) if nodes[x] > nodes[y] else (y, x)
                out.append((nodes[big], nodes[small], int(n[big]), int(n[small]), int(bits[k])))
    return out


def members_of(docs: DataFrame, nodes: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``bucket, node, n_words, native`` of all nodes that share a bucket with another of a length that a
    similar text can have (native: in its own class of lengths), and ``least, n_least`` of the bucket's smallest node.

    Most buckets have one node, and their rows are most of what is shuffled: nodes go by eight bytes
    of their md5 there (unless two have the same), and each row is shuffled once."""
    short = F.xxhash64("node")
    sizes = nodes.agg(F.count(F.lit(1)).alias("all"), F.count_distinct(short).alias("keys")).first()
    key = short if sizes["all"] == sizes["keys"] else F.col("node")
    once = bucketed(docs).groupBy("node").agg(F.first("buckets").alias("buckets"))  # equal texts have equal buckets
    rows = once.select(key.alias("key"), F.explode("buckets").alias("bucket"))
    several = F.count(F.lit(1)).over(Window.partitionBy("bucket"))
    shared = materialize(rows.withColumn("n", several).where("n > 1").select("bucket", "key"), "near-shared")
    # Similar texts are in one class of lengths or in neighbouring ones: each goes to its own and the next.
    level = F.floor(F.log("n_words") / float(np.log(1 / least)))
    members = (shared.join(nodes.select(key.alias("key"), "node", "n_words"), "key")
               .select("bucket", "node", "n_words", level.alias("own"), F.explode(F.array(level, level + 1)).alias("level"))
               .select(F.xxhash64("bucket", "level").alias("bucket"), "node", "n_words", (F.col("own") == F.col("level")).alias("native")))
    whole = Window.partitionBy("bucket")
    members = members.withColumns({"n": several, "natives": F.max("native").over(whole),
                                   "first": F.min(F.struct("node", "n_words")).over(whole)})
    # Texts of one length class meet in their own: no need of a bucket that has only those of the class below.
    return materialize(members.where("n > 1 AND natives").select(
        "bucket", "node", "n_words", "native", F.col("first.node").alias("least"), F.col("first.n_words").alias("n_least")), "near-buckets")


def links(docs: DataFrame, prints: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``a, b, similarity``: verified pairs of nodes, as found through bucket representatives."""
    nodes = prints.groupBy("node").agg(F.min("id").alias("id"), F.first("n_words").alias("n_words"),
                                       F.first("signature").alias("signature"))
    nodes = materialize(nodes, "near-nodes")
    members = members_of(docs, nodes, least)
    texts = Texts(docs, nodes)
    stars = (members.where("node != least")
             .select(F.col("node").alias("a"), F.col("least").alias("b"), F.col("n_words").alias("na"), F.col("n_least").alias("nb")).distinct())
    met = materialize(_apart(stars, nodes), "near-met")
    linked, tested = _linked(met.where(_alike("na", "nb", F.col("bits"), least)), texts, least, ["a"])
    if linked is None:
        linked = tested = docs.sparkSession.createDataFrame([], "a binary, b binary, na bigint, nb bigint, similarity double")
    root = _roots(linked)
    others = materialize(_across(met, root, nodes, least).unionByName(_rest(members, root, nodes, least)).distinct()
                         .join(tested.select("a", "b"), ["a", "b"], "left_anti"), "near-across")
    sides = [F.least("ra", "rb"), F.greatest("ra", "rb")]
    return _linked(others, texts, least, sides, linked, root)[0].select("a", "b", "similarity")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` of every node of the edges (a, b): its component's smallest node.

    Large-star and small-star steps in turn until the edges stay the same."""
    def stars(pairs: DataFrame) -> DataFrame:
        return pairs.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    edges = materialize(stars(edges.select("a", "b")), "near-edges")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.first("a"), F.min("b")).alias("m"))
        large = stars(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        large = materialize(large, "near-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialize(stars(small.unionByName(least.select("a", F.col("m").alias("b")))), "near-small")
        after = state(edges)
        if after == before:
            break
        before = after
    root = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return root.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
                            .join(root.select("node"), "node", "left_anti"))


def one_of_each(df: DataFrame, id_col: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """All columns of one row of every class: the row with the smallest id (then md5)."""
    found = materialize(classes(df, id_col, text, least).withColumnRenamed(id_col, "id"), "near-classes")
    first = (found.where(F.col("id").eqNullSafe(F.col("class_id"))).groupBy("root").agg(F.min("node").alias("node"))
             .withColumnRenamed("root", "of"))
    # Any row of the class with that id and text; several equal rows count as one.
    keep = (found.join(first, (F.col("root") == F.col("of")) & F.col("id").eqNullSafe(F.col("class_id")) &
                       (found["node"] == first["node"]))
            .groupBy("id", found["node"]).agg(F.count(F.lit(1)).alias("n")))
    return decided(df, materialize(keep, "near-kept"), id_col, text)


def classes(df: DataFrame, id_col: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """``id_col, class_id, class_size, node, root`` for every row: the smallest id of its class and
    the number of rows in it; the md5 of its text and the smallest one in its class."""
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    prints = materialize(printed(docs), "near-prints")
    root = components(links(docs, prints, least))
    rows = materialize(prints.select("id", "node").join(root, "node", "left")
                       .select("id", "node", F.coalesce("root", "node").alias("root")), "near-rows")
    names = rows.groupBy("root").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return rows.join(names, "root").select(F.col("id").alias(id_col), "class_id", "class_size", "node", "root")
