"""Byte-level BPE: encoding and decoding by the ranks of a public vocabulary.

A text is cut by the vocabulary's pattern; every piece of it ("word") is encoded on its own: a
word that has a rank is one token, any other starts as its single bytes, and the adjacent
pair whose joined bytes have the least rank (the leftmost of equals) is merged until no
pair has one.  ``fold`` says that in higher-order functions: an ``aggregate`` over a
distinct word's byte array whose state is its pieces so far and the ranks of their pairs.  Ranks are
looked up in a *literal rank map*: an array of hash buckets, each a small map, constant in the
plan, so a lookup costs the same for any vocabulary.

Two steps, both on whole texts:

1. the words of all texts are counted; the frequent ones (at most ``CACHED``, the least count is
   found from a histogram) are folded, as a table of distinct words spread over the
   cluster, and go to the tasks as a broadcast table of bounded size;
2. each text is cut into words, in numpy; words of the table get its ids, a word that is too rare for it
   (or longer than ``CACHED_BYTES``, as the fold takes quadratic time in the length) is merged where
   it stands by ``merge``, the same merges from a heap.

No text is shuffled and no result depends on what the table holds.  Folding rare words too, as a
column of each text's words that the table lacks, was tried: it gives the same results, but
an interpreted lambda takes some 75 microseconds a word (README).  Decoding looks every id's
bytes up and concatenates them.

``Cut`` knows one pattern, that of the byte-level vocabularies (``PATTERN``, fixed value); its
classes of letters, numbers and white space are those of the ``regex`` library.

Defined cases: a null text is the empty text and has no tokens; special tokens are ordinary
text; repeated rows are encoded each; an empty table gives an empty result; other columns
are carried along whatever their names; a word with a byte that has no rank raises, as does
decoding an id that the vocabulary lacks.
"""

from __future__ import annotations

import base64
import heapq
import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyho.llm.common import U64, batches, materialize, run_hashes, shuffle_width

#: The pattern of the vocabularies (fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

CACHED = 1 << 19            # words in the broadcast table at most
CACHED_BYTES = 64           # and the length of each
HELD = 1 << 16              # distinct words that a task holds: counted ones, then merged ones
_NONE = 2147483647          # the rank of a pair that has none
_SPACE, _LETTER, _NUMBER, _OTHER, _EDGE = range(5)


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a vocabulary file: a line per token, base64 and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (x.split() for x in lines if x.strip())}


# ------------------------------------------------------------------ words
_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """The class of every code point."""
    if not _CLASSES:
        table = np.full(0x110000, _OTHER, np.uint8)
        every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        for kind, pattern in ((_SPACE, r"\s+"), (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
            for m in regex.finditer(pattern, every):
                a, b = ord(every[m.start()]), ord(every[m.end() - 1])
                table[a:b + 1] = kind  # a run across the surrogates covers them: no text has any
        _CLASSES.append(table)
    return _CLASSES[0]


class Cut:
    """The words of a chunk: the matches of ``PATTERN`` in each text, one after another.

    ``raw`` are the texts' bytes, joined; word i is ``raw[start[i]:end[i]]``, has the 64-bit
    hash ``hash[i]`` and belongs to text ``document[i]``."""

    def __init__(self, texts: list[bytes]):
        self.raw = b"\n".join(texts) + b"\n"
        points = np.frombuffer(self.raw.decode("utf-8").encode("utf-32-le"), np.uint32)
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        at = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))  # byte offset of each code point
        text_end = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        kind = classes()[points]
        edge = np.searchsorted(at, text_end - 1)
        kind[edge] = _EDGE
        first = np.empty(len(kind), bool)  # a word begins here
        first[0] = True
        np.not_equal(kind[1:], kind[:-1], out=first[1:])
        first[edge] = True
        # The last of white space before something else stays alone; a blank there joins what follows.
        last = np.flatnonzero((kind[:-1] == _SPACE) & (kind[1:] != _SPACE) & (kind[1:] != _EDGE))
        first[last] = True
        blank = last[points[last] == 0x20]
        first[blank + 1] = False
        # An apostrophe that is a word by itself takes some endings.
        lone = np.flatnonzero((points == 0x27) & first)
        lone = lone[kind[lone + 1] == _LETTER]
        one = points[lone + 1]
        two = points[np.minimum(lone + 2, len(points) - 1)]
        short = np.isin(one, [ord(c) for c in "stmd"])
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        for ends, n in ((lone[short], 2), (lone[pair], 3)):
            first[ends + 1] = False
            first[ends + n] = True
        start = np.flatnonzero(first)
        end = np.concatenate((start[1:], [len(kind)]))
        inside = kind[start] != _EDGE
        self.start, self.end = at[start[inside]], at[end[inside]]
        self.document = np.searchsorted(text_end, self.start, "right")
        self.hash = run_hashes(np.frombuffer(self.raw, np.uint8), self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def word(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]]


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The ids of one word by the same merges as ``fold``, from a heap of adjacent pairs."""
    if word in ranks:
        return [ranks[word]]
    n = len(word)
    after, before, piece = list(range(1, n + 1)), list(range(-1, n - 1)), [word[i:i + 1] for i in range(n)]
    heap: list[tuple[int, int, bytes, bytes]] = []

    def offer(i: int) -> None:
        if i >= 0 and after[i] < n:
            rank = ranks.get(piece[i] + piece[after[i]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, piece[i], piece[after[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, a, b = heapq.heappop(heap)
        j = after[i]
        if piece[i] != a or j >= n or piece[j] != b:  # one of the two was merged meanwhile
            continue
        piece[i], piece[j] = a + b, b""
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [ranks[x] for x in piece if x]


# ------------------------------------------------------------------ the fold
def literal_ranks(ranks: dict[bytes, int]) -> Column:
    """The rank map as a constant: hash buckets (a power of two) of hexadecimal bytes and rank."""
    buckets: list[dict[str, int]] = [{} for _ in range(1 << max(1, len(ranks).bit_length()))]
    for key, rank in ranks.items():
        digits = key.hex().upper()
        buckets[zlib.crc32(digits.encode()) & (len(buckets) - 1)][digits] = rank
    return F.from_json(F.lit(json.dumps(buckets, separators=(",", ":"))), "array<map<string,int>>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fold(word: Column, ranks: Column, buckets: int) -> Column:
    """The ids of a word (binary, not empty): ranked merges folded over its bytes.

    ``ranks`` is the literal map and ``buckets`` its size.  The state is the pieces, the ranks of their
    adjacent pairs and the place of the next merge; steps that find it and steps that merge there
    take turns, as a value can only be named in a lambda by being state."""
    no_pairs = F.array().cast("array<int>")

    def rank(piece: Column) -> Column:
        return F.get(ranks, F.crc32(piece.cast("binary")).bitwiseAND(F.lit(buckets - 1)).cast("int"))[piece]

    def pair(left: Column, right: Column) -> Column:
        return F.coalesce(rank(F.concat(left, right)), F.lit(_NONE))

    def state(pieces: Column, pairs: Column, at: Column) -> Column:
        return F.struct(pieces.alias("pieces"), pairs.alias("pairs"), at.alias("at"))

    def step(now: Column) -> Column:
        pieces, pairs, at = now["pieces"], now["pairs"], now["at"]
        least = F.array_min(pairs)
        found = F.when(least < _NONE, F.array_position(pairs, least).cast("int")).otherwise(F.lit(-1))
        joined = F.concat(F.get(pieces, at - 1), F.get(pieces, at))
        before = F.when(at > 1, F.array(pair(F.get(pieces, at - 2), joined))).otherwise(no_pairs)
        behind = F.when(at + 1 < F.size(pieces), F.array(pair(joined, F.get(pieces, at + 1)))).otherwise(no_pairs)
        merged = state(
            F.concat(F.slice(pieces, F.lit(1), at - 1), F.array(joined), F.slice(pieces, at + 2, F.size(pieces))),
            F.concat(F.slice(pairs, F.lit(1), F.greatest(at - 2, F.lit(0))), before, behind,
                     F.slice(pairs, at + 2, F.size(pairs))), F.lit(0))
        return F.when(at < 0, now).when(at == 0, state(pieces, pairs, found)).otherwise(merged)

    def merges(digits: Column) -> Column:
        n = (F.length(digits) / 2).cast("int")
        singles = F.transform(F.sequence(F.lit(1), n), lambda i: F.substring(digits, i * 2 - 1, F.lit(2)))

        def folded(single: Column) -> Column:
            pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
                                lambda i: pair(F.get(single, i - 1), F.coalesce(F.get(single, i), F.lit(""))))
            start = state(single, F.when(n > 1, pairs).otherwise(no_pairs), F.lit(0))
            return F.aggregate(F.sequence(F.lit(2), n * 2), start, lambda now, _: step(now),
                               lambda now: F.transform(now["pieces"], rank))

        return _let(singles, folded)

    def ids(digits: Column) -> Column:
        return _let(rank(digits), lambda whole: F.when(whole.isNotNull(), F.array(whole)).otherwise(merges(digits)))

    return _let(F.hex(word), ids)


def fold_with(word: Column, ranks: dict[bytes, int]) -> Column:
    """``fold`` by the ranks as a literal map."""
    size = 1 << max(1, len(ranks).bit_length())
    return _let(literal_ranks(ranks), lambda table: fold(word, table, size))


# ------------------------------------------------------------------ the table of frequent words
def word_counts(texts: DataFrame) -> DataFrame:
    """``word, n`` (binary) of the words up to ``CACHED_BYTES`` in all texts (one column)."""
    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}

        def passed_on() -> pa.RecordBatch:
            found = list(held.values())
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([w for w, _ in found], pa.binary()),
                                               pa.array([n for _, n in found], pa.int64())], names=["word", "n"])

        for _, parts in batches(rows, "text"):
            cut = Cut(parts)
            some = np.flatnonzero(cut.end - cut.start <= CACHED_BYTES)
            kinds, first, counts = np.unique(cut.hash[some], return_index=True, return_counts=True)
            for h, i, n in zip(kinds.tolist(), some[first].tolist(), counts.tolist()):
                if h in held:
                    held[h][1] += n
                else:
                    held[h] = [cut.word(i), n]
            if len(held) > HELD:
                yield passed_on()
        if held:
            yield passed_on()

    found = texts.toDF("text").mapInArrow(work, "word binary, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(texts: DataFrame, most: int = CACHED) -> DataFrame:
    """The words that occur often enough for there to be at most ``most`` of them."""
    counts = materialize(word_counts(texts), "words")
    step = F.floor(F.log2("n") * 8)  # a few hundred steps whatever the counts
    kept, least = 0, None
    for row in sorted(counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).collect(), reverse=True):
        kept += row["words"]
        if kept > most:
            break
        least = row["step"]
    return counts.where(step >= least).select("word") if least is not None else counts.where("false").select("word")


class Table:
    """Words and their ids as flat arrays, found by the words' hashes."""

    def __init__(self, words: list[bytes], ids: list[list[int]]):
        ends = np.cumsum([len(w) for w in words], dtype=np.int64)
        raw = np.frombuffer(b"".join(words) or b" ", np.uint8)
        hashes = run_hashes(raw, np.concatenate(([0], ends[:-1])).astype(np.int64), ends) if words else np.zeros(0, U64)
        order = np.argsort(hashes, kind="stable")
        sizes = np.array([len(x) for x in ids], np.int64)[order] if words else np.zeros(0, np.int64)
        self.hash, self.first = hashes[order], np.concatenate(([0], np.cumsum(sizes), [0]))  # place -1 is empty
        self.ids = np.array([i for at in order.tolist() for i in ids[at]], np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each hash, or -1."""
        if not len(self.hash):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.where(self.hash[at] == hashes, at, -1)


def _spread(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges ``first[i]:first[i] + sizes[i]``, one after another."""
    ends = np.cumsum(sizes)
    return np.repeat(first - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _lists(flat: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(flat, pa.int32()))


# ------------------------------------------------------------------ encoding and decoding
def _joined(flat: np.ndarray, per_text: np.ndarray, piece: dict[int, bytes]) -> pa.Array:
    """The bytes of each text's ids."""
    ids, ends = flat.tolist(), np.cumsum(per_text).tolist()
    return pa.array([b"".join([piece[i] for i in ids[a:b]]) for a, b in zip([0, *ends], ends)], pa.binary())


def encode(df: DataFrame, text: str, path: str, out: str = "ids", most: int = CACHED, decoded: str | None = None) -> DataFrame:
    """``df`` with the ids of each text in place of the text, and if asked for with what they
    decode to (a round trip without another pass).  No text is shuffled."""
    spark, ranks = df.sparkSession, read_ranks(path)
    kept = [c for c in df.columns if c not in (text, out, decoded)]
    inner = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`")).toDF(*[f"c{i}" for i in range(len(kept))], "text")
    words = frequent_words(inner.select("text"), most).repartition(shuffle_width(spark), "word")  # small rows, much work
    folded = words.select("word", fold_with(F.col("word"), ranks).alias("ids")).toArrow()
    known = spark.sparkContext.broadcast(Table(folded.column("word").to_pylist(), folded.column("ids").to_pylist()))
    every = spark.sparkContext.broadcast(ranks)
    carried = inner.schema.fields[:-1]
    schema = T.StructType([*carried, T.StructField("ids", T.ArrayType(T.IntegerType())),
                           *([T.StructField("decoded", T.BinaryType())] if decoded else [])])

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, rare = known.value, {}
        piece = {rank: token for token, rank in every.value.items()} if decoded else {}
        for batch, parts in batches(rows, "text"):
            cut = Cut(parts)
            kinds, first, place = np.unique(cut.hash, return_index=True, return_inverse=True)
            at = table.find(kinds)
            starts, sizes = table.first[at], table.first[at + 1] - table.first[at]
            own, total = [table.ids], len(table.ids)
            for k in np.flatnonzero(at < 0):  # words that the table lacks
                word = cut.word(first[k])
                found = rare.get(word)
                if found is None:
                    found = merge(word, every.value)
                    if len(word) <= CACHED_BYTES:
                        if len(rare) >= HELD:
                            rare.clear()
                        rare[word] = found
                starts[k], sizes[k] = total, len(found)
                own.append(np.array(found, np.int32))
                total += len(found)
            ids = np.concatenate(own)[_spread(starts[place], sizes[place])]
            per_text = np.bincount(cut.document, sizes[place], len(parts)).astype(np.int64)
            columns = [*(batch.column(c.name) for c in carried), _lists(ids, per_text)]
            if decoded:
                columns.append(_joined(ids, per_text, piece))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return inner.mapInArrow(work, schema).toDF(*kept, out, *([decoded] if decoded else []))


def decode(df: DataFrame, ids: str, path: str, out: str = "decoded") -> DataFrame:
    """``df`` with the bytes of its ids (binary) in a further column."""
    ranks = read_ranks(path)
    pieces = df.sparkSession.sparkContext.broadcast({rank: token for token, rank in ranks.items()})
    kept = [c for c in df.columns if c != out]
    inner = df.select(*[F.col(f"`{c}`") for c in kept]).toDF(*[f"c{i}" for i in range(len(kept))])
    at = kept.index(ids)
    schema = T.StructType([*inner.schema.fields, T.StructField("out", T.BinaryType())])

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece, names = pieces.value, to_arrow_schema(schema).names
        for batch in rows:
            lists = batch.column(at)
            sizes = np.asarray(lists.value_lengths().fill_null(0))
            yield pa.RecordBatch.from_arrays([*batch.columns, _joined(np.asarray(lists.flatten()), sizes, piece)], names=names)

    return inner.mapInArrow(work, schema).toDF(*kept, out)
