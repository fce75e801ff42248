"""Spelling variants by finite-state composition: pairs of words one edit apart, and their forms.

Words are the longest runs ``[A-Za-z\\u00C0-\\u00FF]+``, A-Z lower-cased; with the simulated slips of the
pen of ``word_counts`` (a rule of id and run) each run is one word.  Two words are near if one inserted,
deleted or replaced code point turns one into the other.  A word's form is its near word of largest count,
if that is at least ``FACTOR`` times its own; its root is the last of the forms of forms.

Near words are the pairs that the composition *A o E o A* accepts, where A is the
minimised acceptor of the vocabulary and E the transducer of one edit.  Up to the edit both tapes read
the same symbols, so the pairs fall apart by the composed state that a common
prefix P leads to; as behind the edit both read the same again, a partition is named by

* L, the code points of the shorter word (a word belongs to L = its length and its length - 1),
* lo and hi: the pair's common prefix is at least lo and less than hi long,
* P, the first lo code points, and S, what follows place hi (for the longer word place hi + 1).

The first cut at the middle of L gives two partitions of each word and length.  One with more than
``PARTITION`` words is cut again: either the common prefix reaches the new middle, which lengthens P, or it
ends before, which lengthens S.  Every pair is in exactly one partition at each level, and a
partition of a single place (hi = lo + 1) holds no more words than the alphabet allows there, so
no partition grows with the vocabulary and none is cut short.

A task takes whole partitions, builds the minimised acceptor of what they have between P and S with one
initial state for each, and enumerates what the composition accepts from those states: where both tapes are in one
state, the edit happens here (first symbols differ, then one language) or further down.

Defined cases: a null text has no words and a null id counts as the empty text; repeated rows count as
often as they are there; ties between forms go to the smallest word in code-point order; an empty
table gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyho.llm.common import materialize, shuffle_width

LEAST_LENGTH = 6            # code points of a word
LEAST_COUNT = 5             # occurrences
FACTOR = 5                  # a form is so many times as frequent
SLIP = 199                  # one run in so many loses a code point
PARTITION = 20_000          # words of a partition, beyond which it is cut again
BLOCK = 50_000              # words that share an acceptor, or one partition

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n`` of all words long and frequent enough."""
    lowered = F.translate(F.col(f"`{text}`"), _UPPER, _LOWER)
    # Only longer runs can give a long word; the longest match is the whole run.
    runs = F.regexp_extract_all(lowered, F.lit(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}"), F.lit(0))
    each = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    hashed = each.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = hashed.select(F.when(F.col("h") % SLIP == 0, slipped).otherwise(F.col("run")).alias("word"))
    return (words.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


# ------------------------------------------------------------------ partitions of the composition's states
KEY = ("L", "lo", "hi", "P", "S")


def _cut(members: DataFrame) -> DataFrame:
    """Each interval [lo, hi) of the common prefix's length as two, with the new P and S."""
    middle = F.floor((F.col("lo") + F.col("hi")) / 2).cast("int")
    halves = F.array(F.struct(F.col("lo"), middle.alias("hi")), F.struct(middle.alias("lo"), F.col("hi")))
    cut = members.withColumn("half", F.explode(halves)).withColumns({"lo": F.col("half.lo"), "hi": F.col("half.hi")}).drop("half")
    behind = F.col("hi") + F.length("word") - F.col("L") + 1
    return cut.withColumns({"P": F.substring("word", F.lit(1), F.col("lo")),
                            "S": F.substring(F.col("word"), behind, F.length("word"))})


def partitions(words: DataFrame, most: int = PARTITION) -> DataFrame:
    """``word, n`` and the ``KEY`` of every partition with a possible pair that the word is in."""
    length = F.length("word")
    start = words.select("word", "n", F.explode(F.array(length, length - 1)).alias("L")).where(F.col("L") >= 1)
    members = _cut(start.select("word", "n", "L", F.lit(0).alias("lo"), (F.col("L") + 1).alias("hi")))
    ready = None
    while True:
        sizes = members.groupBy(*KEY).agg(F.count(F.lit(1)).alias("size"), F.count_if(length == F.col("L")).alias("short"))
        members = materialize(members.join(sizes.where("size > 1 AND short > 0"), list(KEY)), "variants-members")
        large = (F.col("size") > most) & (F.col("hi") - F.col("lo") > 1)
        done = members.where(~large).drop("size", "short")
        ready = done if ready is None else ready.unionByName(done)
        members = members.where(large).drop("size", "short")
        if members.isEmpty():
            return ready
        members = _cut(members)


# ------------------------------------------------------------------ acceptor and composition
class Acceptor:
    """Minimised acyclic acceptors that share their states; state i has ``moves[i]`` and ``final[i]``."""

    def __init__(self):
        self.moves: list[dict[str, int]] = []
        self.final: list[bool] = []
        self._known: dict[tuple, int] = {}
        self._edits: dict[int, list[tuple[str, str]]] = {}

    def _state(self, final: bool, moves: list[tuple[str, int]]) -> int:
        key = (final, *moves)
        if key not in self._known:
            self._known[key] = len(self.moves)
            self.moves.append(dict(moves))
            self.final.append(final)
        return self._known[key]

    def add(self, words: list[str]) -> int:
        """The initial state of the words, which are in order and distinct."""
        path: list[list] = [[False, []]]  # open states of the last word
        last = ""
        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            self._close(path, last, same)
            path += [[False, []] for _ in word[same:]]
            path[-1][0] = True
            last = word
        self._close(path, last, 0)
        return self._state(*path[0])

    def _close(self, path: list[list], word: str, depth: int) -> None:
        while len(path) > depth + 1:
            final, moves = path.pop()
            path[-1][1].append((word[len(path) - 1], self._state(final, moves)))

    def common(self, p: int, q: int) -> Iterator[str]:
        """What both states accept."""
        open_ = [(p, q, "")]
        while open_:
            p, q, read = open_.pop()
            if self.final[p] and self.final[q]:
                yield read
            ours, theirs = self.moves[p], self.moves[q]
            for symbol in ours if len(ours) <= len(theirs) else theirs:
                if symbol in ours and symbol in theirs:
                    open_.append((ours[symbol], theirs[symbol], read + symbol))

    def edits(self, p: int) -> list[tuple[str, str]]:
        """Pairs from one state whose edit comes first: replaced, or put before the second's rest."""
        if p not in self._edits:
            moves = sorted(self.moves[p].items())
            found = [(a + z, b + z) for i, (a, x) in enumerate(moves) for b, y in moves[i + 1:] for z in self.common(x, y)]
            found += [(z, b + z) for b, y in moves for z in self.common(y, p) if z[:1] != b]
            self._edits[p] = found
        return self._edits[p]

    def pairs(self, start: int, most: int) -> Iterator[tuple[str, str]]:
        """All pairs that the composition accepts from an initial state after less than ``most`` equal symbols."""
        open_ = [(start, "")]
        while open_:
            p, read = open_.pop()
            for x, y in self.edits(p):
                yield read + x, read + y
            if len(read) + 1 < most:
                open_ += [(q, read + symbol) for symbol, q in self.moves[p].items()]


def _blocks(rows: Iterator[pa.RecordBatch], most: int) -> Iterator[list[tuple]]:
    """Rows (key, word, n, length, L, lo, hi) of whole partitions, one after another."""
    held: list[tuple] = []
    for batch in rows:
        for row in zip(*(batch.column(c).to_pylist() for c in ("key", "word", "n", "L", "lo", "hi"))):
            if len(held) >= most and row[0] != held[-1][0]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def near_pairs(words: DataFrame, partition: int = PARTITION, block: int = BLOCK) -> DataFrame:
    """``a, na, b, nb``: every pair of near words once, with their counts."""
    members = partitions(words, partition).select(F.concat_ws("\n", *(F.col(c).cast("string") for c in KEY)).alias("key"),
                                                  "word", "n", "L", "lo", "hi")
    dealt = members.repartition(shuffle_width(words.sparkSession), "key").sortWithinPartitions("key")

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _blocks(rows, block):
            acceptor, found, first = Acceptor(), [], 0
            while first < len(held):
                end, (key, _, _, short, lo, hi) = first, held[first]
                own = {}
                while end < len(held) and held[end][0] == key:
                    word, n = held[end][1:3]
                    own[word[lo:hi + len(word) - short]] = (word, n)
                    end += 1
                for x, y in acceptor.pairs(acceptor.add(sorted(own)), hi - lo):
                    if len(own[x][0]) == short:  # two longer words meet in their own partition
                        found.append((*own[x], *own[y]))
                first = end
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found), (
                    pa.string(), pa.int64(), pa.string(), pa.int64()))], names=["a", "na", "b", "nb"])

    return dealt.mapInArrow(work, "a string, na bigint, b string, nb bigint")


# ------------------------------------------------------------------ forms and roots
def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for ``word, form``: the last of the forms of forms.

    Each round doubles the steps taken; counts rise by ``FACTOR`` a step, so rounds are few."""
    known = materialize(forms.select("word", F.col("form").alias("root")), "variants-roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(known.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "variants-roots")
        if moved.where("moved").isEmpty():
            return known
        known = moved.drop("moved")


def variants(docs: DataFrame, id_col: str = "doc_id", text: str = "text", partition: int = PARTITION, block: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the texts."""
    words = materialize(word_counts(docs, id_col, text), "variants-words")
    pairs = materialize(near_pairs(words, partition, block), "variants-pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n")))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))

    def formed(value: Column) -> Column:
        return F.when(-F.col("best.less") >= FACTOR * F.col("n"), value)

    rows = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), formed(F.col("best.near")).alias("form"),
        formed(-F.col("best.less")).alias("form_n"))
    rows = materialize(rows, "variants-forms")
    last = roots(rows.where(F.col("form").isNotNull()))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
