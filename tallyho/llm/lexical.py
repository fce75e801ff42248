"""Ranked lexical search by the Best Position Algorithm over sharded impact lists.

Terms are the longest runs ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, A-Z lower-cased.  With N
documents that have a term, L terms in all, n in a document, df documents that hold a term and tf
occurrences in one, a term weighs ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``, a document has
``m = 25 + (75 * n * N) div L``, and a term's impact there is ``w * ((1000000000 * tf) div (1000 * tf + 8 * m))``.
A document's score is the sum of the impacts of the query's terms, repeats included: integers, so
results don't depend on the order of sums.

Three passes:

1. one over the texts keeps, per document, the query terms in it with their counts (a table of
   postings, written once) and its length;
2. Spark sums N, L and df over all documents;
3. each task turns the postings that it reads into shards of at most ``SHARD_POSTINGS``: in a shard every
   term has its impact list, falling, and every posting its position there.  A query reads all its
   lists from the top, some positions at a time; each document that it meets is scored by
   direct access, which also marks the positions of its other terms as seen.  A list's best
   position is the end of its unbroken run of seen positions, however far it was read; no unseen
   document scores more than the sum of the next impacts behind the best positions.  The search
   stops when that sum is strictly below the k-th score (ties could still win by their
   id) or all is seen.  A task keeps its k best across shards, so later shards stop earlier.

A task passes on k rows per query; the best of all are taken in two steps, so that no
group gets the rows of all tasks at once.  Postings are not shuffled, so a term that every document holds,
or copies by the thousand, make no hot key.  Queries come in blocks of ``BLOCK_BYTES`` of text, one
after another, so what the tasks are sent is bounded.

Defined cases: a null or empty text has no terms, as a query it finds nothing; documents that
score 0 are no results; equal scores are ordered by id, null last; a repeated document is ranked as often as
it is there; equal rows of the queries count once; an empty table on either side gives an
empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyho.llm.common import Words, batches, materialize

K = 10
SHARD_POSTINGS = 1 << 21
BLOCK_BYTES = 16 << 20      # of query texts
FIRST_READ = 8              # positions of each list read at first, then twice as many each time
SPREAD = 64                 # groups per query in the first step of the merge

#: Byte classes of the terms (fixed values); A-Z is lower-cased before.
CLASSES = np.ones(256, np.uint8)
CLASSES[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = 0


def terms(texts: list[bytes]) -> Words:
    return Words([t.lower() for t in texts], CLASSES)  # bytes.lower changes A-Z only


class Queries:
    """A block of queries: term hashes in order, and the terms (by number) and counts of each query."""

    def __init__(self, ids: list, texts: list[bytes]):
        words = terms(texts)
        self.vocabulary, number = np.unique(words.hash, return_inverse=True)
        self.ids, self.terms, self.counts = ids, [], []
        for a, b in zip(words.first, words.first[1:]):
            kinds, counts = np.unique(number[a:b], return_counts=True)
            self.terms.append(kinds)
            self.counts.append(counts)


def postings(docs: DataFrame, queries: Queries) -> DataFrame:
    """``id, n, terms, counts`` of each document (id, text): its length and the query terms in it."""
    known = docs.sparkSession.sparkContext.broadcast(queries.vocabulary)

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = known.value
        for batch, texts in batches(rows, "text"):
            words = terms(texts)
            at = np.minimum(np.searchsorted(vocabulary, words.hash), max(len(vocabulary) - 1, 0))
            hit = np.flatnonzero(vocabulary[at] == words.hash) if len(vocabulary) else np.zeros(0, np.int64)
            pair, counts = np.unique(words.document()[hit] * np.int64(len(vocabulary) + 1) + at[hit], return_counts=True)
            offsets = pa.array(np.searchsorted(pair // (len(vocabulary) + 1), np.arange(len(texts) + 1)), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(words.counts, pa.int64()),
                 pa.ListArray.from_arrays(offsets, pa.array(pair % (len(vocabulary) + 1), pa.int32())),
                 pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int32()))], names=["id", "n", "terms", "counts"])

    schema = T.StructType([docs.schema["id"], T.StructField("n", T.LongType()),
                           T.StructField("terms", T.ArrayType(T.IntegerType())), T.StructField("counts", T.ArrayType(T.IntegerType()))])
    return docs.mapInArrow(work, schema)


class Shard:
    """The impact lists of some documents and the position of every posting in its list.

    Postings are numbered document by document (``first``); slots are numbered list by
    list (``begin``), and ``slot`` is a posting's place there."""

    def __init__(self, n: np.ndarray, first: np.ndarray, term: np.ndarray, count: np.ndarray,
                 weights: np.ndarray, documents: int, length: int):
        longest = int(n.max(initial=0))
        if 75 * longest * documents < 1 << 63:
            m = 25 + 75 * n * documents // length
        else:
            m = np.array([25 + 75 * int(x) * documents // length for x in n], np.int64)
        self.first, self.term = first, term
        self.impact = weights[term] * (1_000_000_000 * count // (1000 * count + 8 * np.repeat(m, np.diff(first))))
        order = np.lexsort((-self.impact, term))
        self.slot = np.empty(len(order), np.int64)
        self.slot[order] = np.arange(len(order))
        self.begin = np.searchsorted(term[order], np.arange(len(weights) + 1))
        self.list_impact = self.impact[order]
        self.list_document = np.repeat(np.arange(len(n)), np.diff(first))[order]
        self.seen = np.zeros(len(order), bool)

    def search(self, query: np.ndarray, counts: np.ndarray, k: int, kth: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores: all that can be among the k best and score ``kth`` or more."""
        full = self.begin[query + 1] > self.begin[query]
        query, counts = query[full], counts[full]
        best, end = self.begin[query].copy(), self.begin[query + 1]  # the slot behind each list's best position
        read = best.copy()
        weight = np.zeros(len(self.begin) - 1, np.int64)
        weight[query] = counts
        met = np.zeros(len(self.first) - 1, bool)
        touched, found, scores = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        top, step = np.full(k, kth, np.int64), FIRST_READ
        while True:
            open_lists = best < end
            bound = int((self.list_impact[np.minimum(best, len(self.seen) - 1)] * counts)[open_lists].sum())
            if bound == 0 or bound < top[0]:
                break
            until = np.minimum(read + step, end)
            slots = np.concatenate([np.arange(a, b) for a, b in zip(read[open_lists], until[open_lists])])
            read, step = until, step * 2
            fresh = np.unique(self.list_document[slots])
            fresh = fresh[~met[fresh]]
            if len(fresh):  # direct access
                met[fresh] = True
                sizes = self.first[fresh + 1] - self.first[fresh]
                ends = np.cumsum(sizes)
                at = np.repeat(self.first[fresh] - (ends - sizes), sizes) + np.arange(ends[-1])
                wanted = weight[self.term[at]]
                score = np.add.reduceat(self.impact[at] * wanted, ends - sizes)
                own = self.slot[at[wanted > 0]]
                self.seen[own] = True
                touched.append(own)
                good = score >= max(kth, 1)
                found.append(fresh[good])
                scores.append(score[good])
                top = np.sort(np.concatenate((top, scores[-1])))[-k:]
            for i in np.flatnonzero(open_lists):  # the read slots are seen, and some behind them by direct access
                best[i] = max(best[i], read[i])
                while best[i] < end[i] and self.seen[best[i]]:
                    run = self.seen[best[i]:min(best[i] + 4096, end[i])]
                    gap = int(run.argmin())
                    best[i] += len(run) if run[gap] else gap
            read = np.maximum(read, best)
        for own in touched:
            self.seen[own] = False
        return np.concatenate(found), np.concatenate(scores)


def _shards(rows: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in rows:
        ends = np.cumsum(pc.list_value_length(batch.column("terms")).to_numpy(zero_copy_only=False))
        a = 0
        while a < batch.num_rows:
            before = ends[a - 1] if a else 0
            b = max(int(np.searchsorted(ends, before + most - size, "right")), a + (not held))
            if b > a:
                held.append(batch.slice(a, b - a))
                size += int(ends[b - 1] - before)
                a = b
            if a < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _flat(column: pa.ChunkedArray) -> np.ndarray:
    return np.concatenate([np.asarray(x.flatten()) for x in column.chunks]).astype(np.int64)


def _best(stored: DataFrame, queries: Queries, weights: np.ndarray, documents: int, length: int, k: int,
          most: int) -> DataFrame:
    """``query, id, score``: each task's k best of every query."""
    sent = stored.sparkSession.sparkContext.broadcast((queries.terms, queries.counts, weights))

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query_terms, query_counts, weight = sent.value
        best: list[list[tuple]] = [[] for _ in query_terms]  # (-score, id is null, id)
        kind = None
        for part in _shards(rows, most):
            kind = part.schema.field("id").type
            sizes = np.concatenate([np.asarray(pc.list_value_length(x)) for x in part.column("terms").chunks])
            first = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            if not first[-1]:
                continue
            shard = Shard(part.column("n").to_numpy(), first, _flat(part.column("terms")), _flat(part.column("counts")),
                          weight, documents, length)
            ids = part.column("id").combine_chunks()
            rank = np.empty(len(ids), np.int64)
            rank[np.asarray(pc.sort_indices(ids))] = np.arange(len(ids))  # nulls at the end
            for q, (own, counts) in enumerate(zip(query_terms, query_counts)):
                kth = -best[q][-1][0] if len(best[q]) == k else 0
                found, scores = shard.search(own, counts, k, kth)
                chosen = np.lexsort((rank[found], -scores))[:k]
                if len(chosen):
                    names = ids.take(pa.array(found[chosen])).to_pylist()
                    more = [(-s, x is None, x) for s, x in zip(scores[chosen].tolist(), names)]
                    best[q] = sorted(best[q] + more, key=lambda r: (r[0], r[1], r[2] if r[2] is not None else 0))[:k]
        if kind is not None:
            out = [(q, x, -s) for q, rows_ in enumerate(best) for s, _, x in rows_]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], kind),
                                              pa.array([r[2] for r in out], pa.int64())], names=["query", "id", "score"])

    schema = T.StructType([T.StructField("query", T.IntegerType()), stored.schema["id"], T.StructField("score", T.LongType())])
    found = stored.mapInArrow(work, schema)
    falling = [F.col("score").desc(), F.col("id").asc_nulls_last()]
    near = Window.partitionBy("query", "part").orderBy(*falling)
    some = found.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(SPREAD))).withColumn("rank", F.row_number().over(near))
    every = Window.partitionBy("query").orderBy(*falling)
    return some.where(F.col("rank") <= k).withColumn("rank", F.row_number().over(every)).where(F.col("rank") <= k)


def search(docs: DataFrame, queries: DataFrame, k: int = K, id_col: str = "doc_id", text: str = "text",
           query_id: str = "item_id", query_text: str = "text", shard_postings: int = SHARD_POSTINGS,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``query_id, rank, id_col, score``: the k best documents of every query that score above 0."""
    corpus = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text}`").alias("text"))
    asked = queries.select(F.col(f"`{query_id}`").alias("id"), F.coalesce(F.col(f"`{query_text}`"), F.lit("")).alias("text")).distinct()
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    results = []
    for b in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == b).collect()
        block = Queries([r["id"] for r in rows], [r["text"].encode() for r in rows])
        stored = materialize(postings(corpus, block), "impacts")
        size = stored.agg(F.count(F.when(F.col("n") > 0, 1)).alias("documents"), F.sum("n").alias("length")).first()
        if not size["documents"]:
            continue
        weights = np.zeros(len(block.vocabulary), np.int64)
        for term, df in stored.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow().to_pandas().itertuples(index=False):
            weights[term] = math.floor(1000 * math.log((2 * size["documents"] + 2) / (2 * df + 1)))
        found = _best(stored, block, weights, size["documents"], size["length"], k, shard_postings)
        names = docs.sparkSession.createDataFrame(
            [(i, x) for i, x in enumerate(block.ids)], T.StructType([T.StructField("query", T.IntegerType()), T.StructField(
                "name", queries.schema[query_id].dataType)]))
        results.append(found.join(F.broadcast(names), "query").select(
            F.col("name").alias("c0"), "rank", F.col("id").alias("c1"), "score"))
    if not results:
        empty = T.StructType([T.StructField(query_id, queries.schema[query_id].dataType), T.StructField("rank", T.IntegerType()),
                              T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("score", T.LongType())])
        return docs.sparkSession.createDataFrame([], empty)
    return reduce(DataFrame.unionByName, results).toDF(query_id, "rank", id_col, "score")
