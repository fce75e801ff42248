"""Substring dedup: repeated windows of words found by sharded FM-indexes.

A window is ``WINDOW`` = 13 consecutive words ``[^\\x20\\x09-\\x0D]+`` of one document; a word
goes if a window that covers it also starts in a document with a smaller id.

An index per shard of documents would need every document streamed through every
shard.  Instead equal windows are brought to one shard: a window's *anchor* is the
least of its hashed 5-grams, consecutive windows with the same anchor are a *run*, and
a run goes to the shard of its anchor.

1. Tasks list the anchors of their documents; within a group of documents (some MB)
   an anchor is sent once, whatever the number of documents that have it.
2. An anchor met in two documents marks their runs (``ordinal`` within the document);
   other runs can't repeat and need no index.
3. Marked runs go to the shards, equal runs of a group once (the smallest id stands for
   them; the others repeat it, all their windows go).
4. Each shard builds an FM-index of its distinct runs and streams them through it: the
   matching statistics of every window, and the smallest id in its suffix range.
5. Windows of 13 matched words with a smaller id are reported as word spans and taken
   out of the texts, document by document.

Words enter the index as 40 bits of their hash.  Shards are sized by the number of
marked runs; texts are shuffled twice, everything else is smaller.

Defined cases: null and empty texts have no words; texts of fewer than 13 words keep
them all; documents with the same id don't remove from each other; a null id counts as
larger than all others; equal rows get equal results; an empty table gives an empty
result; ids must be integers; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.llm.common import U64, Words, _powers, batches, gram_hashes, materialize, mix, shuffle_width
from tallyho.llm.fmindex import FMIndex

WINDOW = 13
GRAM = 5
GROUP_BYTES = 4 << 20        # documents whose anchors and runs are combined before the shuffle
BUCKET_BYTES = 64 << 20      # text per bucket of anchors
SHARD_WORDS = 1 << 20        # words per index shard
RUN_WORDS = 18               # about the mean length of a run
NO_ID = (1 << 63) - 1        # stands for a null id
_WORD, _ANCHOR = 5, 6        # bytes kept of a word's and of an anchor's hash


class Runs:
    """Runs of windows with one anchor, over all documents of a chunk."""

    def __init__(self, words: Words):
        grams = gram_hashes(words.hash, GRAM)
        span = WINDOW - GRAM + 1
        n = max(0, len(grams) - span + 1)
        best, at = grams[:n].copy(), np.zeros(n, np.int64)
        for j in range(1, span):
            lower = grams[j:j + n] < best
            best[lower] = grams[j:j + n][lower]
            at[lower] = j
        document = words.document()
        whole = np.flatnonzero(document[:n] == document[WINDOW - 1:WINDOW - 1 + n]) if n else np.zeros(0, np.int64)
        anchor, doc = whole + at[whole], document[whole]
        new = np.ones(len(whole), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(whole)])) - 1 if len(first) else first
        self.words = words
        self.document = doc[first]
        self.hash = best[whole[first]]
        self.start = whole[first]                 # word range of the run
        self.end = whole[last] + WINDOW
        from_doc = np.searchsorted(self.document, np.arange(len(words.first) - 1))
        self.ordinal = np.arange(len(first)) - from_doc[self.document]

    def __len__(self) -> int:
        return len(self.hash)

    def offset(self, i: np.ndarray) -> np.ndarray:
        """Where in its document a run starts."""
        return self.start[i] - self.words.first[self.document[i]]


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays of equal length, one after the other."""
    return len(arrays[0]).to_bytes(8, "little") + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)


def unpacked(blobs: list[bytes], *kinds) -> list[np.ndarray]:
    out: list[list[np.ndarray]] = [[] for _ in kinds]
    for blob in blobs:
        n, at = int.from_bytes(blob[:8], "little"), 8
        for k, kind in enumerate(kinds):
            kind = np.dtype(kind)
            out[k].append(np.frombuffer(blob, kind, n, at))
            at += n * kind.itemsize
    return [np.concatenate(a) if a else np.zeros(0, k) for a, k in zip(out, kinds)]


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)


def _by(key: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Positions of each value of ``key``."""
    order = np.argsort(key, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(key[order])) + 1):
        if len(part):
            yield int(key[part[0]]), part


def _wide(raw: np.ndarray) -> np.ndarray:
    """Rows of a few bytes as integers."""
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :raw.shape[1]] = raw
    return out.view(U64)[:, 0]


#: Rows between the steps: ``kind`` 0 has work for ``part``, kind 1 findings about the documents of
#: ``part`` that only pass through.  A blob holds arrays of equal length.
_ROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("blob", pa.binary())])
_ROW_SQL = "part int, kind int, blob binary"


def _rows(cells: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([c[i] for c in cells], f.type) for i, f in enumerate(_ROW)], schema=_ROW)


def _received(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], pa.RecordBatch]]:
    """Of each batch the blobs to work on, and the rows that only pass through."""
    for batch in rows:
        through = pc.equal(batch.column("kind"), 1)
        yield batch.filter(pc.invert(through)).column("blob").to_pylist(), batch.filter(through)


def _findings(ids: np.ndarray, parts: int, *arrays: np.ndarray) -> list[tuple]:
    """Rows of findings: the arrays, and the ids first, by the part of the id."""
    return [(part, 1, packed(ids[p], *(a[p] for a in arrays))) for part, p in _by(ids % parts)] if len(ids) else []


def anchors(docs: DataFrame, buckets: int) -> DataFrame:
    """Per group and bucket a row of work (hash, id, ordinal), and findings (id, ordinal): the
    runs whose anchor repeats within its group."""
    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(rows, "text", GROUP_BYTES):
            runs = Runs(Words(texts))
            if not len(runs):
                continue
            ids = _ids(batch)[runs.document]
            order = np.lexsort((ids, runs.hash))
            h, d = runs.hash[order], runs.document[order]
            new = np.concatenate(([True], h[1:] != h[:-1]))
            group = np.cumsum(new) - 1
            first = np.flatnonzero(new)
            repeats = (np.minimum.reduceat(d, first) != np.maximum.reduceat(d, first))[group]
            found = order[repeats]
            cells = _findings(ids[found], buckets, runs.ordinal[found].astype(np.int32))
            # one occurrence of each anchor stands for the group, others of one document too
            sent = order[new | ~repeats]
            known = repeats[new | ~repeats]
            ordinal = np.where(known, -1, runs.ordinal[sent]).astype(np.int32)
            for bucket, p in _by(_part(runs.hash[sent], buckets)):
                cells.append((bucket, 0, packed(_cut(runs.hash[sent][p], _ANCHOR), ids[sent][p], ordinal[p])))
            yield _rows(cells)

    return docs.mapInArrow(work, _ROW_SQL)


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return (h & U64(0xFFFFFFFF)).astype(np.int64) % parts


def _cut(h: np.ndarray, size: int) -> np.ndarray:
    """The upper ``size`` bytes of hashes, one row each (the lower ones choose the part)."""
    return h.view(np.uint8).reshape(-1, 8)[:, 8 - size:]


def marked(sent: DataFrame, buckets: int) -> DataFrame:
    """``id, marks``: of every document that has any, a blob of the ordinals of the runs whose
    anchor occurs in several documents."""
    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[bytes] = []
        for own, through in _received(rows):
            blobs += own
            yield through
        cut, ids, ordinal = unpacked(blobs, np.dtype((np.void, _ANCHOR)), np.int64, np.int32)
        if not len(cut):
            return
        h = _wide(cut.view(np.uint8).reshape(-1, _ANCHOR))
        order = np.argsort(h, kind="stable")
        h, ids, ordinal = h[order], ids[order], ordinal[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        size = np.diff(np.concatenate((first, [len(h)])))
        # two ids, or an anchor that repeats in its group (ordinal -1) besides others
        several = (np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)) | \
            (np.minimum.reduceat(ordinal, first) < 0)
        keep = np.flatnonzero(np.repeat(several & (size > 1), size) & (ordinal >= 0))
        yield _rows(_findings(ids[keep], buckets, ordinal[keep]))

    def gather(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, ordinal = unpacked([b for batch in rows for b in batch.column("blob").to_pylist()], np.int64, np.int32)
        for some in _slices(_by(ids)):
            yield pa.RecordBatch.from_pydict({"id": [i for i, _ in some], "marks": [packed(ordinal[p]) for _, p in some]})

    found = sent.repartition(buckets, "part").mapInArrow(work, _ROW_SQL)
    return found.repartition(buckets, "part").mapInArrow(gather, "id bigint, marks binary")


def _slices(groups: Iterator, size: int = 10_000) -> Iterator[list]:
    some: list = []
    for g in groups:
        some.append(g)
        if len(some) == size:
            yield some
            some = []
    if some:
        yield some


def runs_to_shards(docs: DataFrame, shards: int) -> DataFrame:
    """``docs`` (id, row, text, marks) to a row of work per group and shard, and findings (id, row,
    span) of the runs that repeat one of their group."""
    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(rows, "text", GROUP_BYTES):
            runs = Runs(Words(texts))
            marks = batch.column("marks").to_pylist()
            known = np.zeros(len(runs), bool)
            from_doc = np.searchsorted(runs.document, np.arange(len(texts) + 1))
            for d, blob in enumerate(marks):
                (at,) = unpacked([blob], np.int32)
                known[from_doc[d] + at[at < from_doc[d + 1] - from_doc[d]]] = True
            picked = np.flatnonzero(known)
            if not len(picked):
                continue
            ids, row = _ids(batch), batch.column("row").to_numpy()
            up, down = _powers(len(runs.words) + 1)
            total = np.concatenate((np.zeros(1, U64), np.cumsum(runs.words.hash * up[:-1])))
            key = mix((total[runs.end] - total[runs.start]) * down[runs.start] + (runs.end - runs.start).astype(U64))
            order = picked[np.lexsort((ids[runs.document[picked]], key[picked]))]
            new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
            own = ids[runs.document[order]]
            repeats = own > own[np.flatnonzero(new)][np.cumsum(new) - 1]
            p = order[repeats]
            begin = runs.offset(p)
            cells = _findings(ids[runs.document[p]], shards, row[runs.document[p]], begin.astype(np.int32),
                              (begin + runs.end[p] - runs.start[p]).astype(np.int32))
            sent = order[~repeats]
            for shard, p in _by(_part(runs.hash[sent], shards)):
                p = sent[p]
                length = runs.end[p] - runs.start[p]
                at = np.repeat(runs.start[p] - (np.cumsum(length) - length), length) + np.arange(length.sum())
                d = runs.document[p]
                head = packed(ids[d], row[d], runs.offset(p).astype(np.int32), length.astype(np.int32))
                body = _cut(runs.words.hash[at], _WORD).tobytes()
                cells.append((shard, 0, len(head).to_bytes(8, "little") + head + body))
            yield _rows(cells)

    return docs.mapInArrow(work, _ROW_SQL)


def shard_spans(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All runs of a shard: id, row, start and end of the word spans that repeat a smaller id."""
    cut = [8 + int.from_bytes(b[:8], "little") for b in blobs]
    ids, row, offset, length = unpacked([b[8:c] for b, c in zip(blobs, cut)], np.int64, np.int64, np.int32, np.int32)
    if not len(ids):
        return ids, row, offset, offset
    raw = np.frombuffer(b"".join(b[c:] for b, c in zip(blobs, cut)), np.uint8).reshape(-1, _WORD)
    _, symbol = np.unique(_wide(raw), return_inverse=True)
    del raw
    symbol += 1
    start = np.cumsum(length, dtype=np.int64) - length
    # Equal runs are indexed once, with their smallest id.
    up, down = _powers(len(symbol))
    total = np.concatenate((np.zeros(1, U64), np.cumsum(mix(symbol.astype(U64)) * up)))
    key = mix((total[start + length] - total[start]) * down[start] + length.astype(U64))
    order = np.lexsort((ids, key))
    new = np.concatenate(([True], key[order][1:] != key[order][:-1]))
    kind = np.empty(len(ids), np.int64)
    kind[order] = np.cumsum(new) - 1
    lead = order[new]                                     # the run that stands for each kind
    size = length[lead].astype(np.int64)
    text_at = np.cumsum(size + 1) - (size + 1)
    text = np.zeros(int((size + 1).sum()), np.int64)
    owner = np.repeat(np.arange(len(lead)), size + 1)     # kind of each text position
    inside = np.arange(len(text)) - text_at[owner]
    real = inside < size[owner]
    text[real] = symbol[start[lead][owner[real]] + inside[real]]
    index = FMIndex(text)
    windows = np.flatnonzero(real & (inside <= size[owner] - WINDOW))
    matched, low, high = index.matching(windows + WINDOW - 1, WINDOW)
    smallest = np.full(len(windows), NO_ID)
    found = np.flatnonzero(matched == WINDOW)
    smallest[:] = ids[lead][owner[windows]]
    if len(found):
        by_suffix = np.append(ids[lead][owner[index.suffixes]], NO_ID)
        ranges, back = np.unique(low[found], return_inverse=True)
        ends = np.empty(len(ranges), np.int64)
        ends[back] = high[found]
        edges = np.stack((ranges, ends), axis=1).ravel()
        smallest[found] = np.minimum.reduceat(by_suffix, edges)[::2][back]
    first_window = np.searchsorted(windows, text_at)
    # every run, also one of those that share a kind: windows with a smaller id than its own
    n = length.astype(np.int64) - WINDOW + 1
    run = np.repeat(np.arange(len(ids)), n)
    within = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    gone = smallest[first_window[kind[run]] + within] < ids[run]
    run, within = run[gone], within[gone]
    fresh = np.ones(len(run), bool)
    fresh[1:] = (run[1:] != run[:-1]) | (within[1:] != within[:-1] + 1)
    a = np.flatnonzero(fresh)
    b = np.append(a[1:], len(run)) - 1 if len(a) else a
    begin, end = offset[run[a]] + within[a], offset[run[a]] + within[b] + WINDOW
    return ids[run[a]], row[run[a]], begin.astype(np.int32), end.astype(np.int32)


def repeated_spans(sent: DataFrame, shards: int) -> DataFrame:
    """``id, row, spans``: of every document that has any, a blob of the word spans to remove."""
    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[bytes] = []
        for own, through in _received(rows):
            blobs += own
            yield through
        ids, *found = shard_spans(blobs)
        yield _rows(_findings(ids, shards, *found))

    def gather(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs = [b for batch in rows for b in batch.column("blob").to_pylist()]
        ids, row, begin, end = unpacked(blobs, np.int64, np.int64, np.int32, np.int32)
        order = np.lexsort((row, ids))
        change = np.flatnonzero((np.diff(ids[order]) != 0) | (np.diff(row[order]) != 0)) + 1
        for some in _slices(p for p in np.split(order, change) if len(p)):
            yield pa.RecordBatch.from_pydict({"id": [int(ids[p[0]]) for p in some], "row": [int(row[p[0]]) for p in some],
                                              "spans": [packed(begin[p], end[p]) for p in some]})

    found = sent.repartition(shards, "part").mapInArrow(work, _ROW_SQL)
    return found.repartition(shards, "part").mapInArrow(gather, "id bigint, row bigint, spans binary")


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, n_words, n_removed, kept`` (the kept words joined by a space, as ``kept_sha256``
    too) for every row."""
    spark = df.sparkSession
    docs = df.select(F.col(id_col).cast("bigint").alias("id0"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    docs = docs.select(F.coalesce("id0", F.lit(NO_ID)).alias("id"), F.xxhash64("id0", "text").alias("row"), "id0", "text")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(shuffle_width(spark), math.ceil(total / BUCKET_BYTES))
    marks = materialize(marked(anchors(docs.select("id", "text"), buckets), buckets), "repeat-marks")
    runs = marks.agg(F.sum(F.octet_length("marks"))).first()[0] or 0
    shards = max(shuffle_width(spark), math.ceil(runs / 4 * RUN_WORDS / SHARD_WORDS))
    sent = runs_to_shards(docs.drop("id0").join(marks, "id"), shards)
    spans = repeated_spans(sent, shards)
    kind = df.schema[id_col].dataType

    def work(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(rows, "text"):
            n_words, n_removed, kept = [], [], []
            for t, blob in zip(texts, batch.column("spans").to_pylist()):
                words = t.split()
                n_words.append(len(words))
                if blob:
                    begin, end = unpacked([blob], np.int32, np.int32)
                    cover = np.zeros(len(words) + 1, np.int64)
                    np.add.at(cover, begin, 1)
                    np.add.at(cover, end, -1)
                    stays = np.cumsum(cover)[:-1] == 0
                    words = [w for w, s in zip(words, stays.tolist()) if s]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id0"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array([k.decode("utf-8", "replace") for k in kept], pa.string()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())],
                names=["id0", "n_words", "n_removed", "kept", "kept_sha256"])

    placed = docs.join(materialize(spans, "repeat-spans"), ["id", "row"], "left").select("id0", "text", "spans")
    out = placed.mapInArrow(work, "id0 bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string")
    return out.select(F.col("id0").cast(kind).alias(id_col), "n_words", "n_removed", "kept", "kept_sha256")
