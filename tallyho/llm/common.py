"""Shared helpers: input tables, written hand-over tables and byte-level hashing.

The numpy helpers work on *chunks*: the UTF-8 bytes of several whole documents
joined by one separator byte, at most ``CHUNK_BYTES`` together (a longer
document is a chunk of its own), so that a task's memory is bounded by the
longest document, not by the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyho.session import fresh_dir, table_path

CHUNK_BYTES = 1 << 20

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it back:
    cuts the lineage, and a lost executor costs no recomputation."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def keyed(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """``docs`` with generic column names, and ``key_id``/``key_text`` to meet decisions by."""
    inner = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text)
    return inner.withColumns({"key_id": F.col(f"c{id_at}"), "key_text": text_key(F.coalesce(F.col(f"c{text_at}"), F.lit("")))})


def decided(docs: DataFrame, decisions: DataFrame, id_col: str, text: str, *carry: str) -> DataFrame:
    """All columns of the rows of ``docs`` named by ``decisions`` (``id, node, n`` and ``carry``), once
    per decision: where ``n`` equal rows share one, a single row stands for them."""
    rows = keyed(docs, id_col, text)
    inner = rows.columns[:-2]
    met = rows.join(decisions, F.col("key_id").eqNullSafe(F.col("id")) & (F.col("key_text") == F.col("node")))
    if not decisions.where("n > 1").isEmpty():  # equal rows are rare: only they are shuffled again
        met = met.where("n = 1").unionByName(met.where("n > 1").dropDuplicates(["id", "node"]))
    return met.select(*inner, *carry).toDF(*docs.columns, *carry)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_key(text: Column) -> Column:
    """The md5 of a text, as 16 bytes."""
    return F.unhex(F.md5(text.cast("binary")))


def utf8(column: pa.Array) -> list[bytes]:
    """Whole texts as UTF-8 bytes; null gives empty bytes."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def chunks(lengths: Iterable[int], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """``(first, end)`` index ranges whose lengths stay within ``limit`` (one text at least)."""
    first, size, i = 0, 0, -1
    for i, n in enumerate(lengths):
        if i > first and size + n > limit:
            yield first, i
            first, size = i, 0
        size += n + 1
    if first <= i:
        yield first, i + 1


def batches(rows: Iterable[pa.RecordBatch], text: str,
            limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the Arrow batches, each with its texts, within the chunk limit."""
    for batch in rows:
        for a, b in chunks(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist(), limit):
            part = batch.slice(a, b - a)
            yield part, utf8(part.column(text))


def with_text_column(df: DataFrame, text: str, out: str, kind: T.DataType,
                     compute: Callable[[list[bytes]], list | np.ndarray]) -> DataFrame:
    """``df`` with ``out`` (replaced if there) computed from whole texts; other columns are
    carried along whatever their names.  No shuffle."""
    kept = [c for c in df.columns if c != out]
    rows = df.select(*[F.col(f"`{c}`") for c in kept])
    inner = [f"c{i}" for i in range(len(kept))]
    schema = T.StructType([*rows.toDF(*inner).schema.fields, T.StructField("out", kind)])
    at = kept.index(text)

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for batch, texts in batches(parts, inner[at]):
            values = pa.array(compute(texts), arrow.field("out").type)
            yield pa.RecordBatch.from_arrays([*batch.columns, values], names=[*inner, "out"])

    return rows.toDF(*inner).mapInArrow(work, schema).toDF(*kept, out)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values so that every output bit depends on every input bit."""
    h = h ^ (h >> U64(31))
    h = h * U64(0x7FB5D329728EA185)
    h ^= h >> U64(27)
    h *= U64(0x81DADEF4BC2DD44D)
    h ^= h >> U64(33)
    return h


def mix_into(h: np.ndarray, half: np.ndarray) -> None:
    """``mix`` in place; ``half`` is a scratch array of the same size."""
    for shift, factor in ((31, 0x7FB5D329728EA185), (27, 0x81DADEF4BC2DD44D), (33, 1)):
        np.right_shift(h, U64(shift), out=half)
        h ^= half
        if factor > 1:
            h *= U64(factor)


_POWERS = {"n": 0}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE**i`` and its inverse for i < n, modulo 2**64."""
    if _POWERS["n"] < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(n, base, U64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
        _POWERS["n"] = n
    return _POWERS["up"][:n], _POWERS["down"][:n]


def run_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each of the byte runs ``buf[start:end]``, which ascend."""
    out = np.empty(len(start), U64)
    i = 0
    while i < len(start):  # some bytes at a time: prefix sums take eight times as much
        base = start[i]
        j = max(i + 1, int(np.searchsorted(end, base + CHUNK_BYTES // 2, "right")))
        first, last = start[i:j] - base, end[i:j] - base
        up, down = _powers(int(last[-1]))
        total = np.zeros(int(last[-1]) + 1, U64)
        np.cumsum((buf[base:base + last[-1]].astype(U64) + U64(1)) * up, out=total[1:])
        out[i:j] = mix((total[last] - total[first]) * down[first])
        i = j
    return out


#: Byte classes of the words `[^\x20\x09-\x0D]+` (fixed values): 0 is white space.
PLAIN = np.ones(256, np.uint8)
PLAIN[list(b"\x20\x09\x0a\x0b\x0c\x0d")] = 0


class Words:
    """The words of a chunk: longest runs of bytes of one class other than 0.

    ``start``/``end`` are byte offsets, ``hash`` is 64 bits each, and document d has the
    words ``first[d]:first[d + 1]``.  The byte 0x20, which joins the documents, must be of
    class 0."""

    def __init__(self, texts: list[bytes], classes: np.ndarray = PLAIN):
        raw = b" ".join(texts) + b" "
        buf = np.frombuffer(raw, np.uint8)
        kind = classes[buf]
        edge = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1))
        run = np.flatnonzero(kind[edge])
        self.raw, self.start, self.end = raw, edge[run], edge[np.minimum(run + 1, len(edge) - 1)]
        lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
        self.text_end = np.cumsum(lengths)
        self.first = np.concatenate(([0], np.searchsorted(self.start, self.text_end)))
        self.hash = run_hashes(buf, self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def document(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def text(self, i: int) -> bytes:
        return self.raw[self.start[i]:self.end[i]]


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64-bit hash of each run of ``k`` consecutive word hashes (len - k + 1 of them)."""
    n = max(0, len(words) - k + 1)
    h = np.zeros(n, U64)
    for j in range(k):
        h = h * U64(_BASE) + words[j:j + n]
    return mix(h)
