"""Document fingerprints: a quartile bucket digest of hashed byte triplets.

Every text's byte triplets (three bytes at the offsets of ``SHAPES``) are hashed
into ``BUCKETS`` counters.  A bucket's code, 0 to 3, says between which quartiles of
the text's own counters its count lies; the digest is the codes (two bits each)
and a logarithmic length code, as hex.  ``likeness`` is 1 minus a bounded
difference: mean code distance and length code distance, weighted.

Defined cases: a null text is the empty text; empty and very short texts have all
codes 0; equal texts have equal digests; a text of any length is read whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyho.llm.common import U64, batches, chunks, materialize, mix, shuffle_width, utf8, with_text_column

BUCKETS = 256
SHAPES = ((0, 2, 5), (0, 3, 7))
SPAN = 8                 # zero bytes between two texts, more than any shape reaches
LENGTH_WEIGHT = 0.1
LENGTH_STEPS = 64        # length codes per text; four of them per doubling


def digests(texts: list[bytes]) -> np.ndarray:
    """One digest per text: ``BUCKETS`` codes and the length code (uint8)."""
    out = np.zeros((len(texts), BUCKETS + 1), np.uint8)
    for a, b in chunks(map(len, texts)):
        part = texts[a:b]
        lengths = np.array([len(t) for t in part])
        buf = np.frombuffer((b"\0" * SPAN).join(part) + b"\0" * SPAN, np.uint8).astype(U64)
        starts = np.concatenate(([0], np.cumsum(lengths + SPAN)[:-1]))
        counts = np.zeros((len(part), BUCKETS), np.int64)
        for s, (i, j, k) in enumerate(SHAPES):
            # positions of triplets that lie inside one text
            n = np.maximum(0, lengths - k)
            where = np.repeat(starts - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            h = buf[where + i] | buf[where + j] << U64(8) | buf[where + k] << U64(16) | U64(s << 24)
            bucket = (mix(h) >> U64(50)).astype(np.int64) % BUCKETS
            text = np.repeat(np.arange(len(part)), n)
            counts += np.bincount(text * BUCKETS + bucket, minlength=counts.size).reshape(counts.shape)
        ranked = np.sort(counts, axis=1)
        code = np.zeros(counts.shape, np.uint8)
        for q in (1, 2, 3):
            code += counts > ranked[:, [BUCKETS * q // 4 - 1]]
        out[a:b, :BUCKETS] = code
        out[a:b, BUCKETS] = np.minimum(LENGTH_STEPS * 4 - 1, np.round(4 * np.log2(1 + lengths)))
    return out


def encode(codes: np.ndarray) -> list[str]:
    """Hex of the packed codes, the length code last."""
    four = codes[:, :BUCKETS].reshape(len(codes), -1, 4)
    packed = (four * np.array([64, 16, 4, 1], np.uint8)).sum(axis=2).astype(np.uint8)
    return [r.tobytes().hex() for r in np.hstack([packed, codes[:, BUCKETS:]])]


def likeness(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """1 for equal digests, down to 0, row by row."""
    apart = np.abs(x[:, :BUCKETS].astype(int) - y[:, :BUCKETS]).mean(axis=1) / 3
    longer = np.minimum(1, np.abs(x[:, BUCKETS].astype(int) - y[:, BUCKETS]) / LENGTH_STEPS)
    return 1 - (1 - LENGTH_WEIGHT) * apart - LENGTH_WEIGHT * longer


def with_fingerprint(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with its text's digest as column ``out`` (replaced if there); no shuffle."""
    return with_text_column(df, text, out, T.StringType(), lambda texts: encode(digests(texts)))


#: Bytes of text per range partition that ``successor_report`` aims for.
RANGE_BYTES = 64 << 20
_REPORT = ("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def splice(text: str, following: str) -> str:
    """``text`` with its last third replaced by the first as many code points of ``following``."""
    k = len(text) // 3
    return text[:len(text) - k] + following[:k]


def _report(texts: list[str], following: list[str]) -> dict[str, list]:
    edited = [splice(a, b) for a, b in zip(texts, following)]
    raw = [t.encode("utf-8", "replace") for t in edited]
    own, new, after = (digests(x) for x in ([t.encode("utf-8", "replace") for t in texts], raw,
                                             [t.encode("utf-8", "replace") for t in following]))
    return {"n_chars": [len(t) for t in texts], "edited_sha256": [hashlib.sha256(t).hexdigest() for t in raw],
            "fingerprint": encode(own), "edited_fingerprint": encode(new),
            "near_edited": likeness(own, new), "near_next": likeness(own, after)}


def successor_report(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of every text, of the text edited with its successor's beginning,
    and both likenesses; the successor is the next row in descending ``id_col`` (ties
    by text), the first row after the last.

    One shuffle: rows are range-partitioned and sorted; each task streams its run and
    hands its first and last row to a small written table, in which the last row of
    each run meets the first one of the next run (two rows per task, joined by run).
    """
    spark = df.sparkSession
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    runs = max(shuffle_width(spark), math.ceil(total / RANGE_BYTES))
    kind = rows.schema["id"].dataType.simpleString()
    ordered = (rows.repartitionByRange(runs, F.col("id").desc())
               .sortWithinPartitions(F.col("id").desc(), F.col("text")))
    full = f"id {kind}, {_REPORT}, run int, first boolean, text string"
    schema = spark.createDataFrame([], full).schema
    arrow = to_arrow_schema(schema)

    def edge(run: int, first: bool, key, value: str) -> pa.RecordBatch:
        cells = {"id": key, "run": run, "first": first, "text": value}
        return pa.RecordBatch.from_pydict({f.name: [cells.get(f.name)] for f in arrow}, schema=arrow)

    def walk(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, held = TaskContext.get().partitionId(), None
        for batch, raw in batches(batches_in, "text"):
            ids, texts = batch.column("id").to_pylist(), [t.decode("utf-8", "replace") for t in raw]
            if held is None:
                yield edge(run, True, ids[0], texts[0])
            else:
                ids, texts = [held[0], *ids], [held[1], *texts]
            held = ids[-1], texts[-1]
            if len(ids) > 1:
                n = len(ids) - 1
                cells = {"id": ids[:-1], **_report(texts[:-1], texts[1:])}
                yield pa.RecordBatch.from_pydict({f.name: cells.get(f.name, [None] * n) for f in arrow}, schema=arrow)
        if held is not None:
            yield edge(run, False, *held)

    done = materialize(ordered.mapInArrow(walk, schema), "fingerprint-runs")
    edges = done.where("run IS NOT NULL")
    by_run = Window.orderBy("run")  # one row per non-empty task
    following = (edges.where("first").select("run")
                 .select("run", F.coalesce(F.lead("run").over(by_run), F.min("run").over(Window.partitionBy()))
                         .alias("next_run")))
    pairs = (edges.where("NOT first").select("run", "id", "text").join(following, "run")
             .join(edges.where("first").select(F.col("run").alias("next_run"), F.col("text").alias("next_text")),
                   "next_run").select("id", "text", "next_text"))

    def join_ends(batches_in: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_in:
            a, b = ([t.decode("utf-8", "replace") for t in utf8(batch.column(c))] for c in ("text", "next_text"))
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), **_report(a, b)})

    ends = pairs.mapInArrow(join_ends, f"id {kind}, {_REPORT}")
    out = done.where("run IS NULL").drop("run", "first", "text").unionByName(ends)
    return out.withColumnRenamed("id", id_col)
