"""Language ID: multinomial naive Bayes over hashed character n-grams.

``train`` counts n-grams of labelled texts per label (Spark tasks give one count
vector per label, the sum is bounded: labels x buckets) and ``predict`` broadcasts
the log-probability matrix and scores whole texts in numpy, chunk by chunk.

Characters: lower-cased code points; every ASCII character that is not a letter
counts as a space.  An n-gram never spans two documents.

Defined cases: a null or empty text, or one without any letter, gets ``und`` with
score 0.0 (numbers, also those like Ⅷ or ², are no letters); null labels and null texts don't train; repeated rows train repeatedly
and are scored alike; ties between labels go to the smallest label by code point;
an empty training table gives ``und`` throughout; more than ``MAX_LABELS`` labels raise; columns other than the named ones
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.llm.common import U64, batches, mix

NGRAMS = (1, 2, 3)
BUCKETS = 1 << 16
#: Bound of the training sample: at most about so many texts of each label.
MAX_TEXTS_PER_LABEL = 4_000
TRAIN_TASKS = 12
SMOOTHING = 0.1
UNDETERMINED = "und"
#: Labels at most: the matrix that tasks get has a row of half a megabyte for each.
MAX_LABELS = 256
_LETTER = regex.compile(r"\p{L}")
_ASCII = np.arange(128, dtype=np.uint32)
_ASCII[[i for i in range(128) if not chr(i).isalpha()]] = 32


@dataclass
class Model:
    labels: list[str]
    log_prob: np.ndarray   # (buckets + 1, labels); the last row is 0 (no n-gram)
    log_prior: np.ndarray


def ngram_ids(texts: list[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """N-gram buckets of all texts, one after the other: ``(ids (n, len(NGRAMS)), starts, codes)``.

    Texts are joined by NULs; an n-gram that touches one gets the bucket ``buckets``."""
    pad = "\0" * max(NGRAMS)
    joined = pad.join(texts) + pad
    code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    code = np.where(code < 128, _ASCII[np.minimum(code, 127)], code) * (code > 0)
    starts = np.cumsum([0] + [len(t) + len(pad) for t in texts[:-1]])
    n = len(code) - max(NGRAMS) + 1
    ids = np.empty((n, len(NGRAMS)), np.int32)
    wide = code.astype(U64)
    for j, size in enumerate(NGRAMS):
        h, whole = np.full(n, size, U64), np.ones(n, bool)
        for k in range(size):
            h = h * U64(0x110000) + wide[k:k + n]
            whole &= code[k:k + n] > 0
        ids[:, j] = np.where(whole, (mix(h) >> U64(40)).astype(np.int64) % buckets, buckets)
    return ids, starts, code


def train(df: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "lang",
          max_texts_per_label: int = MAX_TEXTS_PER_LABEL) -> Model:
    """Fit on at most about ``max_texts_per_label`` texts of each label, drawn by a
    hash of the id (the whole table where a label has no more)."""
    rows = df.select(F.col(id_col).alias("id"), F.col(text).alias("text"), F.col(label).alias("label"))
    rows = rows.where("text IS NOT NULL AND label IS NOT NULL")
    sizes = rows.groupBy(F.col("label").alias("of")).agg(F.count(F.lit(1)).alias("n"))
    if sizes.limit(MAX_LABELS + 1).count() > MAX_LABELS:
        raise ValueError(f"more than {MAX_LABELS} labels")
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("train")), F.lit(1 << 30)) / (1 << 30)
    sample = (rows.join(F.broadcast(sizes), F.col("label") == F.col("of"))  # a row per label
              .where(draw * F.col("n") < max_texts_per_label)
              .select("label", "text").repartition(TRAIN_TASKS))

    def count(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[np.ndarray, int]] = {}
        for batch, texts in batches(rows, "text"):
            by: dict[str, list[str]] = {}
            for name, t in zip(batch.column("label").to_pylist(), texts):
                by.setdefault(name, []).append(t.decode("utf-8", "replace").lower())
            for name, mine in by.items():
                ids, _, _ = ngram_ids(mine)
                counts, n = seen.get(name, (np.zeros(BUCKETS, np.int64), 0))
                seen[name] = (counts + np.bincount(ids.ravel(), minlength=BUCKETS + 1)[:BUCKETS], n + len(mine))
        if seen:
            yield pa.RecordBatch.from_pydict({"label": list(seen), "n": [n for _, n in seen.values()],
                                              "counts": [c.tobytes() for c, _ in seen.values()]})

    parts = sample.mapInArrow(count, "label string, n bigint, counts binary").collect()
    labels = sorted({r["label"] for r in parts})
    counts = np.zeros((BUCKETS, len(labels)))
    texts = np.zeros(len(labels))
    for r in parts:
        j = labels.index(r["label"])
        counts[:, j] += np.frombuffer(r["counts"], np.int64)
        texts[j] += r["n"]
    log_prob = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=0) + SMOOTHING * BUCKETS)
    return Model(labels, np.vstack([log_prob, np.zeros(len(labels))]), np.log(texts / max(1.0, texts.sum())))


def score_texts(texts: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """Label and score of each text.  The score is the label's posterior with the
    log-likelihood divided by the root of the n-gram count, since overlapping
    n-grams aren't independent (the label is the plain naive Bayes one)."""
    ids, starts, _ = ngram_ids([t.lower() for t in texts])
    total = np.zeros((len(texts), len(model.labels)))
    for j in range(ids.shape[1]):
        for k in range(len(model.labels)):
            total[:, k] += np.add.reduceat(model.log_prob[ids[:, j], k], starts)
    whole = np.add.reduceat((ids < BUCKETS).sum(axis=1), starts)
    best = np.argmax(total + model.log_prior, axis=1)
    soft = total / np.sqrt(np.maximum(1, whole))[:, None] + model.log_prior
    soft = np.exp(soft - soft.max(axis=1, keepdims=True))
    score = soft[np.arange(len(texts)), best] / soft.sum(axis=1)
    known = np.array([_LETTER.search(t) is not None for t in texts])
    names = [model.labels[b] if ok else UNDETERMINED for b, ok in zip(best, known)]
    return names, np.where(known, score, 0.0)


def predict(df: DataFrame, model: Model, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, lang_pred, score`` for every row; nothing but the text is looked at."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # labels x (buckets + 1) doubles

    def score(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch, raw in batches(rows, "text"):
            texts = [t.decode("utf-8", "replace") for t in raw]
            if model.labels:
                names, scores = score_texts(texts, model)
            else:
                names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_pydict({id_col: batch.column(id_col), "lang_pred": names, "score": scores})

    rows = df.select(F.col(id_col), F.col(text).alias("text"))
    kind = rows.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(score, f"`{id_col}` {kind}, lang_pred string, score double")
