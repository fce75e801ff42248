"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Tokens are runs of letters, of digits and of other signs, so that glued junk is a
token of its own; a token that repeats the one before it is a token of one kind.  Every token hashes to one of ``VOCABULARY`` buckets; a bucket has a
fixed sparse random index vector, and its word vector is the sum of the index vectors
found within ``REACH`` tokens of it.  A document's features are the mean and the spread
of its tokens' vectors and its log length; a two-layer network turns them into a
logit, whose temperature is fitted on labelled texts kept out of training.

``fit`` takes at most about ``MAX_TEXTS`` labelled texts, drawn by a hash of the id;
vectors and features are made in Spark tasks and only bounded arrays reach the driver.
``with_score`` broadcasts the model (``VOCABULARY`` x ``WIDTH`` floats) and reads whole texts.

Defined cases: null and empty texts are scored as texts without tokens; a null label
or id doesn't train; repeated rows train repeatedly and are scored alike; without
labelled texts of both classes every score is the share of label 1 (0.5 if none); other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyho.llm.common import U64, Words, batches, with_text_column

VOCABULARY = 1 << 14
REPEAT = VOCABULARY - 1  # bucket of tokens that repeat the one before
WIDTH = 32
NONZERO = 4
REACH = 2
LEAST_COUNT = 5          # rarer tokens have no vector, in training as in scoring
HIDDEN = 24
EPOCHS = 60
MAX_TEXTS = 20_000
FIT_TASKS = 12
SEED = 11

#: Byte classes: 0 space, 1 letters, 2 digits, 3 other signs.
KINDS = np.full(256, 3, np.uint8)
KINDS[list(b"\x20\x09\x0a\x0b\x0c\x0d")] = 0
KINDS[list(b"0123456789")] = 2
KINDS[[b for b in range(256) if chr(b).isalpha() and b < 128 or b >= 128]] = 1


@dataclass
class Model:
    vectors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    layers: list[np.ndarray]
    temperature: float
    base: float | None = None  # a constant score when nothing could be trained


def index_vectors() -> np.ndarray:
    rng = np.random.default_rng(SEED)
    out = np.zeros((VOCABULARY, WIDTH), np.float32)
    for _ in range(NONZERO):
        out[np.arange(VOCABULARY), rng.integers(0, WIDTH, VOCABULARY)] += rng.choice([-1, 1], VOCABULARY)
    return out


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every token, and how many tokens each text has.  A token equal to the one
    before it in its text is the token ``REPEAT``."""
    w = Words(texts, KINDS)
    ids = (w.hash >> U64(40)).astype(np.int64) % REPEAT
    text = w.document()
    ids[1:][(w.hash[1:] == w.hash[:-1]) & (text[1:] == text[:-1])] = REPEAT
    return ids, w.counts


def context_sums(texts: list[bytes], index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each bucket, the sum of the index vectors near its tokens, and its count."""
    ids, counts = tokens(texts)
    text = np.repeat(np.arange(len(counts)), counts)
    near = np.zeros((len(ids), WIDTH), np.float32)
    for step in range(1, REACH + 1):
        if len(ids) > step:
            same = (text[step:] == text[:-step])[:, None]
            near[step:] += index[ids[:-step]] * same
            near[:-step] += index[ids[step:]] * same
    sums = np.stack([np.bincount(ids, weights=near[:, d], minlength=VOCABULARY) for d in range(WIDTH)], axis=1)
    return sums, np.bincount(ids, minlength=VOCABULARY)


def pooled(texts: list[bytes], vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the vectors of each text's known tokens, and its log length."""
    ids, counts = tokens(texts)
    out = np.zeros((len(counts), 2 * WIDTH + 1), np.float32)
    known = (vectors != 0).any(axis=1).astype(np.int64)
    full = np.flatnonzero(counts)
    if len(full):
        starts = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
        rows = vectors[ids]
        n = np.maximum(1, np.add.reduceat(known[ids], starts))[:, None].astype(np.float32)
        mean = np.add.reduceat(rows, starts, axis=0) / n
        out[full, :WIDTH] = mean
        out[full, WIDTH:2 * WIDTH] = np.sqrt(np.maximum(0, np.add.reduceat(rows * rows, starts, axis=0) / n - mean ** 2))
    out[:, -1] = np.log1p(counts)
    return out


def logits(model: Model, features: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = model.layers
    x = (features - model.centre) / model.spread
    return (np.tanh(x @ w1 + b1) @ w2 + b2)[:, 0]


def _train(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Adam on mini-batches; ``x`` is standardised."""
    rng = np.random.default_rng(SEED)
    layers = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
              rng.normal(0, HIDDEN ** -0.5, (HIDDEN, 1)), np.zeros(1)]
    m, v, t = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for a in range(0, len(x), 128):
            i = order[a:a + 128]
            w1, b1, w2, b2 = layers
            h = np.tanh(x[i] @ w1 + b1)
            p = 1 / (1 + np.exp(-np.clip(h @ w2 + b2, -30, 30)))
            d2 = (p - y[i, None]) / len(i)
            d1 = (d2 @ w2.T) * (1 - h ** 2)
            t += 1
            for k, g in enumerate([x[i].T @ d1 + 1e-3 * w1, d1.sum(0), h.T @ d2 + 1e-3 * w2, d2.sum(0)]):
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                layers[k] = layers[k] - 0.01 * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return layers


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality",
        max_texts: int = MAX_TEXTS) -> Model:
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("id"), F.col(label).cast("int").alias("label")).dropna()
    n = max(1, known.count())
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("quality")), F.lit(1 << 30)) / (1 << 30)
    chosen = known.where(draw * n < max_texts)  # about max_texts rows: a bounded broadcast
    sample = (docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")
              .select("id", "text", "label").repartition(FIT_TASKS))

    def contexts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total, seen = index_vectors(), np.zeros((VOCABULARY, WIDTH)), np.zeros(VOCABULARY, np.int64)
        for _, texts in batches(rows, "text"):
            sums, counts = context_sums(texts, index)
            total, seen = total + sums, seen + counts
        yield pa.RecordBatch.from_pydict({"sums": [total.astype(np.float32).tobytes()], "seen": [seen.tobytes()]})

    total, seen = np.zeros((VOCABULARY, WIDTH)), np.zeros(VOCABULARY, np.int64)
    for r in sample.mapInArrow(contexts, "sums binary, seen binary").collect():
        total += np.frombuffer(r["sums"], np.float32).reshape(total.shape)
        seen += np.frombuffer(r["seen"], np.int64)
    total[seen < LEAST_COUNT] = 0
    vectors = total / np.maximum(1e-9, np.linalg.norm(total, axis=1, keepdims=True))
    vectors = vectors.astype(np.float32)
    shared = spark.sparkContext.broadcast(vectors)

    def features(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches(rows, "text"):
            yield pa.RecordBatch.from_pydict({"id": batch.column("id").cast(pa.string()), "label": batch.column("label"),
                                              "x": [r.tobytes() for r in pooled(texts, shared.value)]})

    found = sample.mapInArrow(features, "id string, label int, x binary").collect()
    found.sort(key=lambda r: (r["id"], r["label"], r["x"]))
    width = 2 * WIDTH + 1
    x = np.frombuffer(b"".join(r["x"] for r in found), np.float32).reshape(-1, width).astype(float)
    y = np.array([r["label"] for r in found], float)
    if len(set(y)) < 2:
        return Model(vectors, np.zeros(width), np.ones(width), [], 1.0, float(y.mean()) if len(y) else 0.5)
    centre, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    held = np.random.default_rng(SEED).random(len(y)) < 0.2
    if not (0 < held.sum() < len(y)):
        held[:] = False
    model = Model(vectors, centre, spread, _train(((x - centre) / spread)[~held], y[~held]), 1.0)
    if held.any():
        z = logits(model, x[held])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        model.temperature = float(min(grid, key=lambda t: np.logaddexp(0, -(2 * y[held] - 1) * z / t).sum()))
    return model


def probability(texts: list[bytes], model: Model) -> np.ndarray:
    if model.base is not None:
        return np.full(len(texts), model.base)
    z = logits(model, pooled(texts, model.vectors)) / model.temperature
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def with_score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the score of its text as column ``out`` (replaced if there); no shuffle."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    return with_text_column(df, text, out, T.DoubleType(), lambda texts: probability(texts, shared.value))
