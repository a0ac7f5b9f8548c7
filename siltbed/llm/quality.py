"""Quality by a convolutional network over bytes, trained and run in numpy.

A document's bytes are cut into overlapping chunks that cover it from the first byte to the last. Every
filter reads ``WIDTH`` bytes at a time, ``STRIDE`` apart; a chunk keeps the largest answer of each filter,
and a small hidden layer turns these into features of the chunk. The document takes their mean and their
maximum over all chunks, and a logistic output makes one probability.

The network learns from a bounded sample of labelled documents (``SAMPLE``), then scores every document
in one pass over the table. Scores depend on the text alone. In an epoch of training a longer document shows
``TRAIN_CHUNKS`` of its chunks, drawn anew each time; scores always read all chunks.

Defined cases: a null text counts as empty; an empty text is scored as one chunk of padding; without
labels of both kinds every score is the share of ones (0.5 without any); repeated rows and null ids are
scored like others; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import documents, held, importable, text_of
from siltbed.llm.learning import Adam, labelled_sample, sigmoid

WIDTH, STRIDE, FILTERS, HIDDEN = 8, 4, 24, 12
CHUNK, HOP = 256, 224
#: Labelled documents that are fitted, and how.
SAMPLE, EPOCHS, BATCH, TRAIN_CHUNKS, RATE, DECAY = 3000, 24, 64, 12, 0.01, 1e-4
PAD = 256  # the symbol after the last byte

_PLACES = np.arange(0, CHUNK - WIDTH + 1, STRIDE)


def chunks_of(text: str) -> np.ndarray:
    """Symbols of all chunks, one row each."""
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    n = max(1, -(-max(len(data) - CHUNK, 0) // HOP) + 1)
    padded = np.full((n - 1) * HOP + CHUNK, PAD, dtype=np.int16)
    padded[: len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::HOP]


def initial(seed: int = 9) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    return {
        # The weight that each filter gives to each symbol at each of its places.
        "filters": (r.normal(0, 0.3, (WIDTH, 257, FILTERS))).astype(np.float32),
        "bias": np.zeros(FILTERS, np.float32),
        "hidden": r.normal(0, 0.3, (FILTERS, HIDDEN)).astype(np.float32),
        "hidden_bias": np.zeros(HIDDEN, np.float32),
        "out": r.normal(0, 0.3, 2 * HIDDEN).astype(np.float32),
        "out_bias": np.zeros(1, np.float32),
    }


def pooled(p: dict, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The largest answer of every filter in every chunk, and where it is."""
    total = None
    for j in range(WIDTH):
        part = p["filters"][j].take(chunks[:, _PLACES + j], axis=0)
        total = part if total is None else np.add(total, part, out=total)
    return np.maximum(total.max(axis=1) + p["bias"], 0), total


def chunk_features(p: dict, best: np.ndarray) -> np.ndarray:
    return np.tanh(best @ p["hidden"] + p["hidden_bias"])


def train(texts: list[str], y: np.ndarray) -> dict[str, np.ndarray] | float:
    if len(set(y)) < 2:
        return float(y.mean()) if len(y) else 0.5
    r, p, adam = np.random.default_rng(9), initial(), Adam(RATE)
    cut = [chunks_of(t) for t in texts]
    for epoch in range(EPOCHS):
        adam.rate = RATE * (1 - epoch / EPOCHS) + 1e-4
        order = r.permutation(len(cut))
        for at in range(0, len(order), BATCH):
            docs = order[at : at + BATCH]
            rows = [c if len(c) <= TRAIN_CHUNKS else c[r.choice(len(c), TRAIN_CHUNKS, replace=False)] for c in (cut[d] for d in docs)]
            adam.step(p, gradients(p, rows, y[docs]))
    return p


def gradients(p: dict, rows: list[np.ndarray], y: np.ndarray) -> dict[str, np.ndarray]:
    sizes = np.array([len(c) for c in rows])
    owner = np.repeat(np.arange(len(rows)), sizes)
    starts = np.cumsum(sizes) - sizes
    chunks = np.concatenate(rows)
    best, answers = pooled(p, chunks)
    where = answers.argmax(axis=1)
    h = chunk_features(p, best)
    mean = np.add.reduceat(h, starts) / sizes[:, None]
    top = np.maximum.reduceat(h, starts)
    prob = sigmoid(np.hstack([mean, top]) @ p["out"] + p["out_bias"])
    e = ((prob - y) / len(y)).astype(np.float32)
    g = {"out": np.hstack([mean, top]).T @ e + DECAY * p["out"], "out_bias": np.array([e.sum()])}
    d = np.outer(e, p["out"]).astype(np.float32)
    dh = d[owner, :HIDDEN] / sizes[owner][:, None] + d[owner, HIDDEN:] * (h == top[owner])
    dz = dh * (1 - h * h)
    g["hidden"], g["hidden_bias"] = best.T @ dz + DECAY * p["hidden"], dz.sum(axis=0)
    db = (dz @ p["hidden"].T) * (best > 0)
    g["bias"] = db.sum(axis=0)
    g["filters"] = DECAY * p["filters"]
    f = np.broadcast_to(np.arange(FILTERS), where.shape)
    for j in range(WIDTH):
        symbols = np.take_along_axis(chunks, _PLACES[where] + j, axis=1).astype(np.int64)
        flat = np.bincount((symbols * FILTERS + f).ravel(), db.ravel(), minlength=257 * FILTERS)
        g["filters"][j] += flat.reshape(257, FILTERS)
    return g


def score(p: dict | float, texts: list[str], step: int = 2048) -> np.ndarray:
    """The probability of each text; chunks go through the network ``step`` at a time."""
    if isinstance(p, float):
        return np.full(len(texts), p)
    cut = [chunks_of(t) for t in texts]
    sizes = np.array([len(c) for c in cut])
    features = []
    held_, n = [], 0
    for c in cut:
        for at in range(0, len(c), step):
            held_.append(c[at : at + step])
            n += len(held_[-1])
            if n >= step:
                features.append(chunk_features(p, pooled(p, np.concatenate(held_))[0]))
                held_, n = [], 0
    if held_:
        features.append(chunk_features(p, pooled(p, np.concatenate(held_))[0]))
    h = np.concatenate(features)
    starts = np.cumsum(sizes) - sizes
    both = np.hstack([np.add.reduceat(h, starts) / sizes[:, None], np.maximum.reduceat(h, starts)])
    return sigmoid((both @ p["out"] + p["out_bias"]).astype(np.float64))


def score_documents(docs: DataFrame, params: dict | float) -> DataFrame:
    """(doc_id, score)"""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 128):
                part = b.slice(at, 128)
                scores = score(params, part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    importable(docs.sparkSession)
    return text_of(docs).mapInArrow(run, "doc_id long, score double")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    params = train(*labelled_sample(docs, labels, "quality", ~held(F.col("doc_id"), 4, 2), SAMPLE))
    scored = score_documents(docs, params)
    return scored.select("doc_id", held(F.col("doc_id"), 4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
