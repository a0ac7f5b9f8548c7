"""Language-model scores from a log-bilinear network trained with noise-contrastive estimation.

Tokens are words (A-Z lowered, cut at ASCII white space) and one end per document. The corpus gives the
count of every word. The most frequent words are classes of their own, as many as the square root of the
number of different words (``OWN`` to ``MOST_OWN``), the end is one, and all others share classes by their
last three bytes. The network predicts a token's class from the classes of the two
before it: their vectors, each through a matrix of its own, add up to a predicted vector, whose product
with a class's vector is its score. It is trained in numpy by noise-contrastive estimation: first on a
bounded sample on the driver, then in every task on all contexts of its documents, one full buffer after the
other, and the tasks' weights are averaged. Scoring multiplies pairs of classes with all class vectors and
normalises: all pairs at once for the least number of classes, otherwise each pair where it first comes up; a word of a shared class has its share of that
class's count, and a word never seen has the share that words seen once suggest (Good-Turing). Over all
words of a class and its unseen ones the probabilities add up to one.

Word counts are exact and cover all training documents. The ``FREQUENT`` most frequent words go to every
task; all others are joined by word, so nothing that grows with the vocabulary is broadcast.

Defined cases: a null text counts as empty and scores its end alone; repeated rows and null ids are scored
like others (a null id's text is empty for the split); without training documents all counts are zero
and all classes equally likely; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import crc_mod, documents, importable, stored, text_of
from siltbed.llm.learning import Adam, sigmoid

#: Classes and own words of a small vocabulary; further own words have the classes from CLASSES on.
CLASSES, OWN, MOST_OWN = 256, 170, 2048
END = OWN
SHARED = CLASSES - OWN - 1
FREQUENT = 1 << 17
DIM, NOISE, BATCH = 32, 64, 2048
#: Documents of the first training, its passes, and contexts that a task holds at once in the second.
SAMPLE, PASSES, BUFFER = 1500, 6, 200_000
RATE, TASK_RATE = 0.003, 0.001
#: A task's counts are handed on whenever it holds so many words.
HELD_WORDS = 400_000
SMOOTH = 0.1


def shapes(classes: int) -> dict[str, tuple]:
    return {"context": (classes, DIM), "target": (classes, DIM), "bias": (classes,), "near": (DIM, DIM), "far": (DIM, DIM)}


def own_words(v: int) -> int:
    """How many of ``v`` words are classes of their own."""
    return min(max(OWN, math.isqrt(v)), MOST_OWN)


def words_of(text: str) -> list[bytes]:
    return text.encode().lower().split()


def shared_class(word: bytes) -> int:
    return OWN + 1 + zlib.crc32(word[-3:]) % SHARED


# -- counts ------------------------------------------------------------------------------------------


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, c) of one column of texts; the empty word stands for the ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(c: Counter) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c.keys()), pa.binary()), pa.array(list(c.values()), pa.int64())], names=["word", "c"])

        held: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                held.update(words_of(t))
                held[b""] += 1
                if len(held) > HELD_WORDS:
                    yield out(held)
                    held = Counter()
        if held:
            yield out(held)

    return texts.mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Vocabulary:
    """The frequent words and their counts, the classes, and each class's totals. Small enough for every
    task: FREQUENT words, and CLASSES + MOST_OWN totals at most."""

    def __init__(self, frequent: list[tuple[bytes, int]], n: int, v: int, totals: dict[int, tuple[int, int]]):
        self.words = [w for w, _ in frequent if w]
        self.counts = np.array([c for w, c in frequent if w], dtype=np.int64)
        self.n, self.v = n, v
        self.ends = next((c for w, c in frequent if not w), 0)
        self.classes_in_all = CLASSES + own_words(v) - OWN
        self.total, self.once = np.zeros(self.classes_in_all), np.zeros(self.classes_in_all)
        for k, (t, o) in totals.items():
            self.total[k], self.once[k] = t, o
        self._built()

    def _built(self) -> None:
        self.at = dict(zip(self.words, range(len(self.words))))
        rank = np.arange(len(self.words))
        shared = np.array([shared_class(w) for w in self.words], dtype=np.int64) if self.words else np.zeros(0, np.int64)
        own = own_words(self.v)
        self.kind = np.where(rank < OWN, rank, np.where(rank < own, rank - OWN + CLASSES, shared))
        self.scale = self.n + SMOOTH * (self.v + 1)
        self.base = np.log10((self.counts + SMOOTH) / self.scale)
        self.unseen = (self.once + 1) / (self.total + 2)  # the share of a class's unseen words
        self.known_share = np.log10((1 - self.unseen) / np.maximum(self.total, 1))
        self.within = np.where(rank < own, 0.0, np.log10(np.maximum(self.counts, 1)) + self.known_share[self.kind])
        self.end_base = np.log10((self.ends + SMOOTH) / self.scale)

    def __getstate__(self):
        return {"blob": b"\n".join(self.words), **{k: self.__dict__[k] for k in ("counts", "n", "v", "ends", "classes_in_all", "total", "once")}}

    def __setstate__(self, state):
        blob = state.pop("blob")
        self.__dict__.update(state)
        self.words = blob.split(b"\n") if blob else []
        self._built()

    def classes(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The place of each word among the frequent ones (-1: not there), and the class of each token, the
        end included."""
        at = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        kind = np.empty(len(words) + 1, dtype=np.int64)
        kind[-1] = END
        if len(words):
            kind[:-1] = self.kind[at] if len(self.kind) else 0
            others = np.flatnonzero(at < 0)
            kind[others] = [shared_class(words[i]) for i in others.tolist()]
        return at, kind


def vocabulary(counts: DataFrame) -> Vocabulary:
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    # Sixteen steps to a doubling: at most a thousand sizes, of which the largest are taken whole as long as
    # they hold no more than FREQUENT words.
    size = F.floor(F.log2("c") * 16)
    least, held = float("inf"), 0
    for r in sorted(counts.groupBy(size.alias("size")).agg(F.count("*").alias("n")).collect(), key=lambda r: -r.size):
        held += r.n
        if held > FREQUENT:
            break
        least = r.size
    taken = counts.where((size >= least) | (F.length("word") == 0)).collect()
    frequent = sorted(((bytes(r.word), r.c) for r in taken), key=lambda x: (-x[1], x[0]))
    own = {w for w, _ in [x for x in frequent if x[0]][: own_words(sums.v or 0)]}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, once = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        for b in batches:
            for w, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if w and w not in own:
                    k = shared_class(w)
                    total[k] += c
                    once[k] += c == 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(CLASSES)), pa.array(total), pa.array(once)], names=["k", "total", "once"])

    rows = counts.mapInArrow(run, "k long, total long, once long").groupBy("k").agg(F.sum("total").alias("total"), F.sum("once").alias("once")).collect()
    return Vocabulary(frequent, sums.n or 0, sums.v or 0, {r.k: (r.total, r.once) for r in rows})


# -- the network -------------------------------------------------------------------------------------


def initial(q: np.ndarray) -> dict[str, np.ndarray]:
    """Weights that predict the classes' shares ``q`` after every context."""
    r = np.random.default_rng(1)
    p = {k: r.normal(0, 0.1, s).astype(np.float32) for k, s in shapes(len(q)).items()}
    p["target"] *= np.float32(0.1)
    p["bias"] = np.log(q).astype(np.float32)
    p["near"] += np.eye(DIM, dtype=np.float32)
    p["far"] += 0.5 * np.eye(DIM, dtype=np.float32)
    return p


def contexts(kinds: list[np.ndarray]) -> np.ndarray:
    """(far, near, target) of every token; before a document's first token stand ends."""
    rows = []
    for k in kinds:
        padded = np.concatenate([[END, END], k])
        rows.append(np.column_stack([padded[:-2], padded[1:-1], padded[2:]]))
    return np.concatenate(rows) if rows else np.zeros((0, 3), np.int64)


def noise_of(n: Vocabulary) -> np.ndarray:
    """The share of each class among all training tokens, slightly smoothed."""
    q = n.total + 1.0
    own = own_words(n.v)
    q[n.kind[:own]] = n.counts[:own] + 1.0
    q[END] = n.ends + 1.0
    return q / q.sum()


def _sums(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Row k: the sum of the rows of ``values`` where ``at`` is k."""
    order = np.argsort(at.astype(np.int16) if n < 1 << 15 else at, kind="stable")  # short numbers sort faster
    k = at.take(order)
    new = np.ones(len(k), dtype=bool)
    np.not_equal(k[1:], k[:-1], out=new[1:])
    first = np.flatnonzero(new)
    times = np.r_[first[1:], len(k)] - first
    out = np.zeros((n, values.shape[1]), dtype=values.dtype)
    # Most come once or twice: these are added all at once.
    for m in (1, 2, 3):
        some = first[times == m]
        rows = [values.take(order[some + i], axis=0) for i in range(m)]
        out[k[some]] = rows[0] if m == 1 else rows[0] + (rows[1] if m == 2 else rows[1] + rows[2])
    often = times > 3
    if often.any():
        many = times[often]
        rows = values.take(order[np.repeat(often, times)], axis=0)
        out[k[first[often]]] = np.add.reduceat(rows, np.cumsum(many) - many, axis=0)
    return out


def fit(p: dict, rows: np.ndarray, q: np.ndarray, rate: float, passes: int, seed: int, adam: Adam | None = None) -> None:
    """Noise-contrastive estimation: tell each target from NOISE classes drawn from ``q``, which all
    contexts of a batch share. With ``adam`` it goes on where that one stopped."""
    r, adam, log_kq = np.random.default_rng(seed), adam or Adam(rate), np.log(NOISE * q).astype(np.float32)
    classes, chances = len(q), q.cumsum()
    chances /= chances[-1]
    for _ in range(passes):
        order = r.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            far, near, target = np.ascontiguousarray(rows.take(order[at : at + BATCH], axis=0).T)
            x, y = p["context"].take(near, axis=0), p["context"].take(far, axis=0)
            v = x @ p["near"]
            v += y @ p["far"]
            drawn = chances.searchsorted(r.random(NOISE), side="right")  # as r.choice(classes, NOISE, p=q)
            wanted, others = p["target"].take(target, axis=0), p["target"].take(drawn, axis=0)
            true = sigmoid((v * wanted).sum(axis=1) + p["bias"][target] - log_kq[target]) - 1
            false = v @ others.T
            false += p["bias"][drawn]
            false -= log_kq[drawn]
            n = np.float32(1 / len(target))
            true, false = (true * n).astype(np.float32), sigmoid(false, out=false)
            false *= n
            dv = false @ others
            wanted *= true[:, None]
            dv += wanted
            target_sums = _sums(target, true[:, None] * v, classes)
            target_sums += _sums(drawn, false.T @ v, classes)
            context_sums = _sums(near, dv @ p["near"].T, classes)
            context_sums += _sums(far, dv @ p["far"].T, classes)
            adam.step(
                p,
                {
                    "target": target_sums,
                    "bias": (np.bincount(target, true, classes) + np.bincount(drawn, false.sum(axis=0), classes)).astype(np.float32),
                    "near": x.T @ dv,
                    "far": y.T @ dv,
                    "context": context_sums,
                },
            )


def log_table(p: dict[str, np.ndarray]) -> np.ndarray:
    """log10 of the normalised probability of every class after every pair of CLASSES classes: rows far *
    CLASSES + near, all by matrix products."""
    x, y = p["context"] @ p["near"], p["context"] @ p["far"]
    out = np.empty((CLASSES * CLASSES, CLASSES), dtype=np.float32)
    for far in range(CLASSES):
        s = (y[far] + x) @ p["target"].T + p["bias"]
        s -= s.max(axis=1, keepdims=True)
        s -= np.log(np.exp(s).sum(axis=1, keepdims=True))
        out[far * CLASSES : (far + 1) * CLASSES] = s * np.float32(1 / np.log(10))
    return out


def train_on(columns: Iterable[pa.Array], vocabulary: Vocabulary, p: dict, q: np.ndarray) -> tuple[dict, int]:
    """The weights after one pass over every context of some columns of texts, and how many these are. No
    more than ``BUFFER`` contexts are held beside those of a few texts."""
    own, weight, adam = {k: v.copy() for k, v in p.items()}, 0, Adam(TASK_RATE)
    held, size = [], 0

    def learn(rows: np.ndarray) -> None:
        nonlocal weight
        fit(own, rows.astype(np.int64), q, TASK_RATE, 1, 3 + weight, adam)
        weight += len(rows)

    for texts in columns:
        for at in range(0, len(texts), 256):
            held.append(contexts([vocabulary.classes(words_of(t))[1] for t in texts.slice(at, 256).to_pylist()]).astype(np.int16))
            size += len(held[-1])
            if size >= BUFFER:
                rows = np.concatenate(held)
                for first in range(0, size - BUFFER + 1, BUFFER):
                    learn(rows[first : first + BUFFER])
                held = [rows[size - size % BUFFER :]]
                size = len(held[0])
    if size:
        learn(np.concatenate(held))
    return own, weight


def train(texts: DataFrame, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """The averaged weights after both trainings; ``texts`` holds the ids and texts to train on."""
    marks = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    cut = int(min(1.0, SAMPLE / max(vocabulary.ends, 1)) * (1 << 30))
    some = texts.where(marks < cut).limit(2 * SAMPLE).select("text").collect()  # about SAMPLE of them
    sample = sorted(some, key=lambda r: r.text)
    texts = texts.select("text")
    q = noise_of(vocabulary)
    p = initial(q)
    fit(p, contexts([vocabulary.classes(words_of(r.text))[1] for r in sample]), q, RATE, PASSES, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, weight = train_on((b.column(0) for b in batches), vocabulary, p, q)
        if weight:
            flat = np.concatenate([own[k].ravel() for k in shapes(len(q))]).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat * weight), pa.array(np.full(len(flat), float(weight)))], names=["i", "x", "w"])

    # One row per weight of the network, whatever the number of tasks.
    sums = texts.mapInArrow(run, "i long, x double, w double").groupBy("i").agg((F.sum("x") / F.sum("w")).alias("x")).collect()
    if sums:
        flat = np.zeros(len(sums))
        for s in sums:
            flat[s.i] = s.x
        at = 0
        for k, shape in shapes(len(q)).items():
            size = int(np.prod(shape))
            p[k] = flat[at : at + size].reshape(shape).astype(np.float32)
            at += size
    return p


# -- scores ------------------------------------------------------------------------------------------

class Scorer:
    """log10 of the probability of classes after pairs of classes. The divisors of pairs are kept."""

    def __init__(self, p: dict):
        self.target, self.bias = p["target"], p["bias"]
        self.near, self.far = p["context"] @ p["near"], p["context"] @ p["far"]
        self.classes = len(self.bias)
        self.table = log_table(p) if self.classes == CLASSES else None
        self.divisor = None if self.table is not None else np.full(self.classes**2, np.nan, dtype=np.float32)

    def logs(self, far: np.ndarray, near: np.ndarray, target: np.ndarray) -> np.ndarray:
        pair = far * self.classes + near
        if self.table is not None:
            return self.table[pair, target].astype(np.float64)
        new = np.unique(pair[np.isnan(self.divisor[pair])])
        for at in range(0, len(new), 64):  # small enough for the processor's cache
            part = new[at : at + 64]
            s = (self.far[part // self.classes] + self.near[part % self.classes]) @ self.target.T
            s += self.bias
            top = s.max(axis=1)
            s -= top[:, None]
            self.divisor[part] = top + np.log(np.exp(s, out=s).sum(axis=1))
        out = np.empty(len(pair))
        for at in range(0, len(pair), 1 << 11):
            cut = slice(at, at + (1 << 11))
            both = self.far.take(far[cut], axis=0)
            both += self.near.take(near[cut], axis=0)
            score = np.einsum("ij,ij->i", both, self.target.take(target[cut], axis=0))
            out[cut] = score + self.bias[target[cut]] - self.divisor[pair[cut]]
        return out / np.log(10)


_scorers: dict[int, Scorer] = {}


def _scorer(p: dict) -> Scorer:
    """One per worker process."""
    key = zlib.crc32(p["target"].tobytes() + p["context"].tobytes())
    if key not in _scorers:
        _scorers.clear()
        _scorers[key] = Scorer(p)
    return _scorers[key]


_PARTS = "doc_id long, n_tokens long, n_known long, base double, score double, rare array<binary>, times array<int>, kinds array<int>"


def parts_of(docs: DataFrame, vocabulary: Vocabulary, p: dict) -> DataFrame:
    """Each document's sums over its frequent words, and its other words with their counts and classes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer, v = _scorer(p), vocabulary
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                columns: list[list] = [[] for _ in range(7)]
                split = [words_of(text) for text in part.column(1).to_pylist()]
                seen = [v.classes(words) for words in split]
                ends = np.cumsum([0, *(len(kind) for _, kind in seen)])
                logs = scorer.logs(*contexts([kind for _, kind in seen]).T)
                models = np.add.reduceat(logs, ends[:-1]) if len(split) else []
                for words, (at, _), model in zip(split, seen, models):
                    known = at[at >= 0]
                    rare = Counter(words[j] for j in np.flatnonzero(at < 0))
                    values = (
                        len(words) + 1,
                        len(known) + (v.ends > 0),
                        float(v.base[known].sum() + v.end_base),
                        float(model + v.within[known].sum()),
                        list(rare),
                        list(rare.values()),
                        [shared_class(w) for w in rare],
                    )
                    for column, value in zip(columns, values):
                        column.append(value)
                types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.binary()), pa.list_(pa.int32()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], names=[c.split()[0] for c in _PARTS.split(", ")])

    return docs.select("doc_id", "text").mapInArrow(run, _PARTS)


def score(docs: DataFrame, held_out) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): the model learns from the
    rows of ``docs`` for which ``held_out`` is false."""
    importable(docs.sparkSession)
    whole = text_of(docs).withColumn("held_out", held_out)
    texts = whole.where(~F.col("held_out")).select("doc_id", "text")
    counts = stored(word_counts(texts.select("text")), "word-counts")
    v = vocabulary(counts)
    p = train(texts, v)
    parts = stored(parts_of(whole, v, p).withColumn("row", F.monotonically_increasing_id()), "scores")

    rare = parts.select("row", F.explode(F.arrays_zip("rare", "times", "kinds")).alias("x")).select("row", F.col("x.rare").alias("word"), "x.times", "x.kinds")
    joined = rare.join(counts, "word", "left")
    per_class = lambda values: F.element_at(F.array(*(F.lit(float(x)) for x in values[:CLASSES])), F.col("kinds") + 1)
    seen = F.col("c").isNotNull()
    base = F.log10((F.coalesce("c", F.lit(0)) + SMOOTH) / F.lit(float(v.scale)))
    model = F.when(seen, F.log10(F.col("c").cast("double")) + per_class(v.known_share)).otherwise(per_class(np.log10(v.unseen)))
    sums = joined.groupBy("row").agg(
        F.sum(F.when(seen, F.col("times")).otherwise(0)).alias("n"), F.sum(F.col("times") * base).alias("b"), F.sum(F.col("times") * model).alias("s")
    )
    zero = F.lit(0.0)
    return parts.drop("rare", "times", "kinds").join(sums, "row", "left").select(
        "doc_id",
        (crc_mod(F.col("doc_id"), 10) == 0).alias("held_out"),
        "n_tokens",
        (F.col("n_known") + F.coalesce("n", F.lit(0))).alias("n_known"),
        F.lit(int(v.n)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("b", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("s", zero)).alias("score"),
    )


def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), crc_mod(F.col("doc_id"), 10) == 0)
