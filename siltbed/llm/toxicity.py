"""Toxic spans by a linear-chain conditional random field over words, and document scores from them.

The labels name documents, not words. Words, and beginnings of words, that stand in toxic documents far
more often than chance allows (a likelihood-ratio test over the labelled sample, near copies counted once)
are the labelled tokens: they are toxic where they stand in a toxic document, all other words are not. The
field has two states and learns, by numpy, weights for the word, its beginnings, ending and form, for the
words beside it, and for the step from state to state. Forward-backward gives each word's probability of
being toxic; a document's score is a logistic function of the largest one, of their sum and of their
density, and the offsets of words above a half are its toxic spans.

Long texts go through the chain in stretches of ``STRETCH`` words that overlap by ``HALO`` on either side;
what lies further away changes a marginal by less than the chain remembers over ``HALO`` steps.

The field learns from a bounded sample of labelled documents (``SAMPLE``); every document is then scored
whole, in one pass. Scores depend on the text alone.

Defined cases: a null text counts as empty; a text without letters has no word and gets the score of no
evidence; without labels of both kinds, or without any telling word, every score is the share of ones
(0.5 without labels); repeated rows and null ids are scored like others; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltbed.llm.common import documents, held, importable, text_of
from siltbed.llm.learning import Adam, labelled_sample, logistic, sigmoid
from siltbed.llm.neardup import band_keys, shingles, sketches

#: Labelled documents that are fitted; weights of words share this many places.
SAMPLE, PLACES = 4000, 1 << 17
#: Words of a stretch, words beside it that are read with it, and the log-odds of a place without a word.
STRETCH, HALO, NEVER = 128, 24, -30.0
SEGMENT, EPOCHS, STEPS, BATCH, RATE, DECAY = 96, 12, 300, 1024, 0.05, 1e-4  # at least STEPS steps in all
REJECT = 0.7
#: Words whose weights a worker remembers.
KNOWN = 500_000

_LETTERS = re.compile(r"[^\W\d_]+")


#: Weights of a word: itself, its beginnings of these lengths, its ending, its form.
BEGINNINGS = (3, 5, 7)
WEIGHTS = len(BEGINNINGS) + 3


def core_of(word: str) -> str:
    return word.lower() if word.isalpha() else "".join(_LETTERS.findall(word)).lower()


def features(word: str) -> tuple[int, ...]:
    """Places of a word's weights, those of the word itself first. ``word`` is cut at white space."""
    core = core_of(word)
    form = f"form {min(len(core), 9)}{word[:1].isupper()}{word.isupper()}{core.isascii()}"
    parts = [f"word {core}", *(f"begins {core[:k]}" for k in BEGINNINGS), f"ends {core[-3:]}", form]
    return tuple(zlib.crc32(x.encode()) % PLACES for x in parts)


# -- labelled tokens ---------------------------------------------------------------------------------


def distinct_texts(texts: list[str], at_once: int = 1 << 17) -> list[int]:
    """Indices without those that are near copies of an earlier text; about ``at_once`` shingles are held."""
    seen: set[int] = set()
    out, part, sets, size = [], [], [], 0
    for i, t in enumerate(texts):
        s = shingles(t)
        if len(s):
            part.append(i)
            sets.append(s)
            size += len(s)
        if part and (size >= at_once or i == len(texts) - 1):
            for k, keys in zip(part, band_keys(sketches(sets)).tolist()):
                if seen.isdisjoint(keys):
                    out.append(k)
                seen.update(keys)
            part, sets, size = [], [], 0
    return out


def stems(core: str) -> list[str]:
    """A word's beginnings, marked by a hyphen, and the word."""
    return [core, *(core[:k] + "-" for k in range(3, 9) if len(core) > k)] if core else []


def telling_words(texts: list[str], y: np.ndarray) -> set[str]:
    """Words and beginnings in more toxic documents than chance allows, given how many are tested."""
    toxic, clean = Counter(), Counter()
    for t, label in zip(texts, y):
        if label:
            toxic.update({x for w in set(t.split()) for x in stems(core_of(w))})
    for t, label in zip(texts, y):
        if not label:  # what no toxic text holds tells nothing
            clean.update({x for w in set(t.split()) for x in stems(core_of(w)) if x in toxic})
    n1, n = float(y.sum()), len(y)
    if not 0 < n1 < n:
        return set()
    share = n1 / n
    tested = sum(1 for w, c in toxic.items() if c + clean[w] > 1)
    bar = 2 * math.log(max(tested, 2)) + 2
    found = set()
    for w, a in toxic.items():
        b = clean[w]
        q = a / (a + b)
        if a > 1 and q > max(0.4, 2 * share):
            gain = 2 * (a * math.log(q / share) + (b * math.log((1 - q) / (1 - share)) if b else 0))
            if gain > bar:
                found.add(w)
    return found


def is_telling(word: str, telling: set[str]) -> bool:
    return not telling.isdisjoint(stems(core_of(word)))


# -- the field ---------------------------------------------------------------------------------------


def marginals(e: np.ndarray, step: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """P(state 1) for each place of a padded batch: ``e`` is (documents, places), log-odds of state 1;
    ``step`` holds the four weights of going from state to state; places beyond a size mean nothing."""
    n, length = e.shape
    a = np.exp(step).astype(e.dtype)
    odds = np.exp(np.clip(e, -30, 30)).T.copy()
    ahead = np.empty_like(odds)
    ahead[0] = odds[0]
    for t in range(1, length):
        r = ahead[t - 1]
        ahead[t] = odds[t] * (a[0, 1] + r * a[1, 1]) / (a[0, 0] + r * a[1, 0])
    back = np.ones(n, dtype=e.dtype)
    p = np.empty_like(odds)
    shortest = sizes.min(initial=length)
    for t in range(length - 1, -1, -1):
        if t >= shortest - 1:
            back = np.where(t >= sizes - 1, e.dtype.type(1), back)
        whole = ahead[t] * back
        p[t] = whole / (1 + whole)
        r = odds[t] * back
        back = (a[1, 0] + r * a[1, 1]) / (a[0, 0] + r * a[0, 1])
    return p.T


def _pairs(e: np.ndarray, step: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals, and the expected number of each step from state to state."""
    n, length = e.shape
    a = np.exp(step)
    odds = np.exp(np.clip(e, -30, 30))
    ahead = np.empty_like(odds)
    ahead[:, 0] = odds[:, 0]
    for t in range(1, length):
        r = ahead[:, t - 1]
        ahead[:, t] = odds[:, t] * (a[0, 1] + r * a[1, 1]) / (a[0, 0] + r * a[1, 0])
    back = np.ones(n)
    p, steps = np.empty_like(odds), np.zeros((2, 2))
    for t in range(length - 1, -1, -1):
        back = np.where(t >= sizes - 1, 1.0, back)
        whole = ahead[:, t] * back
        p[:, t] = whole / (1 + whole)
        r = odds[:, t] * back
        if t:
            f = ahead[:, t - 1]
            joint = np.array([[np.ones(n) * a[0, 0], r * a[0, 1]], [f * a[1, 0], f * r * a[1, 1]]])
            joint /= joint.sum(axis=(0, 1))
            steps += joint[:, :, t < sizes].sum(axis=2)
        back = (a[1, 0] + r * a[1, 1]) / (a[0, 0] + r * a[0, 1])
    return p, steps


def train_field(texts: list[str], y: np.ndarray, telling: set[str]) -> dict[str, np.ndarray]:
    """Weights of places (own, before, after) and of steps, by stochastic ascent of the likelihood."""
    # A word is held as its row in a table of features, four bytes, however often it comes.
    row: dict[str, int] = {}
    segments, marks = [], []
    for t, label in zip(texts, y):
        words = t.split()
        f = np.array([row.setdefault(w, len(row)) for w in words], dtype=np.int32)
        z = np.array([bool(label) and is_telling(w, telling) for w in words], dtype=bool)
        segments += [f[at : at + SEGMENT] for at in range(0, len(words), SEGMENT)]
        marks += [z[at : at + SEGMENT] for at in range(0, len(words), SEGMENT)]
    table = np.array([features(w) for w in row], dtype=np.int32).reshape(-1, WEIGHTS)
    row.clear()
    r, use = np.random.default_rng(6), np.arange(len(segments))
    w = {"own": np.zeros(PLACES), "before": np.zeros(PLACES), "after": np.zeros(PLACES), "step": np.zeros((2, 2)), "bias": np.full(1, -4.0)}
    adam = Adam(RATE)
    epochs = max(EPOCHS, -(-STEPS // max(1, -(-len(use) // BATCH))))
    for epoch in range(epochs):
        adam.rate = RATE * (1 - epoch / epochs) + 1e-3
        order = r.permutation(use)
        for at in range(0, len(order), BATCH):
            part = order[at : at + BATCH]
            sizes = np.array([len(segments[i]) for i in part])
            f = np.zeros((len(part), SEGMENT, WEIGHTS), dtype=np.int32)
            z = np.zeros((len(part), SEGMENT))
            for k, i in enumerate(part):
                f[k, : sizes[k]], z[k, : sizes[k]] = table[segments[i]], marks[i]
            inside = np.arange(SEGMENT) < sizes[:, None]
            e = emissions(w, f, inside)
            p, expected = _pairs(e, w["step"], sizes)
            d = np.where(inside, p - z, 0) / len(part)
            zi = z.astype(int)
            seen = np.zeros((2, 2))
            both = inside[:, 1:]
            np.add.at(seen, (zi[:, :-1][both], zi[:, 1:][both]), 1)
            g = {"step": (expected - seen) / len(part), "bias": np.array([d.sum()])}
            g["own"] = np.bincount(f.ravel(), np.repeat(d.ravel(), WEIGHTS), minlength=PLACES) + DECAY * w["own"]
            word = f[:, :, 0]
            g["before"] = np.bincount(word[:, :-1].ravel(), d[:, 1:].ravel(), minlength=PLACES) + DECAY * w["before"]
            g["after"] = np.bincount(word[:, 1:].ravel(), np.where(inside[:, 1:], d[:, :-1], 0).ravel(), minlength=PLACES) + DECAY * w["after"]
            adam.step(w, g)
    return w


def emissions(w: dict, f: np.ndarray, inside: np.ndarray) -> np.ndarray:
    e = w["own"][f].sum(axis=2) + w["bias"]
    word = f[:, :, 0]
    e[:, 1:] += w["before"][word[:, :-1]]
    e[:, :-1] += np.where(inside[:, 1:], w["after"][word[:, 1:]], 0)
    return np.where(inside, e, -30.0)


class Tagger:
    """A trained field, with a table of the words it has met."""

    def __init__(self, model: dict):
        self.model, self.rows = model, {}
        w = model["field"]
        self.own, self.before, self.after = w["own"], w["before"], w["after"]
        self.bias, self.step = float(w["bias"][0]), w["step"]
        self.weights = np.zeros((1024, 3), dtype=np.float32)  # own, for the word behind, for the word before

    def _meet(self, new: list[str]) -> dict[str, int]:
        """Rows of words met for the first time. The first KNOWN words are kept, frequent ones among them;
        later ones serve one batch of texts."""
        base = len(self.rows)
        places = np.array([features(w) for w in new], dtype=np.int64)
        while len(self.weights) < base + len(new):
            self.weights = np.concatenate([self.weights, np.zeros_like(self.weights)])
        self.weights[base : base + len(new), 0] = self.own[places].sum(axis=1) + self.bias
        self.weights[base : base + len(new), 1] = self.before[places[:, 0]]
        self.weights[base : base + len(new), 2] = self.after[places[:, 0]]
        at = dict(zip(new, range(base, base + len(new))))
        self.rows.update((w, at[w]) for w in new[: max(0, KNOWN - base)])
        return at

    def tag(self, texts: list[str]) -> list[np.ndarray]:
        """The probability of each word of each text."""
        out: list[np.ndarray] = [np.zeros(0)] * len(texts)
        split = [t.split() for t in texts]
        everything = [w for words in split for w in words]
        new = [w for w in dict.fromkeys(everything) if w not in self.rows]
        at = self._meet(new) if new else {}
        known = self.rows
        rows = np.fromiter((known[w] if w in known else at[w] for w in everything), np.int64, len(everything))
        weights = self.weights[rows]
        e, begin = [], 0
        for words in split:
            w = weights[begin : (begin := begin + len(words))]
            x = w[:, 0].copy()
            x[1:] += w[:-1, 1]
            x[:-1] += w[1:, 2]
            e.append(x)
        # Stretches of all texts go through the chain together.
        full = [i for i, x in enumerate(e) if len(x)]
        rows = [-(-len(e[i]) // STRETCH) for i in full]
        if not full:
            return out
        flat = np.full((sum(rows) + 2, STRETCH), NEVER, dtype=np.float32)
        ends = np.cumsum(rows)
        for i, n, end in zip(full, rows, ends):
            flat[end - n + 1 : end + 1].ravel()[: len(e[i])] = e[i]
        left, right = flat[:-2, -HALO:].copy(), flat[2:, :HALO].copy()
        left[ends - rows], right[ends - 1] = NEVER, NEVER
        padded = np.hstack([left, flat[1:-1], right])
        p = marginals(padded, self.step, np.full(len(padded), padded.shape[1]))[:, HALO:-HALO]
        for i, n, end in zip(full, rows, ends):
            out[i] = p[end - n : end].ravel()[: len(e[i])]
        return out

    def scores(self, tags: list[np.ndarray]) -> np.ndarray:
        return sigmoid(np.column_stack([evidence(tags), np.ones(len(tags))]) @ self.model["output"])


def evidence(tags: list[np.ndarray]) -> np.ndarray:
    """What a document's score is made of: its largest marginal, the sum of its marginals, and that sum
    against the document's length."""
    top = np.array([p.max() if len(p) else 0.0 for p in tags])
    total = np.array([p[p > 0.05].sum() for p in tags])
    size = np.array([len(p) for p in tags])
    return np.column_stack([top, np.log1p(total), np.log((total + 0.2) / (size / 500 + 1))])


def train(texts: list[str], y: np.ndarray) -> dict | float:
    share = float(y.mean()) if len(y) else 0.5
    once = distinct_texts(texts)
    telling = telling_words([texts[i] for i in once], y[once]) if once else set()
    if not telling:
        return share
    model = {"field": train_field([texts[i] for i in once], y[once], telling)}
    tagger = Tagger(model | {"output": None})
    known = [evidence(tagger.tag(texts[at : at + 256])) for at in range(0, len(texts), 256)]
    model["output"] = logistic(np.concatenate(known), y, ridge=0.1)
    return model


def score(model: dict | float, texts: list[str], tagger: Tagger | None = None) -> np.ndarray:
    if isinstance(model, float):
        return np.full(len(texts), model)
    tagger = tagger or Tagger(model)
    return tagger.scores(tagger.tag(texts))


def spans(text: str, p: np.ndarray, bar: float = 0.5) -> list[list[int]]:
    """[start, end) in code points of the words above ``bar``."""
    hot = np.flatnonzero(p > bar)
    if not len(hot):
        return []
    places = [m.span() for m in re.finditer(r"\S+", text)]
    return [list(places[i]) for i in hot if i < len(places)]


def _slim(model: dict | float) -> dict | float:
    if isinstance(model, float):
        return model
    return {"field": {k: v.astype(np.float32) for k, v in model["field"].items()}, "output": model["output"]}


def score_documents(docs: DataFrame, model: dict | float) -> DataFrame:
    """(doc_id, score, spans): spans are the [start, end) of the toxic words."""
    model = _slim(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = None if isinstance(model, float) else Tagger(model)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = part.column(1).to_pylist()
                if tagger:
                    tags = tagger.tag(texts)
                    scores, found = tagger.scores(tags), [spans(t, p) for t, p in zip(texts, tags)]
                else:
                    scores, found = score(model, texts), [[] for _ in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(scores, pa.float64()), pa.array(found, pa.list_(pa.list_(pa.int64())))], names=["doc_id", "score", "spans"]
                )

    importable(docs.sparkSession)
    return text_of(docs).mapInArrow(run, "doc_id long, score double, spans array<array<long>>")


def reject(docs: DataFrame, model: dict | float, bar: float = REJECT) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that score below ``bar``."""
    model, column = _slim(model), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = None if isinstance(model, float) else Tagger(model)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                yield part.filter(pa.array(score(model, [t or "" for t in part.column(column).to_pylist()], tagger) < bar))

    importable(docs.sparkSession)
    return docs.mapInArrow(run, docs.schema)


def learn(docs: DataFrame, labels: DataFrame) -> dict | float:
    return train(*labelled_sample(docs, labels, "toxic", ~held(F.col("doc_id"), 3, 1), SAMPLE))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_documents(docs, learn(docs, labels))
    predicted = (F.col("score") >= REJECT).cast("int").alias("predicted")
    return scored.select("doc_id", held(F.col("doc_id"), 3, 1).alias("held_out"), "score", predicted, F.to_json("spans").alias("toxic_spans"))
