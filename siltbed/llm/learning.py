"""A bounded sample of labelled documents, and small pieces of numpy training."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltbed.llm.common import text_of


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, allowed: Column, most: int) -> tuple[list[str], np.ndarray]:
    """At most about ``most`` texts with their 0/1 label, from the label rows for which ``allowed`` holds.

    The rows are chosen by a hash of the id, so a second run takes the same. Labels that are null or
    contradict each other for one id are left out. Only the chosen ids, about ``most`` and never more than
    twice that, are sent to the tasks that read the documents.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("y")).where(allowed & F.col("y").isin(0, 1))
    known = known.groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("z")).where("y = z and doc_id is not null").select("doc_id", "y")
    cut = int(min(1.0, most / max(known.count(), 1)) * (1 << 30))
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < cut).limit(2 * most)
    # An id that comes many times is folded where it lies: one text each is sent to the driver.
    found = text_of(docs).join(F.broadcast(chosen), "doc_id")
    rows = sorted(found.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y")).collect())
    return [r.text for r in rows], np.array([r.y for r in rows], dtype=np.float64)


def sigmoid(x: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
    if out is None:
        return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
    np.negative(np.clip(x, -30, 30, out=out), out=out)
    np.exp(out, out=out)
    out += 1
    return np.divide(1, out, out=out)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weights of a logistic regression, the intercept last, by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = sigmoid(x @ w)
        keep = ridge * np.r_[w[:-1], 0]
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + keep)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Adam:
    def __init__(self, rate: float):
        self.rate, self.t, self.m, self.v, self.spare = rate, 0, {}, {}, {}

    def step(self, params: dict[str, np.ndarray], grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        for k, g in grads.items():
            g = np.asarray(g)
            if k not in self.m:
                self.m[k], self.v[k], self.spare[k] = np.zeros_like(g), np.zeros_like(g), np.empty_like(g)
            m, v, x = self.m[k], self.v[k], self.spare[k]
            m *= 0.9
            m += np.multiply(g, 0.1, out=x)
            np.multiply(g, 0.001, out=x)
            x *= g
            v *= 0.999
            v += x
            np.sqrt(np.divide(v, 1 - 0.999**self.t, out=x), out=x)
            x += 1e-8
            change = np.asarray(m / (1 - 0.9**self.t))
            change *= self.rate
            change /= x
            params[k] -= change.astype(params[k].dtype, copy=False)
