"""Quality classifier by positive-unlabelled learning.

Positives are documents with ``quality`` = 1; the unlabelled set is documents
without a label.  Labelled negatives are not used.  A small network on counts
of the text (shares of symbols, case, repetition, lengths) minimises the
non-negative unbiased risk (Kiryo et al., 2017)

    pi * R_p(+) + max(0, R_u(-) - pi * R_p(-))

with the sigmoid loss, where pi, the share of positives among the unlabelled,
is estimated first: a first network tells positives from unlabelled, and over
all its score cuts pi is at most the unlabelled share above the cut divided
by the positives' share (less an error bound); the least such ratio is taken.
The output is shifted so that a share pi of the unlabelled training documents
scores 0.5 or more.

Only rows outside the held-out fold (crc32 of the id's text modulo 3 is 1)
are used in training.  It takes at most ``SAMPLE`` positives and ``SAMPLE``
unlabelled documents, by hash of the id; every document is scored.

Defined results.  Null or empty text: scored like any text, from its counts.
Null id: scored, not held out.  Conflicting labels: not used.  Repeated rows:
one result row each.  No positives: every score is 0.5.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fold, materialize, slices
from .textstats import text_stats

SAMPLE = 20_000
FOLDS, HELD_OUT = 3, 1
HIDDEN = 24


def features(text: str) -> list[float]:
    """Shares and log sizes of one text."""
    (chars, words, word_chars, symbols, dup_lines, repeat, lines, distinct, top, adjacent, upper,
     lower, digits, exclaim, pipes, stops, commas, other) = text_stats(text)
    w, c, n = max(words, 1), max(word_chars, 1), max(lines, 1)
    return [math.log1p(chars), math.log1p(words), math.log1p(lines), word_chars / w, words / n,
            symbols / w, math.sqrt(symbols / c), pipes / w, exclaim / w, digits / c,
            upper / c, lower / c, upper / max(upper + lower, 1), stops / w, commas / w, other / c,
            dup_lines / n, repeat / w, distinct / w, top / w, adjacent / w,
            math.log1p(distinct) / math.log1p(w) if words else 0.0, float(words < 20)]


N_FEATURES = 23


@F.arrow_udf(T.ArrayType(T.FloatType()))
def features_udf(text: pa.Array) -> pa.Array:
    return pa.array([features(x or "") for part in slices(text) for x in part], pa.list_(pa.float32()))


class PuNetwork:
    """One hidden layer; scores are probabilities of quality 1."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.mean, self.spread = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.p = {"w": r.normal(0, 0.3, (N_FEATURES, HIDDEN)), "b": np.zeros(HIDDEN),
                  "v": r.normal(0, 0.3, HIDDEN), "c": np.zeros(1)}
        self.shift, self.prior = 0.0, 0.5

    def scale(self, x: np.ndarray) -> None:
        self.mean, self.spread = x.mean(0), x.std(0) + 1e-3

    def _forward(self, x: np.ndarray):
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        h = np.tanh(z @ self.p["w"] + self.p["b"])
        return z, h, h @ self.p["v"] + self.p["c"][0]

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x)[2]

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x) - self.shift, -30, 30)))

    def _descend(self, x: np.ndarray, dout: np.ndarray, rate: float, state: dict) -> None:
        z, h, _ = self._forward(x)
        dh = dout[:, None] * self.p["v"] * (1 - h * h)
        grads = {"w": z.T @ dh + 1e-4 * self.p["w"], "b": dh.sum(0),
                 "v": h.T @ dout + 1e-4 * self.p["v"], "c": dout.sum(keepdims=True)}
        state["n"] += 1
        for k, g in grads.items():
            m, s = state.setdefault(k, (np.zeros_like(g), np.zeros_like(g)))
            m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
            state[k] = (m, s)
            self.p[k] -= rate * (m / (1 - 0.9 ** state["n"])) / (
                np.sqrt(s / (1 - 0.999 ** state["n"])) + 1e-8)

    def train(self, pos: np.ndarray, unl: np.ndarray, prior: float | None, epochs: int = 15,
              rate: float = 3e-3, seed: int = 1) -> None:
        """Non-negative risk with ``prior``; without, positives against
        unlabelled by logistic loss."""
        r, state = np.random.default_rng(seed), {"n": 0}
        steps = max(30, -(-max(len(pos), len(unl)) // 256))
        for _ in range(epochs):
            for _ in range(steps):
                a, b = pos[r.integers(0, len(pos), 256)], unl[r.integers(0, len(unl), 256)]
                x = np.concatenate([a, b])
                s = 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))
                sp, su = s[:256], s[256:]
                if prior is None:
                    dout = np.concatenate([sp - 1, su]) / 512
                else:
                    # sigmoid loss: l(+) = 1 - s, l(-) = s
                    slope_p, slope_u = sp * (1 - sp) / 256, su * (1 - su) / 256
                    if su.mean() - prior * sp.mean() >= 0:
                        dout = np.concatenate([-2 * prior * slope_p, slope_u])
                    else:  # the negative part went below zero: climb back
                        dout = np.concatenate([prior * slope_p, -slope_u])
                self._descend(x, dout, rate, state)


def estimate_prior(pos: np.ndarray, unl: np.ndarray) -> float:
    """From scores held back: the least over cuts of (unlabelled share above)
    / (positives' share above), each widened by its error."""
    cuts = np.unique(np.quantile(pos, np.linspace(0, 0.98, 99)))
    above_p = np.array([(pos >= c).mean() for c in cuts])
    above_u = np.array([(unl >= c).mean() for c in cuts])
    slack = np.sqrt(above_u * (1 - above_u) / len(unl)) + np.sqrt(above_p * (1 - above_p) / len(pos))
    usable = above_p > 0.1
    return float(np.clip(((above_u + slack) / above_p)[usable].min(), 0.05, 0.98))


def fit(measured: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> PuNetwork | None:
    """``measured``: ``id, x``.  None where there is nothing to learn from."""
    marks = (labels.filter("doc_id is not null and quality is not null")
             .groupBy(F.col("doc_id").cast("bigint").alias("id"))
             .agg(F.min("quality").alias("lo"), F.max("quality").alias("hi")))
    train = measured.filter(fold(F.col("id"), FOLDS) != HELD_OUT).join(marks, "id", "left")
    train = train.withColumn("h", F.pmod(F.xxhash64("id", F.lit("pu")), F.lit(1 << 40)))

    def take(rows: DataFrame) -> np.ndarray:
        # by a threshold on the hash first, so that little over the sample
        # leaves the executors, however many rows and tasks there are
        total = max(1, rows.count())
        some = rows.filter(F.col("h") < int((1 << 40) * min(1.0, 1.1 * sample / total)))
        got = sorted(((r.h, r.id, r.x) for r in some.select("h", "id", "x").collect()),
                     key=lambda r: (r[0], r[1] or 0))
        return np.array([r[2] for r in got[:sample]], float).reshape(-1, N_FEATURES)

    pos, unl = take(train.filter("lo = 1 and hi = 1")), take(train.filter("lo is null"))
    if not len(pos) or not len(unl):
        return None
    half_p, half_u = len(pos) // 2, len(unl) // 2
    first = PuNetwork()
    first.scale(unl)
    first.train(pos[:max(1, half_p)], unl[:max(1, half_u)], None)
    network = PuNetwork()
    network.prior = estimate_prior(first.raw(pos[half_p:]), first.raw(unl[half_u:]))
    network.scale(unl)
    network.train(pos, unl, network.prior)
    network.shift = float(np.quantile(network.raw(unl), 1 - network.prior))
    return network


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return materialize(docs.select(docs[id_col].cast("bigint").alias("id"),
                                   features_udf(docs[text_col]).alias("x")), "features")


def score(measured: DataFrame, network: PuNetwork | None) -> DataFrame:
    """``id, score`` of every row."""
    if network is None:
        return measured.select("id", F.lit(0.5).alias("score"))

    @F.arrow_udf(T.DoubleType())
    def scores(x: pa.Array) -> pa.Array:
        flat = x.flatten().to_numpy(zero_copy_only=False).astype(float)
        return pa.array(network.score(flat.reshape(-1, N_FEATURES)))

    return measured.select("id", scores("x").alias("score"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """The id, ``held_out``, ``score`` and ``predicted`` of every document."""
    measured = measure(docs, id_col, text_col)
    scored = score(measured, fit(measured, labels, sample))
    held = F.coalesce(fold(F.col("id"), FOLDS) == HELD_OUT, F.lit(False))
    return scored.select(F.col("id").alias(id_col), held.alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
