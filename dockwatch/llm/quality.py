"""Operator 5: quality classifier learnt from positive and unlabelled documents."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.labelled import FEATURES, SAMPLE_ROWS, fold, labelled_ids, unlabelled_ids, with_features
from dockwatch.llm.shared import Scratch

FOLDS, HELD_OUT = 4, 2
#: Bytes of a segment and words of a chunk: the unit in which a part of a text can be odd.
SEGMENT, CHUNK = 256, 48
HINGES = 4

_CLASS = np.zeros(256, np.uint8)  # 0 letters and all else, 1 capitals, 2 digits, 3 signs, 4 white space
_CLASS[65:91] = 1
_CLASS[48:58] = 2
for _c in range(33, 127):
    if not chr(_c).isalnum():
        _CLASS[_c] = 3
_CLASS[[9, 10, 13, 32]] = 4


def byte_features(text: str) -> list[float]:
    """Shares of capitals, digits and signs: of the whole text and of its most extreme segment, and
    the share of segments that are mostly capitals or rich in signs."""
    kind = _CLASS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)]
    size = len(kind)
    if not size:
        return [0.0] * 8
    starts = np.arange(0, size, SEGMENT)
    length = np.diff(np.append(starts, size))
    shares = [np.add.reduceat((kind == k).astype(np.int32), starts) for k in (1, 2, 3, 4)]
    weight = np.maximum(length, SEGMENT // 2)  # a short last segment counts as half a segment
    top = [(s / weight).max() for s in shares]
    many = [float((shares[0] > 0.5 * length).mean()), float((shares[2] > 0.08 * length).mean())]
    return [shares[0].sum() / size, top[0], shares[1].sum() / size, shares[2].sum() / size, top[2],
            shares[3].sum() / size, *many]


def word_features(text: str) -> list[float]:
    """Length, and how much words repeat: in the whole text and in its most repetitive chunk."""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0, 0.0, 1.0, 1.0, 0.0]
    least = 1.0
    for i in range(0, n, CHUNK):
        part = words[i:i + CHUNK]
        least = min(least, (len(set(part)) + CHUNK - len(part)) / CHUNK)
    same = sum(a == b for a, b in zip(words, words[1:])) / n
    return [np.log1p(n), len(text) / n, len(set(words)) / n, least, same]


def features(texts: list[str]) -> np.ndarray:
    return np.array([byte_features(t) + word_features(t) for t in texts]).reshape(len(texts), 13)


class PuModel:
    """An additive model: each feature is bent at a few quantiles, the terms are summed; the score is the
    probability of the positive class."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, knots: np.ndarray, weights: np.ndarray):
        self.mean, self.scale, self.knots, self.weights = mean, scale, knots, weights

    @staticmethod
    def _terms(x, mean, scale, knots):
        x = np.clip((x - mean) / scale, -20, 20)
        bent = [np.maximum(0, x - (k - mean) / scale) for k in knots]
        return np.concatenate([np.ones((len(x), 1)), x, *bent], axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._terms(x, self.mean, self.scale, self.knots) @ self.weights, -30, 30)))

    @classmethod
    def fit(cls, positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.03,
            decay: float = 1e-4) -> PuModel:
        """Minimise the non-negative unbiased risk
        ``prior * E_p[l(g, +)] + max(0, E_u[l(g, -)] - prior * E_p[l(g, -)])`` with logistic loss.

        Where the second part, the risk on the negatives, falls below zero, it is held at zero and the step
        follows the first part alone. Steps shrink, and the weights of the last half are averaged.
        """
        both = np.concatenate([positive, unlabelled])
        mean, scale = both.mean(axis=0), both.std(axis=0)
        scale = np.where(scale > 1e-9, scale, np.inf)  # a feature that never differs says nothing
        knots = np.quantile(both, np.linspace(0, 1, HINGES + 2)[1:-1] ** 0.5, axis=0)
        p, u = (cls._terms(z, mean, scale, knots) for z in (positive, unlabelled))
        w = np.zeros(p.shape[1])
        w[0] = np.log(prior / (1 - prior))
        m, v, mid = np.zeros_like(w), np.zeros_like(w), np.zeros_like(w)
        sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        for t in range(1, steps + 1):
            gp, gu = p @ w, u @ w
            neg = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
            d_pos = -prior * (p.T @ sig(-gp)) / len(p)
            d_neg = (u.T @ sig(gu)) / len(u) - prior * (p.T @ sig(gp)) / len(p)
            g = (d_pos + d_neg if neg >= 0 else d_pos) + decay * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            w = w - rate / (1 + t / 300) * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
            mid += w / (steps - steps // 2) if t > steps // 2 else 0
        return cls(mean, scale, knots, mid)


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> PuModel | None:
    """Fit on at most ``rows`` trusted positives and ``rows`` unlabelled documents, none held out; an id that
    repeats is one document.

    Only positive labels train the classifier. The class prior is the share of positives among the labelled
    rows of the same bounded sample, kept inside (0.01, 0.99). None without a positive.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    ids = scratch.table(labelled_ids(labels, "quality", FOLDS, HELD_OUT, rows))
    n, n1 = ids.agg(F.count(F.lit(1)), F.count_if(F.col("y") == 1)).first()
    if not n1:
        return None
    web = scratch.table(unlabelled_ids(docs, FOLDS, HELD_OUT, rows))
    wanted = ids.where("y = 1").select("doc_id", F.lit(1).alias("kind")).union(web.select("doc_id", F.lit(0)))
    # one text of a repeated id: the smallest
    texts = docs.select("doc_id", "text").join(F.broadcast(wanted), "doc_id", "left_semi").groupBy("doc_id").agg(
        F.min("text").alias("text"))
    sample = texts.join(F.broadcast(wanted), "doc_id")
    x = with_features(sample, "text", features, ["kind"]).toArrow()  # at most 2 * rows feature vectors
    kind = x.column("kind").to_numpy()
    if not (kind == 1).any() or not (kind == 0).any():
        return None
    val = np.array(x.column(FEATURES).to_pylist(), np.float64)
    return PuModel.fit(val[kind == 1], val[kind == 0], min(max(n1 / n, 0.01), 0.99))


def _scored(docs: DataFrame, model: PuModel | None, keep: list[str]) -> DataFrame:
    if model is None:
        return docs.select(*keep, F.lit(1.0).alias("_quality_score"))

    def make(texts):
        return model.score(features(texts))[:, None]

    return with_features(docs, "text", make, keep).select(*keep, F.col(FEATURES)[0].alias("_quality_score"))


def held_out() -> Column:
    return F.coalesce(fold("doc_id", FOLDS) == HELD_OUT, F.lit(False))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Null and empty texts are scored as texts without words. Repeated rows are scored alike. A null doc_id
    is never held out. Without a positive label nothing can be learnt: every score is 1. No documents: no rows.
    Other columns are ignored.
    """
    s = _scored(docs, fit(docs, labels, **options), ["doc_id"])
    return s.select("doc_id", held_out().alias("held_out"), F.col("_quality_score").alias("score"),
                    (F.col("_quality_score") >= threshold).cast("int").alias("predicted"))


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **options) -> DataFrame:
    """``docs``, all columns, without those that score below ``threshold``."""
    whole = docs.select(F.struct("*").alias("row"), "text")  # no column can clash with the operator's
    return _scored(whole, fit(docs, labels, **options), ["row"]).where(F.col("_quality_score") >= threshold).select("row.*")
