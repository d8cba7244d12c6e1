"""Sparse binary logistic regression on hashed features, trained on bounded samples."""

from __future__ import annotations

import re

import numpy as np

from periodbook.llm.common import hashes

BITS = 18
TOKEN = re.compile(r"\w+")
STEM = 5


def tokens(text: str | None) -> list[str]:
    return TOKEN.findall(text.lower()) if text else []


def features(words: list[str], bits: int = BITS) -> np.ndarray:
    """Sorted feature numbers of a text: its distinct words, and the first letters of the longer ones."""
    seen = set(words)
    stems = {f"{w[:STEM]}-" for w in seen if len(w) > STEM}
    return np.unique(hashes([*seen, *stems]) >> np.uint64(64 - bits)).astype(np.int32)


class Rows:
    """Rows of feature numbers, in one flat array; sums go by slices, so that passing copies stay small."""

    SLICE = 1 << 20

    def __init__(self, rows: list[np.ndarray], width: int) -> None:
        sizes = np.array([len(r) for r in rows], np.int64)
        self.row = np.repeat(np.arange(len(rows), dtype=np.int32), sizes)
        self.feature = np.concatenate(rows, dtype=np.int32, casting="unsafe") if len(rows) else np.zeros(0, np.int32)
        self.n, self.width = len(rows), width

    def of(self, wanted: np.ndarray) -> Rows:
        """The wanted rows, in order."""
        out = object.__new__(Rows)
        held = wanted[self.row]
        out.row = (np.cumsum(wanted, dtype=np.int32) - 1)[self.row[held]]
        out.feature, out.n, out.width = self.feature[held], int(wanted.sum()), self.width
        return out

    def only(self, features: np.ndarray) -> Rows:
        """All rows with the given features alone, which are numbered by their places in ``features``."""
        out = object.__new__(Rows)
        place = np.full(self.width, -1, np.intp)
        place[features] = np.arange(len(features))
        feature = place[self.feature]
        held = feature >= 0
        out.row, out.feature, out.n, out.width = self.row[held].astype(np.intp), feature[held], self.n, len(features)
        return out

    def _summed(self, into: np.ndarray, values: np.ndarray, by: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(size)
        for k in range(0, len(into), self.SLICE):
            part = slice(k, k + self.SLICE)
            out += np.bincount(into[part], values[by[part]], size)
        return out

    def dot(self, weights: np.ndarray) -> np.ndarray:
        return self._summed(self.row, weights, self.feature, self.n)

    def back(self, per_row: np.ndarray) -> np.ndarray:
        return self._summed(self.feature, per_row, self.row, self.width)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35, 35)))


def log_ratios(rows: Rows, label: np.ndarray, importance: np.ndarray, least: int = 5) -> np.ndarray:
    """How much likelier a feature is in label 1 than in label 0, as a logarithm; 0 for features of fewer than ``least`` rows that count."""
    ones, zeros = rows.back(label * importance) + 1.0, rows.back((1 - label) * importance) + 1.0
    ratio = np.log(ones / ((label * importance).sum() + 2)) - np.log(zeros / (((1 - label) * importance).sum() + 2))
    return np.where(rows.back((importance > 0).astype(np.float64)) >= least, ratio, 0.0)


def fit(
    rows: Rows, label: np.ndarray, l2: float = 1e-3, steps: int = 150, rate: float = 0.05, importance: np.ndarray | None = None,
    pairs: tuple[Rows, Rows] | None = None, pair_weight: float = 0.0,
) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch Adam over features scaled by their log ratios, so that rare words carry little.

    Rows of importance 0 take no part. ``pairs`` are rows whose scores should be equal: their squared differences are penalised.
    """
    importance = np.ones(rows.n) if importance is None else importance
    scale = log_ratios(rows, label, importance)
    # a feature whose scale is 0 has no gradient, so its weight stays 0: the steps go without it
    width, used = rows.width, np.flatnonzero(scale)
    rows, scale = rows.only(used), scale[used]
    pairs = pairs and (pairs[0].only(used), pairs[1].only(used))
    w, b = np.zeros(rows.width), 0.0
    m, v, mb, vb = np.zeros(rows.width), np.zeros(rows.width), 0.0, 0.0
    importance = importance / max(importance.sum(), 1e-9)
    for t in range(1, steps + 1):
        scaled = w * scale
        error = (sigmoid(rows.dot(scaled) + b) - label) * importance
        g, gb = rows.back(error), error.sum()
        if pairs is not None and pairs[0].n and pair_weight:
            apart = 2.0 * pair_weight / pairs[0].n * (pairs[0].dot(scaled) - pairs[1].dot(scaled))
            g += pairs[0].back(apart) - pairs[1].back(apart)
        g = g * scale + l2 * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
        b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-8)
    weights = np.zeros(width)
    weights[used] = w * scale
    return weights, float(b)


def calibrate(z: np.ndarray, label: np.ndarray, steps: int = 300) -> tuple[float, float]:
    """Slope and shift (Platt) that turn scores into probabilities; the identity when one class is missing."""
    if len(np.unique(label)) < 2:
        return 1.0, 0.0
    target = np.where(label > 0, (label.sum() + 1) / (label.sum() + 2), 1 / ((1 - label).sum() + 2))
    scale = max(float(np.std(z)), 1e-6)
    a, b = 1.0, 0.0
    x = z / scale
    for _ in range(steps):  # Newton steps on two parameters
        p = sigmoid(a * x + b)
        e, h = p - target, np.maximum(p * (1 - p), 1e-9)
        g = np.array([(e * x).sum() + 1e-3 * a, e.sum()])
        hess = np.array([[(h * x * x).sum() + 1e-3, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(hess, g)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(a / scale), float(b)
