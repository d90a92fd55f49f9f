"""Logistic regression on hashed binary features, trained with
follow-the-regularised-leader updates (FTRL-proximal)."""

from __future__ import annotations


def train(rows, labels, size: int, *, epochs: int = 5, alpha: float = 1.0, beta: float = 1.0,
          l1: float = 4.0, l2: float = 0.0):
    """Weights (float32 array of ``size``; the last is the bias).

    ``rows``: arrays of distinct feature numbers below ``size - 1``.  A model
    without rows has zero weights: every score is one half.
    """
    import numpy as np

    z, n = np.zeros(size), np.zeros(size)

    def weights(i):
        zi = z[i]
        short = np.abs(zi) <= l1
        return np.where(short, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    rows = [np.append(r, size - 1) for r in rows]
    for epoch in range(epochs):
        for k in np.random.default_rng(epoch).permutation(len(rows)):
            i = rows[k]
            w = weights(i)
            g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - labels[k]
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha * w
            n[i] += g * g
    return weights(np.arange(size)).astype(np.float32)
