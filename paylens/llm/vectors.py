"""Shared by the embedding operators: which vectors take part, and k-means on a bounded sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column | str) -> Column:
    """Whether a vector takes part: not null, no null or non-finite component, not all zero."""
    v = F.col(vector) if isinstance(vector, str) else vector
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & F.exists(v, lambda x: x != 0), F.lit(False))


def sample_vectors(vectors: DataFrame, id_col: str, vector_col: str, size: int) -> np.ndarray:
    """Up to ``size`` vectors for fitting, those of the smallest hash of their id, as float64 rows."""
    rows = vectors.select(F.xxhash64(id_col).alias("h"), vector_col).orderBy("h", vector_col).limit(size).collect()
    return np.array([r[1] for r in rows], dtype=np.float64)


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 0) -> np.ndarray:
    """Centres of Lloyd's k-means from a k-means++ start; at most as many as distinct rows."""
    rng = np.random.default_rng(seed)
    centres = [x[int(rng.integers(len(x)))]]
    nearest = ((x - centres[0]) ** 2).sum(axis=1)
    while len(centres) < k and nearest.max() > 0:
        centres.append(x[int(rng.choice(len(x), p=nearest / nearest.sum()))])
        nearest = np.minimum(nearest, ((x - centres[-1]) ** 2).sum(axis=1))
    c = np.array(centres)
    for _ in range(rounds):
        own = closest(x, c)
        counts = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], c)
    return c


def closest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The index of each row's closest centre."""
    return ((centres**2).sum(axis=1)[None, :] - 2 * (x @ centres.T)).argmin(axis=1)
