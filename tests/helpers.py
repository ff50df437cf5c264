"""Small fixtures and plain-Python counterparts used by several tests."""

from __future__ import annotations

import numpy as np


def vector_frame(spark, x: np.ndarray, labels=None):
    rows = [
        (i, [float(v) for v in np.float32(row)], int(labels[i]) if labels is not None else 0) for i, row in enumerate(x)
    ]
    return spark.createDataFrame(rows, "doc_id long, embedding array<float>, label int").repartition(4)


def distances(x: np.ndarray) -> np.ndarray:
    x = np.float32(x).astype(np.float64)
    return np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))


def with_copies(seed: int = 7, n: int = 90, d: int = 6) -> np.ndarray:
    """Random rows of which a third are copies of one row, and some more come in pairs."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    x[: n // 3] = x[0]
    x[n // 3 : n // 3 + 6] = x[n // 3 + 6 : n // 3 + 12]
    return x[rng.permutation(n)]


def neighbors(x: np.ndarray, k: int) -> dict[int, list[int]]:
    gap = distances(x)
    out = {}
    for i in range(len(x)):
        others = [j for j in range(len(x)) if j != i]
        out[i] = sorted(others, key=lambda j: (gap[i, j], j))[:k]
    return out


def core_distances(x: np.ndarray, k: int) -> np.ndarray:
    gap = distances(x)
    return np.array([np.sort(np.delete(gap[i], i))[: k][-1] for i in range(len(x))])


def components(linked: np.ndarray) -> np.ndarray:
    """Smallest reachable index per row of a boolean adjacency matrix."""
    root = np.arange(len(linked))
    while True:
        low = np.array([root[linked[i] | (np.arange(len(root)) == i)].min() for i in range(len(root))])
        if (low == root).all():
            return root
        root = low


def silhouette(gap: np.ndarray, labels: np.ndarray) -> float:
    scores = []
    for i in range(len(labels)):
        own = (labels == labels[i]) & (np.arange(len(labels)) != i)
        if not own.any():
            scores.append(0.0)
            continue
        a = gap[i, own].mean()
        b = min(gap[i, labels == c].mean() for c in set(labels) if c != labels[i])
        scores.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(scores))
