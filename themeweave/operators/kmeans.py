"""K-Means over a range of k, the k chosen by cosine silhouette.

All models of the sweep - every k and every restart - move together: one pass
over the vectors advances each of them by one Lloyd step, so the corpus is read
as often as the slowest model needs steps, not once per model and step. A task
returns one partial sum per centroid, which Spark adds up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import vectors as vx
from ..session import materialize
from .sampling import select_best_k

SEED_ROUNDS = 4  # passes over all rows that look for starting centroids
SEEDS_PER_K = 8  # candidates that a pass adds, per cluster of the largest model
MAX_STEPS = 300
TOLERANCE = 1e-4  # of the mean feature variance, for the squared move of all centroids
BLOCK = 512  # rows whose scores are held at once, fewer
SCORES = 1 << 19  # if that made more than so many scores
PARTIALS = "model int, slot int, n long, total array<double>"


@dataclass
class Model:
    k: int
    centroids: np.ndarray
    cost: float = float("inf")
    settled: bool = False


@dataclass
class Sweep:
    """Result of a sweep: ``labels`` (doc_id, cluster_kmeans), the chosen k, its score, all scores.

    ``scores`` says for each k whether its model had settled when the steps ran out.
    """

    labels: DataFrame
    k: int | None
    score: float | None
    scores: DataFrame
    centroids: DataFrame


def _spread_seeds(pool: np.ndarray, weight: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Starting centroids drawn from weighted candidates one by one, with probability by squared distance."""
    chosen = [pool[rng.choice(len(pool), p=weight / weight.sum())]]
    gap = ((pool - chosen[0]) ** 2).sum(axis=1)
    while len(chosen) < k:
        total = (gap * weight).sum()
        pick = rng.choice(len(pool), p=gap * weight / total) if total > 0 else rng.integers(len(pool))
        chosen.append(pool[pick])
        gap = np.minimum(gap, ((pool - pool[pick]) ** 2).sum(axis=1))
    return np.array(chosen)


def _gaps(x: np.ndarray, pool: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest candidate of each row and the squared distance to it."""
    apart = (pool**2).sum(axis=1) - 2.0 * (x @ pool.T)
    nearest = apart.argmin(axis=1)
    return nearest, np.maximum(apart[np.arange(len(x)), nearest] + (x**2).sum(axis=1), 0.0)


def _seed_pool(rows: DataFrame, k: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Candidates for starting centroids from all rows, and how many rows are nearest to each.

    Every round draws a bounded number of rows by squared distance to the
    candidates so far (weighted sampling by the least of ``-ln(u) / weight``), so
    far rows are found wherever they are (Bahmani et al., "Scalable K-Means++", 2012).
    """
    first = rows.orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(1).collect()
    pool = np.array([r["v"] for r in first], dtype=np.float64)
    n = SEEDS_PER_K * k
    for turn in range(SEED_ROUNDS):
        known = pool

        def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = vx.to_matrix(batch.column("v"))
                _, gap = _gaps(x, known)
                u = (batch.column("u").to_numpy().astype(np.float64) + 1.0) / 2.0**31
                rank = np.where(gap > 1e-12, -np.log(u) / np.maximum(gap, 1e-12), np.inf)
                best = np.argsort(rank, kind="stable")[:n]
                best = best[np.isfinite(rank[best])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array(best)), pa.array(rank[best]), batch.column("v").take(pa.array(best))], names=["doc_id", "rank", "v"]
                )

        uniform = F.pmod(F.xxhash64("doc_id", F.lit(seed), F.lit(turn)), F.lit((1 << 31) - 1))
        drawn = rows.select("doc_id", uniform.alias("u"), "v").mapInArrow(draw, "doc_id long, rank double, v array<float>")
        new = drawn.orderBy("rank", "doc_id").limit(n).collect()  # n rows
        if not new:
            break
        pool = np.concatenate([pool, np.array([r["v"] for r in new], dtype=np.float64)])
    known = pool

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_of = np.zeros(len(known), np.int64)
        for batch in batches:
            if batch.num_rows:
                n_of += np.bincount(_gaps(vx.to_matrix(batch.column("v")), known)[0], minlength=len(known))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(known))), pa.array(n_of)], names=["candidate", "n"])

    counted = rows.select("v").mapInArrow(count, "candidate long, n long").groupBy("candidate").agg(F.sum("n").alias("n"))
    weight = np.zeros(len(known))
    for r in counted.collect():
        weight[r["candidate"]] = r["n"]
    return pool, weight


def _mean_variance(rows: DataFrame) -> float:
    """Mean over features of their variance over all rows."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = vx.to_matrix(batch.column("v"))
                yield pa.RecordBatch.from_arrays([pa.array([len(x)]), vx.to_lists(np.stack([x.sum(axis=0), (x**2).sum(axis=0)]).reshape(1, -1))], names=["n", "s"])

    total = rows.select("v").mapInArrow(sums, "n long, s array<double>")
    r = total.agg(F.sum("n").alias("n"), Summarizer.sum(array_to_vector("s")).alias("s")).select("n", vector_to_array("s").alias("s")).first()
    if not r["n"]:
        return 0.0
    mean, square = np.array(r["s"]).reshape(2, -1) / r["n"]
    return float(np.maximum(square - mean**2, 0.0).mean())


def _few_tasks(rows: DataFrame) -> DataFrame:
    """At most a few tasks per core, since every task returns a sum per centroid."""
    spark = rows.sparkSession
    wanted = 2 * max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return rows.coalesce(wanted)


def _groups(ks: list[int]) -> tuple[list[tuple[int, int, np.ndarray]], np.ndarray]:
    """(k, first place, starts of the models) of models of one k, and the order that puts their first slots first, then the second ones."""
    starts = np.cumsum([0, *ks])[:-1]
    groups, order, at = [], [], 0
    for k in sorted(set(ks)):
        of_k = starts[np.asarray(ks) == k]
        groups.append((k, at, of_k))
        order.append((np.arange(k)[:, None] + of_k[None, :]).ravel())
        at += k * len(of_k)
    return groups, np.concatenate(order)


def _members(x: np.ndarray, stacked: np.ndarray, ks: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of x, members, order) by blocks of rows: a row per centroid ``stacked[order]``, true for the rows nearest to it in its model.

    Products in single precision decide where the nearest centroid leads by more than
    the bound on their error; what is left is decided in double precision, ties to the first.
    Scores of one slot of many models lie in a row, so that finding their least runs along them.
    """
    groups, order = _groups(ks)
    norms = (stacked**2).sum(axis=1)
    middle = stacked.mean(axis=0)
    centres = stacked[order] - middle
    lengths = (centres**2).sum(axis=1)
    most = lengths.max()
    slack = 2.0 * (x.shape[1] + 8) * float(np.finfo(np.float32).eps)
    right = np.concatenate([-2.0 * centres, lengths[:, None]], axis=1).astype(np.float32)
    step = max(64, min(BLOCK, SCORES // len(stacked)))
    for start in range(0, len(x), step):
        part = x[start : start + step]
        left = part - middle
        margin = (slack * (2.0 * np.sqrt((left**2).sum(axis=1) * most) + most + 1e-30)).astype(np.float32)
        scores = right @ np.concatenate([left, np.ones((len(part), 1))], axis=1).astype(np.float32).T
        near = np.empty(scores.shape, bool)
        for k, at, of_k in groups:
            shape = (k, len(of_k), len(part))
            block = scores[at : at + k * len(of_k)].reshape(shape)
            close = near[at : at + k * len(of_k)].reshape(shape)
            np.less_equal(block, block.min(axis=0) + margin, out=close)
            which, rows = np.nonzero(close.sum(axis=0, dtype=np.int32) != 1)
            if len(which):
                slots = of_k[which] + np.arange(k)[:, None]
                exact = norms[slots] - 2.0 * np.einsum("pd,kpd->kp", part[rows], stacked[slots])
                close[:, which, rows] = False
                close[exact.argmin(axis=0), which, rows] = True
        yield part, near, order


def _lloyd_step(rows: DataFrame, models: dict[int, Model]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """One pass over the rows: per model the new sums and counts."""
    index = list(models)
    ks = [models[m].k for m in index]
    stacked = np.concatenate([models[m].centroids for m in index])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(stacked), np.zeros(len(stacked), dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            with np.errstate(over="ignore", invalid="ignore"):
                for x, near, order in _members(vx.to_matrix(batch.column("v")), stacked, ks):
                    sums[order] += near.astype(np.float64) @ x
                    counts[order] += np.count_nonzero(near, axis=1)
        used = np.flatnonzero(counts)
        model = np.repeat(index, ks)
        slot = np.concatenate([np.arange(k) for k in ks])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(model[used].astype(np.int32)),
                pa.array(slot[used].astype(np.int32)),
                pa.array(counts[used]),
                vx.to_lists(sums[used]),
            ],
            names=["model", "slot", "n", "total"],
        )

    merged = (
        _few_tasks(rows)
        .mapInArrow(scan, PARTIALS)
        .groupBy("model", "slot")
        .agg(F.sum("n").alias("n"), Summarizer.sum(array_to_vector("total")).alias("total"))
        .select("model", "slot", "n", vector_to_array("total").alias("total"))
    )
    table = merged.toArrow()  # one row per centroid
    out = {m: (np.zeros_like(models[m].centroids), np.zeros(models[m].k)) for m in index}
    totals = vx.to_matrix(table.column("total"))
    for i, (m, slot, n) in enumerate(zip(*(table.column(c).to_pylist() for c in ("model", "slot", "n")))):
        sums, counts = out[m]
        sums[slot] += totals[i]
        counts[slot] += n
    return out


def _costs(rows: DataFrame, models: dict[int, Model]) -> dict[int, float]:
    """Per model the sum of squared distances to the nearest centroids, in double precision."""
    index = list(models)
    stacked = np.concatenate([models[m].centroids for m in index])
    starts = np.cumsum([0] + [models[m].k for m in index])
    norms = (stacked**2).sum(axis=1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        costs = np.zeros(len(stacked))
        for batch in batches:
            if not batch.num_rows:
                continue
            x = vx.to_matrix(batch.column("v"))
            own = (x**2).sum(axis=1)
            scores = norms[None, :] - 2.0 * (x @ stacked.T)
            for start, stop in zip(starts, starts[1:]):
                best = scores[:, start:stop].argmin(axis=1)
                gaps = np.maximum(own + scores[np.arange(len(x)), start + best], 0.0)
                costs[start:stop] += np.bincount(best, weights=gaps, minlength=stop - start)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(index, np.diff(starts)).astype(np.int32)), pa.array((np.arange(len(stacked)) - np.repeat(starts[:-1], np.diff(starts))).astype(np.int32)), pa.array(costs)],
            names=["model", "slot", "cost"],
        )

    partials = _few_tasks(rows).mapInArrow(scan, "model int, slot int, cost double")
    out = dict.fromkeys(index, 0.0)
    for r in partials.groupBy("model", "slot").agg(F.sum("cost").alias("cost")).collect():  # one row per centroid
        out[r["model"]] += r["cost"]
    return out


def fit_models(rows: DataFrame, ks: list[int], n_init: int, seed: int, max_steps: int = MAX_STEPS) -> dict[int, Model]:
    """The best of ``n_init`` restarts for every k. ``rows`` is (doc_id, v)."""
    pool, weight = _seed_pool(rows, max(ks), seed)
    models = {
        i: Model(k, _spread_seeds(pool, weight, k, np.random.default_rng([seed, k, run])))
        for i, (k, run) in enumerate((k, run) for k in ks for run in range(n_init))
    }
    tolerance = TOLERANCE * _mean_variance(rows)
    for _ in range(max_steps):
        moving = {i: m for i, m in models.items() if not m.settled}
        if not moving:
            break
        for i, (sums, counts) in _lloyd_step(rows, moving).items():
            model = moving[i]
            moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], model.centroids)
            # An empty cluster starts anew at the candidate that is worst served.
            for slot in np.flatnonzero(counts == 0):
                _, gap = _gaps(pool, moved)
                if gap.max() > 0:
                    moved[slot] = pool[gap.argmax()]
            model.settled = bool(((moved - model.centroids) ** 2).sum() <= tolerance)
            model.centroids = moved
    # The cost of the centroids as they are now, not before their last move.
    for i, cost in _costs(rows, models).items():
        models[i].cost = cost
    best: dict[int, Model] = {}
    for model in models.values():
        if model.k not in best or model.cost < best[model.k].cost:
            best[model.k] = model
    return best


def _label_all(rows: DataFrame, best: dict[int, Model]) -> DataFrame:
    """(doc_id, v, labels): the nearest slot under each model, in k order."""
    ks = sorted(best)
    centres = [best[k].centroids for k in ks]
    norms = [(c**2).sum(axis=1) for c in centres]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = vx.to_matrix(batch.column("v"))
            labels = np.stack([(n - 2.0 * (x @ c.T)).argmin(axis=1) for c, n in zip(centres, norms)], axis=1)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(ks))
            lists = pa.ListArray.from_arrays(offsets, pa.array(labels.reshape(-1).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("v"), lists], names=["doc_id", "v", "labels"])

    return rows.mapInArrow(scan, "doc_id long, v array<float>, labels array<int>")


def _cosine_scores(labelled: DataFrame, best: dict[int, Model]) -> list[tuple[int, float]]:
    """Mean cosine silhouette of every labelling, two passes for all of them."""
    ks = sorted(best)
    starts = np.cumsum([0] + ks)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = None, np.zeros(starts[-1], dtype=np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = vx.unit_rows(vx.to_matrix(batch.column("v")))
            labels = vx.to_matrix(batch.column("labels")).astype(np.int64)
            sums = np.zeros((starts[-1], x.shape[1])) if sums is None else sums
            for j in range(len(ks)):
                member = np.zeros((ks[j], len(x)))
                member[labels[:, j], np.arange(len(x))] = 1.0
                sums[starts[j] : starts[j + 1]] += member @ x
                counts[starts[j] : starts[j + 1]] += np.bincount(labels[:, j], minlength=ks[j])
        if sums is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(starts[-1], dtype=np.int32)), pa.array(counts), vx.to_lists(sums)],
                names=["slot", "n", "total"],
            )

    stats = (
        _few_tasks(labelled.select("v", "labels"))
        .mapInArrow(gather, "slot int, n long, total array<double>")
        .groupBy("slot")
        .agg(F.sum("n").alias("n"), Summarizer.sum(array_to_vector("total")).alias("total"))
        .select("slot", "n", vector_to_array("total").alias("total"))
        .orderBy("slot")
        .collect()
    )
    sizes = np.array([r["n"] for r in stats], dtype=np.float64)
    totals = np.array([r["total"] for r in stats], dtype=np.float64)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(len(ks)), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            x = vx.unit_rows(vx.to_matrix(batch.column("v")))
            labels = vx.to_matrix(batch.column("labels")).astype(np.int64)
            n += len(x)
            for j in range(len(ks)):
                size, total = sizes[starts[j] : starts[j + 1]], totals[starts[j] : starts[j + 1]]
                mine = (np.arange(len(x)), labels[:, j])
                apart = size[None, :] - x @ total.T  # summed cosine distances to each cluster
                same = (x**2).sum(axis=1)  # a zero row is at distance 1 from itself, too
                a = (apart[mine] - (1.0 - same)) / np.maximum(size[labels[:, j]] - 1, 1)
                mean = np.divide(apart, size[None, :], out=np.full_like(apart, np.inf), where=size[None, :] > 0)
                mean[mine] = np.inf
                b = mean.min(axis=1)
                larger = np.maximum(a, b)
                s = np.divide(b - a, larger, out=np.zeros_like(a), where=np.isfinite(b) & (larger > 0))
                sums[j] += s[size[labels[:, j]] > 1].sum()
        yield pa.RecordBatch.from_arrays([pa.array(ks, pa.int32()), pa.array(sums), pa.array([n] * len(ks))], names=["k", "s", "n"])

    means = (
        labelled.select("v", "labels")
        .mapInArrow(score, "k int, s double, n long")
        .groupBy("k")
        .agg((F.sum("s") / F.sum("n")).alias("silhouette"))
    )
    return [(row["k"], row["silhouette"]) for row in means.orderBy("k").collect()]


def kmeans_sweep(
    df: DataFrame,
    k_min: int = fv.K_MIN,
    k_max: int = fv.K_MAX,
    n_init: int = fv.N_INIT,
    seed: int = fv.SAMPLE_SEED,
    vector_col: str = "embedding",
    id_col: str = "doc_id",
    max_steps: int = MAX_STEPS,
) -> Sweep:
    """Fit every k in ``k_min..k_max`` with restarts, score them, keep the best.

    Euclidean fit on the vectors as given, cosine silhouette over all rows. The
    seed fixes the starting centroids independently of the partitioning.
    """
    rows = materialize(
        df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(vector_col).cast("array<float>").alias("v")),
        "kmeans-rows",
    )
    # Read once per step: kept near the executors, read again from the files if one is lost.
    rows.persist()
    best = fit_models(rows, list(range(k_min, k_max + 1)), n_init, seed, max_steps)
    labelled = materialize(_label_all(rows, best), "kmeans-labels")
    rows.unpersist()
    spark = df.sparkSession
    found = [(k, score, best[k].settled) for k, score in _cosine_scores(labelled, best)]
    scores = spark.createDataFrame(found, "k int, silhouette double, settled boolean")
    winner = select_best_k(scores).first()
    k = winner["k"] if winner else min(best)
    place = sorted(best).index(k)
    labels = labelled.select("doc_id", F.get("labels", F.lit(place)).alias("cluster_kmeans"))
    centroids = spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(best[k].centroids)], "cluster_id int, centroid array<double>"
    )
    return Sweep(labels, winner["k"] if winner else None, winner["silhouette"] if winner else None, scores, centroids)
