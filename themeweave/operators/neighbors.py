"""Exact k-nearest neighbours and core distances."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from . import blocks as bl
from .tiles import Tile, over_pairs, over_runs

FOUND = "rep long, nbr long, d double"
FOUND_ARROW = pa.schema([("rep", pa.int64()), ("nbr", pa.int64()), ("d", pa.float64())])


def _nearest_in(left: dict, right: dict, k: int, same: bool) -> pa.Table:
    """For each left row its k nearest right rows, by (distance, id).

    A matrix product finds candidates up to its rounding error; their distances
    are then taken from the difference vectors, which makes ties exact.
    """
    a, b = left["v"], right["v"]
    norms_a, norms_b = (a**2).sum(axis=1), (b**2).sum(axis=1)
    squared = norms_a[:, None] + norms_b[None, :] - 2.0 * (a @ b.T)
    if same:
        np.fill_diagonal(squared, np.inf)
    if b.shape[0] > k:
        limit = np.partition(squared, k - 1, axis=1)[:, k - 1 : k]
        slack = 1e-9 * (1.0 + norms_a[:, None] + norms_b.max(initial=0.0))
        rows, cols = np.nonzero(squared <= limit + slack)
    else:
        rows, cols = np.nonzero(np.isfinite(squared))
    found = _closest(rows, right["rep"][cols], bl.exact_distances(a, b, rows, cols), k)
    return pa.table([left["rep"][found[0]], *found[1:]], schema=FOUND_ARROW)


def _closest(rows: np.ndarray, nbr: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k nearest of each row, by (distance, id)."""
    order = np.lexsort((nbr, d, rows))
    rows, nbr, d = rows[order], nbr[order], d[order]
    keep = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
    return rows[keep], nbr[keep], d[keep]


def _kth_bound(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """What the k-th nearest row of ``b`` is not farther than, for each row of ``a``."""
    if len(b) < k:
        return np.full(len(a), np.inf)
    norms_a, norms_b = (a**2).sum(axis=1), (b**2).sum(axis=1)
    squared = np.partition(norms_a[:, None] + norms_b[None, :] - 2.0 * (a @ b.T), k - 1, axis=1)[:, k - 1]
    return np.sqrt(np.maximum(squared, 0.0) + 1e-9 * (1.0 + norms_a + norms_b.max(initial=0.0)))


def _nearest_of_run(left: Tile, rights: Iterator[tuple[str, Tile]], k: int) -> pa.Table:
    """For each left row its k nearest rows of all the right blocks, as far as they are not beyond its k nearest in its own block."""
    n = len(left["rep"])
    limit = np.full(n, np.inf)
    if n > k:
        limit = _nearest_in(left, left, k, same=True).column("d").to_numpy().reshape(n, k)[:, -1].copy()
    held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    for _, right in rights:
        unbounded = np.flatnonzero(np.isinf(limit))
        if len(unbounded):
            limit[unbounded] = _kth_bound(left["v"][unbounded], right["v"], k)
        found = [(rows, right["rep"][cols], d) for rows, cols, d in bl.near_rows(left["v"], right["v"], limit)]
        if not any(len(rows) for rows, *_ in found):
            continue
        held = _closest(*(np.concatenate(c) for c in zip(held, *found)), k)
        count = np.bincount(held[0], minlength=n)
        full = np.flatnonzero(count == k)
        limit[full] = np.minimum(limit[full], held[2][np.cumsum(count)[full] - 1])
    return pa.table([left["rep"][held[0]], *held[1:]], schema=FOUND_ARROW)


def _best(found: DataFrame, key: str, other: str, k: int) -> DataFrame:
    closest = Window.partitionBy(key).orderBy("d", other)
    return found.withColumn("rank", F.row_number().over(closest)).where(F.col("rank") <= k)


def _distinct_neighbors(blocks: bl.Blocks, k: int) -> DataFrame:
    """(rep, nbr, d, rank) among distinct vectors."""

    def within(rows: Tile, _: Tile, name: str, __: str) -> pa.Table:
        found = _nearest_in(rows, rows, k, same=True)
        return found.append_column("block", pa.array([int(name)] * len(found), pa.int64()))

    def between(left: Tile, _: str, rights: Iterator[tuple[str, Tile]]) -> Iterator[pa.Table]:
        yield _nearest_of_run(left, rights, k)

    own = materialize(over_pairs(blocks.each(), blocks.folder, within, f"{FOUND}, block long"), "knn-own")
    # A row's k-th distance inside its block bounds how far it needs to look. A block of k rows or fewer has no bound.
    known = own.groupBy("block").agg(F.max("d").alias("far"))
    reach = blocks.packed.join(known, "block", "left").select(
        "block", F.when(F.col("size") > k, F.col("far")).otherwise(F.lit(float("inf"))).alias("reach")
    )
    others = over_runs(blocks.pairs_from(reach), blocks.folder, between, FOUND)
    own = own.select("rep", "nbr", "d")
    return _best(own.unionByName(others), "rep", "nbr", k)


def knn_graph(df: DataFrame, k: int, vector_col: str = "embedding", id_col: str = "doc_id", block_rows: int = bl.BLOCK_ROWS) -> DataFrame:
    """(doc_id, neighbor_id, distance, rank): the k nearest rows by Euclidean distance.

    Exact, ties to the smaller id. Distance work is quadratic in the number of
    distinct vectors minus the block pairs that the pivot bounds rule out.
    """
    points = bl.fold_copies(df, vector_col, id_col)
    return _expand(points, knn_points(points, k, block_rows), k)


def knn_points(points: bl.Points, k: int, block_rows: int) -> DataFrame:
    if points.n_distinct == 0:
        return points.distinct.sparkSession.createDataFrame([], f"{FOUND}, rank int")
    blocks = bl.build_blocks(points.distinct.select("rep", "v"), points.n_distinct, block_rows)
    return materialize(_distinct_neighbors(blocks, k), "knn")


def _expand(points: bl.Points, found: DataFrame, k: int) -> DataFrame:
    """From distinct vectors back to rows: copies are each other's neighbours at distance 0."""
    if not points.has_copies:
        return found.select(F.col("rep").alias("doc_id"), F.col("nbr").alias("neighbor_id"), F.col("d").alias("distance"), "rank")
    # k + 1 copies are enough to fill any list, one's own id left out.
    first_copies = _first_copies(points, k + 1)
    at_zero = points.distinct.where("weight > 1").select("rep", F.col("rep").alias("nbr"), F.lit(0.0).cast("double").alias("d"))
    candidates = (
        found.select("rep", "nbr", "d")
        .unionByName(at_zero)
        .join(first_copies, "nbr")
        .select("rep", "neighbor_id", "d")
    )
    lists = _best(candidates, "rep", "neighbor_id", k + 1).drop("rank")
    per_row = points.members.join(lists, "rep").where(F.col("id") != F.col("neighbor_id"))
    return _best(per_row, "id", "neighbor_id", k).select(
        F.col("id").alias("doc_id"), "neighbor_id", F.col("d").alias("distance"), "rank"
    )


def _first_copies(points: bl.Points, n: int) -> DataFrame:
    place = F.row_number().over(Window.partitionBy("rep").orderBy("id"))
    ranked = points.members.withColumn("place", place).where(F.col("place") <= n)
    return ranked.select(F.col("rep").alias("nbr"), F.col("id").alias("neighbor_id"))


def core_distance(df: DataFrame, min_samples: int, vector_col: str = "embedding", id_col: str = "doc_id", block_rows: int = bl.BLOCK_ROWS) -> DataFrame:
    """(doc_id, core_distance): distance to the ``min_samples``-th neighbour, self left out.

    With fewer other rows than that, the farthest of them counts.
    """
    graph = knn_graph(df, min_samples, vector_col, id_col, block_rows)
    return graph.groupBy("doc_id").agg(F.max("distance").alias("core_distance"))


def point_core_distances(points: bl.Points, min_samples: int, block_rows: int) -> DataFrame:
    """(rep, core): all copies of a vector share one core distance."""
    return cores_of(points, knn_points(points, min_samples, block_rows), min_samples)


def cores_of(points: bl.Points, found: DataFrame, min_samples: int) -> DataFrame:
    """(rep, core) from the ``min_samples`` nearest distinct vectors of each."""
    if not points.has_copies:
        return found.groupBy("rep").agg(F.max("d").alias("core"))
    weights = points.distinct.select(F.col("rep").alias("nbr"), "weight")
    copies = points.distinct.select("rep", F.lit(0.0).cast("double").alias("d"), (F.col("weight") - 1).alias("weight"))
    steps = found.join(weights, "nbr").select("rep", "d", "weight").unionByName(copies)
    reached = F.sum("weight").over(Window.partitionBy("rep").orderBy("d").rowsBetween(Window.unboundedPreceding, -1))
    # Every row on the way that starts before min_samples copies are passed.
    needed = steps.where("weight > 0").withColumn("before", F.coalesce(reached, F.lit(0))).where(F.col("before") < min_samples)
    return needed.groupBy("rep").agg(F.max("d").alias("core"))
