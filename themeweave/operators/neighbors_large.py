"""Nearest neighbours of large tables: close to exact, at a cost that grows with the rows.

Lists of k neighbours start from the rows that share a block or a leaf of a random
projection tree, and are improved by neighbour descent: rows that are neighbours of one
row are likely neighbours of each other (Dong et al., "Efficient K-Nearest Neighbor
Graph Construction for Generic Similarity Measures", 2011). Per round and row there are
at most 2k candidates and their pairs; what is shuffled are ids and distances. Vectors
stay in the files of their blocks, where workers look them up; blocks hold near rows, so
few files are touched.

The trees' planes are fitted on a bounded sample of rows (``SAMPLE``); all rows are sent
down the trees. A leaf of more than ``LEAF`` rows is dealt into parts, which loses pairs
between the parts to that tree, but not to the descent. Every reported distance is exact.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import blocks as bl
from .neighbors import FOUND, _best, _expand, _nearest_in
from .tiles import Tile, loaded, over_pairs, read_tile

SAMPLE = 20_000
LEAF = 256
PLACE = 24  # bits of a node that say which row of its block it is


def _block_of(nodes: np.ndarray) -> np.ndarray:
    return nodes >> PLACE


def vectors_of(folder: str, nodes: np.ndarray) -> np.ndarray:
    """Vectors of sorted nodes, read from the files of their blocks."""
    blocks, starts = np.unique(_block_of(nodes), return_index=True)
    parts = [
        read_tile(folder, str(block))["v"][nodes[a:b] & ((1 << PLACE) - 1)].astype(np.float64)
        for block, a, b in zip(blocks.tolist(), starts.tolist(), [*starts[1:].tolist(), len(nodes)])
    ]
    return np.concatenate(parts)


# Trees


def _grow(rows: np.ndarray, depth: int, rng: np.random.Generator) -> list[tuple[np.ndarray, float] | None]:
    """Planes of a binary tree, children of node i at 2i + 1 and 2i + 2; each halves its sample rows."""
    planes: list[tuple[np.ndarray, float] | None] = [None] * ((1 << depth) - 1)
    open_ = [(0, np.arange(len(rows)))]
    while open_:
        node, some = open_.pop()
        if node >= len(planes):
            continue
        pair = rows[rng.choice(some, 2)] if len(some) > 1 else np.zeros((2, rows.shape[1]))
        normal = pair[0] - pair[1]
        if not normal.any():
            normal = rng.normal(size=rows.shape[1])
        height = rows[some] @ normal
        middle = float(np.median(height)) if len(some) else 0.0
        planes[node] = (normal, middle)
        open_ += [(2 * node + 1, some[height <= middle]), (2 * node + 2, some[height > middle])]
    return planes


def _leaves(x: np.ndarray, planes: list, depth: int) -> np.ndarray:
    node = np.zeros(len(x), np.int64)
    for _ in range(depth):
        for at in np.unique(node).tolist():
            here = node == at
            normal, middle = planes[at]
            node[here] = 2 * at + 1 + (x[here] @ normal > middle)
    return node


def _tree_leaves(blocks: bl.Blocks, sample: np.ndarray, n: int, trees: int, seed: int) -> DataFrame:
    """(tree, leaf, node) of all rows."""
    depth = max(0, min(math.ceil(math.log2(max(1, n / LEAF))), int(math.log2(max(1, len(sample) / 4)))))
    forest = [_grow(sample, depth, np.random.default_rng([seed, t])) for t in range(trees)]
    folder = blocks.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                x = loaded(folder, name)["v"]
                nodes = (int(name) << PLACE) + np.arange(len(x))
                for tree, planes in enumerate(forest):
                    leaf = _leaves(x, planes, depth)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), tree)), pa.array(leaf), pa.array(nodes)], names=["tree", "leaf", "node"])

    return blocks.packed.select("name").mapInArrow(run, "tree long, leaf long, node long")


NODES = FOUND.replace("rep", "node")


def _starting_lists(blocks: bl.Blocks, sample: np.ndarray, n: int, k: int, trees: int, seed: int) -> DataFrame:
    folder = blocks.folder

    def in_block(rows: Tile, _: Tile, name: str, __: str) -> pa.Table:
        nodes = (int(name) << PLACE) + np.arange(len(rows["v"]))
        here = {"rep": nodes, "v": rows["v"]}
        return _nearest_in(here, here, k, same=True).rename_columns(["node", "nbr", "d"])

    def in_leaf(table: pa.Table) -> pa.Table:
        nodes = np.sort(table.column("node").to_numpy())
        here = {"rep": nodes, "v": vectors_of(folder, nodes)}
        return _nearest_in(here, here, k, same=True).rename_columns(["node", "nbr", "d"])

    leaves = materialize(_tree_leaves(blocks, sample, n, trees, seed), "leaves")
    sizes = leaves.groupBy("tree", "leaf").agg(F.ceil(F.count(F.lit(1)) / LEAF).alias("parts"))
    dealt = leaves.join(sizes, ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("node", "tree"), F.col("parts")))
    found = dealt.select("tree", "leaf", "part", "node").groupBy("tree", "leaf", "part").applyInArrow(in_leaf, NODES)
    return found.unionByName(over_pairs(blocks.each(), folder, in_block, NODES))


# Descent


def _improved(folder: str, u: np.ndarray, member: np.ndarray, far: np.ndarray, fresh: np.ndarray) -> tuple[np.ndarray, ...]:
    """Members of one row's surroundings that are nearer to each other than what they know: (node, nbr, d)."""
    nodes, at = np.unique(member, return_inverse=True)
    x = vectors_of(folder, nodes)
    ends = np.flatnonzero(np.diff(u, prepend=u[0] - 1, append=u[-1] + 1))
    left, right = [], []
    for a, b in zip(ends[:-1], ends[1:]):
        i, j = np.triu_indices(b - a, 1)
        new = fresh[a + i] | fresh[a + j]
        left.append(a + i[new])
        right.append(a + j[new])
    left, right = np.concatenate(left), np.concatenate(right)
    out = []
    for low in range(0, len(left), 1 << 16):
        i, j = left[low : low + (1 << 16)], right[low : low + (1 << 16)]
        d = np.sqrt(((x[at[i]] - x[at[j]]) ** 2).sum(axis=1))
        for one, other in ((i, j), (j, i)):
            near = (d < far[one]) & (member[one] != member[other])
            out.append((member[one][near], member[other][near], d[near]))
    return tuple(np.concatenate(c) for c in zip(*out)) if out else (u[:0], u[:0], far[:0])


def _descend(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []

    def worked(rows: pa.Table) -> pa.RecordBatch:
        found = _improved(folder, *(rows.column(c).to_numpy() for c in ("u", "member", "far", "fresh")))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in found], names=["node", "nbr", "d"])

    for batch in batches:  # sorted by u; the last u of a batch may go on in the next
        if not batch.num_rows:
            continue
        u = batch.column("u").to_numpy()
        last = int(np.searchsorted(u, u[-1]))
        if last:
            yield worked(pa.Table.from_batches([*held, batch.slice(0, last)]))
            held = []
        held.append(batch.slice(last))
    if held:
        yield worked(pa.Table.from_batches(held))


def _round(lists: DataFrame, folder: str, k: int) -> DataFrame:
    """Lists after one round; ``fresh`` marks what is new in them."""
    far = lists.groupBy("node").agg(F.count(F.lit(1)).alias("n"), F.max("d").alias("d"))
    far = far.select(F.col("node").alias("member"), F.when(F.col("n") < k, F.lit(float("inf"))).otherwise(F.col("d")).alias("far"))
    # of those that list a row the nearest k, so that no row has more candidates than that
    back = _best(lists.select(F.col("nbr").alias("u"), F.col("node").alias("member"), "d", "fresh"), "u", "member", k)
    around = lists.select(F.col("node").alias("u"), F.col("nbr").alias("member"), "fresh").unionByName(back.select("u", "member", "fresh"))
    around = around.groupBy("u", "member").agg(F.bool_or("fresh").alias("fresh"))
    dealt = around.join(far, "member").select("u", "member", "far", "fresh").repartition("u").sortWithinPartitions("u", "member")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _descend(folder, batches)

    found = dealt.mapInArrow(run, NODES).withColumn("fresh", F.lit(True))
    merged = lists.select("node", "nbr", "d", F.lit(False).alias("fresh")).unionByName(found)
    return _lists(merged.groupBy("node", "nbr").agg(F.min("d").alias("d"), F.bool_and("fresh").alias("fresh")), k)


def _lists(found: DataFrame, k: int) -> DataFrame:
    return materialize(_best(found, "node", "nbr", k).select("node", "nbr", "d", "fresh"), "lists")


def knn_graph_large(
    df: DataFrame,
    k: int,
    vector_col: str = "embedding",
    id_col: str = "doc_id",
    trees: int = 4,
    rounds: int = 8,
    settled: float = 0.001,
    seed: int = 42,
    block_rows: int = bl.BLOCK_ROWS,
) -> DataFrame:
    """(doc_id, neighbor_id, distance, rank): nearly all of the k nearest rows, nearest first.

    Rounds end when fewer than the share ``settled`` of the lists' entries change, or
    after ``rounds`` of them. Copies of a vector are folded first, as in ``knn_graph``.
    """
    points = bl.fold_copies(df, vector_col, id_col)
    if points.n_distinct == 0:
        return _expand(points, points.distinct.sparkSession.createDataFrame([], f"{FOUND}, rank int"), k)
    distinct = points.distinct.select("rep", "v")
    blocks = bl.build_blocks(distinct, points.n_distinct, block_rows)
    drawn = distinct.orderBy(F.xxhash64("rep"), "rep").limit(SAMPLE).select("v").collect()
    sample = np.array([r["v"] for r in drawn], dtype=np.float64)
    found = _starting_lists(blocks, sample, points.n_distinct, k, trees, seed)
    lists = _lists(found.groupBy("node", "nbr").agg(F.min("d").alias("d")).withColumn("fresh", F.lit(True)), k)
    for _ in range(rounds):
        lists = _round(lists, blocks.folder, k)
        if lists.where("fresh").count() <= settled * k * points.n_distinct:
            break
    return _expand(points, _named(lists, blocks.folder, k), k)


def _named(lists: DataFrame, folder: str, k: int) -> DataFrame:
    """Row ids for nodes."""

    def reps(nodes: np.ndarray) -> np.ndarray:
        different, at = np.unique(nodes, return_inverse=True)
        blocks, starts = np.unique(_block_of(different), return_index=True)
        out = [
            read_tile(folder, str(block))["rep"][different[a:b] & ((1 << PLACE) - 1)]
            for block, a, b in zip(blocks.tolist(), starts.tolist(), [*starts[1:].tolist(), len(different)])
        ]
        return np.concatenate(out)[at]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(reps(batch.column(c).to_numpy())) for c in ("node", "nbr")] + [batch.column("d")], names=["rep", "nbr", "d"]
                )

    return materialize(_best(lists.select("node", "nbr", "d").mapInArrow(run, FOUND), "rep", "nbr", k), "knn-large")
