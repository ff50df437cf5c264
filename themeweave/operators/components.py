"""Connected components of an edge table, as a loop of small Spark jobs.

Alternates two rewrites that keep components intact and pull every vertex
towards the smallest vertex of its component (Kiveris et al., "Connected
Components in MapReduce and Beyond", 2014). The number of rounds grows with the
logarithm of the component size, not with its diameter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..session import materialize


def _smallest_neighbor(directed: DataFrame, key: str) -> DataFrame:
    return directed.groupBy(key, "u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame, key: str) -> DataFrame:
    """Link every larger neighbour of a vertex to the smallest of its neighbourhood."""
    both = edges.unionByName(edges.select(key, F.col("v").alias("u"), F.col("u").alias("v")))
    # A hub is one row in the written table, so adaptive execution can split its edges on the other side.
    m = materialize(_smallest_neighbor(both, key).withColumn("m", F.least("m", "u")), "smallest")
    return both.where(F.col("v") > F.col("u")).join(m, [key, "u"]).select(key, F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(down: DataFrame, key: str) -> DataFrame:
    """Link a vertex and its smaller neighbours to the smallest of them. Edges point down."""
    m = _smallest_neighbor(down, key)
    moved = down.join(m, [key, "u"]).where(F.col("v") != F.col("m")).select(key, F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(m.select(key, "u", F.col("m").alias("v"))).distinct()


# Edges contracted at a time, which bounds what a task holds.
LOCAL_EDGES = 1 << 20


def contract(key: str, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(held)
    groups, u, v = (table.column(n).to_numpy() for n in (key, "u", "v"))
    vertices, place = np.unique(np.stack([np.tile(groups, 2), np.concatenate([u, v])]), axis=1, return_inverse=True)
    a, b = place.reshape(2, -1)
    # Vertices are sorted, so the smallest index of a component is its smallest vertex.
    root = np.arange(vertices.shape[1])
    while True:
        low = np.minimum(root[a], root[b])
        if (root[a] == root[b]).all():
            break
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (root[root] != root).any():
            root = root[root]
    moved = np.flatnonzero(root != np.arange(len(root)))
    return pa.RecordBatch.from_arrays(
        [pa.array(vertices[0][moved].astype(np.int32)), pa.array(vertices[1][moved]), pa.array(vertices[1][root[moved]])],
        names=[key, "u", "v"],
    )


def _local_stars(edges: DataFrame, key: str) -> DataFrame:
    """Contract the edges each task reads: every vertex linked to its smallest local peer.

    A map-side combine for connectivity. It leaves at most one edge per vertex
    and million edges, and saves the rounds that would be spent inside partitions.
    """

    def stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= LOCAL_EDGES:
                yield contract(key, held)
                held = []
        if any(map(len, held)):
            yield contract(key, held)

    return edges.mapInArrow(stars, f"{key} int, u long, v long")


def _written(edges: DataFrame, key: str) -> tuple[DataFrame, dict]:
    """The edges written out, with a fingerprint taken on the way.

    Counting a retried task twice could only cost one more round.
    """
    seen = Observation()
    marked = edges.observe(
        seen,
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"),
        F.sum(F.xxhash64(key, "u", "v").cast("decimal(38,0)")).alias("x"),
    )
    return materialize(marked, "edges"), seen.get


def connected_components(edges: DataFrame, key: str, max_rounds: int = 100) -> DataFrame:
    """(key, node, component) for every vertex of ``edges`` (key int, u, v).

    ``component`` is the smallest vertex of the component. Graphs with different
    ``key`` are independent and are solved by the same rounds. Each half of a
    round is written out: both use their input twice, and the lineage is cut.
    """
    plain = edges.where(F.col("u") != F.col("v")).select(key, "u", "v")
    current, mark = _written(_local_stars(plain, key).distinct(), key)
    for _ in range(max_rounds):
        # The large star leaves edges pointing down, whatever way they came.
        stars = materialize(_large_star(current, key), "stars")
        current, found = _written(_small_star(stars, key), key)
        if found == mark:
            break
        mark = found
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = current.select(key, F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return current.select(key, F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
