"""Cluster centroids, nearest-centroid assignment and representatives."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors as vx
from ..functions import fixed_values as fv
from ..session import materialize
from .tiles import read_tile, write_tiles

CENTROIDS_PER_PASS = 1024  # in one file, on average
MAX_PIVOTS = 1024
ROWS_AT_ONCE = 4096  # rows compared with one file


def cluster_centroids(df: DataFrame, cluster_col: str, vector_col: str = "embedding") -> DataFrame:
    """(cluster_id, n_docs, centroid): the mean vector of each cluster.

    The summariser keeps one running vector per cluster in each partition, so
    only those are shuffled, whatever the size of a cluster.
    """
    as_vector = array_to_vector(F.col(vector_col).cast("array<double>"))
    return (
        df.groupBy(F.col(cluster_col).cast("int").alias("cluster_id"))
        .agg(Summarizer.mean(as_vector).alias("mean"), F.count(F.lit(1)).alias("n_docs"))
        .select("cluster_id", "n_docs", vector_to_array("mean").alias("centroid"))
    )


@dataclass
class CentroidLists:
    """Where the centroids lie: files by nearest pivot, which workers map. Its size is bounded by
    ``MAX_PIVOTS`` vectors and one number per ``CENTROIDS_PER_PASS`` centroids."""

    folder: str
    pivots: np.ndarray
    radius: np.ndarray  # greatest distance of a listed centroid from its pivot
    parts: list[list[int]]  # files of each list


def _gaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    squares = (x**2).sum(axis=1, keepdims=True) + (y**2).sum(axis=1) - 2.0 * (x @ y.T)
    return np.sqrt(np.maximum(squares, 0.0))


def centroid_lists(centroids: DataFrame) -> CentroidLists:
    """Write ``centroids`` (cluster_id, centroid) as lists by nearest pivot, each in files of bounded size."""
    rows = materialize(centroids.select(F.col("cluster_id").cast("int").alias("cluster_id"), F.col("centroid").cast("array<double>").alias("v")), "centroids")
    wanted = min(MAX_PIVOTS, -(-rows.count() // CENTROIDS_PER_PASS))
    chosen = rows.orderBy(F.xxhash64("cluster_id"), "cluster_id").limit(wanted).collect()
    if not chosen:
        return CentroidLists("", np.zeros((0, 0)), np.zeros(0), [])
    pivots = np.array([r["v"] for r in chosen], dtype=np.float64)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                gap = _gaps(vx.to_matrix(batch.column("v")), pivots)
                nearest = gap.argmin(axis=1)
                columns = [*batch.columns, pa.array(nearest.astype(np.int32)), pa.array(gap[np.arange(len(gap)), nearest])]
                yield pa.RecordBatch.from_arrays(columns, names=["cluster_id", "v", "list", "gap"])

    listed = materialize(rows.mapInArrow(near, "cluster_id int, v array<double>, list int, gap double"), "centroid-lists")
    sizes = {r["list"]: r for r in listed.groupBy("list").agg(F.count(F.lit(1)).alias("n"), F.max("gap").alias("radius")).collect()}
    files = [-(-sizes[k]["n"] // CENTROIDS_PER_PASS) if k in sizes else 1 for k in range(len(pivots))]
    part = F.pmod(F.xxhash64("cluster_id", "v"), F.get(F.lit(files), F.col("list"))).cast("int")
    packed = listed.groupBy("list", part.alias("part")).agg(F.collect_list(F.struct("cluster_id", "v")).alias("rows"))
    written, folder = write_tiles(packed.withColumn("name", F.concat_ws("-", "list", "part")), "centroid-files")
    parts = {r["list"]: sorted(r["parts"]) for r in written.groupBy("list").agg(F.collect_list("part").alias("parts")).collect()}
    radius = np.array([sizes[k]["radius"] if k in sizes else 0.0 for k in range(len(pivots))])
    return CentroidLists(folder, pivots, radius, [parts.get(k, []) for k in range(len(pivots))])


def _closest(x: np.ndarray, lists: CentroidLists) -> tuple[np.ndarray, np.ndarray]:
    """Id and distance of the nearest centroid of each row; of equally near ones the least id."""
    best_id, best = np.full(len(x), np.iinfo(np.int32).max, np.int32), np.full(len(x), np.inf)
    if not len(lists.pivots):
        return best_id, best
    squares = (x**2).sum(axis=1)
    gap = _gaps(x, lists.pivots)
    # No centroid of a list is nearer than this, rounding included.
    bound = gap - lists.radius * (1 + 1e-6) - 1e-6 * (1.0 + np.sqrt(squares))[:, None]

    def visit(number: int, rows: np.ndarray) -> None:
        for part in lists.parts[number]:
            tile = read_tile(lists.folder, f"{number}-{part}")
            ids, centres = tile["cluster_id"], tile["v"]
            norms = (centres**2).sum(axis=1)
            approx = norms - 2.0 * (x[rows] @ centres.T)
            # Ties within rounding are settled by exact distance, then by id.
            slack = 1e-9 * (1.0 + squares[rows, None] + norms.max())
            r, c = np.nonzero(approx <= approx.min(axis=1, keepdims=True) + slack)
            exact = np.sqrt(((x[rows[r]] - centres[c]) ** 2).sum(axis=1))
            order = np.lexsort((ids[c], exact, r))
            first = order[np.unique(r[order], return_index=True)[1]]
            found, distance = ids[c[first]], exact[first]
            better = (distance < best[rows]) | ((distance == best[rows]) & (found < best_id[rows]))
            best_id[rows[better]], best[rows[better]] = found[better], distance[better]

    own = gap.argmin(axis=1)
    for number in np.unique(own):
        visit(int(number), np.flatnonzero(own == number))
    for number in range(len(lists.pivots)):
        rows = np.flatnonzero((bound[:, number] <= best) & (own != number))
        if len(rows):
            visit(number, rows)
    return best_id, best


def nearest_centroid_assign(df: DataFrame, centroids: DataFrame, vector_col: str = "embedding") -> DataFrame:
    """Add ``nearest`` (cluster id) and ``distance`` (Euclidean) to each row.

    The rows are not shuffled, and no centroid passes through the plan: workers map
    lists of centroids by pivot, and leave out lists that the triangle inequality
    shows to be too far away. Without centroids the distance is infinite.
    """
    lists = centroid_lists(centroids)
    schema = T.StructType([*df.schema.fields, T.StructField("nearest", T.IntegerType()), T.StructField("distance", T.DoubleType())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                some = batch.slice(low, ROWS_AT_ONCE)
                ids, distance = _closest(vx.to_matrix(some.column(vector_col)), lists)
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(ids), pa.array(distance)], names=[*some.schema.names, "nearest", "distance"])

    return df.mapInArrow(scan, schema)


SALTS = 64  # parts a cluster is dealt into where its centroid has to be joined by a shuffle


def with_own_centroid(members: DataFrame, centres: DataFrame) -> DataFrame:
    """``members`` (cluster_id, doc_id, ...) with the ``centroid`` of their cluster.

    The centroids are written out, so the join knows their true size: few are
    broadcast, and nothing is shuffled. For more, every centroid is repeated per
    salt, so that a giant cluster is dealt to many tasks.
    """
    salted = materialize(centres, "centroids").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    spread = members.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    return spread.join(salted, ["cluster_id", "salt"]).drop("salt")


def nearest_to_centroid(df: DataFrame, cluster_col: str, n: int = 5, vector_col: str = "embedding") -> DataFrame:
    """The ``n`` rows of each cluster closest to its centroid by cosine distance.

    Only ids, vectors and centroids meet here; join texts to the few rows that
    come out. Noise has no centroid.
    """
    members = df.where(F.col(cluster_col) != fv.NOISE).select(
        F.col(cluster_col).cast("int").alias("cluster_id"), "doc_id", vector_col
    )
    centres = cluster_centroids(members, "cluster_id", vector_col).select("cluster_id", "centroid")
    scored = with_own_centroid(members, centres).select(
        "cluster_id",
        "doc_id",
        (F.lit(1.0).cast("double") - vx.cosine_similarity(F.col(vector_col), F.col("centroid"))).alias("distance"),
    )
    # Rounding first makes equal distances equal on any partitioning.
    closest = Window.partitionBy("cluster_id").orderBy(F.round("distance", 9), "doc_id")
    return scored.withColumn("rk", F.row_number().over(closest)).where(F.col("rk") <= n)
