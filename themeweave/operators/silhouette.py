"""Mean silhouettes: cosine in linear time, Euclidean exactly by blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..functions import vectors as vx
from ..session import materialize
from . import blocks as bl
from .tiles import Tile, loaded, over_runs, write_tiles

# Cluster statistics are shipped to the workers only below this size.
STATS_BYTES = 64 << 20
SLICE = 1 << 17  # distances held at once


def silhouette_cosine(df: DataFrame, cluster_col: str, vector_col: str = "embedding") -> float | None:
    """Mean cosine silhouette over all rows; None with fewer than two clusters.

    Cosine distances to a cluster add up to a product with its summed unit
    vectors, so this takes two passes and no pairs.
    """
    rows = df.select(
        F.col(cluster_col).cast("int").alias("prediction"),
        array_to_vector(F.col(vector_col).cast("array<double>")).alias("features"),
    )
    if rows.select("prediction").distinct().limit(2).count() < 2:
        return None
    return ClusteringEvaluator(distanceMeasure="cosine").evaluate(rows)


LEAST_ASKED = 30  # distinct vectors of a cluster that a sample asks, on average at least


def silhouette_euclidean(
    df: DataFrame,
    cluster_col: str,
    vector_col: str = "embedding",
    id_col: str = "doc_id",
    block_rows: int = bl.BLOCK_ROWS,
    sample_fraction: float = 1.0,
) -> DataFrame:
    """One row: ``silhouette``, the mean over rows that are not noise, its ``standard_error``, and how many vectors were ``asked``.

    ``sample_fraction`` asks only so many of each cluster's distinct vectors, drawn by
    the digest of their id and ``LEAST_ASKED`` of a cluster at least on average; each
    of them is still measured against all rows. Clusters count by their true sizes.
    At 1 the value is exact and the error 0.

    Null unless there are at least two clusters. Mean Euclidean distances have
    no closed form, so a row is measured against its own cluster and against
    every cluster that can be its nearest other one. Which those are follows
    from bounds on the mean distance m to a cluster with centroid c:
    ``|x - c| <= m <= sqrt(mean |x - y|^2)``, both of which need no pairs.
    """
    spark = df.sparkSession
    points = materialize(
        df.where(F.col(cluster_col) != fv.NOISE)
        .groupBy(F.col(cluster_col).cast("long").alias("c"), F.col(vector_col).alias("v"))
        .agg(F.min(id_col).cast("long").alias("rep"), F.count(F.lit(1)).cast("double").alias("weight")),
        "silhouette-points",
    )
    as_vector = array_to_vector(F.col("v").cast("array<double>"))
    stats = materialize(
        points.groupBy("c")
        .agg(
            Summarizer.mean(as_vector, F.col("weight")).alias("mean"),
            F.sum("weight").alias("size"),
            F.count(F.lit(1)).alias("n_points"),
            F.sum(F.col("weight") * vx.squared_norm(F.col("v"))).alias("norm2"),
        )
        .select("c", "size", "n_points", "norm2", vector_to_array("mean").alias("mean")),
        "silhouette-clusters",
    )
    shape = stats.agg(F.count(F.lit(1)).alias("k"), F.max(F.size("mean")).alias("d"), F.sum("n_points").alias("n")).first()
    if shape["k"] < 2:
        return spark.createDataFrame([(None, None, 0)], "silhouette double, standard_error double, asked long")

    parts = F.ceil(F.col("n_points") / bl.grown(block_rows, shape["n"]))
    drawn = F.conv(F.substring(F.md5(F.col("rep").cast("string")), 1, 8), 16, 10).cast("double") / 2.0**32
    share = F.greatest(F.lit(float(sample_fraction)), LEAST_ASKED / F.col("n_points"))
    packed, folder = write_tiles(
        points.join(stats.select("c", parts.alias("parts"), share.alias("share")), "c")
        .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")))
        .withColumn("asked", (drawn < F.col("share")).cast("int"))
        .groupBy("c", "part")
        .agg(F.sort_array(F.collect_list(F.struct("rep", "weight", "asked", "v"))).alias("rows"))
        .withColumn("name", F.concat_ws(".", "c", "part")),
        "silhouette-blocks",
    )
    wanted = _candidate_clusters(packed, folder, stats, max(2, STATS_BYTES // (8 * (shape["d"] + 3))))
    pairs = wanted.join(packed.select(F.col("c").alias("other"), F.col("name").alias("b")), "other")
    sums = _distance_sums(pairs, folder).groupBy("c", "rep", "other").agg(F.sum("total").alias("total"))

    sizes = stats.select(F.col("c").alias("other"), "size")
    means = sums.join(sizes, "other")
    own = F.col("c") == F.col("other")
    per_point = means.groupBy("c", "rep").agg(
        F.max(F.when(own & (F.col("size") > 1), F.col("total") / (F.col("size") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("size"))).alias("b"),
    )
    # A row alone in its cluster (a is null) and coinciding rows score 0.
    larger = F.greatest("a", "b")
    score = F.when(F.col("a").isNotNull() & (larger > 0), (F.col("b") - F.col("a")) / larger).otherwise(F.lit(0.0))
    weighted = per_point.select("c", "rep", score.alias("s")).join(points.select("c", "rep", "weight"), ["c", "rep"])
    w, s = F.col("weight"), F.col("s")
    moments = weighted.groupBy("c").agg(
        F.count(F.lit(1)).alias("m"), F.sum(w).alias("w"), F.sum(w * s).alias("ws"), F.sum(w * w).alias("ww"), F.sum(w * w * s).alias("wws"), F.sum(w * w * s * s).alias("wwss")
    )
    ratio = F.col("ws") / F.col("w")
    # spread of weight * (score - mean) within a cluster, for the part of it that was not asked
    squares = F.greatest(F.lit(0.0), F.col("wwss") - 2 * ratio * F.col("wws") + ratio * ratio * F.col("ww"))
    unasked = 1 - F.col("m") / F.col("n_points")
    variance = F.when(F.col("m") > 1, unasked * F.col("m") * squares / (F.col("m") - 1) / (F.col("w") * F.col("w"))).otherwise(F.lit(0.0))
    by_cluster = moments.join(stats.select("c", "size", "n_points"), "c")
    total = F.sum("size")
    return by_cluster.agg(
        (F.sum(ratio * F.col("size")) / total).alias("silhouette"),
        (F.sqrt(F.sum(variance * F.col("size") * F.col("size"))) / total).alias("standard_error"),
        F.sum("m").alias("asked"),
    )


def _candidate_clusters(packed: DataFrame, folder: str, stats: DataFrame, per_pass: int) -> DataFrame:
    """(a, other): the clusters whose exact distances the asked rows of a block need.

    Cluster statistics are shipped ``per_pass`` at a time. Bounds taken within
    one pass are looser than over all clusters, so the union of the passes may
    name too many clusters but never too few.
    """
    found, chunk = None, []
    for row in stats.orderBy("c").toLocalIterator():
        chunk.append(row)
        if len(chunk) == per_pass:
            found, chunk = _add_candidates(found, packed, folder, chunk), []
    return _add_candidates(found, packed, folder, chunk) if chunk else found


def _add_candidates(found: DataFrame | None, packed: DataFrame, folder: str, rows: list) -> DataFrame:
    ids = np.array([r["c"] for r in rows], dtype=np.int64)
    means = np.array([r["mean"] for r in rows], dtype=np.float64)
    spread = np.array([r["norm2"] / r["size"] for r in rows]) - (means**2).sum(axis=1)
    mean_norms = (means**2).sum(axis=1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, own in zip(batch.column("name").to_pylist(), batch.column("c").to_pylist()):
                tile = loaded(folder, name)
                x = tile["v"][tile["asked"] > 0]
                if not len(x):
                    continue
                to_mean = (x**2).sum(axis=1)[:, None] + mean_norms[None, :] - 2.0 * (x @ means.T)
                to_mean = np.maximum(to_mean, 0.0)
                lower, upper = np.sqrt(to_mean), np.sqrt(np.maximum(to_mean + spread[None, :], 0.0))
                upper[:, ids == own] = np.inf
                possible = (lower <= upper.min(axis=1, keepdims=True) + 1e-6 * (1.0 + lower)).any(axis=0)
                possible[ids == own] = True
                others = ids[possible]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(others)), pa.array(others)], names=["a", "other"])

    here = packed.select("name", "c").mapInArrow(scan, "a string, other long")
    return here if found is None else found.unionByName(here)


def _distance_sums(pairs: DataFrame, folder: str) -> DataFrame:
    """(c, rep, other, total): distances from each asked row to the rows of blocks of ``other``, summed.

    A task sends one sum per row and cluster, however many of the cluster's blocks it met.
    """

    def measure(left: Tile, own: str, rights: Iterator[tuple[str, Tile]]) -> Iterator[pa.Table]:
        asked = left["asked"] > 0
        a, rep = left["v"][asked], left["rep"][asked]
        norms = (a**2).sum(axis=1)
        a_side = np.concatenate([a, norms[:, None], np.ones((len(a), 1))], axis=1)
        totals: dict[int, np.ndarray] = {}
        for name, right in rights:
            other = int(name.split(".")[0])
            if other not in totals:
                totals[other] = np.zeros(len(a))
            totals[other] += _summed(a, norms, a_side, right)
        for other, total in totals.items():
            c = np.full(len(a), int(own.split(".")[0]))
            yield pa.table({"c": c, "rep": rep, "other": np.full(len(a), other), "total": total})

    return over_runs(pairs, folder, measure, "c long, rep long, other long, total double")


def _summed(a: np.ndarray, norms: np.ndarray, a_side: np.ndarray, right: Tile) -> np.ndarray:
    """Weighted distances to all rows of a block, by slices that stay near the processor."""
    b, weight = right["v"], right["weight"]
    b_side = np.ascontiguousarray(np.concatenate([-2.0 * b, np.ones((len(b), 1)), (b**2).sum(axis=1)[:, None]], axis=1).T)
    totals = np.empty(len(a))
    step = max(1, SLICE // len(b))
    for start in range(0, len(a), step):
        part = slice(start, start + step)
        distances = a_side[part] @ b_side
        # Where the product cancels, near-equal rows are measured directly.
        close = np.flatnonzero(distances <= 1e-6 * (1.0 + norms[part, None]))
        np.maximum(distances, 0.0, out=distances)
        np.sqrt(distances, out=distances)
        r, c = np.divmod(close, len(b))
        distances[r, c] = bl.exact_distances(a, b, r + start, c)
        totals[part] = distances @ weight
    return totals
