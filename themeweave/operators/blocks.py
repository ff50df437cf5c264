"""Bounded blocks of vectors, the unit of all exact pairwise work.

Neighbour search, Euclidean silhouettes and density clustering compare rows with
rows. They do it block against block: a block holds a bounded number of distinct
vectors and lies in a file (``tiles``), a task holds two blocks, and only per-row
results leave it - never the pairs themselves.

Blocks are made of vectors near a common pivot. The triangle inequality over
pivots then tells which pairs of blocks cannot matter, and those are never
formed. Equal vectors are folded into one weighted point beforehand, so a crowd
of copies costs as much as a single row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as vx
from ..session import materialize
from .tiles import write_tiles

BLOCK_ROWS = 2048
MAX_PIVOTS = 1024
FEW_BLOCKS = 64  # up to so many, blocks are kept as small as asked for
NEAR_PAIRS = 1 << 19  # products held at once while near rows are looked for
REFINE_ROWS = 1 << 16  # candidate pairs held at once while distances are made exact


def grown(block_rows: int, n_points: int) -> int:
    """Rows of a block: ``block_rows``, on large tables more, up to ``BLOCK_ROWS``.

    Pairs of blocks grow with the square of their number, and each has its fixed cost.
    """
    return max(block_rows, min(BLOCK_ROWS, math.ceil(n_points / FEW_BLOCKS)))


def exact_distances(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Distances from the difference vectors, which makes ties exact."""
    exact = np.empty(len(rows))
    for start in range(0, len(rows), REFINE_ROWS):
        part = slice(start, start + REFINE_ROWS)
        exact[part] = np.sqrt(((a[rows[part]] - b[cols[part]]) ** 2).sum(axis=1))
    return exact


def near_rows(a: np.ndarray, b: np.ndarray, limit: np.ndarray, kinds: tuple[np.ndarray, np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, ...]]:
    """(rows, cols, distances) of all pairs not farther apart than ``limit`` of the row, by slices of rows of ``a``.

    ``limit`` may shrink between slices. With ``kinds`` only pairs of different kinds count.
    A product in single precision finds candidates up to a bound on its error, around
    the middle of ``b``; their distances are then taken from the difference vectors.
    """
    if not len(a) or not len(b):
        return
    middle = b.mean(axis=0)
    x, y = a - middle, b - middle
    norms_x, norms_y = (x**2).sum(axis=1), (y**2).sum(axis=1)
    most = norms_y.max()
    kind = np.float32 if max(norms_x.max(), most) < 1e30 else np.float64
    slack = 2.0 * (a.shape[1] + 8) * float(np.finfo(kind).eps)
    left = np.concatenate([x, norms_x[:, None], np.ones((len(x), 1))], axis=1).astype(kind)
    right = np.ascontiguousarray(np.concatenate([-2.0 * y, np.ones((len(y), 1)), norms_y[:, None]], axis=1).astype(kind).T)
    step = max(1, NEAR_PAIRS // len(b))
    for start in range(0, len(a), step):
        part = slice(start, start + step)
        bound = limit[part].astype(np.float64) ** 2 + slack * (1e-30 + limit[part] ** 2 + norms_x[part] + most)
        close = left[part] @ right <= bound.astype(kind)[:, None]
        if kinds is not None:
            close &= kinds[0][part, None] != kinds[1][None, :]
        rows, cols = np.divmod(np.flatnonzero(close), len(b))
        rows += start
        gaps = exact_distances(a, b, rows, cols)
        keep = gaps <= limit[rows]
        yield rows[keep], cols[keep], gaps[keep]


@dataclass
class Points:
    """Distinct vectors and the rows that carry them.

    ``distinct``: (rep, weight, v) with ``rep`` the smallest row id of the copies.
    ``members``: (id, rep), one row per input row.
    """

    distinct: DataFrame
    members: DataFrame
    n_distinct: int
    n_rows: int

    @property
    def has_copies(self) -> bool:
        return self.n_distinct < self.n_rows


def fold_copies(df: DataFrame, vector_col: str = "embedding", id_col: str = "doc_id") -> Points:
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"))
    distinct = materialize(
        rows.groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("weight")), "distinct"
    )
    size = distinct.agg(F.count(F.lit(1)).alias("d"), F.coalesce(F.sum("weight"), F.lit(0)).alias("n")).first()
    if size["d"] == size["n"]:
        members = distinct.select(F.col("rep").alias("id"), "rep")
    else:
        members = rows.join(distinct.select("v", "rep"), "v").select("id", "rep")
    return Points(distinct, members, size["d"], size["n"])


@dataclass
class Blocks:
    """``packed``: (name, block, pivot, radius, size, and the largest ``core`` and ``asked`` if the points have them).

    ``folder`` has the rows of each block under its name, ``pivots`` the pivot rows
    themselves, ``pivot_distances`` what lies between them.
    """

    packed: DataFrame
    folder: str
    pivots: list
    pivot_distances: np.ndarray
    count: int

    def _meetings(self, reach: DataFrame, bridges: np.ndarray, both: bool, ceiling: float) -> DataFrame:
        """Blocks with the blocks of pivots that may matter: (a, ra, reach_a, b, rb, reach_b, gap, bridge).

        Pairs of pivots are ruled out first, by the largest radius and reach of
        their blocks; there are at most MAX_PIVOTS pivots. Only blocks of the pairs
        that are left meet, by an explode over the pivot's list and an equality join.
        With ``both`` either side's reach counts, else that of ``a`` alone.
        """
        summary = self.packed.select("block", "pivot", "radius").join(reach, "block")
        radius, far = np.full((2, len(self.pivots)), -np.inf)
        for row in summary.groupBy("pivot").agg(F.max("radius").alias("radius"), F.max("reach").alias("reach")).collect():
            radius[row["pivot"]], far[row["pivot"]] = row["radius"], row["reach"]
        limit = np.maximum(np.maximum(far[:, None], far[None, :]), bridges) if both else np.repeat(far[:, None], len(far), axis=1)
        gap = self.pivot_distances
        known = np.isfinite(radius)
        near = gap - np.where(known, radius, 0)[:, None] - np.where(known, radius, 0)[None, :] <= np.minimum(limit, ceiling) + 1e-6 * (1 + gap)
        near &= known[:, None] & known[None, :]
        lists = [
            (i, [(int(j), float(gap[i, j]), float(bridges[i, j])) for j in np.flatnonzero(near[i])])
            for i in range(len(gap))
        ]
        table = self.packed.sparkSession.createDataFrame(
            lists, "pivot int, others array<struct<pivot:int, gap:double, bridge:double>>"
        )
        left = (
            summary.join(table, "pivot")
            .select(F.col("block").alias("a"), F.col("radius").alias("ra"), F.col("reach").alias("reach_a"), F.inline("others"))
        )
        right = summary.select(F.col("block").alias("b"), F.col("radius").alias("rb"), F.col("reach").alias("reach_b"), "pivot")
        return left.join(right, "pivot")

    def pairs_from(self, reach: DataFrame) -> DataFrame:
        """Ordered pairs (a, b): rows of ``a`` may have something in ``b`` within the reach of ``a``.

        ``reach`` has one row (block, reach) per block.
        """
        met = self._meetings(reach, np.zeros_like(self.pivot_distances), both=False, ceiling=float("inf"))
        return _named(met.where((F.col("a") != F.col("b")) & _may_touch(F.col("reach_a"))))

    def pairs_between(self, reach: DataFrame, bridges: np.ndarray, ceiling: float) -> DataFrame:
        """Unordered pairs (a, b) closer than what either reaches and the bridge between their pivots,
        and closer than ``ceiling``."""
        limit = F.least(F.greatest("reach_a", "reach_b", "bridge"), F.lit(float(ceiling)))
        met = self._meetings(reach, bridges, both=True, ceiling=float(ceiling))
        return _named(met.where((F.col("a") < F.col("b")) & _may_touch(limit)))

    def each(self) -> DataFrame:
        """Every block with itself."""
        return self.packed.select(F.col("name").alias("a"), F.col("name").alias("b"))


def _named(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").cast("string").alias("a"), F.col("b").cast("string").alias("b"))


def _may_touch(limit: Column) -> Column:
    """Whether two blocks can hold rows within ``limit``, by the triangle inequality.

    Some slack keeps rounding from ever dropping a pair on the edge.
    """
    return F.col("gap") - F.col("ra") - F.col("rb") <= limit + 1e-6 * (1 + F.col("gap"))


def _assign_pivots(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    norms = (pivots**2).sum(axis=1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = vx.to_matrix(batch.column("v"))
            nearest = (norms - 2.0 * (x @ pivots.T)).argmin(axis=1)
            gap = np.sqrt(((x - pivots[nearest]) ** 2).sum(axis=1))
            columns = [batch.column(n) for n in batch.schema.names]
            columns += [pa.array(nearest.astype(np.int32)), pa.array(gap)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "pivot", "gap"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in points.schema.fields)
    return points.mapInArrow(scan, f"{fields}, pivot int, gap double")


def build_blocks(points: DataFrame, n_points: int, block_rows: int = BLOCK_ROWS) -> Blocks:
    """Pack (rep, v, ...) rows into blocks of about ``block_rows``, or more on large tables (``grown``).

    Pivots are rows drawn in hash order. A pivot with many rows gets as many
    blocks as its count asks for, so no block grows with its neighbourhood.
    """
    block_rows = grown(block_rows, n_points)
    n_pivots = max(1, min(MAX_PIVOTS, math.ceil(n_points / block_rows)))
    drawn = points.orderBy(F.xxhash64("rep"), "rep").limit(n_pivots).collect()
    pivots = np.array([row["v"] for row in drawn], dtype=np.float64)
    placed = _assign_pivots(points, pivots)
    sizes = (
        placed.groupBy("pivot")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("pivot", F.ceil(F.col("n") / block_rows).alias("parts"))
    )
    others = [name for name in points.columns if name != "rep"]
    rows = F.sort_array(F.collect_list(F.struct("rep", *others)))
    most = [F.max(name).alias(name) for name in ("core", "asked") if name in others]
    block = (F.col("part") * MAX_PIVOTS + F.col("pivot")).alias("block")
    packed = (
        placed.join(F.broadcast(sizes), "pivot")  # one row per pivot, MAX_PIVOTS at most
        .withColumn("part", F.pmod(F.xxhash64("rep"), F.col("parts")))
        .groupBy("pivot", "part")
        .agg(F.max("gap").alias("radius"), F.count(F.lit(1)).alias("size"), *most, rows.alias("rows"))
        .select(block, "*")
        .withColumn("name", F.col("block").cast("string"))
        .drop("part")
    )
    written, folder = write_tiles(packed, "blocks")
    return Blocks(written, folder, drawn, _distances(pivots), written.count())


def _distances(x: np.ndarray) -> np.ndarray:
    norms = (x**2).sum(axis=1)
    return np.sqrt(np.maximum(norms[:, None] + norms[None, :] - 2.0 * (x @ x.T), 0.0))
