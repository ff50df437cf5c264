"""Density clustering on the mutual-reachability graph.

Two rows are linked at level eps if ``max(core_i, core_j, distance) <= eps``;
clusters are the connected components of ``min_cluster_size`` rows or more.

The graph is never listed. At one level, the lists of nearest neighbours connect
most rows already; only rows outside the largest component so far look for links to
other components. For all levels, the minimum spanning forest is grown by rounds of
Boruvka over pairs of blocks: in each round the components but the largest look for
their least edge to another one, within what the lists offer, and rows whose core
distance is above that do not look at all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import fixed_values as fv
from ..session import materialize
from . import blocks as bl
from .components import connected_components, contract
from .dendrogram import stable_clusters
from .neighbors import cores_of, knn_points
from .silhouette import silhouette_euclidean
from .tiles import Tile, over_runs, read_tile, write_tiles

EDGES = "u long, v long, w double"


def reachability_forest(points: bl.Points, min_samples: int, block_rows: int, ceiling: float = float("inf")) -> DataFrame:
    """(u, v, w): edges that keep the components of every level up to ``ceiling``.

    Ties apart, they are the minimum spanning forest: of edges of equal weight some may close a cycle.
    """
    spark = points.distinct.sparkSession
    found = knn_points(points, min_samples, block_rows)
    core = cores_of(points, found, min_samples)
    # A row whose core distance is above the ceiling has no edges at all.
    dense = core.where(F.col("core") <= ceiling) if np.isfinite(ceiling) else core
    usable = materialize(points.distinct.join(dense, "rep").select("rep", "v", "core"), "dense")
    n = usable.count()
    if n == 0:
        return spark.createDataFrame([], EDGES)
    blocks = bl.build_blocks(usable, n, block_rows)
    matter = _pairs_that_matter(blocks, ceiling)
    pairs = matter.unionByName(matter.select(F.col("b").alias("a"), F.col("a").alias("b"))).unionByName(blocks.each())
    cores = materialize(usable.select("rep", "core"), "cores")
    left, right = (cores.select(F.col("rep").alias(c), F.col("core").alias(f"{c}_core")) for c in ("u", "v"))
    listed = found.select(F.col("rep").alias("u"), F.col("nbr").alias("v"), "d").join(left, "u").join(right, "v")
    listed = listed.select("u", "v", F.greatest("d", "u_core", "v_core").alias("w")).where((F.col("w") <= ceiling) & (F.col("u") != F.col("v")))
    edges = _least_edges(blocks, materialize(pairs, "block-pairs"), cores, listed, ceiling)
    if points.has_copies:
        # Copies hang on their representative; their mutual reachability is the core distance.
        copies = points.members.where(F.col("id") != F.col("rep")).join(cores, "rep")
        edges = edges.unionByName(copies.select(F.col("rep").alias("u"), F.col("id").alias("v"), F.col("core").alias("w")).distinct())
    return materialize(edges, "forest")


def _placed(blocks: bl.Blocks) -> DataFrame:
    """(name, rep): the block of each row."""
    folder = blocks.folder

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("name").to_pylist():
                reps = np.array(read_tile(folder, name)["rep"])
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(reps)), pa.array(reps)], names=["name", "rep"])

    return materialize(blocks.packed.select("name").mapInArrow(run, "name string, rep long"), "places")


def _least_edges(blocks: bl.Blocks, pairs: DataFrame, cores: DataFrame, listed: DataFrame, ceiling: float) -> DataFrame:
    """Rounds of Boruvka over ``pairs`` of blocks, ``listed`` being edges that are known beforehand.

    The least edge out of a component is part of some minimum forest whatever the other
    components do, so the largest one need not look for its own.
    """
    both = listed.unionByName(listed.select(F.col("v").alias("u"), F.col("u").alias("v"), "w"))
    known = materialize(both.withColumns({"cu": F.col("u"), "cv": F.col("v")}), "listed")
    placed = _placed(blocks)
    labels = cores.select("rep", F.col("rep").alias("comp")).distinct()
    chosen = None
    # Edges of equal weight, which core distances make often, go by their rows, so that they close no cycles.
    edge = F.struct("w", F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"), "cv").alias("e")
    while True:
        largest = labels.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "comp").limit(2).collect()
        if len(largest) < 2:
            break
        least = materialize(known.where(F.col("cu") != largest[0]["comp"]).groupBy(F.col("cu").alias("comp")).agg(F.min(edge).alias("e")), "least")
        bound = F.coalesce("e.w", F.lit(float(np.nextafter(ceiling, np.inf))))
        looking = (F.col("comp") != largest[0]["comp"]) & ((F.col("core") < bound) | F.col("e").isNull())
        marked = placed.join(labels.join(least, "comp", "left"), "rep").join(cores.groupBy("rep").agg(F.min("core").alias("core")), "rep")
        marked = marked.select("name", "rep", "comp", F.when(looking, bound).otherwise(-1.0).alias("bound"))
        marks, folder = write_tiles(
            marked.groupBy("name").agg(F.max("bound").alias("bound"), F.sort_array(F.collect_list(F.struct("rep", "comp", "bound"))).alias("rows")), "marks"
        )
        asking = pairs.join(marks.where("bound >= 0").select(F.col("name").alias("a")), "a", "left_semi")
        best = least.unionByName(_least_found(asking, blocks.folder, folder)).groupBy("comp").agg(F.min("e").alias("e"))
        best = materialize(best.select("comp", "e.*"), "least-edges")
        if not best.head(1):
            break
        ends = best.select("u", "v", "w").distinct()
        chosen = ends if chosen is None else chosen.unionByName(ends)
        merged = connected_components(best.select(F.lit(0).alias("level"), F.col("comp").alias("u"), F.col("cv").alias("v")), "level")
        merged = materialize(merged.select("node", "component"), "forest-parts")
        into = lambda df, c: df.join(merged, F.col(c) == F.col("node"), "left").withColumn(c, F.coalesce("component", c)).drop("node", "component")
        labels = materialize(into(labels, "comp"), "labels")
        known = materialize(into(into(known, "cu"), "cv").where("cu <> cv"), "listed")
    if chosen is None:
        return cores.sparkSession.createDataFrame([], EDGES)
    return chosen


def _least_found(pairs: DataFrame, folder: str, marks: str) -> DataFrame:
    """(comp, e): of the components in a block, the least edge to rows of other components, if it is below the bound."""

    def work(left: Tile, a: str, rights: Iterator[tuple[str, Tile]]) -> Iterator[pa.Table]:
        mark = read_tile(marks, a)
        asking = np.flatnonzero(mark["bound"] >= 0)
        comp, core, rep, v = mark["comp"][asking], left["core"][asking], left["rep"][asking], left["v"][asking]
        names, first, at = np.unique(comp, return_index=True, return_inverse=True)
        bound = mark["bound"][asking][first].copy()
        ends = np.zeros((3, len(names)), np.int64)
        hit = np.zeros(len(names), bool)

        def look(right: Tile, theirs: np.ndarray, some: slice) -> None:
            here = np.flatnonzero(core < bound[at])
            limit = bound[at[here]]
            for r, c, gap in bl.near_rows(v[here], right["v"][some], limit, (comp[here], theirs[some])):
                rows = here[r]
                w = np.maximum(gap, np.maximum(core[rows], right["core"][some][c]))
                one, other = rep[rows], right["rep"][some][c]
                low, high = np.minimum(one, other), np.maximum(one, other)
                order = np.lexsort((high, low, w, at[rows]))
                of, place = np.unique(at[rows][order], return_index=True)
                pick = order[place]
                before = (low[pick] < ends[0, of]) | (low[pick] == ends[0, of]) & (high[pick] < ends[1, of])
                less = (w[pick] < bound[of]) | hit[of] & (w[pick] == bound[of]) & before
                of, pick = of[less], pick[less]
                bound[of], hit[of] = w[pick], True
                ends[:, of] = low[pick], high[pick], theirs[some][c[pick]]
                limit[:] = bound[at[here]]

        for b, right in rights:
            theirs = np.asarray(read_tile(marks, b)["comp"])
            if np.isinf(bound).any():  # a few rows give a first bound
                look(right, theirs, slice(0, 64))
            look(right, theirs, slice(None))
        columns = [names[hit], bound[hit], *ends[:, hit]]
        yield pa.table(dict(zip(("comp", "w", "u", "v", "cv"), columns)))

    found = over_runs(pairs, folder, work, "comp long, w double, u long, v long, cv long")
    return found.groupBy("comp").agg(F.min(F.struct("w", "u", "v", "cv")).alias("e"))


def minimum_forest(edges: DataFrame) -> DataFrame:
    """The minimum spanning forest of (u, v, w), by rounds of Boruvka: at most one edge less than vertices.

    In every round each component takes its least outgoing edge; ties go by the
    vertices, so no cycle can close. What is chosen is contracted, and of several
    edges between two components the least stays.
    """
    ends = [F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")]
    plain = edges.where("u <> v").select("w", *ends)
    live = materialize(plain.select("w", "u", "v", F.col("u").alias("cu"), F.col("v").alias("cv")).distinct(), "forest-edges")
    chosen = None
    while live.head(1):
        edge = F.struct("w", "u", "v", "cu", "cv").alias("e")
        both = live.select(F.col("cu").alias("c"), edge).unionByName(live.select(F.col("cv").alias("c"), edge))
        best = materialize(both.groupBy("c").agg(F.min("e").alias("e")).select("e.*").distinct(), "forest-round")
        chosen = best if chosen is None else chosen.unionByName(best)
        merged = connected_components(best.select(F.lit(0).alias("level"), F.col("cu").alias("u"), F.col("cv").alias("v")), "level")
        merged = materialize(merged.select("node", "component"), "forest-parts")
        left, right = (merged.select(F.col("node").alias(c), F.col("component").alias(f"{c}2")) for c in ("cu", "cv"))
        moved = live.join(left, "cu").join(right, "cv").where("cu2 <> cv2")
        pair = [F.least("cu2", "cv2").alias("cu"), F.greatest("cu2", "cv2").alias("cv")]
        live = moved.groupBy(*pair).agg(F.min(F.struct("w", "u", "v")).alias("e")).select("e.w", "e.u", "e.v", "cu", "cv")
        live = materialize(live, "forest-edges")
    if chosen is None:
        return edges.sparkSession.createDataFrame([], EDGES)
    return chosen.select("u", "v", "w")


def _pairs_that_matter(blocks: bl.Blocks, ceiling: float) -> DataFrame:
    """Pairs of blocks that can hold an edge of the forest.

    Any two rows are joined by a detour: to the pivot of the one, along a
    spanning tree of the pivots, to the other. An edge longer than every step of
    its detour closes a cycle as its longest edge, so it is not needed. Steps to
    the pivot are no longer than the radius and the core distances of a block.
    """
    core = np.array([row["core"] for row in blocks.pivots])
    steps = np.maximum(blocks.pivot_distances, np.maximum(core[:, None], core[None, :]))
    bridges = np.zeros_like(steps)
    inside, best, link = [0], steps[0].copy(), np.zeros(len(core), dtype=int)
    best[0] = np.inf
    while len(inside) < len(core):
        new = int(best.argmin())
        bridges[new, inside] = bridges[inside, new] = np.maximum(bridges[link[new], inside], best[new])
        inside.append(new)
        best[new] = np.inf
        closer = steps[new] < best
        closer[inside] = False
        best[closer], link[closer] = steps[new][closer], new
    pivot_core = F.get(F.array(*[F.lit(float(c)) for c in core]), F.col("pivot"))
    reach = blocks.packed.select("block", F.greatest("radius", "core", pivot_core).alias("reach"))
    return blocks.pairs_between(reach, bridges, ceiling)


def _parts_at(points: bl.Points, eps: float, min_samples: int, block_rows: int) -> DataFrame:
    """(node, component) of the rows with a core distance up to ``eps``, linked up to ``eps``."""
    found = knn_points(points, min_samples, block_rows)
    core = cores_of(points, found, min_samples)
    dense = materialize(core.where(F.col("core") <= eps).select("rep"), "dense")
    listed = found.where(F.col("d") <= eps).select(F.col("rep").alias("u"), F.col("nbr").alias("v"))
    listed = listed.join(dense.select(F.col("rep").alias("u")), "u", "left_semi").join(dense.select(F.col("rep").alias("v")), "v", "left_semi")
    if points.has_copies:
        copies = points.members.where(F.col("id") != F.col("rep")).join(dense, "rep", "left_semi")
        listed = listed.unionByName(copies.select(F.col("rep").alias("u"), F.col("id").alias("v")))
    first = connected_components(listed.select(F.lit(0).alias("level"), "u", "v"), "level")
    first = materialize(first.select("node", "component"), "first-parts")
    rows = points.distinct.join(dense, "rep", "left_semi").join(first.withColumnRenamed("node", "rep"), "rep", "left")
    rows = materialize(rows.select("rep", "v", F.coalesce("component", "rep").alias("comp")), "dense-rows")
    every = first.select("node", "component").unionByName(rows.select(F.col("rep").alias("node"), F.col("comp").alias("component"))).distinct()
    largest = rows.groupBy("comp").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "comp").limit(2).collect()
    if len(largest) < 2:
        return every
    marked = rows.withColumn("asked", (F.col("comp") != largest[0]["comp"]).cast("int"))
    blocks = bl.build_blocks(marked, rows.count(), block_rows)
    reach = blocks.packed.select("block", F.when(F.col("asked") > 0, F.lit(float(eps))).otherwise(-float("inf")).alias("reach"))
    own = blocks.packed.where("asked > 0").select(F.col("name").alias("a"), F.col("name").alias("b"))
    links = over_runs(blocks.pairs_from(reach).unionByName(own), blocks.folder, _links(eps), "level int, u long, v long")
    merged = connected_components(links, "level").select(F.col("node").alias("component"), F.col("component").alias("top"))
    return every.join(merged, "component", "left").select("node", F.coalesce("top", "component").alias("component"))


LINKS = 1 << 16  # links between components that a task holds before it contracts them


def _links(eps: float) -> Callable:
    def work(left: Tile, _: str, rights: Iterator[tuple[str, Tile]]) -> Iterator[pa.Table]:
        asked = np.flatnonzero(left["asked"] > 0)
        v, comp, limit = left["v"][asked], left["comp"][asked], np.full(len(asked), float(eps))
        held = np.empty((2, 0), np.int64)
        for _, right in rights:
            for r, c, _ in bl.near_rows(v, right["v"], limit, (comp, right["comp"])):
                if len(r):
                    held = np.unique(np.concatenate([held, np.stack([comp[r], right["comp"][c]])], axis=1), axis=1)
                if held.shape[1] > LINKS:
                    stars = contract("level", [_batch(held)])
                    held = np.stack([stars.column(n).to_numpy() for n in ("u", "v")])
        yield pa.Table.from_batches([_batch(held)])

    return work


def _batch(links: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.zeros(links.shape[1], np.int32)), *map(pa.array, links)], names=["level", "u", "v"])


def density_cluster(
    df: DataFrame,
    eps: float,
    min_cluster_size: int = fv.MIN_CLUSTER_SIZE,
    min_samples: int | None = None,
    vector_col: str = "embedding",
    id_col: str = "doc_id",
    block_rows: int = bl.BLOCK_ROWS,
) -> DataFrame:
    """(doc_id, cluster_hdbscan) at one level ``eps``; noise is -1.

    A cluster is named after its smallest doc_id, which needs no numbering of
    all clusters in one place and stays the same on any partitioning.
    """
    min_samples = min_samples or min_cluster_size
    points = bl.fold_copies(df, vector_col, id_col)
    parts = _parts_at(points, eps, min_samples, block_rows)
    # a row without any link is not a cluster
    sizes = parts.groupBy("component").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") >= max(min_cluster_size, 2))
    kept = parts.join(sizes, "component").select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
    every = df.select(F.col(id_col).cast("long").alias("doc_id"))
    return every.join(kept, "doc_id", "left").select(
        "doc_id", F.coalesce("cluster", F.lit(fv.NOISE)).cast("long").alias("cluster_hdbscan")
    )


def density_cluster_auto(
    df: DataFrame,
    min_cluster_size: int = fv.MIN_CLUSTER_SIZE,
    min_samples: int | None = None,
    vector_col: str = "embedding",
    id_col: str = "doc_id",
    block_rows: int = bl.BLOCK_ROWS,
) -> DataFrame:
    """(doc_id, cluster_hdbscan) without a given eps; noise is -1.

    The most stable clusters of the minimum spanning forest, taken at the weights of
    its own edges, as ``dendrogram`` describes. A cluster is named after its smallest
    doc_id.
    """
    min_samples = min_samples or min_cluster_size
    points = bl.fold_copies(df, vector_col, id_col)
    every = df.select(F.col(id_col).cast("long").alias("doc_id"))
    forest = reachability_forest(points, min_samples, block_rows)
    ends = forest.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    if forest.count() >= max(ends.count(), 1):  # ties closed a cycle
        forest = materialize(minimum_forest(forest), "forest")
    chosen = stable_clusters(forest, min_cluster_size)
    return every.join(chosen, "doc_id", "left").select(
        "doc_id", F.coalesce("cluster", F.lit(fv.NOISE)).cast("long").alias("cluster_hdbscan")
    )


def density_run(df: DataFrame, min_cluster_size: int = fv.MIN_CLUSTER_SIZE, **options) -> tuple[DataFrame, float | None, float]:
    """Labels, Euclidean silhouette of the rows that are not noise, and coverage.

    ``df`` holds the reduced vectors; the silhouette lives in the same space.
    """
    vector_col, id_col = options.get("vector_col", "embedding"), options.get("id_col", "doc_id")
    labels = materialize(density_cluster_auto(df, min_cluster_size, **options), "density-labels")
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(vector_col).alias("embedding")).join(labels, "doc_id")
    score = silhouette_euclidean(rows, "cluster_hdbscan").first()["silhouette"]
    share = labels.agg(F.avg((F.col("cluster_hdbscan") != fv.NOISE).cast("double"))).first()[0]
    return labels, score, share
