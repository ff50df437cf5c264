"""What keeps pairwise work growing no faster than it must: blocks, tasks, and what leaves them."""

import numpy as np
import pyarrow as pa
import pytest
from helpers import components, core_distances, distances, neighbors, silhouette, vector_frame
from pyspark.sql import functions as F

from themeweave.operators import blocks as bl
from themeweave.operators import density, labeling, tiles
from themeweave.operators import neighbors as nn
from themeweave.operators import silhouette as sil


def _tasks(df) -> set:
    def run(batches):
        from pyspark import TaskContext

        for _ in batches:
            pass
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()])], names=["task"])

    return {r["task"] for r in df.mapInArrow(run, "task long").collect()}


def test_pairs_are_dealt_by_their_number_not_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(tiles, "PAIRS", 10)
    pairs = spark.createDataFrame([(str(a), str(b)) for a in range(40) for b in range(40)], "a string, b string")
    assert len(_tasks(tiles._dealt(pairs))) > 100
    assert tiles._dealt(pairs.limit(0)).count() == 0


def test_blocks_grow_with_the_table(spark):
    x = np.random.default_rng(2).normal(size=(6000, 3))
    blocks = bl.build_blocks(bl.fold_copies(vector_frame(spark, x)).distinct.select("rep", "v"), len(x), 8)
    assert blocks.count < 4 * bl.FEW_BLOCKS
    assert blocks.packed.groupBy().sum("size").first()[0] == len(x)
    assert bl.grown(8, 500) == 8 and bl.grown(64, 10**9) == bl.BLOCK_ROWS and bl.grown(4096, 10**9) == 4096


@pytest.mark.parametrize("offset", [0.0, 1e3, 1e18])
def test_near_rows_equal_brute_force(offset, monkeypatch):
    monkeypatch.setattr(bl, "NEAR_PAIRS", 64)
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=(50, 5)) * max(1.0, offset / 10) + offset, rng.normal(size=(40, 5)) * max(1.0, offset / 10) + offset
    a[:5] = b[:5]
    gap = np.sqrt(((a[:, None] - b[None]) ** 2).sum(axis=2))
    limit = np.sort(gap, axis=1)[:, 6]
    limit[7], limit[8] = np.inf, 0.0
    kinds = rng.integers(0, 3, 50), rng.integers(0, 3, 40)
    for some in (None, kinds):
        got = {(r, c): d for rows, cols, gaps in bl.near_rows(a, b, limit, some) for r, c, d in zip(rows, cols, gaps)}
        want = gap <= limit[:, None] if some is None else (gap <= limit[:, None]) & (kinds[0][:, None] != kinds[1])
        assert set(got) == set(zip(*np.nonzero(want)))
        assert all(d == gap[p] for p, d in got.items())


def test_a_task_sends_one_list_per_row(spark, monkeypatch):
    """Not one for each pair of blocks."""
    sent = []
    kept = nn._best
    monkeypatch.setattr(nn, "_best", lambda df, *a: sent.append(df.count()) or kept(df, *a))
    x = np.random.default_rng(4).normal(size=(1500, 12))
    got = {}
    for r in nn.knn_graph(vector_frame(spark, x), 3, block_rows=32).orderBy("doc_id", "rank").collect():
        got.setdefault(r["doc_id"], []).append(r["neighbor_id"])
    assert sent[0] < 3 * len(x) * 12
    assert got == neighbors(x, 3)


def test_core_distances_in_grown_blocks(spark):
    x = np.random.default_rng(5).normal(size=(900, 6))
    assert bl.grown(4, len(x)) > 4
    got = {r[0]: r[1] for r in nn.core_distance(vector_frame(spark, x), 4, block_rows=4).collect()}
    assert np.allclose([got[i] for i in range(len(x))], core_distances(x, 4), atol=1e-12)


def test_silhouette_sends_one_sum_per_row_and_cluster(spark, monkeypatch):
    x = np.random.default_rng(6).normal(size=(700, 5))
    labels = np.arange(700) % 3
    sent = []
    kept = sil._distance_sums
    monkeypatch.setattr(sil, "_distance_sums", lambda *a: sent.append(kept(*a).count()) or kept(*a))
    got = sil.silhouette_euclidean(vector_frame(spark, x, labels), "label", block_rows=8).first()
    assert got["silhouette"] == pytest.approx(silhouette(distances(x), labels), abs=1e-9) and got["asked"] == 700
    assert sent[0] < 700 * 3 * 8
    monkeypatch.setattr(sil, "SLICE", 50)
    assert sil.silhouette_euclidean(vector_frame(spark, x, labels), "label", block_rows=8).first() == pytest.approx(tuple(got), abs=1e-12)


def test_only_rows_outside_the_largest_component_look_for_links(spark, monkeypatch):
    """A crowd in which all is linked by the lists of neighbours, and two groups far off."""
    rng = np.random.default_rng(7)
    x = np.concatenate([rng.normal(size=(600, 2)), rng.normal(size=(30, 2)) + 40, rng.normal(size=(30, 2)) + 46])
    asked = []
    kept = density._links
    monkeypatch.setattr(density, "_links", lambda eps: asked.append(eps) or kept(eps))
    met = []
    runs = density.over_runs
    monkeypatch.setattr(density, "over_runs", lambda pairs, *a: met.append(pairs.count()) or runs(pairs, *a))
    got = {r[0]: r[1] for r in density.density_cluster(vector_frame(spark, x), 4.0, 5, 4, block_rows=16).collect()}
    gap, core = distances(x), core_distances(x, 4)
    linked = np.maximum(gap, np.maximum(core[:, None], core[None, :])) <= 4.0
    root = components(linked)
    size = np.bincount(root, minlength=len(x))
    assert got == {i: int(root[i]) if core[i] <= 4.0 and size[root[i]] >= 5 else -1 for i in range(len(x))}
    assert asked == [4.0] and met[0] < 400  # of some 2,000 pairs of blocks


def test_forest_has_an_edge_per_row_whatever_the_blocks(spark):
    x = np.random.default_rng(8).normal(size=(300, 4))
    x[150:] += 30
    forest = density.reachability_forest(bl.fold_copies(vector_frame(spark, x)), 4, 16).collect()
    assert len(forest) == len(x) - 1
    core = core_distances(x, 4)
    reach = np.maximum(distances(x), np.maximum(core[:, None], core[None, :]))
    inside, least, total = {0}, reach[0].copy(), []
    while len(inside) < len(x):
        at = min(set(range(len(x))) - inside, key=lambda i: least[i])
        total.append(least[at])
        inside.add(at)
        least = np.minimum(least, reach[at])
    assert sorted(r["w"] for r in forest) == pytest.approx(sorted(total), abs=1e-12)


def test_labels_clean_texts_once(spark, tmp_path):
    cleaned = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def cleaned_text(text):
        cleaned.add(1)
        return text

    rows = [(i, "t", w, i % 2) for i, w in enumerate(["bola gol", "voto urna"] * 6)]
    df = spark.createDataFrame(rows, "doc_id long, title string, text string, c int")
    df = df.withColumn("texto_modelo", cleaned_text("text")).where("length(texto_modelo) > 2")
    labels, dead, _ = labeling.label_clusters(df, "c", lambda: lambda c, p: ("{}", 1, 1), str(tmp_path / "r"))
    assert labels.count() == 0 and dead.count() == 2
    assert cleaned.value <= 2 * len(rows)  # by the filter and by the column
