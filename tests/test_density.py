import numpy as np
import pytest
from helpers import components, core_distances, distances, vector_frame, with_copies

from themeweave.operators import blocks as bl
from themeweave.operators import density
from themeweave.operators.components import connected_components


def brute_force(x, eps, min_samples, min_size):
    core = core_distances(x, min_samples)
    linked = np.maximum(distances(x), np.maximum(core[:, None], core[None, :])) <= eps
    root = components(linked)
    sizes = np.bincount(root, minlength=len(x))
    dense = (core <= eps) & (sizes[root] >= min_size)
    return np.where(dense, root, -1)


def labels_of(df):
    return np.array([r[1] for r in df.orderBy("doc_id").collect()])


def blobs(seed=1):
    rng = np.random.default_rng(seed)
    parts = [rng.normal(size=(40, 4)) * 0.3 + c for c in (np.zeros(4), np.full(4, 3.0), np.array([6.0, 0, 0, 0]))]
    return np.concatenate([*parts, rng.uniform(-6, 10, size=(25, 4))])[rng.permutation(145)]


@pytest.mark.parametrize("block_rows", [13, 4096])
@pytest.mark.parametrize("eps", [0.4, 0.9, 3.0])
def test_level_equals_brute_force(spark, block_rows, eps):
    x = blobs()
    got = labels_of(density.density_cluster(vector_frame(spark, x), eps, 6, 4, block_rows=block_rows))
    assert (got == brute_force(x, eps, 4, 6)).all()


@pytest.mark.parametrize("eps", [0.0, 1.2])
def test_level_with_copies(spark, eps):
    x = with_copies()
    got = labels_of(density.density_cluster(vector_frame(spark, x), eps, 4, 3, block_rows=12))
    assert (got == brute_force(x, eps, 3, 4)).all()


def test_nothing_dense_is_all_noise(spark):
    x = blobs()
    assert (labels_of(density.density_cluster(vector_frame(spark, x), 1e-6, 5)) == -1).all()


def test_forest_keeps_every_level_and_skips_far_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(size=(50, 3)) + 12 * np.array(c) for c in ((0, 0, 0), (1, 0, 0), (2, 0, 0), (3, 0, 0))])
    kept = []
    matter = density._pairs_that_matter
    monkeypatch.setattr(density, "_pairs_that_matter", lambda b, c: kept.append((matter(b, c).count(), b.count)) or matter(b, c))
    forest = density.reachability_forest(bl.fold_copies(vector_frame(spark, x)), 4, 10).collect()
    (n_pairs, n_blocks), = kept
    assert n_pairs < n_blocks * (n_blocks - 1) // 2
    for eps in (0.6, 1.0, 2.0, 6.0, 9.0, 15.0):
        linked = np.zeros((len(x), len(x)), dtype=bool)
        for u, v, w in forest:
            linked[u, v] = linked[v, u] = w <= eps
        sizes = np.bincount(components(linked), minlength=len(x))[components(linked)]
        assert (np.where(sizes > 1, components(linked), -1) == brute_force(x, eps, 4, 2)).all()


@pytest.mark.parametrize("block_rows", [31, 4096])
def test_auto_finds_planted_blobs(spark, block_rows):
    x = blobs()
    df = vector_frame(spark, x)
    got = labels_of(density.density_cluster_auto(df, 10, 5, block_rows=block_rows))
    assert len(set(got) - {-1}) == 3
    planted = brute_force(x, 0.9, 5, 10)
    agree = [(got[i], planted[i]) for i in range(len(x)) if got[i] != -1 and planted[i] != -1]
    assert len(set(agree)) == 3 and len(agree) > 100


def test_auto_is_independent_of_partitions(spark):
    x = blobs(4)
    runs = [labels_of(density.density_cluster_auto(vector_frame(spark, x).repartition(p), 8, 4, block_rows=60)) for p in (1, 6)]
    assert (runs[0] == runs[1]).all()


def test_auto_with_a_third_copies(spark):
    x = np.concatenate([blobs(), np.full((70, 4), 20.0)])
    got = labels_of(density.density_cluster_auto(vector_frame(spark, x), 10, 5, block_rows=40))
    crowd = got[(x == 20.0).all(axis=1)]
    assert len(set(crowd)) == 1 and crowd[0] != -1 and (got == crowd[0]).sum() == 70


def test_auto_on_few_rows(spark):
    x = np.array([[0.0, 1.0], [5.0, 5.0]])
    assert (labels_of(density.density_cluster_auto(vector_frame(spark, x), 5)) == -1).all()
    assert density.density_cluster_auto(vector_frame(spark, x).limit(0), 5).count() == 0


def test_run_reports_score_and_coverage(spark):
    labels, score, share = density.density_run(vector_frame(spark, blobs()), 10, min_samples=5)
    got = labels_of(labels)
    assert share == pytest.approx((got != -1).mean()) and 0.5 < score <= 1


def test_components_of_long_paths_hubs_and_separate_keys(spark):
    path = [(0, i, i + 1) for i in range(300)]
    star = [(0, 1000 + i, 2000) for i in range(500)]
    same_ids_elsewhere = [(1, 0, 1), (1, 5, 9), (1, 9, 7)]
    edges = spark.createDataFrame(path + star + same_ids_elsewhere, "level int, u long, v long").repartition(16)
    got = {(r["level"], r["node"]): r["component"] for r in connected_components(edges, "level").collect()}
    assert all(got[(0, i)] == 0 for i in range(301))
    assert all(got[(0, 1000 + i)] == 1000 for i in range(500)) and got[(0, 2000)] == 1000
    assert {k: v for k, v in got.items() if k[0] == 1} == {(1, 0): 0, (1, 1): 0, (1, 5): 5, (1, 7): 5, (1, 9): 5}


def test_one_forest_whatever_the_blocks(spark):
    x = blobs()
    df = vector_frame(spark, x)
    weights, labels = [], []
    for block_rows in (25, 100, 2048):
        forest = density.minimum_forest(density.reachability_forest(bl.fold_copies(df), 4, block_rows))
        rows = forest.collect()
        assert len(rows) == len(x) - 1
        weights.append(sorted(round(r["w"], 9) for r in rows))
        labels.append(labels_of(density.density_cluster_auto(df, 8, 4, block_rows=block_rows)))
    assert weights[0] == weights[1] == weights[2]
    assert (labels[0] == labels[1]).all() and (labels[0] == labels[2]).all()
    assert len(set(labels[0])) > 2
