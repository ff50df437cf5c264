import numpy as np
import pyarrow as pa
import pytest
from helpers import core_distances, distances, neighbors, silhouette, vector_frame, with_copies
from pyspark.sql import functions as F

from themeweave.functions import vectors as vx
from themeweave.operators import centroids, embedding, kmeans
from themeweave.operators import neighbors as nn
from themeweave.operators import silhouette as sil


@pytest.fixture(scope="module")
def blobs():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(5, 8)) * 3
    labels = rng.integers(0, 5, size=160)
    return centres[labels] + rng.normal(size=(160, 8)), labels


def test_normalised_rows_and_the_zero_row(spark):
    df = vector_frame(spark, np.array([[3.0, 4.0], [0.0, 0.0]]))
    got = {r[0]: r[1] for r in df.select("doc_id", vx.l2_normalize(F.col("embedding"))).collect()}
    assert got[0] == pytest.approx([0.6, 0.8]) and got[1] == [0.0, 0.0]


def test_centroids_and_assignment(spark, blobs):
    x, labels = blobs
    df = vector_frame(spark, x, labels)
    means = {r["cluster_id"]: r["centroid"] for r in centroids.cluster_centroids(df, "label").collect()}
    x = np.float32(x).astype(float)
    want = np.array([x[labels == c].mean(axis=0) for c in range(5)])
    assert np.allclose([means[c] for c in range(5)], want, atol=1e-12)
    gap = np.sqrt(((x[:, None, :] - want[None]) ** 2).sum(axis=2))
    placed = centroids.nearest_centroid_assign(df, centroids.cluster_centroids(df, "label"))
    assert {r["doc_id"]: r["nearest"] for r in placed.collect()} == dict(enumerate(gap.argmin(axis=1)))


def test_assignment_in_several_passes_and_with_ties(spark, blobs, monkeypatch):
    monkeypatch.setattr(centroids, "CENTROIDS_PER_PASS", 2)
    df = vector_frame(spark, np.array([[0.0, 0.0], [2.0, 0.0], [9.0, 9.0]]))
    centres = spark.createDataFrame([(3, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [9.0, 8.0]), (0, [0.0, 1.0])], "cluster_id int, centroid array<double>")
    got = {r["doc_id"]: (r["nearest"], r["distance"]) for r in centroids.nearest_centroid_assign(df, centres).collect()}
    assert got == {0: (0, 1.0), 1: (3, 1.0), 2: (2, 1.0)}


@pytest.mark.parametrize("per_file, pivots", [(1024, 1024), (7, 1024), (7, 3)])
def test_assignment_to_many_centroids(spark, monkeypatch, per_file, pivots):
    """Files and lists of any number give what brute force gives; copies of one centroid crowd a list."""
    monkeypatch.setattr(centroids, "CENTROIDS_PER_PASS", per_file)
    monkeypatch.setattr(centroids, "MAX_PIVOTS", pivots)
    rng = np.random.default_rng(9)
    means = np.round(np.concatenate([rng.normal(size=(200, 3)) * 4, np.ones((100, 3))]), 1)
    x = np.round(np.concatenate([rng.normal(size=(400, 3)) * 4, means[:20], np.ones((5, 3))]), 1).astype(np.float32)
    table = spark.createDataFrame([(int(i), v.tolist()) for i, v in enumerate(means)], "cluster_id int, centroid array<double>")
    placed = centroids.nearest_centroid_assign(vector_frame(spark, x).repartition(3), table)
    got = {r["doc_id"]: (r["nearest"], r["distance"]) for r in placed.collect()}
    gap = np.sqrt(((x.astype(float)[:, None, :] - means[None]) ** 2).sum(axis=2))
    assert {k: v[0] for k, v in got.items()} == dict(enumerate(gap.argmin(axis=1)))
    assert np.allclose([got[i][1] for i in range(len(x))], gap.min(axis=1))
    assert "centroid" not in placed._jdf.queryExecution().toString()


def test_assignment_without_centroids_or_rows(spark):
    df = vector_frame(spark, np.array([[0.0, 1.0]]))
    none = spark.createDataFrame([], "cluster_id int, centroid array<double>")
    row = centroids.nearest_centroid_assign(df, none).first()
    assert row["nearest"] == 2**31 - 1 and row["distance"] == float("inf")
    assert centroids.nearest_centroid_assign(df.limit(0), none).count() == 0


def test_representatives_leave_noise_out(spark):
    x = np.array([[1, 0], [0.9, 0.1], [0, 1], [5, 5]], dtype=float)
    df = vector_frame(spark, x, [0, 0, 0, -1])
    rows = centroids.nearest_to_centroid(df, "label", 2).orderBy("rk").collect()
    assert [(r["cluster_id"], r["doc_id"]) for r in rows] == [(0, 1), (0, 0)]


@pytest.mark.parametrize("block_rows", [16, 4096])
def test_neighbors_equal_brute_force(spark, blobs, block_rows):
    x, _ = blobs
    got = {}
    for r in nn.knn_graph(vector_frame(spark, x), 4, block_rows=block_rows).orderBy("doc_id", "rank").collect():
        got.setdefault(r["doc_id"], []).append(r["neighbor_id"])
    assert got == neighbors(x, 4)


@pytest.mark.parametrize("block_rows", [9, 4096])
def test_neighbors_among_copies(spark, block_rows):
    x = with_copies()
    got, gaps = {}, {}
    for r in nn.knn_graph(vector_frame(spark, x), 5, block_rows=block_rows).orderBy("doc_id", "rank").collect():
        got.setdefault(r["doc_id"], []).append(r["neighbor_id"])
        gaps.setdefault(r["doc_id"], []).append(r["distance"])
    want = neighbors(x, 5)
    assert got == want
    full = distances(x)
    assert all(np.allclose(gaps[i], full[i, want[i]], atol=1e-12) for i in want)


@pytest.mark.parametrize("k", [1, 5, 40])
def test_core_distances_with_copies(spark, k):
    x = with_copies()
    df = vector_frame(spark, x)
    want = core_distances(x, k)
    got = {r[0]: r[1] for r in nn.core_distance(df, k, block_rows=20).collect()}
    assert np.allclose([got[i] for i in range(len(x))], want, atol=1e-12)
    from themeweave.operators import blocks as bl

    points = bl.fold_copies(df)
    by_rep = {r[0]: r[1] for r in nn.point_core_distances(points, k, 20).collect()}
    reps = {r["id"]: r["rep"] for r in points.members.collect()}
    assert np.allclose([by_rep[reps[i]] for i in range(len(x))], want, atol=1e-12)


def test_pivot_bounds_rule_out_far_blocks(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(60, 3)) * 0.1 + 100 * c for c in range(4)])
    from themeweave.operators import blocks as bl

    points = bl.fold_copies(vector_frame(spark, x))
    blocks = bl.build_blocks(points.distinct.select("rep", "v"), points.n_distinct, 10)
    reach = blocks.packed.select("block", F.lit(0.5).cast("double").alias("reach"))
    total = blocks.count * (blocks.count - 1)
    assert 0 < blocks.pairs_from(reach).count() < total


@pytest.mark.parametrize("block_rows", [11, 4096])
def test_silhouettes_equal_brute_force(spark, blobs, block_rows):
    x, labels = blobs
    labels = labels.copy()
    labels[:7] = -1
    labels[7] = 77  # alone in its cluster
    df = vector_frame(spark, x, labels)
    keep = labels != -1
    got = sil.silhouette_euclidean(df, "label", block_rows=block_rows).first()[0]
    assert got == pytest.approx(silhouette(distances(x[keep]), labels[keep]), abs=1e-9)
    x32 = np.float32(x).astype(float)
    unit = x32 / np.linalg.norm(x32, axis=1, keepdims=True)
    assert sil.silhouette_cosine(df, "label") == pytest.approx(silhouette(1 - unit @ unit.T, labels), abs=1e-9)


def test_silhouette_with_copies_and_sliced_statistics(spark, monkeypatch):
    monkeypatch.setattr(sil, "STATS_BYTES", 1)
    x = with_copies()
    labels = np.arange(len(x)) % 4
    got = sil.silhouette_euclidean(vector_frame(spark, x, labels), "label", block_rows=10).first()[0]
    assert got == pytest.approx(silhouette(distances(x), labels), abs=1e-9)


def test_silhouette_needs_two_clusters(spark, blobs):
    x, _ = blobs
    for labels in (np.full(160, -1), np.zeros(160)):
        df = vector_frame(spark, x, labels)
        assert sil.silhouette_euclidean(df, "label").first()[0] is None
    assert sil.silhouette_cosine(vector_frame(spark, x, np.zeros(160)), "label") is None


def test_sweep_finds_planted_groups(spark):
    rng = np.random.default_rng(2)
    centres = np.linalg.qr(rng.normal(size=(12, 12)))[0][:6]
    truth = np.repeat(np.arange(6), 30)
    x = centres[truth] + 0.05 * rng.normal(size=(180, 12))
    sweep = kmeans.kmeans_sweep(vector_frame(spark, x), n_init=5)
    assert sweep.k == 6
    labels = np.array([r[1] for r in sweep.labels.orderBy("doc_id").collect()])
    assert all(len(set(labels[truth == c])) == 1 for c in range(6)) and len(set(labels)) == 6
    x32 = np.float32(x).astype(float)
    unit = x32 / np.linalg.norm(x32, axis=1, keepdims=True)
    assert sweep.score == pytest.approx(silhouette(1 - unit @ unit.T, labels), abs=1e-9)
    assert [r["k"] for r in sweep.scores.orderBy("k").collect()] == list(range(4, 15))


def test_sweep_does_not_depend_on_partitioning(spark, blobs):
    x, _ = blobs
    runs = [
        kmeans.kmeans_sweep(vector_frame(spark, x).repartition(n), k_max=6, n_init=2).labels.orderBy("doc_id").collect()
        for n in (1, 5)
    ]
    assert runs[0] == runs[1]


def test_members_are_those_of_double_precision():
    rng = np.random.default_rng(5)
    for n, d, shift in ((1500, 64, 0.0), (300, 3, 1000.0), (7, 2, 0.0), (200, 8, 1e20)):
        x = np.float32(rng.normal(size=(n, d)) + shift).astype(float)
        ks = [int(k) for k in rng.integers(1, 15, 20)]
        centres = np.concatenate([x[rng.integers(0, n, k)] for k in ks])  # some are equal: the first one wins
        at = 0
        for part, near, order in kmeans._members(x, centres, ks):
            assert len(part) <= kmeans.BLOCK  # scores of a whole batch are never held
            rows, start = np.arange(len(part)), 0
            members = np.empty_like(near)
            members[order] = near
            for k in ks:
                c = centres[start : start + k]
                best = ((c**2).sum(axis=1) - 2.0 * (part @ c.T)).argmin(axis=1)
                assert (members[start : start + k].sum(axis=0) == 1).all() and members[start + best, rows].all()
                start += k
            at += len(part)
        assert at == n


def test_default_vectors_are_unit_and_keyed(spark):
    docs = spark.createDataFrame([(5, "casa amarela na rua"), (9, "rua casa"), (11, "")], "doc_id long, texto_modelo string")
    rows = {r["doc_id"]: np.array(r["embedding"]) for r in embedding.embed_documents(docs).collect()}
    assert set(rows) == {5, 9, 11} and all(len(v) == 768 for v in rows.values())
    assert np.linalg.norm(rows[5]) == pytest.approx(1, abs=1e-6) and not rows[11].any()


def test_encoder_is_loaded_once_per_task(spark, tmp_path):
    log = tmp_path / "loads"

    def load():
        with log.open("a") as f:
            f.write("x")
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    docs = spark.range(300).selectExpr("id as doc_id", "repeat('a', cast(id % 7 as int)) as texto_modelo").repartition(3)
    rows = embedding.embed_documents(docs, load, batch_size=10).collect()
    assert len(rows) == 300 and len(log.read_text()) == 3
    assert all(np.linalg.norm(r["embedding"]) == pytest.approx(1, abs=1e-6) for r in rows)


def test_reduction_keeps_ids_and_explains_more_with_more_dims(spark, blobs):
    df = vector_frame(spark, blobs[0])
    reduced = embedding.reduce_dimensions(df, 3).collect()
    assert len(reduced) == 160 and {len(r["embedding"]) for r in reduced} == {3}
    shares = [sum(embedding.explained_variance(df, k)) for k in (1, 3, 6)]
    assert shares == sorted(shares) and shares[-1] <= 1 + 1e-9


def test_seeds_are_found_among_all_rows(spark):
    """5,000 rows in one place and one far row; whichever it is, it gets a centroid."""
    from themeweave.operators import kmeans

    rng = np.random.default_rng(1)
    x = rng.normal(size=(5001, 3))
    for far in (0, 2500, 5000):
        rows = x.copy()
        rows[far] += 1e4
        df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(rows)], "doc_id long, v array<float>")
        best = kmeans.fit_models(df, [2], 1, 42)[2]
        assert best.settled and min(np.linalg.norm(best.centroids - rows[far], axis=1)) < 1


def test_cost_is_that_of_the_final_centroids(spark):
    from themeweave.operators import kmeans

    x = np.float32(np.random.default_rng(2).normal(size=(200, 4)))
    df = spark.createDataFrame([(i, [float(v) for v in row]) for i, row in enumerate(x)], "doc_id long, v array<float>")
    for model in kmeans.fit_models(df, [2, 5], 2, 7, max_steps=3).values():
        gap = ((x[:, None, :] - model.centroids[None]) ** 2).sum(axis=2).min(axis=1)
        assert model.cost == pytest.approx(gap.sum(), rel=1e-5)


@pytest.mark.parametrize("rows", [[[1.0, 2.0, 3.0], [4.0], [5.0, 6.0]], [[1.0, 2.0], None], [[1.0, None]]])
def test_ragged_and_null_vectors_are_an_error(rows):
    with pytest.raises(ValueError):
        vx.to_matrix(pa.array(rows, pa.list_(pa.float32())))


def test_null_vectors_give_null_results(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, None), (3, [0.0, 2.0])], "i int, v array<float>").coalesce(1)
    got = df.select("i", vx.l2_normalize(F.col("v")), vx.cosine_similarity(F.col("v"), F.col("v")), vx.squared_norm(F.col("v"))).orderBy("i").collect()
    assert [(r[1], r[2], r[3]) for r in got] == [([0.6, 0.8], pytest.approx(1), 25.0), (None, None, None), ([0.0, 1.0], pytest.approx(1), 4.0)]


def test_own_centroid_join_shuffles_no_vectors(spark):
    df = vector_frame(spark, np.random.default_rng(3).normal(size=(50, 4)), labels=[i % 3 for i in range(50)])
    plan = centroids.nearest_to_centroid(df, "label", 2)
    assert plan.count() == 6
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()
