import numpy as np
import pytest
from helpers import distances, neighbors, vector_frame, with_copies

from themeweave.operators import neighbors_large as nl
from themeweave.operators import silhouette as sil
from themeweave.operators import tiles


def lists_of(graph):
    out = {}
    for r in graph.orderBy("doc_id", "rank").collect():
        out.setdefault(r["doc_id"], []).append((r["neighbor_id"], r["distance"]))
    return out


def test_large_mode_finds_nearly_all_neighbours(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(900, 24)), rng.normal(size=(900, 24)) * 0.2 + 3, np.full((40, 24), 7.0)])
    got = lists_of(nl.knn_graph_large(vector_frame(spark, x), 10, block_rows=256))
    assert set(got) == set(range(len(x))) and {len(v) for v in got.values()} == {10}
    gap = distances(x)
    hits = total = 0
    for i in range(0, len(x), 20):  # the rows whose id is divisible by 20, against all
        order = sorted((gap[i, j], j) for j in range(len(x)) if j != i)[:10]
        hits += len({j for _, j in order} & {j for j, _ in got[i]})
        total += 10
        assert all(d == pytest.approx(gap[i, j], abs=1e-9) for j, d in got[i])
    assert hits / total >= 0.9


def test_large_mode_on_few_rows_and_copies(spark):
    x = with_copies(n=60)
    got = lists_of(nl.knn_graph_large(vector_frame(spark, x), 4, block_rows=16))
    want = neighbors(x, 4)
    assert {i: [j for j, _ in v] for i, v in got.items()} == want  # small enough to be exact
    assert nl.knn_graph_large(vector_frame(spark, x).limit(0), 4).count() == 0
    two = lists_of(nl.knn_graph_large(vector_frame(spark, np.array([[0.0, 1.0], [2.0, 1.0]])), 4))
    assert two == {0: [(1, 2.0)], 1: [(0, 2.0)]}


def test_leaves_hold_all_rows():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(2000, 5))
    planes = nl._grow(x[:300], 4, rng)
    leaf = nl._leaves(x, planes, 4)
    sizes = np.unique(leaf, return_counts=True)[1]
    assert len(sizes) == 16 and sizes.max() < 400


def test_sampled_silhouettes_lie_in_their_interval(spark, monkeypatch):
    monkeypatch.setattr(sil, "LEAST_ASKED", 10)
    rng = np.random.default_rng(5)
    labels = np.repeat([0, 1, 2, 3], [400, 120, 60, 20])
    x = rng.normal(size=(600, 6)) + np.array([[0], [1.0], [2.5], [5.0]])[labels]
    df = vector_frame(spark, x, labels)
    true = sil.silhouette_euclidean(df, "label").first()
    assert true["standard_error"] == 0 and true["asked"] == 600
    some = sil.silhouette_euclidean(df, "label", sample_fraction=0.25, block_rows=100).first()
    assert 60 < some["asked"] < 300 and 0 < some["standard_error"] < 0.05
    assert abs(some["silhouette"] - true["silhouette"]) < 3 * some["standard_error"]


def test_tiles_hold_what_was_packed(spark):
    rows = [("a", [(1, 0.5, [1.0, 2.0]), (2, 1.5, [3.0, 4.0])]), ("b", [(9, 0.0, [5.0, 6.0])])]
    packed = spark.createDataFrame(rows, "name string, rows array<struct<rep:long,weight:double,v:array<float>>>")
    summary, folder = tiles.write_tiles(packed, "t")
    assert sorted(r[0] for r in summary.collect()) == ["a", "b"] and summary.columns == ["name"]
    tile = tiles.read_tile(folder, "a")
    assert tile["v"].dtype == np.float32 and tile["v"].tolist() == [[1, 2], [3, 4]]
    assert tile["rep"].tolist() == [1, 2] and tile["weight"].tolist() == [0.5, 1.5]
    pairs = spark.createDataFrame([("a", "b"), ("b", "b")], "a string, b string")
    work = lambda left, right, a, b: tiles.pa.table({"s": [float((left["v"] @ right["v"].T).sum())], "n": [a + b]})
    plan = tiles.over_pairs(pairs, folder, work, "s double, n string")
    assert sorted((r["n"], r["s"]) for r in plan.collect()) == [("ab", 56.0), ("bb", 61.0)]
    assert "array" not in plan._jdf.queryExecution().toString()  # no vectors in the shuffle
