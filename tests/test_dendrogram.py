import random

import numpy as np
import pytest
from helpers import core_distances, distances, vector_frame, with_copies
from test_density import blobs, labels_of

from themeweave.operators import dendrogram, density


def stable_plainly(edges, min_size):
    """Row -> smallest row of its cluster, edge by edge in one place."""
    least = min((w for _, _, w in edges if w > 0), default=None)
    if least is None:
        return {}
    part, of = {}, {}  # rows of each component, component of each row
    for row in {x for u, v, _ in edges for x in (u, v)}:
        part[row], of[row] = [{row}, None], row
    made = []  # clusters: rows with the weight at which they joined, children
    weights = sorted({max(w, least) for _, _, w in edges})
    for w in weights:
        met = {x: {x} for x in part}  # components that this weight brings together
        for u, v, x in edges:
            if max(x, least) == w:
                both = met[of[u]] | met[of[v]]
                for y in both:
                    met[y] = both
        for group in {min(g): g for g in met.values() if len(g) > 1}.values():
            rows = set().union(*(part[x][0] for x in group))
            clusters = [part[x][1] for x in group if part[x][1]]
            loose = {y for x in group if not part[x][1] for y in part[x][0]}
            if len(clusters) == 1:
                new = clusters[0]
                new["rows"].update(dict.fromkeys(loose, w))
            else:
                for c in clusters:
                    c["end"] = w
                new = None
                if len(rows) >= min_size:
                    new = {"rows": dict.fromkeys(rows, w), "children": clusters, "end": None}
                    made.append(new)
            name = min(group)
            for x in group:
                del part[x]
            part[name] = [rows, new]
            of.update(dict.fromkeys(rows, name))

    def stability(c):
        """Its own, and the best of those inside."""
        inner = sum(max(stability(x)) for x in c["children"])
        own = sum(1 / w - 1 / c["end"] for w in c["rows"].values()) if c["end"] else -1.0
        return own, inner

    kept, open_ = {}, [c for c in made if c["end"] is None]
    while open_:  # from the root on, the outermost choice counts
        c = open_.pop()
        own, inner = stability(c)
        if own > 0 and own >= inner * (1 - 1e-12):
            rows = [x for x, w in c["rows"].items() if w < c["end"]]
            kept.update(dict.fromkeys(rows, min(rows)))
        else:
            open_.extend(c["children"])
    return kept


def random_tree(seed, n, shape, ties):
    rng = random.Random(seed)
    ids = rng.sample(range(10 * n), n)
    edges = []
    for k in range(1, n):
        to = {"random": rng.randrange(k), "path": k - 1, "star": 0, "brush": max(0, k - rng.randint(1, 3))}[shape]
        w = float(rng.choice([0, 1, 1, 2, 3])) if ties else rng.random() + (k * 0.01 if shape == "path" else 0)
        edges.append((ids[to], ids[k], w))
    return edges


@pytest.mark.parametrize("band", [5000, 250])
def test_clusters_of_trees(spark, band):
    edges = []  # trees of many shapes, each with a root of its own
    for k, (shape, ties) in enumerate((s, t) for s in ("random", "path", "star", "brush") for t in (False, True)):
        edges += [(u + 10_000 * k, v + 10_000 * k, w) for u, v, w in random_tree(k, 120, shape, ties)]
    frame = spark.createDataFrame(edges, "u long, v long, w double").repartition(3)
    got = {r["doc_id"]: r["cluster"] for r in dendrogram.stable_clusters(frame, 4, band=band).collect()}
    assert got == stable_plainly(edges, 4)


def test_tree_of_clusters_by_contraction(spark):
    # a deep chain of clusters, and a broad tree
    rng = random.Random(3)
    rows = [(0, None, dendrogram.NEVER)] + [(k, k - 1 if k < 70 else rng.randrange(k), round(rng.random() * 4, 3)) for k in range(1, 130)]
    tree = spark.createDataFrame(rows, "id long, parent long, own double").repartition(4)
    near = {r["id"]: r["top"] for r in dendrogram._chosen(tree, 10**6).collect()}
    far = {r["id"]: r["top"] for r in dendrogram._chosen(tree, 10).collect()}
    children = {}
    for i, p, _ in rows:
        children.setdefault(p, []).append(i)
    own, inner, want = {i: o for i, _, o in rows}, {}, {}
    for i, _, _ in reversed(rows):
        inner[i] = sum(max(own[c], inner[c]) for c in children.get(i, []))
    for i, p, _ in rows:
        if p in want:
            want[i] = want[p]
        elif own[i] > 0 and own[i] >= inner[i]:
            want[i] = i
    assert near == want and far == want


@pytest.mark.parametrize("x, size, samples", [(blobs(4), 5, 3), (with_copies(n=120), 4, 3)])
def test_auto_equals_the_whole_hierarchy(spark, x, size, samples):
    core = core_distances(x, samples)
    reach = np.maximum(distances(x), np.maximum(core[:, None], core[None, :]))
    outside, edges = set(range(1, len(x))), []
    inside = [0]
    while outside:
        w, u, v = min((reach[i, j], i, j) for i in inside for j in outside)
        edges.append((u, v, w))
        inside.append(v)
        outside.remove(v)
    want = stable_plainly(edges, size)
    got = labels_of(density.density_cluster_auto(vector_frame(spark, x), size, samples, block_rows=50))
    assert [want.get(i, -1) for i in range(len(x))] == got.tolist()


def test_edges_without_clusters(spark):
    schema = "u long, v long, w double"
    assert dendrogram.stable_clusters(spark.createDataFrame([], schema), 3).count() == 0
    assert dendrogram.stable_clusters(spark.createDataFrame([(1, 2, 0.0), (2, 3, 0.0)], schema), 2).count() == 0
    with pytest.raises(ValueError):
        dendrogram.stable_clusters(spark.createDataFrame([(1, 2, 1.0)], schema), 1)
