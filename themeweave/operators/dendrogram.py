"""Stable clusters of a minimum spanning forest, at the weights of its own edges.

Taken in ascending order, every edge joins two components. A component of
``min_size`` rows or more is a cluster. A cluster that meets a smaller component
absorbs it; where two clusters meet, both end and a new one begins. A cluster's
stability is the sum over its rows of ``1/w_joined - 1/w_ended``. From the finest
on, a cluster is preferred to those inside it if it is at least as stable as the
best choice of them; the last one, the root, is never chosen.

No task holds the forest. Edges are cut into bands by weight, of about ``BAND``
edges each. What a band does depends on the bands before it only by the components
it finds, so these are computed for all bands together, halving the range of bands
in every step. Then each band is worked off on its own, edge by edge. A cluster
that lives on through several bands is followed by doubling. The tree of clusters
(at most two for every ``min_size`` rows) is evaluated by contraction: leaves are
added up, and in chains every other cluster is spliced out, so deep trees take a
logarithmic number of rounds, too.

Ties: edges of equal weight count as taken at once. They are worked off one by one, and
the clusters that end at the weight at which they began, which only the order made, are
taken out of the tree afterwards. A row is not of a cluster that ends at the weight at
which it joined. Weights below the least positive one count as that one.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .components import connected_components

BAND = 1 << 18  # edges worked off by one task
LOCAL = 1 << 18  # clusters whose tree one task evaluates

# A cluster is known by (-1, edge that began it), or by (band, component) where an earlier band began it.
EVENTS = "kind string, tag long, id long, ptag long, pid long, node long, size long, held double, ended double"
NEVER = -float("inf")
SLACK = 1 - 1e-12  # for sums taken in another order


def stable_clusters(forest: DataFrame, min_size: int, band: int | None = None, local: int | None = None) -> DataFrame:
    """(doc_id, cluster) for the rows of chosen clusters; ``forest`` (u, v, w) has no cycles.

    ``cluster`` is the smallest row of the cluster.
    """
    if min_size < 2:
        raise ValueError("a cluster has at least two rows")
    spark = forest.sparkSession
    shape = forest.agg(F.count(F.lit(1)).alias("n"), F.min(F.when(F.col("w") > 0, F.col("w"))).alias("least")).first()
    if shape["least"] is None:  # no edges, or all rows equal: nothing but a root
        return spark.createDataFrame([], "doc_id long, cluster long")
    n_bands = math.ceil(shape["n"] / (band or BAND))
    events = _events(_banded(forest, shape["least"], n_bands), n_bands, min_size)
    rows, tree = _untied(*_followed(events))
    chosen = _chosen(tree, local or LOCAL)
    # with ties a row can join a cluster at the weight at which that ends; it is not of the cluster then
    ends = chosen.join(tree.select(F.col("id").alias("top"), "ended"), "top")
    placed = materialize(rows.join(ends, "id").where("joined < ended").select("node", "top"), "placed")
    names = placed.groupBy("top").agg(F.min("node").alias("cluster"))
    return placed.join(names, "top").select(F.col("node").alias("doc_id"), "cluster")


def _banded(forest: DataFrame, least: float, n_bands: int) -> DataFrame:
    """(band, e, w, u, v): edges numbered, and cut by weight into bands."""
    edges = forest.select("u", "v", F.greatest("w", F.lit(least)).alias("w"))
    cut = edges.repartitionByRange(n_bands, "w", "u", "v") if n_bands > 1 else edges.coalesce(1)
    number = F.spark_partition_id().cast("int") if n_bands > 1 else F.lit(0)
    return materialize(cut.select(number.alias("band"), F.monotonically_increasing_id().alias("e"), "w", "u", "v"), "banded")


def _events(edges: DataFrame, n_bands: int, min_size: int) -> DataFrame:
    """What happens in each band, all bands starting from the components of the bands before."""
    ends = edges.select("band", F.explode(F.array("u", "v")).alias("node")).distinct()
    nodes = ends.select(F.lit(0).alias("part"), "node").distinct().select(
        "part", "node", F.lit(1).cast("long").alias("size"), F.array("node").alias("rows")
    )
    for step in reversed(range(max(n_bands - 1, 0).bit_length())):  # a part is a run of 2**(step + 1) bands
        half, part = F.shiftright("band", step), F.shiftright("band", step + 1).alias("part")
        upper = F.col("half") % 2 == 1
        parted = edges.select("*", half.alias("half"), part)
        low = parted.where(~upper).select("part", "u", "v")
        found = materialize(connected_components(low, "part"), "band-parts")
        name = F.coalesce("component", "node").alias("component")
        placed = nodes.join(found, ["part", "node"], "left").select("part", "node", "size", "rows", name)
        sizes = placed.groupBy("part", "component").agg(F.sum("size").alias("size"))
        few = sizes.where(F.col("size") < min_size).select("part", "component")
        lists = placed.join(few, ["part", "component"]).groupBy("part", "component").agg(F.flatten(F.collect_list("rows")).alias("rows"))
        merged = sizes.join(lists, ["part", "component"], "left").select(
            (F.col("part") * 2 + 1).cast("int").alias("part"), F.col("component").alias("node"), "size", "rows"
        )
        same = nodes.select((F.col("part") * 2).cast("int").alias("part"), "node", "size", "rows")
        left, right = (found.select("part", F.col("node").alias(c), F.col("component").alias(f"{c}2")) for c in "uv")
        moved = parted.where(upper).join(left, ["part", "u"], "left").join(right, ["part", "v"], "left")
        moved = moved.select("band", "e", "w", F.coalesce("u2", "u").alias("u"), F.coalesce("v2", "v").alias("v"))
        edges = materialize(parted.where(~upper).select("band", "e", "w", "u", "v").unionByName(moved), "banded")
        # only components that an edge of the part touches are carried on
        touched = edges.select(F.shiftright("band", step).alias("part"), F.explode(F.array("u", "v")).alias("node")).distinct()
        nodes = materialize(same.unionByName(merged).join(touched, ["part", "node"], "left_semi"), "band-nodes")
    left, right = (
        nodes.select(F.col("part").alias("band"), F.col("node").alias(c), F.col("size").alias(f"{c}_size"), F.col("rows").alias(f"{c}_rows"))
        for c in "uv"
    )
    full = edges.join(left, ["band", "u"]).join(right, ["band", "v"])

    def work(table: pa.Table) -> pa.Table:
        return _work_off(table, min_size)

    return materialize(full.groupBy("band").applyInArrow(work, EVENTS), "band-events")


def _work_off(table: pa.Table, min_size: int) -> pa.Table:
    """The edges of a band one by one."""
    get = lambda c: table.column(c).to_numpy()
    band, w, e = int(table.column("band")[0].as_py()), get("w"), get("e")
    names, places = np.unique(np.concatenate([get("u"), get("v")]), return_inverse=True)
    u, v = places[: len(w)].tolist(), places[len(w) :].tolist()
    size = np.zeros(len(names), np.int64)
    size[u], size[v] = get("u_size"), get("v_size")
    rows = [None] * len(names)
    for c, at in (("u_rows", u), ("v_rows", v)):
        for k, some in zip(at, table.column(c).to_pylist()):
            rows[k] = some
    root, size = list(range(len(names))), size.tolist()
    smallest = names.tolist()
    # cluster of a component, and what it has gained in this band
    cluster = [(band, x) if n >= min_size else None for x, n in zip(smallest, size)]
    gained = {c: [0, 0.0] for c in cluster if c is not None}
    out = []

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    def joins(c, x, weight):
        gained[c][0] += size[x]
        gained[c][1] += size[x] / weight
        out.extend(("row", *c, None, None, row, None, weight, None) for row in rows[x])

    for k in np.lexsort((e, w)).tolist():
        a, b, weight = find(u[k]), find(v[k]), float(w[k])
        if size[a] < size[b]:
            a, b = b, a
        ca, cb = cluster[a], cluster[b]
        if ca is not None and cb is None:
            joins(ca, b, weight)
        elif ca is not None:
            new = (-1, int(e[k]))
            for c in (ca, cb):
                out.append(("part", *c, *new, None, *gained.pop(c), weight))
            cluster[a], gained[new] = new, [size[a] + size[b], (size[a] + size[b]) / weight]
            out.append(("born", *new, None, None, None, None, weight, None))
        elif size[a] + size[b] >= min_size:
            new = cluster[a] = (-1, int(e[k]))
            gained[new] = [0, 0.0]
            out.append(("born", *new, None, None, None, None, weight, None))
            for x in (a, b):
                joins(new, x, weight)
            rows[a] = None
        else:
            rows[a] = rows[a] + rows[b]
        root[b], rows[b] = a, None
        size[a] += size[b]
        smallest[a] = min(smallest[a], smallest[b])
    for x in range(len(names)):
        if root[x] == x and cluster[x] is not None:
            out.append(("exit", *cluster[x], None, band, smallest[x], None, None, None))
    out.extend(("part", *c, None, None, None, *g, None) for c, g in gained.items())
    kinds = [pa.string(), *[pa.int64()] * 6, pa.float64(), pa.float64()]
    columns = list(zip(*out)) or [()] * 9
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=[x.split()[0] for x in EVENTS.split(", ")])


def _followed(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (id, node, joined) and clusters (id, parent, own, began, ended) under the edge that began each cluster.

    The cluster that a band finds in a component is the one that the last band
    before left in a component of that name.
    """
    exits = events.where("kind = 'exit'").select("node", F.col("pid").alias("band"), F.struct("tag", "id").alias("left"), F.lit(1).alias("after"))
    found = events.where("tag >= 0").select(F.col("id").alias("node"), F.col("tag").alias("band")).distinct()
    entries = found.select("node", "band", F.lit(None).cast("struct<tag:bigint,id:bigint>").alias("left"), F.lit(0).alias("after"))
    before = Window.partitionBy("node").orderBy("band", "after").rowsBetween(Window.unboundedPreceding, -1)
    last = exits.unionByName(entries).withColumn("was", F.last("left", ignorenulls=True).over(before)).where("after = 0")
    link = materialize(last.select(F.col("band").alias("tag"), F.col("node").alias("id"), "was.tag", "was.id").toDF("tag", "id", "to_tag", "to_id"), "links")
    while link.where("to_tag >= 0").head(1):
        onward = link.select(F.col("tag").alias("to_tag"), F.col("id").alias("to_id"), F.col("to_tag").alias("tag2"), F.col("to_id").alias("id2"))
        jumped = link.join(onward, ["to_tag", "to_id"], "left")
        link = materialize(jumped.select("tag", "id", F.coalesce("tag2", "to_tag").alias("to_tag"), F.coalesce("id2", "to_id").alias("to_id")), "links")
    known = events.join(link.select("tag", "id", "to_id"), ["tag", "id"], "left").withColumn("id", F.coalesce("to_id", "id"))
    rows = known.where("kind = 'row'").select("id", "node", F.col("held").alias("joined"))
    held = F.sum(F.when(F.col("kind") == "part", F.col("held")))
    began = F.max(F.when(F.col("kind") == "born", F.col("held")))
    parts = known.where("kind in ('part', 'born')").groupBy("id").agg(
        F.sum("size").alias("size"), held.alias("held"), began.alias("began"), F.max("ended").alias("ended"), F.max("pid").alias("parent")
    )
    own = (
        F.when(F.col("parent").isNull(), NEVER)
        .when(F.col("began") == F.col("ended"), 0.0)  # whatever rounding left of it
        .otherwise(F.col("held") - F.col("size") / F.col("ended"))
    )
    return rows, materialize(parts.select("id", "parent", own.alias("own"), "began", "ended"), "clusters")


def _untied(rows: DataFrame, tree: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The same without clusters that end at the weight at which they began.

    What was in one belongs to the first cluster above that is not one itself. If that
    is left with a single child, it only goes on with the child, as nothing else of its
    size met at that weight; the stabilities of the two add up.
    """
    passing = F.col("began") == F.col("ended")
    if not tree.where(passing).head(1):
        return rows, tree.select("id", "parent", "own", "ended")
    above = _ends(tree.where(passing).select("id", F.col("parent").alias("to")))
    moved = lambda df, c: df.join(above.select(F.col("id").alias("x"), F.col("to").alias("y")), F.col(c) == F.col("x"), "left").withColumn(c, F.coalesce("y", c)).drop("x", "y")
    tree = materialize(moved(tree.where(F.col("parent").isNull() | ~passing), "parent"), "untied")
    single = tree.groupBy("parent").agg(F.count(F.lit(1)).alias("n"), F.first("id").alias("id")).where("n = 1 and parent is not null")
    above = _ends(single.select("id", F.col("parent").alias("to")).unionByName(above.select("id", "to")))
    tree = moved(moved(tree.withColumn("name", F.col("id")), "name"), "parent")
    tree = tree.groupBy(F.col("name").alias("id")).agg(
        F.max(F.when(F.col("id") == F.col("name"), F.col("parent"))).alias("parent"), F.sum("own").alias("own"), F.max("ended").alias("ended")
    )
    return moved(rows, "id"), materialize(tree.withColumn("parent", F.when(F.col("parent") != F.col("id"), F.col("parent"))), "clusters")


def _ends(link: DataFrame) -> DataFrame:
    """(id, to) followed to where no link begins, by doubling."""
    link = materialize(link, "links")
    while True:
        onward = link.select(F.col("id").alias("to"), F.col("to").alias("next"))
        jumped = materialize(link.join(onward, "to", "left"), "links")
        if not jumped.where("next is not null").head(1):
            return link
        link = jumped.select("id", F.coalesce("next", "to").alias("to"))


def _chosen(tree: DataFrame, local: int) -> DataFrame:
    """(id, top): clusters that are chosen or inside a chosen one, which is ``top``."""
    if tree.count() <= local:
        return tree.withColumn("one", F.lit(0)).groupBy("one").applyInArrow(_chosen_here, "id long, top long")
    inside = _inside(tree)
    state = tree.join(inside, "id").select(
        "id", F.when((F.col("own") >= F.col("inner") * SLACK) & (F.col("own") > 0), F.col("id")).alias("top"), F.col("parent").alias("up")
    )
    state = materialize(state, "tops")
    while state.where("up is not null").head(1):  # of all chosen ancestors the highest
        above = state.select(F.col("id").alias("up"), F.col("top").alias("top2"), F.col("up").alias("up2"))
        state = materialize(state.join(above, "up", "left").select("id", F.coalesce("top2", "top").alias("top"), F.col("up2").alias("up")), "tops")
    return state.where("top is not null").select("id", "top")


def _chosen_here(table: pa.Table) -> pa.Table:
    ids, own = table.column("id").to_pylist(), dict(zip(table.column("id").to_pylist(), table.column("own").to_pylist()))
    parent = dict(zip(ids, table.column("parent").to_pylist()))
    open_children = dict.fromkeys(ids, 0)
    for p in parent.values():
        if p is not None:
            open_children[p] += 1
    inner, order = dict.fromkeys(ids, 0.0), [i for i in ids if not open_children[i]]
    for i in order:  # grows: children before their parents
        p = parent[i]
        if p is not None:
            inner[p] += max(own[i], inner[i])
            open_children[p] -= 1
            if not open_children[p]:
                order.append(p)
    top: dict[int, int] = {}
    for i in reversed(order):
        above = top.get(parent[i])
        if above is not None:
            top[i] = above
        elif own[i] >= inner[i] * SLACK and own[i] > 0:
            top[i] = i
    return pa.table({"id": pa.array(list(top), pa.int64()), "top": pa.array(list(top.values()), pa.int64())})


def _inside(tree: DataFrame) -> DataFrame:
    """(id, inner): the best total of the clusters inside each cluster, by contraction of the tree.

    ``best = max(own, inner)`` goes up as ``max(floor, best + more)``; such steps can be
    put together, so a cluster with one open child can be spliced out of a chain and
    its value be found after that of the child.
    """
    counts = tree.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count(F.lit(1)).alias("open"))
    state = tree.join(counts, "id", "left").select(
        "id", "parent", "own", F.lit(0.0).alias("inner"), F.coalesce("open", F.lit(0)).cast("long").alias("open"),
        F.lit(NEVER).alias("floor"), F.lit(0.0).alias("more"),
    )
    state = materialize(state, "contraction")
    solved, spliced, step = None, [], 0
    best = F.greatest("own", "inner")
    while state.head(1):
        leaves = materialize(state.where("open = 0").select("id", "inner", best.alias("best"), "parent", F.greatest("floor", best + F.col("more")).alias("up")), "leaves")
        solved = leaves.select("id", "inner", "best") if solved is None else solved.unionByName(leaves.select("id", "inner", "best"))
        added = leaves.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.sum("up").alias("added"), F.count(F.lit(1)).alias("gone"))
        rest = state.where("open > 0").join(added, "id", "left").select(
            "id", "parent", "own", (F.col("inner") + F.coalesce("added", F.lit(0.0))).alias("inner"),
            (F.col("open") - F.coalesce("gone", F.lit(0))).alias("open"), "floor", "more",
        )
        rest = materialize(rest, "contraction")
        # of two neighbours in a chain, which one goes is drawn anew in every step
        drawn = F.xxhash64("id", F.lit(step)) % 2 == 0
        single = rest.where("open = 1").select("id", "parent", "own", "inner", "floor", "more", drawn.alias("drawn"))
        above = single.where(~F.col("drawn")).select(F.col("id").alias("parent"))
        out = materialize(single.where("drawn").join(above, "parent", "left_semi").drop("drawn"), "spliced")
        renamed = out.select(*[F.col(c).alias(f"{c}_x") for c in out.columns])
        kept = rest.join(out.select("id"), "id", "left_anti").join(renamed, F.col("parent") == F.col("id_x"), "left")
        gone = F.col("id_x").isNotNull()
        floor2 = F.greatest("floor_x", F.col("more_x") + F.greatest("own_x", F.col("inner_x") + F.col("floor")))
        more2 = F.col("more_x") + F.col("inner_x") + F.col("more")
        kept = materialize(kept, "contraction-joined")
        spliced.append(kept.where(gone).select(F.col("id_x").alias("id"), F.col("own_x").alias("own"), F.col("inner_x").alias("inner"), F.col("id").alias("child"), "floor", "more"))
        state = materialize(
            kept.select(
                "id", F.when(gone, F.col("parent_x")).otherwise(F.col("parent")).alias("parent"), "own", "inner", "open",
                F.when(gone, floor2).otherwise(F.col("floor")).alias("floor"), F.when(gone, more2).otherwise(F.col("more")).alias("more"),
            ),
            "contraction",
        )
        step += 1
    for some in reversed(spliced):
        child = solved.select(F.col("id").alias("child"), F.col("best").alias("child_best"))
        inner = F.col("inner") + F.greatest("floor", F.col("child_best") + F.col("more"))
        found = some.join(child, "child").select("id", "own", inner.alias("inner"))
        solved = solved.unionByName(found.select("id", "inner", F.greatest("own", "inner").alias("best")))
        solved = materialize(solved, "solved")
    return solved.select("id", "inner")
