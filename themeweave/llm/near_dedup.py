"""Near duplicates by a chosen-path set similarity join.

A document is the set of its word shingles. Independent trees branch documents by
minwise tokens: at every level of a tree a document follows the tokens of its set
that further random orders put first, and two documents share a token with the
probability of their Jaccard similarity. A node of at most ``NODE`` documents is
compared exhaustively on sketches; a larger one branches again, and one that is
still larger at the last level is taken as one family. What this links are
candidate families. Inside them full sets decide:

* a family of bounded total size is compared exhaustively in one task;
* a larger one is dealt into blocks. Every block is compared in itself, then with
  the family's best connected document, and at last everything that this has not
  reached is compared with all of its blocks. So no link is lost, and a crowd of
  copies costs about as many comparisons as it has rows.

Only spanning forests leave a task, never all pairs.

A pair at threshold t is missed by the trees with probability about
``(1 - t**depth)**TREES``: 1e-10 where its nodes are small at once, 1e-4 (t = 0.85) to
2e-3 (t = 0.8) where all of them need four tokens.

Defined results: null, empty and blank texts have no set and no links. A row with
a null doc_id has no links and a null component. Rows that repeat a doc_id are one
vertex that has the links of all of them. Columns other than doc_id and text are
ignored by ``near_duplicates`` and kept by ``drop_near``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import materialize
from .hash_arrays import HashArrays, find_ids, list_ids, rows_by_id
from .words import Block, blocks, mix, window_hashes

TREES = 12
DEPTHS = (1, 2, 4)  # tokens that a document's path has at each level
TOKENS = 48  # minwise tokens of a document, which the trees choose from
NODE = 64
FAMILY = 150_000  # shingles that one task compares exhaustively

_SEEDS = mix(np.arange(1, 2 * TOKENS + 1, dtype=np.uint64)).reshape(2, TOKENS) | np.uint64(1)
# The l-th token of tree t's paths; no two trees share a token, so they miss independently.
_CHOICE = [[t * DEPTHS[-1] + level for level in range(DEPTHS[-1])] for t in range(TREES)]


def shingle_sets(block: Block, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all documents, sorted per document, and each document's range."""
    hashes, counts = block.hashes(lower=True), block.counts()
    at, shingles = block.windows(hashes, size)
    owner = np.repeat(np.arange(block.documents), np.maximum(counts - size + 1, 0))
    for length in range(1, size):
        short = np.flatnonzero(counts == length)
        if len(short):
            owner = np.concatenate([owner, short])
            shingles = np.concatenate([shingles, window_hashes(hashes, block.first[short], length)])
    order = np.lexsort((shingles, owner))
    owner, shingles = owner[order], shingles[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (shingles[1:] != shingles[:-1])
    owner, shingles = owner[new], shingles[new]
    return shingles, np.searchsorted(owner, np.arange(block.documents + 1))


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as fixed-width binary values."""
    width = rows.shape[1] * rows.itemsize
    offsets = (np.arange(len(rows) + 1) * width).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows))])


_SKETCH = "doc_id long, n_shingles long, a long, b long, mins binary"


def _sketch(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                shingles, ends = shingle_sets(block, size)
                n = np.diff(ends)
                some = np.flatnonzero(n)
                mins = np.full((block.documents, TOKENS), 0xFFFFFFFF, np.uint32)
                a, b = np.zeros(block.documents, np.uint64), np.zeros(block.documents, np.uint64)
                if len(some):
                    at = ends[some]
                    for k in range(TOKENS):
                        mins[some, k] = np.minimum.reduceat((shingles * _SEEDS[0, k] + _SEEDS[1, k]) >> np.uint64(32), at)
                    a[some] = np.add.reduceat(shingles, at)
                    b[some] = np.add.reduceat(mix(shingles), at)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(block.low, block.documents), pa.array(n), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), _binary(mins)],
                    names=["doc_id", "n_shingles", "a", "b", "mins"],
                )

    return run


def sketches(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, signature (a, b) of the set, its minwise tokens."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_sketch(size), _SKETCH)


def _branches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes of all levels of all trees that a document would pass."""
    for batch in batches:
        mins = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, TOKENS).astype(np.uint64)
        for t, choice in enumerate(_CHOICE):
            node, path = np.full(len(mins), t + 1, np.uint64), []
            for level, token in enumerate(choice):
                node = mix(node ^ mix(mins[:, token] + np.uint64(level << 32)))
                if level + 1 in DEPTHS:
                    path.append(pa.array(node.view(np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), *path], names=["doc_id", *_PATH])


_PATH = [f"node{depth}" for depth in DEPTHS]
_NODES = "doc_id long, " + ", ".join(f"{name} long" for name in _PATH)


def _runs(key: np.ndarray) -> np.ndarray:
    """Ends of the runs of equal values, with a leading 0."""
    return np.concatenate([[0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]]) if len(key) else np.zeros(1, int)


def _whole_runs(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.Table]:
    """Batches of sorted rows, cut anew so that no run of equal keys is divided."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        key = batch.column(column).to_numpy()
        cut = int(np.searchsorted(key, key[-1]))
        if cut or (held and held[-1].column(column)[-1].as_py() != key[0]):
            held.append(batch.slice(0, cut))
            yield pa.Table.from_batches([x for x in held if len(x)])
            held = []
        held.append(batch.slice(cut))
    if held:
        yield pa.Table.from_batches(held)


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index of each vertex's component."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        if (root[i] == root[j]).all():
            break
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while (root[root] != root).any():
            root = root[root]
    return root


def _likely(threshold: float):
    """Forest edges of a small node's documents whose sketches agree often enough.

    The bound lies five standard deviations below what the threshold would give.
    """
    least = int(np.floor(TOKENS * threshold - 5 * np.sqrt(TOKENS * threshold * (1 - threshold))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_runs(batches, 2):
            table = table.combine_chunks()
            docs = table.column(0).to_numpy()
            mins = np.frombuffer(b"".join(table.column(1).to_pylist()), np.uint32).reshape(-1, TOKENS)
            ends = _runs(table.column(2).to_numpy())
            sizes = np.diff(ends)
            pairs = []
            for size in np.unique(sizes[sizes > 1]):
                i, j = np.triu_indices(size, 1)
                at = ends[:-1][sizes == size]
                for some in np.array_split(at, 1 + len(at) * len(i) // 200_000):
                    left, right = (some[:, None] + i).ravel(), (some[:, None] + j).ravel()
                    same = (mins[left] == mins[right]).sum(axis=1) >= least
                    pairs.append((left[same], right[same]))
            if pairs:
                root = _forest(len(docs), *map(np.concatenate, zip(*pairs)))
                moved = np.flatnonzero(root != np.arange(len(root)))
                yield pa.RecordBatch.from_arrays([pa.array(docs[root[moved]]), pa.array(docs[moved])], names=["u", "v"])

    return run


def candidates(reps: DataFrame, threshold: float) -> DataFrame:
    """Edges (u, v) between documents that one of the trees brings together. reps: doc_id, mins."""
    found, small = [], []
    rows = reps.select("doc_id", "mins").mapInArrow(_branches, _NODES)
    for level, name in enumerate(_PATH):
        rows = materialize(rows, "branches")
        sizes = rows.groupBy(name).agg(F.count("*").alias("n"), F.min("doc_id").alias("least")).where("n > 1")
        sizes = materialize(sizes, "nodes")
        met = rows.join(sizes.hint("merge"), name)
        small.append(met.where(F.col("n") <= NODE).select("doc_id", F.col(name).alias("node")))
        if not sizes.where(F.col("n") > NODE).head(1):
            break
        rows = met.where(F.col("n") > NODE)
        if level == len(DEPTHS) - 1:
            found.append(rows.where("least < doc_id").select(F.col("least").alias("u"), F.col("doc_id").alias("v")))
        else:
            rows = rows.select("doc_id", *_PATH[level + 1 :])
    nodes = small[0]
    for more in small[1:]:
        nodes = nodes.unionByName(more)
    dealt = nodes.hint("merge").join(reps.select("doc_id", "mins"), "doc_id").select("doc_id", "mins", "node").repartition("node")
    edges = dealt.sortWithinPartitions("node").mapInArrow(_likely(threshold), "u long, v long")
    for more in found:
        edges = edges.unionByName(more)
    return edges


def _sets(size: int, members: HashArrays):
    """Sets of the documents that are in a family, looked up so that no text is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, (family,) = find_ids(batch.column(0), members)
            some = pa.array(np.flatnonzero(found))
            ids, texts, family = batch.column(0).take(some), batch.column(1).take(some), pa.array(family[found].view(np.int64))
            for block in blocks(texts):
                shingles, ends = shingle_sets(block, size)
                values = pa.Array.from_buffers(pa.large_binary(), block.documents, [None, pa.py_buffer(ends * 8), pa.py_buffer(shingles)])
                yield pa.RecordBatch.from_arrays([*(c.slice(block.low, block.documents) for c in (ids, family)), values.cast(pa.binary())], names=["doc_id", "family", "tokens"])

    return run


def _linked(percent: int):
    """Forest edges of each group between documents with ``100 * common >= percent * union``.

    Documents that are not ``chosen`` are compared with chosen ones only. Gives the
    number of links each vertex has as well, with v = u.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_runs(batches, 0):
            docs, chosen = table.column("doc_id").to_numpy(), table.column("chosen").to_numpy(zero_copy_only=False)
            family = table.column("family").to_numpy()
            tokens = table.column("tokens").combine_chunks()
            ends = _runs(table.column(0).to_numpy())
            out = []
            for low, high in zip(ends[:-1], ends[1:]):
                if high - low < 2 or not chosen[low:high].any():
                    continue
                sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in tokens.slice(low, high - low)]
                i, j = _compared(sets, chosen[low:high], percent)
                differ = docs[low + i] != docs[low + j]
                i, j = i[differ], j[differ]
                if len(i):
                    root = _forest(high - low, i, j)
                    degree = np.bincount(np.concatenate([i, j]), minlength=high - low)
                    k = np.flatnonzero(degree)
                    out.append((np.full(len(k), family[low]), docs[low + root[k]], docs[low + k], degree[k]))
            if out:
                columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)]
                yield pa.RecordBatch.from_arrays(columns, names=["family", "u", "v", "links"])

    return run


def _compared(sets: list[np.ndarray], chosen: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of linked sets, by products of 0/1 matrices over the tokens that two or more sets share."""
    n = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), n)
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[token] > 1
    owner, token = owner[shared], (np.cumsum(times > 1) - 1)[token[shared]]
    rows = np.flatnonzero(chosen)
    common = np.zeros((len(rows), len(sets)), np.float64)
    order = np.argsort(token, kind="stable")
    owner, token = owner[order], token[order]
    tokens = int(token[-1]) + 1 if len(token) else 0
    width = min(tokens, max(1, (1 << 22) // len(sets)))
    for low in range(0, tokens, max(width, 1)):
        a, b = np.searchsorted(token, [low, low + width])
        held = np.zeros((len(sets), width), np.float32)
        held[owner[a:b], token[a:b] - low] = 1
        common += held[rows] @ held.T
    union = n[rows][:, None] + n[None, :] - common
    k, j = np.nonzero((100 * common >= percent * union) & (common > 0))
    i = rows[k]
    once = (i < j) | ~chosen[j]
    return i[once], j[once]


_LINK = "family long, u long, v long, links long"


def _confirm(groups: DataFrame, percent: int) -> DataFrame:
    """groups: g (long), doc_id, family, tokens, chosen."""
    dealt = groups.select("g", "doc_id", "family", "tokens", "chosen").repartition("g").sortWithinPartitions("g")
    return materialize(dealt.mapInArrow(_linked(percent), _LINK), "links")


def _components(edges: DataFrame) -> DataFrame:
    pairs = edges.select(F.lit(0).alias("key"), "u", "v")
    return materialize(connected_components(pairs, "key").select("node", "component"), "components")


def links(docs: DataFrame, families: DataFrame, sizes: DataFrame, size: int, percent: int) -> DataFrame:
    """Forest edges (u, v) of the exact links inside candidate families.

    families: node, component; sizes: doc_id, n_shingles.
    """
    members = families.select(F.col("node").alias("doc_id"), F.col("component").alias("family"))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = list_ids(members, "members")
    sets = materialize(texts.where("doc_id is not null").mapInArrow(_sets(size, known), "doc_id long, family long, tokens binary"), "sets")
    total = members.join(sizes.select("doc_id", "n_shingles"), "doc_id").groupBy("family").agg(F.sum("n_shingles").alias("total"))
    parts = materialize(total.select("family", F.ceil(F.col("total") / FAMILY).cast("int").alias("parts")), "parts")
    spread = sets.join(parts, "family").select(
        "*", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias("part")
    )
    group = F.xxhash64("family", "part").alias("g")
    own = _confirm(spread.select(group, "*", F.lit(True).alias("chosen")), percent)
    edges = own.select("u", "v")
    crowds = parts.where("parts > 1")
    if not crowds.head(1):
        return edges
    spread = materialize(spread.where("parts > 1"), "crowds")
    every = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    # The best connected document of each crowd against all of its blocks.
    best = own.join(crowds, "family").groupBy("family").agg(F.max(F.struct("links", "v")).getField("v").alias("doc_id"))
    pivot = spread.join(best, ["family", "doc_id"], "left_semi").select("doc_id", "family", "tokens", every, F.lit(True).alias("chosen"))
    others = spread.select("doc_id", "family", "tokens", "part", F.lit(False).alias("chosen"))
    around = _confirm(pivot.unionByName(others).select(group, "*"), percent)
    edges = edges.unionByName(around.select("u", "v"))
    # What neither links to it nor hangs together, in its block, with something that does: in slices, against all blocks.
    inside = own.join(crowds, "family").select("family", F.col("v").alias("doc_id"), F.col("u").alias("label")).distinct()
    labelled = spread.join(inside, ["family", "doc_id"], "left").withColumn("label", F.coalesce("label", "doc_id"))
    linked = around.select("family", F.col("v").alias("doc_id")).distinct()
    reached = labelled.select("family", "doc_id", "label").join(linked, ["family", "doc_id"]).select("family", "label").distinct()
    rest = labelled.join(materialize(reached, "reached"), ["family", "label"], "left_anti")
    rest = materialize(rest.select("doc_id", "family", "tokens", "parts"), "rest")
    cuts = rest.groupBy("family").agg(F.ceil(F.sum(F.length("tokens")) / (8 * FAMILY)).cast("int").alias("cuts"))
    cuts = materialize(cuts, "cuts")
    slices = rest.join(cuts, "family").select(
        "doc_id", "family", "tokens", F.pmod(F.xxhash64("doc_id"), F.col("cuts")).cast("int").alias("slice"), every, F.lit(True).alias("chosen")
    )
    blocks_ = others.join(cuts, "family").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)))
    final = slices.unionByName(blocks_.select("doc_id", "family", "tokens", "slice", "part", "chosen"))
    return edges.unionByName(_confirm(final.select(F.xxhash64("family", "part", "slice").alias("g"), "*"), percent).select("u", "v"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    Links are pairs with ``100 * common >= percent * union`` over shingles of
    ``size`` words, confirmed on full sets.
    """
    drawn = materialize(sketches(docs, size), "sketches")
    some = drawn.where("n_shingles > 0 and doc_id is not null")
    same = ["a", "b", "n_shingles"]
    first = materialize(some.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "first")
    reps = materialize(some.join(first.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), "reps")
    families = _components(candidates(reps.select("doc_id", "mins"), percent / 100))
    found = links(docs, families, reps, size, percent)
    copies = some.join(first.where("n > 1"), same).where("doc_id <> rep").select(F.col("rep").alias("u"), F.col("doc_id").alias("v"))
    classes = _components(found.unionByName(copies))
    component = F.coalesce("component", "doc_id")
    return drawn.join(classes.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )


def drop_near(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document, that of the smallest doc_id, of each group of near duplicates."""
    dropped = near_duplicates(docs, size, percent).where("not kept and doc_id is not null").select("doc_id").distinct()
    return rows_by_id(docs, list_ids(materialize(dropped, "dropped"), "dropped-ids"), inside=False)
