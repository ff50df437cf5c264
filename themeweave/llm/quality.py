"""A quality classifier from overlapping heuristics.

Labellers vote bad (0), nothing (1) or good (2) on every document. Counts of all vote
patterns, over all documents, are the whole evidence: expectation-maximisation
estimates from them how often each labeller is right in either class and how common
the classes are. The posterior labels of a bounded sample of documents then train a
linear scorer on hashed words and votes, and the scorer decides about all documents.
There are two such models, for quality and for toxicity; a document is kept if it
scores good in both.

Two of the toxicity labellers use word lists learned from ``labels``: each from one
half of at most ``LABELLED`` labelled documents, those of least hash. The scorers see
at most ``SAMPLE`` documents, chosen alike. Everything else covers all rows.

Defined results: null, empty and blank texts are rejected, with scores 0; a model of an
empty table has scores of one half for all others. A null doc_id is scored like others. Rows that repeat are counted and scored as often. Without
labels the learned lists are empty and their labellers are silent. Columns other than
those named are ignored by ``classify`` and kept by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Block, blocks, cut, sums_between

LABELLED = 8_000
SAMPLE = 8_000
FEATURES = 1 << 16
BAD, SILENT, GOOD = 0, 1, 2
SLIP = 0.002  # the labellers are written so that they rarely call a good document bad

# Words that insult, as a starting point; the learned lists add to them.
INSULTS = "idiot moron stupid scum loser clown trash pathetic worthless disgusting".split()


def _table(characters: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(characters)] = 1
    return out


_SYMBOLS, _SHOUTS, _BARS = _table(b"*#$%&^~@<>{}[]=_\\"), _table(b"!"), _table(b"|")
_UPPER, _LETTER = _table(bytes(range(65, 91))), _table(bytes([*range(65, 91), *range(97, 123)]))
_NEWLINE = _table(b"\n").astype(bool)
_EDGES = _table(b".,;:!?\"'()*#$%&|-").astype(bool)

STYLE = ["symbols", "shouting", "bars", "capitals", "variety", "lines", "word_length"]
TOXIC = ["insults", "learned_even", "learned_odd"]


def _votes(value: np.ndarray, bad: np.ndarray, good: np.ndarray) -> np.ndarray:
    return np.where(bad, BAD, np.where(good, GOOD, SILENT)).astype(np.int8)


def trimmed(block: Block) -> Block:
    """The block with punctuation taken off both ends of its words; a word of nothing else stays."""
    start, end = block.start.copy(), block.end.copy()
    for _ in range(3):
        start += _EDGES[block.data[start]] & (end - start > 1)
        end -= _EDGES[block.data[end - 1]] & (end - start > 1)
    return Block(block.low, block.data, block.offsets, start, end, block.first)


def distinct(hashes: np.ndarray, owner: np.ndarray, documents: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of each document, sorted, and how many there are."""
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.bincount(owner[new], minlength=documents)


def _word_hash(words: list[str]) -> np.ndarray:
    column = pa.array([" ".join(words)])
    return np.unique(next(blocks(column)).hashes(lower=True)) if words else np.zeros(0, np.uint64)


@dataclass
class Read:
    """What the models see of a block of documents."""

    votes: np.ndarray  # documents by labellers, style first
    words: np.ndarray  # distinct word hashes
    counts: np.ndarray  # distinct words per document


def read(block: Block, lists: list[np.ndarray]) -> Read:
    data, n = block.data, block.counts()
    low, high = block.offsets[:-1], block.offsets[1:]
    size = np.maximum(high - low, 1)
    symbols, shouts, bars = (sums_between(t[data], low, high) / size for t in (_SYMBOLS, _SHOUTS, _BARS))
    letters = sums_between(_LETTER[data], low, high)
    capitals = sums_between(_UPPER[data], low, high) / np.maximum(letters, 1)
    words, counts = distinct(trimmed(block).hashes(lower=True), block.owner(), block.documents)
    variety = counts / np.maximum(n, 1)
    lined = cut(block.low, block.offsets, data, _NEWLINE)
    _, different = distinct(lined.hashes(), lined.owner(), block.documents)
    lines = lined.counts()
    fresh = different / np.maximum(lines, 1)
    length = sums_between(block.end - block.start, block.first[:-1], block.first[1:]) / np.maximum(n, 1)
    style = [
        _votes(symbols, symbols > 0.02, symbols < 0.005),
        _votes(shouts, shouts > 0.02, shouts < 0.005),
        _votes(bars, bars > 0.02, bars < 0.002),
        _votes(capitals, (capitals > 0.4) & (letters >= 40), capitals < 0.2),
        _votes(variety, (variety < 0.4) & (n >= 20), (variety > 0.5) | (n < 20)),
        _votes(fresh, (fresh < 0.5) & (lines >= 4), fresh > 0.8),
        _votes(length, ((length > 10) | (length < 3)) & (n >= 20), (length > 4) & (length < 9)),
    ]
    ends = np.concatenate([[0], np.cumsum(counts)])
    toxic = []
    for known in lists:
        at = np.minimum(np.searchsorted(known, words), max(len(known) - 1, 0))
        hit = known[at] == words if len(known) else np.zeros(len(words), bool)
        found = sums_between(hit.astype(np.int64), ends[:-1], ends[1:])
        toxic.append(_votes(found, found > 0, np.full(len(found), len(known) > 0)))
    return Read(np.stack(style + toxic, axis=1), words, counts)


def _coded(votes: np.ndarray) -> np.ndarray:
    return (votes.astype(np.int64) * 3 ** np.arange(votes.shape[1])).sum(axis=1)


def _decoded(codes: np.ndarray, labellers: int) -> np.ndarray:
    return codes[:, None] // 3 ** np.arange(labellers) % 3


@dataclass
class Labellers:
    """What is believed of the labellers: shares of the classes, good first, and each one's rates of its votes in them."""

    share: np.ndarray
    rates: np.ndarray  # class, labeller, vote

    def members(self, votes: np.ndarray) -> np.ndarray:
        """Probabilities of the classes given votes, be they of a pattern that was seen before or not."""
        logs = np.einsum("plv,clv->pc", _said(votes), np.log(self.rates)) + np.log(self.share)
        out = np.exp(logs - logs.max(axis=1, keepdims=True))
        return out / out.sum(axis=1, keepdims=True)


def _said(votes: np.ndarray) -> np.ndarray:
    return np.stack([votes == v for v in (BAD, SILENT, GOOD)], axis=2).astype(float)  # patterns, labellers, votes


def estimate(votes: np.ndarray, weight: np.ndarray, rounds: int = 200) -> Labellers:
    """Labellers' rates from vote patterns and how often each came, by expectation-maximisation.

    Besides the good class there is one bad class per labeller, the kind of bad that
    it is for, as one kind is seen by few labellers and several see the same. Given
    the class, labellers err independently, each with its own rates. It starts from
    "bad of the kinds that are claimed", and rates are smoothed by one vote each way,
    which is all there is without patterns.
    One prior is needed: no labeller says bad of more than ``SLIP`` of the good.
    """
    claimed = (votes == BAD).astype(float)
    some = claimed.any(axis=1)
    good = np.where(some, 0.05, 0.95)
    kinds = np.where(some[:, None], claimed, 1.0)
    member = np.concatenate([good[:, None], (1 - good)[:, None] * kinds / kinds.sum(axis=1, keepdims=True)], axis=1)  # patterns, classes
    said = _said(votes)
    for _ in range(rounds):
        mass = weight[:, None] * member
        share = (mass.sum(axis=0) + 1) / (mass.sum() + mass.shape[1])
        rates = (np.einsum("pc,plv->clv", mass, said) + 1) / (mass.sum(axis=0)[:, None, None] + 3)
        rates[0, :, BAD] = np.minimum(rates[0, :, BAD], SLIP)
        found = Labellers(share, rates)
        new = found.members(votes)
        moved, member = np.abs(new - member).max(initial=0.0), new
        if moved < 1e-9:
            break
    return found


def posterior(votes: np.ndarray, weight: np.ndarray, rounds: int = 200) -> np.ndarray:
    """Probability of good for each vote pattern."""
    return estimate(votes, weight, rounds).members(votes)[:, 0]


def _columns(read_: Read, labellers: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows: feature, value, and each document's number of features.

    Every distinct word weighs one over the root of their number; votes weigh 1.
    """
    documents, votes = len(read_.counts), read_.votes[:, labellers]
    k = votes.shape[1]
    each = read_.counts + k
    ends = np.cumsum(each)
    feature, value = np.empty(ends[-1] if documents else 0, np.int64), np.empty(ends[-1] if documents else 0)
    first = ends - each
    at = (first[:, None] + np.arange(k)).ravel()
    feature[at], value[at] = FEATURES + (np.arange(k) * 3 + votes).ravel(), 1.0
    words = np.ones(len(feature), bool)
    words[at] = False
    feature[words] = (read_.words >> np.uint64(48)).astype(np.int64)
    value[words] = np.repeat(1 / np.sqrt(np.maximum(read_.counts, 1)), read_.counts)
    return feature, value, each


def train(feature: np.ndarray, value: np.ndarray, each: np.ndarray, label: np.ndarray, rounds: int = 150, ridge: float = 1e-4) -> np.ndarray:
    """Weights (and a bias, last) of a logistic scorer of soft labels."""
    weights = np.zeros(FEATURES + 3 * max(len(STYLE), len(TOXIC)) + 1)
    if not len(each):
        return weights
    owner = np.repeat(np.arange(len(each)), each)
    square = np.full(len(weights), 1e-8)
    # Both classes weigh the same.
    mass = np.array([(1 - label).sum(), label.sum()]) + 1e-9
    importance = (1 - label) / mass[0] + label / mass[1]
    for _ in range(rounds):
        z = np.bincount(owner, weights[feature] * value, minlength=len(each)) + weights[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - label) * importance
        gradient = np.bincount(feature, error[owner] * value, minlength=len(weights)) + ridge * weights
        gradient[-1] = error.sum()
        square += gradient**2
        weights -= 0.5 * gradient / np.sqrt(square)
    return weights


def scored(read_: Read, labellers: slice, weights: np.ndarray) -> np.ndarray:
    feature, value, each = _columns(read_, labellers)
    ends = np.cumsum(each)
    z = sums_between(weights[feature] * value, ends - each, ends) + weights[-1]
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


_MODELS = (slice(0, len(STYLE)), slice(len(STYLE), len(STYLE) + len(TOXIC)))


def _least(df: DataFrame, n: int, *columns: str) -> DataFrame:
    """The rows of the n least hashes of doc_id; at most n rows."""
    return df.where("doc_id is not null").select("doc_id", *columns).orderBy(F.xxhash64("doc_id"), "doc_id", *columns).limit(n)


def toxic_words(docs: DataFrame, labels: DataFrame, least: int = 4, share: float = 0.02, precision: float = 0.95) -> list[np.ndarray]:
    """Hashes of words that almost only toxic documents hold, from either half of the labelled sample.

    A word must be in ``least`` toxic documents and in ``share`` of them, lest the
    words of one much-copied document be listed.
    """
    docs = docs.select("doc_id", "text")
    marked = labels.where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    sample = _least(marked, LABELLED, "toxic").withColumnRenamed("doc_id", "id")  # bounded by LABELLED rows
    rows = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select(
        "toxic", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int").alias("half"), F.col("text").cast("string").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, half = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for block in blocks(batch.column(2)):
                words, counts = distinct(trimmed(block).hashes(lower=True), block.owner(), block.documents)
                owner = np.repeat(np.arange(block.documents), counts) + block.low
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.view(np.int64)), pa.array(half[owner]), pa.array(toxic[owner].astype(np.int64))], names=["word", "half", "toxic"]
                )

    counted = rows.mapInArrow(run, "word long, half int, toxic long").groupBy("word", "half").agg(F.sum("toxic").alias("bad"), F.count("*").alias("n"))
    often = max(least, share * sample.where("toxic = 1").count() / 2)
    found = counted.where((F.col("bad") >= often) & (F.col("bad") >= precision * F.col("n"))).toArrow()
    words, half = found.column("word").to_numpy().view(np.uint64), found.column("half").to_numpy()
    return [np.unique(words[half == k]) for k in (0, 1)]


def _patterns(lists: list[np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0)):
                if block.counts().any():
                    seen = read(block, lists).votes[block.counts() > 0]
                    code, n = np.unique(_coded(seen), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], names=["pattern", "n"])

    return run


@dataclass
class Models:
    lists: list[np.ndarray]
    labellers: list[Labellers]  # of either model
    weights: list[np.ndarray]

    def believed(self, votes: np.ndarray, k: int) -> np.ndarray:
        return self.labellers[k].members(votes[:, _MODELS[k]])[:, 0]


def fit(docs: DataFrame, labels: DataFrame) -> Models:
    """Both models of ``docs`` (doc_id, text), with word lists from ``labels`` (doc_id, toxic)."""
    docs = docs.select("doc_id", "text")
    lists = [_word_hash(INSULTS), *toxic_words(docs, labels)]
    texts = docs.select(F.col("text").cast("string").alias("text"))
    # At most 3 to the power of the number of labellers rows, whatever the corpus.
    seen = texts.mapInArrow(_patterns(lists), "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).toArrow()
    votes, n = _decoded(seen.column("pattern").to_numpy(), len(STYLE) + len(TOXIC)), seen.column("n").to_numpy().astype(float)
    labellers = []
    for some in _MODELS:
        codes, place = np.unique(_coded(votes[:, some]), return_inverse=True)
        labellers.append(estimate(_decoded(codes, some.stop - some.start), np.bincount(place, n, minlength=len(codes))))
    models = Models(lists, labellers, [])
    sample = _least(docs.select("doc_id"), SAMPLE).distinct().withColumnRenamed("doc_id", "id")
    rows = docs.join(F.broadcast(sample), F.col("doc_id") == F.col("id")).select(F.col("text").cast("string").alias("text"), F.xxhash64("id").alias("key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(0)):
                got = read(block, lists)
                ends = np.concatenate([[0], np.cumsum(got.counts)])
                short = (got.words >> np.uint64(48)).astype(np.uint16)
                data = [(short[a:b].tobytes()) for a, b in zip(ends[:-1], ends[1:])]
                keep = np.flatnonzero(block.counts() > 0)
                key = batch.column(1).slice(block.low, block.documents).take(pa.array(keep))
                yield pa.RecordBatch.from_arrays([pa.array(_coded(got.votes)[keep]), pa.array([data[k] for k in keep], pa.binary()), key], names=["pattern", "words", "key"])

    # An id may be on any number of rows; as many rows as ids are drawn.
    drawn = rows.mapInArrow(run, "pattern long, words binary, key long").orderBy("key", "pattern", "words").limit(SAMPLE).toArrow()
    # A fixed order, so that refitting gives the same weights.
    order = sorted(range(len(drawn)), key=lambda k: (drawn["pattern"][k].as_py(), drawn["words"][k].as_py()))
    words = [np.frombuffer(drawn["words"][k].as_py(), np.uint16) for k in order]
    votes = _decoded(drawn["pattern"].to_numpy()[order] if order else np.zeros(0, np.int64), len(STYLE) + len(TOXIC))
    flat = np.concatenate(words).astype(np.uint64) << np.uint64(48) if words else np.zeros(0, np.uint64)
    got = Read(votes, flat, np.array([len(w) for w in words], np.int64))
    for k, some in enumerate(_MODELS):
        label = models.believed(votes, k) if len(votes) else np.zeros(0)
        models.weights.append(train(*_columns(got, some), label))
    return models


_OUT = "doc_id long, quality double, toxicity double, score double, toxic_score double, kept boolean"


def classify(docs: DataFrame, models: Models) -> DataFrame:
    """One row per row of ``docs``: posterior quality and toxicity of its votes, both scorers' results, kept."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                got, some = read(block, models.lists), block.counts() > 0
                if some.any():
                    believed = [np.where(some, models.believed(got.votes, k), 0.0) for k in (0, 1)]
                    scores = [np.where(some, scored(got, _MODELS[k], models.weights[k]), 0.0) for k in (0, 1)]
                else:
                    believed = scores = [np.zeros(len(some))] * 2
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(block.low, block.documents),
                        *(pa.array(x) for x in (believed[0], np.where(some, 1 - believed[1], 0.0), scores[0], np.where(some, 1 - scores[1], 0.0))),
                        pa.array(some & (scores[0] >= 0.5) & (scores[1] >= 0.5)),
                    ],
                    names=["doc_id", "quality", "toxicity", "score", "toxic_score", "kept"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _OUT)


def _good(models: Models, at: int):
    """Batches with their good rows only; column ``at`` is the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for block in blocks(batch.column(at)):
                some = block.counts() > 0
                if some.any():
                    got = read(block, models.lists)
                    for k in (0, 1):
                        some = some & (scored(got, _MODELS[k], models.weights[k]) >= 0.5)
                kept.append(some)
            if kept:
                yield batch.filter(pa.array(np.concatenate(kept)))

    return run


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, unchanged."""
    return docs.mapInArrow(_good(fit(docs, labels), docs.columns.index("text")), docs.schema)
