"""Secrets by inferred credential grammars.

Base patterns find credentials of known kinds. The distinct ones, at most ``EXAMPLES``
of each kind by hash, are the labelled examples. They are laid out as a prefix tree, and
states of one depth are merged, with the subtrees below them, where a likelihood ratio
test does not tell their continuations apart. That leaves a probabilistic automaton per
kind that knows prefixes, separators, alphabets and, as states keep their depth, lengths.
Ordinary words, at most ``EXAMPLES`` of them, chosen by hash, give the automaton of
everything else; its states may be merged at any depth. Every candidate, a run of
``SHORTEST`` key characters or more, is scored by the best kind's log-likelihood over that
of ordinary words. Candidates that gain ``GAIN`` nats per character and ``SURE`` in all are
spans of kind ``learned``.

Defined results: null and empty texts have no spans. Without examples nothing is
learned. Rows are scored one by one, so ties and repeated rows are alike. Learned
spans do not overlap base spans. Of an example longer than ``LONGEST`` the tree holds the
beginning, without an end. Columns other than doc_id and text are ignored. Positions
are code points, ends exclusive.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import blocks, cut, spans

ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LONG_HEX = re.compile(r"[0-9a-f]{32,}")  # runs are taken whole, so short ones can be passed over
KINDS = ["assign", "access", "hex", "learned"]

SHORTEST = 8
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{SHORTEST},}}")
EXAMPLES = 2_000
LONGEST = 512  # characters of an example that the tree holds; a longer one has no end in it
ALPHA = 0.01  # of the compatibility test
RARE = 2  # expected visits below which symbols are taken together in the test
REMEMBERED = 200_000  # candidates whose verdict a worker keeps
GAIN = 0.75
SURE = 12.0  # nats that a candidate must gain in all


def _table(pattern: bytes) -> np.ndarray:
    return np.array([re.fullmatch(pattern, bytes([b])) is not None for b in range(256)])


_KEY, _HEX = (_table(p) for p in (rb"[A-Za-z0-9+/_=-]", rb"[0-9a-f]"))


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(kind number, start, end, credential) of the base patterns."""
    out = []
    if ":" in text or "=" in text:
        out += [(0, m.start(), m.end(), m[1]) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    if "AKIA" in text:
        out += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    out += [(2, m.start(), m.end(), m[0]) for m in LONG_HEX.finditer(text)]
    return out


def worth_reading(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Documents that may hold a base match or a candidate."""
    keys, hexes = cut(0, offsets, data, ~_KEY), cut(0, offsets, data, ~_HEX)
    long = keys.end - keys.start >= SHORTEST
    raw, access, at = data.tobytes(), [], -1
    while (at := raw.find(b"AKIA", at + 1)) >= 0:
        access.append(at)
    signs = np.flatnonzero((data == 58) | (data == 61))
    places = [keys.start[long], hexes.start[hexes.end - hexes.start >= 32], signs, np.array(access, np.int64)]
    out = np.zeros(len(offsets) - 1, bool)
    out[np.searchsorted(offsets, np.concatenate(places), "right") - 1] = True
    return out


def folded(text: str) -> str:
    """Keys in capitals only are scored by the format of their small letters."""
    return text.lower() if text.isupper() else text


@dataclass
class Automaton:
    """Per state: symbol -> (state, count), how often strings end, how often they come by."""

    moves: list[dict[str, tuple[int, int]]] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    total: list[int] = field(default_factory=list)
    symbols: int = 96

    def likelihood(self, text: str) -> float:
        """Log-probability; a symbol that a state has never seen goes back to the start."""
        state, out = 0, 0.0
        for symbol in text:
            to, n = self.moves[state].get(symbol, (0, 0))
            out += math.log((n + 0.1) / (self.total[state] + 0.1 * (self.symbols + 1)))
            state = to
        return out + math.log((self.ends[state] + 0.1) / (self.total[state] + 0.1 * (self.symbols + 1)))


def _differ(a: dict[str, int], a_ends: int, b: dict[str, int], b_ends: int, alpha: float) -> bool:
    """Likelihood ratio test of two states' continuations, symbols too rare for it taken together."""
    na, nb = sum(a.values()) + a_ends, sum(b.values()) + b_ends
    if not na or not nb:
        return False
    share, cells, rare = min(na, nb) / (na + nb), [], [0, 0]
    for x, y in [(a.get(s, 0), b.get(s, 0)) for s in a.keys() | b.keys()] + [(a_ends, b_ends)]:
        if (x + y) * share < RARE:
            rare = [rare[0] + x, rare[1] + y]
        elif x + y:
            cells.append((x, y))
    if rare[0] + rare[1]:
        cells.append(tuple(rare))
    if len(cells) < 2 or min(na, nb) < 2:
        return False
    ratio = 2 * sum(n * math.log(n * (na + nb) / (total * (x + y))) for x, y in cells for n, total in ((x, na), (y, nb)) if n)
    # the chi-squared bound, by the approximation of Wilson and Hilferty
    k, z = len(cells) - 1, NormalDist().inv_cdf(1 - alpha)
    return ratio > k * (1 - 2 / (9 * k) + z * math.sqrt(2 / (9 * k))) ** 3


class _Tree:
    def __init__(self, examples: list[str]):
        self.moves: list[dict[str, int]] = [{}]
        self.count: list[int] = [0]
        self.ends: list[int] = [0]
        self.by: list[dict[str, int]] = [{}]  # how often each symbol was taken
        self.depth: list[int] = [0]
        for text in examples:
            state = 0
            for symbol in text[:LONGEST]:
                self.count[state] += 1
                self.by[state][symbol] = self.by[state].get(symbol, 0) + 1
                if symbol not in self.moves[state]:
                    self.moves[state][symbol] = len(self.moves)
                    self.moves.append({})
                    self.count.append(0)
                    self.ends.append(0)
                    self.by.append({})
                    self.depth.append(self.depth[state] + 1)
                state = self.moves[state][symbol]
            if len(text) <= LONGEST:
                self.count[state] += 1
                self.ends[state] += 1

    def compatible(self, a: int, b: int, alpha: float) -> bool:
        """Whether two states, and those below both, may be one: no likelihood ratio says otherwise."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if _differ(self.by[a], self.ends[a], self.by[b], self.ends[b], alpha):
                return False
            todo += [(to, self.moves[b][symbol]) for symbol, to in self.moves[a].items() if symbol in self.moves[b]]
        return True

    def fold(self, a: int, b: int) -> list[tuple[int, str]]:
        """Add the subtree at b to what hangs at a; the moves that are new there."""
        todo, new = [(a, b)], []
        while todo:
            a, b = todo.pop()
            self.count[a] += self.count[b]
            self.ends[a] += self.ends[b]
            for symbol, n in self.by[b].items():
                self.by[a][symbol] = self.by[a].get(symbol, 0) + n
            for symbol, to in self.moves[b].items():
                if symbol in self.moves[a]:
                    todo.append((self.moves[a][symbol], to))
                else:
                    self.moves[a][symbol] = to
                    new.append((a, symbol))
        return new


def infer(examples: list[str], alpha: float = ALPHA, layered: bool = True) -> Automaton:
    """Merge compatible states of the examples' prefix tree, most frequent first.

    ``layered`` merges states of one depth only, so that lengths are kept.
    """
    tree = _Tree(examples)
    settled, known, layer = [0], {0}, {0: [0]}
    fringe = [(-tree.count[to], to, 0, symbol) for symbol, to in tree.moves[0].items()]
    heapq.heapify(fringe)
    while fringe:
        seen, new, state, symbol = heapq.heappop(fringe)
        if new in known or tree.moves[state].get(symbol) != new:
            continue
        if -seen != tree.count[new]:  # grown by a merge meanwhile
            heapq.heappush(fringe, (-tree.count[new], new, state, symbol))
            continue
        others = layer.get(tree.depth[new], []) if layered else settled
        same = next((old for old in others if tree.compatible(old, new, alpha)), None)
        if same is None:
            settled.append(new)
            known.add(new)
            layer.setdefault(tree.depth[new], []).append(new)
            added = [(new, symbol) for symbol in tree.moves[new]]
        else:
            tree.moves[state][symbol] = same
            added = tree.fold(same, new)
        for state, symbol in added:
            if state in known and tree.moves[state][symbol] not in known:
                to = tree.moves[state][symbol]
                heapq.heappush(fringe, (-tree.count[to], to, state, symbol))
    number = {state: k for k, state in enumerate(settled)}
    return Automaton(
        [{symbol: (number[to], tree.by[state][symbol]) for symbol, to in tree.moves[state].items()} for state in settled],
        [tree.ends[state] for state in settled],
        [tree.count[state] for state in settled],
    )


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct credentials of base matches, and under kind 3 the ordinary words of one hash in 256."""
    for batch in batches:
        texts = batch.column(0)
        for block in blocks(texts):
            found: set[tuple[int, str]] = set()
            for k in np.flatnonzero(worth_reading(block.offsets, block.data)).tolist():
                text = texts[block.low + k].as_py()
                found.update((kind, folded(key)) for kind, _, _, key in base_spans(text or ""))
            some = (block.hashes() & np.uint64(255) == 0) & (block.end - block.start >= 6)
            for start, end in zip(block.start[some].tolist(), block.end[some].tolist()):
                word = block.data[start:end].tobytes().decode()
                if not _KEYLIKE.search(word):
                    found.add((3, word))
            kinds, keys = zip(*sorted(found)) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(keys, pa.string())], names=["kind", "key"])


_KEYLIKE = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z]).{16}")


@dataclass
class Grammar:
    kinds: list[Automaton]
    ordinary: Automaton
    gain: float
    known: dict[str, bool] = field(default_factory=dict)

    def score(self, candidate: str) -> float:
        """Nats that the best kind gains over ordinary words."""
        text = folded(candidate)
        return max(k.likelihood(text) for k in self.kinds) - self.ordinary.likelihood(text)

    def accepts(self, candidate: str) -> bool:
        found = self.known.get(candidate)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            found = self.known[candidate] = self.score(candidate) >= max(SURE, self.gain * len(candidate))
        return found


def learn(docs: DataFrame, examples: int = EXAMPLES, gain: float = GAIN) -> Grammar:
    """Automata from at most ``examples`` distinct credentials per kind, and as many ordinary words, by least hash."""
    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_examples, "kind int, key string").distinct()
    found = materialize(found, "examples")
    kinds = []
    for kind in range(4):
        rows = found.where(F.col("kind") == kind).orderBy(F.xxhash64("key"), "key").limit(examples).collect()
        kinds.append([r["key"] for r in rows])
    return Grammar([infer(keys) for keys in kinds[:3] if keys], infer(kinds[3], layered=False), gain)


def all_spans(text: str, grammar: Grammar | None) -> list[tuple[int, int, int]]:
    base = base_spans(text)
    out = [(kind, start, end) for kind, start, end, _ in base]
    if grammar is not None and grammar.kinds:
        taken = sorted((start, end) for _, start, end in out)
        starts, reach = [a for a, _ in taken], list(itertools.accumulate((b for _, b in taken), max))
        for m in CANDIDATE.finditer(text):
            k = bisect.bisect_left(starts, m.end())
            if not (k and reach[k - 1] > m.start()) and grammar.accepts(m[0]):
                out.append((3, m.start(), m.end()))
    return out


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in sorted(found, key=lambda x: (x[1], x[0])))


_OUT = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_learned long"
_NONE = hashlib.sha256(b"").hexdigest()


def scan(docs: DataFrame, grammar: Grammar | None) -> DataFrame:
    """One row per row of ``docs`` with the numbers and places of its secrets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n = batch.column(1), len(batch)
            counts = np.zeros((4, n), np.int64)
            digests, lists = [_NONE] * n, [""] * n
            for low, offsets, data in spans(texts):
                for k in (np.flatnonzero(worth_reading(offsets, data)) + low).tolist():
                    found = all_spans(texts[k].as_py() or "", grammar)
                    if found:
                        for kind, _, _ in found:
                            counts[kind, k] += 1
                        lists[k] = joined(found)
                        digests[k] = hashlib.sha256(joined([x for x in found if x[0] < 3]).encode()).hexdigest()
            columns = [batch.column(0), *(pa.array(c) for c in counts[:3]), pa.array(digests), pa.array(lists), pa.array(counts[3])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_learned"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _OUT)
