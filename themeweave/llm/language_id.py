"""Languages of mixed texts by a Viterbi path over words.

Every word has a score in every language: the log-probabilities of its byte trigrams
(of the lower-cased word between blanks) and of the word as a whole, from hashed
counts of all labelled texts. Script ranges narrow the candidates: a language that is
hardly ever written in one of a word's scripts is out for that word, unless all are.
The best path pays ``PENALTY`` for every change of language; its runs are the spans.

Defined results: null, empty and letterless texts are ``und`` with score 0 and no
spans. If no row is labelled, every text is ``und``. Rows without a label are not
learned from. Equal languages are decided by code point order of their names. Rows
that repeat are learned from and predicted like others. Columns other than those
named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import Block, blocks, sums_between

BUCKETS = 1 << 16
PENALTY = 25.0
LEAST_SHARE = 1e-3  # of a language's words, for a script to count as one of its own
UNKNOWN = "und"

# First and last code points of scripts (Unicode blocks).
SCRIPTS = [
    ("latin", 0x0041, 0x024F),
    ("greek", 0x0370, 0x03FF),
    ("cyrillic", 0x0400, 0x052F),
    ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F),
    ("devanagari", 0x0900, 0x097F),
    ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF),
    ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF),
    ("latin", 0x1E00, 0x1EFF),
    ("greek", 0x1F00, 0x1FFF),
    ("kana", 0x3040, 0x30FF),
    ("han", 0x3400, 0x9FFF),
    ("hangul", 0xAC00, 0xD7AF),
    ("han", 0x20000, 0x323AF),
]
_NAMES = list(dict.fromkeys(name for name, _, _ in SCRIPTS)) + ["other"]
FEATURES = 2 * BUCKETS + len(_NAMES)

_PLAIN = np.full(256, 32, np.uint8)  # what a byte counts as in a trigram
_PLAIN[97:123] = np.arange(97, 123)
_PLAIN[65:91] = np.arange(97, 123)
_PLAIN[128:] = np.arange(128, 256)
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True


def script_bits(points: np.ndarray) -> np.ndarray:
    """One bit for the script of each code point, 0 for what is not a letter."""
    bits = np.zeros(len(points), np.uint16)
    for k, point in enumerate(points.tolist()):
        if chr(point).isalpha():
            name = next((name for name, low, high in SCRIPTS if low <= point <= high), "other")
            bits[k] = 1 << _NAMES.index(name)
    return bits


def code_points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the characters beyond ASCII begin, and which they are."""
    at = np.flatnonzero(data >= 0xC2)
    padded = np.concatenate([data, np.zeros(3, np.uint8)]).astype(np.int32)
    a, b, c, d = (padded[at + k] for k in range(4))
    point = np.where(a < 0xE0, (a & 31) << 6 | b & 63, np.where(a < 0xF0, (a & 15) << 12 | (b & 63) << 6 | c & 63, (a & 7) << 18 | (b & 63) << 12 | (c & 63) << 6 | d & 63))
    return at, point


@dataclass
class Features:
    letter: np.ndarray  # 1 at the bytes that begin a letter
    scripts: np.ndarray  # bits per word
    letters: np.ndarray  # letters per word
    at: np.ndarray  # middle bytes of the trigrams
    trigram: np.ndarray  # bucket per trigram
    word: np.ndarray  # bucket per word


def features(block: Block) -> Features:
    data = block.data
    bits = _ASCII_LETTER[data].astype(np.uint16)
    at, points = code_points(data)
    some, place = np.unique(points, return_inverse=True)
    bits[at] = script_bits(some)[place]
    letter = (bits > 0).astype(np.int64)
    plain = _PLAIN[data]
    # Capital Latin letters of two bytes: 0xC3 0x80 to 0xC3 0x9E.
    second = at[(data[at] == 0xC3) & (at + 1 < len(data))] + 1
    second = second[(data[second] <= 0x9E) & (data[second] != 0x97)]
    plain[second] += 32
    around = np.full(len(plain) + 2, 32, np.uint32)
    around[1:-1] = plain
    middle = np.flatnonzero(plain != 32)
    code = around[middle] << 16 | around[middle + 1] << 8 | around[middle + 2]
    if len(block.start):
        scripts = np.bitwise_or.reduceat(np.append(bits, 0), np.stack([block.start, block.end], axis=1).ravel())[::2].astype(np.uint16)
    else:
        scripts = np.zeros(0, np.uint16)
    words = (block.hashes(lower=True) >> np.uint64(48)).astype(np.int64)
    return Features(letter, scripts, sums_between(letter, block.start, block.end), middle, (code * np.uint32(0x9E3779B1) >> np.uint32(16)).astype(np.int64), words)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs = batch.column(0).to_pylist()
        for block in blocks(batch.column(1)):
            found = features(block)
            names = np.array(langs[block.low : block.low + block.documents])
            codes, of = np.unique(names, return_inverse=True)
            owner = of[block.owner()]
            lettered = found.letters > 0
            of_trigram = of[np.searchsorted(block.offsets, found.at, "right") - 1]
            for k, name in enumerate(codes.tolist()):
                have = counts.setdefault(name, np.zeros(FEATURES, np.int64))
                have[:BUCKETS] += np.bincount(found.trigram[of_trigram == k], minlength=BUCKETS)
                mine = lettered & (owner == k)
                have[BUCKETS : 2 * BUCKETS] += np.bincount(found.word[mine], minlength=BUCKETS)
                for s in range(len(_NAMES)):
                    have[2 * BUCKETS + s] += int(((found.scripts[mine] >> s) & 1).sum())
    for name, have in counts.items():
        some = np.flatnonzero(have)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(have[some])], names=["lang", "feature", "n"])


@dataclass
class Model:
    langs: list[str]
    trigrams: np.ndarray  # log-probability by bucket and language
    words: np.ndarray
    scripts: np.ndarray  # which languages use a script


def learn(labelled: DataFrame) -> Model:
    """From all rows (lang, text) whose lang is not null. The model has a fixed size per language."""
    rows = labelled.where("lang is not null").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counted = rows.mapInArrow(_counted, "lang string, feature long, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))
    table = counted.toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    n = np.zeros((FEATURES, len(langs)))
    place = np.array([langs.index(x) for x in table.column("lang").to_pylist()], int)
    n[table.column("feature").to_numpy(), place] = table.column("n").to_numpy()
    logs = [np.log((part + 0.5) / (part.sum(axis=0) + 0.5 * BUCKETS)).astype(np.float32) for part in (n[:BUCKETS], n[BUCKETS : 2 * BUCKETS])]
    words = n[BUCKETS : 2 * BUCKETS].sum(axis=0)
    return Model(langs, *logs, n[2 * BUCKETS :] > LEAST_SHARE * words)


def word_scores(block: Block, found: Features, model: Model) -> np.ndarray:
    """Log-probabilities (words by languages); nothing for words without a letter."""
    out = np.empty((len(block.start), len(model.langs)), np.float32)
    low, high = np.searchsorted(found.at, block.start), np.searchsorted(found.at, block.end)
    for k in range(len(model.langs)):
        out[:, k] = sums_between(model.trigrams[found.trigram, k].astype(np.float64), low, high) + model.words[found.word, k]
    fits = np.ones(out.shape, bool)
    for bits in np.unique(found.scripts).tolist():
        uses = [s for s in range(len(_NAMES)) if bits >> s & 1]
        allowed = model.scripts[uses].all(axis=0)
        if uses and allowed.any():
            fits[found.scripts == bits] = allowed
    out[~fits] = -1e6
    out[found.letters == 0] = 0
    return out


def best_paths(scores: np.ndarray, first: np.ndarray, penalty: float) -> np.ndarray:
    """The best language of each word; documents are runs first[d]:first[d + 1] and advance side by side."""
    n = np.diff(first)
    order = np.argsort(-n, kind="stable")
    start, n = first[:-1][order], n[order]
    longest = int(n[0]) if len(n) else 0
    active = np.searchsorted(-n, -np.arange(longest), "left")  # documents with more than t words
    label = np.zeros(len(scores), np.int32)
    if not longest:
        return label
    langs = np.arange(scores.shape[1], dtype=np.int32)
    back = np.empty(scores.shape, np.int32)
    best = scores[start[: active[0]]].astype(np.float64)
    for t in range(1, longest):
        k = active[t]
        ended = best[k:]
        if len(ended):
            label[(start + n - 1)[k : k + len(ended)]] = ended.argmax(axis=1)
            best = best[:k]
        top = best.argmax(axis=1)
        change = best[np.arange(k), top][:, None] - penalty
        stay = best >= change
        at = start[:k] + t
        back[at] = np.where(stay, langs, top[:, None])
        best = np.where(stay, best, change) + scores[at]
    label[(start + n - 1)[: len(best)]] = best.argmax(axis=1)
    for t in range(longest - 1, 0, -1):
        at = start[: active[t]] + t
        label[at - 1] = back[at, label[at]]
    return label


_OUT = "doc_id long, held_out boolean, lang_pred string, score double, spans array<struct<first: int, words: int, lang: string>>"
_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("words", pa.int32()), ("lang", pa.string())]))


def predict(docs: DataFrame, model: Model, penalty: float = PENALTY) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans of every row (doc_id, held_out, text).

    ``lang_pred`` is the language of most letters and ``score`` its share of them.
    """
    names = np.array(model.langs or [UNKNOWN])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, letters, first = [], [], [np.zeros(1, np.int64)]
            for block in blocks(batch.column(2)):
                found = features(block)
                scores.append(word_scores(block, found, model) if model.langs else np.zeros((len(block.start), 1), np.float32))
                letters.append(found.letters if model.langs else found.letters * 0)
                first.append(first[-1][-1] + block.first[1:])
            if not scores:
                continue
            first, letters = np.concatenate(first), np.concatenate(letters)
            label = best_paths(np.concatenate(scores), first, penalty)
            share = np.stack([sums_between(np.where(label == k, letters, 0), first[:-1], first[1:]) for k in range(len(names))], axis=1)
            total, top = share.sum(axis=1), share.argmax(axis=1)
            new = np.ones(len(label), bool)
            new[1:] = label[1:] != label[:-1]
            new[first[:-1][np.diff(first) > 0]] = True
            runs = np.flatnonzero(new)
            of = np.searchsorted(first, runs, "right") - 1
            spoken = total[of] > 0
            runs_end = np.append(runs[1:], len(label))
            items = pa.StructArray.from_arrays(
                [pa.array((runs - first[of])[spoken].astype(np.int32)), pa.array((runs_end - runs)[spoken].astype(np.int32)), pa.array(names[label[runs[spoken]]].tolist(), pa.string())],
                names=["first", "words", "lang"],
            )
            ends = np.searchsorted(of[spoken], np.arange(len(total) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.where(total > 0, names[top], UNKNOWN).tolist(), pa.string()),
                    pa.array(share.max(axis=1) / np.maximum(total, 1)),
                    pa.ListArray.from_arrays(ends, items).cast(_SPANS),
                ],
                names=["doc_id", "held_out", "lang_pred", "score", "spans"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _OUT)


def held_out(parts: int, remainder: int):
    """Whether the CRC-32 of a row's doc_id as text leaves ``remainder``; a null id is not held out."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(code % parts == remainder, F.lit(False))


def identify(docs: DataFrame, parts: int = 4, remainder: int = 2) -> DataFrame:
    """Predictions for all rows by a model of the labelled ones that are not held out."""
    marked = docs.select("doc_id", "lang", "text", held_out(parts, remainder).alias("held_out"))
    return predict(marked, learn(marked.where("not held_out").select("lang", "text")))
