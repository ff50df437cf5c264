"""An interpolated modified Kneser-Ney n-gram model, counted and stored by Spark tasks.

Tokens are lower-cased (A-Z) words and one end per text; ``order - 1`` starts precede
the first word. The highest order counts occurrences; below it a gram counts the
distinct words before it. Tasks fold what they read into distinct n-grams and send
them to the shard of the last word but one; words of a share of ``LISTED`` or more, at
most 65,000, travel as numbers into a list, others as 64-bit hashes.
All shorter endings of an n-gram hold that word, and all its contexts end in it, so
one shuffle serves every order. A very frequent last word but one is spread over
shards by the word after it; only its contexts are then in parts, which are summed
with the statistics of single words in a second, smaller step. An n-gram is folded
before it is sent, so a very frequent one is one row per chunk of tokens.

A shard's task writes its grams as sorted hash arrays. Of a key they hold 32 bits, as
shard and bucket stand for the leading ones, so an unseen gram is taken for a seen one
about once in 10**8.
Workers map these arrays and score texts. Nothing but sizes and a few sums reaches
the driver.

Defined results: null, empty and blank texts have one token, the end. Rows that
repeat a text count as often. Without training texts every probability is 1 over the
one class there is, so all scores are 0. Columns other than those named are ignored.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .hash_arrays import HashArrays, shard_of, write_arrays, write_shard
from .words import Block, blocks, mix

ORDER = 3
START, END = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
CHUNK = 2_000_000  # tokens folded at a time
SHARD = 2_000_000  # training tokens per shard
NOTABLE = 1e-5  # share of a chunk's tokens from which a word is counted as frequent
LISTED = 1 / 65_000  # share of all tokens from which a word has a number
RARE = 65_535  # stands for words without one

_U64, _U32, _U16, _U8 = (np.dtype(t) for t in (np.uint64, np.uint32, np.uint16, np.uint8))
_LEAD, _HIGH = np.uint64(0xFFFF << 48), np.uint64(0xFFFFFFFF << 32)


def padded(block: Block, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, words and end of all documents in a row; places of words and ends; the first of them per document."""
    hashes = block.hashes(lower=True)
    base = block.first[:-1] + order * np.arange(block.documents) + order - 1
    out = np.full(len(hashes) + order * block.documents, START)
    predicted = np.zeros(len(out), bool)
    at = np.arange(len(hashes)) + order * block.owner() + order - 1
    out[at], out[base + block.counts()] = hashes, END
    predicted[at] = predicted[base + block.counts()] = True
    return out, np.flatnonzero(predicted), block.first[:-1] + np.arange(block.documents)


def chain(columns: list[np.ndarray]) -> np.ndarray:
    """Hashes of grams, given as one array per word; that of a single word is the word."""
    out = columns[-1]
    for column in columns[-2::-1]:
        out = mix(mix(column) + out)
    return out


def keys_of(grams: np.ndarray, route: np.ndarray) -> np.ndarray:
    """Keys that lead to the shard of ``route`` and tell grams apart by 48 bits."""
    return (route & _LEAD) | (grams >> np.uint64(16))


def routes(last_but_one: np.ndarray, last: np.ndarray, frequent: HashArrays) -> np.ndarray:
    out = mix(last_but_one)
    hot, _ = frequent.find(last_but_one)
    out[hot] = chain([last_but_one[hot], last[hot]])
    return out


def _chunks(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Padded texts, and the places of words and ends in them."""
    held, n = [], 0

    def joined():
        shift = np.cumsum([0] + [len(text) for text, _ in held])
        return np.concatenate([text for text, _ in held]), np.concatenate([at + s for (_, at), s in zip(held, shift)])

    for batch in batches:
        for block in blocks(batch.column(0)):
            text, at, _ = padded(block, order)
            held.append((text, at))
            n += len(at)
            if n >= CHUNK:
                yield joined()
                held, n = [], 0
    if held:
        yield joined()


def _notable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Frequent words of each chunk with their counts; the number of tokens under key null."""
    for text, at in _chunks(batches, 2):
        word, n = np.unique(text[at - 1], return_counts=True)
        some = n > NOTABLE * len(at)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None, *word[some].view(np.int64).tolist()], pa.int64()), pa.array([len(at), *n[some].tolist()], pa.int64())], names=["word", "n"]
        )


def runs(values: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)


def pack(*columns: np.ndarray) -> bytes:
    return np.array([len(c) for c in columns], np.uint32).tobytes() + b"".join(np.ascontiguousarray(c).tobytes() for c in columns)


def unpack(data: bytes, *types) -> list[np.ndarray]:
    sizes, at, out = np.frombuffer(data, np.uint32, len(types)), 4 * len(types), []
    for n, kind in zip(sizes.tolist(), map(np.dtype, types)):
        out.append(np.frombuffer(data, kind, n, at))
        at += n * kind.itemsize
    return out


def _packed_grams(codes: list[np.ndarray], words: list[np.ndarray], n: np.ndarray) -> bytes:
    """Distinct grams, compressed: numbers of listed words by their bytes, hashes of the others, counts."""
    few, code = np.minimum(n, 255), np.concatenate(codes)
    rare = [w[c == RARE] for c, w in zip(codes, words)]
    data = pack((code & 255).astype(np.uint8), (code >> 8).astype(np.uint8), np.concatenate(rare), few.astype(np.uint8), n[few == 255].astype(np.uint64))
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def _unpacked_grams(data: bytes, order: int, listed: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Grams and counts; ``listed`` has the words in order of their numbers."""
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    low, high, rare, few, big = unpack(raw, _U8, _U8, _U64, _U8, _U64)
    n = few.astype(np.int64)
    n[few == 255] = big
    codes = low | high.astype(np.uint16) << 8
    words = np.empty(len(codes), np.uint64)
    other = codes == RARE
    words[other], words[~other] = rare, listed[codes[~other]]
    return np.split(words, order), n


def _list(listed: HashArrays) -> tuple[np.ndarray, np.ndarray]:
    """The listed words in order of hash, and of each the place in that order of the most, second most ... frequent."""
    if not listed.sizes.get(0):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    words, n = listed.mapped(0)
    return words, np.argsort(n, kind="stable")[::-1]


def _codes(words: np.ndarray, listed: HashArrays) -> np.ndarray:
    """Small numbers for frequent words, which compress."""
    out, (known, by_rank) = np.full(len(words), RARE, np.uint16), _list(listed)
    if len(known):
        rank = np.empty(len(known), np.uint16)
        rank[by_rank] = np.arange(len(known))
        at = np.minimum(np.searchsorted(known, words), len(known) - 1)
        there = known[at] == words
        out[there] = rank[at[there]]
    return out


def _dealt_grams(order: int, shards: int, frequent: HashArrays, listed: HashArrays):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for text, at in _chunks(batches, order):
            codes = _codes(text, listed)
            columns = [text[at - k] for k in range(order - 1, -1, -1)]
            grams = chain(columns)
            # By the whole route, so that the grams of one last word but one are a run and compress.
            keys = (routes(columns[-2], columns[-1], frequent) & _HIGH) | (grams >> np.uint64(32))
            sort = np.argsort(keys)
            new = runs(grams[sort])
            n = np.diff(np.append(new, len(sort)))
            some = sort[new]
            columns, codes = [c[some] for c in columns], [codes[at[some] - k] for k in range(order - 1, -1, -1)]
            ends = np.searchsorted(shard_of(keys[some], shards), np.arange(shards + 1))
            full = np.flatnonzero(np.diff(ends))
            data = [_packed_grams([c[a:b] for c in codes], [c[a:b] for c in columns], n[a:b]) for a, b in zip(ends[full], ends[full + 1])]
            yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(data, pa.binary())], names=["shard", "data"])

    return run


def _by_shard(batches: Iterator[pa.RecordBatch]) -> dict[int, list[tuple]]:
    held: dict[int, list[tuple]] = {}
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            held.setdefault(row[0], []).append(row[1:])
    return held


class ShortArrays(HashArrays):
    """Hash arrays of keys whose leading 16 bits say no more than the shard does.

    The next bits choose a bucket of 16 to 32 keys on average; of a key its bucket
    holds the 32 bits after those.
    """

    @staticmethod
    def bits(n: int) -> int:
        return min(max(0, n.bit_length() - 5), 16)

    @staticmethod
    def cut(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        rest = keys << np.uint64(16)
        bucket = (rest >> np.uint64(1)) >> np.uint64(63 - bits)
        return bucket.astype(np.int64), ((rest << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)

    @staticmethod
    def write(folder: str, shard: int, keys: np.ndarray, *values: np.ndarray) -> int:
        """Keys in order of their last 48 bits, with their values."""
        if len(keys):
            bits = ShortArrays.bits(len(keys))
            bucket, low = ShortArrays.cut(keys, bits)
            write_shard(folder, shard, np.searchsorted(bucket, np.arange((1 << bits) + 1)).astype(np.uint32), low, *values)
        return len(keys)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        found, values = np.zeros(len(keys), bool), [np.zeros(len(keys), t) for t in self.types]
        sort = np.argsort(keys)
        ends = np.searchsorted(shard_of(keys[sort], self.shards), np.arange(self.shards + 1))
        for shard in np.flatnonzero(np.diff(ends)):
            n = self.sizes.get(int(shard))
            if not n:
                continue
            some, raw, bits = sort[ends[shard] : ends[shard + 1]], self.raw(int(shard)), self.bits(n)
            end = 4 * ((1 << bits) + 1)
            offsets, lows, end = raw[:end].view(np.uint32), raw[end : end + 4 * n].view(np.uint32), end + 4 * n
            bucket, want = self.cut(keys[some], bits)
            at, stop = offsets[bucket].astype(np.int64), offsets[bucket + 1].astype(np.int64)
            for _ in range(int(np.max(stop - at)).bit_length()):
                middle = (at + stop) >> 1
                less = (lows[np.minimum(middle, n - 1)] < want) & (middle < stop)
                at, stop = np.where(less, middle + 1, at), np.where(less, stop, middle)
            at, last = np.minimum(at, n - 1), offsets[bucket + 1]
            hit = (lows[at] == want) & (at < last) & (at >= offsets[bucket])
            found[some] = hit
            for value, kind in zip(values, map(np.dtype, self.types)):
                value[some[hit]] = raw[end : end + n * kind.itemsize].view(kind)[at[hit]]
                end += n * kind.itemsize
        return found, values


@dataclass
class Counts:
    """Counts of grams: those that came once, those below 256, and the rest."""

    once: ShortArrays
    few: ShortArrays
    many: ShortArrays

    @staticmethod
    def write(folder: str, shard: int, keys: np.ndarray, n: np.ndarray) -> list[int]:
        """Arrays of one shard from keys in order of their last 48 bits; their sizes."""
        few, many = (n > 1) & (n < 256), n > 255
        return [
            ShortArrays.write(f"{folder}-once", shard, keys[n == 1]),
            ShortArrays.write(f"{folder}-few", shard, keys[few], n[few].astype(np.uint8)),
            ShortArrays.write(f"{folder}-many", shard, keys[many], n[many].astype(np.uint64)),
        ]

    @staticmethod
    def opened(folder: str, shards: int, sizes: dict[int, list[int]]) -> "Counts":
        once, few, many = ({s: x[k] for s, x in sizes.items()} for k in range(3))
        return Counts(ShortArrays(f"{folder}-once", shards, once), ShortArrays(f"{folder}-few", shards, few, [_U8]), ShortArrays(f"{folder}-many", shards, many, [_U64]))

    def of(self, keys: np.ndarray) -> np.ndarray:
        distinct, place = np.unique(keys, return_inverse=True)
        out = self.once.find(distinct)[0].astype(np.int64)
        for arrays in (self.few, self.many):
            rest = np.flatnonzero(out == 0)
            out[rest] = arrays.find(distinct[rest])[1][0]
        return out[place]


_WORDS = "shard int, kind int, data binary"
_STATISTICS = [_U64, _U32, _U32, _U32]  # of a context: sum of counts, words that came once, twice, more often


@dataclass
class Contexts:
    """Statistics of contexts: those whose sum is below 256, and the rest."""

    few: ShortArrays
    many: ShortArrays

    @staticmethod
    def write(folder: str, shard: int, keys: np.ndarray, sums: list[np.ndarray]) -> list[int]:
        sort = np.argsort(keys << np.uint64(16))
        few = sums[0][sort] < 256
        a, b = sort[few], sort[~few]
        return [
            ShortArrays.write(f"{folder}-few", shard, keys[a], *(x[a].astype(np.uint8) for x in sums)),
            ShortArrays.write(f"{folder}-many", shard, keys[b], *(x[b].astype(t) for x, t in zip(sums, _STATISTICS))),
        ]

    @staticmethod
    def opened(folder: str, shards: int, sizes: dict[int, list[int]]) -> "Contexts":
        few, many = ({s: x[k] for s, x in sizes.items()} for k in range(2))
        return Contexts(ShortArrays(f"{folder}-few", shards, few, [_U8] * 4), ShortArrays(f"{folder}-many", shards, many, _STATISTICS))

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        found, few = self.few.find(keys)
        out = [x.astype(t) for x, t in zip(few, _STATISTICS)]
        rest = np.flatnonzero(~found)
        found[rest], many = self.many.find(keys[rest])
        for column, x in zip(out, many):
            column[rest] = x
        return found, out


def statistics(context: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """One row of each distinct context, in order of its hash, and its statistics."""
    sort = np.argsort(context)
    at, n = runs(context[sort]), n[sort]
    return sort[at], [np.add.reduceat(x.astype(np.int64), at) for x in (n, n == 1, n == 2, n > 2)]


def _written_grams(folder: str, order: int, shards: int, word_shards: int, frequent: HashArrays, listed: HashArrays):
    """Writes grams and contexts of each shard. Sends on statistics of words and of contexts
    in parts (kind 0; 4 if their sum is 1), numbers of words before a word (1), occurrences of words (2) and sums (3)."""

    def sent(kind, keys, *columns):
        shard = shard_of(keys, word_shards)
        ends = np.searchsorted(shard, np.arange(word_shards + 1))
        some = np.flatnonzero(np.diff(ends))
        data = [pack(keys[a:b], *(c[a:b] for c in columns)) for a, b in zip(ends[some], ends[some + 1])]
        return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(np.full(len(some), kind, np.int32)), pa.array(data, pa.binary())], names=["shard", "kind", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, by_rank = _list(listed)
        words = words[by_rank]
        for shard, packets in _by_shard(batches).items():
            parts = [_unpacked_grams(data, order, words) for (data,) in packets]
            columns = [np.concatenate([p[0][k] for p in parts]) for k in range(order)]
            n = np.concatenate([p[1] for p in parts])
            del packets, parts
            said = {"shard": int(shard), "sizes": {}, "contexts": {}, "counts": {}}
            for k in range(order, 1, -1):
                # Grams of k words: counts as they came at the highest order, number of words before them below.
                grams = chain(columns)
                sort = np.argsort(grams)
                at = runs(grams[sort])
                n = np.add.reduceat(n[sort], at) if k == order else np.diff(np.append(at, len(sort)))
                columns, grams = [c[sort[at]] for c in columns], grams[sort[at]]
                said["counts"][k] = [int((n == j).sum()) for j in (1, 2, 3, 4)]
                said["sizes"][k] = Counts.write(f"{folder}/{k}", shard, keys_of(grams, routes(columns[-2], columns[-1], frequent)), n)
                if k == order:
                    word, place = np.unique(columns[-2], return_inverse=True)
                    yield sent(2, word, np.bincount(place, n).astype(np.uint64))
                context = chain(columns[:-1])
                some, sums = statistics(context, n)
                last, context = columns[-2][some], context[some]
                onward = np.ones(len(some), bool)
                if k > 2:
                    onward, _ = frequent.find(last)
                    # A context whose words came once altogether is told by its own count.
                    kept = np.flatnonzero(~onward & ((sums[0] > 1) | (last == START)))
                    keys = keys_of(context[kept], mix(last[kept]))
                    said["contexts"][k] = Contexts.write(f"{folder}/contexts-{k}", shard, keys, [x[kept] for x in sums])
                    yield sent(4, context[onward & (sums[0] == 1)])
                    onward &= sums[0] > 1
                if onward.any():
                    yield sent(0, context[onward], *(x[onward].astype(t) for x, t in zip(sums, _STATISTICS)))
                columns = columns[1:]
            yield sent(1, *(x.astype(t) for x, t in zip(np.unique(columns[0], return_counts=True), (np.uint64, np.uint32))))
            yield pa.RecordBatch.from_arrays([pa.array([int(shard) % word_shards], pa.int32()), pa.array([3], pa.int32()), pa.array([json.dumps(said).encode()], pa.binary())], names=["shard", "kind", "data"])

    return run


def _written_words(folder: str):
    """Writes the arrays of words and of contexts that came in parts: occurrences, statistics, number of words before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        said = []
        for shard, packets in _by_shard(batches).items():
            said += [data.decode() for kind, data in packets if kind == 3]
            sources = [(0, [_U64, *_STATISTICS], 1), (1, [_U64, _U32], 5), (2, [_U64, _U64], 0), (4, [_U64], 1)]
            lists = [(first, [unpack(data, *types) for k, data in packets if k == kind]) for kind, types, first in sources]
            if not any(rows for _, rows in lists):
                continue
            keys, place = np.unique(np.concatenate([row[0] for _, rows in lists for row in rows]), return_inverse=True)
            columns, low = [np.zeros(len(keys), np.int64) for _ in range(6)], 0
            for first, rows in lists:
                high = low + sum(len(row[0]) for row in rows)
                if rows and len(rows[0]) == 1:  # contexts that came once
                    np.add.at(columns[1], place[low:high], 1)
                    np.add.at(columns[2], place[low:high], 1)
                for c in range(len(rows[0]) - 1 if rows else 0):
                    np.add.at(columns[first + c], place[low:high], np.concatenate([row[c + 1] for row in rows]).astype(np.int64))
                low = high
            count, before = columns[0], columns[5]
            told = (count == 0) & (before == 0) & (columns[1] == 1)
            size = write_shard(f"{folder}/words", shard, keys[~told], *(c[~told].astype(t) for c, t in zip(columns, _WORD_TYPES)))
            word = keys != START
            said.append(json.dumps({"word_shard": int(shard), "size": size, "tokens": int(count[word].sum()), "words": int((count > 0)[word].sum()), "texts": int(count[~word].sum()), "types": int(before.sum()), "counts": [int((before == k).sum()) for k in (1, 2, 3, 4)], "more": int((before > 2).sum())}))
        yield pa.RecordBatch.from_arrays([pa.array(said, pa.string())], names=["said"])

    return run


_WORD_TYPES = [_U64, *_STATISTICS, _U32]


def discounts(counts: list[int]) -> list[float]:
    """The modified Kneser-Ney discounts for counts 0 (none), 1, 2 and 3 or more.

    Where a count of counts is 0 and the formula has no value, the plain discount
    stands in, and 0.5 where that has none either.
    """
    n1, n2, n3, n4 = counts
    y = n1 / (n1 + 2 * n2) if n1 else 0.5
    out = [0.0]
    for k, (a, b) in enumerate([(n1, n2), (n2, n3), (n3, n4)], 1):
        d = k - (k + 1) * y * b / a if a else y
        out.append(d if 0 < d <= k else y)
    return out


@dataclass
class Model:
    order: int
    grams: dict[int, Counts]  # by number of words, from 2
    contexts: dict[int, Contexts]  # statistics of the contexts of grams of 3 words and more
    words: HashArrays
    frequent: HashArrays
    tokens: int  # training tokens, ends included
    vocabulary: int  # distinct ones
    texts: int
    types: int  # distinct pairs
    discounts: dict[int, list[float]]  # by number of words, from 1
    rest: float  # mass of the word distribution that goes to the uniform one

    def score(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Per document: tokens, known tokens, base score and score (log10)."""
        text, at, first = padded(block, self.order)
        words, place = np.unique(text, return_inverse=True)
        _, (count, *sums, before) = self.words.find(words)
        of_last, of_left = place[at], place[at - 1]
        tokens_of = np.where(words == END, self.texts, count.astype(np.float64))[of_last]
        e = np.array(self.discounts[1])
        p = (np.maximum(before - e[np.minimum(before, 3)], 0.0) / max(self.types, 1) + self.rest / (self.vocabulary + 1))[of_last]
        route, came, context = routes(text[at - 1], text[at], self.frequent), np.zeros(len(text), bool), None
        for k in range(2, self.order + 1):
            found = [x[of_left] for x in sums] if k == 2 else self._context(k, context, text[at - 1], came[at - 1])
            total, *n = (x.astype(np.float64) for x in found)
            d, grams = np.array(self.discounts[k]), chain([text[at - j] for j in range(k - 1, -1, -1)])
            times = self.grams[k].of(keys_of(grams, route))
            kept = np.where(total > 0, sum(d[j] * n[j - 1] for j in (1, 2, 3)) / np.maximum(total, 1), 1.0)
            p = np.maximum(times - d[np.minimum(times, 3)], 0.0) / np.maximum(total, 1) + kept * p
            came[:], came[at] = False, times > 0
            context = chain([text[at - j] for j in range(k, 0, -1)]) if k < self.order else None
        base = np.log10((tokens_of + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1)))
        known = np.add.reduceat((tokens_of > 0).astype(np.int64), first)
        return block.counts() + 1, known, np.add.reduceat(base, first), np.add.reduceat(np.log10(p), first)

    def _context(self, k: int, context: np.ndarray, last: np.ndarray, came: np.ndarray) -> list[np.ndarray]:
        distinct, index, place = np.unique(context, return_index=True, return_inverse=True)
        last = last[index]
        hot, _ = self.frequent.find(last)
        found, out = np.zeros(len(distinct), bool), [np.zeros(len(distinct), t) for t in _STATISTICS]
        wide = self.words.find(distinct[hot])
        near = self.contexts[k].find(keys_of(distinct[~hot], mix(last[~hot])))
        found[hot], found[~hot] = wide[0], near[0]
        for column, a, b in zip(out, wide[1][1:5], near[1]):
            column[hot], column[~hot] = a, b
        single = came[index] & ~found
        out[0][single] = out[1][single] = 1
        return [x[place] for x in out]


def train(texts: DataFrame, order: int = ORDER) -> Model:
    """A model of all rows of ``texts`` (column text)."""
    if order < 2:
        raise ValueError("the model needs pairs at least")
    spark = texts.sparkSession
    rows = texts.select(F.col("text").cast("string").alias("text"))
    notable = materialize(rows.mapInArrow(_notable, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "notable")
    total = F.max(F.when(F.col("word").isNull(), F.col("n")))
    tokens = notable.agg(total).first()[0] or 0
    shards = max(1, -(-tokens // SHARD))
    # At most 2 words per shard can pass this bound.
    hot = notable.where(F.col("word").isNotNull() & (F.col("n") > tokens / (2 * shards)))
    frequent = write_arrays(hot, "frequent", "word", [], 1)
    listed = write_arrays(notable.where(F.col("word").isNotNull() & (F.col("n") > tokens * LISTED)), "listed", "word", ["n"], 1)
    folder, word_shards = scratch_path(spark, "model"), -(-shards // 2)
    dealt = rows.mapInArrow(_dealt_grams(order, shards, frequent, listed), "shard int, data binary").repartition(shards, "shard")
    words = dealt.mapInArrow(_written_grams(folder, order, shards, word_shards, frequent, listed), _WORDS).repartition(word_shards, "shard")
    said = [json.loads(r["said"]) for r in words.mapInArrow(_written_words(folder), "said string").collect()]
    grams, lists = [x for x in said if "shard" in x], [x for x in said if "word_shard" in x]
    added = lambda rows: [sum(c) for c in zip(*rows)] or [0, 0, 0, 0]
    counts, types, texts_seen = added(x["counts"] for x in lists), sum(x["types"] for x in lists), sum(x["texts"] for x in lists)
    e = discounts(counts)
    of_order = {k: {x["shard"]: x["sizes"][str(k)] for x in grams} for k in range(2, order + 1)}
    return Model(
        order,
        {k: Counts.opened(f"{folder}/{k}", shards, sizes) for k, sizes in of_order.items()},
        {k: Contexts.opened(f"{folder}/contexts-{k}", shards, {x["shard"]: x["contexts"][str(k)] for x in grams}) for k in range(3, order + 1)},
        HashArrays(f"{folder}/words", word_shards, {x["word_shard"]: x["size"] for x in lists}, _WORD_TYPES),
        frequent,
        sum(x["tokens"] for x in lists) + texts_seen,
        sum(x["words"] for x in lists) + (1 if texts_seen else 0),
        texts_seen,
        types,
        {1: e} | {k: discounts(added(x["counts"][str(k)] for x in grams)) for k in range(2, order + 1)},
        (e[1] * counts[0] + e[2] * counts[1] + e[3] * sum(x["more"] for x in lists)) / types if types else 1.0,
    )


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row (doc_id, text, held_out)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2), 1 << 21):
                n, known, base, total = model.score(block)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(block.low, block.documents) for k in range(2)), pa.array(n), pa.array(known), pa.array(np.full(len(n), model.tokens)), pa.array(base), pa.array(total)],
                    names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(parts: int, remainder: int):
    """Whether the CRC-32 of a row's doc_id as text leaves ``remainder``; a null id is not held out."""
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(code % parts == remainder, F.lit(False))


def score_held_out(docs: DataFrame, parts: int = 5, remainder: int = 1, order: int = ORDER) -> DataFrame:
    """Scores of all rows by a model of those that are not held out."""
    marked = docs.select("doc_id", "text", held_out(parts, remainder).alias("held_out"))
    return score(marked, train(marked.where("not held_out"), order))
