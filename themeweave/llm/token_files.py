"""Token ids in files coded by a static range asymmetric numeral system.

All documents are encoded once. The counts of all ids give one frequency table, which
every file shares. Documents are dealt by ranges of doc_id, and each range is a file:

    magic | blocks | doc_ids, nulls, token counts | block places | numbers, checksum, magic

A block holds ``BLOCK`` ids, the last of a file fewer. Its ids are dealt in turn to up to
``LANES`` coder states, so that one array operation codes an id per lane and no lane
waits for another. Every ``EVERY`` steps the states and the place in the words are kept
as a checkpoint: decoding can begin there, so any stretch of ids can be read alone and
the parts of a block in parallel. Blocks know the checksums of their bytes and of their
ids, files that of their table; a mismatch raises ``ValueError``.

    head (6 numbers) | checkpoints (place, one 64-bit state per lane) | 32-bit words

``by_word`` is for tokenizers that lower-case A-Z and whose tokens cross neither ASCII
white space nor the end of a run of letters before ASCII punctuation. Their words are
looked up: those of up to ``LONGEST`` bytes under their own bytes in a table of ``SLOTS``
rows, where new words displace old ones, longer ones in a dictionary of ``LONG_WORDS``.

Defined results: a null text counts as empty, and an empty text has the end id alone.
Files are in ascending doc_id order, nulls first; rows of one id follow each other, in
an order that depends on their ids only. Repeated rows are all written. An empty table
gives no files and no rows. Columns other than doc_id and text are ignored.

Limits: a vocabulary has fewer than 2**24 ids, and its counts, one row each, are held by
the driver and by every worker. Memory in a task is bounded by a block of texts or of
ids and by the longest text.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .hash_arrays import open_folder, read_file, remote_file
from .words import LOWER, SPACE, cut, mix, spans, sums_between

BLOCK = 1 << 20
LANES = 1 << 11
LEAST_STEPS = 32  # a short block has fewer lanes instead
EVERY = 256
LOW = np.uint64(1 << 31)
MAGIC = b"TWEAVE1\n"
HEAD = struct.Struct("<6I")  # ids, lanes, words, checkpoints, checksums of ids and of what follows
TAIL = struct.Struct("<4Q2I")  # documents, ids, blocks, place of the index, checksums of table and index

PIECE = 1 << 22
SLOTS = 1 << 21
KEYS = 3
LONGEST = 8 * KEYS - 1
LONG_WORDS = 200_000
TOGETHER = 400  # new words encoded in one text
BREAK = "\x00"

_U32, _U64 = np.dtype("<u4"), np.dtype("<u8")


# The coder


class Table:
    """Shares of ids out of ``2**bits``, none of them 0, and what coding needs of them."""

    def __init__(self, ids: np.ndarray, shares: np.ndarray, bits: int):
        self.ids, self.shares, self.bits = ids.astype(_U32), shares.astype(_U64), bits
        self.before = np.cumsum(self.shares) - self.shares
        self.limits = self.shares << np.uint64(63 - bits)
        self.check = zlib.crc32(self.shares.tobytes(), zlib.crc32(self.ids.tobytes(), bits))
        self.number = np.full(int(self.ids.max(initial=0)) + 1, -1, np.int32)
        self.number[self.ids] = np.arange(len(self.ids))
        self._at = None

    @property
    def at(self) -> np.ndarray:
        """The id's number for each of the ``2**bits`` places."""
        if self._at is None:
            self._at = np.repeat(np.arange(len(self.ids), dtype=np.int32), self.shares.astype(np.int64))
        return self._at

    @staticmethod
    def of(counts: dict[int, int]) -> "Table":
        ids = np.array(sorted(counts), np.int64)
        if len(ids) and not 0 <= ids[0] <= ids[-1] < 1 << 24:
            raise ValueError("ids must be from 0 to 2**24 - 1")
        bits = max(20, len(ids).bit_length() + 4)
        total, free = sum(counts.values()), (1 << bits) - len(ids)
        shares = np.array([1 + counts[i] * free // total for i in ids.tolist()], np.int64)
        if len(ids):
            shares[shares.argmax()] += (1 << bits) - shares.sum()
        return Table(ids, shares, bits)

    def dump(self) -> bytes:
        return struct.pack("<2I", len(self.ids), self.bits) + self.ids.tobytes() + self.shares.astype(_U32).tobytes()

    @staticmethod
    def load(data: bytes) -> "Table":
        n, bits = struct.unpack_from("<2I", data)
        ids, shares = np.frombuffer(data, _U32, 2 * n, 8).reshape(2, n)
        return Table(ids, shares, bits)


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    number = table.number.take(ids)
    share, before, limit = table.shares.take(number), table.before.take(number), table.limits.take(number)
    lanes = min(LANES, max(1, len(ids) // LEAST_STEPS))
    steps = -(-len(ids) // lanes)
    bits, half = np.uint64(table.bits), np.uint64(32)
    states = np.full(lanes, LOW)
    words, marks, n_words = [], [], 0
    for step in reversed(range(steps)):  # what is coded last is decoded first
        some = slice(step * lanes, min(len(ids), (step + 1) * lanes))
        x = states[: some.stop - some.start]
        full = x >= limit[some]
        words.append(np.compress(full, x).astype(_U32))
        n_words += len(words[-1])
        np.right_shift(x, half, out=x, where=full)
        times = x // share[some]
        states[: len(x)] = (times << bits) + (x - times * share[some]) + before[some]
        if step % EVERY == 0:
            marks.append((n_words, states.copy()))
    body = b"".join(
        [struct.pack("<Q", n_words - left) + kept.tobytes() for left, kept in reversed(marks)] + [w.tobytes() for w in reversed(words)]
    )
    return HEAD.pack(len(ids), lanes, n_words, len(marks), zlib.crc32(ids.astype(_U32).tobytes()), zlib.crc32(body)) + body


def decode_block(data: bytes, table: Table, low: int = 0, high: int | None = None) -> np.ndarray:
    """Ids ``low`` to ``high`` of a block, decoded from the last checkpoint before them."""
    n, lanes, n_words, n_marks, ids_check, body_check = HEAD.unpack_from(data)
    high = n if high is None else min(high, n)
    mark_size = 8 + 8 * lanes
    if len(data) != HEAD.size + n_marks * mark_size + 4 * n_words or zlib.crc32(memoryview(data)[HEAD.size :]) != body_check:
        raise ValueError("a block of token ids is damaged")
    begin = low // lanes // EVERY
    if low >= high:
        return np.zeros(0, _U32)
    (place,) = struct.unpack_from("<Q", data, HEAD.size + begin * mark_size)
    states = np.frombuffer(data, _U64, lanes, HEAD.size + begin * mark_size + 8).copy()
    words = np.frombuffer(data, _U32, n_words, HEAD.size + n_marks * mark_size)
    bits, mask, half = np.uint64(table.bits), np.uint64((1 << table.bits) - 1), np.uint64(32)
    first = begin * EVERY
    at, shares, before = table.at, table.shares, table.before
    out = np.empty(high - first * lanes + lanes, np.int32)
    for step in range(first, -(-high // lanes)):
        width = min(n, (step + 1) * lanes) - step * lanes
        x = states[:width]
        place_in = x & mask
        number = at.take(place_in.view(np.int64))
        out[(step - first) * lanes : (step - first) * lanes + width] = number
        x = shares.take(number) * (x >> bits) + place_in - before.take(number)
        short = np.flatnonzero(x < LOW)
        x[short] = (x[short] << half) | words[place : place + len(short)]
        place += len(short)
        states[:width] = x
    ids = table.ids.take(out[low - first * lanes : high - first * lanes])
    if low == 0 and high == n and zlib.crc32(ids.tobytes()) != ids_check:
        raise ValueError("a block of token ids does not decode to what was coded")
    return ids


# Encoding texts


class WordIds:
    """Token ids of words, remembered in bounded memory."""

    def __init__(self, tokenizer):
        self.tokenizer = tokenizer
        mark = tokenizer.encode(BREAK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.special = np.zeros(256, bool)
        for token in tokenizer.get_added_tokens_decoder().values():
            self.special[token.content.encode()[0]] = True
        self.forget()

    def forget(self) -> None:
        self.rows = np.zeros((SLOTS, KEYS + 1), np.uint64)  # a word's bytes, and where its ids are
        self.pool, self.used = np.zeros(1 << 20, np.uint32), 0
        self.long: dict[bytes, int] = {}

    def encode(self, words: list[bytes]) -> np.ndarray:
        """The ids of new words go into the pool; where they are, times 2**24, plus how many."""
        counts, found = [], []
        for low in range(0, len(words), TOGETHER):
            some = [w.decode() for w in words[low : low + TOGETHER]]
            together = self._together(some)
            if together is None:
                each = [e.ids for e in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                together = np.array([i for ids in each for i in ids], np.uint32), [len(ids) for ids in each]
            found.append(together[0])
            counts.extend(together[1])
        n = np.array(counts, np.int64)
        ids = np.concatenate(found) if found else np.zeros(0, np.uint32)
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), np.uint32)])
        self.pool[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(n) - n
        self.used += len(ids)
        return (at << 24 | n).view(np.uint64)

    def _together(self, words: list[str]) -> tuple[np.ndarray, list[int]] | None:
        """Words encoded in one text, set apart by a word that none of them holds."""
        if self.mark is None:
            return None
        text = f" {BREAK} ".join(words)
        if text.count(BREAK) != len(words) - 1:
            return None
        (coded,) = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        ids = np.array(coded.ids, np.uint32)
        breaks = np.flatnonzero(ids == self.mark)
        if len(breaks) != len(words) - 1:
            return None
        counts = np.diff(breaks, prepend=-1, append=len(ids)) - 1
        return ids[ids != self.mark], counts.tolist()

    def of(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words data[start:end] one after the other, and how many each has."""
        if self.used > 8 * SLOTS:
            self.forget()
        length = end - start
        rest = np.flatnonzero(length > LONGEST)
        if len(rest):
            short = np.flatnonzero(length <= LONGEST)
            place = np.zeros(len(start), np.uint64)
            place[short] = self._short(data, start[short], length[short])
            place[rest] = self._long([data[a:b].tobytes() for a, b in zip(start[rest].tolist(), end[rest].tolist())])
        else:
            place = self._short(data, start, length)
        place = place.view(np.int64)
        at, n = place >> 24, place & 0xFFFFFF
        ends = np.cumsum(n)
        total = int(ends[-1]) if len(ends) else 0
        return self.pool[np.arange(total) + np.repeat(at - (ends - n), n)], n

    def _short(self, data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        keys = own_bytes(data, start, length)
        code = mix(keys[0] ^ mix(keys[1] ^ mix(keys[2])))
        slot = (code >> np.uint64(40)).view(np.int64) % SLOTS
        there = self.rows.take(slot, axis=0)
        place = there[:, KEYS].copy()
        new = np.flatnonzero((there[:, 0] != keys[0]) | (there[:, 1] != keys[1]) | (there[:, 2] != keys[2]))
        if not len(new):
            return place
        second = (code[new] & np.uint64(SLOTS - 1)).view(np.int64)
        there = self.rows.take(second, axis=0)
        place[new] = there[:, KEYS]
        new = new[(there[:, :KEYS] != keys[:, new].T).any(axis=1)]
        if not len(new):
            return place
        order = new[np.lexsort(keys[:, new])]
        differ = np.ones(len(order), bool)
        differ[1:] = (keys[:, order[1:]] != keys[:, order[:-1]]).any(axis=0)
        first = order[differ]
        raw = data.tobytes()
        found = self.encode([raw[a : a + n] for a, n in zip(start[first].tolist(), length[first].tolist())])
        place[order] = found[np.cumsum(differ) - 1]
        # a free first slot is taken, else the second, whoever has it; of new words with one slot one gets it
        taken = self.rows[slot[first], KEYS - 1] != 0
        where = np.where(taken, (code[first] & np.uint64(SLOTS - 1)).view(np.int64), slot[first])
        where, one = np.unique(where, return_index=True)
        self.rows[where, :KEYS], self.rows[where, KEYS] = keys[:, first[one]].T, found[one]
        return place

    def _long(self, words: list[bytes]) -> np.ndarray:
        if len(self.long) > LONG_WORDS:
            self.long.clear()
        unseen = list(dict.fromkeys(w for w in words if w not in self.long))
        self.long.update(zip(unseen, self.encode(unseen).tolist()))
        return np.array([self.long[w] for w in words], np.uint64)


_MASKS = np.array([[(1 << 8 * min(max(n - 8 * k, 0), 8)) - 1 for n in range(LONGEST + 1)] for k in range(KEYS)], np.uint64)


def own_bytes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Words of up to ``LONGEST`` bytes as numbers: their bytes, zeros, and at the end their length."""
    padded = np.zeros(-(-len(data) // 8) + KEYS + 1, _U64)
    padded.view(np.uint8)[: len(data)] = data
    at, up = start >> 3, ((start & 7) << 3).view(np.uint64)
    down = np.uint64(63) - up
    keys = np.empty((KEYS, len(start)), np.uint64)
    left = padded.take(at)
    for k in range(KEYS):
        right = padded.take(at + (k + 1))
        keys[k] = (left >> up | right << np.uint64(1) << down) & _MASKS[k].take(length)
        left = right
    keys[-1] |= length.view(np.uint64) << np.uint64(56)
    return keys


_TOKENIZERS: dict[str, WordIds] = {}


def _word_ids(folder: str, name: str) -> WordIds:
    if name not in _TOKENIZERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallel part
        from tokenizers import Tokenizer

        _TOKENIZERS.clear()
        _TOKENIZERS[name] = WordIds(Tokenizer.from_str(read_file(folder, name).decode()))
    return _TOKENIZERS[name]


def _pieces(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about ``PIECE`` bytes that end at white space."""
    low = 0
    while low < len(data):
        high = low + PIECE
        while high < len(data):
            spaces = np.flatnonzero(SPACE[data[high : high + PIECE]])
            if len(spaces):
                high += int(spaces[0]) + 1
                break
            high += PIECE
        yield low, min(high, len(data))
        low = high


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def units(data: np.ndarray, offsets: np.ndarray, special: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, where words begin and end in them, and each document's first word.

    Words end at white space and, after a letter, at punctuation. Words in which a
    special token may begin stay as they are.
    """
    space = SPACE[data]
    new = np.ones(len(data) + 1, bool)
    new[1:-1] = _LETTER[data[:-1]] & _MARK[data[1:]]
    low = LOWER[data]
    doubtful = special[data]
    if doubtful.any():
        words = cut(0, offsets, data, SPACE)
        some = np.flatnonzero(sums_between(doubtful.astype(np.int64), words.start, words.end))
        change = np.zeros(len(data) + 1, np.int8)
        change[words.start[some]] += 1
        change[words.end[some]] -= 1
        inside = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
        low = np.where(inside, data, low)
        new[:-1] &= ~inside
    new[1:-1] |= space[:-1]
    new[offsets] = True
    new[-1] = True
    word = ~space
    start = np.flatnonzero(word & new[:-1])
    space[:-1] = space[1:]
    space[-1:] = True
    return low, start, np.flatnonzero(word & (space | new[1:])) + 1, np.searchsorted(start, offsets)


def _ids_by_word(known: WordIds, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    ids, counts = [], np.zeros(len(offsets) - 1, np.int64)
    for low, high in _pieces(data):
        folded, start, end, first = units(data[low:high], np.clip(offsets, low, high) - low, known.special)
        some, n = known.of(folded, start, end)
        ids.append(some)
        before = np.concatenate([[0], np.cumsum(n)])
        counts += np.diff(before[first])
    return np.concatenate(ids) if ids else np.zeros(0, np.uint32), counts


def _ids_of_texts(tokenizer, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = data.tobytes()
    texts = [raw[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
    each = [np.array(e.ids, np.uint32) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
    return np.concatenate([*each, np.zeros(0, np.uint32)]), np.array([len(e) for e in each], np.int64)


def encode(docs: DataFrame, tokenizer_path: str, end_id: int, by_word: bool) -> DataFrame:
    """doc_id and ids (32-bit little-endian, deflated by zstd) of every row, each with the end id.

    ``by_word`` asks for a tokenizer as described above, and gives the same ids faster.
    """
    with open(tokenizer_path, "rb") as file:
        model = file.read()
    folder, name = scratch_path(docs.sparkSession, "tokenizer"), hashlib.sha256(model).hexdigest()
    remote_file(folder, name, model)  # where all workers can read it

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", 1)
        for batch in batches:
            known = _word_ids(folder, name)
            for low, offsets, data in spans(batch.column(1), PIECE):
                ids, counts = _ids_by_word(known, offsets, data) if by_word else _ids_of_texts(known.tokenizer, offsets, data)
                ends = np.cumsum(counts)
                ids = np.insert(ids, ends, end_id)
                ends += np.arange(1, len(ends) + 1)
                packed = [codec.compress(ids[a:b], asbytes=True) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(counts)), pa.array(counts + 1), pa.array(packed, pa.binary())], names=["doc_id", "n", "ids"]
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, ids binary")


def _unpacked(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    codec = pa.Codec("zstd")
    n, packed = batch.column(batch.schema.get_field_index("n")), batch.column(batch.schema.get_field_index("ids"))
    for size, data in zip(n.to_pylist(), packed):
        yield np.frombuffer(codec.decompress(data.as_buffer(), 4 * size), _U32)


def count(encoded: DataFrame) -> Table:
    """The frequency table of all ids of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(0, np.int64)
        for batch in batches:
            for ids in _unpacked(batch):
                some = np.bincount(ids, minlength=len(counts))
                some[: len(counts)] += counts
                counts = some
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(counts[seen])], names=["id", "n"])

    counted = encoded.select("n", "ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    return Table.of({r["id"]: r["n"] for r in counted.collect()})  # as many rows as the vocabulary has ids


# Files


@dataclass
class Files:
    """What is where: numbers of the files and of the ids that come before each, in order."""

    folder: str
    numbers: list[int]
    starts: list[int]
    table_file: str = "table"

    @property
    def n_ids(self) -> int:
        return self.starts[-1]


def _write_file(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    batch = next(batches, None)
    if batch is None:
        return
    table, number = Table.load(read_file(folder, "table")), TaskContext.get().partitionId()
    system, path = open_folder(folder)
    draft = f"{path}/.{number}-{TaskContext.get().taskAttemptId()}"
    doc_ids, counts, places, held, n_held = [], [], [], [], 0
    with system.open_output_stream(draft) as out:
        out.write(MAGIC)

        def put(ids: np.ndarray) -> None:
            places.append(out.tell())
            out.write(encode_block(ids, table))

        while batch is not None:
            doc_ids.append(batch.column(0))
            for ids in _unpacked(batch):
                counts.append(len(ids))
                held.append(ids)
                n_held += len(ids)
                if n_held >= BLOCK:
                    together = np.concatenate(held)
                    whole = n_held // BLOCK * BLOCK
                    for low in range(0, whole, BLOCK):
                        put(together[low : low + BLOCK])
                    held, n_held = [together[whole:]], n_held - whole
            batch = next(batches, None)
        if n_held:
            put(np.concatenate(held))
        ids = pa.chunked_array(doc_ids)
        index = [ids.fill_null(0).to_numpy().astype("<i8"), ids.is_null().to_numpy().astype(np.uint8), np.array(counts, _U64), np.array(places, _U64)]
        at = out.tell()
        raw = b"".join(x.tobytes() for x in index)
        out.write(raw)
        out.write(TAIL.pack(len(counts), sum(counts), len(places), at, table.check, zlib.crc32(raw)) + MAGIC)
    system.move(draft, f"{path}/{number:06d}")
    yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([sum(counts)])], names=["number", "n"])


def write(encoded: DataFrame, table: Table, folder: str) -> Files:
    """The documents as files in ascending doc_id order.

    A file appears under its name when it is whole, so a lost or repeated task does no harm.
    """
    remote_file(folder, "table", table.dump())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _write_file(folder, batches)

    spread = F.xxhash64("ids")  # rows of one frequent doc_id may be in several files
    dealt = encoded.withColumn("spread", spread).repartitionByRange("doc_id", "spread").sortWithinPartitions("doc_id", "spread", "ids")
    made = dealt.select("doc_id", "n", "ids").mapInArrow(run, "number long, n long").collect()  # two numbers a file
    made.sort()
    return Files(folder, [r["number"] for r in made], np.cumsum([0, *(r["n"] for r in made)]).tolist())


class Reader:
    """One file, read by parts."""

    def __init__(self, folder: str, number: int, table: Table):
        system, path = open_folder(folder)
        self.source, self.table = system.open_input_file(f"{path}/{number:06d}"), table
        size = self.source.size()
        tail = self.source.read_at(TAIL.size + len(MAGIC), size - TAIL.size - len(MAGIC))
        self.n_docs, self.n_ids, n_blocks, self.index, table_check, index_check = TAIL.unpack_from(tail)
        raw = self.source.read_at(size - TAIL.size - len(MAGIC) - self.index, self.index)
        if tail[TAIL.size :] != MAGIC or table_check != table.check or zlib.crc32(raw) != index_check:
            raise ValueError(f"file {number} of token ids is damaged or has another table")
        self.doc_ids = np.frombuffer(raw, "<i8", self.n_docs)
        self.nulls = np.frombuffer(raw, np.uint8, self.n_docs, 8 * self.n_docs).astype(bool)
        self.counts = np.frombuffer(raw, _U64, self.n_docs, 9 * self.n_docs).astype(np.int64)
        self.places = [*np.frombuffer(raw, _U64, n_blocks, 17 * self.n_docs).tolist(), self.index]

    def block(self, k: int, low: int = 0, high: int | None = None) -> np.ndarray:
        return decode_block(self.source.read_at(self.places[k + 1] - self.places[k], self.places[k]), self.table, low, high)

    def between(self, low: int, high: int) -> np.ndarray:
        """Ids ``low`` to ``high`` of the file; only blocks and checkpoints around them are read."""
        high = min(high, self.n_ids)
        parts = [self.block(k, max(0, low - k * BLOCK), high - k * BLOCK) for k in range(low // BLOCK, -(-high // BLOCK))]
        return np.concatenate([np.zeros(0, _U32), *parts])

    def documents(self) -> Iterator[tuple[int, int]]:
        """Number of tokens and checksum of every document, a block at a time."""
        k, ids, at = 0, np.zeros(0, _U32), 0
        for left in self.counts.tolist():
            n, check = left, 0
            while left:
                if at == len(ids):
                    ids, at, k = self.block(k), 0, k + 1
                some = ids[at : at + left]
                check = zlib.crc32(some, check)
                at, left = at + len(some), left - len(some)
            yield n, check

    def close(self) -> None:
        self.source.close()


def read_digests(spark: SparkSession, files: Files) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, decoded from the files, one task each."""
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not files.numbers:
        return spark.createDataFrame([], schema)
    folder, numbers, starts, table_file = files.folder, files.numbers, files.starts, files.table_file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for batch in batches:
            for k in batch.column(0).to_pylist():
                table = table or Table.load(read_file(folder, table_file))
                reader = Reader(folder, numbers[k], table)
                n, check = np.array(list(reader.documents()), np.int64).reshape(-1, 2).T
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(reader.doc_ids, mask=reader.nulls),
                        pa.array(starts[k] + np.cumsum(n) - n),
                        pa.array(n),
                        pa.array(check),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )
                reader.close()

    return spark.range(0, len(numbers), 1, len(numbers)).mapInArrow(run, schema)


def read_between(files: Files, low: int, high: int) -> np.ndarray:
    """Ids ``low`` to ``high`` of the whole corpus, for a caller that wants a stretch of it."""
    table = Table.load(read_file(files.folder, files.table_file))
    out = [np.zeros(0, _U32)]
    for number, begin, end in zip(files.numbers, files.starts, files.starts[1:]):
        if begin < high and end > low:
            reader = Reader(files.folder, number, table)
            out.append(reader.between(max(0, low - begin), high - begin))
            reader.close()
    return np.concatenate(out)


def write_documents(docs: DataFrame, tokenizer_path: str, end_id: int, by_word: bool = False, folder: str | None = None) -> Files:
    """All documents' ids as files in ``folder``, by default a new one in the shared folder."""
    encoded = materialize(encode(docs, tokenizer_path, end_id, by_word), "token-ids")
    return write(encoded, count(encoded), folder or scratch_path(docs.sparkSession, "token-files"))
