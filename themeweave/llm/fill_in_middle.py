"""Fill-in-the-middle documents, cut between units of text.

Texts are cut as bytes. An index lists only the exceptions from one byte a character:
the places of multibyte characters and the bytes they have in excess. One binary search
in it turns a byte cut into a code-point cut or back; what lies between exceptions is
arithmetic, and an ASCII text has an empty index.

A unit is a run of ASCII letters or one other character. Cuts and form of a document
are drawn from the digest of seed and doc_id, so reruns agree and no order matters.

Defined results: a null text counts as empty. An empty text, and one that holds a mark
itself, stays plain. A null doc_id is drawn for as an empty name. Repeated rows get the
same result each; an empty table gives no rows; columns other than doc_id and text are
ignored. Memory in a task is bounded by a block of documents or by the longest one: the
text twice, and 12 bytes for each of its multibyte characters.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import spans

MARKS = ("<P>", "<S>", "<M>")
FORMS = ("plain", "psm", "spm")
PIECE = 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


@dataclass(frozen=True)
class Rule:
    seed: str = "1"
    percent: int = 90  # of the documents are cut
    spm_percent: int = 20  # of those begin with the suffix
    marks: tuple[str, str, str] = MARKS

    def __post_init__(self):
        for a in self.marks:
            for b in self.marks:
                if any(b.startswith(a[k:]) for k in range(0 if a != b else 1, len(a))) or not a:
                    raise ValueError("no mark may begin with the end of a mark")

    @property
    def pattern(self) -> str:
        return "|".join(re.sub(r"([^A-Za-z0-9_])", r"\\\1", m) for m in self.marks)

    def drawn(self, doc_id: int | None) -> tuple[int, int, int, int]:
        code = hashlib.sha256(f"{self.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
        return tuple(int(code[k : k + 8], 16) for k in range(0, 32, 8))


class Exceptions:
    """Where characters of more than one byte are, and how many bytes more they have."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0).astype(np.int32)  # continuation bytes are below
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int32) + (lead >= 0xF0)
        self.excess = np.cumsum(excess, dtype=np.int32)
        self.char = self.at - (self.excess - excess)

    def _before(self, places: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Excess bytes of the exceptions before each cut."""
        if not len(places):
            return np.zeros(len(cuts), np.int64)
        n = np.searchsorted(places, cuts)
        return np.where(n > 0, self.excess[n - 1], 0)

    def chars(self, cuts: np.ndarray) -> np.ndarray:
        return cuts - self._before(self.at, cuts)

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        return cuts + self._before(self.char, cuts)


def _starts(data: np.ndarray, low: int, high: int, document_starts: np.ndarray) -> np.ndarray:
    """Where units begin in data[low:high]."""
    some = data[low:high]
    letter = _LETTER[some]
    follows = np.zeros(len(some), bool)
    follows[1:] = letter[:-1]
    follows[:1] = low > 0 and _LETTER[data[low - 1]]
    inside = document_starts[np.searchsorted(document_starts, low) : np.searchsorted(document_starts, high)]
    follows[inside - low] = False
    return np.flatnonzero(np.where(letter, ~follows, (some & 0xC0) != 0x80)) + low


def unit_counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Units before each document, one more than there are, and units before each piece."""
    begins = np.unique(offsets[:-1][offsets[:-1] < len(data)])
    before, pieces = np.zeros(len(offsets), np.int64), [0]
    for low in range(0, len(data), PIECE):
        starts = _starts(data, low, min(len(data), low + PIECE), begins)
        inside = (offsets > low) & (offsets <= low + PIECE)
        before[inside] = pieces[-1] + np.searchsorted(starts, offsets[inside])
        pieces.append(pieces[-1] + len(starts))
    return before, np.array(pieces)


def unit_cuts(data: np.ndarray, offsets: np.ndarray, pieces: np.ndarray, units: np.ndarray) -> np.ndarray:
    """Byte places before which so many units of the block end; units count from the block's first."""
    begins = np.unique(offsets[:-1][offsets[:-1] < len(data)])
    cuts = np.full(len(units), len(data))
    where = np.searchsorted(pieces, units, "right") - 1
    for piece in np.unique(where[units < pieces[-1]]).tolist():
        some = np.flatnonzero((where == piece) & (units < pieces[-1]))
        starts = _starts(data, piece * PIECE, min(len(data), (piece + 1) * PIECE), begins)
        cuts[some] = starts[units[some] - pieces[piece]]
    return cuts


def _holding(data: bytes, offsets: np.ndarray, pattern: bytes) -> np.ndarray:
    """Which documents of a block hold a mark."""
    out = np.zeros(len(offsets) - 1, bool)
    for found in re.finditer(pattern, data):
        # places inside marks of two neighbours together are in neither
        k = int(np.searchsorted(offsets, found.start(), "right")) - 1
        if found.end() <= offsets[k + 1]:
            out[k] = True
    return out


def assembled(form: str, prefix: bytes, middle: bytes, suffix: bytes, marks: tuple[str, str, str]) -> bytes:
    p, s, m = (x.encode() for x in marks)
    if form == "psm":
        return b"".join([p, prefix, s, suffix, m, middle])
    if form == "spm":
        return b"".join([s, suffix, p, prefix, m, middle])
    return prefix + middle + suffix


_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())]
)


def _block(ids: pa.Array, offsets: np.ndarray, data: np.ndarray, rule: Rule) -> pa.RecordBatch:
    before, pieces = unit_counts(data, offsets)
    n = np.diff(before)
    raw = data.tobytes()
    h1, h2, h3, h4 = np.array([rule.drawn(i) for i in ids.to_pylist()], np.int64).reshape(-1, 4).T
    plain = (n == 0) | (h3 % 100 >= rule.percent) | _holding(raw, offsets, rule.pattern.encode())
    form = np.where(plain, 0, np.where(h4 % 100 < rule.spm_percent, 2, 1))
    a, b = h1 % (n + 1), h2 % (n + 1)
    low = np.minimum(unit_cuts(data, offsets, pieces, before[:-1] + np.minimum(a, b)), offsets[1:])
    high = np.minimum(unit_cuts(data, offsets, pieces, before[:-1] + np.maximum(a, b)), offsets[1:])
    index = Exceptions(data)
    begin_char, low_char, high_char = index.chars(offsets[:-1]), index.chars(low), index.chars(high)
    output = [
        assembled(FORMS[f], raw[i:j], raw[j:k], raw[k:l], rule.marks)
        for f, i, j, k, l in zip(form.tolist(), offsets[:-1].tolist(), low.tolist(), high.tolist(), offsets[1:].tolist())
    ]
    return pa.RecordBatch.from_arrays(
        [
            ids,
            pa.array(n),
            pa.array(np.array(FORMS, object)[form], pa.string()),
            pa.array(low_char - begin_char, mask=plain),
            pa.array(high_char - low_char, mask=plain),
            pa.array(output, pa.binary()).cast(pa.string()),
        ],
        schema=_SCHEMA,
    )


def transform(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (null if plain), output of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, offsets, data in spans(batch.column(1)):
                yield _block(batch.column(0).slice(low, len(offsets) - 1), offsets, data, rule)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def recut(docs: DataFrame, marks: tuple[str, str, str] = MARKS) -> DataFrame:
    """``docs`` (doc_id, text, form, prefix_chars, middle_chars) cut again at recorded code points: doc_id, output."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, offsets, data in spans(batch.column(1)):
                size, raw, index = len(offsets) - 1, data.tobytes(), Exceptions(data)
                prefix, middle = (batch.column(k).slice(first, size).fill_null(0).to_numpy() for k in (3, 4))
                begin = index.chars(offsets[:-1])
                low, high = index.bytes(begin + prefix), index.bytes(begin + prefix + middle)
                forms = batch.column(2).slice(first, size).to_pylist()
                output = [
                    assembled(f, raw[i:j], raw[j:k], raw[k:l], marks)
                    for f, i, j, k, l in zip(forms, offsets[:-1].tolist(), low.tolist(), high.tolist(), offsets[1:].tolist())
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, size), pa.array(output, pa.binary()).cast(pa.string())], names=["doc_id", "output"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "form", "prefix_chars", "middle_chars")
    return rows.mapInArrow(run, "doc_id long, output string")


def restored(output: Column, form: Column, rule: Rule = Rule()) -> Column:
    """The text that an output of this form was made of."""
    parts = F.split(output, rule.pattern, -1)
    part = lambda k: F.get(parts, F.lit(k))
    return (
        F.when(form == "psm", F.concat(part(1), part(3), part(2)))
        .when(form == "spm", F.concat(part(2), part(3), part(1)))
        .otherwise(output)
    )


def digest(made: DataFrame, rule: Rule = Rule()) -> DataFrame:
    code = lambda text: F.sha2(text.cast("binary"), 256)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        code(F.col("output")).alias("output_sha256"),
        code(restored(F.col("output"), F.col("form"), rule)).alias("restored_sha256"),
    )
