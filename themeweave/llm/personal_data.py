"""Personal data by base patterns and a semi-Markov conditional random field.

Base patterns find e-mail and IP addresses, payment cards and phone numbers; their
spans always stay. The field looks at windows where an entity can be at all: runs of
digits with their separators, and words with an @. A window's tokens are divided into
segments, each either one token of no type or an entity of at most ``LONGEST`` tokens
and ``WIDEST`` characters; without an @ it has ``DIGITS`` digits or more.
A segment's score is a sum of weights of features of the whole span (digits, check
digit, parts of an address, what stands around it), and a dynamic programme finds the
best division, boundaries and types together. Weights maximise the likelihood of the
base spans in at most ``EXAMPLES`` distinct windows per kind, chosen by hash among those
of at most ``TAUGHT`` characters.
The field divides what base spans leave of a window; entities of the best division that
score ``SURE`` or more are added.

Defined results: null and empty texts have no spans. Without windows to learn from
nothing is added. Rows are read one by one, so ties and repeated rows are alike.
Columns other than doc_id and text are ignored. Positions are code points, ends
exclusive. Time grows with the length of a text, whatever it holds: patterns begin at
the start of a run, and spans are compared in order.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import spans, sums_between

KINDS = ["email", "ip", "card", "phone"]
# Matches begin where a run does, so no run is read again from each of its characters.
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
MAIL = re.compile(LOCAL.pattern + DOMAIN.pattern)
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

NUMERIC = re.compile(r"[+(]?[0-9][0-9\x20().+-]*[0-9]")
WITH_AT = re.compile(r"(?<![^\s@])[^\s@]++@\S++")
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|\S")
TAUGHT = 200  # characters of the longest window that teaches
DIGITS = 7  # least number of digits in a window without an @
LONGEST = 24
WIDEST = 320  # characters of the longest entity
EXAMPLES = 120
SURE = 1.0  # least score of an added entity


def luhn(digits: str) -> bool:
    total = 0
    for k, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 16 <= len(digits) <= 19 and luhn(digits)


def _is_ip(text: str) -> bool:
    parts = [p.lstrip("0") for p in text.split(".") if p.isascii() and p.isdigit()]
    return len(parts) == 4 and text.count(".") == 3 and all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain; a local part is a whole run but for what a match before took."""
    at = 0
    while run := LOCAL.search(text, at):
        domain = DOMAIN.match(text, run.end())
        if domain:
            yield run.start(), domain.end()
        at = domain.end() if domain else run.end()


def rest(start: int, end: int, starts: list[int], ends: list[int]) -> Iterator[tuple[int, int]]:
    """What sorted spans, ``starts`` to ``ends`` and apart from each other, leave of a stretch."""
    k = bisect.bisect_right(ends, start)
    while k < len(starts) and starts[k] < end:
        if start < starts[k]:
            yield start, starts[k]
        start, k = max(start, ends[k]), k + 1
    if start < end:
        yield start, end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base patterns, by kind, then start."""
    out = []
    if "@" in text:
        out += [(0, start, end) for start, end in _emails(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if _is_ip(m[0])]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if m.end() - m.start() >= 16 and _is_card(m[0])]
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return out


def windows(text: str) -> Iterator[tuple[int, int]]:
    """Where entities can be, left to right; windows do not overlap."""
    found = [(m.start(), m.end()) for m in WITH_AT.finditer(text)] if "@" in text else []
    found += [(m.start(), m.end()) for m in NUMERIC.finditer(text) if m.end() - m.start() >= DIGITS and len(_digits(m[0])) >= DIGITS]
    last = 0
    for start, end in sorted(found):
        if start >= last:
            yield start, end
            last = end


FEATURES = [
    "bias", "digits<7", "digits7-9", "digits10-12", "digits13-15", "digits16-19", "digits20+", "check_digit", "address", "mail_form",
    "plus", "letters", "one_at", "more_at", "dot", "dots3", "spaces", "many_spaces", "brackets", "hyphens", "glued_left", "glued_right", "top_level",
]
_AT = {name: k for k, name in enumerate(FEATURES)}
WIDTH = len(FEATURES) * len(KINDS)


def span_features(text: str, start: int, end: int) -> list[int]:
    """Numbers of the features that the span has."""
    s, names = text[start:end], ["bias"]
    n = len(_digits(s))
    names.append(next((name for most, name in ((6, "digits<7"), (9, "digits7-9"), (12, "digits10-12"), (15, "digits13-15"), (19, "digits16-19")) if n <= most), "digits20+"))
    ats, dots, blanks = s.count("@"), s.count("."), s.count(" ")
    has = {
        "check_digit": 16 <= n <= 19 and luhn(_digits(s)),
        "address": dots == 3 and _is_ip(s),
        "mail_form": ats == 1 and MAIL.fullmatch(s) is not None,
        "plus": s[0] == "+",
        "letters": any(c.isalpha() for c in s),
        "one_at": ats == 1,
        "more_at": ats > 1,
        "dot": dots > 0,
        "dots3": dots == 3,
        "spaces": blanks > 0,
        "many_spaces": blanks > 4,
        "brackets": "(" in s or ")" in s,
        "hyphens": "-" in s,
        "glued_left": start > 0 and text[start - 1].isalnum(),
        "glued_right": end < len(text) and text[end].isalnum(),
        "top_level": re.search(r"\.[A-Za-z]{2,}$", s) is not None,
    }
    return [_AT[x] for x in names] + [_AT[name] for name, yes in has.items() if yes]


class Window:
    """The tokens of a stretch of text and the segments that may be entities."""

    def __init__(self, text: str, start: int, end: int):
        self.tokens = [(m.start(), m.end()) for m in TOKEN.finditer(text, start, end)]
        self.segments: list[tuple[int, int, list[int]]] = []  # first token, token after the last, features
        with_at = "@" in text[start:end]
        for i, (low, _) in enumerate(self.tokens):
            if not (text[low].isalnum() or text[low] in "+(") or with_at and text.find("@", low, low + WIDEST) < 0:
                continue
            for j in range(i, min(i + LONGEST, len(self.tokens))):
                high = self.tokens[j][1]
                if high - low > WIDEST:
                    break
                piece = text[low:high]
                if text[high - 1].isalnum() and ("@" in piece if with_at else high - low >= DIGITS and sum(c.isdigit() for c in piece) >= DIGITS):
                    self.segments.append((i, j + 1, span_features(text, low, high)))

    def scores(self, weights: np.ndarray) -> np.ndarray:
        table = weights.reshape(len(KINDS), -1)
        return np.array([table[:, f].sum(axis=1) for _, _, f in self.segments]).reshape(-1, len(KINDS))

    def best(self, weights: np.ndarray) -> list[tuple[int, int, int, float]]:
        """(kind, start, end, score) of the entities of the best division."""
        scores = self.scores(weights)
        kinds = scores.argmax(axis=1)
        ending: dict[int, list[int]] = {}
        for k, (_, j, _) in enumerate(self.segments):
            ending.setdefault(j, []).append(k)
        value, back = [0.0], [-1]
        for j in range(1, len(self.tokens) + 1):
            top, how = value[j - 1], -1
            for k in ending.get(j, ()):
                total = value[self.segments[k][0]] + scores[k, kinds[k]]
                if total > top:
                    top, how = total, k
            value.append(top)
            back.append(how)
        out, j = [], len(self.tokens)
        while j > 0:
            k = back[j]
            if k >= 0:
                i = self.segments[k][0]
                out.append((int(kinds[k]), self.tokens[i][0], self.tokens[j - 1][1], float(scores[k, kinds[k]])))
                j = i
            else:
                j -= 1
        return out[::-1]

    def gradient(self, weights: np.ndarray, true: dict[tuple[int, int], int]) -> tuple[float, np.ndarray]:
        """Log-likelihood of a division, and its gradient, by forward and backward sums."""
        scores, n = self.scores(weights), len(self.tokens)
        top = np.logaddexp.reduce(scores, axis=1) if len(scores) else np.zeros(0)
        ending: dict[int, list[int]] = {}
        beginning: dict[int, list[int]] = {}
        for k, (i, j, _) in enumerate(self.segments):
            ending.setdefault(j, []).append(k)
            beginning.setdefault(i, []).append(k)
        ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
        for j in range(1, n + 1):
            ahead[j] = _log_sum([ahead[j - 1], *(ahead[self.segments[k][0]] + top[k] for k in ending.get(j, ()))])
        for i in range(n - 1, -1, -1):
            behind[i] = _log_sum([behind[i + 1], *(behind[self.segments[k][1]] + top[k] for k in beginning.get(i, ()))])
        value, out = -ahead[n], np.zeros((len(KINDS), len(FEATURES)))
        for k, (i, j, features) in enumerate(self.segments):
            expected = np.exp(ahead[i] + behind[j] + scores[k] - ahead[n])
            kind = true.get((i, j))
            if kind is not None:
                value += scores[k, kind]
                expected[kind] -= 1
            out[:, features] -= expected[:, None]
        return value, out.ravel()

    def division(self, spans_: list[tuple[int, int, int]]) -> dict[tuple[int, int], int]:
        """The segments that are given spans."""
        places = {(self.tokens[i][0], self.tokens[j - 1][1]): (i, j) for i, j, _ in self.segments}
        return {places[start, end]: kind for kind, start, end in spans_ if (start, end) in places}


def _log_sum(values: list[float]) -> float:
    most = max(values)
    return most + math.log(sum(math.exp(v - most) for v in values))


def fit(examples: list[tuple[str, list[tuple[int, int, int]]]], rounds: int = 60, ridge: float = 0.02) -> np.ndarray:
    """Weights by adaptive gradient ascent. An example is a window with one character of context on either side, and its spans."""
    weights, square = np.zeros(WIDTH), np.full(WIDTH, 1e-6)
    known = []
    for text, found in examples:
        window = Window(text, 1, len(text) - 1)
        if window.segments:
            known.append((window, window.division(found)))
    for _ in range(rounds if known else 0):
        step = -ridge * weights * len(known)
        for window, true in known:
            step += window.gradient(weights, true)[1]
        square += step**2
        weights += 0.5 * step / np.sqrt(square)
    return weights


_DIGIT = np.zeros(256, np.int64)
_DIGIT[48:58] = 1


def worth_reading(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Documents with an @ or four digits; no others hold a base match or a window."""
    low, high = offsets[:-1], offsets[1:]
    return (sums_between((data == 64).astype(np.int64), low, high) > 0) | (sums_between(_DIGIT[data], low, high) >= 4)


def _in_context(text: str, start: int, end: int) -> str:
    before = text[start - 1] if start else " "
    after = text[end] if end < len(text) else " "
    return before + text[start:end] + after


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows with the base spans in them: kind (of the first span, -1 for none), window, spans as text."""
    for batch in batches:
        texts = batch.column(0)
        for low, offsets, data in spans(texts):
            rows = set()
            for k in np.flatnonzero(worth_reading(offsets, data)).tolist():
                text = texts[low + k].as_py() or ""
                base = sorted(base_spans(text), key=lambda x: x[1])
                starts = [a for _, a, _ in base]
                for start, end in windows(text):
                    if end - start <= TAUGHT:
                        near = base[bisect.bisect_left(starts, start) : bisect.bisect_left(starts, end)]
                        inside = sorted((kind, a - start + 1, b - start + 1) for kind, a, b in near if b <= end)
                        rows.add((inside[0][0] if inside else -1, _in_context(text, start, end), ",".join(f"{x}:{a}:{b}" for x, a, b in inside)))
            kinds, found, lists = zip(*sorted(rows)) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(found, pa.string()), pa.array(lists, pa.string())], names=["kind", "found", "spans"])


def learn(docs: DataFrame, examples: int = EXAMPLES) -> np.ndarray:
    """Weights from at most ``examples`` distinct windows of each kind and of none, by least hash."""
    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_windows, "kind int, found string, spans string").distinct()
    found = materialize(found, "examples")
    known = []
    for kind in range(-1, len(KINDS)):
        for r in found.where(F.col("kind") == kind).orderBy(F.xxhash64("found"), "found").limit(examples).collect():
            known.append((r["found"], [tuple(map(int, x.split(":"))) for x in r["spans"].split(",") if x]))
    return fit(known)


def all_spans(text: str, weights: np.ndarray | None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and the spans that the field adds."""
    base, added = base_spans(text), []
    if weights is not None and weights.any():
        starts, ends = [], []
        for a, b in sorted((a, b) for _, a, b in base):
            if ends and a < ends[-1]:
                ends[-1] = max(ends[-1], b)
            else:
                starts.append(a)
                ends.append(b)
        for window in windows(text):
            for start, end in rest(*window, starts, ends):
                if "@" not in text[start:end] and len(_digits(text[start:end])) < DIGITS:
                    continue
                shift = max(start - 1, 0)
                for kind, a, b, score in Window(text[shift : end + 1], start - shift, end - shift).best(weights):
                    if score >= SURE:
                        added.append((kind, a + shift, b + shift))
    return base, added


def joined(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in sorted(found))


_OUT = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"
_NONE = hashlib.sha256(b"").hexdigest()


def find(docs: DataFrame, weights: np.ndarray | None) -> DataFrame:
    """One row per row of ``docs`` with the numbers and places of its personal data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n = batch.column(1), len(batch)
            counts = np.zeros((5, n), np.int64)
            digests, lists = [_NONE] * n, [""] * n
            for low, offsets, data in spans(texts):
                for k in (np.flatnonzero(worth_reading(offsets, data)) + low).tolist():
                    base, added = all_spans(texts[k].as_py() or "", weights)
                    for kind, _, _ in base:
                        counts[kind, k] += 1
                    counts[4, k] = len(added)
                    if base or added:
                        lists[k] = joined(base + added)
                        digests[k] = hashlib.sha256(joined(base).encode()).hexdigest()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c) for c in counts[:4]), pa.array(digests), pa.array(lists), pa.array(counts[4])],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, _OUT)
