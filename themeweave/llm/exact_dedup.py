"""Exact duplicates by composable polynomial fingerprints.

A text is cut into chunks of ``CHUNK`` bytes. A chunk's hash is a polynomial in its
bytes modulo a prime; two neighbouring pieces combine as ``a + base**len(a) * b``,
so the hash of a document does not depend on how it was cut or where the parts
were hashed. Besides the text itself and its normalised form a task holds about
``PIECE`` bytes' worth of arrays, however long the text. Texts of equal fingerprint and length are then compared chunk by chunk.

Defined results: a null text counts as empty, and all empty texts are equal. Rows
that repeat id and text are copies of one another, count in ``group_size`` and carry
the same flags; ``drop_copies`` keeps one of them. A null doc_id is larger than any
other. Columns other than doc_id and text are ignored, and kept by ``drop_copies``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .hash_arrays import list_ids, rows_by_id
from .words import SPACE, spans

CHUNK = 1 << 16
PIECE = 1 << 20  # bytes of a long text that are worked on at a time
PRIME = (1 << 31) - 1
BASES = (1_220_703_125, 742_938_285)
SEPARATORS = r"[\x20\x09-\x0D]+"

_SCHEMA = "doc_id long, n_bytes long, chunks array<struct<h1: long, s1: long, h2: long, s2: long>>, text_sha256 string"
_TYPE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("chunks", pa.list_(pa.struct([(name, pa.int64()) for name in ("h1", "s1", "h2", "s2")]))),
        ("text_sha256", pa.string()),
    ]
)


def powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    size = 1
    while size < n:  # double what there is
        more = min(size, n - size)
        out[size : size + more] = out[:more] * np.uint64(pow(base, size, PRIME)) % np.uint64(PRIME)
        size += more
    return out


def squeeze(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each run of separators inside a document becomes one space."""
    if len(offsets) == 2 and len(data) > PIECE:
        return _squeeze_long(data)
    space = SPACE[data]
    repeated = np.zeros(len(data), bool)
    repeated[1:] = space[1:] & space[:-1]
    repeated[offsets[offsets < len(data)]] = False
    kept = ~repeated
    before = np.zeros(len(data) + 1, np.int64)
    np.cumsum(kept, out=before[1:])
    return np.where(space, np.uint8(32), data)[kept], before[offsets]


def _squeeze_long(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same of one long document, a piece at a time."""
    out, n, last = np.empty(len(data), np.uint8), 0, False
    for low in range(0, len(data), PIECE):
        some = data[low : low + PIECE]
        space = SPACE[some]
        kept = ~space
        kept[1:] |= ~space[:-1]
        kept[0] |= not last
        last = bool(space[-1])
        piece = np.where(space, np.uint8(32), some)[kept]
        out[n : n + len(piece)] = piece
        n += len(piece)
    return out[:n], np.array([0, n])


def chunk_hashes(data: np.ndarray, offsets: np.ndarray, chunk: int, tables: list[np.ndarray]):
    """Number of chunks of each document, and per chunk its hashes and shifts.

    Chunks do not depend on each other; about ``PIECE`` bytes of them are hashed at a time.
    """
    lengths = np.diff(offsets)
    each = -(-lengths // chunk)
    within = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    start = np.repeat(offsets[:-1], each) + within * chunk
    length = np.minimum(chunk, np.repeat(lengths, each) - within * chunk)
    hashed = np.zeros((len(BASES), len(start)), np.uint64)
    low = 0
    while low < len(start):
        high = max(low + 1, int(np.searchsorted(start, start[low] + PIECE)))
        first, some = start[low], length[low:high]
        place = np.arange(some.sum()) - np.repeat(start[low:high] - first, some)
        values = data[first : first + len(place)].astype(np.uint64) + np.uint64(1)
        for out, table in zip(hashed, tables):
            out[low:high] = np.add.reduceat(values * table[place], start[low:high] - first) % np.uint64(PRIME)
        low = high
    out = []
    for base, table, some in zip(BASES, tables, hashed):
        full = pow(base, chunk, PRIME)
        shift = np.where(length == chunk, full, table[np.minimum(length, chunk - 1)].astype(np.int64))
        out += [some.astype(np.int64), shift]
    return each, out


def _hashed(chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [powers(base, chunk) for base in BASES]
        for batch in batches:
            for low, offsets, data in spans(batch.column(1)):
                data, offsets = squeeze(data, offsets)
                each, columns = chunk_hashes(data, offsets, chunk, tables)
                view = memoryview(data)
                digest = [hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                items = pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["h1", "s1", "h2", "s2"])
                ends = np.concatenate([[0], np.cumsum(each)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, len(offsets) - 1),
                        pa.array(np.diff(offsets)),
                        pa.ListArray.from_arrays(ends, items).cast(_TYPE.field("chunks").type),
                        pa.array(digest),
                    ],
                    schema=_TYPE,
                )

    return run


def _combined(hash_name: str, shift_name: str):
    """The document's hash from its chunks', by length-shifted sums."""
    zero = F.struct(F.lit(0).cast("long").alias("h"), F.lit(1).cast("long").alias("s"))
    return F.aggregate(
        "chunks",
        zero,
        lambda a, c: F.struct(
            ((a["h"] + a["s"] * c[hash_name]) % PRIME).alias("h"), (a["s"] * c[shift_name] % PRIME).alias("s")
        ),
        lambda a: a["h"],
    )


def fingerprints(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """doc_id, n_bytes, f1, f2, text_sha256 of every row's normalised text."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_hashed(chunk), _SCHEMA).select(
        "doc_id", "n_bytes", _combined("h1", "s1").alias("f1"), _combined("h2", "s2").alias("f2"), "text_sha256"
    )


KEY = ["f1", "f2", "n_bytes"]


def unequal(docs: DataFrame, prints: DataFrame, groups: DataFrame, piece: int = 1 << 12) -> DataFrame:
    """Keys of those groups whose texts differ in some chunk.

    Chunks of equal place are reduced to their least and greatest, partly before
    the shuffle, so a group of any size costs one row per task and place.
    """
    members = prints.join(groups.select(*KEY), KEY).select("doc_id", *KEY).distinct()
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SEPARATORS, " ")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    listed = list_ids(materialize(members.select("doc_id").where("doc_id is not null").distinct(), "members"), "member-ids")
    texts = rows_by_id(rows, listed, inside=True).select("doc_id", text.alias("text"))
    both = texts.join(members.withColumnRenamed("doc_id", "id"), F.col("doc_id").eqNullSafe(F.col("id")))
    places = F.sequence(F.lit(0), (F.length("text") / piece).cast("int"))
    pieces = both.select(*KEY, "text", F.explode(places).alias("place")).select(
        *KEY, "place", F.substring("text", F.col("place") * piece + 1, F.lit(piece)).alias("piece")
    )
    ends = pieces.groupBy(*KEY, "place").agg(F.min("piece").alias("least"), F.max("piece").alias("most"))
    return ends.where("least <> most").select(*KEY).distinct()


def exact_groups(docs: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Should texts of one fingerprint ever differ, that group is split by digest.
    """
    prints = materialize(fingerprints(docs, chunk), "prints")
    sized = F.count("*").alias("group_size")
    groups = materialize(
        prints.groupBy(*KEY).agg(sized, F.min("doc_id").alias("keep_id")).where("group_size > 1"), "groups"
    )
    wrong = materialize(unequal(docs, prints, groups), "unequal")
    split = prints.join(wrong, KEY, "left_semi").groupBy(*KEY, "text_sha256").agg(
        sized.alias("n"), F.min("doc_id").alias("least")
    )
    grouped = prints.join(groups, KEY, "left").join(materialize(split, "split"), [*KEY, "text_sha256"], "left")
    keep = F.coalesce("least", "keep_id", "doc_id")
    return grouped.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce("n", "group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep).alias("kept"),
        "text_sha256",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text is kept under a smaller doc_id, and without repeated rows.

    Ids are looked up, so that only rows of repeated or null ids are shuffled.
    """
    groups = materialize(exact_groups(docs), "exact-groups")
    fates = groups.groupBy("doc_id").agg(F.count("*").alias("n"), F.bool_or("kept").alias("kept"))
    fates = materialize(fates.where("n > 1 or not kept or doc_id is null"), "fates")
    ids = fates.where("doc_id is not null").select("doc_id")
    rest = rows_by_id(docs, list_ids(ids, "not-simply-kept"), inside=False).where("doc_id is not null")
    again = fates.where("doc_id is null or n > 1").select("doc_id")
    if not again.head(1):
        return rest
    # Rows of one id are told apart by their text; of rows equal in both one stays.
    unclear = rows_by_id(docs, list_ids(again.where("doc_id is not null"), "repeated"), inside=True)
    text = F.regexp_replace(F.coalesce(unclear["text"].cast("string"), F.lit("")), SEPARATORS, " ")
    digest, kept_id = "__digest_of_text", "__kept_doc_id"
    coded = unclear.withColumn(digest, F.sha2(text.cast("binary"), 256))
    kept = groups.where("kept").select(F.col("doc_id").alias(kept_id), F.col("text_sha256").alias("__kept_digest")).distinct()
    same = coded["doc_id"].eqNullSafe(kept[kept_id]) & (coded[digest] == kept["__kept_digest"])
    chosen = coded.join(kept, same, "left_semi").dropDuplicates(["doc_id", digest]).select(*docs.columns)
    return rest.unionByName(chosen)
