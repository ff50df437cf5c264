"""Sorted hash arrays in the shared folder, memory-mapped by the workers that look things up.

Tasks write one file per shard: the sorted 64-bit keys, then each value column. A
shard holds the keys whose leading 16 bits fall into its range, so one search over
the shards' bounds and one inside a shard find a key. Where the shared folder is
not a mounted path, a worker copies a shard once to a file that it unlinks as soon
as it is mapped.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .words import mix


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(48)) * np.uint64(shards) >> np.uint64(16)).astype(np.int64)


def shard_column(key: Column, shards: int) -> Column:
    return F.shiftrightunsigned(F.shiftrightunsigned(key, 48) * shards, 16).cast("int")


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def write_shard(folder: str, shard: int, keys: np.ndarray, *values: np.ndarray) -> int:
    """A whole file under its final name, or none: a repeated or lost attempt leaves no half shard."""
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{shard}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(np.ascontiguousarray(keys))
        for value in values:
            out.write(np.ascontiguousarray(value))
    system.move(draft, f"{path}/{shard:06d}")
    return len(keys)


def write_arrays(df: DataFrame, label: str, key: str, values: list[str], shards: int) -> "HashArrays":
    """Distinct keys of ``df`` (long) with their value columns (long) as sorted arrays."""
    folder = scratch_path(df.sparkSession, label)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if len(batch)]
        if not held:
            return
        table = pa.Table.from_batches(held)
        shard, *columns = (table.column(k).to_numpy() for k in range(table.num_columns))
        order = np.lexsort((columns[0].view(np.uint64), shard))
        ends = np.flatnonzero(np.diff(shard[order], prepend=-1, append=-1))
        for low, high in zip(ends[:-1], ends[1:]):
            some = order[low:high]
            write_shard(folder, int(shard[some[0]]), *(c[some].view(np.uint64) for c in columns))
            yield pa.RecordBatch.from_arrays([pa.array([int(shard[some[0]])]), pa.array([high - low])], names=["shard", "n"])

    dealt = df.select(shard_column(F.col(key), shards).alias("shard"), key, *values).repartition(shards, "shard")
    sizes = {r["shard"]: r["n"] for r in dealt.mapInArrow(run, "shard long, n long").collect()}
    return HashArrays(folder, shards, sizes, [np.dtype(np.uint64)] * len(values))


@dataclass
class HashArrays:
    """Where the arrays are and how long; small, so it travels with the tasks."""

    folder: str
    shards: int
    sizes: dict[int, int]
    types: list[np.dtype] = field(default_factory=list)

    def find(self, keys: np.ndarray, routes: np.ndarray | None = None) -> tuple[np.ndarray, list[np.ndarray]]:
        """Which of the keys are there, and their values (0 where not).

        ``routes`` stand for the keys in the choice of a shard, if these were dealt by something else.
        """
        found = np.zeros(len(keys), bool)
        values = [np.zeros(len(keys), t) for t in self.types]
        shard = shard_of(keys if routes is None else routes, self.shards)
        order = np.lexsort((keys, shard)) if routes is not None else np.argsort(keys)
        ends = np.searchsorted(shard[order], np.arange(self.shards + 1))
        for shard in np.flatnonzero(np.diff(ends)):
            if not self.sizes.get(int(shard)):
                continue
            some = order[ends[shard] : ends[shard + 1]]
            there, *columns = self.mapped(int(shard))
            at = np.minimum(np.searchsorted(there, keys[some]), len(there) - 1)
            hit = there[at] == keys[some]
            found[some] = hit
            for value, column in zip(values, columns):
                value[some[hit]] = column[at[hit]]
        return found, values

    def raw(self, shard: int) -> np.ndarray:
        name = (self.folder, shard)
        if name not in _MAPPED:
            if len(_MAPPED) >= _MOST_MAPPED:
                _MAPPED.clear()
            _MAPPED[name] = _map(self.folder, shard)
        return _MAPPED[name]

    def mapped(self, shard: int) -> list[np.ndarray]:
        n, raw, at, out = self.sizes[shard], self.raw(shard), 0, []
        for kind in [np.dtype(np.uint64), *self.types]:
            out.append(raw[at : at + n * kind.itemsize].view(kind))
            at += n * kind.itemsize
        return out


_MAPPED: dict[tuple[str, int], np.ndarray] = {}
_MOST_MAPPED = 4096


def _map(folder: str, shard: int) -> np.ndarray:
    system, path = open_folder(folder)
    path = f"{path}/{shard:06d}"
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(path, np.uint8, "r")
    with tempfile.NamedTemporaryFile() as copy:
        with system.open_input_stream(path) as source:
            while chunk := source.read(1 << 22):
                copy.write(chunk)
        copy.flush()
        return np.memmap(copy.name, np.uint8, "r")


ENTRIES = 1 << 20  # ids in one shard of a list


def _mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first column, an id, under the hash by which lists are searched."""
    for batch in batches:
        key = pa.array(mix(batch.column(0).to_numpy().view(np.uint64)).view(np.int64))
        yield pa.RecordBatch.from_arrays([key, *batch.columns[1:]], names=batch.schema.names)


def list_ids(df: DataFrame, label: str) -> HashArrays:
    """The distinct ids of the first column (long, none null), with the other columns (long) as values."""
    key, *values = df.columns
    hashed = df.mapInArrow(_mixed, df.schema)
    return write_arrays(hashed, label, key, values, max(1, -(-df.count() // ENTRIES)))


def find_ids(ids: pa.Array, listed: HashArrays) -> tuple[np.ndarray, list[np.ndarray]]:
    """Which ids are in the list, and their values; a null id never is."""
    whole = ids.cast(pa.int64())
    found, values = listed.find(mix(whole.fill_null(0).to_numpy().view(np.uint64)))
    return found & whole.is_valid().to_numpy(zero_copy_only=False), values


def rows_by_id(docs: DataFrame, listed: HashArrays, inside: bool) -> DataFrame:
    """The rows whose doc_id is in the list, or those whose is not; null ids are in neither list nor doubt: they stay.

    Workers look ids up, so no row is shuffled.
    """
    at = docs.columns.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                found, _ = find_ids(batch.column(at), listed)
                stays = (found == inside) | batch.column(at).is_null().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(stays))

    return docs.mapInArrow(run, docs.schema)


def remote_file(folder: str, name: str, data: bytes) -> None:
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(data)
    system.move(draft, f"{path}/{name}")


def read_file(folder: str, name: str) -> bytes:
    system, path = open_folder(folder)
    with system.open_input_stream(f"{path}/{name}") as source:
        return source.read()
