"""Blocks of vectors as files that workers map.

A block is written once, by the task that packed it. From then on a pair of blocks
travels as two names: a task takes the pairs of one left block in a row, maps each
right one, and sends off results only. No vector is shuffled for a pair.

A file appears under its name when it is whole, so a repeated task does no harm. A
mounted folder is mapped in place; from a remote one a worker copies a block to a file
that it unlinks as soon as it is mapped.
"""

from __future__ import annotations

import itertools
import json
import math
import tempfile
import uuid
from collections import OrderedDict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as vx
from ..session import materialize, scratch_path

PAIRS = 256  # pairs of blocks that a task works on
OPEN = 64  # blocks that a worker keeps mapped

Tile = dict[str, np.ndarray]


def unpack(rows: pa.Array | pa.ChunkedArray) -> Tile:
    """The struct rows of one block as arrays; ``v`` becomes a matrix."""
    if isinstance(rows, pa.ChunkedArray):
        rows = rows.combine_chunks()
    structs = rows.flatten()
    names = [structs.type.field(i).name for i in range(structs.type.num_fields)]
    fields = dict(zip(names, structs.flatten()))
    return {n: vx.to_matrix(c) if n == "v" else c.to_numpy(zero_copy_only=False) for n, c in fields.items()}


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _write(folder: str, name: str, tile: Tile) -> None:
    head = json.dumps([[key, x.dtype.str, *x.shape] for key, x in tile.items()]).encode()
    head += b" " * (-len(head) % 8)
    system, path = _open(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as out:
        out.write(len(head).to_bytes(8, "little") + head)
        for x in tile.values():
            out.write(np.ascontiguousarray(x))
            out.write(b"\0" * (-x.nbytes % 8))
    system.move(draft, f"{path}/{name}")


def write_tiles(packed: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``packed`` (name string, rows array<struct<..., v>>, ...): what is left of it without the rows, and the folder."""
    folder = scratch_path(packed.sparkSession, label)
    kept = packed.drop("rows").schema
    # numbers that came as float32 are written as such
    single = "v:array<float>" in packed.schema["rows"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("rows")
            for k, name in enumerate(batch.column("name").to_pylist()):
                tile = unpack(batch.column(at).slice(k, 1))
                if "v" in tile:
                    tile["v"] = tile["v"].astype(np.float32 if single else np.float64)
                _write(folder, name, tile)
            columns = [c for i, c in enumerate(batch.columns) if i != at]
            yield pa.RecordBatch.from_arrays(columns, names=[n for n in batch.schema.names if n != "rows"])

    return materialize(packed.mapInArrow(run, kept), label), folder


_MAPPED: OrderedDict[tuple[str, str], Tile] = OrderedDict()


def read_tile(folder: str, name: str) -> Tile:
    key = (folder, name)
    if key not in _MAPPED:
        while len(_MAPPED) >= OPEN:
            _MAPPED.popitem(last=False)
        _MAPPED[key] = _map(folder, name)
    _MAPPED.move_to_end(key)
    return _MAPPED[key]


def _map(folder: str, name: str) -> Tile:
    system, path = _open(f"{folder}/{name}")
    if isinstance(system, fs.LocalFileSystem):
        raw = np.memmap(path, np.uint8, "r")
    else:
        with tempfile.NamedTemporaryFile() as copy:
            with system.open_input_stream(path) as source:
                while chunk := source.read(1 << 22):
                    copy.write(chunk)
            copy.flush()
            raw = np.memmap(copy.name, np.uint8, "r")
    at = 8 + int.from_bytes(raw[:8].tobytes(), "little")
    tile = {}
    for key, kind, *shape in json.loads(raw[8:at].tobytes()):
        size = int(np.prod(shape)) * np.dtype(kind).itemsize
        tile[key] = raw[at : at + size].view(kind).reshape(shape)
        at += size + -size % 8
    return tile


def loaded(folder: str, name: str) -> Tile:
    """A block with its vectors as float64, as arithmetic on them is done."""
    tile = read_tile(folder, name)
    return {**tile, "v": tile["v"].astype(np.float64)}


def _dealt(pairs: DataFrame) -> DataFrame:
    """The pairs in tasks of about ``PAIRS``, those of one left block in a row.

    The number of tasks is given: a pair is two short names, so by its bytes adaptive
    execution would put hours of work into one task.
    """
    named = materialize(pairs.select("a", "b"), "pairs")
    n = named.count()
    tasks = max(math.ceil(n / PAIRS), min(n, 4 * named.sparkSession.sparkContext.defaultParallelism), 1)
    return named.repartitionByRange(tasks, "a", "b").sortWithinPartitions("a", "b")


def over_runs(pairs: DataFrame, folder: str, work: Callable[[Tile, str, Iterator[tuple[str, Tile]]], Iterator[pa.Table]], schema: str) -> DataFrame:
    """The results of ``work(left, a, rights)``, ``rights`` being those (b, right) that one task meets for the block ``a``.

    What a left block gathers from many right ones can be put together before it leaves the task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named = (pair for batch in batches for pair in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()))
        for a, met in itertools.groupby(named, key=lambda pair: pair[0]):
            left = loaded(folder, a)
            rights = ((b, left if a == b else loaded(folder, b)) for _, b in met)
            for table in work(left, a, rights):
                yield from table.to_batches()

    return _dealt(pairs).mapInArrow(run, schema)


def over_pairs(pairs: DataFrame, folder: str, work: Callable[[Tile, Tile, str, str], pa.Table], schema: str) -> DataFrame:
    """The results of ``work(left, right, a, b)`` for all ``pairs`` (a, b) of block names."""

    def each(left: Tile, a: str, rights: Iterator[tuple[str, Tile]]) -> Iterator[pa.Table]:
        return (work(left, right, a, b) for b, right in rights)

    return over_runs(pairs, folder, each, schema)
