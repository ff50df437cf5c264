"""Vector helpers shared by the operators.

Vectors travel as ``array<float>`` columns. Arithmetic on them runs over Arrow
batches: array lambdas are interpreted element by element in the JVM, while one
matrix product per batch is not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_matrix(lists) -> np.ndarray:
    """An Arrow list column of equal-length vectors as one float64 matrix.

    A null vector, a null number or vectors of different length are an error:
    flattening would shift all that follow.
    """
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    if not len(lists):
        return np.empty((0, 0))
    if lists.null_count:
        raise ValueError(f"{lists.null_count} null vectors")
    values = lists.flatten()
    if values.null_count:
        raise ValueError(f"{values.null_count} null numbers in vectors")
    widths = pc.list_value_length(lists)
    if pc.min(widths).as_py() != pc.max(widths).as_py():
        raise ValueError(f"vectors of {pc.min(widths).as_py()} to {pc.max(widths).as_py()} numbers")
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


def _where_given(results, *columns: pa.Array) -> pa.Array:
    """Results of the rows where no column is null; null for the others."""
    given = pc.is_valid(columns[0])
    for column in columns[1:]:
        given = pc.and_(given, pc.is_valid(column))
    found = results(*(column.filter(given) for column in columns))
    place = pc.if_else(given, pc.cast(pc.subtract(pc.cumulative_sum(pc.cast(given, pa.int64())), 1), pa.int64()), pa.scalar(None, pa.int64()))
    return found.take(place)


def to_lists(matrix: np.ndarray) -> pa.Array:
    """A matrix as an Arrow column of float64 lists."""
    rows, width = matrix.shape
    offsets = np.arange(rows + 1, dtype=np.int32) * width
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(matrix.reshape(-1)))


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; zero rows stay zero."""
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def l2_normalize(vector: Column) -> Column:
    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def scaled(v: pa.Array) -> pa.Array:
        return _where_given(lambda x: to_lists(unit_rows(to_matrix(x))), v)

    return scaled(vector)


def cosine_similarity(left: Column, right: Column) -> Column:
    @F.arrow_udf(T.DoubleType())
    def cosine(a: pa.Array, b: pa.Array) -> pa.Array:
        return _where_given(lambda x, y: pa.array(np.einsum("ij,ij->i", unit_rows(to_matrix(x)), unit_rows(to_matrix(y)))), a, b)

    return cosine(left, right)


def squared_norm(vector: Column) -> Column:
    @F.arrow_udf(T.DoubleType())
    def norm2(v: pa.Array) -> pa.Array:
        return _where_given(lambda x: pa.array((to_matrix(x) ** 2).sum(axis=1)), v)

    return norm2(vector)
