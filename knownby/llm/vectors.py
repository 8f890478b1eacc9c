"""Integer vectors from columns of floating-point arrays, and sorted groups as streams of batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_vectors(rows: DataFrame, vector: str, scale: int, name: str = "x") -> DataFrame:
    """``rows`` with a vector of finite entries, its entries v as floor(scale * v) in ``name``.

    Rows whose vector is null or holds a null or non-finite entry are left out. Entries beyond the range of a
    long take its nearest end. Vectors shorter than the longest are filled up with zeros, empty ones to one zero at least.
    """
    odd = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    fine = rows.where(F.col(vector).isNotNull() & ~odd)
    width = fine.agg(F.max(F.size(vector))).first()[0] or 1
    scaled = F.transform(vector, lambda v: F.floor(v.cast("double") * float(scale)))
    filled = F.concat(scaled, F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size(vector)))
    return fine.withColumn(name, filled)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an Arrow column of arrays of equal width."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def squares(x: np.ndarray) -> np.ndarray:
    """Squared lengths of integer rows as doubles."""
    rows = x.astype(np.float64)
    return np.einsum("ij,ij->i", rows, rows)


def inner_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two blocks as longs; those beyond a long take its nearest end."""
    reach = np.abs(x.astype(np.float64)).max(initial=0.0) * np.abs(y.astype(np.float64)).max(initial=0.0) * x.shape[1]
    if reach < 2.0**53:
        return (x.astype(np.float64) @ y.astype(np.float64).T).astype(np.int64)
    if reach < 2.0**62:
        return x @ y.T
    wide = x.astype(object) @ y.astype(object).T
    return np.clip(wide, -(2**63), 2**63 - 1).astype(np.int64)


def groups_of(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """The parts of sorted batches within which ``keys`` are the same, in their order."""
    for b in batches:
        if not b.num_rows:
            continue
        columns = [b[k].to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(b.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.append(0, np.flatnonzero(change))
        for at, end in zip(starts, np.append(starts[1:], b.num_rows)):
            yield tuple(c[at].item() for c in columns), b.slice(at, end - at)


def streamed(
    rows: DataFrame, keys: tuple[str, ...], role: str, solve: Callable[[list[pa.RecordBatch], Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Per group of ``keys``: the rows of role 0, then those of role 1 as a stream.

    ``solve(first, rest)`` gets the former, whose number the caller bounds, as a list of batches, and the latter
    batch by batch: a group of any size goes through a task in bounded memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = groups_of(batches, (*keys, role))
        ahead = next(parts, None)
        while ahead is not None:
            key = ahead[0][:-1]
            first: list[pa.RecordBatch] = []
            while ahead is not None and ahead[0] == (*key, 0):
                first.append(ahead[1])
                ahead = next(parts, None)

            def rest() -> Iterator[pa.RecordBatch]:
                nonlocal ahead
                while ahead is not None and ahead[0] == (*key, 1):
                    part = ahead[1]
                    ahead = next(parts, None)
                    yield part

            stream = rest()
            if first:
                yield from solve(first, stream)
            for _ in stream:
                pass

    return rows.repartition(*keys).sortWithinPartitions(*keys, role).mapInArrow(run, schema)
