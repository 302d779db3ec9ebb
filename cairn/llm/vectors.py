"""Helpers for columns of vectors."""
from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released


def usable(column: str, most: float):
    """Whether a vector is not null and each entry is a number of size `most` at most."""
    entry = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= F.lit(float(most)))
    return F.col(column).isNotNull() & F.forall(column, entry)


def vectors(df: DataFrame, id_column: str, column: str, most: float, dim: int) -> DataFrame:
    """(id, x) of the rows whose vector has `dim` entries, all of them usable; x holds doubles."""
    slim = df.select(F.col(id_column).alias("id"), F.col(column).cast("array<double>").alias("x"))
    return slim.where((F.size("x") == dim) & usable("x", most))


def matrix(column, dim: int) -> np.ndarray:
    """The rows of an Arrow list column whose lists all have `dim` entries."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def tree_sum(df: DataFrame, start: Callable, add: Callable, merge: Callable):
    """add(start(), batch) over each partition's Arrow batches, then the partitions' states merged by treeAggregate; None without partitions."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        state = start()
        for batch in batches:
            if batch.num_rows:
                state = add(state, batch)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(state)], pa.binary())], ["state"])

    def join(a, b):
        return b if a is None else a if b is None else merge(a, b)

    states = df.mapInArrow(released(run), "state binary").rdd
    return states.treeAggregate(None, lambda held, row: join(held, pickle.loads(row[0])), join)


def whole_sums(x: np.ndarray) -> list[int]:
    """Exact column sums of int64 values of up to 2**53 in size."""
    high, low = x >> 26, x & ((1 << 26) - 1)
    return [(int(h) << 26) + int(v) for h, v in zip(high.sum(axis=0), low.sum(axis=0), strict=True)]


def decimals(values: list[int]):
    """Python integers as decimal(38, 0); null where one has more digits."""
    import pyarrow as pa

    return pa.array([Decimal(v) if abs(v) < 10**38 else None for v in values], pa.decimal128(38, 0))
