"""Bloom filters that keep rows which a join drops anyway out of its shuffle."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame

from .common import mix64, released
from .vectors import tree_sum

MOST = 26
ODD = np.uint64(0x9E3779B97F4A7C15)


def _places(x: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for i in range(3):
        yield mix64(x * ODD + np.uint64(i + 1)) >> np.uint64(64 - bits)


def bloom(values: DataFrame):
    """Broadcast (bits, filter) of a column `x` of longs: a fixed size at most, so beyond some millions of values it lets more through, but never drops one."""
    n = values.count()
    bits = int(np.clip((16 * n).bit_length(), 12, MOST))

    def add(state, batch):
        x = batch.column("x").to_numpy(zero_copy_only=False).view(np.uint64)
        for at in _places(x, bits):
            np.bitwise_or.at(state, (at >> np.uint64(3)).astype(np.int64), np.uint8(1) << (at & np.uint64(7)).astype(np.uint8))
        return state

    held = tree_sum(values, lambda: np.zeros(1 << (bits - 3), np.uint8), add, np.bitwise_or)
    return values.sparkSession.sparkContext.broadcast((bits, held))


def may_hold(filter, x: np.ndarray) -> np.ndarray:
    bits, held = filter
    keep = np.ones(len(x), bool)
    for at in _places(x, bits):
        keep &= (held[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
    return keep


def sifted(rows: DataFrame, key: Column, values: DataFrame) -> DataFrame:
    """The rows whose key, a long, is in the column `x` of the values; a few others stay too, so a join has to follow."""
    held = bloom(values)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            yield batch.select(rest).filter(pa.array(may_hold(held.value, batch.column("x").to_numpy(zero_copy_only=False).view(np.uint64))))

    rest = rows.columns
    return rows.withColumn("x", key).mapInArrow(released(run), rows.schema)
