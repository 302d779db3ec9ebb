"""Helpers that the training-data operators share."""
from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MASK64 = (1 << 64) - 1
#: Odd multiplier of the polynomial hashes, a second one for 128-bit equality.
BASE_A, BASE_B = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir; a temporary one only where none is set and Spark is local (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    held = spark.sparkContext.getCheckpointDir()
    if named is None and held is None:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cairn-checkpoint-"))
        held = spark.sparkContext.getCheckpointDir()
    elif held is None:
        spark.sparkContext.setCheckpointDir(named)
        held = spark.sparkContext.getCheckpointDir()
    return held


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage: the rows are written to the shared checkpoint folder and read from there."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Rows to a partition of what `packed` reads.
ROWS = 25_000


def packed(done: DataFrame, rows: int) -> DataFrame:
    """What `cut` gave, of so many rows, read in no more partitions than they fill, however many it was made in."""
    return done.coalesce(max(1, -(-rows // ROWS)))


def cut_packed(df: DataFrame) -> tuple[DataFrame, int]:
    """`cut` and `packed`, and the number of rows."""
    done = cut(df)
    rows = done.count()
    return packed(done, rows), rows


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def spread_join(rows: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on keys of which the first is a long, for a small side that is an aggregate by them: both sides are dealt anew,
    so that Spark can split a key that many rows have, which it can't where the aggregate's own partitioning is used again."""
    turned = lambda df: df.withColumn(keys[0], F.col(keys[0]).bitwiseXOR(F.lit(1).cast("long")))
    return turned(turned(rows).join(turned(small), keys, how))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text"):
    """The text column; null counts as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalising permutation of uint64 values."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i < n or more."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        inverse = pow(base, -1, 1 << 64)
        out = []
        for b in (base, inverse):
            p = np.full(size, np.uint64(b), dtype=np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        have = _powers[base] = (out[0], out[1])
    return have


def prefix_sums(data: np.ndarray, base: int) -> np.ndarray:
    """Prefix sums of the polynomial hash of uint8 data; one longer than data."""
    up, _ = powers(base, len(data) + 1)
    s = np.empty(len(data) + 1, dtype=np.uint64)
    s[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=s[1:])
    return s


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Hash of data[start:end], the same wherever the bytes stand."""
    _, down = powers(base, len(sums))
    return mix64((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def text_bytes(array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of an Arrow string array without nulls."""
    import pyarrow as pa

    if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type):
        kind = np.int64
    else:
        kind = np.int32
    if len(array) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    buffers = array.buffers()
    offsets = np.frombuffer(buffers[1], dtype=kind)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int):
    """Row ranges (a, b) of at most about `most` bytes; a longer row stands alone."""
    a, n = 0, len(offsets) - 1
    while a < n:
        b = int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b
        a = b


def worker_state() -> dict:
    """What a Python worker keeps from task to task (tokenizers, caches); empty at first."""
    import sys
    import types

    return sys.modules.setdefault("_cairn_worker_state", types.ModuleType("_cairn_worker_state")).__dict__


def free_memory() -> None:
    """Gives memory that a Python worker no longer uses back to the machine; workers live on from stage to stage."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not glibc
        pass


def released(run, keep: bool = False):
    """A function over Arrow batches that frees the worker's memory when its partition ends; what other operators left in the worker goes first, unless `keep`."""

    def call(batches):
        if not keep:
            worker_state().clear()
        try:
            yield from run(batches)
        finally:
            free_memory()

    return call


BATCH_BYTES = 1 << 20


def bound_batches(spark: SparkSession) -> None:
    """Texts travel to Python in batches of about 1 MB, however many rows that is."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
