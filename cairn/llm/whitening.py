"""Whitened embeddings by a covariance in two passes.

The first pass adds up whole numbers x = floor(SCALE * entry) + SHIFT exactly, which gives the
mean as a fraction.  The second adds the outer products of the centred vectors, by
one matrix product a batch; partitions' products are merged by treeAggregate, so that
the driver gets one matrix of dim x dim.  A symmetric eigensolver (LAPACK) gives the components;
their projection, of dim x components, is broadcast, and a third pass measures
the covariance of what it yields.  No row is shuffled.

Rows whose vector is null, or holds a null, a non-finite entry or one over 2**43 in size (whose x no
double holds exactly), are left out.  So are vectors whose length isn't `dim`, by default the
commonest length among the others (ties: the longest); empty vectors always.  Repeated
rows, and rows with one id or a null one, count and are returned each for itself.
A component whose eigenvalue is zero to working precision can't be scaled: its whitened value is null and the
identity error leaves it out; with one vector, or all equal, that is every component, and the error is null.
An empty table gives no rows.  Other columns are not read.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released
from .vectors import decimals, matrix, tree_sum, usable, vectors, whole_sums

COMPONENTS, SCALE, SHIFT, MOST = 8, 1024, 100_000, float(1 << 43)


def whole(x: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * x).astype(np.int64) + SHIFT


def apart(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: int64 where that holds it, else Python integers."""
    most = max(int(np.abs(x).max()) * n, max(map(abs, sums)))
    if 2 * most < 1 << 63:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def squares(gap: np.ndarray) -> list[int]:
    """Exact sums of squares of rows."""
    if gap.dtype != object and gap.shape[1] * int(np.abs(gap).max()) ** 2 < 1 << 63:
        return (gap * gap).sum(axis=1).tolist()
    return [sum(v * v for v in row) for row in gap.tolist()]


def commonest_length(df: DataFrame, column: str) -> int | None:
    sizes = df.select(F.col(column).cast("array<double>").alias("x")).where(usable("x", MOST)).select(F.size("x").alias("n")).where("n > 0")
    top = sizes.groupBy("n").count().orderBy(F.desc("count"), F.desc("n")).first()
    return top and top["n"]


def _add_sums(dim: int):
    def add(state, batch):
        x = whole(matrix(batch.column("x"), dim))
        n, sums = state
        return n + len(x), [a + b for a, b in zip(sums, whole_sums(x), strict=True)]

    return add


def _merge_sums(a, b):
    return a[0] + b[0], [x + y for x, y in zip(a[1], b[1], strict=True)]


def exact_sums(rows: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Number of vectors, and the sum of x by dimension."""
    return tree_sum(rows, lambda: (0, [0] * dim), _add_sums(dim), _merge_sums) or (0, [0] * dim)


def _merge_arrays(a, b):
    return tuple(x + y for x, y in zip(a, b, strict=True))


def covariance(rows: DataFrame, dim: int, n: int, sums: list[int]) -> np.ndarray:
    """Covariance of x, divisor n, centred by the exact mean before multiplying."""

    def add(state, batch):
        centred = apart(whole(matrix(batch.column("x"), dim)), n, sums).astype(np.float64) / n
        return (state[0] + centred.T @ centred,)

    return tree_sum(rows, lambda: (np.zeros((dim, dim)),), add, _merge_arrays)[0] / n


def components(cov: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Projection to the first k components scaled to variance 1 (NaN where there is none), and the share that each explains.

    A component's sign makes its largest entry positive.
    """
    value, vector = np.linalg.eigh(cov)
    value, vector = value[::-1][:k], vector[:, ::-1][:, :k]
    lead = np.abs(vector).argmax(axis=0)
    vector = vector * np.where(vector[lead, np.arange(vector.shape[1])] < 0, -1.0, 1.0)
    total = np.trace(cov)
    has = value > max(value[0], 0.0) * len(cov) * np.finfo(np.float64).eps
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(has, vector / np.sqrt(value), np.nan), has, value / total if total > 0 else np.full(len(value), np.nan)


def whiten(df: DataFrame, k: int = COMPONENTS, id_column: str = "vec_id", column: str = "embedding", dim: int | None = None) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of each vector and component up to k.

    deviation is a decimal of 38 digits, null beyond.
    """
    spark = df.sparkSession
    kind = dict(df.dtypes)[id_column]
    schema = f"id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    dim = dim or commonest_length(df, column)
    rows = vectors(df, id_column, column, MOST, dim or 1)
    n, sums = exact_sums(rows, dim) if dim else (0, [])
    if not n:
        return spark.createDataFrame([], schema)
    scaled, has, explained = components(covariance(rows, dim, n, sums), min(k, dim))
    model = spark.sparkContext.broadcast((n, sums, scaled))

    def project(batch):
        n, sums, scaled = model.value
        gap = apart(whole(matrix(batch.column("x"), dim)), n, sums)
        return gap, (gap.astype(np.float64) / n) @ np.where(np.isnan(scaled), 0.0, scaled)

    def add(state, batch):
        _, w = project(batch)
        return state[0] + w.sum(axis=0), state[1] + w.T @ w

    width = scaled.shape[1]
    total, product = tree_sum(rows, lambda: (np.zeros(width), np.zeros((width, width))), add, _merge_arrays)
    seen = product / n - np.outer(total / n, total / n)
    error = float(np.abs(seen - np.eye(width))[np.ix_(has, has)].max()) if has.any() else None

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            if not batch.num_rows:
                continue
            gap, w = project(batch)
            m = len(w)
            at = pa.array(np.repeat(np.arange(m), width))
            tiled = lambda v: np.tile(v, m)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id").take(at), pa.array(tiled(np.arange(1, width + 1, dtype=np.int32))), pa.array(np.full(m * width, n, dtype=np.int64)), decimals(squares(gap)).take(at),
                    pa.array(w.ravel(), mask=tiled(~has)), pa.array(tiled(explained), mask=tiled(np.isnan(explained))), pa.array(np.full(m * width, error or 0.0), mask=np.full(m * width, error is None)),
                ],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.mapInArrow(released(run), schema)


def op13_whitening(spark, sf_dir: str) -> DataFrame:
    """Eight whitened components of every embedding.  deviation is null where it doesn't fit in a long; deviation_digits has it whole."""
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    exact = F.expr("try_cast(deviation AS bigint)").alias("deviation")
    return whiten(df).select(F.col("id").alias("vec_id"), "component", "n", exact, "whitened", "explained", "identity_error", F.col("deviation").cast("string").alias("deviation_digits"))
