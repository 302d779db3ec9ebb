"""Centroid clustering over whole numbers with exponion search.

Each vector carries an upper bound of its distance to its own centroid and a lower bound of its distance
to all others.  After the centroids move, the bounds are moved with them; a
vector whose upper bound is below its lower bound stays where it is without looking
at any other.  Else only centroids inside a ball around its current one are scanned, of
radius 2 u + s, where u is its distance to that one and s that one's distance to its nearest neighbour:
the list of centroids sorted by their distance to the current one is read up to
that radius, inclusive, so that a tie is never lost.  Bounds are rounded outwards;
what decides is the exact squared distance in whole numbers, ties by the smaller number.

A round reads the vectors with the last round's bounds, kept on the executors' disks (a lost block is computed anew),
and adds up partial sums by cluster and dimension exactly; the driver sees k x dim sums a round.

Vectors of another length than `dim`, null ones and those with a null, a non-finite entry or one
whose floor(scale * entry) is over 2**27 in size (its squared distances would not fit in a long) are left out.  With
fewer than k vectors each is a centroid.  Repeated rows count each for itself; rows of one id are told apart by
their vectors when centroids are chosen; a null id is written as the empty text there.
An empty table gives no rows.  Other columns are not read.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, released
from .vectors import matrix, vectors

K, ROUNDS, DIM, SCALE, SEED = 40, 5, 64, 256, 2
MOST = 1 << 27
#: Rounds distances up and down by more than a double's error.
UP, DOWN = 1 + 1e-12, 1 - 1e-12
STEP = 4_096


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of x to rows of c, whole numbers of at most MOST in size."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    if 4 * most * most * x.shape[1] < 1 << 53:  # every sum that the matrix product meets is exact
        xf, cf = x.astype(np.float64), c.astype(np.float64)
        return ((xf * xf).sum(axis=1)[:, None] - 2 * (xf @ cf.T) + (cf * cf).sum(axis=1)[None, :]).astype(np.int64)
    out = np.empty((len(x), len(c)), dtype=np.int64)
    for j, row in enumerate(c):
        gap = x - row
        out[:, j] = (gap * gap).sum(axis=1)
    return out


def own_squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row of x to the same row of c."""
    gap = x - c
    return (gap * gap).sum(axis=1)


def nearest_two(d: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each row: the centroid at the least distance (ties: the smaller number), that distance, the next distance."""
    order = np.argsort(number, kind="stable")
    d, number = d[:, order], number[order]
    best = d.argmin(axis=1)
    rows = np.arange(len(d))
    least = d[rows, best]
    rest = d.copy()
    rest[rows, best] = np.iinfo(np.int64).max
    return number[best], least, rest.min(axis=1) if d.shape[1] > 1 else np.full(len(d), np.iinfo(np.int64).max)


class Neighbours:
    """Centroids, and for each the others sorted by their distance to it."""

    def __init__(self, c: np.ndarray):
        self.c = c
        far = np.sqrt(squared(c, c).astype(np.float64))
        self.order = np.argsort(far, axis=1, kind="stable")  # repeated centroids stand at distance 0, in the order of their numbers
        self.far = np.take_along_axis(far, self.order, axis=1) * DOWN
        own = far + np.where(np.eye(len(c), dtype=bool), np.inf, 0.0)
        self.gap = own.min(axis=1) * UP if len(c) > 1 else np.full(len(c), np.inf)


def search(x: np.ndarray, at: np.ndarray, near: Neighbours) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest centroid of each row, its exact squared distance, a lower bound of the others' distance, and how many distances were computed."""
    upper = np.sqrt(own_squared(x, near.c[at]).astype(np.float64)) * UP
    to, least, low, seen = at.copy(), np.zeros(len(x), np.int64), np.zeros(len(x)), len(x)
    # A centroid outside the ball is farther than u + s, and the neighbour that s is the distance to is inside and no farther than that: the
    # second nearest of the listed ones is the second nearest of all.
    for a in np.unique(at):
        mine = np.flatnonzero(at == a)
        radius = (2 * upper[mine] + near.gap[a]) * UP
        ball = np.maximum(np.searchsorted(near.far[a], radius, side="right"), 1)
        for size in 2 ** np.arange(int(np.ceil(np.log2(len(near.c)))) + 1):  # rows whose balls are of about one size are scanned together
            here = mine[(ball <= size) & (ball > size // 2)]
            listed = near.order[a][:size]
            for b in range(0, len(here), STEP):
                rows = here[b : b + STEP]
                to[rows], least[rows], second = nearest_two(squared(x[rows], near.c[listed]), listed)
                low[rows] = np.sqrt(second.astype(np.float64)) * DOWN
                seen += len(rows) * len(listed)
    return to, least, low, seen


def _whole(batch, dim: int, scale: int) -> np.ndarray:
    return np.floor(scale * matrix(batch.column("x"), dim)).astype(np.int64)


STATE = "x binary, cluster int, distance long, low double"


def _state(pa, ids, x, cluster, distance, low):
    cols = [ids, pa.array([row.tobytes() for row in x.astype(np.int32)], pa.binary()), pa.array(cluster.astype(np.int32)), pa.array(distance), pa.array(low)]
    return pa.RecordBatch.from_arrays(cols, ["id", "x", "cluster", "distance", "low"])


def _rows(batch, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), dtype=np.int32).reshape(-1, dim).astype(np.int64)


def first_centroids(rows: DataFrame, k: int, seed: int, dim: int, scale: int) -> np.ndarray:
    """The vectors of the k smallest sha256 of `seed:id`, in that order (ties: by their entries)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    top = rows.select(digest.alias("h"), F.transform("x", lambda v: F.floor(F.lit(float(scale)) * v)).alias("x")).orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in top], dtype=np.int64).reshape(-1, dim)


def _partial_sums(k: int, dim: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        count, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)

        def out():
            has = np.flatnonzero(count)
            at = np.repeat(has, dim)
            return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(np.tile(np.arange(dim, dtype=np.int32), len(has))), pa.array(sums[has].ravel()), pa.array(count[at])], ["cluster", "d", "total", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            x, cluster = _rows(batch, dim), batch.column("cluster").to_numpy(zero_copy_only=False)
            if count.sum() + len(x) >= 1 << 35:  # the sums would not fit
                yield out()
                count[:], sums[:] = 0, 0
            order = np.argsort(cluster, kind="stable")
            first = np.flatnonzero(np.diff(cluster[order], prepend=-1))
            sums[cluster[order][first]] += np.add.reduceat(x[order], first, axis=0)
            count += np.bincount(cluster, minlength=k)
        yield out()

    return run


def moved(state: DataFrame, c: np.ndarray) -> np.ndarray:
    """Each centroid's exact floor of the mean of its vectors; empty ones stay."""
    k, dim = c.shape
    whole = lambda name: F.sum(F.col(name).cast("decimal(38,0)")).alias(name)
    sums = state.mapInArrow(released(_partial_sums(k, dim)), "cluster int, d int, total long, n long").groupBy("cluster", "d").agg(whole("total"), whole("n"))
    out = c.copy()
    for r in sums.collect():  # k x dim rows
        out[r["cluster"], r["d"]] = int(r["total"]) // int(r["n"])
    return out


def clusters(df: DataFrame, k: int = K, rounds: int = ROUNDS, id_column: str = "vec_id", column: str = "embedding", dim: int = DIM, scale: int = SCALE, seed: int = SEED):
    """((id, cluster, distance) of every vector, the final centroids)."""
    spark = df.sparkSession
    kind = dict(df.dtypes)[id_column]
    rows = vectors(df, id_column, column, MOST / scale, dim)
    c = first_centroids(rows, k, seed, dim, scale)
    if not len(c):
        return spark.createDataFrame([], f"id {kind}, cluster int, distance long"), c
    shared = spark.sparkContext.broadcast(c)  # arrays alone: broadcasts carry a class by its name, which workers may not know

    def begin(batches: Iterator, shared=shared) -> Iterator:
        import pyarrow as pa

        near = Neighbours(shared.value)
        for batch in batches:
            if batch.num_rows:
                x = _whole(batch, dim, scale)
                parts = [nearest_two(squared(x[a : a + STEP], near.c), np.arange(len(near.c))) for a in range(0, len(x), STEP)]
                to, least, second = (np.concatenate(p) for p in zip(*parts, strict=True))
                yield _state(pa, batch.column("id"), x, to, least, np.sqrt(second.astype(np.float64)) * DOWN)

    def again(shared, shift):
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            near, (own, most) = Neighbours(shared.value), shift
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _rows(batch, dim)
                at = batch.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64)
                upper = (np.sqrt(batch.column("distance").to_numpy(zero_copy_only=False).astype(np.float64)) + own[at]) * UP
                low = np.maximum((batch.column("low").to_numpy(zero_copy_only=False) - most[at]) * DOWN, 0.0)
                stays = upper < np.maximum(low, near.gap[at] / UP * DOWN / 2)
                distance, to = np.empty(len(x), np.int64), at.copy()
                distance[stays] = own_squared(x[stays], near.c[at[stays]])
                go = np.flatnonzero(~stays)
                to[go], distance[go], low[go], _ = search(x[go], at[go], near)
                yield _state(pa, batch.column("id"), x, to, distance, low)

        return run

    state = rows.mapInArrow(released(begin), f"id {kind}, {STATE}").persist(StorageLevel.DISK_ONLY)
    for _ in range(rounds):
        new = moved(state, c)
        far = np.sqrt(own_squared(new, c).astype(np.float64)) * UP
        most = np.array([max(np.delete(far, a), default=0.0) for a in range(len(c))])
        c, shared = new, spark.sparkContext.broadcast(new)
        last, state = state, state.mapInArrow(released(again(shared, (far, most))), f"id {kind}, {STATE}").persist(StorageLevel.DISK_ONLY)
        state.count()
        last.unpersist()
    out = cut(state.select("id", "cluster", "distance"))
    state.unpersist()
    return out, c


def op12_clusters(spark, sf_dir: str) -> DataFrame:
    """Cluster and exact squared distance of every embedding, with each cluster's and the whole inertia (null where one doesn't fit in a long)."""
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    found, c = clusters(df)
    total = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("own")).collect()  # a row for each of the k clusters
    every = sum(int(r["own"]) for r in total)
    fits = lambda v: v if v < 1 << 63 else None
    notes = [(r["cluster"], fits(int(r["own"])), fits(every), hashlib.sha256(",".join(map(str, c[r["cluster"]].tolist())).encode()).hexdigest()) for r in total]
    named = spark.createDataFrame(notes, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(named), "cluster").select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED) -> str:
    assign = """n{r} AS MATERIALIZED (SELECT vec_id, v, cluster, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) AS best FROM (
  SELECT kept.vec_id, kept.v, c.cluster, list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM kept, c{r} c)) WHERE best = 1)"""
    move = """s{r} AS MATERIALIZED (SELECT cluster, i, sum(x) AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM n{r}) GROUP BY ALL),
c{q} AS MATERIALIZED (SELECT cluster, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM s{r} GROUP BY cluster
  UNION ALL SELECT cluster, v FROM c{r} WHERE cluster NOT IN (SELECT cluster FROM s{r}))"""
    steps = [f"""kept AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS cluster, v FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {k}))"""]
    for r in range(rounds):
        steps += [assign.format(r=r), move.format(r=r, q=r + 1)]
    steps.append(assign.format(r=rounds))
    return f"""WITH {", ".join(steps)}
SELECT vec_id, cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM n{rounds} JOIN c{rounds} c USING (cluster)"""


ORACLE_SQL = _oracle()
