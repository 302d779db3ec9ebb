"""Nearest vectors by blocks against all pairs one by one: copies, ties, vectors without direction, rows that aren't vectors."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn.operators import resolve

SCHEMA = "cid long, embedding array<float>"


def brute(queries, rows):
    """The likest other row of each query: NaN is the highest score, of equal ones the smallest id's."""
    want = {}
    for qid, q in queries:
        if qid is None or not any(c is not None and c != qid for c, _ in rows):
            continue
        best = want.get(qid)
        for cid, v in rows:
            if cid is None or cid == qid or q is None or v is None or len(q) != len(v) or None in q or None in v:
                continue
            with np.errstate(all="ignore"):
                x, y = np.float32(q).astype(float), np.float32(v).astype(float)
                s = float(x @ y / np.sqrt((x @ x) * (y @ y)))
            place = (math.inf if math.isnan(s) else math.floor(abs(s) * 1e6 + 0.5) * (1 if s > 0 else -1), -cid)
            best = max(best, (place, cid, s)) if best else (place, cid, s)
        want[qid] = best
    return {k: (None, None) if b is None else (b[1], "nan" if math.isnan(b[2]) else b[0][0]) for k, b in want.items()}


def got(spark, queries, rows, **most):
    asked = spark.createDataFrame(queries, "qid long, qvec array<float>").repartition(3)
    out = resolve.semantic_nearest(asked, spark.createDataFrame(rows, SCHEMA).repartition(4), **most).collect()
    assert len({r.qid for r in out}) == len(out)
    return {r.qid: (r.cid, None if r.score is None else "nan" if math.isnan(r.score) else round(r.score * 1e6)) for r in out}


def vectors(n, dims, seed=1):
    r = np.random.default_rng(seed)
    return [(i, r.normal(size=dims).astype(np.float32).tolist()) for i in range(n)]


@pytest.mark.parametrize("block", [40, 8_192])
def test_every_row_finds_its_likest(spark, monkeypatch, block):
    monkeypatch.setattr(resolve, "CANDIDATES", block)
    rows = vectors(300, 5)
    rows += [(1_000 + i, rows[7][1]) for i in range(60)]  # copies, all of them alike
    rows += [(2_000 + i, [x * (1 + i) for x in rows[8][1]]) for i in range(5)] + [(-3, rows[9][1])]
    assert got(spark, rows, rows, most=block) == brute(rows, rows)


def test_many_copies_are_scored_tile_by_tile(spark):
    rows = [(i, v) for i, (_, v) in enumerate(vectors(4, 8) * 300)]
    assert got(spark, rows, rows) == brute(rows[:4], rows) | {i: (i % 4, 1_000_000) for i in range(4, 1_200)}


def test_vectors_without_direction_and_rows_that_are_none(spark):
    plain = vectors(20, 4)
    odd = [(30, None), (31, [1.0, None, 0.0, 0.0]), (32, [1.0, 2.0]), (33, []), (None, [1.0, 0.0, 0.0, 0.0])]
    assert got(spark, plain + odd, plain + odd) == brute(plain + odd, plain + odd)
    for lost in ([0.0] * 4, [float("nan"), 0.0, 1.0, 1.0], [float("inf"), 0.0, 1.0, 1.0]):
        rows = plain + [(-5, lost), (50, lost)] + odd
        assert got(spark, rows, rows) == brute(rows, rows)
        assert got(spark, [(50, lost)], plain) == {50: (0, "nan")}
    assert got(spark, plain[:1], plain[:1]) == {} == got(spark, plain, []) and got(spark, [], plain) == {}
    assert got(spark, plain, plain[:1]) == brute(plain, plain[:1])


def test_all_vectors_of_a_larger_table(spark):
    """The index that was asked before found 0.76 of them."""
    from cairn.plans import catalog_queries as Q

    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r.embedding for r in rows], dtype=float)
    s = x @ x.T / np.sqrt(np.outer((x * x).sum(1), (x * x).sum(1)))
    np.fill_diagonal(s, -2)
    ids = np.array([r.vec_id for r in rows])
    want = dict(zip(ids.tolist(), zip(ids[np.rint(s * 1e6).argmax(axis=1)].tolist(), np.round(s.max(axis=1), 6).tolist(), strict=True), strict=True))
    assert {r.qid: (r.cid, r.score) for r in Q.semantic_nn_all(spark, sf).select("qid", "cid", F.round("score", 6).alias("score")).collect()} == want
