"""Nearest vectors by blocks: a block of queries meets a block of candidates as one matrix product.

Single-precision products tell which candidates can be the likest, to within a bound on their error; those alone are scored in
double precision.  Where too many are that close (copies), a tile is scored in double precision as a whole.
"""
from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Queries and candidates of a tile; scores count to six decimals.
ROWS, COLUMNS, UNIT = 512, 2_048, 1_000_000
PACKED = "block int, width int, ids binary, vectors binary"
BEST = "qid long, cid long, score double"


def packed(key: tuple, rows: pa.Table) -> pa.Table:
    """One row of all (id, v) of a block, the ids in ascending order."""
    width, block = (k.as_py() for k in key)
    ids = np.asarray(rows.column("id"), np.int64)
    v = rows.column("v").combine_chunks()
    flat = np.asarray((v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v).flatten(), np.float64).reshape(len(ids), width)
    order = np.argsort(ids, kind="stable")
    return pa.table({"block": pa.array([block], pa.int32()), "width": pa.array([width], pa.int32()), "ids": [ids[order].tobytes()], "vectors": [flat[order].tobytes()]})


class Block:
    """Vectors as rows, their lengths and directions; a vector without direction (all zero, or not finite) is `lost`."""

    def __init__(self, width: int, ids: bytes, vectors: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.rows = np.frombuffer(vectors, np.float64).reshape(len(self.ids), width)
        with np.errstate(all="ignore"):
            self.squares = np.einsum("ij,ij->i", self.rows, self.rows)
            self.lost = ~np.isfinite(self.squares) | (self.squares == 0)
            unit = self.rows / np.sqrt(self.squares)[:, None]
        unit[self.lost] = 0
        self.unit = unit.astype(np.float32)


class Best:
    """The likest candidate so far of each query of a block: its score, and as a whole number of `UNIT`ths; equal ones go to the smallest id."""

    def __init__(self, block: Block):
        n = len(block.ids)
        self.block, self.key, self.score, self.cid = block, np.full(n, -np.inf), np.full(n, -np.inf), np.zeros(n, np.int64)

    def take(self, at: np.ndarray, score: np.ndarray, cid: np.ndarray) -> None:
        """Each query (`at`, without repeats) is offered one candidate; a score that isn't a number counts as the highest, as in SQL."""
        key = np.where(np.isnan(score), np.inf, rounded(score))
        won = (key > self.key[at]) | ((key == self.key[at]) & (cid < self.cid[at]) & (key > -np.inf))
        at = at[won]
        self.key[at], self.score[at], self.cid[at] = key[won], score[won], cid[won]

    def told(self) -> pa.RecordBatch:
        met = self.key > -np.inf
        return pa.RecordBatch.from_arrays([pa.array(self.block.ids[met]), pa.array(self.cid[met]), pa.array(self.score[met])], names=["qid", "cid", "score"])


def rounded(score: np.ndarray) -> np.ndarray:
    scaled = score * UNIT
    return np.trunc(scaled + np.copysign(0.5, scaled))


def first_other(ids: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of `asked` have another id among the ascending `ids`, and the smallest such id."""
    two = np.unique(ids)[:2]
    at = np.flatnonzero((asked != two[0]) | (len(two) > 1)) if len(two) else np.zeros(0, int)
    return at, np.where(asked[at] != two[0], two[0], two[-1]) if len(two) else np.zeros(0, np.int64)


def compare(best: Best, c: Block) -> None:
    """Offers all candidates of a block to the queries of another; those of a query's own id aren't candidates."""
    q = best.block
    for queries, others in ((np.arange(len(q.ids)), c.ids[c.lost]), (np.flatnonzero(q.lost), c.ids)):
        at, cid = first_other(others, q.ids[queries])
        best.take(queries[at], np.full(len(at), np.nan), cid)
    low, high = np.searchsorted(c.ids, q.ids, "left"), np.searchsorted(c.ids, q.ids, "right")
    margin = np.float32((2 * q.rows.shape[1] + 16) * 2.0**-24 + 1 / UNIT)  # twice the error of a product, and one unit
    tile = np.empty((ROWS, COLUMNS), np.float32)
    for a in range(0, len(q.ids), ROWS):
        asked = np.arange(a, min(a + ROWS, len(q.ids)))
        floor = np.maximum(np.where(np.isfinite(best.score[asked]), best.score[asked], -3), -3).astype(np.float32) - margin
        floor[np.isinf(best.key[asked]) & (best.key[asked] > 0)] = 3  # nothing beats what isn't a number
        for b in range(0, len(c.ids), COLUMNS):
            end = min(b + COLUMNS, len(c.ids))
            s = np.matmul(q.unit[asked], c.unit[b:end].T, out=tile[: len(asked), : end - b])
            s[:, c.lost[b:end]] = -9
            own = np.flatnonzero((low[asked] < high[asked]) & (low[asked] < end) & (high[asked] > b))
            for i in own:
                s[i, max(low[asked[i]] - b, 0) : high[asked[i]] - b] = -9
            top = s.max(axis=1)
            np.maximum(floor, top - margin, out=floor)
            rows = np.flatnonzero(top >= floor)
            i, j = np.nonzero(s[rows] >= floor[rows, None])
            if len(i) > 16 * len(asked):
                _whole(best, c, asked[rows], b, end, s[rows] > -9)
            elif len(i):
                _some(best, c, asked[rows[i]], b + j)


def _some(best: Best, c: Block, at: np.ndarray, j: np.ndarray) -> None:
    """Scores pairs, ordered by query and candidate, in double precision; the first of a query's likest is offered to it."""
    q = best.block
    score = np.einsum("ij,ij->i", q.rows[at], c.rows[j]) / np.sqrt(q.squares[at] * c.squares[j])
    starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
    key = rounded(score)
    top = np.flatnonzero(key == np.repeat(np.maximum.reduceat(key, starts), np.diff(np.r_[starts, len(at)])))
    _, first = np.unique(at[top], return_index=True)
    won = top[first]
    best.take(at[won], score[won], c.ids[j[won]])


def _whole(best: Best, c: Block, at: np.ndarray, b: int, end: int, real: np.ndarray) -> None:
    """Scores a tile in double precision; the first of the likest real candidates of each query is offered to it."""
    q = best.block
    with np.errstate(all="ignore"):
        score = q.rows[at] @ c.rows[b:end].T / np.sqrt(q.squares[at][:, None] * c.squares[b:end])
        key = np.where(real, rounded(score), -np.inf)
    j = key.argmax(axis=1)
    met = np.flatnonzero(key[np.arange(len(at)), j] > -np.inf)
    best.take(at[met], score[met, j[met]], c.ids[b + j[met]])


def likest(batches):
    """(qid, cid, score) of pairs of blocks (q_…, c_…): the likest candidate of each query among the blocks that follow each other for its block."""
    at, best = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            row = {n: batch.column(n)[i] for n in batch.schema.names}
            if row["q_width"] != row["c_width"]:
                continue
            now = row["q_width"].as_py(), row["q_block"].as_py()
            if now != at:
                if best is not None:
                    yield best.told()
                at, best = now, Best(Block(now[0], row["q_ids"].as_buffer(), row["q_vectors"].as_buffer()))
            compare(best, Block(now[0], row["c_ids"].as_buffer(), row["c_vectors"].as_buffer()))
    if best is not None:
        yield best.told()
