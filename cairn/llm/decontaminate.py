"""Benchmark decontamination: close word pairs that no match can lack, then Smith-Waterman alignment.

Texts and items are lower-cased word sequences.  A document holds an item if their
best Smith-Waterman alignment (match 2, mismatch and gap -1) reaches the share
`cut` of the item's perfect score.  Passages to align are found without loss:

An alignment of M matched words and E errors with an item of m words needs
2M - E >= 2 cut m.  Between two matched words that follow each other at most one
error stands if both are one or two words further on, in item and text.  At most
E/2 <= M - cut m of the M - 1 steps hold more, so at least cut m - 1 words of the
item start a pair, with the next word or the one after it, that the text has as
well at a distance of one or two.  Of the item's words those whose pairs are
commonest in the benchmark are left out, about half as many as that number, and
the other half must be met in as many words as such an alignment can span.  How
many documents hold a pair has no influence.  Items with cut m <= 1 need one word.

The benchmark is read in blocks of about `BLOCK` pairs, so what is sent to the
executors has that bound; a larger benchmark means more passes, not larger
broadcasts.  Null and empty texts and items match nothing.  Repeated rows are
judged alike.  Rows with a null id are kept.
"""
from __future__ import annotations

import math
import pickle
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import bound_batches, released, text_or_empty, worker_state

CUT, BLOCK = 0.6, 200_000
CHUNK = 200_000
_WORD = re.compile(r"\w+")
_STEP, _BITS = np.uint64(0x9E3779B97F4A7C15), 22


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def smith_waterman(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Best local alignment score and where in the passage it ends (exclusive)."""
    j = np.arange(len(passage) + 1)
    above = np.zeros(len(passage) + 1, dtype=np.int64)
    best, end = 0, 0
    for x in item:
        row = np.zeros_like(above)
        np.maximum(above[:-1] + np.where(passage == x, 2, -1), above[1:] - 1, out=row[1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + j) - j  # gaps within the passage
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
        above = row
    return best, end


class Block:
    """Some items, their word numbers and the pairs by which texts that hold them are found."""

    def __init__(self, items: list[tuple[int, str]], cut: float = CUT):
        self.cut, self.names, self.items, self.vocabulary = cut, [], [], {}
        for name, text in items:
            w = words(text)
            if w:
                self.names.append(name)
                self.items.append(np.array([self.vocabulary.setdefault(x, len(self.vocabulary) + 1) for x in w], dtype=np.int64))
        self.width = len(self.vocabulary) + 1
        size = np.array([len(x) for x in self.items], dtype=np.int64)
        self.reach = np.ceil(size * (3 - 2 * cut) + 1e-9).astype(np.int64)  # words that an alignment can span
        least = [math.ceil(cut * m - 1 - 1e-9) for m in size.tolist()]  # words of the item that start a common pair
        self.alone = any(x < 1 for x in least)
        self.need = np.array([max(1, (x + 1) // 2) for x in least], dtype=np.int64)
        own = [self._pairs(ids) if x >= 1 else (ids * self.width, np.arange(len(ids))) for ids, x in zip(self.items, least, strict=True)]
        if own:
            _, back, count = np.unique(np.concatenate([p for p, _ in own]), return_inverse=True, return_counts=True)
            common = np.split(count[back], np.cumsum([len(p) for p, _ in own])[:-1])
        pair, item, start = [], [], []
        for k, (p, at) in enumerate(own):
            weight = np.bincount(at, common[k])
            drop = np.argsort(-weight, kind="stable")[: max(0, least[k] - int(self.need[k]))]
            keep = ~np.isin(at, drop)
            pair.append(p[keep])
            start.append(at[keep])
            item.append(np.full(int(keep.sum()), k))
        cat = lambda x: np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64)
        pair, self.item, self.start = cat(pair), cat(item), cat(start)
        order = np.argsort(pair, kind="stable")
        pair, self.item, self.start = pair[order], self.item[order], self.start[order]
        self.pairs, self.first = np.unique(pair, return_index=True)
        self.count = np.diff(np.append(self.first, len(pair)))
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[self._slot(self.pairs)] = True

    @staticmethod
    def _slot(pair: np.ndarray) -> np.ndarray:
        return (pair.astype(np.uint64) * _STEP) >> np.uint64(64 - _BITS)

    def _pairs(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair, place of its first word) of known words at a distance of one or two."""
        pairs, places = [], []
        for d in (1, 2):
            at = np.flatnonzero((ids[:-d] > 0) & (ids[d:] > 0)) if len(ids) > d else np.zeros(0, np.int64)
            pairs.append(ids[at] * self.width + ids[at + d])
            places.append(at)
        return np.concatenate(pairs), np.concatenate(places)

    def numbers(self, text: str) -> np.ndarray:
        w = words(text)
        return np.fromiter(map(self.vocabulary.get, w, repeat(0)), np.int64, len(w))

    def found(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(pair's number, place) of every pair of the items in the sequence."""
        pair, place = self._pairs(ids)
        if self.alone:
            known = np.flatnonzero(ids)
            pair, place = np.concatenate((pair, ids[known] * self.width)), np.concatenate((place, known))
        hit = self.maybe[self._slot(pair)]
        pair, place = pair[hit], place[hit]
        k = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        hit = self.pairs[k] == pair
        return k[hit], place[hit]

    def matches(self, texts: list[str], memo: dict) -> list[list[tuple]]:
        """For each text (item, score, first word, last word + 1, item's words that start a common pair) of every item it holds."""
        out, held, size = [], [], 0
        for text in texts:
            held.append(self.numbers(text))
            size += len(held[-1])
            if size >= CHUNK:
                out += self._held(held, memo)
                held, size = [], 0
        return out + self._held(held, memo)

    def _held(self, texts: list[np.ndarray], memo: dict) -> list[list[tuple]]:
        out: list[list[tuple]] = [[] for _ in texts]
        if not texts or not len(self.pairs):
            return out
        between = np.zeros(2, np.int64)  # unknown words, which no pair spans
        ids = np.concatenate([x for t in texts for x in (t, between)])
        begin = np.cumsum([0, *(len(t) + 2 for t in texts)])
        k, place = self.found(ids)
        c = self.count[k]
        row = np.repeat(self.first[k], c) + np.arange(c.sum()) - np.repeat(np.cumsum(c) - c, c)
        place = np.repeat(place, c)
        group = (np.searchsorted(begin, place, side="right") - 1) * len(self.items) + self.item[row]
        longest = int(max(map(len, self.items)))
        met = np.unique(group * longest + self.start[row]) // longest
        some, n = np.unique(met, return_counts=True)
        keep = n >= self.need[some % len(self.items)]
        some, n = some[keep], n[keep]
        if not len(some):
            return out
        at = np.minimum(np.searchsorted(some, group), len(some) - 1)
        mine = some[at] == group
        at, place = at[mine], place[mine]
        order = np.lexsort((place, at))
        cuts = np.searchsorted(at[order], np.arange(len(some) + 1))
        place = place[order]
        for g, a, b, seeds in zip(some.tolist(), cuts[:-1], cuts[1:], n.tolist(), strict=True):
            doc, item = divmod(g, len(self.items))
            best = self._best(item, texts[doc], place[a:b] - begin[doc], memo)
            if best[0] >= self.cut:
                out[doc].append((self.names[item], *best, seeds))
        return out

    def _best(self, item: int, ids: np.ndarray, place: np.ndarray, memo: dict) -> tuple[float, int, int]:
        """Best alignment of the item within its reach of any place from which as many pairs as it needs are near."""
        reach, need = int(self.reach[item]), int(self.need[item])
        first = place[: len(place) - need + 1]
        first = first[place[need - 1 :] - first <= reach]
        best = (0.0, 0, 0)
        for near in np.split(first, np.flatnonzero(np.diff(first) > 2 * reach) + 1) if len(first) else []:
            lo, hi = max(0, int(near[0]) - reach), min(len(ids), int(near[-1]) + reach + 1)
            passage = ids[lo:hi]
            key = (item, passage.tobytes())
            got = memo.get(key)
            if got is None:
                got = self._align(self.items[item], passage)
                if len(memo) < 20_000:
                    memo[key] = got
            if got[0] > best[0]:
                best = (got[0], lo + got[1], lo + got[2])
        return best

    @staticmethod
    def _align(own: np.ndarray, passage: np.ndarray) -> tuple[float, int, int]:
        score, end = smith_waterman(own, passage)
        back, length = smith_waterman(own[::-1], passage[:end][::-1])
        return max(score, back) / (2 * len(own)), end - length, end


def _blocks(benchmark: DataFrame, cut: float, most: int) -> Iterator[Block]:
    """The benchmark in id order, in blocks of about `most` pairs at most."""
    rows, size = [], 0
    items = benchmark.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null").orderBy("item_id", "text")
    for r in items.toLocalIterator():
        rows.append((r["item_id"], r["text"]))
        size += 2 * len(words(r["text"]))
        if size >= most:
            yield Block(rows, cut)
            rows, size = [], 0
    if rows:
        yield Block(rows, cut)


def seeded_blocks(docs: DataFrame, benchmark: DataFrame, cut: float = CUT, most: int = BLOCK) -> Iterator:
    """Broadcast blocks of the benchmark."""
    spark = docs.sparkSession
    bound_batches(spark)
    for block in _blocks(benchmark, cut, most):
        if len(block.items):
            yield spark.sparkContext.broadcast(cloudpickle.dumps(block))  # by value: workers need no copy of this package


def _matches(shared, item):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        block, memo = pickle.loads(shared.value), {}
        names = ["doc_id", "item_id", "score", "first_word", "end_word", "seeds"]
        for batch in batches:
            found = block.matches(batch.column("text").to_pylist(), memo)
            rows = [(k, *m) for k, held in zip(batch.column("id").to_pylist(), found, strict=True) for m in held]
            cols = list(zip(*rows, strict=True)) if rows else [[] for _ in names]
            kinds = [batch.schema.field("id").type, item, pa.float64(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame, cut: float = CUT, most: int = BLOCK, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, item_id, score, first_word, end_word, seeds) of every item that a document holds."""
    slim = docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text"))
    kind = dict(slim.dtypes)["id"]
    schema = f"doc_id {kind}, item_id {dict(benchmark.dtypes)['item_id']}, score double, first_word long, end_word long, seeds long"
    out = docs.sparkSession.createDataFrame([], schema)
    for shared in seeded_blocks(docs, benchmark, cut, most):
        out = out.unionByName(slim.mapInArrow(released(_matches(shared, to_arrow_type(benchmark.schema["item_id"].dataType))), schema))
    return out


def holds_item(shared, text: Column) -> Column:
    own: list = []  # a task's block and what it has aligned

    @F.arrow_udf("boolean")
    def held(texts):
        import pyarrow as pa

        if not own:
            worker_state().clear()  # what other operators left in the worker
            own.append((pickle.loads(shared.value), {}))
        block, memo = own[0]
        return pa.array([bool(x) for x in block.matches(texts.to_pylist(), memo)], pa.bool_())

    return held(text)


def without_leaks(docs: DataFrame, benchmark: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows whose texts hold no benchmark item; columns stay as they are."""
    out = docs
    for shared in seeded_blocks(docs, benchmark, cut):
        out = out.where(~holds_item(shared, text_or_empty()))
    return out


def op10_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the alignment's score and place."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
