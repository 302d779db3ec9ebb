"""Exact removal of byte strings that repeat anywhere in the corpus, by a sparse, distributed suffix array.

A byte goes if a string of `length` bytes that covers it also starts somewhere
else, in the same or another text.  Comparing every suffix of the corpus would
move each byte hundreds of times, so the suffix array is sparse:

1. Every window of `length` bytes has one anchor, the position in it whose
   `gram`-byte string hashes lowest (leftmost of ties).  Equal windows have equal
   anchors at equal places, so only the suffixes that start at anchors are sorted,
   each with the bytes that the windows of its anchor cover to both sides.
2. Anchors whose leading string occurs once in the corpus are dropped.
3. Sampled splitters range-partition the suffixes by their leading bytes.  Each
   bucket sorts its suffixes by a multikey quicksort of their bytes, and the common
   prefix of neighbours gives runs that share the leading string.  Within a run the
   common bytes to the left are sorted the same way; two suffixes with so many bytes
   in common to both sides that a window fits are a repeat, and every byte of it was
   compared.  Equal leading strings have equal splitter keys, so a run lies on one
   side of a bucket's boundary: the suffixes next to each other across a boundary
   have less than `gram` bytes in common, and no window can be shared across it.
4. Leading strings with over `hot` suffixes do not enter one bucket: their windows
   become rows that are counted by a strong digest across the whole cluster.

Texts are identified by their MD5, so exact copies are compared once, and a text
of `length` bytes or more with another row of the same text goes whole.
Nulls count as empty texts; texts shorter than `length` keep all their bytes;
long texts are read a piece at a time; repeated rows get equal results; other
columns of the input aren't touched.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bloom import bloom, may_hold
from .common import BASE_A, BASE_B, bound_batches, cut, cut_packed, parts, prefix_sums, released, slices, span_hash, spread_join, text_bytes, text_or_empty

LENGTH, GRAM, HOT = 400, 100, 20_000
#: Words of a passage that `op8_suffix_dedup` tells of beside the strings of LENGTH bytes.
PASSAGE = 51
CHUNK = 1 << 18
#: Runs of up to so many different suffixes are compared pair by pair, larger ones by the groups that each depth makes.
FEW = 24
_TEXT, _RUN = "ta long, tb long", "khash long, s0 int, s1 int, p int"


def window_minimum(key: np.ndarray, width: int) -> np.ndarray:
    """Minimum of key[i : i + width] for each i with that many values."""
    n = len(key)
    if n < width:
        return key[:0]
    rows = -(-n // width)
    block = np.full(rows * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    block[:n] = key
    block = block.reshape(rows, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    behind = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Runs of window starts with one anchor: (row, anchor hash, s0, s1, p), places within the row's bytes."""
    at = np.arange(max(0, len(data) - gram + 1))
    return hashed_runs(span_hash(prefix_sums(data, BASE_A), at, at + gram, BASE_A), offsets, length, gram)


def hashed_runs(h: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """As `anchor_runs`, from the hash of the string of `gram` bytes (or words) at each place."""
    none = np.zeros(0, np.int64)
    counts = np.maximum(0, offsets[1:] - offsets[:-1] - length + 1)
    if not counts.sum():
        return none, none.astype(np.uint64), none, none, none
    key = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    best = (window_minimum(key, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    row = np.repeat(np.arange(len(counts)), counts)
    start = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + offsets[:-1][row]
    p = best[start]
    first = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (row[1:] != row[:-1]))))
    last = np.concatenate((first[1:], [len(p)])) - 1
    base = offsets[:-1][row[first]]
    return row[first], h[p[first]], start[first] - base, start[last] - base, p[first] - base


def _pieces(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple]:
    """(first row, bytes, offsets, place of the bytes in their row): whole rows together, long rows a piece at a time.

    Pieces overlap by length - 1 bytes, so every window is in exactly one.
    """
    for a, b in slices(offsets, CHUNK):
        lo, hi = int(offsets[a]), int(offsets[b])
        if hi - lo <= 2 * CHUNK:
            yield a, data[lo:hi], offsets[a : b + 1] - lo, 0
            continue
        for at in range(lo, hi - length + 1, CHUNK):
            part = data[at : min(hi, at + CHUNK + length - 1)]
            yield a, part, np.array([0, len(part)]), at - lo


def _runs_of(length: int, gram: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: set[int] = set()
        for batch in batches:
            ta, tb = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("ta", "tb"))
            data, offsets = text_bytes(batch.column("text"))
            fresh = np.zeros(len(ta), dtype=bool)  # exact copies within a task are sent once
            for i, name in enumerate(zip(ta.tolist(), tb.tolist(), strict=True)):
                fresh[i] = name not in seen
                if fresh[i] and len(seen) < 200_000:
                    seen.add(name)
            for a, part, cuts, base in _pieces(data, offsets, length):
                row, h, s0, s1, p = anchor_runs(part, cuts, length, gram)
                keep = fresh[a + row]
                row = a + row[keep]
                if len(row):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ta[row]), pa.array(tb[row]), pa.array(h[keep].view(np.int64)), *(pa.array((x[keep] + base).astype(np.int32)) for x in (s0, s1, p))],
                        ["ta", "tb", "khash", "s0", "s1", "p"],
                    )

    return run


def gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes data[start : start + size] of each place, one after the other."""
    to = np.cumsum(size) - size
    return data[np.repeat(start - to, size) + np.arange(int(size.sum()))]


def _segments_of(length: int, gram: int):
    """Cuts each candidate suffix out of its text, with the bytes that its windows cover to the left."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def binary(values: np.ndarray, sizes: np.ndarray):
            ends = np.zeros(len(sizes) + 1, np.int32)
            np.cumsum(sizes, out=ends[1:])
            return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(values))])

        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            runs = batch.column("runs")
            row = np.repeat(np.arange(len(runs)), runs.value_lengths().to_numpy(zero_copy_only=False))
            khash, members, s0, s1, p = (x.to_numpy(zero_copy_only=False) for x in runs.flatten().flatten())
            ta, tb = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("ta", "tb"))
            size = (s1 - s0).astype(np.int64) + length
            start = offsets[row] + s0
            for a, b in slices(np.concatenate(([0], np.cumsum(size))), 2 * CHUNK):
                z = slice(a, b)
                lead = gather(data, start[z] + (p - s0)[z], np.full(b - a, 16))
                yield pa.RecordBatch.from_arrays(
                    [binary(lead, np.full(b - a, 16)), *(pa.array(x[z]) for x in (ta[row], tb[row], khash, members, s0, s1, p)), binary(gather(data, start[z], size[z]), size[z])],
                    ["lead", "ta", "tb", "khash", "members", "s0", "s1", "p", "seg"],
                )

    return run


def multikey_sort(word, n: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of n byte strings by multikey quicksort, eight bytes a round, and the bytes that each has in common with the one before it.

    word(rows, k) gives bytes 8k to 8k + 7 of the rows' strings as numbers in byte order;
    a round reads only strings that are still tied.  Common bytes of strings that stay
    tied are given as 8 * most.
    """
    order = np.arange(n)
    common = np.full(n, 8 * most, dtype=np.int64)
    common[:1] = 0
    at, group = np.arange(n), np.zeros(n, dtype=np.int64)
    for k in range(most):
        if len(at) < 2:
            break
        key = word(order[at], k)
        inner = np.lexsort((key, group))
        order[at] = order[at][inner]
        key = key[inner]
        same = group[1:] == group[:-1]
        split = np.flatnonzero(same & (key[1:] != key[:-1])) + 1
        apart = key[split] ^ key[split - 1]
        for s in (1, 2, 4, 8, 16, 32):  # all bits below the highest differing one
            apart |= apart >> np.uint64(s)
        common[at[split]] = 8 * k + (64 - np.bitwise_count(apart).astype(np.int64)) // 8
        new = np.concatenate(([True], ~same))
        new[split] = True
        group = np.cumsum(new) - 1
        tied = np.bincount(group)[group] > 1
        at, group = at[tied], group[tied]
    return order, common


class Suffixes:
    """Suffixes at anchors with what stands to their left: the bytes of a bucket, or of some whole classes of it."""

    def __init__(self, data: np.ndarray, begin: np.ndarray, left: np.ndarray, right: np.ndarray, length: int, gram: int):
        pad = np.zeros(8, np.uint8)
        self.bytes = np.concatenate((pad, data, pad))
        self.at = begin + left + 8  # the anchor
        self.left, self.right, self.length, self.gram = left, right, length, gram
        self.most = -(-length // 8)
        self.low = np.ndarray(len(self.bytes) - 7, "<u8", self.bytes, strides=(1,))
        self.high = np.ndarray(len(self.bytes) - 7, ">u8", self.bytes, strides=(1,))

    def ahead(self, rows: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8k to 8k + 7 to the right of the anchor; nothing is less than any byte."""
        rest = np.clip(self.right[rows] - 8 * k, 0, 8).astype(np.uint64)
        x = self.high[np.minimum(self.at[rows] + 8 * k, len(self.high) - 1)].astype(np.uint64)
        return np.where(rest > 0, x & (~np.uint64(0) << (np.uint64(64) - np.uint64(8) * np.maximum(rest, np.uint64(1)))), np.uint64(0))

    def behind(self, rows: np.ndarray, k: int) -> np.ndarray:
        """Bytes 8k to 8k + 7 to the left of the anchor, the nearest first."""
        rest = np.clip(self.left[rows] - 8 * k, 0, 8).astype(np.uint64)
        x = self.low[np.maximum(self.at[rows] - 8 * k - 8, 0)].astype(np.uint64)
        return np.where(rest > 0, x & (~np.uint64(0) << (np.uint64(64) - np.uint64(8) * np.maximum(rest, np.uint64(1)))), np.uint64(0))

    def sorted(self, rows: np.ndarray, right: bool) -> tuple[np.ndarray, np.ndarray]:
        """Places of the rows in byte order, shorter ones first, and the bytes in common with the one before."""
        size = (self.right if right else self.left)[rows]
        word = self.ahead if right else self.behind
        by_size = np.argsort(size, kind="stable")  # ties keep this order
        order, common = multikey_sort(lambda r, k: word(rows[by_size[r]], k), len(rows), self.most)
        order = by_size[order]
        common[1:] = np.minimum(common[1:], np.minimum(size[order][1:], size[order][:-1]))
        return order, common

    def common_left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many bytes to the left of the anchors of i and j are equal."""
        most = np.minimum(self.left[i], self.left[j])
        out = most.copy()
        at = np.arange(len(i))
        for k in range(self.most):
            at = at[most[at] > 8 * k]
            if not len(at):
                break
            x = self.low[np.maximum(self.at[i[at]] - 8 * k - 8, 0)].astype(np.uint64) ^ self.low[np.maximum(self.at[j[at]] - 8 * k - 8, 0)].astype(np.uint64)
            for s in (1, 2, 4, 8, 16, 32):
                x |= x >> np.uint64(s)
            same = (64 - np.bitwise_count(x).astype(np.int64)) // 8
            out[at] = np.minimum(most[at], 8 * k + same)
            at = at[same == 8]
        return out

    def repeats(self) -> tuple[np.ndarray, np.ndarray]:
        """For each suffix how far repeated windows reach to its left and right; zeros where there is none."""
        n = len(self.at)
        far_left, far_right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        if n < 2:
            return far_left, far_right
        order, common = self.sorted(np.arange(n), True)
        run = np.cumsum(common < self.gram)  # suffixes with the leading string in common
        begin, end = self.at - self.left, self.at + self.right
        raw = self.bytes.tobytes()
        first: dict = {}
        own = np.empty(n, np.int64)  # the first suffix with the same bytes to both sides
        for place, (i, r) in enumerate(zip(order.tolist(), run.tolist(), strict=True)):
            own[place] = first.setdefault((r, self.left[i], raw[begin[i] : end[i]]), place)
        twice = np.bincount(own, minlength=n)[own] > 1
        far_left[order[twice]], far_right[order[twice]] = self.left[order[twice]], self.right[order[twice]]
        one = np.flatnonzero(own == np.arange(n))
        common = np.append(0, np.minimum.reduceat(common[1 : one[-1] + 1], one[:-1]) if len(one) > 1 else common[:0])
        rows, run = order[one], run[one]
        edges = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1], [True])))
        sizes = np.diff(edges)
        few = np.repeat(sizes <= FEW, sizes)
        right = np.full(len(rows), 8 * self.most)
        for k in range(1, min(FEW, len(rows))):  # suffixes that stand k places apart
            right[:-k] = np.minimum(right[:-k], common[k:])
            i = np.flatnonzero(few[:-k] & (run[k:] == run[:-k]))
            if not len(i):
                break
            a, b, r = rows[i], rows[i + k], right[i]
            near = r + np.minimum(self.left[a], self.left[b]) >= self.length
            a, b, r = a[near], b[near], r[near]
            left = self.common_left(a, b)
            fits = left + r >= self.length
            for x in (a[fits], b[fits]):
                np.maximum.at(far_left, x, left[fits])
                np.maximum.at(far_right, x, r[fits])
        for k in np.flatnonzero(sizes > FEW).tolist():
            self._large(rows[edges[k] : edges[k + 1]], common[edges[k] : edges[k + 1]], far_left, far_right)
        return far_left, far_right

    def _large(self, rows: np.ndarray, right: np.ndarray, far_left: np.ndarray, far_right: np.ndarray) -> None:
        """One run of many suffixes in byte order: those in one group by so many bytes to the left and the rest to the right share a window."""
        n = len(rows)
        order, left = self.sorted(rows, False)

        def shared(depth_left: int, depth_right: int) -> np.ndarray:
            a, b = np.empty(n, np.int64), np.cumsum(right < depth_right)
            a[order] = np.cumsum(left < depth_left)
            _, back, count = np.unique(a * (n + 1) + b, return_inverse=True, return_counts=True)
            return count[back] > 1

        open_left, open_right = np.ones(n, bool), np.ones(n, bool)
        for d in np.unique(left[1:])[::-1].tolist():
            hit = open_left & shared(d, self.length - d)
            far_left[rows[hit]] = np.maximum(far_left[rows[hit]], d)
            open_left &= ~hit
        for d in np.unique(right[1:])[::-1].tolist():
            if d >= self.gram:
                hit = open_right & shared(self.length - d, d)
                far_right[rows[hit]] = np.maximum(far_right[rows[hit]], d)
                open_right &= ~hit


def _resolve(length: int, gram: int):
    def flush(held: list, pa) -> Iterator:
        col = {k: np.concatenate([h.column(k).to_numpy(zero_copy_only=False) for h in held]) for k in ("ta", "tb", "s0", "s1", "p")}
        bits = [text_bytes(h.column("seg")) for h in held]
        data = np.concatenate([x[0] for x in bits])
        size = np.concatenate([np.diff(x[1]) for x in bits])
        begin = np.cumsum(size) - size
        left = (col["p"] - col["s0"]).astype(np.int64)
        far_left, far_right = Suffixes(data, begin, left, size - left, length, gram).repeats()
        hit = np.flatnonzero(far_right)
        if len(hit):
            yield pa.RecordBatch.from_arrays(
                [pa.array(col["ta"][hit]), pa.array(col["tb"][hit]), pa.array((col["p"][hit] - far_left[hit]).astype(np.int32)), pa.array((col["p"][hit] + far_right[hit]).astype(np.int32))],
                ["ta", "tb", "lo", "hi"],
            )

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: list = []
        size = 0
        for batch in batches:  # sorted by (lead, khash): suffixes with one leading string are adjacent
            if not batch.num_rows:
                continue
            kh = batch.column("khash").to_numpy(zero_copy_only=False)
            ends = np.cumsum(np.diff(text_bytes(batch.column("seg"))[1]))
            fresh = kh[1:] != kh[:-1]
            starts = np.flatnonzero(np.append(bool(held) and held[-1].column("khash")[-1].as_py() != kh[0], fresh))
            a = 0
            for b in starts.tolist():
                if size + (ends[b - 1] if b else 0) - (ends[a - 1] if a else 0) > 4 * CHUNK:
                    if b > a:
                        held.append(batch.slice(a, b - a))
                    yield from flush(held, pa)
                    held, size, a = [], 0, b
            held.append(batch.slice(a))
            size += int(ends[-1] - (ends[a - 1] if a else 0))
        if held:
            yield from flush(held, pa)

    return run


def _explode_windows(length: int):
    """A row for each window of the hot classes' suffixes, under its digest."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            col = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in ("ta", "tb", "s0", "s1")}
            for i, seg in enumerate(batch.column("seg")):
                raw = seg.as_buffer()
                n = int(col["s1"][i] - col["s0"][i]) + 1
                word = np.frombuffer(b"".join(hashlib.blake2b(raw[j : j + length], digest_size=16).digest() for j in range(n)), np.int64).reshape(n, 2)
                start = np.arange(col["s0"][i], col["s0"][i] + n, dtype=np.int32)
                yield pa.RecordBatch.from_arrays([*(pa.array(np.full(n, col[k][i])) for k in ("ta", "tb")), pa.array(start), *(pa.array(np.ascontiguousarray(word[:, k])) for k in (0, 1))], ["ta", "tb", "start", "wa", "wb"])

    return run


def keep_bytes(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The bytes outside the spans, how many went, and in how many maximal runs."""
    out, at, gone, runs, end = [], 0, 0, 0, -1
    for lo, hi in sorted(spans):
        if lo > end:
            out.append(raw[at:lo])
            runs += 1
            gone += hi - lo
            end = hi
        elif hi > end:
            gone += hi - end
            end = hi
        at = max(at, end)
    out.append(raw[at:])
    return b"".join(out), gone, runs


def _kept(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        rows = [keep_bytes(t.as_buffer().to_pybytes(), [(x["lo"], x["hi"]) for x in s.as_py()]) for t, s in zip(batch.column("text"), batch.column("spans"), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("ta"), batch.column("tb"), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
            ["ta", "tb", "kept", "n_removed", "n_spans"],
        )


def text_name(text) -> tuple:
    """The MD5 of a text or of bytes as two longs, ta and tb."""
    digest = F.md5(text.cast("binary"))
    return tuple(F.conv(F.substring(digest, at, 16), 16, -10).cast("long").alias(name) for at, name in ((1, "ta"), (17, "tb")))


def repeated_spans(docs: DataFrame, text: str = "text", id_column: str = "doc_id", length: int = LENGTH, gram: int | None = None, hot: int = HOT):
    """(rows, copies, changed): the input as (id, text, ta, tb), texts that can match as (ta, tb, copies), and of texts that lose bytes (ta, tb, kept, n_removed, n_spans)."""
    texts, copies, single = found_spans(docs, text, id_column, length, gram, hot)
    return texts, copies, single.mapInArrow(released(_kept), f"{_TEXT}, kept binary, n_removed long, n_spans long")


def found_spans(docs: DataFrame, text: str = "text", id_column: str = "doc_id", length: int = LENGTH, gram: int | None = None, hot: int = HOT):
    """As `repeated_spans`, but (ta, tb, text, spans) for texts that lose bytes; the spans can overlap."""
    spark = docs.sparkSession
    bound_batches(spark)
    gram = gram or max(1, length // 4)
    name = ["ta", "tb"]
    texts = docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text")).select("id", "text", *text_name(F.col("text")))
    long_enough = texts.where(F.octet_length("text") >= length)
    runs = long_enough.select(*name, "text").mapInArrow(released(_runs_of(length, gram)), f"{_TEXT}, {_RUN}")
    ends = [f(c).alias(f"{c}_{n}") for c in ("ta", "tb", "p") for f, n in ((F.min, "low"), (F.max, "high"))]
    shared = runs.groupBy("khash").agg(F.count("*").alias("members"), *ends).where("ta_low <> ta_high or tb_low <> tb_high or p_low <> p_high")
    # under another key the counts are dealt anew, so that Spark can split a class that a large share of texts has
    other = lambda c: F.col(c).bitwiseXOR(F.lit(1).cast("long"))
    known = shared.select(other("khash").alias("class"), "members")
    # one text stands for its copies; its row has the smallest id
    copies = long_enough.groupBy(*name).agg(F.count("*").alias("copies"), F.min("id").alias("id"))
    met = runs.withColumn("class", other("khash")).join(known, "class")
    wanted = met.groupBy(*name).agg(F.collect_set(F.struct("khash", "members", "s0", "s1", "p")).alias("runs")).join(copies, name)
    w = wanted.select(F.col("ta").alias("ta2"), F.col("tb").alias("tb2"), F.col("id").alias("id2"), "copies", "runs")
    same = (F.col("ta") == F.col("ta2")) & (F.col("tb") == F.col("tb2")) & F.col("id").eqNullSafe(F.col("id2"))
    held = cut(long_enough.join(w, same).select(*name, "text", "copies", "runs"))
    segments = held.select(*name, "text", "runs").mapInArrow(released(_segments_of(length, gram)), f"lead binary, {_TEXT}, khash long, members long, s0 int, s1 int, p int, seg binary")
    n = parts(spark)
    cold = segments.where(F.col("members") <= hot).repartitionByRange(n, "lead", "khash").sortWithinPartitions("lead", "khash")
    found = cold.drop("lead", "members").mapInArrow(released(_resolve(length, gram)), f"{_TEXT}, lo int, hi int")
    windows = segments.where(F.col("members") > hot).select(*name, "s0", "s1", "seg").mapInArrow(released(_explode_windows(length)), f"{_TEXT}, start int, wa long, wb long")
    ends = [f(c).alias(f"{c}_{n}") for c in ("ta", "tb", "start") for f, n in ((F.min, "low"), (F.max, "high"))]
    twice = windows.groupBy("wa", "wb").agg(*ends).where("ta_low <> ta_high or tb_low <> tb_high or start_low <> start_high")
    twice = twice.select(other("wa").alias("xa"), "wb")
    hot_spans = windows.withColumn("xa", other("wa")).join(twice, ["xa", "wb"]).select(*name, F.col("start").alias("lo"), (F.col("start") + length).alias("hi"))
    spans = found.unionByName(hot_spans).groupBy(*name).agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))
    single = held.where("copies = 1").select(*name, "text").join(spans, name)
    return texts, copies.select(*name, "copies"), single


def remove_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id", length: int = LENGTH, passage: int | None = None) -> DataFrame:
    """Each input row's id with n_bytes, n_removed, n_spans, kept_sha256, and how many bytes and code points are left.

    A code point of which a byte went is not counted among those left.  With `passage`,
    repeats_passage is 1 if the row loses bytes or so many of its words in a row stand in
    another document too (another id or another text), however few bytes they have.
    """
    texts, copies, changed = repeated_spans(docs, text, id_column, length)
    rows = texts.select(
        F.col("id").alias("doc_id"), "ta", "tb", F.xxhash64("id").alias("who"), F.octet_length("text").cast("long").alias("n_bytes"), F.char_length("text").cast("long").alias("whole_chars"),
        F.sha2(F.col("text").cast("binary"), 256).alias("whole_sha256"),
    )
    left = F.make_valid_utf8(F.col("kept").cast("string"))
    broken = F.when(F.is_valid_utf8(F.col("kept").cast("string")), 0).otherwise(F.regexp_count(left, F.lit("\ufffd")))
    outcome = changed.select("ta", "tb", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha"), (F.char_length(left) - broken).cast("long").alias("left_chars"))
    name = ["ta", "tb"]
    twin = copies.where("copies > 1").select(*name, F.lit(True).alias("twin"))
    out = rows.join(twin.join(outcome, name, "full_outer"), name, "left")
    whole = F.coalesce(F.col("twin"), F.lit(False))
    pick = lambda gone, part, none: F.when(whole, gone).otherwise(F.coalesce(part, none))
    removed = pick(F.col("n_bytes"), F.col("n_removed"), F.lit(0)).cast("long")
    out = out.select(
        "who", "ta", "doc_id", "n_bytes", removed.alias("n_removed"), pick(F.lit(1), F.col("n_spans"), F.lit(0)).cast("long").alias("n_spans"),
        pick(F.sha2(F.lit("").cast("binary"), 256), F.col("sha"), F.col("whole_sha256")).alias("kept_sha256"),
        (F.col("n_bytes") - removed).alias("kept_bytes"), pick(F.lit(0), F.col("left_chars"), F.col("whole_chars")).cast("long").alias("kept_chars"),
        (removed > 0).cast("int").alias("has_repeats"),
    )
    if passage is None:
        return out.drop("who", "ta")
    out = cut(out)
    found = shared_passages(texts.select(F.xxhash64("id").alias("who"), "ta", "text"), out.where("n_removed = 0").select(F.col("ta").alias("x")), passage)
    met = out.join(found.withColumn("met", F.lit(1)), ["who", "ta"], "left")
    return met.withColumn("repeats_passage", F.greatest("has_repeats", F.coalesce("met", F.lit(0)))).drop("who", "ta", "met")


def without_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id", length: int = LENGTH) -> DataFrame:
    """The input with repeated strings cut out of its texts; rows left with nothing but white space go, unless they were so before.

    A code point of which a byte went goes too.
    """
    _, copies, changed = repeated_spans(docs, text, id_column, length)
    kept = F.col("kept").cast("string")
    fixed = changed.select("ta", "tb", F.coalesce(F.try_validate_utf8(kept), F.regexp_replace(F.make_valid_utf8(kept), "\ufffd", "")).alias("_left"))
    return _with_rest(docs, text, text_or_empty(text), copies, fixed, lambda _, left: left)


def _with_rest(docs: DataFrame, text: str, code: Column, copies: DataFrame, changed: DataFrame, rest) -> DataFrame:
    """The input with rest(text, _left) as the text where `changed` (ta, tb, _left) knows its code; texts with copies go, as do rows of which only white space is left."""
    twin = copies.where("copies > 1").select("ta", "tb", F.lit(True).alias("_twin"))
    both = twin.join(changed, ["ta", "tb"], "full_outer")
    packed = docs.select(F.struct(*docs.columns).alias("row"), code.alias("code")).select("row", F.struct(*text_name(F.col("code"))).alias("name"))
    found = packed.join(both, (F.col("name.ta") == F.col("ta")) & (F.col("name.tb") == F.col("tb")), "left")
    whole = F.coalesce(F.col("row")[text].cast("string"), F.lit(""))
    new = found.withColumn("_rest", F.when(F.col("_twin"), F.lit("")).when(F.col("_left").isNotNull(), rest(whole, F.col("_left"))))
    left = new.where(F.col("_rest").isNull() | (F.trim(F.regexp_replace("_rest", r"\s+", " ")) != ""))
    return left.select(*(F.coalesce(F.col("_rest"), F.col("row")[c]).alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))


#: Words as `without_repeated_words` counts them: runs without white space, and each letter of scripts that don't part words.
_ALONE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
_WORD = re.compile(rf"[{_ALONE}]|[^\s{_ALONE}]+")
CODE = 5  # bytes that stand for a word


#: Bytes of white space in ASCII, and what can't be parted at them alone: other white space, and letters that are words.
_BLANK = np.isin(np.arange(256), list(b"\t\n\v\f\r\x1c\x1d\x1e\x1f "))
_RARE = re.compile(rb"\xc2[\x85\xa0]|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|[\xe0\xe1\xe3-\xef]")


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, first byte, last byte + 1) of every word of the rows."""
    blank = _BLANK[data]
    first, last = ~blank, ~blank
    first[1:] &= blank[:-1]
    last[:-1] &= blank[1:]
    at = offsets[:-1][offsets[:-1] < offsets[1:]]  # rows end words too
    first[at] |= ~blank[at]
    last[offsets[1:][offsets[:-1] < offsets[1:]] - 1] |= ~blank[offsets[1:][offsets[:-1] < offsets[1:]] - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    raw = data.tobytes()
    rare = np.unique(np.searchsorted(offsets, [m.start() for m in _RARE.finditer(raw)], side="right") - 1).tolist()
    if rare:
        keep = ~np.isin(row, rare)
        places = [(row[keep], start[keep], end[keep])]
        for k in rare:
            text = raw[offsets[k] : offsets[k + 1]].decode("utf-8", "surrogatepass")
            byte = np.cumsum([0, *(len(c.encode("utf-8", "surrogatepass")) for c in text)]) + offsets[k]
            spans = np.array([m.span() for m in _WORD.finditer(text)], dtype=np.int64).reshape(-1, 2)
            places.append((np.full(len(spans), k), byte[spans[:, 0]], byte[spans[:, 1]]))
        row, start, end = (np.concatenate(x) for x in zip(*places, strict=True))
        order = np.lexsort((start, row))
        row, start, end = row[order], start[order], end[order]
    return row, start, end


def word_codes(texts):
    """An Arrow array of CODE ASCII letters for each word of each text, 30 bits of its hash."""
    import pyarrow as pa

    data, offsets = text_bytes(texts)
    letters, counts = [], np.zeros(len(texts), np.int64)
    for a, b in slices(offsets, CHUNK):
        part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        row, start, end = word_places(part, cuts)
        h = span_hash(prefix_sums(part, BASE_A), start, end, BASE_A)
        shifts = np.arange(CODE, dtype=np.uint64) * np.uint64(6) + np.uint64(34)
        letters.append((((h[:, None] >> shifts) & np.uint64(63)) + np.uint64(48)).astype(np.uint8).ravel())
        counts[a:b] = np.bincount(row, minlength=b - a)
    ends = np.zeros(len(texts) + 1, np.int32)
    np.cumsum(CODE * counts, out=ends[1:])
    return pa.StringArray.from_buffers(len(texts), pa.py_buffer(ends), pa.py_buffer(np.concatenate(letters) if letters else np.zeros(0, np.uint8)))


def _coded(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column("id"), word_codes(batch.column("text"))], ["id", "codes"])


def without_words(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the words that spans of its codes cover."""
    words = [m.span() for m in _WORD.finditer(text)]
    out, at = [], 0
    for lo, hi in sorted(spans):
        first, last = -(-lo // CODE), hi // CODE - 1
        if first <= last and words[last][1] > at:
            out.append(text[at : max(at, words[first][0])])
            at = words[last][1]
    return "".join(out) + text[at:]


def without_repeated_words(docs: DataFrame, words: int, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """As `without_repeats`, for strings of so many words or more, however short the words; white space between words doesn't count."""
    bound_batches(docs.sparkSession)
    kind = dict(docs.dtypes)[id_column]
    codes = docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text")).mapInArrow(released(_coded), f"id {kind}, codes string")
    _, copies, single = found_spans(codes, "codes", "id", words * CODE)

    @F.arrow_udf("string")
    def coded(texts):
        return word_codes(texts)

    @F.arrow_udf("string")
    def rest(texts, spans):
        import pyarrow as pa

        return pa.array([t if s is None else without_words(t, [(x["lo"], x["hi"]) for x in s]) for t, s in zip(texts.to_pylist(), spans.to_pylist(), strict=True)], pa.string())

    return _with_rest(docs, text, coded(text_or_empty(text)), copies, single.select("ta", "tb", F.col("spans").alias("_left")), rest)


def _word_runs(batches: Iterator, words: int, gram: int) -> Iterator[tuple]:
    """(batch, bytes, first and last byte + 1 of each word, prefix sums of the words' hashes, the batch's row, anchor hash, first and last window of each run), windows by their first word."""
    for batch in batches:
        data, offsets = text_bytes(batch.column("text"))
        for a, b in slices(offsets, CHUNK):
            part, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            row, start, end = word_places(part, cuts)
            sums = prefix_sums(span_hash(prefix_sums(part, BASE_A), start, end, BASE_A), BASE_A)
            at = np.arange(max(0, len(row) - gram + 1))
            first = np.searchsorted(row, np.arange(b - a + 1))
            run, h, s0, s1, _ = hashed_runs(span_hash(sums, at, at + gram, BASE_A), first, words, gram)
            if len(run):
                yield batch, part, start, end, sums, a + run, h, s0 + first[run], s1 + first[run]


def _anchors_of(words: int, gram: int, held):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch, *_, row, h, _, _ in _word_runs(batches, words, gram):
            new = np.append(True, (row[1:] != row[:-1]) | (h[1:] != h[:-1]))
            row, h = row[new], h[new]
            who, ta = (batch.column(k).to_numpy(zero_copy_only=False) for k in ("who", "ta"))
            may = may_hold(held.value, ta.view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(who[row]), pa.array(ta[row]), pa.array(may[row])], ["khash", "who", "ta", "open"])

    return run


def _windows_of(words: int, gram: int, held):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch, part, start, end, sums, row, h, s0, s1 in _word_runs(batches, words, gram):
            pick = may_hold(held.value, h)
            if not pick.any():
                continue
            n = (s1 - s0 + 1)[pick]
            at = np.repeat(s0[pick] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
            other = prefix_sums(span_hash(prefix_sums(part, BASE_B), start, end, BASE_B), BASE_B)
            digest = (span_hash(x, at, at + words, base).view(np.int64) for x, base in ((sums, BASE_A), (other, BASE_B)))
            who, ta = (batch.column(k).to_numpy(zero_copy_only=False)[np.repeat(row[pick], n)] for k in ("who", "ta"))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (who, ta, *digest)], ["who", "ta", "wa", "wb"])

    return run


def shared_passages(texts: DataFrame, open_texts: DataFrame, words: int, gram: int | None = None) -> DataFrame:
    """(who, ta) of the rows (who, ta, text) with so many words in a row that a row of another who or ta has too, where `ta` of one of the two is in the column `x` of `open_texts`.

    Words are those of `without_repeated_words`.  Equal passages have equal anchors, strings of
    `gram` words, at equal places; anchors of one row alone, or of no open row, are dropped, and
    the windows of the others are counted under 128-bit digests.  A row whose ta only seems to be
    open may be found as well.
    """
    spark = texts.sparkSession
    bound_batches(spark)
    gram = gram or max(1, words // 4)
    ends = [f(c).alias(f"{c}_{n}") for c in ("who", "ta") for f, n in ((F.min, "low"), (F.max, "high"))]
    apart = "who_low <> who_high or ta_low <> ta_high"
    anchors = texts.mapInArrow(released(_anchors_of(words, gram, bloom(open_texts))), "khash long, who long, ta long, open boolean")
    wanted, _ = cut_packed(anchors.groupBy("khash").agg(F.max("open").alias("open"), *ends).where("open").where(apart).select(F.col("khash").alias("x")))
    windows = cut(texts.mapInArrow(released(_windows_of(words, gram, bloom(wanted))), "who long, ta long, wa long, wb long"))
    twice = windows.groupBy("wa", "wb").agg(*ends).where(apart).select("wa", "wb")
    return spread_join(windows, twice, ["wa", "wb"]).select("who", "ta").distinct()


def op8_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document's bytes without strings of 400 bytes that start twice or more in the corpus."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), passage=PASSAGE)
