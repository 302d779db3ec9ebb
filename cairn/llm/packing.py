"""Best-fit packing of token sequences by hierarchical residual rounds.

Texts are tokenised whole, an end id is added, and only texts longer than a
sequence are cut.  Each partition packs its pieces best-fit decreasing.  Bins
that are full or nearly so leave; the others become single items, several
partitions' worth of them meet in one, and best-fit runs again, until a round has
so few items that one task holds them, or merging more would gain nothing: a task
never takes more than about `per_task` items, so the tree stops at as many tasks
as that needs.  Items travel as (id, piece, length) rows inside their bin, never
with text or ids.

Null texts count as empty: they are one piece of one id.  Repeated rows are packed
separately.  Bins are at most `capacity` ids; a bin holds at least one piece.
"""
from __future__ import annotations

import bisect
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, cut, released, slices, text_bytes, text_or_empty, worker_state

CAPACITY, END, NEARLY, FAN_IN, PER_TASK, CACHE = 2048, 0, 0.99, 8, 200_000, 1_200_000

MARKS = ".,;:!?%&$#*|"


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


class WordTokens:
    """Ids of whole texts as packed little-endian words, by way of a bounded cache of chunks.

    The tokenizer composes characters (NFC), squeezes white space, lower-cases,
    splits within runs of other characters, and encodes each split by itself; so a
    text's ids are the ids of its chunks between white space in turn.  Unknown
    chunks of many texts are encoded in one call and told apart by their offsets.
    Texts for which that may not hold (a special token's string, characters whose
    lower case depends on their neighbours, separators that Python alone counts as
    white space) go to the tokenizer whole, as all do under another tokenizer.
    """

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        split = told["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        kinds = [x["type"] for x in told["normalizer"]["normalizers"]]
        known = kinds == ["NFC", "Replace", "Lowercase"] and split == self.PATTERN
        self.odd = ["İ", "Σ", "\x1c", "\x1d", "\x1e", "\x1f", *(t["content"] for t in told["added_tokens"])] if known else [""]
        self.cache: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]) -> None:
        ends: dict[str, tuple[str, str]] = {}  # a word and the marks after it are split there
        plain: dict[str, None] = {}
        for c in chunks:
            word = c.rstrip(MARKS)
            if word and len(word) < len(c) and word[-1].isalnum():
                ends[c] = (word, c[len(word) :])
                plain[word] = plain[c[len(word) :]] = None
            else:
                plain[c] = None
        unknown = [c for c in plain if c not in self.cache]
        for a in range(0, len(unknown), 20_000):
            part = unknown[a : a + 20_000]
            told = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            sizes = np.fromiter(map(len, part), np.int64, len(part)) + 1
            begin = np.cumsum(sizes) - sizes
            offsets = np.array(told.offsets, dtype=np.int64).reshape(-1, 2)[:, 0]
            edges = np.searchsorted(offsets, np.append(begin, begin[-1] + sizes[-1])) * 4
            raw = np.array(told.ids, dtype="<u4").tobytes()
            self.cache.update(zip(part, map(lambda x, y: raw[x:y], edges[:-1].tolist(), edges[1:].tolist()), strict=True))
        self.cache.update((c, self.cache[w] + self.cache[m]) for c, (w, m) in ends.items())

    def packed(self, texts: list[str]) -> list[bytes]:
        out: list = [None] * len(texts)
        split: list = []
        missing: dict[str, None] = {}
        for k, text in enumerate(texts):
            if any(x in text for x in self.odd):
                out[k] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()
                continue
            if not text.isascii() and not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            chunks = text.lower().split()
            found = list(map(self.cache.get, chunks))
            if None in found:
                missing.update((c, None) for c, x in zip(chunks, found, strict=True) if x is None)
                split.append((k, chunks))
            else:
                out[k] = b"".join(found)
        if missing:
            if len(self.cache) + 2 * len(missing) > CACHE:  # cleared: all of these texts' chunks are learned anew
                self.cache.clear()
                missing = dict.fromkeys(c for _, chunks in split for c in chunks)
            self._learn(list(missing))
            for k, chunks in split:
                out[k] = b"".join(map(self.cache.__getitem__, chunks))
        return out


def _pieces_of(path: str, capacity: int):
    def run(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        held = worker_state()
        tokens = held.get(path) or held.setdefault(path, WordTokens(path))
        end = np.array([END], dtype="<u4").tobytes()
        step = 4 * capacity
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in batches:
            rows: list[list] = [[] for _ in names]
            _, offsets = text_bytes(batch.column("text"))
            known = (x for a, b in slices(offsets, 2 << 20) for x in tokens.packed(batch.column("text").slice(a, b - a).to_pylist()))
            for k, ids in zip(batch.column("id").to_pylist(), known, strict=True):
                ids += end
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    for to, x in zip(rows, (k, piece, at // 4, len(part) // 4, zlib.crc32(part)), strict=True):
                        to.append(x)
            kinds = [batch.schema.field("id").type, pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds, strict=True)], names)

    return run


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every text's token pieces."""
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text"))
    kind = dict(slim.dtypes)["id"]
    return slim.mapInArrow(released(_pieces_of(path or tokenizer_path(), capacity), keep=True), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of each item: longest first, each into the fullest bin that still takes it."""
    order = np.argsort(-lengths, kind="stable")
    out = np.empty(len(lengths), dtype=np.int64)
    free: dict[int, list[int]] = {}  # bins by space left
    spaces: list[int] = []  # the spaces that have bins, sorted
    bins = 0
    for i, n in zip(order.tolist(), lengths[order].tolist(), strict=True):
        at = bisect.bisect_left(spaces, n)
        if at < len(spaces):
            space = spaces[at]
            held = free[space]
            b = held.pop()
            if not held:
                del free[space], spaces[at]
        else:
            space, b, bins = capacity, bins, bins + 1
        out[i] = b
        if space > n:
            left = space - n
            if left not in free:
                free[left] = []
                bisect.insort(spaces, left)
            free[left].append(b)
    return out


_ITEM = "array<struct<doc_id:{kind},piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"


def _pack(capacity: int):
    """Packs a partition's bins into fewer; a bin is its fill and its items."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        table = pa.Table.from_batches(list(batches)) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        fill = table.column("fill").to_numpy()
        bins = best_fit(fill, capacity)
        order = np.argsort(bins, kind="stable")
        items = table.column("items").combine_chunks().take(pa.array(order))
        if isinstance(items, pa.ChunkedArray):
            items = items.combine_chunks()
        offsets = items.offsets.to_numpy()
        first = np.flatnonzero(np.concatenate(([True], bins[order][1:] != bins[order][:-1])))
        merged = pa.ListArray.from_arrays(pa.array(np.append(offsets[first], offsets[-1]), pa.int32()), items.values)
        total = np.add.reduceat(fill[order], first)
        for a in range(0, len(first), 5000):
            yield pa.RecordBatch.from_arrays([pa.array(total[a : a + 5000]), merged.slice(a, 5000)], ["fill", "items"])

    return run


def pack(items: DataFrame, capacity: int = CAPACITY, nearly: float = NEARLY, fan_in: int = FAN_IN, per_task: int = PER_TASK) -> DataFrame:
    """(fill, items) bins of the items (doc_id, piece, start, length, ids_crc32)."""
    kind = dict(items.dtypes)["doc_id"]
    schema = f"fill long, items {_ITEM.format(kind=kind)}"
    one = F.array(F.struct("doc_id", "piece", "start", "length", "ids_crc32"))
    open_bins = items.select(F.col("length").alias("fill"), one.alias("items"))
    rows = items.count()
    tasks = max(1, -(-rows // max(1, per_task // fan_in)))
    closed = None
    while True:
        dealt = open_bins.repartition(tasks, F.xxhash64("items")) if tasks > 1 else open_bins.coalesce(1)
        packed = cut(dealt.mapInArrow(released(_pack(capacity)), schema))
        last = tasks == 1
        done = packed if last else packed.where(F.col("fill") >= int(nearly * capacity))
        closed = done if closed is None else closed.unionByName(done)
        if last:
            return closed
        open_bins = packed.where(F.col("fill") < int(nearly * capacity))
        left = open_bins.count()
        fewer = max(1, -(-tasks // fan_in), -(-left // per_task))
        if fewer >= tasks:  # more merging would not fit a task, or gain nothing
            return closed.unionByName(open_bins)
        tasks = fewer


def _placed(kind: str):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        seen = 0
        for batch in batches:
            items = batch.column("items")
            offsets = items.offsets.to_numpy()
            flat = items.values.slice(offsets[0], offsets[-1] - offsets[0])
            sizes = np.diff(offsets)
            length = flat.field("length").to_numpy()
            before = np.cumsum(length) - length
            begin = np.cumsum(sizes) - sizes
            bin_of = np.repeat(np.arange(len(sizes)), sizes)
            offset = before - before[begin[bin_of]]
            sequence = (np.int64(task) << 40) + seen + bin_of
            seen += len(sizes)
            cols = [flat.field(k) for k in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(sequence), pa.array(offset)], ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def packed_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its sequence and its place there."""
    kind = dict(docs.dtypes)["doc_id"]
    bins = pack(cut(pieces(docs, path, capacity)), capacity)
    return bins.mapInArrow(released(_placed(kind)), f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def op7_packing(spark, sf_dir: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 ids."""
    return packed_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
