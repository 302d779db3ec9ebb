"""Context-triggered piecewise hashing of documents.

A rolling hash of the last seven bytes cuts the text where it hits a multiple of
the block size; each piece gives one of 64 letters.  A fingerprint is
`size:letters:letters`, its second part cut at twice the block size, so texts
whose lengths differ by a factor of two still share a size.  Block sizes are
3 times a power of two; the first one follows the text's length and is halved
while it gives fewer than 16 letters.  A part has 64 letters at most: the last one
takes in all that follows.

Two fingerprints are compared at every block size that both have, by edit
distance over letters, and count as unlike (0) if their parts share no run of
four letters, unless a part is shorter than that.  Equal fingerprints are 1.

Null and empty texts have the fingerprint `3::`, like each other and unlike all
others.  Every text is read whole.  Neighbours are taken in descending id order
(equal ids by text, nulls last), the last one's neighbour is the first; with one row a text is its own neighbour.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BASE_A, BASE_B, bound_batches, parts, prefix_sums, released, slices, span_hash, text_or_empty

LETTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", dtype=np.uint8)
SMALLEST, MOST, FEWEST, ROLL, COMMON = 3, 64, 16, 7, 4
CHUNK = 1 << 19


def _letters(sums: np.ndarray, cuts: np.ndarray, a: int, b: int) -> str:
    """A letter for each piece of [a, b) between the cuts (places after which a piece ends)."""
    if len(cuts) >= MOST:
        cuts = cuts[: MOST - 1]
    edges = np.concatenate(([a], cuts, [b])) if not len(cuts) or cuts[-1] < b else np.concatenate(([a], cuts))
    h = span_hash(sums, edges[:-1], edges[1:], BASE_B)
    return LETTERS[(h >> np.uint64(58)).astype(np.int64)].tobytes().decode()


def signatures(data: np.ndarray, offsets: np.ndarray) -> list[str]:
    """The fingerprint of each row's bytes."""
    sums, rolled = prefix_sums(data, BASE_B), prefix_sums(data, BASE_A)
    at = np.arange(len(data))
    begin = np.repeat(offsets[:-1], np.diff(offsets))
    roll = (span_hash(rolled, np.maximum(begin, at - ROLL + 1), at + 1, BASE_A) >> np.uint64(16)).astype(np.uint64)
    base = np.flatnonzero(roll % np.uint64(SMALLEST) == SMALLEST - 1)
    # how many times the block size can double with the cut still there
    order = (roll[base] + np.uint64(1)) // np.uint64(SMALLEST)
    level = np.bitwise_count((order & (~order + np.uint64(1))) - np.uint64(1)).astype(np.int64)
    edges = np.searchsorted(base, offsets)
    out = []
    for k in range(len(offsets) - 1):
        a, b = int(offsets[k]), int(offsets[k + 1])
        if a == b:
            out.append(f"{SMALLEST}::")
            continue
        own, lev = base[edges[k] : edges[k + 1]] + 1, level[edges[k] : edges[k + 1]]
        step = 0
        while (SMALLEST << step) * MOST < b - a:
            step += 1
        while step and (lev >= step).sum() + 1 < FEWEST:
            step -= 1
        out.append(f"{SMALLEST << step}:{_letters(sums, own[lev >= step], a, b)}:{_letters(sums, own[lev > step], a, b)}")
    return out


def fingerprint(text: str) -> str:
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    return signatures(raw, np.array([0, len(raw)]))[0]


def _bound(value: Column, then) -> Column:
    """then(value), with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _alike(a: Column, b: Column) -> Column:
    def compared(p: Column) -> Column:
        grams = lambda s: F.transform(F.sequence(F.lit(1), F.char_length(s) - (COMMON - 1)), lambda i: F.substring(s, i, F.lit(COMMON)))
        longest, shortest = F.greatest(F.char_length(p["a"]), F.char_length(p["b"])), F.least(F.char_length(p["a"]), F.char_length(p["b"]))
        unlike = (shortest >= COMMON) & ~F.arrays_overlap(grams(p["a"]), grams(p["b"]))
        return F.when(shortest == 0, 0.0).when(unlike, 0.0).otherwise(F.lit(1.0) - F.levenshtein(p["a"], p["b"]) / longest)

    return _bound(F.struct(a.alias("a"), b.alias("b")), compared)


def likeness(x: Column, y: Column) -> Column:
    """0 to 1 for two fingerprints."""
    part = lambda p, i: F.get(p, F.lit(i))

    def compared(p: Column) -> Column:
        a, b = p["a"], p["b"]
        sa, sb = part(a, 0).cast("long"), part(b, 0).cast("long")
        return (
            F.when(sa == sb, F.greatest(_alike(part(a, 1), part(b, 1)), _alike(part(a, 2), part(b, 2))))
            .when(sa == sb * 2, _alike(part(a, 1), part(b, 2)))
            .when(sb == sa * 2, _alike(part(b, 1), part(a, 2)))
            .otherwise(0.0)
        )

    return F.when(x == y, 1.0).otherwise(_bound(F.struct(F.split(x, ":").alias("a"), F.split(y, ":").alias("b")), compared))


def _with_neighbours(kind: str):
    def flush(rows: list[tuple], pa) -> Iterator:
        """rows: (id, text, next text) triples."""
        a = 0
        while a < len(rows):
            size, b = 0, a
            while b < len(rows) and (b == a or size < 2 * CHUNK):
                size += len(rows[b][1]) + len(rows[b][2])
                b += 1
            part = rows[a:b]
            a = b
            halves = [len(t) // 2 for _, t, _ in part]
            edited = [t[: len(t) - h] + n[:h] for (_, t, n), h in zip(part, halves, strict=True)]
            marks = []
            for texts in ([t for _, t, _ in part], edited, [n for _, _, n in part]):
                raw = [t.encode() for t in texts]
                data, offsets = np.frombuffer(b"".join(raw), dtype=np.uint8), np.cumsum([0, *map(len, raw)])
                own = [s for x, y in slices(offsets, CHUNK) for s in signatures(data[offsets[x] : offsets[y]], offsets[x : y + 1] - offsets[x])]
                marks.append(own)
                if texts is edited:
                    shas = [_sha(r) for r in raw]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part]).cast(kinds[kind]), pa.array([len(t) for _, t, _ in part], pa.int64()), pa.array(shas, pa.string()), *(pa.array(m, pa.string()) for m in marks)],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "next_fingerprint"],
            )

    import pyarrow

    kinds = {"bigint": pyarrow.int64(), "int": pyarrow.int32(), "string": pyarrow.string()}

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held, rows, size, bucket = None, [], 0, None
        for batch in batches:  # sorted by bucket, then descending; each bucket ends with its successor's first row
            for b, k, text, guest in zip(*(batch.column(c).to_pylist() for c in ("b", "id", "text", "guest")), strict=True):
                if b != bucket:
                    held, bucket = None, b
                if held is not None:
                    rows.append((held[0], held[1], text))
                    size += len(held[1])
                    if size > 4 * CHUNK:
                        yield from flush(rows, pa)
                        rows, size = [], 0
                held = None if guest else (k, text)
        if rows:
            yield from flush(rows, pa)

    return run


def _sha(raw: bytes) -> str:
    import hashlib

    return hashlib.sha256(raw).hexdigest()


def neighbour_fingerprints(docs: DataFrame, text: str = "text", id_column: str = "doc_id", buckets: int | None = None) -> DataFrame:
    """Fingerprints of each text, its edited text and its neighbour, and their likeness.

    Ids are dealt into ranges by sampled splitters; each range also gets the first
    row of the range below as a guest, so no row has to see all others.
    """
    spark = docs.sparkSession
    bound_batches(spark)
    slim = docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text"))
    kind = dict(slim.dtypes)["id"]
    n = buckets or 2 * parts(spark)
    cuts = slim.where("id is not null").agg(F.percentile_approx("id", [i / n for i in range(1, n)], 10_000).alias("q")).first()["q"] if n > 1 else []
    cuts = sorted(set(cuts or []))
    # bucket 0 holds the largest ids; nulls come after all
    number = F.array_size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c >= F.col("id"))) if cuts else F.lit(0)
    placed = slim.withColumn("b", F.coalesce(number, F.lit(len(cuts) + 1)).cast("int"))
    order = F.struct("id", F.xxhash64("text").alias("x"), F.octet_length("text").alias("n"))
    heads = {r["b"]: r["h"] for r in placed.groupBy("b").agg(F.max(order).alias("h")).collect()}  # a row for each range
    if not heads:
        empty = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
        return spark.createDataFrame([], empty)
    ranges = sorted(heads)
    above = [(ranges[i - 1], b, heads[b]["id"], heads[b]["x"]) for i, b in enumerate(ranges)]
    first = F.broadcast(spark.createDataFrame(above, f"g int, hb int, hid {kind}, hx long"))  # a row for each range
    same = (F.col("b") == F.col("hb")) & F.col("id").eqNullSafe(F.col("hid")) & (F.xxhash64("text") == F.col("hx"))
    guests = placed.join(first, same).groupBy("g").agg(F.first("id").alias("id"), F.first("text").alias("text")).select(F.col("g").alias("b"), "id", "text")
    rows = placed.select("b", "id", "text", F.lit(False).alias("guest")).unionByName(guests.withColumn("guest", F.lit(True)))
    sorted_rows = rows.repartition(parts(spark), "b").sortWithinPartitions("b", "guest", F.desc_nulls_last("id"), F.desc(F.xxhash64("text")))
    marks = sorted_rows.mapInArrow(released(_with_neighbours(kind)), f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, next_fingerprint string")
    return marks.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )


def op1_fingerprint(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint, and its likeness to its edited text's and the next document's."""
    return neighbour_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
