"""SimHash near-duplicates, searched through a Gray-order hierarchical index.

Fingerprints: 64 majority bits over the XXH64 hashes of word shingles.  Equal
fingerprints are one node, so copies never meet as pairs.  Two fingerprints at
`radius` or fewer differing bits agree on at least k of radius + k blocks of the
64 bits; each choice of k blocks is a table, and the blocks' bits the key under
which fingerprints meet.  k follows the number of distinct fingerprints, so that
a key keeps about 64 of them.  A key of over `KEY` fingerprints is split by blocks of its
other bits, by the same argument, again and again until none is larger; what can't be
split has so few other bits that it can't be larger.  So no link is lost.

Within a key the fingerprints are sorted by Gray rank and made into a tree: each
node keeps the bits that all fingerprints below it share.  Node pairs are
compared on their common shared bits, and a pair whose differences already exceed
the radius is dropped with all below it.  The links found are reduced to a
spanning forest before they leave the task.

Null and empty texts, and texts of white space only, have fingerprint zero and
link like any other.  Repeated rows link to each other.  Rows with a null id are
kept and have the component of their fingerprint.  Ids can be of any type with an order.
"""
from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import sifted
from .common import bound_batches, cut, mix64, parts, released, spread_join, text_bytes, text_or_empty
from .components import connected_components

WORDS, RADIUS, SEED = 4, 4, 42
FAN, ROWS, PAIRS, KEY = 16, 100_000, 1_000_000, 4_096


def shingle_hashes(raw: bytes, words: int, seed: int = SEED) -> list[int]:
    """XXH64 of every shingle of the lower-cased (A-Z only) text's words."""
    import xxhash

    tokens = raw.lower().split()
    if not tokens:
        return []
    line, h = b" ".join(tokens), xxhash.xxh64_intdigest
    if len(tokens) <= words:
        return [h(line, seed)]
    ends = list(itertools.accumulate(map(len, tokens), lambda at, n: at + 1 + n))
    starts = [0, *(e + 1 for e in ends)]
    return [h(line[a:b], seed) for a, b in zip(starts, ends[words - 1 :], strict=False)]


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A fingerprint for each run of `counts` hashes: the bits set in over half of them."""
    out = np.zeros(len(counts), dtype=np.uint64)
    has = np.flatnonzero(counts)
    if not len(has):
        return out
    n = counts[has]
    pieces = -(-n // 255)  # a byte lane counts to 255
    first = np.repeat(np.cumsum(n) - n, pieces)
    within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    at, lanes = first + 255 * within, np.uint64(0x0101010101010101)
    row = np.cumsum(pieces) - pieces
    fp = np.zeros(len(has), dtype=np.uint64)
    for k in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(k)) & lanes, at)
        ones = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8).astype(np.int64), row, axis=0)
        for j in range(8):
            fp |= (2 * ones[:, j] > n).astype(np.uint64) << np.uint64(8 * j + k)
    out[has] = fp
    return out


def _fingerprints(words: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            ids, texts = batch.column("id"), batch.column("text")
            out, hashes, counts, known, todo = [], [], [], {}, []
            for text in texts:
                raw = text.as_buffer().to_pybytes()
                if raw in known:  # copies in this batch
                    todo.append(known[raw])
                    continue
                h = shingle_hashes(raw, words)
                known[raw] = len(counts) + len(out)
                todo.append(known[raw])
                hashes += h
                counts.append(len(h))
                if len(hashes) > 200_000:
                    out += majority_bits(np.array(hashes, np.uint64), np.array(counts)).tolist()
                    hashes, counts = [], []
            if counts:
                out += majority_bits(np.array(hashes, np.uint64), np.array(counts)).tolist()
            fps = np.array(out, dtype=np.uint64)[np.array(todo, dtype=np.int64)] if todo else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(fps.view(np.int64))], ["id", "fp"])

    return run


def fingerprints(docs: DataFrame, words: int = WORDS, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, fp) of every row; fp holds the 64 bits as a long."""
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text"))
    return slim.mapInArrow(released(_fingerprints(words)), f"id {dict(slim.dtypes)['id']}, fp long")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each 64-bit word in the reflected Gray order."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> np.uint64(s))
    return x


def link_groups(fps: np.ndarray, group: np.ndarray, radius: int, label: np.ndarray | None = None, confirm=None) -> np.ndarray:
    """Smallest place that each place links to, within groups, at `radius` or fewer bits.

    fps has a row of words for each fingerprint; rows are sorted by group, then Gray rank.
    Pairs that are linked already, also by a label that is given, are not compared again.
    confirm(label, i, j) links those of the pairs that it accepts; without it all are.
    """
    n = len(fps)
    label = np.arange(n) if label is None else label
    confirm = confirm or settle
    if not n:
        return label
    levels = [(fps, np.full_like(fps, ~np.uint64(0)), np.arange(n), np.arange(1, n + 1))]
    owner = group
    while True:
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        if len(first) == len(owner):
            break
        sizes = np.diff(np.concatenate((first, [len(owner)])))
        nodes = -(-sizes // FAN)
        begin = np.repeat(first, nodes) + FAN * (np.arange(nodes.sum()) - np.repeat(np.cumsum(nodes) - nodes, nodes))
        end = np.minimum(begin + FAN, np.repeat(first + sizes, nodes))
        bits, mask = levels[-1][0], levels[-1][1]
        ones = np.bitwise_and.reduceat(bits | ~mask, begin, axis=0)
        zeros = ~np.bitwise_or.reduceat(bits | ~mask, begin, axis=0)
        levels.append((ones, (ones | zeros) & np.bitwise_and.reduceat(mask, begin, axis=0), begin, end))
        owner = owner[begin]
    top = len(levels) - 1
    roots = np.arange(len(levels[top][0]))
    stack = [(top, roots[a : a + 10_000], roots[a : a + 10_000]) for a in range(0, len(roots), 10_000)]
    most = PAIRS // fps.shape[1]
    while stack:
        level, a, b = stack.pop()
        if level == 0:
            label = settle(label, a, b)
            continue
        _, _, begin, end = levels[level]
        bits, mask = levels[level - 1][0], levels[level - 1][1]
        na, nb = end[a] - begin[a], end[b] - begin[b]
        total = na * nb
        cum = np.cumsum(total)
        x = 0
        while x < len(a):
            y = max(x + 1, int(np.searchsorted(cum, (cum[x - 1] if x else 0) + most, side="right")))
            t = total[x:y]
            k = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
            wide = np.repeat(nb[x:y], t)
            i = np.repeat(begin[a[x:y]], t) + k // wide
            j = np.repeat(begin[b[x:y]], t) + k % wide
            keep = (label[i] != label[j]) if level == 1 else (i <= j)
            i, j = i[keep], j[keep]
            apart = np.bitwise_count((bits[i] ^ bits[j]) & mask[i] & mask[j]).sum(axis=1, dtype=np.int64)
            keep = apart <= radius
            if level == 1:
                label = confirm(label, i[keep], j[keep])
            else:
                stack.append((level - 1, i[keep], j[keep]))
            x = y
    return label


def settle(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest place of each place's component, with the links (i, j) added."""
    while True:
        a, b = label[i], label[j]
        differ = a != b
        if not differ.any():
            return label
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        low = np.minimum(a, b)
        np.minimum.at(label, np.maximum(a, b), low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def _words_of(column) -> np.ndarray:
    """Rows of words from a column of longs or of binaries of one size."""
    import pyarrow as pa

    if pa.types.is_integer(column.type):
        return column.to_numpy(zero_copy_only=False).view(np.uint64)[:, None]
    raw, offsets = text_bytes(column)
    return np.frombuffer(raw.tobytes(), dtype=np.uint64).reshape(len(column), -1) if len(column) else np.zeros((0, 1), np.uint64)


def _links(radius: int):
    keys = ("mask", "key")

    def flush(table: dict, pa) -> Iterator:
        order = np.lexsort((gray_rank(table["fp"][:, 0]), *(table[k] for k in reversed(keys))))
        cols = {k: v[order] for k, v in table.items()}
        edge = np.zeros(len(order), bool)
        for k in keys:
            edge[1:] |= cols[k][1:] != cols[k][:-1]
        edge[:1] = True
        group = np.cumsum(edge) - 1
        alone = np.bincount(group)[group] == 1
        fps, group, node = cols["fp"][~alone], group[~alone], cols["node"][~alone]
        label = link_groups(fps, group, radius)
        linked = np.flatnonzero(label != np.arange(len(fps)))
        if len(linked):
            yield pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[label[linked]])], ["a", "b"])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: list[dict] = []
        size = 0
        for batch in batches:  # sorted by the keys: whole groups are cut off as they pass
            if not batch.num_rows:
                continue
            held.append({k: batch.column(k).to_numpy(zero_copy_only=False) for k in (*keys, "node")} | {"fp": _words_of(batch.column("fp"))})
            size += batch.num_rows
            if size >= ROWS:
                table = {k: np.concatenate([h[k] for h in held]) for k in held[0]}
                same = np.ones(size, bool)
                for k in keys:
                    same &= table[k] == table[k][-1]
                done = size - int(same.sum())
                if done:
                    yield from flush({k: v[:done] for k, v in table.items()}, pa)
                held, size = [{k: v[done:] for k, v in table.items()}], size - done
        if size:
            yield from flush({k: np.concatenate([h[k] for h in held]) for k in held[0]}, pa)

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(bits: list[int], n: int) -> list[int]:
    """Masks of n blocks of nearly equal size over the given bit places."""
    edges = [round(k * len(bits) / n) for k in range(n + 1)]
    return [sum(1 << b for b in bits[x:y]) for x, y in itertools.pairwise(edges)]


def table_masks(bits: list[int], radius: int, k: int) -> list[int]:
    return [sum(c) for c in itertools.combinations(_blocks(bits, radius + k), k)]


def _longs(values: list[int]):
    return F.array(*(F.lit(_signed(v)).cast("long") for v in values))


def split_keys(keyed: DataFrame, radius: int, most: int = KEY) -> DataFrame:
    """(node, fp, mask) so that at most `most` nodes agree on the mask's bits, and pairs at `radius` bits still share a row's mask and bits."""
    left = most.bit_length() - 1  # fingerprints with so few other bits are few
    while True:
        key = F.col("fp").bitwiseAND(F.col("mask"))
        large = cut(keyed.groupBy("mask", key.alias("key")).count().where((F.col("count") > most) & (F.bit_count("mask") < 64 - left)).select("mask", "key"))
        masks = [r["mask"] & (1 << 64) - 1 for r in large.select("mask").distinct().collect()]  # of the tables, whose number the radius bounds
        if not masks:
            return keyed
        inner = F.map_from_arrays(_longs(masks), F.array(*(_longs([m | x for x in table_masks([b for b in range(64) if not m >> b & 1], radius, 1)]) for m in masks)))
        marked = spread_join(keyed.withColumn("key", key), large.withColumn("large", F.lit(True)), ["key", "mask"], "left")
        finer = F.when(F.col("large"), F.element_at(inner, F.col("mask"))).otherwise(F.array("mask"))
        keyed = cut(marked.select("node", "fp", F.explode(finer).alias("mask")))


def linked_components(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(node, component) of nodes (node, fp), distinct in fp, that link to another."""
    n = nodes.count()
    k = next((k for k in (1, 2, 3) if n >> (64 * k // (radius + k)) <= 64), 4)
    keyed = nodes.select("node", "fp", F.explode(_longs(table_masks(list(range(64)), radius, k))).alias("mask"))
    placed = split_keys(keyed, radius).withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
    met = placed.repartition(parts(nodes.sparkSession), "mask", "key").sortWithinPartitions("mask", "key")
    return connected_components(cut(met.mapInArrow(released(_links(radius)), "a long, b long").distinct()))


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, fp, component): the component is the smallest id reachable over links of at most `radius` bits."""
    rows = cut(fingerprints(docs, words, text, id_column))
    nodes = cut(rows.groupBy("fp").agg(F.min("id").alias("least")))
    found = linked_components(nodes.select(F.col("fp").alias("node"), "fp"), radius)
    named = nodes.join(found, nodes["fp"] == found["node"], "left").select("fp", "least", F.coalesce("component", "fp").alias("grp"))
    least = named.groupBy("grp").agg(F.min("least").alias("component"))
    own = spread_join(named.select("fp", "grp"), least, ["grp"]).select(F.col("fp").alias("fp2"), "component")
    return rows.join(own, F.col("fp") == F.col("fp2"), "left").select("id", "fp", "component")


#: For `similar_groups`: words to a shingle, minima to a band and bands of the MinHash signature that deals texts into groups, words and
#: largest distance of the wide fingerprint.  A pair of similarity 0.8 shares a band with a chance of 0.9993 and differs in about 39
#: of the 256 bits, whatever the size of the corpus; over 72 bits differ for fewer than 1 in 1,000 such pairs, of any length.
WIDE_WORDS, BAND, BANDS, WIDE, FAR = 5, 6, 24, 4, 72
#: Texts and bytes of shingles that one task compares with each other, and pivots of a larger group.
GROUP, GROUP_BYTES, PIVOTS = 4_096, 16 << 20, 8


def alike(common, a, b):
    """Whether sets of a and b members with so many in common have a Jaccard similarity of 0.8 at least."""
    return 9 * common >= 4 * (a + b)


def shingle_set(raw: bytes, words: int) -> np.ndarray:
    return np.unique(np.array(shingle_hashes(raw, words), dtype=np.uint64))


def _node(own: np.ndarray) -> int:
    import xxhash

    return _signed(xxhash.xxh64_intdigest(own.tobytes(), SEED))


def band_keys(sets: list[np.ndarray]) -> np.ndarray:
    """A row of BANDS keys for each set of shingles; equal keys are equal minima of BAND hash functions."""
    keys = np.zeros((len(sets), BANDS), np.uint64)
    has = [i for i, x in enumerate(sets) if len(x)]
    if not has:
        return keys
    h = mix64(np.concatenate([sets[i] for i in has]))
    at = np.cumsum([0, *(len(sets[i]) for i in has)])[:-1]
    factors = mix64(np.arange(1, BAND * BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    for t in range(BANDS):
        key = np.zeros(len(has), np.uint64)
        for f in factors[t * BAND : (t + 1) * BAND]:
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(h * f, at))
        keys[has, t] = key
    return keys


def wide_fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """A row of WIDE words of majority bits for each set of shingles."""
    h, counts = np.concatenate(sets) if sets else np.zeros(0, np.uint64), np.array([len(x) for x in sets], dtype=np.int64)
    seeds = np.arange(1, WIDE + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return np.stack([majority_bits(mix64(h ^ x), counts) for x in seeds], axis=1) if sets else np.zeros((0, WIDE), np.uint64)


def _signatures(words: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            nodes, keys, fps, counts, held, size = [], [], [], [], [], 0
            for text in batch.column("text"):
                held.append(shingle_set(text.as_buffer().to_pybytes(), words))
                nodes.append(_node(held[-1]))
                counts.append(len(held[-1]))
                size += len(held[-1])
                if size > 20_000:
                    keys.append(band_keys(held))
                    fps.append(wide_fingerprints(held))
                    held, size = [], 0
            keys.append(band_keys(held))
            fps.append(wide_fingerprints(held))
            packed = (pa.array([x.tobytes() for k in part for x in k], pa.binary()) for part in (keys, fps))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), *packed], ["id", "node", "n", "keys", "fp"])

    return run


def _bands(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        key = _words_of(batch.column("keys")).view(np.int64)
        n = len(key)
        t = np.tile(np.arange(BANDS, dtype=np.int32), n)
        yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(key.ravel()[: len(t)]), batch.column("node").take(pa.array(np.repeat(np.arange(n), BANDS)))], ["t", "key", "node"])


def _sets(words: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            own = [shingle_set(x.as_buffer().to_pybytes(), words) for x in batch.column("text")]
            same = [_node(x) == n for x, n in zip(own, batch.column("node").to_pylist(), strict=True)]  # an id can stand with other texts too
            out = batch.select(["met", "deals", "node", "fp"]).append_column("own", pa.array([x.tobytes() for x in own], pa.binary()))
            yield out.filter(pa.array(same, pa.bool_()))

    return run


def verified_groups(fps: np.ndarray, sets: list[np.ndarray], known: np.ndarray | None = None) -> np.ndarray:
    """Smallest place that each set is joined to by links of sets that are alike by exact count.

    The Gray-order index over their wide fingerprints finds the pairs to count; those joined already,
    also by equal `known` values, are left out.
    """
    n = len(sets)
    order = np.argsort(gray_rank(fps[:, 0]), kind="stable")
    sizes = np.array([len(sets[i]) for i in order], dtype=np.int64)
    ends = np.cumsum(sizes)
    _, shingle = np.unique(np.concatenate([sets[i] for i in order]) if n else np.zeros(0, np.uint64), return_inverse=True)
    mark = np.zeros(len(shingle) + 1, dtype=bool)
    label = np.arange(n)
    if known is not None:
        _, first, back = np.unique(known[order], return_index=True, return_inverse=True)
        label = first[back]

    def confirm(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        fits = (i < j) & alike(np.minimum(sizes[i], sizes[j]), sizes[i], sizes[j])
        i, j = i[fits], j[fits]
        if not len(i):
            return label
        by = np.argsort(i, kind="stable")
        i, j = i[by], j[by]
        cuts = np.flatnonzero(np.concatenate(([True], i[1:] != i[:-1])))
        for a, b in zip(cuts, np.append(cuts[1:], len(i)), strict=True):
            one, js = int(i[a]), j[a:b]
            js = js[label[js] != label[one]]
            if not len(js):
                continue
            if sizes[one]:  # of texts without words all are equal
                own = shingle[ends[one] - sizes[one] : ends[one]]
                mark[own] = True
                to = np.cumsum(sizes[js])
                hits = np.concatenate(([0], np.cumsum(mark[shingle[np.repeat(ends[js] - to, sizes[js]) + np.arange(to[-1])]])))
                mark[own] = False
                js = js[alike(hits[to] - hits[to - sizes[js]], sizes[js], sizes[one])]
            if len(js):
                label = settle(label, np.full(len(js), one), js)
        return label

    label = link_groups(fps[order], np.zeros(n, np.int64), FAR, label, confirm)
    out = np.empty(n, np.int64)
    out[order] = order[label]
    least = np.full(n, n)
    np.minimum.at(least, out, np.arange(n))
    return least[out]


def _verified(batches: Iterator) -> Iterator:
    """Rows sorted by group come in; (node, grp) of nodes that are linked go out."""
    import pyarrow as pa

    def settled(held: list[tuple]) -> Iterator:
        node = np.array([x[0] for x in held], dtype=np.int64)
        fps = np.frombuffer(b"".join(x[2] for x in held), np.uint64).reshape(len(held), -1)
        label = verified_groups(fps, [np.frombuffer(x[3], np.uint64) for x in held], np.array([x[1] for x in held], dtype=np.int64))
        at = np.flatnonzero(label != np.arange(len(held)))
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(node[at]), pa.array(node[label[at]])], ["node", "grp"])

    met, held = None, []
    for batch in batches:
        for m, *row in zip(*(batch.column(c).to_pylist() for c in ("met", "node", "known", "fp", "own")), strict=True):
            if m != met and held:
                yield from settled(held)
                held = []
            met = m
            held.append(tuple(row))
    if held:
        yield from settled(held)


def _compared(dealt: DataFrame) -> DataFrame:
    """(node, grp) of the links within each value of `met`, whose size the caller bounds; rows (met, node, known, fp, own)."""
    one = dealt.select("met", "node", "known", "fp", "own").repartition(parts(dealt.sparkSession), "met").sortWithinPartitions("met", "node")
    return cut(one.mapInArrow(released(_verified), "node long, grp long"))


def _large_groups(large: DataFrame) -> DataFrame:
    """(node, grp) of the links in groups too large for one task; rows (met, deals, node, fp, own).

    Members are dealt out, and some pivots of the group go to every deal.  What that
    doesn't join to the group's largest part is the rest: it is compared with all
    members, block by block, so that every pair but those joined already is looked at.
    """
    placed = large.withColumn("deal", F.pmod(F.xxhash64("node"), "deals"))
    every = lambda rows: rows.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)))
    chosen = large.groupBy("met", F.pmod(F.xxhash64("node", F.lit("pivot")), F.lit(PIVOTS)).alias("slot")).agg(F.min("node").alias("node")).select("node")
    first = placed.unionByName(every(large.join(chosen, "node", "left_semi"))).dropDuplicates(["deal", "node"])
    links = _compared(first.withColumn("met", F.xxhash64("met", "deal")).withColumn("known", F.col("node")))
    parts_of = connected_components(links.select(F.col("node").alias("a"), F.col("grp").alias("b")))
    own = cut(large.select("met", "node", "deals").join(parts_of, "node", "left").select("met", "deals", "node", F.coalesce("component", "node").alias("known")))
    sizes = own.groupBy("met", "known").agg(F.count("*").alias("n"))
    top = sizes.groupBy("met").agg(F.max_by("known", F.struct("n", "known")).alias("top"), F.sum("n").alias("n"), F.max("n").alias("joined"))
    blocks = top.where("n > joined").select("met", "top", F.ceil((F.col("n") - F.col("joined")) / GROUP).alias("blocks"))
    if blocks.isEmpty():
        return links
    marked = spread_join(own, blocks, ["met"]).select("node", "known", "blocks", (F.col("known") != F.col("top")).alias("rest"))
    rows = placed.drop("deal").join(marked, "node").withColumn("deal", F.pmod(F.xxhash64("node"), "deals"))
    asked = every(rows.where("rest").withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), "blocks")))
    answers = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    second = asked.unionByName(answers).dropDuplicates(["deal", "block", "node"])
    return links.unionByName(_compared(second.withColumn("met", F.xxhash64("met", "deal", "block"))))


def similar_groups(docs: DataFrame, words: int = WIDE_WORDS, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, component) for texts linked by a Jaccard similarity of 0.8 or more of their sets of word shingles.

    Texts with one set are a node with a fingerprint of 256 majority bits.  Nodes that share a band of
    their MinHash signature are dealt to one group; within it the Gray-order index over the
    fingerprints finds pairs, and each pair that isn't joined yet is counted exactly, so that only pairs of
    0.8 or more link.  Texts without words are one node.  Rows with a null id have no component.
    """
    bound_batches(docs.sparkSession)
    slim = docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text"))
    rows = cut(slim.mapInArrow(released(_signatures(words)), f"id {dict(slim.dtypes)['id']}, node long, n long, keys binary, fp binary"))
    nodes = cut(rows.where("id is not null").groupBy("node").agg(F.min("id").alias("id"), F.min("n").alias("n"), F.min("keys").alias("keys"), F.min("fp").alias("fp")))
    keyed = nodes.select("node", "keys").mapInArrow(released(_bands), "t int, key long, node long")
    shared = keyed.groupBy("t", "key").agg(F.min("node").alias("a"), F.count("*").alias("n")).where("n > 1").drop("n")
    links = spread_join(keyed, shared, ["key", "t"]).where("a <> node").select("a", F.col("node").alias("b")).distinct()
    found = connected_components(cut(links))
    grouped = cut(nodes.join(found.select("node", F.col("component").alias("met")), "node").select("met", "node", "id", "n", "fp"))
    deals = cut(grouped.groupBy("met").agg(F.greatest(F.ceil(F.count("*") / GROUP), F.ceil(8 * F.sum("n") / GROUP_BYTES), F.lit(1)).cast("long").alias("deals")))
    met = spread_join(grouped, deals, ["met"]).select("met", "deals", "node", "id", "fp")
    texts = sifted(slim.where("id is not null"), F.xxhash64("id"), grouped.select(F.xxhash64("id").alias("x")))
    sets = texts.join(met, "id").select("met", "deals", "node", "fp", "text").mapInArrow(released(_sets(words)), "met long, deals long, node long, fp binary, own binary").dropDuplicates(["node"])
    joined = _compared(sets.where("deals = 1").withColumn("known", F.col("node")))
    if not deals.where("deals > 1").isEmpty():
        joined = joined.unionByName(_large_groups(cut(sets.where("deals > 1"))))
    linked = connected_components(joined.select(F.col("node").alias("a"), F.col("grp").alias("b")))
    named = nodes.join(linked, "node", "left").select("node", "id", F.coalesce("component", "node").alias("grp"))
    least = named.groupBy("grp").agg(F.min("id").alias("component"))
    return rows.join(spread_join(named, least, ["grp"]).select("node", "component"), "node", "left").select("id", "component")


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows with the smallest id of their group of similar texts; equal rows of one id count once.

    Rows whose id is null have no place in the order: they all stay, equal texts once.
    """
    groups = similar_groups(docs.where(F.col(id_column).isNotNull()), text=text, id_column=id_column)
    keep = groups.where("id = component").select(F.col("id").alias("kept")).distinct()
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_column).alias("id"), F.md5(text_or_empty(text).cast("binary")).alias("digest"))
    once = lambda rows: rows.dropDuplicates(["id", "digest"])
    named = once(packed.where("id is not null").join(keep, F.col("id") == F.col("kept"), "left_semi"))  # the join has dealt the rows by id
    every = named.unionByName(once(packed.where("id is null")))
    return every.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def op5_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = near_duplicates(docs)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("component").alias("component_id"))
