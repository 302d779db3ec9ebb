"""Jaccard join of shingle sets through R-trees of count vectors.

A text's set holds the hashes (XXH64) of its distinct word shingles; equal sets are one node.  Two sets link when
100 * intersection >= percent * union, which leaves at most (100 - percent) / (100 + percent) * (|A| + |B|) members
that only one of them has.

Meeting.  Sizes fall into classes; in a class whose largest difference is T the range of hashes is cut into T + 1 equal
parts, so two sets that link agree on all members of one part at least.  A part's members make
a key, and nodes of one key are a bucket.  A smaller set is also keyed in the classes that a larger partner may be of.
Keys that one node has are dropped, as are buckets of the same nodes as another.

Searching.  The hashes are dealt into groups, about one for each four members; a set's counts by group are a point.  In a bucket
the points are packed into an R-tree, each entry with the largest count of each group below it and the smallest
set.  The sum of the smaller counts of two points, or of two entries, bounds the overlap of all sets below them: a pair of
entries that can't reach the similarity goes with all below it.

Verifying.  The pairs that are left are counted exactly.  As only components are asked for, the first round
proposes a spanning forest for each bucket (from the point nearest to the mean, then through the tree); the last proposes every
pair that isn't joined by then and hasn't been counted.  A bucket of one task whose proposals were all right is settled and
isn't searched again: they joined all that could link.  So no link is lost between components, and groups of
many near copies are not expanded into all pairs.

A bucket of over `BUCKET` nodes is dealt to many tasks, with common pivots; only such buckets have a second round of forests, as
in one task the forest would hardly differ. In the last round what isn't of its largest component meets every deal, in blocks.

Null and empty texts, and texts of white space only, have an empty set and link with nothing.  Texts with fewer words than a shingle are one
shingle.  Repeated rows link; a null id stays null and has the component of its text's other rows (null without any).
An empty table gives no rows.  Other columns are not read.  Two different hashes or nodes are told apart by 64 bits.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import ODD, bloom, may_hold, sifted
from .common import bound_batches, cut, cut_packed, mix64, parts, released, shared_path, spread_join, text_or_empty
from .components import connected_components
from .simhash import _node, settle, shingle_set

WORDS, PERCENT = 3, 90
#: Growth of the size classes, members to a group of the points, and the least number of groups.
GROWTH, MEMBERS, LEAST_GROUPS = 1.5, 4, 16
FAN, BUCKET, PIVOTS, CELLS, HELD = 16, 4_096, 8, 2_000_000, 16 << 20


def class_tops() -> np.ndarray:
    tops = [8]
    while tops[-1] < 1 << 31:
        tops.append(int(np.ceil(tops[-1] * GROWTH)))
    return np.array(tops, dtype=np.int64)


TOPS = class_tops()  # an array, as a cached function would travel to workers by name


def size_class(n: int) -> int:
    return int(np.searchsorted(TOPS, n))


def most_apart(total: int, percent: int) -> int:
    """Largest number of members that only one of two linked sets has, of sets of `total` members together."""
    return (100 - percent) * total // (100 + percent)


def groups_of(k: int) -> int:
    """Groups of the points that meet in class k: a power of two."""
    return max(LEAST_GROUPS, 1 << int(TOPS[k] // MEMBERS).bit_length())


def classes_of(n: int, percent: int) -> range:
    """Classes in which a set of n members may meet a partner of its size or larger, or a smaller one."""
    return range(size_class(n), size_class(100 * n // percent) + 1)


def part_keys(own: np.ndarray, percent: int) -> np.ndarray:
    """A key for each class and part; its low 6 bits are the class."""
    n = len(own)
    if most_apart(n + 100 * n // percent, percent) < 1:  # such sets link only when equal
        return np.zeros(0, np.uint64)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix64(own))))
    out = []
    for k in classes_of(n, percent):
        m = most_apart(2 * int(TOPS[k]), percent) + 1
        inner = np.array([(j << 64) // m for j in range(1, m)], dtype=np.uint64)
        at = np.concatenate(([0], np.searchsorted(own, inner), [n]))
        salt = mix64(np.arange(m, dtype=np.uint64) * ODD + np.uint64(k))
        out.append(mix64(sums[at[1:]] - sums[at[:-1]] + salt) & ~np.uint64(63) | np.uint64(k))
    return np.concatenate(out)


def point(own: np.ndarray, groups: int) -> np.ndarray:
    """Members by group; a group is a range of hashes, so that neighbouring groups add up to those of a coarser point."""
    return np.bincount((own >> np.uint64(64 - (groups.bit_length() - 1))).astype(np.int64), minlength=groups).astype(np.uint16)


def coarser(points: np.ndarray, groups: int) -> np.ndarray:
    return points.reshape(len(points), groups, -1).sum(axis=2, dtype=np.int64).astype(np.uint16)


def _rows(words: int, percent: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            known, nodes, counts, keys = {}, [], [], []
            for text in batch.column("text"):
                raw = text.as_buffer().to_pybytes()
                if raw not in known:  # copies in this batch
                    own = shingle_set(raw, words)
                    known[raw] = _node(own), len(own), part_keys(own, percent).tobytes()
                node, n, key = known[raw]
                nodes.append(node)
                counts.append(n)
                keys.append(key)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(nodes, pa.int64()), pa.array(counts, pa.int64()), pa.array(keys, pa.binary())], ["id", "node", "n", "keys"])

    return run


def _keyed(rows: DataFrame, held=None) -> DataFrame:
    """(key, node) of every row's keys, or of those that a filter may hold."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            raw = batch.column("keys").to_pylist()
            keys = np.frombuffer(b"".join(raw), dtype=np.uint64)
            nodes = np.repeat(batch.column("node").to_numpy(zero_copy_only=False), [len(x) // 8 for x in raw])
            keep = may_hold(held.value, keys) if held is not None else slice(None)
            yield pa.RecordBatch.from_arrays([pa.array(keys[keep].view(np.int64)), pa.array(nodes[keep])], ["key", "node"])

    return rows.select("node", "keys").mapInArrow(released(run), "key long, node long")


def buckets(rows: DataFrame) -> DataFrame:
    """(key, node): the nodes of every key that several have, once for each set of nodes."""
    ends = _keyed(rows).groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    several, _ = cut_packed(ends.where("a != b").select("key"))
    held = bloom(several.select(F.col("key").alias("x")))
    members, _ = cut_packed(spread_join(_keyed(rows, held).distinct(), several, ["key"]))
    held.unpersist()
    marks = members.groupBy("key").agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
    one = marks.groupBy("n", "x", "y", F.col("key").bitwiseAND(F.lit(63)).alias("cls")).agg(F.min("key").alias("key")).select("key")
    return cut_packed(spread_join(members, one, ["key"]))[0]


def _sets(words: int, percent: int):
    """The set of each text; a text's copies in one task have one row, those in several tasks one each."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen: set[int] = set()
        for batch in batches:
            sets = {}
            for text in batch.column("text"):
                own = shingle_set(text.as_buffer().to_pybytes(), words)
                node = _node(own)
                if node not in seen:
                    seen.add(node)
                    sets[node] = own
            points = [point(x, groups_of(classes_of(len(x), percent)[-1])).tobytes() for x in sets.values()]
            cols = [pa.array(list(sets), pa.int64()), pa.array([len(x) for x in sets.values()], pa.int64()), pa.array(points, pa.binary()), pa.array([x.tobytes() for x in sets.values()], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, ["node", "n", "point", "own"])

    return run


def _texts(slim: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of the wanted (id, node) and a few others, whose sets no bucket asks for or knows already."""
    return sifted(slim.where("id is not null"), F.xxhash64("id"), wanted.select(F.xxhash64("id").alias("x"))).select("text")


def overlap(points: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Sum of the smaller counts of each pair of rows."""
    out = np.empty(len(i), np.int64)
    step = max(1, CELLS // points.shape[1])
    for a in range(0, len(i), step):
        out[a : a + step] = np.minimum(points[i[a : a + step]], points[j[a : a + step]]).sum(axis=1, dtype=np.int64)
    return out


def reaches(common: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Whether an overlap allows the similarity to sets of `total` members together."""
    return (100 + percent) * common >= percent * total


def _levels(points: np.ndarray, sizes: np.ndarray, label: np.ndarray, group: np.ndarray) -> list[tuple]:
    """From leaves to roots: largest counts, smallest set, the label all below have (or -1), and the children's range."""
    n = len(points)
    levels = [(points, sizes, label, np.arange(n), np.arange(1, n + 1))]
    owner = group
    while True:
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        if len(first) == len(owner):
            return levels
        count = np.diff(np.append(first, len(owner)))
        nodes = -(-count // FAN)
        begin = np.repeat(first, nodes) + FAN * (np.arange(nodes.sum()) - np.repeat(np.cumsum(nodes) - nodes, nodes))
        end = np.minimum(begin + FAN, np.repeat(first + count, nodes))
        top, least, one = levels[-1][:3]
        low, high = np.minimum.reduceat(one, begin), np.maximum.reduceat(one, begin)
        levels.append((np.maximum.reduceat(top, begin, axis=0), np.minimum.reduceat(least, begin), np.where(low == high, low, -1), begin, end))
        owner = owner[begin]


def _forest(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs that join two labels, in order, so that no others would; and the labels after."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while x in up:
            x = up[x]
        return x

    keep = []
    for k, (a, b) in enumerate(zip(label[i].tolist(), label[j].tolist(), strict=True)):
        a, b = root(a), root(b)
        if a != b:
            up[max(a, b)] = min(a, b)
            keep.append(k)
    keep = np.array(keep, dtype=np.int64)
    return keep, settle(label, i[keep], j[keep])


def tree_pairs(points: np.ndarray, sizes: np.ndarray, group: np.ndarray, label: np.ndarray, node: np.ndarray, percent: int, every: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of one group whose bound reaches the similarity, with different labels.

    every: all of them; else a forest that joins what all of them would.
    """
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide = points.var(axis=0).argmax()
    order = np.lexsort((node, points[:, wide], sizes, group))
    points, sizes, group, node = points[order], sizes[order], group[order], node[order]
    _, code = np.unique(label[order], return_inverse=True)
    _, place, back = np.unique(group * (int(code.max()) + 1) + code, return_index=True, return_inverse=True)
    label = place[back]
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if not every:
        first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        count = np.diff(np.append(first, len(group)))
        rank = np.repeat(np.arange(len(first)), count)
        mean = np.add.reduceat(points.astype(np.float32), first, axis=0) / count[:, None]
        off = np.concatenate([np.abs(points[a : a + 4096] - mean[rank[a : a + 4096]]).sum(axis=1) for a in range(0, len(points), 4096)])
        pivot = np.lexsort((node, np.round(off, 3), group))[first]
        i, j = pivot[rank], np.arange(len(points))
        differ = label[i] != label[j]
        i, j = i[differ], j[differ]
        common, total = overlap(points, i, j), sizes[i] + sizes[j]
        fits = reaches(common, total, percent)
        i, j, likeness = i[fits], j[fits], (common[fits] / total[fits])
        best = np.lexsort((node[j], -likeness))  # the likeliest member of each label comes first
        keep, label = _forest(label, i[best], j[best])
        found.append((i[best][keep], j[best][keep]))
    levels = _levels(points, sizes, label, group)
    top = len(levels) - 1
    roots = np.arange(len(levels[top][0]))
    stack = [(top, roots[a : a + 10_000], roots[a : a + 10_000]) for a in range(0, len(roots), 10_000)] if top else []
    most = max(1, CELLS // points.shape[1])
    while stack:
        level, a, b = stack.pop()
        _, _, _, begin, end = levels[level]
        tops, least, one, _, _ = levels[level - 1]
        na, nb = end[a] - begin[a], end[b] - begin[b]
        total = na * nb
        cum = np.cumsum(total)
        x = 0
        while x < len(a):
            y = max(x + 1, int(np.searchsorted(cum, (cum[x - 1] if x else 0) + most, side="right")))
            t = total[x:y]
            k = np.arange(t.sum()) - np.repeat(np.cumsum(t) - t, t)
            wide_b = np.repeat(nb[x:y], t)
            i, j = np.repeat(begin[a[x:y]], t) + k // wide_b, np.repeat(begin[b[x:y]], t) + k % wide_b
            keep = ((i < j) & (label[i] != label[j])) if level == 1 else ((i <= j) & ~((one[i] == one[j]) & (one[i] >= 0)))
            i, j = i[keep], j[keep]
            keep = reaches(overlap(tops, i, j), least[i] + least[j], percent)
            i, j = i[keep], j[keep]
            if level > 1:
                stack.append((level - 1, i, j))
            elif every:
                found.append((i, j))
            elif len(i):
                keep, label = _forest(label, i, j)
                found.append((i[keep], j[keep]))
            x = y
    i, j = (np.concatenate(v) for v in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return order[i], order[j]


def _candidates(percent: int, every: bool):
    """Rows (cls, met, node, n, label, point) sorted by class and bucket come in; pairs of nodes go out."""

    def pairs(held: list[tuple], cls: int) -> Iterator:
        import pyarrow as pa

        groups = groups_of(cls)
        met, node, n, label = (np.concatenate([h[k] for h in held]) for k in range(4))
        width = np.array([len(p) // 2 for h in held for p in h[4]])
        points = np.empty((len(node), groups), np.uint16)
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            raw = [p for h in held for p in h[4]]
            points[at] = coarser(np.frombuffer(b"".join(raw[k] for k in at), np.uint16).reshape(-1, w), groups)
        _, group = np.unique(met, return_inverse=True)
        i, j = tree_pairs(points, n, group, label, node, percent, every)
        if len(i):
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(node[i], node[j])), pa.array(np.maximum(node[i], node[j]))], ["a", "b"])

    def run(batches: Iterator) -> Iterator:
        held, size, now = [], 0, (None, None)
        for batch in batches:
            cls, met = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("cls", "met"))
            if not len(cls):
                continue
            cols = [met, *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "n", "label"))]
            points = batch.column("point").to_pylist()
            edges = np.flatnonzero(np.concatenate(([True], (met[1:] != met[:-1]) | (cls[1:] != cls[:-1]))))
            for a, b in zip(edges, np.append(edges[1:], len(met)), strict=True):
                here = (int(cls[a]), int(met[a]))
                if held and here != now and (here[0] != now[0] or size > HELD):
                    yield from pairs(held, now[0])
                    held, size = [], 0
                now = here
                held.append((*(c[a:b] for c in cols), points[a:b]))
                size += 2 * groups_of(here[0]) * int(b - a)
        if held:
            yield from pairs(held, now[0])

    return run


def _searched(placed: DataFrame, points: DataFrame, percent: int, every: bool) -> DataFrame:
    """Pairs (a, b) that the trees of the placed rows (cls, met, node, label) propose."""
    rows = placed.join(points, "node").select("cls", "met", "node", "n", "label", "point")
    dealt = rows.repartition(parts(placed.sparkSession), "met").sortWithinPartitions("cls", "met", "node")
    return dealt.mapInArrow(released(_candidates(percent, every)), "a long, b long").distinct()


def _proposed(members: DataFrame, points: DataFrame, percent: int, every: bool, most: int = BUCKET) -> tuple[DataFrame, DataFrame]:
    """(pairs, keys) of the buckets (key, node, label): those of over `most` nodes are dealt to several tasks, and theirs are the keys."""
    cls = F.col("key").bitwiseAND(F.lit(63)).cast("int").alias("cls")
    size, n = cut_packed(members.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > most).select("key", F.ceil(F.col("n") / most).cast("long").alias("deals")))
    dealt = size.select("key")
    if not n:
        return _searched(members.select(cls, F.col("key").alias("met"), "node", "label"), points, percent, every), dealt
    sized = spread_join(members, size, ["key"], "left")
    small = sized.where("deals is null").select(cls, F.col("key").alias("met"), "node", "label")
    large = cut(sized.where("deals > 1").withColumn("deal", F.pmod(F.xxhash64("node"), "deals")))
    all_deals = lambda rows: rows.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)))
    if not every:
        chosen = large.groupBy("key", F.pmod(F.xxhash64("node", F.lit("pivot")), F.lit(PIVOTS)).alias("slot")).agg(F.min("node").alias("node")).select("key", "node")
        placed = large.unionByName(all_deals(spread_join(large, chosen, ["key", "node"]))).dropDuplicates(["key", "deal", "node"])
        met = F.xxhash64("key", "deal")
    else:
        tops = large.groupBy("key", "label").agg(F.count("*").alias("n")).groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("top"), F.sum("n").alias("n"), F.max("n").alias("joined"))
        blocks = tops.select("key", "top", F.ceil((F.col("n") - F.col("joined")) / most).cast("long").alias("blocks"))
        marked = spread_join(large, blocks, ["key"])
        asked = all_deals(marked.where("label != top")).withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), "blocks"))
        answers = marked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        placed = asked.unionByName(answers).dropDuplicates(["key", "deal", "block", "node"])
        met = F.xxhash64("key", "deal", "block")
    return _searched(small.unionByName(placed.select(cls, met.alias("met"), "node", "label")), points, percent, every).distinct(), dealt


def _alike(percent: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(batch.column("one"), batch.column("two"), strict=True)):
                one, two = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                if len(one) > len(two):
                    one, two = two, one
                at = np.minimum(np.searchsorted(two, one), len(two) - 1)
                common = int((two[at] == one).sum())
                keep[k] = 100 * common >= percent * (len(one) + len(two) - common)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    return run


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sets reach the similarity, counted exactly; only sets that stand in pairs are shuffled."""
    sets = sifted(sets.select("node", "own"), F.col("node"), pairs.select(F.explode(F.array("a", "b")).alias("x")))
    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("own").alias("one")), "a")
    both = one.join(sets.select(F.col("node").alias("b"), F.col("own").alias("two")), "b").select("a", "b", "one", "two")
    return both.mapInArrow(released(_alike(percent)), "a long, b long")


def _holding(met: DataFrame, pairs: DataFrame) -> DataFrame:
    """Keys of the buckets that hold both nodes of a pair."""
    one = spread_join(met.withColumnRenamed("node", "a"), pairs, ["a"])
    return spread_join(one.select("key", F.col("b").alias("node")), met, ["key", "node"]).select("key")


def similar_nodes(met: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame | None:
    """(node, component) of the nodes of buckets (key, node) that link; None where none do."""
    points, labelled = sets.select("node", "n", "point"), met.withColumn("label", F.col("node"))
    links = tried = named = large = None
    for every in (False, False, True):
        if large is None:
            members = labelled
        elif not (every or many):
            members = labelled.where("false")
        else:
            labelled, _ = cut_packed(labelled)
            open_keys = labelled.groupBy("key").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x != y").select("key")
            again = large
            if every and tried is not None:
                # in a bucket of one task the proposals joined all that could link, so it is settled if none of them failed
                wrong = tried if links is None else tried.join(links, ["a", "b"], "left_anti")
                again = _holding(met, wrong).unionByName(large).distinct()
            members, _ = cut_packed(spread_join(labelled, open_keys.join(again, "key"), ["key"]))
        pairs, dealt = _proposed(members, points, percent, every)
        if large is None:  # the first round sees every bucket
            large, many = dealt, not dealt.isEmpty()
        pairs, n = cut_packed(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
        if not n:
            continue
        tried = pairs if tried is None else tried.unionByName(pairs)
        good, n = cut_packed(verified(pairs, sets, percent))
        if not n:
            continue
        links = good if links is None else links.unionByName(good)
        named = connected_components(links, pack=True)
        labelled = met.join(named, "node", "left").select("key", "node", F.coalesce("component", "node").alias("label"))
    return named


def jaccard_groups(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, n, component) of every row: the size of its set and the smallest id reachable over links."""
    spark = docs.sparkSession
    bound_batches(spark)
    slim = docs.select(F.col(id_column).alias("id"), text_or_empty(text).alias("text"))
    kind, path = dict(slim.dtypes)["id"], shared_path(spark, "jaccard")
    slim.mapInArrow(released(_rows(words, percent)), f"id {kind}, node long, n long, keys binary").write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    reps = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("id"))
    met = buckets(rows.where("length(keys) > 0 AND id is not null"))
    wanted, _ = cut_packed(reps.join(met.select("node").distinct(), "node"))
    _texts(slim, wanted).mapInArrow(released(_sets(words, percent)), "node long, n long, point binary, own binary").write.parquet(f"{path}/sets")
    linked = similar_nodes(met, spark.read.parquet(f"{path}/sets"), percent)
    if linked is None:
        own = reps.select("node", F.col("id").alias("component"))
    else:
        named, _ = cut_packed(reps.join(linked, "node", "left").select("node", "id", F.coalesce("component", "node").alias("grp")))
        least = named.groupBy("grp").agg(F.min("id").alias("component"))
        own = spread_join(named, least, ["grp"]).select("node", "component")
    every = rows.select("node", "id", "n")
    joined = spread_join(every.where("n > 0"), own, ["node"]).select("id", "n", "component")
    return joined.unionByName(every.where("n = 0").select("id", "n", F.col("id").alias("component")))


def op11_jaccard(spark, sf_dir: str) -> DataFrame:
    """Set size and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_groups(docs).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


ORACLE_SQL = rf"""WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - {WORDS - 1}, least(len(w), 1)) + 1), lambda i: array_to_string(w[i:i + {WORDS - 1}], ' '))) AS s FROM words),
members AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common FROM members a JOIN members b ON a.x = b.x
  AND 100 * a.n >= {PERCENT} * b.n AND 100 * b.n >= {PERCENT} * a.n GROUP BY a.doc_id, b.doc_id),
links AS MATERIALIZED (SELECT a, b FROM met WHERE 100 * common >= {PERCENT} * (na + nb - common)),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(r.c, s.doc_id) AS component_id FROM sets s LEFT JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = s.doc_id"""
