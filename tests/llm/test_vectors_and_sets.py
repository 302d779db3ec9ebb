"""Jaccard join, clustering and whitening against brute force."""
import hashlib
import itertools
import re

import numpy as np
import pytest

from cairn.llm import count_tree, exponion, simhash, vectors, whitening

WORDS = [a + b for a in "ban cor del fim gor hul jas kep lom nur".split() for b in "ta re so vi mu".split()]


def rows(df):
    return [r.asDict() for r in df.collect()]


def shingles(text, words=3):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {" ".join(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set()


def brute_groups(texts, percent=90):
    """id -> (size of the set, component), comparing all pairs."""
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(sorted(sets), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
            a, b = find(i), find(j)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def near_copies(seed, n, length, edits, first=0):
    r = np.random.default_rng(seed)
    base = r.choice(WORDS, length).tolist()
    out = {}
    for k in range(n):
        w = list(base)
        for at in r.integers(0, length, r.integers(0, edits + 1)):
            w[at] = f"w{r.integers(0, 10**6)}"
        out[first + k] = " ".join(w)
    return out


def found(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, node string").repartition(3)
    return {r["id"]: (r["n"], r["component"]) for r in rows(count_tree.jaccard_groups(df, **kw))}


def test_op11(spark, sf_tiny, texts):
    want = brute_groups(texts)
    got = rows(count_tree.op11_jaccard(spark, sf_tiny))
    assert len(got) == len(texts) + 1
    assert all((r["n_shingles"], r["component_id"]) == want[r["doc_id"]] for r in got)
    assert want[21][1] == 20 and want[25] == (0, 25)


@pytest.mark.parametrize("percent", [90, 80, 60])
def test_near_copies_of_all_lengths(spark, percent):
    """Groups around the limit, chains among them, and texts of a few words, where one word more or less decides."""
    texts = {}
    for seed, (n, length, edits) in enumerate([(40, 12, 1), (40, 14, 2), (30, 40, 2), (30, 120, 6), (20, 400, 20), (6, 5, 1)]):
        texts |= near_copies(seed, n, length, edits, first=1000 * seed)
    texts |= {9000: "a b", 9001: "A  b", 9002: "a\nb\n", 9003: "a b c", 9004: None, 9005: " \t "}
    texts |= {9100 + k: " ".join(f"q{i}" for i in range(k, k + 60)) for k in range(0, 30)}
    assert found(spark, texts, percent=percent) == brute_groups(texts, percent)


@pytest.mark.parametrize("most", [8, 40])
def test_large_buckets_are_dealt_without_losing_links(spark, monkeypatch, most):
    monkeypatch.setattr(count_tree._proposed, "__defaults__", (most,))
    texts = near_copies(3, 70, 100, 8) | near_copies(4, 60, 30, 3, first=500)
    assert found(spark, texts) == brute_groups(texts)


def test_settled_buckets_and_sets_without_pairs_are_left_alone(spark, monkeypatch):
    own = {n: np.arange(100, dtype=np.uint64) * np.uint64(1 << 57) + np.uint64(n) for n in (3, 4)}
    own[1] = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 100).astype(np.uint64) * np.uint64(2))
    own[2] = np.sort(np.append(own[1][:-1], np.uint64(5)))
    own[4] = own[4] >> np.uint64(1)
    cls = count_tree.size_class(100)
    sets = spark.createDataFrame([(n, len(x), bytearray(count_tree.point(x, count_tree.groups_of(count_tree.classes_of(100, 90)[-1])).tobytes()), bytearray(x.tobytes())) for n, x in own.items()], "node long, n long, point binary, own binary")
    met = spark.createDataFrame([(64 | cls, 1), (64 | cls, 2), (128 | cls, 3), (128 | cls, 4), (192 | cls, 1), (192 | cls, 3)], "key long, node long")
    searched, counted, propose, sift = [], [], count_tree._proposed, count_tree.sifted
    monkeypatch.setattr(count_tree, "_proposed", lambda members, *rest: searched.append(members.count()) or propose(members, *rest))
    monkeypatch.setattr(count_tree, "sifted", lambda *of: counted.append(sift(*of)) or counted[-1])
    assert {r["node"]: r["component"] for r in rows(count_tree.similar_nodes(met, sets))} == {1: 1, 2: 1}
    assert searched == [6, 0, 0] and [x.count() for x in counted] == [2]


def test_a_pair_that_fails_is_searched_once_more_and_small_results_fill_few_partitions(spark, monkeypatch):
    """Node 5 shares a bucket with 1 by its counts alone, so the bucket isn't settled; no bucket is dealt to many tasks."""
    r = np.random.default_rng(4)
    own = {1: np.sort(r.integers(0, 1 << 63, 100).astype(np.uint64) * np.uint64(2))}
    own[2], own[5] = np.sort(np.append(own[1][:-1], np.uint64(5))), own[1] + np.uint64(1)
    cls = count_tree.size_class(100)
    sets = spark.createDataFrame([(n, len(x), bytearray(count_tree.point(x, count_tree.groups_of(count_tree.classes_of(100, 90)[-1])).tobytes()), bytearray(x.tobytes())) for n, x in own.items()], "node long, n long, point binary, own binary")
    met = spark.createDataFrame([(64 | cls, n) for n in own], "key long, node long")
    searched, propose = [], count_tree._proposed
    monkeypatch.setattr(count_tree, "_proposed", lambda members, *rest: searched.append(members.count()) or propose(members, *rest))
    assert {r["node"]: r["component"] for r in rows(count_tree.similar_nodes(met, sets))} == {1: 1, 2: 1}
    assert searched == [3, 0, 3]
    keys = spark.createDataFrame([(n, bytearray(np.arange(64, 1000, 64, dtype=np.uint64).tobytes())) for n in range(9)], "node long, keys binary")
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        for k, v in zip(before, ("40", "false"), strict=True):
            spark.conf.set(k, v)
        assert count_tree.buckets(keys).rdd.getNumPartitions() == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_texts_reach_their_sets_without_a_shuffle(spark):
    texts = near_copies(2, 9, 20, 2)
    slim = spark.createDataFrame(list(texts.items()), "id long, text string").repartition(3)
    found = count_tree._texts(slim, slim.where("id < 4").selectExpr("id", "id as node"))
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert {texts[k] for k in range(4)} <= {r["text"] for r in rows(found)}


def test_an_id_with_several_texts_of_one_set(spark):
    texts = [*near_copies(9, 6, 60, 2).items(), *((i, t.upper()) for i, t in near_copies(9, 6, 60, 2).items()), (3, "quite another text")]
    got = rows(count_tree.jaccard_groups(spark.createDataFrame(texts, "doc_id long, text string").repartition(3)))
    want = brute_groups(dict(texts[:6]))
    assert sorted((r["id"], r["n"], r["component"]) for r in got) == sorted([(i, *want[i]) for i in want] * 2 + [(3, 1, 3)])


def test_a_long_text_and_null_ids(spark):
    long = " ".join(f"t{i}" for i in range(60_000))
    texts = [(1, long), (2, long.replace("t100 ", "u ")), (3, long[: len(long) // 2]), (None, long), (None, "only here"), (4, "only there")]
    df = spark.createDataFrame(texts, "doc_id long, text string")
    got = sorted(map(str, ((r["id"], r["n"], r["component"]) for r in rows(count_tree.jaccard_groups(df)))))
    assert got == sorted(map(str, [(1, 59_998, 1), (2, 59_998, 1), (3, len(shingles(texts[2][1])), 3), (None, 59_998, 1), (None, 1, None), (4, 1, 4)]))


def test_sets_that_link_share_a_key():
    r = np.random.default_rng(2)
    for n in [9, 10, 11, 18, 19, 20, 50, 300, 2000]:
        for _ in range(40):
            own = np.unique(r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, n, dtype=np.uint64))
            gone = r.integers(0, n // 10 + 1)
            other = np.unique(np.concatenate((own[gone:], r.integers(0, 1 << 63, r.integers(0, n // 10 + 1), dtype=np.uint64))))
            common = len(np.intersect1d(own, other))
            if len(own) != common and 100 * common >= 90 * (len(own) + len(other) - common):
                assert set(count_tree.part_keys(own, 90)) & set(count_tree.part_keys(other, 90))


@pytest.mark.parametrize("every", [True, False])
def test_tree_proposes_what_the_bound_allows(every):
    r = np.random.default_rng(9)
    base = r.poisson(4, (12, 32))
    points = np.concatenate([np.maximum(base + r.integers(-1, 2, base.shape) * (r.random(base.shape) < 0.15), 0) for _ in range(25)]).astype(np.uint16)
    sizes, group, node = points.sum(axis=1).astype(np.int64), r.integers(0, 3, len(points)), r.permutation(len(points))
    label = np.where(r.random(len(points)) < 0.3, 1, node + 10)
    i, j = count_tree.tree_pairs(points, sizes, group, label, node, 90, every)
    a, b = np.triu_indices(len(points), 1)
    common = np.minimum(points[a], points[b]).sum(axis=1, dtype=np.int64)
    ok = (group[a] == group[b]) & (label[a] != label[b]) & (190 * common >= 90 * (sizes[a] + sizes[b]))
    want, got = set(zip(a[ok], b[ok])), set(zip(np.minimum(i, j), np.maximum(i, j)))
    assert want and (got == want if every else got < want)
    code = group * 10**6 + label
    start = np.unique(code, return_inverse=True)[1]
    for pairs in (want, got):
        lab = simhash.settle(np.arange(start.max() + 1), *(start[np.array(v)] for v in zip(*pairs)))
        joined = lab if pairs is want else joined == lab
    assert joined.all()


def kept_vectors(table, most):
    ok = lambda x: x is not None and np.isfinite(x) and abs(x) <= most
    return [(i, np.array(v, dtype=np.float32).astype(np.float64)) for i, v, *_ in table if v is not None and len(v) == 64 and all(map(ok, v))]


def test_op12(spark, sf_tiny, vector_table):
    kept = [(i, np.floor(256 * v).astype(int).tolist()) for i, v in kept_vectors(vector_table, exponion.MOST / 256)]
    start = sorted((hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:40]
    c = [v for _, v in start]
    d2 = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    assign = lambda: [min(range(40), key=lambda k: (d2(v, c[k]), k)) for _, v in kept]
    for _ in range(5):
        at = assign()
        for k in set(at):
            mine = [v for (_, v), a in zip(kept, at, strict=True) if a == k]
            c[k] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    at = assign()
    dist = [d2(v, c[k]) for (_, v), k in zip(kept, at, strict=True)]
    want = [(i, k, d, sum(e for e, b in zip(dist, at, strict=True) if b == k), sum(dist), hashlib.sha256(",".join(map(str, c[k])).encode()).hexdigest()) for (i, _), k, d in zip(kept, at, dist, strict=True)]
    got = [tuple(r.values()) for r in rows(exponion.op12_clusters(spark, sf_tiny).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"))]
    assert sorted(got, key=str) == sorted(want, key=str) and len(got) == 93


@pytest.mark.parametrize(("dim", "size"), [(4, 6), (8, 1000), (8, 1 << 26)])
def test_exponion_search_is_exact(dim, size):
    """Few distinct values make many ties, repeated centroids among them; large values leave the exact range of doubles."""
    r = np.random.default_rng(dim)
    x, c = r.integers(-size, size + 1, (3000, dim)), r.integers(-size, size + 1, (40, dim))
    c[7], c[23] = c[31], c[2]
    if size == 1000:  # vectors near to their centroids
        x = c[r.integers(0, 40, 3000)] + r.integers(-60, 61, (3000, dim))
    d = np.array([[sum((a - b) ** 2 for a, b in zip(v, w, strict=True)) for w in c.tolist()] for v in x.tolist()])
    to, least, low, seen = exponion.search(x, r.integers(0, 40, len(x)) if size == 6 else d.argsort(axis=1)[:, 0 if size == 1000 else 1], exponion.Neighbours(c))
    assert (to == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
    second = np.sqrt(np.sort(d, axis=1)[:, 1].astype(float))
    assert (low <= second).all() and (low >= second * (1 - 1e-9)).all()
    if size == 1000:
        assert seen < d.size / 4


def test_few_vectors_and_other_lengths(spark):
    df = spark.createDataFrame([(1, [0.0, 1.0]), (2, [4.0, 4.0]), (3, [1.0])], "vec_id long, embedding array<double>")
    out, c = exponion.clusters(df, k=5, dim=2)
    assert {(r["id"], r["distance"]) for r in rows(out)} == {(1, 0), (2, 0)} and len(c) == 2


def test_op13(spark, sf_tiny, vector_table):
    kept = kept_vectors(vector_table, whitening.MOST)
    x = np.floor(1024 * np.array([v for _, v in kept])).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    mean = s / n
    v = (x - mean).T @ (x - mean) / n
    e, u = np.linalg.eigh(v)
    got = rows(whitening.op13_whitening(spark, sf_tiny))
    assert len(got) == 8 * n and {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-9
    at = lambda i: -1 if i is None else i
    sign, by = {}, {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    for k in range(8):
        w = (x - mean) @ u[:, -1 - k] / np.sqrt(e[-1 - k])
        mine = sorted((at(r["vec_id"]), abs(r["whitened"])) for r in by[k + 1])
        assert np.allclose([a for _, a in mine], [a for _, a in sorted((at(i), abs(b)) for (i, _), b in zip(kept, w, strict=True))], atol=1e-8)
        assert abs(by[k + 1][0]["explained"] - e[-1 - k] / np.trace(v)) < 1e-12
        sign[k] = {r["vec_id"]: r["whitened"] for r in by[k + 1] if r["vec_id"] not in (8, None)}
        assert abs(sum(sign[k][i] * dict((j, b) for (j, _), b in zip(kept, w, strict=True))[i] for i in sign[k])) > 0.9 * (n - 4) - 30
    gap = {at(i): sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s, strict=True)) for (i, _), row in zip(kept, x, strict=True) if i != 8}
    assert all(r["deviation"] == gap[at(r["vec_id"])] == int(r["deviation_digits"]) for r in got if r["vec_id"] != 8)


def test_whitening_of_flat_and_huge_vectors(spark):
    df = spark.createDataFrame([(i, [float(i % 2), 3.0, float(i % 2) * 2]) for i in range(6)], "vec_id long, embedding array<double>")
    got = {(r["id"], r["component"]): r for r in rows(whitening.whiten(df))}
    assert len(got) == 18 and abs(got[0, 1]["whitened"] + 1) < 1e-12 and got[0, 2]["whitened"] is None and got[0, 1]["identity_error"] < 1e-12
    one = rows(whitening.whiten(df.where("vec_id = 1")))
    assert [(r["whitened"], r["explained"], r["identity_error"], int(r["deviation"])) for r in one] == [(None, None, None, 0)] * 3
    r = np.random.default_rng(1)
    big = r.integers(-(1 << 52), 1 << 52, (50, 3))
    df = spark.createDataFrame([(i, [float(a) / 1024 for a in v]) for i, v in enumerate(big.tolist())], "vec_id long, embedding array<double>")
    n, s = 50, (big + 100_000).astype(object).sum(axis=0)
    want = {i: sum((n * (int(a) + 100_000) - b) ** 2 for a, b in zip(v, s, strict=True)) for i, v in enumerate(big)}
    assert {r["id"]: int(r["deviation"]) for r in rows(whitening.whiten(df))} == want


def test_whole_sums():
    x = np.array([[(1 << 53) - 1, -5], [(1 << 53) - 3, -(1 << 53)]] * 2000)
    assert vectors.whole_sums(x) == [sum(map(int, c)) for c in x.T]
