"""The operators against brute force on small tables with nulls, empty and repeated texts, and extra columns."""
import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cairn.llm import chat, decontaminate, fingerprint, packing, queries, sharding, simhash, suffix_dedup, toxicity, warc


def rows(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", sorted(queries.MODULES))
def test_empty_tables(spark, sf_empty, name):
    assert queries.queries()[name](spark, sf_empty).count() == (1 if name == "op4_chat" else 0)


def pieces_by_hand(text):
    """The module's description carried out byte by byte in whole numbers: rolling hash of the last seven bytes, cuts, a letter for each piece."""
    m, raw = 1 << 64, text.encode()
    a, b = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F

    def mixed(x):
        x = ((x ^ x >> 31) * 0x7FB5D329728EA185) % m
        x = ((x ^ x >> 27) * 0x81DADEF4BC2DD44D) % m
        return x ^ x >> 33

    hashed = lambda part, base: mixed((sum((c + 1) * pow(base, i, m) for i, c in enumerate(part)) + len(part)) % m)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    if not raw:
        return "3::"
    rolls = [hashed(raw[max(0, k - 6) : k + 1], a) >> 16 for k in range(len(raw))]
    ends = lambda size: [k + 1 for k, r in enumerate(rolls) if r % size == size - 1]

    def line(size):
        cuts = [0, *ends(size)[:63]]
        cuts += [len(raw)] if cuts[-1] < len(raw) else []
        return "".join(letters[hashed(raw[x:y], b) >> 58] for x, y in zip(cuts, cuts[1:]))

    size = 3
    while size * 64 < len(raw):
        size *= 2
    while size > 3 and len(ends(size)) + 1 < 16:
        size //= 2
    return f"{size}:{line(size)}:{line(2 * size)}"


def likeness_by_hand(x, y):
    if x == y:
        return 1.0

    def alike(p, q):
        runs = lambda s: {s[i : i + 4] for i in range(len(s) - 3)}
        if not p or not q or (min(len(p), len(q)) >= 4 and not runs(p) & runs(q)):
            return 0.0
        row = list(range(len(q) + 1))
        for i, c in enumerate(p, 1):
            new = [i]
            for j, d in enumerate(q, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return 1 - row[-1] / max(len(p), len(q))

    both = [{int(s): p, 2 * int(s): q} for s, p, q in (v.split(":") for v in (x, y))]
    return max((alike(both[0][k], both[1][k]) for k in set(both[0]) & set(both[1])), default=0.0)


def test_op1_against_whole_numbers(spark, sf_tiny, texts):
    order = sorted([*texts, 20], reverse=True)
    got = {r["doc_id"]: r for r in rows(fingerprint.op1_fingerprint(spark, sf_tiny))}
    for k, i in enumerate(order):
        t, n = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        h = len(t) // 2
        own, edited, after = map(pieces_by_hand, (t, t[: len(t) - h] + n[:h], n))
        assert got[i]["fingerprint"] == own
        if i != 20:
            assert got[i]["edited_fingerprint"] == edited
            assert abs(got[i]["near_edited"] - likeness_by_hand(own, edited)) < 1e-9 and abs(got[i]["near_next"] - likeness_by_hand(own, after)) < 1e-9


def test_op1_of_a_text_over_several_batches(spark, tmp_path):
    long = "".join(chr(97 + (i * i // 7 + i // 11) % 26) for i in range(60_000))
    assert fingerprint.fingerprint(long) == pieces_by_hand(long)
    docs = spark.createDataFrame([(1, long * 40), (2, "short")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in rows(fingerprint.op1_fingerprint(spark, str(tmp_path)))}
    assert got[1]["n_chars"] == 2_400_000 and got[1]["fingerprint"] == fingerprint.fingerprint(long * 40) and got[2]["fingerprint"] == pieces_by_hand("short")


def test_op10_items_of_any_id(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in texts.items()], "doc_id long, text string")
    items = spark.createDataFrame([("first", texts[31]), ("other", "nothing of the kind stands anywhere in these texts")], "item_id string, text string")
    assert {(r["doc_id"], r["item_id"]) for r in rows(decontaminate.contaminated(docs, items))} >= {(31, "first")}


def test_op1(spark, sf_tiny, texts):
    order = sorted([*texts, 20], reverse=True)
    got = {(r["doc_id"]): r for r in rows(fingerprint.op1_fingerprint(spark, sf_tiny))}
    for k, i in enumerate(order):
        if i == 20 and k and order[k - 1] != 20:
            continue  # the repeated row's first copy is followed by its second
        t, n = texts[i] or "", texts[order[(k + 1) % len(order)]] or ""
        h = len(t) // 2
        e = t[: len(t) - h] + n[:h]
        if i != 20:
            assert got[i]["edited_sha256"] == hashlib.sha256(e.encode()).hexdigest()
            assert got[i]["edited_fingerprint"] == fingerprint.fingerprint(e)
        assert (got[i]["n_chars"], got[i]["fingerprint"]) == (len(t), fingerprint.fingerprint(t))
    assert got[21]["near_next"] == 1.0 and got[26]["near_next"] == 1.0 and got[27]["near_next"] == 0.0
    assert got[22]["near_next"] > 0.6 and got[15]["near_next"] == 0.0 and got[15]["near_edited"] > 0.25


def test_op2(spark, sf_tiny, texts):
    got = rows(sharding.op2_sharding(spark, sf_tiny))
    assert len(got) == len(texts) + 1 and all(0 <= r["shard"] < 24 for r in got)
    slots = defaultdict(list)
    for r in got:
        raw = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({r["shard"] for r in got if r["doc_id"] in (20, 21)}) == 1
    sizes = np.array([5, 1, 9, 2, 2, 7, 3])
    best = min(max(sum(p) for p in np.split(sizes, [a, b])) for a in range(8) for b in range(a, 8))
    cuts = sharding.minimax_cuts(sizes, 3)
    assert max(sum(p) for p in np.split(sizes, cuts[1:])) == best


@pytest.mark.parametrize("seed", range(4))
def test_trees_and_isotonic(seed):
    r = np.random.default_rng(seed)
    x = r.normal(size=(600, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)
    model = toxicity.Trees().fit(x[:400], y[:400])
    assert ((model.raw(x[400:]) > 0) == y[400:]).mean() > 0.9
    at, level = toxicity.isotonic(x[:, 0], y)
    assert (np.diff(level) > 0).all() and (np.diff(at) > 0).all()


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    n1 = label.sum()
    return (rank[label == 1].sum() - n1 * (n1 - 1) / 2) / (n1 * (len(label) - n1))


@pytest.mark.parametrize(("name", "label", "least"), [("op3_toxicity", "toxic", 0.85), ("op6_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    got = queries.queries()[name](spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert auc(got["score"].to_numpy(), got[label].to_numpy()) >= least


@pytest.mark.parametrize("name", ["op3_toxicity", "op6_quality"])
def test_scores_of_odd_texts(spark, sf_tiny, texts, name):
    got = rows(queries.queries()[name](spark, sf_tiny))
    assert len(got) == len(texts) + 1 and all(0 <= r["score"] <= 1 for r in got)
    m = 3 if name == "op3_toxicity" else 5
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % m == (1 if m == 3 else 0)) for r in got)


def test_op4(spark, sf_tiny):
    conv = defaultdict(list)
    for r in spark.read.parquet(f"{sf_tiny}/conversations.parquet").collect() + [type("R", (), {})]:
        if hasattr(r, "conv_id"):
            conv[r.conv_id].append((r.turn, r.role or "", r.text or ""))
    for c, n, role, text in chat.EXTRA:
        conv[c].append((n, role, text))
    got = {r["conv_id"]: r for r in rows(chat.op4_chat(spark, sf_tiny))}
    assert set(got) == set(conv)
    for c, turns in conv.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        want = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), True)
        assert tuple(got[c][k] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "identical")) == want


def test_op4_mask(spark):
    turns = spark.createDataFrame([(1, 0, "assistant", "x</turn>\ny"), (1, 1, "user", "q"), (1, 2, "assistant", "z")], "conv_id long, turn long, role string, text string")
    r = chat.read_back(chat.format_conversations(turns)).first()
    parts = [r.formatted[m.start : m.start + m.length] for m in r.loss_mask]
    assert parts == ["x\\l/turn\\g\\ny", "z"] and r.identical


def test_op5(spark, sf_tiny, texts):
    import xxhash

    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    fps = {}
    for i, t in texts.items():
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(low))
        s = [" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
        fps[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    root = {i: i for i in fps}
    for _ in fps:
        for i in fps:
            for j in fps:
                if (fps[i] ^ fps[j]).bit_count() <= 4:
                    root[i] = root[j] = min(root[i], root[j])
    got = rows(simhash.op5_simhash(spark, sf_tiny))
    assert len(got) == len(texts) + 1
    assert all((int(r["fingerprint"], 16), r["component_id"]) == (fps[r["doc_id"]], root[r["doc_id"]]) for r in got)


@pytest.mark.parametrize("width", [1, 3])
def test_gray_index_finds_every_link(width):
    r = np.random.default_rng(5)
    base = r.integers(0, 1 << 63, size=(40, width), dtype=np.uint64)
    fps = np.concatenate([base ^ (np.uint64(1) << r.integers(0, 63, size=(40, width), dtype=np.uint64)) for _ in range(30)])
    group = np.sort(r.integers(0, 7, size=len(fps)))
    order = np.lexsort((simhash.gray_rank(fps[:, 0]), group))
    fps = fps[order]
    got = simhash.link_groups(fps, group, 4)
    apart = np.bitwise_count(fps[:, None, :] ^ fps[None, :, :]).sum(axis=2)
    want = np.arange(len(fps))
    i, j = np.nonzero((apart <= 4) & (group[:, None] == group[None, :]))
    want = simhash.settle(want, i, j)
    assert (got == want).all()


def test_op5_splits_large_keys(spark, monkeypatch):
    r = np.random.default_rng(1)
    n = 6000  # all fingerprints share their low blocks, so every key is large
    fps = (r.integers(0, 1 << 20, size=n, dtype=np.uint64) << np.uint64(40)).astype(np.int64)
    fps = np.unique(fps)
    nodes = spark.createDataFrame([(int(i), int(f)) for i, f in enumerate(fps)], "node long, fp long")
    got = {r["node"]: r["component"] for r in rows(simhash.linked_components(nodes, 2))}
    label, u = np.arange(len(fps)), fps.view(np.uint64)
    for i in range(len(u)):
        j = np.flatnonzero(np.bitwise_count(u[i] ^ u) <= 2)
        label = simhash.settle(label, np.full(len(j), i), j)
    assert all(got.get(i, i) == label[i] for i in range(len(u)))


def test_op7(spark, sf_tiny, texts):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(packing.tokenizer_path())
    got = rows(packing.op7_packing(spark, sf_tiny))
    want = []
    for i in [*texts, 20]:
        ids = np.array([*tok.encode(texts[i] or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want += [(i, p, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for p, a in enumerate(range(0, len(ids), 2048))]
    assert sorted(tuple(r[k] for k in ("doc_id", "piece", "start", "length", "ids_crc32")) for r in got) == sorted(want)
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        assert sum(n for _, n in b) <= 2048 and all(o == sum(n for p, n in b if p < o) for o, _ in b)
    assert len(bins) == -(-sum(w[3] for w in want) // 2048)


def test_op7_tokens_of_odd_texts():
    from tokenizers import Tokenizer

    tok, own = Tokenizer.from_file(packing.tokenizer_path()), packing.WordTokens(packing.tokenizer_path())
    odd = ["İstanbul ΣΑΣ ﬁ é it's I'LL <|endoftext|> a b ẞ 1234 ½ ①", "", " \x1c a", "a\x85b c", "don't%%% x,y.z 'S", "é é á,"]
    assert own.packed(odd) == [np.array(tok.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in odd]


def test_op7_rounds(spark):
    r = np.random.default_rng(3)
    items = spark.createDataFrame([(i, 0, 0, int(n), 0) for i, n in enumerate(r.integers(1, 101, 4000))], "doc_id long, piece int, start long, length long, ids_crc32 long")
    bins = rows(packing.pack(items, capacity=100, fan_in=4, per_task=4000))  # a task takes 1000 items at first
    assert sorted(x["doc_id"] for b in bins for x in b["items"]) == list(range(4000))
    assert all(sum(x["length"] for x in b["items"]) == b["fill"] <= 100 for b in bins)
    at_once = packing.best_fit(np.array([x["length"] for b in bins for x in b["items"]]), 100).max() + 1
    assert len(bins) <= 1.02 * at_once


def brute_repeats(raw, length):
    count = Counter(b[i : i + length] for _, b in raw for i in range(len(b) - length + 1))
    return [(k, [(i, i + length) for i in range(len(b) - length + 1) if count[b[i : i + length]] > 1], b) for k, b in raw]


@pytest.mark.parametrize(("hot", "parts"), [(20_000, 1), (20_000, 2), (20_000, 7), (1, 4)])
def test_op8(spark, sf_tiny, texts, hot, parts, monkeypatch):
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (*suffix_dedup.repeated_spans.__defaults__[:-1], hot))
    monkeypatch.setattr(suffix_dedup, "parts", lambda _: parts)
    got = rows(suffix_dedup.op8_suffix_dedup(spark, sf_tiny))
    raw = [(i, (texts[i] or "").encode()) for i in [*texts, 20]]
    want = {}
    for i, spans, b in brute_repeats(raw, 400):
        kept, gone, n = suffix_dedup.keep_bytes(b, spans)
        want[i] = (len(b), gone, n, hashlib.sha256(kept).hexdigest(), len(b) - gone, len(kept.decode("utf-8", "ignore")), int(gone > 0))
    assert len(got) == len(raw) and want[23][1] > 0 and want[29][1] == 900
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes", "kept_chars", "has_repeats")
    assert all(tuple(r[k] for k in names) == want[r["doc_id"]] for r in got)


def test_op8_passages_by_words(spark):
    """Passages of 51 words that other documents have too, of fewer bytes than the strings that go, against all windows."""
    r = np.random.default_rng(8)
    some = lambda n: [f"{x:x}" for x in r.integers(0, 1 << 20, n)]
    a, b, c, d, e = some(51), some(50), some(51), some(60), some(300)
    t = {1: some(90) + a + some(7), 2: a + some(300), 3: some(20) + b + some(80), 4: b + some(30), 5: some(9) + c + some(30) + c, 6: d, 7: d, 8: d[:50], 9: some(50), 10: e + some(40), 11: some(5) + e + some(66) + d[4:55]}
    t |= {12: some(3) + ["w"] * 70, 13: ["w"] * 51 + some(40), 14: ["w"] * 50 + some(40), 15: some(60)}
    text = {k: " ".join(x) for k, x in t.items()}
    text[2], text[16], text[17], text[18] = "\n\t ".join(t[2]), "\u4e2d" * 20 + "\u6587" * 31, "x " + "\u4e2d\n" * 20 + "\u6587" * 31, None
    given = [*text.items(), (15, text[15])]  # a row twice is one document
    docs = spark.createDataFrame(given, "doc_id long, text string").repartition(4)
    got = rows(suffix_dedup.remove_repeats(docs, passage=51))
    seen = {}
    for k, x in text.items():
        words = suffix_dedup._WORD.findall(x or "")
        for i in range(len(words) - 50):
            seen.setdefault(tuple(words[i : i + 51]), set()).add(k)
    want = {k for ids in seen.values() if len(ids) > 1 for k in ids}
    assert want == {1, 2, 6, 7, 10, 11, 12, 13, 16, 17} and len(got) == len(given)
    lost = {x["doc_id"] for x in got if x["has_repeats"]}
    assert {10, 11} <= lost and not lost & {1, 2, 6, 7, 12, 13, 16, 17}
    assert {x["doc_id"] for x in got if x["repeats_passage"]} == want | lost
    assert "repeats_passage" not in suffix_dedup.remove_repeats(docs).columns


def test_op8_long_text(spark):
    """A text of many pieces with repeats inside it and across the borders of pieces."""
    r = np.random.default_rng(4)
    line = lambda n: bytes(r.integers(97, 123, n, dtype=np.uint8))
    passage, size = line(1_000), suffix_dedup.CHUNK
    long = line(size - 500) + passage + line(3 * size) + passage + line(9 * size - 1)
    docs = spark.createDataFrame([(1, long.decode()), (2, (line(700) + passage[:600] + line(700)).decode()), (3, passage[:399].decode())], "doc_id long, text string")
    got = {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"]) for x in rows(suffix_dedup.remove_repeats(docs))}
    assert got == {1: (len(long), 2_000, 2), 2: (2_000, 600, 1), 3: (399, 0, 0)}


@pytest.mark.parametrize("few", [1, 3, 24])
@pytest.mark.parametrize("letters", [2, 3, 20])
def test_op8_suffixes(few, letters, monkeypatch):
    """Reach of repeated windows around anchors against all pairs of suffixes."""
    monkeypatch.setattr(suffix_dedup, "FEW", few)
    r, length, gram = np.random.default_rng(few + letters), 40, 10
    heads, sides = [r.integers(0, letters, gram) for _ in range(3)], [r.integers(0, letters, 30) for _ in range(5)]
    segs, left = [], []
    for _ in range(160):
        a, b = int(r.integers(0, 31)), int(r.integers(0, 31))
        before, after = (np.array(sides[r.integers(0, 5)]) for _ in range(2))
        for x in (before, after):
            if r.random() < 0.7:
                x[r.integers(0, 30)] = r.integers(0, letters)
        segs.append(np.concatenate((before[30 - a :], heads[r.integers(0, 3)], after[:b])).astype(np.uint8))
        left.append(a)
    left, size = np.array(left), np.array([len(x) for x in segs])
    begin = np.cumsum(size) - size
    got = suffix_dedup.Suffixes(np.concatenate(segs), begin, left, size - left, length, gram).repeats()
    common = lambda x, y: next((k for k, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))
    n = len(segs)
    want = np.zeros((2, n), np.int64)
    for i in range(n):
        for j in range(n):
            a, b = common(segs[i][: left[i]][::-1], segs[j][: left[j]][::-1]), common(segs[i][left[i] :], segs[j][left[j] :])
            if i != j and b >= gram and a + b >= length:
                want[0, i], want[1, i] = max(want[0, i], a), max(want[1, i], b)
    whole = {}
    for i in range(n):
        whole.setdefault((left[i], segs[i].tobytes()), []).append(i)
    for same in whole.values():
        if len(same) > 1:  # copies are taken whole: a window fits in each in a corpus
            want[0, same], want[1, same] = left[same], size[same] - left[same]
    assert (want[1] > 0).sum() > 10 and (np.array(got) == want).all()


def test_op9(spark, sf_tiny):
    pages = {r.page_id: (r.html or "").encode() for r in spark.read.parquet(f"{sf_tiny}/pages.parquet").collect()}
    got = {r["page_id"]: r for r in rows(warc.op9_warc(spark, sf_tiny))}
    assert set(got) == set(pages)
    for i, b in pages.items():
        first = min(k for k, x in pages.items() if x == b)
        assert (got[i]["payload_bytes"], got[i]["payload_digest"]) == (len(b), base64.b32encode(hashlib.sha1(b).digest()).decode())
        assert (got[i]["record_type"], got[i]["refers_to"]) == (("response", None) if first == i else ("revisit", first))


def test_op9_detects_damage(spark, sf_tiny, tmp_path):
    from pyspark.sql import functions as F

    headers, payloads = warc.records(spark.read.parquet(f"{sf_tiny}/pages.parquet"))
    headers.write.parquet(f"{tmp_path}/headers")
    payloads.withColumn("payload", F.concat("payload", F.lit("!").cast("binary"))).write.parquet(f"{tmp_path}/payloads")
    with pytest.raises(Exception, match="differs from its digest"):
        warc.read(spark, str(tmp_path)).collect()


def brute_alignment(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_smith_waterman():
    r = np.random.default_rng(2)
    for _ in range(50):
        a, b = r.integers(1, 5, r.integers(1, 12)), r.integers(1, 5, r.integers(1, 20))
        assert decontaminate.smith_waterman(a, b)[0] == brute_alignment(a.tolist(), b.tolist())


@pytest.mark.parametrize("block", [200_000, 10])
def test_op10(spark, sf_tiny, texts, block):
    docs, items = spark.read.parquet(f"{sf_tiny}/documents.parquet"), spark.read.parquet(f"{sf_tiny}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r for r in rows(decontaminate.contaminated(docs, items, most=block))}
    want = {}
    for r in items.collect():
        w = decontaminate.words(r.text or "")
        for i, t in texts.items():
            score = brute_alignment(w, decontaminate.words(t or "")) / (2 * len(w)) if w else 0
            if score >= decontaminate.CUT:
                want[i, r.item_id] = score
    assert set(want) == {(31, 1), (32, 1)} == set(got)
    assert all(abs(got[k]["score"] - s) < 1e-9 for k, s in want.items())
    hit = got[31, 1]
    assert decontaminate.words(texts[31])[hit["first_word"] : hit["end_word"]] == decontaminate.words(texts[31])[30:70]


def test_op10_edited_leak_in_many_documents(spark):
    item = [f"w{i}" for i in range(40)]
    leak = list(item)
    for i in (4, 13, 22, 31):
        leak[i] = f"x{i}"
    docs = spark.createDataFrame([(i, f"before{i} " + " ".join(leak) + f" after{i}") for i in range(12)], "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    want = brute_alignment(item, leak) / 80
    assert want >= decontaminate.CUT
    assert sorted((r["doc_id"], r["score"]) for r in rows(decontaminate.contaminated(docs, items))) == [(i, want) for i in range(12)]


def densely_edited(r, item, kind):
    """The item with every fourth or fifth word replaced, dropped or followed by another."""
    out, at = [], int(r.integers(0, 4))
    for i, w in enumerate(item):
        if i == at:
            at += int(r.integers(4, 6))
            op = kind if kind < 3 else int(r.integers(0, 3))
            out += [[f"x{i}"], [], [w, f"x{i}"]][op]
        else:
            out.append(w)
    return out


def test_op10_recall_of_dense_edits():
    r = np.random.default_rng(5)
    items = [[f"w{x}" for x in r.integers(0, 60, n)] for n in (1, 2, 3, 5, 8, 9, 16, 16, 25, 40)]
    texts = [densely_edited(r, item, kind) for item in items for kind in (0, 1, 2, 3) for _ in range(3)]
    texts += [["w70", *items[6][:3], "x", *items[6][4:7], "y", *items[6][8:11], "z", *items[6][12:]], [*items[4][:4], "x", *items[4][5:]]]
    texts += [[f"w{x}" for x in r.integers(0, 60, 300)] for _ in range(5)]
    texts = [[f"p{i}" for i in range(j % 7)] + t + ["q"] * (j % 5) for j, t in enumerate(texts)]
    want = {}
    for j, t in enumerate(texts):
        for k, item in enumerate(items):
            score = brute_alignment(item, t) / (2 * len(item))
            if score >= decontaminate.CUT:
                want[j, k] = score
    got = decontaminate.Block([(k, " ".join(item)) for k, item in enumerate(items)]).matches([" ".join(t) for t in texts], {})
    assert {(j, m[0]): m[1] for j, found in enumerate(got) for m in found} == want
    assert len(want) > 100


def test_op4_loss_follows_the_mask(spark, sf_tiny, monkeypatch):
    read = chat.read_back
    right = {r["conv_id"]: r["loss_chars"] for r in rows(chat.op4_chat(spark, sf_tiny))}
    shorter = "transform(loss_mask, x -> named_struct('start', x.start, 'length', greatest(x.length - 1, 0L)))"
    monkeypatch.setattr(chat, "read_back", lambda f: read(f).withColumn("loss_mask", chat.F.expr(shorter)))
    wrong = {r["conv_id"]: r["loss_chars"] for r in rows(chat.op4_chat(spark, sf_tiny))}
    assert right[-7] == 26 and wrong[-7] == 25 and right != wrong


def test_op6_difference_is_the_log_density_difference():
    """Against densities computed with full covariances, their inverses and determinants."""
    from cairn.llm import quality

    r = np.random.default_rng(9)
    x = np.concatenate((r.normal(size=(300, 4)) @ r.normal(size=(4, 4)), 1.5 + 2 * r.normal(size=(200, 4))))
    y = np.repeat([0, 1], [300, 200])
    model = quality.Discriminant.fit(x, y.astype(float))
    z = (x - x.mean(axis=0)) / np.maximum(x.std(axis=0), 1e-3)
    side = []
    for k in (0, 1):
        own = z[y == k]
        cov = np.cov(own.T)
        weight = max(quality.SHRINK, min(1.0, 4 / len(own)))
        cov = (1 - weight) * cov + weight * np.diag(np.diag(cov)) + quality.RIDGE * np.eye(4)
        off = z - own.mean(axis=0)
        side.append(np.log(len(own) / len(z)) - 0.5 * np.log(np.linalg.det(cov)) - 0.5 * np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov), off))
    want = side[1] - side[0]
    got = model.difference(x)
    assert np.allclose(np.sign(got) * np.expm1(np.abs(got)), want, rtol=1e-6, atol=1e-8)


def test_op3_isotonic_is_the_best_monotone_fit():
    """Pooled levels against the max-min formula of monotone regression, with tied scores."""
    r = np.random.default_rng(3)
    raw = np.sort(r.normal(size=60))
    y = (r.random(60) < 1 / (1 + np.exp(-2 * raw))).astype(float)
    at, level = toxicity.isotonic(raw, y)
    best = [max(min(y[a : b + 1].mean() for b in range(i, 60)) for a in range(i + 1)) for i in range(60)]
    blocks = np.unique(np.round(best, 9))
    assert np.allclose(np.unique(np.round(level, 9)), blocks) and len(at) == len(level)


def test_op3_split_is_the_best_of_all():
    r = np.random.default_rng(6)
    b = r.integers(0, 6, size=(80, 3))
    grad, hess = r.normal(size=80), r.uniform(0.1, 0.25, size=80)
    rows_ = np.arange(80)
    gain = {}
    for f in range(3):
        for cut in range(1, 6):
            left = b[:, f] < cut
            if min(left.sum(), (~left).sum()) >= toxicity.LEAF:
                gain[f, cut] = sum(grad[m].sum() ** 2 / (hess[m].sum() + 1) for m in (left, ~left)) - grad.sum() ** 2 / (hess.sum() + 1)
    assert toxicity.Trees._split(b, grad, hess, rows_) == max(gain, key=gain.get)


def test_op3_split_is_the_same_in_every_unit():
    r = np.random.default_rng(8)
    b, unit = r.integers(0, 6, size=(80, 3)), 1 << 24
    grad, hess = np.rint(r.normal(size=80) * unit), np.rint(r.uniform(0.1, 0.25, size=80) * unit)
    one = toxicity.Trees._split(b, grad / unit, hess / unit, np.arange(80))
    assert one == toxicity.Trees._split(b, grad, hess, np.arange(80), unit) and one != (0, 1 << 30)
