import random

import pytest

import corpus_pipeline
from cairn.llm import simhash, suffix_dedup


def test_stages(spark, sf_tiny, texts):
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_tiny)
        out = spark.createDataFrame(out.collect(), out.schema)
        kept[name] = out
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns
            docs = out
    ids = {n: sorted(r.doc_id for r in d.select("doc_id").distinct().collect()) for n, d in kept.items()}
    near = ids["simhash_near_dedup"]
    assert 20 in near and 21 not in near and 22 not in near and 25 in near and 26 not in near
    assert set(range(20)) <= set(near)
    after = {r.doc_id: r.text for r in kept["suffix_array_dedup"].collect()}
    assert all(len(after[i]) < len(texts[i]) for i in (23, 24)) and after[5] == texts[5]
    left = ids["benchmark_decontamination"]
    assert 31 not in left and 32 not in left and set(range(20)) <= set(left)
    assert ids["best_fit_packing"] == left


def test_stages_of_empty_tables(spark, sf_tiny, sf_empty):
    docs, none = spark.read.parquet(f"{sf_tiny}/documents.parquet"), spark.read.parquet(f"{sf_empty}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, sf_empty).count() == 0
        out = stage(spark, docs, sf_empty)  # no labels, no benchmark
        assert out.count() > 0 and (name == corpus_pipeline.STAGES[-1][0] or out.columns == docs.columns)
    assert corpus_pipeline.run(spark, sf_empty).count() == 0


def test_columns_named_like_a_stages_own(spark, sf_tiny):
    clash = ["_twin", "_left", "_rest", "row", "code", "id", "node", "n", "component", "kept", "digest", "y", "half", "fp", "keys", "met", "x", "score", "start", "piece", "key"]
    docs = spark.read.parquet(f"{sf_tiny}/documents.parquet").select("doc_id", "text", "n_chars")
    more = docs.selectExpr("*", *(f"'{c}' AS {c}" for c in clash))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, wide = stage(spark, docs, sf_tiny), stage(spark, more, sf_tiny)
        assert wide.columns == more.columns
        assert sorted(map(str, wide.select("doc_id", "text", "n_chars").collect())) == sorted(map(str, plain.collect())), name
        assert all(r[c] == c for r in wide.collect() for c in clash)
    assert corpus_pipeline.pack_sequences(spark, more, sf_tiny).count() == corpus_pipeline.pack_sequences(spark, docs, sf_tiny).count()


def test_ties_of_toxicity(spark):
    """Equal texts have equal scores and leave together, whatever the partitions; order of rows and ids changes nothing."""
    from cairn.llm import toxicity

    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    twice = docs.unionByName(docs.withColumn("doc_id", docs["doc_id"] + 10**6))
    one = sorted((r.doc_id, r.text) for r in toxicity.not_toxic(twice.repartition(1), labels).collect())
    many = sorted((r.doc_id, r.text) for r in toxicity.not_toxic(twice.orderBy("text").repartition(7), labels).collect())
    assert one == many and {i for i, _ in one if i < 10**6} == {i - 10**6 for i, _ in one if i >= 10**6}


def test_run(spark, sf_tiny):
    assert corpus_pipeline.run(spark, sf_tiny).count() > 0


def test_cut_text_stays_valid(spark):
    base = "é" * 300
    docs = spark.createDataFrame([(1, "a" + base + "tail one"), (2, "b" + base + "last end")], "doc_id long, text string")
    got = sorted(r.text for r in suffix_dedup.without_repeats(docs, length=256).collect())
    assert got == ["atail one", "blast end"]


def test_near_duplicates_are_verified(spark):
    r = random.Random(3)
    word = lambda: f"w{r.randrange(10**6)}"
    texts = {}
    for g in range(60):
        base = [word() for _ in range(r.choice([9, 10, 40, 150, 400]))]
        texts[10 * g] = base
        for k in range(1, 5):
            t = list(base)
            for _ in range(r.randrange(1, 2 + len(t) // 30)):
                t[r.randrange(len(t))] = word()
            texts[10 * g + k] = t
        texts[10 * g + 5] = (base + [word()]) if g % 2 else base * 2
    texts[1000], texts[1001] = [*"abcdefgh"], [*"abcdefghi"]  # 4 of 5 shingles: 0.8
    texts[1002], texts[1003] = [*"ABCDEFG".lower(), "z"], [*"abcdefg", "y", "x"]  # few in common
    shingles = {i: {tuple(t[k : k + 5]) for k in range(max(1, len(t) - 4))} for i, t in texts.items()}
    label = {i: i for i in texts}
    linked = apart = 0
    for i in texts:
        for j in texts:
            if j < i:
                similarity = len(shingles[i] & shingles[j]) / len(shingles[i] | shingles[j])
                apart += 0.6 < similarity < 0.8
                if similarity >= 0.8:
                    linked += 1
                    low, high = sorted((label[i], label[j]))
                    label = {k: low if v == high else v for k, v in label.items()}
    assert linked > 30 and apart > 30
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    assert {x.id: x.component for x in simhash.similar_groups(docs).collect()} == label
    assert sorted(x.doc_id for x in simhash.one_of_each(docs).collect()) == sorted(set(label.values()))


def test_texts_without_a_partner_are_not_shuffled(spark, monkeypatch):
    texts = {i: [f"w{i}x{k}" for k in range(30)] for i in range(400)}
    texts[400], texts[401] = texts[3], [*texts[5], "more"]
    sifted, sift = [], simhash.sifted
    monkeypatch.setattr(simhash, "sifted", lambda *of: sifted.append(sift(*of)) or sifted[-1])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    assert sorted(x.doc_id for x in simhash.one_of_each(docs).collect()) == list(range(400))
    assert {5, 401} <= {x.id for x in sifted[0].collect()} and sifted[0].count() < 40


def shingled(t):
    return {tuple(t[k : k + 5]) for k in range(max(1, len(t) - 4))}


def test_near_duplicates_in_a_group_of_many_tasks(spark, monkeypatch):
    """A chain of groups that one task may not hold, with members that only a few others are like."""
    monkeypatch.setattr(simhash, "GROUP", 12)
    monkeypatch.setattr(simhash, "PIVOTS", 2)
    r = random.Random(11)
    base = [f"w{i}" for i in range(120)]
    texts = {}
    for i in range(150):
        t = list(texts[r.randrange(i)]) if i and r.random() < 0.7 else list(base)
        for _ in range(r.choice([1, 2, 3, 3, 4])):
            t[r.randrange(len(t))] = f"v{r.randrange(10**6)}"
        texts[i] = t
    label = {i: i for i in texts}
    sets = {i: shingled(t) for i, t in texts.items()}
    for i in texts:
        for j in range(i):
            if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8 and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    assert 3 < len(set(label.values())) < 150
    docs = spark.createDataFrame([(f"{i:04d}", " ".join(t)) for i, t in texts.items()], "doc_id string, text string")
    assert {x.id: x.component for x in simhash.similar_groups(docs).collect()} == {f"{i:04d}": f"{k:04d}" for i, k in label.items()}


@pytest.mark.parametrize("size", [60, 600, 4_000])
def test_recall_at_sizes(spark, size):
    """Pairs of similarity 0.8 to 0.9 among texts of one vocabulary, whatever the corpus's size."""
    r = random.Random(size)
    texts, pairs = [], []
    for k in range(size // 2):
        t = [f"w{r.randrange(3_000)}" for _ in range(r.choice([12, 30, 90, 250]))]
        u = list(t)
        for _ in range(max(1, len(t) // 60)):
            u[r.randrange(len(u))] = f"x{r.randrange(10**6)}"
        a, b = shingled(t), shingled(u)
        texts += [t, u]
        if len(a & b) / len(a | b) >= 0.8:
            pairs.append((2 * k, 2 * k + 1))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    label = {x.id: x.component for x in simhash.similar_groups(docs).collect()}
    assert len(pairs) > size // 10
    assert sum(label[i] == label[j] for i, j in pairs) >= 0.99 * len(pairs)
    assert sum(label[i] != i for i in label) <= len(pairs)


def test_pair_of_two_thirds_stays(spark):
    a = [f"w{i}" for i in range(104)]
    b = [*a[:50], "x", *a[51:70], "y", *a[71:90], "z", *a[91:97], *(f"v{i}" for i in range(3)), *a[100:]]
    one, two = ({tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in (a, b))
    assert 0.55 < len(one & two) / len(one | two) < 0.8
    docs = spark.createDataFrame([(1, " ".join(a)), (2, " ".join(b))], "doc_id long, text string")
    assert simhash.one_of_each(docs).count() == 2


def test_word_codes_see_every_script_alike():
    import pyarrow as pa

    texts = ["", " ", "a b\tc", "a  b c ", "a\u00a0b", "x \u2003 y\u3000z", "\u4e2d\u6587 ab\u4e00", "é è\x85ñ", "\u2014 dash \u201cquoted\u201d", "😀 a", "\u0e01\u0e02x", "a\x1cb"]
    got = suffix_dedup.word_codes(pa.array(texts)).to_pylist()
    size = suffix_dedup.CODE
    seen = {}
    for t, codes in zip(texts, got, strict=True):
        words = suffix_dedup._WORD.findall(t)
        assert len(codes) == size * len(words)
        for k, w in enumerate(words):
            assert seen.setdefault(w, codes[size * k : size * k + size]) == codes[size * k : size * k + size]
    assert len(set(seen.values())) == len(seen) and suffix_dedup.word_codes(pa.array([], pa.string())).to_pylist() == []


def test_repeats_of_over_50_short_words_go(spark, sf):
    r = random.Random(8)
    short = lambda n: [r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n)]
    cut, left, signs = short(51), short(50), "".join(chr(0x4E00 + r.randrange(2000)) for _ in range(60))
    text = lambda i, part: f"before{i} " + part + f" after{i}"
    parts = [" ".join(cut), "  ".join(cut), " ".join(left), " ".join(left), signs, signs]
    docs = spark.createDataFrame([(i, text(i, p)) for i, p in enumerate(parts)] + [(9, None)], "doc_id long, text string")
    got = {x.doc_id: x.text for x in corpus_pipeline.cut_repeats(spark, docs, sf).collect()}
    assert {i: got[i].split() for i in (0, 1, 4, 5)} == {i: [f"before{i}", f"after{i}"] for i in (0, 1, 4, 5)}
    assert all(got[i] == text(i, parts[i]) for i in (2, 3)) and got[9] is None
