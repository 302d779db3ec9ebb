import random

import pytest

WORDS = [a + b for a in "ban cor del fim gor hul jas kep lom nur".split() for b in "ta re so vi mu".split()]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    long, shared = prose(1, 180), prose(2, 120)
    words = long.split()
    near = " ".join([*words[:90], "changed", *words[91:]])
    t = {i: prose(10 + i, 40 + 5 * i) for i in range(20)}
    t |= {20: long, 21: long, 22: near, 23: prose(50, 130) + " " + shared, 24: shared + " " + prose(51, 130), 25: "", 26: None, 27: "a", 28: "É è ñ\tß " * 30, 29: "x" * 900, 30: "IDIOT you idiot!! " + prose(60, 20)}
    t[31] = prose(61, 30) + " " + prose(900, 40) + " " + prose(62, 30)
    edited = prose(900, 40).split()
    edited[7], edited[19], edited[33] = "zz", "yy", "ww"
    t[32] = prose(63, 25) + " " + " ".join(edited)
    return t


@pytest.fixture(scope="session")
def sf_tiny(spark, tmp_path_factory, texts):
    d = tmp_path_factory.mktemp("tiny")
    rows = [(i, t, "en", "s", -1, 0.5, "fp") for i, t in texts.items()] + [(20, texts[20], "en", "s", -1, 0.5, "fp")]
    extra = "doc_id long, text string, lang string, source string, n_chars long, score double, fp string"
    spark.createDataFrame(rows, extra).repartition(3).write.parquet(f"{d}/documents.parquet")
    labels = [(i, int(i % 4 > 0), int(i == 30)) for i in range(0, 33)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, prose(900, 40)), (2, prose(901, 40)), (3, None), (4, "")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    pages = [(5, "http://a", "<p>x</p>"), (3, "http://b", "<p>x</p>"), (7, None, None), (8, "u", ""), (9, "u\r\nX: y", "é" * 50)]
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{d}/pages.parquet")
    talk = [(1, 1, "assistant", "b</turn>\n<turn user>x"), (1, 0, "user", "a"), (2, 0, "system", None), (2, 1, "assistant", "\\l \\\\l <turn assistant\\>"), (2, 2, "assistant", ""), (3, 0, "we>ird\\", "\n</turn>"), (3, 0, None, "t"), (3, 0, None, "t")]
    spark.createDataFrame(talk, "conv_id long, turn long, role string, text string").write.parquet(f"{d}/conversations.parquet")
    spark.createDataFrame(vector_rows(), "vec_id long, embedding array<float>, label int, x double, id string, cluster int").repartition(3).write.parquet(f"{d}/embeddings.parquet")
    return str(d)


@pytest.fixture(scope="session")
def vector_table():
    return vector_rows()


def vector_rows():
    r = random.Random(7)
    v = {i: [r.choice((-0.5, 0.25, 1.0)) + r.random() for _ in range(64)] for i in range(90)}
    v[3], v[5] = v[4], [0.0] * 64  # equal vectors
    odd = [(100, None), (101, [*v[0][:63], None]), (102, [*v[0][:63], float("nan")]), (103, [*v[0][:63], float("inf")]), (104, v[0][:63]), (105, []), (106, [3e38] * 64), (None, v[7])]
    return [(i, x, 0, 0.5, "id", 1) for i, x in [*v.items(), (8, v[8]), (8, v[9]), *odd]]


@pytest.fixture(scope="session")
def sf_empty(spark, sf_tiny, tmp_path_factory):
    d = tmp_path_factory.mktemp("empty")
    for t in ("documents", "labels", "benchmark", "pages", "conversations", "embeddings"):
        spark.read.parquet(f"{sf_tiny}/{t}.parquet").limit(0).write.parquet(f"{d}/{t}.parquet")
    return str(d)
