from pyspark.sql import functions as F

from cairn.operators import render


def test_a_tree_finds_planted_differences(spark):
    rows = spark.range(5000).select(F.col("id").cast("string").alias("k"), (F.col("id") % 7).cast("string").alias("v"))
    other = rows.where("k not in ('17', '400')").withColumn("v", F.when(F.col("k") == "3000", "x").otherwise(F.col("v"))).unionByName(rows.where("k in ('5', '6')")).repartition(5)
    got = {(r["k"], r["v"], r["side"], r["copies"]) for r in render.differences(rows, other, ["k"]).collect()}
    assert got == {("17", "3", "one", 1), ("400", "1", "one", 1), ("3000", "4", "one", 1), ("3000", "x", "two", 1), ("5", "5", "two", 1), ("6", "6", "two", 1)}
    one, two = (render.tree(x, ["k"]).cache() for x in (rows, other))
    leaves = render.differing(one, two)
    assert 1 <= len(leaves) <= 5 and render.differing(one, render.tree(rows.repartition(9), ["k"])) == []
    assert {(r["k"], r["side"]) for r in render.differences(rows, other, ["k"], (one, two)).collect()} == {(k, s) for k, _, s, _ in got}
    top = one.where("level = 0").collect()
    assert len(top) == 1 and top[0]["n"] == 5000


def test_verify_names_what_differs(spark):
    v = spark.createDataFrame([("k1", "A", None, ["x", "y"], 0.5, 1), ("k2", "B", "u", None, None, 1), ("k3", "C", "u", [], None, 0)], "key string, name string, image_url string, aliases array<string>, volume double, in_full int")
    full = render.varieties(v)
    assert sorted(map(tuple, full.collect())) == [("k1", "A", "", "x|y", "0.5"), ("k2", "B", "u", "", "")]
    p = spark.createDataFrame([("s1", "h1"), ("s2", None), ("s3", "h3")], "sku string, handle string")
    i = spark.createDataFrame([("s1", 4, 3), ("s2", 0, None), ("s3", 5, 5), ("s4", 1, 0), ("s1x", -2, 0)], "sku string, qty int, last_synced_qty int")
    moved = render.stock(i, p)
    assert sorted(map(tuple, moved.collect())) == [("s1", "h1", "4"), ("s2", "", "0")]
    file = spark.createDataFrame([("s1", "h1", "4"), ("s2", "", "9")], ", ".join(f"`{c}` string" for c in render.STOCK_COLUMNS))
    assert render.verify({"varieties": (full, full, ["Key"]), "stock": (moved, file, ["Variant Sku"])}) == {"stock": (1, 1)}
    assert render.verify({"empty": (full.limit(0), full.limit(0), ["Key"])}) == {}


def test_recall_of_the_neighbour_index(spark):
    import numpy as np

    from cairn.plans import catalog_queries as Q

    sf = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").orderBy("vec_id").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sim = x @ x.T
    np.fill_diagonal(sim, -2)
    best = dict(zip(ids.tolist(), np.round(sim.max(axis=1), 6).tolist(), strict=True))
    got = {r.qid: (r.cid, r.score) for r in Q.semantic_nn_all(spark, sf).collect()}
    assert set(got) == set(best) and all(c != q for q, (c, _) in got.items())
    assert sum(abs(got[q][1] - s) < 2e-6 for q, s in best.items()) >= 0.9 * len(best)
