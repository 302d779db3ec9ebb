"""The likeness join and the stored index against all pairs and full builds."""
import random
import uuid

import pytest
from pyspark.sql import functions as F

from cairn.functions import kernels as K
from cairn.operators import candidate_index, likeness, resolve

PARTS = "ar bel cal dor em fan gra hel ir jul kor lam mon nar ol pel qua ros sol tra um ver wis xan yel zor bianco nero gold".split()


def names(seed, n):
    """Names of one to four made words, with misspellings, swaps, doubled letters and very short ones among them."""
    r = random.Random(seed)
    out = set()
    while len(out) < n:
        words = ["".join(r.choice(PARTS) for _ in range(r.randint(1, 3))) for _ in range(r.randint(1, 4))]
        name = " ".join(words)
        out.add(name)
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(name))
            out.add(r.choice([name[:k] + name[k + 1 :], name[:k] + r.choice("aeioux ") + name[k:], name[:k] + name[k : k + 1] * 2 + name[k + 1 :], " ".join(reversed(words)), name[:4]]).strip())
    return sorted(x for x in out if x)[:n]


@pytest.mark.parametrize("floor", [84.0, 90.0, 80.5])
def test_all_pairs_that_reach_the_floor(spark, floor):
    a, b = names(1, 60), names(2, 400)
    b += a[::5] + ["", "x", "xy"]
    df = lambda v: spark.createDataFrame([(x,) for x in v], "name string")
    got = {(r["a"], r["b"]): r["score"] for r in likeness.fuzzy_pairs(df(a), df(b), floor).collect()}
    assert got == {(x, y): K.fuzzy(x, y) for x in a for y in set(b) if K.fuzzy(x, y) >= floor}


def test_five_thousand_names(spark):
    """Nothing is lost, no plan compares all, and few pairs are scored."""
    many = names(3, 5000)
    asked = random.Random(4).sample(many, 60)
    df = lambda v: spark.createDataFrame([(x,) for x in v], "name string")
    found = likeness.fuzzy_pairs(df(asked), df(many), 84.0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {(r["a"], r["b"]) for r in found.collect()}
    fits = lambda x, y: 200 * min(len(x), len(y)) >= 84 * (len(x) + len(y))
    want = {(x, y) for x in asked for y in many if fits(x, y) and K.fuzzy(x, y) >= 84}
    assert got == want and len(want) > 60


def test_pairs_scored_are_few(spark, monkeypatch):
    many = names(5, 3000)
    asked = many[::30]
    df = lambda v: spark.createDataFrame([(x,) for x in v], "name string")
    monkeypatch.setattr(K, "fuzzy_score", lambda a, b: F.lit(100.0))  # every candidate passes: what is left is what would be scored
    candidates = likeness.fuzzy_pairs(df(asked), df(many), 84.0).count()
    assert candidates < 0.05 * len(asked) * len(many)


@pytest.mark.parametrize("least", [0.85, 0.92])
def test_all_pairs_of_a_jaro_winkler_score(spark, least):
    a, b = names(6, 40), names(7, 300)
    b += a[::4] + ["", "x", "xy"]
    df = lambda v: spark.createDataFrame([(x,) for x in v], "name string")
    got = {(r["a"], r["b"]) for r in likeness.jaro_winkler_alike(df(a), df(b), least).collect()}
    assert got == {(x, y) for x in a for y in set(b) if K.jaro_winkler(x, y) >= least}


def test_floors_below_the_bound_are_refused(spark):
    one = spark.createDataFrame([("a",)], "name string")
    with pytest.raises(ValueError):
        likeness.fuzzy_pairs(one, one, 80)
    with pytest.raises(ValueError):
        likeness.jaro_winkler_alike(one, one, 0.8)


def candidates(spark, rows):
    return spark.createDataFrame(rows, "cid long, name string, aliases array<string>, type string")


def test_a_stored_index_is_joined_where_it_lies_and_refreshed_in_part(spark):
    old = [(k, n, [n + " stone"], "marble" if k % 2 else "") for k, n in enumerate(names(8, 300))]
    new = [(k, n + ("x" if k % 50 == 0 else ""), a, t) for k, n, a, t in old if k % 70] + [(1000, "late comer", None, "onyx")]
    first, second, full = (f"cairn_index_{uuid.uuid4().hex}" for _ in range(3))
    candidate_index.build(candidates(spark, old), first, buckets=4)
    changed, gone = candidate_index.changes(candidates(spark, old), candidates(spark, new), ["name", "aliases", "type"])
    assert changed.count() == 5 + 1 and gone.count() == 5
    candidate_index.refresh(spark, first, second, changed, gone, buckets=4)
    candidate_index.build(candidates(spark, new), full, buckets=4)
    rows = lambda table: sorted(map(str, candidate_index.load(spark, table).select("cid", "ckey", "block", "colors", "cwords", "rank", "key").collect()))
    assert rows(second) == rows(full)
    asked = spark.createDataFrame([(n[1], "") for n in new[::7]] + [(n[1] + "q", "marble") for n in new[::11]], "query string, qtype string")
    answers = lambda index: sorted(map(str, resolve.match_ladder(asked, index).select("query", "qblock", "cid", "tier", "decision").collect()))
    stored = candidate_index.load(spark, second)
    assert answers(stored) == answers(resolve.surfaces(candidates(spark, new)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keys = spark.createDataFrame([(0, "late comer")] * 3, "rank int, key string")
        plan = keys.join(stored, ["rank", "key"])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert plan.count("Exchange") == 1 and "SelectedBucketsCount: 4 out of 4" in plan
    for table in (first, second, full):
        spark.sql(f"DROP TABLE {table}")
