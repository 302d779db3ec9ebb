"""The alias model against a plain fit of the same objective, and curation that asks it."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cairn import config as C
from cairn.functions import kernels as K
from cairn.operators import alias_model, catalog

SCHEMA = "name string, aliases array<string>, type string, colors array<string>"


def rows():
    r = random.Random(4)
    words = [a + b for a in ("cal", "vel", "mor", "tan", "ser", "lun", "pir", "gal", "nev", "bor") for b in ("acatta", "uto", "ena", "ino", "osa", "ado")]
    out = []
    for k in range(160):
        name = " ".join(r.sample(words, 2))
        kind = r.choice(["marble", "granite", ""])
        spelt = [name + " stone", "premium " + name, name.replace("a", "aa", 1), name[:-1]]
        out.append((name.title(), r.sample(spelt, r.randint(1, 3)), kind, [r.choice(["white", "black"])]))
    return out + [("", ["x"], "", None), ("Lone", None, None, None)]


@pytest.fixture(scope="module")
def varieties(spark):
    return spark.createDataFrame(rows(), SCHEMA)


@pytest.fixture(scope="module")
def model(varieties):
    return alias_model.train(varieties)


def test_pairs_and_fit(spark, varieties, model):
    pairs = alias_model.training_pairs(varieties).withColumn("x", alias_model.features(*(F.col(c) for c in ("a", "b", "ta", "tb", "ca", "cb")))).collect()
    by_name = {}
    for n, al, t, c in sorted(((n.lower(), [a.lower() for a in al or []], t or "", c or []) for n, al, t, c in rows()), key=lambda v: (v[2], v[1], v[3])):
        by_name.setdefault(n, (al, t, c))
    assert sum(p.label for p in pairs) > 200 and sum(1 - p.label for p in pairs) > 100
    for p in pairs:
        al, t, _ = by_name[p.a]
        assert (p.b in al and p.b != p.a and p.ta == p.tb == t) if p.label else (p.b in by_name and p.b not in al and p.b != p.a and set(p.a.split()) & set(p.b.split()))
    extra = lambda p: set(p.a.split()) ^ set(p.b.split())
    for p in pairs[::17]:
        assert p.x[:13] == pytest.approx(K.pair_features(p.a, p.b)) and p.x[13] == float(p.ta != "" and p.ta == p.tb) and p.x[15] == float(bool(extra(p)) and extra(p) <= set(alias_model.GENERIC))
    learn = [p for p in pairs if not p.held_out]
    x, y = np.array([p.x for p in learn]), np.array([p.label for p in learn], float)
    z = np.c_[(x - x.mean(0)) / (x.std(0) + 1e-9), np.ones(len(x))]
    w = np.zeros(z.shape[1])
    keep = np.diag([1e-3] * (len(w) - 1) + [0.0])
    for _ in range(100):  # Newton's steps on the mean loss with the same penalty
        q = 1 / (1 + np.exp(-z @ w))
        w -= np.linalg.solve(z.T @ (z * (q * (1 - q))[:, None]) / len(z) + keep + 1e-12 * np.eye(len(w)), z.T @ (q - y) / len(z) + keep @ w)
    x = np.array([p.x for p in pairs])
    plain = 1 / (1 + np.exp(-(np.c_[(x - np.array(model.mean)) / np.array(model.spread), np.ones(len(x))] @ w)))
    own = [r.p for r in spark.createDataFrame([(i, p.x) for i, p in enumerate(pairs)], "i int, x array<double>").select("i", model.probability(F.col("x")).alias("p")).orderBy("i").collect()]
    verdict = lambda p: "alias" if p >= C.ALIAS_ACCEPT else "mint" if p <= C.ALIAS_MINT else "review"
    assert np.abs(np.array(own) - plain).max() < 1e-3 and [verdict(p) for p in own] == [verdict(p) for p in plain]
    held = [(v, p.label) for v, p in zip(plain, pairs, strict=True) if p.held_out]
    sure = [(v >= C.ALIAS_ACCEPT) == bool(k) for v, k in held if v >= C.ALIAS_ACCEPT or v <= C.ALIAS_MINT]
    assert model.coverage == pytest.approx(len(sure) / len(held)) and model.accuracy == pytest.approx(sum(sure) / len(sure)) and model.accuracy > 0.9


def test_too_few_names(spark):
    assert alias_model.train(spark.createDataFrame(rows()[:40], SCHEMA)) is None


def test_curation_asks_the_model(spark, varieties, model):
    name, _, kind, _ = next(v for v in rows() if v[2] == "marble")
    asked = spark.createDataFrame([("The " + name, "marble"), ("The " + name, "granite"), ("Wholly Different Thing", "marble"), (name, "marble"), ("AB12", "")], "name string, type string")
    none = spark.createDataFrame([], "name string, type string")
    actions = catalog.curate(asked, varieties.select("name", "type"), none, none)
    got = {(r["norm"], r["type_norm"]): (r["action"], r["nearest"]) for r in alias_model.curate_open(actions, varieties, model).collect()}
    low = name.lower()
    assert got["the " + low, "marble"] == ("alias", low) and got["the " + low, "granite"] == ("review", low)
    assert got["wholly different thing", "marble"] == ("review", None) and got[low, "marble"] == ("existing", None) and got["ab12", ""] == ("hold", None)
    assert {r["action"] for r in alias_model.curate_open(actions, varieties, None).where("norm like 'the %'").collect()} == {"review"}
