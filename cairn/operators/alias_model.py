"""Alias or variety of its own: a logistic model over pairs of names, learned from the catalog's own aliases.

A variety's name with one of its aliases is a pair that belongs together; with the two likest other names that aren't its aliases,
pairs that don't.  Which pairs are learned from and which are held out is decided by a hash of their names.  Likeness features are those of
`kernels.pair_features`; type, colours and words that say nothing add three.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions import kernels as K
from ..functions import text as T
from . import likeness
from .joins import written
from .resolve import alias_decision

# Words that make no variety of their own when they are all that two names differ in.
GENERIC = (
    "marble", "granite", "slab", "slabs", "stone", "tile", "tiles", "block", "blocks", "natural", "polished", "honed",
    "brazilian", "brazil", "italian", "turkish", "indian", "premium", "classic", "extra", "standard", "the", "and",
)
# Names and aliases that a model needs; varieties learned from at most, aliases and other names for each; a fifth is held out.
LEAST_NAMES, LEAST_ALIASES, SAMPLE, POSITIVE, NEGATIVE, HELD_OUT = 50, 100, 6_000, 5, 2, 5


def keyed(varieties: DataFrame) -> DataFrame:
    """(n, aliases, t, c) of varieties (name, aliases, type, colors), as keys, one for each name: the first by type."""
    texts = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), T.match_key)
    rows = varieties.select(T.match_key(F.col("name")).alias("n"), F.array_distinct(F.filter(texts("aliases"), lambda x: x != "")).alias("aliases"), T.match_key(F.col("type")).alias("t"), F.array_distinct(texts("colors")).alias("c")).where("n <> ''")
    return rows.groupBy("n").agg(F.min(F.struct("t", "aliases", "c")).alias("x")).select("n", "x.aliases", "x.t", "x.c")


def features(a: Column, b: Column, ta: Column, tb: Column, ca: Column, cb: Column) -> Column:
    """The likeness features of two keys, then: same type, a colour in common, differ in generic words alone."""
    x, y = F.split(a, " "), F.split(b, " ")
    extra = F.array_union(F.array_except(x, y), F.array_except(y, x))
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    more = F.array(flag((ta != "") & (ta == tb)), flag(F.arrays_overlap(ca, cb)), flag((F.size(extra) > 0) & F.forall(extra, lambda w: w.isin(*GENERIC))))
    return F.concat(K.feature_vector(a, b), more)


def training_pairs(varieties: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """(a, b, ta, tb, ca, cb, label, held_out) of at most `sample` varieties, those whose names hash lowest, against all names.

    The likest other names are found among those that share the name's rarest word, ties by name.
    """
    rows = written(keyed(varieties))
    some = rows.orderBy(F.xxhash64("n"), "n").limit(sample)
    one = some.select(F.col("n").alias("a"), F.explode(F.slice(F.filter("aliases", lambda x: x != F.col("n")), 1, POSITIVE)).alias("b"), F.col("t").alias("ta"), F.col("t").alias("tb"), F.col("c").alias("ca"), F.col("c").alias("cb"), F.lit(1).alias("label"))
    words = rows.select("n", F.explode(F.array_distinct(F.split("n", " "))).alias("w"))
    count = words.groupBy("w").count().where("count > 1")
    rare = some.select(F.col("n").alias("a"), "aliases", F.col("t").alias("ta"), F.col("c").alias("ca"), F.explode(F.array_distinct(F.split("n", " "))).alias("w")).join(count, "w")
    rarest = rare.groupBy("a").agg(F.min(F.struct("count", "w", "aliases", "ta", "ca")).alias("x")).select("a", "x.*").drop("count")
    others = rarest.join(words.withColumnRenamed("n", "b"), "w").where(F.expr("a <> b AND NOT array_contains(aliases, b)"))
    near = others.withColumn("s", K.fuzzy_score("a", "b")).withColumn("_n", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))).where(F.col("_n") <= NEGATIVE)
    two = near.join(rows.select(F.col("n").alias("b"), F.col("t").alias("tb"), F.col("c").alias("cb")), "b").select("a", "b", "ta", "tb", "ca", "cb", F.lit(0).alias("label"))
    return one.unionByName(two).withColumn("held_out", F.pmod(F.xxhash64("a", "b"), F.lit(HELD_OUT)) == 0)


@dataclass
class AliasModel:
    """Weights over standardised features; accuracy and coverage of confident decisions on held-out pairs."""

    weights: list[float]
    bias: float
    mean: list[float]
    spread: list[float]
    accuracy: float = 0.0
    coverage: float = 0.0

    def probability(self, x: Column) -> Column:
        terms = [(F.get(x, F.lit(i)) - m) / s * w for i, (w, m, s) in enumerate(zip(self.weights, self.mean, self.spread, strict=True))]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(sum(terms[1:], terms[0]) + self.bias)))


def train(varieties: DataFrame, sample: int = SAMPLE) -> AliasModel | None:
    """The model, or None where the catalog has too few names or aliases to learn from."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    size = keyed(varieties).agg(F.count("*").alias("n"), F.sum(F.size("aliases")).alias("a")).first()
    if size["n"] < LEAST_NAMES or (size["a"] or 0) < LEAST_ALIASES:
        return None
    pairs = written(training_pairs(varieties, sample).withColumn("x", features(*(F.col(c) for c in ("a", "b", "ta", "tb", "ca", "cb")))))
    learn = pairs.where("not held_out")
    width = len(learn.select("x").first()["x"])
    stats = learn.agg(*(f(F.get("x", F.lit(i))).alias(f"{n}{i}") for i in range(width) for n, f in (("m", F.avg), ("s", F.stddev_pop)))).first()
    mean, spread = [stats[f"m{i}"] for i in range(width)], [stats[f"s{i}"] + 1e-9 for i in range(width)]
    z = F.array(*((F.get("x", F.lit(i)) - m) / s for i, (m, s) in enumerate(zip(mean, spread, strict=True))))
    fit = LogisticRegression(regParam=1e-3, standardization=False, maxIter=200, tol=1e-10).fit(learn.select("label", array_to_vector(z).alias("features")))
    model = AliasModel(fit.coefficients.tolist(), float(fit.intercept), mean, spread)
    p = model.probability(F.col("x"))
    sure = (p >= C.ALIAS_ACCEPT) | (p <= C.ALIAS_MINT)
    told = pairs.where("held_out").agg(F.avg(sure.cast("int")).alias("coverage"), F.avg(F.when(sure, ((p >= C.ALIAS_ACCEPT).cast("int") == F.col("label")).cast("int"))).alias("accuracy")).first()
    model.coverage, model.accuracy = told["coverage"] or 0.0, told["accuracy"] or 0.0
    return model


def decide(model: AliasModel, asked: DataFrame) -> DataFrame:
    """(query, cid, verdict, probability) of asked (query, a, ta, ca, cid, surfaces, tb, cb): a name against all surfaces of one variety, the strongest of which counts.

    Names that differ in spaces alone are never minted, names of two types never merged without review.
    """
    each = asked.select("query", "cid", "a", "ta", "ca", "tb", "cb", F.explode(F.filter(F.transform("surfaces", T.match_key), lambda x: x != "")).alias("b"))
    bare = lambda c: F.replace(F.col(c), F.lit(" "), F.lit(""))
    scored = each.withColumn("x", features(*(F.col(c) for c in ("a", "b", "ta", "tb", "ca", "cb")))).select("query", "cid", "ta", "tb", model.probability(F.col("x")).alias("p"), K.jaro_winkler_score(bare("a"), bare("b")).alias("d"))
    best = scored.groupBy("query", "cid").agg(F.max("p").alias("p"), F.max("d").alias("d"), F.bool_and((F.col("ta") == "") | (F.col("tb") == "") | (F.col("ta") == F.col("tb"))).alias("same"))
    return best.select("query", "cid", alias_decision(F.col("p"), F.col("d"), F.col("same")).alias("verdict"), F.round("p", 6).alias("probability"))


def curate_open(actions: DataFrame, varieties: DataFrame, model: AliasModel | None, floor: float = C.REVIEW_FLOOR) -> DataFrame:
    """(norm, type_norm, name, action, nearest) after curation: what was left for review is held against the likest variety (name, aliases, type, colors).

    The model says alias, mint or review.  Without a variety that reaches the floor there is nothing to be an alias of; that, and everything where there is no model, stays for review.
    """
    if model is None:
        return actions.withColumn("nearest", F.lit(None).cast("string"))
    known = written(keyed(varieties).withColumn("surfaces", F.array_union(F.array("n"), "aliases")))
    still = actions.where("action = 'review'").select("norm", "type_norm")
    names = known.select("n", F.explode("surfaces").alias("s"))
    near = likeness.fuzzy_pairs(still.select(F.col("norm").alias("name")), names.select(F.col("s").alias("name")), floor)
    best = near.join(names, F.col("b") == F.col("s")).groupBy(F.col("a").alias("norm")).agg(F.max_by("n", F.struct("score", F.col("n") == F.col("b"), "n")).alias("n"))
    asked = still.join(best, "norm").join(known, "n").select(F.struct("norm", "type_norm").alias("query"), F.col("norm").alias("a"), F.col("type_norm").alias("ta"), F.array().cast("array<string>").alias("ca"), F.col("n").alias("cid"), "surfaces", F.col("t").alias("tb"), F.col("c").alias("cb"))
    told = decide(model, asked).select("query.norm", "query.type_norm", F.col("cid").alias("nearest"), "verdict")
    return actions.join(told, ["norm", "type_norm"], "left").select("norm", "type_norm", "name", F.coalesce("verdict", "action").alias("action"), "nearest")
