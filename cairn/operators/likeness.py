"""Pairs of names whose likeness may reach a floor, found through an inverted index of rare character grams; none is lost.

Two names that are alike share many grams.  With at least `least` of its grams shared, a name shares one of any
`all - least + 1` of them, so it is enough to post each name under that many of its rarest grams, and to compare names
that meet under one.  Grams are numbered by their occurrence within the name, so that repeats count.

* Insertions and deletions: at a likeness of r (twice the longest common subsequence over both lengths) two names of S letters together
  share at least (1.5 r - 1) S - 1 of their letter pairs, and one at least from r = 0.8 on.  A second form with sorted words finds reordered names.
* Jaro-Winkler: a score of s needs a Jaro score of (s - 0.4) / 0.6, and that a number of common letters.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import kernels as K
from ..functions import text as T
from .joins import written


def numbered(grams: Column) -> Column:
    """Each gram with how often it stood before it."""
    return F.transform(grams, lambda g, i: F.concat(g, F.lit("\t"), F.size(F.filter(F.slice(grams, F.lit(1), i), lambda x: x == g)).cast("string")))


def letter_grams(name: Column, n: int) -> Column:
    """All runs of n letters in their order; a shorter name is one."""
    long = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(name) - (n - 1), F.lit(1))), lambda i: F.substring(name, i, F.lit(n)))
    return F.when(F.char_length(name) < n, F.array(name)).otherwise(long)


def met_under_rare_grams(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """(by…, a, b, common): names a of left and b of right, rows (by…, name, grams, least), that share one of their rarest grams, and how many they share."""
    seen = right.select(*by, F.explode("grams").alias("g")).groupBy(*by, "g").count()

    def posted(rows: DataFrame, to: str) -> DataFrame:
        each = rows.select(*by, "name", (F.size("grams") - F.col("least") + 1).alias("_keep"), F.explode("grams").alias("g")).join(seen, [*by, "g"], "left")
        some = each.groupBy(*by, "name", "_keep").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("count", F.lit(0)).alias("n"), "g"))).alias("gs"))
        return some.select(*by, F.col("name").alias(to), F.explode(F.slice("gs", F.lit(1), F.greatest("_keep", F.lit(1)))).alias("x")).select(*by, to, F.col("x.g").alias("g"))

    met = posted(left, "a").join(posted(right, "b"), [*by, "g"]).select(*by, "a", "b").distinct()
    own = lambda rows, to: rows.select(*by, F.col("name").alias(to), F.col("grams").alias(f"{to}_grams"))
    return met.join(own(left, "a"), [*by, "a"]).join(own(right, "b"), [*by, "b"]).withColumn("common", F.size(F.array_intersect("a_grams", "b_grams"))).drop("a_grams", "b_grams")


def _share(c: Column) -> Column:
    return F.greatest(F.ceil(c), F.lit(1)).cast("int")


def fuzzy_pairs(left: DataFrame, right: DataFrame, floor: float, by: tuple[str, ...] = ()) -> DataFrame:
    """(by…, a, b, score) of all names a of left and b of right (by…, name) whose fuzzy score reaches the floor, which is over 80.

    Empty names are like none.
    """
    if floor <= 80:
        raise ValueError("at 80 and less names need not share a pair of letters")
    at, r = [*by, "_form"], floor / 100
    rate = (1.5 * r - 1) * 2 / (2 - r)

    def forms(rows: DataFrame) -> DataFrame:
        one = rows.select(*by, "name").where("name <> ''").distinct()
        both = one.select(*by, F.col("name").alias("_whole"), F.explode(F.array(F.struct(F.lit(0).alias("_form"), F.col("name").alias("_t")), F.struct(F.lit(1).alias("_form"), T.tokenset(F.col("name")).alias("_t")))).alias("x")).select(*by, "_whole", "x.*")
        return both.select(*at, F.struct("_whole", "_t").alias("name"), numbered(letter_grams(F.col("_t"), 2)).alias("grams"), _share(F.char_length("_t") * rate - 1).alias("least"))

    met = met_under_rare_grams(written(forms(left)), written(forms(right)), at)
    x, y = F.char_length("a._t"), F.char_length("b._t")
    fits = (200 * F.least(x, y) >= floor * (x + y)) & (F.col("common") >= F.ceil((1.5 * r - 1) * (x + y) - 1))
    pairs = met.where((F.col("a._t") == F.col("b._t")) | fits).select(*by, F.col("a._whole").alias("a"), F.col("b._whole").alias("b")).distinct()
    return pairs.withColumn("score", K.fuzzy_score("a", "b")).where(F.col("score") >= floor)


def jaro_winkler_alike(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b, score) of all names a of left and b of right (name) whose Jaro-Winkler score is `least`, over 0.82, or more.  Empty names are like none."""
    if least <= 0.82:
        raise ValueError("under 0.82 the bonus of a common start does not apply to every score")
    share = 3 * (least - 0.4) / 0.6 - 1  # of common letters over one length and over the other, together

    def posted(rows: DataFrame) -> DataFrame:
        one = rows.select("name").where("name <> ''").distinct()
        # The shortest partner has so many letters that all of them are common: n of a's letters with n / len(a) + 1 >= share.
        return one.select("name", numbered(letter_grams(F.col("name"), 1)).alias("grams"), _share(F.char_length("name") * (share - 1) - 1e-9).alias("least"))

    met = met_under_rare_grams(written(posted(left)), written(posted(right)), [])
    x, y = F.char_length("a"), F.char_length("b")
    enough = F.col("common") * (x + y) >= (share - 1e-9) * x * y
    return met.where(enough).drop("common").withColumn("score", K.jaro_winkler_score("a", "b")).where(F.col("score") >= least)
