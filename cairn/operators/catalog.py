"""Catalog algebra: combinations, deltas, survivors, union fill, consistency."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions import text as T


def valid_combinations(rows: DataFrame, axes: list[str]) -> DataFrame:
    """Every combination of each row's lists, by generators; a set."""
    out = rows
    for a in axes:
        out = out.withColumn(a, F.explode(F.array_distinct(F.col(a))))
    return out.distinct()


def delta(current: DataFrame, previous: DataFrame) -> DataFrame:
    """(…, change): rows added to and removed from a set."""
    return current.exceptAll(previous).withColumn("change", F.lit("added")).unionByName(previous.exceptAll(current).withColumn("change", F.lit("removed")))


def same_rows(a: DataFrame, b: DataFrame) -> bool:
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def missing_from(rows: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return rows.select(*keys).distinct().join(known.select(*keys).distinct(), keys, "left_anti")


def consistency(checks: list[tuple[str, DataFrame, DataFrame, list[str]]]) -> DataFrame:
    """(check, violations) of subset tests (name, rows, known, keys)."""
    out = None
    for name, rows, known, keys in checks:
        one = missing_from(rows, known, keys).agg(F.count("*").alias("violations")).select(F.lit(name).alias("check"), "violations")
        out = one if out is None else out.unionByName(one)
    return out


def survivors(rows: DataFrame, identity: list[str], order: list[Column], alias: str) -> DataFrame:
    """The first row of each identity, with all rows' aliases folded in (sorted, distinct whatever the case)."""
    w = Window.partitionBy(*identity).orderBy(*order)
    ranked = rows.withColumn("_n", F.row_number().over(w))
    folded = rows.groupBy(*identity).agg(F.array_sort(F.collect_set(F.lower(alias))).alias("aliases"))
    return ranked.where("_n = 1").drop("_n").join(folded, identity)


def duplicate_identities(rows: DataFrame, identity: list[str], key: str) -> DataFrame:
    return rows.groupBy(*identity).agg(F.count_distinct(key).alias("keys")).where("keys > 1")


def union_fill(rows: DataFrame, categories: DataFrame, category: str, keys: list[str]) -> DataFrame:
    """(category, keys…) that a category lacks though another has them; categories is the closed list, of 1,000 at most."""
    names = [r[0] for r in categories.select(category).where(F.col(category).isNotNull()).distinct().limit(1_001).collect()]
    if len(names) > 1_000:
        raise ValueError("a closed list of categories has 1,000 values at most")
    every = rows.select(*keys).distinct().withColumn(category, F.explode(F.array(*map(F.lit, sorted(names)))))
    return every.join(rows.select(category, *keys).distinct(), [category, *keys], "left_anti")


def union_by_precedence(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of later frames win over those of earlier ones with the same keys."""
    out = None
    for rank, f in enumerate(frames):
        f = f.withColumn("_rank", F.lit(rank))
        out = f if out is None else out.unionByName(f)
    w = Window.partitionBy(*keys).orderBy(F.desc("_rank"))
    return out.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_rank")


def most_common(rows: DataFrame, group: list[str], value: str) -> DataFrame:
    """(group…, value, n): the commonest value; ties take the smallest, which is ours to choose."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*group, value).agg(F.count("*").alias("n"))
    return counts.groupBy(*group).agg(F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(value), F.max("n").alias("n"))


def category_sets(rows: DataFrame, group: str, value: str) -> DataFrame:
    return rows.groupBy(group).agg(F.array_sort(F.collect_set(value)).alias("values"))


def gap_queue(gaps: DataFrame, keys: list[str], ordinal: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*ordinal)
    return gaps.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def code_prefixes(names: DataFrame, name: str) -> DataFrame:
    """(head, rests): code-shaped first words that stand before two or more different rests, whatever their case."""
    text = F.lower(T.collapse_ws(F.coalesce(F.col(name), F.lit(""))))
    parts = names.select(F.regexp_extract(text, r"^(\S+) (.+)$", 1).alias("head"), F.regexp_extract(text, r"^(\S+) (.+)$", 2).alias("rest")).where("rest <> ''")
    return parts.where(T.looks_codey(F.col("head"))).groupBy("head").agg(F.count_distinct("rest").alias("rests")).where("rests >= 2")


def _vocabulary_hits(rows: DataFrame, columns: list[str], vocabulary: DataFrame) -> DataFrame:
    """(column, category, hit, total): how many of a column's filled values a category's vocabulary knows; pairs without a hit are absent."""
    long = rows.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column"), T.match_key(F.col(c)).alias("norm")) for c in columns))).alias("x")).select("x.*").where("norm <> ''")
    counts = long.groupBy("column", "norm").agg(F.count("*").alias("n"))
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    return counts.join(vocabulary.select("category", "norm").distinct(), "norm").groupBy("column", "category").agg(F.sum("n").alias("hit")).join(totals, "column")


def vocabulary_swap(rows: DataFrame, columns: list[str], vocabulary: DataFrame) -> DataFrame:
    """(column, category, rate): share of each column's values that each category's vocabulary knows."""
    return _vocabulary_hits(rows, columns, vocabulary).select("column", "category", F.round(F.col("hit") / F.col("total"), 4).alias("rate"))


def likely_swaps(rows: DataFrame, columns: dict[str, str], vocabulary: DataFrame) -> DataFrame:
    """(column, own, other): columns (by their own category) whose values another vocabulary clearly knows better.

    Needs SWAP_LEAST filled values, under half known by the own vocabulary, at least half by the other and a lead of
    SWAP_LEAD, so values that no vocabulary knows never count.  Of equal vocabularies the smallest name is reported.
    """
    own = F.create_map(*(F.lit(x) for pair in columns.items() for x in pair))[F.col("column")]
    hits = _vocabulary_hits(rows, list(columns), vocabulary).withColumn("own", own)
    named = hits.withColumn("mine", F.col("category") == F.col("own"))
    rates = named.groupBy("column", "own", "total").agg(
        F.coalesce(F.max(F.when(F.col("mine"), F.col("hit"))), F.lit(0)).alias("own_hit"),
        F.min(F.when(~F.col("mine"), F.struct((-F.col("hit")).alias("worst"), F.col("category").alias("other")))).alias("best"),
    )
    here, there = F.col("own_hit") / F.col("total"), -F.col("best.worst") / F.col("total")
    fits = (F.col("total") >= C.SWAP_LEAST) & (here < 0.5) & (there >= 0.5) & (there - here >= C.SWAP_LEAD)
    return rates.where(fits).select("column", "own", F.col("best.other").alias("other"))


def color_fill(rows: DataFrame, identity: list[str], color: str = "color") -> DataFrame:
    """Own colour, else a sibling's of the same identity, else the fallback."""
    w = Window.partitionBy(*identity)
    sibling = F.min(color).over(w)
    return rows.withColumn(color, F.coalesce(F.col(color), sibling, F.lit(C.FALLBACK_COLOR)))


def curate(names: DataFrame, known: DataFrame, rejected: DataFrame, confirmed: DataFrame) -> DataFrame:
    """(norm, type_norm, name, action): hold artefacts and codes, resolve what is known, mint only what is confirmed."""
    keyed = names.withColumn("norm", T.match_key(F.col("name"))).withColumn("type_norm", T.match_key(F.col("type"))).where("norm <> ''")
    one = keyed.groupBy("norm", "type_norm").agg(F.min("name").alias("name"))
    codey = F.exists(F.split("norm", " "), lambda w: w.rlike(r"\d")) | T.looks_codey(F.col("norm"))
    marks = lambda d, name: d.select(T.match_key(F.col("name")).alias("norm"), F.lit(True).alias(name)).distinct()
    typed = known.select(T.match_key(F.col("name")).alias("norm"), T.match_key(F.col("type")).alias("type_norm"), F.lit(True).alias("_known")).distinct()
    out = one.join(marks(rejected, "_rejected"), "norm", "left").join(typed, ["norm", "type_norm"], "left").join(marks(confirmed, "_confirmed"), "norm", "left")
    action = F.when(F.col("_rejected"), "reject").when(codey, "hold").when(F.col("_known"), "existing").when(F.col("_confirmed"), "mint").otherwise("review")
    return out.select("norm", "type_norm", "name", action.alias("action"))


def fan_out(minted: DataFrame, present: DataFrame) -> DataFrame:
    """A row for each branch whose core isn't present yet; branches come from a generator over the closed list."""
    every = minted.withColumn("branch", F.explode(F.array(*map(F.lit, C.CATEGORIES))))
    return every.join(present.select("branch", "norm").distinct(), ["branch", "norm"], "left_anti")


def real_delta(update: DataFrame, known: DataFrame) -> DataFrame:
    """Update rows that bring a new key, a new alias or another image; (key, aliases, image)."""
    k = known.select(F.col("key").alias("_key"), F.col("aliases").alias("_aliases"), F.col("image").alias("_image"))
    j = update.join(k, F.col("key") == F.col("_key"), "left")
    fold = lambda c: F.transform(F.coalesce(c, F.array().cast("array<string>")), T.match_key)
    new = F.col("_key").isNull() | (F.size(F.array_except(fold(F.col("aliases")), fold(F.col("_aliases")))) > 0) | ~F.col("image").eqNullSafe(F.col("_image"))
    return j.where(new).select(*update.columns)


def superseded(runs: DataFrame, source: str = "source", at: str = "run_id", complete: str = "complete") -> DataFrame:
    """Runs that may be deleted: neither a source's newest nor its newest complete one."""
    w = Window.partitionBy(source)
    newest, whole = F.max(at).over(w), F.max(F.when(F.col(complete), F.col(at))).over(w)
    return runs.withColumn("_a", newest).withColumn("_b", whole).where((F.col(at) != F.col("_a")) & ~F.col(at).eqNullSafe(F.col("_b"))).drop("_a", "_b")
