"""Keys, duplicates, vocabulary resolution and the variety ladder."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions import kernels as K
from ..functions import nearest
from ..functions import text as T
from . import likeness
from .joins import dealt_join, written


def keep_first(rows: DataFrame, key: Column, ordinal: list[str]) -> DataFrame:
    """The first row of each key; the order is given, never the partitions'."""
    w = Window.partitionBy(key).orderBy(*ordinal)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def flag_seen(rows: DataFrame, keys: list[Column], ordinal: list[str], value: str, blank: Column) -> DataFrame:
    """Adds `seen_before`, the value of the first row of the same keys, on all later rows whose keys aren't blank."""
    w = Window.partitionBy(*keys).orderBy(*ordinal)
    first = F.first(value).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return rows.withColumn("seen_before", F.when(~blank & (F.row_number().over(w) > 1), first))


def handle_collisions(rows: DataFrame, handle: str, surrogate: str, ordinal: list[str]) -> DataFrame:
    w = Window.partitionBy(handle).orderBy(*ordinal).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn("handle_collision", ~F.first(surrogate).over(w).eqNullSafe(F.col(surrogate)))


def resolve_vocabulary(values: DataFrame, vocabulary: DataFrame, synonyms: DataFrame, floor: float = C.ATTRIBUTE_FLOOR, near: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """(by…, raw, value, confidence, method) of each distinct raw value: synonym, exact, near, or unresolved.

    values (raw); vocabulary (norm, canonical); synonyms (norm, target), target `none` resolves to nothing; all with the columns
    of `by` (such as an attribute's name) if several vocabularies are asked at once.
    Only what no equality resolves is compared by likeness, with every word that can reach the floor (`likeness.fuzzy_pairs`).
    """
    at = list(by)
    raw = values.select(*at, "raw").distinct().withColumn("norm", T.match_key(F.col("raw")))
    words = vocabulary.select(*at, "norm", "canonical")
    named = words.select(*at, F.col("norm").alias("_tnorm"), F.col("canonical").alias("_named"))
    known = synonyms.select(*at, "norm", "target", T.match_key(F.col("target")).alias("_tnorm")).join(named, [*at, "_tnorm"], "left")
    known = known.select(*at, "norm", F.when(F.lower("target") == "none", "none").otherwise(F.coalesce("_named", "target")).alias("target"))
    hit = raw.join(known, [*at, "norm"], "left").join(words, [*at, "norm"], "left")
    method = (
        F.when(F.col("norm") == "", "empty").when(F.col("target") == "none", "synonym_none").when(F.col("target").isNotNull(), "synonym")
        .when(F.col("canonical").isNotNull(), "exact")
    )
    done = hit.withColumn("method", method)
    value = F.when(F.col("method") == "synonym", F.col("target")).when(F.col("method") == "exact", F.col("canonical"))
    if not near:
        sure = F.when(F.col("method").isNull() | (F.col("method") == "empty"), "none").otherwise("high")
        return done.select(*at, "raw", value.alias("value"), sure.alias("confidence"), F.coalesce("method", F.lit("unresolved")).alias("method"))
    done = written(done)  # distinct values: several joins build on them
    residue = done.where("method is null").select(*at, "raw", "norm")
    alike = likeness.fuzzy_pairs(residue.select(*at, F.col("norm").alias("name")), vocabulary.select(*at, F.col("norm").alias("name")), floor, by)
    scored = residue.join(alike.select(*at, F.col("a").alias("norm"), F.col("b").alias("_norm"), "score"), [*at, "norm"]).join(words.select(*at, F.col("norm").alias("_norm"), "canonical"), [*at, "_norm"])
    best = scored.groupBy(*at, "raw").agg(F.max(F.struct("score", "canonical")).alias("b"))
    out = done.join(best, [*at, "raw"], "left")
    close = F.col("method").isNull() & F.col("b").isNotNull()
    sure = F.when(close, "medium").when(F.col("method").isNull() | (F.col("method") == "empty"), "none").otherwise("high")
    return out.select(*at, "raw", F.when(close, F.col("b.canonical")).otherwise(value).alias("value"), sure.alias("confidence"), F.when(close, "fuzzy").otherwise(F.coalesce("method", F.lit("unresolved"))).alias("method"))


# Words around joined values that say nothing.
NOISE = ("dual", "combination", "combo", "mixed", "finish", "finishes")
_COMBINED = r"\+|&|/|\band\b"


def multi_parts(raw: Column) -> Column:
    """(combine, parts) of a value that names several: combined by + & / and, or listed by | and commas."""
    bare = F.regexp_replace(F.coalesce(raw, F.lit("")), rf"(?i)\b(?:{'|'.join(NOISE)})\b|[-–]", " ")
    parts = F.split(bare, rf"(?i)\s*(?:{_COMBINED}|\||,)\s*")
    return F.struct(bare.rlike(f"(?i){_COMBINED}").alias("combine"), F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "").alias("parts"))


def resolve_multi(values: DataFrame, vocabulary: DataFrame, synonyms: DataFrame, floor: float = C.ATTRIBUTE_FLOOR, near: bool = True, by: tuple[str, ...] = ()) -> DataFrame:
    """(by…, raw, value, confidence, method, best) of values that name several.

    A combination is the vocabulary's "A and B", in either order, or a suggestion of it where the
    vocabulary has such values; otherwise the first part that resolves counts.
    """
    at = list(by)
    parsed = values.select(*at, "raw").distinct().withColumn("m", multi_parts(F.col("raw")))
    each = parsed.where(F.size("m.parts") > 1).select(*at, "raw", "m.combine", F.posexplode("m.parts").alias("i", "part"))
    told = resolve_vocabulary(each.select(*at, F.col("part").alias("raw")), vocabulary, synonyms, floor, near, by).select(*at, F.col("raw").alias("part"), "value")
    found = each.join(told, [*at, "part"]).groupBy(*at, "raw", "combine").agg(F.array_sort(F.collect_list(F.when(F.col("value").isNotNull(), F.struct("i", "value")))).alias("p"))
    named = found.withColumn("names", F.array_distinct(F.transform("p", lambda x: x["value"])))
    composing = [tuple(r) for r in vocabulary.where(F.contains(F.lower("canonical"), F.lit(" and "))).select(F.lit(1), *at).distinct().limit(1_000).collect()]  # vocabularies, not words
    composes = F.lit(bool(composing)) if not at else F.struct(F.lit(1), *at).isin(*(F.struct(*map(F.lit, r)) for r in composing)) if composing else F.lit(False)
    a, b = F.get("names", F.lit(0)), F.get("names", F.lit(1))
    both = named.withColumns({"ab": F.concat_ws(" and ", a, b), "ba": F.concat_ws(" and ", b, a), "composes": composes})
    for c, to in (("ab", "one"), ("ba", "two")):
        both = both.withColumn("_k", T.match_key(F.col(c))).join(vocabulary.select(*at, F.col("norm").alias("_k"), F.col("canonical").alias(to)), [*at, "_k"], "left").drop("_k")
    joined = (F.size("names") > 1) & F.col("composes") & F.col("combine")
    method = F.when(F.size("names") == 0, "unresolved").when(joined & F.coalesce("one", "two").isNotNull(), "compound").when(joined, "compound_suggest").otherwise("multi_value")
    both = both.withColumn("method", method)
    value = F.when(F.col("method") == "compound", F.coalesce("one", "two")).when(F.col("method") == "multi_value", a)
    sure = F.when(F.col("method") == "compound", "medium").when(F.col("method") == "unresolved", "none").otherwise("low")
    out = both.select(*at, "raw", value.alias("value"), sure.alias("confidence"), "method", F.when(F.col("method") == "compound_suggest", F.col("ab")).alias("best"))
    none = F.lit(None).cast("string")
    return out.unionByName(parsed.where(F.size("m.parts") < 2).select(*at, "raw", none.alias("value"), F.lit("none").alias("confidence"), F.lit("unresolved").alias("method"), none.alias("best")))


# Spellings of one colour.
COLOUR_FORMS = {"gray": "grey", "golden": "gold"}


def colour_words(key: Column, colours: list[str]) -> Column:
    """The colours that a name key spells out, in one form each."""
    known = [c.lower() for c in colours]
    form = lambda w: F.coalesce(*(F.when(w == k, F.lit(v)) for k, v in COLOUR_FORMS.items()), w)
    return F.array_distinct(F.transform(F.filter(F.split(key, " "), lambda w: w.isin(*known) if known else F.lit(False)), form))


def colour_conflict(a: Column, b: Column) -> Column:
    """Both name a colour and none is common."""
    return (F.size(a) > 0) & (F.size(b) > 0) & ~F.arrays_overlap(a, b)


def surfaces(candidates: DataFrame, colours: list[str] = ()) -> DataFrame:
    """A row for each name and alias with its projections: (cid, ckey, block, colors, cwords, norm, ...).

    candidates (cid, name, aliases, type, and optionally colors); a candidate without colours has those that its name spells out.
    """
    own = F.col("colors") if "colors" in candidates.columns else F.array().cast("array<string>")
    ckey = T.match_key(F.col("name"))
    fixed = candidates.select(
        "cid", ckey.alias("ckey"), T.match_key(F.col("type")).alias("block"), F.transform(F.coalesce(own, F.array().cast("array<string>")), T.match_key).alias("_own"),
        colour_words(ckey, list(colours)).alias("cwords"), F.array_union(F.array("name"), F.coalesce("aliases", F.array().cast("array<string>"))).alias("_names"),
    )
    named = fixed.select("cid", "ckey", "block", F.when(F.size("_own") > 0, F.col("_own")).otherwise(F.col("cwords")).alias("colors"), "cwords", F.explode("_names").alias("surface"))
    keyed = named.withColumn("norm", T.match_key(F.col("surface"))).where("norm <> ''")
    one = keyed.groupBy("cid", "norm").agg(F.min(F.struct("ckey", "block", "colors", "cwords")).alias("x"), F.min("surface").alias("surface")).select("cid", "norm", "surface", "x.*")
    return one.withColumns({"compact": T.compact(F.col("norm")), "tokenset": T.tokenset(F.col("norm")), "deprefixed": T.deprefixed(F.col("surface")), "phonetic": K.phonetic_key("norm")})


TIERS = ("exact", "projection_compact", "projection_tokenset", "projection_deprefixed", "phonetic")
_ASKED = ["query", "qblock", "qcolor"]


def _tiers(rows: DataFrame) -> DataFrame:
    """A row for each tier's key."""
    keys = ("norm", "compact", "tokenset", "deprefixed", "phonetic")
    long = rows.withColumn("_t", F.explode(F.array(*(F.struct(F.lit(i).alias("rank"), F.col(k).alias("key")) for i, k in enumerate(keys)))))
    return long.withColumns({"rank": F.col("_t.rank"), "key": F.col("_t.key")}).drop("_t").where("key <> ''")


def tier_rows(index: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by…, cid, ckey, block, colors, cwords, rank, key): what the equality tiers join on, a row for each tier of each surface."""
    return _tiers(index).select(*by, "cid", "ckey", "block", "colors", "cwords", "rank", "key")


def _fits() -> Column:
    """The candidate's type and colours allow the query's."""
    kind = (F.col("qblock") == "") | (F.col("block") == "") | (F.col("qblock") == F.col("block"))
    return kind & ((F.col("qcolor") == "") | (F.size("colors") == 0) | F.array_contains("colors", F.col("qcolor")))


_NONE = "array<struct<cid:long,name:string,score:double>>"


def _choose(hits: DataFrame, asked_by: list[str]) -> DataFrame:
    """The first tier that settles a query: its only candidate, after narrowing by name, then by type and colour; names that stand twice in the exact tier go to review."""
    one, named = F.struct("cid", "ckey"), F.col("qnorm") == F.col("ckey")
    sets = {"every": F.lit(True), "own": named & (F.col("rank") < 4), "fit": _fits(), "both": named & (F.col("rank") < 4) & _fits()}
    per = hits.groupBy(*asked_by, "rank").agg(*(F.collect_set(F.when(c, one)).alias(k) for k, c in sets.items()))
    by_name = (F.size("every") > 1) & (F.size("own") > 0)
    per = per.withColumn("pool", F.when(by_name, F.col("own")).otherwise(F.col("every"))).withColumn("near", F.when(by_name, F.col("both")).otherwise(F.col("fit")))
    asked = (F.col("qblock") != "") | (F.col("qcolor") != "")
    blocked = (F.size("pool") > 1) & asked & (F.size("near") == 1)
    left = F.when(blocked, F.col("near")).otherwise(F.col("pool"))
    tier = F.concat(F.get(F.array(*map(F.lit, TIERS)), F.col("rank")), F.when(by_name, "_name").otherwise(""), F.when(blocked, "_blocked").otherwise(""))
    sure = F.when(F.col("rank") < 4, "high").otherwise("medium")
    none = F.lit(None).cast(_NONE)
    found = F.when(F.size(left) == 1, F.struct(F.get(left, F.lit(0))["cid"].alias("cid"), tier.alias("tier"), F.lit("accept").alias("decision"), sure.alias("confidence"), F.lit(100.0).alias("score"), none.alias("candidates")))
    dup = F.filter(F.array_sort(left), lambda x: F.size(F.filter(left, lambda y: y["ckey"] == x["ckey"])) > 1)
    shown = F.transform(F.slice(dup, 1, 3), lambda x: F.struct(x["cid"].alias("cid"), x["ckey"].alias("name"), F.lit(100.0).alias("score")))
    tied = F.when(
        (F.col("rank") == 0) & (F.size(left) > 1) & (F.size(dup) > 0),
        F.struct(F.lit(None).cast("long").alias("cid"), F.concat(tier, F.lit("_ambiguous")).alias("tier"), F.lit("review").alias("decision"), F.lit("low").alias("confidence"), F.lit(100.0).alias("score"), shown.cast(_NONE).alias("candidates")),
    )
    out = per.withColumn("x", F.coalesce(found, tied)).where("x is not null")
    return out.groupBy(*asked_by).agg(F.min_by("x", "rank").alias("x")).select(*asked_by, "x.*")


def match_ladder(
    queries: DataFrame, index: DataFrame, accept: float = C.AUTO_ACCEPT, floor: float = C.REVIEW_FLOOR, colours: list[str] = (), overrides: DataFrame | None = None,
    suggestions: DataFrame | None = None, by: tuple[str, ...] = (),
) -> DataFrame:
    """(by…, query, qblock, qcolor, cid, tier, decision, confidence, score, candidates) for distinct queries (by…, query, qtype, optionally qcolor).

    index: what `surfaces` or `tier_rows` gives, the latter perhaps stored (`candidate_index`); with the columns of `by`, such as a branch,
    queries meet candidates of their own only, all in one pass.

    An override (norm, cid) wins.  Exact, compact, token-set, deprefixed and phonetic tiers are one join on
    (tier, key), of which the first that settles a query counts.  The fuzzy tier runs only on what is left: all names that reach the
    floor are found through rare letter pairs and scored once, then held against type and colour.  A best score that
    candidates of one name share, or of a single word for a query of several, goes to review, with the
    three best candidates that reach the floor.  Suggestions (query, cid, score) by meaning are for review only.  cids are longs.
    """
    color = F.col("qcolor") if "qcolor" in queries.columns else F.lit("")
    asked_by = [*by, *_ASKED]
    q = queries.select(*by, "query", T.match_key(F.col("qtype")).alias("qblock"), T.match_key(color).alias("qcolor")).distinct().withColumn("qnorm", T.match_key(F.col("query"))).where("qnorm <> ''")
    q = q.withColumns({"compact": T.compact(F.col("qnorm")), "tokenset": T.tokenset(F.col("qnorm")), "deprefixed": T.deprefixed(F.col("query")), "phonetic": K.phonetic_key("qnorm"), "norm": F.col("qnorm"), "qwords": colour_words(F.col("qnorm"), list(colours))})
    asked = _tiers(q).select(*asked_by, "qnorm", "qwords", "rank", "key")
    held = index if "rank" in index.columns else tier_rows(index, by)
    hits = asked.join(held, [*by, "rank", "key"])
    sound = hits.where("rank = 4").where(_fits() & ~colour_conflict(F.col("qwords"), F.col("cwords"))).where(K.jaro_winkler_score("qnorm", "ckey") * 100 >= C.PHONETIC_GUARD)
    settled = _choose(hits.where("rank < 4").unionByName(sound), asked_by)
    if overrides is not None:
        forced = q.join(overrides.select(F.col("norm").alias("qnorm"), "cid"), "qnorm").select(*asked_by, "cid", F.lit("override").alias("tier"), F.lit("accept").alias("decision"), F.lit("high").alias("confidence"), F.lit(100.0).alias("score"), F.lit(None).cast(_NONE).alias("candidates"))
        settled = forced.unionByName(settled.join(forced.select(*asked_by), asked_by, "left_anti"))
    rest = q.select(*asked_by, "qnorm", "qwords").join(settled.select(*asked_by), asked_by, "left_anti")
    right = held.where("rank = 0").select(*by, "cid", "ckey", "block", "colors", "cwords", F.col("key").alias("_norm"))
    alike = likeness.fuzzy_pairs(rest.select(*by, F.col("qnorm").alias("name")), right.select(*by, F.col("_norm").alias("name")), floor, by)
    met = rest.join(alike.select(*by, F.col("a").alias("qnorm"), F.col("b").alias("_norm"), "score"), [*by, "qnorm"])
    scored = met.join(right, [*by, "_norm"]).where(_fits() & ~colour_conflict(F.col("qwords"), F.col("cwords"))).select(*asked_by, "qnorm", "cid", "ckey", "_norm", "score")
    each = scored.groupBy(*asked_by, "qnorm", "cid", "ckey").agg(F.max(F.struct("score", (F.col("_norm") == F.col("ckey")).alias("own"))).alias("b")).select(*asked_by, "qnorm", "cid", "ckey", "b.*")
    placed = each.withColumn("_n", F.row_number().over(Window.partitionBy(*asked_by).orderBy(F.desc("score"), F.desc("own"), "cid"))).withColumn("_top", F.max("score").over(Window.partitionBy(*asked_by)))
    at_top = F.when(F.col("score") == F.col("_top"), F.col("ckey"))
    three = F.array_sort(F.collect_list(F.when(F.col("_n") <= 3, F.struct("_n", "cid", F.col("ckey").alias("name"), "score"))))
    best = placed.groupBy(*asked_by, "qnorm").agg(F.min_by(F.struct("cid", "ckey"), "_n").alias("x"), F.max("score").alias("score"), (F.count(at_top) > F.count_distinct(at_top)).alias("tied"), three.alias("three"))
    guarded = (F.size(F.split("x.ckey", " ")) > 1) | (F.size(F.split("qnorm", " ")) < 2)
    sure = (F.col("score") >= accept) & guarded & ~F.col("tied")
    fuzzy = best.select(
        *asked_by, F.when(sure, F.col("x.cid")).alias("cid"), F.when(sure, "fuzzy").otherwise("review").alias("tier"), F.when(sure, "accept").otherwise("review").alias("decision"),
        F.when(sure, "medium").otherwise("low").alias("confidence"), F.round("score", 4).alias("score"), F.transform("three", lambda x: F.struct(x["cid"].alias("cid"), x["name"].alias("name"), x["score"].alias("score"))).cast(_NONE).alias("candidates"),
    )
    out = settled.unionByName(fuzzy)
    if suggestions is not None:
        near = rest.join(fuzzy.select(*asked_by), asked_by, "left_anti").join(suggestions.where(F.col("score") >= floor).groupBy("query").agg(F.max_by(F.struct("cid", "score"), F.struct("score", -F.col("cid"))).alias("s")), "query")
        shown = F.array(F.struct(F.col("s.cid").alias("cid"), F.lit(None).cast("string").alias("name"), F.col("s.score").cast("double").alias("score"))).cast(_NONE)
        out = out.unionByName(near.select(*asked_by, F.lit(None).cast("long").alias("cid"), F.lit("semantic_review").alias("tier"), F.lit("review").alias("decision"), F.lit("low").alias("confidence"), F.col("s.score").cast("double").alias("score"), shown.alias("candidates")))
    whole = q.select(*asked_by).join(out, asked_by, "left")
    return whole.withColumns({"tier": F.coalesce("tier", F.lit("no_candidate")), "decision": F.coalesce("decision", F.lit("gap")), "confidence": F.coalesce("confidence", F.lit("none"))})


def hashing_embedding(key: Column, dims: int = 64) -> Column:
    """Unit vector of character-trigram counts hashed by CRC-32."""
    padded = F.concat(F.lit("  "), key, F.lit("  "))
    grams = F.transform(F.sequence(F.lit(1), F.char_length(padded) - 2), lambda i: (F.crc32(F.substring(padded, i, F.lit(3)).cast("binary")) % dims).cast("int"))
    counts = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda d: F.size(F.filter(grams, lambda g: g == d)).cast("double"))
    norm = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(counts, lambda x: x / norm)


#: Candidates of a block, and blocks of them that a task holds at once.
CANDIDATES, HELD = 8_192, 8


def semantic_nearest(queries: DataFrame, candidates: DataFrame, vector: str = "embedding", most: int = 2_000) -> DataFrame:
    """(qid, cid, score) of the nearest other candidate of each query (qid, qvec), by cosine to six decimals; equal ones go to the smallest cid.  Exact.

    Queries are dealt into blocks of about `most`, candidates into such of about 8,192, and every block of the one meets every block of the
    other in one job; no task holds more than some of them.  A null vector, one with a null entry and one of another length have no score;
    a vector without direction (all zero, or not finite) scores NaN, which counts as the highest, as in SQL.
    """
    seen = candidates.where("cid is not null").agg(F.count("*").alias("n"), F.min("cid").alias("low"), F.max("cid").alias("high")).first()
    parts = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asked = queries.where("qid is not null").where((F.col("qid") != seen["low"]) | (F.col("qid") != seen["high"]) if seen["n"] else F.lit(False))
    c, blocks = _blocks(candidates.select(F.col("cid").alias("id"), F.col(vector).alias("v")), seen["n"], CANDIDATES)
    right = max(1, min(blocks, max(-(-blocks // HELD), int((4 * parts) ** 0.5))))
    q, blocks = _blocks(asked.select(F.col("qid").alias("id"), F.col("qvec").alias("v")), asked.count(), most)
    left = max(1, min(blocks, -(-4 * parts // right)))
    named = lambda rows, side, n: rows.repartition(n).select(*(F.col(x).alias(f"{side}_{x}") for x in rows.columns))
    pairs = named(q, "q", left).hint("shuffle_replicate_nl").crossJoin(named(c, "c", right))
    met = pairs.mapInArrow(nearest.likest, nearest.BEST)
    none = asked.select("qid", F.lit(None).cast("long").alias("cid"), F.lit(None).cast("double").alias("score"))
    place = F.when(F.col("score").isNotNull(), F.struct(F.round("score", 6), -F.col("cid")))
    return met.unionByName(none).groupBy("qid").agg(F.max_by("cid", place).alias("cid"), F.round(F.max("score"), 6).alias("score"))


def _blocks(rows: DataFrame, n: int, most: int) -> tuple[DataFrame, int]:
    """Rows (id, v) packed into blocks of about `most`, written, and how many blocks a length of vectors has."""
    blocks = max(1, -(-n // most))
    sound = rows.where("id is not null and v is not null and not exists(v, x -> x is null)")
    dealt = sound.select(F.col("id").cast("long").alias("id"), F.col("v").cast("array<double>").alias("v"), F.size("v").alias("_width"), F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int").alias("_block"))
    parts = min(blocks, max(-(-blocks // HELD), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    return written(dealt.repartition(parts, "_width", "_block").groupBy("_width", "_block").applyInArrow(nearest.packed, nearest.PACKED)), blocks


def alias_decision(probability: Column, despaced: Column, same_type: Column) -> Column:
    """alias, mint or review from the model's best probability, with the despaced-likeness net and the type gate."""
    return (
        F.when((probability >= C.ALIAS_ACCEPT) & same_type, "alias").when(probability >= C.ALIAS_ACCEPT, "review")
        .when((probability <= C.ALIAS_MINT) & (despaced < C.DESPACED_GUARD), "mint").otherwise("review")
    )


def new_aliases(found: DataFrame, known: DataFrame) -> DataFrame:
    """Accepted spellings (variation_id, alias) that are not written back yet; effective from the next run."""
    fold = found.groupBy("variation_id", F.lower("alias").alias("_k")).agg(F.min("alias").alias("alias"))
    return fold.join(known.select("variation_id", F.lower("alias").alias("_k")), ["variation_id", "_k"], "left_anti").drop("_k")


def variation_keys(rows: DataFrame, branches: list[DataFrame], variation: str = "variation_id") -> DataFrame:
    """Adds `variation_key` of the matched variety's id: of the first branch (id, key) that has it, null for none.

    Products hold on to the key: ids change when the other side gives its own.  The last of a branch's rows by key counts; an empty id has none.
    """
    every = reduce(DataFrame.unionByName, (b.select(F.col("id").cast("string").alias("_id"), "key", F.lit(i).alias("_at")) for i, b in enumerate(branches)))
    first = every.where("_id <> ''").groupBy("_id", "_at").agg(F.max("key").alias("key")).groupBy("_id").agg(F.min_by("key", "_at").alias("variation_key"))
    return dealt_join(rows.withColumn("_id", F.col(variation).cast("string")), first, "_id", "left").drop("_id")
