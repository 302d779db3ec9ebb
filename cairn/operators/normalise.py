"""Controlled attributes, variety binding and reconciliation: each distinct raw value is resolved once and joined back."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import kernels as K
from ..functions import names as N
from ..functions import text as T
from . import resolve
from .joins import attach, dealt_join, written

FLAG = "struct<field:string,code:string,raw:string,best:string>"


def flag(field: str, code: str, raw: Column | None = None, best: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(F.lit(field).alias("field"), F.lit(code).alias("code"), (raw if raw is not None else none).alias("raw"), (best if best is not None else none).alias("best")).cast(FLAG)


def add_flags(rows: DataFrame, *found: Column) -> DataFrame:
    """Appends the flags that aren't null to review_flags."""
    old = F.coalesce("review_flags", F.array().cast(f"array<{FLAG}>")) if "review_flags" in rows.columns else F.array().cast(f"array<{FLAG}>")
    return rows.withColumn("review_flags", F.concat(old, F.array_compact(F.array(*found))))


def has_flag(flags: Column, code: str) -> Column:
    return F.exists(F.coalesce(flags, F.array().cast(f"array<{FLAG}>")), lambda f: f["code"] == code)


def attribute_lookup(vocabulary: DataFrame, synonyms: DataFrame, fallback: tuple[str, ...] = ("type",)) -> DataFrame:
    """(category, norm, canonical, id): the vocabulary, and for the fallback categories the synonyms whose key it lacks."""
    direct = vocabulary.groupBy("category", "norm").agg(F.min(F.struct("canonical", "id")).alias("x")).select("category", "norm", "x.*")
    target = synonyms.where(F.col("category").isin(*fallback)).groupBy("category", "norm").agg(F.min("target").alias("target"))
    by_name = direct.select("category", F.col("norm").alias("_t"), "canonical", "id")
    more = target.join(direct.select("category", "norm"), ["category", "norm"], "left_anti").withColumn("_t", T.match_key(F.col("target"))).join(by_name, ["category", "_t"])
    return direct.unionByName(more.select("category", "norm", "canonical", "id"))


def ids_of(lookup: DataFrame) -> DataFrame:
    """The lookup as `attach` reads it: x is (canonical, id)."""
    return lookup.select("category", F.col("norm").alias("_key"), F.struct("canonical", "id").alias("x"))


def closed(lookup: DataFrame, category: str, words: list[str]) -> dict[str, tuple[str, str]]:
    """Key -> (canonical, id) of the given words, as few as they are."""
    keys = lookup.sparkSession.createDataFrame([(w,) for w in words], "word string").select(T.match_key(F.col("word")).alias("norm")).distinct()
    return {r["norm"]: (r["canonical"], r["id"]) for r in lookup.where(F.col("category") == category).join(keys, "norm").collect()}


def pick(table: dict[str, tuple[str, str]], key: Column) -> Column:
    """(name, id) of a key in such a table; null for others."""
    text = lambda v: F.lit(v).cast("string")
    return F.coalesce(*(F.when(key == k, F.struct(text(n).alias("name"), text(i).alias("id"))) for k, (n, i) in table.items()), F.lit(None).cast("struct<name:string,id:string>"))


def normalise(rows: DataFrame, vocabulary: DataFrame, synonyms: DataFrame, type_words: list[str], overrides: DataFrame | None = None) -> DataFrame:
    """Adds {f}_id, {f}_name, {f}_confidence, {f}_method for each attribute, and review flags; nothing is guessed.

    rows have raw_{f}, raw_name, variety_match_key, raw_format; overrides (src_site, surrogate_key, {f}_name) win.  A value is resolved
    whole, else as several joined by signs; a type word in the name beats the tag; a block without finish is raw; finish and
    quality that stay open take their last resort, flagged.
    """
    lookup = attribute_lookup(vocabulary, synonyms)
    out = rows
    if overrides is not None:
        forced = attach(overrides.select("src_site", "surrogate_key", *(f"{f}_name" for f in C.ATTRIBUTES)), {f: T.match_key(F.col(f"{f}_name")) for f in C.ATTRIBUTES}, ids_of(lookup))
        forced = forced.select("src_site", "surrogate_key", *(F.col(f"{f}_name").alias(f"_{f}_forced") for f in C.ATTRIBUTES), *(F.col(f"_{f}")["id"].alias(f"_{f}_fid") for f in C.ATTRIBUTES))
        out = out.join(forced, ["src_site", "surrogate_key"], "left")
    else:
        out = out.withColumns({f"_{f}_{k}": F.lit(None).cast("string") for f in C.ATTRIBUTES for k in ("forced", "fid")})
    empty, of = F.lit(""), ("category",)
    raw = rows.select(F.explode(F.array(*(F.struct(F.lit(f).alias("category"), F.coalesce(f"raw_{f}", empty).alias("raw")) for f in C.ATTRIBUTES))).alias("x")).select("x.*").distinct()
    words = vocabulary.select("category", "norm", "canonical")
    whole = written(resolve.resolve_vocabulary(raw, words, synonyms, by=of))
    several = resolve.resolve_multi(whole.where("value is null and method = 'unresolved'"), words, synonyms, by=of).select("category", "raw", F.col("value").alias("_v"), F.col("confidence").alias("_c"), F.col("method").alias("_m"), "best")
    told = whole.join(several, ["category", "raw"], "left").select("category", "raw", F.coalesce("_v", "value").alias("value"), F.coalesce("_c", "confidence").alias("conf"), F.coalesce("_m", "method").alias("method"), "best")
    told = told.withColumn("norm", T.match_key(F.col("value"))).join(lookup.select("category", "norm", "id"), ["category", "norm"], "left")
    told = written(told.select("category", F.col("raw").alias("_key"), F.struct("value", "conf", "method", "best", "id").alias("x")))
    out = attach(out, {f: F.col(f"raw_{f}") for f in C.ATTRIBUTES}, told)
    new, flags = {}, []
    for f in C.ATTRIBUTES:
        on, x = F.col(f"_{f}_forced").isNotNull(), F.col(f"_{f}")
        new |= {f"{f}_name": F.when(on, F.col(f"_{f}_forced")).otherwise(x["value"]), f"{f}_confidence": F.when(on, "high").otherwise(x["conf"]), f"{f}_method": F.when(on, "override").otherwise(x["method"]), f"{f}_id": F.when(on, F.col(f"_{f}_fid")).otherwise(x["id"])}
        flags.append(F.when(~on & (x["method"] == "multi_value"), flag(f, "multi_value", F.col(f"raw_{f}"), x["value"])))
        flags.append(F.when(~on & x["id"].isNull() & ~x["method"].isin("synonym_none", "empty"), flag(f, "attr_unresolved", F.col(f"raw_{f}"), x["best"])))
    out = out.withColumns(new)
    out = add_flags(out, *flags).drop(*(f"_{f}" for f in C.ATTRIBUTES), *(f"_{f}_fid" for f in C.ATTRIBUTES), *(f"_{f}_forced" for f in C.ATTRIBUTES))
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    word = N.explicit_type_word(F.when(blank("variety_match_key"), F.col("raw_name")).otherwise(F.col("variety_match_key")), type_words)
    kinds = closed(lookup, "type", type_words)
    out = out.withColumn("_said", pick(kinds, T.match_key(word))).withColumns({"_wname": F.col("_said.name"), "_wid": F.col("_said.id")}).drop("_said")
    wins = F.col("_wid").isNotNull() & (F.lower(word) != F.lower(F.coalesce("type_name", F.lit(""))))
    out = out.withColumns({
        "type_name": F.when(wins, F.col("_wname")).otherwise(F.col("type_name")), "type_id": F.when(wins, F.col("_wid")).otherwise(F.col("type_id")),
        "type_confidence": F.when(wins, "high").otherwise(F.col("type_confidence")), "type_method": F.when(wins, "name_explicit").otherwise(F.col("type_method")),
    }).drop("_wname", "_wid")
    form = F.lower(F.trim(F.coalesce("raw_format", F.lit(""))))
    usual = F.coalesce(*(F.when(form == k, F.lit(v)) for k, v in C.LAST_FINISH.items()), F.lit(C.LAST_FINISH["slab"]))
    for f, default in (("finish", F.when(form == "block", F.lit(C.BLOCK_FINISH)).otherwise(usual)), ("quality", F.lit(C.LAST_QUALITY))):
        usable = closed(lookup, f, [C.BLOCK_FINISH, *C.LAST_FINISH.values()] if f == "finish" else [C.LAST_QUALITY])
        out = out.withColumn("_last", pick(usable, T.match_key(default))).withColumns({"_dname": F.col("_last.name"), "_did": F.col("_last.id")}).drop("_last")
        fill, block = F.col(f"{f}_id").isNull() & F.col("_did").isNotNull(), (form == "block") & F.lit(f == "finish")
        out = out.withColumn("_fill", fill).withColumn("_block", block)
        out = add_flags(out, F.when(F.col("_fill") & ~F.col("_block"), flag(f, "attr_last_resort", None, F.col("_dname"))))
        out = out.withColumns({
            f"{f}_name": F.when(F.col("_fill"), F.col("_dname")).otherwise(F.col(f"{f}_name")), f"{f}_id": F.when(F.col("_fill"), F.col("_did")).otherwise(F.col(f"{f}_id")),
            f"{f}_confidence": F.when(F.col("_fill"), "low").otherwise(F.col(f"{f}_confidence")),
            f"{f}_method": F.when(F.col("_fill") & F.col("_block"), "block_default_raw").when(F.col("_fill"), "last_resort_default").otherwise(F.col(f"{f}_method")),
        }).drop("_dname", "_did", "_fill", "_block")
    return out


def backbone_record(rows: DataFrame, backbone: DataFrame, name: Column, kind: Column) -> DataFrame:
    """Adds `record` of the variety by name, else by alias, under the same type; without a type the first by name.  backbone (ordinal, name, type, aliases, colors, finishes, qualities).

    A type that the name doesn't have gives null, never another type's record.
    """
    one = F.struct("name", "type", "colors", "finishes", "qualities")
    keyed = backbone.select("ordinal", T.match_key(F.col("name")).alias("_n"), T.match_key(F.col("type")).alias("_k"), F.transform(F.coalesce("aliases", F.array().cast("array<string>")), T.match_key).alias("_as"), one.alias("r"))
    both = keyed.select("_n", "_k", "ordinal", "r", F.lit(0).alias("at")).unionByName(keyed.select(F.explode("_as").alias("_n"), "_k", "ordinal", "r", F.lit(1).alias("at")).where("_n <> ''"))
    typed = both.groupBy("_n", "_k", "at").agg(F.min_by("r", "ordinal").alias("r"), F.min("ordinal").alias("o"))
    per = []
    for at in (0, 1):  # a name has few types: the vocabulary of types is closed
        mine = F.col("at") == at
        per += [F.map_from_entries(F.collect_list(F.when(mine, F.struct("_k", "r")))).alias(f"_t{at}"), F.min_by("r", F.when(mine, F.col("o"))).alias(f"_u{at}")]
    names = typed.groupBy("_n").agg(*per).withColumnRenamed("_n", "_qn")
    out = dealt_join(rows.withColumns({"_qn": T.match_key(name), "_qk": T.match_key(kind)}), names, "_qn", "left")
    by_name, by_alias = (F.when(F.col("_qk") == "", F.col(f"_u{k}")).otherwise(F.try_element_at(F.col(f"_t{k}"), F.col("_qk"))) for k in (0, 1))
    found = F.when(F.col("_u0").isNotNull(), by_name).otherwise(by_alias)  # aliases count only where no name does
    return out.withColumn("record", found).drop("_qn", "_qk", "_t0", "_u0", "_t1", "_u1")


def reconcile(rows: DataFrame, backbone: DataFrame, vocabulary: DataFrame, synonyms: DataFrame, slugs: list[str]) -> DataFrame:
    """Holds each row to its matched variety: the type is the key's, colour and quality are filled from it, finish and quality snap to the nearest allowed value at 80.

    Adds outcome: missing_variation, no_backbone_record, missing_leaf_child or validated.
    """
    lookup = attribute_lookup(vocabulary, synonyms)
    slug = F.regexp_replace(T.type_slug(F.coalesce("variation_key", F.lit("")), slugs), "_", " ")
    out = attach(rows.withColumn("_bound", F.col("variation_id").isNotNull()), {"type": T.match_key(F.when(F.col("variation_key").isNotNull(), slug))}, ids_of(lookup))
    out = out.withColumn("_ktype", F.col("_type.canonical")).drop("_type")
    out = out.withColumn("_new", F.coalesce("_ktype", F.when(F.col("type_name") != "", F.col("type_name")), "raw_type"))
    over = F.col("_bound") & F.col("_ktype").isNotNull() & (T.match_key(F.col("type_name")) != T.match_key(F.col("_ktype"))) & (F.coalesce("type_name", F.lit("")) != "")
    out = add_flags(out, F.when(over, flag("type", "type_overridden_by_variety", F.col("type_name"), F.col("_ktype"))))
    out = out.withColumn("type_method", F.when(~F.col("_bound"), F.col("type_method")).when(F.col("_ktype").isNotNull(), "variety_authoritative").otherwise("type_name_fallback"))
    out = out.withColumn("type_name", F.when(F.col("_bound") & F.col("_new").isNotNull(), F.col("_new")).otherwise(F.col("type_name"))).drop("_new", "_ktype")
    out = backbone_record(out, backbone, F.when(F.col("_bound"), F.col("variation_name")), F.col("type_name"))
    live = F.col("_bound") & F.col("record").isNotNull()
    missed = F.lit(False)
    for f, allowed, snap in (("color", "colors", False), ("finish", "finishes", True), ("quality", "qualities", True)):
        out = out.withColumn("_allowed", F.when(live, F.coalesce(F.col("record")[allowed], F.array().cast("array<string>"))))
        own = F.coalesce(F.col(f"{f}_name"), F.lit("")) != ""
        if f != "finish":
            fill = live & ~own & (F.size("_allowed") > 0)
            out = out.withColumn("_fill", fill).withColumn("_many", fill & (F.size("_allowed") > 1))
            out = out.withColumns({f"{f}_name": F.when(F.col("_fill"), F.get("_allowed", F.lit(0))).otherwise(F.col(f"{f}_name")), f"{f}_method": F.when(F.col("_many"), "from_variety_primary").when(F.col("_fill"), "from_variety").otherwise(F.col(f"{f}_method"))})
            out = add_flags(out, F.when(F.col("_many"), flag(f, "attr_from_variety", None, F.col(f"{f}_name")))).drop("_fill", "_many")
        fits = ~own & F.lit(f == "finish") | N.member(F.col(f"{f}_name"), F.col("_allowed")) | (F.coalesce(F.col(f"{f}_name"), F.lit("")) == "")
        out = out.withColumn("_miss", live & ~F.coalesce(fits, F.lit(False)))
        if snap:
            out = out.withColumn("_near", F.when(F.col("_miss"), K.nearest(T.match_key(F.col(f"{f}_name")), F.transform("_allowed", T.match_key))))
            hit = F.col("_miss") & (F.col("_near.score") >= C.LEAF_SNAP)
            out = out.withColumn("_hit", F.coalesce(hit, F.lit(False))).withColumn("_to", F.when(F.col("_hit"), F.get("_allowed", F.col("_near.at"))))
            out = add_flags(out, F.when(F.col("_hit"), flag(f, "leaf_snapped", F.col(f"{f}_name"), F.col("_to"))))
            out = out.withColumns({f"{f}_method": F.when(F.col("_hit"), F.format_string("snapped(%d)", F.bround(F.col("_near.score"), 0).cast("int"))).otherwise(F.col(f"{f}_method")), f"{f}_name": F.coalesce("_to", f"{f}_name"), "_miss": F.col("_miss") & ~F.col("_hit")}).drop("_near", "_hit", "_to")
        out = out.withColumn(f"_miss_{f}", F.col("_miss")).drop("_miss", "_allowed")
        missed = missed | F.col(f"_miss_{f}")
    outcome = F.when(~F.col("_bound"), "missing_variation").when(F.col("record").isNull(), "no_backbone_record").when(missed, "missing_leaf_child").otherwise("validated")
    out = out.withColumn("outcome", outcome).withColumn("missing_leaves", F.array_compact(F.array(*(F.when(F.col(f"_miss_{f}"), F.lit(f)) for f in ("color", "finish", "quality")))))
    out = attach(out.drop(*(f"{f}_id" for f in C.ATTRIBUTES)), {f: T.match_key(F.col(f"{f}_name")) for f in C.ATTRIBUTES}, ids_of(lookup))
    out = out.withColumns({f"{f}_id": F.col(f"_{f}")["id"] for f in C.ATTRIBUTES}).drop(*(f"_{f}" for f in C.ATTRIBUTES))
    return out.drop("_bound", "record", "_miss_color", "_miss_finish", "_miss_quality")


def variation_stage(rows: DataFrame, index: DataFrame, active: list[str], colours: list[str], generic: bool = False, suggestions: DataFrame | None = None) -> DataFrame:
    """Binds each row to a variety of its branch: (…, variation_id, variation_method, variation_confidence, action, write_back).

    rows (src_site, surrogate_key, branch, variety_match_key, raw_name, type_name, color_name, forced: an override's id); index as `resolve.surfaces` gives
    it, with `branch`.  Branches that aren't active and have no candidates are held; an override counts only if it is a candidate of the branch; rows without
    a name are a gap, or, for sources of generic descriptors, matched by the name without its format word and accepted only for that very name.
    """
    form = r"(?i)\b(" + "|".join(f"{c}s?" for c in C.CATEGORIES) + r")\b"
    own = F.trim(F.coalesce("variety_match_key", F.lit("")))
    described = T.collapse_ws(F.regexp_replace(F.coalesce("raw_name", F.lit("")), form, " "))
    asked = rows.withColumn("_generic", (own == "") & F.lit(generic) & (described != "")).withColumn("_q", F.when(own != "", own).when(F.col("_generic"), described).otherwise(""))
    asked = asked.withColumns({"_qb": T.match_key(F.col("type_name")), "_qc": T.match_key(F.col("color_name"))})
    known = index.groupBy("branch", "cid").agg(F.min("ckey").alias("ckey"))
    branches = F.col("branch").isin(*C.CATEGORIES)
    found = resolve.match_ladder(asked.where(branches).select("branch", F.col("_q").alias("query"), F.col("type_name").alias("qtype"), F.col("color_name").alias("qcolor")), index, colours=colours, suggestions=suggestions, by=("branch",))
    found = found.select("branch", F.col("query").alias("_q"), F.col("qblock").alias("_qb"), F.col("qcolor").alias("_qc"), "cid", "tier", "decision", "confidence", "candidates")
    out = asked.where(branches).join(found, ["branch", "_q", "_qb", "_qc"], "left")
    out = out.join(known.select("branch", F.col("cid").alias("forced"), F.lit(True).alias("_valid")), ["branch", "forced"], "left")
    out = out.join(known.select("branch", "cid", F.col("ckey").alias("_cname")), ["branch", "cid"], "left")
    out = out.join(known.groupBy("branch").agg(F.count("*").alias("_n")), "branch", "left")
    held = ~F.col("branch").isin(*active) & (F.coalesce("_n", F.lit(0)) == 0)
    same = F.col("_cname") == T.match_key(F.col("_q"))
    accept = (F.col("decision") == "accept") & (~F.col("_generic") | same)
    near = F.col("_generic") & (F.col("cid").isNotNull() | (F.coalesce(F.size("candidates"), F.lit(-1)) > 0))
    cases = [
        (held, "hold", F.lit("category_not_activated"), F.lit("none")), (F.col("_valid"), "bind", F.lit("override"), F.lit("high")), (F.col("_q") == "", "gap", F.lit("no_variety"), F.lit("none")),
        (accept, "bind", F.when(F.col("_generic"), F.concat(F.lit("descriptor_"), F.col("tier"))).otherwise(F.col("tier")), F.col("confidence")), (near, "review", F.lit("review_generic"), F.lit("low")),
        (F.col("decision") == "review", "review", F.col("tier"), F.lit("low")),
    ]
    pick = lambda k, last: F.coalesce(*(F.when(F.coalesce(c[0], F.lit(False)), F.lit(c[k]) if isinstance(c[k], str) else c[k]) for c in cases), last)
    out = out.withColumns({"action": pick(1, F.lit("gap")), "variation_method": pick(2, F.coalesce("tier", F.lit("no_candidate"))), "variation_confidence": pick(3, F.lit("none"))})
    out = out.withColumn("variation_id", F.when(F.col("action") != "bind", F.lit(None)).when(F.col("variation_method") == "override", F.col("forced")).otherwise(F.col("cid")))
    back = (F.col("action") == "bind") & ~F.col("_generic") & ~F.col("variation_method").isin("exact", "override")
    return out.withColumn("write_back", F.when(back, F.col("_q"))).drop("_generic", "_q", "_qb", "_qc", "cid", "tier", "decision", "confidence", "_valid", "_cname", "_n")
