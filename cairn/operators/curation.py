"""Curation of varieties and of the catalog's files: facts, combinations, additions, deletions, images."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions import names as N
from ..functions import kernels as K
from ..functions import text as T


def _texts(c) -> Column:
    return F.coalesce(c, F.array().cast("array<string>"))


def product_facts(products: DataFrame, ordinal: str) -> DataFrame:
    """(variation_id, category, type, colors, qualities, finishes): the last category and type that aren't blank, and the sets of the rest."""
    last = lambda c: F.max_by(F.when(F.trim(c) != "", F.col(c)), F.when(F.trim(c) != "", F.col(ordinal)))
    sets = lambda c: F.array_sort(F.collect_set(F.when(F.trim(c) != "", F.col(c))))
    rows = products.where(F.trim("variation_id") != "")
    return rows.groupBy("variation_id").agg(last("category").alias("category"), last("type").alias("type"), sets("color").alias("colors"), sets("quality").alias("qualities"), sets("finish").alias("finishes"))


def category_finishes(backbone: DataFrame, products: DataFrame, base: str = "slab", extended: str = "tile") -> DataFrame:
    """(category, finishes) from both sources, sorted; the extended category has the base's as well."""
    long = backbone.select("category", "finish").unionByName(products.select("category", "finish")).where("trim(finish) <> ''").distinct()
    more = long.unionByName(long.where(F.col("category") == base).withColumn("category", F.lit(extended)))
    return more.groupBy("category").agg(F.array_sort(F.collect_set("finish")).alias("finishes"))


def build_combinations(export: DataFrame, facts: DataFrame, backbone: DataFrame, finishes: DataFrame, assigned: DataFrame, default_color: str | None, default_quality: str | None, raw_finish: str | None, excluded: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(combinations, uncovered).  export (key, id, name, key_type: the type that the key names, or null); facts as `product_facts`, of ids.

    backbone (ordinal, key, category, name, type, colors, qualities).  The type comes from the key, else from the key's own backbone record, else
    from an assignment (norm, type).  Colours and qualities are the union of the product's, the backbone record's (by key, by category and name, or by
    name) and those of products of the same name; the catalogue's defaults where there is none.  Finishes are the category's, else raw.
    """
    rows = export.where("trim(id) <> '' and trim(key) <> ''").where(~N.looks_like_artifact(F.col("name")))
    if excluded is not None:
        rows = rows.join(excluded.select("key").distinct(), "key", "left_anti")
    rows = rows.withColumns({"category": F.get(F.split("key", "_"), F.lit(0)), "norm": T.match_key(F.col("name"))})
    record = F.struct("type", "colors", "qualities")
    posts = backbone.withColumn("norm", T.match_key(F.col("name")))
    first = lambda name, *keys: posts.groupBy(*keys).agg(F.min_by(record, "ordinal").alias(name))
    rows = rows.join(first("by_key", "key"), "key", "left").join(first("by_cat", "category", "norm"), ["category", "norm"], "left").join(first("by_name", "norm"), "norm", "left")
    own = facts.select(F.col("variation_id").alias("id"), F.col("colors").alias("own_c"), F.col("qualities").alias("own_q"))
    union = lambda c: F.array_distinct(F.flatten(F.collect_list(c)))
    named = rows.select("id", "norm").join(own, "id").groupBy("norm").agg(union("own_c").alias("name_c"), union("own_q").alias("name_q"))
    rows = rows.join(own, "id", "left").join(named, "norm", "left").join(assigned.groupBy("norm").agg(F.min("type").alias("given")), "norm", "left").join(finishes, "category", "left")
    post = F.coalesce("by_key", "by_cat", "by_name")
    known = lambda a, f, b: F.filter(F.array_distinct(F.concat(_texts(F.col(a)), _texts(post[f]), _texts(F.col(b)))), lambda x: x.isNotNull() & (x != ""))
    filled = lambda c, d: F.when(F.size(c) > 0, c).otherwise(F.array_compact(F.array(F.lit(d).cast("string"))))
    rows = rows.select(
        "category", "id", "key", "name", F.coalesce("key_type", F.col("by_key.type"), "given").alias("type"), filled(known("own_c", "colors", "name_c"), default_color).alias("color"),
        filled(known("own_q", "qualities", "name_q"), default_quality).alias("quality"), filled(_texts(F.col("finishes")), raw_finish).alias("finish"),
    )
    whole = F.col("type").isNotNull() & (F.size("color") > 0) & (F.size("quality") > 0) & (F.size("finish") > 0)
    combos = rows.where(whole).select("category", "type", "id", F.explode("finish").alias("finish"), "color", "quality").withColumn("color", F.explode("color")).withColumn("quality", F.explode("quality")).distinct()
    return combos, rows.where(~whole).select("key", "id", "name", "category")


def observed_attributes(rows: DataFrame, identity: list[str]) -> DataFrame:
    """The colours, finishes and qualities seen with each identity, sorted."""
    return rows.groupBy(*identity).agg(*(F.array_sort(F.collect_set(F.when(F.trim(c) != "", F.col(c)))).alias(f"{c}s") for c in ("color", "finish", "quality")))


def unresolved_attributes(rows: DataFrame) -> DataFrame:
    """(field, raw, n) of flags that say a value isn't resolved."""
    return rows.select(F.explode("review_flags").alias("f")).where("f.code = 'attr_unresolved'").groupBy("f.field", "f.raw").agg(F.count("*").alias("n"))


def attribute_curation(unresolved: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Adds the likest value of the field's vocabulary (category, canonical), its score, and a suggestion: synonym from 80, synonym? from 60, else new_value.

    A vocabulary is closed, so a field's values are one list; equal scores go to the first in order.
    """
    lists = vocabulary.groupBy(F.col("category").alias("field")).agg(F.array_sort(F.collect_set("canonical")).alias("_all"))
    near = unresolved.join(lists, "field", "left").withColumn("_near", K.nearest(T.match_key(F.col("raw")), F.transform("_all", T.match_key)))
    scored = near.withColumns({"nearest": F.get("_all", F.col("_near.at")), "score": F.round(F.coalesce("_near.score", F.lit(0.0)), 4)})
    return scored.withColumn("suggestion", F.when(F.col("score") >= 80, "synonym").when(F.col("score") >= 60, "synonym?").otherwise("new_value")).drop("_all", "_near")


def folded_aliases(groups: DataFrame, keys: list[str], name: str, aliases: str, order: list[Column]) -> DataFrame:
    """(keys…, name, aliases): the first row's name, and every row's names and aliases in order, each once whatever its case, the survivor's name not.

    One sort over all groups numbers the rows, and spellings are folded before they are gathered: no task holds a group's rows, only its different spellings.
    """
    ranked = groups.sort(*keys, *order).withColumn("_n", F.monotonically_increasing_id())
    told = F.filter(_texts(F.col(aliases)), lambda x: x.isNotNull() & (F.trim(x) != ""))
    each = ranked.select(*keys, "_n", F.posexplode(F.concat(F.array(name), told)).alias("_at", "_v"))
    seen = each.groupBy(*keys, "_at", "_v").agg(F.min("_n").alias("_n"))
    once = seen.groupBy(*keys, F.lower("_v").alias("_k")).agg(F.min(F.struct("_n", "_at", "_v")).alias("_x"))
    per = once.groupBy(*keys).agg(F.array_sort(F.collect_list("_x")).alias("_all"))
    rest = F.filter(F.transform(F.slice("_all", F.lit(2), F.size("_all")), lambda x: x["_v"]), lambda x: x.isNotNull() & (F.trim(x) != ""))
    return per.select(*keys, F.get("_all", F.lit(0))["_v"].alias(name), rest.alias("aliases"))


def consolidate_grades(rows: DataFrame, clean: Column) -> DataFrame:
    """(category, name, keys, aliases): rows whose cleaned name is another row's name fold into it, with all names as aliases, sorted."""
    named = rows.withColumn("_base", clean)
    per = named.groupBy("category", F.col("_base").alias("name")).agg(F.array_sort(F.collect_set("key")).alias("keys"), F.collect_set("name").alias("_names"), F.flatten(F.collect_list(_texts(F.col("aliases")))).alias("_aliases"))
    every = F.array_sort(F.array_distinct(F.filter(F.concat("_names", "_aliases"), lambda x: x != F.col("name"))))
    return per.withColumn("aliases", every).drop("_names", "_aliases")


def alias_additions(existing: DataFrame, found: DataFrame) -> DataFrame:
    """(key, new_aliases): spellings (key, alias) that a row hasn't as name or alias by key."""
    have = existing.select("key", F.transform(F.concat(F.array("name"), _texts(F.col("aliases"))), T.match_key).alias("_have"))
    new = found.join(have, "key").where(~F.array_contains("_have", T.match_key(F.col("alias"))) & (T.match_key(F.col("alias")) != ""))
    one = new.groupBy("key", T.match_key(F.col("alias")).alias("_k")).agg(F.min("alias").alias("alias"))
    return one.groupBy("key").agg(F.array_sort(F.collect_set("alias")).alias("new_aliases"))


def leaf_suggestions(rows: DataFrame) -> DataFrame:
    """(variety, attribute, value, verdict) from rows (variety, method, missing: struct<attribute, value>); exact and projection matches make it likely."""
    real = F.col("method").startswith("exact") | F.col("method").startswith("projection")
    each = rows.select("variety", real.alias("real"), F.explode("missing").alias("m")).select("variety", "m.attribute", "m.value", "real")
    return each.groupBy("variety", "attribute", "value").agg(F.when(F.bool_or("real"), "likely_real").otherwise("check").alias("verdict"))


def mirrored(posts: DataFrame, source: str, target: str) -> DataFrame:
    """The source category's records under another category, with its keys and labels."""
    return posts.where(F.col("category") == source).withColumns({"category": F.lit(target), "key": F.concat(F.lit(target), F.substring("key", F.lit(len(source) + 1), F.char_length("key")))})


def image_links(rows: DataFrame, stored: DataFrame | None, base: str) -> DataFrame:
    """Adds image: the link where the store has the key; where the store isn't known, where the export or a product has one."""
    link = F.concat(F.lit(base.rstrip("/") + "/"), F.col("key"), F.lit(".webp"))
    if stored is None:
        return rows.withColumn("image", F.when(F.col("has_export_image") | F.col("backed"), link).otherwise(""))
    return rows.join(stored.select("key", F.lit(True).alias("_is")).distinct(), "key", "left").withColumn("image", F.when(F.col("_is"), link).otherwise("")).drop("_is")


def keep_assigned(prior: DataFrame, uncovered: DataFrame) -> DataFrame:
    """(norm, type): an operator's assignments stay; names that became uncovered are added without a type."""
    new = uncovered.select(T.match_key(F.col("name")).alias("norm")).where("norm <> ''").distinct().withColumn("_new", F.lit(True))
    return prior.join(new, "norm", "full_outer").select("norm", F.coalesce("type", F.lit("")).alias("type"))


def delete_list(export: DataFrame, earlier: DataFrame, bare: Column, wrong_type: Column) -> DataFrame:
    """(key, reason) of exported rows that are bare codes, mistyped, or flagged earlier and still there."""
    flagged = earlier.select("key", F.lit(True).alias("_was")).distinct()
    reason = F.when(bare, "bare_code").when(wrong_type, "mistyped").when(F.col("_was"), "flagged_earlier")
    return export.join(flagged, "key", "left").withColumn("reason", reason).where("reason is not null").select("key", "reason")


def drop_deleted(rows: DataFrame, deleted: DataFrame) -> DataFrame:
    return rows.join(deleted.select("key").distinct(), "key", "left_anti")


def collect_products(frames: list[DataFrame]) -> DataFrame:
    """All sources' products; a frame with another header is an error, never filled."""
    out = frames[0]
    for f in frames[1:]:
        if f.columns != out.columns:
            raise ValueError(f"headers differ: {sorted(set(f.columns) ^ set(out.columns))}")
        out = out.unionByName(f)
    return out


def next_base(current: DataFrame, full: DataFrame, least: float = 0.5) -> DataFrame:
    """The full set becomes the base unless it is less than half of the current one."""
    n, m = current.count(), full.count()
    return current if m < least * n else full


def prompt_queue(new: DataFrame, backed: DataFrame, refreshed: DataFrame) -> DataFrame:
    """(key, why): new product-backed varieties, and those to be refreshed, which count first."""
    fresh = new.select("key").distinct().join(backed.select("key").distinct(), "key", "left_semi").withColumn("why", F.lit("new"))
    again = refreshed.select("key").distinct().withColumn("why", F.lit("refresh"))
    return again.unionByName(fresh.join(again.select("key"), "key", "left_anti"))


def pending_images(scraped: DataFrame, enhanced: DataFrame, discarded: DataFrame) -> DataFrame:
    done = enhanced.select("sha256").unionByName(discarded.select("sha256"))
    return scraped.select("sha256").distinct().join(done.distinct(), "sha256", "left_anti")


def orphan_images(images: DataFrame, catalog: DataFrame) -> DataFrame:
    """Images whose key the catalog lacks; an empty catalog makes none an orphan."""
    keys = catalog.select("key").distinct()
    return images.limit(0) if keys.isEmpty() else images.join(keys, "key", "left_anti")


def match_images(files: DataFrame, varieties: DataFrame) -> DataFrame:
    """(file, key, how): the file's own name, else its stem where only one variety has it, else ambiguous:n or none.  varieties (key, image, name)."""
    base = F.lower(F.regexp_replace("file", r"^.*/", ""))
    named = varieties.groupBy(F.lower(F.regexp_replace("image", r"^.*/", "")).alias("_b")).agg(F.min("key").alias("_bk"))
    stems = varieties.groupBy(T.image_stem(F.col("name")).alias("_s")).agg(F.min("key").alias("_sk"), F.count_distinct("key").alias("_n"))
    out = files.withColumns({"_b": base, "_s": T.image_stem(F.col("file"))}).join(named, "_b", "left").join(stems, "_s", "left")
    one = F.col("_n") == 1
    how = F.when(F.col("_bk").isNotNull(), "basename").when(one, "stem").when(F.col("_n") > 1, F.concat(F.lit("ambiguous:"), F.col("_n"))).otherwise("none")
    return out.select("file", F.coalesce("_bk", F.when(one, F.col("_sk"))).alias("key"), how.alias("how"))


def first_images(rows: DataFrame, ordinal: str) -> DataFrame:
    """(variation_id, url) of the first image of each variety."""
    return rows.where("trim(url) <> ''").groupBy("variation_id").agg(F.min_by("url", ordinal).alias("url"))


def slotted(keys: Column, form: Column) -> Column:
    """(oriented, product): a block's first four images are its sides, the rest and all others' are product images."""
    keys, block = _texts(keys), form == "block"
    return F.struct(
        F.when(block, F.slice(keys, 1, C.BLOCK_SLOTS)).otherwise(F.array().cast("array<string>")).alias("oriented"),
        F.slice(F.when(block, F.slice(keys, C.BLOCK_SLOTS + 1, 10_000)).otherwise(keys), 1, C.PRODUCT_SLOTS).alias("product"),
    )


def load_variants(export: DataFrame, branch: str, retired: DataFrame, order: list[Column]) -> DataFrame:
    """A branch's varieties: its keys, without bare codes and retired keys, one survivor for each type and name."""
    mine = export.where(F.col("key").startswith(f"{branch}_")).where(N.code_shape(F.col("name")) != "bare_code").join(retired.select("key").distinct(), "key", "left_anti")
    w = Window.partitionBy("type", T.match_key(F.col("name"))).orderBy(*order)
    return mine.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def evidence(field: str, raw: Column, best: Column, score: Column) -> Column:
    return F.struct(F.lit(field).alias("field"), F.coalesce(raw, F.lit("")).alias("raw"), best.alias("best"), F.round(score, 1).alias("score"))
