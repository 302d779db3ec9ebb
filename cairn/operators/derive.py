"""Derived fields: each ladder takes the first source that has a value and says which one it was."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import numbers as N
from ..functions import text as T


def rung(value: Column, method: str, confidence: str) -> Column:
    """A step of a ladder: null where the value is."""
    return F.when(value.isNotNull(), F.struct(value.alias("value"), F.lit(method).alias("method"), F.lit(confidence).alias("confidence")))


def ladder(*rungs: Column) -> Column:
    return F.coalesce(*rungs)


def format_ladder(override: Column, tag: Column, name: Column, structural: Column) -> Column:
    """override, explicit tag (singular or plural), word in the name, structure, slab."""
    known = list(C.CATEGORIES)
    singular = F.regexp_replace(F.lower(F.trim(F.coalesce(tag, F.lit("")))), "s$", "")
    word = F.regexp_extract(F.lower(F.coalesce(name, F.lit(""))), r"\b(" + "|".join(known) + r")s?\b", 1)
    return ladder(
        rung(F.when(F.trim(override) != "", F.lower(F.trim(override))), "override", "high"),
        rung(F.when(singular.isin(*known), singular), "tag", "high"),
        rung(F.when(word != "", word), "name_word", "medium"),
        rung(F.when(structural, F.lit("slab")), "structural", "medium"),
        rung(F.lit("slab"), "default", "low"),
    )


def bundle_ladder(form: Column, size: Column, slabs: Column, slabs_array: Column, total_m2: Column, slab_m2: Column) -> Column:
    """Blocks have none; else explicit size, slab count, array length, area division, standard area."""
    near = lambda r: F.when(F.bround(r, 0).between(1, 60) & (F.abs(r - F.bround(r, 0)) <= 0.15), F.bround(r, 0).cast("int"))
    divided = N.let(F.try_divide(N.parse_number(total_m2), N.parse_number(slab_m2)), near)
    standard = F.bround(N.parse_number(total_m2) / C.SLAB_AREA, 0).cast("int")
    entries = F.coalesce(F.json_array_length(slabs_array), F.when(slabs_array.rlike(r'"(n|numero)"\s*:'), F.regexp_count(slabs_array, F.lit(r'"(n|numero)"\s*:'))))
    steps = ladder(
        rung(N.positive_int(size), "explicit", "high"),
        rung(N.positive_int(slabs), "slab_count", "high"),
        rung(F.when(entries > 0, entries), "slabs_array", "high"),
        rung(divided, "area_division", "medium"),
        rung(F.when(standard.between(1, 60), standard), "standard_area", "low"),
    )
    return F.when(form == "block", F.lit(None)).otherwise(steps)


def inventory_ladder(slabs: Column, quantity: Column, stock_m2: Column, length: Column, width: Column) -> Column:
    """Slab count, stated quantity (nothing is a quantity too), stock area by face; capped."""
    exact = lambda c: F.when((c.try_cast("double") >= 0) & (c.try_cast("double") == F.floor(c.try_cast("double"))), c.try_cast("double").cast("int"))
    by_area = F.greatest(F.lit(1), F.floor(F.try_divide(N.parse_number(stock_m2), length * width)).cast("int"))
    cap = lambda c: F.when(c > C.INVENTORY_CAP, F.lit(C.INVENTORY_CAP)).otherwise(c)
    return ladder(
        rung(cap(exact(slabs)), "slab_count", "high"),
        rung(cap(exact(quantity)), "quantity", "high"),
        rung(cap(F.when((N.parse_number(stock_m2) > 0) & (length * width > 0), by_area)), "stock_area", "medium"),
    )


def origin_ladder(scraped: Column, type_known: Column, supplier_override: Column, mapped: Column, supplier_default: Column) -> Column:
    """The scraped country; where the type is known the supplier's override and the variety's countries; the supplier's own.

    Of several countries of a variety the supplier's own counts, else the first, to be reviewed (`origin_map_first`).
    """
    one = lambda c: F.when((F.trim(c) != "") & ~F.contains(c, F.lit(",")), F.upper(F.trim(c)))
    many = F.filter(F.transform(F.split(F.coalesce(mapped, F.lit("")), ","), lambda x: F.upper(F.trim(x))), lambda x: x != "")
    home = one(supplier_default)
    return ladder(
        rung(one(scraped), "scrape", "high"),
        rung(F.when(type_known, one(supplier_override)), "supplier_override", "high"),
        rung(F.when(type_known & (F.size(many) == 1), F.get(many, F.lit(0))), "origin_map", "high"),
        rung(F.when(type_known & F.array_contains(many, home), home), "origin_map", "high"),
        rung(F.when(type_known, F.get(many, F.lit(0))), "origin_map_first", "low"),
        rung(home, "supplier_default", "low"),
    )


def origin_mapped(rows: DataFrame, overrides: DataFrame, origins: DataFrame) -> DataFrame:
    """Adds supplier_country of (source, variety, type) and mapped_countries of (variety, type), by name key and only under the same type."""
    keyed = rows.withColumns({"_v": T.match_key(F.col("variety")), "_t": T.match_key(F.col("type"))})
    o = overrides.groupBy("source", T.match_key(F.col("variety")).alias("_v"), T.match_key(F.col("type")).alias("_t")).agg(F.min("country").alias("supplier_country"))
    m = origins.groupBy(T.match_key(F.col("variety")).alias("_v"), T.match_key(F.col("type")).alias("_t")).agg(F.min("countries").alias("mapped_countries"))
    return keyed.join(o, ["source", "_v", "_t"], "left").join(m, ["_v", "_t"], "left").drop("_v", "_t")


def overlay_origins(origins: DataFrame, decided: DataFrame) -> DataFrame:
    """(variety, type, countries): decisions replace the file's countries for the same name and type, and add new ones."""
    key = lambda d: d.withColumns({"_v": T.match_key(F.col("variety")), "_t": T.match_key(F.col("type"))})
    d = key(decided).groupBy("_v", "_t").agg(F.min(F.struct("countries", "variety", "type")).alias("d"))
    o = key(origins).groupBy("_v", "_t").agg(F.min(F.struct("countries", "variety", "type")).alias("o"))
    j = o.join(d, ["_v", "_t"], "full_outer")
    return j.select(F.coalesce("o.variety", "d.variety").alias("variety"), F.coalesce("o.type", "d.type").alias("type"), F.coalesce("d.countries", "o.countries").alias("countries"))


def resolve_ports(sources: DataFrame, ports: DataFrame) -> DataFrame:
    """(source, port_ids, unresolved) of each source's list of tokens, by id, location code or name; order is kept."""
    known = ports.select("port_id", F.explode(F.array_distinct(F.transform(F.array("port_id", "un_locode", "name"), T.match_key))).alias("_k")).where("_k <> ''").groupBy("_k").agg(F.min("port_id").alias("port_id"))
    each = sources.select("source", F.posexplode_outer("ports").alias("i", "token")).withColumn("_k", T.match_key(F.col("token"))).join(known, "_k", "left")
    per = each.groupBy("source").agg(F.array_sort(F.collect_list(F.when(F.col("port_id").isNotNull(), F.struct("i", "port_id")))).alias("p"), F.count("token").alias("n"))
    ids = F.array_distinct(F.transform("p", lambda x: x["port_id"]))
    return per.select("source", ids.alias("port_ids"), ((F.col("n") > 0) & (F.size("p") == 0)).alias("unresolved"))


def apply_overrides(rows: DataFrame, overrides: DataFrame, iso: list[str]) -> DataFrame:
    """Bundle size, origin, title and description that a person has set for (src_site, surrogate_key); an origin must be a country and clears the city."""
    o = overrides.select("src_site", "surrogate_key", *(F.col(c).alias(f"_{c}") for c in ("bundle_size", "origin", "title", "description")))
    j = rows.join(o, ["src_site", "surrogate_key"], "left")
    valid = F.upper(F.trim("_origin")).isin(*iso)
    return j.withColumns({
        "bundle_size": F.coalesce(N.positive_int(F.col("_bundle_size")), F.col("bundle_size")), "origin_city": F.when(valid, F.lit(None)).otherwise(F.col("origin_city")), "origin": F.when(valid, F.upper(F.trim("_origin"))).otherwise(F.col("origin")),
        "title": F.coalesce(F.when(F.trim("_title") != "", F.col("_title")), "title"), "description": F.coalesce(F.when(F.trim("_description") != "", F.col("_description")), "description"),
    }).drop("_bundle_size", "_origin", "_title", "_description")


def category(rows: DataFrame, vocabulary: DataFrame, own: dict[str, str] | None = None) -> DataFrame:
    """Adds category_pcat_id and category_method to rows with the format ladder's `format`: the id of the format's label, else the registry's own id (branch: id), else null.

    vocabulary (label, pcat_id, ordinal): the last id of a label counts, an empty one is none.  A format that is no category has no id; a row without a format has a method all the same.
    """
    branch = {b: f"{b.capitalize()}s" for b in C.CATEGORIES}
    told = vocabulary.where(F.col("label").isin(*branch.values()) & (F.trim("pcat_id") != "")).groupBy("label").agg(F.max_by("pcat_id", "ordinal").alias("_told"))
    label = F.coalesce(*(F.when(F.col("format.value") == b, F.lit(x)) for b, x in branch.items()))
    mine = F.coalesce(*(F.when((F.col("format.value") == b) & F.lit(x != ""), F.lit(x)) for b, x in (own or {}).items()), F.lit(None).cast("string"))
    j = rows.withColumn("_label", label).join(F.broadcast(told.withColumnRenamed("label", "_label")), "_label", "left")  # a row for each category at most
    return j.withColumns({"category_pcat_id": F.coalesce("_told", mine), "category_method": F.concat(F.lit("format:"), F.coalesce("format.method", F.lit("unknown")))}).drop("_label", "_told")


def dimension(raw: Column, form: Column, which: int) -> Column:
    """Metres rounded to three places with method and an out-of-range mark; 0, 1, 2: length, width, thickness."""
    parsed = N.parse_thickness(raw) if which == 2 else N.parse_face(raw)
    pick = lambda f: F.coalesce(*(F.when(form == name, F.lit(f(dims[which]))) for name, dims in C.DIMENSIONS.items()))

    def settled(x: Column) -> Column:
        fixed = N.centimetre_fix(x["v"], x["usual"], x["usual"])
        odd = (fixed > x["usual"] * 3) | (fixed < x["usual"] * 0.3)
        method = F.when(x["v"].isNull(), "default").when(fixed != x["v"], "cm_fix").otherwise("parsed")
        return F.struct(F.round(F.coalesce(fixed, x["usual"]), 3).alias("value"), method.alias("method"), F.coalesce(odd, F.lit(False)).alias("out_of_range"))

    return N.let(F.struct(parsed.alias("v"), pick(float).alias("usual")), settled)


def weight_tonnes(kg: Column, length: Column, width: Column, height: Column, density: Column) -> Column:
    stated = F.round(N.parse_number(kg) / 1000, 3)
    return ladder(rung(F.when(stated > 0, stated), "scrape", "high"), rung(F.round(length * width * height * F.coalesce(density, F.lit(C.DENSITY)) / 1000, 3), "volume_density", "low"))


def title(variety: Column, finish: Column, form: Column, material: Column) -> Column:
    """Variety, finish (not on blocks), and material unless the name has it."""
    has = F.array_contains(F.split(T.match_key(variety), " "), T.match_key(material))
    return T.title_case(F.concat_ws(" ", variety, F.when(form != "block", finish), F.when(~has, material)))


def description(given: Column, title_: Column, thickness_m: Column, finish: Column) -> Column:
    mm = F.round(thickness_m * 1000, 0).cast("int")
    made = F.concat(title_, F.lit("."), F.when(mm.between(3, 80), F.concat(F.lit(" Thickness "), mm.cast("string"), F.lit(" mm."))).otherwise(""), F.when(finish.isNotNull(), F.concat(F.lit(" Finish: "), F.lower(finish), F.lit("."))).otherwise(""))
    return F.when(F.char_length(F.trim(given)) > 20, given).otherwise(made)


def handle(variety: Column, finish: Column, source: Column, surrogate: Column) -> Column:
    return F.concat_ws("-", T.slugify(F.concat_ws(" ", variety, finish)), T.slugify(source), T.slugify(surrogate))


def first_bad_dimension() -> Column:
    """The first of length, width and height that is missing or not positive, unless its fetch failed (dimension_unavailable holds its name)."""
    held = lambda d: F.coalesce(F.array_contains("unavailable", d), F.lit(False))
    return F.coalesce(*(F.when((F.coalesce(F.col(d), F.lit(0.0)) <= 0) & ~held(d), F.lit(d)) for d in ("length", "width", "height")))


#: The row rules in order: name and the condition that rejects.
def row_rules(require_images: bool = True, detailed: bool = False) -> list[tuple[str, Column]]:
    """detailed: rows say which dimensions couldn't be fetched (unavailable) and whether one is a default, and have all three."""
    blank = lambda c: F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) == ""
    rules = [(f"{k}_missing", blank(f"{k}_id")) for k in ("type", "color", "finish", "quality", "variation")]
    rules += [("tree_gap", F.coalesce(F.col("tree_gap"), F.lit(False))), ("category_invalid", blank("category_id")), ("handle_missing", blank("handle")), ("owner_missing", blank("owner")), ("origin_missing", blank("origin"))]
    if require_images:
        rules.append(("no_image", (F.coalesce(F.col("images"), F.lit(0)) == 0) & ~F.coalesce(F.col("image_terminal"), F.lit(False))))
    if detailed:
        rules += [("dimension_unavailable", F.coalesce(F.size("unavailable"), F.lit(0)) > 0), ("dimension_defaulted", F.coalesce(F.col("dimension_defaulted"), F.lit(False))), ("dimension_invalid", first_bad_dimension().isNotNull())]
    else:
        rules += [("dimension_unavailable", F.coalesce(F.col("dimension_unavailable"), F.lit(False))), ("dimension_invalid", F.coalesce(F.col("length") <= 0, F.lit(False)))]
    rules += [("stock_undetermined", F.col("inventory").isNull())]
    return rules


def validate(rows: DataFrame, rules: list[tuple[str, Column]], emit_on_review: bool = False) -> DataFrame:
    """Adds reject_reasons and the route: reject, review or emit."""
    out = rows.withColumn("reject_reasons", F.array_compact(F.array(*(F.when(bad, F.lit(name)) for name, bad in rules))))
    flagged = F.lit(False) if emit_on_review else F.size("review_flags") > 0
    return out.withColumn("route", F.when(F.size("reject_reasons") > 0, "reject").when(flagged, "review").otherwise("emit"))


def product_state(rows: DataFrame, known: DataFrame) -> DataFrame:
    """new or existing by upper-case SKU, and whether the stock changed."""
    at = F.col("ordinal") if "ordinal" in known.columns else F.col("quantity")  # the last row of a SKU counts
    k = known.groupBy(F.upper("sku").alias("_sku")).agg(N.parse_number(F.max_by("quantity", at)).alias("_old"))
    out = rows.join(k, F.upper("sku") == F.col("_sku"), "left")
    return out.withColumn("state", F.when(F.col("_sku").isNull(), "new").otherwise("existing")).withColumn("product_changed", F.col("_sku").isNotNull() & ~F.col("_old").eqNullSafe(F.col("inventory").cast("double"))).drop("_sku", "_old")


def discontinued(known: DataFrame, rows: DataFrame, prefix: str) -> DataFrame:
    """Known SKUs of the source that the run didn't bring."""
    return known.where(F.upper("sku").startswith(prefix.upper())).join(rows.select(F.upper("sku").alias("_s")).distinct(), F.upper("sku") == F.col("_s"), "left_anti")


def delist_allowed(gone: int, known: int) -> bool:
    return known == 0 or gone <= C.DELIST_CAP * known


def publishable_images(images: DataFrame, discarded: DataFrame, enhanced: DataFrame) -> DataFrame:
    """(surrogate_key, keys, state) from (surrogate_key, i, url, sha256): content duplicates and discards go, enhanced ones stay in order."""
    fresh = images.join(discarded.select("sha256").distinct(), "sha256", "left_anti").groupBy("surrogate_key", "sha256").agg(F.min("i").alias("i"))
    ready = fresh.join(enhanced.groupBy("sha256").agg(F.min("key").alias("key")), "sha256", "left")
    per = ready.groupBy("surrogate_key").agg(F.transform(F.array_sort(F.collect_list(F.when(F.col("key").isNotNull(), F.struct("i", "key")))), lambda x: x["key"]).alias("keys"), F.count("*").alias("n"))
    every = images.groupBy("surrogate_key").agg(F.count("*").alias("raw"))
    out = every.join(per, "surrogate_key", "left").withColumn("keys", F.coalesce("keys", F.array().cast("array<string>")))
    return out.select("surrogate_key", "keys", F.when(F.size("keys") > 0, "ok").when(F.coalesce("n", F.lit(0)) == 0, "no_publishable_image").otherwise("no_image").alias("state"))
