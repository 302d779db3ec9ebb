"""Queries of the stages, contracts, curation and ledger over the driver's tables, with the SQL that checks them; every query reads its whole tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import names as M
from ..functions import numbers as N
from ..functions import text as T
from ..operators import catalog, contracts, control, curation, derive, health, ledger, normalise, resolve
from ..sources import sinks
from .catalog_queries import LCS, query, t


def _word(n: int):
    return F.get(F.split("p_name", " "), F.lit(n))


# A closed vocabulary (category, canonical, id) and synonyms (category, norm, target) over the words of part names and types.
_VOCABULARY = [("type", x.title(), f"t{i}") for i, x in enumerate(("standard", "medium", "large", "small"))] + [("color", x.title(), f"c{i}") for i, x in enumerate(("red", "blue", "hot", "cold"))] + [
    ("finish", x.title(), f"f{i}") for i, x in enumerate(("plate", "rod", "gear", "raw", "polished", "honed"))] + [("quality", "A", "q0"), ("quality", "B", "q1")]
_SYNONYMS = [("color", "new", "Red"), ("color", "old", "none"), ("finish", "bolt", "Rod"), ("type", "promo", "Large")]


def _vocabulary(spark):
    return spark.createDataFrame([(c, v.lower(), v, i) for c, v, i in _VOCABULARY], "category string, norm string, canonical string, id string")


def _synonyms(spark):
    return spark.createDataFrame(_SYNONYMS, "category string, norm string, target string")


_V = "v AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{n}', '{i}')" for c, n, i in _VOCABULARY) + ") AS x(category, name, id))"
_LISTED = f"""
WITH {_V}, r AS (SELECT p_partkey, p_size % 3 AS form, CASE WHEN p_type = 'PROMO' THEN 'Large' WHEN p_type IN ('STANDARD', 'MEDIUM', 'LARGE', 'SMALL') THEN p_type[1] || lower(p_type[2:]) END AS type_name,
  CASE string_split(p_name, ' ')[1] WHEN 'new' THEN 'Red' WHEN 'red' THEN 'Red' WHEN 'blue' THEN 'Blue' WHEN 'hot' THEN 'Hot' WHEN 'cold' THEN 'Cold' END AS color_name, string_split(p_name, ' ')[1] = 'old' AS none,
  CASE string_split(p_name, ' ')[2] WHEN 'bolt' THEN 'Rod' WHEN 'plate' THEN 'Plate' WHEN 'rod' THEN 'Rod' WHEN 'gear' THEN 'Gear' END AS f0, CASE WHEN p_size > 40 THEN 'B' WHEN p_size > 20 THEN 'A' END AS q0 FROM part),
n AS (SELECT *, coalesce(f0, CASE form WHEN 0 THEN 'Raw' WHEN 1 THEN 'Honed' ELSE 'Polished' END) AS finish_name, CASE WHEN f0 IS NULL THEN CASE form WHEN 0 THEN 'block_default_raw' ELSE 'last_resort_default' END END AS f_method, coalesce(q0, 'A') AS quality_name FROM r)
"""


def _listed(spark, sf):
    p = t(spark, sf, "part")
    rows = p.select(
        "p_partkey", F.lit("s").alias("src_site"), F.col("p_partkey").cast("string").alias("surrogate_key"), F.col("p_type").alias("raw_type"), _word(0).alias("raw_color"), _word(1).alias("raw_finish"),
        F.when(F.col("p_size") > 40, "B").when(F.col("p_size") > 20, "a").alias("raw_quality"), F.col("p_name").alias("raw_name"), F.lit("").alias("variety_match_key"),
        F.when(F.col("p_size") % 3 == 0, "Block").when(F.col("p_size") % 3 == 1, "tile").otherwise("slab").alias("raw_format"),
    )
    return normalise.normalise(rows, _vocabulary(spark), _synonyms(spark), ["standard", "marble"])


@query(_LISTED + """
SELECT p_partkey, type_name, t.id AS type_id, color_name, c.id AS color_id, finish_name, f.id AS finish_id, coalesce(f_method, 'x') AS finish_method, quality_name, q.id AS quality_id,
list_aggregate(list_sort(list_filter([CASE WHEN type_name IS NULL THEN 'type:attr_unresolved' END, CASE WHEN color_name IS NULL AND NOT none THEN 'color:attr_unresolved' END, CASE WHEN f0 IS NULL THEN 'finish:attr_unresolved' END,
  CASE WHEN f0 IS NULL AND form <> 0 THEN 'finish:attr_last_resort' END, CASE WHEN q0 IS NULL THEN 'quality:attr_last_resort' END], lambda x: x IS NOT NULL)), 'string_agg', ',') AS flags
FROM n LEFT JOIN v t ON t.category = 'type' AND t.name = type_name LEFT JOIN v c ON c.category = 'color' AND c.name = color_name JOIN v f ON f.category = 'finish' AND f.name = finish_name JOIN v q ON q.category = 'quality' AND q.name = quality_name
""")
def attribute_normalise(spark, sf):
    out = _listed(spark, sf)
    method = F.when(F.col("finish_method").isin("block_default_raw", "last_resort_default"), F.col("finish_method")).otherwise("x")
    flags = F.array_join(F.array_sort(F.transform("review_flags", lambda f: F.concat_ws(":", f["field"], f["code"]))), ",")
    return out.select("p_partkey", "type_name", "type_id", "color_name", "color_id", "finish_name", "finish_id", method.alias("finish_method"), "quality_name", "quality_id", F.when(flags != "", flags).alias("flags"))


@query(_LISTED + """
, u AS (SELECT 'type' AS field, p_type AS raw FROM part JOIN n USING (p_partkey) WHERE type_name IS NULL UNION ALL SELECT 'color', string_split(p_name, ' ')[1] FROM part JOIN n USING (p_partkey) WHERE color_name IS NULL AND NOT none
  UNION ALL SELECT 'finish', string_split(p_name, ' ')[2] FROM part JOIN n USING (p_partkey) WHERE f0 IS NULL)
, k AS (SELECT field, raw, count(*) AS n FROM u GROUP BY 1, 2), p AS (SELECT k.field || ':' || raw AS a, v.name AS b, [lower(raw), lower(v.name)] AS t FROM k JOIN v ON v.category = k.field),
""" + LCS + """, z AS (SELECT a, b, 200.0 * row[n + 1] / (m + n) AS score FROM l), y AS (SELECT a, max(score) AS score, min(b) AS nearest FROM (SELECT *, max(score) OVER (PARTITION BY a) AS top FROM z) WHERE score = top GROUP BY a)
SELECT field, raw, n, CASE WHEN score > 0 THEN nearest END AS nearest, round(coalesce(score, 0), 4) AS score, CASE WHEN score >= 80 THEN 'synonym' WHEN score >= 60 THEN 'synonym?' ELSE 'new_value' END AS suggestion FROM k LEFT JOIN y ON y.a = field || ':' || raw
""")
def unresolved_attributes(spark, sf):
    return curation.attribute_curation(curation.unresolved_attributes(_listed(spark, sf)), _vocabulary(spark))


@query(_LISTED + """
SELECT stage, (SELECT count(*) FROM n) AS rows, hits, CASE WHEN hits / (SELECT count(*) FROM n) >= lim THEN 'DEGRADED' ELSE 'OK' END AS status FROM (
SELECT 'normalise' AS stage, (SELECT count(*) FROM n WHERE type_name IS NULL OR (color_name IS NULL AND NOT none) OR f0 IS NULL) AS hits, 0.25 AS lim UNION ALL SELECT 'match', (SELECT count(*) FROM n WHERE type_name IS NULL), 0.5
UNION ALL SELECT 'derive', (SELECT count(*) FROM n WHERE form = 0), 0.25)
""")
def stage_status(spark, sf):
    out = _listed(spark, sf)
    return contracts.stage_status(out, {"normalise": normalise.has_flag(F.col("review_flags"), "attr_unresolved"), "match": F.col("type_name").isNull(), "derive": F.lower("raw_format") == "block"})


_BACKBONE = "b AS (SELECT p_brand, CASE WHEN min(p_size) % 2 = 0 THEN ['Red', 'Blue'] ELSE ['Hot'] END AS colors, CASE WHEN min(p_size) % 3 = 0 THEN ['Rod'] ELSE ['Plates', 'Gear'] END AS finishes FROM part GROUP BY 1)"


@query(_LISTED + f""", {_BACKBONE.strip()},
m AS (SELECT n.*, p_brand, p_size % 7 = 0 AS unbound, b.colors, b.finishes, p_brand LIKE '%1' AS no_record FROM n JOIN part USING (p_partkey) JOIN b USING (p_brand)),
k AS (SELECT *, CASE WHEN color_name IS NULL THEN colors[1] ELSE color_name END AS c2, CASE WHEN finish_name = 'Plate' AND list_contains(finishes, 'Plates') THEN 'Plates' ELSE finish_name END AS f2 FROM m)
SELECT p_partkey, CASE WHEN unbound THEN 'missing_variation' WHEN no_record THEN 'no_backbone_record' WHEN NOT list_contains(colors, c2) OR NOT list_contains(finishes, f2) THEN 'missing_leaf_child' ELSE 'validated' END AS outcome,
CASE WHEN unbound THEN type_name ELSE 'Medium' END AS type_name, CASE WHEN unbound OR no_record THEN color_name ELSE c2 END AS color_name, CASE WHEN unbound OR no_record THEN finish_name ELSE f2 END AS finish_name,
CASE WHEN unbound OR no_record THEN '' ELSE array_to_string(list_filter([CASE WHEN NOT list_contains(colors, c2) THEN 'color' END, CASE WHEN NOT list_contains(finishes, f2) THEN 'finish' END], lambda x: x IS NOT NULL), ',') END AS missing FROM k
""")
def reconcile_leaf(spark, sf):
    p = t(spark, sf, "part")
    lists = p.groupBy("p_brand").agg(F.min("p_size").alias("s"))
    a = lambda *x: F.array(*map(F.lit, x))
    backbone = lists.where(~F.col("p_brand").endswith("1")).select(
        F.col("s").alias("ordinal"), F.col("p_brand").alias("name"), F.lit("medium").alias("type"), F.array().cast("array<string>").alias("aliases"),
        F.when(F.col("s") % 2 == 0, a("Red", "Blue")).otherwise(a("Hot")).alias("colors"), F.when(F.col("s") % 3 == 0, a("Rod")).otherwise(a("Plates", "Gear")).alias("finishes"), a("A", "B").alias("qualities"),
    )
    bound = p.select("p_partkey", F.when(F.col("p_size") % 7 != 0, F.col("p_partkey")).alias("variation_id"), F.when(F.col("p_size") % 7 != 0, F.lit("slab_medium_x")).alias("variation_key"), F.col("p_brand").alias("variation_name"))
    rows = _listed(spark, sf).join(bound, "p_partkey")
    out = normalise.reconcile(rows, backbone, _vocabulary(spark), _synonyms(spark), ["medium", "large"])
    return out.select("p_partkey", "outcome", "type_name", "color_name", "finish_name", F.array_join("missing_leaves", ",").alias("missing"))


@query("""
WITH c AS (SELECT p_name, p_type, min(p_partkey) AS cid FROM part GROUP BY 1, 2), n AS (SELECT p_name, count(*) AS k, min(cid) AS one FROM c GROUP BY 1),
q AS (SELECT p_partkey, p_name, p_type, p_size % 19 = 0 AS untyped, CASE WHEN p_size % 5 = 0 THEN 'block' WHEN p_size % 5 = 1 THEN 'tile' ELSE 'slab' END AS branch, p_size % 11 = 0 AS blank, p_size % 13 = 0 AS forced FROM part)
SELECT p_partkey, CASE WHEN branch = 'tile' THEN 'hold' WHEN forced THEN 'bind' WHEN blank THEN 'gap' WHEN k > 1 AND untyped THEN 'review' ELSE 'bind' END AS action,
CASE WHEN branch = 'tile' THEN NULL WHEN forced THEN 0 WHEN blank THEN NULL WHEN k = 1 THEN one WHEN NOT untyped THEN cid END AS variation_id,
CASE WHEN branch = 'tile' THEN 'category_not_activated' WHEN forced THEN 'override' WHEN blank THEN 'no_variety' WHEN k = 1 THEN 'exact' WHEN untyped THEN 'exact_name_ambiguous' ELSE 'exact_name_blocked' END AS method
FROM q JOIN c ON c.p_name = q.p_name AND c.p_type = q.p_type JOIN n ON n.p_name = q.p_name
""")
def variation_stage(spark, sf):
    p = t(spark, sf, "part")
    known = p.groupBy(F.col("p_name").alias("name"), F.col("p_type").alias("type")).agg(F.min("p_partkey").cast("long").alias("cid")).withColumn("aliases", F.array().cast("array<string>"))
    index = resolve.surfaces(known).withColumn("branch", F.explode(F.array(F.lit("slab"), F.lit("block"))))
    s = F.col("p_size")
    rows = p.select(
        "p_partkey", F.when(s % 5 == 0, "block").when(s % 5 == 1, "tile").otherwise("slab").alias("branch"), F.when(s % 11 == 0, "").otherwise(F.col("p_name")).alias("variety_match_key"), F.col("p_name").alias("raw_name"),
        F.when(s % 19 == 0, "").otherwise(F.col("p_type")).alias("type_name"), F.lit("").alias("color_name"), F.when(s % 13 == 0, 0).when(s % 17 == 0, -1).cast("long").alias("forced"),
    )
    return normalise.variation_stage(rows, index, ["slab", "block"], []).select("p_partkey", "action", "variation_id", F.col("variation_method").alias("method"))


# ---- contracts ------------------------------------------------------------------------------------------------------

_GATE = "round(v / (SELECT count(*) FROM part), 4) AS fraction, CASE WHEN round(v / (SELECT count(*) FROM part), 4) >= 0.9 THEN 'FAILED' WHEN round(v / (SELECT count(*) FROM part), 4) >= 0.5 THEN 'DEGRADED' ELSE 'OK' END AS status"


@query(f"""
SELECT invariant, v AS violations, {_GATE} FROM (SELECT 'ingest_missing_variety_name' AS invariant, count_if(p_size % 4 = 0) AS v FROM part UNION ALL SELECT 'ingest_missing_dimensions_source', count_if(p_size > 20) FROM part
UNION ALL SELECT 'ingest_missing_image_source', count_if(p_size < 48) FROM part UNION ALL SELECT 'process_origin_missing', count_if(p_type = 'PROMO') FROM part)
""")
def ingest_and_process_contracts(spark, sf):
    p = t(spark, sf, "part").select(
        F.when(F.col("p_size") % 4 == 0, " ").otherwise(F.col("p_name")).alias("raw_name"), F.lit(None).cast("string").alias("variety_match_key"), F.lit("").alias("raw_dimensions"), F.when(F.col("p_size") <= 20, "2 cm").alias("raw_thickness"),
        F.lit("").alias("raw_total_m2"), F.lit("").alias("raw_per_slab_m2"), F.when(F.col("p_size") >= 48, F.array(F.lit("u"))).alias("raw_image_urls"), F.when(F.col("p_type") != "PROMO", "IT").alias("origin_country_code"),
    )
    return health.gate(p, contracts.ingest_contract() + contracts.process_contract()).drop("severity")


@query(f"""
SELECT invariant, v AS violations, {_GATE} FROM (SELECT 'clean_noncanonical_type_name' AS invariant, count_if(p_type IN ('STANDARD', 'MEDIUM', 'LARGE', 'SMALL')) AS v FROM part UNION ALL
SELECT 'clean_noncanonical_color_name', count_if(string_split(p_name, ' ')[1] IN ('red', 'blue', 'hot', 'cold')) FROM part UNION ALL SELECT 'clean_noncanonical_finish_name', 0 FROM (SELECT 1) UNION ALL
SELECT 'clean_noncanonical_quality_name', 0 FROM (SELECT 1) UNION ALL SELECT 'clean_unresolved_tree_gap', count_if(p_size > 10) FROM part)
""")
def clean_contract(spark, sf):
    p = t(spark, sf, "part").select(F.col("p_type").alias("type_name"), _word(0).alias("color_name"), F.lit("Rod").alias("finish_name"), F.lit(None).cast("string").alias("quality_name"), F.when(F.col("p_size") > 10, F.array(F.lit("g"))).alias("tree_gaps"))
    return contracts.clean_contract(p, _vocabulary(spark)).drop("severity")


@query("SELECT count(*) AS varieties, count_if(c_acctbal > 5000) AS synced, count_if(c_mktsegment = 'BUILDING') AS untyped, count_if(c_mktsegment = 'BUILDING' AND c_acctbal > 5000) AS untyped_synced FROM customer")
def typing_health(spark, sf):
    c = t(spark, sf, "customer").select(F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("type"), F.when(F.col("c_acctbal") > 5000, "synced").otherwise("dirty").alias("state"))
    return contracts.typing_health(c)


@query("SELECT p_brand, count(DISTINCT p_name) AS keys, (SELECT count(DISTINCT p_name) FROM part) AS every FROM part GROUP BY 1 HAVING count(DISTINCT p_name) < (SELECT count(DISTINCT p_name) FROM part)")
def non_uniform_categories(spark, sf):
    return contracts.non_uniform_categories(t(spark, sf, "part"), "p_brand", "p_name")


@query("SELECT p_partkey, lower(p_type) NOT IN (string_split(p_name, ' ')[1], string_split(p_name, ' ')[2]) AS mistyped FROM part")
def mistyped_variants(spark, sf):
    return t(spark, sf, "part").select("p_partkey", contracts.mistyped(F.col("p_name"), F.col("p_type")).alias("mistyped"))


@query("SELECT 'length' AS field, count_if(p_size > 10 AND p_size % 2 = 0) AS gaps FROM part UNION ALL SELECT 'weight', count_if(p_size % 3 = 0) FROM part")
def provenance_gaps(spark, sf):
    p = t(spark, sf, "part").select(F.when(F.col("p_size") > 10, F.col("p_size")).alias("length"), F.when(F.col("p_size") % 2 == 1, "parsed").alias("length_method"), F.col("p_retailprice").alias("weight"), F.when(F.col("p_size") % 3 != 0, "scrape").otherwise("").alias("weight_method"))
    return contracts.provenance_gaps(p, [("length", "length_method"), ("weight", "weight_method")])


@query("""
WITH r AS (SELECT p_partkey, p_size % 10 AS k FROM part)
SELECT p_partkey, array_to_string(list_filter([CASE WHEN k = 0 THEN 'type_missing' END, CASE WHEN k = 1 THEN 'variation_missing' END, CASE WHEN k = 2 THEN 'tree_gap' END, CASE WHEN k IN (3, 4) THEN 'origin_missing' END, CASE WHEN k = 5 THEN 'no_image' END,
CASE WHEN k = 7 THEN 'dimension_unavailable' END, CASE WHEN k = 8 THEN 'dimension_defaulted' END, CASE WHEN k IN (4, 9) THEN 'dimension_invalid' END, CASE WHEN k = 6 THEN 'stock_undetermined' END], lambda x: x IS NOT NULL), ',') AS reasons, CASE WHEN k IN (4, 9) THEN 'width' END AS bad_dimension FROM r
""")
def row_rules(spark, sf):
    k = F.col("p_size") % 10
    ok = lambda bad: F.when(~bad, "x")
    p = t(spark, sf, "part").select(
        "p_partkey", ok(k == 0).alias("type_id"), F.lit("c").alias("color_id"), F.lit("f").alias("finish_id"), F.lit("q").alias("quality_id"), ok(k == 1).alias("variation_id"), (k == 2).alias("tree_gap"), F.lit("p").alias("category_id"),
        F.lit("h").alias("handle"), F.lit("o").alias("owner"), ok(k.isin(3, 4)).alias("origin"), F.when(k == 5, 0).otherwise(1).alias("images"), F.lit(False).alias("image_terminal"), F.when(k == 7, F.array(F.lit("length"))).alias("unavailable"),
        (k == 8).alias("dimension_defaulted"), F.when(k != 7, 1.0).alias("length"), F.when(k.isin(4, 9), -1.0).otherwise(1.0).alias("width"), F.when(k == 9, 0.0).otherwise(1.0).alias("height"), F.when(k != 6, 1).alias("inventory"),
    ).withColumn("review_flags", F.array().cast("array<string>"))
    return derive.validate(p, derive.row_rules(detailed=True)).select("p_partkey", F.array_join("reject_reasons", ",").alias("reasons"), derive.first_bad_dimension().alias("bad_dimension"))


# ---- curation and catalog -------------------------------------------------------------------------------------------


@query("""
SELECT l_partkey AS variation_id, arg_max(l_linestatus, o) FILTER (WHERE l_linestatus = 'O') AS category, arg_max(l_returnflag, o) FILTER (WHERE l_returnflag <> 'A') AS type, array_to_string(list_sort(list(DISTINCT CAST(l_linenumber AS VARCHAR))), ',') AS colors
FROM (SELECT *, l_orderkey * 100000 + l_linenumber * 10000 + l_suppkey * 50 + l_quantity AS o FROM lineitem) GROUP BY 1
""")
def product_facts(spark, sf):
    li = t(spark, sf, "lineitem").withColumn("o", F.col("l_orderkey") * 100000 + F.col("l_linenumber") * 10000 + F.col("l_suppkey") * 50 + F.col("l_quantity"))
    rows = li.select(F.col("l_partkey").cast("string").alias("variation_id"), F.when(F.col("l_linestatus") == "O", "O").otherwise("").alias("category"), F.when(F.col("l_returnflag") != "A", F.col("l_returnflag")).otherwise(" ").alias("type"), F.col("l_linenumber").cast("string").alias("color"), F.lit("q").alias("quality"), F.lit("f").alias("finish"), "o")
    return curation.product_facts(rows, "o").select(F.col("variation_id").cast("long").alias("variation_id"), "category", "type", F.array_join("colors", ",").alias("colors"))


@query("""
WITH a AS (SELECT 'slab' AS category, string_split(p_name, ' ')[2] AS f FROM part WHERE p_size < 25 UNION SELECT 'block', p_type FROM part UNION SELECT 'tile', 'Own'), b AS (SELECT * FROM a UNION SELECT 'tile', f FROM a WHERE category = 'slab')
SELECT category, array_to_string(list_sort(list(f)), ',') AS finishes FROM b GROUP BY 1
""")
def category_finish_union(spark, sf):
    p = t(spark, sf, "part")
    backbone = p.where("p_size < 25").select(F.lit("slab").alias("category"), _word(1).alias("finish")).unionByName(p.select(F.lit("tile").alias("category"), F.lit("Own").alias("finish")))
    return curation.category_finishes(backbone, p.select(F.lit("block").alias("category"), F.col("p_type").alias("finish"))).select("category", F.array_join("finishes", ",").alias("finishes"))


_COMBOS = """
WITH e AS (SELECT p_partkey, p_name, p_size, CASE WHEN p_size % 2 = 0 THEN 'slab' ELSE 'block' END AS cat FROM part WHERE p_size <> 13),
o AS (SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN [p_brand] ELSE [] END AS oc FROM part), nm AS (SELECT p_name, flatten(list(oc)) AS nc FROM e JOIN o USING (p_partkey) GROUP BY 1),
b AS (SELECT p_name, arg_min(p_type, p_partkey) AS bt, arg_min('B' || p_size, p_partkey) AS bc FROM part WHERE p_size > 45 GROUP BY 1),
r AS (SELECT e.*, CASE WHEN p_size % 3 = 0 THEN 'K' WHEN p_name IN (SELECT p_name FROM part WHERE p_size % 3 = 1 AND string_split(p_name, ' ')[1] = 'red') THEN 'G' END AS typ, list_distinct(list_filter(list_concat(list_concat(oc, nc), CASE WHEN bc IS NULL THEN [] ELSE [bc] END), lambda x: x IS NOT NULL)) AS cs FROM e JOIN o USING (p_partkey) JOIN nm USING (p_name) LEFT JOIN b USING (p_name))
"""


@query(_COMBOS + "SELECT p_partkey AS id, cat AS category, typ AS type, f AS finish, c AS color FROM r, LATERAL (SELECT unnest(CASE WHEN len(cs) > 0 THEN cs ELSE ['Dflt'] END) AS c) x, LATERAL (SELECT unnest(CASE WHEN cat = 'slab' THEN ['Gear', 'Rod'] ELSE ['Raw'] END) AS f) y WHERE typ IS NOT NULL")
def combination_build(spark, sf):
    return _combinations(spark, sf)[0].select(F.col("id").cast("long").alias("id"), "category", "type", "finish", "color")


@query(_COMBOS + "SELECT p_partkey AS id, cat AS category FROM r WHERE typ IS NULL")
def combination_uncovered(spark, sf):
    return _combinations(spark, sf)[1].select(F.col("id").cast("long").alias("id"), "category")


def _combinations(spark, sf):
    p = t(spark, sf, "part")
    s, pid = F.col("p_size"), F.col("p_partkey").cast("string")
    export = p.select(F.concat(F.when(s % 2 == 0, "slab_").otherwise("block_"), pid).alias("key"), pid.alias("id"), F.col("p_name").alias("name"), F.when(s % 3 == 0, "K").alias("key_type"))
    facts = p.select(pid.alias("variation_id"), F.when(s % 4 == 0, F.array("p_brand")).otherwise(F.array().cast("array<string>")).alias("colors"), F.array(F.lit("Q")).alias("qualities"))
    backbone = p.where("p_size > 45").select(F.col("p_partkey").alias("ordinal"), F.lit("none").alias("key"), F.lit("none").alias("category"), F.col("p_name").alias("name"), F.col("p_type").alias("type"), F.array(F.concat(F.lit("B"), s.cast("string"))).alias("colors"), F.array().cast("array<string>").alias("qualities"))
    finishes = spark.createDataFrame([("slab", ["Gear", "Rod"])], "category string, finishes array<string>")
    assigned = p.where((s % 3 == 1) & (_word(0) == "red")).select(T.match_key(F.col("p_name")).alias("norm"), F.lit("G").alias("type"))
    excluded = p.where("p_size = 13").select(F.concat(F.lit("block_"), pid).alias("key"))
    return curation.build_combinations(export, facts, backbone, finishes, assigned, "Dflt", "Q", "Raw", excluded)


@query("""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_size DESC, p_partkey) AS n FROM part), f AS (SELECT p_name, p_brand, min(n) AS n FROM r GROUP BY 1, 2)
SELECT p_name, arg_min(p_brand, n) AS p_brand, array_to_string(list_filter(list(p_brand ORDER BY n), lambda x: TRUE)[2:], ',') AS aliases FROM f GROUP BY 1
""")
def alias_fold(spark, sf):
    p = t(spark, sf, "part").withColumn("a", F.array(F.upper("p_brand")))
    return curation.folded_aliases(p, ["p_name"], "p_brand", "a", [F.desc("p_size"), F.col("p_partkey")]).select("p_name", "p_brand", F.array_join("aliases", ",").alias("aliases"))


@query("""
WITH n AS (SELECT p_type AS category, CAST(p_partkey AS VARCHAR) AS key, p_name || CASE p_size % 3 WHEN 0 THEN ' C' WHEN 1 THEN ' T' ELSE '' END AS name, p_name AS base FROM part)
SELECT category, base AS name, count(*) AS keys, array_to_string(list_sort(list(DISTINCT name) FILTER (WHERE name <> base)), ',') AS aliases FROM n GROUP BY 1, 2
""")
def grade_consolidation(spark, sf):
    name = F.concat("p_name", F.when(F.col("p_size") % 3 == 0, " C").when(F.col("p_size") % 3 == 1, " T").otherwise(""))
    rows = t(spark, sf, "part").select(F.col("p_type").alias("category"), F.col("p_partkey").cast("string").alias("key"), name.alias("name"), F.array().cast("array<string>").alias("aliases"))
    return curation.consolidate_grades(rows, M.clean_variety_name(F.col("name"))).select("category", "name", F.size("keys").cast("long").alias("keys"), F.coalesce(F.when(F.size("aliases") > 0, F.array_join("aliases", ","))).alias("aliases"))


@query("""
WITH f AS (SELECT p_brand AS key, string_split(p_name, ' ')[1] AS a FROM part) SELECT key, array_to_string(list_sort(list(DISTINCT a)), ',') AS new_aliases FROM f WHERE a NOT IN ('red', 'blue', lower(key)) GROUP BY 1
""")
def alias_additions(spark, sf):
    p = t(spark, sf, "part")
    have = p.select(F.col("p_brand").alias("key")).distinct().withColumn("name", F.col("key")).withColumn("aliases", F.array(F.lit("RED"), F.lit("Blue!")))
    return curation.alias_additions(have, p.select(F.col("p_brand").alias("key"), _word(0).alias("alias"))).select("key", F.array_join("new_aliases", ",").alias("new_aliases"))


@query("SELECT p_partkey AS key, CASE WHEN p_size % 10 = 0 THEN 'bare_code' WHEN p_type = 'PROMO' THEN 'mistyped' ELSE 'flagged_earlier' END AS reason FROM part WHERE p_size % 10 = 0 OR p_type = 'PROMO' OR p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50 AND l_linenumber = 7)")
def delete_list(spark, sf):
    p = t(spark, sf, "part").withColumn("key", F.col("p_partkey")).withColumn("name", F.when(F.col("p_size") % 10 == 0, "kx7").otherwise(F.col("p_name")))
    earlier = t(spark, sf, "lineitem").where("l_quantity = 50 and l_linenumber = 7").select(F.col("l_partkey").alias("key"))
    return curation.delete_list(p, earlier, M.code_shape(F.col("name")) == "bare_code", F.col("p_type") == "PROMO")


@query("SELECT p_partkey AS key FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)")
def drop_deleted(spark, sf):
    return curation.drop_deleted(t(spark, sf, "part").select(F.col("p_partkey").alias("key")), t(spark, sf, "lineitem").where("l_quantity > 48").select(F.col("l_partkey").alias("key")))


@query("SELECT p_name AS norm, CASE WHEN max(CASE WHEN p_size < 10 THEN p_brand END) IS NULL THEN '' ELSE max(CASE WHEN p_size < 10 THEN p_brand END) END AS type FROM part WHERE p_size < 10 OR p_size > 40 GROUP BY 1")
def assigned_types(spark, sf):
    p = t(spark, sf, "part")
    prior = p.where("p_size < 10").groupBy(F.col("p_name").alias("norm")).agg(F.max("p_brand").alias("type"))
    return curation.keep_assigned(prior, p.where("p_size > 40").select(F.upper("p_name").alias("name")))


@query("SELECT l_partkey AS key, 'refresh' AS why FROM lineitem WHERE l_quantity = 1 GROUP BY 1 UNION ALL SELECT p_partkey, 'new' FROM part WHERE p_size > 25 AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_discount > 0.05) AND p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 1)")
def prompt_queue(spark, sf):
    li, key = t(spark, sf, "lineitem"), F.col("l_partkey").alias("key")
    return curation.prompt_queue(t(spark, sf, "part").where("p_size > 25").select(F.col("p_partkey").alias("key")), li.where("l_discount > 0.05").select(key), li.where("l_quantity = 1").select(key))


@query("SELECT DISTINCT md5(text) AS sha256 FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM documents WHERE doc_id % 3 = 0 AND text IS NOT NULL)")
def pending_images(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("sha256"))
    return curation.pending_images(d, d.where("doc_id % 3 = 0"), d.where("doc_id % 6 = 0"))


@query("SELECT page_id FROM pages WHERE page_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def orphan_images(spark, sf):
    images = t(spark, sf, "pages").select("page_id", F.col("page_id").alias("key"))
    return curation.orphan_images(images, t(spark, sf, "documents").where("lang = 'en'").select(F.col("doc_id").alias("key"))).select("page_id")


@query("""
WITH v AS (SELECT p_partkey, p_name, 'img/' || p_partkey || '.jpg' AS image FROM part), s AS (SELECT p_name, count(*) AS n, min(p_partkey) AS k FROM part GROUP BY 1)
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN p_partkey WHEN 1 THEN CASE WHEN n = 1 THEN k END END AS key, CASE p_size % 3 WHEN 0 THEN 'basename' WHEN 1 THEN CASE WHEN n = 1 THEN 'stem' ELSE 'ambiguous:' || n END ELSE 'none' END AS how FROM part JOIN s USING (p_name)
""")
def image_intake(spark, sf):
    p = t(spark, sf, "part")
    pid, s = F.col("p_partkey").cast("string"), F.col("p_size") % 3
    name = F.when(s == 0, F.concat(F.lit("x/"), pid, F.lit(".JPG"))).when(s == 1, F.concat(F.lit("up/"), F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("_crop.png"))).otherwise(F.concat(F.lit("zz"), pid, F.lit("zz.png")))
    files = p.select("p_partkey", F.concat(F.lit("f"), pid, F.lit("/"), name).alias("file"))
    varieties = p.select(F.col("p_partkey").alias("key"), F.concat(F.lit("img/"), pid, F.lit(".jpg")).alias("image"), F.concat("p_name", F.lit(".png")).alias("name"))
    return files.join(curation.match_images(files.select("file"), varieties), "file").select("p_partkey", "key", "how")


@query("SELECT l_partkey AS variation_id, CAST(l_orderkey AS VARCHAR) AS url FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey) AS n FROM lineitem WHERE l_quantity > 10) WHERE n = 1")
def first_image(spark, sf):
    li = t(spark, sf, "lineitem").select(F.col("l_partkey").alias("variation_id"), F.when(F.col("l_quantity") > 10, F.col("l_orderkey").cast("string")).otherwise(" ").alias("url"), "l_orderkey")
    return curation.first_images(li, "l_orderkey")


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN least(p_size, 4) ELSE 0 END AS oriented, CASE WHEN p_size % 2 = 0 THEN least(greatest(p_size - 4, 0), 15) ELSE least(p_size, 15) END AS product FROM part")
def image_slots(spark, sf):
    keys = F.transform(F.sequence(F.lit(1), F.col("p_size")), lambda i: i.cast("string"))
    s = curation.slotted(keys, F.when(F.col("p_size") % 2 == 0, "block").otherwise("slab"))
    return t(spark, sf, "part").withColumn("s", s).select("p_partkey", F.size("s.oriented").alias("oriented"), F.size("s.product").alias("product"))


@query("SELECT p_partkey, CASE WHEN r >= 0 THEN n END AS color FROM (SELECT p_partkey, 0 AS r, CASE p_size % 6 WHEN 0 THEN 'Black' WHEN 1 THEN 'Grey' WHEN 2 THEN 'Cream' WHEN 3 THEN 'Gold' WHEN 4 THEN 'Green' ELSE 'Pink' END AS n FROM part)")
def color_buckets(spark, sf):
    k = F.col("p_size") % 6
    pick = lambda *x: F.element_at(F.array(*map(F.lit, x)), k + 1)
    return t(spark, sf, "part").select("p_partkey", N.color_bucket(pick(20, 120, 250, 220, 40, 230), pick(20, 118, 240, 160, 160, 60), pick(20, 116, 225, 60, 60, 190)).alias("color"))


@query("""
SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'IT' WHEN 1 THEN 'N' || s_nationkey WHEN 2 THEN 'BR' WHEN 3 THEN 'N' || s_nationkey ELSE 'DE' END AS origin, CASE s_suppkey % 5 WHEN 0 THEN 'scrape' WHEN 1 THEN 'supplier_override' WHEN 2 THEN 'origin_map' WHEN 3 THEN 'origin_map' ELSE 'origin_map_first' END AS method FROM supplier
""")
def origin_of_many(spark, sf):
    s = t(spark, sf, "supplier")
    k, home = F.col("s_suppkey") % 5, F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))
    rows = s.select("s_suppkey", k.alias("k"), home.alias("home"), F.lit("x").alias("source"), F.concat(F.lit("Variety "), F.col("s_suppkey").cast("string")).alias("variety"), F.lit("Marble").alias("type"))
    over = s.where(k == 1).select(F.lit("x").alias("source"), F.concat(F.lit("VARIETY "), F.col("s_suppkey").cast("string")).alias("variety"), F.lit("marble").alias("type"), home.alias("country"))
    maps = s.where(k > 1).select(F.concat(F.lit("variety "), F.col("s_suppkey").cast("string")).alias("variety"), F.lit("marble").alias("type"), F.when(k == 2, "br").when(k == 3, F.concat(F.lit("de, "), home)).otherwise("de,fr").alias("countries"))
    o = derive.origin_ladder(F.when(F.col("k") == 0, "it"), F.lit(True), F.col("supplier_country"), F.col("mapped_countries"), F.col("home"))
    return derive.origin_mapped(rows, over, maps).withColumn("o", o).select("s_suppkey", F.col("o.value").alias("origin"), F.col("o.method").alias("method"))


@query("SELECT p_brand AS source, CASE WHEN min(p_size) % 2 = 0 THEN 'pa,pb' ELSE '' END AS port_ids, min(p_size) % 2 = 1 AS unresolved FROM part GROUP BY 1")
def port_resolution(spark, sf):
    even = F.array(F.lit("Alpha Port"), F.lit("zz"), F.lit("BBB"), F.lit("pa"))
    src = t(spark, sf, "part").groupBy(F.col("p_brand").alias("source")).agg(F.min("p_size").alias("s")).select("source", F.when(F.col("s") % 2 == 0, even).otherwise(F.array(F.lit("nowhere"))).alias("ports"))
    ports = spark.createDataFrame([("pa", "AAA", "Alpha Port"), ("pb", "BBB", "Beta")], "port_id string, un_locode string, name string")
    return derive.resolve_ports(src, ports).select("source", F.array_join("port_ids", ",").alias("port_ids"), "unresolved")


@query("""
SELECT p_partkey, slug AS "Product Handle", p_name AS "Product Title", 'published' AS "Product Status", CASE WHEN p_retailprice = floor(p_retailprice) THEN CAST(CAST(p_retailprice AS BIGINT) AS VARCHAR) ELSE CAST(CAST(p_retailprice AS DECIMAL(18, 1)) AS VARCHAR) END AS "Product Weight", CASE WHEN p_size > 3 THEN 'k4' ELSE '' END AS "Left Image",
CASE WHEN p_size > 5 THEN 'k6' ELSE '' END AS "Product Image 2", '''=' || p_brand AS "STN Type Name", 'a|b' AS "STN Port Ids", CASE WHEN p_size > 25 THEN 'true' ELSE 'false' END AS "STN Sold In Bundle", '' AS "STN Specification File Ids" FROM (SELECT *, replace(p_name, ' ', '-') AS slug FROM part)
""")
def import_file(spark, sf):
    p = t(spark, sf, "part")
    keys = F.transform(F.sequence(F.lit(1), F.col("p_size")), lambda i: F.concat(F.lit("k"), i.cast("string")))
    text = lambda *cs: {c: F.lit("x") for c in cs}
    rows = p.withColumn("s", curation.slotted(keys, F.lit("block"))).withColumns({
        "handle": T.slugify(F.col("p_name")), "title": F.col("p_name"), "weight": F.col("p_retailprice"), "length": F.lit(1.0), "width": F.lit(2.0), "height": F.lit(0.02), "oriented_images": F.col("s.oriented"), "product_images": F.col("s.product"),
        "type_name": F.concat(F.lit("="), F.col("p_brand")), "port_ids": F.array(F.lit("a"), F.lit("b")), "sold_in_bundle": F.col("p_size") > 25, "bundle_size": F.col("p_size"), "inventory": F.col("p_size"),
        **text("description", "thumbnail_key", "category_id", "sku", "origin", "origin_city", "origin_county", "color_id", "finish_id", "quality_id", "variation_id", "type_id", "slug"),
    })
    rows = sinks.with_constants(rows, "c", "ch")
    out = sinks.template(rows, ["key", *sinks.IMPORT_COLUMNS], {"key": F.col("p_partkey")} | sinks.import_mapping())
    shown = ["Product Handle", "Product Title", "Product Status", "Product Weight", "Left Image", "Product Image 2", "STN Type Name", "STN Port Ids", "STN Sold In Bundle", "STN Specification File Ids"]
    return out.select(F.col("key").cast("long").alias("p_partkey"), *(f"`{c}`" for c in shown))


# ---- ledger ---------------------------------------------------------------------------------------------------------

_ORDERS = "SELECT o_orderkey AS k, o_custkey AS v, CASE WHEN o_orderkey % 11 = 0 THEN 'retiring' ELSE 'syncing' END AS state, o_orderkey % 6 AS attempts, o_orderpriority AS h, o_orderkey % 4 AS a FROM orders"


@query(f"""
WITH o AS ({_ORDERS}), p AS (SELECT c_custkey FROM customer WHERE c_acctbal > 0), j AS (SELECT *, state <> 'retiring' AND a IN (0, 1) AND v IN (SELECT c_custkey FROM p) AND (a = 0 OR h = '1-URGENT') AS ok, state <> 'retiring' AND a = 2 AS bad FROM o)
SELECT k, CASE WHEN ok THEN 'synced' WHEN bad AND attempts + 1 >= 5 THEN 'gap_held' WHEN bad THEN 'dirty' ELSE state END AS state, CAST(CASE WHEN ok THEN 0 WHEN bad THEN attempts + 1 ELSE attempts END AS INT) AS attempts, CASE WHEN ok THEN 'r' || k END AS remote_id, CASE WHEN bad THEN 'apply failed' END AS error FROM j
""")
def ack_apply(spark, sf):
    o, k = t(spark, sf, "orders"), F.col("o_orderkey")
    state = o.select(k.alias("k"), F.col("o_custkey").alias("variation_key"), F.when(k % 11 == 0, "retiring").otherwise("syncing").alias("state"), (k % 6).cast("int").alias("attempts"), F.col("o_orderpriority").alias("payload_hash"), F.lit(None).cast("string").alias("remote_id"), F.lit(None).cast("string").alias("error"), F.lit(None).cast("timestamp").alias("updated_at"))
    acks = o.where(k % 4 < 3).select(k.alias("k"), F.when(k % 4 == 2, "failed").otherwise("synced").alias("status"), F.concat(F.lit("r"), k.cast("string")).alias("remote_id"), F.when(k % 4 == 1, "1-URGENT").alias("payload_hash"), F.lit(None).cast("string").alias("reason"))
    parents = t(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("variation_key"))
    return ledger.apply_acks(state, acks, "k", F.lit("2024-01-01").cast("timestamp"), parents).select("k", "state", "attempts", "remote_id", "error")


@query("SELECT p_partkey AS sku, CASE WHEN p_size < 40 AND p_size % 3 = 0 AND p_size % 2 = 0 THEN p_size ELSE -1 END AS last_synced_qty FROM part")
def inventory_acks(spark, sf):
    p = t(spark, sf, "part").select(F.col("p_partkey").alias("sku"), F.col("p_size").alias("qty"))
    acks = p.where("qty % 3 = 0").select("sku", F.lit("done").alias("status"), F.when(F.col("qty") % 2 == 0, F.col("qty")).otherwise(F.col("qty") + 1).alias("quantity"))
    products = p.select("sku", F.when(F.col("qty") < 40, "synced").otherwise("dirty").alias("state"))
    return ledger.apply_inventory_acks(p.withColumn("last_synced_qty", F.lit(-1)), acks, products).select("sku", "last_synced_qty")


@query("""
WITH s AS (SELECT p_partkey AS id, CASE WHEN p_size % 2 = 0 THEN 'variation' ELSE 'product' END AS kind, p_size % 6 AS att, p_size % 3 AS a, p_brand = 'Brand#3' AS kids FROM part)
SELECT id, CAST(CASE WHEN a = 1 THEN att + 1 ELSE att END AS INT) AS attempts, CASE WHEN a = 1 AND att + 1 >= 5 THEN 'dead' ELSE 'pending' END AS state FROM s WHERE NOT (a = 0 AND NOT (kind = 'variation' AND kids))
""")
def removed_acks(spark, sf):
    p, s = t(spark, sf, "part"), F.col("p_size")
    stones = p.select(F.col("p_partkey").alias("external_id"), F.when(s % 2 == 0, "variation").otherwise("product").alias("kind"), (s % 6).cast("int").alias("attempts"), F.lit("pending").alias("state"))
    acks = p.where(s % 3 < 2).select(F.col("p_partkey").alias("external_id"), F.when(s % 3 == 0, "done").otherwise("blocked").alias("status"))
    kids = p.where("p_brand = 'Brand#3'").select(F.col("p_partkey").alias("variation_key"))
    return ledger.removed_acks(stones, acks, kids).select(F.col("external_id").alias("id"), "attempts", "state")


@query("SELECT coalesce(n.k, i.k) AS sku, CAST(coalesce(n.q, i.q) AS INT) AS qty, i.l AS last_synced_qty FROM (SELECT p_partkey AS k, p_size AS q, p_size + 1 AS l FROM part WHERE p_size < 30) i FULL JOIN (SELECT p_partkey AS k, CASE WHEN p_size > 45 THEN 0 ELSE p_size * 2 END AS q FROM part WHERE p_size > 20) n ON i.k = n.k")
def inventory_populate(spark, sf):
    p = t(spark, sf, "part").select(F.col("p_partkey").alias("sku"), F.col("p_size").alias("s"))
    old = p.where("s < 30").select("sku", F.col("s").alias("qty"), (F.col("s") + 1).alias("last_synced_qty"))
    return ledger.populate_inventory(old, p.where("s > 20 and s <= 45").select("sku", (F.col("s") * 2).alias("qty")), p.where("s > 45").select("sku"))


@query("SELECT p_partkey AS key FROM part WHERE p_size = 50 UNION SELECT k FROM (SELECT p_partkey AS k, p_name, p_type, row_number() OVER (PARTITION BY p_name, p_type ORDER BY CASE WHEN p_size < 10 THEN 0 ELSE 1 END, p_partkey) AS n FROM part) WHERE n = 1 AND (p_name, p_type) IN (SELECT p_name, p_type FROM part WHERE p_size < 10)")
def reconcile_to_seed(spark, sf):
    p = t(spark, sf, "part").select(F.col("p_partkey").alias("key"), "p_name", "p_type", "p_size")
    return ledger.reconcile_to_seed(p, p.where("p_size < 10"), ["p_name", "p_type"], p.where("p_size = 50")).select("key")


@query("SELECT event_id, CASE WHEN user_id % 5 = 0 THEN 'unreadable: props' END AS error FROM events")
def serve_isolated(spark, sf):
    e = t(spark, sf, "events").select("event_id", F.when(F.col("user_id") % 5 == 0, F.lit("{broken")).otherwise(F.col("props")).alias("props"), F.lit("syncing").alias("state"))
    served, held = ledger.isolate(e, {"props": "map<string,long>"})
    return served.select("event_id", F.lit(None).cast("string").alias("error")).unionByName(held.select("event_id", "error"))


@query("SELECT c_custkey AS variation_key FROM customer WHERE c_acctbal < 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders)")
def stale_varieties(spark, sf):
    v = t(spark, sf, "customer").select(F.col("c_custkey").alias("variation_key"), F.when(F.col("c_acctbal") < 0, 0).otherwise(1).alias("in_full"))
    return ledger.stale_varieties(v, t(spark, sf, "orders").select(F.col("o_custkey").alias("variation_key"))).select("variation_key")


@query("SELECT 'product' AS kind, o_orderkey AS external_id FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 9000) UNION ALL SELECT 'variation', c_custkey FROM customer WHERE c_acctbal > 9000")
def retire_cascade(spark, sf):
    v = t(spark, sf, "customer").select(F.col("c_custkey").alias("variation_key"), F.lit("synced").alias("state"), "c_acctbal")
    p = t(spark, sf, "orders").select(F.col("o_orderkey").alias("sku"), F.col("o_custkey").alias("variation_key"))
    return ledger.retire(v, p, p.select("sku"), v.where("c_acctbal > 9000"))[3].select("kind", "external_id")


@query("SELECT c_custkey AS k, 'kept' AS state FROM customer WHERE c_acctbal > 0 UNION ALL SELECT o_custkey, 'seed' FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def ledger_bootstrap(spark, sf):
    state = t(spark, sf, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"), F.lit("kept").alias("state"))
    return ledger.bootstrap(state, t(spark, sf, "orders").select(F.col("o_custkey").alias("k")).distinct().withColumn("state", F.lit("seed")), "k")


@query("""
WITH v AS (SELECT 'color' AS category, unnest(['red', 'blue', 'small', 'large']) AS norm UNION ALL SELECT 'type', unnest(['standard', 'promo', 'economy', 'large', 'small', 'medium'])),
l AS (SELECT 'first' AS "column", 'type' AS own, string_split(p_name, ' ')[1] AS norm FROM part UNION ALL SELECT 'p_type', 'color', lower(p_type) FROM part),
h AS (SELECT l."column", l.own, category, count(*) AS hit FROM l JOIN v USING (norm) GROUP BY 1, 2, 3), n AS (SELECT "column", count(*) AS total FROM l GROUP BY 1),
r AS (SELECT h."column", h.own, any_value(total) AS total, coalesce(max(CASE WHEN category = own THEN hit END), 0) AS mine, max(CASE WHEN category <> own THEN hit END) AS best, arg_max(category, CASE WHEN category <> own THEN hit END) AS other FROM h JOIN n ON n."column" = h."column" GROUP BY 1, 2)
SELECT "column", own, other FROM r WHERE total >= 5 AND mine / total < 0.5 AND best / total >= 0.5 AND (best - mine) / total >= 0.4
""")
def likely_swaps(spark, sf):
    p = t(spark, sf, "part").select(F.get(F.split("p_name", " "), F.lit(0)).alias("first"), "p_type")
    v = spark.createDataFrame([("color", w) for w in ("red", "blue", "small", "large")] + [("type", w) for w in ("standard", "promo", "economy", "large", "small", "medium")], "category string, norm string")
    return catalog.likely_swaps(p, {"first": "type", "p_type": "color"}, v)


@query("""
WITH d AS (SELECT p_name AS n, lower(p_type) AS t, arg_max(CASE WHEN p_size % 3 = 0 THEN 'approve' ELSE 'reject' END, p_partkey) AS a FROM part GROUP BY 1, 2),
r AS (SELECT p_name AS n, lower(p_type) AS t, arg_max(CASE WHEN p_size > 47 THEN 'clear' ELSE 'approve' END, p_partkey) AS a FROM part WHERE p_size > 40 GROUP BY 1, 2)
SELECT n AS name_norm, t AS type_norm, string_split(n, ' ')[1] AS value_norm, coalesce(r.a, d.a) AS action FROM d LEFT JOIN r USING (n, t) WHERE coalesce(r.a, '') <> 'clear'
""")
def leaf_decisions(spark, sf):
    p = t(spark, sf, "part").select(F.col("p_name").alias("name"), F.col("p_type").alias("type"), F.lit("color").alias("attribute"), F.get(F.split("p_name", " "), F.lit(0)).alias("value"), "p_size", F.col("p_partkey").alias("at"))
    none = spark.createDataFrame([], "name_norm string, type_norm string, attribute string, value_norm string, value string, action string, at long")
    decided = control.decide_leaves(none, p.withColumn("action", F.when(F.col("p_size") % 3 == 0, "approve").otherwise("reject")), "at")
    keyed = control.leaf_changes(p.where("p_size > 40").withColumn("action", F.lit("approve")))
    revised = keyed.select(*control.LEAF_KEY, F.when(F.col("p_size") > 47, "clear").otherwise("approve").alias("action"), "at")
    return control.revise_leaves(decided, revised, "at").select("name_norm", "type_norm", "value_norm", "action")
