"""Queries of decisions, removals and the catalog's full set over the driver's tables, with the SQL that checks them; every query reads its whole tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import adapters, lifecycle
from .catalog_queries import query, t


@query("""
WITH d AS (SELECT p_partkey AS key, p_size % 3 AS a, CASE WHEN p_size % 2 = 1 THEN p_brand END AS color, CASE WHEN p_size % 4 > 0 THEN p_type END AS type, CASE WHEN p_size > 25 THEN 'IT' END AS country, p_name AS target FROM part)
SELECT key, CASE a WHEN 0 THEN 'yes' WHEN 1 THEN 'no' END AS confirm, CASE WHEN a = 2 THEN target END AS alias_of, CASE WHEN a = 2 THEN type END AS alias_type, CASE WHEN a = 0 THEN color END AS seed_color, CASE WHEN a = 0 THEN type END AS seed_type, CASE WHEN a = 0 THEN country END AS seed_country FROM d
""")
def decision_views(spark, sf):
    s = F.col("p_size")
    kind = F.when(s % 4 > 0, F.col("p_type")).otherwise("")
    return lifecycle.decision_views(t(spark, sf, "part").select(
        F.col("p_partkey").alias("key"), F.when(s % 3 == 0, "mint").when(s % 3 == 1, "reject").otherwise("alias").alias("action"), F.when(s % 2 == 1, F.col("p_brand")).otherwise(" ").alias("color"),
        kind.alias("type"), F.when(s > 25, "IT").alias("country"), F.col("p_name").alias("target"), kind.alias("target_type"),
    ))


@query("""
WITH d AS (SELECT DISTINCT lower(p_name) AS n, lower(p_type) AS t FROM part WHERE p_size % 3 = 0 AND p_size % 4 > 0 AND p_size > 25) SELECT n AS name_norm, t AS type_norm, 'IT' AS country FROM d
""")
def minted_countries(spark, sf):
    s = F.col("p_size")
    rows = t(spark, sf, "part").select(F.upper("p_name").alias("key"), F.when(s % 3 == 0, "mint").otherwise("reject").alias("action"), F.lit("").alias("color"), F.when(s % 4 > 0, F.col("p_type")).alias("type"), F.when(s > 25, "IT").alias("country"), F.lit("").alias("target"), F.lit("").alias("target_type"))
    return lifecycle.country_rules(rows).distinct()


@query("""
WITH v AS (SELECT DISTINCT 'COLOR' AS category, p_name || ' ' || p_type AS value, 'own' AS id FROM part WHERE p_size = 1),
c AS (SELECT lower(p_name || ' ' || p_type) AS n, arg_max(CASE WHEN p_size % 2 = 0 THEN upper(p_name || ' ' || p_type) ELSE p_name || ' ' || p_type END, p_partkey) AS value, arg_max('i' || p_size, p_partkey) AS id FROM part WHERE p_size > 5 GROUP BY 1)
SELECT * FROM v UNION ALL SELECT 'color', value, id FROM c WHERE n NOT IN (SELECT lower(value) FROM v)
""")
def attribute_ids(spark, sf):
    p = t(spark, sf, "part").withColumn("v", F.concat_ws(" ", "p_name", "p_type"))
    s = F.col("p_size")
    changes = p.select(F.lit(" Color").alias("kind"), F.when(s % 2 == 0, F.upper("v")).otherwise(F.col("v")).alias("value"), F.when(s > 5, F.concat(F.lit("i"), s.cast("string"))).otherwise(" ").alias("id"), F.col("p_partkey").alias("at"))
    none = spark.createDataFrame([], "kind string, value_norm string, value string, id string")
    known = p.where("p_size = 1").select(F.lit("COLOR").alias("category"), F.col("v").alias("value"), F.lit("own").alias("id")).distinct()
    return lifecycle.adopt_attribute_ids(known, lifecycle.set_attribute_ids(none, changes, "at"))


@query("""
WITH v AS (SELECT c_custkey AS id, c_mktsegment = 'BUILDING' AS asked, c_acctbal < 0 AS gone, c_nationkey % 2 = 0 AS remote FROM customer)
SELECT 'variation' AS kind, id, CASE WHEN NOT gone THEN 'synced' WHEN NOT asked THEN 'retiring' WHEN remote THEN 'dirty' ELSE 'pending' END AS state FROM v
UNION ALL SELECT 'tombstone', id, '' FROM v WHERE gone AND NOT asked UNION ALL SELECT 'tombstone', o_orderkey, '' FROM orders WHERE o_orderstatus = 'F'
""")
def variety_restore(spark, sf):
    c = t(spark, sf, "customer")
    v = c.select(F.col("c_custkey").alias("variation_key"), F.when(F.col("c_acctbal") < 0, "retiring").otherwise("synced").alias("state"), F.when(F.col("c_nationkey") % 2 == 0, "r").otherwise("").alias("remote_id"))
    stones = c.where("c_acctbal < 0").select(F.col("c_custkey").alias("external_id"), F.lit("variation").alias("kind")).unionByName(t(spark, sf, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("external_id"), F.lit("product").alias("kind")))
    served, left = lifecycle.restore(v, stones, c.where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("variation_key")))
    return served.select(F.lit("variation").alias("kind"), F.col("variation_key").alias("id"), "state").unionByName(left.select(F.lit("tombstone").alias("kind"), F.col("external_id").alias("id"), F.lit("").alias("state")))


@query("""
WITH k AS (SELECT CASE WHEN c_acctbal < 0 THEN -c_custkey ELSE c_custkey END AS k FROM customer), b AS (SELECT k, k NOT IN (SELECT c_custkey FROM customer) AS unknown, k IN (SELECT o_custkey FROM orders WHERE o_totalprice > 200000) AS live FROM k)
SELECT k AS variation_key, CASE WHEN unknown THEN 'unknown' ELSE 'live_products' END AS problem FROM b WHERE unknown OR live
""")
def blocked_retirements(spark, sf):
    c, o = t(spark, sf, "customer"), t(spark, sf, "orders")
    keys = c.select(F.when(F.col("c_acctbal") < 0, -F.col("c_custkey")).otherwise(F.col("c_custkey")).alias("variation_key"))
    stock = o.select(F.col("o_orderkey").alias("sku"), (F.col("o_totalprice") > 200000).cast("int").alias("qty"))
    return lifecycle.blocked_retirements(c.select(F.col("c_custkey").alias("variation_key")), o.select(F.col("o_orderkey").alias("sku"), F.col("o_custkey").alias("variation_key")), stock, keys)


@query("SELECT o_orderkey AS sku, CASE WHEN o_orderpriority LIKE '1%' THEN 'before' WHEN o_orderstatus = 'F' AND o_totalprice > 100000 THEN 'now' ELSE '' END AS abandoned FROM orders")
def abandoned_dead_letters(spark, sf):
    o = t(spark, sf, "orders").select(F.col("o_orderkey").alias("sku"), F.when(F.col("o_orderstatus") == "F", "gap_held").otherwise("synced").alias("state"), F.when(F.col("o_orderpriority").startswith("1"), "before").alias("abandoned_at"), "o_totalprice")
    return lifecycle.abandon(o, o.where("o_totalprice > 100000"), "sku", "gap_held", F.lit("now")).select("sku", F.coalesce("abandoned_at", F.lit("")).alias("abandoned"))


@query("SELECT c_custkey AS variation_key, CASE WHEN c_acctbal <= 0 THEN 'pending' WHEN c_nationkey % 3 = 0 AND c_mktsegment <> 'MACHINERY' AND c_nationkey % 7 <> 0 THEN 'dirty' ELSE 'synced' END AS state FROM customer")
def stranded_images(spark, sf):
    c, n, key = t(spark, sf, "customer"), F.col("c_nationkey"), F.col("c_custkey").cast("string")
    v = c.select(key.alias("variation_key"), F.when(F.col("c_acctbal") > 0, "synced").otherwise("pending").alias("state"), F.when(F.col("c_mktsegment") != "MACHINERY", "u").otherwise("").alias("image_url"), F.when(n % 7 != 0, "h").alias("image_sha256"))
    out = lifecycle.reserve_stranded(v, c.select(key.alias("key"), F.when(n % 3 != 0, "i").otherwise(" ").alias("image")))
    return out.select(F.col("variation_key").cast("long").alias("variation_key"), "state")


@query("SELECT 'slab_' || p_partkey AS key FROM part WHERE p_size <> 3 AND p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def product_backed_keys(spark, sf):
    pid = F.col("p_partkey").cast("string")
    export = t(spark, sf, "part").select(pid.alias("id"), F.when(F.col("p_size") != 3, F.concat(F.lit("slab_"), pid)).otherwise("").alias("key"))
    return lifecycle.product_backed(export, t(spark, sf, "lineitem").select(F.when(F.col("l_quantity") > 45, F.col("l_partkey").cast("string")).otherwise(" ").alias("variation_id")))


@query("""
WITH k AS (SELECT *, category || '_' || p_partkey AS key FROM (SELECT p_partkey, p_size, p_type AS type, p_name AS name, CASE p_size % 3 WHEN 0 THEN 'slab' WHEN 1 THEN 'tile' ELSE 'block' END AS category,
  CASE WHEN p_size % 10 = 0 THEN 'Gamma Three' WHEN p_size <= 30 THEN 'Alpha One' ELSE 'Beta Two' END AS alias, p_brand LIKE '%1' AS img, p_size > 45 AS backed FROM part)),
m AS (SELECT type, name, arg_min(alias, key) AS alias FROM k GROUP BY 1, 2), w AS (SELECT DISTINCT category, type, name FROM k),
f AS (SELECT c || '_' || lower(m.type) || '_' || replace(m.name, ' ', '_') AS key, c AS category, m.type, m.name, alias FROM m JOIN (VALUES ('slab'), ('tile'), ('block')) x(c) ON TRUE LEFT JOIN w ON w.category = c AND w.type = m.type AND w.name = m.name WHERE w.name IS NULL),
u AS (SELECT key, category, type, name, alias, img, backed FROM k WHERE p_size <> 7 UNION ALL SELECT key, category, type, name, alias, FALSE, FALSE FROM f)
SELECT min(key) AS key, category, type, array_to_string(list_transform(string_split(name, ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS name, array_to_string(list_sort(list(DISTINCT alias)), '|') AS aliases,
CASE WHEN bool_or(img) OR arg_min(backed, key) THEN 'http://i/' || min(key) || '.webp' ELSE '' END AS image FROM u GROUP BY category, type, u.name
""")
def variants_full(spark, sf):
    p, s = t(spark, sf, "part"), F.col("p_size")
    category = F.when(s % 3 == 0, "slab").when(s % 3 == 1, "tile").otherwise("block")
    rows = p.select("p_size", F.concat_ws("_", category, F.col("p_partkey").cast("string")).alias("key"), category.alias("category"), F.col("p_type").alias("type"), F.col("p_name").alias("name"), F.when(F.col("p_brand").endswith("1"), "x").otherwise("").alias("image"))
    said = lambda f, a: f.withColumn("aliases", F.array(F.lit(a)))
    categories = spark.createDataFrame([("slab",), ("tile",), ("block",)], "category string")
    out = lifecycle.variants_full(said(rows.where("p_size <= 30"), "alpha ONE"), said(rows.where("p_size > 20"), "beta two"), said(rows.where("p_size % 10 = 0"), "Gamma three"), rows.where("p_size = 7"), categories, None, rows.where("p_size > 45"), "http://i/")
    return out.withColumn("aliases", F.array_join("aliases", "|"))


@query("""
WITH b AS (SELECT p_partkey AS key, CASE WHEN p_size % 2 = 0 THEN 'slab' ELSE 'tile' END AS category, lower(p_type) AS type, p_name AS name, p_size FROM part), c AS (SELECT category, count(DISTINCT (type, name)) AS n FROM b GROUP BY 1)
SELECT 'lost_rows' AS check, count_if(p_size = 9) AS violations FROM b UNION ALL SELECT 'added_rows', count_if(p_size = 4) FROM b
UNION ALL SELECT 'duplicate_varieties', count(*) FROM (SELECT 1 FROM b GROUP BY category, type, name HAVING count(DISTINCT key) > 1) UNION ALL SELECT 'unknown_types', count_if(type NOT IN ('standard', 'promo', 'large', 'small', 'medium')) FROM b
UNION ALL SELECT 'non_uniform_categories', count(*) FROM c WHERE n < (SELECT count(DISTINCT (type, name)) FROM b)
UNION ALL SELECT 'mistyped_variants', count_if(string_split(name, ' ')[1] IN ('standard', 'promo', 'large', 'small', 'medium') AND string_split(name, ' ')[1] <> type) FROM b
""")
def seed_report(spark, sf):
    p = t(spark, sf, "part").select(F.col("p_partkey").alias("key"), F.when(F.col("p_size") % 2 == 0, "slab").otherwise("tile").alias("category"), F.lower("p_type").alias("type"), F.col("p_name").alias("name"), "p_size")
    full = p.where("p_size <> 9").unionByName(p.where("p_size = 4").withColumn("key", -F.col("key")))
    return lifecycle.seed_report(p, full, ["standard", "promo", "large", "small", "medium"])


@query("SELECT o_orderpriority AS source, max(o_orderkey) AS run_id, arg_max(o_orderstatus, o_orderkey) AS status, arg_max(o_custkey, o_orderkey) AS row_count, CASE WHEN o_orderpriority LIKE '1%' THEN 'auto' END AS admission FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1")
def latest_diagnostics(spark, sf):
    o = t(spark, sf, "orders")
    runs = o.select(F.col("o_orderpriority").alias("source"), F.col("o_orderkey").alias("run_id"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"), F.col("o_custkey").alias("row_count"), F.lit(0).alias("row_baseline"))
    admitted = o.where("o_orderpriority like '1%'").select(F.col("o_orderpriority").alias("source"), F.lit("auto").alias("admission")).distinct()
    return lifecycle.latest_diagnostics(runs, admitted).drop("row_baseline")


@query("""
SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'block' WHEN 1 THEN '' ELSE 'slab' END AS format, CASE p_size % 3 WHEN 0 THEN '' WHEN 1 THEN '' ELSE p_brand END AS price,
CASE p_size % 4 WHEN 0 THEN 'recommended' WHEN 1 THEN 'new' ELSE '' END AS badge, p_size || ' | ' || ' | 7' AS widths, 'http://x/1,http://b/p/2,http://b/' || p_partkey AS photos FROM part
""")
def supplier_fields(spark, sf):
    s, pid = F.col("p_size"), F.col("p_partkey").cast("string")
    html = F.when(s % 4 == 0, "<span class='Recommended-Product' style='display: block'>").when(s % 4 == 1, "<b CLASS='new-product' style='Display: Block'>").when(s % 4 == 2, "<b class='new-product' style='display: none'>")
    pieces = F.array(*(F.struct(w.cast("string").alias("w")) for w in (s, F.lit(None), F.lit(7))))
    return t(spark, sf, "part").select(
        "p_partkey", adapters.thickness_format(F.when(s % 3 == 0, " multi").when(s % 3 == 2, "2cm")).alias("format"), adapters.shown_price(F.when(s % 3 == 0, "< a href='#'>in</a>").when(s % 3 == 1, "LOGIN for  price").otherwise(F.col("p_brand"))).alias("price"),
        F.coalesce(adapters.badge(html), F.lit("")).alias("badge"), adapters.joined(pieces, "w").alias("widths"), F.array_join(adapters.photo_urls(F.array(F.lit("http://x/1"), F.lit("/p/2"), F.lit(""), pid), "http://b"), ",").alias("photos"),
    )
