"""Queries of curated sets, overlays and queues over the driver's tables, with the SQL that checks them; every query reads its whole tables."""
from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import catalog, control, curation, derive
from .catalog_queries import query, t


def _told(word: str, c: str):
    return F.concat(F.lit(word), F.col(c).cast("string"))


@query("""
SELECT p_name, string_agg(DISTINCT p_brand, '|' ORDER BY p_brand) AS colors, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS finishes, coalesce(string_agg(DISTINCT 'A' || p_size, '|' ORDER BY 'A' || p_size) FILTER (p_size % 2 = 0), '') AS qualities FROM part GROUP BY p_name
""")
def observed_attribute_sets(spark, sf):
    rows = t(spark, sf, "part").select("p_name", F.col("p_brand").alias("color"), F.col("p_type").alias("finish"), F.when(F.col("p_size") % 2 == 0, _told("A", "p_size")).otherwise("  ").alias("quality"))
    seen = curation.observed_attributes(rows, ["p_name"])
    return seen.select("p_name", *(F.array_join(c, "|").alias(to) for c, to in (("colors", "colors"), ("finishs", "finishes"), ("qualitys", "qualities"))))


@query("SELECT p_name, p_type, count(DISTINCT p_brand) AS keys FROM part GROUP BY ALL HAVING count(DISTINCT p_brand) > 1")
def duplicate_identities(spark, sf):
    return catalog.duplicate_identities(t(spark, sf, "part"), ["p_name", "p_type"], "p_brand")


@query("""
WITH o AS (SELECT o_custkey AS k, 'orders ' || count(*) AS v FROM orders GROUP BY 1), e AS (SELECT user_id AS k, 'events ' || count(*) AS v FROM events WHERE event_type = 'error' GROUP BY 1)
SELECT coalesce(c_custkey, o.k, e.k) AS k, coalesce(e.v, o.v, c_mktsegment) AS v FROM customer FULL JOIN o ON c_custkey = o.k FULL JOIN e ON coalesce(c_custkey, o.k) = e.k
""")
def union_by_precedence(spark, sf):
    """Three tables under one key; the latest one that has it counts."""
    counted = lambda df, key, word: df.groupBy(F.col(key).alias("k")).agg(F.concat(F.lit(word), F.count("*").cast("string")).alias("v"))
    frames = [t(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("v")), counted(t(spark, sf, "orders"), "o_custkey", "orders "), counted(t(spark, sf, "events").where("event_type = 'error'"), "user_id", "events ")]
    return catalog.union_by_precedence(frames, ["k"])


@query("""
WITH u AS (SELECT p_partkey AS key, p_size AS s, p_size % 4 > 0 AS known FROM part WHERE p_size > 10)
SELECT key FROM u WHERE NOT known OR s % 2 = 1 OR s % 5 = 0
""")
def real_delta(spark, sf):
    """Varieties that bring a new key, alias or image; aliases compare by key, so that other capitals bring nothing."""
    p, s = t(spark, sf, "part"), F.col("p_size")
    image = _told("i", "p_partkey")
    update = p.where(s > 10).select(F.col("p_partkey").alias("key"), F.array("p_name", "p_type").alias("aliases"), F.when(s % 5 > 0, image).alias("image"))
    known = p.where(s % 4 > 0).select(F.col("p_partkey").alias("key"), F.when(s % 2 == 0, F.array(F.upper("p_name"), F.lower("p_type"))).otherwise(F.array("p_name")).alias("aliases"), image.alias("image"))
    return catalog.real_delta(update, known).select("key")


@query("""
WITH r AS (SELECT event_type AS source, event_id AS run, max(event_id) OVER w AS newest, max(CASE WHEN value < 20 THEN event_id END) OVER w AS whole FROM events WINDOW w AS (PARTITION BY event_type))
SELECT source, run FROM r WHERE run <> newest AND run IS DISTINCT FROM whole
""")
def superseded_runs(spark, sf):
    """Runs that retention may delete: neither a source's newest nor its newest complete one."""
    runs = t(spark, sf, "events").select(F.col("event_type").alias("source"), F.col("event_id").alias("run"), (F.col("value") < 20).alias("complete"))
    return catalog.superseded(runs, at="run").select("source", "run")


@query("""
WITH o AS (SELECT 'u' || c_custkey AS key, 'mint' AS action, c_mktsegment AS color, NULL AS target FROM customer WHERE c_acctbal > 0),
c AS (SELECT 'u' || s_suppkey AS key, CASE s_nationkey % 3 WHEN 0 THEN 'mint' WHEN 1 THEN 'alias' ELSE 'reject' END AS action, CASE WHEN s_nationkey % 3 = 0 THEN 'Teal' END AS color, CASE WHEN s_nationkey % 3 = 1 THEN s_name END AS target FROM supplier),
d AS (SELECT * FROM c UNION ALL SELECT * FROM o WHERE key NOT IN (SELECT key FROM c))
SELECT * FROM d UNION ALL SELECT DISTINCT 'u' || user_id, 'reject', NULL, NULL FROM events WHERE event_type = 'error' AND 'u' || user_id NOT IN (SELECT key FROM d)
""")
def decision_upserts(spark, sf):
    """Decisions replaced by later ones, then rejects learned for keys that nobody has decided."""
    blank = {c: F.lit(None).cast("string") for c in ("type", "country", "target_type")}
    old = t(spark, sf, "customer").where("c_acctbal > 0").select(_told("u", "c_custkey").alias("key"), F.lit("mint").alias("action"), F.col("c_mktsegment").alias("color"), F.lit(None).cast("string").alias("target")).withColumns(blank)
    n = F.col("s_nationkey") % 3
    changes = t(spark, sf, "supplier").select(_told("u", "s_suppkey").alias("key"), F.when(n == 0, "mint").when(n == 1, "alias").otherwise("reject").alias("action"), F.lit("Teal").alias("color"), F.col("s_name").alias("target")).withColumns(blank)
    found = t(spark, sf, "events").where("event_type = 'error'").select(_told("u", "user_id").alias("key"))
    return control.learn_rejects(control.decide(old, changes), found).select("key", "action", "color", "target")


@query("""
WITH l AS (SELECT 'u' || user_id AS ref, arg_max(event_type, event_id) AS note FROM events GROUP BY 1)
SELECT 'variety' AS kind, l.ref, note, CASE WHEN c_acctbal < 0 THEN 'reject' WHEN c_acctbal >= 0 THEN 'mint' END AS action FROM l LEFT JOIN customer ON l.ref = 'u' || c_custkey
UNION ALL SELECT 'attribute', 'u' || n_nationkey, n_name, CASE WHEN c_acctbal < 0 THEN 'reject' WHEN c_acctbal >= 0 THEN 'mint' END FROM nation LEFT JOIN customer ON n_nationkey = c_custkey
""")
def pending_queue(spark, sf):
    """One kind's queue replaced as a whole by the last row of each ref, the other kind's kept, each with what was decided."""
    row = lambda kind, ref, note: [F.lit(kind).alias("kind"), ref.alias("ref"), F.col(note).alias("note")]
    pending = t(spark, sf, "nation").select(*row("attribute", _told("u", "n_nationkey"), "n_name")).unionByName(t(spark, sf, "supplier").select(*row("variety", _told("old", "s_suppkey"), "s_name")))
    rows = t(spark, sf, "events").select(_told("u", "user_id").alias("ref"), F.col("event_type").alias("note"), F.col("event_id").alias("ordinal"))
    decided = t(spark, sf, "customer").select(_told("u", "c_custkey").alias("key"), F.when(F.col("c_acctbal") < 0, "reject").otherwise("mint").alias("action"))
    return control.pending_with_action(control.replace_pending(pending, "variety", rows), decided)


@query("SELECT 's' || s_suppkey AS source FROM supplier WHERE s_nationkey < 10 OR s_acctbal >= 0")
def seeded_sources(spark, sf):
    """Missing sources come in from the seed, but not removed ones."""
    s = t(spark, sf, "supplier").withColumn("source", _told("s", "s_suppkey"))
    return control.seed_sources(s.where("s_nationkey < 10").select("source"), s.select("source"), s.where("s_acctbal < 0").select("source"))


@query("""
WITH r AS (SELECT 's' || user_id AS source, CASE WHEN max(value) FILTER (event_type = 'error') > 150 THEN 'FAILED' ELSE 'OK' END AS status FROM events GROUP BY 1)
SELECT q.source, coalesce(status, 'absent') AS status FROM (SELECT 's' || s_suppkey AS source FROM supplier WHERE s_acctbal > 0) q LEFT JOIN r ON q.source = r.source WHERE status IS NULL OR status = 'FAILED'
""")
def blocked_auto_sources(spark, sf):
    bad = F.max(F.when(F.col("event_type") == "error", F.col("value"))) > 150
    results = t(spark, sf, "events").groupBy(_told("s", "user_id").alias("source")).agg(F.when(bad, "FAILED").otherwise("OK").alias("status"))
    asked = t(spark, sf, "supplier").select(_told("s", "s_suppkey").alias("source"), F.when(F.col("s_acctbal") > 0, "auto").otherwise("review").alias("mode"))
    return control.blocked_auto(asked, results)


@query("SELECT 'tile_' || replace(p_name, ' ', '_') || '_' || p_partkey AS key, 'tile' AS category, p_type FROM part WHERE p_size % 2 = 0")
def mirrored_backbone(spark, sf):
    kind = F.when(F.col("p_size") % 2 == 0, "slab").otherwise("block")
    posts = t(spark, sf, "part").select(F.concat_ws("_", kind, F.replace("p_name", F.lit(" "), F.lit("_")), F.col("p_partkey").cast("string")).alias("key"), kind.alias("category"), "p_type")
    return curation.mirrored(posts, "slab", "tile")


@query("""
WITH r AS (SELECT p_name AS variety, p_size % 4 IN (0, 1) AS real, [{'a': 'color', 'v': p_brand}, {'a': 'finish', 'v': p_type}][1:1 + p_size % 3 % 2] AS m FROM part)
SELECT variety, x.a AS attribute, x.v AS value, CASE WHEN bool_or(real) THEN 'likely_real' ELSE 'check' END AS verdict FROM (SELECT variety, real, unnest(m) AS x FROM r) GROUP BY ALL
""")
def leaf_suggestions(spark, sf):
    s = F.col("p_size")
    method = F.when(s % 4 == 0, "exact").when(s % 4 == 1, "projection_compact").when(s % 4 == 2, "fuzzy").otherwise("review")
    leaf = lambda a, c: F.struct(F.lit(a).alias("attribute"), F.col(c).alias("value"))
    missing = F.slice(F.array(leaf("color", "p_brand"), leaf("finish", "p_type")), F.lit(1), 1 + s % 3 % 2)
    return curation.leaf_suggestions(t(spark, sf, "part").select(F.col("p_name").alias("variety"), method.alias("method"), missing.alias("missing")))


@query("""
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 1 + o_custkey % 5 ELSE 7 END AS bundle_size, CASE WHEN o_orderkey % 4 <> 3 AND o_custkey % 2 = 0 THEN 'BR' ELSE 'IT' END AS origin, CASE WHEN NOT (o_orderkey % 4 <> 3 AND o_custkey % 2 = 0) THEN 'Carrara' END AS origin_city,
CASE WHEN o_orderkey % 4 = 1 THEN o_orderpriority ELSE 'title' END AS title, 'text' AS description FROM orders
""")
def overrides_applied(spark, sf):
    """What a person has set for a row: sound bundle sizes and countries only, texts that aren't blank."""
    o, k = t(spark, sf, "orders"), F.col("o_orderkey") % 4
    key = [F.col("o_orderstatus").alias("src_site"), F.col("o_orderkey").cast("string").alias("surrogate_key")]
    rows = o.select("o_orderkey", *key, F.lit(7).alias("bundle_size"), F.lit("IT").alias("origin"), F.lit("Carrara").alias("origin_city"), F.lit("title").alias("title"), F.lit("text").alias("description"))
    size = F.when(k == 0, (1 + F.col("o_custkey") % 5).cast("string")).when(k == 1, "-3").otherwise("many")
    told = o.where(k < 3).select(*key, size.alias("bundle_size"), F.when(F.col("o_custkey") % 2 == 0, " br ").otherwise("xx").alias("origin"), F.when(k == 1, F.col("o_orderpriority")).otherwise(" ").alias("title"), F.lit("").alias("description"))
    return derive.apply_overrides(rows, told, ["IT", "BR"]).select("o_orderkey", "bundle_size", "origin", "origin_city", "title", "description")


@query("""
WITH f AS (SELECT p_name AS v, p_type AS k, min('IT' || p_size) AS c FROM part WHERE p_size < 30 GROUP BY 1, 2), d AS (SELECT p_name AS v, p_type AS k, min('BR' || p_size) AS c FROM part WHERE p_size % 7 = 0 GROUP BY 1, 2)
SELECT v AS variety, lower(k) AS type, coalesce(d.c, f.c) AS countries FROM f FULL JOIN d USING (v, k)
""")
def origin_overlay(spark, sf):
    """Decided countries replace the file's for the same name and type, whatever their capitals, and add new ones."""
    p, s = t(spark, sf, "part"), F.col("p_size")
    file = p.where(s < 30).select(F.col("p_name").alias("variety"), F.lower("p_type").alias("type"), _told("IT", "p_size").alias("countries"))
    decided = p.where(s % 7 == 0).select(F.upper("p_name").alias("variety"), F.col("p_type").alias("type"), _told("BR", "p_size").alias("countries"))
    return derive.overlay_origins(file, decided).select(F.lower("variety").alias("variety"), F.lower("type").alias("type"), "countries")


@query("""
WITH a AS (SELECT lower(p_name) AS n, list_sort(list(DISTINCT p_type)) AS vs FROM part WHERE p_size % 3 = 0 GROUP BY 1)
SELECT p_partkey, array_to_string(list_concat(['economy', 'Slate'], coalesce(list_filter(vs, lambda x: lower(x) <> 'economy'), [])), '|') AS colors FROM part LEFT JOIN a ON lower(p_name) = n AND p_size % 5 > 0
""")
def leaf_overlay(spark, sf):
    """Approved colours join the backbone record of their name and type, at the end, unless their key is there."""
    p, s = t(spark, sf, "part"), F.col("p_size")
    leaves = p.select(F.upper("p_name").alias("name"), F.lit("STONE").alias("type"), F.lit("color").alias("attribute"), F.col("p_type").alias("value"), F.when(s % 3 == 0, "approve").otherwise("reject").alias("action"))
    backbone = p.select("p_partkey", F.col("p_name").alias("name"), F.when(s % 5 > 0, "stone").otherwise("other").alias("type"), F.array(F.lit("economy"), F.lit("Slate")).alias("color"))
    return control.overlay(backbone, leaves, "color").select("p_partkey", F.array_join("color", "|").alias("colors"))


@query("""
WITH r AS (SELECT p_partkey, p_name AS n, p_size AS s, p_size % 3 = 0 AS block, CASE WHEN p_size % 2 = 0 THEN 'Honed' END AS f, CASE WHEN p_size % 4 = 0 THEN string_split(p_name, ' ')[2] ELSE 'stone' END AS m FROM part),
u AS (SELECT *, concat_ws(' ', n, CASE WHEN NOT block THEN f END, CASE WHEN s % 4 > 0 THEN m END) AS raw FROM r),
w AS (SELECT *, array_to_string(list_transform(string_split(lower(raw), ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS title FROM u)
SELECT p_partkey, title, CASE WHEN s % 5 = 0 THEN 'A description given by a person ' || p_partkey ELSE title || '.' || CASE WHEN s BETWEEN 3 AND 80 THEN ' Thickness ' || s || ' mm.' ELSE '' END || CASE WHEN f IS NOT NULL THEN ' Finish: honed.' ELSE '' END END AS description,
CASE WHEN s % 7 > 0 THEN round(s * 25 / 1000.0, 3) ELSE round(2.0 * 1.0 * s / 1000.0 * 2700.0 / 1000.0, 3) END AS tonnes, CASE WHEN s % 7 > 0 THEN 'scrape' ELSE 'volume_density' END AS weight_method FROM w
""")
def titles_and_weights(spark, sf):
    """Each product's title, description and weight by their ladders."""
    s = F.col("p_size")
    finish, form = F.when(s % 2 == 0, "Honed"), F.when(s % 3 == 0, "block").otherwise("slab")
    material = F.when(s % 4 == 0, F.get(F.split("p_name", " "), F.lit(1))).otherwise("stone")
    p = t(spark, sf, "part").withColumn("title", derive.title(F.col("p_name"), finish, form, material))
    given = F.when(s % 5 == 0, _told("A description given by a person ", "p_partkey")).otherwise("short")
    kg = F.when(s % 7 > 0, (s * 25).cast("string")).otherwise("0")
    p = p.withColumn("w", derive.weight_tonnes(kg, F.lit(2.0), F.lit(1.0), s / 1000, F.lit(None).cast("double")))
    return p.select("p_partkey", "title", derive.description(given, F.col("title"), s / 1000, finish).alias("description"), F.col("w.value").alias("tonnes"), F.col("w.method").alias("weight_method"))
