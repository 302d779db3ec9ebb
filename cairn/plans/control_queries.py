"""Queries of the sources' configuration, ids and write-through over the driver's tables, with the SQL that checks them; every query reads its whole tables."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import commits, control, derive, resolve, source_requests, writethrough
from ..streaming.paths import scratch
from .catalog_queries import query, t

_AT = "2024-01-01"
_ADAPTERS = 100  # sources that code knows


@query(f"""
WITH RECURSIVE s AS (SELECT 's' || s_suppkey AS source, 'C' || s_suppkey AS source_code, ['p' || s_nationkey] AS ports, s_acctbal > 0 AS enabled, CASE WHEN s_nationkey < 5 THEN 'delisted' WHEN s_acctbal < 1000 THEN 'paused' END AS lifecycle, s_name AS vendor FROM supplier),
gone AS (SELECT DISTINCT 's' || user_id AS source FROM events WHERE user_id % 7 = 0 AND user_id NOT IN (SELECT s_suppkey FROM supplier)),
p AS (SELECT l_orderkey * 10 + l_linenumber AS sku, 's' || l_suppkey AS source, CASE WHEN l_suppkey % 3 > 0 AND l_quantity > 25 THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS qty FROM lineitem),
q AS (SELECT event_id AS n, 's' || user_id AS source, CASE event_type WHEN 'signup' THEN 'put' WHEN 'purchase' THEN 'resume' WHEN 'view' THEN CASE WHEN value > 5 THEN 'pause' ELSE 'polish' END
      WHEN 'click' THEN CASE WHEN value > 40 THEN 'clean' ELSE 'delist' END ELSE CASE WHEN value > 40 THEN 'purge' ELSE 'remove' END END AS verb,
      CASE WHEN value % 2 < 1.5 THEN 'C' || user_id ELSE ' c' || (user_id + 1) END AS source_code, CASE WHEN value < 10 THEN [' '] ELSE ['q' || CAST(floor(value) AS BIGINT)] END AS ports, value < 60 AS enabled, user_id >= {_ADAPTERS} AS unknown FROM events),
a AS (SELECT *, lower(trim(source_code)) AS c, CASE WHEN unknown THEN 'no_adapter' WHEN trim(ports[1]) = '' THEN 'no_port' END AS e FROM q WHERE verb = 'put'),
h AS (SELECT lower(source_code) AS c, source AS holder FROM s), f AS (SELECT c, arg_min(source, n) AS taker FROM a WHERE e IS NULL GROUP BY c),
b AS (SELECT a.n, CASE WHEN e IS NOT NULL THEN e WHEN coalesce(holder, taker) <> source THEN 'code_taken' END AS refusal FROM a LEFT JOIN h USING (c) LEFT JOIN f USING (c)),
k AS (SELECT q.*, refusal, row_number() OVER (PARTITION BY source ORDER BY q.n) AS r FROM q LEFT JOIN b ON q.n = b.n),
w AS (SELECT x.source, CAST(0 AS BIGINT) AS r, CAST(NULL AS BIGINT) AS n, CASE WHEN s.source IS NULL THEN 'absent' ELSE coalesce(lifecycle, 'active') END AS life, x.source IN (SELECT source FROM p WHERE qty > 0) AS live, '' AS was, FALSE AS had
      FROM (SELECT DISTINCT source FROM q UNION SELECT source FROM s) x LEFT JOIN s ON x.source = s.source
      UNION ALL SELECT k.source, k.r, k.n, CASE WHEN refusal IS NOT NULL THEN life WHEN verb = 'put' THEN CASE WHEN life = 'absent' THEN 'active' ELSE life END WHEN life = 'absent' THEN life
        WHEN verb = 'pause' THEN 'paused' WHEN verb = 'resume' THEN 'active' WHEN verb = 'delist' THEN 'delisted' WHEN verb = 'remove' AND NOT live THEN 'absent' ELSE life END,
        live AND NOT (verb = 'delist' AND life <> 'absent'), life, live FROM w JOIN k ON k.source = w.source AND k.r = w.r + 1),
d AS (SELECT k.*, life, CASE WHEN verb = 'polish' THEN 'no_such_request' WHEN refusal IS NOT NULL THEN refusal WHEN verb <> 'put' AND was = 'absent' THEN 'unknown_source' WHEN verb = 'remove' AND had THEN 'live_products'
      WHEN verb = 'clean' AND was IN ('paused', 'delisted') THEN 'frozen' WHEN verb = 'resume' AND was = 'delisted' THEN 'restock_required' END AS detail FROM k JOIN w ON k.source = w.source AND k.r = w.r),
o AS (SELECT *, CASE WHEN detail IS NULL OR detail = 'restock_required' THEN 200 WHEN detail = 'no_such_request' THEN 405 WHEN detail = 'unknown_source' THEN 404 WHEN detail IN ('live_products', 'frozen') THEN 409 ELSE 400 END AS code FROM d),
z AS (SELECT source, arg_max(life, n) AS life, max(n) FILTER (code = 200 AND verb = 'put') AS put, max(n) FILTER (code = 200 AND verb = 'remove') AS rm, min(n) FILTER (code = 200 AND verb = 'delist') AS off, max(n) FILTER (code = 200 AND verb IN ('purge', 'remove')) AS purged,
      max(n) FILTER (code = 200 AND verb IN ('put', 'pause', 'resume', 'delist')) AS ran, max(n) FILTER (code = 200 AND verb = 'clean') AS cleaned FROM o GROUP BY source)
SELECT 'answer' AS kind, source, n AS id, verb || ' ' || code || ' ' || coalesce(detail, '') AS what FROM o
UNION ALL SELECT 'source', coalesce(s.source, z.source), 0, concat_ws('|', CASE WHEN put IS NULL THEN s.source_code ELSE u.source_code END, CASE WHEN put IS NULL THEN s.ports[1] ELSE u.ports[1] END,
  CASE WHEN ran IS NULL THEN s.enabled WHEN v.verb = 'put' THEN v.enabled ELSE v.verb = 'resume' END, CASE WHEN z.source IS NULL THEN coalesce(s.lifecycle, 'active') ELSE life END, CASE WHEN rm IS NULL THEN vendor END)
  FROM s FULL JOIN z ON s.source = z.source LEFT JOIN q u ON u.n = put LEFT JOIN q v ON v.n = ran WHERE life IS NULL OR life <> 'absent'
UNION ALL SELECT 'removed', source, 0, '' FROM (SELECT source FROM gone WHERE source NOT IN (SELECT source FROM z WHERE put IS NOT NULL AND (rm IS NULL OR put > rm)) UNION SELECT source FROM z WHERE rm IS NOT NULL AND (put IS NULL OR rm > put))
UNION ALL SELECT 'cleaned', source, 0, '' FROM z WHERE cleaned IS NOT NULL
UNION ALL SELECT 'product', p.source, sku, CAST(CASE WHEN off IS NULL THEN qty ELSE 0 END AS VARCHAR) FROM p LEFT JOIN z ON z.source = p.source WHERE NOT (purged IS NOT NULL AND (qty = 0 OR coalesce(off < purged, FALSE)))
""")
def source_request_batch(spark, sf):
    """Requests to sources in their order: what each answers, and the sources, removals, scrapes to delete and stock after them."""
    tables, asked = _sources(spark, sf)
    out, answers = source_requests.apply_requests(tables, asked, [f"s{i}" for i in range(_ADAPTERS)])
    row = lambda df, kind, id_, what: df.select(F.lit(kind).alias("kind"), "source", id_.cast("long").alias("id"), what.alias("what"))
    none, zero = F.lit(""), F.lit(0)
    said = F.concat_ws(" ", "verb", F.col("code").cast("string"), F.coalesce("detail", F.lit("")))
    now = F.concat_ws("|", "source_code", F.get("ports", F.lit(0)), F.col("enabled").cast("string"), F.coalesce("lifecycle", F.lit("active")), "vendor")
    parts = row(answers, "answer", F.col("n"), said).unionByName(row(out["sources"], "source", zero, now)).unionByName(row(out["removed"], "removed", zero, none))
    return parts.unionByName(row(out["cleaned"], "cleaned", zero, none)).unionByName(row(out["products"], "product", F.col("sku"), F.col("qty").cast("string")))


def _sources(spark, sf) -> tuple[dict[str, DataFrame], DataFrame]:
    s, e, li = t(spark, sf, "supplier"), t(spark, sf, "events"), t(spark, sf, "lineitem")
    name = lambda c: F.concat(F.lit("s"), F.col(c).cast("string"))
    life = F.when(F.col("s_nationkey") < 5, "delisted").when(F.col("s_acctbal") < 1000, "paused")
    sources = s.select(name("s_suppkey").alias("source"), F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("source_code"), F.array(F.concat(F.lit("p"), F.col("s_nationkey").cast("string"))).alias("ports"), (F.col("s_acctbal") > 0).alias("enabled"), life.alias("lifecycle"), F.col("s_name").alias("vendor"))
    removed = e.where("user_id % 7 = 0").select(name("user_id").alias("source")).distinct().join(sources.select("source"), "source", "left_anti")
    qty = F.when((F.col("l_suppkey") % 3 > 0) & (F.col("l_quantity") > 25), F.col("l_quantity").cast("long")).otherwise(0)
    products = li.select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sku"), name("l_suppkey").alias("source"), qty.alias("qty"))
    kind, value = F.col("event_type"), F.col("value")
    verb = F.when(kind == "signup", "put").when(kind == "purchase", "resume").when(kind == "view", F.when(value > 5, "pause").otherwise("polish")).when(kind == "click", F.when(value > 40, "clean").otherwise("delist")).otherwise(F.when(value > 40, "purge").otherwise("remove"))
    code = F.when(value % 2 < 1.5, F.concat(F.lit("C"), F.col("user_id").cast("string"))).otherwise(F.concat(F.lit(" c"), (F.col("user_id") + 1).cast("string")))
    port = F.when(value < 10, F.lit(" ")).otherwise(F.concat(F.lit("q"), F.floor(value).cast("string")))
    asked = e.select(F.col("event_id").alias("n"), name("user_id").alias("source"), verb.alias("verb"), code.alias("source_code"), F.array(port).alias("ports"), (value < 60).alias("enabled"))
    return {"sources": sources, "removed": removed, "products": products}, asked


@query("""
SELECT substr(sha256(string_agg(i || chr(0), '' ORDER BY i)), 1, 16) AS fingerprint
FROM (SELECT DISTINCT 'part_' || p_partkey AS i FROM part UNION SELECT 'cust_' || c_custkey FROM customer UNION SELECT p_name FROM part UNION SELECT s_name FROM supplier)
""")
def id_fingerprint(spark, sf):
    """The digest of all ids and names in their order, range after range."""
    col = lambda table, c: t(spark, sf, table).select(c.alias("id"))
    told = lambda word, c: F.concat(F.lit(word), F.col(c).cast("string"))
    ids = col("part", told("part_", "p_partkey")).unionByName(col("customer", told("cust_", "c_custkey"))).unionByName(col("part", F.col("p_name"))).unionByName(col("supplier", F.col("s_name")))
    return control.backend_fingerprint(ids, held=1_000)


@query("""
WITH b AS (SELECT 'v' || p_partkey AS id, 'slab-' || lower(p_name) || '-' || p_partkey AS key, 0 AS o FROM part WHERE p_size <= 20 UNION ALL SELECT 'v' || p_partkey, 'block-' || p_partkey, 1 FROM part WHERE p_size BETWEEN 10 AND 30 UNION ALL SELECT 'v' || p_partkey, 'tile-' || p_type, 2 FROM part WHERE p_size BETWEEN 25 AND 40)
SELECT l_orderkey, l_linenumber, key AS variation_key FROM lineitem LEFT JOIN (SELECT id, arg_min(key, o) AS key FROM b GROUP BY id) k ON k.id = 'v' || l_partkey
""")
def variation_keys(spark, sf):
    """Each listed product's variety by its stable key, from the first branch that has its id."""
    p, size = t(spark, sf, "part"), F.col("p_size")
    id_ = F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("id")
    slab = p.where(size <= 20).select(id_, F.concat(F.lit("slab-"), F.lower("p_name"), F.lit("-"), F.col("p_partkey").cast("string")).alias("key"))
    block = p.where(size.between(10, 30)).select(id_, F.concat(F.lit("block-"), F.col("p_partkey").cast("string")).alias("key"))
    tile = p.where(size.between(25, 40)).select(id_, F.concat(F.lit("tile-"), F.col("p_type")).alias("key"))
    rows = t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.concat(F.lit("v"), F.col("l_partkey").cast("string")).alias("variation_id"))
    return resolve.variation_keys(rows, [slab, block, tile]).select("l_orderkey", "l_linenumber", "variation_key")


@query("""
WITH v AS (SELECT CASE n_regionkey WHEN 0 THEN 'Blocks' WHEN 1 THEN 'Slabs' WHEN 2 THEN 'Tiles' ELSE 'Others' END AS label, CASE WHEN n_regionkey = 2 THEN ' ' ELSE 'pcat_' || n_nationkey END AS id, n_nationkey AS o FROM nation),
m AS (SELECT label, arg_max(id, o) AS id FROM v WHERE trim(id) <> '' GROUP BY label),
f AS (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'block' WHEN 1 THEN 'slab' WHEN 2 THEN CASE WHEN p_size > 25 THEN 'tile' ELSE 'slab' END ELSE 'mosaic' END AS f, CASE p_size % 4 WHEN 0 THEN 'tag' WHEN 1 THEN 'name_word' WHEN 2 THEN CASE WHEN p_size > 25 THEN 'tag' ELSE 'default' END ELSE 'override' END AS method FROM part)
SELECT p_partkey, CASE f WHEN 'block' THEN (SELECT id FROM m WHERE label = 'Blocks') WHEN 'slab' THEN (SELECT id FROM m WHERE label = 'Slabs') WHEN 'tile' THEN 'pcat_own' END AS category_pcat_id, 'format:' || method AS category_method FROM f
""")
def row_categories(spark, sf):
    """Each product's category by its format: the vocabulary's id of the label, else the registry's own."""
    k = F.col("p_size") % 4
    told = derive.format_ladder(F.when(k == 3, "Mosaic"), F.when(k == 0, "Blocks").when((k == 2) & (F.col("p_size") > 25), "tile"), F.when(k == 1, F.concat("p_name", F.lit(" slabs"))).otherwise("plain"), F.lit(False))
    region = F.col("n_regionkey")
    words = t(spark, sf, "nation").select(F.when(region == 0, "Blocks").when(region == 1, "Slabs").when(region == 2, "Tiles").otherwise("Others").alias("label"), F.when(region == 2, " ").otherwise(F.concat(F.lit("pcat_"), F.col("n_nationkey").cast("string"))).alias("pcat_id"), F.col("n_nationkey").alias("ordinal"))
    return derive.category(t(spark, sf, "part").withColumn("format", told), words, {"tile": "pcat_own", "slab": "unused"}).select("p_partkey", "category_pcat_id", "category_method")


@query("""
WITH v AS (SELECT 'v' || p_partkey AS key, p_size % 2 = 0 AS seeded, p_size % 3 = 0 AS full_, p_size % 5 = 0 AS changed FROM part),
o AS (SELECT 'o' || o_orderkey AS key, o_orderstatus AS st, o_orderkey, CAST(floor(o_totalprice / 1000) AS INT) AS q FROM orders)
SELECT 'variation' AS kind, key, CASE WHEN NOT seeded THEN 'pending' WHEN full_ AND changed THEN 'dirty' ELSE 'synced' END AS state, CAST(NULL AS INT) AS qty, CAST(NULL AS INT) AS last_synced_qty FROM v WHERE seeded OR full_
UNION ALL SELECT 'product', key, CASE WHEN st = 'P' AND o_orderkey % 2 = 0 THEN 'dirty' WHEN st = 'P' THEN 'synced' ELSE 'pending' END, NULL, NULL FROM o
UNION ALL SELECT 'inventory', key, NULL, CASE WHEN st = 'F' THEN 0 ELSE q END, CASE WHEN st = 'P' THEN q + 1 END FROM o
""")
def write_through(spark, sf):
    """A catalog and two runs of a source recorded by three commits; the second run changes nothing but stock that it lists or lacks."""
    root, now = scratch(spark, "ledger"), F.lit(_AT).cast("timestamp")
    k, part = F.col("p_size"), t(spark, sf, "part")
    variety = F.concat(F.lit("v"), F.col("p_partkey").cast("string")).alias("variation_key")
    synced = [F.lit("synced").alias("state"), now.alias("created_at"), now.alias("updated_at")]
    o = t(spark, sf, "orders").select(F.concat(F.lit("o"), F.col("o_orderkey").cast("string")).alias("sku"), "o_orderkey", "o_orderstatus", F.floor(F.col("o_totalprice") / 1000).cast("int").alias("qty"))
    older, turned = F.col("o_orderstatus") == "P", F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderkey") % 2 == 0), "h2").otherwise("h").alias("payload_hash")
    seeds = {
        "variations": part.where(k % 2 == 0).select(variety, F.lit("h").alias("payload_hash"), *synced),
        "products": o.where(older).select("sku", F.lit("h").alias("payload_hash"), *synced),
        "inventory": o.where(older).select("sku", (F.col("qty") + 1).alias("qty"), (F.col("qty") + 1).alias("last_synced_qty")),
    }
    full = part.where(k % 3 == 0).select(variety, F.when(k % 5 == 0, "h2").otherwise("h").alias("payload_hash"))
    run, none = o.select("sku", turned, "qty"), o.limit(0).select("sku")
    done = [
        writethrough.record_catalog(spark, root, full, now, seeds),
        writethrough.record_source(spark, root, run, none, now, seeds),
        writethrough.record_source(spark, root, run.where("payload_hash = 'h2'"), o.where("o_orderstatus = 'F'").select("sku"), now, seeds),
    ]
    if not all(done):
        raise RuntimeError("a run did not reach the ledger")
    at, nil = commits.read(spark, root), F.lit(None).cast("int")
    states = [at[f"{x}s"].select(F.lit(x).alias("kind"), F.col(c).alias("key"), "state", nil.alias("qty"), nil.alias("last_synced_qty")) for x, c in (("variation", "variation_key"), ("product", "sku"))]
    stock = at["inventory"].select(F.lit("inventory").alias("kind"), F.col("sku").alias("key"), F.lit(None).cast("string").alias("state"), "qty", "last_synced_qty")
    return states[0].unionByName(states[1]).unionByName(stock)
