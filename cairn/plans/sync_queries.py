"""Queries of the sync ledger's batches over the driver's tables, with the SQL that checks them; every query reads its whole tables."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import acks, ledger
from .catalog_queries import query, t

_ACK_BATCH = """
WITH a AS (SELECT event_id AS n, CASE WHEN event_id % 7 = 0 THEN 'variations' WHEN event_id % 7 IN (1, 4) THEN 'products' WHEN event_id % 7 = 2 THEN 'inventory' WHEN event_id % 7 IN (3, 5) THEN 'removed' END AS kind,
  CASE WHEN event_id % 7 = 0 OR (event_id % 7 = 3 AND user_id % 2 = 0) THEN 'v' || (user_id % 90) ELSE 'p' || (user_id % 400) END AS key, event_type <> 'error' AS ok, event_type = 'purchase' AS done, 'r' || event_id AS rid,
  CASE WHEN value > 50 THEN CASE WHEN event_id % 7 = 0 THEN 'BUILDING' ELSE '1-URGENT' END END AS echo, CASE WHEN event_id % 2 = 0 THEN user_id % 5 END AS qty FROM events),
v AS (SELECT 'v' || c_custkey AS key, CASE c_nationkey % 4 WHEN 0 THEN 'synced' WHEN 1 THEN 'retiring' ELSE 'dirty' END AS state, c_nationkey % 5 AS attempts, c_mktsegment AS hash FROM customer),
p AS (SELECT 'p' || o_orderkey AS key, 'v' || o_custkey AS vk, CASE o_orderstatus WHEN 'F' THEN 'synced' WHEN 'O' THEN 'pending' ELSE 'retiring' END AS state, o_orderkey % 5 AS attempts, o_orderpriority AS hash, o_custkey % 5 AS qty FROM orders),
s AS (SELECT 'v' || c_custkey AS key, 'variation' AS kind, 3 AS attempts FROM customer WHERE c_acctbal < 2000 UNION ALL SELECT 'p' || o_orderkey, 'product', o_orderkey % 5 FROM orders WHERE o_totalprice > 150000),
rm AS (SELECT a.n, a.key, a.done, s.kind, min(CASE WHEN a.done AND NOT (s.kind = 'variation' AND a.key IN (SELECT vk FROM p)) THEN n END) OVER (PARTITION BY a.key) AS gone FROM a JOIN s ON a.key = s.key WHERE a.kind = 'removed'),
ro AS (SELECT *, NOT done AND (gone IS NULL OR n < gone) AS counted FROM rm), g AS (SELECT key, min(gone) AS gone FROM ro WHERE kind = 'variation' AND gone IS NOT NULL GROUP BY key),
va AS (SELECT a.n, a.key, a.ok, a.rid, v.state <> 'retiring' AND (NOT a.ok OR a.echo IS NULL OR a.echo = v.hash) AND (g.gone IS NULL OR a.n < g.gone) AS hit FROM a JOIN v ON a.key = v.key LEFT JOIN g ON g.key = a.key WHERE a.kind = 'variations'),
vl AS (SELECT key, n, ok AS synced FROM va WHERE hit UNION ALL SELECT key, gone, FALSE FROM g UNION ALL SELECT key, -1, state = 'synced' FROM v),
pa AS (SELECT x.n, x.key, x.ok, x.rid, p.state <> 'retiring' AND (NOT x.ok OR ((x.echo IS NULL OR x.echo = p.hash) AND vl.synced)) AS hit FROM a x JOIN p ON x.key = p.key ASOF JOIN vl ON p.vk = vl.key AND x.n > vl.n WHERE x.kind = 'products'),
pl AS (SELECT key, n, ok AS synced FROM pa WHERE hit UNION ALL SELECT key, -1, state = 'synced' FROM p),
ia AS (SELECT x.n, x.key, x.ok AND pl.synced AND (x.qty IS NULL OR x.qty = p.qty) AS hit FROM a x JOIN p ON x.key = p.key ASOF JOIN pl ON x.key = pl.key AND x.n > pl.n WHERE x.kind = 'inventory'),
h AS (SELECT 'variations' AS kind, n, key, ok, rid FROM va WHERE hit UNION ALL SELECT 'products', n, key, ok, rid FROM pa WHERE hit),
o AS (SELECT *, max(CASE WHEN ok THEN n END) OVER (PARTITION BY kind, key) AS la FROM h),
f AS (SELECT kind, key, la, max(CASE WHEN n = la THEN rid END) AS rid, count(CASE WHEN NOT ok AND n > coalesce(la, -1) THEN 1 END) AS fails FROM o GROUP BY ALL),
e AS (SELECT 'variations' AS kind, key, state, attempts FROM v WHERE key NOT IN (SELECT key FROM g) UNION ALL SELECT 'products', key, state, attempts FROM p),
x AS (SELECT e.kind, e.key, e.state, f.key IS NOT NULL AS hit, f.rid, CASE WHEN f.key IS NULL OR f.la IS NULL THEN e.attempts ELSE 0 END + coalesce(f.fails, 0) AS attempts, f.fails FROM e LEFT JOIN f ON e.kind = f.kind AND e.key = f.key),
r AS (SELECT s.key, s.attempts + count(CASE WHEN ro.counted THEN 1 END) AS attempts, count(CASE WHEN ro.counted THEN 1 END) AS k, max(ro.gone) AS gone FROM s LEFT JOIN ro ON s.key = ro.key GROUP BY s.key, s.attempts)
SELECT kind, key, CASE WHEN NOT hit THEN state WHEN fails = 0 THEN 'synced' WHEN attempts >= 5 THEN 'gap_held' ELSE 'dirty' END AS state, CAST(attempts AS BIGINT) AS attempts, rid AS remote_id FROM x
UNION ALL SELECT 'inventory', p.key, CASE WHEN bool_or(hit) THEN 'held' ELSE 'open' END, any_value(qty), NULL FROM p LEFT JOIN ia ON p.key = ia.key GROUP BY p.key
UNION ALL SELECT 'removed', key, CASE WHEN k = 0 THEN 'pending' WHEN attempts >= 5 THEN 'dead' ELSE 'pending' END, attempts, NULL FROM r WHERE gone IS NULL
UNION ALL SELECT 'ack', CAST(a.n AS VARCHAR), CASE WHEN a.kind IS NULL THEN 'skipped' WHEN y.hit THEN 'applied' ELSE 'missed' END, 0, NULL FROM a LEFT JOIN
  (SELECT n, hit FROM va UNION ALL SELECT n, hit FROM pa UNION ALL SELECT n, hit FROM ia UNION ALL SELECT n, counted OR n = gone FROM ro) y ON a.n = y.n
"""


def _text(letter: str, c: str):
    return F.concat(F.lit(letter), F.col(c).cast("string"))


def _ledger(spark, sf) -> dict[str, DataFrame]:
    o, c = t(spark, sf, "orders"), t(spark, sf, "customer")
    none, nation = F.lit(None).cast("string"), F.col("c_nationkey") % 4
    blank = [none.alias("remote_id"), none.alias("error"), F.lit("2024-01-01").cast("timestamp").alias("updated_at")]
    stones = c.where("c_acctbal < 2000").select(_text("v", "c_custkey").alias("external_id"), F.lit("variation").alias("kind"), F.lit(3).alias("attempts"))
    stones = stones.unionByName(o.where("o_totalprice > 150000").select(_text("p", "o_orderkey").alias("external_id"), F.lit("product").alias("kind"), (F.col("o_orderkey") % 5).cast("int").alias("attempts")))
    return {
        "variations": c.select(_text("v", "c_custkey").alias("variation_key"), F.when(nation == 0, "synced").when(nation == 1, "retiring").otherwise("dirty").alias("state"), (F.col("c_nationkey") % 5).cast("int").alias("attempts"), F.col("c_mktsegment").alias("payload_hash"), *blank),
        "products": o.select(_text("p", "o_orderkey").alias("sku"), _text("v", "o_custkey").alias("variation_key"), F.when(F.col("o_orderstatus") == "F", "synced").when(F.col("o_orderstatus") == "O", "pending").otherwise("retiring").alias("state"), (F.col("o_orderkey") % 5).cast("int").alias("attempts"), F.col("o_orderpriority").alias("payload_hash"), *blank),
        "inventory": o.select(_text("p", "o_orderkey").alias("sku"), (F.col("o_custkey") % 5).cast("int").alias("qty"), F.lit(-1).alias("last_synced_qty")), "removed": stones.withColumn("state", F.lit("pending")),
    }


def _acks(spark, sf) -> DataFrame:
    n, u = F.col("event_id") % 7, F.col("user_id")
    text = lambda letter, c: F.concat(F.lit(letter), c.cast("string"))
    return t(spark, sf, "events").select(
        F.col("event_id").alias("ordinal"), F.when(n == 0, "variation").when(n.isin(1, 4), "products").when(n == 2, "inventory").when(n.isin(3, 5), "removed").otherwise("combinations").alias("type"),
        F.when((n == 0) | ((n == 3) & (u % 2 == 0)), text("v", u % 90)).otherwise(text("p", u % 400)).alias("external_id"), F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "purchase", "done").otherwise("synced").alias("status"),
        text("r", F.col("event_id")).alias("remote_id"), F.when(F.col("value") > 50, F.when(n == 0, "BUILDING").otherwise("1-URGENT")).alias("payload_hash"), F.when(F.col("event_id") % 2 == 0, u % 5).alias("quantity"),
    )


def _long(tables: dict[str, DataFrame], outcome: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    row = lambda name, kind, key, state, attempts, rid: tables[name].select(F.lit(kind).alias("kind"), F.col(key).alias("key"), state.alias("state"), attempts.cast("long").alias("attempts"), rid.alias("remote_id"))
    out = row("variations", "variations", "variation_key", F.col("state"), F.col("attempts"), F.col("remote_id")).unionByName(row("products", "products", "sku", F.col("state"), F.col("attempts"), F.col("remote_id")))
    out = out.unionByName(row("inventory", "inventory", "sku", F.when(F.col("last_synced_qty") == F.col("qty"), "held").otherwise("open"), F.col("qty"), none)).unionByName(row("removed", "removed", "external_id", F.col("state"), F.col("attempts"), none))
    return out.unionByName(outcome.select(F.lit("ack").alias("kind"), F.col("ordinal").cast("string").alias("key"), F.col("outcome").alias("state"), F.lit(0).cast("long").alias("attempts"), none.alias("remote_id")))


@query(_ACK_BATCH)
def ack_batch(spark, sf):
    return _long(*acks.apply_batch(_ledger(spark, sf), _acks(spark, sf), F.lit("2024-05-01").cast("timestamp")))


def _entity_events(spark, sf) -> DataFrame:
    kind = F.col("event_type")
    what = F.when(kind.isin("view", "click"), "serve").otherwise("ack")
    return t(spark, sf, "events").select(F.concat(F.lit("e"), F.col("user_id").cast("string")).alias("key"), F.col("event_id").alias("ordinal"), what.alias("what"), F.col("ts").cast("timestamp").alias("at"), (kind == "purchase").alias("ok"), F.concat(F.lit("r"), F.col("event_id").cast("string")).alias("remote_id"))


_LEASES = """
WITH e AS (SELECT 'e' || user_id AS key, event_id AS n, CASE WHEN event_type IN ('view', 'click') THEN 'serve' ELSE 'ack' END AS what, epoch_ms(ts) AS ms, event_type = 'purchase' AS ok FROM events),
g AS (SELECT *, sum(CASE WHEN what = 'ack' AND ok THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY n) AS g, max(CASE WHEN what = 'ack' THEN n END) OVER (PARTITION BY key) AS last FROM e),
m AS (SELECT *, max(g) OVER (PARTITION BY key) AS top FROM g), until AS (SELECT max(ms) - 3600000 AS w FROM e),
k AS (SELECT key, CAST(count(CASE WHEN what = 'ack' AND g = top AND NOT ok THEN 1 END) AS INTEGER) AS attempts, arg_max(CASE WHEN what = 'ack' AND ok THEN 'r' || n END, CASE WHEN what = 'ack' AND ok THEN n END) AS remote_id, any_value(top) AS top,
  list(ms ORDER BY n) FILTER (what = 'serve' AND (last IS NULL OR n > last)) AS pages FROM m GROUP BY key),
b AS (SELECT *, CASE WHEN attempts >= 5 THEN 'gap_held' WHEN attempts > 0 THEN 'dirty' WHEN top > 0 THEN 'synced' ELSE 'pending' END AS base, list_reduce(pages, lambda a, t: CASE WHEN t - a > 900000 THEN t ELSE a END) AS leased FROM k)
SELECT key, CASE WHEN base IN ('gap_held', 'synced') OR leased IS NULL THEN base WHEN leased + 900000 < w THEN 'dirty' ELSE 'syncing' END AS state, attempts, remote_id FROM b, until
"""


@query(_LEASES)
def lease_state(spark, sf):
    from ..streaming import leases

    e = _entity_events(spark, sf)
    until = e.agg(F.max("at").alias("x")).first()["x"]
    return leases.at_once(e, F.lit(until) - F.expr("INTERVAL 1 HOUR"))


@query(_LEASES)
def streaming_lease_state(spark, sf):
    """The same as a stream: events come in four slices, each a micro-batch."""
    from ..streaming import leases
    from ..streaming.paths import scratch

    e, root = _entity_events(spark, sf), scratch(spark, "leases")
    size = e.agg(F.max("ordinal").alias("x")).first()["x"] // 4 + 1
    for k in range(4):
        e.where(F.floor(F.col("ordinal") / size) == k).coalesce(1).write.mode("append").parquet(f"{root}/in")
    source = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    leases.run(spark, leases.ledger_rows(source, "1 hour"), f"{root}/log", f"{root}/checkpoint")
    return leases.latest(spark, f"{root}/log")


_RESET = """
WITH v AS (SELECT 'v' || c_custkey AS key, CASE c_nationkey % 4 WHEN 0 THEN 'synced' WHEN 1 THEN 'retiring' ELSE 'dirty' END AS state, c_nationkey % 5 AS attempts, c_acctbal >= 0 AS in_full, c_custkey IN (SELECT o_custkey FROM orders) AS used FROM customer),
p AS (SELECT 'p' || o_orderkey AS key, o_orderstatus AS st, o_orderpriority LIKE '1%' AS mine, CASE o_orderstatus WHEN 'F' THEN 'synced' WHEN 'O' THEN 'pending' ELSE 'retiring' END AS state, o_orderkey % 5 AS attempts, o_custkey % 5 AS qty FROM orders),
s AS (SELECT 'v' || c_custkey AS key, 3 AS attempts FROM customer WHERE c_acctbal < 2000 UNION ALL SELECT 'p' || o_orderkey, o_orderkey % 5 FROM orders WHERE o_totalprice > 150000),
x AS (SELECT *, NOT in_full AND NOT used AND state <> 'retiring' AS gone FROM v)
SELECT 'soft variations' AS kind, key, CASE WHEN gone OR state = 'retiring' THEN 'retiring' ELSE 'pending' END AS state, CASE WHEN gone OR state = 'retiring' THEN attempts ELSE 0 END AS attempts FROM x
UNION ALL SELECT 'soft products', key, CASE WHEN state = 'retiring' THEN state ELSE 'pending' END, CASE WHEN state = 'retiring' THEN attempts ELSE 0 END FROM p
UNION ALL SELECT 'soft inventory', key, 'open', qty FROM p
UNION ALL SELECT 'soft removed', s.key, 'pending', CASE WHEN s.key IN (SELECT key FROM x WHERE gone) THEN 0 ELSE attempts END FROM s UNION ALL SELECT 'soft removed', key, 'pending', 0 FROM x WHERE gone AND key NOT IN (SELECT key FROM s)
UNION ALL SELECT 'hard products', key, state, attempts FROM p WHERE NOT mine UNION ALL SELECT 'hard inventory', key, 'held', qty FROM p WHERE NOT mine
UNION ALL SELECT 'hard removed', key, 'pending', CASE WHEN key IN (SELECT key FROM p WHERE mine AND st = 'F') THEN 0 ELSE attempts END FROM s UNION ALL SELECT 'hard removed', key, 'pending', 0 FROM p WHERE mine AND st = 'F' AND key NOT IN (SELECT key FROM s)
"""


@query(_RESET)
def reset_state(spark, sf):
    """A soft reset of everything with stale varieties pruned, and a hard one of one source's products."""
    ts = _ledger(spark, sf)
    c, o, now = t(spark, sf, "customer"), t(spark, sf, "orders"), F.lit("2024-05-01").cast("timestamp")
    ts["variations"] = ts["variations"].join(c.select(_text("v", "c_custkey").alias("variation_key"), (F.col("c_acctbal") >= 0).cast("int").alias("in_full")), "variation_key")
    ts["products"] = ts["products"].drop("remote_id").join(o.select(_text("p", "o_orderkey").alias("sku"), F.col("o_orderpriority").alias("source"), F.when(F.col("o_orderstatus") == "F", "r").otherwise("").alias("remote_id")), "sku")
    ts["inventory"] = ts["inventory"].withColumn("last_synced_qty", F.col("qty"))
    urgent = [r[0] for r in o.select("o_orderpriority").distinct().where("o_orderpriority like '1%'").collect()]
    keys = {"variations": "variation_key", "products": "sku", "inventory": "sku", "removed": "external_id"}

    def told(label: str, changed: dict) -> list[DataFrame]:
        state = lambda k: F.when(F.col("last_synced_qty").isNull(), "open").otherwise("held") if k == "inventory" else F.col("state")
        return [df.select(F.lit(f"{label} {k}").alias("kind"), F.col(keys[k]).alias("key"), state(k).alias("state"), F.col("qty" if k == "inventory" else "attempts").cast("long").alias("attempts")) for k, df in sorted(changed.items())]

    return reduce(DataFrame.unionByName, told("soft", ledger.reset(ts, now, prune_stale=True)) + told("hard", ledger.reset(ts, now, hard=True, sources=urgent)))


@query("""
WITH i AS (SELECT 'p' || o_orderkey AS sku, o_custkey % 5 AS qty, CASE WHEN o_orderstatus = 'F' THEN o_custkey % 5 END AS last FROM orders WHERE o_orderpriority NOT LIKE '5%'),
r AS (SELECT sku, 'h' || sku AS handle, CAST(qty AS VARCHAR) AS quantity FROM i WHERE last IS DISTINCT FROM qty),
f AS (SELECT sku, handle, CASE WHEN sku LIKE '%77' THEN '9' ELSE quantity END AS quantity FROM r WHERE sku NOT LIKE '%13')
SELECT sku, quantity, 'one' AS side FROM (SELECT * FROM r EXCEPT SELECT * FROM f) UNION ALL SELECT sku, quantity, 'two' FROM (SELECT * FROM f EXCEPT SELECT * FROM r)
""")
def rendered_stock_differences(spark, sf):
    """Stock rendered from the ledger against a file that lacks some rows and has others changed."""
    from ..operators import render

    o = t(spark, sf, "orders")
    sku = _text("p", "o_orderkey")
    held = o.where("o_orderpriority not like '5%'").select(sku.alias("sku"), (F.col("o_custkey") % 5).cast("int").alias("qty"), F.when(F.col("o_orderstatus") == "F", F.col("o_custkey") % 5).cast("int").alias("last_synced_qty"))
    own = render.stock(held, o.select(sku.alias("sku"), F.concat(F.lit("h"), sku).alias("handle")))
    key, quantity = render.STOCK_COLUMNS[0], render.STOCK_COLUMNS[2]
    file = own.where(~F.col(key).endswith("13")).withColumn(quantity, F.when(F.col(key).endswith("77"), "9").otherwise(F.col(quantity)))
    return render.differences(own, file, [key]).select(F.col(key).alias("sku"), F.col(quantity).alias("quantity"), "side")
