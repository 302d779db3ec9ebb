"""A batch of acknowledgements over the ledger's tables, as if each were applied in turn.

Whether an acknowledgement counts depends on few things: its row isn't retiring, the version it echoes is the row's, a product's variety (stock's
product) is synced at that moment.  The first two don't change within a batch; the last is looked up as of the acknowledgement's
place.  So a batch is folded by key in four steps (removals, varieties, products, stock) with aggregates and joins, whatever the number
of acknowledgements; what each step found is written once to the shared folder for the next.  No table is walked in order, and a key with many of them is dealt to many tasks.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from .joins import dealt_join, written

#: What a type is called; any other is malformed.
KINDS = {"variation": "variations", "variations": "variations", "product": "products", "products": "products", "inventory": "inventory", "removed": "removed"}
ACK = {"remote_id": "string", "payload_hash": "string", "quantity": "long", "reason": "string"}
REASON = 500


def as_of(events: DataFrame, key: str, order: str, value: str, to: str, block: int = 100_000) -> DataFrame:
    """Adds to each event the last value that isn't null among its key's earlier ones.

    Events are numbered; a task orders one block of numbers of one key, and what earlier blocks leave is carried over by a summary of a row a block.
    """
    marked = events.withColumn("_b", F.floor(F.col(order) / block))
    within = Window.partitionBy(key, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    near = marked.withColumn("_near", F.last(value, ignorenulls=True).over(within))
    ends = marked.where(F.col(value).isNotNull()).groupBy(key, "_b").agg(F.max_by(value, order).alias("_end"))
    blocks = marked.select(key, "_b").distinct().join(ends, [key, "_b"], "left")
    carried = blocks.withColumn("_far", F.last("_end", ignorenulls=True).over(Window.partitionBy(key).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)))
    return near.join(carried.drop("_end"), [key, "_b"]).withColumn(to, F.coalesce("_near", "_far")).drop("_near", "_far", "_b")


def tidy(acks: DataFrame) -> DataFrame:
    """(ordinal, kind, external_id, status, …): kind is null for a malformed acknowledgement."""
    kind = F.coalesce(*(F.when(F.col("type") == k, F.lit(v)) for k, v in KINDS.items()))
    more = [(F.col(c) if c in acks.columns else F.lit(None)).cast(t).alias(c) for c, t in ACK.items()]
    named = acks.select("ordinal", F.when(F.col("external_id").isNotNull(), kind).alias("kind"), F.col("external_id").cast("string").alias("external_id"), F.coalesce("status", F.lit("synced")).alias("status"), *more)
    return named.withColumn("ok", F.col("status") != "failed")


def _removals(stones: DataFrame, acks: DataFrame, children: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tombstones, (key, gone_at) of varieties that leave, (ordinal, applied))."""
    kids = children.select(F.col("variation_key").cast("string").alias("external_id"), F.lit(True).alias("_kids")).distinct()
    of = stones.select("external_id", "kind").join(kids, "external_id", "left").withColumn("_bound", (F.col("kind") == "variation") & F.coalesce("_kids", F.lit(False))).select("external_id", F.col("kind").alias("_kind"), "_bound")
    mine = dealt_join(acks.where("kind = 'removed'").select("ordinal", "external_id", "status", "reason"), of, "external_id")
    mine = mine.withColumn("_done", F.col("status") == "done")
    ends = mine.groupBy("external_id", "_kind").agg(F.min(F.when(F.col("_done") & ~F.col("_bound"), F.col("ordinal"))).alias("gone_at"))
    placed = written(dealt_join(mine, ends.drop("_kind"), "external_id")).withColumn("_before", F.col("gone_at").isNull() | (F.col("ordinal") < F.col("gone_at")))
    counted = F.col("_before") & ~F.col("_done")
    told = placed.groupBy("external_id").agg(F.count(F.when(counted, 1)).alias("_n"), F.max_by("reason", F.when(counted, F.col("ordinal"))).alias("_why"), F.min("gone_at").alias("_gone"))
    left = stones.join(told, "external_id", "left").where("_gone is null")
    held = F.coalesce("_n", F.lit(0)) > 0
    left = left.withColumn("attempts", F.when(held, F.coalesce("attempts", F.lit(0)) + F.col("_n")).otherwise(F.col("attempts")).cast("int"))
    left = left.withColumn("state", F.when(~held, F.col("state")).when(F.col("attempts") >= C.DEAD_LETTER, "dead").otherwise("pending"))
    if "error" in stones.columns:
        left = left.withColumn("error", F.when(held, F.substring(F.coalesce("_why", F.lit("blocked")), 1, REASON)).otherwise(F.col("error")))
    gone = placed.where("_kind = 'variation' and gone_at is not null").select("external_id", "gone_at").distinct()
    return left.select(*stones.columns), gone, placed.select("ordinal", (counted | (F.col("ordinal") == F.col("gone_at"))).alias("applied"))


def _fold(state: DataFrame, key: str, events: DataFrame, now: Column) -> DataFrame:
    """The rows after those of the events (external_id, ordinal, ok, remote_id, reason) that count: a success syncs, failures count up since the last one and at the cap hold the row."""
    last = events.groupBy("external_id").agg(F.max(F.when(F.col("ok"), F.col("ordinal"))).alias("_at"), F.max_by("remote_id", F.when(F.col("ok"), F.col("ordinal"))).alias("_rid"))
    after = dealt_join(events, last.drop("_rid"), "external_id").where(~F.col("ok") & (F.col("_at").isNull() | (F.col("ordinal") > F.col("_at"))))
    fails = after.groupBy("external_id").agg(F.count("*").alias("_fails"), F.max_by(F.struct("reason"), "ordinal").alias("_why"))
    told = last.join(fails, "external_id", "left").withColumnRenamed("external_id", key)
    j = state.join(told.withColumn("_hit", F.lit(True)), key, "left")
    hit, synced = F.coalesce("_hit", F.lit(False)), F.col("_at").isNotNull()
    n = F.coalesce("_fails", F.lit(0)) + F.when(synced, 0).otherwise(F.coalesce("attempts", F.lit(0)))
    failed = hit & (F.coalesce("_fails", F.lit(0)) > 0)
    new = {
        "state": F.when(~hit, F.col("state")).when(~failed, "synced").when(n >= C.DEAD_LETTER, "gap_held").otherwise("dirty"), "attempts": F.when(hit, n).otherwise(F.col("attempts")).cast("int"),
        "remote_id": F.when(hit & synced, F.col("_rid")).otherwise(F.col("remote_id")), "error": F.when(failed, F.substring(F.coalesce("_why.reason", F.lit("apply failed")), 1, REASON)).when(~hit, F.col("error")),
        "updated_at": F.when(hit, now).otherwise(F.col("updated_at")),
    }
    return j.select(*(new.get(c, F.col(c)).alias(c) for c in state.columns))


def _sound(events: DataFrame) -> Column:
    """Not retiring, and a success is of the row's version."""
    return (F.col("_state") != "retiring") & (~F.col("ok") | F.col("payload_hash").isNull() | (F.col("payload_hash") == F.col("_hash")))


def _timeline(events: DataFrame) -> DataFrame:
    """(key, ordinal, synced) after each event that counts."""
    return events.where("applied").select(F.col("external_id").alias("key"), "ordinal", F.col("ok").alias("synced"))


def _with_parent(events: DataFrame, parent: str, timeline: DataFrame, start: DataFrame) -> DataFrame:
    """Adds `ready`: the parent was synced when the event came.  start (key, was)."""
    asked = events.withColumnRenamed(parent, "key").withColumn("synced", F.lit(None).cast("boolean"))
    both = as_of(asked.withColumn("_ask", F.lit(True)).unionByName(timeline, allowMissingColumns=True), "key", "ordinal", "synced", "_seen").where("_ask")
    return dealt_join(both, start, "key", "left").withColumn("ready", F.coalesce("_seen", "was", F.lit(False))).drop("_ask", "_seen", "was", "synced").withColumnRenamed("key", parent)


def apply_batch(tables: dict[str, DataFrame], acks: DataFrame, now: Column) -> tuple[dict[str, DataFrame], DataFrame]:
    """(changed tables, (ordinal, outcome)) after the acknowledgements in the order of their ordinals, which are distinct.

    tables: variations (variation_key, state, payload_hash, attempts, remote_id, error, updated_at), products (sku, variation_key, …), inventory (sku, qty,
    last_synced_qty), removed (external_id, kind, state, attempts), and optionally combinations (variation_key).  acks (ordinal, type, external_id,
    status, and optionally remote_id, payload_hash, quantity, reason).  outcome: applied, missed (unknown, refused or too early) or skipped (malformed).
    """
    a = tidy(acks)
    keyed = lambda df, c: df.withColumn(c, F.col(c).cast("string"))
    variations, products, stock, stones = keyed(tables["variations"], "variation_key"), keyed(keyed(tables["products"], "sku"), "variation_key"), keyed(tables["inventory"], "sku"), keyed(tables["removed"], "external_id")
    if "attempts" not in stones.columns:
        stones = stones.withColumn("attempts", F.lit(None).cast("int"))
    children = reduce(DataFrame.unionByName, [df.select("variation_key") for df in (products, keyed(tables["combinations"], "variation_key") if "combinations" in tables else None) if df is not None])
    left, gone, r_out = _removals(stones, a, children)
    of = lambda kind: a.where(F.col("kind") == kind)
    rows = lambda df, key: df.select(F.col(key).alias("external_id"), F.col("state").alias("_state"), F.col("payload_hash").alias("_hash"), *(["variation_key"] if key == "sku" else []))

    v = dealt_join(of("variations"), rows(variations, "variation_key"), "external_id")
    v = dealt_join(v, gone, "external_id", "left").withColumn("applied", _sound(v) & (F.col("gone_at").isNull() | (F.col("ordinal") < F.col("gone_at"))))
    v = written(v.drop("_state", "_hash", "gone_at"))
    v_next = _fold(variations, "variation_key", v.where("applied"), now).join(gone.select(F.col("external_id").alias("variation_key")), "variation_key", "left_anti")
    v_line = _timeline(v).unionByName(gone.select(F.col("external_id").alias("key"), F.col("gone_at").alias("ordinal"), F.lit(False).alias("synced")))

    p = dealt_join(of("products"), rows(products, "sku"), "external_id")
    p = _with_parent(p, "variation_key", v_line, variations.select(F.col("variation_key").alias("key"), (F.col("state") == "synced").alias("was")))
    p = written(p.withColumn("applied", _sound(p) & (~F.col("ok") | F.col("ready"))).drop("_state", "_hash", "ready"))
    p_next = _fold(products, "sku", p.where("applied"), now)

    held = stock.select(F.col("sku").alias("external_id"), "qty")
    i = dealt_join(of("inventory").where("ok"), held, "external_id")
    i = _with_parent(i.withColumn("sku", F.col("external_id")), "sku", _timeline(p), products.select(F.col("sku").alias("key"), (F.col("state") == "synced").alias("was")))
    i = written(i.withColumn("applied", F.col("ready") & (F.col("quantity").isNull() | (F.col("quantity") == F.col("qty")))).select("ordinal", "sku", "applied"))
    known = i.where("applied").select("sku", F.lit(True).alias("_in")).distinct()
    i_next = stock.join(known, "sku", "left").withColumn("last_synced_qty", F.when(F.col("_in"), F.col("qty")).otherwise(F.col("last_synced_qty"))).select(*stock.columns)

    done = reduce(DataFrame.unionByName, [x.select("ordinal", F.coalesce("applied", F.lit(False)).alias("applied")) for x in (r_out, v, p, i)])
    outcome = F.when(F.col("kind").isNull(), "skipped").when(F.col("applied"), "applied").otherwise("missed")
    told = a.select("ordinal", "kind").join(done, "ordinal", "left").select("ordinal", outcome.alias("outcome"))
    return {"variations": v_next, "products": p_next, "inventory": i_next, "removed": left}, told


def counts(outcomes: DataFrame) -> dict[str, int]:
    """How many of a batch were applied, missed and skipped."""
    found = {r["outcome"]: r["count"] for r in outcomes.groupBy("outcome").count().collect()}
    return {k: found.get(k, 0) for k in ("applied", "missed", "skipped")}
