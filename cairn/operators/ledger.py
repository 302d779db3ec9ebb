"""The sync ledger: keyed snapshots, leases, acknowledgements.  A transition is a join and a CASE, written as the next version."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions import numbers as N
from .commits import current, publish, write_version  # noqa: F401


def payload_hash(columns: list[str]) -> Column:
    return N.fingerprint(*(F.col(c) for c in columns))


def upsert(state: DataFrame, incoming: DataFrame, key: str, now: Column) -> DataFrame:
    """(key, payload_hash, state, created_at, updated_at): new rows pending, changed or retiring ones dirty, others as they were."""
    old = state.select(key, F.col("payload_hash").alias("_h"), F.col("state").alias("_s"), F.col("created_at").alias("_c"), F.col("updated_at").alias("_u"), F.lit(True).alias("_old"))
    new = incoming.select(key, "payload_hash", F.lit(True).alias("_new"))
    j = old.join(new, key, "full_outer")
    to = (
        F.when(F.col("_old").isNull(), "pending").when(F.col("_new").isNull(), F.col("_s")).when(F.col("_s") == "retiring", "dirty")
        .when(~F.col("_h").eqNullSafe(F.col("payload_hash")), F.when(F.col("_s") == "pending", "pending").otherwise("dirty")).otherwise(F.col("_s"))
    )
    touched = F.col("_new") & (F.col("_old").isNull() | ~F.col("_h").eqNullSafe(F.col("payload_hash")))
    return j.select(key, F.coalesce("payload_hash", "_h").alias("payload_hash"), to.alias("state"), F.coalesce("_c", now).alias("created_at"), F.when(touched, now).otherwise(F.col("_u")).alias("updated_at"))


def reap(state: DataFrame, now: Column) -> DataFrame:
    """Leases older than their time go back to dirty."""
    stale = (F.col("state") == "syncing") & (F.col("leased_at") < now - F.expr(f"INTERVAL {C.LEASE_SECONDS} SECONDS"))
    return state.withColumn("state", F.when(stale, "dirty").otherwise(F.col("state")))


def servable_products(products: DataFrame, variations: DataFrame) -> DataFrame:
    """Pending or dirty products whose variety is synced, typed and textured."""
    ready = variations.where((F.col("state") == "synced") & (F.trim("type") != "") & (F.trim("image_url") != "")).select("variation_key")
    return products.where(F.col("state").isin("pending", "dirty")).join(ready, "variation_key", "left_semi")


def page(rows: DataFrame, order: list[str], size: int = C.PAGE) -> DataFrame:
    return rows.orderBy(*order).limit(min(size, C.PAGE_MOST))


def serve(state: DataFrame, eligible: DataFrame, key: str, now: Column, size: int = C.PAGE) -> tuple[DataFrame, DataFrame]:
    """(page, next state): the page's rows are leased."""
    out = page(eligible, ["created_at", key], size)
    leased = state.join(out.select(key, F.lit(True).alias("_out")), key, "left")
    return out, leased.withColumn("state", F.when(F.col("_out"), "syncing").otherwise(F.col("state"))).withColumn("leased_at", F.when(F.col("_out"), now).otherwise(F.col("leased_at"))).drop("_out")


def inventory_deltas(inventory: DataFrame, products: DataFrame) -> DataFrame:
    return inventory.where(~F.col("qty").eqNullSafe(F.col("last_synced_qty"))).join(products.select("sku").distinct(), "sku")


def orphans(variations: DataFrame, products: DataFrame) -> DataFrame:
    return variations.join(products.select("variation_key").distinct(), "variation_key", "left_anti")


def status(state: DataFrame) -> DataFrame:
    return state.groupBy("state").agg(F.count("*").alias("n"))


def ack_fold(acks: DataFrame, key: str, order: list[str], ok: Column, attempts: Column | None = None) -> DataFrame:
    """(key, state, attempts) after acks in order: a success syncs, failures count up since the last success and at the cap the row is held.

    A row once held stays so until a later success.
    """
    w = Window.partitionBy(key).orderBy(*order)
    run = acks.withColumn("_ok", ok).withColumn("_g", F.sum(F.col("_ok").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    per = run.groupBy(key, "_g").agg(F.sum((~F.col("_ok")).cast("int")).alias("_fails"))
    last = per.groupBy(key).agg(F.max(F.struct("_g", "_fails")).alias("x"))
    before = F.when(F.col("x._g") == 0, attempts).otherwise(F.lit(0)) if attempts is not None else F.lit(0)
    n = F.col("x._fails") + F.coalesce(before, F.lit(0))
    state = F.when(n >= C.DEAD_LETTER, "gap_held").when(n > 0, "dirty").otherwise("synced")
    return last.select(key, state.alias("state"), n.cast("long").alias("attempts"))


def guarded_product_acks(acks: DataFrame) -> DataFrame:
    """Product acks (ordinal, type, key, variation_key, ok) with `applied`: the variety's last ack before them in the batch was a success.

    A variety's state at a product ack is the latest of its own acks with a smaller ordinal: one sorted window, no self join.
    """
    events = acks.withColumn("_v", F.when(F.col("type") == "variation", F.col("key")).otherwise(F.col("variation_key")))
    w = Window.partitionBy("_v").orderBy("ordinal").rowsBetween(Window.unboundedPreceding, -1)
    seen = F.last(F.when(F.col("type") == "variation", F.col("ok")), ignorenulls=True).over(w)
    return events.withColumn("applied", F.coalesce(seen, F.lit(False))).where("type = 'product'").drop("_v")


def _overlay(state: DataFrame, now: Column, scope: Column | None = None) -> DataFrame:
    """Rows in scope are served again from nothing: ids and bookkeeping go.  Retiring ones keep theirs, which tell what the other side must delete."""
    on = (F.lit(True) if scope is None else F.coalesce(scope, F.lit(False))) & (F.col("state") != "retiring")
    new = {"state": F.lit("pending"), "attempts": F.lit(0)} | {c: F.lit(None) for c in ("remote_id", "last_synced", "error", "abandoned_at", "leased_at")} | {"updated_at": now}
    kinds = dict(state.dtypes)
    return state.select(*(F.when(on, new[c].cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in state.columns))


def with_tombstones(stones: DataFrame, new: DataFrame, reason: str) -> DataFrame:
    """Tombstones with new ones (external_id, kind); one that is there already is served again from nothing."""
    kinds = dict(stones.dtypes)
    fresh = {"external_id": F.col("external_id"), "kind": F.col("kind"), "state": F.lit("pending"), "reason": F.lit(reason), "attempts": F.lit(0)}
    rows = new.select("external_id", "kind").distinct()
    return stones.join(rows.select("external_id"), "external_id", "left_anti").select(*stones.columns).unionByName(rows.select(*(fresh.get(c, F.lit(None)).cast(kinds[c]).alias(c) for c in stones.columns)))


def reset(tables: dict[str, DataFrame], now: Column, hard: bool = False, sources: list[str] | None = None, prune_stale: bool = False) -> dict[str, DataFrame]:
    """The tables that a clean start of the sync changes: variations, products, inventory, removed.

    Soft: everything is served again, without ids and bookkeeping, and all stock counts as not synced.  Hard: products and their stock go, and those that
    the other side knows leave a tombstone.  sources (perhaps none) narrow it to their products and stock, and leave the varieties alone.  prune_stale: without sources,
    varieties that the last full set lacked and that no product has retire first, each with a tombstone.
    """
    v, p, stock, stones = (tables[k] for k in ("variations", "products", "inventory", "removed"))
    out: dict[str, DataFrame] = {}
    if sources is None:
        if prune_stale:
            gone = stale_varieties(v.where("state <> 'retiring'"), p).select("variation_key", F.lit(True).alias("_gone"))
            stones = out["removed"] = with_tombstones(stones, gone.select(F.col("variation_key").alias("external_id"), F.lit("variation").alias("kind")), "stale_not_in_seed")
            v = v.join(gone, "variation_key", "left").withColumn("state", F.when(F.col("_gone"), "retiring").otherwise(F.col("state"))).select(*v.columns)
        out["variations"] = _overlay(v, now)
        mine = F.lit(True)
    else:
        mine = F.col("source").isin(*sources) if sources else F.lit(False)
    own = p.where(mine).select("sku").distinct()
    if hard:
        known = p.where(mine & (F.trim(F.coalesce("remote_id", F.lit(""))) != "")).select(F.col("sku").alias("external_id"), F.lit("product").alias("kind"))
        out["removed"] = with_tombstones(stones, known, "reset_dropped")
        out["products"] = p.where(~F.coalesce(mine, F.lit(False)))
        out["inventory"] = stock.limit(0) if sources is None else stock.join(own, "sku", "left_anti").select(*stock.columns)
    else:
        out["products"] = _overlay(p, now, mine)
        j = stock.join(own.withColumn("_own", F.lit(True)), "sku", "left")
        out["inventory"] = j.withColumn("last_synced_qty", F.when(F.lit(sources is None) | F.coalesce("_own", F.lit(False)), F.lit(None)).otherwise(F.col("last_synced_qty"))).select(*stock.columns)
    return out


def purge(products: DataFrame, inventory: DataFrame, reason: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(tombstones, products, inventory): rows without stock leave and are remembered."""
    gone = products.join(inventory.where("qty = 0").select("sku"), "sku", "left_semi")
    stones = gone.select(F.col("sku").alias("external_id"), F.lit("product").alias("kind"), F.lit(reason).alias("reason"))
    key = gone.select("sku")
    return stones, products.join(key, "sku", "left_anti"), inventory.join(key, "sku", "left_anti")


def delist(inventory: DataFrame, products: DataFrame, source: str) -> DataFrame:
    mine = products.where(F.col("source") == source).select("sku", F.lit(True).alias("_mine")).distinct()
    j = inventory.join(mine, "sku", "left")
    hit = F.col("_mine") & (F.col("qty") != 0)
    return j.withColumn("qty", F.when(hit, 0).otherwise(F.col("qty"))).withColumn("reason", F.when(hit, "delisted").otherwise(F.col("reason"))).drop("_mine")


def requeue(state: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    j = state.join(keys.select(key, F.lit(True).alias("_k")).distinct(), key, "left")
    on = F.col("_k") & (F.col("state") == "gap_held")
    return j.withColumn("state", F.when(on, "dirty").otherwise(F.col("state"))).withColumn("attempts", F.when(on, 0).otherwise(F.col("attempts"))).drop("_k")


def converge(state: DataFrame, key: str, rounds: int = 50, size: int = C.PAGE) -> tuple[DataFrame, int]:
    """Pulls and acknowledges pages until nothing is servable; the rounds it took."""
    now = F.current_timestamp()
    for n in range(rounds):
        ready = state.where(F.col("state").isin("pending", "dirty"))
        if ready.isEmpty():
            return state, n
        _, state = serve(state, ready, key, now, size)
        state = state.withColumn("state", F.when(F.col("state") == "syncing", "synced").otherwise(F.col("state"))).checkpoint()
    raise RuntimeError(f"no fixed point in {rounds} rounds")


def apply_acks(state: DataFrame, acks: DataFrame, key: str, now: Column, parents: DataFrame | None = None) -> DataFrame:
    """The entities after one acknowledgement each: (key, status, remote_id, payload_hash, reason).

    A success counts only for a row that isn't retiring, for the version it echoes, and, where parents are given
    (variation_key), if its parent is synced.  Failures count up; at the cap the row is held.
    """
    a = acks.select(F.col(key).alias("_k"), F.col("status").alias("_status"), F.col("remote_id").alias("_rid"), F.col("payload_hash").alias("_echo"), F.coalesce("reason", F.lit("apply failed")).alias("_reason"))
    j = state.join(a, F.col(key) == F.col("_k"), "left")
    live = F.col("_k").isNotNull() & (F.col("state") != "retiring")
    if parents is not None:
        j = j.join(parents.select(F.col("variation_key").alias("_p")).distinct(), F.col("variation_key") == F.col("_p"), "left")
        ready = F.col("_p").isNotNull()
    else:
        ready = F.lit(True)
    ok = live & (F.col("_status") == "synced") & ready & (F.col("_echo").isNull() | (F.col("_echo") == F.col("payload_hash")))
    failed = live & (F.col("_status") == "failed")
    n = F.coalesce("attempts", F.lit(0)) + 1
    j = j.withColumns({"_ok": F.coalesce(ok, F.lit(False)), "_failed": F.coalesce(failed, F.lit(False)), "_n": n})
    to = F.when(F.col("_ok"), "synced").when(F.col("_failed") & (F.col("_n") >= C.DEAD_LETTER), "gap_held").when(F.col("_failed"), "dirty").otherwise(F.col("state"))
    new = {
        "state": to, "attempts": F.when(F.col("_ok"), 0).when(F.col("_failed"), F.col("_n")).otherwise(F.col("attempts")).cast("int"), "remote_id": F.when(F.col("_ok"), F.col("_rid")).otherwise(F.col("remote_id")),
        "error": F.when(F.col("_failed"), F.substring("_reason", 1, 500)).when(~F.col("_ok"), F.col("error")), "updated_at": F.when(F.col("_ok") | F.col("_failed"), now).otherwise(F.col("updated_at")),
    }
    return j.select(*(new.get(c, F.col(c)).alias(c) for c in state.columns))


def apply_inventory_acks(inventory: DataFrame, acks: DataFrame, products: DataFrame) -> DataFrame:
    """Stock that the other side holds: only of synced products, and only the quantity that the ack (sku, status, quantity) echoes, if it does."""
    a = acks.where("status <> 'failed'").groupBy("sku").agg(F.max("quantity").alias("_echo"), F.lit(True).alias("_in")) if "quantity" in acks.columns else acks.where("status <> 'failed'").select("sku", F.lit(None).cast("int").alias("_echo"), F.lit(True).alias("_in")).distinct()
    held = products.where("state = 'synced'").select("sku", F.lit(True).alias("_held")).distinct()
    j = inventory.join(a, "sku", "left").join(held, "sku", "left")
    hit = F.col("_in") & F.col("_held") & (F.col("_echo").isNull() | (F.col("_echo") == F.col("qty")))
    return j.withColumn("last_synced_qty", F.when(hit, F.col("qty")).otherwise(F.col("last_synced_qty"))).drop("_echo", "_in", "_held")


def removed_acks(tombstones: DataFrame, acks: DataFrame, children: DataFrame) -> DataFrame:
    """Tombstones after acks (external_id, status): done ones go, unless a variety has children again; others count up and die at the cap."""
    a = acks.groupBy("external_id").agg(F.max("status").alias("_status"))
    kids = children.select(F.col("variation_key").alias("external_id"), F.lit(True).alias("_kids")).distinct()
    j = tombstones.join(a, "external_id", "left").join(kids, "external_id", "left")
    gone = (F.col("_status") == "done") & ~((F.col("kind") == "variation") & F.coalesce("_kids", F.lit(False)))
    blocked = F.col("_status").isNotNull() & (F.col("_status") != "done")
    left = j.where(~F.coalesce(gone, F.lit(False))).withColumn("_b", F.coalesce(blocked, F.lit(False)))
    left = left.withColumn("attempts", F.when(F.col("_b"), F.coalesce("attempts", F.lit(0)) + 1).otherwise(F.col("attempts")).cast("int"))
    return left.withColumn("state", F.when(~F.col("_b"), F.col("state")).when(F.col("attempts") >= C.DEAD_LETTER, "dead").otherwise("pending")).drop("_status", "_kids", "_b")


def populate_inventory(inventory: DataFrame, rows: DataFrame, discontinued: DataFrame) -> DataFrame:
    """(sku, qty, last_synced_qty): new quantities, nothing for discontinued ones; what was synced last stays known."""
    new = rows.select("sku", F.col("qty").cast("int").alias("_q"), F.lit(1).alias("_r")).unionByName(discontinued.select("sku", F.lit(0).alias("_q"), F.lit(0).alias("_r")))
    one = new.groupBy("sku").agg(F.max_by("_q", "_r").alias("_q"))
    return inventory.join(one, "sku", "full_outer").select("sku", F.coalesce("_q", "qty").alias("qty"), "last_synced_qty")


def bootstrap(state: DataFrame, seeds: DataFrame, key: str) -> DataFrame:
    """Seeds that the ledger lacks, added as they are; what is there stays."""
    return state.unionByName(seeds.join(state.select(key), key, "left_anti"), allowMissingColumns=True)


def reconcile_to_seed(state: DataFrame, seeds: DataFrame, identity: list[str], protected: DataFrame) -> DataFrame:
    """One row for each identity, a seed's before others; rows whose identity no seed has go, unless protected."""
    marked = state.join(seeds.select("key", F.lit(True).alias("_seed")).distinct(), "key", "left").join(protected.select("key", F.lit(True).alias("_safe")).distinct(), "key", "left")
    w = Window.partitionBy(*identity).orderBy(F.col("_seed").desc_nulls_last(), "key")
    ranked = marked.withColumn("_n", F.row_number().over(w)).join(seeds.select(*identity, F.lit(True).alias("_known")).distinct(), identity, "left")
    keep = F.coalesce("_safe", F.lit(False)) | ((F.col("_n") == 1) & F.coalesce("_known", F.lit(False)))
    return ranked.where(keep).select(*state.columns)


def isolate(page_rows: DataFrame, cells: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(served, held): rows of which a JSON cell (column: type) can't be read are held with the reason, the rest of the page is served."""
    bad = F.array_compact(F.array(*(F.when(F.col(c).isNotNull() & F.from_json(c, kind, {"mode": "PERMISSIVE"}).isNull(), F.lit(c)) for c, kind in cells.items())))
    marked = page_rows.withColumn("_bad", bad)
    held = marked.where(F.size("_bad") > 0).withColumn("state", F.lit("gap_held")).withColumn("error", F.concat(F.lit("unreadable: "), F.array_join("_bad", ",")))
    return marked.where(F.size("_bad") == 0).drop("_bad"), held.drop("_bad")


def bind_env(meta: DataFrame, env: str, fingerprint: str | None) -> DataFrame:
    """The ledger's one (env, fingerprint) row; another environment's is an error."""
    rows = meta.limit(2).collect()
    if rows and (len(rows) > 1 or rows[0]["env"] != env or (fingerprint and rows[0]["fingerprint"] and rows[0]["fingerprint"] != fingerprint)):
        raise RuntimeError(f"the ledger belongs to {rows[0]['env']}, not to {env}")
    return meta if rows else meta.sparkSession.createDataFrame([(env, fingerprint)], "env string, fingerprint string")


def removed_page(tombstones: DataFrame, size: int = C.PAGE) -> DataFrame:
    return page(tombstones.where("state = 'pending'"), ["created_at", "external_id"], size)


def stale_varieties(variations: DataFrame, products: DataFrame) -> DataFrame:
    """Varieties that the last full set lacked and that no product has."""
    return variations.where("in_full = 0").join(products.select("variation_key").distinct(), "variation_key", "left_anti")


def retire(variations: DataFrame, products: DataFrame, inventory: DataFrame, keys: DataFrame, reason: str = "retired") -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(variations, products, inventory, tombstones): retired varieties wait for their ack, their products and stock leave with a tombstone."""
    gone = keys.select("variation_key").distinct()
    out = variations.join(gone.withColumn("_go", F.lit(True)), "variation_key", "left").withColumn("state", F.when(F.col("_go"), "retiring").otherwise(F.col("state"))).drop("_go")
    lost = products.join(gone, "variation_key", "left_semi").select("sku")
    stones = lost.select(F.col("sku").alias("external_id"), F.lit("product").alias("kind")).unionByName(gone.join(variations.select("variation_key"), "variation_key", "left_semi").select(F.col("variation_key").alias("external_id"), F.lit("variation").alias("kind")))
    return out, products.join(lost, "sku", "left_anti"), inventory.join(lost, "sku", "left_anti"), stones.withColumn("reason", F.lit(reason))


def failures(state: DataFrame, key: str, size: int = 200) -> DataFrame:
    """The held rows, the newest first; the limit is the page."""
    return state.where("state = 'gap_held'").orderBy(F.desc("updated_at"), key).limit(size)
