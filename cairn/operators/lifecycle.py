"""Lifecycle of varieties and sources: views of decisions, attribute ids, undoing a removal, the seed's checks, certification, and the sync requests."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import names as N
from ..functions import text as T
from . import acks, catalog, contracts, curation, ledger

#: Run modes, the tables of sync requests with their keys, and the state in which each is a dead letter.
MODES = ("review", "auto")
SYNC_KEYS = {"variations": "variation_key", "products": "sku", "removed": "external_id"}
DEAD_STATES = {"variations": "gap_held", "products": "gap_held", "removed": "dead"}


def _blank_null(c: str) -> Column:
    return F.when(F.trim(c) != "", F.col(c))


# ---- decisions and attribute ids ------------------------------------------------------------------------------------


def decision_views(decisions: DataFrame) -> DataFrame:
    """(key, confirm, alias_of, alias_type, seed_color, seed_type, seed_country) of variety decisions as curation reads them.

    confirm is yes for mint, no for reject and null for alias; what an action doesn't use, and empty texts, are null.
    """
    on = lambda action, c: F.when(F.col("action") == action, _blank_null(c))
    return decisions.select(
        "key", F.when(F.col("action") == "mint", "yes").when(F.col("action") == "reject", "no").alias("confirm"), on("alias", "target").alias("alias_of"), on("alias", "target_type").alias("alias_type"),
        on("mint", "color").alias("seed_color"), on("mint", "type").alias("seed_type"), on("mint", "country").alias("seed_country"),
    )


def country_rules(decisions: DataFrame) -> DataFrame:
    """(name_norm, type_norm, country) of minted varieties; one without a type gives no rule, as an origin belongs to a name and a type."""
    rules = decision_views(decisions).where("seed_country is not null and seed_type is not null")
    return rules.select(T.match_key(F.col("key")).alias("name_norm"), T.match_key(F.col("seed_type")).alias("type_norm"), F.col("seed_country").alias("country"))


def set_attribute_ids(ids: DataFrame, changes: DataFrame, at: str) -> DataFrame:
    """ids (kind, value_norm, value, id) after changes (kind, value, id, at): the last of a kind and value counts, with its own spelling; incomplete ones change nothing."""
    tidy = changes.select(F.lower(F.trim("kind")).alias("kind"), T.match_key(F.col("value")).alias("value_norm"), F.trim("value").alias("value"), F.trim("id").alias("id"), at)
    sound = tidy.where("kind <> '' and value <> '' and id <> ''")
    last = sound.groupBy("kind", "value_norm").agg(F.max_by(F.struct("value", "id"), F.struct(at, "value", "id")).alias("x")).select("kind", "value_norm", "x.value", "x.id")
    return ids.join(last, ["kind", "value_norm"], "left_anti").select("kind", "value_norm", "value", "id").unionByName(last)


def adopt_attribute_ids(vocabulary: DataFrame, ids: DataFrame) -> DataFrame:
    """vocabulary (category, value, id) with the ids that it lacks by category and key of the value; what it has stays."""
    have = vocabulary.select(F.lower(F.trim("category")).alias("kind"), T.match_key(F.col("value")).alias("value_norm")).distinct()
    new = ids.join(have, ["kind", "value_norm"], "left_anti")
    return vocabulary.select("category", "value", "id").unionByName(new.select(F.col("kind").alias("category"), "value", "id"))


# ---- removal undone, images served again ----------------------------------------------------------------------------


def in_flight(state: DataFrame, now: Column) -> bool:
    """Whether a page is out: destructive steps wait for it, but not for a lease past its time."""
    return not ledger.reap(state, now).where("state = 'syncing'").isEmpty()


def restore(variations: DataFrame, tombstones: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(variations, tombstones): retiring varieties among the keys are served again, dirty if the other side knows them, and their tombstones go.

    The caller takes the keys out of the retired list (a retirement undone) or adds them to the protected one (not a duplicate).
    """
    back = keys.select("variation_key").distinct()
    j = variations.join(back.withColumn("_back", F.lit(True)), "variation_key", "left")
    to = F.when(_blank_null("remote_id").isNotNull(), "dirty").otherwise("pending")
    served = j.withColumn("state", F.when(F.col("_back") & (F.col("state") == "retiring"), to).otherwise(F.col("state"))).select(*variations.columns)
    gone = back.select(F.col("variation_key").alias("external_id"), F.lit("variation").alias("kind"))
    return served, tombstones.join(gone, ["external_id", "kind"], "left_anti").select(*tombstones.columns)


def blocked_retirements(variations: DataFrame, products: DataFrame, inventory: DataFrame, keys: DataFrame) -> DataFrame:
    """(variation_key, problem): asked-for keys that nobody knows, or that still have products in stock."""
    live = products.join(inventory.where("qty > 0").select("sku"), "sku", "left_semi").select("variation_key", F.lit(True).alias("_live")).distinct()
    known = variations.select("variation_key", F.lit(True).alias("_known")).distinct()
    j = keys.select("variation_key").distinct().join(known, "variation_key", "left").join(live, "variation_key", "left")
    return j.withColumn("problem", F.when(F.col("_known").isNull(), "unknown").when(F.col("_live"), "live_products")).where("problem is not null").select("variation_key", "problem")


def abandon(state: DataFrame, keys: DataFrame, key: str, dead: str, now: Column) -> DataFrame:
    """Dead letters among the keys are marked for good (abandoned_at); rows in another state and those marked before stay as they are."""
    j = state.join(keys.select(key, F.lit(True).alias("_k")).distinct(), key, "left")
    hit = F.col("_k") & (F.col("state") == dead) & F.col("abandoned_at").isNull()
    return j.withColumn("abandoned_at", F.when(hit, now).otherwise(F.col("abandoned_at"))).select(*state.columns)


def reserve_stranded(variations: DataFrame, export: DataFrame) -> DataFrame:
    """Synced varieties that have an image here while the export (key, image) shows none are dirty again."""
    bare = export.where(_blank_null("key").isNotNull() & _blank_null("image").isNull()).select(F.trim("key").alias("variation_key"), F.lit(True).alias("_bare")).distinct()
    hit = F.col("_bare") & (F.col("state") == "synced") & _blank_null("image_url").isNotNull() & F.col("image_sha256").isNotNull()
    return variations.join(bare, "variation_key", "left").withColumn("state", F.when(hit, "dirty").otherwise(F.col("state"))).select(*variations.columns)


def product_backed(export: DataFrame, products: DataFrame) -> DataFrame:
    """Keys of exported varieties (id, key) that a product's variation_id names."""
    ids = products.select(F.trim("variation_id").alias("_id")).where("_id <> ''").distinct()
    named = export.where(_blank_null("id").isNotNull() & _blank_null("key").isNotNull()).select(F.trim("id").alias("_id"), F.trim("key").alias("key"))
    return named.join(ids, "_id", "left_semi").select("key").distinct()


# ---- the full set of varieties, the seed, certification -------------------------------------------------------------


def variants_full(base: DataFrame, live: DataFrame, update: DataFrame, retired: DataFrame, categories: DataFrame, stored: DataFrame | None, backed: DataFrame, image_base: str) -> DataFrame:
    """(key, category, type, name, aliases, image): the complete catalog.  base, live, update (key, category, type, name, aliases, image).

    An update wins over the base, and that over the live export.  Every category gets every variety (type and name) that another
    has, with a key of its own; retired keys and names that are codes go; grades of one name fold together; brackets in a name
    become aliases (sorted); one key stays for each category, type and name, the smallest.  Where nothing is known of the store,
    an image is linked if the export or a product has it.
    """
    columns = ["key", "category", "type", "name", "aliases", "image"]
    rows = catalog.union_by_precedence([live.select(*columns), base.select(*columns), update.select(*columns)], ["key"])
    rows = rows.withColumns({"tn": T.match_key(F.col("type")), "nn": T.match_key(F.col("name"))})
    # One record stands for a variety in the categories that lack it: that of the smallest key.
    model = rows.groupBy("tn", "nn").agg(F.min_by(F.struct("type", "name", "aliases"), "key").alias("m"))
    lacking = catalog.union_fill(rows, categories, "category", ["tn", "nn"]).join(model, ["tn", "nn"])
    filled = lacking.select(F.concat_ws("_", "category", T.slugify(F.col("m.type"), "_"), T.slugify(F.col("m.name"), "_")).alias("key"), "category", "m.type", "m.name", "m.aliases", F.lit("").alias("image"))
    every = rows.select(*columns).unionByName(filled).join(retired.select("key").distinct(), "key", "left_anti").where(~N.looks_like_artifact(F.col("name")))
    none = F.array().cast("array<string>")
    cleaned = every.withColumn("_clean", N.clean_variety_name(F.col("name")))
    folded = cleaned.withColumn("_said", F.concat(F.when(F.col("_clean") != F.col("name"), F.array("name")).otherwise(none), F.coalesce("aliases", none), T.bracket_aliases(F.col("name"))))
    shown = folded.withColumn("_name", T.title_case(T.without_brackets(F.col("_clean"))))
    identity = ["category", T.match_key(F.col("type")).alias("tn"), T.match_key(F.col("_name")).alias("nn")]
    one = shown.groupBy(*identity).agg(F.min_by(F.struct("key", "type", "_name"), "key").alias("x"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("_said")))).alias("said"), F.max(F.coalesce(F.trim("image") != "", F.lit(False))).alias("has_export_image"))
    out = one.select("x.key", "category", "x.type", F.col("x._name").alias("name"), F.array_sort(N.alias_list(F.col("x._name"), F.col("said"))).alias("aliases"), "has_export_image")
    out = out.join(backed.select("key", F.lit(True).alias("_b")).distinct(), "key", "left").withColumn("backed", F.coalesce("_b", F.lit(False)))
    return curation.image_links(out, stored, image_base).select(*columns)


def seed_report(base: DataFrame, full: DataFrame, types: list[str]) -> DataFrame:
    """(check, violations) of a seed (key, category, type, name): rows that rebuilding it loses or adds, varieties under several keys,

    unknown types, categories that lack varieties, names that contradict their type.  No violation at all makes it a fixed point.
    """
    word = N.explicit_type_word(F.col("name"), types)
    named = base.withColumns({"tn": T.match_key(F.col("type")), "nn": T.match_key(F.col("name")), "variety": F.concat_ws("\t", T.match_key(F.col("type")), T.match_key(F.col("name")))})
    mark = lambda f, n: f.select("key", "category", "type", "name").withColumn("n", F.lit(n))
    moved = mark(base, -1).unionByName(mark(full, 1)).groupBy("key", "category", "type", "name").agg(F.sum("n").alias("n"))
    known = [t.lower() for t in types]
    parts = {
        "lost_rows": moved.agg(F.coalesce(F.sum(F.when(F.col("n") < 0, -F.col("n"))), F.lit(0)).alias("v")), "added_rows": moved.agg(F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("n"))), F.lit(0)).alias("v")),
        "duplicate_varieties": catalog.duplicate_identities(named, ["category", "tn", "nn"], "key").agg(F.count("*").alias("v")),
        "unknown_types": named.agg(F.count_if((F.col("tn") != "") & ~F.col("tn").isin(*known)).alias("v")),
        "non_uniform_categories": contracts.non_uniform_categories(named, "category", "variety").agg(F.count("*").alias("v")),
        "mistyped_variants": named.agg(F.count_if(F.coalesce(contracts.mistyped(word, F.col("type")), F.lit(False))).alias("v")),
    }
    return reduce(DataFrame.unionByName, (f.select(F.lit(k).alias("check"), F.col("v").cast("long").alias("violations")) for k, f in parts.items()))


def certify(source: str, code: str, mode: str, adapter, sample: DataFrame | None, expected: DataFrame | None, columns: dict[str, str], vocabulary: DataFrame, contract) -> list[tuple[str, bool, str]]:
    """(check, ok, detail) of a source: its configuration, adapter, golden rows, attribute columns against the vocabularies, contract.

    The golden rows only show that the adapter is stable; the vocabularies show a column taken for another.
    """
    out = [("config", bool(code) and mode in MODES, f"code {code!r}, mode {mode!r}"), ("adapter", adapter is not None, source if adapter else "missing")]
    if adapter is None or sample is None or expected is None:
        out.append(("golden", False, "no adapter or no sample"))
    else:
        got = adapter.adapt(sample)
        shared = [c for c in expected.columns if c in got.columns]
        changes = catalog.delta(got.select(*shared), expected.select(*shared)).groupBy("change").count().collect()
        lacking = sorted(set(expected.columns) - set(shared))
        out.append(("golden", not changes and not lacking, ", ".join([f"{r['count']} {r['change']}" for r in changes] + [f"no {c}" for c in lacking]) or "equal"))
        swaps = catalog.likely_swaps(got, columns, vocabulary).collect()  # one row a column at most
        out.append(("vocabulary", not swaps, "; ".join(f"{r['column']}: {r['other']}, not {r['own']}" for r in swaps)))
    return [*out, ("contract", contract is not None, "defined" if contract is not None else "missing")]


def latest_diagnostics(runs: DataFrame, admission: DataFrame) -> DataFrame:
    """Each source's newest run that left a summary (source, run_id, status, row_count, row_baseline), with its admission state."""
    last = runs.where("status is not null").groupBy("source").agg(F.max_by(F.struct("run_id", "status", "row_count", "row_baseline"), "run_id").alias("x"))
    return last.select("source", "x.*").join(admission.select("source", "admission"), "source", "left")


# ---- sync requests --------------------------------------------------------------------------------------------------


def _ack_rows(spark, body: list) -> DataFrame:
    """A request's list of acknowledgements as rows, numbered in their order; what isn't an object is malformed."""
    columns = {"type": str, "external_id": str, "status": str, "remote_id": str, "payload_hash": str, "quantity": int, "reason": str}
    cell = lambda x, c, kind: x[c] if isinstance(x, dict) and isinstance(x.get(c), kind) else None
    rows = [(n, *(cell(x, c, kind) for c, kind in columns.items())) for n, x in enumerate(body)]
    return spark.createDataFrame(rows, "ordinal long, " + ", ".join(f"{c} {'long' if kind is int else 'string'}" for c, kind in columns.items()))


def sync_request(tables: dict[str, DataFrame], method: str, resource: str, limit: str = "", body=None, now: Column | None = None) -> tuple[int, DataFrame | dict, dict[str, DataFrame]]:
    """(code, answer, changed tables) of one request to the ledger's tables: variations, products, inventory, removed.  Pure: the caller writes the changes.

    body is a frame of acks (ordinal, type, external_id, and the columns of `acks.apply_batch`) or a list of them in their order, the type to requeue
    (none: both), or (type, external_id) to abandon.  An ack answers how many were applied, missed and skipped.
    """
    now = F.current_timestamp() if now is None else now
    size = int(limit) if limit.isdigit() and 0 < int(limit) <= C.PAGE_MOST else C.PAGE
    both = ("variations", "products")
    if method == "GET" and resource == "status":
        return 200, reduce(DataFrame.unionByName, (ledger.status(tables[k]).withColumn("type", F.lit(k)) for k in both)), {}
    if method == "GET" and resource == "failures":
        return 200, reduce(DataFrame.unionByName, (ledger.failures(tables[k], SYNC_KEYS[k]).select(F.lit(k).alias("type"), F.col(SYNC_KEYS[k]).alias("external_id"), "error", "abandoned_at") for k in both)), {}
    if method == "GET" and resource in both:
        state = ledger.reap(tables[resource], now)
        ready = ledger.servable_products(state, tables["variations"]) if resource == "products" else state.where(F.col("state").isin("pending", "dirty"))
        page, leased = ledger.serve(state, ready, SYNC_KEYS[resource], now, size)
        return 200, page, {resource: leased}
    if method == "GET" and resource == "inventory":
        return 200, ledger.page(ledger.inventory_deltas(tables["inventory"], tables["products"].where("state = 'synced'")), ["sku"], size), {}
    if method == "GET" and resource == "removed":
        return 200, ledger.removed_page(tables["removed"], size), {}
    if method == "POST" and resource == "ack":
        if not isinstance(body, (DataFrame, list)):
            return 400, {"error": "acks are rows or a list"}, {}
        changed, outcome = acks.apply_batch(tables, body if isinstance(body, DataFrame) else _ack_rows(tables["variations"].sparkSession, body), now)
        return 200, acks.counts(outcome), changed
    if method == "POST" and resource == "requeue":
        kinds = both if body is None else (body,)
        if not set(kinds) <= set(both):
            return 400, {"error": "type is variations or products"}, {}
        held = {k: tables[k].where("state = 'gap_held' and abandoned_at is null").select(SYNC_KEYS[k]) for k in kinds}
        return 200, {}, {k: ledger.requeue(tables[k], held[k], SYNC_KEYS[k]) for k in kinds}
    if method == "POST" and resource == "abandon":
        kind, key = body if isinstance(body, tuple) and len(body) == 2 else (None, None)
        if kind not in SYNC_KEYS or not key:
            return 400, {"error": "type and external_id are needed"}, {}
        rows, name = tables[kind], SYNC_KEYS[kind]
        found = rows.where(F.col(name) == key).select("state", "abandoned_at").limit(1).collect()
        if not found:
            return 404, {"error": f"unknown {kind} {key!r}"}, {}
        if found[0]["abandoned_at"] is None and found[0]["state"] != DEAD_STATES[kind]:
            return 409, {"error": f"{key!r} is {found[0]['state']}"}, {}
        return 200, {}, {kind: abandon(rows, rows.where(F.col(name) == key), name, DEAD_STATES[kind], now)}
    return 404, {"error": f"no {method} {resource}"}, {}
