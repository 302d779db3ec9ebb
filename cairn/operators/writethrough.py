"""What a run found, recorded in the ledger's tables by one commit; a failure is told and never raised, as the run's files are whole without it."""
from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits, ledger

log = logging.getLogger(__name__)
#: Columns of the recorded tables.
LEDGER = "string, payload_hash string, state string, created_at timestamp, updated_at timestamp"
TABLES = {"variations": f"variation_key {LEDGER}", "products": f"sku {LEDGER}", "inventory": "sku string, qty int, last_synced_qty int"}


def opened(spark: SparkSession, tables: dict[str, DataFrame], seeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The tables, empty ones for those that are missing; while there is no variety, seeds (table: rows) come in as they are."""
    out = {t: tables[t] if t in tables else spark.createDataFrame([], schema) for t, schema in TABLES.items()}
    if out["variations"].isEmpty():
        out |= {t: ledger.bootstrap(out[t], rows, out[t].columns[0]) for t, rows in seeds.items()}
    return out


def _recorded(spark: SparkSession, root: str, seeds: dict[str, DataFrame], change: Callable, enabled: bool, what: str) -> bool:
    if not enabled:
        return True

    def new(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        at = opened(spark, tables, seeds)
        return at | change(at)

    try:
        commits.transact(spark, root, new, {"recorded": what})
        return True
    except Exception:
        log.exception("%s did not reach the ledger", what)
        return False


def record_source(spark: SparkSession, root: str, emitted: DataFrame, discontinued: DataFrame, now: Column, seeds: dict[str, DataFrame] | None = None, enabled: bool = True) -> bool:
    """Records a source's emitted rows (sku, payload_hash, qty) and its discontinued ones (sku); False if that failed.

    Products are new, changed or as they were; stock is what all emitted rows say, and nothing for discontinued ones, in one commit: a reader
    sees both or neither.  The last of a sku's rows by payload_hash and quantity counts; rows without one are left out.
    """

    def change(at: dict[str, DataFrame]) -> dict[str, DataFrame]:
        one = emitted.where("sku is not null").groupBy("sku").agg(F.max(F.struct("payload_hash", "qty")).alias("x")).select("sku", "x.*")
        return {"products": ledger.upsert(at["products"], one, "sku", now), "inventory": ledger.populate_inventory(at["inventory"], one, discontinued.where("sku is not null"))}

    return _recorded(spark, root, seeds or {}, change, enabled, "source")


def record_catalog(spark: SparkSession, root: str, full: DataFrame | None, now: Column, seeds: dict[str, DataFrame] | None = None, enabled: bool = True) -> bool:
    """Records the catalog's full set of varieties (variation_key, payload_hash); no set yet is nothing to do, False tells a failure."""
    if full is None:
        return True
    change = lambda at: {"variations": ledger.upsert(at["variations"], full.where("variation_key is not null").groupBy("variation_key").agg(F.max("payload_hash").alias("payload_hash")), "variation_key", now)}
    return _recorded(spark, root, seeds or {}, change, enabled, "catalog")


def rebuild_base(spark: SparkSession, root: str, leases: DataFrame, now: Column, table: str = "base", pristine: str = "pristine") -> tuple[int, str]:
    """(code, what): the base table is again as the named snapshot has it, by one fenced commit; other tables stay.

    409 while a page is out (leases: state, leased_at), another destructive step holds the slot or wrote first, or there is no snapshot with that table.
    What is derived from the base is the caller's to derive again.
    """
    from .lifecycle import in_flight

    try:
        with commits.exclusive(spark, root, "rebuild_base") as commit:
            if in_flight(leases, now):
                return 409, "a page is out"
            kept = commits.kept(spark, root, pristine)
            if table not in kept:
                return 409, "nothing to rebuild from"
            commit(commits.head(spark, root)[0], {table: kept[table]})
            return 200, "rebuilt"
    except (commits.Busy, commits.Conflict) as e:
        return 409, str(e)
