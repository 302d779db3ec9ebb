"""The ledger's rows as keyed streaming state: pages lease them, acknowledgements settle them, and a timer gives an expired lease back.

A key holds one row of fixed size in the state store, however many events it gets.  Event time decides: a lease ends LEASE_SECONDS after it was given, found
either when the next page asks for the row or by a timer that the watermark fires.  Events behind the watermark are dropped by Spark.
"""
from __future__ import annotations

import sys
from collections.abc import Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.window import Window

from .. import config as C

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = "state string, attempts int, remote_id string, leased_ms long, seq long"
OUT = "key string, state string, attempts int, remote_id string, seq long"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def step(held: tuple, what: str, at_ms: int, ok: bool | None, remote_id: str | None, lease_ms: int, cap: int) -> tuple:
    """(state, attempts, remote_id, leased_ms) after one event: serve, ack, or lapse, the end of a lease."""
    state, attempts, rid, leased = held
    if what == "ack":
        if ok:
            return "synced", 0, remote_id, None
        attempts += 1
        return "gap_held" if attempts >= cap else "dirty", attempts, rid, None
    if state == "syncing" and at_ms - leased > lease_ms:
        state, leased = "dirty", None
    if what == "serve" and state in ("pending", "dirty"):
        return "syncing", attempts, rid, at_ms
    return state, attempts, rid, leased


class LedgerRows(StatefulProcessor):
    """One ledger row a key; emits the row whenever events or a timer changed it."""

    def __init__(self, lease_ms: int = C.LEASE_SECONDS * 1000, cap: int = C.DEAD_LETTER):
        self.lease_ms, self.cap = lease_ms, cap

    def init(self, handle) -> None:
        self.handle = handle
        self.row = handle.getValueState("row", STATE)

    def _held(self) -> tuple[tuple, int]:
        found = self.row.get() if self.row.exists() else None
        return (("pending", 0, None, None), 0) if found is None else ((found[0], found[1], found[2], found[3]), found[4])

    def _keep(self, key, old: tuple, new: tuple, seq: int) -> Iterator[Row]:
        if new[3] != old[3]:
            if old[3] is not None:
                self.handle.deleteTimer(old[3] + self.lease_ms + 1)
            if new[3] is not None:
                self.handle.registerTimer(new[3] + self.lease_ms + 1)
        self.row.update((*new, seq + 1))
        yield Row(key=key[0], state=new[0], attempts=new[1], remote_id=new[2], seq=seq + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old, seq = self._held()
        new = old
        for r in sorted(rows, key=lambda r: r.ordinal):
            new = step(new, r.what, int(r.at.timestamp() * 1000), r.ok, r.remote_id, self.lease_ms, self.cap)
        yield from self._keep(key, old, new, seq)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        old, seq = self._held()
        new = step(old, "lapse", expiredTimerInfo.getExpiryTimeInMs(), None, None, self.lease_ms, self.cap)
        if new != old:
            self.row.update((*new, seq + 1))
            yield Row(key=key[0], state=new[0], attempts=new[1], remote_id=new[2], seq=seq + 1)

    def close(self) -> None:
        pass


def ledger_rows(events: DataFrame, late: str) -> DataFrame:
    """The stream of changed rows (key, state, attempts, remote_id, seq) of events (key, ordinal, what, at, ok, remote_id); a key's last seq counts."""
    return events.withWatermark("at", late).groupBy("key").transformWithState(statefulProcessor=LedgerRows(), outputStructType=OUT, outputMode="Update", timeMode="EventTime")


def run(spark: SparkSession, changed: DataFrame, path: str, checkpoint: str) -> None:
    """Writes every micro-batch's changes under its number, so that a batch that is run again replaces itself."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)
    try:
        changed.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(STORE, before)


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The rows as the last change left them."""
    return spark.read.parquet(path).groupBy("key").agg(F.max_by(F.struct("state", "attempts", "remote_id"), "seq").alias("x")).select("key", "x.*")


def at_once(events: DataFrame, until) -> DataFrame:
    """What `ledger_rows` leaves, over a finished table of events in the order of their ordinals, with the watermark at `until` at the end.

    The last acknowledgement of a key settles its row; of the pages after it only those count that find the row free, which a fold over
    their times tells: a key's pages after its last acknowledgement are one list of two numbers each.
    """
    w = Window.partitionBy("key").orderBy("ordinal")
    g = F.sum(F.when((F.col("what") == "ack") & F.col("ok"), 1).otherwise(0)).over(w)
    last = F.max(F.when(F.col("what") == "ack", F.col("ordinal"))).over(Window.partitionBy("key"))
    m = events.withColumns({"_g": g, "_last": last}).withColumn("_max", F.max("_g").over(Window.partitionBy("key")))
    ms = F.unix_millis("at")
    per = m.groupBy("key").agg(
        F.count(F.when((F.col("what") == "ack") & (F.col("_g") == F.col("_max")) & ~F.col("ok"), 1)).cast("int").alias("attempts"), F.max_by("remote_id", F.when((F.col("what") == "ack") & F.col("ok"), F.col("ordinal"))).alias("remote_id"),
        F.array_sort(F.collect_list(F.when((F.col("what") == "serve") & (F.col("_last").isNull() | (F.col("ordinal") > F.col("_last"))), F.struct("ordinal", ms.alias("ms"))))).alias("pages"), F.max("_max").alias("_max"),
    )
    lease = C.LEASE_SECONDS * 1000
    none = F.lit(None).cast("long")
    leased = F.aggregate("pages", none, lambda a, p: F.when(a.isNull() | (p["ms"] - a > lease), p["ms"]).otherwise(a))
    base = F.when(F.col("attempts") >= C.DEAD_LETTER, "gap_held").when(F.col("attempts") > 0, "dirty").when(F.col("_max") > 0, "synced").otherwise("pending")
    out = per.withColumns({"_base": base, "_at": leased})
    free = F.col("_base").isin("pending", "dirty") & F.col("_at").isNotNull()
    state = F.when(~free, F.col("_base")).when(F.col("_at") + lease < F.unix_millis(until), "dirty").otherwise("syncing")
    return out.select("key", state.alias("state"), "attempts", "remote_id")
