"""Acknowledgements and ingest as streams; the batch operators stay authoritative."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import acks, commits, ledger


def replay(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Appends every micro-batch to the ack log, once; the log is then folded as a whole."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def folded(spark: SparkSession, path: str, key: str, order: list[str], ok: Column) -> DataFrame:
    return ledger.ack_fold(spark.read.parquet(path), key, order, ok)


def windowed_counts(stream: DataFrame, at: str, width: str, late: str, by: list[str]) -> DataFrame:
    """Counts by event-time window; rows later than `late` behind the newest drop out of open windows."""
    return stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *by, "n")


def ingest(stream: DataFrame, stage: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> None:
    """Runs a pure stage over each micro-batch and appends what it gives."""

    def step(batch: DataFrame, number: int) -> None:
        stage(batch).write.mode("overwrite").parquet(f"{path}/batch={number}")

    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def apply_once(spark: SparkSession, root: str, batch: DataFrame, number: int, now: Column) -> None:
    """Commits the ledger's tables after a micro-batch of acknowledgements; a batch that a commit names already changes nothing."""
    while True:
        base, held = commits.head(spark, root)
        if held["note"].get("acks", -1) >= number:
            return
        changed, _ = acks.apply_batch(commits.read(spark, root, base), batch, now)
        try:
            commits.commit(spark, root, base, {t: commits.write_version(df, root, t) for t, df in changed.items()}, held["note"] | {"acks": number})
            return
        except commits.Conflict:
            continue


def apply(stream: DataFrame, root: str, checkpoint: str, now=None) -> None:
    """Applies a stream of acknowledgements (ordinal, type, external_id, status, …) to the ledger's committed tables, a commit for each micro-batch."""

    def step(batch: DataFrame, number: int) -> None:
        apply_once(batch.sparkSession, root, batch, number, F.current_timestamp() if now is None else F.lit(now))

    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
