"""The candidates' tier keys as a stored table: bucketed by tier and key, so that the ladder joins it without moving it.

Each version is a table of its own, named after the commit that publishes it; a refresh computes the keys of the candidates that
changed and takes all others' from the version before.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import resolve

BUCKETS = 64


def save(rows: DataFrame, table: str, by: tuple[str, ...] = (), buckets: int = BUCKETS) -> None:
    """Stores tier rows; a table of that name must not be there."""
    keys = [*by, "rank", "key"]
    rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").mode("errorifexists").saveAsTable(table)


def build(candidates: DataFrame, table: str, colours: list[str] = (), by: tuple[str, ...] = (), buckets: int = BUCKETS) -> None:
    """Stores the tier rows of all candidates (by…, cid, name, aliases, type, and optionally colors); a cid belongs to one value of `by`."""
    save(_rows(candidates, colours, by), table, by, buckets)


def _rows(candidates: DataFrame, colours: list[str], by: tuple[str, ...]) -> DataFrame:
    rows = resolve.surfaces(candidates, colours)
    if by:
        rows = rows.join(candidates.select("cid", *by).distinct(), "cid")
    return resolve.tier_rows(rows, by)


def load(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def refresh(spark: SparkSession, before: str, table: str, changed: DataFrame, gone: DataFrame, colours: list[str] = (), by: tuple[str, ...] = (), buckets: int = BUCKETS) -> None:
    """Stores the next version: the rows before without the candidates that changed or are gone (cid), and the changed ones' new rows."""
    drop = changed.select("cid").unionByName(gone.select("cid")).distinct()
    save(load(spark, before).join(drop, "cid", "left_anti").select(*by, "cid", "ckey", "block", "colors", "cwords", "rank", "key").unionByName(_rows(changed, colours, by)), table, by, buckets)


def changes(old: DataFrame, new: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """(changed or new candidates, cids that are gone) between two versions of the candidates."""
    mark = lambda df: df.withColumn("_h", F.xxhash64(*columns))
    seen = mark(old).select("cid", "_h")
    return mark(new).join(seen, ["cid", "_h"], "left_anti").drop("_h"), old.select("cid").join(new.select("cid"), "cid", "left_anti")
