"""Joins that hold for keys with many rows, and rows written once for several readers."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..streaming.paths import scratch


def dealt_join(rows: DataFrame, small: DataFrame, key: str | list[str], how: str = "inner") -> DataFrame:
    """A join with a side that has a key once: both sides are dealt by key and hash, so that Spark can split a key that many rows have."""
    keys = [key] if isinstance(key, str) else list(key)
    mark = lambda df: df.withColumn("_deal", F.xxhash64(*keys))
    return mark(rows).join(mark(small), [*keys, "_deal"], how).drop("_deal")


def written(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read from there, so that what builds on them doesn't compute them again, and knows their size."""
    path = scratch(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def attach(rows: DataFrame, asked: dict[str, Column], known: DataFrame) -> DataFrame:
    """Adds `_{category}` for each asked category: what is known (category, _key, x) of its key, null for none.

    Only distinct combinations of the keys are looked up; they are written, and the rows meet them in one join, a broadcast where they are few.
    """
    keys = [f"_k_{f}" for f in asked]
    named = rows.withColumns({f"_k_{f}": F.coalesce(c, F.lit("")) for f, c in asked.items()})
    each = named.select(*keys).distinct().select(*keys, F.explode(F.array(*(F.struct(F.lit(f).alias("category"), F.col(f"_k_{f}").alias("_key")) for f in asked))).alias("_e")).select(*keys, "_e.*")
    found = each.join(known, ["category", "_key"], "left").groupBy(*keys).agg(*(F.max(F.when(F.col("category") == f, F.col("x"))).alias(f"_{f}") for f in asked))
    return dealt_join(named, written(found), keys).drop(*keys)
