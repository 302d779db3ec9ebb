"""Minimax contiguous sharding.

Texts hash to `groups` ordered atomic groups, so equal texts share one.  The
smallest shard capacity for which a greedy pass needs at most the wanted number
of shards is found by binary search over the groups' sizes, and the groups are cut
there.  The driver sees one size for each group, a fixed number of them however
large the corpus.  Slots are counted within ranges of rows and then moved by the
sizes of the ranges before, so a shard that one copied text fills is still
numbered by many tasks.

Law `bytes`: sizes are as equal as groups allow; a group larger than a fair share
fills a shard by itself.  Null texts weigh only the 8 bytes that each row weighs.
Repeated rows each get a slot of their own.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import cut, parts

SHARDS, GROUPS, ROW_BYTES = 24, 1 << 16, 8


def cuts_at(sizes: np.ndarray, capacity: int) -> list[int]:
    """First group of each shard, filled greedily up to the capacity."""
    sums = np.concatenate(([0], np.cumsum(sizes)))
    out, at = [], 0
    while at < len(sizes):
        out.append(at)
        at = max(at + 1, int(np.searchsorted(sums, sums[at] + capacity, side="right")) - 1)
    return out


def minimax_cuts(sizes: np.ndarray, shards: int) -> list[int]:
    """First groups of at most `shards` contiguous shards whose largest is as small as can be."""
    sizes = np.asarray(sizes, dtype=np.int64)
    low, high = int(max(sizes.max(initial=0), -(-sizes.sum() // shards))), int(sizes.sum())
    while low < high:
        middle = (low + high) // 2
        if len(cuts_at(sizes, middle)) <= shards:
            high = middle
        else:
            low = middle + 1
    return cuts_at(sizes, low)


def shard(docs: DataFrame, shards: int = SHARDS, groups: int = GROUPS, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every row."""
    spark = docs.sparkSession
    raw = F.col(text).cast("string").cast("binary")
    full = F.coalesce(raw, F.lit("").cast("binary"))
    slim = docs.select(
        F.col(id_column).alias("doc_id"),
        (F.octet_length(full) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(full).alias("text_crc32"),
        F.pmod(F.xxhash64(full), F.lit(groups)).cast("int").alias("g"),
        F.xxhash64(F.col(id_column), F.lit("slot")).alias("x"),
    )
    # ranges by group, then by a hash of the id: one large group spans several
    laid = cut(slim.repartitionByRange(4 * parts(spark), "g", "x", "doc_id").withColumn("range", F.spark_partition_id()))
    known = {r["g"]: r["n"] for r in laid.groupBy("g").agg(F.sum("size").alias("n")).collect()}  # at most `groups` rows
    order = sorted(known)
    starts = minimax_cuts(np.array([known[g] for g in order], dtype=np.int64), shards) if order else []
    firsts = [order[i] for i in starts]
    cell = F.array_size(F.filter(F.array(*map(F.lit, firsts)), lambda f: f <= F.col("g"))) - 1 if firsts else F.lit(0)
    placed = laid.withColumn("shard", cell.cast("int"))
    counts = placed.groupBy("shard", "range").agg(F.count("*").alias("n")).orderBy("shard", "range").collect()  # about a row for each range
    before, rows, last = 0, [], None
    for r in counts:
        before = 0 if r["shard"] != last else before
        last = r["shard"]
        rows.append((r["shard"], r["range"], before))
        before += r["n"]
    moved = F.broadcast(spark.createDataFrame(rows, "shard int, range int, before long"))
    within = F.row_number().over(Window.partitionBy("shard", "range").orderBy("g", "x", "doc_id", "text_crc32"))
    return placed.join(moved, ["shard", "range"]).select("doc_id", "size", "text_crc32", "shard", (F.col("before") + within - 1).cast("long").alias("slot"))


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
