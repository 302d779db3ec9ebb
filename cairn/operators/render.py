"""Files rendered from the ledger, and a digest tree that tells where two sets of rows differ.

Each row falls into one of FAN ** DEPTH leaves by the hash of its key; a leaf holds how many rows it has and two sums of their hashes, an inner node
the sums of what is below.  Trees are made in one aggregation and stored beside what they describe, so a check of two published sets
reads two small trees, descends only where they differ, and reads rows of the leaves that differ alone.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Columns of the rendered files.
VARIETY_COLUMNS = ("Key", "Name", "Image", "Aliases", "Volume per kg (m³/kg)")
STOCK_COLUMNS = ("Variant Sku", "Product Handle", "Variant Inventory Quantity")
FAN, DEPTH = 256, 2


def varieties(variations: DataFrame) -> DataFrame:
    """The full set (key, name, image_url, aliases, volume, in_full) as its file's text columns; aliases joined by bars."""
    cells = ("key", "name", "image_url", F.array_join("aliases", "|"), F.col("volume").cast("string"))
    return variations.where("in_full = 1").select(*(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")).alias(n) for c, n in zip(cells, VARIETY_COLUMNS, strict=True)))


def stock(inventory: DataFrame, products: DataFrame) -> DataFrame:
    """Stock that moved since it was last synced, of products that the ledger has: sku, handle, quantity; less than nothing counts as nothing."""
    moved = inventory.where(~F.col("qty").eqNullSafe(F.col("last_synced_qty"))).join(products.select("sku", "handle"), "sku")
    cells = ("sku", F.coalesce("handle", F.lit("")), F.greatest(F.coalesce("qty", F.lit(0)), F.lit(0)).cast("string"))
    return moved.select(*(F.col(c).alias(n) if isinstance(c, str) else c.alias(n) for c, n in zip(cells, STOCK_COLUMNS, strict=True)))


def leaf(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(FAN**DEPTH)).cast("int")


def tree(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(level, node, n, a, b): every node that has rows; level 0 is the root, level DEPTH the leaves.  Repeated rows count."""
    whole = lambda seed: F.sum(F.xxhash64(*(F.col(c) for c in sorted(rows.columns)), F.lit(seed)).cast("decimal(38,0)"))
    leaves = rows.groupBy(leaf(keys).alias("node")).agg(F.count("*").alias("n"), whole(1).alias("a"), whole(2).alias("b"))
    up = F.explode(F.transform(F.sequence(F.lit(0), F.lit(DEPTH)), lambda d: F.struct(d.alias("level"), F.floor(F.col("node") / F.pow(F.lit(FAN), F.lit(DEPTH) - d)).cast("int").alias("at"))))
    return leaves.select("n", "a", "b", up.alias("x")).groupBy("x.level", F.col("x.at").alias("node")).agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("b").alias("b"))


def differing(one: DataFrame, two: DataFrame) -> list[int]:
    """Leaves in which two trees differ, found from the root down: a level's nodes are compared only below nodes that differ.  At most FAN ** DEPTH numbers."""
    nodes = [0]
    for level in range(DEPTH + 1):
        def at(t: DataFrame) -> DataFrame:
            some = t.where(F.col("level") == level).select("node", F.struct("n", "a", "b").alias("x"))  # noqa: B023
            return some.where(F.floor(F.col("node") / FAN).isin(nodes)) if 0 < level and len(nodes) <= FAN else some  # noqa: B023

        both = at(one).join(at(two).withColumnRenamed("x", "y"), "node", "full_outer").where(~F.col("x").eqNullSafe(F.col("y")))
        nodes = [r["node"] for r in both.select("node").collect()]
        if not nodes:
            return []
    return sorted(nodes)


def differences(one: DataFrame, two: DataFrame, keys: list[str], trees: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """(columns…, side, copies): rows that only one of two sets has, or more often.  trees: stored ones of the sets."""
    a, b = trees or (tree(one, keys), tree(two, keys))
    leaves = one.sparkSession.createDataFrame([(x,) for x in differing(a, b)], "_leaf int")
    inside = lambda df, sign: df.withColumn("_leaf", leaf(keys)).join(F.broadcast(leaves), "_leaf", "left_semi").drop("_leaf").withColumn("_s", F.lit(sign))
    both = inside(one, 1).unionByName(inside(two.select(*one.columns), -1)).groupBy(*one.columns).agg(F.sum("_s").alias("_s")).where("_s <> 0")
    return both.select(*one.columns, F.when(F.col("_s") > 0, "one").otherwise("two").alias("side"), F.abs("_s").alias("copies"))


def verify(checks: dict[str, tuple[DataFrame, DataFrame, list[str]]]) -> dict[str, tuple[int, int]]:
    """Name -> how many rows only the rendered set and only the file has, of those (rendered, file, keys) that differ."""
    out = {}
    for name, (one, two, keys) in checks.items():
        found = {r["side"]: r["n"] for r in differences(one, two, keys).groupBy("side").agg(F.sum("copies").alias("n")).collect()}
        if found:
            out[name] = (found.get("one", 0), found.get("two", 0))
    return out
