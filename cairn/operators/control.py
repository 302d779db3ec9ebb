"""Control-plane state: decisions, sources, pending queues.  Small tables, each change a pure function of the last version."""
from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .. import config as C
from ..functions import digest
from ..functions import text as T
from ..streaming.paths import scratch
from .joins import written

#: Fields that a variety decision keeps, by action.
DECISION_FIELDS = {"mint": ("color", "type", "country"), "alias": ("target", "target_type"), "reject": ()}
#: What a leaf can be, the verdicts, and what tells a leaf.
LEAF_ATTRIBUTES, LEAF_ACTIONS = ("color", "finish", "quality"), ("approve", "reject")
LEAF_KEY = ["name_norm", "type_norm", "attribute", "value_norm"]
#: Ranges of a fingerprint at most, and ids of a range from which on there are more.
RANGES, IDS = 32, 200_000


def decide(decisions: DataFrame, changes: DataFrame) -> DataFrame:
    """Keyed upsert of variety decisions (key, action, …): a later one replaces the earlier, fields its action doesn't use are null."""
    fields = [f for fs in DECISION_FIELDS.values() for f in fs]
    clean = changes.withColumns({f: F.when(F.col("action").isin(*[a for a, fs in DECISION_FIELDS.items() if f in fs]), F.col(f)) for f in fields})
    kept = decisions.join(clean.select("key").distinct(), "key", "left_anti")
    return kept.unionByName(clean.select(*decisions.columns))


def learn_rejects(decisions: DataFrame, found: DataFrame) -> DataFrame:
    """Adds rejects only for keys that nobody has decided."""
    new = found.select("key").distinct().join(decisions.select("key"), "key", "left_anti")
    return decisions.unionByName(new.withColumn("action", F.lit("reject")), allowMissingColumns=True)


def replace_pending(pending: DataFrame, kind: str, rows: DataFrame) -> DataFrame:
    """One kind's queue is replaced as a whole; the last row of a ref counts (rows carry `ordinal`)."""
    w = Window.partitionBy("ref").orderBy(F.desc("ordinal"))
    last = rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "ordinal").withColumn("kind", F.lit(kind))
    return pending.where(F.col("kind") != kind).unionByName(last, allowMissingColumns=True)


def pending_with_action(pending: DataFrame, decisions: DataFrame) -> DataFrame:
    return pending.join(decisions.select(F.col("key").alias("ref"), "action"), "ref", "left")


def leaf_changes(rows: DataFrame) -> DataFrame:
    """Leaf rows (name, type, attribute, value, action) with their key columns and `error`: attribute, action or empty, null for a sound row."""
    low = lambda c: F.lower(F.trim(F.coalesce(F.col(c), F.lit(""))))
    key = lambda c: T.match_key(F.coalesce(F.col(c), F.lit("")))
    blank = lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == ""
    out = rows.withColumns({"attribute": low("attribute"), "action": low("action"), "name_norm": key("name"), "type_norm": key("type"), "value_norm": key("value")})
    wrong = F.when(~F.col("attribute").isin(*LEAF_ATTRIBUTES), "attribute").when(~F.col("action").isin(*LEAF_ACTIONS), "action").when(blank("name") | blank("value"), "empty")
    return out.withColumn("error", wrong)


def decide_leaves(decisions: DataFrame, changes: DataFrame, at: str) -> DataFrame:
    """Decisions (LEAF_KEY, value, action, at) with the sound changes; the last change of a key by `at` replaces what stood there."""
    last = leaf_changes(changes).where("error IS NULL").groupBy(*LEAF_KEY).agg(F.max_by(F.struct(F.trim("value").alias("value"), "action", at), F.struct(at, "action", "value")).alias("x"))
    new = last.select(*LEAF_KEY, "x.*")
    return decisions.join(new, LEAF_KEY, "left_anti").unionByName(new)


def undecided_leaves(pending: DataFrame, decisions: DataFrame) -> DataFrame:
    """Suggestions that nobody has approved or rejected; decided ones leave the queue."""
    keyed = leaf_changes(pending.withColumn("action", F.lit("approve"))).drop("action", "error")
    return keyed.join(decisions, LEAF_KEY, "left_anti")


def approve_leaves(decisions: DataFrame, pending: DataFrame, at: str, verdict: str | None = None) -> DataFrame:
    """Approves the suggestions that are still undecided, on request only those of one verdict; a decision is never flipped."""
    open_ = undecided_leaves(pending, decisions).where(F.lit(True) if verdict is None else F.col("verdict") == verdict)
    return decide_leaves(decisions, open_.drop("name_norm", "type_norm", "value_norm").withColumn("action", F.lit("approve")), at)


def revise_leaves(decisions: DataFrame, revisions: DataFrame, at: str) -> DataFrame:
    """Recorded decisions changed by revisions (LEAF_KEY, action, at): approve or reject flips, clear forgets; unknown keys and actions change nothing."""
    sound = revisions.where(F.col("action").isin(*LEAF_ACTIONS, "clear"))
    last = sound.groupBy(*LEAF_KEY).agg(F.max_by(F.struct("action", at), F.struct(at, "action")).alias("_new"))
    joined = decisions.join(last, LEAF_KEY, "left").where(~F.col("_new.action").eqNullSafe("clear"))
    return joined.withColumns({c: F.coalesce(F.col(f"_new.{c}"), F.col(c)) for c in ("action", at)}).select(*decisions.columns)


def leaf_overlay(leaves: DataFrame) -> DataFrame:
    """(name_norm, type_norm, attribute, values) of approved leaves."""
    ok = leaves.where("action = 'approve'")
    return ok.groupBy(T.match_key(F.col("name")).alias("name_norm"), T.match_key(F.col("type")).alias("type_norm"), "attribute").agg(F.array_sort(F.collect_set("value")).alias("values"))


def overlay(backbone: DataFrame, leaves: DataFrame, attribute: str) -> DataFrame:
    """Backbone rows with approved values added at the end, unless their key is there; applying it twice changes nothing."""
    add = leaf_overlay(leaves).where(F.col("attribute") == attribute).select("name_norm", "type_norm", F.col("values").alias("_add"))
    b = backbone.withColumn("name_norm", T.match_key(F.col("name"))).withColumn("type_norm", T.match_key(F.col("type"))).join(add, ["name_norm", "type_norm"], "left")
    have = F.transform(F.col(attribute), lambda x: T.match_key(x))
    fresh = F.filter(F.coalesce("_add", F.array().cast("array<string>")), lambda x: ~F.array_contains(have, T.match_key(x)))
    return b.withColumn(attribute, F.concat(F.col(attribute), fresh)).drop("name_norm", "type_norm", "_add")


def seed_sources(current: DataFrame, seed: DataFrame, removed: DataFrame) -> DataFrame:
    """Adds sources that are missing and were never removed."""
    return current.unionByName(seed.join(current.select("source"), "source", "left_anti").join(removed.select("source"), "source", "left_anti"))


def invalid_sources(sources: DataFrame) -> DataFrame:
    """(source, problem): a source code used twice whatever its case, or no port."""
    twice = Window.partitionBy(F.lower("source_code"))
    out = sources.withColumn("problem", F.when(F.count("*").over(twice) > 1, "source_code_taken").when(F.size("ports") < 1, "no_port"))
    return out.where("problem is not null").select("source", "problem")


def set_lifecycle(sources: DataFrame, source: str, enabled: bool, lifecycle: str) -> DataFrame:
    on = F.col("source") == source
    return sources.withColumn("enabled", F.when(on, F.lit(enabled)).otherwise(F.col("enabled"))).withColumn("lifecycle", F.when(on, F.lit(lifecycle)).otherwise(F.col("lifecycle")))


def removable(products: DataFrame, inventory: DataFrame, source: str) -> bool:
    """A source with stock is live and can't be removed."""
    return products.where(F.col("source") == source).join(inventory.where("qty > 0"), "sku", "left_semi").isEmpty()


def blocked_auto(requested: DataFrame, results: DataFrame) -> DataFrame:
    """Automatic sources whose gate failed or that gave no result."""
    j = requested.where("mode = 'auto'").join(results.select("source", "status"), "source", "left")
    return j.where("status is null or status = 'FAILED'").select("source", F.coalesce("status", F.lit("absent")).alias("status"))


def scrape_allowed(rows: int, expected: int) -> bool:
    return rows >= max(1, expected)


def history(events: DataFrame, source: str = "source", at: str = "at", most: int = C.HISTORY) -> DataFrame:
    w = Window.partitionBy(source).orderBy(F.desc(at))
    return events.withColumn("age", F.row_number().over(w)).where(F.col("age") <= most)


def search_names(rows: DataFrame, part: str, most: int) -> DataFrame:
    """Type-ahead: names that contain the part literally, in order; the limit is the feature."""
    return rows.where(F.contains(F.lower("name"), F.lit(part.lower()))).orderBy(F.lower("name"), "name").limit(most)


def backend_fingerprint(ids: DataFrame, column: str = "id", held: int = 200_000) -> DataFrame:
    """(fingerprint): 16 hexadecimal digits of the SHA-256 of all different ids in their byte order, each with a zero byte after it; null ids don't count.

    The digest takes them in one order, so ranges follow each other; a task reads one range, and hands the digest's state, some hundred bytes, to the next.  `held` ids
    make a range, but as handing on takes longer than digesting few ids, there are no more than 32 ranges until each has 200,000.
    """
    spark = ids.sparkSession
    one = written(ids.select(F.col(column).cast("string").alias("i")).where("i is not null").distinct())
    n = one.count()
    ranges = min(n // held + 1, max(RANGES, n // IDS + 1))
    path = scratch(spark, "ids")
    one.repartitionByRange(ranges, "i").withColumn("range", F.spark_partition_id()).write.partitionBy("range").parquet(path)
    rows, state = spark.read.schema("i string, range int").parquet(path), digest.start()
    for r in range(ranges):

        def go_on(batches, at=state, taken=digest.taken):
            for b in batches:
                at = taken(at, b"".join(x.encode() + b"\0" for x in b.column(0).to_pylist()))
            yield pa.RecordBatch.from_pylist([{"words": list(at[0]), "n": at[1], "rest": at[2]}])

        got = rows.where(F.col("range") == r).select("i").coalesce(1).sortWithinPartitions("i").mapInArrow(go_on, "words array<long>, n long, rest binary").collect()
        state = next(((tuple(x["words"]), x["n"], bytes(x["rest"])) for x in got), state)
    return spark.createDataFrame([(digest.hexed(state)[:16],)], "fingerprint string")


def drifted(ids: DataFrame, pinned: str | None) -> bool:
    """Whether a pinned fingerprint isn't that of the ids; nothing pinned yet is no drift."""
    return bool(pinned) and backend_fingerprint(ids).first()[0] != pinned
