"""The resumable digest, write-through, base rebuild, categories and keys: edges that the queries' tables don't have."""
import hashlib
import random

from pyspark.sql import functions as F

from cairn.functions import digest
from cairn.operators import commits, control, derive, resolve, writethrough


def now():
    return F.lit("2024-01-01").cast("timestamp")


def test_digest_stops_anywhere():
    r = random.Random(1)
    for n in [*range(0, 130), 1000, 4097]:
        data, state, at = r.randbytes(n), digest.start(), 0
        while at < n:
            step = r.randrange(1, 90)
            state, at = digest.taken(state, data[at : at + step]), at + step
        assert digest.hexed(state) == hashlib.sha256(data).hexdigest()


def test_fingerprint_of_many_ranges(spark):
    ids = [f"pcat_{i % 700}" for i in range(1_000)] + ["", "é", "z" * 200, None]
    want = hashlib.sha256(b"".join(x.encode() + b"\0" for x in sorted({i for i in ids if i is not None}))).hexdigest()[:16]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    assert {control.backend_fingerprint(df.repartition(n), held=h).first()[0] for n, h in ((1, 10_000), (7, 100))} == {want}
    assert control.backend_fingerprint(df.limit(0)).first()[0] == hashlib.sha256(b"").hexdigest()[:16]
    assert control.drifted(df, "0" * 16) and not control.drifted(df, want) and not control.drifted(df, None)


def emitted(spark, *rows):
    return spark.createDataFrame(list(rows), "sku string, payload_hash string, qty int")


def test_failed_write_is_told_and_changes_nothing(spark, tmp_path, caplog):
    root, none = str(tmp_path / "ledger"), emitted(spark).select("sku")
    seeds = {"variations": spark.createDataFrame([("v", "h", "synced")], "variation_key string, payload_hash string, state string").withColumns({"created_at": now(), "updated_at": now()})}
    assert writethrough.record_source(spark, root, emitted(spark, ("a", "h", 3), ("a", "h", 5), (None, "h", 1), ("b", None, None)), none, now(), seeds)
    before, at = commits.head(spark, root)[0], commits.read(spark, root)
    assert {tuple(r) for r in at["products"].select("sku", "payload_hash", "state").collect()} == {("a", "h", "pending"), ("b", None, "pending")}
    assert {tuple(r) for r in at["inventory"].collect()} == {("a", 5, None), ("b", None, None)} and at["variations"].count() == 1
    broken = emitted(spark, ("c", "h", 1)).withColumn("qty", F.raise_error(F.lit("lost")).cast("int"))
    assert writethrough.record_source(spark, root, broken, none, now()) is False and "source did not reach the ledger" in caplog.text
    assert writethrough.record_source(spark, root, broken, none, now(), enabled=False) and writethrough.record_catalog(spark, root, None, now())
    assert commits.head(spark, root)[0] == before
    assert writethrough.record_source(spark, root, emitted(spark), emitted(spark, ("a", "", 0)).select("sku"), now())
    assert {(r["sku"], r["qty"]) for r in commits.current(spark, root, "inventory").collect()} == {("a", 0), ("b", None)}


def test_base_is_rebuilt_from_its_snapshot_only_when_nothing_is_out(spark, tmp_path):
    root = str(tmp_path / "base")
    table = lambda *xs: spark.createDataFrame([(x,) for x in xs], "name string")
    leases = lambda state: spark.createDataFrame([(state,)], "state string").withColumn("leased_at", now())
    commits.transact(spark, root, lambda _: {"base": table("a", "b"), "other": table("x")})
    assert writethrough.rebuild_base(spark, root, leases("synced"), now()) == (409, "nothing to rebuild from")
    commits.snapshot(spark, root, "pristine")
    commits.transact(spark, root, lambda _: {"base": table("broken"), "other": table("y")})
    assert writethrough.rebuild_base(spark, root, leases("syncing"), now())[0] == 409
    with commits.exclusive(spark, root, "purge"):
        assert writethrough.rebuild_base(spark, root, leases("synced"), now()) == (409, "purge is in progress")
    assert commits.current(spark, root, "base").first()[0] == "broken"
    assert writethrough.rebuild_base(spark, root, leases("synced"), now()) == (200, "rebuilt")
    assert {r[0] for r in commits.current(spark, root, "base").collect()} == {"a", "b"} and commits.current(spark, root, "other").first()[0] == "y"


def test_categories_and_keys_of_odd_rows(spark):
    rows = spark.createDataFrame([(1, ("slab", "tag")), (2, ("tile", "tag")), (3, ("mosaic", "override")), (4, None)], "id long, format struct<value: string, method: string>")
    words = spark.createDataFrame([("Slabs", "s1", 1), ("Slabs", "s2", 2), ("Slabs", " ", 3), (None, "n", 4)], "label string, pcat_id string, ordinal int")
    got = {r["id"]: (r["category_pcat_id"], r["category_method"]) for r in derive.category(rows, words, {"tile": "own", "block": ""}).collect()}
    assert got == {1: ("s2", "format:tag"), 2: ("own", "format:tag"), 3: (None, "format:override"), 4: (None, "format:unknown")}
    listed = spark.createDataFrame([("7",), ("8",), ("",), (None,)], "variation_id string")
    branch = lambda *xs: spark.createDataFrame(list(xs), "id string, key string")
    keyed = resolve.variation_keys(listed, [branch(("7", "first"), ("", "none"), (None, "null")), branch(("7", "second"), ("8", "a"), ("8", "b"))])
    assert {(r[0], r[1]) for r in keyed.collect()} == {("7", "first"), ("8", "b"), ("", None), (None, None)}
