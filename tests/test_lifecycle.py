from datetime import datetime

import numpy as np
from pyspark.sql import functions as F

from cairn.functions import kernels as K
from cairn.functions import numbers as N
from cairn.operators import adapters, lifecycle

ROW = "state string, attempts int, remote_id string, payload_hash string, error string, abandoned_at timestamp, created_at timestamp, updated_at timestamp, leased_at timestamp"


def now():
    return F.lit(datetime(2024, 5, 1, 12)).cast("timestamp")


def tables(spark):
    old, late = datetime(2024, 1, 1), datetime(2024, 5, 1, 11, 59)
    row = lambda state, **k: (state, k.get("n", 0), None, "h", None, None, old, old, k.get("leased"))
    varieties = [("a", "t", "u", *row("synced")), ("b", "t", "u", *row("pending")), ("c", "t", "u", *row("gap_held", n=5)), ("d", "", "u", *row("syncing", leased=old))]
    products = [("p1", "a", *row("dirty")), ("p2", "b", *row("dirty")), ("p3", "a", *row("gap_held", n=5)), ("p4", "a", *row("syncing", leased=late))]
    return {
        "variations": spark.createDataFrame(varieties, f"variation_key string, type string, image_url string, {ROW}"), "products": spark.createDataFrame(products, f"sku string, variation_key string, {ROW}"),
        "inventory": spark.createDataFrame([("p1", 2, 1), ("p2", 2, 2)], "sku string, qty int, last_synced_qty int"),
        "removed": spark.createDataFrame([("x", "product", "dead", None, old)], "external_id string, kind string, state string, abandoned_at timestamp, created_at timestamp"),
    }


def states(frame, key):
    return {r[key]: r["state"] for r in frame.collect()}


def test_pages_lease_what_they_give(spark):
    ts = tables(spark)
    code, page, changed = lifecycle.sync_request(ts, "GET", "products", now=now())
    assert (code, [r["sku"] for r in page.collect()]) == (200, ["p1"])  # p2's variety isn't synced, p4 is out
    assert states(changed["products"], "sku") == {"p1": "syncing", "p2": "dirty", "p3": "gap_held", "p4": "syncing"}
    _, page, _ = lifecycle.sync_request(ts, "GET", "variations", "1", now=now())
    assert page.count() == 1
    _, page, changed = lifecycle.sync_request(ts, "GET", "variations", "99999", now=now())
    assert states(changed["variations"], "variation_key")["d"] == "syncing" and page.count() == 2  # an old lease is served again


def test_acks_of_varieties_free_their_products(spark):
    acks = spark.createDataFrame([(1, "variation", "b", "synced", "r1", "h", None), (2, "product", "p2", "synced", "r2", "h", None), (3, "product", "p1", "failed", None, None, "no price")], "ordinal long, type string, external_id string, status string, remote_id string, payload_hash string, reason string")
    code, _, changed = lifecycle.sync_request(tables(spark), "POST", "ack", body=acks, now=now())
    got = {r["sku"]: (r["state"], r["attempts"], r["error"]) for r in changed["products"].collect()}
    assert code == 200 and got["p2"] == ("synced", 0, None) and got["p1"] == ("dirty", 1, "no price")
    assert lifecycle.sync_request(tables(spark), "POST", "ack", body="x")[0] == 400


def test_requeue_and_abandon(spark):
    ts = tables(spark)
    assert lifecycle.sync_request(ts, "POST", "abandon", body=("products", "p1"))[0] == 409
    assert lifecycle.sync_request(ts, "POST", "abandon", body=("products", "no"))[0] == 404
    assert lifecycle.sync_request(ts, "POST", "abandon", body=("orders", "p1"))[0] == 400
    code, _, changed = lifecycle.sync_request(ts, "POST", "abandon", body=("products", "p3"), now=now())
    assert code == 200 and changed["products"].where("abandoned_at is not null").count() == 1
    again = lifecycle.sync_request(ts | changed, "POST", "requeue")[2]
    assert states(again["products"], "sku")["p3"] == "gap_held" and states(again["variations"], "variation_key")["c"] == "dirty"
    failed = lifecycle.sync_request(ts | changed, "GET", "failures")[1]
    assert {(r["external_id"], r["abandoned_at"] is not None) for r in failed.collect()} == {("c", False), ("p3", True)}
    assert lifecycle.sync_request(ts, "POST", "requeue", body="removed")[0] == 400 and lifecycle.sync_request(ts, "PUT", "status")[0] == 404
    assert {r["type"] for r in lifecycle.sync_request(ts, "GET", "status")[1].collect()} == {"variations", "products"}
    assert [r["sku"] for r in lifecycle.sync_request({**ts, "products": ts["products"].withColumn("state", F.lit("synced"))}, "GET", "inventory")[1].collect()] == ["p1"]


def test_only_fresh_leases_block(spark):
    ts = tables(spark)
    assert lifecycle.in_flight(ts["products"], now()) and not lifecycle.in_flight(ts["variations"], now())


def test_certificate_tells_a_swapped_column(spark):
    words = {"color": ["red", "blue", "black"], "finish": ["polished", "honed", "raw"]}
    vocabulary = spark.createDataFrame([(c, w) for c, ws in words.items() for w in ws], "category string, norm string")
    sample = spark.createDataFrame([(str(i), "n", words["color"][i % 3], words["finish"][i % 3]) for i in range(6)], "id string, name string, c string, f string")
    right = adapters.Adapter("s", {"src_natural_key": "id", "raw_name": "name", "raw_color": "c", "raw_finish": "f"})
    swapped = adapters.Adapter("s", {"src_natural_key": "id", "raw_name": "name", "raw_color": "f", "raw_finish": "c"})
    run = lambda adapter, expected, code="1": {n: ok for n, ok, _ in lifecycle.certify("s", code, "auto", adapter, sample, expected, {"raw_color": "color", "raw_finish": "finish"}, vocabulary, {})}
    assert all(run(right, right.adapt(sample)).values())
    assert run(swapped, swapped.adapt(sample)) == {"config": True, "adapter": True, "golden": True, "vocabulary": False, "contract": True}
    assert not run(right, swapped.adapt(sample))["golden"] and not run(right, right.adapt(sample).where("src_natural_key <> '0'"))["golden"]
    assert run(None, None, "") == {"config": False, "adapter": False, "golden": False, "contract": True}


def test_dominant_color(spark):
    rng = np.random.default_rng(5)
    grey = np.repeat(rng.integers(100, 140, (400, 1)), 3, axis=1)
    green = np.array([40, 150, 60]) + rng.integers(-5, 6, (100, 3))
    clear = np.c_[np.tile([250, 0, 0], (900, 1)), np.zeros(900)]  # not opaque
    rows = [(1, np.r_[grey, green], 3), (2, grey, 3), (3, grey[:49], 3), (4, np.r_[np.c_[green, np.full(100, 255)], clear], 4), (5, None, 3), (6, np.r_[grey, green[:50]], 3)]
    frame = spark.createDataFrame([(i, None if a is None else bytearray(a.astype(np.uint8).tobytes()), c) for i, a, c in rows], "id int, pixels binary, channels int")
    rgb = frame.select("id", K.dominant_color("pixels", "channels").alias("x"))
    got = {r["id"]: r["name"] for r in rgb.select("id", F.when(F.col("x").isNotNull(), N.color_bucket(F.col("x.r"), F.col("x.g"), F.col("x.b"))).alias("name")).collect()}
    assert got == {1: "Green", 2: "Grey", 3: None, 4: "Green", 5: None, 6: "Grey"}
    assert K.dominant_rgb(np.tile([10, 200, 30], (60, 1)).astype(np.uint8).tobytes(), 3) == (10, 200, 30)
