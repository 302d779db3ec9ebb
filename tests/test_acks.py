"""Batches of acknowledgements, in one step and as a stream, against the rule applied one by one."""
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cairn.operators import acks, lifecycle

ROW = "state string, attempts int, remote_id string, payload_hash string, error string, updated_at timestamp"
ACK = "ordinal long, type string, external_id string, status string, remote_id string, payload_hash string, quantity long, reason string"
NOW = datetime(2024, 5, 1, 12)


def start(seed, n=8):
    r = random.Random(seed)
    states = ("pending", "synced", "dirty", "syncing", "gap_held", "retiring")
    row = lambda: [r.choice(states), r.choice([None, 0, 1, 3, 4, 5]), r.choice([None, "r"]), r.choice("hk"), r.choice([None, "e"])]
    return {
        "variations": {f"v{i}": row() for i in range(n)}, "products": {f"p{i}": [f"v{r.randrange(n + 2)}", *row()] for i in range(n)},
        "inventory": {f"p{i}": [r.randrange(3), r.choice([None, 0, 1])] for i in range(0, n + 2)}, "removed": {**{f"v{i}": ["variation", "pending", r.choice([None, 0, 3])] for i in range(0, n, 2)}, **{f"x{i}": ["product", "pending", 0] for i in range(4)}},
    }


def some_acks(seed, count, n=8):
    r = random.Random(seed)
    out = []
    for k in range(count):
        kind = r.choice(["variation", "variations", "product", "products", "products", "inventory", "removed", "removed", "combination", None])
        key = {"v": f"v{r.randrange(n + 1)}", "p": f"p{r.randrange(n + 1)}", "i": f"p{r.randrange(n + 2)}", "r": r.choice([f"v{r.randrange(n)}", f"x{r.randrange(5)}"])}.get((kind or "c")[0], "c1")
        key = None if r.random() < 0.03 else key
        out.append((k * 7, kind, key, r.choice(["synced", "synced", None, "failed", "done", "blocked"]), r.choice([None, "r2", "r3"]), r.choice([None, None, "h", "k"]), r.choice([None, 0, 1, 2]), r.choice([None, "why"])))
        if r.random() < 0.2:  # delivered twice
            out.append((k * 7 + 1, *out[-1][1:]))
    return out


def one_by_one(t, batch):
    t = {k: {a: list(b) for a, b in v.items()} for k, v in t.items()}
    told = []

    def fold(row, ok, rid, reason):
        if ok:
            row[:] = ["synced", 0, rid, row[3], None]
        else:
            n = (row[1] or 0) + 1
            row[:] = ["gap_held" if n >= 5 else "dirty", n, row[2], row[3], (reason or "apply failed")]
        return True

    def one(kind, key, status, rid, echo, qty, reason):
        ok = status != "failed"
        if kind.startswith("removed"):
            stone = t["removed"].get(key)
            if not stone:
                return False
            if status == "done":
                if stone[0] == "variation":
                    if any(p[0] == key for p in t["products"].values()):
                        return False
                    t["variations"].pop(key, None)
                del t["removed"][key]
                return True
            stone[2] = (stone[2] or 0) + 1
            stone[1] = "dead" if stone[2] >= 5 else "pending"
            return True
        if kind == "inventory":
            stock, product = t["inventory"].get(key), t["products"].get(key)
            if not ok or not stock or not product or product[1] != "synced" or (qty is not None and qty != stock[0]):
                return False
            stock[1] = stock[0]
            return True
        row = t["variations" if kind.startswith("v") else "products"].get(key)
        body = row and (row if kind.startswith("v") else row[1:])
        if not row or body[0] == "retiring" or (ok and echo is not None and echo != body[3]):
            return False
        if ok and kind.startswith("p") and t["variations"].get(row[0], [""])[0] != "synced":
            return False
        fold(body, ok, rid, reason)
        row[:] = body if kind.startswith("v") else [row[0], *body]
        return True

    for n, kind, key, status, *rest in batch:
        if kind not in acks.KINDS or key is None:
            told.append((n, "skipped"))
        else:
            told.append((n, "applied" if one(kind, key, status or "synced", *rest) else "missed"))
    return t, told


def frames(spark, t):
    at = datetime(2024, 1, 1)
    return {
        "variations": spark.createDataFrame([(k, *v, at) for k, v in t["variations"].items()], f"variation_key string, {ROW}"), "products": spark.createDataFrame([(k, *v, at) for k, v in t["products"].items()], f"sku string, variation_key string, {ROW}"),
        "inventory": spark.createDataFrame([(k, *v) for k, v in t["inventory"].items()], "sku string, qty int, last_synced_qty int"), "removed": spark.createDataFrame([(k, *v) for k, v in t["removed"].items()], "external_id string, kind string, state string, attempts int"),
    }


def plain(tables):
    return {
        "variations": {r[0]: [r["state"], r["attempts"], r["remote_id"], r["payload_hash"], r["error"]] for r in tables["variations"].collect()},
        "products": {r["sku"]: [r["variation_key"], r["state"], r["attempts"], r["remote_id"], r["payload_hash"], r["error"]] for r in tables["products"].collect()},
        "inventory": {r["sku"]: [r["qty"], r["last_synced_qty"]] for r in tables["inventory"].collect()},
        "removed": {r["external_id"]: [r["kind"], r["state"], r["attempts"]] for r in tables["removed"].collect()},
    }


@pytest.mark.parametrize("seed", range(4))
def test_a_batch_equals_its_acks_in_turn(spark, seed):
    t, batch = start(seed), some_acks(seed, 150)
    want, told = one_by_one(t, batch)
    changed, outcome = acks.apply_batch(frames(spark, t), spark.createDataFrame(batch, ACK).repartition(3), F.lit(NOW))
    assert plain(changed) == want
    assert sorted(map(tuple, outcome.collect())) == sorted(told)


def test_as_of_over_blocks(spark):
    r = random.Random(3)
    rows = [(k % 3, k, r.choice([None, None, k])) for k in range(400)]
    df = spark.createDataFrame(rows, "k long, o long, v long")
    got = {x["o"]: x["before"] for x in acks.as_of(df, "k", "o", "v", "before", block=17).collect()}
    assert got == {o: max((x for y, p, x in rows if y == k and p < o and x is not None), default=None) for k, o, _ in rows}


def test_requests_with_acks_of_all_types(spark):
    t = start(9)
    t["variations"] |= {"v1": ["dirty", 0, None, "h", None]}
    t["products"] |= {"p1": ["v1", "dirty", 0, None, "h", None]}
    t["inventory"] |= {"p1": [2, None]}
    body = [{"type": "products", "external_id": "p1"}, {"type": "variations", "external_id": "v1", "status": "failed"}, {"type": "variations", "external_id": "v1", "remote_id": "r"}, {"type": "products", "external_id": "p1"}, {"type": "inventory", "external_id": "p1", "quantity": 2}, {"type": "removed", "external_id": "x1", "status": "done"}, {"external_id": "p1"}, 7]
    code, answer, changed = lifecycle.sync_request(frames(spark, t), "POST", "ack", body=body, now=F.lit(NOW))
    assert (code, answer) == (200, {"applied": 5, "missed": 1, "skipped": 2})  # the first product comes before its variety
    got = plain(changed)
    assert got["variations"]["v1"] == ["synced", 0, "r", "h", None] and got["products"]["p1"][1] == "synced" and got["inventory"]["p1"] == [2, 2] and "x1" not in got["removed"]
    assert len(got["variations"]) == len(t["variations"])
