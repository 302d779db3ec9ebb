"""A batch of requests to sources against the rule applied one request at a time."""
import random

import pytest

from cairn.operators import machine, source_requests as R

SCHEMA = {"sources": "source string, source_code string, ports array<string>, enabled boolean, lifecycle string, vendor string", "removed": "source string", "products": "sku string, source string, qty int"}
ASKED = "n long, source string, verb string, source_code string, ports array<string>, enabled boolean"
ADAPTERS = ["a", "b", "c", "hot"]


def one_by_one(sources, removed, products, asked):
    """The rule as a loop; codes are as the batch finds them, a free one goes to its first sound put."""
    asked = sorted(asked)
    held = {}
    for s, code, *_ in sources:
        held.setdefault((code or "").strip().lower(), set()).add(s)
    at, gone, stock, cleaned, answers, first = {s[0]: list(s) for s in sources}, {r[0] for r in removed}, {p[0]: list(p) for p in products}, set(), [], {}

    def refusal(source, code, ports):
        if source not in ADAPTERS:
            return "no_adapter"
        if not any((p or "").strip() for p in ports or []):
            return "no_port"

    for _, source, verb, code, ports, _ in asked:
        if verb == "put" and refusal(source, code, ports) is None:
            first.setdefault((code or "").strip().lower(), source)
    for n, source, verb, code, ports, enabled in asked:
        source, c, detail, status = source or "", (code or "").strip().lower(), None, 200
        live = any(p[1] == source and (p[2] or 0) > 0 for p in stock.values())
        row = at.get(source)
        if verb not in R.VERBS:
            status, detail = 405, "no_such_request"
        elif verb == "put":
            detail = refusal(source, code, ports)
            if detail is None and c and (held[c] - {source} if c in held else first[c] != source):
                detail = "code_taken"
            if detail:
                status = 400
            else:
                old = row or [source, None, None, None, "active", None]
                at[source] = [source, code, ports, True if enabled is None else enabled, old[4] or "active", old[5]]
                gone.discard(source)
        elif row is None:
            status, detail = 404, "unknown_source"
        elif verb in ("pause", "resume", "delist"):
            detail = "restock_required" if verb == "resume" and row[4] == "delisted" else None
            row[3], row[4] = verb == "resume", {"pause": "paused", "resume": "active", "delist": "delisted"}[verb]
            if verb == "delist":
                for p in stock.values():
                    if p[1] == source:
                        p[2] = 0
        elif verb == "remove" and live:
            status, detail = 409, "live_products"
        elif verb in ("purge", "remove"):
            stock = {k: p for k, p in stock.items() if p[1] != source or (p[2] or 0) > 0}
            if verb == "remove":
                del at[source]
                gone.add(source)
        elif row[4] in ("paused", "delisted"):
            status, detail = 409, "frozen"
        else:
            cleaned.add(source)
        answers.append((n, source, verb, status, detail))
    plain = lambda r: (r[0], r[1], tuple(r[2] or []), r[3], r[4] or "active", r[5])
    return {plain(r) for r in at.values()}, gone, {(p[0], p[1], p[2]) for p in stock.values()}, cleaned, set(answers)


def batch(spark, sources, removed, products, asked, width):
    tables = {k: spark.createDataFrame(v, SCHEMA[k]) for k, v in (("sources", sources), ("removed", removed), ("products", products))}
    out, answers = R.apply_requests(tables, spark.createDataFrame(asked, ASKED), ADAPTERS, width)
    assert out["sources"].columns == tables["sources"].columns and out["products"].dtypes == tables["products"].dtypes
    got = {(r[0], r[1], tuple(r[2] or []), r[3], r[4] or "active", r[5]) for r in out["sources"].collect()}
    return got, {r[0] for r in out["removed"].collect()}, {tuple(r) for r in out["products"].collect()}, {r[0] for r in out["cleaned"].collect()}, {tuple(r) for r in answers.collect()}


def made(seed, n):
    r = random.Random(seed)
    names = ["a", "b", "c", "hot", "hot", "hot", "x", None]
    sources = [("a", "A1", ["p"], True, None, "va"), ("b", " a2", ["p"], False, "paused", "vb"), ("x", None, None, None, "delisted", None), ("y", "A9", ["p"], True, "active", "vy")]
    products = [(f"s{i}", r.choice(["a", "b", "hot", "x", None]), r.choice([0, 3, None])) for i in range(20)]
    verbs = [*R.VERBS, "put", "resume", "polish", None]
    asked = [(i, r.choice(names), r.choice(verbs), r.choice(["a1", "A2", "z ", "Z", "q", "", None]), r.choice([["p"], ["p", "r"], [" "], [None], [], None]), r.choice([True, False, None])) for i in r.sample(range(3 * n), n)]
    return sources, [("c",), ("gone",)], products, asked


@pytest.mark.parametrize("seed,n,width", [(1, 150, 4), (2, 150, 3), (3, 200, 256)])
def test_batch_equals_one_by_one(spark, seed, n, width):
    case = made(seed, n)
    want = one_by_one(*case)
    assert len({(a[3], a[4]) for a in want[4]}) > 5  # the case has most of the answers
    assert batch(spark, *case, width) == want


def test_no_requests_and_no_tables(spark):
    sources, removed, products, asked = made(4, 20)
    assert batch(spark, sources, removed, products, [], 4) == one_by_one(sources, removed, products, [])
    assert batch(spark, [], [], [], asked, 4) == one_by_one([], [], [], asked)


def test_states_of_a_hot_key_in_small_runs(spark):
    """A counter modulo five with one key of most requests: what each request meets is the sum before it, in runs of three."""
    from pyspark.sql import functions as F

    r = random.Random(7)
    steps = [("hot" if r.random() < 0.9 else f"k{r.randrange(9)}", n, r.randrange(5)) for n in r.sample(range(5_000), 600)]
    rows = spark.createDataFrame(steps, "key string, n long, step int")
    moves = rows.withColumn("move", F.transform(F.sequence(F.lit(0), F.lit(4)), lambda s: ((s + F.col("step")) % 5).cast("int")))
    got = {(x["key"], x["n"]): x["before"] for x in machine.states_before(moves, spark.createDataFrame([("hot", 2)], "key string, state int"), "key", 3).collect()}
    at, want = {"hot": 2}, {}
    for key, n, step in sorted(steps, key=lambda x: x[1]):
        want[key, n] = at.get(key, 0)
        at[key] = (at.get(key, 0) + step) % 5
    assert got == want
