from pyspark.sql import functions as F

from cairn import config as C
from cairn.operators import catalog, derive, health, ledger, resolve
from cairn.sources import readers, sinks


def test_ladder_resolves_and_rejects(spark):
    known = spark.createDataFrame([(1, "Arabescato", "marble", ["Arab"]), (2, "Afyon White", "marble", []), (3, "Crystal Tempest", "quartz", []), (4, "Crystal", "quartz", [])], "cid int, name string, type string, aliases array<string>")
    index = resolve.surfaces(known)
    asked = [("Arabescatto", "marble"), ("AfyonWhite", "marble"), ("White Afyon", ""), ("arab", "marble"), ("Crystal Tempest Black", "quartz"), ("Nothing Like It", "")]
    got = {r["query"]: (r["cid"], r["tier"], r["decision"]) for r in resolve.match_ladder(spark.createDataFrame(asked, "query string, qtype string"), index).collect()}
    assert got["AfyonWhite"] == (2, "projection_compact", "accept")
    assert got["White Afyon"] == (2, "projection_tokenset", "accept")
    assert got["arab"] == (1, "exact", "accept")
    assert got["Arabescatto"][0] == 1 and got["Arabescatto"][2] == "accept"
    assert got["Crystal Tempest Black"][0] != 4
    assert got["Nothing Like It"][1:] == ("no_candidate", "gap")


def test_ladder_finds_typos_at_word_starts_and_holds_ties(spark):
    known = spark.createDataFrame([(1, "Travertine", "travertine", []), (2, "Calacatta Golden", "marble", []), (3, "Calacatta Golden", "dolomite", []), (4, "Onyxia", "onyx", [])], "cid int, name string, type string, aliases array<string>")
    asked = [("Trsvertine", "travertine"), ("Calacatta Goldenq", ""), ("Calacatta Goldenq", "marble"), ("Trsvertine", "onyx"), ("Onyxia a", "onyx")]
    got = {(r["query"], r["qblock"]): (r["cid"], r["tier"], r["decision"]) for r in resolve.match_ladder(spark.createDataFrame(asked, "query string, qtype string"), resolve.surfaces(known)).collect()}
    assert got["Trsvertine", "travertine"] == (None, "review", "review")
    assert got["Trsvertine", "onyx"][1:] == ("no_candidate", "gap")
    assert got["Calacatta Goldenq", ""][1:] == ("review", "review")
    assert got["Calacatta Goldenq", "marble"] == (2, "fuzzy", "accept")
    assert got["Onyxia a", "onyx"] == (None, "review", "review")


def indel(a, b):
    """Insertion-deletion likeness by the longest common subsequence's table."""
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return 200 * row[-1] / (len(a) + len(b)) if a and b else 0.0


def likeness(a, b):
    return max(indel(a, b), indel(" ".join(sorted(a.split())), " ".join(sorted(b.split()))))


def test_ladder_query_against_brute_force(spark, sf):
    """The query's fuzzy tier against every candidate, its exact tiers against string rules."""
    from cairn.plans import catalog_queries as Q

    parts = [(r.p_name, r.p_type, r.p_size, r.p_partkey) for r in spark.read.parquet(f"{sf}/part.parquet").collect()]
    known = {}
    for name, kind, _, key in parts:
        known[name, kind] = min(key, known.get((name, kind), key))
    colour = lambda n: {w for w in n.split() if w in ("red", "blue")}
    want = {}
    for name, kind, size, _ in parts:
        q = [name + "s", name.replace(" ", ""), " ".join(reversed(name.split())), name][size % 4]
        mine = [(n, c) for (n, k), c in known.items() if k == kind]
        whole = [(n, k.lower(), c) for (n, k), c in known.items()]
        out = None
        for tier, test in (("exact", lambda n: q in (n, n + " stone")), ("projection_compact", lambda n: q.replace(" ", "") in (n.replace(" ", ""), n.replace(" ", "") + "stone")), ("projection_tokenset", lambda n: sorted(q.split()) in (sorted(n.split()), sorted((n + " stone").split())))):
            every = [(n, k, c) for n, k, c in whole if test(n)]
            named = [x for x in every if x[0] == q] if len(every) > 1 else []
            pool = named or every
            near = [x for x in pool if x[1] == kind.lower()]
            blocked = len(pool) > 1 and len(near) == 1
            left = near if blocked else pool
            if len(left) == 1:
                out = (left[0][2], tier + "_name" * bool(named) + "_blocked" * blocked)
                break
        if out is None:
            scored = sorted(((max(likeness(q, n), likeness(q, n + " stone")), n, c) for n, c in mine if not (colour(q) and colour(n) and not colour(q) & colour(n))), reverse=True)
            top = scored[0] if scored else (0,)
            out = ((top[2] if top[0] >= 92 else None), "fuzzy" if top[0] >= 92 else "review" if top[0] >= 84 else "no_candidate")
            if top[0] >= 92 and len([x for x in scored if x[0] == top[0]]) > 1:
                continue  # which of several names at one score comes first is the query's choice
        want[q, kind.lower()] = out
    got = {(r["query"], r["qblock"]): (r["cid"], r["tier"]) for r in Q.fuzzy_match_ladder(spark, sf).collect()}
    sound = {k for k, v in got.items() if v[1].startswith("phonetic")}
    assert len(want) > 50 and {k: got[k] for k in want if k not in sound} == {k: v for k, v in want.items() if k not in sound}


def test_fuzzy_vocabulary_query_against_brute_force(spark, sf):
    from cairn.plans import catalog_queries as Q

    words, said = ["red", "blue", "small", "large", "hot", "cold"], {"new": "Red", "old": None}
    for r in Q.vocab_resolve_fuzzy(spark, sf).collect():
        raw = r["raw"]
        best = max((likeness(raw, w), w.title()) for w in words)
        if raw in said:
            assert (r["value"], r["method"]) == (said[raw], "synonym" if said[raw] else "synonym_none")
        elif raw in words:
            assert (r["value"], r["method"]) == (raw.title(), "exact")
        else:
            assert (r["value"], r["method"]) == ((best[1], "fuzzy") if best[0] >= 90 else (None, "unresolved"))


def test_hashing_embedder_query_against_brute_force(spark, sf):
    import math
    import zlib

    from cairn.plans import catalog_queries as Q

    rows = Q.hashing_embedder(spark, sf).collect()
    for r in rows:
        text, counts = f"  {r['p_name']}  ", [0.0] * 64
        for i in range(len(text) - 2):
            counts[zlib.crc32(text[i : i + 3].encode()) % 64] += 1
        norm = math.sqrt(sum(c * c for c in counts))
        assert all(abs(float(x) - c / norm) < 6e-5 for x, c in zip(r["vector"].split(","), counts, strict=True))
    assert len(rows) > 10


def test_ladder_override_colour_ties_and_meaning(spark):
    known = spark.createDataFrame(
        [(1, "Andromeda White", "granite", []), (2, "Andromeda Cream", "granite", []), (3, "Onyx Bar", "onyx", ["Bar"]), (4, "Bar", "onyx", []), (5, "Twin", "marble", []), (6, "Twin", "granite", []), (7, "Pietra Grey", "marble", [])],
        "cid long, name string, type string, aliases array<string>",
    )
    colours = ["White", "Cream", "Grey", "Gray"]
    asked = [("Andromeda Creams", "granite"), ("Andromeda White", ""), ("bar", ""), ("Twin", ""), ("Twin", "marble"), ("Pietra Gray", "marble"), ("Forced", ""), ("Dawn", ""), ("Z Twin / polished", "granite")]
    q = spark.createDataFrame(asked, "query string, qtype string")
    over = spark.createDataFrame([("forced", 2)], "norm string, cid long")
    meant = spark.createDataFrame([("Dawn", 7, 90.0), ("Dawn", 1, 85.0)], "query string, cid long, score double")
    got = {(r["query"], r["qblock"]): (r["cid"], r["tier"], r["decision"]) for r in resolve.match_ladder(q, resolve.surfaces(known, colours), colours=colours, overrides=over, suggestions=meant).collect()}
    assert got["Andromeda Creams", "granite"] == (2, "fuzzy", "accept")
    assert got["bar", ""] == (4, "exact_name", "accept")
    assert got["Twin", ""] == (None, "exact_name_ambiguous", "review")
    assert got["Twin", "marble"] == (5, "exact_name_blocked", "accept")
    assert got["Pietra Gray", "marble"][0] == 7
    assert got["Forced", ""] == (2, "override", "accept")
    assert got["Dawn", ""] == (None, "semantic_review", "review")
    assert got["Z Twin / polished", "granite"] == (6, "projection_deprefixed_blocked", "accept")


def test_vocabulary_ladder(spark):
    v = spark.createDataFrame([("polished", "Polished"), ("leathered", "Leathered")], "norm string, canonical string")
    s = spark.createDataFrame([("gloss", "Polished"), ("tbd", "none")], "norm string, target string")
    raw = spark.createDataFrame([("Polished",), ("gloss",), ("TBD",), ("Leatherd",), ("zzz",), ("",)], "raw string")
    got = {r["raw"]: (r["value"], r["method"]) for r in resolve.resolve_vocabulary(raw, v, s).collect()}
    assert got == {"Polished": ("Polished", "exact"), "gloss": ("Polished", "synonym"), "TBD": (None, "synonym_none"), "Leatherd": ("Leathered", "fuzzy"), "zzz": (None, "unresolved"), "": (None, "empty")}


def test_vocabulary_compares_with_every_word(spark):
    v = spark.createDataFrame([("dark brown", "Dark Brown"), ("leathered and polished", "Leathered And Polished")], "norm string, canonical string")
    s = spark.createDataFrame([], "norm string, target string")
    raw = spark.createDataFrame([("brown dark",), ("xeathered and polishex",), ("light",)], "raw string")
    got = {r["raw"]: (r["value"], r["method"]) for r in resolve.resolve_vocabulary(raw, v, s).collect()}
    assert got == {"brown dark": ("Dark Brown", "fuzzy"), "xeathered and polishex": ("Leathered And Polished", "fuzzy"), "light": (None, "unresolved")}


def test_health_paths(spark):
    assert health.structural(spark.range(1).toDF("a"), ["a", "b"], [])["status"] == "FAILED"
    assert health.structural(spark.range(1).toDF("a"), ["a"], [])["status"] == "OK"
    assert health.renamed(["material_name"], ["materialname", "x"]) == {"material_name": "materialname"}
    empty = spark.createDataFrame([], "a string")
    assert [tuple(r) for r in health.fill_rates(empty).collect()] == [("a", 0.0)]
    one = spark.range(1).select(health.drift_status(F.lit(50.0), F.lit(10.0)).alias("a"), health.drift_status(F.lit(1.0), F.lit(1000.0)).alias("b"), health.volume_status(F.lit(4), F.lit(10)).alias("c")).first()
    assert tuple(one) == ("DEGRADED", "FAILED", "FAILED")


def test_derivation(spark):
    d = spark.createDataFrame([("Free", "tile"), ("332m", "slab"), ("6.44m", "slab"), ("105 to 145cm", "slab")], "raw string, form string")
    got = [tuple(r["d"])[:2] for r in d.select(derive.dimension(F.col("raw"), F.col("form"), 0).alias("d")).collect()]
    assert got == [(0.6, "default"), (3.32, "cm_fix"), (6.44, "parsed"), (1.45, "parsed")]
    t = spark.range(1).select(derive.title(F.lit("azul bahia"), F.lit("polished"), F.lit("slab"), F.lit("granite")).alias("a"), derive.title(F.lit("black granite"), F.lit("raw"), F.lit("block"), F.lit("Granite")).alias("b")).first()
    assert tuple(t) == ("Azul Bahia Polished Granite", "Black Granite")
    q = spark.createDataFrame([("0", None, None), (None, None, "17"), (None, None, None), ("2000000", None, None)], "s string, q string, m string")
    inv = [r["i"] and r["i"]["value"] for r in q.select(derive.inventory_ladder(F.col("s"), F.col("q"), F.col("m"), F.lit(2.0), F.lit(2.0)).alias("i")).collect()]
    assert inv == [0, 4, None, C.INVENTORY_CAP]


def test_row_rules_each_reject(spark):
    good = {f"{k}_id": "x" for k in ("type", "color", "finish", "quality", "variation", "category")} | {"tree_gap": False, "handle": "h", "owner": "o", "origin": "IT", "images": 1, "image_terminal": False, "dimension_unavailable": False, "length": 1.0, "inventory": 1, "review_flags": []}
    bad = [good] + [good | {k: None} for k in ("type_id", "color_id", "finish_id", "quality_id", "variation_id", "category_id", "handle", "owner", "origin", "inventory")] + [good | {"tree_gap": True}, good | {"images": 0}, good | {"images": 0, "image_terminal": True}, good | {"dimension_unavailable": True}, good | {"length": -1.0}, good | {"review_flags": ["f"]}]
    kinds = {"tree_gap": "boolean", "images": "int", "image_terminal": "boolean", "dimension_unavailable": "boolean", "length": "double", "inventory": "int", "review_flags": "array<string>"}
    rows = spark.createDataFrame([tuple(b.values()) for b in bad], ", ".join(f"{k} {kinds.get(k, 'string')}" for k in good))
    routes = [r["route"] for r in derive.validate(rows, derive.row_rules()).collect()]
    assert routes == ["emit"] + ["reject"] * 12 + ["emit"] + ["reject"] * 2 + ["review"]


def test_catalog_sets(spark):
    a, b = spark.createDataFrame([(1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert sorted(tuple(r) for r in catalog.delta(a, b).collect()) == [(1, "added"), (3, "removed")]
    assert catalog.same_rows(a, a) and not catalog.same_rows(a, b)
    runs = spark.createDataFrame([("s", 1, True), ("s", 2, True), ("s", 3, False)], "source string, run_id int, complete boolean")
    assert [r["run_id"] for r in catalog.superseded(runs).collect()] == [1]
    assert [r["run_id"] for r in readers.latest_per_source(runs, usable=F.col("complete")).collect()] == [2]
    u = spark.createDataFrame([("k", ["A"], "i")], "key string, aliases array<string>, image string")
    assert catalog.real_delta(u, spark.createDataFrame([("k", ["a"], "i")], "key string, aliases array<string>, image string")).isEmpty()


def test_ledger_cycle(spark, tmp_path):
    now = F.lit("2024-01-01").cast("timestamp")
    s = spark.createDataFrame([(i, "pending") for i in range(7)], "sku int, state string").withColumn("created_at", now).withColumn("leased_at", F.lit(None).cast("timestamp"))
    page, leased = ledger.serve(s, s, "sku", now, 3)
    assert page.count() == 3 and leased.where("state = 'syncing'").count() == 3
    assert ledger.reap(leased, F.lit("2024-01-02").cast("timestamp")).where("state = 'dirty'").count() == 3
    done, rounds = ledger.converge(s, "sku", size=3)
    assert rounds == 3 and done.where("state = 'synced'").count() == 7
    acks = spark.createDataFrame([("a", i, False) for i in range(5)] + [("b", 0, False), ("b", 1, True), ("c", 0, False)], "k string, i int, ok boolean")
    assert {r["k"]: r["state"] for r in ledger.ack_fold(acks, "k", ["i"], F.col("ok")).collect()} == {"a": "gap_held", "b": "synced", "c": "dirty"}
    ledger.write_version(s, str(tmp_path), "product", 1)
    ledger.publish(spark, str(tmp_path), {"product": 1})
    assert ledger.current(spark, str(tmp_path), "product").count() == 7
    products = spark.createDataFrame([("s1", "x"), ("s2", "x")], "sku string, source string")
    inventory = spark.createDataFrame([("s1", 0, None), ("s2", 3, None)], "sku string, qty int, reason string")
    stones, left, _ = ledger.purge(products, inventory, "gone")
    assert stones.count() == 1 and left.count() == 1
    assert {r["sku"]: r["qty"] for r in ledger.delist(inventory, products, "x").collect()} == {"s1": 0, "s2": 0}


def test_scrape_and_sinks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,name\n1,"a, ""b"""\n2,=x\n', encoding="utf-8")
    r = readers.read_scrape(spark, str(tmp_path / "a.csv"))
    assert r.columns == ["id", "name", "_ordinal"] and r.dtypes[0] == ("id", "string")
    out = sinks.template(r, ["Name", "None", "N"], {"Name": F.col("name"), "N": F.lit(1.50)}).collect()
    assert [tuple(x) for x in out] == [('a, "b"', "", "1.5"), ("'=x", "", "1.5")]
    h = spark.createDataFrame([("<table><tr><th>Unit</th><td> <b>SQM</b></td></tr><tr><th>Unit</th><td>x</td></tr></table>",)], "h string")
    assert h.select(readers.attribute_table(F.col("h")).alias("m")).first()["m"] == {"unit": "SQM"}
