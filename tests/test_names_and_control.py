from pyspark.sql import functions as F

from cairn.functions import names as M
from cairn.operators import adapters, control


def one(spark, values, f):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r["x"] for r in d.select("i", f(F.col("c")).alias("x")).orderBy("i").collect()]


def test_alias_list(spark):
    d = spark.createDataFrame([("Rosa", ["Rosé", "rose", "ROSÉ"]), ("X", ["In China Market:(bai Si Hui Wang)", "Tropical Rain Forest, Rain Forest", "()", "x"]), ("Y", None)], "n string, a array<string>")
    assert [r["x"] for r in d.select(M.alias_list(F.col("n"), F.col("a")).alias("x")).collect()] == [["Rosé"], ["Bai Si Hui Wang", "Tropical Rain Forest", "Rain Forest"], []]


def test_clean_variety_name(spark):
    asked = ["Z Astoria", "Super – 1.08", "Marjan – No. 426", "883 Black", "G682", "La Perla", "Rosal C", "Onyx I", "Red Wendeng-z", "Bianco C T", "Z", "ZB Blue"]
    want = ["Astoria", "Super", "Marjan", "Black", "G682", "La Perla", "Rosal", "Onyx I", "Red Wendeng", "Bianco C", "Z", "Blue"]
    assert one(spark, asked, lambda c: M.clean_variety_name(c, lead_codes=("zb",))) == want


def test_artifacts_and_codes(spark):
    assert one(spark, ["Z Astoria", "883 Black", "大理石", "", "Azul", "G682 Grey"], M.looks_like_artifact) == [True, True, True, True, False, False]
    assert one(spark, ["Rosal C", "Gs", "Ice", "G682", ""], M.code_shape) == ["lone_letter", "bare_code", "", "", ""]


def test_words(spark):
    assert one(spark, ["Azul Marble", "Marble Azul", "Marble", "Falsa Marble", "Marble False Marble", "azul MARBLE"], lambda c: M.explicit_type_word(c, ["marble"])) == ["Marble", "Marble", None, None, None, "MARBLE"]
    assert one(spark, ["Preto São", "nothing", "the grey black"], lambda c: M.extract_word(c, {"preto": "Black", "black": "Black", "grey": "Grey"})) == ["Black", None, "Grey"]
    d = spark.createDataFrame([(None, ["A"]), (None, ["A", "B"]), ("C", ["A"]), (None, None)], "v string, a array<string>")
    got = [r["x"] and r["x"]["method"] for r in d.select(M.from_variety(F.col("v"), F.col("a")).alias("x")).collect()]
    assert got == ["from_variety", "from_variety_primary", "scrape", None]


def test_adapter(spark):
    cols = "product_id material stone_type color finish dimension_length dimension_height image_urls".split()
    rows = [("1", "Azul&amp;Co", "Marble /", "N/A", "P", "2", "", "a| b|"), ("", "x", "", "", "", "", "", ""), (None, "x", None, None, None, None, None, None)]
    s = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    a = adapters.Adapter("s", adapters.listing_map(), columns=("product_id", "price"))
    got = a.adapt(s).collect()
    assert len(got) == 1 and got[0]["raw_name"] == "Azul&Co" and got[0]["raw_type"] == "Marble" and got[0]["raw_dimensions"] == "length=2m" and got[0]["raw_image_urls"] == ["a", "b"]
    assert a.missing(s) == ["price"] and adapters.smoke(a, s) == "FAILED" and not adapters.loss_allowed(3, 1)
    assert one(spark, ["1200"], lambda c: adapters.per_piece_weight(c, F.lit("5"))) == ["240.0"]


def test_decisions(spark):
    kind = "key string, action string, color string, type string, country string, target string, target_type string"
    old = spark.createDataFrame([("a", "mint", "Red", "t", "IT", None, None), ("b", "reject", None, None, None, None, None)], kind)
    new = spark.createDataFrame([("a", "alias", "Red", "t", "IT", "z", "tt")], kind)
    got = {r["key"]: r for r in control.decide(old, new).collect()}
    assert (got["a"]["action"], got["a"]["color"], got["a"]["target"]) == ("alias", None, "z") and got["b"]["action"] == "reject"
    learned = control.learn_rejects(old, spark.createDataFrame([("a",), ("c",)], "key string"))
    assert {(r["key"], r["action"]) for r in learned.collect()} == {("a", "mint"), ("b", "reject"), ("c", "reject")}


def test_overlay_twice(spark):
    b = spark.createDataFrame([("Azul", "Marble", ["Blue"])], "name string, type string, color array<string>")
    leaves = spark.createDataFrame([("azul", "MARBLE", "color", "Teal", "approve"), ("azul", "marble", "color", "blue", "approve"), ("azul", "marble", "color", "Red", "reject")], "name string, type string, attribute string, value string, action string")
    once = control.overlay(b, leaves, "color")
    assert once.first()["color"] == ["Blue", "Teal"] and control.overlay(once, leaves, "color").first()["color"] == ["Blue", "Teal"]


def test_sources(spark):
    s = spark.createDataFrame([("a", "X", ["p"]), ("b", "x", ["p"]), ("c", "y", [])], "source string, source_code string, ports array<string>")
    assert {tuple(r) for r in control.invalid_sources(s).collect()} == {("a", "source_code_taken"), ("b", "source_code_taken"), ("c", "no_port")}
    names = lambda *xs: spark.createDataFrame([(x,) for x in xs], "source string")
    assert sorted(r["source"] for r in control.seed_sources(names("a"), names("a", "b", "c"), names("c")).collect()) == ["a", "b"]
    ids = spark.range(50).select(F.col("id").cast("string"))
    assert control.backend_fingerprint(ids).first() == control.backend_fingerprint(ids.orderBy(F.desc("id"))).first()


def test_leaf_decisions(spark):
    frame = lambda rows, schema="name string, type string, attribute string, value string, action string, at long": spark.createDataFrame(rows, schema)
    none = spark.createDataFrame([], "name_norm string, type_norm string, attribute string, value_norm string, value string, action string, at long")
    changes = frame([("Azul  Bahia", "Granite", "Color", " Teal", "approve", 1), ("azul bahia", "granite", "color", "teal", "reject", 2), ("A", "b", "size", "x", "approve", 3), ("A", "b", "color", "x", "maybe", 4), ("A", "b", "color", None, "reject", 5)])
    assert [r["error"] for r in control.leaf_changes(changes).orderBy("at").collect()] == [None, None, "attribute", "action", "empty"]
    held = control.decide_leaves(none, changes, "at")
    assert [(r["value"], r["action"], r["at"]) for r in held.collect()] == [("teal", "reject", 2)]
    pending = spark.createDataFrame([("Azul Bahia", "granite", "color", "Teal", "likely_real", 7), ("Azul Bahia", "granite", "color", "Navy", "likely_real", 7), ("Azul Bahia", "granite", "finish", "Honed", "doubtful", 7)], "name string, type string, attribute string, value string, verdict string, at long")
    assert {r["value"] for r in control.undecided_leaves(pending, held).collect()} == {"Navy", "Honed"}
    more = control.approve_leaves(held, pending, "at", "likely_real")
    assert {(r["value"], r["action"]) for r in more.collect()} == {("teal", "reject"), ("Navy", "approve")}
    revisions = more.select(*control.LEAF_KEY, F.when(F.col("value") == "Navy", "clear").otherwise("approve").alias("action"), F.lit(9).cast("long").alias("at"))
    assert [(r["value"], r["action"], r["at"]) for r in control.revise_leaves(more, revisions, "at").collect()] == [("teal", "approve", 9)]
