"""Source maps, text cleaning, the import file and the ledger's pointer on small frames."""
import pytest
from pyspark.sql import functions as F

from cairn.functions import names as M
from cairn.functions import text as T
from cairn.operators import adapters, curation, ledger
from cairn.sources import sinks


def one(spark, values, f):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(f(F.col("v"))).collect()]


def test_clean_and_keys(spark):
    assert one(spark, ["a &amp; b&nbsp;", "&#233;t&eacute; &unknown; &", "​x y ", None, "&#x41;&lt;"], T.clean) == ["a & b", "été &unknown; &", "x y", "", "A<"]
    assert one(spark, ["Crema Marfil Premium", "Z Astoria", "ZB Verde / 2cm polished", "Rosa grade A", "Nero 2 cm", "Zebra"], T.deprefixed) == ["crema marfil premium", "astoria", "verde", "rosa", "nero", "zebra"]
    assert one(spark, ["Xy", "Gry", "(st)", "El", "--"], T.looks_codey) == [True, True, False, False, False]
    assert one(spark, ["In China Market:(Bai Si", "Local market known as Rosa", "Market Stone", "Blue: Sky"], M.without_market) == ["Bai Si", "Rosa", "Market Stone", "Blue: Sky"]


def test_source_maps(spark):
    colours, types = {"preto": "Black", "gold": "Gold"}, {"granite": "Granite"}
    bundle = spark.createDataFrame(
        [("b1", "Semi Prec Alaska", "CIN Quartz Semi Prec Preto", "1000", "4"), ("b2", "Alaska Gold", "", "10", "0"), ("", "lost", "", "", "")], "bundle_id string, product_name_en string, product_name_pt string, weight_kg_net string, slab_count string"
    )
    for c in ("detail_url", "scrape_timestamp", "family", "finish", "classification", "format", "thickness", "area_m2", "description", "length_m", "height_m", "image_urls"):
        bundle = bundle.withColumn(c, F.lit("2|3" if c == "image_urls" else "2"))
    got = {r["src_natural_key"]: r for r in adapters.Adapter("z", adapters.bundle_map(colours)).adapt(bundle).collect()}
    assert set(got) == {"b1", "b2"} and got["b1"]["raw_color"] == "Black" and got["b2"]["raw_color"] == "Gold"
    assert float(got["b1"]["raw_weight"]) == 250 and got["b2"]["raw_weight"] == "" and got["b1"]["raw_dimensions"] == "length=2m;height=2m" and got["b1"]["raw_image_urls"] == ["2", "3"]
    assert one(spark, ["Granite / ", "Exotic / ", "Stock Clearance", None], lambda c: adapters.mixed_type(c, types)) == ["Granite", "", "", ""]
    assert one(spark, ["Super White Slabs", "Cream Marble Tile"], adapters.without_format) == ["Super White", "Cream Marble"]
    assert one(spark, ["Marble /", "Marble", " Onyx / "], lambda c: adapters.without_trailing(c, "/")) == ["Marble", "Marble", "Onyx"]


def test_import_columns_and_headers(spark):
    assert len(sinks.IMPORT_COLUMNS) == 55 and len(set(sinks.IMPORT_COLUMNS)) == 55
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([("y", 2)], "s string, i int")
    assert curation.collect_products([a, a]).count() == 2
    with pytest.raises(ValueError):
        curation.collect_products([a, b])


def test_pointer_survives_an_unfinished_write(spark, tmp_path):
    root = str(tmp_path / "ledger")
    rows = spark.createDataFrame([(1,)], "k int")
    ledger.write_version(rows, root, "t", 1)
    ledger.publish(spark, root, {"t": 1})
    ledger.write_version(rows.union(rows), root, "t", 2)
    (tmp_path / "ledger" / "_commits" / "_part-1").write_text("{")  # a driver lost while it wrote
    assert ledger.current(spark, root, "t").count() == 1
    ledger.publish(spark, root, {"t": 2})
    assert ledger.current(spark, root, "t").count() == 2


def test_ledger_belongs_to_one_environment(spark):
    meta = ledger.bind_env(spark.createDataFrame([], "env string, fingerprint string"), "dev", "f")
    assert ledger.bind_env(meta, "dev", "f").count() == 1
    with pytest.raises(RuntimeError):
        ledger.bind_env(meta, "prod", "f")
