"""Entities and folding against the standard library, for every name and code point; inventory marks and tags."""
import html
import unicodedata
from html.entities import html5

from pyspark.sql import functions as F

from cairn.functions import text as T


def column(spark, values, f):
    df = spark.createDataFrame(list(enumerate(values)), "i int, s string").select("i", f(F.col("s")).alias("x"))
    return [r["x"] for r in sorted(df.collect())]


def test_every_entity(spark):
    cases = [f"a&{n} b" for n in html5] + [f"x&{n}y" for n in html5 if not n.endswith(";")] + ["&", "&&amp;", "&#;", "&#x;", "&notit;", "&copy x", "a &unknown; b", "&amp;lt;", "&#65", "&#x41;z", "&#99999999999;", "&#0;", "&#x80;&#x9F;&#129;", "&#xD800;", "&#11;", "&#xFFFF;", "&#13;", "<&lt<", "&AMP&amp", "&#038;"]
    assert column(spark, cases, T._unescaped) == [html.unescape(x) for x in cases]


def test_every_code_point_folds_like_its_decomposition(spark):
    chars = [chr(c) for c in range(0x80, 0x110000) if not 0xD800 <= c < 0xE000 and (unicodedata.decomposition(chr(c)) or c < 0x250 or chr(c) in T.SPECIAL)]
    want = [T.SPECIAL.get(c) or unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode() for c in chars]
    got = column(spark, ["a" + c + "b" for c in chars], T.ascii_fold)
    assert [(c, g) for c, g, w in zip(chars, got, want, strict=True) if g != f"a{w}b"] == []


def test_marks_and_tags(spark):
    cases = {
        "Z Astoria": "astoria", "ZB Verde / 2cm polished": "verde", "z b Rosa": "rosa", "Z B": "b", "Zebra": "zebra", "Nero 2 cm": "nero", "Nero 20CM": "nero", "Rosa grade A": "rosa", "Grade A": "",
        "Onyx / Honed / 2cm": "onyx", "Onyx/white": "onyx white", "Onyx / 3 cm slab": "onyx", "Onyx / matter": "onyx matter", "cm 2": "cm 2", "": "", None: "",
    }
    assert dict(zip(cases, column(spark, list(cases), T.deprefixed), strict=True)) == cases
