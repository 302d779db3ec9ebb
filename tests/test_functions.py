import uuid

import pytest
from pyspark.sql import functions as F

from cairn import config
from cairn.functions import kernels as K
from cairn.functions import names
from cairn.functions import numbers as N
from cairn.functions import text as T


def apply(spark, values, *fs, kind="string"):
    d = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [tuple(r)[1:] for r in d.select("i", *(f(F.col("c")).alias(f"_{k}") for k, f in enumerate(fs))).orderBy("i").collect()]


def test_parse_number(spark):
    cases = {"2.500.000": 2500000, "1.234.567": 1234567, "2.80": 2.8, "1.234": 1.234, "1.234,56": 1234.56, "1,234.56": 1234.56, "1,234": 1234, ".5": 0.5, ",5": 0.5, "thickness: .8 cm": 0.8, "none": None, "": None, "-3,5": -3.5}
    assert [r[0] for r in apply(spark, list(cases), N.parse_number)] == list(cases.values())
    assert apply(spark, [None], N.parse_number) == [(None,)]


def test_match_key(spark):
    keys = [r[0] for r in apply(spark, ["Rosa Porriño", "Rosa Porrino", "Black & Gold", "Black Gold", None, "  ŁYSA—Góra_x ", "Straße", "Ærø"], T.match_key)]
    assert keys == ["rosa porrino", "rosa porrino", "black gold", "black gold", "", "lysa gora x", "strasse", "aero"]


def test_title_case(spark):
    got = [r[0] for r in apply(spark, ["AZUL MACAÚBAS", "giallo DI siena", "de something", "(lasa)", "42 x"], T.title_case)]
    assert got == ["Azul Macaúbas", "Giallo di Siena", "De Something", "(Lasa)", "42 X"]


def test_safe_cell(spark):
    got = [r[0] for r in apply(spark, ["=1", " +x", "-2", "@a", "\tq", "\rq", "plain", "", None], T.safe_cell)]
    assert got == ["'=1", "' +x", "'-2", "'@a", "'\tq", "'\rq", "plain", "", None]


def test_small_text_functions(spark):
    assert apply(spark, ["a (b) [c ] ()"], T.bracket_aliases, T.without_brackets) == [(["b", "c"], "a")]
    assert apply(spark, ["St", "El", "Kx", "Z", "a1", "brr"], T.looks_codey) == [(False,), (False,), (True,), (True,), (True,), (True,)]
    assert apply(spark, ["G654", "12", "No."], names.number_code) == [(False,), (True,), (True,)]
    assert apply(spark, ["x, y,,z "], T.split_list) == [(["x", "y", "z"],)]
    assert apply(spark, ["Grey Slab stone"], lambda c: T.strip_words(c, ["slab"])) == [("Grey stone",)]
    assert apply(spark, ["A&amp;B&nbsp;​"], T.clean) == [("A&B",)]
    assert apply(spark, ["n/a", "x"], T.na) == [("",), ("x",)]
    assert apply(spark, ["12,5", "https://x", "a|b", "word"], T.value_shape) == [("numeric",), ("url",), ("pipe",), ("len00",)]
    assert apply(spark, ["slab_lime_stone_x", "slab_foo_x"], lambda c: T.type_slug(c, ["lime", "lime_stone"])) == [("lime_stone",), ("foo",)]


def test_measures(spark):
    got = apply(spark, ["2-3 cm", "105 to 145cm", "2 cm", "3", "2 furlongs", None], N.parse_measure, N.parse_face, N.parse_thickness)
    want = [(0.025, 0.03, None), (1.25, 1.45, None), (0.02,) * 3, (3.0,) * 3, (None,) * 3, (None,) * 3]
    assert [tuple(None if x is None else round(x, 6) for x in r) for r in got] == want


def test_numbers_out(spark):
    assert apply(spark, [100.0, 0.5, 1e-7, None], N.plain_number, kind="double") == [("100",), ("0.5",), ("0.0000001",), (None,)]
    assert apply(spark, ["5", "0", "x", " 7 "], N.positive_int) == [(5,), (None,), (None,), (7,)]


def test_uuid5(spark):
    assert apply(spark, ["slab:azul_x", ""], N.uuid5) == [(str(uuid.uuid5(uuid.UUID(config.NAMESPACE), v)),) for v in ("slab:azul_x", "")]


@pytest.mark.parametrize(("a", "b", "want"), [("abc", "abc", 100), ("", "a", 0), ("abcd", "abxd", 75), ("kitten", "sitting", 200 * 4 / 13)])
def test_indel(a, b, want):
    assert K.indel_ratio(a, b) == pytest.approx(want)


def test_similarities():
    assert K.jaro_winkler("martha", "marhta") == pytest.approx(0.9611111)
    assert K.token_sort_ratio("white afyon", "afyon white") == 100
    assert K.phonetic("philip") == K.phonetic("filip")
    assert len(K.pair_features("azul x", "azul")) == 13
