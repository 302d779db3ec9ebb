"""Numbers, measures, hashes and formats over columns; text that isn't a number gives null, never an error."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import NAMESPACE

# Units of length in metres.
UNITS = {"m": 1.0, "cm": 0.01, "mm": 0.001, "in": 0.0254, "ft": 0.3048}
_NUMBER = r"(-?[.,]?\d[\d.,]*\d|-?[.,]?\d)"


def let(value: Column, then) -> Column:
    """then(value) with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def parse_number(c: Column) -> Column:
    """First number of a text in either locale.

    With both signs the rightmost is the decimal one; a lone comma is decimal if one or
    two digits follow; several dots are thousands; a single dot is decimal.
    """
    return let(F.regexp_extract(F.coalesce(c.cast("string"), F.lit("")), _NUMBER, 1), _number)


def _number(raw: Column) -> Column:
    comma, dot = raw.contains(","), raw.contains(".")
    last_comma, last_dot = F.char_length(raw) - F.instr(F.reverse(raw), ","), F.char_length(raw) - F.instr(F.reverse(raw), ".")
    plain = lambda x, gone: F.replace(x, F.lit(gone), F.lit(""))
    text = (
        F.when(comma & dot & (last_comma > last_dot), F.replace(plain(raw, "."), F.lit(","), F.lit(".")))
        .when(comma & dot, plain(raw, ","))
        .when(comma & raw.rlike(r"^-?\d*,\d{1,2}$"), F.replace(raw, F.lit(","), F.lit(".")))
        .when(comma, plain(raw, ","))
        .when(raw.rlike(r"\..*\."), plain(raw, "."))
        .otherwise(raw)
    )
    return F.regexp_replace(text, r"^(-?)\.", "$10.").try_cast("double")


def normalize_unit(c: Column) -> Column:
    low = F.lower(F.trim(F.coalesce(c, F.lit(""))))
    return F.when(low == "", "m").when(low.isin('"', "”", "''", "inch", "inches", "in."), "in").when(low.isin("'", "’", "feet", "foot", "ft."), "ft").otherwise(low)


def to_metres(value: Column, unit: Column) -> Column:
    """Null for a unit that isn't known."""

    def factor(u: Column) -> Column:
        out = F.lit(None).cast("double")
        for name, x in UNITS.items():
            out = F.when(u == name, F.lit(x)).otherwise(out)
        return out

    return value * let(normalize_unit(unit), factor)


_MEASURE = r"^\s*([\d.,]+)\s*(?:(?:-|–|to)\s*([\d.,]+))?\s*([A-Za-z\"'”’]*)\.?\s*$"


def _measure(c: Column, of_range) -> Column:
    """Metres of a measure; of_range gives a range's value from its two ends."""
    parts = F.struct(*(F.regexp_extract(c, _MEASURE, k).alias(n) for k, n in ((1, "a"), (2, "b"), (3, "u"))))

    def value(p: Column) -> Column:
        ends = F.struct(parse_number(p["a"]).alias("a"), parse_number(p["b"]).alias("b"))
        number = let(ends, lambda e: F.when(e["b"].isNotNull(), of_range(e["a"], e["b"])).otherwise(e["a"]))
        return F.when(p["a"] != "", to_metres(number, p["u"]))

    return let(parts, value)


def parse_measure(c: Column) -> Column:
    """Metres of `3`, `2 cm`, or the middle of `2-3 cm`; null for an unknown unit."""
    return _measure(c, lambda a, b: (a + b) / 2)


def parse_face(c: Column) -> Column:
    """Like parse_measure, but a range gives its larger end."""
    return _measure(c, F.greatest)


def parse_thickness(c: Column) -> Column:
    """Like parse_measure, but a range gives null."""
    return _measure(c, lambda a, b: F.lit(None).cast("double"))


def centimetre_fix(v: Column, low: float, high: float) -> Column:
    """A value far above the range that fits it as centimetres is one."""
    return F.when((v > high * 3) & ((v / 100).between(low * 0.3, high * 3)), v / 100).otherwise(v)  # v: a plain column or a bound one


def positive_int(c: Column) -> Column:
    n = F.trim(c.cast("string")).try_cast("int")
    return F.when(n > 0, n)


def plain_number(c: Column) -> Column:
    """Up to ten decimals, no exponent, no trailing zeros after the point."""
    text = c.cast("decimal(38,10)").cast("string")
    return F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")


def _marked(cols: list[Column]) -> Column:
    """Each part followed by a NUL."""
    return F.concat(*(x for c in cols for x in (F.coalesce(c.cast("string"), F.lit("")), F.char(F.lit(0)))))


def fingerprint(*cols: Column) -> Column:
    return F.substring(F.sha2(_marked(list(cols)).cast("binary"), 256), 1, 24)


def surrogate(natural: Column, site: Column, name: Column, form: Column) -> Column:
    """The natural key, else one minted from site, address or name, and format."""
    minted = F.concat(F.lit("mint_"), F.substring(F.sha1(_marked([site, name, F.lower(form)]).cast("binary")), 1, 16))
    return F.when(F.trim(natural) != "", F.trim(natural)).otherwise(minted)


def uuid5(name: Column, namespace: str = NAMESPACE) -> Column:
    h = F.sha1(F.concat(F.unhex(F.lit(namespace.replace("-", ""))), name.cast("binary")))
    variant = F.lower(F.hex((F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(F.lit(3))).bitwiseOR(F.lit(8))))
    part = lambda a, n: F.substring(h, a, n)
    return F.concat(part(1, 8), F.lit("-"), part(9, 4), F.lit("-5"), part(14, 3), F.lit("-"), variant, part(18, 3), F.lit("-"), part(21, 12))


def variety_key(branch: Column, type_slug: Column, name_slug: Column) -> Column:
    """The unique part covers branch and name, not the type."""
    return F.concat_ws("_", branch, type_slug, name_slug, uuid5(F.concat(branch, F.lit(":"), name_slug)))


def color_bucket(r: Column, g: Column, b: Column) -> Column:
    """Name of a stone's colour from 0..255 channels: a lightness ramp for neutral and washed-out light ones, else by hue."""

    def named(x: Column) -> Column:
        r, g, b = x["r"], x["g"], x["b"]
        top, low = F.greatest(r, g, b), F.least(r, g, b)
        v, s = top / 255, F.when(top == 0, 0.0).otherwise((top - low) / top)
        turn = F.when(top == low, 0.0).when(top == r, (g - b) / (top - low)).when(top == g, (b - r) / (top - low) + 2).otherwise((r - g) / (top - low) + 4)
        hue = F.pmod(turn * 60, F.lit(360.0))
        neutral = (s < 0.10) | ((s < 0.25) & (v > 0.80))
        # The ramp's and the hues' limits.
        ramp = F.when(v < 0.27, "Black").when(v < 0.70, "Grey").when(r > b + 12, "Cream").otherwise("White")
        earth = F.when(v < 0.55, "Brown").when(s > 0.4, "Gold").otherwise("Beige")
        rest = F.when(hue < 170, "Green").when(hue < 255, "Blue").when(hue < 290, "Purple").otherwise("Pink")
        return F.when(neutral, ramp).when((hue < 20) | (hue >= 345), "Red").when(hue < 45, earth).when(hue < 70, F.when(v > 0.6, "Yellow").otherwise("Brown")).otherwise(rest)

    return let(F.struct(r.cast("double").alias("r"), g.cast("double").alias("g"), b.cast("double").alias("b")), named)
