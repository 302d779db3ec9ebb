"""String functions over columns.  Every one is null-safe as stated and stays in the JVM."""
from __future__ import annotations

import json
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters without a decomposition, and what they fold to.
SPECIAL = {
    "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d",
    "Þ": "Th", "þ": "th", "ß": "ss", "ẞ": "SS", "ı": "i", "Ħ": "H", "ħ": "h", "Ŋ": "N", "ŋ": "n", "Ŧ": "T", "ŧ": "t", "ĸ": "k",
}
# Connectors that stay lower-case inside a title.
CONNECTORS = ("de", "do", "da", "di", "del", "della", "e", "y")


@cache
def _single_folds() -> tuple[str, str]:
    """Characters of the basic plane whose compatibility decomposition leaves exactly one ASCII character, and those."""
    source, target = [], []
    for code in range(0x80, 0x10000):
        c = chr(code)
        if c in SPECIAL or 0xD800 <= code < 0xE000:
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x) and ord(x) < 128)
        if len(plain) == 1 and plain != c:
            source.append(c)
            target.append(plain)
    return "".join(source), "".join(target)


def collapse_ws(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"(?U)\s+", " "))


@cache
def _many_folds() -> dict[str, str]:
    """Other characters whose compatibility decomposition leaves ASCII characters: several, or one for those beyond the basic plane."""
    out = {}
    for code in range(0x80, 0x110000):
        c = chr(code)
        if 0xD800 <= code < 0xE000 or c in SPECIAL or not unicodedata.decomposition(c):
            continue
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if ord(x) < 128)
        if len(plain) > 1 or (plain and code >= 0x10000):
            out[c] = plain
    return out


def ascii_fold(c: Column) -> Column:
    """Letters and signs to ASCII by their compatibility decompositions; other characters outside ASCII go.  ASCII passes as it is."""
    plain = c
    for k, v in SPECIAL.items():
        if len(v) > 1:
            c = F.replace(c, F.lit(k), F.lit(v))
    one = {k: v for k, v in SPECIAL.items() if len(v) == 1}
    source, target = _single_folds()
    c = F.translate(c, "".join(one) + source, "".join(one.values()) + target)
    table = F.from_json(F.lit(json.dumps(_many_folds())), "map<string,string>")
    rare = F.array_join(F.transform(F.split(c, ""), lambda x: F.when(~x.rlike(r"[^\x00-\x7F]"), x).otherwise(F.coalesce(F.try_element_at(table, x), F.lit("")))), "")
    return F.when(~plain.rlike(r"[^\x00-\x7F]"), plain).when(~c.rlike(r"[^\x00-\x7F]"), c).otherwise(rare)


def match_key(c: Column) -> Column:
    """The one name key: punctuation to spaces, folded, lower-case, squeezed; null gives the empty key."""
    spaced = F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}\p{M}\s]", " ")
    return collapse_ws(F.lower(ascii_fold(spaced)))


def compact(key: Column) -> Column:
    return F.regexp_replace(key, "[^a-z0-9]", "")


def tokenset(key: Column) -> Column:
    """The words in order, repeats kept."""
    return F.array_join(F.array_sort(F.split(key, " ")), " ")


# Render words that a slash tag at a name's end may hold.
RENDER_TAGS = ("polished", "honed", "leather", "leathered", "brushed", "mat", "matt", "mate", "matte")


def deprefixed(name: Column) -> Column:
    """Key of a name without the inventory mark that is its first word (Z, ZB, or Z and B), and without one tag at its end.

    A tag is all from the first slash on whose next word is a thickness or a render word; without one, a thickness at the end, else "grade" and the word after it.
    """
    mark = lambda w: F.lower(F.get(w, F.lit(0)))
    given = F.split(collapse_ws(name), " ")
    two = (mark(given) == "z") & (F.lower(F.get(given, F.lit(1))) == "b") & (F.size(given) > 2)
    skip = F.when(two, 2).when(mark(given).isin("z", "zb") & (F.size(given) > 1), 1).otherwise(0)
    parts = F.split(F.array_join(F.slice(given, skip + 1, F.size(given)), " "), "/")

    def tagged(part: Column) -> Column:
        words = F.transform(F.split(F.trim(part), " "), lambda w: F.regexp_substr(F.lower(w), F.lit("^[a-z0-9]+")))
        first, second = F.get(words, F.lit(0)), F.get(words, F.lit(1))
        return F.coalesce(first.isin(*RENDER_TAGS) | first.rlike("^[0-9]+cm$") | (first.rlike("^[0-9]+$") & (second == "cm")), F.lit(False))

    at = F.array_position(F.transform(parts, lambda p, i: (i > 0) & tagged(p)), True).cast("int")
    words = F.split(F.trim(F.array_join(parts, "/")), " ")
    back = lambda k: F.lower(F.get(words, F.size(words) - k))
    gone = F.when(back(1).rlike("^[0-9]+cm$"), 1).when((back(1) == "cm") & back(2).rlike("^[0-9]+$"), 2).when((back(2) == "grade") & back(1).rlike(r"^\w+$"), 2).otherwise(0)
    return match_key(F.when(at > 0, F.array_join(F.slice(parts, F.lit(1), at - 1), "/")).otherwise(F.array_join(F.slice(words, F.lit(1), F.size(words) - gone), " ")))


def slugify(c: Column, sep: str = "-") -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(ascii_fold(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", sep), f"^{sep}+|{sep}+$", "")


def title_case(c: Column) -> Column:
    """First letter of each word upper, the rest lower; connectors lower unless they lead; accents stay."""
    words = F.split(collapse_ws(c), " ")

    def word(w: Column, i: Column) -> Column:
        low = F.lower(w)
        at = F.regexp_instr(low, F.lit(r"\p{L}"))
        up = F.when(at == 0, low).otherwise(F.concat(F.substring(low, F.lit(1), at - 1), F.upper(F.substring(low, at, F.lit(1))), F.substring(low, at + 1, F.char_length(low))))
        return F.when((i > 0) & low.isin(*CONNECTORS), low).otherwise(up)

    return F.array_join(F.transform(words, word), " ")


def bracket_aliases(c: Column) -> Column:
    """What stands in round or square brackets, trimmed, blanks dropped."""
    found = F.regexp_extract_all(c, F.lit(r"[(\[]([^)\]]*)[)\]]"), 1)
    return F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: x != "")


def without_brackets(c: Column) -> Column:
    return collapse_ws(F.regexp_replace(c, r"[(\[][^)\]]*[)\]]", " "))


def first_by_key(items: Column, keys: Column) -> Column:
    """Items whose key occurs for the first time, in order, blank keys dropped."""
    numbered = F.arrays_zip(items.alias("v"), keys.alias("k"))
    return F.transform(
        F.filter(numbered, lambda x, i: (x["k"] != "") & (F.array_position(keys, x["k"]) == i + 1)), lambda x: x["v"]
    )


def looks_codey(c: Column) -> Column:
    """A word that reads like a code: a digit, or no vowel (a, e, i, o, u), bar st, mt and ft; edge punctuation doesn't count."""
    low = F.regexp_replace(F.lower(c), r"^[().\[\]{}\-–—,]+|[().\[\]{}\-–—,]+$", "")
    return (low != "") & (low.rlike(r"\d") | (~low.rlike("[aeiou]") & ~low.isin("st", "mt", "ft")))


@cache
def _entities() -> tuple[dict[str, str], int]:
    """Every named entity, with its semicolon where that is needed, and the length of the longest name that goes without."""
    from html.entities import html5

    return dict(html5), max(len(k) for k in html5 if not k.endswith(";"))


#: What the numbers 128 to 159 stand for on the web, in Windows' Latin alphabet; undefined ones stay control characters.
_WINDOWS = {k: bytes([k]).decode("cp1252", "replace") for k in range(0x80, 0xA0)}


def _unescaped(c: Column) -> Column:
    """Entities by their longest name, also without a semicolon, and by number, as browsers read them."""
    names, longest = _entities()
    table = F.from_json(F.lit(json.dumps(names)), "map<string,string>")  # folded to a constant; one literal instead of thousands
    windows = F.from_json(F.lit(json.dumps({str(k): chr(k) if v == "\ufffd" else v for k, v in _WINDOWS.items()})), "map<string,string>")

    def resolved(part: Column) -> Column:
        told = F.regexp_extract(part, r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)", 1)
        after = lambda k: F.substring(part, k + 1, F.char_length(part))
        digits = F.regexp_replace(F.regexp_replace(told, "^#[xX]?0*|;$", ""), "^$", "0")
        hexed = told.rlike("^#[xX]")
        many = F.char_length(digits) > 9  # beyond any letter
        number = F.when(many, F.lit(0x110000)).when(hexed, F.conv(digits, 16, 10).try_cast("int")).otherwise(digits.try_cast("int"))
        letter = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
        dropped = number.between(1, 8) | number.isin(11) | number.between(14, 31) | (number == 127) | number.between(0xFDD0, 0xFDEF) | ((number % 65536) >= 65534)
        sign = F.when((number == 0) | number.between(0xD800, 0xDFFF) | (number > 0x10FFFF), "\ufffd").when(number == 13, "\r").when(number.between(0x80, 0x9F), F.try_element_at(windows, number.cast("string"))).when(dropped, "").otherwise(letter)
        short = [F.concat(F.try_element_at(table, F.left(told, F.lit(k))), after(F.lit(k))) for k in range(longest, 1, -1)]
        named = F.coalesce(F.concat(F.try_element_at(table, told), after(F.char_length(told))), *short)
        return F.when(told == "", F.concat(F.lit("&"), part)).when(told.startswith("#"), F.concat(sign, after(F.char_length(told)))).otherwise(F.coalesce(named, F.concat(F.lit("&"), part)))

    return F.array_join(F.transform(F.split(c, "&"), lambda x, i: F.when(i == 0, x).otherwise(resolved(x))), "")


def clean(c: Column) -> Column:
    """Entities resolved, no-break spaces plain, zero-width characters gone, trimmed; null gives the empty text."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    c = F.when(c.contains("&"), _unescaped(c)).otherwise(c)
    return F.trim(F.regexp_replace(F.replace(c, F.lit("\u00a0"), F.lit(" ")), "[\u200b\u200c\u200d\u2060\ufeff]", ""))


def split_list(c: Column, sep: str = ",") -> Column:
    import re

    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), re.escape(sep)), lambda x: F.trim(x)), lambda x: x != "")


def na(c: Column) -> Column:
    return F.when(F.upper(F.trim(c)) == "N/A", F.lit("")).otherwise(c)


def build_dims(length: Column, height: Column, unit: str) -> Column:
    """length=..u;height=..u, or the empty text if both are blank."""
    part = lambda name, c: F.when(F.trim(c) != "", F.concat(F.lit(f"{name}="), F.trim(c), F.lit(unit)))
    return F.concat_ws(";", part("length", length), part("height", height))


def strip_words(c: Column, words: list[str]) -> Column:
    """Without the given whole words, whatever their case."""
    import re

    if not words:
        return collapse_ws(c)
    return collapse_ws(F.regexp_replace(c, r"(?iu)\b(" + "|".join(map(re.escape, sorted(words, key=len, reverse=True))) + r")\b", " "))


def safe_cell(c: Column) -> Column:
    """A leading apostrophe before text that a spreadsheet would run as a formula."""
    return F.when(c.rlike("^[=+\\-@\t\r]") | c.rlike(r"^\s*[=+\-@]"), F.concat(F.lit("'"), c)).otherwise(c)


def human_join(items: Column) -> Column:
    """A; A and B; A, B, and C."""
    n = F.size(items)
    head = F.array_join(F.slice(items, 1, F.greatest(F.lit(1), n - 1)), ", ")
    return F.when(n == 0, "").when(n == 1, F.get(items, F.lit(0))).when(n == 2, F.array_join(items, " and ")).otherwise(F.concat(head, F.lit(", and "), F.element_at(items, -1)))


def image_stem(c: Column) -> Column:
    """Folded file stem without render marks, unique ids and crop tails."""
    name = F.regexp_replace(F.regexp_replace(c, r"^.*/", ""), r"\.[A-Za-z0-9]+$", "")
    low = F.regexp_replace(F.lower(ascii_fold(name)), r"_rb_\d+_?", "_")
    low = F.regexp_replace(low, r"[0-9a-f]{8}-([0-9a-f]{4}-){3}[0-9a-f]{12}", "")
    return F.regexp_replace(F.regexp_replace(low, r"[-_ ]*(crop|cropped)\d*$", ""), r"[^a-z0-9]+", "")


def value_shape(c: Column) -> Column:
    """numeric, url, pipe, long, or len and the length in tens."""
    t = F.trim(c)
    return (
        F.when(t.rlike(r"^-?[\d.,]+$"), "numeric").when(t.rlike("(?i)^https?://"), "url").when(t.contains("|"), "pipe")
        .when(F.char_length(t) > 80, "long").otherwise(F.concat(F.lit("len"), F.floor(F.char_length(t) / 10).cast("string"), F.lit("0")))
    )


def type_slug(key: Column, slugs: list[str]) -> Column:
    """Longest known type that the part after the branch is or starts with; else its first word."""
    rest = F.regexp_replace(key, "^[^_]+_", "")
    out = F.get(F.split(key, "_"), F.lit(1))
    for s in sorted(slugs, key=len):
        out = F.when((rest == s) | rest.startswith(f"{s}_"), F.lit(s)).otherwise(out)
    return out
