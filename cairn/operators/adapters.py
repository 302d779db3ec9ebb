"""Declarative source adapters: canonical columns as expressions over a scrape's columns."""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import names as N_
from ..functions import numbers as N
from ..functions import text as T


@dataclass(frozen=True)
class Adapter:
    source: str
    fields: dict[str, str | Callable[[], Column]]
    required: tuple[str, ...] = ("src_natural_key", "raw_name")
    version: str = "1.0.0"
    columns: tuple[str, ...] = field(default=())

    def adapt(self, scrape: DataFrame) -> DataFrame:
        """Canonical rows; one that lacks a required value drops out alone."""
        have = set(scrape.columns)
        source = lambda c: T.clean(F.col(c)) if c in have else F.lit("")
        out = scrape.select(F.lit(self.source).alias("src_site"), F.lit(self.version).alias("adapter_version"), *((source(e) if isinstance(e, str) else e()).alias(k) for k, e in self.fields.items()))
        return out.where(" and ".join(f"trim(coalesce({c}, '')) <> ''" for c in self.required))

    def missing(self, scrape: DataFrame) -> list[str]:
        return [c for c in self.columns if c not in scrape.columns]


def loss_allowed(rows: int, adapted: int) -> bool:
    return rows == 0 or rows - adapted <= C.ADAPT_LOSS_CAP * rows


def smoke(adapter: Adapter, scrape: DataFrame) -> str:
    """FAILED if hardly any of the first 50 rows comes through; the limit is the check."""
    first = scrape.limit(50)
    n, ok = first.count(), adapter.adapt(first).count()
    return "FAILED" if n and ok <= max(1, n * 0.1) else "OK"


def _same(**names: str) -> dict:
    return names


def listing_map() -> dict:
    """A source that names its varieties: one row a bundle, metres, images joined by bars, a type with a trailing slash."""
    return _same(
        src_natural_key="product_id", src_url="detail_url", scrape_timestamp="scrape_timestamp", raw_name="material", variety_match_key="material", raw_color="color", raw_finish="finish",
        raw_quality="quality", raw_format="format", raw_origin="origin", raw_thickness="thickness", raw_weight="weight", raw_total_m2="area_sqmt", raw_slab_count="slab_count", raw_slabs_array="slabs_detail",
    ) | {
        "raw_type": lambda: without_trailing(F.col("stone_type"), "/"), "raw_dimensions": lambda: T.build_dims(F.col("dimension_length"), F.col("dimension_height"), "m"),
        "raw_image_urls": lambda: T.split_list(F.col("image_urls"), "|"), "raw_description": lambda: F.lit(""),
    }


def without_trailing(c: Column, token: str) -> Column:
    """Cleaned, without one trailing token."""
    import re

    return F.trim(F.regexp_replace(T.clean(c), rf"\s*{re.escape(token)}\s*$", ""))


def without_format(c: Column) -> Column:
    """A name without format words, singular or plural."""
    return T.strip_words(T.clean(c), [w for k in C.CATEGORIES for w in (k, f"{k}s")])


def descriptor_map(images: list[str]) -> dict:
    """A source of generic descriptors: the variety is the name without its format word, centimetres without a unit, N/A for nothing."""
    pictures = F.coalesce(*(F.when(F.trim(c) != "", F.col(c)) for c in images), F.lit(""))
    return _same(
        src_natural_key="sku", src_url="permalink", scrape_timestamp="scrape_timestamp", raw_name="name", raw_type="attr_category1", raw_color="attr_category2", raw_finish="attr_finish",
        raw_quality="attr_quality", raw_format="attr_format", raw_stock_m2="ready_stock_sqm",
    ) | {
        "variety_match_key": lambda: without_format(F.col("name")), "raw_thickness": lambda: T.na(F.col("dimensions_width")), "raw_weight": lambda: T.na(F.col("weight")),
        "raw_dimensions": lambda: T.build_dims(T.na(F.col("dimensions_length")), T.na(F.col("dimensions_height")), ""),
        "raw_description": lambda: F.coalesce(F.when(T.clean(F.col("description")) != "", T.clean(F.col("description"))), T.clean(F.col("short_description"))),
        "raw_image_urls": lambda: T.split_list(pictures, "|"),
    }


def mixed_type(c: Column, types: dict[str, str]) -> Column:
    """The head before a slash, if it names a known type (key to canonical); a tag gives the empty text."""
    table = F.create_map(*(F.lit(x) for kv in types.items() for x in kv))
    return F.coalesce(F.try_element_at(table, T.match_key(T.clean(F.get(F.split(F.coalesce(c, F.lit("")), "/"), F.lit(0))))), F.lit(""))


def composed_map(types: dict[str, str], colours: dict[str, str]) -> dict:
    """A source whose composition is a type or a tag, and whose colour stands in the name; the wide side is the length."""
    first = lambda c: F.coalesce(F.get(T.split_list(F.col(c), "|"), F.lit(0)), F.lit(""))
    return _same(
        src_natural_key="bundle_id", src_url="detail_url", scrape_timestamp="scrape_timestamp", raw_name="material_name", variety_match_key="material_name", raw_finish="finish", raw_quality="quality",
        raw_format="format", raw_thickness="thickness", raw_total_m2="total_sqmt", raw_slab_count="slab_count", raw_origin="country_code", raw_description="description",
    ) | {
        "raw_type": lambda: mixed_type(F.col("composition"), types), "raw_color": lambda: F.coalesce(F.when(T.clean(F.col("color")) != "", T.clean(F.col("color"))), N_.extract_word(F.col("material_name"), colours), F.lit("")),
        "raw_dimensions": lambda: T.build_dims(first("slab_widths_m"), first("slab_heights_m"), "m"), "raw_image_urls": lambda: T.split_list(F.col("photo_urls"), "|"),
    }


def bundle_map(colours: dict[str, str]) -> dict:
    """A source of bundles: the colour from the local name, the English name or the description, without the mark of half-precious stones; weight a piece."""
    bare = lambda c: F.regexp_replace(T.clean(F.col(c)), r"(?i)\bsemi[\s-]*prec\w*\b", " ")
    return _same(
        src_natural_key="bundle_id", src_url="detail_url", scrape_timestamp="scrape_timestamp", raw_name="product_name_en", variety_match_key="product_name_en", raw_type="family", raw_finish="finish",
        raw_quality="classification", raw_format="format", raw_thickness="thickness", raw_total_m2="area_m2", raw_slab_count="slab_count", raw_description="description",
    ) | {
        "raw_color": lambda: F.coalesce(*(N_.extract_word(bare(c), colours) for c in ("product_name_pt", "product_name_en", "description")), F.lit("")),
        "raw_dimensions": lambda: T.build_dims(F.col("length_m"), F.col("height_m"), "m"), "raw_weight": lambda: per_piece_weight(F.col("weight_kg_net"), F.col("slab_count")),
        "raw_image_urls": lambda: T.split_list(F.col("image_urls"), "|"),
    }


def per_piece_weight(net: Column, count: Column) -> Column:
    """A bundle's net weight over its slabs; blank where either is missing."""
    each = F.try_divide(N.parse_number(net), N.parse_number(count))
    return F.coalesce(F.when(each > 0, F.round(each, 3).cast("string")), F.lit(""))


# ---- fields of slab back ends ---------------------------------------------------------------------------------------


def thickness_format(thickness: Column) -> Column:
    """block for the sentinel of several thicknesses, slab for any other, empty where there is none: the name is never asked."""
    t = F.upper(F.trim(F.coalesce(thickness, F.lit(""))))
    return F.when(t == "", "").when(t == "MULTI", "block").otherwise("slab")


def shown_price(price: Column) -> Column:
    """The price, or empty where a link or an invitation to log in stands instead."""
    p = F.coalesce(price, F.lit(""))
    return F.when(p.rlike(r"(?i)<\s*a\s") | p.rlike(r"(?i)login\s*for\s*price"), "").otherwise(p)


def badge(html: Column) -> Column:
    """recommended or new by the class of a badge that is displayed, else empty."""
    classes = F.lower(F.regexp_extract(html, r"(?i)class='([^']+)'", 1))
    shown = F.contains(F.lower(html), F.lit("display: block"))
    return F.when(shown & F.contains(classes, F.lit("recommended-product")), "recommended").when(shown & F.contains(classes, F.lit("new-product")), "new").otherwise("")


def joined(items: Column, field_: str) -> Column:
    """One field of all pieces, joined by bars; a missing one leaves its place empty."""
    return F.array_join(F.transform(F.coalesce(items, F.array()), lambda x: F.coalesce(x[field_].cast("string"), F.lit(""))), " | ")


def photo_urls(paths: Column, base: str) -> Column:
    """Absolute addresses of photo paths; empty ones drop out."""
    some = F.filter(F.coalesce(paths, F.array().cast("array<string>")), lambda p: p.isNotNull() & (p != ""))
    return F.transform(some, lambda p: F.when(p.startswith("http"), p).when(p.startswith("/"), F.concat(F.lit(base), p)).otherwise(F.concat(F.lit(base + "/"), p)))
