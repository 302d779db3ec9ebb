"""Writers: parquet checkpoints, guarded CSV files, payload lists."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import numbers as N
from ..functions import text as T
from ..operators import commits


def write_canonical(rows: DataFrame, path: str) -> int:
    """Writes the rows beside what is there and then publishes them, so that a lost driver leaves the rows before; the commit's number."""
    return commits.publish(rows.sparkSession, path, {"canonical": commits.write_version(rows, path, "canonical")})


def cell(c: Column, kind: str) -> Column:
    """Numbers without exponents, booleans lower-case, blanks for nulls, text guarded against formulas."""
    if kind in ("double", "float") or kind.startswith("decimal"):
        out = N.plain_number(c)
    elif kind == "string":
        out = T.safe_cell(c)
    else:
        out = c.cast("string")
    return F.coalesce(out, F.lit(""))


def template(rows: DataFrame, columns: list[str], mapping: dict[str, Column]) -> DataFrame:
    """The template's columns in its order; unmapped ones are blank."""
    out = rows.select("*", *(e.alias(f"_c{i}") for i, (_, e) in enumerate(mapping.items())))
    kinds = dict(out.dtypes)
    place = {name: f"_c{i}" for i, name in enumerate(mapping)}
    return out.select(*((cell(F.col(place[c]), kinds[place[c]]) if c in place else F.lit("")).alias(c) for c in columns))


# The import file's columns in order; the product images stand between the block's sides and the variant's title.
_HEAD = ("Product Handle", "Product Title", "Product Status", "Product Description", "Product Weight", "Product Length", "Product Width", "Product Height", "Product Discountable", "Product Thumbnail",
         "Product Category 1", "Product Sales Channel 1", "Front Image", "Right Image", "Back Image", "Left Image")
_TAIL = ("Variant Title", "Variant Sku", "Variant Manage Inventory", "Variant Allow Backorder", "Variant Option 1 Name", "Variant Option 1 Value", "Variant Inventory Quantity", "STN Origin Country Code",
         "STN Origin City", "STN Origin County", "STN Color Id", "STN Finish Id", "STN Quality Id", "STN Variation Id", "STN Type Id", "STN Type Name", "STN Company Id", "STN Port Ids", "STN Visibility",
         "STN Slug", "STN Popular", "STN Sold In Bundle", "STN Bundle Size", "STN Specification File Ids")
IMPORT_COLUMNS = (*_HEAD, *(f"Product Image {i + 1}" for i in range(C.PRODUCT_SLOTS)), *_TAIL)
# What every row of the import file says.
CONSTANTS = {"Product Status": "published", "Variant Title": "Default", "Variant Manage Inventory": "true", "Variant Allow Backorder": "false", "Variant Option 1 Name": "Default option", "Variant Option 1 Value": "Default option value", "STN Popular": "false"}


def import_mapping(constants: dict[str, str] | None = None) -> dict[str, Column]:
    """The import file's cells from canonical rows; what isn't mapped stays blank."""
    plain = {
        "Product Handle": "handle", "Product Title": "title", "Product Description": "description", "Product Weight": "weight", "Product Length": "length", "Product Width": "width", "Product Height": "height",
        "Product Discountable": "discountable", "Product Thumbnail": "thumbnail_key", "Product Category 1": "category_id", "Product Sales Channel 1": "sales_channel_id", "Variant Sku": "sku",
        "Variant Inventory Quantity": "inventory", "STN Origin Country Code": "origin", "STN Origin City": "origin_city", "STN Origin County": "origin_county", "STN Color Id": "color_id",
        "STN Finish Id": "finish_id", "STN Quality Id": "quality_id", "STN Variation Id": "variation_id", "STN Type Id": "type_id", "STN Type Name": "type_name", "STN Company Id": "company_id",
        "STN Visibility": "visibility", "STN Slug": "slug", "STN Sold In Bundle": "sold_in_bundle", "STN Bundle Size": "bundle_size",
    }
    sides = {n: F.get("oriented_images", F.lit(i)) for i, n in enumerate(_HEAD[12:])}
    images = {f"Product Image {i + 1}": F.get("product_images", F.lit(i)) for i in range(C.PRODUCT_SLOTS)}
    fixed = {k: F.lit(v) for k, v in (CONSTANTS | (constants or {})).items()}
    return {k: F.col(v) for k, v in plain.items()} | sides | images | fixed | {"STN Port Ids": F.array_join(F.coalesce("port_ids", F.array().cast("array<string>")), "|")}


def with_constants(rows: DataFrame, company: str, channel: str, visibility: str = "public", discountable: str = "true") -> DataFrame:
    return rows.withColumns({"company_id": F.lit(company), "sales_channel_id": F.lit(channel), "visibility": F.lit(visibility), "discountable": F.lit(discountable)})


def import_rows(rows: DataFrame) -> DataFrame:
    """Canonical rows as the import file's 55 text columns."""
    return template(rows, list(IMPORT_COLUMNS), import_mapping())


def render_products(products: DataFrame, varieties: DataFrame, lookup: DataFrame) -> DataFrame:
    """Ledger products as canonical rows: ids by name of type, colour, finish, quality, and the variety's present id by its key.

    lookup (category, norm, id); a name that it lacks stays blank.
    """
    out = products.join(varieties.groupBy("key").agg(F.max("remote_id").alias("variation_id")).withColumnRenamed("key", "variation_key"), "variation_key", "left")
    for f in C.ATTRIBUTES:
        known = lookup.where(F.col("category") == f).groupBy("norm").agg(F.min("id").alias(f"{f}_id"))
        out = out.join(known.withColumnRenamed("norm", "_n"), T.match_key(F.col(f"{f}_name")) == F.col("_n"), "left").drop("_n")
    return out


def write_sorted(rows: DataFrame, path: str) -> None:
    """A set in the order of all its columns, the same whatever the partitions."""
    write_csv(rows.distinct().orderBy(*rows.columns), path)


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, header=True, quoteAll=False, escape='"', emptyValue="")


def review_rows(rows: DataFrame) -> DataFrame:
    """A row for each review flag."""
    return rows.select("src_site", "surrogate_key", F.explode("review_flags").alias("f")).select("src_site", "surrogate_key", "f.*")


def reject_rows(rows: DataFrame) -> DataFrame:
    return rows.select("src_site", "surrogate_key", F.explode("reject_reasons").alias("r")).select("src_site", "surrogate_key", "r.*")


def inventory_delta(existing: DataFrame, discontinued: DataFrame) -> DataFrame:
    """Changed known rows, and discontinued ones at nothing."""
    changed = existing.where("product_changed").select("sku", F.col("inventory_quantity").cast("int").alias("qty"))
    return changed.unionByName(discontinued.select("sku", F.lit(0).alias("qty")))


def payloads(rows: DataFrame) -> DataFrame:
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("payload"))


def image_slots(keys: Column, slots: int, prefix: str = "Product Image ") -> list[Column]:
    return [F.get(keys, F.lit(i)).alias(f"{prefix}{i + 1}") for i in range(slots)]
