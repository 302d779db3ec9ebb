"""Contracts of the stages, their status, and checks of keys, types and categories."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions import text as T
from . import health


def _filled(*columns: str) -> Column:
    return F.concat_ws("", *(F.trim(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in columns)) != ""


def ingest_contract(image_urls: str = "raw_image_urls") -> list[tuple[str, str, Column]]:
    """What a scrape's rows should have, soft: a name, a source of dimensions, an image."""
    return [
        ("ingest_missing_variety_name", "SOFT", _filled("raw_name", "variety_match_key")),
        ("ingest_missing_dimensions_source", "SOFT", _filled("raw_dimensions", "raw_thickness", "raw_total_m2", "raw_per_slab_m2")),
        ("ingest_missing_image_source", "SOFT", F.coalesce(F.size(image_urls), F.lit(0)) > 0),
    ]


def clean_contract(rows: DataFrame, vocabulary: DataFrame, gaps: str = "tree_gaps") -> DataFrame:
    """Gate rows of canonical spelling for each attribute, and of rows without gaps; a name that the vocabulary doesn't know isn't miscased."""
    out = rows
    for f in C.ATTRIBUTES:
        known = vocabulary.where(F.col("category") == f).groupBy("norm").agg(F.min("canonical").alias(f"_c_{f}"))
        out = out.join(known.withColumnRenamed("norm", f"_n_{f}"), T.match_key(F.col(f"{f}_name")) == F.col(f"_n_{f}"), "left")
    cased = [(f"clean_noncanonical_{f}_name", "SOFT", F.col(f"_c_{f}").isNull() | F.col(f"{f}_name").isNull() | (F.col(f"_c_{f}") == F.col(f"{f}_name"))) for f in C.ATTRIBUTES]
    return health.gate(out, [*cased, ("clean_unresolved_tree_gap", "SOFT", F.coalesce(F.size(gaps), F.lit(0)) <= 0)])


def process_contract() -> list[tuple[str, str, Column]]:
    return [("process_origin_missing", "SOFT", _filled("origin_country_code"))]


def stage_status(rows: DataFrame, stages: dict[str, Column]) -> DataFrame:
    """(stage, rows, hits, status): a stage whose share of bad rows reaches its threshold is degraded; no rows are fine."""
    one = rows.agg(F.count("*").alias("n"), *(F.count_if(F.coalesce(bad, F.lit(False))).alias(f"_{k}") for k, bad in stages.items()))
    cells = F.array(*(F.struct(F.lit(k).alias("stage"), F.col("n").alias("rows"), F.col(f"_{k}").alias("hits"), F.lit(C.STAGE_DEGRADED[k]).alias("limit")) for k in stages))
    out = one.select(F.explode(cells).alias("x")).select("x.*")
    return out.select("stage", "rows", "hits", F.when((F.col("rows") > 0) & (F.col("hits") / F.greatest("rows", F.lit(1)) >= F.col("limit")), "DEGRADED").otherwise("OK").alias("status"))


def provenance_gaps(rows: DataFrame, derived: list[tuple[str, str]]) -> DataFrame:
    """(field, gaps): derived values (value column, method column) without a method."""
    one = rows.agg(*(F.count_if(F.col(v).isNotNull() & (F.coalesce(F.col(m), F.lit("")) == "")).alias(v) for v, m in derived))
    return one.select(F.explode(F.array(*(F.struct(F.lit(v).alias("field"), F.col(v).alias("gaps")) for v, _ in derived))).alias("x")).select("x.*")


def mistyped(name_type: Column, key_type: Column) -> Column:
    """The type word of a name shares no word with the key's type; false where either says nothing."""
    a, b = F.split(T.match_key(name_type), " "), F.split(T.match_key(key_type), " ")
    return (T.match_key(name_type) != "") & (T.match_key(key_type) != "") & ~F.arrays_overlap(a, b)


def typing_health(variations: DataFrame) -> DataFrame:
    """One row: varieties, synced ones, those without a type, and served ones without a type."""
    typed = F.trim(F.coalesce("type", F.lit(""))) != ""
    return variations.agg(
        F.count("*").alias("varieties"), F.count_if(F.col("state") == "synced").alias("synced"), F.count_if(~typed).alias("untyped"),
        F.count_if(~typed & (F.col("state") == "synced")).alias("untyped_synced"),
    )


def non_uniform_categories(rows: DataFrame, category: str, key: str) -> DataFrame:
    """(category, keys, every): categories that lack keys which another has."""
    per = rows.groupBy(category).agg(F.count_distinct(key).alias("keys"))
    every = rows.select(key).distinct().agg(F.count("*").alias("every"))
    return per.join(F.broadcast(every), F.col("keys") < F.col("every"))  # one row


def duplicate_source_codes(sources: DataFrame) -> DataFrame:
    return sources.groupBy(F.lower("source_code").alias("code")).agg(F.count("*").alias("n")).where("n > 1")
