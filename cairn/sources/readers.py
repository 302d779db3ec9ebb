"""Readers: all-string scrapes, reference tables, run folders."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as T
from ..operators import commits


def read_scrape(spark: SparkSession, path: str) -> DataFrame:
    """Every column a string, no inference, the byte-order mark off the first header, `_ordinal` in file order."""
    raw = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"')
    raw = raw.toDF(*(c.lstrip("﻿").strip() for c in raw.columns))
    return raw.withColumn("_ordinal", F.monotonically_increasing_id())


def read_scrape_split(spark: SparkSession, path: str) -> DataFrame:
    """What `read_scrape` gives of one file, read in as many splits as Spark makes of it: every column a string, `_ordinal` from 0 in file order.

    A line belongs to the record before it if an odd number of quotes stands before it.  Each split's quotes and record starts are counted
    first; what earlier splits leave, a row for each, is carried over, and then each split's lines find their records by themselves.
    Line ends inside quotes become plain newlines.
    """
    # The header is the first line: no column's name holds a newline.
    columns = [c.lstrip("\ufeff").strip() for c in spark.read.csv(path, header=True, inferSchema=False, escape='"').columns]
    lines = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    own = Window.partitionBy("block").orderBy("at")
    marked = lines.withColumn("q", quotes).withColumn("seen", F.sum("q").over(own) - F.col("q"))  # quotes of the split before the line
    # Of a split that begins outside quotes the lines with an even count before them start a record, of one that begins inside the others do.
    sums = marked.groupBy("block").agg(F.sum("q").alias("q"), F.count_if(F.col("seen") % 2 == 0).alias("even"), F.count_if(F.col("seen") % 2 == 1).alias("odd"))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    carried = sums.withColumn("inside", F.coalesce(F.sum("q").over(before), F.lit(0)) % 2)
    carried = carried.withColumn("starts", F.when(F.col("inside") == 0, F.col("even")).otherwise(F.col("odd")))
    carried = carried.withColumn("first", F.coalesce(F.sum("starts").over(before), F.lit(0))).select("block", "inside", "first")
    placed = marked.join(F.broadcast(carried), "block").withColumn("start", ((F.col("seen") + F.col("inside")) % 2 == 0).cast("int"))
    numbered = placed.withColumn("record", F.col("first") + F.sum("start").over(own) - 1)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), "\n")
    records = numbered.groupBy("record").agg(text.alias("t")).where("record > 0")
    schema = ", ".join(f"_c{i} string" for i in range(len(columns)))
    parsed = records.where("t <> ''").select((F.col("record") - 1).alias("_ordinal"), F.from_csv("t", F.lit(schema), {"escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"}).alias("r"))
    return parsed.select(*(F.col(f"r._c{i}").alias(c) for i, c in enumerate(columns)), "_ordinal")


def latest_per_source(runs: DataFrame, source: str = "source", at: str = "run_id", usable: Column | None = None) -> DataFrame:
    """The newest usable run of each source; a newer unusable one never supersedes it."""
    rows = runs if usable is None else runs.where(F.coalesce(usable, F.lit(True)))
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(source).orderBy(F.desc(at)))).where("_n = 1").drop("_n")


def last_wins(rows: DataFrame, keys: list[str], ordinal: str) -> DataFrame:
    """One row for each key: the last read."""
    w = Window.partitionBy(*keys).orderBy(F.desc(ordinal))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def vocabulary(rows: DataFrame) -> DataFrame:
    """(category, norm, canonical, id) from rows (category, value, sourceid); rows with a blank go."""
    full = rows.where(" and ".join(f"trim(coalesce({c}, '')) <> ''" for c in ("category", "value", "sourceid")))
    at = F.col("_ordinal") if "_ordinal" in rows.columns else F.struct("value", "sourceid")
    one = full.groupBy("category", T.match_key(F.col("value")).alias("norm")).agg(F.max_by(F.struct("value", "sourceid"), at).alias("x"))  # the last of a key counts
    return one.select("category", "norm", F.col("x.value").alias("canonical"), F.col("x.sourceid").alias("id"))


def last_of(rows: DataFrame, keys: list[str], values: list[str], ordinal: str = "_ordinal") -> DataFrame:
    """Reference rows by key, the last of each; rows with a blank key or value go."""
    full = rows.where(" and ".join(f"trim(coalesce({c}, '')) <> ''" for c in (*keys, *values)))
    return full.groupBy(*keys).agg(F.max_by(F.struct(*values), ordinal).alias("x")).select(*keys, "x.*")


def canonical(spark: SparkSession, path: str) -> DataFrame:
    """Canonical rows as last published, or of a plain folder; lists are arrays, not text."""
    return commits.current(spark, path, "canonical") if commits.head(spark, path)[0] else spark.read.parquet(path)


def from_source(adapter, load, spark: SparkSession):
    """Rows of a source that gives a frame instead of a file: (rows, label), or None where it has nothing, which is a clean skip."""
    got = load(spark)
    if got is None:
        return None
    frame, label = got
    return adapter.adapt(frame), label


def backbone(spark: SparkSession, path: str) -> DataFrame:
    """Posts of a list or of {posts: [...]}, aliases split at commas."""
    raw = spark.read.json(path, multiLine=True)
    posts = raw.select(F.explode("posts").alias("p")).select("p.*") if "posts" in raw.columns else raw
    return posts.withColumn("aliases", F.flatten(F.transform("aliases", lambda a: T.split_list(a)))) if "aliases" in posts.columns else posts


def pivot_overrides(rows: DataFrame, fields: list[str]) -> DataFrame:
    """(src_site, surrogate_key, field, value) to one row for each key; the last of a field counts, by `_ordinal` where rows have one."""
    at = F.col("_ordinal") if "_ordinal" in rows.columns else F.col("value")
    return rows.groupBy("src_site", "surrogate_key").agg(*(F.max_by(F.when(F.col("field") == f, F.col("value")), F.when(F.col("field") == f, at)).alias(f) for f in fields))


def by_alternates(frame: DataFrame, wanted: dict[str, list[str]]) -> DataFrame:
    """Columns under their wanted names, found by any alternate, whatever its case."""
    have = {c.strip().lower(): c for c in frame.columns}
    pick = lambda names: F.coalesce(*(F.col(f"`{have[n.lower()]}`") for n in names if n.lower() in have), F.lit(None).cast("string"))
    return frame.select(*(pick(names).alias(to) for to, names in wanted.items()))


def attribute_table(html: Column) -> Column:
    """Map of lower-case label to value from `<th>label</th><td>value</td>` rows; the first of a label counts."""
    cell = r"(?is)<th[^>]*>(.*?)</th>\s*<td[^>]*>(.*?)</td>"
    plain = lambda x: T.collapse_ws(F.regexp_replace(x, "<[^>]*>", " "))
    labels = F.transform(F.regexp_extract_all(html, F.lit(cell), 1), lambda x: F.lower(plain(x)))
    values = F.transform(F.regexp_extract_all(html, F.lit(cell), 2), plain)
    pairs = F.arrays_zip(labels.alias("k"), values.alias("v"))
    firsts = F.filter(pairs, lambda p, i: F.array_position(labels, p["k"]) == i + 1)
    return F.map_from_entries(firsts)
