"""Content-addressed WARC archive.

Payload bytes are stored once under their SHA-1 and SHA-256; record headers are
stored exactly, apart from them, with the payload's digest.  Reading verifies each
stored payload once against both digests and rebuilds records by joining headers
to payloads.  Of records with equal payloads the one with the smallest id is the
response, the others are revisits that refer to it; payloads of fewer than
`smallest` bytes are always responses.

Null payloads count as empty ones and null addresses as empty headers.  Rows that
repeat an id and a payload are records of their own; the first of them by address is the
response.  Records with a null id come after all others.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import shared_path

SMALLEST, CRLF = 0, "\r\n"


def base32(hexed: Column) -> Column:
    """RFC 4648 base32, upper case, of 40 hex digits: four letters for each five digits."""
    four = lambda i: F.lpad(F.conv(F.substring(hexed, 5 * i + 1, 5), 16, 32), 4, "0")
    return F.translate(F.concat(*(four(i) for i in range(8))), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def records(pages: DataFrame, smallest: int = SMALLEST, id_column: str = "page_id", url: str = "url", payload: str = "html") -> tuple[DataFrame, DataFrame]:
    """(headers, payloads): headers (page_id, sha1, header), payloads (sha1, sha256, payload)."""
    rows = pages.select(F.col(id_column).alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"), F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary").alias("payload"))
    known = rows.select("page_id", "url", F.sha1("payload").alias("sha1"), F.sha2("payload", 256).alias("sha256"), F.octet_length("payload").cast("long").alias("bytes"))
    place = F.struct(F.col("page_id").isNull().alias("z"), "page_id", "url")
    firsts = known.groupBy("sha1", "sha256").agg(F.min(place).alias("first"))
    joined = known.join(firsts.withColumnRenamed("sha1", "s1").withColumnRenamed("sha256", "s2"), (F.col("sha1") == F.col("s1")) & (F.col("sha256") == F.col("s2")))
    own = (place == F.col("first")) | (F.col("bytes") < smallest)
    kind = F.when(own, "response").otherwise("revisit")
    clean = F.regexp_replace("url", r"[\r\n]+", "")
    name = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    header = F.concat_ws(
        CRLF,
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), name(F.col("page_id"))),
        F.concat(F.lit("WARC-Target-URI: "), clean),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), base32(F.col("sha1"))),
        F.when(~own, F.concat(F.lit("WARC-Refers-To: "), name(F.col("first.page_id")))),
        F.when(~own, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.concat(F.lit("Content-Length: "), F.when(own, F.col("bytes")).otherwise(0).cast("string")),
    )
    headers = joined.select("page_id", "sha1", F.concat(header, F.lit(CRLF + CRLF)).alias("header"))
    stored = firsts.select(F.col("sha1").alias("s1"), F.col("sha256").alias("s2"), F.col("first.page_id").alias("id1"), F.col("first.url").alias("url1"))
    found = rows.withColumn("sha1", F.sha1("payload")).withColumn("sha256", F.sha2("payload", 256))
    same = (F.col("page_id").eqNullSafe(F.col("id1"))) & (F.col("sha1") == F.col("s1")) & (F.col("url") == F.col("url1")) & (F.col("sha256") == F.col("s2"))
    return headers, found.join(stored, same, "left_semi").select("sha1", "sha256", "payload")


def write(pages: DataFrame, path: str, **options) -> None:
    """Writes the archive under the path: headers and payloads."""
    headers, payloads = records(pages, **options)
    headers.write.parquet(f"{path}/headers")
    payloads.write.parquet(f"{path}/payloads")


def read(spark, path: str) -> DataFrame:
    """Every record (page_id, header, payload, payload_bytes, payload_digest), rebuilt; a payload that fails its digests raises."""
    stored = spark.read.parquet(f"{path}/payloads")
    sound = (F.sha1("payload") == F.col("sha1")) & (F.sha2("payload", 256) == F.col("sha256"))
    checked = stored.select(
        F.col("sha1").alias("s1"),
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        F.when(sound, base32(F.sha1("payload"))).otherwise(F.raise_error(F.concat(F.lit("payload differs from its digest: "), F.col("sha1")))).alias("payload_digest"),
    ).dropDuplicates(["s1"])
    return spark.read.parquet(f"{path}/headers").join(checked, F.col("sha1") == F.col("s1")).select("page_id", "header", "payload", "payload_bytes", "payload_digest")


def field(name: str) -> Column:
    """A header field's value, null where the record has none."""
    return F.nullif(F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))


def op9_warc(spark, sf_dir: str) -> DataFrame:
    """Every page's record, read back from an archive of all pages."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    path = shared_path(spark, "warc")
    write(pages, path)
    back = read(spark, path)
    target = F.regexp_extract(field("WARC-Refers-To"), r"<urn:page:(-?\d+)>", 1)
    return back.select("page_id", "payload_bytes", "payload_digest", field("WARC-Type").alias("record_type"), F.nullif(target, F.lit("")).cast(pages.schema["page_id"].dataType).alias("refers_to"))


ORACLE_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages), h AS (SELECT page_id, html, sha1(html) AS h, min(page_id) OVER (PARTITION BY html) AS first FROM p)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT) + 1, 1)), '') AS payload_digest,
CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM h
"""
