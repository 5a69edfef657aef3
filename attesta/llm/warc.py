"""Content-addressed WARC archive.

An archive is two tables. ``payloads`` holds every distinct payload once, under its SHA-256. ``records`` holds one row
per record with its exact header block and the digest of its payload. A record's original bytes are the header block,
the payload found by a join on the digest, and the two line ends that close a record. Payload bytes never travel
more than once when an archive is written: duplicates are found on digests alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.llm.common import query, table
from attesta.session import checkpoint_folder

LEAST_REVISIT = 100
EPOCH = "2024-01-01T00:00:00Z"


def _record_id(key: Column) -> Column:
    """A stable record id made from the key."""
    h = F.md5(F.concat(F.lit("record:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.concat(F.lit("<urn:uuid:"), F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-"), F.substring(h, 13, 4), F.lit("-"), F.substring(h, 17, 4), F.lit("-"), F.substring(h, 21, 12), F.lit(">"))


def _header(key: Column, url: Column) -> Column:
    """The exact header block of a record, up to and with the empty line."""
    revisit = F.col("record_type") == "revisit"
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.col("record_type")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(key)),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.coalesce(url.cast("string"), F.lit("")), r"[\r\n]", "")),
        F.lit(f"WARC-Date: {EPOCH}"),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("payload_digest")),
        F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")))),
        F.lit("Content-Type: application/octet-stream"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string")),
    ]
    return F.concat(F.concat_ws("\r\n", *lines), F.lit("\r\n\r\n"))


def write_archive(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", body: str = "html", least: int = LEAST_REVISIT) -> None:
    """Write ``payloads`` and ``records`` under ``folder``.

    A null body is empty. Of the records with equal payloads of at least ``least`` bytes, the one with the smallest key is
    a response and the others revisit it; smaller payloads are all responses and are still stored once. A null key
    comes after all others. Repeated rows are records of their own: rows that repeat a response's key are responses too,
    as they are the same record twice. Only the three named columns are read.
    """
    payload = F.encode(F.coalesce(F.col(body), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).alias("key"), F.col(url).cast("string").alias("url"), payload.alias("payload"))
    digested = rows.withColumn("payload_digest", F.sha2("payload", 256)).withColumn("payload_bytes", F.length("payload").cast("long"))
    facts = digested.select("key", "url", "payload_digest", "payload_bytes")
    facts.write.parquet(f"{folder}/facts")
    facts = pages.sparkSession.read.parquet(f"{folder}/facts")
    # min() skips nulls, so a key-less record is the first only where no other has a key.
    firsts = facts.groupBy("payload_digest").agg(F.min("key").alias("first_key"))
    # One row's bytes per digest: only that row's payload is shuffled.
    keep = firsts.select(F.col("payload_digest").alias("_digest"), F.col("first_key"))
    unique = digested.join(keep, (F.col("payload_digest") == F.col("_digest")) & F.col("key").eqNullSafe(F.col("first_key")), "left_semi")
    unique = unique.dropDuplicates(["payload_digest"]) if _repeats(facts) else unique
    unique.select("payload_digest", "payload_bytes", "payload").write.option("compression", "zstd").parquet(f"{folder}/payloads")
    kinds = facts.join(firsts, "payload_digest")
    later = (F.col("payload_bytes") >= least) & ~F.col("key").eqNullSafe(F.col("first_key"))
    records = kinds.withColumn("record_type", F.when(later, "revisit").otherwise("response")).withColumn("refers_to", F.when(later, F.col("first_key")))
    records.select("key", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", _header(F.col("key"), F.col("url")).alias("header")).write.option("compression", "zstd").parquet(f"{folder}/records")


def _repeats(facts: DataFrame) -> bool:
    """Whether a key comes more than once for one payload: then one row of its bytes has to be chosen."""
    return bool(facts.groupBy("payload_digest", "key").count().filter("count > 1").limit(1).collect())


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """The payloads with their digests computed again from the bytes read; ``verified`` says whether they agree."""
    rows = spark.read.parquet(f"{folder}/payloads")
    digest, length = F.sha2("payload", 256), F.length("payload").cast("long")
    return rows.select("payload_digest", "payload", digest.alias("computed_digest"), length.alias("computed_bytes"), ((digest == F.col("payload_digest")) & (length == F.col("payload_bytes"))).alias("verified"))


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records, their header fields parsed again from the stored header block."""
    rows = spark.read.parquet(f"{folder}/records")
    field = lambda name: F.nullif(F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))
    return rows.select("key", "refers_to", "header", field("WARC-Type").alias("record_type"), F.regexp_replace(field("WARC-Payload-Digest"), "^sha256:", "").alias("payload_digest"), field("Content-Length").cast("long").alias("content_length"))


def sound(value: Column) -> Column:
    """``value`` of a payload whose bytes have the digest they are stored under; a damaged payload stops the job."""
    return F.when(F.col("verified"), value).otherwise(F.raise_error(F.concat(F.lit("archived payload does not have its digest "), F.col("payload_digest"))))


def present(value: Column) -> Column:
    """``value`` of a record's payload; a record whose payload is not in the archive stops the job."""
    return F.when(F.col("there"), value).otherwise(F.raise_error(F.concat(F.lit("no archived payload "), F.col("payload_digest"))))


def reconstruct(spark: SparkSession, folder: str) -> DataFrame:
    """Original records: key, and the bytes of header block, payload (none for a revisit) and closing line ends."""
    records = read_records(spark, folder)
    payloads = read_payloads(spark, folder).select("payload_digest", sound(F.col("payload")).alias("payload"), F.lit(True).alias("there"))
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    found = records.join(payloads, "payload_digest", "left").withColumn("payload", present(F.col("payload")))
    return found.select("key", F.concat(F.encode("header", "UTF-8"), body, F.lit(b"\r\n\r\n")).alias("record"), "payload")


@query(
    "op3_warc_archive",
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
         d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
         f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
    SELECT page_id, payload_bytes, payload_digest,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
    FROM f
    """,
)
def op3_warc_archive(spark, sf_dir):
    folder = f"{checkpoint_folder(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archive(table(spark, sf_dir, "pages").select("page_id", "url", "html"), folder)
    payloads = read_payloads(spark, folder).select(F.col("payload_digest").alias("_digest"), sound(F.col("computed_digest")).alias("computed_digest"), "computed_bytes", F.lit(True).alias("there"))
    records = read_records(spark, folder)
    return records.join(payloads, F.col("payload_digest") == F.col("_digest"), "left").select(
        F.col("key").alias("page_id"), F.col("computed_bytes").alias("payload_bytes"), present(F.col("computed_digest")).alias("payload_digest"), "record_type", "refers_to"
    )
