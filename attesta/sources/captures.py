"""Captured source bytes and the JSON sinks."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from attesta.session import stored
from attesta.streaming.batches import read_if_present, write_batch


# Row ids up to this many are broadcast to the scan that fetches their bodies; beyond it the bodies join by shuffle.
FETCH_ROWS = 2_000_000
BUCKETS = 64


def _addressed(bodies: DataFrame, body: str) -> DataFrame:
    """``bodies`` with the file and row each comes from; rows that are in no Parquet file are written to one first."""
    try:
        return bodies.select(F.col(body).alias("body"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    except AnalysisException as error:
        if error.getCondition() not in ("UNRESOLVED_COLUMN.WITH_SUGGESTION", "UNRESOLVED_COLUMN.WITHOUT_SUGGESTION"):
            raise
        return _addressed(stored(bodies.select(body), "bodies"), body)


def first_rows(bodies: DataFrame, known: DataFrame | None = None, body: str = "body") -> tuple[DataFrame, DataFrame]:
    """(addressed bodies, (content_sha256, file, row) of one row for each content that ``known`` lacks).

    Only digests and row ids are shuffled. ``known`` is (content_sha256).
    """
    rows = _addressed(bodies, body)
    digests = rows.select(F.sha2("body", 256).alias("content_sha256"), F.struct("file", "row").alias("at")).filter("content_sha256 IS NOT NULL")
    fresh = digests.groupBy("content_sha256").agg(F.min("at").alias("at"))
    if known is not None:
        fresh = fresh.join(known.select("content_sha256"), "content_sha256", "left_anti")
    return rows, stored(fresh.select("content_sha256", "at.file", "at.row"), "fresh-captures")


def fetch(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(content_sha256, body) of the wanted rows: one scan; the bodies are not shuffled while the row ids are few enough to be sent to it."""
    few = wanted.limit(FETCH_ROWS + 1).count() <= FETCH_ROWS
    return rows.join(F.broadcast(wanted) if few else wanted, ["file", "row"]).select("content_sha256", "body")


def capture_rows(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One row per distinct content: (content_sha256, body). NULL bodies have none."""
    return fetch(*first_rows(bodies, body=body))


def new_captures(bodies: DataFrame, store: DataFrame, body: str = "body") -> DataFrame:
    """Content the store does not hold yet; only hashes take part in the joins."""
    return fetch(*first_rows(bodies, store, body))


class CaptureStore:
    """Bodies under their digest in one folder, and their digests as a bucketed table.

    The digests' files are bucketed, so the stored side of the join that finds unseen content is read bucket by bucket and never
    shuffled. Bodies are written where they are scanned. A batch that runs again after a loss writes the same folder; once
    its digests are in, it finds nothing new and writes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "capture_digests"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (content_sha256 STRING, batch BIGINT) USING parquet "
            f"CLUSTERED BY (content_sha256) SORTED BY (content_sha256) INTO {BUCKETS} BUCKETS LOCATION '{self.path}/digests'"
        )

    def digests(self) -> DataFrame:
        return self.spark.table(self.name)

    def bodies(self, schema: str = "content_sha256 string, body string") -> DataFrame:
        return read_if_present(self.spark, f"{self.path}/bodies", f"{schema}, batch long")

    def append(self, bodies: DataFrame, batch_id: int, body: str = "body") -> bool:
        """Store unseen content; tells whether there was any."""
        rows, fresh = first_rows(bodies, self.digests(), body)
        if fresh.isEmpty():
            return False
        write_batch(fetch(rows, fresh), f"{self.path}/bodies", batch_id)
        fresh.select("content_sha256", F.lit(batch_id).cast("long").alias("batch")).repartition(BUCKETS, "content_sha256").write.insertInto(self.name)
        return True


def audit_captures(records: DataFrame, store: DataFrame) -> DataFrame:
    """Published hashes whose stored bytes are missing or hash to something else."""
    stored = store.select("content_sha256", F.sha2("body", 256).alias("actual_sha256"))
    checked = records.join(stored, "content_sha256", "left")
    good = F.coalesce(F.col("actual_sha256") == F.col("content_sha256"), F.lit(False))
    return checked.withColumn("intact", good)


def audit_summary(checked: DataFrame) -> DataFrame:
    row = checked.agg(
        F.count(F.lit(1)).alias("captures_checked"), F.count_if(~F.col("intact")).alias("failures"),
        F.count_distinct("org").alias("accepted_sites"),
    )
    return row.withColumn("passed", (F.col("accepted_sites") > 0) & (F.col("failures") == 0))


def write_json(rows: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """JSON lines; the committer publishes finished files only, so a lost task leaves no half row."""
    writer = rows.write.mode("overwrite").option("ignoreNullFields", "false")
    (writer.partitionBy(*partition_by) if partition_by else writer).json(path)


def write_envelopes(headers: DataFrame, claims: DataFrame, path: str) -> None:
    """Envelopes as two sets of JSON lines: ``headers``, one per entity, and ``claims``, one per claim."""
    write_json(headers, f"{path}/headers")
    write_json(claims, f"{path}/claims")


def json_lines(rows: DataFrame) -> Column:
    return F.to_json(F.struct(*rows.columns))
