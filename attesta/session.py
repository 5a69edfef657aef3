"""Session settings shared by the entry points, the bench and the tests."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",  # markup repeats keys; the last one counts
}


def build_session(app: str = "attesta", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, which need it to run its Arrow functions."""
    package = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="package-")  # the driver serves it to the executors while the session lives
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to a session someone else built."""
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder that spark.checkpoint.dir names; where it is unset, one in the warehouse, which every executor can reach too."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def settle(df: DataFrame) -> DataFrame:
    """Cut lineage through reliable storage, so a lost executor costs one re-read."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write once to the shared folder as Parquet and read back: columns prune, lineage ends.

    For a costly projection that several joins of one job read.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fixed(rows: DataFrame) -> DataFrame:
    """The same rows, their columns made once: a later filter on one of them is not moved below and made of the inputs again."""
    return rows.select(F.inline(F.array(F.struct(*rows.columns))))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt to every core by their keys, for work that costs far more than the size of its input lets Spark expect."""
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), *keys)
