"""Helpers the operators of this package share: tables, settings, and the registry of their queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attesta.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# Arrow batches are bounded by rows and bytes, so one long document does not bring thousands of others along.
ARROW_CONF = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def ready(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on, set on a session someone else built."""
    configure(spark)
    for key, value in ARROW_CONF.items():
        spark.conf.set(key, value)
    return spark


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query of this package, with the SQL it is checked against where SQL can express it."""

    def register(function: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: function(ready(spark), sf_dir)
        if oracle:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def free_name(df: DataFrame, name: str) -> str:
    """A column name that does not clash with any of the caller's."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# Separators of words in the contracts of this package: space, and the controls from tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
