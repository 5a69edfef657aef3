"""Folders of micro-batches: a batch that runs twice overwrites its own folder and nothing else."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, GroupedData, SparkSession, functions as F
from pyspark.sql.types import StructType

# A call of a stateful processor costs milliseconds however few rows it has, so the state holds many keys in a row.
BUCKETS = 1024
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")


def read_if_present(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def drop_batches(spark: SparkSession, path: str, upto: int) -> None:
    """Delete the folders of batches up to one, which a later table holds."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return
    for found in files.listStatus(folder):
        name = found.getPath().getName()
        if name.startswith("batch=") and int(name[6:]) <= upto:
            files.delete(found.getPath(), True)


@contextmanager
def arbitrary_state(spark: SparkSession) -> Iterator[None]:
    """The state store that operators with several states, timers or an initial state need; a stream keeps the one it starts with."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def in_buckets(rows: DataFrame, *keys: str) -> GroupedData:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")).groupBy("bucket")


def rows_in(part: pd.DataFrame, names: list[str]) -> Iterator[tuple]:
    """The rows of a frame as tuples, missing values as None."""
    columns = [part[n].astype(object) for n in names]
    return zip(*[c.where(c.notna(), None).tolist() for c in columns])


def packed(rows: list[tuple], schema: pa.Schema) -> bytes:
    """Rows as one Arrow stream, the value that a bucket's state holds."""
    columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, schema) as writer:
        writer.write_batch(pa.record_batch(columns, schema=schema))
    return sink.getvalue().to_pybytes()


def unpacked(data: bytes) -> Iterator[tuple]:
    with pa.ipc.open_stream(data) as reader:
        return zip(*[c.to_pylist() for c in reader.read_all().columns])
