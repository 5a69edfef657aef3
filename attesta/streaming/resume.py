"""Batches that can stop anywhere and go on without repeating finished entities."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from attesta.operators.ordering import number_within
from attesta.streaming.batches import read_if_present, write_batch


def finished(module_evidence: DataFrame, modules: list[str]) -> DataFrame:
    """Entities with every requested module present and fetched."""
    done = module_evidence.filter(F.col("module").isin(modules) & (F.coalesce("status", F.lit("not_fetched")) != "not_fetched"))
    return done.groupBy("org").agg(F.count_distinct("module").alias("n")).filter(F.col("n") == len(modules)).select("org")


def pending(profiles: DataFrame, module_evidence: DataFrame, modules: list[str], priority: str = "priority") -> DataFrame:
    """Entities still to do, with the order they should be done in as columns to sort by."""
    left = profiles.join(finished(module_evidence, modules), "org", "left_anti")
    return left.withColumn("order_key", F.struct((-F.coalesce(F.col(priority), F.lit(0))).alias("p"), F.col("org").alias("o")))


def resume_problems(profiles: DataFrame, module_evidence: DataFrame) -> DataFrame:
    """Finished rows of entities outside this batch: the wrong output was given to resume from."""
    return module_evidence.select("org").distinct().join(profiles.select("org"), "org", "left_anti")


class GoalReached(Exception):
    """The steps that a run was asked for are done."""


class ResumableRun:
    """A queue of entities in priority order, processed a step of ``every`` entities at a time.

    The queue is written once, a folder per tick. A stream takes one tick per micro-batch; its checkpoint is the place the run has
    reached. A tick reads its own folder and writes its own result folder, so the queue is scanned once in all, a stopped run goes on
    where it was, and the tick it was in is written again and not twice.

    A tick is one step. With ``ticks`` the queue is dealt into at most so many ticks of as many whole steps each, so that a long queue
    costs no more micro-batches than a short one; steps are then counted in ticks throughout.
    """

    def __init__(self, spark: SparkSession, path: str, every: int, ticks: int | None = None):
        self.spark, self.path, self.every, self.ticks = spark, path.rstrip("/"), every, ticks

    def enqueue(self, waiting: DataFrame) -> None:
        """Write the queue from rows with an ``order_key``; a run that has its queue keeps it."""
        try:
            self.steps()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            placed = number_within(waiting, [], ["order_key"], "place").withColumn("step", F.floor((F.col("place") - 1) / self.every).cast("long"))
            last = placed.agg(F.max("step")).first()[0]
            steps = 0 if last is None else last + 1
            together = 1 if self.ticks is None else max(1, -(-steps // self.ticks))
            ticked = placed.drop("order_key").withColumn("tick", F.floor(F.col("step") / together).cast("long"))
            ticked.write.mode("overwrite").partitionBy("tick").parquet(f"{self.path}/queue")
            self.spark.range(-(-steps // together)).write.parquet(f"{self.path}/steps")  # written last: a queue that broke off is written again

    def steps(self) -> int:
        """How many steps the queue has."""
        return self.spark.read.schema("id long").parquet(f"{self.path}/steps").count()

    def run(self, process: Callable[[DataFrame], DataFrame], most: int | None = None) -> int:
        """Process steps until the queue or ``most`` steps are done; returns how many are done in all.

        ``process`` maps queue rows (with ``place`` and ``step``) to result rows.
        """
        steps = self.steps()
        goal = steps if most is None else min(steps, self._done() + most)
        if goal == self._done():
            return goal

        def one(_: DataFrame, batch_id: int) -> None:
            if batch_id >= goal:
                # Failing the batch keeps it out of the checkpoint, so its step is the first of the next run.
                raise GoalReached(f"step {batch_id} is left for another run")
            rows = self.spark.read.parquet(f"{self.path}/queue/tick={batch_id}")
            write_batch(process(rows), f"{self.path}/results", batch_id)
            write_batch(self.spark.range(batch_id, batch_id + 1).coalesce(1), f"{self.path}/done", batch_id)

        ticks = self.spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).option("numPartitions", 1).load()
        query = ticks.writeStream.foreachBatch(one).option("checkpointLocation", f"{self.path}/checkpoint").trigger(processingTime="0 seconds").start()
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            if GoalReached.__name__ not in str(error):
                raise
        return self._done()

    def _done(self) -> int:
        return read_if_present(self.spark, f"{self.path}/done", "id long, batch long").count()

    def results(self, schema) -> DataFrame:
        """The result rows of the steps that are done."""
        return read_if_present(self.spark, f"{self.path}/results", schema).drop("batch")
