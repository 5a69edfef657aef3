"""Change events from a stream of snapshots; a replayed snapshot gives none."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor

from attesta import lexicon as lx
from attesta.operators.diffs import CARRIED
from attesta.streaming.batches import arbitrary_state, in_buckets, packed, read_if_present, rows_in, unpacked, write_batch

FACT = "snapshot long, value string, source_url string, retrieved_at string, effective_at string, content_sha256 string, status string"
EVENT = (
    "org string, field string, snapshot long, old_value string, new_value string, source_url string, retrieved_at string, effective_at string, "
    "old_content_sha256 string, new_content_sha256 string, status string"
)


def facts_of(rows: DataFrame) -> DataFrame:
    """(org, field) facts of numbered snapshots as text; columns a source does not have are NULL."""
    none = F.lit(None).cast("string")
    carried = [F.col(c).cast("string").alias(c) if c in rows.columns else none.alias(c) for c in CARRIED]
    return rows.select("org", "field", F.col("snapshot").cast("long").alias("snapshot"), F.col("value").cast("string").alias("value"), *carried)


class LastFact(StatefulProcessor):
    """Holds the last facts of a bucket of (org, field) and emits the old and the new value where a later snapshot differs."""

    names = ["org", "field"] + [part.split()[0] for part in FACT.split(", ")]

    def __init__(self, after_baseline: bool):
        # With a baseline, a fact it does not have is new; without one, the first snapshot of a fact is what later ones are compared with.
        self.after_baseline = after_baseline

    def init(self, handle) -> None:
        self.state = handle.getValueState("facts", "facts binary")

    def _held(self) -> dict[tuple, tuple]:
        return {row[:2]: row[2:] for row in unpacked(bytes(self.state.get()[0]))} if self.state.exists() else {}

    def _hold(self, held: dict[tuple, tuple]) -> None:
        schema = pa.schema([(n, pa.int64() if n == "snapshot" else pa.string()) for n in self.names])
        self.state.update((packed([key + fact for key, fact in held.items()], schema),))

    @staticmethod
    def _order(fact: tuple) -> tuple:
        # Of facts of one snapshot that differ the last in order counts, whatever order they come in.
        return fact[0], *[(v is not None, v or "") for v in fact[1:]]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        newest: dict[tuple, tuple] = {}
        for part in rows:
            for org, field, *rest in rows_in(part, self.names):
                place, fact = (org, field, rest[0]), tuple(rest)
                known = newest.get(place)
                if known is None or known != fact and self._order(fact) > self._order(known):
                    newest[place] = fact
        held, events, later = self._held(), [], False
        for (org, field, snapshot), fact in sorted(newest.items(), key=lambda item: item[0][2]):
            last = held.get((org, field))
            if last is not None and snapshot <= last[0]:
                continue  # a replay
            old = last if last is not None else (None,) * len(fact) if self.after_baseline else fact
            if old[1] != fact[1]:
                events.append((org, field, snapshot, old[1], fact[1], fact[2], fact[3], fact[4], old[5], fact[5], fact[6]))
            held[org, field], later = fact, True
        if later:
            self._hold(held)
        if events:
            yield pd.DataFrame(events, columns=[part.split()[0] for part in EVENT.split(", ")])

    def handleInitialState(self, key, initialState, timerValues) -> None:
        held = self._held()
        for org, field, *rest in rows_in(initialState, self.names):
            fact, known = tuple(rest), held.get((org, field))
            if known is None or self._order(fact) > self._order(known):
                held[org, field] = fact
        self._hold(held)

    def close(self) -> None:
        pass


def change_events(snapshots: DataFrame, baseline: DataFrame | None = None, fields: list[str] | None = None) -> DataFrame:
    """Change events of a stream of numbered snapshots (org, field, snapshot, value, …).

    Each fact is compared with the last one of its (org, field), which Spark's state store holds; ``baseline`` fills it before the
    first batch. NULL to 0 is a change. A snapshot with a number that is not above the last one is a replay and gives nothing. An absent
    entity or field is no change. Without ``fields`` the tracked ones are compared, with an empty list all. The state's keys are buckets
    of (org, field), so a call of the processor handles many facts.
    """
    fields = lx.TRACKED_FIELDS if fields is None else fields
    wanted = F.col("field").isin(fields) if fields else F.lit(True)
    keyed = in_buckets(facts_of(snapshots.filter(wanted)), "org", "field")
    start = None if baseline is None else in_buckets(facts_of(baseline.filter(wanted)), "org", "field")
    return keyed.transformWithStateInPandas(LastFact(baseline is not None), EVENT, "Update", "None", initialState=start)


class ChangeLog:
    """The events between snapshots, one folder per batch; the facts are in the stream's state and nowhere else."""

    def __init__(self, spark: SparkSession, path: str, fields: list[str] | None = None):
        self.spark, self.path, self.fields = spark, path.rstrip("/"), fields

    def events(self) -> DataFrame:
        return read_if_present(self.spark, f"{self.path}/events", EVENT + ", batch long")

    def run(self, snapshots: DataFrame, checkpoint: str, baseline: DataFrame | None = None):
        """Drain a stream of snapshots and stop; a later run goes on with the state of this one."""
        with arbitrary_state(self.spark):
            query = (
                change_events(snapshots, baseline, self.fields).writeStream.outputMode("update")
                .foreachBatch(lambda rows, batch_id: write_batch(rows, f"{self.path}/events", batch_id))
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            )
        query.awaitTermination()
        return query
