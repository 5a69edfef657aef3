import random

import pytest
from pyspark.sql import functions as F

from attesta.streaming.changes import ChangeLog
from attesta.streaming.feed_index import FeedIndex, fold_entries, in_window, index_checksum
from attesta.streaming.resume import ResumableRun, finished, pending, resume_problems

ENTRY = "uuid string, modified timestamp, status string, business_name string, url string, arrival long"


def entries(spark, rows):
    return spark.createDataFrame(rows, "uuid string, modified string, status string, business_name string, url string, arrival long").withColumn(
        "modified", F.col("modified").cast("timestamp")
    )


def state(df):
    return sorted((r.uuid, str(r.modified), r.status, r.business_name) for r in df.collect())


def test_out_of_order_and_repeated_batches_give_the_batch_answer(spark, tmp_path):
    generator = random.Random(5)
    rows = [
        (f"u{generator.randint(0, 30)}", f"2026-01-{generator.randint(1, 28):02d} 10:00:00", generator.choice(["active", "INACTIVE"]), f"Firma {i}", f"/{i}", i)
        for i in range(300)
    ]
    expected = state(fold_entries(entries(spark, rows).withColumn("status", F.upper("status"))))
    shuffled = rows[:]
    generator.shuffle(shuffled)
    index = FeedIndex(spark, str(tmp_path / "index"))
    for batch, start in enumerate(range(0, 300, 60)):
        part = entries(spark, shuffled[start:start + 60])
        index.merge(part, batch)
        index.merge(part, batch)  # a retried batch changes nothing
    assert state(index.current()) == expected


READ = ENTRY + ", retrieved_at timestamp, complete boolean"


def reads(spark, source, batches):
    """One file per read: (clock, complete, rows)."""
    for clock, complete, rows in batches:
        df = entries(spark, rows).withColumn("retrieved_at", F.lit(clock).cast("timestamp")).withColumn("complete", F.lit(complete))
        df.coalesce(1).write.mode("append").parquet(str(source))
    return spark.readStream.schema(READ).option("maxFilesPerTrigger", 1).parquet(str(source))


def test_stream_of_files_equals_one_batch(spark, tmp_path):
    rows = [(f"u{i % 7}", f"2026-01-{1 + i % 28:02d} 00:00:00", "ACTIVE", f"F{i}", "/", i) for i in range(40)]
    stream = reads(spark, tmp_path / "source", [("2026-01-31", True, rows[part::4]) for part in range(4)])
    index = FeedIndex(spark, str(tmp_path / "index"))
    index.run(stream, str(tmp_path / "checkpoint"))
    assert state(index.current()) == state(fold_entries(entries(spark, rows)))


def test_state_ends_with_the_window(spark, tmp_path):
    """Old active entries stay, others leave the state, partial reads and replays change nothing; another run goes on."""
    source, index = tmp_path / "source", FeedIndex(spark, str(tmp_path / "index"))
    first = [("old-active", "2025-01-01", "active", "A", "/", 1), *[(f"gone{i}", "2026-01-05", "INACTIVE", "G", "/", 2) for i in range(20)], ("closing", "2026-01-20", "ACTIVE", "C", "/", 3), (None, "2026-01-05", "ACTIVE", "N", "/", 4)]
    batches = [
        ("2026-01-21", True, first),
        ("2026-02-01", False, [("old-active", "2026-01-30", "INACTIVE", "broken", "/", 5), ("closing", "2026-01-31", "INACTIVE", "broken", "/", 6)]),
        ("2026-02-01", True, [("closing", "2026-01-31", "inactive", "C2", "/", 7), ("closing", "2026-01-20", "ACTIVE", "stale", "/", 3), ("reopened", "2026-01-25", "INACTIVE", "R", "/", 8)]),
        ("2026-02-20", True, [("new", "2026-02-19", "ACTIVE", "N", "/", 9), ("reopened", "2026-02-18", "ACTIVE", "R2", "/", 10)]),
        ("2026-03-01", True, [("new", "2026-02-19", "ACTIVE", "N", "/", 9)]),
    ]
    stream = reads(spark, source, batches)
    query = index.run(stream, str(tmp_path / "checkpoint"), window="20 days", compact_every=3)
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) >= 22 and held[-1] == 3, held
    assert [r.uuid for r in index.current("2026-02-09").orderBy("uuid").collect()] == ["new", "old-active", "reopened"]
    assert [r.uuid for r in index.current().orderBy("uuid").collect()] == ["new", "old-active", "reopened"]
    # A repeat of what has left comes with its own clock and is late; the old entry closes at last.
    reads(spark, source, [("2026-01-21", True, [("gone1", "2026-01-04", "ACTIVE", "G", "/", 1)]), ("2026-03-20", True, [("old-active", "2026-03-19", "INACTIVE", "A", "/", 11)])])
    index.run(spark.readStream.schema(READ).option("maxFilesPerTrigger", 1).parquet(str(source)), str(tmp_path / "checkpoint"), window="20 days")
    assert state(index.current()) == [("new", "2026-02-19 00:00:00", "ACTIVE", "N"), ("old-active", "2026-03-19 00:00:00", "INACTIVE", "A"), ("reopened", "2026-02-18 00:00:00", "ACTIVE", "R2")]


def test_window_keeps_old_active_entries_and_partial_loads_change_nothing(spark, tmp_path):
    index = FeedIndex(spark, str(tmp_path / "index"))
    assert index.load(entries(spark, [("a", "2025-01-01", "ACTIVE", "A", "/", 1), ("b", "2025-01-01", "INACTIVE", "B", "/", 2), ("c", "2026-02-01", "INACTIVE", "C", "/", 3)]), 0, complete=True)
    assert not index.load(entries(spark, [("a", "2026-03-01", "INACTIVE", "A", "/", 4)]), 1, complete=False)
    assert [r.uuid for r in index.current("2026-01-01").orderBy("uuid").collect()] == ["a", "c"]
    index.merge(entries(spark, [("a", "2026-03-01", "INACTIVE", "A", "/", 4), ("", "2026-03-01", "ACTIVE", "none", "/", 5)]), 1)
    assert [r.status for r in in_window(index.current(), "2026-01-01").filter("uuid = 'a'").collect()] == ["INACTIVE"]


def test_runs_are_recorded_and_compaction_evicts(spark, tmp_path):
    index = FeedIndex(spark, str(tmp_path / "index"))
    assert index.next_since() is None
    index.load(entries(spark, [("a", "2025-01-01", "INACTIVE", "A", "/", 1), ("b", "2026-02-01", "ACTIVE", "B", "/", 2)]), 0, True, "2026-02-02 10:00:00")
    index.load(entries(spark, [("b", "2026-03-01", "INACTIVE", "B", "/", 3)]), 1, False, "2026-03-02 10:00:00")
    assert str(index.next_since()) == "2026-02-02 09:55:00" and index.current().count() == 2
    index.compact(1, "2026-01-01")
    assert [r.uuid for r in index.current().collect()] == ["b"]
    index.merge(entries(spark, [("a", "2026-02-03", "ACTIVE", "A", "/", 4)]), 2)
    assert state(index.current()) == [("a", "2026-02-03 00:00:00", "ACTIVE", "A"), ("b", "2026-02-01 00:00:00", "ACTIVE", "B")]


def test_checksum_ignores_order(spark):
    rows = [(f"u{i}", "2026-01-01", "ACTIVE", "F", "/", i) for i in range(20)]
    assert index_checksum(entries(spark, rows)).first() == index_checksum(entries(spark, rows[::-1]).repartition(5)).first()


FACTS = "org string, field string, snapshot long, value string, content_sha256 string"


def snapshots(spark, source, batches):
    for rows in batches:
        spark.createDataFrame(rows, FACTS).coalesce(1).write.mode("append").parquet(str(source))
    return spark.readStream.schema(FACTS).option("maxFilesPerTrigger", 1).parquet(str(source))


def events(log):
    return sorted(((r.org, r.field, r.snapshot, r.old_value, r.new_value, r.old_content_sha256, r.new_content_sha256) for r in log.events().collect()), key=str)


def test_changes_are_emitted_once_and_replay_gives_none(spark, tmp_path):
    first = [("1", "registry.employees", 0, None, "h1"), ("1", "registry.name", 0, "A", "h1"), ("2", "registry.name", 0, "B", "h2")]
    second = [("1", "registry.employees", 1, "0", "h3"), ("1", "registry.name", 1, "A", "h3"), ("1", "untracked", 1, "x", "h3"), ("3", "registry.name", 1, "C", "h3")]
    log = ChangeLog(spark, str(tmp_path / "log"), ["registry.employees", "registry.name"])
    stream = snapshots(spark, tmp_path / "s", [first, second, second, first])
    query = log.run(stream, str(tmp_path / "c"))
    # NULL to 0 is a change; the entity the snapshot leaves out is not one, nor is an entity's first snapshot.
    assert events(log) == [("1", "registry.employees", 1, None, "0", "h1", "h3")]
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 4
    # A later run needs no earlier batch: the source is gone, the state is not.
    other = tmp_path / "s"
    for file in other.glob("*.parquet"):
        file.rename(tmp_path / file.name)
    third = [("2", "registry.name", 2, None, "h4"), ("3", "registry.name", 2, "D", "h4"), ("3", "registry.name", 3, "E", "h5")]
    log.run(snapshots(spark, other, [third]), str(tmp_path / "c"))
    assert events(log)[1:] == [("2", "registry.name", 2, "B", None, "h2", "h4"), ("3", "registry.name", 2, "C", "D", "h3", "h4"), ("3", "registry.name", 3, "D", "E", "h4", "h5")]


def test_a_baseline_makes_new_facts_events(spark, tmp_path):
    first = [("1", "registry.name", 0, "A", "h1")]
    second = [("1", "registry.name", 1, "B", "h2"), ("2", "registry.name", 1, "C", "h2"), ("2", "registry.employees", 1, None, "h2")]
    log = ChangeLog(spark, str(tmp_path / "log"), [])
    log.run(snapshots(spark, tmp_path / "s", [second, second]), str(tmp_path / "c"), baseline=spark.createDataFrame(first, FACTS))
    assert events(log) == [("1", "registry.name", 1, "A", "B", "h1", "h2"), ("2", "registry.name", 1, None, "C", None, "h2")]


def test_resume_skips_only_finished_entities(spark, tmp_path):
    profiles = spark.createDataFrame([("1", 5), ("2", 9), ("3", 1)], "org string, priority int")
    modules = spark.createDataFrame([("1", "a", "available"), ("1", "b", "not_found"), ("2", "a", "available"), ("2", "b", "not_fetched")], "org string, module string, status string")
    assert [r.org for r in finished(modules, ["a", "b"]).collect()] == ["1"]
    assert [r.org for r in pending(profiles, modules, ["a", "b"]).orderBy("order_key").collect()] == ["2", "3"]
    assert resume_problems(profiles.filter("org <> '2'"), modules).count() == 1


def test_a_stopped_run_goes_on_in_priority_order(spark, tmp_path):
    profiles = spark.createDataFrame([(f"{i:03d}", i * 37 % 101) for i in range(50)], "org string, priority int")
    waiting = pending(profiles, spark.createDataFrame([], "org string, module string, status string"), ["a"]).select("org", "priority", "order_key")
    wanted = [r.org for r in waiting.orderBy("order_key").collect()]
    seen = []

    def process(rows, fail=None):
        step = rows.first()["step"]
        if step == fail:
            raise RuntimeError("stopped in the middle")
        seen.append(step)
        return rows.select("org", "place", "step")

    run = ResumableRun(spark, str(tmp_path / "run"), every=8)
    run.enqueue(waiting)
    assert run.steps() == 7 and run.run(process, most=2) == 2 and seen == [0, 1]
    with pytest.raises(Exception, match="stopped in the middle"):
        run.run(lambda rows: process(rows, fail=4))
    again = ResumableRun(spark, str(tmp_path / "run"), every=8)
    again.enqueue(waiting.limit(0))  # the queue is there and stays
    assert again.run(process) == 7 and seen == [0, 1, 2, 3, 4, 5, 6]
    assert again.run(process) == 7 and len(seen) == 7
    found = again.results("org string, place long, step long").orderBy("place").collect()
    assert [r.org for r in found] == wanted and [r.step for r in found] == [k // 8 for k in range(50)]


def test_a_long_queue_takes_no_more_ticks(spark, tmp_path):
    waiting = spark.range(1000).select(F.col("id").cast("string").alias("org"), F.struct(F.col("id").alias("p")).alias("order_key"))
    run = ResumableRun(spark, str(tmp_path / "run"), every=8, ticks=3)
    run.enqueue(waiting)
    process = lambda rows: rows.select("org", "place", "step")
    assert run.steps() == 3 and run.run(process, most=1) == 1
    assert run.results("org string, place long, step long").agg(F.max("step")).first()[0] == 41  # whole steps
    assert run.run(process) == 3
    found = run.results("org string, place long, step long").orderBy("place").collect()
    assert [(r.org, r.place, r.step) for r in found] == [(str(k), k + 1, k // 8) for k in range(1000)]


def test_an_empty_queue_is_done(spark, tmp_path):
    run = ResumableRun(spark, str(tmp_path / "run"), every=8)
    run.enqueue(spark.createDataFrame([], "org string, order_key struct<p:int,o:string>"))
    assert run.steps() == 0 and run.run(lambda rows: rows) == 0


def test_entries_without_an_id_are_left_out(spark, tmp_path):
    index = FeedIndex(spark, str(tmp_path / "index"))
    index.merge(entries(spark, [(None, "2026-01-01", "ACTIVE", "x", "/", 1)]), 0)
    assert index.current().count() == 0
    assert ChangeLog(spark, str(tmp_path / "nothing")).events().count() == 0


def test_the_state_of_many_keys_takes_few_calls(spark, tmp_path):
    """A call of a processor costs milliseconds, so the state's rows grow with the buckets and not with the keys."""
    first = [(f"{k}", "registry.name", 0, "A", "h1") for k in range(6000)]
    second = [(f"{k}", "registry.name", 1, "B" if k % 3 else "A", "h2") for k in range(7000)]
    log = ChangeLog(spark, str(tmp_path / "log"), [])
    query = log.run(snapshots(spark, tmp_path / "s", [second]), str(tmp_path / "c"), baseline=spark.createDataFrame(first, FACTS))
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 1024
    assert log.events().count() == sum(k % 3 > 0 or k >= 6000 for k in range(7000))
    index = FeedIndex(spark, str(tmp_path / "index"))
    rows = [(f"u{k}", "2026-01-20", "ACTIVE", "F", "/", k) for k in range(6000)]
    query = index.run(reads(spark, tmp_path / "source", [("2026-01-21", True, rows)]), str(tmp_path / "checkpoint"))
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]) <= 1024
    assert index.current().count() == 6000
