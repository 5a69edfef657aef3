"""Mixing sources to target weights: a time-varying curriculum.

Every source has a weight schedule over training time u in [0, 1]. Its token demand up to u is the source's target
times the integral of its normalised schedule. A document copy that starts at word w of its source's stream is
trained when the demand reaches w: its position is the inverse of the cumulative demand there. Range-sorting the
copies by position gives the training order.

The order inside a source is a seeded hash, so it ignores input order. Running sums are taken in two levels: a
hash bucket's total first, then the sum inside a bucket. The hash is uniform, so a source that holds a third of all
rows is spread over as many buckets as any other rows and is never sorted by one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from attesta.llm.common import free_name, query, table, word_count
from attesta.session import stored

CYCLE = (5.0, 2.0, 1.0)
# (start, end) of each source's linear schedule: density at u is start + (end - start) * u, by place in the source order.
RAMPS = ((1.0, 1.0), (0.5, 1.5), (1.5, 0.5))


def targets(totals: DataFrame, share: float = 1.5, most: float = 2.0, cycle: Sequence[float] = CYCLE, ramps: Sequence[tuple[float, float]] = RAMPS) -> DataFrame:
    """Target words per source from (source, source_size): weight shares, stopped at ``most`` times the source.

    What a stopped source gives up is shared by weight among the others until none is above its stop. The end of that
    process is a water level L with sum(min(most * size, L * weight)) = share * total; it is found by one running sum
    over the sources in the order in which they stop. The table has one row per source, so its windows are over
    sources and not over documents. Sources are ordered by code point, null last.
    """
    place = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("_place", F.row_number().over(place) - 1)
    turn = lambda values: F.element_at(F.array(*[F.lit(float(v)) for v in values]), (F.col("_place") % len(values) + 1).cast("int"))
    ranked = ranked.select(
        "source", "source_size", "n_rows", turn(cycle).alias("weight"), turn([r[0] for r in ramps]).alias("ramp_start"), turn([r[1] for r in ramps]).alias("ramp_end"), (F.col("source_size") * most).alias("_stop")
    )
    everything = Window.partitionBy()
    stops = Window.orderBy((F.col("_stop") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = stops.rowsBetween(Window.unboundedPreceding, -1)
    levels = ranked.select(
        "*",
        (F.sum("source_size").over(everything) * share).alias("_goal"),
        F.coalesce(F.sum("_stop").over(before), F.lit(0.0)).alias("_stopped"),
        (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))).alias("_open"),
    )
    # The level if exactly the sources before this one are stopped; the first that does not stop this one is the answer.
    level = (F.col("_goal") - F.col("_stopped")) / F.col("_open")
    levels = levels.withColumn("_level", F.when(level * F.col("weight") <= F.col("_stop"), level))
    water = F.first("_level", ignorenulls=True).over(stops.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return levels.withColumn("target", F.coalesce(F.least(F.col("_stop"), water * F.col("weight")), F.col("_stop"))).drop("_stop", "_goal", "_stopped", "_open", "_level")


def invert(demand: Column, start: Column, end: Column) -> Column:
    """Training time at which a linear schedule's integral reaches ``demand`` of its whole: solves a u + (b - a) u^2 / 2 = d (a + b) / 2."""
    area = demand * (start + end) / 2
    slope = end - start
    root = (F.sqrt(F.greatest(F.lit(0.0), start * start + 2 * slope * area)) - start) / slope
    return F.when(slope == 0, demand).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), root)))


def allocate(docs: DataFrame, key: str = "doc_id", source: str = "source", size: Column | None = None, seed: int = 17, whole: bool = False, **options) -> DataFrame:
    """Every row of ``docs`` with its size, its source's size and target, the words taken of it and its copies.

    ``copies`` holds (epoch, words, position) of each copy that is trained; ``position`` runs from 0 to 1. The last copy
    of a source is cut where the target ends, so the source's words meet its target; with ``whole`` a copy is taken
    entirely when its middle is before the target. A target is at most twice its source, so there are at most two
    epochs and no document exceeds two times its size.

    Nulls: a null source is a source of its own, last in order; null text has size 0 and is never taken. Repeated rows
    count as rows. Empty tables give no rows. The caller's columns are kept, in a struct while the work is done, so no
    name can clash.
    """
    counted = size if size is not None else word_count(F.col("text"))
    own = docs.select(F.struct("*").alias("_row"), F.col(key).alias("_key"), F.col(source).alias("source"), counted.alias("size"))
    totals = own.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    plan = stored(targets(totals, **options), "mix-targets")
    # The root of a source's rows: buckets and the rows inside one grow alike.
    hashed = own.withColumn("_hash", F.xxhash64(F.lit(seed), F.col("_key").cast("string")))
    plan = plan.withColumn("_buckets", F.ceil(F.sqrt("n_rows"))).withColumnRenamed("source", "_of").drop("n_rows")
    joined = hashed.join(plan, F.col("source").eqNullSafe(F.col("_of"))).drop("_of")
    unit = F.shiftrightunsigned(F.col("_hash"), 1).cast("double") / F.lit(float(2**63))
    placed = joined.withColumn("_bucket", F.floor(unit * F.col("_buckets"))).withColumn("_unit", unit)
    sums = placed.groupBy("source", "_bucket").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(F.col("source").alias("_s"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("source", "_bucket").orderBy("_unit", "_key", "size").rowsBetween(Window.unboundedPreceding, -1)
    run = placed.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    run = run.join(offsets, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_bucket") == F.col("_b")))
    start, goal = F.col("_inside") + F.col("_offset"), F.round(F.col("target")).cast("long")

    def copy(epoch: int) -> Column:
        begin = start + F.col("source_size") * epoch
        cut = F.when(begin + F.col("size") / 2 <= F.col("target"), F.col("size")).otherwise(0) if whole else F.greatest(F.lit(0), F.least(F.col("size"), goal - begin))
        # A source without words has target 0 and no copy; its rows are divided before the copies are chosen.
        position = invert(F.least(F.lit(1.0), F.try_divide(begin, F.col("target"))), F.col("ramp_start"), F.col("ramp_end"))
        return F.struct(F.lit(epoch).alias("epoch"), cut.cast("long").alias("words"), position.alias("position"))

    copies = F.filter(F.array(copy(0), copy(1)), lambda c: c["words"] > 0)
    taken = F.aggregate(F.col("copies"), F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return run.withColumn("copies", copies).select("_row", F.col("_key"), "source", "size", F.col("source_size").cast("long").alias("source_size"), "target", taken.alias("taken"), "copies")


def training_order(docs: DataFrame, key: str = "doc_id", whole: bool = True, **options) -> DataFrame:
    """The copies that are trained, in training order: the caller's columns, range-sorted by position."""
    mixed = allocate(docs, key, whole=whole, **options)
    at = free_name(docs, "position")
    rows = mixed.select("_row", F.explode("copies").alias("_copy")).select("_row.*", F.col("_copy.position").alias(at), F.col("_copy.epoch").alias(free_name(docs, "epoch")))
    return rows.repartitionByRange(F.col(at), F.col(key)).sortWithinPartitions(at, key)


@query("op1_mix_sources")
def op1_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    narrow = docs.select("doc_id", "source", word_count(F.col("text")).alias("n"))
    mixed = allocate(narrow, size=F.col("n"))
    first = F.element_at(F.transform("copies", lambda c: c["position"]), 1)
    rows = mixed.select(F.col("_key").alias("doc_id"), "size", "source_size", "target", "taken", F.when(F.size("copies") > 0, first).alias("first_position"))
    return rows.repartitionByRange(F.col("first_position"), F.col("doc_id")).sortWithinPartitions("first_position", "doc_id")
