"""Exact global and per-key positions without sorting a hot key in one task.

Rows are dealt by ranges of the whole sort key, whose bounds Spark samples, so any distribution splits evenly: one hot
entity, a burst of equal times or scores near zero. The ranges are stored once, as a second deal could draw other
bounds. A position is the number of rows in earlier ranges plus the position inside the row's own; there is one
size per key and range, and the heavy sorting happens per range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from attesta.session import stored


def dealt(rows: DataFrame, order: list, out: str) -> DataFrame:
    """The rows with the number of their range in ``order``, stored."""
    return stored(rows.repartitionByRange(*order).withColumn(out, F.spark_partition_id()), "ranges")


def number_within(rows: DataFrame, keys: list[str], order: list, out: str) -> DataFrame:
    """Row number from 1 per ``keys`` in ``order``."""
    return number_in_ranges(dealt(rows, [*keys, *order], "_bucket"), keys, order, out)


def number_in_ranges(placed: DataFrame, keys: list[str], order: list, out: str) -> DataFrame:
    """``number_within`` for rows whose ``_bucket`` is the number of their range in ``order``."""
    sizes = placed.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_size"))
    before = W.partitionBy(*keys).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    shifts = sizes.select(*keys, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    inside = placed.withColumn("_inside", F.row_number().over(W.partitionBy(*keys, "_bucket").orderBy(*order)))
    joined = inside.join(shifts, [*keys, "_bucket"])
    return joined.withColumn(out, F.col("_shift") + F.col("_inside")).drop("_bucket", "_inside", "_shift")


def number_by_hash(rows: DataFrame, hashed: str, out: str, digits: int = 3) -> DataFrame:
    """Row number over the whole table by a hex hash column; its prefix spreads rows evenly."""
    return number_in_ranges(rows.withColumn("_bucket", F.substring(hashed, 1, digits)), [], [hashed], out)


def running_totals(rows: DataFrame, order: list, values: list[str]) -> DataFrame:
    """Inclusive running sums ``c_<value>`` over the whole table in ``order``.

    Equal sort keys must already be folded into one row. The number of ranges, the
    session's shuffle partitions, bounds the broadcast offsets.
    """
    placed = dealt(rows, order, "_bucket")
    sums = placed.groupBy("_bucket").agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("_bucket", *[F.coalesce(F.sum(f"_s_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in values])
    inside = W.partitionBy("_bucket").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    local = placed.select("*", *[F.sum(v).over(inside).alias(f"_l_{v}") for v in values])
    joined = local.join(F.broadcast(offsets), "_bucket")
    done = joined.withColumns({f"c_{v}": F.col(f"_o_{v}") + F.col(f"_l_{v}") for v in values})
    return done.drop("_bucket", *[f"_o_{v}" for v in values], *[f"_l_{v}" for v in values])


def with_totals(rows: DataFrame, totals: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row."""
    return rows.join(F.broadcast(totals), F.lit(True))


def nearest_rank(rows: DataFrame, keys: list[str], value: str, quantiles: dict[str, float]) -> DataFrame:
    """Exact nearest-rank percentiles per key.

    Equal values are counted first and dealt by ranges; the range that holds each wanted
    rank is found from range sizes alone, and only that range's values are put in order.
    """
    counted = rows.filter(F.col(value).isNotNull()).groupBy(*keys, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    placed = dealt(counted, [*keys, "_v"], "_b")
    span = placed.groupBy(*keys).agg(F.max("_v").alias("_hi"), F.sum("_n").alias("n"))
    sizes = placed.groupBy(*keys, "_b").agg(F.sum("_n").alias("_size"))
    upto = W.partitionBy(*keys).orderBy("_b")
    ends = sizes.select(*keys, "_b", (F.sum("_size").over(upto) - F.col("_size")).alias("_before"), "_size")
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), F.lit(q).alias("q")) for name, q in quantiles.items()])
    targets = span.select(*keys, "n", "_hi", F.explode(wanted).alias("_t")).select(
        *keys, "n", "_hi", F.col("_t.name").alias("name"), F.greatest(F.lit(1), F.ceil(F.col("_t.q") * F.col("n"))).alias("_rank")
    )
    link = (targets.join(ends, keys) if keys else targets.join(F.broadcast(ends), F.lit(True))).filter(
        (F.col("_rank") > F.col("_before")) & (F.col("_rank") <= F.col("_before") + F.col("_size"))
    )
    inside = W.partitionBy(*keys, "_b").orderBy("_v")
    needed = placed.join(link.select(*keys, "_b").distinct(), [*keys, "_b"], "left_semi")
    ordered = needed.select(*keys, "_b", "_v", F.sum("_n").over(inside).alias("_upto"))
    hits = link.join(ordered, [*keys, "_b"]).filter(F.col("_before") + F.col("_upto") >= F.col("_rank"))
    answer = hits.groupBy(*keys, "name", "n", "_hi").agg(F.min("_v").alias("_answer"))
    columns = [F.max(F.when(F.col("name") == name, F.col("_answer"))).alias(name) for name in quantiles]
    return answer.groupBy(*keys, "n").agg(*columns, F.max("_hi").alias("maximum"))
