"""Positions and running sums over a global order, without a one-task window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphvec.storage import materialize


def running(rows: DataFrame, keys: list[str], order: list[str], weight: str | None = None, name: str = "ordered") -> DataFrame:
    """`rows` with pos (0, 1, ...) in each group of `keys` by `order`, and with `weight` also
    start, the sum of the weights before.  A group is cut into ranges of the order: each range
    numbers its rows, and counts of the ranges, one row each, give what comes before."""
    cut = rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id())
    cut = materialize(cut, name)
    within = Window.partitionBy("_range", *keys).orderBy(*order)
    w = F.col(weight).cast("bigint") if weight else F.lit(0).cast("bigint")
    sizes = cut.groupBy("_range", *keys).agg(F.count("*").alias("_n"), F.sum(w).alias("_w"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_range", *keys, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(c) for c in ("_n", "_w")])
    on = [F.col("x._range") == F.col("s._range"), *[F.col(f"x.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]]
    placed = cut.withColumns({"_pos": F.row_number().over(within).cast("bigint") - 1, "_before": F.sum(w).over(within.rowsBetween(Window.unboundedPreceding, -1))})
    r = placed.alias("x").join(sizes.alias("s"), on)
    start = [(F.col("_w") + F.coalesce("_before", F.lit(0))).alias("start")] if weight else []
    return r.select(*[f"x.{c}" for c in rows.columns], (F.col("_n") + F.col("_pos")).alias("pos"), *start)


def earlier(rows: DataFrame, keys: list[str], order: list[str], value: str | None = None, weight: str | None = None, name: str = "earlier") -> DataFrame:
    """`rows` with what stands before each in its group of `keys` by `order`: `last`, the latest
    value that is not null, and `total`, the sum of the weights.  Both are associative: ranges of the order are
    scanned each on its own, and a row for each range carries them on."""
    cut = materialize(rows.repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()), name)
    v = F.col(value) if value else F.lit(None).cast("boolean")
    w = F.col(weight).cast("bigint") if weight else F.lit(0).cast("bigint")
    within = Window.partitionBy("_range", *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ends = cut.groupBy("_range", *keys).agg(F.max_by(v, F.when(v.isNotNull(), F.struct(*order))).alias("_ends_last"), F.sum(w).alias("_ends_sum"))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select("_range", *keys, F.last("_ends_last", ignorenulls=True).over(before).alias("_ends_last"), F.coalesce(F.sum("_ends_sum").over(before), F.lit(0)).alias("_ends_sum"))
    on = [F.col("x._range") == F.col("s._range"), *[F.col(f"x.{k}").eqNullSafe(F.col(f"s.{k}")) for k in keys]]
    seen = cut.withColumns({"_seen_last": F.last(v, ignorenulls=True).over(within), "_seen_sum": F.coalesce(F.sum(w).over(within), F.lit(0))})
    return seen.alias("x").join(ends.alias("s"), on).select(*[f"x.{c}" for c in rows.columns], F.coalesce("_seen_last", "_ends_last").alias("last"), (F.col("_seen_sum") + F.col("_ends_sum")).alias("total"))
