"""Positions in a total order without gathering all rows in one task."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_total(rows: DataFrame, order: str, value: str | None, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` (null: a row counts 1) over all rows before, by
    ``order``, whose values must be unique.

    Rows are dealt out by ranges and summed within them; a window over one row a range
    adds what the ranges before hold. The ranges are kept on disk, so that both
    readings see the same ones.
    """
    amount = F.lit(1).cast("long") if value is None else F.col(value).cast("long")
    dealt = rows.repartitionByRange(order).withColumn("_range", F.spark_partition_id()).persist(StorageLevel.DISK_ONLY)
    sums = dealt.groupBy("_range").agg(F.sum(amount).alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_within", F.coalesce(F.sum(amount).over(within), F.lit(0))).join(F.broadcast(offsets), "_range")
    return placed.withColumn(name, (F.col("_offset") + F.col("_within")).cast("long")).drop("_range", "_offset", "_within")
