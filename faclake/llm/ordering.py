"""Numbering the rows of a table by an order, without a task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import keep

_LOW = (1 << 33) - 1          # monotonically_increasing_id: partition above, row number in these bits


def numbered(df: DataFrame, order: list[Column], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with ``position``, the 0-based place of each row in ``order``.

    ``df`` must come from stored files (a scan), because rows that are equal under
    ``order`` are told apart by their place in the scan: a large group of equal rows
    spreads over partitions too.  Rows are dealt by range, sorted in their partition
    and written; a partition's rows start where those before it end, which takes one
    count a partition.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("scan__", F.monotonically_increasing_id())
    order = [*order, F.col("scan__").asc()]
    dealt = (placed.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("scan__")
             .withColumn("part__", F.spark_partition_id())
             .withColumn("at__", F.monotonically_increasing_id().bitwiseAND(F.lit(_LOW))))
    kept = keep(dealt, name)
    counts = kept.groupBy("part__").agg(F.count(F.lit(1)).alias("n__"))          # a row a partition
    before = counts.select("part__", (F.sum("n__").over(Window.orderBy("part__")) - F.col("n__")).alias("before__"))
    return (kept.join(F.broadcast(before), "part__")
            .withColumn("position", (F.col("before__") + F.col("at__")).cast("long")).drop("part__", "at__", "before__"))
