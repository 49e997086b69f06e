"""Running totals over a global order, without a task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.runtime import materialize


def running_total(df: DataFrame, order: list[str], value: str, out: str, partitions: int | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over all rows up to and including this one, in the order of ``order``.

    The rows are range-partitioned once; each partition is summed, the sums (one row a partition) give every
    partition's start, and a window runs inside each partition only. ``order`` must end in a unique column, so that
    ranges can be cut anywhere. Nulls in ``value`` count as 0; an empty table gives an empty table.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The partition number must not change between the two reads, so the ranged table is written once.
    ranged = materialize(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranged")
    worth: Column = F.coalesce(F.col(value), F.lit(0))
    sums = ranged.groupBy("_part").agg(F.sum(worth).alias("_sum"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # n rows
    starts = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranged.join(F.broadcast(starts), "_part")  # at most n rows
        .withColumn(out, F.col("_start") + F.sum(worth).over(inside))
        .drop("_part", "_start")
    )
