"""Distributed global ordering helpers.

A window with an ORDER BY but no PARTITION BY runs in one task; these
helpers give the same row numbers without that: range-partition on the
order keys, sort inside each partition, count rows per partition (a table
with one row per partition), turn the counts into offsets and add the
position inside the partition.  Work and memory per task stay bounded by
the partition size; the only small side is the per-partition count table.

The order keys must be a total order (add a unique key as the last one).
The range bounds are sampled, and the sample depends on the order in which
an upstream shuffle delivers rows, so two evaluations of the same plan may
cut the ranges differently.  The partitioned, positioned rows are therefore
written once with a reliable checkpoint (shared ``spark.checkpoint.dir``)
and both the counts and the numbering read that one copy; this also keeps
the result stable if an executor is lost afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.session import cut_lineage

_POS_BITS = 33  # monotonically_increasing_id = (partition << 33) + position


def global_row_number(df: DataFrame, order_cols: list[str], out: str = "rn",
                      num_partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(
        df.repartitionByRange(n, *order_cols)
          .sortWithinPartitions(*order_cols)
          .withColumn("_pid", F.spark_partition_id())
          .withColumn("_pos", F.monotonically_increasing_id()
                      - F.shiftleft(F.spark_partition_id().cast("long"), _POS_BITS)))
    counts = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # At most n rows: one per range partition.
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn(out, F.col("_off") + F.col("_pos") + 1)
                  .drop("_pid", "_pos", "_off"))
