"""Positions of rows in a total order inside their group, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written


def positions(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with pos (0-based, nulls first) and n (rows of the group), both long.

    The rows are range-partitioned by (group, order) and sorted inside each partition, so a group that holds
    most rows spreads over many partitions. Only (group, partition) counts are then summed up; rows that
    tie in every order column get positions in an arbitrary, but fixed, order (the sorted table is written).
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    numbered = ranged.withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id())
    numbered = written(numbered, "positions")
    runs = numbered.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    own = Window.partitionBy(group)
    runs = runs.select(group, "_part", "_first", F.sum("_rows").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
                       F.sum("_rows").over(own).alias("n"))
    pos = (F.col("_at") - F.col("_first") + F.coalesce("_before", F.lit(0))).alias("pos")
    return numbered.join(runs, [group, "_part"]).select(*rows.columns, pos, "n")
