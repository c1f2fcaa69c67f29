"""Row numbers over a whole table, or over groups of any size, without gathering them in one task.

``ROW_NUMBER() OVER (ORDER BY ...)`` without an outer limit is one task in Spark, and with PARTITION BY one
task for each key. Here the rows are range-partitioned by the order, sorted inside each partition, and each
partition's numbers start behind the rows of the partitions before it: a prefix sum of one count a partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from ..session import cut_lineage


def _orderable(t: DataType) -> bool:
    if isinstance(t, (MapType, VariantType)):
        return False
    if isinstance(t, ArrayType):
        return _orderable(t.elementType)
    if isinstance(t, StructType):
        return all(_orderable(f.dataType) for f in t.fields)
    return True


def row_numbers(df: DataFrame, order: list[Column], name: str = "rn", keys: tuple[str, ...] = (),
                partitions: int | None = None) -> DataFrame:
    """``df`` with ``name`` (long, from 1): the row's number in ``order``, inside its ``keys`` if there are any.

    Nulls stand where ``order`` puts them (Spark's default: first when ascending); null keys are a group of
    their own. Rows that tie in ``order`` are numbered by their other columns, equal rows in any order, so a
    value that a third of the rows share is spread over partitions too. An empty table stays empty; a column
    named like ``name`` is replaced.
    """
    df = df.drop(name)
    spark = df.sparkSession
    n_parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rest = [F.col(f"`{f.name}`") for f in df.schema.fields if _orderable(f.dataType)]
    by = [*[F.col(f"`{k}`") for k in keys], *order, *rest, F.col("__tie")]
    ranged = df.withColumn("__tie", F.monotonically_increasing_id()).repartitionByRange(n_parts, *by).sortWithinPartitions(*by)
    # written once: the numbers below are read from what was written, also after an executor is lost
    placed = cut_lineage(ranged.drop("__tie").select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at")))
    runs = placed.groupBy(*keys, "__part").agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n"))
    if keys:
        before = Window.partitionBy(*keys).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        runs = runs.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__part").alias("__p"), "__first",
                           F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
        same = F.col("__part") == F.col("__p")
        for i, k in enumerate(keys):
            same = same & F.col(f"`{k}`").eqNullSafe(F.col(f"__k{i}"))
        joined = placed.join(runs, same)
    else:
        total, rows = 0, []  # one row a partition, at most n_parts of them
        for r in sorted(runs.collect(), key=lambda r: r["__part"]):
            rows.append((r["__part"], r["__first"], total))
            total += r["__n"]
        offsets = spark.createDataFrame(rows, "__part int, __first long, __before long")
        joined = placed.join(F.broadcast(offsets), "__part")
    number = (F.col("__at") - F.col("__first") + F.col("__before") + 1).alias(name)
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], number)
