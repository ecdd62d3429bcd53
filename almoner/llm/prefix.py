"""Global prefix sums from per-partition totals, without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almoner.llm.common import partitions, write_table


def ranged(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df dealt out by ranges of `order`, with the range's number as _pid, and as _rank the row's place in it; written."""
    spread = df.repartitionByRange(partitions(df.sparkSession), *order).withColumn("_pid", F.spark_partition_id())
    table = write_table(spread, name)
    return table.withColumn("_rank", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)).cast("long"))


def with_starts(table: DataFrame, order: list[Column], size: str, group: list[str]) -> DataFrame:
    """`table` (from ranged(), whose order begins with `group`) with _start: the sum of `size` over the group's earlier rows; _at: their number.

    Only one row for each range (and group in it) crosses between ranges."""
    inside = Window.partitionBy("_pid", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = table.groupBy("_pid", *group).agg(F.sum(size).alias("_sum"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("_pid").alias("_p"),
        *[F.col(g).alias(f"_of_{g}") for g in group],
        F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_sums"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ns"),
    )
    same = F.col("_pid") == F.col("_p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_of_{g}"))
    summed = table.withColumn("_in", F.sum(size).over(inside) - F.col(size)).withColumn("_k", F.count(F.lit(1)).over(inside) - 1)
    joined = summed.join(totals if group else F.broadcast(totals), same)  # without groups: a row for each range
    return joined.withColumn("_start", F.col("_sums") + F.col("_in")).withColumn("_at", F.col("_ns") + F.col("_k")).drop(
        "_p", "_sums", "_ns", "_in", "_k", *[f"_of_{g}" for g in group]
    )
