"""The previous value within a group, in a global order, without putting a
group into one task.

A window ``lag`` partitioned by the group sends a whole group to one task; a
group holding a third of all rows would then be one task.  Here the rows are
range-partitioned by (group, order), which splits a hot group over many
range partitions; the lag runs per (range partition, group), so each piece
is bounded by one range partition; and the first row of a group inside a
partition takes its predecessor from the last row of the previous non-empty
partition (a table with one row per partition).  All of it runs in the JVM."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Rows of a range partition, about.
ROWS_PER_PARTITION = 500_000


def _partitions(df: DataFrame, given: int | None) -> int:
    return given or df.count() // ROWS_PER_PARTITION + 1


def lag_in_order(df: DataFrame, group: str, order: str, value: str, out: str,
                 partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = ``value`` of the previous row of the same
    ``group`` by ``order`` (NULL for the first).  ``order`` must be unique
    within a group."""
    from ..session import materialize
    n = _partitions(df, partitions)
    # Range partitions are fixed once (written), so the partition id of a row
    # is the same for the lag and for the boundary table, and under retries.
    ranged = materialize(
        df.select(F.col(group).alias("_g"), F.col(order).alias("_o"), F.col(value).alias("_v"))
          .repartitionByRange(n, "_g", "_o")
          .withColumn("_pid", F.spark_partition_id()))
    local = ranged.withColumn(
        "_prev", F.lag("_v").over(Window.partitionBy("_pid", "_g").orderBy("_o")))
    # Last row of each non-empty partition and, per partition, the last row of
    # the previous non-empty one.  One row per partition: a tiny table.
    ends = ranged.groupBy("_pid").agg(F.max(F.struct("_g", "_o", "_v")).alias("_end"))
    ends = ends.withColumn("_before", F.lag("_end").over(Window.orderBy("_pid")))
    carry = F.broadcast(ends.select("_pid", "_before"))
    # A group that continues from the previous partition starts this one, so a
    # row without a local predecessor whose group matches that last row gets it.
    fixed = (local.join(carry, "_pid", "left")
             .withColumn(out, F.when(F.col("_prev").isNull() & (F.col("_before._g") == F.col("_g")),
                                     F.col("_before._v")).otherwise(F.col("_prev")))
             .select(F.col("_g").alias(group), F.col("_o").alias(order), out))
    return df.join(fixed, [group, order], "left")


def _in_order(df: DataFrame, order: list, partitions: int | None) -> DataFrame:
    """``df`` written in range partitions of the order (sort Columns), with
    ``_pid`` and the row's ``_place`` in its partition.  Written once: the ids
    are the same for whatever is worked out from them."""
    from ..session import materialize
    n = _partitions(df, partitions)
    ranged = materialize(df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                         .withColumn("_id", F.monotonically_increasing_id()))
    pid, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.withColumns({"_pid": pid, "_place": place}).drop("_id")


def _before(sums: DataFrame, value: str) -> DataFrame:
    """Per partition, the sum of ``value`` over all earlier ones: a table with
    one row per partition."""
    earlier = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return F.broadcast(sums.select("_pid", F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias("_offset")))


def rank_in_order(df: DataFrame, order: list, out: str, partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = 1-based position of each row in the global
    ``order`` (sort Columns; end with a unique tie-breaker).

    A ``row_number()`` over an unpartitioned window puts every row in one
    task.  Here rows are range-partitioned and sorted by the order in one
    shuffle; ``monotonically_increasing_id`` then holds the partition and the
    place in it, and each partition is shifted by the rows of all earlier ones
    (a table with one row per partition)."""
    ranged = _in_order(df, order, partitions)
    offsets = _before(ranged.groupBy("_pid").agg(F.count("*").alias("_n")), "_n")
    return (ranged.join(offsets, "_pid")
            .withColumn(out, F.col("_offset") + F.col("_place") + 1)
            .drop("_pid", "_place", "_offset"))


def sum_in_order(df: DataFrame, order: list, value: str, out: str, partitions: int | None = None) -> DataFrame:
    """``df`` plus ``out`` = sum of ``value`` over all rows before this one in
    the global ``order`` (sort Columns).  The running sum is a window per range
    partition, shifted by the sums of the earlier partitions."""
    ranged = _in_order(df, order, partitions)
    local = Window.partitionBy("_pid").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    offsets = _before(ranged.groupBy("_pid").agg(F.sum(value).alias("_n")), "_n")
    return (ranged.withColumn("_run", F.coalesce(F.sum(value).over(local), F.lit(0))).join(offsets, "_pid")
            .withColumn(out, F.col("_offset") + F.col("_run"))
            .drop("_pid", "_place", "_run", "_offset"))
