"""Dense, deterministic surrogate keys without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkmart.sources.staging import stage

# monotonically_increasing_id() documents its layout: partition number above bit 33,
# row position inside the partition below it.
_PARTITION_SHIFT = 33
_POSITION_MASK = (1 << _PARTITION_SHIFT) - 1


def next_base(dim: DataFrame, sk: str) -> Column:
    """The highest key in use (0 for an empty table), as a scalar subquery."""
    return dim.agg(F.coalesce(F.max(sk), F.lit(0).cast("long"))).scalar()


def assign_keys(new: DataFrame, nk: str, sk: str, base: Column | int = 0) -> DataFrame:
    """Adds ``sk`` = base + 1, base + 2, ... in natural-key order.

    ``new`` holds each natural key once. It is range-partitioned and sorted, so the
    key of a row is the number of rows in earlier partitions plus its place in its
    own. The ranged rows are written first: partition numbers then stay what they
    were however often they are read or a task is retried, and the result does not
    depend on where Spark put the range bounds.
    """
    ranged = stage(
        new.repartitionByRange(F.col(nk))
        .sortWithinPartitions(nk)
        .withColumn("_slot", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftrightunsigned("_slot", _PARTITION_SHIFT))
    # One row per range partition, so this window and the broadcast are bounded by
    # the shuffle partition count, not by the data.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    first = F.lit(base) if isinstance(base, int) else base
    position = F.col("_slot").bitwiseAND(F.lit(_POSITION_MASK))
    return ranged.join(F.broadcast(offsets), "_part").select(
        *new.columns, (first + F.col("_before") + position + 1).cast("long").alias(sk)
    )
