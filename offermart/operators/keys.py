"""Dense surrogate keys without a single-partition sort.

Names are dealt out by ranges and sorted within them, once; that narrow table is a checkpoint. A key is the number of names in
the ranges before, plus the place within the range. The number of ranges follows the size of the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offermart.session import cut_lineage

# ``monotonically_increasing_id`` is the number of the partition, shifted by so many bits, plus the place of the row.
PLACE_BITS = 33


def dense_keys(names: DataFrame, name: str, key: str, start: Column | int = 0) -> DataFrame:
    """``names`` (distinct, no nulls) with ``key`` = ``start`` + 1, 2, … in name order."""
    ordered = names.select(name).repartitionByRange(name).sortWithinPartitions(name)
    placed = cut_lineage(ordered.withColumn("_at", F.monotonically_increasing_id()))
    placed = placed.select(
        name, F.shiftright("_at", PLACE_BITS).alias("_range"), F.col("_at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).alias("_place")
    )
    sizes = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    # One row per range, so an unpartitioned window is safe here.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    keyed = placed.join(F.broadcast(offsets), "_range")
    return keyed.select((F.col("_before") + F.col("_place") + 1 + F.lit(start)).cast("int").alias(key), name)


def extend_dimension(existing: DataFrame | None, names: DataFrame, name: str, key: str) -> DataFrame:
    """Existing rows unchanged plus the new names, whose keys go on after the greatest one."""
    if existing is None:
        return dense_keys(names, name, key)
    greatest = existing.agg(F.max(key)).first()[0] or 0
    fresh = names.join(existing.select(name), name, "left_anti")
    return existing.select(key, name).unionByName(dense_keys(fresh, name, key, greatest))
