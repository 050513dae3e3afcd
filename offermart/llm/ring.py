"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points of a ring of 65,536 cells. A row's cell is a hash of its identity; the arc that ends in the
next point clockwise is its home. A shard keeps its home rows up to its capacity, in ring order; the rest go on clockwise to the next
point whose shard has room. With no slack the capacities add up to the rows, so every shard ends exactly full.

Rows are ranked within their cell by Spark. Only the number of rows per arc, at most ``shards * points`` numbers whatever
the size of the data, comes to the driver, where the overflow is walked; the ranges it returns are joined back.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offermart.llm.common import stored, table
from offermart.llm.registry import query

CELL_BITS = 16
OVERHEAD = 16  # bytes counted for a row besides its text


def _cell(*parts: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*parts), 64 - CELL_BITS).cast("int")


def ring(spark: SparkSession, shards: int, points: int) -> DataFrame:
    """``(cell, shard)`` of the points; where two fall together the smaller shard has the cell."""
    at = spark.range(shards * points).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.expr(f"id div {shards}").alias("replica")
    )
    return at.groupBy(_cell(F.lit("point"), "shard", "replica").alias("cell")).agg(F.min("shard").alias("shard"))


def capacities(rows: int, shards: int, slack: float) -> list[int]:
    """Without slack the sizes are at most one apart and add up; with slack every shard may take that share more."""
    if slack:
        return [-(-int(rows * (1 + slack)) // shards) + 1] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk(owners: list[int], counts: list[int], room: list[int]) -> list[tuple[int, int, int, int, int]]:
    """``(arc, from, to, shard, slot)``: the ranks of an arc's rows that a shard takes, and the slot of the first.

    ``owners`` names the shard at the end of each arc, clockwise; ``counts`` the rows of the arc. ``room`` is used up.
    """
    taken, out, over = [0] * len(room), [], []

    def give(arc, lo, hi, shard):
        out.append((arc, lo, hi, shard, taken[shard]))
        taken[shard] += hi - lo
        room[shard] -= hi - lo

    for arc, (shard, n) in enumerate(zip(owners, counts)):
        stay = min(n, room[shard])
        if stay:
            give(arc, 0, stay, shard)
        if n > stay:
            over.append((arc, stay, n))
    open_points = [arc for arc, shard in enumerate(owners) if room[shard]]
    for arc, lo, n in over:
        at = next((k for k, p in enumerate(open_points) if p > arc), 0)
        while lo < n:
            shard = owners[open_points[at]]
            hi = min(n, lo + room[shard])
            give(arc, lo, hi, shard)
            lo = hi
            if not room[shard]:
                here = open_points[at]
                open_points = [p for p in open_points if room[owners[p]]]
                at = next((k for k, p in enumerate(open_points) if p > here), 0)
    return out


def place(
    docs: DataFrame, shards: int, points: int = 100, slack: float = 0.0, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, size, text_crc32, shard, slot)`` per row of ``docs``; slots count from 0 in each shard without gaps.

    The identity of a row is its id, size and checksum, so a null or repeated id spreads by its texts. Equal rows are
    folded before they are moved and unfolded at the end. A null text has no bytes and checksum 0. An empty table gives
    an empty result. Other columns are ignored.
    """
    if shards < 1 or points < 1 or slack < 0:
        raise ValueError("shards and points must be positive, slack not negative")
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    classes = stored(rows.groupBy("id", "size", "text_crc32").agg(F.count("*").alias("n")), "ring-classes")
    spot = F.xxhash64("id", "text_crc32", "size")
    classes = classes.withColumn("spot", spot).withColumn("cell", _cell("id", "text_crc32", "size"))

    # The ring and the rows per cell: 65,536 rows at most, whatever the data.
    nodes = ring(spark, shards, points)
    clockwise = Window.orderBy("cell")
    cells = spark.range(1 << CELL_BITS).select(F.col("id").cast("int").alias("cell"))
    cells = cells.join(nodes, "cell", "left").join(classes.groupBy("cell").agg(F.sum("n").alias("n")), "cell", "left")
    before = F.count("shard").over(clockwise.rowsBetween(Window.unboundedPreceding, -1))
    cells = cells.select("cell", "shard", F.coalesce("n", F.lit(0)).alias("n"), before.alias("point"))
    n_points = F.count("shard").over(Window.partitionBy())
    cells = cells.withColumn("arc", (F.col("point") % n_points).cast("int"))
    # The first arc runs across the origin: its cells at the far end come first.
    along = Window.partitionBy("arc").orderBy(F.col("point").desc(), "cell")
    cells = stored(
        cells.withColumn("past", F.sum("n").over(along) - F.col("n")).select("cell", "arc", "past", "n", "shard"),
        "ring-cells",
    )
    arcs = cells.groupBy("arc").agg(F.sum("n").alias("n"), F.max("shard").alias("shard")).orderBy("arc").collect()
    owners, counts = [r["shard"] for r in arcs], [r["n"] for r in arcs]
    ranges = walk(owners, counts, capacities(sum(counts), shards, slack))
    told = F.from_json(
        F.lit(json.dumps(ranges and [dict(zip(("arc", "lo", "hi", "shard", "slot"), r)) for r in ranges])),
        "array<struct<arc int, lo long, hi long, shard int, slot long>>",
    )
    ranges_df = spark.range(1).select(F.inline(told))

    in_cell = Window.partitionBy("cell").orderBy("spot", "id", "size", "text_crc32")
    ranked = classes.withColumn("first", F.sum("n").over(in_cell) - F.col("n"))
    ranked = ranked.join(F.broadcast(cells.select("cell", "arc", "past")), "cell")
    ranked = ranked.withColumn("first", F.col("first") + F.col("past"))
    meets = (F.col("lo") < F.col("first") + F.col("n")) & (F.col("first") < F.col("hi"))
    shared = ranked.join(F.broadcast(ranges_df), "arc").where(meets)
    from_, to = F.greatest("lo", "first"), F.least("hi", F.col("first") + F.col("n"))
    slot = F.explode(F.sequence(F.col("slot") + from_ - F.col("lo"), F.col("slot") + to - F.col("lo") - 1))
    return shared.select("id", "size", "text_crc32", "shard", slot.alias("slot"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Writes ``id, text, slot`` into one folder per shard, in slot order within each file."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.crc32(text).alias("text_crc32"))
    texts = texts.dropDuplicates(["id", "text_crc32"])
    same = placed["id"].eqNullSafe(texts["id"]) & (placed["text_crc32"] == texts["text_crc32"])
    out = placed.join(texts, same, "left").select(placed["id"], "text", "shard", "slot")
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


@query(tested_by="tests/llm/test_text_operators.py")
def op4_ring(spark, sf_dir):
    placed = place(table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
