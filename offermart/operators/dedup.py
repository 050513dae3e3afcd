"""Duplicate removal: by id (first or last), and greedy by id and fingerprint."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offermart.functions.text import fingerprint
from offermart.operators.ranking import top_per_group
from offermart.session import cut_lineage


def first_by_id(df: DataFrame, key: str = "id", order: str = "ord") -> DataFrame:
    return top_per_group(df, [key], [F.col(order).asc()], 1)


def last_by_id(df: DataFrame, key: str = "id", order: str = "ord") -> DataFrame:
    return top_per_group(df, [key], [F.col(order).desc()], 1)


def greedy_unique(df: DataFrame, key: str = "id", order: str = "ord") -> DataFrame:
    """Rows kept by a pass in order that drops a row when its id or fingerprint belongs to a row kept before.

    The same set is found in rounds. A row that comes first among the undecided rows of its id and of its
    fingerprint is certain to be kept; every undecided row that shares a key with it is certain to go. Each round
    decides at least the first undecided row, so the rounds end, whatever the size. Only ``(order, id, fingerprint)`` moves,
    and rows equal in both keys are folded to the first one beforehand, so repeated offers do not travel at all.
    """
    fp = fingerprint(F.col("titre"), F.col("entreprise"), F.col("lieu"))
    narrow = df.select(F.col(order).alias("o"), F.col(key).alias("k"), fp.alias("f"))
    kept = _greedy_orders(narrow)
    return df.join(kept, F.col(order) == kept["o"], "left_semi")


def _greedy_orders(rows: DataFrame) -> DataFrame:
    undecided = cut_lineage(rows.groupBy("k", "f").agg(F.min("o").alias("o")))
    kept_parts = [undecided.select("o").limit(0)]
    while not undecided.isEmpty():
        # One row per key on both sides: a hot key cannot skew this join.
        by_key = undecided.groupBy("k").agg(F.min("o").alias("o"))
        by_fp = undecided.groupBy("f").agg(F.min("o").alias("o"))
        first = by_key.join(by_fp, "o")
        kept = cut_lineage(first.select("o", "k", "f"))
        kept_parts.append(kept.select("o"))
        # The kept side is unique per key; AQE splits a hot key on the undecided side.
        rest = undecided.join(kept.select("k"), "k", "left_anti").join(kept.select("f"), "f", "left_anti")
        undecided = cut_lineage(rest)
    out = kept_parts[0]
    for part in kept_parts[1:]:
        out = out.unionByName(part)
    return out


def duplicate_stats(df: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: rows read, rows kept, duplicates and their share."""
    tagged = df.select(F.lit(0).alias("kept")).unionByName(kept.select(F.lit(1).alias("kept")))
    counts = tagged.agg(
        F.count_if(F.col("kept") == 0).alias("total"), F.count_if(F.col("kept") == 1).alias("uniques")
    )
    share = F.coalesce(F.try_divide(F.col("doublons"), F.col("total")), F.lit(0.0))
    return counts.withColumn("doublons", F.col("total") - F.col("uniques")).withColumn("taux", F.round(share, 4))
