"""Helpers shared by the corpus operators: stored intermediate tables and connected components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offermart.session import cut_lineage, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def identity(id_col: str, text_col: str) -> list[Column]:
    """``r1, r2``: 128 bits that name a row by its id and text. Rows equal in both share them; null is an empty text."""
    key, text = F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return [F.xxhash64(key, text).alias("r1"), F.xxhash64(text, key).alias("r2")]


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder all executors share."""
    return f"{shared_dir(spark)}/llm-{uuid.uuid4().hex[:12]}/{name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read back: computed once, and safe from lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of every node in the links ``(a, b)``: the smallest node it is connected with.

    Alternates the large-star and small-star steps, in which every node is tied to its smallest known neighbour, until
    the links no longer change. The number of rounds grows with the logarithm of the longest chain. Only ``(a, b)``
    pairs move; each round is a checkpoint, so a lost executor costs at most one round.
    """
    cur = cut_lineage(
        links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    before = None
    while True:
        state = cur.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before or state[0] == 0:
            return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        before = state
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        tied = large.join(small, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur = cut_lineage(tied.unionByName(small.select("a", F.col("m").alias("b"))).distinct())
