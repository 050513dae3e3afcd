"""Stored postings of search texts: which offers hold a word, appended per delivery, so that a search reads no text.

A posting is a word and an offer. Postings lie in parts by the hash of their word and sorted within them, so a lookup reads the parts of its words and
from those files only the row groups that hold them. All words of a query must occur: the offers of the rarest word are cut down by the others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offermart.operators.market import search_words, word_array

PARTS = 64  # of the words, by their hash; never changed for a folder


def _part(word: str) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(PARTS)).cast("int")


def append_postings(offers: DataFrame, path: str, batch: str | int, key: str = "id_offre", text: str = "recherche_text") -> None:
    """Adds the distinct words of every offer below ``batch=``; the same batch sent again replaces its folder. Offers of a batch are new ones."""
    rows = offers.select(key, F.explode(F.array_distinct(word_array(F.col(text)))).alias("mot")).where("mot <> ''").withColumn("part", _part("mot"))
    # A common word has many offers: the offer is part of the range, so its postings spread over several tasks.
    dealt = rows.repartitionByRange("part", "mot", key).sortWithinPartitions("part", "mot", key)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(f"{path}/batch={batch}")


def read_postings(spark: SparkSession, path: str, words: list[str]) -> DataFrame:
    """``(key, mot)`` of the given words, from their parts alone."""
    asked = spark.createDataFrame([(w,) for w in words], "mot string")
    parts = [r[0] for r in asked.select(_part("mot")).distinct().collect()]
    return spark.read.parquet(path).where(F.col("part").isin(parts) & F.col("mot").isin(words)).drop("part", "batch")


def search_postings(spark: SparkSession, path: str, query: str, key: str = "id_offre") -> DataFrame:
    """Distinct keys of the texts that hold every word of ``query``, as ``market.token_search`` finds them; nothing for a query without words."""
    words = search_words(query)
    if not words:
        return spark.read.parquet(path).select(key).limit(0)
    found = read_postings(spark, path, words)
    sizes = {r["mot"]: r["n"] for r in found.groupBy("mot").agg(F.count("*").alias("n")).collect()}  # one number per word of the query
    if len(sizes) < len(words):
        return found.select(key).limit(0)
    rarest, *others = sorted(words, key=lambda w: (sizes[w], w))
    keys = found.where(F.col("mot") == rarest).select(key).distinct()
    for word in others:
        keys = keys.join(found.where(F.col("mot") == word).select(key), key, "left_semi")
    return keys
