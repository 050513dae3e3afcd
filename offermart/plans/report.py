"""Collector report as one tidy table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offermart import vocab as V
from offermart.operators import market
from offermart.plans.layers import union_sources
from offermart.session import cut_lineage


def _section(name: str, counted: DataFrame, key: str, value: str = "count") -> DataFrame:
    return counted.select(
        F.lit(name).alias("section"), F.col(key).cast("string").alias("cle"), F.col(value).cast("long").alias("n")
    )


def collector_report(raw: DataFrame, unique: DataFrame, source: str) -> DataFrame:
    """``(section, cle, n)`` of a collection: totals, keywords, skills, contracts, places, salaries, duplicates.

    ``raw`` are the collected offers, ``unique`` those kept, which are found once: the columns that are counted are a checkpoint. F counts the tail of
    a place, W the place as it is, A none.
    """
    places = [] if source == V.A else ["lieu"]
    unique = cut_lineage(unique.select("salaire_min", "query_recherche", "competences", "type_contrat", *places))
    totals = unique.agg(
        F.count("*").alias("total"), F.count_if(F.col("salaire_min") != 0).alias("avec_salaire")
    )
    doubles = raw.select(F.lit(1).alias("s")).unionByName(unique.select(F.lit(-1).alias("s"))).agg(F.sum("s").alias("n"))
    parts = [
        _section("total", totals.withColumn("k", F.lit("offres uniques")), "k", "total"),
        _section("salaire", totals.withColumn("k", F.lit("offres avec salaire")), "k", "avec_salaire"),
        _section("doublons", doubles.withColumn("k", F.lit("supprimés")), "k", "n"),
        _section("mot-clé", market.by_keyword(unique), "query_recherche"),
        _section("compétence", market.common_skills(unique, 10), "nom"),
        _section("contrat", market.by_contract(unique), "type_contrat"),
    ]
    if source != V.A:
        parts.append(_section("lieu", market.by_location(unique, 5, source == V.F, "lieu"), "lieu"))
    return union_sources(parts)
