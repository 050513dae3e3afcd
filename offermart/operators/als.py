"""Collaborative recommendations with alternating least squares."""

from __future__ import annotations

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offermart.operators.keys import dense_keys
from offermart.operators.match import ProductScorer
from offermart.operators.search import search


def best_scores(df: DataFrame, user: str, item: str, score: str) -> DataFrame:
    """Greatest score per user and item, as ``user_id, offre, score``."""
    pairs = df.groupBy(F.col(user).cast("int").alias("user_id"), F.col(item).alias("offre"))
    return pairs.agg(F.max(score).cast("float").alias("score"))


def ratings(recommendations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Ratings ``(user_id, offre_id, score)`` from recommendation rows, and the offers behind the integer ids.

    Ids count from 0 in the order of the offers. They are dense keys, so no list of offers goes through the driver.
    """
    scored = best_scores(recommendations, "id_utilisateur", "id_offre", "score_recommandation")
    ids = dense_keys(scored.select("offre").distinct(), "offre", "offre_id", start=-1)
    return scored.join(ids, "offre").select("user_id", "offre_id", "score"), ids


def train(rows: DataFrame, seed: int = 42, rank: int = 10) -> ALSModel:
    als = ALS(
        maxIter=10, regParam=0.01, rank=rank, seed=seed, coldStartStrategy="drop",
        userCol="user_id", itemCol="offre_id", ratingCol="score",
    )
    return als.fit(rows)


def top_offers(model: ALSModel, n: int = 10, trace: list | None = None) -> DataFrame:
    """``(user_id, offre_id, score, rang)`` of the ``n`` best offers per user; ties go to the smaller offer.

    The score is the product of the factors. Offers lie in cells by direction and length, and a user's factors are multiplied only with
    the cells whose bound reaches the user's ``n``-th score, not with all offers.
    """
    users = model.userFactors.select(F.col("id").alias("query"), F.col("features").alias("vecteur"))
    items = model.itemFactors.select("id", F.col("features").alias("vecteur"))
    best = search(users, items, "id", n, ProductScorer(), "vecteur", cosine=False, trace=trace)
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("value"), F.asc("id")))
    return best.select(
        F.col("query").alias("user_id"), F.col("id").alias("offre_id"), F.col("value").cast("float").alias("score"), rank.alias("rang")
    )
