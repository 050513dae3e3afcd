"""The batch behind an uploaded CV: its skills, fresh recommendations, and the rows both leave behind."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offermart.functions.values import at
from offermart.operators import match
from offermart.sinks import append_recommendations, replace_skills


def upload(
    cvs: DataFrame, candidates: DataFrame, skills: DataFrame, cards: DataFrame, path: str, run_at: dt.datetime, k: int = 10
) -> tuple[DataFrame, DataFrame]:
    """Skills of all candidates after the upload, and the recommendations of those who uploaded, appended below ``path``.

    ``cvs`` is ``(cv_id, text)`` with the candidate as id. Candidates whose CV names no known skill keep their old rows.
    Only titled offers are recommended.
    """
    found = match.cv_profiles(cvs).select(
        F.col("cv_id").alias("id_utilisateur"), F.explode(F.transform("competences", F.lower)).alias("nom_competence"),
        F.lit("cv").alias("source_detection"), at(run_at).alias("date_ajout"),
    )
    uploaded = candidates.join(cvs.select(F.col("cv_id").alias("id_utilisateur")), "id_utilisateur", "left_semi")
    profiles = match.candidate_profiles(uploaded, found)
    recommendations = match.recommend(profiles, cards, k)
    append_recommendations(recommendations, path, run_at)
    return replace_skills(skills, found), recommendations
