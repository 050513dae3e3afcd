"""Scores, coercions, defaults and vector arithmetic."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offermart import vocab as V
from offermart.functions.text import blank


def quality_score(length: Column, skills: Column, contract: Column, salary: Column) -> Column:
    """0 to 7: up to 2 for the length of the text, 3 for skills, 1 each for a known contract and salary."""
    return (
        F.when(length > 500, 2).when(length > 100, 1).otherwise(0)
        + F.when(skills >= 5, 3).when(skills >= 3, 2).when(skills >= 1, 1).otherwise(0)
        + F.when(contract != V.NON_SPECIFIE, 1).otherwise(0)
        + F.when(salary.isNotNull(), 1).otherwise(0)
    ).cast("int")


def quality_percent(score: Column) -> Column:
    return F.round(score / 7 * 100, 1)


def display_score(skills: Column) -> Column:
    return F.when(skills > 0, F.least(60 + 2 * skills, F.lit(99))).otherwise(65)


def to_number(col: Column) -> Column:
    return col.try_cast("double")


def to_timestamp(col: Column) -> Column:
    """Wall-clock time of a text or timestamp column; null for empty or unreadable values."""
    return F.nullif(col.cast("string"), F.lit("")).try_cast("timestamp_ntz")


def finite(df: DataFrame) -> DataFrame:
    """NaN and infinities to null in every floating column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    keep = {
        c: F.when(~F.isnan(c) & (F.abs(F.col(c)) != float("inf")), F.col(c)) for c in floats
    }
    return df.withColumns(keep) if keep else df


def at(moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat()).cast("timestamp_ntz")


def run_columns(run_at: dt.datetime) -> dict[str, Column]:
    """Columns of the processing run (not of the publication)."""
    return {
        "date_nettoyage": at(run_at),
        "annee": F.lit(run_at.year),
        "mois": F.lit(run_at.month),
        "jour": F.lit(run_at.day),
    }


def shown_url(col: Column) -> Column:
    return F.when(blank(col), "#").otherwise(col)


def shown_company(col: Column) -> Column:
    return F.coalesce(col, F.lit("Entreprise inconnue"))


def first_tags(skills: Column) -> Column:
    return F.slice(skills, 1, 4)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None) -> Column:
    """Cosine of two vectors. Pass norms that are already computed to avoid computing them per pair."""
    a_len = norm(a) if norm_a is None else norm_a
    b_len = norm(b) if norm_b is None else norm_b
    return F.try_divide(dot(a, b), a_len * b_len)


def harmonic_score(shared: Column, offer_skills: Column, cv_skills: Column) -> Column:
    """Harmonic mean of coverage and relevance; offers with fewer than three skills score half their coverage."""
    coverage = F.coalesce(F.try_divide(shared, offer_skills), F.lit(0.0))
    relevance = F.coalesce(F.try_divide(shared, cv_skills), F.lit(0.0))
    blended = 2 * coverage * relevance / (coverage + relevance + F.lit(1e-9))
    return F.when(offer_skills < 3, coverage * 0.5).otherwise(blended)
