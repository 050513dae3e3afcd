"""Raw payloads to the Bronze record of 18 fields."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offermart import schemas as S
from offermart import vocab as V
from offermart.functions import labels, salary, skills, text

BRONZE_COLUMNS = S.BRONZE.fieldNames()


def _or(col: str, default: str) -> Column:
    return F.coalesce(F.col(col), F.lit(default))


def _record(df: DataFrame, source: str, scraped_at: dt.datetime, keep: tuple[str, ...], **fields: Column) -> DataFrame:
    """The common fields around those of a source."""
    fields |= {
        "description_snippet": text.snippet(fields["description"]),
        "devise_salaire": F.lit("EUR"),
        "source": F.lit(source),
        "date_scraping": F.lit(scraped_at.isoformat()),
        "statut": F.lit("active"),
    }
    return df.select(*[fields[c].alias(c) for c in BRONZE_COLUMNS], *keep)


def _amount(col: str) -> Column:
    """Whole euros; zero means unknown."""
    return F.when(F.col(col) != 0, F.col(col).try_cast("int"))


def flatten_a(payloads: DataFrame, scraped_at: dt.datetime, keyword: str = "query_recherche",
              keep: tuple[str, ...] = ()) -> DataFrame:
    title, body = _or("title", ""), _or("description", "")
    return _record(
        payloads, V.A, scraped_at, keep,
        id=F.concat(F.lit(V.ID_PREFIX[V.A]), _or("id", "")),
        titre=title,
        entreprise=_or("company.display_name", V.NON_SPECIFIE),
        lieu=_or("location.display_name", "France"),
        description=body,
        competences=skills.extract_skills(F.concat_ws(" ", title, body), V.SKILLS_COLLECTOR_A),
        salaire_min=_amount("salary_min"),
        salaire_max=_amount("salary_max"),
        type_contrat=labels.contract_from_text(body),
        niveau_experience=labels.experience_level(body, V.A),
        date_publication=_or("created", ""),
        url=_or("redirect_url", ""),
        query_recherche=F.col(keyword),
    )


def flatten_f(payloads: DataFrame, scraped_at: dt.datetime, keyword: str = "query_recherche",
              keep: tuple[str, ...] = ()) -> DataFrame:
    title, body = _or("intitule", ""), _or("description", "")
    bounds = salary.bounds_from_label(F.col("salaire.libelle"))
    declared = F.coalesce(
        F.transform("competences", lambda c: F.coalesce(c["libelle"], F.lit(""))), F.array().cast("array<string>")
    )
    found = skills.extract_skills(F.concat_ws(" ", title, body), V.SKILLS_COLLECTOR)
    return _record(
        payloads, V.F, scraped_at, keep,
        id=F.concat(F.lit(V.ID_PREFIX[V.F]), _or("id", "")),
        titre=title,
        entreprise=_or("entreprise.nom", V.NON_SPECIFIE),
        lieu=_or("lieuTravail.libelle", "France"),
        description=body,
        competences=F.array_sort(F.array_union(declared, found)),
        salaire_min=bounds["salaire_min"],
        salaire_max=bounds["salaire_max"],
        type_contrat=labels.contract_from_code(F.col("typeContrat")),
        niveau_experience=labels.experience_level(body, V.F),
        date_publication=_or("dateCreation", ""),
        url=_or("origineOffre.urlOrigine", ""),
        query_recherche=F.col(keyword),
    )


def build_w(cards: DataFrame, scraped_at: dt.datetime, keep: tuple[str, ...] = ()) -> DataFrame:
    """Record of a card and its detail (columns of ``pages.cards`` and ``pages.details``).

    A card without a detail page (null description) gets its skills from the title and an unknown level.
    """
    body = _or("description", "")
    detailed = F.col("description").isNotNull()
    level = F.when(detailed, labels.experience_level(body, V.W)).otherwise(V.NON_SPECIFIE)
    words = F.when(detailed, body).otherwise(F.col("_titre"))
    return _record(
        cards, V.W, scraped_at, keep,
        id=F.concat(F.lit(V.ID_PREFIX[V.W]), F.col("_id")),
        titre=F.col("_titre"),
        entreprise=F.col("_entreprise"),
        lieu=F.col("_lieu"),
        description=body,
        competences=skills.extract_skills(words, V.SKILLS_COLLECTOR),
        salaire_min=F.col("salaire_min"),
        salaire_max=F.col("salaire_max"),
        type_contrat=F.col("_contrat"),
        niveau_experience=level,
        date_publication=F.lit(""),
        url=F.col("_url"),
        query_recherche=F.col("_keyword"),
    )
