"""Bronze to Silver and Gold for each source, as one lazy transform per source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offermart import schemas as S
from offermart import vocab as V
from offermart.functions import labels, salary, skills, text, values
from offermart.operators.dedup import first_by_id
from offermart.sources import conform, tag_source

SILVER_COLUMNS = S.SILVER.fieldNames()
GOLD_COLUMNS = S.GOLD.fieldNames()
# F offers carry neither of these in Silver.
NOT_IN_F = ("query_recherche", "url")


def _filled(source: str) -> dict[str, Column]:
    """Defaults of the raw fields; A also trims its short texts."""

    def default(name: str, value: str) -> Column:
        return F.coalesce(F.col(name), F.lit(value))

    if source == V.A:
        return {
            "id": default("id", "unknown"),
            "titre": text.strip(default("titre", "")),
            "entreprise": text.strip(default("entreprise", V.NON_SPECIFIE)),
            "lieu": text.strip(default("lieu", "France")),
            "description": default("description", ""),
            "type_contrat": default("type_contrat", V.NON_SPECIFIE),
            "query_recherche": default("query_recherche", ""),
            "url": default("url", ""),
        }
    filled = {c: default(c, "") for c in ("titre", "lieu", "type_contrat", "description")}
    if source == V.F:
        return {**filled, "entreprise": default("entreprise", V.NON_SPECIFIE)}
    whole = F.coalesce(F.nullif(F.col("description"), F.lit("")), F.col("description_snippet"), F.lit(""))
    filled |= {c: default(c, "") for c in ("entreprise", "url", "query_recherche")}
    return {**filled, "description": whole}


def gold(bronze: DataFrame, source: str, run_at: dt.datetime, keep: tuple[str, ...] = ("ord",),
         keep_interim: bool = False) -> DataFrame:
    """Gold offers of one source. ``keep`` names extra columns to carry, such as the input order.

    Skills, lengths and search text read the whole description; only the stored ``description_clean`` is cut.
    A offers are de-duplicated by id when the input order is known.
    """
    raw = tag_source(conform(bronze, S.BRONZE, keep), source)
    # W replaces an empty description by the snippet, but reads the salary from its own description only.
    raw = raw.withColumns({**_filled(source), "_own": F.coalesce("description", F.lit(""))})
    if source == V.A and "ord" in raw.columns:
        raw = first_by_id(raw, "id", "ord")
    company = text.clean_company(F.col("entreprise")) if source == V.W else F.col("entreprise")
    found = skills.extract_skills(F.concat_ws(" ", "titre", "description"), skills.ETL[source])
    monthly = salary.monthly_salary(source, F.col("_own"), F.col("titre"), F.col("salaire_min"), F.col("salaire_max"))
    cleaned = raw.select(
        "id",
        F.col("titre").alias("titre_original"),
        text.clean_title(F.col("titre"), source).alias("titre_clean"),
        company.alias("entreprise"),
        F.col("lieu").alias("lieu_original"),
        text.clean_city(F.col("lieu"), source).alias("ville"),
        text.truncate_description(F.col("description")).alias("description_clean"),
        F.char_length("description").alias("description_length"),
        F.col("type_contrat").alias("type_contrat_original"),
        labels.normalize_contract(F.col("type_contrat"), source, keep_interim).alias("type_contrat"),
        monthly.alias("salaire_mensuel"),
        values.to_timestamp(F.col("date_publication")).alias("date_publication"),
        values.to_timestamp(F.col("date_scraping")).alias("date_scraping"),
        *[c.alias(name) for name, c in values.run_columns(run_at).items()],
        "source",
        *[F.lit(None).cast("string").alias(c) if source == V.F else F.col(c) for c in NOT_IN_F],
        found.alias("competences"),
        "description",
        *[c for c in keep if c in raw.columns],
    )
    count = F.size("competences")
    score = values.quality_score(
        F.col("description_length"), count, F.col("type_contrat"), F.col("salaire_mensuel")
    )
    searched = [F.col("titre_original"), F.col("description"), F.col("entreprise")]
    return cleaned.withColumns(
        {
            "nb_competences": count,
            "score_qualite": score,
            "score_qualite_pct": values.quality_percent(score),
            "recherche_text": text.search_text(searched, F.col("competences"), pad_without_skills=source == V.A),
        }
    ).select(*GOLD_COLUMNS, *[c for c in keep if c in raw.columns])


def silver(bronze: DataFrame, source: str, run_at: dt.datetime, keep: tuple[str, ...] = ("ord",),
           keep_interim: bool = False) -> DataFrame:
    """Silver offers: the cleaned columns only; the enrichment is pruned from the plan."""
    full = gold(bronze, source, run_at, keep, keep_interim)
    names = [c for c in SILVER_COLUMNS if not (source == V.F and c in NOT_IN_F)]
    return full.select(*names, *[c for c in keep if c in full.columns])


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """All sources together; columns a source lacks are null. Absent sources are simply not in the list."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def gold_all(bronze: DataFrame, run_at: dt.datetime, keep: tuple[str, ...] = ("ord",)) -> DataFrame:
    """Gold of a table that holds several sources; on a table partitioned by source each branch reads its own part."""
    return union_sources([gold(bronze.filter(F.col("source") == s), s, run_at, keep) for s in V.SOURCES])
