"""Star schema: company and skill dimensions, offer fact, offer-skill bridge."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offermart import schemas as S
from offermart import vocab as V
from offermart.functions.values import finite
from offermart.operators.keys import extend_dimension
from offermart.operators.ranking import top_per_group
from offermart.sources import conform

# Of several rows with one id the first gives every value but these, which the last one gives.
UPDATED = ["titre_clean", "score_qualite", "score_qualite_pct", "description_clean", "date_nettoyage"]
FACT_COLUMNS = S.OFFRES.fieldNames()
FROM_GOLD = [c for c in FACT_COLUMNS if c not in ("id_offre", "id_entreprise")]


@dataclass
class Star:
    entreprises: DataFrame
    competences: DataFrame
    offres: DataFrame
    offre_competence: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {
            "entreprises": self.entreprises,
            "competences": self.competences,
            "offres": self.offres,
            "offre_competence": self.offre_competence,
        }


def company_names(gold: DataFrame) -> DataFrame:
    known = F.col("entreprise").isNotNull() & (F.col("entreprise") != V.NON_SPECIFIE)
    return gold.filter(known).select(F.col("entreprise").alias("nom")).distinct()


def offer_skills(gold: DataFrame) -> DataFrame:
    """One row per offer and skill, over all rows of an id."""
    pairs = gold.select(F.col("id").alias("id_offre"), F.explode("competences").alias("nom"))
    return pairs.filter(F.col("nom").isNotNull() & F.col("id_offre").isNotNull()).dropDuplicates()


def skill_names(gold: DataFrame) -> DataFrame:
    return gold.select(F.explode("competences").alias("nom")).filter(F.col("nom").isNotNull()).distinct()


def company_dimension(gold: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return extend_dimension(existing, company_names(gold), "nom", "id_entreprise")


def skill_dimension(gold: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    return extend_dimension(existing, skill_names(gold), "nom", "id_competence")


def _ends(rows: DataFrame, first: str, last: str) -> DataFrame:
    """``(id_offre, first, last)``: of every id the structs with the smallest and the greatest order ``o``.

    Both ends are cut to one row per id and task before they are shuffled, each with its own columns only, and then meet where they are. Rows dealt by
    id already, such as stored buckets, are not shuffled at all. Orders are unique per row.
    """
    lows = top_per_group(rows.select("id_offre", F.col(first).alias("first")), ["id_offre"], [F.col("first.o").asc()], 1)
    highs = top_per_group(rows.select("id_offre", F.col(last).alias("last")), ["id_offre"], [F.col("last.o").desc()], 1)
    return lows.join(highs, "id_offre")


def upsert_states(gold: DataFrame, order: str = "ord") -> DataFrame:
    """Per id the first and the last row, as structs. States of several batches merge by ``merge_states``."""
    first = F.struct(F.col(order).alias("o"), "entreprise", *[c for c in FROM_GOLD if c not in UPDATED])
    last = F.struct(F.col(order).alias("o"), *UPDATED)
    rows = gold.filter(F.col("id").isNotNull()).select(F.col("id").alias("id_offre"), first.alias("f"), last.alias("l"))
    return _ends(rows, "f", "l")


def merge_states(states: DataFrame) -> DataFrame:
    return _ends(states.select("id_offre", "first", "last"), "first", "last")


def fact_rows(states: DataFrame) -> DataFrame:
    """One row per id with the company name still in place."""
    values = [F.col(f"last.{c}" if c in UPDATED else f"first.{c}").alias(c) for c in FROM_GOLD]
    return states.select("id_offre", F.col("first.entreprise").alias("entreprise"), *values)


def with_company_key(rows: DataFrame, entreprises: DataFrame) -> DataFrame:
    """Name to key; unknown names and the sentinel get none. AQE broadcasts the dimension when it is small."""
    keys = entreprises.select("id_entreprise", F.col("nom").alias("entreprise"))
    return conform(finite(rows.join(keys, "entreprise", "left")), S.OFFRES)


def fact_offers(gold: DataFrame, entreprises: DataFrame, order: str = "ord") -> DataFrame:
    return with_company_key(fact_rows(upsert_states(gold, order)), entreprises)


def bridge(gold: DataFrame, competences: DataFrame) -> DataFrame:
    return key_skills(offer_skills(gold), competences)


def key_skills(pairs: DataFrame, competences: DataFrame) -> DataFrame:
    return pairs.join(competences, "nom").select("id_offre", "id_competence")


def _broken() -> Column:
    """Name of the first constraint a Gold row breaks, null when it breaks none."""
    limits = {**S.MAX_LENGTHS, "entreprise": S.MAX_COMPANY_LENGTH}
    rule = F.when(F.col("id").isNull(), "id_offre absent")
    for column, limit in limits.items():
        name = "id" if column == "id_offre" else column
        rule = rule.when(F.char_length(name) > limit, f"{column} > {limit}")
    return rule


def split_rejects(gold: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that meet the warehouse constraints, and the others with the constraint they break.

    Only the bad rows are left out; the rest of the source is loaded.
    """
    marked = gold.withColumn("motif", _broken())
    return marked.filter(F.col("motif").isNull()).drop("motif"), marked.filter(F.col("motif").isNotNull())


def build_star(gold: DataFrame, existing: Star | None = None, order: str = "ord") -> Star:
    entreprises = company_dimension(gold, existing.entreprises if existing else None)
    competences = skill_dimension(gold, existing.competences if existing else None)
    return Star(entreprises, competences, fact_offers(gold, entreprises, order), bridge(gold, competences))


def table_counts(star: Star) -> DataFrame:
    parts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("cle"), "n") for name, t in star.tables().items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def load_summary(star: Star) -> DataFrame:
    """Row count per table and offers per source, as ``(section, cle, n)``."""
    sources = star.offres.groupBy(F.col("source").alias("cle")).agg(F.count("*").alias("n"))
    return (
        table_counts(star)
        .select(F.lit("table").alias("section"), "cle", "n")
        .unionByName(sources.select(F.lit("source").alias("section"), "cle", "n"))
    )


def read_star(spark, path: str) -> Star:
    return Star(
        *(
            spark.read.schema(schema).parquet(f"{path}/{name}")
            for name, schema in (
                ("entreprises", S.ENTREPRISES),
                ("competences", S.COMPETENCES),
                ("offres", S.OFFRES),
                ("offre_competence", S.OFFRE_COMPETENCE),
            )
        )
    )
