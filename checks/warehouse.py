"""Queries over the star schema: its build, and the market questions it answers."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import layers
from checks import sql_layers as L
from checks.views import CANDIDATES_CTE, candidate_skills, candidates, offers_raw, query, stored, table
from offermart.operators import dedup, market, postings
from offermart.operators import star as S
from offermart.session import shared_dir
from offermart.sinks import load_star


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Gold table, stored as a daily run leaves it; ``ord`` is the load order."""
    path = stored(spark, sf_dir, "gold", lambda p: layers.gold(spark, sf_dir).write.parquet(p))
    return spark.read.parquet(path)


def warehouse(spark: SparkSession, sf_dir: str) -> S.Star:
    """The star schema, loaded from Gold and read back."""
    path = stored(spark, sf_dir, "star", lambda p: load_star(gold(spark, sf_dir), p))
    return S.read_star(spark, path)


def _array(name: str):
    return F.array_join(name, "|").alias(name)


# Build ----------------------------------------------------------------------------------------------------------


@query(f"{L.WITH_STAR} SELECT CAST(id_entreprise AS INT) AS id_entreprise, nom FROM entreprises")
def dim_company(spark, sf_dir):
    return S.company_dimension(gold(spark, sf_dir))


@query(f"{L.WITH_STAR} SELECT CAST(id_competence AS INT) AS id_competence, nom FROM competences")
def dim_skill(spark, sf_dir):
    return S.skill_dimension(gold(spark, sf_dir))


@query(
    f"{L.WITH_STAR}, old AS (SELECT DISTINCT entreprise AS nom FROM gold WHERE entreprise <> 'Non spécifié' AND source = 'adzuna') "
    "SELECT CAST(row_number() OVER (ORDER BY nom) AS INT) AS id_entreprise, nom FROM old UNION ALL "
    "SELECT CAST((SELECT count(*) FROM old) + row_number() OVER (ORDER BY nom) AS INT), nom FROM entreprises "
    "WHERE nom NOT IN (SELECT nom FROM old)"
)
def dim_company_extended(spark, sf_dir):
    rows = gold(spark, sf_dir)
    old = S.company_dimension(rows.filter(F.col("source") == "adzuna"))
    return S.company_dimension(rows, existing=old)


FACT_OUT = ", ".join(
    f"CAST({c} AS INT) AS {c}" if c in ("id_entreprise", "salaire_mensuel", "description_length", "score_qualite") else c
    for c in S.FACT_COLUMNS
)


@query(f"{L.WITH_STAR} SELECT {FACT_OUT} FROM offres")
def fact_upsert(spark, sf_dir):
    rows = gold(spark, sf_dir)
    fact = S.fact_offers(rows, S.company_dimension(rows))
    return fact.withColumn("score_qualite_pct", F.col("score_qualite_pct").cast("double"))


@query(f"{L.WITH_STAR} SELECT id_offre, CAST(id_competence AS INT) AS id_competence FROM offre_competence")
def bridge(spark, sf_dir):
    rows = gold(spark, sf_dir)
    return S.bridge(rows, S.skill_dimension(rows))


@query(
    f"{L.WITH_STAR} SELECT 'table' AS section, 'offres' AS cle, count(*) AS n FROM offres UNION ALL "
    "SELECT 'table', 'entreprises', count(*) FROM entreprises UNION ALL SELECT 'table', 'competences', count(*) FROM competences "
    "UNION ALL SELECT 'table', 'offre_competence', count(*) FROM offre_competence "
    "UNION ALL SELECT 'source', source, count(*) FROM offres GROUP BY source"
)
def load_summary(spark, sf_dir):
    return S.load_summary(warehouse(spark, sf_dir))


# Every offer id or place that is too long once a long suffix is added to some rows.
_LONG = "CASE WHEN ord % 5 = 1 THEN repeat('x', CAST(ord % 700 AS INT)) ELSE '' END"


@query(
    f"{L.WITH_GOLD}, padded AS (SELECT CASE WHEN ord % 50 = 3 THEN NULL WHEN ord % 10 = 6 THEN id || {_LONG} ELSE id END AS id, "
    f"lieu_original || {_LONG} AS lieu_original, ord FROM gold) SELECT motif, count(*) AS n FROM (SELECT CASE WHEN id IS NULL "
    "THEN 'id_offre absent' WHEN length(id) > 255 THEN 'id_offre > 255' WHEN length(lieu_original) > 500 THEN 'lieu_original > 500' "
    "ELSE 'valide' END AS motif FROM padded) GROUP BY motif"
)
def rejects(spark, sf_dir):
    padded = gold(spark, sf_dir).withColumns(
        {
            "lieu_original": F.expr(f"lieu_original || {_LONG}"),
            "id": F.expr(f"CASE WHEN ord % 50 = 3 THEN NULL WHEN ord % 10 = 6 THEN id || {_LONG} ELSE id END"),
        }
    )
    valid, bad = S.split_rejects(padded)
    counted = bad.groupBy("motif").agg(F.count("*").alias("n"))
    return counted.unionByName(valid.agg(F.count("*").alias("n")).select(F.lit("valide").alias("motif"), "n"))


# Offers ---------------------------------------------------------------------------------------------------------

CARDS = """cards AS (SELECT o.id_offre, o.titre_clean, e.nom AS entreprise, o.ville, o.salaire_mensuel, o.source, o.url,
 o.type_contrat, o.date_scraping, o.description_clean, list_sort(list_filter(list(DISTINCT c.nom), lambda x: x IS NOT NULL)) AS l
 FROM offres o LEFT JOIN entreprises e USING (id_entreprise) LEFT JOIN offre_competence oc ON o.id_offre = oc.id_offre
 LEFT JOIN competences c ON oc.id_competence = c.id_competence GROUP BY ALL)"""
CARD_OUT = (
    "id_offre, titre_clean, entreprise, ville, CAST(salaire_mensuel AS INT) AS salaire_mensuel, source, url, "
    "array_to_string(l, '|') AS competences, CAST(CASE WHEN len(l) > 0 THEN least(60 + 2 * len(l), 99) ELSE 65 END AS INT) AS score_match"
)
NEWEST = "ORDER BY date_scraping DESC NULLS FIRST, id_offre"


@query(f"{L.WITH_STAR}, {CARDS} SELECT {CARD_OUT} FROM cards")
def offer_cards(spark, sf_dir):
    cards = market.offer_cards(warehouse(spark, sf_dir))
    shown = cards.withColumn("score_match", market.display_score(F.size("competences")))
    return shown.select(*market.CARD_COLUMNS, _array("competences"), "score_match")


@query(
    f"{L.WITH_STAR}, {CARDS} SELECT id_offre, CASE WHEN entreprise IS NULL THEN 'JI' ELSE upper(substr(entreprise, 1, 1) || "
    "coalesce(substr(split_part(entreprise, ' ', 2), 1, 1), '')) END AS initiales, titre_clean AS titre, "
    "coalesce(entreprise, 'Entreprise inconnue') AS entreprise, array_to_string(l[1:4], '|') AS tags, coalesce(url, '#') AS url, "
    "CAST(CASE WHEN len(l) > 0 THEN least(60 + 2 * len(l), 99) ELSE 65 END AS INT) AS score_match FROM cards"
)
def shown_cards(spark, sf_dir):
    shown = market.shown_cards(market.offer_cards(warehouse(spark, sf_dir)))
    return shown.withColumn("tags", F.array_join("tags", "|"))


@query(f"{L.WITH_STAR}, {CARDS} SELECT {CARD_OUT} FROM cards WHERE titre_clean IS NOT NULL {NEWEST} LIMIT 10")
def recent(spark, sf_dir):
    return market.recent(warehouse(spark, sf_dir)).withColumn("competences", F.array_join("competences", "|"))


@query(
    f"{L.WITH_STAR}, {CARDS} SELECT {CARD_OUT}, type_contrat FROM cards WHERE titre_clean ILIKE '%scientist%' OR "
    f"description_clean ILIKE '%scientist%' {NEWEST} LIMIT 50"
)
def search(spark, sf_dir):
    found = market.search(warehouse(spark, sf_dir), "scientist")
    return found.withColumn("competences", F.array_join("competences", "|"))


@query(
    f"{L.WITH_STAR} SELECT id_offre FROM offres WHERE list_has_all(string_split_regex(recherche_text, '[^\\p{{L}}\\p{{N}}_]+'), "
    "['engineer', 'spark', 'mission'])"
)
def token_search(spark, sf_dir):
    return market.token_search(warehouse(spark, sf_dir).offres, "des Engineer avec Spark et une mission").select("id_offre")


@query(
    f"{L.WITH_STAR} SELECT id_offre FROM offres WHERE list_has_all(string_split_regex(recherche_text, '[^\\p{{L}}\\p{{N}}_]+'), "
    "['engineer', 'spark', 'mission'])"
)
def token_postings(spark, sf_dir):
    """The same search over stored postings, which came in two deliveries, the second of them sent twice."""
    offers, path = warehouse(spark, sf_dir).offres, f"{shared_dir(spark)}/offermart-postings-{uuid.uuid4().hex[:12]}"
    for batch, mine in ((0, F.col("source") == "adzuna"), (1, F.col("source") != "adzuna"), (1, F.col("source") != "adzuna")):
        postings.append_postings(offers.filter(mine), path, batch)
    return postings.search_postings(spark, path, "des Engineer avec Spark et une mission")


@query(
    "SELECT doc_id FROM documents WHERE list_has_all(string_split_regex(lower(text), '[^\\p{L}\\p{N}_]+'), ['license', 'mit'])"
)
def token_search_documents(spark, sf_dir):
    return market.token_search(table(spark, sf_dir, "documents"), "MIT license", "text").select("doc_id")


# Skills ---------------------------------------------------------------------------------------------------------

COUNTS = (
    "counts AS (SELECT nom, count(DISTINCT id_offre) AS count FROM competences JOIN offre_competence USING (id_competence) "
    "GROUP BY nom)"
)


@query(f"{L.WITH_STAR}, {COUNTS} SELECT nom, count FROM counts ORDER BY count DESC, nom LIMIT 12")
def top_skills(spark, sf_dir):
    return market.top_skills(warehouse(spark, sf_dir))


@query(f"{L.WITH_STAR}, {COUNTS} SELECT nom FROM counts ORDER BY count DESC, nom LIMIT 5")
def top_skill_names(spark, sf_dir):
    return market.top_skill_names(warehouse(spark, sf_dir))


@query(
    f"{L.WITH_STAR}, {COUNTS} SELECT nom, count, CAST(round(count * 100.0::DOUBLE / max(count) OVER ()) AS INT) AS pct FROM counts "
    "ORDER BY count DESC, nom LIMIT 12"
)
def skill_bars(spark, sf_dir):
    return market.skill_bars(market.top_skills(warehouse(spark, sf_dir)))


@query(f"{L.WITH_GOLD} SELECT nom, count(*) AS count FROM (SELECT unnest(skills) AS nom FROM gold) GROUP BY nom ORDER BY count DESC, nom LIMIT 10")
def common_skills(spark, sf_dir):
    return market.common_skills(gold(spark, sf_dir))


# Aggregates -----------------------------------------------------------------------------------------------------


@query(f"{L.WITH_STAR} SELECT count(*) AS total FROM offres")
def total_offers(spark, sf_dir):
    return market.total_offers(warehouse(spark, sf_dir).offres)


@query(f"{L.WITH_STAR} SELECT count(*) AS total FROM offres WHERE titre_clean IS NOT NULL")
def titled_offers(spark, sf_dir):
    return market.titled_total(warehouse(spark, sf_dir).offres)


@query(f"{L.WITH_STAR} SELECT source, count(*) AS nb FROM offres GROUP BY source")
def by_source(spark, sf_dir):
    return market.by_source(warehouse(spark, sf_dir).offres)


@query(f"{L.WITH_STAR} SELECT type_contrat, count(*) AS count FROM offres GROUP BY type_contrat ORDER BY count DESC, type_contrat LIMIT 10")
def by_contract(spark, sf_dir):
    return market.by_contract(warehouse(spark, sf_dir).offres, 10)


@query(
    f"{L.RAW}, u AS (SELECT CASE WHEN contains(lieu, ' - ') THEN split_part(lieu, ' - ', -1) ELSE lieu END AS lieu FROM offers_raw "
    "WHERE source = 'france_travail') SELECT lieu, count(*) AS count FROM u GROUP BY lieu ORDER BY count DESC, lieu LIMIT 5"
)
def by_location_tail(spark, sf_dir):
    rows = offers_raw(spark, sf_dir).filter(F.col("source") == "france_travail")
    return market.by_location(rows, tail=True, column="lieu")


@query(f"{L.WITH_STAR} SELECT lieu_original AS lieu, count(*) AS count FROM offres GROUP BY 1 ORDER BY count DESC, lieu LIMIT 5")
def by_location(spark, sf_dir):
    return market.by_location(warehouse(spark, sf_dir).offres)


@query(f"{L.WITH_GREEDY} SELECT query_recherche, count(*) AS count FROM offers_raw WHERE ord IN (SELECT ord FROM greedy) GROUP BY 1")
def by_keyword(spark, sf_dir):
    return market.by_keyword(dedup.greedy_unique(offers_raw(spark, sf_dir)))


@query(
    f"{L.WITH_STAR} SELECT CAST(coalesce(round_even(avg(salaire_mensuel), 0), 0) AS BIGINT) AS avg_salary, "
    "CAST(min(salaire_mensuel) AS BIGINT) AS min_salary, CAST(max(salaire_mensuel) AS BIGINT) AS max_salary FROM offres "
    "WHERE titre_clean ILIKE '%data engineer%' OR titre_original ILIKE '%data engineer%'"
)
def salary_stats(spark, sf_dir):
    return market.salary_stats(warehouse(spark, sf_dir).offres, "data engineer")


ROLE_SQL = " UNION ALL ".join(
    f"SELECT {'NULL' if r is None else L.q(r)} AS role, CAST(coalesce(round_even(avg(salaire_mensuel), 0), 0) AS BIGINT) AS avg_salary, "
    "CAST(coalesce(min(salaire_mensuel), 0) AS BIGINT) AS min_salary, CAST(coalesce(max(salaire_mensuel), 0) AS BIGINT) AS max_salary FROM offres "
    + ("" if r is None else f"WHERE titre_clean ILIKE '%{r}%' OR titre_original ILIKE '%{r}%'")
    for r in (None, "data scientist", "data engineer", "data analyst", "ml engineer", "data architect")
)


@query(f"{L.WITH_STAR} {ROLE_SQL}")
def salary_by_role(spark, sf_dir):
    return market.salary_by_role(warehouse(spark, sf_dir).offres, market.V.ROLES)


def growth_sql(source: str, column: str, as_of: str) -> str:
    return (
        f"SELECT recent, past, round_even((recent - past) / past * 100, 1) AS growth FROM (SELECT "
        f"count(*) FILTER ({column} > TIMESTAMP '{as_of}' - INTERVAL 30 DAY) AS recent, "
        f"greatest(count(*) FILTER ({column} < TIMESTAMP '{as_of}' - INTERVAL 60 DAY), 1) AS past FROM {source})"
    )


@query(f"{L.WITH_STAR} {growth_sql('offres', 'date_scraping', '1997-06-01 00:00:00')}")
def growth(spark, sf_dir):
    return market.growth(warehouse(spark, sf_dir).offres, dt.datetime(1997, 6, 1))


@query(growth_sql("events", "ts", "2024-03-20 12:00:00"))
def growth_events(spark, sf_dir):
    return market.growth(table(spark, sf_dir, "events"), dt.datetime(2024, 3, 20, 12), "ts")


@query(
    f"{L.WITH_STAR} SELECT *, round(avec_titre * 100 / total, 1) AS part_titre, round(avec_ville * 100 / total, 1) AS part_ville, "
    "round(avec_salaire * 100 / total, 1) AS part_salaire FROM (SELECT count(*) AS total, count(*) FILTER (titre_clean <> '') AS avec_titre, "
    "count(*) FILTER (ville <> 'Non spécifié') AS avec_ville, count(salaire_mensuel) AS avec_salaire FROM offres)"
)
def completeness(spark, sf_dir):
    return market.completeness(warehouse(spark, sf_dir).offres)


@query(
    f"{L.WITH_GOLD} SELECT 'entreprises' AS quoi, count(DISTINCT entreprise) AS n FROM gold UNION ALL "
    "SELECT 'villes', count(DISTINCT ville) FROM gold WHERE ville <> 'Non spécifié'"
)
def distincts(spark, sf_dir):
    return market.distincts(gold(spark, sf_dir))


@query(
    f"{L.WITH_GOLD} SELECT round_even(avg(salaire_mensuel), 0) AS salaire_moyen, CAST(sum(nb_competences) AS BIGINT) AS total_competences, "
    "round(avg(nb_competences), 1) AS competences_par_offre, round(avg(score_qualite), 1) AS score_moyen FROM gold"
)
def means(spark, sf_dir):
    return market.means(gold(spark, sf_dir))


# Candidates -----------------------------------------------------------------------------------------------------


@query(
    f"WITH {CANDIDATES_CTE} SELECT id_utilisateur, array_to_string(list_sort(list_transform(list(nom_competence), "
    "lambda x: coalesce(x, '<null>'))), '|') AS competences FROM candidates LEFT JOIN candidate_skills USING (id_utilisateur) "
    "GROUP BY id_utilisateur"
)
def user_skills(spark, sf_dir):
    rows = market.user_skills(candidates(spark, sf_dir), candidate_skills(spark, sf_dir))
    return rows.withColumn("competences", F.array_join("competences", "|", "<null>"))


@query(
    f"WITH {CANDIDATES_CTE} SELECT nom_competence, count(DISTINCT id_utilisateur) AS nb_utilisateurs, "
    "round(avg(annee_experience), 1) AS experience_moyenne FROM candidate_skills GROUP BY nom_competence"
)
def skill_users(spark, sf_dir):
    return market.skill_users(candidate_skills(spark, sf_dir))


@query(
    f"{L.WITH_GREEDY} SELECT t AS total, u AS uniques, t - u AS doublons, round((t - u) / t, 4) AS taux FROM "
    "(SELECT count(*) AS t FROM offers_raw), (SELECT count(*) AS u FROM greedy)"
)
def duplicate_rate_greedy(spark, sf_dir):
    raw = offers_raw(spark, sf_dir)
    return dedup.duplicate_stats(raw, dedup.greedy_unique(raw))
