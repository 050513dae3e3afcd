"""Queries that match candidates to offers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sql_layers as L
from checks.views import CANDIDATES_CTE, RUN_AT, candidate_skills, candidates, query, table
from checks.warehouse import warehouse
from offermart import vocab as V
from offermart.functions.values import cosine
from offermart.operators import market, match
from offermart.plans.upload import upload
from offermart.session import shared_dir
from offermart.sinks import recommendation_rows, replace_skills, replace_stored_skills, store_skills


def _candidates(spark: SparkSession, sf_dir: str, defaults: bool = True) -> DataFrame:
    return match.candidate_profiles(candidates(spark, sf_dir), candidate_skills(spark, sf_dir), defaults)


def _cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.offer_cards(warehouse(spark, sf_dir))


def _with_vectors(spark: SparkSession, sf_dir: str, df: DataFrame, number: str) -> DataFrame:
    """A vector from ``embeddings`` for every row, by its number modulo the number of vectors."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vecteur"))
    slot = F.expr(f"pmod({number}, {vectors.count()})")
    return df.withColumn("vec_id", slot).join(vectors, "vec_id").drop("vec_id")


MATCH_CTES = f"""{CANDIDATES_CTE},
wants AS (SELECT id_utilisateur, coalesce(ville_souhaitee, 'Paris') AS ville, coalesce(contrat_souhaite, 'CDI') AS contrat,
  n_cv FROM candidates JOIN (SELECT id_utilisateur, count(DISTINCT nom_competence) AS n_cv FROM candidate_skills GROUP BY 1)
  USING (id_utilisateur)),
o_skills AS (SELECT DISTINCT id_offre, lower(nom) AS s FROM offre_competence JOIN competences USING (id_competence)),
o_sets AS (SELECT id_offre, count(*) AS n_offre, list_sort(list(s)) AS l FROM o_skills GROUP BY id_offre),
c_sets AS (SELECT id_utilisateur, list_sort(list(DISTINCT nom_competence)) AS l FROM candidate_skills GROUP BY id_utilisateur),
set_pairs AS (SELECT c.l AS cl, o.l AS ol, len(list_intersect(c.l, o.l)) AS communs FROM (SELECT DISTINCT l FROM c_sets) c,
  (SELECT DISTINCT l FROM o_sets) o WHERE len(list_intersect(c.l, o.l)) > 0),
shared AS (SELECT c.id_utilisateur, o.id_offre, p.communs FROM c_sets c JOIN set_pairs p ON c.l = p.cl JOIN o_sets o ON o.l = p.ol)"""
WITH_MATCH = f"{L.WITH_STAR},\n{MATCH_CTES}"
BEST = "QUALIFY row_number() OVER (PARTITION BY id_utilisateur ORDER BY score_match DESC, id_offre) <= {k}"


@query(
    f"{WITH_MATCH} SELECT id_utilisateur, id_offre, communs, round(communs / n_offre, 4) AS score_match FROM shared "
    f"JOIN o_sets USING (id_offre) {BEST.format(k=5)}"
)
def match_keyword(spark, sf_dir):
    return match.match_top(_candidates(spark, sf_dir), _cards(spark, sf_dir), 5, match.Scoring("keyword"))


@query(
    f"{WITH_MATCH} SELECT id_utilisateur, id_offre, communs, round(CASE WHEN n_offre < 3 THEN communs / n_offre * 0.5 ELSE "
    "2 * (communs / n_offre * (communs / n_cv)) / (communs / n_offre + communs / n_cv + 1e-9) END, 6) AS score_match FROM shared "
    f"JOIN o_sets USING (id_offre) JOIN wants USING (id_utilisateur) {BEST.format(k=5)}"
)
def match_harmonic(spark, sf_dir):
    return match.match_top(_candidates(spark, sf_dir), _cards(spark, sf_dir), 5, match.Scoring("harmonic"))


FINAL = """vecs AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
cos AS (SELECT a.vec_id AS va, b.vec_id AS vb, list_cosine_similarity(a.e, b.e) AS c FROM vecs a, vecs b),
o_vec AS (SELECT id_offre, CAST(substr(id_offre, 3) AS BIGINT) % (SELECT count(*) FROM embeddings) AS vb FROM offres),
u_vec AS (SELECT id_utilisateur, id_utilisateur % (SELECT count(*) FROM embeddings) AS va FROM wants),
scored AS (SELECT id_utilisateur, id_offre, communs, round_even(round(100 * (0.5::DOUBLE * c + 0.35::DOUBLE * (communs / n_offre)
  + 0.15::DOUBLE * ((CASE WHEN w.contrat = f.type_contrat THEN 1.0 ELSE 0.0 END)::DOUBLE
  + (CASE WHEN contains(lower(f.ville), lower(w.ville)) THEN 1.0 ELSE 0.5 END)::DOUBLE) / 2), 6), 1) AS score_match
  FROM shared JOIN o_sets USING (id_offre) JOIN wants w USING (id_utilisateur) JOIN offres f USING (id_offre)
  JOIN o_vec USING (id_offre) JOIN u_vec USING (id_utilisateur) JOIN cos USING (va, vb))"""


def _final(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    users = _with_vectors(spark, sf_dir, _candidates(spark, sf_dir), "id_utilisateur")
    cards = _with_vectors(spark, sf_dir, _cards(spark, sf_dir), "CAST(substr(id_offre, 3) AS BIGINT)")
    return users, cards


TITLED = "CAST(substr(id_offre, 3) AS BIGINT) % 7 <> 0"


def _untitled(cards: DataFrame) -> DataFrame:
    return cards.withColumn("titre_clean", F.when(F.expr(TITLED), F.col("titre_clean")))


@query(f"{WITH_MATCH},\n{FINAL} SELECT id_utilisateur, id_offre, communs, score_match FROM scored {BEST.format(k=3)}")
def match_final(spark, sf_dir):
    users, cards = _final(spark, sf_dir)
    return match.match_top(users, cards, 3)


@query(
    f"{WITH_MATCH},\n{FINAL}, best AS (SELECT * FROM scored WHERE {TITLED} {BEST.format(k=10)}) SELECT id_utilisateur, id_offre, communs, score_match, "
    "titre_clean AS titre, coalesce(e.nom, 'Entreprise inconnue') AS entreprise, f.ville, CAST(salaire_mensuel AS INT) AS salaire, source, "
    "coalesce(url, '#') AS url, array_to_string(list_sort(list_intersect(o_sets.l, c_sets.l)), '|') AS competences_matchees "
    "FROM best JOIN offres f USING (id_offre) LEFT JOIN entreprises e USING (id_entreprise) JOIN o_sets USING (id_offre) "
    "JOIN c_sets USING (id_utilisateur)"
)
def reco_topk(spark, sf_dir):
    """Every seventh offer has lost its title, so it is not recommended."""
    users, cards = _final(spark, sf_dir)
    return match.recommend(users, _untitled(cards), 10).withColumn("competences_matchees", F.array_join("competences_matchees", "|"))


@query(f"{WITH_MATCH} SELECT id_utilisateur, count(*) AS offres FROM shared GROUP BY id_utilisateur")
def shared_offer_counts(spark, sf_dir):
    return match.shared_offer_counts(_candidates(spark, sf_dir), _cards(spark, sf_dir))


# Words by row, their rarity, and cosines of the weighted counts.
WORDS = r"list_filter(string_split_regex(lower({text}), '[^\p{{L}}\p{{N}}_]+'), lambda w: w <> '')"
TERMS = f"""o_words AS (SELECT id_offre, mot, count(*) AS n FROM (SELECT id_offre, unnest({WORDS.format(text="coalesce(recherche_text, '')")}) AS mot
  FROM offres) GROUP BY ALL),
rarity AS (SELECT mot, ln(((SELECT count(*) FROM offres) + 1) / (count(*) + 1)) AS r FROM o_words GROUP BY mot),
o_w AS (SELECT id_offre, mot, n * r AS w FROM o_words JOIN rarity USING (mot)),
o_len AS (SELECT id_offre, sqrt(sum(w * w)) AS l FROM o_w GROUP BY id_offre),
c_words AS (SELECT l AS cl, mot, count(*) AS n FROM (SELECT l, unnest({WORDS.format(text="array_to_string(l, ' ')")}) AS mot
  FROM (SELECT DISTINCT l FROM c_sets)) GROUP BY ALL),
c_w AS (SELECT cl, mot, n * r AS w FROM c_words JOIN rarity USING (mot)),
c_len AS (SELECT cl, sqrt(sum(w * w)) AS l FROM c_w GROUP BY cl),
dots AS (SELECT cl, id_offre, sum(c_w.w * o_w.w) AS d FROM c_w JOIN o_w USING (mot) GROUP BY ALL),
cos AS (SELECT cl, id_offre, CASE WHEN c_len.l * o_len.l = 0 THEN 0 ELSE d / (c_len.l * o_len.l) END AS c FROM dots JOIN c_len USING (cl)
  JOIN o_len USING (id_offre)),
scored AS (SELECT s.id_utilisateur, id_offre, communs, round_even(round(100 * (0.5::DOUBLE * coalesce(c, 0) + 0.35::DOUBLE * (communs / n_offre)
  + 0.15::DOUBLE * ((CASE WHEN w.contrat = f.type_contrat THEN 1.0 ELSE 0.0 END)::DOUBLE
  + (CASE WHEN contains(lower(f.ville), lower(w.ville)) THEN 1.0 ELSE 0.5 END)::DOUBLE) / 2), 6), 1) AS score_match
  FROM shared s JOIN o_sets USING (id_offre) JOIN wants w ON w.id_utilisateur = s.id_utilisateur JOIN offres f USING (id_offre)
  JOIN c_sets ON c_sets.id_utilisateur = s.id_utilisateur LEFT JOIN cos USING (cl, id_offre) WHERE f.titre_clean IS NOT NULL)"""
TERMS = TERMS.replace("LEFT JOIN cos USING (cl, id_offre)", "LEFT JOIN cos ON cos.cl = c_sets.l AND cos.id_offre = f.id_offre").replace(
    "SELECT s.id_utilisateur, id_offre", "SELECT s.id_utilisateur, f.id_offre"
)


@query(f"{WITH_MATCH},\n{TERMS} SELECT id_utilisateur, id_offre, communs, score_match FROM scored {BEST.format(k=5)}")
def reco_term_vectors(spark, sf_dir):
    """Blended recommendations with exact sparse vectors of the skills and of the whole search text, in which no description is cut."""
    cards = _cards(spark, sf_dir).filter(F.col("titre_clean").isNotNull())
    encoder = match.TermEncoder().fit(warehouse(spark, sf_dir).offres, "id_offre", F.col("recherche_text"))
    users = encoder.transform(_candidates(spark, sf_dir), "id_utilisateur", F.array_join("competences", " "))
    offers = encoder.transform(cards, "id_offre", F.col("recherche_text"), only=users)
    return match.match_top(users, offers, 5)


@query(
    f"WITH {CANDIDATES_CTE} SELECT id_utilisateur, coalesce(ville_souhaitee, 'Paris') AS ville, coalesce(contrat_souhaite, 'CDI') AS contrat, "
    "coalesce(l, '') AS competences, l IS NOT NULL AS has_cv FROM candidates LEFT JOIN (SELECT id_utilisateur, "
    "array_to_string(list_sort(list(DISTINCT nom_competence)), '|') AS l FROM candidate_skills GROUP BY 1) USING (id_utilisateur)"
)
def candidate_profiles(spark, sf_dir):
    return _candidates(spark, sf_dir).withColumn("competences", F.array_join("competences", "|"))


# Every third candidate uploads a CV that names one skill.
@query(
    f"WITH {CANDIDATES_CTE}, fresh AS (SELECT id_utilisateur, 'redis' AS nom_competence FROM candidates WHERE id_utilisateur % 3 = 0) "
    "SELECT id_utilisateur, nom_competence FROM candidate_skills WHERE id_utilisateur NOT IN (SELECT id_utilisateur FROM fresh) "
    "UNION ALL SELECT id_utilisateur, nom_competence FROM fresh"
)
def replaced_skills(spark, sf_dir):
    users = candidates(spark, sf_dir).filter("id_utilisateur % 3 = 0")
    fresh = users.select("id_utilisateur", F.lit("redis").alias("nom_competence"))
    return replace_skills(candidate_skills(spark, sf_dir).drop("annee_experience"), fresh)


@query(
    f"WITH {CANDIDATES_CTE}, fresh AS (SELECT id_utilisateur, 'redis' AS nom_competence FROM candidates WHERE id_utilisateur % 30 = 0) "
    "SELECT id_utilisateur, nom_competence FROM candidate_skills WHERE id_utilisateur NOT IN (SELECT id_utilisateur FROM fresh) "
    "UNION ALL SELECT id_utilisateur, nom_competence FROM fresh"
)
def stored_skills(spark, sf_dir):
    """The stored skills after some candidates have uploaded a CV, of which only their buckets were replaced."""
    path = f"{shared_dir(spark)}/offermart-skills-{uuid.uuid4().hex[:12]}"
    store_skills(candidate_skills(spark, sf_dir).drop("annee_experience"), path)
    users = candidates(spark, sf_dir).filter("id_utilisateur % 30 = 0")
    replace_stored_skills(path, users.select("id_utilisateur", F.lit("redis").alias("nom_competence")))
    return spark.read.parquet(path).select("id_utilisateur", "nom_competence")


@query(
    f"{WITH_MATCH},\n{FINAL}, best AS (SELECT * FROM scored {BEST.format(k=3)}) SELECT id_utilisateur, id_offre, source, score_match AS "
    "score_recommandation, TIMESTAMP '2024-02-01 06:00:00' AS date_recommandation, false AS est_consulte, false AS est_sauvegarde "
    "FROM best JOIN offres USING (id_offre)"
)
def recommendation_table(spark, sf_dir):
    users, cards = _final(spark, sf_dir)
    rows = recommendation_rows(match.recommend(users, cards, 3), RUN_AT)
    return rows.withColumn("score_recommandation", F.col("score_recommandation").cast("double"))


@query(
    "SELECT a.vec_id AS requete, b.vec_id AS id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 4) AS cosinus "
    "FROM embeddings a, embeddings b QUALIFY row_number() OVER (PARTITION BY requete ORDER BY cosinus DESC, id) <= 5"
)
def cosine_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    vectors = rows.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vecteur"))
    return match.cosine_top(vectors, rows.select(F.col("vec_id").alias("requete"), F.col("embedding").alias("vecteur")), 5)


@query(
    "SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[], list_transform(embedding, lambda x, i: x::DOUBLE + i)::DOUBLE[]), 6) AS cosinus "
    "FROM embeddings"
)
def cosine_column(spark, sf_dir):
    """Cosine of two vector columns, row by row."""
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.transform("embedding", lambda x, i: x.cast("double") + i + 1)
    return rows.select("vec_id", F.round(cosine(F.col("embedding"), shifted), 6).alias("cosinus"))


CV = "'CV : ' || CASE id_utilisateur % 4 WHEN 0 THEN 'Python et SQL' WHEN 1 THEN 'Spark, Kafka; python' WHEN 2 THEN 'cuisine' ELSE 'Docker' END"
CV_SKILLS = (
    f"cvs AS (SELECT id_utilisateur, {CV} AS text FROM candidates WHERE id_utilisateur % 3 = 0), fresh AS "
    f"(SELECT id_utilisateur, lower(unnest({L.substring_list('text', V.SKILLS_CV)})) AS nom_competence FROM cvs)"
)


def _upload(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Every third candidate uploads a CV: all skills afterwards, and the recommendation rows that were appended."""
    people = candidates(spark, sf_dir)
    cvs = people.filter("id_utilisateur % 3 = 0").select(F.col("id_utilisateur").alias("cv_id"), F.expr(CV.replace("id_utilisateur", "cv_id")).alias("text"))
    old = candidate_skills(spark, sf_dir).drop("annee_experience")
    path = f"{shared_dir(spark)}/offermart-upload-{uuid.uuid4().hex[:12]}"
    after, _ = upload(cvs, people, old, _untitled(_cards(spark, sf_dir)), path, RUN_AT, k=3)
    return after, spark.read.parquet(path)


@query(
    f"WITH {CANDIDATES_CTE}, {CV_SKILLS} "
    "SELECT id_utilisateur, nom_competence FROM candidate_skills WHERE id_utilisateur NOT IN (SELECT id_utilisateur FROM fresh) "
    "UNION ALL SELECT id_utilisateur, nom_competence FROM fresh"
)
def cv_upload(spark, sf_dir):
    """Skills of all candidates after every third has uploaded a CV."""
    return _upload(spark, sf_dir)[0].select("id_utilisateur", "nom_competence")


@query(
    f"{L.WITH_STAR},\n{CANDIDATES_CTE}, {CV_SKILLS}, o_skills AS (SELECT DISTINCT id_offre, lower(nom) AS s FROM offre_competence "
    "JOIN competences USING (id_competence)), n_skills AS (SELECT id_offre, count(*) AS n_offre FROM o_skills GROUP BY id_offre), "
    "shared AS (SELECT id_utilisateur, id_offre, count(*) AS communs FROM (SELECT DISTINCT * FROM fresh) JOIN o_skills ON s = nom_competence "
    "GROUP BY ALL), scored AS (SELECT id_utilisateur, id_offre, round_even(round(100 * (0.35::DOUBLE * (communs / n_offre) + 0.15::DOUBLE * "
    "((CASE WHEN coalesce(contrat_souhaite, 'CDI') = type_contrat THEN 1.0 ELSE 0.0 END)::DOUBLE + (CASE WHEN contains(lower(ville), "
    "lower(coalesce(ville_souhaitee, 'Paris'))) THEN 1.0 ELSE 0.5 END)::DOUBLE) / 2), 6), 1) AS score_match FROM shared JOIN n_skills "
    f"USING (id_offre) JOIN offres USING (id_offre) JOIN candidates USING (id_utilisateur) WHERE {TITLED}) "
    "SELECT id_utilisateur, id_offre, source, score_match AS score_recommandation, TIMESTAMP '2024-02-01 06:00:00' AS date_recommandation, "
    f"false AS est_consulte, false AS est_sauvegarde FROM (SELECT * FROM scored {BEST.format(k=3)}) JOIN offres USING (id_offre)"
)
def cv_recommendations(spark, sf_dir):
    """The rows an upload appends, in which no untitled offer is named."""
    return _upload(spark, sf_dir)[1].withColumn("score_recommandation", F.col("score_recommandation").cast("double"))
