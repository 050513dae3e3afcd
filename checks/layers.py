"""Queries over Bronze, Silver and Gold."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sql_layers as L
from checks.views import RUN_AT, offers_raw, query, spread, table
from offermart import vocab as V
from offermart.functions import labels, skills, text
from offermart.functions.values import finite, to_number
from offermart.operators import dedup
from offermart.operators.terms import find_terms
from offermart.plans import layers


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layers.gold_all(offers_raw(spark, sf_dir), RUN_AT)


def _silver(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    raw = offers_raw(spark, sf_dir)
    return layers.silver(raw.filter(F.col("source") == source), source, RUN_AT).drop("ord")


@query(f"{L.WITH_A} SELECT {L.SILVER_OUT} FROM silver_a")
def silver_a(spark, sf_dir):
    return _silver(spark, sf_dir, V.A)


@query(f"{L.WITH_F} SELECT {L.SILVER_OUT.replace(', query_recherche, url', '')} FROM silver_f")
def silver_f(spark, sf_dir):
    return _silver(spark, sf_dir, V.F)


@query(f"{L.WITH_W} SELECT {L.SILVER_OUT} FROM silver_w")
def silver_w(spark, sf_dir):
    return _silver(spark, sf_dir, V.W)


@query(f"{L.WITH_GOLD} SELECT id, ord, array_to_string(skills, '|') AS competences, CAST(nb_competences AS INT) AS nb_competences FROM gold")
def gold_skills(spark, sf_dir):
    rows = gold(spark, sf_dir)
    return rows.select("id", "ord", F.array_join("competences", "|").alias("competences"), "nb_competences")


@query(f"{L.WITH_GOLD} SELECT id, ord, CAST(score_qualite AS INT) AS score_qualite, score_qualite_pct FROM gold")
def gold_score(spark, sf_dir):
    return gold(spark, sf_dir).select("id", "ord", "score_qualite", "score_qualite_pct")


@query(f"{L.WITH_GOLD} SELECT id, ord, recherche_text FROM gold")
def search_text(spark, sf_dir):
    return gold(spark, sf_dir).select("id", "ord", "recherche_text")


@query(
    f"{L.RAW} SELECT ord, {L.experience('description', V.EXPERIENCE_A)} AS niveau_a, "
    f"{L.experience('description', V.EXPERIENCE_F)} AS niveau_f, {L.experience('description', V.EXPERIENCE_W)} AS niveau_w "
    "FROM offers_raw"
)
def experience(spark, sf_dir):
    level = {f"niveau_{n}": labels.experience_level(F.col("description"), s) for n, s in zip("afw", V.SOURCES)}
    return offers_raw(spark, sf_dir).select("ord", *[c.alias(n) for n, c in level.items()])


@query(
    f"{L.RAW} SELECT ord, CASE WHEN regexp_matches(lower(description), '{L.EDGE_L}(cdi|permanent){L.EDGE_R}') THEN 'CDI' "
    f"WHEN regexp_matches(lower(description), '{L.EDGE_L}(cdd|contract){L.EDGE_R}') THEN 'CDD' "
    f"WHEN regexp_matches(lower(description), '{L.EDGE_L}(freelance|indépendant){L.EDGE_R}') THEN 'Freelance' "
    f"WHEN regexp_matches(lower(description), '{L.EDGE_L}(stage|alternance|internship){L.EDGE_R}') THEN 'Stage' "
    "ELSE 'Non spécifié' END AS du_texte, CASE type_contrat WHEN 'CDI' THEN 'CDI' WHEN 'CDD' THEN 'CDD' WHEN 'MIS' THEN 'Intérim' "
    "WHEN 'SAI' THEN 'Saisonnier' WHEN 'LIB' THEN 'Freelance' WHEN 'CCE' THEN 'Freelance' ELSE 'Non spécifié' END AS du_code, "
    "CASE WHEN contains(description, 'CDI') THEN 'CDI' WHEN contains(description, 'CDD') THEN 'CDD' WHEN contains(description, 'Freelance') "
    "THEN 'Freelance' WHEN contains(description, 'Stage') THEN 'Stage' WHEN contains(description, 'Alternance') THEN 'Alternance' "
    "WHEN contains(description, 'Intérim') THEN 'Intérim' WHEN contains(description, 'VIE') THEN 'VIE' ELSE 'Non spécifié' END AS de_la_carte "
    "FROM offers_raw"
)
def contract_text(spark, sf_dir):
    return offers_raw(spark, sf_dir).select(
        "ord",
        labels.contract_from_text(F.col("description")).alias("du_texte"),
        labels.contract_from_code(F.col("type_contrat")).alias("du_code"),
        labels.contract_from_card(F.col("description")).alias("de_la_carte"),
    )


@query(
    f"{L.RAW} SELECT ord, CASE WHEN coalesce(entreprise, '') = '' THEN 'JI' ELSE upper(substr(entreprise, 1, 1) || "
    "coalesce(substr(split_part(entreprise, ' ', 2), 1, 1), '')) END AS initiales, "
    r"lower(regexp_replace(titre, '[^\p{L}\p{N}_]+', '_', 'g')) AS slug, "
    "CASE WHEN contains(lieu, ' - ') THEN split_part(lieu, ' - ', -1) ELSE lieu END AS lieu_final, substr(description, 1, 300) AS extrait "
    "FROM offers_raw"
)
def text_helpers(spark, sf_dir):
    return offers_raw(spark, sf_dir).select(
        "ord",
        text.initials(F.col("entreprise")).alias("initiales"),
        F.lower(text.slug(F.col("titre"))).alias("slug"),
        text.location_tail(F.col("lieu")).alias("lieu_final"),
        text.snippet(F.col("description")).alias("extrait"),
    )


@query(f"{L.RAW} SELECT id, ord, titre FROM offers_raw QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1")
def dedup_first(spark, sf_dir):
    return dedup.first_by_id(offers_raw(spark, sf_dir)).select("id", "ord", "titre")


@query(f"{L.RAW} SELECT id, ord, titre FROM offers_raw QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord DESC) = 1")
def dedup_last(spark, sf_dir):
    return dedup.last_by_id(offers_raw(spark, sf_dir)).select("id", "ord", "titre")


@query(
    f"{L.RAW} SELECT count(*) AS total, count(DISTINCT id) AS uniques, count(*) - count(DISTINCT id) AS doublons, "
    "round((count(*) - count(DISTINCT id)) / count(*), 4) AS taux FROM offers_raw"
)
def duplicate_rate(spark, sf_dir):
    raw = offers_raw(spark, sf_dir)
    return dedup.duplicate_stats(raw, dedup.first_by_id(raw.select("id", "ord")))


@query(f"{L.WITH_GREEDY} SELECT id, ord, titre, entreprise, lieu FROM offers_raw WHERE ord IN (SELECT ord FROM greedy)")
def dedup_greedy(spark, sf_dir):
    kept = dedup.greedy_unique(offers_raw(spark, sf_dir))
    return kept.select("id", "ord", "titre", "entreprise", "lieu")


DOC_TERMS = {"license": "license", "mit": "mit", "apache": "apache", "the": "the", "les": "les", "que": "que"}


@query(
    f"SELECT doc_id, array_to_string({L.skill_list('text', DOC_TERMS)}, '|') AS mots, "
    f"array_to_string({L.substring_list('text', list(DOC_TERMS))}, '|') AS fragments FROM documents"
)
def doc_terms(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id",
        F.array_join(skills.extract_skills(F.col("text"), DOC_TERMS), "|").alias("mots"),
        F.array_join(skills.extract_skills(F.col("text"), list(DOC_TERMS)), "|").alias("fragments"),
    )


NESTED_TERMS = {"License": "license", "MIT License": "mit license", "Apache License": "apache license", "Public License": "public license",
                "General Public License": "general public license", "Rights": "rights", "All rights": "all rights", "cc": "cc"}


@query(f"SELECT doc_id, array_to_string({L.skill_list('text', NESTED_TERMS)}, '|') AS mots FROM documents")
def doc_nested_terms(spark, sf_dir):
    """Terms that lie inside others."""
    found = skills.extract_skills(F.col("text"), NESTED_TERMS)
    return spread(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", F.array_join(found, "|").alias("mots"))


# Every fourth text says something about tools; the terms are all words of the conversations, all pairs of neighbours in the benchmark, and a few more.
_TOOLS = "text || CASE doc_id % 4 WHEN 0 THEN ' Node.js, C++ (ml-ops)' WHEN 1 THEN ' c+ .net C++11 node js' WHEN 2 THEN ' mlops; c++.' ELSE '' END"
FEW_TERMS = ["C", "C++", "Node.js", "node", "js", "MLOps", "ml-ops", "ML", "ops", ".NET", "c++11", "+", "é"]
_WORD = r"[\p{L}\p{N}_]+"


def vocabulary_table(spark, sf_dir):
    words = F.regexp_extract_all(F.lower("text"), F.lit(_WORD), F.lit(0))
    pairs = F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat_ws(" ", F.element_at("w", i), F.element_at("w", i + 1)))
    single = table(spark, sf_dir, "conversations").select(F.explode(words).alias("terme"))
    double = table(spark, sf_dir, "benchmark").select(words.alias("w")).where(F.size("w") > 1).select(F.explode(pairs).alias("terme"))
    return single.unionByName(double).unionByName(spark.createDataFrame([(t,) for t in FEW_TERMS], "terme string")).distinct()


@query(
    rf"""WITH words AS (SELECT regexp_extract_all(lower(text), '{_WORD}') AS w FROM benchmark),
    terms AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '{_WORD}')) AS terme FROM conversations
      UNION SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
      UNION SELECT unnest({FEW_TERMS})),
    texts AS (SELECT doc_id, lower({_TOOLS}) AS t FROM documents),
    cut AS (SELECT doc_id, regexp_extract_all(t, '{_WORD}') AS w, regexp_extract_all(t, '{_WORD}([^\p{{L}}\p{{N}}_]*)', 1) AS g FROM texts),
    runs AS (SELECT DISTINCT doc_id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || g[i] || w[i + 1]))) AS run FROM cut),
    plain AS (SELECT doc_id, terme FROM runs JOIN terms ON run = lower(terme)
      WHERE regexp_full_match(terme, '[\p{{L}}\p{{N}}_](.*[\p{{L}}\p{{N}}_])?')),
    signed AS (SELECT doc_id, terme FROM texts, (VALUES ('C++', '(^|[^\p{{L}}\p{{N}}_])c\+\+($|[^\p{{L}}\p{{N}}_])'),
      ('.NET', '(^|[^\p{{L}}\p{{N}}_])\.net($|[^\p{{L}}\p{{N}}_])')) AS v(terme, p) WHERE regexp_matches(t, p))
    SELECT doc_id, terme FROM plain UNION SELECT doc_id, terme FROM signed"""
)
def doc_vocabulary(spark, sf_dir):
    """Terms of a large table in all documents, signs and neighbours included."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.expr(_TOOLS).alias("text"))
    # Texts that come in many parts stay where they are read.
    parts = 4 * spark.sparkContext.defaultParallelism
    docs = docs if docs.rdd.getNumPartitions() >= parts else spread(docs, "doc_id")
    return find_terms(docs, "doc_id", "text", vocabulary_table(spark, sf_dir))


@query(
    "SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE value END AS valeur, CASE WHEN event_id % 3 = 0 THEN NULL ELSE "
    "CAST(value AS DOUBLE) END AS nombre FROM events"
)
def numbers(spark, sf_dir):
    """Numbers out of texts, and finite ones only: unreadable texts, NaN and infinities become null."""
    broken = F.when(F.col("event_id") % 10 == 0, F.lit(float("nan"))).when(F.col("event_id") % 5 == 0, F.lit(float("-inf")))
    words = F.when(F.col("event_id") % 3 == 0, F.lit("à négocier")).otherwise(F.col("value").cast("string"))
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.coalesce(broken, F.col("value").cast("double")).alias("valeur"), to_number(words).alias("nombre")
    )
    return finite(rows)
