"""DuckDB text of the layers and of the star schema, written apart from the Spark code.

Only the fixed tables of ``offermart.vocab`` are shared. RE2 has no Unicode word classes, so boundaries are spelled out.
"""

from __future__ import annotations

from offermart import vocab as V
from checks.views import OFFERS_CTE

EDGE_L = r"(^|[^\p{L}\p{N}_])"
EDGE_R = r"([^\p{L}\p{N}_]|$)"


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def skill_list(text: str, vocabulary: dict[str, str]) -> str:
    """Sorted list of the names found as whole words in ``text`` (an SQL expression)."""
    cases = [
        f"CASE WHEN regexp_matches(lower({text}), {q(EDGE_L + '(' + p + ')' + EDGE_R)}) THEN {q(n)} END"
        for n, p in vocabulary.items()
    ]
    return f"list_sort(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL))"


def substring_list(text: str, terms: list[str]) -> str:
    cases = [f"CASE WHEN contains(lower({text}), {q(t.lower())}) THEN {q(t)} END" for t in terms]
    return f"list_sort(list_filter([{', '.join(cases)}], lambda x: x IS NOT NULL))"


def contract(column: str, table: dict[str, str], unknown: str) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items())
    return f"CASE WHEN coalesce({column}, '') = '' THEN 'Non spécifié' ELSE CASE upper({column}) {cases} ELSE {unknown} END END"


UNITS = {"month": "{n}", "year": "{n} // 12", "kyear": "{n} * 1000 // 12", "day": "{n} * 20"}


def amount(text: str, rules: list[tuple[str, str]]) -> str:
    found = [
        UNITS[unit].format(n=f"TRY_CAST(regexp_extract({text}, {q(p)}, 1) AS BIGINT)") for p, unit in rules
    ]
    return f"coalesce({', '.join(found)})"


def per_month(column: str) -> str:
    return f"CASE WHEN {column} > 10000 THEN {column} // 12 ELSE {column} END"


def experience(text: str, rules: list[tuple[str, str]]) -> str:
    out = []
    for level, pattern in rules:
        words = [w.replace(r"\b", "") for w in pattern.split("|")]
        found = " OR ".join(
            f"regexp_matches(lower({text}), {q((EDGE_L if not w.startswith('5') else EDGE_L) + w + EDGE_R)})"
            for w in words
            if not w.startswith(r"\+")
        )
        out.append(f"WHEN {found} THEN {q(level)}")
    return f"CASE {' '.join(out)} ELSE 'Non spécifié' END"


SCORE = """(CASE WHEN description_length > 500 THEN 2 WHEN description_length > 100 THEN 1 ELSE 0 END
 + CASE WHEN len(skills) >= 5 THEN 3 WHEN len(skills) >= 3 THEN 2 WHEN len(skills) >= 1 THEN 1 ELSE 0 END
 + CASE WHEN type_contrat <> 'Non spécifié' THEN 1 ELSE 0 END + CASE WHEN salaire_mensuel IS NOT NULL THEN 1 ELSE 0 END)"""

_RUN = "TIMESTAMP '2024-02-01 06:00:00' AS date_nettoyage, 2024 AS annee, 2 AS mois, 1 AS jour"
_DATES = "TRY_CAST(date_publication AS TIMESTAMP) AS date_publication, TRY_CAST(date_scraping AS TIMESTAMP) AS date_scraping"

_TITLE_F = (
    r"list_aggregate(list_transform(regexp_extract_all(trim(regexp_replace(titre, '\s*\([H/Fh/f]+\)\s*$', '')), "
    r"'\p{L}+|[^\p{L}]+'), lambda w: upper(w[1]) || lower(w[2:])), 'string_agg', '')"
)
_TITLE_W = (
    r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(titre, "
    r"'\s*\([H/Fh/f\s/]+\s*\)\s*$', ''), '\s*\(CDI\)\s*$', ''), '\s*-\s*\([H/Fh/f]+\s*\)\s*$', ''), "
    r"'\s*[\d.,]+\s*[kK]?\s*€\s*', '', 'g'), '\s+', ' ', 'g'))"
)
_CITY = r"trim(regexp_replace(trim(split_part({c}, ',', 1)), '\d{{5}}', '', 'g'))"
_COMPANY_W = (
    r"CASE WHEN coalesce(entreprise, '') = '' THEN 'Non spécifié' ELSE trim(regexp_replace(regexp_replace("
    r"regexp_replace(entreprise, '\s*\(.*?\)\s*$', ''), '\s+S\.?A\.?S\.?$', ''), '\s+S\.?A\.?$', '')) END"
)

SILVER_A = f"""silver_a AS (
SELECT id, trim(titre) AS titre_original, trim(regexp_replace(titre, '\\s*\\([H/Fh/f]+\\)\\s*$', '')) AS titre_clean,
 trim(coalesce(entreprise, 'Non spécifié')) AS entreprise, lieu AS lieu_original,
 CASE WHEN lieu = 'France' THEN 'Non spécifié' WHEN {_CITY.format(c='lieu')} = '' THEN 'Non spécifié'
  ELSE {_CITY.format(c='lieu')} END AS ville,
 substr(description, 1, 5000) AS description_clean, length(description) AS description_length,
 type_contrat AS type_contrat_original, {contract('type_contrat', V.CONTRACTS_A, 'type_contrat')} AS type_contrat,
 CASE WHEN salaire_min > 0 THEN {per_month('salaire_min')} WHEN salaire_max > 0 THEN {per_month('salaire_max')} END
  AS salaire_mensuel,
 {_DATES}, {_RUN}, source, query_recherche, url, ord, description AS full_text,
 {skill_list("titre || ' ' || description", V.SKILLS_ETL_A)} AS skills, ' ' AS tail
FROM offers_raw WHERE source = 'adzuna' QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1)"""

SILVER_F = f"""silver_f AS (
SELECT id, titre AS titre_original, {_TITLE_F} AS titre_clean, coalesce(entreprise, 'Non spécifié') AS entreprise,
 lieu AS lieu_original,
 coalesce(nullif(regexp_replace({_CITY.format(c='lieu')}, '^[0-9]{{2,3}}\\s*-\\s*', ''), ''), 'Non spécifié') AS ville,
 substr(description, 1, 5000) AS description_clean, length(description) AS description_length,
 type_contrat AS type_contrat_original, {contract('type_contrat', V.CONTRACTS_F, q('Non spécifié'))} AS type_contrat,
 coalesce({amount('lower(description)', V.SALARY_TEXT_F)},
  CASE WHEN salaire_min > 10000 THEN salaire_min // 12 WHEN salaire_min < 10000 AND salaire_min <> 0 THEN salaire_min END)
  AS salaire_mensuel,
 {_DATES}, {_RUN}, source, CAST(NULL AS VARCHAR) AS query_recherche, CAST(NULL AS VARCHAR) AS url, ord,
 description AS full_text, {skill_list("titre || ' ' || description", V.SKILLS_ETL_FW)} AS skills, '' AS tail
FROM offers_raw WHERE source = 'france_travail')"""

SILVER_W = f"""full_w AS (SELECT *, CASE WHEN description = '' THEN description_snippet ELSE description END AS body
 FROM offers_raw WHERE source = 'welcometothejungle'),
silver_w AS (
SELECT id, titre AS titre_original, {_TITLE_W} AS titre_clean, {_COMPANY_W} AS entreprise, lieu AS lieu_original,
 CASE WHEN contains(lower(lieu), 'télétravail') THEN 'Télétravail'
  WHEN contains(lower(lieu), 'france') AND length(lieu) < 15 THEN 'France'
  ELSE coalesce(nullif(trim(split_part(regexp_replace(regexp_replace(lieu, '\\(\\d+\\)', '', 'g'), '\\d{{5}}', '', 'g'), ',', 1)), ''),
   'Non spécifié') END AS ville,
 substr(body, 1, 5000) AS description_clean, length(body) AS description_length,
 type_contrat AS type_contrat_original, {contract('type_contrat', V.CONTRACTS_W, 'upper(type_contrat)')} AS type_contrat,
 coalesce(nullif({amount('lower(description)', V.SALARY_TEXT_W)}, 0), nullif({amount('lower(titre)', V.SALARY_TITLE_W)}, 0),
  CASE WHEN salaire_min > 0 THEN {per_month('salaire_min')} END) AS salaire_mensuel,
 {_DATES}, {_RUN}, source, query_recherche, url, ord, body AS full_text,
 {skill_list("titre || ' ' || body", V.SKILLS_ETL_FW)} AS skills, '' AS tail
FROM full_w)"""

GOLD = f"""gold_rows AS (SELECT * FROM silver_a UNION ALL BY NAME SELECT * FROM silver_f UNION ALL BY NAME SELECT * FROM silver_w),
gold AS (SELECT *, len(skills) AS nb_competences, {SCORE} AS score_qualite, round({SCORE} / 7.0::DOUBLE * 100, 1) AS score_qualite_pct,
 regexp_replace(lower(titre_original || ' ' || full_text || ' ' || entreprise
  || CASE WHEN len(skills) > 0 THEN ' ' || array_to_string(skills, ' ') ELSE tail END), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g')
  AS recherche_text FROM gold_rows)"""

RAW = f"WITH {OFFERS_CTE}"
WITH_A = f"{RAW},\n{SILVER_A}"
WITH_F = f"{RAW},\n{SILVER_F}"
WITH_W = f"{RAW},\n{SILVER_W}"
WITH_GOLD = f"{RAW},\n{SILVER_A},\n{SILVER_F},\n{SILVER_W},\n{GOLD}"

STAR = """entreprises AS (SELECT row_number() OVER (ORDER BY nom) AS id_entreprise, nom FROM
  (SELECT DISTINCT entreprise AS nom FROM gold WHERE entreprise <> 'Non spécifié')),
pairs AS (SELECT DISTINCT id AS id_offre, unnest(skills) AS nom FROM gold),
competences AS (SELECT row_number() OVER (ORDER BY nom) AS id_competence, nom FROM (SELECT DISTINCT nom FROM pairs)),
offre_competence AS (SELECT id_offre, id_competence FROM pairs JOIN competences USING (nom)),
f_first AS (SELECT * FROM gold QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord) = 1),
f_last AS (SELECT * FROM gold QUALIFY row_number() OVER (PARTITION BY id ORDER BY ord DESC) = 1),
offres AS (SELECT f.id AS id_offre, id_entreprise, f.source, f.titre_original, l.titre_clean, f.ville, f.lieu_original,
  f.type_contrat, f.type_contrat_original, f.salaire_mensuel, l.description_clean, f.description_length, l.score_qualite,
  l.score_qualite_pct, f.recherche_text, f.date_publication, f.date_scraping, l.date_nettoyage, f.annee, f.mois, f.jour,
  f.url, f.query_recherche
  FROM f_first f JOIN f_last l ON f.id = l.id LEFT JOIN entreprises e ON f.entreprise = e.nom)"""
WITH_STAR = f"{WITH_GOLD},\n{STAR}"

SILVER_OUT = (
    "id, titre_original, titre_clean, entreprise, lieu_original, ville, description_clean, "
    "CAST(description_length AS INT) AS description_length, type_contrat_original, type_contrat, "
    "CAST(salaire_mensuel AS INT) AS salaire_mensuel, date_publication, date_scraping, date_nettoyage, annee, mois, jour, "
    "source, query_recherche, url"
)

# Offers a greedy pass keeps: rounds of first-in-both-groups rows. Needs WITH RECURSIVE.
GREEDY = """rounds AS (
 SELECT ord, id, lower(titre) || '|' || lower(coalesce(entreprise, '')) || '|' || lower(lieu) AS fp, false AS kept FROM {rows}
 UNION ALL
 SELECT ord, id, fp, first AS kept FROM (
  SELECT *, bool_or(first) OVER (PARTITION BY id) AS ki, bool_or(first) OVER (PARTITION BY fp) AS kf FROM (
   SELECT ord, id, fp, ord = min(ord) OVER (PARTITION BY id) AND ord = min(ord) OVER (PARTITION BY fp) AS first
   FROM rounds WHERE NOT kept))
 WHERE first OR NOT (ki OR kf)),
greedy AS (SELECT ord FROM rounds WHERE kept)"""
WITH_GREEDY = f"WITH RECURSIVE {OFFERS_CTE},\n{GREEDY.format(rows='offers_raw')}"
