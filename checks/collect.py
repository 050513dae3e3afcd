"""Queries over raw payloads, saved pages, messages, ratings, streams and the daily run.

Payloads, page sources and messages are derived from every offer of ``offers_raw``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sql_layers as L
from checks import warehouse as W
from checks.views import OFFERS, RUN_AT, offers_in_order, offers_raw, query, spread, stored, table
from offermart import schemas as S
from offermart import streaming
from offermart import vocab as V
from offermart.operators import als, assistant, dedup, pages, raw
from offermart.operators.keys import dense_keys
from offermart.operators.star import load_summary as summary
from offermart.operators.star import table_counts
from offermart.plans import daily, layers, report
from offermart.session import shared_dir
from offermart.sinks import current_star, load_star, publish_star, to_messages, write_layer
from offermart.sources import conform, parse_offers, read_gold_for_day, stream_bronze


def _fresh(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/offermart-{name}-{uuid.uuid4().hex[:12]}"


# Raw payloads ---------------------------------------------------------------------------------------------------


def _through_json(df: DataFrame, schema, keep: list[str]) -> DataFrame:
    """The payload as it arrives: encoded to JSON text and read back with the payload schema."""
    text = df.select(F.to_json(F.struct(*[c for c in df.columns if c not in keep])).alias("value"), *keep)
    return text.select(F.from_json("value", schema).alias("p"), *keep).select("p.*", *keep)


def _payload_a(rows: DataFrame) -> DataFrame:
    return rows.select(
        "id",
        F.col("titre").alias("title"),
        "description",
        F.struct(F.col("entreprise").alias("display_name")).alias("company"),
        F.struct(F.col("lieu").alias("display_name")).alias("location"),
        F.col("salaire_min").cast("double").alias("salary_min"),
        F.col("salaire_max").cast("double").alias("salary_max"),
        F.col("url").alias("redirect_url"),
        F.col("date_publication").alias("created"),
        "query_recherche",
        "ord",
    )


def _payload_f(rows: DataFrame) -> DataFrame:
    label = F.expr("'Annuel de ' || salaire_min || '.0 Euros à ' || salaire_max || ' Euros'")
    only_low = F.expr("'Mensuel de ' || salaire_min || ' Euros'")
    return rows.select(
        "id",
        F.col("titre").alias("intitule"),
        "description",
        F.struct(F.col("entreprise").alias("nom")).alias("entreprise"),
        F.struct(F.col("lieu").alias("libelle")).alias("lieuTravail"),
        F.struct(F.coalesce(label, only_low).alias("libelle")).alias("salaire"),
        F.array(F.struct(F.lit("Gestion").alias("libelle")), F.struct(F.lit("Python").alias("libelle"))).alias("competences"),
        F.col("type_contrat").alias("typeContrat"),
        F.col("date_publication").alias("dateCreation"),
        F.struct(F.col("url").alias("urlOrigine")).alias("origineOffre"),
        "query_recherche",
        "ord",
    )


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumn("competences", F.array_join("competences", "|"))


CONTRACT_FROM_TEXT = (
    f"CASE WHEN regexp_matches(lower(description), '{L.EDGE_L}(cdi|permanent){L.EDGE_R}') THEN 'CDI' "
    f"WHEN regexp_matches(lower(description), '{L.EDGE_L}(cdd|contract){L.EDGE_R}') THEN 'CDD' "
    f"WHEN regexp_matches(lower(description), '{L.EDGE_L}(freelance|indépendant){L.EDGE_R}') THEN 'Freelance' "
    f"WHEN regexp_matches(lower(description), '{L.EDGE_L}(stage|alternance|internship){L.EDGE_R}') THEN 'Stage' ELSE 'Non spécifié' END"
)
COMMON_OUT = (
    "'EUR' AS devise_salaire, '2024-02-01T06:00:00' AS date_scraping, 'active' AS statut, query_recherche, ord, "
    "substr(description, 1, 300) AS description_snippet, description"
)


@query(
    f"{L.RAW} SELECT 'adzuna_' || id AS id, titre, coalesce(entreprise, 'Non spécifié') AS entreprise, lieu, array_to_string("
    f"{L.substring_list("titre || ' ' || description", V.SKILLS_COLLECTOR_A)}, '|') AS competences, nullif(salaire_min, 0) AS salaire_min, "
    f"nullif(salaire_max, 0) AS salaire_max, {CONTRACT_FROM_TEXT} AS type_contrat, {L.experience('description', V.EXPERIENCE_A)} "
    f"AS niveau_experience, coalesce(date_publication, '') AS date_publication, url, 'adzuna' AS source, {COMMON_OUT} FROM offers_raw"
)
def raw_flatten_a(spark, sf_dir):
    payloads = _through_json(_payload_a(offers_raw(spark, sf_dir)), S.RAW_A, ["query_recherche", "ord"])
    return _flat(raw.flatten_a(payloads, RUN_AT, keep=("ord",)))


F_RECORD = (
    "SELECT 'ft_' || id AS id, titre, coalesce(entreprise, 'Non spécifié') AS entreprise, lieu, list_sort(list_distinct(list_concat("
    f"['Gestion', 'Python'], {L.skill_list("titre || ' ' || description", V.SKILLS_COLLECTOR)}))) AS skills, "
    "salaire_min, CASE WHEN salaire_min IS NOT NULL AND salaire_max IS NOT NULL "
    "THEN 0 END AS salaire_max, CASE type_contrat WHEN 'CDI' THEN 'CDI' WHEN 'MIS' THEN 'Intérim' ELSE 'Non spécifié' END AS type_contrat, "
    f"{L.experience('description', V.EXPERIENCE_F)} AS niveau_experience, coalesce(date_publication, '') AS date_publication, url, "
    f"'france_travail' AS source, {COMMON_OUT} FROM offers_raw"
)


@query(f"{L.RAW}, records AS ({F_RECORD}) SELECT * EXCLUDE (skills), array_to_string(skills, '|') AS competences FROM records")
def raw_flatten_f(spark, sf_dir):
    payloads = _through_json(_payload_f(offers_raw(spark, sf_dir)), S.RAW_F, ["query_recherche", "ord"])
    return _flat(raw.flatten_f(payloads, RUN_AT, keep=("ord",)))


NOT_IN_OFFERS = [f.name for f in S.BRONZE.fields if f.name not in OFFERS]


@query(
    f"{L.RAW} SELECT * EXCLUDE (ord), " + ", ".join(f"NULL::VARCHAR AS {c}" for c in NOT_IN_OFFERS) + " FROM offers_raw"
)
def messages_round_trip(spark, sf_dir):
    """Offers encoded as topic messages and decoded again, in all their fields."""
    rows = conform(offers_raw(spark, sf_dir), S.BRONZE)
    return parse_offers(to_messages(rows)).withColumn("competences", F.array_join("competences", "|"))


A_RECORD = (
    f"SELECT 'adzuna_' || id AS id, titre, coalesce(entreprise, 'Non spécifié') AS entreprise, lieu, "
    f"{L.substring_list("titre || ' ' || description", V.SKILLS_COLLECTOR_A)} AS skills, nullif(salaire_min, 0) AS salaire_min, "
    f"{CONTRACT_FROM_TEXT} AS type_contrat, query_recherche, ord FROM offers_raw"
)


def _report_sql(records: str, place: str | None) -> str:
    """The report of one source; ``place`` is what its places are counted by, if they are."""
    places = (
        f", places AS (SELECT {place} AS cle, count(*) AS n FROM u GROUP BY 1 ORDER BY n DESC, cle LIMIT 5)" if place else ""
    )
    return (
        f"WITH RECURSIVE {L.OFFERS_CTE},\nrecords AS ({records}),\n{L.GREEDY.format(rows='records')}, u AS (SELECT * FROM records WHERE ord IN "
        f"(SELECT ord FROM greedy)){places}, words AS (SELECT unnest(skills) AS cle FROM u), top_words AS "
        "(SELECT cle, count(*) AS n FROM words GROUP BY cle ORDER BY n DESC, cle LIMIT 10) "
        "SELECT 'total' AS section, 'offres uniques' AS cle, count(*) AS n FROM u UNION ALL SELECT 'salaire', 'offres avec salaire', "
        "count(*) FILTER (salaire_min <> 0) FROM u UNION ALL SELECT 'doublons', 'supprimés', (SELECT count(*) FROM records) - count(*) FROM u "
        "UNION ALL SELECT 'mot-clé', query_recherche, count(*) FROM u GROUP BY 2 UNION ALL SELECT 'compétence', cle, n FROM top_words "
        "UNION ALL SELECT 'contrat', type_contrat, count(*) FROM u GROUP BY 2"
    ) + (" UNION ALL SELECT 'lieu', cle, n FROM places" if place else "")


def _collected(rows: DataFrame) -> DataFrame:
    """The records as a collector leaves them: read out of their payloads once and stored, however many steps read them."""
    path = _fresh(rows.sparkSession, "collected")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@query(_report_sql(F_RECORD, "CASE WHEN contains(lieu, ' - ') THEN split_part(lieu, ' - ', -1) ELSE lieu END"))
def collector_report(spark, sf_dir):
    rows = _collected(raw.flatten_f(_payload_f(offers_raw(spark, sf_dir)), RUN_AT, keep=("ord",)))
    return report.collector_report(rows, dedup.greedy_unique(rows), V.F)


@query(_report_sql(A_RECORD, None))
def collector_report_a(spark, sf_dir):
    """The report of A, which names no places."""
    payloads = _through_json(_payload_a(offers_raw(spark, sf_dir)), S.RAW_A, ["query_recherche", "ord"])
    rows = _collected(raw.flatten_a(payloads, RUN_AT, keep=("ord",)))
    return report.collector_report(rows, dedup.greedy_unique(rows), V.A)


@query(
    _report_sql(
        "SELECT 'jungle_' || CASE WHEN ord % 5 = 0 THEN id || '_x' ELSE 'co-' || (ord % 7) || '__' || id END AS id, titre, coalesce(entreprise, 'cover') AS entreprise, "
        "CASE WHEN (ord % 2 = 0 AND lieu <> 'France') OR (ord % 2 = 1 AND substr(lieu, 1, 1) <> '7') THEN lieu WHEN type_contrat <> '' THEN type_contrat "
        f"ELSE 'France' END AS lieu, {L.skill_list('titre', V.SKILLS_COLLECTOR)} AS skills, NULL::INT AS salaire_min, CASE WHEN contains(type_contrat, 'CDI') "
        "OR contains(description, 'CDI') OR (ord % 3 < 2 AND contains(titre, 'CDI')) THEN 'CDI' WHEN contains(description, 'CDD') THEN 'CDD' "
        "ELSE 'Non spécifié' END AS type_contrat, query_recherche, ord FROM offers_raw",
        "lieu",
    )
)
def collector_report_w(spark, sf_dir):
    """The report of W over its cards, as they are before the detail pages are read."""
    found = pages.cards(_offer_pages(spark, sf_dir), F.col("query_recherche")).withColumnRenamed("page_id", "ord")
    found = found.withColumns({"description": F.lit(None).cast("string"), "salaire_min": F.lit(None).cast("int"), "salaire_max": F.lit(None).cast("int")})
    rows = _collected(raw.build_w(found, RUN_AT, keep=("ord",)))
    return report.collector_report(rows, dedup.greedy_unique(rows), V.W)


# Pages ----------------------------------------------------------------------------------------------------------

# A card and its detail page for every offer; links, images, places and pay vary with the offer.
HTML = """'<li><img alt="cover"><img src="l.png" alt="' || coalesce(entreprise, '') || '">' ||
 CASE ord % 3 WHEN 0 THEN '<h2 class="t">' || titre || '</h2>' WHEN 1 THEN '<div role="mark">' || titre || '</div>' ELSE '' END ||
 '<a href="/fr/blog">blog</a><a aria-label="Consultez l&#39;offre ' || titre || '" href="' || CASE ord % 4 WHEN 0 THEN 'https://site.example' ELSE '' END ||
 CASE ord % 5 WHEN 0 THEN '/fr/jobs/' || id || '-x' ELSE '/fr/companies/co-' || (ord % 7) || '/jobs/' || id || '?q=1' END || '">voir</a>' ||
 CASE ord % 2 WHEN 0 THEN '<p data-testid="job-location">' || lieu || '</p>' ELSE '<span>12 j</span><span>4 k€</span><span>' || lieu || '</span>' END ||
 '<span>' || type_contrat || '</span></li><main><h1>x</h1>' || CASE ord % 3 WHEN 0 THEN '<section data-testid="job-description"><section class="empty"></section><p>' || description
 || '</p></section>' WHEN 1 THEN '<article><article> </article>' || description || '</article>' ELSE '<p>' || description || '</p>' END
 || CASE ord % 4 WHEN 0 THEN '<b>35K - 45K</b>' WHEN 1 THEN '<b>38 000 € - 42 000 €</b>' WHEN 2 THEN '<b>41 000 € / an</b>' ELSE '' END || '</main>'"""

_BODY = r"trim(regexp_replace(description, '\s+', ' ', 'g'))"
_PAY = "CASE ord % 4 WHEN 0 THEN '35K - 45K' WHEN 1 THEN '38 000 € - 42 000 €' WHEN 2 THEN '41 000 € / an' ELSE '' END"


def _offer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = offers_raw(spark, sf_dir)
    return rows.select(F.col("ord").alias("page_id"), "url", F.expr(HTML).alias("html"), "query_recherche")


# Text of the main part, and the amounts that the first of the patterns to match finds in it; numbers under 500 are thousands.
_MAIN = rf"trim(regexp_replace('x ' || description || ' ' || {_PAY}, '\s+', ' ', 'g'))"


def _page_amount(group: int) -> str:
    number = lambda p: f"TRY_CAST(regexp_replace(regexp_extract(m, {L.q(p)}, {group}), '\\s', '', 'g') AS INT)"
    cases = ""
    for pattern, has_upper in V.SALARY_PAGE_W:
        n = number(pattern) if group == 1 or has_upper else "NULL"
        few = f"{n} < 500" if group == 1 else f"{n} <> 0 AND {n} < 500"
        cases += f" WHEN regexp_matches(m, {L.q(pattern)}) THEN CASE WHEN {few} THEN {n} * 1000 ELSE {n} END"
    return f"CASE{cases} END"


@query(
    f"{L.RAW}, d AS (SELECT *, {_MAIN} AS m, CASE WHEN ord % 3 < 2 AND {_BODY} <> '' THEN {_BODY} ELSE substr(trim(regexp_replace('x ' || description || ' ' "
    rf"|| {_PAY}, '\s+', ' ', 'g')), 1, 3000) END AS body FROM offers_raw) SELECT ord AS page_id, 'jungle_' || CASE WHEN ord % 5 = 0 "
    "THEN id || '_x' ELSE 'co-' || (ord % 7) || '__' || id END AS id, titre, coalesce(entreprise, 'cover') AS entreprise, "
    "CASE WHEN (ord % 2 = 0 AND lieu <> 'France') OR (ord % 2 = 1 AND substr(lieu, 1, 1) <> '7') THEN lieu WHEN type_contrat <> '' THEN type_contrat ELSE 'France' END AS lieu, "
    "body AS description, substr(body, 1, 300) AS description_snippet, "
    f"array_to_string({L.skill_list('body', V.SKILLS_COLLECTOR)}, '|') AS competences, "
    "'EUR' AS devise_salaire, CASE WHEN contains(type_contrat, 'CDI') OR contains(description, 'CDI') OR (ord % 3 < 2 AND contains(titre, 'CDI')) "
    "THEN 'CDI' WHEN contains(description, 'CDD') THEN 'CDD' ELSE 'Non spécifié' END AS type_contrat, "
    f"{L.experience('body', V.EXPERIENCE_W)} AS niveau_experience, '' AS date_publication, "
    "CASE ord % 4 WHEN 0 THEN 'https://site.example' ELSE 'https://www.welcometothejungle.com' END || CASE WHEN ord % 5 = 0 THEN '/fr/jobs/' "
    "|| id || '-x' ELSE '/fr/companies/co-' || (ord % 7) || '/jobs/' || id || '?q=1' END AS url, 'welcometothejungle' AS source, "
    f"{_page_amount(1)} AS salaire_min, {_page_amount(2)} AS salaire_max, "
    "'2024-02-01T06:00:00' AS date_scraping, 'active' AS statut, query_recherche FROM d"
)
def page_records(spark, sf_dir):
    """Bronze records of W from page sources, in all their fields."""
    found = pages.details(pages.cards(_offer_pages(spark, sf_dir), F.col("query_recherche")))
    return _flat(raw.build_w(found, RUN_AT, keep=("page_id",)))


@query(
    f"{L.RAW} SELECT ord AS page_id, CASE ord % 4 WHEN 0 THEN 35000 WHEN 1 THEN 38000 WHEN 2 THEN 41000 END AS salaire_min, "
    "CASE ord % 4 WHEN 0 THEN 45000 WHEN 1 THEN 42000 END AS salaire_max FROM offers_raw"
)
def page_bounds(spark, sf_dir):
    """Salary bounds printed on page sources that hold no other amounts."""
    rows = offers_raw(spark, sf_dir).withColumn("description", F.lit("Poste"))
    html = rows.select(F.col("ord").alias("page_id"), F.expr(HTML).alias("html"))
    return pages.details(html).select("page_id", "salaire_min", "salaire_max")


def _sql_text(x: str) -> str:
    out = f"regexp_replace({x}, '<[^>]+>', ' ', 'g')"
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = f"replace({out}, {L.q(entity)}, {L.q(char)})"
    return rf"trim(regexp_replace({out}, '[\s\p{{Z}}]+', ' ', 'g'))"


_LINK = r"regexp_extract(html, '(?is)<a\b[^>]*href=[" + '"' + r"'']([^" + '"' + r"'']*)[" + '"' + r"'']', 1)"


@query(
    "SELECT page_id, " + _sql_text(r"regexp_extract(html, '(?is)<h1\b[^>]*>(.*?)</h1>', 1)") + " AS titre, "
    f"'https://www.welcometothejungle.com' || {_LINK} AS url, "
    rf"regexp_replace(split_part({_LINK}, '/', -1), '[^\p{{L}}\p{{N}}_]+', '_', 'g') AS id, "
    "'France' AS lieu, 'Non spécifié' AS entreprise, "
    + _sql_text(r"regexp_extract(html, '(?is)<article\b[^>]*>(.*?)</article>', 1)") + " AS description FROM pages"
)
def page_fields(spark, sf_dir):
    """Fields of the given pages, whose title is the main heading."""
    found = pages.details(pages.cards(spread(table(spark, sf_dir, "pages").drop("url"), "page_id"), page_heading=True), any_article=True)
    names = {"_titre": "titre", "_url": "url", "_id": "id", "_lieu": "lieu", "_entreprise": "entreprise"}
    return found.select("page_id", *[F.col(c).alias(n) for c, n in names.items()], "description")


# Assistant ------------------------------------------------------------------------------------------------------

WORDS = [("salaire", ["que", "les"]), ("competences", ["was"]), ("offres", ["ing"]), ("evolution", ["eau", "die"]), ("cv", ["of"])]
SPOKEN = ["of the", "in the", "de la"]


def _first_hit(text: str, rules: list[tuple[str, list[str]]]) -> str:
    cases = " ".join(
        f"WHEN {' OR '.join(f'contains(lower({text}), {L.q(w)})' for w in words)} THEN {L.q(name)}" for name, words in rules
    )
    return f"CASE {cases} END"


@query(
    f"SELECT conv_id, turn, {_first_hit('text', WORDS)} AS intent, CASE WHEN contains(lower(text), 'of the') THEN 'Of The' "
    "WHEN contains(lower(text), 'in the') THEN 'In The' WHEN contains(lower(text), 'de la') THEN 'De La' END AS role_cite FROM conversations"
)
def intents(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations")
    return assistant.classify(rows, "text", WORDS, SPOKEN).select("conv_id", "turn", "intent", "role_cite")


MESSAGE = (
    "CASE ord % 7 WHEN 0 THEN 'Quel salaire pour un ' || lower(titre) || ' ?' WHEN 1 THEN 'Combien gagne-t-on ?' "
    "WHEN 2 THEN 'Quelles compétences apprendre ?' WHEN 3 THEN 'Des postes à ' || lieu || ' ?' WHEN 4 THEN 'Quelle évolution ?' "
    "WHEN 5 THEN 'Relire mon CV de ' || titre ELSE 'Bonjour' END"
)
GROWTH_AT = dt.datetime(1997, 6, 1)
ROLES_SQL = "CASE " + " ".join(f"WHEN contains(lower(m), '{r}') THEN '{r}'" for r in V.ROLES) + " END"


def _sql_answer(template: str, **values: str) -> str:
    out = L.q(template)
    for name, value in values.items():
        out = f"replace({out}, '{{{name}}}', CAST({value} AS VARCHAR))"
    return out


def _title_sql(x: str) -> str:
    return f"CASE {x} " + " ".join(f"WHEN '{r}' THEN '{r.title()}'" for r in V.ROLES) + " END"


@query(
    f"{L.WITH_STAR}, {W.COUNTS}, msgs AS (SELECT ord, {MESSAGE} AS m FROM offers_raw), cl AS (SELECT ord, {_first_hit('m', V.INTENTS)} AS intent, "
    f"{ROLES_SQL} AS role FROM msgs), st AS ({W.ROLE_SQL}), sk AS (SELECT string_agg('• ' || nom, chr(10) ORDER BY count DESC, nom) AS skills "
    "FROM (SELECT * FROM counts ORDER BY count DESC, nom LIMIT 10)), tot AS (SELECT count(*) AS total FROM offres), "
    f"gr AS ({W.growth_sql('offres', 'date_scraping', '1997-06-01 00:00:00')}) "
    f"SELECT ord, intent, {_title_sql('cl.role')} AS role_cite, CASE intent WHEN 'salaire' THEN "
    + _sql_answer(V.ANSWER_SALARY, role=f"coalesce({_title_sql('cl.role')}, 'data')", avg="avg_salary", min="min_salary", max="max_salary")
    + f" WHEN 'competences' THEN {_sql_answer(V.ANSWER_SKILLS, skills='(SELECT skills FROM sk)')}"
    f" WHEN 'offres' THEN {_sql_answer(V.ANSWER_OFFERS, total='(SELECT total FROM tot)')}"
    f" WHEN 'evolution' THEN {_sql_answer(V.ANSWER_GROWTH, growth='(SELECT growth FROM gr)')}"
    f" WHEN 'cv' THEN {L.q(V.ANSWER_CV)} ELSE {L.q(V.ANSWER_DEFAULT)} END AS reponse "
    "FROM cl LEFT JOIN st ON cl.role IS NOT DISTINCT FROM st.role"
)
def answers(spark, sf_dir):
    messages = offers_raw(spark, sf_dir).select("ord", F.expr(MESSAGE).alias("m"))
    facts = assistant.market_facts(W.warehouse(spark, sf_dir), GROWTH_AT)
    return assistant.answer(assistant.classify(messages, "m"), facts).drop("m")


# Ratings --------------------------------------------------------------------------------------------------------


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id_utilisateur"),
        F.concat(F.lit("o_"), F.get_json_object("props", "$.k")).alias("id_offre"),
        F.col("value").alias("score_recommandation"),
    )


@query(
    "WITH r AS (SELECT CAST(user_id AS INT) AS user_id, 'o_' || json_extract_string(props, '$.k') AS offre, max(CAST(value AS FLOAT)) AS score "
    "FROM events GROUP BY ALL), o AS (SELECT offre, row_number() OVER (ORDER BY offre) - 1 AS i FROM (SELECT DISTINCT offre FROM r)) "
    "SELECT user_id, CAST(i AS INT) AS offre_id, CAST(score AS DOUBLE) AS score FROM r JOIN o USING (offre)"
)
def als_ratings(spark, sf_dir):
    return als.ratings(_scored(spark, sf_dir))[0].withColumn("score", F.col("score").cast("double"))


@query()
def als_topn(spark, sf_dir):
    rows, _ = als.ratings(_scored(spark, sf_dir))
    return als.top_offers(als.train(rows), 5)


# Streams --------------------------------------------------------------------------------------------------------


def _bronze_files(spark: SparkSession, sf_dir: str) -> str:
    """Offers as compressed JSON lines, as they are dropped into a watched folder."""
    rows = conform(offers_raw(spark, sf_dir), S.BRONZE)
    return stored(spark, sf_dir, "bronze", lambda p: rows.write.option("compression", "gzip").json(p))


def _drained(stream: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    path = _fresh(spark, name)
    streaming.to_parquet(stream, f"{path}/out", f"{path}/state").start().awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query(f"{L.WITH_F} SELECT {L.SILVER_OUT.replace(', query_recherche, url', '')} FROM silver_f")
def stream_silver(spark, sf_dir):
    arriving = stream_bronze(spark, _bronze_files(spark, sf_dir)).filter(F.col("source") == V.F)
    names = [c for c in layers.SILVER_COLUMNS if c not in layers.NOT_IN_F]
    return _drained(streaming.refined(arriving, V.F, RUN_AT).select(*names), spark, "silver")


@query(f"{L.WITH_W} SELECT {L.SILVER_OUT} FROM silver_w")
def stream_silver_w(spark, sf_dir):
    arriving = stream_bronze(spark, _bronze_files(spark, sf_dir)).filter(F.col("source") == V.W)
    return _drained(streaming.refined(arriving, V.W, RUN_AT).select(*layers.SILVER_COLUMNS), spark, "silver-w")


@query(f"{L.RAW} SELECT DISTINCT id FROM offers_raw")
def stream_unique(spark, sf_dir):
    arriving = stream_bronze(spark, _bronze_files(spark, sf_dir))
    return _drained(streaming.unique_by_id(arriving).select("id"), spark, "unique")


@query(
    "SELECT CAST(ts AS DATE) AS jour, event_type, count(*) AS n FROM events GROUP BY 1, 2 "
    "HAVING CAST(ts AS DATE) + 1 <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY"
)
def stream_daily(spark, sf_dir):
    """Events per day and type; days the watermark has not passed are still open and not counted."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return _drained(streaming.daily_counts(events, time="ts", by="event_type"), spark, "daily")


# Every eleventh event has no readable time; events come in four deliveries, not in the order of their time.
_TIME = "CASE WHEN event_id % 11 = 0 THEN 'bientôt' ELSE CAST(ts AS STRING) END"


@query("SELECT CASE WHEN event_id % 11 <> 0 THEN CAST(ts AS DATE) END AS jour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily_totals(spark, sf_dir):
    """All events per day and type, late and undated ones too; the stream is stopped and started again between two deliveries."""
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", F.expr(_TIME).alias("time"))
    path = _fresh(spark, "totals")
    for deliveries in ((3, 1), (0, 2)):
        for part in deliveries:
            rows.filter(F.expr(f"pmod(xxhash64(event_id), 4) = {part}")).write.parquet(f"{path}/in/{part}")
        # A batch takes as many files as a delivery has, so there are as many batches as deliveries, whatever the size of the table.
        files = max(len(spark.read.parquet(f"{path}/in/{part}").inputFiles()) for part in deliveries)
        arriving = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", files).parquet(f"{path}/in")
        totals = streaming.daily_totals(arriving, time="time", by="event_type")
        streaming.to_latest(totals, f"{path}/out", f"{path}/state").start().awaitTermination()
    return streaming.read_latest(spark, f"{path}/out", ["jour", "event_type"])


@query(f"{L.WITH_A} SELECT {L.SILVER_OUT} FROM silver_a")
def stream_silver_a(spark, sf_dir):
    """A offers that arrive in any order: of every id the first in the order of the load stays, as in a batch."""
    rows = offers_raw(spark, sf_dir).filter(F.col("source") == V.A)
    rows = conform(rows, S.BRONZE, ("ord",))
    path = _fresh(spark, "silver-a")
    rows.repartition(8, F.xxhash64("ord")).write.parquet(f"{path}/in")
    arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3).parquet(f"{path}/in")
    streaming.collect_first(arriving, f"{path}/out", f"{path}/state").start().awaitTermination()
    return layers.silver(streaming.read_first(spark, f"{path}/out"), V.A, RUN_AT).drop("ord")


@query(f"{L.WITH_STAR} SELECT {W.FACT_OUT} FROM offres")
def stream_upsert(spark, sf_dir):
    """Gold files loaded batch by batch, in several micro-batches.

    Keys depend on the batch a company came with; they are resolved to names, and numbered in name order for comparison.
    """
    schema = W.gold(spark, sf_dir).schema
    source = stored(spark, sf_dir, "gold", lambda p: None)
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).parquet(source)
    path = _fresh(spark, "upsert")
    streaming.upsert(rows, path, f"{path}/state").start().awaitTermination()
    star = streaming.read_upserted(spark, path)
    by_name = dense_keys(star.entreprises.select("nom"), "nom", "numero")
    fact = star.offres.join(star.entreprises, "id_entreprise", "left").join(by_name, "nom", "left")
    fact = fact.withColumn("id_entreprise", F.col("numero")).drop("nom", "numero")
    return fact.withColumn("score_qualite_pct", F.col("score_qualite_pct").cast("double"))


@query(
    f"{L.WITH_STAR}, early AS (SELECT DISTINCT entreprise AS nom FROM gold WHERE entreprise <> 'Non spécifié' AND source = 'adzuna'), "
    "late AS (SELECT nom FROM entreprises WHERE nom NOT IN (SELECT nom FROM early)), first AS (SELECT count(*) AS n FROM early) "
    "SELECT nom, row_number() OVER (ORDER BY nom) AS id_entreprise, true AS stable FROM early UNION ALL "
    "SELECT nom, n + row_number() OVER (ORDER BY nom), true FROM late, first"
)
def stream_keys(spark, sf_dir):
    """Companies of an incremental load: keys of the first delivery stay when the second comes, after a replay and in a compacted copy."""
    rows, path = W.gold(spark, sf_dir), _fresh(spark, "keys")
    for part, mine in (("a", F.col("source") == V.A), ("b", F.col("source") != V.A)):
        rows.filter(mine).write.parquet(f"{path}/in/{part}")
        arriving = spark.readStream.schema(rows.schema).option("recursiveFileLookup", True).parquet(f"{path}/in")
        streaming.upsert(arriving, f"{path}/out", f"{path}/state").start().awaitTermination()
    streaming.compact(spark, f"{path}/out", f"{path}/compact")
    kept, packed = (streaming.read_upserted(spark, f"{path}/{p}").entreprises for p in ("out", "compact"))
    first = spark.read.parquet(f"{path}/out/entreprises").filter("batch = 0").select("nom", F.col("id_entreprise").alias("early"))
    same = packed.select("nom", F.col("id_entreprise").alias("packed"))
    stable = (F.col("id_entreprise") == F.col("packed")) & F.coalesce(F.col("early") == F.col("id_entreprise"), F.lit(True))
    out = kept.join(same, "nom", "full").join(first, "nom", "left")
    return out.select("nom", F.col("id_entreprise").cast("long").alias("id_entreprise"), stable.alias("stable"))


@query(
    f"{L.WITH_GOLD} SELECT id, source, titre_clean, nb_competences + 2 AS nb_competences FROM gold WHERE source = 'adzuna'"
)
def gold_of_day(spark, sf_dir):
    """The newest of two runs of a day, below a root that is named like another day; a later day has runs of its own."""
    rows, root = W.gold(spark, sf_dir).drop("ord"), _fresh(spark, "20240205")
    more = F.col("nb_competences")
    for added, run_at in enumerate((RUN_AT, RUN_AT + dt.timedelta(hours=1), RUN_AT + dt.timedelta(days=4)), start=1):
        write_layer(rows.withColumn("nb_competences", (more + added).cast("int")), f"{root}/20240205/gold", run_at)
    day = read_gold_for_day(spark, f"{root}/20240205/gold", V.A, RUN_AT.strftime("%Y%m%d"))
    return day.select("id", "source", "titre_clean", "nb_competences")


# Daily run ------------------------------------------------------------------------------------------------------


@query(
    f"{L.WITH_STAR} SELECT 'table' AS section, 'offres' AS cle, count(*) AS n FROM offres UNION ALL "
    "SELECT 'table', 'entreprises', count(*) FROM entreprises UNION ALL SELECT 'table', 'competences', count(*) FROM competences "
    "UNION ALL SELECT 'table', 'offre_competence', count(*) FROM offre_competence "
    "UNION ALL SELECT 'source', source, count(*) FROM offres GROUP BY source"
)
def daily_run(spark, sf_dir):
    """Bronze, Silver, Gold and star schema written and read back below one folder."""
    rows = offers_in_order(spark, sf_dir)
    delivered = {s: rows.filter(F.col("source") == s) for s in V.SOURCES}
    return summary(daily.run_day(spark, _fresh(spark, "run"), RUN_AT, delivered))


@query(
    f"{L.WITH_STAR} SELECT 'table' AS section, 'offres' AS cle, count(*) AS n FROM offres UNION ALL "
    "SELECT 'table', 'entreprises', count(*) FROM entreprises UNION ALL SELECT 'table', 'competences', count(*) FROM competences "
    "UNION ALL SELECT 'table', 'offre_competence', count(*) FROM offre_competence "
    "UNION ALL SELECT 'source', source, count(*) FROM offres GROUP BY source"
)
def daily_resumed(spark, sf_dir):
    """A day in three attempts: Bronze alone, then a start that ends when one source is refined, then the rest. Nothing is collected or refined twice."""
    rows, root = offers_in_order(spark, sf_dir), _fresh(spark, "resumed")
    delivered = {s: rows.filter(F.col("source") == s) for s in V.SOURCES}
    daily.run_day(spark, root, RUN_AT, delivered, collect_only=True)
    daily.refine_source(spark, root, V.A, RUN_AT)
    return summary(daily.run_day(spark, root, RUN_AT, delivered))


_COUNTS = (
    "SELECT '{v}' AS version, 'offres' AS cle, count(DISTINCT id) AS n FROM {g} UNION ALL SELECT '{v}', 'entreprises', count(DISTINCT entreprise) FROM {g} "
    "WHERE entreprise <> 'Non spécifié' UNION ALL SELECT '{v}', 'competences', count(DISTINCT nom) FROM (SELECT unnest(skills) AS nom FROM {g}) "
    "UNION ALL SELECT '{v}', 'offre_competence', count(*) FROM (SELECT DISTINCT id, unnest(skills) FROM {g} WHERE id IS NOT NULL)"
)
_FIRST = "(SELECT * FROM gold WHERE source = 'adzuna')"


@query(f"{L.WITH_STAR} {_COUNTS.format(v='après un arrêt', g=_FIRST)} UNION ALL {_COUNTS.format(v='après la reprise', g='gold')}")
def star_versions(spark, sf_dir):
    """What readers see while a second version is half written, and once it is published."""
    rows, root = W.gold(spark, sf_dir), _fresh(spark, "versions")
    publish_star(rows.filter(F.col("source") == V.A), root, "v1")
    load_star(rows, f"{root}/versions/v2")  # a run that ends before its manifest
    half = table_counts(current_star(spark, root)).select(F.lit("après un arrêt").alias("version"), "cle", "n")
    half = spark.createDataFrame(half.collect(), half.schema)  # four numbers, read before the next version is out
    publish_star(rows, root, "v2")
    return half.unionByName(table_counts(current_star(spark, root)).select(F.lit("après la reprise").alias("version"), "cle", "n"))
