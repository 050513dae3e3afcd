"""Market queries over the star schema and over Gold offers."""

from __future__ import annotations

import datetime as dt
import re
import unicodedata

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offermart import vocab as V
from offermart.functions.text import blank, initials, location_tail
from offermart.functions.values import at, display_score, first_tags, shown_company, shown_url
from offermart.operators.ranking import newest, top_counts
from offermart.operators.star import Star

CARD_COLUMNS = ["id_offre", "titre_clean", "entreprise", "ville", "salaire_mensuel", "source", "url"]


# Offers with company and skills ---------------------------------------------------------------------------------


def skills_of(links: DataFrame, competences: DataFrame) -> DataFrame:
    """Sorted skill names per offer; the list is as long as the skills of one offer."""
    named = links.join(competences, "id_competence")
    return named.groupBy("id_offre").agg(F.array_sort(F.collect_set("nom")).alias("competences"))


def offer_cards(star: Star, offers: DataFrame | None = None, empty_as_null: bool = False) -> DataFrame:
    """Every offer with its company name and its skills (``[]`` or null without any)."""
    rows = star.offres if offers is None else offers
    names = star.entreprises.withColumnRenamed("nom", "entreprise")
    cards = rows.join(names, "id_entreprise", "left").join(
        skills_of(star.offre_competence, star.competences), "id_offre", "left"
    )
    if empty_as_null:
        return cards
    return cards.withColumn("competences", F.coalesce("competences", F.array().cast("array<string>")))


def _cards_of_few(star: Star, few: DataFrame) -> DataFrame:
    """Cards of a result that a limit has already bounded: the short side is broadcast, the bridge never shuffles."""
    few = few.select(
        "id_offre", "id_entreprise", "titre_clean", "ville", "salaire_mensuel", "source", "url", "type_contrat",
        "date_scraping",
    )
    links = star.offre_competence.join(F.broadcast(few.select("id_offre")), "id_offre")
    skills = skills_of(links, star.competences)
    names = star.entreprises.withColumnRenamed("nom", "entreprise")
    ids = F.broadcast(few.select("id_entreprise").distinct())
    # Both lookups hold at most one row per row of ``few``.
    few_names = F.broadcast(names.join(ids, "id_entreprise"))
    cards = few.join(few_names, "id_entreprise", "left").join(F.broadcast(skills), "id_offre", "left")
    listed = F.coalesce("competences", F.array().cast("array<string>"))
    return cards.withColumn("competences", listed).withColumn("score_match", display_score(F.size("competences")))


def recent(star: Star, n: int = 10) -> DataFrame:
    """The ``n`` most recent titled offers. The fact is cut to ``n`` rows before anything is joined to it."""
    if not 1 <= n <= 50:
        raise ValueError("n must be between 1 and 50")
    few = newest(star.offres.filter(F.col("titre_clean").isNotNull()), n)
    cards = _cards_of_few(star, few).orderBy(F.col("date_scraping").desc_nulls_first(), "id_offre")
    return cards.select(*CARD_COLUMNS, "competences", "score_match")


def _like(text: str, literal: bool) -> str:
    return "%" + (re.sub(r"([\\%_])", r"\\\1", text) if literal else text) + "%"


def keyword(q: str, *columns: str, literal: bool = False) -> Column:
    """Any of the columns holds ``q``, in any case; ``%`` and ``_`` are wildcards unless ``literal``."""
    pattern = _like(q, literal)
    found = F.col(columns[0]).ilike(pattern)
    for column in columns[1:]:
        found = found | F.col(column).ilike(pattern)
    return found


def search(star: Star, q: str, literal: bool = False, n: int = 50) -> DataFrame:
    """Up to ``n`` most recent offers whose title or description holds ``q``; nothing for an empty ``q``."""
    hit = keyword(q, "titre_clean", "description_clean", literal=literal) if q else F.lit(False)
    cards = _cards_of_few(star, newest(star.offres.filter(hit), n))
    ordered = cards.orderBy(F.col("date_scraping").desc_nulls_first(), "id_offre")
    return ordered.select(*CARD_COLUMNS, "type_contrat", "competences", "score_match")


def search_words(query: str) -> list[str]:
    """Distinct words of a query in lower case, without French stop words; nothing is stemmed."""
    words = re.findall(r"\w+", unicodedata.normalize("NFC", query).lower())
    stop = set(StopWordsRemover.loadDefaultStopWords("french"))
    return [w for w in dict.fromkeys(words) if w not in stop]


def word_array(text: Column) -> Column:
    """Words of a search text in lower case; an empty string may stand at either end."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}_]+")


def token_search(df: DataFrame, query: str, column: str = "recherche_text") -> DataFrame:
    """Rows whose text holds every word of ``query``, found by reading every text; for stored postings see ``operators.postings``."""
    wanted = search_words(query)
    tokens = word_array(F.col(column))
    if not wanted:
        return df.filter(F.lit(False))
    # A text that does not hold the letters of every word is not cut into words.
    for word in wanted:
        df = df.filter(F.lower(column).contains(word))
    return df.filter(F.size(F.array_intersect(tokens, F.array(*[F.lit(w) for w in wanted]))) == len(wanted))


def shown_cards(cards: DataFrame) -> DataFrame:
    """What a list of offers shows: initials, at most four tags, defaults for a missing link or company."""
    return cards.select(
        "id_offre",
        initials(F.col("entreprise")).alias("initiales"),
        F.when(blank(F.col("titre_clean")), "Offre Data").otherwise(F.col("titre_clean")).alias("titre"),
        shown_company(F.col("entreprise")).alias("entreprise"),
        first_tags(F.col("competences")).alias("tags"),
        shown_url(F.col("url")).alias("url"),
        display_score(F.size("competences")).alias("score_match"),
    )


# Skills ---------------------------------------------------------------------------------------------------------


def top_skills(star: Star, n: int = 12) -> DataFrame:
    """Skills by number of offers. Pairs of the bridge are unique, so counting by key first moves only a few rows."""
    counts = star.offre_competence.groupBy("id_competence").agg(F.count("*").alias("count"))
    return counts.join(star.competences, "id_competence").select("nom", "count").orderBy(F.desc("count"), "nom").limit(n)


def top_skill_names(star: Star, n: int = 5) -> DataFrame:
    return top_skills(star, n).orderBy(F.desc("count"), "nom").select("nom")


def skill_bars(top: DataFrame) -> DataFrame:
    """Counts as a percentage of the greatest one. ``top`` is a top-k result, so one window partition holds it."""
    share = F.col("count") / F.max("count").over(Window.partitionBy())
    return top.withColumn("pct", F.floor(share * 100 + 0.5).cast("int"))


def common_skills(gold: DataFrame, n: int = 10) -> DataFrame:
    return top_counts(gold.select(F.explode("competences").alias("nom")), "nom", n)


# Aggregates over offers -----------------------------------------------------------------------------------------


def titled_total(offres: DataFrame) -> DataFrame:
    """Offers that can be shown among the recent ones: those with a title."""
    return offres.agg(F.count("titre_clean").alias("total"))


def total_offers(offers: DataFrame) -> DataFrame:
    return offers.agg(F.count("*").alias("total"))


def by_source(offers: DataFrame) -> DataFrame:
    return top_counts(offers, "source", count="nb")


def by_contract(offers: DataFrame, n: int | None = None) -> DataFrame:
    return top_counts(offers, "type_contrat", n)


def by_location(offers: DataFrame, n: int = 5, tail: bool = False, column: str = "lieu_original") -> DataFrame:
    """Most frequent places; ``tail`` counts the part after the last dash."""
    place = location_tail(F.col(column)) if tail else F.col(column)
    return top_counts(offers.select(place.alias("lieu")), "lieu", n)


def by_keyword(unique_offers: DataFrame) -> DataFrame:
    return top_counts(unique_offers, "query_recherche")


def _rounded(col: Column) -> Column:
    return F.coalesce(F.bround(col.cast("double"), 0), F.lit(0.0)).cast("long")


def mentions_role(role: str) -> Column:
    return keyword(role, "titre_clean", "titre_original")


def _salary_numbers(amount: Column) -> dict[str, Column]:
    return {
        "avg_salary": _rounded(F.avg(amount)),
        "min_salary": _rounded(F.min(amount)),
        "max_salary": _rounded(F.max(amount)),
    }


def salary_stats(offers: DataFrame, role: str | None = None) -> DataFrame:
    """Mean, least and greatest salary, of one role or of all offers; 0 when there is none."""
    rows = offers.filter(F.col("salaire_mensuel").isNotNull())
    if role:
        rows = rows.filter(mentions_role(role))
    return rows.agg(*[c.alias(n) for n, c in _salary_numbers(F.col("salaire_mensuel")).items()])


def salary_by_role(offers: DataFrame, roles: list[str]) -> DataFrame:
    """``salary_stats`` of every role and of all offers (role null), in one pass over the offers."""
    cells = {}
    for i, role in enumerate([None, *roles]):
        amount = F.col("salaire_mensuel") if role is None else F.when(mentions_role(role), F.col("salaire_mensuel"))
        cells |= {f"{name}_{i}": c for name, c in _salary_numbers(amount).items()}
    one = offers.filter(F.col("salaire_mensuel").isNotNull()).agg(*[c.alias(n) for n, c in cells.items()])
    names = ("avg_salary", "min_salary", "max_salary")
    rows = [
        F.struct(F.lit(role).cast("string").alias("role"), *[F.col(f"{n}_{i}").alias(n) for n in names])
        for i, role in enumerate([None, *roles])
    ]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def growth(offers: DataFrame, as_of: dt.datetime, date: str = "date_scraping") -> DataFrame:
    """Offers of the last 30 days against those older than 60 days, in percent; an empty past counts as one."""
    now = at(as_of)
    counts = offers.agg(
        F.count_if(F.col(date) > now - F.expr("INTERVAL 30 DAYS")).alias("recent"),
        F.count_if(F.col(date) < now - F.expr("INTERVAL 60 DAYS")).alias("older"),
    )
    past = F.when(F.col("older") == 0, 1).otherwise(F.col("older"))
    return counts.select("recent", past.alias("past")).withColumn(
        "growth", F.bround((F.col("recent") - F.col("past")) / F.col("past") * 100, 1)
    )


def completeness(offers: DataFrame) -> DataFrame:
    """Offers with a title, a city and a salary, and the shares in percent."""
    counts = offers.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("titre_clean") != "").alias("avec_titre"),
        F.count_if(F.col("ville") != V.NON_SPECIFIE).alias("avec_ville"),
        F.count_if(F.col("salaire_mensuel").isNotNull()).alias("avec_salaire"),
    )
    shares = {
        f"part_{c}": F.round(F.coalesce(F.try_divide(F.col(f"avec_{c}") * 100, F.col("total")), F.lit(0.0)), 1)
        for c in ("titre", "ville", "salaire")
    }
    return counts.withColumns(shares)


def distincts(offers: DataFrame) -> DataFrame:
    """Distinct companies and distinct known cities, each counted from its own distinct values."""
    company = offers.select("entreprise").distinct().agg(F.count("entreprise").alias("n"))
    city = offers.filter(F.col("ville") != V.NON_SPECIFIE).select("ville").distinct().agg(F.count("ville").alias("n"))
    return company.select(F.lit("entreprises").alias("quoi"), "n").unionByName(city.select(F.lit("villes").alias("quoi"), "n"))


def means(gold: DataFrame) -> DataFrame:
    return gold.agg(
        F.bround(F.avg("salaire_mensuel"), 0).alias("salaire_moyen"),
        F.sum("nb_competences").alias("total_competences"),
        F.round(F.avg("nb_competences"), 1).alias("competences_par_offre"),
        F.round(F.avg("score_qualite"), 1).alias("score_moyen"),
    )


# Candidates -----------------------------------------------------------------------------------------------------


def user_skills(users: DataFrame, skills: DataFrame) -> DataFrame:
    """Skills of every user, sorted, repeats kept; a user without any gets a list that holds one null.

    Repeats are counted before a user's rows meet, so only distinct skills travel.
    """
    counted = skills.groupBy("id_utilisateur", "nom_competence").agg(F.count("*").cast("int").alias("n"))
    joined = users.join(counted, "id_utilisateur", "left")
    listed = F.array_sort(F.collect_list(F.struct("nom_competence", F.coalesce("n", F.lit(1)).alias("n"))))
    repeated = F.flatten(F.transform(listed, lambda s: F.array_repeat(s["nom_competence"], s["n"])))
    return joined.groupBy("id_utilisateur").agg(repeated.alias("competences"))


def skill_users(skills: DataFrame) -> DataFrame:
    """Users per skill and their mean experience. Users are made unique before the count, so no group is collected."""
    per_user = skills.groupBy("nom_competence", "id_utilisateur").agg(
        F.sum("annee_experience").alias("s"), F.count("annee_experience").alias("n")
    )
    mean = F.try_divide(F.sum("s"), F.sum("n").cast("double"))
    out = per_user.groupBy("nom_competence").agg(
        F.count("id_utilisateur").alias("nb_utilisateurs"), F.round(mean, 1).alias("experience_moyenne")
    )
    return out.orderBy(F.desc("nb_utilisateurs"), "nom_competence")
