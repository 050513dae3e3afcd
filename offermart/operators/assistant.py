"""Market questions: intent and role of a message, and the answer. Works on tables and on streams of messages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offermart import vocab as V
from offermart.functions.labels import first_match
from offermart.functions.text import title_case
from offermart.operators import market
from offermart.operators.star import Star


def intent(message: Column, intents: list[tuple[str, list[str]]] | None = None) -> Column:
    """Name of the first intent one of whose keywords occurs in the message; null without any."""
    lower = F.lower(message)
    rules = []
    for name, keywords in V.INTENTS if intents is None else intents:
        found = lower.contains(keywords[0])
        for word in keywords[1:]:
            found = found | lower.contains(word)
        rules.append((name, found))
    return first_match(rules, None)


def role(message: Column, roles: list[str] | None = None) -> Column:
    """First role that occurs in the message, as it is in the list (lower case); null without any."""
    lower = F.lower(message)
    return first_match([(r, lower.contains(r)) for r in (V.ROLES if roles is None else roles)], None)


def classify(messages: DataFrame, text: str = "text", intents=None, roles=None) -> DataFrame:
    return messages.withColumns(
        {"intent": intent(F.col(text), intents), "role_cite": title_case(role(F.col(text), roles))}
    )


def market_facts(star: Star, as_of: dt.datetime, roles: list[str] | None = None) -> DataFrame:
    """What answers are filled with: one row per role and one without a role (at most as many rows as roles, plus one).

    The offers are scanned once per figure, however many messages are answered.
    """
    salaries = market.salary_by_role(star.offres, V.ROLES if roles is None else roles)
    ranked = market.top_skills(star, 10).agg(
        F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("c"), "nom"))).alias("l")
    )
    skills = ranked.select(
        F.array_join(F.transform("l", lambda s: F.concat(F.lit("• "), s["nom"])), "\n").alias("skills"),
        F.lit(1).alias("one"),
    )
    total = market.total_offers(star.offres).withColumn("one", F.lit(1))
    growing = market.growth(star.offres, as_of).select("growth", F.lit(1).alias("one"))
    facts = salaries.withColumn("one", F.lit(1))
    # Each of these is a single aggregated row.
    for figure in (skills, total, growing):
        facts = facts.join(F.broadcast(figure), "one")
    return facts.drop("one").withColumn("role_cite", title_case(F.col("role"))).drop("role")


def _fill(template: str, **values: Column) -> Column:
    out = F.lit(template)
    for name, value in values.items():
        out = F.replace(out, F.lit("{" + name + "}"), value.cast("string"))
    return out


def answer(messages: DataFrame, facts: DataFrame) -> DataFrame:
    """``messages`` (classified) with ``reponse``. ``facts`` has a row per role, so it is broadcast."""
    role_known = F.col("m.role_cite").eqNullSafe(F.col("f.role_cite"))
    joined = messages.alias("m").join(F.broadcast(facts).alias("f"), role_known, "left")
    reply = (
        F.when(
            F.col("intent") == "salaire",
            _fill(
                V.ANSWER_SALARY,
                role=F.coalesce(F.col("m.role_cite"), F.lit("data")),
                avg=F.col("avg_salary"),
                min=F.col("min_salary"),
                max=F.col("max_salary"),
            ),
        )
        .when(F.col("intent") == "competences", _fill(V.ANSWER_SKILLS, skills=F.col("skills")))
        .when(F.col("intent") == "offres", _fill(V.ANSWER_OFFERS, total=F.col("total")))
        .when(F.col("intent") == "evolution", _fill(V.ANSWER_GROWTH, growth=F.col("growth")))
        .when(F.col("intent") == "cv", V.ANSWER_CV)
        .otherwise(V.ANSWER_DEFAULT)
    )
    return joined.select("m.*", reply.alias("reponse"))
