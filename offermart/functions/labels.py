"""Contracts and experience: table look-ups and ordered rules."""

from __future__ import annotations

from functools import reduce
from itertools import chain
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from offermart import vocab as V
from offermart.functions.text import blank, holds, let, strip


def lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())]), key)


def first_match(rules: list[tuple[str, Column]], default: str | None) -> Column:
    """Label of the first rule whose condition holds."""
    (label, condition), *rest = rules
    out = F.when(condition, label)
    for label, condition in rest:
        out = out.when(condition, label)
    return out if default is None else out.otherwise(default)


def first_word_rule(col: Column, rules: list[tuple[str, str]], default: str) -> Column:
    """Label of the first rule one of whose whole words occurs, in any case."""

    def label(lower: Column) -> Column:
        found = []
        for name, words in rules:
            bodies = [w.removeprefix(r"\b").removesuffix(r"\b").lower() for w in words.split("|")]
            found.append((name, reduce(or_, [holds(lower, b) for b in bodies])))
        return first_match(found, default)

    return let(F.lower(col), label)


def normalize_contract(col: Column, source: str, keep_interim: bool = False) -> Column:
    if source == V.A:
        known = F.coalesce(lookup(V.CONTRACTS_A, F.upper(col)), col)
    elif source == V.F:
        table = {**V.CONTRACTS_F, **(V.CONTRACTS_F_EMITTED if keep_interim else {})}
        known = F.coalesce(lookup(table, F.upper(col)), F.lit(V.NON_SPECIFIE))
    else:
        key = strip(F.upper(col))
        known = F.coalesce(lookup(V.CONTRACTS_W, key), key)
    return F.when(blank(col), V.NON_SPECIFIE).otherwise(known)


def contract_from_code(col: Column) -> Column:
    return F.coalesce(lookup(V.CONTRACT_CODES_F, col), F.lit(V.NON_SPECIFIE))


def contract_from_text(col: Column) -> Column:
    return first_word_rule(col, V.CONTRACT_TEXT_A, V.NON_SPECIFIE)


def contract_from_card(col: Column) -> Column:
    rules = [(label, col.contains(label)) for label in V.CONTRACT_CARD_W]
    return first_match(rules, V.NON_SPECIFIE)


EXPERIENCE = {V.A: V.EXPERIENCE_A, V.F: V.EXPERIENCE_F, V.W: V.EXPERIENCE_W}


def experience_level(col: Column, source: str) -> Column:
    return first_word_rule(col, EXPERIENCE[source], V.NON_SPECIFIE)
