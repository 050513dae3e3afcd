"""Skill extraction.

Every term of a whole-word vocabulary is tested by itself: the text must hold the letters of its pattern, which is a plain search, and only then is
the pattern looked for as a whole word. So terms may share words (``SQL`` and ``SQL Server``) and hold any sign (``C++``, ``Node.js``).
``split_overlaps`` tells which terms no hit of another one can overlap. For tables of very many terms see ``operators.terms``.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

from offermart import vocab as V
from offermart.functions.text import holds, let

SEPARATORS = r"[-\s/]+"

ETL = {V.A: V.SKILLS_ETL_A, V.F: V.SKILLS_ETL_FW, V.W: V.SKILLS_ETL_FW}


def skill_key(name: str) -> str:
    return re.sub(SEPARATORS, "", name.lower())


# What may stand between the letters of a plain pattern: blanks, dashes and slashes, optional or not.
_BETWEEN = r"(?:\[(?:\\s|\\-|[-/ ])+\]|\\s|\\-|\\/|\\ |[-/ ])[?*+]?"


def _words(name: str) -> set[str]:
    """Words that a hit of the name can consist of: its parts, and all of them written together."""
    return {*re.findall(r"\w+", name.lower()), skill_key(name)}


def _regular(name: str, pattern: str) -> bool:
    parts = re.split(SEPARATORS, name.lower())
    return re.sub(_BETWEEN, "", pattern) == skill_key(name) and all(re.fullmatch(r"\w+", p) for p in parts) and len(parts) == len(set(parts))


def split_overlaps(vocabulary: dict[str, str]) -> tuple[dict[str, str], dict[str, str]]:
    """Terms whose hits no other term of the vocabulary can overlap, and the rest."""
    uses = Counter(w for name in vocabulary for w in _words(name))
    alone = {n for n, p in vocabulary.items() if not _regular(n, p) or any(uses[w] > 1 for w in _words(n))}
    return {n: p for n, p in vocabulary.items() if n not in alone}, {n: vocabulary[n] for n in vocabulary if n in alone}


def find_words(text: Column, vocabulary: dict[str, str]) -> Column:
    """Sorted names of the vocabulary whose pattern occurs as a whole word, in any case."""

    def hits(lower: Column) -> Column:
        return F.array_compact(F.array(*[F.when(holds(lower, pattern), F.lit(name)) for name, pattern in vocabulary.items()]))

    if not vocabulary:
        return F.array().cast("array<string>")
    return F.array_sort(let(F.lower(text), hits))


def find_substrings(text: Column, terms: list[str]) -> Column:
    """Sorted terms that occur anywhere in the lower-cased text (so ``r`` is found in any word holding an r)."""

    def hits(lower: Column) -> Column:
        return F.array_compact(F.array(*[F.when(lower.contains(t.lower()), F.lit(t)) for t in sorted(terms)]))

    return let(F.lower(F.coalesce(text, F.lit(""))), hits)


def extract_skills(text: Column, vocabulary: dict[str, str] | list[str], mode: str | None = None) -> Column:
    """``mode`` is ``word`` for a vocabulary of patterns and ``substring`` for a plain list, unless told otherwise."""
    mode = mode or ("word" if isinstance(vocabulary, dict) else "substring")
    if mode == "substring":
        return find_substrings(text, list(vocabulary))
    if not isinstance(vocabulary, dict):
        vocabulary = {t: re.escape(t.lower()) for t in vocabulary}
    return find_words(text, vocabulary)
